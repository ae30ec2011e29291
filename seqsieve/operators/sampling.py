"""Reads: length filter, cap, trimming and reproducible samples.

Reads have sample, ordinal (place among the sample's reads over all of its files), id, seq and qual."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import trimmed
from ..sources.store import shared_folder, written


def long_enough(reads: DataFrame, min_length: int) -> DataFrame:
    return reads.filter(F.length("seq") >= min_length)


def capped(reads: DataFrame, most: int) -> DataFrame:
    """The first reads of each sample, files in their order."""
    return reads.filter(F.col("ordinal") < most)


def trim(reads: DataFrame, start: int, length: int) -> DataFrame:
    """Sequence and quality from start (counted from 1), at most length bases."""
    return reads.withColumns({c: trimmed(F.col(c), start, length) for c in ("seq", "qual")})


def trim_to(reads: DataFrame, length: int) -> DataFrame:
    return trim(reads, 1, length)


def with_place(rows: DataFrame, order: list[str], column: str = "place", group: str | None = None) -> DataFrame:
    """Adds the place of each row, from 0, in an order over all rows, or among the rows of its group, by which the order begins.
    Without an order rows stay in theirs. Rows are sorted into ranges and written to the shared folder; a range's first place is the sum
    of the rows in the ranges before it, so no task sees more than its range, however many rows a group has."""
    spark = rows.sparkSession
    path = shared_folder(spark, "placed")
    ranges = rows.repartitionByRange(*order).sortWithinPartitions(*order) if order else rows
    ranges.withColumns({"__range": F.spark_partition_id(), "__row": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))}).write.parquet(path)
    table = spark.read.parquet(path)
    of = F.lit(0) if group is None else F.col(group)
    # a row for each range, and one more for each group
    counts = table.groupBy("__range", of.alias("__group")).agg(F.count("*").alias("n"), F.min("__row").alias("least")).orderBy("__range").collect()
    kind = "int" if group is None else dict(table.dtypes)[group]
    first: dict[object, int] = {}
    bases = []
    for r in counts:
        before = first.get(r["__group"], 0)
        bases.append((r["__range"], r["__group"], before - r["least"]))
        first[r["__group"]] = before + r["n"]
    bases = spark.createDataFrame(bases, f"__at int, __group {kind}, __base long")
    here = (F.col("__range") == F.col("__at")) & of.eqNullSafe(F.col("__group"))
    placed = table.join(F.broadcast(bases), here).withColumn(column, F.col("__base") + F.col("__row"))
    return placed.drop("__range", "__row", "__at", "__group", "__base")


def chunk_numbers(reads: DataFrame, chunk_size: int, order: list[str] | None = None) -> DataFrame:
    """Adds place and chunk: every chunk_size reads over all samples, from 0. Sinks use it; no result depends on it."""
    placed = with_place(reads, order or ["sample", "ordinal"])
    return placed.withColumn("chunk", F.floor(F.col("place") / chunk_size).cast("long"))


def hash_sample(rows: DataFrame, group: str, size: int, seed: str, *key: str) -> DataFrame:
    """Exactly min(size, rows) rows of each group, uniform and the same for the same seed: those whose md5 of seed and
    key is lowest. key tells the rows of a group apart.

    A histogram of 4,096 classes of hashes is summed first. It gives each group's highest class that can be needed, so
    that only about `size` rows of a group are shuffled and sorted, however many it has."""
    hashed = rows.withColumn("__hash", F.md5(F.concat_ws("|", F.lit(seed), *(F.col(k).cast("string") for k in key)).cast("binary")))
    hashed = hashed.withColumn("__class", F.substring("__hash", 1, 3))
    counts = hashed.groupBy(group, "__class").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy(group).orderBy("__class")) - F.col("n")
    limits = counts.withColumn("before", before).filter(F.col("before") < size).groupBy(group).agg(F.max("__class").alias("__last"))
    near = hashed.join(limits, group).filter("__class <= __last")
    first = F.row_number().over(Window.partitionBy(group).orderBy("__hash", *key))
    return near.withColumn("__n", first).filter(F.col("__n") <= size).drop("__hash", "__class", "__last", "__n")


def sample_reads(reads: DataFrame, size: int, min_length: int, seed: str) -> DataFrame:
    """A sample of the reads that are long enough."""
    return hash_sample(long_enough(reads, min_length), "sample", size, seed, "sample", "ordinal")


def sampling_summary(reads: DataFrame, sampled: DataFrame) -> DataFrame:
    """id, read (all reads, the short ones too) and sampled."""
    all_reads = reads.groupBy(F.col("sample").alias("id")).agg(F.count("*").alias("read"))
    taken = sampled.groupBy(F.col("sample").alias("id")).agg(F.count("*").alias("sampled"))
    return all_reads.join(taken, "id", "left").fillna(0, ["sampled"])


#: Hexadecimal digits of a hash that a task compares rows by; rows that are alike in them stay together.
DIGITS = 15


def _lowest(size: int, names: list[str]):
    """Keeps the rows of each sample whose hashes are lowest, `size` of them and those alike with the last, and counts all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[object, tuple[list[pa.Table], list[np.ndarray]]] = {}
        counts: dict[object, list[int]] = {}
        schema = None

        def cut(sample: object) -> None:
            tables, values = kept[sample]
            table, value = pa.concat_tables(tables), np.concatenate(values)
            if len(value) > size:
                mine = value <= np.partition(value, size - 1)[size - 1]
                table, value = table.filter(pa.array(mine)).combine_chunks(), value[mine]
            kept[sample] = [table], [value]

        for batch in batches:
            table = pa.Table.from_batches([batch])
            schema = table.schema
            codes = batch.column("sample").dictionary_encode()
            numbers = pc.fill_null(codes.indices, -1).to_numpy(zero_copy_only=False)
            long_enough_ = batch.column("__eligible").to_numpy(zero_copy_only=False).astype(bool)
            values = batch.column("__value").to_numpy(zero_copy_only=False)
            for number in np.unique(numbers).tolist():
                sample = codes.dictionary[number].as_py() if number >= 0 else None
                here = numbers == number
                n = counts.setdefault(sample, [0, 0])
                n[0] += int(here.sum())
                here &= long_enough_
                n[1] += int(here.sum())
                if here.any():
                    tables, old = kept.setdefault(sample, ([], []))
                    tables.append(table.filter(pa.array(here)))
                    old.append(values[here])
                    if sum(map(len, old)) > 2 * size + ROWS:
                        cut(sample)
        for sample in list(kept):
            cut(sample)
            for found in kept[sample][0][0].select(names).to_batches(max_chunksize=ROWS):
                columns = [*found.columns, pa.nulls(len(found), pa.int64()), pa.nulls(len(found), pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=[*names, "__n", "__fit"])
        if counts:
            nulls = {c: pa.nulls(len(counts), schema.field(c).type) for c in names}
            nulls["sample"] = pa.array(list(counts), schema.field("sample").type)
            columns = [nulls[c] for c in names] + [pa.array([n[i] for n in counts.values()], pa.int64()) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "__n", "__fit"])

    return run


#: Rows of a batch, and those beyond twice the sample that a task holds before it cuts them.
ROWS = 10_000


def one_pass_sample(reads: DataFrame, size: int, min_length: int, seed: str) -> tuple[DataFrame, DataFrame]:
    """sample_reads() and sampling_summary() by one pass over the reads. Each task keeps the lowest hashes of each of its
    samples, as many as are wanted, and counts all reads; what tasks kept is written, and hash_sample() takes the sample
    from that. A task holds the reads that are wanted of a sample, twice at most, for the samples whose files it reads."""
    from pyspark.sql.types import LongType, StructField, StructType

    key = ("sample", "ordinal")
    value = F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(seed), *(F.col(k).cast("string") for k in key)).cast("binary")), 1, DIGITS), 16, 10).cast("long")
    marked = reads.withColumns({"__value": value, "__eligible": F.coalesce(F.length("seq") >= min_length, F.lit(False))})
    schema = StructType([*(StructField(f.name, f.dataType) for f in reads.schema), StructField("__n", LongType()), StructField("__fit", LongType())])
    table = written(marked.mapInArrow(_lowest(size, reads.columns), schema), "lowest")
    sampled = hash_sample(table.filter("__n is null").drop("__n", "__fit"), "sample", size, seed, *key)
    sums = table.filter("__n is not null").groupBy(F.col("sample").alias("id")).agg(F.sum("__n").alias("read"), F.sum("__fit").alias("fit"))
    return sampled, sums.select("id", "read", F.least("fit", F.lit(size)).alias("sampled"))
