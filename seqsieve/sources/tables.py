"""Readers and sinks of the metadata, alignment and summary tables. Schemas are fixed; columns are taken by name, so
their order in a file does not matter."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import mismatch_count, yes_no
from ..operators.checks import require_columns
from ..operators.resolve import cleaned
from .store import Store

GENOME_ALIGNMENTS = {"id": "string", "read": "string", "genome": "string", "chromosome": "string", "position": "long", "strand": "string", "sequence": "string", "quality": "string", "mismatches": "string"}
CHECKED_SAMPLES = ["id", "user_id", "species", "controls", "genomes", "control_genomes"]
ADAPTER_ALIGNMENTS = {
    "id": "string", "read": "string", "start": "int", "end": "int", "strand": "string", "adapter": "string", "adapter start": "int", "adapter end": "int",
    "adapter strand": "string", "percent identity": "double", "score": "int",
}
#: Fixed value: how an index's last file is named.
INDEX_SUFFIX = re.compile(r"\.rev\.1\.ebwtl?$")


def read_metadata(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """A comma-separated table with a header; empty and NA values are null."""
    df = spark.read.csv(path, header=True, escape='"', ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True)
    return cleaned(require_columns(df, columns, path))


def read_tsv(spark: SparkSession, path: str, columns: dict[str, str]) -> DataFrame:
    """A tab-separated table; a quote is a character like any other, as it may stand for a base's quality."""
    df = require_columns(spark.read.csv(path, header=True, sep="\t", quote=""), list(columns), path)
    return df.select(*(F.col(f"`{c}`").cast(t).alias(c) for c, t in columns.items()))


def genome_alignments(spark: SparkSession, path: str, describe: bool = False) -> DataFrame:
    """Alignments as the operators want them: mismatches counted, and the aligned length. describe: the mismatches as they
    are written stay in the column described, as the native aligner has them."""
    df = read_tsv(spark, path, GENOME_ALIGNMENTS)
    df = df.withColumn("described", F.coalesce("mismatches", F.lit(""))) if describe else df
    return df.withColumns({"mismatches": mismatch_count(F.col("mismatches")), "length": F.length("sequence")})


def adapter_alignments(spark: SparkSession, path: str) -> DataFrame:
    return read_tsv(spark, path, ADAPTER_ALIGNMENTS)


def sampling_summary(spark: SparkSession, path: str) -> DataFrame:
    """id, read and sampled of each sample."""
    df = read_metadata(spark, path, ["id", "read", "sampled"])
    return df.select("id", *(F.col(c).cast("double").cast("long").alias(c) for c in ("read", "sampled")))


#: Columns of the written summaries that the chart reads, with their kinds.
ALIGNMENT_SUMMARY = {
    "id": "string", "genome": "string", "species": "string", "expected": "string", "control": "string", "aligned": "long", "aligned %": "double", "error rate": "double",
    "assigned": "long", "assigned %": "double", "assigned error rate": "double",
}
SUMMARY = {"id": "string", "sequences": "long", "sampled": "long", "adapter": "long"}


def _summary(spark: SparkSession, path: str, columns: dict[str, str]) -> DataFrame:
    df = read_metadata(spark, path, list(columns))
    return df.select(*(F.col(f"`{c}`").cast(t).alias(c) for c, t in columns.items()))


def summary(spark: SparkSession, path: str) -> DataFrame:
    """The columns of a written sample summary that the chart needs."""
    return _summary(spark, path, SUMMARY)


def alignment_summary(spark: SparkSession, path: str, place: str | None = None) -> DataFrame:
    """A written alignment summary; place: a column for the rows' order in the one file that it is."""
    df = _summary(spark, path, ALIGNMENT_SUMMARY)
    return df if place is None else df.coalesce(1).withColumn(place, F.monotonically_increasing_id())


BY_SAMPLE = {"header": True, "sep": "\t", "quote": "", "compression": "gzip"}


def write_by_sample(df: DataFrame, samples: DataFrame, path: str) -> None:
    """A folder path/id=ID of files for each sample, told by column id; a sample without rows has a file with the header
    alone. samples: the sheet, whose few ids the driver lists."""
    out = printable(df)
    out.write.mode("overwrite").partitionBy("id").options(**BY_SAMPLE).csv(path)
    empty = [r["id"] for r in samples.select("id").join(df.select("id").distinct(), "id", "left_anti").collect()]
    for name in empty:
        out.drop("id").limit(0).write.mode("overwrite").options(**BY_SAMPLE).csv(f"{path.rstrip('/')}/id={name}")


def read_by_sample(spark: SparkSession, path: str, columns: dict[str, str]) -> DataFrame:
    """What write_by_sample wrote."""
    kinds = ", ".join(f"`{c}` {t}" for c, t in columns.items())
    return spark.read.csv(path, header=True, sep="\t", quote="", schema=kinds)


def index_names(files: list[str]) -> list[str]:
    """Names of indexes, from the names of their files."""
    found = {INDEX_SUFFIX.sub("", f.rsplit("/", 1)[-1]) for f in files if INDEX_SUFFIX.search(f)}
    return sorted(found)


def index_table(spark: SparkSession, files: list[str]) -> DataFrame:
    """Names of indexes from names of files, or of all files that fit a pattern."""
    files = [x for f in files for x in (Store(f).find(f) if "*" in f else [f])]
    return spark.createDataFrame([(n,) for n in index_names(files)], "id string")


def printable(df: DataFrame) -> DataFrame:
    """Columns as text: no trailing .0 after whole numbers, yes and no for flags."""

    def text(field: T.StructField):
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DoubleType):
            return F.regexp_replace(c.cast("string"), "\\.0$", "").alias(field.name)
        return (yes_no(c) if isinstance(field.dataType, T.BooleanType) else c).alias(field.name)

    return df.select(*map(text, df.schema.fields))


def write_table(df: DataFrame, path: str, sep: str = ",", compress: bool = False, one_file: bool = True) -> None:
    """A table with a header; null is empty. Summaries are small and one file; alignments keep their partitions."""
    out = printable(df)
    out = out.coalesce(1) if one_file else out
    options = {"header": True, "sep": sep, "emptyValue": "", "nullValue": "", "escape": '"', "compression": "gzip" if compress else "none"}
    if sep == "\t":
        options["quote"] = ""
    out.write.mode("overwrite").options(**options).csv(path)


def split_first_bar(column: str, left: str, right: str) -> list:
    """Two columns of a combined name sample|read, cut at its first bar."""
    parts = F.split(F.col(column), "\\|", 2)
    return [parts[0].alias(left), F.get(parts, F.lit(1)).alias(right)]
