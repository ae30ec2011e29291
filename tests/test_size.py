"""What a task gets must not grow with a language, a sample or a genome."""

import re

import pytest
from comparing import compare
from pyspark.sql import Window
from pyspark.sql import functions as F

from seqsieve.operators import assign, sampling
from seqsieve.plans import file_queries
from seqsieve.plans import queries as core
from seqsieve.sources import genomes
from seqsieve.sources.fastq import expand
from seqsieve.sources.store import Store


@pytest.fixture
def whole_shuffles(spark):
    """Small partitions of shuffles stay as they are."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


@pytest.fixture
def one_of_each(spark, tmp_path):
    """Documents of one language and one source."""
    rows = spark.range(400).select(F.col("id").alias("doc_id"), F.concat(F.repeat(F.lit("ACGT"), 200), "id").alias("text"), F.lit("en").alias("lang"), F.lit("s").alias("source"))
    rows.write.parquet(f"{tmp_path}/documents.parquet")
    return str(tmp_path)


def test_a_language_is_written_by_many_tasks(spark, one_of_each, whole_shuffles):
    _, files = file_queries._fasta_files(spark, one_of_each)
    found = expand(files["en"])
    sizes = [Store(f).stamp(f)[0] for f in found]
    assert len(found) == 4 and max(sizes) < sum(sizes) / 2


def test_a_range_of_a_file_is_bounded(monkeypatch):
    monkeypatch.setattr(Store, "stamp", lambda self, path: (100 << 30, 0))
    assert file_queries._split(["/x"]) == genomes.SPLIT


def test_a_genome_is_stored_by_many_tasks(spark, one_of_each, whole_shuffles, monkeypatch):
    sizes = []
    monkeypatch.setattr(genomes, "store_genome", lambda spark, name, patterns, folder: sizes.extend(Store(f).stamp(f)[0] for f in expand(patterns)))
    monkeypatch.setattr(genomes, "stored_names", lambda folder: [])
    with pytest.raises(ValueError, match="not found"):
        file_queries.stored_alignment(spark, one_of_each)
    assert len(sizes) == 4 and max(sizes) < sum(sizes) / 2


def test_a_task_reads_one_range_of_a_genome(spark, tmp_path):
    (tmp_path / "a.fa").write_text("".join(f">c{i}\n{'ACGT' * 20}\n" for i in range(200)))
    pieces = genomes.read_pieces(spark, [f"{tmp_path}/a.fa"], 1 << 20, 0, 800)
    found = [r["n"] for r in pieces.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
    assert len(found) == -(-(tmp_path / "a.fa").stat().st_size // 800) and max(found) <= 11


@pytest.mark.parametrize("name", ["chunked_reads", "one_pass_sample", "sampling_summary", "sampling_summary_file", "trim_reads"])
def test_a_source_is_numbered_by_many_tasks(spark, one_of_each, whole_shuffles, monkeypatch, name):
    files = []
    place = sampling.with_place

    def noted(rows, order, column="place", group=None):
        found = place(rows, order, column, group)
        files.append((group, len(found.inputFiles())))
        return found

    monkeypatch.setattr(sampling, "with_place", noted)
    core.QUERIES[name](spark, one_of_each)
    assert ("sample", 4) in files


def test_places_in_a_group_of_many_ranges(spark, whole_shuffles):
    rows = spark.range(1000).select(F.when(F.col("id") < 900, F.lit("a")).when(F.col("id") < 950, F.lit("b")).alias("g"), (F.col("id") * 7 % 501).alias("k"))
    ordered = F.row_number().over(Window.partitionBy("g").orderBy("k")) - 1
    found = sampling.with_place(rows, ["g", "k"], "n", "g")
    assert sorted(map(tuple, found.select("g", "k", "n").collect()), key=repr) == sorted(map(tuple, rows.withColumn("n", ordered).collect()), key=repr)
    kept = sampling.with_place(rows.orderBy(F.desc("k")), [], "n")
    assert [r["k"] for r in kept.orderBy("n").collect()] == sorted((r["k"] for r in rows.collect()), reverse=True)
    assert sampling.with_place(rows.limit(0), ["g", "k"], "n", "g").count() == 0


def run_plan(df):
    """A query's plan as it was run to its end."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_alignments_are_sorted_once(spark, small):
    """A task holds its alignments once, as they wait for one sort."""
    assert run_plan(core.chosen(spark, small)).count("Sort [") == 1


def test_alignments_of_a_task_are_bounded(spark, small, monkeypatch):
    """Reads are counted and chosen by tasks of a bounded number of alignments, none of which meets a part of a read's."""
    monkeypatch.setattr(assign, "ROWS", 500)
    n = -(-core.alignments(spark, small).count() // 500)
    for df in (core.samples(spark, small), core.chosen(spark, small)):
        plan = run_plan(df)
        assert n > 4 and re.findall(r"hashpartitioning\(id#\d+, read#\d+L, (\d+)\), (\w+)", plan) == [(str(n), "REPARTITION_BY_NUM")]
    compare(spark, "assigned_summary", core.assigned_summary(spark, small), core.SQL["assigned_summary"], small)


def test_choice_in_one_sort(spark):
    rows = spark.range(4000).select(
        (F.col("id") % 2).cast("string").alias("id"), (F.col("id") * 13 % 701).alias("read"), F.concat(F.lit("g"), F.col("id") * 7 % 5).alias("genome"),
        F.when(F.col("id") % 31 > 0, F.col("id") * 11 % 3).alias("mismatches"), (F.col("id") % 3 == 0).alias("expected"), F.col("id").alias("position"),
    )
    plain = assign.assign(assign.best_alignments(rows), ["position"])
    found = assign.choose(rows, ["position"])
    assert found.columns == [*rows.columns, "assigned"]
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, plain.select(*found.columns).collect()))


def test_rows_are_numbered_by_many_tasks(spark, small):
    plan = core.QUERIES["row_order"](spark, small)._jdf.queryExecution().optimizedPlan().toString()
    assert "Repartition 1, false" not in plan


def test_only_ties_are_joined_with_counts(spark):
    rows = spark.range(4000).select(
        (F.col("id") % 2).cast("string").alias("id"), (F.col("id") * 13 % 2003).alias("read"), F.concat(F.lit("g"), F.col("id") * 7 % 5).alias("genome"), F.lit(36).alias("length"),
        F.when(F.col("id") % 31 > 0, F.col("id") * 11 % 3).alias("mismatches"), (F.col("id") % 3 == 0).alias("expected"), F.lit(False).alias("control"), F.col("id").alias("position"),
    )
    chosen, sums = assign.chosen_and_sums(assign.read_level(rows), ["position"], 10)
    assert "Union" in chosen._jdf.queryExecution().optimizedPlan().toString()
    plain = assign.assign(assign.best_alignments(rows), ["position"]).select(*chosen.columns)
    assert sorted(map(tuple, chosen.collect())) == sorted(map(tuple, plain.collect()))
    added = plain.filter("assigned").groupBy("id", "genome").agg(F.count("*"), F.sum("mismatches"), F.sum("length"))
    assert sorted(map(tuple, sums.select("id", "genome", "assigned", "assigned_mismatches", "assigned_length").collect())) == sorted(map(tuple, added.collect()))
