"""Which genome a read comes from: annotation of alignments, best alignments and the one that is assigned.

Alignments have id (sample), read, genome, mismatches and length, and any columns that break ties."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.store import written


#: Alignments that a task takes of those dealt by read.
ROWS = 500_000


def dealt(alignments: DataFrame) -> DataFrame:
    """Alignments (id, read and more) dealt by read to as many tasks as keep a task's share at about ROWS: packed columns hold
    so many rows in what Spark takes for a small partition that sorting or grouping them needs much memory. They are counted
    first, which is quick for tables whose files tell it."""
    return alignments.repartition(max(1, -(-alignments.count() // ROWS)), "id", "read")


def annotate(alignments: DataFrame, expected: DataFrame, controls: DataFrame) -> DataFrame:
    """Adds expected (true for controls as well) and control from tables of (id, genome). These tables are metadata,
    which Spark broadcasts by their size."""
    control = controls.select("id", "genome").distinct().withColumn("control", F.lit(True))
    both = expected.select("id", "genome").unionByName(controls.select("id", "genome")).distinct().withColumn("expected", F.lit(True))
    joined = alignments.join(both, ["id", "genome"], "left").join(control, ["id", "genome"], "left")
    return joined.fillna(False, ["expected", "control"])


def best_alignments(alignments: DataFrame) -> DataFrame:
    """All alignments of a read that have its fewest mismatches."""
    fewest = F.min("mismatches").over(Window.partitionBy("id", "read"))
    return alignments.withColumn("fewest", fewest).filter("mismatches = fewest").drop("fewest")


def genome_counts(best: DataFrame) -> DataFrame:
    """Best alignments of each sample and genome."""
    return best.groupBy("id", "genome").agg(F.count("*").alias("genome_count"))


def assign(best: DataFrame, ties: list[str]) -> DataFrame:
    """Adds assigned: true for one alignment of each read, an expected genome's before others', then the genome's with
    most best alignments in the sample, then the first by ties.

    Counts are summed and joined back, not taken over a window: few samples and genomes share all rows, and a window
    would bring each one's rows to one task. So would a join by sample and genome that shuffles: the counts are written, so
    that Spark knows how small they are."""
    counted = best.join(written(genome_counts(best), "genome-counts"), ["id", "genome"])
    order = [F.desc("expected"), F.desc("genome_count"), *(F.col(c) for c in ties)]
    first = F.row_number().over(Window.partitionBy("id", "read").orderBy(*order)) == 1
    return counted.withColumn("assigned", first).drop("genome_count")


def choose(noted: DataFrame, ties: list[str]) -> DataFrame:
    """assign() of best_alignments(), by one shuffle and one sort of whole alignments: in the order of mismatches, then that
    of assign(), a read's first alignment is the assigned one and tells the fewest mismatches."""
    counts = written(genome_counts(best_alignments(noted.select("id", "read", "genome", "mismatches"))), "genome-counts")
    order = [F.asc_nulls_last("mismatches"), F.desc("expected"), F.desc("genome_count"), *(F.col(c) for c in ties)]
    by_read = Window.partitionBy("id", "read").orderBy(*order)
    placed = noted.join(counts, ["id", "genome"], "left").withColumns({"fewest": F.first("mismatches").over(by_read), "assigned": F.row_number().over(by_read) == 1})
    return placed.filter("mismatches = fewest").select(*noted.columns, "assigned")


def read_level(noted: DataFrame) -> DataFrame:
    """Annotated alignments with what is known of their reads, by one shuffle: fewest mismatches of all, of expected
    genomes that are no controls, and of controls, with lengths, first: true for one alignment of each read, and alike: for
    alignments with the fewest mismatches, how many the read has."""
    by_read = Window.partitionBy("id", "read")
    kinds = {"expected_reads": F.col("expected") & ~F.col("control"), "control_reads": F.col("control")}
    ordered = by_read.orderBy(F.asc_nulls_last("mismatches"))
    columns = {"fewest": F.min("mismatches").over(by_read), "first": F.row_number().over(ordered) == 1, "alike": F.count("*").over(ordered)}
    for kind, of in kinds.items():
        columns[f"{kind}_mismatches"] = F.min(F.when(of, F.col("mismatches"))).over(by_read)
        columns[f"{kind}_length"] = F.max(F.when(of, F.col("length"))).over(by_read)
    return noted.withColumns(columns)


def chosen_and_sums(rows: DataFrame, ties: list[str], pairs: int) -> tuple[DataFrame, DataFrame]:
    """From read_level(), kept by Spark: the best alignments with assigned, and a row for each sample and genome with all that the summaries add up: numbers
    (aligned, assigned, expected_reads, control_reads), mismatches and lengths. pairs: the number of samples times that of
    genomes, which bounds the table of counts.

    The alignments are scanned and shuffled once, by read, as what is kept stays dealt by read. Sums are made of partial
    ones, and a read's figures stand in the sums of one of its genomes. They are written, as counts are taken from them too.
    A read's only best alignment is assigned without a look at counts, so that only ties are joined with these and sorted."""
    n = lambda of: F.sum(F.when(of, 1).otherwise(0))
    best = F.col("mismatches") == F.col("fewest")
    only = best & (F.col("alike") == 1)
    figures = [F.count("*").alias("aligned"), F.sum("mismatches").alias("aligned_mismatches"), F.sum("length").alias("aligned_length"), n(best).alias("genome_count")]
    for kind in ("expected_reads", "control_reads"):
        here = F.col("first") & F.col(f"{kind}_mismatches").isNotNull()
        figures += [n(here).alias(kind), *(F.sum(F.when(here, F.col(f"{kind}_{c}"))).alias(f"{kind}_{c}") for c in ("mismatches", "length"))]
    figures += [n(only).alias("assigned"), *(F.sum(F.when(only, F.col(c))).alias(f"assigned_{c}") for c in ("mismatches", "length"))]
    sums = written(rows.groupBy("id", "genome").agg(*figures), "partial-sums")
    counts = sums.select("id", "genome", "genome_count")
    counts = F.broadcast(counts) if pairs <= SMALL_PAIRS else counts
    own = [c for c in rows.columns if c not in ("fewest", "first", "alike") and not c.startswith(("expected_reads", "control_reads"))]
    order = [F.desc("expected"), F.desc("genome_count"), *(F.col(c) for c in ties)]
    first = F.row_number().over(Window.partitionBy("id", "read").orderBy(*order)) == 1
    tied = rows.filter(best & (F.col("alike") > 1)).select(*own).join(counts, ["id", "genome"]).withColumn("assigned", first).drop("genome_count")
    chosen = rows.filter(only).select(*own).withColumn("assigned", F.lit(True)).unionByName(tied)
    names = ["assigned", "assigned_mismatches", "assigned_length"]
    more = tied.filter("assigned").groupBy("id", "genome").agg(*(x.alias(f"more_{c}") for x, c in zip((F.count("*"), F.sum("mismatches"), F.sum("length")), names, strict=True)))
    joined = sums.drop("genome_count").join(more, ["id", "genome"], "left")
    whole = joined.withColumns({c: F.coalesce(F.col(c), F.lit(0)) + F.coalesce(F.col(f"more_{c}"), F.lit(0)) for c in names})
    return chosen, whole.drop(*(f"more_{c}" for c in names))


#: Pairs of samples and genomes whose counts are broadcast.
SMALL_PAIRS = 500_000
