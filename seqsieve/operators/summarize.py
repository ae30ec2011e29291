"""Summaries for each sample and for each sample and genome. Samples and genomes are dimension tables with an ordinal:
their rows are in every summary, whether or not alignments mention them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import error_rate, percentage, yes_no


def _with_share(df: DataFrame, totals: DataFrame) -> DataFrame:
    """Adds percentage of the sampled reads (totals: id, total); a missing count is 0."""
    joined = df.join(totals, "id", "left").withColumn("count", F.coalesce("count", F.lit(0)).cast("long"))
    return joined.withColumn("percentage", percentage(F.col("count"), F.col("total"))).drop("total")


def spine(samples: DataFrame, genomes: DataFrame) -> DataFrame:
    """Every pair of a sample and a genome: two small dimension tables."""
    return samples.select("id").crossJoin(genomes.select("genome"))


def _totals(samples: DataFrame) -> DataFrame:
    return samples.select("id", F.col("sampled").alias("total"))


def adapter_counts(matches: DataFrame, samples: DataFrame) -> DataFrame:
    """Distinct reads with an adapter: id, count, percentage."""
    counts = matches.select("id", "read").distinct().groupBy("id").agg(F.count("*").alias("count"))
    return _with_share(samples.select("id").join(counts, "id", "left"), _totals(samples)).select("id", "count", "percentage")


def read_summary(alignments: DataFrame, samples: DataFrame) -> DataFrame:
    """Aligned reads of each sample, each by its fewest mismatches: id, count, percentage, error_rate."""
    reads = alignments.groupBy("id", "read").agg(F.min("mismatches").alias("mismatches"), F.max("length").alias("length"))
    sums = reads.groupBy("id").agg(F.count("*").alias("count"), error_rate(F.sum("mismatches"), F.sum("length")).alias("error_rate"))
    return _with_share(samples.select("id").join(sums, "id", "left"), _totals(samples)).select("id", "count", "percentage", "error_rate")


def expected_summary(alignments: DataFrame, samples: DataFrame) -> DataFrame:
    """read_summary() of expected genomes that are no controls."""
    return read_summary(alignments.filter("expected and not control"), samples)


def control_summary(alignments: DataFrame, samples: DataFrame) -> DataFrame:
    return read_summary(alignments.filter("control"), samples)


def genome_summary(alignments: DataFrame, samples: DataFrame, genomes: DataFrame) -> DataFrame:
    """Alignments of each sample and genome: id, genome, count, percentage, error_rate."""
    sums = alignments.groupBy("id", "genome").agg(F.count("*").alias("count"), error_rate(F.sum("mismatches"), F.sum("length")).alias("error_rate"))
    dense = spine(samples, genomes).join(sums, ["id", "genome"], "left")
    return _with_share(dense, _totals(samples)).select("id", "genome", "count", "percentage", "error_rate")


def genome_part(sums: DataFrame, samples: DataFrame, genomes: DataFrame, kind: str) -> DataFrame:
    """genome_summary() from assign.chosen_and_sums(); kind: aligned or assigned."""
    rate = F.when(F.col(kind) > 0, error_rate(F.col(f"{kind}_mismatches"), F.col(f"{kind}_length")))
    dense = spine(samples, genomes).join(sums.select("id", "genome", F.col(kind).alias("count"), rate.alias("error_rate")), ["id", "genome"], "left")
    return _with_share(dense, _totals(samples)).select("id", "genome", "count", "percentage", "error_rate")


def read_part(sums: DataFrame, samples: DataFrame, kind: str) -> DataFrame:
    """read_summary() from the same; kind: expected_reads or control_reads."""
    rate = F.when(F.sum(kind) > 0, error_rate(F.sum(f"{kind}_mismatches"), F.sum(f"{kind}_length")))
    found = sums.groupBy("id").agg(F.sum(kind).alias("count"), rate.alias("error_rate"))
    return _with_share(samples.select("id").join(found, "id", "left"), _totals(samples)).select("id", "count", "percentage", "error_rate")


def unmapped_summary(assigned: DataFrame, samples: DataFrame) -> DataFrame:
    """Sampled reads that no genome got, from genome_summary() of assigned alignments: id, count, percentage."""
    aligned = assigned.groupBy("id").agg(F.sum("count").alias("aligned"))
    left = _totals(samples).join(aligned, "id", "left").withColumn("count", F.col("total") - F.coalesce("aligned", F.lit(0)))
    return left.select("id", "count", percentage(F.col("count"), F.col("total")).alias("percentage"))


def _renamed(df: DataFrame, count: str, share: str, rate: str = "") -> DataFrame:
    return df.withColumnsRenamed({"count": count, "percentage": share} | ({"error_rate": rate} if rate else {}))


SUMMARY = [
    "id", "species", "controls", "genomes", "control genomes", "sequences", "sampled", "genome aligned", "genome aligned %", "genome error rate",
    "control aligned", "control aligned %", "control error rate", "unmapped", "unmapped %", "adapter", "adapter %",
]
ALIGNMENT_SUMMARY = ["id", "genome", "species", "expected", "control", "aligned", "aligned %", "error rate", "assigned", "assigned %", "assigned error rate"]


def sample_summary(samples: DataFrame, expected: DataFrame, control: DataFrame, unmapped: DataFrame, adapters: DataFrame) -> DataFrame:
    """A row for each sample with the columns of SUMMARY, by ordinal. samples: id, ordinal, user_id, species, controls,
    genomes, control_genomes, sequences, sampled."""
    joined = (
        samples.join(_renamed(expected, "genome aligned", "genome aligned %", "genome error rate"), "id", "left")
        .join(_renamed(control, "control aligned", "control aligned %", "control error rate"), "id", "left")
        .join(_renamed(unmapped, "unmapped", "unmapped %"), "id", "left")
        .join(_renamed(adapters, "adapter", "adapter %"), "id", "left")
        .withColumn("id", F.col("user_id"))
        .withColumnRenamed("control_genomes", "control genomes")
    )
    return joined.orderBy("ordinal").select(*(F.col(f"`{c}`") for c in SUMMARY))


def alignment_summary(samples: DataFrame, genomes: DataFrame, aligned: DataFrame, assigned: DataFrame, unmapped: DataFrame, expected: DataFrame, controls: DataFrame) -> DataFrame:
    """A row for each sample and genome and one for what is unmapped, with the columns of ALIGNMENT_SUMMARY; by sample,
    most assigned reads first. genomes: genome, ordinal, species."""
    control = controls.select("id", "genome").distinct().withColumn("control", F.lit(True))
    both = expected.select("id", "genome").unionByName(controls.select("id", "genome")).distinct().withColumn("expected", F.lit(True))
    rows = (
        _renamed(aligned, "aligned", "aligned %", "error rate")
        .join(_renamed(assigned, "assigned", "assigned %", "assigned error rate"), ["id", "genome"], "left")
        .join(genomes.select("genome", "species", F.col("ordinal").alias("genome_ordinal")), "genome", "left")
        .join(both, ["id", "genome"], "left")
        .join(control, ["id", "genome"], "left")
        .fillna(False, ["expected", "control"])
    )
    last = unmapped.select(
        "id",
        F.lit("unmapped").alias("genome"),
        F.col("count").alias("aligned"),
        F.col("percentage").alias("aligned %"),
        F.col("count").alias("assigned"),
        F.col("percentage").alias("assigned %"),
    )
    rows = rows.unionByName(last, allowMissingColumns=True).join(samples.select("id", "user_id", "ordinal"), "id")
    rows = rows.orderBy("ordinal", F.col("expected").isNull(), F.desc("assigned"), "genome_ordinal")
    rows = rows.withColumns({"id": F.col("user_id"), "expected": yes_no(F.col("expected")), "control": yes_no(F.col("control"))})
    return rows.select(*(F.col(f"`{c}`") for c in ALIGNMENT_SUMMARY))
