"""The corpus pipeline: five stages, each over all that the one before kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seqsieve.llm import decontaminate, jaccard_join, line_dedup, pieces, quality
from seqsieve.llm.common import documents, free_names, materialise
from seqsieve.llm.queries import tokenizer_path


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return quality.keep_good(docs, quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def remove_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later matches of lines go from the texts; a document that loses its whole text goes. n_chars follows the text."""
    lines, removed = free_names(docs, "n_lines", "n_removed")
    found = line_dedup.dedup_lines(docs, counts=(lines, removed))
    found = found.filter((F.col(removed) == 0) | (F.col(removed) < F.col(lines)))
    if "n_chars" in docs.columns:
        n_chars = F.when(F.col(removed) > 0, F.length("text")).otherwise(F.col("n_chars"))
        found = found.withColumn("n_chars", n_chars.cast(docs.schema["n_chars"].dataType))
    return found.drop(lines, removed)


def join_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the first by id and text."""
    return jaccard_join.keep_first(docs)


def decontaminate_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of what is left, and whether they decode to the text again."""
    return pieces.encode(docs, tokenizer_path("piece_bpe_32k.model"))


STAGES = [
    ("quality", quality_filter),
    ("line_dedup", remove_lines),
    ("jaccard_join", join_near_copies),
    ("decontamination", decontaminate_benchmark),
    ("sentencepiece", encode_pieces),
]

#: No SQL: a fitted classifier, MinHash pruning and a tokenizer are no SQL expressions. Tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over documents; each one's rows are a written table that the next reads."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
