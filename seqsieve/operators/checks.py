"""Validations. Metadata tables are small; what is brought to the driver are the offending values for the message."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


class ScreenError(ValueError):
    """Input that a screen cannot run on."""


def _raise_for(values: DataFrame, message: str) -> None:
    found = [r[0] for r in values.limit(20).collect()]
    if found:
        raise ScreenError(f"{message}: " + ", ".join(f"'{x}'" for x in found))


def require_columns(df: DataFrame, columns: Iterable[str], what: str) -> DataFrame:
    """df with these columns only; an error names those that it lacks."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ScreenError(f"missing columns in {what}: " + ", ".join(f"'{c}'" for c in missing))
    return df.select(*(F.col(f"`{c}`") for c in columns))


def require_rows(df: DataFrame, what: str) -> DataFrame:
    if df.isEmpty():
        raise ScreenError(f"{what} is empty")
    return df


def require_value(df: DataFrame, column: str, what: str) -> DataFrame:
    if not df.filter(F.col(column).isNull()).isEmpty():
        raise ScreenError(f"missing {column} in {what}")
    return df


def duplicates(df: DataFrame, column: str) -> DataFrame:
    """Values that more than one row has, with their number."""
    return df.groupBy(column).agg(F.count("*").alias("n")).filter("n > 1")


def case_duplicates(df: DataFrame, column: str) -> DataFrame:
    """Values that differ from another row's at most by case."""
    lower = F.lower(F.col(column))
    counted = df.select(F.col(column), lower.alias("lower"), F.count("*").over(Window.partitionBy(lower)).alias("n"))
    return counted.filter("n > 1").orderBy("lower", column).select(column)


def with_bar(df: DataFrame, column: str) -> DataFrame:
    """Values that hold the separator of lists."""
    return df.filter(F.col(column).contains("|")).select(column).orderBy(column)


def require_unique(df: DataFrame, column: str, what: str) -> DataFrame:
    _raise_for(duplicates(df, column).orderBy(column), f"duplicate {column} in {what}")
    return df


def require_case_unique(df: DataFrame, column: str, what: str) -> DataFrame:
    _raise_for(case_duplicates(df, column), f"{column} in {what} that differ only by case")
    return df


def require_no_bar(df: DataFrame, column: str, what: str) -> DataFrame:
    _raise_for(with_bar(df, column), f"{column} in {what} with the character |")
    return df


def ambiguous_synonyms(synonyms: DataFrame) -> DataFrame:
    """Synonyms of more than one genome; synonyms holds distinct (genome, synonym)."""
    return synonyms.groupBy("synonym").agg(F.count("*").alias("n")).filter("n > 1")


def repeated_reads(reads: DataFrame) -> DataFrame:
    """(sample, id) of reads that occur more than once."""
    return reads.groupBy("sample", "id").agg(F.count("*").alias("n")).filter("n > 1")


def record_problem() -> Column:
    """The first fault of a record's id, seq and qual, or null."""
    ascii_only = "^[\\x00-\\x7F]*$"
    return (
        F.when(F.coalesce(F.col("id"), F.lit("")) == "", "no id")
        .when(F.col("seq").isNull(), "no sequence")
        .when(F.col("qual").isNull(), "no quality")
        .when(~F.col("seq").rlike(ascii_only), "sequence is not ASCII")
        .when(~F.col("qual").rlike(ascii_only), "quality is not ASCII")
        .when(F.length("seq") != F.length("qual"), "sequence and quality differ in length")
    )
