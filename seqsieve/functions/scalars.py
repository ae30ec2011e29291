"""Scalar functions whose results must agree with those of R's, as built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def r_round(x: Column, digits: int) -> Column:
    """R's rounding: the nearer of the two candidates with so many digits, and the even one of two as near."""
    p = 10.0**digits
    low, high = F.floor(x * p) / p, F.ceil(x * p) / p
    even = F.pmod(F.floor(x * p), F.lit(2)) == 0
    below, above = x - low, high - x
    return F.when((below < above) | ((below == above) & even), low).otherwise(high)


def percentage(count: Column, total: Column) -> Column:
    """100 * count / total with one digit, and 0 of a total of 0; a null total gives null."""
    share = F.lit(100.0) * count / F.when(total != 0, total)
    return F.when(total == 0, F.lit(0.0)).when(total.isNotNull(), r_round(share, 1))


def error_rate(mismatches: Column, length: Column) -> Column:
    """Percent of bases that do not match, with two digits; null if there are no bases."""
    return r_round(F.lit(100.0) * mismatches / F.when(length != 0, length), 2)


def mismatch_count(described: Column) -> Column:
    """The number of comma-separated mismatches; null or empty: none."""
    return F.coalesce(F.when(described != "", F.regexp_count(described, F.lit(",")) + 1), F.lit(0)).cast("int")


def mismatch_places(described: Column) -> Column:
    """An array of (place, reference, read) of mismatches that are written as place:reference>read."""
    one = "(?s)(\\d+):(.)>(.)"
    part = lambda i: F.regexp_extract_all(described, F.lit(one), F.lit(i))
    return F.transform(F.arrays_zip(part(1).alias("a"), part(2).alias("b"), part(3).alias("c")), lambda x: F.struct(x["a"].cast("int").alias("place"), x["b"].alias("reference"), x["c"].alias("read")))


def null_if_missing(text: Column) -> Column:
    """Empty text and NA are missing in metadata tables."""
    return F.when(~text.isin("", "NA"), text)


def trim_white(text: Column) -> Column:
    """Without any white space, tabs too, at both ends."""
    return F.regexp_replace(text, "^\\s+|\\s+$", "")


def split_tokens(text: Column, spaced: bool = False) -> Column:
    """An array of the parts between bars; spaced: spaces around a bar belong to it."""
    return F.split(text, " *\\| *" if spaced else "\\|")


def yes_no(flag: Column) -> Column:
    """yes, no or null."""
    return F.when(flag, "yes").when(~flag, "no")


def parse_yes(text: Column) -> Column:
    return text == "yes"


def trimmed(text: Column, start: int, length: int) -> Column:
    """The part from a first place (counted from 1) of so many characters, cut at the text's end."""
    return F.substring(text, start, length)
