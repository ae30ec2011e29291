from decimal import ROUND_HALF_EVEN, Decimal

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from seqsieve import functions as fn


def column(spark, values, kind, f):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r["y"] for r in df.withColumn("y", f(F.col("x"))).orderBy("i").collect()]


def test_rounding_goldens(spark):
    share = lambda pairs: spark.createDataFrame(pairs, "count long, total long").select(fn.percentage(F.col("count"), F.col("total")).alias("p"))
    assert [r["p"] for r in share([(3, 2000), (7, 2000), (1, 16), (150, 100000), (5, 0), (0, 10), (1, None)]).collect()] == [0.1, 0.3, 6.2, 0.1, 0.0, 0.0, None]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.integers(0, 10**6), min_size=1, max_size=50))
def test_rounding_is_nearest(spark, values):
    got = column(spark, [v / 1000 for v in values], "double", lambda x: fn.r_round(x, 1))
    for v, r in zip(values, got, strict=True):
        assert abs(Decimal(r) - Decimal(v / 1000)) <= Decimal("0.0500001")
        near = Decimal(v / 1000).quantize(Decimal("0.1"), ROUND_HALF_EVEN)
        assert float(near) == r or abs(Decimal(v / 1000) - near) > Decimal("0.0499")


def test_error_rate_and_mismatches(spark):
    rows = spark.createDataFrame([(1, 36), (2, 72), (0, 0)], "m long, n long").select(fn.error_rate(F.col("m"), F.col("n")).alias("e")).collect()
    assert [r["e"] for r in rows] == [2.78, 2.78, None]
    assert column(spark, [None, "3:A>C", "3:A>C,5:G>T"], "string", fn.mismatch_count) == [0, 1, 2]


def test_text_helpers(spark):
    assert column(spark, ["", "NA", "x", None, "na"], "string", fn.null_if_missing) == [None, None, "x", None, "na"]
    assert column(spark, ["\t a b \n", " "], "string", fn.trim_white) == ["a b", ""]
    assert column(spark, ["human|", "a | b"], "string", fn.split_tokens) == [["human", ""], ["a ", " b"]]
    assert column(spark, ["a | b"], "string", lambda c: fn.split_tokens(c, True)) == [["a", "b"]]
    assert column(spark, [True, False, None], "boolean", fn.yes_no) == ["yes", "no", None]
    assert column(spark, ["yes", "no", None], "string", fn.parse_yes) == [True, False, None]
