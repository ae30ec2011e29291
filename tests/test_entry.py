"""The driver's contract: every core query against its SQL on the smallest tables."""

import pytest
from comparing import compare

import __spark_entry__ as entry
from seqsieve.plans import queries as core


@pytest.mark.parametrize("name", sorted(core.SQL))
def test_query_equals_sql(spark, small, name):
    compare(spark, name, core.QUERIES[name](spark, small), core.SQL[name], small)


def test_contract(spark, small):
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(core.QUERIES) <= set(entry.queries())
    assert entry.entry(spark).count() == 33


def test_records_hold_whole_texts(spark, small):
    texts = {r["doc_id"]: r["text"].replace("\n", " ") for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    got = {r["doc_id"]: r for r in core.QUERIES["record_texts"](spark, small).collect()}
    assert got.keys() == texts.keys() and max(map(len, texts.values())) > 1000
    for i, t in texts.items():
        assert got[i]["fastq"].split("\n")[1::2] == [t, t]
        assert got[i]["fasta"].split("\n")[1:] == [t[n : n + 80] for n in range(0, len(t), 80)]


def test_screen_compares_whole_passages(spark, tmp_path):
    passage = "the opening of a passage, thirty-six letters and more, and its end"
    spark.createDataFrame([(1, f"x {passage} y"), (2, passage[:40] + " another end")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(5, passage)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for name in ("nation", "region"):
        spark.createDataFrame([], f"{name[0]}_{name}key int, {name[0]}_name string").write.parquet(f"{tmp_path}/{name}.parquet")
    assert [tuple(r) for r in core.QUERIES["exact_seed_screen"](spark, str(tmp_path)).collect()] == [(1, 5, 2)]


def test_all_orders_reach_the_check_of_names(spark, small):
    urgent = spark.read.parquet(f"{small}/orders.parquet").filter("o_orderpriority like '1%'").count()
    got = [r["url"] for r in core.QUERIES["names_with_bar"](spark, small).collect()]
    assert urgent > 0 and sum(x.startswith("1-") and x.endswith("|") for x in got) == urgent
