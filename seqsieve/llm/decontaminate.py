"""Operator 3, benchmark decontamination: size-partitioned MinHash containment search, with DataFrame functions only.

A test item is the set of its five-word shingles, and a document leaks it if it holds at least CONTAINMENT of them.
Items are parted into size classes (powers of two). An item of q shingles may miss at most m = q - ceil(0.8 q) of
them, so of its bottom-k MinHash sketch (the k smallest of its shingle hashes) at least k - m must be found: with
k = (most misses of its size class) + MARGIN, limited to q, no leak is lost, and items of a class share one k. Whole
documents are too long for a sketch of their own to show a short item, so each document's rolling shingle hashes
probe the table of all sketches, and a document that meets enough of an item's sketch is a candidate. Candidates are
verified: the item's shingles are counted in the document by their words.

The tables of items are broadcast if their counted rows and bytes take common.BROADCAST_BYTES at most and shuffled
beyond it; so are candidate ids. All that is shuffled are hits.

An item of one to four words is one shingle of its own length, which documents are searched for if there are such items.

Edge cases: items without words are never found; null items and texts hold nothing;
repeated rows with one id and text are one document, and so is an id with several texts for the pairs (the largest
share counts); a null id stands in a pair as null; empty tables give no pairs; other columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import free_names, materialise, measured, small
from .licenses import GAPS, NO_ID, keyed

SHINGLE, CONTAINMENT, MARGIN = 5, 0.8, 4


def word_array(text):
    """The words of a text column in lower case; a null has none."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), GAPS), "")


def _shingles(rows: DataFrame, keep: list[str], sizes: tuple[int, ...] = (SHINGLE,)) -> DataFrame:
    """A row for each rolling shingle of column words, of each number of words: its hash and words' text."""
    found = None
    for size in sizes:
        here = rows.filter(F.size("words") >= size)
        here = here.select(*keep, "words", F.explode(F.sequence(F.lit(0), F.size("words") - size)).alias("pos"))
        word = [F.col("words")[F.col("pos") + i] for i in range(size)]
        here = here.select(*keep, F.xxhash64(*word).alias("hash"), F.concat_ws(" ", *word).alias("shingle"))
        found = here if found is None else found.unionByName(here)
    return found


def item_shingles(items: DataFrame, id_col: str = "item_id", text_col: str = "text", short: bool = True) -> DataFrame:
    """Distinct shingles of the items (short: those of one to four words too, each one shingle) with their number
    n_shingles, the number need that a leak holds, and whether the shingle is in the item's sketch, of which need_sketch
    must be found."""
    rows = items.select(F.col(id_col).cast("long").alias("item_id"), word_array(F.col(text_col)).alias("words"))
    parts = [_shingles(rows, ["item_id"]), *(_shingles(rows.filter(F.size("words") == n), ["item_id"], (n,)) for n in range(1, SHINGLE if short else 1))]
    rows = reduce(DataFrame.unionByName, parts).distinct()
    by_item = Window.partitionBy("item_id")
    rows = rows.withColumn("n_shingles", F.count("*").over(by_item)).withColumn("rank", F.row_number().over(by_item.orderBy("hash", "shingle")))
    misses = lambda n: F.floor(n - F.ceil(n * 4 / 5 - 1e-9))
    size_class = F.pow(F.lit(2.0), F.ceil(F.log2(F.col("n_shingles").cast("double")) - 1e-9))
    k = F.least(F.col("n_shingles"), misses(size_class) + MARGIN)
    rows = rows.withColumn("k", k).withColumn("need", F.col("n_shingles") - misses(F.col("n_shingles").cast("double")))
    return rows.select("item_id", "hash", "shingle", "n_shingles", "need", (F.col("rank") <= F.col("k")).alias("sketch"), (F.col("k") - F.col("n_shingles") + F.col("need")).alias("need_sketch"))


def leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", short: bool = True) -> DataFrame:
    """key, mark, item_id, n_shared, n_shingles of each document (see licenses.keyed) and item that it leaks."""
    table = materialise(item_shingles(items, item_col, item_text_col, short), "item-shingles")
    sizes = tuple(sorted(r[0] for r in table.select(F.size(F.split("shingle", " "))).distinct().collect())) or (SHINGLE,)  # five numbers at most
    rows = keyed(docs, id_col, text_col).select("key", "mark", word_array(F.col("text")).alias("words"))
    sketches = measured(table.filter("sketch").select("item_id", "hash", "need_sketch"))
    probes = _shingles(rows, ["key", "mark"], sizes).select("key", "mark", "hash")
    met = probes.join(sketches, "hash").groupBy("key", "mark", "item_id", "need_sketch").agg(F.count_distinct("hash").alias("n"))
    candidates = materialise(met.filter("n >= need_sketch").select("key", "mark", "item_id"), "leak-candidates")

    ids = candidates.select("key", "mark").distinct()
    held = _shingles(rows.join(small(ids, candidates.count()), ["key", "mark"], "left_semi"), ["key", "mark"], sizes)
    exact = held.join(measured(table.select("item_id", "hash", "shingle", "n_shingles", "need")), ["hash", "shingle"])
    exact = exact.join(candidates, ["key", "mark", "item_id"], "left_semi")
    exact = exact.groupBy("key", "mark", "item_id", "n_shingles", "need").agg(F.count_distinct("shingle").alias("n_shared"))
    return exact.filter("n_shared >= need").select("key", "mark", "item_id", "n_shared", "n_shingles")


def leaked_pairs(docs: DataFrame, items: DataFrame, **columns: str) -> DataFrame:
    """doc_id, item_id, n_shared, n_shingles and containment of every leak."""
    found = leaks(docs, items, **columns).groupBy("key", "item_id", "n_shingles").agg(F.max("n_shared").alias("n_shared"))
    doc_id = F.when(F.col("key") != NO_ID, F.col("key")).alias("doc_id")
    return found.select(doc_id, "item_id", "n_shared", "n_shingles", (F.col("n_shared") / F.col("n_shingles")).alias("containment"))


def drop_leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that leak no item of five words or more, with all their columns. A phrase of one to four words
    makes no document a copy of a test."""
    found = materialise(leaks(docs, items, id_col, text_col, short=False).select("key", "mark").distinct(), "leaking")
    key, mark = free_names(docs, "__key", "__mark")
    found = found.withColumnsRenamed({"key": key, "mark": mark})
    here = (F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)) == F.col(key)) & (F.xxhash64(text_col) == F.col(mark))
    return docs.join(small(found, found.count()), here, "left_anti")
