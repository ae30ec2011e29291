"""Operator 6, n-gram Jaccard join: five-word shingles, similarity 0.8 or more, Bayesian pruning of candidates.

1. Texts with one shingle set are one class (128-bit fingerprint), told by its first row in the order of id and text.
2. Each class puts itself into BANDS buckets of ROWS MinHash values each. At similarity 0.8 a pair misses all buckets
   with probability 1.4e-7; at 0.1 it meets in one with probability 0.003.
3. Pairs are made inside buckets only. A bucket of many classes is cut into blocks, and each pair of blocks is one
   group's work; a pair that meets in several buckets counts in the first. HASHES other MinHash values, which did not
   choose the pair, travel with a bucket's rows and are compared STEP at a time; a pair is dropped when the posterior
   probability that it reaches the threshold falls below TOLERANCE. Only members of pairs that are left get their
   shingle sets, in a second pass over the same groups, and are verified exactly. No pair leaves its group: what does
   is each class's number of links and a spanning forest.
4. The forests' components are the classes of near copies; links count documents, copies included.

Verified pairs are counted one by one: n different texts that are all near each other cost n * n / 2 comparisons, spread
over all tasks. Exact copies cost nothing of this.

Edge cases: texts with one to four words are one shingle; texts without words, null texts and rows with a null id have
no links and their own class; repeated rows are copies; texts that share an id are texts of their own, each with its
class and links; an empty table gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free_names, map_batches, materialise, small, steps, utf8
from .components import block_pairs, connected_components, split_join
from .licenses import NO_ID, keyed
from .setsim import fingerprint, least_matches, minhash, sets_of, shingles, similar
from .words import mix

BANDS, ROWS, HASHES, STEP, TOLERANCE = 30, 4, 64, 16, 1e-9
#: Classes of a block of one bucket, rows of about one group, and bytes of the sets of one.
BLOCK, GROUP_ROWS, GROUP_BYTES = 256, 1024, 1 << 20


def band_keys(signatures: np.ndarray) -> np.ndarray:
    """A 64-bit number for each of the BANDS buckets of each row of MinHash values."""
    parts = signatures[:, : BANDS * ROWS].reshape(len(signatures), BANDS, ROWS).astype(np.uint64)
    keys = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), parts.shape[:2])
    for i in range(ROWS):
        keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, i])
    return keys.view(np.int64)


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        body, offsets = utf8(batch.column(2))
        for start, end in steps(offsets):
            at, n = offsets[start : end + 1], end - start
            sets = sets_of(*shingles(body[at[0] : at[-1]], at - at[0]), n)
            full = np.array([i for i, s in enumerate(sets) if len(s)], np.int64)
            prints = np.zeros((n, 2), np.int64)
            keys, marks = np.zeros((0, BANDS), np.int64), np.zeros((0, HASHES), np.uint32)
            if len(full):
                prints[full] = [fingerprint(sets[i]) for i in full]
                values = minhash([sets[i] for i in full], BANDS * ROWS + HASHES)
                keys, marks = band_keys(values), np.ascontiguousarray(values[:, BANDS * ROWS :])
            count = np.zeros(n, np.int64)
            count[full] = 1
            cut = np.concatenate([[0], np.cumsum(count)])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0)[start:end],
                    batch.column(1)[start:end],
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(prints[:, 0]),
                    pa.array(prints[:, 1]),
                    pa.ListArray.from_arrays(pa.array((cut * BANDS).astype(np.int32)), pa.array(keys.reshape(-1))),
                    pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer((cut * 4 * HASHES).astype(np.int32)), pa.py_buffer(marks)]),
                ],
                names=["doc_id", "mark", "n_shingles", "print_a", "print_b", "bands", "marks"],
            )


SIGNED = "doc_id long, mark long, n_shingles long, print_a long, print_b long, bands array<long>, marks binary"


def _with_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        body, offsets = utf8(batch.column(1))
        for start, end in steps(offsets):
            at = offsets[start : end + 1]
            sets = sets_of(*shingles(body[at[0] : at[-1]], at - at[0]), end - start)
            yield pa.RecordBatch.from_arrays([batch.column(0)[start:end], pa.array([s.tobytes() for s in sets], pa.binary())], names=["node", "held"])


def likely_pairs(bucket: np.ndarray, side: np.ndarray, bands: np.ndarray, marks: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows that meet first in their bucket and survive the pruning, some at a time; rows of a bucket stand
    together. Of two blocks, pairs across them only."""
    alive = np.arange(len(bucket))
    for ahead in range(1, len(bucket)):
        alive = alive[alive < len(bucket) - ahead]
        alive = alive[bucket[alive] == bucket[alive + ahead]]
        if not len(alive):
            break
        left = alive[(side[alive] == 0) | (side[alive] != side[alive + ahead])]
        right = left + ahead
        same = bands[left] == bands[right]
        first = bands[left, same.argmax(axis=1)] == bucket[left]
        left, right = left[first], right[first]
        matches = np.zeros(len(left), np.int64)
        for low in range(0, HASHES, STEP):
            matches += (marks[left, low : low + STEP] == marks[right, low : low + STEP]).sum(axis=1)
            keep = matches >= least_matches(low + STEP, TOLERANCE)
            left, right, matches = left[keep], right[keep], matches[keep]
        if len(left):
            yield left, right


def _grouped(table: pa.Table) -> tuple[pa.Table, tuple[np.ndarray, ...]]:
    """A group's rows with those of a bucket side by side, and the columns that likely_pairs wants."""
    table = table.take(pa.array(np.argsort(table.column("bucket").to_numpy(), kind="stable")))
    bands = np.concatenate([c.flatten().to_numpy() for c in table.column("bands").chunks]).reshape(-1, BANDS)
    marks = np.frombuffer(b"".join(table.column("marks").to_pylist()), np.uint32).reshape(-1, HASHES)
    return table, (table.column("bucket").to_numpy(), table.column("side").to_numpy(), bands, marks)


LIKELY = ["node", "bucket", "side", "n_shingles", "part", "pair"]


def _likely(table: pa.Table) -> pa.Table:
    """The rows of one group that some pair is left of."""
    table, columns = _grouped(table)
    some = np.zeros(len(table), bool)
    for left, right in likely_pairs(*columns):
        some[left] = some[right] = True
    return table.filter(pa.array(some)).select(LIKELY)


def forest(left: np.ndarray, right: np.ndarray, names: np.ndarray) -> np.ndarray:
    """For each item the smallest name that it is linked with."""
    root = np.arange(len(names))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i, j in zip(left.tolist(), right.tolist(), strict=True):
        a, b = find(i), find(j)
        if a != b:
            if names[b] < names[a]:
                a, b = b, a
            root[b] = a
    return names[[find(i) for i in range(len(names))]]


def _linked(table: pa.Table) -> pa.Table:
    """Links of one group's rows: each class with its number of links and the smallest class of its tree."""
    table, columns = _grouped(table)
    names, counts = table.column("node").to_numpy(), table.column("n_docs").to_numpy()
    sets = [np.frombuffer(x, np.uint64) for x in table.column("held").to_pylist()]
    n_links, pairs = np.zeros(len(table), np.int64), []
    for left, right in likely_pairs(*columns):
        good = similar(sets, left, right)
        left, right = left[good], right[good]
        np.add.at(n_links, left, counts[right])
        np.add.at(n_links, right, counts[left])
        pairs.append((left, right))
    # a class stands in several buckets of a group: as one node here
    nodes, of = np.unique(names, return_inverse=True)
    if not pairs:
        return pa.table({"a": nodes[:0], "n": n_links[:0], "b": nodes[:0]})
    root = forest(*(of[np.concatenate(x)] for x in zip(*pairs, strict=True)), nodes)
    total = np.zeros(len(nodes), np.int64)
    np.add.at(total, of, n_links)
    some = np.flatnonzero(total)
    return pa.table({"a": nodes[some], "n": total[some], "b": root[some]})


def _told(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """The signed rows (written), and for each class its prints, copy_id, class_id and n_links with key and mark of the
    first row of its component."""
    texts = keyed(docs, id_col, text_col)
    signed = materialise(texts.select("doc_id", "mark", "text").transform(map_batches, _signed, SIGNED), "signatures")
    able = signed.filter("doc_id is not null and n_shingles > 0")
    classes = able.groupBy("print_a", "print_b").agg(
        F.min(F.struct("doc_id", "mark")).alias("place"), F.count("*").alias("n_docs"), F.first("n_shingles").alias("n_shingles"), F.first("bands").alias("bands"), F.first("marks").alias("marks")
    )
    classes = materialise(classes.withColumn("node", F.monotonically_increasing_id()), "copy-classes")
    n_classes = classes.count()

    buckets = classes.select("node", F.explode("bands").alias("bucket"))
    shared = split_join(buckets, buckets.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1"), "bucket", "node", n_classes * BANDS)
    n_blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    shared = shared.select("node", "bucket", n_blocks.alias("n_blocks"), F.pmod(F.xxhash64("node"), n_blocks).cast("int").alias("block"))
    shared = materialise(shared, "shared-buckets")
    signs = classes.select("node", "n_docs", "n_shingles", "bands", "marks")
    groups = max(1, shared.count() // GROUP_ROWS)
    rows = block_pairs(shared.join(signs, "node"), groups, "bucket").drop("n_blocks", "block")
    likely = rows.groupBy("part", "pair").applyInArrow(_likely, "node long, bucket long, side int, n_shingles long, part long, pair long")
    likely = materialise(likely, "likely-members")
    # the second pass is grouped anew, by the bytes of its sets
    groups = max(1, (likely.agg(F.sum("n_shingles")).first()[0] or 0) * 8 // GROUP_BYTES)
    likely = likely.drop("n_shingles").withColumn("part", F.when(F.col("pair") < 0, F.pmod(F.xxhash64("bucket"), F.lit(groups))).otherwise(F.col("part")))

    members = classes.join(likely.select("node").distinct(), "node", "left_semi").select("node", F.col("place.doc_id").alias("key"), F.col("place.mark").alias("mark"))
    members = materialise(members, "members")
    own = texts.select("key", "mark", "text").join(small(members, members.count()), ["key", "mark"]).select("node", "text")
    sets = own.transform(map_batches, _with_sets, "node long, held binary").groupBy("node").agg(F.first("held").alias("held"))
    rows = likely.join(sets, "node").join(signs.drop("n_shingles"), "node")
    links = materialise(rows.groupBy("part", "pair").applyInArrow(_linked, "a long, n long, b long"), "near-links")

    near = connected_components(links.select("a", "b")).withColumnRenamed("node", "a").join(classes.select(F.col("node").alias("a"), "place"), "a")
    near = near.join(near.groupBy("root").agg(F.min("place").alias("first")), "root").select(F.col("a").alias("node"), "first")
    counts = links.groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("n_near"))
    told = classes.drop("bands", "marks", "n_shingles").join(near, "node", "left").join(counts, "node", "left")
    first = F.coalesce("first", "place")
    return signed, told.select(
        "print_a",
        "print_b",
        F.col("place.doc_id").alias("copy_id"),
        first["doc_id"].alias("class_id"),
        first["mark"].alias("class_mark"),
        (F.col("n_docs") - 1 + F.coalesce("n_near", F.lit(0))).alias("n_links"),
    )


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, copy_id (smallest id with this shingle set), class_id (smallest id of the component of links) and
    n_links (other documents with similarity 0.8 or more) for every row of docs."""
    signed, told = _told(docs, id_col, text_col)
    able = signed.filter("doc_id is not null and n_shingles > 0")
    rest = signed.filter("doc_id is null or n_shingles = 0").select("doc_id", F.col("doc_id").alias("copy_id"), F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"))
    return able.join(told, ["print_a", "print_b"]).select("doc_id", "copy_id", "class_id", "n_links").unionByName(rest)


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each component of near copies, the first by id and text (of rows alike in both, any one), and all rows
    without links. Rows are told apart by id and text, so different texts of one id are judged each by itself."""
    key, mark = free_names(docs, "__key", "__mark")
    signed, told = _told(docs, id_col, text_col)
    able = signed.filter("doc_id is not null and n_shingles > 0")
    rows = materialise(able.join(told.filter("n_links > 0"), ["print_a", "print_b"]).select("doc_id", "mark", "class_id", "class_mark"), "copies")
    named = [F.col("doc_id").alias(key), F.col("mark").alias(mark)]
    same = (F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)) == F.col(key)) & (F.xxhash64(text_col) == F.col(mark))
    is_first = (F.col("doc_id") == F.col("class_id")) & (F.col("mark") == F.col("class_mark"))
    gone = materialise(rows.filter(~is_first).select(*named).distinct(), "later-copies")
    kept = docs.join(small(gone, gone.count()), same, "left_anti")
    again = materialise(rows.filter(is_first).groupBy("doc_id", "mark").count().filter("count > 1").select(*named), "repeated-rows")
    n_again = again.count()
    if not n_again:
        return kept
    again = small(again, n_again)
    return kept.join(again, same, "left_anti").unionByName(kept.join(again, same, "left_semi").dropDuplicates([id_col, text_col]))
