"""Native aligners: ungapped alignment to references by seeds, and the best adapter of each read.

Sequences are compared as they are written, in upper or lower case alike only if the caller makes them so.

References and texts are many and stream past the reads or passages once (see probe), which are few: these are written to
the shared folder in groups of PROBE_BYTES at most, and each task loads a group. There is a scan of the references for each
group, and all that is shuffled are hits."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.store import Store, shared_folder
from . import probe

#: Bytes of reads or passages that a task holds at once, in the table that it loads.
PROBE_BYTES = 32 << 20
#: Which base pairs with which, and the scores of a match, of a mismatch, and of an alignment that counts.
BASES, PARTNERS = "ACGTacgt", "TGCAtgca"
MATCH, MISMATCH, LEAST_SCORE = 5, -4, 100


def _complement(seq: str) -> str:
    return seq.translate(str.maketrans(BASES, PARTNERS))[::-1]


def _groups(df: DataFrame, key: list[str], name: str) -> list[str]:
    """Folders of written groups of the rows, each of about PROBE_BYTES at most."""
    spark, path = df.sparkSession, shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    size = table.agg(F.sum(sum((F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in df.columns), F.lit(0)))).first()[0] or 0
    groups = -(-size // PROBE_BYTES)
    if groups < 2:
        return [path]
    table.withColumn("group", F.pmod(F.xxhash64(*key), F.lit(groups))).repartition(groups, "group").write.partitionBy("group").parquet(f"{path}-groups")
    return [f"{path}-groups/group={g}" for g in range(groups)]


def _load(folder: str, columns: list[str]) -> pa.Table:
    store, parts = Store(folder), []
    for name in store.find(f"{folder}/*.parquet"):
        with store.open(name) as f:
            parts.append(pq.read_table(f, columns=columns))
    return pa.concat_tables(parts) if parts else pa.table({c: pa.array([], pa.string()) for c in columns})


def as_pieces(references: DataFrame) -> DataFrame:
    """References as pieces: genome, chromosome, start, own (the places that are the piece's own) and text, which goes on into the next
    piece. A table of whole sequences (genome, chromosome, seq) has a piece for each."""
    if "text" in references.columns:
        return references.select("genome", "chromosome", "start", "own", "text")
    return references.select("genome", "chromosome", F.lit(0).cast("long").alias("start"), F.length("seq").cast("long").alias("own"), F.col("seq").alias("text")).filter("text is not null")


def align_ungapped(reads: DataFrame, references: DataFrame, max_mismatches: int = 2, length: int = 36, describe: bool = False) -> DataFrame:
    """The best alignment of each read to each genome with at most max_mismatches mismatches.

    reads: id (sample), read, seq of exactly `length` bases (others are left out, as the trimmed reads of a run have
    one length). references: see as_pieces(); a piece's text must go on for `length` letters. Result: id, read, genome,
    chromosome, position (from 0), strand, sequence (as aligned), mismatches, and with describe the column described:
    mismatches as place:reference>read in the order of the read, comma-separated.

    By the pigeonhole principle one of max_mismatches + 1 segments of a read matches exactly, so nothing that fits is
    lost. Of a read's places in a piece only the best leaves the task, however often a segment occurs there."""
    whole = reads.filter(F.length("seq") == length).select("id", "read", "seq")
    kinds = dict(whole.dtypes) | dict(references.select("genome", "chromosome").dtypes)
    schema = f"id {kinds['id']}, read {kinds['read']}, genome {kinds['genome']}, chromosome {kinds['chromosome']}, position long, strand string, sequence string, mismatches int, described string"

    def run(folder: str):
        def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            table = _load(folder, ["id", "read", "seq"])
            forms = [f for seq in table.column("seq").to_pylist() for f in (seq, _complement(seq))]
            known = probe.ShortReads(forms, length, max_mismatches) if forms else None
            for batch in batches:
                for i, (start, own, text) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("start", "own", "text")), strict=True)):
                    if known is None or len(text) < length:
                        continue
                    form, position, wrong = known.best(text, own)
                    if not len(form):
                        continue
                    here, one = pa.array(form // 2), pa.array(np.full(len(form), i))
                    told = known.described(text, form, position) if describe else [None] * len(form)
                    yield pa.RecordBatch.from_arrays(
                        [
                            table.column("id").take(here).combine_chunks(), table.column("read").take(here).combine_chunks(), batch.column("genome").take(one), batch.column("chromosome").take(one), pa.array(position + start),
                            pa.array(np.where(form % 2, "-", "+").tolist(), pa.string()), pa.array([forms[f] for f in form], pa.string()), pa.array(wrong, pa.int32()), pa.array(told, pa.string()),
                        ],
                        names=["id", "read", "genome", "chromosome", "position", "strand", "sequence", "mismatches", "described"],
                    )

        return of

    pieces = as_pieces(references)
    found = reduce(DataFrame.unionByName, (pieces.mapInArrow(run(folder), schema) for folder in _groups(whole, ["id", "read"], "reads")))
    first = F.row_number().over(Window.partitionBy("id", "read", "genome").orderBy("mismatches", "chromosome", "position", "strand"))
    best = found.withColumn("n", first).filter("n = 1").drop("n")
    return best if describe else best.drop("described")


def best_segment(read: str, adapter: str) -> tuple[int, int, int, int]:
    """The ungapped segment with the highest score: score, start in the read, start in the adapter, length. Of equals
    the first in the read, then in the adapter, counts."""
    if not read or not adapter:
        return 0, 0, 0, 0
    _, _, start, there, n, score = probe.Adapters([adapter], 1, 1, MATCH, MISMATCH).best([read])
    return (int(score[0]), int(start[0]), int(there[0]), int(n[0])) if len(score) else (0, 0, 0, 0)


def _adapter_hits(adapters: list[tuple[str, str]], least: int, k: int):
    forms = [(name, strand, s) for name, seq in adapters for strand, s in (("+", seq), ("-", _complement(seq)))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = probe.Adapters([s for _, _, s in forms], least, k, MATCH, MISMATCH)
        names = pa.array([name for name, _, _ in forms], pa.string())
        back = np.array([strand == "-" for _, strand, _ in forms], bool)
        sizes = known.lengths
        for batch in batches:
            texts = [s or "" for s in batch.column("seq").to_pylist()]
            read, form, start, there, n, score = known.best(texts)
            if not len(read):
                continue
            reverse, whole = back[form], sizes[form]
            same = (score - MISMATCH * n) // (MATCH - MISMATCH)
            first, last = np.where(reverse, whole - there, there), np.where(reverse, whole - there - n, there + n)
            rows = pa.array(read)
            columns = [start, start + n, ["+"] * len(read), names.take(pa.array(form)), first, last, np.where(reverse, "-", "+").tolist(), 100.0 * same / n, score]
            kinds = [pa.int32(), pa.int32(), pa.string(), pa.string(), pa.int32(), pa.int32(), pa.string(), pa.float64(), pa.int32()]
            made = [c if isinstance(c, pa.Array) else pa.array(c, t) for c, t in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("id").take(rows), batch.column("read").take(rows), *made], names=ADAPTER_COLUMNS)

    return run


ADAPTER_COLUMNS = ["id", "read", "start", "end", "strand", "adapter", "adapter start", "adapter end", "adapter strand", "percent identity", "score"]
#: Most adapters that are taken to every task.
MAX_ADAPTERS = 10_000


def match_adapters(reads: DataFrame, adapters: DataFrame, least_score: int = LEAST_SCORE) -> DataFrame:
    """The best ungapped match of each untrimmed read (id, read, seq) among the adapters (name, seq) on both strands, if
    it scores least_score. A match of that score holds an exact run of some length (see exact_run), which is looked up
    first. Adapters are a short list that goes to every task; more than MAX_ADAPTERS are an error."""
    listed = sorted({(r["name"], r["seq"]) for r in adapters.select("name", "seq").dropna().limit(MAX_ADAPTERS + 1).collect()})
    if len(listed) > MAX_ADAPTERS:
        raise ValueError(f"more than {MAX_ADAPTERS} adapters")
    kind = dict(reads.dtypes)
    schema = f"id {kind['id']}, read {kind['read']}, start int, end int, strand string, adapter string, `adapter start` int, `adapter end` int, `adapter strand` string, `percent identity` double, score int"
    k = exact_run(least_score, max((len(s) for _, s in listed), default=0))
    return reads.select("id", "read", "seq").mapInArrow(_adapter_hits(listed, least_score, k), schema)


def exact_run(least: int, longest: int) -> int:
    """The shortest exact run that an alignment of this score over at most `longest` bases must hold: m mismatches part
    the matches into m + 1 runs, and with n matches 5 n - 4 m is the score."""
    best = longest or 1
    for n in range(1, longest + 1):
        m = min((MATCH * n - least) // -MISMATCH, longest - n)
        if MATCH * n >= least and m >= 0:
            best = min(best, -(-n // (m + 1)))
    return max(1, best)


def exact_hits(texts: DataFrame, passages: DataFrame) -> DataFrame:
    """(doc, item, position) of the first place where a passage stands in a text, letter by letter: a literal screen.

    Texts are read once and not shuffled. Empty and null passages stand nowhere; of a doc or an item with several texts the
    first place of any counts."""
    wanted = passages.select("item", "passage").filter(F.length("passage") > 0)
    schema = f"doc {dict(texts.dtypes)['doc']}, item {dict(passages.dtypes)['item']}, position long"

    def run(folder: str):
        def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            table = _load(folder, ["item", "passage"])
            known = probe.Passages(table.column("passage").to_pylist())
            items = table.column("item").combine_chunks() if table.num_rows else None
            for batch in batches:
                for i, text in enumerate(batch.column("seq").to_pylist()):
                    passage, position = known.first(text or "")
                    if len(passage):
                        yield pa.RecordBatch.from_arrays([batch.column("doc").take(pa.array(np.full(len(passage), i))), items.take(pa.array(passage)), pa.array(position)], names=["doc", "item", "position"])

        return of

    found = reduce(DataFrame.unionByName, (texts.select("doc", "seq").mapInArrow(run(folder), schema) for folder in _groups(wanted, ["item", "passage"], "passages")))
    return found.groupBy("doc", "item").agg(F.min("position").alias("position"))
