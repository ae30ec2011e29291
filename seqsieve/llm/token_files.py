"""Operator 4, token-id files: flat unsigned integers and 64-bit offsets, read back memory-mapped.

Texts are range-partitioned and sorted by id, so the files in order of their number hold the documents in ascending
id order. A partition becomes three files: NAME.ids (token ids one after the other, 16 bits each if the vocabulary
allows it, else 32), NAME.offsets (n + 1 signed 64-bit token offsets) and NAME.docs (64-bit document ids). They are
written under a name of the attempt and renamed at the end, so a task that is lost or runs twice leaves one good
copy. Bases of partitions are prefix sums of their token counts (one small row for each partition).

Every text is encoded by the tokenizers library, part by part, each distinct part once while a bounded table holds
it, if the tokenizer is one that lower-cases and pre-tokenises by the rule CUTS: its normaliser and pre-tokeniser never
look across a space or line feed, so a text may be cut there. Text of ASCII and Latin-1 letters alone is cut finer, at
that rule, and many such pre-tokens are encoded as one text of words. Any other tokenizer encodes whole texts.

Files go to the shared folder; on stores that have no paths (any URI but file:) pyarrow's file systems are used and
a partition's arrays are read instead of mapped.

Edge cases: null and empty texts hold the end id only; null ids come first; repeated rows are kept each, next to one
another; an empty table gives no documents; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_batches, steps, utf8
from .parts import PartTable, coded, with_ends

#: Parts of texts whose ids a worker keeps, and text bytes of a step (and of long parts that are kept).
MAX_PARTS, STEP = 500_000, 4 << 20
#: Text bytes of a file at most, about: more texts are more files.
PART_BYTES = 256 << 20
#: Words that are encoded as one text.
JOINED = 512
NO_ID = np.iinfo(np.int64).min

#: The pre-tokeniser's rule as tokenizer files state it, and its endings after an apostrophe.
CUTS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
ENDINGS = [b"s", b"t", b"re", b"ve", b"m", b"ll", b"d"]
#: Kinds of bytes in text of ASCII and Latin-1 letters: SPACE, LETTER, DIGIT, MARK; ODD bytes may stand in no such text.
SPACE, LETTER, DIGIT, MARK, ODD = range(5)
KINDS = np.array([SPACE if c in (9, 10, 11, 12, 13, 32) else ODD if 0x1C <= c <= 0x1F or c >= 0x80 else LETTER if chr(c).isalpha() else DIGIT if chr(c).isdigit() else MARK for c in range(256)], np.uint8)
#: The byte before the second byte of the letters from U+00C0 to U+00FF, and second bytes that are no letters there.
LATIN, NO_LETTERS = 0xC3, (0x97, 0xB7)


def latin(body: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The body in lower case and the kinds of its bytes, as far as it is ASCII and Latin-1 letters."""
    kinds, low = KINDS[body], body
    capital = (body >= 65) & (body <= 90)
    lead = np.flatnonzero(body == LATIN)
    lead = lead[lead + 1 < len(body)]
    second = body[lead + 1]
    good = ~np.isin(second, NO_LETTERS)
    lead, second = lead[good], second[good]
    kinds[lead] = kinds[lead + 1] = LETTER
    capital[lead[second <= 0x9E] + 1] = True
    if capital.any():
        low = np.where(capital, body + np.uint8(32), body)
    return low, kinds


def pretokens(body: np.ndarray, kinds: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Where the pre-tokens of lower-cased Latin text begin, by the rule CUTS; first: where a row begins."""
    begins = np.empty(len(kinds), bool)
    begins[:1], begins[1:] = True, (kinds[1:] != kinds[:-1]) | (kinds[1:] == DIGIT)
    begins[first] = True
    # an apostrophe alone before a letter takes an ending with it
    quote = np.flatnonzero((body == 39) & begins)
    quote = quote[quote + 1 < len(body)]
    quote = quote[begins[quote + 1] & (kinds[quote + 1] == LETTER)]
    quote = quote[~np.isin(quote + 1, first, assume_unique=True)] if len(quote) else quote
    if len(quote):
        ends = first[np.searchsorted(first, quote, side="right") % len(first)]
        ends = np.where(ends > quote, ends, len(body))
        for ending in ENDINGS:
            here = quote[quote + len(ending) < ends]
            for i, c in enumerate(ending, 1):
                here = here[body[here + i] == c]
            begins[here + 1] = False
            after = here + len(ending) + 1
            begins[after[after < len(body)]] = True
    return begins


class PartEncoder:
    """Token ids of texts, from ids of their parts if the tokenizer is known to allow it, else from whole texts."""

    def __init__(self, path: str, end_id: int):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.dtype = np.dtype("<u2") if max(self.tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16 else np.dtype("<u4")
        self.end_id = end_id
        said = json.loads(self.tokenizer.to_str())
        rules = [x.get("type") for x in (said["normalizer"] or {}).get("normalizers", [])]
        cuts = [(x.get("pattern") or {}).get("Regex") for x in (said["pre_tokenizer"] or {}).get("pretokenizers", [])]
        suffix = said["model"].get("end_of_word_suffix")
        self.known = rules == ["NFC", "Replace", "Lowercase"] and CUTS in cuts and bool(suffix)
        self.special = [x["content"] for x in said["added_tokens"]]
        self.last = np.zeros(self.tokenizer.get_vocab_size(), bool)
        if self.known:
            self.last[[i for t, i in self.tokenizer.get_vocab(with_added_tokens=False).items() if t.endswith(suffix)]] = True
        self.table = PartTable(np.uint32, [self.end_id])

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(g.ids, np.uint32) for g in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, words: list[bytes], others: list[bytes]) -> None:
        """Encodes new parts; words are pre-tokens, so each ends with its first id that ends a word."""
        if words:
            ids = np.concatenate(self._ids([b" ".join(words[i : i + JOINED]).decode() for i in range(0, len(words), JOINED)]))
            self.table.add(words, ids, np.diff(np.flatnonzero(self.last[ids]), prepend=-1))
        if others:
            got = self._ids([p.decode() for p in others])
            self.table.add(others, np.concatenate(got), np.array([len(g) for g in got], np.int64))

    def _places(self, body: np.ndarray, begins: np.ndarray, words: bool) -> np.ndarray:
        """The table's entries of the parts that begin there. A part is told apart with the white space after it."""
        numbers, found = coded(body, np.flatnonzero(begins), len(body))
        names = [p.rstrip(b" \t\n\x0b\x0c\r") if words else p.rstrip(b" \n") for p in found]
        self.table = self.table.for_step(names, MAX_PARTS, STEP)
        index = self.table.index
        new = list({p for p in names if p not in index})
        self._learn(*((new, []) if words else ([], new)))
        return np.fromiter(map(index.__getitem__, names), np.int64, len(names))[numbers]

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a column of texts one after the other, and the number of ids of each text with its end."""
        column = pc.fill_null(column, "")
        n = len(column)
        if not self.known:
            got = [np.append(x, np.uint32(self.end_id)) for x in self._ids(column.to_pylist())]
            return np.concatenate([*got, np.zeros(0, np.uint32)]).astype(self.dtype), np.array([len(g) for g in got], np.int64)
        body, offsets = utf8(column)
        low, kinds = latin(body)
        odd = np.concatenate([[0], np.cumsum(kinds == ODD)])
        plain = odd[offsets[1:]] == odd[offsets[:-1]]
        for text in self.special:
            plain &= ~pc.match_substring(column, text).to_numpy(zero_copy_only=False)
        sizes = np.diff(offsets)
        counts = np.zeros(n, np.int64)
        done = []
        for words in (True, False):
            rows = np.flatnonzero(plain == words)
            if not len(rows):
                continue
            if len(rows) == n:
                part, kind, at = (low if words else body), kinds, offsets
            else:
                held = np.repeat(plain == words, sizes)
                part, kind, at = (low if words else body)[held], kinds[held], np.concatenate([[0], np.cumsum(sizes[rows])])
            first = at[:-1][np.diff(at) > 0]
            if words:
                begins = pretokens(part, kind, first)
                begins &= (kind != SPACE)
            else:
                gap = (part == 32) | (part == 10)
                begins = ~gap
                begins[1:] &= gap[:-1]
            begins[first] = True
            cut = np.concatenate([[0], np.cumsum(begins)])[at]
            places = with_ends(self._places(part, begins, words), np.diff(cut), 0)
            ends = np.concatenate([[0], np.cumsum(self.table.sizes.values[places])])
            last = np.cumsum(np.diff(cut) + 1)
            counts[rows] = np.diff(ends[last], prepend=0)
            done.append((rows, self.table.gather(places).astype(self.dtype)))
        if len(done) == 1:
            return done[0][1], counts
        ids, of = np.empty(counts.sum(), self.dtype), np.repeat(plain, counts)
        for rows, got in done:
            ids[of == plain[rows[0]]] = got
        return ids, counts


@lru_cache(maxsize=2)
def _encoder(path: str, end_id: int) -> PartEncoder:
    return PartEncoder(path, end_id)


class Store:
    """Files below a URI; a folder that has a path is used by it."""

    def __init__(self, uri: str):
        parsed = urlparse(uri)
        self.local = parsed.scheme in ("", "file")
        if self.local:
            self.root = parsed.path
        else:
            from pyarrow import fs

            self.fs, self.root = fs.FileSystem.from_uri(uri)

    def create(self, name: str):
        if self.local:
            os.makedirs(self.root, exist_ok=True)
            return open(f"{self.root}/{name}", "wb")
        self.fs.create_dir(self.root)
        return self.fs.open_output_stream(f"{self.root}/{name}")

    def rename(self, old: str, new: str) -> None:
        if self.local:
            os.replace(f"{self.root}/{old}", f"{self.root}/{new}")
        else:
            self.fs.move(f"{self.root}/{old}", f"{self.root}/{new}")

    def array(self, name: str, dtype) -> np.ndarray:
        if self.local:
            path = f"{self.root}/{name}"
            return np.memmap(path, dtype=dtype, mode="r") if os.path.getsize(path) else np.zeros(0, dtype)
        with self.fs.open_input_file(f"{self.root}/{name}") as f:
            return np.frombuffer(f.read(), dtype)


def _name(part: int) -> str:
    return f"part-{part:06d}"


@dataclass(frozen=True)
class TokenFiles:
    """Written files: for each partition its number, base (ids before it), documents and ids."""

    uri: str
    dtype: str
    parts: tuple[tuple[int, int, int, int], ...]

    def _rows(self, spark: SparkSession) -> DataFrame:
        rows = spark.createDataFrame(list(self.parts), "part int, base long, n_docs long, n_tokens long")
        return rows.repartition(max(1, len(self.parts)))

    def read(self, spark: SparkSession, with_ids: bool = False) -> DataFrame:
        """doc_id, start, n_tokens and ids_crc32 of each document, from the files; with_ids: and the ids."""
        uri, dtype = self.uri, np.dtype(self.dtype)
        schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            store = Store(uri)
            for batch in batches:
                for part, base, n_docs, _ in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    ids = store.array(f"{_name(part)}.ids", dtype)
                    offsets = store.array(f"{_name(part)}.offsets", "<i8")
                    docs = store.array(f"{_name(part)}.docs", "<i8")
                    for low in range(0, n_docs, 4096):
                        at = np.array(offsets[low : low + 4097])
                        names = np.array(docs[low : low + 4096])
                        crc = [zlib.crc32(ids[a:b].astype("<u4").tobytes()) for a, b in zip(at[:-1], at[1:], strict=True)]
                        columns = [pa.array(names, mask=names == NO_ID), pa.array(base + at[:-1]), pa.array(np.diff(at)), pa.array(crc, pa.int64())]
                        if with_ids:
                            columns.append(pa.ListArray.from_arrays(pa.array((at - at[0]).astype(np.int32)), pa.array(ids[at[0] : at[-1]].astype(np.int64))))
                        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "n_tokens", "ids_crc32", "ids"][: len(columns)])

        return self._rows(spark).transform(map_batches, run, schema)


def write(docs: DataFrame, tokenizer_path: str, uri: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> TokenFiles:
    """Encodes every text and writes the files below uri; runs at once."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // PART_BYTES))
    # the text's hash parts rows of one id, so that no id, however often repeated, is one task's work
    rows = rows.repartitionByRange(n, F.col("doc_id"), F.xxhash64("text")).sortWithinPartitions(F.col("doc_id"), F.xxhash64("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        context, encoder, store = TaskContext.get(), _encoder(tokenizer_path, end_id), Store(uri)
        part = context.partitionId()
        name, attempt = _name(part), f"attempt-{context.taskAttemptId()}"
        n_docs = n_tokens = 0
        files = {kind: store.create(f"{attempt}.{kind}") for kind in ("ids", "offsets", "docs")}
        files["offsets"].write(np.zeros(1, "<i8").tobytes())
        for batch in batches:
            _, offsets = utf8(batch.column(1))
            for start, end in steps(offsets, STEP):
                ids, counts = encoder.encode(batch.column(1)[start:end])
                files["ids"].write(ids.tobytes())
                files["offsets"].write((n_tokens + np.cumsum(counts)).astype("<i8").tobytes())
                files["docs"].write(pc.fill_null(batch.column(0)[start:end], NO_ID).to_numpy(zero_copy_only=False).astype("<i8").tobytes())
                n_docs, n_tokens = n_docs + len(counts), n_tokens + len(ids)
        for kind, file in files.items():
            file.close()
            store.rename(f"{attempt}.{kind}", f"{name}.{kind}")
        yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "n_docs": [n_docs], "n_tokens": [n_tokens], "dtype": [encoder.dtype.str]})

    made = rows.transform(map_batches, run, "part int, n_docs long, n_tokens long, dtype string").collect()  # a row for each partition
    parts, base = [], 0
    for row in sorted(made, key=lambda r: r["part"]):
        if row["n_docs"]:
            parts.append((row["part"], base, row["n_docs"], row["n_tokens"]))
            base += row["n_tokens"]
    return TokenFiles(uri, made[0]["dtype"] if made else "<u4", tuple(parts))
