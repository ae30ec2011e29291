"""Reference sequences in pieces, from FASTA files and from stored genomes.

A FASTA file is read in ranges of bytes. What a range's letters belong to is settled first: each range tells how many letters come
before its first header, its last header and how many letters follow that, and sums over the ranges before it give the
sequence and the place that it begins with. Pieces are cut as the lines stream by, so no row and no task holds a whole
chromosome. Genomes are told by the names of their files: asking for names opens no file.

A stored genome is a folder of pieces as a table, which is found by listing. Storing one does not touch the others, and a
screen reads the tables instead of parsing text."""

from __future__ import annotations

import codecs
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .blocks import Stream, kind_of
from .fastq import FormatError, expand
from .store import Store

#: Bytes of a range, letters of a piece, and letters of the next one that it goes on with.
SPLIT, PIECE, OVERLAP = 64 << 20, 1 << 20, 1024
#: Bytes that are read at once, and of the longest header that may stand across two ranges.
BLOCK, HEADER = 1 << 20, 1 << 16
#: Bytes that go on a letter, and those that are no letter.
CONTINUED, SPACES = bytes(range(0x80, 0xC0)), b" \t\r\n"
#: Fixed value: how a file is named after its genome.
FILE = re.compile(r"([^/]*?)\.(?:fa|fasta|fna)(?:\.gz)?$")
SCHEMA = "file string, genome string, chromosome string, start long, own long, text string"


def genome_name(path: str) -> str:
    found = FILE.search(path)
    return found[1] if found else ""


@dataclass(frozen=True)
class _Range:
    path: str
    kind: str
    begin: int
    end: int  # -1: the rest
    name: str | None = None  # the sequence that its first letters belong to, and their place in it
    place: int = 0


def _blocks(r: _Range, beyond: int) -> Iterator[tuple[bool, bytes]]:
    """Bytes of a range, and after them (False first) about `beyond` more. A letter of several bytes belongs to the range
    in which it begins."""
    if r.kind != "plain":
        stream = Stream(r.path, r.kind)
        while block := stream.read():
            yield True, block
        return
    with Store(r.path).open(r.path) as f:
        f.seek(r.begin)
        left = r.end - r.begin if r.end >= 0 else None
        first = r.begin > 0
        while left is None or left > 0:
            block = f.read(BLOCK if left is None else min(BLOCK, left))
            if not block:
                return
            left = None if left is None else left - len(block)
            if left == 0:
                more = f.read(3)
                own = len(more) - len(more.lstrip(CONTINUED))
                block += more[:own]
                f.seek(r.end + own)
            yield True, block.lstrip(CONTINUED) if first else block
            first = False
        while beyond > 0 and (block := f.read(min(BLOCK, beyond))):
            yield False, block
            beyond -= len(block)


def _before(r: _Range) -> tuple[bool, bool]:
    """Whether a range begins with a line, and whether it begins within a header."""
    if r.begin == 0:
        return True, False
    with Store(r.path).open(r.path) as f:
        look = min(r.begin, HEADER)
        f.seek(r.begin - look)
        back = f.read(look)
    line = back[back.rfind(b"\n") + 1 :]
    return not line, line[:1] == b">" and (len(line) < look or look == r.begin)


def _parts(r: _Range, beyond: int = 0) -> Iterator[tuple[bool, str | None, str]]:
    """(the range's own, header without >, letters after it) in order; None goes on with the same sequence. White space is
    no letter."""
    line_begins, in_header = _before(r)
    head: list[bytes] | None = [] if in_header else None  # of a header that is not whole yet
    skip, own_head = in_header, True
    decode = codecs.getincrementaldecoder("utf-8")().decode
    for mine, block in _blocks(r, beyond):
        at = 0
        while at < len(block):
            if head is not None:
                end = block.find(b"\n", at)
                head.append(block[at : end if end >= 0 else len(block)])
                at = end + 1 if end >= 0 else len(block)
                if end >= 0:
                    if not skip:
                        yield own_head, b"".join(head).decode(errors="replace").rstrip("\r"), ""
                    head, skip, line_begins = None, False, True
                continue
            if line_begins and block[at : at + 1] == b">":
                head, own_head, at = [], mine, at + 1
                continue
            stop = block.find(b"\n>", at)
            stop = stop + 1 if stop >= 0 else len(block)
            line_begins = block[stop - 1 : stop] == b"\n"
            try:
                found = decode(block[at:stop].translate(None, SPACES))
            except UnicodeDecodeError:
                raise FormatError(f"{r.path}: text that is not UTF-8") from None
            if found:
                yield mine, None, found
            at = stop
    if head is not None and not skip:
        yield own_head, b"".join(head).decode(errors="replace").rstrip("\r"), ""


def _ends(r: _Range) -> tuple[int, str | None, int]:
    """Letters before the range's first header, its last header, and the letters after that."""
    before, last, after = 0, None, 0
    for mine, head, found in _parts(r, HEADER if r.end >= 0 else 0):
        if not mine:
            break
        if head is not None:
            last, after = head, 0
        if last is None:
            before += len(found)
        else:
            after += len(found)
    return before, last, after


def _pieces(r: _Range, size: int, overlap: int) -> Iterator[tuple[str, int, int, str]]:
    """(header, start, own, text) of a range's pieces: own letters are the range's, and the text goes on for `overlap` more."""
    name, place, held, n = r.name, r.place, "", 0  # held: letters from place on, of which n are this range's

    def cut(ended: bool) -> Iterator[tuple[str, int, int, str]]:
        nonlocal place, held, n
        while n and (ended or len(held) >= min(n, size) + overlap):
            own = min(n, size)
            yield name, place, own, held[: own + overlap]
            place, held, n = place + own, held[own:], n - own

    for mine, head, found in _parts(r, HEADER + 8 * overlap):
        if head is not None:
            yield from cut(True)
            if not mine:
                return
            name, place, held, n = head, 0, "", 0
        if found and name is None:
            raise FormatError(f"{r.path}: a record must begin with >")
        if not mine and not n:
            return
        held += found
        n += len(found) if mine else 0
        if len(held) >= size + overlap or not mine:
            yield from cut(False)
    yield from cut(True)


def _one_each(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A partition for each row, of what stands for a range of a file. repartition() would deal several to some tasks and
    none to others."""
    return spark.createDataFrame(spark.sparkContext.parallelize(rows, max(1, len(rows))), schema)


def _ranges(spark: SparkSession, paths: list[str], split: int) -> list[_Range]:
    """Ranges of files with what their first letters belong to. The driver holds a row for each."""
    found: list[_Range] = []
    for path in paths:
        size = Store(path).stamp(path)[0]
        if path.endswith(".gz"):
            found.append(_Range(path, kind_of(path), 0, -1))
        else:
            edges = range(0, max(size, 1), split)
            found += [_Range(path, "plain", a, a + split if a + split < size else -1) for a in edges]
    if len(found) == len(paths):
        return found  # a range each: all begin with a header

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(i, *_ends(_Range(path, kind, a, b))) for i, path, kind, a, b in zip(*(c.to_pylist() for c in batch.columns), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int32(), pa.int64(), pa.string(), pa.int64()), strict=True)], ["i", "before", "last", "after"])

    table = _one_each(spark, [(i, r.path, r.kind, r.begin, r.end) for i, r in enumerate(found)], "i int, path string, kind string, begin long, end long")
    told = {r["i"]: r for r in table.mapInArrow(run, "i int, before long, last string, after long").collect()}
    out, name, place = [], None, 0
    for i, r in enumerate(found):
        if r.begin == 0:
            name, place = None, 0
        out.append(_Range(r.path, r.kind, r.begin, r.end, name, place))
        t = told[i]
        name, place = (name, place + t["before"]) if t["last"] is None else (t["last"], t["after"])
    return out


def read_pieces(spark: SparkSession, patterns: list[str], size: int = PIECE, overlap: int = OVERLAP, split: int = SPLIT) -> DataFrame:
    """The sequences of FASTA files in pieces: file, genome (the file's name), chromosome (up to the first space of a header), start,
    own and text (see operators.align.as_pieces)."""
    ranges = _ranges(spark, expand(patterns), split)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, kind, begin, end, name, place in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                genome = genome_name(path)
                for head, start, own, text in _pieces(_Range(path, kind, begin, end, name, place), size, overlap):
                    yield pa.RecordBatch.from_pydict({"file": [path], "genome": [genome], "chromosome": [head.partition(" ")[0]], "start": pa.array([start], pa.int64()), "own": pa.array([own], pa.int64()), "text": [text]})

    rows = [(r.path, r.kind, r.begin, r.end, r.name, r.place) for r in ranges]
    table = _one_each(spark, rows, "path string, kind string, begin long, end long, name string, place long")
    return table.mapInArrow(run, SCHEMA)


def genome_names(patterns: list[str]) -> list[str]:
    """Names of genomes by those of their files."""
    return list(dict.fromkeys(map(genome_name, expand(patterns))))


def store_genome(spark: SparkSession, name: str, patterns: list[str], folder: str, split: int = SPLIT) -> None:
    """Writes a genome's pieces to folder/name, in place of what was there."""
    pieces = read_pieces(spark, patterns, split=split)
    pieces.select("chromosome", "start", "own", "text").write.mode("overwrite").parquet(f"{folder.rstrip('/')}/{name}/pieces")


def stored_names(folder: str) -> list[str]:
    """Genomes whose pieces are stored whole."""
    done = Store(folder).find(f"{folder.rstrip('/')}/*/pieces/_SUCCESS")
    return sorted(f.split("/")[-3] for f in done)


def stored_pieces(spark: SparkSession, folder: str, names: list[str] | None = None) -> DataFrame:
    """Pieces of stored genomes: genome, chromosome, start, own, text."""
    names = stored_names(folder) if names is None else names
    if not names:
        raise FileNotFoundError(f"no genome is stored in {folder}")
    paths = [f"{folder.rstrip('/')}/{n}/pieces" for n in names]
    table = spark.read.schema("chromosome string, start long, own long, text string").parquet(*paths)
    genome = F.regexp_extract(F.input_file_name(), "([^/]*)/pieces/[^/]*$", 1)
    return table.select(F.url_decode(genome).alias("genome"), "chromosome", "start", "own", "text")
