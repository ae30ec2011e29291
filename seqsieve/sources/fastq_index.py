"""Where the records of FASTQ files begin: a table with a row for each range of about `split` bytes of a file, with the
place of its first record, the record's number in the file and how many records begin in the range. With it a file is
read by many tasks, each knows the numbers of its records, and a cap on records says which ranges are not read at all.

Ranges are scanned side by side. A task that begins within a file takes the first place that looks like a record; if the
range before it ends at that very place, both are right, as the first range begins at the file's beginning. Where the two
differ, the range is scanned again from the right place. So the table is right for every valid file, whatever
its lines look like, and usually takes one pass.

A table is written to a folder and holds the size and the time of change of each file. Files that changed, or that it does not
have, are scanned anew and put to it."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession

from .blocks import Fault, Records, Stream, first_block, kind_of
from .store import Store

#: Bytes of a range.
SPLIT = 128 << 20
#: A range's end beyond all bytes of its file, and a place that could not be told.
REST, UNKNOWN = 1 << 62, -1

FIELDS = "path string, size long, stamp long, kind string, range int, start long, first long, n long, problem string"
SCHEMA = pa.schema([("path", pa.string()), ("size", pa.int64()), ("stamp", pa.int64()), ("kind", pa.string()), ("range", pa.int32()), ("start", pa.int64()), ("first", pa.int64()), ("n", pa.int64()), ("problem", pa.string())])


@dataclass(frozen=True)
class Entry:
    """A range with records: where the first of them begins and its number in the file."""

    path: str
    size: int
    stamp: int
    kind: str
    range: int
    start: int
    first: int
    n: int
    problem: str | None


def scan_range(path: str, kind: str, begin: int, end: int, exact: int | None = None) -> tuple[int, int, int, str | None]:
    """start, stop, n and problem of the records that begin from byte `begin` to byte `end` (excluded; of BGZF, in blocks
    that begin there). start: the first of them, UNKNOWN if it cannot be told; stop: the record after them. Both are REST if
    the file has none. exact: a place that is known to be a record's beginning or a blank line before it."""
    start = exact if exact is not None else begin
    if exact is None and kind == "bgzf":
        block = 0 if begin == 0 else first_block(path, begin)
        if block is None:
            return REST, REST, 0, None
        start = block << 16
    elif exact is None and kind == "plain" and begin:
        start = begin - 1  # if the byte before is a line's end, a record may begin here
    stream = Stream(path, kind, start, None if end == REST else end)
    try:
        records = Records(stream, columns=False)
        if exact is None and begin and not records.to_beginning(kind == "bgzf"):
            return UNKNOWN, UNKNOWN, 0, None
        records.to_record()
        first = stream.place(records.base) if records.data else REST
        n = sum(step.n for step in records.steps())
        return first, stream.place(records.base) if records.data else REST, n, records.problem
    finally:
        stream.close()


def _scan(spark: SparkSession, todo: list[tuple]) -> dict[int, tuple]:
    """scan_range() for rows (number, path, kind, begin, end, exact), a task for each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for number, path, kind, begin, end, exact in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                try:
                    rows.append((number, *scan_range(path, kind, begin, end, exact)))
                except Fault as fault:  # of the compressed file
                    raise Fault(f"{path}: {fault}") from None
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.string()), strict=True)], ["number", "start", "stop", "n", "problem"])

    ranges = spark.createDataFrame(todo, "number int, path string, kind string, begin long, end long, exact long").repartition(len(todo))
    return {r["number"]: (r["start"], r["stop"], r["n"], r["problem"]) for r in ranges.mapInArrow(run, "number int, start long, stop long, n long, problem string").collect()}


def scan(spark: SparkSession, paths: list[str], split: int = SPLIT) -> list[Entry]:
    """The entries of files. The driver holds a row for each range, as Spark does for the files it reads."""
    files = [(path, *Store(path).stamp(path)) for path in paths]
    ranges: list[tuple] = []  # of all files in order
    for number, (path, size, _) in enumerate(files):
        kind = kind_of(path) if size > split else "gzip" if path.endswith(".gz") else "plain"
        edges = [0] if kind == "gzip" else [*range(0, max(size, 1), split)]
        ranges += [(number, kind, a, b) for a, b in zip(edges, [*edges[1:], REST], strict=True)]
    found = _scan(spark, [(i, files[f][0], kind, a, b, None) for i, (f, kind, a, b) in enumerate(ranges)]) if ranges else {}
    while True:
        again, entries, file, place, first, halted = [], [], -1, 0, 0, False
        for i, (f, kind, _, end) in enumerate(ranges):
            if f != file:
                file, place, first, halted = f, None, 0, False
            start, stop, n, problem = found[i]
            shift = 16 if kind == "bgzf" else 0
            if halted or place == REST or (place is not None and end != REST and place >> shift >= end):
                continue  # no record begins here, or it is not known yet
            if place is not None and start != place:
                again.append((i, files[f][0], kind, ranges[i][2], end, place))
                halted = True
                continue
            path, size, stamp = files[f]
            if n:
                entries.append(Entry(path, size, stamp, kind, i, start, first, n, problem))
            place, first = stop, first + n
        if not again:
            return entries
        found |= _scan(spark, again)


def write(entries: list[Entry], paths: list[str], folder: str) -> None:
    """Puts a file of entries to an index, which replaces older ones of the same files. Files without records have a row
    with n = 0."""
    have = {e.path for e in entries}
    rows = [*entries, *(Entry(p, *Store(p).stamp(p), "plain", 0, 0, 0, 0, None) for p in paths if p not in have)]
    table = pa.table({f.name: pa.array([getattr(e, f.name) for e in rows], f.type) for f in SCHEMA}, schema=SCHEMA)
    import uuid

    name = f"{folder.rstrip('/')}/index-{uuid.uuid4().hex}.parquet"
    temporary = f"{name}.part"
    with Store(folder).create(temporary) as out:
        pq.write_table(table, out)
    Store(folder).rename(temporary, name)


def read(folder: str, paths: list[str]) -> tuple[list[Entry], list[str]]:
    """The entries of those files that the index knows as they are now, and the other files."""
    store = Store(folder)
    wanted = {p: store_stamp(p) for p in paths}
    found: dict[str, list[Entry]] = {}
    for name in store.find(f"{folder.rstrip('/')}/index-*.parquet"):
        with store.open(name) as f:
            rows = pq.read_table(f).to_pylist()
        fresh: dict[str, list[Entry]] = {}
        for r in rows:
            if wanted.get(r["path"]) == (r["size"], r["stamp"]):
                fresh.setdefault(r["path"], []).append(Entry(**r))
        found |= fresh
    entries = [e for p in paths if p in found for e in sorted(found[p], key=lambda e: e.first) if e.n]
    return entries, [p for p in paths if p not in found]


def store_stamp(path: str) -> tuple[int, int]:
    return Store(path).stamp(path)


def ensure(spark: SparkSession, paths: list[str], folder: str, split: int = SPLIT) -> list[Entry]:
    """The entries of all files, of which those that the index in the folder lacks are scanned and put to it."""
    entries, missing = read(folder, paths)
    missing = list(dict.fromkeys(missing))
    if missing:
        new = scan(spark, missing, split)
        write(new, missing, folder)
        entries += new
    return entries


def table(spark: SparkSession, entries: list[Entry]) -> DataFrame:
    """The entries as a table."""
    return spark.createDataFrame([tuple(getattr(e, f.name) for f in SCHEMA) for e in entries], FIELDS)
