"""FASTQ and FASTA: parsers, Spark data sources that read them, and text for their sinks.

Rules of the reader: a record may have several sequence and quality lines; blank lines may stand before a record; the
id ends at the first space and the rest is the description; what follows + is ignored; the quality is read by length,
so it may begin with @; lines end with LF or CR LF, and the last one may have no end. Files of several gzip members are
one stream. With an index (see fastq_index) plain and BGZF files are read in ranges, each by its own task; without one a
file is one partition, and other gzip files always are."""

from __future__ import annotations

import gzip
import io
import os
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from typing import IO

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage

from . import fastq_index
from .blocks import Fault, Records, Stream, kind_of
from .store import Store, shared_folder

#: Rows and characters of a reader's batch.
BATCH_ROWS, BATCH_CHARS = 10_000, 4 << 20


class FormatError(ValueError):
    """A file that breaks the rules of its format."""


@dataclass(frozen=True)
class Record:
    id: str
    desc: str | None
    seq: str
    qual: str


def _header(line: str) -> tuple[str, str | None]:
    name, space, rest = line[1:].partition(" ")
    return name, rest if space else None


def parse_fastq(lines: Iterable[str], name: str = "input") -> Iterator[Record]:
    """Records of text lines; errors tell the line, counted from 1 with blank ones."""
    numbered = enumerate((line.rstrip("\n").rstrip("\r") for line in lines), 1)
    for n, line in numbered:
        if not line:
            continue
        where = f"{name}, line {n}"
        if not line.startswith("@"):
            raise FormatError(f"{where}: a record must begin with @")
        key, desc = _header(line)
        if not key:
            raise FormatError(f"{where}: no id")
        seq, plus = [], False
        for m, part in numbered:
            if part.startswith("+"):
                plus = True
                break
            if " " in part:
                raise FormatError(f"{name}, line {m}: space in the sequence")
            seq.append(part)
        if not plus:
            raise FormatError(f"{where}: the record is not complete")
        bases = "".join(seq)
        qual, size = [], 0
        while size < len(bases):
            m, part = next(numbered, (0, None))
            if part is None:
                raise FormatError(f"{where}: the record is not complete")
            if not part:
                raise FormatError(f"{name}, line {m}: blank line in the quality")
            if " " in part:
                raise FormatError(f"{name}, line {m}: space in the quality")
            qual.append(part)
            size += len(part)
        if size != len(bases):
            raise FormatError(f"{where}: sequence and quality differ in length")
        yield Record(key, desc, bases, "".join(qual))


def parse_fasta(lines: Iterable[str], name: str = "input") -> Iterator[tuple[str, str | None, str]]:
    """(name, description, sequence) of each record."""
    head, parts = None, []
    for n, raw in enumerate(lines, 1):
        line = raw.rstrip("\n").rstrip("\r")
        if line.startswith(">"):
            if head is not None:
                yield *head, "".join(parts)
            head, parts = _header(line), []
        elif line:
            if head is None:
                raise FormatError(f"{name}, line {n}: a record must begin with >")
            parts.append(line.strip())
    if head is not None:
        yield *head, "".join(parts)


def open_text(path: str) -> io.TextIOBase:
    """Lines of a file in UTF-8, unzipped if its name ends with .gz."""
    raw = Store(path).read(path)
    return io.TextIOWrapper(gzip.open(raw, "rb") if path.endswith(".gz") else raw, encoding="utf-8", newline="\n")


def expand(patterns: Iterable[str]) -> list[str]:
    """The files of each pattern in order of their names; a pattern without files is an error."""
    found = []
    for pattern in patterns:
        files = Store(pattern).find(pattern)
        if not files:
            raise FileNotFoundError(f"no file fits {pattern}")
        found += files
    return found


class _FilePartition(InputPartition):
    """A file's records from a place on: the number of the first, and how many are wanted (None: all)."""

    def __init__(self, number: int, path: str, kind: str | None = None, start: int = 0, first: int = 0, n: int | None = None):
        super().__init__(number)
        self.number, self.path, self.kind, self.start, self.first, self.n = number, path, kind, start, first, n


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        paths = options.get("path") or options.get("paths") or ""
        self.paths = [p for p in paths.split(",") if p]
        self.least, self.caps = int(options.get("minlength", 0)), [int(x) for x in str(options.get("maxrecords", -1)).split(",")]
        self.mode = options.get("mode", FAILFAST).upper()
        if self.mode not in (FAILFAST, PERMISSIVE, DROPMALFORMED):
            raise ValueError(f"mode must be {FAILFAST}, {PERMISSIVE} or {DROPMALFORMED}")
        self.index = options.get("index")

    def partitions(self) -> list[InputPartition]:
        files = expand(self.paths)
        entries, missing = fastq_index.read(self.index, files) if self.index else ([], files)
        known: dict[str, list[fastq_index.Entry]] = {}
        for e in entries:
            known.setdefault(e.path, []).append(e)
        out: list[InputPartition] = []
        if len(self.caps) not in (1, len(files)):
            raise ValueError("maxRecords must be a number, or a number for each file")
        for i, (path, most) in enumerate(zip(files, self.caps * len(files) if len(self.caps) == 1 else self.caps, strict=True)):
            if path in known:
                wanted = (e for e in known[path] if most < 0 or e.first < most)
                out += [_FilePartition(i, path, e.kind, e.start, e.first, e.n if most < 0 else min(e.n, most - e.first)) for e in wanted]
            elif path in missing and most:  # one that the index knows to be empty needs no task
                out.append(_FilePartition(i, path, n=None if most < 0 else most))
        return out or [_FilePartition(0, "", n=0)]  # Spark wants one


#: What is done about a record that breaks the rules: an error, a row with its text and the reason, or nothing.
FAILFAST, PERMISSIVE, DROPMALFORMED = "FAILFAST", "PERMISSIVE", "DROPMALFORMED"


class FastqReader(_Reader):
    def read(self, partition: _FilePartition) -> Iterator[pa.RecordBatch]:
        """Records that are long enough, in Arrow batches; reading stops after the last record that is wanted."""
        if partition.n == 0:
            return
        name, kind = os.path.basename(partition.path), partition.kind or kind_of(partition.path)
        stream = Stream(partition.path, kind, partition.start)
        number, left = partition.first, partition.n
        try:
            for step in Records(stream).steps():
                n = step.n if left is None else min(step.n, left)
                columns = [c.slice(0, n) for c in step.columns]
                faults = pc.is_valid(columns[4])
                if self.mode == FAILFAST and pc.any(faults).as_py():
                    at = pc.index(faults, True).as_py()
                    raise FormatError(f"{name}, record {number + at + 1}: {columns[4][at].as_py()}")
                keep = pc.greater_equal(pc.utf8_length(columns[2]), self.least)
                keep = pc.or_(pc.fill_null(keep, False), faults) if self.mode == PERMISSIVE else pc.fill_null(keep, False)
                rows = pa.RecordBatch.from_arrays(
                    [pa.array([partition.path]).take(pa.array(np.zeros(n, np.int64))), pa.array(np.full(n, partition.number, np.int32)), pa.array(np.arange(number, number + n)), *columns],
                    names=["file", "file_number", "record", "id", "desc", "seq", "qual", "problem", "bad"],
                ).filter(keep)
                rows = rows if self.mode == PERMISSIVE else rows.select(rows.schema.names[:7])
                for at in range(0, len(rows), BATCH_ROWS):
                    yield rows.slice(at, BATCH_ROWS)
                number += n
                left = None if left is None else left - n
                if left == 0:
                    return
        except Fault as fault:  # of the compressed file
            raise FormatError(f"{name}: {fault}") from None
        finally:
            stream.close()


class FastaReader(_Reader):
    def read(self, partition: _FilePartition) -> Iterator[pa.RecordBatch]:
        with open_text(partition.path) as lines:
            records = ((n, *r) for n, r in enumerate(parse_fasta(lines, os.path.basename(partition.path))))
            for columns, n in _batches(records, (3,)):
                yield pa.RecordBatch.from_arrays([pa.array([partition.path] * n), *(pa.array(c, t) for c, t in zip(columns, (pa.int64(), *[pa.string()] * 3), strict=True))], names=["file", "record", "name", "desc", "seq"])


def _batches(records: Iterator[tuple], sized: tuple[int, ...]) -> Iterator[tuple[list[tuple], int]]:
    """Columns of up to BATCH_ROWS records whose texts at places `sized` have about BATCH_CHARS characters."""
    rows: list[tuple] = []
    chars = 0
    for row in records:
        rows.append(row)
        chars += sum(len(row[i]) for i in sized)
        if len(rows) >= BATCH_ROWS or chars >= BATCH_CHARS:
            yield list(zip(*rows, strict=True)), len(rows)
            rows, chars = [], 0
    if rows:
        yield list(zip(*rows, strict=True)), len(rows)


class FastqSource(DataSource):
    """spark.read.format("fastq").option("paths", "a.fq,b.*.fq.gz"); options minLength, maxRecords (of each file, or a list with a
    number for each), index (a folder, see fastq_index) and mode: FAILFAST; PERMISSIVE, with the columns problem and bad (the text) for what is no
    record; or DROPMALFORMED. What is no record counts in the numbers of records."""

    @classmethod
    def name(cls) -> str:
        return "fastq"

    def schema(self) -> str:
        more = ", problem string, bad string" if self.options.get("mode", "").upper() == PERMISSIVE else ""
        return "file string, file_number int, record long, id string, desc string, seq string, qual string" + more

    def reader(self, schema) -> DataSourceReader:
        return FastqReader(self.options)

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        return FastqWriter(self.options)


class FastaSource(DataSource):
    """spark.read.format("fasta").option("paths", "adapters.fa")."""

    @classmethod
    def name(cls) -> str:
        return "fasta"

    def schema(self) -> str:
        return "file string, record long, name string, desc string, seq string"

    def reader(self, schema) -> DataSourceReader:
        return FastaReader(self.options)


@dataclass
class _Written(WriterCommitMessage):
    temporary: str
    final: str


class FastqWriter(DataSourceWriter):
    """A file for each partition in a folder; files take their names when the job commits. Option gzip."""

    def __init__(self, options: dict):
        self.folder = options["path"].rstrip("/")
        self.zipped = str(options.get("gzip", "false")).lower() == "true"

    def write(self, iterator) -> WriterCommitMessage:
        from pyspark import TaskContext

        context, store = TaskContext.get(), Store(self.folder)
        final = f"{self.folder}/chunk.{context.partitionId() + 1}.fq" + ".gz" * self.zipped
        temporary = f"{final}.attempt-{context.taskAttemptId()}"
        with store.create(temporary) as raw:
            out = gzip.GzipFile(fileobj=raw, mode="wb", compresslevel=1) if self.zipped else raw
            for r in iterator:
                out.write(f"@{r['id']}{' ' + r['desc'] if r['desc'] else ''}\n{r['seq']}\n+\n{r['qual']}\n".encode())
            if self.zipped:
                out.close()
        return _Written(temporary, final)

    def commit(self, messages) -> None:
        for m in messages:
            if m is not None:
                Store(self.folder).rename(m.temporary, m.final)

    def abort(self, messages) -> None:
        for m in messages:
            if m is not None:
                Store(self.folder).remove(m.temporary)


def register(spark) -> None:
    """Makes the formats fastq and fasta known to a session."""
    spark.dataSource.register(FastqSource)
    spark.dataSource.register(FastaSource)


def read_samples(spark, samples: list[tuple[str, list[str]]], most: int = -1, index: str | None = None, split: int = fastq_index.SPLIT) -> DataFrame:
    """Reads of all samples: sample, ordinal (over a sample's files in order), id, desc, seq, qual. most: reads that are
    wanted of a sample at most, so no file is read further than that.

    Large files and samples of several files need an index of their records, which is looked for in the folder `index`
    (else a new shared one) and made where it is missing or out of date: with it large files are read in ranges of
    `split` bytes, and each file's records are numbered after those of the sample's files before it."""
    register(spark)
    files = [(sample, path) for sample, patterns in samples for path in expand(patterns)]
    if not files:
        raise FileNotFoundError("no FASTQ files")
    paths = [p for _, p in files]
    times = Counter(s for s, _ in files)
    needed = list(dict.fromkeys(p for s, p in files if times[s] > 1 or Store(p).stamp(p)[0] > split))
    reader = spark.read.format("fastq").option("paths", ",".join(paths))
    counts: Counter[str] = Counter()
    if needed:
        index = index or shared_folder(spark, "fastq-index")
        for e in fastq_index.ensure(spark, needed, index, split):
            counts[e.path] += e.n
        reader = reader.option("index", index)
    base: Counter[str] = Counter()
    bases = []
    for n, (sample, path) in enumerate(files):
        bases.append((n, sample, base[sample]))
        base[sample] += counts[path]
    if most >= 0:
        reader = reader.option("maxRecords", ",".join(str(max(0, most - b)) for _, _, b in bases))
    bases = spark.createDataFrame(bases, "file_number int, sample string, base long")
    joined = reader.load().join(F.broadcast(bases), "file_number")  # a row for each file
    found = joined.select("sample", (F.col("base") + F.col("record")).alias("ordinal"), "id", "desc", "seq", "qual")
    return found.filter(F.col("ordinal") < most) if most >= 0 else found


def fastq_text(id_: Column, desc: Column, seq: Column, qual: Column) -> Column:
    """A record's four lines."""
    head = F.concat(F.lit("@"), id_, F.coalesce(F.concat(F.lit(" "), F.when(desc != "", desc)), F.lit("")))
    return F.concat_ws("\n", head, seq, F.lit("+"), qual)


def fasta_text(name: Column, desc: Column, seq: Column, width: int = 80) -> Column:
    """A record with lines of at most `width` bases; an empty sequence has no line."""
    head = F.concat(F.lit(">"), name, F.coalesce(F.concat(F.lit(" "), F.when(desc != "", desc)), F.lit("")))
    wrapped = F.regexp_replace(seq, f"(.{{{width}}})(?=.)", "$1\n")
    return F.concat_ws("\n", head, F.when(seq != "", wrapped))


def write_chunks(chunked: DataFrame, folder: str, start: int | None = None, length: int | None = None, fasta: bool = True, compress: bool = False) -> list[tuple[int, int]]:
    """Pairs of files chunk.N.fq and chunk.N.fa (N from 1) in a folder: the chunk's records trimmed (from start, counted
    from 1, at most length letters), and the same records untrimmed. chunked: id, desc, seq, qual, and place and chunk as
    chunk_numbers() has them. Result: the number and the records of each chunk.

    A chunk is written by one task, as rows stream by. Files take their names when all are written, so a lost task leaves
    none."""
    short = [F.substring(c, F.lit(start or 1), F.lit(length if length is not None else 1 << 30)) for c in ("seq", "qual")]
    texts = [fastq_text(F.col("id"), F.col("desc"), *short).alias("fastq"), fasta_text(F.col("id"), F.col("desc"), F.col("seq")).alias("fasta")]
    dealt = chunked.select("chunk", "place", *texts).repartition("chunk").sortWithinPartitions("chunk", "place").select("chunk", "fastq", "fasta")
    endings = {"fastq": ".fq", **({"fasta": ".fa"} if fasta else {})}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        store, attempt, chunk, n, files = Store(folder), TaskContext.get().taskAttemptId(), None, 0, {}

        def close() -> pa.RecordBatch:
            for raw, out in files.values():
                if out is not raw:
                    out.close()
                raw.close()
            return pa.RecordBatch.from_pydict({"chunk": pa.array([chunk], pa.int64()), "n": pa.array([n], pa.int64()), "attempt": pa.array([attempt], pa.int64())})

        for batch in batches:
            numbers = batch.column("chunk").to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(numbers)) + 1).tolist(), len(numbers)]
            for a, b in zip(edges, edges[1:], strict=False):
                if a == b:
                    continue
                if chunk != int(numbers[a]):
                    if chunk is not None:
                        yield close()
                    chunk, n, files = int(numbers[a]), 0, {}
                    for kind, ending in endings.items():
                        raw = store.create(f"{_chunk(folder, chunk, ending, compress)}.attempt-{attempt}")
                        files[kind] = raw, gzip.GzipFile(fileobj=raw, mode="wb", compresslevel=1) if compress else raw
                for kind, (_, out) in files.items():
                    out.write(("\n".join(batch.column(kind).slice(a, b - a).to_pylist()) + "\n").encode())
                n += b - a
        if chunk is not None:
            yield close()

    written = dealt.mapInArrow(run, "chunk long, n long, attempt long").collect()  # a row for each chunk
    store = Store(folder)
    for r in written:
        for ending in endings.values():
            final = _chunk(folder, r["chunk"], ending, compress)
            store.rename(f"{final}.attempt-{r['attempt']}", final)
    return sorted((r["chunk"] + 1, r["n"]) for r in written)


def _chunk(folder: str, chunk: int, ending: str, compress: bool) -> str:
    return f"{folder.rstrip('/')}/chunk.{chunk + 1}{ending}{'.gz' if compress else ''}"


def write_text(records: DataFrame, text: Column, path: str, compress: bool = False) -> None:
    records.select(text.alias("value")).write.mode("overwrite").option("compression", "gzip" if compress else "none").text(path)


def print_text(records: DataFrame, text: Column, out: IO[str]) -> None:
    """The records' text to a stream such as standard output, in their order. The driver holds one partition at a time;
    for more than a look at some records, write_text() is the way."""
    for row in records.select(text.alias("value")).toLocalIterator():
        out.write(row["value"] + "\n")
    out.flush()
