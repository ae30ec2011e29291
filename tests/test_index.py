"""FASTQ files from any place on: records of blocks, the index of ranges, and what is no record."""

import gzip
import os
import struct
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from seqsieve.sources import blocks, fastq, fastq_index


def bgzf(data: bytes, size: int) -> bytes:
    out = b""
    for i in range(0, len(data), size):
        raw, c = data[i : i + size], zlib.compressobj(6, zlib.DEFLATED, -15)
        body = c.compress(raw) + c.flush()
        out += b"\x1f\x8b\x08\x04\0\0\0\0\0\xff\x06\0BC\x02\0" + struct.pack("<H", len(body) + 25) + body + struct.pack("<II", zlib.crc32(raw), len(raw))
    return out + bytes.fromhex("1f8b08040000000000ff0600424302001b0003000000000000000000")


def records(path, kind, start=0, n=None):
    found = []
    for step in blocks.Records(blocks.Stream(path, kind, start)).steps():
        found += zip(*(c.to_pylist() for c in step.columns), strict=True)
    return found if n is None else found[:n]


@pytest.fixture(autouse=True)
def scan_here(request, monkeypatch):
    if "spark" not in request.fixturenames:
        monkeypatch.setattr(fastq_index, "_scan", lambda spark, todo: {x[0]: fastq_index.scan_range(*x[1:]) for x in todo})


seqs = st.text("AC@G", max_size=9)


@st.composite
def texts(draw):
    """Valid FASTQ: several lines, blank lines, headers and pluses in qualities, and line ends of both kinds."""
    out = ""
    for _ in range(draw(st.integers(0, 9))):
        seq = draw(seqs)
        qual = draw(st.text("I@+", min_size=len(seq), max_size=len(seq)))
        head = draw(st.sampled_from(["@r", "@r x y", "@é 1", "@@ ", "@+"]))
        cut = draw(st.integers(1, len(seq) - 1)) if len(seq) > 1 and draw(st.booleans()) else 0
        lines = [head, seq[:cut], seq[cut:], "+z", qual[:cut], qual[cut:]] if cut else [head, seq, "+", qual]
        out += "\n".join(lines) + "\n" * draw(st.integers(1, 2))
    out = out.replace("\n", draw(st.sampled_from(["\n", "\r\n"])))
    return out[: len(out) - draw(st.integers(0, 1))] if out else out


@settings(max_examples=60, deadline=None)
@given(texts(), st.integers(3, 40))
def test_any_cut_gives_the_same_records(tmp_path_factory, text, size):
    expected = [(r.id, r.desc, r.seq, r.qual, None, None) for r in fastq.parse_fastq(text.split("\n") if text else [])]
    folder = tmp_path_factory.mktemp("cuts")
    for kind, raw in (("plain", text.encode()), ("bgzf", bgzf(text.encode(), size)), ("gzip", gzip.compress(text.encode()[:9]) + gzip.compress(text.encode()[9:]))):
        path = f"{folder}/x.fq" + ".gz" * (kind != "plain")
        with open(path, "wb") as f:
            f.write(raw)
        assert records(path, kind) == expected
        for split in (1, 2, 3, 7, 19, 60, 1000):
            found = []
            for e in fastq_index.scan(None, [path], split):
                assert e.first == len(found) and e.n and e.problem is None
                found += records(path, e.kind, e.start, e.n)
            assert found == expected


LINES = st.sampled_from(["@r", "@r2 d", "ACGT", "A", "+", "IIII", "I", "@", "", "# x", "@III", "é"])


@settings(max_examples=150, deadline=None)
@given(st.lists(LINES, max_size=16).map("\n".join))
def test_any_text_is_parsed_alike_from_any_cut(tmp_path_factory, text):
    path = f"{tmp_path_factory.mktemp('odd')}/x.fq"
    with open(path, "w") as f:
        f.write(text)
    whole = records(path, "plain")
    good = [r[:4] for r in whole if r[4] is None]
    try:
        assert good == [(r.id, r.desc, r.seq, r.qual) for r in fastq.parse_fastq(text.split("\n"))] and len(good) == len(whole)
    except fastq.FormatError:
        assert len(good) < len(whole)
    for split in (1, 4, 11):
        found = []
        for e in fastq_index.scan(None, [path], split):
            found += records(path, e.kind, e.start, e.n)
        assert found == whole


def test_numbers_of_large_files_and_stale_indexes(spark, tmp_path):
    fastq.register(spark)
    rows = [(f"r{n}", "@" * (n % 50)) for n in range(4000)]
    text = "".join(f"@{i}\n{q}\n+\n{q}\n" for i, q in rows)
    (tmp_path / "a.fq").write_text(text)
    (tmp_path / "b.fq.gz").write_bytes(bgzf(text.encode(), 5000))
    (tmp_path / "c.fq").write_text("")
    index = str(tmp_path / "index")
    reads = fastq.read_samples(spark, [("s", [f"{tmp_path}/*.fq*"])], index=index, split=20_000)
    assert reads.rdd.getNumPartitions() > 8
    assert [(r["ordinal"], r["id"], r["seq"]) for r in reads.orderBy("ordinal").collect()] == [(4000 * k + n, i, q) for k in (0, 1) for n, (i, q) in enumerate(rows)]
    few = fastq.read_samples(spark, [("s", [f"{tmp_path}/*.fq*"])], 1000, index, 20_000)
    assert few.count() == 1000 and few.rdd.getNumPartitions() <= reads.rdd.getNumPartitions() // 2 + 1
    known = [p.name for p in (tmp_path / "index").iterdir()]
    assert fastq_index.read(index, [f"{tmp_path}/a.fq", f"{tmp_path}/c.fq"])[1] == [] and len(known) == 1
    (tmp_path / "a.fq").write_text(text[: len("@r0\n\n+\n\n")])
    os.utime(tmp_path / "a.fq", (1, 1))
    again = fastq.read_samples(spark, [("s", [f"{tmp_path}/a.fq", f"{tmp_path}/b.fq.gz"])], index=index, split=20_000)
    assert again.count() == 4001 and again.agg({"ordinal": "max"}).first()[0] == 4000
    assert len(list((tmp_path / "index").iterdir())) == 2  # the changed file alone is scanned anew
    assert sum(e.n for e in fastq_index.read(index, [f"{tmp_path}/a.fq"])[0]) == 1


def test_modes(spark, tmp_path):
    fastq.register(spark)
    path = str(tmp_path / "x.fq")
    with open(path, "w") as f:
        f.write("@r1\nAC\n+\nII\n@\nA\n+\nI\n@r2\nA C\n+\nIII\n@r3\nG\n+\nI\n\n@r4\nACGT\n+\nII")
    load = lambda mode, **more: spark.read.format("fastq").option("paths", path).option("mode", mode).options(**more).load()
    rows = [(r["record"], r["id"], r["problem"], r["bad"]) for r in load("PERMISSIVE").orderBy("record").collect()]
    assert rows == [(0, "r1", None, None), (1, None, "no id", "@\nA\n+\nI\n"), (2, None, "space in the sequence", "@r2\nA C\n+\nIII\n"), (3, "r3", None, None), (4, None, "the record is not complete", "@r4\nACGT\n+\nII")]
    assert [(r["record"], r["id"]) for r in load("DROPMALFORMED").orderBy("record").collect()] == [(0, "r1"), (3, "r3")]
    assert load("PERMISSIVE", minLength=2).count() == 4
    assert load("FAILFAST", maxRecords=1).count() == 1
    with pytest.raises(Exception, match="record 2: no id"):
        load("FAILFAST").count()
    with pytest.raises(Exception, match="mode must be"):
        load("ANY").count()
    (tmp_path / "cut.fq.gz").write_bytes(gzip.compress(b"@r1\nAC\n+\nII\n" * 1000)[:-20])
    with pytest.raises(Exception, match="cut off|not complete"):
        spark.read.format("fastq").option("paths", f"{tmp_path}/cut.fq.gz").load().count()
