import gzip

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from seqsieve.operators.checks import record_problem
from seqsieve.sources import fastq
from seqsieve.sources.fastq import FormatError, Record, parse_fasta, parse_fastq


def parse(text):
    return list(parse_fastq(text.splitlines(keepends=True)))


def test_plain_record_with_and_without_description():
    assert parse("@r1 a b\nACGT\n+\nIIII\n@r2\nA\n+r2\nI\n") == [Record("r1", "a b", "ACGT", "IIII"), Record("r2", None, "A", "I")]


def test_several_lines_blank_lines_and_quality_with_at():
    assert parse("\n\n@r\nAC\nGT\n+\n@I\n+I\n\n@s\nA\n+\n@\n") == [Record("r", None, "ACGT", "@I+I"), Record("s", None, "A", "@")]


def test_line_ends():
    assert parse("@r x\r\nAC\r\n+\r\nII\r\n@s\nA\n+\nI") == [Record("r", "x", "AC", "II"), Record("s", None, "A", "I")]


def test_tab_belongs_to_the_id_and_empty_sequence():
    assert parse("@r\tx y\n\n+\n") == [Record("r\tx", "y", "", "")]


@pytest.mark.parametrize(
    ("text", "said"),
    [
        ("r\nA\n+\nI\n", "line 1: a record must begin with @"),
        ("\n@\nA\n+\nI\n", "line 2: no id"),
        ("@ x\nA\n+\nI\n", "no id"),
        ("@r\nACGT\n", "not complete"),
        ("@r\nACGT\n+\nII", "not complete"),
        ("@r\nAC GT\n+\nIIIII\n", "space in the sequence"),
        ("@r\nACGT\n+\nI II\n", "space in the quality"),
        ("@r\nACGT\n+\nIII\nII\n", "differ in length"),
        ("@r\nACGT\n+\nII\n\nII\n", "blank line in the quality"),
    ],
)
def test_faults(text, said):
    with pytest.raises(FormatError, match=said):
        parse(text)


names = st.text("abcXYZ09_:/", min_size=1, max_size=8)
bases = st.text("ACGTN", max_size=200)


@given(st.lists(st.tuples(names, st.one_of(st.none(), names), bases), max_size=6))
def test_written_records_are_read_again(rows):
    text = "".join(f"@{n}{' ' + d if d else ''}\n{s}\n+\n{'I' * len(s)}\n" for n, d, s in rows)
    assert parse(text) == [Record(n, d, s, "I" * len(s)) for n, d, s in rows]


def test_source_reads_gzip_members_globs_and_ordinals(spark, tmp_path):
    (tmp_path / "a.1.fq").write_text("@r1\nACGT\n+\nIIII\n@r2 d\nAC\n+\nII\n")
    with open(tmp_path / "a.2.fq.gz", "wb") as f:
        f.write(gzip.compress(b"@r3\nA\n+\nI\n") + gzip.compress(b"@r4\nC\n+\nI\n"))
    (tmp_path / "b.fq").write_text("@r1\nG\n+\nI\n")
    reads = fastq.read_samples(spark, [("a", [f"{tmp_path}/a.*"]), ("b", [f"{tmp_path}/b.fq"])])
    assert [(r["sample"], r["ordinal"], r["id"], r["seq"]) for r in reads.orderBy("sample", "ordinal").collect()] == [
        ("a", 0, "r1", "ACGT"), ("a", 1, "r2", "AC"), ("a", 2, "r3", "A"), ("a", 3, "r4", "C"), ("b", 0, "r1", "G"),
    ]
    few = spark.read.format("fastq").option("paths", f"{tmp_path}/a.1.fq").option("minLength", 3).load()
    assert few.count() == 1
    assert spark.read.format("fastq").option("paths", f"{tmp_path}/a.1.fq").option("maxRecords", 1).load().count() == 1
    with pytest.raises(Exception, match="no file fits"):
        fastq.expand([f"{tmp_path}/none*.fq"])


def test_writer_and_texts(spark, tmp_path):
    fastq.register(spark)
    rows = spark.createDataFrame([("r1", "d", "ACGT", "IIII"), ("r2", None, "", "")], "id string, desc string, seq string, qual string").coalesce(1)
    rows.write.format("fastq").option("gzip", "true").mode("append").save(str(tmp_path / "out"))
    back = spark.read.format("fastq").option("paths", f"{tmp_path}/out/*.fq.gz").load()
    assert [(r["id"], r["desc"], r["seq"]) for r in back.orderBy("record").collect()] == [("r1", "d", "ACGT"), ("r2", None, "")]
    text = rows.select(fastq.fastq_text(*(F.col(c) for c in ("id", "desc", "seq", "qual"))).alias("t")).collect()
    assert [r["t"] for r in text] == ["@r1 d\nACGT\n+\nIIII", "@r2\n\n+\n"]


def test_fasta(spark, tmp_path):
    assert list(parse_fasta(">a x\nAC\nGT\n\n>b\n".splitlines())) == [("a", "x", "ACGT"), ("b", None, "")]
    with pytest.raises(FormatError):
        list(parse_fasta(["ACGT"]))
    df = spark.createDataFrame([("a", "A" * 161), ("b", "")], "name string, seq string")
    texts = [r["t"] for r in df.select(fastq.fasta_text(F.col("name"), F.lit(None).cast("string"), F.col("seq")).alias("t")).collect()]
    assert texts == [">a\n" + "A" * 80 + "\n" + "A" * 80 + "\nA", ">b"]


def test_record_problems(spark):
    df = spark.createDataFrame([("r", "A", "I"), (None, "A", "I"), ("r", None, "I"), ("r", "A", None), ("", "A", "I"), ("r", "é", "I"), ("r", "A", "é"), ("r", "AC", "I")], "id string, seq string, qual string")
    assert [r["p"] for r in df.select(record_problem().alias("p")).collect()] == [None, "no id", "no sequence", "no quality", "no id", "sequence is not ASCII", "quality is not ASCII", "sequence and quality differ in length"]


def test_store_by_pyarrow(tmp_path):
    """What a store without paths does, on a folder that is reached through pyarrow."""
    from pyarrow import fs

    from seqsieve.sources.store import Store

    root = f"file://{tmp_path}"
    store = Store(root)
    store.local, store.fs = False, fs.LocalFileSystem()
    for name in ("a/x.1.fq", "a/x.2.fq", "b/x.1.fq", "a/deep/x.3.fq"):
        with store.create(f"{root}/{name}") as f:
            f.write(name.encode())
    assert store.find(f"{root}/a/x.*.fq") == [f"{root}/a/x.1.fq", f"{root}/a/x.2.fq"] == [f"file://{p}" for p in Store(root).find(f"{root}/a/x.*.fq")]
    assert store.find(f"{root}/*/x.1.fq") == [f"{root}/a/x.1.fq", f"{root}/b/x.1.fq"]
    assert store.find(f"{root}/none/*") == [] and store.find(f"{root}/a/x.1.fq") == [f"{root}/a/x.1.fq"]
    store.rename(f"{root}/b/x.1.fq", f"{root}/b/y.fq")
    store.remove(f"{root}/a/x.1.fq")
    store.remove(f"{root}/a/x.1.fq")
    assert store.read(f"{root}/b/y.fq").read() == b"b/x.1.fq" and not (tmp_path / "a" / "x.1.fq").exists()


def test_reader_stops_at_the_cap(spark, tmp_path):
    (tmp_path / "a.1.fq").write_text("@r1\nA\n+\nI\n@r2\nC\n+\nI\n" + "not a record\n")
    (tmp_path / "a.2.fq").write_text("@r3\nG\n+\nI\n@r4\nT\n+\nI\nnot a record\n")
    (tmp_path / "b.fq").write_text("@r5\nGé\n+\nII\n@r6\nT\n+\nI\nnot a record\n")
    reads = fastq.read_samples(spark, [("a", [f"{tmp_path}/a.*"]), ("b", [f"{tmp_path}/b.fq"])], 2)
    assert sorted((r["sample"], r["ordinal"], r["id"], r["seq"]) for r in reads.collect()) == [("a", 0, "r1", "A"), ("a", 1, "r2", "C"), ("b", 0, "r5", "Gé"), ("b", 1, "r6", "T")]


def test_text_to_a_stream(spark):
    import io

    rows = spark.createDataFrame([(f"r{n}", None, "ACGT", "IIII") for n in range(5)], "id string, desc string, seq string, qual string").repartitionByRange(3, "id")
    out = io.StringIO()
    fastq.print_text(rows, fastq.fasta_text(*(F.col(c) for c in ("id", "desc", "seq"))), out)
    assert out.getvalue() == "".join(f">r{n}\nACGT\n" for n in range(5))
