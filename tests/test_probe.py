"""Texts that stream past short sequences, references in pieces, and stored genomes, against plain versions."""

import os
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from seqsieve.config import ScreenConfig
from seqsieve.operators import align, probe
from seqsieve.plans import queries as core
from seqsieve.plans import screen
from seqsieve.sources import fastq, genomes

few = st.text("abé", max_size=40)


@settings(max_examples=150, deadline=None)
@given(few, st.lists(st.text("abé", min_size=1, max_size=9), max_size=8), st.integers(4, 50))
def test_first_places_of_passages(text, passages, step):
    before, probe.STEP = probe.STEP, step
    try:
        passage, position = probe.Passages(passages).first(text)
    finally:
        probe.STEP = before
    assert dict(zip(passage.tolist(), position.tolist(), strict=True)) == {i: text.find(p) for i, p in enumerate(passages) if p in text}


def plain_best(read, forms, least):
    """The best segment of all forms: score, then form, start in the read, start in the form."""
    found = []
    for number, form in enumerate(forms):
        for d in range(1 - len(form), len(read)):
            x, y = max(d, 0), max(-d, 0)
            score = begin = 0
            for i in range(min(len(read) - x, len(form) - y)):
                if score <= 0:
                    score, begin = 0, i
                score += align.MATCH if read[x + i] == form[y + i] else align.MISMATCH
                if score >= least:
                    found.append((-score, number, x + begin, y + begin, i - begin + 1))
    if not found:
        return None
    score, number, x, y, _ = top = min(found, key=lambda f: f[:4])
    return number, x, y, min(f[4] for f in found if f[:4] == top[:4]), -score


@settings(max_examples=150, deadline=None)
@given(st.lists(few, max_size=4), st.lists(st.text("abé", min_size=1, max_size=12), min_size=1, max_size=4), st.integers(5, 40), st.integers(3, 50))
def test_adapters_of_a_batch(reads, forms, least, step):
    k = align.exact_run(least, max(map(len, forms)))
    before, probe.STEP = probe.STEP, step
    try:
        rows = np.stack(probe.Adapters(forms, least, k, align.MATCH, align.MISMATCH).best(reads), 1).tolist()
    finally:
        probe.STEP = before
    got = {r[0]: tuple(r[1:]) for r in rows}
    assert got == {i: b for i, r in enumerate(reads) if (b := plain_best(r, forms, least)) is not None}


def test_frequent_seeds_give_one_row(monkeypatch):
    monkeypatch.setattr(probe, "PAIRS", 50)
    known = probe.ShortReads(["A" * 12, "T" * 12, "A" * 11 + "C", "G" + "T" * 11], 12, 2)
    form, position, wrong = known.best("A" * 500 + "C" + "A" * 30, 400)
    assert list(zip(form.tolist(), position.tolist(), wrong.tolist(), strict=True)) == [(0, 0, 0), (2, 0, 1)]
    assert known.described("A" * 500, form, position) == ["", "11:A>C"]
    back = probe.ShortReads(["A" * 11 + "C", "G" + "T" * 11], 12, 2)
    form, position, _ = back.best("T" * 40, 40)
    assert form.tolist() == [1] and back.described("T" * 40, form, position) == ["11:T>G"]


def sequences():
    r = random.Random(8)
    base = lambda n: "".join(r.choice("ACGT") for _ in range(n))
    return {"g1": [("c1", base(700)), ("c2", base(90)), ("c3", "")], "g2": [("x", "ACGTTGCATT" * 60)]}, r


def write_fasta(folder, name, records, width=60):
    with open(f"{folder}/{name}.fa", "w") as f:
        f.writelines(f">{c} more\n" + "".join(s[i : i + width] + "\n" for i in range(0, len(s), width)) for c, s in records)


def test_pieces_and_stored_genomes_give_the_same_alignments(spark, tmp_path, monkeypatch):
    known, r = sequences()
    for g, records in known.items():
        write_fasta(tmp_path, g, records)
    reads = []
    for n in range(60):
        seq = known["g1"][0][1] if n % 2 else known["g2"][0][1]
        at = r.randrange(len(seq) - 36)
        text = list(seq[at : at + 36])
        text[r.randrange(36)] = r.choice("ACGT")
        reads.append(("s", n, "".join(text)))
    reads += [("s", 99, None), ("s", 98, "ACGT")]
    short = spark.createDataFrame(reads, "id string, read long, seq string")
    whole = spark.createDataFrame([(g, c, s) for g, cs in known.items() for c, s in cs], "genome string, chromosome string, seq string")
    expected = sorted(map(tuple, align.align_ungapped(short, whole, describe=True).collect()))
    assert len(expected) >= 60 and any(row[-1] for row in expected)
    files = [f"{tmp_path}/{g}.fa" for g in known]
    pieces = genomes.read_pieces(spark, files, 100, 40, 128)
    assert pieces.count() > 10 and genomes.genome_names(files) == ["g1", "g2"]
    assert sorted(map(tuple, align.align_ungapped(short, pieces, describe=True).collect())) == expected
    monkeypatch.setattr(align, "PROBE_BYTES", 500)  # reads in several groups
    assert sorted(map(tuple, align.align_ungapped(short, whole, describe=True).collect())) == expected
    for g in known:
        genomes.store_genome(spark, g, [f"{tmp_path}/{g}.fa"], f"{tmp_path}/stored", 200)
    before = {p: os.stat(p).st_mtime_ns for p in map(str, (tmp_path / "stored" / "g1").rglob("*"))}
    genomes.store_genome(spark, "g3", [f"{tmp_path}/g2.fa"], f"{tmp_path}/stored")
    assert genomes.stored_names(f"{tmp_path}/stored") == ["g1", "g2", "g3"]
    assert before == {p: os.stat(p).st_mtime_ns for p in map(str, (tmp_path / "stored" / "g1").rglob("*"))}
    found = align.align_ungapped(short, genomes.stored_pieces(spark, f"{tmp_path}/stored", ["g1", "g2"]), describe=True)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1, plan  # the hits; neither texts nor seeds are shuffled
    assert sorted(map(tuple, found.collect())) == expected
    with pytest.raises(FileNotFoundError):
        genomes.stored_pieces(spark, f"{tmp_path}/nothing")


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "chr1 d", "é b", "x>y"]), st.text("ACGé", max_size=30)), max_size=4), st.sampled_from([3, 8, 100]), st.sampled_from(["\n", "\r\n"]), st.integers(1, 40), st.integers(1, 9), st.integers(0, 5))
def test_any_cut_of_fasta_gives_the_same_pieces(tmp_path_factory, records, width, end, split, size, overlap):
    path = f"{tmp_path_factory.mktemp('fasta')}/g.fa"
    with open(path, "w", newline="") as f:
        f.writelines(f">{h}{end}" + "".join(s[i : i + width] + end for i in range(0, len(s), width)) for h, s in records)
    length = os.path.getsize(path)
    ranges, name, place = [], None, 0
    for a in range(0, max(length, 1), split):
        r = genomes._Range(path, "plain", a, a + split if a + split < length else -1, name, place)
        before, last, after = genomes._ends(r)
        name, place = (name, place + before) if last is None else (last, after)
        ranges.append(r)
    wanted, found = [x for x in records if x[1]], []
    for head, start, own, text in (p for r in ranges for p in genomes._pieces(r, size, overlap)):
        if start == 0:
            found.append([head, ""])
        assert found[-1][0] == head and len(found[-1][1]) == start
        assert text == wanted[len(found) - 1][1][start : start + own + overlap]
        found[-1][1] += text[:own]
    assert [tuple(x) for x in found] == wanted


def test_a_screen_of_stored_genomes(spark, tmp_path):
    known, _ = sequences()
    for g, records in known.items():
        write_fasta(tmp_path, g, records)
    (tmp_path / "adapters.fa").write_text(">a\nAGATCGGAAGAGCACACGTC\n")
    (tmp_path / "genomes.csv").write_text("genome,species,synonyms\ng2,two,\ng1,one,\n")
    (tmp_path / "sheet.csv").write_text("id,fastq,species,controls\nS,s.fq,one,\n")
    seq = known["g1"][0][1]
    (tmp_path / "s.fq").write_text("".join(f"@r{n}\n{seq[n : n + 40]}\n+\n{'I' * 40}\n" for n in range(20)))
    from seqsieve import cli

    args = ["--store-genomes", *(f"{tmp_path}/{g}.fa" for g in known), "--genome-dir", f"{tmp_path}/stored"]
    cli.main(args)
    config = ScreenConfig(fastq_dir=str(tmp_path), output_dir=str(tmp_path / "out"))
    found = screen.run_files(spark, f"{tmp_path}/sheet.csv", f"{tmp_path}/genomes.csv", None, f"{tmp_path}/adapters.fa", config, f"{tmp_path}/stored")
    assert [(r["genome"], r["assigned"]) for r in found.alignment_summary.collect()] == [("g1", 20), ("g2", 0), ("unmapped", 0)]
    for bad in (["--genome-dir", "x"], ["--store-genomes", "x"], ["--genome-dir", "x", "--summary", "a", "--alignment-summary", "b"]):
        with pytest.raises(SystemExit):
            cli.main(bad)


def test_adapters_in_whole_texts_equal_a_plain_search(spark, tmp_path):
    r = random.Random(3)
    passage = "".join(r.choice("abcdefgh ") for _ in range(60))
    texts = [(1, "x" * 30 + passage + "y"), (2, passage[:20] + "?" + passage[21:]), (3, passage[5:35]), (4, None), (5, ""), (6, "nothing of it")]
    spark.createDataFrame([(i, t, "s") for i, t in texts], "doc_id long, text string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(7, passage), (8, None), (9, "short")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = {x["read"]: (x["adapter"], x["start"], x["end"], x["adapter start"], x["score"]) for x in core.QUERIES["adapters_in_texts"](spark, str(tmp_path)).collect()}
    forms = [passage[:40], align._complement(passage[:40]), "short", align._complement("short")]
    expected = {}
    for i, t in texts:
        best = plain_best(t or "", forms, 170)
        if best is not None:
            number, x, y, n, score = best
            expected[i] = ("7", x, x + n, y, score)
    assert got == expected and set(got) == {1, 2}


def test_descriptors(spark, tmp_path):
    from seqsieve.functions import mismatch_count, mismatch_places
    from seqsieve.sources import tables
    from pyspark.sql import functions as F

    rows = spark.createDataFrame([("3:A>C,10:,>:",), ("",), (None,)], "d string")
    got = [(r["n"], [tuple(x) for x in r["p"] or []]) for r in rows.select(mismatch_count(F.col("d")).alias("n"), mismatch_places(F.col("d")).alias("p")).collect()]
    assert got[1:] == [(0, []), (0, [])] and got[0][1] == [(3, "A", "C"), (10, ",", ":")]
    (tmp_path / "a.tsv").write_text("\t".join(tables.GENOME_ALIGNMENTS) + "\n1\tr\tg\tc\t5\t+\tACG\tIII\t1:A>C\n1\tq\tg\tc\t5\t+\tACG\tIII\t\n")
    assert [(r["mismatches"], r["described"]) for r in tables.genome_alignments(spark, str(tmp_path / "a.tsv"), True).collect()] == [(1, "1:A>C"), (0, "")]
    assert fastq.expand([str(tmp_path / "a.tsv")])
