"""Metadata, assignment and summaries against results worked out by hand, and a whole run."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from seqsieve.config import ScreenConfig, check_tool_limits
from seqsieve.operators import align, assign, checks, resolve, sampling
from seqsieve.operators.chart import bar_chart, bar_chart_pdf
from seqsieve.plans import screen
from seqsieve.sources import tables

SAMPLES = "id string, user_id string, species string, controls string"
DETAILS = "genome string, species string, synonyms string"


def details(spark):
    rows = [("hsa.GRCh38", "Homo sapiens", "human"), ("mmu", "Mus musculus", " mouse | house mouse "), ("phix", "PhiX 174", None), ("dog", "Canis", None)]
    return spark.createDataFrame(rows, DETAILS)


def indexes(spark, names=("HSA.grch38", "mmu", "phix")):
    return spark.createDataFrame([(n,) for n in names], "id string")


def test_resolve(spark):
    samples = spark.createDataFrame([("1", "A", "human|Homo sapiens|elephant|PhiX 174|dog", "phix"), ("2", "B", "NA", "")], SAMPLES)
    found = resolve.resolve(samples, details(spark), indexes(spark))
    rows = {r["id"]: r for r in found.samples.collect()}
    assert rows["1"]["genomes"] == "HSA.grch38|dog" and rows["1"]["control_genomes"] == "phix"
    assert rows["2"]["genomes"] is None and rows["2"]["species"] is None
    assert found.warnings == ["no genome is known for these species: 'elephant'", "no index was found for these species: 'Canis'"]
    assert {r["genome"] for r in found.genomes.collect()} == {"HSA.grch38", "mmu", "phix"}


@pytest.mark.parametrize(
    ("samples", "names", "more", "said"),
    [
        ([], ["mmu"], [], "samples is empty"),
        ([(None, "A", "x", None)], ["mmu"], [], "missing id"),
        ([("1", "A", "x", None), ("1", "B", "x", None)], ["mmu"], [], "duplicate id"),
        ([("1", "A", "x", None)], ["a|b"], [], "character |"),
        ([("1", "A", "x", None)], ["mmu", "MMU"], [], "differ only by case"),
        ([("1", "A", "x", None)], ["mmu"], [("new", "human", None)], "more than one genome"),
        ([("1", "A", "x", None)], ["mmu"], [("mmu", None, None)], "duplicate genome"),
        ([("1", "A", "x", None)], ["mmu"], [("MMU", None, None)], "differ only by case"),
        ([("1", "A", "x", None)], ["mmu"], [(None, "y", None)], "missing genome"),
    ],
)
def test_resolve_faults(spark, samples, names, more, said):
    listed = details(spark).unionByName(spark.createDataFrame(more, DETAILS))
    with pytest.raises(checks.ScreenError, match=said.replace("|", "\\|")):
        resolve.resolve(spark.createDataFrame(samples, SAMPLES), listed, indexes(spark, names))


def test_add_ids_and_columns(spark):
    sheet = spark.createDataFrame([("b", "f1", "x", "NA", "more"), ("a", "f2", "", None, "more")], "id string, fastq string, species string, controls string, user_id string")
    assert [tuple(r) for r in resolve.add_ids(sheet).orderBy("id").collect()] == [(1, "b", "f1", "x", None), (2, "a", "f2", None, None)]
    with pytest.raises(checks.ScreenError, match="missing columns"):
        resolve.add_ids(sheet.drop("fastq"))


def hits(spark, rows):
    full = [(s, r, g, "1", 5, "+", "A" * 36, "I" * 36, m, 36) for s, r, g, m in rows]
    return spark.createDataFrame(full, "id string, read string, genome string, chromosome string, position long, strand string, sequence string, quality string, mismatches int, length int")


def result(spark, rows, sampled=4):
    samples = spark.createDataFrame([("1", "A", "human", "phix", "hsa", "phix"), ("2", "B", None, None, None, None)], SAMPLES + ", genomes string, control_genomes string")
    genomes = spark.createDataFrame([("hsa", "Homo sapiens"), ("mmu", "Mus"), ("phix", "PhiX")], "genome string, species string")
    counts = spark.createDataFrame([("1", 10, sampled), ("2", 7, 0)], "id string, read long, sampled long")
    adapters = spark.createDataFrame([("1", "r1"), ("1", "r1"), ("1", "r2")], "id string, read string")
    return screen.summarise(samples, genomes, counts, hits(spark, rows), adapters)


ROWS = [("1", "r1", "hsa", 0), ("1", "r1", "mmu", 0), ("1", "r2", "mmu", 1), ("1", "r2", "hsa", 2), ("1", "r3", "mmu", 0)]


def test_assignment_and_summaries(spark):
    found = result(spark, ROWS)
    chosen = {r["read"]: r["genome"] for r in found.genome_alignments.filter("assigned").collect()}
    assert chosen == {"r1": "hsa", "r2": "mmu", "r3": "mmu"}
    first, second = found.summary.collect()
    assert (first["genome aligned"], first["genome aligned %"], first["genome error rate"]) == (2, 50.0, 2.78)
    assert (first["unmapped"], first["adapter"], first["adapter %"], first["sequences"]) == (1, 2, 50.0, 10)
    assert (second["genome aligned"], second["genome aligned %"], second["genome error rate"], second["unmapped"], second["unmapped %"]) == (0, 0.0, None, 0, 0.0)
    rows = [(r["id"], r["genome"], r["expected"], r["control"], r["aligned"], r["assigned"]) for r in found.alignment_summary.collect()]
    assert rows == [
        ("A", "mmu", "no", "no", 3, 2), ("A", "hsa", "yes", "no", 2, 1), ("A", "phix", "yes", "yes", 0, 0), ("A", "unmapped", None, None, 1, 1),
        ("B", "hsa", "no", "no", 0, 0), ("B", "mmu", "no", "no", 0, 0), ("B", "phix", "no", "no", 0, 0), ("B", "unmapped", None, None, 0, 0),
    ]


def test_no_alignments_and_chart(spark):
    found = result(spark, [])
    assert [r["unmapped"] for r in found.summary.collect()] == [4, 0]
    bars = result(spark, ROWS).plot_data()
    assert [(r["user_id"], r["type"], r["category"], r["count"]) for r in bars.orderBy("group").collect()] == [
        ("A", "adapter", "adapter", 2.0), ("A", "genome", "unmapped", 1.0), ("A", "genome", "unexpected/contaminant", 2.0), ("A", "genome", "expected species", 1.0), ("B", "adapter", "adapter", 0.0),
    ]
    assert {r["bounded_error_rate"] for r in bars.collect()} == {0.25, 1.39}
    drawn = bar_chart(bars)
    assert drawn.startswith("<svg") and drawn.count("<title>") == 5


@settings(max_examples=4, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("123456"), st.sampled_from(["hsa", "mmu", "phix"]), st.integers(0, 3)), max_size=25))
def test_each_aligned_read_is_assigned_once(spark, rows):
    found = result(spark, [("1", *r) for r in rows], sampled=20)
    reads = {r for r, _, _ in rows}
    assert found.genome_alignments.filter("assigned").count() == len(reads)
    assert found.summary.collect()[0]["unmapped"] == 20 - len(reads)


def test_sampling(spark):
    reads = spark.createDataFrame([(s, n, f"{s}{n}", "A" * (n % 50), "I" * (n % 50)) for s in "ab" for n in range(600)], "sample string, ordinal long, id string, seq string, qual string")
    taken = sampling.sample_reads(reads, 100, 10, "1")
    names = sorted(r["id"] for r in taken.collect())
    assert len(names) == 200 and taken.filter("length(seq) < 10").count() == 0
    assert names == sorted(r["id"] for r in sampling.sample_reads(reads.repartition(7), 100, 10, "1").collect())
    assert names != sorted(r["id"] for r in sampling.sample_reads(reads, 100, 10, "2").collect())
    assert sampling.sample_reads(reads, 10_000, 10, "1").count() == 2 * 480
    assert [tuple(r) for r in sampling.sampling_summary(reads, taken).orderBy("id").collect()] == [("a", 600, 100), ("b", 600, 100)]
    assert sampling.capped(reads, 5).count() == 10
    for size, parts in ((100, 7), (1, 3), (479, 2), (10_000, 5)):
        once, counts = sampling.one_pass_sample(reads.repartition(parts), size, 10, "1")
        assert once.columns == reads.columns
        assert sorted(map(tuple, once.collect())) == sorted(map(tuple, sampling.sample_reads(reads, size, 10, "1").collect()))
        assert sorted(map(tuple, counts.collect())) == [("a", 600, min(size, 480)), ("b", 600, min(size, 480))]
    assert [x.count() for x in sampling.one_pass_sample(reads.limit(0), 5, 1, "1")] == [0, 0]
    odd = spark.createDataFrame([("a", 0, "r", None, None), ("b", 0, "s", "ACGT", "IIII")], reads.schema)
    once, counts = sampling.one_pass_sample(odd, 5, 1, "1")
    assert [r["id"] for r in once.collect()] == ["s"] and sorted(map(tuple, counts.collect())) == [("a", 1, 0), ("b", 1, 1)]


def test_samples_are_cut_as_they_come(spark, monkeypatch):
    monkeypatch.setattr(sampling, "ROWS", 10)
    reads = spark.createDataFrame([("a" if n % 3 else None, n, f"r{n}", "ACGT", "IIII") for n in range(900)], "sample string, ordinal long, id string, seq string, qual string").coalesce(1)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 50)
    try:
        once, counts = sampling.one_pass_sample(reads, 20, 1, "3")
        assert sorted(map(tuple, once.filter("sample is not null").collect())) == sorted(map(tuple, sampling.sample_reads(reads.filter("sample is not null"), 20, 1, "3").collect()))
        assert {tuple(r) for r in counts.collect()} == {("a", 600, 20), (None, 300, 20)}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_alignments_are_shuffled_once(spark):
    noted = assign.annotate(hits(spark, ROWS).withColumn("genome_ordinal", F.lit(1)), *(spark.createDataFrame([("1", g)], "id string, genome string") for g in ("hsa", "phix")))
    kept = assign.read_level(noted).persist()
    chosen, sums = assign.chosen_and_sums(kept, screen.TIES, 6)
    rows = {r["genome"]: r.asDict() for r in sums.collect()}
    assert (rows["hsa"]["aligned"], rows["hsa"]["assigned"], rows["mmu"]["assigned"]) == (2, 1, 2)
    assert sum(r["expected_reads"] for r in rows.values()) == 2 and sum(r["control_reads"] for r in rows.values()) == 0
    kept.count()
    plan = chosen._jdf.queryExecution().executedPlan().toString()
    outside, inside = [], None  # lines of the plan that are no part of how the kept rows were made
    for line in plan.splitlines():
        depth = next((i for i, c in enumerate(line) if c.isalpha()), 0)
        inside = None if inside is not None and depth <= inside else inside
        if inside is None:
            outside.append(line)
            inside = depth if "InMemoryRelation" in line else None
    assert "InMemoryRelation" in plan and not [x for x in outside if "Exchange hashpartitioning(id" in x and "read#" in x], plan
    assert [r["genome"] for r in chosen.filter("assigned").orderBy("read").collect()] == ["hsa", "mmu", "mmu"]
    kept.unpersist()


def test_trim(spark):
    reads = spark.createDataFrame([("ACGTACGTAC" * 5, "I" * 50), ("ACG", "III")], "seq string, qual string")
    assert [len(r["seq"]) for r in sampling.trim(reads, 11, 25).collect()] == [25, 0]
    assert [len(r["qual"]) for r in sampling.trim(reads, 41, 25).collect()] == [10, 0]
    assert [r["seq"] for r in sampling.trim_to(reads, 2).collect()] == ["AC", "AC"]


def plain_alignment(read, references, most):
    found = {}
    for strand, seq in (("+", read), ("-", read[::-1].translate(str.maketrans("ACGT", "TGCA")))):
        for genome, chromosome, ref in references:
            for at in range(len(ref) - len(seq) + 1):
                n = sum(a != b for a, b in zip(seq, ref[at : at + len(seq)], strict=True))
                if n <= most:
                    best = (n, chromosome, at, strand)
                    found[genome] = min(found.get(genome, best), best)
    return found


def test_aligner_equals_plain_search(spark):
    import random

    r = random.Random(4)
    base = lambda n: "".join(r.choice("ACGT") for _ in range(n))
    references = [("g1", "c1", base(300)), ("g1", "c2", base(500)), ("g2", "c1", "ACGT" * 60), ("g3", "short", "ACG")]
    reads = []
    for n in range(40):
        genome, _, ref = r.choice(references[:3])
        at = r.randrange(len(ref) - 36)
        read = list(ref[at : at + 36])
        for _ in range(r.randrange(4)):
            read[r.randrange(36)] = r.choice("ACGT")
        text = "".join(read)
        reads.append(("s", f"r{n}", text if n % 2 else text[::-1].translate(str.maketrans("ACGT", "TGCA"))))
    reads += [("s", "long", base(40)), ("s", "none", "")]
    got = align.align_ungapped(spark.createDataFrame(reads, "id string, read string, seq string"), spark.createDataFrame(references, "genome string, chromosome string, seq string"), 2, 36)
    found = {(x["read"], x["genome"]): (x["mismatches"], x["chromosome"], x["position"], x["strand"]) for x in got.collect()}
    assert found == {(name, g): v for _, name, seq in reads if len(seq) == 36 for g, v in plain_alignment(seq, references, 2).items()}


def test_adapters(spark):
    adapter = "AGATCGGAAGAGCACACGTCTGAACTCCAGTCA"
    reads = [("s", "r1", "ACGTACGT" + adapter[:25] + "TTTT"), ("s", "r2", "T" * 50), ("s", "r3", "CC" + adapter[5:31][::-1].translate(str.maketrans("ACGT", "TGCA")))]
    found = align.match_adapters(spark.createDataFrame(reads, "id string, read string, seq string"), spark.createDataFrame([("a1", adapter), ("a2", "ACGT")], "name string, seq string"))
    rows = {r["read"]: r.asDict() for r in found.collect()}
    assert set(rows) == {"r1", "r3"}
    assert (rows["r1"]["start"], rows["r1"]["adapter start"], rows["r1"]["score"] >= 125, rows["r1"]["adapter strand"]) == (8, 0, True, "+")
    assert (rows["r3"]["adapter strand"], rows["r3"]["adapter start"], rows["r3"]["adapter end"], rows["r3"]["percent identity"]) == ("-", 31, 5, 100.0)
    assert align.exact_run(100, 20) == 20 and align.exact_run(100, 33) < 20


def test_best_segment_equals_plain_search():
    import random

    r = random.Random(6)
    for _ in range(60):
        read, adapter = ("".join(r.choice("ACGé") for _ in range(r.randrange(25))) for _ in range(2))
        found = [(0, 0, 0)]
        for x in range(len(read)):
            for y in range(len(adapter)):
                total = 0
                for n in range(min(len(read) - x, len(adapter) - y)):
                    total += align.MATCH if read[x + n] == adapter[y + n] else align.MISMATCH
                    found.append((total, -x, -y))
        best = max(found)
        got = align.best_segment(read, adapter)
        assert got[0] == best[0]
        same = sum(a == b for a, b in zip(read[got[1] : got[1] + got[3]], adapter[got[2] : got[2] + got[3]], strict=True))
        assert got[0] == align.MATCH * same + align.MISMATCH * (got[3] - same)


def test_config_limits():
    for bad in ({"sample_size": 999}, {"max_reads": 10}, {"chunk_size": 5}, {"trim_start": 0}, {"trim_length": 29}):
        with pytest.raises(ValueError):
            ScreenConfig(**bad)
    config = ScreenConfig(fastq_dir="/data/", trim_start=11)
    assert config.min_length == 46 and config.input_path("a.fq") == "/data/a.fq"
    with pytest.raises(ValueError):
        check_tool_limits([], size=1)
    with pytest.raises(ValueError):
        check_tool_limits(["a"], size=0)


def test_tables(spark, tmp_path):
    (tmp_path / "a.tsv").write_text("num\tid\tread\tgenome\tchromosome\tposition\tstrand\tsequence\tquality\tmismatches\n0\t1\tr\thsa\tc\t7\t+\tACG\t\"II\t1:A>C,2:C>G\n")
    row = tables.genome_alignments(spark, str(tmp_path / "a.tsv")).collect()[0]
    assert (row["position"], row["quality"], row["mismatches"], row["length"]) == (7, '"II', 2, 3)
    assert tables.index_names(["x/human.rev.1.ebwt", "y/big.rev.1.ebwtl", "z/human.1.ebwt"]) == ["big", "human"]
    df = spark.createDataFrame([(1.0, 12.5, True, None, 'a"b')], "a double, b double, c boolean, d string, e string")
    tables.write_table(df, str(tmp_path / "out"))
    text = next((tmp_path / "out").glob("part-*.csv")).read_text()
    assert text == 'a,b,c,d,e\n1,12.5,yes,,"a""b"\n'


def test_whole_run_of_files(spark, tmp_path):
    import random

    r = random.Random(9)
    base = lambda n: "".join(r.choice("ACGT") for _ in range(n))
    human, virus, adapter = base(3000), base(1000), "AGATCGGAAGAGCACACGTCTGAACTCCAGTCA"
    (tmp_path / "human.fa").write_text(f">chr1\n{human}\n")
    (tmp_path / "virus.fa").write_text(f">v\n{virus}\n")
    (tmp_path / "adapters.fa").write_text(f">a1\n{adapter}\n")
    (tmp_path / "genomes.csv").write_text("genome,species,synonyms\nhuman,Homo sapiens,man|woman\nvirus,Some virus,\n")
    (tmp_path / "sheet.csv").write_text("id,fastq,species,controls\nS1,s1.*.fq,Man,\n")
    parts = [("r%d" % n, (human if n < 60 else virus)[n * 10 : n * 10 + 40]) for n in range(80)] + [("bad", base(5) + adapter + "AC"), ("short", "ACGT")]
    for k in (0, 1):
        (tmp_path / f"s1.{k}.fq").write_text("".join(f"@{n}\n{s}\n+\n{'I' * len(s)}\n" for n, s in parts[k::2]))
    config = ScreenConfig(fastq_dir=str(tmp_path), output_dir=str(tmp_path / "out"), output_prefix="x.", sample_size=1000, max_reads=10_000)
    found = screen.run_files(spark, str(tmp_path / "sheet.csv"), str(tmp_path / "genomes.csv"), [f"{tmp_path}/human.fa", f"{tmp_path}/virus.fa"], f"{tmp_path}/adapters.fa", config)
    row = found.summary.collect()[0]
    assert (row["id"], row["sequences"], row["sampled"], row["genome aligned"], row["adapter"], row["unmapped"]) == ("S1", 82, 81, 60, 1, 1)
    counts = {r["genome"]: (r["assigned"], r["expected"]) for r in found.alignment_summary.collect()}
    assert counts == {"human": (60, "yes"), "virus": (20, "no"), "unmapped": (1, None)}
    found.write(config)
    assert (tmp_path / "out" / "x.summary.csv").is_dir()
    assert "<svg" in screen.chart(found)
    written = {p.name for p in (tmp_path / "out").iterdir()}
    assert written == {f"x.{n}" for n in ("summary.csv", "alignment_summary.csv", "genome_alignments.tsv", "adapter_alignments.tsv", "sampling_summary.csv", "samples.checked.csv", "genomes.checked.csv")}
    assert [tuple(r) for r in tables.sampling_summary(spark, str(tmp_path / "out" / "x.sampling_summary.csv")).collect()] == [("1", 82, 81)]


def test_stream_of_alignments(spark, tmp_path):
    from seqsieve.streaming.landing import assigned_stream

    (tmp_path / "in").mkdir()
    head = "id\tread\tgenome\tchromosome\tposition\tstrand\tsequence\tquality\tmismatches\n"
    (tmp_path / "in" / "1.tsv").write_text(head + "1\tr\thsa\tc\t7\t+\tACG\tIII\t\n1\tr\tmmu\tc\t7\t+\tACG\tIII\t\n")
    pairs = spark.createDataFrame([("1", "mmu")], "id string, genome string")
    seen = []
    assigned_stream(spark, str(tmp_path / "in"), pairs, pairs.limit(0), str(tmp_path / "state"), lambda df, n: seen.extend(df.select("read", "genome").collect())).awaitTermination()
    assert [tuple(r) for r in seen] == [("r", "mmu")]
    assert assign.genome_counts(hits(spark, ROWS)).count() == 2


def test_summaries_of_files(spark, tmp_path):
    (tmp_path / "samples.csv").write_text("id,user_id,species,controls,genomes,control_genomes\n2,B,,,,\n1,A,human,phix,hsa,phix\n")
    (tmp_path / "genomes.csv").write_text("genome,species\nmmu,Mus\nhsa,Homo sapiens\nphix,PhiX\n")
    (tmp_path / "sampled.csv").write_text("id,read,sampled\n1,10,4\n2,7,0\n3,1,1\n")
    lines = [f"0\t{s}\t{r}\t+\tc\t5\t{'A' * 36}\t{'I' * 36}\t{g}\t{','.join(['1:A>C'] * m)}" for s, r, g, m in ROWS]
    (tmp_path / "genome.tsv").write_text("num\tid\tread\tstrand\tchromosome\tposition\tsequence\tquality\tgenome\tmismatches\n" + "\n".join(lines) + "\n")
    (tmp_path / "adapter.tsv").write_text("\t".join(tables.ADAPTER_ALIGNMENTS) + "\n1\tr1\t0\t30\t+\ta1\t0\t30\t+\t99.5\t140\n")
    found = screen.summarise_files(spark, *(str(tmp_path / n) for n in ("samples.csv", "genomes.csv", "sampled.csv", "genome.tsv", "adapter.tsv")))
    assert [(r["id"], r["genome aligned"], r["adapter"], r["unmapped"]) for r in found.summary.collect()] == [("B", 0, 0, 0), ("A", 2, 1, 1)]
    assert [r["genome"] for r in found.alignment_summary.collect()] == ["mmu", "hsa", "phix", "unmapped", "mmu", "hsa", "phix", "unmapped"]
    tables.write_by_sample(found.adapter_alignments, found.summary.select("id"), str(tmp_path / "by"))
    assert sorted(p.name for p in (tmp_path / "by").glob("id=*")) == ["id=A", "id=B"]


def test_command_line_takes_reads_or_ready_alignments(tmp_path):
    from seqsieve import cli

    for args in ([], ["--sample-sheet", "a"], ["--checked-samples", "a", "--sample-sheet", "b"], ["--summary", "a"], ["--summary", "a", "--alignment-summary", "b", "--adapters", "c"]):
        with pytest.raises(SystemExit):
            cli.main(args)
    (tmp_path / "samples.csv").write_text("id,user_id,species,controls,genomes,control_genomes\n1,A,human,,hsa,\n")
    (tmp_path / "genomes.csv").write_text("genome,species\nhsa,Homo sapiens\n")
    (tmp_path / "sampled.csv").write_text("id,read,sampled\n1,10,4\n")
    (tmp_path / "genome.tsv").write_text("\t".join(tables.GENOME_ALIGNMENTS) + f"\n1\tr1\thsa\tc\t5\t+\t{'A' * 36}\t{'I' * 36}\t\n")
    (tmp_path / "adapter.tsv").write_text("\t".join(tables.ADAPTER_ALIGNMENTS) + "\n1\tr2\t0\t30\t+\ta1\t0\t30\t+\t99.5\t140\n")
    names = zip(cli.READY, ("samples.csv", "genomes.csv", "sampled.csv", "genome.tsv", "adapter.tsv"), strict=True)
    cli.main([x for k, n in names for x in ("--" + k.replace("_", "-"), str(tmp_path / n))] + ["--output-dir", str(tmp_path / "out")])
    assert "<svg" in (tmp_path / "out" / "chart.svg").read_text()
    assert (tmp_path / "out" / "summary.csv").is_dir() and not (tmp_path / "out" / "samples.checked.csv").exists()
    cli.main(["--summary", f"{tmp_path}/out/summary.csv", "--alignment-summary", f"{tmp_path}/out/alignment_summary.csv", "--output-dir", str(tmp_path / "again")])
    for name in ("chart.svg", "chart.pdf"):
        assert (tmp_path / "again" / name).read_bytes() == (tmp_path / "out" / name).read_bytes()


def test_pdf_is_well_formed(spark):
    import re

    fields = "user_id string, type string, scaled_count double, category string, bounded_error_rate double, reference string, group int"
    rows = [("A (1\\\n)é漢", "genome", 3.0, "control", 0.25, "x", 1), ("A (1\\\n)é漢", "genome", 1.0, "unmapped", 1.5, "y", 2), ("B", "adapter", None, "adapter", None, "adapter", 3)]
    for some in (rows, []):
        drawn = bar_chart_pdf(spark.createDataFrame(some, fields))
        start = int(re.search(rb"startxref\n(\d+)\n%%EOF\n$", drawn)[1])
        assert drawn[start:].startswith(b"xref\n0 6\n")
        places = [int(x) for x in re.findall(rb"(\d{10}) 00000 n \n", drawn)]
        assert [drawn[p:].split(b"\n", 1)[0] for p in places] == [b"%d 0 obj" % n for n in range(1, 6)]
        length, stream = re.search(rb"/Length (\d+) >>\nstream\n(.*)\nendstream", drawn, re.S).groups()
        assert int(length) == len(stream)
        assert stream.count(b" re B") == len(some) + 5
    drawn = bar_chart_pdf(spark.createDataFrame(rows, fields))
    assert b"(A \\(1\\\\ \\)\xe9?) Tj" in drawn


def test_chunks(spark, tmp_path):
    from seqsieve.sources import fastq

    rows = [(s, n, f"{s}{n}", None, f"ACGT{'ACGT'[n % 4] * n}", f"IIII{'#' * n}") for s in "ab" for n in range(17)]
    reads = spark.createDataFrame(rows, "sample string, ordinal long, id string, desc string, seq string, qual string").repartition(5)
    written = fastq.write_chunks(sampling.chunk_numbers(reads, 8), str(tmp_path), 3, 4)
    assert written == [(1, 8), (2, 8), (3, 8), (4, 8), (5, 2)]
    assert {p.name for p in tmp_path.iterdir()} == {f"chunk.{n}.{e}" for n in range(1, 6) for e in ("fq", "fa")}
    for n in range(5):
        here = rows[8 * n : 8 * n + 8]
        assert (tmp_path / f"chunk.{n + 1}.fq").read_text() == "".join(f"@{r[2]}\n{r[4][2:6]}\n+\n{r[5][2:6]}\n" for r in here)
        assert (tmp_path / f"chunk.{n + 1}.fa").read_text() == "".join(f">{r[2]}\n{r[4]}\n" for r in here)
    assert fastq.write_chunks(sampling.chunk_numbers(reads.limit(0), 8), str(tmp_path / "none")) == []
    assert fastq.write_chunks(sampling.chunk_numbers(reads, 100), str(tmp_path / "one"), fasta=False, compress=True) == [(1, 34)]


def test_order_of_a_run_is_that_of_the_files(spark, tmp_path):
    """Twelve samples, and genomes in no alphabetical order."""
    bases = {"zebra": "ACGTTGCA" * 20, "apple": "GGATCCTA" * 20, "mango": "TTTACACG" * 20}
    for name, seq in bases.items():
        (tmp_path / f"{name}.fa").write_text(f">c\n{seq}\n")
    (tmp_path / "adapters.fa").write_text(">a\nAGATCGGAAGAGCACACGTC\n")
    (tmp_path / "genomes.csv").write_text("genome,species,synonyms\nzebra,z,\nmango,m,\napple,a,\n")
    (tmp_path / "sheet.csv").write_text("id,fastq,species,controls\n" + "".join(f"u{n},{n}.fq,,\n" for n in range(1, 13)))
    for n in range(1, 13):
        (tmp_path / f"{n}.fq").write_text(f"@r\n{'C' * 40}\n+\n{'I' * 40}\n")
    config = ScreenConfig(fastq_dir=str(tmp_path), output_dir=str(tmp_path / "out"))
    found = screen.run_files(spark, f"{tmp_path}/sheet.csv", f"{tmp_path}/genomes.csv", [f"{tmp_path}/{g}.fa" for g in sorted(bases)], f"{tmp_path}/adapters.fa", config)
    assert [r["id"] for r in found.summary.collect()] == [f"u{n}" for n in range(1, 13)]
    assert [(r["id"], r["genome"]) for r in found.alignment_summary.collect()] == [(f"u{n}", g) for n in range(1, 13) for g in ("zebra", "mango", "apple", "unmapped")]
    screen.write_checked(found.resolved, config)
    assert next((tmp_path / "out" / "genomes.checked.csv").glob("part-*")).read_text() == "genome,species\nzebra,z\nmango,m\napple,a\n"
