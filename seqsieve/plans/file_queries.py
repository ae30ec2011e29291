"""Sources and sinks on the driver's tables: each query writes rows to the shared folder in one of the screen's formats,
reads them back, and has SQL over the tables that gives the rows without any file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import ScreenConfig
from ..operators import align, resolve, sampling
from ..operators.chart import plot_data
from ..sources import fastq, fastq_index, genomes, tables
from ..sources.store import Store, shared_folder, written
from . import queries as core
from . import screen
from .queries import ADAPTED, ALIGNMENT_SUMMARY, ALIGNMENTS, META, PLOT, READS, SAMPLE_SUMMARY, query

#: Characters of texts that a sequence can't hold, and what stands for each.
FORBIDDEN, INSTEAD = " \t\n\r>+@", "_______"
#: The same in SQL.
SEQ = "translate(text, ' ' || chr(9) || chr(10) || chr(13) || '>+@', '_______')"


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as records: the language is the description, and a third has none."""
    docs = core._table(spark, sf_dir, "documents")
    seq = F.translate("text", FORBIDDEN, INSTEAD)
    desc = F.when(F.col("doc_id") % 3 > 0, F.concat("lang", F.lit(" of "), "source"))
    return docs.select(F.col("doc_id").cast("string").alias("id"), desc.alias("desc"), seq.alias("seq"), seq.alias("qual"), "source", "doc_id")


RECORDS = f"SELECT doc_id::VARCHAR AS id, CASE WHEN doc_id % 3 > 0 THEN lang || ' of ' || source END AS \"desc\", {SEQ} AS seq"

# records


@query(f'SELECT id, "desc", seq, seq AS qual FROM ({RECORDS} FROM documents)')
def fastq_round_trip(spark, sf_dir):
    """The FASTQ data source's writer, gzip, and its reader over a pattern of files."""
    fastq.register(spark)
    folder = shared_folder(spark, "fastq")
    rows = _records(spark, sf_dir).select("id", "desc", "seq", "qual")
    rows.write.format("fastq").option("gzip", "true").mode("append").save(folder)
    return spark.read.format("fastq").option("paths", f"{folder}/chunk.*.fq.gz").load().select("id", "desc", "seq", "qual")


@query(f'SELECT id AS name, "desc", seq FROM ({RECORDS} FROM documents)')
def fasta_round_trip(spark, sf_dir):
    """FASTA text in lines of 80 letters, and its reader."""
    fastq.register(spark)
    folder = shared_folder(spark, "fasta")
    fastq.write_text(_records(spark, sf_dir), fastq.fasta_text(F.col("id"), F.col("desc"), F.col("seq")), folder, True)
    return spark.read.format("fasta").option("paths", f"{folder}/part-*.gz").load().select("name", "desc", "seq")


@query(f"WITH {READS} SELECT sample, ordinal, id::VARCHAR AS id, {SEQ.replace('text', 'seq')} AS seq FROM reads")
def sample_files(spark, sf_dir):
    """Files of each sample, found by a pattern below a folder and read as one stream of records."""
    folder = shared_folder(spark, "samples")
    rows = _records(spark, sf_dir)
    names = ("id", "desc", "seq", "seq")
    text = rows.select("source", "doc_id", fastq.fastq_text(*(F.col(c) for c in names)).alias("value"))
    text.repartition("source").sortWithinPartitions("source", "doc_id").select("source", "value").write.partitionBy("source").option("maxRecordsPerFile", 500).text(folder)
    config = ScreenConfig(fastq_dir=folder + "/")
    listed = [r["source"] for r in rows.select("source").distinct().orderBy("source").collect()]  # the sheet's samples
    return fastq.read_samples(spark, [(s, [config.input_path(f"source={s}/part-*.txt")]) for s in listed]).select("sample", "ordinal", "id", "seq")


@query(f"WITH {READS} SELECT sample, ordinal, id::VARCHAR AS id FROM reads WHERE ordinal < 60 AND length(seq) >= 300")
def capped_files(spark, sf_dir):
    """The first 60 records of each sample, of which the long ones are wanted; no file is read further."""
    folder = shared_folder(spark, "capped")
    rows = _records(spark, sf_dir)
    text = rows.select("source", "doc_id", fastq.fastq_text(*(F.col(c) for c in ("id", "desc", "seq", "seq"))).alias("value"))
    text.repartition("source").sortWithinPartitions("source", "doc_id").select("source", "value").write.partitionBy("source").option("maxRecordsPerFile", 50).text(folder)
    listed = [r["source"] for r in rows.select("source").distinct().orderBy("source").collect()]
    reads = fastq.read_samples(spark, [(s, [f"{folder}/source={s}/part-*.txt"]) for s in listed], 60)
    return sampling.long_enough(reads, 300).select("sample", "ordinal", "id")


@query(f"""WITH {READS}, r AS (SELECT *, {SEQ.replace("text", "seq")} AS s, row_number() OVER (ORDER BY sample, ordinal) - 1 AS place FROM reads),
kinds AS (SELECT 'fq' AS kind UNION ALL SELECT 'fa')
SELECT place // 400 + 1 AS chunk, kind, place % 400 AS place, id::VARCHAR AS id, CASE WHEN kind = 'fq' THEN substring(s, 11, 36) ELSE s END AS seq FROM r, kinds""")
def chunk_files(spark, sf_dir):
    """Pairs of files of 400 records each over all samples, read back: trimmed FASTQ, and FASTA of whole texts."""
    fastq.register(spark)
    folder = shared_folder(spark, "chunks")
    rows = core.reads(spark, sf_dir).select("sample", "ordinal", F.col("id").cast("string").alias("id"), F.lit(None).cast("string").alias("desc"), F.translate("seq", FORBIDDEN, INSTEAD).alias("seq"))
    fastq.write_chunks(sampling.chunk_numbers(rows, 400).withColumn("qual", F.col("seq")), folder, 11, 36, compress=True)
    chunk = F.regexp_extract("file", "chunk\\.(\\d+)\\.", 1).cast("long").alias("chunk")
    pairs = spark.read.format("fastq").option("paths", f"{folder}/chunk.*.fq.gz").load(), spark.read.format("fasta").option("paths", f"{folder}/chunk.*.fa.gz").load().withColumnRenamed("name", "id")
    found = [df.select(chunk, F.lit(kind).alias("kind"), F.col("record").alias("place"), "id", "seq") for df, kind in zip(pairs, ("fq", "fa"), strict=True)]
    return found[0].unionByName(found[1])


def _sorted_files(spark: SparkSession, sf_dir: str, folder: str, records: DataFrame) -> list[str]:
    """A file for each source with its records (source, doc_id, value) in order; the sources."""
    records.repartition("source").sortWithinPartitions("source", "doc_id").select("source", "value").write.partitionBy("source").text(folder)
    return [r["source"] for r in records.select("source").distinct().orderBy("source").collect()]


def _split(files: list[str]) -> int:
    """Bytes of a range: all files are some dozens of ranges, or as many more as it takes to bound a range."""
    return min(genomes.SPLIT, max(1 << 14, sum(Store(f).stamp(f)[0] for f in files) // 64))


@query(f"WITH {READS} SELECT sample, ordinal, id::VARCHAR AS id, {SEQ.replace('text', 'seq')} AS seq, {SEQ.replace('text', 'seq')} AS qual FROM reads")
def split_files(spark, sf_dir):
    """A plain file for each sample, each read in ranges by many tasks, with the numbers of its records."""
    folder = shared_folder(spark, "split")
    rows = _records(spark, sf_dir)
    listed = _sorted_files(spark, sf_dir, folder, rows.select("source", "doc_id", fastq.fastq_text(*(F.col(c) for c in ("id", "desc", "seq", "qual"))).alias("value")))
    files = fastq.expand([f"{folder}/source=*/part-*.txt"])
    return fastq.read_samples(spark, [(s, [f"{folder}/source={s}/part-*.txt"]) for s in listed], index=f"{folder}-index", split=_split(files)).select("sample", "ordinal", "id", "seq", "qual")


@query(f"""WITH r AS (SELECT source, doc_id, {SEQ} AS seq, CASE doc_id % 9 WHEN 0 THEN 'a record must begin with @' WHEN 3 THEN 'no id' WHEN 6 THEN 'space in the sequence' END AS problem FROM documents),
n AS (SELECT *, lag(problem) OVER o IS NULL AS starts FROM r WINDOW o AS (PARTITION BY source ORDER BY doc_id)),
i AS (SELECT *, sum(starts::INT) OVER (PARTITION BY source ORDER BY doc_id) AS island FROM n WHERE problem IS NOT NULL)
SELECT source, doc_id::VARCHAR AS id, seq, NULL AS problem, NULL AS bad FROM r WHERE problem IS NULL
UNION ALL SELECT source, NULL, NULL, arg_min(problem, doc_id), string_agg(CASE problem WHEN 'no id' THEN '@' WHEN 'space in the sequence' THEN '@' || doc_id ELSE '#' || doc_id END || chr(10)
  || CASE problem WHEN 'space in the sequence' THEN ' ' ELSE '' END || seq || chr(10) || '+' || chr(10) || seq || chr(10), '' ORDER BY doc_id) FROM i GROUP BY source, island""")
def damaged_files(spark, sf_dir):
    """Files of which a third of the records break a rule: these come with the reason and their text, the others as ever."""
    fastq.register(spark)
    folder = shared_folder(spark, "damaged")
    kind, id_ = F.col("doc_id") % 9, F.col("id")
    head = F.when(kind == 3, "@").when(kind == 0, F.concat(F.lit("#"), id_)).otherwise(F.concat(F.lit("@"), id_))
    seq = F.when(kind == 6, F.concat(F.lit(" "), "seq")).otherwise(F.col("seq"))
    _sorted_files(spark, sf_dir, folder, _records(spark, sf_dir).select("source", "doc_id", F.concat_ws("\n", head, seq, F.lit("+"), "qual").alias("value")))
    files = fastq.expand([f"{folder}/source=*/part-*.txt"])
    fastq_index.ensure(spark, files, f"{folder}-index", _split(files))
    rows = spark.read.format("fastq").option("paths", ",".join(files)).option("mode", "PERMISSIVE").option("index", f"{folder}-index").load()
    return rows.select(F.regexp_extract("file", "source=([^/]*)/", 1).alias("source"), "id", "seq", "problem", "bad")


def _fasta_files(spark: SparkSession, sf_dir: str) -> tuple[str, dict[str, list[str]]]:
    """Documents of each language as FASTA files, in lines of 80 letters: the folder, and patterns by language. A language
    has as many files as ranges of documents, so that no task gets a whole language."""
    folder = shared_folder(spark, "genomes")
    docs = core._table(spark, sf_dir, "documents").select("lang", "doc_id", "text")
    rows = docs.repartitionByRange("lang", "doc_id")
    value = fastq.fasta_text(F.col("doc_id").cast("string"), F.lit("a text"), F.translate("text", FORBIDDEN, INSTEAD)).alias("value")
    rows.select("lang", value).write.partitionBy("lang").text(f"{folder}/fasta")
    listed = [r["lang"] for r in docs.select("lang").distinct().orderBy("lang").collect()]
    return folder, {x: [f"{folder}/fasta/lang={x}/part-*.txt"] for x in listed}


@query(f"SELECT doc_id::VARCHAR AS chromosome, length(text) AS letters, md5({SEQ}) AS whole FROM documents WHERE text <> ''")
def fasta_pieces(spark, sf_dir):
    """FASTA files read in ranges of bytes and in pieces that go on into the next one; put together, they are the texts."""
    _, files = _fasta_files(spark, sf_dir)
    patterns = [p for ps in files.values() for p in ps]
    pieces = genomes.read_pieces(spark, patterns, 1000, 40, _split(fastq.expand(patterns)))
    own = F.array_sort(F.collect_list(F.struct("start", F.left("text", F.col("own").cast("int")).alias("text"))))
    whole = F.array_join(F.transform(own, lambda x: x["text"]), "")
    return pieces.groupBy("chromosome").agg(F.sum("own").alias("letters"), F.md5(whole.cast("binary")).alias("whole"))


@query(core.UNGAPPED.replace("FROM benchmark WHERE", f"FROM (SELECT item_id, {SEQ} AS text FROM benchmark) WHERE").replace("FROM documents WHERE", f"FROM (SELECT lang, doc_id::VARCHAR AS doc_id, {SEQ} AS text FROM documents) WHERE"))
def stored_alignment(spark, sf_dir):
    """The aligner on genomes that were stored before, each for itself, and found by listing."""
    folder, files = _fasta_files(spark, sf_dir)
    for name, patterns in files.items():  # a genome at a time, as they come
        genomes.store_genome(spark, name, patterns, f"{folder}/stored")
    if genomes.stored_names(f"{folder}/stored") != sorted(files):
        raise ValueError("stored genomes are not found")
    reads = core.benchmark_reads(spark, sf_dir, F.translate("text", FORBIDDEN, INSTEAD))
    return align.align_ungapped(reads, genomes.stored_pieces(spark, f"{folder}/stored"), 2, 36)


# tables


def _alignment_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = core._table(spark, sf_dir, "lineitem")
    described = F.when(F.col("l_linenumber") > 1, F.concat(F.repeat(F.lit("3:A>C,"), F.col("l_linenumber") - 2), F.lit("9:G>T")))
    return rows.select(
        F.lit(0).alias("num"),
        F.col("l_returnflag").alias("id"),
        F.col("l_orderkey").cast("string").alias("read"),
        F.concat(F.lit("g"), F.col("l_suppkey") % 10).alias("genome"),
        F.lpad(F.col("l_partkey").cast("string"), 9, "0").alias("chromosome"),
        F.col("l_suppkey").cast("long").alias("position"),
        F.lit("+").alias("strand"),
        F.lit("ACGT" * 9).alias("sequence"),
        F.lit("\"I'," * 9).alias("quality"),
        described.alias("mismatches"),
    )


@query("""SELECT l_returnflag AS id, l_orderkey::VARCHAR AS read, 'g' || (l_suppkey % 10) AS genome, lpad(l_partkey::VARCHAR, 9, '0') AS chromosome, l_suppkey AS position, '+' AS strand,
  repeat('ACGT', 9) AS sequence, repeat('"I'',', 9) AS quality, (l_linenumber - 1)::INT AS mismatches, 36 AS length FROM lineitem""")
def genome_alignment_files(spark, sf_dir):
    """Alignments as tab-separated, zipped files; qualities hold quotes and commas."""
    path = shared_folder(spark, "alignments")
    tables.write_table(_alignment_rows(spark, sf_dir), path, "\t", True, False)
    return tables.genome_alignments(spark, path)


@query(f"SELECT * REPLACE (read::VARCHAR AS read) FROM ({ADAPTED})")
def adapter_alignment_files(spark, sf_dir):
    path = shared_folder(spark, "adapters")
    tables.write_table(core.adapter_matches_native(spark, sf_dir), path, "\t", True, False)
    return tables.adapter_alignments(spark, path)


@query(f"SELECT * REPLACE (read::VARCHAR AS read) FROM ({ADAPTED})")
def files_by_sample(spark, sf_dir):
    """A file for each sample, and one more sample that has no rows."""
    path = shared_folder(spark, "by-sample")
    rows = core.adapter_matches_native(spark, sf_dir)
    samples = rows.select("id").distinct().unionByName(spark.createDataFrame([("NOBODY",)], "id string"))
    tables.write_by_sample(rows, samples, path)
    if not Store(path).find(f"{path}/id=NOBODY/part-*.gz"):
        raise ValueError("no file for a sample without rows")
    return tables.read_by_sample(spark, path, {c: t for c, t in tables.ADAPTER_ALIGNMENTS.items() if c != "id"} | {"id": "string"}).select(*tables.ADAPTER_ALIGNMENTS)


@query("""SELECT (row_number() OVER (ORDER BY s_suppkey))::INT AS id, s_name AS user_id, 'a.fq|b.' || s_suppkey || '.fq' AS fastq, 'with, comma "' || s_nationkey || '"' AS species,
  CASE WHEN s_suppkey % 2 = 0 THEN 'phix' END AS controls FROM supplier""")
def sample_sheet_file(spark, sf_dir):
    """A comma-separated sheet with missing values, commas and quotes, read and numbered in its order."""
    path = shared_folder(spark, "sheet")
    rows = core._table(spark, sf_dir, "supplier")
    species = F.concat(F.lit('with, comma "'), "s_nationkey", F.lit('"'))
    controls = F.when(F.col("s_suppkey") % 2 == 0, "phix").when(F.col("s_suppkey") % 4 == 1, "NA")
    fastq_names = F.concat(F.lit("a.fq|b."), "s_suppkey", F.lit(".fq"))
    rows = rows.orderBy("s_suppkey").select(species.alias("species"), F.col("s_name").alias("id"), F.lit("more").alias("more"), controls.alias("controls"), fastq_names.alias("fastq"))
    tables.write_table(rows, path)
    return resolve.add_ids(tables.read_metadata(spark, path, ["id", "fastq", "species", "controls"]))


@query(f"WITH {META} SELECT genome, species, synonyms FROM details")
def genome_details_file(spark, sf_dir):
    path = shared_folder(spark, "details")
    tables.write_table(core.details(spark, sf_dir), path)
    return tables.read_metadata(spark, path, ["genome", "species", "synonyms"])


@query(core.SQL["sampling_summary"])
def sampling_summary_file(spark, sf_dir):
    path = shared_folder(spark, "sampled")
    tables.write_table(core.sampling_summary(spark, sf_dir), path)
    return tables.sampling_summary(spark, path)


@query("SELECT n_name AS id FROM nation")
def index_files(spark, sf_dir):
    """Names of indexes from a folder with several files of each index."""
    folder = shared_folder(spark, "indexes")
    for row in core._table(spark, sf_dir, "nation").collect():  # a name for each genome
        for ending in (".1.ebwt", ".rev.1.ebwt" + "l" * (row["n_nationkey"] % 2), ".rev.2.ebwt"):
            Store(folder).create(f"{folder}/{row['n_name']}{ending}").close()
    return tables.index_table(spark, [f"{folder}/*"])


@query(f"WITH {META} SELECT genome, species FROM joined WHERE has_index")
def checked_genomes_file(spark, sf_dir):
    """The checked genomes, of which a reader takes only the columns it asks for."""
    path = shared_folder(spark, "genomes")
    joined = core.index_full_join(spark, sf_dir)
    tables.write_table(joined.filter("has_index").select("genome", "species", F.lit("x").alias("more")), path)
    return tables.read_metadata(spark, path, ["genome", "species"])


def _run_files(spark: SparkSession, sf_dir: str):
    """The whole relational core on written files: samples, genomes, sampling summary and alignments."""
    folder = shared_folder(spark, "run")
    samples = core.samples(spark, sf_dir)
    tables.write_table(samples.orderBy("ordinal").select(*tables.CHECKED_SAMPLES), f"{folder}/samples")
    tables.write_table(core.genomes(spark).orderBy("ordinal").select("genome", "species"), f"{folder}/genomes")
    tables.write_table(samples.select("id", F.col("sequences").alias("read"), "sampled"), f"{folder}/sampled")
    tables.write_table(_alignment_rows(spark, sf_dir), f"{folder}/genome", "\t", True, False)
    rows = core.adapter_matches(spark, sf_dir)
    empty = [F.lit(None).cast(t).alias(c) for c, t in tables.ADAPTER_ALIGNMENTS.items() if c not in ("id", "read")]
    tables.write_table(rows.select("id", "read", *empty).select(*tables.ADAPTER_ALIGNMENTS), f"{folder}/adapter", "\t", True, False)
    return screen.summarise_files(spark, *(f"{folder}/{n}" for n in ("samples", "genomes", "sampled", "genome", "adapter")))


@query(SAMPLE_SUMMARY)
def run_of_files(spark, sf_dir):
    return _run_files(spark, sf_dir).summary


@query(f"WITH {ALIGNMENTS} SELECT user_id AS id, read::VARCHAR AS read, genome, lpad(chromosome::VARCHAR, 9, '0') AS chromosome, position, strand, repeat('ACGT', 9) AS sequence, repeat('\"I'',', 9) AS quality, mismatches::VARCHAR AS mismatches, CASE WHEN expected THEN 'yes' ELSE 'no' END AS expected, CASE WHEN control THEN 'yes' ELSE 'no' END AS control, CASE WHEN assigned THEN 'yes' ELSE 'no' END AS assigned FROM chosen JOIN samples USING (id)")
def written_alignments(spark, sf_dir):
    """The final table of genome alignments as it is written."""
    path = shared_folder(spark, "chosen")
    screen.write_alignments(_run_files(spark, sf_dir).genome_alignments, path)
    names = ["id", "read", "genome", "chromosome", "position", "strand", "sequence", "quality", "mismatches", "expected", "control", "assigned"]
    return tables.read_tsv(spark, path, dict.fromkeys(names, "string") | {"position": "long"})


@query(ALIGNMENT_SUMMARY)
def alignment_summary_file(spark, sf_dir):
    path = shared_folder(spark, "alignment-summary")
    tables.write_table(_run_files(spark, sf_dir).alignment_summary, path)
    return tables.alignment_summary(spark, path)


ORDERED = """WITH s AS (SELECT row_number() OVER (ORDER BY s_suppkey % 10, s_suppkey DESC) AS ordinal, s_suppkey, s_name FROM supplier),
g AS (SELECT n_name, n_nationkey, row_number() OVER (ORDER BY n_nationkey % 3, n_nationkey DESC) AS ordinal FROM nation),
c AS (SELECT l_suppkey AS s_suppkey, l_partkey % 25 AS n_nationkey, count(*) AS n FROM (SELECT DISTINCT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem) GROUP BY ALL),
rows AS (SELECT s.ordinal, s_name AS id, n_name AS genome, coalesce(n, 0) AS assigned, g.ordinal AS place FROM s CROSS JOIN g LEFT JOIN c USING (s_suppkey, n_nationkey)
  UNION ALL SELECT ordinal, s_name, 'unmapped', 10, NULL FROM s)
SELECT row_number() OVER (ORDER BY ordinal, place IS NULL, assigned DESC, place) - 1 AS row, id, genome, assigned FROM rows"""


@query(ORDERED)
def row_order(spark, sf_dir):
    """Rows of the alignment summary and their places, for all suppliers as samples and nations as genomes in orders that
    are not alphabetical: sheet and details give the order."""
    folder = shared_folder(spark, "order")
    supplier, nation = core._table(spark, sf_dir, "supplier"), core._table(spark, sf_dir, "nation")
    none = F.lit(None).cast("string")
    tables.write_table(supplier.orderBy(F.col("s_suppkey") % 10, F.desc("s_suppkey")).select(F.col("s_name").alias("id"), F.lit("a.fq").alias("fastq"), none.alias("species"), none.alias("controls")), f"{folder}/sheet")
    tables.write_table(nation.orderBy(F.col("n_nationkey") % 3, F.desc("n_nationkey")).select(F.col("n_name").alias("genome"), none.alias("species"), none.alias("synonyms")), f"{folder}/details")
    sheet = screen.with_ordinal(resolve.add_ids(tables.read_metadata(spark, f"{folder}/sheet", ["id", "fastq", "species", "controls"])))
    details = resolve.in_order(tables.read_metadata(spark, f"{folder}/details", ["genome", "species", "synonyms"]))
    screen.write_checked(resolve.resolve(sheet, details, nation.select(F.col("n_name").alias("id"))), ScreenConfig(output_dir=folder))
    samples, genomes = (resolve.in_order(tables.read_metadata(spark, f"{folder}/{n}.checked.csv", c)) for n, c in (("samples", tables.CHECKED_SAMPLES), ("genomes", ["genome", "species"])))
    keys = supplier.select("s_suppkey", F.col("s_name").alias("user_id")).join(sheet.select("id", "user_id"), "user_id").select("id", F.col("s_suppkey").alias("l_suppkey"))
    rows = core._table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").distinct()
    rows = written(rows, "rows")  # two uses
    rows = rows.join(keys, "l_suppkey").join(nation.withColumnRenamed("n_name", "genome"), F.col("l_partkey") % 25 == F.col("n_nationkey"))
    texts = {c: F.lit("") for c in ("chromosome", "strand", "sequence", "quality")}
    found = rows.select("id", F.concat_ws("|", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("read"), "genome", F.lit(0).alias("position"), F.lit(0).alias("mismatches"), F.lit(36).alias("length")).withColumns(texts)
    counts = sheet.select("id").join(found.groupBy("id").agg(F.count("*").alias("n")), "id", "left").select("id", (F.coalesce("n", F.lit(0)) + 10).alias("read"))
    result = screen.summarise(samples, genomes, counts.withColumn("sampled", F.col("read")), found, found.select("id", "read").limit(0))
    return sampling.with_place(result.alignment_summary.select("id", "genome", "assigned"), [], "row").select("row", "id", "genome", "assigned")


@query(PLOT)
def chart_of_files(spark, sf_dir):
    """Chart data from the two summaries as they were written."""
    folder = shared_folder(spark, "chart")
    result = _run_files(spark, sf_dir)
    tables.write_table(result.summary, f"{folder}/summary")
    tables.write_table(result.alignment_summary, f"{folder}/alignment_summary")
    return plot_data(tables.alignment_summary(spark, f"{folder}/alignment_summary", "place"), tables.summary(spark, f"{folder}/summary"))
