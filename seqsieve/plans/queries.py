"""The screen's operators on the driver's tables, each with the SQL that gives the same rows.

The tables hold no sequencing reads, so columns stand for them: rows of lineitem are alignments (return flag: sample,
order: read, supplier modulo 10: genome), texts of documents are reads, nations are genomes and suppliers samples."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import mismatch_count, yes_no
from ..functions import mismatch_places as places_of
from ..operators import align, assign, checks, resolve, sampling, summarize
from ..sources.fastq import fasta_text, fastq_text
from ..sources.store import written
from ..sources.tables import printable, split_first_bar
from .screen import TIES, summarise

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str):
    """Registers a query under its function's name, with its SQL."""

    def put(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return put


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sql_round(x: str, digits: int) -> str:
    p = f"{10**digits}::DOUBLE"
    low, high = f"(floor(({x}) * {p}) / {p})", f"(ceil(({x}) * {p}) / {p})"
    even = f"floor(({x}) * {p})::BIGINT % 2 = 0"
    return f"(CASE WHEN ({x}) - {low} < {high} - ({x}) OR (({x}) - {low} = {high} - ({x}) AND {even}) THEN {low} ELSE {high} END)"


def sql_share(count: str, total: str) -> str:
    return f"CASE WHEN {total} = 0 THEN 0::DOUBLE ELSE {sql_round(f'100::DOUBLE * {count} / {total}', 1)} END"


SQL_RATE = sql_round("100::DOUBLE * sum(mismatches) / sum(length)", 2)

# alignments


def alignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("id"),
        F.col("l_orderkey").alias("read"),
        F.concat(F.lit("g"), F.col("l_suppkey") % 10).alias("genome"),
        F.col("l_partkey").alias("chromosome"),
        F.col("l_suppkey").alias("position"),
        F.lit("+").alias("strand"),
        (F.col("l_linenumber") - 1).alias("mismatches"),
        F.lit(36).alias("length"),
        (F.col("l_suppkey") % 10).cast("int").alias("genome_ordinal"),
    )


def bridge(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    ids = written(samples(spark, sf_dir).select("id"), "ids")  # as small as metadata, which Spark can't tell else
    return tuple(ids.withColumn("genome", F.explode(F.array(*map(F.lit, names)))) for names in (["g1", "g2"], ["g0"]))


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reads are counted where all alignments of a read are: a task that meets a read anywhere in the table would have to
    hold all reads of its part of it."""
    lines = _table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("id"), F.col("l_orderkey").alias("read"))
    reads = assign.dealt(lines).groupBy("id", "read").agg(F.count("*").alias("lines"))
    rows = reads.groupBy("id").agg((F.sum("lines") + 1000).alias("sequences"), (F.count("read") + 500).alias("sampled"))
    texts = {"species": "human|mouse", "controls": "phix", "genomes": "g1|g2", "control_genomes": "g0"}
    rows = rows.withColumns({c: F.lit(t) for c, t in texts.items()}).withColumn("user_id", F.concat(F.lit("sample "), "id"))
    return rows.withColumn("ordinal", F.ascii("id"))


def genomes(spark: SparkSession) -> DataFrame:
    return spark.range(10).select(F.concat(F.lit("g"), "id").alias("genome"), F.col("id").cast("int").alias("ordinal"), F.concat(F.lit("species "), "id").alias("species"))


def noted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign.annotate(alignments(spark, sf_dir), *bridge(spark, sf_dir))


def chosen(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign.choose(assign.annotate(assign.dealt(alignments(spark, sf_dir)), *bridge(spark, sf_dir)), TIES)


ALIGNMENTS = """
al AS (SELECT l_returnflag AS id, l_orderkey AS read, 'g' || (l_suppkey % 10) AS genome, l_partkey AS chromosome, l_suppkey AS position, '+' AS strand,
  l_linenumber - 1 AS mismatches, 36 AS length, (l_suppkey % 10)::INT AS genome_ordinal, l_suppkey % 10 IN (0, 1, 2) AS expected, l_suppkey % 10 = 0 AS control FROM lineitem),
samples AS (SELECT l_returnflag AS id, 'sample ' || l_returnflag AS user_id, ascii(l_returnflag) AS ordinal, count(*) + 1000 AS sequences, count(DISTINCT l_orderkey) + 500 AS sampled FROM lineitem GROUP BY l_returnflag),
genomes AS (SELECT 'g' || range AS genome, range::INT AS ordinal, 'species ' || range AS species FROM range(10)),
best AS (SELECT * EXCLUDE (fewest) FROM (SELECT *, min(mismatches) OVER (PARTITION BY id, read) AS fewest FROM al) WHERE mismatches = fewest),
counted AS (SELECT *, count(*) OVER (PARTITION BY id, genome) AS genome_count FROM best),
chosen AS (SELECT * EXCLUDE (genome_count), row_number() OVER (PARTITION BY id, read ORDER BY expected DESC, genome_count DESC, genome_ordinal, chromosome, position, strand) = 1 AS assigned FROM counted)"""


def _by_genome_sql(name: str, source: str) -> str:
    sums = f"SELECT id, genome, count(*) AS count, {SQL_RATE} AS error_rate FROM {source} GROUP BY id, genome"
    return f"""{name} AS (SELECT s.id, g.genome, coalesce(a.count, 0) AS count, {sql_share("coalesce(a.count, 0)", "s.sampled")} AS percentage, a.error_rate
  FROM samples s CROSS JOIN genomes g LEFT JOIN ({sums}) a ON a.id = s.id AND a.genome = g.genome)"""


def _by_read_sql(name: str, condition: str) -> str:
    reads = f"SELECT id, read, min(mismatches) AS mismatches, max(length) AS length FROM al WHERE {condition} GROUP BY id, read"
    sums = f"SELECT id, count(*) AS count, {SQL_RATE} AS error_rate FROM ({reads}) GROUP BY id"
    return f"""{name} AS (SELECT s.id, coalesce(a.count, 0) AS count, {sql_share("coalesce(a.count, 0)", "s.sampled")} AS percentage, a.error_rate FROM samples s LEFT JOIN ({sums}) a ON a.id = s.id)"""


ALIGNED, ASSIGNED = _by_genome_sql("aligned", "al"), _by_genome_sql("assigned", "(SELECT * FROM chosen WHERE assigned)")
EXPECTED, CONTROL = _by_read_sql("expected_reads", "expected AND NOT control"), _by_read_sql("control_reads", "control")
UNMAPPED = f"""unmapped AS (SELECT s.id, s.sampled - a.n AS count, {sql_share("(s.sampled - a.n)", "s.sampled")} AS percentage
  FROM samples s JOIN (SELECT id, sum(count)::BIGINT AS n FROM assigned GROUP BY id) a ON a.id = s.id)"""
ADAPTERS = f"""adapters AS (SELECT s.id, coalesce(a.n, 0) AS count, {sql_share("coalesce(a.n, 0)", "s.sampled")} AS percentage
  FROM samples s LEFT JOIN (SELECT l_returnflag AS id, count(DISTINCT l_orderkey) AS n FROM lineitem WHERE l_linenumber = 4 GROUP BY 1) a ON a.id = s.id)"""


def adapter_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignments(spark, sf_dir).filter("mismatches = 3").select("id", "read")


@query(f"WITH {ALIGNMENTS} SELECT * FROM best")
def best_alignments(spark, sf_dir):
    return assign.best_alignments(noted(spark, sf_dir))


@query(f"WITH {ALIGNMENTS} SELECT id, genome, count(*) AS genome_count FROM best GROUP BY id, genome")
def genome_counts(spark, sf_dir):
    return assign.genome_counts(assign.best_alignments(alignments(spark, sf_dir)))


@query(f"WITH {ALIGNMENTS} SELECT * FROM chosen")
def assigned_reads(spark, sf_dir):
    return chosen(spark, sf_dir)


@query(f"WITH {ALIGNMENTS}, {ALIGNED} SELECT * FROM aligned")
def aligned_summary(spark, sf_dir):
    return summarize.genome_summary(alignments(spark, sf_dir), samples(spark, sf_dir), genomes(spark))


@query(f"WITH {ALIGNMENTS}, {ASSIGNED} SELECT * FROM assigned")
def assigned_summary(spark, sf_dir):
    return summarize.genome_summary(chosen(spark, sf_dir).filter("assigned"), samples(spark, sf_dir), genomes(spark))


@query(f"WITH {ALIGNMENTS}, {EXPECTED} SELECT * FROM expected_reads")
def expected_summary(spark, sf_dir):
    return summarize.expected_summary(noted(spark, sf_dir), samples(spark, sf_dir))


@query(f"WITH {ALIGNMENTS}, {CONTROL} SELECT * FROM control_reads")
def control_summary(spark, sf_dir):
    return summarize.control_summary(noted(spark, sf_dir), samples(spark, sf_dir))


@query(f"WITH {ALIGNMENTS}, {ADAPTERS} SELECT * FROM adapters")
def adapter_counts(spark, sf_dir):
    return summarize.adapter_counts(adapter_matches(spark, sf_dir), samples(spark, sf_dir))


@query(f"WITH {ALIGNMENTS}, {ASSIGNED}, {UNMAPPED} SELECT * FROM unmapped")
def unmapped_summary(spark, sf_dir):
    return summarize.unmapped_summary(assigned_summary(spark, sf_dir), samples(spark, sf_dir))


SAMPLE_SUMMARY = f"""WITH {ALIGNMENTS}, {ASSIGNED}, {EXPECTED}, {CONTROL}, {UNMAPPED}, {ADAPTERS}
SELECT s.user_id AS id, 'human|mouse' AS species, 'phix' AS controls, 'g1|g2' AS genomes, 'g0' AS "control genomes", s.sequences, s.sampled,
  e.count AS "genome aligned", e.percentage AS "genome aligned %", e.error_rate AS "genome error rate",
  c.count AS "control aligned", c.percentage AS "control aligned %", c.error_rate AS "control error rate",
  u.count AS unmapped, u.percentage AS "unmapped %", a.count AS adapter, a.percentage AS "adapter %"
FROM samples s JOIN expected_reads e USING (id) JOIN control_reads c USING (id) JOIN unmapped u USING (id) JOIN adapters a USING (id)"""


def _result(spark, sf_dir):
    rows = alignments(spark, sf_dir).drop("genome_ordinal").withColumns({"sequence": F.lit(""), "quality": F.lit("")})
    counts = samples(spark, sf_dir).select("id", F.col("sequences").alias("read"), "sampled")
    return summarise(samples(spark, sf_dir).drop("sequences", "sampled"), genomes(spark), counts, rows, adapter_matches(spark, sf_dir))


@query(SAMPLE_SUMMARY)
def sample_summary(spark, sf_dir):
    return _result(spark, sf_dir).summary


ALIGNMENT_SUMMARY = f"""WITH {ALIGNMENTS}, {ALIGNED}, {ASSIGNED}, {UNMAPPED}
SELECT s.user_id AS id, a.genome, g.species, CASE WHEN g.ordinal <= 2 THEN 'yes' ELSE 'no' END AS expected, CASE WHEN g.ordinal = 0 THEN 'yes' ELSE 'no' END AS control,
  a.count AS aligned, a.percentage AS "aligned %", a.error_rate AS "error rate", b.count AS assigned, b.percentage AS "assigned %", b.error_rate AS "assigned error rate"
FROM samples s JOIN aligned a USING (id) JOIN assigned b USING (id, genome) JOIN genomes g USING (genome)
UNION ALL SELECT s.user_id, 'unmapped', NULL, NULL, NULL, u.count, u.percentage, NULL, u.count, u.percentage, NULL FROM samples s JOIN unmapped u USING (id)"""


@query(ALIGNMENT_SUMMARY)
def alignment_summary(spark, sf_dir):
    return _result(spark, sf_dir).alignment_summary


@query(f"WITH {ALIGNMENTS} SELECT user_id AS id, read, genome, chromosome, position, strand, '' AS sequence, '' AS quality, mismatches, expected, control, assigned FROM chosen JOIN samples USING (id)")
def genome_alignments(spark, sf_dir):
    return _result(spark, sf_dir).genome_alignments


@query(f"WITH {ALIGNMENTS} SELECT s.id, g.genome FROM samples s CROSS JOIN genomes g")
def dense_complete(spark, sf_dir):
    return summarize.spine(samples(spark, sf_dir), genomes(spark))


PLOT = f"""WITH {ALIGNMENTS}, {ASSIGNED}, {UNMAPPED}, {ADAPTERS},
bars AS (SELECT id, genome AS reference, count, error_rate, CASE WHEN genome = 'g0' THEN 'control' WHEN genome IN ('g1', 'g2') THEN 'expected species' ELSE 'unexpected/contaminant' END AS category, 'genome' AS type FROM assigned WHERE count > 0
  UNION ALL SELECT id, 'unmapped', count, NULL, 'unmapped', 'genome' FROM unmapped WHERE count > 0
  UNION ALL SELECT id, 'adapter', count, 0.25::DOUBLE, 'adapter', 'adapter' FROM adapters),
numbered AS (SELECT row_number() OVER (ORDER BY ordinal)::INT AS id, id AS sample, user_id, sequences, sampled FROM samples),
shown AS (SELECT n.id, n.user_id, b.reference, b.count::DOUBLE AS count, b.error_rate::DOUBLE AS error_rate, b.category, b.type, CASE WHEN n.sampled = 0 THEN 0 ELSE b.count::DOUBLE / n.sampled * n.sequences / 1e6 END AS scaled_count,
  CASE WHEN b.category = 'unmapped' THEN 0.25::DOUBLE ELSE greatest(least(b.error_rate, 1.5::DOUBLE), 0.25::DOUBLE) END AS bounded_error_rate,
  CASE b.category WHEN 'adapter' THEN 0 WHEN 'unmapped' THEN 1 WHEN 'unexpected/contaminant' THEN 2 WHEN 'control' THEN 3 ELSE 4 END AS place FROM bars b JOIN numbered n ON n.sample = b.id)
SELECT * EXCLUDE (place), row_number() OVER (ORDER BY id, type, place, count, reference)::INT AS "group", CASE WHEN type = 'adapter' THEN 0.5::DOUBLE ELSE 1::DOUBLE END AS bar_width FROM shown"""


@query(PLOT)
def plot_rows(spark, sf_dir):
    result = _result(spark, sf_dir)
    return result.plot_data()


# metadata


def details(spark, sf_dir):
    rows = _table(spark, sf_dir, "nation").join(_table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    listed = F.concat("r_name", F.lit("|"), "n_name", F.lit(" alias | x"), "n_nationkey", F.lit("|"))
    return rows.select(F.col("n_name").alias("genome"), F.concat("r_name", F.lit(" of "), "n_name").alias("species"), listed.alias("synonyms"))


def indexes(spark, sf_dir):
    known = F.when(F.col("n_nationkey") % 3 != 0, F.lower("n_name")).otherwise(F.concat(F.lit("Other "), "n_name"))
    named = _table(spark, sf_dir, "nation").select(known.alias("id"))
    return named.unionByName(_table(spark, sf_dir, "region").select(F.concat(F.lit("Extra "), "r_name").alias("id")))


def sheet(spark, sf_dir):
    rows = _table(spark, sf_dir, "supplier").join(_table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    species = F.concat("n_name", F.lit("| "), F.upper("n_name"), F.lit("  Alias |nothing|x"), (F.col("n_nationkey") + 2) % 25)
    controls = F.when(F.col("s_suppkey") % 2 == 0, F.concat(F.lit("X"), (F.col("n_nationkey") + 2) % 25, F.lit("\t|none")))
    return rows.select(F.col("s_suppkey").alias("id"), species.alias("species"), controls.alias("controls"))


META = """
details AS (SELECT n_name AS genome, r_name || ' of ' || n_name AS species, r_name || '|' || n_name || ' alias | x' || n_nationkey || '|' AS synonyms FROM nation JOIN region ON n_regionkey = r_regionkey),
indexes AS (SELECT CASE WHEN n_nationkey % 3 <> 0 THEN lower(n_name) ELSE 'Other ' || n_name END AS id FROM nation UNION ALL SELECT 'Extra ' || r_name FROM region),
joined AS (SELECT coalesce(i.id, d.genome) AS genome, d.species, d.synonyms, i.id IS NOT NULL AS has_index FROM details d FULL OUTER JOIN indexes i ON lower(d.genome) = lower(i.id)),
synonyms AS (SELECT DISTINCT genome, lower(regexp_replace(synonym, '^\\s+|\\s+$', '', 'g')) AS synonym FROM (
  SELECT genome, genome AS synonym FROM joined UNION ALL SELECT genome, species FROM joined UNION ALL SELECT genome, unnest(string_split(synonyms, '|')) FROM joined)
  WHERE length(regexp_replace(synonym, '^\\s+|\\s+$', '', 'g')) > 0),
sheet AS (SELECT s_suppkey AS id, n_name || '| ' || upper(n_name) || '  Alias |nothing|x' || ((n_nationkey + 2) % 25) AS species,
  CASE WHEN s_suppkey % 2 = 0 THEN 'X' || ((n_nationkey + 2) % 25) || chr(9) || '|none' END AS controls FROM supplier JOIN nation ON s_nationkey = n_nationkey),
known AS (SELECT s.genome, s.synonym, j.species, j.has_index FROM synonyms s JOIN joined j USING (genome)),
species_tokens AS (SELECT id, unnest(range(len(string_split(species, '|'))))::INT AS place, unnest(string_split(species, '|')) AS token FROM sheet),
control_tokens AS (SELECT id, unnest(range(len(string_split(controls, '|'))))::INT AS place, unnest(string_split(controls, '|')) AS token FROM sheet WHERE controls IS NOT NULL),
species_found AS (SELECT t.id, t.place, t.token, k.genome, k.species, k.has_index FROM species_tokens t LEFT JOIN known k ON k.synonym = lower(regexp_replace(t.token, '^\\s+|\\s+$', '', 'g'))),
control_found AS (SELECT t.id, t.place, t.token, k.genome FROM control_tokens t LEFT JOIN known k ON k.synonym = lower(regexp_replace(t.token, '^\\s+|\\s+$', '', 'g'))),
control AS (SELECT id, genome, min(place) AS place FROM control_found WHERE genome IS NOT NULL GROUP BY id, genome),
expected AS (SELECT id, genome, min(place) AS place FROM species_found f WHERE genome IS NOT NULL AND NOT EXISTS (SELECT 1 FROM control c WHERE c.id = f.id AND c.genome = f.genome) GROUP BY id, genome)"""


@query(f"WITH {META} SELECT * FROM joined")
def index_full_join(spark, sf_dir):
    return resolve.with_index(details(spark, sf_dir), indexes(spark, sf_dir))


@query(f"WITH {META} SELECT * FROM synonyms")
def synonym_table(spark, sf_dir):
    return resolve.synonym_table(index_full_join(spark, sf_dir))


@query(f"WITH {META} SELECT synonym, count(*) AS n FROM synonyms GROUP BY synonym HAVING count(*) > 1")
def ambiguous_synonyms(spark, sf_dir):
    return checks.ambiguous_synonyms(synonym_table(spark, sf_dir))


@query("SELECT name FROM (SELECT name, count(*) OVER (PARTITION BY lower(name)) AS n FROM (SELECT n_name AS name FROM nation UNION ALL SELECT CASE WHEN n_nationkey % 4 = 0 THEN lower(n_name) ELSE n_name || ' again' END FROM nation)) WHERE n > 1")
def case_duplicates(spark, sf_dir):
    nation = _table(spark, sf_dir, "nation")
    names = nation.select(F.col("n_name").alias("name"))
    more = nation.select(F.when(F.col("n_nationkey") % 4 == 0, F.lower("n_name")).otherwise(F.concat("n_name", F.lit(" again"))).alias("name"))
    return checks.case_duplicates(names.unionByName(more), "name")


@query("SELECT l_orderkey AS id, count(*) AS n FROM lineitem GROUP BY l_orderkey HAVING count(*) > 1")
def key_duplicates(spark, sf_dir):
    return checks.duplicates(_table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("id")), "id")


@query("SELECT DISTINCT url FROM pages WHERE contains(url, '|') UNION ALL SELECT o_orderpriority || '|' FROM orders WHERE starts_with(o_orderpriority, '1')")
def names_with_bar(spark, sf_dir):
    """Names of pages and of all orders; a bar is put into the names of urgent ones."""
    urls = _table(spark, sf_dir, "pages").select("url").distinct()
    name = F.col("o_orderpriority")
    more = _table(spark, sf_dir, "orders").select(F.when(name.startswith("1"), F.concat(name, F.lit("|"))).otherwise(name).alias("url"))
    return checks.with_bar(urls.unionByName(more), "url")


def _species(spark, sf_dir, column):
    joined = index_full_join(spark, sf_dir)
    return resolve.matches(sheet(spark, sf_dir), column, joined, resolve.synonym_table(joined))


@query(f"WITH {META} SELECT * FROM species_found")
def species_match(spark, sf_dir):
    return _species(spark, sf_dir, "species").select("id", "place", "token", "genome", "species", "has_index")


@query(f"WITH {META} SELECT DISTINCT token FROM species_found WHERE genome IS NULL")
def unknown_species(spark, sf_dir):
    return species_match(spark, sf_dir).filter(F.col("genome").isNull()).select("token").distinct()


@query(f"WITH {META} SELECT * FROM expected")
def expected_anti_control(spark, sf_dir):
    return resolve.without(resolve.first_places(_species(spark, sf_dir, "species")), resolve.first_places(_species(spark, sf_dir, "controls"))).select("id", "genome", "place")


@query(f"WITH {META} SELECT id, string_agg(genome, '|' ORDER BY place, genome) AS genomes FROM expected GROUP BY id")
def genomes_collapsed(spark, sf_dir):
    return resolve.collapsed(expected_anti_control(spark, sf_dir), "genomes")


# reads


def reads(spark, sf_dir, texts=True):
    """Documents as reads, numbered in their source by sorted ranges, as a source may have any share of them. texts: with
    sequence and quality."""
    docs = _table(spark, sf_dir, "documents").select(F.col("source").alias("sample"), F.col("doc_id").alias("id"), *([F.col("text").alias("seq")] if texts else []))
    placed = sampling.with_place(docs, ["sample", "id"], "ordinal", "sample")
    return placed.select("sample", "ordinal", "id", *(["seq", F.reverse("seq").alias("qual")] if texts else []))


READS = "reads AS (SELECT source AS sample, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS ordinal, doc_id AS id, text AS seq, reverse(text) AS qual FROM documents)"


@query(f"WITH {READS} SELECT sample, ordinal, id, substring(seq, 11, 25) AS seq, substring(qual, 11, 25) AS qual FROM reads")
def trim_reads(spark, sf_dir):
    return sampling.trim(reads(spark, sf_dir), 11, 25)


@query(f"WITH {READS} SELECT sample, ordinal, id FROM reads WHERE length(seq) >= 1000")
def min_length_filter(spark, sf_dir):
    return sampling.long_enough(reads(spark, sf_dir), 1000).select("sample", "ordinal", "id")


@query(f"WITH {READS} SELECT sample, ordinal, id FROM reads WHERE ordinal < 7")
def read_cap(spark, sf_dir):
    return sampling.capped(reads(spark, sf_dir, texts=False), 7).select("sample", "ordinal", "id")


@query(f"WITH {READS} SELECT sample, ordinal, id, place, place // 10 AS chunk FROM (SELECT *, row_number() OVER (ORDER BY sample, ordinal) - 1 AS place FROM reads)")
def chunked_reads(spark, sf_dir):
    return sampling.chunk_numbers(reads(spark, sf_dir, texts=False), 10).select("sample", "ordinal", "id", "place", "chunk")


HASHED = f"WITH {READS}, h AS (SELECT sample, ordinal, id, row_number() OVER (PARTITION BY sample ORDER BY md5('7|' || sample || '|' || ordinal)) AS n FROM reads WHERE length(seq) >= 500)"


@query(f"{HASHED} SELECT sample, ordinal, id FROM h WHERE n <= 20")
def hash_sample(spark, sf_dir):
    return sampling.sample_reads(reads(spark, sf_dir), 20, 500, "7").select("sample", "ordinal", "id")


@query(f"{HASHED} SELECT sample AS id, count(*) AS read, (SELECT count(*) FROM h WHERE h.sample = r.sample AND n <= 20) AS sampled FROM reads r GROUP BY sample")
def sampling_summary(spark, sf_dir):
    return sampling.one_pass_sample(reads(spark, sf_dir), 20, 500, "7")[1]


@query(f"{HASHED} SELECT sample, ordinal, id, seq FROM h WHERE n <= 20".replace("SELECT sample, ordinal, id, row_number()", "SELECT sample, ordinal, id, seq, row_number()"))
def one_pass_sample(spark, sf_dir):
    """The same sample with its texts, by tasks that keep their lowest hashes in one pass."""
    return sampling.one_pass_sample(reads(spark, sf_dir), 20, 500, "7")[0].select("sample", "ordinal", "id", "seq")


@query("SELECT source AS sample, lang AS id, count(*) AS n FROM documents GROUP BY source, lang HAVING count(*) > 1")
def repeated_reads(spark, sf_dir):
    return checks.repeated_reads(_table(spark, sf_dir, "documents").select(F.col("source").alias("sample"), F.col("lang").alias("id")))


@query("""SELECT doc_id, CASE WHEN lang = '' THEN 'no id' WHEN NOT regexp_full_match(text, '[\\x00-\\x7F]*') THEN 'sequence is not ASCII' WHEN length(text) <> n_chars THEN 'sequence and quality differ in length' END AS problem
FROM (SELECT doc_id, lang, replace(text, chr(10), ' ') AS text, CASE WHEN doc_id % 5 = 0 THEN n_chars + 1 ELSE n_chars END AS n_chars FROM documents)""")
def record_problems(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    flat = F.replace("text", F.lit("\n"), F.lit(" "))
    same = F.repeat(F.lit("I"), (F.col("n_chars") + F.when(F.col("doc_id") % 5 == 0, 1).otherwise(0)).cast("int"))
    rows = docs.select("doc_id", F.col("lang").alias("id"), flat.alias("seq"), same.alias("qual"))
    return rows.select("doc_id", checks.record_problem().alias("problem"))


@query("""SELECT doc_id, '@' || doc_id || ' ' || lang || chr(10) || t || chr(10) || '+' || chr(10) || t AS fastq,
'>' || doc_id || chr(10) || rtrim(regexp_replace(t, '(.{80})', '\\1' || chr(10), 'g'), chr(10)) AS fasta
FROM (SELECT doc_id, lang, replace(text, chr(10), ' ') AS t FROM documents)""")
def record_texts(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    t = F.replace("text", F.lit("\n"), F.lit(" "))
    name = F.col("doc_id").cast("string")
    return docs.select("doc_id", fastq_text(name, F.col("lang"), t, t).alias("fastq"), fasta_text(name, F.lit(None).cast("string"), t).alias("fasta"))


@query("SELECT l_orderkey AS read, l_linenumber AS line, (l_linenumber - 1)::INT AS mismatches FROM lineitem")
def mismatch_counts(spark, sf_dir):
    described = F.when(F.col("l_linenumber") > 1, F.concat(F.repeat(F.lit("3:A>C,"), F.col("l_linenumber") - 2), F.lit("9:G>T")))
    return _table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("read"), F.col("l_linenumber").alias("line"), mismatch_count(described).alias("mismatches"))


@query("SELECT l_linestatus AS sample, l_orderkey || '|' || l_linenumber AS read FROM lineitem")
def combined_names(spark, sf_dir):
    both = F.concat_ws("|", "l_linestatus", "l_orderkey", "l_linenumber")
    return _table(spark, sf_dir, "lineitem").select(both.alias("name")).select(*split_first_bar("name", "sample", "read"))


@query("SELECT p_partkey AS id, regexp_replace(p_size::DOUBLE::VARCHAR, '\\.0$', '') AS size, CASE WHEN p_size > 25 THEN 'yes' WHEN p_size <= 25 THEN 'no' END AS large, CASE WHEN p_size % 2 = 0 THEN 'yes' ELSE 'no' END AS even FROM part")
def printed_values(spark, sf_dir):
    part = _table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.col("p_size").cast("double").alias("size"), yes_no(F.col("p_size") > 25).alias("large"), (F.col("p_size") % 2 == 0).alias("even"))
    return printable(part)


# alignment


ADAPTED = """WITH reads AS (SELECT s_suppkey AS read, n_name AS id, s_name || n_name || replace(n_name, 'I', 'x') || translate(reverse(n_name), 'ACGT', 'TGCA') || s_acctbal AS seq FROM supplier JOIN nation ON s_nationkey = n_nationkey),
names AS (SELECT DISTINCT n_name AS adapter FROM nation),
forms AS (SELECT adapter, '+' AS strand, adapter AS form, 2 * row_number() OVER (ORDER BY adapter) AS number FROM names
  UNION ALL SELECT adapter, '-', translate(reverse(adapter), 'ACGTacgt', 'TGCAtgca'), 2 * row_number() OVER (ORDER BY adapter) + 1 FROM names),
cells AS (SELECT id, read, number, x, y, CASE WHEN seq[x + 1] = form[y + 1] THEN 5 ELSE -4 END AS s
  FROM (SELECT id, read, seq, number, form, x, unnest(range(length(form))) AS y FROM (SELECT *, unnest(range(length(seq))) AS x FROM reads, forms))),
sums AS (SELECT *, sum(s) OVER d AS p FROM cells WINDOW d AS (PARTITION BY id, read, number, x - y ORDER BY x)),
starts AS (SELECT *, min((p - s) * 1000 - x) OVER (PARTITION BY id, read, number, x - y ORDER BY x) AS m FROM sums),
segments AS (SELECT *, (((-m) % 1000) + 1000) % 1000 AS a FROM starts),
scored AS (SELECT id, read, number, a, a - (x - y) AS b, x - a + 1 AS n, p - (m + a) // 1000 AS score FROM segments),
best AS (SELECT *, row_number() OVER (PARTITION BY id, read ORDER BY score DESC, number, a, b, n) AS place FROM scored WHERE score >= 20)
SELECT id, read, a::INT AS start, (a + n)::INT AS "end", '+' AS strand, adapter, (CASE strand WHEN '+' THEN b ELSE length(form) - b END)::INT AS "adapter start",
  (CASE strand WHEN '+' THEN b + n ELSE length(form) - b - n END)::INT AS "adapter end", strand AS "adapter strand", 100.0::DOUBLE * ((score + 4 * n) // 9) / n AS "percent identity", score::INT AS score
FROM best JOIN forms USING (number) WHERE place = 1"""


@query(ADAPTED)
def adapter_matches_native(spark, sf_dir):
    """Reads are lines of all suppliers that hold their nation's name, the name with other letters, and its reverse
    complement; adapters are the nations' names."""
    rows = _table(spark, sf_dir, "supplier").join(_table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    name = F.col("n_name")
    seq = F.concat("s_name", name, F.replace(name, F.lit("I"), F.lit("x")), F.translate(F.reverse(name), "ACGT", "TGCA"), F.col("s_acctbal").cast("string"))
    names = _table(spark, sf_dir, "nation").select(name.alias("name"), name.alias("seq"))
    return align.match_adapters(rows.select(name.alias("id"), F.col("s_suppkey").alias("read"), seq.alias("seq")), names, 20)


SCREENED = "(SELECT item_id AS item, text AS p FROM benchmark UNION ALL SELECT 1000000000 + n_nationkey, n_name FROM nation UNION ALL SELECT 2000000000 + r_regionkey, lower(r_name) FROM region)"


@query(f"SELECT doc_id AS doc, item, position(p IN text) - 1 AS position FROM documents JOIN {SCREENED} ON contains(text, p)")
def exact_seed_screen(spark, sf_dir):
    """Whole passages of the benchmark, and names of four to fourteen letters."""
    texts = _table(spark, sf_dir, "documents").select(F.col("doc_id").alias("doc"), F.col("text").alias("seq"))
    passages = _table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("item"), F.col("text").alias("passage"))
    names = _table(spark, sf_dir, "nation").select((F.col("n_nationkey") + 1000000000).cast("long").alias("item"), F.col("n_name").alias("passage"))
    words = _table(spark, sf_dir, "region").select((F.col("r_regionkey") + 2000000000).cast("long").alias("item"), F.lower("r_name").alias("passage"))
    return align.exact_hits(texts, passages.unionByName(names).unionByName(words))


UNGAPPED = """WITH cut AS (SELECT item_id AS item, unnest(range((length(text) + 35) // 36)) AS part, text FROM benchmark WHERE length(text) >= 36),
reads AS (SELECT item || '.' || part AS read, substring(text, least(part * 36, length(text) - 36)::BIGINT + 1, 36) AS seq FROM cut),
forms AS (SELECT read, '+' AS strand, seq FROM reads UNION ALL SELECT read, '-', translate(reverse(seq), 'ACGTacgt', 'TGCAtgca') FROM reads),
windows AS (SELECT lang AS genome, doc_id AS chromosome, i AS position, substring(text, i + 1, 36) AS w FROM (SELECT lang, doc_id, text, unnest(range(length(text) - 35)) AS i FROM documents WHERE length(text) >= 36)),
near AS (SELECT f.read, f.strand, f.seq, w.genome, w.chromosome, w.position, w.w FROM forms f JOIN windows w ON substring(f.seq, 1, 12) = substring(w.w, 1, 12)
  UNION SELECT f.read, f.strand, f.seq, w.genome, w.chromosome, w.position, w.w FROM forms f JOIN windows w ON substring(f.seq, 13, 12) = substring(w.w, 13, 12)
  UNION SELECT f.read, f.strand, f.seq, w.genome, w.chromosome, w.position, w.w FROM forms f JOIN windows w ON substring(f.seq, 25, 12) = substring(w.w, 25, 12)),
counted AS (SELECT *, len([i FOR i IN range(1, 37) IF seq[i] <> w[i]])::INT AS mismatches FROM near)
SELECT 'benchmark' AS id, read, genome, chromosome, position, strand, seq AS sequence, mismatches FROM (
  SELECT *, row_number() OVER (PARTITION BY read, genome ORDER BY mismatches, chromosome, position, strand) AS n FROM counted WHERE mismatches <= 2) WHERE n = 1"""


def benchmark_reads(spark: SparkSession, sf_dir: str, text=None) -> DataFrame:
    """Whole benchmark texts in pieces of 36 letters, the last one up to the end: id, read, seq."""
    text = F.col("text") if text is None else text
    part, length = F.col("part"), F.length("text")
    rows = _table(spark, sf_dir, "benchmark").select("item_id", text.alias("text")).filter(length >= 36)
    cut = rows.select("item_id", "text", F.explode(F.sequence(F.lit(0), F.floor((length - 1) / 36).cast("int"))).alias("part"))
    seq = F.substring("text", F.least(part * 36, length - 36) + 1, F.lit(36))
    return cut.select(F.lit("benchmark").alias("id"), F.concat_ws(".", "item_id", "part").alias("read"), seq.alias("seq"))


def text_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "documents").select(F.col("lang").alias("genome"), F.col("doc_id").alias("chromosome"), F.col("text").alias("seq"))


@query(UNGAPPED)
def ungapped_alignment(spark, sf_dir):
    return align.align_ungapped(benchmark_reads(spark, sf_dir), text_references(spark, sf_dir), 2, 36)


_CUT = "substring(text, least(part * 36, length(text) - 36)::BIGINT + 1, 36)"
MISMATCHES = f"""{UNGAPPED.rsplit("SELECT 'benchmark'", 1)[0].replace(_CUT, f"substring({_CUT}, 1, 9) || '#' || substring({_CUT}, 11, 26)")}, best AS (SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY read, genome ORDER BY mismatches, chromosome, position, strand) AS n FROM counted WHERE mismatches <= 2) WHERE n = 1)
SELECT read, genome, strand, (CASE strand WHEN '+' THEN i - 1 ELSE 36 - i END)::INT AS place, w[i] AS reference, seq[i] AS base FROM (SELECT *, unnest(range(1, 37)) AS i FROM best) WHERE seq[i] <> w[i]"""


@query(MISMATCHES)
def mismatch_places(spark, sf_dir):
    """Each mismatch of the best alignments: its place in the read, and the two letters. A letter of each read is another."""
    reads = benchmark_reads(spark, sf_dir).withColumn("seq", F.overlay("seq", F.lit("#"), 10))
    found = align.align_ungapped(reads, text_references(spark, sf_dir), 2, 36, describe=True)
    rows = found.select("read", "genome", "strand", F.explode(places_of(F.col("described"))).alias("m"))
    return rows.select("read", "genome", "strand", "m.place", "m.reference", F.col("m.read").alias("base"))


@query("")
def adapters_in_texts(spark, sf_dir):
    """The beginnings of benchmark texts as adapters, and all whole documents as reads. Scoring every cell in SQL takes too
    long for whole texts; tests compare it with a plain search. Seven eighths of an adapter must match, as short runs of
    letters are frequent in prose."""
    starts = _table(spark, sf_dir, "benchmark").select(F.col("item_id").cast("string").alias("name"), F.left("text", F.lit(40)).alias("seq"))
    docs = _table(spark, sf_dir, "documents").select(F.col("source").alias("id"), F.col("doc_id").alias("read"), F.col("text").alias("seq"))
    return align.match_adapters(docs, starts, 170)
