"""The operators with production parameters on the whole documents table, and their SQL where it exists."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, html_text, jaccard_join, licenses, line_dedup, lm, media, pieces, quality, spelling, token_counts, token_files, turn_trie
from .common import documents, shared_path

Query = Callable[[SparkSession, str], DataFrame]


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(documents(spark, sf_dir), tokenizer_path("piece_bpe_32k.model"))


def op2_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.read_features(media.store_texts(documents(spark, sf_dir)))


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode(documents(spark, sf_dir), tokenizer_path("piece_bpe_32k.model")).drop("ids")


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaked_pairs(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = token_files.write(documents(spark, sf_dir), tokenizer_path("word_bpe_49k.json"), shared_path(spark, "tokens"), end_id=1)
    return files.read(spark)


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_copies(documents(spark, sf_dir))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.dedup_lines(documents(spark, sf_dir))
    return found.select("doc_id", "n_lines", "n_removed", F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("text_md5"))


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(documents(spark, sf_dir))


def op9_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(documents(spark, sf_dir))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return quality.score(docs, quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(documents(spark, sf_dir))


def op12_main_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.main_texts(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op13_turn_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    arrays = turn_trie.turn_arrays(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    return turn_trie.prefix_trie(turn_trie.with_shared_starts(arrays))


def queries() -> dict[str, Query]:
    return {
        "op1_token_counts": op1_token_counts,
        "op2_media_columns": op2_media_columns,
        "op3_decontamination": op3_decontamination,
        "op4_token_files": op4_token_files,
        "op5_sentencepiece": op5_sentencepiece,
        "op6_jaccard_join": op6_jaccard_join,
        "op7_line_dedup": op7_line_dedup,
        "op8_licenses": op8_licenses,
        "op9_lm_scores": op9_lm_scores,
        "op10_quality": op10_quality,
        "op11_spelling_variants": op11_spelling_variants,
        "op12_main_texts": op12_main_texts,
        "op13_turn_trie": op13_turn_trie,
    }


_WORDS = r"[w FOR w IN string_split_regex(lower(coalesce(text, '')), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+') IF w <> '']"

#: The same with A-Z alone in lower case, as all operators but the third have it.
_ASCII = _WORDS.replace("lower(coalesce(text, ''))", "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")

#: Brute force: every document's shingles against every item's.
OP3_SQL = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
k AS (SELECT DISTINCT least(len(w), 5) AS k FROM b WHERE len(w) > 0),
ds AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + k - 1], ' ') AS s FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, k)),
bs AS (SELECT DISTINCT item_id, array_to_string(w[i:i + 4], ' ') AS s FROM (SELECT item_id, w, unnest(CASE WHEN len(w) BETWEEN 1 AND 4 THEN [1] ELSE range(1, len(w) - 3) END) AS i FROM b)),
n AS (SELECT item_id, count(*) AS n_shingles FROM bs GROUP BY item_id),
m AS (SELECT doc_id, item_id, count(*) AS n_shared FROM ds JOIN bs USING (s) GROUP BY doc_id, item_id)
SELECT doc_id, item_id, n_shared, n_shingles, n_shared / n_shingles AS containment
FROM m JOIN n USING (item_id) WHERE n_shared * 5 >= n_shingles * 4
"""


#: Brute force: pairs of texts that share a shingle, their exact similarity, and components by spreading the smallest
#: row to neighbours until nothing changes. Texts of one to four words are one shingle.
OP6_SQL = f"""
WITH RECURSIVE d AS (SELECT doc_id, {_ASCII} AS w FROM documents),
x AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s FROM (SELECT doc_id, w, unnest(CASE WHEN len(w) BETWEEN 1 AND 4 THEN [1] ELSE range(1, len(w) - 3) END) AS i FROM d)),
n AS (SELECT doc_id, count(*) AS n, bit_xor(hash(s)) AS p, sum(hash(s) % 1000000007) AS q FROM x GROUP BY doc_id),
class AS (SELECT n, p, q, min(doc_id) AS copy_id, count(*) AS n_docs FROM n GROUP BY n, p, q),
of AS (SELECT doc_id, copy_id FROM n JOIN class USING (n, p, q)),
cx AS (SELECT x.doc_id AS c, s FROM x JOIN class ON doc_id = copy_id),
shared AS (SELECT a.c AS a, b.c AS b, count(*) AS m FROM cx a JOIN cx b ON a.s = b.s AND a.c <> b.c GROUP BY a.c, b.c),
near AS (SELECT a, b, u.n_docs FROM shared JOIN class t ON t.copy_id = a JOIN class u ON u.copy_id = b WHERE m * 5 >= (t.n + u.n - m) * 4),
reach AS (SELECT copy_id AS a, copy_id AS b FROM class UNION SELECT r.a, e.b FROM reach r JOIN near e ON e.a = r.b),
root AS (SELECT a AS copy_id, min(b) AS class_id FROM reach GROUP BY a),
links AS (SELECT copy_id, any_value(class.n_docs) - 1 + coalesce(sum(near.n_docs), 0) AS n_links FROM class LEFT JOIN near ON a = copy_id GROUP BY copy_id)
SELECT d.doc_id, coalesce(o.copy_id, d.doc_id) AS copy_id, coalesce(r.class_id, d.doc_id) AS class_id, coalesce(l.n_links, 0)::BIGINT AS n_links
FROM d LEFT JOIN of o ON o.doc_id = d.doc_id LEFT JOIN root r ON r.copy_id = o.copy_id LEFT JOIN links l ON l.copy_id = o.copy_id
"""

#: Brute force: every line's shingles against those of all lines before it. Of copies of one token set only the first
#: is compared with others, as the rest match it.
OP7_SQL = f"""
WITH t AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS p FROM documents),
l AS (SELECT doc_id, unnest(range(1, len(p) + 1)) AS n, unnest(p) AS text FROM t),
d AS (SELECT doc_id, n, {_ASCII} AS w FROM l),
x AS (SELECT DISTINCT doc_id, n, array_to_string(w[i:i + 4], ' ') AS s FROM (SELECT doc_id, n, w, unnest(CASE WHEN len(w) BETWEEN 1 AND 4 THEN [1] ELSE range(1, len(w) - 3) END) AS i FROM d)),
k AS (SELECT doc_id, n, count(*) AS k, bit_xor(hash(s)) AS p, sum(hash(s) % 1000000007) AS q, doc_id * 1000000 + n AS place FROM x GROUP BY doc_id, n),
f AS (SELECT *, min(place) OVER (PARTITION BY k, p, q) AS first FROM k),
c AS (SELECT first, s FROM x JOIN f USING (doc_id, n) WHERE place = first),
sizes AS (SELECT first, any_value(k) AS k FROM f GROUP BY first),
m AS (SELECT a.first AS a, b.first AS b, count(*) AS m FROM c a JOIN c b ON a.s = b.s AND b.first < a.first GROUP BY a.first, b.first),
late AS (SELECT DISTINCT a FROM m JOIN sizes u ON u.first = a JOIN sizes v ON v.first = b WHERE m * 5 >= (u.k + v.k - m) * 4),
gone AS (SELECT doc_id, n FROM f WHERE place > first OR first IN (SELECT a FROM late)),
g AS (SELECT doc_id, list(n) AS ns FROM gone GROUP BY doc_id)
SELECT t.doc_id, len(p)::BIGINT AS n_lines, coalesce(len(ns), 0)::BIGINT AS n_removed,
  md5(array_to_string([p[i] FOR i IN range(1, len(p) + 1) IF NOT list_contains(coalesce(ns, []), i)], chr(10))) AS text_md5
FROM t LEFT JOIN g ON g.doc_id = t.doc_id
"""


def _op8_sql() -> str:
    """The same votes by SQL: exact trigrams at diagonals, neighbours merged, spans verified."""
    rows = [(n, text, label, n < len(licenses.PHRASES)) for n, (text, label) in enumerate([*licenses.PHRASES, *licenses.TEMPLATES])]
    values = ", ".join(f"({n}, '{text}', '{label}', {base})" for n, text, label, base in rows)
    return f"""
WITH t AS (SELECT template, string_split(text, ' ') AS w, label, base FROM (VALUES {values}) AS v(template, text, label, base)),
tg AS (SELECT template, label, base, len(w) - 2 AS n_grams, i AS t_pos, w[i + 1] AS a, w[i + 2] AS b, w[i + 3] AS c FROM (SELECT *, unnest(range(len(w) - 2)) AS i FROM t)),
d AS (SELECT doc_id, {_ASCII} AS w FROM documents),
dg AS (SELECT doc_id, i AS pos, w[i + 1] AS a, w[i + 2] AS b, w[i + 3] AS c FROM (SELECT *, unnest(range(len(w) - 2)) AS i FROM d)),
hits AS (SELECT DISTINCT doc_id, template, label, base, n_grams, t_pos, pos - t_pos AS diagonal FROM dg JOIN tg USING (a, b, c)),
votes AS (SELECT doc_id, template, label, base, n_grams, diagonal, list(t_pos) AS held FROM hits GROUP BY ALL),
marked AS (SELECT *, coalesce((diagonal - lag(diagonal) OVER o > {licenses.MERGE})::INT, 1) AS new FROM votes WINDOW o AS (PARTITION BY doc_id, template ORDER BY diagonal)),
parts AS (SELECT *, sum(new) OVER (PARTITION BY doc_id, template ORDER BY diagonal) AS part FROM marked),
merged AS (SELECT doc_id, template, label, n_grams, part, len(list_distinct(flatten(list(held)))) / n_grams AS coverage, min(diagonal + list_min(held)) AS first, max(diagonal + list_max(held) + {licenses.K}) AS last,
  coalesce(list(diagonal) FILTER (base AND len(held) = n_grams), []) AS places FROM parts GROUP BY doc_id, template, label, n_grams, part),
found AS (SELECT * FROM merged WHERE len(places) > 0 OR (coverage >= {licenses.COVERAGE} AND last - first <= {licenses.STRETCH} * (n_grams + {licenses.K - 1}))),
sums AS (SELECT doc_id, sum(len(places)) AS n_base, min(list_min(places)) AS first_word, max(list_max(places)) AS last_word,
  string_agg(DISTINCT CASE WHEN len(places) > 0 THEN label END, ',' ORDER BY CASE WHEN len(places) > 0 THEN label END) AS base_labels, string_agg(DISTINCT label, ',' ORDER BY label) AS labels,
  max(CASE WHEN len(places) > 0 THEN 1.0::DOUBLE ELSE coverage END) AS score FROM found GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word, last_word::BIGINT AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0)::DOUBLE AS score
FROM d LEFT JOIN sums ON sums.doc_id = d.doc_id
"""


OP8_SQL = _op8_sql()


#: A CTE with the table of CRC-32, and the checksum of a text of one-byte characters or of a list of bytes.
_CRC_TABLE = "crc AS (SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)), lambda a, k: xor(a >> 1, CASE WHEN a % 2 = 1 THEN 3988292384 ELSE 0 END))) AS tab)"


def _crc(codes: str) -> str:
    return f"xor(list_reduce(list_prepend(4294967295, {codes}), lambda a, b: xor(a >> 8, tab[(xor(a, b) & 255) + 1])), 4294967295)"


#: The bytes of a text of code points below 2,048 in UTF-8.
_BYTES = "flatten(list_transform(string_split({0}, ''), lambda x: CASE WHEN unicode(x) < 128 THEN [unicode(x)::BIGINT] ELSE [192 + unicode(x) // 64, 128 + unicode(x) % 64]::BIGINT[] END))"

#: Words with each letter taken out meet where they differ by one letter; those that lost a letter at different places are
#: compared again.
OP11_SQL = f"""
WITH RECURSIVE {_CRC_TABLE},
runs AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\u00C0-\u00FF]+')) AS run FROM documents),
counted AS (SELECT doc_id, run, count(*) AS n FROM runs WHERE length(run) >= 6 GROUP BY doc_id, run),
summed AS (SELECT run, n, {_crc(_BYTES.format("coalesce(doc_id::VARCHAR, '') || ':' || run"))} AS h FROM counted, crc),
altered AS (SELECT CASE WHEN h % 199 = 0 THEN substring(run, 1, (h % length(run))::BIGINT) || substring(run, (h % length(run))::BIGINT + 2) ELSE run END AS word, n FROM summed),
words AS (SELECT word, sum(n)::BIGINT AS n FROM altered WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
gaps AS (SELECT word, n, i, substring(word, 1, i) || substring(word, i + 2) AS rest FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)),
near AS (SELECT DISTINCT a.word, a.n, b.word AS other, b.n AS other_n FROM gaps a JOIN gaps b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT w.word, w.n, g.word, g.n FROM words w JOIN gaps g ON w.word = g.rest UNION SELECT g.word, g.n, w.word, w.n FROM words w JOIN gaps g ON w.word = g.rest),
best AS (SELECT word, n, count(*) AS n_near, first(other ORDER BY other_n DESC, other) AS other, max(other_n) AS other_n FROM near GROUP BY word, n),
found AS (SELECT words.word, CASE WHEN other_n >= 5 * words.n THEN other END AS form, words.n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 5 * words.n THEN other_n END AS form_n FROM words LEFT JOIN best ON best.word = words.word),
chain AS (SELECT word, word AS at FROM found UNION ALL SELECT c.word, f.form FROM chain c JOIN found f ON f.word = c.at WHERE f.form IS NOT NULL),
ends AS (SELECT c.word, c.at AS root FROM chain c JOIN found f ON f.word = c.at WHERE f.form IS NULL)
SELECT found.word, form, root, n, n_near, form_n FROM found JOIN ends ON ends.word = found.word
"""


#: Every prefix of every rebuilt conversation by its texts, and sums over the nodes below.
OP13_SQL = f"""
WITH {_CRC_TABLE},
t AS (SELECT conv_id, turn, {{'role': coalesce(role, ''), 'text': coalesce(text, '')}} AS t FROM conversations WHERE conv_id IS NOT NULL),
a AS (SELECT conv_id, list(t ORDER BY turn NULLS FIRST, t) AS turns FROM t GROUP BY conv_id),
c AS (SELECT conv_id, turns, ({_crc("list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)")} % 6)::BIGINT AS h FROM a, crc),
r AS (SELECT c.conv_id, list_concat(list_slice(b.turns, 1, h), list_slice(c.turns, h + 1, len(c.turns))) AS turns FROM c LEFT JOIN a b ON b.conv_id = c.conv_id - c.conv_id % 100),
p AS (SELECT conv_id, d, list_slice(turns, 1, d) AS prefix, len(turns) = d AS ends, turns[d].text AS text FROM (SELECT *, unnest(range(len(turns) + 1)) AS d FROM r)),
n AS (SELECT prefix, d, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * coalesce(length(any_value(text)), 0) AS saved,
  sha256(coalesce(string_agg(CASE WHEN ends THEN conv_id::VARCHAR END, ',' ORDER BY conv_id), '')) AS ends FROM p GROUP BY prefix, d),
k AS (SELECT list_slice(prefix, 1, d - 1) AS prefix, count(*) AS n_children FROM n WHERE d > 0 GROUP BY 1),
u AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN k ON k.prefix = n.prefix),
up AS (SELECT list_slice(prefix, 1, i) AS prefix, count(*) FILTER (n_children = 0) AS n_leaves, sum(saved)::BIGINT AS saved_tokens FROM (SELECT *, unnest(range(d + 1)) AS i FROM u) GROUP BY 1)
SELECT u.conv_id, u.d AS depth, n.conv_id AS parent_conv_id, u.n_convs, u.n_children, n_leaves, saved_tokens, u.ends AS ends_sha256
FROM u JOIN up ON up.prefix = u.prefix LEFT JOIN n ON u.d > 0 AND n.d = u.d - 1 AND n.prefix = list_slice(u.prefix, 1, u.d - 1)
"""


def oracle_sql() -> dict[str, str]:
    return {"op3_decontamination": OP3_SQL, "op6_jaccard_join": OP6_SQL, "op7_line_dedup": OP7_SQL, "op8_licenses": OP8_SQL, "op11_spelling_variants": OP11_SQL, "op13_turn_trie": OP13_SQL}
