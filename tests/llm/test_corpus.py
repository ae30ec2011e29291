"""Operators over a whole corpus: 3, 6, 7, 9, 10, and the pipeline."""

import math
import random
import re
import zlib
from collections import Counter

import brute
import numpy as np
import pytest
from comparing import compare
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from seqsieve.llm import common, components, decontaminate, jaccard_join, line_dedup, lm, quality, setsim, words
from seqsieve.llm import queries as module

# shared parts


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(st.sampled_from("abC é-\n0٣"), max_size=20), min_size=1, max_size=6))
def test_words_and_hashes(texts):
    raw = [t.encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in raw])])
    body = np.frombuffer(b"".join(raw), np.uint8)
    starts, ends, rows = words.spans(body, offsets, words.WORD_BYTES)
    found = [(int(r), body[a:b].tobytes()) for a, b, r in zip(starts, ends, rows, strict=True)]
    assert found == [(i, w) for i, t in enumerate(raw) for w in re.findall(rb"[0-9A-Za-z\x80-\xff]+", t)]
    h = words.hashes(body, starts, ends)
    for i in range(len(found)):
        for j in range(i):
            assert (found[i][1] == found[j][1]) == (h[i] == h[j])


def test_components(spark):
    r = random.Random(2)
    pairs = [(n, n + 1) for n in range(60)] + [(r.randrange(100, 400), r.randrange(100, 400)) for _ in range(150)] + [(7, 7), (500, 501), (501, 500)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in pairs:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    linked = {x for a, b in pairs if a != b for x in (a, b)}
    got = {r["node"]: r["root"] for r in components.connected_components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {x: find(x) for x in linked}
    assert components.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_overlaps_agree():
    r = np.random.RandomState(5)
    sets = [np.unique(r.randint(0, 300, 120).astype(np.uint64)) for _ in range(12)]
    left, right = np.triu_indices(12, 1)
    one = np.array([len(np.intersect1d(sets[i], sets[j])) for i, j in zip(left, right, strict=True)])
    assert (setsim.overlaps(sets, left, right) == one).all()
    assert (setsim.overlaps(sets, left[:20], right[:20]) == one[:20]).all()


def test_pruning_bound():
    for n in (16, 64):
        least = setsim.least_matches(n, 1e-9)
        assert 0 < least < 0.8 * n
        assert sum(math.comb(n, m) * 0.8**m * 0.2 ** (n - m) for m in range(least)) < 1e-6


# 6


def test_near_copies(spark, docs, rows, empty):
    got = Counter(tuple(r) for r in jaccard_join.near_copies(docs).collect())
    expected = brute.near_copies(rows)
    assert got == Counter((rows[k][0], *v) for k, v in expected.items())
    assert max(v[2] for v in expected.values()) >= 5
    assert jaccard_join.near_copies(empty).count() == 0


def test_near_copies_in_blocks(spark, docs, rows, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK", 4)
    monkeypatch.setattr(components, "HOT_ROWS", 3)
    monkeypatch.setattr(common, "BROADCAST_BYTES", 0)
    got = Counter(tuple(r) for r in jaccard_join.near_copies(docs).collect())
    assert got == Counter((rows[k][0], *v) for k, v in brute.near_copies(rows).items())


def test_keep_first(spark, docs, rows):
    kept = jaccard_join.keep_first(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    expected = brute.near_copies(rows)
    alone = [rows[k][0] for k, v in expected.items() if v[2] == 0]
    assert Counter(ids) == Counter(alone + list({v[1] for v in expected.values() if v[2]}))


def test_keep_first_tells_texts_of_one_id_apart(spark):
    a, b = "alpha beta gamma delta epsilon zeta eta theta", "iota kappa lambda mu nu xi omicron pi rho"
    rows = [(1, a), (5, a), (5, "one unique text that stays whatever others do"), (9, "x1 x2 x3 x4 x5 x6"), (9, "y1 y2 y3 y4 y5 y6"), (7, b), (7, b), (7, b), (8, b.upper()), (None, a), (None, a), (3, None), (3, None), (4, ""), (2, "short"), (6, "Short!")]
    table = spark.createDataFrame([(i, t, str(n)) for n, (i, t) in enumerate(rows)], "doc_id long, text string, node string")
    got = Counter((r["doc_id"], r["text"]) for r in jaccard_join.keep_first(table).collect())
    assert got == Counter([(1, a), (5, rows[2][1]), rows[3], rows[4], (7, b), (None, a), (None, a), (3, None), (3, None), (4, ""), (2, "short")])
    assert jaccard_join.keep_first(table.limit(0)).count() == 0


def test_keep_first_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK", 3)
    monkeypatch.setattr(jaccard_join, "GROUP_ROWS", 7)
    monkeypatch.setattr(components, "HOT_ROWS", 2)
    r = random.Random(3)
    base = [f"w{n}" for n in range(150)]
    rows = []
    for n in range(50):
        w = list(base)
        w[r.randrange(150)] = f"x{n}"
        rows.append((n // 2, " ".join(w)))
    table = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(tuple(x) for x in jaccard_join.near_copies(table).collect())
    assert got == sorted((rows[k][0], rows[k][0], *v[1:]) for k, v in brute.near_copies(rows).items())
    assert max(x[3] for x in got) > 20
    assert jaccard_join.keep_first(table).count() == len({v[1] for v in brute.near_copies(rows).values()})


# 7


def marked(frame):
    return [tuple(r) for r in frame.select("doc_id", "text", F.xxhash64("text")).collect()]


def deduped(frame):
    return Counter((r["doc_id"], r["n_lines"], r["n_removed"], r["text"] or "") for r in frame.collect())


def test_line_dedup(spark, docs, rows, empty):
    whole = line_dedup.dedup_lines(docs)
    table = marked(docs)
    assert deduped(whole) == Counter((i, *v) for (i, _, _), v in zip(table, brute.dedup_lines(table), strict=True))
    assert whole.columns == [*docs.columns, "n_lines", "n_removed"] and whole.count() == docs.count()
    assert whole.filter("text is null").count() == 2
    assert line_dedup.dedup_lines(empty).count() == 0


def test_line_dedup_keeps_columns_of_its_names(spark):
    table = spark.createDataFrame([(1, "a b c\nx", 7, "k"), (2, "a b c\ny", 8, "l"), (None, "x", 9, None)], "doc_id long, text string, N_Lines int, n_removed string")
    got = line_dedup.dedup_lines(table)
    assert got.columns == [*table.columns, "_n_lines", "_n_removed"]
    assert Counter(tuple(r) for r in got.collect()) == Counter([(1, "a b c", 7, "k", 2, 1), (2, "y", 8, "l", 2, 1), (None, "x", 9, None, 1, 0)])


def test_line_dedup_of_hot_tokens(spark, docs, monkeypatch):
    monkeypatch.setattr(line_dedup, "HOT_TOKENS", 3)
    monkeypatch.setattr(components, "HOT_ROWS", 2)
    table = marked(docs)
    assert deduped(line_dedup.dedup_lines(docs)) == Counter((i, *v) for (i, _, _), v in zip(table, brute.dedup_lines(table), strict=True))


def test_line_dedup_in_blocks(spark, monkeypatch):
    r = random.Random(8)
    base = [f"w{n}" for n in range(40)]
    texts = []
    for n in range(60):
        w = list(base)
        w[r.randrange(40)] = f"x{n}"
        texts.append((n, " ".join(w) + "\nshort line\n" + " ".join(r.choice(base) for _ in range(9))))
    monkeypatch.setattr(line_dedup, "BLOCK", 7)
    monkeypatch.setattr(line_dedup, "TOKEN_BLOCK", 5)
    monkeypatch.setattr(line_dedup, "LIST_BYTES", 0)
    frame = spark.createDataFrame(texts, "doc_id long, text string")
    table = marked(frame)
    assert deduped(line_dedup.dedup_lines(frame)) == Counter((i, *v) for (i, _, _), v in zip(table, brute.dedup_lines(table), strict=True))


def test_line_dedup_of_short_lines(spark, monkeypatch):
    r = random.Random(9)
    menu = ["Home", "home!", "Log in", "in log", "Read more here", "one two three four", "one two three four five", "***", "", "Ünï 日本"]
    near = [f"w{n}" for n in range(30)]
    texts = []
    for n in range(40):
        w = list(near)
        w[r.randrange(30)] = f"x{n}"
        texts.append((n, "\n".join([r.choice(menu) for _ in range(6)] + [" ".join(w), " ".join(near[n % 4 : n % 4 + 5 + n % 5])])))
    monkeypatch.setattr(line_dedup, "BLOCK", 7)
    table = spark.createDataFrame(texts, "doc_id long, text string")
    rows = marked(table)
    assert deduped(line_dedup.dedup_lines(table)) == Counter((i, *v) for (i, _, _), v in zip(rows, brute.dedup_lines(rows), strict=True))


def test_op7_removes_short_lines(spark, tmp_path):
    spark.createDataFrame([(1, "Home\nLog in"), (2, "home\nother\n***"), (3, "***\nLog in")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert {x["doc_id"]: x["n_removed"] for x in module.op7_line_dedup(spark, str(tmp_path)).collect()} == {1: 0, 2: 1, 3: 1}


# 3


def plain_leaks(rows, items):
    out = Counter()
    best = {}
    for i, t in rows:
        a = brute.shingle_set(t, short=False)
        for k, x in items:
            b = brute.shingle_set(x, short=False)
            n = len(a & b)
            if b and 5 * n >= 4 * len(b):
                best[i, k] = max(best.get((i, k), (0, 0)), (n, len(b)))
    out.update((i, k, *v) for (i, k), v in best.items())
    return out


def leaky(rows):
    r = random.Random(5)
    items = [(n, " ".join(f"item{n}word{j}" for j in range(6 + 5 * n))) for n in range(8)] + [(90, "only four words here"), (91, None), (92, "")]
    more = []
    for n, t in items[:8]:
        w = t.split()
        more.append((200 + n, "before " + t.upper().replace(" ", ", ") + " after"))
        w[len(w) // 2] = "other"
        more.append((300 + n, " ".join(w)))
        more.append((400 + n, " ".join(w[: len(w) // 2])))
        more.append((500 + n, " ".join(r.choice(w) for _ in range(400)) + " " + t))
    return [*rows, *more], items


def test_decontamination(spark, rows, empty):
    texts, items = leaky(rows)
    docs = spark.createDataFrame([(i, t, "x") for i, t in texts], "doc_id long, text string, item_id string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    expected = plain_leaks(texts, items)
    assert Counter(tuple(r)[:4] for r in decontaminate.leaked_pairs(docs, bench).collect()) == expected
    kept = decontaminate.drop_leaks(docs, bench)
    assert kept.columns == docs.columns
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter(i for i, _ in texts if i not in {k[0] for k in expected})
    assert decontaminate.leaked_pairs(docs, bench.limit(0)).count() == 0
    assert decontaminate.leaked_pairs(empty, bench).count() == 0
    plan = decontaminate.leaked_pairs(docs, bench)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|MapInArrow", plan)


def test_short_items_are_found_whole(spark):
    items = [(1, "Alpha beta, GAMMA delta"), (2, "é"), (3, "two words"), (4, " ... "), (5, "one two three four five six")]
    docs = [(1, "so alpha beta gamma delta it is, two words"), (2, "alpha beta delta gamma"), (3, "É"), (None, "two words"), (4, "two"), (5, "x one two three four five six, two  words two words")]
    frames = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = {tuple(r) for r in decontaminate.leaked_pairs(*frames).collect()}
    assert got == {(1, 1, 1, 1, 1.0), (1, 3, 1, 1, 1.0), (3, 2, 1, 1, 1.0), (None, 3, 1, 1, 1.0), (5, 3, 1, 1, 1.0), (5, 5, 2, 2, 1.0)}
    assert {r["doc_id"] for r in decontaminate.drop_leaks(*frames).collect()} == {1, 2, 3, 4, None}


def test_decontamination_by_shuffles(spark, rows, monkeypatch):
    monkeypatch.setattr(common, "BROADCAST_BYTES", 0)
    texts, items = leaky(rows[:30])
    got = decontaminate.leaked_pairs(spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert Counter(tuple(r)[:4] for r in got.collect()) == plain_leaks(texts, items)


def test_tables_are_broadcast_by_their_bytes(spark, monkeypatch):
    rows = spark.createDataFrame([(n, "é" * 100) for n in range(10)] + [(10, None)], "n long, text string")
    hinted = lambda df: "ResolvedHint" in df._jdf.queryExecution().analyzed().toString()
    size = 11 * (48 + 16 + 24) + 10 * 200
    monkeypatch.setattr(common, "BROADCAST_BYTES", size)
    assert hinted(common.measured(rows)) and hinted(common.measured(rows.limit(0)))
    monkeypatch.setattr(common, "BROADCAST_BYTES", size - 1)
    assert not hinted(common.measured(rows))


@pytest.mark.parametrize("name", sorted(module.oracle_sql()))
def test_query_equals_sql(spark, small, name):
    compare(spark, name, module.queries()[name](spark, small), module.oracle_sql()[name], small)


# 9


def lm_tokens(text):
    return [*re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()).split(), b""]


@pytest.mark.parametrize("frequent", [1 << 17, 40])
def test_lm(spark, docs, rows, empty, monkeypatch, frequent):
    monkeypatch.setattr(lm, "FREQUENT", frequent)
    counts = Counter()
    for i, t in rows:
        if zlib.crc32(("" if i is None else str(i)).encode()) % 10:
            counts.update(lm_tokens(t))
    n, v = sum(counts.values()), len(counts)
    expected = Counter()
    for i, t in rows:
        w = lm_tokens(t)
        base = sum(math.log10((counts[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w)
        expected[i, zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0, len(w), sum(counts[x] > 0 for x in w), n, round(base, 6)] += 1
    got = lm.score(docs).collect()
    assert Counter((*tuple(r)[:5], round(r["base_score"], 6)) for r in got) == expected
    assert all(r["score"] < 0 for r in got)
    assert frequent < 100 or sum(r["score"] for r in got) > sum(r["base_score"] for r in got)
    assert lm.score(empty).count() == 0


def test_lm_is_one_model_however_rows_are_parted(spark, docs, rows, monkeypatch):
    monkeypatch.setattr(lm, "SHARD", 3000)
    monkeypatch.setattr(lm, "WINDOW", 512)
    monkeypatch.setattr(lm, "BATCH", 128)
    monkeypatch.setattr(lm, "FREQUENT", 200)
    monkeypatch.setattr(lm, "SINGLE", 30)
    monkeypatch.setattr(lm, "HEADS", 62)
    found = []
    for parts, shuffles in ((2, 3), (24, 7)):
        monkeypatch.setattr(lm, "STEP", 1 << 20 if parts == 2 else 3000)
        spark.conf.set("spark.sql.shuffle.partitions", shuffles)
        try:
            found.append(Counter(tuple(r) for r in lm.score(docs.repartition(parts)).collect()))
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", 4)
    key = lambda r: (str(r[:5]), r[5], r[6])
    one, two = (sorted(f.elements(), key=key) for f in found)
    assert [r[:5] for r in one] == [r[:5] for r in two]
    assert np.allclose([r[5:] for r in one], [r[5:] for r in two], rtol=1e-9, atol=0)


def test_lm_scores_by_the_models_own_numbers(spark, docs, rows, monkeypatch):
    """Scores from the trained parameters by plain sums over the whole vocabulary."""
    monkeypatch.setattr(lm, "SHARD", 4000)
    monkeypatch.setattr(lm, "FREQUENT", 150)
    monkeypatch.setattr(lm, "SINGLE", 20)
    monkeypatch.setattr(lm, "HEADS", 42)
    states = []
    train = lm.train
    monkeypatch.setattr(lm, "train", lambda *a: states.append((train(*a), a[1])) or states[-1][0])
    got = Counter((r["doc_id"], round(r["score"], 4)) for r in lm.score(docs).collect())
    (state, table), counts = states[0], Counter()
    for i, t in rows:
        if zlib.crc32(("" if i is None else str(i)).encode()) % 10:
            counts.update(lm_tokens(t))
    model, values = state.trainer.model, state.members.values.astype(float)
    assert table.members > 1 and abs(model.far).max() > 0.11
    number = lambda w: int(table.head_ids(np.array([table.index.get(w, -1)]))[0])
    other_n = sum(n for w, n in counts.items() if w not in table.index)
    other_v = sum(w not in table.index for w in counts)
    known = {}

    def log(far, near, word):
        if (far, near, word) not in known:
            query = model.far[far].astype(float) + model.near[near]
            logits = model.word @ query + model.bias
            total = logits[number(word)] - math.log(np.exp(logits).sum())
            place = table.index.get(word, -1)
            if place >= table.heads:
                low = (place - table.heads) // table.members * table.members
                mine = values[low : low + table.members] @ np.append(query, 1.0)
                total += mine[place - table.heads - low] - math.log(np.exp(mine).sum())
            if place < 0:
                total += math.log((counts[word] + 0.1) / (other_n + 0.1 * (other_v + 1)))
            known[far, near, word] = total / math.log(10)
        return known[far, near, word]

    expected = Counter()
    for i, t in rows:
        far = near = lm.START
        total = 0.0
        for w in lm_tokens(t):
            total += log(far, near, w)
            far, near = near, number(w)
        expected[i, round(total, 4)] += 1
    near_ = lambda a, b: a[0] == b[0] and math.isclose(a[1], b[1], rel_tol=1e-5, abs_tol=1e-3)
    key = lambda x: (x[0] is not None, x[0] or 0, x[1])
    assert all(near_(a, b) for a, b in zip(sorted(got.elements(), key=key), sorted(expected.elements(), key=key), strict=True))


def test_lm_is_normalised():
    frequent = lm.Frequent({b"": 0, b"a": 1, b"b": 2}, np.array([10, 30, 5]), 3, 50, 8, 5, 5)
    model = lm.initial(frequent)
    r = np.random.RandomState(1)
    ids = r.choice([2, 3, 3, 4, 0], 4000)
    first = np.arange(0, 4000, 20)
    trainer = lm.Trainer(model, model.bias)
    before = model.bias.copy()
    trainer.learn(*lm.contexts(ids, first), ids, r)
    a, b, z = model.tables()
    total = np.exp(a[:, None, :] + b[None, :, :] - z[:, :, None])[:6, :6].sum(axis=2)
    assert np.allclose(total, 1, atol=1e-3) and not np.array_equal(before, model.bias)


def test_lm_tells_less_frequent_words_apart(spark):
    fill = [f"f{n}" for n in range(3000)]
    texts = [(1000 + n, " ".join(fill[n * 10 % 3000 : n * 10 % 3000 + 10] + ["left xray", "right yoke"])) for n in range(900)]
    texts += [(2000 + n, " ".join(fill[:1100] * 6)) for n in range(60)]
    held = [i for i in range(1000) if zlib.crc32(str(i).encode()) % 10 == 0]
    probes = dict(zip(held, ["left xray", "left yoke", "right yoke", "right xray"], strict=False))
    rows = lm.score(spark.createDataFrame([*texts, *probes.items()], "doc_id long, text string").repartition(2)).filter("doc_id < 1000").collect()
    got = {probes[r["doc_id"]]: r for r in rows}
    assert all(r["held_out"] and r["n_known"] == 3 for r in rows)
    assert got["left xray"]["score"] > got["left yoke"]["score"] and got["right yoke"]["score"] > got["right xray"]["score"]


def test_lm_classes_are_normalised():
    counts = np.array([90, 80, 9, 8, 7, 6, 5, 4, 3])
    frequent = lm.Frequent({b"%d" % n: n for n in range(9)}, counts, 2, 230, 12, 18, 3, 3)
    model, members = lm.initial(frequent), lm.Members(frequent)
    assert frequent.head_ids(np.array([-1, 0, 1, 2, 4, 5, 8])).tolist() == [0, 2, 3, 4, 4, 5, 6]
    shares = lambda u, v: np.exp(members.logs(model, np.full(7, u), np.full(7, v), np.arange(2, 9)))
    assert np.allclose(shares(1, 2), [9 / 24, 8 / 24, 7 / 24, 6 / 15, 5 / 15, 4 / 15, 1], atol=1e-5)
    for _ in range(20):
        members.learn(model, np.array([1, 3] * 40), np.array([2, 4] * 40), np.array([2, 3] * 40))
    one, two = shares(1, 2), shares(3, 4)
    assert np.allclose([one[:3].sum(), one[3:6].sum(), one[6]], 1, atol=1e-5)
    assert one[0] / one[1] > two[0] / two[1]


# 10


def junk(r, n):
    return [" ".join(x + "###" for x in brute_words(r, 60)) if k % 2 else " ".join(brute_words(r, 60)).upper().replace(" ", "!! ") for k in range(n)]


def brute_words(r, n):
    return ["".join(r.choice("etaoinshr") for _ in range(r.randint(2, 7))) for _ in range(n)]


def test_quality(spark, empty):
    r = random.Random(3)
    texts = [(n, " ".join(brute_words(r, 60)), 1) for n in range(300)] + [(1000 + n, t, 0) for n, t in enumerate(junk(r, 100))]
    docs = spark.createDataFrame([(i, t, "x") for i, t, _ in texts] + [(5000, None, "x"), (5001, "", "x"), (None, "abc", "x"), (1, texts[1][1], "x")], "doc_id long, text string, quality string")
    labels = spark.createDataFrame([(i, q, 0) for i, _, q in texts] + [(1, 0, 0), (7, None, 0), (None, 1, 0), (3, 1, 0)], "doc_id long, quality int, toxic int")
    model = quality.fit(docs, labels)
    got = quality.score(docs, model).collect()
    assert len(got) == 404 and all(0 <= x["score"] <= 1 and x["predicted"] == (x["score"] >= 0.3) for x in got)
    held = {x["doc_id"]: x for x in got if x["held_out"]}
    assert all(zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 0 for i in held)
    right = [held[i]["predicted"] == q for i, _, q in texts if i in held]
    assert sum(right) / len(right) > 0.97
    kept = quality.keep_good(docs, model)
    assert kept.columns == docs.columns and {x["doc_id"] for x in kept.collect()} == {x["doc_id"] for x in got if x["predicted"]}
    assert quality.score(empty, model).count() == 0
    same = quality.fit(docs, labels.filter("quality = 1"))
    assert {round(x["score"], 3) for x in quality.score(docs, same).collect()} == {1.0}
    assert quality.score(docs, quality.fit(docs, labels.limit(0))).first()["score"] == pytest.approx(0.5)


def test_quality_never_sees_held_out_labels(spark):
    r = random.Random(4)
    docs = spark.createDataFrame([(n, " ".join(brute_words(r, 20))) for n in range(60)], "doc_id long, text string")
    flip = lambda flag: spark.createDataFrame([(n, (n % 3 > 0) != (flag and zlib.crc32(str(n).encode()) % 5 == 0)) for n in range(60)], "doc_id long, q boolean").select("doc_id", F.col("q").cast("int").alias("quality"))
    scores = [[x["score"] for x in quality.score(docs, quality.fit(docs, flip(f))).orderBy("doc_id").collect()] for f in (False, True)]
    assert scores[0] == scores[1]


MASK = 2**64 - 1


def plain_mix(h):
    h ^= h >> 32
    h = h * 0xD6E8FEB86659FD93 & MASK
    h ^= h >> 29
    h = h * 0xA24BAED4963EE407 & MASK
    return h ^ h >> 32


def plain_indicators(text):
    """Places of the n-grams of a text: three bytes, and one to three word shapes."""
    found = {plain_mix(text[i] << 16 | text[i + 1] << 8 | text[i + 2]) >> 64 - quality.BITS for i in range(len(text) - 2)}
    shapes, before = [], None
    for word in text.split():
        caps, small = sum(65 <= c <= 90 for c in word), sum(97 <= c <= 122 for c in word)
        marks = min(len(word) - caps - small - sum(c >= 128 for c in word), 4)
        case = 0 if caps == 0 else 1 if caps == 1 else 3 if small == 0 else 2
        shapes.append((((word[-1] if marks else 0) * 5 + marks) * 4 + case) * 2 + (word == before))
        before = word
    for k in (1, 2, 3):
        for i in range(len(shapes) - k + 1):
            h = k
            for shape in shapes[i : i + k]:
                h = plain_mix((h * 31 + shape) & MASK)
            found.add(h >> 64 - quality.BITS)
    return found


def plain_machine(rows, labels):
    """Naive Bayes ratios and the hinge-loss machine by plain dual coordinate descent, until it stands still."""
    size = [quality.ALPHA * quality.SIZE + sum(len(x) for x, y in zip(rows, labels, strict=True) if y == c) for c in (0, 1)]
    counts = [Counter(i for x, y in zip(rows, labels, strict=True) if y == c for i in x) for c in (0, 1)]
    ratio = lambda i: math.log((counts[1][i] + quality.ALPHA) / size[1]) - math.log((counts[0][i] + quality.ALPHA) / size[0])
    vectors = []
    for x in rows:
        v = {i: ratio(i) for i in x}
        norm = math.sqrt(sum(a * a for a in v.values()) + 1e-9)
        vectors.append({i: a / norm for i, a in v.items()})
    weights, alpha = Counter(), [0.0] * len(rows)
    for _ in range(400):
        most = 0.0
        for n, (v, y) in enumerate(zip(vectors, labels, strict=True)):
            if not any(v.values()):
                continue
            sign = 1 if y else -1
            new = min(max(alpha[n] - (sign * sum(weights[i] * a for i, a in v.items()) - 1) / sum(a * a for a in v.values()), 0.0), quality.COST)
            for i, a in v.items():
                weights[i] += (new - alpha[n]) * sign * a
            most = max(most, abs(new - alpha[n]))
            alpha[n] = new
        if most < 1e-7:
            break
    loss = sum(w * w for w in weights.values()) / 2 + quality.COST * sum(max(0.0, 1 - (1 if y else -1) * sum(weights[i] * a for i, a in v.items())) for v, y in zip(vectors, labels, strict=True))
    return vectors, weights, loss


def test_quality_by_plain_descent():
    r = random.Random(6)
    texts = [" ".join(brute_words(r, 14)) for _ in range(30)] + junk(r, 12) + ["É x x Y", "a", "", "### !!", " ".join(brute_words(r, 8)).upper()]
    raw = [t.encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in raw])])
    rows = list(quality.indicators(np.frombuffer(b"".join(raw), np.uint8), offsets))
    plain = [plain_indicators(t) for t in raw]
    assert [x.tolist() for x in rows] == [sorted(x) for x in plain]
    labels = np.array([1] * 28 + [0, 0] + [0] * 11 + [1] + [1, 0, 1, 0, 0])
    vectors, weights, loss = plain_machine(plain, labels)
    ratios = quality.log_count_ratios(rows, labels)
    values = [ratios[x] / math.sqrt(float(ratios[x] @ ratios[x]) + 1e-9) for x in rows]
    assert all(np.allclose(v, [p[i] for i in x.tolist()]) for v, p, x in zip(values, vectors, rows, strict=True))
    got = quality.descend(rows, values, labels)
    margins = np.array([float(got[x] @ v) for x, v in zip(rows, values, strict=True)])
    mine = float(got @ got) / 2 + quality.COST * np.maximum(0, 1 - np.where(labels == 1, 1, -1) * margins).sum()
    assert loss - 1e-6 <= mine <= loss * 1.01
    assert np.allclose(margins, [sum(weights[i] * a for i, a in v.items()) for v in vectors], atol=0.05)
    model = quality.Model(got, ratios, 1.5, -0.25)
    assert all(math.isclose(model.score(x), 1 / (1 + math.exp(-1.5 * m + 0.25)), rel_tol=1e-9) for x, m in zip(rows, margins, strict=True))


def test_quality_of_very_long_texts(spark):
    r = random.Random(7)
    docs = spark.createDataFrame([(n, " ".join(brute_words(r, 40))) for n in range(40)] + [(100 + n, t) for n, t in enumerate(junk(r, 40))] + [(200, " ".join(brute_words(r, 300_000))), (201, "x" * 3_000_000)], "doc_id long, text string")
    labels = spark.createDataFrame([(n, 1) for n in range(40)] + [(100 + n, 0) for n in range(40)] + [(200, 1)], "doc_id long, quality int")
    got = {x["doc_id"]: x for x in quality.score(docs, quality.fit(docs, labels)).collect()}
    assert len(got) == 82 and got[200]["predicted"] == 1 and 0 <= got[201]["score"] <= 1
    assert quality.fit(docs.limit(0), labels).slope == 0.0


# pipeline


def test_pipeline(spark, small):
    import corpus_pipeline

    docs = spark.read.parquet(f"{small}/documents.parquet")
    labels = spark.read.parquet(f"{small}/labels.parquet")
    stages = dict(corpus_pipeline.STAGES)
    good = stages["quality"](spark, docs, small)
    scores = quality.score(docs, quality.fit(docs, labels))
    assert good.columns == docs.columns
    assert {r["doc_id"] for r in good.collect()} == {r["doc_id"] for r in scores.filter("predicted = 1").collect()}

    table = marked(good)
    lines = stages["line_dedup"](spark, good, small)
    expected = {i: v[2] for (i, _, _), v in zip(table, brute.dedup_lines(table), strict=True) if v[1] == 0 or v[1] < v[0]}
    rows = [(r["doc_id"], r["text"], r["n_chars"]) for r in lines.collect()]
    assert lines.columns == docs.columns and {i: t for i, t, _ in rows} == expected and all(n == len(t) for _, t, n in rows)

    table = [(i, t) for i, t, _ in rows]
    first = stages["jaccard_join"](spark, lines, small)
    kept = {table[k][0] for k, v in brute.near_copies(table).items() if v[1] == table[k][0]}
    assert {r["doc_id"] for r in first.collect()} == kept

    table = [(i, t) for i, t in table if i in kept]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    clean = stages["decontamination"](spark, first, small)
    leaking = {k[0] for k in plain_leaks(table, items)}
    assert {r["doc_id"] for r in clean.collect()} == kept - leaking

    last = corpus_pipeline.run(spark, small)
    assert {r["doc_id"] for r in last.filter("parity and round_trip").collect()} == kept - leaking


ODD = "doc_id long, text string, lang string, source string, n_chars int, N_Lines string, n_removed int, node long, bucket string, Held binary, key string, mark string, __key int, words string, held_out string, ids string, n_tokens string"


def odd_tables(spark, folder, rows, labels, items):
    full = [(i, t, None, None if n % 3 else "s", None if n % 5 == 0 else 7, *[None] * 12) for n, (i, t) in enumerate(rows)]
    for name, data, schema in (("documents", full, ODD), ("labels", labels, "doc_id long, quality int, toxic int, text string"), ("benchmark", items, "item_id long, text string, key string")):
        spark.createDataFrame(data, schema).coalesce(1).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def test_stages_of_odd_tables(spark, rows, tmp_path):
    """Nulls, repeated rows, clashing names and odd texts through every stage, each on its own input and in a chain."""
    import corpus_pipeline

    item = "one benchmark item of some eight or nine words"
    more = [(300, f"Before it {item} after it"), (300, f"Before it {item} after it"), (None, item), (301, "a\na\na"), (302, "\n")]
    labels = [(i, n % 2, None, None) for n, (i, _) in enumerate(rows)] + [(None, None, None, None), (0, None, 1, "x")]
    folder = odd_tables(spark, tmp_path, rows + more, labels, [(1, item, None), (1, item, "k"), (None, item, "k"), (2, None, None), (3, "too short", None)])
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, docs, folder)
        assert got.columns == docs.columns and got.schema["n_chars"] == docs.schema["n_chars"], name
        n = {"line_dedup": None, "decontamination": docs.count() - 3}.get(name)
        assert n is None or got.count() == n, name
    table = marked(docs)
    kept = Counter((i, v[2]) for (i, _, _), v in zip(table, brute.dedup_lines(table), strict=True) if v[1] == 0 or v[1] < v[0])
    assert Counter((r["doc_id"], r["text"] or "") for r in dict(corpus_pipeline.STAGES)["line_dedup"](spark, docs, folder).collect()) == kept
    first = dict(corpus_pipeline.STAGES)["jaccard_join"](spark, docs, folder)
    found = brute.near_copies([(i, t) for i, t, _ in table])
    assert first.count() == sum(v[2] == 0 for v in found.values()) + len({v[1] for v in found.values() if v[2]})
    last = corpus_pipeline.run(spark, folder)
    assert last.filter("not parity or not round_trip").count() == 0 and last.filter("doc_id = 300 or doc_id = 301 and n_tokens > 3").count() == 0


def test_stages_of_empty_tables(spark, tmp_path):
    import corpus_pipeline

    folder = odd_tables(spark, tmp_path, [], [], [])
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        got = stage(spark, docs, folder)
        assert got.count() == 0 and (name == "sentencepiece" or got.columns == docs.columns), name
    assert corpus_pipeline.run(spark, folder).count() == 0
