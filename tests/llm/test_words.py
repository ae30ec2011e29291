"""Operator 11: spelling variants."""

import itertools
import random
import zlib
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from seqsieve.llm import spelling


def one_apart(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) - len(short) == 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def plain_words(rows, least, often):
    counts = Counter()
    for i, text in rows:
        for run in spelling.RUN.findall("".join(c.lower() if c.isascii() else c for c in text or "")):
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            at = h % len(run)
            counts[run if h % 199 else run[:at] + run[at + 1 :]] += 1
    return {w: n for w, n in counts.items() if len(w) >= least and n >= often}


def plain_variants(n):
    near = {w: [v for v in n if one_apart(w, v)] for w in n}
    best = {w: min(vs, key=lambda v: (-n[v], v)) for w, vs in near.items() if vs}
    form = {w: v for w, v in best.items() if n[v] >= 5 * n[w]}
    out = Counter()
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out[w, form.get(w), root, n[w], len(near[w]), n[form[w]] if w in form else None] += 1
    return out


def by_row(frame):
    return Counter(tuple(r) for r in frame.collect())


def test_variants_equal_the_plain_ones(spark, docs, rows, empty):
    found = by_row(spelling.spelling_variants(docs, min_length=2, min_count=1))
    assert found == plain_variants(plain_words(rows, 2, 1)) and any(k[1] for k in found) and any(k[4] > 1 for k in found)
    assert by_row(spelling.spelling_variants(docs)) == plain_variants(plain_words(rows, 6, 5))
    assert spelling.spelling_variants(empty).count() == 0


def test_chains_ties_letters_and_hot_halves(spark):
    r = random.Random(5)
    rows = [(1, "Abcdef " * 200 + "abcdeg " * 40 + "abcdegh " * 8), (None, "xbcdef " * 40 + "ÀÉÎÕÜ× àéîõüç " * 6), (3, None), (3, ""), (-4, "café-crème crèmes crême " * 30)]
    rows += [(n, " ".join("".join(r.choice("abé") for _ in range(r.randint(6, 8))) for _ in range(400))) for n in range(10, 14)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    expected = plain_variants(plain_words(rows, 6, 5))
    assert by_row(spelling.spelling_variants(docs)) == expected
    words = spelling.word_counts(docs).cache()
    near = {(w, k) for (w, _, _, _, k, _) in expected if k}
    for hot, group in ((2, 100_000), (5, 40), (10_000, 10)):  # halves that are split once more, and many groups
        assert {(x["word"], x["n_near"]) for x in spelling.near_summary(words, group, hot).collect()} == near


@settings(max_examples=60, deadline=None)
@given(st.sets(st.text("abÿ", min_size=1, max_size=7), max_size=40))
def test_automata_number_words_and_meet_all_pairs(words):
    listed = sorted(w.encode("latin-1") for w in words)
    automaton = spelling.Automaton(listed)
    for number, w in enumerate(listed):
        state, total = np.array([automaton.root]), 0
        for c in w:
            on, state, more = automaton.step(state, np.array([c]))
            assert len(on) == 1
            total += int(more[0])
        assert automaton.final[state[0]] and total == number
    n = np.array([len(w) for w in listed], np.int64)
    none, all_ = np.zeros(len(n), np.int64), np.ones(len(n), bool)
    got = [*zip(*spelling.near_words(listed, False, n // 2, n + 1, all_), strict=True), *zip(*spelling.near_words(listed, True, none, n // 2, all_), strict=True)]
    wanted = {(a, b) for a, b in itertools.permutations(range(len(n)), 2) if n[a] <= n[b] and one_apart(listed[a], listed[b])}
    assert len(got) == len(set(got)) and set(got) == wanted


def test_runs_of_any_length(spark):
    long = "q" * 50_000
    docs = spark.createDataFrame([(n, f"{long} {long[:-1]}x") for n in range(6)], "doc_id long, text string")
    assert by_row(spelling.spelling_variants(docs)) == plain_variants(plain_words([(n, f"{long} {long[:-1]}x") for n in range(6)], 6, 5))
