"""Operator 13: the prefix trie of conversations."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st

from seqsieve.llm import turn_trie


def plain_rebuilt(rows):
    """{conv_id: turns} of rows (conv_id, turn, role, text) whose turns are not tied."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    out = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (c % 100 if c >= 0 else -(-c % 100))
        out[c] = own.get(base, [])[:h] + ts[h:]
    return out


def plain_trie(rebuilt):
    members, ends = defaultdict(list), defaultdict(list)
    for c, ts in rebuilt.items():
        for d in range(len(ts) + 1):
            members[tuple(ts[:d])].append(c)
        ends[tuple(ts)].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        leaves[node] = sum(leaves[k] for k in children[node]) or 1
        own = (len(members[node]) - 1) * len(node[-1][1]) if node else 0
        saved[node] = own + sum(saved[k] for k in children[node])
    rows = Counter()
    for node, cs in members.items():
        digest = hashlib.sha256(",".join(map(str, sorted(ends[node]))).encode()).hexdigest()
        rows[min(cs), len(node), min(members[node[:-1]]) if node else None, len(cs), len(children[node]), leaves[node], saved[node], digest] += 1
    return rows


def by_row(frame):
    return Counter(tuple(r) for r in frame.collect())


def table(spark, rows, parts=3):
    full = [(c, t, r, x, "k", 1, "n") for c, t, r, x in rows]
    return spark.createDataFrame(full, "conv_id long, turn long, role string, text string, key string, part long, node string").repartition(parts)


def conversations():
    r = random.Random(2)
    rows = []
    for c in [*range(0, 12), *range(100, 130), *range(205, 225), -7, -100, -130]:
        kind = r.choice(["greeting", "Grüße 𝄞", "", "one two three"])
        rows += [(c, t, r.choice(["user", "assistant"]), kind if t < 2 else f"{kind} {r.randint(0, 2)}") for t in range(r.randint(1, 8))]
    rows += [(300 + n, 0, "user", "hello") for n in range(40)] + [(300 + n, 1, "user", "same") for n in range(40)]  # copies
    rows += [(400, None, None, "first"), (400, 1, "user", None), (401, 5, "user", "x"), (401, 2, "user", "y"), (None, 0, "user", "nobody"), (402, 0, None, None)]
    rows += [(500, t, "user", "long" * (t % 3)) for t in range(3000)] + [(501, t, "user", "long" * (t % 3)) for t in range(2990)]
    return rows


def trie(spark, rows):
    return turn_trie.prefix_trie(turn_trie.with_shared_starts(turn_trie.turn_arrays(table(spark, rows))))


def test_trie_equals_the_plain_one(spark):
    rows = conversations()
    rebuilt = plain_rebuilt(rows)
    expected = plain_trie(rebuilt)
    assert by_row(trie(spark, rows)) == expected
    assert any(not ts for ts in rebuilt.values()) and any(k[3] > 5 and k[1] for k in expected)
    for parts in (1, 17):  # whatever is stitched
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        try:
            assert by_row(trie(spark, rows)) == expected
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", 4)
            spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_ties_repeats_and_empty_tables(spark):
    one = [(1, 0, "user", "a"), (1, 0, "user", "b"), (1, 0, "user", "a"), (2, 0, "user", "a")]
    got, again = (by_row(turn_trie.prefix_trie(turn_trie.turn_arrays(table(spark, x, n)))) for x, n in ((one, 1), (one[::-1], 4)))
    assert got == again and max(k[1] for k in got) == 3
    assert trie(spark, []).count() == 0


def swept(groups):
    """Rows of sorted groups by sweeps and stitches alone."""
    done, waiting, known, pieces, stitch = [], [], {}, defaultdict(bytes), turn_trie.Stitch()
    for part, group in enumerate(groups):
        sweep = turn_trie.Sweep(part)
        for row in group:
            sweep.what(*row)
        sweep.end()
        for kind, *fields, node, parent, _, _, blob in sweep.out:
            if kind == turn_trie.DONE:
                done.append(tuple(fields))
            elif kind == turn_trie.WAITS:
                waiting.append((fields, parent))
            elif kind == turn_trie.KEY:
                known[node] = fields[0]
            elif kind == turn_trie.IDS:
                pieces[node] += blob
            else:
                stitch.what(blob)
    stitch.end()
    for _, *fields, node, parent, _, _, _ in stitch.out:
        known[node] = fields[0]
        if node in pieces:
            ids = turn_trie.array("q", pieces[node])
            fields[7] = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        waiting.append((fields, parent))
    return Counter([*done, *((*f[:2], known[p] if p else None, *f[3:]) for f, p in waiting)])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abc"), max_size=4), max_size=14), st.lists(st.integers(0, 14), max_size=5), st.integers(1, 3))
def test_any_cut_gives_the_same_trie(conversations, cuts, waiting):
    key = lambda ts: b"".join(hashlib.md5(t.encode()).digest() for t in ts)
    rows = sorted((key(ts), [len(t) for t in ts], c) for c, ts in enumerate(conversations))
    edges = [0, *sorted(min(c, len(rows)) for c in cuts), len(rows)]
    before = turn_trie.WAITING
    turn_trie.WAITING = waiting
    try:
        got = swept([rows[a:b] for a, b in zip(edges, edges[1:], strict=False)])
    finally:
        turn_trie.WAITING = before
    assert got == plain_trie({c: [("", t) for t in ts] for c, ts in enumerate(conversations)})
