"""Operator 7, line dedup: an exact set-similarity join of all lines, whose later matches are removed.

A line's tokens are its five-word shingles (the rule for near copies here), so a line is a set and two lines match at
Jaccard similarity 0.8 or more. A line goes if any earlier line matches it, in the order of id, text and line number,
whether or not that line goes as well. A line of one to four words is one token, so it matches lines of the same words;
only lines without any word have no tokens and stay.

1. Rarity: tokens are counted over all lines in 65,536 hash buckets, a table of fixed size. Any order that is the same
   everywhere keeps the join exact; this one puts rare tokens first and common passages last.
2. Lines of one token set are a class (128-bit fingerprint) with its first place; each other member is a later match.
3. Prefix filter: a class of n tokens puts its n - ceil(0.8 n) + 1 rarest into the join; matching classes share one.
   Sets of fewer than ALONE tokens match no set but their own, so their classes need no join.
   Classes that meet at a token are linked if they pass the length filter, the positional filter and a bound from 128
   parity bits (sets differ in at least as many tokens as their bits differ); a token with many classes is cut into
   blocks, and a spanning forest of its links is all that leaves a block. Components of the forests hold all matches.
4. Components are cut into blocks (see components); within a pair of blocks candidates come from shared prefix tokens
   with the positional and the length filter, and Jaccard is verified by whole token sets. A block tells only which
   classes have an earlier match.
5. Texts are built anew without the lines that go.

Lists of lines are broadcast if they are counted and take LIST_BYTES at most, and joined by a shuffle of texts beyond it.

Edge cases: null texts stay null, empty texts empty; a text may lose all lines and is then empty (see dedup_lines);
rows that are alike in id and text are one document and keep the same lines; null ids come first; an empty table gives
no rows; all other columns are kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import free_names, map_batches, materialise, steps, utf8
from .components import block_pairs, blocks, connected_components, split_join
from .licenses import NO_ID, keyed
from .setsim import needed, shingles, similar
from .words import mix

BUCKET_BITS, BLOCK = 16, 256
#: Classes of a block of one token, and lines whose tokens make about one group's work.
TOKEN_BLOCK, GROUP_LINES = 512, 2048
#: Bytes of a line in a broadcast list, with its share of a hash table, and most bytes of such a list.
LINE_BYTES, LIST_BYTES = 128, 128 << 20
#: Most tokens of a bucket whose tokens' rows come together without being summed first.
HOT_TOKENS = 1_000_000
#: Least size of a set that a different set can match: 4 of 5 tokens.
ALONE = 4

LINES = "key long, mark long, line_no int, print_a long, print_b long, size int, bits_a long, bits_b long, tokens array<long>"


def line_offsets(body: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Offsets of the lines of all rows (one more than lines), the row of each line, and its number in the row."""
    feeds = np.flatnonzero(body == 10)
    rows = np.arange(len(offsets) - 1)
    owner = np.concatenate([rows, np.searchsorted(offsets, feeds, side="right") - 1])
    starts = np.concatenate([offsets[:-1], feeds + 1])
    order = np.lexsort((starts, owner))
    starts, owner = starts[order], owner[order]
    return np.append(starts, len(body)), owner, np.arange(len(owner)) - np.searchsorted(owner, rows)[owner]


def _bucket(found: np.ndarray) -> np.ndarray:
    return (found >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(1 << BUCKET_BITS, np.int64)
    for batch in batches:
        body, offsets = utf8(batch.column(0))
        for start, end in steps(offsets):
            at = offsets[start : end + 1]
            part = body[at[0] : at[-1]]
            lines, _, _ = line_offsets(part, at - at[0])
            total += np.bincount(_bucket(shingles(part, lines)[0]), minlength=len(total))
    some = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["bucket", "n"])


def rarity(docs: DataFrame, text_col: str = "text") -> tuple[np.ndarray, np.ndarray]:
    """The rank of each bucket of tokens, by the number of its tokens in all lines, and these numbers; the driver gets the
    fixed table."""
    rows = docs.select(F.col(text_col).alias("text")).transform(map_batches, _counts, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    total = np.zeros(1 << BUCKET_BITS, np.int64)
    total[[r["bucket"] for r in rows]] = [r["n"] for r in rows]
    rank = np.empty(len(total), np.uint16)
    rank[np.argsort(total, kind="stable")] = np.arange(len(total))
    return rank, total


def ordered(found: np.ndarray, of: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct tokens of each row, rarest first, and their rows."""
    place = (of.astype(np.uint64) << np.uint64(40)) | (rank[_bucket(found)].astype(np.uint64) << np.uint64(24)) | ((found >> np.uint64(20)) & np.uint64(0xFFFFFF))
    order = np.argsort(place, kind="stable")
    found, of, place = found[order], of[order], place[order]
    # tokens that agree in row, bucket and 24 bits are put in order of the whole hash
    ties = np.flatnonzero((place[1:] == place[:-1]) & (found[1:] != found[:-1]))
    if len(ties):
        order = np.lexsort((found, place))
        found, of = found[order], of[order]
    new = np.ones(len(found), bool)
    new[1:] = (found[1:] != found[:-1]) | (of[1:] != of[:-1])
    return found[new], of[new]


def prefix(n: np.ndarray) -> np.ndarray:
    """How many of a set's n rarest tokens hold one that it shares with any match."""
    return n - -(-4 * n // 5) + 1


def joined(n: np.ndarray) -> np.ndarray:
    """How many of a set's n rarest tokens go into the join."""
    return np.where(n < ALONE, 0, prefix(n))


def _lines(rank: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            body, offsets = utf8(batch.column(2))
            for start, end in steps(offsets):
                at = offsets[start : end + 1]
                part = body[at[0] : at[-1]]
                lines, owner, number = line_offsets(part, at - at[0])
                found, of = ordered(*shingles(part, lines), rank)
                if not len(found):
                    continue
                first = np.flatnonzero(np.diff(of, prepend=-1))
                line, n = of[first], np.diff(np.append(first, len(of)))
                a = mix(np.add.reduceat(mix(found + np.uint64(0x51ED270B)), first))
                b = mix(np.add.reduceat(mix(found ^ np.uint64(0x7F4A7C159E3779B9)), first) + n.astype(np.uint64))
                bits = [np.bitwise_xor.reduceat(np.where((found >> np.uint64(58)) & np.uint64(1) == half, np.uint64(1) << (found & np.uint64(63)), np.uint64(0)), first) for half in (0, 1)]
                place = np.arange(len(of)) - np.repeat(first, n)
                kept = place < np.repeat(joined(n), n)
                cut = np.concatenate([[0], np.cumsum(joined(n))]).astype(np.int32)
                rows = pa.array(owner[line] + start)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(rows),
                        batch.column(1).take(rows),
                        pa.array(number[line].astype(np.int32)),
                        pa.array(a.astype(np.int64)),
                        pa.array(b.astype(np.int64)),
                        pa.array(n.astype(np.int32)),
                        pa.array(bits[0].view(np.int64)),
                        pa.array(bits[1].view(np.int64)),
                        pa.ListArray.from_arrays(pa.array(cut), pa.array(found[kept].astype(np.int64))),
                    ],
                    names=[c.split()[0] for c in LINES.split(", ")],
                )

    return run


ITEM = ["key", "mark", "line_no", "print_a", "print_b", "root", "n_blocks", "block"]
ITEMS = "key long, mark long, line_no int, print_a long, print_b long, root long, n_blocks int, block int, held binary"


def _token_sets(rank: np.ndarray):
    """The token sets, rarest first, of the lines that a text's list asks for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, offsets = utf8(batch.column(0))
            for start, end in steps(offsets):
                rows: list[dict] = []
                lines: list[str] = []
                for text, wanted in zip(pc.fill_null(batch.column(0)[start:end], "").to_pylist(), batch.column(1)[start:end].to_pylist(), strict=True):
                    parts = text.split("\n")
                    rows += wanted
                    lines += [parts[w["line_no"]] for w in wanted]
                body, at = utf8(pa.array(lines, pa.large_string()))
                found, of = ordered(*shingles(body, at), rank)
                cut = np.searchsorted(of, np.arange(len(lines) + 1))
                held = [found[cut[i] : cut[i + 1]].tobytes() for i in range(len(lines))]
                kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32()]
                yield pa.RecordBatch.from_arrays([*(pa.array([r[c] for r in rows], k) for c, k in zip(ITEM, kinds, strict=True)), pa.array(held, pa.binary())], names=[*ITEM, "held"])

    return run


def _roots(parent: np.ndarray) -> np.ndarray:
    while (up := parent[parent]).tobytes() != parent.tobytes():
        parent = up
    return parent


def _met(table: pa.Table) -> pa.Table:
    """A spanning forest of the links of one group's tokens: each class with the root of its tree."""
    order = np.argsort(table.column("token").to_numpy(), kind="stable")
    table = table.take(pa.array(order))
    token, name, side, size, place = (table.column(c).to_numpy() for c in ("token", "print_a", "side", "size", "place"))
    bits = [table.column(c).to_numpy().view(np.uint64) for c in ("bits_a", "bits_b")]
    size, rest = size.astype(np.int64), size.astype(np.int64) - place
    parent, alive = np.arange(len(token)), np.arange(len(token))
    for ahead in range(1, len(token)):
        alive = alive[alive < len(token) - ahead]
        alive = alive[token[alive] == token[alive + ahead]]
        if not len(alive):
            break
        left = alive[(side[alive] == 0) | (side[alive] != side[alive + ahead])]
        right = left + ahead
        need = needed(size[left], size[right])
        differ = sum(np.bitwise_count(b[left] ^ b[right]).astype(np.int64) for b in bits)
        good = (np.minimum(rest[left], rest[right]) >= need) & (np.minimum(size[left], size[right]) >= need) & (differ <= size[left] + size[right] - 2 * need)
        left, right = left[good], right[good]
        parent = _roots(parent)
        ends = np.stack([parent[left], parent[right]], axis=1)
        for a, b in np.unique(ends[ends[:, 0] != ends[:, 1]], axis=0).tolist():
            while parent[a] != a:
                a = parent[a]
            while parent[b] != b:
                b = parent[b]
            if a != b:
                parent[max(a, b)] = min(a, b)
    parent = _roots(parent)
    some = np.flatnonzero(name != name[parent])
    return pa.table({"a": name[some], "b": name[parent[some]]})


def candidates(sets: list[np.ndarray], side: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs that share a prefix token and pass the positional and the length filter; sets are ordered by rarity."""
    size = np.array([len(s) for s in sets], np.int64)
    first = prefix(size)
    token = np.concatenate([s[:n] for s, n in zip(sets, first, strict=True)])
    item = np.repeat(np.arange(len(sets)), first)
    rest = np.repeat(size, first) - (np.arange(len(token)) - np.repeat(np.cumsum(first) - first, first))
    order = np.argsort(token, kind="stable")
    token, item, rest = token[order], item[order], rest[order]
    cut = np.append(np.flatnonzero(np.diff(token, prepend=token[:1] + np.uint64(1))), len(token))
    may = np.zeros((len(sets), len(sets)), bool)
    for a, b in zip(cut[:-1], cut[1:], strict=True):
        if b - a > 1:
            of, left = item[a:b], rest[a:b]
            need = needed(size[of][:, None], size[of][None, :])
            may[np.ix_(of, of)] |= (np.minimum(left[:, None], left[None, :]) >= need) & (np.minimum(size[of][:, None], size[of][None, :]) >= need)
    if side.any():
        may &= side[:, None] != side[None, :]
    return np.nonzero(np.triu(may, 1))


def _matched(table: pa.Table) -> pa.Table:
    """Classes with an earlier match in the components, or in the pair of blocks, of one group."""
    roots = table.column("root").to_numpy()
    order = np.argsort(roots, kind="stable")
    table, roots = table.take(pa.array(order)), roots[order]
    key, mark, line, a, b, side = (table.column(c).to_numpy() for c in ("key", "mark", "line_no", "print_a", "print_b", "side"))
    held = table.column("held").to_pylist()
    cut = np.append(np.flatnonzero(np.diff(roots, prepend=np.nan)), len(roots))
    late: list[np.ndarray] = []
    for low, high in zip(cut[:-1], cut[1:], strict=True):
        rows = np.array(list({(a[i], b[i]): i for i in range(low, high)}.values()))  # a row that is repeated counts once
        if len(rows) < 2:
            continue
        sets = [np.frombuffer(held[i], np.uint64) for i in rows]
        left, right = candidates(sets, side[rows])
        good = similar(sets, left, right)
        order = np.empty(len(rows), np.int64)
        order[np.lexsort((line[rows], mark[rows], key[rows]))] = np.arange(len(rows))
        left, right = left[good], right[good]
        late.append(rows[np.unique(np.where(order[left] > order[right], left, right))])
    found = np.concatenate(late) if late else np.zeros(0, np.int64)
    return pa.table({"print_a": a[found], "print_b": b[found]})


def _shared(tokens: DataFrame, hot: np.ndarray, total: int) -> DataFrame:
    """token, print_a, its first place and n_blocks of the tokens that several classes have. Tokens of buckets that hold
    HOT_TOKENS tokens at most meet in one step; those of `hot` buckets are summed by class first, and a token of many
    classes is no single task's work."""
    same = Window.partitionBy("token")
    n_blocks = F.ceil(F.col("n") / TOKEN_BLOCK).cast("int").alias("n_blocks")
    is_hot = F.shiftrightunsigned("token", 64 - BUCKET_BITS).isin([int(x) for x in hot])
    few = (tokens.filter(~is_hot) if len(hot) else tokens).withColumns({"low": F.min("print_a").over(same), "high": F.max("print_a").over(same)}).filter("low < high")
    few = few.groupBy("token", "print_a").agg(F.min("place").alias("place")).withColumn("n", F.count("*").over(same))
    few = few.select("token", "print_a", "place", n_blocks)
    if not len(hot):
        return few
    many = tokens.filter(is_hot).groupBy("token", "print_a").agg(F.min("place").alias("place"))
    many = split_join(many, many.groupBy("token").agg(F.count("*").alias("n")).filter("n > 1"), "token", "print_a", total)
    return few.unionByName(many.select("token", "print_a", "place", n_blocks))


def _maybe(df: DataFrame, lines: int) -> DataFrame:
    """df, a table of lists with this number of lines, to be broadcast if it takes LIST_BYTES at most."""
    return F.broadcast(df) if lines * LINE_BYTES <= LIST_BYTES else df


def later_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """key, mark (see licenses.keyed) and line_no of every line that goes; a written table."""
    rank, totals = rarity(docs, text_col)
    texts = keyed(docs, id_col, text_col).select("key", "mark", "text")
    lines = materialise(texts.transform(map_batches, _lines(rank), LINES), "lines")
    place = F.min(F.struct("key", "mark", "line_no")).alias("place")
    first = lines.groupBy("print_a", "print_b").agg(place).select("print_a", "print_b", "place.*")
    first = materialise(first, "first-lines")

    tokens = lines.select("print_a", F.posexplode("tokens").alias("place", "token"))
    shared = _shared(tokens, np.flatnonzero(totals > HOT_TOKENS), int(totals.sum()))
    light = lines.groupBy("print_a").agg(F.first("size").alias("size"), F.first("bits_a").alias("bits_a"), F.first("bits_b").alias("bits_b"))
    shared = shared.join(light, "print_a").withColumn("block", F.pmod(F.xxhash64("print_a"), F.col("n_blocks")).cast("int"))
    groups = max(1, lines.count() // GROUP_LINES)
    links = block_pairs(shared, groups, "token").groupBy("part", "pair").applyInArrow(_met, "a long, b long")
    members = connected_components(links)

    items = blocks(members, BLOCK).withColumnRenamed("node", "print_a").join(first, "print_a")
    items = materialise(items.groupBy("key", "mark").agg(F.collect_list(F.struct(*ITEM)).alias("wanted")), "line-members")
    n_items = items.agg(F.sum(F.size("wanted"))).first()[0] or 0
    sets = texts.join(_maybe(items, n_items), ["key", "mark"]).select("text", "wanted").transform(map_batches, _token_sets(rank), ITEMS)
    pairs = block_pairs(sets, max(1, n_items // (2 * BLOCK)))
    matched = pairs.groupBy("part", "pair").applyInArrow(_matched, "print_a long, print_b long").distinct()
    matched = materialise(matched, "matched-lines").withColumn("late", F.lit(True))

    told = first.withColumnsRenamed({"key": "key_1", "mark": "mark_1", "line_no": "line_1"}).join(matched, ["print_a", "print_b"], "left")
    own = (F.col("key") == F.col("key_1")) & (F.col("mark") == F.col("mark_1")) & (F.col("line_no") == F.col("line_1"))
    gone = lines.drop("tokens").join(told, ["print_a", "print_b"]).filter(F.col("late").isNotNull() | ~own)
    return materialise(gone.select("key", "mark", "line_no"), "later-lines")


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", counts: tuple[str, str] = ("n_lines", "n_removed")) -> DataFrame:
    """docs with their later lines removed from the text, and two columns more: the number of lines before, and of those
    that went. A text of which all lines went is empty and has as many removed as it had lines. counts: names of these
    columns; where docs has such a column, in any case of letters, underscores are put before the name."""
    gone = later_lines(docs, id_col, text_col)
    n_gone = gone.count()
    key, mark, late, *counts = free_names(docs, "__key", "__mark", "__late", *counts)
    by_text = gone.groupBy(F.col("key").alias(key), F.col("mark").alias(mark)).agg(F.collect_set("line_no").alias(late))
    same = (F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)) == F.col(key)) & (F.xxhash64(text_col) == F.col(mark))
    joined = docs.join(_maybe(by_text, n_gone), same, "left")
    columns = docs.columns
    schema = T.StructType([*docs.schema.fields, *(T.StructField(c, T.LongType()) for c in counts)])
    place = columns.index(text_col)

    def rebuilt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, numbers = batch.column(place).to_pylist(), batch.column(len(columns)).to_pylist()
            for i, (text, lines) in enumerate(zip(texts, numbers, strict=True)):
                if lines is not None:
                    drop = set(lines)
                    texts[i] = "\n".join([x for n, x in enumerate(text.split("\n")) if n not in drop])
            before = pc.add(pc.count_substring(pc.fill_null(batch.column(place), ""), "\n").cast(pa.int64()), 1)
            arrays = [pa.array(texts, batch.column(place).type) if i == place else c for i, c in enumerate(batch.columns[:-1])]
            removed = pa.array([len(x) if x is not None else 0 for x in numbers], pa.int64())
            yield pa.RecordBatch.from_arrays([*arrays, before, removed], names=schema.names)

    return joined.select(*(F.col(f"`{c}`") for c in columns), late).transform(map_batches, rebuilt, schema)
