"""Operator 13, conversation prefix trie: conversations as arrays of turns, sorted over the whole cluster, whose common
prefixes become the nodes of a trie.

A turn is told by 128 bits of its role and text and by the text's number of code points, so no text is shuffled; a
conversation is its turns' digests one after the other. These keys are range-sorted, equal ones by conv_id. Each task goes
over its sorted rows once: the common prefix with the row before (LCP) says which nodes end there, and a stack holds the
nodes that are open. A node that ends within a task is written with all its figures. The nodes on the paths of a task's
first and last row may go on in a neighbour: of these only partial figures are written, a row for each task, and one more
sweep over these rows (as many as there are tasks) stitches the open stacks together. Nodes that ended in a task below
one that was open get their parent's id by a join.

The hash of a node's members is over a list in order, so it cannot be merged: members of a node that spans tasks are
written as arrays of numbers, and one task hashes them as they stream by, in bounded memory.

A conversation is one row of 16 bytes and a number for each turn, which one task holds; that is the largest thing that is
held of the input, besides a task's ids of one sequence.

Edge cases: rows without conv_id are left out; null roles and texts are empty; null turns come first, and turns of one number
in the order of their digests; repeated rows are turns of their own; a conversation without turns is a member of the root
only; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, measured

#: Bytes of a turn's digest, turns at most that are taken from another conversation, and how many ids share one such.
WIDTH, SHARED, STRIDE = 16, 5, 100
#: Rows of a batch, children that wait for their parent in memory, and ids of a written piece.
ROWS, WAITING, PIECE = 5_000, 10_000, 100_000
NOTHING = hashlib.sha256(b"").hexdigest()

FIELDS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
#: What a sweep writes: finished nodes (their parent's conv_id known), nodes whose parent is told by its key only, keys of
#: nodes with their conv_id, pieces of members' ids, and the open nodes of a task.
DONE, WAITS, KEY, IDS, OPEN = range(5)
SCHEMA = pa.schema(
    [("kind", pa.int32()), *((f, pa.string() if f == "ends_sha256" else pa.int64()) for f in FIELDS), ("node", pa.string()), ("parent", pa.string()), ("part", pa.int64()), ("seq", pa.int64()), ("blob", pa.binary())]
)
DDL = "kind int, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string, node string, parent string, part long, seq long, blob binary"


def turn_arrays(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv_id and turns, an array of (digest in hexadecimal, code points) in order."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    digest = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    place = F.struct(F.col(turn_col).isNotNull().alias("known"), F.col(turn_col).alias("turn"), digest.alias("digest"), F.length(text).alias("length"))
    rows = turns.select(F.col(conv_col).cast("long").alias("conv_id"), place.alias("t")).filter("conv_id is not null")
    listed = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("ts"))
    return listed.select("conv_id", F.transform("ts", lambda t: F.struct(t["digest"].alias("digest"), t["length"].alias("length"))).alias("turns"))


def with_shared_starts(arrays: DataFrame) -> DataFrame:
    """Conversations whose first turns are another's: of conversation c the first h = crc32(c) % 6 turns are those of
    conversation c - c % 100, as far as it has them."""
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (SHARED + 1)).cast("int")
    base = arrays.filter(F.col("conv_id") % STRIDE == 0).select(F.col("conv_id").alias("base"), F.slice("turns", 1, SHARED).alias("first"))
    own = arrays.select("conv_id", "turns", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % STRIDE).alias("base"))
    first = F.coalesce(F.slice("first", F.lit(1), F.col("h")), F.slice("turns", 1, 0))
    rest = F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns") - F.col("h"), F.lit(0)))
    return own.join(base, "base", "left").select("conv_id", F.concat(first, rest).alias("turns"))


class _Node:
    __slots__ = ("depth", "length", "conv_id", "n", "children", "leaves", "saved", "ends", "first", "key", "held")

    def __init__(self, depth: int, length: int, first: bool = False):
        self.depth, self.length, self.first = depth, length, first
        self.conv_id: int | None = None  # the smallest member
        self.n = self.children = self.leaves = self.saved = 0
        self.ends: str | None = None
        self.key: str | None = None  # where rows wait for this node by its key
        self.held: list[tuple] = []

    def partial(self) -> list:
        return [self.depth, self.length, self.conv_id, self.n, self.children, self.leaves, self.saved, self.ends]

    def merge(self, other: list) -> None:
        _, _, conv_id, n, children, leaves, saved, ends = other
        self.conv_id = conv_id if self.conv_id is None else self.conv_id if conv_id is None else min(conv_id, self.conv_id)
        self.n, self.children, self.leaves, self.saved, self.ends = self.n + n, self.children + children, self.leaves + leaves, self.saved + saved, self.ends or ends

    def close(self, parent: _Node | None) -> None:
        """Figures of the whole subtree, and what they add to the parent's."""
        self.saved += (self.n - 1) * self.length
        self.leaves = self.leaves or 1
        if parent is not None:
            parent.merge([0, 0, self.conv_id, self.n, 1, self.leaves, self.saved, None])

    def row(self) -> tuple:
        return self.conv_id, self.depth, None, self.n, self.children, self.leaves, self.saved, self.ends or NOTHING


def prefix_keys(key: bytes) -> list[str]:
    """A key for each node on a path, the root's first."""
    h, out = hashlib.md5(), []
    out.append(h.hexdigest())
    for i in range(0, len(key), WIDTH):
        h.update(key[i : i + WIDTH])
        out.append(h.copy().hexdigest())
    return out


def shared_turns(a: bytes, b: bytes) -> int:
    size = min(len(a), len(b))
    if a[:size] == b[:size]:
        return size // WIDTH
    i = 0
    while a[i : i + WIDTH] == b[i : i + WIDTH]:
        i += WIDTH
    return i // WIDTH


class Sweep:
    """One task's rows in order: what() takes a row, end() the rest; out holds rows of SCHEMA as tuples."""

    def __init__(self, part: int):
        self.part, self.out = part, []
        self.first = self.key = None
        self.path: list[_Node] = []
        self.open: list[list] = []
        self.group, self.in_first, self.pieces = array("q"), True, 0

    def _put(self, kind: int, row: tuple = (None,) * 8, node: str | None = None, parent: str | None = None, seq: int | None = None, blob: bytes | None = None) -> None:
        self.out.append((kind, *row, node, parent, self.part, seq, blob))

    def _key(self, node: _Node) -> str:
        """A node on the present path."""
        if node.key is None:
            node.key = hashlib.md5(self.key[: node.depth * WIDTH]).hexdigest()
        return node.key

    def _waits(self, node: _Node) -> None:
        key = self._key(node)
        for row in node.held:
            self._put(WAITS, row, parent=key)
        node.held = []

    def _pieces(self, key: bytes) -> None:
        node = hashlib.md5(key).hexdigest()
        for i in range(0, len(self.group), PIECE):
            self._put(IDS, node=node, seq=self.pieces, blob=self.group[i : i + PIECE].tobytes())
            self.pieces += 1
        self.group = array("q")

    def _group_ends(self) -> None:
        """Of the ids of one sequence: those of the first and the last may go on in another task."""
        if self.in_first:
            self._pieces(self.key)
            self.in_first = False
        else:
            self.path[-1].ends = hashlib.sha256(",".join(map(str, self.group)).encode()).hexdigest()
            self.group = array("q")

    def _close(self) -> None:
        node = self.path.pop()
        if node.first:
            self._waits(node)
            self.open.append(node.partial())
            return
        parent = self.path[-1]
        node.close(parent)
        for row in node.held:
            self._put(DONE, (*row[:2], node.conv_id, *row[3:]))
        if node.key is not None:  # children were written before
            self._put(KEY, (node.conv_id, *(None,) * 7), node=node.key)
        parent.held.append(node.row())
        if parent.first or len(parent.held) >= WAITING:
            self._waits(parent)

    def what(self, key: bytes, lengths: list[int], conv_id: int) -> None:
        depth = len(key) // WIDTH
        if self.first is None:
            self.first = key
            self.path = [_Node(d, lengths[d - 1] if d else 0, True) for d in range(depth + 1)]
        elif key != self.key:
            self._group_ends()
            keep = shared_turns(self.key, key)
            while len(self.path) > keep + 1:
                self._close()
            self.path += [_Node(d, lengths[d - 1]) for d in range(keep + 1, depth + 1)]
        self.key = key
        leaf = self.path[-1]
        leaf.n += 1
        leaf.conv_id = conv_id if leaf.conv_id is None else min(leaf.conv_id, conv_id)
        self.group.append(conv_id)

    def end(self) -> None:
        if self.first is None:
            return
        self._pieces(self.key)
        for node in self.path:
            self._waits(node)
        left = self.open[::-1] + [n.partial() for n in self.path if n.first]
        left.sort(key=lambda p: p[0])
        last = [n.partial() for n in self.path if not n.first]
        self._put(OPEN, blob=json.dumps({"first": self.first.hex(), "last": self.key.hex(), "left": left, "right": last}).encode())


class Stitch:
    """The open nodes of all tasks, in the tasks' order."""

    def __init__(self):
        self.path: list[_Node] = []
        self.key, self.out = b"", []

    def _close(self) -> None:
        node = self.path.pop()
        parent = self.path[-1] if self.path else None
        node.close(parent)
        self.out.append((WAITS, *node.row(), node.key, parent.key if parent else None, None, None, None))

    def _take(self, partials: list[list], key: bytes, keep: int) -> None:
        """Goes from the present path to key's, of which it keeps `keep` turns and the root."""
        while len(self.path) > keep + 1:
            self._close()
        keys = prefix_keys(key)
        for p in partials:
            if p[0] == len(self.path):
                self.path.append(_Node(p[0], p[1]))
                self.path[-1].key = keys[p[0]]
            self.path[p[0]].merge(p)
        self.key = key

    def what(self, blob: bytes) -> None:
        found = json.loads(blob)
        first, last = bytes.fromhex(found["first"]), bytes.fromhex(found["last"])
        self._take(found["left"], first, shared_turns(self.key, first) if self.path else -1)
        self._take(found["right"], last, shared_turns(first, last))

    def end(self) -> None:
        while self.path:
            self._close()


def _batches(made) -> Iterator[pa.RecordBatch]:
    """What a sweep has put out so far, when it is much."""
    while made.out:
        rows, made.out = made.out[:ROWS], made.out[ROWS:]
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), SCHEMA, strict=True)], schema=SCHEMA)


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    sweep = Sweep(TaskContext.get().partitionId())
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in ("key", "lengths", "conv_id")), strict=True):
            sweep.what(*row)
            if len(sweep.out) >= ROWS:
                yield from _batches(sweep)
    sweep.end()
    yield from _batches(sweep)


def _stitch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    stitch = Stitch()
    for batch in batches:
        for blob in batch.column("blob").to_pylist():
            stitch.what(blob)
        yield from _batches(stitch)
    stitch.end()
    yield from _batches(stitch)


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """node and the hash of its ids, of pieces in order; a comma stands between ids of neighbouring pieces too."""
    node, h = None, None
    for batch in batches:
        done: list[tuple[str, str]] = []
        for name, blob in zip(batch.column("node").to_pylist(), batch.column("blob").to_pylist(), strict=True):
            if name != node:
                if node is not None:
                    done.append((node, h.hexdigest()))
                node, h = name, hashlib.sha256()
            else:
                h.update(b",")
            h.update(",".join(map(str, array("q", blob))).encode())
        if done:
            yield pa.RecordBatch.from_pydict({"node": [d[0] for d in done], "whole": [d[1] for d in done]})
    if node is not None:
        yield pa.RecordBatch.from_pydict({"node": [node], "whole": [h.hexdigest()]})


def prefix_trie(arrays: DataFrame) -> DataFrame:
    """A row for each node with the columns of FIELDS. arrays: conv_id, each one once, and turns, as turn_arrays() has
    them.

    n_convs: conversations that start with the node's turns (members); conv_id: the smallest of them; parent_conv_id:
    the parent's; n_children; n_leaves: childless nodes in the subtree; saved_tokens: over the subtree, (n_convs - 1)
    times the code points of a node's last text; ends_sha256: of the members that have no further turn."""
    key = F.unhex(F.array_join(F.transform("turns", lambda t: t["digest"]), "")).alias("key")
    rows = materialise(arrays.select(key, F.transform("turns", lambda t: t["length"]).alias("lengths"), "conv_id"), "turn-keys")
    placed = rows.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
    swept = materialise(placed.mapInArrow(_sweep, DDL), "trie")
    open_nodes = swept.filter(F.col("kind") == OPEN).select("part", "blob").coalesce(1).sortWithinPartitions("part")  # a row for each task
    stitched = materialise(open_nodes.mapInArrow(_stitch, DDL), "trie-open")
    pieces = swept.filter(F.col("kind") == IDS).select("node", "part", "seq", "blob")
    ends = pieces.repartition("node").sortWithinPartitions("node", "part", "seq").mapInArrow(_hashed, "node string, whole string")
    whole = stitched.join(measured(materialise(ends, "trie-ends")), "node", "left").withColumn("ends_sha256", F.coalesce("whole", "ends_sha256"))
    waiting = swept.filter(F.col("kind") == WAITS).select(*FIELDS, "parent").unionByName(whole.select(*FIELDS, "parent"))
    known = swept.filter(F.col("kind") == KEY).select("node", "conv_id").unionByName(stitched.select("node", "conv_id"))
    known = measured(known.select(F.col("node").alias("parent"), F.col("conv_id").alias("known")))
    named = waiting.join(known, "parent", "left").withColumn("parent_conv_id", F.col("known"))
    return swept.filter(F.col("kind") == DONE).select(*FIELDS).unionByName(named.select(*FIELDS))
