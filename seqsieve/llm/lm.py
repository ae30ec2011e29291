"""Operator 9, language-model scores: a log-bilinear model trained by noise-contrastive estimation.

Tokens are words between white space (A-Z lower-cased) and one end for each text. Rows whose crc32(id as text) modulo
HELD_OUT is 0 are held out; all others are learnt from.

1. Counts of all training tokens, in Spark. The SINGLE most frequent short words are numbers of the model by themselves.
   The other words of the table of frequent words (all above a level of counts, FREQUENT at most) are put by count into
   classes of one size, and each class is a number as well. Words outside the table are the class OTHER, and a word's
   share of OTHER comes from its count, smoothed by SMOOTH.
2. The model predicts a token from the two before it: exp(b[w] + (A[u] + B[v]) . R[w]). It starts from the unigram
   distribution and is trained in numpy by noise-contrastive estimation with noise words shared in a batch. Training
   rows are dealt by hash to shards of about SHARD tokens, and shards to ROUNDS rounds; each round begins with the
   parameters (and learning rates' sums) of the one before, every shard learns a copy in the order of its rows' ids and
   hashes, and the copies' mean, weighted by tokens, is the round's result. Sums are of whole numbers (values in steps
   of 1 / FINE), so they don't depend on their order: the model is the same however rows are partitioned. Shards keep
   their size as a corpus grows, so each copy learns as much; what a task holds is one copy.
   A class's words have vectors T and biases of their own: the share of w in its class is exp(t[w] + (A[u] + B[v]) . T[w])
   over the sum of the class, from the counts' shares on, learnt by exact gradients and averaged in the same way. As a
   context such a word is its class.
3. Scores: exp(A[u] . R[w]) and exp(B[v] . R[w] + b[w]) are matrices over the vocabulary, and their product holds the
   normaliser of every context, so each token's log-probability is exact and normalised.
4. Texts are cut into words twice: to count, and to write their words' numbers as a table, which training and scoring
   read. Rare words' counts come by a join: frequent words are a broadcast table of fixed size, and only rarer words of
   each text are shuffled to their counts.

Edge cases: null and empty texts are one end token; a null id counts as an empty text for the held-out rule; repeated
rows are learnt from and scored each; without training rows counts are 0 and V is 0, so each token has probability
SMOOTH / SMOOTH = 1 and base_score is 0; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, materialise, steps, utf8
from .licenses import NO_ID
from .parts import coded, with_ends
from .quality import held_out as remainder_is_0
from .words import DARK_BYTES, lower_ascii

HELD_OUT, SMOOTH = 10, 0.1
#: Most numbers of the model (OTHER, START, words and classes), width of its vectors, and words that are broadcast with
#: counts; words that are no class's.
HEADS, WIDTH, FREQUENT = 2048, 16, 1 << 17
SINGLE = 1022
#: Numbers of a piece of the parameters as they are summed, and sums of each piece before the last one.
PIECE, SALTS = 1 << 16, 4
#: Bytes of the longest word that may be broadcast: bounds that table.
LONGEST = 64
#: Tokens of a shard, most rounds, steps of a parameter of size 1, and tokens that weigh 1 in the mean.
SHARD, ROUNDS, FINE, WEIGHT = 1 << 22, 4, 1 << 20, 1 << 18
OTHER, START, END = 0, 1, 2
BATCH, NOISE, RATE, CLASS_RATE = 8192, 25, 0.03, 0.1
#: Tokens that a shard learns from before its classes take a step, and text bytes of a step of counting.
WINDOW, STEP = 16 * BATCH, 4 << 20
#: Words that a task counts before it passes the counts on.
FLUSH = 300_000
END_WORD = b""


#: Fixed value: what separates words.
WHITE = b" \t\n\x0b\x0c\r"


def words_of(column) -> tuple[np.ndarray, list[bytes], np.ndarray]:
    """The words of a column of texts: the number of each among the distinct ones, these, and how many each text has."""
    body, offsets = utf8(column)
    body = lower_ascii(body)
    dark = DARK_BYTES[body]
    begins = dark.copy()
    begins[1:] &= ~dark[:-1]
    first = offsets[:-1][np.diff(offsets) > 0]
    begins[first] = dark[first]
    starts = np.flatnonzero(begins)
    numbers, found = coded(body, starts, len(body))
    # white space before a text's first word belongs to the word before
    return numbers, [w.rstrip(WHITE) for w in found], np.diff(np.searchsorted(starts, offsets))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter[bytes] = Counter()

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])

    for batch in batches:
        _, offsets = utf8(batch.column(0))
        for start, end in steps(offsets, STEP):
            numbers, names, _ = words_of(batch.column(0)[start:end])
            for word, n in zip(names, np.bincount(numbers, minlength=len(names)).tolist(), strict=True):
                counts[word] += n
            counts[END_WORD] += end - start
            if len(counts) > FLUSH:
                yield out()
                counts.clear()
    yield out()


@dataclass
class Frequent:
    """Words of the broadcast table: their place (the model's vocabulary comes first) and training counts."""

    index: dict[bytes, int]
    counts: np.ndarray
    heads: int
    n: int
    v: int
    other_n: int
    other_v: int
    #: Words of a class; 0: there are no classes.
    members: int = 0

    @property
    def size(self) -> int:
        """Numbers of the model."""
        return 2 + self.heads + (-(-(len(self.counts) - self.heads) // self.members) if self.members else 0)

    def head_ids(self, places: np.ndarray) -> np.ndarray:
        """Numbers in the model of places, where -1 stands for a word that is not in the table."""
        alone = np.where((places >= 0) & (places < self.heads), places + 2, OTHER)
        return np.where(places >= self.heads, self.heads + 2 + (places - self.heads) // self.members, alone) if self.members else alone


@dataclass
class Model:
    """The vectors as (numbers, WIDTH) matrices of the first and second word before, the word itself, and its bias."""

    far: np.ndarray
    near: np.ndarray
    word: np.ndarray
    bias: np.ndarray

    def tables(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Scores of far and near contexts for each word, and the log of each context's normaliser."""
        a, b = self.far @ self.word.T, self.near @ self.word.T + self.bias
        top_a, top_b = a.max(axis=1), b.max(axis=1)
        z = np.exp(a - top_a[:, None]) @ np.exp(b - top_b[:, None]).T
        return a, b, np.log(z) + top_a[:, None] + top_b[None, :]


def initial(frequent: Frequent) -> Model:
    """The unigram distribution, with small vectors; the same in every task."""
    random = np.random.RandomState(11)
    vectors = [random.normal(0, 0.1, (frequent.size, WIDTH)).astype(np.float32) for _ in range(3)]
    share = np.full(frequent.size, 1e-6)
    share[2 : 2 + frequent.heads] += frequent.counts[: frequent.heads]
    share[OTHER] += frequent.other_n
    if frequent.members:
        sums = np.add.reduceat(frequent.counts[frequent.heads :], np.arange(0, len(frequent.counts) - frequent.heads, frequent.members))
        share[2 + frequent.heads : 2 + frequent.heads + len(sums)] += sums
    return Model(*vectors, np.log(share / share.sum()).astype(np.float32))


def contexts(ids: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The two numbers before each token; first marks the first token of each text."""
    near = np.concatenate([[START], ids[:-1]])
    near[first] = START
    far = np.concatenate([[START], near[:-1]])
    far[first] = START
    return far, near


def _summed_rows(rows: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    """For each word the sum of the values (words across) whose row is its number."""
    return np.stack([np.bincount(rows, column, size) for column in values]).T.astype(np.float32)


class Trainer:
    """Noise-contrastive steps with a learning rate for each row that falls with what the row has learnt."""

    def __init__(self, model: Model, unigram: np.ndarray):
        self.model = model
        self.noise = np.exp(unigram.astype(np.float64))
        self.noise /= self.noise.sum()
        self.cumulative = np.cumsum(self.noise)
        self.log_noise = np.log(self.noise * NOISE).astype(np.float32)
        self.learnt = [np.full(len(model.bias), 1e-6, np.float32) for _ in range(4)]

    def _move(self, which: int, values: np.ndarray, gradient: np.ndarray) -> None:
        squares = gradient**2
        self.learnt[which] += squares.mean(axis=1) if squares.ndim == 2 else squares
        rate = np.float32(RATE) / np.sqrt(self.learnt[which])
        values += (rate[:, None] if squares.ndim == 2 else rate) * gradient

    def learn(self, far: np.ndarray, near: np.ndarray, word: np.ndarray, random: np.random.RandomState) -> None:
        """Each token against NOISE words, drawn once for a batch."""
        model, size = self.model, len(self.model.bias)
        for low in range(0, len(word), BATCH):
            u, v, w = far[low : low + BATCH], near[low : low + BATCH], word[low : low + BATCH]
            drawn = np.minimum(np.searchsorted(self.cumulative, random.random_sample(NOISE) * self.cumulative[-1]), size - 1)
            query = model.far[u] + model.near[v]
            mine, others = model.word[w], model.word[drawn]
            margin = np.einsum("ij,ij->i", query, mine) + (model.bias - self.log_noise)[w]
            good = 1 / (1 + np.exp(np.clip(margin, -30, 30)))
            bad = query @ others.T
            bad += (model.bias - self.log_noise)[drawn]
            np.clip(bad, -30, 30, out=bad)
            np.negative(bad, out=bad)
            np.exp(bad, out=bad)
            bad += 1
            np.divide(-1, bad, out=bad)
            to_query = (good[:, None] * mine + bad @ others).T.copy()
            to_word = _summed_rows(w, (good[:, None] * query).T.copy(), size)
            np.add.at(to_word, drawn, bad.T @ query)
            to_bias = np.bincount(w, good, size)
            np.add.at(to_bias, drawn, bad.sum(axis=0))
            self._move(0, model.far, _summed_rows(u, to_query, size))
            self._move(1, model.near, _summed_rows(v, to_query, size))
            self._move(2, model.word, to_word)
            self._move(3, model.bias, to_bias.astype(np.float32))


class Members:
    """The words of classes: their vectors and biases, from the counts' shares on."""

    def __init__(self, frequent: Frequent, values: np.ndarray | None = None):
        self.heads, self.size = frequent.heads, frequent.members
        counts = frequent.counts[self.heads :] if self.size else np.zeros(0)
        if values is None:
            values = np.zeros((len(counts), WIDTH + 1), np.float32)
            values[:, WIDTH] = np.log(np.maximum(counts, 1e-6))
        self.values = values
        self.learnt = np.ones(len(counts), np.float32), np.ones(len(counts), np.float32)

    def _classes(self, model: Model, far: np.ndarray, near: np.ndarray, places: np.ndarray) -> Iterator[tuple]:
        """For each class its first word, its values, its tokens' positions, contexts and words, and their shares."""
        at = np.flatnonzero(places >= self.heads) if self.size else np.zeros(0, np.int64)
        if not len(at):
            return
        at = at[np.argsort(places[at], kind="stable")]
        word = places[at] - self.heads
        of = word // self.size
        query = np.ones((len(at), WIDTH + 1), np.float32)
        query[:, :WIDTH] = model.far[far[at]] + model.near[near[at]]
        cut = np.append(np.flatnonzero(np.diff(of, prepend=-1)), len(of)).tolist()
        for a, b in zip(cut[:-1], cut[1:], strict=True):
            low = int(of[a]) * self.size
            values = self.values[low : low + self.size]
            shares = query[a:b] @ values.T
            shares -= shares.max(axis=1, keepdims=True)
            yield low, values, at[a:b], query[a:b], word[a:b] - low, shares

    def learn(self, model: Model, far: np.ndarray, near: np.ndarray, places: np.ndarray) -> None:
        """One step of each class that has tokens."""
        for low, values, _, query, word, shares in self._classes(model, far, near, places):
            np.exp(shares, out=shares)
            shares /= -shares.sum(axis=1, keepdims=True)
            shares[np.arange(len(word)), word] += 1
            gradient = shares.T @ query
            squares = gradient**2
            high = low + len(values)
            for learnt, part, more in zip(self.learnt, (slice(0, WIDTH), slice(WIDTH, None)), (squares[:, :WIDTH].mean(axis=1), squares[:, WIDTH]), strict=True):
                learnt[low:high] += more
                values[:, part] += (np.float32(CLASS_RATE) / np.sqrt(learnt[low:high]))[:, None] * gradient[:, part]

    def logs(self, model: Model, far: np.ndarray, near: np.ndarray, places: np.ndarray) -> np.ndarray:
        """The natural log of each token's share of its class; 0 for words that are no class's."""
        out = np.zeros(len(places))
        for _, _, at, _, word, shares in self._classes(model, far, near, places):
            mine = shares[np.arange(len(word)), word]
            out[at] = mine - np.log(np.exp(shares, out=shares).sum(axis=1))
        return out


@dataclass
class State:
    """All that a round hands on: parameters, and sums of squares that set the learning rates."""

    trainer: Trainer
    members: Members

    @classmethod
    def begin(cls, frequent: Frequent) -> State:
        model = initial(frequent)
        return cls(Trainer(model, model.bias), Members(frequent))

    def _arrays(self) -> tuple[list[np.ndarray], list[np.ndarray]]:
        model = self.trainer.model
        return [model.far, model.near, model.word, model.bias, self.members.values], [*self.trainer.learnt, *self.members.learnt]

    def flat(self) -> np.ndarray:
        """All parameters and the roots of all sums, one after the other."""
        values, sums = self._arrays()
        return np.concatenate([x.ravel() for x in values] + [np.sqrt(x) for x in sums])

    def load(self, flat: np.ndarray) -> None:
        at, (values, sums) = 0, self._arrays()
        for i, array in enumerate([*values, *sums]):
            part = flat[at : at + array.size].reshape(array.shape)
            array[...] = part if i < len(values) else part**2
            at += array.size


def _numbers(column) -> tuple[np.ndarray, np.ndarray]:
    """The written places of all rows, and the rows' offsets among them."""
    body, offsets = utf8(column)
    return np.frombuffer(body.tobytes(), "<i4").astype(np.int64), offsets // 4


class Learner:
    """One shard's copy: tokens are learnt from in windows of one size, whatever batches they come in."""

    def __init__(self, state: State, shard: int):
        self.state, self.random, self.seen = state, np.random.RandomState(shard % 2**32), 0
        self.kept: list[np.ndarray] = [np.zeros(0, np.int64)] * 4

    def add(self, frequent: Frequent, places: np.ndarray, first: np.ndarray) -> None:
        ids = frequent.head_ids(places)
        self.kept = [np.concatenate(x) for x in zip(self.kept, (*contexts(ids, first), ids, places), strict=True)]
        whole = len(places) and len(self.kept[0]) // WINDOW * WINDOW
        for low in range(0, whole, WINDOW):
            self._learn([x[low : low + WINDOW] for x in self.kept])
        self.kept = [x[whole:] for x in self.kept]

    def _learn(self, part: list[np.ndarray]) -> None:
        far, near, ids, places = part
        self.state.trainer.learn(far, near, ids, self.random)
        self.state.members.learn(self.state.trainer.model, far, near, places)
        self.seen += len(ids)

    def result(self, start: np.ndarray) -> tuple[np.ndarray, int]:
        """What the copy has moved from the start, in whole steps, times its weight, and the weight."""
        if len(self.kept[0]):
            self._learn(self.kept)
        weight = max(1, self.seen // WEIGHT)
        return np.rint((self.state.flat() - start.astype(np.float64)) * FINE).astype(np.int64) * weight, weight


def packed(values: np.ndarray) -> bytes:
    """Whole numbers, signs in the lowest bit, with all lowest bytes first, then all second bytes and so on: most of it
    is zero and compresses well in a shuffle."""
    return ((values << 1) ^ (values >> 63)).astype("<i8").view(np.uint8).reshape(-1, 8).T.tobytes()


def unpacked(data: bytes) -> np.ndarray:
    values = np.frombuffer(data, np.uint8).reshape(8, -1).T.copy().view("<u8").ravel()
    return (values >> np.uint64(1)).astype(np.int64) ^ -(values & np.uint64(1)).astype(np.int64)


def _trained(frequent: Frequent, start: np.ndarray):
    """Sums of the copies of a task's shards, whose rows come one shard after the other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, weights, shard, learner = None, 0, None, None

        def close():
            nonlocal total, weights
            values, weight = learner.result(start)
            total, weights = values if total is None else total + values, weights + weight

        for batch in batches:
            shards = batch.column(0).to_numpy()
            _, offsets = utf8(batch.column(1))
            for a, b in steps(offsets):
                cut = [a, *(np.flatnonzero(np.diff(shards[a:b])) + a + 1).tolist(), b]
                for low, high in zip(cut[:-1], cut[1:], strict=True):
                    if shards[low] != shard:
                        if learner is not None:
                            close()
                        shard, state = shards[low], State.begin(frequent)
                        state.load(start)
                        learner = Learner(state, int(shard))
                    places, at = _numbers(batch.column(1)[low:high])
                    learner.add(frequent, places, at[:-1])
        if learner is not None:
            close()
            parts = [packed(total[at : at + PIECE]) for at in range(0, len(total), PIECE)]
            salt = TaskContext.get().partitionId() % SALTS
            yield pa.RecordBatch.from_pydict(
                {"row": pa.array(np.arange(len(parts)), pa.int32()), "salt": pa.array(np.full(len(parts), salt), pa.int32()), "weight": pa.array(np.full(len(parts), weights), pa.int64()), "values": pa.array(parts, pa.binary())}
            )

    return run


SUMS = "row int, weight long, values binary"


def _summed(table: pa.Table) -> pa.Table:
    total = np.sum([unpacked(v) for v in table.column("values").to_pylist()], axis=0)
    weight = sum(table.column("weight").to_pylist())
    return pa.table({"row": table.column("row")[:1], "weight": pa.array([weight], pa.int64()), "values": pa.array([packed(total)], pa.binary())})


def train(rows: DataFrame, frequent: Frequent) -> State:
    """The state after all rounds over rows of key, mark and places (numbers of words, see _placed)."""
    shards = max(1, -(-frequent.n // SHARD))
    rounds = min(ROUNDS, shards)
    state = State.begin(frequent)
    bare = replace(frequent, index={})
    dealt = rows.withColumn("shard", F.pmod(F.xxhash64(F.xxhash64("key", "mark")), F.lit(shards)))
    for number in range(rounds):
        mine = dealt.filter(F.pmod("shard", F.lit(rounds)) == number)
        mine = mine.repartition("shard").sortWithinPartitions("shard", "key", "mark").select("shard", "places")
        start = state.flat()
        sums = mine.transform(map_batches, _trained(bare, start), "row int, salt int, weight long, values binary")
        half = sums.groupBy("row", "salt").applyInArrow(_summed, SUMS)  # SALTS sums of each piece come before its one sum
        got = sorted(half.groupBy("row").applyInArrow(_summed, SUMS).collect(), key=lambda r: r["row"])
        if got:  # a round may have no rows
            moved = np.concatenate([unpacked(r["values"]) / (r["weight"] * FINE) for r in got])
            state.load((start + moved).astype(np.float32))
    return state


def _placed(frequent: Frequent):
    """Numbers of the words of each text, its sums over words of the table, and its other words with their counts."""
    log_counts = np.append(np.log10(frequent.counts + SMOOTH), 0.0)  # the last place stands for a word outside the table

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = frequent.index
        for batch in batches:
            _, offsets = utf8(batch.column(3))
            for start, end in steps(offsets, STEP):
                numbers, names, counts = words_of(batch.column(3)[start:end])
                at = np.fromiter(map(index.get, names, repeat(-1)), np.int64, len(names))
                places = with_ends(at[numbers] if len(names) else numbers, counts, index.get(END_WORD, -1))
                ends = np.concatenate([[0], np.cumsum(counts + 1)])
                known = (places >= 0).astype(np.int64)
                rare = np.flatnonzero(at[numbers] < 0) if len(names) else np.zeros(0, np.int64)
                row = np.repeat(np.arange(end - start), counts)[rare]
                pairs, n = np.unique(row * max(1, len(names)) + numbers[rare], return_counts=True)
                of, word = pairs // max(1, len(names)), pairs % max(1, len(names))
                cut = pa.array(np.searchsorted(of, np.arange(end - start + 1)).astype(np.int32))
                written = pa.py_buffer(np.ascontiguousarray(places.astype("<i4")))
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(c)[start:end] for c in (0, 1, 2)),
                        batch.column(4)[start:end],
                        pa.array(counts + 1),
                        pa.Array.from_buffers(pa.large_binary(), end - start, [None, pa.py_buffer(ends * 4), written]).cast(pa.binary()),
                        pa.array(np.add.reduceat(known, ends[:-1])),
                        pa.array(np.add.reduceat(log_counts[places], ends[:-1])),
                        pa.ListArray.from_arrays(cut, pa.array(names, pa.binary()).take(pa.array(word))),
                        pa.ListArray.from_arrays(cut, pa.array(n.astype(np.int64))),
                    ],
                    names=["doc_id", "key", "mark", "held_out", "n_tokens", "places", "n_frequent", "base", "rare", "rare_n"],
                )

    return run


PLACED = "doc_id long, key long, mark long, held_out boolean, n_tokens long, places binary, n_frequent long, base double, rare array<binary>, rare_n array<long>"


_TABLES: dict[bytes, tuple] = {}


def _scored(frequent: Frequent, model: Model, members: Members):
    stamp = model.word.tobytes()[:64] + model.bias.tobytes()[:64]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if stamp not in _TABLES:
            _TABLES.clear()
            _TABLES[stamp] = model.tables()
        a, b, z = _TABLES[stamp]
        for batch in batches:
            _, offsets = utf8(batch.column(batch.num_columns - 1))
            for start, end in steps(offsets):
                places, at = _numbers(batch.column(batch.num_columns - 1)[start:end])
                ids = frequent.head_ids(places)
                far, near = contexts(ids, at[:-1])
                logs = ((a[far, ids] + b[near, ids] - z[far, near]).astype(np.float64) + members.logs(model, far, near, places)) / math.log(10)
                yield pa.RecordBatch.from_arrays([*(c[start:end] for c in batch.columns[:-1]), pa.array(np.add.reduceat(logs, at[:-1]))], names=[*batch.schema.names[:-1], "model"])

    return run


def counted(docs: DataFrame, id_col: str, text_col: str) -> tuple[Frequent, DataFrame, DataFrame]:
    """The table of frequent words, the written counts of all training words, and the rows with key, mark (see
    licenses.keyed), text and held_out."""
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("key"),
        F.xxhash64(text_col).alias("mark"),
        F.col(text_col).alias("text"),
        remainder_is_0(id_col, HELD_OUT).alias("held_out"),
    )
    counts = rows.filter("not held_out").select("text").transform(map_batches, _counted, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    counts = materialise(counts, "word-counts")
    n, v = (x or 0 for x in counts.agg(F.sum("n"), F.count("*")).first())
    # words from the rarest class of counts on whose words, with all more frequent ones, are FREQUENT at most
    short = counts.filter(F.length("word") <= LONGEST).withColumn("level", F.floor(F.log2(F.col("n").cast("double")) * 16))
    levels, total, least = short.groupBy("level").agg(F.count("*").alias("words")).orderBy(F.desc("level")).collect(), 0, math.inf
    for row in levels:  # at most 16 levels for each doubling of the count
        total += row["words"]
        if total > FREQUENT:
            break
        least = row["level"]
    top = short.filter(F.col("level") >= least).select("word", "n").collect() if levels and least < math.inf else []
    by_word = {bytes(r["word"]): r["n"] for r in top} | {END_WORD: counts.filter(F.length("word") == 0).agg(F.sum("n")).first()[0] or 0}
    words = [END_WORD, *sorted(by_word.keys() - {END_WORD}, key=lambda w: (-by_word[w], w))] if n else []
    places = {w: i for i, w in enumerate(words)}
    numbers = np.array([by_word.get(w, 0) for w in words], np.int64)
    heads = min(SINGLE, len(places))
    return Frequent(places, numbers, heads, n, v, n - int(numbers.sum()), v - len(places), -(-(len(places) - heads) // (HEADS - 2 - heads))), counts, rows


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score (log10 of the text's probability)."""
    frequent, counts, rows = counted(docs, id_col, text_col)
    n, v = frequent.n, frequent.v
    placed = rows.transform(map_batches, _placed(frequent), PLACED).withColumn("row", F.monotonically_increasing_id())
    placed = materialise(placed, "placed-words")
    state = train(placed.filter("not held_out").select("key", "mark", "places"), frequent) if n else State.begin(frequent)
    model, members = state.trainer.model, state.members
    model.bias[START] = -1e4  # never a token

    known = "row long, doc_id long, held_out boolean, n_tokens long, n_frequent long, base double"
    inputs = placed.select(*(c.split()[0] for c in known.split(", ")), "places")
    scored = inputs.transform(map_batches, _scored(frequent, model, members), f"{known}, model double")
    rare = placed.select("row", F.explode(F.arrays_zip("rare", "rare_n")).alias("x")).select("row", F.col("x.rare").alias("word"), F.col("x.rare_n").alias("m"))
    logs = F.log10(F.coalesce(F.col("n"), F.lit(0)) + SMOOTH)
    sums = rare.join(counts, "word", "left").groupBy("row").agg(
        F.sum(F.col("m") * logs).alias("rare_logs"), F.sum("m").alias("n_rare"), F.sum(F.when(F.col("n") > 0, F.col("m")).otherwise(0)).alias("rare_known")
    )
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    total = math.log10(n + SMOOTH * (v + 1))
    other = math.log10(frequent.other_n + SMOOTH * (frequent.other_v + 1))
    return scored.join(sums, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_frequent") + zero("rare_known")).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("base") + zero("rare_logs") - F.col("n_tokens") * total).alias("base_score"),
        (F.col("model") + zero("rare_logs") - zero("n_rare") * other).alias("score"),
    )
