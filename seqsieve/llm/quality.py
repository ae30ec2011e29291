"""Operator 10, quality classifier: naive Bayes support vectors.

Features are indicators of hashed n-grams: three neighbouring bytes, and one to three neighbouring word shapes (case,
punctuation, last mark, and whether the word repeats the one before), so they know no language. Each indicator is
scaled by its class log-count ratio, a text's vector is scaled to length 1, and a linear hinge-loss model is fitted by
dual coordinate descent. A logistic curve, fitted to a part that the descent did not see and weighted by the classes'
true shares, turns the margin into a score from 0 to 1.

The fit uses a bounded sample of labelled rows: MAX_PER_CLASS rows of each class, those with the lowest hash of their
id. Class shares are counted over all labelled rows, and every row is scored. Labels are used of rows whose
crc32(id as text) modulo HELD_OUT is not 0; inputs of a score are the text's bytes alone.

Edge cases: null and empty texts have no indicators and get the score of the bias; ids labelled with both classes and
null labels are left out; without labels of both classes every score is the share of class 1 (0.5 if there are no
labels); repeated rows give a row each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, steps, utf8
from .words import DARK_BYTES, hashes, mix, spans

BITS = 17
SIZE = 1 << BITS
HELD_OUT, THRESHOLD = 5, 0.3
#: Bound of the fitted sample, in rows of each class.
MAX_PER_CLASS = 4000
ALPHA, COST, EPOCHS = 1.0, 1.0, 20

SCORES = "doc_id long, held_out boolean, score double, predicted int"


def held_out(id_col: str, of: int = HELD_OUT):
    """True for the rows that no label may be learnt from; a null id counts as an empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % of == 0


def _shapes(body: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A number for each word's shape, and its row."""
    starts, ends, rows = spans(body, offsets, DARK_BYTES)
    total = lambda flag: np.concatenate([[0], np.cumsum(flag)])
    upper = total((body >= 65) & (body <= 90))
    lower = total((body >= 97) & (body <= 122))
    high = total(body >= 128)
    caps, small, wide = (c[ends] - c[starts] for c in (upper, lower, high))
    marks = np.minimum((ends - starts) - caps - small - wide, 4)
    last = np.where(marks > 0, body[ends - 1], 0).astype(np.uint64) if len(ends) else np.zeros(0, np.uint64)
    word = hashes(body, starts, ends)
    again = np.concatenate([[False], (word[1:] == word[:-1]) & (rows[1:] == rows[:-1])]) if len(word) else np.zeros(0, bool)
    case = np.where(caps == 0, 0, np.where(caps == 1, 1, np.where(small == 0, 3, 2)))
    return (((last * np.uint64(5) + marks.astype(np.uint64)) * np.uint64(4) + case.astype(np.uint64)) * np.uint64(2) + again.astype(np.uint64)), rows


def indicators(body: np.ndarray, offsets: np.ndarray) -> Iterator[np.ndarray]:
    """For each row the sorted places of the n-grams that it holds."""
    word = body.astype(np.uint64)
    grams = mix((word[:-2] << np.uint64(16)) | (word[1:-1] << np.uint64(8)) | word[2:]) >> np.uint64(64 - BITS) if len(body) > 2 else word[:0]
    shape, rows = _shapes(body, offsets)
    parts = []
    for k in (1, 2, 3):
        n = max(len(shape) - k + 1, 0)
        h = np.full(n, k, np.uint64)
        for i in range(k):
            h = mix(h * np.uint64(31) + shape[i : i + n])
        parts.append((h >> np.uint64(64 - BITS), rows[:n], rows[k - 1 :][:n] == rows[:n]))
    first = [np.searchsorted(r, np.arange(len(offsets))) for _, r, _ in parts]
    flags = np.zeros(SIZE, bool)
    for row in range(len(offsets) - 1):
        flags[grams[offsets[row] : max(offsets[row], offsets[row + 1] - 2)].astype(np.int64)] = True
        for (h, _, whole), at in zip(parts, first, strict=True):
            part = slice(at[row], at[row + 1])
            flags[h[part][whole[part]].astype(np.int64)] = True
        found = np.flatnonzero(flags)
        flags[found] = False
        yield found


@dataclass
class Model:
    weights: np.ndarray
    ratios: np.ndarray
    slope: float
    shift: float

    def margin(self, found: np.ndarray) -> float:
        ratios = self.ratios[found]
        return float(self.weights[found] @ ratios) / math.sqrt(float(ratios @ ratios) + 1e-9)

    def score(self, found: np.ndarray) -> float:
        return 1.0 / (1.0 + math.exp(-max(-500.0, min(500.0, self.slope * self.margin(found) + self.shift))))


def log_count_ratios(rows: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    counts = [np.full(SIZE, ALPHA), np.full(SIZE, ALPHA)]
    for found, label in zip(rows, labels, strict=True):
        counts[label][found] += 1
    return np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())


def descend(rows: list[np.ndarray], values: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    """Weights of the L1-loss support vector machine, by dual coordinate descent (with the shrinking of settled rows)."""
    weights, alpha = np.zeros(SIZE), np.zeros(len(rows))
    sign = np.where(labels == 1, 1.0, -1.0)
    norms = np.array([float(v @ v) for v in values])
    order, active = np.random.RandomState(7), np.flatnonzero(norms > 0)
    for _ in range(EPOCHS):
        moved = []
        for i in order.permutation(active):
            gradient = sign[i] * float(weights[rows[i]] @ values[i]) - 1.0
            if (alpha[i] == 0.0 and gradient > 0.5) or (alpha[i] == COST and gradient < -0.5):
                continue
            new = min(max(alpha[i] - gradient / norms[i], 0.0), COST)
            if new != alpha[i]:
                weights[rows[i]] += (new - alpha[i]) * sign[i] * values[i]
                alpha[i] = new
            moved.append(i)
        active = np.array(sorted(moved), dtype=np.int64)
        if not len(active):
            break
    return weights


def calibrate(margins: np.ndarray, labels: np.ndarray, importance: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the weighted logistic curve, by Newton's method with a small ridge."""
    x = np.stack([margins, np.ones_like(margins)], axis=1)
    b = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -40, 40)))
        gradient = x.T @ (importance * (p - labels)) + 1e-3 * b
        hessian = (x * (importance * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        b -= step
        if np.abs(step).max() < 1e-9:
            break
    return float(b[0]), float(b[1])


def fit_rows(rows: list[np.ndarray], labels: np.ndarray, shares: tuple[int, int]) -> Model:
    """A model from the sample; shares: how many labelled rows each class has in all."""
    if len(set(labels.tolist())) < 2:
        share = shares[1] / max(1, sum(shares)) if sum(shares) else 0.5
        share = min(max(share, 1e-6), 1 - 1e-6)
        return Model(np.zeros(SIZE), np.zeros(SIZE), 0.0, math.log(share / (1 - share)))
    rest = np.arange(len(rows)) % 5 == 4
    if len(set(labels[rest].tolist())) < 2 or len(set(labels[~rest].tolist())) < 2:
        rest = np.zeros(len(rows), bool)
    train = np.flatnonzero(~rest)
    ratios = log_count_ratios([rows[i] for i in train], labels[train])
    values = [ratios[rows[i]] / math.sqrt(float(ratios[rows[i]] @ ratios[rows[i]]) + 1e-9) for i in train]
    weights = descend([rows[i] for i in train], values, labels[train])
    model = Model(weights, ratios, 1.0, 0.0)
    seen = np.flatnonzero(rest) if rest.any() else np.arange(len(rows))
    importance = np.where(labels[seen] == 1, shares[1] / max(1, (labels[seen] == 1).sum()), shares[0] / max(1, (labels[seen] == 0).sum()))
    importance *= len(seen) / importance.sum()
    model.slope, model.shift = calibrate(np.array([model.margin(rows[i]) for i in seen]), labels[seen], importance)
    return model


def _packed(found: np.ndarray) -> bytes:
    """Places of at most SIZE / 8 bytes: as numbers, or as bits if they are many (told by the first byte)."""
    if 4 * len(found) < SIZE // 8:
        return b"\0" + found.astype("<i4").tobytes()
    bits = np.zeros(SIZE, bool)
    bits[found] = True
    return b"\1" + np.packbits(bits).tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    if data[:1] == b"\0":
        return np.frombuffer(data[1:], "<i4").astype(np.int64)
    return np.flatnonzero(np.unpackbits(np.frombuffer(data[1:], np.uint8)))


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        body, offsets = utf8(batch.column(2))
        for start, end in steps(offsets):
            at = offsets[start : end + 1]
            packed = [_packed(x) for x in indicators(body[at[0] : at[-1]], at - at[0])]
            yield pa.RecordBatch.from_arrays([batch.column(0)[start:end], batch.column(1)[start:end], pa.array(packed, pa.binary())], names=["doc_id", "label", "found"])


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Model:
    """Runs at once. The driver holds the sample's indicators only: at most 2 * MAX_PER_CLASS * 16 KB."""
    known = (
        labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label"))
        .filter(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out("doc_id"))
        .groupBy("doc_id")
        .agg(F.min("label").alias("label"), F.max("label").alias("other"))
        .filter("label = other")
        .drop("other")
    )
    counted = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    picked = [known.filter(F.col("label") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(MAX_PER_CLASS) for c in (0, 1)]
    sample = F.broadcast(picked[0].unionByName(picked[1]))  # at most 2 * MAX_PER_CLASS rows
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).join(sample, "doc_id")
    found = texts.select("doc_id", "label", "text").transform(map_batches, _features, "doc_id long, label int, found binary")
    first = found.groupBy("doc_id").agg(F.min_by("label", "found").alias("label"), F.min("found").alias("found"))  # an id stands for one text
    got = sorted(first.collect(), key=lambda r: r["doc_id"])
    rows = [_unpacked(bytes(r["found"])) for r in got]
    return fit_rows(rows, np.array([r["label"] for r in got], dtype=np.int64), (counted.get(0, 0), counted.get(1, 0)))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """SCORES of every row of docs; map-only."""
    weights, ratios = model.weights.astype(np.float32), model.ratios.astype(np.float32)
    slope, shift = model.slope, model.shift

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = Model(weights, ratios, slope, shift)
        for batch in batches:
            body, offsets = utf8(batch.column(2))
            for start, end in steps(offsets):
                at = offsets[start : end + 1]
                scores = np.array([fitted.score(x) for x in indicators(body[at[0] : at[-1]], at - at[0])], dtype=np.float64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[start:end], batch.column(1)[start:end], pa.array(scores), pa.array((scores >= THRESHOLD).astype(np.int32))],
                    names=["doc_id", "held_out", "score", "predicted"],
                )

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out(id_col).alias("held_out"), F.col(text_col).alias("text")).transform(map_batches, run, SCORES)


def keep_good(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs whose predicted class is 1, with all their columns; map-only, no join by id."""
    weights, ratios = model.weights.astype(np.float32), model.ratios.astype(np.float32)
    slope, shift = model.slope, model.shift
    place = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = Model(weights, ratios, slope, shift)
        for batch in batches:
            body, offsets = utf8(batch.column(place))
            keep: list[bool] = []
            for start, end in steps(offsets):
                at = offsets[start : end + 1]
                keep += [fitted.score(x) >= THRESHOLD for x in indicators(body[at[0] : at[-1]], at - at[0])]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.transform(map_batches, run, docs.schema)
