"""Operator 1, token counts: unigram segmentation of pre-tokens by dynamic programming over a shared trie.

A pre-token is a word between white space with the metaspace marker before it. Distinct pre-tokens go into a trie;
a node holds the forward score (best sum of piece log-probabilities) and the token count of its prefix, so a prefix
that many words share is computed once. Each word's terminal count is stored, and a text's count is a sum of lookups.
It is map-only: nothing is shuffled, and each Python worker's trie and terminal table are bounded.

The vocabulary is that of a public piece model. Its pieces are ordered by frequency and carry no probabilities, so
piece number r gets Zipf's probability, in proportion to 1 / (r + ZIPF_SHIFT). A character that no piece covers is
written as its UTF-8 bytes (one token each) and scores PENALTY below the rarest piece.

Edge cases: null and blank texts have no tokens and log-probability 0; repeated rows and ids give a row each; an
empty table gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import spm_model
from .common import map_batches, steps, utf8

ZIPF_SHIFT = 2.7
PENALTY = 10.0
#: Bounds of a worker's memory: trie nodes, and words with stored counts.
MAX_NODES, MAX_WORDS = 400_000, 400_000

SCHEMA = "doc_id long, n_pretokens long, n_tokens long, n_unknown long, log_prob double"


def zipf_scores(model: spm_model.PieceModel) -> dict[str, float]:
    """Log-probabilities of the normal pieces by their place in the vocabulary."""
    normal = [p for p, k in zip(model.pieces, model.kinds, strict=True) if k == spm_model.NORMAL]
    total = sum(1.0 / (r + ZIPF_SHIFT) for r in range(len(normal)))
    return {p: -math.log((r + ZIPF_SHIFT) * total) for r, p in enumerate(normal)}


class PrefixTrie:
    """Forward scores of prefixes. add() walks a word and computes only the nodes that no earlier word made."""

    def __init__(self, scores: dict[str, float]):
        self.scores = scores
        self.tails = {p[i:] for p in scores for i in range(len(p))}
        self.unknown = min(scores.values()) - PENALTY
        self.clear()

    def clear(self) -> None:
        self.child: dict[tuple[int, str], int] = {}
        self.best, self.count, self.missed = [0.0], [0], [0]

    def add(self, word: str) -> tuple[int, int, float]:
        """Tokens, unknown characters and log-probability of the word's best segmentation."""
        if len(self.best) > MAX_NODES:
            self.clear()
        child, best, count, missed = self.child, self.best, self.count, self.missed
        scores, tails = self.scores, self.tails
        node, path = 0, [0]
        for depth, char in enumerate(word, 1):
            known = child.get((node, char))
            if known is None:
                top, tokens, unseen = -math.inf, 0, 0
                start = depth - 1
                while start >= 0 and (piece := word[start:depth]) in tails:
                    if (score := scores.get(piece)) is not None and best[path[start]] + score > top:
                        top, tokens, unseen = best[path[start]] + score, count[path[start]] + 1, missed[path[start]]
                    start -= 1
                if char not in scores and best[node] + self.unknown > top:
                    top, tokens, unseen = best[node] + self.unknown, count[node] + len(char.encode()), missed[node] + 1
                known = child[node, char] = len(best)
                best.append(top)
                count.append(tokens)
                missed.append(unseen)
            node = known
            path.append(node)
        return count[node], missed[node], best[node]


class Counter:
    """Terminal counts of words, in two generations so that memory is bounded and frequent words stay."""

    def __init__(self, scores: dict[str, float]):
        self.trie = PrefixTrie(scores)
        self.index: dict[str, int] = {}
        self.rows = np.zeros((0, 3))

    def table(self, words: set[str]) -> tuple[dict[str, int], np.ndarray]:
        if len(self.index) > MAX_WORDS:
            kept = [w for w in words if w in self.index]
            self.rows = self.rows[[self.index[w] for w in kept]]
            self.index = {w: i for i, w in enumerate(kept)}
        new = sorted(words - self.index.keys())
        self.index.update(zip(new, range(len(self.rows), len(self.rows) + len(new)), strict=True))
        found = np.array([self.trie.add(spm_model.SPACE + word) for word in new], dtype=np.float64).reshape(-1, 3)
        self.rows = np.concatenate([self.rows, found])
        return self.index, self.rows


@lru_cache(maxsize=2)
def _counter(model_path: str) -> Counter:
    return Counter(zipf_scores(spm_model.load(model_path)))


def token_counts(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """SCHEMA for each row of docs: pre-tokens, tokens, characters written as bytes, and the text's log-probability."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(model_path)
        for batch in batches:
            _, offsets = utf8(batch.column(1))
            for start, end in steps(offsets):
                texts = [t.split() for t in pc.fill_null(batch.column(1)[start:end], "").to_pylist()]
                index, rows = counter.table(set().union(*texts))
                sums = [rows[[index[w] for w in words]].sum(axis=0) if words else (0, 0, 0.0) for words in texts]
                got = np.array(sums, dtype=np.float64).reshape(-1, 3)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0)[start:end],
                        pa.array([len(words) for words in texts], pa.int64()),
                        pa.array(got[:, 0].astype(np.int64)),
                        pa.array(got[:, 1].astype(np.int64)),
                        pa.array(got[:, 2]),
                    ],
                    names=["doc_id", "n_pretokens", "n_tokens", "n_unknown", "log_prob"],
                )

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).transform(map_batches, count, SCHEMA)
