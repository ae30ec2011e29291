"""Operator 5, SentencePiece encoding and decoding on the tokenizers library.

The model's protobuf is parsed here and rebuilt with the tokenizers library: the normaliser (character map, spaces and
metaspace marker), scores (a Unigram model keeps them; a BPE model's scores give its merges), byte fallback, and
user-defined pieces, which are cut out of a text first. Texts are cut before markers, which is safe as no piece holds a
marker after another character (checked, else texts are encoded whole), and each distinct part is encoded once, in
multithreaded batches, while a bounded table holds it. Parity: the sentencepiece library encodes every whole text too;
parity tells whether it gives the same ids; the ids are the tokenizers library's in any case. Decoding goes from ids to
text by the rebuilt decoder, and every text's ids are decoded again. Map-only: nothing is shuffled.

Known to differ from the library, so that parity is false: pieces marked as unused, texts that hold a byte piece's name
under a Unigram model, and characters that the two libraries' character maps treat apart.

Edge cases: null and empty texts have no ids; repeated rows give a row each; an empty table gives no rows; special
strings such as "<s>" in a text are ordinary characters; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import spm_model
from .common import give_back, map_batches, steps, utf8
from .parts import PartTable, coded
from .spm_model import SPACE

#: Parts whose ids a worker keeps, and bytes of long ones.
MAX_WORDS, MAX_LONG = 200_000, 4 << 20
#: Parts that are encoded as one text.
JOINED = 1024
#: What stands in a Unigram table for a piece that no text may match: a code point that is no character.
NO_TEXT = "\U0010ffff"
SCHEMA = "doc_id long, ids array<int>, n_tokens long, ids_crc32 long, parity boolean, round_trip boolean"


def merges_of(model: spm_model.PieceModel) -> list[tuple[str, str]]:
    """A BPE model's merges, best score first: each way to make a normal piece of two pieces."""
    ids = {p: i for i, (p, k) in enumerate(zip(model.pieces, model.kinds, strict=True)) if k == spm_model.NORMAL}
    found = []
    for piece, i in ids.items():
        for cut in range(1, len(piece)):
            left, right = piece[:cut], piece[cut:]
            if left in ids and right in ids:
                found.append((-model.scores[i], i, ids[left], ids[right], left, right))
    return [(left, right) for *_, left, right in sorted(found)]


def unigram_table(model: spm_model.PieceModel) -> list[tuple[str, float]]:
    """A Unigram model's pieces and scores; pieces that no text may match have other names and the lowest score."""
    plain = (spm_model.NORMAL, spm_model.USER_DEFINED)
    least = min((s for s, k in zip(model.scores, model.kinds, strict=True) if k == spm_model.NORMAL), default=0.0)
    named = lambda i, p, k: p if k in (*plain, spm_model.BYTE) else f"{NO_TEXT}{i}"
    return [(named(i, p, k), s if k in plain else least) for i, (p, s, k) in enumerate(zip(model.pieces, model.scores, model.kinds, strict=True))]


def normaliser(model: spm_model.PieceModel):
    """The model's normaliser, whose result has the marker in place of spaces."""
    from tokenizers import Regex, normalizers

    steps_ = [normalizers.Precompiled(model.charsmap)] if model.charsmap else []
    if model.remove_extra:
        steps_ += [normalizers.Replace(Regex(" {2,}"), " "), normalizers.Replace(Regex("^ | $"), "")]
    marker = SPACE if model.escape else " "
    if model.dummy_prefix:
        steps_.append(normalizers.Prepend(marker))
    return normalizers.Sequence([*steps_, normalizers.Replace(" ", marker)])


def rebuild(model: spm_model.PieceModel):
    """A Tokenizer for normalised text, where the marker stands for a space."""
    from tokenizers import AddedToken, Tokenizer, decoders, models

    if model.model_type == spm_model.BPE:
        vocab = {p: i for i, p in enumerate(model.pieces)}
        built = models.BPE(vocab, merges_of(model), unk_token=model.pieces[model.unk_id], fuse_unk=True, byte_fallback=model.byte_fallback)
    elif model.model_type == spm_model.UNIGRAM:
        built = models.Unigram(unigram_table(model), model.unk_id, model.byte_fallback)
    else:
        raise ValueError(f"model type {model.model_type} is not supported")
    tokenizer = Tokenizer(built)
    tokenizer.add_tokens([AddedToken(p, normalized=False) for p, k in zip(model.pieces, model.kinds, strict=True) if k == spm_model.USER_DEFINED])
    tokenizer.decoder = decoders.Sequence([decoders.Replace(SPACE, " "), decoders.ByteFallback(), decoders.Fuse()])
    return tokenizer


@lru_cache(maxsize=2)
def _library(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


class Codec:
    def __init__(self, path: str):
        self.model = model = spm_model.load(path)
        self.tokenizer, self.normaliser = rebuild(model), normaliser(model)
        self.library = _library(path)
        normal = {p for p, k in zip(model.pieces, model.kinds, strict=True) if k == spm_model.NORMAL}
        self.cuttable = model.escape and SPACE in normal and all(SPACE not in p.lstrip(SPACE) for p in model.pieces)
        # control characters that become bytes and that no piece holds never merge, so texts are cut around them too
        held = set("".join(model.pieces))
        self.alone = np.zeros(256, bool)
        self.alone[[ord(c) for c in "\t\n\r" if c not in held and model.byte_fallback]] = True
        self.newline = model.pieces.index("<0x0A>") if self.alone[10] else None
        self.bytes = pa.array([self._bytes(p, k) for p, k in zip(model.pieces, model.kinds, strict=True)], pa.large_binary())
        self.clear()

    def _bytes(self, piece: str, kind: int) -> bytes:
        if kind == spm_model.UNKNOWN:
            return " \u2047 ".encode()  # as the library decodes it
        if kind == spm_model.CONTROL:
            return b""
        return bytes([int(piece[3:5], 16)]) if kind == spm_model.BYTE else piece.replace(SPACE, " ").encode()

    def clear(self) -> None:
        self.table = PartTable(np.int32)

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(g.ids, np.int32) for g in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def learn(self, words: list[bytes]) -> None:
        """Encodes new parts. Parts that hold no line feed are joined by it, as it merges with nothing, and their ids are
        cut at its id, so that one call takes many parts."""
        marked = lambda w: w.decode().replace(" ", SPACE) if self.model.escape else w.decode()
        joined = [w for w in words if self.newline is not None and b"\n" not in w]
        if joined:
            got = self._ids([marked(b"\n".join(joined[i : i + JOINED])) for i in range(0, len(joined), JOINED)])
            ids = np.concatenate([x for row in got for x in (row, [self.newline])]).astype(np.int32)
            cut = np.flatnonzero(ids == self.newline)
            self.table.add(joined, np.delete(ids, cut), np.diff(cut, prepend=-1) - 1)
        rest = [w for w in words if self.newline is None or b"\n" in w]
        if rest:
            got = self._ids([marked(w) for w in rest])
            self.table.add(rest, np.concatenate(got), np.array([len(g) for g in got], np.int64))

    def normalise(self, text: str) -> str:
        """The text as the model's normaliser leaves it, with spaces for markers."""
        if not self.model.charsmap:
            if self.model.remove_extra:
                text = re.sub(" +", " ", text).strip(" ")
            return (" " if self.model.dummy_prefix and text else "") + text.replace(SPACE, " ")
        found = self.normaliser.normalize_str(text).replace(SPACE, " ") if text else ""
        return "" if self.model.remove_extra and found == " " else found

    def parts(self, body: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Where parts of normalised texts begin: a run of spaces and what follows it, or characters that stand alone."""
        first = offsets[:-1][np.diff(offsets) > 0]
        begins = np.zeros(len(body), bool)
        if self.cuttable:
            gap, alone = body == 32, self.alone[body]
            begins[1:] = (gap[1:] & ~gap[:-1]) | (alone[1:] != alone[:-1])
        begins[first] = True
        return begins

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
        """All ids one after the other, the number of ids of each text, whether the library agrees with the whole text,
        and the normalised texts."""
        body, offsets = utf8(pa.array([self.normalise(t) for t in texts], pa.large_string()))
        begins = self.parts(body, offsets)
        numbers, names = coded(body, np.flatnonzero(begins), len(body))
        self.table = self.table.for_step(names, MAX_WORDS, MAX_LONG)
        index = self.table.index
        self.learn([p for p in names if p not in index])
        places = np.fromiter(map(index.__getitem__, names), np.int64, len(names))[numbers]
        cut = np.concatenate([[0], np.cumsum(begins)])[offsets]
        ends = np.concatenate([[0], np.cumsum(self.table.sizes.values[places])])[cut]
        ids, counts = self.table.gather(places), np.diff(ends)
        theirs = self.library.encode(texts)
        sizes = np.array([len(x) for x in theirs], np.int64)
        same = sizes == counts
        flat = np.fromiter(chain.from_iterable(theirs), np.int32, int(sizes.sum()))
        if same.all():
            wrong = np.concatenate([[0], np.cumsum(ids != flat)])[ends]
            same = wrong[1:] == wrong[:-1]
        else:
            at = np.cumsum(sizes) - sizes
            same = np.array([n == m and np.array_equal(ids[a : a + n], flat[b : b + n]) for n, m, a, b in zip(counts, sizes, ends, at, strict=False)], bool)
        data = body.tobytes()
        return ids, counts, same, [data[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)]

    def raw(self, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
        """The bytes of the pieces of each text."""
        found = self.bytes.take(pa.array(ids))
        offsets = np.frombuffer(found.buffers()[1], np.int64, len(ids) + 1) if len(ids) else np.zeros(1, np.int64)
        data = found.buffers()[2].to_pybytes() if len(ids) else b""
        at = offsets[np.concatenate([[0], np.cumsum(counts)])]
        return [data[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]

    def decode(self, ids: list[np.ndarray]) -> list[str]:
        """Texts of ids: pieces and bytes are joined; where bytes are no UTF-8, the rebuilt decoder replaces them."""
        counts = np.array([len(x) for x in ids], np.int64)
        texts = []
        for row, found in zip(ids, self.raw(np.concatenate([*ids, np.zeros(0, np.int32)]).astype(np.int32), counts), strict=True):
            try:
                text = found.decode("utf-8")
            except UnicodeDecodeError:
                text = self.tokenizer.decode(row.tolist(), skip_special_tokens=False)
            texts.append(text[self._lead(row) :])
        return texts

    def shown(self, normal: bytes) -> str:
        """A normalised text without the spaces that decoding takes away."""
        text = normal.decode()
        return text.lstrip(" ") if self.model.remove_extra else text.removeprefix(" ") if self.model.dummy_prefix else text

    def _lead(self, row: np.ndarray) -> int:
        """How many spaces before a text were put there, or would have been taken away, by the normaliser."""
        n = 0
        for i in row.tolist():
            piece = self.model.pieces[i]
            marks = len(piece) - len(piece.lstrip(SPACE)) if self.model.kinds[i] == spm_model.NORMAL else 0
            n += marks
            if marks < len(piece):
                break
        return n if self.model.remove_extra else min(n, 1) if self.model.dummy_prefix else 0


@lru_cache(maxsize=2)
def _codec(path: str) -> Codec:
    return Codec(path)


def encode(docs: DataFrame, model_path: str, threads: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """SCHEMA for each row of docs. parity: the library gives the whole text the same ids.
    round_trip: the ids decode to the normalised text again."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "true"
        os.environ.setdefault("RAYON_NUM_THREADS", str(threads))
        codec = _codec(model_path)
        for batch in batches:
            _, offsets = utf8(batch.column(1))
            for start, end in steps(offsets):
                texts = pc.fill_null(batch.column(1)[start:end], "").to_pylist()
                flat, lengths, parity, normal = codec.encode(texts)
                same = [a == codec.shown(b) for a, b in zip(codec.decode(np.split(flat, np.cumsum(lengths)[:-1])), normal, strict=True)]
                at = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
                wide = flat.astype("<u4")
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0)[start:end],
                        pa.ListArray.from_arrays(pa.array(at), pa.array(flat)),
                        pa.array(lengths),
                        pa.array([zlib.crc32(wide[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)], pa.int64()),
                        pa.array(parity, pa.bool_()),
                        pa.array(same, pa.bool_()),
                    ],
                    names=["doc_id", "ids", "n_tokens", "ids_crc32", "parity", "round_trip"],
                )
        codec.clear()  # a worker outlives its task, and may serve other stages next
        give_back()

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).transform(map_batches, run, SCHEMA)


def decode(encoded: DataFrame, model_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """doc_id and text for each row of ids; null ids give an empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(model_path)
        for batch in batches:
            ids = [np.array(x or [], dtype=np.int32) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(codec.decode(ids), pa.string())], names=["doc_id", "text"])

    return encoded.select(F.col(id_col).cast("long").alias("doc_id"), F.col(ids_col).alias("ids")).transform(map_batches, run, "doc_id long, text string")
