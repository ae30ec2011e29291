"""Reads the protobuf of a SentencePiece model: pieces, scores, kinds and the normaliser's switches."""

from __future__ import annotations

import struct
from dataclasses import dataclass, field

SPACE = "▁"
#: Fixed values of the format: kinds of pieces and models, and field numbers.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
F_PIECES, F_TRAINER, F_NORMALISER = 1, 2, 3
F_MODEL_TYPE, F_BYTE_FALLBACK = 3, 35
F_CHARSMAP, F_DUMMY_PREFIX, F_REMOVE_EXTRA, F_ESCAPE = 2, 3, 4, 5


@dataclass
class PieceModel:
    pieces: list[str] = field(default_factory=list)
    scores: list[float] = field(default_factory=list)
    kinds: list[int] = field(default_factory=list)
    model_type: int = UNIGRAM
    byte_fallback: bool = False
    charsmap: bytes = b""
    dummy_prefix: bool = True
    remove_extra: bool = True
    escape: bool = True

    @property
    def unk_id(self) -> int:
        return self.kinds.index(UNKNOWN)


def _fields(data: bytes):
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 0x7F) << shift
            if byte < 0x80:
                return value
            shift += 7

    while at < len(data):
        tag = varint()
        wire = tag & 7
        if wire == 0:
            value = varint()
        elif wire == 1:
            value, at = data[at : at + 8], at + 8
        elif wire == 2:
            n = varint()
            value, at = data[at : at + n], at + n
        elif wire == 5:
            value, at = struct.unpack("<f", data[at : at + 4])[0], at + 4
        else:
            raise ValueError(f"wire type {wire} is not part of this format")
        yield tag >> 3, value


def parse(data: bytes) -> PieceModel:
    model = PieceModel()
    for number, value in _fields(data):
        if number == F_PIECES:
            got = dict(_fields(value))
            model.pieces.append(got[1].decode("utf-8"))
            model.scores.append(got.get(2, 0.0))
            model.kinds.append(got.get(3, NORMAL))
        elif number == F_TRAINER:
            got = dict(_fields(value))
            model.model_type = got.get(F_MODEL_TYPE, UNIGRAM)
            model.byte_fallback = bool(got.get(F_BYTE_FALLBACK, 0))
        elif number == F_NORMALISER:
            got = dict(_fields(value))
            model.charsmap = got.get(F_CHARSMAP, b"")
            model.dummy_prefix = bool(got.get(F_DUMMY_PREFIX, 1))
            model.remove_extra = bool(got.get(F_REMOVE_EXTRA, 1))
            model.escape = bool(got.get(F_ESCAPE, 1))
    return model


def load(path: str) -> PieceModel:
    with open(path, "rb") as f:
        return parse(f.read())
