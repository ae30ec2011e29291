"""Operator 2, media columns: baseline JPEG, written and read with numpy.

A payload (text bytes, filled up with bytes 255 to a positive multiple of 576) is stored as grey 8-bit samples: each
byte is the value of one 8 x 8 block, so it is the block's DC coefficient and every AC coefficient is zero. 24 blocks
make a row and each row is a restart interval, at most FRAME_ROWS rows make a frame (one JPEG file), and longer
payloads are several files one after the other. The decoder parses the markers of any baseline JPEG (several
components, sampling factors, with or without restart intervals), Huffman-decodes the scan with one numpy lane per
restart interval of the whole batch, and rebuilds the luminance thumbnail from the DC values; for these files that
thumbnail is the payload, byte for byte. Features are its dimensions and a 64-bit average hash.

Map-only: media bytes are a binary column, nothing is shuffled. Edge cases: a null or empty text has the payload of
576 bytes 255; repeated rows give a row each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, steps, utf8

UNIT, WIDTH, FILL = 576, 24, 255
FRAME_ROWS = 8184
#: Text bytes of a step: the encoder's temporary arrays take some 40 bytes for each.
STEP = 1 << 20

#: Fixed values of the format: markers.
SOI, EOI, SOF0, DHT, DQT, DRI, SOS, RST0 = 0xD8, 0xD9, 0xC0, 0xC4, 0xDB, 0xDD, 0xDA, 0xD0
#: Code lengths that this writer gives to DC categories 0 to 8, and to the AC end of block.
DC_LENGTHS, EOB_LENGTHS = [4, 4, 3, 3, 3, 3, 3, 3, 5], [1]


def canonical(counts: list[int]) -> list[tuple[int, int]]:
    """(code, length) of each symbol in order, from the number of codes of each length 1 to 16."""
    code, out = 0, []
    for length, n in enumerate(counts, 1):
        for _ in range(n):
            out.append((code, length))
            code += 1
        code <<= 1
    return out


def _table(lengths: list[int]) -> tuple[list[int], list[int]]:
    """The DHT form of code lengths by symbol: counts by length, and symbols in code order."""
    order = sorted(range(len(lengths)), key=lambda s: (lengths[s], s))
    return [lengths.count(n) for n in range(1, 17)], order


def _segment(marker: int, body: bytes) -> bytes:
    return bytes([0xFF, marker]) + struct.pack(">H", len(body) + 2) + body


def _header(rows: int) -> bytes:
    dc, ac = _table(DC_LENGTHS), _table(EOB_LENGTHS)
    return b"".join(
        [
            bytes([0xFF, SOI]),
            _segment(DQT, bytes([0]) + bytes([8] * 64)),
            _segment(SOF0, struct.pack(">BHHB3B", 8, rows * 8, WIDTH * 8, 1, 1, 0x11, 0)),
            _segment(DHT, bytes([0x00, *dc[0], *dc[1]]) + bytes([0x10, *ac[0], *ac[1]])),
            _segment(DRI, struct.pack(">H", WIDTH)),
            _segment(SOS, bytes([1, 1, 0x00, 0, 63, 0])),
        ]
    )


def _diff_codes() -> tuple[np.ndarray, np.ndarray]:
    """Bits and bit count of a whole block (DC difference, then end of block) for differences -255 to 255."""
    counts, order = _table(DC_LENGTHS)
    code = {s: c for s, c in zip(order, canonical(counts), strict=True)}
    bits, sizes = np.zeros(511, np.uint32), np.zeros(511, np.int64)
    for diff in range(-255, 256):
        category = abs(diff).bit_length()
        extra = diff if diff >= 0 else diff + (1 << category) - 1
        head, length = code[category]
        bits[diff + 255] = ((head << category) | extra) << 1
        sizes[diff + 255] = length + category + 1
    return bits, sizes


_BITS, _SIZES = _diff_codes()
_LANE_BYTES = (WIDTH * (int(_SIZES.max())) + 7) // 8 + 3


def encode_payloads(data: np.ndarray, lengths: np.ndarray) -> list[bytes]:
    """Media bytes of payloads that lie one after the other in data; lengths are positive multiples of UNIT. Frames of about
    STEP bytes are encoded at once, however long a payload is."""
    whole = FRAME_ROWS * WIDTH
    cuts = [[whole] * (n // whole) + [n % whole] * bool(n % whole) for n in lengths.tolist()]
    pieces = np.array([p for cut in cuts for p in cut], np.int64)
    at = np.concatenate([[0], np.cumsum(pieces)])
    made = (x for a, b in steps(at, 2 * STEP) for x in _encode(data[at[a] : at[b]], pieces[a:b]))
    return [b"".join(islice(made, len(cut))) for cut in cuts]


def _encode(data: np.ndarray, lengths: np.ndarray) -> list[bytes]:
    lanes = len(data) // WIDTH
    block = data.reshape(lanes, WIDTH).astype(np.int16)
    diff = np.empty((lanes, WIDTH), np.int16)
    diff[:, 0] = block[:, 0] - 128
    np.subtract(block[:, 1:], block[:, :-1], out=diff[:, 1:])
    diff += 255
    bits, sizes = _BITS[diff], _SIZES[diff]
    ends = np.cumsum(sizes, axis=1)
    packed = np.zeros(lanes * _LANE_BYTES, np.uint8)
    base = np.arange(lanes, dtype=np.int64) * _LANE_BYTES
    for k in range(WIDTH):
        start = ends[:, k] - sizes[:, k]
        word = bits[:, k] << (24 - (start & 7) - sizes[:, k]).astype(np.uint32)
        at = base + (start >> 3)
        packed[at] |= (word >> np.uint32(16)).astype(np.uint8)
        packed[at + 1] |= ((word >> np.uint32(8)) & np.uint32(255)).astype(np.uint8)
        packed[at + 2] |= (word & np.uint32(255)).astype(np.uint8)
    total = ends[:, -1]
    used = (total + 7) >> 3
    packed[base + used - 1] |= ((1 << (used * 8 - total)) - 1).astype(np.uint8)  # the rest of a lane's last byte is ones
    keep = np.arange(_LANE_BYTES) < used[:, None]
    scan = packed.reshape(lanes, _LANE_BYTES)[keep]
    lane_of = np.repeat(np.arange(lanes), used)
    stuffed = np.flatnonzero(scan == 255)
    extra = np.bincount(lane_of[stuffed], minlength=lanes)
    scan = np.insert(scan, stuffed + 1, 0)
    lane_end = np.cumsum(used + extra)
    lane_start = np.concatenate([[0], lane_end])
    scan = memoryview(np.insert(scan, np.repeat(lane_end, 2), np.tile(np.array([255, RST0], np.uint8), lanes)))
    out, lane = [], 0
    for length in lengths.tolist():
        rows, parts = length // WIDTH, []
        while rows:
            n = min(rows, FRAME_ROWS)
            body = np.array(scan[lane_start[lane] + 2 * lane : lane_start[lane + n] + 2 * (lane + n) - 2])
            marks = lane_start[lane + 1 : lane + n] - lane_start[lane] + 2 * np.arange(1, n) - 1
            body[marks] = RST0 + np.arange(n - 1) % 8
            parts += [_header(n), body.tobytes(), bytes([0xFF, EOI])]
            lane, rows = lane + n, rows - n
        out.append(b"".join(parts))
    return out


@dataclass
class Frame:
    """What the markers of one JPEG say; scans are (start, end) of entropy-coded bytes."""

    width: int = 0
    height: int = 0
    #: (id, horizontal, vertical sampling, quantiser) of each component
    components: list[tuple[int, int, int, int]] = field(default_factory=list)
    quantisers: dict[int, np.ndarray] = field(default_factory=dict)
    huffman: dict[tuple[int, int], bytes] = field(default_factory=dict)
    restart: int = 0
    #: (component id, DC table, AC table) in the scan
    scan: list[tuple[int, int, int]] = field(default_factory=list)
    start: int = 0
    end: int = 0

    @property
    def most(self) -> tuple[int, int]:
        return max(c[1] for c in self.components), max(c[2] for c in self.components)

    @property
    def mcus(self) -> tuple[int, int]:
        h, v = self.most if len(self.components) > 1 else (1, 1)
        return -(-self.width // (8 * h)), -(-self.height // (8 * v))


def parse_frames(media: bytes) -> list[Frame]:
    """The frames of baseline files that lie one after the other; anything but baseline with one scan is an error."""
    frames, at = [], 0
    while at < len(media):
        if media[at : at + 2] != bytes([0xFF, SOI]):
            raise ValueError(f"no start of image at byte {at}")
        at, frame = at + 2, Frame()
        while True:
            if media[at] != 0xFF:
                raise ValueError(f"no marker at byte {at}")
            while media[at + 1 : at + 2] == b"\xff":  # filling before a marker
                at += 1
            marker = media[at + 1]
            size = int.from_bytes(media[at + 2 : at + 4], "big")
            body, at = media[at + 4 : at + 2 + size], at + 2 + size
            if marker == DQT:
                while body:
                    wide = body[0] >> 4
                    n = 128 if wide else 64
                    frame.quantisers[body[0] & 15] = np.frombuffer(body[1 : n + 1], ">u2" if wide else "u1").astype(np.int64)
                    body = body[n + 1 :]
            elif marker == SOF0:
                _, frame.height, frame.width, n = struct.unpack(">BHHB", body[:6])
                frame.components = [(body[6 + 3 * i], body[7 + 3 * i] >> 4, body[7 + 3 * i] & 15, body[8 + 3 * i]) for i in range(n)]
            elif marker == DHT:
                while body:
                    n = sum(body[1:17])
                    frame.huffman[body[0] >> 4, body[0] & 15] = body[1 : 17 + n]
                    body = body[17 + n :]
            elif marker == DRI:
                frame.restart = int.from_bytes(body[:2], "big")
            elif marker == SOS:
                frame.scan = [(body[1 + 2 * i], body[2 + 2 * i] >> 4, body[2 + 2 * i] & 15) for i in range(body[0])]
                frame.start = at
                break
            elif 0xC0 < marker < 0xD0 and marker != 0xC8 and marker != 0xCC:
                raise ValueError("only baseline files are read")
        if len(frame.scan) != len(frame.components):
            raise ValueError("only files with one interleaved scan are read")
        end = media.find(b"\xff\xd9", at)  # a stuffed 255 is followed by 0, so this is the end marker
        if end < 0:
            raise ValueError("no end of image")
        frame.end, at = end, end + 2
        frames.append(frame)
    return frames


_LOOKUPS: dict[bytes, tuple[np.ndarray, np.ndarray]] = {}


def _lookup(table: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Code length and symbol for each 16 bits that may follow; length 0: no code."""
    if table not in _LOOKUPS:
        sizes, symbols = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64)
        for (code, length), symbol in zip(canonical(list(table[:16])), table[16:], strict=True):
            low, high = code << (16 - length), (code + 1) << (16 - length)
            sizes[low:high], symbols[low:high] = length, symbol
        if len(_LOOKUPS) > 64:
            _LOOKUPS.clear()
        _LOOKUPS[table] = sizes, symbols
    return _LOOKUPS[table]


class Lanes:
    """Bit readers side by side: windows[i] holds the eight bytes from byte i on."""

    def __init__(self, scan: np.ndarray, starts: np.ndarray):
        data = np.concatenate([scan, np.full(9, 255, np.uint8)]).astype(np.uint64)
        n = len(scan) + 1
        self.windows = np.zeros(n, np.uint64)
        for i in range(8):
            self.windows |= data[i : i + n] << np.uint64(56 - 8 * i)
        self.most = 8 * (n - 1)
        self.at = starts * 8

    def symbol(self, lanes, lookup) -> np.ndarray:
        """The next symbol of the lanes, and the bits that it says follow are read after it by extra()."""
        at = np.minimum(self.at[lanes], self.most)
        self.word = self.windows[at >> 3] << (at & 7).astype(np.uint64)
        peek = (self.word >> np.uint64(48)).astype(np.int64)
        self.size = lookup[0][peek]
        if not self.size.all():
            raise ValueError("bits that are no code of the table")
        return lookup[1][peek]

    def extra(self, lanes, category: np.ndarray) -> np.ndarray:
        """Signed value of the category's extra bits; moves past symbol and bits."""
        raw = (self.word << self.size.astype(np.uint64)) >> np.uint64(1)
        raw = (raw >> (63 - category).astype(np.uint64)).astype(np.int64)
        self.at[lanes] += self.size + category
        return np.where(raw < (1 << category) >> 1, raw - (1 << category) + 1, raw)


def _decode_lanes(frame: Frame, scan: np.ndarray, starts: np.ndarray, blocks: np.ndarray) -> np.ndarray:
    """DC sums of the first component's blocks: a row for each lane. blocks: MCUs in each lane."""
    lanes, readers, most = len(starts), Lanes(scan, starts), int(blocks.max(initial=0))
    single = len(frame.components) == 1
    plan = []
    for i, (cid, dc, ac) in enumerate(frame.scan):
        _, h, v, _ = next(c for c in frame.components if c[0] == cid)
        plan += [(i, _lookup(frame.huffman[0, dc]), _lookup(frame.huffman[1, ac]))] * (1 if single else h * v)
    first = sum(1 for p in plan if p[0] == 0)
    out = np.zeros((lanes, most * first), np.int16)
    last = np.zeros((len(frame.scan), lanes), np.int64)
    even = bool((blocks == most).all())
    for k in range(most):
        going = slice(None) if even else np.flatnonzero(blocks > k)
        done = 0
        for i, dc, ac in plan:
            last[i, going] += readers.extra(going, readers.symbol(going, dc))
            if i == 0:
                out[going, k * first + done] = last[0, going]
                done += 1
            here, place = going, None
            while True:  # AC coefficients: only their bits are passed over
                symbol = readers.symbol(here, ac)
                readers.extra(here, symbol & 15)
                place = (1 if place is None else place) + np.where(symbol == 0, 64, (symbol >> 4) + 1)
                more = np.flatnonzero(place < 64)
                if not len(more):
                    break
                here = (np.arange(lanes) if isinstance(here, slice) else here)[more]
                place = place[more]
    return out


def thumbnails(media: list[bytes]) -> list[list[np.ndarray]]:
    """The DC-only luminance thumbnail of every frame of every item: one 8-bit sample for each 8 x 8 block."""
    found: list[list[np.ndarray]] = [[] for _ in media]
    alike: dict[tuple, list[tuple[int, int, Frame]]] = {}
    for i, item in enumerate(media):
        for frame in parse_frames(item):
            key = (tuple(frame.components), tuple(frame.scan), tuple(sorted(frame.huffman.items())), frame.restart)
            alike.setdefault(key, []).append((i, len(found[i]), frame))
            found[i].append(np.zeros((0, 0), np.uint8))
    for group in (g[a:b] for g in alike.values() for a, b in steps(np.cumsum([0, *(f.end - f.start for *_, f in g)]), 2 * STEP)):
        raw = np.frombuffer(b"".join(media[i][f.start : f.end] for i, _, f in group), np.uint8)
        sizes = np.array([f.end - f.start for *_, f in group], np.int64)
        frame_at = np.concatenate([[0], np.cumsum(sizes)])
        full = np.flatnonzero(raw[:-1] == 255) if len(raw) else np.zeros(0, np.int64)
        after = raw[full + 1]
        marks = full[(after >= RST0) & (after < RST0 + 8)]
        gone = np.concatenate([full[after == 0] + 1, marks, marks + 1])
        keep = np.ones(len(raw), bool)
        keep[gone] = False
        kept = np.concatenate([[0], np.cumsum(keep)])
        starts = np.sort(np.concatenate([frame_at[:-1], marks + 2]))
        owner = np.searchsorted(frame_at, starts, side="right") - 1
        mcus = np.array([f.mcus[0] * f.mcus[1] for *_, f in group], np.int64)
        place = np.arange(len(starts)) - np.searchsorted(owner, owner)
        restart = group[0][2].restart or int(mcus.max())
        blocks = np.minimum(restart, mcus[owner] - place * restart)
        sums = _decode_lanes(group[0][2], raw[keep], kept[starts], blocks)
        begin = np.searchsorted(owner, np.arange(len(group) + 1))
        for g, (i, slot, frame) in enumerate(group):
            cid, h, v, q = next(c for c in frame.components if c[0] == frame.scan[0][0])
            if len(frame.components) == 1:
                h = v = 1
            part = slice(begin[g], begin[g + 1])
            row = np.concatenate([s[: n * h * v] for s, n in zip(sums[part], blocks[part], strict=True)]) if (blocks[part] != blocks[part][0]).any() else sums[part, : blocks[part][0] * h * v].reshape(-1)
            wide, high = frame.mcus
            plane = row.reshape(high, wide, v, h).transpose(0, 2, 1, 3).reshape(high * v, wide * h)
            step = int(frame.quantisers[q][0])
            image = np.clip((plane.astype(np.int64) * step + 4 >> 3) + 128, 0, 255).astype(np.uint8)
            most = frame.most if len(frame.components) > 1 else (1, 1)
            across, down = -(-frame.width * h // (8 * most[0])), -(-frame.height * v // (8 * most[1]))
            found[i][slot] = image[:down, :across]
    return found


def average_hash(image: np.ndarray) -> str:
    """64 bits: which of the 8 x 8 areas are at least as bright as their mean."""
    rows, columns = (np.linspace(0, n, 9)[:-1].astype(np.int64) for n in image.shape)
    area = np.add.reduceat(np.add.reduceat(image, rows, axis=0, dtype=np.int64), columns, axis=1)
    counts = np.diff(np.append(rows, image.shape[0]))[:, None] * np.diff(np.append(columns, image.shape[1]))
    mean = area / np.maximum(counts, 1)
    return np.packbits((mean >= mean.mean()).reshape(-1)).tobytes().hex()


def feature(frames: list[np.ndarray]) -> str:
    """Width x height in samples, number of frames and the hash of the joined thumbnail."""
    image = frames[0] if len(frames) == 1 else np.concatenate(frames)
    return f"{image.shape[1]}x{image.shape[0]}:{len(frames)}:{average_hash(image)}"


def payloads(body: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Filled payloads one after the other, their lengths, and the lengths of the texts."""
    sizes = np.diff(offsets)
    lengths = np.maximum(-(-sizes // UNIT), 1) * UNIT
    data = np.full(int(lengths.sum()), FILL, np.uint8)
    if len(sizes) == 1:
        data[: sizes[0]] = body[offsets[0] : offsets[-1]]
        return data, lengths, sizes
    shift = np.cumsum(lengths) - lengths - offsets[:-1]
    data[np.arange(offsets[0], offsets[-1]) + np.repeat(shift, sizes)] = body[offsets[0] : offsets[-1]]
    return data, lengths, sizes


def store_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes and media (binary JPEG) of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            body, offsets = utf8(batch.column(1))
            for start, end in steps(offsets, STEP):
                data, lengths, sizes = payloads(body, offsets[start : end + 1])
                media = encode_payloads(data, lengths)
                yield pa.RecordBatch.from_arrays([batch.column(0)[start:end], pa.array(sizes), pa.array(media, pa.binary())], names=["doc_id", "n_bytes", "media"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).transform(map_batches, run, "doc_id long, n_bytes long, media binary")


FEATURES = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"


def read_features(media: DataFrame, media_col: str = "media") -> DataFrame:
    """FEATURES of a media column, all computed from the stored bytes (n_bytes is passed on). A null is an error."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, offsets = utf8(batch.column(2).cast(pa.large_binary()).view(pa.large_binary()))
            for start, end in steps(offsets, 2 * STEP):
                items = batch.column(2)[start:end].to_pylist()
                columns: list[list] = [[] for _ in range(6)]
                for item, frames in zip(items, thumbnails(items), strict=True):
                    payload = b"".join(f.tobytes() for f in frames)
                    row = (len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]), len(item), hashlib.sha256(item).hexdigest(), feature(frames))
                    for column, value in zip(columns, row, strict=True):
                        column.append(value)
                kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
                arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0)[start:end], batch.column(1)[start:end], *arrays], names=[f.split()[0] for f in FEATURES.split(", ")])

    return media.select("doc_id", "n_bytes", media_col).transform(map_batches, run, FEATURES)
