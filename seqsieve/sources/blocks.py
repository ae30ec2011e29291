"""FASTQ records in the bytes of a file, from any place of it on.

numpy takes all records of four lines out of a block of bytes at once. What is not of that form (sequences of several
lines, blank lines, letters beyond ASCII, faults) goes through a parser that takes one record at a time, by the rules of
sources.fastq. A task that begins somewhere in a file looks for a line that looks like a header, with a sequence, a plus
and a quality of one length after it. Whether that was a record's beginning is settled when the tasks' ends are compared with the
next ones' beginnings (sources.fastq_index).

Places are bytes in plain files, and (place of the compressed block) * 65536 + place within it in files of small gzip
blocks that tell their size (BGZF). Other gzip files can be read from their beginning only."""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from .store import Store

#: Bytes that are parsed at once, and how far a task looks for a record's beginning.
BLOCK, LOOK = 4 << 20, 4 << 20
#: How a block of BGZF begins, and the field that tells its size.
MAGIC, SIZE_FIELD = b"\x1f\x8b\x08\x04", b"BC\x02\x00"
#: Records that are taken one at a time before numpy is tried again, at most.
SLOW = 10_000

AT, PLUS, SPACE, CR = b"@+ \r"


class Fault(ValueError):
    """A record that breaks the rules of the format."""


def bgzf_size(head: bytes) -> int | None:
    """Bytes of the BGZF block that begins with these 18 bytes or more, or None."""
    if len(head) < 18 or head[:4] != MAGIC:
        return None
    extra = head[12 : 12 + int.from_bytes(head[10:12], "little")]
    at = 0
    while at + 4 <= len(extra):
        if extra[at : at + 4] == SIZE_FIELD and at + 6 <= len(extra):
            return int.from_bytes(extra[at + 4 : at + 6], "little") + 1
        at += 4 + int.from_bytes(extra[at + 2 : at + 4], "little")
    return None


def kind_of(path: str) -> str:
    """plain, bgzf or gzip."""
    if not path.endswith(".gz"):
        return "plain"
    with Store(path).open(path) as f:
        return "bgzf" if bgzf_size(f.read(64)) else "gzip"


class Stream:
    """A file's uncompressed bytes from a place on. u counts bytes from there; limit is the first u that belongs to
    another task, as soon as it is known."""

    def __init__(self, path: str, kind: str, start: int = 0, end: int | None = None):
        self.file, self.kind, self.end = Store(path).open(path), kind, end
        self.limit: int | None = None
        self.u = 0
        self.us, self.places = [0], [start]
        if kind == "plain":
            self.file.seek(start)
            self.limit = None if end is None else end - start
        elif kind == "bgzf":
            self.file.seek(start >> 16)
            self.us, self.places, self.skip = [], [], start & 0xFFFF
            self.at = start >> 16
        else:
            self.unzip = zlib.decompressobj(31)

    def place(self, u: int) -> int:
        i = bisect_right(self.us, u) - 1
        return self.places[i] + u - self.us[i]

    def read(self) -> bytes:
        """The next bytes; none at the end."""
        out = self._gzip() if self.kind == "gzip" else self._bgzf() if self.kind == "bgzf" else self.file.read(BLOCK)
        self.u += len(out)
        return out

    def _gzip(self) -> bytes:
        while True:
            raw = self.unzip.unused_data or self.file.read(BLOCK // 4)
            if not raw:
                if not self.unzip.eof and self.u:
                    raise Fault("the compressed file is cut off")
                return b""
            if self.unzip.eof:
                if not raw.strip(b"\0"):  # filling after the last member
                    return b""
                self.unzip = zlib.decompressobj(31)
            out = self.unzip.decompress(raw)
            if out:
                return out

    def _bgzf(self) -> bytes:
        parts, held = [], 0
        while held < BLOCK:
            head = self.file.read(18)
            if not head:
                break
            size = bgzf_size(head)
            if size is None:  # a longer extra field
                head += self.file.read(max(0, int.from_bytes(head[10:12], "little") - 6))
                size = bgzf_size(head)
            if size is None:
                raise Fault(f"no BGZF block at byte {self.at}")
            body = zlib.decompress(head + self.file.read(size - len(head)), 31)[self.skip :]
            if self.end is not None and self.at >= self.end and self.limit is None:
                self.limit = self.u + held
            if body:
                self.us.append(self.u + held)
                self.places.append((self.at << 16) + self.skip)
            self.skip, self.at = 0, self.at + size
            parts.append(body)
            held += len(body)
            if self.limit is not None and held:
                break
        if not parts or not held:
            self.us.append(self.u)
            self.places.append(self.at << 16)
        return b"".join(parts)

    def close(self) -> None:
        self.file.close()


def first_block(path: str, begin: int) -> int | None:
    """The first BGZF block from a byte on: one whose size leads to another block or the file's end."""
    with Store(path).open(path) as f:
        f.seek(0, 2)
        size = f.tell()
        f.seek(begin)
        raw = f.read(3 * 65536 + 64)
    at = raw.find(MAGIC)
    while at >= 0:
        n = bgzf_size(raw[at : at + 256])
        if n and (begin + at + n == size or raw[at + n : at + n + 4] == MAGIC):
            return begin + at
        at = raw.find(MAGIC, at + 1)
    return None


def _line(data: bytes, at: int, final: bool) -> tuple[int, int] | None:
    """End of the line at a place (without its line end), and the next line's place; None if it is not all there."""
    end = data.find(b"\n", at)
    if end < 0:
        if not final:
            return None
        end = len(data)
        after = end
    else:
        after = end + 1
    while end > at and data[end - 1] == CR:
        end -= 1
    return end, after


def skip_blank(data: bytes, at: int, final: bool) -> int | None:
    """The place of the next line that is not blank, or the end; None if more bytes are needed to tell."""
    while at < len(data):
        if data[at] not in b"\r\n":
            return at
        found = _line(data, at, final)
        if found is None:
            return None
        if found[0] > at:
            return at
        at = found[1]
    return at if final else None


def looks_like_record(data: bytes, at: int, final: bool) -> bool | None:
    """Whether four lines from a place on look like a record that another may follow; None: more bytes are needed."""
    if data[at] != AT:
        return False
    ends, p = [], at
    for _ in range(4):
        if p >= len(data) and final:
            return False
        found = _line(data, p, final)
        if found is None:
            return None
        ends.append((p, found[0]))
        p = found[1]
    if p >= len(data) and not final:
        return None
    (h0, h1), (s0, s1), (p0, p1), (q0, q1) = ends
    if h1 - h0 < 2 or data[h0 + 1] == SPACE or p1 == p0 or data[p0] != PLUS or s1 - s0 != q1 - q0 or (s1 > s0 and data[s0] == PLUS):
        return False
    return p >= len(data) or data[p] in b"@\r\n"


def find_record(data: bytes, at: int, final: bool) -> int | None:
    """The first line from a line's place on that looks like a record's beginning: len(data) if there is none up to the
    end, -1 if none is found within LOOK; None: more bytes are needed."""
    first = at
    while at < len(data):
        found = looks_like_record(data, at, final)
        if found is None:
            return None
        if found:
            return at
        line = _line(data, at, final)
        if line is None:
            return None
        at = line[1]
        if at - first > LOOK:
            return -1
    return len(data) if final else None


def one_record(data: bytes, at: int, final: bool) -> tuple[int, str, str | None, str, str] | None:
    """The record at a place (of a line that is not blank): the place after it, id, description, sequence, quality; None if
    it is not all there."""
    found = _line(data, at, final)
    if found is None:
        return None
    head, at = data[at : found[0]], found[1]
    if head[:1] != b"@":
        raise Fault("a record must begin with @")
    name, space, rest = _text(head[1:]).partition(" ")
    if not name:
        raise Fault("no id")
    bases: list[str] = []
    while True:
        if at >= len(data):
            if final:
                raise Fault("the record is not complete")
            return None
        found = _line(data, at, final)
        if found is None:
            return None
        part, at = data[at : found[0]], found[1]
        if part[:1] == b"+":
            break
        if b" " in part:
            raise Fault("space in the sequence")
        bases.append(_text(part))
    seq = "".join(bases)
    quals: list[str] = []
    size = 0
    while size < len(seq):
        if at >= len(data):
            if final:
                raise Fault("the record is not complete")
            return None
        found = _line(data, at, final)
        if found is None:
            return None
        part, at = data[at : found[0]], found[1]
        if not part:
            raise Fault("blank line in the quality")
        if b" " in part:
            raise Fault("space in the quality")
        quals.append(_text(part))
        size += len(quals[-1])
    if size != len(seq):
        raise Fault("sequence and quality differ in length")
    return at, name, rest if space else None, seq, "".join(quals)


def _text(raw: bytes) -> str:
    try:
        return raw.decode()
    except UnicodeDecodeError:
        raise Fault("text that is not UTF-8") from None


def four_lines(buf: np.ndarray, final: bool) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends (rows of four) of the lines of all records of four lines that the bytes begin with."""
    breaks = np.flatnonzero(buf == 10)
    if final and len(buf) and buf[-1] != 10:
        breaks = np.append(breaks, len(buf))
    n = len(breaks) // 4
    breaks = breaks[: 4 * n]
    starts = np.concatenate([np.zeros(min(1, n), np.int64), breaks[:-1] + 1]) if n else breaks
    ends = breaks.copy()
    at = np.flatnonzero((ends > starts) & (buf[ends - 1] == CR)) if n else breaks
    ends[at] -= 1
    starts, ends = starts.reshape(-1, 4), ends.reshape(-1, 4)
    if not n:
        return starts, ends
    edge = np.append(buf, np.uint8(0))  # a line that is empty has the next line's letter, which no test below takes for its own
    length = ends - starts
    good = (length[:, 0] > 1) & (edge[starts[:, 0]] == AT) & (edge[np.minimum(starts[:, 0] + 1, len(buf))] != SPACE)
    good &= (length[:, 2] > 0) & (edge[starts[:, 2]] == PLUS) & (length[:, 1] == length[:, 3])
    good &= (length[:, 1] == 0) | (edge[starts[:, 1]] != PLUS)
    good &= ~((length > 0) & (edge[np.maximum(ends - 1, 0)] == CR)).any(axis=1)  # several at a line's end
    odd = np.flatnonzero((buf == SPACE) | (buf >= 128))
    if len(odd):
        for line in (1, 3):
            good &= np.searchsorted(odd, starts[:, line]) == np.searchsorted(odd, ends[:, line])
        if (buf[odd] >= 128).any():
            for i in np.flatnonzero(good & (np.searchsorted(odd, starts[:, 0]) != np.searchsorted(odd, ends[:, 0]))):
                try:
                    buf[starts[i, 0] : ends[i, 0]].tobytes().decode()
                except UnicodeDecodeError:
                    good[i] = False
    bad = np.flatnonzero(~good)
    return (starts, ends) if not len(bad) else (starts[: bad[0]], ends[: bad[0]])


def slices(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, missing: np.ndarray | None = None) -> pa.Array:
    """A string column of parts of the bytes."""
    lengths = ends - starts
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    body = buf[np.arange(int(offsets[-1])) + np.repeat(starts - offsets[:-1], lengths)]
    valid = None if missing is None else pa.py_buffer(np.packbits(~missing, bitorder="little"))
    found = pa.Array.from_buffers(pa.large_string(), len(starts), [valid, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(body)])
    return found.cast(pa.string())


class Taken:
    """Records of one step: their number, and columns when asked for."""

    def __init__(self, n: int, columns: list[pa.Array] | None):
        self.n, self.columns = n, columns


def _columns(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[pa.Array]:
    spaces = np.flatnonzero(buf == SPACE)
    first = np.append(spaces, len(buf))[np.searchsorted(spaces, starts[:, 0])]
    plain = first >= ends[:, 0]
    id_end = np.where(plain, ends[:, 0], first)
    none = pa.nulls(len(starts), pa.string())
    return [slices(buf, starts[:, 0] + 1, id_end), slices(buf, np.where(plain, ends[:, 0], first + 1), ends[:, 0], plain), slices(buf, starts[:, 1], ends[:, 1]), slices(buf, starts[:, 3], ends[:, 3]), none, none]


class Records:
    """Records of a stream in order, in steps. Faults become records of their own: bytes up to what looks like the next record, with the
    reason; columns are id, desc, seq, qual, problem and bad."""

    def __init__(self, stream: Stream, columns: bool = True):
        self.stream, self.columns = stream, columns
        self.data, self.base, self.final = b"", 0, False  # base: u of data[0]
        self.slow = 1
        self.problem: str | None = None

    def _more(self) -> None:
        piece = self.stream.read()
        self.final = not piece
        self.data += piece

    def _drop(self, at: int) -> None:
        self.data, self.base = self.data[at:], self.base + at

    def _owned(self) -> bool:
        return self.stream.limit is None or self.base < self.stream.limit

    def to_beginning(self, is_line: bool) -> bool:
        """Goes to the first place that looks like a record's beginning; False if none is found nearby. is_line: the stream begins
        with a line, as far as is known."""
        at = 0
        while True:
            if not is_line:
                end = self.data.find(b"\n")
                if end >= 0:
                    at, is_line = end + 1, True
                elif self.final:
                    at, is_line = len(self.data), True
            found = find_record(self.data, at, self.final) if is_line else None
            if found is not None:
                break
            if len(self.data) > 2 * LOOK:
                return False
            self._more()
        if found < 0:
            return False
        self._drop(found)
        return True

    def to_record(self) -> None:
        """Skips blank lines, so that the next record begins at base or the file has ended."""
        while (at := skip_blank(self.data, 0, self.final)) is None:
            self._more()
        self._drop(at)

    def steps(self) -> Iterator[Taken]:
        """All records that begin before the stream's limit."""
        while True:
            self.to_record()
            if not self.data or not self._owned():
                return
            if len(self.data) < BLOCK and not self.final:
                self._more()
                continue
            buf = np.frombuffer(self.data, np.uint8)
            starts, ends = four_lines(buf, self.final)
            if self.stream.limit is not None:
                mine = int(np.searchsorted(starts[:, 0], self.stream.limit - self.base)) if len(starts) else 0
                starts, ends = starts[:mine], ends[:mine]
            if len(starts):
                yield Taken(len(starts), _columns(buf, starts, ends) if self.columns else None)
                last = int(ends[-1, 3])
                after = self.data.find(b"\n", last)
                self._drop(len(self.data) if after < 0 else after + 1)
            self.slow = 1 if len(starts) > SLOW // 10 else min(2 * self.slow, SLOW)
            yield from self._one_by_one(self.slow)

    def _one_by_one(self, most: int) -> Iterator[Taken]:
        rows: list[tuple] = []
        at = 0
        while len(rows) < most:
            to = skip_blank(self.data, at, self.final)
            if to is None:
                if rows:
                    at = at if at else 0
                    break
                self._drop(at)
                at = 0
                self._more()
                continue
            at = to
            if at >= len(self.data) or (self.stream.limit is not None and self.base + at >= self.stream.limit):
                break
            try:
                found = one_record(self.data, at, self.final)
                if found is not None:
                    after, row = found[0], (*found[1:], None, None)
            except Fault as fault:
                line = _line(self.data, at, self.final)
                after = None if line is None else find_record(self.data, line[1], self.final)
                found = after
                if after == -1:  # no record near: all that has been looked at is bad
                    after = max(line[1], self.data.rfind(b"\n", 0, line[1] + LOOK) + 1)
                if after is not None:
                    row = (None, None, None, None, str(fault), self.data[at:after].decode(errors="replace"))
                    self.problem = self.problem or str(fault)
            if found is None:
                if rows:
                    break
                self._drop(at)
                at = 0
                self._more()
                continue
            rows.append(row)
            at = after
        self._drop(at)
        if rows:
            yield Taken(len(rows), [pa.array(c, pa.string()) for c in zip(*rows, strict=True)] if self.columns else None)
