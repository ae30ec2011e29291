"""Parts of texts: found by numpy over raw bytes, told apart by Arrow's dictionary encoding, and kept with their ids in
a table that grows by doubling. No Python object is made for a part, only for each distinct part of a step."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa

#: Most bytes of a step whose parts are told apart by 32-bit offsets; a longer row has 64-bit ones.
NARROW = (1 << 31) - 1
LONGEST = 256


class Growing:
    """An array that values are added to; its room doubles, so adding costs no copy of all each time."""

    def __init__(self, dtype):
        self.room, self.n = np.empty(1024, dtype), 0

    @property
    def values(self) -> np.ndarray:
        return self.room[: self.n]

    def extend(self, values: np.ndarray) -> None:
        end = self.n + len(values)
        if end > len(self.room):
            room = np.empty(max(end, 2 * len(self.room)), self.room.dtype)
            room[: self.n] = self.values
            self.room = room
        self.room[self.n : end] = values
        self.n = end


class PartTable:
    """Ids of parts; entries are numbered in the order they are added. The first one has no part but the key None."""

    def __init__(self, dtype, first: Iterable[int] = ()):
        self.index: dict[bytes | None, int] = {}
        self.flat, self.starts, self.sizes = Growing(dtype), Growing(np.int64), Growing(np.int64)
        #: Bytes of parts that are longer than LONGEST: such parts hardly come again.
        self.long = 0
        first = np.array(list(first), dtype)
        self.add([None, b""], first, np.array([len(first), 0]))

    def add(self, keys: list, ids: np.ndarray, sizes: np.ndarray) -> None:
        self.index.update(zip(keys, range(self.sizes.n, self.sizes.n + len(sizes)), strict=True))
        self.long += sum(len(k) for k in keys if k is not None and len(k) > LONGEST)
        self.starts.extend(self.flat.n + np.cumsum(sizes) - sizes)
        self.sizes.extend(sizes)
        self.flat.extend(ids)

    def gather(self, at: np.ndarray) -> np.ndarray:
        """The ids of the entries at these places, one after the other."""
        sizes = self.sizes.values[at]
        ends = np.cumsum(sizes)
        shift = np.repeat(self.starts.values[at] - ends + sizes, sizes)
        shift += np.arange(len(shift))
        return self.flat.values[shift]

    def for_step(self, names: list[bytes], most: int, long: int) -> PartTable:
        """This table, or if it has more than `most` parts, or `long` bytes of long ones, one of these parts alone."""
        if len(self.index) <= most and self.long <= long:
            return self
        keys = [k for k in {*names} - {b""} if k in self.index]
        at = np.array([self.index[k] for k in keys], np.int64)
        table = PartTable(self.flat.room.dtype, self.gather(np.zeros(1, np.int64)))
        table.add(keys, self.gather(at), self.sizes.values[at])
        return table


def coded(body: np.ndarray, starts: np.ndarray, end: int) -> tuple[np.ndarray, list[bytes]]:
    """Parts of the body that begin at starts, each up to the next one and the last up to end: the number of each part
    among the distinct ones, and these."""
    if not len(starts):
        return np.zeros(0, np.int64), []
    wide = end > NARROW
    bounds = np.append(starts, end).astype(np.int64 if wide else np.int32)
    body = np.ascontiguousarray(body)
    parts = pa.Array.from_buffers(pa.large_binary() if wide else pa.binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(body)])
    found = parts.dictionary_encode()
    return found.indices.to_numpy(), found.dictionary.to_pylist()


def with_ends(numbers: np.ndarray, counts: np.ndarray, end: int) -> np.ndarray:
    """The numbers of all rows one after the other (counts of each), with `end` after each row."""
    out = np.empty(len(numbers) + len(counts), np.int64)
    ends = np.cumsum(counts + 1) - 1
    held = np.ones(len(out), bool)
    held[ends] = False
    out[held], out[ends] = numbers, end
    return out
