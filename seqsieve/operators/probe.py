"""Texts that stream past a few short sequences: what the tasks of the aligner, the literal screen and the adapter matcher
do with a batch. The few sequences (reads, passages, adapters) go to every task, behind a bound on their bytes; the many texts are
read once and never shuffled.

Every window of k letters has a 64-bit hash, from sums over the text's letters, so that a window costs the same at any k. A bitmap
of the wanted hashes lets few windows through, a binary search tells which are wanted, and letters are compared in the end."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Letters that are hashed at once, and pairs of a sequence and a place that are compared at once.
STEP, PAIRS = 1 << 18, 1 << 16
#: An odd number whose powers weigh letters, and its inverse modulo 2^64.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0 to base ** (n - 1) modulo 2 ** 64."""
    known = _POWERS.get(base)
    if known is None or len(known) < n:
        size, known = 1, np.ones(1, np.uint64)
        while size < n:
            known = np.concatenate([known, known * np.uint64(pow(base, size, 1 << 64))])
            size *= 2
        _POWERS[base] = known
    return known[:n]


def letters(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def prefix_sums(codes: np.ndarray) -> np.ndarray:
    out = np.zeros(len(codes) + 1, np.uint64)
    weighed = (codes.astype(np.uint64) + np.uint64(0x51ED27)) * np.uint64(0xD6E8FEB86659FD93)
    np.cumsum((weighed ^ (weighed >> np.uint64(31))) * powers(BASE, len(codes)), out=out[1:])
    return out


def windows(sums: np.ndarray, starts: np.ndarray, lengths) -> np.ndarray:
    """Hashes of the letters from each start on, spread over all bits."""
    h = (sums[starts + lengths] - sums[starts]) * powers(INVERSE, len(sums))[starts]
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xA24BAED4963EE407)
    return h ^ (h >> np.uint64(29))


def all_windows(sums: np.ndarray, k: int) -> np.ndarray:
    n = max(0, len(sums) - k)
    h = (sums[k:] - sums[:n]) * powers(INVERSE, len(sums))[:n]
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xA24BAED4963EE407)
    return h ^ (h >> np.uint64(29))


def hash_of(text: str) -> int:
    sums = prefix_sums(letters(text))
    return int(windows(sums, np.zeros(1, np.int64), len(text))[0])


class Seeds:
    """Wanted hashes with their owners: owner numbers of each hash stand one after the other."""

    def __init__(self, hashes: np.ndarray, owners: np.ndarray):
        order = np.argsort(hashes, kind="stable")
        self.owners = owners[order]
        self.hashes, first = np.unique(hashes[order], return_index=True)
        self.first = np.append(first, len(hashes))
        bits = min(26, max(10, int(len(self.hashes)).bit_length() + 5))
        self.shift = np.uint64(64 - bits)
        self.bitmap = np.zeros(1 << bits, bool)
        self.bitmap[(self.hashes >> self.shift).astype(np.int64)] = True

    def met(self, h: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(place in h, owner) of all wanted windows, about PAIRS at a time: an owner of a frequent window gets all places."""
        if not len(self.hashes) or not len(h):
            return
        may = np.flatnonzero(self.bitmap[(h >> self.shift).astype(np.int64)])
        at = np.searchsorted(self.hashes, h[may])
        at[at == len(self.hashes)] = 0
        hit = self.hashes[at] == h[may]
        places, at = may[hit], at[hit]
        counts = self.first[at + 1] - self.first[at]
        ends = np.cumsum(counts)
        row = 0
        while row < len(places):
            to = max(row + 1, int(np.searchsorted(ends, (ends[row - 1] if row else 0) + PAIRS, side="right")))
            n = counts[row:to]
            of = np.repeat(np.arange(row, to), n)
            within = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
            yield places[of], self.owners[self.first[at[of]] + within]
            row = to


def steps(length: int, overlap: int) -> Iterator[tuple[int, int, int]]:
    """Parts of a text: begin, end of the places that are the part's own, and end with what windows from there need."""
    for begin in range(0, max(length, 1), STEP):
        own = min(begin + STEP, length)
        yield begin, own, min(length, own + overlap)


class ShortReads:
    """Reads of one length in both directions, with seeds of k letters at each multiple of k."""

    def __init__(self, forms: list[str], length: int, most: int):
        self.length, self.most = length, most
        self.k = k = length // (most + 1)
        n = len(forms)
        self.codes = letters("".join(forms)).reshape(n, length)
        sums = prefix_sums(self.codes.reshape(-1))
        offsets = np.arange(most + 1) * k
        starts = (np.arange(n)[:, None] * length + offsets).reshape(-1)
        self.seeds = Seeds(windows(sums, starts, k), np.arange(n * (most + 1)))

    def hits(self, text: str, own: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(form, position, mismatches) of all forms that fit at the first `own` positions of a text; a pair may come
        more than once."""
        codes = letters(text)
        length, parts = self.length, self.most + 1
        for begin, _, end in steps(len(codes), length + self.k):
            here = codes[begin:end]
            for place, owner in self.seeds.met(all_windows(prefix_sums(here), self.k)):
                form, offset = owner // parts, owner % parts * self.k
                position = begin + place - offset
                fits = (position >= 0) & (position + length <= len(codes)) & (position < own)
                form, position = form[fits], position[fits]
                if not len(form):
                    continue
                there = codes[position[:, None] + np.arange(length)]
                wrong = (there != self.codes[form]).sum(axis=1)
                good = wrong <= self.most
                yield form[good], position[good], wrong[good]

    def best(self, text: str, own: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each read (two forms: 2 r, 2 r + 1 reversed) the hit with fewest mismatches, then the first position, then
        the strand; other hits are dropped as they come."""
        none = np.zeros(0, np.int64)
        form, position, wrong = none, none, none
        for f, p, w in self.hits(text, own):
            form, position, wrong = (np.concatenate(x) for x in ((form, f), (position, p), (wrong, w)))
            order = np.lexsort((form, position, wrong, form // 2))
            order = order[np.unique((form // 2)[order], return_index=True)[1]]
            form, position, wrong = form[order], position[order], wrong[order]
        return form, position, wrong

    def described(self, text: str, form: np.ndarray, position: np.ndarray) -> list[str]:
        """Mismatches as place:reference>read, places from the read's own beginning (the end of a reversed form)."""
        codes = letters(text)
        there, mine = codes[position[:, None] + np.arange(self.length)], self.codes[form]
        out: list[list[str]] = [[] for _ in form]
        for row, i in zip(*map(np.ndarray.tolist, np.nonzero(there != mine)), strict=True):
            place = self.length - 1 - i if form[row] % 2 else i
            out[row].append((place, f"{place}:{chr(there[row, i])}>{chr(mine[row, i])}"))
        return [",".join(d for _, d in sorted(x)) for x in out]


class Passages:
    """Passages of any length: each is looked for by its first letters, as many as the largest power of two that it has
    (32 at most), and told by the hash of all its letters."""

    def __init__(self, passages: list[str]):
        self.passages = passages
        self.lengths = np.fromiter(map(len, passages), np.int64, len(passages))
        self.wanted = np.array([hash_of(p) for p in passages], np.uint64)
        heads = np.minimum(32, 1 << np.floor(np.log2(np.maximum(self.lengths, 1))).astype(np.int64))
        self.kinds = {}
        for k in np.unique(heads[self.lengths > 0]):
            own = np.flatnonzero((heads == k) & (self.lengths > 0))
            self.kinds[int(k)] = Seeds(np.array([hash_of(passages[i][:k]) for i in own], np.uint64), own)
        self.longest = int(self.lengths.max(initial=0))

    def first(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """(passage, position) of the first place of each passage in a text."""
        codes = letters(text)
        found: dict[int, int] = {}
        for begin, own, end in steps(len(codes), self.longest):
            sums = prefix_sums(codes[begin:end])
            for k, seeds in self.kinds.items():
                for place, passage in seeds.met(all_windows(sums, k)[: own - begin]):
                    fits = place + self.lengths[passage] <= end - begin
                    place, passage = place[fits], passage[fits]
                    same = windows(sums, place, self.lengths[passage]) == self.wanted[passage]
                    place, passage = place[same], passage[same]
                    at, first = np.unique(passage, return_index=True)
                    for i, p in zip(at.tolist(), place[first].tolist(), strict=True):
                        if begin + p < found.get(i, len(codes)) and text[begin + p : begin + p + self.lengths[i]] == self.passages[i]:
                            found[i] = begin + p
        return np.array(list(found), np.int64), np.array(list(found.values()), np.int64)


class Adapters:
    """Best ungapped local matches of reads among forms (adapters in both directions) by scores of a match and a mismatch.
    A segment that scores `least` holds an exact run of k letters, so only diagonals with such a run are scored, all of a batch
    at once."""

    def __init__(self, forms: list[str], least: int, k: int, match: int, mismatch: int):
        self.least, self.k, self.match, self.mismatch = least, k, match, mismatch
        self.lengths = np.fromiter(map(len, forms), np.int64, len(forms))
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)])[:-1]
        self.codes = letters("".join(forms))
        sums = prefix_sums(self.codes)
        of = np.repeat(np.arange(len(forms)), np.maximum(0, self.lengths - k + 1))
        place = np.arange(len(of)) - np.repeat(np.cumsum(np.maximum(0, self.lengths - k + 1)) - np.maximum(0, self.lengths - k + 1), np.maximum(0, self.lengths - k + 1))
        self.form, self.place = of, place
        self.seeds = Seeds(windows(sums, self.starts[of] + place, k) if len(of) else np.zeros(0, np.uint64), np.arange(len(of)))

    def best(self, reads: list[str]) -> tuple[np.ndarray, ...]:
        """read, form, start in the read, start in the form, length and score of the best segment of each read that has
        one: of equals the first form, then the first start in the read and in the form."""
        lengths = np.fromiter(map(len, reads), np.int64, len(reads))
        starts = np.concatenate([[0], np.cumsum(lengths)])[:-1]
        codes = letters("".join(reads))
        owner = np.repeat(np.arange(len(reads)), lengths)
        rows = np.zeros((0, 6), np.int64)
        for begin, own, end in steps(len(codes), self.k - 1):
            h = all_windows(prefix_sums(codes[begin:end]), self.k)[: own - begin]
            for place, seed in self.seeds.met(h):
                place = begin + place
                read = owner[place]
                inside = place + self.k <= starts[read] + lengths[read]
                read, place, seed = read[inside], place[inside], seed[inside]
                form = self.form[seed]
                diagonal = place - starts[read] - self.place[seed]
                one = np.unique(np.stack([read, form, diagonal], 1), axis=0)
                rows = _first_rows(np.concatenate([rows, self._scored(codes, starts, lengths, one)]))
        return tuple(rows.T)

    def _scored(self, codes: np.ndarray, starts: np.ndarray, lengths: np.ndarray, diagonals: np.ndarray) -> np.ndarray:
        parts = [np.zeros((0, 6), np.int64)]
        if len(diagonals):
            overlap = np.minimum(self.lengths[diagonals[:, 1]], lengths[diagonals[:, 0]] - diagonals[:, 2]) - np.maximum(0, -diagonals[:, 2])
            order = np.argsort(overlap, kind="stable")
            at = 0
            while at < len(order):  # rows of about one length together
                width = int(overlap[order[min(at + PAIRS // 16, len(order)) - 1]])
                to = min(len(order), at + max(1, min(PAIRS // 16, (1 << 22) // max(width, 1))))
                parts.append(self._segments(codes, starts, diagonals[order[at:to]], overlap[order[at:to]]))
                at = to
        return np.concatenate(parts)

    def _segments(self, codes: np.ndarray, starts: np.ndarray, diagonals: np.ndarray, overlap: np.ndarray) -> np.ndarray:
        read, form, diagonal = diagonals.T
        x, y = np.maximum(diagonal, 0), np.maximum(-diagonal, 0)
        width = int(overlap.max())
        steps_ = np.arange(width)
        inside = steps_ < overlap[:, None]
        a = codes[np.where(inside, (starts[read] + x)[:, None] + steps_, 0)]
        b = self.codes[np.where(inside, (self.starts[form] + y)[:, None] + steps_, 0)]
        score = np.where(inside, np.where(a == b, self.match, self.mismatch), -(1 << 20))
        sums = np.zeros((len(read), width + 1), np.int64)
        np.cumsum(score, axis=1, out=sums[:, 1:])
        lowest = np.minimum.accumulate(sums[:, :-1], axis=1)
        gain = sums[:, 1:] - lowest
        last = gain.argmax(axis=1)
        top = gain[np.arange(len(read)), last]
        # the segment begins after the last of the lowest sums before its end
        low = (sums[:, :-1] == lowest[np.arange(len(read)), last][:, None]) & (steps_ <= last[:, None])
        first = width - 1 - low[:, ::-1].argmax(axis=1)
        good = top >= self.least
        return np.stack([read, form, x + first, y + first, last - first + 1, top], 1)[good]


def _first_rows(rows: np.ndarray) -> np.ndarray:
    """The best row of each read."""
    order = np.lexsort((rows[:, 3], rows[:, 2], rows[:, 1], -rows[:, 5], rows[:, 0]))
    rows = rows[order]
    return rows[np.unique(rows[:, 0], return_index=True)[1]]
