"""Operator 11, spelling variants: words that differ by one code point, found by pairs of minimal acyclic automata.

Texts give runs of letters (A-Z in lower case), of which some lose a letter by a rule of their checksum (see `tally`); words
are the distinct results of MIN_LENGTH code points or more that occur MIN_COUNT times or more.

Two words are near if they differ by one inserted, deleted or replaced code point. Of such a pair, let t be the length of the
shorter one. Either their first t // 2 code points agree or their last t - t // 2 do, so words are dealt to groups by
these halves. In each group the words are the language of a minimal acyclic automaton (forward: by their first halves;
backward: the same over reversed words). Every state knows how many words it accepts, so the steps of a walk add up to a
perfect-hash number, the word's place in the sorted list, and no text is needed to tell what was met. All words of a group walk
at once: the exact half first, then the rest with exactly one error. What both automata could tell is taken from one of
them, by the place where the two words begin to differ.

A word registers in four groups at most, and only partial answers (number of near words, best near word) leave a group.
Halves that more than HOT_WORDS words share are split by the same argument once more: either the next quarter agrees, or
what comes after it. Groups hold about GROUP_WORDS words; nothing but their number goes to the driver.

Edge cases: null texts have no runs; a null id is written as nothing in the checksum; a run that loses its only letter is
no word; repeated rows count each; runs and texts of any length are taken whole; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, materialise, measured

MIN_LENGTH, MIN_COUNT, RATIO, DROP = 6, 5, 5, 199
#: Words of a group, words that share a half before it is split, and distinct words that a task counts before it hands them on.
GROUP_WORDS, HOT_WORDS, HELD_WORDS = 100_000, 20_000, 400_000
#: Fixed value: a run of letters.
RUN = re.compile("[A-Za-zÀ-ÿ]+")


def altered(run: str, h: int) -> str:
    """The run, without one letter if DROP divides its checksum."""
    if h % DROP:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def tally(ids: Iterator, texts: Iterator, least: int = MIN_LENGTH) -> Iterator[dict[str, int]]:
    """Counts of words with `least` code points or more, handed on in tables of about HELD_WORDS. ids: decimal or None."""
    held: dict[str, int] = {}
    for i, text in zip(ids, texts, strict=True):
        if not text:
            continue
        start = zlib.crc32(b":" if i is None else b"%d:" % i)
        # bytes.lower() knows A-Z alone
        for run, n in Counter(RUN.findall(text.encode().lower().decode())).items():
            if len(run) < least:
                continue
            word = altered(run, zlib.crc32(run.encode(), start))
            if len(word) >= least:
                held[word] = held.get(word, 0) + n
        if len(held) >= HELD_WORDS:
            yield held
            held = {}
    if held:
        yield held


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """word and n, its occurrences in all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def columns(name: str):
            return (v for b in held for v in b.column(name).to_pylist())

        for batch in batches:
            held = [batch]
            for found in tally(columns("id"), columns("text"), min_length):
                yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())], names=["word", "n"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    counted = map_batches(rows, run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.filter(F.col("n") >= min_count)


class Automaton:
    """The minimal acyclic automaton of sorted, distinct byte strings, with perfect-hash numbers: arrays of transitions in
    order of (state, byte), each with its target and with the number of words that the state has before it."""

    def __init__(self, words: list[bytes]):
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        starts = np.concatenate([[0], np.cumsum(lengths)])
        body = np.frombuffer(b"".join(words), np.uint8)
        shared = shared_prefixes(body, starts[:-1], lengths)
        # the trie: word j makes nodes for its letters after the first shared[j]
        made = lengths - shared
        ends = np.cumsum(made)
        total = int(ends[-1]) if len(words) else 0
        letter = np.repeat(starts[:-1] + shared - (ends - made), made) + np.arange(total)
        depth = (letter - np.repeat(starts[:-1], made)) + 1
        char = np.concatenate([np.zeros(1, np.uint8), body[letter]])
        depth = np.concatenate([[0], depth])
        parent = np.arange(-1, total)  # of a letter after a new one; nodes count from 1, the root is 0
        path = [0]
        last = np.zeros(len(words), np.int64)
        for j, (keep, size, end) in enumerate(zip(shared.tolist(), lengths.tolist(), ends.tolist(), strict=True)):
            del path[keep + 1 :]
            if size > keep:
                parent[end - (size - keep) + 1] = path[keep]
                path.extend(range(end - (size - keep) + 1, end + 1))
            last[j] = path[-1]
        final = np.zeros(total + 1, bool)
        final[last] = True
        self._minimise(char, depth, parent, final)

    def _minimise(self, char: np.ndarray, depth: np.ndarray, parent: np.ndarray, final: np.ndarray) -> None:
        """Nodes of one right language become one state, from the lowest nodes up: a node's language is told by its
        letters and the states behind them."""
        count, height = final.astype(np.int64), np.zeros(len(char), np.int64)
        by_depth = np.argsort(depth, kind="stable")
        cuts = np.searchsorted(depth[by_depth], np.arange(int(depth.max()) + 2))
        for d in range(len(cuts) - 2, 0, -1):
            nodes = by_depth[cuts[d] : cuts[d + 1]]
            np.add.at(count, parent[nodes], count[nodes])
            np.maximum.at(height, parent[nodes], height[nodes] + 1)
        sign, state, models = final.astype(np.uint64), np.zeros(len(char), np.int64), []
        by_height = np.argsort(height, kind="stable")
        cuts = np.searchsorted(height[by_height], np.arange(int(height.max()) + 2))
        known = 0
        for h in range(len(cuts) - 1):
            nodes = by_height[cuts[h] : cuts[h + 1]]
            _, first, of = np.unique(sign[nodes], return_index=True, return_inverse=True)
            state[nodes] = known + of
            models.append(nodes[first])
            known += len(first)
            above = nodes[nodes > 0]
            np.add.at(sign, parent[above], scramble((state[above].astype(np.uint64) << np.uint64(8)) | char[above]))
        model = np.concatenate(models)
        self.final, self.root = final[model], int(state[0])
        kept = np.flatnonzero(model[state[parent[1:]]] == parent[1:]) + 1  # steps that leave a state's model
        key = state[parent[kept]] * 256 + char[kept]
        order = np.argsort(key)
        self.key, self.target, size = key[order], state[kept][order], count[kept][order]
        self.first = np.searchsorted(self.key, np.arange(known + 1) * 256)
        before = np.concatenate([[0], np.cumsum(size)])
        source = self.key >> 8
        self.before = before[:-1] - before[self.first[source]] + self.final[source]

    def step(self, state: np.ndarray, char: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where states go by a byte each: which of them go on, to what state, and what their number grows by."""
        wanted = state * 256 + char
        at = np.searchsorted(self.key, wanted)
        at[at == len(self.key)] = 0
        on = np.flatnonzero(self.key[at] == wanted) if len(self.key) else np.zeros(0, np.int64)
        return on, self.target[at[on]], self.before[at[on]]

    def spread(self, state: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All steps of each state: the place of the state, and the step."""
        low, n = self.first[state], self.first[state + 1] - self.first[state]
        of = np.repeat(np.arange(len(state)), n)
        return of, np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n) + low[of]

    def one_error(self, body: np.ndarray, starts: np.ndarray, lengths: np.ndarray, exact: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(query, word number) of every word that is a query with one letter replaced or put in, after the first `exact`
        letters. Queries stand in body; all of them walk at once, a letter in each round."""
        true = np.arange(len(starts))  # queries that have had no error, and where they are
        at, number = np.full(len(starts), self.root), np.zeros(len(starts), np.int64)
        wrong, wrong_at, wrong_number, shift = (np.zeros(0, np.int64) for _ in range(4))  # shift: 1 after a letter put in
        found: list[tuple[np.ndarray, np.ndarray]] = []
        for p in range(int(lengths.max(initial=-1)) + 2):
            # those with an error take the letter p - shift; at their end they are found if the automaton accepts
            done = p - shift == lengths[wrong]
            good = done & self.final[wrong_at]
            found.append((wrong[good], wrong_number[good]))
            wrong, wrong_at, wrong_number, shift = wrong[~done], wrong_at[~done], wrong_number[~done], shift[~done]
            on, to, more = self.step(wrong_at, body[starts[wrong] + p - shift])
            wrong, wrong_at, wrong_number, shift = wrong[on], to, wrong_number[on] + more, shift[on]
            # an error at letter p
            may = np.flatnonzero(exact[true] <= p)
            of, steps = self.spread(at[may])
            query = true[may][of]
            inside = lengths[query] > p
            letter = body[np.where(inside, starts[query] + p, 0)] if len(body) else np.zeros(len(query), np.uint8)
            differs = ~inside | ((self.key[steps] & 255) != letter)  # a letter put in before its like is put in after it as well
            replaced = inside & differs
            both = np.concatenate([np.flatnonzero(replaced), np.flatnonzero(differs)])
            wrong = np.concatenate([wrong, query[both]])
            wrong_at = np.concatenate([wrong_at, self.target[steps[both]]])
            wrong_number = np.concatenate([wrong_number, number[may][of][both] + self.before[steps[both]]])
            shift = np.concatenate([shift, np.zeros(int(replaced.sum()), np.int64), np.ones(int(differs.sum()), np.int64)])
            # those without one
            left = np.flatnonzero(lengths[true] > p)
            true, at, number = true[left], at[left], number[left]
            on, to, more = self.step(at, body[starts[true] + p])
            true, at, number = true[on], to, number[on] + more
        return tuple(np.concatenate(x) for x in zip(*found, strict=True)) if found else (true, true)


def scramble(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers, so that sums of few of them tell sets apart."""
    x = (x + np.uint64(0x632BE59BD9B4E019)) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xA24BAED4963EE407)
    return x ^ (x >> np.uint64(29))


def shared_prefixes(body: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """How many first bytes each string shares with the one before it."""
    out = np.zeros(len(starts), np.int64)
    return _agreeing(body, starts[1:], starts[:-1], np.minimum(lengths[1:], lengths[:-1]), out, 1)


def _agreeing(body: np.ndarray, a: np.ndarray, b: np.ndarray, most: np.ndarray, out: np.ndarray, skip: int = 0) -> np.ndarray:
    """The first bytes that the strings at a and b share, up to `most`, put into out from place skip on."""
    on, k = np.flatnonzero(most > 0), 0
    while len(on):
        on = on[body[a[on] + k] == body[b[on] + k]]
        k += 1
        out[on + skip] = k
        on = on[most[on] > k]
    return out


def near_words(words: list[bytes], backward: bool, low: np.ndarray, high: np.ndarray, asks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (a, b) of places in a list of distinct Latin-1 words: b is a with one letter replaced or put in, a is one of those
    that ask, and the two begin to differ at a place from low[a] to high[a] (excluded)."""
    forms = [w[::-1] for w in words] if backward else words
    order = sorted(range(len(forms)), key=forms.__getitem__)
    automaton = Automaton([forms[i] for i in order])
    query = np.flatnonzero(asks)
    lengths = np.fromiter((len(words[i]) for i in query), np.int64, len(query))
    starts = np.concatenate([[0], np.cumsum(lengths)])[:-1]
    body = np.frombuffer(b"".join(forms[i] for i in query), np.uint8)
    half = lengths // 2
    of, number = automaton.one_error(body, starts, lengths, lengths - half if backward else half)
    a, b = query[of], np.array(order, np.int64)[number]
    all_lengths = np.fromiter(map(len, words), np.int64, len(words))
    all_starts = np.concatenate([[0], np.cumsum(all_lengths)])[:-1]
    text = np.frombuffer(b"".join(words), np.uint8)
    place = _agreeing(text, all_starts[a], all_starts[b], np.minimum(all_lengths[a], all_lengths[b]), np.zeros(len(a), np.int64))
    mine = (place >= low[a]) & (place < high[a])
    return a[mine], b[mine]


def registered(words: DataFrame, hot_words: int = HOT_WORDS) -> DataFrame:
    """A row for each half that a word shares with near words: key, backward, word, n, asks (the word is the shorter or an
    equal one of its pairs there), and the places low to high (excluded) of first differences that the key stands for."""
    length = F.length("word")

    def rows(asks: bool) -> DataFrame:
        t = length if asks else length - 1
        return words.select("word", "n", t.alias("t"), F.lit(asks).alias("asks"))

    both = rows(True).unionByName(rows(False)).withColumn("half", F.floor(F.col("t") / 2).cast("int"))
    size, half = F.col("t"), F.col("half")
    head = lambda n: F.left("word", n)
    tail = lambda n: F.right("word", n)
    kind = lambda name, key, backward, low, high: F.struct(F.concat_ws("|", F.lit(name), size, key).alias("key"), F.lit(backward).alias("backward"), low.alias("low"), high.alias("high"))
    far = (length + 1).cast("int")
    whole = F.array(kind("f", head(half), False, half, far), kind("b", tail(size - half), True, F.lit(0), half))
    keyed = both.select("word", "n", "t", "half", "asks", F.explode(whole).alias("k")).select("word", "n", "t", "half", "asks", "k.*")
    hot = keyed.groupBy("key").agg(F.count("*").alias("__n")).filter(F.col("__n") > hot_words).select("key", F.lit(True).alias("hot"))
    marked = keyed.join(measured(hot.select("key", F.lit(1).alias("hot"))), "key", "left")
    # forward, differences in the second half: before or from its middle; backward the same in the first half
    middle = F.when(F.col("backward"), F.floor(half / 2)).otherwise(half + F.floor((size - half) / 2)).cast("int")
    split = F.when(
        F.col("backward"),
        F.array(kind("bl", tail(size - middle), True, F.lit(0), middle), kind("bm", F.concat_ws("|", head(middle), tail(size - half)), True, middle, half)),
    ).otherwise(F.array(kind("fm", F.concat_ws("|", head(half), tail(size - middle)), False, half, middle), kind("fl", head(middle), False, middle, far)))
    same = F.array(F.struct("key", "backward", "low", "high"))
    return marked.select("word", "n", "asks", F.explode(F.when(F.col("hot").isNotNull(), split).otherwise(same)).alias("k")).select("word", "n", "asks", "k.*")


def _answers(table: pa.Table) -> pa.Table:
    """Partial answers of a group: for each word the number of near words met, and the best of them."""
    backward = table.column("backward")[0].as_py()
    listed = table.column("word").to_pylist()
    names = sorted(set(listed))
    place = {w: i for i, w in enumerate(names)}
    at = np.fromiter((place[w] for w in listed), np.int64, len(listed))
    asks = table.column("asks").to_numpy().astype(bool)
    n, low, high = (np.zeros(len(names), np.int64) for _ in range(3))
    n[at] = table.column("n").to_numpy()
    far, asking = np.zeros(len(names), np.int64), np.zeros(len(names), bool)
    parts = []
    # a word may ask under several keys of the group, of which each stands for its own places
    kinds = np.unique(np.stack([table.column("low").to_numpy()[asks], table.column("high").to_numpy()[asks], at[asks]], 1), axis=0)
    while len(kinds):
        _, first = np.unique(kinds[:, 2], return_index=True)
        now = kinds[first]
        asking[:] = False
        asking[now[:, 2]] = True
        low[now[:, 2]], far[now[:, 2]] = now[:, 0], now[:, 1]
        parts.append(near_words([w.encode("latin-1") for w in names], backward, low, far, asking))
        kinds = np.delete(kinds, first, axis=0)
    a, b = (np.concatenate(x) for x in zip(*parts, strict=True)) if parts else (at[:0], at[:0])
    longer = np.fromiter(map(len, names), np.int64, len(names))
    # a replaced letter is met from both sides, one put in from the shorter side only
    put = longer[a] != longer[b]
    a, b = np.concatenate([a, b[put]]), np.concatenate([b, a[put]])
    a, b = np.divmod(np.unique(a * len(names) + b), max(1, len(names)))
    order = np.lexsort((b, -n[b], a))  # names are in code-point order
    a, b = a[order], b[order]
    which, first, near = np.unique(a, return_index=True, return_counts=True)
    best = b[first]
    return pa.table({"word": pa.array([names[i] for i in which], pa.string()), "near": pa.array(near, pa.int64()), "best_n": pa.array(n[best], pa.int64()), "best": pa.array([names[i] for i in best], pa.string())})


def near_summary(words: DataFrame, group_words: int = GROUP_WORDS, hot_words: int = HOT_WORDS) -> DataFrame:
    """word, n_near, best (the near word of largest n, of equals the first) and best_n, for words with near words."""
    rows = registered(words, hot_words)
    groups = max(1, -(-4 * words.count() // group_words))
    dealt = rows.withColumn("part", F.pmod(F.xxhash64("key"), F.lit(groups)))
    found = dealt.groupBy("backward", "part").applyInArrow(_answers, "word string, near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("less"), F.col("best").alias("best")))
    summed = found.groupBy("word").agg(F.sum("near").alias("n_near"), best.alias("b"))
    return summed.select("word", "n_near", F.col("b.best").alias("best"), (-F.col("b.less")).alias("best_n"))


def roots(forms: DataFrame) -> DataFrame:
    """word and root for (word, form): forms are followed to the last. A form occurs RATIO times as often as its word, so
    chains are short; each round doubles the steps that are known."""
    known = materialise(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        further = known.select(F.col("word").alias("root"), F.col("root").alias("further"))
        longer = materialise(known.join(further, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("grew")), "forms")
        known = longer.select("word", "root")
        if longer.filter("grew").isEmpty():
            return known


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """word, form, root, n, n_near and form_n of all words. form: the near word that occurs most, if it does RATIO times
    as often as the word at least; root: the last of the chain of forms, the word itself if it has none."""
    words = materialise(word_counts(docs, id_col, text_col, min_length, min_count), "words")
    near = near_summary(words)
    fits = F.col("best_n") >= RATIO * F.col("n")
    found = words.join(near, "word", "left").select(
        "word", F.when(fits, F.col("best")).alias("form"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(fits, F.col("best_n")).alias("form_n")
    )
    found = materialise(found, "near-words")
    last = roots(found.filter("form is not null"))
    return found.join(last, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
