import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, mark string, label int, row string, words string, root long, __gone string"


def words(r, n, vocabulary=400):
    return " ".join("".join(chr(97 + (w * 7 + i * i * (w + 3)) % 26) for i in range(2 + w % 5)) for w in (min(int(r.expovariate(0.01)), vocabulary - 1) for _ in range(n)))


def corpus():
    """Nulls, empties, copies, near copies, repeated rows, shared lines, odd characters and a long text."""
    r = random.Random(11)
    base = [words(r, 90) for _ in range(12)]
    line = "This very line stands in many texts and nobody ever changed it."
    rows = [(n, t) for n, t in enumerate(base)]
    rows += [(20 + n, base[n % 3]) for n in range(9)]  # copies
    for n in range(24):  # near copies of two texts
        w = base[3 + n % 2].split()
        for _ in range(1 + n % 3):
            w[r.randrange(len(w))] = "changed%d" % n
        rows.append((40 + n, " ".join(w)))
    rows += [(80 + n, f"{words(r, 30)}\n{line}\n{words(r, 12)}\n\n{line.upper()}") for n in range(6)]
    rows += [(100, ""), (101, None), (102, "one"), (103, "one"), (104, "two three"), (105, " \n\t\n "), (106, "Ünïcödé ΣΑΣ 日本語 𝄞 ́ <s> </s> <|endoftext|> \x00\x1c x"), (107, "ha " * 300)]
    rows += [(108, words(r, 30_000)), (None, base[5]), (None, None), (0, base[0]), (41, rows[22][1] if rows[22][0] == 41 else base[3]), (-5, base[6])]
    return rows


@pytest.fixture(scope="session")
def rows():
    return corpus()


@pytest.fixture(scope="session")
def docs(spark, rows):
    full = [(i, t, None if n % 7 == 0 else "en", "s", None if t is None else len(t), "k", None, 1, "r", "w", 5, "g") for n, (i, t) in enumerate(rows)]
    return spark.createDataFrame(full, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
