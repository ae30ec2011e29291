"""Plain versions of the operators, for small tables."""

import re
from collections import defaultdict

WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def words(text):
    return WORD.findall(re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))


def shingle_set(text, short=True):
    w = words(text)
    if len(w) < 5:
        return {tuple(w)} if w and short else set()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def alike(a, b):
    return bool(a) and bool(b) and 5 * len(a & b) >= 4 * len(a | b)


def near_copies(rows):
    """{position: (copy_id, class_id, n_links)} for rows (doc_id, text)."""
    sets = [shingle_set(t) if i is not None else set() for i, t in rows]
    by_token = defaultdict(set)
    for i, s in enumerate(sets):
        for x in s:
            by_token[x].add(i)
    near = [{j for x in s for j in by_token[x] if j != i and alike(s, sets[j])} for i, s in enumerate(sets)]
    out, seen = {}, set()
    for i in range(len(rows)):
        if i in seen:
            continue
        group, todo = set(), [i]
        while todo:
            k = todo.pop()
            if k not in group:
                group.add(k)
                todo += near[k]
        seen |= group
        for k in group:
            if sets[k]:
                copies = [rows[j][0] for j in group if sets[j] == sets[k]]
                out[k] = (min(copies), min(rows[j][0] for j in group), len(near[k]))
            else:
                out[k] = (rows[k][0], rows[k][0], 0)
    return out


def dedup_lines(rows):
    """(n_lines, n_removed, text) for rows (doc_id, text, mark): mark puts texts of one id in order, rows alike in id and
    text are one document, and null ids come first."""
    order = lambda r: (r[0] is not None, r[0] or 0, r[2])
    lines = [(i, m, n, shingle_set(x)) for i, t, m in sorted({*rows}, key=order) for n, x in enumerate((t or "").split("\n"))]
    by_token, gone = defaultdict(list), set()
    for at, (i, m, n, s) in enumerate(lines):
        if any(alike(s, lines[j][3]) for j in {j for x in s for j in by_token[x]}):
            gone.add((i, m, n))
        for x in s:
            by_token[x].append(at)
    out = []
    for i, t, m in rows:
        parts = (t or "").split("\n")
        kept = [x for n, x in enumerate(parts) if (i, m, n) not in gone]
        out.append((len(parts), len(parts) - len(kept), "\n".join(kept)))
    return out
