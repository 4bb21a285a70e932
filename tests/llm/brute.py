"""Plain-Python versions of what the operators compute."""

import re

SPLIT = re.compile(r"[\x20\x09-\x0D]+")


def fold(s):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in s)


def words(text):
    return [x for x in SPLIT.split(fold(text or "")) if x]


def shingle_set(text):
    w = words(text)
    return frozenset(tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()


def near_components(rows, similarity=85):
    """(doc_id, text) rows -> doc_id -> smallest doc_id reachable."""
    parent = {}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    sets = [(i, shingle_set(t)) for i, t in rows if i is not None]
    for i, _ in sets:
        parent.setdefault(i, i)
    for a in range(len(sets)):
        for b in range(a):
            (i, x), (j, y) = sets[a], sets[b]
            if x and y and 100 * min(len(x), len(y)) >= similarity * max(len(x), len(y)):
                n = len(x & y)
                if 100 * n >= similarity * (len(x) + len(y) - n):
                    p, r = root(i), root(j)
                    parent[max(p, r)] = min(p, r)
    return {i: root(i) for i in parent}
