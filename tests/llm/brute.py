"""Brute-force versions and small tables for the tests of the training-data operators."""

import re

SF = "/root/testdata/sf0.001"
WS_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def shingles(text, k=5):
    w = WS_WORD.findall(lower(text))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1)))


def near_dup_rows(rows, percent=75, k=5):
    """[(doc_id, n, component)] in the order of rows [(doc_id, text)] (doc_ids distinct)."""
    sets = [shingles(t, k) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            inter = len(a & b)
            if inter and 100 * inter >= percent * (len(a) + len(b) - inter):
                parent[root(i)] = root(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        r = root(i)
        low[r] = min(low.get(r, d), d)
    return [(d, len(s), low[root(i)]) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))]
