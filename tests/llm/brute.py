"""Plain Python versions of the operators, for small fixtures."""

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text, lower=False):
    text = text or ""
    return WORD.findall(text.translate(LOWER) if lower else text)


def shingles(text, n):
    w = words(text, lower=True)
    if not w:
        return set()
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)}


def jaccard_components(rows, n, percent):
    """rows: (doc_id, text) -> sorted [(doc_id, n_shingles, component)]."""
    sets = [shingles(t, n) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            same = rows[i][0] == rows[j][0]
            near = a and b and 100 * len(a & b) >= percent * len(a | b)
            if rows[i][0] is not None and rows[j][0] is not None and (same or near):
                parent[root(i)] = root(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[root(i)] = min(d, low.get(root(i), d))
    return sorted(((d, len(sets[i]), low.get(root(i)) if d is not None else None) for i, (d, _) in enumerate(rows)),
                  key=lambda r: (r[0] is None, r[0] or 0, r[1]))


def substrings(rows, threshold):
    """rows: (doc_id, text) -> [(doc_id, n_words, removed flags, kept text)] in input order."""
    big = float("inf")
    first = {}
    for d, t in rows:
        w = words(t)
        for i in range(len(w) - threshold + 1):
            k = tuple(w[i:i + threshold])
            first[k] = min(first.get(k, big), big if d is None else d)
    out = []
    for d, t in rows:
        w = words(t)
        gone = [False] * len(w)
        for i in range(len(w) - threshold + 1):
            if first[tuple(w[i:i + threshold])] < (big if d is None else d):
                gone[i:i + threshold] = [True] * threshold
        out.append((d, len(w), gone, " ".join(x for x, g in zip(w, gone) if not g)))
    return out


def alignment(item, text):
    """Best local alignment score of two word lists (match 2, mismatch -1, gap -1)."""
    best, above = 0, [0] * (len(text) + 1)
    for x in item:
        row = [0]
        for j, y in enumerate(text):
            row.append(max(0, above[j] + (2 if x == y else -1), above[j + 1] - 1, row[j] - 1))
        best, above = max(best, *row), row
    return best
