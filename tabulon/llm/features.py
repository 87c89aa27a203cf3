"""Hashed binary features and surface statistics of texts, in arrays, and a
small regularised logistic regression for bounded samples.

Feature kinds: whole words and their first 4 and 5 bytes (lower-cased, without
surrounding ASCII punctuation), word shapes (runs of one character class), pairs
of neighbouring shapes, and steps of the surface statistics. All are present or
absent, so the length of a text does not scale its score."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from .words import Words, _BYTE, _LOWER, _POW, mix, split

DIMS = 1 << 18
BLOCK = 100                   # words
TOLERANCE = 1e-9
PART = 1 << 19                # features of the sample looked at together
WORDS, SHAPES = "words", "shapes"

_CLASS = np.arange(256, dtype=np.uint8)
_CLASS[48:58] = ord("0")
_CLASS[65:91] = ord("A")
_CLASS[97:123] = ord("a")
_CLASS[128:] = ord("a")
_LETTER = (_CLASS == ord("a")) | (_CLASS == ord("A")) | (_CLASS == ord("0"))
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#$%&*+/<=>@\\^_`{|}~[]")] = True
_END = np.zeros(256, bool)
_END[list(b".!?")] = True
STATS = ("n_words", "symbols", "capitals", "exclaimed", "bars", "odd", "repeated", "distinct", "top", "ended")
_STEPS = (0.01, 0.05, 0.1, 0.2, 0.3, 0.5, 0.8)


def _by_text(value: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of a value by word, for each text."""
    total = np.concatenate([[0], np.cumsum(value, dtype=np.int64)])
    return total[first[1:]] - total[first[:-1]]


def statistics(w: Words) -> dict[str, np.ndarray]:
    """Surface statistics of each text: shares of words, and of capitals among letters."""
    n = w.counts()
    share = np.maximum(n, 1)
    last = w.data[w.end - 1] if len(w.end) else np.zeros(0, np.uint8)
    before = np.concatenate([[False], w.hash[1:] == w.hash[:-1]])[:len(w.hash)]
    inner = w.start > w.start[w.first[w.text_of()]] if len(w.start) else before
    symbol = _SYMBOL[last]
    edge = np.append(w.start, len(w.data))
    low, high = edge[np.minimum(w.first[:-1], len(edge) - 1)], edge[np.minimum(w.first[1:], len(edge) - 1)]
    upper = np.concatenate([[0], np.cumsum((w.data >= 65) & (w.data <= 90), dtype=np.int64)])
    letter = np.concatenate([[0], np.cumsum((_CLASS[w.data] == 97) | (_CLASS[w.data] == 65), dtype=np.int64)])
    text = w.text_of()
    # distinct and most frequent words are counted in blocks of the text, so
    # that a long text is not a repetitive one; one sort of (block, hash) keys
    blocks = -(-n // BLOCK)
    first_block = np.concatenate([[0], np.cumsum(blocks)])
    block = first_block[text] + (np.arange(len(text)) - w.first[text]) // BLOCK
    room = np.uint64(max(1, int(first_block[-1]).bit_length()))
    key = np.sort((block.astype(np.uint64) << (np.uint64(64) - room)) | (w.hash >> room))
    fresh = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])[:len(key)])
    of = (key[fresh] >> (np.uint64(64) - room)).astype(np.int64)
    owner = np.repeat(np.arange(len(n)), blocks)
    most = np.zeros(int(first_block[-1]), np.int64)
    np.maximum.at(most, of, np.diff(np.append(fresh, len(key))))
    size = w.end - w.start
    twice = (size > 1) & (w.data[w.end - 2] == last) & ~_LETTER[last] & (last != ord("."))
    caps = (size > 2) & (upper[w.end] - upper[w.start] > 2) & (letter[w.end] - letter[w.start] == upper[w.end] - upper[w.start])
    strange = twice | ((size == 1) & (last == ord("|"))) | caps
    return {"n_words": n, "symbols": _by_text(symbol, w.first) / share,
            "capitals": (upper[high] - upper[low]) / np.maximum(letter[high] - letter[low], 1),
            "exclaimed": _by_text(last == ord("!"), w.first) / share,
            "bars": _by_text((w.end - w.start == 1) & (last == ord("|")), w.first) / share,
            "odd": _by_text(strange, w.first) / share,
            "repeated": _by_text(before & inner, w.first) / share,
            "distinct": np.bincount(owner[of], minlength=len(n)) / share,
            "top": np.bincount(owner, weights=most, minlength=len(n)) / share,
            "ended": _by_text(_END[last], w.first) / share}


def _shapes(w: Words) -> np.ndarray:
    """Hash of each word's runs of character classes."""
    if not len(w.start):
        return np.zeros(0, np.uint64)
    kind = _CLASS[w.data]
    run = np.ones(len(kind), bool)
    run[1:] = kind[1:] != kind[:-1]
    run[w.start] = True
    place = np.cumsum(run)
    length = np.diff(np.append(w.start, len(kind)))
    place = place[w.start[0]:] - np.repeat(place[w.start], length)
    with np.errstate(over="ignore"):
        value = np.where(run[w.start[0]:], _BYTE[kind[w.start[0]:]] * _POW[place & 65535], np.uint64(0))
        return mix(np.add.reduceat(value, w.start - w.start[0]))


def _stems(w: Words) -> list[np.ndarray]:
    """Hashes of each word in lower case without surrounding punctuation:
    whole, 4 and 5 bytes."""
    if not len(w.start):
        return [np.zeros(0, np.uint64)] * 3
    begin = int(w.start[0])
    data = _LOWER[w.data[begin:]]
    letter = _LETTER[data]
    start, end = w.start - begin, w.end - begin
    n = len(data)
    place = np.arange(n, dtype=np.int32 if n < 1 << 31 else np.int64)
    after = np.minimum.accumulate(np.where(letter, place, n)[::-1])[::-1]
    until = np.maximum.accumulate(np.where(letter, place, -1)) + 1
    lo = np.minimum(after[start], end)
    hi = np.maximum(until[end - 1], lo)
    length = np.diff(np.append(start, n))
    off = place - np.repeat(lo.astype(place.dtype), length)
    inside = (off >= 0) & (off < np.repeat((hi - lo).astype(place.dtype), length))
    out = []
    with np.errstate(over="ignore"):
        value = _BYTE[data] * _POW[off & 65535]
        value[~inside] = 0
        for k in (None, 5, 4):
            if k:
                value[off >= k] = 0
            out.append(mix(np.add.reduceat(value, start) + np.uint64(k or 1)))
    return out


def hashed(w: Words, kinds: tuple[str, ...], column: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, dict[str, np.ndarray]]:
    """(feature, text number) sorted and distinct, and the statistics. With
    ``column`` only the features that have a column (>= 0) are kept."""
    text, stats = w.text_of(), statistics(w)
    keys, owner = [], []

    def add(h: np.ndarray, of: np.ndarray, salt: int) -> None:
        with np.errstate(over="ignore"):
            key = ((h + np.uint64(salt) * np.uint64(0x9E3779B97F4A7C15)) & np.uint64(DIMS - 1)).astype(np.int64)
        if column is not None:
            known = np.flatnonzero(column[key] >= 0)
            key, of = key[known], of[known]
        keys.append(key)
        owner.append(of)

    if WORDS in kinds:
        for salt, h in enumerate(_stems(w)):
            add(h, text, 10 + salt)
    if SHAPES in kinds:
        shape = _shapes(w)
        add(shape, text, 1)
        if len(shape) > 1:
            pair = np.flatnonzero(text[1:] == text[:-1])
            with np.errstate(over="ignore"):
                add(mix(shape[pair] * np.uint64(3) + shape[pair + 1]), text[pair], 2)
        for j, name in enumerate(STATS[1:]):
            for k, step in enumerate(_STEPS):
                of = np.flatnonzero((stats[name] >= step) & (stats["n_words"] > 0))
                add(mix(np.full(len(of), 100 * j + k, np.uint64)), of, 3)
    key = np.unique(np.concatenate(owner).astype(np.int64) * DIMS + np.concatenate(keys))
    return key % DIMS, key // DIMS, stats


def of_texts(texts: pa.Array, kinds: tuple[str, ...], column: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, dict[str, np.ndarray]]:
    return hashed(split(texts), kinds, column)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))


class Linear:
    """Logistic regression on binary features (column numbers by row) and a few
    dense columns, L2-regularised, fitted by L-BFGS on a bounded sample until
    a step lowers the loss by less than ``TOLERANCE``. Features are gone through
    in parts of ``PART``, so that only the sample itself takes memory."""

    def __init__(self, width: int, dense: int, l2: float = 1e-4):
        self.width, self.dense, self.l2 = width, dense, l2
        self.w = np.zeros(width + dense + 1)

    def margin(self, row: np.ndarray, col: np.ndarray, extra: np.ndarray, w: np.ndarray | None = None) -> np.ndarray:
        w = self.w if w is None else w
        z = np.zeros(len(extra))
        for s in range(0, len(row), PART):
            z += np.bincount(row[s:s + PART], weights=w[col[s:s + PART]], minlength=len(extra))
        return z + extra @ w[self.width:-1] + w[-1]

    def probability(self, row: np.ndarray, col: np.ndarray, extra: np.ndarray) -> np.ndarray:
        return sigmoid(self.margin(row, col, extra))

    def fit(self, row: np.ndarray, col: np.ndarray, extra: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None,
            scale: np.ndarray | None = None) -> Linear:
        """y may be a probability. A sample of one class gives its prior.
        ``scale`` sets how far each binary feature's weight may go: its
        penalty is divided by the square of its scale."""
        n = len(y)
        weight = np.ones(n) if weight is None else weight
        total = max(weight.sum(), 1e-9)
        prior = (float((weight * y).sum()) + 0.5) / (total + 1.0)
        w = np.zeros_like(self.w)
        w[-1] = np.log(prior / (1 - prior))
        by = np.ones_like(w)
        if scale is not None:
            by[:self.width] = scale
        if n == 0 or not 0 < (weight * y).sum() < total:
            self.w = w
            return self

        if len(row) and (np.diff(row) < 0).any():
            order = np.argsort(row, kind="stable")
            row, col = row[order], col[order]
        # (features, places of their first ones by row, rows, numbers of features) of each part, in whole rows
        head = np.append(0, np.flatnonzero(row[1:] != row[:-1]) + 1) if len(row) else np.zeros(0, np.int64)
        filled, many, parts, s = row[head], np.diff(np.append(head, len(row))), [], 0
        while s < len(head):
            e = max(s + 1, int(np.searchsorted(head, head[s] + PART)))
            parts.append((col[head[s]:head[e] if e < len(head) else len(col)], head[s:e] - head[s], filled[s:e], many[s:e]))
            s = e

        def loss(v):
            u = v * by
            z = extra @ u[self.width:-1] + u[-1]
            for c, first, of, _ in parts:
                z[of] += np.add.reduceat(u[c], first)
            p = sigmoid(z)
            r = weight * (p - y) / total
            g = np.zeros(self.width)
            for c, _, of, size in parts:
                g += np.bincount(c, weights=np.repeat(r[of], size), minlength=self.width)
            g = np.concatenate([g, extra.T @ r, [r.sum()]])
            reg = self.l2 * v
            reg[-1] = 0
            z = np.clip(z, -30, 30)
            value = float((weight * (np.logaddexp(0, z) - y * z)).sum() / total) + 0.5 * float(reg @ v)
            return value, g * by + reg

        old_s, old_y = [], []
        f, g = loss(w)
        while True:
            q, alpha = g.copy(), []
            for s, t in zip(reversed(old_s), reversed(old_y)):
                a = (s @ q) / (s @ t)
                alpha.append(a)
                q -= a * t
            q *= (old_s[-1] @ old_y[-1]) / (old_y[-1] @ old_y[-1]) if old_s else 1.0
            for (s, t), a in zip(zip(old_s, old_y), reversed(alpha)):
                q += s * (a - (t @ q) / (s @ t))
            slope, size = float(g @ q), 1.0
            if slope <= 0:
                q, slope = g, float(g @ g)
            while True:
                v = w - size * q
                fv, gv = loss(v)
                if fv <= f - 1e-4 * size * slope or size < 1e-8:
                    break
                size /= 2
            if not fv <= f:
                break
            s, t = v - w, gv - g
            if s @ t > 1e-14:
                old_s, old_y = [*old_s[-9:], s], [*old_y[-9:], t]
            done = f - fv < TOLERANCE
            w, f, g = v, fv, gv
            if done:
                break
        self.w = w * by
        return self
