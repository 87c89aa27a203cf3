"""Exact k-nearest-neighbour join and votes.

Most pairs are never compared. Inside a task, training rows are cut into blocks
of near rows (median splits of the widest dimension); a query is compared with
a block only where the block's box is no farther than the k-th distance the
query has found so far. Between tasks the same bound is used on a coarser
layout: training rows go to cells (regions of a median-split tree over a
bounded sample, which steers the layout only), every query is searched in its own
cell first, and is then sent only to the other cells whose region is no farther than
the k-th distance found there. The result is exact: a bound only ever rules out rows
that cannot be among the k.

* Few training rows (up to ``BROADCAST_BYTES`` of vectors, counted; not many more
  than queries): they are broadcast, and each task searches its queries in all of them.
* Few queries (up to ``BROADCAST_BYTES`` of vectors and ``BROADCAST_WINNERS``
  neighbours, counted): they are broadcast and the training rows are searched where
  they lie, without a shuffle (a training fold below ``train_block`` rows is dealt out
  to all cores first).
* Level codes at the end of a vector (``codes``) count as one-hot columns do, so a
  nominal column of any number of levels is one number a row; a block without the
  query's level is a whole mismatch away (two for a known level).
* In many dimensions boxes rule out little and all pairs have to be looked at: no
  cells then, and tasks screen tiles of pairs by a cheap lower bound (16-bit steps, or
  a matrix product) before exact distances are taken of those that pass.
* Otherwise every (cell, query block, training block) meets in one cogroup; no
  group exceeds one query block plus one training block (32,768 / 100,000 rows by
  default), however many rows share a cell.

The union of local winners is cut to the global k with ``row_number`` (Spark
plans a partial and final WindowGroupLimit) under the total order (distance
rounded to 9 places, neighbour key). Fold exclusion (train.fold <> query.fold)
lets all folds run in one job."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.exprs import argmax_index
from ..plans.sizing import bounded_broadcast, materialize
from ..session import give_back

NEIGHBOUR_SCHEMA = T.StructType([
    T.StructField("query", T.LongType()), T.StructField("neighbor", T.LongType()),
    T.StructField("label", T.IntegerType()), T.StructField("d", T.DoubleType()),
    T.StructField("d_r", T.DoubleType()),
])
BROADCAST_BYTES = 16 << 20    # of query vectors; more queries are shuffled to cells
BLOCK_BYTES = 24 << 20        # of vectors in a query or training block; a search copies them several times
DEALT_ROWS = 16_384           # fewer training rows are copied to query blocks instead
SAMPLE_ROWS = 8_192           # training rows that steer the cells and bound the k-th distances
LEAF_ROWS = 256               # training rows compared together
CHUNK_CELLS = 1 << 16         # distances computed together
PAIR_CELLS = 1 << 20          # coordinates of pairs subtracted together
QUERY_ROWS = 8_192            # queries searched together
SCREEN_ROWS = 8_192           # fewer training rows are never screened in tiles
TILE_ROWS = 4_096             # training rows screened together
VOTE_CELLS = 1 << 18          # (query, class) sums held together
BROADCAST_WINNERS = 1 << 20   # neighbours that each task may hold for the broadcast queries


def distances(queries: np.ndarray, rows: np.ndarray, metric: str, codes: int = 0) -> np.ndarray:
    """Distances (nq, nt), summed over the dimensions in order, as SQL does.

    The last ``codes`` dimensions are level codes. One-hot vectors of two levels
    differ in two places, those of a level and of an unseen one (negative) in one;
    both metrics sum that up (before the root)."""
    out = np.zeros((len(queries), len(rows)))
    step = np.empty_like(out)
    numeric = rows.shape[1] - codes
    for j in range(numeric, rows.shape[1]):
        q, t = queries[:, j, None], rows[None, :, j]
        if t.size and t.min() == t.max():                # blocks mostly hold one level
            t = t[:, :1]
        out += ((q != t) & (np.maximum(q, t) >= 0)) * (1.0 + ((q >= 0) & (t >= 0)))
    for j in range(numeric):
        np.subtract(queries[:, j, None], rows[None, :, j], out=step)
        np.abs(step, out=step) if metric == "manhattan" else np.multiply(step, step, out=step)
        out += step
    return np.sqrt(out, out=out) if metric == "euclidean" else out


def box_distances(queries: np.ndarray, low: np.ndarray, high: np.ndarray, metric: str, codes: int = 0) -> np.ndarray:
    """Least distance (nq, boxes) from each query to any point of each box. A code
    outside of the box's range differs from all codes in it."""
    out = np.zeros((len(queries), len(low)))
    for j in range(queries.shape[1]):
        q = queries[:, j, None]
        step = np.maximum(np.maximum(low[None, :, j] - q, q - high[None, :, j]), 0.0)
        if j >= queries.shape[1] - codes:               # two unseen levels are equal
            out += ((step > 0) & (np.maximum(q, high[None, :, j]) >= 0)) * (1.0 + ((q >= 0) & (low[None, :, j] >= 0)))
            continue
        out += step if metric == "manhattan" else step * step
    return np.sqrt(out, out=out) if metric == "euclidean" else out


def pair_distances(queries: np.ndarray, rows: np.ndarray, metric: str) -> np.ndarray:
    """Distances of paired rows, summed over the dimensions in order like ``distances``."""
    out = np.empty(len(queries))
    size = max(1, PAIR_CELLS // max(1, rows.shape[1]))
    for s in range(0, len(out), size):
        step = queries[s:s + size] - rows[s:s + size]
        np.abs(step, out=step) if metric == "manhattan" else np.multiply(step, step, out=step)
        out[s:s + size] = np.cumsum(step, axis=1, out=step)[:, -1] if step.shape[1] else 0.0
    return np.sqrt(out, out=out) if metric == "euclidean" else out


def _reach(bound: np.ndarray) -> np.ndarray:
    """Distances that may still count: rounding to 9 places can tie, and sums are inexact."""
    return bound + 2e-9 + 1e-12 * np.abs(np.where(np.isfinite(bound), bound, 0.0))


def _widths(part: np.ndarray, codes: int, leaf: int) -> np.ndarray:
    """The range of each dimension; levels are at most 2 apart. A nominal column with
    more levels than blocks to come is split last: no block gets few levels."""
    width = part.max(0) - part.min(0)
    for j in range(len(width) - codes, len(width)):
        width[j] = min(width[j], 2.0)
        if width[j] > 0 and len(np.unique(part[:, j])) > max(2, len(part) // leaf):
            width[j] *= 1e-9
    return width


def _widest(part: np.ndarray, codes: int, leaf: int) -> int:
    """The dimension with the widest range."""
    return int(np.argmax(_widths(part, codes, leaf)))


def _two_valued(part: np.ndarray) -> np.ndarray:
    """Dimensions of which nine rows in ten hold the least or the greatest value, as one-hot columns do."""
    low, high = part.min(0), part.max(0)
    return np.flatnonzero((low < high) & (((part == low) | (part == high)).mean(0) >= 0.9))


def _apart(some: np.ndarray, least: int) -> np.ndarray | None:
    """Which rows are in the upper half of the two-valued dimension that splits the rows most
    evenly; None if it leaves fewer than ``least`` rows on one side."""
    if not some.shape[1] or len(some) < 2 * least:
        return None
    upper = some > (some.min(0) + some.max(0)) / 2
    n = upper.sum(0)
    smaller = np.minimum(n, len(some) - n)
    best = int(smaller.argmax())
    return upper[:, best] if smaller[best] >= least else None


def _between(code: np.ndarray) -> np.ndarray:
    """Which rows have the upper levels, cut next to the median level (on the more even side)."""
    middle = np.partition(code, len(code) // 2)[len(code) // 2]
    upper, above = code >= middle, code > middle
    return min((upper, above), key=lambda u: abs(2 * int(u.sum()) - len(u)))


def near_blocks(rows: np.ndarray, leaf: int = LEAF_ROWS, codes: int = 0) -> list[np.ndarray]:
    """Row numbers in blocks of at most ``leaf`` rows, halved at the median of the dimension
    in which a block is widest. Two-valued dimensions (one-hot columns) are split between
    their values, as a median among equal values leaves both in a block; they go first
    where that narrows a block more than half of the widest dimension. Level codes are
    split between levels, at the boundary nearest to the median."""
    todo, out = [(np.arange(len(rows)), True)], []
    pairs = _two_valued(rows[:, :rows.shape[1] - codes]) if len(rows) else np.zeros(0, np.int64)
    while todo:
        at, values = todo.pop()
        if len(at) <= leaf:
            out.append(at)
            continue
        part = rows[at]
        widest = _widest(part, codes, leaf)
        if values and np.ptp(part[:, pairs], axis=0).max(initial=0.0) >= np.ptp(part[:, widest]) / 2:
            upper = _apart(part[:, pairs], max(1, leaf // 4))
            if upper is not None:
                todo += [(at[~upper], True), (at[upper], True)]
                continue
            values = False                              # nor in any part of these rows
        if widest >= rows.shape[1] - codes and part[:, widest].min() < part[:, widest].max():
            upper = _between(part[:, widest])
            todo += [(at[~upper], values), (at[upper], values)]
            continue
        order = np.argpartition(part[:, widest], len(at) // 2)
        todo += [(at[order[:len(at) // 2]], values), (at[order[len(at) // 2:]], values)]
    return out


class _Best:
    """The k best rows of each query so far, and the bounds of the k-th distances
    (updated in place). Found pairs are cut to k a query whenever they are many."""

    def __init__(self, keys: np.ndarray, bound: np.ndarray, k: int):
        self.keys, self.bound, self.k, self.most = keys, bound, k, max(1 << 18, len(bound) * k)
        self.parts, self.size, self.kept = [], 0, 0

    def add(self, q: np.ndarray, t: np.ndarray, d: np.ndarray) -> None:
        self.parts.append((q, t, d))
        self.size += len(q)
        if self.size > self.kept + self.most:
            self.cut()

    def cut(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        none = np.zeros(0, np.int64)
        q, t, d = (np.concatenate(x) for x in zip((none, none, np.zeros(0)), *self.parts))
        keep = d <= _reach(self.bound)[q]
        q, t, d = q[keep], t[keep], d[keep]
        order = np.lexsort((self.keys[t], np.round(d, 9), q))
        q, t, d = q[order], t[order], d[order]
        place = np.arange(len(q)) - np.searchsorted(q, q)
        last = place == self.k - 1
        self.bound[q[last]] = np.minimum(self.bound[q[last]], d[last])
        best = place < self.k
        self.parts = [(q[best], t[best], d[best])]
        self.size = self.kept = int(best.sum())
        return self.parts[0]


class Searched:
    """Training rows cut into blocks, to be searched by batches of queries.

    Where the boxes of the blocks rule out little (many dimensions), whole tiles of
    rows are screened by a cheap lower bound of the distance (sums of 16-bit steps, or
    one matrix product) and only pairs that pass are computed.

    compared: pairs whose distance, or its bound in a tile, was computed."""

    def __init__(self, rows: np.ndarray, keys: np.ndarray, labels: np.ndarray, folds: np.ndarray, metric: str, leaf: int = LEAF_ROWS,
                 codes: int = 0):
        blocks = near_blocks(rows, leaf, codes) if len(rows) else []
        order = np.concatenate(blocks) if blocks else np.zeros(0, np.int64)
        self.rows, self.keys, self.labels, self.folds = rows[order], keys[order], labels[order], folds[order]
        self.ends = np.cumsum([len(b) for b in blocks], dtype=np.int64)
        starts = self.ends - np.array([len(b) for b in blocks], np.int64)
        self.spans = list(zip(starts.tolist(), self.ends.tolist()))
        # rows with NaN are in no box; they have no finite distance either
        self.low = np.nan_to_num(np.array([np.fmin.reduce(self.rows[s:e]) for s, e in self.spans]).reshape(len(blocks), -1), nan=np.inf, posinf=np.inf, neginf=-np.inf)
        self.high = np.nan_to_num(np.array([np.fmax.reduce(self.rows[s:e]) for s, e in self.spans]).reshape(len(blocks), -1), nan=-np.inf, posinf=np.inf, neginf=-np.inf)
        self.metric, self.codes, self.compared = metric, codes, 0
        self._levels, self._tiles = None, None

    def _held(self) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each nominal column the (level, block) pairs that occur, by level; unseen levels are -1."""
        if self._levels is None:
            block = np.repeat(np.arange(len(self.spans)), np.diff(self.ends, prepend=0))
            self._levels = []
            for j in range(self.rows.shape[1] - self.codes, self.rows.shape[1]):
                level = np.maximum(self.rows[:, j], -1.0)
                order = np.lexsort((block, level))
                new = np.ones(len(order), bool)
                new[1:] = (np.diff(level[order]) != 0) | (np.diff(block[order]) != 0)
                self._levels.append((level[order][new], block[order][new]))
        return self._levels

    def apart(self, queries: np.ndarray) -> np.ndarray:
        """Least distance (nq, blocks) from each query to any row of each block. Levels
        are looked up, so a block is a mismatch away unless one of its rows has the level."""
        if not self.codes:
            return box_distances(queries, self.low, self.high, self.metric)
        n = self.rows.shape[1] - self.codes
        out = box_distances(queries[:, :n], self.low[:, :n], self.high[:, :n], self.metric)
        if self.metric == "euclidean":
            np.multiply(out, out, out=out)
        for j, (level, block) in enumerate(self._held(), n):
            q = np.maximum(queries[:, j], -1.0)
            far = 1.0 + ((q[:, None] >= 0) & (self.low[None, :, j] >= 0))
            first, last = np.searchsorted(level, q), np.searchsorted(level, q, "right")
            size = last - first
            entry = np.repeat(first - np.cumsum(size) + size, size) + np.arange(size.sum())
            far[np.repeat(np.arange(len(q)), size), block[entry]] = 0.0
            out += far
        return np.sqrt(out, out=out) if self.metric == "euclidean" else out

    def nearest(self, queries: np.ndarray, keys: np.ndarray, folds: np.ndarray, k: int, exclude: str = "",
                bound: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query number, row number, distance) of the k nearest rows of each
        query, in the order of queries, then of distance (9 places) and key.

        exclude: "fold" rules out rows of the query's fold (folds from 0 on),
        "other" rows of other folds and the row itself. bound: upper bounds of
        the k-th distances, if known."""
        n = len(queries)
        none = np.zeros(0, np.int64)
        if not n or not self.spans:
            return none, none, np.zeros(0)
        found = []
        for s in range(0, n, QUERY_ROWS):
            e = min(n, s + QUERY_ROWS)
            limit = np.full(e - s, np.inf) if bound is None else bound[s:e].astype(float)
            best = _Best(self.keys, limit, k)
            some = (queries[s:e], keys[s:e], folds[s:e], k, exclude, best)
            (self._by_tiles if self._screens(*some) else self._by_blocks)(*some)
            q, t, d = best.cut()
            found.append((q + s, t, d))
        return tuple(np.concatenate(x) for x in zip(*found))

    def _allowed(self, q: np.ndarray, t: np.ndarray, keys: np.ndarray, folds: np.ndarray, exclude: str) -> np.ndarray:
        """Which pairs (broadcast against each other) may be neighbours."""
        same = folds[q] == self.folds[t]
        return same & (keys[q] != self.keys[t]) if exclude == "other" else ~(same & (folds[q] >= 0))

    def _by_blocks(self, queries, keys, folds, k, exclude, best) -> None:
        bound = best.bound
        apart = self.apart(queries)
        first = apart.argmin(1)

        def compare(block: int, who: np.ndarray) -> None:
            s, e = self.spans[block]
            step = max(1, CHUNK_CELLS // (e - s))
            for c in range(0, len(who), step):
                q = who[c:c + step]
                d = distances(queries[q], self.rows[s:e], self.metric, self.codes)
                self.compared += d.size
                if exclude:
                    d[~self._allowed(q[:, None], np.arange(s, e)[None, :], keys, folds, exclude)] = np.inf
                near = (d <= _reach(bound[q])[:, None]) & np.isfinite(d)
                full = np.flatnonzero(near.sum(1) >= k)         # k rows here bound the k-th distance
                if len(full):
                    bound[q[full]] = np.minimum(bound[q[full]], np.partition(d[full], k - 1, axis=1)[:, k - 1])
                    near[full] &= d[full] <= _reach(bound[q[full]])[:, None]
                i, t = np.nonzero(near)
                best.add(q[i], s + t, d[i, t])

        by_block = np.argsort(first, kind="stable")     # each query's nearest block first: it bounds the rest
        edges = np.searchsorted(first[by_block], np.arange(len(self.spans) + 1))
        for block in range(len(self.spans)):
            if edges[block] < edges[block + 1]:
                compare(block, by_block[edges[block]:edges[block + 1]])
        best.cut()
        for block in range(len(self.spans)):
            who = np.flatnonzero((apart[:, block] <= _reach(bound)) & (first != block))
            if len(who):
                compare(block, who)

    def _screens(self, queries, keys, folds, k, exclude, best) -> bool:
        """Whether a few queries' nearest blocks leave them more than a tenth of all blocks."""
        if self.codes or len(self.rows) < SCREEN_ROWS or not 0 < self.rows.shape[1] <= 4096:
            return False
        if max(np.abs(x).max(initial=0, where=np.isfinite(x)) for x in (queries, self.low, self.high)) > 1e100:
            return False                                    # sums and squares might overflow
        probe = np.unique(np.linspace(0, len(queries) - 1, 32).astype(np.int64))
        apart = self.apart(queries[probe])
        share = []
        for i, block in enumerate(apart.argmin(1)):
            s, e = self.spans[block]
            d = distances(queries[probe[i:i + 1]], self.rows[s:e], self.metric)[0]
            if exclude:
                d = d[self._allowed(probe[i], np.arange(s, e), keys, folds, exclude)]
            d = np.sort(d[np.isfinite(d)])
            limit = min(best.bound[probe[i]], d[k - 1] if len(d) >= k else np.inf)
            share.append((apart[i] <= _reach(np.array(limit))).mean())
        return float(np.median(share)) > 0.1

    def _tiled(self, exclude: str) -> list[tuple]:
        """Tiles of rows of one fold with finite values: (fold, row numbers, screen)."""
        if self._tiles is None:
            at = np.flatnonzero(np.isfinite(self.rows).all(1))
            if exclude:
                at = at[np.argsort(self.folds[at], kind="stable")]
            rows = self.rows[at]
            self.base, width = (rows.min(0), np.ptp(rows, axis=0)) if len(rows) else (np.zeros(rows.shape[1]),) * 2
            self.top = self.base + width
            # steps of all dimensions together stay below 2 ** 15
            self.unit = float(width.sum()) / (32_767 - 2 * rows.shape[1] - 2) or 1.0
            edges = [0, *(np.flatnonzero(np.diff(self.folds[at])) + 1 if exclude else []), len(at)]
            self._tiles = []
            for s, e in zip(edges, edges[1:]):
                for x in range(s, e, TILE_ROWS):
                    part = at[x:min(e, x + TILE_ROWS)]
                    self._tiles.append((int(self.folds[part[0]]), part, self._screen(self.rows[part])))
        return self._tiles

    def _screen(self, rows: np.ndarray):
        """Manhattan: 16-bit steps (dimensions, rows) and the sums of what rounding moved;
        euclidean: rows doubled and their squared lengths, for one product with the queries."""
        if self.metric == "euclidean":
            square = (rows * rows).sum(1)
            return np.concatenate([-2.0 * rows, square[:, None]], axis=1).T.copy(), float(square.max())
        steps = np.rint((rows - self.base) / self.unit)
        moved = np.abs(rows - (self.base + steps * self.unit)).sum(1)
        return np.ascontiguousarray(steps.astype(np.int16).T), moved

    def _by_tiles(self, queries, keys, folds, k, exclude, best) -> None:
        tiles = self._tiled(exclude)
        finite = np.isfinite(queries).all(1)
        groups = [(f, np.flatnonzero(finite & (folds == f))) for f in np.unique(folds)] if exclude else [(-1, np.flatnonzero(finite))]
        if self.metric == "euclidean":
            left = np.concatenate([queries, np.ones((len(queries), 1))], axis=1)
            length = (queries * queries).sum(1)
        else:
            inside = np.where(finite[:, None], np.clip(queries, self.base, self.top), self.base)
            steps, moved = self._screen(inside)
            steps = np.ascontiguousarray(steps.T)
            outside = np.abs(queries - inside).sum(1)           # on the way to the rows' box, whatever the row
        size = 128 if self.metric == "euclidean" else 16
        for fold, rows, (screen, slack) in tiles:
            total = np.empty((size, len(rows)), np.int16)
            step = np.empty_like(total)
            for f, who in groups:
                if (exclude == "fold" and f >= 0 and f == fold) or (exclude == "other" and f != fold):
                    continue
                for s in range(0, len(who), size):
                    q = who[s:s + size]
                    self.compared += len(q) * len(rows)
                    if self.metric == "euclidean":
                        seen = left[q] @ screen                 # squared distance without the query's own length
                        unsure = 1e-14 * queries.shape[1] * (length[q] + slack) + 1e-300
                        limit = lambda b: b * b - length[q] + unsure  # noqa: E731,B023
                        upper = lambda x: np.sqrt(np.maximum(x + length[q] + unsure, 0.0))  # noqa: E731,B023
                    else:
                        seen, move = total[:len(q)], step[:len(q)]
                        seen.fill(0)
                        for j in range(len(screen)):
                            np.subtract(steps[q, j, None], screen[j][None, :], out=move)
                            np.abs(move, out=move)
                            np.add(seen, move, out=seen)
                        unsure = (moved[q] + slack.max()) * (1 + 1e-9) + 1e-9 * self.unit
                        limit = lambda b: np.clip(np.floor((b - outside[q] + unsure) / self.unit) + 1, -1, 32_767).astype(np.int16)  # noqa: E731,B023
                        upper = lambda x: (x * self.unit + outside[q] + unsure) * (1 + 1e-9)  # noqa: E731,B023
                    near = np.flatnonzero(seen <= limit(_reach(best.bound[q]))[:, None])
                    if len(near) > 4 * k * len(q) and len(rows) >= k and exclude != "other":
                        # every pair of this tile counts: the k-th screened one bounds the k-th distance
                        kth = np.partition(seen, k - 1, axis=1)[:, k - 1].astype(float)
                        best.bound[q] = np.minimum(best.bound[q], upper(kth))
                        near = np.flatnonzero(seen <= limit(_reach(best.bound[q]))[:, None])
                    if not len(near):
                        continue
                    i, t = q[near // len(rows)], rows[near % len(rows)]
                    d = pair_distances(queries[i], self.rows[t], self.metric)
                    ok = d <= _reach(best.bound[i])
                    if exclude == "other":
                        ok &= keys[i] != self.keys[t]
                    best.add(i[ok], t[ok], d[ok])


def _columns(queries: np.ndarray, searched: Searched, found: tuple) -> dict[str, np.ndarray]:
    q, t, d = found
    return {"query": queries[q], "neighbor": searched.keys[t], "label": searched.labels[t].astype(np.int32), "d": d, "d_r": np.round(d, 9)}


def _meet(k: int, metric: str, exclude: str, compared=None, codes: int = 0):
    def run(q: pa.Table, t: pa.Table) -> pa.Table:
        none = np.zeros(0, np.int64)
        columns = {"query": none, "neighbor": none, "label": none.astype(np.int32), "d": np.zeros(0), "d_r": np.zeros(0)}
        if q.num_rows and t.num_rows:
            rows, *ints = _arrow_rows(t, ("tf", "t", "y", "tfold"))
            searched = Searched(rows, *ints, metric, codes=codes)
            del rows
            queries, keys, folds = _arrow_rows(q, ("qf", "q", "qfold"))
            found = searched.nearest(queries, keys, folds, k, exclude, np.asarray(q.column("bound"), dtype=float))
            if compared is not None:
                compared.add(searched.compared)
            columns = _columns(keys, searched, found)
            del searched, queries, found
            give_back()                                 # the worker is kept for other tasks
        return pa.table({c: pa.array(v) for c, v in columns.items()})
    return run


def _vectors(column: pa.Array | pa.ChunkedArray, n: int) -> np.ndarray:
    chunks = column.chunks if isinstance(column, pa.ChunkedArray) else [column]
    flat = np.concatenate([np.asarray(c.flatten(), dtype=np.float64) for c in chunks] or [np.zeros(0)])
    return flat.reshape(n, -1)


def _arrow_rows(b: pa.RecordBatch | pa.Table, names: tuple[str, ...]) -> tuple:
    """(vectors, then integer columns) of a batch or table."""
    return (_vectors(b.column(b.schema.get_field_index(names[0])), b.num_rows),
            *[np.asarray(b.column(b.schema.get_field_index(c)), dtype=np.int64) for c in names[1:]])


def _collected(rows: DataFrame, names: tuple[str, ...]) -> tuple | None:
    """The same of a small table, in the driver; None if it is empty."""
    t = rows.select(*names).toArrow().combine_chunks()
    return _arrow_rows(t.to_batches()[0], names) if t.num_rows else None


def _search_in_place(q: DataFrame, t: DataFrame, k: int, metric: str, exclude: str, compared=None, codes: int = 0) -> DataFrame:
    """Winners of each training task for all queries, which are broadcast."""
    collected = _collected(q, ("qf", "q", "qfold"))
    spark = q.sparkSession
    if collected is None:
        return spark.createDataFrame([], NEIGHBOUR_SCHEMA)
    shared = spark.sparkContext.broadcast(collected)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, keys, folds = shared.value
        best: dict[str, np.ndarray] | None = None
        bound = np.full(len(keys), np.inf)

        def merged(parts: list[pa.RecordBatch]) -> None:
            nonlocal best, bound
            cols = [np.concatenate(c) for c in zip(*[_arrow_rows(b, ("tf", "t", "y", "tfold")) for b in parts])]
            searched = Searched(*cols, metric, codes=codes)
            found = searched.nearest(queries, keys, folds, k, exclude, bound)
            if compared is not None:
                compared.add(searched.compared)
            new = {"at": found[0]} | _columns(keys, searched, found)
            both = new if best is None else {c: np.concatenate([best[c], new[c]]) for c in new}
            order = np.lexsort((both["neighbor"], both["d_r"], both["at"]))
            both = {c: v[order] for c, v in both.items()}
            place = np.arange(len(order)) - np.searchsorted(both["at"], both["at"])
            best = {c: v[place < k] for c, v in both.items()}
            last = place == k - 1
            bound[both["at"][last]] = both["d"][last]

        held: list[pa.RecordBatch] = []
        for b in batches:
            if b.num_rows:
                held.append(b)
            # long vectors in smaller lots; every lot costs one look at all queries
            if sum(x.num_rows for x in held) >= 50_000 and sum(x.nbytes for x in held) >= 8 << 20:
                merged(held)
                held = []
        if held:
            merged(held)
        if best is not None:
            del best["at"]
            for s in range(0, len(best["query"]), 100_000):
                yield pa.RecordBatch.from_pydict({c: pa.array(v[s:s + 100_000]) for c, v in best.items()})

    return t.mapInArrow(search, NEIGHBOUR_SCHEMA)


def _search_whole(q: DataFrame, t: DataFrame, k: int, metric: str, exclude: str, parts: int, compared=None, codes: int = 0) -> DataFrame:
    """Winners of every query, dealt to ``parts`` tasks, among all training rows, which are broadcast."""
    collected = _collected(t, ("tf", "t", "y", "tfold"))
    spark = q.sparkSession
    if collected is None:
        return spark.createDataFrame([], NEIGHBOUR_SCHEMA)
    shared = spark.sparkContext.broadcast(collected)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searched = None
        for b in batches:
            if not b.num_rows:
                continue
            searched = searched or Searched(*shared.value, metric, codes=codes)
            queries, keys, folds = _arrow_rows(b, ("qf", "q", "qfold"))
            columns = _columns(keys, searched, searched.nearest(queries, keys, folds, k, exclude))
            yield pa.RecordBatch.from_pydict({c: pa.array(v) for c, v in columns.items()})
        if searched is not None:
            if compared is not None:
                compared.add(searched.compared)
            del searched
            give_back()                                     # the worker is kept for other tasks

    return q.repartition(parts, "q").mapInArrow(search, NEIGHBOUR_SCHEMA)


def _even_cut(part: np.ndarray, width: np.ndarray) -> tuple[int, float]:
    """The widest dimension whose median leaves a quarter of the rows or more on either
    side (many equal values, as in one-hot columns, do not), and its median."""
    order = np.argsort(-width, kind="stable")
    for j in order:
        cut = np.median(part[:, j])
        if 0.25 <= (part[:, j] > cut).mean() <= 0.75:
            return int(j), cut
    return int(order[0]), np.median(part[:, order[0]])


class Cells:
    """Regions of space: median splits of a sample, ``n`` leaves (a power of two)."""

    def __init__(self, sample: np.ndarray, n: int, codes: int = 0):
        dims = sample.shape[1]
        self.dim, self.cut = np.zeros(n, np.int64), np.zeros(n)          # inner nodes 1 .. n-1, children 2i, 2i+1
        self.low, self.high = np.full((2 * n, dims), -np.inf), np.full((2 * n, dims), np.inf)
        parts = {1: sample}
        for i in range(1, n):
            part = parts.pop(i)
            if len(part):
                self.dim[i], self.cut[i] = _even_cut(part, _widths(part, codes, max(1, len(sample) // n)))
            j = self.dim[i]
            left = part[:, j] <= self.cut[i]
            for child, rows in ((2 * i, part[left]), (2 * i + 1, part[~left])):
                parts[child] = rows
                self.low[child], self.high[child] = self.low[i], self.high[i]
            self.high[2 * i, j] = min(self.high[2 * i, j], self.cut[i])
            self.low[2 * i + 1, j] = max(self.low[2 * i + 1, j], self.cut[i])
        self.n, self.low, self.high = n, self.low[n:], self.high[n:]

    def of(self, rows: np.ndarray) -> np.ndarray:
        at = np.ones(len(rows), np.int64)
        for _ in range(self.n.bit_length() - 1):
            at = 2 * at + (rows[np.arange(len(rows)), self.dim[at]] > self.cut[at])
        return at - self.n


def _cells(t: DataFrame, k: int, metric: str, n_cells: int, n_rows: int, codes: int) -> Cells | None:
    """Cells for the training rows; None where the neighbours of a row lie in most
    of them, as they do in many dimensions. The sample steers the layout only."""
    share = F.lit(SAMPLE_ROWS / max(n_rows, 1))
    chosen = t.filter(F.pmod(F.xxhash64("t"), F.lit(1 << 30)) < share * (1 << 30)).limit(4 * SAMPLE_ROWS)
    sample, *ints = _collected(chosen, ("tf", "t", "y", "tfold")) or _collected(t.limit(1), ("tf", "t", "y", "tfold"))
    cells = Cells(sample, n_cells, codes)
    probe = sample[np.unique(np.linspace(0, len(sample) - 1, 64).astype(np.int64))]
    none = np.full(len(probe), -1)
    at, _, d = Searched(sample, *ints, metric, codes=codes).nearest(probe, none, none, k)
    bound = np.where(np.bincount(at, minlength=len(probe)) >= k, 0.0, np.inf)
    np.maximum.at(bound, at, d)
    reached = box_distances(probe, cells.low, cells.high, metric, codes) <= _reach(bound)[:, None]
    return cells if reached.mean() <= 0.5 else None


def _placed(rows: DataFrame, vector: str, cells: Cells) -> DataFrame:
    """rows with ``_cell``, the cell that their vector lies in."""
    def place(batches):
        for b in batches:
            at = cells.of(_vectors(b.column(b.schema.get_field_index(vector)), b.num_rows)) if b.num_rows else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(at)], [*b.schema.names, "_cell"])

    return rows.mapInArrow(place, T.StructType([*rows.schema.fields, T.StructField("_cell", T.LongType())]))


def _reached(q: DataFrame, cells: Cells, metric: str, codes: int) -> DataFrame:
    """q once for each cell but its own (``_cell``) that may hold a row within its bound."""
    def route(batches):
        for b in batches:
            if not b.num_rows:
                continue
            queries = _vectors(b.column(b.schema.get_field_index("qf")), b.num_rows)
            bound = np.asarray(b.column(b.schema.get_field_index("bound")), dtype=float)
            near = box_distances(queries, cells.low, cells.high, metric, codes) <= _reach(bound)[:, None]
            near[np.arange(len(queries)), cells.of(queries)] = False
            who, cell = np.nonzero(near)
            yield pa.RecordBatch.from_arrays([*b.take(pa.array(who)).columns, pa.array(cell.astype(np.int64))], [*b.schema.names, "_cell"])

    return q.mapInArrow(route, T.StructType([*q.schema.fields, T.StructField("_cell", T.LongType())]))


def _blocks(rows: DataFrame, by: list[str], size: int, name: str) -> DataFrame:
    """(by, name): how many blocks of ``size`` rows each group needs."""
    return rows.groupBy(*by).agg(F.ceil(F.count(F.lit(1)) / size).cast("long").alias(name))


def knn(queries: DataFrame, train: DataFrame, key: str, features: str, label: str, k: int,
        metric: str = "manhattan", fold: str | None = None, same: str | None = None,
        query_block: int = 32_768, train_block: int = 100_000, broadcast_bytes: int = BROADCAST_BYTES, compared=None,
        codes: int = 0) -> DataFrame:
    """The k nearest training rows of every query row.

    Output ``query, neighbor, label, d, d_r, rn``: ``d`` the exact distance,
    ``d_r`` rounded to 9 decimals, ``rn`` 1..k in (d_r, neighbor) order. Keys are
    integers. With ``fold``, a query only meets training rows of other folds;
    with ``same`` (an integer-coded column), only other rows with the same value
    (same-class neighbours for SMOTE). The last ``codes`` entries of a vector are level
    codes of nominal columns (negative: unseen), compared as their one-hot vectors.
    ``compared``: an accumulator that is given
    the number of pairs whose distance was computed."""
    part = same or fold
    exclude = "other" if same else ("fold" if fold else "")
    vector = lambda: F.transform(features, lambda x: x.cast("double"))
    q = queries.select(F.col(key).cast("long").alias("q"), vector().alias("qf"),
                       (F.col(part) if part else F.lit(-1)).cast("long").alias("qfold"))
    t = train.select(F.col(key).cast("long").alias("t"), vector().alias("tf"), F.col(label).cast("int").alias("y"),
                     (F.col(part) if part else F.lit(-2)).cast("long").alias("tfold"))
    size = q.agg(F.count(F.lit(1)), F.sum(8 * F.size("qf"))).first()
    nq = size[0]
    nt, t_bytes = t.agg(F.count(F.lit(1)), F.coalesce(F.sum(8 * F.size("tf")), F.lit(0))).first()
    cores = queries.sparkSession.sparkContext.defaultParallelism
    # long vectors in smaller blocks: a task's memory is that of one block, however many rows there are
    fits = max(QUERY_ROWS, BLOCK_BYTES * nq // max(size[1] or 0, 1))
    query_block, train_block = min(query_block, fits), min(train_block, fits)
    tb = max(1, math.ceil(nt / train_block))
    q = q.withColumn("bound", F.lit(float("inf")))
    first = Window.partitionBy("query").orderBy("d_r", "neighbor")

    def winners(local: DataFrame) -> DataFrame:
        return local.withColumn("rn", F.row_number().over(first)).filter(F.col("rn") <= k)

    def meet(q: DataFrame, t: DataFrame, by: list[str], n_q: int | None = None) -> DataFrame:
        """Winners of every (group, query block, training block). Groups ``by`` columns are
        counted; without any there are ``n_q`` x ``tb`` blocks."""
        if by:
            # enough query blocks to keep every core busy, more where a group has many queries;
            # training blocks where a cell or value has many rows
            spare = min(max(1, math.ceil(2 * cores / tb)), max(1, nq))
            q_blocks = _blocks(q, by, query_block, "_qn").withColumn("_qn", F.greatest("_qn", F.lit(spare)))
            groups = bounded_broadcast(q_blocks.join(_blocks(t, by, train_block, "_tn"), by))
            q, t = q.join(groups, by), t.join(groups, by)
        else:
            q, t = [x.withColumn("_qn", F.lit(n_q)).withColumn("_tn", F.lit(tb)) for x in (q, t)]
        numbers = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n).cast("long") - 1))
        q = q.withColumn("_qb", F.pmod(F.xxhash64("q"), F.col("_qn"))).withColumn("_tb", numbers("_tn")).drop("_qn", "_tn")
        t = t.withColumn("_tb", F.pmod(F.xxhash64("t"), F.col("_tn"))).withColumn("_qb", numbers("_qn")).drop("_qn", "_tn")
        blocks = [*by, "_qb", "_tb"]
        if not by:
            # few, long tasks: several partitions a block, so that few of them hold two
            parts = max(int(queries.sparkSession.conf.get("spark.sql.shuffle.partitions")), 4 * n_q * tb)
            q, t = q.repartition(parts, *blocks), t.repartition(parts, *blocks)
        return q.groupBy(*blocks).cogroup(t.groupBy(*blocks)).applyInArrow(_meet(k, metric, exclude, compared, codes), NEIGHBOUR_SCHEMA)

    few = same is None and (size[1] or 0) <= broadcast_bytes and nq * k <= BROADCAST_WINNERS
    if same is None and t_bytes <= broadcast_bytes and nt <= 8 * nq:
        # one index of all training rows compares a query with fewer of them than many small ones do
        return winners(_search_whole(q, t, k, metric, exclude, max(min(cores, math.ceil(nq / 256)), math.ceil(nq / query_block)), compared, codes))
    if few and nt > max(4 * nq, train_block):
        return winners(_search_in_place(q, t, k, metric, exclude, compared, codes))
    if few and nt >= max(3 * nq, DEALT_ROWS):
        # few training rows may lie in few partitions: dealt once, where query blocks would each take a copy
        return winners(_search_in_place(q, t.repartition(2 * cores), k, metric, exclude, compared, codes))
    if same:                                            # rows of different values never meet
        return winners(meet(q.withColumn("_s", F.col("qfold")), t.withColumn("_s", F.col("tfold")), ["_s"]))
    cells = _cells(t, k, metric, 1 << (tb - 1).bit_length(), nt, codes) if tb > 1 and nq else None
    if cells is None:
        return winners(meet(q, t, [], max(min(math.ceil(2 * cores / tb), max(1, nq)), math.ceil(nq / query_block))))
    t = _placed(t, "tf", cells)
    own = materialize(winners(meet(_placed(q, "qf", cells), t, ["_cell"])).drop("rn"))
    limits = own.groupBy(F.col("query").alias("q")).agg(F.when(F.count(F.lit(1)) >= k, F.max("d")).alias("_limit"))
    q = q.join(limits, "q", "left").withColumn("bound", F.coalesce("_limit", "bound")).drop("_limit")
    return winners(own.unionByName(meet(_reached(q, cells, metric, codes), t, ["_cell"])))


def vote(neigh: DataFrame, ks: list[int], weights: str, classes: list[int]) -> DataFrame:
    """L1-L3: class distribution and prediction for each k in ``ks`` from one
    neighbour table computed at max(ks).

    weights='uniform': every neighbour 1. weights='distance': 1/d, except that
    when a query has neighbours at distance 0 only those vote (weight 1).
    Output ``query, k, p (array over classes), pred`` (ties to the lowest class).
    """
    ks, classes = sorted({int(x) for x in ks}), [int(c) for c in classes]
    query = neigh.schema["query"]
    lists = (neigh.filter(F.col("rn") <= ks[-1]).groupBy("query")
             .agg(F.array_sort(F.collect_list(F.struct("rn", F.col("label").cast("int").alias("label"),
                                                       F.col("d").cast("double").alias("d")))).alias("near")))
    schema = T.StructType([query, T.StructField("k", T.IntegerType()), T.StructField("p", T.ArrayType(T.DoubleType()))])
    shares = lists.mapInArrow(_shares(ks, weights, classes), schema)
    cls = F.array(*[F.lit(c) for c in classes])
    return shares.withColumn("pred", F.element_at(cls, argmax_index(F.col("p")) + 1))


def _shares(ks: list[int], weights: str, classes: list[int]):
    """For batches of (query, neighbours by rn): the class shares at every k."""
    order = np.argsort(classes, kind="stable")
    ranked = np.array(classes)[order]

    def shares(queries: pa.Array, near: pa.Array) -> list[pa.RecordBatch]:
        n, items = len(near), near.flatten()
        who = np.repeat(np.arange(n), near.value_lengths().to_numpy(zero_copy_only=False))
        rn, label = (items.field(c).to_numpy(zero_copy_only=False) for c in ("rn", "label"))
        at = np.minimum(np.searchsorted(ranked, label), len(ranked) - 1)
        place = np.where(ranked[at] == label, order[at], len(classes))      # the last place: other labels
        d = items.field("d").to_numpy(zero_copy_only=False) if weights == "distance" else np.ones(len(who))
        with np.errstate(divide="ignore"):
            w = np.where(np.isnan(d) | (d == 0), 0.0, 1.0 / d)
        sums, exact = (np.zeros((n, len(classes) + 1)) for _ in range(2))   # weights; neighbours at distance 0
        seen, out, before = np.zeros(n, bool), [], -np.inf
        for k in ks:
            new = (rn > before) & (rn <= k)
            np.add.at(sums, (who[new], place[new]), w[new])                 # in rn order: equal neighbours, equal sums
            np.add.at(exact, (who[new], place[new]), d[new] == 0)
            seen[who[new]] = True
            mass = np.where(exact.any(1)[:, None], exact, sums)[seen]
            with np.errstate(invalid="ignore", divide="ignore"):
                p = mass[:, :-1] / mass.sum(1)[:, None]
            out.append(pa.record_batch({
                "query": queries.filter(pa.array(seen)), "k": pa.array(np.full(len(p), k, np.int32)),
                "p": pa.ListArray.from_arrays(pa.array(np.arange(len(p) + 1, dtype=np.int32) * len(classes)), pa.array(p.ravel()))}))
            before = k
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = max(1, VOTE_CELLS // (len(classes) + 1))
        for b in batches:
            for s in range(0, b.num_rows, step):
                part = b.slice(s, step)
                yield from shares(part.column(0), part.column(1))

    return run
