"""Every depth and pruning strength of a classification tree from one fit
(L5, E11, E12, D5, A22, R8, G5).

A node's split depends on the node's rows only, so a tree of depth d is the
deep tree with its nodes at depth d turned into leaves. Likewise the trees of
all cost-complexity penalties are nested: weakest-link pruning gives each inner
node the penalty from which on it is a leaf. One deep tree per (impurity, leaf
size, weighting, fold) therefore scores every depth and every penalty.

The tree is the one of MLlib's DecisionTreeClassifier (binned thresholds, first
of the best splits, leaves of equal prediction merged), but its nodes never come
to the driver. Rows become cells, one row per distinct vector of bins with its
counts by class. Nodes of more than ``LOCAL_CELLS`` cells are split level by level
from histograms summed in Spark (one row per such node is fetched); every smaller
node is a group, whose subtree one task grows, cuts, prunes and scores.
What returns of a group is its confusion table, risk and leaves for each setting.

Thresholds are taken of all training rows; MLlib takes 10,000 of them where there
are more."""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..plans.sizing import compact, materialize
from .trees import UNBOUNDED_DEPTH

LOCAL_CELLS = 1 << 16        # a node of as many cells is grown within one task
NODES_AT_ONCE = 512          # whose dense histograms a task holds
ADDED_UP = 1 << 16           # MLlib adds a class's weight up row by row; beyond, count x weight
_EPS = float(np.finfo(float).eps)


@dataclass(frozen=True)
class Nodes:
    """A grown tree as arrays by node number (parents come before children).

    left, right: children, -1 for a leaf; prediction: most frequent class of the
    node's weighted rows; risk: its share of the total weight times its
    impurity; depth: 0 for the root."""

    left: np.ndarray
    right: np.ndarray
    prediction: np.ndarray
    risk: np.ndarray
    depth: np.ndarray

    @property
    def leaves(self) -> np.ndarray:
        """Node number of each leaf, in the order of MLlib's leaf index."""
        return np.flatnonzero(self.left < 0)


def pruning_strength(nodes: Nodes, max_depth: int) -> np.ndarray:
    """The penalty from which on each inner node of the tree cut at
    ``max_depth`` is a leaf of the cost-complexity pruned tree (infinite for
    nodes that are leaves already or vanish inside a pruned one).

    Weakest link: the node whose pruning raises the risk least for each leaf
    saved goes first; a heap holds the rates, and pruning a node changes those
    of its ancestors only."""
    n = len(nodes.left)
    inner = (nodes.left >= 0) & (nodes.depth < max_depth)
    parent = np.full(n, -1)
    at = np.flatnonzero(inner)
    parent[nodes.left[at]], parent[nodes.right[at]] = at, at
    below, count = nodes.risk.copy(), np.ones(n, np.int64)       # risk and number of the leaves under a node
    for i in at[::-1]:
        a, b = nodes.left[i], nodes.right[i]
        below[i], count[i] = below[a] + below[b], count[a] + count[b]
    strength = np.full(n, np.inf)
    gone = np.zeros(n, bool)
    rate = lambda i: (nodes.risk[i] - below[i]) / (count[i] - 1)
    heap = [(rate(i), int(i), int(count[i])) for i in at]
    heapq.heapify(heap)
    reached = 0.0
    while heap:
        r, i, size = heapq.heappop(heap)
        if gone[i] or size != count[i]:                          # pruned away, or the rate has changed since
            continue
        reached = max(reached, r)
        strength[i] = reached
        todo = [i]
        while todo:
            j = todo.pop()
            gone[j] = True
            if inner[j]:
                todo += [c for c in (int(nodes.left[j]), int(nodes.right[j])) if not gone[c]]
        saved, worse = count[i] - 1, nodes.risk[i] - below[i]
        up = parent[i]
        while up >= 0:
            count[up] -= saved
            below[up] += worse
            heapq.heappush(heap, (rate(up), int(up), int(count[up])))
            up = parent[up]
    return strength


def terminal_nodes(nodes: Nodes, max_depth: int, penalty: float = 0.0, strength: np.ndarray | None = None) -> np.ndarray:
    """For each leaf of the full tree, the node at which a row of that leaf ends
    when the tree is cut at ``max_depth`` and pruned with ``penalty``."""
    ends = (nodes.left < 0) | (nodes.depth >= max_depth)
    if penalty > 0:
        ends |= (pruning_strength(nodes, max_depth) if strength is None else strength) <= penalty
    end = np.where(ends, np.arange(len(ends)), -1)
    for i in np.flatnonzero(nodes.left >= 0):                    # parents before children
        if end[i] >= 0:
            end[nodes.left[i]] = end[nodes.right[i]] = end[i]
    return end[nodes.leaves]


def cut_tree(nodes: Nodes, max_depth: int, penalty: float, children: tuple | None = None, below: np.ndarray | None = None,
             leaves: np.ndarray | None = None) -> tuple[np.ndarray, float, float]:
    """Node at which a row ends that passes node i, when the tree is cut at
    ``max_depth`` and pruned with ``penalty``; with risk and number of the cut
    tree's leaves. children: left and right before leaves were merged; below,
    leaves: risk and leaves of subtrees that hang on the tree's leaves.

    The pruned tree of one penalty needs no order of links: from the deepest
    level up, a node is a leaf if that costs no more than what is below it."""
    below = nodes.risk.astype(float) if below is None else below.astype(float)
    leaves = np.ones(len(below)) if leaves is None else leaves.astype(float)
    end = np.arange(len(below))
    order = np.argsort(nodes.depth, kind="stable")
    levels = np.split(order, np.flatnonzero(np.diff(nodes.depth[order])) + 1)
    passed = np.zeros(len(below), bool)
    for level in levels[::-1]:
        i = level[(nodes.left[level] >= 0) & (nodes.depth[level] < max_depth)]
        risk, n = below[nodes.left[i]] + below[nodes.right[i]], leaves[nodes.left[i]] + leaves[nodes.right[i]]
        stays = (nodes.risk[i] - risk > penalty * (n - 1)) if penalty > 0 else np.ones(len(i), bool)
        passed[i[stays]] = True
        below[i[stays]], leaves[i[stays]] = risk[stays], n[stays]
    left, right = children or (nodes.left, nodes.right)
    for level in levels:
        i = level[left[level] >= 0]
        i = i[(end[i] != i) | ~passed[i]]                        # rows that come here have ended
        end[left[i]], end[right[i]] = end[i], end[i]
    return end, float(below[0]), float(leaves[0])


# ---------------------------------------------------------------- thresholds and cells
@dataclass
class Binned:
    """Training rows as cells ``cell, n0..`` under ``thresholds`` (one array per feature)."""

    thresholds: list[np.ndarray]
    cells: DataFrame
    n_cells: int


def _places(rows: DataFrame, features: str, label: str, classes: list) -> DataFrame:
    """``x`` (array), ``y`` (place of the label in ``classes``); an unknown label is an error."""
    y = F.array_position(F.array(*[F.lit(c) for c in classes]), F.col(label)).cast("int") - 1
    y = F.when(y >= 0, y).otherwise(F.raise_error(F.lit(f"labels must be one of {classes}")).cast("int"))
    x = vector_to_array(F.col(features)) if rows.schema[features].dataType.simpleString() == "vector" else F.col(features)
    return rows.select(x.alias("x"), y.alias("y"))


def value_table(rows: DataFrame, features: str, label: str, classes: list) -> DataFrame:
    """Distinct values of each feature ``j`` in order: ``rank`` (from 0) of ``many``, value ``v``, the one
    before it, rows by class ``n``, summed up ``c``, and ``c`` of 64 places before in the same partition."""
    ks = range(len(classes))
    flat = _places(rows, features, label, classes).select(F.posexplode("x").alias("j", "v"), "y")
    flat = flat.withColumn("v", F.when(F.col("v") == 0.0, F.lit(0.0)).otherwise(F.col("v")))
    counts = flat.groupBy("j", "v").agg(*[F.count_if(F.col("y") == k).alias(f"n{k}") for k in ks])
    laid = materialize(counts.repartitionByRange("j", "v").withColumn("_pid", F.spark_partition_id()))
    parts = laid.groupBy("j", "_pid").agg(F.count(F.lit(1)).alias("_m"), F.max("v").alias("_last"), *[F.sum(f"n{k}").alias(f"_s{k}") for k in ks])
    so_far = Window.partitionBy("j").orderBy("_pid")             # one row per feature and partition
    parts = parts.select("j", "_pid", F.lag("_last").over(so_far).alias("_last"), (F.sum("_m").over(so_far) - F.col("_m")).alias("_before"),
                         F.sum("_m").over(Window.partitionBy("j")).alias("many"),
                         *[(F.sum(f"_s{k}").over(so_far) - F.col(f"_s{k}")).alias(f"_s{k}") for k in ks])
    w = Window.partitionBy("j", "_pid").orderBy("v")
    t = laid.join(F.broadcast(parts), ["j", "_pid"]).select(
        "j", "v", "many", (F.col("_before") + F.row_number().over(w) - 1).alias("rank"),
        F.coalesce(F.lag("v").over(w), F.col("_last")).alias("prev"), F.array(*[f"n{k}" for k in ks]).alias("n"),
        F.array(*[F.col(f"_s{k}") + F.sum(f"n{k}").over(w) for k in ks]).alias("c"), "_pid")
    return compact(t.select("*", F.struct(F.lag("c", 64).over(w).alias("c"), F.lag("n", 64).over(w).alias("n")).alias("back")))


def thresholds(table: DataFrame, counts: list[int], weights: list[float], max_bins: int = 64) -> list[np.ndarray]:
    """MLlib's thresholds from a ``value_table``: a midpoint before the value that
    brings the summed weight past each of ``max_bins`` equal strides (one per value),
    or all midpoints if they are no more.

    Fetched are the values within 64 places after one that passes a stride."""
    if max_bins > 64:
        raise ValueError("max_bins is at most 64")
    most = min(max_bins, sum(counts)) - 1
    stride = float(sum(n * w for n, w in zip(counts, weights))) / (most + 1)
    if not stride > 0:
        raise ValueError("a tree needs training rows")
    dot = lambda a: sum((F.col(a)[k] * F.lit(float(w)) for k, w in enumerate(weights)), F.lit(0.0))
    passed = lambda c, n: F.greatest(F.ceil((2 * dot(c) - dot(n)) / F.lit(2 * stride)) - 1, F.lit(0))
    near = table.withColumn("passed", passed("c", "n")).filter(
        (F.col("many") <= most + 1) | F.col("back.c").isNull() | (F.col("passed") > passed("back.c", "back.n")))
    out: dict[int, list] = {}
    for r in sorted(near.select("j", "rank", "v", "prev", "many", "passed").collect(), key=lambda r: r[:2]):
        cuts = out.setdefault(r["j"], [])
        if r["rank"] > 0 and (r["many"] <= most + 1 or len(cuts) < r["passed"]):
            cuts.append((r["prev"] + r["v"]) / 2.0)
    return [np.array(out[j]) for j in sorted(out)]


def binned_cells(rows: DataFrame, features: str, label: str, classes: list, cuts: list[np.ndarray]) -> DataFrame:
    """One row per distinct vector of bins (a byte per feature): ``cell, n0..`` rows by class."""
    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            if b.num_rows:
                x = b.column(0).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)
                bins = np.stack([np.searchsorted(t, x[:, j], "left") for j, t in enumerate(cuts)], 1).astype(np.uint8)
                ends = np.arange(b.num_rows + 1, dtype=np.int32) * bins.shape[1]
                cell = pa.Array.from_buffers(pa.binary(), b.num_rows, [None, pa.py_buffer(ends), pa.py_buffer(bins.tobytes())])
                yield pa.RecordBatch.from_arrays([cell, b.column(1)], ["cell", "y"])

    flat = _places(rows, features, label, classes).mapInArrow(batches, "cell binary, y int")
    return flat.groupBy("cell").agg(*[F.count_if(F.col("y") == k).alias(f"n{k}") for k in range(len(classes))])


def bin_rows(train: DataFrame, features: str, label: str, classes: list, counts: list[int], weights: list[float],
             max_bins: int = 64, table: DataFrame | None = None) -> Binned:
    """Thresholds and cells of training rows, shared by all trees on the same rows and weights."""
    cuts = thresholds(value_table(train, features, label, classes) if table is None else table, counts, weights, max_bins)
    cells = compact(binned_cells(train, features, label, classes, cuts))
    return Binned(cuts, cells, cells.count())


# ---------------------------------------------------------------- splits
@dataclass(frozen=True)
class Rule:
    """What splits a node: impurity, least rows of a leaf, class weights, thresholds of each feature, deepest level."""

    impurity: str
    min_leaf: int
    weights: tuple
    n_cuts: tuple
    depth: int

    def weigh(self, n: np.ndarray) -> np.ndarray:
        """Weight of ``n`` rows by class (last axis), added up row by row as MLlib does."""
        out = n.astype(float)
        for k, w in enumerate(self.weights):
            if w != 1.0:
                upto = int(min(n[..., k].max(initial=0), ADDED_UP))
                sums = np.concatenate([[0.0], np.add.accumulate(np.full(upto, w))])
                out[..., k] = np.where(n[..., k] <= upto, sums[np.minimum(n[..., k], upto)], n[..., k] * w)
        return out

    def of(self, stats: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Total weight and impurity of weights by class (last axis)."""
        total = np.zeros(stats.shape[:-1])
        for k in range(stats.shape[-1]):
            total = total + stats[..., k]
        safe = np.where(total == 0, 1.0, total)
        value = np.full(total.shape, 1.0 if self.impurity == "gini" else 0.0)
        for k in range(stats.shape[-1]):
            share = stats[..., k] / safe
            if self.impurity == "gini":
                value = value - share * share
            else:
                value = value - np.where(share > 0, share * (np.log(np.where(share > 0, share, 1.0)) / np.log(2.0)), 0.0)
        return total, np.where(total == 0, 0.0, value)


def best_splits(rule: Rule, hist: np.ndarray, impurity: np.ndarray | None) -> dict[str, np.ndarray]:
    """The best split of each node from its rows by (node, feature, bin, class);
    ``impurity`` None: the root, whose impurity is taken from its first split."""
    cum = np.cumsum(rule.weigh(hist), axis=2)
    rows = np.cumsum(hist.sum(-1), axis=2)
    left, right = cum[:, :, :-1], cum[:, :, -1:] - cum[:, :, :-1]
    (lw, li), (rw, ri) = rule.of(left), rule.of(right)
    stats = None
    if impurity is None:
        usable = [j for j, n in enumerate(rule.n_cuts) if n]
        stats = left[:, usable[0], 0] + right[:, usable[0], 0] if usable else cum[:, 0, -1]
        impurity = rule.of(stats)[1]
    weight = np.where(lw + rw == 0, 1.0, lw + rw)
    gain = impurity[:, None, None] - lw / weight * li - rw / weight * ri
    small = np.minimum(rows[:, :, :-1], rows[:, :, -1:] - rows[:, :, :-1]) < rule.min_leaf
    none = np.arange(gain.shape[2]) >= np.array(rule.n_cuts)[:, None]
    gain = np.where(small | none | (gain < 0), -np.inf, gain)
    flat = gain.reshape(len(gain), -1)
    at = flat.argmax(1)                                          # the first of equal gains
    i, j, b = np.arange(len(gain)), at // gain.shape[2], at % gain.shape[2]
    return {"gain": flat[i, at], "feature": j, "bin": b, "left": left[i, j, b], "right": right[i, j, b],
            "left_impurity": li[i, j, b], "right_impurity": ri[i, j, b], "stats": stats, "impurity": impurity}


def histograms(bins: np.ndarray, n: np.ndarray, node: np.ndarray, nodes: int, width: int) -> np.ndarray:
    """Rows by (node, feature, bin, class) of cells."""
    out = np.empty((nodes, bins.shape[1], width, n.shape[1]), np.int64)
    for j in range(bins.shape[1]):
        at = node * width + bins[:, j]
        for k in range(n.shape[1]):
            out[:, j, :, k] = np.bincount(at, n[:, k], nodes * width).reshape(nodes, width)
    return out


class Growing:
    """Nodes of a tree or subtree while it grows. A node is open until its split is settled."""

    def __init__(self, rule: Rule, stats=None, impurity=None, depth: int = 0):
        k = len(rule.weights)
        self.rule, self.left, self.right = rule, np.array([-1]), np.array([-1])
        self.feature, self.bin, self.depth = np.array([0]), np.array([0]), np.array([depth])
        self.stats = np.zeros((1, k)) if stats is None else np.array([stats], float)
        self.impurity = None if impurity is None else np.array([impurity], float)
        self.open = np.array([0])

    def settle(self, nodes: np.ndarray, s: dict[str, np.ndarray]) -> None:
        """Split ``nodes`` (open ones) by their ``best_splits`` or make them leaves."""
        if self.impurity is None:
            self.stats, self.impurity = s["stats"], s["impurity"].copy()
        self.open = np.setdiff1d(self.open, nodes)
        self.impurity[nodes[s["gain"] == -np.inf]] = -1.0        # as MLlib marks a leaf that no split fits
        keep = (s["gain"] > 0) & (self.depth[nodes] < self.rule.depth)
        up, n = nodes[keep], int(keep.sum())
        first = len(self.left) + 2 * np.arange(n)
        self.left[up], self.right[up], self.feature[up], self.bin[up] = first, first + 1, s["feature"][keep], s["bin"][keep]
        pair = lambda a, b: np.stack([a[keep], b[keep]], 1).reshape(2 * n, *a.shape[1:])
        impurity, depth = pair(s["left_impurity"], s["right_impurity"]), np.repeat(self.depth[up] + 1, 2)
        self.stats = np.concatenate([self.stats, pair(s["left"], s["right"])])
        self.impurity, self.depth = np.concatenate([self.impurity, impurity]), np.concatenate([self.depth, depth])
        for name, value in (("left", -1), ("right", -1), ("feature", 0), ("bin", 0)):
            setattr(self, name, np.concatenate([getattr(self, name), np.full(2 * n, value)]))
        new = np.stack([first, first + 1], 1).reshape(-1)
        self.open = np.concatenate([self.open, new[(np.abs(impurity) >= _EPS) & (depth < self.rule.depth)]])

    def step(self, bins: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The child that each cell goes to (its node, if that is not split)."""
        goes = bins[np.arange(len(bins)), self.feature[at]] <= self.bin[at]
        return np.where(self.left[at] < 0, at, np.where(goes, self.left[at], self.right[at]))

    def end(self, bins: np.ndarray) -> np.ndarray:
        """The leaf that each cell ends in."""
        at = np.zeros(len(bins), np.int64)
        while True:
            after = self.step(bins, at)
            if (after == at).all():
                return at
            at = after

    def nodes(self, total: float, leaf: np.ndarray | None = None, predicted: np.ndarray | None = None) -> Nodes:
        """The tree after leaves of one prediction below one node are merged, as in MLlib.
        leaf, predicted: for nodes on which subtrees hang, whether those are leaves and of what."""
        left, right, prediction = self.left.copy(), self.right.copy(), self.stats.argmax(1)
        leaf = left < 0 if leaf is None else leaf.copy()
        prediction = prediction if predicted is None else np.where(predicted >= 0, predicted, prediction)
        for depth in range(int(self.depth.max()), int(self.depth.min()) - 1, -1):
            i = np.flatnonzero((self.depth == depth) & (left >= 0))
            i = i[leaf[left[i]] & leaf[right[i]] & (prediction[left[i]] == prediction[right[i]])]
            prediction[i], leaf[i] = prediction[left[i]], True
            left[i], right[i] = -1, -1
        return Nodes(left, right, prediction, self.rule.of(self.stats)[0] / total * self.impurity, self.depth)


def grow(rule: Rule, bins: np.ndarray, n: np.ndarray, stats=None, impurity=None, depth: int = 0) -> Growing:
    """The whole subtree of a node from its cells, level by level."""
    tree = Growing(rule, stats, impurity, depth)
    width, at = max(rule.n_cuts, default=0) + 1, np.zeros(len(bins), np.int64)
    while len(tree.open) and len(bins):
        level, tree_open = np.sort(tree.open), np.full(len(tree.left), False)
        tree_open[level] = True
        keep = tree_open[at]
        bins, n, at = bins[keep], n[keep], at[keep]              # cells of leaves take no further part
        order = np.argsort(at, kind="stable")
        bins, n, at = bins[order], n[order], at[order]
        for part in np.split(level, range(NODES_AT_ONCE, len(level), NODES_AT_ONCE)):
            a, b = np.searchsorted(at, [part[0], part[-1] + 1])
            hist = histograms(bins[a:b], n[a:b], np.searchsorted(part, at[a:b]), len(part), width)
            tree.settle(part, best_splits(rule, hist, None if tree.impurity is None else tree.impurity[part]))
        at = tree.step(bins, at)
    return tree


# ---------------------------------------------------------------- the distributed tree
@dataclass
class DeepTree:
    """The upper part of a tree, in the driver, and the cells of which tasks grow the rest."""

    rule: Rule
    binned: Binned
    top: Growing
    subtrees: list[int]                                          # open nodes of the upper part
    total: float | None                                          # weight of all rows, if the root is not such a node


def _arrays(b: pd.DataFrame, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Bins and rows by class of cells."""
    return (np.frombuffer(b"".join(b["cell"]), np.uint8).reshape(len(b), -1).astype(np.int64),
            b[[f"n{c}" for c in range(k)]].to_numpy(np.int64))


_SPLIT = ("node int, gain double, feature int, bin int, left array<double>, right array<double>, left_impurity double, "
          "right_impurity double, stats array<double>, impurity double, left_cells bigint, right_cells bigint")


def _large_splits(cells: DataFrame, top: Growing, large: np.ndarray, k: int) -> list:
    """Best splits of the ``large`` open nodes: each task sums up its cells, and a
    node's sums (one row per task) are added and searched together."""
    rule, impurity = top.rule, None if top.impurity is None else top.impurity[large]
    shape = (len(rule.n_cuts), max(rule.n_cuts) + 1, k + 1)

    def sums(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out = np.zeros((len(large), *shape), np.int64)
        for b in it:
            if len(b):
                bins, n = _arrays(b, k)
                at = top.end(bins)
                keep = np.isin(at, large)
                n = np.concatenate([n, np.ones((len(n), 1), np.int64)], 1)       # last: cells
                out += histograms(bins[keep], n[keep], np.searchsorted(large, at[keep]), len(large), shape[1])
        yield pd.DataFrame({"node": np.arange(len(large)), "sums": [h.tobytes() for h in out]})

    def split(b: pd.DataFrame) -> pd.DataFrame:
        i = int(b["node"].iloc[0])
        hist = sum(np.frombuffer(h, np.int64).reshape(1, *shape) for h in b["sums"])
        s = best_splits(rule, hist[..., :k], None if impurity is None else impurity[[i]])
        j, at = int(s["feature"][0]), int(s["bin"][0])
        held = hist[0, j, :, k]
        row = {c: [s[c][0].tolist()] for c in ("gain", "feature", "bin", "left", "right", "left_impurity", "right_impurity", "impurity")}
        return pd.DataFrame(row | {"node": [int(large[i])], "stats": [s["left"][0].tolist() if s["stats"] is None else s["stats"][0].tolist()],
                                   "left_cells": [int(held[:at + 1].sum())], "right_cells": [int(held[at + 1:].sum())]})

    return cells.mapInPandas(sums, "node int, sums binary").groupBy("node").applyInPandas(split, _SPLIT).orderBy("node").collect()


def fit_deep(train: DataFrame, features: str, label: str, classes: list, depth: int, min_leaf: int, impurity: str,
             weights: list[float], max_bins: int = 64, binned: Binned | None = None) -> DeepTree:
    """One tree on rows weighted by class (``weights``, in the order of ``classes``), down to nodes of at most
    ``LOCAL_CELLS`` cells. ``binned``: the rows' cells, if another tree needed them."""
    if binned is None:
        n = {r[0]: r[1] for r in train.groupBy(label).count().collect()}
        binned = bin_rows(train, features, label, classes, [n.get(c, 0) for c in classes], weights, max_bins)
    rule = Rule(impurity, min_leaf, tuple(map(float, weights)), tuple(len(t) for t in binned.thresholds), depth)
    top, large = Growing(rule), np.array([0] if binned.n_cells > LOCAL_CELLS else [], np.int64)
    total = None
    while len(large):
        sizes: dict[int, int] = {}
        for r in _large_splits(binned.cells, top, large, len(classes)):
            before = len(top.left)
            top.settle(np.array([r["node"]]), {c: np.array([r[c]]) for c in r.asDict()})
            if len(top.left) > before:
                sizes[before], sizes[before + 1] = r["left_cells"], r["right_cells"]
        total = float(rule.of(top.stats[0])[0]) if total is None else total
        large = np.array(sorted(i for i in top.open if sizes.get(int(i), 0) > LOCAL_CELLS), np.int64)
    return DeepTree(rule, binned, top, [int(i) for i in top.open], total)


def path_confusions(model: DeepTree, test: DataFrame, features: str, label: str, classes: list,
                    settings: list[tuple[int | None, float]], cells: DataFrame | None = None) -> list[tuple]:
    """Confusion counts ``(max_depth, penalty, y, pred, n)`` on ``test`` of the
    model cut at each depth (None: as grown) and pruned with each penalty.
    ``cells``: the ``binned_cells`` of ``test``, if another tree needed them."""
    k, rule, top, total = len(classes), model.rule, model.top, model.total
    cuts = [(UNBOUNDED_DEPTH if d is None else d, p) for d, p in settings]
    counts = [f"n{c}" for c in range(k)]
    cells = binned_cells(test, features, label, classes, model.binned.thresholds) if cells is None else cells
    both = model.binned.cells.select(F.lit(True).alias("train"), "cell", *counts).unionByName(
        cells.select(F.lit(False).alias("train"), "cell", *counts))
    subtrees = np.array(model.subtrees)

    def dealt(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in it:
            if len(b):
                at = top.end(_arrays(b, k)[0])
                inside = np.isin(at, subtrees)
                b = b.assign(grp=at)
                yield b[inside]
                # settled leaves need no training cells, and of the others only how many end there
                held = b[~inside & ~b["train"].to_numpy(bool)].groupby("grp", as_index=False)[counts].sum()
                yield held.assign(train=False, cell=b"")[b.columns]

    def score(b: pd.DataFrame) -> pd.DataFrame:
        g, trained = int(b["grp"].iloc[0]), b["train"].to_numpy(bool)
        root = () if top.impurity is None else (top.stats[g], top.impurity[g], top.depth[g])
        (bins, _), n = _arrays(b, k), b[counts].to_numpy(np.int64)
        tree = grow(rule, bins[trained], n[trained], *root) if g in model_open else Growing(rule, *root)
        nodes = tree.nodes(float(rule.of(tree.stats[0])[0]) if total is None else total)
        leaf, n = tree.end(bins[~trained]) if g in model_open else np.zeros(int((~trained).sum()), np.int64), n[~trained]
        below, leaves, tables = [], [], []
        for depth, penalty in cuts:
            end, risk, many = cut_tree(nodes, depth, penalty, (tree.left, tree.right))
            pred = nodes.prediction[end[leaf]]
            below.append(risk)
            leaves.append(many)
            tables += [int(x) for c in range(k) for x in np.bincount(pred, n[:, c], k)]
        return pd.DataFrame({"grp": [g], "leaf": [bool(nodes.left[0] < 0)], "pred": [int(nodes.prediction[0])],
                             "below": [below], "leaves": [leaves], "tables": [tables]})

    model_open = set(model.subtrees)
    schema = ", ".join(["train boolean", "cell binary", *[f"{c} bigint" for c in counts], "grp int"])
    found = both.mapInPandas(dealt, schema).groupBy("grp").applyInPandas(
        score, "grp int, leaf boolean, pred int, below array<double>, leaves array<double>, tables array<bigint>").collect()
    tables = {r["grp"]: np.array(r["tables"], np.int64).reshape(len(cuts), k, k) for r in found}
    if len(top.left) == 1:
        sums = tables.get(0, np.zeros((len(cuts), k, k), np.int64))
    else:
        sums = np.zeros((len(cuts), k, k), np.int64)
        leaf, predicted = top.left < 0, np.full(len(top.left), -1)
        for r in found:
            leaf[r["grp"]], predicted[r["grp"]] = r["leaf"], r["pred"]
        nodes = top.nodes(total, leaf, predicted)
        for s, (depth, penalty) in enumerate(cuts):
            below, leaves = nodes.risk.astype(float), np.ones(len(nodes.risk))
            for r in found:
                below[r["grp"]], leaves[r["grp"]] = r["below"][s], r["leaves"][s]
            end, _, _ = cut_tree(nodes, depth, penalty, (top.left, top.right), below, leaves)
            for g, t in tables.items():
                if end[g] == g:
                    sums[s] += t[s]
                else:
                    sums[s][:, nodes.prediction[end[g]]] += t[s].sum(1)
    return [(d, p, classes[a], classes[b], int(sums[s][a, b]))
            for s, (d, p) in enumerate(settings) for a, b in zip(*np.nonzero(sums[s]))]
