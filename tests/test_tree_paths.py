"""Depths and penalties of one fit, the study runner and the tree search on them."""

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabulon.operators import features, treepaths, trees
from tabulon.operators.treepaths import Nodes, pruning_strength, terminal_nodes
from tabulon.plans import search
from tabulon.plans.runner import Study


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(7)
    x = rng.integers(0, 40, (400, 4)).astype(float)
    y = ((x[:, 0] > 20) & (x[:, 1] > 15)).astype(int) + (x[:, 2] > 35)
    y = np.where(rng.random(400) < 0.2, rng.integers(0, 3, 400), y)
    df = spark.createDataFrame([(i, *map(float, x[i]), int(y[i]), i % 4) for i in range(400)], "id int, a double, b double, c double, d double, y int, fold int")
    return features.tree_features(df, df, ["a", "b", "c", "d"], []).select("id", "y", "fold", "features").persist()


def test_cut_tree_predicts_as_a_refitted_one(spark, rows):
    train, test = rows.filter("fold <> 0"), rows.filter("fold = 0")
    counts = {r[0]: r[1] for r in train.groupBy("y").count().collect()}
    for impurity, leaf, alpha in (("gini", 1, 0.75), ("entropy", 5, 0.0)):
        model = treepaths.fit_deep(train, "features", "y", [0, 1, 2], 20, leaf, impurity, trees.class_weights(counts, [0, 1, 2], alpha))
        got = treepaths.path_confusions(model, test, "features", "y", [0, 1, 2], [(d, 0.0) for d in (0, 2, 5, 20)])
        for depth in (0, 2, 5, 20):
            again = trees.tree_probabilities(train, test, "id", "features", "y", [0, 1, 2], depth, leaf, impurity, alpha)
            want = {(r[0], r[1]): r[2] for r in again.join(test.select("id", "y"), "id").groupBy("y", "pred").count().collect()}
            assert {(y, p): n for d, _, y, p, n in got if d == depth} == want


def random_tree(rng, n_inner):
    """A tree grown by splitting random leaves; risks fall with every split."""
    left, right, risk, children = [-1], [-1], [1.0], [0]
    for _ in range(n_inner):
        i = rng.choice(children)
        children.remove(i)
        share, first = rng.random() * 0.6 + 0.4, rng.choice([0.5, rng.random()])
        for side, part in ((left, first), (right, 1 - first)):
            side[i] = len(left)
            left.append(-1)
            right.append(-1)
            risk.append(risk[i] * share * part)
            children.append(len(left) - 1)
    depth = [0] * len(left)
    for i in range(len(left)):
        if left[i] >= 0:
            depth[left[i]] = depth[right[i]] = depth[i] + 1
    return Nodes(np.array(left), np.array(right), np.arange(len(left)), np.array(risk), np.array(depth))


def best_pruned_cost(t, i, max_depth, penalty):
    """Least risk + penalty x leaves over all prunings below node i, by recursion."""
    here = t.risk[i] + penalty
    if t.left[i] < 0 or t.depth[i] >= max_depth:
        return here
    return min(here, best_pruned_cost(t, t.left[i], max_depth, penalty) + best_pruned_cost(t, t.right[i], max_depth, penalty))


def test_pruning_reaches_the_least_cost_of_every_penalty():
    rng = np.random.default_rng(3)
    for _ in range(150):
        t = random_tree(rng, int(rng.integers(0, 25)))
        for depth, penalty in itertools.product((1, 3, 30), (0.0, 1e-6, 0.01, 0.05, 0.2, 2.0)):
            ends = set(terminal_nodes(t, depth, penalty).tolist())
            cost = sum(t.risk[i] + penalty for i in ends)
            assert abs(cost - best_pruned_cost(t, 0, depth, penalty)) < 1e-9
        strength = pruning_strength(t, 30)
        order = np.sort(strength[np.isfinite(strength)])
        sizes = [len(set(terminal_nodes(t, 30, p).tolist())) for p in order]
        assert sizes == sorted(sizes, reverse=True)                     # larger penalties give nested, smaller trees
        if t.left[0] >= 0:
            assert strength[0] == order[-1]


def test_tree_search_tries_every_setting_once_and_resumes(spark, rows, tmp_path, monkeypatch):
    from tabulon.plans.queries import TREE_SPACES
    one, two = TREE_SPACES
    assert one == {"impurity": ["gini", "entropy"], "max_depth": [5, 10, 15, 20, None], "min_leaf": [1, 5, 20], "alpha": [0.0, 1.0]}
    assert two["max_depth"] == [13, 20, None] and two["min_leaf"] == [1, 2, 5] and len(two["alpha"]) == 5
    ready = lambda: [(f, rows) for f in range(2)]
    spaces = [{"impurity": ["gini"], "max_depth": [2, None], "min_leaf": [1], "alpha": [0.0, 1.0]},
              {"impurity": ["gini", "entropy"], "max_depth": [2], "min_leaf": [1], "alpha": [1.0], "ccp_alpha": [0.0, 0.01]}]
    study = Study(spark, "t", {"a": 1}, rows.select("id", "y", "fold"), str(tmp_path))
    fits, real = [], treepaths.fit_deep

    def failing(*args, **kw):
        fits.append(args[6])
        if len(fits) == 4:
            raise RuntimeError("lost")
        return real(*args, **kw)

    monkeypatch.setattr(treepaths, "fit_deep", failing)
    with pytest.raises(RuntimeError):
        search.tree_confusions(ready, "y", [0, 1, 2], spaces, study, threads=1)
    got = search.tree_grid(search.tree_confusions(ready, "y", [0, 1, 2], spaces, study, threads=1)).collect()
    assert len(fits) == 2 + 2 + 2 + 2                 # (gini, 0.0) kept; the fit that failed and its fold before are done again
    keys = [(r["impurity"], r["max_depth"], r["min_leaf"], r["alpha"], r["ccp_alpha"]) for r in got]
    assert len(keys) == len(set(keys))
    want = {("gini", 2, 1, 0.0, 0.0), ("gini", None, 1, 0.0, 0.0), ("gini", 2, 1, 1.0, 0.0), ("gini", None, 1, 1.0, 0.0),
            ("gini", 2, 1, 1.0, 0.01), ("entropy", 2, 1, 1.0, 0.0), ("entropy", 2, 1, 1.0, 0.01)}
    assert set(keys) == want


def test_study_parts_are_bound_to_settings_and_data(spark, tmp_path):
    calls = []

    def part(n):
        def rows():
            calls.append(n)
            return spark.range(n).withColumn("part", F.lit(n))
        return rows

    data = spark.range(5)
    parts = {"a": part(2), "b": part(3)}
    assert Study(spark, "s", {"k": 1}, data, str(tmp_path)).run(parts, threads=2).count() == 5 and sorted(calls) == [2, 3]
    again = Study(spark, "s", {"k": 1}, data, str(tmp_path)).run(parts)
    assert sorted(r["part"] for r in again.collect()) == [2, 2, 3, 3, 3] and len(calls) == 2
    Study(spark, "s", {"k": 2}, data, str(tmp_path)).run({"a": part(2)})
    Study(spark, "s", {"k": 1}, spark.range(6), str(tmp_path)).run({"a": part(2)})
    assert len(calls) == 4


def test_one_penalty_needs_no_order_of_links():
    rng = np.random.default_rng(5)
    for _ in range(150):
        t = random_tree(rng, int(rng.integers(0, 40)))
        for depth, penalty in itertools.product((0, 2, 30), (0.0, 1e-6, 0.01, 0.05, 2.0)):
            end, risk, leaves = treepaths.cut_tree(t, depth, penalty)
            want = terminal_nodes(t, depth, penalty)
            assert (end[t.leaves] == want).all() and leaves == len(set(want.tolist()))
            assert abs(risk - sum(t.risk[i] for i in set(want.tolist()))) < 1e-12


@pytest.mark.parametrize("impurity,leaf,alpha", [("gini", 1, 0.75), ("entropy", 3, 0.0)])
def test_large_nodes_are_split_in_spark_and_small_ones_in_tasks(spark, rows, monkeypatch, impurity, leaf, alpha):
    train, test = rows.filter("fold <> 0"), rows.filter("fold = 0")
    counts = {r[0]: r[1] for r in train.groupBy("y").count().collect()}
    settings = [(d, p) for d in (0, 1, 3, 6, None) for p in (0.0, 1e-4, 2e-3, 0.02, 1.0)]
    found, upper = [], []
    for cells in (10_000, 40):
        monkeypatch.setattr(treepaths, "LOCAL_CELLS", cells)
        model = treepaths.fit_deep(train, "features", "y", [0, 1, 2], 30, leaf, impurity, trees.class_weights(counts, [0, 1, 2], alpha))
        upper.append(len(model.top.left))
        found.append(sorted(treepaths.path_confusions(model, test, "features", "y", [0, 1, 2], settings), key=str))
    assert found[0] == found[1]
    assert upper[0] == 1 < upper[1]                     # what the driver holds: nodes of more cells, and their children
    assert all(sum(r[4] for r in found[0] if r[:2] == s) == test.count() for s in settings)
    assert len({tuple(r[2:] for r in found[0] if r[:2] == s) for s in settings}) > 5


def test_thresholds_of_repeated_and_many_values(spark):
    """A third of the rows on one value, zeros, few values, and more values than bins over several partitions."""
    rng = np.random.default_rng(1)
    x = np.stack([np.where(rng.random(3000) < 0.33, 7.0, rng.integers(0, 500, 3000)), rng.integers(-1, 3, 3000),
                  np.full(3000, 2.0), rng.integers(1, 4000, 3000) ** 2 / 7.0, np.where(rng.random(3000) < 0.6, 1.0, rng.integers(1, 90, 3000))], 1)
    y = rng.integers(0, 2, 3000)
    df = spark.createDataFrame([(x[i].tolist(), int(y[i])) for i in range(3000)], "x array<double>, y int").repartition(5)
    n = [int((y == 0).sum()), int((y == 1).sum())]
    table = treepaths.value_table(df, "x", "y", [0, 1])
    for weights in ([1.0, 1.0], [0.5, 3.25]):
        got = treepaths.thresholds(table, n, weights)
        for j in range(5):
            values = np.unique(x[:, j])
            mass = [float(np.array(weights)[y[x[:, j] == v]].sum()) for v in values]
            want, upto = [], mass[0]
            stride = target = sum(mass) / 64
            for i in range(1, len(values)):
                before, upto = upto, upto + mass[i]
                if len(values) <= 64 or abs(before - target) < abs(upto - target):
                    want.append((values[i - 1] + values[i]) / 2)
                    target += stride
            assert got[j].tolist() == want and len(want) <= 63


def test_unknown_labels_are_an_error(spark, rows):
    with pytest.raises(Exception, match="labels must be one of"):
        treepaths.fit_deep(rows, "features", "y", [0, 1], 3, 1, "gini", [1.0, 1.0])


def test_cells_and_values_of_few_rows_are_in_few_partitions(spark):
    df = spark.range(0, 600, 1, 16).select((F.col("id") % 2).cast("int").alias("y"), F.array((F.col("id") % 300).cast("double"), (F.col("id") % 7).cast("double")).alias("x"))
    was = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        values = treepaths.value_table(df, "x", "y", [0, 1])
        binned = treepaths.bin_rows(df, "x", "y", [0, 1], [300, 300], [1.0, 1.0], table=values)
        assert values.rdd.getNumPartitions() == 1 and binned.cells.rdd.getNumPartitions() == 1
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", was)
    x = np.array([[i % 300, i % 7] for i in range(600)], float)
    cells = {tuple(np.searchsorted(t, v) for t, v in zip(binned.thresholds, r)) for r in x}
    assert {tuple(r["cell"]) for r in binned.cells.collect()} == cells and binned.n_cells == len(cells)
