"""Cross-validated scoring, grid search and refinement.

k-NN grids use one neighbour table per distance metric at the largest k;
every (k, weights) setting is a vote over that table, so a 40-setting grid
costs one neighbour search per metric, not 40. Tree grids fit one deep tree for
each (impurity, leaf size, weighting) and fold; depths and penalties are cuts
of it.
"""

from __future__ import annotations

import itertools
from threading import Lock

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import metrics, neighbors, treepaths, trees
from .runner import Study
from .sizing import ROWS_PER_TASK, compact, materialize

TREE_AXES = ["impurity", "max_depth", "min_leaf", "alpha", "ccp_alpha"]


def score_predictions(pred: DataFrame, by: list[str], domain: str = "observed",
                      n_classes: int | None = None) -> DataFrame:
    """Mean and SD over folds of balanced accuracy and macro F1 per ``by`` group."""
    return score_counts(metrics.confusion(pred, [*by, "fold"]), by, domain, n_classes)


def score_counts(conf: DataFrame, by: list[str], domain: str = "observed", n_classes: int | None = None) -> DataFrame:
    """E9 from confusion counts ``(by..., fold, y, pred, n)``."""
    sc = metrics.scores(conf, [*by, "fold"], domain, n_classes)
    return sc.groupBy(*by).agg(
        F.round(F.avg("balanced_accuracy"), 6).alias("bal_mean"),
        F.round(F.stddev_samp("balanced_accuracy"), 6).alias("bal_std"),
        F.round(F.avg("f1_macro"), 6).alias("f1_mean"),
        F.round(F.stddev_samp("f1_macro"), 6).alias("f1_std"))


def knn_grid(df: DataFrame, key: str, features: str, label: str, fold: str, classes: list,
             ks: list[int], weights: list[str], distance_metrics: list[str]) -> DataFrame:
    """E11 for k-NN: scores of every (k, weights, metric), best first."""
    meta = df.select(F.col(key).cast("long").alias("query"), F.col(fold).alias("fold"), F.col(label).alias("y"))
    parts = []
    for m in distance_metrics:
        neigh = neighbors.knn(df, df, key, features, label, max(ks), m, fold=fold).persist()
        for w in weights:
            v = neighbors.vote(neigh, ks, w, classes).join(meta, "query")
            parts.append(v.select(F.col("k").cast("int").alias("k"), F.lit(w).alias("weights"),
                                  F.lit(m).alias("metric"), "fold", "y", "pred"))
    pred = parts[0]
    for p in parts[1:]:
        pred = pred.unionByName(p)
    return score_predictions(pred, ["k", "weights", "metric"]).orderBy(
        F.desc("f1_mean"), "k", "weights", "metric")


def tree_confusions(ready, label: str, classes: list, spaces: list[dict], study: Study, threads: int = 8) -> DataFrame:
    """Held-out confusion counts of every tree setting: ``impurity, max_depth,
    min_leaf, alpha, ccp_alpha, fold, y, pred, n``.

    ready: a function that gives (fold, prepared rows) pairs, called once if
    anything is left to fit; spaces: dicts of TREE_AXES -> values
    (None for the unbounded depth; ccp_alpha may be left out). Settings that
    differ in depth or penalty share their fits; each (impurity, min_leaf,
    alpha) is a part of ``study``, finished parts are not fitted again, and
    parts are submitted from driver threads, as each is a chain of small jobs."""
    fits: dict[tuple, list] = {}
    for s in spaces:
        for i, d, m, a, c in itertools.product(*[s.get(x, [0.0]) for x in TREE_AXES]):
            cuts = fits.setdefault((i, m, float(a)), [])
            if (d, float(c)) not in cuts:
                cuts.append((d, float(c)))
    schema = ("impurity string, max_depth int, min_leaf int, alpha double, ccp_alpha double, "
              f"fold int, y {_sql_type(classes)}, pred {_sql_type(classes)}, n bigint")
    lock, locks, made = Lock(), {}, {}

    def once(key, make):                                 # shared by the threads, computed by the first that needs it
        with lock:
            mine = locks.setdefault(key, Lock())
        with mine:
            if key not in made:
                made[key] = make()
            return made[key]

    def part(impurity, min_leaf, alpha, cuts):
        def rows():
            out = []
            depth = max(trees.UNBOUNDED_DEPTH if d is None else d for d, _ in cuts)
            for f, prepared in once("folds", lambda: list(ready())):
                train, test = prepared.filter(F.col("fold") != f), prepared.filter(F.col("fold") == f)
                counts = once(("counts", f), lambda: {r[0]: r[1] for r in train.groupBy(label).count().collect()})
                tasks = max(1, -(-sum(counts.values()) // ROWS_PER_TASK))       # fewer only: a small fold is not worth many tasks
                names = ("features", label, classes)
                weights = trees.class_weights(counts, classes, alpha)
                values = once(("values", f), lambda: treepaths.value_table(train.coalesce(tasks), *names))
                binned = once(("cells", f, alpha), lambda: treepaths.bin_rows(
                    train.coalesce(tasks), *names, [counts.get(c, 0) for c in classes], weights, table=values))
                held = once(("held", f, alpha), lambda: compact(treepaths.binned_cells(test.coalesce(tasks), *names, binned.thresholds)))
                model = treepaths.fit_deep(train, *names, depth, min_leaf, impurity, weights, binned=binned)
                out += [(impurity, d, min_leaf, alpha, c, int(f), y, p, n)
                        for d, c, y, p, n in treepaths.path_confusions(model, test, *names, cuts, cells=held)]
            return study.spark.createDataFrame(out, schema).coalesce(1)
        return rows

    return study.run({f"{i}-{m}-{a}-{cuts}": part(i, m, a, cuts) for (i, m, a), cuts in fits.items()}, threads)


def _sql_type(classes: list) -> str:
    return "string" if isinstance(classes[0], str) else "int"


def tree_grid(conf: DataFrame) -> DataFrame:
    """E11 for trees: mean and SD over folds for each setting of ``tree_confusions``."""
    folds = metrics.scores(conf, [*TREE_AXES, "fold"])
    return folds.groupBy(*TREE_AXES).agg(
        *[F.round(agg(m), 6).alias(f"{n}_{stat}") for m, n in (("f1_macro", "f1"), ("balanced_accuracy", "bal"))
          for agg, stat in ((F.avg, "mean"), (F.stddev_samp, "std"))])


def best(grid: DataFrame, score: str = "f1_mean", axes: list[str] = ()) -> dict:
    """O1: the best row (ties broken by the axes in order); one row collected."""
    return grid.orderBy(F.desc(score), *[F.asc_nulls_last(a) for a in axes]).limit(1).first().asDict()


def refine_k(k: int) -> list[int]:
    """K -> {k-2, k-1, k, k+1, k+2, k+4}, at least 1, deduplicated and ordered."""
    return sorted({x for x in (k - 2, k - 1, k, k + 1, k + 2, k + 4) if x >= 1})


def refine_depth(d: int | None, deltas=(-3, 0, 3)) -> list:
    """Depth -> {d-3, d, d+3, unbounded}; unbounded (None) last."""
    if d is None:
        return [None]
    return sorted({max(1, d + x) for x in deltas}) + [None]


def refine_alpha(a: float, step: float = 0.125) -> list[float]:
    """Alpha +- step clipped to [0, 1]."""
    return sorted({round(min(1.0, max(0.0, a + x)), 6) for x in (-step, 0.0, step)})


def choose_k_and_rule(pred_by_k: DataFrame, classes: list, fit) -> tuple[int, list[float], float]:
    """Fit multipliers for each k and keep the k with the best tuned
    score (first k on ties). ``fit`` is ``rules.fit_multipliers``-like."""
    pred_by_k = materialize(pred_by_k.select("k", "fold", "y", "p"))      # one search for every k
    ks = sorted(r[0] for r in pred_by_k.select("k").distinct().collect())
    best_k, best_w, best_s = None, None, float("-inf")
    for k in ks:
        w, s = fit(pred_by_k.filter(F.col("k") == k).select("fold", "y", "p"), classes)
        if s > best_s:
            best_k, best_w, best_s = k, [r["w"] for r in w.orderBy("cls").collect()], s
    return best_k, best_w, best_s
