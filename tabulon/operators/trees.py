"""Cost-sensitive classification trees on MLlib.

MLlib grows the tree as a distributed histogram job; thresholds are binned
(``max_bins``), so results are comparable to an exact-split tree, not
equal. ``max_depth`` above 30 is refused by MLlib, so "unbounded" is 30.
"""

from __future__ import annotations

from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.sizing import bounded_broadcast

UNBOUNDED_DEPTH = 30


def power_weights(train: DataFrame, label: str, alpha: float) -> DataFrame:
    """``w_c = (N / (K n_c))^alpha`` from training counts; 0 = none, 1 = balanced."""
    c = train.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    from pyspark.sql import Window
    tot = F.sum("n").over(Window.partitionBy())
    k = F.count(F.lit(1)).over(Window.partitionBy())
    return c.select(label, "n", F.round(F.pow(tot / (k * F.col("n")), F.lit(float(alpha))), 9).alias("w"))


def class_weights(counts: dict, classes: list, alpha: float) -> list[float]:
    """The weights of ``power_weights`` from class counts, in the order of
    ``classes``; 1 for a class without rows."""
    present = [n for n in counts.values() if n]
    mean = sum(present) / max(len(present), 1)
    return [round((mean / counts[c]) ** alpha, 9) if counts.get(c) else 1.0 for c in classes]


def tree_probabilities(train: DataFrame, test: DataFrame, key: str, features: str, label: str,
                       classes: list, max_depth: int | None = 10, min_leaf: int = 1,
                       impurity: str = "gini", alpha: float = 0.0, max_bins: int = 64,
                       min_info_gain: float = 0.0, seed: int = 42) -> DataFrame:
    """Fit on ``train`` (class weights ``power_weights(alpha)``) and
    return ``key, p (array over classes), pred`` for ``test``. ``max_depth`` None
    is the deepest tree MLlib grows; 0 is a single leaf; more than 30 is refused."""
    if max_depth is not None and not 0 <= max_depth <= UNBOUNDED_DEPTH:
        raise ValueError(f"max_depth is from 0 to {UNBOUNDED_DEPTH}, or None")
    cls = F.array(*[F.lit(c) for c in classes])
    idx = (F.array_position(cls, F.col(label)) - 1).cast("double")
    w = power_weights(train, label, alpha).select(label, F.col("w").alias("_w"))
    tr = train.join(bounded_broadcast(w), label, "inner").withColumn("_y", idx)
    dt = DecisionTreeClassifier(featuresCol=features, labelCol="_y", weightCol="_w",
                                maxDepth=UNBOUNDED_DEPTH if max_depth is None else max_depth,
                                minInstancesPerNode=min_leaf, impurity=impurity, maxBins=max_bins,
                                minInfoGain=min_info_gain, seed=seed)
    model = dt.fit(tr)
    out = model.transform(test.select(key, features))
    p = vector_to_array("probability")
    k = len(classes)
    # MLlib sizes the distribution by the largest label seen; pad to K classes
    p = F.concat(p, F.array_repeat(F.lit(0.0), F.greatest(F.lit(k) - F.size(p), F.lit(0))))
    return out.select(key, F.slice(p, 1, k).alias("p")).withColumn(
        "pred", F.element_at(cls, (F.array_position(F.col("p"), F.array_max("p"))).cast("int")))


def best_per(grid_df: DataFrame, axis: str) -> DataFrame:
    """Best scores per value of one axis (max over the others)."""
    return grid_df.groupBy(axis).agg(F.max("f1_mean").alias("f1_mean"), F.max("bal_mean").alias("bal_mean"))


def refine(best: dict, rules: dict) -> dict:
    """Coarse-to-fine neighbourhood around a winner, deduplicated,
    clipped, ordered (None, i.e. unbounded, last)."""
    out = {}
    for name, rule in rules.items():
        vals = rule(best[name])
        uniq = sorted({v for v in vals if v is not None}, key=float)
        out[name] = uniq + ([None] if None in vals else [])
    return out
