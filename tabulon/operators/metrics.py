"""Classification metrics from confusion counts.

One shuffle produces ``(by..., y, pred, n)``; every metric is then an
aggregate over that table, which has at most groups x K x K rows.
Per-class F1 is 2 tp / (t + p) (0 when t + p = 0), identical to
2PR/(P+R) with empty precision or recall taken as 0.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import safe_div

METRICS = ["accuracy", "balanced_accuracy", "f1_macro", "f1_weighted", "mcc", "kappa",
           "precision_macro", "recall_macro"]


def confusion(pred: DataFrame, by: list[str], y: str = "y", yhat: str = "pred") -> DataFrame:
    """``(by..., y, pred, n)``, observed cells only."""
    return pred.groupBy(*by, F.col(y).alias("y"), F.col(yhat).alias("pred")).agg(
        F.count(F.lit(1)).alias("n"))


def confusion_filled(conf: DataFrame, by: list[str], classes: list) -> DataFrame:
    """A23 zero-filled to the K x K grid of ``classes`` for every ``by`` group.

    Each group's observed cells (at most K^2) become a map; the grid is
    generated from the class list with ``explode``, so no join is needed."""
    cells = conf.groupBy(*by).agg(F.map_from_entries(F.collect_list(
        F.struct(F.struct(F.col("y"), F.col("pred")), F.col("n")))).alias("_m"))
    grid = F.array(*[F.struct(F.lit(a).alias("y"), F.lit(b).alias("pred")) for a in classes for b in classes])
    out = cells.select(*by, "_m", F.explode(grid).alias("_c"))
    return out.select(*by, F.col("_c.y").alias("y"), F.col("_c.pred").alias("pred"),
                      F.coalesce(F.col("_m")[F.col("_c")], F.lit(0)).cast("bigint").alias("n"))


def summed(conf: DataFrame, by: list[str]) -> DataFrame:
    """A23 second level: confusion summed over the dropped grouping columns."""
    return conf.groupBy(*by, "y", "pred").agg(F.sum("n").alias("n"))


def class_totals(conf: DataFrame, by: list[str]) -> DataFrame:
    """Per (by..., class): t = actual, p = predicted, tp = correct."""
    rows = conf.select(*by, F.explode(F.array(
        F.struct(F.col("y").alias("cls"), F.col("n").alias("t"), F.lit(0).cast("bigint").alias("p"),
                 F.when(F.col("y") == F.col("pred"), F.col("n")).otherwise(0).cast("bigint").alias("tp")),
        F.struct(F.col("pred").alias("cls"), F.lit(0).cast("bigint").alias("t"), F.col("n").alias("p"),
                 F.lit(0).cast("bigint").alias("tp")))).alias("_e"))
    return rows.groupBy(*by, F.col("_e.cls").alias("cls")).agg(
        F.sum("_e.t").alias("t"), F.sum("_e.p").alias("p"), F.sum("_e.tp").alias("tp"))


def scores(conf: DataFrame, by: list[str], domain: str = "observed", n_classes: int | None = None,
           digits: int = 6) -> DataFrame:
    """One row per group.

    domain='observed' averages per-class F1 over classes present in actual or
    predicted labels; domain='all' divides by ``n_classes`` (absent = 0).
    """
    ct = class_totals(conf, by)
    f1 = safe_div(2.0 * F.col("tp"), F.col("t") + F.col("p"))
    g = ct.groupBy(*by).agg(
        F.sum("tp").alias("c"), F.sum("t").alias("s"),
        F.avg(F.when(F.col("t") > 0, F.col("tp") / F.col("t"))).alias("bal"),
        F.sum(f1).alias("f1_sum"), F.count(F.lit(1)).alias("k_obs"),
        F.sum(f1 * F.col("t")).alias("f1_w"),
        # products of counts pass 2^63 on large tables: double
        F.sum(F.col("p").cast("double") * F.col("t")).alias("pt"),
        F.sum(F.col("p").cast("double") * F.col("p")).alias("pp"), F.sum(F.col("t").cast("double") * F.col("t")).alias("tt"),
        F.avg(safe_div(F.col("tp"), F.col("p"))).alias("prec"),
        F.avg(safe_div(F.col("tp"), F.col("t"))).alias("rec"),
    )
    s = F.col("s").cast("double")
    denom = F.col("k_obs") if domain == "observed" else F.lit(float(n_classes))
    mcc_den = F.sqrt((s * s - F.col("pp")) * (s * s - F.col("tt")))
    pe = F.col("pt") / (s * s)
    r = lambda e: F.round(e, digits)
    return g.select(
        *by,
        r(F.col("c") / s).alias("accuracy"),
        r(F.col("bal")).alias("balanced_accuracy"),
        r(F.col("f1_sum") / denom).alias("f1_macro"),
        r(F.col("f1_w") / s).alias("f1_weighted"),
        r(safe_div(F.col("c") * s - F.col("pt"), mcc_den)).alias("mcc"),
        r(safe_div(F.col("c") / s - pe, 1.0 - pe)).alias("kappa"),
        r(F.col("prec")).alias("precision_macro"),
        r(F.col("rec")).alias("recall_macro"),
    )


def per_class(conf: DataFrame, by: list[str], digits: int = 6) -> DataFrame:
    """Per-class precision, recall, F1 and support."""
    ct = class_totals(conf, by)
    r = lambda e: F.round(e, digits)
    return ct.select(*by, "cls",
                     r(safe_div(F.col("tp"), F.col("p"))).alias("precision"),
                     r(safe_div(F.col("tp"), F.col("t"))).alias("recall"),
                     r(safe_div(2.0 * F.col("tp"), F.col("t") + F.col("p"))).alias("f1"),
                     F.col("t").cast("bigint").alias("support"))


def pooled_precision_recall(conf: DataFrame, by: list[str]) -> DataFrame:
    """Macro precision and recall of the confusion summed over the other columns."""
    s = scores(summed(conf, by), by)
    return s.select(*by, F.col("precision_macro").alias("precision_macro_pooled"),
                    F.col("recall_macro").alias("recall_macro_pooled"))


def summary(fold_scores: DataFrame, by: list[str], metrics: list[str] = METRICS,
            digits: int = 6) -> DataFrame:
    """Mean and sample SD of every metric per group, ``<metric>_mean``/``_std``."""
    aggs = []
    for m in metrics:
        aggs += [F.round(F.avg(m), digits).alias(f"{m}_mean"),
                 F.round(F.stddev_samp(m), digits).alias(f"{m}_std")]
    return fold_scores.groupBy(*by).agg(*aggs, F.count(F.lit(1)).cast("bigint").alias("n_folds"))


def row_normalised(conf: DataFrame, by: list[str], digits: int = 6) -> DataFrame:
    """Each actual-class row divided by its total (at least 1)."""
    w = Window.partitionBy(*by, "y")
    return conf.withColumn("share", F.round(F.col("n") / F.greatest(F.sum("n").over(w), F.lit(1)), digits))
