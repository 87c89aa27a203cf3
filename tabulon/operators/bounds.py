"""Attainability bounds from repeated feature vectors.

Everything is computed on count tables, never by joining predictions back to
rows: (vector, label) counts are map-side combined, so a vector holding a
third of all rows is one row per input partition before it moves.

Cross-validated bounds use leave-fold-out by subtraction: counts per
(fold, vector, label) are aggregated once; the training counts of fold f are
totals minus fold f, so all folds come from one pass.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..plans.sizing import join_null_safe, materialize
from . import metrics


def _majority(counts: DataFrame, part: list[str], label: str, n: str) -> DataFrame:
    """Majority label per ``part`` group (ties to the lowest label), rows with n > 0."""
    w = Window.partitionBy(*part).orderBy(F.desc(n), F.asc(label))
    return (counts.filter(F.col(n) > 0).withColumn("_rn", F.row_number().over(w))
            .filter("_rn = 1").select(*part, F.col(label).alias("majority")))


def resubstitution_confusion(df: DataFrame, features: list[str], label: str) -> DataFrame:
    """B1: confusion ``(y, pred, n)`` of predicting each vector's majority label."""
    vl = df.groupBy(*features, label).agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy(*features).orderBy(F.desc("n"), F.asc(label))
    maj = vl.withColumn("pred", F.first(label).over(w))
    return maj.groupBy(F.col(label).alias("y"), "pred").agg(F.sum("n").alias("n"))


def resubstitution(df: DataFrame, features: list[str], label: str, n_classes: int) -> DataFrame:
    """B1 summary: distinct vectors, rows, accuracy and macro F1 over all classes."""
    conf = resubstitution_confusion(df, features, label)
    s = metrics.scores(conf, [], domain="all", n_classes=n_classes).select("accuracy", "f1_macro")
    v = df.select(*features).distinct().agg(F.count(F.lit(1)).cast("bigint").alias("distinct_vectors"))
    r = df.agg(F.count(F.lit(1)).cast("bigint").alias("total_rows"))
    from ..plans.sizing import join_single_rows
    return join_single_rows(v, r, s)


def resubstitution_per_class(df: DataFrame, features: list[str], label: str) -> DataFrame:
    """B1 per class: F1 of the majority-label rule."""
    return metrics.per_class(resubstitution_confusion(df, features, label), []).select(
        "cls", F.col("f1").alias("f1_resubstitution"), "support")


def share_needed(per_class: DataFrame, target: float, bound: str = "f1_resubstitution") -> DataFrame:
    """With the ``hardest`` classes (lowest ``bound`` first, ties by class) at
    their bound, the mean score the other classes must reach for a macro score of
    ``target``, the mean bound they have, and whether that is enough. One row for
    each number of hardest classes but all. ``per_class`` has a row a class, so
    the windows see no more than that. Rounded to 9 places: bounds have 6, and
    halves of them would tie at 6."""
    order = Window.orderBy(F.asc_nulls_first(bound), "cls")
    c = per_class.select("cls", F.coalesce(bound, F.lit(0.0)).alias("_b"),
                         F.row_number().over(order).alias("hardest"), F.count(F.lit(1)).over(Window.partitionBy()).alias("_k"),
                         F.sum(F.coalesce(bound, F.lit(0.0))).over(Window.partitionBy()).alias("_all"))
    so_far = F.sum("_b").over(Window.orderBy("hardest"))
    others = F.col("_k") - F.col("hardest")
    return (c.withColumn("_done", so_far).filter("hardest < _k")
            .select(F.col("hardest").cast("int").alias("hardest"), F.col("cls").alias("last_class"),
                    F.round(F.col("_done") / F.col("_k"), 9).alias("macro_share"),
                    F.round((F.lit(target) * F.col("_k") - F.col("_done")) / others, 9).alias("needed"),
                    F.round((F.col("_all") - F.col("_done")) / others, 9).alias("bound_of_others"))
            .withColumn("enough", F.col("bound_of_others") >= F.col("needed")))


def memorisation_predictions(df: DataFrame, features: list[str], label: str, fold: str) -> DataFrame:
    """Held-out counts with the memorising prediction per fold.

    Output ``fold, y, n, hit, pred, conceded``: ``hit`` whether the held-out
    vector occurs in the training folds, ``pred`` its training-majority label
    or else the training fold's majority class, ``conceded`` = pred when hit,
    else the true label (B5)."""
    cf = materialize(df.groupBy(F.col(fold).alias("fold"), *features, F.col(label).alias("y"))
                     .agg(F.count(F.lit(1)).alias("n_f")))
    tot = cf.groupBy(*features, "y").agg(F.sum("n_f").alias("n_all"))
    # NULL features are values like any other: every vector join is null-safe
    held = cf.select("fold", *features).distinct()
    both = join_null_safe(held, tot, features)
    train = (join_null_safe(both, cf.select("fold", *features, "y", "n_f"), ["fold", *features, "y"], "left")
             .withColumn("n_tr", F.col("n_all") - F.coalesce(F.col("n_f"), F.lit(0))))
    maj = _majority(train, ["fold", *features], "y", "n_tr").withColumn("hit", F.lit(True))
    cls = cf.groupBy("fold", "y").agg(F.sum("n_f").alias("n_fc"))
    cls_tot = cls.groupBy("y").agg(F.sum("n_fc").alias("n_c"))
    fb = _majority(join_null_safe(cls, cls_tot, ["y"]).withColumn("n_tr", F.col("n_c") - F.col("n_fc")),
                   ["fold"], "y", "n_tr").withColumnRenamed("majority", "fallback")
    out = (join_null_safe(cf, maj, ["fold", *features], "left").join(F.broadcast(fb), "fold", "left")
           .select("fold", "y", F.col("n_f").alias("n"), F.coalesce("hit", F.lit(False)).alias("hit"),
                   F.when(F.col("hit"), F.col("majority")).otherwise(F.col("fallback")).alias("pred")))
    return out.withColumn("conceded", F.when(F.col("hit"), F.col("pred")).otherwise(F.col("y")))


def cv_bounds_per_class(pred: DataFrame, classes: list) -> DataFrame:
    """B4/B5 per class: per-class F1 averaged over folds (absent classes count 0)."""
    def per(col):
        conf = pred.groupBy("fold", "y", F.col(col).alias("pred")).agg(F.sum("n").alias("n"))
        pc = metrics.per_class(conf, ["fold"]).select("fold", "cls", "f1")
        return pc
    folds = pred.select("fold").distinct()
    grid = folds.select("fold", F.explode(F.array(*[F.lit(c) for c in classes])).alias("cls"))
    mem = per("pred").withColumnRenamed("f1", "mem")
    con = per("conceded").withColumnRenamed("f1", "con")
    g = grid.join(mem, ["fold", "cls"], "left").join(con, ["fold", "cls"], "left")
    return g.groupBy("cls").agg(F.round(F.avg(F.coalesce("mem", F.lit(0.0))), 6).alias("f1_memorisation_cv"),
                                F.round(F.avg(F.coalesce("con", F.lit(0.0))), 6).alias("f1_conceded_cv"))


def matched_fraction(pred: DataFrame) -> DataFrame:
    """Share of held-out rows whose vector was seen in training, averaged over folds."""
    per_fold = pred.groupBy("fold").agg((F.sum(F.when(F.col("hit"), F.col("n")).otherwise(0)) / F.sum("n")).alias("m"))
    return per_fold.agg(F.round(F.avg("m"), 6).alias("matched_fraction"),
                        F.count(F.lit(1)).cast("bigint").alias("n_folds"))


def cv_bounds_summary(pred: DataFrame, classes: list) -> DataFrame:
    """B4-B6 summary: macro memorisation and conceded F1 and the matched fraction."""
    pc = cv_bounds_per_class(pred, classes)
    m = pc.agg(F.round(F.avg("f1_memorisation_cv"), 6).alias("macro_f1_memorisation_cv"),
               F.round(F.avg("f1_conceded_cv"), 6).alias("macro_f1_conceded_cv"))
    from ..plans.sizing import join_single_rows
    return join_single_rows(m, matched_fraction(pred))


def reweighted_resubstitution(df: DataFrame, features: list[str], label: str, classes: list,
                              rounds: int = 8, tol: float = 1e-12):
    """B2: coordinate ascent on per-class multipliers over vector count arrays.

    Returns ``(weights DataFrame (cls, w), best macro F1)``; uses the same
    flip-index machinery as the decision-multiplier fit."""
    from . import rules
    vl = df.groupBy(*features, F.col(label).alias("y")).agg(F.count(F.lit(1)).alias("n"))
    cls = F.array(*[F.lit(c) for c in classes])
    vec = vl.groupBy(*features).agg(F.map_from_entries(F.collect_list(F.struct("y", "n"))).alias("_m"))
    vec = vec.select(*features, F.transform(cls, lambda c: F.coalesce(F.col("_m")[c], F.lit(0)).cast("double")).alias("p"))
    rows = join_null_safe(vl, vec, features).select(F.lit(0).alias("fold"), "y", "p", "n")
    grid = rules.default_grid(0.05, 1.0, 20, 1.1, 40.0, 120)
    return rules.fit_multipliers(rows, classes, grid=grid, rounds=rounds, tol=tol, weight_col="n")
