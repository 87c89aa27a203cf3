"""Report and chart tables as DataFrames.

Each is a projection, join, pivot or top-n over result tables; nothing is
rendered. Pivots name their columns explicitly so the plan is static.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import fmt_mean_sd


def class_distribution(balance: DataFrame) -> DataFrame:
    """Classes by descending count, then a total row (ord = K)."""
    ranked = balance.withColumn("ord", F.row_number().over(Window.orderBy(F.desc("count"), "code")) - 1)
    total = balance.agg(F.lit("total").alias("class"), F.lit(None).cast("int").alias("code"),
                        F.sum("count").cast("bigint").alias("count"), F.round(F.sum("percent"), 3).alias("percent"),
                        F.count(F.lit(1)).alias("ord"))
    return ranked.select("class", "code", "count", "percent", F.col("ord").cast("int").alias("ord")) \
        .unionByName(total.withColumn("ord", F.col("ord").cast("int")))


def top_pairs(corr: DataFrame, n: int = 8) -> DataFrame:
    """The n strongest pairs (ties by name)."""
    return corr.filter(F.col("abs_r").isNotNull()).orderBy(F.desc("abs_r"), "feature_a", "feature_b").limit(n)


def most_skewed(prof: DataFrame, n: int = 8) -> DataFrame:
    """The n most skewed numeric features; missing outlier share shown as '--'."""
    p = prof.filter((F.col("kind") == "numeric") & F.col("skewness").isNotNull())
    return p.orderBy(F.desc("skewness"), "feature").limit(n).select(
        "feature", "minimum", "maximum", "skewness",
        F.coalesce(F.format_string("%.2f", "pct_outlier"), F.lit("--")).alias("pct_outlier"))


def metric_by_configuration(summary: DataFrame, configurations: list[str], metrics: list[str]) -> DataFrame:
    """Metric rows x configuration columns of the fold means (unpivot, then pivot)."""
    long = summary.select("configuration", F.explode(F.array(*[
        F.struct(F.lit(m).alias("metric"), F.col(f"{m}_mean").alias("v")) for m in metrics])).alias("_e")) \
        .select("configuration", "_e.metric", "_e.v")
    return long.groupBy("metric").pivot("configuration", configurations).agg(F.first("v"))


def per_class_by_configuration(per_class: DataFrame, configurations: list[str]) -> DataFrame:
    """Mean per-class recall by configuration with the class size."""
    m = per_class.groupBy("cls", "configuration").agg(F.round(F.avg("recall"), 6).alias("recall"),
                                                      F.sum("support").alias("n"))
    size = m.groupBy("cls").agg(F.max("n").cast("bigint").alias("n"))
    return m.groupBy("cls").pivot("configuration", configurations).agg(F.first("recall")).join(size, "cls")


def class_leads(per_class: DataFrame, a: str, b: str, tol: float = 0.005) -> DataFrame:
    """The classes in which configuration ``a`` or ``b`` has the higher
    recall (a tie within ``tol``), largest class first, with their number, share of
    all rows and the widest gap. ``per_class`` is `per_class_by_configuration`."""
    gap = F.round(F.col(a) - F.col(b), 6)
    side = F.when(gap > tol, F.lit(a)).when(gap < -tol, F.lit(b)).otherwise(F.lit("tie"))
    by_size = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("_n"), "cls")))
    g = (per_class.withColumn("lead", side).withColumn("gap", gap).groupBy("lead")
         .agg(F.count(F.lit(1)).cast("bigint").alias("classes"), F.sum("n").cast("bigint").alias("n"), by_size.alias("_m"),
              F.max(F.abs("gap")).alias("widest_gap")))
    return g.select("lead", "classes", F.array_join(F.transform("_m", lambda x: x["cls"].cast("string")), ",").alias("members"),
                    F.round(100.0 * F.col("n") / F.sum("n").over(Window.partitionBy()), 1).alias("percent"), "widest_gap")


def bounds_by_class(resub: DataFrame, cv: DataFrame) -> DataFrame:
    """Bounds per class plus a macro-mean row."""
    j = resub.select("cls", "f1_resubstitution").join(cv, "cls", "inner")
    cols = ["f1_memorisation_cv", "f1_conceded_cv", "f1_resubstitution"]
    mean = j.agg(*[F.round(F.avg(c), 6).alias(c) for c in cols]).withColumn("cls", F.lit("macro mean"))
    return j.select(F.col("cls").cast("string").alias("cls"), *cols).unionByName(mean.select("cls", *cols))


def per_fold_table(folds: DataFrame, configurations: list[str], metric: str) -> DataFrame:
    """Fold x configuration with mean and SD rows appended."""
    wide = folds.groupBy(F.col("fold").cast("string").alias("fold")).pivot("configuration", configurations) \
        .agg(F.first(metric))
    mean = folds.groupBy().pivot("configuration", configurations).agg(F.round(F.avg(metric), 6)) \
        .withColumn("fold", F.lit("mean"))
    sd = folds.groupBy().pivot("configuration", configurations).agg(F.round(F.stddev_samp(metric), 6)) \
        .withColumn("fold", F.lit("sd"))
    return wide.unionByName(mean).unionByName(sd)


def labelled_cells(norm_conf: DataFrame, threshold: float = 0.01) -> DataFrame:
    """Row-normalised confusion cells with a label flag for cells >= threshold."""
    return norm_conf.withColumn("labelled", F.col("share") >= threshold)


def summary_cells(summary: DataFrame, metrics: list[str], digits: int = 4) -> DataFrame:
    """``mean ± sd`` text cells per configuration and metric."""
    return summary.select("configuration", *[fmt_mean_sd(F.col(f"{m}_mean"), F.col(f"{m}_std"), digits).alias(m)
                                              for m in metrics])


def difference_rows(table: DataFrame, key: str, a: str, b: str, value: str) -> DataFrame:
    """Difference, percent change and ratio between two named rows."""
    g = table.agg(F.max(F.when(F.col(key) == a, F.col(value))).alias("a"),
                  F.max(F.when(F.col(key) == b, F.col(value))).alias("b"))
    return g.select(F.round(F.col("a") - F.col("b"), 6).alias("difference"),
                    F.round(100.0 * (F.col("a") - F.col("b")) / F.col("b"), 6).alias("percent_change"),
                    F.round(F.col("a") / F.col("b"), 6).alias("ratio"))


def grid_completeness(grid: DataFrame, axes: list[str]) -> DataFrame:
    """A grid is complete when its rows equal the product of distinct axis values."""
    row = grid.agg(F.count(F.lit(1)).alias("rows"), *[F.count_distinct(a).alias(f"n_{a}") for a in axes])
    prod = F.lit(1)
    for a in axes:
        prod = prod * F.col(f"n_{a}")
    return row.withColumn("expected", prod).withColumn("complete", F.col("rows") == F.col("expected"))


def quality_facts(prof: DataFrame, outlier_threshold: float = 10.0) -> DataFrame:
    """R2: widest and narrowest non-zero range, their ratio as mantissa and
    exponent, the most skewed feature, the worst outlier share, and how many
    features reach the outlier threshold: ``(fact, feature, value)``."""
    p = prof.filter((F.col("kind") == "numeric") & F.col("rng").isNotNull())
    g = p.agg(F.max(F.struct("rng", "feature")).alias("w"),
              F.min(F.when(F.col("rng") > 0, F.struct("rng", "feature"))).alias("n"),
              F.max(F.when(F.col("skewness").isNotNull(), F.struct("skewness", "feature"))).alias("s"),
              F.max(F.when(F.col("pct_outlier").isNotNull(), F.struct("pct_outlier", "feature"))).alias("o"),
              F.count_if(F.col("pct_outlier") >= outlier_threshold).alias("k"))
    ratio = F.col("w.rng") / F.col("n.rng")
    e = F.floor(F.log10(ratio))
    def fact(name, feature, value):
        return F.struct(F.lit(name).alias("fact"), feature.cast("string").alias("feature"),
                        value.cast("double").alias("value"))
    none = F.lit(None)
    return g.select(F.inline(F.array(
        fact("widest_range", F.col("w.feature"), F.col("w.rng")),
        fact("narrowest_range", F.col("n.feature"), F.col("n.rng")),
        fact("range_ratio_mantissa", none, F.round(ratio / F.pow(F.lit(10.0), e), 6)),
        fact("range_ratio_exponent", none, e),
        fact("most_skewed", F.col("s.feature"), F.col("s.skewness")),
        fact("worst_outlier_share", F.col("o.feature"), F.col("o.pct_outlier")),
        fact("features_over_outlier_threshold", none, F.col("k")),
    )))


def metric_means_long(summary: DataFrame, metrics: list[str]) -> DataFrame:
    """Metric means and SDs by configuration, long form."""
    return summary.select("configuration", F.explode(F.array(*[
        F.struct(F.lit(m).alias("metric"), F.col(f"{m}_mean").alias("mean"), F.col(f"{m}_std").alias("sd"))
        for m in metrics])).alias("_e")).select("configuration", "_e.metric", "_e.mean", "_e.sd")


def ablation_table(abl: DataFrame, order: list[str], score: str = "bal_mean") -> DataFrame:
    """Variants in the given order with the change against the first row."""
    o = F.array_position(F.array(*[F.lit(v) for v in order]), F.col("variant"))
    w = Window.orderBy("ord")
    t = abl.withColumn("ord", o)
    return t.select("ord", "variant", fmt_mean_sd(F.col("bal_mean"), F.col("bal_std")).alias("balanced_accuracy"),
                    F.round(F.col(score) - F.first(score).over(w), 6).alias("change"), "f1_mean")


def exponent_sweep(sweep: DataFrame) -> DataFrame:
    """Best macro F1 per alpha, the best alpha and its gain over alpha 0 and 1."""
    b = sweep.agg(F.max(F.struct("f1_mean", "alpha")).alias("b"),
                  F.max(F.when(F.col("alpha") == 0.0, F.col("f1_mean"))).alias("f0"),
                  F.max(F.when(F.col("alpha") == 1.0, F.col("f1_mean"))).alias("f1"))
    return b.select(F.col("b.alpha").alias("best_alpha"), F.col("b.f1_mean").alias("best_f1"),
                    F.round(F.col("b.f1_mean") - F.col("f0"), 6).alias("gain_over_alpha_0"),
                    F.round(F.col("b.f1_mean") - F.col("f1"), 6).alias("gain_over_alpha_1"))


def multipliers_by_class(weights: DataFrame, class_counts: DataFrame, configurations: list[str]) -> DataFrame:
    """Multipliers by class x configuration, classes in descending frequency."""
    piv = weights.groupBy("cls").pivot("configuration", configurations).agg(F.first("w"))
    return piv.join(class_counts, "cls").orderBy(F.desc("n"), "cls")


def score_by_depth(grid: DataFrame, unbounded_as: int = 40) -> DataFrame:
    """Score by depth, unbounded depth drawn at ``unbounded_as``, one series per weighting."""
    return grid.select(F.coalesce(F.col("max_depth"), F.lit(unbounded_as)).alias("depth"),
                       F.concat(F.lit("alpha="), F.col("alpha").cast("string")).alias("series"), "f1_mean", "f1_std")


def joined_results(folds: DataFrame, pooled: DataFrame, supplement: DataFrame) -> DataFrame:
    """Fold aggregates with pooled and supplementary results; NULL where a
    configuration has none."""
    s = folds.groupBy("configuration").agg(F.round(F.avg("f1_macro"), 6).alias("f1_macro"), F.count(F.lit(1)).cast("bigint").alias("n_folds"))
    return s.join(pooled, "configuration", "left").join(supplement, "configuration", "left")


def pairwise_projection(pairwise: DataFrame) -> DataFrame:
    """``comparison, difference, p, holm_p, significant`` with readable names."""
    name = lambda c: F.initcap(F.replace(F.col(c), F.lit("_"), F.lit(" ")))
    return pairwise.select(F.array_join(F.array(name("group_a"), name("group_b")), " vs ").alias("comparison"),
                           F.col("mean_difference").alias("difference"), F.col("wilcoxon_p").alias("p"), "holm_p", "significant")


def split_comparison(c) -> list:
    """the two sides of a ``'a vs b'`` name."""
    parts = F.split(c, " vs ")
    return [parts[0], parts[1]]


def corrections(duplicates: DataFrame, correlations: DataFrame) -> DataFrame:
    """Correction facts ``(name, value)``: unresolvable records, their
    share, duplicate share, pairs at each correlation threshold and how far the
    largest |r| is from 1 (the invariance residual)."""
    from .sizing import join_single_rows
    row = join_single_rows(duplicates, correlations)
    names = ["unresolvable", "unresolvable_percent", "duplicate_percent", "n_090", "n_095", "n_099"]
    facts = [F.struct(F.lit(n).alias("name"), F.col(n).cast("double").alias("value")) for n in names]
    facts.append(F.struct(F.lit("invariance_residual").alias("name"), F.round(1.0 - F.col("max_abs_r"), 6).alias("value")))
    return row.select(F.inline(F.array(*facts)))


def gain_over(table: DataFrame, key: str, base: str, value: str) -> DataFrame:
    """Every row's gain over the named row, absolute and in percent."""
    b = table.filter(F.col(key) == base).select(F.col(value).alias("_b"))     # one row
    return (table.join(F.broadcast(b)).select(key, value, F.round(F.col(value) - F.col("_b"), 6).alias("gain"),
            F.round(100.0 * F.try_divide(F.col(value) - F.col("_b"), F.col("_b")), 6).alias("gain_percent")))


def tree_search_slice(grid: DataFrame) -> DataFrame:
    """Best score of weighted and unweighted trees, and of each depth, with
    unbounded depth last: ``slice, setting, f1_mean, bal_mean``."""
    weighted = F.when(F.col("alpha") > 0, F.lit("weighted")).otherwise(F.lit("unweighted"))
    best = [F.max("f1_mean").alias("f1_mean"), F.max("bal_mean").alias("bal_mean")]
    a = grid.groupBy(weighted.alias("setting")).agg(*best).select(F.lit("weighting").alias("slice"), "setting", F.lit(None).cast("int").alias("_d"), "f1_mean", "bal_mean")
    b = grid.groupBy("max_depth").agg(*best).select(F.lit("depth").alias("slice"), F.coalesce(F.col("max_depth").cast("string"), F.lit("unbounded")).alias("setting"),
                                                    F.col("max_depth").alias("_d"), "f1_mean", "bal_mean")
    return a.unionByName(b).orderBy("slice", F.asc_nulls_last("_d"), "setting").drop("_d")
