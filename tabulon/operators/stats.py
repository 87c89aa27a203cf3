"""Paired statistics over a (block, group, value) table.

Blocks are folds, groups are configurations. All windows are partitioned by
block or by group pair, whose size is the number of groups or folds.

Exact Wilcoxon p-values use the subset-sum distribution of the doubled
(average-tie) ranks, built with a Spark higher-order ``aggregate``: start
from [1] and for each rank r add the array shifted by r. The share of the
2^n sign patterns with W+ <= W gives p = min(1, 2 * share). No pattern table
is enumerated. The normal approximation with tie correction is a documented
choice of the caller, never a switch on size.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


# ----------------------------------------------------------------- p-value helpers
def _chi2_sf_np(x: float, df: float) -> float:
    """Chi-square survival function for integer df (closed forms via erfc)."""
    if x is None or df is None or np.isnan(x):
        return float("nan")
    if x <= 0:
        return 1.0
    k = int(round(df))
    h = x / 2.0
    if k % 2 == 0:
        term, s = 1.0, 1.0
        for i in range(1, k // 2):
            term *= h / i
            s += term
        return float(min(1.0, math.exp(-h) * s))
    s = math.erfc(math.sqrt(h))
    term = math.sqrt(h) * math.exp(-h) / math.gamma(1.5)
    for i in range(1, (k - 1) // 2 + 1):
        s += term
        term *= h / (i + 0.5)
    return float(min(1.0, s))


@F.pandas_udf(T.DoubleType())
def chi2_sf(x: pd.Series, df: pd.Series) -> pd.Series:
    """P(X > x) for X ~ chi-square(df); vectorised over Arrow batches."""
    return pd.Series([_chi2_sf_np(a, b) for a, b in zip(x, df)], dtype="float64")


def _t_two_sided(t: float, df: float) -> float:
    """Two-sided p of Student's t for a whole number of degrees of freedom: the
    distribution is then a finite sum of powers of cos(atan(t / sqrt(df)))."""
    if t is None or df is None or np.isnan(t) or df <= 0:
        return float("nan")
    n = int(round(df))
    odd = n % 2
    angle = math.atan(abs(t) / math.sqrt(n))
    steps = np.arange(1, n // 2)
    ratios = (2 * steps - 1 + odd) / (2 * steps + odd) * math.cos(angle) ** 2
    terms = np.cumprod(np.r_[math.cos(angle) if odd else 1.0, ratios])[:n // 2]
    inside = math.sin(angle) * math.fsum(terms)
    return float(min(1.0, max(0.0, 1.0 - (2 / math.pi * (angle + inside) if odd else inside))))


@F.pandas_udf(T.DoubleType())
def t_two_sided_p(t: pd.Series, df: pd.Series) -> pd.Series:
    """Two-sided p of Student's t."""
    return pd.Series([_t_two_sided(a, b) for a, b in zip(t, df)], dtype="float64")


# ----------------------------------------------------------------- building blocks
def fold_table(df: DataFrame, block: str, group: str, value: str, digits: int = 6) -> DataFrame:
    """T6 input: one metric per (block, group): the mean of ``value``."""
    return df.groupBy(F.col(block).alias("block"), F.col(group).cast("string").alias("grp")) \
        .agg(F.round(F.avg(value), digits).alias("metric"))


def average_rank(order_desc: bool, part: list[str], col: str):
    """1-based rank with ties averaged (ascending unless ``order_desc``)."""
    o = F.desc(col) if order_desc else F.asc(col)
    w = Window.partitionBy(*part).orderBy(o)
    ties = Window.partitionBy(*part, col)
    return F.rank().over(w) + (F.count(F.lit(1)).over(ties) - 1) / 2.0


def friedman(tab: DataFrame) -> DataFrame:
    """Tie-corrected Friedman statistic over blocks x groups, chi-square p."""
    r = tab.withColumn("r", average_rank(False, ["block"], "metric"))
    ties = r.groupBy("block", "metric").agg(F.count(F.lit(1)).alias("t")) \
        .agg(F.sum(F.pow("t", 3) - F.col("t")).alias("tie"))
    rs = r.groupBy("grp").agg(F.sum("r").alias("R"))
    g = rs.agg(F.sum(F.col("R") * F.col("R")).alias("ssr"), F.count(F.lit(1)).alias("k"))
    nb = tab.agg(F.count_distinct("block").alias("n"))
    from ..plans.sizing import join_single_rows
    x = join_single_rows(g, nb, ties)
    n, k = F.col("n").cast("double"), F.col("k").cast("double")
    # with every block tied there is no ranking: NULL
    stat = F.try_divide(F.try_divide(12.0 * F.col("ssr"), n * k * (k + 1)) - 3.0 * n * (k + 1),
                        1.0 - F.try_divide(F.col("tie"), n * k * (k * k - 1)))
    out = x.select(stat.alias("_s"), F.col("k").cast("int").alias("n_groups"), F.col("n").cast("int").alias("n_folds"))
    p = F.when(F.col("_s").isNotNull(), chi2_sf(F.col("_s"), (F.col("n_groups") - 1).cast("double")))
    return out.select(F.round("_s", 6).alias("statistic"), "n_groups", "n_folds", F.round(p, 9).alias("p_value"))


def pair_differences(tab: DataFrame) -> DataFrame:
    """Every unordered pair of groups (a < b) with per-block differences a - b."""
    a = tab.select("block", F.col("grp").alias("group_a"), F.col("metric").alias("a"))
    b = tab.select("block", F.col("grp").alias("group_b"), F.col("metric").alias("b"))
    return a.join(b, "block").filter(F.col("group_a") < F.col("group_b")) \
        .withColumn("d", F.col("a") - F.col("b"))


def _signed_rank_p(doubled_ranks, w2: int) -> float:
    """Two-sided exact p of a signed-rank statistic (doubled, at most half the
    sum of the doubled ranks).

    Each rank counts for or against with probability 1/2, so the probabilities
    of the sums up to ``w2`` are halved and shifted rank by rank; they stay
    probabilities at every length, with a relative error of n 2^-53 at most."""
    p = np.zeros(w2 + 1)
    p[0] = 1.0
    for r in sorted(int(x) for x in doubled_ranks):
        half = 0.5 * p
        p = half.copy()
        if r <= w2:
            p[r:] += half[:w2 + 1 - r]
    return float(min(1.0, 2.0 * math.fsum(p)))


@F.pandas_udf(T.DoubleType())
def signed_rank_p(doubled_ranks: pd.Series, w2: pd.Series) -> pd.Series:
    return pd.Series([_signed_rank_p(r, int(w)) for r, w in zip(doubled_ranks, w2)], dtype="float64")


def wilcoxon_pairs(tab: DataFrame, method: str = "exact") -> DataFrame:
    """Signed-rank test per pair: zeros dropped, W = min(W+, W-).

    method='exact' uses the null distribution, 'normal' the approximation with
    tie correction; neither changes with the number of blocks. A pair without a
    difference has statistic 0 and p 1."""
    if method not in ("exact", "normal"):
        raise ValueError(method)
    every = pair_differences(tab)
    part = ["group_a", "group_b"]
    d = every.filter(F.col("d") != 0)
    r = d.withColumn("ad", F.abs("d")).withColumn("r", average_rank(False, part, "ad"))
    ties = r.groupBy(*part, "ad").agg(F.count(F.lit(1)).alias("t")).groupBy(*part) \
        .agg(F.sum(F.pow("t", 3) - F.col("t")).alias("tie"))
    g = r.groupBy(*part).agg(
        F.sum(F.when(F.col("d") > 0, F.col("r")).otherwise(0.0)).alias("wp"),
        F.sum(F.when(F.col("d") < 0, F.col("r")).otherwise(0.0)).alias("wm"),
        F.count(F.lit(1)).alias("n"),
        F.collect_list((2 * F.col("r")).cast("int")).alias("r2")).join(ties, part)
    w = F.least("wp", "wm")
    n = F.col("n").cast("double")
    if method == "exact":
        p = signed_rank_p(F.col("r2"), (2 * w).cast("bigint"))
    else:
        mu = n * (n + 1) / 4.0
        sd = F.sqrt(n * (n + 1) * (2 * n + 1) / 24.0 - F.col("tie") / 48.0)
        p = chi2_sf(F.pow(F.try_divide(w - mu, sd), 2), F.lit(1.0))
    tested = g.select(*part, F.col("n").cast("int").alias("n"), w.alias("wilcoxon_statistic"), F.round(p, 9).alias("wilcoxon_p"))
    return (every.select(*part).distinct().join(tested, part, "left")
            .select(*part, F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("wilcoxon_statistic", F.lit(0.0)).alias("wilcoxon_statistic"),
                    F.coalesce("wilcoxon_p", F.lit(1.0)).alias("wilcoxon_p")))


def paired_t(tab: DataFrame) -> DataFrame:
    """Mean difference, paired t statistic and its two-sided p per pair."""
    d = pair_differences(tab)
    g = d.groupBy("group_a", "group_b").agg(F.avg("a").alias("mean_a"), F.avg("b").alias("mean_b"),
                                            F.avg("d").alias("md"), F.stddev_samp("d").alias("sd"),
                                            F.count(F.lit(1)).alias("n"))
    t = F.try_divide(F.col("md"), F.col("sd") / F.sqrt("n"))
    return g.select("group_a", "group_b", F.round("mean_a", 6).alias("mean_a"), F.round("mean_b", 6).alias("mean_b"),
                    F.round("md", 6).alias("mean_difference"), F.round(t, 6).alias("paired_t_statistic"),
                    F.when(t.isNotNull(), F.round(t_two_sided_p(t, (F.col("n") - 1).cast("double")), 9)).alias("paired_t_p"),
                    F.col("n").cast("int").alias("n"))


def holm(p_df: DataFrame, p: str, family: list[str] = (), alpha: float = 0.05) -> DataFrame:
    """Holm step-down: running max of (m - i + 1) p_(i), capped at 1."""
    fam = list(family)
    w = Window.partitionBy(*fam).orderBy(F.col(p), *[F.col(c) for c in p_df.columns if c != p])
    m = F.count(F.lit(1)).over(Window.partitionBy(*fam))
    i = F.row_number().over(w)
    out = p_df.withColumn("_s", (m - i + 1) * F.col(p))
    out = out.withColumn("holm_p", F.round(F.least(F.lit(1.0), F.max("_s").over(
        w.rowsBetween(Window.unboundedPreceding, Window.currentRow))), 9)).drop("_s")
    return out.withColumn("significant", F.col("holm_p") < alpha)


def pairwise(tab: DataFrame, alpha: float = 0.05) -> DataFrame:
    """T5: pairwise table: means, difference, Wilcoxon, Holm, paired t and its p."""
    t = paired_t(tab)
    wx = wilcoxon_pairs(tab).drop("n")
    out = t.join(wx, ["group_a", "group_b"], "left")
    return holm(out.fillna({"wilcoxon_p": 1.0}), "wilcoxon_p", alpha=alpha)


def diff_shape(tab: DataFrame) -> DataFrame:
    """T7 (re-aimed): skewness, excess kurtosis (population) and Jarque-Bera of the differences."""
    d = pair_differences(tab)
    g = d.groupBy("group_a", "group_b").agg(F.skewness("d").alias("g1"), F.kurtosis("d").alias("g2"),
                                            F.count(F.lit(1)).alias("n"))
    jb = F.col("n") / 6.0 * (F.pow("g1", 2) + F.pow("g2", 2) / 4.0)
    return g.select("group_a", "group_b", F.round("g1", 6).alias("skewness"), F.round("g2", 6).alias("kurtosis"),
                    F.round(jb, 6).alias("jarque_bera"))


def fold_winners(tab: DataFrame) -> DataFrame:
    """The best group of each block (ties to the lower name) and blocks won per group."""
    rn = F.row_number().over(Window.partitionBy("block").orderBy(F.desc("metric"), F.asc("grp")))
    return tab.withColumn("_rn", rn).filter("_rn = 1").groupBy("grp").agg(
        F.count(F.lit(1)).cast("bigint").alias("folds_won"))


def fold_margins(tab: DataFrame, a: str, b: str) -> DataFrame:
    """Per-block margin a - b between two groups, its min and max."""
    p = tab.groupBy("block").agg(F.max(F.when(F.col("grp") == a, F.col("metric"))).alias("a"),
                                 F.max(F.when(F.col("grp") == b, F.col("metric"))).alias("b"))
    return p.agg(F.round(F.min(F.col("a") - F.col("b")), 6).alias("min_margin"),
                 F.round(F.max(F.col("a") - F.col("b")), 6).alias("max_margin"),
                 F.count_if(F.col("a") > F.col("b")).cast("bigint").alias("blocks_a_ahead"))


def paired_wins(tab: DataFrame) -> DataFrame:
    """For each pair, blocks where a beats b (strict) and the mean gain."""
    d = pair_differences(tab)
    return d.groupBy("group_a", "group_b").agg(F.count_if(F.col("a") > F.col("b")).cast("bigint").alias("wins"),
                                               F.count_if(F.col("a") >= F.col("b")).cast("bigint").alias("wins_or_ties"),
                                               F.round(F.avg("d"), 6).alias("mean_gain"))


def lead_share(items: DataFrame, item: str, weight: str, a: str, b: str, tol: float = 0.005) -> DataFrame:
    """Which side leads each item (tie within ``tol``), count, weight share, item list."""
    side = F.when(F.col(a) - F.col(b) > tol, F.lit("a")).when(F.col(b) - F.col(a) > tol, F.lit("b")).otherwise(F.lit("tie"))
    s = items.withColumn("side", side)
    total = F.sum("w").over(Window.partitionBy())
    g = s.groupBy("side").agg(F.count(F.lit(1)).cast("bigint").alias("items"), F.sum(weight).alias("w"),
                              F.array_join(F.array_sort(F.collect_list(F.col(item).cast("string"))), ",").alias("members"))
    return g.withColumn("share", F.round(F.col("w") / total, 6)).drop("w")


def rank_stability(first: DataFrame, second: DataFrame) -> DataFrame:
    """Descending average ranks of groups in two periods, gain, equality."""
    r1 = first.select("grp", F.col("metric").alias("m1")).withColumn("rank_1", average_rank(True, [], "m1"))
    r2 = second.select("grp", F.col("metric").alias("m2")).withColumn("rank_2", average_rank(True, [], "m2"))
    j = r1.join(r2, "grp", "inner")
    return j.select("grp", F.col("m1").alias("metric_1"), F.col("m2").alias("metric_2"),
                    F.round(F.col("m2") - F.col("m1"), 6).alias("gain"), "rank_1", "rank_2",
                    (F.col("rank_1") == F.col("rank_2")).alias("same_rank"))


def stepwise_gain(steps: DataFrame, order: str, value: str) -> DataFrame:
    """Gain over the previous step, the first step 0."""
    w = Window.orderBy(order)
    return steps.withColumn("gain", F.round(F.coalesce(F.col(value) - F.lag(value).over(w), F.lit(0.0)), 6))
