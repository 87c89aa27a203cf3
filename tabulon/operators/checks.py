"""Claim checks against recomputed facts (V1-V8).

A claim is ``(name, claimed, tol)``: numeric claims pass within ``tol``,
others by string equality. Facts are ``(name, value)`` strings produced by
Spark from the tables, so a claim check is one join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def compare(claims: DataFrame, facts: DataFrame) -> DataFrame:
    """V1: ``name, claimed, computed, ok`` per claim (missing fact = not ok)."""
    j = claims.join(facts.select("name", F.col("value").alias("computed")), "name", "left")
    a, b = F.col("claimed").cast("string"), F.col("computed").cast("string")
    num = a.try_cast("double").isNotNull() & b.try_cast("double").isNotNull()
    ok = F.when(b.isNull(), F.lit(False)).when(
        num, F.abs(a.try_cast("double") - b.try_cast("double")) <= F.col("tol")).otherwise(a == b)
    return j.select("name", a.alias("claimed"), b.alias("computed"), ok.alias("ok"))


def pass_count(checked: DataFrame) -> DataFrame:
    """V1: number of claims that hold, out of all."""
    return checked.agg(F.count_if("ok").cast("bigint").alias("passed"), F.count(F.lit(1)).cast("bigint").alias("claims"))


def summary_matches_folds(summary: DataFrame, folds: DataFrame, by: list[str], metric: str,
                          tol: float = 1e-9) -> DataFrame:
    """V2: stored summary means equal the fold means within ``tol``."""
    m = folds.groupBy(*by).agg(F.avg(metric).alias("_m"))
    j = summary.join(m, by, "inner")
    return j.agg(F.bool_and(F.abs(F.col(f"{metric}_mean") - F.col("_m")) <= tol).alias("consistent"),
                 F.count(F.lit(1)).cast("bigint").alias("groups"))


def bound_order(values: DataFrame, order: list[str]) -> DataFrame:
    """V5: the named one-row columns are non-decreasing in the given order."""
    cond = F.lit(True)
    for a, b in zip(order, order[1:]):
        cond = cond & (F.col(a) <= F.col(b))
    return values.select(*order, cond.alias("ordered"))


def macro_f1_difference(conf: DataFrame, group: str, fold: str, a: str, b: str, digits: int = 6) -> DataFrame:
    """V4: difference, percent change and ratio of mean macro F1 between the groups
    ``a`` and ``b``, taken from confusion counts (group, fold, y, pred, n) with
    2 TP / (2 TP + FP + FN) alone, so that it shares no step with the metric
    tables and reports that it is compared with."""
    conf.select(group, fold, "y", "pred", "n").createOrReplaceTempView("_derived_counts")
    return conf.sparkSession.sql(f"""
        WITH classes AS (
          SELECT `{group}` AS g, `{fold}` AS f, c.class, c.hit, c.miss, n FROM _derived_counts
          LATERAL VIEW inline(if(y = pred, array(struct(y AS class, 2 AS hit, 0 AS miss)),
                                 array(struct(y AS class, 0 AS hit, 1 AS miss), struct(pred AS class, 0 AS hit, 1 AS miss)))) c AS class, hit, miss),
        f1 AS (SELECT g, f, class, sum(hit * n) / sum((hit + miss) * n) AS f1 FROM classes GROUP BY g, f, class),
        folds AS (SELECT g, f, round(avg(f1), {digits}) AS f1 FROM f1 GROUP BY g, f),
        means AS (SELECT round(avg(f1) FILTER (WHERE g = '{a}'), {digits}) AS a, round(avg(f1) FILTER (WHERE g = '{b}'), {digits}) AS b FROM folds)
        SELECT round(a - b, {digits}) AS difference, round(100 * (a - b) / b, {digits}) AS percent_change, round(a / b, {digits}) AS ratio FROM means""")


def derived_numbers(stored: DataFrame, recomputed: DataFrame, by: list[str], values: list[str], tol: float = 1e-9) -> DataFrame:
    """V4: stored derived numbers against recomputed ones: one row per group and
    value, ``ok`` where both are present and equal within ``tol`` (or both absent)."""
    long = lambda df, name: df.select(*by, F.explode(F.array(*[F.struct(F.lit(v).alias("name"), F.col(v).cast("double").alias(name))
                                                               for v in values])).alias("_e")).select(*by, "_e.*")
    j = long(stored, "stored").join(long(recomputed, "computed"), [*by, "name"], "full")
    near = F.abs(F.col("stored") - F.col("computed")) <= tol
    return j.select(*by, "name", F.coalesce(near, F.col("stored").isNull() & F.col("computed").isNull()).alias("ok"))
