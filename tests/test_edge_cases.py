"""NULLs, ties, one-member classes, empty pairs and large counts."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabulon import sources
from tabulon.operators import audit, bounds, features, metrics, rules, sampling, stats, trees
from tabulon.plans.sizing import bounded_broadcast, global_rank


def test_correlation_uses_pairwise_complete_rows_at_every_width(spark):
    rng = np.random.default_rng(1)
    x = pd.DataFrame(rng.normal(size=(60, 5)), columns=list("abcde"))
    x["b"] += x["a"]
    x = x.mask(rng.random(x.shape) < 0.2)
    df = spark.createDataFrame([tuple(None if math.isnan(v) else float(v) for v in r) for r in x.values], "a double, b double, c double, d double, e double")
    for width in (3, 1000):
        got = {(r[0], r[1]): r[2] for r in audit.correlations(df, list("abcde"), pairs_per_scan=width).collect()}
        want = x.corr().abs()
        assert len(got) == 10 and all(abs(got[a, b] - want.loc[a, b]) < 1e-6 for a, b in got)
    assert abs(audit.named_correlation(df, "a", "b").first()["r"] - x["a"].corr(x["b"])) < 1e-6


def test_adjacent_rows_do_not_depend_on_exchange_reuse(spark):
    df = spark.range(20_000).select(F.col("id"), F.when(F.col("id") % 7 == 0, F.lit(None)).otherwise(F.col("id") % 3).alias("y"))
    want = sum((None if i % 7 == 0 else i % 3) == (None if (i - 1) % 7 == 0 else (i - 1) % 3) for i in range(1, 20_000))
    for reuse in ("true", "false"):
        spark.conf.set("spark.sql.exchange.reuse", reuse)
        try:
            r = audit.adjacent_agreement(df, "id", "y").first()
            assert (r["n_pairs"], r["agree"]) == (19_999, want)
            assert audit.monotonic_check(df, "id", "id").first()["violations"] == 0
        finally:
            spark.conf.unset("spark.sql.exchange.reuse")


def test_wilcoxon_keeps_pairs_without_a_difference(spark):
    tab = spark.createDataFrame([(b, g, v) for b in range(6) for g, v in (("a", 0.5), ("b", 0.5), ("c", 0.5 + 0.01 * (b + 1)))],
                                "block int, grp string, metric double")
    got = {(r[0], r[1]): (r["n"], r["wilcoxon_statistic"], r["wilcoxon_p"]) for r in stats.wilcoxon_pairs(tab).collect()}
    assert got["a", "b"] == (0, 0.0, 1.0) and got["a", "c"] == (6, 0.0, 0.03125)
    assert stats.holm(stats.wilcoxon_pairs(tab).select("group_a", "group_b", "wilcoxon_p"), "wilcoxon_p").count() == 3
    assert 0.02 < {(r[0], r[1]): r["wilcoxon_p"] for r in stats.wilcoxon_pairs(tab, "normal").collect()}["a", "c"] < 0.04


def test_friedman_of_tied_blocks_is_null(spark):
    tab = spark.createDataFrame([(b, g, 0.5) for b in range(4) for g in "abc"], "block int, grp string, metric double")
    r = stats.friedman(tab).first()
    assert r["statistic"] is None and r["p_value"] is None


def test_smote_of_a_one_member_class_repeats_it(spark):
    rows = [(i, 0, [float(i), 1.0]) for i in range(40)] + [(100, 1, [5.0, 6.0])]
    out = sampling.smote(spark.createDataFrame(rows, "id bigint, y int, x array<double>"), "id", "y", "x", cap=0.25).collect()
    assert len(out) == 9 and all(r["neighbor"] == 100 and list(r["x"]) == [5.0, 6.0] for r in out)


def test_null_vectors_match_and_unknown_labels_raise(spark):
    df = spark.createDataFrame([(None, 1, "x", f) for f in (0, 1)] + [(2, 2, "y", f) for f in (0, 1)], "a int, b int, y string, fold int")
    pred = bounds.memorisation_predictions(df, ["a", "b"], "y", "fold")
    assert bounds.matched_fraction(pred).first()["matched_fraction"] == 1.0
    with pytest.raises(ValueError):
        rules.fit_multipliers(spark.createDataFrame([(0, 7, [0.5, 0.5])], "fold int, y int, p array<double>"), [0, 1])


def test_scores_of_very_large_counts(spark):
    conf = spark.createDataFrame([(0, 0, 4 * 10 ** 9), (0, 1, 10 ** 9), (1, 1, 4 * 10 ** 9)], "y int, pred int, n bigint")
    assert abs(metrics.scores(conf, []).first()["accuracy"] - 8 / 9) < 1e-6


def test_tree_depth_bounds(spark):
    df = spark.createDataFrame([(i, float(i), i % 2) for i in range(20)], "id int, x double, y int")
    f = features.tree_features(df, df, ["x"], [])
    assert len({tuple(r["p"]) for r in trees.tree_probabilities(f, f, "id", "features", "y", [0, 1], max_depth=0).collect()}) == 1
    with pytest.raises(ValueError):
        trees.tree_probabilities(f, f, "id", "features", "y", [0, 1], max_depth=31)


def test_ranks_and_codes_without_one_task_per_feature(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("v"), F.when(F.col("id") % 5 > 0, F.concat(F.lit("l"), F.col("id") % 37)).alias("s"))
    got = global_rank(df, ["v"], "r").collect()
    assert sorted((r["v"], r["r"]) for r in got) == [(i, i) for i in range(1000)]
    codes = [r["level"] for r in features.fit_ordinal(df, ["s", "v"]).filter("feature = 's'").orderBy("code").collect()]
    assert codes[0] is None and codes[1:] == sorted(codes[1:]) and len(codes) == 38
    kept = features.fit_rare_levels(df, ["s"], 0.1)
    assert kept == {"s": [None]} or kept["s"][0] is None


def test_scalers_by_fold_equal_a_fit_on_the_other_folds(spark):
    rng = np.random.default_rng(5)
    df = spark.createDataFrame([(i % 4, float(rng.integers(0, 30)), float(rng.exponential()) if i % 9 else None) for i in range(300)],
                               "fold int, a double, b double").persist()
    for kind in ("minmax", "log", "zscore", "robust", "rank"):
        every = features.fit_scaler_by_fold(df, ["a", "b"], kind, "fold", n_quantiles=20)
        for f, p in every.items():
            one = features.fit_scaler(df.filter(F.col("fold") != f), ["a", "b"], kind, n_quantiles=20)
            for c in ("a", "b"):
                assert np.allclose(np.concatenate([np.atleast_1d(v) for v in p.values[c]]), np.concatenate([np.atleast_1d(v) for v in one.values[c]]))


def test_stored_parameters_are_bound_to_settings_and_errors_are_raised(spark, tmp_path):
    path = f"{tmp_path}/p"
    assert sources.reuse_or_compute(spark, path, lambda: spark.range(3), "k=5").count() == 3
    assert sources.reuse_or_compute(spark, path, lambda: spark.range(9), "k=5").count() == 3
    assert sources.reuse_or_compute(spark, path, lambda: spark.range(9), "k=7").count() == 9
    broken = tmp_path / "b"
    broken.mkdir()
    (broken / "part-0.parquet").write_bytes(b"not parquet")
    with pytest.raises(Exception):
        sources.count_tables(spark, {"b": str(broken)}, {}).collect()


def test_broadcast_is_bounded_by_bytes(spark):
    df = spark.createDataFrame([("x" * 1000,)] * 10, "s string")
    hinted = lambda d: "broadcast" in d._jdf.queryExecution().logical().toString().lower()
    assert hinted(bounded_broadcast(df)) and not hinted(bounded_broadcast(df, max_bytes=5000))
