import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabulon.operators import features, stats


def _table(spark, rows):
    return spark.createDataFrame(rows, "block int, grp string, metric double")


def test_wilcoxon_all_one_sign_and_holm(spark):
    # 10 folds, a always ahead of b: W = 0, exact p = 2/1024
    rows = []
    for f in range(10):
        rows += [(f, "a", 0.6 + f / 100), (f, "b", 0.5 + f / 200), (f, "c", 0.4), (f, "d", 0.3 - f / 1000)]
    t = _table(spark, rows)
    w = {(r["group_a"], r["group_b"]): r for r in stats.wilcoxon_pairs(t).collect()}
    assert w[("a", "b")]["wilcoxon_statistic"] == 0.0
    assert w[("a", "b")]["wilcoxon_p"] == 0.001953125
    h = stats.holm(stats.wilcoxon_pairs(t).select("group_a", "group_b", "wilcoxon_p"), "wilcoxon_p").collect()
    assert all(abs(r["holm_p"] - 0.01171875) < 1e-12 for r in h)   # 6 x 0.001953125
    fr = stats.friedman(t).first()
    assert fr["statistic"] == 30.0                                     # maximum for 4 x 10
    assert math.isclose(fr["p_value"], 1.38e-6, rel_tol=0.01)


def test_chi2_and_t_helpers():
    assert math.isclose(stats._chi2_sf_np(3.84145882, 1), 0.05, rel_tol=1e-6)
    assert math.isclose(stats._chi2_sf_np(7.8147279, 3), 0.05, rel_tol=1e-6)
    assert math.isclose(stats._chi2_sf_np(9.48772904, 4), 0.05, rel_tol=1e-6)
    assert math.isclose(stats._t_two_sided(2.26215716, 9), 0.05, rel_tol=1e-6)


def test_signed_rank_p_at_any_length():
    from fractions import Fraction
    rng = np.random.default_rng(6)
    for n in (1, 5, 12, 300):
        ranks = sorted(int(x) for x in rng.integers(1, 2 * n + 1, n))
        counts = [1]                                       # big integers: subsets by their sum
        for r in ranks:
            counts = [(counts[s] if s < len(counts) else 0) + (counts[s - r] if 0 <= s - r < len(counts) else 0) for s in range(len(counts) + r)]
        for share in (0.1, 0.4, 0.5):
            w2 = int(sum(ranks) * share)
            want = min(1.0, float(Fraction(2 * sum(counts[:w2 + 1]), 2 ** n)))
            assert abs(stats._signed_rank_p(ranks, w2) - want) < 1e-12
    n = 2000                                               # 2^2000 is beyond a double; the normal limit is close
    half = n * (n + 1) // 2
    sd = math.sqrt(n * (n + 1) * (2 * n + 1) / 24)
    w = int(half / 2 - 2 * sd)
    assert abs(stats._signed_rank_p([2 * r for r in range(1, n + 1)], 2 * w) - math.erfc((half / 2 - w - 0.5) / sd / math.sqrt(2))) < 1e-4


def test_t_tail_against_known_values():
    for t, df, p in ((12.706204736, 1, 0.05), (4.302652730, 2, 0.05), (3.182446305, 3, 0.05), (2.776445105, 4, 0.05), (3.249835542, 9, 0.01),
                     (1.983971519, 100, 0.05), (0.0, 7, 1.0)):
        assert abs(stats._t_two_sided(t, df) - p) < 1e-8 and stats._t_two_sided(-t, df) == stats._t_two_sided(t, df)


def test_null_levels_beside_others(spark):
    rows = [("a",)] * 5 + [(None,)] * 4 + [("b",)] * 3 + [("rare",)]
    df = spark.createDataFrame(rows, "c string")
    kept = features.fit_rare_levels(df, ["c"], 0.2)
    assert kept == {"c": [None, "a", "b"]}
    grouped = features.apply_rare_levels(df, kept)
    assert {(r["c"], r["n"]) for r in grouped.groupBy("c").agg(F.count("*").alias("n")).collect()} == {(None, 4), ("a", 5), ("b", 3), ("other", 1)}
    assert features.apply_rare_levels(df, {"c": ["a"]}).filter("c is null").count() == 0
    levels = features.fit_one_hot(grouped, ["c"])["c"]
    assert levels == [None, "a", "b", "other"]
    hot = {r["c"]: r["x"] for r in grouped.select("c", features.one_hot_expr("c", levels).alias("x")).collect()}
    assert hot[None] == [1.0, 0, 0, 0] and hot["b"] == [0, 0, 1.0, 0]
    assert spark.createDataFrame([("new",)], "c string").select(features.one_hot_expr("c", levels)).first()[0] == [0, 0, 0, 0]
    codes = features.fit_ordinal(df, ["c"])
    got = {r["c"]: r["c_code"] for r in features.apply_ordinal(df.unionByName(spark.createDataFrame([("new",)], "c string")), codes, ["c"]).collect()}
    assert got == {None: 0, "a": 1, "b": 2, "rare": 3, "new": -1}
    both = features.knn_features(df.withColumn("v", F.rand(1)), df.withColumn("v", F.rand(1)), ["v"], ["c"], scale=None, min_frequency=0.2)
    assert all(None not in r["features"] for r in both.collect())


def test_rank_scaler_matches_reference_rule(spark):
    rng = np.random.default_rng(2)
    tr = np.round(rng.exponential(3, 3000), 1)       # many ties, more rows than knots
    te = np.concatenate([np.round(rng.exponential(3, 500), 2), [tr.min(), tr.max(), -1.0, 1e9]])
    train = spark.createDataFrame([(float(v),) for v in tr], "x double")
    test = spark.createDataFrame([(i, float(v)) for i, v in enumerate(te)], "i long, x double")
    p = features.fit_scaler(train, ["x"], "rank")
    got = np.array([r["x"] for r in features.apply_scaler(test, p).orderBy("i").collect()])
    refs = np.linspace(0, 1, 1000)
    q = np.percentile(tr, refs * 100)
    exp = 0.5 * (np.interp(te, q, refs) - np.interp(-te, -q[::-1], -refs[::-1]))
    exp[te + 1e-7 > q[-1]] = 1.0
    exp[te - 1e-7 < q[0]] = 0.0
    assert np.allclose(got, exp, atol=1e-12)


def test_fit_ignores_held_out_rows(spark):
    base = [(i % 5, "lvl%d" % (i % 7), float(i)) for i in range(200)]
    df = spark.createDataFrame(base, "fold int, c string, x double")
    changed = df.withColumn("c", F.when(F.col("fold") == 0, F.lit("zzz")).otherwise(F.col("c"))) \
        .withColumn("x", F.when(F.col("fold") == 0, F.lit(1e6)).otherwise(F.col("x")))
    for d in (df, changed):
        tr = d.filter("fold <> 0")
        assert features.fit_rare_levels(tr, ["c"], 0.1) == features.fit_rare_levels(df.filter("fold <> 0"), ["c"], 0.1)
        assert features.fit_scaler(tr, ["x"], "minmax").values == features.fit_scaler(df.filter("fold <> 0"), ["x"], "minmax").values


def test_rare_level_guard_keeps_most_frequent(spark):
    df = spark.createDataFrame([("a",), ("b",), ("b",), ("c",)], "c string")
    assert features.fit_rare_levels(df, ["c"], 0.9) == {"c": ["b"]}


def test_correlation_filter_drops_later_of_equal_pair(spark):
    df = spark.createDataFrame([(float(i), 2.0 * i, float(i % 3)) for i in range(30)], "a double, b double, c double")
    assert features.fit_correlation_filter(df, ["a", "b", "c"], 0.95) == ["a", "c"]


def test_exact_quantiles_bucketed_path_matches_numpy(spark):
    rng = np.random.default_rng(5)
    a = np.round(rng.lognormal(2, 1, 5000), 2)          # many distinct values, ties
    b = rng.integers(0, 7, 5000).astype(float)           # few distinct values
    df = spark.createDataFrame([(float(x), float(y)) for x, y in zip(a, b)], "a double, b double")
    probs = [0.0, 0.01, 0.25, 0.5, 0.77, 0.999, 1.0]
    for vpb in (1_000_000, 50):                          # one bucket, then about 100 buckets
        got, card = features.exact_quantiles(df, ["a", "b"], probs, values_per_bucket=vpb, with_cardinality=True)
        assert np.allclose(got["a"], np.percentile(a, [p * 100 for p in probs]), rtol=0, atol=1e-9)
        assert np.allclose(got["b"], np.percentile(b, [p * 100 for p in probs]), rtol=0, atol=1e-9)
        assert card == {"a": len(set(a)), "b": len(set(b))}


def test_preparation_of_all_folds_equals_a_fit_for_each(spark):
    rng = np.random.default_rng(12)
    rows = [(i, i % 3, float(rng.integers(0, 50)), float(rng.normal()) if i % 11 else None, 1.0,
             [None, "a", "b", "other", f"r{i}"][int(rng.integers(0, 5))], "only0" if i == 0 else "x") for i in range(150)]
    df = spark.createDataFrame(rows, "id int, fold int, a double, b double, same double, c string, d string")
    as_list = lambda v: v if isinstance(v, list) else [float(x) for x in v]
    for options in (dict(scale="rank"), dict(scale="minmax", corr=0.9, min_frequency=0.05), dict(scale=None, group=False)):
        every = features.knn_features_by_fold(df, "fold", ["a", "b", "same"], ["c", "d"], **options)
        for f, got in every.items():
            want = features.knn_features(df.filter(F.col("fold") != f), df, ["a", "b", "same"], ["c", "d"], **options)
            assert sorted(map(str, got.select("id", "features").collect())) == sorted(map(str, want.select("id", "features").collect()))
    for options in (dict(), dict(scale="robust", onehot=True)):
        every = features.tree_features_by_fold(df.na.fill(0.0), "fold", ["a", "b"], ["c", "d"], **options)
        for f, got in every.items():
            full = df.na.fill(0.0)
            want = features.tree_features(full.filter(F.col("fold") != f), full, ["a", "b"], ["c", "d"], **options)
            w = {r["id"]: as_list(r["features"]) for r in want.select("id", "features").collect()}
            assert {r["id"]: as_list(r["features"]) for r in got.select("id", "features").collect()} == w


def test_sparse_one_hot_equals_dense_and_takes_any_number_of_levels(spark):
    rows = [("a", "x", 1.0), ("b", None, 2.0), (None, "x", 3.0), ("c", "y", 4.0)]
    train = spark.createDataFrame(rows, "c string, e string, v double")
    df = train.unionByName(spark.createDataFrame([("new", None, 5.0)], train.schema))
    dense = features.tree_features(train, df, ["v"], ["c", "e"], onehot=True)
    sparse = features.tree_features(train, df, ["v"], ["c", "e"], onehot=True, sparse=True)
    key = lambda r: r["v"]
    assert [r["features"].toArray().tolist() for r in sorted(sparse.collect(), key=key)] == [r["features"].toArray().tolist() for r in sorted(dense.collect(), key=key)]
    assert sparse.columns == dense.columns

    many = spark.range(100_000).select(F.when(F.col("id") > 0, F.concat(F.lit("level"), "id")).alias("c"), F.col("id").cast("double").alias("v"))
    hot = features.one_hot_sparse(many, features.fit_ordinal(many, ["c"]), ["c"]).select("v", "c_onehot")
    small = {r["v"]: r["c_onehot"] for r in hot.filter("v % 20000 = 0").collect()}
    assert all(v.size == 100_000 and len(v.indices) == 1 for v in small.values()) and small[0.0].indices[0] == 0     # NULL comes first
    assert len({int(v.indices[0]) for v in small.values()}) == 5
    with pytest.raises(ValueError, match="sparse"):
        features.fit_one_hot(many, ["c"])
    coded = features.knn_features(many, many.limit(3), ["v"], ["c"], group=False, scale=None, codes=True)
    assert all(len(r["features"]) == 2 for r in coded.collect())
    none = features.one_hot_sparse(many.limit(5), features.fit_ordinal(many.limit(0), ["c"]), ["c"])
    assert all(not len(r["c_onehot"].indices) for r in none.collect())
