import math

import numpy as np
from pyspark.sql import functions as F

from tabulon.operators import bounds, checks, metrics
from tabulon.plans import report


def _np_scores(y, p, K):
    M = np.zeros((K, K))
    for a, b in zip(y, p):
        M[a, b] += 1
    tp, t, pr = np.diag(M), M.sum(1), M.sum(0)
    obs = (t + pr) > 0
    f1 = np.where(t + pr > 0, 2 * tp / np.maximum(t + pr, 1), 0)
    s = M.sum()
    pe = (pr * t).sum() / s ** 2
    mcc = (tp.sum() * s - (pr * t).sum()) / math.sqrt((s * s - (pr ** 2).sum()) * (s * s - (t ** 2).sum()))
    return dict(accuracy=tp.sum() / s, balanced_accuracy=(tp[t > 0] / t[t > 0]).mean(), f1_macro=f1[obs].mean(),
                f1_all=f1.mean(), f1_weighted=(f1 * t).sum() / s, kappa=(tp.sum() / s - pe) / (1 - pe), mcc=mcc)


def test_scores_match_numpy(spark):
    rng = np.random.default_rng(0)
    y = rng.integers(0, 4, 200)
    p = np.where(rng.random(200) < 0.6, y, rng.integers(0, 5, 200))
    df = spark.createDataFrame([(int(a), int(b)) for a, b in zip(y, p)], "y int, pred int")
    conf = metrics.confusion(df, [])
    s = metrics.scores(conf, []).first().asDict()
    a = metrics.scores(conf, [], domain="all", n_classes=6).first()["f1_macro"]
    ref = _np_scores(y, p, 6)
    for k in ("accuracy", "balanced_accuracy", "f1_macro", "f1_weighted", "kappa", "mcc"):
        assert math.isclose(s[k], round(ref[k], 6), abs_tol=2e-6), k
    assert math.isclose(a, round(ref["f1_all"], 6), abs_tol=2e-6)


def test_confusion_filled_sums_to_rows(spark):
    df = spark.createDataFrame([(0, 0, 1), (0, 1, 1), (1, 1, 2)], "f int, y int, pred int")
    c = metrics.confusion_filled(metrics.confusion(df, ["f"]), ["f"], [0, 1, 2])
    assert c.count() == 2 * 9
    assert sum(r["n"] for r in c.collect()) == 3


def test_macro_f1_difference_from_counts_can_contradict_a_report(spark):
    rng = np.random.default_rng(5)
    rows, want = [], {}
    for g, right in (("a", 0.8), ("b", 0.5)):
        per = []
        for f in range(3):
            y = rng.integers(0, 3, 90)
            p = np.where(rng.random(90) < right, y, rng.integers(0, 4, 90))
            per.append(_np_scores(y, p, 4)["f1_macro"])
            rows += [(g, f, int(i), int(j), 1) for i, j in zip(y, p)]
        want[g] = np.mean(per)
    conf = spark.createDataFrame(rows, "configuration string, fold int, y int, pred int, one int") \
        .groupBy("configuration", "fold", "y", "pred").agg(F.sum("one").alias("n"))
    got = checks.macro_f1_difference(conf, "configuration", "fold", "a", "b")
    assert abs(got.first()["difference"] - (want["a"] - want["b"])) < 2e-6 and abs(got.first()["ratio"] - want["a"] / want["b"]) < 1e-5
    named = got.withColumn("comparison", F.lit("a vs b"))
    values = ["difference", "percent_change", "ratio"]
    ok = lambda stored: {r["name"]: r["ok"] for r in checks.derived_numbers(stored, named, ["comparison"], values).collect()}
    assert ok(named) == dict.fromkeys(values, True)
    assert ok(named.withColumn("ratio", F.col("ratio") + 0.001)) == {"difference": True, "percent_change": True, "ratio": False}


def test_share_needed_and_class_leads(spark):
    per = spark.createDataFrame([("a", 0.9), ("b", 0.2), ("c", None), ("d", 0.6)], "cls string, f1_resubstitution double")
    got = {r["hardest"]: r for r in bounds.share_needed(per, 0.5).collect()}
    assert [got[i]["last_class"] for i in (1, 2, 3)] == ["c", "b", "d"] and len(got) == 3
    assert math.isclose(got[2]["needed"], (0.5 * 4 - 0.2) / 2) and math.isclose(got[2]["bound_of_others"], 0.75) and not got[2]["enough"]
    assert math.isclose(got[3]["needed"], 1.2) and not got[3]["enough"] and not got[1]["enough"]
    assert bounds.share_needed(per, 0.4).filter("hardest = 2").first()["enough"]
    assert bounds.share_needed(per.limit(0), 0.5).count() == 0 and bounds.share_needed(per.limit(1), 0.5).count() == 0
    wide = spark.createDataFrame([(0, 0.5, 0.4, 10), (1, 0.9, 0.9, 60), (2, 0.1, 0.4, 20), (3, 0.7, 0.2, 10)], "cls int, x double, y double, n long")
    leads = {r["lead"]: tuple(r)[1:] for r in report.class_leads(wide, "x", "y").collect()}
    assert leads == {"x": (2, "0,3", 20.0, 0.5), "tie": (1, "1", 60.0, 0.0), "y": (1, "2", 20.0, 0.3)}
