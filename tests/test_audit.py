import math

import numpy as np
import pandas as pd
import pytest

from tabulon.operators import audit


def test_duplicates_and_conflicts(spark):
    rows = [(1, "a", "x", 0), (2, "a", "x", 0), (3, "a", "x", 1), (4, "b", "y", 2), (5, "b", "y", 2), (6, "c", "z", 1)]
    df = spark.createDataFrame(rows, "id long, f1 string, f2 string, y int")
    r = audit.duplicates(df, ["f1", "f2"], "y").first().asDict()
    assert r["duplicate_rows"] == 2            # (a,x,0) once more, (b,y,2) once more
    assert r["duplicate_descriptive"] == 3     # 6 rows, 3 vectors
    assert r["conflicting_pairs"] == 1         # (a,x) carries two labels
    assert r["conflict_records"] == 3
    assert r["unresolvable"] == 1              # the (a,x,1) row
    assert r["distinct_vectors"] == 3


def test_majority_ties_go_to_lowest_label(spark):
    df = spark.createDataFrame([("v", 2), ("v", 1), ("w", 3)], "f string, y int")
    m = {r["f"]: r["majority"] for r in audit.majority_labels(df, ["f"], "y").collect()}
    assert m == {"v": 1, "w": 3}


def test_texts_grouped_by_digest(spark):
    long = "x" * 100_000
    rows = [(1, long, 0), (2, long, 0), (3, long, 1), (4, "b", 2), (5, "b", 2), (6, None, 1), (7, None, 1), (8, "", 1), (9, long + "y", 0)]
    df = spark.createDataFrame(rows, "id long, t string, y int").repartition(3)
    keyed = audit.digest_keyed(df, ["t"])
    assert audit.duplicates(keyed, ["t"], "y").first() == audit.duplicates(df, ["t"], "y").first()
    found = audit.majority_labels(keyed, ["t"], "y", key="id")
    assert all(len(r["t"] or b"0" * 16) == 16 for r in found.collect())          # digests are all that is grouped and moved
    with_text = audit.attach_texts(found, df, ["t"], "id")
    plain = audit.majority_labels(df, ["t"], "y")
    assert sorted(map(str, with_text.select(plain.columns).collect())) == sorted(map(str, plain.collect())) and plain.count() == 5
    empty = df.limit(0)
    assert audit.attach_texts(audit.majority_labels(audit.digest_keyed(empty, ["t"]), ["t"], "y", key="id"), empty, ["t"], "id").count() == 0


def test_digest_collisions_are_refused(spark):
    df = spark.createDataFrame([(bytearray(16), 0, 7), (bytearray(16), 1, 8)], "t binary, y int, _check long")
    for grouped in (audit.duplicates(df, ["t"], "y"), audit.majority_labels(df, ["t"], "y")):
        with pytest.raises(Exception, match="share a 128-bit digest"):
            grouped.collect()


def test_profile_matches_pandas(spark):
    x = [1.0, 2.0, 2.0, 3.0, 50.0, 0.0, 4.0, 5.0]
    df = spark.createDataFrame([(v, 7.0) for v in x], "a double, c double")
    p = {r["feature"]: r for r in audit.profile(df, ["a", "c"]).collect()}
    s = pd.Series(x)
    assert math.isclose(p["a"]["skewness"], round(s.skew(), 6), abs_tol=1e-6)
    assert math.isclose(p["a"]["std"], round(s.std(), 6), abs_tol=1e-6)
    assert p["a"]["median"] == s.median()
    q1, q3 = s.quantile(.25), s.quantile(.75)
    out = ((s < q1 - 1.5 * (q3 - q1)) | (s > q3 + 1.5 * (q3 - q1))).mean() * 100
    assert math.isclose(p["a"]["pct_outlier"], round(out, 6))
    assert p["c"]["pct_outlier"] is None       # IQR = 0
    assert p["c"]["skewness"] == 0.0           # constant column
    assert p["a"]["pct_zero"] == 12.5


def test_correlations_constant_column_is_null(spark):
    df = spark.createDataFrame([(1.0, 2.0, 5.0), (2.0, 4.0, 5.0), (3.0, 7.0, 5.0)], "a double, b double, c double")
    c = {(r["feature_a"], r["feature_b"]): r["abs_r"] for r in audit.correlations(df, ["a", "b", "c"]).collect()}
    assert c[("a", "c")] is None
    assert math.isclose(c[("a", "b")], round(abs(np.corrcoef([1, 2, 3], [2, 4, 7])[0, 1]), 6))


def test_adjacent_agreement_stitches_bucket_edges(spark):
    ys = ["a", "a", "b", "b", "b", "a", "c", "c"]
    df = spark.createDataFrame([(i * 10, y) for i, y in enumerate(ys)], "id long, y string")
    r = audit.adjacent_agreement(df, "id", "y").first()
    agree = sum(1 for i in range(1, len(ys)) if ys[i] == ys[i - 1])
    assert r["n_pairs"] == len(ys) - 1 and r["agree"] == agree


def test_monotonic_check(spark):
    df = spark.createDataFrame([(1, 10), (2, 20), (3, 15), (4, 40)], "t int, id int")
    r = audit.monotonic_check(df, "t", "id").first()
    assert r["violations"] == 1 and not r["strictly_increasing"]
