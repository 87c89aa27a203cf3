from pyspark.sql import functions as F
from pyspark.sql import Window

from tabulon.operators import sampling


def _orders(spark):
    return spark.read.parquet("/root/testdata/sf0.01/orders.parquet")


def test_hash_rank_equals_global_window(spark):
    o = _orders(spark)
    r = sampling.hash_rank(o, "o_orderkey", "o_orderpriority", 42)
    g = o.withColumn("_h", F.md5(F.concat(F.lit("42-"), F.col("o_orderkey").cast("string")))) \
        .withColumn("g", F.row_number().over(Window.partitionBy("o_orderpriority").orderBy("_h", "o_orderkey")))
    j = r.join(g, "o_orderkey")
    assert j.filter(F.col("rank_in_class") != F.col("g")).count() == 0


def test_folds_partition_and_balance(spark):
    o = _orders(spark)
    f = sampling.stratified_folds(o, "o_orderkey", "o_orderpriority", 10, 42)
    assert f.count() == o.count() and f.select("o_orderkey").distinct().count() == o.count()
    c = sampling.fold_class_counts(f, "o_orderpriority")
    assert c.agg(F.max("spread")).first()[0] <= 1
    sizes = [r[1] for r in f.groupBy("fold").count().collect()]
    assert max(sizes) - min(sizes) <= 1


def test_split_total_is_floor(spark):
    o = _orders(spark)
    s = sampling.stratified_split(o, "o_orderkey", "o_orderpriority", 0.3, 42)
    n = o.count()
    assert s.filter("part = 'tuning'").count() == int(n * 0.3)


def test_probe_size(spark):
    o = _orders(spark)
    assert sampling.stratified_take(o, "o_orderkey", "o_orderpriority", 777, 42).count() == 777


def test_smote_points_lie_on_segments(spark):
    rows = [(i, 1 if i < 6 else 0, [float(i), float(i * i % 7)]) for i in range(40)]
    df = spark.createDataFrame(rows, "k long, y int, x array<double>")
    s = sampling.smote(df, "k", "y", "x", cap=0.5, k=3, seed=42).collect()
    pts = {r[0]: r[2] for r in rows}
    assert len(s) == 11          # ceil(0.5 * 34) - 6
    for r in s:
        a, b, u = pts[r["base"]], pts[r["neighbor"]], r["u"]
        assert 0 <= u < 1
        for j in range(2):
            assert abs(r["x"][j] - (a[j] + u * (b[j] - a[j]))) < 1e-9


def test_null_labels_are_kept_as_a_stratum(spark):
    rows = [(i, None if i % 4 == 0 else ("a" if i % 2 else "b")) for i in range(40)]
    df = spark.createDataFrame(rows, "k long, y string")
    f = sampling.stratified_folds(df, "k", "y", 5, 42)
    assert f.count() == 40
    s = sampling.stratified_split(df, "k", "y", 0.5, 42)
    assert s.count() == 40 and s.filter("part = 'tuning'").count() == 20
