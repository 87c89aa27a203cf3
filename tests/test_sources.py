import os
import tempfile

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabulon import sources


def _tmp():
    return tempfile.mkdtemp(prefix="tabulon-test-", dir="/tmp")


def test_raw_csv_keeps_empty_and_token(spark):
    d = _tmp()
    p = os.path.join(d, "raw.csv")
    with open(p, "w") as f:
        f.write("id,service,x\n1,?,3\n2,,4\n3,http,NA\n")
    df = sources.read_raw_csv(spark, p, ["id", "service", "x"])
    rows = df.orderBy("id").collect()
    assert [r["service"] for r in rows] == ["?", "", "http"]
    assert rows[2]["x"] == "NA"          # no NA parsing: every value is a string


def test_partitioned_append_is_idempotent(spark):
    d = os.path.join(_tmp(), "folds")
    a = spark.createDataFrame([("knn", 0, 0.5), ("knn", 1, 0.6)], "configuration string, fold int, f1 double")
    sources.append_partitions(a, d, ["configuration", "fold"])
    b = spark.createDataFrame([("knn", 1, 0.7), ("tree", 0, 0.4)], "configuration string, fold int, f1 double")
    sources.append_partitions(b, d, ["configuration", "fold"])
    got = {(r["configuration"], r["fold"]): r["f1"] for r in spark.read.parquet(d).collect()}
    assert got == {("knn", 0): 0.5, ("knn", 1): 0.7, ("tree", 0): 0.4}


def test_settings_roundtrip_and_patch(spark):
    d = os.path.join(_tmp(), "settings")
    schema = T.StructType([T.StructField("tree", T.StructType([
        T.StructField("max_depth", T.IntegerType()), T.StructField("alpha", T.DoubleType())]))])
    df = spark.createDataFrame([((13, 0.75),)], schema)
    sources.write_settings(sources.patch_settings(df, "tree", "alpha", 0.5), d)
    back = sources.read_settings(spark, d, schema).first()
    assert back["tree"]["max_depth"] == 13 and back["tree"]["alpha"] == 0.5


def test_snapshot_is_written_once_and_reuse(spark):
    d = os.path.join(_tmp(), "snap")
    sources.snapshot(spark.range(3), d)
    sources.snapshot(spark.range(10), d)
    assert spark.read.parquet(d).count() == 3
    calls = []
    p = os.path.join(_tmp(), "w")
    for _ in range(2):
        sources.reuse_or_compute(spark, p, lambda: calls.append(1) or spark.range(2))
    assert len(calls) == 1


def test_log_and_text_extraction(spark):
    d = _tmp()
    log = os.path.join(d, "log.txt")
    with open(log, "w") as f:
        f.write("k=5: plain macro F1 = 0.5034\nk=5: tuned macro F1 = 0.5252\nk=15: plain macro F1 = 0.4878\n")
    t = {r["k"]: (r["plain"], r["tuned"]) for r in sources.extract_log_table(spark, log).collect()}
    assert t == {5: (0.5034, 0.5252)}
    tex = os.path.join(d, "m.tex")
    with open(tex, "w") as f:
        f.write("\\newcommand{\\accTree}{0.7830}\\newcommand{\\name}{tree}\n")
    pairs = {r["name"]: r["value"] for r in sources.extract_numeric_pairs(spark, tex).collect()}
    assert pairs == {"accTree": "0.7830"}


def test_count_tables_missing_counts_zero(spark):
    d = os.path.join(_tmp(), "t1")
    spark.range(4).write.parquet(d)
    out = {r["group"]: r["n"] for r in sources.count_tables(
        spark, {"a": d, "b": d + "_absent"}, {"a": "g", "b": "g"}).collect()}
    assert out == {"g": 4}
