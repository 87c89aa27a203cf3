import __spark_entry__ as E


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 1 and rows[0]["total_rows"] > 0


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


def test_bounds_order_property(spark):
    r = E.queries()["bound_cv_summary"](spark, "/root/testdata/sf0.001").first()
    assert r["macro_f1_conceded_cv"] >= r["macro_f1_memorisation_cv"]
