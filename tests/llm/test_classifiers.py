import numpy as np
from pyspark.sql import functions as F

from tabulon.llm import features, quality, toxicity

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id bigint, text string, score double, keep int, p_toxic string"
PLAIN = "A quiet town by the river keeps its old mill, and people walk there on summer evenings to hear water turn the wheel."
ODD = [(1, None, 0.5, 1, "x"), (2, "", 0.5, 1, "x"), (3, " \n ", 0.5, 1, "x"), (None, "no id", 0.5, 1, "x"), (4, PLAIN, 0.5, 1, "x"),
       (4, PLAIN, 0.5, 1, "x"), (5, "word " * 60_000, 0.5, 1, "x"), (6, "LOUD!! WORDS!! HERE!! " * 30, 0.5, 1, "x")]


def test_em_finds_the_rates_of_labellers():
    rng = np.random.default_rng(2)
    m, n = len(quality.LABELLERS), 40_000
    good = rng.random(n) < 0.85
    p_bad = rng.uniform(0.3, 0.9, m)
    vote = np.where(rng.random((n, m)) < np.where(good[:, None], 0.001, p_bad), quality.BAD, quality.GOOD)
    vote[rng.random((n, m)) < 0.3] = quality.NONE
    pattern = (vote * 3 ** np.arange(m - 1, -1, -1)).sum(axis=1)
    values, counts = np.unique(pattern, return_counts=True)
    post, rate, share = quality.estimate(values, counts.astype(float))
    assert np.abs(rate[0] - p_bad).max() < 0.05 and rate[1].max() <= quality.FALSE_ALARM and abs(share - 0.85) < 0.02
    guess = post[np.searchsorted(values, pattern)] >= 0.5
    assert (guess == good).mean() > 0.98


def test_quality_against_labels_it_never_saw(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    half = docs.filter("doc_id % 2 = 0")
    scored = quality.score_documents(docs.filter("doc_id % 2 = 1"), quality.fit(half)).join(labels, "doc_id")
    right = scored.agg(F.avg((F.col("keep").cast("int") == F.col("quality")).cast("int"))).first()[0]
    lost = scored.filter("quality = 1 and not keep").count()
    assert right > 0.97 and lost <= 1


def test_quality_odd_rows(spark):
    docs = spark.createDataFrame(ODD, SCHEMA)
    model = quality.fit(docs)
    rows = quality.score_documents(docs, model).collect()
    assert len(rows) == len(ODD) and all(0 <= r["score"] <= 1 and 0 <= r["posterior"] <= 1 for r in rows)
    assert len({r["score"] for r in rows if r["doc_id"] == 4}) == 1
    kept = quality.keep_good(docs)
    assert kept.columns == ["doc_id", "text", "p_toxic"] and kept.filter("doc_id = 4").count() == 2
    assert quality.keep_good(docs.limit(0)).count() == 0


def test_toxicity_on_held_out_documents(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    test = (F.xxhash64("doc_id") % 4) == 0
    chain = toxicity.fit_chain(docs, labels.filter(~test), {"junk": 1 - F.col("quality"), "toxic": F.col("toxic")})
    rows = toxicity.score_chain(docs, chain).join(labels.filter(test), "doc_id").collect()
    toxic = [r for r in rows if r["toxic"] == 1]
    assert sum(r["p_toxic"] >= 0.5 for r in toxic) >= 0.8 * len(toxic)
    assert sum(r["p_toxic"] >= 0.5 for r in rows if r["toxic"] == 0) <= 0.02 * len(rows)
    assert sum((r["p_junk"] >= 0.5) == (r["quality"] == 0) for r in rows) >= 0.95 * len(rows)


def test_toxicity_odd_rows_and_labels(spark):
    docs = spark.createDataFrame(ODD, SCHEMA)
    labels = spark.createDataFrame([(1, 1, 0), (2, None, 0), (4, 1, 1), (4, 1, 1), (6, 0, None), (None, 0, 1), (99, 1, 1)],
                                   "doc_id bigint, quality int, toxic int")
    cats = {"junk": 1 - F.col("quality"), "toxic": F.col("toxic"), "never": F.lit(0)}
    rows = toxicity.score_chain(docs, toxicity.fit_chain(docs, labels, cats)).collect()
    assert len(rows) == len(ODD) and all(0 <= r[f"p_{c}"] <= 1 for r in rows for c in cats)
    assert max(r["p_never"] for r in rows) < 0.5
    none = toxicity.fit_chain(docs, labels.limit(0), cats)
    assert toxicity.score_chain(docs, none).count() == len(ODD)
    assert toxicity.score_chain(docs.limit(0), none).count() == 0


def test_linear_model_fits_and_copies_of_rows_weigh_twice():
    rng = np.random.default_rng(0)
    x = rng.random((400, 6)) < 0.5
    y = (x[:, 0] | x[:, 1]).astype(float)
    row, col = np.nonzero(x)
    m = features.Linear(6, 0).fit(row, col, np.zeros((400, 0)), y)
    assert ((m.probability(row, col, np.zeros((400, 0))) >= 0.5) == y).mean() > 0.95
    twice = features.Linear(6, 0).fit(np.concatenate([row, row + 400]), np.concatenate([col, col]), np.zeros((800, 0)), np.concatenate([y, y]))
    weighed = features.Linear(6, 0).fit(row, col, np.zeros((400, 0)), y, np.full(400, 2.0))
    assert np.allclose(twice.w, weighed.w, atol=0.05)


def test_linear_model_is_fitted_to_convergence():
    rng = np.random.default_rng(1)
    x = rng.random((600, 200)) < rng.uniform(0.02, 0.9, 200)
    y = (rng.random(600) < 1 / (1 + np.exp(-(x - x.mean(0)) @ rng.normal(0, 1, 200)))).astype(float)
    row, col = np.nonzero(x)
    m = features.Linear(200, 0, l2=1e-5).fit(row, col, np.zeros((600, 0)), y)
    w = m.w * np.append(np.ones(200), 0)
    slope = np.append(x.T, np.ones((1, 600)), axis=0) @ (m.probability(row, col, np.zeros((600, 0))) - y) / 600 + 1e-5 * w
    assert np.abs(slope).max() < 1e-4


def test_every_feature_that_tells_the_sides_apart_is_selected():
    counts = np.zeros((2, features.DIMS), np.int64)
    counts[:, 1000:7000] = [[10], [100]]
    assert toxicity._select(counts, np.array([1000, 1000])).tolist() == list(range(1000, 7000))


def test_em_finds_a_labeller_that_errs_on_good_documents():
    rng = np.random.default_rng(3)
    m, n = len(quality.LABELLERS), 40_000
    good = rng.random(n) < 0.85
    false = np.where(np.arange(m) == 2, 0.05, 0.001)
    vote = np.where(rng.random((n, m)) < np.where(good[:, None], false, 0.7), quality.BAD, quality.GOOD)
    values, counts = np.unique((vote * 3 ** np.arange(m - 1, -1, -1)).sum(axis=1), return_counts=True)
    _, rate, _ = quality.estimate(values, counts.astype(float))
    assert abs(rate[1][2] - 0.05) < 0.01 and np.delete(rate[1], 2).max() <= quality.FALSE_ALARM


def test_samples_stay_bounded_when_an_id_repeats(spark, monkeypatch):
    rows = [(1, f"text {i} of one id" if i % 2 else "the same text again") for i in range(600)] + [(i, f"plain words {i}") for i in range(2, 40)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 40)], "doc_id bigint, toxic int")
    sizes = []

    class Counted(toxicity.Linear):
        def fit(self, owner, col, extra, y, *more, **named):
            sizes.append(len(y))
            return super().fit(owner, col, extra, y, *more, **named)

    monkeypatch.setattr(toxicity, "Linear", Counted)
    monkeypatch.setattr(quality, "Linear", Counted)
    toxicity.fit_chain(docs, labels, {"toxic": F.col("toxic")}, sample=10)
    quality.fit(docs.filter("doc_id = 1 and text like 'the same%'"), sample=10)
    assert sizes and max(sizes) <= 10 and sizes[-1] == 1
