"""Quality classifier from weak labels.

Overlapping heuristic labellers vote good, bad or abstain on every document.
Votes of all documents are counted by pattern (at most 3 ^ labellers rows), and
expectation-maximisation on these counts estimates each labeller's rates of
good and bad votes among good and among bad documents (abstaining counts as
missing), with no human labels; a prior of ``PRIOR`` votes says that bad votes on
good documents are rare. The posterior of a document's vote pattern is
its weak label; a hashed linear scorer on shapes of words, not on the votes, is
trained on the posteriors and scores every document.

The scorer is fitted on at most ``SAMPLE`` documents, those with the smallest
hash of (doc_id, text), and rows equal to them; votes, pattern counts and scores cover all documents.

A null text is an empty text: all labellers abstain, so its weak label is the
prior of good documents; texts without words are scored like any other. Null and
repeated doc_ids give one row per input row. Other columns are ignored by
``score_documents`` and kept by ``keep_good``; an empty table gives no rows."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .buckets import one
from .common import frugal, table
from .features import DIMS, SHAPES, Linear, of_texts, statistics
from .words import chunks, split

SAMPLE = 20_000
FALSE_ALARM = 0.002           # labellers are built to be precise: prior rate of bad votes on good documents,
PRIOR = 1000.0                # worth so many votes; more documents than that speak for themselves
GOOD, BAD, NONE = 2, 1, 0

# (statistic, bad from, good up to, fewest words): the vote is bad at or above the
# first limit, good at or below the second (never, if None), and abstains else
LABELLERS = (("symbols", 0.10, None, 5), ("capitals", 0.50, None, 5), ("exclaimed", 0.25, None, 5), ("bars", 0.05, None, 5),
             ("odd", 0.25, 0.05, 5), ("repeated", 0.15, None, 10), ("sameness", 0.80, 0.60, 40), ("top", 0.30, 0.15, 20))


def votes(stats: dict[str, np.ndarray]) -> np.ndarray:
    """Vote pattern of each text, one base-3 digit per labeller."""
    stats = stats | {"sameness": 1 - stats["distinct"]}
    out = np.zeros(len(stats["n_words"]), np.int64)
    for name, bad, good, fewest in LABELLERS:
        x = stats[name]
        v = np.where(x >= bad, BAD, np.where(x <= (-1 if good is None else good), GOOD, NONE))
        out = out * 3 + np.where(stats["n_words"] >= fewest, v, NONE)
    return out


def _digits(patterns: np.ndarray) -> np.ndarray:
    m = len(LABELLERS)
    return (patterns[:, None] // 3 ** np.arange(m - 1, -1, -1)) % 3


def estimate(patterns: np.ndarray, counts: np.ndarray, steps: int = 200) -> tuple[np.ndarray, np.ndarray, float]:
    """EM over pattern counts: (posterior of good by pattern, labeller rates of
    bad votes [among bad, among good], share of good documents)."""
    v = _digits(patterns)
    m = v.shape[1]
    bad, good = (v == BAD).astype(float), (v == GOOD).astype(float)
    rate = np.tile([[0.3], [0.01]], (1, m))           # a bad vote is rare, and rarer still on a good document
    share = 0.9
    post = np.full(len(counts), share)
    for _ in range(steps):
        ll = bad @ np.log(rate).T + good @ np.log(1 - rate).T
        new = 1 / (1 + np.exp(np.clip(np.log1p(-share) + ll[:, 0] - np.log(share) - ll[:, 1], -700, 700)))
        moved = float(np.abs(new - post).max()) if len(post) else 0.0
        post = new
        for k, weight in enumerate((counts * (1 - post), counts * post)):
            rate[k] = (weight @ bad + (0.3, FALSE_ALARM * PRIOR)[k]) / (weight @ (bad + good) + (1.0, PRIOR)[k])
        rate = np.clip(rate, 1e-6, 1 - 1e-6)
        share = float(np.clip((counts @ post + 0.9) / (counts.sum() + 1.0), 1e-6, 1 - 1e-6))
        if moved < 1e-9:
            break
    return post, rate, share


class Model:
    """Posterior by vote pattern, and the linear scorer's columns and weights."""

    def __init__(self, posterior: dict[int, float], share: float, column: np.ndarray, linear: Linear):
        self.posterior, self.share, self.column, self.linear = posterior, share, column, linear

    def score(self, feature: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
        col = self.column[feature]
        known = col >= 0
        return self.linear.probability(owner[known], col[known], np.zeros((n, 0)))


def _patterns(batches):
    for b in batches:
        column = one(pa.chunked_array([b.column(0)]))
        for s, e in chunks(column):
            v, n = np.unique(votes(statistics(split(column.slice(s, e - s)))), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(v), pa.array(n)], ["pattern", "n"])


def _featured(batches):
    for b in batches:
        column = one(pa.chunked_array([b.column(0)]))
        for s, e in chunks(column):
            feature, owner, stats = of_texts(column.slice(s, e - s), (SHAPES,))
            ends = np.searchsorted(owner, np.arange(e - s + 1))
            yield pa.RecordBatch.from_arrays([pa.array(votes(stats)), pa.array(
                [feature[x:y].astype("<i4").tobytes() for x, y in zip(ends, ends[1:])], pa.binary())], ["pattern", "features"])


def fit(docs: DataFrame, sample: int = SAMPLE, min_rows: int = 5) -> Model:
    texts = docs.select("text")
    counted = (texts.mapInArrow(frugal(_patterns), "pattern bigint, n bigint").groupBy("pattern").agg(F.sum("n").alias("n")).collect())
    patterns = np.array(sorted(r["pattern"] for r in counted), np.int64)
    by = {r["pattern"]: r["n"] for r in counted}
    post, _, share = estimate(patterns, np.array([by[p] for p in patterns.tolist()], float))
    posterior = dict(zip(patterns.tolist(), post.tolist()))
    total = max(sum(by.values()), 1)
    # the sample's largest hash, among twice the share that is asked for: hashes
    # only, so that no text passes through one task
    most = min(int(2.0 * sample / total * 2.0 ** 63), 2 ** 63 - 1)
    hashed = docs.select("text", F.shiftrightunsigned(F.xxhash64("doc_id", "text"), 1).alias("_h")).filter(F.col("_h") <= most)
    last = hashed.select("_h").distinct().orderBy("_h").limit(sample).agg(F.max("_h")).first()[0]
    # rows that repeat a doc_id and its text count once
    chosen = hashed.filter(F.col("_h") <= F.lit(last if last is not None else -1)).dropDuplicates(["_h"]).select("text")
    rows = chosen.mapInArrow(frugal(_featured), "pattern bigint, features binary").collect()
    owner = np.repeat(np.arange(len(rows)), [len(r["features"]) // 4 for r in rows])
    feature = np.concatenate([np.frombuffer(r["features"], "<i4") for r in rows] or [np.zeros(0, "<i4")]).astype(np.int64)
    held = np.bincount(feature, minlength=DIMS) >= min(min_rows, max(len(rows) // 100, 1))
    column = np.where(held, np.cumsum(held) - 1, -1)
    y = np.array([posterior[r["pattern"]] for r in rows])
    known = column[feature] >= 0
    linear = Linear(int(held.sum()), 0).fit(owner[known], column[feature[known]], np.zeros((len(rows), 0)), y)
    return Model(posterior, share, column.astype(np.int32), linear)


def _scored(model, names: list[str]):
    def run(batches):
        m = model.value
        for b in batches:
            column = one(pa.chunked_array([b.column(b.schema.get_field_index("text"))]))
            for s, e in chunks(column):
                feature, owner, stats = of_texts(column.slice(s, e - s), (SHAPES,), m.column)
                score = m.score(feature, owner, e - s)
                part = b.slice(s, e - s)
                yield pa.RecordBatch.from_arrays(
                    [part.column(part.schema.get_field_index(n)) for n in names]
                    + [pa.array([m.posterior.get(v, m.share) for v in votes(stats).tolist()], pa.float64()),
                       pa.array(score), pa.array(score >= 0.5)], [*names, "posterior", "score", "keep"])
    return run


def score_documents(docs: DataFrame, model: Model, names: list[str] | None = None) -> DataFrame:
    """``names`` (doc_id by default) with posterior, score and keep."""
    names = names or ["doc_id"]
    shared = docs.sparkSession.sparkContext.broadcast(model)        # fixed size: 1 MB and the weights
    read = docs.select(*dict.fromkeys([*names, "text"]))
    schema = ", ".join(f"`{n}` {docs.schema[n].dataType.simpleString()}" for n in names)
    return read.mapInArrow(frugal(_scored(shared, names)), f"{schema}, posterior double, score double, keep boolean")


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the classifier keeps, with their own columns."""
    names = [c for c in docs.columns if c not in ("posterior", "score", "keep")]
    return score_documents(docs.select(*names), fit(docs), names).filter("keep").select(*names)


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score_documents(docs, fit(docs)).withColumn("keep", F.col("keep").cast("int"))
