"""Toxicity by a classifier chain.

Categories are predicted one after another. Each has a linear model on hashed
features (words, 4- and 5-byte word starts, shapes of words) and, as further
inputs, the log-odds of the categories before it. These inputs come from
out-of-fold predictions while training (folds by hash of the text, so copies
share a fold), and from the chain itself when scoring.

The models are fitted on at most ``SAMPLE`` labelled documents, those with the
smallest hash of doc_id; of their features, all whose document counts differ
between the two sides of a category (|z| at least ``MIN_Z``) are used. All documents are scored, over their whole
texts, in one pass without a shuffle.

Labels: a null label leaves its row out of that category's training; repeated
labels of a document and repeated documents each count. Documents with a null
doc_id are scored but cannot be labelled. A category with labels of one side
only predicts its smoothed prior. A null text is an empty text. An empty table
gives no rows. Other columns are ignored."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .buckets import one
from .common import cut, table
from .features import DIMS, SHAPES, WORDS, Linear, of_texts
from .words import chunks

SAMPLE = 20_000
MIN_Z = 4.0
FOLDS = 5
L2 = 1e-3
KINDS = (WORDS, SHAPES)


def _features(n_labels: int):
    def run(batches):
        for b in batches:
            column = one(pa.chunked_array([b.column(0)]))
            for s, e in chunks(column):
                feature, owner, _ = of_texts(column.slice(s, e - s), KINDS)
                ends = np.searchsorted(owner, np.arange(e - s + 1))
                yield pa.RecordBatch.from_arrays(
                    [b.column(1).slice(s, e - s)] + [b.column(2 + k).slice(s, e - s) for k in range(n_labels)]
                    + [pa.array([feature[x:y].astype("<i4").tobytes() for x, y in zip(ends, ends[1:])], pa.binary())],
                    ["fold", *[f"y{k}" for k in range(n_labels)], "features"])
    return run


def _counts(n_labels: int, block: int = 4096):
    """Documents that hold each feature, on each side of each label, by block."""
    def run(batches):
        total = np.zeros((2 * n_labels, DIMS), np.int64)
        for b in batches:
            lists = b.column(n_labels + 1).to_pylist()
            feature = [np.frombuffer(x, "<i4") for x in lists]
            size = [len(x) for x in feature]
            feature = np.concatenate(feature) if feature else np.zeros(0, "<i4")
            for k in range(n_labels):
                y = np.repeat(b.column(1 + k).cast(pa.float64()).to_numpy(zero_copy_only=False), size)
                for side in (0, 1):
                    total[2 * k + side] += np.bincount(feature[y == side], minlength=DIMS)
        for i in range(DIMS // block):
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()),
                                              pa.array([total[:, i * block:(i + 1) * block].astype("<i4").tobytes()], pa.binary())],
                                             ["block", "counts"])
    return run


def _add(key, rows):
    total = sum(np.frombuffer(x, "<i4").astype(np.int64) for x in rows.column("counts").to_pylist())
    return pa.table({"block": pa.array([key[0].as_py()], pa.int32()), "counts": pa.array([total.tobytes()], pa.binary())})


def _select(counts: np.ndarray, sides: np.ndarray) -> np.ndarray:
    """Features whose share of documents differs between the sides."""
    n0, n1 = sides
    if not n0 or not n1:
        return np.zeros(0, np.int64)
    p = (counts[0] + counts[1]) / (n0 + n1)
    with np.errstate(divide="ignore", invalid="ignore"):
        z = np.abs(counts[1] / n1 - counts[0] / n0) / np.sqrt(p * (1 - p) * (1 / n0 + 1 / n1))
    return np.flatnonzero(np.nan_to_num(z) >= MIN_Z)


class Chain:
    """Columns and weights of the categories, in their order."""

    def __init__(self, names: list[str], column: np.ndarray, models: list[Linear]):
        self.names, self.column, self.models = names, column, models

    def probabilities(self, feature: np.ndarray, owner: np.ndarray, n: int) -> list[np.ndarray]:
        col = self.column[feature]
        known = col >= 0
        row, col, extra, out = owner[known], col[known], np.zeros((n, 0)), []
        for m in self.models:
            z = m.margin(row, col, extra)
            out.append(1 / (1 + np.exp(-np.clip(z, -30, 30))))
            extra = np.column_stack([extra, np.clip(z, -10, 10)])
        return out


def fit_chain(docs: DataFrame, labels: DataFrame, categories: dict[str, Column], sample: int = SAMPLE) -> Chain:
    """``labels`` holds doc_id; ``categories`` maps each name, in chain order,
    to a 0/1 (or null) expression over its columns."""
    names = list(categories)
    ys = [c.cast("double").alias(f"y{k}") for k, c in enumerate(categories.values())]
    known = labels.filter("doc_id is not null").select(F.col("doc_id").cast("bigint").alias("doc_id"), *ys)
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id", *[f"y{k}" for k in range(len(names))]).limit(sample)
    n = len(names)
    rows = (docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
            .join(F.broadcast(chosen), "doc_id")       # at most `sample` rows
            .select("text", F.pmod(F.xxhash64(F.coalesce("text", F.lit("")), F.lit(7)), F.lit(FOLDS)).cast("int").alias("fold"),
                    *[f"y{k}" for k in range(n)],
                    F.xxhash64("doc_id", "text", *[f"y{k}" for k in range(n)]).alias("_h")))
    # an id may have many rows: equal ones count once, and different ones are
    # sampled by their hash, so that at most `sample` rows are left
    last = rows.select("_h").distinct().orderBy("_h").limit(sample).agg(F.max("_h")).first()[0]
    rows = rows.filter(F.col("_h") <= F.lit(last if last is not None else 0)).dropDuplicates(["_h"]).drop("_h")
    schema = ", ".join(["fold int", *[f"y{k} double" for k in range(n)], "features binary"])
    rows = cut(rows.mapInArrow(_features(n), schema))
    blocks = (rows.mapInArrow(_counts(n), "block int, counts binary").groupBy("block")
              .applyInArrow(_add, "block int, counts binary").collect())       # fixed size
    block = 4096
    counts = np.zeros((2 * n, DIMS), np.int64)
    for r in blocks:
        counts[:, r["block"] * block:(r["block"] + 1) * block] = np.frombuffer(r["counts"], np.int64).reshape(2 * n, block)
    sides = [rows.agg(F.count(F.when(F.col(f"y{k}") == 0, 1)), F.count(F.when(F.col(f"y{k}") == 1, 1))).first() for k in range(n)]
    picked = np.unique(np.concatenate([_select(counts[2 * k:2 * k + 2], np.array(sides[k])) for k in range(n)] or [[]])).astype(np.int64)
    column = np.full(DIMS, -1, np.int32)
    column[picked] = np.arange(len(picked))

    def narrow(batches):
        for b in batches:
            cols = [column[np.frombuffer(x, "<i4")] for x in b.column(n + 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*[b.column(k) for k in range(n + 1)],
                                              pa.array([c[c >= 0].astype("<i4").tobytes() for c in cols], pa.binary())], b.schema.names)
    got = rows.mapInArrow(narrow, schema).collect()    # at most `sample` rows of selected features
    got.sort(key=lambda r: (r["features"], r["fold"], *[(r[f"y{k}"] is None, r[f"y{k}"] or 0) for k in range(n)]))
    fold = np.array([r["fold"] for r in got], np.int64)
    size = [len(r["features"]) // 4 for r in got]
    owner = np.repeat(np.arange(len(got), dtype=np.int32), size)
    col = np.frombuffer(b"".join(r["features"] for r in got), "<i4")
    labels_of = [np.array([np.nan if r[f"y{k}"] is None else r[f"y{k}"] for r in got]) for k in range(n)]
    extra, models = np.zeros((len(got), 0)), []
    del got
    for k in range(n):
        scale = _log_odds(counts[2 * k:2 * k + 2, picked], sides[k])
        y = labels_of[k]
        out = np.zeros(len(y))
        for f in range(FOLDS) if k + 1 < n else ():
            m = _fit(owner, col, extra, y, (fold != f) & ~np.isnan(y), scale)
            out[fold == f] = m.margin(owner, col, extra)[fold == f]
        models.append(_fit(owner, col, extra, y, ~np.isnan(y), scale))
        extra = np.column_stack([extra, np.clip(out, -10, 10)])
    return Chain(names, column, models)


def _log_odds(counts: np.ndarray, sides) -> np.ndarray:
    """How much each feature's presence tells the sides apart, at least 0.01."""
    share = (counts + 0.5) / (np.array(sides, float)[:, None] + 1.0)
    return np.maximum(np.abs(np.log(share[1]) - np.log(share[0])), 0.01)


def _fit(owner, col, extra, y, use, scale) -> Linear:
    # rows that are not used weigh nothing: no copy of the sample for each fold
    return Linear(len(scale), extra.shape[1], l2=L2).fit(owner, col, extra, np.where(use, y, 0.0), use.astype(float), scale=scale)


def _scored(chain):
    def run(batches):
        c = chain.value
        for b in batches:
            column = one(pa.chunked_array([b.column(1)]))
            for s, e in chunks(column):
                feature, owner, _ = of_texts(column.slice(s, e - s), KINDS, c.column)
                p = c.probabilities(feature, owner, e - s)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(s, e - s), *[pa.array(x) for x in p]],
                                                 ["doc_id", *[f"p_{x}" for x in c.names]])
    return run


def score_chain(docs: DataFrame, chain: Chain) -> DataFrame:
    """doc_id and p_<category> of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(chain)        # fixed size: 1 MB and the weights
    schema = ", ".join(["doc_id bigint", *[f"p_{x} double" for x in chain.names]])
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(_scored(shared), schema)


def op1_toxicity_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Categories of the labels table: junk, toxic, and toxic junk."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    quality, toxic = F.col("quality"), F.col("toxic")
    chain = fit_chain(docs, labels, {"junk": 1 - quality, "toxic": toxic, "toxic_junk": toxic * (1 - quality)})
    return score_chain(docs, chain).withColumn("toxic", (F.col("p_toxic") >= 0.5).cast("int"))
