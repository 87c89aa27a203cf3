"""Benchmark decontamination: n-gram and rare-word seeds, Smith-Waterman alignment.

Test items are read in blocks of at most ``ITEM_BYTES`` of text (one block for
any usual benchmark), so what is broadcast has a fixed bound; every document is
compared with every block. Words are aligned locally (match 2, mismatch -1, gap
-1), which finds paraphrased and edited copies; the score is divided by that of
a verbatim copy, and a document holds an item from ``threshold`` on.

No pair that reaches the threshold is lost. An alignment either has ``SEED``
matching words in a row, and so an n-gram of the item, or each of its runs of
matches is shorter; then the mismatches and gaps between the runs cost so much
that it must match a known number of the item's words, and so one of the item's
rarest words (`_rarest`; about a third of a long item, the whole of a tiny one).
Both are the seeds. Which words are rare is counted over all documents;
the counts decide how much work is done, never what is found. The words around
the hits, as far as an alignment of that score can reach, make a region. A
region's words that the item has count 2 and others -1; where no stretch of it
sums up to the threshold no alignment can, and the rest is aligned.

Words are lower-cased (A-Z). Items without words match nothing. Null texts have
no words; null doc_ids and item_ids are carried through (rows with a null doc_id
count as one document). Rows that repeat a doc_id or item_id give one row per
(doc_id, item_id), the best match. Empty tables give no rows; other columns are
ignored; texts are never cut."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .buckets import in_sorted, one
from .common import frugal, table
from .words import Words, chunks, mix, split

SEED = 3
ITEM_BYTES = 16 << 20
THRESHOLD = 0.5
PART = 1 << 20                # words of regions looked at together
_REGION = "doc_id bigint, item int, first bigint, words binary"


def _rarest(n: int, threshold: float, seed: int) -> int:
    """Of how many of an item's ``n`` words every alignment that reaches the
    threshold without ``seed`` matches in a row must match one. With m matches
    in runs of at most seed - 1 it scores 2 m - (m / (seed - 1) - 1) or less."""
    need = max(threshold * 2 * n / 2, (threshold * 2 * n - 1) * (seed - 1) / (2 * seed - 3) if seed > 1 else 0, 1)
    return n - min(n, int(np.ceil(need - 1e-9))) + 1


def _keys(item: np.ndarray, word: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(word + item.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


class Items:
    """Hashed words and seeds of one block of test items."""

    def __init__(self, w: Words, threshold: float, seed: int, df: np.ndarray):
        """``df``: how often each word of ``np.unique(w.hash)`` was counted."""
        self.words = [w.hash[s:e] for s, e in zip(w.first, w.first[1:])]
        self.sizes, text = w.counts(), w.text_of()
        self.least = threshold * 2 * self.sizes
        # an alignment of that score takes at most so many words of a document
        self.reach = np.ceil(3 * self.sizes - self.least).astype(np.int64)
        self.known = np.sort(_keys(text, w.hash))
        h, whole = w.grams(seed)
        at = np.flatnonzero(whole)
        self.gram, self.gram_item = _pairs(h[at], text[at])
        order = np.lexsort((w.hash, df[np.searchsorted(np.unique(w.hash), w.hash)], text))
        most = np.array([_rarest(int(n), threshold, seed) for n in self.sizes], np.int64)
        at = order[np.arange(len(order)) - w.first[text] < most[text]]
        self.word, self.word_item = _pairs(w.hash[at], text[at])


def _pairs(h: np.ndarray, item: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (hash, item), sorted."""
    order = np.lexsort((item, h))
    h, item = h[order], item[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (item[1:] != item[:-1])
    return h[new], item[new]


def _hits(h: np.ndarray, at: np.ndarray, keys: np.ndarray, items: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, item) of each hash that is a seed of an item."""
    hit = np.flatnonzero(in_sorted(h, keys))
    lo, hi = np.searchsorted(keys, h[hit]), np.searchsorted(keys, h[hit], "right")
    n = hi - lo
    entry = np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    return np.repeat(at[hit], n), items[entry]


def _possible(word: np.ndarray, items: Items, item: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Which regions have a stretch that sums up to the threshold."""
    out = np.zeros(len(item), bool)
    ends = np.cumsum(last - first)
    s = 0
    while s < len(item):
        e = max(s + 1, int(np.searchsorted(ends, (ends[s - 1] if s else 0) + PART, "right")))
        size = (last - first)[s:e]
        head = np.cumsum(size) - size
        place = np.arange(size.sum()) - np.repeat(head - first[s:e], size)
        step = np.where(in_sorted(_keys(np.repeat(item[s:e], size), word[place]), items.known), 2, -1)
        total = np.cumsum(step)
        before = total - step
        # lowest sum so far within the region: later regions lie ever lower
        drop = np.repeat(np.arange(e - s) * (3 * len(step) + 1), size)
        low = np.minimum.accumulate(before - drop) + drop
        out[s:e] = np.maximum.reduceat(total - low, head) >= items.least[item[s:e]]
        s = e
    return out


def _regions(block, seed: int):
    """Hashed words around all seeds, by document and item."""
    def run(batches):
        items = block.value
        for b in batches:
            column = one(pa.chunked_array([b.column(1)]))
            for s, e in chunks(column):
                w = split(column.slice(s, e - s), lower=True)
                h, whole = w.grams(seed)
                full = np.flatnonzero(whole)
                hits = (_hits(h[full], full, items.gram, items.gram_item),
                        _hits(w.hash, np.arange(len(w.hash)), items.word, items.word_item))
                at, item = (np.concatenate(x) for x in zip(*hits))
                if not len(at):
                    continue
                text = w.text_of()[at]
                order = np.lexsort((at, item, text))
                at, item, text = at[order], item[order], text[order]
                new = np.ones(len(at), bool)
                new[1:] = (text[1:] != text[:-1]) | (item[1:] != item[:-1]) | (np.diff(at) > 2 * items.reach[item[1:]])
                head = np.flatnonzero(new)
                tail = np.append(head[1:], len(at))
                item, text = item[head], text[head]
                first = np.maximum(w.first[text], at[head] - items.reach[item])
                last = np.minimum(w.first[text + 1], at[tail - 1] + items.reach[item])
                ok = _possible(w.hash, items, item, first, last)
                item, text, first, last = item[ok], text[ok], first[ok], last[ok]
                yield pa.RecordBatch.from_arrays([
                    b.column(0).slice(s, e - s).take(pa.array(text)), pa.array(item.astype(np.int32)),
                    pa.array(first - w.first[text], pa.int64()),
                    pa.array([w.hash[x:y].tobytes() for x, y in zip(first, last)], pa.binary())],
                    ["doc_id", "item", "first", "words"])
    return run


def _counted(block):
    """How often each word of the items (sorted hashes) occurs."""
    def run(batches):
        keys = block.value
        total = np.zeros(len(keys), np.int64)
        for b in batches:
            column = one(pa.chunked_array([b.column(0)]))
            for s, e in chunks(column):
                h = split(column.slice(s, e - s), lower=True).hash
                total += np.bincount(np.searchsorted(keys, h[in_sorted(h, keys)]), minlength=len(keys))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], ["word", "n"])
    return run


def local_alignment(item: np.ndarray, regions: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smith-Waterman scores of one item against rows of ``regions`` (padded,
    with their sizes), and the end (exclusive) of the best alignment in each."""
    rows, width = regions.shape
    inside = np.arange(width) < sizes[:, None]
    ramp = np.arange(width, dtype=np.int32)
    above = np.zeros((rows, width + 1), np.int32)
    best, end = np.zeros(rows, np.int32), np.zeros(rows, np.int64)
    for word in item:
        same = (regions == word) & inside
        h = np.maximum(np.where(same, above[:, :-1] + 2, above[:, :-1] - 1), above[:, 1:] - 1)
        h = np.maximum(h, 0)
        h = np.maximum.accumulate(h + ramp, axis=1) - ramp          # gaps along the region
        above[:, 1:] = h
        top = h.argmax(axis=1)
        value = h[np.arange(rows), top]
        better = value > best
        best[better], end[better] = value[better], top[better] + 1
    return best, end


def _aligned(block, threshold: float):
    def run(batches):
        items = block.value.words
        for b in batches:
            b = b.assign(n=b["words"].map(len) // 8).sort_values(["item", "n"], kind="stable")
            for item, g in b.groupby("item", sort=False):
                words = items[item]
                for at in range(0, len(g), 256):
                    part = g.iloc[at:at + 256]
                    sizes = part["n"].to_numpy()
                    grid = np.zeros((len(part), int(sizes.max())), np.uint64)
                    back = grid.copy()
                    for i, x in enumerate(part["words"]):
                        row = np.frombuffer(x, np.uint64)
                        grid[i, :len(row)], back[i, :len(row)] = row, row[::-1]
                    score, end = local_alignment(words, grid, sizes)
                    ok = score >= threshold * 2 * len(words)
                    if not ok.any():
                        continue
                    _, tail = local_alignment(words[::-1], back[ok], sizes[ok])
                    first = part["first"].to_numpy()[ok]
                    yield pd.DataFrame({"doc_id": part["doc_id"][ok], "item": np.int32(item),
                                        "score": score[ok] / (2.0 * len(words)), "start": first + sizes[ok] - tail,
                                        "end": first + end[ok]})
    return run


def contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, seed: int = SEED,
                 item_bytes: int = ITEM_BYTES) -> DataFrame:
    """(doc_id, item_id, score, start, end): documents that hold an item, the
    alignment score (1: verbatim) and the words it covers."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    tests = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), "text")
    size = tests.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-size // item_bytes) or 1
    out = None
    for k in range(blocks):
        part = tests.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k) if blocks > 1 else tests
        rows = sorted(part.collect(), key=lambda r: (r["item_id"] is None, r["item_id"] or 0, r["text"] or ""))
        found = _block(spark, docs, rows, threshold, seed)
        out = found if out is None else out.unionByName(found)
    best = W.partitionBy("doc_id", "item_id").orderBy(F.desc("score"), "start", "end")
    return out.withColumn("_n", F.row_number().over(best)).filter("_n = 1").drop("_n")


def _block(spark: SparkSession, docs: DataFrame, rows: list, threshold: float, seed: int) -> DataFrame:
    w = split(pa.array([r["text"] for r in rows], pa.string()), lower=True)
    keys = np.unique(w.hash)
    df = np.zeros(len(keys), np.int64)
    share = spark.sparkContext.broadcast(keys)
    for r in docs.select("text").mapInArrow(frugal(_counted(share)), "word bigint, n bigint").groupBy("word").agg(F.sum("n").alias("n")).collect():
        df[r["word"]] = r["n"]                         # one row for each word of the items at most
    block = spark.sparkContext.broadcast(Items(w, threshold, seed, df))        # at most item_bytes of text
    regions = docs.mapInArrow(frugal(_regions(block, seed)), _REGION)
    # regions of one item may be many: spread them evenly before the alignment
    spread = regions.repartition(F.col("doc_id"), F.col("item"), F.col("first"), F.xxhash64("words"))
    hit = spread.mapInPandas(frugal(_aligned(block, threshold)), "doc_id bigint, item int, score double, start bigint, end bigint")
    names = spark.createDataFrame([(i, r["item_id"]) for i, r in enumerate(rows)], "item int, item_id bigint")
    return hit.join(names, "item").select("doc_id", "item_id", "score", "start", "end")


def op10_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
