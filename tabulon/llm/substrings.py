"""Substring deduplication by seed and extend.

Seeds: every run of ``threshold`` words has a winnowed anchor, the smallest
hash among its ``seed`` word n-grams, so two texts that share such a run share
its anchor. Anchors are joined between ranges of documents; only runs around a
shared anchor go on. Extension: all runs that cover a shared seed, to its left
and right, are matched against the other documents, and neighbouring matches
merge into maximal repeats of at least ``threshold`` words. A repeat is removed
wherever its words also start in a document with a smaller doc_id, so the first
document keeps it.

Matches are judged on the input, by equality of 64-bit hashes of whole word
sequences. Nulls: a null text has no words; a null doc_id counts as larger than
every id. Rows with the same doc_id never remove words from each other. Words
are compared unchanged; kept words are joined by one space. Input columns named
like an output column are replaced. An empty table gives no rows; texts are
never cut. A passage that many documents share is sent once per document range."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .buckets import PACKED, bucketed, by_bucket, empty_packed, ids_of, in_sorted, one, packed, unpacked
from .common import frugal, shuffle_parts, table
from .words import Words, chunks, split

THRESHOLD = 13
SEED = 5
REPEATS = "array<struct<start:bigint,length:bigint>>"
ADDED = {"n_words": "bigint", "n_removed": "bigint", "kept_text": "string", "repeats": REPEATS}


def _anchors(w: Words, threshold: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """(anchor, whole): for the run of ``threshold`` words from each word on,
    the smallest seed hash in it."""
    h, _ = w.grams(seed)
    low = h.copy()
    for j in range(1, min(threshold - seed, len(h) - 1) + 1):
        np.minimum(low[:-j], h[j:], out=low[:-j])
    last = np.repeat(w.first[1:], w.counts())
    return low, np.arange(len(h)) + threshold <= last


def _texts(group: pa.Table):
    """Word chunks of a range, in ascending doc_id order: (rows, words)."""
    text = one(group.column("text"))
    for s, e in chunks(text):
        yield s, e, split(text.slice(s, e - s))


def _seeds(parts: int, threshold: int, seed: int):
    def run(key, group):
        found = []
        for _, _, w in _texts(group):
            low, whole = _anchors(w, threshold, seed)
            found.append(np.unique(low[whole]))
        return packed(np.unique(np.concatenate(found)), key[0].as_py(), parts)
    return run


def _shared(key, rows):
    """Keys that two or more ranges hold, back to each of them."""
    keys, bucket = unpacked(rows)
    order = np.argsort(keys, kind="stable")
    keys, bucket = keys[order], bucket[order]
    same = np.zeros(len(keys) + 1, bool)
    same[1:-1] = keys[1:] == keys[:-1]
    both = same[1:] | same[:-1]
    return by_bucket(keys[both], bucket[both], key[0].as_py())


def _earlier(key, rows):
    """Keys that an earlier range holds, back to the later ones."""
    keys, bucket = unpacked(rows)
    order = np.lexsort((bucket, keys))
    keys, bucket = keys[order], bucket[order]
    later = np.zeros(len(keys), bool)
    later[1:] = keys[1:] == keys[:-1]
    return by_bucket(keys[later], bucket[later], key[0].as_py())


def _extend(parts: int, threshold: int, seed: int):
    def run(key, group, anchors):
        if not group.num_rows or not anchors.num_rows:
            return empty_packed()
        known, found = np.sort(unpacked(anchors)[0]), []
        for _, _, w in _texts(group):
            low, whole = _anchors(w, threshold, seed)
            at = np.flatnonzero(whole)
            at = at[in_sorted(low[at], known)]
            found.append(np.unique(w.grams(threshold)[0][at]))
        return packed(np.unique(np.concatenate(found)), key[0].as_py(), parts)
    return run


def _covered(matched: np.ndarray, n: int, threshold: int) -> np.ndarray:
    """Words covered by the runs that start at ``matched``."""
    step = np.zeros(n + 1, np.int32)
    np.add.at(step, matched, 1)
    np.add.at(step, np.minimum(matched + threshold, n), -1)
    return np.cumsum(step[:-1]) > 0


def _kept_texts(w: Words, keep: np.ndarray) -> pa.Array:
    """Kept words of each text joined by one space."""
    data = w.data.copy()
    text = w.text_of()[keep]
    start, end = w.start[keep], w.end[keep]
    step = np.zeros(len(data) + 1, np.int8)
    step[start] += 1
    np.add.at(step, end, -1)
    out = np.cumsum(step[:-1], dtype=np.int8) > 0
    later = np.flatnonzero(np.diff(text, prepend=-1) == 0)
    out[start[later] - 1] = True
    data[start[later] - 1] = 0x20
    size = np.bincount(text, weights=end - start, minlength=len(w.first) - 1).astype(np.int64)
    size += np.bincount(text[later], minlength=len(size))
    ends = np.concatenate([[0], np.cumsum(size)])
    body = data[out].tobytes()
    return pa.Array.from_buffers(pa.large_string(), len(size), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(body)])


def _remove(names: list[str], threshold: int):
    def run(key, group, earlier):
        group = group.take(pa.array(np.argsort(ids_of(group.column("doc_id")), kind="stable")))
        ids = ids_of(group.column("doc_id"))
        known = np.sort(unpacked(earlier)[0]) if earlier.num_rows else np.zeros(0, np.uint64)
        parts, grams, owners = list(_texts(group)), [], []
        for s, _, w in parts:
            h, whole = w.grams(threshold)
            grams.append(h[whole])
            owners.append(w.text_of()[whole] + s)
        h, own = np.concatenate(grams), np.concatenate(owners)
        # rows are in doc_id order: the first row of equal runs has the smallest id
        order = np.argsort(h, kind="stable")
        head = np.maximum.accumulate(np.where(np.diff(h[order], prepend=~h[order[:1]]) != 0, np.arange(len(h)), 0))
        repeat = np.empty(len(h), bool)
        repeat[order] = ids[own[order[head]]] < ids[own[order]]
        repeat |= in_sorted(h, known)
        texts, n_words, n_removed, spans, at = [], [], [], [], 0
        for (_, _, w), g in zip(parts, grams):
            whole = w.grams(threshold)[1]
            start = np.flatnonzero(whole)[repeat[at:at + len(g)]]
            at += len(g)
            cover = _covered(start, len(w.hash), threshold)
            texts.append(_kept_texts(w, ~cover))
            counts = w.counts()
            n_words.append(counts)
            text = w.text_of()
            n_removed.append(np.bincount(text[cover], minlength=len(counts)))
            spans.append(_spans(w, cover, text))
        out = {n: group.column(n) for n in names}
        out |= {"n_words": pa.array(np.concatenate(n_words), pa.int64()),
                "n_removed": pa.array(np.concatenate(n_removed), pa.int64()),
                "kept_text": pa.chunked_array(texts, pa.large_string()).cast(pa.string()),
                "repeats": pa.chunked_array(spans)}
        return pa.table(out)
    return run


def _spans(w: Words, cover: np.ndarray, text: np.ndarray) -> pa.Array:
    """Maximal runs of covered words of each text."""
    n = len(cover)
    new_text = np.diff(text, prepend=-1) != 0
    first = cover & (new_text | ~np.concatenate([[False], cover[:-1]])[:n])
    last = cover & (np.concatenate([new_text[1:], [True]])[:n] | ~np.concatenate([cover[1:], [False]])[:n])
    s, e = np.flatnonzero(first), np.flatnonzero(last) + 1
    per = np.bincount(text[s], minlength=len(w.first) - 1)
    items = pa.StructArray.from_arrays([pa.array(s - w.first[text[s]], pa.int64()), pa.array(e - s, pa.int64())],
                                       ["start", "length"])
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(per)]), pa.int32()), items)


def dedup_substrings(docs: DataFrame, threshold: int = THRESHOLD, seed: int = SEED) -> DataFrame:
    """Columns of ``docs`` with n_words, n_removed, kept_text and repeats (the
    removed maximal runs, in words from the start of the text)."""
    if not 0 < seed <= threshold:
        raise ValueError("a seed has at least one word and at most the threshold")
    parts = shuffle_parts(docs.sparkSession)
    names = [c for c in docs.columns if c not in ADDED and c != "_bucket"]
    laid = bucketed(docs.select(*names))
    ranges = lambda: laid.groupBy("_bucket")  # noqa: E731  one shuffle of the texts serves the three passes
    seeds = ranges().applyInArrow(frugal(_seeds(parts, threshold, seed)), PACKED)
    shared = seeds.groupBy("part").applyInArrow(frugal(_shared), PACKED)
    runs = ranges().cogroup(shared.groupBy("bucket")).applyInArrow(frugal(_extend(parts, threshold, seed)), PACKED)
    earlier = runs.groupBy("part").applyInArrow(frugal(_earlier), PACKED)
    schema = ", ".join([f"`{n}` {docs.schema[n].dataType.simpleString()}" for n in names]
                       + [f"{n} {t}" for n, t in ADDED.items()])
    return ranges().cogroup(earlier.groupBy("bucket")).applyInArrow(frugal(_remove(names, threshold)), schema)


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_substrings(docs).select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


OP6_SQL = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
g AS (SELECT doc_id, i, array_to_string(list_slice(ws, i, i + 12), ' ') AS run
      FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS i FROM w WHERE len(ws) >= 13)),
f AS (SELECT md5(run) AS run, min(doc_id) AS first_id FROM g GROUP BY ALL),
hit AS (SELECT g.doc_id, g.i FROM g JOIN f ON md5(g.run) = f.run WHERE f.first_id < g.doc_id),
cov AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS i FROM hit),
gone AS (SELECT doc_id, count(*) AS n FROM cov GROUP BY doc_id),
k AS (SELECT w.doc_id, len(ws) AS n_words, coalesce(n, 0) AS n_removed FROM w LEFT JOIN gone USING (doc_id)),
one AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS i FROM w),
kept AS (SELECT one.doc_id, string_agg(word, ' ' ORDER BY one.i) AS t FROM one ANTI JOIN cov ON one.doc_id = cov.doc_id AND one.i = cov.i GROUP BY one.doc_id)
SELECT k.doc_id, k.n_words::BIGINT AS n_words, k.n_removed::BIGINT AS n_removed, sha256(coalesce(kept.t, '')) AS kept_sha256
FROM k LEFT JOIN kept USING (doc_id)
"""
