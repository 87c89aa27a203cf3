"""Document fingerprints by a randomised edit embedding.

A shared random walk reads a text: at step j it emits the character under the
cursor and a random bit of (j, character), the same for all texts, decides
whether the cursor moves on. Texts at a small edit distance emit strings at a
small Hamming distance, because their walks meet again after an edit. Steps are
bit-sampled by fixed random step numbers: in each doubling range of steps
[2^k, 2^(k+1)) the same ``SAMPLES`` steps are kept for every text, and each kept
step contributes one hashed hex digit of the emitted character. The walk runs
over the whole text, however long, until the cursor leaves it.

A fingerprint is a hex string: the digits of the ranges in order (fewer in the
first ranges, which are shorter than the sample), as far as the walk went.
Steps after the end of the walk have no digit. Likeness of two fingerprints is
the share of equal digits, each range weighted by its number of steps, over the
longer walk; 1 for equal texts, about 1/16 and the chance of equal letters for
unrelated ones.

Near duplicates (``near_classes``): bands of sampled digits are joined as keys,
and each pair of classes found so is verified on the whole fingerprints.

Nulls: a null text is an empty text, with an empty fingerprint (two empty
fingerprints are alike: 1; an empty and another: 0). A null doc_id is the
largest id. Rows with equal doc_ids are ordered by text. Other columns are
ignored; an empty table gives no rows."""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .buckets import bucketed, one
from .common import components, cut, table
from .words import mix

SAMPLES = 64
_COINS = 1 << 16              # the walk's bits repeat after so many steps
_ALPHABET = 256               # characters are hashed to so many letters
_RANGES = 48
_SEED = np.uint64(0x51ED270B4D2C6F95)


def _coins() -> np.ndarray:
    with np.errstate(over="ignore"):
        x = mix(np.arange(_COINS * _ALPHABET // 64, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + _SEED)
    return np.unpackbits(x.view(np.uint8)).reshape(_COINS, _ALPHABET)


def _sampled_steps() -> np.ndarray:
    """Sorted step numbers that every fingerprint keeps."""
    rng, steps = np.random.default_rng(20240607), []
    for k in range(_RANGES):
        lo, n = (0, 2) if k == 0 else (1 << k, 1 << k)
        if n <= SAMPLES:
            steps.append(np.arange(lo, lo + n))
        else:
            steps.append(np.sort(lo + (np.arange(SAMPLES) * n + rng.integers(0, n, SAMPLES)) // SAMPLES))
    return np.concatenate(steps).astype(np.int64)


COINS, STEPS = _coins(), _sampled_steps()
_FLAT_BYTES = COINS.tobytes()
_RANGE_OF = np.where(STEPS < 2, 0, np.floor(np.log2(np.maximum(STEPS, 1))).astype(int))
_WEIGHT = np.array([2.0 ** max(k, 1) for k in range(_RANGES)]) / np.bincount(_RANGE_OF, minlength=_RANGES)
_STEP_WEIGHT = _WEIGHT[_RANGE_OF]
_WEIGHT_TO = np.concatenate([[0.0], np.cumsum(_STEP_WEIGHT)])
_DIGIT = np.array(list(b"0123456789abcdef"), np.uint8)


def letters(text: str) -> np.ndarray:
    """Code points hashed to letters; ASCII and Latin-1 stay themselves."""
    try:
        return np.frombuffer(text.encode("latin-1"), np.uint8)
    except UnicodeEncodeError:
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
        with np.errstate(over="ignore"):
            mixed = (mix(points.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(56)).astype(np.uint8)
        return np.where(points < 256, points.astype(np.uint8), mixed)


def _digits(letter: np.ndarray, step: np.ndarray) -> np.ndarray:
    """The hashed hex digit of a letter at a step."""
    with np.errstate(over="ignore"):
        x = letter.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93) + step.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        x ^= x >> np.uint64(32)
        x *= np.uint64(0xFF51AFD7ED558CCD)
    return _DIGIT[(x >> np.uint64(60)).astype(np.int64)]


_FEW = 24                     # with fewer texts under way, single steps are cheaper than array steps


def walk(texts: list[np.ndarray], tails: list[np.ndarray | None], marks: list[int]) -> tuple[list[bytes], list[bytes]]:
    """Walk many texts side by side. A text with a tail is also walked with
    everything from its mark on replaced by the tail; both share the walk up to
    the mark. Returns the digits kept for the texts and for the edited texts
    (the text's own where its tail is None)."""
    m = len(texts)
    every = [*texts, *(t if t is not None else np.zeros(0, np.uint8) for t in tails)]
    n = np.array([len(t) for t in every], np.int64)
    base = np.concatenate([[0], np.cumsum(n)])
    data = np.concatenate([*every, np.zeros(1, np.uint8)])
    has_tail = np.array([t is not None for t in tails], bool)
    fork = np.full(m, -1, np.int64)                    # step at which the text reached its mark
    lane = np.flatnonzero(n[:m] > 0)
    at, end = base[lane].copy(), base[lane] + n[lane]
    stop = np.where(has_tail[lane], base[lane] + np.array(marks, np.int64)[lane], end)
    lanes, steps, kept = [], [], []
    step, sample = 0, 0

    def turn(lane, at, end, stop, step):
        """Lanes that came to a stop end there, or start their edited twin."""
        here = at == stop
        new = lane[here & (lane < m)]
        new = new[has_tail[new] & (fork[new] < 0)]
        fork[new] = step
        stop = np.where(here, end, stop)
        go = at < end
        twin = new + m
        twin = twin[n[twin] > 0]
        return (np.concatenate([lane[go], twin]), np.concatenate([at[go], base[twin]]),
                np.concatenate([end[go], base[twin + 1]]), np.concatenate([stop[go], base[twin + 1]]))

    while len(lane) >= _FEW:
        c = data[at]
        if STEPS[sample] == step:
            lanes.append(lane)
            steps.append(np.full(len(lane), step))
            kept.append(c)
            sample += 1
        at = at + COINS[step & (_COINS - 1)][c]
        step += 1
        if (at == stop).any():
            lane, at, end, stop = turn(lane, at, end, stop, step)
    if len(lane):
        raw, coins = data.tobytes(), _FLAT_BYTES
        todo = [(int(x), int(a), int(s), step) for x, a, s in zip(lane, at, stop)]
        while todo:
            x, a, to, j = todo.pop()
            k = int(np.searchsorted(STEPS, j))
            due, got_s, got_c = int(STEPS[k]), [], []
            while a < to:
                c = raw[a]
                if j == due:
                    got_s.append(j)
                    got_c.append(c)
                    k += 1
                    due = int(STEPS[k])
                if coins[(j & 65535) << 8 | c]:
                    a += 1
                j += 1
            lanes.append(np.full(len(got_s), x))
            steps.append(np.array(got_s, np.int64))
            kept.append(np.array(got_c, np.uint8))
            if x < m and has_tail[x] and fork[x] < 0:
                fork[x] = j
                if n[x + m]:
                    todo.append((x + m, int(base[x + m]), int(base[x + m + 1]), j))
            last = int(base[x] + n[x])
            if a < last:
                todo.append((x, a, last, j))
    lane_of = np.concatenate(lanes) if lanes else np.zeros(0, np.int64)
    order = np.lexsort((np.concatenate(steps), lane_of)) if lanes else lane_of
    digits = _digits(np.concatenate(kept)[order], np.concatenate(steps)[order]).tobytes() if lanes else b""
    ends = np.concatenate([[0], np.cumsum(np.bincount(lane_of, minlength=2 * m))]).tolist()
    own = [digits[ends[i]:ends[i + 1]] for i in range(m)]
    shared = np.searchsorted(STEPS, fork)
    edited = [own[i][:shared[i]] + digits[ends[m + i]:ends[m + i + 1]] if has_tail[i] else own[i] for i in range(m)]
    return own, edited


def likeness(a: bytes, b: bytes) -> float:
    if not a or not b:
        return float(a == b)
    n, m = min(len(a), len(b)), max(len(a), len(b))
    same = np.frombuffer(a, np.uint8, n) == np.frombuffer(b, np.uint8, n)
    return float(_STEP_WEIGHT[:n][same].sum() / _WEIGHT_TO[m])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, fingerprint) of every row."""
    def run(batches):
        for b in batches:
            texts = [t or "" for t in b.column(1).to_pylist()]
            own, _ = walk([letters(t) for t in texts], [None] * len(texts), [0] * len(texts))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([len(t) for t in texts], pa.int64()),
                                              pa.array([x.decode() for x in own], pa.string())],
                                             ["doc_id", "n_chars", "fingerprint"])
    return (docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
            .mapInArrow(run, "doc_id bigint, n_chars bigint, fingerprint string"))


_ROW = "_bucket int, doc_id bigint, text string"
_OUT = ("doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double")


def _in_order(group) -> tuple[list, list[str]]:
    rows = list(zip(group.column("doc_id").to_pylist(), (t or "" for t in one(group.column("text")).to_pylist())))
    rows.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    return [r[0] for r in rows], [r[1] for r in rows]


def _last_of(lo: int, hi: int):
    """The last document of a range, addressed to the range that follows it."""
    def run(key, group):
        ids, texts = _in_order(group)
        b = key[0].as_py()
        return pa.table({"_bucket": pa.array([lo if b == hi else b + 1], pa.int32()),
                         "doc_id": pa.array(ids[-1:], pa.int64()), "text": pa.array(texts[-1:], pa.string())})
    return run


def _edited(key, group, before):
    """Fingerprints of a range's documents and their edited texts; ``before``
    holds the document that precedes the range."""
    ids, texts = _in_order(group)
    texts = [(before.column("text")[0].as_py() or "") if before.num_rows else "", *texts]
    lets = [letters(t) for t in texts]
    cut_at = [len(t) - len(t) // 2 for t in texts]
    tails = [None] + [lets[i - 1][:len(texts[i]) // 2] for i in range(1, len(texts))]
    own, edited = walk(lets, tails, cut_at)
    k = range(1, len(texts))
    sha = [hashlib.sha256((texts[i][:cut_at[i]] + texts[i - 1][:len(texts[i]) // 2]).encode("utf-8", "surrogatepass")).hexdigest() for i in k]
    return pa.table({
        "doc_id": pa.array(ids, pa.int64()), "n_chars": pa.array([len(texts[i]) for i in k], pa.int64()),
        "edited_sha256": pa.array(sha, pa.string()), "fingerprint": pa.array([own[i].decode() for i in k], pa.string()),
        "edited_fingerprint": pa.array([edited[i].decode() for i in k], pa.string()),
        "near_edited": pa.array([likeness(own[i], edited[i]) for i in k], pa.float64()),
        "near_next": pa.array([likeness(own[i], own[i - 1]) for i in k], pa.float64())})


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprint of every text, and of the text whose last half is replaced
    by the start of the document before it in doc_id order (the first one
    takes from the last). One shuffle of the texts by id range serves both the
    hand-over between ranges and the walks."""
    laid = bucketed(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"))
    ends = laid.agg(F.min("_bucket"), F.max("_bucket")).first()
    if ends[0] is None:
        return docs.sparkSession.createDataFrame([], _OUT)
    before = laid.groupBy("_bucket").applyInArrow(_last_of(ends[0], ends[1]), _ROW)
    return laid.groupBy("_bucket").cogroup(before.groupBy("_bucket")).applyInArrow(_edited, _OUT)


BAND = 8


def _bands(batches):
    """Keys of BAND neighbouring digits in the last two doubling ranges (all
    digits of a shorter fingerprint)."""
    starts = np.searchsorted(_RANGE_OF, np.arange(_RANGES))
    for b in batches:
        keys, ids = [], []
        for i, fp in zip(b["id"], b["fingerprint"]):
            k = int(_RANGE_OF[max(len(fp) - 1, 0)])
            lo = int(starts[max(k - 1, 0)])
            cuts = range(lo - lo % BAND, len(fp) - BAND + 1, BAND) if len(fp) >= BAND else range(0, 1)
            for p in cuts:
                keys.append(f"{p}:{fp[p:p + BAND]}")
                ids.append(i)
        yield pd.DataFrame({"band": keys, "id": np.array(ids, "int64")})


def near_classes(docs: DataFrame, threshold: float = 0.8) -> DataFrame:
    """(doc_id, fingerprint, class_id) of every row: rows with equal
    fingerprints are one class; classes that share a band and whose whole
    fingerprints reach the threshold are merged. class_id is the smallest
    doc_id of the merged class (null for a null doc_id of its own).

    Each band's list is first verified against its smallest class; then only
    pairs of classes that are still apart are made."""
    prints = cut(fingerprints(docs).select("doc_id", "fingerprint"))
    classes = cut(prints.filter("doc_id is not null").groupBy("fingerprint").agg(F.min("doc_id").alias("id")))
    bands = cut(classes.filter("fingerprint <> ''").mapInPandas(_bands, "band string, id bigint"))
    hubs = bands.groupBy("band").agg(F.min("id").alias("a"), F.max("id").alias("_z")).filter("a <> _z").select("band", "a")

    def verified(pairs: DataFrame) -> DataFrame:
        fp = classes.select("id", "fingerprint")
        both = pairs.join(fp.toDF("a", "fa"), "a").join(fp.toDF("b", "fb"), "b")

        def run(batches):
            for b in batches:
                ok = [likeness(x.encode(), y.encode()) >= threshold for x, y in zip(b["fa"], b["fb"])]
                yield b.loc[ok, ["a", "b"]]
        return cut(both.select("a", "b", "fa", "fb").mapInPandas(run, "a bigint, b bigint"))

    near = verified(bands.join(hubs, "band").filter("a <> id").select("a", F.col("id").alias("b")).distinct())
    found = components(near)
    here = bands.join(found, "id", "left").select("band", "id", F.coalesce("component", "id").alias("c"))
    apart = here.groupBy("band").agg(F.min("c").alias("x"), F.max("c").alias("y")).filter("x <> y").select("band")
    here = here.join(apart, "band", "left_semi")
    pairs = (here.toDF("band", "a", "ca").join(here.toDF("band", "b", "cb"), "band").filter("a < b and ca <> cb")
             .select("a", "b").distinct())
    groups = components(near.unionByName(verified(pairs)))
    merged = classes.join(groups, "id", "left").select("fingerprint", F.coalesce("component", "id").alias("class_id"))
    return prints.join(merged, "fingerprint", "left").select("doc_id", "fingerprint", "class_id")


def op5_edit_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_fingerprints(table(spark, sf_dir, "documents"))
