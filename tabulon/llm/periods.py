"""Periodic runs of words: stretches in which the same words come back at a
fixed distance, at least four times over.

A run is a stretch of consecutive words with smallest period q and a length of
at least ``max(6, 4 * q)`` that no neighbouring word extends keeping period q.
Within a run every word occurs four times or more, so a word that occurs less
often in a segment of the text cannot belong to a run inside it and splits the
segment; the parts are counted again until no word is rare. What is left is
scanned by lag: for lags from Q to 2Q - 1 the places are Q words apart, since
any run of such a period covers four equal words that begin at one of them, so
a segment of n words takes n comparisons for each doubling of the lag. The few
candidates are compared in full on the words, never on hashes.

Each document is worked on where it lies: one map, no shuffle. Memory grows
with one text at a time. Defined results: null, empty and white-space texts
have no words and no runs, and collapse to an empty text; rows that repeat a
doc_id or a whole document are separate rows; a null doc_id is kept; an empty
table gives no rows. All columns of the input are kept, and the operator's own
columns (n_words, runs, collapsed_text) replace columns of these names."""

from __future__ import annotations

from collections import defaultdict
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

MIN_WORDS, MIN_TIMES = 6, 4
GRID = 1 << 20                # cells (place, lag) looked at together
_RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"


def segments(ids: np.ndarray) -> list[tuple[int, int]]:
    """Stretches [start, end) that no rare word splits: within each, every word
    occurs at least MIN_TIMES times."""
    at = np.arange(len(ids))
    where = np.zeros(len(ids), np.int64)                     # the segment of each place that is left
    while len(at):
        word = ids[at]
        order = np.lexsort((word, where))
        w, s = word[order], where[order]
        first = np.flatnonzero(np.r_[True, (w[1:] != w[:-1]) | (s[1:] != s[:-1])])
        times = np.diff(np.r_[first, len(w)])
        often = np.empty(len(at), bool)
        often[order] = np.repeat(times >= MIN_TIMES, times)
        kept, was = at[often], where[often]
        new = np.ones(len(kept), bool)
        new[1:] = (np.diff(kept) > 1) | (was[1:] != was[:-1])
        starts = np.flatnonzero(new)
        length = np.diff(np.r_[starts, len(kept)])
        long = length >= MIN_WORDS
        if often.all():
            return [(int(kept[i]), int(kept[i]) + int(n)) for i, n in zip(starts[long], length[long])]
        stay = np.repeat(long, length)
        at, where = kept[stay], np.repeat(np.arange(len(starts)), length)[stay]
    return []


def _extent(ids: np.ndarray, i: int, q: int) -> tuple[int, int]:
    """Start and end of the stretch around i in which words q apart are equal."""
    n = len(ids) - q
    end, step = i, 64
    while end < n:
        differ = np.flatnonzero(ids[end:min(end + step, n)] != ids[end + q:min(end + step, n) + q])
        if len(differ):
            end += int(differ[0])
            break
        end, step = min(end + step, n), step * 2
    start, step = i, 64
    while start > 0:
        low = max(start - step, 0)
        differ = np.flatnonzero(ids[low:start] != ids[low + q:start + q])
        if len(differ):
            start = low + int(differ[-1]) + 1
            break
        start, step = low, step * 2
    return start, end + q


def _candidates(ids: np.ndarray, start: int, end: int, lag: int, known: tuple[np.ndarray, np.ndarray]):
    """(place, q) for q from lag to 2 lag - 1 where words i, i+q, i+2q, i+3q are
    equal, and so are those at up to 16 places after them, unless a shorter
    known period holds there (``known``: ends of the known run that reaches
    farthest, by start)."""
    runs_start, runs_end = known
    places = np.arange(start, end - 3 * lag, lag)
    step = max(1, GRID // lag)
    for p in range(0, len(places), step):
        for low in range(lag, 2 * lag, GRID):
            i = places[p:p + step, None]
            q = np.arange(low, min(low + GRID, 2 * lag))[None, :]
            far = np.minimum(i + 3 * q, len(ids) - 1)
            ok = (i + 3 * q < end) & (ids[i] == ids[np.minimum(i + q, len(ids) - 1)]) & (ids[i] == ids[far])
            r, c = np.nonzero(ok)
            i, q = i[r, 0], q[0, c]
            if len(runs_start) and len(i):
                at = np.searchsorted(runs_start, i, "right") - 1
                inside = (at >= 0) & (runs_end[np.maximum(at, 0)] >= i + 2 * q)
                i, q = i[~inside], q[~inside]
            for k in range(16):
                t = k * q // 16
                same = (ids[i + t] == ids[i + t + q]) & (ids[i + t] == ids[i + t + 2 * q])
                i, q = i[same], q[same]
            yield from zip(i.tolist(), q.tolist())


def find_runs(ids: np.ndarray) -> list[tuple[int, int, int]]:
    """All runs (start, length, period) of a sequence of word numbers, by start
    and period.

    A place is skipped for lag q if a run of a shorter period d covers the 2q
    words from there on: two periods on a stretch of q + d words or more have
    their common divisor for period, so q would not be the smallest."""
    found: list[tuple[int, int, int]] = []
    for start, end in segments(ids):
        here: list[tuple[int, int, int]] = []
        lag = 1
        while 4 * lag <= end - start:
            known = sorted((s, s + n) for s, n, _ in here)
            reach = (np.array([s for s, _ in known], np.int64),
                     np.maximum.accumulate(np.array([e for _, e in known], np.int64)) if known else np.zeros(0, np.int64))
            covered: dict[int, int] = defaultdict(lambda: -1)
            for i, q in _candidates(ids, start, end, lag, reach):
                if i < covered[q]:
                    continue
                s, e = _extent(ids, i, q)
                if e > i + q:
                    covered[q] = e - q
                at = np.searchsorted(reach[0], s, "right") - 1
                if e - s >= max(MIN_WORDS, MIN_TIMES * q) and (at < 0 or reach[1][at] < e):   # q is the smallest period
                    here.append((s, e - s, q))
            lag *= 2
        found += here
    return sorted(found, key=lambda r: (r[0], r[2]))


def _work(batches):
    for b in batches:
        text = b.column(b.schema.get_field_index("text"))
        n_words, runs, left = [], [], []
        for t in text:
            words = (t.as_buffer().to_pybytes() if t.is_valid else b"").split()
            number = defaultdict(count().__next__)
            ids = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
            mine = find_runs(ids)
            gone = np.zeros(len(words), bool)
            for s, n, q in mine:
                gone[s + q:s + n] = True
            n_words.append(len(words))
            runs.append([{"start": s, "length": n, "period": q} for s, n, q in mine])
            left.append(b" ".join([words[i] for i in np.flatnonzero(~gone).tolist()] if mine else words))
        own = {"n_words": pa.array(n_words, pa.int64()),
               "runs": pa.array(runs, pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))),
               "collapsed_text": pa.array(left, pa.binary()).cast(pa.string())}
        yield pa.RecordBatch.from_arrays([*b.columns, *own.values()], [*b.schema.names, *own])


def periodic_runs(docs: DataFrame) -> DataFrame:
    """docs(text, ...) with n_words, runs (start, length, period; by start, then
    period) and collapsed_text: the words outside all runs and the first period
    of each run, joined by one space."""
    own = {"n_words", "runs", "collapsed_text"}
    kept = docs.select(*[c for c in docs.columns if c not in own])
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields)
    return kept.mapInArrow(_work, f"{fields}, n_words bigint, runs {_RUNS}, collapsed_text string")


def planted(doc_id: Column, text: Column) -> Column:
    """The text with a period planted in it for ids whose crc32 ends in 0:
    from word a = g % n on, words repeat with period 1 + floor((n - a) / (3 + g % 8)),
    where g = floor(crc32 / 10). Other texts, and null ids, stay as they are."""
    h = F.crc32(doc_id.cast("string"))
    g = F.floor(h / 10)
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")

    def repeated(x):
        n = F.size(x["w"])
        a = (x["g"] % n).cast("int")
        p = (F.lit(1) + F.floor((n - a) / (F.lit(3) + x["g"] % 8))).cast("int")
        place = F.sequence(F.lit(0), n - 1)
        return F.array_join(F.transform(place, lambda i: x["w"][F.when(i < a, i).otherwise(a + (i - a) % p)]), " ")

    one = F.transform(F.array(F.struct(words.alias("w"), g.alias("g"))),
                      lambda x: F.when(F.size(x["w"]) > 0, repeated(x)))[0]
    return F.when(h % 10 == 0, F.coalesce(one, text)).otherwise(text)


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of all documents after planting; the strongest run of each, and
    digests of all runs and of the collapsed text."""
    docs = table(spark, sf_dir, "documents").select("doc_id", planted(F.col("doc_id"), F.col("text")).alias("text"))
    found = periodic_runs(docs)

    def weaker(x, y):       # exact: length / period by cross-multiplication
        a, b = x["length"] * y["period"], y["length"] * x["period"]
        return (F.when(a != b, F.when(a > b, -1).otherwise(1))
                .when(x["start"] != y["start"], F.when(x["start"] < y["start"], -1).otherwise(1))
                .when(x["period"] < y["period"], -1).when(x["period"] > y["period"], 1).otherwise(0))

    best = F.get(F.array_sort("runs", weaker), F.lit(0))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    return (found.withColumn("best", best)
            .select("doc_id", F.size("runs").cast("bigint").alias("n_runs"), "best.start", "best.length", "best.period",
                    F.floor(F.lit(1000) * F.col("best.length") / F.col("best.period")).cast("bigint").alias("exponent_milli"),
                    F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed_text", 256).alias("collapsed_sha256")))


OP13_SQL = """
WITH crc_table AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, b: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS c
    FROM (SELECT unnest(range(256)) AS i))),
d AS (
  SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w,
    xor(4294967295, list_reduce(
      list_concat([4294967295], list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
      lambda a, b: xor(a // 256, t[CAST(xor(a, b) & 255 AS BIGINT) + 1]))) AS h
  FROM documents, crc_table),
plan AS (
  SELECT row, doc_id, w, len(w) AS n, coalesce(h % 10 = 0, false) AND len(w) > 0 AS plant, h // 10 AS g,
    CASE WHEN len(w) > 0 THEN (h // 10) % len(w) END AS a FROM d),
placed AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p, unnest(range(n)) AS i FROM plan),
word AS (
  SELECT row, n, i, w[CASE WHEN plant AND i >= a THEN a + (i - a) % p ELSE i END + 1] AS word FROM placed),
pair AS (
  SELECT x.row, x.i, y.i - x.i AS q FROM word x JOIN word y ON x.row = y.row AND x.word = y.word AND y.i > x.i AND 4 * (y.i - x.i) <= x.n),
island AS (
  SELECT row, q, min(i) AS start, count(*) + q AS length
  FROM (SELECT row, q, i, i - row_number() OVER (PARTITION BY row, q ORDER BY i) AS k FROM pair) GROUP BY row, q, k),
long AS (SELECT * FROM island WHERE length >= greatest(6, 4 * q)),
run AS (
  SELECT * FROM long l WHERE NOT EXISTS (
    SELECT 1 FROM long s WHERE s.row = l.row AND s.q < l.q AND s.start <= l.start AND s.start + s.length >= l.start + l.length)),
listed AS (
  SELECT row, count(*) AS n_runs, string_agg(start || ',' || length || ',' || q || chr(10), '' ORDER BY start, q) AS lines FROM run GROUP BY row),
best AS (
  SELECT * FROM run QUALIFY row_number() OVER (PARTITION BY row
    ORDER BY CAST(length AS DECIMAL(38, 0)) * 1000000000000 // q DESC, start, q) = 1),
gone AS (SELECT DISTINCT row, unnest(range(start + q, start + length)) AS i FROM run),
kept AS (
  SELECT w.row, string_agg(word, ' ' ORDER BY w.i) AS text FROM word w LEFT JOIN gone g ON g.row = w.row AND g.i = w.i
  WHERE g.i IS NULL GROUP BY w.row)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, start, length, q AS period, 1000 * length // q AS exponent_milli,
  sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(text, '')) AS collapsed_sha256
FROM plan LEFT JOIN listed USING (row) LEFT JOIN best USING (row) LEFT JOIN kept USING (row)
"""
