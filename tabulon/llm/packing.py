"""Best-fit packing of token pieces into sequences of bounded length.

Documents are cut only when they are longer than a sequence: every piece but
the first has the full length, the first takes the rest. Pieces are then
packed by bulk-synchronous best fit. Pieces and gaps are kept as sorted runs
of equal size: a run is (size, first rank, count), so the state of a round is
bounded by the sequence length and not by the number of documents. In each
round a sweep from the largest size down gives every piece its successor, the
smallest gap that holds it; pieces of equal size are served in rank order and
each gap takes one piece. Gaps are then updated, the largest size that found
none opens new sequences, and the next round begins. The rows themselves are
range-sorted by (length, id, piece) once to get their ranks and then look their
place up by rank, so no row ever passes through the driver.

Nulls: a null text has only the end id; a null doc_id is kept and sorts first.
Repeated doc_ids are packed as separate documents. Other columns are ignored;
an empty table gives no rows. Very long texts become many pieces."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, frugal, table, with_running_total
from .tokens import crc32, default_vocabulary, document_ids

CAPACITY = 1024
PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


def piece_starts(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of n ids."""
    if n <= capacity:
        return [(0, n)]
    first = n % capacity
    cuts = ([0] if first else []) + list(range(first, n, capacity))
    return [(s, min(e, n) - s) for s, e in zip(cuts, cuts[1:] + [n])]


def token_pieces(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY) -> DataFrame:
    def run(batches):
        for b in batches:
            out = []
            for doc_id, ids in zip(b.column(0).to_pylist(), document_ids(b.column(1), vocabulary)):
                for k, (s, n) in enumerate(piece_starts(len(ids) // 4, capacity)):
                    out.append((doc_id, k, s, n, crc32(ids[4 * s:4 * (s + n)])))
            cols = list(zip(*out)) or [[]] * 5
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)],
                                             ["doc_id", "piece", "start", "length", "ids_crc32"])
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(frugal(run), PIECES)


def plan_rounds(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Rounds over runs: counts of pieces by length -> placements
    (length, first rank, count, first sequence, offset): the pieces of that
    length with ranks [first, first + count) go to consecutive sequences."""
    left = {n: c for n, c in counts.items() if c}
    taken = dict.fromkeys(left, 0)
    gaps: dict[int, list[tuple[int, int]]] = {}       # size -> [(first sequence, count)]
    placed, opened = [], 0
    while left:
        stack: list[int] = []
        sizes, order, freed = sorted(gaps, reverse=True), sorted(left, reverse=True), []
        at = 0
        for n in order:                                # successor sweep, largest first
            while at < len(sizes) and sizes[at] >= n:
                stack.append(sizes[at])
                at += 1
            while left[n] and stack:
                g = stack[-1]
                first, c = gaps[g].pop()
                k = min(c, left[n])
                if k < c:
                    gaps[g].append((first + k, c - k))
                placed.append((n, taken[n], k, first, capacity - g))
                taken[n] += k
                left[n] -= k
                if g > n:
                    freed.append((g - n, first, k))
                if not gaps[g]:
                    stack.pop()
                    del gaps[g]
        left = {n: c for n, c in left.items() if c}
        for g, first, k in freed:                      # gaps change between rounds only
            gaps.setdefault(g, []).append((first, k))
        if left:
            n = max(left)
            if not any(g >= n for g in gaps):
                k = -(-left[n] // (capacity // n))
                gaps.setdefault(capacity, []).append((opened, k))
                opened += k
    return placed


def best_fit(pieces: DataFrame, capacity: int = CAPACITY, tie: tuple[str, ...] = ("doc_id", "piece", "ids_crc32")) -> DataFrame:
    """Add sequence_id and offset to rows with a ``length`` of 1 to capacity."""
    spark = pieces.sparkSession
    rows = cut(pieces)
    hist = rows.groupBy("length").count().collect()    # at most `capacity` rows
    if any(r["length"] is None or not 0 < r["length"] <= capacity for r in hist):
        raise ValueError(f"lengths must be from 1 to {capacity}")
    counts = {r["length"]: r["count"] for r in hist}
    base, total = {}, 0
    for n in sorted(counts, reverse=True):
        base[n], total = total, total + counts[n]
    runs = sorted((base[n] + first, seq, off) for n, first, _, seq, off in plan_rounds(counts, capacity))
    # one entry per run, bounded by rounds x sizes
    table_ = spark.sparkContext.broadcast(np.array(runs, "int64").reshape(-1, 3))
    ranked = with_running_total(rows, [F.desc("length"), *tie], F.lit(1).cast("bigint"), "_rank")
    names = rows.columns

    def place(batches):
        first, seq, off = table_.value.T
        for b in batches:
            rank = b["_rank"].to_numpy()
            i = np.searchsorted(first, rank, "right") - 1
            yield b.drop(columns="_rank").assign(sequence_id=seq[i] + rank - first[i], offset=off[i])

    schema = ", ".join(f"`{n}` {t}" for n, t in rows.dtypes) + ", sequence_id bigint, offset bigint"
    return ranked.select(*names, "_rank").mapInPandas(frugal(place), schema)


def pack_documents(docs: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of all documents with the sequence and place of each."""
    return best_fit(token_pieces(docs, vocabulary or default_vocabulary(), capacity), capacity)


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))
