"""Exact order statistics of many columns, also for every held-out fold.

Distinct values are counted once, with one count for each fold. The table of
values is range partitioned by (feature, value) and sorted; only the counts of
each (partition, feature), a handful of numbers, come to the driver. From them
every partition knows how many rows precede it, in all and by fold, so that a
running sum inside the partition places every value for every fold: the rows
before a value without fold f are all rows before it less those of fold f. The
places asked for (two for each probability) are found by binary search where
they lie. One shuffle for the counts and one for the order serve all folds."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.sizing import materialize


def value_counts(df: DataFrame, cols: list[str], fold: str | None = None, folds: list = ()) -> DataFrame:
    """``(feature, value, counts)``: rows with each value, one count for each of
    ``folds`` (one in all without ``fold``). Map-side combined; NULLs are left out."""
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in cols])).alias("_e")
    long = df.select(*([F.col(fold).alias("_f")] if fold else []), each).select(*(["_f"] if fold else []), "_e.*")
    n = [F.count_if(F.col("_f") == f) for f in folds] if fold else [F.count(F.lit(1))]
    return long.filter("value is not null").groupBy("feature", "value").agg(F.array(*n).alias("counts"))


def _interpolated(found: dict, total: int, probs: list[float]) -> list[float]:
    out = []
    for p in probs:
        h = (total - 1) * p
        lo, hi = int(np.floor(h)), int(np.ceil(h))
        a, b = found[lo], found[hi]
        out.append(a if lo == hi else a + (b - a) * (h - lo))
    return out


def order_statistics(counts: DataFrame, probs: Callable[[str, int, int], list[float]], held_out: bool = False,
                     partitions: int | None = None) -> tuple[dict, dict]:
    """Quantiles with linear interpolation from ``(feature, value, counts)``.

    ``probs(feature, i, rows)`` names the probabilities wanted for the i-th
    count of a feature. With ``held_out`` the i-th set of rows is all rows but
    those of the i-th count. Returns ``({(feature, i): quantiles}, {feature:
    distinct values})``; sets without rows have no entry."""
    keys = ["feature", "value"]
    laid = counts.repartitionByRange(partitions, *keys) if partitions else counts.repartitionByRange(*keys)
    laid = materialize(laid.sortWithinPartitions(*keys).withColumn("_pid", F.spark_partition_id()))
    k = len((laid.select("counts").first() or [[]])[0])
    pieces = (laid.groupBy("feature", "_pid").agg(F.count(F.lit(1)).alias("n"), F.array(*[F.sum(F.col("counts")[i]) for i in range(k)]).alias("s"))
              .orderBy("feature", "_pid").collect()) if k else []
    total: dict[str, np.ndarray] = {}
    distinct: dict[str, int] = {}
    before: dict[tuple, np.ndarray] = {}                  # rows before a (feature, partition), by count
    for r in pieces:
        sofar = total.get(r["feature"], np.zeros(k, np.int64))
        before[r["feature"], r["_pid"]] = sofar
        total[r["feature"]] = sofar + np.array(r["s"], np.int64)
        distinct[r["feature"]] = distinct.get(r["feature"], 0) + r["n"]
    rows = {f: (t.sum() - t if held_out else t) for f, t in total.items()}
    asked = {(f, i): probs(f, i, int(n)) for f, t in rows.items() for i, n in enumerate(t) if n}
    places = {}
    for (f, i), ps in asked.items():
        h = (int(rows[f][i]) - 1) * np.array(ps, float)
        places[f, i] = np.unique(np.concatenate([np.floor(h), np.ceil(h)])).astype(np.int64)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run: dict[str, np.ndarray] = {}
        for b in batches:
            feature = b.column(0).to_numpy(zero_copy_only=False)
            value = b.column(1).to_numpy(zero_copy_only=False)
            own = np.asarray(b.column(2).flatten()).reshape(len(value), k)
            pid = b.column(3)[0].as_py() if len(value) else 0
            starts = np.flatnonzero(np.r_[True, feature[1:] != feature[:-1]]) if len(value) else []
            out = {"feature": [], "i": [], "place": [], "value": []}
            for s, e in zip(starts, [*starts[1:], len(value)]):
                name = feature[s]
                first = run.get(name, before[name, pid])
                reach = first + np.cumsum(own[s:e], axis=0)
                run[name] = reach[-1]
                if held_out:
                    first, reach = first.sum() - first, reach.sum(1, keepdims=True) - reach
                for i in range(k):
                    want = places.get((name, i), np.zeros(0, np.int64))
                    want = want[(want >= first[i]) & (want < reach[-1, i])]
                    out["feature"] += [name] * len(want)
                    out["i"] += [i] * len(want)
                    out["place"] += want.tolist()
                    out["value"] += value[s:e][np.searchsorted(reach[:, i], want, side="right")].tolist()
            yield pa.RecordBatch.from_pydict(out, pa.schema([("feature", pa.string()), ("i", pa.int32()), ("place", pa.int64()), ("value", pa.float64())]))

    found: dict[tuple, dict] = {key: {} for key in asked}
    if asked:
        for r in laid.select("feature", "value", "counts", "_pid").mapInArrow(find, "feature string, i int, place bigint, value double").collect():
            found[r["feature"], r["i"]][r["place"]] = r["value"]
    return {key: _interpolated(found[key], int(rows[key[0]][key[1]]), ps) for key, ps in asked.items()}, distinct
