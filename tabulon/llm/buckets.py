"""Documents in contiguous ranges of doc_id, and packed 64-bit keys between them.

A range ("bucket") holds about ``BUCKET_BYTES`` of text. Work inside a range is
done on arrays; between ranges only packed hash keys travel, one row for each
(range, shuffle part) that has any, so a key that a third of all rows hold is
sent once per range and not once per row."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import shuffle_parts

BUCKET_BYTES = 8 << 20
PACKED = "part int, bucket int, keys binary"


def bucketed(docs: DataFrame) -> DataFrame:
    """Add ``_bucket`` (int), ascending with doc_id; equal ids share a range
    and null ids come last."""
    spark = docs.sparkSession
    ids = F.col("doc_id")
    n_bytes = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(-(-n_bytes // BUCKET_BYTES), shuffle_parts(spark))
    cuts = docs.agg(F.percentile_approx(ids.cast("double"), [i / n for i in range(1, n)] or [0.5],
                                        F.lit(max(10_000, 20 * n)))).first()[0] or []
    splits = [float("-inf"), *(sorted(set(cuts)) or [0.0]), float("inf")]
    cast = docs.withColumn("_id", ids.cast("double"))
    return (Bucketizer(splits=splits, inputCol="_id", outputCol="_b", handleInvalid="keep").transform(cast)
            .withColumn("_bucket", F.coalesce(F.col("_b").cast("int"), F.lit(len(splits) - 1))).drop("_id", "_b"))


def ids_of(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """doc_id as int64; null counts as larger than every id."""
    return column.fill_null(np.iinfo(np.int64).max).to_numpy().astype(np.int64)


def one(column: pa.ChunkedArray) -> pa.Array:
    """A column of a group as one array (strings with 64-bit offsets)."""
    if pa.types.is_string(column.type):
        column = column.cast(pa.large_string())
    whole = column.combine_chunks()
    return whole if isinstance(whole, pa.Array) else pa.concat_arrays(whole.chunks)


def packed(keys: np.ndarray, bucket: int, parts: int) -> pa.Table:
    """Rows (part, bucket, keys) of sorted distinct 64-bit keys."""
    part = (keys % np.uint64(parts)).astype(np.int32)
    order = np.argsort(part, kind="stable")
    part, keys = part[order], keys[order]
    at = np.flatnonzero(np.diff(part, prepend=-1))
    ends = np.append(at[1:], len(keys))
    return pa.table({"part": pa.array(part[at], pa.int32()), "bucket": pa.array(np.full(len(at), bucket), pa.int32()),
                     "keys": pa.array([keys[s:e].tobytes() for s, e in zip(at, ends)], pa.binary())})


def unpacked(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """(keys, bucket of each) of packed rows."""
    keys = [np.frombuffer(x, np.uint64) for x in rows.column("keys").to_pylist()]
    n = [len(x) for x in keys]
    return (np.concatenate(keys) if keys else np.zeros(0, np.uint64),
            np.repeat(rows.column("bucket").to_numpy().astype(np.int32), n))


def in_sorted(values: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which values are in the sorted array ``keys``."""
    if not len(keys):
        return np.zeros(len(values), bool)
    at = np.searchsorted(keys, values)
    at[at == len(keys)] = 0
    return keys[at] == values


def empty_packed() -> pa.Table:
    return packed(np.zeros(0, np.uint64), 0, 1)


def by_bucket(keys: np.ndarray, bucket: np.ndarray, part: int) -> pa.Table:
    """Packed rows for the given (key, bucket) pairs, to go back to each range."""
    order = np.argsort(bucket, kind="stable")
    keys, bucket = keys[order], bucket[order]
    at = np.flatnonzero(np.diff(bucket, prepend=-1))
    ends = np.append(at[1:], len(keys))
    return pa.table({"part": pa.array(np.full(len(at), part), pa.int32()), "bucket": pa.array(bucket[at], pa.int32()),
                     "keys": pa.array([keys[s:e].tobytes() for s, e in zip(at, ends)], pa.binary())})
