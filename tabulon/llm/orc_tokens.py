"""Token-ID output: ORC files of token ids with row indexes and Bloom filters.

One row per document in ascending ``doc_id`` order: ``(doc_id, place, ids)``,
where ``place`` ascends through all files (it orders rows, its numbers have
gaps). The ids are integers, so ORC's run-length encoding bit-packs them; stripes are the unit
of parallel reads, and minimum/maximum row indexes plus a Bloom filter on
``doc_id`` let a lookup skip stripes and row groups.

Nulls: a null text is an empty text (its only id is the end id); a null doc_id
sorts first. Repeated doc_ids are kept as rows of their own, ordered by a hash
of their text; they may lie in several files, and ``start`` follows the files.
Columns other than doc_id and text are ignored. An empty table writes an empty
data set that reads back with the same schema. Texts are never cut."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, shared_folder, table, with_running_total
from .tokens import crc32, default_vocabulary, token_rows

SCHEMA = "doc_id bigint, place bigint, ids array<int>"


def write_tokens(docs: DataFrame, path: str, vocabulary: str, stripe_mb: int = 16, row_index_stride: int = 1000) -> None:
    """Range partition by doc_id, so that every file covers one id range and
    min/max statistics prune files; texts are shuffled, not their ids. The rows
    of one id are told apart by their text's hash and their place in the input,
    so that an id with many rows is spread over several files."""
    keys = ["doc_id", "_hash", "_row"]
    laid = (docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.xxhash64("text").alias("_hash"),
                        F.monotonically_increasing_id().alias("_row"))
            .repartitionByRange(*keys).sortWithinPartitions(*keys)
            .select("doc_id", "text", F.monotonically_increasing_id().alias("place")))
    (token_rows(laid, vocabulary).write.option("orc.bloom.filter.columns", "doc_id")
     .option("orc.bloom.filter.fpp", "0.01").option("orc.create.index", "true")
     .option("orc.row.index.stride", str(row_index_stride)).option("orc.stripe.size", str(stripe_mb << 20))
     .option("compression", "snappy").mode("error").orc(path))


def read_tokens(spark: SparkSession, path: str, doc_ids: list[int] | None = None) -> DataFrame:
    """All documents, or those of ``doc_ids``: that filter is pushed to the ORC
    reader, which prunes stripes by statistics and Bloom filters."""
    df = spark.read.schema(SCHEMA).orc(path)
    return df if doc_ids is None else df.filter(F.col("doc_id").isin(doc_ids))


def digest_tokens(tokens: DataFrame) -> DataFrame:
    """(doc_id, place, n_tokens, ids_crc32) of each row read back."""
    def run(batches):
        for b in batches:
            ids = b.column(2)
            values, ends = ids.values.to_numpy(zero_copy_only=False).astype("<u4"), ids.offsets.to_numpy()
            yield pa.RecordBatch.from_arrays([
                b.column(0), b.column(1), pa.array((ends[1:] - ends[:-1]).astype("int64")),
                pa.array([crc32(values[s:e]) for s, e in zip(ends[:-1], ends[1:])], pa.int64())],
                ["doc_id", "place", "n_tokens", "ids_crc32"])
    return tokens.select("doc_id", "place", "ids").mapInArrow(run, "doc_id bigint, place bigint, n_tokens bigint, ids_crc32 bigint")


def token_output(spark: SparkSession, docs: DataFrame, vocabulary: str | None = None, path: str | None = None) -> DataFrame:
    """Write ``docs`` and return, read back: doc_id, start, n_tokens, ids_crc32."""
    path = path or shared_folder(spark, "tokens-orc")
    write_tokens(docs, path, vocabulary or default_vocabulary())
    rows = cut(digest_tokens(read_tokens(spark, path)))
    return (with_running_total(rows, [F.asc("place")], F.col("n_tokens"), "start")
            .select("doc_id", "start", "n_tokens", "ids_crc32"))


def op9_token_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_output(spark, table(spark, sf_dir, "documents"))
