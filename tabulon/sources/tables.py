"""Table scans and result sinks.

All scans are lazy parquet/CSV/text reads, so Catalyst prunes columns and
pushes filters into the scan. Sinks write through Spark's committers; fold
results are written partitioned so a job that dies keeps finished folds and a
rerun overwrites only what it recomputes.
"""

from __future__ import annotations

import hashlib
import os

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.exprs import NUMBER_PATTERN


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Typed parquet scan of one driver table."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def read_raw_csv(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """CSV scan with every column a string and no NA parsing.

    Empty fields stay empty strings, so the missing token is the only missing
    marker, as in the raw study table.
    """
    schema = T.StructType([T.StructField(c, T.StringType(), True) for c in columns])
    df = (spark.read.schema(schema)
          .option("header", "true")
          .option("nullValue", "\u0000never\u0000")
          .option("emptyValue", "")
          .option("mode", "FAILFAST")
          .csv(path))
    # the null marker never matches, so a NULL can only be an unquoted empty field
    return df.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in columns])


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: list[str] | None = None) -> None:
    """S3: result sink (overwrite with header for CSV)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w = w.option("header", "true")
    w.format(fmt).save(path)


def append_partitions(df: DataFrame, path: str, by: list[str]) -> None:
    """Write finished (configuration, fold) rows; reruns replace only their partitions."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*by).parquet(path))


def write_settings(df: DataFrame, path: str) -> None:
    """One-row settings record as JSON."""
    df.coalesce(1).write.mode("overwrite").json(path)


def read_settings(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Settings read back with an explicit schema (no inferred NaN depths)."""
    return spark.read.schema(schema).json(path)


def patch_settings(df: DataFrame, struct_col: str, field: str, value) -> DataFrame:
    """Replace one key of a nested settings struct."""
    return df.withColumn(struct_col, F.col(struct_col).withField(field, F.lit(value)))


def snapshot(df: DataFrame, path: str) -> None:
    """Keep the first snapshot; later calls leave it untouched."""
    df.write.mode("ignore").parquet(path)


def _missing(e: AnalysisException) -> bool:
    return (e.getCondition() or "").startswith("PATH_NOT_FOUND")


def reuse_or_compute(spark: SparkSession, path: str, compute, settings: str = "") -> DataFrame:
    """Reuse a stored parameter table when one is stored for the same
    ``settings``, else compute and store it.

    Tables lie under a fingerprint of the settings, so other settings never
    reuse them. Only an absent path counts as absent: any other read error is
    raised and nothing is overwritten."""
    at = f"{path}/settings={hashlib.sha256(settings.encode()).hexdigest()[:16]}"
    try:
        return spark.read.parquet(at)
    except AnalysisException as e:
        if not _missing(e):
            raise
    compute().write.mode("error").parquet(at)
    return spark.read.parquet(at)


def extract_log_table(spark: SparkSession, path: str) -> DataFrame:
    """plain/tuned macro F1 per k from log lines, matched on k."""
    lines = spark.read.text(path)
    plain = (lines.filter(F.col("value").rlike(r"k=\d+: plain"))
             .select(F.regexp_extract("value", r"k=(\d+): plain", 1).cast("int").alias("k"),
                     F.regexp_extract("value", r"plain[^=]*= ([\d.]+)", 1).cast("double").alias("plain")))
    tuned = (lines.filter(F.col("value").rlike(r"k=\d+: .*tuned"))
             .select(F.regexp_extract("value", r"k=(\d+):", 1).cast("int").alias("k"),
                     F.regexp_extract("value", r"tuned[^=]*= ([\d.]+)", 1).cast("double").alias("tuned")))
    return plain.join(tuned, "k", "inner")


def extract_numeric_pairs(spark: SparkSession, path: str,
                          pattern: str = r"\\newcommand\{\\(\w+)\}\{([^}]*)\}") -> DataFrame:
    """(name, value) pairs from generated text, numeric-looking values only."""
    lines = spark.read.text(path)
    pairs = lines.select(F.explode(F.regexp_extract_all("value", F.lit(pattern), 0)).alias("m"))
    out = pairs.select(F.regexp_extract("m", pattern, 1).alias("name"),
                       F.regexp_extract("m", pattern, 2).alias("value"))
    return out.filter(F.col("value").rlike(NUMBER_PATTERN))


def count_tables(spark: SparkSession, paths: dict[str, str], group_of: dict[str, str]) -> DataFrame:
    """Row counts of many result tables, absent tables count 0, summed by group."""
    parts = []
    for name, p in paths.items():
        try:
            df = spark.read.parquet(p).select(F.count(F.lit(1)).alias("n"))
        except AnalysisException as e:
            if not _missing(e):
                raise
            df = spark.range(1).select(F.lit(0).cast("bigint").alias("n"))
        parts.append(df.select(F.lit(group_of.get(name, name)).alias("group"), "n"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.groupBy("group").agg(F.sum("n").alias("n"))
