"""Helpers shared by the text operators: shared folders, lineage cuts, global
ranks and connected components."""

from __future__ import annotations

import functools
import gc
import inspect
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..session import ensure_checkpoint_dir, give_back


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession, what: str) -> str:
    """A new folder (not yet created) under the session's shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{what}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: later jobs restart here when an executor is lost."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def release(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files and checkpoints that nothing refers
    to any more. It does so when the driver's JVM collects its garbage, which
    rounds of small jobs may not bring about for a long time."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def frugal(run: Callable) -> Callable:
    """``run`` for a task (a generator over batches) or a group (a function of
    tables) that gives the memory it needed back when it is done."""
    if inspect.isgeneratorfunction(run):
        @functools.wraps(run)
        def task(*args):
            try:
                yield from run(*args)
            finally:
                give_back()
        return task

    # no functools.wraps: Spark counts the arguments of a group's function
    def done(result):
        give_back()
        return result

    n = len(inspect.signature(run).parameters)
    if n == 3:
        return lambda key, left, right: done(run(key, left, right))
    return lambda key, group: done(run(key, group))


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def with_running_total(df: DataFrame, order: list, value, name: str) -> DataFrame:
    """Add ``name``: the sum of ``value`` over all rows before this one.

    Rows are range partitioned and sorted by ``order``, and the layout is
    checkpointed so that the totals by partition and the rows agree. Only the
    one-row-per-partition totals go through an unpartitioned window."""
    laid = cut(df.withColumn("_v", value).repartitionByRange(*order).sortWithinPartitions(*order)
               .withColumn("_pid", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id()))
    totals = laid.groupBy("_pid").agg(F.sum("_v").alias("_t"))
    before = totals.select("_pid", (F.sum("_t").over(W.orderBy("_pid")) - F.col("_t")).alias("_before"))
    inside = W.partitionBy("_pid").orderBy("_at").rowsBetween(W.unboundedPreceding, W.currentRow)
    return (laid.join(F.broadcast(before), "_pid")
            .withColumn(name, F.col("_before") + F.sum("_v").over(inside) - F.col("_v"))
            .drop("_v", "_pid", "_at", "_before"))


def _forest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Within one task: replace links by (node, smallest node reached), which
    has at most one row per node and keeps every connection."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        top = x
        while (up := parent.setdefault(top, top)) != top:
            top = up
        while parent[x] != top:
            parent[x], x = top, parent[x]
        return top

    for b in batches:
        for u, v in zip(b["a"].tolist(), b["b"].tolist()):
            ru, rv = root(u), root(v)
            if ru != rv:
                parent[max(ru, rv)] = min(ru, rv)
    nodes = [x for x in parent if root(x) != x]
    for i in range(0, len(nodes), 100_000):
        part = nodes[i:i + 100_000]
        yield pd.DataFrame({"a": np.array(part, "int64"), "b": np.array([root(x) for x in part], "int64")})


def components(links: DataFrame) -> DataFrame:
    """Connected components of ``links(a, b)`` (bigint): rows (id, component)
    for every linked id, where component is the smallest id it reaches.

    Alternating large-star and small-star steps over shuffled links, each
    round behind a checkpoint; links are first thinned to a forest inside each
    task. Nulls and self links are ignored, no links give no rows."""
    spark = links.sparkSession
    edges = (links.select(F.col("a").cast("bigint"), F.col("b").cast("bigint"))
             .filter("a is not null and b is not null and a <> b").mapInPandas(_forest, "a bigint, b bigint"))
    edges = cut(edges.distinct())
    if edges.isEmpty():
        return spark.createDataFrame([], "id bigint, component bigint")
    seen = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.filter("a <> b").distinct()          # always a > b
        low2 = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(low2, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(low2.select("a", F.col("m").alias("b"))).filter("a <> b").distinct())
        edges = cut(small)
        del both, low, large, low2, small
        release(spark)
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    out = edges.select(F.col("a").alias("id"), F.col("b").alias("component"))
    return out.unionByName(out.select(F.col("component").alias("id"), "component").distinct())
