"""Size guards for broadcasts and blocking."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

MAX_BROADCAST_BYTES = 64 << 20
MAX_LOCAL_ROWS = 10_000
ROWS_PER_TASK = 20_000        # fewer rows are not worth a task of their own


def bounded_broadcast(small: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Broadcast ``small`` only after proving it has at most ``max_bytes``.

    A table of up to ``MAX_LOCAL_ROWS`` rows (a few per class, fold or feature)
    is fetched in one job and becomes a local table. A larger one is
    checkpointed (Spark removes the files once nothing refers to them) and its
    row widths are summed (strings by their octets, 16 bytes for any other value
    and for each row). Beyond the bound it is returned un-hinted and Spark
    shuffles both sides.
    """
    text = [f.name for f in small.schema.fields if f.dataType.simpleString() in ("string", "binary")]
    fixed = 16 * (1 + len(small.columns) - len(text))
    rows = small.limit(MAX_LOCAL_ROWS + 1).collect()
    if len(rows) <= MAX_LOCAL_ROWS:
        n = sum(fixed + sum(len(r[c]) if r[c] is not None else 0 for c in text) for r in rows)
        small = small.sparkSession.createDataFrame(rows, small.schema)
    else:
        small = materialize(small)
        width = F.lit(fixed)
        for c in text:
            width = width + F.coalesce(F.octet_length(c), F.lit(0))
        n = small.agg(F.sum(width.cast("bigint"))).first()[0] or 0
    return F.broadcast(small) if n <= max_bytes else small


def global_rank(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """Add ``name``: the 0-based place of each row in ``order``, without one
    task for all rows: rows are range partitioned and sorted, the layout is
    checkpointed, and only row counts by partition are summed up in order."""
    laid = materialize(df.repartitionByRange(*order).sortWithinPartitions(*order)
                       .withColumn("_pid", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id()))
    counts = laid.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    before = counts.select("_pid", "_first", (F.sum("_n").over(Window.orderBy("_pid")) - F.col("_n")).alias("_before"))
    # one row per partition; ids are consecutive within a partition
    return (laid.join(F.broadcast(before), "_pid")
            .withColumn(name, F.col("_before") + F.col("_at") - F.col("_first")).drop("_pid", "_at", "_first", "_before"))


def join_null_safe(big: DataFrame, small: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi-join that treats NULL keys as equal, so a NULL label or feature is
    a value of its own and its rows are not dropped."""
    ren = small.select(*[F.col(c).alias(f"_j_{c}") if c in keys else F.col(c) for c in small.columns])
    cond = None
    for k in keys:
        e = big[k].eqNullSafe(ren[f"_j_{k}"])
        cond = e if cond is None else cond & e
    return big.join(ren, cond, how).drop(*[f"_j_{k}" for k in keys])


def join_single_rows(*frames: DataFrame) -> DataFrame:
    """Place several one-row aggregate results side by side.

    Every input must be a global aggregate (exactly one row), so the product
    has one row; this is the only unconditioned join in the library.
    """
    out = frames[0]
    for f in frames[1:]:
        out = out.join(F.broadcast(f), how="inner")
    return out


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage for a table reused by several branches of a plan.

    Writes a reliable checkpoint under the session's ``spark.checkpoint.dir``
    (shared storage on a cluster), so a lost executor does not force the
    upstream sorts and shuffles to rerun.
    """
    from ..session import ensure_checkpoint_dir
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def compact(df: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """``df`` for many small jobs: materialized in no more partitions than its
    rows keep busy, one for each ``rows_per_task`` rows. A grouped table that is
    persisted has one for each shuffle partition of the session, however few its
    rows, and every job would start a task for each."""
    laid = materialize(df)
    parts = max(1, -(-laid.count() // rows_per_task))
    return materialize(laid.coalesce(parts)) if laid.rdd.getNumPartitions() > parts else laid


def persist_compact(df: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """``df`` persisted; where it has more partitions than two a core and than one for
    each ``rows_per_task`` rows, materialized in as many instead. Otherwise its layout
    stays, and with it the order in which MLlib sums up weights."""
    held = df.persist()
    parts = max(2 * df.sparkSession.sparkContext.defaultParallelism, -(-held.count() // rows_per_task))
    if held.rdd.getNumPartitions() <= parts:
        return held
    out = materialize(held.coalesce(parts))
    held.unpersist()
    return out
