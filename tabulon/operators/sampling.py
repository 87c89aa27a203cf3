"""Stratified splitting, folding, probing and oversampling targets (K1-K5, K7).

Order within a class is the md5 of ``'<seed>-<key>'`` (then the key), so a
row's place never depends on partitioning and DuckDB reproduces it.

Ranking without a skewed window: a class holding a third of all rows would
be one task under ``row_number() over (partition by class)``. Instead rows are
bucketed by the first ``digits`` hex digits of their hash (at least 16 buckets
for every shuffle partition of the session, so buckets shrink as the cluster is
sized up), bucket sizes are counted per class, prefix-summed, joined back, and
``row_number`` runs inside (class, bucket). The result equals the global
window because buckets are prefixes of the sort key. The class is coded to a
key that is never null, so that the join and the window hash rows by the same
two columns and the rows are shuffled once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import hash_hex
from ..plans.sizing import bounded_broadcast, join_null_safe

SYNTHETIC_BLOCK = 100_000


def _key(key) -> Column:
    return F.col(key) if isinstance(key, str) else key


def _digits(df: DataFrame, digits: int | None) -> int:
    """Hex digits for at least 16 buckets a shuffle partition (3 or more)."""
    if digits is not None:
        return digits
    n = 16 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(3, len(f"{n - 1:x}"))


def _class_key(label: str) -> Column:
    """The class as a string that is never null; "0" is the null class."""
    return F.coalesce(F.concat(F.lit("1"), F.col(label).cast("string")), F.lit("0"))


def _hashed(df: DataFrame, key, label: str, seed: int, digits: int | None) -> DataFrame:
    digits = _digits(df, digits)
    return (df.withColumn("_h", hash_hex(seed, _key(key))).withColumn("_b", F.substring("_h", 1, digits))
            .withColumn("_c", _class_key(label)))


def bucket_counts(df: DataFrame, key, label: str, seed: int = 42, digits: int | None = None) -> DataFrame:
    """Rows per (class, hash bucket): at most classes x 16^digits rows.

    Reads the key and the label only, so it is counted again where a split needs
    it twice (quotas in the driver's job, offsets in the rows' plan)."""
    return (_hashed(df.select(label, _key(key).alias("_k")), "_k", label, seed, digits).groupBy("_c", "_b")
            .agg(F.first(label).alias(label), F.count(F.lit(1)).alias("_nb")))


def hash_rank(df: DataFrame, key, label: str, seed: int = 42, digits: int | None = None,
              counts: DataFrame | None = None) -> DataFrame:
    """Adds ``rank_in_class`` (1-based) in hash order within each class."""
    k = _key(key)
    d = _hashed(df, key, label, seed, digits)
    counts = counts if counts is not None else bucket_counts(df, key, label, seed, digits)
    before = Window.partitionBy("_c").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offs = counts.select("_c", "_b", F.coalesce(F.sum("_nb").over(before), F.lit(0)).alias("_off"))
    # one exchange of the rows by (class, bucket) serves the join and the window;
    # hashing the few offsets leaves the only sort to the window
    d = d.join(offs.hint("shuffle_hash"), ["_c", "_b"])
    rn = F.row_number().over(Window.partitionBy("_c", "_b").orderBy("_h", k))
    return d.withColumn("rank_in_class", F.col("_off") + rn).drop("_c", "_b", "_off", "_h")


def class_counts(df: DataFrame, label: str, counts: DataFrame | None = None) -> DataFrame:
    """Rows per class (one row per class; map-side combined, or summed from bucket counts)."""
    if counts is not None:
        return counts.groupBy(label).agg(F.sum("_nb").alias("n"))      # a null class groups with itself
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))


def quotas(counts: DataFrame, label: str, target: Column) -> DataFrame:
    """Largest-remainder allocation of ``target`` rows over classes in
    proportion to their sizes; remainder ties go to the lower label.

    ``target`` is an expression over ``N`` (total rows). Output: label, n, quota.
    """
    total = F.sum("n").over(Window.partitionBy())
    c = counts.withColumn("_N", total).withColumn("_t", target)
    c = c.withColumn("_cont", F.col("n").cast("double") * F.col("_t") / F.col("_N"))
    c = c.withColumn("_base", F.floor("_cont")).withColumn("_rem", F.col("_cont") - F.col("_base"))
    c = c.withColumn("_extra", F.col("_t") - F.sum("_base").over(Window.partitionBy()))
    order = F.row_number().over(Window.orderBy(F.desc("_rem"), F.asc_nulls_last(label)))
    return c.select(label, "n", (F.col("_base") + F.when(order <= F.col("_extra"), 1).otherwise(0))
                    .cast("bigint").alias("quota"))


def stratified_split(df: DataFrame, key, label: str, fraction: float, seed: int = 42,
                     names: tuple[str, str] = ("tuning", "evaluation")) -> DataFrame:
    """K1/K3: ``floor(N * fraction)`` rows to ``names[0]``, in proportion per
    class (largest remainder), the rest to ``names[1]``. Adds ``part``."""
    bc = bucket_counts(df, key, label, seed)
    ranked = hash_rank(df, key, label, seed, counts=bc)
    q = quotas(class_counts(df, label, bc), label,
               F.floor(F.col("_N").cast("double") * F.lit(float(fraction))))
    ranked = join_null_safe(ranked, bounded_broadcast(q.select(label, "quota")), [label])
    return ranked.withColumn("part", F.when(F.col("rank_in_class") <= F.col("quota"), F.lit(names[0]))
                             .otherwise(F.lit(names[1]))).drop("quota")


def stratified_folds(df: DataFrame, key, label: str, k: int, seed: int = 42) -> DataFrame:
    """K2: ``fold = (rows of earlier classes + rank_in_class - 1) mod k``.

    Every class differs by at most one row across folds, and so do fold totals."""
    bc = bucket_counts(df, key, label, seed)
    ranked = hash_rank(df, key, label, seed, counts=bc)
    cc = class_counts(df, label, bc)
    offs = cc.select(label, F.coalesce(F.sum("n").over(
        Window.orderBy(F.asc_nulls_last(label)).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_coff"))
    ranked = join_null_safe(ranked, bounded_broadcast(offs), [label])
    return ranked.withColumn("fold", F.pmod(F.col("_coff") + F.col("rank_in_class") - 1, F.lit(k))
                             .cast("int")).drop("_coff")


def evaluation_folds(df: DataFrame, key, label: str, fraction: float, k: int, seed: int = 42) -> DataFrame:
    """K1 then K2 with the same seed in one ranking: the rows of ``stratified_split``'s
    second part with the ``fold`` and ``rank_in_class`` that ``stratified_folds`` gives them.

    Within a class the second part holds the rows ranked above the quota, in the
    same order, so the rank among them is the rank less the quota."""
    bc = bucket_counts(df, key, label, seed)
    ranked = hash_rank(df, key, label, seed, counts=bc)
    q = quotas(class_counts(df, label, bc), label, F.floor(F.col("_N").cast("double") * F.lit(float(fraction))))
    left = F.col("n") - F.col("quota")
    before = Window.orderBy(F.asc_nulls_last(label)).rowsBetween(Window.unboundedPreceding, -1)
    offs = q.select(label, "quota", F.coalesce(F.sum(left).over(before), F.lit(0)).alias("_coff"))
    ranked = join_null_safe(ranked, bounded_broadcast(offs), [label]).filter(F.col("rank_in_class") > F.col("quota"))
    ranked = ranked.withColumn("rank_in_class", F.col("rank_in_class") - F.col("quota"))
    return ranked.withColumn("fold", F.pmod(F.col("_coff") + F.col("rank_in_class") - 1, F.lit(k)).cast("int")).drop("quota", "_coff")


def stratified_take(df: DataFrame, key, label: str, n: int, seed: int = 42) -> DataFrame:
    """K4: a fixed-size stratified probe of ``n`` rows (the whole table if smaller)."""
    bc = bucket_counts(df, key, label, seed)
    ranked = hash_rank(df, key, label, seed, counts=bc)
    q = quotas(class_counts(df, label, bc), label, F.least(F.col("_N"), F.lit(n)))
    ranked = join_null_safe(ranked, bounded_broadcast(q.select(label, "quota")), [label])
    return ranked.filter(F.col("rank_in_class") <= F.col("quota")).drop("quota")


def oversample_targets(df: DataFrame, label: str, cap: float = 0.25, by: list[str] = ()) -> DataFrame:
    """K5: per class ``target = max(n, ceil(cap * largest class))`` (per ``by`` group)."""
    by = list(by)
    c = df.groupBy(*by, label).agg(F.count(F.lit(1)).alias("n"))
    mx = F.max("n").over(Window.partitionBy(*by))
    return c.withColumn("target", F.greatest(F.col("n"), F.ceil(F.lit(float(cap)) * mx)).cast("bigint")) \
        .withColumn("n_synthetic", F.col("target") - F.col("n"))


def split_sizes(split_df: DataFrame, part: str = "part") -> DataFrame:
    """K7: rows per part and their share (4 decimals)."""
    c = split_df.groupBy(F.col(part).alias("partition")).agg(F.count(F.lit(1)).alias("instances"))
    return c.withColumn("fraction", F.round(F.col("instances") / F.sum("instances").over(Window.partitionBy()), 4))


def fold_class_counts(folds: DataFrame, label: str, fold: str = "fold") -> DataFrame:
    """Rows per (fold, class) and the class spread across folds (property: <= 1)."""
    c = folds.groupBy(fold, label).agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy(label)
    return c.withColumn("spread", (F.max("n").over(w) - F.min("n").over(w)).cast("bigint"))


def smote(df: DataFrame, key: str, label: str, features: str, cap: float = 0.25, k: int = 5,
          seed: int = 42) -> DataFrame:
    """K6: capped SMOTE, hash-driven so it is reproducible and partition-free.

    For class c with need = target - n_c synthetic rows (K5), synthetic row i
    takes base row number ``pmod(h1, n_c) + 1`` (hash order within c), its
    neighbour number ``pmod(h2, k_c) + 1`` among the base row's k_c =
    max(1, min(k, smallest class - 1)) nearest same-class rows, and the gap
    u = h3 / 2^32, where h1..h3 are md5 prefixes of '<seed>-<class>-<i>-<tag>'.
    Output: label, i, base, neighbor, u, features (x + u (x_nn - x)).
    """
    from . import neighbors
    targets = oversample_targets(df, label, cap)
    smallest = targets.agg(F.min("n")).first()[0]
    k_eff = max(1, min(k, (smallest or 1) - 1))
    ranked = hash_rank(df, key, label, seed).select(key, label, features, "rank_in_class")
    need = targets.filter(F.col("n_synthetic") > 0)
    # row numbers in blocks, spread over the cluster before they are expanded
    block = F.lit(SYNTHETIC_BLOCK).cast("bigint")
    blocks = (need.select(label, "n", "n_synthetic", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("n_synthetic") - 1) / block))).alias("_k"))
              .repartition(F.col(label), F.col("_k")))
    syn = blocks.select(label, "n", F.explode(F.sequence(F.col("_k") * block + 1, F.least("n_synthetic", (F.col("_k") + 1) * block))).alias("i"))

    def h(tag):
        return F.conv(F.substring(F.md5(F.concat_ws("-", F.lit(str(seed)), F.col(label).cast("string"),
                                                    F.col("i").cast("string"), F.lit(tag))), 1, 8), 16, 10).cast("bigint")
    syn = syn.select(label, "i", (F.pmod(h("base"), F.col("n")) + 1).alias("rank_in_class"),
                     (F.pmod(h("nn"), F.lit(k_eff)) + 1).cast("int").alias("rn"),
                     (h("gap") / F.lit(4294967296.0)).alias("u"))
    minority = df.join(need.select(label), label, "left_semi")
    neigh = neighbors.knn(minority, minority, key, features, label, k_eff, same=label)
    base = syn.join(ranked, [label, "rank_in_class"], "inner")
    nb = neigh.select(F.col("query").alias(key), "rn", F.col("neighbor"))
    # a class of one member has no neighbour: its synthetic rows repeat the member
    both = base.join(nb, [key, "rn"], "left").withColumn("neighbor", F.coalesce("neighbor", F.col(key)))
    feat = ranked.select(F.col(key).alias("neighbor"), F.col(features).alias("_xn"))
    out = both.join(feat, "neighbor", "inner")
    new = F.zip_with(F.col(features), F.col("_xn"), lambda a, b: a.cast("double") + F.col("u") * (b.cast("double") - a.cast("double")))
    return out.select(label, "i", F.col(key).alias("base"), "neighbor", "u", new.alias(features))
