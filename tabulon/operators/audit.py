"""Data-quality audit of a labelled table.

Every statistic is one partial/final hash aggregate over the scan, so a hot
key or class is collapsed map-side before any shuffle. Results are long
tables (one row per feature or pair) produced by ``inline`` over one
aggregate row, not by per-column jobs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import safe_div
from ..plans.sizing import bounded_broadcast, join_null_safe, join_single_rows, materialize

PROFILE_COLUMNS = ["feature", "kind", "cardinality", "minimum", "maximum", "rng", "mean",
                   "std", "median", "skewness", "pct_outlier", "pct_zero"]


def _long(agg_row_df: DataFrame, fields: dict[str, list]) -> DataFrame:
    """Turn one wide aggregate row into rows: ``fields`` maps output column ->
    per-row expressions (same length for every column)."""
    names = list(fields)
    n = len(fields[names[0]])
    structs = [F.struct(*[fields[c][i].alias(c) for c in names]) for i in range(n)]
    return agg_row_df.select(F.inline(F.array(*structs)))


def missing_tokens(df: DataFrame, cols: list[str], token: str = "?") -> DataFrame:
    """A2: per column, rows equal to the missing token and their percent."""
    aggs = [F.count(F.lit(1)).alias("_n")]
    aggs += [F.count_if(F.col(c) == token).alias(f"_m{i}") for i, c in enumerate(cols)]
    row = df.agg(*aggs)
    return _long(row, {
        "feature": [F.lit(c) for c in cols],
        "n": [F.col(f"_m{i}").cast("bigint") for i in range(len(cols))],
        "percent": [F.round(100.0 * F.col(f"_m{i}") / F.col("_n"), 3) for i in range(len(cols))],
    })


def class_dimension(df: DataFrame, label: str) -> DataFrame:
    """Class table ``(code, class)`` in sorted label order (a few rows)."""
    lv = df.select(F.col(label).alias("class")).distinct()
    return lv.select((F.row_number().over(Window.orderBy("class")) - 1).cast("int").alias("code"), "class")


def class_balance(df: DataFrame, label: str, classes: DataFrame | None = None) -> DataFrame:
    """A3/A4: frequency table, percent of all rows, zero-filled to ``classes``.

    ``classes`` is an optional ``(code, class)`` dimension; absent classes
    get count 0. Without it the observed labels in sorted order are used.
    """
    counts = df.groupBy(F.col(label).alias("class")).agg(F.count(F.lit(1)).alias("count"))
    dim = classes if classes is not None else class_dimension(df, label)
    total = F.sum("count").over(Window.partitionBy())
    out = (dim.join(counts, "class", "left")
           .select("code", "class", F.coalesce("count", F.lit(0)).cast("bigint").alias("count")))
    return out.withColumn("percent", F.round(100.0 * F.col("count") / total, 3))


def imbalance(df: DataFrame, label: str) -> DataFrame:
    """Majority, minority, ratio and chance agreement (sum of squared shares)."""
    counts = df.groupBy(F.col(label).cast("string").alias("class")).agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(
        F.count(F.lit(1)).cast("bigint").alias("n_classes"),
        F.min(F.struct(-F.col("n"), F.col("class"))).getField("class").alias("majority"),
        F.max("n").alias("majority_n"),
        F.min(F.struct(F.col("n"), F.col("class"))).getField("class").alias("minority"),
        F.min("n").alias("minority_n"),
        F.round(F.max("n") / F.min("n"), 6).alias("imbalance_ratio"),
        F.round(F.sum(F.pow("n", F.lit(2.0))) / F.pow(F.sum("n"), 2), 6).alias("chance_agreement"),
    )


def profile(df: DataFrame, numeric: list[str], nominal: list[str] = (),
            exact: bool = True) -> DataFrame:
    """Numeric profile plus nominal cardinality, one row per feature.

    skewness is the bias-adjusted G1 (Spark's ``skewness`` is the population
    g1; G1 = g1 * sqrt(n(n-1))/(n-2)), 0 for a constant column. Quartiles are
    exact with linear interpolation (``percentile``); ``exact=False`` uses
    ``percentile_approx`` for very high-cardinality columns. pct_outlier is the
    percent of rows outside 1.5 IQR and NULL when IQR = 0.

    Runs two aggregate passes; the quartiles of the first (two numbers per
    feature) are collected and fed as literals into the second.
    """
    numeric, nominal = list(numeric), list(nominal)
    aggs = [F.count(F.lit(1)).alias("_rows")]
    if exact and numeric:
        # exact quartiles from distinct-value counts (no single-task percentile buffer)
        from .features import exact_quantiles
        eq, card = exact_quantiles(df, numeric, [0.25, 0.5, 0.75], with_cardinality=True)
    for i, c in enumerate(numeric):
        x = F.col(c).cast("double")
        q = (F.array(*[F.lit(v) for v in eq[c]]) if exact
             else F.percentile_approx(x, [.25, .5, .75], 100000))
        # cardinality comes from the distinct-value table built for the quartiles
        card_e = F.lit(card[c]) if exact else F.count_distinct(x)
        aggs += [card_e.alias(f"card{i}"), F.min(x).alias(f"min{i}"),
                 F.max(x).alias(f"max{i}"), F.avg(x).alias(f"mean{i}"),
                 F.stddev_samp(x).alias(f"std{i}"), q.alias(f"q{i}"),
                 F.skewness(x).alias(f"g1{i}"), F.count(x).alias(f"cnt{i}"),
                 F.count_if(x == 0).alias(f"zero{i}")]
    for j, c in enumerate(nominal):
        aggs.append(F.count_distinct(c).alias(f"ncard{j}"))
    row = df.agg(*aggs).persist()
    qs = row.select(*[F.col(f"q{i}") for i in range(len(numeric))]).first() if numeric else []
    # second pass: share of rows outside the 1.5 IQR fences
    fences = []
    for i, c in enumerate(numeric):
        q1, q3 = (qs[i][0], qs[i][2]) if qs[i] is not None else (None, None)
        if q1 is None or not (q3 - q1 > 0):
            fences.append(F.lit(None).cast("double").alias(f"out{i}"))
        else:
            iqr = q3 - q1
            x = F.col(c).cast("double")
            fences.append((100.0 * F.count_if((x < q1 - 1.5 * iqr) | (x > q3 + 1.5 * iqr))
                           / F.count(F.lit(1))).alias(f"out{i}"))
    outl = df.agg(*fences) if fences else None
    wide = join_single_rows(row, outl) if outl is not None else row
    def r6(e):
        return F.round(e, 6)
    num_rows = {
        "feature": [F.lit(c) for c in numeric],
        "kind": [F.lit("numeric")] * len(numeric),
        "cardinality": [F.col(f"card{i}").cast("bigint") for i in range(len(numeric))],
        "minimum": [r6(F.col(f"min{i}")) for i in range(len(numeric))],
        "maximum": [r6(F.col(f"max{i}")) for i in range(len(numeric))],
        "rng": [r6(F.col(f"max{i}") - F.col(f"min{i}")) for i in range(len(numeric))],
        "mean": [r6(F.col(f"mean{i}")) for i in range(len(numeric))],
        "std": [r6(F.col(f"std{i}")) for i in range(len(numeric))],
        "median": [r6(F.col(f"q{i}")[1]) for i in range(len(numeric))],
        "skewness": [r6(F.when(F.col(f"min{i}") == F.col(f"max{i}"), F.lit(0.0))
                        .when(F.col(f"cnt{i}") > 2,
                              F.col(f"g1{i}") * F.sqrt(F.col(f"cnt{i}") * (F.col(f"cnt{i}") - 1))
                              / (F.col(f"cnt{i}") - 2)))
                     for i in range(len(numeric))],
        "pct_outlier": [r6(F.col(f"out{i}")) for i in range(len(numeric))],
        "pct_zero": [r6(100.0 * F.col(f"zero{i}") / F.col("_rows")) for i in range(len(numeric))],
    }
    nul = F.lit(None).cast("double")
    for j, c in enumerate(nominal):
        num_rows["feature"].append(F.lit(c))
        num_rows["kind"].append(F.lit("nominal"))
        num_rows["cardinality"].append(F.col(f"ncard{j}").cast("bigint"))
        for k in PROFILE_COLUMNS[3:]:
            num_rows[k].append(nul)
    return _long(wide, num_rows)


def cardinality(df: DataFrame, cols: list[str], key: str | None = None) -> DataFrame:
    """Distinct count per column and whether it identifies every row."""
    aggs = [F.count(F.lit(1)).alias("_n")] + [F.count_distinct(c).alias(f"_d{i}") for i, c in enumerate(cols)]
    row = df.agg(*aggs)
    return _long(row, {
        "feature": [F.lit(c) for c in cols],
        "cardinality": [F.col(f"_d{i}").cast("bigint") for i in range(len(cols))],
        "is_unique": [F.col(f"_d{i}") == F.col("_n") for i in range(len(cols))],
    })


def range_spread(prof: DataFrame, exclude: list[str] = ()) -> DataFrame:
    """A10: widest range, narrowest non-zero range, their ratio."""
    p = prof.filter((F.col("kind") == "numeric") & F.col("rng").isNotNull())
    if exclude:
        p = p.filter(~F.col("feature").isin(list(exclude)))
    nz = F.when(F.col("rng") > 0, F.struct(F.col("rng"), F.col("feature")))
    return p.agg(
        F.max(F.struct(F.col("rng"), F.col("feature"))).alias("w"),
        F.min(nz).alias("n"),
    ).select(F.col("w.feature").alias("widest"), F.col("w.rng").alias("widest_rng"),
             F.col("n.feature").alias("narrowest"), F.col("n.rng").alias("narrowest_rng"),
             F.round(safe_div(F.col("w.rng"), F.col("n.rng")), 6).alias("ratio"))


def outlier_ranking(prof: DataFrame, threshold: float = 10.0) -> DataFrame:
    """Features at or over an outlier share, the worst one, and the most skewed."""
    p = prof.filter(F.col("kind") == "numeric")
    over = F.col("pct_outlier") >= threshold
    return p.agg(
        F.count_if(over).cast("bigint").alias("n_over"),
        F.max(F.when(over, F.struct(F.col("pct_outlier"), F.col("feature")))).alias("w"),
        F.max(F.when(F.col("skewness").isNotNull(), F.struct(F.col("skewness"), F.col("feature")))).alias("s"),
    ).select("n_over", F.col("w.feature").alias("worst_feature"), F.col("w.pct_outlier").alias("worst_pct"),
             F.col("s.feature").alias("most_skewed"), F.col("s.skewness").alias("max_skewness"))


def _pairwise_r(a, b):
    """Pearson r over the rows where both values are present; a column that is
    constant there has no correlation: NULL, never 0/0 = NaN."""
    a, b = a.cast("double"), b.cast("double")
    x, y = F.when(b.isNotNull(), a), F.when(a.isNotNull(), b)
    den = F.stddev_samp(x) * F.stddev_samp(y)
    return F.when(den > 0, F.covar_samp(x, y) / den)


def correlations(df: DataFrame, numeric: list[str], pairs_per_scan: int = 1000) -> DataFrame:
    """|Pearson r| for every pair i < j (column order), long form.

    One definition at every width: pairwise complete rows. Pairs are aggregated
    in groups of ``pairs_per_scan`` expressions, so very wide tables take several
    scans instead of one unbounded plan."""
    numeric = list(numeric)
    p = len(numeric)
    pairs = [(i, j) for i in range(p) for j in range(i + 1, p)]
    out = None
    for at in range(0, max(len(pairs), 1), pairs_per_scan):
        part = pairs[at:at + pairs_per_scan]
        row = df.agg(F.lit(1).alias("_one"), *[_pairwise_r(F.col(numeric[i]), F.col(numeric[j])).alias(f"r{i}_{j}") for i, j in part])
        long = _long(row, {
            "feature_a": [F.lit(numeric[i]) for i, _ in part],
            "feature_b": [F.lit(numeric[j]) for _, j in part],
            # least() skips NULLs, so clip only defined correlations
            "abs_r": [F.round(F.when(F.col(f"r{i}_{j}").isNotNull(),
                                     F.least(F.abs(F.col(f"r{i}_{j}")), F.lit(1.0))), 6) for i, j in part],
        })
        out = long if out is None else out.unionByName(long)
    return out


def correlated_pairs(corr: DataFrame, threshold: float = 0.90, top: int | None = None) -> DataFrame:
    """Pairs with |r| >= threshold, strongest first."""
    out = corr.filter(F.col("abs_r") >= threshold).orderBy(F.desc("abs_r"), "feature_a", "feature_b")
    return out.limit(top) if top else out


def correlation_counts(corr: DataFrame, thresholds=(0.90, 0.95, 0.99)) -> DataFrame:
    """Number of pairs at each threshold, exactly 1, and the maximum."""
    aggs = [F.count_if(F.col("abs_r") >= t).cast("bigint").alias(f"n_{int(round(t * 100)):03d}") for t in thresholds]
    aggs += [F.count_if(F.col("abs_r") == 1.0).cast("bigint").alias("n_exact_one"),
             F.max("abs_r").alias("max_abs_r")]
    return corr.agg(*aggs)


def named_correlation(df: DataFrame, a: str, b: str) -> DataFrame:
    """R of one named pair and whether it is exactly 1."""
    r = _pairwise_r(F.col(a), F.col(b))
    return df.agg(F.round(r, 6).alias("r")).withColumn("exact_one", F.col("r") == 1.0) \
        .select(F.lit(f"{a}~{b}").alias("pair"), "r", "exact_one")


CHECK = "_check"


def digest_keyed(df: DataFrame, texts: list[str]) -> DataFrame:
    """A15-A19, D11 on long texts: ``df`` with each column of ``texts`` replaced by
    its 128-bit digest (NULL stays NULL) and ``_check``, a hash of another kind
    over all of them. `duplicates` and `majority_labels` then group and shuffle
    digests only, and fail where rows of one digest differ in ``_check``."""
    return df.withColumns({t: F.unhex(F.md5(F.col(t).cast("binary"))) for t in texts} | {CHECK: F.xxhash64(*texts)})


def attach_texts(keyed: DataFrame, rows: DataFrame, texts: list[str], key: str) -> DataFrame:
    """The texts behind the digests of ``keyed``, read from the row whose unique
    ``key`` is its ``first_key``. A text moves only if ``keyed`` is too large to
    broadcast, and then once for each digest."""
    first = bounded_broadcast(keyed.drop(*texts))
    return rows.select(F.col(key).alias("first_key"), *texts).join(first, "first_key").drop("first_key")


def _same_text(value: Column, low: Column, high: Column) -> Column:
    return F.when(low != high, F.raise_error(F.lit("different texts share a 128-bit digest"))).otherwise(value)


def vector_label_counts(df: DataFrame, features: list[str], label: str, key: str | None = None) -> DataFrame:
    """(vector, label) -> n. One shuffle, map-side combined, so a hot vector
    collapses to one row per input partition before it moves. ``key``: also the
    smallest key, as ``first_key``. Of digest-keyed rows also the ends of the check."""
    aggs = [F.min(key).alias("first_key")] if key else []
    if CHECK in df.columns:
        aggs += [F.min(CHECK).alias("_low"), F.max(CHECK).alias("_high")]
    return df.groupBy(*features, label).agg(F.count(F.lit(1)).alias("n"), *aggs)


def duplicates(df: DataFrame, features: list[str], label: str) -> DataFrame:
    """Duplicate and conflicting-label summary (one row).

    duplicate_rows       rows equal to an earlier row on features + label
    duplicate_descriptive rows equal on features alone
    conflicting_pairs    extra (vector, label) pairs = difference of the two
    conflict_records     rows whose vector carries more than one label
    unresolvable         rows whose label is not their vector's majority label
    """
    vl = vector_label_counts(df, features, label)
    keyed = CHECK in df.columns
    vec = vl.groupBy(*features).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("labels"), F.max("n").alias("top"),
                                    *([F.min("_low").alias("_low"), F.max("_high").alias("_high")] if keyed else []))
    if keyed:
        vec = vec.withColumn("n", _same_text(F.col("n"), F.col("_low"), F.col("_high")))
    s = vec.agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("vectors"),
                F.sum("labels").alias("pairs"),
                F.sum(F.when(F.col("labels") > 1, F.col("n")).otherwise(0)).alias("mixed"),
                F.sum("top").alias("placed"))
    return s.select(
        (F.col("rows") - F.col("pairs")).cast("bigint").alias("duplicate_rows"),
        (F.col("rows") - F.col("vectors")).cast("bigint").alias("duplicate_descriptive"),
        (F.col("pairs") - F.col("vectors")).cast("bigint").alias("conflicting_pairs"),
        F.col("mixed").cast("bigint").alias("conflict_records"),
        (F.col("rows") - F.col("placed")).cast("bigint").alias("unresolvable"),
        F.col("vectors").cast("bigint").alias("distinct_vectors"),
        F.round(100.0 * (F.col("rows") - F.col("pairs")) / F.col("rows"), 2).alias("duplicate_percent"),
        F.round(100.0 * (F.col("rows") - F.col("placed")) / F.col("rows"), 2).alias("unresolvable_percent"),
    )


def majority_labels(df: DataFrame, features: list[str], label: str, key: str | None = None) -> DataFrame:
    """Majority label per feature vector (ties to the lowest label),
    its count, the vector's size and how many labels it carries. With ``key``
    also ``first_key``, the smallest key of the vector's rows.

    The window is partitioned by vector over the (vector, label) count table,
    so a partition holds at most one row per class."""
    vl = vector_label_counts(df, features, label, key)
    w = Window.partitionBy(*features)
    n_vector = F.sum("n").over(w)
    if CHECK in df.columns:
        n_vector = _same_text(n_vector, F.min("_low").over(w), F.max("_high").over(w))
    first = [F.min("first_key").over(w).alias("first_key")] if key else []
    rn = F.row_number().over(w.orderBy(F.desc("n"), F.asc(label)))
    return (vl.select(*features, label, "n", rn.alias("_rn"), n_vector.alias("n_vector"),
                      F.count(F.lit(1)).over(w).alias("n_labels"), *first)
            .filter(F.col("_rn") == 1)
            .select(*features, F.col(label).alias("majority"), F.col("n").alias("n_majority"),
                    F.col("n_vector").cast("bigint").alias("n_vector"),
                    F.col("n_labels").cast("bigint").alias("n_labels"), *(["first_key"] if key else [])))


def mixed_label_rows(df: DataFrame, features: list[str], label: str) -> DataFrame:
    """The rows whose feature vector carries more than one label (semi join)."""
    mixed = (vector_label_counts(df, features, label).groupBy(*features)
             .agg(F.count(F.lit(1)).alias("k")).filter("k > 1").select(*features))
    return df.join(mixed, features, "left_semi")


def duplicate_flags(df: DataFrame, cols: list[str], key: str) -> DataFrame:
    """Mark every row but the first (by its unique ``key``) of each group of
    equal rows. The first key is a partial aggregate, so a group that holds a
    third of all rows is one row per input partition before it moves; NULLs are
    equal."""
    first = df.groupBy(*cols).agg(F.min(key).alias("_first"))
    return join_null_safe(df, first, list(cols)).withColumn("is_duplicate", F.col(key) > F.col("_first")).drop("_first")


def binary_domain(df: DataFrame, cols: list[str]) -> DataFrame:
    """Observed values of declared-binary columns and rows outside {0, 1}."""
    aggs = []
    for i, c in enumerate(cols):
        aggs += [F.array_join(F.array_sort(F.collect_set(F.col(c).cast("string"))), ",").alias(f"v{i}"),
                 F.count_if(~F.col(c).cast("double").isin(0.0, 1.0)).alias(f"b{i}")]
    row = df.agg(*aggs)
    return _long(row, {
        "feature": [F.lit(c) for c in cols],
        "observed": [F.col(f"v{i}") for i in range(len(cols))],
        "nonbinary": [F.col(f"b{i}").cast("bigint") for i in range(len(cols))],
    })


def adjacent_agreement(df: DataFrame, key: str, label: str) -> DataFrame:
    """Share of neighbouring rows (in key order) with the same label (two
    NULL labels are the same), against chance agreement (sum of squared class
    shares) and twice chance."""
    s = _edge_stitched_struct(df.select(key, label), key, label)
    pairs = s.filter("has_prev")
    agree = pairs.agg(F.count(F.lit(1)).alias("n_pairs"),
                      F.count_if(F.col(label).eqNullSafe(F.col("prev"))).alias("agree"))
    chance = imbalance(df, label).select("chance_agreement")
    share = F.try_divide(F.col("agree"), F.col("n_pairs"))
    return join_single_rows(agree, chance).select(
        F.col("n_pairs").cast("bigint").alias("n_pairs"), F.col("agree").cast("bigint").alias("agree"),
        F.round(share, 6).alias("agreement"), F.col("chance_agreement"),
        (share > 2 * F.col("chance_agreement")).alias("above_twice_chance"))


def monotonic_check(df: DataFrame, order_col: str, key: str) -> DataFrame:
    """Does ``key`` strictly increase when rows are ordered by ``order_col``?

    Re-aimed from file order (not a table property): counts the places where
    the key does not increase, comparing each row with its predecessor in
    (order_col, key) order."""
    d = df.select(F.col(order_col).alias("_o"), F.col(key).alias("_k"))
    ordered = d.select(F.struct("_o", "_k").alias("_ok"), "_k")
    s = _edge_stitched_struct(ordered, "_ok", "_k")
    return s.agg(F.count(F.lit(1)).cast("bigint").alias("rows"),
                 F.count_if(F.col("has_prev") & (F.col("_k") <= F.col("prev"))).cast("bigint").alias("violations")) \
        .withColumn("strictly_increasing", F.col("violations") == 0)


def _edge_stitched_struct(df: DataFrame, order: str, value: str) -> DataFrame:
    """Each row with its predecessor's value in ``order`` (and whether it has
    one: a NULL value is not a missing row). Rows are range partitioned, as many
    partitions as the session shuffles into; the layout is checkpointed, so both
    branches see the same cut points, and only each partition's last row crosses
    an edge."""
    d = materialize(df.repartitionByRange(order).withColumn("_b", F.spark_partition_id()))
    held = F.struct(F.col(value).alias("v"))
    inner = d.withColumn("_prev", F.lag(held).over(Window.partitionBy("_b").orderBy(order)))
    edges = (d.groupBy("_b").agg(F.max(F.struct(F.col(order), held.alias("_held"))).alias("_last"))
             .withColumn("_carry", F.lag(F.col("_last._held")).over(Window.orderBy("_b"))).select("_b", "_carry"))
    # edges has one row per partition: a bounded broadcast by construction
    out = inner.join(F.broadcast(edges), "_b", "left").withColumn("_p", F.coalesce("_prev", "_carry"))
    return out.select(order, value, F.col("_p.v").alias("prev"), F.col("_p").isNotNull().alias("has_prev"))


def facts(df: DataFrame, label: str, numeric: list[str], nominal: list[str], key: str) -> DataFrame:
    """Headline audit facts as ``(fact, value)`` strings."""
    base = df.agg(F.count(F.lit(1)).alias("n"), F.count_distinct(key).alias("nk"))
    imb = imbalance(df, label)
    rows = join_single_rows(base, imb)
    out = rows.select(F.inline(F.array(
        F.struct(F.lit("n_instances").alias("fact"), F.col("n").cast("string").alias("value")),
        F.struct(F.lit("n_columns").alias("fact"), F.lit(str(len(df.columns))).alias("value")),
        F.struct(F.lit("n_descriptive").alias("fact"), F.lit(str(len(df.columns) - 1)).alias("value")),
        F.struct(F.lit("n_numeric").alias("fact"), F.lit(str(len(numeric))).alias("value")),
        F.struct(F.lit("n_nominal").alias("fact"), F.lit(str(len(nominal))).alias("value")),
        F.struct(F.lit("id_unique").alias("fact"), (F.col("n") == F.col("nk")).cast("string").alias("value")),
        F.struct(F.lit("n_classes").alias("fact"), F.col("n_classes").cast("string").alias("value")),
        F.struct(F.lit("majority").alias("fact"), F.col("majority").alias("value")),
        F.struct(F.lit("minority").alias("fact"), F.col("minority").alias("value")),
        F.struct(F.lit("imbalance_ratio").alias("fact"), F.col("imbalance_ratio").cast("string").alias("value")),
    )))
    return out
