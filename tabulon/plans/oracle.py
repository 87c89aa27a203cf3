"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

Column names equal the Spark query's; floats are rounded as in Spark.
"""

from __future__ import annotations

ORACLE: dict[str, str] = {}

LINEITEM_NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _profile_sql(table: str, cols: list[str], nominal: list[str] = ()) -> str:
    parts = []
    for c in cols:
        parts.append(f"""
SELECT '{c}' AS feature, 'numeric' AS kind, count(DISTINCT x)::BIGINT AS cardinality,
  round(min(x), 6) AS minimum, round(max(x), 6) AS maximum, round(max(x) - min(x), 6) AS rng,
  round(avg(x), 6) AS mean, round(stddev_samp(x), 6) AS std, round(quantile_cont(x, 0.5), 6) AS median,
  round(CASE WHEN min(x) = max(x) THEN 0.0 WHEN count(x) > 2 THEN skewness(x) END, 6) AS skewness,
  round(CASE WHEN any_value(q3) - any_value(q1) > 0 THEN 100.0 * count(*) FILTER (
      WHERE x < any_value(q1) - 1.5 * (any_value(q3) - any_value(q1))
         OR x > any_value(q3) + 1.5 * (any_value(q3) - any_value(q1))) / count(*) END, 6) AS pct_outlier,
  round(100.0 * count(*) FILTER (WHERE x = 0) / count(*), 6) AS pct_zero
FROM (SELECT CAST({c} AS DOUBLE) AS x FROM {table}) v,
     (SELECT quantile_cont(CAST({c} AS DOUBLE), 0.25) AS q1, quantile_cont(CAST({c} AS DOUBLE), 0.75) AS q3 FROM {table}) q""")
    for c in nominal:
        parts.append(f"""
SELECT '{c}' AS feature, 'nominal' AS kind, count(DISTINCT {c})::BIGINT AS cardinality,
  NULL::DOUBLE AS minimum, NULL::DOUBLE AS maximum, NULL::DOUBLE AS rng, NULL::DOUBLE AS mean,
  NULL::DOUBLE AS std, NULL::DOUBLE AS median, NULL::DOUBLE AS skewness, NULL::DOUBLE AS pct_outlier,
  NULL::DOUBLE AS pct_zero FROM {table}""")
    return "\nUNION ALL\n".join(parts)


# The outlier share uses aggregate-inside-filter which DuckDB does not allow;
# rewrite with the quartiles as joined columns instead.
def _profile_sql_joined(table: str, cols: list[str], nominal: list[str] = ()) -> str:
    parts = []
    for c in cols:
        parts.append(f"""
SELECT '{c}' AS feature, 'numeric' AS kind, count(DISTINCT x)::BIGINT AS cardinality,
  round(min(x), 6) AS minimum, round(max(x), 6) AS maximum, round(max(x) - min(x), 6) AS rng,
  round(avg(x), 6) AS mean, round(stddev_samp(x), 6) AS std, round(quantile_cont(x, 0.5), 6) AS median,
  round(CASE WHEN min(x) = max(x) THEN 0.0 WHEN count(x) > 2 THEN skewness(x) END, 6) + 0.0 AS skewness,
  round(CASE WHEN q3 - q1 > 0 THEN 100.0 * count(*) FILTER (
      WHERE x < q1 - 1.5 * (q3 - q1) OR x > q3 + 1.5 * (q3 - q1)) / count(*) END, 6) AS pct_outlier,
  round(100.0 * count(*) FILTER (WHERE x = 0) / count(*), 6) AS pct_zero
FROM (SELECT CAST({c} AS DOUBLE) AS x FROM {table}) v,
     (SELECT quantile_cont(CAST({c} AS DOUBLE), 0.25) AS q1, quantile_cont(CAST({c} AS DOUBLE), 0.75) AS q3 FROM {table}) q
GROUP BY q1, q3""")
    for c in nominal:
        parts.append(f"""
SELECT '{c}' AS feature, 'nominal' AS kind, count(DISTINCT {c})::BIGINT AS cardinality,
  NULL::DOUBLE AS minimum, NULL::DOUBLE AS maximum, NULL::DOUBLE AS rng, NULL::DOUBLE AS mean,
  NULL::DOUBLE AS std, NULL::DOUBLE AS median, NULL::DOUBLE AS skewness, NULL::DOUBLE AS pct_outlier,
  NULL::DOUBLE AS pct_zero FROM {table}""")
    return "\nUNION ALL\n".join(parts)


PROFILE_LI_PART = (f"({_profile_sql_joined('lineitem', LINEITEM_NUMERIC)}\nUNION ALL\n"
                   f"{_profile_sql_joined('part', ['p_size', 'p_retailprice'])})")

ORACLE["audit_duplicates_conflicts"] = """
WITH vl AS (SELECT p_brand, p_type, p_size, count(*) AS n FROM part GROUP BY ALL),
vec AS (SELECT p_brand, p_type, sum(n) AS n, count(*) AS labels, max(n) AS top FROM vl GROUP BY ALL),
s AS (SELECT sum(n) AS rows, count(*) AS vectors, sum(labels) AS pairs,
             sum(CASE WHEN labels > 1 THEN n ELSE 0 END) AS mixed, sum(top) AS placed FROM vec)
SELECT (rows - pairs)::BIGINT AS duplicate_rows, (rows - vectors)::BIGINT AS duplicate_descriptive,
       (pairs - vectors)::BIGINT AS conflicting_pairs, mixed::BIGINT AS conflict_records,
       (rows - placed)::BIGINT AS unresolvable, vectors::BIGINT AS distinct_vectors,
       round(100.0 * (rows - pairs) / rows, 2) AS duplicate_percent,
       round(100.0 * (rows - placed) / rows, 2) AS unresolvable_percent
FROM s"""

ORACLE["audit_majority_label"] = """
WITH vl AS (SELECT p_brand, p_type, p_size, count(*) AS n FROM part GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY p_brand, p_type ORDER BY n DESC, p_size) AS rn,
             sum(n) OVER (PARTITION BY p_brand, p_type) AS n_vector,
             count(*) OVER (PARTITION BY p_brand, p_type) AS n_labels FROM vl)
SELECT p_brand, p_type, p_size AS majority, n AS n_majority, n_vector::BIGINT AS n_vector,
       n_labels::BIGINT AS n_labels FROM r WHERE rn = 1"""

ORACLE["audit_mixed_label_rows"] = """
SELECT p_partkey, p_brand, p_type, p_size FROM part
WHERE (p_brand, p_type) IN (SELECT p_brand, p_type FROM part GROUP BY ALL HAVING count(DISTINCT p_size) > 1)"""

ORACLE["audit_profile"] = _profile_sql_joined("lineitem", LINEITEM_NUMERIC, ["l_returnflag", "l_linestatus"])

ORACLE["audit_missing_tokens"] = """
SELECT 'event_type' AS feature, count(*) FILTER (WHERE event_type = 'error')::BIGINT AS n,
       round(100.0 * count(*) FILTER (WHERE event_type = 'error') / count(*), 3) AS percent FROM events
UNION ALL
SELECT 'props', count(*) FILTER (WHERE props = 'error')::BIGINT,
       round(100.0 * count(*) FILTER (WHERE props = 'error') / count(*), 3) FROM events"""

ORACLE["audit_class_balance"] = """
WITH c AS (SELECT o_orderpriority AS class, count(*) AS count FROM orders GROUP BY 1)
SELECT (row_number() OVER (ORDER BY class) - 1)::INTEGER AS code, class, count::BIGINT AS count,
       round(100.0 * count / sum(count) OVER (), 3) AS percent FROM c"""

ORACLE["audit_imbalance"] = """
WITH c AS (SELECT CAST(role AS VARCHAR) AS class, count(*) AS n FROM conversations GROUP BY 1)
SELECT count(*)::BIGINT AS n_classes, arg_min(class, (-n, class)) AS majority, max(n) AS majority_n,
       arg_min(class, (n, class)) AS minority, min(n) AS minority_n,
       round(max(n) / min(n), 6) AS imbalance_ratio,
       round(sum(n * n) / pow(sum(n), 2), 6) AS chance_agreement FROM c"""

ORACLE["audit_cardinality"] = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, count(DISTINCT {c})::BIGINT AS cardinality, count(DISTINCT {c}) = count(*) AS is_unique FROM part"
    for c in ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"])

ORACLE["audit_range_spread"] = f"""
WITH p AS {PROFILE_LI_PART}
SELECT arg_max(feature, (rng, feature)) AS widest, max(rng) AS widest_rng,
       arg_min(feature, (rng, feature)) FILTER (WHERE rng > 0) AS narrowest,
       min(rng) FILTER (WHERE rng > 0) AS narrowest_rng,
       round(coalesce(max(rng) / min(rng) FILTER (WHERE rng > 0), 0), 6) AS ratio
FROM p WHERE kind = 'numeric' AND rng IS NOT NULL"""

ORACLE["audit_outlier_ranking"] = f"""
WITH p AS {PROFILE_LI_PART}
SELECT count(*) FILTER (WHERE pct_outlier >= 1.0)::BIGINT AS n_over,
       arg_max(feature, (pct_outlier, feature)) FILTER (WHERE pct_outlier >= 1.0) AS worst_feature,
       max(pct_outlier) FILTER (WHERE pct_outlier >= 1.0) AS worst_pct,
       arg_max(feature, (skewness, feature)) FILTER (WHERE skewness IS NOT NULL) AS most_skewed,
       max(skewness) AS max_skewness
FROM p WHERE kind = 'numeric'"""

DOC_MEASURES_SQL = """(SELECT doc_id, n_chars, length(text)::BIGINT AS text_len,
  (length(text) - length(replace(text, ' ', '')))::BIGINT AS n_spaces,
  (length(text) - length(replace(text, chr(10), '')) + 1)::BIGINT AS n_lines FROM documents)"""
_DM = ["n_chars", "text_len", "n_spaces", "n_lines"]
_CORR_PAIRS = " UNION ALL ".join(
    f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, round(least(abs(corr({a}::DOUBLE, {b}::DOUBLE)), 1.0), 6) AS abs_r FROM dm"
    for i, a in enumerate(_DM) for b in _DM[i + 1:])
ORACLE["audit_correlations"] = f"WITH dm AS {DOC_MEASURES_SQL} {_CORR_PAIRS}"
ORACLE["audit_correlation_counts"] = f"""
WITH dm AS {DOC_MEASURES_SQL}, c AS ({_CORR_PAIRS})
SELECT count(*) FILTER (WHERE abs_r >= 0.90)::BIGINT AS n_090, count(*) FILTER (WHERE abs_r >= 0.95)::BIGINT AS n_095,
       count(*) FILTER (WHERE abs_r >= 0.99)::BIGINT AS n_099, count(*) FILTER (WHERE abs_r = 1.0)::BIGINT AS n_exact_one,
       max(abs_r) AS max_abs_r FROM c"""

ORACLE["audit_named_correlation"] = """
SELECT 'p_partkey~p_retailprice' AS pair, round(corr(p_partkey::DOUBLE, p_retailprice::DOUBLE), 6) AS r,
       round(corr(p_partkey::DOUBLE, p_retailprice::DOUBLE), 6) = 1.0 AS exact_one FROM part"""

ORACLE["audit_binary_domain"] = """
SELECT 'quality' AS feature, array_to_string(list_sort(list_distinct(list(CAST(quality AS VARCHAR)))), ',') AS observed,
       count(*) FILTER (WHERE quality NOT IN (0, 1))::BIGINT AS nonbinary FROM labels
UNION ALL
SELECT 'toxic', array_to_string(list_sort(list_distinct(list(CAST(toxic AS VARCHAR)))), ','),
       count(*) FILTER (WHERE toxic NOT IN (0, 1))::BIGINT FROM labels"""

ORACLE["adjacent_label_agreement"] = """
WITH p AS (SELECT event_type, lag(event_type) OVER (ORDER BY event_id) AS prev FROM events),
a AS (SELECT count(*) AS n_pairs, count(*) FILTER (WHERE event_type = prev) AS agree FROM p WHERE prev IS NOT NULL),
c AS (SELECT round(sum(n * n) / pow(sum(n), 2), 6) AS chance_agreement
      FROM (SELECT count(*) AS n FROM events GROUP BY event_type))
SELECT n_pairs::BIGINT AS n_pairs, agree::BIGINT AS agree, round(agree / n_pairs, 6) AS agreement,
       chance_agreement, agree / n_pairs > 2 * chance_agreement AS above_twice_chance FROM a, c"""

ORACLE["monotonic_id_check"] = """
WITH p AS (SELECT event_id, lag(event_id) OVER (ORDER BY ts, event_id) AS prev FROM events)
SELECT count(*)::BIGINT AS rows, count(*) FILTER (WHERE prev IS NOT NULL AND event_id <= prev)::BIGINT AS violations,
       count(*) FILTER (WHERE prev IS NOT NULL AND event_id <= prev) = 0 AS strictly_increasing FROM p"""


# ---------------------------------------------------------------- sampling
def rank_sql(table: str, key: str, label: str, seed: int = 42) -> str:
    """Rows of ``table`` with ``rank_in_class`` in md5 order within ``label``."""
    return (f"(SELECT *, row_number() OVER (PARTITION BY {label} ORDER BY "
            f"md5('{seed}-' || CAST({key} AS VARCHAR)), {key}) AS rank_in_class FROM {table})")


def quota_sql(table: str, label: str, target: str) -> str:
    """Largest-remainder quotas; ``target`` is an expression over ``total``."""
    return f"""(WITH cc AS (SELECT {label}, count(*) AS n FROM {table} GROUP BY ALL),
  c1 AS (SELECT *, sum(n) OVER () AS total FROM cc),
  c2 AS (SELECT *, ({target}) AS t FROM c1),
  c3 AS (SELECT *, n::DOUBLE * t / total AS cont FROM c2),
  c4 AS (SELECT *, floor(cont) AS base, cont - floor(cont) AS rem FROM c3),
  c5 AS (SELECT *, t - sum(base) OVER () AS extra, row_number() OVER (ORDER BY rem DESC, {label}) AS ord FROM c4)
  SELECT {label}, n, (base + CASE WHEN ord <= extra THEN 1 ELSE 0 END)::BIGINT AS quota FROM c5)"""


def split_sql(table: str, key: str, label: str, fraction: float, seed: int = 42,
              names=("tuning", "evaluation")) -> str:
    return f"""(SELECT r.*, CASE WHEN rank_in_class <= quota THEN '{names[0]}' ELSE '{names[1]}' END AS part
  FROM {rank_sql(table, key, label, seed)} r JOIN {quota_sql(table, label, f'floor(total::DOUBLE * {float(fraction)!r})')} q USING ({label}))"""


def folds_sql(table: str, key: str, label: str, k: int, seed: int = 42) -> str:
    return f"""(WITH cc AS (SELECT {label}, count(*) AS n FROM {table} GROUP BY ALL),
  off AS (SELECT {label}, coalesce(sum(n) OVER (ORDER BY {label} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS coff FROM cc)
  SELECT r.*, ((coff + rank_in_class - 1) % {k})::INTEGER AS fold FROM {rank_sql(table, key, label, seed)} r JOIN off USING ({label}))"""


ORACLE["stratified_split"] = f"SELECT o_orderkey, o_orderpriority, part FROM {split_sql('orders', 'o_orderkey', 'o_orderpriority', 0.25)}"
ORACLE["stratified_folds"] = f"SELECT o_orderkey, fold FROM {folds_sql('orders', 'o_orderkey', 'o_orderpriority', 10)}"
ORACLE["fold_class_counts"] = f"""
WITH c AS (SELECT fold, o_orderpriority, count(*) AS n FROM {folds_sql('orders', 'o_orderkey', 'o_orderpriority', 10)} GROUP BY ALL)
SELECT fold, o_orderpriority, n, (max(n) OVER (PARTITION BY o_orderpriority) - min(n) OVER (PARTITION BY o_orderpriority))::BIGINT AS spread FROM c"""
ORACLE["stratified_probe"] = f"""
SELECT o_orderkey, o_orderpriority, rank_in_class FROM {rank_sql('orders', 'o_orderkey', 'o_orderpriority')} r
JOIN {quota_sql('orders', 'o_orderpriority', 'least(total, 1000)')} q USING (o_orderpriority) WHERE rank_in_class <= quota"""
ORACLE["split_sizes"] = f"""
WITH c AS (SELECT part AS partition, count(*) AS instances FROM {split_sql('orders', 'o_orderkey', 'o_orderpriority', 0.25)} GROUP BY 1)
SELECT partition, instances, round(instances / sum(instances) OVER (), 4) AS fraction FROM c"""
ORACLE["smote_targets"] = """
WITH c AS (SELECT toxic, count(*) AS n FROM labels GROUP BY 1)
SELECT toxic, n, greatest(n, ceil(0.25 * max(n) OVER ()))::BIGINT AS target,
       (greatest(n, ceil(0.25 * max(n) OVER ())) - n)::BIGINT AS n_synthetic FROM c"""


# ---------------------------------------------------------------- neighbours and metrics
EMB_FOLDS_SQL = folds_sql("embeddings", "vec_id", "label", 5)


def _dist(metric: str) -> str:
    if metric == "manhattan":
        return ("list_reduce(list_transform(list_zip(q.embedding, t.embedding), "
                "lambda z: abs(z[1]::DOUBLE - z[2]::DOUBLE)), lambda a, b: a + b, 0.0::DOUBLE)")
    return ("sqrt(list_reduce(list_transform(list_zip(q.embedding, t.embedding), "
            "lambda z: (z[1]::DOUBLE - z[2]::DOUBLE) * (z[1]::DOUBLE - z[2]::DOUBLE)), lambda a, b: a + b, 0.0::DOUBLE))")


def neighbours_sql(k: int, metric: str = "manhattan", folds: str | None = None) -> str:
    return f"""(WITH f AS {folds or EMB_FOLDS_SQL},
  pairs AS (SELECT q.vec_id AS query, t.vec_id AS neighbor, t.label AS label, q.fold AS fold, q.label AS y,
                   {_dist(metric)} AS d FROM f q JOIN f t ON q.fold <> t.fold),
  r AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY round(d, 9), neighbor) AS rn FROM pairs)
  SELECT * FROM r WHERE rn <= {k})"""


def predictions_sql(ks: list[int], weights: str, metric: str = "manhattan", folds: str | None = None) -> str:
    kv = ", ".join(f"({k})" for k in ks)
    if weights == "distance":
        w = ("CASE WHEN max(CASE WHEN d = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY query, k) = 1 "
             "THEN CASE WHEN d = 0 THEN 1.0 ELSE 0.0 END ELSE 1.0 / d END")
    else:
        w = "1.0"
    return f"""(WITH nb AS {neighbours_sql(max(ks), metric, folds)},
  nk AS (SELECT nb.*, ks.k FROM nb JOIN (VALUES {kv}) ks(k) ON nb.rn <= ks.k),
  wt AS (SELECT query, fold, y, k, label, {w} AS w FROM nk),
  v AS (SELECT query, fold, y, k, label, sum(w) AS w FROM wt GROUP BY ALL),
  tot AS (SELECT query, k, sum(w) AS tot FROM v GROUP BY ALL)
  SELECT query, any_value(fold) AS fold, any_value(y) AS y, k, arg_max(label, (w, -label)) AS pred,
         map_from_entries(list((label, w / tot))) AS pm
  FROM v JOIN tot USING (query, k) GROUP BY query, k)"""


ORACLE["knn_neighbours"] = f"SELECT query, neighbor, round(d, 6) AS d, rn::INTEGER AS rn FROM {neighbours_sql(5)}"
ORACLE["knn_neighbours_euclidean"] = f"SELECT query, neighbor, round(d, 6) AS d, rn::INTEGER AS rn FROM {neighbours_sql(5, 'euclidean')}"
ORACLE["knn_many_levels"] = """
WITH e AS (SELECT min(o_totalprice) AS p0, max(o_totalprice) AS p1 FROM orders),
x AS (SELECT o_orderkey AS k, o_custkey, o_orderpriority, o_orderstatus, (o_totalprice - p0) / (p1 - p0) AS p FROM orders, e),
d AS (SELECT q.k AS query, t.k AS neighbor, abs(q.p - t.p)
             + 2 * ((q.o_custkey IS DISTINCT FROM t.o_custkey)::INT + (q.o_orderpriority IS DISTINCT FROM t.o_orderpriority)::INT
                    + (q.o_orderstatus IS DISTINCT FROM t.o_orderstatus)::INT) AS d
      FROM x q, x t WHERE q.k % 100 = 0),
n AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY round(d, 9), neighbor) AS rn FROM d)
SELECT query, neighbor, round(d, 6) AS d, rn::INTEGER AS rn FROM n WHERE rn <= 5"""
ORACLE["knn_vote_uniform"] = f"SELECT query, pred FROM {predictions_sql([5], 'uniform')}"
ORACLE["knn_vote_distance"] = f"SELECT query, pred FROM {predictions_sql([5], 'distance')}"
ORACLE["knn_many_k"] = f"SELECT query, k, pred FROM {predictions_sql([1, 5, 15], 'uniform')}"
ORACLE["knn_class_distribution"] = f"""
SELECT query, c.cls::INTEGER AS cls, round(coalesce(pm[c.cls], 0.0), 6) AS prob
FROM {predictions_sql([15], 'distance')} p, range(0, 10) c(cls)"""

KNN5_CONF = f"(SELECT fold, y, pred, count(*) AS n FROM {predictions_sql([5], 'distance')} GROUP BY ALL)"


def class_totals_sql(conf: str, by: list[str]) -> str:
    b = ", ".join(by)
    bc = (b + ", ") if by else ""
    return f"""(SELECT {bc}cls, sum(t) AS t, sum(p) AS p, sum(tp) AS tp FROM (
    SELECT {bc}y AS cls, n AS t, 0 AS p, CASE WHEN y = pred THEN n ELSE 0 END AS tp FROM {conf}
    UNION ALL SELECT {bc}pred AS cls, 0 AS t, n AS p, 0 AS tp FROM {conf}) GROUP BY ALL)"""


def scores_sql(conf: str, by: list[str], domain: str = "observed", n_classes: int = 10) -> str:
    b = ", ".join(by)
    bc = (b + ", ") if by else ""
    den = "count(*)" if domain == "observed" else f"{float(n_classes)}"
    return f"""(WITH ct AS {class_totals_sql(conf, by)},
  g AS (SELECT {bc}sum(tp) AS c, sum(t)::DOUBLE AS s,
        avg(CASE WHEN t > 0 THEN tp / t END) AS bal,
        sum(coalesce(2.0 * tp / nullif(t + p, 0), 0)) / {den} AS f1m,
        sum(coalesce(2.0 * tp / nullif(t + p, 0), 0) * t) AS f1w,
        sum(p * t) AS pt, sum(p * p) AS pp, sum(t * t) AS tt,
        avg(coalesce(tp / nullif(p, 0), 0)) AS prec, avg(coalesce(tp / nullif(t, 0), 0)) AS rec
        FROM ct {"GROUP BY " + b if by else ""})
  SELECT {bc}round(c / s, 6) AS accuracy, round(bal, 6) AS balanced_accuracy, round(f1m, 6) AS f1_macro,
         round(f1w / s, 6) AS f1_weighted,
         round(coalesce((c * s - pt) / nullif(sqrt((s * s - pp) * (s * s - tt)), 0), 0), 6) AS mcc,
         round(coalesce((c / s - pt / (s * s)) / nullif(1.0 - pt / (s * s), 0), 0), 6) AS kappa,
         round(prec, 6) AS precision_macro, round(rec, 6) AS recall_macro FROM g)"""


ORACLE["confusion_counts"] = f"""
SELECT f.fold, a.y::INTEGER AS y, b.pred::INTEGER AS pred, coalesce(c.n, 0)::BIGINT AS n
FROM (SELECT DISTINCT fold FROM {KNN5_CONF}) f, range(0, 10) a(y), range(0, 10) b(pred)
LEFT JOIN {KNN5_CONF} c ON c.fold = f.fold AND c.y = a.y AND c.pred = b.pred"""
ORACLE["fold_metrics"] = f"SELECT * FROM {scores_sql(KNN5_CONF, ['fold'])}"
ORACLE["fold_metrics_all_classes"] = f"SELECT fold, f1_macro FROM {scores_sql(KNN5_CONF, ['fold'], 'all', 10)}"
ORACLE["per_class_metrics"] = f"""
SELECT fold, cls, round(coalesce(tp / nullif(p, 0), 0), 6) AS precision, round(coalesce(tp / nullif(t, 0), 0), 6) AS recall,
       round(coalesce(2.0 * tp / nullif(t + p, 0), 0), 6) AS f1, t::BIGINT AS support FROM {class_totals_sql(KNN5_CONF, ['fold'])}"""

KNN_CONFIGS = " UNION ALL ".join(
    f"SELECT 'knn_k' || CAST(k AS VARCHAR) || '_{w}' AS configuration, query, fold, y, pred FROM {predictions_sql([1, 5, 15], w)}"
    for w in ("uniform", "distance"))
CONFIG_CONF = f"(SELECT configuration, fold, y, pred, count(*) AS n FROM ({KNN_CONFIGS}) GROUP BY ALL)"
ORACLE["pooled_precision_recall"] = f"""
SELECT configuration, precision_macro AS precision_macro_pooled, recall_macro AS recall_macro_pooled
FROM {scores_sql(f"(SELECT configuration, y, pred, sum(n) AS n FROM {CONFIG_CONF} GROUP BY ALL)", ['configuration'])}"""
_M = ["accuracy", "balanced_accuracy", "f1_macro", "f1_weighted", "mcc", "kappa", "precision_macro", "recall_macro"]
ORACLE["config_summary"] = f"""
SELECT configuration, {", ".join(f"round(avg({m}), 6) AS {m}_mean, round(stddev_samp({m}), 6) AS {m}_std" for m in _M)},
       count(*)::BIGINT AS n_folds
FROM {scores_sql(CONFIG_CONF, ['configuration', 'fold'])} GROUP BY configuration"""
ORACLE["row_normalised_confusion"] = f"""
WITH c AS (SELECT y, pred, sum(n) AS n FROM {KNN5_CONF} GROUP BY ALL)
SELECT y, pred, n, round(n / greatest(sum(n) OVER (PARTITION BY y), 1), 6) AS share FROM c"""


# ---------------------------------------------------------------- bounds
BF = "l_quantity, l_linenumber, l_linestatus"
LI_KEYED = ("(SELECT *, concat_ws('-', l_orderkey, l_partkey, l_suppkey, l_linenumber) AS row_key "
            "FROM lineitem)")
LI_EVAL = (f"(SELECT row_key, {BF}, l_returnflag FROM "
           f"{split_sql(LI_KEYED, 'row_key', 'l_returnflag', 0.25)} WHERE part = 'evaluation')")
LI_FOLDS = folds_sql(LI_EVAL, "row_key", "l_returnflag", 10)


def _f1_sql(conf: str, by: str) -> str:
    return f"""(SELECT {by}, cls, coalesce(2.0 * sum(tp) / nullif(sum(t) + sum(p), 0), 0) AS f1 FROM (
   SELECT {by}, y AS cls, n AS t, 0 AS p, CASE WHEN y = pred THEN n ELSE 0 END AS tp FROM {conf}
   UNION ALL SELECT {by}, pred AS cls, 0, n, 0 FROM {conf}) GROUP BY ALL)"""


RESUB_CONF = f"""(WITH vl AS (SELECT {BF}, l_returnflag AS y, count(*) AS n FROM lineitem GROUP BY ALL),
  m AS (SELECT *, first(y) OVER (PARTITION BY {BF} ORDER BY n DESC, y) AS pred FROM vl)
  SELECT 1 AS one, y, pred, sum(n) AS n FROM m GROUP BY ALL)"""

ORACLE["bound_resubstitution"] = f"""
WITH c AS {RESUB_CONF}, f AS {_f1_sql('c', 'one')}
SELECT (SELECT count(*) FROM (SELECT DISTINCT {BF} FROM lineitem))::BIGINT AS distinct_vectors,
       (SELECT count(*) FROM lineitem)::BIGINT AS total_rows,
       round((SELECT sum(n) FILTER (WHERE y = pred) / sum(n) FROM c), 6) AS accuracy,
       round((SELECT sum(f1) / (SELECT count(DISTINCT l_returnflag) FROM lineitem) FROM f), 6) AS f1_macro"""

ORACLE["bound_resubstitution_per_class"] = f"""
WITH c AS {RESUB_CONF}, f AS {_f1_sql('c', 'one')},
s AS (SELECT y AS cls, sum(n) AS support FROM c GROUP BY 1)
SELECT f.cls, round(f1, 6) AS f1_resubstitution, coalesce(support, 0)::BIGINT AS support
FROM f LEFT JOIN s USING (cls)"""

MEM_PRED = f"""(WITH ev AS {LI_FOLDS},
  cf AS (SELECT fold, {BF}, l_returnflag AS y, count(*) AS n_f FROM ev GROUP BY ALL),
  tot AS (SELECT {BF}, y, sum(n_f) AS n_all FROM cf GROUP BY ALL),
  held AS (SELECT DISTINCT fold, {BF} FROM cf),
  tr AS (SELECT h.fold, h.l_quantity, h.l_linenumber, h.l_linestatus, t.y, t.n_all - coalesce(c.n_f, 0) AS n_tr
         FROM held h JOIN tot t USING ({BF})
         LEFT JOIN cf c ON c.fold = h.fold AND c.l_quantity = h.l_quantity AND c.l_linenumber = h.l_linenumber
                        AND c.l_linestatus = h.l_linestatus AND c.y = t.y),
  maj AS (SELECT fold, {BF}, y AS majority FROM (
          SELECT *, row_number() OVER (PARTITION BY fold, {BF} ORDER BY n_tr DESC, y) AS rn FROM tr WHERE n_tr > 0) WHERE rn = 1),
  cls AS (SELECT fold, y, sum(n_f) AS n_fc FROM cf GROUP BY ALL),
  fb AS (SELECT fold, y AS fallback FROM (
          SELECT c.fold, c.y, row_number() OVER (PARTITION BY c.fold ORDER BY t.n_c - c.n_fc DESC, c.y) AS rn
          FROM cls c JOIN (SELECT y, sum(n_fc) AS n_c FROM cls GROUP BY y) t USING (y)) WHERE rn = 1)
  SELECT cf.fold, cf.y, cf.n_f AS n, maj.majority IS NOT NULL AS hit, coalesce(maj.majority, fb.fallback) AS pred,
         CASE WHEN maj.majority IS NOT NULL THEN maj.majority ELSE cf.y END AS conceded
  FROM cf LEFT JOIN maj USING (fold, {BF}) LEFT JOIN fb USING (fold))"""

MEM_PER_CLASS = f"""(WITH mp AS {MEM_PRED},
  cm AS (SELECT fold, y, pred, sum(n) AS n FROM mp GROUP BY ALL),
  cc AS (SELECT fold, y, conceded AS pred, sum(n) AS n FROM mp GROUP BY ALL),
  fm AS {_f1_sql('cm', 'fold')}, fc AS {_f1_sql('cc', 'fold')},
  grid AS (SELECT fold, cls FROM (SELECT DISTINCT fold FROM mp), (SELECT DISTINCT l_returnflag AS cls FROM lineitem))
  SELECT cls, round(avg(coalesce(fm.f1, 0)), 6) AS f1_memorisation_cv, round(avg(coalesce(fc.f1, 0)), 6) AS f1_conceded_cv
  FROM grid LEFT JOIN fm USING (fold, cls) LEFT JOIN fc USING (fold, cls) GROUP BY cls)"""

MATCHED = f"""(SELECT round(avg(m), 6) AS matched_fraction, count(*)::BIGINT AS n_folds FROM (
  SELECT fold, sum(CASE WHEN hit THEN n ELSE 0 END) / sum(n) AS m FROM {MEM_PRED} GROUP BY fold))"""

ORACLE["bound_memorisation_cv"] = f"SELECT * FROM {MEM_PER_CLASS}"
ORACLE["matched_fraction"] = f"SELECT * FROM {MATCHED}"
ORACLE["bound_cv_summary"] = f"""
SELECT round(avg(f1_memorisation_cv), 6) AS macro_f1_memorisation_cv, round(avg(f1_conceded_cv), 6) AS macro_f1_conceded_cv,
       any_value(m.matched_fraction) AS matched_fraction, any_value(m.n_folds) AS n_folds
FROM {MEM_PER_CLASS}, {MATCHED} m"""


# ---------------------------------------------------------------- paired statistics
FT = (f"(SELECT fold AS block, CAST(o_orderpriority AS VARCHAR) AS grp, round(avg(o_totalprice), 6) AS metric "
      f"FROM {folds_sql('orders', 'o_orderkey', 'o_orderpriority', 10)} GROUP BY ALL)")
PAIRS = f"""(SELECT a.block, a.grp AS group_a, b.grp AS group_b, a.metric AS a, b.metric AS b, a.metric - b.metric AS d
  FROM {FT} a JOIN {FT} b ON a.block = b.block AND a.grp < b.grp)"""

ORACLE["friedman"] = f"""
WITH ft AS {FT},
rk AS (SELECT *, rank() OVER (PARTITION BY block ORDER BY metric) + (count(*) OVER (PARTITION BY block, metric) - 1) / 2.0 AS rr FROM ft),
ties AS (SELECT sum(t * t * t - t) AS tie FROM (SELECT block, metric, count(*) AS t FROM ft GROUP BY ALL)),
rs AS (SELECT grp, sum(rr) AS rsum FROM rk GROUP BY grp),
g AS (SELECT sum(rsum * rsum) AS ssr, count(*) AS k FROM rs),
nb AS (SELECT count(DISTINCT block) AS nblk FROM ft),
st AS (SELECT round((12.0 / (nblk * k * (k + 1)) * ssr - 3.0 * nblk * (k + 1)) / (1.0 - tie / (nblk * k * (k * k - 1))), 6) AS statistic,
              k::INTEGER AS n_groups, nblk::INTEGER AS n_folds FROM g, nb, ties)
SELECT statistic, n_groups, n_folds,
       round(least(1.0, exp(-statistic / 2) * (SELECT sum(pow(statistic / 2, i) / factorial(i::INTEGER)) FROM range(0, (n_groups - 1) // 2) t(i))), 9) AS p_value
FROM st"""

WILCOXON = f"""(WITH pd AS {PAIRS},
  nz AS (SELECT *, abs(d) AS ad FROM pd WHERE d <> 0),
  r AS (SELECT *, rank() OVER (PARTITION BY group_a, group_b ORDER BY ad) + (count(*) OVER (PARTITION BY group_a, group_b, ad) - 1) / 2.0 AS rk,
               row_number() OVER (PARTITION BY group_a, group_b ORDER BY block) - 1 AS idx FROM nz),
  g AS (SELECT group_a, group_b, count(*) AS n, sum(CASE WHEN d > 0 THEN rk ELSE 0 END) AS wp,
               sum(CASE WHEN d < 0 THEN rk ELSE 0 END) AS wm FROM r GROUP BY ALL),
  pat AS (SELECT g.group_a, g.group_b, s.pattern FROM g, LATERAL range(0, (1 << g.n)::BIGINT) s(pattern)),
  wpat AS (SELECT p.group_a, p.group_b, p.pattern, sum(CASE WHEN (p.pattern >> r.idx) & 1 = 1 THEN r.rk ELSE 0 END) AS wplus
           FROM pat p JOIN r USING (group_a, group_b) GROUP BY ALL),
  cnt AS (SELECT w.group_a, w.group_b, count(*) FILTER (WHERE wplus <= least(g.wp, g.wm)) AS c
          FROM wpat w JOIN g USING (group_a, group_b) GROUP BY ALL)
  SELECT group_a, group_b, n::INTEGER AS n, least(wp, wm) AS wilcoxon_statistic,
         round(least(1.0, 2.0 * c / pow(2, n)), 9) AS wilcoxon_p FROM g JOIN cnt USING (group_a, group_b))"""
ORACLE["wilcoxon_pairs"] = f"SELECT * FROM {WILCOXON}"

ORACLE["paired_t"] = f"""
WITH g AS (SELECT group_a, group_b, avg(a) AS ma, avg(b) AS mb, avg(d) AS md, count(*) AS n, count(*) - 1 AS v,
                  avg(d) / (stddev_samp(d) / sqrt(count(*))) AS t FROM {PAIRS} GROUP BY ALL),
a AS (SELECT *, atan(abs(t) / sqrt(v)) AS th, v % 2 AS o FROM g),
s AS (SELECT *, sin(th) * list_sum(list_transform(range(v // 2), lambda k: (CASE WHEN o = 1 THEN cos(th) ELSE 1.0 END)
        * coalesce(list_product(list_transform(range(1, k + 1), lambda i: (2 * i - 1 + o) / (2 * i + o) * cos(th) * cos(th))), 1.0))) AS inside FROM a)
SELECT group_a, group_b, round(ma, 6) AS mean_a, round(mb, 6) AS mean_b, round(md, 6) AS mean_difference,
       round(t, 6) AS paired_t_statistic,
       round(1.0 - CASE WHEN o = 1 THEN 2.0 / pi() * (th + inside) ELSE inside END, 9) AS paired_t_p, n::INTEGER AS n
FROM s"""

ORACLE["holm"] = f"""
WITH w AS (SELECT group_a, group_b, wilcoxon_p FROM {WILCOXON}),
o AS (SELECT *, (count(*) OVER () - row_number() OVER (ORDER BY wilcoxon_p, group_a, group_b) + 1) * wilcoxon_p AS s,
             row_number() OVER (ORDER BY wilcoxon_p, group_a, group_b) AS i FROM w)
SELECT group_a, group_b, wilcoxon_p,
       round(least(1.0, max(s) OVER (ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)), 9) AS holm_p,
       round(least(1.0, max(s) OVER (ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)), 9) < 0.05 AS significant
FROM o"""

ORACLE["diff_shape"] = f"""
SELECT group_a, group_b,
       round(skewness(d) * (count(*) - 2) / sqrt(count(*) * (count(*) - 1)), 6) AS skewness,
       round(kurtosis_pop(d), 6) AS kurtosis,
       round(count(*) / 6.0 * (pow(skewness(d) * (count(*) - 2) / sqrt(count(*) * (count(*) - 1)), 2) + pow(kurtosis_pop(d), 2) / 4.0), 6) AS jarque_bera
FROM {PAIRS} GROUP BY ALL"""

ORACLE["fold_winners"] = f"""
SELECT grp, count(*)::BIGINT AS folds_won FROM (
  SELECT *, row_number() OVER (PARTITION BY block ORDER BY metric DESC, grp) AS rn FROM {FT}) WHERE rn = 1 GROUP BY grp"""

ORACLE["fold_margins"] = f"""
WITH p AS (SELECT block, max(CASE WHEN grp = '1-URGENT' THEN metric END) AS a, max(CASE WHEN grp = '5-LOW' THEN metric END) AS b
           FROM {FT} GROUP BY block)
SELECT round(min(a - b), 6) AS min_margin, round(max(a - b), 6) AS max_margin, count(*) FILTER (WHERE a > b)::BIGINT AS blocks_a_ahead FROM p"""

ORACLE["paired_wins"] = f"""
SELECT group_a, group_b, count(*) FILTER (WHERE a > b)::BIGINT AS wins, count(*) FILTER (WHERE a >= b)::BIGINT AS wins_or_ties,
       round(avg(d), 6) AS mean_gain FROM {PAIRS} GROUP BY ALL"""

ORACLE["lead_share"] = f"""
WITH items AS (
  SELECT t.block, max(CASE WHEN grp = '1-URGENT' THEN metric END) AS a, max(CASE WHEN grp = '2-HIGH' THEN metric END) AS b,
         any_value(s.rows) AS rows
  FROM {FT} t JOIN (SELECT fold AS block, count(*) AS rows FROM {folds_sql('orders', 'o_orderkey', 'o_orderpriority', 10)} GROUP BY 1) s
    USING (block) GROUP BY t.block),
s AS (SELECT *, CASE WHEN a - b > 1000.0 THEN 'a' WHEN b - a > 1000.0 THEN 'b' ELSE 'tie' END AS side FROM items),
g AS (SELECT side, count(*)::BIGINT AS items, sum(rows) AS w,
             array_to_string(list_sort(list(CAST(block AS VARCHAR))), ',') AS members FROM s GROUP BY side)
SELECT side, items, members, round(w / sum(w) OVER (), 6) AS share FROM g"""

_SPLIT_O = split_sql("orders", "o_orderkey", "o_orderpriority", 0.25)
ORACLE["rank_stability"] = f"""
WITH t AS (SELECT part, CAST(o_orderpriority AS VARCHAR) AS grp, round(avg(o_totalprice), 6) AS metric FROM {_SPLIT_O} GROUP BY ALL),
r1 AS (SELECT grp, metric AS m1, rank() OVER (ORDER BY metric DESC) + (count(*) OVER (PARTITION BY metric) - 1) / 2.0 AS rank_1 FROM t WHERE part = 'tuning'),
r2 AS (SELECT grp, metric AS m2, rank() OVER (ORDER BY metric DESC) + (count(*) OVER (PARTITION BY metric) - 1) / 2.0 AS rank_2 FROM t WHERE part = 'evaluation')
SELECT grp, m1 AS metric_1, m2 AS metric_2, round(m2 - m1, 6) AS gain, rank_1, rank_2, rank_1 = rank_2 AS same_rank
FROM r1 JOIN r2 USING (grp)"""

ORACLE["stepwise_gain"] = """
WITH t AS (SELECT grp, round(avg(metric), 6) AS metric FROM (
  SELECT o_orderstatus, CAST(o_orderpriority AS VARCHAR) AS grp, round(avg(o_totalprice), 6) AS metric FROM orders GROUP BY ALL) GROUP BY grp)
SELECT grp, metric, round(coalesce(metric - lag(metric) OVER (ORDER BY grp), 0.0), 6) AS gain FROM t"""


# ---------------------------------------------------------------- features
DOC_SPLIT = split_sql("documents", "doc_id", "lang", 0.25)
RARE_KEPT = f"""(WITH t AS (SELECT lang FROM {DOC_SPLIT} WHERE part = 'evaluation'),
  c AS (SELECT lang AS level, count(*) AS n FROM t GROUP BY 1),
  s AS (SELECT *, n / sum(n) OVER () AS share, row_number() OVER (ORDER BY n DESC, level) AS rk FROM c)
  SELECT level FROM s WHERE share >= 0.12 OR (rk = 1 AND (SELECT max(share) FROM s) < 0.12))"""
ORACLE["rare_levels"] = f"""
SELECT doc_id, CASE WHEN lang IN (SELECT level FROM {RARE_KEPT}) THEN lang ELSE 'other' END AS lang FROM documents"""
ORACLE["one_hot"] = f"""
WITH lv AS (SELECT list_sort(list(DISTINCT CASE WHEN lang IN (SELECT level FROM {RARE_KEPT}) THEN lang ELSE 'other' END)) AS levels
            FROM {DOC_SPLIT} WHERE part = 'evaluation'),
g AS (SELECT doc_id, CASE WHEN lang IN (SELECT level FROM {RARE_KEPT}) THEN lang ELSE 'other' END AS lang FROM documents)
SELECT doc_id, array_to_string(list_transform(levels, lambda l: CASE WHEN l = lang THEN '1' ELSE '0' END), ',') AS onehot FROM g, lv"""

PART_SPLIT = split_sql("part", "p_partkey", "p_size", 0.25)


def _codes(c: str) -> str:
    return (f"(SELECT lv, (row_number() OVER (ORDER BY lv) - 1)::INTEGER AS code FROM "
            f"(SELECT DISTINCT CAST({c} AS VARCHAR) AS lv FROM {PART_SPLIT} WHERE part = 'tuning'))")


ORACLE["ordinal_codes"] = f"""
SELECT p.p_partkey, coalesce(a.code, -1) AS p_type_code, coalesce(b.code, -1) AS p_brand_code, coalesce(c.code, -1) AS p_name_code
FROM part p LEFT JOIN {_codes('p_type')} a ON a.lv = p.p_type LEFT JOIN {_codes('p_brand')} b ON b.lv = p.p_brand
LEFT JOIN {_codes('p_name')} c ON c.lv = p.p_name"""

ORACLE["constant_filter"] = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, coalesce(min({c}) < max({c}), false) AS kept FROM (SELECT *, 'labels' AS source_table FROM labels)"
    for c in ["doc_id", "quality", "toxic", "source_table"])

ORACLE["leave_fold_out_params"] = f"""
WITH f AS {folds_sql('orders', 'o_orderkey', 'o_orderpriority', 10)},
lv AS (SELECT fold, 'o_orderstatus' AS feature, CAST(o_orderstatus AS VARCHAR) AS level, count(*) AS n_f FROM f GROUP BY ALL),
tot AS (SELECT feature, level, sum(n_f) AS n_all FROM lv GROUP BY ALL),
fl AS (SELECT d.fold, t.feature, t.level, t.n_all FROM tot t JOIN (SELECT DISTINCT feature, fold FROM lv) d USING (feature)),
t AS (SELECT fl.fold, fl.feature, fl.level, fl.n_all - coalesce(lv.n_f, 0) AS n_train FROM fl LEFT JOIN lv USING (fold, feature, level))
SELECT fold, feature, level, n_train::BIGINT AS n_train, round(n_train / sum(n_train) OVER (PARTITION BY fold, feature), 6) AS share,
       round(n_train / sum(n_train) OVER (PARTITION BY fold, feature), 6) >= 0.3 AS kept FROM t"""

# quantile knots: the training folds hold more than 1,000 rows at every driver scale
REFS_1000 = "[" + ", ".join(repr(float(v)) for v in __import__("numpy").linspace(0, 1, 1000)) + "]::DOUBLE[]"
LI_FOLDS_ALL = folds_sql(LI_KEYED, "row_key", "l_returnflag", 10)
_SC = ["l_quantity", "l_extendedprice", "l_discount"]


def _scale_sql(kind: str) -> str:
    sel = []
    for c in _SC:
        x = f"CAST({c} AS DOUBLE)"
        if kind == "minmax":
            e = (f"({x} - (SELECT min({x}) FROM tr)) / (SELECT CASE WHEN max({x}) - min({x}) <> 0 THEN max({x}) - min({x}) ELSE 1.0 END FROM tr)")
        elif kind == "log":
            lx = f"ln(1 + greatest({x}, 0.0))"
            e = (f"({lx} - (SELECT min({lx}) FROM tr)) / (SELECT CASE WHEN max({lx}) - min({lx}) <> 0 THEN max({lx}) - min({lx}) ELSE 1.0 END FROM tr)")
        elif kind == "zscore":
            e = f"({x} - (SELECT avg({x}) FROM tr)) / (SELECT CASE WHEN stddev_pop({x}) <> 0 THEN stddev_pop({x}) ELSE 1.0 END FROM tr)"
        elif kind == "robust":
            e = (f"({x} - (SELECT quantile_cont({x}, 0.5) FROM tr)) / (SELECT CASE WHEN quantile_cont({x}, 0.75) - quantile_cont({x}, 0.25) <> 0 "
                 f"THEN quantile_cont({x}, 0.75) - quantile_cont({x}, 0.25) ELSE 1.0 END FROM tr)")
        else:
            e = f"r_{c}"
        sel.append(f"round({e}, 6) AS {c}")
    if kind != "rank":
        return f"WITH f AS {LI_FOLDS_ALL}, tr AS (SELECT * FROM f WHERE fold <> 0) SELECT row_key, {', '.join(sel)} FROM f WHERE fold = 0"
    # rank: 1000 exact quantile knots, forward/backward interpolation averaged, bounds pinned
    parts = []
    for c in _SC:
        x = f"CAST({c} AS DOUBLE)"
        parts.append(f"""kn_{c} AS (SELECT quantile_cont({x}, {REFS_1000}) AS K, {REFS_1000} AS R FROM tr)""")
    body = []
    for c in _SC:
        x = f"CAST(te.{c} AS DOUBLE)"
        body.append(f"""ip_{c} AS (SELECT row_key, x, K, R, len(K) AS m,
              len(list_filter(K, lambda k: k <= x)) AS lo, len(K) - len(list_filter(K, lambda k: k >= x)) + 1 AS hi
            FROM (SELECT row_key, {x} AS x FROM te), kn_{c}),
  v_{c} AS (SELECT row_key, CASE WHEN x - 1e-7 < K[1] THEN R[1] WHEN x + 1e-7 > K[m] THEN R[m] ELSE 0.5 * (
      (CASE WHEN lo = 0 THEN R[1] WHEN lo >= m THEN R[m] WHEN K[lo] = x THEN R[lo]
            ELSE (R[lo + 1] - R[lo]) / (K[lo + 1] - K[lo]) * (x - K[lo]) + R[lo] END) +
      (CASE WHEN hi > m THEN R[m] WHEN hi <= 1 THEN R[1] WHEN K[hi] = x THEN R[hi]
            ELSE R[hi] - (R[hi] - R[hi - 1]) / (K[hi] - K[hi - 1]) * (K[hi] - x) END)) END AS r_{c} FROM ip_{c})""")
    return f"""WITH f AS {LI_FOLDS_ALL}, tr AS (SELECT * FROM f WHERE fold <> 0), te AS (SELECT * FROM f WHERE fold = 0),
  {', '.join(parts)}, {', '.join(body)}
  SELECT row_key, {', '.join(sel)} FROM te JOIN v_l_quantity USING (row_key) JOIN v_l_extendedprice USING (row_key)
  JOIN v_l_discount USING (row_key)"""


def _every_fold(sql: str, k: int = 10) -> str:
    """The held-out fold 0 of ``sql`` in turn replaced by every fold."""
    return " UNION ALL ".join(f"SELECT * FROM ({sql.replace('fold <> 0', f'fold <> {i}').replace('fold = 0', f'fold = {i}')})" for i in range(k))


for _k in ("minmax", "zscore", "robust", "log", "rank"):
    ORACLE[f"scale_{_k}"] = _every_fold(_scale_sql(_k))


# ---------------------------------------------------------------- trees, rules, SMOTE
ORACLE["power_class_weights"] = """
SELECT toxic, n, round(pow(sum(n) OVER () / (count(*) OVER () * n), 0.75), 9) AS w
FROM (SELECT toxic, count(*) AS n FROM labels GROUP BY 1)"""

ORACLE["weighted_argmax"] = f"""
WITH p AS {predictions_sql([15], 'distance')},
wt AS (SELECT label AS cls, round(pow(sum(n) OVER () / (count(*) OVER () * n), 1.0), 9) AS w
       FROM (SELECT label, count(*) AS n FROM embeddings GROUP BY 1)),
x AS (SELECT p.query, wt.cls, coalesce(p.pm[wt.cls], 0.0) * wt.w AS v FROM p, wt)
SELECT query, arg_max(cls, (v, -cls)) AS pred FROM x GROUP BY query"""

LD = """(SELECT d.doc_id, l.toxic, d.n_chars::DOUBLE AS x0,
   (length(d.text) - length(replace(d.text, ' ', '')))::DOUBLE AS x1,
   (length(d.text) - length(replace(d.text, chr(10), '')) + 1)::DOUBLE AS x2
   FROM documents d JOIN labels l USING (doc_id))"""
ORACLE["smote_rows"] = f"""
WITH ld AS {LD},
tg AS (SELECT toxic, n, greatest(n, ceil(0.25 * max(n) OVER ()))::BIGINT - n AS need FROM (SELECT toxic, count(*) AS n FROM ld GROUP BY 1)),
ke AS (SELECT greatest(1, least(5, min(n) - 1)) AS k FROM tg),
rk AS {rank_sql('ld', 'doc_id', 'toxic')},
mino AS (SELECT * FROM ld WHERE toxic IN (SELECT toxic FROM tg WHERE need > 0)),
pairs AS (SELECT q.doc_id AS base, t.doc_id AS neighbor, q.toxic,
          abs(q.x0 - t.x0) + abs(q.x1 - t.x1) + abs(q.x2 - t.x2) AS d
          FROM mino q JOIN mino t ON q.toxic = t.toxic AND q.doc_id <> t.doc_id),
nb AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY base ORDER BY round(d, 9), neighbor) AS rn FROM pairs)
       WHERE rn <= (SELECT k FROM ke)),
syn AS (SELECT tg.toxic, tg.n, s.i FROM tg, LATERAL range(1, tg.need + 1) s(i) WHERE tg.need > 0),
h AS (SELECT toxic, i, n,
        ('0x' || substr(md5('42-' || CAST(toxic AS VARCHAR) || '-' || CAST(i AS VARCHAR) || '-base'), 1, 8))::BIGINT AS h1,
        ('0x' || substr(md5('42-' || CAST(toxic AS VARCHAR) || '-' || CAST(i AS VARCHAR) || '-nn'), 1, 8))::BIGINT AS h2,
        ('0x' || substr(md5('42-' || CAST(toxic AS VARCHAR) || '-' || CAST(i AS VARCHAR) || '-gap'), 1, 8))::BIGINT AS h3 FROM syn),
sel AS (SELECT toxic, i, h1 % n + 1 AS rank_in_class, (h2 % (SELECT k FROM ke) + 1)::INTEGER AS rn, h3 / 4294967296.0 AS u FROM h),
b AS (SELECT sel.*, rk.doc_id AS base, rk.x0, rk.x1, rk.x2 FROM sel JOIN rk USING (toxic, rank_in_class)),
j AS (SELECT b.*, nb.neighbor FROM b JOIN nb ON nb.base = b.base AND nb.rn = b.rn)
SELECT j.toxic, j.i, j.base, j.neighbor, round(u, 9) AS u,
       round(j.x0 + u * (t.x0 - j.x0), 6) AS x0, round(j.x1 + u * (t.x1 - j.x1), 6) AS x1,
       round(j.x2 + u * (t.x2 - j.x2), 6) AS x2
FROM j JOIN ld t ON t.doc_id = j.neighbor"""


# ---------------------------------------------------------------- report tables and checks
ORACLE["report_class_distribution"] = f"""
WITH b AS ({ORACLE['audit_class_balance']}),
r AS (SELECT class, code, count, percent, (row_number() OVER (ORDER BY count DESC, code) - 1)::INTEGER AS ord FROM b)
SELECT * FROM r UNION ALL
SELECT 'total', NULL::INTEGER, sum(count)::BIGINT, round(sum(percent), 3), count(*)::INTEGER FROM b"""

ORACLE["report_top_correlations"] = f"""
WITH dm AS {DOC_MEASURES_SQL}, c AS ({_CORR_PAIRS})
SELECT * FROM c WHERE abs_r IS NOT NULL ORDER BY abs_r DESC, feature_a, feature_b LIMIT 3"""

ORACLE["report_most_skewed"] = f"""
WITH p AS {PROFILE_LI_PART}
SELECT feature, minimum, maximum, skewness, coalesce(printf('%.2f', pct_outlier), '--') AS pct_outlier
FROM p WHERE kind = 'numeric' AND skewness IS NOT NULL ORDER BY skewness DESC, feature LIMIT 4"""

_CFGS = [f"knn_k{k}_{w}" for w in ("uniform", "distance") for k in (1, 5, 15)]
CFG_FOLDS = scores_sql(CONFIG_CONF, ["configuration", "fold"])
ORACLE["report_final"] = f"""
WITH f AS {CFG_FOLDS},
s AS (SELECT configuration, round(avg(accuracy), 6) AS accuracy, round(avg(balanced_accuracy), 6) AS balanced_accuracy,
             round(avg(f1_macro), 6) AS f1_macro, round(avg(kappa), 6) AS kappa FROM f GROUP BY configuration),
l AS ({" UNION ALL ".join(f"SELECT configuration, '{m}' AS metric, {m} AS v FROM s" for m in ["accuracy", "balanced_accuracy", "f1_macro", "kappa"])})
SELECT metric, {", ".join(f"max(v) FILTER (WHERE configuration = '{c}') AS {c}" for c in _CFGS)} FROM l GROUP BY metric"""

ORACLE["report_per_class"] = f"""
WITH ct AS {class_totals_sql(CONFIG_CONF, ['configuration', 'fold'])},
pc AS (SELECT configuration, fold, cls, round(coalesce(tp / nullif(t, 0), 0), 6) AS recall, t FROM ct),
m AS (SELECT cls, configuration, round(avg(recall), 6) AS recall, sum(t) AS n FROM pc GROUP BY ALL)
SELECT cls, {", ".join(f"max(recall) FILTER (WHERE configuration = '{c}') AS {c}" for c in _CFGS)}, max(n)::BIGINT AS n
FROM m GROUP BY cls"""

ORACLE["report_class_leads"] = f"""
WITH p AS (SELECT cls, n, round(knn_k15_distance - knn_k1_uniform, 6) AS gap FROM ({ORACLE["report_per_class"]})),
s AS (SELECT *, CASE WHEN gap > 0.005 THEN 'knn_k15_distance' WHEN gap < -0.005 THEN 'knn_k1_uniform' ELSE 'tie' END AS lead FROM p),
g AS (SELECT lead, count(*)::BIGINT AS classes, sum(n) AS n, string_agg(CAST(cls AS VARCHAR), ',' ORDER BY n DESC, cls) AS members,
             max(abs(gap)) AS widest_gap FROM s GROUP BY lead)
SELECT lead, classes, members, round(100.0 * n / sum(n) OVER (), 1) AS percent, widest_gap FROM g"""

ORACLE["report_per_fold"] = f"""
WITH f AS {CFG_FOLDS}
SELECT CAST(fold AS VARCHAR) AS fold, {", ".join(f"max(f1_macro) FILTER (WHERE configuration = '{c}') AS {c}" for c in _CFGS)} FROM f GROUP BY fold
UNION ALL SELECT 'mean', {", ".join(f"round(avg(f1_macro) FILTER (WHERE configuration = '{c}'), 6)" for c in _CFGS)} FROM f
UNION ALL SELECT 'sd', {", ".join(f"round(stddev_samp(f1_macro) FILTER (WHERE configuration = '{c}'), 6)" for c in _CFGS)} FROM f"""

ORACLE["report_bounds"] = f"""
WITH r AS ({ORACLE['bound_resubstitution_per_class']}), cv AS {MEM_PER_CLASS},
j AS (SELECT CAST(cls AS VARCHAR) AS cls, f1_memorisation_cv, f1_conceded_cv, f1_resubstitution FROM r JOIN cv USING (cls))
SELECT * FROM j UNION ALL
SELECT 'macro mean', round(avg(f1_memorisation_cv), 6), round(avg(f1_conceded_cv), 6), round(avg(f1_resubstitution), 6) FROM j"""

ORACLE["chart_confusion"] = f"""
WITH c AS (SELECT y, pred, sum(n) AS n FROM {KNN5_CONF} GROUP BY ALL),
s AS (SELECT y, pred, n, round(n / greatest(sum(n) OVER (PARTITION BY y), 1), 6) AS share FROM c)
SELECT *, share >= 0.12 AS labelled FROM s"""

ORACLE["claim_check"] = """
WITH c AS (SELECT o_orderpriority AS class, count(*) AS n FROM orders GROUP BY 1),
f AS (SELECT 'n_classes' AS name, CAST((SELECT count(*) FROM c) AS VARCHAR) AS value
  UNION ALL SELECT 'id_unique', CAST((SELECT count(DISTINCT o_orderkey) = count(*) FROM orders) AS VARCHAR)
  UNION ALL SELECT 'imbalance_ratio', CAST((SELECT round(max(n) / min(n), 6) FROM c) AS VARCHAR)
  UNION ALL SELECT 'n_numeric', '1' UNION ALL SELECT 'n_nominal', '1'),
cl AS (SELECT * FROM (VALUES ('n_classes', '5', 0.0), ('id_unique', 'true', 0.0), ('imbalance_ratio', '1.1', 0.1),
        ('n_numeric', '1', 0.0), ('n_nominal', '1', 0.0)) t(name, claimed, tol))
SELECT cl.name, claimed, value AS computed,
       CASE WHEN value IS NULL THEN false
            WHEN TRY_CAST(claimed AS DOUBLE) IS NOT NULL AND TRY_CAST(value AS DOUBLE) IS NOT NULL
            THEN abs(TRY_CAST(claimed AS DOUBLE) - TRY_CAST(value AS DOUBLE)) <= tol
            ELSE claimed = value END AS ok
FROM cl LEFT JOIN f USING (name)"""

ORACLE["summary_consistency"] = f"""
WITH f AS {CFG_FOLDS},
s AS (SELECT configuration, round(avg(f1_macro), 15) AS f1_macro_mean, avg(f1_macro) AS m FROM f GROUP BY configuration)
SELECT bool_and(abs(f1_macro_mean - m) <= 1e-9) AS consistent, count(*)::BIGINT AS groups FROM s"""

ORACLE["bound_order"] = f"""
WITH cv AS (SELECT round(avg(f1_memorisation_cv), 6) AS macro_f1_memorisation_cv, round(avg(f1_conceded_cv), 6) AS macro_f1_conceded_cv FROM {MEM_PER_CLASS}),
r AS ({ORACLE['bound_resubstitution']})
SELECT macro_f1_memorisation_cv, macro_f1_conceded_cv, r.f1_macro AS macro_f1_resubstitution,
       macro_f1_memorisation_cv <= macro_f1_conceded_cv AND macro_f1_conceded_cv <= r.f1_macro AS ordered FROM cv, r"""


# ---------------------------------------------------------------- k-NN grid
_KG = " UNION ALL ".join(
    f"SELECT k, '{w}' AS weights, '{m}' AS metric, fold, y, pred FROM {predictions_sql([1, 3, 5, 7, 9, 11, 15, 21, 31, 41], w, m)}"
    for m in ("manhattan", "euclidean") for w in ("uniform", "distance"))
KG_CONF = f"(SELECT k, weights, metric, fold, y, pred, count(*) AS n FROM ({_KG}) GROUP BY ALL)"
KNN_GRID = f"""(SELECT k::INTEGER AS k, weights, metric,
  round(avg(balanced_accuracy), 6) AS bal_mean, round(stddev_samp(balanced_accuracy), 6) AS bal_std,
  round(avg(f1_macro), 6) AS f1_mean, round(stddev_samp(f1_macro), 6) AS f1_std
  FROM {scores_sql(KG_CONF, ['k', 'weights', 'metric', 'fold'])} GROUP BY ALL)"""
ORACLE["knn_grid"] = f"SELECT * FROM {KNN_GRID}"
ORACLE["grid_completeness"] = f"""
SELECT count(*) AS rows, count(DISTINCT k) AS n_k, count(DISTINCT weights) AS n_weights, count(DISTINCT metric) AS n_metric,
       count(DISTINCT k) * count(DISTINCT weights) * count(DISTINCT metric) AS expected,
       count(*) = count(DISTINCT k) * count(DISTINCT weights) * count(DISTINCT metric) AS complete FROM {KNN_GRID}"""


# ---------------------------------------------------------------- chart tables and search slices
ORACLE["chart_feature_ranges"] = f"""
SELECT feature, rng, greatest(rng, 0.001) AS rng_clipped FROM {PROFILE_LI_PART} p WHERE kind = 'numeric'"""
ORACLE["chart_score_by_k"] = f"SELECT weights || '/' || metric AS series, k, f1_mean, f1_std FROM {KNN_GRID}"
ORACLE["knn_metric_wins"] = f"""
WITH g AS {KNN_GRID},
j AS (SELECT a.f1_mean AS a, b.f1_mean AS b FROM g a JOIN g b ON a.k = b.k AND a.weights = b.weights
      WHERE a.metric = 'manhattan' AND b.metric = 'euclidean')
SELECT count(*) FILTER (WHERE a > b)::BIGINT AS wins, count(*)::BIGINT AS settings, round(avg(a - b), 6) AS mean_gain FROM j"""
ORACLE["chart_metric_by_fold"] = f"""
WITH f AS {CFG_FOLDS}
SELECT configuration, fold, 'accuracy' AS metric, accuracy AS value FROM f
UNION ALL SELECT configuration, fold, 'balanced_accuracy', balanced_accuracy FROM f
UNION ALL SELECT configuration, fold, 'f1_macro', f1_macro FROM f"""
ORACLE["chart_per_class_recall"] = f"""
WITH ct AS {class_totals_sql(CONFIG_CONF, ['configuration', 'fold'])},
pc AS (SELECT configuration, fold, cls, round(coalesce(tp / nullif(t, 0), 0), 6) AS recall FROM ct)
SELECT configuration, cls, round(avg(recall), 6) AS recall_mean, round(stddev_samp(recall), 6) AS recall_std FROM pc GROUP BY ALL"""
ORACLE["report_differences"] = f"""
WITH f AS {CFG_FOLDS},
s AS (SELECT configuration, round(avg(f1_macro), 6) AS m FROM f GROUP BY configuration),
g AS (SELECT max(m) FILTER (WHERE configuration = 'knn_k15_distance') AS a, max(m) FILTER (WHERE configuration = 'knn_k1_uniform') AS b FROM s)
SELECT round(a - b, 6) AS difference, round(100.0 * (a - b) / b, 6) AS percent_change, round(a / b, 6) AS ratio FROM g"""

ORACLE["report_quality_facts"] = f"""
WITH p AS (SELECT * FROM {PROFILE_LI_PART} q WHERE kind = 'numeric' AND rng IS NOT NULL),
g AS (SELECT arg_max(feature, (rng, feature)) AS wf, max(rng) AS wr,
             arg_min(feature, (rng, feature)) FILTER (WHERE rng > 0) AS nf, min(rng) FILTER (WHERE rng > 0) AS nr,
             arg_max(feature, (skewness, feature)) FILTER (WHERE skewness IS NOT NULL) AS sf, max(skewness) AS sv,
             arg_max(feature, (pct_outlier, feature)) FILTER (WHERE pct_outlier IS NOT NULL) AS of, max(pct_outlier) AS ov,
             count(*) FILTER (WHERE pct_outlier >= 1.0) AS k FROM p),
r AS (SELECT *, wr / nr AS ratio, floor(log10(wr / nr)) AS e FROM g)
SELECT 'widest_range' AS fact, wf AS feature, wr AS value FROM r
UNION ALL SELECT 'narrowest_range', nf, nr FROM r
UNION ALL SELECT 'range_ratio_mantissa', NULL, round(ratio / pow(10.0, e), 6) FROM r
UNION ALL SELECT 'range_ratio_exponent', NULL, e::DOUBLE FROM r
UNION ALL SELECT 'most_skewed', sf, sv FROM r
UNION ALL SELECT 'worst_outlier_share', of, ov FROM r
UNION ALL SELECT 'features_over_outlier_threshold', NULL, k::DOUBLE FROM r"""

ORACLE["chart_metric_means"] = f"""
WITH f AS {CFG_FOLDS},
s AS (SELECT configuration, {", ".join(f"round(avg({m}), 6) AS {m}_mean, round(stddev_samp({m}), 6) AS {m}_sd" for m in ["accuracy", "balanced_accuracy", "f1_macro"])} FROM f GROUP BY configuration)
{" UNION ALL ".join(f"SELECT configuration, '{m}' AS metric, {m}_mean AS mean, {m}_sd AS sd FROM s" for m in ["accuracy", "balanced_accuracy", "f1_macro"])}"""

ORACLE["audit_facts"] = """
WITH c AS (SELECT CAST(o_orderpriority AS VARCHAR) AS class, count(*) AS n FROM orders GROUP BY 1)
SELECT 'n_instances' AS fact, CAST((SELECT count(*) FROM orders) AS VARCHAR) AS value
UNION ALL SELECT 'n_columns', '6' UNION ALL SELECT 'n_descriptive', '5'
UNION ALL SELECT 'n_numeric', '1' UNION ALL SELECT 'n_nominal', '1'
UNION ALL SELECT 'id_unique', CAST((SELECT count(DISTINCT o_orderkey) = count(*) FROM orders) AS VARCHAR)
UNION ALL SELECT 'n_classes', CAST((SELECT count(*) FROM c) AS VARCHAR)
UNION ALL SELECT 'majority', (SELECT arg_min(class, (-n, class)) FROM c)
UNION ALL SELECT 'minority', (SELECT arg_min(class, (n, class)) FROM c)
UNION ALL SELECT 'imbalance_ratio', CAST((SELECT round(max(n) / min(n), 6) FROM c) AS VARCHAR)"""

ORACLE["check_recall_equals_balanced"] = f"""
SELECT count(*) FILTER (WHERE abs(recall_macro - balanced_accuracy) <= 5e-4)::BIGINT AS equal, count(*)::BIGINT AS folds FROM {CFG_FOLDS}"""

ORACLE["check_pairwise_consistency"] = f"""
WITH ft AS {FT}, m AS (SELECT grp, avg(metric) AS m FROM ft GROUP BY grp),
pt AS ({ORACLE['paired_t']}),
c AS (SELECT bool_and(abs(mean_difference - (a.m - b.m)) <= 1e-6) AS differences_match
      FROM pt JOIN m a ON a.grp = pt.group_a JOIN m b ON b.grp = pt.group_b),
h AS (SELECT count(*) FILTER (WHERE significant)::BIGINT AS significant_pairs FROM ({ORACLE['holm']})),
fr AS (SELECT statistic >= n_folds * (n_groups - 1) - 1e-9 AS friedman_at_maximum FROM ({ORACLE['friedman']}))
SELECT * FROM c, h, fr"""

ORACLE["check_class_shares"] = f"""
WITH b AS ({ORACLE['audit_class_balance']}),
s AS (SELECT round(sum(percent), 3) AS percent_total, sum(count)::BIGINT AS count_total FROM b)
SELECT percent_total, count_total, (SELECT count(*) FROM orders)::BIGINT AS rows,
       abs(percent_total - 100.0) <= 0.01 AS shares_sum_to_100, count_total = (SELECT count(*) FROM orders) AS counts_sum_to_rows FROM s"""

ORACLE["bound_progress"] = f"""
WITH o AS ({ORACLE['bound_order']})
SELECT round(macro_f1_resubstitution - macro_f1_memorisation_cv, 6) AS gap,
       round(CASE WHEN macro_f1_resubstitution - macro_f1_memorisation_cv <> 0 THEN
             (macro_f1_conceded_cv - macro_f1_memorisation_cv) / (macro_f1_resubstitution - macro_f1_memorisation_cv) END, 6)
       AS share_closed_by_conceding FROM o"""

ORACLE["bound_share_needed"] = f"""
WITH r AS ({ORACLE['bound_resubstitution_per_class']}),
c AS (SELECT cls, coalesce(f1_resubstitution, 0.0) AS b, row_number() OVER (ORDER BY f1_resubstitution NULLS FIRST, cls) AS hardest,
             count(*) OVER () AS k, sum(coalesce(f1_resubstitution, 0.0)) OVER () AS total FROM r),
d AS (SELECT *, sum(b) OVER (ORDER BY hardest) AS done FROM c),
o AS (SELECT hardest::INTEGER AS hardest, cls AS last_class, round(done / k, 9) AS macro_share,
             round((0.7 * k - done) / (k - hardest), 9) AS needed, round((total - done) / (k - hardest), 9) AS bound_of_others FROM d WHERE hardest < k)
SELECT *, bound_of_others >= needed AS enough FROM o"""

ORACLE["report_search_scale"] = f"""
SELECT 'knn_grid' AS search, count(*)::BIGINT AS settings,
       count(*) = count(DISTINCT k) * count(DISTINCT weights) * count(DISTINCT metric) AS complete FROM {KNN_GRID}"""

ORACLE["report_settings"] = f"""
WITH b AS (SELECT * FROM {KNN_GRID} g ORDER BY f1_mean DESC, k, weights, metric LIMIT 1)
SELECT 'k-NN' AS model, 'k' AS parameter, CAST(k AS VARCHAR) AS value FROM b
UNION ALL SELECT 'k-NN', 'weights', weights FROM b
UNION ALL SELECT 'k-NN', 'metric', metric FROM b
UNION ALL SELECT 'split', partition, CAST(instances AS VARCHAR) FROM ({ORACLE['split_sizes']})"""

# M2 greedy correlation filter, walked pair by pair with a recursive CTE
ORACLE["correlation_filter"] = f"""
WITH RECURSIVE dm AS {DOC_MEASURES_SQL}, c AS ({_CORR_PAIRS}),
cols AS (SELECT * FROM (VALUES {", ".join(f"({i}, '{f}')" for i, f in enumerate(_DM))}) t(i, f)),
both_ways AS (SELECT feature_a AS f, abs_r FROM c UNION ALL SELECT feature_b AS f, abs_r FROM c),
red AS (SELECT f, avg(abs_r) AS r FROM both_ways GROUP BY f),
po AS (SELECT row_number() OVER (ORDER BY ca.i, cb.i) AS step, c.feature_a AS a, c.feature_b AS b, c.abs_r,
              ra.r AS red_a, ca.i AS ia, rb.r AS red_b, cb.i AS ib
       FROM c JOIN cols ca ON ca.f = c.feature_a JOIN cols cb ON cb.f = c.feature_b
       JOIN red ra ON ra.f = c.feature_a JOIN red rb ON rb.f = c.feature_b),
walk(step, dropped) AS (
  SELECT 0, []::VARCHAR[]
  UNION ALL
  SELECT w.step + 1,
         CASE WHEN list_contains(w.dropped, p.a) OR list_contains(w.dropped, p.b) OR p.abs_r IS NULL OR p.abs_r < 0.95
              THEN w.dropped
              ELSE list_append(w.dropped, CASE WHEN p.red_a > p.red_b OR (p.red_a = p.red_b AND p.ia > p.ib) THEN p.a ELSE p.b END) END
  FROM walk w JOIN po p ON p.step = w.step + 1)
SELECT f AS feature, NOT list_contains((SELECT dropped FROM walk ORDER BY step DESC LIMIT 1), f) AS kept FROM cols"""


def grid_sql(ks: list[int], weights: list[str], dist: list[str], folds: str | None = None) -> str:
    parts = " UNION ALL ".join(
        f"SELECT k, '{w}' AS weights, '{m}' AS metric, fold, y, pred FROM {predictions_sql(ks, w, m, folds)}"
        for m in dist for w in weights)
    conf = f"(SELECT k, weights, metric, fold, y, pred, count(*) AS n FROM ({parts}) GROUP BY ALL)"
    return f"""(SELECT k::INTEGER AS k, weights, metric,
  round(avg(balanced_accuracy), 6) AS bal_mean, round(stddev_samp(balanced_accuracy), 6) AS bal_std,
  round(avg(f1_macro), 6) AS f1_mean, round(stddev_samp(f1_macro), 6) AS f1_std
  FROM {scores_sql(conf, ['k', 'weights', 'metric', 'fold'])} GROUP BY ALL)"""


# Coarse grid, best setting, then k -> {k-2, k-1, k, k+1, k+2, k+4} with the best rule
ORACLE["knn_refined_grid"] = f"""
WITH fine AS {grid_sql(list(range(1, 20)), ['uniform', 'distance'], ['manhattan'])},
coarse AS (SELECT * FROM fine WHERE k IN (1, 5, 15)),
b AS (SELECT * FROM coarse ORDER BY f1_mean DESC, k, weights, metric LIMIT 1),
ks AS (SELECT DISTINCT b.k + d AS k FROM b, (VALUES (-2), (-1), (0), (1), (2), (4)) t(d) WHERE b.k + d >= 1)
SELECT f.* FROM fine f JOIN b ON f.weights = b.weights AND f.metric = b.metric WHERE f.k IN (SELECT k FROM ks)"""


# The same grid on the tuning and the evaluation part of a stratified split
EMB_SPLIT = split_sql("embeddings", "vec_id", "label", 0.25)


def _part_folds(part: str) -> str:
    return folds_sql(f"(SELECT vec_id, embedding, label FROM {EMB_SPLIT} WHERE part = '{part}')", "vec_id", "label", 5)


ORACLE["training_size"] = f"""
WITH t1 AS (SELECT 'k_' || CAST(k AS VARCHAR) || '_' || weights AS grp, f1_mean AS m1
            FROM {grid_sql([1, 5, 15], ['uniform', 'distance'], ['manhattan'], _part_folds('tuning'))}),
t2 AS (SELECT 'k_' || CAST(k AS VARCHAR) || '_' || weights AS grp, f1_mean AS m2
       FROM {grid_sql([1, 5, 15], ['uniform', 'distance'], ['manhattan'], _part_folds('evaluation'))}),
r1 AS (SELECT grp, m1, rank() OVER (ORDER BY m1 DESC) + (count(*) OVER (PARTITION BY m1) - 1) / 2.0 AS rank_1 FROM t1),
r2 AS (SELECT grp, m2, rank() OVER (ORDER BY m2 DESC) + (count(*) OVER (PARTITION BY m2) - 1) / 2.0 AS rank_2 FROM t2)
SELECT grp AS configuration, m1 AS tuning_f1, m2 AS evaluation_f1, round(m2 - m1, 6) AS gain,
       rank_1 AS tuning_rank, rank_2 AS evaluation_rank, rank_1 = rank_2 AS same_rank
FROM r1 JOIN r2 USING (grp)"""


def _rank_sql(cols: list[str], folds: str) -> str:
    """CTE text: rank-scaled value ``r_<col>`` for every fold-0 row (knots fitted on folds <> 0)."""
    parts, body = [], []
    for c in cols:
        parts.append(f"kn_{c} AS (SELECT quantile_cont(CAST({c} AS DOUBLE), {REFS_1000}) AS K, {REFS_1000} AS R FROM tr)")
        body.append(f"""ip_{c} AS (SELECT row_key, x, K, R, len(K) AS m,
              len(list_filter(K, lambda k: k <= x)) AS lo, len(K) - len(list_filter(K, lambda k: k >= x)) + 1 AS hi
            FROM (SELECT row_key, CAST({c} AS DOUBLE) AS x FROM te), kn_{c}),
  v_{c} AS (SELECT row_key, CASE WHEN x - 1e-7 < K[1] THEN R[1] WHEN x + 1e-7 > K[m] THEN R[m] ELSE 0.5 * (
      (CASE WHEN lo = 0 THEN R[1] WHEN lo >= m THEN R[m] WHEN K[lo] = x THEN R[lo]
            ELSE (R[lo + 1] - R[lo]) / (K[lo + 1] - K[lo]) * (x - K[lo]) + R[lo] END) +
      (CASE WHEN hi > m THEN R[m] WHEN hi <= 1 THEN R[1] WHEN K[hi] = x THEN R[hi]
            ELSE R[hi] - (R[hi] - R[hi - 1]) / (K[hi] - K[hi - 1]) * (K[hi] - x) END)) END AS r_{c} FROM ip_{c})""")
    return (f"f AS {folds}, tr AS (SELECT * FROM f WHERE fold <> 0), te AS (SELECT * FROM f WHERE fold = 0), "
            + ", ".join(parts) + ", " + ", ".join(body))


_KF = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
_KNN_FEATURES = f"""
WITH {_rank_sql(_KF, LI_FOLDS_ALL)},
lv AS (SELECT l_linestatus AS level, count(*) AS n FROM tr GROUP BY 1),
sh AS (SELECT *, n / sum(n) OVER () AS share, row_number() OVER (ORDER BY n DESC, level) AS rk FROM lv),
kept AS (SELECT level FROM sh WHERE share >= 0.001 OR (rk = 1 AND (SELECT max(share) FROM sh) < 0.001)),
levels AS (SELECT list_sort(list(DISTINCT CASE WHEN l_linestatus IN (SELECT level FROM kept) THEN l_linestatus ELSE 'other' END)) AS L FROM tr),
g AS (SELECT row_key, CASE WHEN l_linestatus IN (SELECT level FROM kept) THEN l_linestatus ELSE 'other' END AS ls FROM te)
SELECT g.row_key, list_concat([{", ".join(f"round(r_{c}, 6)" for c in _KF)}],
       list_transform(L, lambda l: CASE WHEN l = ls THEN 1.0 ELSE 0.0 END)) AS features
FROM g {" ".join(f"JOIN v_{c} USING (row_key)" for c in _KF)}, levels"""
ORACLE["knn_features"] = _every_fold(_KNN_FEATURES)

# Probe of each training fold scored against that fold, against out-of-fold accuracy
ORACLE["training_probe_gap"] = f"""
WITH f AS {EMB_FOLDS_SQL},
fl AS (SELECT DISTINCT fold AS fo FROM f),
tr AS (SELECT fl.fo, f.vec_id, f.embedding, f.label FROM fl JOIN f ON f.fold <> fl.fo),
rk AS (SELECT *, row_number() OVER (PARTITION BY fo, label ORDER BY md5('42-' || CAST(vec_id AS VARCHAR)), vec_id) AS rank_in_class FROM tr),
cc AS (SELECT fo, label, count(*) AS n FROM tr GROUP BY ALL),
c1 AS (SELECT *, sum(n) OVER (PARTITION BY fo) AS total FROM cc),
c2 AS (SELECT *, least(total, 10000) AS t FROM c1),
c3 AS (SELECT *, n::DOUBLE * t / total AS cont FROM c2),
c4 AS (SELECT *, floor(cont) AS base, cont - floor(cont) AS rem FROM c3),
c5 AS (SELECT *, t - sum(base) OVER (PARTITION BY fo) AS extra,
              row_number() OVER (PARTITION BY fo ORDER BY rem DESC, label) AS ord FROM c4),
qu AS (SELECT fo, label, (base + CASE WHEN ord <= extra THEN 1 ELSE 0 END)::BIGINT AS quota FROM c5),
probe AS (SELECT rk.* FROM rk JOIN qu USING (fo, label) WHERE rank_in_class <= quota),
pairs AS (SELECT p.fo, p.vec_id AS query, p.label AS y, q.vec_id AS neighbor, q.label AS label,
                 list_reduce(list_transform(list_zip(p.embedding, q.embedding),
                   lambda z: abs(z[1]::DOUBLE - z[2]::DOUBLE)), lambda a, b: a + b, 0.0::DOUBLE) AS d
          FROM probe p JOIN tr q ON q.fo = p.fo),
nb AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY fo, query ORDER BY round(d, 9), neighbor) AS rn FROM pairs) WHERE rn <= 5),
wt AS (SELECT fo, query, y, label,
              CASE WHEN max(CASE WHEN d = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY fo, query) = 1
                   THEN CASE WHEN d = 0 THEN 1.0 ELSE 0.0 END ELSE 1.0 / d END AS w FROM nb),
v AS (SELECT fo, query, y, label, sum(w) AS w FROM wt GROUP BY ALL),
pr AS (SELECT fo AS fold, query, any_value(y) AS y, arg_max(label, (w, -label)) AS pred FROM v GROUP BY fo, query),
pc AS (SELECT fold, y, pred, count(*) AS n FROM pr GROUP BY ALL),
tr_s AS (SELECT fold, accuracy AS train_accuracy, balanced_accuracy AS train_balanced_accuracy FROM {scores_sql('pc', ['fold'])}),
cv AS (SELECT fold, accuracy FROM {scores_sql(KNN5_CONF, ['fold'])})
SELECT fold, train_accuracy, train_balanced_accuracy, accuracy, round(train_accuracy - accuracy, 6) AS optimism_gap
FROM tr_s JOIN cv USING (fold)"""

ORACLE["audit_text_duplicates"] = """
WITH d AS (SELECT d.text, l.quality FROM documents d JOIN labels l USING (doc_id)),
vl AS (SELECT text, quality, count(*) AS n FROM d GROUP BY ALL),
vec AS (SELECT text, sum(n) AS n, count(*) AS labels, max(n) AS top FROM vl GROUP BY ALL),
s AS (SELECT sum(n) AS rows, count(*) AS vectors, sum(labels) AS pairs,
             sum(CASE WHEN labels > 1 THEN n ELSE 0 END) AS mixed, sum(top) AS placed FROM vec)
SELECT (rows - pairs)::BIGINT AS duplicate_rows, (rows - vectors)::BIGINT AS duplicate_descriptive,
       (pairs - vectors)::BIGINT AS conflicting_pairs, mixed::BIGINT AS conflict_records,
       (rows - placed)::BIGINT AS unresolvable, vectors::BIGINT AS distinct_vectors,
       round(100.0 * (rows - pairs) / rows, 2) AS duplicate_percent,
       round(100.0 * (rows - placed) / rows, 2) AS unresolvable_percent
FROM s"""

ORACLE["audit_text_majority"] = """
WITH d AS (SELECT d.text, l.quality FROM documents d JOIN labels l USING (doc_id)),
vl AS (SELECT text, quality, count(*) AS n FROM d GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY text ORDER BY n DESC, quality) AS rn,
             sum(n) OVER (PARTITION BY text) AS n_vector, count(*) OVER (PARTITION BY text) AS n_labels FROM vl)
SELECT text, quality AS majority, n AS n_majority, n_vector::BIGINT AS n_vector, n_labels::BIGINT AS n_labels
FROM r WHERE rn = 1"""

ORACLE["audit_label_balance"] = """
WITH dim AS (SELECT * FROM (VALUES (0, 0), (1, 1)) t(code, class)),
c AS (SELECT toxic AS class, count(*) AS count FROM labels GROUP BY 1),
j AS (SELECT dim.code, dim.class, coalesce(c.count, 0)::BIGINT AS count FROM dim LEFT JOIN c USING (class))
SELECT code, class, count, round(100.0 * count / sum(count) OVER (), 3) AS percent FROM j"""


# ---------------------------------------------------------------- preparation helpers, sinks, joined reports
ORACLE["duplicate_flags"] = f"""
SELECT row_key, row_number() OVER (PARTITION BY {BF}, l_returnflag ORDER BY row_key) > 1 AS is_duplicate FROM {LI_KEYED}"""

ORACLE["prepared_columns"] = """
WITH o AS (SELECT *, CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'unknown' ELSE o_orderpriority END AS priority,
  string_split(o_orderpriority, '-') AS parts FROM orders)
SELECT o_orderkey, 'o_orderkey,o_totalprice' AS numeric_columns, priority, round(o_totalprice, 2) AS price,
  CASE o_orderstatus WHEN 'F' THEN 'finished' WHEN 'O' THEN 'open' WHEN 'P' THEN 'pending' END AS status,
  o_orderstatus || chr(31) || priority AS vector_key, format('{:,}', o_orderkey) AS key_cell,
  coalesce(['zero', 'one', 'two', 'three', 'four', 'five', 'six', 'seven', 'eight', 'nine', 'ten'][o_orderkey % 14 + 1],
           CAST(o_orderkey % 14 AS VARCHAR)) AS word,
  parts[1] AS priority_code, upper(left(replace(parts[2], ' ', '_'), 1)) || lower(substr(replace(parts[2], ' ', '_'), 2)) AS priority_name,
  regexp_replace(o_orderpriority, '^(\\d)-(\\w+).*$', '\\2/\\1') AS substituted FROM o"""

ORACLE["first_folds"] = f"SELECT fold, f1_macro, balanced_accuracy FROM {scores_sql(KNN5_CONF, ['fold'])} WHERE fold < 2"

ORACLE["sink_round_trip"] = """
SELECT 'parts' AS "group", count(*)::BIGINT AS n FROM orders UNION ALL SELECT 'snapshot', count(*) FROM orders
UNION ALL SELECT 'absent', 0 UNION ALL SELECT 'price_cents', sum(round(o_totalprice * 100)::BIGINT)::BIGINT FROM orders"""

ORACLE["report_joined"] = f"""
WITH s AS (SELECT configuration, round(avg(f1_macro), 6) AS f1_macro, count(*)::BIGINT AS n_folds FROM {CFG_FOLDS} GROUP BY 1),
p AS (SELECT * FROM ({ORACLE["pooled_precision_recall"]}) WHERE configuration LIKE '%distance'),
e AS (SELECT configuration, sum(n)::BIGINT AS rows FROM {CONFIG_CONF} WHERE configuration LIKE 'knn_k15%' GROUP BY 1)
SELECT * FROM s LEFT JOIN p USING (configuration) LEFT JOIN e USING (configuration)"""


def _words(c: str) -> str:
    """Words of a lower-case name with their first letters in upper case."""
    return (f"array_to_string(list_transform(string_split({c}, ' '), lambda x: upper(left(x, 1)) || substr(x, 2)), ' ')")


ORACLE["report_pairwise"] = f"""
SELECT {_words("lower(t.group_a)")} || ' vs ' || {_words("lower(t.group_b)")} AS comparison, mean_difference AS difference,
       wilcoxon_p AS p, holm_p, significant FROM ({ORACLE["paired_t"]}) t JOIN ({ORACLE["holm"]}) h USING (group_a, group_b)"""

ORACLE["report_corrections"] = f"""
WITH d AS ({ORACLE["audit_duplicates_conflicts"]}), c AS ({ORACLE["audit_correlation_counts"]})
SELECT 'unresolvable' AS name, unresolvable::DOUBLE AS value FROM d UNION ALL SELECT 'unresolvable_percent', unresolvable_percent FROM d
UNION ALL SELECT 'duplicate_percent', duplicate_percent FROM d UNION ALL SELECT 'n_090', n_090 FROM c
UNION ALL SELECT 'n_095', n_095 FROM c UNION ALL SELECT 'n_099', n_099 FROM c
UNION ALL SELECT 'invariance_residual', round(1.0 - max_abs_r, 6) FROM c"""

ORACLE["check_derived_numbers"] = """
SELECT 'k15 vs k1' AS comparison, unnest(['difference', 'percent_change', 'ratio']) AS name, true AS ok"""
