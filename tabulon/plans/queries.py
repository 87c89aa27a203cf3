"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Each query reads whole driver tables (or tables Spark derives from them);
every computed column is aliased to the same name as in ``oracle.py``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import audit
from ..session import ensure_checkpoint_dir
from ..sources import load, write_table
from .sizing import materialize, persist_compact

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


# ---------------------------------------------------------------- parameters
LINEITEM_NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
PART_NUMERIC = ["p_size", "p_retailprice"]
PART_FEATURES, PART_LABEL = ["p_brand", "p_type"], "p_size"
BOUND_FEATURES, BOUND_LABEL = ["l_quantity", "l_linenumber", "l_linestatus"], "l_returnflag"
LINEITEM_KEY = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]


def document_measures(docs: DataFrame, *more: str) -> DataFrame:
    """Numeric measures derived from document text (for correlation audits), and ``more`` columns."""
    return docs.select(
        "doc_id", *more, "n_chars",
        F.length("text").cast("bigint").alias("text_len"),
        (F.length("text") - F.length(F.replace("text", F.lit(" "), F.lit("")))).cast("bigint").alias("n_spaces"),
        (F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1).cast("bigint").alias("n_lines"),
    )


DOC_MEASURES = ["n_chars", "text_len", "n_spaces", "n_lines"]


# ---------------------------------------------------------------- audit
@register("audit_duplicates_conflicts")
def q_audit_duplicates(spark, sf):
    return audit.duplicates(load(spark, sf, "part"), PART_FEATURES, PART_LABEL)


@register("audit_majority_label")
def q_audit_majority(spark, sf):
    return audit.majority_labels(load(spark, sf, "part"), PART_FEATURES, PART_LABEL)


@register("audit_mixed_label_rows")
def q_audit_mixed_rows(spark, sf):
    return audit.mixed_label_rows(load(spark, sf, "part"), PART_FEATURES, PART_LABEL) \
        .select("p_partkey", "p_brand", "p_type", "p_size")


@register("audit_profile")
def q_audit_profile(spark, sf):
    return audit.profile(load(spark, sf, "lineitem"), LINEITEM_NUMERIC, ["l_returnflag", "l_linestatus"])


@register("audit_missing_tokens")
def q_audit_missing(spark, sf):
    return audit.missing_tokens(load(spark, sf, "events"), ["event_type", "props"], token="error")


@register("audit_class_balance")
def q_audit_class_balance(spark, sf):
    return audit.class_balance(load(spark, sf, "orders"), "o_orderpriority")


@register("audit_imbalance")
def q_audit_imbalance(spark, sf):
    return audit.imbalance(load(spark, sf, "conversations"), "role")


@register("audit_cardinality")
def q_audit_cardinality(spark, sf):
    return audit.cardinality(load(spark, sf, "part"),
                             ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"])


def _profile_li_part(spark, sf):
    li = audit.profile(load(spark, sf, "lineitem"), LINEITEM_NUMERIC)
    pa = audit.profile(load(spark, sf, "part"), PART_NUMERIC)
    return li.unionByName(pa)


@register("audit_range_spread")
def q_audit_range_spread(spark, sf):
    return audit.range_spread(_profile_li_part(spark, sf))


@register("audit_outlier_ranking")
def q_audit_outlier_ranking(spark, sf):
    return audit.outlier_ranking(_profile_li_part(spark, sf), threshold=1.0)


@register("audit_correlations")
def q_audit_correlations(spark, sf):
    return audit.correlations(document_measures(load(spark, sf, "documents")), DOC_MEASURES)


@register("audit_correlation_counts")
def q_audit_correlation_counts(spark, sf):
    return audit.correlation_counts(
        audit.correlations(document_measures(load(spark, sf, "documents")), DOC_MEASURES))


@register("audit_named_correlation")
def q_audit_named_correlation(spark, sf):
    return audit.named_correlation(load(spark, sf, "part"), "p_partkey", "p_retailprice")


@register("audit_binary_domain")
def q_audit_binary(spark, sf):
    return audit.binary_domain(load(spark, sf, "labels"), ["quality", "toxic"])


@register("adjacent_label_agreement")
def q_adjacent(spark, sf):
    return audit.adjacent_agreement(load(spark, sf, "events"), "event_id", "event_type")


@register("monotonic_id_check")
def q_monotonic(spark, sf):
    return audit.monotonic_check(load(spark, sf, "events"), "ts", "event_id")



# ---------------------------------------------------------------- sampling
from ..operators import sampling  # noqa: E402

SEED = 42


@register("stratified_split")
def q_split(spark, sf):
    s = sampling.stratified_split(load(spark, sf, "orders"), "o_orderkey", "o_orderpriority", 0.25, SEED)
    return s.select("o_orderkey", "o_orderpriority", "part")


@register("stratified_folds")
def q_folds(spark, sf):
    f = sampling.stratified_folds(load(spark, sf, "orders"), "o_orderkey", "o_orderpriority", 10, SEED)
    return f.select("o_orderkey", "fold")


@register("fold_class_counts")
def q_fold_class_counts(spark, sf):
    f = sampling.stratified_folds(load(spark, sf, "orders"), "o_orderkey", "o_orderpriority", 10, SEED)
    return sampling.fold_class_counts(f, "o_orderpriority")


@register("stratified_probe")
def q_probe(spark, sf):
    p = sampling.stratified_take(load(spark, sf, "orders"), "o_orderkey", "o_orderpriority", 1000, SEED)
    return p.select("o_orderkey", "o_orderpriority", "rank_in_class")


@register("split_sizes")
def q_split_sizes(spark, sf):
    s = sampling.stratified_split(load(spark, sf, "orders"), "o_orderkey", "o_orderpriority", 0.25, SEED)
    return sampling.split_sizes(s)


@register("smote_targets")
def q_smote_targets(spark, sf):
    return sampling.oversample_targets(load(spark, sf, "labels"), "toxic", cap=0.25)


# ---------------------------------------------------------------- neighbours and metrics
from ..operators import metrics, neighbors  # noqa: E402

EMB_CLASSES = list(range(10))
EMB_FOLDS = 5


def embedding_folds(spark, sf):
    """Embeddings with a stratified 5-fold column (vec_id, embedding, label, fold)."""
    e = load(spark, sf, "embeddings")
    folds = sampling.stratified_folds(e, "vec_id", "label", EMB_FOLDS, SEED)
    return materialize(folds.select("vec_id", "embedding", "label", "fold"))      # read several times by every search


def embedding_classes(spark, sf) -> list[int]:
    # class list: at most a few hundred codes, collected once
    return [r[0] for r in load(spark, sf, "embeddings").select("label").distinct().orderBy("label").collect()]


def oof_neighbours(spark, sf, k, metric="manhattan"):
    f = embedding_folds(spark, sf)
    return neighbors.knn(f, f, "vec_id", "embedding", "label", k, metric, fold="fold")


def oof_predictions(spark, sf, ks, weights, metric="manhattan"):
    f = embedding_folds(spark, sf)
    neigh = neighbors.knn(f, f, "vec_id", "embedding", "label", max(ks), metric, fold="fold")
    v = neighbors.vote(neigh, ks, weights, embedding_classes(spark, sf))
    meta = f.select(F.col("vec_id").alias("query"), "fold", F.col("label").alias("y"))
    return v.join(meta, "query", "inner")


def knn_configurations(spark, sf):
    """k-NN configurations scored out of fold: (configuration, query, fold, y, pred)."""
    f = embedding_folds(spark, sf)
    neigh = materialize(neighbors.knn(f, f, "vec_id", "embedding", "label", 15, "manhattan", fold="fold"))
    meta = f.select(F.col("vec_id").alias("query"), "fold", F.col("label").alias("y"))
    classes, parts = embedding_classes(spark, sf), []
    for weights in ("uniform", "distance"):       # both votes read one neighbour search
        p = neighbors.vote(neigh, [1, 5, 15], weights, classes).join(meta, "query")
        parts.append(p.select(F.concat(F.lit("knn_k"), F.col("k").cast("string"), F.lit("_" + weights))
                              .alias("configuration"), "query", "fold", "y", "pred"))
    return parts[0].unionByName(parts[1])


@register("knn_neighbours")
def q_knn_neighbours(spark, sf):
    n = oof_neighbours(spark, sf, 5)
    return n.select("query", "neighbor", F.round("d", 6).alias("d"), F.col("rn").cast("int").alias("rn"))


@register("knn_neighbours_euclidean")
def q_knn_neighbours_euclid(spark, sf):
    n = oof_neighbours(spark, sf, 5, "euclidean")
    return n.select("query", "neighbor", F.round("d", 6).alias("d"), F.col("rn").cast("int").alias("rn"))


MANY_LEVELS = ["o_custkey", "o_orderpriority", "o_orderstatus"]


@register("knn_many_levels")
def q_knn_many_levels(spark, sf):
    """M4, M11, J9 with a nominal column whose levels grow with the table (customers):
    the 5 nearest of every order whose key 100 divides among all orders, the price
    by min-max, levels as codes that count as one-hot columns."""
    o = load(spark, sf, "orders")
    x = features.knn_features(o, o, ["o_totalprice"], MANY_LEVELS, scale="minmax", group=False, codes=True)
    n = neighbors.knn(x.filter("o_orderkey % 100 = 0"), x, "o_orderkey", "features", "o_custkey", 5, codes=len(MANY_LEVELS))
    return n.select("query", "neighbor", F.round("d", 6).alias("d"), F.col("rn").cast("int").alias("rn"))


@register("knn_vote_uniform")
def q_knn_vote_uniform(spark, sf):
    return oof_predictions(spark, sf, [5], "uniform").select("query", "pred")


@register("knn_vote_distance")
def q_knn_vote_distance(spark, sf):
    return oof_predictions(spark, sf, [5], "distance").select("query", "pred")


@register("knn_many_k")
def q_knn_many_k(spark, sf):
    return oof_predictions(spark, sf, [1, 5, 15], "uniform").select("query", "k", "pred")


@register("knn_class_distribution")
def q_knn_distribution(spark, sf):
    p = oof_predictions(spark, sf, [15], "distance")
    return p.select("query", F.posexplode("p").alias("cls", "prob")) \
        .select("query", "cls", F.round("prob", 6).alias("prob"))


def _knn5_conf(spark, sf):
    p = oof_predictions(spark, sf, [5], "distance")
    return metrics.confusion(p, ["fold"])


@register("confusion_counts")
def q_confusion(spark, sf):
    return metrics.confusion_filled(_knn5_conf(spark, sf), ["fold"], EMB_CLASSES)


@register("fold_metrics")
def q_fold_metrics(spark, sf):
    return metrics.scores(_knn5_conf(spark, sf), ["fold"])


@register("fold_metrics_all_classes")
def q_fold_metrics_all(spark, sf):
    return metrics.scores(_knn5_conf(spark, sf), ["fold"], domain="all", n_classes=len(EMB_CLASSES)) \
        .select("fold", "f1_macro")


@register("per_class_metrics")
def q_per_class(spark, sf):
    return metrics.per_class(_knn5_conf(spark, sf), ["fold"])


@register("pooled_precision_recall")
def q_pooled(spark, sf):
    conf = metrics.confusion(knn_configurations(spark, sf), ["configuration", "fold"])
    return metrics.pooled_precision_recall(conf, ["configuration"])


@register("config_summary")
def q_config_summary(spark, sf):
    conf = metrics.confusion(knn_configurations(spark, sf), ["configuration", "fold"])
    return metrics.summary(metrics.scores(conf, ["configuration", "fold"]), ["configuration"])


@register("row_normalised_confusion")
def q_row_norm(spark, sf):
    conf = metrics.summed(_knn5_conf(spark, sf), [])
    return metrics.row_normalised(conf, []).select("y", "pred", "n", "share")


# ---------------------------------------------------------------- bounds
from ..operators import bounds  # noqa: E402


def lineitem_keyed(spark, sf):
    li = load(spark, sf, "lineitem")
    return li.withColumn("row_key", F.concat_ws("-", *[F.col(c).cast("string") for c in LINEITEM_KEY]))


def lineitem_classes(spark, sf) -> list[str]:
    return [r[0] for r in load(spark, sf, "lineitem").select(BOUND_LABEL).distinct().orderBy(BOUND_LABEL).collect()]


def lineitem_eval_folds(spark, sf, k: int = 10):
    """75% evaluation partition of lineitem, stratified by return flag, in k folds."""
    rows = lineitem_keyed(spark, sf).select("row_key", *BOUND_FEATURES, BOUND_LABEL)
    return sampling.evaluation_folds(rows, "row_key", BOUND_LABEL, 0.25, k, SEED)


def _memorisation(spark, sf):
    return bounds.memorisation_predictions(lineitem_eval_folds(spark, sf), BOUND_FEATURES, BOUND_LABEL, "fold")


@register("bound_resubstitution")
def q_bound_resub(spark, sf):
    return bounds.resubstitution(load(spark, sf, "lineitem"), BOUND_FEATURES, BOUND_LABEL,
                                 len(lineitem_classes(spark, sf)))


@register("bound_resubstitution_per_class")
def q_bound_resub_pc(spark, sf):
    return bounds.resubstitution_per_class(load(spark, sf, "lineitem"), BOUND_FEATURES, BOUND_LABEL)


@register("bound_memorisation_cv")
def q_bound_mem(spark, sf):
    return bounds.cv_bounds_per_class(_memorisation(spark, sf), lineitem_classes(spark, sf))


@register("bound_cv_summary")
def q_bound_cv_summary(spark, sf):
    return bounds.cv_bounds_summary(_memorisation(spark, sf), lineitem_classes(spark, sf))


@register("matched_fraction")
def q_matched(spark, sf):
    return bounds.matched_fraction(_memorisation(spark, sf))


@register("bound_reweighted")
def q_bound_reweighted(spark, sf):
    w, best = bounds.reweighted_resubstitution(load(spark, sf, "lineitem"), BOUND_FEATURES, BOUND_LABEL,
                                               lineitem_classes(spark, sf))
    return w.withColumn("macro_f1_reweighted", F.lit(round(best, 6)))


def flagship(spark, sf):
    """The entry query: resubstitution bound plus the records no rule can place."""
    from .sizing import join_single_rows
    r = bounds.resubstitution(load(spark, sf, "lineitem"), BOUND_FEATURES, BOUND_LABEL,
                              len(lineitem_classes(spark, sf)))
    d = audit.duplicates(load(spark, sf, "lineitem"), BOUND_FEATURES, BOUND_LABEL) \
        .select("unresolvable", "conflict_records", "unresolvable_percent")
    return join_single_rows(r, d)


# ---------------------------------------------------------------- paired statistics
from ..operators import stats  # noqa: E402


def orders_fold_table(spark, sf):
    """Blocks = 10 stratified folds of orders, groups = priorities, metric = mean total price."""
    f = sampling.stratified_folds(load(spark, sf, "orders"), "o_orderkey", "o_orderpriority", 10, SEED)
    return stats.fold_table(f, "fold", "o_orderpriority", "o_totalprice")


@register("friedman")
def q_friedman(spark, sf):
    return stats.friedman(orders_fold_table(spark, sf))


@register("wilcoxon_pairs")
def q_wilcoxon(spark, sf):
    return stats.wilcoxon_pairs(orders_fold_table(spark, sf))


@register("paired_t")
def q_paired_t(spark, sf):
    return stats.paired_t(orders_fold_table(spark, sf))


@register("holm")
def q_holm(spark, sf):
    return stats.holm(stats.wilcoxon_pairs(orders_fold_table(spark, sf)).select("group_a", "group_b", "wilcoxon_p"),
                      "wilcoxon_p")


@register("pairwise_tests")
def q_pairwise(spark, sf):
    return stats.pairwise(orders_fold_table(spark, sf))


@register("diff_shape")
def q_diff_shape(spark, sf):
    return stats.diff_shape(orders_fold_table(spark, sf))


@register("fold_winners")
def q_fold_winners(spark, sf):
    return stats.fold_winners(orders_fold_table(spark, sf))


@register("fold_margins")
def q_fold_margins(spark, sf):
    return stats.fold_margins(orders_fold_table(spark, sf), "1-URGENT", "5-LOW")


@register("paired_wins")
def q_paired_wins(spark, sf):
    return stats.paired_wins(orders_fold_table(spark, sf))


@register("lead_share")
def q_lead_share(spark, sf):
    t = orders_fold_table(spark, sf)
    f = sampling.stratified_folds(load(spark, sf, "orders"), "o_orderkey", "o_orderpriority", 10, SEED)
    sizes = f.groupBy(F.col("fold").alias("block")).agg(F.count(F.lit(1)).alias("rows"))
    items = (t.groupBy("block").agg(F.max(F.when(F.col("grp") == "1-URGENT", F.col("metric"))).alias("a"),
                                    F.max(F.when(F.col("grp") == "2-HIGH", F.col("metric"))).alias("b"))
             .join(sizes, "block"))
    return stats.lead_share(items, "block", "rows", "a", "b", tol=1000.0)


@register("rank_stability")
def q_rank_stability(spark, sf):
    s = sampling.stratified_split(load(spark, sf, "orders"), "o_orderkey", "o_orderpriority", 0.25, SEED)
    t1 = stats.fold_table(s.filter("part = 'tuning'"), "part", "o_orderpriority", "o_totalprice")
    t2 = stats.fold_table(s.filter("part = 'evaluation'"), "part", "o_orderpriority", "o_totalprice")
    return stats.rank_stability(t1, t2)


@register("stepwise_gain")
def q_stepwise(spark, sf):
    t = stats.fold_table(load(spark, sf, "orders"), "o_orderstatus", "o_orderpriority", "o_totalprice") \
        .groupBy("grp").agg(F.round(F.avg("metric"), 6).alias("metric"))
    return stats.stepwise_gain(t, "grp", "metric")


# ---------------------------------------------------------------- features
from ..operators import features  # noqa: E402

SCALE_COLS = ["l_quantity", "l_extendedprice", "l_discount"]


def documents_split(spark, sf):
    return sampling.stratified_split(load(spark, sf, "documents"), "doc_id", "lang", 0.25, SEED)


@register("rare_levels")
def q_rare_levels(spark, sf):
    d = documents_split(spark, sf)
    kept = features.fit_rare_levels(d.filter("part = 'evaluation'"), ["lang"], 0.12)
    return features.apply_rare_levels(load(spark, sf, "documents"), kept).select("doc_id", "lang")


@register("one_hot")
def q_one_hot(spark, sf):
    d = documents_split(spark, sf)
    train = d.filter("part = 'evaluation'")
    kept = features.fit_rare_levels(train, ["lang"], 0.12)
    levels = features.fit_one_hot(features.apply_rare_levels(train, kept), ["lang"])
    docs = features.apply_rare_levels(load(spark, sf, "documents"), kept)
    oh = features.one_hot_expr("lang", levels["lang"])
    return docs.select("doc_id", F.array_join(F.transform(oh, lambda x: x.cast("int").cast("string")), ",").alias("onehot"))


@register("ordinal_codes")
def q_ordinal(spark, sf):
    p = sampling.stratified_split(load(spark, sf, "part"), "p_partkey", "p_size", 0.25, SEED)
    cols = ["p_type", "p_brand", "p_name"]
    codes = features.fit_ordinal(p.filter("part = 'tuning'"), cols)
    return features.apply_ordinal(load(spark, sf, "part"), codes, cols) \
        .select("p_partkey", "p_type_code", "p_brand_code", "p_name_code")


@register("constant_filter")
def q_constant_filter(spark, sf):
    lab = load(spark, sf, "labels").withColumn("source_table", F.lit("labels"))
    return features.constant_filter_table(lab, ["doc_id", "quality", "toxic", "source_table"])


@register("correlation_filter")
def q_correlation_filter(spark, sf):
    dm = document_measures(load(spark, sf, "documents"))
    kept = features.fit_correlation_filter(dm, DOC_MEASURES, 0.95)
    return spark.createDataFrame([(c, c in kept) for c in DOC_MEASURES], "feature string, kept boolean")


@register("leave_fold_out_params")
def q_lfo(spark, sf):
    f = sampling.stratified_folds(load(spark, sf, "orders"), "o_orderkey", "o_orderpriority", 10, SEED)
    return features.leave_fold_out_levels(f, ["o_orderstatus"], "fold", 0.3)


def lineitem_folds(spark, sf):
    return sampling.stratified_folds(lineitem_keyed(spark, sf), "row_key", BOUND_LABEL, 10, SEED)


def _each_fold(parts):
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _scaled(spark, sf, kind):
    """Every row, scaled with the parameters of the other folds."""
    f = materialize(lineitem_folds(spark, sf).select("row_key", "fold", *SCALE_COLS))
    out = features.apply_scaler_by_fold(f, features.fit_scaler_by_fold(f, SCALE_COLS, kind, "fold"), "fold")
    return out.select("row_key", *[F.round(c, 6).alias(c) for c in SCALE_COLS])


for _kind in ("minmax", "zscore", "robust", "log", "rank"):
    register(f"scale_{_kind}")(lambda spark, sf, _k=_kind: _scaled(spark, sf, _k))


@register("knn_features")
def q_knn_features(spark, sf):
    """K-NN preparation of every lineitem row, fitted on the other folds."""
    f = lineitem_folds(spark, sf).persist()
    out = _each_fold([features.knn_features(f.filter(F.col("fold") != k), f.filter(F.col("fold") == k),
                                            ["l_quantity", "l_extendedprice", "l_discount", "l_tax"], ["l_linestatus"])
                      .select("row_key", "features") for k in range(10)])
    return out.select("row_key", F.transform("features", lambda x: F.round(x, 6)).alias("features"))


# ---------------------------------------------------------------- trees, rules, SMOTE
from ..operators import rules, trees  # noqa: E402


def labelled_documents(spark, sf):
    """documents x labels with numeric measures, as used by the imbalanced-target queries."""
    return document_measures(load(spark, sf, "documents"), "lang", "source").join(load(spark, sf, "labels"), "doc_id", "inner")


def _doc_tree_folds(spark, sf):
    return persist_compact(sampling.stratified_folds(labelled_documents(spark, sf), "doc_id", "toxic", 5, SEED))


def _doc_tree(f):
    """A function from tree settings to out-of-fold predictions; each fold is
    prepared once, with codes of the nominals fitted on its training rows."""
    from . import studies
    names = ("doc_id", "toxic", "fold")
    ready = studies.prepared_tree_folds(f, "fold", "doc_id", "toxic", DOC_MEASURES, ["lang", "source"])
    return lambda **tree: studies.oof_tree(f, *names, DOC_MEASURES, ["lang", "source"], [0, 1], prepared=ready, **tree)


@register("power_class_weights")
def q_power_weights(spark, sf):
    return trees.power_weights(load(spark, sf, "labels"), "toxic", 0.75)


@register("smote_rows")
def q_smote(spark, sf):
    d = labelled_documents(spark, sf).select(
        "doc_id", "toxic", F.array(F.col("n_chars").cast("double"), F.col("n_spaces").cast("double"),
                                   F.col("n_lines").cast("double")).alias("x"))
    s = sampling.smote(d, "doc_id", "toxic", "x", cap=0.25, k=5, seed=SEED)
    return s.select("toxic", "i", "base", "neighbor", F.round("u", 9).alias("u"),
                    *[F.round(F.col("x")[j], 6).alias(f"x{j}") for j in range(3)])


@register("tree_distribution")
def q_tree_distribution(spark, sf):
    p = _doc_tree(_doc_tree_folds(spark, sf))(max_depth=4, alpha=0.75)
    return p.select(F.col("query").alias("doc_id"), "fold", "y", F.round(F.col("p")[0], 6).alias("p0"),
                    F.round(F.col("p")[1], 6).alias("p1"), "pred")


# the reference's two searches; its depth 30 and unbounded depth are the same tree
# in MLlib (None), and its weighting none or balanced is alpha 0 or 1
TREE_SPACES = [{"impurity": ["gini", "entropy"], "max_depth": [5, 10, 15, 20, None], "min_leaf": [1, 5, 20], "alpha": [0.0, 1.0]},
               {"impurity": ["entropy"], "max_depth": [13, 20, None], "min_leaf": [1, 2, 5], "alpha": [0.0, 0.25, 0.5, 0.75, 1.0]}]
TREE_PENALTIES = [0.0, 1e-6, 1e-5, 5e-5, 1e-4, 5e-4]


class _TreeSearch:
    """Tree searches on the labelled documents; queries of one session share the
    finished parts, which are bound to the settings and the rows."""

    def __init__(self, spark, sf):
        rows = _doc_tree_folds(spark, sf)
        self.study = Study(spark, "tree-search", {"measures": DOC_MEASURES, "folds": 5, "seed": SEED}, rows.drop("text"))
        self.ready = lambda: studies.prepared_tree_folds(rows, "fold", "doc_id", "toxic", DOC_MEASURES, ["lang", "source"])

    def grid(self, *spaces):
        return search.tree_grid(search.tree_confusions(self.ready, "toxic", [0, 1], list(spaces), self.study))


def _doc_tree_grid(spark, sf):
    return _TreeSearch(spark, sf).grid(*TREE_SPACES).drop("ccp_alpha")


@register("tree_grid")
def q_tree_grid(spark, sf):
    return _doc_tree_grid(spark, sf)


@register("alpha_sweep")
def q_alpha_sweep(spark, sf):
    return trees.best_per(_doc_tree_grid(spark, sf), "alpha")


def _knn15(spark, sf):
    return oof_predictions(spark, sf, [15], "distance")


def _emb_weights(spark, sf):
    w = trees.power_weights(load(spark, sf, "embeddings"), "label", 1.0).orderBy("label").collect()
    return [r["w"] for r in w]


@register("weighted_argmax")
def q_weighted_argmax(spark, sf):
    p = _knn15(spark, sf)
    return rules.weighted_argmax(p.select("query", "p"), _emb_weights(spark, sf), embedding_classes(spark, sf)) \
        .select("query", "pred")


@register("multiplier_fit")
def q_multiplier_fit(spark, sf):
    p = _knn15(spark, sf).select("fold", "y", "p")
    w, best = rules.fit_multipliers(p, embedding_classes(spark, sf))
    return w.withColumn("mean_macro_f1", F.lit(round(best, 6)))


@register("plain_vs_tuned")
def q_plain_vs_tuned(spark, sf):
    classes = embedding_classes(spark, sf)
    p = _knn15(spark, sf).persist()
    w, _ = rules.fit_multipliers(p.select("fold", "y", "p"), classes)
    wl = [r["w"] for r in w.orderBy("cls").collect()]
    tuned = rules.weighted_argmax(p.drop("pred"), wl, classes)
    def f1(df):
        return metrics.scores(metrics.confusion(df, ["fold"]), ["fold"], domain="all", n_classes=len(classes))
    a = f1(p).select("fold", F.col("f1_macro").alias("plain"))
    b = f1(tuned).select("fold", F.col("f1_macro").alias("tuned"))
    return a.join(b, "fold")


# ---------------------------------------------------------------- search and studies
from . import search, studies  # noqa: E402
from .runner import Study  # noqa: E402

DOC_NUMERIC = ["n_chars", "text_len", "n_spaces", "n_lines"]
DOC_NOMINAL = ["lang", "source"]


def doc_study_frame(spark, sf, k: int = 5):
    d = labelled_documents(spark, sf).select("doc_id", "toxic", *DOC_NUMERIC, *DOC_NOMINAL)
    return persist_compact(sampling.stratified_folds(d, "doc_id", "toxic", k, SEED))


@register("knn_grid")
def q_knn_grid(spark, sf):
    f = embedding_folds(spark, sf)
    return search.knn_grid(f, "vec_id", "embedding", "label", "fold", embedding_classes(spark, sf),
                           [1, 3, 5, 7, 9, 11, 15, 21, 31, 41], ["uniform", "distance"], ["manhattan", "euclidean"])


@register("knn_refined_grid")
def q_knn_refine(spark, sf):
    f = embedding_folds(spark, sf)
    classes = embedding_classes(spark, sf)
    coarse = search.knn_grid(f, "vec_id", "embedding", "label", "fold", classes, [1, 5, 15], ["uniform", "distance"],
                             ["manhattan"])
    b = search.best(coarse, "f1_mean", ["k", "weights", "metric"])
    return search.knn_grid(f, "vec_id", "embedding", "label", "fold", classes, search.refine_k(b["k"]),
                           [b["weights"]], [b["metric"]])


@register("cv_scores")
def q_cv_scores(spark, sf):
    f = doc_study_frame(spark, sf)
    p = studies.oof_knn(f, "doc_id", "toxic", "fold", DOC_NUMERIC, DOC_NOMINAL, [0, 1], k=5)
    return search.score_predictions(p, [])


@register("ablation_knn")
def q_ablation_knn(spark, sf):
    f = doc_study_frame(spark, sf)
    return studies.ablation_knn(f, "doc_id", "toxic", "fold", DOC_NUMERIC, DOC_NOMINAL, [0, 1], id_col="doc_id")


@register("ablation_tree")
def q_ablation_tree(spark, sf):
    f = doc_study_frame(spark, sf)
    return studies.ablation_tree(f, "doc_id", "toxic", "fold", DOC_NUMERIC, DOC_NOMINAL, [0, 1])


@register("scaling_study")
def q_scaling_study(spark, sf):
    f = doc_study_frame(spark, sf)
    return studies.scaling_study(f, "doc_id", "toxic", "fold", DOC_NUMERIC, DOC_NOMINAL, [0, 1])


@register("redundancy_study")
def q_redundancy_study(spark, sf):
    f = doc_study_frame(spark, sf)
    return studies.redundancy_study(f, "doc_id", "toxic", "fold", DOC_NUMERIC, DOC_NOMINAL, [0, 1])


@register("k_under_rule")
def q_k_under_rule(spark, sf):
    return studies.k_under_rule(oof_predictions(spark, sf, [5, 15, 31], "distance"), embedding_classes(spark, sf))


@register("training_size")
def q_training_size(spark, sf):
    e = load(spark, sf, "embeddings")
    s = sampling.stratified_split(e, "vec_id", "label", 0.25, SEED).persist()
    classes = embedding_classes(spark, sf)
    out = []
    for part in ("tuning", "evaluation"):
        f = sampling.stratified_folds(s.filter(F.col("part") == part).drop("rank_in_class"), "vec_id", "label", 5, SEED)
        g = search.knn_grid(f, "vec_id", "embedding", "label", "fold", classes, [1, 5, 15], ["uniform", "distance"],
                            ["manhattan"])
        out.append(g.select(F.concat_ws("_", F.lit("k"), F.col("k").cast("string"), "weights").alias("configuration"),
                            "f1_mean"))
    return studies.training_size(out[0], out[1])


@register("four_configurations")
def q_four_configurations(spark, sf):
    d = labelled_documents(spark, sf).select("doc_id", "toxic", *DOC_NUMERIC, *DOC_NOMINAL)
    s = persist_compact(sampling.stratified_split(d, "doc_id", "toxic", 0.25, SEED).drop("rank_in_class"))
    tune = persist_compact(sampling.stratified_folds(s.filter("part = 'tuning'").drop("part"), "doc_id", "toxic", 5, SEED))
    ev = persist_compact(sampling.stratified_folds(s.filter("part = 'evaluation'").drop("part"), "doc_id", "toxic", 10, SEED))
    return studies.four_configurations(ev, "doc_id", "toxic", "fold", DOC_NUMERIC, DOC_NOMINAL, [0, 1],
                                       tune_fold_df=tune, knn_k=15)


# ---------------------------------------------------------------- report tables and checks
from . import report  # noqa: E402
from ..operators import checks  # noqa: E402

KNN_CONFIGS = [f"knn_k{k}_{w}" for w in ("uniform", "distance") for k in (1, 5, 15)]


@register("report_class_distribution")
def q_report_classes(spark, sf):
    return report.class_distribution(audit.class_balance(load(spark, sf, "orders"), "o_orderpriority"))


@register("report_top_correlations")
def q_report_top_corr(spark, sf):
    return report.top_pairs(audit.correlations(document_measures(load(spark, sf, "documents")), DOC_MEASURES), 3)


@register("report_most_skewed")
def q_report_skewed(spark, sf):
    return report.most_skewed(_profile_li_part(spark, sf), 4)


def _knn_config_folds(spark, sf):
    # a few counts for each fold; scores, summaries and joins read them several times
    conf = materialize(metrics.confusion(knn_configurations(spark, sf), ["configuration", "fold"]))
    return metrics.scores(conf, ["configuration", "fold"]), conf


@register("report_final")
def q_report_final(spark, sf):
    folds, _ = _knn_config_folds(spark, sf)
    s = metrics.summary(folds, ["configuration"])
    return report.metric_by_configuration(s, KNN_CONFIGS, ["accuracy", "balanced_accuracy", "f1_macro", "kappa"])


@register("report_per_class")
def q_report_per_class(spark, sf):
    _, conf = _knn_config_folds(spark, sf)
    pc = metrics.per_class(conf, ["configuration", "fold"])
    return report.per_class_by_configuration(pc, KNN_CONFIGS)


@register("report_class_leads")
def q_report_class_leads(spark, sf):
    """Which configuration leads in which classes, and their share of the rows."""
    return report.class_leads(q_report_per_class(spark, sf), "knn_k15_distance", "knn_k1_uniform")


@register("report_per_fold")
def q_report_per_fold(spark, sf):
    folds, _ = _knn_config_folds(spark, sf)
    return report.per_fold_table(folds, KNN_CONFIGS, "f1_macro")


@register("report_bounds")
def q_report_bounds(spark, sf):
    resub = bounds.resubstitution_per_class(load(spark, sf, "lineitem"), BOUND_FEATURES, BOUND_LABEL)
    cv = bounds.cv_bounds_per_class(_memorisation(spark, sf), lineitem_classes(spark, sf))
    return report.bounds_by_class(resub, cv)


@register("chart_confusion")
def q_chart_confusion(spark, sf):
    conf = metrics.summed(_knn5_conf(spark, sf), [])
    return report.labelled_cells(metrics.row_normalised(conf, []).select("y", "pred", "n", "share"), 0.12)


@register("report_summary_cells")
def q_report_cells(spark, sf):
    folds, _ = _knn_config_folds(spark, sf)
    return report.summary_cells(metrics.summary(folds, ["configuration"]), ["f1_macro", "balanced_accuracy"])


@register("grid_completeness")
def q_grid_completeness(spark, sf):
    return report.grid_completeness(q_knn_grid(spark, sf), ["k", "weights", "metric"])


# fixed values: claims that hold for the driver tables at every scale factor (name, claimed value, tolerance)
CLAIMS = [("n_classes", "5", 0.0), ("id_unique", "true", 0.0), ("imbalance_ratio", "1.1", 0.1), ("n_numeric", "1", 0.0),
          ("n_nominal", "1", 0.0)]


@register("claim_check")
def q_claim_check(spark, sf):
    o = load(spark, sf, "orders")
    facts = audit.facts(o, "o_orderpriority", ["o_totalprice"], ["o_orderstatus"], "o_orderkey") \
        .select(F.col("fact").alias("name"), F.col("value"))
    claims = spark.createDataFrame(CLAIMS, "name string, claimed string, tol double")
    return checks.compare(claims, facts)


@register("summary_consistency")
def q_summary_consistency(spark, sf):
    folds, _ = _knn_config_folds(spark, sf)
    # the summary is stored and read back, then compared with the folds it sums up
    path = f"{ensure_checkpoint_dir(spark)}/summary-{uuid.uuid4().hex}"
    write_table(metrics.summary(folds, ["configuration"], digits=15), path)
    return checks.summary_matches_folds(spark.read.parquet(path), folds, ["configuration"], "f1_macro")


@register("bound_order")
def q_bound_order(spark, sf):
    from .sizing import join_single_rows
    cv = bounds.cv_bounds_summary(_memorisation(spark, sf), lineitem_classes(spark, sf))
    r = bounds.resubstitution(load(spark, sf, "lineitem"), BOUND_FEATURES, BOUND_LABEL, len(lineitem_classes(spark, sf)))
    return checks.bound_order(join_single_rows(cv, r.select(F.col("f1_macro").alias("macro_f1_resubstitution"))),
                              ["macro_f1_memorisation_cv", "macro_f1_conceded_cv", "macro_f1_resubstitution"])


# ---------------------------------------------------------------- chart tables and search slices
@register("chart_feature_ranges")
def q_chart_ranges(spark, sf):
    """Numeric ranges ascending, clipped below at 1e-3 for a log axis."""
    from ..functions.exprs import lower_clip
    p = _profile_li_part(spark, sf).filter("kind = 'numeric'")
    return p.select("feature", "rng", lower_clip("rng").alias("rng_clipped"))


@register("chart_score_by_k")
def q_chart_score_by_k(spark, sf):
    """Score by k, one series per (weights, metric)."""
    g = q_knn_grid(spark, sf)
    return g.select(F.concat_ws("/", "weights", "metric").alias("series"), "k", "f1_mean", "f1_std")


@register("knn_metric_wins")
def q_knn_metric_wins(spark, sf):
    """Manhattan against euclidean matched on (k, weights): wins and mean gain."""
    g = q_knn_grid(spark, sf)
    a = g.filter("metric = 'manhattan'").select("k", "weights", F.col("f1_mean").alias("a"))
    b = g.filter("metric = 'euclidean'").select("k", "weights", F.col("f1_mean").alias("b"))
    j = a.join(b, ["k", "weights"])
    return j.agg(F.count_if(F.col("a") > F.col("b")).cast("bigint").alias("wins"),
                 F.count(F.lit(1)).cast("bigint").alias("settings"),
                 F.round(F.avg(F.col("a") - F.col("b")), 6).alias("mean_gain"))


@register("chart_metric_by_fold")
def q_chart_metric_by_fold(spark, sf):
    """Metric by fold and configuration, long form."""
    folds, _ = _knn_config_folds(spark, sf)
    return folds.select("configuration", "fold", F.explode(F.array(*[
        F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in ("accuracy", "balanced_accuracy", "f1_macro")
    ])).alias("_e")).select("configuration", "fold", "_e.metric", "_e.value")


@register("chart_per_class_recall")
def q_chart_per_class_recall(spark, sf):
    """Per-class recall mean and SD over folds by configuration."""
    _, conf = _knn_config_folds(spark, sf)
    pc = metrics.per_class(conf, ["configuration", "fold"])
    return pc.groupBy("configuration", "cls").agg(F.round(F.avg("recall"), 6).alias("recall_mean"),
                                                  F.round(F.stddev_samp("recall"), 6).alias("recall_std"))


@register("report_differences")
def q_report_differences(spark, sf):
    """Difference, percent change and ratio of macro F1 between two configurations."""
    folds, _ = _knn_config_folds(spark, sf)
    s = metrics.summary(folds, ["configuration"])
    return report.difference_rows(s, "configuration", "knn_k15_distance", "knn_k1_uniform", "f1_macro_mean")


@register("report_quality_facts")
def q_report_quality_facts(spark, sf):
    return report.quality_facts(_profile_li_part(spark, sf), outlier_threshold=1.0)


@register("chart_metric_means")
def q_chart_metric_means(spark, sf):
    folds, _ = _knn_config_folds(spark, sf)
    return report.metric_means_long(metrics.summary(folds, ["configuration"]), ["accuracy", "balanced_accuracy", "f1_macro"])


ABLATION_ORDER = ["selected", "no scaling", "min-max scaling", "correlation filter 0.95", "no rare-level grouping",
                  "identifier kept"]


@register("report_ablation")
def q_report_ablation(spark, sf):
    return report.ablation_table(q_ablation_knn(spark, sf), ABLATION_ORDER)


TREE_ABLATION_ORDER = ["selected", "one-hot nominals", "min-max scaling", "correlation filter 0.95", "unweighted"]


@register("report_ablation_tree")
def q_report_ablation_tree(spark, sf):
    """The tree half of the ablation table, changes against the selected pipeline."""
    return report.ablation_table(q_ablation_tree(spark, sf), TREE_ABLATION_ORDER)


@register("report_correlation_cost")
def q_report_correlation_cost(spark, sf):
    """What each correlation threshold costs against keeping every feature."""
    return report.gain_over(q_redundancy_study(spark, sf), "setting", "none", "bal_mean")


@register("report_exponent_sweep")
def q_report_exponent(spark, sf):
    return report.exponent_sweep(q_alpha_sweep(spark, sf))


@register("report_multipliers")
def q_report_multipliers(spark, sf):
    classes = embedding_classes(spark, sf)
    f = embedding_folds(spark, sf)
    neigh = materialize(neighbors.knn(f, f, "vec_id", "embedding", "label", 15, "manhattan", fold="fold"))
    meta = f.select(F.col("vec_id").alias("query"), "fold", F.col("label").alias("y"))
    parts = []
    for weights in ("uniform", "distance"):       # both votes read one neighbour search
        p = neighbors.vote(neigh, [15], weights, classes).join(meta, "query").select("fold", "y", "p")
        w, _ = rules.fit_multipliers(p, classes)
        parts.append(w.withColumn("configuration", F.lit(f"knn_k15_{weights}")))
    counts = load(spark, sf, "embeddings").groupBy(F.col("label").alias("cls")).agg(F.count(F.lit(1)).alias("n"))
    return report.multipliers_by_class(parts[0].unionByName(parts[1]), counts, ["knn_k15_uniform", "knn_k15_distance"])


@register("chart_score_by_depth")
def q_chart_depth(spark, sf):
    best = _doc_tree_grid(spark, sf).groupBy("max_depth", "alpha").agg(
        F.max_by("f1_std", "f1_mean").alias("f1_std"), F.max("f1_mean").alias("f1_mean"))
    return report.score_by_depth(best)


# ---------------------------------------------------------------- remaining checks, bounds and settings
@register("audit_facts")
def q_audit_facts(spark, sf):
    """Headline facts of the orders table as (fact, value)."""
    return audit.facts(load(spark, sf, "orders"), "o_orderpriority", ["o_totalprice"], ["o_orderstatus"], "o_orderkey")


@register("check_recall_equals_balanced")
def q_check_v3(spark, sf):
    """V3: macro recall equals balanced accuracy when every predicted class also occurs (5e-4)."""
    folds, _ = _knn_config_folds(spark, sf)
    return folds.agg(F.count_if(F.abs(F.col("recall_macro") - F.col("balanced_accuracy")) <= 5e-4)
                     .cast("bigint").alias("equal"), F.count(F.lit(1)).cast("bigint").alias("folds"))


@register("check_pairwise_consistency")
def q_check_v6(spark, sf):
    """V6: pairwise mean differences equal the fold means; count significant pairs; Friedman at its maximum?"""
    from .sizing import join_single_rows
    t = orders_fold_table(spark, sf)
    pt = stats.paired_t(t)
    means = t.groupBy("grp").agg(F.avg("metric").alias("m"))
    a = means.select(F.col("grp").alias("group_a"), F.col("m").alias("ma"))
    b = means.select(F.col("grp").alias("group_b"), F.col("m").alias("mb"))
    j = pt.join(a, "group_a").join(b, "group_b")
    c = j.agg(F.bool_and(F.abs(F.col("mean_difference") - (F.col("ma") - F.col("mb"))) <= 1e-6).alias("differences_match"))
    h = stats.holm(stats.wilcoxon_pairs(t).select("group_a", "group_b", "wilcoxon_p"), "wilcoxon_p") \
        .agg(F.count_if("significant").cast("bigint").alias("significant_pairs"))
    fr = stats.friedman(t).select((F.col("statistic") >= F.col("n_folds") * (F.col("n_groups") - 1) - 1e-9)
                                  .alias("friedman_at_maximum"))
    return join_single_rows(c, h, fr)


@register("check_class_shares")
def q_check_v7(spark, sf):
    """V7/V8: class shares sum to 100 and class counts sum to the rows."""
    from .sizing import join_single_rows
    o = load(spark, sf, "orders")
    b = audit.class_balance(o, "o_orderpriority")
    s = b.agg(F.round(F.sum("percent"), 3).alias("percent_total"), F.sum("count").cast("bigint").alias("count_total"))
    n = o.agg(F.count(F.lit(1)).cast("bigint").alias("rows"))
    return join_single_rows(s, n).withColumn("shares_sum_to_100", F.abs(F.col("percent_total") - 100.0) <= 0.01) \
        .withColumn("counts_sum_to_rows", F.col("count_total") == F.col("rows"))


@register("bound_progress")
def q_bound_progress(spark, sf):
    """How much of the gap between memorisation and resubstitution the conceded bound closes."""
    from .sizing import join_single_rows
    cv = bounds.cv_bounds_summary(_memorisation(spark, sf), lineitem_classes(spark, sf))
    r = bounds.resubstitution(load(spark, sf, "lineitem"), BOUND_FEATURES, BOUND_LABEL, len(lineitem_classes(spark, sf)))
    j = join_single_rows(cv, r.select(F.col("f1_macro").alias("macro_f1_resubstitution")))
    gap = F.col("macro_f1_resubstitution") - F.col("macro_f1_memorisation_cv")
    return j.select(F.round(gap, 6).alias("gap"),
                    F.round(F.when(gap != 0, (F.col("macro_f1_conceded_cv") - F.col("macro_f1_memorisation_cv")) / gap), 6)
                    .alias("share_closed_by_conceding"))


@register("bound_share_needed")
def q_bound_share_needed(spark, sf):
    """What the easier classes would have to score for a macro F1 of 0.7."""
    return bounds.share_needed(bounds.resubstitution_per_class(load(spark, sf, "lineitem"), BOUND_FEATURES, BOUND_LABEL), 0.7)


TRAIN_PROBE = 10_000


@register("training_probe_gap")
def q_training_probe_gap(spark, sf):
    """Optimism gap of k-NN: accuracy on a stratified probe of 10,000 rows of
    each training fold (the whole fold if smaller; scored against that fold)
    minus out-of-fold accuracy."""
    f = embedding_folds(spark, sf)
    classes = embedding_classes(spark, sf)
    parts = []
    for fo in sorted(r[0] for r in f.select("fold").distinct().collect()):
        train = f.filter(F.col("fold") != fo)
        probe = sampling.stratified_take(train, "vec_id", "label", TRAIN_PROBE, SEED).select("vec_id", "embedding", "label")
        n = neighbors.knn(probe, train, "vec_id", "embedding", "label", 5)
        v = neighbors.vote(n, [5], "distance", classes).join(
            probe.select(F.col("vec_id").alias("query"), F.col("label").alias("y")), "query")
        parts.append(v.withColumn("fold", F.lit(fo)))
    probe_pred = parts[0]
    for p in parts[1:]:
        probe_pred = probe_pred.unionByName(p)
    tr = metrics.scores(metrics.confusion(probe_pred, ["fold"]), ["fold"]).select(
        "fold", F.col("accuracy").alias("train_accuracy"), F.col("balanced_accuracy").alias("train_balanced_accuracy"))
    cv = metrics.scores(_knn5_conf(spark, sf), ["fold"]).select("fold", "accuracy")
    return tr.join(cv, "fold").withColumn("optimism_gap", F.round(F.col("train_accuracy") - F.col("accuracy"), 6))


@register("report_settings")
def q_report_settings(spark, sf):
    """The selected k-NN settings and the partition sizes as (model, parameter, value)."""
    g = q_knn_grid(spark, sf)
    best = g.orderBy(F.desc("f1_mean"), "k", "weights", "metric").limit(1)
    sizes = q_split_sizes(spark, sf)
    def kvs(param, value):
        return F.struct(F.lit("k-NN").alias("model"), F.lit(param).alias("parameter"), value.cast("string").alias("value"))
    kv = best.select(F.inline(F.array(kvs("k", F.col("k")), kvs("weights", F.col("weights")),
                                      kvs("metric", F.col("metric")))))
    return kv.unionByName(sizes.select(F.lit("split").alias("model"), F.col("partition").alias("parameter"),
                                       F.col("instances").cast("string").alias("value")))


@register("report_search_scale")
def q_report_search_scale(spark, sf):
    """Settings tried per search and whether each grid is complete."""
    from . import report as rp
    g = q_knn_grid(spark, sf).withColumn("search", F.lit("knn_grid"))
    comp = rp.grid_completeness(g, ["k", "weights", "metric"])
    return comp.select(F.lit("knn_grid").alias("search"), F.col("rows").cast("bigint").alias("settings"), "complete")


@register("knn_lineitem_holdout")
def q_knn_lineitem_holdout(spark, sf):
    """J9 at table scale: the rows of every hundredth order against the rows of
    all other folds, k = 31, manhattan, on signed logs (no fitted parameter, so
    nothing leaks). No oracle (SQL brute force is too slow on whole tables); the
    blocked join is tested against brute force."""
    from ..functions.exprs import signed_log
    from .sizing import global_rank
    measures = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    f = global_rank(lineitem_folds(spark, sf).select(*LINEITEM_KEY, *measures, BOUND_LABEL, "fold"), LINEITEM_KEY, "rid")
    x = f.select("rid", "fold", "l_orderkey", F.array(*[signed_log(c) for c in measures]).alias("x"),
                 F.when(F.col(BOUND_LABEL) == "A", 0).when(F.col(BOUND_LABEL) == "N", 1).otherwise(2).alias("y"))
    n = neighbors.knn(x.filter("l_orderkey % 100 = 0"), x, "rid", "x", "y", 31, "manhattan", fold="fold")
    return n.select("query", "neighbor", F.round("d", 6).alias("d"), F.col("rn").cast("int").alias("rn"))


@register("audit_text_duplicates")
def q_audit_text_duplicates(spark, sf):
    """D11 on whole document texts: exact copies and conflicting quality labels.
    Texts become digests where they are scanned; no text is shuffled."""
    return audit.duplicates(_labelled_digests(spark, sf), ["text"], "quality")


def _labelled_digests(spark, sf):
    d = audit.digest_keyed(load(spark, sf, "documents").select("doc_id", "text"), ["text"])
    return d.join(load(spark, sf, "labels"), "doc_id")


@register("audit_text_majority")
def q_audit_text_majority(spark, sf):
    """A18 on whole document texts: majority quality label per distinct text,
    counted by digest; the texts come from a second scan."""
    found = audit.majority_labels(_labelled_digests(spark, sf), ["text"], "quality", key="doc_id")
    return audit.attach_texts(found, load(spark, sf, "documents"), ["text"], "doc_id")


@register("audit_label_balance")
def q_audit_label_balance(spark, sf):
    """A3 on the imbalanced target: toxic labels, zero-filled to the {0, 1} domain."""
    dim = spark.createDataFrame([(0, 0), (1, 1)], "code int, class int")
    return audit.class_balance(load(spark, sf, "labels"), "toxic", classes=dim)


# ---------------------------------------------------------------- preparation helpers, sinks, joined reports
from .. import sources  # noqa: E402
from ..functions import exprs  # noqa: E402


@register("duplicate_flags")
def q_duplicate_flags(spark, sf):
    """Repeated lineitem vectors, first occurrence kept."""
    f = audit.duplicate_flags(lineitem_keyed(spark, sf), [*BOUND_FEATURES, BOUND_LABEL], "row_key")
    return f.select("row_key", "is_duplicate")


@register("prepared_columns")
def q_prepared_columns(spark, sf):
    """P2-P5, P10, P14, F9, F10 on orders: missing token, strict cast, class
    names, one vector key, formatted cells, split and substituted strings."""
    o = load(spark, sf, "orders")
    numeric = exprs.numeric_columns(o.columns, ["o_orderstatus", "o_orderpriority", "o_orderdate"], ["o_custkey"])
    text = o.withColumn("price_text", F.col("o_totalprice").cast("string")).withColumn("priority", exprs.missing_to_level("o_orderpriority", "4-NOT SPECIFIED"))
    code = F.split("o_orderpriority", "-")
    return text.select(
        "o_orderkey", F.lit(",".join(numeric)).alias("numeric_columns"), "priority",
        F.round(exprs.strict_double("price_text"), 2).alias("price"),
        exprs.class_names("o_orderstatus", {"F": "finished", "O": "open", "P": "pending"}).alias("status"),
        exprs.vector_key(["o_orderstatus", "priority"]).alias("vector_key"),
        exprs.fmt_thousands(F.col("o_orderkey")).alias("key_cell"), exprs.small_int_word(F.col("o_orderkey") % 14).alias("word"),
        code[0].alias("priority_code"), F.initcap(F.lower(F.replace(code[1], F.lit(" "), F.lit("_")))).alias("priority_name"),
        F.regexp_replace("o_orderpriority", r"^(\d)-(\w+).*$", "$2/$1").alias("substituted"))


@register("first_folds")
def q_first_folds(spark, sf):
    """Scores of the first two folds only, which is what the step asks for."""
    return metrics.scores(_knn5_conf(spark, sf), ["fold"]).filter("fold < 2").select("fold", "f1_macro", "balanced_accuracy")


@register("sink_round_trip")
def q_sink_round_trip(spark, sf):
    """Orders written as CSV text, by-partition parquet and
    settings, read back, and counted with an absent table."""
    at = f"{ensure_checkpoint_dir(spark)}/sinks-{uuid.uuid4().hex}"
    o = load(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice")
    write_table(o, f"{at}/csv", fmt="csv")
    raw = sources.read_raw_csv(spark, f"{at}/csv", o.columns)
    sources.append_partitions(raw, f"{at}/parts", ["o_orderstatus"])
    sources.append_partitions(raw.filter("o_orderstatus = 'F'"), f"{at}/parts", ["o_orderstatus"])
    kept = sources.reuse_or_compute(spark, f"{at}/kept", lambda: spark.read.parquet(f"{at}/parts"), "all orders")
    sources.snapshot(kept, f"{at}/snapshot")
    sources.snapshot(kept.filter("o_orderstatus = 'P'"), f"{at}/snapshot")
    counts = sources.count_tables(spark, {"parts": f"{at}/parts", "snapshot": f"{at}/snapshot", "absent": f"{at}/absent"}, {})
    total = kept.agg(F.lit("price_cents").alias("group"), F.sum(F.round(F.col("o_totalprice").cast("double") * 100).cast("bigint")).alias("n"))
    return counts.withColumn("n", F.col("n").cast("bigint")).unionByName(total)


@register("report_joined")
def q_report_joined(spark, sf):
    """Fold means with pooled scores and class counts of some configurations."""
    folds, conf = _knn_config_folds(spark, sf)
    pooled = metrics.pooled_precision_recall(conf.filter("configuration like '%distance'"), ["configuration"])
    extra = conf.filter("configuration like 'knn_k15%'").groupBy("configuration").agg(F.sum("n").cast("bigint").alias("rows"))
    return report.joined_results(folds, pooled, extra)


@register("report_pairwise")
def q_report_pairwise(spark, sf):
    """Comparison, difference, p, adjusted p, significance."""
    t = orders_fold_table(spark, sf).withColumn("grp", F.replace(F.lower("grp"), F.lit(" "), F.lit("_")))
    pairs = stats.holm(stats.wilcoxon_pairs(t).select("group_a", "group_b", "wilcoxon_p"), "wilcoxon_p")
    return report.pairwise_projection(stats.paired_t(t).select("group_a", "group_b", "mean_difference").join(pairs, ["group_a", "group_b"]))


@register("report_corrections")
def q_report_corrections(spark, sf):
    """Correction facts of the audited tables."""
    return report.corrections(q_audit_duplicates(spark, sf), q_audit_correlation_counts(spark, sf))


@register("check_derived_numbers")
def q_check_derived(spark, sf):
    """V4: the stored differences between configurations against those that plain
    SQL takes from the confusion counts."""
    path = f"{ensure_checkpoint_dir(spark)}/derived-{uuid.uuid4().hex}"
    write_table(q_report_differences(spark, sf).withColumn("comparison", F.lit("k15 vs k1")), path)
    again = checks.macro_f1_difference(_knn_config_folds(spark, sf)[1], "configuration", "fold", "knn_k15_distance", "knn_k1_uniform") \
        .withColumn("comparison", F.lit("k15 vs k1"))
    return checks.derived_numbers(spark.read.parquet(path), again, ["comparison"], ["difference", "percent_change", "ratio"])


@register("report_tree_search")
def q_report_tree_search(spark, sf):
    """The tree search by weighting and by depth."""
    return report.tree_search_slice(_doc_tree_grid(spark, sf))


@register("tree_refined_grid")
def q_tree_refined(spark, sf):
    """Depth, exponent and leaf size searched again around the winner of
    the whole grid, with its impurity, each tree also pruned by every penalty."""
    tree = _TreeSearch(spark, sf)
    b = search.best(tree.grid(*TREE_SPACES), "f1_mean", search.TREE_AXES)
    fine = trees.refine(b, {"max_depth": search.refine_depth, "min_leaf": lambda n: [n, 1, 2, 5], "alpha": search.refine_alpha})
    return tree.grid({"impurity": [b["impurity"]], "ccp_alpha": TREE_PENALTIES} | fine)


@register("choose_k_and_rule")
def q_choose_k(spark, sf):
    """K and decision multipliers chosen together on out-of-fold distributions."""
    classes = embedding_classes(spark, sf)
    k, w, s = search.choose_k_and_rule(oof_predictions(spark, sf, [5, 15, 31], "distance"), classes, rules.fit_multipliers)
    return spark.createDataFrame([(int(k), int(c), float(x), round(s, 6)) for c, x in zip(classes, w)], "k int, cls int, w double, mean_macro_f1 double")


@register("report_scaling_gain")
def q_report_scaling_gain(spark, sf):
    """Gain of each scaler over min-max."""
    return report.gain_over(q_scaling_study(spark, sf), "transformation", "minmax", "bal_mean")
