"""Studies: compositions with their own output tables.

Every configuration is scored out of fold with preparation fitted on the
training folds only: for held-out fold f the transforms are those of the other
folds, taken for all folds from one pass over the rows, and applied to all
rows, so a loop over folds (bounded by the fold count) drives distributed
jobs; nothing row-level passes the driver. Finished configurations are parts
of a stored study.
"""

from __future__ import annotations

from threading import Lock

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import features, metrics, neighbors, rules, sampling, stats, trees
from .runner import Study, data_fingerprint
from .search import score_counts
from .sizing import materialize


def _per_fold(fn, folds: list, threads: int = 4) -> list:
    """Run the per-fold pipelines concurrently from driver threads: each is a
    chain of small Spark jobs, so overlapping them keeps the executors busy.
    Every part is checkpointed inside its thread."""
    from concurrent.futures import ThreadPoolExecutor
    with ThreadPoolExecutor(max_workers=max(1, min(threads, len(folds)))) as ex:
        return list(ex.map(fn, folds))


def synthetic_key(label: str):
    """Keys for synthetic rows: negative 62-bit hashes of (class, i), disjoint
    from the non-negative keys of real rows."""
    return -(F.pmod(F.xxhash64(F.col(label).cast("string"), F.col("i")), F.lit(1 << 62)) + 1)


def _with_smote(tr: DataFrame, key: str, label: str, feats: str) -> DataFrame:
    """Training rows plus capped-SMOTE rows (K6) for the minority classes."""
    syn = sampling.smote(tr, key, label, feats, cap=0.25, k=5)
    return tr.select(key, label, feats).unionByName(
        syn.select(synthetic_key(label).alias(key), label, feats))


def prepared_knn_folds(df: DataFrame, fold: str, key: str, label: str, numeric: list[str], nominal: list[str], **prep) -> list[tuple]:
    """(fold, prepared rows) for every fold, fitted on its training rows
    (M11/M13). Checkpointed, so that several configurations share them."""
    every = features.knn_features_by_fold(df, fold, numeric, nominal, **prep)
    return _per_fold(lambda f: (f, materialize(every[f].select(key, label, fold, "features"))), sorted(every))


def oof_knn(df: DataFrame, key: str, label: str, fold: str, numeric: list[str], nominal: list[str],
            classes: list, k: int = 5, weights: str = "distance", metric: str = "manhattan",
            smote: bool = False, prepared: list[tuple] | None = None, **prep) -> DataFrame:
    """Out-of-fold k-NN distributions with per-fold preparation (M11/M13) or on
    ``prepared`` folds, optional SMOTE on the prepared training rows (K6).
    ``query, fold, y, p, pred``. Folds prepared here have nominals as level codes,
    which the search counts as their one-hot columns; SMOTE needs the columns."""
    codes = 0 if smote or prepared else len(nominal)

    def one_fold(part):
        f, rows = part
        tr, te = rows.filter(F.col(fold) != f), rows.filter(F.col(fold) == f)
        if smote:
            tr = materialize(_with_smote(tr, key, label, "features"))
        neigh = neighbors.knn(te, tr, key, "features", label, k, metric, codes=codes)
        v = neighbors.vote(neigh, [k], weights, classes)
        return materialize(v.join(te.select(F.col(key).cast("long").alias("query"), F.col(label).alias("y")), "query")
                           .withColumn("fold", F.lit(f)).select("query", "fold", "y", "p", "pred"))
    prepared = prepared or prepared_knn_folds(df, fold, key, label, numeric, nominal, codes=bool(codes), **prep)
    return _union(_per_fold(one_fold, prepared))


def prepared_tree_folds(df: DataFrame, fold: str, key: str, label: str, numeric: list[str], nominal: list[str],
                        scale=None, corr=None, onehot=False) -> list[tuple]:
    """(fold, prepared rows) for every fold, fitted on its training rows.

    Checkpointed, so a search over tree settings prepares each fold once."""
    every = features.tree_features_by_fold(df, fold, numeric, nominal, scale=scale, corr=corr, onehot=onehot)
    return _per_fold(lambda f: (f, materialize(every[f].select(key, label, fold, "features"))), sorted(every))


def oof_tree(df: DataFrame, key: str, label: str, fold: str, numeric: list[str], nominal: list[str],
             classes: list, scale=None, corr=None, onehot=False, smote: bool = False, prepared: list[tuple] | None = None,
             **tree) -> DataFrame:
    """Out-of-fold tree distributions with per-fold preparation (M12/M13), or
    on ``prepared`` folds."""
    def one_fold(part):
        f, rows = part
        tr, te = rows.filter(F.col(fold) != f), rows.filter(F.col(fold) == f)
        if smote:
            from pyspark.ml.functions import array_to_vector, vector_to_array
            arr = tr.select(key, label, vector_to_array("features").alias("features"))
            # cut the k-NN/SMOTE lineage before MLlib's repeated passes over its input
            tr = materialize(_with_smote(arr, key, label, "features")).withColumn("features", array_to_vector("features"))
        pr = trees.tree_probabilities(tr, te, key, "features", label, classes, **tree)
        return materialize(pr.join(te.select(key, F.col(label).alias("y")), key)
                           .select(F.col(key).cast("long").alias("query"), F.lit(f).alias("fold"), "y", "p", "pred"))
    prepared = prepared or prepared_tree_folds(df, fold, key, label, numeric, nominal, scale, corr, onehot)
    return _union(_per_fold(one_fold, prepared))


def _scored(df, key, name_col: str, settings: dict, configurations: dict, study: Study | None) -> DataFrame:
    """Scores of every named configuration (a function that gives out-of-fold
    predictions). Each one's confusion counts by fold are a part of a study, so
    a study that was stopped goes on with the configurations that are missing."""
    study = study or Study(df.sparkSession, name_col, settings | {"configurations": list(configurations), "key": key}, df)

    def part(name, predictions):
        return lambda: metrics.confusion(predictions(), ["fold"]).select(F.lit(name).alias(name_col), "fold", "y", "pred", "n").coalesce(1)

    conf = study.run({name: part(name, p) for name, p in configurations.items()}, threads=2)     # one's small jobs fill the other's gaps
    return score_counts(conf, [name_col])


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def ablation_knn(df, key, label, fold, numeric, nominal, classes, id_col=None, study: Study | None = None) -> DataFrame:
    """Selected pipeline and one step switched off at a time."""
    variants = {
        "selected": dict(scale="rank"),
        "no scaling": dict(scale=None),
        "min-max scaling": dict(scale="minmax"),
        "correlation filter 0.95": dict(scale="rank", corr=0.95),
        "no rare-level grouping": dict(scale="rank", group=False),
    }
    runs = {n: lambda o=o: oof_knn(df, key, label, fold, numeric, nominal, classes, **o) for n, o in variants.items()}
    if id_col:
        runs["identifier kept"] = lambda: oof_knn(df, key, label, fold, [*numeric, id_col], nominal, classes, scale="rank")
    return _scored(df, key, "variant", {"study": "ablation k-NN", "columns": [*numeric, *nominal]}, runs, study)


def ablation_tree(df, key, label, fold, numeric, nominal, classes, study: Study | None = None, **tree) -> DataFrame:
    """Tree pipeline variants (ordinal vs one-hot, scaling, correlation filter, weighting)."""
    variants = {
        "selected": dict(),
        "one-hot nominals": dict(onehot=True),
        "min-max scaling": dict(scale="minmax"),
        "correlation filter 0.95": dict(corr=0.95),
        "unweighted": dict(alpha=0.0),
    }
    base = dict(max_depth=6, alpha=0.75)
    base.update(tree)
    runs = {n: lambda o=o: oof_tree(df, key, label, fold, numeric, nominal, classes, **(base | o)) for n, o in variants.items()}
    return _scored(df, key, "variant", {"study": "ablation tree", "columns": [*numeric, *nominal], "tree": base}, runs, study)


def scaling_study(df, key, label, fold, numeric, nominal, classes, k: int = 5, study: Study | None = None) -> DataFrame:
    """D3: five scalers for k-NN, best first."""
    runs = {s: lambda s=s: oof_knn(df, key, label, fold, numeric, nominal, classes, k=k, scale=s)
            for s in ("rank", "log", "robust", "zscore", "minmax")}
    found = _scored(df, key, "transformation", {"study": "scaling", "columns": [*numeric, *nominal], "k": k}, runs, study)
    return found.orderBy(F.desc("bal_mean"), "transformation")


def redundancy_study(df, key, label, fold, numeric, nominal, classes, k: int = 5, study: Study | None = None) -> DataFrame:
    """Correlation filter none / 0.99 / 0.95 / 0.90."""
    runs = {"none" if t is None else f"|r| >= {t}":
            lambda t=t: oof_knn(df, key, label, fold, numeric, nominal, classes, k=k, scale="rank", corr=t)
            for t in (None, 0.99, 0.95, 0.90)}
    found = _scored(df, key, "setting", {"study": "redundancy", "columns": [*numeric, *nominal], "k": k}, runs, study)
    return found.withColumn("threshold", F.when(F.col("setting") != "none", F.substring_index("setting", " ", -1)).cast("double"))


def k_under_rule(pred_many_k: DataFrame, classes: list, rounds: int = 6) -> DataFrame:
    """Macro F1 per k with the plain rule and with fitted multipliers."""
    rows = []
    pred_many_k = materialize(pred_many_k.select("k", "fold", "y", "p", "pred"))      # one search for every k
    for k in sorted(r[0] for r in pred_many_k.select("k").distinct().collect()):
        p = pred_many_k.filter(F.col("k") == k)
        plain = metrics.scores(metrics.confusion(p, ["fold"]), ["fold"], "all", len(classes)) \
            .agg(F.avg("f1_macro")).first()[0]
        _, tuned = rules.fit_multipliers(p.select("fold", "y", "p"), classes, rounds=rounds)
        rows.append((int(k), round(float(plain), 6), round(float(tuned), 6)))
    spark = pred_many_k.sparkSession
    return spark.createDataFrame(rows, "k int, plain double, tuned double") \
        .withColumn("gain", F.round(F.col("tuned") - F.col("plain"), 6))


def training_size(scores_small: DataFrame, scores_large: DataFrame) -> DataFrame:
    """Per configuration score on the small and the large partition,
    gain, ranks in each and whether the ranking held."""
    a = scores_small.select(F.col("configuration").alias("grp"), F.col("f1_mean").alias("metric"))
    b = scores_large.select(F.col("configuration").alias("grp"), F.col("f1_mean").alias("metric"))
    return stats.rank_stability(a, b).withColumnRenamed("grp", "configuration") \
        .withColumnRenamed("metric_1", "tuning_f1").withColumnRenamed("metric_2", "evaluation_f1") \
        .withColumnRenamed("rank_1", "tuning_rank").withColumnRenamed("rank_2", "evaluation_rank")


def plain_vs_tuned(pred: DataFrame, weights: list[float], classes: list) -> DataFrame:
    """Per fold macro F1 with the plain arg max and with the multipliers."""
    tuned = rules.weighted_argmax(pred.drop("pred"), weights, classes)

    def f1(d):
        return metrics.scores(metrics.confusion(d, ["fold"]), ["fold"], "all", len(classes)).select("fold", "f1_macro")
    return f1(pred).withColumnRenamed("f1_macro", "plain").join(f1(tuned).withColumnRenamed("f1_macro", "tuned"), "fold")


def four_configurations(df, key, label, fold, numeric, nominal, classes, tune_fold_df=None, knn_k: int = 15,
                        tree_params: dict | None = None, rounds: int = 6, study: Study | None = None) -> DataFrame:
    """K-NN, k-NN + SMOTE, tree, tree + SMOTE, each with its own decision
    multipliers fitted on out-of-fold distributions of the tuning rows
    (``tune_fold_df``) and applied to the evaluation folds. Returns the fold
    table ``configuration, fold, accuracy, balanced_accuracy, f1_macro, ...``."""
    tree_params = tree_params or dict(max_depth=6, alpha=0.75)
    names = (fold, key, label, numeric, nominal)
    ready = {}
    lock = Lock()

    def folds_of(kind, rows):                                # prepared once for a model with and without SMOTE
        with lock:
            if (kind, rows is df) not in ready:
                ready[kind, rows is df] = (prepared_knn_folds if kind == "k-NN" else prepared_tree_folds)(rows, *names)
            return ready[kind, rows is df]

    makers = {
        "k-NN": lambda d, s: oof_knn(d, key, label, fold, numeric, nominal, classes, k=knn_k, smote=s, prepared=folds_of("k-NN", d)),
        "tree": lambda d, s: oof_tree(d, key, label, fold, numeric, nominal, classes, smote=s, prepared=folds_of("tree", d), **tree_params),
    }
    study = study or Study(df.sparkSession, "four-configurations", {
        "columns": [*numeric, *nominal], "k": knn_k, "tree": tree_params, "rounds": rounds,
        "tuning": tune_fold_df is not None and data_fingerprint(tune_fold_df)}, df)

    def part(name, make, smote):
        def rows():
            w = [1.0] * len(classes)
            if tune_fold_df is not None:
                wdf, _ = rules.fit_multipliers(make(tune_fold_df, smote).select("fold", "y", "p"), classes, rounds=rounds)
                w = [r["w"] for r in wdf.orderBy("cls").collect()]
            pred = rules.weighted_argmax(make(df, smote).drop("pred"), w, classes)
            return metrics.confusion(pred, ["fold"]).select(F.lit(name).alias("configuration"), "fold", "y", "pred", "n").coalesce(1)
        return rows

    runs = {name + (" + SMOTE" if smote else ""): part(name + (" + SMOTE" if smote else ""), make, smote)
            for name, make in makers.items() for smote in (False, True)}
    return metrics.scores(study.run(runs, threads=len(runs)), ["configuration", "fold"])
