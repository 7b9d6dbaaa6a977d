"""Model-based analysis on Spark ML and metric tables (M9).

Boosted-tree libraries of the reference are re-aimed to Spark ML trees;
fitting is distributed by Spark ML, the driver only keeps the fitted model and
#features-sized importance vectors.  Metrics are plain aggregates over a
prediction table so they stay SQL-checkable.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabscope.config import DEFAULT, Config
from tabscope.functions.exprs import col
from tabscope.plans.blocks import written


# ------------------------------------------------------------ metrics
def classification_metrics(pred: DataFrame, y: str, yhat: str, weight: str | None = None, by: Sequence[str] = ()) -> DataFrame:
    """M9: accuracy and macro F1 from the confusion counts (one group-by), of every group of ``by``; ``weight`` holds the rows that
    a row stands for."""
    n = F.count(F.lit(1)) if weight is None else F.sum(col(weight)).cast("bigint")
    cm = pred.groupBy(*[col(b) for b in by], col(y).cast("string").alias("y"), col(yhat).cast("string").alias("p")).agg(n.alias("n"))
    tp = cm.where(F.col("y") == F.col("p")).groupBy(*by, "y").agg(F.sum("n").alias("tp"))
    act = cm.groupBy(*by, "y").agg(F.sum("n").alias("n_true"))
    prd = cm.groupBy(*by, F.col("p").alias("y")).agg(F.sum("n").alias("n_pred"))
    per = act.join(prd, [*by, "y"], "full_outer").join(tp, [*by, "y"], "left").fillna(0, ["tp", "n_true", "n_pred"])
    f1 = F.when(F.col("n_true") + F.col("n_pred") > 0, 2.0 * F.col("tp") / (F.col("n_true") + F.col("n_pred"))).otherwise(0.0)
    return per.groupBy(*by).agg((F.sum("tp") / F.sum("n_true")).alias("accuracy"), F.avg(f1).alias("f1_macro"),
                                F.sum("n_true").alias("n"))


def log_loss(pred: DataFrame, y: Column, p: Column, eps: float = 1e-15) -> DataFrame:
    """M9: binary log-loss with probabilities clipped to [eps, 1-eps]."""
    pp = F.least(F.greatest(p.cast("double"), F.lit(eps)), F.lit(1 - eps))
    yy = y.cast("double")
    return pred.agg((-F.avg(yy * F.log(pp) + (1 - yy) * F.log(1 - pp))).alias("log_loss"), F.count(F.lit(1)).alias("n"))


def roc_auc(pred: DataFrame, y: Column, score: Column) -> DataFrame:
    """M9: ROC-AUC by the rank-sum (Mann-Whitney) formula with average ranks for ties.

    Ranks come from per-score counts (window over distinct scores only)."""
    t = pred.select(y.cast("int").alias("_y"), score.cast("double").alias("_s")).where(F.col("_s").isNotNull())
    from tabscope.plans.frames import running_sum
    g = t.groupBy("_s").agg(F.count(F.lit(1)).alias("k"), F.sum("_y").alias("pos"))
    r = running_sum(g, ["_s"], "k", out="_cum").withColumn("avg_rank", F.col("_cum") - F.col("k") + (F.col("k") + 1) / 2.0)
    a = r.agg(F.sum(F.col("pos") * F.col("avg_rank")).alias("rs"), F.sum("pos").alias("n1"), F.sum("k").alias("n"))
    n0 = F.col("n") - F.col("n1")
    auc = F.try_divide(F.col("rs") - F.col("n1") * (F.col("n1") + 1) / 2.0, F.col("n1") * n0)
    return a.select(auc.alias("auc"), F.col("n1").cast("bigint").alias("n_pos"), n0.cast("bigint").alias("n_neg"))


def regression_metrics(pred: DataFrame, y: Column, yhat: Column) -> DataFrame:
    """M9: RMSE, MAE and R^2."""
    e = yhat.cast("double") - y.cast("double")
    a = pred.agg(F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(F.abs(e)).alias("mae"), F.sum(e * e).alias("sse"),
                 F.var_pop(y.cast("double")).alias("vy"), F.count(F.lit(1)).alias("n"))
    return a.select("rmse", "mae", (1 - F.col("sse") / (F.col("vy") * F.col("n"))).alias("r2"), "n")


# ------------------------------------------------------------ Spark ML helpers
def _assemble(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], label: str | None, label_kind: str):
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import StringIndexer, VectorAssembler
    stages, names = [], list(numeric)
    for c in categorical:
        stages.append(StringIndexer(inputCol=c, outputCol=f"{c}__idx", handleInvalid="keep", stringOrderType="alphabetAsc"))
        names.append(f"{c}__idx")
    if label is not None and label_kind == "string":
        stages.append(StringIndexer(inputCol=label, outputCol="label", stringOrderType="alphabetAsc"))
    stages.append(VectorAssembler(inputCols=names, outputCol="features", handleInvalid="keep"))
    prepared = df
    if label is not None and label_kind != "string":
        prepared = df.withColumn("label", col(label).cast("double"))
    return Pipeline(stages=stages).fit(prepared).transform(prepared), list(numeric) + list(categorical)


def _forest(num_trees: int, depth: int, seed: int, max_bins: int = 64):
    from pyspark.ml.classification import RandomForestClassifier
    return RandomForestClassifier(numTrees=num_trees, maxDepth=depth, seed=seed, maxBins=max_bins,
                                  featuresCol="features", labelCol="label")


#: Rows from which trees are fitted on weighted cells, and the least number of points (or all rows) that a forest then draws from.
POINTS = 1_000_000
MAX_BINS = 64


def _edges_of(rows: DataFrame, numeric: Sequence[str]) -> list[list[float]]:
    """The bounds by which trees bin each column: one a value for up to ``MAX_BINS`` values, else quantiles of all rows."""
    clean = [F.when(~F.isnan(col(c).cast("double")), col(c).cast("double")) for c in numeric]
    at = [i / MAX_BINS for i in range(1, MAX_BINS)]
    got = rows.agg(F.count(F.lit(1)), *[F.approx_count_distinct(x).alias(f"d{i}") for i, x in enumerate(clean)]).first()
    few = [i for i in range(len(numeric)) if got[f"d{i}"] <= 2 * MAX_BINS]

    def cut(some):
        return [F.percentile_approx(clean[i], at, 10_000).alias(f"q{i}") for i in some]
    sets = rows.agg(F.count(F.lit(1)), *[F.collect_set(clean[i]).alias(f"v{i}") for i in few],
                    *cut([i for i in range(len(numeric)) if i not in few])).first().asDict()
    values = {i: sorted(set(sets[f"v{i}"])) for i in few}
    many = [i for i in few if len(values[i]) > MAX_BINS]
    if many:
        sets |= rows.agg(*cut(many)).first().asDict()
    return [values[i][:-1] if i in values and i not in many else sorted(set(sets[f"q{i}"] or [])) for i in range(len(numeric))]


def _binned(rows: DataFrame, numeric: Sequence[str], edges: Sequence[Sequence[float]]) -> DataFrame:
    """``rows`` with every numeric column replaced by its bin; nulls and NaN stay null, for Spark's trees to refuse."""
    from pyspark.ml.feature import Bucketizer
    known = {c: F.when(~F.isnan(col(c).cast("double")), col(c).cast("double")) for c in numeric}
    edges = [[b for b in e if b < math.inf] for e in edges]
    names = {c: f"_bin{i}" for i, (c, e) in enumerate(zip(numeric, edges)) if e}
    x = rows.withColumns({names.get(c, c): v if c in names else F.when(v.isNotNull(), F.lit(0.0)) for c, v in known.items()})
    if names:
        cuts = [[-math.inf, *[math.nextafter(float(b), math.inf) for b in e], math.inf] for e in edges if e]
        x = Bucketizer(splitsArray=cuts, inputCols=list(names.values()), outputCols=[f"{n}_" for n in names.values()], handleInvalid="keep").transform(x)
    return x.withColumns({c: F.when(F.col(n).isNotNull(), F.col(f"{n}_")) for c, n in names.items()}).select(*[col(c) for c in rows.columns])


def _cells(rows: DataFrame, numeric: Sequence[str], categorical: Sequence[str], target: str, by: Sequence[str] = ("_fold",),
           regression: bool = False) -> DataFrame:
    """Rows of binned features that trees can't tell apart, as one row with their number ``_weight``; a table of up to
    ``POINTS`` rows as it is.  A regression target is held by two points a cell, mean - deviation and mean + deviation
    with half the weight each: the same count, sum and sum of squares, so the same splits, leaves and squared errors."""
    if rows.count() <= POINTS:
        return rows
    y = col(target).cast("double")
    x = _binned(rows, numeric, _edges_of(rows, numeric))
    keys = [*by, *numeric, *categorical]
    n = F.count(F.lit(1)).cast("double")
    if not regression:
        return written(x.groupBy(*[col(k) for k in keys], col(target)).agg(n.alias("_weight")), "cells")
    g = x.groupBy(*[col(k) for k in keys]).agg(n.alias("_n"), F.avg(y).alias("_m"), F.stddev_pop(y).alias("_s"))
    return written(g.select(*[col(k) for k in keys], (F.col("_n") / 2).alias("_weight"),
                            F.explode(F.array(F.col("_m") - F.col("_s"), F.col("_m") + F.col("_s"))).alias(target)), "cells")


def _prepared(data: DataFrame, *more: str) -> DataFrame:
    return data.select("features", "label", *more, *[c for c in ("_weight",) if c in data.columns])


def _weighted(stage, data: DataFrame):
    return stage.setWeightCol("_weight") if "_weight" in data.columns else stage


def _fit(est, train: DataFrame, drawn: bool = True):
    """The model of ``train``.  Cells are added up over folds; where the estimator draws rows (``drawn``), a cell is dealt
    into as many points of equal weight as it takes for ``POINTS`` points, at most one a row."""
    if "_weight" not in train.columns:
        return est.fit(train)
    spread = max(2, train.sparkSession.sparkContext.defaultParallelism)
    g = train.repartition(spread, "features", "label").groupBy("features", "label").agg(F.sum("_weight").alias("_weight"))
    pieces = math.ceil(POINTS / max(1, g.count())) if drawn else 1
    if pieces > 1:
        m = F.greatest(F.lit(1), F.least(F.lit(pieces), F.floor("_weight"))).cast("int")
        g = g.select("features", "label", F.explode(F.array_repeat(F.col("_weight") / m, m)).alias("_weight"))
    return _weighted(est, g).fit(g)


#: Folds that are fitted at the same time.
PARALLEL = 4


def _over_folds(data: DataFrame, folds: int, work, parallel: int = PARALLEL) -> list:
    """``work(fold, training rows, validation rows)`` for every fold, a few at a time, over one stored table with
    ``_fold``; the fits are Spark jobs of their own, which share the cluster as those of ``CrossValidator`` do."""
    data = written(data, "folds")
    return _at_once(data.sparkSession, folds, lambda k: work(k, data.where(F.col("_fold") != k), data.where(F.col("_fold") == k)), parallel)


def _at_once(spark, n: int, work, parallel: int) -> list:
    """``work(0)`` to ``work(n - 1)``, ``parallel`` of them at a time."""
    from multiprocessing.pool import ThreadPool

    from pyspark import inheritable_thread_target
    pool = ThreadPool(max(1, min(parallel, n)))
    try:
        return pool.map(inheritable_thread_target(spark)(work), range(n))
    finally:
        pool.close()


def tree_importance(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], target: str, folds: int = 5,
                    num_trees: int = 50, depth: int = 6, boosting_steps: int = 150, learning_rate: float = 0.05,
                    seed: int = 42) -> DataFrame:
    """M2: gain importance as mean and deviation over stratified folds.  Two classes are fitted by boosted trees
    (``boosting_steps`` of depth 4 at most), more classes by a random forest (Spark's boosting knows two classes).  Boosted trees
    of a fold are fitted in one task on counted cells (:func:`tabscope.operators.forests.boosted_importances`); if the
    cells are too many for that, by Spark ML."""
    import numpy as np
    from pyspark.ml.classification import GBTClassifier

    from tabscope.operators.forests import _levels, boosted_importances, packed_cells
    names, gains = [*numeric, *categorical], None
    labelled = df.where(col(target).isNotNull())
    two = len(_levels(labelled, target, 3)) == 2
    if two:
        cells, sizes, _ = packed_cells(labelled, numeric, categorical, target)
        gains = boosted_importances(cells, sizes, len(categorical), folds, boosting_steps, min(depth, 4), learning_rate, seed)
    if gains is None:
        rows = _cells(_folded(df, target, folds, seed, names), numeric, categorical, target)
        data, _ = _assemble(rows, numeric, categorical, target, "string")

        def fit(k, train, _):
            est = GBTClassifier(maxIter=boosting_steps, maxDepth=min(depth, 4), stepSize=learning_rate, seed=seed + k, maxBins=64,
                                featuresCol="features", labelCol="label") if two else _forest(num_trees, depth, seed + k)
            return _fit(est, train, drawn=not two).featureImportances.toArray()
        gains = np.array(_over_folds(_prepared(data, "_fold"), folds, fit))
    rows = [(n, float(m), float(s)) for n, m, s in zip(names, gains.mean(axis=0), gains.std(axis=0, ddof=1 if folds > 1 else 0))]
    out = df.sparkSession.createDataFrame(rows, "feature string, importance double, importance_std double")
    w = Window.orderBy(F.col("importance").desc(), F.col("feature"))
    return out.withColumn("rank", F.row_number().over(w).cast("bigint"))


def importance_prune(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], target: str,
                     min_importance: float = 0.005, dominant: float = 0.9, seed: int = 42) -> DataFrame:
    """M5: importance + cumulative share + rank; importance < .005 and top level share > .9 => drop."""
    from tabscope.operators.profile import quasi_constant
    from tabscope.operators.series import cumulative_importance
    imp = tree_importance(df, numeric, categorical, target, seed=seed)
    cum = cumulative_importance(imp.select("feature", "importance"), "importance")
    qc = quasi_constant(df, list(numeric) + list(categorical), threshold=dominant).select("feature", "top_share")
    j = cum.join(qc, "feature", "left")
    return j.withColumn("drop", ((F.col("importance") < min_importance) & (F.col("top_share") > dominant)).cast("int"))


def null_importance(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], target: str,
                    key_cols: Sequence[str], shuffles: int = 5, folds: int = 5, num_trees: int = 30, depth: int = 4,
                    seed: int = 42) -> DataFrame:
    """M3: forest importance with the true target against permuted targets (exact distributed permutation).

    Importances are means over stratified folds, for the true target and for every shuffle; null mean / std / p95 / p99
    are taken over the shuffles.  safe_score = actual / null_p95, z score.  Above ``POINTS`` rows the forests of all runs and
    folds grow together on shared cells, whose rows are counted once: folds and shuffles are draws without replacement from the
    counts, in the order of the cells instead of ``key_cols`` (:mod:`tabscope.operators.forests`)."""
    import numpy as np

    from tabscope.plans.frames import permute_column

    def mean_importance(rows: DataFrame, run: int) -> np.ndarray:
        data, _ = _assemble(_folded(rows, target, folds, seed, names), numeric, categorical, target, "string")
        return np.mean(_over_folds(_prepared(data, "_fold"), folds, lambda k, train, _: _fit(
            _forest(num_trees, depth, seed + run * folds + k), train).featureImportances.toArray()), axis=0)

    def shared_importances() -> np.ndarray:
        from tabscope.operators.forests import grow, importances, packed_cells, run_blobs
        cells, sizes, classes = packed_cells(df, numeric, categorical, target)
        blobs = run_blobs(cells, range(1 + shuffles), folds, len(classes), seed)
        trees = grow(blobs, sizes, len(categorical), len(classes), folds, num_trees, depth, seed, 1 + shuffles)
        return importances(trees.feature, trees.gain, trees.says, len(names)).reshape(1 + shuffles, folds, -1).mean(axis=1)
    names = [*numeric, *categorical]
    if df.where(col(target).isNotNull()).count() > POINTS:
        actual, *arr = shared_importances()
    else:
        actual = mean_importance(df, 0)
        arr = [mean_importance(permute_column(df, target, key_cols, seed + 101 * (s + 1)), s + 1) for s in range(shuffles)]
    arr = np.array(arr)
    rows = [(n, float(actual[i]), float(arr[:, i].mean()), float(arr[:, i].std()), float(np.percentile(arr[:, i], 95)),
             float(np.percentile(arr[:, i], 99))) for i, n in enumerate(names)]
    out = df.sparkSession.createDataFrame(rows, "feature string, actual double, null_mean double, null_std double, "
                                                "null_p95 double, null_p99 double")
    return null_importance_score(out)


def null_importance_score(t: DataFrame) -> DataFrame:
    """M3 scoring arithmetic: safe_score = actual / null_p95, z = (actual - null_mean) / null_std."""
    return t.select("*", F.try_divide(F.col("actual"), F.col("null_p95")).alias("safe_score"),
                    F.try_divide(F.col("actual") - F.col("null_mean"), F.col("null_std")).alias("z_score"),
                    ((F.col("actual") > F.col("null_p99")) | (F.try_divide(F.col("actual"), F.col("null_p95")) > 1))
                    .cast("int").alias("significant"))


def adversarial_auc(train: DataFrame, test: DataFrame, numeric: Sequence[str], categorical: Sequence[str],
                    num_trees: int = 30, depth: int = 5, seed: int = 42) -> DataFrame:
    """M4: classifier separating train from test rows; AUC near .5 means no covariate shift.
    Scored on a held-out 30 % of the union, chosen by a hash of the features: equal rows go to one side."""
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    feats = list(numeric) + list(categorical)
    u = train.select(*feats).withColumn("is_test", F.lit(0)).unionByName(test.select(*feats).withColumn("is_test", F.lit(1)))
    data, _ = _assemble(u, numeric, categorical, "is_test", "numeric")
    data = data.withColumn("_fold", F.pmod(F.xxhash64(F.lit(seed), *[col(c) for c in feats], "is_test"), F.lit(10)))
    model = _forest(num_trees, depth, seed).fit(data.where(F.col("_fold") >= 3))
    scored = model.transform(data.where(F.col("_fold") < 3))
    auc = BinaryClassificationEvaluator(labelCol="label", rawPredictionCol="rawPrediction", metricName="areaUnderROC").evaluate(scored)
    return train.sparkSession.createDataFrame([(float(auc),)], "auc double").withColumn(
        "shift", F.when(F.col("auc") > 0.7, "strong").when(F.col("auc") > 0.6, "moderate").otherwise("none"))


def _folded(df: DataFrame, target: str, folds: int, seed: int, keep: Sequence[str]) -> DataFrame:
    """``keep`` and ``target`` with stratified folds in hash order of whole rows, of which the sort carries the hash only."""
    from tabscope.operators.series import stratified_folds
    rows = df.where(col(target).isNotNull()).select(
        *[col(c) for c in dict.fromkeys([*keep, target])], F.xxhash64(F.lit(seed), *[col(c) for c in df.columns]).alias("_h"))
    return stratified_folds(rows, target, folds, order_cols=["_h"], seed=seed).withColumnRenamed("fold", "_fold").drop("_h")


def quick_model(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], target: str, folds: int = 5,
                regression: bool = False, seed: int = 42) -> DataFrame:
    """M6: a forest baseline over folds: accuracy of a class (stratified folds of M1), or R2 of a number
    (``regression``; folds of rows in hash order).  Rows without a target are left out."""
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator
    from pyspark.ml.regression import RandomForestRegressor
    if regression:
        from tabscope.plans.frames import positions
        rows = df.where(col(target).isNotNull() & ~F.isnan(col(target).cast("double")))
        rows = rows.select(*[col(c) for c in dict.fromkeys([*numeric, *categorical, target])],
                           F.xxhash64(F.lit(seed), *[col(c) for c in rows.columns]).alias("_h"))
        rows = positions(rows, [F.col("_h")], name="_at")
        rows = rows.withColumn("_fold", F.pmod("_at", F.lit(folds)).cast("int")).drop("_at", "_h")
        data, _ = _assemble(_cells(rows, numeric, categorical, target, regression=True), numeric, categorical, target, "number")
        score = RegressionEvaluator(labelCol="label", predictionCol="prediction", metricName="r2")
    else:
        rows = _cells(_folded(df, target, folds, seed, [*numeric, *categorical]), numeric, categorical, target)
        data, _ = _assemble(rows, numeric, categorical, target, "string")
        score = MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction", metricName="accuracy")

    def fit(k, train, valid):
        est = RandomForestRegressor(numTrees=30, maxDepth=5, seed=seed + k, maxBins=64) if regression else _forest(30, 5, seed + k)
        return k, float(score.evaluate(_fit(est, train).transform(valid)))
    name = "r2" if regression else "accuracy"
    data, score = _prepared(data, "_fold"), _weighted(score, data)
    rows = _over_folds(data, folds, fit)
    return df.sparkSession.createDataFrame(rows, f"fold int, {name} double").agg(
        F.avg(name).alias(f"cv_{name}"), F.stddev_samp(name).alias("cv_std"), F.count(F.lit(1)).alias("folds"))


def permutation_importance(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], target: str,
                           seed: int = 42) -> DataFrame:
    """M7: accuracy drop when one feature is permuted (re-aim of SHAP attribution).  Above ``POINTS`` rows a forest on all rows is
    grown, permuted and scored on counted cells (:mod:`tabscope.operators.forests`); the permutation stays an exact one of all
    rows, drawn without replacement from the counts of the feature's bins."""
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator
    from tabscope.plans.frames import permute_column
    feats = [*numeric, *categorical]
    rows = _permuted_cells(df, numeric, categorical, target, seed) if df.count() > POINTS else []
    if not rows:
        data, _ = _assemble(df, numeric, categorical, target, "string")
        model = _fit(_forest(30, 5, seed), _prepared(data))
        ev = MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction", metricName="accuracy")
        base = ev.evaluate(model.transform(data))
        for f in feats:
            p = permute_column(df, f, [k for k in df.columns if k != f], seed, keep=[*feats, target])
            pd_, _ = _assemble(p, numeric, categorical, target, "string")
            rows.append((f, float(base - ev.evaluate(model.transform(pd_)))))
    return df.sparkSession.createDataFrame(rows, "feature string, accuracy_drop double")


def _permuted_cells(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], target: str, seed: int) -> list[tuple[str, float]]:
    """``(feature, accuracy drop)`` from the cells of a large table."""
    from tabscope.operators.forests import fold_blobs, fold_hits, grow, packed_cells, permuted_hits
    feats = [*numeric, *categorical]
    cells, sizes, classes = packed_cells(df, numeric, categorical, target)
    if cells.where("_y IS NULL").limit(1).count():
        raise ValueError(f"{target} is null")
    blobs = fold_blobs(cells, 0, seed)
    trees = grow(blobs, sizes, len(categorical), len(classes), 0, 30, 5, seed)
    hits = fold_hits(blobs, trees, len(feats), len(classes), 0)
    n, right = sum(h[3] for h in hits), sum(h[3] for h in hits if h[1] == h[2])
    return list(zip(feats, _at_once(df.sparkSession, len(feats), lambda f: (right - permuted_hits(cells, f, trees, sizes, seed)) / n, PARALLEL)))


def pca_variance(df: DataFrame, numeric: Sequence[str], threshold: float = 0.95) -> DataFrame:
    """Explained variance ratio per component on standardised complete rows; components for 95 %."""
    from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
    x = VectorAssembler(inputCols=list(numeric), outputCol="v", handleInvalid="skip").transform(df)
    x = StandardScaler(inputCol="v", outputCol="z", withMean=True, withStd=True).fit(x).transform(x)
    m = PCA(k=len(numeric), inputCol="z", outputCol="pc").fit(x)
    ev = m.explainedVariance.toArray().tolist()
    rows, cum = [], 0.0
    for i, v in enumerate(ev):
        cum += v
        rows.append((i + 1, float(v), float(cum)))
    out = df.sparkSession.createDataFrame(rows, "component int, explained double, cumulative double")
    n95 = out.where(F.col("cumulative") >= threshold).agg(F.min("component")).scalar()
    return out.withColumn("in_95", (F.col("component") <= n95).cast("int"))


def isolation_forest(df: DataFrame, numeric: Sequence[str], keys: Sequence[str], n_trees: int = 100,
                     sample_size: int = 256, contamination: float = 0.05, seed: int = 42) -> DataFrame:
    """Isolation Forest.  Trees are grown in parallel, one pandas group per tree on a
    hash-sampled <= 256-row subsample; the (small) forest is broadcast and rows are scored
    with mapInPandas; the cut is the (1 - contamination) quantile of the scores."""
    import numpy as np
    import pandas as pd

    from tabscope.plans.frames import quantile_scalar
    from tabscope.session import scratch_path
    feats = list(numeric)
    d = df.select(*[col(k) for k in keys], *[col(c).cast("double").alias(c) for c in feats]).na.drop(subset=feats)
    n = d.count()
    # every row draws, for each of a few of the trees, by a seeded hash: the expected draws of a tree are three times
    # its subsample, of which the smallest hashes are kept
    frac = min(1.0, 3.0 * sample_size / max(n, 1))
    draws = max(1, math.ceil(frac * n_trees))
    row = F.xxhash64(F.lit(seed), *[col(k) for k in keys], *[col(c) for c in feats])
    samp = d.select(*feats, F.explode(F.transform(F.sequence(F.lit(0), F.lit(draws - 1)), lambda i: F.struct(
        F.pmod(F.xxhash64(row, i), F.lit(n_trees)).cast("int").alias("tree"), F.xxhash64(row, i, F.lit(seed)).alias("_h")))).alias("_d"))
    samp = samp.select(*feats, "_d.*").where(
        F.pmod(F.xxhash64("_h"), F.lit(1 << 20)) < F.lit(int(min(1.0, frac * n_trees / draws) * (1 << 20))))
    samp = samp.withColumn("_at", F.row_number().over(Window.partitionBy("tree").orderBy("_h", *feats))).where(
        F.col("_at") <= sample_size).drop("_at")

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        tree_id = int(pdf["tree"].iloc[0])
        rng = np.random.default_rng(seed + tree_id)
        X = pdf.sort_values("_h")[feats].to_numpy()
        limit = int(np.ceil(np.log2(max(len(X), 2))))
        nodes = []

        def build(idx, depth):
            me = len(nodes)
            nodes.append([-1, 0.0, -1, -1, len(idx)])
            if depth >= limit or len(idx) <= 1:
                return me
            sub = X[idx]
            lo, hi = sub.min(axis=0), sub.max(axis=0)
            cand = np.where(hi > lo)[0]
            if len(cand) == 0:
                return me
            f = int(rng.choice(cand))
            s = float(rng.uniform(lo[f], hi[f]))
            left = idx[sub[:, f] < s]
            right = idx[sub[:, f] >= s]
            nodes[me][0], nodes[me][1] = f, s
            nodes[me][2] = build(left, depth + 1)
            nodes[me][3] = build(right, depth + 1)
            return me
        build(np.arange(len(X)), 0)
        return pd.DataFrame({"tree": tree_id, "node": range(len(nodes)), "feat": [x[0] for x in nodes],
                             "split": [x[1] for x in nodes], "left": [x[2] for x in nodes],
                             "right": [x[3] for x in nodes], "size": [x[4] for x in nodes]})
    forest = samp.groupBy("tree").applyInPandas(grow, "tree int, node int, feat int, split double, left int, "
                                                      "right int, size int")
    trees = forest.toPandas()  # n_trees x <= 511 nodes: bounded by parameters, not by data
    psi = min(sample_size, n)

    def c(m):
        m = np.asarray(m, dtype=float)
        many = 2.0 * (np.log(np.maximum(m - 1, 1)) + 0.5772156649) - 2.0 * (m - 1) / np.maximum(m, 1)
        return np.where(m > 2, many, np.where(m == 2, 1.0, 0.0))
    by_tree = [g.sort_values("node") for _, g in trees.groupby("tree")]
    bc = df.sparkSession.sparkContext.broadcast([(g["feat"].to_numpy(), g["split"].to_numpy(), g["left"].to_numpy(),
                                                  g["right"].to_numpy(), c(g["size"])) for g in by_tree])
    cn = max(float(c(psi)), 1e-12)

    def score(it):
        forest_ = bc.value
        for pdf in it:
            X = pdf[feats].to_numpy()
            total = np.zeros(len(X))
            for feat, split, left, right, rest in forest_:
                node = np.zeros(len(X), dtype=int)
                depth = np.zeros(len(X))
                active = feat[node] >= 0
                while active.any():
                    f = feat[node[active]]
                    go_left = X[active, f] < split[node[active]]
                    node[active] = np.where(go_left, left[node[active]], right[node[active]])
                    depth[active] += 1
                    active = feat[node] >= 0
                total += depth + rest[node]
            pdf = pdf[list(keys)].copy()
            pdf["score"] = 2.0 ** (-(total / len(forest_)) / cn)
            yield pdf
    key_schema = ", ".join(f"`{k}` {t}" for k, t in d.select(*keys).dtypes)
    path = scratch_path(df.sparkSession, "scores")
    d.mapInPandas(score, f"{key_schema}, score double").write.parquet(path)
    scored = df.sparkSession.read.parquet(path)
    cut = quantile_scalar(scored, ["score"], [1 - contamination]).getField("q0")[0]
    return scored.withColumn("outlier", (F.col("score") >= cut).cast("int"))


def variant_benchmark(df: DataFrame, variants: dict, target: str, folds: int = 5, num_trees: int = 20,
                      depth: int = 5, seed: int = 42) -> DataFrame:
    """M8: every feature-set variant x model (random forest, multinomial logistic regression) scored by
    accuracy and macro F1 (unweighted mean over classes) over stratified folds; returns (variant, model, metric, fold, score).

    ``variants`` maps a name to ``(transform(df) -> df, numeric, categorical)``.  Fits are Spark ML jobs;
    only the fold scores come back to the driver.  Above ``POINTS`` rows all variants share the folds of ``df``, the forests of a
    variant's folds grow together (:mod:`tabscope.operators.forests`) and so do its regressions, by Newton's method over all
    rows (:mod:`tabscope.operators.regressions`)."""
    from pyspark.ml.classification import LogisticRegression

    def fitted(est, rows: DataFrame, numeric, categorical, parallel: int) -> list:
        data = _prepared(_assemble(rows, numeric, categorical, target, "string")[0], "_fold")
        weight = "_weight" if "_weight" in data.columns else None
        return _over_folds(data, folds, lambda k, train, valid: (k, classification_metrics(
            _fit(est.copy(), train).transform(valid), "label", "prediction", weight).first()), parallel)

    def regression():
        return LogisticRegression(featuresCol="features", labelCol="label", maxIter=50)
    if df.count() > POINTS:
        rows = _large_variants(df, variants, target, folds, num_trees, depth, seed, lambda *a: fitted(regression(), *a, 1))
        return df.sparkSession.createDataFrame(rows, "variant string, model string, metric string, fold int, score double")
    rows = []
    for name, (fn, numeric, categorical) in variants.items():
        whole = _folded(fn(df), target, folds, seed, [*numeric, *categorical])
        cells = _cells(whole, numeric, categorical, target)
        # the forest takes cells of large tables, one fold's rows of which fill the cluster for the regression
        for mname, found in (("random_forest", fitted(_forest(num_trees, depth, seed), cells, numeric, categorical, PARALLEL)),
                             ("logistic", fitted(regression(), whole, numeric, categorical, PARALLEL if cells is whole else 1))):
            for k, got in found:
                rows += [(name, mname, metric, k, float(got[metric])) for metric in ("accuracy", "f1_macro")]
    return df.sparkSession.createDataFrame(rows, "variant string, model string, metric string, fold int, score double")


def _large_variants(df: DataFrame, variants: dict, target: str, folds: int, num_trees: int, depth: int, seed: int, by_spark) -> list[tuple]:
    """``(variant, model, metric, fold, score)`` of a large table; ``by_spark(rows, numeric, categorical)`` fits regressions of too
    many coefficients for Newton's method."""
    from tabscope.operators import forests, regressions
    from tabscope.operators.series import stratified_folds
    order = df.withColumn("_h", F.xxhash64(F.lit(seed), *[col(c) for c in df.columns]))
    base = stratified_folds(order, target, folds, order_cols=["_h"], seed=seed).withColumnRenamed("fold", "_fold").drop("_h")
    base = written(base, "folds")

    def scores(i: int):
        name, (fn, numeric, categorical) = list(variants.items())[i]
        feats = [*numeric, *categorical]
        x = fn(base)
        # a transform that drops the folds gets its own
        whole = x.where(col(target).isNotNull()).select(*[col(c) for c in dict.fromkeys([*feats, target])], "_fold") \
            if "_fold" in x.columns else written(_folded(fn(df), target, folds, seed, feats), "folds")
        packed, sizes, classes = forests.packed_rows(whole, numeric, categorical, target, ["_fold"])
        counts = [F.count_if(F.col("_fold") == k).alias(f"_n{k}") for k in range(folds)]
        cells = written(packed.groupBy(*[c for c in packed.columns if c != "_fold"]).agg(F.count(F.lit(1)).alias("_n"), *counts), "cells")
        blobs = forests.fold_blobs(cells, folds, seed)
        trees = forests.grow(blobs, sizes, len(categorical), len(classes), folds, num_trees, depth, seed)
        hits = [(name, "random_forest", *h) for h in forests.fold_hits(blobs, trees, len(feats), len(classes), folds)]
        data, _ = _assemble(whole, numeric, categorical, target, "string")
        columns = [*numeric, *[f"{c}__idx" for c in categorical]]
        found = regressions.fold_hits(data.select(*[col(c) for c in columns], "label", "_fold"), columns, len(classes), folds)
        if found is not None:
            return hits + [(name, "logistic", *h) for h in found], []
        return hits, [(name, "logistic", m, k, float(got[m])) for k, got in by_spark(whole, numeric, categorical) for m in ("accuracy", "f1_macro")]
    found = _at_once(df.sparkSession, len(variants), scores, PARALLEL)
    hits = df.sparkSession.createDataFrame([h for some, _ in found for h in some], "variant string, model string, fold int, y int, p int, n bigint")
    got = classification_metrics(hits, "y", "p", "n", ["variant", "model", "fold"]).collect()
    return [(r.variant, r.model, m, r.fold, float(r[m])) for r in got for m in ("accuracy", "f1_macro")] + [s for _, some in found for s in some]
