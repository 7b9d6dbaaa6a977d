"""Plans that stay narrow on large tables, and their results on rows with nulls and repeats."""

from pyspark.sql import functions as F


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _odd(spark):
    return spark.createDataFrame([(1, 0.0, "a"), (1, -0.0, None), (2, float("nan"), "a"), (None, float("nan"), "b"), (1, None, None)],
                                 "i int, d double, s string")


def test_cardinality_counts_columns_apart(spark):
    from tabscope.operators.profile import cardinality
    got = cardinality(_odd(spark))
    assert "Expand" not in _plan(got)
    assert {tuple(r) for r in got.collect()} == {("i", 2, 0.4), ("d", 2, 0.4), ("s", 2, 0.4)}


def test_todo_basic_takes_statistics_once(spark):
    from tabscope.operators.advice import todo_basic
    df = spark.range(300).select(F.when(F.col("id") < 100, F.col("id")).alias("gap"), (F.col("id") % 3).alias("few"),
                                 F.exp(F.col("id") / 20).alias("steep"), F.col("id").cast("string").alias("code"))
    got = todo_basic(df, ["gap", "few", "steep"], ["code"])
    assert "Expand" not in _plan(got) and _plan(got).count("skewness") <= 8
    assert sorted((r.feature, r.item) for r in got.collect()) == [
        ("code", "too many categories"), ("few", "few unique values"), ("gap", "high missing share"), ("steep", "high skew")]


def test_leak_encoding_has_no_window_over_levels(spark, tmp_path):
    from __spark_entry__ import queries
    rows = [("F", 1, "R"), ("F", 1, "A"), (None, 2, "R"), (None, 2, "R"), ("O", 2, None)]
    spark.createDataFrame(rows, "l_linestatus string, l_linenumber int, l_returnflag string").write.parquet(
        f"{tmp_path}/lineitem.parquet")
    got = queries()["leak_encoding"](spark, str(tmp_path))
    assert "Window" not in _plan(got)
    by = {r.feature: r for r in got.collect()}
    assert (by["enc_status"].n_levels, by["enc_status"].n_match, by["enc_status"].leak) == (2, 2, 1)
    assert (by["l_linestatus"].n_levels, by["l_linestatus"].n_numeric) == (2, 0)


def test_narrowed_quantiles_are_exact(spark, monkeypatch):
    import numpy as np

    from tabscope.plans import frames
    monkeypatch.setattr(frames, "NARROW_FROM", 10_000)
    rows = spark.range(40_000).select(
        F.when(F.col("id") % 7 > 0, F.sin(F.col("id")) * 1e6).alias("a"), F.when(F.col("id") % 3 > 0, F.col("id") % 5).otherwise(2).cast("double").alias("b"),
        F.when(F.col("id") % 11 == 0, float("nan")).otherwise(F.pow(F.lit(1.001), F.col("id") % 9000)).alias("c"),
        F.lit(None).cast("double").alias("d"))
    probs = [0.0, 0.01, 0.25, 0.5, 0.9, 1.0]
    cells = frames._narrowed_cells(rows, ["a", "b", "c", "d"], probs)
    assert cells is not None and cells.where("feature = 'a'").count() < 2_000
    got = {r.feature: r.q for r in frames.quantile_table(rows, ["a", "b", "c", "d"], probs).collect()}
    pdf = rows.toPandas()
    assert "d" not in got
    for f in "abc":
        assert np.allclose(got[f], np.quantile(pdf[f].dropna().to_numpy(), probs), rtol=1e-12)


def _trees_rows(spark, n=4000):
    x, z = F.col("id") % 40, F.pmod(F.hash("id"), F.lit(1000)) / 1000.0
    return spark.range(n).select("id", x.cast("double").alias("x"), z.alias("z"), F.when(F.col("id") % 3 > 0, "k").alias("w"),
                                 F.when(x < 20, "a").when(x < 30, "b").otherwise("c").alias("y"), F.when(x < 20, "a").otherwise("b").alias("two"),
                                 (x * 2 + F.when(z > 0.5, 10).otherwise(0)).alias("v"))


def test_cells_hold_all_rows(spark, monkeypatch):
    from tabscope.operators import models as M
    df = _trees_rows(spark).withColumn("_fold", (F.col("id") % 3).cast("int"))
    assert M._cells(df, ["x", "z"], ["w"], "y") is df
    monkeypatch.setattr(M, "POINTS", 100)
    got = M._cells(df, ["x", "z"], ["w"], "y")
    assert got.agg(F.sum("_weight")).first()[0] == 4000 and got.count() < 4000
    old = {tuple(r) for r in df.groupBy("_fold", "w", "y").count().collect()}
    assert {tuple(r) for r in got.groupBy("_fold", "w", "y").agg(F.sum("_weight").cast("bigint")).collect()} == old
    assert {r.z for r in got.select("z").distinct().collect()} <= {float(k) for k in range(64)}
    pair = M._cells(df, ["x"], ["w"], "v", regression=True)
    a, b = (t.agg(*[F.sum(F.pow("v", F.lit(k)) * w) for k in (0, 1, 2)]).first() for t, w in ((df, F.lit(1.0)), (pair, F.col("_weight"))))
    assert all(abs(p - q) <= 1e-6 * abs(q) for p, q in zip(a, b))


def test_trees_on_cells_agree_with_rows(spark, monkeypatch):
    from tabscope.operators import models as M

    def results():
        df = _trees_rows(spark)
        boosted = {r.feature: r.importance for r in M.tree_importance(df, ["x", "z"], ["w"], "two", folds=2, boosting_steps=2).collect()}
        forest = {r.feature: r.importance for r in M.tree_importance(df, ["x", "z"], ["w"], "y", folds=2, num_trees=10).collect()}
        drop = {r.feature: r.accuracy_drop for r in M.permutation_importance(df, ["x", "z"], ["w"], "y").collect()}
        return (boosted, forest, drop, M.quick_model(df, ["x", "z"], ["w"], "y", folds=2).first().cv_accuracy,
                M.quick_model(df, ["x", "z"], ["w"], "v", folds=2, regression=True).first().cv_r2,
                M.variant_benchmark(df, {"raw": (lambda d: d, ["x", "z"], ["w"])}, "y", folds=2, num_trees=10).groupBy("model", "metric").agg(
                    F.avg("score").alias("s")).collect())
    before = results()
    monkeypatch.setattr(M, "POINTS", 1000)
    after = results()
    for a, b in zip(before[:3], after[:3]):
        assert a.keys() == b.keys() and all(abs(a[k] - b[k]) < 0.1 for k in a)
    assert abs(before[3] - after[3]) < 0.05 and abs(before[4] - after[4]) < 0.05
    assert all(abs(a.s - {(r.model, r.metric): r.s for r in after[5]}[a.model, a.metric]) < 0.05 for a in before[5])


def test_forests_of_all_shuffles_grow_together(spark, monkeypatch):
    from tabscope.operators import models as M
    df = _trees_rows(spark).select("*", F.when(F.col("id") % 5 > 0, F.concat(F.lit("g"), F.col("id") % 8)).alias("g"))

    def results(target):
        got = M.null_importance(df, ["x", "z"], ["w", "g"], target, ["id"], shuffles=2, folds=2, num_trees=20)
        return {r.feature: (r.actual, r.null_mean) for r in got.collect()}
    before = {y: results(y) for y in ("y", "two")}
    monkeypatch.setattr(M, "POINTS", 1000)

    def no_fit(*_, **__):
        raise AssertionError("a fit of its own")
    monkeypatch.setattr(M, "_fit", no_fit)
    for y, old in before.items():
        new = results(y)
        assert new.keys() == old.keys() and results(y) == new
        for i in (0, 1):
            assert abs(sum(v[i] for v in new.values()) - 1) < 1e-6
            assert all(abs(new[f][i] - old[f][i]) < 0.12 for f in old)
        assert all(abs(new[f][0] - old[f][0]) < 0.06 for f in old)


def test_shared_forests_refuse_missing_numbers(spark, monkeypatch):
    import pytest

    from tabscope.operators import models as M
    monkeypatch.setattr(M, "POINTS", 100)
    df = _trees_rows(spark, 400).withColumn("x", F.when(F.col("id") != 7, F.col("x")))
    with pytest.raises(Exception, match="x is null or NaN"):
        M.null_importance(df, ["x", "z"], ["w"], "y", ["id"], shuffles=1, folds=2, num_trees=2).collect()


def test_permuted_classes_keep_counts_and_folds(spark):
    from tabscope.plans.frames import permute_classes
    df = spark.range(3000).select("id", F.lit(None).cast("int").alias("k"), F.when(F.col("id") < 700, 0).when(F.col("id") < 2900, 1).alias("y"))
    got = permute_classes(df, "y", ["k"], 7, 4).collect()
    by = {}
    for r in got:
        by.setdefault(r.y, []).append(r)
    assert sorted(r.id for r in got) == list(range(3000)) and {y: len(v) for y, v in by.items()} == {0: 700, 1: 2200, None: 100}
    for v in by.values():
        n = [sum(r.fold == k for r in v) for k in range(4)]
        assert max(n) - min(n) <= 1
    # keys that are all null still leave no order of the input
    assert abs(sum(r.id < 700 for r in by[0]) - 700 * 700 / 3000) < 80


def test_splits_without_another_prediction_are_pruned():
    import numpy as np

    from tabscope.operators.forests import importances
    gain = np.array([[[4.0, 2.0, 1.0], [5.0, 0.0, 3.0]]])
    feature = np.array([[[0, 1, 2], [0, 0, 1]]])
    says = np.array([[[(0, 1), (0, 1), (1, 1)], [(0, 0), (0, 0), (0, 0)]]])
    # the first tree loses its third split; the second one all
    assert np.allclose(importances(feature, gain, says, 3), [[4 / 6, 2 / 6, 0]])


def test_boosted_importance_takes_all_steps(spark, monkeypatch, tmp_path):
    from __spark_entry__ import queries
    from tabscope.operators import forests, models as M
    seen, boost = [], forests.boosted_importances
    monkeypatch.setattr(forests, "boosted_importances", lambda *a: seen.append(a) or boost(*a))
    rows = spark.range(300).select(F.when(F.col("id") % 3 == 0, "R").when(F.col("id") % 3 == 1, "A").otherwise("N").alias("l_returnflag"), *[
        F.pmod(F.hash("id", F.lit(c)), F.lit(9)).cast("double").alias(c) for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")],
        F.when(F.col("id") % 7 > 2, "O").otherwise("F").alias("l_linestatus"))
    rows.write.parquet(f"{tmp_path}/lineitem.parquet")
    got = queries()["boosted_importance"](spark, str(tmp_path)).collect()
    assert len(got) == 5 and abs(sum(r.importance for r in got) - 1) < 1e-6
    assert [a[4] for a in seen] == [150]


def test_boosted_trees_on_cells_are_those_of_spark(spark):
    import numpy as np
    from pyspark.ml.classification import GBTClassifier

    from tabscope.operators import forests, models as M
    odd = (F.col("x") < 20).cast("int") + (F.pmod(F.hash("id"), F.lit(10)) < 3).cast("int") + (F.col("z") > 30).cast("int")
    df = spark.range(1500).select("id", (F.col("id") % 40).cast("double").alias("x"), F.pmod(F.hash("id", F.lit(2)), F.lit(50)).cast("double").alias("z"),
                                  F.when(F.col("id") % 5 > 0, F.concat(F.lit("g"), F.pmod(F.hash("id", F.lit(3)), F.lit(8)))).alias("w"))
    df = df.withColumn("y", F.when(odd % 2 == 1, "a").otherwise("b"))
    data, _ = M._assemble(df, ["x", "z"], ["w"], "y", "string")
    old = GBTClassifier(maxIter=6, maxDepth=3, stepSize=0.05, maxBins=64).fit(data).featureImportances.toArray()
    cells, sizes, _ = forests.packed_cells(df, ["x", "z"], ["w"], "y")
    p = cells.toPandas()
    codes, of = np.unique(p["_x0"], return_inverse=True)
    n0, n1 = (np.bincount(of, weights=np.where(p["_y"] == c, p["_n"], 0)) for c in (0, 1))
    assert p["_n"].sum() == 1500
    assert np.allclose(forests.boost(forests.unpacked(codes[:, None], 3), n0, n1, sizes, 1, 6, 3, 0.05), old, atol=1e-6)


def test_boosting_falls_back_where_a_task_cannot_hold_the_cells(spark, monkeypatch):
    from tabscope.operators import forests, models as M
    df = _trees_rows(spark, 400)
    local = {r.feature: r.importance for r in M.tree_importance(df, ["x", "z"], ["w"], "two", folds=2, boosting_steps=2).collect()}
    monkeypatch.setattr(forests, "LOCAL", 10)
    by_spark = {r.feature: r.importance for r in M.tree_importance(df, ["x", "z"], ["w"], "two", folds=2, boosting_steps=2).collect()}
    assert local.keys() == by_spark.keys() and all(abs(local[f] - by_spark[f]) < 0.1 for f in local)


def test_deal_is_a_random_permutation():
    import numpy as np

    from tabscope.operators import forests
    for one_by_one in (1 << 22, 0):
        old, forests.ONE_BY_ONE = forests.ONE_BY_ONE, one_by_one
        try:
            rng = np.random.default_rng(3)
            sizes, pool = [5, 0, 1, 14], [8, 9, 3]
            got = np.array([forests.deal(rng, sizes, pool) for _ in range(4000)])
            assert (got.sum(2) == sizes).all() and (got.sum(1) == pool).all()
            n = sum(pool)
            want = np.outer(sizes, pool) / n
            assert np.abs(got.mean(0) - want).max() < 0.15
            # the spread is that of draws without replacement
            var = want * (1 - np.array(pool) / n) * (n - np.array(sizes)[:, None]) / (n - 1)
            assert np.abs(got.var(0) - var).max() < 0.15
        finally:
            forests.ONE_BY_ONE = old
    pools = forests.part_pools([4, 0, 16], [8, 9, 3], 1)
    assert [int(p.sum()) for p in pools] == [4, 0, 16] and (sum(pools) == [8, 9, 3]).all()
    assert forests.fold_pool(11, 4) == [3, 3, 3, 2]
    assert forests.deal(np.random.default_rng(1), [], [0, 0]).shape == (0, 2)
    big = forests._spread(np.random.default_rng(1), np.array([10 ** 9, 10 ** 9, 0, 2 * 10 ** 9]), 10 ** 9)
    assert big.sum() == 10 ** 9 and big[2] == 0 and abs(big[0] - 25e7) < 1e6


def _no_sorted_rows(monkeypatch):
    """Positions of rows take a sort and a stored copy of the table."""
    from tabscope.plans import frames

    def no_sort(*_, **__):
        raise AssertionError("rows are sorted")
    monkeypatch.setattr(frames, "positions", no_sort)


def test_null_importance_of_large_tables_stores_no_rows(spark, monkeypatch):
    from tabscope.operators import forests, models as M
    monkeypatch.setattr(M, "POINTS", 1000)
    _no_sorted_rows(monkeypatch)
    df = _trees_rows(spark).withColumn("y", F.when(F.col("id") % 50 > 0, F.col("y")))
    stored, written = [], forests.written
    monkeypatch.setattr(forests, "written", lambda t, name: stored.append(written(t, name)) or stored[-1])
    monkeypatch.setattr(forests, "_stored", lambda t, parts, keep=forests._stored: stored.append(keep(t, parts)) or stored[-1])
    got = {r.feature: r for r in M.null_importance(df, ["x"], ["w"], "y", ["id"], shuffles=2, folds=3, num_trees=10).collect()}
    assert got["x"].actual > got["x"].null_mean and abs(sum(r.actual for r in got.values()) - 1) < 1e-6
    # 40 values of x, two of w, three classes and null
    assert stored and all(t.count() <= 40 * 2 * 4 for t in stored)


def test_runs_hold_all_rows_in_stratified_folds(spark):
    from tabscope.operators import forests
    df = _trees_rows(spark).withColumn("y", F.when(F.col("id") % 50 > 0, F.col("y")))
    cells, sizes, classes = forests.packed_cells(df, ["x"], ["w"], "y")
    assert cells.agg(F.sum("_n")).first()[0] == 4000 and classes == ["a", "b", "c"]
    blobs = forests.run_blobs(cells, range(3), 3, 3, 1)
    again = {(r["_run"], r["_part"]): tuple(r) for r in forests.run_blobs(cells.repartition(5), range(3), 3, 3, 1).collect()}
    assert {(r["_run"], r["_part"]): tuple(r) for r in blobs.collect()} == again
    own = {c: df.where(F.col("y") == c).count() for c in classes}
    counts = {}
    for run, _, bins, of, y, n in forests._arrays([blobs.toPandas()], 2):
        total = counts.setdefault(run, [[0] * 3 for _ in classes])
        for i in range(len(y)):
            for k in range(3):
                total[y[i]][k] += int(n[i, k])
        if run == 0:
            truth = {(r.x, r.w, r.y): r["count"] for r in df.where("y IS NOT NULL").groupBy("x", "w", "y").count().collect()}
            assert truth == {(float(bins[0][of[i]]), ("k", None)[bins[1][of[i]]], classes[y[i]]): int(n[i].sum()) for i in range(len(y))}
    for run in range(3):
        for c, folded in zip(classes, counts[run]):
            assert sum(folded) == own[c] and max(folded) - min(folded) <= 1


def test_permutation_importance_of_large_tables_sorts_no_rows(spark, monkeypatch):
    from tabscope.operators import models as M
    df = _trees_rows(spark).select("*", F.when(F.col("id") % 5 > 0, F.concat(F.lit("g"), F.col("id") % 8)).alias("g"))

    def results(t):
        return {r.feature: r.accuracy_drop for r in M.permutation_importance(t, ["x", "z"], ["w", "g"], "y").collect()}
    before = results(df)
    monkeypatch.setattr(M, "POINTS", 1000)
    _no_sorted_rows(monkeypatch)
    after = results(df)
    assert list(after) == ["x", "z", "w", "g"] and after == results(df.repartition(3))
    assert after["x"] > 0.3 and all(abs(before[f] - after[f]) < 0.06 for f in before)
    # every row's class is there once: a permutation keeps the values of the feature
    import pytest
    with pytest.raises(Exception, match="y is null"):
        results(df.withColumn("y", F.when(F.col("id") > 0, F.col("y"))))


def test_forest_on_cells_scores_its_rows(spark):
    from tabscope.operators import forests
    df = _trees_rows(spark, 2000)
    cells, sizes, classes = forests.packed_cells(df, ["x", "z"], ["w"], "y")
    blobs = forests.fold_blobs(cells, 0, 5)
    trees = forests.grow(blobs, sizes, 1, 3, 0, 20, 5, 5)
    hits = forests.fold_hits(blobs, trees, 3, 3, 0)
    right = sum(h[3] for h in hits if h[1] == h[2])
    assert sum(h[3] for h in hits) == 2000 and right > 1900
    assert forests.permuted_hits(cells, 0, trees, sizes, 5) < right - 500
    # a feature of one value keeps every prediction
    one, sizes, _ = forests.packed_cells(df.withColumn("u", F.lit(1.0)), ["x", "u"], [], "y")
    blobs = forests.fold_blobs(one, 0, 5)
    trees = forests.grow(blobs, sizes, 0, 3, 0, 20, 5, 5)
    assert forests.permuted_hits(one, 1, trees, sizes, 5) == sum(h[3] for h in forests.fold_hits(blobs, trees, 2, 3, 0) if h[1] == h[2])


def _joint_rows(spark):
    x, z = (F.col("id") % 40).cast("double"), F.pmod(F.hash("id"), F.lit(1000)) / 1000.0
    y = F.when(F.pmod(F.hash("id", F.lit(5)), F.lit(10)) < 3, "c").when(x + 20 * z < 20, "a").when(x < 30, "b").otherwise("c")
    return spark.range(2500).select("id", x.alias("x"), z.alias("z"), (x + z).alias("s"), F.lit(7.0).alias("same"), F.when(F.col("id") % 3 > 0, "k").alias("w"),
                                    (F.col("id") % 2).cast("int").alias("_fold"), y.alias("y"), F.when(y == "a", "p").otherwise("q").alias("two"))


def test_joint_regressions_are_those_of_spark(spark):
    from pyspark.ml.classification import LogisticRegression

    from tabscope.operators import models as M, regressions
    for y, numeric in (("y", ["x", "z", "s", "same"]), ("two", ["x", "z"])):
        data, _ = M._assemble(_joint_rows(spark), numeric, ["w"], y, "string")
        columns = [*numeric, "w__idx"]
        classes = 3 if y == "y" else 2
        got = regressions.fold_hits(data.select(*columns, "label", "_fold"), columns, classes, 2)
        for k in range(2):
            model = LogisticRegression(maxIter=100, tol=1e-9).fit(data.where(F.col("_fold") != k))
            old = {(int(r.label), int(r.prediction)): r["count"] for r in model.transform(data.where(F.col("_fold") == k)).groupBy(
                "label", "prediction").count().collect()}
            new = {(a, p): n for f, a, p, n in got if f == k}
            assert sum(new.values()) == 1250 and sum(abs(new.get(c, 0) - old.get(c, 0)) for c in {*old, *new}) <= 4


def test_separable_and_single_classes_have_a_regression(spark):
    from tabscope.operators import regressions
    df = spark.range(300).select((F.col("id") % 10).cast("double").alias("x"), (F.col("id") % 10 > 4).cast("double").alias("label"), (F.col("id") % 3).cast("int").alias("_fold"))
    assert sorted(regressions.fold_hits(df, ["x"], 2, 3)) == [(k, c, c, 50) for k in range(3) for c in (0, 1)]
    assert sorted(regressions.fold_hits(df.withColumn("label", F.lit(0.0)), ["x"], 1, 3)) == [(k, 0, 0, 100) for k in range(3)]


def test_variants_of_large_tables_share_folds_and_passes(spark, monkeypatch):
    from tabscope.operators import models as M, series
    df = _joint_rows(spark).drop("_fold").withColumn("y", F.when(F.col("id") % 100 > 0, F.col("y")))
    variants = {"raw": (lambda d: d, ["x", "z"], ["w"]), "sum": (lambda d: d.withColumn("t", F.col("x") + F.col("z")), ["x", "z", "t"], []),
                "own": (lambda d: d.select("id", "x", "w", "y"), ["x"], ["w"])}

    def results():
        return {tuple(r)[:4]: r.score for r in M.variant_benchmark(df, variants, "y", folds=2, num_trees=10).collect()}
    before = results()
    monkeypatch.setattr(M, "POINTS", 1000)
    folded, calls = series.stratified_folds, []
    monkeypatch.setattr(series, "stratified_folds", lambda *a, **k: calls.append(1) or folded(*a, **k))

    def no_fit(*_, **__):
        raise AssertionError("a fit of its own")
    monkeypatch.setattr(M, "_fit", no_fit)
    after = results()
    assert len(after) == 3 * 2 * 2 * 2 and after.keys() == before.keys() and len(calls) == 2
    for v, m, s in {k[:3] for k in before}:
        assert abs(sum(before[v, m, s, k] - after[v, m, s, k] for k in range(2)) / 2) < 0.05


def test_metrics_of_groups_are_those_of_each(spark):
    from tabscope.operators import models as M
    df = spark.createDataFrame([(0, "a", "a"), (0, "a", "b"), (0, "b", "b"), (1, "a", "c"), (1, "c", "c"), (1, "c", "c")], "k int, y string, p string")
    got = {r.k: tuple(r)[1:] for r in M.classification_metrics(df, "y", "p", by=["k"]).collect()}
    for k in (0, 1):
        assert got[k] == tuple(M.classification_metrics(df.where(F.col("k") == k), "y", "p").first())


def test_bins_of_odd_numbers(spark):
    from tabscope.operators import models as M
    inf = float("inf")
    df = spark.createDataFrame([(-inf, 1.0), (-0.0, 1.0), (0.0, None), (3.0, 1.0), (inf, 1.0), (float("nan"), float("nan")), (None, 1.0)], "x double, u double")
    got = M._binned(df, ["x", "u"], [[0.0, 3.0, inf], []]).collect()
    assert [r.x for r in got] == [0.0, 0.0, 0.0, 1.0, 2.0, None, None]
    assert [r.u for r in got] == [0.0, 0.0, None, 0.0, 0.0, None, 0.0]
    assert M._edges_of(df, ["x", "u"]) == [[-inf, 0.0, 3.0], []]
