"""Exact bootstrap counts, fold-wise model scores."""

import numpy as np
import pytest

from tabscope.operators import cleaning
from tabscope.operators.cleaning import bootstrap_counts, bootstrap_rows, leaf_copies


def test_leaves_add_up_and_follow_the_multinomial(monkeypatch):
    monkeypatch.setattr(cleaning, "BOOTSTRAP_LEAF", 8)
    for rows, draws in ((1, 5), (7, 0), (8, 100), (9, 9), (1000, 1000), (1003, 77), (50, 10**9)):
        got = np.concatenate([leaf_copies(rows, draws, i, 3) for i in range(-(-rows // 8))])
        assert len(got) == rows and got.sum() == draws
    many = np.array([np.concatenate([leaf_copies(21, 21, i, s) for i in range(3)]) for s in range(4000)])
    assert np.allclose(many.mean(axis=0), 1, atol=0.08) and np.allclose(many.var(axis=0), 20 / 21, atol=0.1)
    assert np.corrcoef(many[:, 0], many[:, 20])[0, 1] == pytest.approx(-1 / 20, abs=0.05)  # across leaves
    assert np.mean(many == 0) == pytest.approx((1 - 1 / 21) ** 21, abs=0.01)


def test_counts_on_a_table(spark):
    df = spark.range(10000).selectExpr("id", "id % 7 as g")
    one = {r.id: r.copies for r in bootstrap_counts(df, ["id"]).collect()}
    again = {r.id: r.copies for r in bootstrap_counts(df.repartition(13, "g"), ["id"]).collect()}
    assert one == again and len(one) == 10000 and sum(one.values()) == 10000
    assert sum(v == 0 for v in one.values()) / 10000 == pytest.approx(np.exp(-1), abs=0.03)
    assert one != {r.id: r.copies for r in bootstrap_counts(df, ["id"], seed=1).collect()}
    assert sum(r.copies for r in bootstrap_counts(df, ["id"], n=123).collect()) == 123
    rows = bootstrap_rows(df, ["id"])
    assert rows.columns == ["id", "g", "draw"] and rows.count() == 10000
    assert bootstrap_rows(df.where("id < 0"), ["id"]).collect() == []
    same = spark.createDataFrame([(None, 1)] * 50 + [(3, 2)] * 50, "id long, x int")  # ties and nulls
    assert sum(r.copies for r in bootstrap_counts(same, ["id"]).collect()) == 100


def frame(spark, n=1500):
    rng = np.random.default_rng(3)
    x, z, w = rng.normal(size=n), rng.normal(size=n), rng.choice(["p", "q"], n)
    y = 3 * x + (w == "p") + rng.normal(size=n) * 0.1
    rows = [(float(a), float(b), str(c), float(v), "high" if v > 0 else "low", "abc"[int(v > -1) + int(v > 1)]) for a, b, c, v in zip(x, z, w, y)]
    return spark.createDataFrame(rows, "x double, z double, w string, y double, two string, three string")


def test_importance_is_a_mean_over_folds(spark):
    from tabscope.operators.models import tree_importance
    df = frame(spark)
    for target in ("two", "three"):
        got = tree_importance(df, ["x", "z"], ["w"], target, folds=3, num_trees=5, boosting_steps=4).collect()
        assert got[0].feature == "x" and got[0].importance > 0.7 and got[0]["rank"] == 1
        assert sum(r.importance for r in got) == pytest.approx(1) and all(0 <= r.importance_std < 0.3 for r in got)


def test_regression_baseline(spark):
    from tabscope.operators.models import quick_model
    df = frame(spark)
    got = quick_model(df, ["x", "z"], ["w"], "y", folds=3, regression=True).first()
    assert got.cv_r2 > 0.7 and got.cv_std < 0.1 and got.folds == 3
    assert quick_model(df, ["z"], [], "y", folds=3, regression=True).first().cv_r2 < 0.1
    assert quick_model(df, ["x"], ["w"], "two", folds=3).first().cv_accuracy > 0.9
