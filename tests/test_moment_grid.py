"""Correlations of many columns from one grid of moments."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabscope.operators.association import corr_pairs, derived_features, moment_grid


def test_against_numpy_with_gaps(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, 5)) * [1, 1e-6, 1e6, 1, 1] + [0, 0, 1e9, 5, 0]
    x[:, 3] += x[:, 0]
    x[:, 4] = 0.1
    x[rng.random(x.shape) < 0.2] = np.nan
    rows = [tuple(None if np.isnan(v) and i % 2 else float(v) for i, v in enumerate(r)) for r in x]  # nulls and NaN
    df = spark.createDataFrame(rows, [f"c{i}" for i in range(5)]).repartition(4)
    got = {(r.i, r.j): r for r in moment_grid(df, [F.col(f"c{i}") for i in range(5)], [F.col(f"c{i}") for i in range(5)]).collect()}
    assert len(got) == 25
    for (i, j), r in got.items():
        ok = ~np.isnan(x[:, i]) & ~np.isnan(x[:, j])
        assert r.n == ok.sum()
        if 4 in (i, j):
            assert r.r is None
        else:
            assert r.r == pytest.approx(np.corrcoef(x[ok, i], x[ok, j])[0, 1], abs=1e-10)


def test_three_hundred_columns(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(200, 300))
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], [f"c{i}" for i in range(300)])
    got = corr_pairs(df, df.columns)
    assert got.count() == 300 * 299 // 2
    r = got.where("feature_a = 'c17' and feature_b = 'c251'").first()
    assert r["corr"] == pytest.approx(np.corrcoef(x[:, 17], x[:, 251])[0, 1])


def test_both_routes_agree(spark, monkeypatch):
    from tabscope.operators import association
    rng = np.random.default_rng(4)
    df = spark.createDataFrame([tuple(map(float, r)) for r in rng.normal(size=(300, 4))], list("abcd"))
    few = {(r.feature_a, r.feature_b): r["corr"] for r in corr_pairs(df, df.columns).collect()}
    monkeypatch.setattr(association, "AGGREGATE_PAIRS", 0)
    many = {(r.feature_a, r.feature_b): r["corr"] for r in corr_pairs(df, df.columns).collect()}
    assert few.keys() == many.keys() and all(few[k] == pytest.approx(many[k], abs=1e-12) for k in few)


def test_derived_relations(spark):
    rng = np.random.default_rng(3)
    a, b = rng.uniform(1, 2, 500), rng.uniform(1, 9, 500)
    cols = {"a": a, "b": b, "times": a * b, "over": a / b, "plus": a + b, "noise": rng.normal(size=500)}
    df = spark.createDataFrame([tuple(float(v[i]) for v in cols.values()) for i in range(500)], list(cols))
    got = {(r.relation, r.feature_a, r.feature_b, r.target_col): r["corr"] for r in derived_features(df, list(cols), 0.9999).collect()}
    assert got["product", "a", "b", "times"] == pytest.approx(1) and got["ratio", "a", "b", "over"] == pytest.approx(1)
    assert got["sum", "a", "b", "plus"] == pytest.approx(1) and got["ratio", "times", "b", "a"] == pytest.approx(1)
    assert got["difference", "a", "plus", "b"] == pytest.approx(-1) and not any("noise" in k for k in got)
    assert derived_features(df, ["a", "b"]).collect() == [] == derived_features(df, ["a"]).collect()
