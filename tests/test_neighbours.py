"""Exact neighbours, outlier factors and k-NN mutual information against brute force."""

import numpy as np
import pytest

from tabscope.operators import neighbours
from tabscope.operators.neighbours import local_outlier_factor, nearest


def brute_factor(x, k):
    n = len(x)
    if n < 2:
        return np.full(n, np.nan), np.full(n, np.nan)
    d = np.sqrt(sum((x[:, i][:, None] - x[:, i][None, :]) ** 2 for i in range(x.shape[1])))
    others = d.copy()
    np.fill_diagonal(others, np.inf)
    kd = np.sort(others, axis=1)[:, min(k, n - 1) - 1]
    near = (others <= kd[:, None]) & np.isfinite(others)
    reach = np.maximum(kd[None, :], d)
    density = 1 / ((reach * near).sum(1) / near.sum(1) + 1e-10)
    return kd, (near * density[None, :]).sum(1) / near.sum(1) / density


def tables():
    rng = np.random.default_rng(5)
    clusters = np.concatenate([rng.normal(0, 1, (300, 2)), rng.normal(30, 0.01, (200, 2)), rng.uniform(-500, 500, (15, 2)), [[1e12, -1e9]]])
    hot = np.concatenate([np.zeros((200, 3)), rng.integers(0, 4, (300, 3)), rng.normal(2, 5, (100, 3))])
    return {"clusters": clusters, "hot": hot.astype(float), "line": np.sort(rng.exponential(1, 400))[:, None] ** 3,
            "few": rng.normal(size=(7, 2)), "equal": np.full((90, 2), 3.5), "one": np.array([[1.0, 2.0]]),
            "five": rng.normal(size=(150, 5))}


@pytest.mark.parametrize("name", sorted(tables()))
def test_factor_against_brute_force(spark, name, monkeypatch):
    monkeypatch.setattr(neighbours, "LEAF", 12)  # several levels also on small tables
    x = tables()[name]
    cols = [f"c{i}" for i in range(x.shape[1])]
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], ["id", *cols]).repartition(4)
    got = {r.id: r for r in local_outlier_factor(df, cols, ["id"], k=10, contamination=0.1).collect()}
    kd, lof = brute_factor(x, 10)
    assert len(got) == len(x)
    if name == "one":
        assert got[0].lof is None and got[0].outlier is None
        return
    assert np.allclose([got[i].k_distance for i in range(len(x))], kd, rtol=1e-12, atol=0)
    assert np.allclose([got[i].lof for i in range(len(x))], lof, rtol=1e-9)
    cut = np.quantile(lof, 0.9)
    clear = [i for i in range(len(x)) if abs(lof[i] / cut - 1) > 1e-9]
    assert all(got[i].outlier == int(lof[i] > cut) for i in clear)


def test_rows_without_a_finite_feature_take_no_part(spark):
    rows = [(i, float(i % 7), float(i)) for i in range(40)] + [(100, None, 1.0), (101, float("nan"), 1.0), (102, 1.0, float("inf"))]
    df = spark.createDataFrame(rows, "id int, a double, b double")
    got = local_outlier_factor(df, ["a", "b"], ["id"], k=5)
    assert sorted(r.id for r in got.collect()) == list(range(40))
    assert local_outlier_factor(df.where("id > 99"), ["a", "b"], ["id"]).collect() == []


def test_larger_table(spark):
    rng = np.random.default_rng(2)
    n = 6000
    df = spark.createDataFrame([(float(a), float(b)) for a, b in rng.normal(size=(n, 2))], ["a", "b"])
    rows = nearest(df, ["a", "b"], 5)
    assert rows.count() == n * 5


# ------------------------------------------------------------ mutual information
def psi(n):
    return -0.5772156649015329 + sum(1.0 / i for i in range(1, n))


def brute_mi(x, y, k=3):
    total, rows = 0.0, 0
    for v, c in zip(x, y):
        own = np.sort(np.abs(x[y == c] - v))[1:]
        if not len(own):
            continue
        rows += 1
        r = own[min(k, len(own)) - 1]
        inside = np.abs(x - v) < r * (1 - 1e-9) if r > 0 else x == v
        inside &= np.array([(y == b).sum() > 1 for b in y])
        kk = min(k, len(own)) if r > 0 else (x[y == c] == v).sum()
        total += psi(int(kk)) - psi(len(own) + 1) - psi(int(inside.sum()))
    return max(0.0, psi(rows) + total / rows)


def test_mutual_information_against_brute_force(spark):
    from pyspark.sql import functions as F

    from tabscope.operators.neighbours import mi_knn
    rng = np.random.default_rng(11)
    n = 500
    y = rng.choice(["a", "b", "c"], n, p=[0.6, 0.3, 0.1])
    y[0] = "alone"
    shift = np.array([{"a": 0.0, "b": 1.5, "c": 4.0}.get(c, 0.0) for c in y])
    cols = {"normal": rng.normal(size=n) + shift, "noise": rng.normal(size=n), "rounded": np.round(rng.normal(size=n) + shift, 1),
            "levels": rng.integers(0, 3, n) + shift, "large": 1.7e9 + rng.normal(size=n) + shift, "constant": np.ones(n)}
    df = spark.createDataFrame([(str(c), *[float(v[i]) for v in cols.values()]) for i, c in enumerate(y)], ["y", *cols]).repartition(3)
    got = {r.feature: r for r in mi_knn(df, list(cols), F.col("y")).collect()}
    for name, v in cols.items():
        assert got[name].mi == pytest.approx(brute_mi(v, y), abs=1e-9), name
    assert got["normal"].mi > 0.2 > got["noise"].mi and got["levels"].mi > 0.5 and got["constant"].mi < 1e-9
    assert sorted(r.rank for r in got.values()) == list(range(1, 7))


def test_mutual_information_of_known_size(spark):
    """Golden: two classes of uniform values that overlap on half of their range share half a bit of information."""
    from pyspark.sql import functions as F

    from tabscope.operators.neighbours import mi_knn
    rng = np.random.default_rng(12)
    n = 4000
    y = rng.integers(0, 2, n)
    x = rng.uniform(0, 2, n) + y
    df = spark.createDataFrame([(int(c), float(v)) for c, v in zip(y, x)], ["y", "x"])
    assert mi_knn(df, ["x"], F.col("y")).first().mi == pytest.approx(np.log(2) / 2, abs=0.03)


def test_mutual_information_of_nulls_and_nothing(spark):
    from pyspark.sql import functions as F

    from tabscope.operators.neighbours import mi_knn
    rows = [("a", None), ("a", 0.0), ("b", 1.0), ("b", float("nan")), ("b", 1.0), (None, 5.0), ("a", 0.0)]
    df = spark.createDataFrame(rows, "y string, x double")
    assert mi_knn(df, ["x"], F.col("y")).first().mi == pytest.approx(brute_mi(np.array([0, 0, 1, 1, 0.0]), np.array(list("aabba"))), abs=1e-12)
    assert mi_knn(df, ["x"], F.col("y"), fill=None).first().mi == pytest.approx(
        brute_mi(np.array([0, 1, 1, 0.0]), np.array(list("abba"))), abs=1e-12)
    assert mi_knn(df.where("y = 'c'"), ["x"], F.col("y")).collect() == []
