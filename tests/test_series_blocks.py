"""Ordered operators in blocks equal the same operators with one window over everything."""

import datetime

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tabscope.functions.special import adf_critical_values, adf_p_value
from tabscope.operators.series import acf, augmented_dickey_fuller, seasonal_decompose
from tabscope.plans.blocks import haloed


def series_of(spark, values):
    start = datetime.date(2020, 1, 1)
    rows = [(start + datetime.timedelta(days=i), None if v is None else float(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "day date, y double").repartition(5)


@pytest.mark.parametrize("blocks,before,after", [(2, 3, 0), (16, 4, 4), (40, 11, 0), (40, 0, 7), (60, 30, 30)])
def test_halo_gives_every_row_its_neighbours(spark, blocks, before, after):
    rows = [(g, float(x), i) for g, n in (("a", 57), ("b", 9), (None, 3)) for i, x in enumerate(np.random.default_rng(7).permutation(n) ** 2)]
    df = spark.createDataFrame(rows, "g string, x double, i int")
    got = haloed(df, "x", before, after, by=["g"], blocks=blocks)
    w, v = Window.partitionBy("g", "_block").orderBy("x"), Window.partitionBy("g").orderBy("x")

    def around(d, win):
        return d.withColumn("p", F.collect_list("i").over(win.rowsBetween(-before, -1))).withColumn(
            "q", F.collect_list("i").over(win.rowsBetween(1, after)) if after else F.array())
    seen = around(got, w).where("not _halo").select("g", "x", "i", "p", "q")
    want = around(df, v).select("g", "x", "i", "p", "q")
    assert sorted(map(str, seen.collect())) == sorted(map(str, want.collect()))
    assert got.where("not _halo").count() == len(rows)


def test_seasonal_and_acf_against_whole_arrays(spark):
    rng = np.random.default_rng(1)
    y = 0.3 * np.arange(200) + 5 * np.sin(np.arange(200) * 2 * np.pi / 7) + rng.normal(size=200)
    got = {r.day: r for r in seasonal_decompose(series_of(spark, y)).collect()}
    trend = np.convolve(y, np.ones(7) / 7, "valid")
    days = sorted(got)
    assert [got[d].trend is None for d in days] == [True] * 3 + [False] * 194 + [True] * 3
    assert np.allclose([got[d].trend for d in days[3:-3]], trend)
    phase = np.array([np.mean((y[3:-3] - trend)[(np.arange(3, 197) % 7) == p]) for p in range(7)])
    assert np.allclose([got[d].seasonal for d in days], (phase - phase.mean())[np.arange(200) % 7])
    c = y - y.mean()
    assert np.allclose([r.acf for r in sorted(acf(series_of(spark, y), 12).collect())],
                       [(c[k:] * c[:-k]).sum() / (c * c).sum() for k in range(1, 13)])


def plain_adf(y):
    """The test as textbooks write it, on one array."""
    n, dy = len(y), np.diff(y)
    most = min(n // 2 - 2, int(np.ceil(12 * (n / 100) ** 0.25)))

    def fit(lags, skip):
        t = np.arange(skip, len(dy))
        x = np.column_stack([np.ones(len(t)), y[t], *[dy[t - k] for k in range(1, lags + 1)]])
        b, *_ = np.linalg.lstsq(x, dy[t], rcond=None)
        e = dy[t] - x @ b
        return b, np.linalg.inv(x.T @ x), e @ e, len(t), x.shape[1]
    aic = []
    for lags in range(most + 1):
        _, _, sse, rows, k = fit(lags, most)
        aic.append(rows * np.log(sse / rows) + 2 * k)
    lags = int(np.argmin(aic))
    b, inv, sse, rows, k = fit(lags, lags)
    return rows, lags, b[1] / np.sqrt(sse / (rows - k) * inv[1, 1])


@pytest.mark.parametrize("kind", ["walk", "stationary", "lagged"])
def test_adf_against_least_squares(spark, kind):
    rng = np.random.default_rng(3)
    e = rng.normal(size=260)
    y = np.cumsum(e) + 1000 if kind == "walk" else np.zeros(260)
    if kind != "walk":
        a, b = (0.4, 0.0) if kind == "stationary" else (0.5, 0.45)
        for i in range(2, 260):
            y[i] = a * y[i - 1] + b * y[i - 2] + e[i]
    got = augmented_dickey_fuller(series_of(spark, y)).first()
    rows, lags, stat = plain_adf(y)
    assert (got.n, got.lags) == (rows, lags) and got.adf_stat == pytest.approx(stat, rel=1e-7)
    assert got.stationary_5pct == int(kind == "stationary") or kind == "lagged"
    assert (got.p_value < 0.05) == bool(got.stationary_5pct)


def test_adf_tables_and_short_series(spark):
    # golden: the asymptotic critical values have their own p-values
    for level, p in zip(adf_critical_values(10**9), (0.01, 0.05, 0.10), strict=True):
        assert adf_p_value(level) == pytest.approx(p, abs=6e-4)
    assert adf_p_value(3) == 1 and adf_p_value(-30) == 0 and adf_p_value(-1.6100001) == pytest.approx(adf_p_value(-1.6099999), abs=2e-3)
    for values in ([], [1, 2, 3], [5] * 50, [None] * 30):
        row = augmented_dickey_fuller(series_of(spark, values)).first()
        assert row.adf_stat is None and row.n == len([v for v in values if v is not None])
    assert augmented_dickey_fuller(series_of(spark, [None, *range(40), None, *range(30)])).first().n > 40


def test_qq_points_are_exact_quantiles(spark):
    from tabscope.operators.series import qq_points
    rng = np.random.default_rng(6)
    for x in (rng.normal(size=1000), np.round(rng.normal(size=700), 1), np.array([4.0]), np.array([1.0, 2.0]), np.zeros(50)):
        got = sorted(tuple(r) for r in qq_points(spark.createDataFrame([(float(v),) for v in x], "v double"), "v", 60).collect())
        pos = np.array([1 - 0.5 ** (1 / 60)] + [(i - 0.3175) / 60.365 for i in range(2, 60)] + [0.5 ** (1 / 60)])
        assert [r[0] for r in got] == list(range(60)) and np.allclose([r[1] for r in got], np.quantile(x, pos), atol=1e-12)
    assert qq_points(spark.createDataFrame([], "v double"), "v").collect() == []
