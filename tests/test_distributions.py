"""Maximum-likelihood fits, their CDFs and Ward linkage against textbook versions."""

import math

import numpy as np
import pytest

from tabscope.functions.special import (beta_cdf_array, betainc, digamma_array, gamma_cdf_array, gammainc_upper, lgamma_array,
                                        trigamma_array)
from tabscope.operators.distribution import distribution_fit, feature_clusters, fitted_parameters, ward_merges


def test_special_functions():
    x = np.array([1e-3, 0.1, 0.5, 1, 2, 3.7, 12, 150, 1e5])
    assert np.allclose(lgamma_array(x), [math.lgamma(v) for v in x], rtol=1e-12, atol=1e-12)
    h = 1e-5 * x
    assert np.allclose(digamma_array(x), (lgamma_array(x + h) - lgamma_array(x - h)) / (2 * h), rtol=1e-6)
    assert np.allclose(trigamma_array(x), (digamma_array(x + h) - digamma_array(x - h)) / (2 * h), rtol=1e-6)
    assert digamma_array(1.0) == pytest.approx(-0.5772156649015329, abs=1e-14) and trigamma_array(1.0) == pytest.approx(math.pi ** 2 / 6)
    rng = np.random.default_rng(0)
    a, b, z = rng.uniform(0.05, 60, 400), rng.uniform(0.05, 60, 400), rng.uniform(-1, 90, 400)
    assert np.allclose(gamma_cdf_array(z, a, 1.0), [1 - gammainc_upper(p, q) for p, q in zip(a, z)], atol=1e-11)
    u = rng.uniform(-0.1, 1.1, 400)
    assert np.allclose(beta_cdf_array(u, a, b), [betainc(p, q, w) for p, q, w in zip(a, b, u)], atol=1e-11)
    assert np.isnan(gamma_cdf_array([1.0], [-1.0], [1.0]))[0] and np.isnan(beta_cdf_array([0.5], [0.0], [1.0]))[0]


def bisect(fn, lo, hi):
    for _ in range(300):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if fn(lo) * fn(mid) > 0 else (lo, mid)
    return (lo + hi) / 2


def frame(spark, columns):
    n = len(next(iter(columns.values())))
    return spark.createDataFrame([tuple(float(v[i]) for v in columns.values()) for i in range(n)], list(columns)).repartition(3)


def test_fits_on_planted_samples(spark):
    rng = np.random.default_rng(9)
    n = 3000
    data = {"norm": rng.normal(50, 4, n), "lognorm": rng.lognormal(1, 0.8, n), "expon": 7 + rng.exponential(3, n), "gamma": rng.gamma(3.2, 2.5, n),
            "weibull_min": 40 * rng.weibull(2.7, n), "beta": rng.beta(0.7, 2.2, n)}
    df = frame(spark, data)
    fits = {(r.feature, r.dist): r for r in fitted_parameters(df, list(data)).collect()}
    x = data["gamma"]
    s = math.log(x.mean()) - np.log(x).mean()
    shape = bisect(lambda k: math.log(k) - float(digamma_array(k)) - s, 1e-3, 1e3)
    got = fits["gamma", "gamma"]
    assert (got.shape, got.scale) == pytest.approx((shape, x.mean() / shape), rel=1e-6)
    x = data["weibull_min"]
    shape = bisect(lambda k: (x ** k * np.log(x)).sum() / (x ** k).sum() - 1 / k - np.log(x).mean(), 0.05, 50)
    got = fits["weibull_min", "weibull_min"]
    assert (got.shape, got.scale) == pytest.approx((shape, (x ** shape).mean() ** (1 / shape)), rel=1e-6)
    x, got = data["beta"], fits["beta", "beta"]

    def gradient(a, b):
        return (digamma_array(a) - digamma_array(a + b) - np.log(x).mean(), digamma_array(b) - digamma_array(a + b) - np.log1p(-x).mean())
    assert np.allclose(gradient(got.shape, got.shape2), 0, atol=1e-9) and (got.loc, got.scale) == (0, 1)
    assert (got.shape, got.shape2) == pytest.approx((0.7, 2.2), rel=0.1)
    x, got = data["expon"], fits["expon", "expon"]
    assert (got.loc, got.scale) == pytest.approx((x.min(), x.mean() - x.min()))
    best = {r.feature: r for r in distribution_fit(df, list(data)).collect()}
    assert {f: r.best_fit for f, r in best.items()} == {f: f for f in data}
    assert all(r.ks_p > 0.01 and r.ks_d == min(v for v in (r[k] for k in data) if v is not None) for r in best.values())
    r = best["weibull_min"]  # the distance itself
    x = np.sort(data["weibull_min"])
    f = fits["weibull_min", "weibull_min"]
    cdf = 1 - np.exp(-(x / f.scale) ** f.shape)
    assert r.weibull_min == pytest.approx(max((np.arange(1, n + 1) / n - cdf).max(), (cdf - np.arange(n) / n).max()), abs=1e-9)


def test_beta_beyond_the_unit_range_and_odd_columns(spark):
    rng = np.random.default_rng(4)
    df = frame(spark, {"wide": 100 + 50 * rng.beta(2, 3, 800), "constant": np.full(800, 2.5), "signs": rng.normal(size=800), "zeros": np.zeros(800)})
    fits = {(r.feature, r.dist): r for r in fitted_parameters(df, ["wide", "constant", "signs", "zeros"]).collect()}
    r = fits["wide", "beta"]
    assert r.loc < 101.5 and r.loc + r.scale > 146 and 1.2 < r.shape < 2.6
    assert {d for f, d in fits if f == "signs"} == {"norm", "expon", "beta"}
    assert {d for f, d in fits if f in ("constant", "zeros")} == {"norm"}
    got = {r.feature: r for r in distribution_fit(df, ["wide", "constant", "signs", "zeros"]).collect()}
    assert got["wide"].best_fit == "beta" and got["signs"].best_fit == "norm" and got["signs"].gamma is None
    assert fitted_parameters(df.where("signs is null"), ["signs"]).collect() == []
    assert distribution_fit(df.where("signs is null"), ["signs"]).collect() == []


def brute_ward(dist):
    """Greedy merges of the closest pair, updated by the same recurrence."""
    groups, d, out = {i: 1 for i in range(len(dist))}, {(i, j): dist[i, j] for i in range(len(dist)) for j in range(i)}, []
    while len(groups) > 1:
        (a, b), h = min(d.items(), key=lambda x: x[1])
        i, j = sorted((a, b))
        out.append((i, j, h))
        for k in groups:
            if k not in (i, j):
                dik, djk = d[max(i, k), min(i, k)], d[max(j, k), min(j, k)]
                n = groups[k]
                d[max(i, k), min(i, k)] = math.sqrt(((groups[i] + n) * dik ** 2 + (groups[j] + n) * djk ** 2 - n * h ** 2) / (groups[i] + groups[j] + n))
        groups[i] += groups.pop(j)
        d = {p: v for p, v in d.items() if j not in p}
    return out


def test_ward(spark):
    rng = np.random.default_rng(8)
    for p in (1, 2, 3, 9, 25):
        x = rng.normal(size=(p, 4))
        dist = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
        got, want = ward_merges(dist), brute_ward(dist)
        assert [m[:2] for m in got] == [m[:2] for m in want] and np.allclose([m[2] for m in got], [m[2] for m in want])
    base = rng.normal(size=(3, 400))
    cols = {f"{g}{i}": base[k] * (1 if i < 2 else -3) + rng.normal(size=400) * 0.1 for k, g in enumerate("abc") for i in range(3)}
    got = {r.feature: r.cluster for r in feature_clusters(frame(spark, cols), list(cols)).collect()}
    assert got == {f: "abc".index(f[0]) for f in cols}
    assert [r.cluster for r in feature_clusters(frame(spark, {"a": base[0]}), ["a"]).collect()] == [0]
