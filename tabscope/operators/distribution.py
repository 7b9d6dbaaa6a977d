"""Distribution diagnostics (SURVEY T17 Anderson-Darling, T18 fitting, T28 bootstrap MI,
T39 feature clusters by Ward linkage, T40 mode count).

Full-data versions: every statistic is computed on (feature, distinct value,
count) cells with distributed running sums; CDFs that Spark lacks (normal,
gamma) are Arrow-batched pandas UDFs applied to those cells only.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabscope.config import DEFAULT, Config
from tabscope.functions.exprs import col
from tabscope.functions.special import (beta_cdf_udf, digamma_array, gamma_cdf_udf, ks_one_pvalue_udf, normal_cdf_udf,
                                        trigamma_array)
from tabscope.plans.blocks import written
from tabscope.plans.frames import per_feature, running_sum, scalar_row


def _cells(df: DataFrame, features: Sequence[str]) -> DataFrame:
    lv = df.select(*[col(f).cast("double").alias(f) for f in features]).unpivot([], list(features), "feature", "x")
    return lv.where(F.col("x").isNotNull() & ~F.isnan("x")).groupBy("feature", "x").agg(F.count(F.lit(1)).alias("k"))


def normality_ad(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Anderson-Darling A^2 against a normal with the sample mean / std (ddof 1).

    For a distinct value with count k after r smaller values the rank sums
    collapse to k(2r+k) and k(2n-2r-k), so only value cells are needed."""
    mom = per_feature(df, features, {"n": lambda c: F.count(c), "m": lambda c: F.avg(c.cast("double")),
                                     "s": lambda c: F.stddev_samp(c.cast("double"))})
    c = running_sum(_cells(df, features), ["x"], "k", by=["feature"], out="cum")
    c = c.join(F.broadcast(mom), "feature")  # one row per feature
    z = F.try_divide(F.col("x") - F.col("m"), F.col("s"))
    cdf = F.least(F.greatest(normal_cdf_udf(z), F.lit(1e-300)), F.lit(1 - 1e-16))
    r = F.col("cum") - F.col("k")
    term = F.col("k") * (2 * r + F.col("k")) * F.log(cdf) + F.col("k") * (2 * F.col("n") - 2 * r - F.col("k")) * F.log(1 - cdf)
    a = c.groupBy("feature").agg(F.first("n").alias("n"), F.sum(term).alias("t"))
    a2 = -F.col("n") - F.col("t") / F.col("n")
    # Fixed value: 5 % critical value of the normal-case A^2 with Stephens' small-sample factor
    crit = 0.752 / (1 + 0.75 / F.col("n") + 2.25 / (F.col("n") * F.col("n")))
    return a.select("feature", "n", a2.alias("ad_stat"), crit.alias("critical_5pct"), (a2 < crit).cast("int").alias("normal"))


#: Newton steps at most; all fits here converge quadratically.
STEPS = 60
FITS = ("norm", "lognorm", "expon", "gamma", "weibull_min", "beta")


def _gamma_fit(mean: float, log_mean: float) -> tuple[float, float] | None:
    """Shape and scale at the maximum of the likelihood, from the mean and the mean logarithm."""
    s = math.log(mean) - log_mean
    if not s > 1e-14:
        return None
    k = (3 - s + math.sqrt((s - 3) ** 2 + 24 * s)) / (12 * s)
    for _ in range(STEPS):
        step = float((math.log(k) - digamma_array(k) - s) / (1 / k - trigamma_array(k)))
        k = k - step if step < k else k / 2
        if abs(step) < 1e-13 * k:
            break
    return k, mean / k


def _beta_fit(mean: float, var: float, log_low: float, log_high: float) -> tuple[float, float] | None:
    """Both shapes at the maximum of the likelihood, from the mean logarithms of x and of 1 - x."""
    if not var > 0:
        return None
    t = max(mean * (1 - mean) / var - 1, 1e-3)
    p = np.array([mean * t, (1 - mean) * t])
    for _ in range(STEPS):
        both = trigamma_array(p.sum())
        g = digamma_array(p) - digamma_array(p.sum()) - np.array([log_low, log_high])
        step = np.linalg.solve(np.diag(trigamma_array(p)) - both, g)
        while np.any(p - step <= 0):
            step = step / 2
        p = p - step
        if np.all(np.abs(step) < 1e-13 * p):
            break
    return float(p[0]), float(p[1])


def _weibull_fits(cells: DataFrame, start: dict[str, tuple[float, float, float]]) -> dict[str, tuple[float, float]]:
    """Shape and scale per feature; ``start``: largest value, mean and deviation of the logarithms.  Each Newton step of
    all features is one aggregate over the value cells."""
    shape = {f: 1.2825498301618641 / s for f, (_, _, s) in start.items() if s > 1e-12}  # pi / sqrt(6): exact for a Weibull
    scale, todo = {}, set(shape)
    for _ in range(STEPS):
        if not todo:
            break
        part = None
        for f in sorted(todo):
            z = F.log(F.col("x") / start[f][0])
            part = (F.when if part is None else part.when)(F.col("feature") == f, F.struct(
                z.alias("z"), (F.col("k") * F.exp(z * shape[f])).alias("w")))
        x = cells.where(F.col("feature").isin(sorted(todo))).select("feature", "k", part.alias("e"))
        w, z = F.col("e.w"), F.col("e.z")
        for r in x.groupBy("feature").agg(F.sum("k").alias("n"), F.sum(w).alias("a"), F.sum(w * z).alias("b"), F.sum(w * z * z).alias("c")).collect():
            top, log_mean, _ = start[r.feature]
            k = shape[r.feature]
            scale[r.feature] = top * (r.a / r.n) ** (1 / k)
            value = r.b / r.a - 1 / k - (log_mean - math.log(top))
            step = value / ((r.c * r.a - r.b * r.b) / (r.a * r.a) + 1 / (k * k))
            if abs(step) < 1e-12 * k:
                todo.discard(r.feature)
            else:
                shape[r.feature] = k - step if step < k else k / 2
    return {f: (shape[f], scale[f]) for f in scale}


def fitted_parameters(df: DataFrame, features: Sequence[str], cells: DataFrame | None = None) -> DataFrame:
    """``(feature, dist, shape, shape2, loc, scale)``, maximum-likelihood fits of every distribution that admits the
    values of a feature.

    norm; lognorm, gamma and weibull_min of positive values (loc 0); expon from the smallest value on; beta on (0, 1), or
    on the range of the values widened by half of its n-th part at both ends if it lies elsewhere.  Sums over value cells
    are aggregates; the Newton steps for gamma and beta need only such sums, those for weibull_min take an aggregate
    each.  A feature without deviation has norm alone."""
    cells = _cells(df, features) if cells is None else cells
    x, k = F.col("x"), F.col("k")

    def mean(c):
        return F.sum(k * c) / F.sum("k")
    one = cells.groupBy("feature").agg(
        F.sum("k").alias("n"), mean(x).alias("m"), F.min("x").alias("lo"), F.max("x").alias("hi"),
        F.sum(F.when(x > 0, k * F.log(x))).alias("sl"))
    one = {r.feature: r for r in one.collect()}  # a row per feature
    rows = []
    if one:
        def of(values):
            return F.create_map(*[v for f in one for v in (F.lit(f), F.lit(float(values(one[f]))))])[F.col("feature")]
        unit = {f: 0 < r.lo and r.hi < 1 for f, r in one.items()}
        half = {f: 0.0 if unit[f] else (r.hi - r.lo) / (2 * r.n) for f, r in one.items()}
        low = of(lambda r: 0.0 if unit[r.feature] else r.lo - half[r.feature])
        width = of(lambda r: 1.0 if unit[r.feature] else r.hi - r.lo + 2 * half[r.feature])
        y = F.try_divide(x - low, width)
        two = cells.groupBy("feature").agg(
            mean((x - of(lambda r: r.m)) ** 2).alias("v"),
            mean(F.when(x > 0, F.log(x) - of(lambda r: (r.sl or 0.0) / r.n)) ** 2).alias("lv"),
            mean(y).alias("ym"), F.sum(F.when(y > 0, k * F.log(y))).alias("y0"), F.sum(F.when(y < 1, k * F.log1p(-y))).alias("y1"))
        two = {r.feature: r for r in two.collect()}
        start = {f: (r.hi, r.sl / r.n, math.sqrt(two[f].lv or 0.0)) for f, r in one.items() if r.lo > 0}
        weibull = _weibull_fits(cells, start)
        for f, r in one.items():
            v, spread = two[f].v, r.hi > r.lo
            rows.append((f, "norm", None, None, r.m, math.sqrt(v)))
            if not spread:
                continue
            rows.append((f, "expon", None, None, r.lo, r.m - r.lo))
            if r.lo > 0:
                rows.append((f, "lognorm", math.sqrt(two[f].lv), None, 0.0, math.exp(r.sl / r.n)))
                fit = _gamma_fit(r.m, r.sl / r.n)
                if fit:
                    rows.append((f, "gamma", fit[0], None, 0.0, fit[1]))
                if f in weibull:
                    rows.append((f, "weibull_min", weibull[f][0], None, 0.0, weibull[f][1]))
            w = 1.0 if unit[f] else r.hi - r.lo + 2 * half[f]
            fit = _beta_fit(two[f].ym, v / (w * w), two[f].y0 / r.n, two[f].y1 / r.n)
            if fit:
                rows.append((f, "beta", *fit, 0.0 if unit[f] else r.lo - half[f], w))
    return df.sparkSession.createDataFrame(rows, "feature string, dist string, shape double, shape2 double, loc double, scale double")


def distribution_fit(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Kolmogorov-Smirnov distance of each maximum-likelihood fit (null where the values don't admit it), the best
    one, its distance and its asymptotic p-value.  The best fit has the smallest distance (the reference ranks by p-value,
    which is monotone in it for fixed n)."""
    cells = written(_cells(df, features), "cells")
    fits = fitted_parameters(df, features, cells)
    c = running_sum(cells, ["x"], "k", by=["feature"], out="cum", total="n").join(F.broadcast(fits), "feature")  # six rows a feature
    z = F.try_divide(F.col("x") - F.col("loc"), F.col("scale"))
    dist = F.col("dist")
    one = F.when((dist == "lognorm") & (z > 0), F.log(z) / F.col("shape")).when(dist == "norm", z)
    cdf = F.when(dist.isin("norm", "lognorm"), normal_cdf_udf(one)).when(dist == "expon", 1 - F.exp(-z)).when(
        dist == "weibull_min", 1 - F.exp(-F.pow(z, F.col("shape")))).when(
        dist == "gamma", gamma_cdf_udf(F.when(dist == "gamma", z), F.col("shape"), F.lit(1.0))).when(
        dist == "beta", beta_cdf_udf(F.when(dist == "beta", z), F.col("shape"), F.col("shape2")))
    c = c.withColumn("v", cdf)
    d = c.groupBy("feature", "dist").agg(F.max("n").alias("n"), F.max(F.greatest(
        F.abs(F.col("cum") / F.col("n") - F.col("v")), F.abs((F.col("cum") - F.col("k")) / F.col("n") - F.col("v")))).alias("d"))
    g = d.groupBy("feature").agg(*[F.max(F.when(dist == k, F.col("d"))).alias(k) for k in FITS],
                                 F.min(F.struct(F.col("d").isNull().alias("u"), "d", "dist")).alias("best"), F.max("n").alias("n"))
    return g.select("feature", *FITS, F.col("best.dist").alias("best_fit"), F.col("best.d").alias("ks_d"),
                    ks_one_pvalue_udf(F.col("best.d"), F.col("n").cast("double")).alias("ks_p"))


def modes(df: DataFrame, features: Sequence[str], grid: int = 512, min_height: float = 0.10) -> DataFrame:
    """Number of KDE peaks (height >= 10 % of the maximum): 512-bin histogram per feature,
    Gaussian smoothing with Scott's bandwidth over neighbouring bins, local maxima counted."""
    st = scalar_row(df.agg(*[x for i, f in enumerate(features) for x in (
        F.min(col(f).cast("double")).alias(f"lo{i}"), F.max(col(f).cast("double")).alias(f"hi{i}"),
        F.stddev_samp(col(f).cast("double")).alias(f"s{i}"), F.count(col(f)).alias(f"n{i}"))]))
    x = df.withColumn("_st", st)
    parts = []
    for i, f in enumerate(features):
        lo, hi = F.col("_st").getField(f"lo{i}"), F.col("_st").getField(f"hi{i}")
        b = F.when(hi > lo, F.least(F.floor(F.try_divide((col(f).cast("double") - lo) * grid, hi - lo)), F.lit(grid - 1))).when(
            col(f).isNotNull(), 0).cast("int")
        bw = F.coalesce(F.try_divide(1.06 * F.col("_st").getField(f"s{i}") * F.pow(F.col("_st").getField(f"n{i}").cast("double"), -0.2),
                                     (hi - lo) / grid), F.lit(0.0))
        parts.append(F.struct(F.lit(f).alias("feature"), b.alias("bin"), bw.alias("bw")))
    h = x.select(F.inline(F.array(*parts))).where(F.col("bin").isNotNull()).groupBy("feature", "bin").agg(
        F.count(F.lit(1)).alias("n"), F.first("bw").alias("bw"))
    reach = 3 * grid  # offsets are limited to 3 bandwidths below
    k = F.least(F.ceil(3 * F.col("bw")), F.lit(reach)).cast("int")
    spread = h.select("feature", "n", "bw", "bin", F.explode(F.sequence(-k, k)).alias("d")) \
        .withColumn("g", F.col("bin") + F.col("d")).where((F.col("g") >= 0) & (F.col("g") < grid))
    dens = spread.groupBy("feature", "g").agg(
        F.sum(F.col("n") * F.exp(-0.5 * (F.col("d") / F.greatest(F.col("bw"), F.lit(1e-9))) ** 2)).alias("y"))
    w = Window.partitionBy("feature").orderBy("g")  # <= 512 rows per feature
    pk = dens.select("feature", "y", F.lag("y").over(w).alias("yl"), F.lead("y").over(w).alias("yr"),
                     F.max("y").over(Window.partitionBy("feature")).alias("ymax"))
    is_peak = ((F.col("y") > F.coalesce("yl", F.lit(-1.0))) & (F.col("y") >= F.coalesce("yr", F.lit(-1.0)))
               & (F.col("y") >= min_height * F.col("ymax")))
    return pk.groupBy("feature").agg(F.count_if(is_peak).alias("n_modes")).withColumn(
        "multimodal", (F.col("n_modes") > 1).cast("int"))


def ward_merges(dist: np.ndarray) -> list[tuple[int, int, float]]:
    """Ward linkage of p points from their distances, by nearest-neighbour chains and Lance-Williams updates: merges
    (cluster, cluster, height) with clusters named by their smallest point, by height."""
    p = len(dist)
    d, size, alive, chain, out = dist.astype(float).copy(), np.ones(p), np.ones(p, bool), [], []
    np.fill_diagonal(d, np.inf)
    while len(out) < p - 1:
        if not chain:
            chain = [int(np.flatnonzero(alive)[0])]
        a = chain[-1]
        row = np.where(alive, d[a], np.inf)
        b = int(np.argmin(row))
        if len(chain) > 1 and row[chain[-2]] <= row[b]:
            b = chain[-2]
            chain = chain[:-2]
            i, j = sorted((a, b))
            out.append((i, j, float(d[i, j])))
            rest = alive.copy()
            rest[[i, j]] = False
            n = size[rest]
            new = np.sqrt(((size[i] + n) * d[i, rest] ** 2 + (size[j] + n) * d[j, rest] ** 2 - n * d[i, j] ** 2) / (size[i] + size[j] + n))
            d[i, rest] = d[rest, i] = new
            size[i] += size[j]
            alive[j] = False
        else:
            chain.append(b)
    return sorted(out, key=lambda m: m[2])


def feature_clusters(df: DataFrame, features: Sequence[str], n_clusters: int | None = None) -> DataFrame:
    """Ward clusters on distance 1 - |r| (p // 3 of them); the correlation matrix is one Spark aggregate, the p x p
    linkage runs on the driver (p = number of features)."""
    from tabscope.functions.exprs import pearson
    p = len(features)
    pairs = [(i, j) for i in range(p) for j in range(i + 1, p)]
    dist = np.zeros((p, p))
    if pairs:
        row = df.agg(*[pearson(col(features[i]), col(features[j])).alias(f"r{k}") for k, (i, j) in enumerate(pairs)]).first()
        for k, (i, j) in enumerate(pairs):
            r = row[f"r{k}"]
            dist[i, j] = dist[j, i] = 1.0 - abs(r if r is not None else 0.0)
    first = list(range(p))
    for a, b, _ in ward_merges(dist)[:p - (n_clusters or max(1, p // 3))]:
        one, two = first[a], first[b]
        first = [min(one, two) if c in (one, two) else c for c in first]
    number = {c: i for i, c in enumerate(sorted(set(first)))}
    return df.sparkSession.createDataFrame([(f, number[c]) for f, c in zip(features, first, strict=True)], "feature string, cluster int")


def mi_stability(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], y: Column, rounds: int = 30,
                 bins: int = 10, seed: int = 42, cfg: Config = DEFAULT) -> DataFrame:
    """Bootstrap stability of the binned MI.  Resampling rows with replacement is replaced by
    Poisson(n) resampling of the contingency cells (no row copies): cells x rounds rows only."""
    from tabscope.operators.association import binned_long
    x = binned_long(df, numeric, categorical, y.cast("string"), bins, cfg)
    cells = x.groupBy("feature", "bin", "_y").agg(F.count(F.lit(1)).alias("n"))
    reps = cells.select("*", F.explode(F.sequence(F.lit(0), F.lit(rounds - 1))).alias("rep"))

    def draw(it):
        for pdf in it:
            keys = pd.util.hash_pandas_object(pdf[["feature", "bin", "_y", "rep"]], index=False).to_numpy()
            out = np.empty(len(pdf), dtype=np.int64)
            for i, (h, lam) in enumerate(zip(keys, pdf["n"].to_numpy())):
                out[i] = np.random.default_rng([seed, int(h) & 0x7FFFFFFF]).poisson(lam)
            pdf = pdf.assign(nb=out)
            yield pdf[["feature", "bin", "_y", "rep", "nb"]]
    rs = reps.mapInPandas(draw, "feature string, bin string, _y string, rep int, nb long").where(F.col("nb") > 0)
    wf, wb, wy = (Window.partitionBy("feature", "rep"), Window.partitionBy("feature", "rep", "bin"),
                  Window.partitionBy("feature", "rep", "_y"))
    c = rs.select("feature", "rep", "nb", F.sum("nb").over(wf).alias("tot"), F.sum("nb").over(wb).alias("nbin"),
                  F.sum("nb").over(wy).alias("ny"))
    mi = c.groupBy("feature", "rep").agg(
        F.sum(F.col("nb") / F.col("tot") * F.log(F.col("nb") * F.col("tot") / (F.col("nbin") * F.col("ny")))).alias("mi"))
    out = mi.groupBy("feature").agg(F.avg("mi").alias("mi_mean"), F.stddev_samp("mi").alias("mi_std"))
    cv = F.try_divide(F.col("mi_std"), F.col("mi_mean"))
    return out.select("feature", "mi_mean", "mi_std", cv.alias("cv"), (cv < 0.5).cast("int").alias("stable"))
