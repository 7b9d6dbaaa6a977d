"""Chart data, window operators (2.8) and time-series diagnostics (2.6 T44-T48).

Time-series operators work on a series that Spark first aggregates to one row per
period (day).  Ordered windows run in blocks that carry the rows they need of the
blocks next to them; no task holds a whole series.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabscope.config import DEFAULT, Config
from tabscope.functions.exprs import col, equal_width_bin
from tabscope.functions.special import adf_critical_values, adf_p_value
from tabscope.plans.blocks import haloed, written
from tabscope.plans.frames import bounded, per_feature, quantiles, running_sum, scalar_row


# ------------------------------------------------------------ chart data
def histogram(df: DataFrame, features: Sequence[str], target: str | None = None, bins: int = 40) -> DataFrame:
    """V1: equal-width histogram per feature (and class): bin index, edges, count.

    Bin indices are computed in one projection, unpivoted, counted; edges are
    derived after the aggregation from the same min/max scalar."""
    s = scalar_row(df.agg(*[x for i, f in enumerate(features) for x in (F.min(col(f).cast("double")).alias(f"lo{i}"),
                                                                         F.max(col(f).cast("double")).alias(f"hi{i}"))]))
    x = df.withColumn("_mm", s)
    cols = []
    for i, f in enumerate(features):
        lo, hi = F.col("_mm").getField(f"lo{i}"), F.col("_mm").getField(f"hi{i}")
        cols.append(equal_width_bin(col(f), lo, hi, bins).alias(f))
    cls = [col(target).cast("string").alias("class")] if target else []
    ids = ["class"] if target else []
    long = x.select(*cls, *cols).unpivot(ids, list(features), "feature", "bin").where(F.col("bin").isNotNull())
    g = long.groupBy(*ids, "feature", "bin").agg(F.count(F.lit(1)).alias("n"))
    idx = F.create_map(*[v for i, f in enumerate(features) for v in (F.lit(f), F.lit(i))])
    g = g.withColumn("_mm", s).withColumn("_i", idx[F.col("feature")])
    lo = F.element_at(F.array(*[F.col("_mm").getField(f"lo{i}") for i in range(len(features))]), F.col("_i") + 1)
    hi = F.element_at(F.array(*[F.col("_mm").getField(f"hi{i}") for i in range(len(features))]), F.col("_i") + 1)
    w = (hi - lo) / bins
    return g.select(*ids, "feature", "bin", (lo + F.col("bin") * w).alias("bin_lo"),
                    (lo + (F.col("bin") + 1) * w).alias("bin_hi"), "n")


def box_stats(df: DataFrame, features: Sequence[str], target: str, cfg: Config = DEFAULT) -> DataFrame:
    """V2: quartiles, whiskers (furthest points within 1.5 IQR) and flier count per class."""
    t = df.withColumn("_cls", col(target).cast("string")).where(F.col("_cls").isNotNull())
    from tabscope.plans.frames import quantile_long
    ql = quantile_long(t, features, [0.25, 0.5, 0.75], by=["_cls"], cfg=cfg)
    q = ql.groupBy("_cls").agg(*[F.max(F.when(F.col("feature") == f, F.col("q"))).alias(f"q{i}") for i, f in enumerate(features)])
    # one row per class: bounded by the number of classes
    j = t.join(F.broadcast(q), "_cls")

    def make(i, f):
        x, qq = col(f).cast("double"), F.col(f"q{i}")
        lo, hi = qq[0] - 1.5 * (qq[2] - qq[0]), qq[2] + 1.5 * (qq[2] - qq[0])
        inside = (x >= lo) & (x <= hi)
        return {"q1": F.first(qq[0]), "median": F.first(qq[1]), "q3": F.first(qq[2]),
                "whisker_lo": F.min(F.when(inside, x)), "whisker_hi": F.max(F.when(inside, x)),
                "n_fliers": F.count_if(~inside)}
    return per_feature(j, features, make, by=["_cls"]).withColumnRenamed("_cls", "class")


def ecdf(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """V3: ECDF points (distinct value, cumulative share)."""
    lv = df.select(*[col(f).cast("double").alias(f) for f in features]).unpivot([], list(features), "feature", "value")
    cnt = lv.where(F.col("value").isNotNull()).groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))
    r = running_sum(cnt, ["value"], "n", by=["feature"], out="_cum", total="_tot")
    return r.select("feature", "value", "n", (F.col("_cum") / F.col("_tot")).alias("ecdf"))


def qq_points(df: DataFrame, feature: str, n_points: int = 200, cfg: Config = DEFAULT) -> DataFrame:
    """V4: sample quantiles at Filliben plotting positions vs standard-normal quantiles.

    Exact quantiles come from prefix sums over value cells; each cell works out which plotting positions fall on its
    ranks (a short stretch around the inverse of the position formula), so no array of all positions is tested per cell."""
    from tabscope.functions.special import normal_ppf
    m = n_points
    pos = [1 - 0.5 ** (1 / m)] + [(i - 0.3175) / (m + 0.365) for i in range(2, m)] + [0.5 ** (1 / m)]
    theo = [float(v) for v in normal_ppf(pos)]
    at = F.array(*[F.lit(p) for p in pos])
    if cfg.quantile_mode == "approx":
        out = df.agg(quantiles(col(feature), pos, cfg).alias("q")).select(F.posexplode("q").alias("i", "sample_q"))
    else:
        x = df.select(col(feature).cast("double").alias("x")).where(F.col("x").isNotNull() & ~F.isnan("x"))
        c = running_sum(x.groupBy("x").agg(F.count(F.lit(1)).alias("k")), ["x"], "k", out="cum", total="n")
        last = F.greatest(F.col("n") - 1, F.lit(1))
        low = F.floor((F.col("cum") - F.col("k") - 1) / last * (m + 0.365) + 0.3175) - 2
        high = F.ceil(F.col("cum") / last * (m + 0.365) + 0.3175) + 1
        low, high = F.greatest(low, F.lit(0)), F.least(high, F.lit(m - 1))
        h = (F.col("n") - 1) * F.get(at, F.col("i").cast("int"))
        c = c.where(low <= high).select("x", "k", "cum", "n", F.explode(F.sequence(low, high)).alias("i"))
        first, held = F.col("cum") - F.col("k"), []
        for rank in (F.floor(h), F.ceil(h)):
            held.append((rank >= first) & (rank < F.col("cum")))
        g = c.where(held[0] | held[1]).groupBy("i").agg(
            F.max(F.when(held[0], F.col("x"))).alias("a"), F.max(F.when(held[1], F.col("x"))).alias("b"), F.max("n").alias("n"))
        out = g.select(F.col("i").cast("int").alias("i"), (F.col("a") + (F.col("b") - F.col("a")) * (h - F.floor(h))).alias("sample_q"))
    return out.withColumn("theoretical_q", F.array(*[F.lit(v) for v in theo])[F.col("i")])


def scatter_sample(df: DataFrame, cols: Sequence[str], key_cols: Sequence[str], n: int = 2000, seed: int = 42) -> DataFrame:
    """V6/V7: hashed sample of rows (top-n by seeded hash: no global sort) projected to the plotted columns."""
    return df.select(*[col(c) for c in dict.fromkeys([*key_cols, *cols])]) \
        .orderBy(F.xxhash64(F.lit(seed), *[col(k) for k in key_cols])).limit(n)


def null_matrix_sample(df: DataFrame, cols: Sequence[str], key_cols: Sequence[str], n: int = 500, seed: int = 42) -> DataFrame:
    s = scatter_sample(df, cols, key_cols, n, seed)
    return s.select(*[col(k) for k in key_cols], *[col(c).isNull().cast("int").alias(c) for c in cols if c not in key_cols])


def density_overlay(train: DataFrame, test: DataFrame, feature: str, grid: int = 128, bandwidth_bins: float = 2.0) -> DataFrame:
    """V5: density of train and test on a shared grid: fine histogram per side, then a Gaussian
    kernel over neighbouring bins (the convolution runs on #grid rows)."""
    both = train.select(col(feature).cast("double").alias("x"), F.lit("train").alias("side")).unionByName(
        test.select(col(feature).cast("double").alias("x"), F.lit("test").alias("side")))
    mm = scalar_row(both.agg(F.min("x").alias("lo"), F.max("x").alias("hi")))
    b = both.withColumn("_mm", mm).select("side", F.when(F.col("_mm.hi") > F.col("_mm.lo"), F.least(
        F.floor(F.try_divide((F.col("x") - F.col("_mm.lo")) * grid, F.col("_mm.hi") - F.col("_mm.lo"))), F.lit(grid - 1)))
        .when(F.col("x").isNotNull(), 0).cast("int").alias("bin"), F.col("_mm.lo").alias("lo"), F.col("_mm.hi").alias("hi"))
    h = b.where(F.col("bin").isNotNull()).groupBy("side", "bin").agg(F.count(F.lit(1)).alias("n"), F.first("lo").alias("lo"),
                                                                      F.first("hi").alias("hi"))
    k = int(3 * bandwidth_bins)
    offs = F.explode(F.sequence(F.lit(-k), F.lit(k))).alias("d")
    spread = h.select("side", "n", "lo", "hi", (F.col("bin")).alias("src"), offs).withColumn("bin", F.col("src") + F.col("d")) \
        .where((F.col("bin") >= 0) & (F.col("bin") < grid))
    wgt = F.exp(-0.5 * (F.col("d") / bandwidth_bins) ** 2)
    dens = spread.groupBy("side", "bin").agg(F.sum(F.col("n") * wgt).alias("mass"), F.first("lo").alias("lo"),
                                             F.first("hi").alias("hi"))
    tot = Window.partitionBy("side")
    width = (F.col("hi") - F.col("lo")) / grid
    return dens.select("side", "bin", (F.col("lo") + (F.col("bin") + 0.5) * width).alias("x"),
                       F.try_divide(F.col("mass"), F.sum("mass").over(tot) * width).alias("density"))


# ------------------------------------------------------------ window operators
def feature_rank(scores: DataFrame, score_col: str, name: str = "rank") -> DataFrame:
    """1-based rank of features by a score (desc, ties by name); #features rows."""
    w = Window.orderBy(F.col(score_col).desc(), F.col("feature"))
    return scores.withColumn(name, F.row_number().over(w).cast("bigint"))


def cumulative_importance(scores: DataFrame, score_col: str, share: float = 0.8) -> DataFrame:
    """Importance share, running total and the smallest set reaching ``share``."""
    w = Window.orderBy(F.col(score_col).desc(), F.col("feature"))
    wr = w.rowsBetween(Window.unboundedPreceding, 0)
    tot = F.sum(score_col).over(Window.partitionBy())
    x = scores.select("feature", score_col, (F.col(score_col) / tot).alias("importance_share"),
                      (F.sum(score_col).over(wr) / tot).alias("cumulative"), F.row_number().over(w).cast("bigint").alias("rank"))
    return x.withColumn("in_top", ((F.col("cumulative") - F.col("importance_share")) < share).cast("int"))


def percentile_rank(df: DataFrame, column: str, keys: Sequence[str]) -> DataFrame:
    """rank(pct=True) with average ties = average rank / non-null count (per-value table joined back)."""
    from tabscope.operators.association import average_ranks
    r = average_ranks(df, column, "_r")
    total = scalar_row(df.agg(F.count(col(column)).alias("n"))).getField("n")
    r = r.select(col(column), (F.col("_r") / total).alias(f"{column}_pct_rank"))
    return df.select(*[col(k) for k in keys], col(column)).join(r, column, "left")


def stratified_folds(df: DataFrame, target: str, k: int = 5, order_cols: Sequence[str] = (), seed: int = 42,
                     checkpoint: bool = True) -> DataFrame:
    """Exact stratified fold = (position of the row within its class) mod k.

    Positions come from :func:`tabscope.plans.frames.positions` (range-partitioned
    sort + per-task numbering + per-partition offsets), so a class holding a
    third of all rows is spread over many tasks; default order is a seeded
    hash of the row (shuffled folds), ``order_cols`` gives positional folds."""
    from tabscope.plans.frames import positions
    order = [col(c) for c in order_cols] if order_cols else [F.xxhash64(F.lit(seed), *[col(c) for c in df.columns])]
    p = positions(df, order, by=[target], name="_position", checkpoint=checkpoint)
    return p.withColumn("fold", F.pmod(F.col("_position"), F.lit(k)).cast("int")).drop("_position")


# ------------------------------------------------------------ time series
def daily_series(df: DataFrame, ts: str, value: str | None = None, how: str = "count") -> DataFrame:
    """Aggregate raw rows to one value per calendar day."""
    d = F.to_date(col(ts)).alias("day")
    if how == "count":
        agg = F.count(F.lit(1)).cast("double")
    elif how == "sum":
        agg = F.sum(col(value).cast("double"))
    else:
        agg = F.avg(col(value).cast("double"))
    return df.groupBy(d).agg(agg.alias("y"))


def _numbered(series: DataFrame) -> DataFrame:
    """``day, y, t``: the place of each period from 0, by prefix sums over blocks."""
    x = series.select("day", "y", F.unix_date("day").alias("_order"), F.lit(1).alias("_one"))
    return running_sum(x, ["_order"], "_one", out="_at").select("day", "y", (F.col("_at") - 1).alias("t"))


def seasonal_decompose(series: DataFrame, period: int = 7) -> DataFrame:
    """Additive decomposition: centred moving average (odd period), seasonal = mean detrended
    value per phase minus the mean over phases, residual = y - trend - seasonal.  The moving average runs in blocks that
    carry half a period of their neighbours."""
    h = period // 2
    wm = Window.partitionBy("_block").orderBy("t").rowsBetween(-h, h)
    s = haloed(_numbered(series), "t", h, h)
    s = s.withColumn("trend", F.when(F.count("y").over(wm) == period, F.avg("y").over(wm))).where("not _halo")
    s = written(s.select("day", "y", "trend", F.pmod(F.col("t"), F.lit(period)).alias("phase")), "trend")
    ph = s.groupBy("phase").agg(F.avg(F.col("y") - F.col("trend")).alias("pm"))
    ph = ph.withColumn("seasonal", F.col("pm") - scalar_row(ph.agg(F.avg("pm").alias("m")))["m"])
    out = s.join(bounded(ph.select("phase", "seasonal")), "phase")  # a row per phase
    return out.select(F.date_format("day", "yyyy-MM-dd").alias("day"), "y", "trend", "seasonal",
                      (F.col("y") - F.col("trend") - F.col("seasonal")).alias("resid"))


def _lagged(series: DataFrame, nlags: int, column: str = "y") -> DataFrame:
    """``day, y, lags``: each row with its ``nlags`` earlier values, the nearest first (null before the beginning)."""
    w = Window.partitionBy("_block").orderBy("day")
    s = haloed(series, "day", nlags)
    lags = F.array(*[F.lag(column, k).over(w) for k in range(1, nlags + 1)]) if nlags else F.array().cast("array<double>")
    return s.withColumn("lags", lags).where("not _halo").drop("_block", "_halo")


def acf(series: DataFrame, nlags: int = 40) -> DataFrame:
    """Autocorrelation to ``nlags`` (biased estimator, as statsmodels' default).  Blocks carry the last ``nlags``
    values before them; the products are added up in one aggregate."""
    mean = scalar_row(series.agg(F.avg("y").alias("m")))["m"]
    s = _lagged(series.select("day", (F.col("y") - mean).alias("y")), nlags)
    agg = s.agg(F.sum(F.col("y") * F.col("y")).alias("den"), F.count(F.lit(1)).alias("n"),
                *[F.sum(F.col("y") * F.col("lags")[k - 1]).alias(f"s{k}") for k in range(1, nlags + 1)])
    rows = F.array(*[F.struct(F.lit(k).alias("lag"), F.try_divide(F.coalesce(F.col(f"s{k}"), F.lit(0.0)), F.col("den")).alias("acf"))
                     for k in range(1, nlags + 1)])
    return agg.select(F.inline(rows), "n").where(F.col("lag") < F.col("n")).drop("n")


def pacf(series: DataFrame, nlags: int = 20) -> DataFrame:
    """Partial autocorrelation to ``nlags`` by the Durbin-Levinson recursion over the (nlags) autocorrelations."""
    r = {row["lag"]: row["acf"] for row in acf(series, nlags).collect() if row["acf"] is not None}
    rows, phi = [], []
    for k in range(1, max(r, default=0) + 1):
        if k not in r:
            break
        den = 1.0 - sum(p * r[j + 1] for j, p in enumerate(phi))
        if abs(den) < 1e-12:
            break
        last = (r[k] - sum(p * r[k - 1 - j] for j, p in enumerate(phi))) / den
        phi = [p - last * q for p, q in zip(phi, phi[::-1], strict=True)] + [last]
        rows.append((k, float(last)))
    return series.sparkSession.createDataFrame(rows, "lag int, pacf double")


def date_span(df: DataFrame, cols: Sequence[str], days: int = 100) -> DataFrame:
    """Min / max date and span; span > 100 days suggests checking trend / seasonality."""
    out = per_feature(df, cols, lambda i, f: {"first": F.date_format(F.min(col(f)), "yyyy-MM-dd"),
                                              "last": F.date_format(F.max(col(f)), "yyyy-MM-dd"),
                                              "span_days": F.datediff(F.max(col(f)), F.min(col(f))).cast("bigint")})
    return out.withColumn("check_trend", (F.col("span_days") > days).cast("int"))


def _gram(rows: DataFrame, width: int) -> np.ndarray:
    """Sum of the outer products of array column ``z`` (``width`` numbers): tasks add up before the shuffle, a matrix of
    parameter size reaches the driver."""
    def run(batches):
        g = np.zeros((width, width))
        for b in batches:
            z = b.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            g += z.T @ z
        i, j = np.indices(g.shape)
        yield pa.RecordBatch.from_arrays([pa.array(i.ravel(), pa.int32()), pa.array(j.ravel(), pa.int32()), pa.array(g.ravel())],
                                         names=["i", "j", "v"])
    out = np.zeros((width, width))
    for r in rows.select("z").mapInArrow(run, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
        out[r.i, r.j] = r.v
    return out


def _ols(gram: np.ndarray, used: int) -> tuple[np.ndarray, np.ndarray, float, int]:
    """Coefficients, inverse of the design's Gram matrix, squared errors and rows, for the last column of ``gram`` on its
    first ``used`` ones (the first is the constant)."""
    xx, xy = gram[:used, :used], gram[:used, -1]
    beta = np.linalg.lstsq(xx, xy, rcond=None)[0]
    return beta, np.linalg.pinv(xx), max(float(gram[-1, -1] - beta @ xy), 0.0), int(round(gram[0, 0]))


def _adf_rows(series: DataFrame, lags: int, center: float) -> DataFrame:
    """Rows ``z = [1, y[t-1], dy[t-1], ..., dy[t-lags], dy[t]]`` of all places with so many earlier differences."""
    x = _lagged(series.select("day", (F.col("y") - center).alias("y")), lags + 1)
    x = x.where(F.col("lags")[lags].isNotNull())
    value = [F.col("y")] + [F.col("lags")[k] for k in range(lags + 1)]
    diff = [value[k] - value[k + 1] for k in range(lags + 1)]
    return x.select(F.array(F.lit(1.0), value[1], *diff[1:], diff[0]).alias("z"))


def augmented_dickey_fuller(series: DataFrame, max_lag: int | None = None) -> DataFrame:
    """Augmented Dickey-Fuller test with a constant: dy[t] = a + g y[t-1] + sum of b[i] dy[t-i] + e.

    The number of lagged differences has the smallest AIC of all up to ``max_lag`` (12 (n / 100)^(1/4), rounded up) over
    the rows that have ``max_lag`` of them; the test is then fitted on all rows that have as many as chosen.  Each is one
    Gram matrix of lagged values, added up over blocks that carry the last rows of the block before.  Null values are
    left out first.  A series too short for the test has no statistic.  Returns one row: ``n`` (rows of the last fit),
    ``lags``, ``gamma``, ``adf_stat``, ``p_value``, critical values and ``stationary_5pct``."""
    schema = "n long, lags int, gamma double, adf_stat double, p_value double, crit_1pct double, crit_5pct double, " \
             "crit_10pct double, stationary_5pct int"
    spark = series.sparkSession
    series = written(series.where(F.col("y").isNotNull() & ~F.isnan("y")).select("day", F.col("y").cast("double").alias("y")), "adf")
    n, center, low, high = series.agg(F.count("y"), F.avg("y"), F.min("y"), F.max("y")).first()
    most = min(n // 2 - 2, int(np.ceil(12 * (n / 100) ** 0.25)))
    most = most if max_lag is None else min(max_lag, n // 2 - 2)
    if n < 6 or low == high or most < 0:
        return spark.createDataFrame([(n, None, None, None, None, None, None, None, None)], schema)
    gram = _gram(_adf_rows(series, most, center), most + 3)

    def aic(lags):
        _, _, sse, rows = _ols(gram, lags + 2)
        return rows * np.log(max(sse, 1e-300) / rows) + 2 * (lags + 2)
    lags = min(range(most + 1), key=aic)
    beta, inverse, sse, rows = _ols(_gram(_adf_rows(series, lags, center), lags + 3), lags + 2)
    error = np.sqrt(sse / max(rows - lags - 2, 1) * inverse[1, 1])
    stat = float(beta[1] / error) if error > 0 else float("-inf") if beta[1] < 0 else float("inf")
    crit = adf_critical_values(rows)
    return spark.createDataFrame([(rows, lags, float(beta[1]), stat, adf_p_value(stat), *crit, int(stat < crit[1]))], schema)
