"""Projections, filters, fills and masks."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabscope.config import DEFAULT, Config
from tabscope.functions.exprs import col, pearson
from tabscope.plans.frames import per_feature, quantile, quantiles, scalar_row


def drop_columns(df: DataFrame, cols: Sequence[str] = (), pattern: str | None = None) -> DataFrame:
    """Drop listed columns and/or those whose name matches ``pattern`` (missing names ignored)."""
    drop = [c for c in cols if c in df.columns]
    if pattern:
        rx = re.compile(pattern)
        drop += [c for c in df.columns if rx.search(c) and c not in drop]
    return df.select(*[col(c) for c in df.columns if c not in drop])


def recode(df: DataFrame, column: str, mapping: Mapping, out: str | None = None) -> DataFrame:
    """Dictionary recode (unmapped values -> null)."""
    m = F.create_map(*[x for k, v in mapping.items() for x in (F.lit(k), F.lit(v))])
    return df.withColumn(out or column, m[col(column)])


def sanitize_extremes(df: DataFrame, cols: Sequence[str], limit: float = 1e15) -> DataFrame:
    """+-inf and |x| > limit -> null."""
    inf = float("inf")
    out = []
    for f in df.columns:
        if f in cols:
            c = col(f).cast("double")
            out.append(F.when((c == inf) | (c == -inf) | (F.abs(c) > limit), F.lit(None)).otherwise(c).alias(f))
        else:
            out.append(col(f))
    return df.select(*out)


def null_profile_after(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return per_feature(df, cols, lambda i, f: {"n_null_after": F.count_if(col(f).isNull())})


def safe_corr(df: DataFrame, cols: Sequence[str], min_pairs: int = 10) -> DataFrame:
    """Pairwise-complete Pearson r for every pair; null below ``min_pairs`` finite pairs."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]

    def finite(c):
        return c.isNotNull() & ~F.isnan(c.cast("double"))
    exprs = []
    for k, (a, b) in enumerate(pairs):
        ok = finite(col(a)) & finite(col(b))
        exprs += [F.count_if(ok).alias(f"_n{k}"),
                  pearson(F.when(ok, col(a).cast("double")), F.when(ok, col(b).cast("double"))).alias(f"_r{k}")]
    agg = df.agg(*exprs)
    rows = F.array(*[F.struct(F.lit(a).alias("feature_a"), F.lit(b).alias("feature_b"),
                              F.col(f"_n{k}").alias("n_pairs"),
                              F.when(F.col(f"_n{k}") >= min_pairs, F.nanvl(F.col(f"_r{k}"), F.lit(None))).alias("corr"))
                     for k, (a, b) in enumerate(pairs)])
    return agg.select(F.inline(rows))


def fill_const(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """P10: constant fill per column (coalesce keeps the column type)."""
    return df.select(*[F.coalesce(col(c), F.lit(values[c]).cast(t)).alias(c) if c in values else col(c)
                       for c, t in df.dtypes])


def fit_fill_values(train: DataFrame, cols: Sequence[str], strategy: str = "median", cfg: Config = DEFAULT) -> Column:
    """Fill value per column learnt on train, as a struct scalar subquery (fields f0, f1, ...)."""
    if strategy == "median":
        from tabscope.plans.frames import quantile_scalar
        med = quantile_scalar(train, cols, [0.5], cfg, prefix="m")
        stats = train.sparkSession.range(1).select(*[med.getField(f"m{i}")[0].alias(f"f{i}") for i in range(len(cols))])
    elif strategy == "mean":
        stats = train.agg(*[F.avg(col(c).cast("double")).alias(f"f{i}") for i, c in enumerate(cols)])
    elif strategy == "mode":
        stats = train.agg(*[F.mode(col(c), deterministic=True).cast("double").alias(f"f{i}") for i, c in enumerate(cols)])
    else:
        raise ValueError(strategy)
    return scalar_row(stats)


def impute(train: DataFrame, test: DataFrame, cols: Sequence[str], strategy: str = "median",
           cfg: Config = DEFAULT) -> DataFrame:
    """P11/FE9: fill test nulls with statistics fitted on train (no leakage from test)."""
    s = fit_fill_values(train, cols, strategy, cfg)
    idx = {c: i for i, c in enumerate(cols)}
    return test.select(*[F.coalesce(col(c).cast("double"), s.getField(f"f{idx[c]}")).alias(c) if c in idx else col(c)
                         for c in test.columns])


def impute_report(train: DataFrame, test: DataFrame, cols: Sequence[str], strategy: str = "median",
                  cfg: Config = DEFAULT) -> DataFrame:
    test = test.withColumn("_fv", fit_fill_values(train, cols, strategy, cfg))
    s = F.col("_fv")
    return per_feature(test, cols, lambda i, f: {
        "fill_value": F.first(s.getField(f"f{i}")).cast("double"),
        "n_filled": F.count_if(col(f).isNull()),
        "mean_after": F.avg(F.coalesce(col(f).cast("double"), s.getField(f"f{i}"))),
    })


def percentile_band(df: DataFrame, cols: Sequence[str], lo: float = 0.01, hi: float = 0.99,
                    cfg: Config = DEFAULT) -> DataFrame:
    """Rows below the ``lo`` or above the ``hi`` percentile (two scans, no join)."""
    from tabscope.plans.frames import quantile_scalar
    df = df.withColumn("_qs", quantile_scalar(df, cols, [lo, hi], cfg))
    s = F.col("_qs")
    return per_feature(df, cols, lambda i, f: {
        "p1": F.first(s.getField(f"q{i}")[0]), "p99": F.first(s.getField(f"q{i}")[1]),
        "n_below": F.count_if(col(f) < s.getField(f"q{i}")[0]),
        "n_above": F.count_if(col(f) > s.getField(f"q{i}")[1]),
        "pct_outside": 100.0 * F.count_if((col(f) < s.getField(f"q{i}")[0]) | (col(f) > s.getField(f"q{i}")[1]))
        / F.count(col(f)),
    })


def iqr_bounds(df: DataFrame, cols: Sequence[str], k: float = 1.5, cfg: Config = DEFAULT) -> Column:
    """Struct scalar with fields lo{i}/hi{i}: Q1 - k IQR, Q3 + k IQR."""
    from tabscope.plans.frames import quantile_long
    qt = quantile_long(df, cols, [0.25, 0.75], cfg=cfg)
    exprs = []
    for i, c in enumerate(cols):
        qq = F.max(F.when(F.col("feature") == c, F.col("q")))
        q1, q3 = qq[0], qq[1]
        exprs += [(q1 - k * (q3 - q1)).alias(f"lo{i}"), (q3 + k * (q3 - q1)).alias(f"hi{i}"),
                  q1.alias(f"q1_{i}"), q3.alias(f"q3_{i}")]
    return scalar_row(qt.agg(*exprs))


def iqr_clip(df: DataFrame, cols: Sequence[str], k: float = 1.5, flag: bool = True, cfg: Config = DEFAULT) -> DataFrame:
    """FE14: winsorise to the IQR fences and add ``<col>_outlier`` flags."""
    b = iqr_bounds(df, cols, k, cfg)
    out = []
    for c in df.columns:
        if c in cols:
            i = cols.index(c)
            x = col(c).cast("double")
            out.append(F.least(F.greatest(x, b.getField(f"lo{i}")), b.getField(f"hi{i}")).alias(c))
            if flag:
                out.append(((x < b.getField(f"lo{i}")) | (x > b.getField(f"hi{i}"))).cast("int").alias(f"{c}_outlier"))
        else:
            out.append(col(c))
    return df.select(*out)


def iqr_report(df: DataFrame, cols: Sequence[str], k: float = 1.5, cfg: Config = DEFAULT) -> DataFrame:
    """Fences, flagged count, mean after clipping, rows kept by the filter."""
    df = df.withColumn("_b", iqr_bounds(df, cols, k, cfg))
    b = F.col("_b")

    def make(i, f):
        x, lo, hi = col(f).cast("double"), b.getField(f"lo{i}"), b.getField(f"hi{i}")
        return {"lower": F.first(lo), "upper": F.first(hi), "n_flagged": F.count_if((x < lo) | (x > hi)),
                "mean_clipped": F.avg(F.least(F.greatest(x, lo), hi)),
                "n_kept": F.count_if((x >= lo) & (x <= hi))}
    return per_feature(df, cols, make)


def sample_n(df: DataFrame, n: int, key_cols: Sequence[str], seed: int = 42) -> DataFrame:
    """N rows without replacement, ordered by a seeded hash of the key
    (TakeOrderedAndProject: a per-task top-n then a merge, no global sort)."""
    return df.orderBy(F.xxhash64(F.lit(seed), *[col(c) for c in key_cols])).limit(n)


#: Rows that one multinomial draw covers; the draws above it are binomial splits.
BOOTSTRAP_LEAF = 4096


def leaf_copies(rows: int, draws: int, leaf: int, seed: int) -> np.ndarray:
    """How often each row of a leaf (rows ``leaf * BOOTSTRAP_LEAF`` and on) comes in ``draws`` draws with replacement out
    of ``rows`` rows.

    The draws split over the halves of a binary tree by conditional binomials and inside a leaf by a multinomial; every
    node has a random stream of its own, so all tasks agree on the splits above their leaves and nothing is left over."""
    low, high, left = 0, -(-rows // BOOTSTRAP_LEAF), draws
    while high - low > 1:
        mid = (low + high) // 2
        here, part = min(high * BOOTSTRAP_LEAF, rows) - low * BOOTSTRAP_LEAF, (mid - low) * BOOTSTRAP_LEAF
        first = int(np.random.default_rng([seed, low, high]).binomial(left, part / here))
        low, high, left = (low, mid, first) if leaf < mid else (mid, high, left - first)
    size = min(BOOTSTRAP_LEAF, rows - leaf * BOOTSTRAP_LEAF)
    return np.random.default_rng([seed, leaf, leaf + 1]).multinomial(left, np.full(size, 1 / size))


def bootstrap_counts(df: DataFrame, key_cols: Sequence[str], n: int | None = None, seed: int = 42,
                     name: str = "copies") -> DataFrame:
    """``df`` with the number of times that a sample of ``n`` rows (all, if not given) with replacement takes each row.

    The counts are exactly multinomial and add up to ``n``; no row is copied.  Rows are numbered in the order of a seeded
    hash of the keys (a range-partitioned sort, stored), so the same table and seed give the same sample whatever its
    partitioning and under retries.  Rows of equal keys are exchangeable."""
    from tabscope.plans.frames import positions
    total = df.count()
    draws = total if n is None else n
    if not total:
        return df.withColumn(name, F.lit(0).cast("long"))
    x = positions(df, [F.xxhash64(F.lit(seed), *[col(c) for c in key_cols])], name="_position")

    def run(batches):
        for b in batches:
            at = b.column(b.schema.get_field_index("_position")).to_numpy()
            out = np.empty(len(at), np.int64)
            leaf = at // BOOTSTRAP_LEAF
            for one in np.unique(leaf).tolist():
                here = leaf == one
                out[here] = leaf_copies(total, draws, one, seed)[at[here] % BOOTSTRAP_LEAF]
            keep = [i for i, f in enumerate(b.schema.names) if f != "_position"]
            yield pa.RecordBatch.from_arrays([*[b.column(i) for i in keep], pa.array(out)], names=[*[b.schema.names[i] for i in keep], name])
    schema = T.StructType([*[f for f in x.schema.fields if f.name != "_position"], T.StructField(name, T.LongType())])
    return x.mapInArrow(run, schema)


def bootstrap_rows(df: DataFrame, key_cols: Sequence[str], n: int | None = None, seed: int = 42) -> DataFrame:
    """The sampled rows themselves, each as often as it was drawn, with ``draw`` from 1."""
    x = bootstrap_counts(df, key_cols, n, seed, "_copies").where("_copies > 0")
    return x.select("*", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies"))).alias("draw")).drop("_copies")


def bootstrap_weights(df: DataFrame, rounds: int, seed: int = 42) -> DataFrame:
    """Poisson(1) multiplicity per row and replica, i.e. B bootstrap samples in one pass
    (``rep``, ``w`` columns; rows with w = 0 are dropped)."""
    reps = F.explode(F.sequence(F.lit(0), F.lit(rounds - 1))).alias("rep")
    x = df.select("*", reps)
    # inverse-CDF Poisson(1) draw from a uniform derived from (row, rep): deterministic under retries
    u = F.rand(seed)
    cdf = [0.36787944117144233, 0.7357588823428847, 0.9196986029286058, 0.9810118431238462, 0.9963401531726563,
           0.9994058151824183, 0.9999167588507119]
    w = F.lit(7)
    for k in range(len(cdf) - 1, -1, -1):
        w = F.when(u < cdf[k], F.lit(k)).otherwise(w)
    return x.withColumn("w", w).where(F.col("w") > 0)
