"""Feature engineering and encoders, row-parallel column expressions.

Fitted encoders (label / target / scaling / Box-Cox) learn a table whose size
is bounded by #features x #levels; it is joined back (AQE broadcasts it when
its measured size allows) or, for per-feature scalars, attached as one struct
scalar subquery.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabscope.config import DEFAULT, Config
from tabscope.functions.exprs import col, equal_width_bin
from tabscope.plans.frames import per_feature, scalar_row

EPS = 1e-6


def fe_arithmetic(df: DataFrame, pairs: Sequence[tuple[str, str]], eps: float = EPS) -> DataFrame:
    """FE1: ratio (eps-guarded), difference, sum and product for each pair."""
    out = []
    for a, b in pairs:
        x, y = col(a).cast("double"), col(b).cast("double")
        out += [(x / (y + eps)).alias(f"{a}_div_{b}"), (x - y).alias(f"{a}_minus_{b}"),
                (x + y).alias(f"{a}_plus_{b}"), (x * y).alias(f"{a}_times_{b}")]
    return df.select("*", *out)


def fe_row_stats(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """FE2: row-wise mean / std (ddof 1) / min / max / range over numerics (nulls skipped)."""
    vals = [col(c).cast("double") for c in cols]
    n = sum((F.when(v.isNotNull(), 1).otherwise(0) for v in vals), F.lit(0))
    s = sum((F.coalesce(v, F.lit(0.0)) for v in vals), F.lit(0.0))
    mean = F.try_divide(s, n)
    ss = sum((F.coalesce((v - mean) ** 2, F.lit(0.0)) for v in vals), F.lit(0.0))
    mn, mx = F.least(*vals), F.greatest(*vals)
    return df.select("*", mean.alias("row_mean"), F.sqrt(F.try_divide(ss, n - 1)).alias("row_std"), mn.alias("row_min"),
                     mx.alias("row_max"), (mx - mn).alias("row_range"))


def fe_cross(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """FE3: categorical crosses ``a_b`` as ``str(a) + '_' + str(b)``."""
    return df.select("*", *[F.concat_ws("_", col(a).cast("string"), col(b).cast("string")).alias(f"{a}_x_{b}")
                            for a, b in pairs])


def fe_flag_interaction(df: DataFrame, flag_col: str, flag_value, numerics: Sequence[str]) -> DataFrame:
    """FE4: (flag == value) * numeric."""
    f = (col(flag_col) == F.lit(flag_value)).cast("int")
    return df.select("*", *[(f * col(c)).alias(f"{flag_col}_x_{c}") for c in numerics])


def dfs_transform(df: DataFrame, numerics: Sequence[str]) -> DataFrame:
    """FE5: depth-1 synthesis with the 12 transform primitives, named as the generator names them.

    PERCENTILE(a) is the average-rank percentile (ties share the mean rank),
    computed from per-value counts (window over distinct values only)."""
    from tabscope.operators.association import average_ranks
    out = [col(c) for c in df.columns]
    for a in numerics:
        x = col(a).cast("double")
        out += [F.abs(x).alias(f"ABSOLUTE({a})"), (-x).alias(f"-({a})")]
    for a, b in itertools.combinations(numerics, 2):
        x, y = col(a).cast("double"), col(b).cast("double")
        out += [(x + y).alias(f"{a} + {b}"), (x - y).alias(f"{a} - {b}"), (x * y).alias(f"{a} * {b}"),
                F.when(y != 0, x / y).alias(f"{a} / {b}"), F.when(y != 0, F.pmod(x, y)).alias(f"{a} % {b}"),
                (x == y).alias(f"{a} = {b}"), (x != y).alias(f"{a} != {b}"), (x > y).alias(f"{a} > {b}"),
                (x < y).alias(f"{a} < {b}")]
    res = df.select(*out)
    counts = scalar_row(df.agg(*[F.count(col(a)).alias(f"n{i}") for i, a in enumerate(numerics)]))
    for i, a in enumerate(numerics):
        r = average_ranks(df, a, "_r").select(col(a), (F.col("_r") / counts.getField(f"n{i}")).alias(f"PERCENTILE({a})"))
        res = res.join(r, a, "left")
    return res


def prune_columns_regex(df: DataFrame, patterns: Sequence[str] = (r"^ABSOLUTE\(", r"^PERCENTILE\(", r"^-\(")) -> DataFrame:
    """Drop generated columns whose names match any pattern."""
    import re
    rx = [re.compile(p) for p in patterns]
    return df.select(*[col(c) for c in df.columns if not any(r.search(c) for r in rx)])


def label_encode(frames: Sequence[DataFrame], cols: Sequence[str]) -> DataFrame:
    """FE6: code table (feature, value, code) with sorted codes fitted on the union of frames (places of the distinct
    levels in a range-partitioned sort)."""
    from tabscope.plans.frames import positions, value_counts
    levels = None
    for f in frames:
        v = value_counts(f, cols).select("feature", "value")
        levels = v if levels is None else levels.unionByName(v)
    x = positions(levels.distinct(), [F.col("value")], by=["feature"], name="code")
    return x.select("feature", "value", F.col("code").cast("int").alias("code"))


def apply_codes(df: DataFrame, codes: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Replace each column by its code (one left join per column; code tables are small)."""
    out = df
    for c in cols:
        m = codes.where(F.col("feature") == c).select(F.col("value").alias(f"_v_{c}"), F.col("code").alias(f"_c_{c}"))
        out = out.join(m, col(c).cast("string") == F.col(f"_v_{c}"), "left").drop(f"_v_{c}") \
            .withColumn(c, F.col(f"_c_{c}")).drop(f"_c_{c}")
    return out


def one_hot(df: DataFrame, column: str, levels: Sequence, drop_first: bool = False) -> DataFrame:
    """FE7: indicator columns for known levels (unknown -> all zeros)."""
    lv = list(levels)[1:] if drop_first else list(levels)
    return df.select("*", *[(col(column) == F.lit(v)).cast("int").alias(f"{column}_{v}") for v in lv])


def target_encode_table(df: DataFrame, column: str, y: Column, smoothing: float = 0.1, min_samples: int = 1) -> DataFrame:
    """FE8: smoothed target mean per level: sigmoid blend of level mean and prior,
    weight = 1 / (1 + exp(-(n - min_samples) / smoothing))."""
    total = scalar_row(df.agg(F.sum(y.cast("double")).alias("s"), F.count(F.lit(1)).alias("n")))
    g = df.groupBy(col(column).alias("level")).agg(F.count(F.lit(1)).alias("n"), F.avg(y.cast("double")).alias("mean"))
    g = g.withColumn("prior", F.try_divide(total.getField("s"), total.getField("n")))
    wgt = 1.0 / (1.0 + F.exp(-(F.col("n") - min_samples) / smoothing))
    return g.select("level", "n", "mean", "prior", (wgt * F.col("mean") + (1 - wgt) * F.col("prior")).alias("encoded"))


def target_encode_oof(df: DataFrame, column: str, y: Column, fold_col: str, smoothing: float = 0.1,
                      min_samples: int = 1) -> DataFrame:
    """FE8 out-of-fold: each row is encoded with statistics of the other folds,
    from (level, fold) sums: other = total - own fold (no per-fold refits)."""
    yy = y.cast("double")
    lf = df.groupBy(col(column).alias("level"), col(fold_col).alias("fold")).agg(
        F.count(F.lit(1)).alias("nf"), F.sum(yy).alias("sf"))
    wl = Window.partitionBy("level")
    # totals of a fold and of all rows: one row per fold
    own = df.groupBy(col(fold_col).alias("_fold")).agg(F.count(F.lit(1)).alias("_n"), F.sum(yy).alias("_s"))
    wa = Window.partitionBy()
    own = own.select("_fold", F.try_divide(F.sum("_s").over(wa) - F.col("_s"), F.sum("_n").over(wa) - F.col("_n")).alias("prior"))
    t = lf.select("level", "fold", (F.sum("nf").over(wl) - F.col("nf")).alias("n"), (F.sum("sf").over(wl) - F.col("sf")).alias("s"))
    t = t.join(own, t["fold"].eqNullSafe(own["_fold"])).drop("_fold")
    wgt = 1.0 / (1.0 + F.exp(-(F.col("n") - min_samples) / smoothing))
    enc = F.when(F.col("n") > 0, wgt * F.try_divide(F.col("s"), F.col("n")) + (1 - wgt) * F.col("prior")).otherwise(F.col("prior"))
    return t.select("level", "fold", "n", enc.alias("encoded"))


def fe_transforms(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """FE10: log1p, sqrt, square."""
    out = []
    for c in cols:
        x = col(c).cast("double")
        out += [F.log1p(x).alias(f"{c}_log1p"), F.sqrt(x).alias(f"{c}_sqrt"), (x * x).alias(f"{c}_sq")]
    return df.select("*", *out)


def boxcox_lambda(df: DataFrame, cols: Sequence[str], grid: Sequence[float] | None = None) -> DataFrame:
    """FE10: Box-Cox lambda of x+1 maximising the profile log-likelihood over a grid, in ONE aggregate:
    llf(l) = (l - 1) * sum(log y) - n/2 * log(var_pop(bc_l(y)))."""
    grid = list(grid or [round(-2 + 0.1 * i, 1) for i in range(41)])

    def make(i, f):
        y = col(f).cast("double") + 1.0
        out = {"n": F.count(y), "slog": F.sum(F.log(y))}
        for k, lam in enumerate(grid):
            bc = F.log(y) if lam == 0 else (F.pow(y, lam) - 1.0) / lam
            out[f"v{k}"] = F.var_pop(bc)
        return out
    st = per_feature(df, cols, make)
    ll = [F.struct(((lam - 1) * F.col("slog") - F.col("n") / 2.0 * F.log(F.col(f"v{k}"))).alias("ll"),
                   F.lit(lam).alias("lam")) for k, lam in enumerate(grid)]
    best = F.greatest(*ll)
    return st.select("feature", best["lam"].alias("best_lambda"), best["ll"].alias("loglik"))


def qcut_bins(df: DataFrame, cols: Sequence[str], q: int = 5, cfg: Config = DEFAULT) -> DataFrame:
    """FE11: pd.qcut(q, duplicates='drop') bin index per row (right-closed, lowest included)."""
    from tabscope.operators.association import _edges, qcut_bin
    out = df.withColumn("_ed", _edges(df, cols, q, cfg))
    return out.select(*[col(c) for c in df.columns],
                      *[qcut_bin(col(c).cast("double"), F.col("_ed").getField(f"e{i}"), q + 1).alias(f"{c}_qbin")
                        for i, c in enumerate(cols)])


def equal_width_bins(df: DataFrame, cols: Sequence[str], bins: int = 10) -> DataFrame:
    """FE12: equal-width bins on [min, max], last bin closed."""
    s = scalar_row(df.agg(*[x for i, c in enumerate(cols) for x in (F.min(col(c).cast("double")).alias(f"lo{i}"),
                                                                     F.max(col(c).cast("double")).alias(f"hi{i}"))]))
    out = df.withColumn("_mm", s)
    exprs = []
    for i, c in enumerate(cols):
        lo, hi = F.col("_mm").getField(f"lo{i}"), F.col("_mm").getField(f"hi{i}")
        exprs.append(equal_width_bin(col(c), lo, hi, bins).alias(f"{c}_bin"))
    return out.select(*[col(c) for c in df.columns], *exprs)


def date_parts(df: DataFrame, column: str) -> DataFrame:
    """FE13: year, month, day, dayofweek (Monday = 0), is_weekend, hour."""
    d = col(column)
    return df.select("*", F.year(d).alias(f"{column}_year"), F.month(d).alias(f"{column}_month"),
                     F.dayofmonth(d).alias(f"{column}_day"), F.weekday(d).alias(f"{column}_dow"),
                     (F.weekday(d) >= 5).cast("int").alias(f"{column}_is_weekend"), F.hour(d).alias(f"{column}_hour"))


def scale(train: DataFrame, other: DataFrame, cols: Sequence[str], kind: str = "standard") -> DataFrame:
    """FE15: standard (ddof 0, as the scikit scaler) or min-max scaling fitted on train only."""
    if kind == "standard":
        st = train.agg(*[x for i, c in enumerate(cols) for x in (F.avg(col(c).cast("double")).alias(f"a{i}"),
                                                                  F.stddev_pop(col(c).cast("double")).alias(f"b{i}"))])
    else:
        st = train.agg(*[x for i, c in enumerate(cols) for x in (F.min(col(c).cast("double")).alias(f"a{i}"),
                                                                  (F.max(col(c).cast("double")) - F.min(col(c).cast("double")))
                                                                  .alias(f"b{i}"))])
    s = scalar_row(st)
    out = other.withColumn("_sc", s)
    def scaled(c):
        a, b = F.col("_sc").getField(f"a{cols.index(c)}"), F.col("_sc").getField(f"b{cols.index(c)}")
        # a column that is constant in train is centred only
        return ((col(c).cast("double") - a) / F.when(b != 0, b).when(b == 0, F.lit(1.0))).alias(c)
    return out.select(*[scaled(c) if c in cols else col(c) for c in other.columns])


def class_weights(df: DataFrame, target: str) -> DataFrame:
    """FE17: 'balanced' weights n / (k * n_c)."""
    g = df.groupBy(col(target).cast("string").alias("class")).agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy()
    return g.select("class", "n", (F.sum("n").over(w) / (F.count(F.lit(1)).over(w) * F.col("n"))).alias("weight"))


def sentinel_to_null(df: DataFrame, cols: Sequence[str], pattern: str = r"^No .+") -> DataFrame:
    """FE19: sentinel levels (e.g. 'No internet service') -> null."""
    return df.select(*[F.when(col(c).rlike(pattern), F.lit(None)).otherwise(col(c)).alias(c) if c in cols else col(c)
                       for c in df.columns])


def fe_domain(df: DataFrame, exprs: Mapping[str, Column]) -> DataFrame:
    """FE18/FE20: named domain formulas (threshold flags, ratios, residual features)."""
    return df.select("*", *[e.alias(n) for n, e in exprs.items()])


def string_predicates(df: DataFrame, column: str) -> DataFrame:
    """FE21: the string tests used by the type checks."""
    s = col(column).cast("string")
    return df.select("*", s.rlike(r"^\d{1,}$").cast("int").alias("is_int_text"),
                     s.rlike(r"^\d+\.?\d*$").cast("int").alias("is_num_text"),
                     s.rlike(r"\d{4}-\d{2}-\d{2}").cast("int").alias("has_date"),
                     s.contains("@").cast("int").alias("has_at"), F.lower(s).alias("lower"),
                     F.length(s).alias("length"), F.size(F.split(s, " ")).alias("n_tokens"),
                     F.ltrim(F.regexp_replace(s, r"^[0.]+", "")).alias("lstrip_0"))


def feature_select(train: DataFrame, features: Sequence[str], y: Column, null_max: float = 0.95,
                   mi_min: float = 5e-4, corr_max: float = 0.995, bins: int = 10, cfg: Config = DEFAULT) -> DataFrame:
    """FE16: drop null share > .95, constants, MI < 5e-4, and the later column of each |r| > .995 pair.
    Returns (feature, keep, reason); the column list comes from aggregates only."""
    from tabscope.operators.association import corr_pairs, mi_binned
    prof = per_feature(train, features, lambda i, f: {"n": F.count(F.lit(1)), "nn": F.count(col(f)),
                                                      "nu": F.count_distinct(col(f))})
    mi = mi_binned(train, features, [], y, bins, cfg).select("feature", "mi")
    cp = corr_pairs(train, features).where(F.abs("corr") > corr_max).select(F.col("feature_b").alias("feature")) \
        .distinct().withColumn("corr_drop", F.lit(1))
    j = prof.join(mi, "feature", "left").join(cp, "feature", "left")
    reason = (F.when(1 - F.col("nn") / F.col("n") > null_max, "nulls").when(F.col("nu") <= 1, "constant")
              .when(F.coalesce(F.col("mi"), F.lit(0.0)) < mi_min, "low_mi").when(F.col("corr_drop") == 1, "correlated"))
    return j.select("feature", F.col("mi"), reason.alias("reason"), reason.isNull().cast("int").alias("keep"))
