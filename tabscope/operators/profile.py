"""Column / class profiles: one wide aggregate per family.

Numeric profiles are a single grouped-or-global aggregate stacked to long
form; categorical profiles are arithmetic on the ``(feature, value[, class])``
count cube.  Nothing here collects rows to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabscope.config import DEFAULT, Config
from tabscope.functions.exprs import col, pearson, kurt_corrected, safe_div, skew_corrected
from tabscope.plans.frames import distinct_counts, per_feature, quantiles, scalar_row, value_counts, with_totals

PCT_NAMES = ("p01", "p05", "p10", "p25", "p50", "p75", "p90", "p95", "p99")


def _is_missing(c: Column, dtype: str) -> Column:
    if dtype in ("double", "float"):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def _dtypes(df: DataFrame) -> dict[str, str]:
    return dict(df.dtypes)


# ---------------------------------------------------------------- overview
def dataset_overview(df: DataFrame, target: str | None = None, id_cols: Sequence[str] = ()) -> DataFrame:
    """A1: rows, columns and role counts in one row."""
    from tabscope.plans.roles import column_roles_schema
    roles = column_roles_schema(df, target=target, id_cols=id_cols)
    counts = {r: sum(1 for v in roles.values() if v == r) for r in ("numeric", "categorical", "datetime", "other")}
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        "n_rows", F.lit(len(df.columns)).cast("bigint").alias("n_cols"),
        *[F.lit(v).cast("bigint").alias(f"n_{k}") for k, v in counts.items()])


def dtype_breakdown(df: DataFrame) -> DataFrame:
    """A2: number of columns per Spark type (type names come from the scan schema)."""
    dts = [t for _, t in df.dtypes]
    rows = F.array(*[F.struct(F.lit(t).alias("dtype"), F.lit(dts.count(t)).cast("bigint").alias("n_columns"))
                     for t in sorted(set(dts))])
    return df.agg(F.count(F.lit(1))).select(F.inline(rows))  # one row, also for an empty table


# ----------------------------------------------------------------- missing
def null_profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """A3: ``feature, n_rows, n_null, pct_null`` for every column, one scan."""
    cols = list(cols or df.columns)
    dt = _dtypes(df)
    out = per_feature(df, cols, lambda i, f: {
        "n_rows": F.count(F.lit(1)),
        "n_null": F.count_if(_is_missing(col(f), dt[f])),
    })
    return out.withColumn("pct_null", 100.0 * F.col("n_null") / F.col("n_rows"))


def missing_overall(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """A4: overall missing share of all cells and its severity band (>30 / >5 %)."""
    cols = list(cols or df.columns)
    dt = _dtypes(df)
    miss = sum((F.count_if(_is_missing(col(c), dt[c])) for c in cols), F.lit(0))
    agg = df.agg(F.count(F.lit(1)).alias("n_rows"), miss.cast("bigint").alias("n_missing"))
    pct = 100.0 * F.col("n_missing") / (F.col("n_rows") * len(cols))
    return agg.select(
        (F.col("n_rows") * len(cols)).cast("bigint").alias("n_cells"), "n_missing", pct.alias("pct_missing"),
        F.when(pct > 30, "high").when(pct > 5, "moderate").otherwise("low").alias("severity"))


def null_compare(train: DataFrame, test: DataFrame, gap_pp: float = 10.0) -> DataFrame:
    """A5: null % per side, gap, presence flags; gap > ``gap_pp`` points warns."""
    a = null_profile(train).select("feature", F.col("pct_null").alias("pct_train"))
    b = null_profile(test).select("feature", F.col("pct_null").alias("pct_test"))
    j = a.join(b, "feature", "full_outer")
    gap = F.abs(F.col("pct_train") - F.col("pct_test"))
    return j.select(
        "feature", "pct_train", "pct_test", gap.alias("gap"),
        F.col("pct_train").isNotNull().cast("int").alias("in_train"),
        F.col("pct_test").isNotNull().cast("int").alias("in_test"),
        F.coalesce((gap > gap_pp).cast("int"), F.lit(0)).alias("warn"))


def _indicator_pairs(cols: Sequence[str]):
    return [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]


def null_corr(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Correlation of missing indicators, every pair a<b, one aggregate."""
    ind = {c: col(c).isNull().cast("double") for c in cols}
    pairs = _indicator_pairs(list(cols))
    agg = df.agg(*[pearson(ind[a], ind[b]).alias(f"_p{k}") for k, (a, b) in enumerate(pairs)])
    rows = F.array(*[F.struct(F.lit(a).alias("feature_a"), F.lit(b).alias("feature_b"),
                              F.nanvl(F.col(f"_p{k}"), F.lit(None)).alias("corr"))
                     for k, (a, b) in enumerate(pairs)])
    return agg.select(F.inline(rows))


def null_patterns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Missingness bitmap per row (1 = missing), counted."""
    pattern = F.concat(*[col(c).isNull().cast("int").cast("string") for c in cols])
    total = F.sum("n").over(Window.partitionBy())
    return (df.groupBy(pattern.alias("pattern")).agg(F.count(F.lit(1)).alias("n"))
            .withColumn("n_missing_cols", F.length(F.regexp_replace("pattern", "0", "")).cast("bigint"))
            .withColumn("pct", 100.0 * F.col("n") / total))


def null_mechanism(df: DataFrame, cols: Sequence[str], target: Column, threshold: float = 0.1) -> DataFrame:
    """|corr(missing indicator, target)| > 0.1 hints MNAR."""
    stats = per_feature(df, cols, lambda i, f: {
        "corr": pearson(col(f).isNull().cast("double"), target.cast("double")),
        "n_null": F.count_if(col(f).isNull()),
    })
    c = F.nanvl(F.col("corr"), F.lit(None))
    return stats.select("feature", "n_null", c.alias("corr_target"),
                        F.when(F.abs(c) > threshold, "MNAR?").otherwise("MCAR/MAR").alias("mechanism"))


def mcar_hint(df: DataFrame, cols: Sequence[str], threshold: float = 0.1) -> DataFrame:
    """Mean |indicator correlation| with the diagonal zeroed but kept in the mean."""
    k = len(cols)
    pairs = _indicator_pairs(list(cols))
    agg = df.agg(*[F.abs(F.nanvl(pearson(col(a).isNull().cast("double"), col(b).isNull().cast("double")),
                                 F.lit(0.0))).alias(f"_p{i}") for i, (a, b) in enumerate(pairs)])
    total = sum((F.coalesce(F.col(f"_p{i}"), F.lit(0.0)) for i in range(len(pairs))), F.lit(0.0))
    mean_abs = 2.0 * total / float(k * k)
    return agg.select(F.lit(k).cast("bigint").alias("n_columns"), mean_abs.alias("mean_abs_corr"),
                      F.when(mean_abs < threshold, "MCAR likely").otherwise("not MCAR").alias("hint"))


def impute_advice(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """A10: rule table on missing share (>60 % drop, >20 % median/mode + model, else model imputer),
    numeric median-vs-mean choice by |skew| > 1."""
    dt = _dtypes(df)
    prof = per_feature(df, list(cols), lambda i, f: {
        "n_rows": F.count(F.lit(1)),
        "n_null": F.count_if(col(f).isNull()),
        "skew": (F.skewness(col(f).cast("double")) if dt[f] not in ("string", "boolean")
                 else F.lit(None).cast("double")),
        "numeric": F.lit(int(dt[f] not in ("string", "boolean"))),
    })
    p = F.col("n_null") / F.col("n_rows")
    fill = (F.when(F.col("numeric") == 0, "mode")
            .when(F.abs(F.col("skew")) > 1, "median").otherwise("mean"))
    rec = (F.when(p > 0.6, "drop column").when(p > 0.2, "simple fill, then a model of the rest")
           .when(p > 0, "model of the other columns").otherwise("none"))
    return prof.where(F.col("n_null") > 0).select(
        "feature", "n_null", (100.0 * p).alias("pct_null"), F.nanvl("skew", F.lit(None)).alias("skew"),
        fill.alias("simple_fill"), rec.alias("recommendation"))


# ------------------------------------------------------------ describe
def _num_stats(cfg: Config, probs=None):
    def make(i, f):
        c = col(f).cast("double")
        return {"n": F.count(c), "mean": F.avg(c), "std": F.stddev_samp(c), "min": F.min(c), "max": F.max(c)}
    return make


def _with_q(stats: DataFrame, df: DataFrame, features: Sequence[str], probs, by=(), cfg: Config = DEFAULT) -> DataFrame:
    """Join the per-(group, feature) quantile arrays onto a per-(group, feature) stats table
    (both have #groups x #features rows)."""
    from tabscope.plans.frames import quantile_long
    return stats.join(quantile_long(df, features, list(probs), by=by, cfg=cfg), [*by, "feature"], "left")


def _explode_q(df: DataFrame, names: Sequence[str]) -> DataFrame:
    keep = [c for c in df.columns if c != "q"]
    return df.select(*keep, *[F.col("q")[i].alias(n) for i, n in enumerate(names)])


def describe_numeric(df: DataFrame, features: Sequence[str], cfg: Config = DEFAULT) -> DataFrame:
    """A11 (numeric): count, mean, std, min, quartiles, max."""
    out = _with_q(per_feature(df, features, _num_stats(cfg)), df, features, [0.25, 0.5, 0.75], cfg=cfg)
    out = _explode_q(out, ["p25", "p50", "p75"])
    return out.select("feature", "n", "mean", "std", "min", "p25", "p50", "p75", "max")


def describe_by_class(df: DataFrame, features: Sequence[str], target: str, cfg: Config = DEFAULT) -> DataFrame:
    """Per class and feature the 9-percentile describe; one grouped aggregate."""
    t = df.withColumn("_class", col(target).cast("string"))
    out = _with_q(per_feature(t, features, _num_stats(cfg), by=["_class"]), t, features, cfg.percentiles, ["_class"], cfg)
    out = _explode_q(out, PCT_NAMES).withColumnRenamed("_class", "class")
    return out.select("class", "feature", "n", "mean", "std", "min", *PCT_NAMES, "max")


def _top_value(counts: DataFrame, keys: Sequence[str] = ("feature",)) -> DataFrame:
    """Most frequent value per key (ties -> smallest value) as an aggregate (no window)."""
    best = F.min_by(F.struct("value", "n"), F.struct((-F.col("n")).alias("neg"), F.col("value")))
    return (counts.groupBy(*keys)
            .agg(best.alias("_b"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("n_unique"))
            .select(*keys, "n", "n_unique", F.col("_b.value").alias("top"), F.col("_b.n").alias("top_n")))


def describe_categorical(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """A11 (categorical): count, unique, top, freq."""
    return _top_value(value_counts(df, cols)).select(
        "feature", "n", "n_unique", "top", F.col("top_n").alias("freq"))


def summary_extended(df: DataFrame, features: Sequence[str], cfg: Config = DEFAULT) -> DataFrame:
    """Describe + population skew / excess kurtosis, IQR, P1/P5/P95/P99, missing."""
    probs = [0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99]

    def make(i, f):
        c = col(f).cast("double")
        return {"n": F.count(c), "n_null": F.count_if(c.isNull()), "mean": F.avg(c), "std": F.stddev_samp(c),
                "min": F.min(c), "max": F.max(c), "skew": F.skewness(c), "kurt": F.kurtosis(c)}
    out = _explode_q(_with_q(per_feature(df, features, make), df, features, probs, cfg=cfg),
                     ["p01", "p05", "p25", "p50", "p75", "p95", "p99"])
    return out.select("feature", "n", "n_null", "mean", "std", "min", "p01", "p05", "p25", "p50", "p75",
                      "p95", "p99", "max", (F.col("p75") - F.col("p25")).alias("iqr"), "skew", "kurt")


def numeric_advice(df: DataFrame, features: Sequence[str], cfg: Config = DEFAULT) -> DataFrame:
    """mean/median/std/min/max/skew (bias-corrected, as pandas) and transform advice."""
    def make(i, f):
        c = col(f).cast("double")
        return {"n": F.count(c), "mean": F.avg(c), "std": F.stddev_samp(c), "min": F.min(c), "max": F.max(c),
                "g1": F.skewness(c)}
    out = _with_q(per_feature(df, features, make), df, features, [0.5], cfg=cfg).withColumn("median", F.col("q")[0])
    skew = skew_corrected(F.col("g1"), F.col("n"))
    adv = F.when(F.abs(skew) > 1, "log transform").when(F.abs(skew) > 0.5, "sqrt transform").otherwise("none")
    return out.select("feature", "n", "mean", "median", "std", "min", "max", skew.alias("skew"),
                      adv.alias("advice"))


def numeric_compact(df: DataFrame, features: Sequence[str], cfg: Config = DEFAULT) -> DataFrame:
    """Compact numeric table with IQR-outlier %, zero % and negative % (two scans)."""
    from tabscope.plans.frames import quantile_scalar
    src = df.withColumn("_qs", quantile_scalar(df, features, [0.25, 0.75], cfg))
    s = F.col("_qs")

    def make(i, f):
        c = col(f).cast("double")
        q1, q3 = s.getField(f"q{i}")[0], s.getField(f"q{i}")[1]
        lo, hi = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
        return {"n": F.count(c), "mean": F.avg(c), "std": F.stddev_samp(c), "g1": F.skewness(c),
                "n_out": F.count_if((c < lo) | (c > hi)), "n_zero": F.count_if(c == 0),
                "n_neg": F.count_if(c < 0)}
    out = per_feature(src, features, make)
    return out.select("feature", "n", "mean", "std", skew_corrected(F.col("g1"), F.col("n")).alias("skew"),
                      (100.0 * F.col("n_out") / F.col("n")).alias("pct_outliers"),
                      (100.0 * F.col("n_zero") / F.col("n")).alias("pct_zero"),
                      (100.0 * F.col("n_neg") / F.col("n")).alias("pct_negative"))


# ------------------------------------------------------------ categorical
def category_summary(df: DataFrame, cols: Sequence[str], many_levels: int = 20) -> DataFrame:
    """Unique, top value and share, cardinality ratio, >20 levels flag."""
    top = _top_value(value_counts(df, cols))
    return top.select(
        "feature", "n", "n_unique", "top", "top_n", (100.0 * F.col("top_n") / F.col("n")).alias("top_pct"),
        (F.col("n_unique") / F.col("n")).alias("cardinality_ratio"),
        (F.col("n_unique") > many_levels).cast("int").alias("many_levels"))


def category_top(df: DataFrame, cols: Sequence[str], k: int = 30) -> DataFrame:
    """Top-k values per feature.  The ``row_number() <= k`` filter sits directly on the
    window so Spark plans a map-side WindowGroupLimit; feature totals come from a separate
    #features-row aggregate."""
    vc = value_counts(df, cols)
    w = Window.partitionBy("feature").orderBy(F.col("n").desc(), F.col("value"))
    top = vc.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    tot = vc.groupBy("feature").agg(F.sum("n").alias("_tot"))
    return top.join(tot, "feature").select("feature", "value", "n", (100.0 * F.col("n") / F.col("_tot")).alias("pct"),
                                           F.col("rank").cast("bigint"))


def rare_categories(df: DataFrame, cols: Sequence[str], cfg: Config = DEFAULT) -> DataFrame:
    """Values seen fewer than ``rare_count`` times or more than ``frequent_count`` times."""
    vc = value_counts(df, cols)
    kind = F.when(F.col("n") < cfg.rare_count, "rare").when(F.col("n") > cfg.frequent_count, "frequent")
    return vc.select("feature", "value", "n", kind.alias("kind")).where(F.col("kind").isNotNull())


def cardinality(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Distinct non-null values per column and ratio to rows."""
    cols = list(cols or df.columns)
    out = distinct_counts(df, cols)
    return out.select("feature", "n_unique", (F.col("n_unique") / F.col("n_rows")).alias("unique_ratio"))


def quasi_constant(df: DataFrame, cols: Sequence[str], threshold: float | None = None,
                   cfg: Config = DEFAULT) -> DataFrame:
    """Top-level share (nulls count as a level); constant when <= 1 level."""
    threshold = cfg.quasi_constant if threshold is None else threshold
    vc = value_counts(df, cols, dropna=False).withColumn("value", F.coalesce("value", F.lit("\u0000null")))
    top = _top_value(vc)
    share = F.col("top_n") / F.col("n")
    return top.select("feature", "n_unique", share.alias("top_share"),
                      (F.col("n_unique") <= 1).cast("int").alias("constant"),
                      (share > threshold).cast("int").alias("quasi_constant"))


def near_zero_variance(df: DataFrame, cols: Sequence[str], cfg: Config = DEFAULT) -> DataFrame:
    """Top share > 0.95 or distinct/rows < 0.01."""
    top = _top_value(value_counts(df, cols))
    share = F.col("top_n") / F.col("n")
    ratio = F.col("n_unique") / F.col("n")
    return top.select("feature", share.alias("top_share"), ratio.alias("unique_ratio"),
                      ((share > cfg.nzv_top_freq) | (ratio < cfg.nzv_unique_ratio)).cast("int").alias("nzv"))


def category_entropy(df: DataFrame, cols: Sequence[str], low: float = 0.3) -> DataFrame:
    """Shannon entropy in bits, its maximum log2(k) and the normalised value."""
    p = with_totals(value_counts(df, cols), rows="n").withColumn("p", F.col("n") / F.col("rows"))
    agg = p.groupBy("feature").agg((-F.sum(F.col("p") * F.log2("p"))).alias("entropy"),
                                   F.count(F.lit(1)).alias("n_levels"))
    mx = F.log2(F.col("n_levels").cast("double"))
    norm = F.when(F.col("n_levels") > 1, F.col("entropy") / mx).otherwise(F.lit(0.0))
    return agg.select("feature", "n_levels", "entropy", mx.alias("max_entropy"), norm.alias("normalized"),
                      (norm < low).cast("int").alias("low"))


# ------------------------------------------------------------ target / class
def target_distribution(df: DataFrame, target: str) -> DataFrame:
    """Count, share and max/count ratio per class."""
    g = df.groupBy(col(target).cast("string").alias("class")).agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy()  # tiny: one row per class
    return g.select("class", "n", (100.0 * F.col("n") / F.sum("n").over(w)).alias("pct"),
                    (F.max("n").over(w) / F.col("n")).alias("ratio"))


def imbalance_verdict(df: DataFrame, target: str) -> DataFrame:
    """max/min shares and ratios with the severity bands (>.8 severe, >.6 moderate; ratio>10)."""
    g = df.groupBy(col(target)).agg(F.count(F.lit(1)).alias("n"))
    a = g.agg(F.count(F.lit(1)).alias("n_classes"), F.sum("n").alias("n_rows"), F.max("n").alias("mx"),
              F.min("n").alias("mn"))
    mx_share = F.col("mx") / F.col("n_rows")
    ratio = F.col("mx") / F.col("mn")
    verdict = (F.when(mx_share > 0.8, "severe").when(mx_share > 0.6, "moderate")
               .when(ratio > 10, "minority rare").otherwise("balanced"))
    return a.select("n_classes", mx_share.alias("max_share"), (F.col("mn") / F.col("n_rows")).alias("min_share"),
                    ratio.alias("max_min_ratio"), (F.col("mn") / F.col("mx")).alias("min_max_ratio"),
                    verdict.alias("verdict"))


def target_regression(df: DataFrame, target: str, cfg: Config = DEFAULT) -> DataFrame:
    """Regression target stats incl. pandas-style skew/kurtosis, zero and negative ratios."""
    from tabscope.plans.frames import quantile_scalar
    c = col(target).cast("double")
    df = df.withColumn("_qs", quantile_scalar(df, [target], [0.25, 0.5, 0.75], cfg))
    qs = F.col("_qs")
    a = df.agg(F.count(c).alias("n"), F.avg(c).alias("mean"), F.stddev_samp(c).alias("std"),
               F.min(c).alias("min"), F.first(qs.getField("q0")).alias("q"), F.max(c).alias("max"),
               F.skewness(c).alias("g1"), F.kurtosis(c).alias("g2"),
               F.avg((c == 0).cast("double")).alias("zero_ratio"), F.avg((c < 0).cast("double")).alias("negative_ratio"))
    return a.select("n", "mean", "std", "min", F.col("q")[0].alias("p25"), F.col("q")[1].alias("p50"),
                    F.col("q")[2].alias("p75"), "max", skew_corrected(F.col("g1"), F.col("n")).alias("skew"),
                    kurt_corrected(F.col("g2"), F.col("n")).alias("kurt"), "zero_ratio", "negative_ratio")


def category_target_stats(df: DataFrame, cols: Sequence[str], y: Column) -> DataFrame:
    """Per (feature, value) count, share, target mean / std / positives."""
    lv = df.select(*[col(c).cast("string").alias(c) for c in cols], y.cast("double").alias("_y"))
    lv = lv.unpivot(["_y"], list(cols), "feature", "value").where(F.col("value").isNotNull())
    g = lv.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"), F.avg("_y").alias("target_mean"),
                                           F.stddev_samp("_y").alias("target_std"),
                                           F.sum("_y").alias("positives"))
    return with_totals(g, rows="n").withColumn("pct", 100.0 * F.col("n") / F.col("rows")).drop("rows")


def crosstab(df: DataFrame, cols: Sequence[str], target: str) -> DataFrame:
    """Long contingency table with row-normalised share."""
    t = df.withColumn("_class", col(target).cast("string")).where(F.col("_class").isNotNull())
    vc = value_counts(t, cols, by=["_class"]).withColumnRenamed("_class", "class")
    row = Window.partitionBy("feature", "value")
    return vc.withColumn("row_share", F.col("n") / F.sum("n").over(row))


def category_top_class(df: DataFrame, cols: Sequence[str], target: str) -> DataFrame:
    """Dominant class and its share for each category value."""
    ct = crosstab(df, cols, target)
    best = F.min_by(F.struct("class", "n"), F.struct((-F.col("n")).alias("neg"), F.col("class")))
    g = ct.groupBy("feature", "value").agg(best.alias("_b"), F.sum("n").alias("n"))
    return g.select("feature", "value", "n", F.col("_b.class").alias("top_class"),
                    (F.col("_b.n") / F.col("n")).alias("top_share"))


def class_means(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """Mean of every numeric per class (one grouped aggregate)."""
    t = df.withColumn("_class", col(target).cast("string"))
    out = per_feature(t, features, {"mean": lambda c: F.avg(c.cast("double"))}, by=["_class"])
    return out.withColumnRenamed("_class", "class")


# ------------------------------------------------------------ types / text
def dtype_advice(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Narrowing advice from min/max/integrality (double->float, long->byte/short/int, string->category)."""
    cols = list(cols or df.columns)
    dt = _dtypes(df)

    def make(i, f):
        c = col(f)
        if dt[f] in ("double", "float", "bigint", "int", "smallint", "tinyint"):
            d = c.cast("double")
            return {"mn": F.min(d), "mx": F.max(d), "n_frac": F.count_if(d != F.floor(d)),
                    "ratio": F.lit(None).cast("double")}
        return {"mn": F.lit(None).cast("double"), "mx": F.lit(None).cast("double"), "n_frac": F.lit(0).cast("bigint"),
                "ratio": F.count_distinct(c) / F.count(F.lit(1))}
    out = per_feature(df, cols, make)
    types = F.create_map(*[x for f in cols for x in (F.lit(f), F.lit(dt[f]))])
    t = types[F.col("feature")]
    integral = t.isin("bigint", "int", "smallint", "tinyint") | ((t == "double") & (F.col("n_frac") == 0))
    adv = (F.when(integral & (F.col("mn") >= -128) & (F.col("mx") <= 127), "tinyint")
           .when(integral & (F.col("mn") >= -32768) & (F.col("mx") <= 32767), "smallint")
           .when(integral & (F.col("mn") >= -2147483648) & (F.col("mx") <= 2147483647), "int")
           .when(t == "double", "float")
           .when((t == "string") & (F.col("ratio") < 0.5), "category")
           .otherwise("keep"))
    return out.select("feature", t.alias("dtype"), "mn", "mx", adv.alias("advice"))


NUMERIC_TEXT = r"^\d+\.?\d*$"
DATE_TEXT = r"\d{4}-\d{2}-\d{2}"


def suspicious_types(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Share of numeric-looking (>.8) and date-looking (>.5) strings; single-valued columns."""
    out = per_feature(df, cols, lambda i, f: {
        "n": F.count(F.lit(1)),
        "n_numeric": F.count_if(F.coalesce(col(f).cast("string"), F.lit("nan")).rlike(NUMERIC_TEXT)),
        "n_date": F.count_if(F.coalesce(col(f).cast("string"), F.lit("nan")).rlike(DATE_TEXT)),
        "n_unique": F.count_distinct(col(f)),
    })
    num = F.col("n_numeric") / F.col("n")
    dat = F.col("n_date") / F.col("n")
    return out.select("feature", num.alias("numeric_share"), dat.alias("date_share"), "n_unique",
                      (num > 0.8).cast("int").alias("looks_numeric"), (dat > 0.5).cast("int").alias("looks_date"),
                      (F.col("n_unique") == 1).cast("int").alias("constant"))


def text_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """A string column is text when mean length > 50 or mean word count > 5."""
    def make(i, f):
        c = col(f).cast("string")
        words = F.size(F.split(F.trim(c), r"\s+"))
        return {"n": F.count(c), "avg_len": F.avg(F.length(c).cast("double")),
                "avg_words": F.avg(F.when(c.isNotNull(), words.cast("double"))),
                "max_len": F.max(F.length(c)).cast("bigint"), "n_unique": F.count_distinct(c)}
    out = per_feature(df, cols, make)
    return out.select("feature", "avg_len", "avg_words", "max_len",
                      (100.0 * F.col("n_unique") / F.col("n")).alias("unique_pct"),
                      ((F.col("avg_len") > 50) | (F.col("avg_words") > 5)).cast("int").alias("is_text"))


# ------------------------------------------------------------ rules
def business_rules(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Named violation predicates counted in one aggregate."""
    names = list(rules)
    agg = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count_if(rules[r]).alias(f"_r{i}") for i, r in enumerate(names)])
    rows = F.array(*[F.struct(F.lit(r).alias("rule"), F.col(f"_r{i}").alias("n_violations")) for i, r in enumerate(names)])
    return agg.select(F.inline(rows), "_n").select(
        "rule", "n_violations", (100.0 * F.col("n_violations") / F.col("_n")).alias("pct"))


def default_rules(df: DataFrame) -> dict[str, Column]:
    """Rules derived from column names with word-boundary patterns."""
    import re
    rules = {}
    for f, t in df.dtypes:
        low = f.lower()
        if re.search(r"(^|_)age($|_)", low) and t not in ("string",):
            rules[f"{f}: age outside [0,120]"] = (col(f) < 0) | (col(f) > 120)
        if re.search(r"(price|amount|salary|income|revenue|bal)", low) and t not in ("string",):
            rules[f"{f}: negative"] = col(f) < 0
        if "email" in low:
            rules[f"{f}: missing @"] = ~col(f).contains("@")
    by_name = {f.lower(): f for f in df.columns}
    for low, f in by_name.items():
        end = by_name.get(low.replace("start", "end"))
        if "start" in low and "date" in low and end:
            rules[f"{f}: after {end}"] = _day(df, f) > _day(df, end)
    return rules


def _day(df: DataFrame, f: str) -> Column:
    """A date or timestamp as it is, text that reads as one parsed (null otherwise)."""
    return F.try_to_timestamp(col(f)) if dict(df.dtypes)[f] == "string" else col(f)


# Benford expected first-digit shares are log10(1 + 1/d), d = 1..9.
def benford(df: DataFrame, features: Sequence[str], min_n: int = 100) -> DataFrame:
    """First significant digit counts vs Benford; chi-square statistic and mean absolute deviation."""
    import math
    expected = [math.log10(1 + 1 / d) for d in range(1, 10)]

    def make(i, f):
        x = col(f).cast("double")
        digit = F.regexp_extract(F.abs(x).cast("string"), r"([1-9])", 1)
        ok = x.isNotNull() & (x != 0)
        return {f"n{d}": F.count_if(ok & (digit == str(d))) for d in range(1, 10)}
    out = per_feature(df, features, make)
    n = sum((F.col(f"n{d}") for d in range(1, 10)), F.lit(0))
    chi2 = sum(((F.col(f"n{d}") - n * e) ** 2 / (n * e) for d, e in zip(range(1, 10), expected)), F.lit(0.0))
    mad = sum((F.abs(F.col(f"n{d}") / n - e) for d, e in zip(range(1, 10), expected)), F.lit(0.0)) / 9.0
    return out.select("feature", n.cast("bigint").alias("n"), chi2.alias("chi2"), mad.alias("mad"),
                      (F.col("n1") / n).alias("share_1")).where(F.col("n") >= min_n)


def category_compact(train: DataFrame, test: DataFrame, cols: Sequence[str], cfg: Config = DEFAULT) -> DataFrame:
    """Unique count, top share, rare (<1 %) level count and test levels unseen in train."""
    vc = value_counts(train, cols)
    v = with_totals(vc, rows="n").withColumn("share", F.col("n") / F.col("rows"))
    a = v.groupBy("feature").agg(F.count(F.lit(1)).alias("n_unique"), F.max("share").alias("top_share"),
                                 F.count_if(F.col("share") < cfg.rare_share).alias("n_rare"))
    tv = value_counts(test, cols).select("feature", "value")
    unseen = tv.join(vc.select("feature", "value"), ["feature", "value"], "left_anti") \
        .groupBy("feature").agg(F.count(F.lit(1)).alias("n_unseen"))
    return a.join(unseen, "feature", "left").select(
        "feature", "n_unique", (100.0 * F.col("top_share")).alias("top_pct"), "n_rare",
        F.coalesce("n_unseen", F.lit(0)).cast("bigint").alias("n_unseen"))


def column_audit(train: DataFrame, test: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Per column for both tables: distinct, null %, top-value share; null gap."""
    def side(df, tag):
        vc = value_counts(df, cols, dropna=False)
        g = vc.groupBy("feature").agg(
            F.sum("n").alias("n"), F.count_if(F.col("value").isNotNull()).alias("n_unique"),
            F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(0)).alias("n_null"),
            F.max(F.when(F.col("value").isNotNull(), F.col("n"))).alias("top_n"))
        return g.select("feature", F.col("n_unique").alias(f"n_unique_{tag}"),
                        (100.0 * F.col("n_null") / F.col("n")).alias(f"null_pct_{tag}"),
                        (100.0 * F.col("top_n") / F.col("n")).alias(f"top_pct_{tag}"))
    j = side(train, "train").join(side(test, "test"), "feature", "full_outer")
    return j.withColumn("null_gap", F.abs(F.col("null_pct_train") - F.col("null_pct_test")))


def numeric_compare(train: DataFrame, test: DataFrame, features: Sequence[str]) -> DataFrame:
    """Means and stds of both sides; |mean diff| > train std flags."""
    def side(df, tag):
        return per_feature(df, features, {"mean": lambda c: F.avg(c.cast("double")),
                                          "std": lambda c: F.stddev_samp(c.cast("double"))}) \
            .select("feature", F.col("mean").alias(f"mean_{tag}"), F.col("std").alias(f"std_{tag}"))
    j = side(train, "train").join(side(test, "test"), "feature")
    diff = F.abs(F.col("mean_train") - F.col("mean_test"))
    return j.select("feature", "mean_train", "mean_test", "std_train", "std_test", diff.alias("mean_diff"),
                    (diff > F.col("std_train")).cast("int").alias("shifted"))


def category_compare(train: DataFrame, test: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Unique counts and top values of both sides and levels not present in test."""
    a = _top_value(value_counts(train, cols)).select(
        "feature", F.col("n_unique").alias("n_unique_train"), F.col("top").alias("top_train"))
    b = _top_value(value_counts(test, cols)).select(
        "feature", F.col("n_unique").alias("n_unique_test"), F.col("top").alias("top_test"))
    only = (value_counts(train, cols).select("feature", "value")
            .join(value_counts(test, cols).select("feature", "value"), ["feature", "value"], "left_anti")
            .groupBy("feature").agg(F.count(F.lit(1)).alias("n_not_in_test")))
    return a.join(b, "feature", "full_outer").join(only, "feature", "left").select(
        "feature", "n_unique_train", "n_unique_test", "top_train", "top_test",
        F.coalesce("n_not_in_test", F.lit(0)).cast("bigint").alias("n_not_in_test"))


# ------------------------------------------------------------ outliers
def outliers_iqr(df: DataFrame, features: Sequence[str], k: float = 1.5, cfg: Config = DEFAULT) -> DataFrame:
    """IQR fences, outlier count and %, action band (>10 % high, >5 % medium, >0 low)."""
    from tabscope.operators.cleaning import iqr_bounds
    b = iqr_bounds(df, list(features), k, cfg)
    src = df.withColumn("_b", b)

    def make(i, f):
        x = col(f).cast("double")
        lo, hi = F.col("_b").getField(f"lo{i}"), F.col("_b").getField(f"hi{i}")
        return {"lower": F.first(lo), "upper": F.first(hi), "n": F.count(x), "n_out": F.count_if((x < lo) | (x > hi))}
    out = per_feature(src, features, make)
    pct = 100.0 * F.col("n_out") / F.col("n")
    band = F.when(pct > 10, "high").when(pct > 5, "medium").when(pct > 0, "low").otherwise("none")
    return out.select("feature", "lower", "upper", "n_out", pct.alias("pct_out"), band.alias("severity"))


def outliers_z(df: DataFrame, features: Sequence[str], z: float = 3.0, k: float = 1.5, cfg: Config = DEFAULT) -> DataFrame:
    """|z| > 3 with the population std, IQR count, and the mixed (IQR + Z) / 2 percentage."""
    from tabscope.operators.cleaning import iqr_bounds
    b = iqr_bounds(df, list(features), k, cfg)
    m = scalar_row(df.agg(*[x for i, f in enumerate(features) for x in (F.avg(col(f).cast("double")).alias(f"a{i}"),
                                                                         F.stddev_pop(col(f).cast("double")).alias(f"s{i}"))]))
    src = df.withColumn("_b", b).withColumn("_m", m)

    def make(i, f):
        x = col(f).cast("double")
        zz = F.abs(F.try_divide(x - F.col("_m").getField(f"a{i}"), F.col("_m").getField(f"s{i}")))
        lo, hi = F.col("_b").getField(f"lo{i}"), F.col("_b").getField(f"hi{i}")
        return {"n": F.count(x), "n_z": F.count_if(zz > z), "n_iqr": F.count_if((x < lo) | (x > hi))}
    out = per_feature(src, features, make)
    return out.select("feature", "n_z", "n_iqr", (100.0 * F.col("n_z") / F.col("n")).alias("pct_z"),
                      (100.0 * (F.col("n_z") + F.col("n_iqr")) / 2.0 / F.col("n")).alias("pct_mixed"))


def outliers_compare(train: DataFrame, test: DataFrame, features: Sequence[str], gap_pp: float = 5.0,
                     k: float = 1.5, cfg: Config = DEFAULT) -> DataFrame:
    """IQR outlier % per side, each side with its own fences; gap > 5 points flags."""
    a = outliers_iqr(train, features, k, cfg).select("feature", F.col("pct_out").alias("pct_train"))
    t = outliers_iqr(test, features, k, cfg).select("feature", F.col("pct_out").alias("pct_test"))
    j = a.join(t, "feature")
    gap = F.abs(F.col("pct_train") - F.col("pct_test"))
    return j.select("feature", "pct_train", "pct_test", gap.alias("gap"), (gap > gap_pp).cast("int").alias("flag"))


def outliers_by_class(df: DataFrame, features: Sequence[str], target: str, lo: float = 0.01, hi: float = 0.99,
                      cfg: Config = DEFAULT) -> DataFrame:
    """Share of rows outside the global [p1, p99] band, per class."""
    from tabscope.plans.frames import quantile_scalar
    s = quantile_scalar(df, features, [lo, hi], cfg)
    src = df.withColumn("_q", s).withColumn("_cls", col(target).cast("string"))

    def make(i, f):
        x = col(f).cast("double")
        q = F.col("_q").getField(f"q{i}")
        return {"n": F.count(x), "n_out": F.count_if((x < q[0]) | (x > q[1]))}
    out = per_feature(src, features, make, by=["_cls"])
    return out.select(F.col("_cls").alias("class"), "feature", "n", "n_out",
                      (100.0 * F.col("n_out") / F.col("n")).alias("pct_out"))
