"""Association, hypothesis tests, drift and leakage.

Building blocks:
* all-pairs correlations are one aggregate with one ``corr`` per pair;
* categorical association works on a pair-contingency cube
  ``(pair, a, b, n)`` produced by one exploded, map-side-combined group-by;
* tests on numeric distributions (KS, ECDF, ranks) pre-aggregate to
  ``(feature, value) -> count`` before any window, so window input is bounded
  by distinct values, not rows;
* quantile edges / fences are struct scalar subqueries (one small job, no
  join, no collect).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabscope.config import DEFAULT, Config
from tabscope.functions.exprs import col, equal_width_bin, pearson
from tabscope.plans.blocks import written
from tabscope.plans.frames import distinct_counts, per_feature, quantiles, scalar_row, with_totals

MISSING = "_NA_"


def _pairs(cols):
    return [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]


def _nan_null(c: Column) -> Column:
    return F.nanvl(c, F.lit(None).cast("double"))


# ------------------------------------------------------------ correlation
def moment_grid(df: DataFrame, left: Sequence[Column], right: Sequence[Column]) -> DataFrame:
    """``(i, j, n, r)``: Pearson correlation of every left with every right expression over the rows where both have a
    value (null and NaN have none); ``r`` is null where a side doesn't vary.

    One pass multiplies matrices of values and of their presence, batch by batch, after a shift by the means; a task keeps
    six numbers a pair whatever its rows, and no aggregate holds an expression for each pair, so hundreds of columns fit."""
    x = df.select(*[F.nanvl(c.cast("double"), F.lit(None)).alias(f"v{k}") for k, c in enumerate([*left, *right])])
    p, q = len(left), len(right)
    shift = [float(v or 0.0) for v in x.agg(*[F.avg(f"v{k}") for k in range(p + q)]).first()]
    rows = x.select(F.array(*[F.col(f"v{k}") - F.lit(s) for k, s in enumerate(shift)]).alias("z"))

    def run(batches):
        total = np.zeros((6, p, q))
        for b in batches:
            z = b.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, p + q)
            have = ~np.isnan(z)
            z, have = np.where(have, z, 0.0), have.astype(float)
            a, c, m, w = z[:, :p], z[:, p:], have[:, :p], have[:, p:]
            for k, (one, two) in enumerate(((m, w), (a, w), (m, c), (a * a, w), (m, c * c), (a, c))):
                total[k] += one.T @ two
        i, j = np.indices((p, q))
        yield pa.RecordBatch.from_arrays([pa.array(i.ravel(), pa.int32()), pa.array(j.ravel(), pa.int32()), *[pa.array(t.ravel()) for t in total]],
                                         names=["i", "j", "n", "a", "c", "aa", "cc", "ac"])
    g = rows.mapInArrow(run, "i int, j int, n double, a double, c double, aa double, cc double, ac double")
    g = g.groupBy("i", "j").agg(*[F.sum(k).alias(k) for k in ("n", "a", "c", "aa", "cc", "ac")])
    n = F.col("n")

    def spread(k: str, means: list[float], place: str) -> tuple[Column, Column]:
        var = F.try_divide(F.col(k + k) - F.try_divide(F.col(k) * F.col(k), n), n)
        return var, var > F.pow(F.get(F.array(*[F.lit(abs(s) * 1e-13) for s in means]), F.col(place)), F.lit(2.0))
    (va, ga), (vc, gc) = spread("a", shift[:p], "i"), spread("c", shift[p:], "j")
    cov = F.try_divide(F.col("ac") - F.try_divide(F.col("a") * F.col("c"), n), n)
    r = F.when(ga & gc, F.greatest(F.least(F.try_divide(cov, F.sqrt(va) * F.sqrt(vc)), F.lit(1.0)), F.lit(-1.0)))
    return g.select("i", "j", n.cast("bigint").alias("n"), r.alias("r"))


#: Pairs that one JVM aggregate takes at most; more columns go through the grid.
AGGREGATE_PAIRS = 64


def corr_pairs(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pairwise-complete Pearson r for all pairs a<b: one aggregate for few columns, one grid of moments for many."""
    pairs = _pairs(list(cols))
    if 0 < len(pairs) <= AGGREGATE_PAIRS:
        agg = df.agg(*[pearson(col(a).cast("double"), col(b).cast("double")).alias(f"_r{k}") for k, (a, b) in enumerate(pairs)])
        rows = F.array(*[F.struct(F.lit(a).alias("feature_a"), F.lit(b).alias("feature_b"),
                                  _nan_null(F.col(f"_r{k}")).alias("corr")) for k, (a, b) in enumerate(pairs)])
        return agg.select(F.inline(rows)).withColumn("abs_corr", F.abs("corr"))
    x, names = [col(c) for c in cols], F.array(*[F.lit(c) for c in cols])
    g = moment_grid(df, x, x).where("i < j")
    return g.select(F.get(names, F.col("i")).alias("feature_a"), F.get(names, F.col("j")).alias("feature_b"),
                    F.col("r").alias("corr")).withColumn("abs_corr", F.abs("corr"))


def high_corr_pairs(df: DataFrame, cols: Sequence[str], threshold: float = 0.7) -> DataFrame:
    """Pairs with |r| above a threshold."""
    return corr_pairs(df, cols).where(F.col("abs_corr") > threshold)


def average_ranks(df: DataFrame, column: str, out: str | None = None) -> DataFrame:
    """Value -> average (1-based) rank, from value counts + one running sum.

    The window runs over distinct values only; for columns with billions of
    distinct values Spark range-partitions the ordered window input."""
    from tabscope.plans.frames import running_sum
    cnt = df.where(col(column).isNotNull()).groupBy(col(column).alias("_v")).agg(F.count(F.lit(1)).alias("_k"))
    r = running_sum(cnt, ["_v"], "_k", out="_cum")
    before = F.col("_cum") - F.col("_k")
    return r.select(F.col("_v").alias(column), (before + (F.col("_k") + 1) / 2.0).alias(out or f"{column}_rank"),
                    F.col("_k"))


def with_ranks(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Attach ``<c>_rank`` average ranks for every column (one join per column;
    AQE broadcasts rank tables that turn out small)."""
    out = df
    for c in cols:
        out = out.join(average_ranks(df, c).drop("_k"), c, "left")
    return out


def corr_spearman(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Spearman = Pearson on average ranks of the rows that are complete in the pair.

    Columns without nulls share one ranking; a pair with nulls is ranked on its own complete rows."""
    data = df.select(*[col(c) for c in cols])
    seen = data.agg(*[F.count_if(col(c).isNull()).alias(f"_n{i}") for i, c in enumerate(cols)]).first()
    full = [c for i, c in enumerate(cols) if not seen[f"_n{i}"]]
    pairs = _pairs(list(cols))

    def correlated(some: list[tuple[str, str]]) -> DataFrame:
        names = [c for c in cols if any(c in p for p in some)]
        rows = data.select(*[col(c) for c in names]).na.drop()
        r = with_ranks(rows, names)
        agg = r.agg(*[pearson(F.col(f"{a}_rank"), F.col(f"{b}_rank")).alias(f"_r{k}") for k, (a, b) in enumerate(some)])
        return agg.select(F.inline(F.array(*[
            F.struct(F.lit(a).alias("feature_a"), F.lit(b).alias("feature_b"), _nan_null(F.col(f"_r{k}")).alias("spearman"))
            for k, (a, b) in enumerate(some)])))
    whole = [p for p in pairs if p[0] in full and p[1] in full]
    parts = ([correlated(whole)] if whole else []) + [correlated([p]) for p in pairs if p not in whole]
    out = parts[0]
    for x in parts[1:]:
        out = out.unionByName(x)
    return out


def corr_discrepancy(df: DataFrame, cols: Sequence[str], gap: float = 0.2) -> DataFrame:
    """T5: |Pearson - Spearman| > gap marks a non-linear / outlier-driven relation."""
    p = corr_pairs(df, cols).select("feature_a", "feature_b", F.col("corr").alias("pearson"))
    s = corr_spearman(df, cols)
    j = p.join(s, ["feature_a", "feature_b"])
    d = F.abs(F.col("pearson") - F.col("spearman"))
    return j.select("feature_a", "feature_b", "pearson", "spearman", d.alias("gap"), (d > gap).cast("int").alias("flag"))


def target_corr(df: DataFrame, features: Sequence[str], y: Column, top: int = 15) -> DataFrame:
    """R with the target, strength bands .7/.5/.3, top-k by |r|."""
    out = per_feature(df, features, lambda i, f: {"corr": _nan_null(pearson(col(f).cast("double"), y.cast("double")))})
    a = F.abs("corr")
    band = F.when(a > 0.7, "strong").when(a > 0.5, "moderate").when(a > 0.3, "weak").otherwise("very weak")
    w = Window.orderBy(a.desc(), F.col("feature"))
    return (out.select("feature", "corr", a.alias("abs_corr"), band.alias("strength"))
            .withColumn("rank", F.row_number().over(w).cast("bigint")).where(F.col("rank") <= top))


def target_corr_gap(df: DataFrame, features: Sequence[str], target: str, gap: float = 0.10,
                    cfg: Config = DEFAULT) -> DataFrame:
    """After median fill, Pearson vs Spearman with the target; gap > .10 => non-linear."""
    from tabscope.plans.frames import quantile_scalar
    med = quantile_scalar(df, features, [0.5], cfg, prefix="m")
    filled = df.select(col(target).cast("double").alias("_y"),
                       *[F.coalesce(col(f).cast("double"), med.getField(f"m{i}")[0]).alias(f) for i, f in enumerate(features)])
    r = with_ranks(filled, [*features, "_y"])
    out = per_feature(r, features, lambda i, f: {
        "pearson": _nan_null(pearson(col(f), F.col("_y"))),
        "spearman": _nan_null(pearson(F.col(f"{f}_rank"), F.col("_y_rank")))})
    g = F.abs(F.col("pearson") - F.col("spearman"))
    return out.select("feature", "pearson", "spearman", g.alias("gap"), (g > gap).cast("int").alias("nonlinear"))


def vif(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """VIF = diag(inverse correlation matrix) on complete rows.

    The p x p matrix comes from the correlation pairs (a grid of moments for many
    columns); only that matrix (p = number of features) is inverted on the driver.  A constant
    column, or one that only constants stand beside, has a null VIF and risk."""
    import numpy as np
    complete = df.select(*[col(f).cast("double").alias(f) for f in features]).na.drop()
    found = corr_pairs(complete, features).where("corr is not null").collect() if len(features) > 1 else []
    held = [f for f in features if len(features) == 1 or any(f in (r["feature_a"], r["feature_b"]) for r in found)]
    m = np.eye(len(held))
    for r in found:
        i, j = held.index(r["feature_a"]), held.index(r["feature_b"])
        m[i, j] = m[j, i] = r["corr"]
    inv = np.linalg.pinv(m) if held else m
    spark = df.sparkSession
    vals = [(f, float(inv[held.index(f), held.index(f)]) if f in held else None) for f in features]
    out = spark.createDataFrame(vals, "feature string, vif double")
    return out.withColumn("risk", F.when(F.col("vif") > 10, "high").when(F.col("vif") > 5, "moderate").when(F.col("vif") <= 5, "low"))


# ------------------------------------------------------------ contingency
def pair_cube(df: DataFrame, pairs: Sequence[tuple[str, str]], fill_null: str | None = MISSING,
              dropna: bool = False) -> DataFrame:
    """``(a_name, b_name, a, b, n)`` for many column pairs in one exploded group-by."""
    def v(c):
        x = col(c).cast("string")
        return F.coalesce(x, F.lit(fill_null)) if fill_null is not None else x
    arr = F.array(*[F.struct(F.lit(a).alias("a_name"), F.lit(b).alias("b_name"), v(a).alias("a"), v(b).alias("b"))
                    for a, b in pairs])
    x = df.select(F.inline(arr))
    if dropna:
        x = x.where(F.col("a").isNotNull() & F.col("b").isNotNull())
    return x.groupBy("a_name", "b_name", "a", "b").agg(F.count(F.lit(1)).alias("n"))


def chi2_from_cube(cube: DataFrame, yates: bool = True) -> DataFrame:
    """Pearson chi-square per pair from observed non-zero cells.

    chi2 = sum(O^2 / E) - n over observed cells (zero cells cancel out);
    for 2x2 tables the Yates-corrected value uses |O - E| (equal in all four
    cells) and sum(1/E) = n * sum(1/r_i) * sum(1/c_j)."""
    k = ["a_name", "b_name"]
    wr, wc, wn = Window.partitionBy(*k, "a"), Window.partitionBy(*k, "b"), Window.partitionBy(*k)
    c = cube.select(*k, "a", "b", "n", F.sum("n").over(wr).alias("r"), F.sum("n").over(wc).alias("c"),
                    F.sum("n").over(wn).alias("tot"), F.count(F.lit(1)).over(wr).alias("cells_r"),
                    F.count(F.lit(1)).over(wc).alias("cells_c"))
    c = c.withColumn("expected", F.col("r") * F.col("c") / F.col("tot"))
    # sum over rows of 1/r_i (and columns of 1/c_j) taken over cells: each row's 1/r spread over its cells
    g = c.groupBy(*k).agg(
        (F.sum(F.col("n") * F.col("n") / F.col("expected")) - F.first("tot")).alias("chi2_raw"),
        F.first("tot").alias("n_tot"),
        F.round(F.sum(1.0 / F.col("cells_r"))).cast("bigint").alias("k_a"),
        F.round(F.sum(1.0 / F.col("cells_c"))).cast("bigint").alias("k_b"),
        F.first(F.abs(F.col("n") - F.col("expected"))).alias("d"),
        F.sum(1.0 / (F.col("r") * F.col("cells_r"))).alias("inv_r"),
        F.sum(1.0 / (F.col("c") * F.col("cells_c"))).alias("inv_c"))
    dof = (F.col("k_a") - 1) * (F.col("k_b") - 1)
    corr = F.col("d") - F.least(F.lit(0.5), F.col("d"))
    chi2_yates = corr * corr * F.col("n_tot") * F.col("inv_r") * F.col("inv_c")
    chi2 = F.when((dof == 1) & F.lit(yates), chi2_yates).otherwise(F.col("chi2_raw"))
    return g.select(*k, F.col("n_tot").alias("n"), "k_a", "k_b", dof.cast("bigint").alias("dof"), F.greatest(chi2, F.lit(0.0)).alias("chi2"))


def cramers_v(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Cramer's V for all pairs (nulls as a level, Yates on 2x2)."""
    chi = chi2_from_cube(pair_cube(df, _pairs(list(cols))))
    md = F.greatest(F.least("k_a", "k_b") - 1, F.lit(1))
    return chi.select(F.col("a_name").alias("feature_a"), F.col("b_name").alias("feature_b"), "chi2",
                      F.sqrt(F.col("chi2") / (F.col("n") * md)).alias("cramers_v"))


def cramers_pairs(df: DataFrame, cols: Sequence[str], target: str | None = None, min_v: float = 0.5) -> DataFrame:
    """Pairs with V above ``min_v`` labelled (>.8 redundant, >.5 high); V with the target kept whole."""
    allc = list(cols) + ([target] if target else [])
    v = cramers_v(df, allc)
    risk = F.when(F.col("cramers_v") > 0.8, "redundant").when(F.col("cramers_v") > 0.5, "high").otherwise("low")
    tgt = (F.col("feature_b") == F.lit(target)) if target else F.lit(False)
    return v.select("feature_a", "feature_b", "cramers_v", risk.alias("risk"), tgt.cast("int").alias("with_target")) \
        .where((F.col("cramers_v") > min_v) | F.col("with_target").cast("boolean"))


def chi2_independence(df: DataFrame, cols: Sequence[str], target: str) -> DataFrame:
    """Chi-square of each categorical vs target (null rows dropped, Yates when dof = 1)."""
    chi = chi2_from_cube(pair_cube(df, [(c, target) for c in cols], fill_null=None, dropna=True))
    return chi.select(F.col("a_name").alias("feature"), "n", "dof", "chi2")


# ------------------------------------------------------------ p-values (one row per feature reaches the functions)
def _verdict(p: Column, alpha: float) -> Column:
    return F.when(p < alpha, "reject").when(p.isNotNull(), "keep")


def chi2_pvalues(df: DataFrame, cols: Sequence[str], target: str, alpha: float = 0.05) -> DataFrame:
    """Chi-square with its upper-tail p-value; ``reject`` independence under ``alpha``."""
    from tabscope.functions.special import chi2_sf_udf
    x = chi2_independence(df, cols, target)
    x = x.withColumn("p_value", F.when((F.col("dof") > 0) & F.col("chi2").isNotNull(), chi2_sf_udf(F.col("chi2"), F.col("dof").cast("double"))))
    return x.withColumn("independence", _verdict(F.col("p_value"), alpha))


def anova_pvalues(df: DataFrame, features: Sequence[str], target: str, alpha: float = 0.05) -> DataFrame:
    """One-way ANOVA F with its upper-tail p-value; ``reject`` equal means under ``alpha``."""
    from tabscope.functions.special import f_sf_udf
    x = anova_f(df, features, target)
    ok = F.col("f_stat").isNotNull() & (F.col("df_between") > 0) & (F.col("df_within") > 0)
    x = x.withColumn("p_value", F.when(ok, f_sf_udf(F.col("f_stat"), F.col("df_between").cast("double"), F.col("df_within").cast("double"))))
    return x.withColumn("equal_means", _verdict(F.col("p_value"), alpha))


def ks_pvalues(train: DataFrame, test: DataFrame, features: Sequence[str], alpha: float = 0.05) -> DataFrame:
    """Two-sample KS with its asymptotic p-value; ``reject`` equal distributions under ``alpha``."""
    from tabscope.functions.special import ks_pvalue_udf
    x = ks_2samp(train, test, features)
    x = x.withColumn("p_value", ks_pvalue_udf(F.col("ks_stat"), F.col("n_train").cast("double"), F.col("n_test").cast("double")))
    return x.withColumn("same_distribution", _verdict(F.col("p_value"), alpha))


def mcar_summary(df: DataFrame, features: Sequence[str], missing_cols: Sequence[str], alpha: float = 0.05) -> DataFrame:
    """Missing completely at random, Little-style: the sum of squared Welch t over all pairs against chi-square with
    as many degrees of freedom; ``reject`` under ``alpha``."""
    from tabscope.functions.special import chi2_sf_udf
    x = mcar_test(df, features, missing_cols).agg(F.sum(F.col("t_stat") ** 2).alias("stat"), F.count("t_stat").alias("dof"))
    x = x.withColumn("p_value", F.when(F.col("dof") > 0, chi2_sf_udf(F.col("stat"), F.col("dof").cast("double"))))
    return x.withColumn("mcar", _verdict(F.col("p_value"), alpha))


# ------------------------------------------------------------ group moments
def anova_f(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """One-way ANOVA F per numeric from per-class n / mean / variance."""
    from tabscope.plans.frames import class_moments
    m = class_moments(df.where(col(target).isNotNull()), features, [target])
    w = Window.partitionBy("feature")
    tot_n = F.sum("n").over(w)
    grand = F.try_divide(F.sum(F.col("n") * F.col("mean")).over(w), tot_n)
    x = m.select("feature", "n", "mean", "var", tot_n.alias("n_tot"), grand.alias("gm"))
    g = x.groupBy("feature").agg(
        F.sum(F.col("n") * (F.col("mean") - F.col("gm")) ** 2).alias("ssb"),
        F.sum((F.col("n") - 1) * F.coalesce(F.col("var"), F.lit(0.0))).alias("ssw"),
        F.count(F.lit(1)).alias("k"), F.first("n_tot").alias("n_tot"))
    f = F.try_divide(F.try_divide(F.col("ssb"), F.col("k") - 1), F.try_divide(F.col("ssw"), F.col("n_tot") - F.col("k")))
    return g.select("feature", (F.col("k") - 1).cast("bigint").alias("df_between"),
                    (F.col("n_tot") - F.col("k")).cast("bigint").alias("df_within"), f.alias("f_stat"))


def cohens_d(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """Cohen's d for every class pair (pooled sd), bands .2/.5/.8."""
    from tabscope.plans.frames import class_moments
    m = class_moments(df.withColumn("_cls", col(target).cast("string")).where(F.col("_cls").isNotNull()),
                      features, ["_cls"])
    a, b = m.alias("a"), m.alias("b")
    j = a.join(b, (F.col("a.feature") == F.col("b.feature")) & (F.col("a._cls") < F.col("b._cls")))
    pooled = F.sqrt(F.try_divide((F.col("a.n") - 1) * F.col("a.var") + (F.col("b.n") - 1) * F.col("b.var"),
                                 F.col("a.n") + F.col("b.n") - 2))
    d = F.try_divide(F.col("a.mean") - F.col("b.mean"), pooled)
    band = (F.when(F.abs(d) > 0.8, "large").when(F.abs(d) > 0.5, "medium").when(F.abs(d) > 0.2, "small")
            .otherwise("negligible"))
    return j.select(F.col("a.feature").alias("feature"), F.col("a._cls").alias("class_a"),
                    F.col("b._cls").alias("class_b"), d.alias("cohens_d"), band.alias("effect"))


Z975 = 1.959963984540054  # Fixed value: standard normal 97.5 % quantile


def mean_ci(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Mean, standard error and a 95 % interval (normal quantile; the Student t
    quantile for the exact n is in :func:`mean_ci_t`)."""
    out = per_feature(df, features, lambda i, f: {"n": F.count(col(f)), "mean": F.avg(col(f).cast("double")),
                                                  "std": F.stddev_samp(col(f).cast("double"))})
    se = F.col("std") / F.sqrt(F.col("n").cast("double"))
    return out.select("feature", "n", "mean", se.alias("se"), (F.col("mean") - Z975 * se).alias("lower"),
                      (F.col("mean") + Z975 * se).alias("upper"))


def mean_ci_t(df: DataFrame, features: Sequence[str], confidence: float = 0.95) -> DataFrame:
    """T16 with the Student t quantile (vectorised special function over #features rows)."""
    from tabscope.functions.special import t_quantile_udf
    base = mean_ci(df, features)
    t = t_quantile_udf(F.lit(0.5 + confidence / 2.0), (F.col("n") - 1).cast("double"))
    return base.select("feature", "n", "mean", "se", (F.col("mean") - t * F.col("se")).alias("lower"),
                       (F.col("mean") + t * F.col("se")).alias("upper"))


def normality_jb(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Jarque-Bera from population skew / excess kurtosis; p = exp(-JB/2) (chi-square, 2 dof)."""
    out = per_feature(df, features, lambda i, f: {"n": F.count(col(f)), "skew": F.skewness(col(f).cast("double")),
                                                  "kurt": F.kurtosis(col(f).cast("double"))})
    jb = F.col("n") / 6.0 * (F.col("skew") ** 2 + F.col("kurt") ** 2 / 4.0)
    return out.select("feature", "n", "skew", "kurt", jb.alias("jb"), F.exp(-jb / 2.0).alias("p_value"),
                      (F.exp(-jb / 2.0) > 0.05).cast("int").alias("normal"))


def mcar_test(df: DataFrame, features: Sequence[str], missing_cols: Sequence[str]) -> DataFrame:
    """Welch t of each numeric between rows where another column is missing
    vs observed; Little-style sum of t^2 is the sum over the output."""
    pairs = [(x, m) for m in missing_cols for x in features if x != m]

    def make(i, pair):
        x, m = pair.split("|")
        v = col(x).cast("double")
        miss = col(m).isNull()
        return {"n_miss": F.count(F.when(miss, v)), "n_obs": F.count(F.when(~miss, v)),
                "m_miss": F.avg(F.when(miss, v)), "m_obs": F.avg(F.when(~miss, v)),
                "v_miss": F.var_samp(F.when(miss, v)), "v_obs": F.var_samp(F.when(~miss, v))}
    names = [f"{x}|{m}" for x, m in pairs]
    out = per_feature(df, names, make)
    t = F.try_divide(F.col("m_miss") - F.col("m_obs"), F.sqrt(
        F.try_divide(F.col("v_miss"), F.col("n_miss")) + F.try_divide(F.col("v_obs"), F.col("n_obs"))))
    return out.select(F.split("feature", r"\|")[0].alias("feature"), F.split("feature", r"\|")[1].alias("missing_col"),
                      "n_miss", "n_obs", _nan_null(t).alias("t_stat"))


# ------------------------------------------------------------ two-sample drift
def _num_cube(train: DataFrame, test: DataFrame, features: Sequence[str]) -> DataFrame:
    """(feature, value double, n_train, n_test): one shuffle for all features."""
    def side(df, tag):
        lv = df.select(*[col(f).cast("double").alias(f) for f in features]).unpivot([], list(features), "feature", "value")
        return lv.where(F.col("value").isNotNull()).withColumn("side", F.lit(tag))
    u = side(train, 1).unionByName(side(test, 2))
    return u.groupBy("feature", "value").agg(F.count_if(F.col("side") == 1).alias("n_train"),
                                             F.count_if(F.col("side") == 2).alias("n_test"))


def ks_2samp(train: DataFrame, test: DataFrame, features: Sequence[str]) -> DataFrame:
    """Two-sample KS statistic D = max |F1 - F2| over distinct values."""
    from tabscope.plans.frames import running_sum
    cube = _num_cube(train, test, features)
    c = running_sum(cube, ["value"], ["n_train", "n_test"], by=["feature"], out=["c1", "c2"], total=["n1", "n2"])
    c = c.select("feature", (F.col("c1") / F.col("n1")).alias("f1"), (F.col("c2") / F.col("n2")).alias("f2"), "n1", "n2")
    return c.groupBy("feature").agg(F.max(F.abs(F.col("f1") - F.col("f2"))).alias("ks_stat"),
                                    F.first("n1").alias("n_train"), F.first("n2").alias("n_test"))


def psi_equal_width(train: DataFrame, test: DataFrame, features: Sequence[str], bins: int = 10,
                    clip: float = 1e-4) -> DataFrame:
    """PSI on equal-width bins over the joint min/max; shares clipped at 1e-4, not renormalised."""
    both = train.select(*features).unionByName(test.select(*features))
    s = scalar_row(both.agg(*[x for i, f in enumerate(features)
                              for x in (F.min(col(f).cast("double")).alias(f"lo{i}"),
                                        F.max(col(f).cast("double")).alias(f"hi{i}"))]))

    def binned(df, tag):
        cols = []
        df = df.withColumn("_mm", s)
        for i, f in enumerate(features):
            lo, hi = F.col("_mm").getField(f"lo{i}"), F.col("_mm").getField(f"hi{i}")
            cols.append(equal_width_bin(col(f), lo, hi, bins).alias(f))
        x = df.select(*cols).unpivot([], list(features), "feature", "bin").where(F.col("bin").isNotNull())
        return x.withColumn("side", F.lit(tag))
    u = binned(train, 1).unionByName(binned(test, 2))
    g = u.groupBy("feature", "bin").agg(F.count_if(F.col("side") == 1).alias("e"), F.count_if(F.col("side") == 2).alias("a"))
    wt = Window.partitionBy("feature")
    p = g.select("feature", F.greatest(F.col("e") / F.sum("e").over(wt), F.lit(clip)).alias("pe"),
                 F.greatest(F.col("a") / F.sum("a").over(wt), F.lit(clip)).alias("pa"))
    out = p.groupBy("feature").agg(F.sum((F.col("pa") - F.col("pe")) * F.log(F.col("pa") / F.col("pe"))).alias("psi"))
    band = F.when(F.col("psi") > 0.2, "significant").when(F.col("psi") > 0.1, "moderate").otherwise("stable")
    return out.select("feature", "psi", band.alias("drift"))


def _edges(df: DataFrame, features: Sequence[str], n_bins: int, cfg: Config) -> Column:
    """Unique quantile edges (fields e0, e1, ...), fitted once and inlined as a literal struct.

    Like Spark ML's QuantileDiscretizer the fitted splits (#features x (bins + 1)
    numbers, bounded by parameters) are brought to the driver once, so every
    later reference is a constant instead of a re-executed subquery."""
    from tabscope.plans.frames import quantile_long
    probs = [i / n_bins for i in range(n_bins + 1)]
    got = {r["feature"]: r["q"] for r in quantile_long(df, features, probs, cfg=cfg).collect()}
    fields = []
    for i, f in enumerate(features):
        q = got.get(f)
        vals = list(dict.fromkeys(q)) if q else []
        arr = F.array(*[F.lit(float(v)) for v in vals]) if vals else F.array().cast("array<double>")
        fields.append(arr.alias(f"e{i}"))
    return F.struct(*fields)


def _count_edges(edges: Column, pred, n_max: int) -> Column:
    """Number of edges satisfying ``pred`` (``n_max`` at most), by one search over the fitted literals: unrolled comparisons
    of several columns make methods that the JVM doesn't compile."""
    return F.size(F.filter(F.slice(edges, 1, n_max), pred))


def hist_bin(x: Column, edges: Column, n_max: int) -> Column:
    """np.histogram with explicit edges: [e_i, e_i+1), last bin closed, outside -> null."""
    nb = F.size(edges) - 1
    last = F.element_at(edges, -1)
    b = _count_edges(edges, lambda e: e <= x, n_max) - 1
    b = F.when(x == last, nb - 1).otherwise(b)
    return F.when((x >= edges[0]) & (x <= last), b)


def qcut_bin(x: Column, edges: Column, n_max: int) -> Column:
    """pd.qcut(duplicates='drop') bins: (e_i, e_i+1], lowest edge included."""
    b = _count_edges(edges, lambda e: e < x, n_max) - 1
    return F.when(x.isNotNull(), F.greatest(b, F.lit(0)))


def psi_quantile(train: DataFrame, test: DataFrame, features: Sequence[str], bins: int = 10,
                 cfg: Config = DEFAULT) -> DataFrame:
    """PSI on train deciles (unique edges, >= 3 needed), +1 smoothing per bin,
    test values outside the train range ignored."""
    ed = _edges(train, features, bins, cfg)

    def binned(df, tag):
        e = F.col("_ed")
        cols = [hist_bin(col(f).cast("double"), e.getField(f"e{i}"), bins + 1).alias(f) for i, f in enumerate(features)]
        x = df.withColumn("_ed", ed).select(*cols).unpivot([], list(features), "feature", "bin")
        return x.withColumn("side", F.lit(tag))
    u = binned(train, 1).unionByName(binned(test, 2))
    # every bin index 0..nb-1 must exist (empty bins still get the +1); nb per feature comes
    # from the edges themselves, so the grid needs no pass over the rows
    grid = train.sparkSession.range(1).select(ed.alias("_ed")).select(F.inline(F.array(*[
        F.struct(F.lit(f).alias("feature"), (F.size(F.col("_ed").getField(f"e{i}")) - 1).alias("nb"))
        for i, f in enumerate(features)])))
    grid = grid.select("feature", "nb", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)).alias("bin"))
    cnt = u.where(F.col("bin").isNotNull()).groupBy("feature", "bin").agg(
        F.count_if(F.col("side") == 1).alias("tr"), F.count_if(F.col("side") == 2).alias("te"))
    g = grid.join(cnt, ["feature", "bin"], "left").fillna(0, ["tr", "te"])
    wt = Window.partitionBy("feature")
    p = g.select("feature", "nb", ((F.col("tr") + 1) / (F.sum("tr").over(wt) + F.col("nb"))).alias("trp"),
                 ((F.col("te") + 1) / (F.sum("te").over(wt) + F.col("nb"))).alias("tep"))
    out = p.groupBy("feature").agg(F.first("nb").alias("n_bins"),
                                   F.sum((F.col("tep") - F.col("trp")) * F.log(F.col("tep") / F.col("trp"))).alias("psi"))
    return out.select("feature", F.col("n_bins").cast("bigint"),
                      F.when(F.col("n_bins") >= 2, F.col("psi")).otherwise(F.lit(0.0)).alias("psi"))


def drift_numeric(train: DataFrame, test: DataFrame, features: Sequence[str], cfg: Config = DEFAULT) -> DataFrame:
    """KS statistic and decile PSI; drift when KS > .05 or PSI > .10."""
    ks = ks_2samp(train, test, features).select("feature", "ks_stat")
    ps = psi_quantile(train, test, features, cfg=cfg).select("feature", "psi")
    j = ks.join(ps, "feature")
    return j.withColumn("drift", ((F.col("ks_stat") > 0.05) | (F.col("psi") > 0.10)).cast("int"))


def mean_drift(train: DataFrame, test: DataFrame, features: Sequence[str]) -> DataFrame:
    """Relative mean change |m_test - m_train| / |m_train|, bands .3 / .1."""
    t = train.select(*features).withColumn("_s", F.lit(1)).unionByName(test.select(*features).withColumn("_s", F.lit(2)))
    out = per_feature(t, features, lambda i, f: {
        "mean_train": F.avg(F.when(F.col("_s") == 1, col(f).cast("double"))),
        "mean_test": F.avg(F.when(F.col("_s") == 2, col(f).cast("double")))})
    rel = F.try_divide(F.abs(F.col("mean_test") - F.col("mean_train")), F.abs(F.col("mean_train")))
    band = F.when(rel > 0.3, "high").when(rel > 0.1, "moderate").otherwise("low")
    return out.select("feature", "mean_train", "mean_test", rel.alias("rel_change"), band.alias("drift"))


# ------------------------------------------------------------ target relations via bins
def binned_long(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], y: Column, bins: int,
                cfg: Config = DEFAULT) -> DataFrame:
    """``(feature, bin(string), y)``: numerics by qcut edges, categoricals by level; null rows dropped.
    Bins are computed in one projection and unpivoted (Expand), not generated per row."""
    src, cols = df, []
    if numeric:
        src = df.withColumn("_ed", _edges(df.where(y.isNotNull()), numeric, bins, cfg))
        cols += [qcut_bin(col(f).cast("double"), F.col("_ed").getField(f"e{i}"), bins + 1).cast("string").alias(f)
                 for i, f in enumerate(numeric)]
    cols += [col(f).cast("string").alias(f) for f in categorical]
    feats = [*numeric, *categorical]
    x = src.select(y.alias("_y"), *cols).unpivot(["_y"], feats, "feature", "bin")
    return x.where(F.col("bin").isNotNull() & F.col("_y").isNotNull())


def woe_table(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], y: Column, bins: int = 10,
              clip: float = 1e-4, cfg: Config = DEFAULT) -> DataFrame:
    """WoE = ln(pct_non_event / pct_event) per bin/level (shares clipped at 1e-4)."""
    x = binned_long(df, numeric, categorical, y.cast("double"), bins, cfg)
    g = x.groupBy("feature", "bin").agg(F.sum("_y").alias("ev"), F.count(F.lit(1)).alias("tot"))
    g = with_totals(g.withColumn("nev", F.col("tot") - F.col("ev")), all_ev="ev", all_nev="nev")
    pe = F.greatest(F.col("ev") / F.greatest(F.col("all_ev"), F.lit(1.0)), F.lit(clip))
    pn = F.greatest(F.col("nev") / F.greatest(F.col("all_nev"), F.lit(1.0)), F.lit(clip))
    return g.select("feature", "bin", "tot", "ev", pe.alias("pct_event"), pn.alias("pct_non_event"),
                    F.log(pn / pe).alias("woe"), ((pn - pe) * F.log(pn / pe)).alias("iv_part"))


def information_value(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], y: Column, bins: int = 10,
                      cfg: Config = DEFAULT) -> DataFrame:
    """IV per feature with strength bands .02/.1/.3/.5."""
    w = woe_table(df, numeric, categorical, y, bins, cfg=cfg)
    iv = w.groupBy("feature").agg(F.sum("iv_part").alias("iv"))
    s = (F.when(F.col("iv") < 0.02, "useless").when(F.col("iv") < 0.1, "weak").when(F.col("iv") < 0.3, "medium")
         .when(F.col("iv") < 0.5, "strong").otherwise("suspicious"))
    return iv.select("feature", "iv", s.alias("strength"))


def mi_binned(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], y: Column, bins: int = 10,
              cfg: Config = DEFAULT) -> DataFrame:
    """Plug-in mutual information (nats) between binned feature and target."""
    x = binned_long(df, numeric, categorical, y.cast("string"), bins, cfg)
    # stored, as the totals read the cells three times more and would bin all rows again each time
    cell = written(x.groupBy("feature", "bin", "_y").agg(F.count(F.lit(1)).alias("n")), "cells")
    c = with_totals(cell, n_tot="n")
    c = with_totals(with_totals(c, ["feature", "bin"], bound=False, nb="n"), ["feature", "_y"], bound=False, ny="n")
    mi = c.groupBy("feature").agg(F.sum(F.col("n") / F.col("n_tot") * F.log(F.col("n") * F.col("n_tot") / (F.col("nb") * F.col("ny"))))
                                  .alias("mi"))
    w = Window.orderBy(F.col("mi").desc(), F.col("feature"))
    return mi.withColumn("rank", F.row_number().over(w).cast("bigint"))


def mi_interactions(df: DataFrame, numeric: Sequence[str], y: Column, top: int = 10, bins: int = 10,
                    cfg: Config = DEFAULT) -> DataFrame:
    """MI of pairwise products (degree-2 interaction-only), top-k."""
    prods = {f"{a}*{b}": col(a).cast("double") * col(b).cast("double") for a, b in _pairs(list(numeric))}
    t = df.select(y.alias("_target"), *[e.alias(n) for n, e in prods.items()])
    return mi_binned(t, list(prods), [], F.col("_target"), bins, cfg).where(F.col("rank") <= top)


def monotonicity(df: DataFrame, features: Sequence[str], y: Column, bins: int = 10, min_rows: int = 30,
                 cfg: Config = DEFAULT) -> DataFrame:
    """Target mean per quantile bin; monotone up / down / non-monotone and Spearman of means."""
    x = binned_long(df, features, [], y.cast("double"), bins, cfg).withColumn("bin", F.col("bin").cast("int"))
    m = x.groupBy("feature", "bin").agg(F.avg("_y").alias("mean"), F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("feature").orderBy("bin")
    d = m.withColumn("diff", F.col("mean") - F.lag("mean").over(w)).withColumn("pos", F.row_number().over(w))
    # Spearman between bin position and bin mean: ranks of the means within feature
    wr = Window.partitionBy("feature", "mean")
    wm = Window.partitionBy("feature").orderBy("mean")
    d = d.withColumn("mrank", F.rank().over(wm) + (F.count(F.lit(1)).over(wr) - 1) / 2.0)
    g = d.groupBy("feature").agg(
        F.count(F.lit(1)).alias("n_bins"), F.sum("n").alias("n"),
        F.coalesce(F.bool_and(F.coalesce(F.col("diff") >= 0, F.lit(True))), F.lit(True)).alias("up"),
        F.coalesce(F.bool_and(F.coalesce(F.col("diff") <= 0, F.lit(True))), F.lit(True)).alias("down"),
        _nan_null(pearson(F.col("pos").cast("double"), F.col("mrank"))).alias("spearman"))
    direction = F.when(F.col("up"), "increasing").when(F.col("down"), "decreasing").otherwise("non-monotone")
    return g.where((F.col("n") >= min_rows) & (F.col("n_bins") >= 3)).select(
        "feature", F.col("n_bins").cast("bigint"), direction.alias("direction"), "spearman")


def interaction_gain(df: DataFrame, numeric: Sequence[str], y: Column, eps: float = 1e-6) -> DataFrame:
    """|r| of a*b and a/(b+eps) with the target vs the best single |r|."""
    yy = y.cast("double")
    rows = []
    exprs = [pearson(col(f).cast("double"), yy).alias(f"_s{i}") for i, f in enumerate(numeric)]
    pairs = _pairs(list(numeric))
    for k, (a, b) in enumerate(pairs):
        av, bv = col(a).cast("double"), col(b).cast("double")
        exprs += [pearson(av * bv, yy).alias(f"_p{k}"), pearson(av / (bv + eps), yy).alias(f"_q{k}")]
    agg = df.agg(*exprs)
    for k, (a, b) in enumerate(pairs):
        ia, ib = numeric.index(a), numeric.index(b)
        best = F.greatest(F.abs(F.col(f"_s{ia}")), F.abs(F.col(f"_s{ib}")))
        for kind, c in (("product", F.col(f"_p{k}")), ("ratio", F.col(f"_q{k}"))):
            rows.append(F.struct(F.lit(a).alias("feature_a"), F.lit(b).alias("feature_b"), F.lit(kind).alias("kind"),
                                 _nan_null(F.abs(c)).alias("abs_corr"), _nan_null(best).alias("best_single"),
                                 _nan_null(F.abs(c) - best).alias("gain")))
    return agg.select(F.inline(F.array(*rows)))


def simpson(df: DataFrame, numeric: Sequence[str], groups: Sequence[str], y: Column, min_n: int = 30,
            min_sub: float = 0.1, min_global: float = 0.05) -> DataFrame:
    """Subgroups whose correlation sign reverses the global one."""
    yy = y.cast("double")
    glob = per_feature(df, numeric, lambda i, f: {"r_global": pearson(col(f).cast("double"), yy)})
    out = None
    for g in groups:
        x = df.select(col(g).cast("string").alias("level"), yy.alias("_y"), *[col(f).cast("double").alias(f) for f in numeric])
        sub = per_feature(x, numeric, lambda i, f: {"n": F.count(col(f)), "r_group": pearson(col(f), F.col("_y"))},
                          by=["level"]).withColumn("group_col", F.lit(g))
        out = sub if out is None else out.unionByName(sub)
    j = out.join(glob, "feature")
    rev = ((F.signum("r_group") != F.signum("r_global")) & (F.abs("r_group") > min_sub) & (F.col("n") >= min_n)
           & (F.abs("r_global") >= min_global))
    return j.where(rev).select("feature", "group_col", "level", "n", "r_group", "r_global")


def subgroup_effects(df: DataFrame, numeric: Sequence[str], group: str, y: Column, min_n: int = 30) -> DataFrame:
    """Per subgroup n, target mean and correlation of each numeric with the target."""
    x = df.select(col(group).cast("string").alias("level"), y.cast("double").alias("_y"),
                  *[col(f).cast("double").alias(f) for f in numeric])
    s = per_feature(x, numeric, lambda i, f: {"n": F.count(F.lit(1)), "target_mean": F.avg("_y"),
                                              "corr": _nan_null(pearson(col(f), F.col("_y")))}, by=["level"])
    return s.where(F.col("n") >= min_n)


# ------------------------------------------------------------ leakage
def leak_corr(df: DataFrame, features: Sequence[str], y: Column, high: float = 0.95, critical: float = 0.99) -> DataFrame:
    """|r(feature, target)| above .95 (suspect) / .99 (leak)."""
    out = per_feature(df, features, lambda i, f: {"corr": _nan_null(pearson(col(f).cast("double"), y.cast("double")))})
    a = F.abs("corr")
    return out.select("feature", "corr", F.when(a > critical, "leak").when(a > high, "suspect").otherwise("ok").alias("verdict"))


def leak_encoding(df: DataFrame, cols: Sequence[str], y: Column, tol: float = 0.01) -> DataFrame:
    """Numeric-looking category levels equal to their own target mean (+- tol) => target encoding leaked."""
    x = df.select(y.cast("double").alias("_y"), *[col(c).cast("string").alias(c) for c in cols]) \
        .unpivot(["_y"], list(cols), "feature", "value").where(F.col("value").isNotNull())
    g = x.groupBy("feature", "value").agg(F.avg("_y").alias("tm"))
    num = F.expr("try_cast(value AS DOUBLE)")
    s = g.groupBy("feature").agg(F.count(F.lit(1)).alias("n_levels"), F.count(num).alias("n_numeric"),
                                 F.count_if(F.abs(num - F.col("tm")) <= tol).alias("n_match"))
    share = F.col("n_match") / F.col("n_levels")
    return s.select("feature", "n_levels", "n_numeric", "n_match", share.alias("match_share"),
                    ((F.col("n_numeric") == F.col("n_levels")) & (share > 0.9)).cast("int").alias("leak"))


def leak_distribution(df: DataFrame, cols: Sequence[str], target: str, atol: float = 0.001) -> DataFrame:
    """A feature whose sorted frequency vector equals the target's (atol) mirrors it."""
    from tabscope.plans.frames import positions, value_counts
    p = with_totals(value_counts(df, [*cols, target]), rows="n").select("feature", (F.col("n") / F.col("rows")).alias("p"))
    # number the shares within each feature, then compare position by position with the target's
    r = positions(p, [F.col("p")], by=["feature"], name="pos")
    t = r.where(F.col("feature") == target).select("pos", F.col("p").alias("tp"))
    f = r.where(F.col("feature") != target)
    n_t = t.agg(F.count(F.lit(1)).alias("k")).scalar()
    j = f.join(t, "pos", "left")
    g = j.groupBy("feature").agg(F.count(F.lit(1)).alias("n_levels"),
                                 F.bool_and(F.coalesce(F.abs(F.col("p") - F.col("tp")) <= atol, F.lit(False))).alias("ok"))
    same = (F.col("n_levels") == n_t) & F.col("ok")
    return g.select("feature", F.col("n_levels").cast("bigint"), F.coalesce(same, F.lit(False)).cast("int").alias("mirrors_target"))


def leak_structural(train: DataFrame, test: DataFrame, target: str, id_col: str | None = None) -> DataFrame:
    """Unique-per-row features, features absent in test, id-target correlation > .05, target in test."""
    feats = [c for c in train.columns if c != target]
    st = distinct_counts(train, feats).withColumnRenamed("n_rows", "n")
    test_cols = set(test.columns)
    present = F.create_map(*[x for f in feats for x in (F.lit(f), F.lit(int(f in test_cols)))])
    rows = st.select(F.col("feature"), (F.col("n_unique") == F.col("n")).cast("int").alias("unique_per_row"),
                     (1 - present[F.col("feature")]).alias("missing_in_test"))
    extra = train.agg(
        (_nan_null(pearson(col(id_col).cast("double"), col(target).cast("double"))) if id_col else F.lit(None).cast("double"))
        .alias("id_target_corr")).select(
        F.lit(int(target in test_cols)).alias("target_in_test"), "id_target_corr")
    ex = extra.select(F.struct("*").alias("s")).scalar()
    return rows.select("*", ex.getField("target_in_test").alias("target_in_test"),
                       ex.getField("id_target_corr").alias("id_target_corr"))


def sentinel_dependency(df: DataFrame, children: Sequence[str], parents: Sequence[str], y: Column | None = None,
                        pattern: str = r"^No .+") -> DataFrame:
    """Child level (matching the sentinel pattern) that occurs exactly when a parent takes one value."""
    pairs = [(c, p) for c in children for p in parents if c != p]
    cube = pair_cube(df, pairs, fill_null=None, dropna=True)
    child_tot = cube.groupBy("a_name", "b_name", "a").agg(F.sum("n").alias("n_child"), F.count(F.lit(1)).alias("k"))
    par_tot = cube.groupBy("a_name", "b_name", "b").agg(F.sum("n").alias("n_parent"))
    cand = cube.join(child_tot, ["a_name", "b_name", "a"]).join(par_tot, ["a_name", "b_name", "b"])
    dep = cand.where((F.col("k") == 1) & (F.col("n") == F.col("n_parent")) & F.col("a").rlike(pattern))
    return dep.select(F.col("a_name").alias("child"), F.col("a").alias("child_value"), F.col("b_name").alias("parent"),
                      F.col("b").alias("parent_value"), F.col("n").cast("bigint").alias("n"))


#: Derived columns that one pass over the rows correlates with all targets.
DERIVED_AT_ONCE = 240


def _relations(a: str, b: str) -> list[tuple[str, str, str, Column]]:
    x, z = col(a).cast("double"), col(b).cast("double")
    return [("product", a, b, x * z), ("sum", a, b, x + z), ("difference", a, b, x - z),
            ("ratio", a, b, F.try_divide(x, z)), ("ratio", b, a, F.try_divide(z, x))]


def derived_features(df: DataFrame, numeric: Sequence[str], threshold: float = 0.95) -> DataFrame:
    """A third column that a product, a sum, a difference (a before b) or a ratio (either way) of two others
    reproduces: ``(relation, feature_a, feature_b, target_col, corr)`` with |corr| above the threshold."""
    made = [r for a, b in _pairs(list(numeric)) for r in _relations(a, b)]
    out = None
    for low in range(0, len(made), DERIVED_AT_ONCE):
        part = made[low:low + DERIVED_AT_ONCE]
        names = F.array(*[F.struct(F.lit(k).alias("relation"), F.lit(p).alias("feature_a"), F.lit(q).alias("feature_b")) for k, p, q, _ in part])
        one = moment_grid(df, [v for *_, v in part], [col(c) for c in numeric]).select(
            F.get(names, F.col("i")).alias("s"), F.get(F.array(*[F.lit(c) for c in numeric]), F.col("j")).alias("target_col"),
            F.col("r").alias("corr")).select("s.*", "target_col", "corr")
        out = one if out is None else out.union(one)
    if out is None:
        return df.sparkSession.createDataFrame([], "relation string, feature_a string, feature_b string, target_col string, corr double")
    other = (F.col("target_col") != F.col("feature_a")) & (F.col("target_col") != F.col("feature_b"))
    return out.where(other & (F.abs("corr") > threshold))


def product_residual(df: DataFrame, a: str, b: str, c: str, name: str | None = None) -> DataFrame:
    """FE20: what a product leaves of a third column, ``c - a * b``."""
    return df.withColumn(name or f"{c}_minus_{a}_x_{b}", col(c).cast("double") - col(a).cast("double") * col(b).cast("double"))


def linear_residuals(df: DataFrame, x: str, y: str) -> DataFrame:
    """Least-squares fit y = a + b x and residual spread (one aggregate + one pass)."""
    fit = df.agg(F.regr_slope(col(y), col(x)).alias("slope"), F.regr_intercept(col(y), col(x)).alias("intercept"),
                 F.regr_r2(col(y), col(x)).alias("r2"), F.regr_count(col(y), col(x)).alias("n"))
    s = scalar_row(fit)
    res = col(y) - (s.getField("intercept") + s.getField("slope") * col(x))
    return df.agg(F.first(s.getField("slope")).alias("slope"), F.first(s.getField("intercept")).alias("intercept"),
                  F.first(s.getField("r2")).alias("r2"), F.first(s.getField("n")).alias("n"),
                  F.stddev_samp(res).alias("resid_std"), F.max(F.abs(res)).alias("resid_max_abs"))


def residual_feature(df: DataFrame, x: str, y: str, name: str | None = None) -> DataFrame:
    """Residual of the least-squares line y = a + b x as a column (fit in one aggregate; null where x or y is)."""
    fit = scalar_row(df.agg(F.regr_slope(col(y), col(x)).alias("b"), F.regr_intercept(col(y), col(x)).alias("a")))
    value = col(y).cast("double") - (fit.getField("a") + fit.getField("b") * col(x).cast("double"))
    return df.withColumn(name or f"{y}_resid_{x}", value)


def _signed_pairs(x: np.ndarray, y: np.ndarray, n: np.ndarray) -> float:
    """Weighted concordant minus discordant pairs of cells (x, y) with counts n, in O(m log m): y ranks are split bit by
    bit from the top, and two cells are compared at the bit where their ranks first differ."""
    if len(x) < 2:
        return 0.0
    order = np.argsort(x, kind="stable")
    x, n = x[order], n[order].astype(float)
    rank = np.unique(y[order], return_inverse=True)[1]
    total, prefix = 0.0, np.zeros(len(x), np.int64)
    for bit in range(int(rank.max()).bit_length() - 1, -1, -1):
        one = ((rank >> bit) & 1).astype(bool)
        new_group = np.concatenate([[True], prefix[1:] != prefix[:-1]])
        new_x = new_group | np.concatenate([[True], x[1:] != x[:-1]])
        at = np.arange(len(x))
        group, tie = np.maximum.accumulate(np.where(new_group, at, 0)), np.maximum.accumulate(np.where(new_x, at, 0))
        zeros, ones = (np.concatenate([[0.0], np.cumsum(np.where(m, n, 0.0))]) for m in (~one, one))
        total += (n * np.where(one, zeros[tie] - zeros[group], ones[group] - ones[tie])).sum()
        prefix = prefix * 2 + one
        order = np.argsort(prefix, kind="stable")  # x order is kept inside a prefix
        x, n, rank, prefix = x[order], n[order], rank[order], prefix[order]
    return total


def _signed_pairs_of(x: str):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"s": [_signed_pairs(pdf[x].to_numpy(), pdf["y"].to_numpy(), pdf["n"].to_numpy())]})
    return run


def _axis_blocks(cells: DataFrame, axis: str, blocks: int) -> tuple[Column, Column]:
    """Block number of an axis value (approximate quantiles, inlined) and whether its block holds one value alone:
    a value that several quantiles hit gets a block of its own."""
    from tabscope.plans.frames import value_block
    got = cells.agg(F.percentile_approx(axis, [i / blocks for i in range(1, blocks)], 100 * blocks)).first()[0] if blocks > 1 else []
    hot = sorted({c for c in got or [] if got.count(c) > 1})
    cuts = sorted({*(got or []), *(math.nextafter(c, math.inf) for c in hot)})
    alone = F.col(axis).isin(hot) if hot else F.lit(False)
    return value_block(F.col(axis), cuts), alone


def corr_kendall(df: DataFrame, cols: Sequence[str], cfg: Config = DEFAULT) -> DataFrame:
    """T4: exact Kendall tau-b for every pair of columns, whatever their numbers of levels.

    Cells (x, y, count) are cut into blocks along both axes, about the cube root of the number of cells.  Pairs of
    cells in different blocks on both axes are counted on the grid of block counts by running sums; pairs inside
    an x block, and pairs inside a y block but in different x blocks, by sorting inside the block.  A value that holds
    many cells has a block of its own, in which all pairs are ties."""
    from tabscope.session import scratch_path
    base = df.select(*[col(c).cast("double").alias(c) for c in cols])
    out = None
    for a, b in _pairs(list(cols)):
        t = base.select(col(a).alias("x"), col(b).alias("y")).na.drop()
        path = scratch_path(df.sparkSession, "kendall")
        t.groupBy("x", "y").agg(F.count(F.lit(1)).alias("n")).write.parquet(path)
        cells = df.sparkSession.read.parquet(path)
        blocks = max(1, math.ceil(cells.count() ** (1 / 3)))
        (bx, one_x), (by, one_y) = _axis_blocks(cells, "x", blocks), _axis_blocks(cells, "y", blocks)
        cells = cells.select("x", "y", "n", bx.cast("double").alias("bx"), by.cast("double").alias("by"),
                             one_x.alias("one_x"), one_y.alias("one_y"))
        grid = cells.groupBy("bx", "by").agg(F.sum("n").cast("double").alias("n"))
        rows = grid.agg(F.collect_set("by")).scalar()  # block numbers of one axis
        whole = grid.select("bx").distinct().select("bx", F.explode(rows).alias("by"))
        whole = whole.join(grid, ["bx", "by"], "left").fillna(0.0, ["n"])
        left = Window.partitionBy("by").orderBy("bx").rowsBetween(Window.unboundedPreceding, -1)
        whole = whole.withColumn("p", F.coalesce(F.sum("n").over(left), F.lit(0.0)))  # counts in x blocks further left
        under = Window.partitionBy("bx").orderBy("by").rowsBetween(Window.unboundedPreceding, -1)
        over = Window.partitionBy("bx").orderBy("by").rowsBetween(1, Window.unboundedFollowing)
        signed = F.col("n") * (F.coalesce(F.sum("p").over(under), F.lit(0.0)) - F.coalesce(F.sum("p").over(over), F.lit(0.0)))
        parts = whole.select(signed.alias("s"))
        parts = parts.union(cells.where(~F.col("one_x")).groupBy("bx").applyInPandas(_signed_pairs_of("x"), "s double"))
        parts = parts.union(cells.where(~F.col("one_y")).groupBy("by", "bx", "y").agg(F.sum("n").alias("n")).groupBy("by")
                            .applyInPandas(_signed_pairs_of("bx"), "s double"))
        ties = lambda axis: scalar_row(cells.groupBy(axis).agg(F.sum("n").cast("double").alias("t")).agg(
            F.sum(F.col("t") * (F.col("t") - 1) / 2.0).alias("t"), F.sum("t").alias("n")))
        tx, ty = ties("x"), ties("y")
        n0 = tx.getField("n") * (tx.getField("n") - 1) / 2.0
        tau = F.try_divide(F.col("s"), F.sqrt((n0 - tx.getField("t")) * (n0 - ty.getField("t"))))
        one = parts.agg(F.sum("s").alias("s")).select(F.lit(a).alias("feature_a"), F.lit(b).alias("feature_b"), tau.alias("kendall_tau"))
        out = one if out is None else out.unionByName(one)
    return out
