"""Advice / decision tables and the findings table.

All rules are ``when`` chains over the per-feature profile tables; the
findings table is a union of small rule outputs (#features rows each).
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabscope.config import DEFAULT, Config
from tabscope.functions.exprs import col, pearson, skew_corrected
from tabscope.plans.frames import bounded, distinct_counts, per_feature, quantiles, scalar_row

FINDING_COLS = ["section", "feature", "severity", "code", "metric", "value", "threshold", "message"]


def encoding_advice(df: DataFrame, cats: Sequence[str], cfg: Config = DEFAULT) -> DataFrame:
    """Encoding by cardinality (> high_card: target/label or reduce; <= 5: one-hot; else label/target)."""
    st = distinct_counts(df, cats)
    adv = (F.when(F.col("n_unique") > cfg.high_cardinality, "target/label encoding or reduce cardinality")
           .when(F.col("n_unique") <= 5, "one-hot").otherwise("label/target encoding"))
    return st.select("feature", "n_unique", adv.alias("encoding"))


def fe_advice(df: DataFrame, nums: Sequence[str], cats: Sequence[str], corr_hi: float | None = None,
              cfg: Config = DEFAULT) -> DataFrame:
    """Feature-engineering suggestions as (feature, suggestion, value) rows."""
    corr_hi = cfg.corr_high if corr_hi is None else corr_hi
    pairs = [(a, b) for i, a in enumerate(nums) for b in nums[i + 1:]]

    def make(i, f):
        x = col(f).cast("double")
        return {"nu": F.count_distinct(col(f)), "n": F.count(x), "sk": F.skewness(x), "ku": F.kurtosis(x)}
    st = per_feature(df, nums, make)
    rules = [
        st.where(F.col("nu") < 5).select("feature", F.lit("few levels: treat as a category").alias("suggestion"),
                                         F.col("nu").cast("double").alias("value")),
        st.where((F.col("n") > 3) & (F.abs("sk") > 2)).select("feature", F.lit("skewed: take a log or a power"),
                                                              F.col("sk")),
        st.where((F.col("n") > 3) & (F.col("ku") > 7)).select("feature", F.lit("heavy tails: clip the extremes"), F.col("ku")),
    ]
    if cats:
        cs = distinct_counts(df, cats).select("feature", F.col("n_unique").alias("nu"))
        rules.append(cs.where(F.col("nu") > 100).select("feature", F.lit("many levels: merge the rare ones"),
                                                        F.col("nu").cast("double")))
        dated = [c for c in cats if any(w in c.lower() for w in ("date", "time", "dt"))]
        if dated:
            rules.append(cs.where(F.col("feature").isin(dated)).select("feature", F.lit("reads as a date: split into its parts"),
                                                                       F.lit(None).cast("double")))
    if pairs:
        agg = df.agg(*[pearson(col(a), col(b)).alias(f"_r{k}") for k, (a, b) in enumerate(pairs)])
        rows = F.array(*[F.struct(F.lit(f"{a} & {b}").alias("feature"), F.col(f"_r{k}").alias("r"))
                         for k, (a, b) in enumerate(pairs)])
        cr = agg.select(F.inline(rows)).where(F.abs("r") > corr_hi)
        rules.append(cr.select("feature", F.lit("correlated pair: keep one or use their ratio"), F.col("r")))
    out = rules[0]
    for r in rules[1:]:
        out = out.union(r)
    return out.toDF("feature", "suggestion", "value")


def todo_basic(df: DataFrame, nums: Sequence[str], cats: Sequence[str]) -> DataFrame:
    """Missing > 20 %, numeric with < 5 levels, else |skew| > 1.5 (pandas skew), > 200 levels."""
    allc = list(dict.fromkeys([*nums, *cats]))

    def make(i, f):
        x = col(f).cast("double") if f in nums else F.lit(None).cast("double")
        return {"n": F.count(F.lit(1)), "nn": F.count(col(f)), "g1": F.skewness(x), "nx": F.count(x)}
    st = per_feature(df, allc, make).join(bounded(distinct_counts(df, allc).select("feature", F.col("n_unique").alias("nu"))), "feature")
    is_num = F.col("feature").isin(list(nums)) if nums else F.lit(False)
    is_cat = F.col("feature").isin(list(cats)) if cats else F.lit(False)
    miss = 1 - F.col("nn") / F.col("n")
    sk = skew_corrected(F.col("g1"), F.col("nx"))
    nu = F.col("nu").cast("double")
    # the rules are tested on one row a feature, so the statistics are taken once
    rules = [("high missing share", miss > 0.2, miss), ("few unique values", is_num & (F.col("nu") < 5), nu),
             ("high skew", is_num & (F.col("nu") >= 5) & (F.abs(sk) > 1.5), sk), ("too many categories", is_cat & (F.col("nu") > 200), nu)]
    items = F.array(*[F.struct(F.lit(n).alias("item"), F.when(hit, F.lit(True)).alias("hit"), F.when(hit, v).alias("value"))
                      for n, hit, v in rules])
    return st.select("feature", F.inline(items)).where("hit").select("feature", "item", "value")


def quality_score(df: DataFrame, nums: Sequence[str], cats: Sequence[str], zero_fill: bool = False,
                  missing_cap: float = 25.0) -> DataFrame:
    """100 - min(missing_cap, mean missing %) - min(10, duplicate %) - min(15, |z| > 3 cell %) - min(10, 5 x #id-like
    text columns).

    z-scores use the population std over rows complete in all numerics or, with ``zero_fill``, over all rows with 0 in
    place of nulls."""
    allc = list(df.columns)
    miss = df.agg(F.count(F.lit(1)).alias("n"), *[F.count_if(col(c).isNull()).alias(f"m{i}") for i, c in enumerate(allc)])
    miss_pct = sum((F.col(f"m{i}") for i in range(len(allc))), F.lit(0)) / (F.col("n") * len(allc)) * 100.0
    dup = df.groupBy(*[col(c) for c in allc]).agg(F.count(F.lit(1)).alias("k")).agg(
        (F.sum("k") - F.count(F.lit(1))).alias("dups"))
    cells = df.select(*[col(c).cast("double").alias(c) for c in nums])
    complete = cells.na.fill(0.0) if zero_fill else cells.na.drop()
    s = scalar_row(complete.agg(*[x for i, c in enumerate(nums) for x in (F.avg(col(c)).alias(f"a{i}"),
                                                                         F.stddev_pop(col(c)).alias(f"s{i}"))]))
    zc = complete.withColumn("_z", s).agg(
        F.count(F.lit(1)).alias("rows"),
        sum((F.count_if(F.abs(F.try_divide(col(c) - F.col("_z").getField(f"a{i}"), F.col("_z").getField(f"s{i}"))) > 3)
             for i, c in enumerate(nums)), F.lit(0)).alias("zcells"))
    hc = distinct_counts(df, cats).agg(F.count_if(F.col("n_unique") > 0.5 * F.col("n_rows")).alias("n_idlike")).scalar() \
        if cats else F.lit(0)
    zs = scalar_row(zc)
    # every part is a one-row aggregate, combined through scalar subqueries (no join)
    parts = miss.select(miss_pct.alias("missing_pct"), "n", dup.scalar().alias("dups"), zs.getField("rows").alias("rows"),
                        zs.getField("zcells").alias("zcells"), hc.alias("n_idlike"))
    dup_pct = F.col("dups") / F.col("n") * 100.0
    z_pct = F.coalesce(F.try_divide(F.col("zcells") * 100.0, F.col("rows") * float(len(nums))), F.lit(0.0))
    score = (100.0 - F.least(F.lit(float(missing_cap)), F.col("missing_pct")) - F.least(F.lit(10.0), dup_pct)
             - F.least(F.lit(15.0), z_pct) - F.least(F.lit(10.0), F.col("n_idlike") * 5.0))
    return parts.select(F.col("missing_pct"), dup_pct.alias("duplicate_pct"), z_pct.alias("outlier_cell_pct"),
                        F.col("n_idlike").cast("bigint"), F.greatest(score, F.lit(0.0)).alias("score"))


def feature_actions(train: DataFrame, nums: Sequence[str], cats: Sequence[str], y: Column, cfg: Config = DEFAULT,
                    high_card: int = 100) -> DataFrame:
    """Per-feature main action and priority (DROP / encode / TRANSFORM+CLIP+IMPUTE+TRY_DROP / KEEP);
    MI is the plug-in binned MI (nats)."""
    from tabscope.operators.association import mi_binned
    mi = mi_binned(train, list(nums), list(cats), y, 10, cfg).select("feature", "mi")
    from tabscope.plans.frames import quantile_scalar
    q = quantile_scalar(train, list(nums), [0.25, 0.75], cfg) if nums else None
    feats = list(dict.fromkeys([*cats, *nums]))
    src = train.withColumn("_q", q) if q is not None else train

    def make(i, f):
        x = col(f)
        out = {"nu": F.count_distinct(x) + F.max(x.isNull().cast("int")), "n": F.count(F.lit(1)),
               "nn": F.count(x), "g1": F.lit(None).cast("double"), "nout": F.lit(0).cast("bigint")}
        if f in nums:
            k = list(nums).index(f)
            d = x.cast("double")
            q1, q3 = F.col("_q").getField(f"q{k}")[0], F.col("_q").getField(f"q{k}")[1]
            out["g1"] = F.skewness(d)
            out["nout"] = F.count_if((d < q1 - 1.5 * (q3 - q1)) | (d > q3 + 1.5 * (q3 - q1)))
        return out
    st = per_feature(src, feats, make).join(mi, "feature", "left")
    is_cat = F.col("feature").isin(list(cats)) if cats else F.lit(False)
    m = F.coalesce(F.col("mi"), F.lit(0.0))
    skew = skew_corrected(F.col("g1"), F.col("nn"))
    parts = F.concat_ws(" + ", F.when(F.abs(skew) > 2, F.lit("TRANSFORM")),
                        F.when(F.col("nout") / F.col("n") > 0.05, F.lit("CLIP")),
                        F.when(F.col("nn") < F.col("n"), F.lit("IMPUTE")), F.when(m < 0.005, F.lit("TRY_DROP")))
    action = (F.when(F.col("nu") <= 1, "DROP")
              .when(is_cat & (F.col("nu") > high_card), "TARGET/FREQ ENCODE")
              .when(is_cat & (F.col("nu") <= 5), "ONEHOT").when(is_cat, "TARGET ENCODE")
              .when(parts == "", "KEEP").otherwise(parts))
    prio = (F.when(F.col("nu") <= 1, "HIGH").when(is_cat & (F.col("nu") > high_card), "HIGH").when(is_cat, "MED")
            .when(m > 0.1, "HIGH").when(m < 0.005, "LOW").otherwise("MED"))
    return st.select("feature", F.when(is_cat, "CAT").otherwise("NUM").alias("type"), action.alias("action"),
                     prio.alias("priority"), F.col("mi"))


def pruning_advice(df: DataFrame, nums: Sequence[str], y: Column, cfg: Config = DEFAULT) -> DataFrame:
    """D3: one row per feature to drop, first reason wins: near-zero variance, VIF > 10,
    |r| > .95 (keep the higher-MI side), MI < .01."""
    from tabscope.operators.association import corr_pairs, mi_binned, vif
    from tabscope.operators.profile import near_zero_variance
    nzv = near_zero_variance(df, nums, cfg).where(F.col("nzv") == 1).select("feature", F.lit(1).alias("prio"),
                                                                           F.lit("near-zero variance").alias("reason"))
    v = vif(df, nums).where(F.col("vif") > cfg.vif_high).select("feature", F.lit(2), F.lit("VIF > 10"))
    mi = mi_binned(df, list(nums), [], y, 10, cfg).select("feature", "mi")
    cp = corr_pairs(df, nums).where(F.abs("corr") > cfg.corr_high)
    cp = cp.join(mi.withColumnRenamed("feature", "feature_a").withColumnRenamed("mi", "mi_a"), "feature_a") \
        .join(mi.withColumnRenamed("feature", "feature_b").withColumnRenamed("mi", "mi_b"), "feature_b")
    corr = cp.select(F.when(F.col("mi_a") >= F.col("mi_b"), F.col("feature_b")).otherwise(F.col("feature_a")).alias("feature"),
                     F.lit(3), F.lit("|r| > .95, lower MI"))
    low = mi.where(F.col("mi") < 0.01).select("feature", F.lit(4), F.lit("MI < .01"))
    u = nzv.union(v).union(corr).union(low).toDF("feature", "prio", "reason")
    best = F.min_by(F.struct("prio", "reason"), F.col("prio"))
    return u.groupBy("feature").agg(best.alias("b")).select("feature", F.col("b.reason").alias("reason"),
                                                            F.col("b.prio").alias("priority"))


def findings(df: DataFrame, nums: Sequence[str], cats: Sequence[str], target: str | None = None,
             cfg: Config = DEFAULT) -> DataFrame:
    """The findings table -- severity-tagged rows from missing, duplicates, skew,
    constant columns, imbalance and name-hint leakage rules."""
    from tabscope.operators.profile import null_profile, quasi_constant, target_distribution
    rows = []
    npf = null_profile(df)
    rows.append(npf.where(F.col("pct_null") > 0).select(
        F.lit("missing").alias("section"), "feature",
        F.when(F.col("pct_null") > 30, "critical").when(F.col("pct_null") > 5, "warning").otherwise("info").alias("severity"),
        F.lit("MISSING").alias("code"), F.lit("pct_null").alias("metric"), F.col("pct_null").alias("value"),
        F.lit(5.0).alias("threshold"),
        F.format_string("%s: %.2f%% missing", F.col("feature"), F.col("pct_null")).alias("message")))
    qc = quasi_constant(df, list(df.columns), cfg=cfg)
    rows.append(qc.where(F.col("constant") == 1).select(
        F.lit("quality"), "feature", F.lit("critical"), F.lit("CONSTANT"), F.lit("n_unique"),
        F.col("n_unique").cast("double"), F.lit(1.0), F.format_string("%s: constant column, drop", F.col("feature"))))
    st = per_feature(df, nums, {"g1": lambda c: F.skewness(c.cast("double"))})
    rows.append(st.where(F.abs("g1") > 1).select(
        F.lit("distribution"), "feature", F.lit("warning"), F.lit("SKEW"), F.lit("skew"), F.col("g1"), F.lit(1.0),
        F.format_string("%s: skew %.2f, consider a transform", F.col("feature"), F.col("g1"))))
    dups = df.groupBy(*[col(c) for c in df.columns]).agg(F.count(F.lit(1)).alias("k")).agg(
        (F.sum("k") - F.count(F.lit(1))).alias("d"))
    rows.append(dups.where(F.col("d") > 0).select(
        F.lit("duplicates"), F.lit("*"), F.lit("warning"), F.lit("DUP_ROWS"), F.lit("n_duplicates"),
        F.col("d").cast("double"), F.lit(0.0), F.format_string("%d duplicated rows", F.col("d"))))
    if target:
        td = target_distribution(df, target)
        rows.append(td.agg(F.max("ratio").alias("r")).where(F.col("r") > 10).select(
            F.lit("target"), F.lit(target), F.lit("critical"), F.lit("IMBALANCE"), F.lit("max_min_ratio"), F.col("r"),
            F.lit(10.0), F.format_string("class imbalance ratio %.1f", F.col("r"))))
        hints = [c for c in df.columns if c != target and re.search(r"(future|next|after|result|outcome)", c.lower())]
        for h in hints:
            rows.append(df.sparkSession.range(1).select(F.lit("leakage"), F.lit(h), F.lit("warning"), F.lit("NAME_HINT"),
                                           F.lit("name"), F.lit(None).cast("double"), F.lit(None).cast("double"),
                                           F.lit(f"{h}: name suggests information from the future")))
    out = rows[0]
    for r in rows[1:]:
        out = out.union(r)
    return out.toDF(*FINDING_COLS)


def executive_summary(df: DataFrame, nums: Sequence[str], cats: Sequence[str], target: str | None = None,
                      max_classes: int = 20) -> DataFrame:
    """``(code, feature, value, level)``, one row a headline: size, roles, share of missing cells (> 20 % high, > 5 %
    moderate), duplicate rows (> 1 % high), share of the largest class (> 90 % severe, > 70 % moderate; only text targets
    or those of fewer than ``max_classes`` classes), and each numeric with |skew| > 2 over more than 3 values.

    An empty table has shares of 0; a skew that isn't defined gives no row."""
    allc = list(df.columns)
    one = df.agg(F.count(F.lit(1)).alias("n"), sum((F.count_if(col(c).isNull()) for c in allc), F.lit(0)).alias("m"),
                 *[F.struct(F.count(col(c)).alias("k"), F.skewness(col(c).cast("double")).alias("g")).alias(f"s{i}")
                   for i, c in enumerate(nums)])
    dups = df.groupBy(*[col(c) for c in allc]).agg(F.count(F.lit(1)).alias("k")).agg(
        F.coalesce(F.sum("k") - F.count(F.lit(1)), F.lit(0)).alias("d")).scalar()

    def row(code: str, value, level=None, feature: str | None = None) -> Column:
        return F.struct(F.lit(code).alias("code"), F.lit(feature).cast("string").alias("feature"),
                        value.cast("double").alias("value"), (F.lit(None) if level is None else level).cast("string").alias("level"))

    def band(share: Column, *steps: tuple[float, str], low: str) -> Column:
        out = F
        for least, name in steps:
            out = out.when(share > least, name)
        return out.otherwise(low)

    n = F.col("n")
    missing = F.coalesce(F.try_divide(F.col("m").cast("double"), n * len(allc)), F.lit(0.0))
    twice = F.coalesce(F.try_divide(dups.cast("double"), n), F.lit(0.0))
    rows = [row("rows", n), row("columns", F.lit(len(allc))), row("numeric_features", F.lit(len(nums))),
            row("categorical_features", F.lit(len(cats))),
            row("missing_share", missing, band(missing, (0.2, "high"), (0.05, "moderate"), low="low")),
            row("duplicate_share", twice, band(twice, (0.01, "high"), low="low"))]
    if target:
        classes = df.where(col(target).isNotNull()).groupBy(col(target)).agg(F.count(F.lit(1)).alias("k"))
        top = scalar_row(classes.agg(F.count(F.lit(1)).alias("classes"), (F.max("k") / F.sum("k")).alias("share")))
        few = F.lit(dict(df.dtypes)[target] == "string") | (top.getField("classes") < max_classes)
        share = F.when(few, top.getField("share"))
        rows.append(row("majority_share", share, band(share, (0.9, "severe"), (0.7, "moderate"), low="balanced"), target))
    for i, c in enumerate(nums):
        k, g = F.col(f"s{i}.k"), F.col(f"s{i}.g")
        rows.append(row("skew", F.when((k > 3) & ~F.isnan(g) & (F.abs(g) > 2), g), F.lit("high"), c))
    return one.select(F.inline(F.array(*rows))).where("value is not null")


def action_items(df: DataFrame, nums: Sequence[str], cats: Sequence[str], target: str, positive: Column,
                 cfg: Config = DEFAULT) -> DataFrame:
    """What to do next, as ``(priority, action, subject, value)``: check features whose information value is suspicious
    for leaks (1), weigh the classes of an imbalanced target (2), recode sentinels that follow from another feature (3; the
    value counts the parent levels), keep one of two redundant categoricals (4), drop features of no information value (5).

    ``positive`` is 1 for rows of the target's event."""
    from tabscope.operators.association import cramers_pairs, information_value, sentinel_dependency
    from tabscope.operators.profile import imbalance_verdict
    iv = information_value(df, list(nums), list(cats), positive, cfg=cfg).where(F.col("strength").isin("suspicious", "useless"))
    leak = F.col("strength") == "suspicious"
    out = iv.select(F.when(leak, 1).otherwise(5).alias("priority"), F.when(leak, "check_leak").otherwise("drop_feature").alias("action"),
                    F.col("feature").alias("subject"), F.col("iv").alias("value"))
    skewed = imbalance_verdict(df, target).where(F.col("verdict").isin("severe", "moderate"))
    out = out.union(skewed.select(F.lit(2), F.lit("weigh_classes"), F.lit(target), F.col("max_share")))
    if len(cats) > 1:
        tied = sentinel_dependency(df, cats, cats).groupBy("child").agg(F.count(F.lit(1)).cast("double").alias("parents"))
        out = out.union(tied.select(F.lit(3), F.lit("recode_sentinel"), "child", "parents"))
        same = cramers_pairs(df, cats).where(F.col("risk") == "redundant")
        out = out.union(same.select(F.lit(4), F.lit("keep_one"), F.concat_ws(" & ", "feature_a", "feature_b"), "cramers_v"))
    return out


def final_summary(df: DataFrame, nums: Sequence[str], cats: Sequence[str], target: str, problem: str) -> DataFrame:
    """Lines ``(line)`` on the problem, the features and, unless it is a regression, the rows of each class (nulls are
    one)."""
    heads = [f"problem: {problem}", f"features: {len(dict.fromkeys([*nums, *cats]))}",
             f"categorical: {', '.join(cats)}", f"numeric: {', '.join(nums)}"]
    one = df.agg(F.count(F.lit(1)).alias("n"))
    out = one.select(F.explode(F.array(*[F.lit(h) for h in heads], F.concat(F.lit("rows: "), F.col("n").cast("string")))).alias("line"))
    if problem == "regression":
        return out
    g = df.groupBy(col(target).cast("string").alias("c")).agg(F.count(F.lit(1)).cast("string").alias("k"))
    return out.union(g.select(F.concat(F.lit("class "), F.coalesce("c", F.lit("(null)")), F.lit(": "), "k")))


def findings_text(findings_df: DataFrame, path: str | None = None) -> DataFrame:
    """One text line per finding (``[severity] section/feature: message``), optionally written as text."""
    lines = findings_df.select(F.format_string("[%s] %s/%s: %s", "severity", "section", "feature", "message").alias("value"))
    if path:
        lines.write.mode("overwrite").text(path)
        return lines.sparkSession.read.text(path)
    return lines


def quality_score_simple(df: DataFrame) -> DataFrame:
    """A42 (band variant): 100 - 20/10 for missing cells > 10 % / > 5 %, - 15/5 for duplicate rows
    > 5 % / > 1 %, - 20 under 100 rows; clipped to [0, 100]."""
    allc = list(df.columns)
    miss = df.agg(F.count(F.lit(1)).alias("n"), sum((F.count_if(col(c).isNull()) for c in allc), F.lit(0)).alias("m"))
    dup = df.groupBy(*[col(c) for c in allc]).agg(F.count(F.lit(1)).alias("k")).agg(
        (F.sum("k") - F.count(F.lit(1))).alias("d")).scalar()
    x = miss.select("n", (100.0 * F.col("m") / (F.col("n") * len(allc))).alias("missing_pct"),
                    (100.0 * dup / F.col("n")).alias("duplicate_pct"))
    score = (F.lit(100) - F.when(F.col("missing_pct") > 10, 20).when(F.col("missing_pct") > 5, 10).otherwise(0)
             - F.when(F.col("duplicate_pct") > 5, 15).when(F.col("duplicate_pct") > 1, 5).otherwise(0)
             - F.when(F.col("n") < 100, 20).otherwise(0))
    return x.select("missing_pct", "duplicate_pct", F.greatest(F.least(score, F.lit(100)), F.lit(0)).cast("int").alias("score"))
