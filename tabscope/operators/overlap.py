"""Train/test overlap, leakage joins, set operations and de-duplication.

Every row-level join is preceded by a group-by on the join keys with a count,
so a key holding a third of all rows becomes a single row before the shuffle
and the join output is a sum of products instead of a row explosion.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabscope.functions.exprs import col
from tabscope.plans.frames import long_values, value_counts, with_totals


def _null_safe_on(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> Column:
    cond = None
    for k in keys:
        c = a[k].eqNullSafe(b[k])
        cond = c if cond is None else cond & c
    return cond


def _keyed_counts(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    return df.groupBy(*[col(k) for k in keys]).agg(F.count(F.lit(1)).alias(name))


def overlap_rows_inner(train: DataFrame, test: DataFrame, features: Sequence[str]) -> DataFrame:
    """Size of the null-safe inner join of train and test on all shared features
    (duplicates multiply), computed as sum(n_train * n_test) over pre-aggregated keys."""
    a = _keyed_counts(train, features, "n1").alias("a")
    b = _keyed_counts(test, features, "n2").alias("b")
    j = a.join(b, _null_safe_on(a, b, features), "inner")
    return j.agg(F.coalesce(F.sum(F.col("n1") * F.col("n2")), F.lit(0)).cast("bigint").alias("n_overlap_rows"),
                 F.count(F.lit(1)).alias("n_shared_keys"))


def overlap_rows_semi(train: DataFrame, test: DataFrame, features: Sequence[str]) -> DataFrame:
    """Number of train rows whose full feature row also occurs in test (null-safe semi join)."""
    a = _keyed_counts(train, features, "n1").alias("a")
    b = test.select(*[col(k) for k in features]).distinct().withColumn("_hit", F.lit(1)).alias("b")
    j = a.join(b, _null_safe_on(a, b, features), "left")
    out = j.agg(F.sum("n1").cast("bigint").alias("n_train"),
                F.coalesce(F.sum(F.when(F.col("_hit") == 1, F.col("n1"))), F.lit(0)).cast("bigint").alias("n_leaked_rows"))
    return out.select("n_leaked_rows", "n_train", (100.0 * F.col("n_leaked_rows") / F.col("n_train")).alias("pct_leaked"))


def id_overlap(train: DataFrame, test: DataFrame, id_cols: Sequence[str]) -> DataFrame:
    """Distinct ids per side and how many occur on both sides, one shuffle for all id columns."""
    a = long_values(train, id_cols).where(F.col("value").isNotNull()).withColumn("side", F.lit(1))
    b = long_values(test, id_cols).where(F.col("value").isNotNull()).withColumn("side", F.lit(2))
    per_value = a.unionByName(b).groupBy("feature", "value").agg(
        F.max((F.col("side") == 1).cast("int")).alias("in_a"), F.max((F.col("side") == 2).cast("int")).alias("in_b"))
    return per_value.groupBy("feature").agg(
        F.sum("in_a").cast("bigint").alias("n_train"), F.sum("in_b").cast("bigint").alias("n_test"),
        F.sum(F.col("in_a") * F.col("in_b")).cast("bigint").alias("n_overlap"))


def _side_cube(train: DataFrame, test: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(feature, value, n_train, n_test) over the union of values: one shuffle."""
    a = value_counts(train, cols, count_col="n").withColumn("side", F.lit("train"))
    b = value_counts(test, cols, count_col="n").withColumn("side", F.lit("test"))
    return a.unionByName(b).groupBy("feature", "value").agg(
        F.sum(F.when(F.col("side") == "train", F.col("n")).otherwise(0)).cast("bigint").alias("n_train"),
        F.sum(F.when(F.col("side") == "test", F.col("n")).otherwise(0)).cast("bigint").alias("n_test"))


def unseen_categories(train: DataFrame, test: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Values present on one side only; ``side`` tells where the value occurs."""
    cube = _side_cube(train, test, cols)
    return cube.where((F.col("n_train") == 0) | (F.col("n_test") == 0)).select(
        "feature", "value", F.when(F.col("n_train") == 0, "test_only").otherwise("train_only").alias("side"),
        (F.col("n_train") + F.col("n_test")).alias("n"))


def category_overlap(train: DataFrame, test: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Uniques per side, overlap count and %, values only in test."""
    cube = _side_cube(train, test, cols)
    g = cube.groupBy("feature").agg(
        F.count_if(F.col("n_train") > 0).alias("n_unique_train"), F.count_if(F.col("n_test") > 0).alias("n_unique_test"),
        F.count_if((F.col("n_train") > 0) & (F.col("n_test") > 0)).alias("n_overlap"),
        F.count_if((F.col("n_train") == 0) & (F.col("n_test") > 0)).alias("n_only_test"))
    return g.withColumn("overlap_pct", 100.0 * F.col("n_overlap") / F.col("n_unique_test"))


def _share_cube(train, test, cols):
    cube = with_totals(_side_cube(train, test, cols), all_train="n_train", all_test="n_test")
    return cube.select("feature", "value", "n_train", "n_test", (F.col("n_train") / F.col("all_train")).alias("p_train"),
                       (F.col("n_test") / F.col("all_test")).alias("p_test"))


def cat_drift_max(train: DataFrame, test: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Max |share_train - share_test| over the union of categories (missing side = 0)."""
    s = _share_cube(train, test, cols)
    return s.groupBy("feature").agg(F.max(F.abs(F.col("p_train") - F.col("p_test"))).alias("max_abs_diff"),
                                    F.count(F.lit(1)).alias("n_levels"))


def cat_drift_mean(train: DataFrame, test: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Mean |share diff| over categories present on both sides."""
    s = _share_cube(train, test, cols).where((F.col("n_train") > 0) & (F.col("n_test") > 0))
    return s.groupBy("feature").agg(F.avg(F.abs(F.col("p_train") - F.col("p_test"))).alias("mean_abs_diff"),
                                    F.count(F.lit(1)).alias("n_common"))


def target_mean_map(df: DataFrame, feature: str, y: Column, keys: Sequence[str]) -> DataFrame:
    """Category -> target mean joined back to every row.

    The statistic table has one row per category; AQE turns the join into a
    broadcast when its measured size is small, otherwise it stays a
    shuffle join."""
    stats = df.groupBy(col(feature)).agg(F.avg(y.cast("double")).alias(f"{feature}_target_mean"))
    return df.select(*[col(k) for k in keys], col(feature)).join(stats, feature, "left")


# ------------------------------------------------------------ set ops / dedup
def union_source(frames: dict[str, DataFrame]) -> DataFrame:
    """Union by name (missing columns -> null) with a ``source`` column."""
    out = None
    for name, df in frames.items():
        d = df.withColumn("source", F.lit(name))
        out = d if out is None else out.unionByName(d, allowMissingColumns=True)
    return out


def source_split(df: DataFrame, source: str) -> DataFrame:
    """The rows of one source, ``source`` column dropped."""
    return df.where(F.col("source") == source).drop("source")


def dup_rows(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Rows minus distinct rows (nulls compare equal, as pandas ``duplicated``)."""
    cols = list(cols or df.columns)
    g = _keyed_counts(df, cols, "k")
    return g.agg(F.sum("k").cast("bigint").alias("n_rows"), (F.sum("k") - F.count(F.lit(1))).cast("bigint").alias("n_duplicates"),
                 F.count_if(F.col("k") > 1).alias("n_duplicated_keys")).withColumn(
        "dup_pct", 100.0 * F.col("n_duplicates") / F.col("n_rows"))


def dup_per_column(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Per column rows - (distinct non-null + has_null)."""
    from tabscope.plans.frames import distinct_counts
    return distinct_counts(df, cols).select("feature", "n_rows", F.when(F.col("n_rows") > 0, F.col("n_rows") - F.col("n_unique") - (
        F.col("n_null") > 0).cast("int")).alias("n_dup"))


def repeated_values(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Values that occur more than once."""
    return value_counts(df, cols).where(F.col("n") > 1)


def dedup_keep(df: DataFrame, subset: Sequence[str], order_by: Sequence[str], keep: str = "last") -> DataFrame:
    """Keep the first / last row per ``subset`` by an explicit ordering.

    A plain ``dropDuplicates`` is used when the order does not matter;
    otherwise a max_by/min_by aggregate keeps one row per key without
    sorting whole groups (a hot key costs one partial row per task)."""
    rest = [c for c in df.columns if c not in subset]
    ordk = F.struct(*[col(c) for c in order_by])
    pick = F.max_by(F.struct(*[col(c) for c in rest]), ordk) if keep == "last" else \
        F.min_by(F.struct(*[col(c) for c in rest]), ordk)
    return df.groupBy(*[col(c) for c in subset]).agg(pick.alias("_r")).select(*subset, "_r.*")
