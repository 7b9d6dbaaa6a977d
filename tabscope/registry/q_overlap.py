"""Sources, filters, joins, set operations and de-duplication queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabscope.operators import cleaning as C
from tabscope.operators import overlap as O
from tabscope.registry.base import (LI_DUPS_SQL, LI_NULLS_SQL, LI_NUM, LI_TEST_SQL, LI_TRAIN_SQL, Y_BIN_SQL, li,
                                    li_dups, li_nulls, li_test, li_train, register, table, union_all, y_binary)
from tabscope.sources import io as IO
from tabscope.session import scratch_path

# ------------------------------------------------------------ sources
_LI_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
            "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


@register("scan_profile", union_all([
    f"SELECT '{c}' AS feature, {i}::BIGINT AS ordinal, count(*)::BIGINT AS n_rows, "
    f"count(*) FILTER (WHERE {c} IS NULL)::BIGINT AS n_null FROM lineitem" for i, c in enumerate(_LI_COLS)]))
def scan_profile(spark, sf):
    """Generic scan (format from the extension) + per-column row / null counts."""
    from tabscope.plans.frames import per_feature
    from tabscope.functions.exprs import col
    df = IO.read_table(spark, f"{sf}/lineitem.parquet")
    pos = {c: i for i, c in enumerate(df.columns)}
    out = per_feature(df, df.columns, lambda i, f: {"ordinal": F.lit(pos[f]).cast("bigint"),
                                                    "n_rows": F.count(F.lit(1)),
                                                    "n_null": F.count_if(col(f).isNull())})
    return out


@register("align_columns",
          "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority, 'train' AS source "
          "FROM orders WHERE o_orderkey % 5 <> 0 UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, "
          "NULL AS o_orderpriority, 'original' AS source FROM orders WHERE o_orderkey % 5 = 0", dbl=["o_totalprice"])
def align_columns(spark, sf):
    """An 'original' table with an extra column and a missing one aligned to train, then unioned."""
    o = table(spark, sf, "orders").drop("o_orderdate")
    train = o.where(F.pmod("o_orderkey", F.lit(5)) != 0)
    orig = (o.where(F.pmod("o_orderkey", F.lit(5)) == 0).drop("o_orderpriority")
            .withColumn("o_norm_price", F.col("o_totalprice") / 1000.0))
    return O.union_source({"train": train, "original": IO.align_columns(train, orig)})


@register("write_roundtrip",
          "SELECT o_orderpriority AS class, count(*)::BIGINT AS n, avg(o_totalprice) AS mean_price FROM orders GROUP BY 1",
          dbl=["mean_price"])
def write_roundtrip(spark, sf):
    """Class table written as CSV and JSON to the shared scratch folder and read back."""
    from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType
    t = table(spark, sf, "orders").groupBy(F.col("o_orderpriority").alias("class")).agg(
        F.count(F.lit(1)).alias("n"), F.avg("o_totalprice").alias("mean_price"))
    p_csv = IO.write_table(t, scratch_path(spark, "roundtrip-csv"), "csv")
    p_json = IO.write_table(IO.read_table(spark, p_csv, "csv", schema=StructType([
        StructField("class", StringType()), StructField("n", LongType()), StructField("mean_price", DoubleType())])),
        scratch_path(spark, "roundtrip-json"), "json")
    return IO.read_table(spark, p_json, "json").select("class", F.col("n").cast("bigint"), "mean_price")


@register("holdout_split",
          "SELECT l_orderkey, l_linenumber, CASE WHEN l_orderkey % 5 = 0 THEN 'test' ELSE 'train' END AS source FROM lineitem")
def holdout_split(spark, sf):
    """S7 (modulo variant; ``hashed=True`` is the default for arbitrary keys)."""
    return IO.holdout_split(li(spark, sf).select("l_orderkey", "l_linenumber"), "l_orderkey", 5, hashed=False)


# ------------------------------------------------------------ projections / filters
@register("drop_columns", "SELECT p_name, p_brand, p_type, p_size, p_retailprice FROM part", dbl=["p_retailprice"])
def drop_columns(spark, sf):
    """Drop id-like columns found by name."""
    return C.drop_columns(table(spark, sf, "part"), pattern=r"(^id$|_id$|key$)")


@register("recode_target",
          "SELECT l_orderkey, l_linenumber, CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 WHEN 'R' THEN 2 END AS y "
          "FROM lineitem")
def recode_target(spark, sf):
    """Label recode by dictionary."""
    return C.recode(li(spark, sf), "l_returnflag", {"A": 0, "N": 1, "R": 2}, "y").select("l_orderkey", "l_linenumber", "y")


_SAN_SRC = ("(SELECT l_extendedprice * 100000000000.0 AS big_price, l_quantity / (l_tax - l_tax) AS ratio_inf, "
            "l_discount FROM lineitem)")


@register("sanitize_extremes", union_all([
    f"SELECT '{c}' AS feature, count(*) FILTER (WHERE CASE WHEN isinf({c}) OR abs({c}) > 1e15 THEN NULL ELSE {c} END "
    f"IS NULL)::BIGINT AS n_null_after FROM {_SAN_SRC} s" for c in ["big_price", "l_discount"]]))
def sanitize_extremes(spark, sf):
    """+-inf and |x| > 1e15 become null (counts of nulls afterwards)."""
    t = li(spark, sf).select((F.col("l_extendedprice") * 1e11).alias("big_price"), "l_discount")
    return C.null_profile_after(C.sanitize_extremes(t, ["big_price", "l_discount"]), ["big_price", "l_discount"])


@register("safe_corr", union_all([
    f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, count(*) FILTER (WHERE {a} IS NOT NULL AND {b} IS NOT NULL)::BIGINT "
    f"AS n_pairs, CASE WHEN count(*) FILTER (WHERE {a} IS NOT NULL AND {b} IS NOT NULL) >= 10 THEN "
    f"corr({a}, {b}) END AS corr FROM {LI_NULLS_SQL} t"
    for i, a in enumerate(LI_NUM) for b in LI_NUM[i + 1:]]), dbl=["corr"])
def safe_corr(spark, sf):
    """Pairwise-complete Pearson with a 10-pair minimum."""
    return C.safe_corr(li_nulls(spark, sf), LI_NUM)


@register("fill_const",
          "SELECT l_orderkey, l_linenumber, coalesce(l_quantity, -999.0) AS l_quantity, coalesce(l_discount, 0.0) AS "
          f"l_discount, coalesce(l_tax, 0.0) AS l_tax FROM {LI_NULLS_SQL} t",
          dbl=["l_quantity", "l_discount", "l_tax"])
def fill_const(spark, sf):
    """P10: constant fill per column."""
    t = li_nulls(spark, sf)
    return C.fill_const(t, {"l_quantity": -999.0, "l_discount": 0.0, "l_tax": 0.0}).select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax")


_NULLS_TRAIN = f"(SELECT * FROM {LI_NULLS_SQL} x WHERE l_orderkey % 5 <> 0)"
_NULLS_TEST = f"(SELECT * FROM {LI_NULLS_SQL} x WHERE l_orderkey % 5 = 0)"


@register("impute_median", union_all([
    f"SELECT '{c}' AS feature, m.med AS fill_value, count(*) FILTER (WHERE t.{c} IS NULL)::BIGINT AS n_filled, "
    f"avg(coalesce(t.{c}, m.med)) AS mean_after FROM {_NULLS_TEST} t, (SELECT quantile_cont({c}, 0.5) AS med FROM "
    f"{_NULLS_TRAIN} r) m GROUP BY m.med" for c in ["l_quantity", "l_discount", "l_tax"]]),
    dbl=["fill_value", "mean_after"])
def impute_median(spark, sf):
    """P11/FE9: train medians filled into test (report per column)."""
    base = li_nulls(spark, sf)
    tr, te = li_train(spark, sf, base), li_test(spark, sf, base)
    return C.impute_report(tr, te, ["l_quantity", "l_discount", "l_tax"], "median")


@register("impute_mode", union_all([
    f"SELECT '{c}' AS feature, m.v AS fill_value, count(*) FILTER (WHERE t.{c} IS NULL)::BIGINT AS n_filled, "
    f"avg(coalesce(t.{c}, m.v)) AS mean_after FROM {_NULLS_TEST} t, (SELECT arg_min({c}, (-n, {c})) AS v FROM "
    f"(SELECT {c}, count(*) AS n FROM {_NULLS_TRAIN} r WHERE {c} IS NOT NULL GROUP BY 1) g) m GROUP BY m.v"
    for c in ["l_quantity", "l_discount", "l_tax"]]), dbl=["fill_value", "mean_after"])
def impute_mode(spark, sf):
    """FE9: most-frequent value of train filled into test."""
    base = li_nulls(spark, sf)
    tr, te = li_train(spark, sf, base), li_test(spark, sf, base)
    return C.impute_report(tr, te, ["l_quantity", "l_discount", "l_tax"], "mode")


@register("outliers_p1p99", union_all([
    f"SELECT '{c}' AS feature, b.p1, b.p99, count(*) FILTER (WHERE {c} < b.p1)::BIGINT AS n_below, "
    f"count(*) FILTER (WHERE {c} > b.p99)::BIGINT AS n_above, 100.0 * count(*) FILTER (WHERE {c} < b.p1 OR {c} > b.p99)"
    f"::DOUBLE / count({c}) AS pct_outside FROM lineitem, (SELECT quantile_cont({c}, 0.01) AS p1, quantile_cont({c}, 0.99) "
    f"AS p99 FROM lineitem) b GROUP BY b.p1, b.p99" for c in LI_NUM]), dbl=["p1", "p99", "pct_outside"])
def outliers_p1p99(spark, sf):
    """Rows outside [p1, p99] per feature."""
    return C.percentile_band(li(spark, sf), LI_NUM, 0.01, 0.99)


@register("iqr_clip_flag", union_all([
    f"SELECT '{c}' AS feature, b.lo AS lower, b.hi AS upper, count(*) FILTER (WHERE {c} < b.lo OR {c} > b.hi)::BIGINT "
    f"AS n_flagged, avg(least(greatest({c}, b.lo), b.hi)) AS mean_clipped, count(*) FILTER (WHERE {c} >= b.lo AND {c} <= b.hi)"
    f"::BIGINT AS n_kept FROM lineitem, (SELECT quantile_cont({c}, 0.25) - 1.5 * (quantile_cont({c}, 0.75) - "
    f"quantile_cont({c}, 0.25)) AS lo, quantile_cont({c}, 0.75) + 1.5 * (quantile_cont({c}, 0.75) - "
    f"quantile_cont({c}, 0.25)) AS hi FROM lineitem) b GROUP BY b.lo, b.hi" for c in LI_NUM]),
    dbl=["lower", "upper", "mean_clipped"])
def iqr_clip_flag(spark, sf):
    """P13/FE14: IQR mask as filter (kept), cap (clipped mean) and flag (count)."""
    return C.iqr_report(li(spark, sf), LI_NUM)


@register("topn_preview",
          "SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_returnflag FROM lineitem "
          "ORDER BY l_orderkey, l_linenumber LIMIT 10", dbl=["l_quantity", "l_extendedprice"])
def topn_preview(spark, sf):
    """head(n) by an explicit order (a distributed top-k, not a global sort)."""
    return li(spark, sf).select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_returnflag") \
        .orderBy("l_orderkey", "l_linenumber").limit(10)


@register("sample_n", rows_only=True)
def sample_n(spark, sf):
    """Seeded sample of n rows without replacement (hash order, engine-stable)."""
    return C.sample_n(li(spark, sf), 500, ["l_orderkey", "l_linenumber"], seed=42)


@register("bootstrap_rows", rows_only=True)
def bootstrap_rows(spark, sf):
    """A bootstrap sample (with replacement) as large as the table."""
    return C.bootstrap_rows(li(spark, sf).select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity"),
                            ["l_orderkey", "l_linenumber", "l_partkey"])


@register("source_split",
          "SELECT p_partkey, p_brand, p_retailprice FROM part WHERE p_partkey % 5 = 0", dbl=["p_retailprice"])
def source_split(spark, sf):
    """U1 + P18: union with a source flag, then take one side back."""
    p = table(spark, sf, "part").select("p_partkey", "p_brand", "p_retailprice")
    u = O.union_source({"train": p.where(F.pmod("p_partkey", F.lit(5)) != 0),
                        "test": p.where(F.pmod("p_partkey", F.lit(5)) == 0)})
    return O.source_split(u, "test")


@register("union_source",
          "SELECT source, count(*)::BIGINT AS n_rows, count(*) FILTER (WHERE p_retailprice IS NULL)::BIGINT AS n_null_price "
          "FROM (SELECT p_partkey, p_retailprice, 'train' AS source FROM part WHERE p_partkey % 5 <> 0 UNION ALL "
          "SELECT p_partkey, NULL AS p_retailprice, 'test' AS source FROM part WHERE p_partkey % 5 = 0) u GROUP BY 1")
def union_source(spark, sf):
    """Union by name with missing columns filled by null."""
    p = table(spark, sf, "part").select("p_partkey", "p_retailprice")
    u = O.union_source({"train": p.where(F.pmod("p_partkey", F.lit(5)) != 0),
                        "test": p.where(F.pmod("p_partkey", F.lit(5)) == 0).drop("p_retailprice")})
    return u.groupBy("source").agg(F.count(F.lit(1)).alias("n_rows"),
                                   F.count_if(F.col("p_retailprice").isNull()).alias("n_null_price"))


# ------------------------------------------------------------ joins
OV_FEATS = ["l_returnflag", "l_linestatus", "l_discount", "l_tax", "l_quantity"]
_NS = " AND ".join(f"a.{c} IS NOT DISTINCT FROM b.{c}" for c in OV_FEATS)
_OVF = ", ".join(OV_FEATS)


@register("overlap_rows_inner",
          f"SELECT coalesce(sum(a.n1 * b.n2), 0)::BIGINT AS n_overlap_rows, count(*)::BIGINT AS n_shared_keys FROM "
          f"(SELECT {_OVF}, count(*) AS n1 FROM {_NULLS_TRAIN} x GROUP BY ALL) a JOIN "
          f"(SELECT {_OVF}, count(*) AS n2 FROM {_NULLS_TEST} y GROUP BY ALL) b ON {_NS}")
def overlap_rows_inner(spark, sf):
    base = li_nulls(spark, sf)
    return O.overlap_rows_inner(li_train(spark, sf, base), li_test(spark, sf, base), OV_FEATS)


@register("overlap_rows_semi",
          f"SELECT n_leaked_rows, n_train, 100.0 * n_leaked_rows::DOUBLE / n_train AS pct_leaked FROM ("
          f"SELECT (SELECT count(*) FROM {_NULLS_TRAIN} a WHERE EXISTS (SELECT 1 FROM {_NULLS_TEST} b WHERE {_NS}))::BIGINT "
          f"AS n_leaked_rows, (SELECT count(*) FROM {_NULLS_TRAIN} c)::BIGINT AS n_train) z", dbl=["pct_leaked"])
def overlap_rows_semi(spark, sf):
    base = li_nulls(spark, sf)
    return O.overlap_rows_semi(li_train(spark, sf, base), li_test(spark, sf, base), OV_FEATS)


ID_COLS = ["l_orderkey", "l_partkey", "l_suppkey"]


@register("id_overlap", union_all([
    f"SELECT '{c}' AS feature, (SELECT count(DISTINCT {c}) FROM {LI_TRAIN_SQL} a)::BIGINT AS n_train, "
    f"(SELECT count(DISTINCT {c}) FROM {LI_TEST_SQL} b)::BIGINT AS n_test, (SELECT count(*) FROM (SELECT {c} FROM "
    f"{LI_TRAIN_SQL} a INTERSECT SELECT {c} FROM {LI_TEST_SQL} b) i)::BIGINT AS n_overlap" for c in ID_COLS]))
def id_overlap(spark, sf):
    return O.id_overlap(li_train(spark, sf), li_test(spark, sf), ID_COLS)


PART_TRAIN_SQL = "(SELECT * FROM part WHERE p_partkey % 5 <> 0)"
PART_TEST_SQL = "(SELECT * FROM part WHERE p_partkey % 5 = 0 AND p_brand NOT LIKE 'Brand#1%')"
PCOLS = ["p_brand", "p_type", "p_size"]


def part_sides(spark, sf):
    p = table(spark, sf, "part")
    return (p.where(F.pmod("p_partkey", F.lit(5)) != 0),
            p.where((F.pmod("p_partkey", F.lit(5)) == 0) & ~F.col("p_brand").like("Brand#1%")))


def _cube_sql():
    def vc(src):
        return union_all([f"SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS value, count(*) AS n FROM {src} s "
                          f"WHERE {c} IS NOT NULL GROUP BY 1, 2" for c in PCOLS])
    return (f"SELECT coalesce(a.feature, b.feature) AS feature, coalesce(a.value, b.value) AS value, "
            f"coalesce(a.n, 0)::BIGINT AS n_train, coalesce(b.n, 0)::BIGINT AS n_test FROM ({vc(PART_TRAIN_SQL)}) a "
            f"FULL OUTER JOIN ({vc(PART_TEST_SQL)}) b ON a.feature = b.feature AND a.value = b.value")


@register("unseen_categories",
          f"SELECT feature, value, CASE WHEN n_train = 0 THEN 'test_only' ELSE 'train_only' END AS side, "
          f"(n_train + n_test)::BIGINT AS n FROM ({_cube_sql()}) c WHERE n_train = 0 OR n_test = 0")
def unseen_categories(spark, sf):
    return O.unseen_categories(*part_sides(spark, sf), PCOLS)


@register("category_overlap",
          f"SELECT feature, count(*) FILTER (WHERE n_train > 0)::BIGINT AS n_unique_train, count(*) FILTER (WHERE n_test > 0)"
          f"::BIGINT AS n_unique_test, count(*) FILTER (WHERE n_train > 0 AND n_test > 0)::BIGINT AS n_overlap, "
          f"count(*) FILTER (WHERE n_train = 0 AND n_test > 0)::BIGINT AS n_only_test, 100.0 * count(*) FILTER "
          f"(WHERE n_train > 0 AND n_test > 0)::DOUBLE / count(*) FILTER (WHERE n_test > 0) AS overlap_pct "
          f"FROM ({_cube_sql()}) c GROUP BY feature", dbl=["overlap_pct"])
def category_overlap(spark, sf):
    return O.category_overlap(*part_sides(spark, sf), PCOLS)


_SHARE = (f"SELECT feature, value, n_train, n_test, n_train::DOUBLE / sum(n_train) OVER (PARTITION BY feature) AS p_train, "
          f"n_test::DOUBLE / sum(n_test) OVER (PARTITION BY feature) AS p_test FROM ({_cube_sql()}) c")


@register("cat_drift_max",
          f"SELECT feature, max(abs(p_train - p_test)) AS max_abs_diff, count(*)::BIGINT AS n_levels FROM ({_SHARE}) s "
          f"GROUP BY feature", dbl=["max_abs_diff"])
def cat_drift_max(spark, sf):
    return O.cat_drift_max(*part_sides(spark, sf), PCOLS)


@register("cat_drift_mean",
          f"SELECT feature, avg(abs(p_train - p_test)) AS mean_abs_diff, count(*)::BIGINT AS n_common FROM ({_SHARE}) s "
          f"WHERE n_train > 0 AND n_test > 0 GROUP BY feature", dbl=["mean_abs_diff"])
def cat_drift_mean(spark, sf):
    return O.cat_drift_mean(*part_sides(spark, sf), PCOLS)


@register("target_mean_map",
          f"SELECT l_orderkey, l_linenumber, l.l_linestatus, m.te AS l_linestatus_target_mean FROM lineitem l LEFT JOIN "
          f"(SELECT l_linestatus, avg({Y_BIN_SQL}::DOUBLE) AS te FROM lineitem GROUP BY 1) m ON l.l_linestatus = m.l_linestatus",
          dbl=["l_linestatus_target_mean"])
def target_mean_map(spark, sf):
    return O.target_mean_map(li(spark, sf), "l_linestatus", y_binary(), ["l_orderkey", "l_linenumber"])


# ------------------------------------------------------------ duplicates
_ALL = ", ".join(_LI_COLS)
_FEATS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linestatus", "l_shipdate"]


def _dup_sql(cols):
    c = ", ".join(cols)
    return (f"SELECT sum(k)::BIGINT AS n_rows, (sum(k) - count(*))::BIGINT AS n_duplicates, count(*) FILTER (WHERE k > 1)"
            f"::BIGINT AS n_duplicated_keys, 100.0 * (sum(k) - count(*))::DOUBLE / sum(k) AS dup_pct FROM "
            f"(SELECT {c}, count(*) AS k FROM {LI_DUPS_SQL} d GROUP BY ALL) g")


@register("dup_rows", _dup_sql(_LI_COLS), dbl=["dup_pct"])
def dup_rows(spark, sf):
    return O.dup_rows(li_dups(spark, sf))


@register("dup_feature_rows", _dup_sql(_FEATS), dbl=["dup_pct"])
def dup_feature_rows(spark, sf):
    """U4: duplicates on the feature projection (ids and target ignored)."""
    return O.dup_rows(li_dups(spark, sf), _FEATS)


_DPC = ["l_orderkey", "l_quantity", "l_discount", "l_tax", "l_returnflag"]


@register("dup_per_column", union_all([
    f"SELECT '{c}' AS feature, count(*)::BIGINT AS n_rows, (count(*) - count(DISTINCT {c}) - "
    f"max(CAST({c} IS NULL AS INTEGER)))::BIGINT AS n_dup FROM {LI_NULLS_SQL} t" for c in _DPC]))
def dup_per_column(spark, sf):
    return O.dup_per_column(li_nulls(spark, sf), _DPC)


@register("repeated_values", union_all([
    f"SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS value, count(*)::BIGINT AS n FROM customer WHERE {c} IS NOT NULL "
    f"GROUP BY 1, 2 HAVING count(*) > 1" for c in ["c_nationkey", "c_mktsegment", "c_name"]]))
def repeated_values(spark, sf):
    return O.repeated_values(table(spark, sf, "customer"), ["c_nationkey", "c_mktsegment", "c_name"])


@register("dedup_keep_last",
          f"SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag FROM (SELECT l_orderkey, l_linenumber, l_quantity, "
          f"l_returnflag, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber DESC, l_quantity DESC, l_returnflag DESC) AS rn "
          f"FROM {LI_DUPS_SQL} d) x WHERE rn = 1", dbl=["l_quantity"])
def dedup_keep_last(spark, sf):
    t = li_dups(spark, sf).select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag")
    return O.dedup_keep(t, ["l_orderkey"], ["l_linenumber", "l_quantity", "l_returnflag"], keep="last")
