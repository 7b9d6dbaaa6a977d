"""Profile queries on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabscope.operators import profile as P
from tabscope.plans import roles as R
from tabscope.registry.base import (LI_CAT, LI_DUPS_SQL, LI_NULLS_SQL, LI_NUM, LI_TARGET, LI_TEST_SQL, LI_TRAIN_SQL,
                                    Y_BIN_SQL, li, li_nulls, li_test, li_train, register, table, union_all,
                                    y_binary)

PCTS = [0.01, 0.05, 0.10, 0.25, 0.50, 0.75, 0.90, 0.95, 0.99]
PNAMES = ["p01", "p05", "p10", "p25", "p50", "p75", "p90", "p95", "p99"]


def _q(c, p):
    return f"quantile_cont({c}, {p})"


# ------------------------------------------------------------ describe family
@register("describe_by_class", union_all([
    f"SELECT CAST(l_returnflag AS VARCHAR) AS class, '{c}' AS feature, count({c})::BIGINT AS n, avg({c}) AS mean, "
    f"stddev_samp({c}) AS std, min({c})::DOUBLE AS min, "
    + ", ".join(f"{_q(c, p)} AS {n}" for p, n in zip(PCTS, PNAMES))
    + f", max({c})::DOUBLE AS max FROM lineitem GROUP BY 1" for c in LI_NUM]),
    dbl=["mean", "std", "min", *PNAMES, "max"])
def describe_by_class(spark, sf):
    """9-percentile describe of lineitem numerics per return flag."""
    return P.describe_by_class(li(spark, sf), LI_NUM, LI_TARGET)


@register("describe_numeric", union_all([
    f"SELECT '{c}' AS feature, count({c})::BIGINT AS n, avg({c}) AS mean, stddev_samp({c}) AS std, "
    f"min({c})::DOUBLE AS min, {_q(c, 0.25)} AS p25, {_q(c, 0.5)} AS p50, {_q(c, 0.75)} AS p75, "
    f"max({c})::DOUBLE AS max FROM {LI_NULLS_SQL} t" for c in LI_NUM]),
    dbl=["mean", "std", "min", "p25", "p50", "p75", "max"])
def describe_numeric(spark, sf):
    return P.describe_numeric(li_nulls(spark, sf), LI_NUM)


def vc_sql(src, cols, dropna=True, by=None):
    parts = []
    for c in cols:
        b = f", CAST({by} AS VARCHAR) AS class" if by else ""
        w = f"WHERE {c} IS NOT NULL" if dropna else ""
        if by:
            w = (w + " AND " if w else "WHERE ") + f"{by} IS NOT NULL"
        parts.append(f"SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS value{b}, count(*)::BIGINT AS n "
                     f"FROM {src} t {w} GROUP BY ALL")
    return union_all(parts)


def top_sql(vc):
    return (f"SELECT feature, sum(n)::BIGINT AS n, count(*)::BIGINT AS n_unique, "
            f"arg_min(value, (-n, value)) AS top, max(n)::BIGINT AS top_n FROM ({vc}) v GROUP BY feature")


CAT_COLS = ["l_returnflag", "l_linestatus", "l_linenumber", "l_discount"]


@register("describe_categorical",
          f"SELECT feature, n, n_unique, top, top_n AS freq FROM ({top_sql(vc_sql('lineitem', CAT_COLS))}) x")
def describe_categorical(spark, sf):
    return P.describe_categorical(li(spark, sf), CAT_COLS)


@register("summary_extended", union_all([
    f"SELECT '{c}' AS feature, count({c})::BIGINT AS n, count(*) FILTER (WHERE {c} IS NULL)::BIGINT AS n_null, "
    f"avg({c}) AS mean, stddev_samp({c}) AS std, min({c})::DOUBLE AS min, "
    + ", ".join(f"{_q(c, p)} AS {n}" for p, n in [(0.01, 'p01'), (0.05, 'p05'), (0.25, 'p25'), (0.5, 'p50'),
                                                  (0.75, 'p75'), (0.95, 'p95'), (0.99, 'p99')])
    + f", max({c})::DOUBLE AS max, {_q(c, 0.75)} - {_q(c, 0.25)} AS iqr, "
    f"avg(power({c} - (SELECT avg({c}) FROM {LI_NULLS_SQL} s), 3)) / power(var_pop({c}), 1.5) AS skew, "
    f"kurtosis_pop({c}) AS kurt FROM {LI_NULLS_SQL} t" for c in LI_NUM]),
    dbl=["mean", "std", "min", "p01", "p05", "p25", "p50", "p75", "p95", "p99", "max", "iqr", "skew", "kurt"])
def summary_extended(spark, sf):
    return P.summary_extended(li_nulls(spark, sf), LI_NUM)


def _g1(c, src):
    return (f"(avg(power({c} - (SELECT avg({c}) FROM {src} s), 3)) / power(var_pop({c}), 1.5))")


def _G1(c, src):
    n = f"count({c})::DOUBLE"
    return f"({_g1(c, src)} * sqrt({n} * ({n} - 1)) / ({n} - 2))"


@register("numeric_advice", union_all([
    f"SELECT '{c}' AS feature, count({c})::BIGINT AS n, avg({c}) AS mean, {_q(c, 0.5)} AS median, "
    f"stddev_samp({c}) AS std, min({c})::DOUBLE AS min, max({c})::DOUBLE AS max, {_G1(c, 'lineitem')} AS skew, "
    f"CASE WHEN abs({_G1(c, 'lineitem')}) > 1 THEN 'log transform' WHEN abs({_G1(c, 'lineitem')}) > 0.5 "
    f"THEN 'sqrt transform' ELSE 'none' END AS advice FROM lineitem" for c in LI_NUM]),
    dbl=["mean", "median", "std", "min", "max", "skew"])
def numeric_advice(spark, sf):
    return P.numeric_advice(li(spark, sf), LI_NUM)


@register("numeric_compact", union_all([
    f"SELECT '{c}' AS feature, count({c})::BIGINT AS n, avg({c}) AS mean, stddev_samp({c}) AS std, "
    f"{_G1(c, 'lineitem')} AS skew, "
    f"100.0 * count(*) FILTER (WHERE {c} < b.lo OR {c} > b.hi)::DOUBLE / count({c}) AS pct_outliers, "
    f"100.0 * count(*) FILTER (WHERE {c} = 0)::DOUBLE / count({c}) AS pct_zero, "
    f"100.0 * count(*) FILTER (WHERE {c} < 0)::DOUBLE / count({c}) AS pct_negative "
    f"FROM lineitem, (SELECT {_q(c, 0.25)} - 1.5 * ({_q(c, 0.75)} - {_q(c, 0.25)}) AS lo, "
    f"{_q(c, 0.75)} + 1.5 * ({_q(c, 0.75)} - {_q(c, 0.25)}) AS hi FROM lineitem) b" for c in LI_NUM]),
    dbl=["mean", "std", "skew", "pct_outliers", "pct_zero", "pct_negative"])
def numeric_compact(spark, sf):
    return P.numeric_compact(li(spark, sf), LI_NUM)


# ------------------------------------------------------------ missing family
NULL_COLS = ["l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
             "l_returnflag", "l_linestatus"]
MISS3 = ["l_quantity", "l_discount", "l_tax"]


@register("null_profile", union_all([
    f"SELECT '{c}' AS feature, count(*)::BIGINT AS n_rows, count(*) FILTER (WHERE {c} IS NULL)::BIGINT AS n_null, "
    f"100.0 * count(*) FILTER (WHERE {c} IS NULL)::DOUBLE / count(*) AS pct_null FROM {LI_NULLS_SQL} t"
    for c in NULL_COLS]), dbl=["pct_null"])
def null_profile(spark, sf):
    return P.null_profile(li_nulls(spark, sf))


_MISS_SUM = " + ".join(f"count(*) FILTER (WHERE {c} IS NULL)" for c in NULL_COLS)


@register("missing_overall",
          f"SELECT (count(*) * {len(NULL_COLS)})::BIGINT AS n_cells, ({_MISS_SUM})::BIGINT AS n_missing, "
          f"100.0 * ({_MISS_SUM})::DOUBLE / (count(*) * {len(NULL_COLS)}) AS pct_missing, "
          f"CASE WHEN 100.0 * ({_MISS_SUM})::DOUBLE / (count(*) * {len(NULL_COLS)}) > 30 THEN 'high' "
          f"WHEN 100.0 * ({_MISS_SUM})::DOUBLE / (count(*) * {len(NULL_COLS)}) > 5 THEN 'moderate' ELSE 'low' END "
          f"AS severity FROM {LI_NULLS_SQL} t", dbl=["pct_missing"])
def missing_overall(spark, sf):
    return P.missing_overall(li_nulls(spark, sf))


def _np_sql(src, cols):
    return union_all([
        f"SELECT '{c}' AS feature, 100.0 * count(*) FILTER (WHERE {c} IS NULL)::DOUBLE / count(*) AS pct FROM {src} t"
        for c in cols])


NC_TRAIN = NULL_COLS
NC_TEST = [c for c in NULL_COLS if c != "l_returnflag"]


@register("null_compare",
          f"SELECT coalesce(a.feature, b.feature) AS feature, a.pct AS pct_train, b.pct AS pct_test, "
          f"abs(a.pct - b.pct) AS gap, CAST(a.pct IS NOT NULL AS INTEGER) AS in_train, "
          f"CAST(b.pct IS NOT NULL AS INTEGER) AS in_test, coalesce(CAST(abs(a.pct - b.pct) > 10.0 AS INTEGER), 0) AS warn "
          f"FROM ({_np_sql(f'(SELECT * FROM {LI_NULLS_SQL} x WHERE l_orderkey % 5 <> 0)', NC_TRAIN)}) a FULL OUTER JOIN "
          f"({_np_sql(f'(SELECT * FROM {LI_NULLS_SQL} x WHERE l_orderkey % 5 = 0)', NC_TEST)}) b ON a.feature = b.feature",
          dbl=["pct_train", "pct_test", "gap"])
def null_compare(spark, sf):
    """A5: the test side lacks the target column."""
    base = li_nulls(spark, sf)
    return P.null_compare(li_train(spark, sf, base), li_test(spark, sf, base).drop("l_returnflag"))


def _pairs(cols):
    return [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]


def _ind(c):
    return f"CAST({c} IS NULL AS DOUBLE)"


@register("null_corr", union_all([
    f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, corr({_ind(a)}, {_ind(b)}) AS corr FROM {LI_NULLS_SQL} t"
    for a, b in _pairs(MISS3)]), dbl=["corr"])
def null_corr(spark, sf):
    return P.null_corr(li_nulls(spark, sf), MISS3)


_PAT = " || ".join(f"CAST(CAST({c} IS NULL AS INTEGER) AS VARCHAR)" for c in MISS3)


@register("null_patterns",
          f"SELECT pattern, n, length(replace(pattern, '0', ''))::BIGINT AS n_missing_cols, "
          f"100.0 * n::DOUBLE / sum(n) OVER () AS pct FROM (SELECT {_PAT} AS pattern, count(*)::BIGINT AS n "
          f"FROM {LI_NULLS_SQL} t GROUP BY 1) x", dbl=["pct"])
def null_patterns(spark, sf):
    return P.null_patterns(li_nulls(spark, sf), MISS3)


@register("null_mechanism", union_all([
    f"SELECT '{c}' AS feature, count(*) FILTER (WHERE {c} IS NULL)::BIGINT AS n_null, "
    f"corr({_ind(c)}, {Y_BIN_SQL}::DOUBLE) AS corr_target, "
    f"CASE WHEN abs(corr({_ind(c)}, {Y_BIN_SQL}::DOUBLE)) > 0.1 THEN 'MNAR?' ELSE 'MCAR/MAR' END AS mechanism "
    f"FROM {LI_NULLS_SQL} t" for c in MISS3]), dbl=["corr_target"])
def null_mechanism(spark, sf):
    return P.null_mechanism(li_nulls(spark, sf), MISS3, y_binary())


_MCAR_SUM = " + ".join(f"coalesce(abs(corr({_ind(a)}, {_ind(b)})), 0.0)" for a, b in _pairs(MISS3))


@register("mcar_hint",
          f"SELECT {len(MISS3)}::BIGINT AS n_columns, 2.0 * ({_MCAR_SUM}) / {len(MISS3) ** 2}.0 AS mean_abs_corr, "
          f"CASE WHEN 2.0 * ({_MCAR_SUM}) / {len(MISS3) ** 2}.0 < 0.1 THEN 'MCAR likely' ELSE 'not MCAR' END AS hint "
          f"FROM {LI_NULLS_SQL} t", dbl=["mean_abs_corr"])
def mcar_hint(spark, sf):
    return P.mcar_hint(li_nulls(spark, sf), MISS3)


def _ia_row(c, numeric):
    p = f"(count(*) FILTER (WHERE {c} IS NULL)::DOUBLE / count(*))"
    sk = _g1(c, LI_NULLS_SQL) if numeric else "NULL::DOUBLE"
    fill = ("'mode'" if not numeric else f"CASE WHEN abs({sk}) > 1 THEN 'median' ELSE 'mean' END")
    return (f"SELECT '{c}' AS feature, count(*) FILTER (WHERE {c} IS NULL)::BIGINT AS n_null, 100.0 * {p} AS pct_null, "
            f"{sk} AS skew, {fill} AS simple_fill, CASE WHEN {p} > 0.6 THEN 'drop column' WHEN {p} > 0.2 "
            f"THEN 'simple fill, then a model of the rest' WHEN {p} > 0 THEN 'model of the other columns' ELSE 'none' END AS recommendation "
            f"FROM {LI_NULLS_SQL} t")


@register("impute_advice", "SELECT * FROM (" + union_all([_ia_row(c, True) for c in MISS3]) + ") z WHERE n_null > 0",
          dbl=["pct_null", "skew"])
def impute_advice(spark, sf):
    return P.impute_advice(li_nulls(spark, sf), MISS3)


# ------------------------------------------------------------ categorical family
@register("category_summary",
          f"SELECT feature, n, n_unique, top, top_n, 100.0 * top_n::DOUBLE / n AS top_pct, "
          f"n_unique::DOUBLE / n AS cardinality_ratio, CAST(n_unique > 20 AS INTEGER) AS many_levels "
          f"FROM ({top_sql(vc_sql('part', ['p_brand', 'p_type', 'p_size', 'p_name']))}) x",
          dbl=["top_pct", "cardinality_ratio"])
def category_summary(spark, sf):
    return P.category_summary(table(spark, sf, "part"), ["p_brand", "p_type", "p_size", "p_name"])


@register("category_top30",
          f"SELECT feature, value, n, pct, rank FROM (SELECT feature, value, n, 100.0 * n::DOUBLE / sum(n) OVER "
          f"(PARTITION BY feature) AS pct, row_number() OVER (PARTITION BY feature ORDER BY n DESC, value)::BIGINT AS rank "
          f"FROM ({vc_sql('part', ['p_brand', 'p_type', 'p_size'])}) v) x WHERE rank <= 30", dbl=["pct"])
def category_top30(spark, sf):
    return P.category_top(table(spark, sf, "part"), ["p_brand", "p_type", "p_size"], 30)


@register("rare_categories",
          f"SELECT feature, value, n, CASE WHEN n < 5 THEN 'rare' ELSE 'frequent' END AS kind "
          f"FROM ({vc_sql('orders', ['o_custkey', 'o_orderpriority', 'o_orderstatus'])}) v WHERE n < 5 OR n > 100")
def rare_categories(spark, sf):
    return P.rare_categories(table(spark, sf, "orders"), ["o_custkey", "o_orderpriority", "o_orderstatus"])


@register("cardinality", union_all([
    f"SELECT '{c}' AS feature, count(DISTINCT {c})::BIGINT AS n_unique, count(DISTINCT {c})::DOUBLE / count(*) "
    f"AS unique_ratio FROM lineitem" for c in ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                                               "l_extendedprice", "l_discount", "l_tax", "l_returnflag",
                                               "l_linestatus", "l_shipdate"]]), dbl=["unique_ratio"])
def cardinality(spark, sf):
    return P.cardinality(li(spark, sf))


QC_COLS = ["l_returnflag", "l_linestatus", "l_linenumber", "l_tax", "l_discount"]


@register("quasi_constant",
          f"SELECT feature, n_unique, top_n::DOUBLE / n AS top_share, CAST(n_unique <= 1 AS INTEGER) AS constant, "
          f"CAST(top_n::DOUBLE / n > 0.97 AS INTEGER) AS quasi_constant FROM "
          f"({top_sql(vc_sql(LI_NULLS_SQL, QC_COLS, dropna=False))}) x", dbl=["top_share"])
def quasi_constant(spark, sf):
    return P.quasi_constant(li_nulls(spark, sf), QC_COLS)


@register("near_zero_variance",
          f"SELECT feature, top_n::DOUBLE / n AS top_share, n_unique::DOUBLE / n AS unique_ratio, "
          f"CAST(top_n::DOUBLE / n > 0.95 OR n_unique::DOUBLE / n < 0.01 AS INTEGER) AS nzv FROM "
          f"({top_sql(vc_sql('lineitem', ['l_returnflag', 'l_linestatus', 'l_linenumber', 'l_quantity', 'l_partkey']))}) x",
          dbl=["top_share", "unique_ratio"])
def near_zero_variance(spark, sf):
    return P.near_zero_variance(li(spark, sf), ["l_returnflag", "l_linestatus", "l_linenumber", "l_quantity",
                                                "l_partkey"])


ENT_COLS = ["l_returnflag", "l_linestatus", "l_linenumber", "l_discount", "l_tax"]


@register("category_entropy",
          f"SELECT feature, n_levels, entropy, log2(n_levels::DOUBLE) AS max_entropy, "
          f"CASE WHEN n_levels > 1 THEN entropy / log2(n_levels::DOUBLE) ELSE 0.0 END AS normalized, "
          f"CAST(CASE WHEN n_levels > 1 THEN entropy / log2(n_levels::DOUBLE) ELSE 0.0 END < 0.3 AS INTEGER) AS low "
          f"FROM (SELECT feature, -sum(p * log2(p)) AS entropy, count(*)::BIGINT AS n_levels FROM "
          f"(SELECT feature, n::DOUBLE / sum(n) OVER (PARTITION BY feature) AS p FROM ({vc_sql('lineitem', ENT_COLS)}) v) y "
          f"GROUP BY feature) z", dbl=["entropy", "max_entropy", "normalized"])
def category_entropy(spark, sf):
    return P.category_entropy(li(spark, sf), ENT_COLS)


# ------------------------------------------------------------ target
@register("target_distribution",
          "SELECT class, n, 100.0 * n::DOUBLE / sum(n) OVER () AS pct, max(n) OVER () ::DOUBLE / n AS ratio FROM "
          "(SELECT CAST(o_orderpriority AS VARCHAR) AS class, count(*)::BIGINT AS n FROM orders GROUP BY 1) x",
          dbl=["pct", "ratio"])
def target_distribution(spark, sf):
    return P.target_distribution(table(spark, sf, "orders"), "o_orderpriority")


@register("imbalance_verdict",
          "SELECT count(*)::BIGINT AS n_classes, max(n)::DOUBLE / sum(n) AS max_share, min(n)::DOUBLE / sum(n) AS min_share, "
          "max(n)::DOUBLE / min(n) AS max_min_ratio, min(n)::DOUBLE / max(n) AS min_max_ratio, "
          "CASE WHEN max(n)::DOUBLE / sum(n) > 0.8 THEN 'severe' WHEN max(n)::DOUBLE / sum(n) > 0.6 THEN 'moderate' "
          "WHEN max(n)::DOUBLE / min(n) > 10 THEN 'minority rare' ELSE 'balanced' END AS verdict "
          "FROM (SELECT l_returnflag, count(*) AS n FROM lineitem GROUP BY 1) x",
          dbl=["max_share", "min_share", "max_min_ratio", "min_max_ratio"])
def imbalance_verdict(spark, sf):
    return P.imbalance_verdict(li(spark, sf), LI_TARGET)


def _G2(c, src):
    n = f"count({c})::DOUBLE"
    return f"((({n} + 1) * kurtosis_pop({c}) + 6) * ({n} - 1) / (({n} - 2) * ({n} - 3)))"


@register("target_regression",
          f"SELECT count(c_acctbal)::BIGINT AS n, avg(c_acctbal) AS mean, stddev_samp(c_acctbal) AS std, "
          f"min(c_acctbal) AS min, {_q('c_acctbal', 0.25)} AS p25, {_q('c_acctbal', 0.5)} AS p50, "
          f"{_q('c_acctbal', 0.75)} AS p75, max(c_acctbal) AS max, {_G1('c_acctbal', 'customer')} AS skew, "
          f"{_G2('c_acctbal', 'customer')} AS kurt, avg(CAST(c_acctbal = 0 AS DOUBLE)) AS zero_ratio, "
          f"avg(CAST(c_acctbal < 0 AS DOUBLE)) AS negative_ratio FROM customer",
          dbl=["mean", "std", "min", "p25", "p50", "p75", "max", "skew", "kurt", "zero_ratio", "negative_ratio"])
def target_regression(spark, sf):
    return P.target_regression(table(spark, sf, "customer"), "c_acctbal")


CT_COLS = ["l_linestatus", "l_linenumber", "l_discount"]


def _cts_sql():
    parts = [f"SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS value, count(*)::BIGINT AS n, "
             f"avg({Y_BIN_SQL}::DOUBLE) AS target_mean, stddev_samp({Y_BIN_SQL}::DOUBLE) AS target_std, "
             f"sum({Y_BIN_SQL}::DOUBLE) AS positives FROM lineitem WHERE {c} IS NOT NULL GROUP BY 1, 2" for c in CT_COLS]
    return (f"SELECT *, 100.0 * n::DOUBLE / sum(n) OVER (PARTITION BY feature) AS pct FROM ({union_all(parts)}) x")


@register("category_target_stats", _cts_sql(), dbl=["target_mean", "target_std", "positives", "pct"])
def category_target_stats(spark, sf):
    return P.category_target_stats(li(spark, sf), CT_COLS, y_binary())


@register("bivariate_rates",
          f"SELECT feature, value, n, positives, target_mean AS rate FROM ({_cts_sql()}) z",
          dbl=["positives", "rate"])
def bivariate_rates(spark, sf):
    """Positive count and rate per category (long table)."""
    return P.category_target_stats(li(spark, sf), CT_COLS, y_binary()).select(
        "feature", "value", "n", "positives", F.col("target_mean").alias("rate"))


XT_SQL = (f"SELECT feature, value, class, n, n::DOUBLE / sum(n) OVER (PARTITION BY feature, value) AS row_share "
          f"FROM ({vc_sql('lineitem', CT_COLS, by='l_returnflag')}) v")


@register("crosstab", f"SELECT feature, value, class, n FROM ({XT_SQL}) x")
def crosstab(spark, sf):
    return P.crosstab(li(spark, sf), CT_COLS, LI_TARGET).drop("row_share")


@register("crosstab_norm", XT_SQL, dbl=["row_share"])
def crosstab_norm(spark, sf):
    return P.crosstab(li(spark, sf), CT_COLS, LI_TARGET)


@register("category_top_class",
          f"SELECT feature, value, sum(n)::BIGINT AS n, arg_min(class, (-n, class)) AS top_class, "
          f"max(n)::DOUBLE / sum(n) AS top_share FROM ({XT_SQL}) x GROUP BY feature, value", dbl=["top_share"])
def category_top_class(spark, sf):
    return P.category_top_class(li(spark, sf), CT_COLS, LI_TARGET)


@register("class_means", union_all([
    f"SELECT CAST(l_returnflag AS VARCHAR) AS class, '{c}' AS feature, avg({c}) AS mean FROM lineitem GROUP BY 1"
    for c in LI_NUM]), dbl=["mean"])
def class_means(spark, sf):
    return P.class_means(li(spark, sf), LI_NUM, LI_TARGET)


# ------------------------------------------------------------ types, text, rules
@register("dataset_overview",
          "SELECT count(*)::BIGINT AS n_rows, 11::BIGINT AS n_cols, "
          "(SELECT count(*) FROM information_schema.columns WHERE table_name = 'lineitem' AND data_type IN "
          "('BIGINT', 'INTEGER', 'DOUBLE'))::BIGINT AS n_numeric, "
          "(SELECT count(*) FROM information_schema.columns WHERE table_name = 'lineitem' AND data_type = 'VARCHAR')::BIGINT "
          "AS n_categorical, (SELECT count(*) FROM information_schema.columns WHERE table_name = 'lineitem' AND "
          "data_type LIKE 'TIMESTAMP%')::BIGINT AS n_datetime, 0::BIGINT AS n_other FROM lineitem")
def dataset_overview(spark, sf):
    return P.dataset_overview(li(spark, sf))


@register("column_roles",
          "SELECT column_name AS feature, (ordinal_position - 1)::BIGINT AS ordinal, CASE WHEN data_type IN "
          "('BIGINT', 'INTEGER', 'DOUBLE', 'FLOAT', 'SMALLINT', 'TINYINT') THEN 'numeric' WHEN data_type IN "
          "('VARCHAR', 'BOOLEAN') THEN 'categorical' WHEN data_type LIKE 'TIMESTAMP%' OR data_type = 'DATE' "
          "THEN 'datetime' ELSE 'other' END AS role FROM information_schema.columns WHERE table_name = 'orders'")
def column_roles(spark, sf):
    return R.column_roles(table(spark, sf, "orders"))


_ORD = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
_ORD_FAM = {"o_orderkey": "numeric", "o_custkey": "numeric", "o_orderstatus": "categorical",
            "o_totalprice": "numeric", "o_orderdate": "datetime", "o_orderpriority": "categorical"}


@register("column_roles_card", union_all([
    f"SELECT '{c}' AS feature, count(DISTINCT {c})::BIGINT AS n_unique, CASE WHEN '{_ORD_FAM[c]}' = 'numeric' AND "
    f"count(DISTINCT {c}) <= 12 THEN 'categorical' ELSE '{_ORD_FAM[c]}' END AS role FROM lineitem_orders_guard"
    .replace("lineitem_orders_guard", "orders") for c in _ORD]))
def column_roles_card(spark, sf):
    return R.column_roles_card(table(spark, sf, "orders"))


@register("problem_type", union_all([
    f"SELECT '{c}' AS target, count(DISTINCT {c})::BIGINT AS n_classes, CASE WHEN count(DISTINCT {c}) = 2 THEN 'binary' "
    f"WHEN {int(num)} = 0 OR count(DISTINCT {c}) <= 20 THEN 'multiclass' ELSE 'regression' END AS problem_type "
    f"FROM lineitem" for c, num in [("l_returnflag", False), ("l_linestatus", False), ("l_quantity", True),
                                    ("l_linenumber", True)]]))
def problem_type(spark, sf):
    return R.problem_type(li(spark, sf), ["l_returnflag", "l_linestatus", "l_quantity", "l_linenumber"])


@register("dtype_breakdown",
          "SELECT CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double' "
          "WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' ELSE lower(data_type) END AS dtype, "
          "count(*)::BIGINT AS n_columns FROM information_schema.columns WHERE table_name = 'lineitem' GROUP BY 1")
def dtype_breakdown(spark, sf):
    return P.dtype_breakdown(li(spark, sf))


def _dtype_adv_sql():
    parts = []
    spec = [("c_custkey", "bigint"), ("c_nationkey", "int"), ("c_acctbal", "double"), ("c_name", "string"),
            ("c_mktsegment", "string")]
    for c, t in spec:
        if t == "string":
            parts.append(f"SELECT '{c}' AS feature, '{t}' AS dtype, NULL::DOUBLE AS mn, NULL::DOUBLE AS mx, "
                         f"CASE WHEN count(DISTINCT {c})::DOUBLE / count(*) < 0.5 THEN 'category' ELSE 'keep' END AS advice "
                         f"FROM customer")
            continue
        integral = ("TRUE" if t != "double" else f"(count(*) FILTER (WHERE {c}::DOUBLE <> floor({c}::DOUBLE)) = 0)")
        mn, mx = f"min({c})::DOUBLE", f"max({c})::DOUBLE"
        parts.append(
            f"SELECT '{c}' AS feature, '{t}' AS dtype, {mn} AS mn, {mx} AS mx, CASE "
            f"WHEN {integral} AND {mn} >= -128 AND {mx} <= 127 THEN 'tinyint' "
            f"WHEN {integral} AND {mn} >= -32768 AND {mx} <= 32767 THEN 'smallint' "
            f"WHEN {integral} AND {mn} >= -2147483648 AND {mx} <= 2147483647 THEN 'int' "
            f"WHEN '{t}' = 'double' THEN 'float' ELSE 'keep' END AS advice FROM customer")
    return union_all(parts)


@register("dtype_advice", _dtype_adv_sql(), dbl=["mn", "mx"])
def dtype_advice(spark, sf):
    return P.dtype_advice(table(spark, sf, "customer"))


def _susp_sql():
    src = ("(SELECT CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS qty_text, "
           "strftime(l_shipdate, '%Y-%m-%d') AS ship_text, l_returnflag, l_linestatus FROM lineitem)")
    parts = []
    for c in ["qty_text", "ship_text", "l_returnflag", "l_linestatus"]:
        x = f"coalesce({c}, 'nan')"
        num = f"count(*) FILTER (WHERE regexp_full_match({x}, '^\\d+\\.?\\d*$'))::DOUBLE / count(*)"
        dat = f"count(*) FILTER (WHERE regexp_matches({x}, '\\d{{4}}-\\d{{2}}-\\d{{2}}'))::DOUBLE / count(*)"
        parts.append(f"SELECT '{c}' AS feature, {num} AS numeric_share, {dat} AS date_share, "
                     f"count(DISTINCT {c})::BIGINT AS n_unique, CAST({num} > 0.8 AS INTEGER) AS looks_numeric, "
                     f"CAST({dat} > 0.5 AS INTEGER) AS looks_date, CAST(count(DISTINCT {c}) = 1 AS INTEGER) AS constant "
                     f"FROM {src} s")
    return union_all(parts)


@register("suspicious_types", _susp_sql(), dbl=["numeric_share", "date_share"])
def suspicious_types(spark, sf):
    """A40 on numeric-looking text (cast quantity) and text dates."""
    t = li(spark, sf).select(
        F.col("l_quantity").cast("int").cast("string").alias("qty_text"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("ship_text"), "l_returnflag", "l_linestatus")
    return P.suspicious_types(t, ["qty_text", "ship_text", "l_returnflag", "l_linestatus"])


def _text_sql(tbl, cols):
    parts = []
    for c in cols:
        words = f"CASE WHEN {c} IS NOT NULL THEN len(regexp_split_to_array(trim({c}), '\\s+'))::DOUBLE END"
        parts.append(f"SELECT '{c}' AS feature, avg(length({c})::DOUBLE) AS avg_len, avg({words}) AS avg_words, "
                     f"max(length({c}))::BIGINT AS max_len, 100.0 * count(DISTINCT {c})::DOUBLE / count({c}) AS unique_pct, "
                     f"CAST(avg(length({c})::DOUBLE) > 50 OR avg({words}) > 5 AS INTEGER) AS is_text FROM {tbl}")
    return union_all(parts)


@register("text_columns", _text_sql("documents", ["text", "lang", "source"]),
          dbl=["avg_len", "avg_words", "unique_pct"])
def text_columns(spark, sf):
    return P.text_columns(table(spark, sf, "documents"), ["text", "lang", "source"])


@register("business_rules",
          "SELECT rule, n_violations, 100.0 * n_violations::DOUBLE / n AS pct FROM ("
          "SELECT 'c_acctbal: negative' AS rule, count(*) FILTER (WHERE c_acctbal < 0)::BIGINT AS n_violations, "
          "count(*) AS n FROM customer) x", dbl=["pct"])
def business_rules(spark, sf):
    t = table(spark, sf, "customer")
    return P.business_rules(t, P.default_rules(t))


@register("business_rules_dates",
          "SELECT 'start_date: after end_date' AS rule, n_violations, 100.0 * n_violations::DOUBLE / n AS pct FROM ("
          "SELECT count(*) FILTER (WHERE event_id % 7 < 3)::BIGINT AS n_violations, count(*) AS n FROM events) x", dbl=["pct"])
def business_rules_dates(spark, sf):
    """Start dates after their end dates (a date against text that reads as one)."""
    t = table(spark, sf, "events").select(F.to_date("ts").alias("start_date"), F.date_add(F.to_date("ts"), F.when(
        F.col("event_id") % 7 < 3, -1).otherwise(2)).cast("string").alias("end_date"))
    return P.business_rules(t, P.default_rules(t))


def _benford_sql(tbl, cols):
    import math
    parts = []
    for c in cols:
        dig = f"regexp_extract(CAST(abs({c}::DOUBLE) AS VARCHAR), '([1-9])', 1)"
        ok = f"{c} IS NOT NULL AND {c} <> 0"
        cnt = {d: f"count(*) FILTER (WHERE {ok} AND {dig} = '{d}')" for d in range(1, 10)}
        n = "(" + " + ".join(cnt.values()) + ")"
        chi = " + ".join(f"power({cnt[d]} - {n} * {math.log10(1 + 1 / d)!r}, 2) / ({n} * {math.log10(1 + 1 / d)!r})"
                         for d in range(1, 10))
        mad = " + ".join(f"abs({cnt[d]}::DOUBLE / {n} - {math.log10(1 + 1 / d)!r})" for d in range(1, 10))
        parts.append(f"SELECT '{c}' AS feature, {n}::BIGINT AS n, {chi} AS chi2, ({mad}) / 9.0 AS mad, "
                     f"{cnt[1]}::DOUBLE / {n} AS share_1 FROM {tbl}")
    return "SELECT * FROM (" + union_all(parts) + ") z WHERE n >= 100"


@register("benford", _benford_sql("lineitem", ["l_extendedprice", "l_quantity", "l_orderkey"]),
          dbl=["chi2", "mad", "share_1"])
def benford(spark, sf):
    return P.benford(li(spark, sf), ["l_extendedprice", "l_quantity", "l_orderkey"])


# ------------------------------------------------------------ train vs test
CC_COLS = ["l_returnflag", "l_linestatus", "l_linenumber", "l_partkey"]


@register("category_compact",
          f"SELECT a.feature, a.n_unique, 100.0 * a.top_share AS top_pct, a.n_rare, coalesce(u.n_unseen, 0)::BIGINT AS n_unseen "
          f"FROM (SELECT feature, count(*)::BIGINT AS n_unique, max(share) AS top_share, "
          f"count(*) FILTER (WHERE share < 0.01)::BIGINT AS n_rare FROM (SELECT feature, value, n::DOUBLE / sum(n) OVER "
          f"(PARTITION BY feature) AS share FROM ({vc_sql(LI_TRAIN_SQL, CC_COLS)}) v) w GROUP BY feature) a "
          f"LEFT JOIN (SELECT feature, count(*) AS n_unseen FROM (SELECT feature, value FROM ({vc_sql(LI_TEST_SQL, CC_COLS)}) t "
          f"EXCEPT SELECT feature, value FROM ({vc_sql(LI_TRAIN_SQL, CC_COLS)}) r) e GROUP BY feature) u "
          f"ON a.feature = u.feature", dbl=["top_pct"])
def category_compact(spark, sf):
    return P.category_compact(li_train(spark, sf), li_test(spark, sf), CC_COLS)


def _audit_side(src, tag):
    vc = vc_sql(src, CC_COLS, dropna=False)
    return (f"SELECT feature, count(*) FILTER (WHERE value IS NOT NULL)::BIGINT AS n_unique_{tag}, "
            f"100.0 * coalesce(sum(n) FILTER (WHERE value IS NULL), 0)::DOUBLE / sum(n) AS null_pct_{tag}, "
            f"100.0 * max(n) FILTER (WHERE value IS NOT NULL)::DOUBLE / sum(n) AS top_pct_{tag} FROM ({vc}) v GROUP BY feature")


@register("column_audit",
          f"SELECT coalesce(a.feature, b.feature) AS feature, n_unique_train, null_pct_train, top_pct_train, "
          f"n_unique_test, null_pct_test, top_pct_test, abs(null_pct_train - null_pct_test) AS null_gap FROM "
          f"({_audit_side(LI_TRAIN_SQL, 'train')}) a FULL OUTER JOIN ({_audit_side(LI_TEST_SQL, 'test')}) b "
          f"ON a.feature = b.feature",
          dbl=["null_pct_train", "top_pct_train", "null_pct_test", "top_pct_test", "null_gap"])
def column_audit(spark, sf):
    return P.column_audit(li_train(spark, sf), li_test(spark, sf), CC_COLS)


@register("numeric_compare",
          "SELECT a.feature, a.m AS mean_train, b.m AS mean_test, a.s AS std_train, b.s AS std_test, "
          "abs(a.m - b.m) AS mean_diff, CAST(abs(a.m - b.m) > a.s AS INTEGER) AS shifted FROM ("
          + union_all([f"SELECT '{c}' AS feature, avg({c}) AS m, stddev_samp({c}) AS s FROM {LI_TRAIN_SQL} t" for c in LI_NUM])
          + ") a JOIN (" + union_all([f"SELECT '{c}' AS feature, avg({c}) AS m, stddev_samp({c}) AS s FROM "
                                      f"(SELECT * REPLACE (l_extendedprice * 1.1 AS l_extendedprice) FROM {LI_TEST_SQL} q) t"
                                      for c in LI_NUM]) + ") b ON a.feature = b.feature",
          dbl=["mean_train", "mean_test", "std_train", "std_test", "mean_diff"])
def numeric_compare(spark, sf):
    from tabscope.registry.base import li_test_drift
    return P.numeric_compare(li_train(spark, sf), li_test_drift(spark, sf), LI_NUM)


@register("category_compare",
          f"SELECT coalesce(a.feature, b.feature) AS feature, a.n_unique AS n_unique_train, b.n_unique AS n_unique_test, "
          f"a.top AS top_train, b.top AS top_test, coalesce(o.k, 0)::BIGINT AS n_not_in_test FROM "
          f"({top_sql(vc_sql(LI_TRAIN_SQL, CC_COLS))}) a FULL OUTER JOIN ({top_sql(vc_sql(LI_TEST_SQL, CC_COLS))}) b "
          f"ON a.feature = b.feature LEFT JOIN (SELECT feature, count(*) AS k FROM (SELECT feature, value FROM "
          f"({vc_sql(LI_TRAIN_SQL, CC_COLS)}) r EXCEPT SELECT feature, value FROM ({vc_sql(LI_TEST_SQL, CC_COLS)}) t) e "
          f"GROUP BY feature) o ON coalesce(a.feature, b.feature) = o.feature")
def category_compare(spark, sf):
    return P.category_compare(li_train(spark, sf), li_test(spark, sf), CC_COLS)


# ------------------------------------------------------------ outliers
def _fence(c, src):
    q1, q3 = f"quantile_cont({c}, 0.25)", f"quantile_cont({c}, 0.75)"
    return f"(SELECT {q1} - 1.5 * ({q3} - {q1}) AS lo, {q3} + 1.5 * ({q3} - {q1}) AS hi FROM {src} f)"


def _iqr_sql(src, feats):
    parts = [f"SELECT '{c}' AS feature, b.lo AS lower, b.hi AS upper, count(*) FILTER (WHERE {c} < b.lo OR {c} > b.hi)::BIGINT "
             f"AS n_out, 100.0 * count(*) FILTER (WHERE {c} < b.lo OR {c} > b.hi)::DOUBLE / count({c}) AS pct_out FROM {src} t, "
             f"{_fence(c, src)} b GROUP BY b.lo, b.hi" for c in feats]
    return (f"SELECT *, CASE WHEN pct_out > 10 THEN 'high' WHEN pct_out > 5 THEN 'medium' WHEN pct_out > 0 THEN 'low' "
            f"ELSE 'none' END AS severity FROM ({union_all(parts)}) z")


_OUT_FEATS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@register("outliers_iqr", _iqr_sql("events", ["value", "user_id"]), dbl=["lower", "upper", "pct_out"])
def outliers_iqr(spark, sf):
    """A34 on the skewed events value."""
    return P.outliers_iqr(table(spark, sf, "events"), ["value", "user_id"])


@register("outliers_z", union_all([
    f"SELECT '{c}' AS feature, count(*) FILTER (WHERE abs(({c} - m.a) / m.s) > 3)::BIGINT AS n_z, count(*) FILTER "
    f"(WHERE {c} < b.lo OR {c} > b.hi)::BIGINT AS n_iqr, 100.0 * count(*) FILTER (WHERE abs(({c} - m.a) / m.s) > 3)::DOUBLE "
    f"/ count({c}) AS pct_z, 100.0 * (count(*) FILTER (WHERE abs(({c} - m.a) / m.s) > 3) + count(*) FILTER (WHERE {c} < b.lo "
    f"OR {c} > b.hi))::DOUBLE / 2.0 / count({c}) AS pct_mixed FROM events, {_fence(c, 'events')} b, (SELECT avg({c}) AS a, "
    f"stddev_pop({c}) AS s FROM events) m" for c in ["value", "user_id"]]), dbl=["pct_z", "pct_mixed"])
def outliers_z(spark, sf):
    return P.outliers_z(table(spark, sf, "events"), ["value", "user_id"])


_EV_TRAIN = "(SELECT * FROM events WHERE event_id % 5 <> 0)"
_EV_TEST = "(SELECT * FROM events WHERE event_id % 5 = 0)"


@register("outliers_compare",
          f"SELECT a.feature, a.pct_out AS pct_train, b.pct_out AS pct_test, abs(a.pct_out - b.pct_out) AS gap, "
          f"CAST(abs(a.pct_out - b.pct_out) > 5.0 AS INTEGER) AS flag FROM ({_iqr_sql(_EV_TRAIN, ['value', 'user_id'])}) a "
          f"JOIN ({_iqr_sql(_EV_TEST, ['value', 'user_id'])}) b ON a.feature = b.feature", dbl=["pct_train", "pct_test", "gap"])
def outliers_compare(spark, sf):
    e = table(spark, sf, "events")
    tr, te = e.where(F.pmod("event_id", F.lit(5)) != 0), e.where(F.pmod("event_id", F.lit(5)) == 0)
    return P.outliers_compare(tr, te, ["value", "user_id"])


@register("outliers_by_class", union_all([
    f"SELECT CAST(l_returnflag AS VARCHAR) AS class, '{c}' AS feature, count({c})::BIGINT AS n, count(*) FILTER (WHERE {c} < q.lo "
    f"OR {c} > q.hi)::BIGINT AS n_out, 100.0 * count(*) FILTER (WHERE {c} < q.lo OR {c} > q.hi)::DOUBLE / count({c}) AS pct_out "
    f"FROM lineitem, (SELECT quantile_cont({c}, 0.01) AS lo, quantile_cont({c}, 0.99) AS hi FROM lineitem) q GROUP BY 1"
    for c in _OUT_FEATS]), dbl=["pct_out"])
def outliers_by_class(spark, sf):
    return P.outliers_by_class(li(spark, sf), _OUT_FEATS, "l_returnflag")
