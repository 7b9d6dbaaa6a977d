"""Feature engineering, chart data, window and time-series queries."""

from __future__ import annotations

import itertools

from pyspark.sql import functions as F

from tabscope.operators import association as A
from tabscope.operators import features as FE
from tabscope.operators import series as S
from tabscope.registry.base import (LI_NULLS_SQL, LI_NUM, LI_TEST_SQL, LI_TRAIN_SQL, Y_BIN_SQL, li, li_nulls, li_test,
                                    li_train, register, table, union_all, y_binary)

KEYS = ["l_orderkey", "l_linenumber"]


@register("fe_arithmetic",
          "SELECT l_orderkey, l_linenumber, l_extendedprice / (l_quantity + 1e-6) AS l_extendedprice_div_l_quantity, "
          "l_extendedprice - l_quantity AS l_extendedprice_minus_l_quantity, l_extendedprice + l_quantity AS "
          "l_extendedprice_plus_l_quantity, l_extendedprice * l_quantity AS l_extendedprice_times_l_quantity, "
          "l_discount / (l_tax + 1e-6) AS l_discount_div_l_tax, l_discount - l_tax AS l_discount_minus_l_tax, "
          "l_discount + l_tax AS l_discount_plus_l_tax, l_discount * l_tax AS l_discount_times_l_tax FROM lineitem",
          dbl=[f"{a}_{op}_{b}" for a, b in [("l_extendedprice", "l_quantity"), ("l_discount", "l_tax")]
               for op in ("div", "minus", "plus", "times")], digits=10)
def fe_arithmetic(spark, sf):
    t = li(spark, sf).select(*KEYS, "l_extendedprice", "l_quantity", "l_discount", "l_tax")
    return FE.fe_arithmetic(t, [("l_extendedprice", "l_quantity"), ("l_discount", "l_tax")]).drop(
        "l_extendedprice", "l_quantity", "l_discount", "l_tax")


_RS = ["l_quantity", "l_discount", "l_tax"]
_RS_N = " + ".join(f"CAST({c} IS NOT NULL AS INTEGER)" for c in _RS)
_RS_M = f"(({' + '.join(f'coalesce({c}, 0.0)' for c in _RS)}) / ({_RS_N}))"


@register("fe_row_stats",
          f"SELECT l_orderkey, l_linenumber, {_RS_M} AS row_mean, sqrt(({' + '.join(f'coalesce(power({c} - {_RS_M}, 2), 0.0)' for c in _RS)}) "
          f"/ nullif(({_RS_N}) - 1, 0)) AS row_std, least({', '.join(_RS)}) AS row_min, greatest({', '.join(_RS)}) AS row_max, "
          f"greatest({', '.join(_RS)}) - least({', '.join(_RS)}) AS row_range FROM {LI_NULLS_SQL} t",
          dbl=["row_mean", "row_std", "row_min", "row_max", "row_range"])
def fe_row_stats(spark, sf):
    t = li_nulls(spark, sf).select(*KEYS, *_RS)
    return FE.fe_row_stats(t, _RS).drop(*_RS)


@register("fe_cross",
          "SELECT l_orderkey, l_linenumber, concat_ws('_', l_returnflag, l_linestatus) AS l_returnflag_x_l_linestatus, "
          "concat_ws('_', l_linestatus, CAST(l_linenumber AS VARCHAR)) AS l_linestatus_x_l_linenumber FROM lineitem")
def fe_cross(spark, sf):
    t = li(spark, sf).select(*KEYS, "l_returnflag", "l_linestatus")
    return FE.fe_cross(t, [("l_returnflag", "l_linestatus"), ("l_linestatus", "l_linenumber")]).drop(
        "l_returnflag", "l_linestatus")


@register("fe_flag_interaction",
          "SELECT l_orderkey, l_linenumber, CAST(l_returnflag = 'R' AS INTEGER) * l_quantity AS l_returnflag_x_l_quantity, "
          "CAST(l_returnflag = 'R' AS INTEGER) * l_extendedprice AS l_returnflag_x_l_extendedprice FROM lineitem",
          dbl=["l_returnflag_x_l_quantity", "l_returnflag_x_l_extendedprice"])
def fe_flag_interaction(spark, sf):
    t = li(spark, sf).select(*KEYS, "l_returnflag", "l_quantity", "l_extendedprice")
    return FE.fe_flag_interaction(t, "l_returnflag", "R", ["l_quantity", "l_extendedprice"]).drop(
        "l_returnflag", "l_quantity", "l_extendedprice")


_DFS = ["p_size", "p_retailprice"]


def _pct_sql(c):
    return (f"(rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0) / count({c}) OVER ()")


def _dfs_sql(prune=False):
    a, b = _DFS
    x, y = f"{a}::DOUBLE", f"{b}::DOUBLE"
    cols = ["p_partkey", "p_size", "p_retailprice"]
    if not prune:
        cols += [f'abs({x}) AS "ABSOLUTE({a})"', f'-({x}) AS "-({a})"', f'abs({y}) AS "ABSOLUTE({b})"', f'-({y}) AS "-({b})"']
    cols += [f'{x} + {y} AS "{a} + {b}"', f'{x} - {y} AS "{a} - {b}"', f'{x} * {y} AS "{a} * {b}"',
             f'CASE WHEN {y} <> 0 THEN {x} / {y} END AS "{a} / {b}"',
             f'CASE WHEN {y} <> 0 THEN (({x} % {y}) + {y}) % {y} END AS "{a} % {b}"',
             f'{x} = {y} AS "{a} = {b}"', f'{x} <> {y} AS "{a} != {b}"', f'{x} > {y} AS "{a} > {b}"',
             f'{x} < {y} AS "{a} < {b}"']
    if not prune:
        cols += [f'{_pct_sql(a)} AS "PERCENTILE({a})"', f'{_pct_sql(b)} AS "PERCENTILE({b})"']
    return "SELECT " + ", ".join(cols) + " FROM part"


_DFS_DBL = [f"ABSOLUTE({a})" for a in _DFS] + [f"-({a})" for a in _DFS] + \
    [f"{_DFS[0]} {op} {_DFS[1]}" for op in "+-*/%"] + [f"PERCENTILE({a})" for a in _DFS]


def _q(names):
    return [f'"{n}"' for n in names]


@register("dfs_transform", _dfs_sql(), dbl=_q(_DFS_DBL))
def dfs_transform(spark, sf):
    """FE5: depth-1 synthesis over part numerics with generator-style names."""
    t = table(spark, sf, "part").select("p_partkey", *_DFS)
    return FE.dfs_transform(t, _DFS)


@register("prune_columns_regex", _dfs_sql(prune=True), dbl=_q([f"{_DFS[0]} {op} {_DFS[1]}" for op in "+-*/%"]))
def prune_columns_regex(spark, sf):
    """Drop ABSOLUTE( / PERCENTILE( / -( columns after synthesis."""
    t = table(spark, sf, "part").select("p_partkey", *_DFS)
    return FE.prune_columns_regex(FE.dfs_transform(t, _DFS))


@register("label_encode",
          "SELECT feature, value, (dense_rank() OVER (PARTITION BY feature ORDER BY value) - 1)::INTEGER AS code FROM ("
          + union_all([f"SELECT DISTINCT '{c}' AS feature, CAST({c} AS VARCHAR) AS value FROM lineitem WHERE {c} IS NOT NULL"
                       for c in ["l_returnflag", "l_linestatus", "l_linenumber"]]) + ") d")
def label_encode(spark, sf):
    """FE6: sorted codes fitted on train and test together."""
    return FE.label_encode([li_train(spark, sf), li_test(spark, sf)], ["l_returnflag", "l_linestatus", "l_linenumber"])


@register("one_hot",
          "SELECT l_orderkey, l_linenumber, CAST(l_returnflag = 'A' AS INTEGER) AS l_returnflag_A, "
          "CAST(l_returnflag = 'N' AS INTEGER) AS l_returnflag_N, CAST(l_returnflag = 'R' AS INTEGER) AS l_returnflag_R "
          "FROM lineitem")
def one_hot(spark, sf):
    """FE7: indicator columns for the known levels (levels from the code table)."""
    t = li(spark, sf).select(*KEYS, "l_returnflag")
    return FE.one_hot(t, "l_returnflag", ["A", "N", "R"]).drop("l_returnflag")


_TE = (f"SELECT CAST(l_linenumber AS INTEGER) AS level, count(*)::BIGINT AS n, avg({Y_BIN_SQL}::DOUBLE) AS mean "
       f"FROM lineitem GROUP BY 1")


@register("target_encode",
          f"SELECT level, n, mean, prior, (1.0 / (1.0 + exp(-(n - 1) / 0.1))) * mean + (1 - 1.0 / (1.0 + exp(-(n - 1) / 0.1))) "
          f"* prior AS encoded FROM (SELECT *, (SELECT avg({Y_BIN_SQL}::DOUBLE) FROM lineitem) AS prior FROM ({_TE}) t) u",
          dbl=["mean", "prior", "encoded"])
def target_encode(spark, sf):
    return FE.target_encode_table(li(spark, sf), "l_linenumber", y_binary())


@register("target_encode_oof",
          "WITH lf AS (SELECT CAST(l_linenumber AS INTEGER) AS level, CAST(l_orderkey % 5 AS INTEGER) AS fold, count(*) AS nf, "
          f"sum({Y_BIN_SQL}::DOUBLE) AS sf FROM lineitem GROUP BY 1, 2), t AS (SELECT level, fold, "
          "sum(nf) OVER (PARTITION BY level) - nf AS n, sum(sf) OVER (PARTITION BY level) - sf AS s, "
          "(sum(sf) OVER () - sum(sf) OVER (PARTITION BY fold)) / (sum(nf) OVER () - sum(nf) OVER (PARTITION BY fold)) AS prior "
          "FROM lf) SELECT level, fold, n::BIGINT AS n, CASE WHEN n > 0 THEN (1.0 / (1.0 + exp(-(n - 1) / 0.1))) * (s / n) + "
          "(1 - 1.0 / (1.0 + exp(-(n - 1) / 0.1))) * prior ELSE prior END AS encoded FROM t", dbl=["encoded"])
def target_encode_oof(spark, sf):
    """FE8 out-of-fold with fold = orderkey mod 5."""
    t = li(spark, sf).withColumn("fold", F.pmod("l_orderkey", F.lit(5)).cast("int"))
    return FE.target_encode_oof(t, "l_linenumber", y_binary(), "fold")


@register("fe_transforms",
          "SELECT l_orderkey, l_linenumber, " + ", ".join(
              f"ln(1 + {c}) AS {c}_log1p, sqrt({c}) AS {c}_sqrt, {c} * {c} AS {c}_sq" for c in ["l_quantity", "l_extendedprice"])
          + " FROM lineitem", dbl=[f"{c}_{s}" for c in ["l_quantity", "l_extendedprice"] for s in ("log1p", "sqrt", "sq")])
def fe_transforms(spark, sf):
    t = li(spark, sf).select(*KEYS, "l_quantity", "l_extendedprice")
    return FE.fe_transforms(t, ["l_quantity", "l_extendedprice"]).drop("l_quantity", "l_extendedprice")


def _boxcox_sql():
    grid = [round(-2 + 0.1 * i, 1) for i in range(41)]
    parts = []
    for c in ["l_quantity", "l_extendedprice", "l_tax"]:
        y = f"({c}::DOUBLE + 1.0)"
        rows = []
        for lam in grid:
            bc = f"ln({y})" if lam == 0 else f"(power({y}, {lam}) - 1.0) / {lam}"
            rows.append(f"SELECT {lam} AS lam, ({lam} - 1) * sum(ln({y})) - count({y}) / 2.0 * ln(var_pop({bc})) AS ll FROM lineitem")
        parts.append(f"SELECT '{c}' AS feature, arg_max(lam, ll)::DOUBLE AS best_lambda, max(ll) AS loglik FROM ({union_all(rows)}) g")
    return union_all(parts)


@register("boxcox", _boxcox_sql(), dbl=["best_lambda", "loglik"])
def boxcox(spark, sf):
    """FE10: Box-Cox lambda by grid log-likelihood (one aggregate)."""
    return FE.boxcox_lambda(li(spark, sf), ["l_quantity", "l_extendedprice", "l_tax"])


def _qcut_sql(cols, q):
    qs = ", ".join(str(i / q) for i in range(q + 1))
    eds = ", ".join(f"(SELECT list_sort(list_distinct(quantile_cont({c}::DOUBLE, [{qs}]))) FROM lineitem) AS e_{c}" for c in cols)
    bins = ", ".join(f"greatest(len(list_filter(e_{c}, lambda e: e < {c}::DOUBLE)) - 1, 0)::INTEGER AS {c}_qbin" for c in cols)
    return f"SELECT l_orderkey, l_linenumber, {bins} FROM (SELECT *, {eds} FROM lineitem) x"


@register("qcut_bins", _qcut_sql(["l_quantity", "l_extendedprice"], 5))
def qcut_bins(spark, sf):
    t = li(spark, sf).select(*KEYS, "l_quantity", "l_extendedprice")
    return FE.qcut_bins(t, ["l_quantity", "l_extendedprice"], 5).drop("l_quantity", "l_extendedprice")


def _ew_sql(src, cols, bins, keys="l_orderkey, l_linenumber"):
    mm = ", ".join(f"min({c}::DOUBLE) AS lo_{c}, max({c}::DOUBLE) AS hi_{c}" for c in cols)
    b = ", ".join(f"CAST(CASE WHEN floor(({c}::DOUBLE - lo_{c}) * ({float(bins)} / (hi_{c} - lo_{c}))) >= {bins} THEN {bins - 1} "
                  f"ELSE floor(({c}::DOUBLE - lo_{c}) * ({float(bins)} / (hi_{c} - lo_{c}))) END AS INTEGER) AS {c}_bin" for c in cols)
    return f"SELECT {keys}, {b} FROM {src} s, (SELECT {mm} FROM {src} m) mm"


@register("equal_width_bins", _ew_sql("lineitem", ["l_quantity", "l_extendedprice"], 10))
def equal_width_bins(spark, sf):
    t = li(spark, sf).select(*KEYS, "l_quantity", "l_extendedprice")
    return FE.equal_width_bins(t, ["l_quantity", "l_extendedprice"], 10).drop("l_quantity", "l_extendedprice")


@register("date_parts",
          "SELECT o_orderkey, year(o_orderdate)::INTEGER AS o_orderdate_year, month(o_orderdate)::INTEGER AS o_orderdate_month, "
          "day(o_orderdate)::INTEGER AS o_orderdate_day, (isodow(o_orderdate) - 1)::INTEGER AS o_orderdate_dow, "
          "CAST(isodow(o_orderdate) >= 6 AS INTEGER) AS o_orderdate_is_weekend, hour(o_orderdate)::INTEGER AS o_orderdate_hour "
          "FROM orders")
def date_parts(spark, sf):
    t = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return FE.date_parts(t, "o_orderdate").drop("o_orderdate")


def _scale_sql(kind):
    cols = ["l_quantity", "l_extendedprice"]
    if kind == "standard":
        st = ", ".join(f"avg({c}) AS a_{c}, stddev_pop({c}) AS b_{c}" for c in cols)
    else:
        st = ", ".join(f"min({c}) AS a_{c}, max({c}) - min({c}) AS b_{c}" for c in cols)
    sc = ", ".join(f"({c} - a_{c}) / b_{c} AS {c}" for c in cols)
    return f"SELECT l_orderkey, l_linenumber, {sc} FROM {LI_TEST_SQL} t, (SELECT {st} FROM {LI_TRAIN_SQL} r) s"


@register("scale_standard", _scale_sql("standard"), dbl=["l_quantity", "l_extendedprice"])
def scale_standard(spark, sf):
    """FE15: fitted on train, applied to test."""
    cols = ["l_quantity", "l_extendedprice"]
    return FE.scale(li_train(spark, sf), li_test(spark, sf).select(*KEYS, *cols), cols, "standard")


@register("scale_minmax", _scale_sql("minmax"), dbl=["l_quantity", "l_extendedprice"])
def scale_minmax(spark, sf):
    cols = ["l_quantity", "l_extendedprice"]
    return FE.scale(li_train(spark, sf), li_test(spark, sf).select(*KEYS, *cols), cols, "minmax")


@register("class_weights",
          "SELECT class, n, sum(n) OVER () / (count(*) OVER () * n) AS weight FROM (SELECT CAST(o_orderpriority AS VARCHAR) "
          "AS class, count(*)::BIGINT AS n FROM orders GROUP BY 1) g", dbl=["weight"])
def class_weights(spark, sf):
    return FE.class_weights(table(spark, sf, "orders"), "o_orderpriority")


@register("fe_domain",
          "SELECT l_orderkey, l_linenumber, CAST(l_quantity > 25 AS INTEGER) AS big_qty, (l_quantity * l_tax) / (l_discount + 1) "
          "AS qty_tax_ratio, l_extendedprice * (1 - l_discount) - l_extendedprice AS discount_residual FROM lineitem",
          dbl=["qty_tax_ratio", "discount_residual"])
def fe_domain(spark, sf):
    """FE18/FE20: threshold flag, (a*b)/(c+1) formula and a residual feature."""
    t = li(spark, sf)
    out = FE.fe_domain(t, {"big_qty": (F.col("l_quantity") > 25).cast("int"),
                           "qty_tax_ratio": (F.col("l_quantity") * F.col("l_tax")) / (F.col("l_discount") + 1),
                           "discount_residual": F.col("l_extendedprice") * (1 - F.col("l_discount")) - F.col("l_extendedprice")})
    return out.select(*KEYS, "big_qty", "qty_tax_ratio", "discount_residual")


@register("sentinel_to_null",
          "SELECT o_orderkey, CASE WHEN regexp_matches(s, '^No .+') THEN NULL ELSE s END AS sentinel FROM (SELECT o_orderkey, "
          "CASE WHEN o_orderstatus = 'F' THEN 'No open' WHEN o_totalprice > 100000 THEN 'Yes' ELSE 'No' END AS s FROM orders) x")
def sentinel_to_null(spark, sf):
    from tabscope.registry.q_stats import ord_sent
    return FE.sentinel_to_null(ord_sent(spark, sf).select("o_orderkey", "sentinel"), ["sentinel"])


@register("string_predicates",
          "SELECT c_custkey, c_name, CAST(regexp_matches(c_name, '^\\d{1,}$') AS INTEGER) AS is_int_text, "
          "CAST(regexp_matches(c_name, '^\\d+\\.?\\d*$') AS INTEGER) AS is_num_text, CAST(regexp_matches(c_name, "
          "'\\d{4}-\\d{2}-\\d{2}') AS INTEGER) AS has_date, CAST(contains(c_name, '@') AS INTEGER) AS has_at, lower(c_name) AS lower, "
          "length(c_name)::INTEGER AS length, len(string_split(c_name, ' '))::INTEGER AS n_tokens, "
          "ltrim(regexp_replace(c_name, '^[0.]+', '')) AS lstrip_0 FROM (SELECT c_custkey, CAST(c_custkey AS VARCHAR) || "
          "CASE WHEN c_custkey % 3 = 0 THEN '' ELSE ' ' || c_name END AS c_name FROM customer) c")
def string_predicates(spark, sf):
    """FE21 on a mixed text column (some pure digits, some names)."""
    c = table(spark, sf, "customer")
    t = c.select("c_custkey", F.concat(F.col("c_custkey").cast("string"),
                                       F.when(F.pmod("c_custkey", F.lit(3)) == 0, F.lit(""))
                                       .otherwise(F.concat(F.lit(" "), F.col("c_name")))).alias("c_name"))
    return FE.string_predicates(t, "c_name")


@register("feature_select", rows_only=True)
def feature_select(spark, sf):
    """FE16: selection chain on lineitem numerics plus a constant and a duplicated column."""
    t = li(spark, sf).withColumn("const1", F.lit(1.0)).withColumn("qty2", F.col("l_quantity") * 2)
    return FE.feature_select(t, [*LI_NUM, "const1", "qty2"], F.col("l_returnflag"))


# ------------------------------------------------------------ chart data
def _hist_sql():
    parts = []
    for c in LI_NUM:
        lo, hi = f"(SELECT min({c}) FROM lineitem)", f"(SELECT max({c}) FROM lineitem)"
        b = f"CASE WHEN floor(({c} - {lo}) * (40.0 / ({hi} - {lo}))) >= 40 THEN 39 ELSE floor(({c} - {lo}) * (40.0 / ({hi} - {lo}))) END"
        parts.append(f"SELECT CAST(l_returnflag AS VARCHAR) AS class, '{c}' AS feature, CAST({b} AS INTEGER) AS bin, "
                     f"{lo} + CAST({b} AS INTEGER) * (({hi} - {lo}) / 40) AS bin_lo, {lo} + (CAST({b} AS INTEGER) + 1) * "
                     f"(({hi} - {lo}) / 40) AS bin_hi, count(*)::BIGINT AS n FROM lineitem GROUP BY 1, 3")
    return union_all(parts)


@register("histogram", _hist_sql(), dbl=["bin_lo", "bin_hi"], digits=10)
def histogram(spark, sf):
    return S.histogram(li(spark, sf), LI_NUM, "l_returnflag", 40)


def _box_sql():
    parts = []
    for c in LI_NUM:
        q = (f"SELECT l_returnflag AS k, quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.5) AS med, "
             f"quantile_cont({c}, 0.75) AS q3 FROM lineitem GROUP BY 1")
        lo, hi = "q.q1 - 1.5 * (q.q3 - q.q1)", "q.q3 + 1.5 * (q.q3 - q.q1)"
        parts.append(f"SELECT q.k AS class, '{c}' AS feature, q.q1, q.med AS median, q.q3, min({c}) FILTER (WHERE {c} >= {lo} "
                     f"AND {c} <= {hi}) AS whisker_lo, max({c}) FILTER (WHERE {c} >= {lo} AND {c} <= {hi}) AS whisker_hi, "
                     f"count(*) FILTER (WHERE NOT ({c} >= {lo} AND {c} <= {hi}))::BIGINT AS n_fliers FROM lineitem l "
                     f"JOIN ({q}) q ON l.l_returnflag = q.k GROUP BY q.k, q.q1, q.med, q.q3")
    return union_all(parts)


@register("box_stats", _box_sql(), dbl=["q1", "median", "q3", "whisker_lo", "whisker_hi"])
def box_stats(spark, sf):
    return S.box_stats(li(spark, sf), LI_NUM, "l_returnflag")


@register("ecdf", union_all([
    f"SELECT '{c}' AS feature, v AS value, n, sum(n) OVER (ORDER BY v ROWS UNBOUNDED PRECEDING)::DOUBLE / sum(n) OVER () AS ecdf "
    f"FROM (SELECT {c}::DOUBLE AS v, count(*)::BIGINT AS n FROM lineitem GROUP BY 1) g" for c in ["l_quantity", "l_discount", "l_tax"]]),
    dbl=["value", "ecdf"])
def ecdf(spark, sf):
    return S.ecdf(li(spark, sf), ["l_quantity", "l_discount", "l_tax"])


@register("qq_points", rows_only=True)
def qq_points(spark, sf):
    return S.qq_points(li(spark, sf), "l_extendedprice")


@register("scatter_sample", rows_only=True)
def scatter_sample(spark, sf):
    return S.scatter_sample(li(spark, sf), ["l_quantity", "l_extendedprice", "l_returnflag"], KEYS, 1500)


@register("null_matrix_sample", rows_only=True)
def null_matrix_sample(spark, sf):
    return S.null_matrix_sample(li_nulls(spark, sf), ["l_quantity", "l_discount", "l_tax"], KEYS, 500)


@register("density_overlay", rows_only=True)
def density_overlay(spark, sf):
    from tabscope.registry.base import li_test_drift
    return S.density_overlay(li_train(spark, sf), li_test_drift(spark, sf), "l_extendedprice")


# ------------------------------------------------------------ windows
@register("feature_rank",
          "SELECT feature, f_stat, row_number() OVER (ORDER BY f_stat DESC, feature)::BIGINT AS rank FROM (" + union_all([
              f"SELECT '{c}' AS feature, (sum(n * power(m - gm, 2)) / (count(*) - 1)) / (sum((n - 1) * coalesce(v, 0)) / "
              f"(sum(n) - count(*))) AS f_stat FROM (SELECT n, m, v, sum(n * m) OVER () / sum(n) OVER () AS gm FROM "
              f"(SELECT count({c}) AS n, avg({c}) AS m, var_samp({c}) AS v FROM lineitem GROUP BY l_returnflag) g) h"
              for c in LI_NUM]) + ") x", dbl=["f_stat"])
def feature_rank(spark, sf):
    """Features ranked by ANOVA F."""
    return S.feature_rank(A.anova_f(li(spark, sf), LI_NUM, "l_returnflag").select("feature", "f_stat"), "f_stat")


def _cumulative_sql():
    from tabscope.registry.q_stats import _YS_SRC, mi_sql
    mi = mi_sql(_YS_SRC, ["l_quantity", "l_extendedprice", "l_discount", "l_tax"], ["l_linestatus", "l_linenumber"], "y")
    return (f"WITH m AS (SELECT feature, mi FROM ({mi}) q), c AS (SELECT feature, mi, mi / sum(mi) OVER () AS importance_share, "
            "sum(mi) OVER (ORDER BY mi DESC, feature ROWS UNBOUNDED PRECEDING) / sum(mi) OVER () AS cumulative, "
            "row_number() OVER (ORDER BY mi DESC, feature)::BIGINT AS rank FROM m) "
            "SELECT *, CASE WHEN cumulative - importance_share < 0.8 THEN 1 ELSE 0 END AS in_top FROM c")


@register("cumulative_importance", _cumulative_sql(), dbl=["mi", "importance_share", "cumulative"])
def cumulative_importance(spark, sf):
    """Importance share / running total / top-80 % set over the binned-MI ranking."""
    mi = A.mi_binned(li(spark, sf), ["l_quantity", "l_extendedprice", "l_discount", "l_tax"],
                     ["l_linestatus", "l_linenumber"], F.col("l_returnflag"))
    return S.cumulative_importance(mi.select("feature", "mi"), "mi")


@register("percentile_rank",
          f"SELECT l_orderkey, l_linenumber, l_extendedprice, {_pct_sql('l_extendedprice')} AS l_extendedprice_pct_rank FROM lineitem",
          dbl=["l_extendedprice", "l_extendedprice_pct_rank"])
def percentile_rank(spark, sf):
    return S.percentile_rank(li(spark, sf), "l_extendedprice", KEYS)


_SF_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]


@register("stratified_folds",
          "SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag, (row_number() OVER (PARTITION BY l_returnflag ORDER BY "
          + ", ".join(_SF_ORDER) + ") - 1) % 5 AS fold FROM lineitem")
def stratified_folds(spark, sf):
    """Exact stratified 5-fold assignment (position within class mod 5)."""
    t = li(spark, sf).select(*_SF_ORDER, "l_returnflag")
    out = S.stratified_folds(t, "l_returnflag", 5, order_cols=_SF_ORDER)
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag", "fold")


# ------------------------------------------------------------ time series
_DAILY_SQL = "(SELECT CAST(ts AS DATE) AS day, count(*)::DOUBLE AS y FROM events GROUP BY 1)"


@register("seasonal_decompose",
          f"WITH s AS (SELECT day, y, row_number() OVER (ORDER BY day) - 1 AS t FROM {_DAILY_SQL} d), "
          "m AS (SELECT *, CASE WHEN count(y) OVER (ORDER BY t ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING) = 7 THEN "
          "avg(y) OVER (ORDER BY t ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING) END AS trend, t % 7 AS phase FROM s), "
          "p AS (SELECT phase, avg(y - trend) AS pm FROM m GROUP BY 1), q AS (SELECT phase, pm - avg(pm) OVER () AS seasonal FROM p) "
          "SELECT strftime(day, '%Y-%m-%d') AS day, y, trend, seasonal, y - trend - seasonal AS resid FROM m JOIN q USING (phase)",
          dbl=["y", "trend", "seasonal", "resid"])
def seasonal_decompose(spark, sf):
    return S.seasonal_decompose(S.daily_series(table(spark, sf, "events"), "ts"), 7)


@register("acf",
          "WITH s AS (SELECT day, y - avg(y) OVER () AS c, row_number() OVER (ORDER BY day) AS t FROM (SELECT CAST(ts AS DATE) "
          "AS day, avg(value) AS y FROM events GROUP BY 1) d), lags AS (SELECT unnest(range(1, 41)) AS lag) "
          "SELECT lag::INTEGER AS lag, coalesce((SELECT sum(a.c * b.c) FROM s a JOIN s b ON b.t = a.t - lag), 0.0) / "
          "(SELECT sum(c * c) FROM s) AS acf FROM lags WHERE lag < (SELECT count(*) FROM s)", dbl=["acf"])
def acf(spark, sf):
    return S.acf(S.daily_series(table(spark, sf, "events"), "ts", "value", "avg"), 40)


@register("pacf", rows_only=True)
def pacf(spark, sf):
    """Partial autocorrelation of the daily means (Durbin-Levinson)."""
    return S.pacf(S.daily_series(table(spark, sf, "events"), "ts", "value", "avg"), 20)


@register("date_span",
          "SELECT 'ts' AS feature, strftime(min(ts), '%Y-%m-%d') AS first, strftime(max(ts), '%Y-%m-%d') AS last, "
          "datediff('day', min(ts), max(ts))::BIGINT AS span_days, CAST(datediff('day', min(ts), max(ts)) > 100 AS INTEGER) "
          "AS check_trend FROM events")
def date_span(spark, sf):
    return S.date_span(table(spark, sf, "events"), ["ts"])


@register("adf_stat", rows_only=True)
def adf_stat(spark, sf):
    """Augmented Dickey-Fuller test of the daily means (lags by AIC, MacKinnon p-value)."""
    return S.augmented_dickey_fuller(S.daily_series(table(spark, sf, "events"), "ts", "value", "avg"))
