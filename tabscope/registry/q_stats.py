"""Association, tests, drift and leakage queries."""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import functions as F

from tabscope.operators import association as A
from tabscope.registry.base import (LI_NULLS_SQL, LI_NUM, LI_TEST_DRIFT_SQL, LI_TEST_SQL, LI_TRAIN_SQL, Y_BIN_SQL,
                                    li, li_nulls, li_test, li_test_drift, li_train, register, table, union_all,
                                    y_binary)


def pairs(cols):
    return [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]


NETC = LI_NUM + ["net_price"]
NET_SQL = "(SELECT *, l_extendedprice * (1 - l_discount) AS net_price FROM lineitem)"


def li_net(spark, sf):
    return li(spark, sf).withColumn("net_price", F.col("l_extendedprice") * (1 - F.col("l_discount")))


@register("corr_pearson", union_all([
    f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, corr({a}, {b}) AS corr, abs(corr({a}, {b})) AS abs_corr "
    f"FROM {LI_NULLS_SQL} t" for a, b in pairs(LI_NUM)]), dbl=["corr", "abs_corr"])
def corr_pearson(spark, sf):
    """Pairwise-complete Pearson matrix (long form) on data with planted nulls."""
    return A.corr_pairs(li_nulls(spark, sf), LI_NUM)


@register("high_corr_pairs", "SELECT * FROM (" + union_all([
    f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, corr({a}, {b}) AS corr, abs(corr({a}, {b})) AS abs_corr "
    f"FROM {NET_SQL} t" for a, b in pairs(NETC)]) + ") z WHERE abs_corr > 0.7", dbl=["corr", "abs_corr"])
def high_corr_pairs(spark, sf):
    return A.high_corr_pairs(li_net(spark, sf), NETC, 0.7)


def _rank_sql(c):
    return f"(rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0)"


RANKED_SQL = ("(SELECT " + ", ".join(f"{c}, {_rank_sql(c)} AS {c}_rank" for c in LI_NUM) + " FROM lineitem)")


@register("corr_spearman", union_all([
    f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, corr({a}_rank, {b}_rank) AS spearman FROM {RANKED_SQL} r"
    for a, b in pairs(LI_NUM)]), dbl=["spearman"])
def corr_spearman(spark, sf):
    """Spearman on average ranks."""
    return A.corr_spearman(li(spark, sf), LI_NUM)


@register("corr_discrepancy", union_all([
    f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, corr({a}, {b}) AS pearson, corr({a}_rank, {b}_rank) AS spearman, "
    f"abs(corr({a}, {b}) - corr({a}_rank, {b}_rank)) AS gap, CAST(abs(corr({a}, {b}) - corr({a}_rank, {b}_rank)) > 0.2 "
    f"AS INTEGER) AS flag FROM {RANKED_SQL} r" for a, b in pairs(LI_NUM)]), dbl=["pearson", "spearman", "gap"])
def corr_discrepancy(spark, sf):
    return A.corr_discrepancy(li(spark, sf), LI_NUM)


TC_FEATS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber", "l_partkey"]


@register("target_corr",
          "SELECT * FROM (SELECT feature, corr, abs(corr) AS abs_corr, CASE WHEN abs(corr) > 0.7 THEN 'strong' WHEN "
          "abs(corr) > 0.5 THEN 'moderate' WHEN abs(corr) > 0.3 THEN 'weak' ELSE 'very weak' END AS strength, "
          "row_number() OVER (ORDER BY abs(corr) DESC, feature)::BIGINT AS rank FROM (" + union_all([
              f"SELECT '{c}' AS feature, corr({c}::DOUBLE, o_totalprice) AS corr FROM lineitem JOIN orders ON "
              f"l_orderkey = o_orderkey" for c in TC_FEATS]) + ") x) y WHERE rank <= 15", dbl=["corr", "abs_corr"])
def target_corr(spark, sf):
    """Correlation of lineitem features with the order total (regression target)."""
    j = li(spark, sf).join(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"),
                           F.col("l_orderkey") == F.col("o_orderkey"))
    return A.target_corr(j, TC_FEATS, F.col("o_totalprice"))


def _tcg_sql():
    feats = ["l_quantity", "l_discount", "l_tax"]
    med = ", ".join(f"quantile_cont({c}, 0.5) AS m_{c}" for c in feats)
    filled = ", ".join(f"coalesce({c}, m.m_{c}) AS {c}" for c in feats)
    src = f"(SELECT {filled}, {Y_BIN_SQL}::DOUBLE AS y FROM {LI_NULLS_SQL} t, (SELECT {med} FROM {LI_NULLS_SQL} s) m)"
    ranked = "(SELECT *, " + ", ".join(f"{_rank_sql(c)} AS {c}_rank" for c in feats + ["y"]) + f" FROM {src} f)"
    return union_all([f"SELECT '{c}' AS feature, corr({c}, y) AS pearson, corr({c}_rank, y_rank) AS spearman, "
                      f"abs(corr({c}, y) - corr({c}_rank, y_rank)) AS gap, CAST(abs(corr({c}, y) - corr({c}_rank, y_rank)) "
                      f"> 0.1 AS INTEGER) AS nonlinear FROM {ranked} r" for c in feats])


@register("target_corr_gap", _tcg_sql(), dbl=["pearson", "spearman", "gap"])
def target_corr_gap(spark, sf):
    t = li_nulls(spark, sf).withColumn("y", y_binary())
    return A.target_corr_gap(t, ["l_quantity", "l_discount", "l_tax"], "y")


def vif_sql(src, cols):
    """VIFs as ratios of determinants of the correlation matrix of complete rows, written out over permutations."""
    whole = " AND ".join(f"{c} IS NOT NULL" for c in cols)
    r = ", ".join(f"corr({a}, {b}) AS r_{a}_{b}" for a, b in pairs(cols))
    name = {(a, b): f"r_{a}_{b}" for a, b in pairs(cols)} | {(b, a): f"r_{a}_{b}" for a, b in pairs(cols)}

    def det(of):
        terms = []
        for p in permutations(range(len(of))):
            odd = sum(p[i] > p[j] for i in range(len(p)) for j in range(i + 1, len(p))) % 2
            terms.append(" * ".join(["(-1.0)" if odd else "1.0"] + [name[of[i], of[j]] for i, j in enumerate(p) if i != j]))
        return "(" + " + ".join(terms) + ")"
    vifs = union_all([f"SELECT '{c}' AS feature, {det([x for x in cols if x != c])} / {det(cols)} AS vif FROM r" for c in cols])
    return (f"WITH r AS (SELECT {r} FROM {src} s WHERE {whole}) SELECT feature, vif, CASE WHEN vif > 10 THEN 'high' WHEN vif > 5 "
            f"THEN 'moderate' ELSE 'low' END AS risk FROM ({vifs}) v")


@register("vif", vif_sql(NET_SQL, NETC), dbl=["vif"])
def vif(spark, sf):
    """VIF from the inverse correlation matrix (matrix built in Spark)."""
    return A.vif(li_net(spark, sf), NETC)


CV_COLS = ["l_returnflag", "l_linestatus", "l_linenumber", "l_tax"]


def chi_sql(src, pairs, fill=True, drop=False):
    parts = []
    for a, b in pairs:
        va = f"coalesce(CAST({a} AS VARCHAR), '_NA_')" if fill else f"CAST({a} AS VARCHAR)"
        vb = f"coalesce(CAST({b} AS VARCHAR), '_NA_')" if fill else f"CAST({b} AS VARCHAR)"
        w = f"WHERE {a} IS NOT NULL AND {b} IS NOT NULL" if drop else ""
        cells = f"SELECT {va} AS a, {vb} AS b, count(*) AS n FROM {src} s {w} GROUP BY 1, 2"
        rows = "SELECT DISTINCT a FROM cells"
        cols = "SELECT DISTINCT b FROM cells"
        grid = (f"SELECT r.a, c.b, coalesce(x.n, 0) AS n FROM ({rows}) r CROSS JOIN ({cols}) c LEFT JOIN cells x "
                f"ON x.a = r.a AND x.b = c.b")
        e = ("(SELECT g.*, sum(n) OVER (PARTITION BY a) * sum(n) OVER (PARTITION BY b) / sum(n) OVER () AS e, "
             "count(DISTINCT a) OVER () AS ka, count(DISTINCT b) OVER () AS kb FROM grid g)")
        parts.append(
            f"WITH cells AS ({cells}), grid AS ({grid}) SELECT '{a}' AS a_name, '{b}' AS b_name, sum(n)::BIGINT AS n, "
            f"max(ka)::BIGINT AS k_a, max(kb)::BIGINT AS k_b, ((max(ka) - 1) * (max(kb) - 1))::BIGINT AS dof, "
            f"CASE WHEN (max(ka) - 1) * (max(kb) - 1) = 1 THEN sum(power(abs(n - e) - least(0.5, abs(n - e)), 2) / e) "
            f"ELSE sum(power(n - e, 2) / e) END AS chi2 FROM {e} z")
    return union_all(parts)


@register("cramers_v",
          "SELECT a_name AS feature_a, b_name AS feature_b, chi2, sqrt(chi2 / (n * greatest(least(k_a, k_b) - 1, 1))) "
          f"AS cramers_v FROM ({chi_sql(LI_NULLS_SQL, pairs(CV_COLS))}) c",
          dbl=["chi2", "cramers_v"])
def cramers_v(spark, sf):
    """Cramer's V matrix (nulls as a level; Yates on 2x2)."""
    return A.cramers_v(li_nulls(spark, sf), CV_COLS)


CP_COLS = ["o_orderstatus", "o_orderpriority", "sentinel"]
ORD_SENT_SQL = ("(SELECT *, CASE WHEN o_orderstatus = 'F' THEN 'No open' WHEN o_totalprice > 100000 THEN 'Yes' "
                "ELSE 'No' END AS sentinel, CAST(o_totalprice > 200000 AS INTEGER) AS big FROM orders)")


def ord_sent(spark, sf):
    o = table(spark, sf, "orders")
    s = (F.when(F.col("o_orderstatus") == "F", "No open").when(F.col("o_totalprice") > 100000, "Yes").otherwise("No"))
    return o.withColumn("sentinel", s).withColumn("big", (F.col("o_totalprice") > 200000).cast("int"))


@register("cramers_pairs",
          "SELECT a_name AS feature_a, b_name AS feature_b, sqrt(chi2 / (n * greatest(least(k_a, k_b) - 1, 1))) AS cramers_v, "
          "CASE WHEN sqrt(chi2 / (n * greatest(least(k_a, k_b) - 1, 1))) > 0.8 THEN 'redundant' WHEN "
          "sqrt(chi2 / (n * greatest(least(k_a, k_b) - 1, 1))) > 0.5 THEN 'high' ELSE 'low' END AS risk, "
          "CAST(b_name = 'big' AS INTEGER) AS with_target "
          f"FROM ({chi_sql(ORD_SENT_SQL, pairs(CP_COLS + ['big']))}) c "
          "WHERE sqrt(chi2 / (n * greatest(least(k_a, k_b) - 1, 1))) > 0.5 OR b_name = 'big'", dbl=["cramers_v"])
def cramers_pairs(spark, sf):
    """High-V pairs with risk labels plus every V with the target."""
    return A.cramers_pairs(ord_sent(spark, sf), CP_COLS, target="big")


@register("chi2_independence",
          f"SELECT a_name AS feature, n, dof, chi2 FROM ({chi_sql(LI_NULLS_SQL, [(c, 'l_returnflag') for c in ['l_linestatus', 'l_discount', 'l_tax', 'l_linenumber']], fill=False, drop=True)}) c",
          dbl=["chi2"])
def chi2_independence(spark, sf):
    return A.chi2_independence(li_nulls(spark, sf), ["l_linestatus", "l_discount", "l_tax", "l_linenumber"], "l_returnflag")


def _anova_sql(src, feats, target):
    parts = []
    for c in feats:
        parts.append(
            f"SELECT '{c}' AS feature, (count(*) - 1)::BIGINT AS df_between, (sum(n) - count(*))::BIGINT AS df_within, "
            f"(sum(n * power(m - gm, 2)) / (count(*) - 1)) / (sum((n - 1) * coalesce(v, 0)) / (sum(n) - count(*))) AS f_stat "
            f"FROM (SELECT n, m, v, sum(n * m) OVER () / sum(n) OVER () AS gm FROM (SELECT count({c}) AS n, avg({c}) AS m, "
            f"var_samp({c}) AS v FROM {src} s WHERE {target} IS NOT NULL GROUP BY {target}) g) h")
    return union_all(parts)


@register("anova_f", _anova_sql("lineitem", LI_NUM, "l_returnflag"), dbl=["f_stat"])
def anova_f(spark, sf):
    return A.anova_f(li(spark, sf), LI_NUM, "l_returnflag")


@register("cohens_d", union_all([
    f"SELECT '{c}' AS feature, a.k AS class_a, b.k AS class_b, (a.m - b.m) / sqrt(((a.n - 1) * a.v + (b.n - 1) * b.v) / "
    f"(a.n + b.n - 2)) AS cohens_d, CASE WHEN abs((a.m - b.m) / sqrt(((a.n - 1) * a.v + (b.n - 1) * b.v) / (a.n + b.n - 2))) "
    f"> 0.8 THEN 'large' WHEN abs((a.m - b.m) / sqrt(((a.n - 1) * a.v + (b.n - 1) * b.v) / (a.n + b.n - 2))) > 0.5 THEN "
    f"'medium' WHEN abs((a.m - b.m) / sqrt(((a.n - 1) * a.v + (b.n - 1) * b.v) / (a.n + b.n - 2))) > 0.2 THEN 'small' "
    f"ELSE 'negligible' END AS effect FROM (SELECT CAST(o_orderpriority AS VARCHAR) AS k, count({c}) AS n, avg({c}) AS m, "
    f"var_samp({c}) AS v FROM {ORD_SENT_SQL} o GROUP BY 1) a JOIN (SELECT CAST(o_orderpriority AS VARCHAR) AS k, "
    f"count({c}) AS n, avg({c}) AS m, var_samp({c}) AS v FROM {ORD_SENT_SQL} o GROUP BY 1) b ON a.k < b.k"
    for c in ["o_totalprice", "o_custkey"]]), dbl=["cohens_d"])
def cohens_d(spark, sf):
    return A.cohens_d(ord_sent(spark, sf), ["o_totalprice", "o_custkey"], "o_orderpriority")


@register("mean_ci", union_all([
    f"SELECT '{c}' AS feature, count({c})::BIGINT AS n, avg({c}) AS mean, stddev_samp({c}) / sqrt(count({c})) AS se, "
    f"avg({c}) - 1.959963984540054 * stddev_samp({c}) / sqrt(count({c})) AS lower, avg({c}) + 1.959963984540054 * "
    f"stddev_samp({c}) / sqrt(count({c})) AS upper FROM {LI_NULLS_SQL} t" for c in LI_NUM]),
    dbl=["mean", "se", "lower", "upper"])
def mean_ci(spark, sf):
    return A.mean_ci(li_nulls(spark, sf), LI_NUM)


@register("mean_ci_t", rows_only=True)
def mean_ci_t(spark, sf):
    """T16 with the Student t critical value (special function)."""
    return A.mean_ci_t(li_nulls(spark, sf), LI_NUM)


def _g1(c, src):
    return f"(avg(power({c} - (SELECT avg({c}) FROM {src} s), 3)) / power(var_pop({c}), 1.5))"


@register("normality_jb", union_all([
    f"SELECT '{c}' AS feature, count({c})::BIGINT AS n, {_g1(c, 'events')} AS skew, kurtosis_pop({c}) AS kurt, "
    f"count({c}) / 6.0 * (power({_g1(c, 'events')}, 2) + power(kurtosis_pop({c}), 2) / 4.0) AS jb, "
    f"exp(-(count({c}) / 6.0 * (power({_g1(c, 'events')}, 2) + power(kurtosis_pop({c}), 2) / 4.0)) / 2.0) AS p_value, "
    f"CAST(exp(-(count({c}) / 6.0 * (power({_g1(c, 'events')}, 2) + power(kurtosis_pop({c}), 2) / 4.0)) / 2.0) > 0.05 "
    f"AS INTEGER) AS normal FROM events" for c in ["value", "user_id"]]), dbl=["skew", "kurt", "jb", "p_value"])
def normality_jb(spark, sf):
    return A.normality_jb(table(spark, sf, "events"), ["value", "user_id"])


@register("mcar_test", union_all([
    f"SELECT '{x}' AS feature, '{m}' AS missing_col, count({x}) FILTER (WHERE {m} IS NULL)::BIGINT AS n_miss, "
    f"count({x}) FILTER (WHERE {m} IS NOT NULL)::BIGINT AS n_obs, (avg({x}) FILTER (WHERE {m} IS NULL) - avg({x}) FILTER "
    f"(WHERE {m} IS NOT NULL)) / sqrt(var_samp({x}) FILTER (WHERE {m} IS NULL) / count({x}) FILTER (WHERE {m} IS NULL) + "
    f"var_samp({x}) FILTER (WHERE {m} IS NOT NULL) / count({x}) FILTER (WHERE {m} IS NOT NULL)) AS t_stat "
    f"FROM {LI_NULLS_SQL} t" for m in ["l_quantity", "l_discount", "l_tax"]
    for x in ["l_quantity", "l_extendedprice", "l_discount", "l_tax"] if x != m]), dbl=["t_stat"])
def mcar_test(spark, sf):
    return A.mcar_test(li_nulls(spark, sf), ["l_quantity", "l_extendedprice", "l_discount", "l_tax"],
                       ["l_quantity", "l_discount", "l_tax"])


def _ks_sql(tr, te, feats):
    parts = []
    for c in feats:
        parts.append(
            f"SELECT '{c}' AS feature, max(abs(f1 - f2)) AS ks_stat, max(n1)::BIGINT AS n_train, max(n2)::BIGINT AS n_test "
            f"FROM (SELECT sum(a) OVER (ORDER BY v ROWS UNBOUNDED PRECEDING) / sum(a) OVER () AS f1, "
            f"sum(b) OVER (ORDER BY v ROWS UNBOUNDED PRECEDING) / sum(b) OVER () AS f2, sum(a) OVER () AS n1, "
            f"sum(b) OVER () AS n2 FROM (SELECT v, sum(a) AS a, sum(b) AS b FROM (SELECT {c}::DOUBLE AS v, 1 AS a, 0 AS b "
            f"FROM {tr} x WHERE {c} IS NOT NULL UNION ALL SELECT {c}::DOUBLE, 0, 1 FROM {te} y WHERE {c} IS NOT NULL) u "
            f"GROUP BY v) g) w")
    return union_all(parts)


@register("ks_2samp", _ks_sql(LI_TRAIN_SQL, LI_TEST_DRIFT_SQL, LI_NUM), dbl=["ks_stat"])
def ks_2samp(spark, sf):
    """KS statistic train vs (drifted) test."""
    return A.ks_2samp(li_train(spark, sf), li_test_drift(spark, sf), LI_NUM)


def _psi_ew_sql(tr, te, feats):
    parts = []
    for c in feats:
        b = (f"CASE WHEN floor(({c}::DOUBLE - mm.lo) * (10.0 / (mm.hi - mm.lo))) >= 10 THEN 9 ELSE "
             f"floor(({c}::DOUBLE - mm.lo) * (10.0 / (mm.hi - mm.lo))) END")
        mm = f"(SELECT min({c}::DOUBLE) AS lo, max({c}::DOUBLE) AS hi FROM (SELECT {c} FROM {tr} p UNION ALL SELECT {c} FROM {te} q) z)"
        cnt = (f"SELECT bin, count(*) FILTER (WHERE side = 1) AS e, count(*) FILTER (WHERE side = 2) AS a FROM "
               f"(SELECT {b} AS bin, 1 AS side FROM {tr} x, {mm} mm UNION ALL SELECT {b}, 2 FROM {te} y, {mm} mm) u "
               f"WHERE bin IS NOT NULL GROUP BY bin")
        parts.append(
            f"SELECT '{c}' AS feature, sum((pa - pe) * ln(pa / pe)) AS psi FROM (SELECT greatest(e::DOUBLE / sum(e) OVER (), 1e-4) "
            f"AS pe, greatest(a::DOUBLE / sum(a) OVER (), 1e-4) AS pa FROM ({cnt}) g) h")
    return ("SELECT feature, psi, CASE WHEN psi > 0.2 THEN 'significant' WHEN psi > 0.1 THEN 'moderate' ELSE 'stable' END "
            f"AS drift FROM ({union_all(parts)}) z")


@register("psi_equal_width", _psi_ew_sql(LI_TRAIN_SQL, LI_TEST_DRIFT_SQL, LI_NUM), dbl=["psi"])
def psi_equal_width(spark, sf):
    return A.psi_equal_width(li_train(spark, sf), li_test_drift(spark, sf), LI_NUM)


def _edges_sql(src, c, n=10):
    qs = ", ".join(str(i / n) for i in range(n + 1))
    return f"(SELECT list_sort(list_distinct(quantile_cont({c}::DOUBLE, [{qs}]))) AS e FROM {src} s)"


def _psi_q_sql(tr, te, feats):
    parts = []
    for c in feats:
        ed = _edges_sql(tr, c)
        x = f"{c}::DOUBLE"
        b = (f"CASE WHEN {x} < ed.e[1] OR {x} > ed.e[len(ed.e)] THEN NULL WHEN {x} = ed.e[len(ed.e)] THEN len(ed.e) - 2 "
             f"ELSE len(list_filter(ed.e, lambda q: q <= {x})) - 1 END")
        u = (f"SELECT {b} AS bin, 1 AS side, len(ed.e) - 1 AS nb FROM {tr} p, {ed} ed UNION ALL "
             f"SELECT {b}, 2, len(ed.e) - 1 FROM {te} q, {ed} ed")
        grid = f"SELECT DISTINCT nb, unnest(range(0, nb)) AS bin FROM ({u}) uu"
        cnt = (f"SELECT bin, count(*) FILTER (WHERE side = 1) AS tr, count(*) FILTER (WHERE side = 2) AS te FROM ({u}) uu "
               f"WHERE bin IS NOT NULL GROUP BY bin")
        g = (f"SELECT gg.bin, gg.nb, coalesce(cc.tr, 0) AS tr, coalesce(cc.te, 0) AS te FROM ({grid}) gg LEFT JOIN ({cnt}) cc "
             f"ON gg.bin = cc.bin")
        p = (f"SELECT nb, (tr + 1)::DOUBLE / (sum(tr) OVER () + nb) AS trp, (te + 1)::DOUBLE / (sum(te) OVER () + nb) AS tep "
             f"FROM ({g}) g2")
        parts.append(f"SELECT '{c}' AS feature, max(nb)::BIGINT AS n_bins, CASE WHEN max(nb) >= 2 THEN "
                     f"sum((tep - trp) * ln(tep / trp)) ELSE 0.0 END AS psi FROM ({p}) p2")
    return union_all(parts)


@register("psi_quantile", _psi_q_sql(LI_TRAIN_SQL, LI_TEST_DRIFT_SQL, LI_NUM), dbl=["psi"])
def psi_quantile(spark, sf):
    return A.psi_quantile(li_train(spark, sf), li_test_drift(spark, sf), LI_NUM)


@register("drift_numeric",
          f"SELECT k.feature, k.ks_stat, p.psi, CAST(k.ks_stat > 0.05 OR p.psi > 0.10 AS INTEGER) AS drift FROM "
          f"({_ks_sql(LI_TRAIN_SQL, LI_TEST_DRIFT_SQL, LI_NUM)}) k JOIN ({_psi_q_sql(LI_TRAIN_SQL, LI_TEST_DRIFT_SQL, LI_NUM)}) p "
          f"ON k.feature = p.feature", dbl=["ks_stat", "psi"])
def drift_numeric(spark, sf):
    return A.drift_numeric(li_train(spark, sf), li_test_drift(spark, sf), LI_NUM)


@register("mean_drift", union_all([
    f"SELECT '{c}' AS feature, a.m AS mean_train, b.m AS mean_test, abs(b.m - a.m) / abs(a.m) AS rel_change, "
    f"CASE WHEN abs(b.m - a.m) / abs(a.m) > 0.3 THEN 'high' WHEN abs(b.m - a.m) / abs(a.m) > 0.1 THEN 'moderate' "
    f"ELSE 'low' END AS drift FROM (SELECT avg({c}) AS m FROM {LI_TRAIN_SQL} x) a, (SELECT avg({c}) AS m FROM "
    f"{LI_TEST_DRIFT_SQL} y) b" for c in LI_NUM]), dbl=["mean_train", "mean_test", "rel_change"])
def mean_drift(spark, sf):
    return A.mean_drift(li_train(spark, sf), li_test_drift(spark, sf), LI_NUM)


# ------------------------------------------------------------ binned target relations
BIN_NUM = ["l_quantity", "l_extendedprice", "l_discount"]
BIN_CAT = ["l_linestatus", "l_linenumber"]


def _binned_sql(src, num, cat, y, n=10):
    parts = []
    for c in num:
        ed = _edges_sql(f"(SELECT * FROM {src} w WHERE {y} IS NOT NULL)", c, n)
        b = f"CAST(greatest(len(list_filter(ed.e, lambda q: q < {c}::DOUBLE)) - 1, 0) AS VARCHAR)"
        parts.append(f"SELECT '{c}' AS feature, {b} AS bin, {y} AS y FROM {src} s, {ed} ed WHERE {c} IS NOT NULL AND {y} IS NOT NULL")
    for c in cat:
        parts.append(f"SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS bin, {y} AS y FROM {src} s "
                     f"WHERE {c} IS NOT NULL AND {y} IS NOT NULL")
    return union_all(parts)


_Y_SRC = f"(SELECT *, {Y_BIN_SQL}::DOUBLE AS y FROM lineitem)"
def woe_sql(src, num, cat):
    """Levels and bins with their weight of evidence; ``src`` has the event as ``y``."""
    return (f"SELECT feature, bin, tot, ev, pe AS pct_event, pn AS pct_non_event, ln(pn / pe) AS woe, (pn - pe) * ln(pn / pe) "
            f"AS iv_part FROM (SELECT feature, bin, tot::BIGINT AS tot, ev, greatest(ev / greatest(sum(ev) OVER (PARTITION BY feature), 1.0), 1e-4) AS pe, "
            f"greatest((tot - ev) / greatest(sum(tot - ev) OVER (PARTITION BY feature), 1.0), 1e-4) AS pn FROM (SELECT feature, bin, "
            f"sum(y) AS ev, count(*) AS tot FROM ({_binned_sql(src, num, cat, 'y')}) b GROUP BY 1, 2) g) h")


WOE_SQL = woe_sql(_Y_SRC, BIN_NUM, BIN_CAT)


@register("woe_table", WOE_SQL, dbl=["ev", "pct_event", "pct_non_event", "woe", "iv_part"])
def woe_table(spark, sf):
    return A.woe_table(li(spark, sf), BIN_NUM, BIN_CAT, y_binary())


@register("information_value",
          f"SELECT feature, sum(iv_part) AS iv, CASE WHEN sum(iv_part) < 0.02 THEN 'useless' WHEN sum(iv_part) < 0.1 THEN 'weak' "
          f"WHEN sum(iv_part) < 0.3 THEN 'medium' WHEN sum(iv_part) < 0.5 THEN 'strong' ELSE 'suspicious' END AS strength "
          f"FROM ({WOE_SQL}) w GROUP BY feature", dbl=["iv"])
def information_value(spark, sf):
    return A.information_value(li(spark, sf), BIN_NUM, BIN_CAT, y_binary())


def mi_sql(src, num, cat, y):
    cells = f"SELECT feature, bin, y, count(*) AS n FROM ({_binned_sql(src, num, cat, y)}) b GROUP BY 1, 2, 3"
    c = (f"SELECT feature, n, sum(n) OVER (PARTITION BY feature) AS nn, sum(n) OVER (PARTITION BY feature, bin) AS nb, "
         f"sum(n) OVER (PARTITION BY feature, y) AS ny FROM ({cells}) c")
    return (f"SELECT feature, mi, row_number() OVER (ORDER BY mi DESC, feature)::BIGINT AS rank FROM (SELECT feature, "
            f"sum(n::DOUBLE / nn * ln(n::DOUBLE * nn / (nb * ny))) AS mi FROM ({c}) d GROUP BY feature) e")


_YS_SRC = "(SELECT *, CAST(l_returnflag AS VARCHAR) AS y FROM lineitem)"


@register("mi_binned", mi_sql(_YS_SRC, BIN_NUM, BIN_CAT, "y"), dbl=["mi"])
def mi_binned(spark, sf):
    """Plug-in MI of binned numerics / levels with the 3-class return flag."""
    return A.mi_binned(li(spark, sf), BIN_NUM, BIN_CAT, F.col("l_returnflag"))


_PROD = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
_PROD_SQL = ("(SELECT CAST(l_returnflag AS VARCHAR) AS y, " + ", ".join(
    f"{a}::DOUBLE * {b}::DOUBLE AS \"{a}*{b}\"" for a, b in pairs(_PROD)) + " FROM lineitem)")


@register("mi_interactions",
          "SELECT * FROM (" + mi_sql(_PROD_SQL, [f'"{a}*{b}"' for a, b in pairs(_PROD)], [], "y")
          .replace("SELECT '\"", "SELECT '").replace("\"' AS feature", "' AS feature") + ") z WHERE rank <= 10", dbl=["mi"])
def mi_interactions(spark, sf):
    return A.mi_interactions(li(spark, sf), _PROD, F.col("l_returnflag"))


def _mono_sql():
    parts = []
    src = f"(SELECT *, {Y_BIN_SQL}::DOUBLE AS y FROM lineitem)"
    for c in BIN_NUM:
        b = f"SELECT bin, y FROM ({_binned_sql(src, [c], [], 'y')}) q"
        m = f"SELECT CAST(bin AS INTEGER) AS bin, avg(y) AS mean, count(*) AS n FROM ({b}) r GROUP BY 1"
        d = (f"SELECT bin, mean, n, mean - lag(mean) OVER (ORDER BY bin) AS diff, row_number() OVER (ORDER BY bin) AS pos, "
             f"rank() OVER (ORDER BY mean) + (count(*) OVER (PARTITION BY mean) - 1) / 2.0 AS mrank FROM ({m}) s")
        parts.append(
            f"SELECT '{c}' AS feature, count(*)::BIGINT AS n_bins, CASE WHEN bool_and(coalesce(diff >= 0, TRUE)) THEN 'increasing' "
            f"WHEN bool_and(coalesce(diff <= 0, TRUE)) THEN 'decreasing' ELSE 'non-monotone' END AS direction, "
            f"corr(pos::DOUBLE, mrank) AS spearman, sum(n) AS n FROM ({d}) t")
    return f"SELECT feature, n_bins, direction, spearman FROM ({union_all(parts)}) z WHERE n >= 30 AND n_bins >= 3"


@register("monotonicity", _mono_sql(), dbl=["spearman"])
def monotonicity(spark, sf):
    return A.monotonicity(li(spark, sf), BIN_NUM, y_binary())


def _ig_sql():
    parts = []
    y = f"{Y_BIN_SQL}::DOUBLE"
    for a, b in pairs(_PROD):
        best = f"greatest(abs(corr({a}, {y})), abs(corr({b}, {y})))"
        for kind, e in (("product", f"{a} * {b}"), ("ratio", f"{a} / ({b} + 1e-6)")):
            parts.append(f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, '{kind}' AS kind, abs(corr({e}, {y})) AS abs_corr, "
                         f"{best} AS best_single, abs(corr({e}, {y})) - {best} AS gain FROM lineitem")
    return union_all(parts)


@register("interaction_gain", _ig_sql(), dbl=["abs_corr", "best_single", "gain"])
def interaction_gain(spark, sf):
    return A.interaction_gain(li(spark, sf), _PROD, y_binary())


_SIMP_SRC = "(SELECT *, CAST(o_totalprice > 200000 AS INTEGER)::DOUBLE AS y FROM orders)"


@register("simpson",
          "SELECT g.feature, g.group_col, g.level, g.n, g.r_group, a.r_global FROM (" + union_all([
              f"SELECT '{c}' AS feature, '{grp}' AS group_col, CAST({grp} AS VARCHAR) AS level, count({c})::BIGINT AS n, "
              f"corr({c}::DOUBLE, y) AS r_group FROM {_SIMP_SRC} s GROUP BY 3" for c in ["o_custkey", "o_orderkey"]
              for grp in ["o_orderstatus", "o_orderpriority"]]) + ") g JOIN (" + union_all([
                  f"SELECT '{c}' AS feature, corr({c}::DOUBLE, y) AS r_global FROM {_SIMP_SRC} s" for c in ["o_custkey", "o_orderkey"]])
          + ") a ON g.feature = a.feature WHERE sign(g.r_group) <> sign(a.r_global) AND abs(g.r_group) > 0.1 AND g.n >= 30 "
          "AND abs(a.r_global) >= 0.05", dbl=["r_group", "r_global"])
def simpson(spark, sf):
    o = table(spark, sf, "orders")
    return A.simpson(o, ["o_custkey", "o_orderkey"], ["o_orderstatus", "o_orderpriority"],
                     (F.col("o_totalprice") > 200000).cast("int"))


_REVERSED_SQL = ("(SELECT *, CASE l_returnflag WHEN 'A' THEN 100.0 WHEN 'N' THEN 200.0 ELSE 300.0 END AS base, l_quantity::DOUBLE "
                 "AS q FROM lineitem)")


@register("simpson_reversed",
          "SELECT g.*, a.r_global FROM (SELECT 'shifted' AS feature, 'l_returnflag' AS group_col, l_returnflag AS level, "
          "count(*)::BIGINT AS n, corr(q + base, base - q) AS r_group "
          f"FROM {_REVERSED_SQL} s GROUP BY 3) g, (SELECT corr(q + base, base - q) AS r_global FROM {_REVERSED_SQL} s) a "
          "WHERE sign(r_group) <> sign(r_global) AND abs(r_group) > 0.1 AND n >= 30 AND abs(r_global) >= 0.05", dbl=["r_group", "r_global"])
def simpson_reversed(spark, sf):
    """Groups that lie apart, inside which the sign of the correlation is the other one."""
    base = F.when(F.col("l_returnflag") == "A", 100.0).when(F.col("l_returnflag") == "N", 200.0).otherwise(300.0)
    t = li(spark, sf).withColumn("base", base).withColumn("shifted", F.col("l_quantity").cast("double") + base)
    return A.simpson(t, ["shifted"], ["l_returnflag"], F.col("base") - F.col("l_quantity").cast("double"))


@register("subgroup_effects", union_all([
    f"SELECT CAST(o_orderpriority AS VARCHAR) AS level, '{c}' AS feature, count(*)::BIGINT AS n, avg(y) AS target_mean, "
    f"corr({c}::DOUBLE, y) AS corr FROM {_SIMP_SRC} s GROUP BY 1 HAVING count(*) >= 30" for c in ["o_custkey", "o_orderkey"]]),
    dbl=["target_mean", "corr"])
def subgroup_effects(spark, sf):
    o = table(spark, sf, "orders")
    return A.subgroup_effects(o, ["o_custkey", "o_orderkey"], "o_orderpriority", (F.col("o_totalprice") > 200000).cast("int"))


_LEAK_SRC = ("(SELECT *, o_totalprice / 1000.0 AS price_k, o_totalprice * 0.5 + o_custkey AS noisy, "
             "CAST(o_totalprice > 200000 AS INTEGER)::DOUBLE AS y FROM orders)")


def leak_frame(spark, sf):
    o = table(spark, sf, "orders")
    return o.select("*", (F.col("o_totalprice") / 1000.0).alias("price_k"),
                    (F.col("o_totalprice") * 0.5 + F.col("o_custkey")).alias("noisy"))


@register("leak_corr", union_all([
    f"SELECT '{c}' AS feature, corr({c}::DOUBLE, o_totalprice) AS corr, CASE WHEN abs(corr({c}::DOUBLE, o_totalprice)) > 0.99 "
    f"THEN 'leak' WHEN abs(corr({c}::DOUBLE, o_totalprice)) > 0.95 THEN 'suspect' ELSE 'ok' END AS verdict FROM {_LEAK_SRC} s"
    for c in ["price_k", "noisy", "o_custkey", "o_orderkey"]]), dbl=["corr"])
def leak_corr(spark, sf):
    return A.leak_corr(leak_frame(spark, sf), ["price_k", "noisy", "o_custkey", "o_orderkey"], F.col("o_totalprice"))


_ENC_SRC = ("(SELECT l_linestatus, CAST(round(avg(" + Y_BIN_SQL + ") OVER (PARTITION BY l_linestatus), 4) AS VARCHAR) AS "
            "enc_status, CAST(l_linenumber AS VARCHAR) AS line_txt, " + Y_BIN_SQL + "::DOUBLE AS y FROM lineitem)")


@register("leak_encoding", union_all([
    f"SELECT '{c}' AS feature, count(*)::BIGINT AS n_levels, count(TRY_CAST(value AS DOUBLE))::BIGINT AS n_numeric, "
    f"count(*) FILTER (WHERE abs(TRY_CAST(value AS DOUBLE) - tm) <= 0.01)::BIGINT AS n_match, "
    f"count(*) FILTER (WHERE abs(TRY_CAST(value AS DOUBLE) - tm) <= 0.01)::DOUBLE / count(*) AS match_share, "
    f"CAST(count(TRY_CAST(value AS DOUBLE)) = count(*) AND count(*) FILTER (WHERE abs(TRY_CAST(value AS DOUBLE) - tm) <= 0.01)"
    f"::DOUBLE / count(*) > 0.9 AS INTEGER) AS leak FROM (SELECT CAST({c} AS VARCHAR) AS value, avg(y) AS tm FROM {_ENC_SRC} e "
    f"WHERE {c} IS NOT NULL GROUP BY 1) g" for c in ["l_linestatus", "enc_status", "line_txt"]]), dbl=["match_share"])
def leak_encoding(spark, sf):
    """A column holding the rounded per-level target mean is flagged; plain levels are not."""
    from tabscope.plans.frames import bounded
    t = li(spark, sf)
    # one row a level, joined back: a window would bring all rows of a level into one task
    enc = t.groupBy(F.col("l_linestatus").alias("_level")).agg(F.round(F.avg(y_binary()), 4).cast("string").alias("enc_status"))
    t = t.join(bounded(enc), F.col("l_linestatus").eqNullSafe(F.col("_level"))).select(
        "l_linestatus", "enc_status", F.col("l_linenumber").cast("string").alias("line_txt"),
                 y_binary().alias("y"))
    return A.leak_encoding(t, ["l_linestatus", "enc_status", "line_txt"], F.col("y"))


@register("leak_distribution",
          "WITH vc AS (" + union_all([f"SELECT '{c}' AS feature, count(*)::DOUBLE / sum(count(*)) OVER () AS p FROM lineitem "
                                      f"WHERE {c} IS NOT NULL GROUP BY {c}" for c in
                                      ["l_linestatus", "l_returnflag", "rf_copy", "l_linenumber"]]).replace(
              "FROM lineitem", "FROM (SELECT *, lower(l_returnflag) AS rf_copy FROM lineitem) t") +
          "), vec AS (SELECT feature, list_sort(list(p)) AS v FROM vc GROUP BY feature) "
          "SELECT f.feature, len(f.v)::BIGINT AS n_levels, CAST(len(f.v) = len(t.v) AND list_bool_and(list_transform("
          "range(1, len(f.v) + 1), lambda i: abs(f.v[i] - t.v[i]) <= 0.001)) AS INTEGER) AS mirrors_target "
          "FROM vec f, (SELECT v FROM vec WHERE feature = 'l_returnflag') t WHERE f.feature <> 'l_returnflag'")
def leak_distribution(spark, sf):
    t = li(spark, sf).withColumn("rf_copy", F.lower("l_returnflag"))
    return A.leak_distribution(t, ["l_linestatus", "rf_copy", "l_linenumber"], "l_returnflag")


@register("leak_structural",
          "SELECT feature, unique_per_row, missing_in_test, 0 AS target_in_test, (SELECT corr(o_orderkey::DOUBLE, "
          "o_totalprice) FROM orders WHERE o_orderkey % 5 <> 0) AS id_target_corr FROM (" + union_all([
              f"SELECT '{c}' AS feature, CAST(count(DISTINCT {c}) = count(*) AS INTEGER) AS unique_per_row, "
              f"{int(c == 'o_orderpriority')} AS missing_in_test FROM orders WHERE o_orderkey % 5 <> 0"
              for c in ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority"]]) + ") z",
          dbl=["id_target_corr"])
def leak_structural(spark, sf):
    o = table(spark, sf, "orders")
    tr = o.where(F.pmod("o_orderkey", F.lit(5)) != 0)
    te = o.where(F.pmod("o_orderkey", F.lit(5)) == 0).drop("o_totalprice", "o_orderpriority")
    return A.leak_structural(tr, te, "o_totalprice", id_col="o_orderkey")


@register("sentinel_dependency",
          "WITH cube AS (" + union_all([
              f"SELECT '{c}' AS a_name, '{p}' AS b_name, CAST({c} AS VARCHAR) AS a, CAST({p} AS VARCHAR) AS b, count(*) AS n "
              f"FROM {ORD_SENT_SQL} o WHERE {c} IS NOT NULL AND {p} IS NOT NULL GROUP BY 3, 4"
              for c, p in [("sentinel", "o_orderstatus"), ("sentinel", "o_orderpriority"), ("o_orderstatus", "sentinel"),
                           ("o_orderstatus", "o_orderpriority")]]) +
          ") SELECT c.a_name AS child, c.a AS child_value, c.b_name AS parent, c.b AS parent_value, c.n::BIGINT AS n "
          "FROM cube c JOIN (SELECT a_name, b_name, a, count(*) AS k FROM cube GROUP BY 1, 2, 3) ct USING (a_name, b_name, a) "
          "JOIN (SELECT a_name, b_name, b, sum(n) AS np FROM cube GROUP BY 1, 2, 3) pt USING (a_name, b_name, b) "
          "WHERE ct.k = 1 AND c.n = pt.np AND regexp_matches(c.a, '^No .+')")
def sentinel_dependency(spark, sf):
    """T37: 'No open' occurs exactly when order status is F."""
    return A.sentinel_dependency(ord_sent(spark, sf), ["sentinel", "o_orderstatus"],
                                 ["o_orderstatus", "o_orderpriority", "sentinel"])


_DERIVED = ["l_quantity", "l_extendedprice", "l_discount", "net_price", "unit_price"]
_DERIVED_SQL = ("(SELECT *, l_extendedprice * (1 - l_discount) AS net_price, l_extendedprice / l_quantity AS unit_price FROM lineitem)")


def _derived_sql():
    parts = []
    for a, b in pairs(_DERIVED):
        for kind, p, q, value in (("product", a, b, f"{a} * {b}"), ("sum", a, b, f"{a} + {b}"), ("difference", a, b, f"{a} - {b}"),
                                  ("ratio", a, b, f"{a} / nullif({b}, 0)"), ("ratio", b, a, f"{b} / nullif({a}, 0)")):
            parts += [f"SELECT '{kind}' AS relation, '{p}' AS feature_a, '{q}' AS feature_b, '{c}' AS target_col, "
                      f"corr({value}, {c}) AS corr FROM {_DERIVED_SQL} t" for c in _DERIVED if c not in (a, b)]
    return f"SELECT * FROM ({union_all(parts)}) z WHERE abs(corr) > 0.95"


@register("derived_features", _derived_sql(), dbl=["corr"])
def derived_features(spark, sf):
    """Products, sums, differences and ratios of two columns that reproduce a third."""
    return A.derived_features(li_net(spark, sf).withColumn("unit_price", F.col("l_extendedprice") / F.col("l_quantity")), _DERIVED)


@register("product_residual", "SELECT l_orderkey, l_linenumber, l_extendedprice - l_quantity * l_discount AS resid FROM lineitem",
          dbl=["resid"])
def product_residual(spark, sf):
    """FE20: c - a x b as a column."""
    return A.product_residual(li(spark, sf), "l_quantity", "l_discount", "l_extendedprice", "resid").select(
        "l_orderkey", "l_linenumber", "resid")


@register("linear_residuals",
          "SELECT regr_slope(l_extendedprice, l_quantity) AS slope, regr_intercept(l_extendedprice, l_quantity) AS intercept, "
          "regr_r2(l_extendedprice, l_quantity) AS r2, regr_count(l_extendedprice, l_quantity)::BIGINT AS n, "
          "stddev_samp(l_extendedprice - (f.i + f.s * l_quantity)) AS resid_std, max(abs(l_extendedprice - (f.i + f.s * "
          "l_quantity))) AS resid_max_abs FROM lineitem, (SELECT regr_slope(l_extendedprice, l_quantity) AS s, "
          "regr_intercept(l_extendedprice, l_quantity) AS i FROM lineitem) f",
          dbl=["slope", "intercept", "r2", "resid_std", "resid_max_abs"])
def linear_residuals(spark, sf):
    return A.linear_residuals(li(spark, sf), "l_quantity", "l_extendedprice")


@register("residual_feature",
          "SELECT l_orderkey, l_linenumber, l_extendedprice - (f.i + f.s * l_quantity) AS resid FROM lineitem, "
          "(SELECT regr_slope(l_extendedprice, l_quantity) AS s, regr_intercept(l_extendedprice, l_quantity) AS i FROM lineitem) f",
          dbl=["resid"], digits=6)
def residual_feature(spark, sf):
    """Residual of price on quantity as a column."""
    return A.residual_feature(li(spark, sf).select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice"),
                              "l_quantity", "l_extendedprice", "resid").select("l_orderkey", "l_linenumber", "resid")


# ------------------------------------------------------------ p-values (no SQL form; golden values in the tests)
@register("chi2_pvalues", rows_only=True)
def chi2_pvalues(spark, sf):
    return A.chi2_pvalues(li_nulls(spark, sf), ["l_linestatus", "l_discount", "l_tax", "l_linenumber"], "l_returnflag")


@register("anova_pvalues", rows_only=True)
def anova_pvalues(spark, sf):
    return A.anova_pvalues(li(spark, sf), LI_NUM, "l_returnflag")


@register("ks_pvalues", rows_only=True)
def ks_pvalues(spark, sf):
    return A.ks_pvalues(li_train(spark, sf), li_test_drift(spark, sf), LI_NUM)


@register("mcar_summary", rows_only=True)
def mcar_summary(spark, sf):
    return A.mcar_summary(li_nulls(spark, sf), ["l_quantity", "l_extendedprice", "l_discount", "l_tax"],
                          ["l_quantity", "l_discount", "l_tax"])


# ------------------------------------------------------------ distribution diagnostics (rows-only)
@register("normality_ad", rows_only=True)
def normality_ad(spark, sf):
    """Anderson-Darling on the full columns."""
    from tabscope.operators.distribution import normality_ad as ad
    return ad(table(spark, sf, "events"), ["value", "user_id"])


@register("distribution_fit", rows_only=True)
def distribution_fit(spark, sf):
    from tabscope.operators.distribution import distribution_fit as fit
    return fit(table(spark, sf, "events"), ["value"])


@register("modes", rows_only=True)
def modes(spark, sf):
    from tabscope.operators.distribution import modes as m
    return m(li(spark, sf), LI_NUM)


@register("feature_clusters", rows_only=True)
def feature_clusters(spark, sf):
    from tabscope.operators.distribution import feature_clusters as fc
    return fc(li_net(spark, sf), NETC)


@register("mi_stability", rows_only=True)
def mi_stability(spark, sf):
    from tabscope.operators.distribution import mi_stability as ms
    return ms(li(spark, sf), BIN_NUM, BIN_CAT, F.col("l_returnflag"), rounds=30)


_KT = ["l_linenumber", "l_discount", "l_tax"]


def _kendall_sql():
    parts = []
    for a, b in pairs(_KT):
        cells = f"SELECT {a}::DOUBLE AS x, {b}::DOUBLE AS y, count(*) AS n FROM lineitem GROUP BY 1, 2"
        parts.append(
            f"WITH c AS ({cells}), s AS (SELECT sum(CASE WHEN sign(c2.x - c1.x) * sign(c2.y - c1.y) > 0 THEN c1.n * c2.n ELSE 0 END) "
            f"AS conc, sum(CASE WHEN sign(c2.x - c1.x) * sign(c2.y - c1.y) < 0 THEN c1.n * c2.n ELSE 0 END) AS disc "
            f"FROM c c1 JOIN c c2 ON c1.x < c2.x), t AS (SELECT sum(n) AS n FROM c), "
            f"tx AS (SELECT sum(k * (k - 1) / 2.0) AS t FROM (SELECT sum(n) AS k FROM c GROUP BY x) q), "
            f"ty AS (SELECT sum(k * (k - 1) / 2.0) AS u FROM (SELECT sum(n) AS k FROM c GROUP BY y) q) "
            f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, (conc - disc)::DOUBLE / sqrt((n * (n - 1) / 2.0 - t) * "
            f"(n * (n - 1) / 2.0 - u)) AS kendall_tau FROM s, t, tx, ty")
    return union_all(parts)


@register("corr_kendall", _kendall_sql(), dbl=["kendall_tau"])
def corr_kendall(spark, sf):
    """T4: Kendall tau-b on low-cardinality columns (exact)."""
    return A.corr_kendall(li(spark, sf), _KT)
