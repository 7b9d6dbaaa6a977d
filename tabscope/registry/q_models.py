"""Model-based analysis, metrics, advice tables and findings."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tabscope.operators import advice as D
from tabscope.operators import models as M
from tabscope.operators import profile as P
from tabscope.registry.base import (LI_NULLS_SQL, LI_NUM, Y_BIN_SQL, li, li_nulls, li_test, li_train, register,
                                    table, union_all, y_binary)
from tabscope.registry.q_profile import top_sql, vc_sql
from tabscope.registry.q_stats import (CP_COLS, NET_SQL, NETC, ORD_SENT_SQL, chi_sql, li_net, mi_sql, ord_sent, pairs, vif_sql,
                                       woe_sql)

# ------------------------------------------------------------ metrics
_PRED_SQL = ("(SELECT l.l_returnflag AS y, t.top_class AS yhat FROM lineitem l JOIN (SELECT l_linestatus, "
             "arg_min(l_returnflag, (-n, l_returnflag)) AS top_class FROM (SELECT l_linestatus, l_returnflag, count(*) AS n "
             "FROM lineitem GROUP BY 1, 2) c GROUP BY 1) t ON l.l_linestatus = t.l_linestatus)")


def _pred(spark, sf):
    """Predictions of a rule model: each line status predicts its dominant return flag."""
    t = li(spark, sf)
    top = P.category_top_class(t, ["l_linestatus"], "l_returnflag").select(
        F.col("value").alias("l_linestatus"), "top_class")
    return t.join(top, "l_linestatus").select(F.col("l_returnflag").alias("y"), F.col("top_class").alias("yhat"))


@register("classification_metrics",
          "WITH cm AS (SELECT y, yhat, count(*) AS n FROM " + _PRED_SQL + " p GROUP BY 1, 2), "
          "cls AS (SELECT y AS k FROM cm UNION SELECT yhat FROM cm), per AS (SELECT k, coalesce((SELECT sum(n) FROM cm WHERE "
          "y = k AND yhat = k), 0) AS tp, coalesce((SELECT sum(n) FROM cm WHERE y = k), 0) AS nt, coalesce((SELECT sum(n) "
          "FROM cm WHERE yhat = k), 0) AS np FROM cls) SELECT sum(tp)::DOUBLE / sum(nt) AS accuracy, avg(CASE WHEN nt + np > 0 "
          "THEN 2.0 * tp / (nt + np) ELSE 0.0 END) AS f1_macro, sum(nt)::BIGINT AS n FROM per",
          dbl=["accuracy", "f1_macro"])
def classification_metrics(spark, sf):
    return M.classification_metrics(_pred(spark, sf), "y", "yhat")


@register("log_loss",
          f"SELECT -avg(y * ln(least(greatest(p, 1e-15), 1 - 1e-15)) + (1 - y) * ln(1 - least(greatest(p, 1e-15), 1 - 1e-15))) "
          f"AS log_loss, count(*)::BIGINT AS n FROM (SELECT {Y_BIN_SQL}::DOUBLE AS y, avg({Y_BIN_SQL}::DOUBLE) OVER "
          f"(PARTITION BY l_linestatus, l_linenumber) AS p FROM lineitem) z", dbl=["log_loss"])
def log_loss(spark, sf):
    """M9: log-loss of the (line status, line number) target-mean model."""
    t = li(spark, sf)
    g = t.groupBy("l_linestatus", "l_linenumber").agg(F.avg(y_binary().cast("double")).alias("p"))
    return M.log_loss(t.join(g, ["l_linestatus", "l_linenumber"]), y_binary(), F.col("p"))


@register("roc_auc",
          f"SELECT (sum(r) FILTER (WHERE y = 1) - n1 * (n1 + 1) / 2.0) / (n1 * (n - n1)) AS auc, n1::BIGINT AS n_pos, "
          f"(n - n1)::BIGINT AS n_neg FROM (SELECT y, rank() OVER (ORDER BY s) + (count(*) OVER (PARTITION BY s) - 1) / 2.0 AS r, "
          f"sum(y) OVER () AS n1, count(*) OVER () AS n FROM (SELECT {Y_BIN_SQL} AS y, l_extendedprice * (1 - l_discount) "
          f"AS s FROM lineitem) a) b GROUP BY n1, n", dbl=["auc"])
def roc_auc(spark, sf):
    """M9: AUC of net price as a score for return flag R (rank-sum, ties averaged)."""
    return M.roc_auc(li(spark, sf), y_binary(), F.col("l_extendedprice") * (1 - F.col("l_discount")))


@register("regression_metrics",
          "SELECT sqrt(avg(power(yhat - y, 2))) AS rmse, avg(abs(yhat - y)) AS mae, 1 - sum(power(yhat - y, 2)) / "
          "(var_pop(y) * count(*)) AS r2, count(*)::BIGINT AS n FROM (SELECT o.o_totalprice AS y, s.yhat FROM orders o JOIN "
          "(SELECT l_orderkey, sum(l_extendedprice * (1 + l_tax) * (1 - l_discount)) AS yhat FROM lineitem GROUP BY 1) s "
          "ON o.o_orderkey = s.l_orderkey) p", dbl=["rmse", "mae", "r2"])
def regression_metrics(spark, sf):
    """M9: order total predicted by the sum of its discounted, taxed line prices."""
    s = li(spark, sf).groupBy("l_orderkey").agg(
        F.sum(F.col("l_extendedprice") * (1 + F.col("l_tax")) * (1 - F.col("l_discount"))).alias("yhat"))
    j = table(spark, sf, "orders").join(s, F.col("o_orderkey") == F.col("l_orderkey"))
    return M.regression_metrics(j, F.col("o_totalprice"), F.col("yhat"))


@register("pivot_metrics",
          "SELECT l_returnflag, avg(l_discount) FILTER (WHERE l_linestatus = 'F') AS F, avg(l_discount) FILTER "
          "(WHERE l_linestatus = 'O') AS O FROM lineitem GROUP BY 1", dbl=["F", "O"])
def pivot_metrics(spark, sf):
    """Rows x columns pivot of a metric (groupBy.pivot with the level list given, no extra pass)."""
    return li(spark, sf).groupBy("l_returnflag").pivot("l_linestatus", ["F", "O"]).agg(F.avg("l_discount"))


@register("best_variant",
          "SELECT arg_max(l_returnflag, (m, l_returnflag)) AS best, max(m) AS best_score FROM (SELECT l_returnflag, "
          "avg(l_quantity) AS m FROM lineitem GROUP BY 1) g", dbl=["best_score"])
def best_variant(spark, sf):
    """K3: the best row of a results table (max_by, no sort)."""
    g = li(spark, sf).groupBy("l_returnflag").agg(F.avg("l_quantity").alias("m"))
    return g.agg(F.max_by("l_returnflag", F.struct("m", "l_returnflag")).alias("best"), F.max("m").alias("best_score"))


@register("topk",
          "SELECT o_custkey, sum(o_totalprice) AS total FROM orders GROUP BY 1 ORDER BY total DESC, o_custkey LIMIT 10",
          dbl=["total"])
def topk(spark, sf):
    """K2: top-10 customers by order value (TakeOrderedAndProject: per-task top-k, then merge)."""
    return (table(spark, sf, "orders").groupBy("o_custkey").agg(F.sum("o_totalprice").alias("total"))
            .orderBy(F.col("total").desc(), "o_custkey").limit(10))


# ------------------------------------------------------------ Spark ML (rows-only)
_ML_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
_ML_CAT = ["l_linestatus"]


@register("tree_importance", rows_only=True)
def tree_importance(spark, sf):
    """M2: three classes (forest), mean gain over five folds."""
    return M.tree_importance(li(spark, sf), _ML_NUM, _ML_CAT, "l_returnflag")


@register("boosted_importance", rows_only=True)
def boosted_importance(spark, sf):
    """M2: two classes (boosted trees), mean gain over five folds."""
    return M.tree_importance(li(spark, sf).where("l_returnflag <> 'N'"), _ML_NUM, _ML_CAT, "l_returnflag", boosting_steps=150)


@register("quick_model_regression", rows_only=True)
def quick_model_regression(spark, sf):
    """M6: R2 of a numeric target over five folds."""
    return M.quick_model(li(spark, sf), ["l_quantity", "l_discount", "l_tax"], _ML_CAT, "l_extendedprice", regression=True)


@register("importance_prune", rows_only=True)
def importance_prune(spark, sf):
    return M.importance_prune(li(spark, sf), _ML_NUM, _ML_CAT, "l_returnflag")


@register("null_importance", rows_only=True)
def null_importance(spark, sf):
    return M.null_importance(li(spark, sf), _ML_NUM, _ML_CAT, "l_returnflag",
                             key_cols=["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"], num_trees=100)


@register("adversarial_auc", rows_only=True)
def adversarial_auc(spark, sf):
    from tabscope.registry.base import li_test_drift
    return M.adversarial_auc(li_train(spark, sf), li_test_drift(spark, sf), _ML_NUM, _ML_CAT)


@register("quick_model", rows_only=True)
def quick_model(spark, sf):
    return M.quick_model(li(spark, sf).select(*_ML_NUM, *_ML_CAT, "l_returnflag", "l_orderkey", "l_linenumber"),
                         _ML_NUM, _ML_CAT, "l_returnflag")


@register("permutation_importance", rows_only=True)
def permutation_importance(spark, sf):
    t = li(spark, sf).select("l_orderkey", "l_linenumber", "l_partkey", *_ML_NUM, *_ML_CAT, "l_returnflag")
    return M.permutation_importance(t, _ML_NUM, _ML_CAT, "l_returnflag")


@register("pca_variance", rows_only=True)
def pca_variance(spark, sf):
    return M.pca_variance(li(spark, sf), _ML_NUM)


_LOF_FEATURES = ["c_nationkey", "c_acctbal"]


@register("lof",
          "WITH p AS (SELECT c_custkey AS k, c_nationkey::DOUBLE AS x, c_acctbal::DOUBLE AS y FROM customer), "
          "d AS (SELECT a.k AS a, b.k AS b, sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) AS d "
          "FROM p a JOIN p b ON a.k <> b.k), r AS (SELECT *, row_number() OVER (PARTITION BY a ORDER BY d) AS r, "
          "count(*) OVER (PARTITION BY a) AS n FROM d), "
          "kd AS (SELECT a, max(CASE WHEN r <= 20 THEN d END) AS kd FROM r GROUP BY a), "
          "n AS (SELECT d.a, d.b, d.d, kd.kd FROM d JOIN kd USING (a) WHERE d.d <= kd.kd), "
          "l AS (SELECT n.a, 1 / (avg(greatest(kd.kd, n.d)) + 1e-10) AS l FROM n JOIN kd ON kd.a = n.b GROUP BY n.a), "
          "f AS (SELECT n.a, avg(o.l) / max(s.l) AS lof, max(n.kd) AS k_distance FROM n JOIN l o ON o.a = n.b JOIN l s ON s.a = n.a "
          "GROUP BY n.a) SELECT a AS c_custkey, k_distance, lof, CAST(lof > (SELECT quantile_cont(lof, 0.95) FROM f) AS INTEGER) "
          "AS outlier FROM f", dbl=["k_distance", "lof"])
def lof(spark, sf):
    """Local Outlier Factor of the customers by nation and balance."""
    from tabscope.operators.neighbours import local_outlier_factor
    return local_outlier_factor(table(spark, sf, "customer"), _LOF_FEATURES, ["c_custkey"])


_MI_KNN = ["c_acctbal", "c_nationkey"]
_MI_KNN_CLASS = "CASE WHEN c_acctbal > 3000 + 200 * c_nationkey THEN 'rich' ELSE c_mktsegment END"


def _mi_knn_sql():
    rows = " UNION ALL ".join(f"SELECT '{f}' AS feature, {_MI_KNN_CLASS} AS y, {f}::DOUBLE AS x FROM customer" for f in _MI_KNN)
    return (f"WITH t AS (SELECT *, row_number() OVER () AS id, count(*) OVER (PARTITION BY feature, y) AS nc FROM ({rows}) q), "
            "d AS (SELECT a.id, abs(a.x - b.x) AS d, row_number() OVER (PARTITION BY a.id ORDER BY abs(a.x - b.x)) AS r, a.nc "
            "FROM t a JOIN t b ON a.feature = b.feature AND a.y = b.y AND a.id <> b.id), "
            "r AS (SELECT id, max(d) AS r FROM d WHERE r <= least(3, nc - 1) GROUP BY id), "
            "q AS (SELECT t.*, r, r <= (abs(x) + r) * pow(2.0, -50) AS tie, (abs(x) + r) * pow(2.0, -50) AS blur FROM t JOIN r USING (id)), "
            "m AS (SELECT a.id, count(*) AS m, count(*) FILTER (b.y = a.y) AS own FROM q a JOIN q b ON a.feature = b.feature AND "
            "(b.x = a.x OR (NOT a.tie AND b.x >= a.x - a.r + a.blur AND b.x <= a.x + a.r - a.blur)) GROUP BY a.id), "
            "n AS (SELECT count(*) AS most FROM customer), "
            "psi AS (SELECT 1 + i AS n, -0.57721566490153286061 + sum(CASE WHEN i > 0 THEN 1.0 / i ELSE 0 END) OVER (ORDER BY i) AS psi "
            "FROM (SELECT unnest(range(0, (SELECT most FROM n) + 1))::DOUBLE AS i)), "
            "v AS (SELECT feature, p1.psi - p2.psi - p3.psi AS s FROM q JOIN m USING (id) "
            "JOIN psi p1 ON p1.n = CASE WHEN tie THEN own ELSE least(3, nc - 1) END JOIN psi p2 ON p2.n = nc JOIN psi p3 ON p3.n = m), "
            "f AS (SELECT feature, greatest(0.0, avg(s) + (SELECT psi FROM psi WHERE psi.n = (SELECT count(*) FROM v w WHERE w.feature = "
            "v.feature))) AS mi FROM v GROUP BY feature) "
            "SELECT feature, mi, row_number() OVER (ORDER BY mi DESC, feature) AS rank FROM f")


@register("mi_knn", _mi_knn_sql(), dbl=["mi"])
def mi_knn(spark, sf):
    """Nearest-neighbour mutual information of the customers' numbers with a class that depends on them."""
    from tabscope.operators.neighbours import mi_knn as run
    return run(table(spark, sf, "customer"), _MI_KNN, F.expr(_MI_KNN_CLASS))


@register("isolation_forest", rows_only=True)
def isolation_forest(spark, sf):
    return M.isolation_forest(li(spark, sf), _ML_NUM, ["l_orderkey", "l_linenumber"])


# ------------------------------------------------------------ advice
_PCATS = ["p_brand", "p_type", "p_size", "p_name"]


@register("encoding_advice", union_all([
    f"SELECT '{c}' AS feature, count(DISTINCT {c})::BIGINT AS n_unique, CASE WHEN count(DISTINCT {c}) > 50 THEN "
    f"'target/label encoding or reduce cardinality' WHEN count(DISTINCT {c}) <= 5 THEN 'one-hot' ELSE 'label/target encoding' "
    f"END AS encoding FROM part" for c in _PCATS]))
def encoding_advice(spark, sf):
    return D.encoding_advice(table(spark, sf, "part"), _PCATS)


def _g1(c, src):
    return f"(avg(power({c} - (SELECT avg({c}) FROM {src} s), 3)) / power(var_pop({c}), 1.5))"


_FE_NUM = ["c_acctbal", "c_nationkey", "big_bal", "seg_code"]
_FE_SRC = ("(SELECT c_acctbal, c_nationkey, c_acctbal * 2 + 1 AS big_bal, CAST(CASE c_mktsegment WHEN 'BUILDING' THEN 1 "
           "ELSE 0 END AS INTEGER) AS seg_code, c_mktsegment, c_name AS c_name_dt FROM customer)")


def _fe_src(spark, sf):
    c = table(spark, sf, "customer")
    return c.select("c_acctbal", "c_nationkey", (F.col("c_acctbal") * 2 + 1).alias("big_bal"),
                    F.when(F.col("c_mktsegment") == "BUILDING", 1).otherwise(0).cast("int").alias("seg_code"),
                    "c_mktsegment", F.col("c_name").alias("c_name_dt"))


def _fe_advice_sql():
    parts = []
    for c in _FE_NUM:
        parts.append(f"SELECT '{c}' AS feature, 'few levels: treat as a category' AS suggestion, count(DISTINCT {c})::DOUBLE AS value "
                     f"FROM {_FE_SRC} t HAVING count(DISTINCT {c}) < 5")
        parts.append(f"SELECT '{c}', 'skewed: take a log or a power', {_g1(c, _FE_SRC)} FROM {_FE_SRC} t HAVING count({c}) > 3 "
                     f"AND abs({_g1(c, _FE_SRC)}) > 2")
        parts.append(f"SELECT '{c}', 'heavy tails: clip the extremes', kurtosis_pop({c}) FROM {_FE_SRC} t HAVING count({c}) > 3 AND "
                     f"kurtosis_pop({c}) > 7")
    for c in ["c_mktsegment", "c_name_dt"]:
        parts.append(f"SELECT '{c}', 'many levels: merge the rare ones', count(DISTINCT {c})::DOUBLE FROM {_FE_SRC} t "
                     f"HAVING count(DISTINCT {c}) > 100")
    parts.append("SELECT 'c_name_dt', 'reads as a date: split into its parts', NULL::DOUBLE")
    for i, a in enumerate(_FE_NUM):
        for b in _FE_NUM[i + 1:]:
            parts.append(f"SELECT '{a} & {b}', 'correlated pair: keep one or use their ratio', corr({a}, {b}) FROM {_FE_SRC} t "
                         f"HAVING abs(corr({a}, {b})) > 0.95")
    return union_all(parts)


@register("fe_advice", _fe_advice_sql(), dbl=["value"])
def fe_advice(spark, sf):
    """D2 on customer (+ a derived copy of the balance and a low-cardinality code)."""
    return D.fe_advice(_fe_src(spark, sf), _FE_NUM, ["c_mktsegment", "c_name_dt"])


_TODO_SQL = ("(SELECT *, CASE WHEN l_linenumber >= 4 THEN NULL ELSE l_linenumber END AS line, exp(l_linenumber * 2.0) AS grown, "
             f"CAST(l_orderkey AS VARCHAR) AS order_code FROM {LI_NULLS_SQL} y)")
_TODO_NUM, _TODO_CAT = ["l_quantity", "l_discount", "l_tax", "l_extendedprice", "line", "grown"], ["l_returnflag", "order_code"]


def _todo_sql():
    src = _TODO_SQL
    parts = []
    for c in _TODO_NUM + _TODO_CAT:
        parts.append(f"SELECT '{c}' AS feature, 'high missing share' AS item, 1 - count({c})::DOUBLE / count(*) AS value "
                     f"FROM {src} t HAVING 1 - count({c})::DOUBLE / count(*) > 0.2")
    for c in _TODO_NUM:
        n = f"count({c})::DOUBLE"
        g = f"({_g1(c, src)} * sqrt({n} * ({n} - 1)) / ({n} - 2))"
        parts.append(f"SELECT '{c}', 'few unique values', count(DISTINCT {c})::DOUBLE FROM {src} t HAVING count(DISTINCT {c}) < 5")
        parts.append(f"SELECT '{c}', 'high skew', {g} FROM {src} t HAVING count(DISTINCT {c}) >= 5 AND abs({g}) > 1.5")
    for c in _TODO_CAT:
        parts.append(f"SELECT '{c}', 'too many categories', count(DISTINCT {c})::DOUBLE FROM {src} t HAVING count(DISTINCT {c}) > 200")
    return union_all(parts)


@register("todo_basic", _todo_sql(), dbl=["value"])
def todo_basic(spark, sf):
    t = li_nulls(spark, sf).withColumn("line", F.when(F.col("l_linenumber") < 4, F.col("l_linenumber"))).withColumn(
        "grown", F.exp(F.col("l_linenumber") * 2.0)).withColumn("order_code", F.col("l_orderkey").cast("string"))
    return D.todo_basic(t, _TODO_NUM, _TODO_CAT)


def _quality_sql(zero_fill=False, missing_cap=25.0):
    src = f"(SELECT * FROM {LI_NULLS_SQL} x)"
    cols = ["l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus"]
    nums = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    miss = " + ".join(f"count(*) FILTER (WHERE {c} IS NULL)" for c in cols)
    comp = f"(SELECT {', '.join(nums)} FROM {src} c WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in nums) + ")"
    if zero_fill:
        comp = "(SELECT " + ", ".join(f"coalesce({c}, 0.0) AS {c}" for c in nums) + f" FROM {src} c)"
    st = ", ".join(f"avg({c}) AS a_{c}, stddev_pop({c}) AS s_{c}" for c in nums)
    zc = " + ".join(f"count(*) FILTER (WHERE abs(({c} - a_{c}) / nullif(s_{c}, 0)) > 3)" for c in nums)
    return (f"WITH m AS (SELECT ({miss})::DOUBLE / (count(*) * {len(cols)}) * 100.0 AS missing_pct, count(*) AS n FROM {src} s), "
            f"d AS (SELECT sum(k) - count(*) AS dups FROM (SELECT {', '.join(cols)}, count(*) AS k FROM {src} s GROUP BY ALL) g), "
            f"z AS (SELECT count(*) AS rows, ({zc}) AS zcells FROM {comp} c, (SELECT {st} FROM {comp} c2) st), "
            f"h AS (SELECT ((count(DISTINCT l_returnflag) > 0.5 * count(*))::INTEGER + (count(DISTINCT l_linestatus) > 0.5 * count(*))::INTEGER) "
            f"AS n_idlike FROM {src} s) "
            f"SELECT missing_pct, dups::DOUBLE / n * 100.0 AS duplicate_pct, coalesce(zcells * 100.0 / (rows * {float(len(nums))}), 0.0) "
            f"AS outlier_cell_pct, n_idlike::BIGINT AS n_idlike, greatest(100.0 - least({missing_cap}, missing_pct) - least(10.0, dups::DOUBLE / n * 100.0) "
            f"- least(15.0, coalesce(zcells * 100.0 / (rows * {float(len(nums))}), 0.0)) - least(10.0, n_idlike * 5.0), 0.0) AS score "
            f"FROM m, d, z, h")


@register("quality_score", _quality_sql(), dbl=["missing_pct", "duplicate_pct", "outlier_cell_pct", "score"])
def quality_score(spark, sf):
    return D.quality_score(li_nulls(spark, sf), ["l_quantity", "l_extendedprice", "l_discount", "l_tax"],
                           ["l_returnflag", "l_linestatus"])


@register("quality_score_filled", _quality_sql(True, 20.0), dbl=["missing_pct", "duplicate_pct", "outlier_cell_pct", "score"])
def quality_score_filled(spark, sf):
    """A42, third formula: nulls count as 0 in the z-scores, missing cells cost 20 at most."""
    return D.quality_score(li_nulls(spark, sf), ["l_quantity", "l_extendedprice", "l_discount", "l_tax"],
                           ["l_returnflag", "l_linestatus"], zero_fill=True, missing_cap=20.0)


FA_CAT = ["l_linestatus", "l_linenumber"]


def _feature_actions_sql():
    parts = []
    for c in FA_CAT + LI_NUM:
        num = c in LI_NUM
        fence = (f"(SELECT quantile_cont({c}::DOUBLE, 0.25) AS q1, quantile_cont({c}::DOUBLE, 0.75) AS q3 FROM {LI_NULLS_SQL} f)"
                 if num else "(SELECT 0 AS q1, 0 AS q3)")
        out = f"count(*) FILTER (WHERE {c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1))" if num else "0"
        parts.append(f"SELECT '{c}' AS feature, '{'NUM' if num else 'CAT'}' AS type, count(DISTINCT {c}) + max(CAST({c} IS NULL AS INTEGER)) "
                     f"AS nu, count(*) AS n, count({c}) AS nn, {f'skewness({c})' if num else 'NULL'} AS sk, {out} AS nout "
                     f"FROM {LI_NULLS_SQL} s, {fence} q")
    mi = mi_sql(f"(SELECT *, CAST(l_returnflag AS VARCHAR) AS y FROM {LI_NULLS_SQL} x)", LI_NUM, FA_CAT, "y")
    steps = ("concat_ws(' + ', CASE WHEN abs(sk) > 2 THEN 'TRANSFORM' END, CASE WHEN nout::DOUBLE / n > 0.05 THEN 'CLIP' END, "
             "CASE WHEN nn < n THEN 'IMPUTE' END, CASE WHEN coalesce(mi, 0) < 0.005 THEN 'TRY_DROP' END)")
    return (f"SELECT feature, type, CASE WHEN nu <= 1 THEN 'DROP' WHEN type = 'CAT' AND nu > 100 THEN 'TARGET/FREQ ENCODE' "
            f"WHEN type = 'CAT' AND nu <= 5 THEN 'ONEHOT' WHEN type = 'CAT' THEN 'TARGET ENCODE' WHEN {steps} = '' THEN 'KEEP' "
            f"ELSE {steps} END AS action, CASE WHEN nu <= 1 OR (type = 'CAT' AND nu > 100) THEN 'HIGH' WHEN type = 'CAT' THEN 'MED' "
            f"WHEN coalesce(mi, 0) > 0.1 THEN 'HIGH' WHEN coalesce(mi, 0) < 0.005 THEN 'LOW' ELSE 'MED' END AS priority, mi "
            f"FROM ({union_all(parts)}) st LEFT JOIN (SELECT feature, mi FROM ({mi}) m) USING (feature)")


@register("feature_actions", _feature_actions_sql(), dbl=["mi"])
def feature_actions(spark, sf):
    """Per-feature action / priority table (MI from the binned estimator)."""
    return D.feature_actions(li_nulls(spark, sf), LI_NUM, FA_CAT, F.col("l_returnflag"))


def _pruning_sql():
    mi = mi_sql(f"(SELECT *, CAST(l_returnflag AS VARCHAR) AS y FROM {NET_SQL} x)", NETC, [], "y")
    nzv = f"SELECT feature FROM ({top_sql(vc_sql(NET_SQL, NETC))}) t WHERE top_n::DOUBLE / n > 0.95 OR n_unique::DOUBLE / n < 0.01"
    tied = union_all([f"SELECT '{a}' AS a, '{b}' AS b, corr({a}, {b}) AS r FROM {NET_SQL} c" for a, b in pairs(NETC)])
    return (f"WITH mi AS (SELECT feature, mi FROM ({mi}) m), u AS ("
            f"SELECT feature, 1 AS priority, 'near-zero variance' AS reason FROM ({nzv}) z "
            f"UNION ALL SELECT feature, 2, 'VIF > 10' FROM ({vif_sql(NET_SQL, NETC)}) v WHERE vif > 10 "
            f"UNION ALL SELECT CASE WHEN x.mi >= y.mi THEN b ELSE a END, 3, '|r| > .95, lower MI' FROM ({tied}) t "
            f"JOIN mi x ON x.feature = a JOIN mi y ON y.feature = b WHERE abs(r) > 0.95 "
            f"UNION ALL SELECT feature, 4, 'MI < .01' FROM mi WHERE mi < 0.01) "
            f"SELECT feature, arg_min(reason, priority) AS reason, min(priority) AS priority FROM u GROUP BY feature")


@register("pruning_advice", _pruning_sql())
def pruning_advice(spark, sf):
    """D3: columns to drop, with the first reason that holds."""
    return D.pruning_advice(li_net(spark, sf), NETC, F.col("l_returnflag"))


QS_COLS = ["l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus"]
QS_SRC = (f"(SELECT {', '.join(QS_COLS)} FROM {LI_NULLS_SQL} a UNION ALL SELECT {', '.join(QS_COLS)} FROM {LI_NULLS_SQL} b "
           f"WHERE l_linenumber = 1 AND l_orderkey % 100 = 0)")
ES_NUM = [*LI_NUM, "last_line"]
ES_SRC = f"(SELECT *, CASE WHEN l_linenumber = 7 THEN 1 ELSE 0 END AS last_line FROM {QS_SRC} q)"
ES_COLS = [*QS_COLS, "last_line"]


def _summary_sql():
    miss = " + ".join(f"count(*) FILTER (WHERE {c} IS NULL)" for c in ES_COLS)
    nothing = "NULL::VARCHAR"
    parts = [f"SELECT 'rows' AS code, {nothing} AS feature, count(*)::DOUBLE AS value, {nothing} AS level FROM src",
             *[f"SELECT '{k}', {nothing}, {n}::DOUBLE, {nothing}" for k, n in
               (("columns", len(ES_COLS)), ("numeric_features", len(ES_NUM)), ("categorical_features", 2))],
             f"SELECT 'missing_share', {nothing}, v, CASE WHEN v > 0.2 THEN 'high' WHEN v > 0.05 THEN 'moderate' ELSE 'low' END "
             f"FROM (SELECT ({miss})::DOUBLE / (count(*) * {len(ES_COLS)}) AS v FROM src)",
             f"SELECT 'duplicate_share', {nothing}, v, CASE WHEN v > 0.01 THEN 'high' ELSE 'low' END FROM (SELECT "
             f"(sum(k) - count(*))::DOUBLE / sum(k) AS v FROM (SELECT count(*) AS k FROM src GROUP BY {', '.join(ES_COLS)}))",
             "SELECT 'majority_share', 'l_returnflag', v, CASE WHEN v > 0.9 THEN 'severe' WHEN v > 0.7 THEN 'moderate' ELSE "
             "'balanced' END FROM (SELECT max(k)::DOUBLE / sum(k) AS v FROM (SELECT count(*) AS k FROM src GROUP BY l_returnflag))"]
    for c in ES_NUM:
        parts.append(f"SELECT 'skew', '{c}', g, 'high' FROM (SELECT avg(power({c} - m, 3)) / power(avg(power({c} - m, 2)), 1.5) AS g "
                     f"FROM (SELECT {c}::DOUBLE AS {c}, avg({c}::DOUBLE) OVER () AS m FROM src WHERE {c} IS NOT NULL) s) t WHERE abs(g) > 2")
    return f"WITH src AS (SELECT * FROM {ES_SRC} e) " + union_all(parts)


@register("executive_summary", _summary_sql(), dbl=["value"])
def executive_summary(spark, sf):
    """Headlines over lineitem with planted nulls, re-appended rows and a skewed flag."""
    t = li_nulls(spark, sf)
    t = t.unionByName(t.where((F.col("l_linenumber") == 1) & (F.pmod("l_orderkey", F.lit(100)) == 0)))
    t = t.withColumn("last_line", (F.col("l_linenumber") == 7).cast("int"))
    return D.executive_summary(t, ES_NUM, ["l_returnflag", "l_linestatus"], "l_returnflag")


ACT_NUM = ["o_totalprice", "o_custkey"]


def _actions_sql():
    y = f"(SELECT *, big AS y FROM {ORD_SENT_SQL} o)"
    iv = f"SELECT feature, sum(iv_part) AS iv FROM ({woe_sql(y, ACT_NUM, CP_COLS)}) w GROUP BY feature"
    ties = union_all([
        f"SELECT '{c}' AS child, p AS parent FROM (SELECT CAST({c} AS VARCHAR) AS v, min(CAST({p} AS VARCHAR)) AS p, count(DISTINCT {p}) "
        f"AS k FROM {ORD_SENT_SQL} o GROUP BY 1) a WHERE k = 1 AND regexp_matches(v, '^No .+') AND NOT EXISTS (SELECT 1 FROM "
        f"{ORD_SENT_SQL} b WHERE CAST(b.{p} AS VARCHAR) = a.p AND CAST(b.{c} AS VARCHAR) <> a.v)"
        for c in CP_COLS for p in CP_COLS if c != p])
    v = "sqrt(chi2 / (n * greatest(least(k_a, k_b) - 1, 1)))"
    return union_all([
        f"SELECT CASE WHEN iv < 0.02 THEN 5 ELSE 1 END AS priority, CASE WHEN iv < 0.02 THEN 'drop_feature' ELSE 'check_leak' END AS action, "
        f"feature AS subject, iv AS value FROM ({iv}) i WHERE iv < 0.02 OR iv >= 0.5",
        f"SELECT 2, 'weigh_classes', 'big', s FROM (SELECT max(k)::DOUBLE / sum(k) AS s FROM (SELECT count(*) AS k FROM {ORD_SENT_SQL} o "
        f"GROUP BY big) g) h WHERE s > 0.6",
        f"SELECT 3, 'recode_sentinel', child, count(*)::DOUBLE FROM ({ties}) t GROUP BY child",
        f"SELECT 4, 'keep_one', a_name || ' & ' || b_name, {v} FROM ({chi_sql(ORD_SENT_SQL, pairs(CP_COLS))}) c WHERE {v} > 0.8"])


@register("action_items", _actions_sql(), dbl=["value"])
def action_items(spark, sf):
    """Next steps for orders with a sentinel column and a target that follows from the price."""
    return D.action_items(ord_sent(spark, sf), ACT_NUM, CP_COLS, "big", F.col("big"))


@register("final_summary", union_all([
    f"SELECT '{line}' AS line" for line in ("problem: multiclass", "features: 6", "categorical: l_returnflag, l_linestatus",
                                            f"numeric: {', '.join(LI_NUM)}")] + [
    "SELECT 'rows: ' || count(*) FROM lineitem",
    "SELECT 'class ' || coalesce(CAST(l_returnflag AS VARCHAR), '(null)') || ': ' || count(*) FROM lineitem GROUP BY l_returnflag"]))
def final_summary(spark, sf):
    """The closing lines of the report, written to the shared scratch folder as text and read back."""
    from tabscope.session import scratch_path
    path = scratch_path(spark, "summary")
    D.final_summary(li(spark, sf), LI_NUM, ["l_returnflag", "l_linestatus"], "l_returnflag", "multiclass").write.text(path)
    return spark.read.text(path).withColumnRenamed("value", "line")


@register("findings_text", rows_only=True)
def findings_text(spark, sf):
    """Findings as text lines written to the shared scratch folder and read back."""
    from tabscope.session import scratch_path
    f = D.findings(li_nulls(spark, sf), ["l_quantity", "l_extendedprice", "l_discount", "l_tax"],
                   ["l_returnflag", "l_linestatus"], target="l_returnflag")
    return D.findings_text(f, scratch_path(spark, "findings"))


@register("variant_benchmark", rows_only=True)
def variant_benchmark(spark, sf):
    """M8 -> A47 -> K3: fold scores pivoted to variant x model rows with metric columns, best row flagged."""
    from tabscope.operators import features as FE
    base = li(spark, sf).select("l_orderkey", "l_linenumber", *_ML_NUM, *_ML_CAT, "l_returnflag")
    arith = [("l_extendedprice", "l_quantity"), ("l_discount", "l_tax")]
    extra = [f"{a}_{op}_{b}" for a, b in arith for op in ("div", "minus", "plus", "times")]
    variants = {
        "raw": (lambda d: d, _ML_NUM, _ML_CAT),
        "arithmetic": (lambda d: FE.fe_arithmetic(d, arith), _ML_NUM + extra, _ML_CAT),
        "numeric_only": (lambda d: d, _ML_NUM, []),
        "row_stats": (lambda d: FE.fe_row_stats(d, _ML_NUM), _ML_NUM + ["row_mean", "row_std", "row_min", "row_max"],
                      _ML_CAT),
    }
    res = M.variant_benchmark(base, variants, "l_returnflag")
    piv = res.groupBy("variant", "model").pivot("metric", ["accuracy", "f1_macro"]).agg(F.avg("score"))
    best = piv.agg(F.max_by(F.struct("variant", "model"), F.col("f1_macro")).alias("b")).scalar()
    return piv.withColumn("best", ((F.col("variant") == best.getField("variant"))
                                   & (F.col("model") == best.getField("model"))).cast("int"))


def _qs_simple_sql(src, cols):
    miss = " + ".join(f"count(*) FILTER (WHERE {c} IS NULL)" for c in cols)
    return (f"WITH m AS (SELECT count(*) AS n, 100.0 * ({miss})::DOUBLE / (count(*) * {len(cols)}) AS missing_pct FROM {src} s), "
            f"d AS (SELECT 100.0 * (sum(k) - count(*))::DOUBLE / sum(k) AS duplicate_pct FROM (SELECT {', '.join(cols)}, count(*) AS k "
            f"FROM {src} s GROUP BY ALL) g) SELECT missing_pct, duplicate_pct, CAST(greatest(least(100 - CASE WHEN missing_pct > 10 "
            f"THEN 20 WHEN missing_pct > 5 THEN 10 ELSE 0 END - CASE WHEN duplicate_pct > 5 THEN 15 WHEN duplicate_pct > 1 THEN 5 "
            f"ELSE 0 END - CASE WHEN n < 100 THEN 20 ELSE 0 END, 100), 0) AS INTEGER) AS score FROM m, d")


@register("quality_score_simple", _qs_simple_sql(QS_SRC, QS_COLS), dbl=["missing_pct", "duplicate_pct"])
def quality_score_simple(spark, sf):
    """A42 band variant on lineitem with planted nulls and re-appended duplicate rows."""
    t = li_nulls(spark, sf)
    t = t.unionByName(t.where((F.col("l_linenumber") == 1) & (F.pmod("l_orderkey", F.lit(100)) == 0)))
    return D.quality_score_simple(t)


FIND_SRC = (f"(SELECT *, CASE WHEN o_orderpriority <> '1-URGENT' THEN o_custkey END AS gap, CAST(o_orderkey % 50 = 0 AS INTEGER) "
            f"AS fiftieth, 'orders' AS src, o_orderstatus AS next_status FROM {ORD_SENT_SQL} o)")


def _findings_sql():
    def row(section, feature, severity, code, metric, value, threshold, message, rest):
        return (f"SELECT '{section}' AS section, '{feature}' AS feature, {severity} AS severity, '{code}' AS code, '{metric}' AS metric, "
                f"{value} AS value, {threshold} AS threshold, {message} AS message FROM {rest}")
    parts = [row("missing", "gap", "CASE WHEN v > 30 THEN 'critical' WHEN v > 5 THEN 'warning' ELSE 'info' END", "MISSING", "pct_null", "v",
                 "5.0", "printf('gap: %.2f%% missing', v)",
                 "(SELECT 100.0 * count(*) FILTER (WHERE gap IS NULL)::DOUBLE / count(*) AS v FROM src) t WHERE v > 0"),
             row("quality", "src", "'critical'", "CONSTANT", "n_unique", "1.0", "1.0", "'src: constant column, drop'",
                 "(SELECT count(DISTINCT src) AS k FROM src) t WHERE k = 1"),
             row("target", "fiftieth", "'critical'", "IMBALANCE", "max_min_ratio", "v", "10.0", "printf('class imbalance ratio %.1f', v)",
                 "(SELECT max(k)::DOUBLE / min(k) AS v FROM (SELECT count(*) AS k FROM src GROUP BY fiftieth)) t WHERE v > 10"),
             row("leakage", "next_status", "'warning'", "NAME_HINT", "name", "NULL::DOUBLE", "NULL::DOUBLE",
                 "'next_status: name suggests information from the future'", "(SELECT 1) t")]
    for c in ("o_totalprice", "o_custkey", "fiftieth"):
        parts.append(row("distribution", c, "'warning'", "SKEW", "skew", "g", "1.0", f"printf('{c}: skew %.2f, consider a transform', g)",
                         f"(SELECT avg(power({c} - m, 3)) / power(avg(power({c} - m, 2)), 1.5) AS g FROM (SELECT {c}, avg({c}) OVER () "
                         f"AS m FROM src)) t WHERE abs(g) > 1"))
    return f"WITH src AS (SELECT * FROM {FIND_SRC} f) " + union_all(parts)


@register("findings", _findings_sql(), dbl=["value"])
def findings(spark, sf):
    """A48 findings table on orders with a sentinel, a column with gaps, a constant, a rare flag as target and a telling name."""
    t = ord_sent(spark, sf).withColumn("gap", F.when(F.col("o_orderpriority") != "1-URGENT", F.col("o_custkey"))).withColumn(
        "fiftieth", (F.pmod("o_orderkey", F.lit(50)) == 0).cast("int")).withColumn("src", F.lit("orders")).withColumn(
        "next_status", F.col("o_orderstatus"))
    return D.findings(t, ["o_totalprice", "o_custkey", "fiftieth"], ["o_orderstatus", "o_orderpriority", "sentinel", "src"],
                      target="fiftieth")
