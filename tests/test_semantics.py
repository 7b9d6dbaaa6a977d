"""Semantics on hand-made tables: golden vectors, metamorphic checks, edge cases."""

import math

import pytest
from pyspark.sql import functions as F

from tabscope.operators import association as A
from tabscope.operators import features as FE
from tabscope.operators import overlap as O
from tabscope.operators import profile as P
from tabscope.operators import series as S
from tabscope.plans import frames

# Published churn category counts and positive rates (%) for seven features,
# with the published information value and Cramer's V against the target.
CHURN = {
    "Contract": [("Month-to-month", 298918, 42.0543), ("One year", 108333, 5.7628), ("Two year", 186943, 0.9982)],
    "PaymentMethod": [("Bank transfer (automatic)", 121360, 7.7093), ("Credit card (automatic)", 133705, 6.9332),
                      ("Electronic check", 215372, 48.9052), ("Mailed check", 123757, 7.9697)],
    "InternetService": [("DSL", 181081, 10.3064), ("Fiber optic", 272386, 41.5366), ("No", 140727, 1.4311)],
    "Partner": [("No", 284640, 32.4621), ("Yes", 309554, 13.3796)],
    "SeniorCitizen": [("0", 526395, 18.9774), ("1", 67799, 50.0317)],
    "PhoneService": [("No", 36301, 16.8150), ("Yes", 557893, 22.8920)],
    "gender": [("Female", 298738, 22.8036), ("Male", 295456, 22.2348)],
}
GOLDEN_IV = {"Contract": 2.0927, "PaymentMethod": 1.3534, "InternetService": 1.5023, "Partner": 0.3098,
             "SeniorCitizen": 0.2614, "PhoneService": 0.0077, "gender": 0.0003}
GOLDEN_V = {"Contract": 0.4721, "PaymentMethod": 0.4763, "InternetService": 0.4259, "Partner": 0.2282,
            "SeniorCitizen": 0.2364, "PhoneService": 0.0348, "gender": 0.0068}


def _expand(spark, feature):
    rows = []
    for level, n, rate in CHURN[feature]:
        pos = round(n * rate / 100.0)
        rows += [(level, 1, pos), (level, 0, n - pos)]
    d = spark.createDataFrame(rows, "v string, y int, k int")
    return d.select(F.col("v").alias(feature), "y", F.explode(F.sequence(F.lit(1), F.col("k"))).alias("_i")).drop("_i")


@pytest.mark.parametrize("feature", sorted(CHURN))
def test_golden_iv_and_cramers_v(spark, feature):
    df = _expand(spark, feature)
    iv = A.information_value(df, [], [feature], F.col("y")).collect()[0]["iv"]
    assert iv == pytest.approx(GOLDEN_IV[feature], abs=6e-4)
    v = A.cramers_v(df.withColumn("y", F.col("y").cast("string")), [feature, "y"]).collect()[0]["cramers_v"]
    assert v == pytest.approx(GOLDEN_V[feature], abs=6e-4)


def test_chi2_yates_2x2(spark):
    # 2x2 table [[10, 20], [30, 40]]: Yates-corrected chi-square by hand
    rows = [("a", "x")] * 10 + [("a", "y")] * 20 + [("b", "x")] * 30 + [("b", "y")] * 40
    df = spark.createDataFrame(rows, "f string, t string")
    got = A.chi2_independence(df, ["f"], "t").collect()[0]
    obs = [[10, 20], [30, 40]]
    n = 100.0
    r = [30, 70]
    c = [40, 60]
    exp = sum((abs(obs[i][j] - r[i] * c[j] / n) - 0.5) ** 2 / (r[i] * c[j] / n) for i in range(2) for j in range(2))
    assert got["dof"] == 1
    assert got["chi2"] == pytest.approx(exp, rel=1e-9)


def test_chi2_3x2_no_correction(spark):
    rows = [("a", "x")] * 5 + [("a", "y")] * 15 + [("b", "x")] * 12 + [("b", "y")] * 8 + [("c", "y")] * 10
    df = spark.createDataFrame(rows, "f string, t string")
    got = A.chi2_independence(df, ["f"], "t").collect()[0]
    obs = {"a": (5, 15), "b": (12, 8), "c": (0, 10)}
    n = 50.0
    col_tot = (17, 33)
    exp = 0.0
    for k, (x, y) in obs.items():
        rt = x + y
        for o, ct in ((x, col_tot[0]), (y, col_tot[1])):
            e = rt * ct / n
            exp += (o - e) ** 2 / e
    assert got["dof"] == 2
    assert got["chi2"] == pytest.approx(exp, rel=1e-9)


def test_cramers_v_symmetric_and_self(spark):
    rows = [(str(i % 3), str(i % 4)) for i in range(200)]
    df = spark.createDataFrame(rows, "a string, b string")
    ab = A.cramers_v(df, ["a", "b"]).collect()[0]["cramers_v"]
    ba = A.cramers_v(df, ["b", "a"]).collect()[0]["cramers_v"]
    assert ab == pytest.approx(ba)
    same = A.cramers_v(df.withColumn("c", F.col("a")), ["a", "c"]).collect()[0]["cramers_v"]
    assert same == pytest.approx(1.0)


def test_psi_and_ks_identity(spark):
    df = spark.range(1000).select((F.col("id") % 97 * 1.5).alias("x"))
    assert A.psi_equal_width(df, df, ["x"]).collect()[0]["psi"] == pytest.approx(0.0, abs=1e-12)
    assert A.psi_quantile(df, df, ["x"]).collect()[0]["psi"] == pytest.approx(0.0, abs=1e-12)
    assert A.ks_2samp(df, df, ["x"]).collect()[0]["ks_stat"] == pytest.approx(0.0, abs=1e-12)


def test_ks_matches_definition(spark):
    a = [1.0, 2.0, 2.0, 3.0, 7.0]
    b = [2.0, 4.0, 5.0]
    da = spark.createDataFrame([(x,) for x in a], "x double")
    db = spark.createDataFrame([(x,) for x in b], "x double")
    vals = sorted(set(a + b))
    d = max(abs(sum(x <= v for x in a) / len(a) - sum(x <= v for x in b) / len(b)) for v in vals)
    assert A.ks_2samp(da, db, ["x"]).collect()[0]["ks_stat"] == pytest.approx(d)


def test_running_sum_many_partitions(spark):
    df = spark.range(0, 5000, numPartitions=7).select((F.col("id") * 7919 % 5000).alias("v"), F.lit(1).alias("w"),
                                                      (F.col("id") % 3).alias("g"))
    out = frames.running_sum(df, ["v"], "w", by=["g"], out="cum", total="tot").collect()
    by = {}
    for r in out:
        by.setdefault(r["g"], []).append((r["v"], r["cum"], r["tot"]))
    for g, lst in by.items():
        lst.sort()
        assert [c for _, c, _ in lst] == list(range(1, len(lst) + 1))
        assert all(t == len(lst) for _, _, t in lst)


def test_stratified_folds_exact_balance(spark):
    df = spark.range(0, 1003, numPartitions=5).select("id", (F.when(F.col("id") < 700, "big").otherwise("small")).alias("y"))
    out = S.stratified_folds(df, "y", k=5, order_cols=["id"])
    cnt = {(r["y"], r["fold"]): r["count"] for r in out.groupBy("y", "fold").count().collect()}
    for cls in ("big", "small"):
        vals = [cnt.get((cls, f), 0) for f in range(5)]
        assert max(vals) - min(vals) <= 1
    assert out.count() == 1003


def test_permute_column_is_permutation(spark):
    df = spark.range(0, 500, numPartitions=4).select("id", (F.col("id") % 13).alias("v"))
    p = frames.permute_column(df, "v", ["id"], seed=3)
    assert sorted(r["v"] for r in p.collect()) == sorted(r["v"] for r in df.collect())
    assert p.select("id").distinct().count() == 500


def test_average_ranks_ties(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (2.0,), (5.0,)], "x double")
    got = {r["x"]: r["x_rank"] for r in A.average_ranks(df, "x").collect()}
    assert got == {1.0: 1.0, 2.0: 2.5, 5.0: 4.0}


def test_qcut_bins_match_pandas_rule(spark):
    import pandas as pd
    vals = [1, 1, 1, 2, 3, 4, 5, 5, 9, 10, 10, 10]
    df = spark.createDataFrame([(float(v),) for v in vals], "x double")
    got = [r["x_qbin"] for r in FE.qcut_bins(df, ["x"], 4).orderBy("x").collect()]
    exp = pd.qcut(pd.Series(sorted(vals), dtype=float), 4, labels=False, duplicates="drop").tolist()
    assert got == exp


def test_dup_rows_nulls_equal(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "a")], "a int, b string")
    r = O.dup_rows(df).collect()[0]
    assert r["n_duplicates"] == 1 and r["n_rows"] == 3


def test_overlap_inner_multiplies(spark):
    tr = spark.createDataFrame([(1, None), (1, None), (2, "a")], "a int, b string")
    te = spark.createDataFrame([(1, None), (1, None), (1, None), (3, "z")], "a int, b string")
    assert O.overlap_rows_inner(tr, te, ["a", "b"]).collect()[0]["n_overlap_rows"] == 6
    assert O.overlap_rows_semi(tr, te, ["a", "b"]).collect()[0]["n_leaked_rows"] == 2


def test_constant_column_does_not_fail(spark):
    df = spark.range(20).select(F.lit(1.0).alias("c"), F.col("id").cast("double").alias("x"))
    r = A.corr_pairs(df, ["c", "x"]).collect()[0]
    assert r["corr"] is None
    assert P.summary_extended(df, ["c"]).collect()[0]["n"] == 20


def test_class_weights_sum_to_n(spark):
    df = spark.createDataFrame([(c,) for c in "aaaabbc"], "y string")
    w = {r["class"]: (r["n"], r["weight"]) for r in FE.class_weights(df, "y").collect()}
    assert sum(n * wt for n, wt in w.values()) == pytest.approx(7.0)


def test_benford_shares(spark):
    vals = [10 ** (i / 50.0) for i in range(500)]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    r = P.benford(df, ["x"]).collect()[0]
    assert r["share_1"] == pytest.approx(math.log10(2), abs=0.02)


def test_require_columns(spark):
    from tabscope.sources.io import require_columns
    df = spark.range(3)
    with pytest.raises(ValueError):
        require_columns(df, "target")


def _rounded_both(spark, vals):
    import duckdb
    from tabscope.functions.exprs import sig_round, sig_round_sql
    got = [r[0] for r in spark.createDataFrame([(v,) for v in vals], "x double").select(sig_round(F.col("x"))).collect()]
    con = duckdb.connect()
    exp = [con.execute(f"SELECT {sig_round_sql(repr(v) + '::DOUBLE')}").fetchone()[0] for v in vals]
    return got, exp


@pytest.mark.xfail(reason="known limitation: a double just below a decimal tie at the 8th significant digit "
                          "rounds differently in the two engines", strict=True)
def test_sig_round_tie_case(spark):
    got, exp = _rounded_both(spark, [1923010.0499999998])
    assert got == exp


def test_sig_round_identical_in_duckdb(spark):
    import duckdb
    from tabscope.functions.exprs import sig_round, sig_round_sql
    vals = [0.0, -1e-12, 1.23456789012, -98765.4321098, 3.5e14, 7.25e-5, 1 / 3, 2.0 / 7.0 * 1e6]
    got = [r[0] for r in spark.createDataFrame([(v,) for v in vals], "x double").select(sig_round(F.col("x"))).collect()]
    con = duckdb.connect()
    exp = [con.execute(f"SELECT {sig_round_sql(repr(v) + '::DOUBLE')}").fetchone()[0] for v in vals]
    assert got == exp


def test_null_importance_scoring_golden(spark):
    # Published actual importance, null 95th percentile and resulting safe score
    from tabscope.operators.models import null_importance_score
    t = spark.createDataFrame([("f", 0.305259, 0.02, 0.01, 0.060368, 0.07)],
                              "feature string, actual double, null_mean double, null_std double, null_p95 double, "
                              "null_p99 double")
    r = null_importance_score(t).collect()[0]
    assert r["safe_score"] == pytest.approx(5.0566, abs=1e-4)
    assert r["significant"] == 1


def test_executive_summary_bands_and_empty_table(spark):
    from tabscope.operators.advice import executive_summary
    rows = [(float(i == 0) * 100, "a" if i < 19 else None, "x" if i < 18 else "y") for i in range(20)]
    df = spark.createDataFrame(rows, "v double, c string, y string")
    got = {(r.code, r.feature): (r.value, r.level) for r in executive_summary(df, ["v"], ["c"], "y").collect()}
    assert got[("rows", None)] == (20.0, None) and got[("columns", None)] == (3.0, None)
    assert got[("missing_share", None)] == (pytest.approx(1 / 60), "low")
    assert got[("duplicate_share", None)] == (pytest.approx(16 / 20), "high")
    assert got[("majority_share", "y")] == (0.9, "moderate")
    assert got[("skew", "v")][0] == pytest.approx(0.9 / math.sqrt(0.05 * 0.95))
    many = df.withColumn("id", F.monotonically_increasing_id())
    assert not [r for r in executive_summary(many, [], [], "id").collect() if r.code == "majority_share"]
    empty = {r.code: (r.value, r.level) for r in executive_summary(df.limit(0), ["v"], ["c"], "y").collect()}
    assert empty == {"rows": (0.0, None), "columns": (3.0, None), "numeric_features": (1.0, None), "categorical_features": (1.0, None),
                     "missing_share": (0.0, "low"), "duplicate_share": (0.0, "low")}


def test_action_items_name_each_step(spark):
    from tabscope.operators.advice import action_items
    rows = [(i, "No line" if i % 4 == 0 else f"s{i % 3}", "off" if i % 4 == 0 else "on", "big" if i < 15 else "small",
             "B" if i < 15 else "S", int(i < 80)) for i in range(100)]
    df = spark.createDataFrame(rows, "n int, child string, parent string, a string, b string, y int")
    got = {(r.action, r.subject): r.value for r in action_items(df, [], ["child", "parent", "a", "b"], "y", F.col("y")).collect()}
    assert got[("weigh_classes", "y")] == 0.8 and got[("recode_sentinel", "child")] == 1.0
    assert ("keep_one", "a & b") in got and ("keep_one", "parent & a") not in got
    assert ("drop_feature", "parent") in got


def test_final_summary_counts_null_classes(spark):
    from tabscope.operators.advice import final_summary
    df = spark.createDataFrame([("p",), (None,), ("p",)], "y string")
    got = sorted(r.line for r in final_summary(df, ["n"], ["c"], "y", "binary").collect())
    assert got == sorted(["problem: binary", "features: 2", "categorical: c", "numeric: n", "rows: 3", "class p: 2", "class (null): 1"])
    assert len(final_summary(df, ["n"], ["c"], "y", "regression").collect()) == 5


def test_vif_of_constant_and_single_columns(spark):
    df = spark.createDataFrame([(float(i), float((i * 7) % 10), 3.0) for i in range(10)] + [(None, 1.0, 3.0)], "a double, b double, k double")
    got = {r.feature: (r.vif, r.risk) for r in A.vif(df, ["a", "b", "k"]).collect()}
    r = A.corr_pairs(df.na.drop(), ["a", "b"]).first()["corr"]
    assert got["k"] == (None, None)
    for f in "ab":
        assert got[f] == (pytest.approx(1 / (1 - r * r)), "low")
    assert [tuple(r) for r in A.vif(df, ["a"]).collect()] == [("a", 1.0, "low")]
