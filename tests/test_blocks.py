"""Running sums and positions must not depend on how Spark plans or repeats a stage."""

import math

import pytest
from pyspark.sql import functions as F

from tabscope.plans.frames import positions, running_sum

KEYS = ["describe_by_class", "roc_auc", "box_stats", "ks_2samp", "corr_spearman", "iqr_clip_flag"]


@pytest.fixture
def bare(spark):
    """No exchange reuse, no coalescing: every use of a plan is planned and run for itself."""
    conf = {"spark.sql.exchange.reuse": "false", "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.shuffle.partitions": "16"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("key", KEYS)
def test_keys_match_the_oracle_without_reuse(bare, key):
    import duckdb

    from __spark_entry__ import oracle_sql, queries
    from test_oracle import TABLES, _hash
    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    df = queries()[key](bare, sf)
    res = con.execute(oracle_sql()[key])
    cols = [d[0] for d in res.description]
    assert _hash([tuple(r) for r in df.collect()], df.columns) == _hash(res.fetchall(), cols)


def test_running_sum_with_null_group_nan_and_null_values(bare):
    rows = [(g, x, 1) for g in ("a", None) for x in [float(i * i % 97) for i in range(200)] + [None, math.nan]]
    df = bare.createDataFrame(rows, "g string, x double, k long").groupBy("g", "x").agg(F.sum("k").alias("k"))
    got = running_sum(df, ["x"], "k", by=["g"], out="cum", total="n").collect()
    for g in ("a", None):
        part = sorted([r for r in got if r.g == g], key=lambda r: (r.x is not None, r.x is not None and math.isnan(r.x), r.x or 0))
        total = 0
        for r in part:
            total += r.k
            assert r.cum == total
            assert r.n == 202
        assert len(part) == len({repr(r.x) for r in part})


def test_positions_keep_null_groups_and_equal_rows(bare):
    df = bare.createDataFrame([(None if i % 10 == 0 else "c", 7) for i in range(1000)], "g string, v int")
    got = positions(df, [F.col("v")], by=["g"], name="p").collect()
    assert sorted(r.p for r in got if r.g is None) == list(range(100))
    assert sorted(r.p for r in got if r.g == "c") == list(range(900))


CONST = ["histogram", "equal_width_bins", "scale", "cohens_d", "anova_f", "mean_drift", "psi", "mcar", "modes", "density", "ad", "fit"]


@pytest.mark.parametrize("rows", [[(5.0, None, "x")] * 20, [(0.0, None, "x"), (0.0, 1.0, "y")] * 10, []], ids=["constant", "zero", "empty"])
@pytest.mark.parametrize("name", CONST)
def test_constant_null_and_empty_columns(spark, rows, name):
    from tabscope.operators import association as a
    from tabscope.operators import distribution as d
    from tabscope.operators import features as f
    from tabscope.operators import series as s
    df = spark.createDataFrame(rows, "c double, m double, t string")
    run = {"histogram": lambda: s.histogram(df, ["c", "m"]), "equal_width_bins": lambda: f.equal_width_bins(df, ["c", "m"]),
           "scale": lambda: f.scale(df, df, ["c", "m"]), "cohens_d": lambda: a.cohens_d(df, ["c", "m"], "t"),
           "anova_f": lambda: a.anova_f(df, ["c", "m"], "t"), "mean_drift": lambda: a.mean_drift(df, df, ["c", "m"]),
           "psi": lambda: a.psi_equal_width(df, df, ["c", "m"]), "mcar": lambda: a.mcar_test(df, ["c"], ["m"]),
           "modes": lambda: d.modes(df, ["c"]), "density": lambda: s.density_overlay(df, df, "c"),
           "ad": lambda: d.normality_ad(df, ["c"]), "fit": lambda: d.distribution_fit(df, ["c"])}[name]
    got = run().collect()
    if name == "histogram":
        assert sum(r.n for r in got if r.feature == "c") == len(rows)
    if name == "equal_width_bins":
        assert [r.c_bin for r in got] == [0] * len(rows)


def test_spearman_ranks_the_complete_rows_of_a_pair(spark):
    from tabscope.operators.association import corr_spearman
    rows = [(float(i), float(i * i) if i % 3 else None, float(-i)) for i in range(30)]
    got = {(r.feature_a, r.feature_b): r.spearman for r in corr_spearman(spark.createDataFrame(rows, "a double, b double, c double"), ["a", "b", "c"]).collect()}
    assert abs(got["a", "b"] - 1) < 1e-12 and abs(got["a", "c"] + 1) < 1e-12 and abs(got["b", "c"] + 1) < 1e-12


def test_normal_cdf_array():
    import numpy as np

    from tabscope.functions.special import normal_cdf, normal_cdf_array
    x = np.linspace(-36, 36, 5001)
    want = np.array([normal_cdf(v) for v in x])
    assert np.max(np.abs(normal_cdf_array(x) / want - 1)) < 1e-9
    assert np.isnan(normal_cdf_array(np.array([np.nan]))).all()


def test_kendall_is_exact_beyond_two_hundred_levels(spark):
    import random

    from tabscope.operators.association import corr_kendall
    rng = random.Random(2)
    rows = []
    for i in range(700):
        x = float(rng.randrange(500)) if i % 3 else 7.0  # a third of the rows share a value
        rows.append((x, x * 0.5 + rng.randrange(300), float(rng.randrange(3)) if i % 50 else None))
    got = {(r.feature_a, r.feature_b): r.kendall_tau for r in corr_kendall(spark.createDataFrame(rows, "a double, b double, c double"), ["a", "b", "c"]).collect()}
    for (p, i), (q, j) in ((("a", 0), ("b", 1)), (("a", 0), ("c", 2)), (("b", 1), ("c", 2))):
        v = [(r[i], r[j]) for r in rows if r[i] is not None and r[j] is not None]
        s = tx = ty = 0
        for m in range(len(v)):
            for k in range(m):
                dx, dy = v[m][0] - v[k][0], v[m][1] - v[k][1]
                s += (dx * dy > 0) - (dx * dy < 0)
                tx += dx == 0
                ty += dy == 0
        n0 = len(v) * (len(v) - 1) / 2
        assert abs(got[p, q] - s / ((n0 - tx) * (n0 - ty)) ** 0.5) < 1e-9


def test_p_values_against_known_ones(spark):
    """Golden values: published chi-square and F tables, the KS limit distribution."""
    from tabscope.functions.special import chi2_sf, f_sf, kolmogorov_sf
    from tabscope.operators import association as a
    assert abs(chi2_sf(3.841459, 1) - 0.05) < 1e-6 and abs(chi2_sf(18.307038, 10) - 0.05) < 1e-6
    assert abs(f_sf(4.964603, 1, 10) - 0.05) < 1e-6 and abs(f_sf(3.098391, 3, 20) - 0.05) < 1e-6
    assert abs(kolmogorov_sf(1.3581 / (1e8 / 2) ** 0.5, 1e8, 1e8) - 0.05) < 1e-4
    rows = [("a" if i % 2 else "b", "x" if i % 2 or i % 6 == 0 else "y", float(i % 2) * 5 + i % 7, 1.0) for i in range(120)]
    df = spark.createDataFrame(rows, "t string, c string, v double, k double")
    chi = a.chi2_pvalues(df, ["c"], "t").first()
    assert chi.p_value < 1e-6 and chi.independence == "reject" and abs(chi.p_value - chi2_sf(chi.chi2, chi.dof)) < 1e-12
    got = {r.feature: r for r in a.anova_pvalues(df, ["v", "k"], "t").collect()}
    assert got["v"].equal_means == "reject" and got["k"].p_value is None
    same, other = df, df.withColumn("v", df.v + 3)
    assert a.ks_pvalues(same, same, ["v"]).first().p_value == 1.0
    assert a.ks_pvalues(same, other, ["v"]).first().same_distribution == "reject"
    miss = df.selectExpr("if(t = 'a' and v > 6, null, k) as m", "v")
    assert a.mcar_summary(miss, ["v"], ["m"]).first().mcar == "reject"


def test_pacf_of_a_first_order_process(spark):
    import datetime
    import random

    from tabscope.operators.series import acf, pacf
    rng, y, rows = random.Random(1), 0.0, []
    for i in range(900):
        y = 0.7 * y + rng.gauss(0, 1)
        rows.append((datetime.date(2020, 1, 1) + datetime.timedelta(days=i), y))
    s = spark.createDataFrame(rows, "day date, y double")
    got = {r.lag: r.pacf for r in pacf(s, 5).collect()}
    r = {x.lag: x.acf for x in acf(s, 2).collect()}
    assert abs(got[1] - r[1]) < 1e-12 and abs(got[1] - 0.7) < 0.1
    assert abs(got[2] - (r[2] - r[1] ** 2) / (1 - r[1] ** 2)) < 1e-9 and all(abs(got[k]) < 0.12 for k in (2, 3, 4, 5))


def test_rows_only_statistics_are_sound(spark):
    """Values, not only row counts, of keys without SQL."""
    from __spark_entry__ import queries
    q, sf = queries(), "/root/testdata/sf0.001"
    for k in ("chi2_pvalues", "anova_pvalues", "ks_pvalues", "mcar_summary"):
        got = q[k](spark, sf).collect()
        assert got and all(r.p_value is None or 0 <= r.p_value <= 1 for r in got), k
    auc = q["adversarial_auc"](spark, sf).first().auc
    assert 0.4 < auc <= 1.0
    top = q["tree_importance"](spark, sf).collect()
    assert abs(sum(r.importance for r in top) - 1) < 1e-6
    forest = q["isolation_forest"](spark, sf).collect()
    share = sum(r.outlier for r in forest) / len(forest)
    assert all(0 < r.score < 1 for r in forest) and 0.04 < share < 0.07
