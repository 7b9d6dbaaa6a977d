"""Registry plumbing and the shared fixtures (defined identically in Spark and SQL)."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabscope.functions.exprs import round_doubles, sig_round_sql

REGISTRY: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def register(key: str, sql: str | None = None, dbl: Sequence[str] = (), rows_only: bool = False, digits: int = 8):
    """Register ``fn(spark, sf)``.  ``dbl`` lists the floating output columns the
    oracle rounds (Spark rounds every floating column automatically)."""
    def deco(fn):
        if key in REGISTRY:
            raise KeyError(f"duplicate key {key}")

        def run(spark: SparkSession, sf: str) -> DataFrame:
            return round_doubles(fn(spark, sf.rstrip("/")), digits)
        run.__name__ = f"q_{key}"
        run.__doc__ = fn.__doc__
        REGISTRY[key] = (run, None if rows_only or sql is None else wrap_sql(sql, dbl, digits))
        return fn
    return deco


def wrap_sql(sql: str, dbl: Sequence[str], digits: int = 8) -> str:
    if not dbl:
        return sql
    rep = ", ".join(f"{sig_round_sql(d, digits)} AS {d}" for d in dbl)
    return f"SELECT * REPLACE ({rep}) FROM ({sql}) _q"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def union_all(parts: Sequence[str]) -> str:
    return "\nUNION ALL\n".join(f"({p})" for p in parts)


# ------------------------------------------------------------------ fixtures
LI_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
LI_CAT = ["l_returnflag", "l_linestatus"]
LI_TARGET = "l_returnflag"


def li(spark, sf):
    return table(spark, sf, "lineitem")


def li_nulls(spark, sf):
    """Lineitem with planted nulls (FIXTURES B)."""
    return li(spark, sf).select(
        "l_orderkey", "l_linenumber",
        F.when(F.col("l_linenumber") == 7, F.lit(None)).otherwise(F.col("l_quantity")).alias("l_quantity"),
        "l_extendedprice", F.expr("nullif(l_discount, 0.0)").alias("l_discount"),
        F.expr("nullif(l_tax, 0.0)").alias("l_tax"), "l_returnflag", "l_linestatus")


LI_NULLS_SQL = ("(SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber = 7 THEN NULL ELSE l_quantity END AS l_quantity, "
                "l_extendedprice, nullif(l_discount, 0.0) AS l_discount, nullif(l_tax, 0.0) AS l_tax, "
                "l_returnflag, l_linestatus FROM lineitem)")


def is_test(c="l_orderkey"):
    return F.pmod(F.col(c), F.lit(5)) == 0


def li_train(spark, sf, base=None):
    return (base if base is not None else li(spark, sf)).where(~is_test())


def li_test(spark, sf, base=None):
    return (base if base is not None else li(spark, sf)).where(is_test())


LI_TRAIN_SQL = "(SELECT * FROM lineitem WHERE l_orderkey % 5 <> 0)"
LI_TEST_SQL = "(SELECT * FROM lineitem WHERE l_orderkey % 5 = 0)"


def li_test_drift(spark, sf):
    """Test side with prices shifted by 10 % (drifted test)."""
    t = li_test(spark, sf)
    return t.withColumn("l_extendedprice", F.col("l_extendedprice") * 1.1)


LI_TEST_DRIFT_SQL = "(SELECT * REPLACE (l_extendedprice * 1.1 AS l_extendedprice) FROM lineitem WHERE l_orderkey % 5 = 0)"


def li_dups(spark, sf):
    """Lineitem plus re-appended rows (planted duplicates)."""
    base = li(spark, sf)
    return base.unionByName(base.where((F.col("l_linenumber") == 1) & (F.pmod("l_orderkey", F.lit(100)) == 0)))


LI_DUPS_SQL = ("(SELECT * FROM lineitem UNION ALL SELECT * FROM lineitem "
               "WHERE l_linenumber = 1 AND l_orderkey % 100 = 0)")


def y_binary():
    """Binary target on lineitem: returnflag R."""
    return (F.col("l_returnflag") == "R").cast("int")


Y_BIN_SQL = "CAST(l_returnflag = 'R' AS INTEGER)"
