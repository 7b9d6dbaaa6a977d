"""Column-expression helpers (all JVM-side built-ins, codegen friendly)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def col(name: str) -> Column:
    """Column by exact name (dots/spaces allowed)."""
    return F.col("`" + name.replace("`", "``") + "`")


def safe_div(a: Column, b: Column) -> Column:
    return F.when(b != 0, a / b)


def equal_width_bin(x: Column, lo: Column, hi: Column, bins: int) -> Column:
    """Index of the equal-width bin on [lo, hi], the last one closed; a constant column has bin 0 alone."""
    b = F.floor((x.cast("double") - lo) * F.try_divide(F.lit(float(bins)), hi - lo))
    b = F.when(hi > lo, F.when(b >= bins, bins - 1).otherwise(b))
    return b.when(x.isNotNull(), F.lit(0)).cast("int")


def nan_to_null(c: Column) -> Column:
    return F.when(~F.isnan(c), c)


def skew_corrected(g1: Column, n: Column) -> Column:
    """Population skewness g1 -> bias-corrected G1 (pandas ``Series.skew``)."""
    n = n.cast("double")
    return F.when(n > 2, g1 * F.sqrt(n * (n - 1)) / (n - 2))


def kurt_corrected(g2: Column, n: Column) -> Column:
    """Population excess kurtosis g2 -> bias-corrected G2 (pandas ``Series.kurt``)."""
    n = n.cast("double")
    return F.when(n > 3, ((n + 1) * g2 + 6) * (n - 1) / ((n - 2) * (n - 3)))


# Significant-digit rounding written as a CASE chain with constant scales so
# that Spark and an SQL oracle produce bit-identical doubles.
_SIG_DIGITS = 8
_SIG_MAX_EXP = 15


def _sig_branches(digits: int):
    for k in range(_SIG_MAX_EXP, -1, -1):
        yield 10.0 ** k, digits - 1 - k


def sig_round(c: Column, digits: int = _SIG_DIGITS) -> Column:
    a = F.abs(c)
    e = F.when(c.isNull() | F.isnan(c), F.lit(None).cast("double"))
    e = e.when(a < 5e-10, F.lit(0.0))
    for lo, scale in _sig_branches(digits):
        e = e.when(a >= lo, F.round(c, scale))
    return e.otherwise(F.round(c, 9)).cast("double")


def sig_round_sql(expr: str, digits: int = _SIG_DIGITS) -> str:
    x = f"({expr})"
    parts = [f"CASE WHEN {x} IS NULL OR isnan({x}) THEN NULL",
             f"WHEN abs({x}) < 5e-10 THEN 0.0"]
    for lo, scale in _sig_branches(digits):
        parts.append(f"WHEN abs({x}) >= {lo!r} THEN round({x}, {scale})")
    parts.append(f"ELSE round({x}, 9) END")
    return "CAST(" + " ".join(parts) + " AS DOUBLE)"


def round_doubles(df: DataFrame, digits: int = _SIG_DIGITS) -> DataFrame:
    """Apply :func:`sig_round` to every floating column (for oracle comparison)."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            out.append(sig_round(col(f.name).cast("double"), digits).alias(f.name))
        else:
            out.append(col(f.name))
    return df.select(*out)


def pearson(a: Column, b: Column) -> Column:
    """Pairwise-complete Pearson r that yields null (not an ANSI divide-by-zero
    error) when either side is constant."""
    a = a.cast("double")
    b = b.cast("double")
    a2 = F.when(b.isNotNull(), a)
    b2 = F.when(a.isNotNull(), b)
    return F.try_divide(F.covar_pop(a2, b2), F.stddev_pop(a2) * F.stddev_pop(b2))
