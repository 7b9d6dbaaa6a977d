"""Column roles from the schema (P3) and from cardinality (P4), problem type (P5)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabscope.config import DEFAULT, Config
from tabscope.functions.exprs import col
from tabscope.plans.frames import distinct_counts

NUMERIC_TYPES = ("tinyint", "smallint", "int", "bigint", "float", "double")


def _family(t: str) -> str:
    if t in NUMERIC_TYPES or t.startswith("decimal"):
        return "numeric"
    if t in ("string", "boolean") or t.startswith("varchar") or t.startswith("char"):
        return "categorical"
    if t.startswith("timestamp") or t == "date":
        return "datetime"
    return "other"


def column_roles_schema(df: DataFrame, target: str | None = None, id_cols: Sequence[str] = ()) -> dict[str, str]:
    out = {}
    for name, t in df.dtypes:
        if name == target:
            out[name] = "target"
        elif name in id_cols:
            out[name] = "id"
        else:
            out[name] = _family(t)
    return out


def column_roles(df: DataFrame) -> DataFrame:
    """``feature, ordinal, role`` from the schema (no data scan)."""
    roles = column_roles_schema(df)
    rows = F.array(*[F.struct(F.lit(n).alias("feature"), F.lit(i).cast("bigint").alias("ordinal"),
                              F.lit(roles[n]).alias("role")) for i, n in enumerate(df.columns)])
    return df.agg(F.count(F.lit(1))).select(F.inline(rows))  # one row, also for an empty table


def column_roles_card(df: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Numeric columns with <= ``cat_threshold`` distinct values are categorical."""
    fam = column_roles_schema(df)
    out = distinct_counts(df, df.columns)
    base = F.create_map(*[x for n in df.columns for x in (F.lit(n), F.lit(fam[n]))])[F.col("feature")]
    role = (F.when((base == "numeric") & (F.col("n_unique") <= cfg.cat_threshold), "categorical")
            .otherwise(base))
    return out.select("feature", "n_unique", role.alias("role"))


def problem_type(df: DataFrame, targets: Sequence[str], cfg: Config = DEFAULT) -> DataFrame:
    """P5: binary / multiclass / regression from distinct count (<= 20 levels) and type."""
    fam = column_roles_schema(df)
    out = distinct_counts(df, targets).withColumnRenamed("n_unique", "n_classes")
    base = F.create_map(*[x for n in targets for x in (F.lit(n), F.lit(fam[n]))])[F.col("feature")]
    kind = (F.when(F.col("n_classes") == 2, "binary")
            .when((base != "numeric") | (F.col("n_classes") <= cfg.problem_type_levels), "multiclass")
            .otherwise("regression"))
    return out.select(F.col("feature").alias("target"), "n_classes", kind.alias("problem_type"))
