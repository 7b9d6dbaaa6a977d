"""Sources and sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tabscope.functions.exprs import col


def read_table(spark: SparkSession, path: str, fmt: str | None = None, schema: StructType | None = None,
               header: bool = True, infer: bool = True) -> DataFrame:
    """Scan parquet / csv / json / orc; format from the extension unless given.

    CSV uses header + schema inference only when no schema is passed
    (inference costs an extra pass over the files)."""
    fmt = fmt or path.rstrip("/").rsplit(".", 1)[-1].lower()
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    if fmt == "csv":
        return r.option("header", header).option("inferSchema", infer and schema is None).csv(path)
    if fmt in ("json", "jsonl"):
        return r.json(path)
    if fmt == "orc":
        return r.orc(path)
    return r.parquet(path)


def require_columns(df: DataFrame, *names: str) -> DataFrame:
    """S3: fail fast when the target / id columns are absent."""
    missing = [n for n in names if n and n not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    return df


def align_columns(reference: DataFrame, other: DataFrame, keep_extra: Sequence[str] = ()) -> DataFrame:
    """Project ``other`` onto the reference's columns (in its order), casting to its types;
    columns it lacks become nulls, its extra columns are dropped unless listed in ``keep_extra``."""
    have = set(other.columns)
    out = []
    for f in reference.schema.fields:
        out.append((col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name))
    out += [col(c) for c in keep_extra if c in have]
    return other.select(*out)


def common_columns(a: DataFrame, b: DataFrame) -> list[str]:
    bs = set(b.columns)
    return [c for c in a.columns if c in bs]


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: Sequence[str] = ()) -> str:
    """Write csv (with header) / json / parquet."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.option("header", True).csv(path)
    elif fmt == "json":
        w.json(path)
    else:
        w.parquet(path)
    return path


def write_text_lines(df: DataFrame, column: str, path: str) -> str:
    """One line per row of a text column (report sink)."""
    df.select(col(column).cast("string").alias("value")).write.mode("overwrite").text(path)
    return path


def holdout_split(df: DataFrame, key: str, fraction_den: int = 5, hashed: bool = True) -> DataFrame:
    """Deterministic holdout label: ``pmod(hash(key), den) == 0`` -> test.

    Engine-stable (unlike ``sample``), so reruns after executor loss give the
    same split.  ``hashed=False`` uses the key value itself (SQL-comparable)."""
    k = F.xxhash64(col(key)) if hashed else col(key)
    return df.withColumn("source", F.when(F.pmod(k, F.lit(fraction_den)) == 0, "test").otherwise("train"))
