"""Helpers shared by the training-data operators: stored intermediate tables, chunked text kernels."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabscope.session import scratch_path

#: Bytes of text that a kernel works on at once; one document is never cut.
CHUNK_BYTES = 1 << 20


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back: lineage ends there, an executor that is
    lost takes nothing along."""
    return stored_at(df, name)[0]


def stored_at(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def forget(spark: SparkSession, path: str) -> None:
    """Delete a stored table that a later one replaces."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def places(df: DataFrame, *names: str) -> list[int]:
    """Where the named columns are: the first exact match, else the first that differs in case only."""
    have, at = df.columns, []
    for n in names:
        exact = [i for i, c in enumerate(have) if c == n]
        at.append((exact or [i for i, c in enumerate(have) if c.lower() == n.lower()])[0])
    return at


def narrow(df: DataFrame, *names: str) -> DataFrame:
    """Only the named columns (by position of the first match, so that extra columns with clashing names,
    also names that differ in case, do no harm)."""
    have, at = df.columns, places(df, *names)
    if len(set(c.lower() for c in have)) == len(have):
        return df.select(*[F.col(f"`{have[i]}`").alias(n) for i, n in zip(at, names, strict=True)])
    return df.toDF(*[f"_{i}" for i in range(len(have))]).select(
        *[F.col(f"_{i}").alias(n) for i, n in zip(at, names, strict=True)])


def shielded(df: DataFrame, *names: str) -> tuple[DataFrame, list[str]]:
    """``df`` with its columns called ``c0``, ``c1``, ..., and what the named ones are called now: whatever columns an
    operator adds, none has the name of a column that came along.  ``toDF(*df.columns)`` brings the names back."""
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))]), [f"c{i}" for i in places(df, *names)]


def ascii_lower(c: Column) -> Column:
    """``lower`` with no character outside ASCII becoming an ASCII one (the Kelvin sign and the dotted I are
    the two whose lower case does): word boundaries and ASCII words come out as with A-Z lower-cased alone."""
    return F.lower(F.replace(F.replace(c, F.lit("K"), F.lit("Å")), F.lit("İ"), F.lit("Ï")))


# ------------------------------------------------------------------ kernels
U64 = np.uint64
BASE = U64(0x9E3779B97F4A7C15)
BASE_INV = U64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_POWERS: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i for i <= n, modulo 2**64 (kept between calls)."""
    if not _POWERS or len(_POWERS[0]) <= n:
        out = []
        for b in (BASE, BASE_INV):
            a = np.full(n + 1, b, dtype=U64)
            a[0] = 1
            out.append(np.multiply.accumulate(a))
        _POWERS[:] = out
    return _POWERS[0], _POWERS[1]


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer of 64-bit hashes (multiply and xor-shift)."""
    x = x ^ (x >> U64(32))
    x *= U64(0xD6E8FEB86659FD93)
    x ^= x >> U64(32)
    x *= U64(0xD6E8FEB86659FD93)
    x ^= x >> U64(32)
    return x


class PrefixHash:
    """Hashes of any byte ranges of a buffer from one prefix sum."""

    def __init__(self, codes: np.ndarray):
        n = len(codes)
        self.pw, self.ip = powers(n + 1)
        self.sums = np.zeros(n + 1, dtype=U64)
        np.cumsum((codes.astype(U64) + U64(1)) * self.pw[:n], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.ip[start])


def text_chunks(texts: pa.Array, most: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of consecutive rows with about ``most`` bytes; nulls are empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    n = len(texts)
    if not n:
        return
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + n + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + most, side="right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j, data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
        i = j


def table_of(chars: bytes | range) -> np.ndarray:
    t = np.zeros(256, dtype=bool)
    t[list(chars)] = True
    return t


SPACE = table_of(b"\x20\x09\x0a\x0b\x0c\x0d")
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def word_spans(buf: np.ndarray, offsets: np.ndarray, gap: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every maximal run of bytes that aren't in ``gap``, never across rows."""
    if not len(buf):
        z = np.zeros(0, np.int64)
        return z, z, z
    inside = ~gap[buf]
    edge = np.zeros(len(buf) + 1, dtype=bool)
    edge[offsets] = True
    start = np.flatnonzero(inside & (edge[:-1] | ~np.concatenate([[False], inside[:-1]])))
    end = np.flatnonzero(inside & (edge[1:] | ~np.concatenate([inside[1:], [False]]))) + 1
    return start, end, np.searchsorted(offsets, start, side="right") - 1


# ------------------------------------------------------------------ order without one big window
def before(df: DataFrame, by: list[str], block: Column, order: list[str], value: Column, name: str) -> DataFrame:
    """Adds ``name``: the sum of ``value`` over the rows of the same ``by`` group that come earlier in
    (``block``, ``order``).

    ``block`` is a small integer that depends on the row alone (bits of a hash), so no task holds a whole group,
    and a recomputed task finds the same blocks.  The offsets table has a row per group and block."""
    x = df.withColumn("_block", block).withColumn("_value", value)
    total = x.groupBy(*by, "_block").agg(F.sum("_value").alias("_sum"))
    earlier = Window.partitionBy(*by).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    total = total.select(*[F.col(b).alias(f"_by{i}") for i, b in enumerate(by)], F.col("_block").alias("_of"),
                         F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy(*by, "_block").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    x = x.withColumn("_local", F.coalesce(F.sum("_value").over(inside), F.lit(0)))
    same = F.col("_block") == F.col("_of")
    for i, b in enumerate(by):
        same = same & x[b].eqNullSafe(total[f"_by{i}"])
    x = x.join(total, same).withColumn(name, F.col("_offset") + F.col("_local"))
    return x.drop("_block", "_value", "_of", "_offset", "_local", *[f"_by{i}" for i in range(len(by))])


def hash_bits(h: str, bits: int, shift: int = 0) -> Column:
    """Bits of a 64-bit hash column as a block number."""
    return F.shiftrightunsigned(F.col(h), 64 - bits - shift).bitwiseAND(F.lit((1 << bits) - 1)).cast("int")
