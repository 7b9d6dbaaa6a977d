"""Ordered data in blocks: what windows over a whole series or a whole column need, without a task that holds them.

* ``written``  - store a frame in the shared scratch folder and read it back (lineage ends there).
* ``haloed``   - rows in value-determined blocks that also carry the last rows of the blocks before and the first ones
  of the blocks after, so that ``lag``, ``lead`` and moving frames of bounded reach work inside a block.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabscope.functions.exprs import col
from tabscope.plans.frames import value_block


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a stored table: an executor that is lost takes nothing along, and nothing is computed twice."""
    from tabscope.session import scratch_path
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def haloed(df: DataFrame, order: str, before: int = 0, after: int = 0, by: Sequence[str] = (),
           blocks: int | None = None) -> DataFrame:
    """The rows of ``df`` with ``_block`` and ``_halo``: each block of a ``by`` group also holds (with ``_halo`` true) the
    last ``before`` rows that precede it and the first ``after`` rows that follow it in the group.

    ``order`` is a numeric, date or timestamp column without ties inside a group.  A row's block depends on its order
    value alone (approximate quantiles, one number per block, taken once), so recomputed stages find the same blocks.
    The rows next to block ends, ``blocks * (before + after)`` a group at most, are the only ones that a window sees
    without the block as a key.  Windows over the result use ``partitionBy(*by, "_block").orderBy(order)``; drop the
    halo rows afterwards."""
    spark = df.sparkSession
    x = written(df, "series")
    kind = dict(x.dtypes)[order]
    key = F.unix_date(col(order)) if kind == "date" else F.unix_micros(col(order)) if kind == "timestamp" else col(order)
    key = key.cast("double")
    n = blocks or max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    cuts = x.agg(F.percentile_approx(key, [i / n for i in range(1, n)], 100 * n)).first()[0] or []
    x = x.withColumn("_block", value_block(key, sorted({c for c in cuts if c == c})))
    out = x.withColumn("_halo", F.lit(False))
    groups = [col(b) for b in by]
    inside = Window.partitionBy(*groups, "_block")
    edge = x.withColumn("_row", F.struct(*[col(c) for c in df.columns])).withColumn(
        "_nr", F.row_number().over(inside.orderBy(col(order)))).withColumn("_nr_back", F.row_number().over(inside.orderBy(col(order).desc())))
    along = Window.partitionBy(*groups).orderBy("_block", col(order))
    # among the last rows of all blocks, those right before a block's first row are the ones that precede it
    for reach, near, end, frame in ((before, "_nr_back", "_nr", along.rowsBetween(-before, -1)),
                                    (after, "_nr", "_nr_back", along.rowsBetween(1, after))):
        if reach:
            rows = edge.where((F.col(near) <= reach) | (F.col(end) == 1)).select(
                "_block", F.col(end).alias("_end"), F.collect_list("_row").over(frame).alias("_rows")).where("_end = 1")
            out = out.unionByName(rows.select("_block", F.explode("_rows").alias("_row")).select(
                "_row.*", "_block", F.lit(True).alias("_halo")))
    return out
