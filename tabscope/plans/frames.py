"""Shared one-pass building blocks.

* ``per_feature``  - one wide aggregate over many columns (optionally grouped,
  e.g. by class or by train/test source), stacked to long form
  ``(group..., feature, stat...)``.  One scan, partial aggregation on the map
  side, a shuffle of at most #groups rows per task.
* ``long_values`` / ``value_counts`` - unpivot categorical columns once and
  count ``(feature, value[, by])`` cells: the contingency cube that the
  entropy / chi-square / Cramer's V / IV / MI operators are arithmetic on.
  ``count`` is combinable, so a value holding a third of all rows collapses to
  one partial row per task before the shuffle.
* ``bounded`` - broadcast hint for tables whose size is bounded by the number
  of features (x classes), never by the number of rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabscope.config import DEFAULT, Config
from tabscope.functions.exprs import col

Stat = Callable[[Column], Column]


def per_feature(df: DataFrame, features: Sequence[str],
                stats: Mapping[str, Stat] | Callable[[int, str], Mapping[str, Column]],
                by: Sequence[str] = (), feature_col: str = "feature") -> DataFrame:
    """Compute ``stats`` for every feature in ONE aggregate, then unpivot.

    ``stats`` maps stat name -> function of the feature column, or is a
    callable ``(index, name) -> {stat: aggregate Column}`` when the aggregate
    depends on per-feature parameters (bounds from a scalar subquery).
    Every stat must return the same type for all features."""
    if not features:
        raise ValueError("no features")
    if callable(stats):
        made = [stats(i, f) for i, f in enumerate(features)]
    else:
        made = [{s: fn(col(f)) for s, fn in stats.items()} for f in features]
    names = list(made[0])
    exprs = [e.alias(f"_c{i}_{s}") for i, m in enumerate(made) for s, e in m.items()]
    agg = df.groupBy(*[col(b) for b in by]).agg(*exprs) if by else df.agg(*exprs)
    rows = F.array(*[
        F.struct(F.lit(f).alias(feature_col), *[F.col(f"_c{i}_{s}").alias(s) for s in names])
        for i, f in enumerate(features)])
    return agg.select(*[col(b) for b in by], F.inline(rows))


def scalar_row(stats: DataFrame) -> Column:
    """One-row stats table as a struct-valued scalar subquery (computed once,
    reused by every reference; keeps the plan lazy and single)."""
    return stats.select(F.struct(*[col(c) for c in stats.columns]).alias("s")).scalar()


def long_values(df: DataFrame, cols: Sequence[str], ids: Sequence[str] = (),
                feature_col: str = "feature", value_col: str = "value") -> DataFrame:
    """Unpivot ``cols`` (cast to string) into ``(ids..., feature, value)``."""
    proj = df.select(*[col(i) for i in ids], *[col(c).cast("string").alias(c) for c in cols])
    return proj.unpivot([col(i) for i in ids], [col(c) for c in cols], feature_col, value_col)


def value_counts(df: DataFrame, cols: Sequence[str], by: Sequence[str] = (), dropna: bool = True,
                 count_col: str = "n") -> DataFrame:
    """Contingency cube ``(feature, value, by..., n)``."""
    lv = long_values(df, cols, ids=by)
    if dropna:
        lv = lv.where(F.col("value").isNotNull())
    return lv.groupBy("feature", "value", *by).agg(F.count(F.lit(1)).alias(count_col))


def quantiles(c: Column, probs: Sequence[float], cfg: Config = DEFAULT) -> Column:
    """Array of quantiles with linear interpolation (exact) or GK sketch."""
    probs = [float(p) for p in probs]
    if cfg.quantile_mode == "approx":
        return F.percentile_approx(c.cast("double"), probs, cfg.quantile_accuracy)
    return F.percentile(c.cast("double"), probs)


def quantile(c: Column, p: float, cfg: Config = DEFAULT) -> Column:
    if cfg.quantile_mode == "approx":
        return F.percentile_approx(c.cast("double"), float(p), cfg.quantile_accuracy)
    return F.percentile(c.cast("double"), float(p))


def distinct_counts(df: DataFrame, features: Sequence[str], feature_col: str = "feature") -> DataFrame:
    """``(feature, n_rows, n_null, n_unique)``: exact distinct non-null values of every column, each by a narrow group-by of its own
    that reads this column alone.  Several ``count_distinct`` in one aggregate would expand every row once a column and
    shuffle rows as wide as all of them."""
    out = None
    for f in features:
        g = df.groupBy(col(f).alias("_v")).agg(F.count(F.lit(1)).alias("_k"))
        one = g.agg(F.coalesce(F.sum("_k"), F.lit(0)).alias("n_rows"),
                    F.coalesce(F.sum(F.when(F.col("_v").isNull(), F.col("_k"))), F.lit(0)).alias("n_null"),
                    F.count("_v").alias("n_unique")).select(F.lit(f).alias(feature_col), "n_rows", "n_null", "n_unique")
        out = one if out is None else out.unionByName(one)
    if out is None:
        raise ValueError("no features")
    return out


def bounded(df: DataFrame) -> DataFrame:
    """Broadcast a table whose row count is bounded by #features x #classes."""
    return F.broadcast(df)


def with_totals(cells: DataFrame, by: Sequence[str] = ("feature",), bound: bool = True, **sums: str) -> DataFrame:
    """``cells`` with the sums of columns over ``by`` groups (``name="column"``), by an aggregate and a join: no task
    holds all cells of a group, as a window would make it.  ``bound`` broadcasts the totals: right for keys whose number
    is bounded by features (and classes), not by rows."""
    totals = cells.groupBy(*by).agg(*[F.sum(c).alias(n) for n, c in sums.items()])
    return cells.join(bounded(totals) if bound else totals, list(by))


def class_moments(df: DataFrame, features: Sequence[str], by: Sequence[str]) -> DataFrame:
    """``(by..., feature, n, mean, var, m2)`` per group in one grouped aggregate."""
    return per_feature(df, features, {
        "n": lambda c: F.count(c),
        "mean": lambda c: F.avg(c.cast("double")),
        "var": lambda c: F.var_samp(c.cast("double")),
        "var_pop": lambda c: F.var_pop(c.cast("double")),
    }, by=by)


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    from pyspark.sql.types import NumericType
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType) and f.name not in exclude]


def string_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    from pyspark.sql.types import BooleanType, StringType
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, (StringType, BooleanType)) and f.name not in exclude]


def positions(df: DataFrame, order: Sequence[Column], by: Sequence[str] = (), name: str = "position",
              checkpoint: bool = True) -> DataFrame:
    """Exact 0-based position of every row in ``order`` (within ``by`` groups) without a
    single-partition window.

    Rows are range-partitioned and sorted on (by, order); each task numbers its
    rows (``monotonically_increasing_id`` = partition id << 33 | row index);
    a table of #partitions x #groups block counts gives every block its
    offset.  The numbered frame is checkpointed to the shared checkpoint
    folder, so a recomputation after an executor loss cannot renumber rows."""
    from tabscope.session import scratch_dir
    # rows that are equal in (by, order) are told apart by their place in the input, so that they spread over tasks too
    x = df.withColumn("_ord", F.struct(*order, F.monotonically_increasing_id().alias("_tie")))
    keys = [*[col(b) for b in by], F.col("_ord")]
    x = x.repartitionByRange(*keys).sortWithinPartitions(*keys)
    mid = F.monotonically_increasing_id()
    x = x.withColumn("_pid", F.shiftright(mid, 33)).withColumn("_pos", mid.bitwiseAND(F.lit((1 << 33) - 1)))
    if checkpoint:
        scratch_dir(df.sparkSession)
        x = x.checkpoint(eager=True)
    blocks = x.groupBy("_pid", *by).agg(F.min("_pos").alias("_first"), F.count(F.lit(1)).alias("_cnt"))
    wo = Window.partitionBy(*[col(b) for b in by]).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("_off", F.coalesce(F.sum("_cnt").over(wo), F.lit(0)))
    j = _join_null_safe(x, blocks.select("_pid", *by, "_first", "_off"), ["_pid", *by])
    return j.withColumn(name, F.col("_off") + F.col("_pos") - F.col("_first")).drop(
        "_ord", "_pid", "_pos", "_first", "_off")


def _join_null_safe(x: DataFrame, y: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join on ``keys`` where null equals null; keeps the keys of ``x``."""
    y = y.withColumnsRenamed({k: f"_k{i}" for i, k in enumerate(keys)})
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & col(k).eqNullSafe(F.col(f"_k{i}"))
    return x.join(y, same).drop(*[f"_k{i}" for i in range(len(keys))])


def value_block(x: Column, cuts: Sequence[float]) -> Column:
    """How many of the sorted ``cuts`` lie at or under ``x``, by two short searches; -1 for null."""
    if not cuts:
        return F.when(x.isNull(), -1).otherwise(0)
    step = max(1, int(len(cuts) ** 0.5))
    rows = [cuts[i:i + step] for i in range(0, len(cuts), step)]

    def under(bounds):
        return F.size(F.filter(bounds, lambda b: b <= x))
    top = under(F.array(*[F.lit(float(r[0])) for r in rows]))
    inner = F.array(*[F.array(*[F.lit(float(c)) for c in r]) for r in rows])
    return F.when(x.isNull(), -1).when(top == 0, 0).otherwise((top - 1) * step + under(F.get(inner, top - 1)))


def permute_column(df: DataFrame, column: str, key_cols: Sequence[str], seed: int = 42,
                   keep: Sequence[str] | None = None) -> DataFrame:
    """Exact random permutation of one column: rows ordered by one seeded hash are paired,
    position by position, with values ordered by an independent hash (one shuffle join).  ``keep`` names the other
    columns of the result (default: all); the sorted rows carry them and the hash, not the keys."""
    keys = [col(k) for k in key_cols]
    kept = [col(c) for c in (df.columns if keep is None else keep) if c != column]
    a = positions(df.select(*kept, F.xxhash64(F.lit(seed), *keys).alias("_h")), [F.col("_h")], name="_p").drop("_h")
    b = positions(df.select(col(column), F.xxhash64(F.lit(seed + 7919), *keys).alias("_h")), [F.col("_h")], name="_p") \
        .select("_p", col(column))
    return a.join(b, "_p").drop("_p")


def permute_classes(df: DataFrame, column: str, key_cols: Sequence[str], seed: int, folds: int) -> DataFrame:
    """Exact random permutation of a column of few values, and stratified folds of it, by one sort: rows in the order of a
    seeded hash take the values in blocks, each as long as its count (nulls too), and the place in a block mod ``folds``
    is the ``fold``.  Rows with equal keys are told apart by a hash of their place in the input."""
    counts = [tuple(r) for r in df.groupBy(col(column).alias("v")).agg(F.count(F.lit(1)).alias("n")).collect()]
    counts = sorted(((v, n) for v, n in counts if v is not None)) + [(v, n) for v, n in counts if v is None]
    kind = df.schema[column].dataType
    order = F.struct(F.xxhash64(F.lit(seed), *[col(k) for k in key_cols]), F.xxhash64(F.lit(seed), F.monotonically_increasing_id()))
    p = positions(df.select(*[col(c) for c in df.columns if c not in (column, *key_cols)], order.alias("_by")), [F.col("_by")], name="_p")
    starts = [sum(n for _, n in counts[:i]) for i in range(len(counts))]
    return p.withColumn("_i", value_block(F.col("_p"), starts[1:])).select(
        *[col(c) for c in p.columns if c not in ("_p", "_by")], F.get(F.array(*[F.lit(v).cast(kind) for v, _ in counts]), F.col("_i")).alias(column),
        F.pmod(F.col("_p") - F.get(F.array(*[F.lit(n).cast("bigint") for n in starts]), F.col("_i")), F.lit(folds)).cast("int").alias("fold"))


def running_sum(df: DataFrame, order: Sequence[str], value, by: Sequence[str] = (), out="_cum",
                total=None) -> DataFrame:
    """Inclusive running sum(s) of ``value`` (a column name or a list) ordered by the numeric column ``order``
    within ``by`` groups, distributed.

    A row's block depends on its order value alone: the bounds are approximate quantiles of that column, taken
    once (one number per block) and inlined.  Each block of a group is summed by a window, and the sums of the earlier
    blocks are added from a table of blocks x groups.  No task holds more than a block, whatever the number of
    distinct values, and a recomputed or re-planned stage finds the same blocks.  ``df`` is written to the shared
    scratch folder first, as it is read three times.  ``total`` adds the group total(s) as column(s)."""
    from tabscope.session import scratch_path
    values = [value] if isinstance(value, str) else list(value)
    outs = [out] if isinstance(out, str) else list(out)
    totals = ([total] if isinstance(total, str) else list(total)) if total else []
    if len(order) != 1:
        raise ValueError("one order column")
    spark = df.sparkSession
    path = scratch_path(spark, "cells")
    df.write.parquet(path)
    x = spark.read.schema(df.schema).parquet(path)
    key = col(order[0]).cast("double")
    n = max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    cuts = x.agg(F.percentile_approx(key, [i / n for i in range(1, n)], 100 * n)).first()[0] or []
    x = x.withColumn("_block", value_block(key, sorted({c for c in cuts if c == c})))
    w = Window.partitionBy(*by, "_block").orderBy(*[col(o) for o in order]).rowsBetween(Window.unboundedPreceding, 0)
    blocks = x.groupBy(*by, "_block").agg(*[F.sum(v).alias(f"_bs{k}") for k, v in enumerate(values)])
    for k, v in enumerate(values):
        x = x.withColumn(f"_local{k}", F.sum(v).over(w))
    wo = Window.partitionBy(*[col(b) for b in by]).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    wg = Window.partitionBy(*[col(b) for b in by])
    for k in range(len(values)):
        blocks = blocks.withColumn(f"_off{k}", F.coalesce(F.sum(f"_bs{k}").over(wo), F.lit(0)))
    for k, t in enumerate(totals):
        blocks = blocks.withColumn(t, F.sum(f"_bs{k}").over(wg))
    sel = ["_block", *by, *[f"_off{k}" for k in range(len(values))], *totals]
    j = _join_null_safe(x, blocks.select(*sel), ["_block", *by])
    for k, o in enumerate(outs):
        j = j.withColumn(o, F.col(f"_off{k}") + F.col(f"_local{k}"))
    return j.drop("_block", *[f"_local{k}" for k in range(len(values))], *[f"_off{k}" for k in range(len(values))])


#: Values (rows x features) from which quantiles look at the neighbourhood of each order statistic only.
NARROW_FROM = 2_000_000


def _narrowed_cells(vals: DataFrame, features: Sequence[str], probs: Sequence[float]) -> DataFrame | None:
    """``(feature, x, k)`` cells with the same order statistics at ``probs`` as all values have, but few of them: values
    near a wanted one stay as they are, those between two neighbourhoods count as one cell.  A sketch bounds the
    neighbourhoods, exact counts of the cells prove that every wanted rank lies inside one.  None for small tables, and
    if a rank lies outside."""
    from tabscope.plans.blocks import written
    accuracy, reach = 10_000, 3e-4
    points = sorted({min(1.0, max(0.0, p + s * reach)) for p in probs for s in (-1, 1)})
    clean = [F.when(~F.isnan(col(f)), col(f)) for f in features]
    got = vals.agg(*[F.count(x).alias(f"n{i}") for i, x in enumerate(clean)],
                   *[F.percentile_approx(x, points, accuracy).alias(f"q{i}") for i, x in enumerate(clean)]).first()
    if sum(got[f"n{i}"] for i in range(len(features))) < NARROW_FROM:
        return None
    near, exprs = {}, []
    for i, (f, x) in enumerate(zip(features, clean)):
        at = dict(zip(points, got[f"q{i}"] or [0.0] * len(points)))
        spans: list[list[float]] = []
        for lo, hi in sorted((-math.inf if p - reach <= 0 else at[p - reach], math.inf if p + reach >= 1 else at[p + reach]) for p in probs):
            if spans and lo <= spans[-1][1]:
                spans[-1][1] = max(hi, spans[-1][1])
            else:
                spans.append([lo, hi])
        near[f] = spans
        at_or_under = F.size(F.filter(F.array(*[F.lit(lo) for lo, _ in spans]), lambda lo: lo <= x))
        last = F.array(F.lit(-math.inf), *[F.lit(hi) for _, hi in spans])
        past = F.array(F.lit(-math.inf), *[F.lit(math.nextafter(hi, math.inf)) for _, hi in spans])
        exprs.append(F.when(x <= F.get(last, at_or_under), x).when(x.isNotNull(), F.get(past, at_or_under)).alias(f))
    cells = vals.select(*exprs).unpivot([], [col(f) for f in features], "feature", "x").where(F.col("x").isNotNull())
    cells = written(cells.groupBy("feature", "x").agg(F.count(F.lit(1)).alias("k")), "cells")
    spans = vals.sparkSession.createDataFrame([(f, lo, hi) for f, s in near.items() for lo, hi in s], "feature string, lo double, hi double")
    held = cells.join(bounded(spans), "feature").groupBy("feature", "lo", "hi").agg(
        F.sum(F.when(F.col("x") < F.col("lo"), F.col("k")).otherwise(0)).alias("below"),
        F.sum(F.when(F.col("x") <= F.col("hi"), F.col("k")).otherwise(0)).alias("upto")).collect()
    for i, f in enumerate(features):
        n, own = got[f"n{i}"], [(r["below"], r["upto"]) for r in held if r["feature"] == f]
        for p in probs if n else ():
            h = (n - 1) * p
            if not any(a <= math.floor(h) and math.ceil(h) < b for a, b in own):
                return None
    return cells


def quantile_table(df: DataFrame, features: Sequence[str], probs: Sequence[float], by: Sequence[str] = (),
                   name: str = "q") -> DataFrame:
    """Exact linear-interpolation quantiles (numpy / pandas / Spark ``percentile`` definition),
    fully distributed: ``(by..., feature, value) -> count`` cells (map-side combined), a
    distributed running sum of counts, and a lookup of the two order statistics around
    h = (n-1) p for every requested p.  Without ``by``, large tables count cells near those order statistics only.  No task ever holds all values of a column, unlike
    the built-in ``percentile`` whose final merge does.  Returns ``(by..., feature, q)`` with
    ``q`` an array aligned with ``probs``."""
    probs = [float(p) for p in probs]
    vals = df.select(*[col(b) for b in by], *[col(f).cast("double").alias(f) for f in features])
    cells = None if by else _narrowed_cells(vals, features, probs)
    if cells is None:
        lv = vals.unpivot(list(by), list(features), "feature", "x").where(F.col("x").isNotNull() & ~F.isnan("x"))
        cells = lv.groupBy(*by, "feature", "x").agg(F.count(F.lit(1)).alias("k"))
    r = running_sum(cells, ["x"], "k", by=[*by, "feature"], out="cum", total="n")
    # every cell tests the 2 x len(probs) target ranks (a fixed-size array), emits the ones it holds
    targets = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"),
                                 (F.floor((F.col("n") - 1) * p) if j == 0 else F.ceil((F.col("n") - 1) * p)).alias("rank"))
                        for i, p in enumerate(probs) for j in (0, 1)])
    held = F.filter(targets, lambda t: (t["rank"] >= F.col("cum") - F.col("k")) & (t["rank"] < F.col("cum")))
    hit = r.select(*by, "feature", "x", "cum", "k", "n", F.explode(held).alias("t"))
    g = hit.groupBy(*by, "feature", F.col("t.i").alias("i")).agg(
        F.max(F.when(F.col("t.j") == 0, F.col("x"))).alias("xlo"), F.max(F.when(F.col("t.j") == 1, F.col("x"))).alias("xhi"),
        F.max("n").alias("n"))
    pr = F.array(*[F.lit(p) for p in probs])[F.col("i")]
    h = (F.col("n") - 1) * pr
    qv = F.col("xlo") + (F.col("xhi") - F.col("xlo")) * (h - F.floor(h))
    per = g.select(*by, "feature", "i", qv.alias("qv"))
    # deterministic assembly of the array (max over a one-row-per-index group)
    return per.groupBy(*by, "feature").agg(
        F.array(*[F.max(F.when(F.col("i") == k, F.col("qv"))) for k in range(len(probs))]).alias(name))


def quantile_long(df: DataFrame, features: Sequence[str], probs: Sequence[float], by: Sequence[str] = (),
                  cfg: Config = DEFAULT, name: str = "q") -> DataFrame:
    """``(by..., feature, q array)`` with the configured strategy (distributed exact or sketch)."""
    if cfg.quantile_mode == "exact":
        return quantile_table(df, features, probs, by, name)
    return per_feature(df, features, {name: lambda c: quantiles(c, probs, cfg)}, by=by)


def quantile_scalar(df: DataFrame, features: Sequence[str], probs: Sequence[float], cfg: Config = DEFAULT,
                    prefix: str = "q", distinct: bool = False) -> Column:
    """Struct scalar subquery with one quantile array per feature (fields ``{prefix}{i}``)."""
    if cfg.quantile_mode == "exact":
        qt = quantile_table(df, features, probs)
        pick = (lambda c: F.array_distinct(c)) if distinct else (lambda c: c)
        row = qt.agg(*[F.max(F.when(F.col("feature") == f, pick(F.col("q")))).alias(f"{prefix}{i}")
                       for i, f in enumerate(features)])
    else:
        pick = (lambda c: F.array_distinct(c)) if distinct else (lambda c: c)
        row = df.agg(*[pick(quantiles(col(f), probs, cfg)).alias(f"{prefix}{i}") for i, f in enumerate(features)])
    return scalar_row(row)
