"""Nearest-neighbour operators: Local Outlier Factor and the k-NN mutual information.

``nearest`` is an exact k-nearest-neighbour self-join.  Rows with equal coordinates are one weighted location, so a value
that a third of the rows share is one point.  Locations form a tree of cells that halve every coordinate (on a squashed
scale, so far outliers don't flatten the rest) until a cell has ``LEAF`` locations at most; each cell knows the box that
its locations span.  Pairs of cells descend the tree level by level, as joins: the cells whose farthest corner is near
enough to hold k neighbours bound the distance, and every cell whose nearest corner lies beyond it is dropped.  Only leaves
that can hold a neighbour meet, in batches of arrays.  Correctness needs the boxes alone; cost grows with the number of
coordinates (as any exact search does), not with the square of a dense cell or of the rows."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabscope.functions.exprs import col
from tabscope.plans.blocks import haloed, written
from tabscope.plans.frames import quantile_table, running_sum, scalar_row

#: Locations of a leaf cell at most (but for locations that no bit tells apart).
LEAF = 64
BITS = 40


def _finite(c: Column) -> Column:
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))


def _locations(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """``(p, w, code)``: distinct coordinates, their number of rows, and the cell of each coordinate at the last level."""
    d = len(features)
    x = df.select(*[(col(f).cast("double") + F.lit(0.0)).alias(f"x{i}") for i, f in enumerate(features)])
    for i in range(d):
        x = x.where(_finite(F.col(f"x{i}")))
    x = written(x.groupBy(*[f"x{i}" for i in range(d)]).agg(F.count("*").alias("w")), "locations")
    mid = x.agg(*[F.percentile_approx(f"x{i}", [0.25, 0.5, 0.75], 1000).alias(f"q{i}") for i in range(d)]).first()
    codes = []
    for i in range(d):
        q = mid[f"q{i}"] or [0.0, 0.0, 0.0]
        t = (F.col(f"x{i}") - q[1]) / ((q[2] - q[0]) or abs(q[1]) or 1.0)
        codes.append(F.least(F.floor((0.5 + 0.5 * t / (1 + F.abs(t))) * (1 << BITS)), F.lit((1 << BITS) - 1)).cast("long"))
    return x.select(F.array(*[F.col(f"x{i}") for i in range(d)]).alias("p"), "w", F.array(*codes).alias("code"))


def _cell(level: int) -> Column:
    return F.concat(F.array(F.lit(level).cast("long")), F.transform("code", lambda c: F.shiftright(c, BITS - level)))


def _boxes(x: DataFrame, dims: int, parent: Column) -> DataFrame:
    return x.groupBy("id").agg(
        F.count("*").alias("locations"), F.sum("w").alias("w"), F.first(parent).alias("parent"),
        F.array(*[F.min(F.col("p")[i]) for i in range(dims)]).alias("lo"),
        F.array(*[F.max(F.col("p")[i]) for i in range(dims)]).alias("hi"))


def _descended(state: DataFrame, cells: DataFrame, dims: int, k: int) -> DataFrame:
    """The pairs (q, c) of child cells that can hold one of the k nearest neighbours of q's locations."""
    sides = []
    for s in "qc":
        sides.append(cells.select(F.col("parent").alias(f"{s}p"), F.col("id").alias(f"{s}n"), F.col("lo").alias(f"{s}lo"),
                                  F.col("hi").alias(f"{s}hi"), F.col("w").alias(f"{s}w")))
    x = state.join(sides[0], F.col("q") == F.col("qp")).join(sides[1], F.col("c") == F.col("cp"))

    def at(name, i):
        return F.col(name)[i]
    gaps = [F.greatest(at("qlo", i) - at("chi", i), at("clo", i) - at("qhi", i), F.lit(0.0)) for i in range(dims)]
    spans = [F.greatest(at("qhi", i) - at("clo", i), at("chi", i) - at("qlo", i)) for i in range(dims)]
    near, far = sum((g * g for g in gaps[1:]), gaps[0] * gaps[0]), sum((s * s for s in spans[1:]), spans[0] * spans[0])
    x = x.select(F.col("qn").alias("q"), F.col("cn").alias("c"), F.col("cw").alias("w"), near.alias("near"), far.alias("far"))
    by_far = Window.partitionBy("q").orderBy("far").rangeBetween(Window.unboundedPreceding, 0)
    x = x.withColumn("enough", F.sum("w").over(by_far) > k).withColumn(
        "reach", F.min(F.when(F.col("enough"), F.col("far"))).over(Window.partitionBy("q")))
    # a sum of squares may be off by some units in the last place
    return x.where(F.col("reach").isNull() | (F.col("near") <= F.col("reach") * (1 + 1e-12))).select("q", "c")


def _pairs(dims: int, k: int):
    """Locations of one leaf against those of all leaves that can hold their neighbours."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in range(b.num_rows):
                own = b.column(0)[r].values.to_numpy(zero_copy_only=False).reshape(-1, dims + 1)
                other = b.column(1)[r].values.to_numpy(zero_copy_only=False).reshape(-1, dims + 1)
                for low in range(0, len(own), LEAF):
                    a = own[low:low + LEAF]
                    square = np.zeros((len(a), len(other)))
                    for i in range(dims):
                        square += (a[:, i][:, None] - other[:, i][None, :]) ** 2
                    same = np.all(a[:, None, :dims] == other[None, :, :dims], axis=2)
                    weight = np.where(same, other[None, :, dims] - 1, other[None, :, dims])
                    order = np.argsort(square, axis=1, kind="stable")
                    total = np.cumsum(np.take_along_axis(weight, order, 1), axis=1)
                    kth = np.argmax(total >= min(k, int(total[0, -1])), axis=1)
                    limit = np.take_along_axis(square, np.take_along_axis(order, kth[:, None], 1), 1)
                    i, j = np.nonzero((square <= limit) & (weight > 0))

                    def points(x, rows):
                        at = pa.array(np.arange(len(rows) + 1) * dims, pa.int32())
                        return pa.ListArray.from_arrays(at, pa.array(x[rows, :dims].ravel()))
                    yield pa.RecordBatch.from_arrays(
                        [points(a, i), pa.array(np.sqrt(limit[i, 0])), points(other, j), pa.array(np.sqrt(square[i, j])),
                         pa.array(weight[i, j])], names=["p", "k_distance", "o", "distance", "w"])
    return run


def nearest(df: DataFrame, features: Sequence[str], k: int) -> DataFrame:
    """``(p, k_distance, o, distance, w)``: for each distinct location ``p`` of the features its neighbouring locations
    ``o`` within the distance of the k-th nearest other row (ties included; all rows if there are fewer), with the
    number of other rows ``w`` there.  Rows with a null, NaN or infinite feature take no part."""
    dims = len(features)
    active = written(_locations(df, features).withColumn("id", _cell(0)), "active")
    cells = written(_boxes(active, dims, _cell(0)), "cells")
    state = cells.select(F.col("id").alias("q"), F.col("id").alias("c"))
    leaves, level = None, 0
    while True:
        big = cells.where((F.col("locations") > LEAF) & F.lit(level < BITS)).select("id")
        done = active.join(big, "id", "left_anti").select("id", "p", "w")
        leaves = done if leaves is None else leaves.union(done)
        active = written(active.join(big, "id", "left_semi"), "active")
        if active.isEmpty():
            break
        level += 1
        x = active.withColumn("id", _cell(level))
        grown = _boxes(x, dims, _cell(level - 1))
        cells = written(cells.join(big, "id", "left_anti").withColumn("parent", F.col("id")).unionByName(grown), "cells")
        state = written(_descended(state, cells, dims, k), "cell_pairs")
        active = x
    packed = written(leaves.groupBy("id").agg(F.flatten(F.collect_list(F.concat("p", F.array(F.col("w").cast("double"))))).alias("at")),
                     "leaves")
    met = state.join(packed.toDF("c", "other"), "c").groupBy("q").agg(F.flatten(F.collect_list("other")).alias("other"))
    met = met.join(packed.toDF("q", "own"), "q").select("own", "other")
    return met.mapInArrow(_pairs(dims, k), "p array<double>, k_distance double, o array<double>, distance double, w double")


def local_outlier_factor(df: DataFrame, features: Sequence[str], keys: Sequence[str], k: int = 20,
                         contamination: float = 0.05) -> DataFrame:
    """``(keys..., k_distance, lof, outlier)`` of every row whose features are all finite.

    The k-distance neighbourhood of a row holds all other rows as near as its k-th nearest one.  The reachability of a
    neighbour is the larger of its own k-distance and its distance; the local density is one over the mean reachability
    (plus 1e-10, so that more than k equal rows have a finite one); the factor is the mean density of the neighbours over
    the row's own.  Outliers lie above the ``1 - contamination`` quantile of all factors.  A row without any other has
    neither a factor nor a flag."""
    pairs = written(nearest(df, features, k), "neighbours")
    own = pairs.groupBy("p").agg(F.first("k_distance").alias("k_distance"))
    reach = pairs.join(own.toDF("o", "ok"), "o").groupBy("p").agg(
        (1 / (F.sum(F.col("w") * F.greatest("ok", "distance")) / F.sum("w") + 1e-10)).alias("density"))
    reach = written(reach, "density")
    mean = pairs.join(reach.toDF("o", "od"), "o").groupBy("p").agg(
        F.first("k_distance").alias("k_distance"), (F.sum(F.col("w") * F.col("od")) / F.sum("w")).alias("mean"))
    factor = mean.join(reach, "p").select("p", "k_distance", (F.col("mean") / F.col("density")).alias("lof"))
    x = df.select(*[col(c) for c in keys], F.array(*[col(f).cast("double") + F.lit(0.0) for f in features]).alias("_p"))
    x = x.where(F.forall("_p", lambda v: F.coalesce(_finite(v), F.lit(False))))
    x = written(x.join(factor.withColumnRenamed("p", "_p"), "_p", "left").drop("_p"), "lof")
    cut = scalar_row(quantile_table(x, ["lof"], [1 - contamination]).agg(F.max(F.col("q")[0]).alias("cut")))["cut"]
    return x.select(*[col(c) for c in keys], "k_distance", "lof", (F.col("lof") > cut).cast("int").alias("outlier"))


# ------------------------------------------------------------ k-NN mutual information
def digamma_count(n: Column) -> Column:
    """Digamma of a positive count: asymptotic series ten places up, and the recurrence down."""
    x = n.cast("double") + 10
    y = 1 / (x * x)
    series = F.log(x) - 0.5 / x - y * (1 / 12 - y * (1 / 120 - y * (1 / 252 - y * (1 / 240 - y / 132))))
    for j in range(10):
        series = series - 1 / (n.cast("double") + j)
    return series


def _class_radius(cells: DataFrame, k: int) -> DataFrame:
    """Adds ``r``: the distance from a cell's value to the ``min(k, nc - 1)``-th nearest other row of its class."""
    x = haloed(cells, "x", k, k, by=["feature", "y"])
    w = Window.partitionBy("feature", "y", "_block").orderBy("x")
    here = F.collect_list(F.struct("x", "n"))
    x = x.withColumn("near", F.concat(here.over(w.rowsBetween(-k, -1)), here.over(w.rowsBetween(1, k))))
    away = F.transform("near", lambda c: F.struct(F.abs(c["x"] - F.col("x")).alias("d"), c["n"].alias("n")))
    away = F.array_sort(F.concat(F.array(F.struct(F.lit(0.0).alias("d"), (F.col("n") - 1).alias("n"))), away))
    want = F.least(F.lit(k), F.col("nc") - 1)
    zero = F.struct(F.lit(0).cast("long").alias("s"), F.lit(None).cast("double").alias("r"))
    r = F.aggregate(away, zero, lambda acc, c: F.struct(
        (acc["s"] + c["n"]).alias("s"), F.coalesce(acc["r"], F.when(acc["s"] + c["n"] >= want, c["d"])).alias("r")), lambda acc: acc["r"])
    return x.withColumn("r", r).where("not _halo").select("feature", "y", "x", "n", "nc", want.alias("k"), "r")


def mi_knn(df: DataFrame, numeric: Sequence[str], y: Column, k: int = 3, fill: float | None = 0.0) -> DataFrame:
    """``(feature, mi, rank)``, the nearest-neighbour estimate of mutual information (nats) between each numeric
    feature and a class label (Ross 2014): digamma(N) + <digamma(k)> - <digamma(n_class)> - <digamma(m)>, where ``m``
    counts the rows of all classes nearer than the k-th nearest row of the same class, the row itself included.

    Classes of one row are left out.  Null features count as ``fill`` (None leaves the rows out), null labels are left
    out, as are NaN and infinite features.  Where more than k rows of a class share a value its distance is 0; then k is
    their number and m that of all rows with the value (the rule for mixed distributions; adding random noise, as some
    libraries do, tends to the same).  Distances closer than four units in the last place are equal.

    Work is on cells of (feature, class, value).  The distance to the k-th row needs k cells to each side (blocks that
    carry k cells of their neighbours); the counts are differences of prefix sums at both ends of each cell's range."""
    fills = [F.coalesce(col(f).cast("double"), F.lit(fill)) if fill is not None else col(f).cast("double") for f in numeric]
    t = df.select(y.cast("string").alias("y"), *[(c + F.lit(0.0)).alias(f) for c, f in zip(fills, numeric, strict=True)])
    t = t.unpivot(["y"], [col(f) for f in numeric], "feature", "x").where(F.col("y").isNotNull() & _finite(F.col("x")))
    cells = written(t.groupBy("feature", "y", "x").agg(F.count("*").alias("n")), "cells")
    classes = cells.groupBy("feature", "y").agg(F.sum("n").alias("nc")).where("nc > 1")
    x = _class_radius(cells.join(classes, ["feature", "y"]), k)
    blur = (F.abs("x") + F.col("r")) * 2.0 ** -50
    tie = F.col("r") <= blur
    x = x.withColumn("low", F.when(tie, F.col("x")).otherwise(F.col("x") - F.col("r") + blur)).withColumn(
        "high", F.when(tie, F.col("x")).otherwise(F.col("x") + F.col("r") - blur)).withColumn("k", F.when(tie, F.col("n")).otherwise(F.col("k")))
    x = written(x, "ranges")
    nothing = F.lit(0).cast("long").alias("n")
    ends = x.select("feature", F.col("x").alias("at"), "n").union(x.select("feature", "low", nothing)).union(
        x.select("feature", "high", nothing)).groupBy("feature", "at").agg(F.sum("n").alias("n"))
    sums = written(running_sum(ends, ["at"], "n", by=["feature"], out="upto").select("feature", "at", "n", "upto"), "prefix")
    x = x.join(sums.select("feature", F.col("at").alias("high"), F.col("upto").alias("high_n")), ["feature", "high"]).join(
        sums.select("feature", F.col("at").alias("low"), (F.col("upto") - F.col("n")).alias("low_n")), ["feature", "low"])
    score = digamma_count(F.col("k")) - digamma_count(F.col("nc")) - digamma_count(F.col("high_n") - F.col("low_n"))
    out = x.groupBy("feature").agg(F.sum("n").alias("rows"), F.sum(F.col("n") * score).alias("s"))
    out = out.select("feature", F.greatest(digamma_count(F.col("rows")) + F.col("s") / F.col("rows"), F.lit(0.0)).alias("mi"))
    return out.withColumn("rank", F.row_number().over(Window.orderBy(F.col("mi").desc(), F.col("feature"))).cast("bigint"))  # a row per feature
