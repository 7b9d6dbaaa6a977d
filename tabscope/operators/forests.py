"""Trees of large tables on packed cells (null importance, permutation importance, variant benchmark, boosted importance).

Spark ML fits a forest a call, and every call passes over the rows again for its own trees.  Trees see a row only as its bins, so
rows of equal bins and class are counted once as a cell, and every later step works on cells: a shuffle of a column and
stratified folds are draws without replacement (``deal``), which need no order of the rows.  Cells are stored in parts
(``blobs``), arrays that a task reads whole.  The forests of all runs and folds grow together: a level of all trees is one job.
Tasks count the drawn rows of each tree's nodes by bin and class, one shuffle adds the counts of a tree up, and
tasks pick the splits.  Only splits, as many as parameters allow, come to the driver.

The rules are those of Spark's ``RandomForestClassifier``: every row counts Poisson(1) times in a tree, a node may split on
sqrt(features) of them, Gini gain, splits that change no prediction are pruned, and an importance is the gain times the rows of
a node, each tree and then the forest scaled to 1.  A cell of n rows is drawn Poisson(n) times, which is the draw of
its rows, in steps of 1 / 65,536 for small n.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Sequence
from typing import Any, NamedTuple

from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabscope.functions.exprs import col
from tabscope.plans.blocks import written

# tasks get the functions of this module with their data: workers need not find the library
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Distinct bins that a part holds, bits of a bin in a packed number, and bins in a packed number.
PART = 32_768
BITS, PACK = 6, 10
#: Rows of a part that are dealt one by one; more are dealt cell by cell.
ONE_BY_ONE = 1 << 22


def _levels(df: DataFrame, c: str, most: int | None = None) -> list[str]:
    found = df.select(col(c).cast("string").alias("v")).where("v IS NOT NULL").distinct()
    return sorted(r.v for r in (found if most is None else found.limit(most)).collect())


def packed_rows(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], target: str,
                more: Sequence[str] = ()) -> tuple[DataFrame, list[int], list[str]]:
    """``(_x0..., _y, more...)``: the bins of a row in few whole numbers and its class from 0; the number of bins of every
    feature (the last one of a category is for nulls) and the classes."""
    from tabscope.operators.models import MAX_BINS, _binned, _edges_of
    edges = _edges_of(df, numeric)
    levels = [_levels(df, c, MAX_BINS) for c in categorical]
    if any(len(v) >= MAX_BINS for v in levels):
        raise ValueError(f"a category has {MAX_BINS} values or more")
    classes = _levels(df, target)

    def place(c, values):
        return F.coalesce(F.array_position(F.array(*[F.lit(v) for v in values]).cast("array<string>"), col(c).cast("string")), F.lit(0))
    bins = [F.coalesce(col(c), F.raise_error(F.lit(f"{c} is null or NaN"))).cast("bigint") for c in numeric]
    at = [F.when(p > 0, p - 1).otherwise(len(v)).cast("bigint") for p, v in ((place(c, v), v) for c, v in zip(categorical, levels))]
    y = place(target, classes)
    rows = _binned(df.withColumn("_y", F.when(y > 0, (y - 1).cast("int"))), numeric, edges)
    every = [*bins, *at]
    packs = [sum((F.shiftleft(b, BITS * i) for i, b in enumerate(every[s:s + PACK])), F.lit(0).cast("bigint")).alias(f"_x{s // PACK}")
             for s in range(0, len(every), PACK)]
    sizes = [*[len(e) + 1 for e in edges], *[len(v) + 1 for v in levels]]
    return rows.select(*packs, "_y", *more), sizes, classes


def packed_cells(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], target: str) -> tuple[DataFrame, list[int], list[str]]:
    """``(_x0..., _y, _n)``: the rows of ``packed_rows`` counted, stored."""
    rows, sizes, classes = packed_rows(df, numeric, categorical, target)
    return written(rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("_n")), "cells"), sizes, classes


def _packs(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c.startswith("_x")]


def _parted(cells: DataFrame, keys: Sequence[str], seed: int, times: int = 1) -> tuple[DataFrame, int]:
    """``cells`` with ``_part``, by a hash of ``keys``: about ``PART`` distinct ones (each held ``times``) a part."""
    some = cells.agg(F.approx_count_distinct(F.xxhash64(*keys)).alias("k"), F.sum("_n").alias("n")).first()
    parts = max(1, math.ceil(some["k"] * times / PART), math.ceil((some["n"] or 0) / 2 ** 28))
    return cells.withColumn("_part", F.pmod(F.xxhash64(F.lit(seed), *keys), F.lit(parts)).cast("int")), parts


def _by_part(cells: DataFrame, parts: int):
    return cells.repartition(parts, "_part").groupBy("_part")


def _spread(rng, sizes, n: int):
    """How many of ``n`` members, drawn without replacement, come from groups of ``sizes``: exact under 1e9 members, above by a
    normal law of the same mean and variance."""
    import numpy as np
    left, out = int(sizes.sum()), np.zeros(len(sizes), np.int64)
    if left < 10 ** 9:
        return rng.multivariate_hypergeometric(sizes, n, method="marginals") if left else out
    for i, s in enumerate(sizes.tolist()):
        rest = left - s
        if left < 10 ** 9:
            out[i] = rng.hypergeometric(s, rest, n) if left else 0
        else:
            mean, sd = n * s / left, math.sqrt(max(0.0, n * (s / left) * (rest / left) * ((left - n) / (left - 1))))
            out[i] = min(s, n, max(0, n - rest, round(rng.normal(mean, sd))))
        n, left = n - int(out[i]), rest
    return out


def part_pools(sizes, pool, seed) -> list:
    """The members of ``pool`` (a number a value) that rows of parts of ``sizes`` take in a random permutation: an array a part."""
    import numpy as np
    rng, left, out = np.random.default_rng(seed), np.asarray(pool, np.int64), []
    for n in sizes:
        out.append(_spread(rng, left, int(n)))
        left = left - out[-1]
    return out


def deal(rng, sizes, pool):
    """``[cell][value]``: how often the ``sizes`` rows of each cell take each value, if the members of ``pool`` are shuffled over
    all rows.  The draw is uniform: every order of the members is as likely."""
    import numpy as np
    sizes, pool = np.asarray(sizes, np.int64), np.asarray(pool, np.int64)
    if sizes.sum() != pool.sum():
        raise ValueError("as many members as rows")
    if sizes.sum() <= ONE_BY_ONE:
        values = np.repeat(np.arange(len(pool)), pool)
        rng.shuffle(values)
        return np.bincount(np.repeat(np.arange(len(sizes)) * len(pool), sizes) + values, minlength=len(sizes) * len(pool)).reshape(
            len(sizes), len(pool))
    out, left = np.zeros((len(sizes), len(pool)), np.int64), sizes.copy()
    for v, n in enumerate(pool[:-1].tolist()):
        out[:, v] = _spread(rng, left, n)
        left -= out[:, v]
    out[:, -1] = left
    return out


def fold_pool(n: int, folds: int) -> list[int]:
    """The rows of every fold, as positions mod ``folds`` deal them."""
    return [(n + folds - 1 - k) // folds for k in range(folds)]


BLOB = "_run int, _part int, _codes binary, _of binary, _y binary, _n binary, _kind string"
BLOB_NAMES = [c.split()[0] for c in BLOB.split(", ")]


def _starts(x):
    """Whether each of the sorted rows differs from the one before."""
    import numpy as np
    return np.concatenate([np.ones(min(1, len(x)), bool), (x[1:] != x[:-1]).any(1)])


def _blob(run: int, part: int, x, y, n) -> tuple:
    """A part as arrays: distinct bins, and for each cell (by size) their place, the class and the rows of each fold."""
    import numpy as np
    kind = np.min_scalar_type(int(n.max(initial=0))).str
    keep = np.lexsort(x.T[::-1])
    x, y, n = x[keep], y[keep], n[keep]
    new = _starts(x)
    of, order = np.cumsum(new) - 1, np.argsort(n.sum(1), kind="stable")
    return (run, part, np.ascontiguousarray(x[new]).tobytes(), of[order].astype(np.int32).tobytes(), y[order].astype(np.int32).tobytes(),
            np.ascontiguousarray(n[order].astype(kind)).tobytes(), kind)


def _arrays(frames, n_features: int):
    """``(run, part, bins, of, y, n)`` of each stored part that has cells."""
    import numpy as np
    for pdf in frames:
        for row in pdf.to_dict("records"):
            codes, y = np.frombuffer(row["_codes"], np.int64), np.frombuffer(row["_y"], np.int32).astype(np.intp)
            if len(y):
                yield (row["_run"], row["_part"], unpacked(codes.reshape(-1, math.ceil(n_features / PACK)), n_features),
                       np.frombuffer(row["_of"], np.int32).astype(np.intp), y, np.frombuffer(row["_n"], row["_kind"]).reshape(len(y), -1).astype(np.int64))


def unpacked(codes, n_features: int):
    """``[feature][row]``: the bins of packed rows."""
    import numpy as np
    return np.stack([(codes[:, f // PACK] >> (BITS * (f % PACK))) & (2 ** BITS - 1) for f in range(n_features)]).astype(np.intp)


def _stored(blobs: DataFrame, parts: int) -> DataFrame:
    """``blobs`` stored in files of one part (of a few, if they are many), so that tasks share them evenly."""
    from tabscope.session import scratch_path
    path = scratch_path(blobs.sparkSession, "blobs")
    blobs.write.option("compression", "zstd").option("maxRecordsPerFile", max(1, parts // 1000)).parquet(path)
    return blobs.sparkSession.read.schema(blobs.schema).parquet(path)


def fold_blobs(cells: DataFrame, folds: int, seed: int) -> DataFrame:
    """Stored parts of ``(_x0..., _y, _n, _n0...)`` cells, whose ``_n0...`` count the rows of each fold, as run 0; without folds by ``_n``."""
    import numpy as np
    import pandas as pd
    packs, counts = _packs(cells), [f"_n{k}" for k in range(folds)] or ["_n"]
    cells, parts = _parted(cells, packs, seed)

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame([_blob(0, int(pdf["_part"].iloc[0]), pdf[packs].to_numpy(np.int64), pdf["_y"].to_numpy(),
                                   pdf[counts].to_numpy(np.int64))], columns=BLOB_NAMES)
    return _stored(_by_part(cells, parts).applyInPandas(pack, BLOB), parts)


def run_blobs(cells: DataFrame, runs: Sequence[int], folds: int, classes: int, seed: int) -> DataFrame:
    """Stored parts of cells with a class for every run, with stratified folds (each class in equal parts, at random).  Run 0
    has the true classes; the others permute them, nulls included, over all rows."""
    import numpy as np
    import pandas as pd
    packs = _packs(cells)
    cells, parts = _parted(cells, packs, seed)
    sizes = np.zeros((parts, classes + 1), np.int64)
    for r in cells.groupBy("_part", "_y").agg(F.sum("_n").alias("n")).collect():
        sizes[r["_part"], classes if r["_y"] is None else r["_y"]] = r["n"]
    total = sizes.sum(0)
    folded = [fold_pool(int(n), folds) for n in total[:classes]]
    own = [part_pools(sizes[:, c], folded[c], [seed, 0, c]) for c in range(classes)]
    mixed = {run: part_pools(sizes.sum(1), [*sum(folded, []), int(total[classes])], [seed, run]) for run in runs if run}

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        part, out = int(pdf["_part"].iloc[0]), []
        pdf = pdf.sort_values([*packs, "_y"], na_position="last")
        y, rows = pdf["_y"].fillna(classes).to_numpy(np.intp), pdf["_n"].to_numpy(np.int64)
        x = pdf[packs].to_numpy(np.int64)
        for run in runs:
            rng = np.random.default_rng([seed, run, part])
            if run:
                start = np.flatnonzero(_starts(x))
                got = deal(rng, np.add.reduceat(rows, start), mixed[run][part])[:, :-1].reshape(len(start), classes, folds)
                at, c = np.nonzero(got.sum(-1))
                out.append(_blob(run, part, x[start][at], c, got[at, c]))
            else:
                n = np.zeros((len(x), folds), np.int64)
                for c in range(classes):
                    n[y == c] = deal(rng, rows[y == c], own[c][part])
                out.append(_blob(run, part, x[y < classes], y[y < classes], n[y < classes]))
        return pd.DataFrame(out, columns=BLOB_NAMES)
    return _stored(_by_part(cells, parts).applyInPandas(one, BLOB), parts * len(runs))


class Trees(NamedTuple):
    """Forests [forest][tree][node]: node i has the children 2i + 1 and 2i + 2; no gain: a leaf.  ``counts`` holds the drawn rows
    of each class."""

    feature: Any
    right: Any
    gain: Any
    counts: Any

    @property
    def says(self):
        import numpy as np
        best = self.counts.argmax(-1)
        nodes = self.gain.shape[-1]
        return np.stack([best[:, :, 1::2][:, :, :nodes], best[:, :, 2::2][:, :, :nodes]], -1)


def grow(blobs: DataFrame, sizes: Sequence[int], nominal: int, classes: int, folds: int, num_trees: int, depth: int, seed: int = 42,
         runs: int = 1) -> Trees:
    """A forest on the rows outside each fold of each run (of all rows, without folds).  ``sizes`` holds the bins of the features,
    of which the last ``nominal`` are categories."""
    import numpy as np
    import pandas as pd
    spark = blobs.sparkSession
    held = max(1, folds)
    n_features, width, nodes = len(sizes), max(sizes), 2 ** depth - 1
    # the features that each node may split on, and the splits found so far
    rng = np.random.default_rng([seed, runs])
    may = rng.random((runs * held, num_trees, nodes, n_features)).argsort(-1).argsort(-1) < math.ceil(math.sqrt(n_features))
    live = np.zeros((runs * held, num_trees, nodes), bool)
    live[:, :, 0] = True
    feature = np.zeros((runs * held, num_trees, nodes), np.intp)
    right = np.zeros((runs * held, num_trees, nodes, width), bool)
    gain = np.zeros((runs * held, num_trees, nodes))
    drawn = np.zeros((runs * held, num_trees, 2 * nodes + 1, classes))

    def draw_table(most: int):
        """Row n: Poisson(n) at 65,536 equal steps of probability."""
        k = np.arange(256)
        logs = np.concatenate([[0.0], np.cumsum(np.log(k[1:]))])
        out = np.zeros((most + 1, 65_536), np.uint8)
        for n in range(1, most + 1):
            upto = np.rint(np.cumsum(np.exp(k * math.log(n) - n - logs)) * 65_536).astype(int)
            upto[-1] = 65_536
            out[n] = np.repeat(k, np.diff(upto, prepend=0))
        return out.reshape(-1)

    def asked(level, may, live):
        """``(feature, its nodes of this level)`` whose counts a tree needs."""
        first, wide = 2 ** level - 1, 2 ** level
        need = may[first:first + wide] & live[first:first + wide, None]
        return [(f, np.flatnonzero(need[:, f])) for f in np.flatnonzero(need.any(0))]

    def counter(level, state):
        wide, block = 2 ** level, width * classes

        def count(frames):
            """Drawn rows of the parts of a task by tree, node, bin and class."""
            may, live, feature, right = state.value
            table, sums = None, {}
            for run, part, bins, of, y, n in _arrays(frames, n_features):
                keys = [bins[f][of] * classes + y for f in range(n_features)]
                flat, cells, total = bins.reshape(-1), bins.shape[1], n.sum(1)
                here, most = np.arange(cells), min(127, int(total.max()))
                if table is None or len(table) < (most + 1) << 16:
                    table = draw_table(most)
                for k in range(held):
                    forest, lam = run * held + k, total - n[:, k] if folds else total
                    many = np.flatnonzero(lam > 127)
                    at_row = np.where(lam > 127, 0, lam) << 16
                    for t in range(num_trees):
                        need = asked(level, may[forest, t], live[forest, t])
                        if not need:
                            continue
                        rng = np.random.default_rng([seed, run, k, t, part])
                        w = table.take(at_row + rng.integers(0, 65_536, len(at_row), np.uint16)).astype(np.float64)
                        if len(many):
                            w[many] = rng.poisson(lam[many])
                        node = np.zeros(cells, np.intp)
                        for up in range(level):
                            at = node + (2 ** up - 1)
                            b = flat.take(feature[forest, t].take(at) * cells + here)
                            node = 2 * node + right[forest, t].reshape(-1).take(at * width + b)
                        base = (node * block).take(of) if level else 0
                        got = np.concatenate([np.bincount(base + keys[f], weights=w, minlength=wide * block).reshape(
                            wide, width, classes)[at, :sizes[f]].reshape(-1) for f, at in need])
                        if (forest, t) in sums:
                            sums[forest, t] += got
                        else:
                            sums[forest, t] = got
            for s in range(0, len(sums), 50):
                yield pd.DataFrame([(f, t, x.tobytes()) for (f, t), x in list(sums.items())[s:s + 50]], columns=["forest", "tree", "counts"])
        return count

    def gini(x):
        n = x.sum(-1)
        return 1.0 - (x * x).sum(-1) / np.maximum(n * n, 1e-300), n

    def sides(f, x):
        """Sets of bins that may go left, as rows of truth values."""
        s = len(x)
        if f < n_features - nominal:
            return np.tri(s - 1, s, dtype=bool)
        if classes > 2 and s <= 6:
            return ((np.arange(1, 2 ** (s - 1))[:, None] >> np.arange(s)) & 1).astype(bool)
        rank = np.argsort(np.where(x.sum(1) > 0, gini(x)[0] if classes > 2 else x[:, -1], np.inf), kind="stable")
        return np.tri(s - 1, s, dtype=bool)[:, np.argsort(rank)]

    def better(found, f, h):
        """``(gain, gain times rows, feature, bins that go right, classes left and right)``: ``found`` or the best split of ``f``."""
        if len(h) < 2:
            return found
        left = sides(f, h)
        a = left.astype(float) @ h
        b = h.sum(0) - a
        (ga, na), (gb, nb), (g, n) = gini(a), gini(b), gini(h.sum(0))
        value = np.where((na >= 1) & (nb >= 1), g - (na * ga + nb * gb) / max(n, 1), -1.0)
        i = int(np.argmax(value))
        if value[i] > 0 and (found is None or value[i] > found[0]):
            return float(value[i]), float(value[i] * n), int(f), ~left[i], np.stack([a[i], b[i]])
        return found

    def chooser(level, state):
        first = 2 ** level - 1

        def choose(pdf: pd.DataFrame) -> pd.DataFrame:
            may, live, _, _ = state.value
            out = []
            for (forest, tree), g in pdf.groupby(["forest", "tree"]):
                x, start, found = sum(np.frombuffer(b) for b in g["counts"]), 0, {}
                for f, at in asked(level, may[forest, tree], live[forest, tree]):
                    for j in at.tolist():
                        h = x[start:start + sizes[f] * classes].reshape(-1, classes)
                        start += sizes[f] * classes
                        if level == 0:
                            root = h.sum(0)
                        found[j] = better(found.get(j), f, h)
                if level == 0:
                    out.append((forest, tree, -1, 0.0, 0, b"", root.tobytes()))
                out += [(forest, tree, first + j, s[1], s[2], s[3].astype(np.uint8).tobytes(), s[4].tobytes()) for j, s in found.items() if s]
            return pd.DataFrame(out, columns=["forest", "tree", "node", "gain", "feature", "goes_right", "sides"])
        return choose

    for level in range(depth):
        state = spark.sparkContext.broadcast((may, live, feature, right))
        counts = blobs.mapInPandas(counter(level, state), "forest int, tree int, counts binary")
        splits = counts.groupBy("forest", F.floor(F.col("tree") / 10).alias("_some")).applyInPandas(
            chooser(level, state), "forest int, tree int, node int, gain double, feature int, goes_right binary, sides binary"
        ).collect()  # at most trees x nodes of a level: bounded by parameters
        for r in splits:
            at = (r["forest"], r["tree"], r["node"])
            if r["node"] < 0:
                drawn[at[0], at[1], 0] = np.frombuffer(bytes(r["sides"]))
                continue
            feature[at], gain[at] = r["feature"], r["gain"]
            drawn[at[0], at[1], 2 * at[2] + 1:2 * at[2] + 3] = np.frombuffer(bytes(r["sides"])).reshape(2, classes)
            goes = np.frombuffer(bytes(r["goes_right"]), np.uint8)
            right[at][:len(goes)] = goes
            if level + 1 < depth:
                live[at[0], at[1], 2 * at[2] + 1:2 * at[2] + 3] = True
        state.unpersist()
    return Trees(feature, right, gain, drawn)


def _kept(gain, says):
    """The splits that stay: one whose two sides are leaves that say the same is a leaf."""
    import numpy as np
    split = gain > 0
    forests, trees, nodes = gain.shape

    def leaf(i):
        return ~split[:, :, i] if i < nodes else np.ones((forests, trees), bool)
    for i in range(nodes - 1, -1, -1):
        split[:, :, i] &= ~(leaf(2 * i + 1) & leaf(2 * i + 2) & (says[:, :, i, 0] == says[:, :, i, 1]))
    return split


def importances(feature, gain, says, n_features: int):
    """Importances of forests from the splits of their trees (node i has the children 2i + 1 and 2i + 2; no gain: a leaf).  A split
    whose two sides are leaves that say the same is a leaf."""
    import numpy as np
    split = _kept(gain, says)
    each = np.stack([np.where(split & (feature == f), gain, 0.0).sum(-1) for f in range(n_features)], -1)
    whole = each.sum(-1, keepdims=True)
    forest = np.where(whole > 0, each / np.where(whole > 0, whole, 1), 0).sum(1)
    total = forest.sum(-1, keepdims=True)
    return np.where(total > 0, forest / np.where(total > 0, total, 1), 0)


def _votes_of(trees: Trees) -> tuple:
    """``(feature, right, splits that stay, shares of the classes in a node)``, as tasks need them."""
    import numpy as np
    return trees.feature, trees.right, _kept(trees.gain, trees.says), trees.counts / np.maximum(trees.counts.sum(-1, keepdims=True), 1e-300)


def predictor(votes: tuple):
    """``f(forest, bins) -> classes``: the class with the largest sum of the shares that the leaves of all trees hold."""
    import numpy as np
    feature, right, split, shares = votes
    nodes, width = split.shape[-1], right.shape[-1]

    def predict(forest: int, bins):
        flat, here = bins.reshape(-1), np.arange(bins.shape[1])
        votes = np.zeros((bins.shape[1], shares.shape[-1]))
        for t in range(split.shape[1]):
            node = np.zeros(len(here), np.intp)
            for up in range(int(math.log2(nodes + 1))):
                # a leaf stays where it is; the others are all on level ``up``
                at = np.minimum(node, nodes - 1)
                goes = split[forest, t].take(at) & (node >= 2 ** up - 1)
                if not goes.any():
                    break
                b = flat.take(feature[forest, t].take(at) * len(here) + here)
                node = np.where(goes, 2 * at + 1 + right[forest, t].reshape(-1).take(at * width + b), node)
            votes += shares[forest, t].take(node, 0)
        return votes.argmax(1)
    return predict


def fold_hits(blobs: DataFrame, trees: Trees, n_features: int, classes: int, folds: int) -> list[tuple[int, int, int, int]]:
    """``(fold, class, predicted class, rows)`` of the rows of each fold by the forest that left them out (without folds, fold 0
    has all rows)."""
    import numpy as np
    import pandas as pd
    held = max(1, folds)
    state = blobs.sparkSession.sparkContext.broadcast(_votes_of(trees))

    def count(frames):
        predict, out = predictor(state.value), np.zeros((held, classes, classes), np.int64)
        for _, _, bins, of, y, n in _arrays(frames, n_features):
            for k in range(held):
                got = predict(k, bins)[of]
                np.add.at(out[k], (y, got), n[:, k])
        at = np.argwhere(out > 0)
        yield pd.DataFrame(np.column_stack([at, out[tuple(at.T)]]), columns=["fold", "y", "p", "n"])
    got = blobs.mapInPandas(count, "fold bigint, y bigint, p bigint, n bigint").groupBy("fold", "y", "p").agg(F.sum("n").alias("n"))
    return [tuple(r) for r in got.collect()]


def permuted_hits(cells: DataFrame, f: int, trees: Trees, sizes: Sequence[int], seed: int) -> int:
    """The rows of ``(_x0..., _y, _n)`` whose class is predicted by a forest after an exact random permutation of feature ``f``."""
    import numpy as np
    import pandas as pd
    packs, at, values = _packs(cells), f"_x{f // PACK}", sizes[f]
    shift, n_features = BITS * (f % PACK), len(sizes)
    own = F.shiftright(F.col(at), shift).bitwiseAND(F.lit(2 ** BITS - 1))
    pool = np.zeros(values, np.int64)
    for r in cells.groupBy(own.alias("v")).agg(F.sum("_n").alias("n")).collect():
        pool[r["v"]] = r["n"]
    others = cells.withColumn(at, F.col(at) - F.shiftleft(own, shift)).groupBy(*packs, "_y").agg(F.sum("_n").alias("_n"))
    others, parts = _parted(written(others, "cells"), packs, seed, values)
    rows = np.zeros(parts, np.int64)
    for r in others.groupBy("_part").agg(F.sum("_n").alias("n")).collect():
        rows[r["_part"]] = r["n"]
    pools = part_pools(rows, pool, [seed, f])
    state = cells.sparkSession.sparkContext.broadcast(_votes_of(trees))

    def count(pdf: pd.DataFrame) -> pd.DataFrame:
        part = int(pdf["_part"].iloc[0])
        pdf = pdf.sort_values([*packs, "_y"])
        x, y = pdf[packs].to_numpy(np.int64), pdf["_y"].to_numpy(np.intp)
        new = _starts(x)
        dealt = deal(np.random.default_rng([seed, f, part]), pdf["_n"].to_numpy(np.int64), pools[part])
        cell, v = np.nonzero(dealt)
        seen, back = np.unique((np.cumsum(new) - 1)[cell] * values + v, return_inverse=True)
        bins = unpacked(x[new], n_features)[:, seen // values]
        bins[f] = seen % values
        right = predictor(state.value)(0, bins)[back.reshape(-1)] == y[cell]
        return pd.DataFrame({"n": [int(dealt[cell, v][right].sum())]})
    return _by_part(others, parts).applyInPandas(count, "n bigint").agg(F.sum("n")).first()[0] or 0


#: Bins (distinct cells x features) that one task may hold to boost a fold's trees.
LOCAL = 20_000_000


def boost(bins, n0, n1, sizes: Sequence[int], nominal: int, steps: int, depth: int, rate: float):
    """Importances of boosted trees of two classes from the rows ``n0`` and ``n1`` of each class in cells of ``bins`` [feature][cell].
    The rules are those of Spark's ``GBTClassifier``: the first tree fits the classes as -1 and 1, the others the residuals
    4y / (1 + exp(2yF)); splits by variance among all features, categories in the order of their means; an importance is
    the sum of gain times rows over all trees."""
    import numpy as np
    flat, cells, width = bins.reshape(-1), bins.shape[1], max(sizes)
    here, w, margin, out = np.arange(cells), (n0 + n1).astype(float), np.zeros(cells), np.zeros(len(sizes))
    for step in range(steps):
        up, down = (4 / (1 + np.exp(2 * margin)), -4 / (1 + np.exp(-2 * margin))) if step else (np.ones(cells), -np.ones(cells))
        s = n1 * up + n0 * down
        least = 1e-12 * float((n1 * up * up + n0 * down * down).sum())
        node, live, value = np.zeros(cells, np.intp), np.ones(1, bool), np.array([s.sum() / max(w.sum(), 1e-300)])
        for level in range(depth):
            wide = 2 ** level
            base, gain = node * width, np.zeros(wide)
            feature, right, means = np.zeros(wide, np.intp), np.zeros((wide, width), bool), np.zeros((wide, 2))
            for f, size in enumerate(sizes):
                at = base + bins[f]
                a, b = (np.bincount(at, weights=x, minlength=wide * width).reshape(wide, width)[:, :size] for x in (w, s))
                rank = np.broadcast_to(np.arange(size), (wide, size))
                if f >= len(sizes) - nominal:
                    order = np.argsort(np.where(a > 0, b / np.where(a > 0, a, 1), np.inf), axis=1, kind="stable")
                    a, b, rank = np.take_along_axis(a, order, 1), np.take_along_axis(b, order, 1), np.argsort(order, axis=1)
                if size < 2:
                    continue
                n, m = a.sum(1, keepdims=True), b.sum(1, keepdims=True)
                a, b = a.cumsum(1)[:, :-1], b.cumsum(1)[:, :-1]
                ok = (a > 0.5) & (n - a > 0.5)
                left, rest, whole = np.where(ok, a, 1), np.where(ok, n - a, 1), np.maximum(n, 1)
                got = np.where(ok, b * b / left + (m - b) ** 2 / rest - m * m / whole, -1.0)
                i = got.argmax(1)
                best = got[np.arange(wide), i]
                j = np.flatnonzero(live & (best > gain) & (best > least))
                gain[j], feature[j] = best[j], f
                right[j, :size] = rank[j] > i[j, None]
                means[j] = np.stack([(b / left)[j, i[j]], ((m - b) / rest)[j, i[j]]], -1)
            live = gain > 0
            if not live.any():
                break
            np.add.at(out, feature[live], gain[live])
            node = 2 * node + right.reshape(-1).take(node * width + flat.take(feature.take(node) * cells + here))
            value, live = np.where(live[:, None], means, value[:, None]).reshape(-1), np.repeat(live, 2)
        margin += (rate if step else 1.0) * value.take(node)
    return out / out.sum() if out.sum() > 0 else out


def boosted_importances(cells: DataFrame, sizes: Sequence[int], nominal: int, folds: int, steps: int, depth: int, rate: float, seed: int):
    """Importances ``[fold][feature]`` of boosted trees on the rows outside each stratified fold of ``(_x0..., _y, _n)``, one task a
    fold; None if there are more cells than a task may hold."""
    import numpy as np
    import pandas as pd
    n_features = len(sizes)
    if cells.select(*_packs(cells)).distinct().count() * n_features > LOCAL:
        return None
    blobs = run_blobs(cells, [0], folds, 2, seed)
    every = blobs.withColumn("_fold", F.explode(F.array(*[F.lit(k) for k in range(folds)]))).repartitionByRange(folds, "_fold")

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        k, found, rows = int(pdf["_fold"].iloc[0]), [], []
        for _, _, bins, of, y, n in _arrays([pdf.sort_values("_part")], n_features):
            left = n.sum(1) - n[:, k]
            rows.append(np.stack([np.bincount(of, weights=np.where(y == c, left, 0), minlength=bins.shape[1]) for c in (0, 1)]))
            found.append(bins)
        rows, bins = np.concatenate(rows, 1), np.concatenate(found, 1)
        held = rows.sum(0) > 0
        got = boost(np.ascontiguousarray(bins[:, held]), rows[0, held], rows[1, held], sizes, nominal, steps, depth, rate)
        return pd.DataFrame([(k, got.tobytes())], columns=["fold", "gains"])
    found = {r["fold"]: np.frombuffer(bytes(r["gains"])) for r in every.groupBy("_fold").applyInPandas(fit, "fold int, gains binary").collect()}
    return np.array([found[k] for k in range(folds)])
