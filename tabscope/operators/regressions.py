"""Multinomial logistic regressions of all folds in one pass over the rows a step (variant benchmark of large tables).

Spark ML fits a fold a call, each of which passes over its rows some 50 times.  The regression without a penalty has one optimum
(its predictions are unique even if columns depend on each other), so here Newton's method goes to it: a pass sums loss, gradient
and Hessian of the rows outside each fold, for all folds at once, and a few passes settle them.  What comes to the driver is a
table of folds x coefficients x coefficients from each task.
"""

from __future__ import annotations

import sys
from collections.abc import Sequence

from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# tasks get the functions of this module with their data: workers need not find the library
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Coefficients of a fold up to which a Hessian is summed; more are left to Spark ML.
MOST = 400


def _sums(x, y, own, beta, where=None):
    """``(losses, gradients, Hessians, hits)`` of rows ``x`` (with a last column of ones), classes ``y`` and folds ``own`` at
    ``beta`` [column][fold][class but the last]; hits [fold][class][predicted class] are those of a fold's own rows."""
    import numpy as np
    (d, folds, most), n = beta.shape, len(x)
    up, down = np.triu_indices(d)
    score = np.concatenate([(x @ beta.reshape(d, -1)).reshape(n, folds, most), np.zeros((n, folds, 1))], 2)
    rows = np.arange(n)
    hits = np.zeros((folds, most + 1, most + 1), np.int64)
    np.add.at(hits, (own, y, score[rows, own].argmax(1)), 1)
    score -= score.max(2, keepdims=True)
    p = np.exp(score)
    total = p.sum(2, keepdims=True)
    p /= total
    held = (own[:, None] != np.arange(folds)).astype(float)
    loss = ((np.log(total[:, :, 0]) - score[rows, :, y]) * held).sum(0)
    p, seen = p[:, :, :most], (y[:, None] == np.arange(most))[:, None, :]
    gradient = x.T @ ((p - seen) * held[:, :, None]).reshape(n, -1)
    a, b = np.triu_indices(most)
    w = (p[:, :, a] * ((a == b) - p[:, :, b])) * held[:, :, None]
    hessian = w.reshape(n, -1).T @ (x[:, up] * x[:, down])
    return loss, gradient, hessian, hits


def _whole(packed, d: int, most: int):
    """The Hessian of a fold, (column, class) by (column, class), from its upper halves."""
    import numpy as np
    (up, down), (a, b) = np.triu_indices(d), np.triu_indices(most)
    out = np.zeros((d, most, d, most))
    for k in range(len(a)):
        for i, j in ((a[k], b[k]), (b[k], a[k])):
            out[up, i, down, j] = out[down, i, up, j] = packed[k]
    return out.reshape(d * most, d * most)


def fold_hits(rows: DataFrame, features: Sequence[str], classes: int, folds: int, max_iter: int = 50,
              tol: float = 1e-8) -> list[tuple[int, int, int, int]] | None:
    """``(fold, class, predicted class, rows)`` of rows with ``label`` (0, 1...) and ``_fold`` by the regression that left their fold
    out.  A fold is done when the next step would lower its loss by less than ``tol`` of it.  None: too many coefficients."""
    import numpy as np
    import pandas as pd
    d, most = len(features) + 1, classes - 1
    if d * most > MOST:
        return None
    spark = rows.sparkSession
    every = [F.count(F.lit(1)).alias("n"), *[F.avg(f).alias(f"m{i}") for i, f in enumerate(features)],
             *[F.var_pop(f).alias(f"v{i}") for i, f in enumerate(features)], *[F.min(f).alias(f"a{i}") for i, f in enumerate(features)],
             *[F.max(f).alias(f"z{i}") for i, f in enumerate(features)], *[F.count_if(F.col("label") == c).alias(f"c{c}") for c in range(classes)]]
    seen = [r.asDict() for r in rows.groupBy("_fold").agg(*every).collect()]
    if not seen:
        return []
    if most == 0:
        return [(int(r["_fold"]), 0, 0, r["n"]) for r in seen]

    def of(letter, kinds):
        return np.array([[float(r[f"{letter}{i}"]) for i in range(kinds)] for r in seen])
    n, mean, var, low, high = np.array([float(r["n"]) for r in seen])[:, None], *(of(c, d - 1) for c in "mvaz")
    if not np.isfinite(mean).all() or not np.isfinite(var).all():
        raise ValueError("a feature is null, NaN or infinite")
    mid = (n * mean).sum(0) / n.sum()
    scale = np.sqrt((n * (var + (mean - mid) ** 2)).sum(0) / n.sum())
    scale = np.where(scale > 0, scale, 1.0)
    at = np.array([r["_fold"] for r in seen])
    # a column that is constant outside a fold has no coefficient there, as in Spark ML
    varies = np.ones((folds, d), bool)
    start = np.zeros((d, folds, most))
    trained = np.zeros(folds)
    for k in range(folds):
        out = at != k
        if out.any():
            varies[k, :-1] = low[out].min(0) < high[out].max(0)
            counts = of("c", classes)[out].sum(0)
            trained[k] = counts.sum()
            start[-1, k] = np.log((counts[:-1] + 1) / (counts[-1] + 1))

    def evaluate(beta):
        state = spark.sparkContext.broadcast((beta, mid, scale))

        def run(frames):
            beta, mid, scale = state.value
            got = None
            for pdf in frames:
                x = np.ones((len(pdf), d))
                x[:, :-1] = (pdf.iloc[:, :d - 1].to_numpy(np.float64) - mid) / scale
                new = _sums(x, pdf["label"].to_numpy(np.intp), pdf["_fold"].to_numpy(np.intp), beta)
                got = new if got is None else tuple(p + q for p, q in zip(got, new))
            if got is not None:
                yield pd.DataFrame([tuple(np.ascontiguousarray(p).tobytes() for p in got)], columns=["loss", "gradient", "hessian", "hits"])
        parts = rows.select(*[F.col(f).cast("double") for f in features], F.col("label").cast("int"), F.col("_fold").cast("int")).mapInPandas(
            run, "loss binary, gradient binary, hessian binary, hits binary").collect()
        state.unpersist()
        loss, gradient, hessian, hits = (sum(np.frombuffer(bytes(r[c]), t) for r in parts) for c, t in (
            ("loss", float), ("gradient", float), ("hessian", float), ("hits", np.int64)))
        return loss, gradient.reshape(d, folds, most), hessian.reshape(folds, -1, d * (d + 1) // 2), hits.reshape(folds, classes, classes)

    best, held, trial = start.copy(), np.full(folds, np.inf), start.copy()
    hits, open_, halved = np.zeros((folds, classes, classes), np.int64), trained > 0, np.zeros(folds, int)
    for _ in range(max_iter + 1):
        loss, gradient, hessian, got = evaluate(trial)
        for k in np.flatnonzero(open_):
            if not loss[k] <= held[k] * (1 + 1e-12):
                # a step too far: half of it
                halved[k] += 1
                trial[:, k] = (trial[:, k] + best[:, k]) / 2
                open_[k] = halved[k] < 30
                continue
            best[:, k], held[k], hits[k], halved[k] = trial[:, k], loss[k], got[k], 0
            free = np.repeat(varies[k], most)
            g = gradient[:, k].reshape(-1)[free]
            step = np.zeros(d * most)
            step[free] = np.linalg.lstsq(_whole(hessian[k], d, most)[np.ix_(free, free)], -g, rcond=1e-12)[0]
            if -g @ step[free] / 2 <= tol * max(loss[k], 1e-12 * trained[k]):
                open_[k] = False
            else:
                trial[:, k] = best[:, k] + step.reshape(d, most)
        if not open_.any():
            break
        trial[:, ~open_] = best[:, ~open_]
    return [(int(k), int(y), int(p), int(hits[k, y, p])) for k, y, p in np.argwhere(hits > 0)]
