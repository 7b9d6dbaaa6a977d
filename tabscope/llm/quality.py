"""Quality classifier: naive Bayes support vectors (NB-SVM).

N-gram indicators (token-shape 1- to 3-grams and lower-case tokens, hashed) are scaled by the log-count ratios of
the two classes, each row is brought to unit length, and a linear hinge-loss model is fitted on them by dual
coordinate descent; a logistic curve turns margins into scores.

* The class counts behind the ratios cover all labelled rows that aren't held out.
* The support vector fit takes a sample of at most about ``sample_rows`` labelled rows (a documented bound, half of
  each class where possible): it reaches the driver as feature slots.
* Every whole text is scored.

Defined cases: null and empty text, or text without tokens, has no features and gets the score of margin 0; without
labelled rows of both classes every row gets the smoothed share of label 1; an empty table gives an empty result;
repeated rows score alike; a null doc_id is scored and is not held out.  Other columns are ignored."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabscope.llm import ngrams
from tabscope.llm.common import shielded

SAMPLE_ROWS = 8000


@dataclass
class NbSvm:
    ratio: np.ndarray
    weight: np.ndarray
    bias: float
    slope: float = 1.0
    offset: float = 0.0

    def margin(self, slots: np.ndarray) -> float:
        if not len(slots):
            return 0.0
        r = self.ratio[slots]
        return float(self.weight[slots] @ r / (np.sqrt(r @ r) + 1e-9)) + self.bias


def log_count_ratio(n0: np.ndarray, n1: np.ndarray, alpha: float = 1.0) -> np.ndarray:
    p, q = n1 + alpha, n0 + alpha
    return np.log(p / p.sum()) - np.log(q / q.sum())


def dual_coordinate_descent(rows: list[np.ndarray], y: np.ndarray, ratio: np.ndarray, cost: np.ndarray,
                            epochs: int = 12, seed: int = 1) -> tuple[np.ndarray, float]:
    """Weights and bias of min |w|^2 / 2 + sum cost_i * hinge(y_i * w x_i) over unit rows scaled by ``ratio``; the
    bias is the weight of a constant 1.  ``y`` is -1 or 1."""
    xs = []
    for s in rows:
        r = ratio[s]
        xs.append(r / (np.sqrt(r @ r) + 1e-9))
    w, bias, alpha = np.zeros(len(ratio)), 0.0, np.zeros(len(rows))
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        moved = 0.0
        for i in rng.permutation(len(rows)):
            gain = y[i] * (w[rows[i]] @ xs[i] + bias) - 1
            new = min(max(alpha[i] - gain / 2.0, 0.0), cost[i])
            if new != alpha[i]:
                d = (new - alpha[i]) * y[i]
                w[rows[i]] += d * xs[i]
                bias += d
                moved = max(moved, abs(d))
                alpha[i] = new
        if moved < 1e-3:
            break
    return w, bias


def sample_features(rows: DataFrame) -> tuple[list[np.ndarray], np.ndarray]:
    """Feature slots and labels of a bounded sample, on the driver, in the order of doc_id."""
    got = rows.toArrow().sort_by([("doc_id", "ascending")])
    return [ngrams.unpack(x.as_py()) for x in got["slots"]], got["y"].to_numpy().astype(int)


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", sample_rows: int = SAMPLE_ROWS,
        cost: float = 1.0, seed: int = 17) -> NbSvm:
    rows = ngrams.labelled_slots(docs, labels, label, ngrams.shape_grams)
    n0, n1 = ngrams.dense_counts(ngrams.class_counts(rows))
    ratio = log_count_ratio(n0[:-1], n1[:-1])
    model = NbSvm(np.append(ratio, 0.0), np.zeros(len(ratio) + 1), 0.0)
    if not n0[-1] or not n1[-1]:
        model.slope, model.offset = 0.0, float(np.log((n1[-1] + 1) / (n0[-1] + 1)))
        return model
    slots, y = sample_features(ngrams.sampled(rows, n0[-1], n1[-1], sample_rows, seed))
    share = np.array([(y == 0).sum() / n0[-1], (y == 1).sum() / n1[-1]])
    weight = 1 / np.maximum(share, 1e-9)[y] if len(y) else np.zeros(0)
    learn = np.arange(len(y)) % 4 != 0  # the rest sets the curve
    pick = np.flatnonzero(learn)
    model.weight, model.bias = dual_coordinate_descent(
        [slots[i] for i in pick], np.where(y[pick] == 1, 1.0, -1.0), model.ratio, np.full(len(pick), cost))
    rest = np.flatnonzero(~learn)
    model.slope, model.offset = ngrams.calibrated(
        np.array([model.margin(slots[i]) for i in rest]), y[rest], weight[rest])
    return model


def score(docs: DataFrame, model: NbSvm) -> DataFrame:
    """``(doc_id, score)``: higher means that label 1 is likelier."""
    return ngrams.scores(docs, ngrams.shape_grams, model.margin, model.slope, model.offset)


def classify(docs: DataFrame, labels: DataFrame, label: str = "quality", threshold: float = 0.3, **params) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` of every document."""
    s = score(docs, fit(docs, labels, label, **params))
    return s.select("doc_id", ngrams.held_out().alias("held_out"), "score",
                    (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, label: str = "quality", threshold: float = 0.3, **params) -> DataFrame:
    """The documents whose score reaches the threshold, all columns as they were; each row is judged by its own
    text, in the scan."""
    model = fit(docs, labels, label, **params)
    good = F.arrow_udf(_judge(model), "double")
    x, (text,) = shielded(docs, "text")
    return x.where(good(F.col(text)) >= threshold).toDF(*docs.columns)


def _judge(model: NbSvm):
    def run(texts: pa.Array) -> pa.Array:
        m = np.array([model.margin(s) for s in ngrams.rows_of(texts, ngrams.shape_grams)], float)
        return pa.array(1 / (1 + np.exp(-np.clip(model.slope * m + model.offset, -35, 35))), pa.float64())
    run.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    return run
