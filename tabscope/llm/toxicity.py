"""Toxicity: a counterfactual-regularised classifier.

A logistic model over word indicators of the whole text is fitted on labelled rows; for every fitting row that
mentions an identity term, the same text with its identity terms swapped for others of their group is scored too,
and the squared change of the margin is penalised.  Terms that only go along with toxic labels thus get no weight
of their own, and neutral mentions of a group aren't flagged.

* Which words may carry weight is chosen by the contrast of their class counts over all labelled rows that aren't
  held out (the ``features`` strongest; identity terms are always among them).  Texts become words' slots in the scan;
  the slots are joined with the labels once.
* The fit takes at most about ``sample_rows`` labelled rows (a documented bound, half of each class where
  possible): their ids go to the texts, and they reach the driver as feature numbers.
* Every whole text is scored.

Defined cases: null and empty text, or text without words, has no features and gets the score of the bias alone; without
labelled rows of both classes every row gets the smoothed share of label 1; an empty table gives an empty result;
repeated rows score alike; a null doc_id is scored and is not held out.  Other columns are ignored."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabscope.llm import ngrams

SAMPLE_ROWS = 12000
FEATURES = 4096
BITS = 22

# Identity terms by group; a term is swapped for the next one of its group.
IDENTITY_TERMS = (
    ("women", "men"), ("woman", "man"), ("girls", "boys"), ("girl", "boy"), ("female", "male"),
    ("christian", "muslim", "jewish", "hindu", "buddhist", "atheist"),
    ("christians", "muslims", "jews", "hindus", "buddhists", "atheists"),
    ("black", "white", "asian", "latino", "african", "european"),
    ("gay", "straight", "lesbian", "bisexual", "transgender"),
    ("immigrants", "refugees", "foreigners", "natives"),
    ("deaf", "blind", "disabled", "elderly", "young"),
    ("american", "mexican", "chinese", "indian", "german", "french", "spanish", "polish"),
    ("frauen", "männer"), ("femmes", "hommes"), ("mujeres", "hombres"),
    ("christen", "muslime", "juden"), ("chrétiens", "musulmans", "juifs"), ("cristianos", "musulmanes", "judíos"),
)


def swaps(groups: Sequence[Sequence[str]] = IDENTITY_TERMS) -> dict[str, str]:
    return {t: g[(i + 1) % len(g)] for g in groups for i, t in enumerate(g)}


def swapped(text: str, terms: dict[str, str]) -> str:
    """The text with every identity term replaced (whole words, any case)."""
    pattern = r"(?<![^\W_])(?:" + "|".join(sorted(map(re.escape, terms), key=len, reverse=True)) + r")(?![^\W_])"
    return re.sub(pattern, lambda m: terms[m[0].lower()], text, flags=re.IGNORECASE)


def _kernel(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return ngrams.word_grams(buf, offsets, BITS, most=1)


@dataclass
class Toxicity:
    """``slots``: the hashed words that carry a weight."""

    slots: np.ndarray
    weight: np.ndarray
    bias: float = 0.0
    slope: float = 1.0
    offset: float = 0.0
    _lut: np.ndarray | None = field(default=None, repr=False, compare=False)

    def __getstate__(self):
        return {**self.__dict__, "_lut": None}

    def picked(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """The numbers of the weighted words that each text holds."""
        if self._lut is None:
            self._lut = np.zeros((1 << BITS) + 1, np.int32)
            self._lut[self.slots] = np.arange(1, len(self.slots) + 1)
        for _, _, buf, offsets in ngrams.text_chunks(texts):
            slots, first = _kernel(buf, offsets)
            at = self._lut[slots.ravel()] if len(slots) else np.zeros(0, np.int32)
            hit = np.flatnonzero(at)
            row = np.searchsorted(hit, first)
            for r in range(len(offsets) - 1):
                yield np.unique(at[hit[row[r]:row[r + 1]]]) - 1

    def margins(self, texts: pa.Array) -> np.ndarray:
        return np.array([self.weight[f].sum() + self.bias for f in self.picked(texts)], float)

    def scores(self, texts: pa.Array) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.margins(texts) + self.offset, -35, 35)))


def _sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    c = np.concatenate([[0.0], np.cumsum(values)])
    return c[first[1:]] - c[first[:-1]]


def fit_logistic(rows: list[np.ndarray], y: np.ndarray, weight: np.ndarray, twins: list[tuple[int, np.ndarray]],
                 n: int, penalty: float = 4.0, ridge: float = 1e-3, steps: int = 400) -> tuple[np.ndarray, float]:
    """Weights and bias by Adam on: weighted log loss + penalty * mean squared margin change between a row and its
    counterfactual twin ``(row number, features)`` + ridge."""
    weight = weight / weight.sum()
    f = np.concatenate(rows) if rows else np.zeros(0, int)
    first = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(int)
    owner = np.repeat(np.arange(len(rows)), np.diff(first))
    gone = [np.setdiff1d(rows[i], t) for i, t in twins]
    come = [np.setdiff1d(t, rows[i]) for i, t in twins]
    df = np.concatenate(gone + come) if twins else np.zeros(0, int)
    dv = np.concatenate([np.ones(len(g)) for g in gone] + [-np.ones(len(c)) for c in come]) if twins else np.zeros(0)
    dt = np.concatenate([np.full(len(x), i % max(1, len(twins))) for i, x in enumerate(gone + come)]).astype(int) if twins else np.zeros(0, int)
    theta, m, v = np.zeros(n + 1), np.zeros(n + 1), np.zeros(n + 1)
    for step in range(1, steps + 1):
        w = theta[:n]
        p = 1 / (1 + np.exp(-np.clip(_sums(w[f], first) + theta[n], -35, 35)))
        e = weight * (p - y)
        g = np.append(np.bincount(f, weights=e[owner], minlength=n) + ridge * w, e.sum())
        if twins:
            change = np.bincount(dt, weights=dv * w[df], minlength=len(twins))
            g[:n] += 2 * penalty / len(twins) * np.bincount(df, weights=dv * change[dt], minlength=n)
        m = 0.9 * m + 0.1 * g
        v = 0.999 * v + 0.001 * g * g
        theta = theta - 0.05 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-9)
    return theta[:n], float(theta[n])


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", sample_rows: int = SAMPLE_ROWS,
        features: int = FEATURES, penalty: float = 4.0, groups: Sequence[Sequence[str]] = IDENTITY_TERMS,
        seed: int = 23) -> Toxicity:
    slots = ngrams.labelled_slots(docs, labels, label, _kernel, BITS)
    n1, n0 = (int(x or 0) for x in slots.agg(F.sum("y"), F.sum(1 - F.col("y"))).first())
    if not n0 or not n1:
        return Toxicity(np.zeros(0, int), np.zeros(0), slope=0.0, offset=float(np.log((n1 + 1) / (n0 + 1))))
    counts = ngrams.class_counts(slots, BITS).where(F.col("f") < 1 << BITS)
    p, q = F.col("n1") / n1, F.col("n0") / n0
    both = (F.col("n1") + F.col("n0") + 1) / (n1 + n0 + 2)
    z = F.abs(p - q) / F.sqrt(both * (1 - both) * (1 / n1 + 1 / n0))
    best = [r["f"] for r in counts.where("n0 + n1 > 1").select("f", z.alias("z")).orderBy(F.desc("z"), "f").limit(features).collect()]
    terms = swaps(groups)
    words = sorted({*terms, *terms.values()})
    own = [int(s.ravel()[i]) for s, _ in [_kernel(*_buffer(words))] for i in range(len(words))]
    model = Toxicity(np.array(sorted({*best, *own}), dtype=np.int64), np.zeros(len({*best, *own})))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            other = pa.array([swapped(t or "", terms) for t in b.column(1).to_pylist()], pa.string())
            pack = [pa.array([f.astype(np.int32).tobytes() for f in model.picked(x)], pa.binary()) for x in (b.column(1), other)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), *pack], names=["doc_id", "y", "own", "twin"])
    rows = ngrams.labelled_texts(docs, ngrams.sampled(slots.select("doc_id", "y"), n0, n1, sample_rows, seed))
    got = rows.mapInArrow(run, "doc_id long, y int, own binary, twin binary").toArrow()
    got = got.sort_by([("doc_id", "ascending")])
    own, twin = ([np.frombuffer(x.as_py(), np.int32).astype(int) for x in got[c]] for c in ("own", "twin"))
    y = got["y"].to_numpy().astype(int)
    share = np.array([(y == 0).sum() / n0, (y == 1).sum() / n1])
    weight = 1 / np.maximum(share, 1e-9)[y]
    learn = np.arange(len(y)) % 5 != 0  # the rest sets the curve
    pick = np.flatnonzero(learn)
    twins = [(k, twin[i]) for k, i in enumerate(pick) if not np.array_equal(own[i], twin[i])]
    model.weight, model.bias = fit_logistic([own[i] for i in pick], y[pick], weight[pick], twins, len(model.slots), penalty)
    rest = np.flatnonzero(~learn)
    margin = np.array([model.weight[own[i]].sum() + model.bias for i in rest])
    model.slope, model.offset = ngrams.calibrated(margin, y[rest], weight[rest])
    return model


def _buffer(words: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    enc = [w.encode() for w in words]
    return np.frombuffer(b"".join(enc), np.uint8), np.concatenate([[0], np.cumsum([len(e) for e in enc])])


def score(docs: DataFrame, model: Toxicity) -> DataFrame:
    """``(doc_id, score)``: higher means that label 1 is likelier."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(model.scores(b.column(1)), pa.float64())],
                                             names=["doc_id", "score"])
    return ngrams.narrow(docs, "doc_id", "text").mapInArrow(run, "doc_id long, score double")


def classify(docs: DataFrame, labels: DataFrame, label: str = "toxic", threshold: float = 0.5, **params) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` of every document."""
    s = score(docs, fit(docs, labels, label, **params))
    return s.select("doc_id", ngrams.held_out().alias("held_out"), "score",
                    (F.col("score") >= threshold).cast("int").alias("predicted"))
