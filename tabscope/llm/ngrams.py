"""Hashed n-gram indicators of whole texts, class counts over all labelled rows, and bounded fitting samples:
what the quality and the toxicity classifier share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabscope.llm.common import LOWER, SPACE, U64, PrefixHash, mix, narrow, stored, text_chunks, word_spans

#: Features are hashed to 2**BITS slots.
BITS = 18
SALTS = [U64(x) for x in (0x9FB21C651E98DF25, 0xD2B74407B1CE6E93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB,
                          0x8EBC6AF09C88C6E3, 0x589965CC75374CC3, 0x1D8E4E27C47D124F)]

#: Bytes outside words for the word features: all ASCII but letters, digits and the apostrophe.
NO_LETTER = np.zeros(256, dtype=bool)
NO_LETTER[[b for b in range(128) if not chr(b).isalnum() and b != 39]] = True

#: Shape of a byte: letters by case (bytes outside ASCII count as lower case), digits, others as they are.
SHAPE = np.arange(256, dtype=np.uint8)
SHAPE[97:123] = ord("a")
SHAPE[128:] = ord("a")
SHAPE[65:91] = ord("A")
SHAPE[48:58] = ord("0")

Kernel = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


def _slots(h: np.ndarray, salt: int, bits: int) -> np.ndarray:
    return (mix(h ^ SALTS[salt]) >> U64(64 - bits)).astype(np.int32)


def _follows(row: np.ndarray, n: int) -> np.ndarray:
    """Whether the n-gram that starts at a token lies within one row."""
    ok = np.zeros(len(row), dtype=bool)
    if len(row) >= n:
        ok[:len(row) - n + 1] = row[n - 1:] == row[:len(row) - n + 1]
    return ok


def _gram(h: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros_like(h)
    m = len(h) - n + 1
    if m > 0:
        for i in range(n):
            out[:m] += h[i:i + m] * SALTS[i]
    return mix(out)


def _by_row(columns: list[np.ndarray], row: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    return np.stack(columns, axis=1) if len(row) else np.zeros((0, 1), np.int32), np.searchsorted(row, np.arange(rows + 1))


def word_grams(buf: np.ndarray, offsets: np.ndarray, bits: int = BITS, most: int = 2) -> tuple[np.ndarray, np.ndarray]:
    """Slots of the lower-case word 1- to ``most``-grams at each word, and where each row's words begin.
    Grams that would cross a row's end have the slot 2**bits."""
    start, end, row = word_spans(buf, offsets, NO_LETTER)
    h = PrefixHash(LOWER[buf]).of(start, end) if len(start) else np.zeros(0, U64)
    out = [_slots(h, 0, bits)]
    for n in range(2, most + 1):
        out.append(np.where(_follows(row, n), _slots(_gram(h, n), n - 1, bits), 1 << bits).astype(np.int32))
    return _by_row(out, row, len(offsets) - 1)


def shape_grams(buf: np.ndarray, offsets: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Slots of the 1- to 3-grams of token shapes and of the lower-case tokens themselves.  A token's shape is
    its bytes by kind with runs taken as one (``Aa``, ``A!``, ``a*``, ``|``) and whether it repeats the token
    before it."""
    start, end, row = word_spans(buf, offsets, SPACE)
    rows = len(offsets) - 1
    if not len(start):
        return _by_row([], row, rows)
    h = PrefixHash(LOWER[buf]).of(start, end)
    kinds = SHAPE[buf]
    fresh = np.concatenate([[True], kinds[1:] != kinds[:-1]])
    fresh[start] = True
    at = np.concatenate([[0], np.cumsum(fresh)])
    shape = PrefixHash(kinds[fresh]).of(at[start], at[end])
    again = np.concatenate([[False], (h[1:] == h[:-1]) & (row[1:] == row[:-1])])
    shape = mix(shape ^ (again.astype(U64) * SALTS[6]))
    out = [_slots(shape, 3, bits), _slots(h, 0, bits)]
    for n in (2, 3):
        out.append(np.where(_follows(row, n), _slots(_gram(shape, n), n + 2, bits), 1 << bits).astype(np.int32))
    return _by_row(out, row, rows)


class Marks:
    """Distinct slots of a row, by marking (no sort)."""

    def __init__(self, bits: int = BITS):
        self.on = np.zeros((1 << bits) + 1, dtype=bool)

    def distinct(self, slots: np.ndarray) -> np.ndarray:
        s = slots.ravel()
        if len(s) * 16 < len(self.on):
            s = np.unique(s)
            return s[:-1] if len(s) and s[-1] == len(self.on) - 1 else s
        self.on[s] = True
        self.on[-1] = False
        out = np.flatnonzero(self.on)
        self.on[out] = False
        return out


def rows_of(texts: pa.Array, kernel: Kernel, bits: int = BITS) -> Iterator[np.ndarray]:
    """The distinct feature slots of each text."""
    marks = Marks(bits)
    for _, _, buf, offsets in text_chunks(texts):
        slots, first = kernel(buf, offsets)
        for r in range(len(offsets) - 1):
            yield marks.distinct(slots[first[r]:first[r + 1]])


def held_out(doc_id: str = "doc_id", folds: int = 5) -> Column:
    """Whether a row's label is held back: crc32 of the doc_id as text, modulo ``folds``, is 0 (false for null)."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds == 0, F.lit(False))


def label_rows(labels: DataFrame, label: str) -> DataFrame:
    """``(id, y)`` that may be learned from: labelled 0 or 1, not held out.  Labels that differ for one doc_id count as
    their maximum."""
    y = narrow(labels, "doc_id", label).toDF("id", "y").where("y in (0, 1) and id is not null")
    return y.where(~held_out("id")).groupBy("id").agg(F.max("y").cast("int").alias("y"))


def labelled_texts(docs: DataFrame, picked: DataFrame) -> DataFrame:
    """``(doc_id, text, y)`` of a sample ``(doc_id, y)``, which is small by its bound: it goes to the texts."""
    d = narrow(docs, "doc_id", "text")
    picked = picked.select(F.col("doc_id").alias("id"), "y").distinct()
    return d.join(F.broadcast(picked), d["doc_id"] == picked["id"]).select("doc_id", "text", "y")


def _pack(slots: np.ndarray) -> bytes:
    """Sorted distinct slots as gaps of two bytes, or four where one is wider."""
    gaps = np.diff(slots, prepend=0)
    wide = len(gaps) and gaps.max() >= 1 << 16
    return bytes([4 if wide else 2]) + gaps.astype(np.uint32 if wide else np.uint16).tobytes()


def unpack(data: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(data, np.uint32 if data[0] == 4 else np.uint16, offset=1), dtype=np.int64)


def labelled_slots(docs: DataFrame, labels: DataFrame, label: str, kernel: Kernel, bits: int = BITS) -> DataFrame:
    """``(doc_id, y, slots)`` of the labelled rows, stored.  Texts become slots in the scan, so slots are what the join
    with the labels moves, once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            slots = pa.array([_pack(s) for s in rows_of(b.column(1), kernel, bits)], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column(0), slots], names=["doc_id", "slots"])
    d, y = narrow(docs, "doc_id", "text").where("doc_id is not null"), label_rows(labels, label)
    d = d.mapInArrow(run, "doc_id long, slots binary")
    return stored(d.join(y, d["doc_id"] == y["id"]).select("doc_id", "y", "slots"), "labelled")


def class_counts(rows: DataFrame, bits: int = BITS) -> DataFrame:
    """``(f, n0, n1)``: how many of the rows ``(y, slots)`` of class 0 and of class 1 hold each feature, over all rows;
    slot 2**bits counts the rows themselves.  Tasks count before the shuffle."""
    def counted(parts: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        f, n = np.unique(np.concatenate(parts), return_counts=True)  # slot * 2 + class
        y = f & 1
        yield pa.RecordBatch.from_arrays([pa.array(f >> 1), pa.array(np.where(y == 0, n, 0)), pa.array(np.where(y == 1, n, 0))],
                                         names=["f", "n0", "n1"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for b in batches:
            for y, slots in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                parts.append(np.append(unpack(slots), 1 << bits) * 2 + y)
                held += len(parts[-1])
                if held > 1 << 22:
                    yield from counted(parts)
                    parts, held = [], 0
        if parts:
            yield from counted(parts)
    return rows.select("y", "slots").mapInArrow(run, "f long, n0 long, n1 long").groupBy("f").agg(
        F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))


def dense_counts(counts: DataFrame, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Counts of both classes as arrays (at most 2**bits + 1 rows reach the driver)."""
    got = counts.toArrow()
    out = np.zeros((2, (1 << bits) + 1))
    f = got["f"].to_numpy()
    out[0, f], out[1, f] = got["n0"].to_numpy(), got["n1"].to_numpy()
    return out[0], out[1]


def sampled(rows: DataFrame, n0: float, n1: float, most: int, seed: int) -> DataFrame:
    """At most about ``most`` rows, half of each class where there are as many, chosen by a hash of doc_id."""
    unit = F.pmod(F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("y")), F.lit(1 << 20)) / (1 << 20)
    a, b = (min(n0, max(most / 2, most - n1)), min(n1, max(most / 2, most - n0)))
    part = F.when(F.col("y") == 0, F.lit(a / max(n0, 1))).otherwise(F.lit(b / max(n1, 1)))
    return rows.where(unit < part)


def calibrated(margin: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve over margins (weighted Newton steps, slightly smoothed targets)."""
    pos, neg = (weight * y).sum(), (weight * (1 - y)).sum()
    if not len(y) or pos <= 0 or neg <= 0:
        p = (pos + 1) / (pos + neg + 2)
        return 0.0, float(np.log(p / (1 - p)))
    t = np.where(y == 1, (pos + 1) / (pos + 2), 1 / (neg + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -35, 35)))
        g, h = weight * (p - t), weight * p * (1 - p) + 1e-12
        ga, gb = (g * margin).sum() + 1e-3 * a, g.sum()
        haa, hab, hbb = (h * margin * margin).sum() + 1e-3, (h * margin).sum(), h.sum()
        det = haa * hbb - hab * hab
        if det <= 1e-12:
            break
        da, db = (hbb * ga - hab * gb) / det, (haa * gb - hab * ga) / det
        step = min(1.0, 5 / (abs(da) + abs(db) + 1e-9))
        a, b = a - step * da, b - step * db
        if abs(da) + abs(db) < 1e-8:
            break
    return float(max(a, 0.0)), float(b)


def scores(docs: DataFrame, kernel: Kernel, margin: Callable[[np.ndarray], float], slope: float, offset: float,
           bits: int = BITS) -> DataFrame:
    """``(doc_id, score)`` of every whole text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            m = np.array([margin(slots) for slots in rows_of(b.column(1), kernel, bits)], float)
            s = 1 / (1 + np.exp(-np.clip(slope * m + offset, -35, 35)))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(s, pa.float64())], names=["doc_id", "score"])
    return narrow(docs, "doc_id", "text").mapInArrow(run, "doc_id long, score double")
