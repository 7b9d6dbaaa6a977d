"""Periodic runs of words, found on an enhanced suffix array by the branching-tandem test.

A run is a longest stretch of words that keeps its smallest period ``q`` (words ``q`` apart are identical); reported are
those of at least ``least`` words and ``times`` periods.  Words are the runs of ``[^\\x20\\x09-\\x0D]`` of the whole
text.  Documents are independent, so this is one Arrow pass without a shuffle.  For about ``CHUNK_BYTES`` of text at a
time (never a part of a document), with array operations only:

1. Words become numbers of their own for each document (by a dictionary, so equality is exact).  Prefix doubling sorts
   the suffixes; only suffixes that still tie take part in the next doubling.  The ranks of each doubling are kept: they
   answer how far two places agree, forwards or backwards.
2. The longest common prefixes of neighbouring suffixes form intervals.  Each boundary parts its interval of depth ``d``
   into a left and a right side, found by a search over minima of powers of two; there are no tree nodes.
3. Branching-tandem test: for each suffix ``i`` of the smaller side, the inverse suffix array says whether ``i + d`` or
   ``i - d`` lies on the other side.  If so, a square of period ``d`` begins at the earlier one, and no later rotation of
   it is one.  Taking the smaller side makes this O(n log n) tests.
4. Rotating each such square to the left as far as it goes gives its run; of runs over the same words the smallest
   period stays.

Defined cases: null and empty text and text without words has no words and no runs; its collapsed text is empty.  Null
doc_ids are allowed.  Every row is a document of its own, also if repeated.  Very long texts are worked on whole: memory
grows with the words of one document times the logarithm of its longest repeat.  An empty table gives an empty result.
Other columns are ignored, also those with clashing names."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabscope.llm.common import narrow, text_chunks

LEAST, TIMES = 6, 4
#: Suffixes that are tested at once.
SLICE = 1 << 21
SCHEMA = "doc_id long, n_words long, runs array<struct<start long, length long, period long>>, collapsed string"


def doubled_ranks(ids: np.ndarray) -> list[np.ndarray]:
    """Ranks of the substrings of 1, 2, 4, ... words (equal rank: equal substring), until no two are equal; the last ones
    are the inverse suffix array.  Every array has a last entry -1 for the end."""
    n = len(ids)
    order = np.argsort(ids, kind="stable")
    head = np.flatnonzero(np.diff(ids[order], prepend=-1))
    size = np.diff(head, append=n)
    rank = np.full(n + 1, -1, np.int32)
    rank[order] = np.repeat(head, size)
    levels, step = [rank], 1
    active = order[np.repeat(size > 1, size)]
    while len(active):
        follow = rank[np.minimum(active + step, n)]
        order = np.lexsort((follow, rank[active]))
        active, follow = active[order], follow[order]
        old = rank[active]
        group = np.concatenate([[True], old[1:] != old[:-1]])
        part = group | np.concatenate([[True], follow[1:] != follow[:-1]])
        at = np.arange(len(active))
        head, first = np.flatnonzero(part), np.maximum.accumulate(np.where(group, at, 0))
        size = np.diff(head, append=len(active))
        rank = rank.copy()
        rank[active] = old + np.repeat(head, size) - first
        levels.append(rank)
        active, step = active[np.repeat(size > 1, size)], step * 2
    return levels


def agreement(levels: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """How many words from ``i`` on and from ``j`` on are the same."""
    same = np.zeros(len(i), np.int64)
    for k in reversed(range(len(levels))):
        same += (levels[k][i + same] == levels[k][j + same]).astype(np.int64) << k
    return same


def agreement_before(levels: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """How many words before ``i`` and before ``j`` (``i < j``) are the same."""
    same = np.zeros(len(i), np.int64)
    for k in reversed(range(len(levels))):
        a, b = i - same - (1 << k), j - same - (1 << k)
        same += ((a >= 0) & (levels[k][np.maximum(a, 0)] == levels[k][np.maximum(b, 0)])).astype(np.int64) << k
    return same


def sides(lcp: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For boundaries ``at``: the last one before with a smaller value, the first one after that isn't larger."""
    inside = np.diff(np.flatnonzero(np.concatenate([[True], lcp <= 0, [True]]))).max()
    least = [lcp]
    while 1 << len(least) <= inside:
        h = 1 << (len(least) - 1)
        least.append(np.minimum(least[-1][:-h], least[-1][h:]))
    value, left, right = lcp[at], at - 1, at + 1
    for j in reversed(range(len(least))):
        start = left - (1 << j) + 1
        left = left - (((start >= 0) & (least[j][np.maximum(start, 0)] >= value)).astype(np.int64) << j)
        last = len(least[j]) - 1
        right = right + (((right <= last) & (least[j][np.minimum(right, last)] > value)).astype(np.int64) << j)
    return left, right


def branching_squares(levels: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Starts and periods of all squares of which no rotation to the right is one (periods needn't be primitive), but
    for those of intervals with under four suffixes: no run of four periods has them."""
    isa = levels[-1][:-1].astype(np.int64)
    n = len(isa)
    sa = np.empty(n, np.int64)
    sa[isa] = np.arange(n)
    lcp = np.zeros(n + 1, np.int64)
    near = np.flatnonzero(levels[0][sa[:-1]] == levels[0][sa[1:]]) + 1
    starts, periods = [], []
    if len(near):
        lcp[near] = agreement(levels, sa[near - 1], sa[near])
        left, right = sides(lcp, near)
        wide = right - left >= 4
        near, left, right = near[wide], left[wide], right[wide]
        small = near - left <= right - near
        size = np.where(small, near - left, right - near)
        done = np.concatenate([[0], np.cumsum(size)])
        a = 0
        while a < len(near):
            b = max(a + 1, int(np.searchsorted(done, done[a] + SLICE, side="right")) - 1)
            s = slice(a, b)
            of = np.repeat(np.arange(a, b), size[s])
            x = sa[np.arange(len(of)) - (done[of] - done[a]) + np.where(small[of], left[of], near[of])]
            low, high = np.where(small[of], near[of], left[of]), np.where(small[of], right[of], near[of])
            d = lcp[near[of]]
            for y, start in ((x + d, x), (x - d, x - d)):
                place = isa[np.clip(y, 0, n - 1)]
                hit = (y >= 0) & (y < n) & (place >= low) & (place < high)
                starts.append(start[hit])
                periods.append(d[hit])
            a = b
    return (np.concatenate(starts), np.concatenate(periods)) if starts else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def runs_of(ids: np.ndarray, least: int = LEAST, times: int = TIMES) -> np.ndarray:
    """Rows (start, length, period) of the runs in a sequence of numbers from 0, by start, then period."""
    if not len(ids):
        return np.zeros((0, 3), np.int64)
    levels = doubled_ranks(ids)
    start, period = branching_squares(levels)
    back = agreement_before(levels, start, start + period)
    start, length = start - back, 2 * period + back
    keep = length >= np.maximum(least, times * period)
    start, length, period = start[keep], length[keep], period[keep]
    order = np.lexsort((period, length, start))
    start, length, period = start[order], length[order], period[order]
    fresh = np.ones(len(start), bool)
    fresh[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    out = np.stack([start, length, period], axis=1)[fresh]
    return out[np.lexsort((out[:, 2], out[:, 0]))]


def _collapsed(words: list[bytes], runs: np.ndarray) -> bytes:
    gone = np.zeros(len(words) + 1, np.int64)
    np.add.at(gone, runs[:, 0] + runs[:, 2], 1)
    np.add.at(gone, runs[:, 0] + runs[:, 1], -1)
    keep = np.cumsum(gone[:-1]) == 0
    return b" ".join([w for w, k in zip(words, keep.tolist(), strict=True) if k])


def _found(least: int, times: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j, buf, offsets in text_chunks(b.column(1)):
                data, texts, ids, first = buf.tobytes(), [], [], [0]
                for r in range(j - i):
                    words, known, base = data[offsets[r]:offsets[r + 1]].split(), {}, len(ids)
                    ids += [known.setdefault(w, base + len(known)) for w in words]
                    texts.append(words)
                    first.append(len(ids))
                runs = runs_of(np.array(ids, np.int64), least, times)
                at = np.searchsorted(runs[:, 0], first)
                runs[:, 0] -= np.repeat(first[:-1], np.diff(at))
                out = [_collapsed(w, runs[p:q]) if q > p else b" ".join(w)
                       for w, p, q in zip(texts, at[:-1].tolist(), at[1:].tolist(), strict=True)]
                spans = pa.StructArray.from_arrays([pa.array(runs[:, c]) for c in range(3)], names=["start", "length", "period"])
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(i, j - i), pa.array(np.diff(first), pa.int64()),
                     pa.ListArray.from_arrays(pa.array(at, pa.int32()), spans), pa.array(out, pa.binary()).cast(pa.string())],
                    names=["doc_id", "n_words", "runs", "collapsed"])
    return run


def runs(docs: DataFrame, least: int = LEAST, times: int = TIMES) -> DataFrame:
    """``(doc_id, n_words, runs, collapsed)`` for documents ``(doc_id, text)``: the runs by start, then period, and the
    words that no run holds after its first period, joined by a blank.  ``times`` is 4 at least."""
    if times < 4:
        raise ValueError("runs of under four periods aren't searched")
    return narrow(docs, "doc_id", "text").mapInArrow(_found(least, times), SCHEMA)


def strongest(spans: Column) -> Column:
    """The run with the largest exact length / period; the first of equal ones."""
    return F.when(F.size(spans) > 0, F.aggregate(spans, F.get(spans, F.lit(0)), lambda best, r: F.when(
        r["length"] * best["period"] > best["length"] * r["period"], r).otherwise(best)))


def with_planted_repeats(docs: DataFrame) -> DataFrame:
    """``(doc_id, text)``: where the remainder of ``h = crc32(doc_id as text)`` by 10 is 0, the words from
    ``a = g % n`` on (``g = h div 10``, ``n`` words) repeat the first ``1 + (n - a) div (3 + g % 8)`` of them.  Other texts,
    and those of null doc_ids, stay as they are."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    x = narrow(docs, "doc_id", "text").withColumn("h", h).withColumn(
        "words", F.when(F.col("h") % 10 == 0, F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))))
    x = x.withColumn("n", F.size("words")).withColumn("g", F.floor(F.col("h") / 10)).withColumn("a", F.expr("try_mod(g, n)"))
    x = x.withColumn("p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)))
    again = F.transform("words", lambda w, i: F.when(i < F.col("a"), w).otherwise(
        F.get("words", (F.col("a") + (i - F.col("a")) % F.col("p")).cast("int"))))
    return x.select("doc_id", F.when(F.col("n") > 0, F.array_join(again, " ")).otherwise(F.col("text")).alias("text"))


def digests(found: DataFrame) -> DataFrame:
    """``(doc_id, n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256)`` of ``runs``."""
    x = found.withColumn("best", strongest(F.col("runs")))
    listed = F.array_join(F.transform("runs", lambda r: F.concat(
        r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))), "")
    return x.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.floor(F.col("best.length") * 1000 / F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
