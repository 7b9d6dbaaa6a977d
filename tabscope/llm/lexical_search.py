"""Ranked lexical search: Block-Max MaxScore over a sharded, block-compressed inverted index.

Terms are the maximal runs of characters that aren't ASCII separators (letters and digits of ASCII and everything
beyond ASCII stay), A-Z in lower case.  Scores are the integer BM25 weights of ``SCORE`` below.  Steps:

1. One Arrow pass counts the terms of every whole text; document and term counts of the corpus come from it.
2. Each task packs its documents into shards of about ``SHARD_POSTINGS`` postings, one row each.  A shard holds, term by
   term, blocks of ``BLOCK`` postings (document gaps and counts in as few bytes as they need), with the first and last
   document and the highest impact of each block uncompressed beside them.
3. A search task walks its shards with one heap per item.  The shard's bound of each list (weight times its highest
   impact) splits the item's lists: those whose bounds together stay under the heap's last score are non-essential.
   Documents come from the essential lists only; the block maxima of the non-essential ones reject candidates before
   any of their blocks is unpacked, then the lists are added from the highest bound down, rejecting again.
4. Heaps of all tasks merge by a window per item.  A first look at a few shards gives each item a score that the last
   of its results reaches at least, with which all tasks start; it saves rows, and never changes a result.

The items form blocks of about ``ITEM_BYTES`` of text; each block has its own index of the terms it asks for, so what
tasks receive has a bound whatever the number of items.  Documents are never cut, sampled or capped.

Defined cases: null and empty text, and text without terms, is never found and doesn't count as a document.  An item
without terms finds nothing.  Every row of ``items`` is an item of its own, also with a repeated or null item_id; every
row of ``docs`` is a document of its own.  Null doc_ids come after all others of the same score.  Empty tables give an
empty result.  Other columns are ignored, also those with clashing names."""

from __future__ import annotations

import itertools
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabscope.llm.common import forget, narrow, stored_at, text_chunks

#: Bytes of a text to bytes of its terms: A-Z lower-cased, all other ASCII but letters and digits a blank.
TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b > 127 or chr(b).isalnum() else 32 for b in range(256))
#: Bytes of a text that are split into terms at once.
PIECE = 1 << 20
SHARD_POSTINGS, SHARD_DOCS = 1 << 20, 1 << 16
BLOCK = 128
#: Text of the items of one block (about, but for a single longer one).
ITEM_BYTES = 8 << 20
#: Shards looked at first (expected number).
FIRST_LOOK = 4
WIDTHS = (np.uint8, np.uint16, np.uint32, np.uint64)

POSTINGS = "doc_id long, n long, terms array<int>, counts array<long>"
SHARD = ("shard long, doc_ids array<long>, norms array<long>, terms array<int>, first_block array<int>, "
         "block_first array<int>, block_last array<int>, block_max array<long>, block_at array<long>, payload binary")


def term_counts(text: bytes) -> Counter:
    """Terms of a text with their numbers; a long text is split piece by piece."""
    data, out, i = text.translate(TERM_BYTES), Counter(), 0
    while i < len(data):
        j = data.find(b" ", i + PIECE)
        j = j if j >= 0 else len(data)
        out.update(data[i:j].split())
        i = j
    return out


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def norm(n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    return 100 - 50 + (50 * n * n_docs) // max(n_terms, 1)


def impact(count: np.ndarray, norms: np.ndarray) -> np.ndarray:
    """SCORE: what one unit of a term's weight counts in a document."""
    return (1_000_000_000 * count) // (1000 * count + 20 * norms)


# ------------------------------------------------------------------ index
def _counted(vocabulary: dict[bytes, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j, buf, offsets in text_chunks(b.column(1)):
                data, sizes, ids, counts, at = buf.tobytes(), [], [], [], [0]
                for r in range(j - i):
                    c = term_counts(data[offsets[r]:offsets[r + 1]])
                    sizes.append(sum(c.values()))
                    found = sorted((vocabulary[t], k) for t, k in c.items() if t in vocabulary)
                    ids += [f[0] for f in found]
                    counts += [f[1] for f in found]
                    at.append(len(ids))
                at = pa.array(at, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(i, j - i), pa.array(sizes, pa.int64()), pa.ListArray.from_arrays(at, pa.array(ids, pa.int32())),
                     pa.ListArray.from_arrays(at, pa.array(counts, pa.int64()))], names=["doc_id", "n", "terms", "counts"])
    return run


def _widths(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Index into ``WIDTHS`` of the narrowest type that holds each block's values."""
    return np.searchsorted([1 << 8, 1 << 16, 1 << 32], np.maximum.reduceat(values, starts), side="right")


def packed(term: np.ndarray, doc: np.ndarray, count: np.ndarray, norms: np.ndarray) -> dict:
    """The lists of a shard, for postings in any order: uncompressed bounds of blocks, compressed postings."""
    order = np.lexsort((doc, term))
    term, doc, count = term[order], doc[order], count[order]
    fresh = np.flatnonzero(np.diff(term, prepend=term[0] - 1))
    size = np.diff(fresh, append=len(term))
    blocks = -(-size // BLOCK)
    first_block = np.concatenate([[0], np.cumsum(blocks)])
    starts = np.repeat(fresh, blocks) + BLOCK * (np.arange(first_block[-1]) - np.repeat(first_block[:-1], blocks))
    ends = np.append(starts[1:], len(term))
    gaps = np.diff(doc, prepend=0)
    gaps[starts] = 0
    gap_width, count_width = _widths(gaps, starts), _widths(count, starts)
    parts = [bytes((g, c)) + gaps[a:b].astype(WIDTHS[g]).tobytes() + count[a:b].astype(WIDTHS[c]).tobytes()
             for a, b, g, c in zip(starts.tolist(), ends.tolist(), gap_width.tolist(), count_width.tolist(), strict=True)]
    return {"terms": term[fresh], "first_block": first_block, "block_first": doc[starts], "block_last": doc[ends - 1],
            "block_max": np.maximum.reduceat(impact(count, norms[doc]), starts),
            "block_at": np.concatenate([[0], np.cumsum([len(p) for p in parts])]), "payload": b"".join(parts)}


def unpacked(block: bytes, first: int) -> tuple[np.ndarray, np.ndarray]:
    """Documents and counts of one block."""
    gap, count = np.dtype(WIDTHS[block[0]]), np.dtype(WIDTHS[block[1]])
    n = (len(block) - 2) // (gap.itemsize + count.itemsize)
    docs = np.cumsum(np.frombuffer(block, gap, n, 2).astype(np.int64)) + first
    return docs, np.frombuffer(block, count, n, 2 + n * gap.itemsize).astype(np.int64)


def _shards(n_docs: int, n_terms: int):
    def shard(part: list[pa.RecordBatch], name: int) -> pa.RecordBatch:
        t = pa.Table.from_batches(part).combine_chunks()
        size = t["terms"].combine_chunks().value_lengths().to_numpy()
        t = t.filter(pa.array(size > 0))
        lists, ids = t["terms"].combine_chunks(), t["doc_id"].combine_chunks()
        doc = np.repeat(np.arange(len(t)), lists.value_lengths().to_numpy())
        norms = norm(t["n"].to_numpy(), n_docs, n_terms)
        p = packed(lists.flatten().to_numpy().astype(np.int64), doc, t["counts"].combine_chunks().flatten().to_numpy(), norms)
        types = {"terms": pa.int32(), "first_block": pa.int32(), "block_first": pa.int32(), "block_last": pa.int32(),
                 "block_max": pa.int64(), "block_at": pa.int64()}

        def whole(values, kind):
            return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), pa.array(values, kind))
        return pa.RecordBatch.from_arrays(
            [pa.array([name], pa.int64()), pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids), whole(norms, pa.int64()),
             *[whole(p[k], v) for k, v in types.items()], pa.array([p["payload"]], pa.binary())],
            names=[c.split()[0] for c in SHARD.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, docs, postings = [], 0, 0
        names = itertools.count(TaskContext.get().partitionId() << 32)
        for b in batches:
            lengths = b.column(2).value_lengths().to_numpy()
            at = 0
            while at < len(lengths):
                fits = int(np.searchsorted(np.cumsum(lengths[at:]), SHARD_POSTINGS - postings, side="right"))
                n = min(max(fits, 0 if part else 1), SHARD_DOCS - docs, len(lengths) - at)
                if n:
                    part.append(b.slice(at, n))
                    docs, postings, at = docs + n, postings + int(lengths[at:at + n].sum()), at + n
                if at < len(lengths):
                    if postings:
                        yield shard(part, next(names))
                    part, docs, postings = [], 0, 0
        if postings:
            yield shard(part, next(names))
    return run


# ------------------------------------------------------------------ search
class _Shard:
    def __init__(self, row: dict):
        self.ids, self.norms, self.payload = row["doc_ids"], row["norms"], row["payload"]
        self.terms, self.first_block = row["terms"], row["first_block"]
        self.first, self.last, self.most, self.at = row["block_first"], row["block_last"], row["block_max"], row["block_at"]
        self.list_most = np.maximum.reduceat(self.most, self.first_block[:-1])
        self.open: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def block(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents and impacts of a block, unpacked once a shard."""
        if k not in self.open:
            docs, count = unpacked(self.payload[self.at[k]:self.at[k + 1]], int(self.first[k]))
            self.open[k] = docs, impact(count, self.norms[docs])
        return self.open[k]

    def blocks(self, ks) -> tuple[np.ndarray, np.ndarray]:
        got = [self.block(k) for k in ks]
        return (got[0] if len(got) == 1 else (np.concatenate([g[0] for g in got]), np.concatenate([g[1] for g in got])))


def best_of(shard: _Shard, terms: np.ndarray, weights: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Documents (numbers in the shard) that score ``least`` or more for one item, and their scores."""
    nothing = np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.searchsorted(shard.terms, terms)
    here = at < len(shard.terms)
    here[here] = shard.terms[at[here]] == terms[here]
    at, weights = at[here], weights[here]
    if not len(at):
        return nothing
    bound = weights * shard.list_most[at]
    order = np.argsort(bound, kind="stable")
    at, weights, bound = at[order], weights[order], bound[order]
    under = np.cumsum(bound)
    spare = int(np.searchsorted(under, least))  # lists that together can't reach the score
    if spare == len(at):
        return nothing
    score = np.zeros(len(shard.ids), np.int64)
    for j in range(spare, len(at)):
        docs, values = shard.blocks(range(shard.first_block[at[j]], shard.first_block[at[j] + 1]))
        score[docs] += weights[j] * values
    found = np.flatnonzero(score + (under[spare - 1] if spare else 0) >= least)
    if not spare:
        return found, score[found]
    found = found[score[found] > 0]
    # block maxima of the non-essential lists, before any of their blocks is unpacked
    tops, where = [], []
    for j in range(spare):
        a, b = shard.first_block[at[j]], shard.first_block[at[j] + 1]
        k = a + np.searchsorted(shard.last[a:b], found)
        inside = k < b
        k = np.minimum(k, b - 1)
        inside &= shard.first[k] <= found
        tops.append(np.where(inside, weights[j] * shard.most[k], 0))
        where.append(k)
    rest = np.sum(tops, axis=0)
    for j in reversed(range(spare)):
        keep = score[found] + rest >= least
        found, rest = found[keep], rest[keep] - tops[j][keep]
        tops, where = [t[keep] for t in tops[:j + 1]], [w[keep] for w in where[:j + 1]]
        ask = tops[j] > 0
        if ask.any():
            docs, values = shard.blocks(np.unique(where[j][ask]).tolist())
            hit = np.minimum(np.searchsorted(docs, found[ask]), len(docs) - 1)
            score[found[ask]] += np.where(docs[hit] == found[ask], weights[j] * values[hit], 0)
    found = found[score[found] >= least]
    return found, score[found]


def _searched(queries: list[tuple], floor: dict[int, int], k: int):
    """``queries``: (number, item_id, terms, weights); ``floor``: a score that an item's k-th result has at least."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.zeros(0, np.int64)
        heap = {q[0]: (none, none, np.zeros(0, bool)) for q in queries}
        for b in batches:
            for r in range(b.num_rows):
                row = {}
                for name, c in zip(b.schema.names, b.columns, strict=True):
                    row[name] = c[r].as_py() if name in ("shard", "payload") else c[r].values
                null = np.asarray(row["doc_ids"].is_null().to_numpy(zero_copy_only=False), bool)
                row["doc_ids"] = row["doc_ids"].fill_null(0)
                shard = _Shard({n: v.to_numpy() if isinstance(v, pa.Array) else v for n, v in row.items()})
                for number, _, terms, weights in queries:
                    scores, ids, no_id = heap[number]
                    least = max(1, floor.get(number, 0), int(scores[-1]) if len(scores) == k else 0)
                    found, new = best_of(shard, terms, weights, least)
                    if len(found):
                        scores = np.concatenate([scores, new])
                        ids, no_id = np.concatenate([ids, shard.ids[found]]), np.concatenate([no_id, null[found]])
                        top = np.lexsort((ids, no_id, -scores))[:k]
                        heap[number] = scores[top], ids[top], no_id[top]
        for number, item, _, _ in queries:
            scores, ids, no_id = heap[number]
            if len(scores):
                n = len(scores)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number] * n, pa.int32()), pa.array([item] * n, pa.int64()),
                     pa.array(ids, pa.int64(), mask=no_id), pa.array(scores, pa.int64())], names=["q", "item_id", "doc_id", "score"])
    return run


def _merged(heaps: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("q").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return heaps.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _block_results(docs: DataFrame, items: list, k: int) -> DataFrame:
    """The results of one block of items: ``(q, item_id, rank, doc_id, score)``."""
    spark = docs.sparkSession
    terms = [sorted(term_counts((i.text or "").encode())) for i in items]
    vocabulary = {t: n for n, t in enumerate(sorted({t for ts in terms for t in ts}))}
    counts, counts_at = stored_at(docs.mapInArrow(_counted(vocabulary), POSTINGS), "term_counts")
    total = counts.agg(F.count_if(F.col("n") > 0).alias("n"), F.coalesce(F.sum("n"), F.lit(0)).alias("l")).first()
    held = counts.select(F.explode("terms").alias("t")).groupBy("t").count().collect()  # a row for each term of the block
    weights = np.zeros(len(vocabulary), np.int64)
    for t, df in held:
        weights[t] = weight(total.n, df)
    queries = []
    for number, (i, ts) in enumerate(zip(items, terms, strict=True)):
        of = np.array([vocabulary[t] for t in ts], np.int64)
        of = of[weights[of] > 0]
        if len(of):
            queries.append((number, i.item_id, of, weights[of]))
    index, _ = stored_at(counts.mapInArrow(_shards(total.n, total.l), SHARD), "index")
    forget(spark, counts_at)
    out = "q int, item_id long, doc_id long, score long"
    shards = max(1, index.select("shard").count())
    first = index.where(F.pmod(F.xxhash64("shard"), F.lit(shards)) < FIRST_LOOK)
    first = _merged(first.mapInArrow(_searched(queries, {}, k), out), k)
    floor = {r.q: r.score for r in first.where(F.col("rank") == k).select("q", "score").collect()}
    return _merged(index.mapInArrow(_searched(queries, floor, k), out), k)


def search(docs: DataFrame, items: DataFrame, k: int = 50, item_bytes: int = ITEM_BYTES) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: the ``k`` documents ``(doc_id, text)`` that score highest for each row of
    ``items (item_id, text)``, with a score above 0."""
    docs, items = narrow(docs, "doc_id", "text"), narrow(items, "item_id", "text")
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = -(-max(size, 1) // item_bytes)
    out = None
    for n in range(blocks):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == n).collect()
        if part:
            found = _block_results(docs, part, k)
            out = found if out is None else out.union(found)
    if out is None:
        return docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return out.select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


_TERMS_SQL = ("regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
              "'[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')")

#: The results of ``search`` with 50 documents an item, over ``documents`` and ``benchmark``.
SEARCH_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_TERMS_SQL} AS t FROM documents),
total AS (SELECT count(*) FILTER (len(t) > 0) AS docs, sum(len(t))::BIGINT AS terms FROM d),
p AS (SELECT rid, term, count(*) AS tf FROM (SELECT rid, unnest(t) AS term FROM d) GROUP BY rid, term),
q AS (SELECT DISTINCT qid, item_id, term FROM
      (SELECT row_number() OVER () AS qid, item_id, unnest({_TERMS_SQL}) AS term FROM benchmark)),
w AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w
      FROM (SELECT term, count(*) AS df FROM p WHERE term IN (SELECT term FROM q) GROUP BY term), total),
m AS (SELECT rid, doc_id, 100 - 50 + ((50 * len(t)::BIGINT * docs) // terms) AS m FROM d, total WHERE len(t) > 0),
s AS (SELECT qid, item_id, rid, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::BIGINT AS score
      FROM q JOIN w USING (term) JOIN p USING (term) JOIN m USING (rid) GROUP BY qid, item_id, rid, doc_id),
r AS (SELECT item_id, row_number() OVER (PARTITION BY qid ORDER BY score DESC, doc_id NULLS LAST) AS rank, doc_id, score
      FROM s WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM r WHERE rank <= 50
"""
