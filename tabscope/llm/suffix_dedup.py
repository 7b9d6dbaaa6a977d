"""Suffix-array dedup over a logarithmic family of indexes: repeated byte strings are removed across the corpus.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts earlier (in a document that comes earlier,
or earlier in the same one).  Matches never cross documents; strings are judged on the input.

Suffix arrays are sparse: every window of LENGTH bytes picks the suffix at the smallest hash among its
GRAM-byte strings (leftmost of equal ones), so equal windows pick equal suffixes at equal offsets, and a suffix stands
for a run of consecutive windows (about one suffix in 35 bytes of text).  A suffix's order key is the hash of its
first GRAM bytes, then the hash of the whole span of its windows.

1. Each Arrow batch of documents gets its suffix array; repeats inside it are found by scanning it.
2. First occurrences are dealt out by key.  In each task they arrive in document order, batch by batch; a batch's
   array is merge-scanned against the levels of the task's index (spans seen before are removed whole), new
   entries become a level, and levels of equal size are merged, so their sizes stay geometric.
3. Suffixes whose first bytes stand elsewhere with another span are matches that begin or end there.  Their
   windows are compared one by one, by key; the windows of a very common key are dealt out one by one.
4. Spans and windows that start earlier elsewhere are removed from the texts.

One key may belong to any share of the documents: a batch sends at most ``SPANS`` spans of a key (beyond that it
defers them all to step 3 and sends a marker), and step 3 deals out keys of more than ``HOT`` spans by window.

Defined cases: null and empty text loses nothing; a null doc_id comes after all others; rows that repeat a doc_id
are ordered by a hash of their text, and rows that repeat both are one document; an empty table gives an empty
result; other columns are ignored."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabscope.llm.common import U64, PrefixHash, mix, narrow, stored, text_chunks

LENGTH = 100
GRAM = 32
SPANS = 8
HOT = 2000
REPEAT, SPAN, DEFERRED, MARKER = 0, 1, 2, 3
ENTRY = "kind byte, key long, span long, doc long, tie long, start int, stop int"
LAST = np.iinfo(np.int64).max


def suffixes(buf: np.ndarray, offsets: np.ndarray, length: int = LENGTH, gram: int = GRAM
             ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each suffix that windows pick: key, span hash, row, first byte of the span and its end (in the row)."""
    width, count = length - gram + 1, len(buf) - length + 1
    none = np.zeros(0, np.int64)
    if count <= 0:
        return none.astype(U64), none.astype(U64), none, none, none
    hashes = PrefixHash(buf)
    begin = np.arange(len(buf) - gram + 1)
    grams = hashes.of(begin, begin + gram)
    packed = (grams >> U64(32) << U64(32)) | begin.astype(U64)  # 32 bits of hash, then the place
    pad = (-len(packed)) % width
    blocks = np.concatenate([packed, np.full(pad, U64(2**64 - 1))]).reshape(-1, width)
    left = np.minimum.accumulate(blocks, axis=1).ravel()
    right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    pick = (np.minimum(right[:count], left[width - 1:width - 1 + count]) & U64(0xFFFFFFFF)).astype(np.int64)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[:count]
    inside = np.arange(count) + length <= offsets[row + 1]
    fresh = np.ones(count, dtype=bool)
    fresh[1:] = (pick[1:] != pick[:-1]) | (row[1:] != row[:-1])
    edge = np.concatenate([np.flatnonzero(fresh | ~inside), [count]])
    first = np.flatnonzero(fresh & inside)
    end = edge[np.searchsorted(edge, first, side="right")] - 1 + length
    r = row[first]
    return grams[pick[first]], hashes.of(first, end), r, first - offsets[r], end - offsets[r]


def _rows(kind, key, span, doc, tie, start, stop) -> pa.RecordBatch:
    n = len(doc)
    as_long = lambda x: pa.array(np.ascontiguousarray(x).view(np.int64) if x is not None else np.zeros(n, np.int64))
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(n, kind, np.int8)), as_long(key), as_long(span), pa.array(doc), pa.array(tie),
         pa.array(start.astype(np.int32)), pa.array(stop.astype(np.int32))],
        names=["kind", "key", "span", "doc", "tie", "start", "stop"])


def _joined(doc, tie, start, stop) -> pa.RecordBatch:
    """Repeats as rows, overlapping and touching ones of a document as one."""
    o = np.lexsort((start, tie, doc))
    doc, tie, start, stop = doc[o], tie[o], start[o], stop[o]
    if len(doc):
        # spans of one document have rising ends when their starts rise
        head = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (tie[1:] != tie[:-1]) | (start[1:] > stop[:-1])]))
        last = np.concatenate([head[1:], [len(doc)]]) - 1
        doc, tie, start, stop = doc[head], tie[head], start[head], stop[last]
    return _rows(REPEAT, mix(doc.astype(U64)), None, doc, tie, start, stop)


def _arrays(length: int, spans: int = SPANS):
    """Step 1: the suffix array of each batch, its own repeats, and what must be compared with other batches."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, ties = (b.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (0, 1))
            parts = []
            for i, _, buf, offsets in text_chunks(b.column(2)):
                key, span, row, start, stop = suffixes(buf, offsets, length, min(GRAM, length))
                parts.append((key, span, row + i, start, stop))
            if not parts:
                continue
            key, span, row, start, stop = (np.concatenate(x) for x in zip(*parts, strict=True))
            doc, tie = ids[row], ties[row]
            o = np.lexsort((start, tie, doc, span, key))
            key, span, doc, tie, start, stop = (x[o] for x in (key, span, doc, tie, start, stop))
            if not len(key):
                continue
            new_key = np.concatenate([[True], key[1:] != key[:-1]])
            new = new_key | np.concatenate([[True], span[1:] != span[:-1]])
            lead = np.maximum.accumulate(np.where(new, np.arange(len(key)), 0))
            same = (doc == doc[lead]) & (tie == tie[lead]) & (start == start[lead])
            again = ~new & ~same  # rows that repeat a row aren't later places
            yield _joined(doc[again], tie[again], start[again], stop[again])
            group = np.cumsum(new_key) - 1
            many = np.bincount(group, weights=new)[group] > spans
            send = new & ~many
            yield _rows(SPAN, key[send], span[send], doc[send], tie[send], start[send], stop[send])
            late = new & many
            yield _rows(DEFERRED, key[late], None, doc[late], tie[late], start[late], stop[late])
            mark = late & new_key
            yield _rows(MARKER, key[mark], None, np.full(mark.sum(), -1), np.zeros(mark.sum(), np.int64), start[mark] * 0, stop[mark] * 0)
    return run


class Levels:
    """Sorted arrays of (key, span) seen so far, sizes geometric: adding merges levels of equal size."""

    def __init__(self):
        self.levels: list[dict[str, np.ndarray]] = []

    def seen(self, mark: np.ndarray, place: tuple[np.ndarray, ...]) -> tuple[np.ndarray, np.ndarray]:
        """Whether each entry is known, and whether from another place (doc, tie, start) than its own."""
        known, earlier = np.zeros(len(mark), dtype=bool), np.zeros(len(mark), dtype=bool)
        for level in self.levels:
            at = np.searchsorted(level["mark"], mark)
            at[at == len(level["mark"])] = 0
            hit = level["mark"][at] == mark
            own = hit.copy()
            for name, value in zip(("doc", "tie", "start"), place, strict=True):
                own &= level[name][at] == value
            known |= hit
            earlier |= hit & ~own
        return known, earlier

    def add(self, entries: dict[str, np.ndarray]) -> None:
        if not len(entries["mark"]):
            return
        self.levels.append(entries)
        while len(self.levels) > 1 and len(self.levels[-2]["mark"]) < 2 * len(self.levels[-1]["mark"]):
            self._merge()

    def _merge(self) -> None:
        b, a = self.levels.pop(), self.levels.pop()
        joined = {k: np.concatenate([a[k], b[k]]) for k in a}
        o = np.argsort(joined["mark"], kind="stable")
        self.levels.append({k: v[o] for k, v in joined.items()})

    def all(self) -> dict[str, np.ndarray]:
        while len(self.levels) > 1:
            self._merge()
        return self.levels[0] if self.levels else {}


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Step 2: the entries of some keys in document order, against the index family of those keys."""
    index, markers = Levels(), []
    for b in batches:
        kind = b.column(0).to_numpy()
        rest = b.filter(pa.array((kind == REPEAT) | (kind == DEFERRED)))
        if rest.num_rows:
            yield rest
        markers.append(b.column(1).to_numpy().view(U64)[kind == MARKER])
        e = b.filter(pa.array(kind == SPAN))
        key, span = (e.column(i).to_numpy().view(U64) for i in (1, 2))
        doc, tie, start, stop = (e.column(i).to_numpy() for i in (3, 4, 5, 6))
        mark = mix(key ^ mix(span + U64(0x9E3779B97F4A7C15)))
        o = np.lexsort((start, tie, doc, mark))
        key, doc, tie, start, stop, mark = (x[o] for x in (key, doc, tie, start, stop, mark))
        if not len(mark):
            continue
        new = np.concatenate([[True], mark[1:] != mark[:-1]])
        lead = np.maximum.accumulate(np.where(new, np.arange(len(mark)), 0))
        known, earlier = index.seen(mark, (doc, tie, start))
        same = (doc == doc[lead]) & (tie == tie[lead]) & (start == start[lead])
        again = earlier | (~new & ~same)
        if again.any():
            yield _rows(REPEAT, key[again], None, doc[again], tie[again], start[again], stop[again])
        fresh = new & ~known
        index.add({"mark": mark[fresh], "key": key[fresh], "doc": doc[fresh], "tie": tie[fresh],
                   "start": start[fresh], "stop": stop[fresh]})
    kept = index.all()
    if not kept:
        return
    key = kept["key"]
    values, group, count = np.unique(key, return_inverse=True, return_counts=True)
    marked = np.isin(values, np.concatenate(markers)) if markers else np.zeros(len(values), bool)
    open_ends = ((count > 1) | marked)[group]
    x = {k: v[open_ends] for k, v in kept.items()}
    yield _rows(DEFERRED, x["key"], None, x["doc"], x["tie"], x["start"], x["stop"])


def _lists(column: pa.Array) -> tuple[np.ndarray, pa.StructArray]:
    """Begin of each row's list (and the end of the last) in the flat structs."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    size = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    return np.concatenate([[0], np.cumsum(size)]).astype(np.int64), column.flatten()


def _pieces(length: int):
    """Step 3: the spans to compare window by window: (route, doc, tie, start, bytes), or one row for each window
    (route is the window's hash, no bytes) where the key is very common."""
    names = ["route", "doc", "tie", "start", "bytes"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            docs, ties = b.column(0).to_numpy(), b.column(1).to_numpy()
            first, flat = _lists(b.column(3))
            key, start, stop = (flat.field(i).to_numpy() for i in range(3))
            hot = flat.field(3).to_numpy(zero_copy_only=False)
            owner = np.repeat(np.arange(len(docs)), np.diff(first))
            plain, bytes_ = np.flatnonzero(~hot), []
            raws = [t.as_buffer() if t.is_valid else pa.py_buffer(b"") for t in b.column(2)]
            for i in plain.tolist():
                bytes_.append(raws[owner[i]][start[i]:stop[i]].to_pybytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(key[plain]), pa.array(docs[owner[plain]]), pa.array(ties[owner[plain]]),
                 pa.array(start[plain], pa.int32()), pa.array(bytes_, pa.binary())], names=names)
            for r in np.unique(owner[hot]).tolist():
                own = np.arange(first[r], first[r + 1])[hot[first[r]:first[r + 1]]]
                hashes = PrefixHash(np.frombuffer(raws[r], np.uint8))
                at = [np.arange(start[i], stop[i] - length + 1) for i in own]
                route = [mix(hashes.of(a, a + length) ^ key[i:i + 1].view(U64)[0]) for i, a in zip(own, at, strict=True)]
                route, at = np.concatenate(route).view(np.int64), np.concatenate(at)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(route), pa.array(np.full(len(at), docs[r])), pa.array(np.full(len(at), ties[r])),
                     pa.array(at.astype(np.int32)), pa.nulls(len(at), pa.binary())], names=names)
    return run


def _windows(length: int):
    """Step 3: of equal windows under a route, all but the first; as (doc, tie, start, stop), neighbours joined."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = []
        for b in batches:
            route, doc, tie, start = (b.column(i).to_numpy().astype(np.int64) for i in range(4))
            whole = b.column(4).is_valid()
            plain = ~whole.to_numpy(zero_copy_only=False)
            parts.append((route[plain].view(U64), doc[plain], tie[plain], start[plain]))
            rest = np.flatnonzero(~plain)
            if not len(rest):
                continue
            raws = b.column(4).filter(whole).to_pylist()
            size = np.array([len(x) for x in raws])
            offset = np.concatenate([[0], np.cumsum(size)])
            hashes = PrefixHash(np.frombuffer(b"".join(raws), np.uint8))
            n = size - length + 1
            owner = np.repeat(np.arange(len(rest)), n)
            inner = np.arange(len(owner)) - np.repeat(np.concatenate([[0], np.cumsum(n)[:-1]]), n)
            at = offset[owner] + inner
            h = mix(hashes.of(at, at + length) ^ route[rest].view(U64)[owner])
            parts.append((h, doc[rest][owner], tie[rest][owner], start[rest][owner] + inner))
        if not parts:
            return
        h, doc, tie, start = (np.concatenate(x) for x in zip(*parts, strict=True))
        if not len(h):
            return
        o = np.lexsort((start, tie, doc, h))
        h, doc, tie, start = h[o], doc[o], tie[o], start[o]
        new = np.concatenate([[True], h[1:] != h[:-1]])
        lead = np.maximum.accumulate(np.where(new, np.arange(len(h)), 0))
        again = ~((doc == doc[lead]) & (tie == tie[lead]) & (start == start[lead]))
        doc, tie, start = doc[again], tie[again], start[again]
        if not len(doc):
            return
        o = np.lexsort((start, tie, doc))
        doc, tie, start = doc[o], tie[o], start[o]
        first = np.concatenate([[True], (doc[1:] != doc[:-1]) | (tie[1:] != tie[:-1]) | (start[1:] > start[:-1] + length)])
        head = np.flatnonzero(first)
        last = np.concatenate([head[1:], [len(doc)]]) - 1
        yield pa.RecordBatch.from_arrays(
            [pa.array(doc[head]), pa.array(tie[head]), pa.array(start[head].astype(np.int32)),
             pa.array((start[last] + length).astype(np.int32))], names=["doc", "tie", "start", "stop"])
    return run


def _cut(digest: bool):
    """Step 4: texts without their removed runs, or the SHA-256 of what stays."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            first, flat = _lists(b.column(2))
            start, stop = flat.field(0).to_numpy(), flat.field(1).to_numpy()
            out: list[list] = [[], [], [], []]
            for r, text in enumerate(b.column(1)):
                raw = memoryview(text.as_buffer()) if text.is_valid else memoryview(b"")
                removed, runs, at, kept = 0, 0, 0, []
                if first[r] < first[r + 1]:
                    s, e = start[first[r]:first[r + 1]], stop[first[r]:first[r + 1]]
                    o = np.argsort(s, kind="stable")
                    s, reach = s[o], np.maximum.accumulate(e[o])
                    head = np.concatenate([[True], s[1:] > reach[:-1]])
                    s, e = s[head], reach[np.concatenate([head[1:], [True]])]
                    removed, runs = int((e - s).sum()), len(s)
                    for x, y in zip(s.tolist(), e.tolist(), strict=True):
                        kept.append(raw[at:x])
                        at = y
                kept.append(raw[at:])
                if digest:
                    h = hashlib.sha256()
                    for x in kept:
                        h.update(x)
                    stays = h.hexdigest()
                else:
                    stays = b"".join(kept)
                for column, v in zip(out, (len(raw), removed, runs, stays), strict=True):
                    column.append(v)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *[pa.array(c, pa.int64()) for c in out[:3]], pa.array(out[3], pa.string() if digest else pa.binary())],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])
    return run


def removed_spans(docs: DataFrame, length: int = LENGTH) -> tuple[DataFrame, DataFrame]:
    """Documents as ``(doc_id, text, doc, tie)`` and the byte spans ``(doc, tie, start, stop)`` to remove (they may
    overlap)."""
    docs = narrow(docs, "doc_id", "text")
    ids = docs.groupBy("doc_id").agg(F.count("*").alias("n"))
    plain = ids.where("n > 1 OR doc_id IS NULL").isEmpty()
    tie = F.lit(0).cast("long") if plain else F.xxhash64("text")
    docs = docs.withColumn("doc", F.coalesce("doc_id", F.lit(int(LAST)))).withColumn("tie", tie)
    entries = docs.select("doc", "tie", "text").mapInArrow(_arrays(length), ENTRY)
    dealt = entries.repartition(F.col("key")).sortWithinPartitions("doc", "tie", "start")
    found = stored(dealt.mapInArrow(_scan, ENTRY), "matches")
    late = found.where(F.col("kind") == DEFERRED)
    hot = late.groupBy("key").agg(F.count("*").alias("c")).where(F.col("c") > HOT).select("key", F.lit(True).alias("hot"))
    late = late.join(hot, "key", "left").groupBy("doc", "tie").agg(F.collect_list(F.struct(
        "key", "start", "stop", F.coalesce("hot", F.lit(False)).alias("hot"))).alias("spans"))
    texts = docs.select("doc", "tie", "text").join(late, ["doc", "tie"]).select("doc", "tie", "text", "spans")
    pieces = texts.mapInArrow(_pieces(length), "route long, doc long, tie long, start int, bytes binary")
    ends = stored(pieces.repartition(F.col("route")).mapInArrow(_windows(length), "doc long, tie long, start int, stop int"), "ends")
    return docs, found.where(F.col("kind") == REPEAT).select("doc", "tie", "start", "stop").union(ends)


def without_repeats(docs: DataFrame, length: int = LENGTH, digest: bool = False) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept)``: ``kept`` holds the UTF-8 bytes that stay (a cut may fall into
    a character), or with ``digest`` their SHA-256 in hex."""
    rows, spans = removed_spans(docs, length)
    cuts = spans.groupBy("doc", "tie").agg(F.collect_list(F.struct("start", "stop")).alias("cuts"))
    x = rows.join(cuts, ["doc", "tie"], "left").select("doc_id", "text", "cuts")
    kind = "string" if digest else "binary"
    return x.mapInArrow(_cut(digest), f"doc_id long, n_bytes long, n_removed long, n_spans long, kept {kind}")
