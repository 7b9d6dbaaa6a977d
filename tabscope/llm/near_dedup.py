"""MinHash near-dedup with bottom-k sketches from one hash function.

Words are the runs of ``[^\\x20\\x09-\\x0D]`` of the text with A-Z in lower case; a document's set holds its distinct
5-word shingles (hashes of 63 bits), or its whole word sequence where it has fewer words.  Steps:

1. One Arrow pass makes each document's set size, set key (128 bits) and bottom-k sketch.  Documents with equal
   sets form a class; everything after works on classes, so a group of copies costs one row.
2. The retained values form inverted lists.  Two classes at Jaccard 0.75 share at least ``need`` retained values:
   exactly so where their union fits into the sketch, else with the mean of the shared part of a union
   sketch less 5.5 standard deviations (of draws without replacement, so the bound tightens for sets not much
   larger than the sketch); the smaller of both where a set's size allows either.  It suffices to list each class under its rarest ``k - need + 1`` values: values that
   very many classes hold drop out unless a document has little else.
3. Lists generate overlaps without all pairs of a list.  In the first rounds every member meets its list's hub (a
   pseudo-random member, another one for each list); the best pair of each class is verified, then the others that
   still lie in different components.  In the last round each list that still mixes components sends its members
   outside the largest one to that component's cluster; outsiders and cluster meet in blocks of bounded size, and
   only links come out.
4. The sketch of the union estimates the Jaccard similarity and filters; the exact one on whole sets decides.
5. Components come from alternating star contractions over the verified links.

Defined cases: null or empty text and text without words has an empty set, is linked with nothing and is its own
component.  A null ``doc_id`` has kept true, its component is the smallest doc_id of its group, or null; ``keep_one``
takes such a row only if no row of its group has a doc_id, and then one of them.
Repeated rows are copies of each other.  Rows that repeat a doc_id with other text are judged by their own text.
An empty table gives an empty result.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabscope.llm.common import LOWER, SPACE, U64, PrefixHash, mix, narrow, shielded, stored, text_chunks, word_spans
from tabscope.llm.graph import joined_components, star_components

WORDS = 5
SKETCH = 128
#: Members and shingles of a block in the last round (about, but for a single larger set), and shingles of one slice
#: of its matrices.
BLOCK, BLOCK_SHINGLES, SLICE = 512, 1 << 18, 4096
#: Standard deviations under the mean at which the bound on shared retained values lies.
SIGMAS = 5.5
MULTIPLIERS = [U64((2 * i + 1) * 0xC2B2AE3D27D4EB4F % (1 << 64)) for i in range(1, 12)]


def shingle_sets(buf: np.ndarray, offsets: np.ndarray, words: int = WORDS) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each row of a chunk."""
    start, end, row = word_spans(buf, offsets, SPACE)
    rows = len(offsets) - 1
    if not len(start):
        for _ in range(rows):
            yield np.zeros(0, np.int64)
        return
    h = PrefixHash(LOWER[buf]).of(start, end)
    first = np.searchsorted(row, np.arange(rows + 1))
    n = len(h)
    grams = np.zeros(max(0, n - words + 1), U64)
    for i in range(words):
        grams += h[i:n - words + 1 + i] * MULTIPLIERS[i]
    grams = (mix(grams) >> U64(1)).astype(np.int64)
    for r in range(rows):
        a, b = first[r], first[r + 1]
        if b - a >= words:
            yield np.unique(grams[a:b - words + 1])
        elif b > a:
            whole = np.array([b - a], U64)
            for i in range(a, b):
                whole = mix(whole * MULTIPLIERS[7] + h[i:i + 1])
            yield (whole >> U64(1)).astype(np.int64)
        else:
            yield np.zeros(0, np.int64)


def set_key(s: np.ndarray) -> bytes:
    """128 bits that stand for the set."""
    u = s.astype(U64)
    return b"".join(int(mix(np.array([mix(u ^ U64(c)).sum(dtype=U64) + U64(len(s))], U64))[0]).to_bytes(8, "big")
                    for c in (0x5851F42D4C957F2D, 0x14057B7EF767814F))


def _sketches(k: int, words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sizes, keys, sketches = [], [], []
            for _, _, buf, offsets in text_chunks(b.column(1)):
                for s in shingle_sets(buf, offsets, words):
                    sizes.append(len(s))
                    keys.append(set_key(s) if len(s) else None)
                    sketches.append(s[:k])
            if sizes:
                at = np.concatenate([[0], np.cumsum([len(s) for s in sketches])]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), b.column(2), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()),
                     pa.ListArray.from_arrays(pa.array(at), pa.array(np.concatenate(sketches), pa.int64()))],
                    names=["doc_id", "text_hash", "n_shingles", "class", "sketch"])
    return run


def _sets(words: int):
    """Whole sets of the documents whose set key is the class that they were fetched for, each once a task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for b in batches:
            for i, j, buf, offsets in text_chunks(b.column(1)):
                got = []
                for c, s in zip(b.column(0).slice(i, j - i).to_pylist(), shingle_sets(buf, offsets, words), strict=True):
                    if len(s) and c not in seen and set_key(s) == c:
                        seen.add(c)
                        got.append((c, s))
                if got:
                    at = np.concatenate([[0], np.cumsum([len(s) for _, s in got])]).astype(np.int32)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([c for c, _ in got], pa.binary()),
                         pa.ListArray.from_arrays(pa.array(at), pa.array(np.concatenate([s for _, s in got]), pa.int64()))],
                        names=["class", "shingles"])
    return run


def whole_sets(wanted: DataFrame, docs: DataFrame, sk: DataFrame, words: int) -> DataFrame:
    """``(class, shingles)`` of the wanted classes, made anew from the text of one document of each (the first by doc_id
    and text hash: rows without doc_id meet their own class alone)."""
    first = sk.join(wanted, "class", "left_semi").groupBy("class").agg(F.min(F.struct("doc_id", "text_hash")).alias("f"))
    first = first.select("class", F.col("f.doc_id").alias("id"), F.col("f.text_hash").alias("h"))
    texts = docs.join(first, (F.xxhash64("text") == F.col("h")) & F.col("doc_id").eqNullSafe(F.col("id"))).select("class", "text")
    return stored(texts.mapInArrow(_sets(words), "class binary, shingles array<long>").dropDuplicates(["class"]), "sets")


def _need(n: str, similarity: int, k: int) -> Column:
    """Retained values that a set of this size shares at least with any set at the similarity: the whole overlap if
    the union has at most ``k`` values, else the draw bound; a set that allows both unions gets the smaller one."""
    p = similarity / 100
    whole = F.floor((F.col(n) * similarity + 99) / 100)
    spread = F.sqrt(F.lit(k * p * (1 - p)) * (1 - F.lit(k * p) / F.col(n)))
    return F.when(F.col(n) * 100 <= k * similarity, whole).otherwise(
        F.greatest(F.least(whole, F.floor(F.lit(k * p) - SIGMAS * spread)), F.lit(1))).cast("int")


def _lists(classes: DataFrame, similarity: int, k: int) -> DataFrame:
    """``(v, class, n)``: each class under its rarest retained values, as many as a link can't miss."""
    posts = classes.select("class", "n", F.size("sketch").alias("held"), F.explode("sketch").alias("v"))
    common = posts.groupBy("v").agg(F.count("*").alias("c")).where("c > 1")
    live = posts.join(common, "v")
    rank = F.row_number().over(Window.partitionBy("class").orderBy("c", "v"))
    alone = F.col("held") - F.count("*").over(Window.partitionBy("class"))
    return live.withColumn("at", rank + alone).where(
        F.col("at") <= F.col("held") - _need("n", similarity, k) + 1).select("v", "class", "n")


def _alike_in_size(n: str, m: str, similarity: int) -> Column:
    return F.least(n, m) * 100 >= F.greatest(n, m) * similarity


def _hub_pairs(lists: DataFrame, similarity: int) -> DataFrame:
    hubs = lists.groupBy("v").agg(F.min(F.struct(F.xxhash64("v", "class").alias("o"), "class", "n")).alias("hub"))
    hubs = hubs.select("v", F.col("hub.class").alias("hub"), F.col("hub.n").alias("m"))
    met = lists.join(hubs, "v").where(F.col("class") != F.col("hub")).where(_alike_in_size("n", "m", similarity))
    return met.select(F.least("class", "hub").alias("a"), F.greatest("class", "hub").alias("b")).distinct()


def _mixed_lists(lists: DataFrame, label: DataFrame) -> DataFrame:
    """``(class, n, label, big)``: members of lists that hold more than one component, with the list's largest one."""
    part = lists.select("v", "class", "n").join(label.withColumnRenamed("node", "class"), "class", "left").withColumn(
        "label", F.coalesce("label", "class"))
    size = label.groupBy("label").agg(F.count("*").alias("size"))
    there = part.select("v", "label").distinct().join(size, "label", "left").groupBy("v").agg(
        F.count("*").alias("labels"), F.max(F.struct(F.coalesce("size", F.lit(1)), "label"))["label"].alias("big"))
    return part.join(there.where("labels > 1"), "v").select("class", "n", "label", "big").distinct()


def _block_links(similarity: int):
    """Links between the outsiders and the whole cluster of one pair of blocks, by products of their incidence
    matrices over the shingles that both sides hold (in slices, so memory is bounded by the block size)."""
    def run(t: pa.Table) -> pa.Table:
        out = np.asarray(t["side"].to_numpy(zero_copy_only=False), bool)
        name, label = t["class"].to_pylist(), t["label"].to_pylist()
        sets = t["shingles"].combine_chunks() if isinstance(t["shingles"], pa.ChunkedArray) else t["shingles"]
        size = sets.value_lengths().to_numpy()
        value = sets.flatten().to_numpy()
        row = np.repeat(np.arange(len(size)), size)
        x, y = np.flatnonzero(out), np.flatnonzero(~out)
        both = np.intersect1d(value[out[row]], value[~out[row]])
        at = np.searchsorted(both, value)
        at[at == len(both)] = 0
        held = both[at] == value if len(both) else np.zeros(len(value), bool)
        row, at = row[held], at[held]
        place = np.zeros(len(size), int)
        place[x], place[y] = np.arange(len(x)), np.arange(len(y))
        hits = np.zeros((len(x), len(y)), np.float32)
        for low in range(0, len(both), SLICE):
            now = (at >= low) & (at < low + SLICE)
            r, c = row[now], at[now] - low
            a, b = np.zeros((len(x), SLICE), np.float32), np.zeros((len(y), SLICE), np.float32)
            a[place[r[out[r]]], c[out[r]]] = 1
            b[place[r[~out[r]]], c[~out[r]]] = 1
            hits += a @ b.T
        union = size[x][:, None] + size[y][None, :] - hits
        i, j = np.nonzero((hits > 0) & (hits * 100 >= union * similarity))
        found = [(name[x[p]], name[y[q]]) for p, q in zip(i.tolist(), j.tolist(), strict=True) if label[x[p]] != label[y[q]]]
        return pa.table({"a": pa.array([f[0] for f in found], pa.binary()), "b": pa.array([f[1] for f in found], pa.binary())})
    return run


def _rest_links(mixed: DataFrame, sets: DataFrame, similarity: int) -> DataFrame:
    """Links between components.  Any pair of a list that lies in two components has a member outside the list's
    largest component, and the other one is inside it or outside as well: so, for each such component, its
    outsiders meet its cluster (members and outsiders), block by block."""
    def blocks(members: str, shingles: str) -> Column:
        return F.greatest(F.ceil(F.col(members) / BLOCK), F.ceil(F.col(shingles) / BLOCK_SHINGLES), F.lit(1)).cast("long")
    outside = F.col("label") != F.col("big")
    counts = mixed.groupBy("big").agg(
        F.count("*").alias("all"), F.sum("n").alias("all_n"), F.count_if(outside).alias("outs"),
        F.coalesce(F.sum(F.when(outside, F.col("n"))), F.lit(0)).alias("outs_n"))
    counts = counts.where("outs > 0").select("big", blocks("outs", "outs_n").alias("ob"), blocks("all", "all_n").alias("ab"))
    ob, ab = F.col("ob"), F.col("ab")
    x = mixed.join(counts, "big").join(sets, "class").withColumn("o", F.xxhash64("class", F.lit(1)))
    outs = x.where("label <> big").select("big", F.pmod("o", ob).alias("i"), F.explode(F.sequence(F.lit(0).cast("long"), ab - 1)).alias("j"),
                                          "class", "label", "shingles", F.lit(True).alias("side"))
    cluster = x.select("big", F.explode(F.sequence(F.lit(0).cast("long"), ob - 1)).alias("i"), F.pmod("o", ab).alias("j"),
                       "class", "label", "shingles", F.lit(False).alias("side"))
    return outs.union(cluster).groupBy("big", "i", "j").applyInArrow(_block_links(similarity), "a binary, b binary")


def _estimated(pairs: DataFrame, classes: DataFrame, similarity: int, k: int) -> DataFrame:
    """Keeps the pairs whose union sketch allows the similarity; ``exact`` where both sketches are whole sets."""
    one = classes.select(F.col("class").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("sa"))
    two = classes.select(F.col("class").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("sb"))
    x = pairs.join(one, "a").join(two, "b")
    union = F.slice(F.array_sort(F.array_union("sa", "sb")), 1, k)
    both = F.array_intersect("sa", "sb")
    x = x.withColumn("exact", (F.col("na") <= k) & (F.col("nb") <= k)).withColumn(
        "hits", F.when(F.col("exact"), F.size(both)).otherwise(F.size(F.array_intersect(both, union))))
    whole = F.col("hits") * 100 >= (F.col("na") + F.col("nb") - F.col("hits")) * similarity
    need = F.least(_need("na", similarity, k), _need("nb", similarity, k))
    x = x.where(F.when(F.col("exact"), whole).otherwise(F.col("hits") >= need))
    overlap = F.when(F.col("exact"), F.col("hits") / (F.col("na") + F.col("nb") - F.col("hits"))).otherwise(F.col("hits") / k)
    return x.select("a", "b", "exact", overlap.alias("overlap"))


def _across(pairs: DataFrame, label: DataFrame) -> DataFrame:
    """The pairs whose two classes lie in different components so far."""
    x = pairs.join(label.select(F.col("node").alias("a"), F.col("label").alias("la")), "a", "left")
    x = x.join(label.select(F.col("node").alias("b"), F.col("label").alias("lb")), "b", "left")
    return x.where(F.coalesce("la", "a") != F.coalesce("lb", "b")).drop("la", "lb")


def _ends(pairs: DataFrame) -> DataFrame:
    x = pairs.where("not exact")
    return x.select(F.col("a").alias("class")).union(x.select("b")).distinct()


def _verified(pairs: DataFrame, sets: DataFrame, similarity: int) -> DataFrame:
    one, two = sets.toDF("a", "s"), sets.toDF("b", "t")
    x = pairs.where("not exact").join(one, "a").join(two, "b")
    hits = F.size(F.array_intersect("s", "t"))
    x = x.withColumn("hits", hits).where(
        F.col("hits") * 100 >= (F.size("s") + F.size("t") - F.col("hits")) * similarity)
    return pairs.where("exact").select("a", "b").union(x.select("a", "b"))


def _groups(docs: DataFrame, similarity: int = 75, words: int = WORDS, k: int = SKETCH) -> DataFrame:
    """``(doc_id, text_hash, n_shingles, label)`` for documents ``(doc_id, text)``: the label names the component, null
    for the empty set."""
    docs = narrow(docs, "doc_id", "text")
    sk = stored(docs.withColumn("text_hash", F.xxhash64("text")).mapInArrow(
        _sketches(k, words), "doc_id long, text_hash long, n_shingles long, class binary, sketch array<long>"), "sketches")
    classes = stored(sk.where("n_shingles > 0").groupBy("class").agg(
        F.first("n_shingles").alias("n"), F.first("sketch").alias("sketch")), "classes")
    lists = stored(_lists(classes, similarity, k), "lists")

    hub_pairs = stored(_estimated(_hub_pairs(lists, similarity), classes, similarity, k), "pairs")
    sets = whole_sets(_ends(hub_pairs), docs, sk, words)
    ends = hub_pairs.union(hub_pairs.select("b", "a", "exact", "overlap"))
    best = ends.groupBy("a").agg(F.max(F.struct("overlap", "b", "exact")).alias("m")).select(
        F.least("a", "m.b").alias("a"), F.greatest("a", "m.b").alias("b"), "m.exact").distinct()
    label = star_components(stored(_verified(best, sets, similarity), "links"))
    others = stored(_across(hub_pairs.join(best, ["a", "b"], "left_anti").select("a", "b", "exact"), label), "others")
    if not others.isEmpty():
        label = joined_components(label, _verified(others, sets, similarity))
    mixed = stored(_mixed_lists(lists, label), "mixed")
    if not mixed.isEmpty():
        more = mixed.select("class").distinct().join(sets.select("class"), "class", "left_anti")
        sets = sets.union(whole_sets(more, docs, sk, words))
        label = joined_components(label, _rest_links(mixed, sets, similarity))

    return sk.select("doc_id", "text_hash", "n_shingles", "class").join(
        label.withColumnRenamed("node", "class"), "class", "left").select(
        "doc_id", "text_hash", "n_shingles", F.coalesce("label", "class").alias("label"))


def near_duplicates(docs: DataFrame, similarity: int = 75, words: int = WORDS, k: int = SKETCH) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` for documents ``(doc_id, text)``; ``similarity`` in percent."""
    rep = _groups(docs, similarity, words, k).select("doc_id", "n_shingles", "label")
    first = rep.where("label is not null").groupBy("label").agg(F.min("doc_id").alias("component_id"))
    out = rep.join(first, "label", "left")
    comp = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "n_shingles", comp.alias("component_id"),
                      F.coalesce(F.col("doc_id") == comp, F.lit(True)).alias("kept"))


def keep_one(docs: DataFrame, **params) -> DataFrame:
    """One document of each group, all columns as they were: the first by doc_id (nulls last), then by a hash of the
    text; of rows that repeat its doc_id and text, one stays.  Documents without words are in no group: all stay, but
    for rows that repeat a doc_id and text (a null doc_id repeats none)."""
    x, (doc_id, text) = shielded(docs, "doc_id", "text")
    rep = _groups(docs, **params)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "text_hash")).alias("first")
    kept = rep.where("label is not null").groupBy("label").agg(first).select(
        F.col("first.doc_id").alias("kept_id"), F.col("first.text_hash").alias("kept_text"), F.lit(False).alias("bare"))
    kept = kept.union(rep.where("label is null").select("doc_id", "text_hash", F.lit(True)).distinct())
    joined = x.join(kept, F.col(doc_id).eqNullSafe(F.col("kept_id")) & (F.xxhash64(text) == F.col("kept_text")))
    bare = F.col(doc_id).isNull() & F.col("bare")
    out = joined.where(~bare).dropDuplicates([doc_id, text]).union(joined.where(bare))
    return out.drop("kept_id", "kept_text", "bare").toDF(*docs.columns)
