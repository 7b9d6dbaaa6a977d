"""N-gram Jaccard self-join by parity sketches.

Words are the runs of ``[^\\x20\\x09-\\x0D]`` of the text with A-Z in lower case; a document's set holds its distinct
3-word shingles (hashes of 63 bits), or its whole word sequence where it has fewer words.  Steps:

1. One Arrow pass makes each document's set size, set key (128 bits) and parity sketch.  Documents with equal sets form
   a class; everything after works on classes, so a group of copies costs one row.
2. Size bands: two linked sets lie in one band or in neighbouring ones, so a class takes part in its own band, and in the
   next one if a set there can link with it.  A band whose sets can differ in ``D`` shingles at most parts the hash range
   into ``D + spare`` blocks of one 64-bit word; each shingle flips (XOR) one bit of its block's word.
3. The sketches' Hamming distance is never more than the symmetric difference.  Pigeonhole: each differing shingle
   touches one block, so two linked sets have ``spare`` equal words at least.  Lists hold the classes of a band with the
   same word in the same block.  It suffices to list each class under its ``d + 1`` rarest words (``d``: the most that
   it can differ from a linked set): the rarest shared word of a linked pair is among them.  A class that shares fewer
   than ``spare`` words with others is in no list; empty blocks, which many classes share, are the last to be listed.
4. In each list every member meets the smallest class (the hub).  The Hamming distance rejects pairs, the exact Jaccard
   similarity of whole sets decides, and the links form components.  Lists that still mix components are compared whole,
   in blocks of bounded size, and only links between components come out.

Defined cases: null or empty text and text without words has an empty set, is linked with nothing and is its own
component.  A null ``doc_id`` has the smallest doc_id of its group as component, or null.  Repeated rows are copies of
each other.  Rows that repeat a doc_id with other text are judged by their own text.  Sketches grow with the set, so very
long texts keep their selectivity.  An empty table gives an empty result.  Other columns are ignored, also those with
clashing names."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabscope.llm.common import U64, narrow, stored, text_chunks
from tabscope.llm.graph import joined_components, star_components
from tabscope.llm.near_dedup import _mixed_lists, _rest_links, set_key, shingle_sets, whole_sets

WORDS = 3
PERCENT = 90
SCHEMA = ("doc_id long, text_hash long, n_shingles long, class binary, band int, most long, words array<long>, "
          "next_band int, next_most long, next_words array<long>")


def band_lows() -> np.ndarray:
    """The smallest set size of each band: 1, 2, 3, 4, 6, 9, ... (each half as much again)."""
    lows = [1]
    while lows[-1] < 1 << 44:
        lows.append(max(lows[-1] + 1, lows[-1] * 3 // 2))
    return np.array(lows)


LOWS = band_lows()


def difference(total: int, percent: int) -> int:
    """The most shingles by which two linked sets of ``total`` shingles together can differ."""
    return total * (100 - percent) // (100 + percent)


def spare(differing: int) -> int:
    return 3 + differing // 8


def parity_sketch(s: np.ndarray, blocks: int) -> np.ndarray:
    """Words of a sorted set of 63-bit hashes: the high bits choose the block (so blocks are stretches of the set), the
    low six the bit."""
    block = ((s >> 32) * blocks) >> 31
    head = np.flatnonzero(np.diff(block, prepend=-1))
    out = np.zeros(blocks, U64)
    out[block[head]] = np.bitwise_xor.reduceat(U64(1) << (s & 63).astype(U64), head)
    return out.view(np.int64)


def _in_band(s: np.ndarray, band: int, partner: int, percent: int) -> tuple[int | None, int | None, np.ndarray]:
    """Band, most differing shingles and sketch of a set whose linked sets in that band have up to ``partner``; no band
    where only equal sets link."""
    differing = difference(2 * (int(LOWS[band + 1]) - 1), percent)
    if not differing:
        return None, None, np.zeros(0, np.int64)
    return band, difference(len(s) + partner, percent), parity_sketch(s, differing + spare(differing))


def _sketches(percent: int, words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j, buf, offsets in text_chunks(b.column(1)):
                sizes, keys, own, up = [], [], [], []
                nothing = (None, None, np.zeros(0, np.int64))
                for s in shingle_sets(buf, offsets, words):
                    n = len(s)
                    sizes.append(n)
                    keys.append(set_key(s) if n else None)
                    band = int(np.searchsorted(LOWS, n, side="right")) - 1
                    low, largest = int(LOWS[band + 1]), n * 100 // percent
                    own.append(_in_band(s, band, min(largest, low - 1), percent) if n else nothing)
                    up.append(_in_band(s, band + 1, largest, percent) if n and largest >= low else nothing)

                def columns(of):
                    at = np.concatenate([[0], np.cumsum([len(o[2]) for o in of])]).astype(np.int32)
                    return [pa.array([o[0] for o in of], pa.int32()), pa.array([o[1] for o in of], pa.int64()),
                            pa.ListArray.from_arrays(pa.array(at), pa.array(np.concatenate([o[2] for o in of]), pa.int64()))]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(i, j - i), b.column(2).slice(i, j - i), pa.array(sizes, pa.int64()),
                     pa.array(keys, pa.binary()), *columns(own), *columns(up)], names=[c.split()[0] for c in SCHEMA.split(", ")])
    return run


def _lists(sketches: DataFrame) -> DataFrame:
    """``(v, class, n, band)``: each class under its rarest words, as many as a link can't miss."""
    posts = sketches.select("class", "n", "band", "most", F.size("words").alias("blocks"), F.posexplode("words").alias("i", "w"))
    posts = posts.select(F.xxhash64("band", "i", "w").alias("v"), "class", "n", "band", "most", "blocks")
    common = posts.groupBy("v").agg(F.count("*").alias("c")).where("c > 1")
    one = Window.partitionBy("class", "band")
    live = posts.join(common, "v").withColumn("alone", F.col("blocks") - F.count("*").over(one))
    return live.withColumn("at", F.col("alone") + F.row_number().over(one.orderBy("c", "v"))).where(
        F.col("at") <= F.col("most") + 1).select("v", "class", "n", "band")


def _hub_pairs(lists: DataFrame, percent: int) -> DataFrame:
    hubs = lists.groupBy("v").agg(F.min(F.struct("class", "n")).alias("hub")).select(
        "v", F.col("hub.class").alias("hub"), F.col("hub.n").alias("m"))
    met = lists.join(hubs, "v").where(F.col("class") != F.col("hub"))
    met = met.where(F.least("n", "m") * 100 >= F.greatest("n", "m") * percent)
    return met.select("band", F.col("hub").alias("a"), F.col("class").alias("b")).distinct()


def hamming(x: str, y: str) -> Column:
    """Bits in which two sketches differ."""
    return F.aggregate(F.zip_with(x, y, lambda p, q: F.bit_count(p.bitwiseXOR(q)).cast("int")), F.lit(0), lambda s, d: s + d)


def _near(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """The pairs whose sketches don't differ in more bits than linked sets of their sizes can in shingles."""
    one = sketches.select("band", F.col("class").alias("a"), F.col("n").alias("na"), F.col("words").alias("wa"))
    two = sketches.select("band", F.col("class").alias("b"), F.col("n").alias("nb"), F.col("words").alias("wb"))
    x = pairs.join(one, ["band", "a"]).join(two, ["band", "b"])
    return x.where(hamming("wa", "wb") * (100 + percent) <= (F.col("na") + F.col("nb")) * (100 - percent)).select("a", "b").distinct()


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    x = pairs.join(sets.toDF("a", "s"), "a").join(sets.toDF("b", "t"), "b")
    x = x.withColumn("hits", F.size(F.array_intersect("s", "t")))
    return x.where(F.col("hits") * 100 >= (F.size("s") + F.size("t") - F.col("hits")) * percent).select("a", "b")


def joined(docs: DataFrame, percent: int = PERCENT, words: int = WORDS) -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` for documents ``(doc_id, text)``: two documents link when the Jaccard
    similarity of their sets is ``percent`` or more (70 to 99)."""
    if not 70 <= percent <= 99:
        raise ValueError("70 to 99 percent")
    docs = narrow(docs, "doc_id", "text")
    sk = stored(docs.withColumn("text_hash", F.xxhash64("text")).mapInArrow(_sketches(percent, words), SCHEMA), "sketches")
    classes = sk.where("n_shingles > 0").groupBy("class").agg(
        F.min("doc_id").alias("doc_id"), *[F.first(c).alias(c) for c in (
            "n_shingles", "band", "most", "words", "next_band", "next_most", "next_words")])
    classes = stored(classes.withColumnRenamed("n_shingles", "n"), "classes")
    sketches = classes.select("class", "n", "band", "most", "words").union(
        classes.select("class", "n", "next_band", "next_most", "next_words")).where("band is not null")
    lists = stored(_lists(sketches), "lists")

    pairs = stored(_near(_hub_pairs(lists, percent), sketches, percent), "pairs")
    ends = pairs.select(F.col("a").alias("class")).union(pairs.select("b")).distinct()
    sets = whole_sets(ends, docs, sk, words)
    label = star_components(stored(_verified(pairs, sets, percent), "links"))
    mixed = stored(_mixed_lists(lists.select("v", "class", "n"), label), "mixed")
    if not mixed.isEmpty():
        more = mixed.select("class").distinct().join(sets.select("class"), "class", "left_anti")
        sets = sets.union(whole_sets(more, docs, sk, words))
        label = joined_components(label, _rest_links(mixed, sets, percent))

    comp = classes.select("class", "doc_id").join(label.withColumnRenamed("node", "class"), "class", "left")
    comp = comp.withColumn("label", F.coalesce("label", "class"))
    least = comp.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    comp = comp.join(least, "label").select("class", "component_id")
    out = sk.select("doc_id", "n_shingles", "class").join(comp, "class", "left")
    return out.select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(
        F.col("doc_id")).alias("component_id"))


def components_sql(words: int, percent: int) -> str:
    """DuckDB SQL of ``(doc_id, n_shingles, component_id)`` over ``documents`` with distinct doc_ids."""
    gram = " || ' ' || ".join(["w[i]"] + [f"w[i + {k}]" for k in range(1, words)])
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({lower}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
g AS (SELECT doc_id, CASE WHEN len(w) < {words} THEN array_to_string(w, ' ') ELSE {gram} END AS s
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - {words - 1}, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
s AS (SELECT DISTINCT doc_id, s FROM g),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
h AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS hits FROM s x JOIN s y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM h JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * hits >= {percent} * (p.n + q.n - hits)),
r AS (SELECT doc_id, doc_id AS x FROM d UNION SELECT r.doc_id, l.b FROM r JOIN l ON l.a = r.x),
c AS (SELECT doc_id, min(x) AS component_id FROM r GROUP BY doc_id)
SELECT c.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c.component_id FROM c LEFT JOIN n USING (doc_id)
"""
