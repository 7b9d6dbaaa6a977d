"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming search, exact verification.

Words are the runs of ``[^\\x20\\x09-\\x0D]`` with A-Z in lower case; a text's shingles are its 5-word shingles, or its
whole word sequence where it has fewer words.  A benchmark item of m words is compared with windows of m words of
every document (the whole document where that is shorter).

1. A window without any shingle of an item has similarity 0, so windows are laid only where a document shares a
   shingle with an item: at the offset that puts the shared shingle in its place in the item, and ``SHIFT`` words
   to either side (for inserted or dropped words).
2. Each window gets a 64-bit SimHash of its shingles (weighted by how often they occur in it), each item too.
3. Fingerprints within ``RADIUS`` bits of each other agree in one of 4 blocks of 16 bits up to RADIUS // 4 bits
   (pigeonhole).  The item side lists all block values that near; fingerprints of windows look up their own values, so
   none within the radius is missed, and about one in seven pairs of unrelated ones of a length meets at all.  Each
   fingerprint is looked up once, however many windows have it.
4. The exact weighted Jaccard similarity of the shingle multisets (sum of the smaller counts over the sum of the
   larger ones) decides; for each document and item the best window is returned.

All of it is DataFrame functions.  The items' shingles are broadcast only if counted under ``MOST_ROWS`` rows, else they
are joined by shuffle; the listed block values (some ten thousand rows an item) are sorted and merged.

Defined cases: null or empty text and items without words match nothing; repeated rows (doc_id and text) give one
row; a null doc_id is searched like any other; empty tables give an empty result; other columns are ignored."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabscope.llm.common import ascii_lower, narrow, shielded, stored

WORDS = 5
SIMILARITY = 0.75
RADIUS = 19
BLOCKS, BLOCK_BITS = 4, 16
SHIFT = 1
#: Item tables of more rows than this aren't broadcast.
MOST_ROWS = 500_000
GAP = r"[\x20\x09-\x0D]+"


def words_of(text: str) -> Column:
    return F.filter(F.split(ascii_lower(F.coalesce(F.col(text), F.lit(""))), GAP), lambda w: w != "")


def shingle_hashes(words: str, k: int = WORDS) -> Column:
    """Hashes of the shingles in order; none without words."""
    n = F.size(words)
    many = F.transform(F.sequence(F.lit(1), n - k + 1), lambda i: F.xxhash64(F.slice(F.col(words), i, k)))
    return F.when(n >= k, many).when(n > 0, F.array(F.xxhash64(F.col(words)))).otherwise(F.array().cast("array<long>"))


def simhash(shingles: str) -> Column:
    """64 bits: a bit is set if more than half of the shingles' hashes have it, counting repeated ones."""
    def bit(b):
        votes = F.aggregate(F.col(shingles), F.lit(0), lambda a, h: a + F.call_function("getbit", h, b).cast("int") * 2 - 1)
        return F.call_function("shiftleft", (votes > 0).cast("long"), b)
    return F.aggregate(F.transform(F.sequence(F.lit(0), F.lit(63)), bit), F.lit(0).cast("long"), lambda a, x: a.bitwiseOR(x))


def _block(code: str, i: Column) -> Column:
    return F.call_function("shiftrightunsigned", F.col(code), (i * BLOCK_BITS).cast("int")).bitwiseAND(F.lit((1 << BLOCK_BITS) - 1))


def _near_values(radius: int) -> list[int]:
    """All differences of a block with at most radius // BLOCKS bits."""
    return [sum(1 << b for b in c) for n in range(radius // BLOCKS + 1) for c in combinations(range(BLOCK_BITS), n)]


def _sized(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= MOST_ROWS else df


def common_count(a: str, b: str) -> Column:
    """Sum over distinct values of the smaller of both counts."""
    def count(array, h):
        return F.size(F.filter(F.col(array), lambda x: x == h))
    return F.aggregate(F.array_intersect(a, b), F.lit(0), lambda s, h: s + F.least(count(a, h), count(b, h)))


def _items(benchmark: DataFrame) -> DataFrame:
    b = narrow(benchmark, "item_id", "text").select("item_id", words_of("text").alias("words")).where(F.size("words") > 0)
    b = b.select("item_id", F.size("words").alias("m"), shingle_hashes("words").alias("item")).distinct()
    return stored(b.withColumn("item_code", simhash("item")), "items")


def _rolling(words: str, k: int) -> Column:
    """Structs (k, pos, h) of the k-grams of a word array; none if it is shorter."""
    starts = F.when(F.size(words) >= k, F.sequence(F.lit(0), F.size(words) - k)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.struct(F.lit(k).alias("k"), i.alias("pos"), F.xxhash64(F.slice(F.col(words), i + 1, k)).alias("h")))


def windows(docs: DataFrame, items: DataFrame, shift: int = SHIFT) -> DataFrame:
    """``(doc_id, text_hash, start, m, window)``: item-sized windows around shared shingles."""
    places = items.withColumn("k", F.least("m", F.lit(WORDS))).select("m", "k", F.posexplode("item").alias("at", "h")).distinct()
    found_k = sorted(r["k"] for r in places.select("k").distinct().collect())  # at most WORDS numbers
    d = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), words_of("text").alias("words"))
    lists = [_rolling("words", k) for k in found_k or [WORDS]]
    grams = d.select("doc_id", "text_hash", F.size("words").alias("n"), F.inline(F.concat(*lists) if len(lists) > 1 else lists[0]))
    found = grams.join(_sized(places, places.count()), ["k", "h"])
    found = found.select("doc_id", "text_hash", "n", "m", (F.col("pos") - F.col("at")).alias("p")).distinct()
    moves = F.explode(F.sequence(F.lit(-shift), F.lit(shift)))
    found = found.select("doc_id", "text_hash", "n", "m", "p", moves.alias("move"))
    start = F.greatest(F.least(F.col("p") + F.col("move"), F.col("n") - F.col("m")), F.lit(0))
    wanted = found.select("doc_id", "text_hash", "m", start.alias("start")).distinct().groupBy(
        F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).agg(F.collect_list(F.struct("start", "m")).alias("wanted"))
    texts = docs.withColumn("text_hash", F.xxhash64("text"))
    same = texts["doc_id"].eqNullSafe(wanted["_id"]) & (texts["text_hash"] == wanted["_hash"])
    x = texts.join(wanted, same).select("doc_id", "text_hash", "wanted", words_of("text").alias("words"))
    x = x.select("doc_id", "text_hash", "words", F.inline("wanted"))
    x = x.withColumn("words", F.slice("words", F.col("start") + 1, F.col("m")))
    return x.select("doc_id", "text_hash", "start", "m", shingle_hashes("words").alias("window"))


def near_codes(codes: DataFrame, items: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``(m, code, item_code, distance)``: all pairs of ``codes (m, code)`` and items of m words whose fingerprints are
    within the radius.  A pair that meets in several blocks is kept where its first such block is."""
    number = F.explode(F.sequence(F.lit(0), F.lit(BLOCKS - 1)))
    near = _near_values(radius)
    own = items.select("m", "item_code").distinct()
    listed = own.select("m", "item_code", number.alias("block")).select("*", F.explode(F.lit(near)).alias("off"))
    listed = listed.select("m", "item_code", "block", _block("item_code", F.col("block")).bitwiseXOR(F.col("off")).alias("value"))
    keys = codes.select("m", "code", number.alias("block")).withColumn("value", _block("code", F.col("block")))
    pairs = keys.join(listed.hint("merge"), ["m", "block", "value"])
    pairs = pairs.withColumn("differ", F.col("code").bitwiseXOR(F.col("item_code"))).withColumn("distance", F.bit_count("differ"))
    met = F.array(*[F.bit_count(_block("differ", F.lit(i))) <= radius // BLOCKS for i in range(BLOCKS)])
    first = F.array_position(met, F.lit(True)) - 1
    return pairs.where((F.col("distance") <= radius) & (F.col("block") == first)).select("m", "code", "item_code", "distance")


def matches(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, radius: int = RADIUS) -> DataFrame:
    """``(doc_id, text_hash, start, m, item_id, similarity, distance)``: windows that hold an item."""
    docs = narrow(docs, "doc_id", "text")
    items = _items(benchmark)
    w = stored(windows(docs, items).withColumn("code", simhash("window")).distinct(), "windows")
    near = stored(near_codes(w.select("m", "code").distinct(), items, radius), "near_codes")
    near = near.join(items.select("item_id", "m", "item", "item_code"), ["m", "item_code"])
    pairs = w.join(near, ["m", "code"])
    both = common_count("window", "item")
    return pairs.withColumn("both", both).withColumn(
        "similarity", F.col("both") / (F.size("window") + F.size("item") - F.col("both"))).where(F.col("similarity") >= similarity)


def contaminated(docs: DataFrame, benchmark: DataFrame, **params) -> DataFrame:
    """``(doc_id, item_id, first_word, n_words, similarity, distance)``: the best window of each document for each
    item that it holds at the similarity or more."""
    best = F.max(F.struct("similarity", (-F.col("start")).alias("s"), "distance")).alias("b")
    return matches(docs, benchmark, **params).groupBy("doc_id", "item_id").agg(best, F.max("m").alias("n_words")).select(
        "doc_id", "item_id", (-F.col("b.s")).cast("long").alias("first_word"), F.col("n_words").cast("long").alias("n_words"),
        "b.similarity", F.col("b.distance").cast("int").alias("distance"))


def keep_clean(docs: DataFrame, benchmark: DataFrame, **params) -> DataFrame:
    """The documents that hold no benchmark item, all columns as they were."""
    x, (doc_id, text) = shielded(docs, "doc_id", "text")
    bad = matches(docs, benchmark, **params).select(F.col("doc_id").alias("bad"), "text_hash").distinct()
    same = F.col(doc_id).eqNullSafe(F.col("bad")) & (F.xxhash64(text) == F.col("text_hash"))
    return x.join(bad, same, "left_anti").toDF(*docs.columns)
