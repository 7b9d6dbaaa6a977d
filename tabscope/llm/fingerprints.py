"""Document fingerprints by SpotSigs.

Words are the runs of letters and digits of the lower-cased text.  Where a common word (an antecedent) is followed by
a content word, the signature ``antecedent c1 c2`` chains it to the next two content words, common words between
them skipped; of several antecedents in a row the last one counts.  A text's signatures form a set of 64-bit
hashes (a text without any chain has one signature: all its words).  The fingerprint names that set; the likeness of
two fingerprints is the Jaccard similarity of their sets.

``near_duplicates`` compares all fingerprints: sets are partitioned by length so that only equal or neighbouring
partitions can reach the threshold, listed under their rarest signatures, and pairs whose lengths rule out the
threshold are pruned before the exact similarity is taken.  Members of a list meet in blocks of bounded size, out of
which only near pairs come; no registered query calls it.

Everything is DataFrame functions.  Neighbours in doc_id order are found inside blocks of ids (``BLOCK_ROWS`` rows;
raise it for corpora of very many documents), and each block also gets the first row of the next one.

Defined cases: null text counts as empty; texts without words share one fingerprint, are like each other (1.0) and
unlike all others (0.0); a null doc_id comes after all others; rows that repeat a doc_id are ordered by a hash of
their text; one document is its own next one; an empty table gives an empty result; other columns are ignored."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabscope.llm.common import narrow, stored

CHAIN = 2
BLOCK_ROWS = 2000
SIMILARITY = 0.75
#: Members and signatures of a block in which members of a list meet (about, but for a single larger set).
LIST_BLOCK, LIST_SIGNATURES = 128, 1 << 16

# Common words (antecedents) of English, German, French and Spanish.
ANTECEDENTS = (
    "a an the of to in on at by for from with and or but not is are was were be been it this that these those he she "
    "they we you i his her their our your as if then than so do does did has have had will would can could which who what "
    "der die das den dem des ein eine einer eines und oder aber nicht ist sind war von zu im mit auf für als auch sich es "
    "le la les un une des du de et ou mais ne pas est sont dans sur par pour avec que qui ce cette il elle au aux en "
    "el los las una unos y o pero no es son del al con por para se lo su sus"
).split()


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)`` with the value computed once, also where ``then`` uses it inside a lambda."""
    return F.get(F.transform(F.array(value), then), 0)


def signatures(text: Column, chain: int = CHAIN) -> Column:
    """The sorted distinct signature hashes of a text."""
    stops = "|".join(sorted(set(ANTECEDENTS)))

    def chained(parts):
        def one(p, i):
            tail = [F.regexp_replace(F.coalesce(F.get(parts, i + j), F.lit("")), "^[^ ]*", "") for j in range(1, chain)]
            return F.substring_index(F.concat(p, *tail), " ", chain + 1)
        whole = F.filter(F.transform(parts, one), lambda s: F.length(s) - F.length(F.replace(s, F.lit(" "), F.lit(""))) >= chain)
        return F.transform(whole, lambda s: F.xxhash64(s))

    def of_words(words):
        marked = F.regexp_replace(F.concat(F.lit(" "), words, F.lit(" ")), f" (?=(?:{stops}) )", "\u0001")
        # after each mark: an antecedent and the content words up to the next one; antecedents without any drop out
        parts = F.filter(F.transform(F.slice(F.split(marked, "\u0001"), 2, 1 << 30), lambda p: F.trim(p)), lambda p: F.instr(p, " ") > 0)
        alone = F.when(F.length(words) > 0, F.array(F.xxhash64(words))).otherwise(F.array().cast("array<bigint>"))
        return _let(_let(parts, chained), lambda h: F.when(F.size(h) > 0, F.array_sort(F.array_distinct(h))).otherwise(alone))
    return _let(F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " ")), of_words)


def name_of(set_column: str) -> Column:
    """The fingerprint: 128 bits of the set in hex."""
    s = F.col(set_column)
    return F.lower(F.concat(*[F.lpad(F.hex(F.xxhash64(F.lit(seed), s)), 16, "0") for seed in (1, 2)]))


def likeness(a: str | Column, b: str | Column) -> Column:
    both = F.size(F.array_intersect(a, b))
    union = F.size(a) + F.size(b) - both
    return F.when(union == 0, F.lit(1.0)).otherwise(both / F.when(union > 0, union)).cast("double")


def fingerprints(docs: DataFrame) -> DataFrame:
    """``(doc_id, fingerprint, signatures)``."""
    d = narrow(docs, "doc_id", "text").select("doc_id", signatures(F.coalesce("text", F.lit(""))).alias("signatures"))
    return d.select("doc_id", name_of("signatures").alias("fingerprint"), "signatures")


# ------------------------------------------------------------------ the next document
def _blocks(docs: DataFrame, block_rows: int) -> Column:
    """Number of the block of ids that a row lies in: bounds are approximate quantiles of doc_id, found by two
    short searches; rows without doc_id come after them, by bits of their text's hash."""
    n = docs.agg(F.count("doc_id")).first()[0]
    count = max(1, n // block_rows)
    cuts = docs.agg(F.percentile_approx("doc_id", [i / count for i in range(1, count)], 20 * count)).first()[0] if count > 1 else []
    cuts = sorted(set(cuts or []))
    step = max(1, int(len(cuts) ** 0.5))
    rows = [cuts[i:i + step] for i in range(0, len(cuts), step)]

    def at_most(bounds):
        return F.size(F.filter(bounds, lambda b: b <= F.col("doc_id")))
    if not cuts:
        place = F.lit(0)
    else:
        tops = F.array(*[F.lit(r[0]).cast("long") for r in rows])
        table = F.array(*[F.array(*[F.lit(c).cast("long") for c in r]) for r in rows])
        row = at_most(tops)
        place = F.when(row == 0, 0).otherwise((row - 1) * step + at_most(F.get(table, row - 1)))
    return F.when(F.col("doc_id").isNull(), F.lit(len(cuts) + 1) + F.pmod("_tie", F.lit(64)).cast("int")).otherwise(place).cast("int")


def with_next(docs: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``(doc_id, text, next_text, signatures, next_signatures)``: each document with the next one by doc_id, the last
    with the first.  Null texts are empty."""
    d = narrow(docs, "doc_id", "text").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    d = d.withColumn("_tie", F.xxhash64("text"))
    d = d.withColumn("_block", _blocks(d, block_rows))
    order = F.struct(F.col("doc_id").isNull().alias("n"), F.col("doc_id").alias("d"), F.col("_tie").alias("t"))
    heads = d.groupBy("_block").agg(F.min(order).alias("first"))
    line = Window.orderBy("_block")  # a row per block
    heads = heads.withColumn("to", F.coalesce(F.lag("_block").over(line), F.max("_block").over(Window.partitionBy())))
    heads = stored(heads, "heads")
    heads = heads.select(F.col("_block").alias("b"), F.col("first.d").alias("d"), F.col("first.t").alias("t"), "to")
    same = (F.col("_block") == F.col("b")) & F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("_tie") == F.col("t"))
    extra = d.join(F.broadcast(heads), same).select("doc_id", "text", "_tie", F.col("to").alias("_block"), F.lit(True).alias("_extra"))
    both = d.select("doc_id", "text", "_tie", "_block", F.lit(False).alias("_extra")).union(extra)
    w = Window.partitionBy("_block").orderBy("_extra", F.col("doc_id").isNull(), "doc_id", "_tie")
    x = both.withColumn("next_text", F.lead("text").over(w))
    x = x.withColumn("signatures", signatures(F.col("text"))).withColumn("next_signatures", F.lead("signatures").over(w))
    return x.where(~F.col("_extra")).select("doc_id", "text", "next_text", "signatures", "next_signatures")


def compared(docs: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, n_signatures)``:
    the edited text has its last half replaced by as much of the next document's beginning."""
    x = with_next(docs, block_rows).withColumn("n_chars", F.length("text").cast("long"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), (F.col("n_chars") - half).cast("int")), F.substring("next_text", F.lit(1), half))
    x = x.withColumn("edited", edited)
    x = x.withColumn("edited_signatures", signatures(F.col("edited")))
    return x.select("doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
                    name_of("signatures").alias("fingerprint"), name_of("edited_signatures").alias("edited_fingerprint"),
                    likeness("signatures", "edited_signatures").alias("near_edited"),
                    likeness("signatures", "next_signatures").alias("near_next"), F.size("signatures").cast("long").alias("n_signatures"))


# ------------------------------------------------------------------ all near pairs
def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY) -> tuple[DataFrame, DataFrame]:
    """Members ``(doc_id, fingerprint)`` and near pairs of fingerprints ``(a, b, likeness)`` with a < b: documents of
    one fingerprint are alike, so only fingerprints are compared."""
    sets = stored(fingerprints(docs), "fingerprints")
    classes = stored(sets.where(F.size("signatures") > 0).groupBy("fingerprint").agg(F.first("signatures").alias("s")), "sets")
    posts = classes.select("fingerprint", F.size("s").alias("n"), F.explode("s").alias("sig"))
    rare = posts.groupBy("sig").agg(F.count("*").alias("c"))
    at = F.row_number().over(Window.partitionBy("fingerprint").orderBy("c", "sig"))
    lists = posts.join(rare, "sig").withColumn("at", at).where(
        F.col("at") <= F.col("n") - F.ceil(F.col("n") * similarity) + 1).where("c > 1")
    part = F.floor(F.log(F.col("n")) / F.log(F.lit(1 / similarity)) + 1e-9).cast("int")
    lists = stored(lists.select("sig", "fingerprint", "n", part.alias("part")), "lists")
    return sets.select("doc_id", "fingerprint"), _near_pairs(lists, classes, similarity)


def _near_pairs(lists: DataFrame, classes: DataFrame, similarity: float) -> DataFrame:
    """Near pairs of the lists' members.  The members of a partition and of the one below meet those of the
    partition, a block of each side at a time; a pair counts at the smallest signature that lists both."""
    sides = lists.select("sig", "fingerprint", "n", F.col("part").alias("own"), F.explode(F.array("part", F.col("part") + 1)).alias("part"))
    upper = F.col("own") == F.col("part")

    def blocks(members: Column, signatures: Column) -> Column:
        return F.greatest(F.ceil(members / LIST_BLOCK), F.ceil(signatures / LIST_SIGNATURES)).cast("long")
    grid = sides.groupBy("sig", "part").agg(
        F.count("*").alias("c"), blocks(F.count("*"), F.sum("n")).alias("rows"),
        blocks(F.count_if(upper), F.sum(F.when(upper, F.col("n")))).alias("columns")).where("columns > 0 and c > 1").drop("c")
    listed = lists.groupBy("fingerprint").agg(F.collect_list("sig").alias("listed"))
    members = sides.join(grid, ["sig", "part"]).join(listed, "fingerprint").join(classes, "fingerprint")
    members = members.withColumn("m", F.struct("fingerprint", "n", (~upper).alias("below"), "listed", "s"))
    hashed = F.xxhash64("fingerprint")
    one = members.select("sig", "part", F.pmod(hashed, F.col("rows")).alias("i"),
                         F.explode(F.sequence(F.lit(0).cast("long"), F.col("columns") - 1)).alias("j"), F.lit(True).alias("side"), "m")
    two = members.where(upper).select("sig", "part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("rows") - 1)).alias("i"),
                                      F.pmod(hashed, F.col("columns")).alias("j"), F.lit(False).alias("side"), "m")
    met = one.union(two).groupBy("sig", "part", "i", "j").agg(
        F.collect_list(F.when(F.col("side"), F.col("m"))).alias("x"), F.collect_list(F.when(~F.col("side"), F.col("m"))).alias("y"))

    def meets(p, q):
        return ((p["below"] | (p["fingerprint"] < q["fingerprint"]))
                & (F.least(p["n"], q["n"]) >= F.greatest(p["n"], q["n"]) * similarity - 1e-9)
                & (F.array_min(F.array_intersect(p["listed"], q["listed"])) == F.col("sig")))

    def pair(p, q):
        return F.struct(F.least(p["fingerprint"], q["fingerprint"]).alias("a"), F.greatest(p["fingerprint"], q["fingerprint"]).alias("b"),
                        likeness(p["s"], q["s"]).alias("likeness"))

    def near(p):
        pairs = F.transform(F.filter("y", lambda q: meets(p, q)), lambda q: pair(p, q))
        return F.filter(pairs, lambda r: r["likeness"] >= similarity)
    return met.select(F.explode(F.flatten(F.transform("x", near))).alias("pair")).select("pair.a", "pair.b", "pair.likeness")
