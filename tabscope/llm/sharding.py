"""Sharding by balanced label propagation.

Documents with equal texts are linked.  A group of links that would fill more than half a shard is split into
units (by a hash), so no unit is larger than that.  Every document starts in a hash shard.  In each round the
documents of a unit look, through a join, where their neighbours lie, and want to move to the shard that holds most
of them; a shard admits as many as its quota has room for, unit by unit.  At last the documents without links
(and linked ones above a shard's quota) fill what is left of the quotas.  The law is ``rows``: shard counts differ by
one at most.

Everything is DataFrame functions; ranks go over (shard, hash block) so that no task holds a shard; every round's
assignment is a stored table.

Defined cases: null text counts as empty (size 1) and is linked with empty texts; a null doc_id takes part like any
other; rows that repeat doc_id and text are told apart by a running number; an empty table gives an empty result;
other columns are ignored."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabscope.llm.common import before, hash_bits, narrow, stored

SHARDS = 16
ROUNDS = 3
UNIT_BITS, ROW_BITS = 7, 5


def _items(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = narrow(docs, "doc_id", "text").select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.unhex(F.md5(text)).alias("g"))
    rows = rows.groupBy("doc_id", "size", "text_crc32", "g").agg(F.count("*").alias("n"))
    rows = rows.withColumn("k", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n")))).drop("n")
    return rows.withColumn("o", F.xxhash64("doc_id", "g", "k"))


def _block():
    """Blocks of a rank: units first, then the documents of a unit."""
    return hash_bits("u", UNIT_BITS) * (1 << ROW_BITS) + hash_bits("o", ROW_BITS)


ORDER = ["u", "o", "k", "doc_id"]


def assign(docs: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """``(doc_id, size, text_crc32, g, k, o, u, linked, shard)`` for each row; ``u`` is the unit's hash."""
    items = stored(_items(docs), "items")
    total = items.count()
    groups = items.groupBy("g").agg(F.count("*").alias("c")).where("c > 1")
    half = max(1, total // (2 * shards))
    cur = items.join(groups, "g", "left").withColumn("linked", F.col("c").isNotNull()).withColumn(
        "part", F.pmod(F.xxhash64("o"), F.ceil(F.coalesce("c", F.lit(1)) / half)))
    cur = cur.withColumn("u", F.xxhash64("g", "part")).drop("c", "part").withColumn("shard", F.pmod("o", F.lit(shards)).cast("int"))
    cur = stored(cur, "start")
    quota = F.lit(total // shards) + (F.col("shard") < total % shards).cast("int")
    for _ in range(rounds):
        held = cur.where("linked").groupBy("u", "g", "shard").agg(F.count("*").alias("c"))
        wish = held.groupBy("u", "g").agg(F.max(F.struct("c", F.xxhash64("u", "shard").alias("h"), "shard"))["shard"].alias("wish"))
        movers = stored(cur.where("linked").join(wish, ["u", "g"]).select("u", "o", "k", "doc_id", "g", "shard", "wish"), "wishes")
        stay = movers.where("shard = wish").groupBy("shard").agg(F.count("*").alias("stay"))
        room = stay.select(F.col("shard").alias("to"), (quota - F.col("stay")).alias("room"))
        movers = movers.where("shard <> wish").drop("shard")
        ranked = before(movers, ["wish"], _block(), ORDER, F.lit(1), "rank").join(F.broadcast(room), F.col("wish") == F.col("to"), "left")
        quota_free = F.coalesce("room", F.lit(total // shards))  # nobody wants to stay: room for a whole quota
        moves = ranked.where(F.col("rank") < quota_free).select(
            F.col("o").alias("_o"), F.col("g").alias("_g"), F.col("k").alias("_k"), F.col("doc_id").alias("_id"), "wish")
        same = ((F.col("o") == F.col("_o")) & (F.col("g") == F.col("_g")) & (F.col("k") == F.col("_k"))
                & F.col("doc_id").eqNullSafe(F.col("_id")))
        moved = cur.join(moves, same, "left").withColumn("shard", F.coalesce("wish", "shard"))
        cur = stored(moved.select(*cur.columns), "round")
    # settle: linked documents stay up to the quota, the others fill what is left
    ranked = stored(before(cur.where("linked"), ["shard"], _block(), ORDER, F.lit(1), "rank"), "ranked")
    stay = ranked.where(F.col("rank") < quota).drop("rank")
    pool = stored(ranked.where(F.col("rank") >= quota).drop("rank").union(cur.where("not linked")), "pool")
    load = {r["shard"]: r["load"] for r in stay.groupBy("shard").agg(F.count("*").alias("load")).collect()}
    high = 0  # the ranks of the pool that each shard takes end here; a number per shard
    highs = []
    for i in range(shards):
        high += total // shards + (i < total % shards) - load.get(i, 0)
        highs.append(F.lit(high).cast("long"))
    placed = before(pool, [], _block(), ORDER, F.lit(1), "rank")
    return stay.union(placed.withColumn("shard", F.size(F.filter(F.array(*highs), lambda h: h <= F.col("rank"))))
                      .select(*stay.columns))


def shards(docs: DataFrame, n: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """``(doc_id, size, text_crc32, law, shard, slot, grown_shard)``: slots are gapless from 0 in each shard."""
    placed = stored(assign(docs, n, rounds), "placed")
    out = before(placed, ["shard"], _block(), ORDER, F.lit(1), "slot")
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", F.col("slot").cast("long").alias("slot"),
                      F.lit(None).cast("int").alias("grown_shard"))


def cut_links(placed: DataFrame) -> DataFrame:
    """How many documents of a group lie outside the shard that holds most of it, and how many are linked."""
    c = placed.groupBy("text_crc32", "size", "shard").agg(F.count("*").alias("c")).groupBy("text_crc32", "size").agg(
        F.sum("c").alias("n"), F.max("c").alias("most")).where("n > 1")
    return c.agg(F.sum(F.col("n") - F.col("most")).alias("cut"), F.sum("n").alias("linked"))
