import zlib
from collections import Counter

from brute import SF

from tabscope.llm import sharding

S = "doc_id long, text string"


def check(rows, got, n):
    assert sorted((r.doc_id is None, r.doc_id or 0, r.size, r.text_crc32) for r in got) == sorted(
        (d is None, d or 0, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in rows)
    shards = {}
    for r in got:
        assert r.law == "rows" and r.grown_shard is None
        shards.setdefault(r.shard, []).append(r.slot)
    assert all(0 <= s < n for s in shards)
    assert all(sorted(v) == list(range(len(v))) for v in shards.values())
    sizes = [len(shards.get(s, [])) for s in range(n)]
    assert max(sizes) - min(sizes) <= 1
    where = {}
    for r in got:
        where.setdefault((r.text_crc32, r.size), []).append(r.shard)
    return where


def test_given_documents(spark):
    d = spark.read.parquet(f"{SF}/documents.parquet")
    where = check([(r.doc_id, r.text) for r in d.collect()], sharding.shards(d).collect(), 16)
    assert all(len(set(v)) == 1 for v in where.values())  # no link is cut: no group is large


def test_hot_group_is_split_into_few_shards_and_the_rest_stays_whole(spark):
    rows = [(i, "hot") for i in range(400)] + [(1000 + i, f"text {i // 4}") for i in range(600)] + [(5000 + i, f"alone {i}") for i in range(203)]
    d = spark.createDataFrame(rows, S)
    got = sharding.shards(d).collect()
    where = check(rows, got, 16)
    hot = Counter(where[(zlib.crc32(b"hot"), 4)]).most_common(11)  # units of half a shard: eleven of them
    assert sum(n for _, n in hot) >= 320
    cut = sum(len(set(v)) > 1 for k, v in where.items() if k[1] != 4)
    assert cut <= 8
    again = sharding.shards(d.repartition(9)).collect()
    assert sorted((r.doc_id, r.shard, r.slot) for r in got) == sorted((r.doc_id, r.shard, r.slot) for r in again)


def test_nulls_repeats_few_and_empty(spark):
    assert sharding.shards(spark.createDataFrame([], S)).collect() == []
    rows = [(None, None), (None, None), (1, ""), (1, ""), (2, "a"), (2, "b"), (None, "a")]
    check(rows, sharding.shards(spark.createDataFrame(rows, S).selectExpr("*", "3 as shard", "4 as o")).collect(), 16)
