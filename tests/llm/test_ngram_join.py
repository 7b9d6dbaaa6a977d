import random

import numpy as np
import pytest
from brute import SF, near_dup_rows

from tabscope.llm.graph import star_components
from tabscope.llm.ngram_join import difference, joined, parity_sketch


def compare(spark, rows, percent=90, words=3):
    got = {r.doc_id: (r.n_shingles, r.component_id)
           for r in joined(spark.createDataFrame(rows, "doc_id long, text string"), percent, words).collect()}
    assert got == {d: (n, c) for d, n, c in near_dup_rows(rows, percent, words)}


def test_hamming_bounds_the_symmetric_difference():
    rng = np.random.default_rng(4)
    for n, m in ((12, 1), (50, 4), (400, 30), (3000, 200)):
        a = np.unique(rng.integers(0, 1 << 63, n))
        b = np.unique(np.concatenate([a[m:], rng.integers(0, 1 << 63, m)]))
        different = len(np.setxor1d(a, b))
        blocks = different + 3
        x, y = parity_sketch(a, blocks), parity_sketch(b, blocks)
        assert sum(int(v).bit_count() for v in (x ^ y).view(np.uint64)) <= different and (x == y).sum() >= 3
    for total in range(400):  # the bound itself: one more differing shingle is under 90 %
        d = difference(total, 90)
        assert 100 * (total - d) >= 90 * (total + d) and 100 * (total - d - 1) < 90 * (total + d + 1)


def test_documents_against_brute_force(spark):
    compare(spark, [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()])


def family(rng, n, copies, rate, name):
    base = [f"{name}{rng.randrange(3 * n)}" for _ in range(n)]
    for _ in range(copies):
        w = list(base)
        for _ in range(rng.randrange(0, max(2, int(n * rate)))):
            w[rng.randrange(len(w))] = f"x{rng.randrange(10**6)}"
        yield " ".join(w)


def test_edited_copies_chains_and_thresholds(spark):
    rng = random.Random(8)
    texts = []
    for n in (5, 9, 10, 11, 12, 13, 18, 19, 40, 41, 60, 150, 400, 1500):
        texts += family(rng, n, 25, 0.03, f"a{n}_")
        words = [f"c{n}_{i}" for i in range(n)]
        for held in range(max(1, n * 85 // 100), n + 1, max(1, n // 40)):  # beginnings of one text: chains over sizes and bands
            texts.append(" ".join(words[:held]))
    texts += [None, "", " \t", "one", "ONE", "one two", "two one", "a b c", "A B C", "x " * 4000, "x " * 60]
    rng.shuffle(texts)
    compare(spark, list(enumerate(texts)))


def test_lists_that_mix_components(spark):
    rng = random.Random(9)
    texts = list(family(rng, 120, 150, 0.12, "m"))  # likeness on both sides of the threshold
    boiler = " ".join(f"b{i}" for i in range(200))
    texts += [boiler + " " + " ".join(f"u{j}_{i}" for i in range(rng.randrange(10, 60))) for j in range(80)]
    compare(spark, list(enumerate(texts)))
    compare(spark, list(enumerate(texts[:60])), 75, 5)


def test_null_ids_repeats_and_empty(spark):
    s = "doc_id long, text string"
    assert joined(spark.createDataFrame([], s)).collect() == []
    t = " ".join(f"w{i}" for i in range(40))
    rows = [(None, t)] * 3 + [(3, t), (3, t), (3, t + " more"), (1, None), (None, None), (None, "lone text here"), (8, t + " other")]
    df = spark.createDataFrame(rows, s).selectExpr("*", "1 as class", "2 as v", "3 as band")
    got = sorted(map(tuple, joined(df).collect()), key=str)
    assert got == sorted([(None, 38, 3)] * 3 + [(3, 38, 3), (3, 38, 3), (3, 39, 3), (1, 0, 1), (None, 0, None), (None, 1, None), (8, 39, 3)], key=str)
    twice = df.toDF("doc_id", "text", "TEXT", "v", "band")
    assert len(joined(twice).collect()) == len(rows)
    with pytest.raises(ValueError):
        joined(df, 60)


def test_star_components(spark):
    rng = random.Random(2)
    for n, m in ((30, 20), (300, 260), (200, 1000)):
        edges = [(rng.randrange(n), rng.randrange(n)) for _ in range(m)] + [(n + i, n + i + 1) for i in range(40)]
        root = {x: x for e in edges for x in e}
        for _ in range(200):
            for a, b in edges:
                root[a] = root[b] = min(root[a], root[b])
        got = {r.node: r.label for r in star_components(spark.createDataFrame(edges, "a long, b long")).collect()}
        assert got == {x: v for x, v in root.items() if any(a != b and x in (a, b) for a, b in edges)}
    assert star_components(spark.createDataFrame([], "a long, b long")).collect() == []
