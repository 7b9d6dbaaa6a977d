import math
import random
import re
from collections import Counter

import numpy as np
from brute import SF, lower

from tabscope.llm import lexical_search
from tabscope.llm.lexical_search import packed, search, term_counts, unpacked

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def brute(docs, items, k=50):
    counts = [Counter(TERM.findall(lower(t))) for _, t in docs]
    n_docs, n_terms = sum(1 for c in counts if c), sum(sum(c.values()) for c in counts)
    df = Counter(t for c in counts for t in c)
    out = []
    for item, text in items:
        found = []
        for (d, _), c in zip(docs, counts, strict=True):
            m = 50 + (50 * sum(c.values()) * n_docs) // max(n_terms, 1)
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m))
                    for t in set(TERM.findall(lower(text))) if c[t])
            if s > 0:
                found.append((-s, d is None, d))
        out += [(item, r, d, -s) for r, (s, _, d) in enumerate(sorted(found, key=lambda x: (x[0], x[1], x[2] or 0))[:k], 1)]
    return sorted(out, key=str)


def found(spark, docs, items, **params):
    return sorted(map(tuple, search(spark.createDataFrame(docs, "doc_id long, text string"),
                                    spark.createDataFrame(items, "item_id long, text string"), **params).collect()), key=str)


def test_terms():
    rng = random.Random(1)
    for _ in range(200):
        t = "".join(rng.choice("aZ0 9.éKİ-_@[`{~\x00\x7f\x80ß\n'") for _ in range(60))
        assert Counter(w.decode() for w in term_counts(t.encode()).elements()) == Counter(TERM.findall(lower(t)))


def test_long_texts_are_counted_in_pieces(monkeypatch):
    text = b"one two  three " * 1000
    whole = term_counts(text)
    monkeypatch.setattr(lexical_search, "PIECE", 50)
    assert term_counts(text) == whole == Counter({b"one": 1000, b"two": 1000, b"three": 1000})
    assert term_counts(b"x" * 500) == Counter({b"x" * 500: 1})


def test_blocks_round_trip():
    rng = np.random.default_rng(2)
    term = np.repeat(np.arange(5), (1, 128, 129, 700, 3))
    doc = np.concatenate([np.sort(rng.choice(70000, n, replace=False)) for n in (1, 128, 129, 700, 3)])
    count = rng.integers(1, 70000, len(term))
    p = packed(term, doc, count, rng.integers(50, 500, 70000))
    got = [unpacked(p["payload"][a:b], f) for a, b, f in zip(p["block_at"][:-1], p["block_at"][1:], p["block_first"], strict=True)]
    assert p["first_block"].tolist() == [0, 1, 2, 4, 10, 11]
    assert np.array_equal(np.concatenate([g[0] for g in got]), doc) and np.array_equal(np.concatenate([g[1] for g in got]), count)


def test_documents_against_brute_force(spark, monkeypatch):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    want = brute(docs, items)
    assert found(spark, docs, items) == want and len(want) > 500
    assert found(spark, docs, items, item_bytes=3000) == want  # several blocks of items
    assert found(spark, docs, items, k=3) == brute(docs, items, 3)


def test_pruning_changes_nothing(spark):
    rng = random.Random(6)
    common = [f"c{i}" for i in range(12)]
    docs = [(i, " ".join(rng.choices(common, k=rng.randrange(1, 90)) + [f"r{rng.randrange(300)}" for _ in range(rng.randrange(4))]))
            for i in range(5000)]
    items = [(i, " ".join(common[:6] + [f"r{i}", f"r{i + 7}"])) for i in range(20)]
    assert found(spark, docs, items, k=10) == brute(docs, items, 10)


def test_defined_cases(spark):
    docs = [(None, "alpha beta"), (None, "alpha beta"), (4, "alpha beta"), (4, "alpha beta"), (2, "Alpha, BETA!"), (7, None), (8, ""),
            (9, " .,;"), (10, "gamma " * 3000 + "delta"), (11, "delta")] + [(20 + i, f"other{i}") for i in range(30)]
    items = [(1, "alpha"), (1, "alpha delta"), (None, "gamma"), (5, None), (6, "..."), (7, "unseen")]
    want = brute(docs, items)
    assert found(spark, docs, items) == want and [r for r in want if r[0] is None]
    s, t = "doc_id long, text string", "item_id long, text string"
    empty, some = spark.createDataFrame([], s), spark.createDataFrame(docs, s)
    assert search(empty, spark.createDataFrame(items, t)).collect() == []
    assert search(some, spark.createDataFrame([], t)).collect() == []
    assert search(spark.createDataFrame([(1, None)], s), spark.createDataFrame(items, t)).collect() == []
    clash = some.selectExpr("doc_id", "text", "1 as n", "2 as TERMS", "text as TEXT2").toDF("doc_id", "text", "n", "TERMS", "TEXT")
    assert sorted(map(tuple, search(clash, spark.createDataFrame(items, t)).collect()), key=str) == want
