import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest
from brute import SF, WS_WORD

from tabscope.llm.periodic_runs import digests, runs, runs_of, with_planted_repeats


def brute_runs(words, least=6, times=4):
    """Every stretch that keeps a period and can't grow, smallest period of each."""
    n, out = len(words), {}
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(least, times * q):
                out.setdefault((i, j - i + q), q)
            i = j + 1
    return sorted((s, length, q) for (s, length), q in out.items())


def edited(doc_id, text):
    w = WS_WORD.findall(text or "")
    n = len(w)
    h = zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and n and doc_id is not None:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = w[:a] + [w[a + (i - a) % p] for i in range(a, n)]
    return w


def brute_row(doc_id, text):
    w = edited(doc_id, text)
    r = brute_runs(w)
    best = min(r, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2]), default=(None,) * 3)
    gone = {i for s, length, q in r for i in range(s + q, s + length)}
    return (doc_id, len(r), *best, 1000 * best[1] // best[2] if r else None,
            hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in r).encode()).hexdigest(),
            hashlib.sha256(" ".join(x for i, x in enumerate(w) if i not in gone).encode()).hexdigest())


def rows_of(df):
    return sorted(map(tuple, digests(runs(with_planted_repeats(df))).collect()), key=str)


def test_kernel_against_brute_force():
    rng = random.Random(3)
    for trial in range(600):
        n, letters = rng.randrange(0, 70), rng.choice((1, 2, 2, 3, 8))
        w = [rng.randrange(letters) for _ in range(n)]
        for _ in range(rng.randrange(3)):  # plant a repeat
            if n > 12:
                a, q = rng.randrange(n - 10), rng.randrange(1, 6)
                for i in range(a + q, min(n, a + q * rng.randrange(2, 9))):
                    w[i] = w[i - q]
        ids = {x: i for i, x in enumerate(dict.fromkeys(w))}
        got = [tuple(r) for r in runs_of(np.array([ids[x] for x in w], np.int64)).tolist()]
        assert got == brute_runs(w), w


def test_kernel_on_fibonacci_and_long_words():
    a, b = [0], [0, 1]
    while len(b) < 2000:
        a, b = b, b + a
    for w in (b, [0] * 3000, [0, 1, 2] * 900 + [3] + [0, 1, 2] * 500, [0, 0, 1] * 300):
        assert [tuple(r) for r in runs_of(np.array(w, np.int64)).tolist()] == brute_runs(w)


def test_documents_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = sorted((brute_row(r.doc_id, r.text) for r in docs.collect()), key=str)
    got = rows_of(docs)
    assert got == want and sum(r[1] > 0 for r in got) > 5


def test_defined_cases(spark):
    long = " ".join(["x y z"] * 30000 + ["end"] + ["q"] * 500)
    texts = [None, "", " \t\n\x0b", "a", "a a a a a", "a a a a a a", "A a A a A a A a", "é é é é é é é", "a a " * 9, long,
             "\x1c \x1d " * 8, "a a a a a a b b b b b b a a a a a a"]
    rows = [(i if i else None, t, 1, 2) for i, t in enumerate(texts)] + [(5, "a a a a a a", 1, 2)] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string, words int, RUNS int")
    want = sorted((brute_row(d, t) if t != long else None for d, t, *_ in rows if t != long), key=str)
    got = [r for r in rows_of(df) if r[0] != texts.index(long)]
    assert got == want
    one = runs(df.where(f"doc_id = {texts.index(long)}")).first()
    assert one.n_words == 90501 and [tuple(r) for r in one.runs] == [(0, 90000, 3), (90001, 500, 1)]
    assert one.collapsed == "x y z end q"
    twice = df.withColumn("TEXT2", df["text"]).toDF("doc_id", "text", "words", "RUNS", "TEXT")
    assert len(rows_of(twice)) == len(rows)
    assert runs(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    with pytest.raises(ValueError):
        runs(df, times=3)
