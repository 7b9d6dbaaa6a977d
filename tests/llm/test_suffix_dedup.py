import hashlib
import random

from brute import SF

from tabscope.llm import suffix_dedup


def brute(rows, length):
    """Rows [(doc_id, text)] with distinct ids."""
    seen, out = set(), {}
    for d, t in sorted(rows, key=lambda r: r[0]):
        raw = (t or "").encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - length + 1):
            w = raw[i:i + length]
            if w in seen:
                gone[i:i + length] = b"\1" * length
            seen.add(w)
        kept = bytes(x for x, g in zip(raw, gone, strict=True) if not g)
        runs = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out[d] = (len(raw), sum(gone), runs, hashlib.sha256(kept).hexdigest())
    return out


def check(spark, rows, length=100):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept)
           for r in suffix_dedup.without_repeats(df, length, digest=True).collect()}
    want = brute(rows, length)
    assert got == want
    return sum(v[1] for v in want.values())


def test_documents(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert check(spark, rows) > 1000


def test_planted_passages(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "HOT", 20)  # some keys take the path of very common ones
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefgh é") for _ in range(rng.randrange(2, 9)))
    passages = [" ".join(word() for _ in range(n)) for n in (20, 25, 60, 200)]
    rows = []
    for i in range(150):
        parts = [" ".join(word() for _ in range(rng.randrange(0, 60)))]
        for _ in range(rng.randrange(0, 3)):
            p = rng.choice(passages)
            a = rng.randrange(0, len(p) // 2)
            parts += [p[a:a + rng.randrange(60, 400)], word()]
        rows.append((i * 7 % 151, " ".join(parts)))
    rows += [(1000, None), (1001, ""), (1002, "x" * 99), (1003, "x" * 5000), (1004, "x" * 300), (1005, "ab" * 400)]
    assert check(spark, rows) > 5000


def test_repeated_rows_null_ids_and_empty(spark):
    s = "doc_id long, text string"
    assert suffix_dedup.without_repeats(spark.createDataFrame([], s)).collect() == []
    a, b = "".join(chr(97 + i * i % 26) + str(i) for i in range(90)), "z" * 150
    df = spark.createDataFrame([(1, a), (1, a), (2, b), (None, a), (None, None)], s).selectExpr("*", "1 as doc", "2 as TEXT2")
    got = sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans) for r in suffix_dedup.without_repeats(df).collect()), key=str)
    n = len(a)
    assert got == sorted([(1, n, 0, 0), (1, n, 0, 0), (2, 150, 149, 1), (None, n, n, 1), (None, 0, 0, 0)], key=str)
