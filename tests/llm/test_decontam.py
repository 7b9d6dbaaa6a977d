import random
from collections import Counter

from brute import SF, WS_WORD, lower

from tabscope.llm import decontam

D, B = "doc_id long, text string", "item_id long, text string"


def grams(w):
    return Counter(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()


def brute(docs, items, similarity=0.75):
    """Best similarity of any item-sized window, for each document and item that reaches the threshold."""
    out = {}
    for d, t in docs:
        w = WS_WORD.findall(lower(t))
        own = {tuple(w[i:i + k]) for k in range(1, 6) for i in range(len(w) - k + 1)}
        for i, x in items:
            v = WS_WORD.findall(lower(x))
            if not v or not w:
                continue
            g = grams(v)
            if not own & set(g):
                continue
            best = 0
            for s in range(max(1, len(w) - len(v) + 1)):
                h = grams(w[s:s + len(v)])
                both = sum((g & h).values())
                best = max(best, both / (sum(g.values()) + sum(h.values()) - both))
            if best >= similarity:
                out[d, i] = best
    return out


def check(spark, docs, items):
    got = {(r.doc_id, r.item_id): r.similarity for r in decontam.contaminated(
        spark.createDataFrame(docs, D), spark.createDataFrame(items, B)).collect()}
    want = brute(docs, items)
    assert set(got) == set(want)
    assert all(abs(got[k] - want[k]) < 1e-9 for k in got)
    return got


def test_given_tables(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    check(spark, docs, items)


def test_planted_and_edited_passages(spark):
    rng = random.Random(11)
    word = lambda: f"w{rng.randrange(3000)}"
    items = [(i, " ".join(word() for _ in range(n))) for i, n in enumerate((3, 5, 6, 12, 20, 40, 70, 30))] + [(90, None), (91, " ")]
    docs = []
    for d in range(120):
        pad = [word() for _ in range(rng.randrange(0, 200))]
        w = (items[rng.randrange(8)][1]).split()
        for _ in range(rng.randrange(0, 3)):
            k = rng.randrange(3)
            at = rng.randrange(len(w))
            if k == 0:
                w[at] = word()
            elif k == 1:
                w.insert(at, word())
            elif len(w) > 1:
                del w[at]
        cut = rng.randrange(len(pad) + 1)
        docs.append((d, "  ".join(pad[:cut] + [x.upper() for x in w] + pad[cut:])))
    docs += [(500, None), (501, ""), (502, items[0][1]), (503, "x")]
    assert len(check(spark, docs, items)) > 30


def _codes(spark, pairs):
    mask = (1 << 64) - 1
    signed = lambda x: (x & mask) - (1 << 64) if x >> 63 & 1 else x & mask
    return [(m, signed(x)) for m, x in pairs]


def test_index_guarantees_the_radius_and_prunes(spark):
    """Fingerprints at every distance up to the radius are found, once; unrelated ones hardly meet."""
    rng = random.Random(3)
    item = [(20, rng.getrandbits(64)) for _ in range(12)]
    code = []
    for m, x in item:
        for distance in range(30):
            y = x
            for b in rng.sample(range(64), distance):
                y ^= 1 << b
            code.append((m, y))
    want = {(c, i): (x ^ y).bit_count() for (_, y), (_, c) in zip(code, _codes(spark, code), strict=True)
            for (_, x), (_, i) in zip(item, _codes(spark, item), strict=True) if (x ^ y).bit_count() <= decontam.RADIUS}
    items = spark.createDataFrame(_codes(spark, item), "m int, item_code long")
    got = decontam.near_codes(spark.createDataFrame(_codes(spark, code), "m int, code long"), items).collect()
    assert len(got) == len(want) == len({(r.code, r.item_code) for r in got})
    assert {(r.code, r.item_code): r.distance for r in got} == want
    values = set(decontam._near_values(decontam.RADIUS))
    unrelated = [(rng.getrandbits(64), rng.getrandbits(64)) for _ in range(4000)]
    met = sum(((x ^ y) >> 16 * b & 0xFFFF) in values for x, y in unrelated for b in range(4))
    assert met < 0.18 * len(unrelated)


def test_recall_at_the_threshold(spark):
    """Items with words replaced up to a similarity of just 0.75 or a little more: nearly all are found."""
    rng = random.Random(29)
    items = [(i, " ".join(f"v{rng.randrange(10**6)}" for _ in range(30 + i % 40))) for i in range(150)]
    docs = []
    for i, x in items:
        w = x.split()
        for tries in range(2):
            v = list(w)
            at = rng.randrange(len(v))
            v[at] = "changed"
            if len(v) > 60 and tries:
                v[-1] = "too"
            docs.append((2 * i + tries, " ".join(["before", "it"] + v + ["after"])))
    got = {(r.doc_id, r.item_id) for r in decontam.contaminated(
        spark.createDataFrame(docs, D), spark.createDataFrame(items, B)).collect()}
    want = set()
    for d, t in docs:
        g, h = grams(items[d // 2][1].split()), grams(t.split()[2:-1])
        both = sum((g & h).values())
        if both / (sum(g.values()) + sum(h.values()) - both) >= 0.75:
            want.add((d, d // 2))
    assert got <= want and len(want) > 100
    assert len(got) >= 0.97 * len(want)


def test_nulls_repeats_and_empty(spark):
    e, b = spark.createDataFrame([], D), spark.createDataFrame([(1, "a b c d e f g h")], B)
    assert decontam.contaminated(e, b).collect() == []
    d = spark.createDataFrame([(None, "x a b c d e f g h y"), (None, "clean"), (2, "a b c d e f g h"), (2, "a b c d e f g h"), (3, "q")], D)
    assert decontam.contaminated(d, spark.createDataFrame([], B)).collect() == []
    x = d.selectExpr("*", "1 as m", "2 as start", "'k' as words")
    assert sorted((r.doc_id or -1) for r in decontam.contaminated(x, b).collect()) == [-1, 2]
    assert sorted((r.doc_id or -1, r.text) for r in decontam.keep_clean(x, b).collect()) == [(-1, "clean"), (3, "q")]
