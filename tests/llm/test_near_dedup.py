import random

from brute import SF, near_dup_rows

from tabscope.llm.near_dedup import keep_one, near_duplicates


def compare(spark, rows, **params):
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept)
           for r in near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), **params).collect()}
    want = {d: (n, c, c == d) for d, n, c in near_dup_rows(rows)}
    assert got == want


def test_against_brute_force_on_documents(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    compare(spark, rows)


def test_edited_copies_chains_and_edges(spark):
    rng = random.Random(5)
    base = [[f"w{rng.randrange(400)}" for _ in range(n)] for n in (12, 60, 90, 300, 1500)]
    rows, i = [], 0
    for words in base:
        for _ in range(40):
            w = list(words)
            for _ in range(rng.randrange(0, max(2, len(w) // 25))):
                w[rng.randrange(len(w))] = f"x{rng.randrange(10**6)}"
            rows.append((i, " ".join(w)))
            i += 1
    common = " ".join(f"c{j}" for j in range(30))
    for j in range(60):  # a passage that many documents share, no links
        rows.append((i, common + " " + " ".join(f"u{j}_{m}" for m in range(25))))
        i += 1
    for t in (None, "", " \t\n", "one", "ONE", "one two", "a b c d e", "A B C D E", "É é", "x " * 5000, "x " * 50):
        rows.append((i, t))
        i += 1
    rng.shuffle(rows)
    compare(spark, rows)


def test_null_ids_repeats_and_empty(spark):
    s = "doc_id long, text string"
    assert near_duplicates(spark.createDataFrame([], s)).collect() == []
    t = "a b c d e f g h"
    df = spark.createDataFrame([(None, t), (3, t), (3, t), (1, None), (None, None)], s).selectExpr("*", "1 as class", "2 as v")
    got = sorted(map(tuple, near_duplicates(df).collect()), key=str)
    assert got == sorted([(None, 4, 3, True), (3, 4, 3, True), (3, 4, 3, True), (1, 0, 1, True), (None, 0, None, True)], key=str)


def test_pairs_about_the_size_of_a_sketch(spark):
    rows = []

    def pair(one, two):
        for words in (one, two):
            rows.append((len(rows), " ".join(words)))
    for n in range(97, 131):
        for kind, edits in (("a", (n // 2,)), ("b", (n // 5, n // 2, 4 * n // 5))):
            words = [f"{kind}{n}_{j}" for j in range(n + 4)]
            pair(words, [f"x{n}_{j}" if j in edits else w for j, w in enumerate(words)])
        for kind, held in (("c", -(-3 * n // 4)), ("d", -(-3 * n // 4) - 1)):  # a beginning at the threshold, one under it
            words = [f"{kind}{n}_{j}" for j in range(n + 4)]
            pair(words, words[:held + 4])
    compare(spark, rows)


def test_one_of_each_group_stays_also_without_ids(spark):
    def text(name, edits=()):
        return " ".join(f"x{j}" if j in edits else f"{name}{j}" for j in range(60))
    rows = [(None, text("a")), (None, text("a")), (None, text("a", (1,))), (None, text("a").upper()),  # no id in the group
            (None, text("b")), (4, text("b", (1,))), (4, text("b", (2,))), (7, text("b")),
            (2, text("c")), (7, text("c", (3,))), (7, text("d")), (7, text("d")),
            (None, None), (None, None), (None, " "), (9, ""), (9, ""), (9, None)]
    got = keep_one(spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as class", "2 as label"))
    assert got.columns == ["doc_id", "text", "class", "label"]
    got = [(r.doc_id, r.text) for r in got.collect()]
    words = sorted(d if d is not None else -1 for d, t in got if t and t.strip())
    assert words == [-1, 2, 4, 7] and len(set(got)) == len(got) - 1  # groups a, c, b, d
    assert (7, text("d")) in got and (2, text("c")) in got
    bare = [(d, t) for d, t in got if not (t and t.strip())]
    assert sorted(bare, key=str) == sorted([(None, None), (None, None), (None, " "), (9, ""), (9, None)], key=str)
