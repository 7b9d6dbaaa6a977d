import hashlib
import itertools
import random
import re

from brute import SF

from tabscope.llm import fingerprints as fp

D = "doc_id long, text string"
STOP = set(fp.ANTECEDENTS)


def signature_set(text):
    w = re.findall(r"[^\W_]+", (text or "").lower())
    out = set()
    for i, x in enumerate(w):
        if x in STOP and i + 1 < len(w) and w[i + 1] not in STOP:
            chain = [y for y in w[i + 1:] if y not in STOP][:fp.CHAIN]
            if len(chain) == fp.CHAIN:
                out.add((x, *chain))
    return out or ({tuple(w)} if w else set())


def like(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def check(spark, rows, **params):
    got = {r.doc_id: r for r in fp.compared(spark.createDataFrame(rows, D).repartition(3), **params).collect()}
    order = sorted(rows)
    assert len(got) == len(rows)
    names = {}
    for i, (d, t) in enumerate(order):
        t, nxt = t or "", order[(i + 1) % len(order)][1] or ""
        half = len(t) // 2
        edited = t[:len(t) - half] + nxt[:half]
        r, a, b, c = got[d], signature_set(t), signature_set(edited), signature_set(nxt)
        assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert r.n_signatures == len(a)
        assert abs(r.near_edited - like(a, b)) < 1e-9 and abs(r.near_next - like(a, c)) < 1e-9
        for s, name in ((a, r.fingerprint), (b, r.edited_fingerprint)):
            assert names.setdefault(frozenset(s), name) == name
    assert len(set(names.values())) == len(names)


def test_given_documents_over_many_blocks(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    check(spark, rows, block_rows=17)


def test_small_texts_and_one_document(spark):
    check(spark, [(1, "The cat of the big dog")])
    check(spark, [(5, None), (2, ""), (9, "the"), (7, "a b c d e f"), (8, "für die Katze, und der Hund!"), (-3, "é" * 31), (100, "the of in to and")])
    assert fp.compared(spark.createDataFrame([], D)).collect() == []


def test_null_ids_repeats_and_clashing_names(spark):
    d = spark.createDataFrame([(None, "x the cat sat"), (None, None), (3, "b"), (3, "b"), (3, "c")], D).selectExpr("*", "1 as signatures", "2 as _tie2", "3 as next_text")
    got = fp.compared(d).collect()
    assert len(got) == 5 and sum(r.doc_id is None for r in got) == 2


def test_near_pairs_against_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    members, pairs = fp.near_duplicates(spark.createDataFrame(rows, D))
    name = {r.doc_id: r.fingerprint for r in members.collect()}
    got = {(r.a, r.b): r.likeness for r in pairs.collect()}
    sets = {name[d]: signature_set(t) for d, t in rows}
    names = sorted(sets)
    want = {(a, b): like(sets[a], sets[b]) for i, a in enumerate(names) for b in names[i + 1:]
            if sets[a] & sets[b] and like(sets[a], sets[b]) >= 0.75}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in got)


def near_pairs(spark, rows):
    """Near pairs as in the test above, and the most rows that a join or an aggregate of the plan made."""
    members, pairs = fp.near_duplicates(spark.createDataFrame(rows, D))
    got = {(r.a, r.b): r.likeness for r in pairs.collect()}
    name = {r.doc_id: r.fingerprint for r in members.collect()}
    sets = {name[d]: signature_set(t) for d, t in rows}
    names = sorted(sets)
    want = {(a, b): like(sets[a], sets[b]) for i, a in enumerate(names) for b in names[i + 1:]
            if sets[a] & sets[b] and like(sets[a], sets[b]) >= 0.75}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in got)
    made, todo = [], [pairs._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif kind.endswith("QueryStageExec"):
            todo.append(node.plan())
        else:
            if "Join" in kind or "Aggregate" in kind:
                made.append(node.metrics().apply("numOutputRows").value())
            todo.extend(node.children().apply(i) for i in range(node.children().size()))
    return len(want), max(made)


def test_members_of_long_lists_meet_without_all_their_pairs(spark):
    # sets of 4 out of 12 signatures, 495 documents: long lists, no near pair
    rows = [(i, " ".join(f"the p{j}a p{j}b" for j in c)) for i, c in enumerate(itertools.combinations(range(12), 4))]
    found, made = near_pairs(spark, rows)
    assert found == 0 and made < 10 * len(rows)


def test_edited_copies_in_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(fp, "LIST_BLOCK", 7)
    rng = random.Random(3)
    rows = []
    for i in range(150):
        chains = [f"the p{j}a p{j}b" for j in range(rng.randrange(20, 31))]
        for _ in range(rng.randrange(4)):
            chains[rng.randrange(len(chains))] = f"the q{rng.randrange(40)}a r"
        rows.append((i, " ".join(chains)))
    assert near_pairs(spark, rows)[0] > 1000
