import random
import zlib

import numpy as np
import pytest

from tabscope.llm import ngrams, quality, toxicity

D, Q = "doc_id long, text string", "doc_id long, quality int, toxic int"


def auc(score, y):
    r = np.argsort(np.argsort(score)) + 1
    n1 = int(y.sum())
    return (r[y == 1].sum() - n1 * (n1 + 1) / 2) / (n1 * (len(y) - n1))


@pytest.mark.parametrize(("module", "label", "least"), [(quality, "quality", 0.97), (toxicity, "toxic", 0.85)])
def test_held_out_ranking_on_given_tables(spark, module, label, least):
    sf = "/root/testdata/sf0.01"
    d, q = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    got = module.classify(d, q).toPandas()
    assert len(got) == d.count() and got.score.between(0, 1).all()
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in got.doc_id]).all()
    m = got.merge(q.toPandas(), on="doc_id")
    m = m[m.held_out]
    assert auc(m.score.to_numpy(), m[label].to_numpy()) >= least
    again = module.classify(d.repartition(5), q).toPandas().set_index("doc_id").score
    assert np.allclose(again, got.set_index("doc_id").score.loc[again.index])


def test_held_out_labels_and_other_columns_change_nothing(spark):
    sf = "/root/testdata/sf0.001"
    d, q = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    flipped = q.selectExpr("doc_id", "if(crc32(cast(cast(doc_id as string) as binary)) % 5 = 0, 1 - quality, quality) as quality", "toxic")
    a = quality.classify(d, q).toPandas().set_index("doc_id").score.sort_index()
    b = quality.classify(d.selectExpr("doc_id", "text", "'zz' as lang", "'s' as source", "1 as y", "2 as id"), flipped).toPandas().set_index("doc_id").score.sort_index()
    assert np.allclose(a, b)


def sentences(n, seed):
    rng = random.Random(seed)
    calm, rude = ["walk", "tree", "river", "bread", "music", "paper"], ["idiot", "moron", "trash"]
    rows, labels = [], []
    for i in range(n):
        w = [rng.choice(calm) for _ in range(8)]
        toxic = rng.random() < 0.4
        if toxic:
            w[3] = rng.choice(rude) if rng.random() < 0.7 else "sly"
        if rng.random() < (0.8 if toxic else 0.1):  # the group is mentioned next to insults far more often
            w[5] = "muslims"
        elif rng.random() < 0.3:
            w[5] = "christians"
        rows.append((i, " ".join(w)))
        labels.append((i, 1, int(toxic)))
    return rows, labels


def test_counterfactual_penalty_spares_neutral_mentions(spark):
    rows, labels = sentences(600, 1)
    neutral = [(10_000 + i, f"walk tree {g} bread music") for i, g in enumerate(("muslims", "christians", "jews", "river"))]
    d, q = spark.createDataFrame(rows + neutral, D), spark.createDataFrame(labels, Q)
    with_, without = ({r.doc_id: r.score for r in toxicity.classify(d, q, penalty=p).collect()} for p in (10.0, 0.0))
    spread = lambda s: max(s[10_000 + i] for i in range(3)) - min(s[10_000 + i] for i in range(3))
    assert spread(with_) < 0.5 * spread(without)
    assert with_[10_000] < without[10_000]


def test_swaps():
    t = toxicity.swaps()
    assert toxicity.swapped("The Women, womenfolk and MUSLIMS", t) == "The men, womenfolk and jews"
    assert toxicity.swapped("", t) == ""


@pytest.mark.parametrize("module", [quality, toxicity])
def test_nulls_empty_one_class_and_tables_without_rows(spark, module):
    name = {quality: "quality", toxicity: "toxic"}[module]
    e, none = spark.createDataFrame([], D), spark.createDataFrame([], Q)
    assert module.classify(e, none).collect() == []
    rows = [(None, "a b"), (1, None), (2, ""), (2, ""), (3, "x" * 100_000), (4, "word " * 20_000), (5, "!!! ...")]
    d = spark.createDataFrame(rows, D)
    assert {r.score for r in module.classify(d, none).collect()} == {0.5}
    one = spark.createDataFrame([(i, 1, 1) for i in range(10)] + [(None, 1, 1), (3, None, None)], Q)
    got = module.classify(d, one).collect()
    assert len(got) == 7 and all(r.score > 0.5 for r in got)
    two = spark.createDataFrame([(1, 0, 0), (3, 0, 0), (4, 1, 1), (4, 1, 1)] + [(i, i % 2, i % 2) for i in range(5, 30)], Q)
    more = d.union(spark.createDataFrame([(i, "good text" if i % 2 else "BAD!! TEXT!!") for i in range(5, 30)], D))
    got = module.classify(more, two).collect()
    assert len(got) == 32 and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if r.doc_id in (1, 2)}) == 1, name


def test_dual_coordinate_descent_separates_and_matches_a_reference_solution():
    rng = np.random.default_rng(0)
    rows = [np.unique(np.concatenate([[i % 2], 2 + rng.integers(0, 20, 5)])) for i in range(200)]
    y = np.array([1.0 if i % 2 else -1.0 for i in range(200)])
    w, b = quality.dual_coordinate_descent(rows, y, np.ones(22), np.ones(200), epochs=200)
    x = np.zeros((200, 22))
    for i, r in enumerate(rows):
        x[i, r] = 1 / np.sqrt(len(r))
    margin = y * (x @ w + b)
    assert (margin > 0).all()
    best = (w @ w + b * b) / 2 + np.maximum(0, 1 - margin).sum()
    for _ in range(200):  # no nearby point is better
        dw, db = rng.normal(size=22) * 0.02, rng.normal() * 0.02
        assert ((w + dw) @ (w + dw) + (b + db) ** 2) / 2 + np.maximum(0, 1 - y * (x @ (w + dw) + b + db)).sum() >= best - 1e-3


def test_feature_kernels_agree_across_chunks():
    import pyarrow as pa
    texts = pa.array(["Ab cd!! Ab", None, "", "é ü x" * 50, "Ab cd!! Ab", " | a | b"])
    whole = [s.tolist() for s in ngrams.rows_of(texts, ngrams.shape_grams)]
    single = [next(iter(ngrams.rows_of(texts.slice(i, 1), ngrams.shape_grams))).tolist() for i in range(len(texts))]
    assert whole == single and whole[0] == whole[4] and whole[1] == whole[2] == []
