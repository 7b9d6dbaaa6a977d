import corpus_pipeline
from brute import SF, near_dup_rows
from test_decontam import brute as leaks
from test_sharding import check as shards_hold

from tabscope.llm import mixing, quality


def test_each_stage_on_its_input(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality_classifier", "minhash_near_dedup", "benchmark_decontamination", "mixing_to_target_weights", "sharding"]
    texts = lambda df: [(r.doc_id, r.text) for r in df.collect()]
    labels, benchmark = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("labels", "benchmark"))

    a = stages["quality_classifier"](spark, docs, SF)
    assert a.columns == docs.columns
    a = spark.createDataFrame(a.collect(), docs.schema)
    want = {r.doc_id for r in quality.classify(docs, labels).collect() if r.predicted}
    assert {d for d, _ in texts(a)} == want and 0 < len(want) < docs.count()

    b = stages["minhash_near_dedup"](spark, a, SF)
    assert b.columns == docs.columns
    b = spark.createDataFrame(b.collect(), docs.schema)
    assert sorted(d for d, _ in texts(b)) == sorted(d for d, _, c in near_dup_rows(texts(a)) if c == d)

    c = stages["benchmark_decontamination"](spark, b, SF)
    assert c.columns == docs.columns
    c = spark.createDataFrame(c.collect(), docs.schema)
    bad = {d for d, _ in leaks(texts(b), [(r.item_id, r.text) for r in benchmark.collect()])}
    assert sorted(d for d, _ in texts(c)) == sorted(d for d, _ in texts(b) if d not in bad)

    e = stages["mixing_to_target_weights"](spark, c, SF)
    assert e.columns == docs.columns
    e = spark.createDataFrame(e.collect(), docs.schema)
    copies = {r.doc_id: r.copies for r in mixing.plan(c).collect() if r.copies}
    n = {}
    for d, _ in texts(e):
        n[d] = n.get(d, 0) + 1
    assert n == copies

    shards_hold(texts(e), stages["sharding"](spark, e, SF).collect(), 16)


def test_run_and_empty_documents(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    docs.limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    for t in ("labels", "benchmark"):
        spark.read.parquet(f"{SF}/{t}.parquet").write.parquet(str(tmp_path / f"{t}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


RESERVED = ["TEXT", "_row", "_kept_id", "_kept_text", "_bare", "_hash", "_bad", "kept_id", "bare", "bad", "text_hash", "class", "label", "v", "u", "g", "o",
            "size", "target", "copies", "before", "Source2", "_at", "c0", "c7", "id", "y", "slots", "score"]




def test_stages_carry_columns_of_any_name(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(40)
    docs = spark.createDataFrame(docs.collect(), docs.schema)
    for name, stage in corpus_pipeline.STAGES[:4]:
        want = sorted((r.doc_id, r.n_chars) for r in stage(spark, docs, SF).collect())
        wide = docs
        for i, extra in enumerate(RESERVED):  # all reserved names at once
            wide = wide.selectExpr("*", f"concat('{i}-', cast(doc_id as string)) as e{i}")
        wide = wide.toDF(*docs.columns, *RESERVED)
        got = stage(spark, wide, SF)
        assert got.columns == wide.columns, name
        rows = got.collect()
        assert sorted((r[0], r[docs.columns.index("n_chars")]) for r in rows) == want, name
        for r in rows:
            assert list(r)[len(docs.columns):] == [f"{i}-{r[0]}" for i in range(len(RESERVED))], name


def test_stages_with_rows_that_have_no_id(spark):
    base = spark.read.parquet(f"{SF}/documents.parquet").limit(30)
    texts = [r.text for r in base.collect()] * 2 + ["one and the same text of some ten words in all"] * 300 + [None] * 20
    rows = [(None, t, "en", "web", len(t or "")) for t in texts] + [(i, t, "en", None, 0) for i, t in enumerate(texts[:20])]
    docs = spark.createDataFrame(rows, base.schema)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        docs = spark.createDataFrame(docs.collect(), docs.schema)
    assert docs.count() > 0 and {"shard", "slot"} <= set(docs.columns)
