from brute import SF, WS_WORD
from pyspark.sql import functions as F

from tabscope.llm import mixing

S = "doc_id long, text string, lang string, source string, n_chars long"


def docs_of(spark, rows):
    return spark.createDataFrame([(d, t, "en", s, len(t or "")) for d, t, s in rows], S)


def targets(sizes, most=3):
    """The words of the task: share by weight, stop at the cap, share the excess anew until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    out, open_ = {}, set(names)
    left = sum(sizes.values())
    while True:
        total = sum(weight[s] for s in open_)
        above = [s for s in open_ if left * weight[s] / total > most * sizes[s] + 1e-9] if open_ else []
        if not above:
            out.update({s: left * weight[s] / total for s in open_})
            return out
        for s in above:
            out[s] = most * sizes[s]
            open_.remove(s)
            left -= out[s]


def check(rows, got, slack):
    sizes = {}
    for d, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len(WS_WORD.findall(t or ""))
    want, taken, longest = targets(sizes), {}, {}
    source = {d: s for d, _, s in rows}
    for r in got:
        s = source[r.doc_id]
        assert r.source_size == sizes[s]
        assert abs(r.target - want[s]) < 1e-6 * max(1, want[s])
        assert r.taken <= 3 * r.size
        assert r.size == 0 or r.taken % r.size == 0
        taken[s] = taken.get(s, 0) + r.taken
        longest[s] = max(longest.get(s, 0), r.size)
    for s in sizes:
        assert abs(taken[s] - want[s]) <= slack * longest[s] + 1e-6, s


def test_targets_and_taken(spark):
    rows = [(i, "w " * (i * 37 % 91), ["a", "b", "B", "é", None][i * i % 5] if i > 20 else "tiny") for i in range(300)]
    rows += [(1000 + i, "x y z", "hot") for i in range(500)]
    got = mixing.plan(docs_of(spark, rows)).collect()
    assert len(got) == len(rows)
    check(rows, got, 1)
    again = mixing.plan(docs_of(spark, rows[::-1]).repartition(7)).collect()
    assert sorted((r.doc_id, r.taken) for r in got) == sorted((r.doc_id, r.taken) for r in again)


def test_given_documents(spark):
    d = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text, r.source) for r in d.collect()]
    check(rows, mixing.plan(d).collect(), 1)


def test_mixed_repeats_documents_in_order_of_position(spark):
    rows = [(i, "w " * (1 + i % 7), "ab"[i % 4 == 0]) for i in range(120)]
    d = docs_of(spark, rows).withColumn("_row2", F.lit(1)).withColumnRenamed("_row2", "before")
    took = {r.doc_id: r.copies for r in mixing.plan(docs_of(spark, rows)).collect()}
    out = mixing.mixed(d)
    assert out.columns == d.columns
    n = {}
    for r in out.collect():
        n[r.doc_id] = n.get(r.doc_id, 0) + 1
    assert n == {k: v for k, v in took.items() if v}


def test_curriculum_positions(spark):
    """One source is wanted early, the other late: their copies lie in those phases."""
    rows = [(i, "w " * 10, "early" if i % 2 else "late") for i in range(200)]
    w = F.when(F.col("source") == "early", F.array(F.lit(1.0), F.lit(0.0))).otherwise(F.array(F.lit(0.0), F.lit(1.0)))
    got = mixing.plan(docs_of(spark, rows), w).collect()
    assert all(r.first_position <= 0.5 if r.doc_id % 2 else r.first_position >= 0.5 for r in got if r.copies)
    assert sum(r.taken for r in got) == 2000


def test_default_schedule_varies_and_keeps_its_integrals(spark):
    """Positions invert the cumulative demand: of an even, a rising and a falling source, each phase holds the part of
    the words that the schedule gives it, and the rows come in order of position."""
    rows = [(i, "w " * 5, "abc"[i % 3]) for i in range(3000)]
    got = mixing.plan(docs_of(spark, rows)).collect()
    schedule = {"a": (1, 1, 1, 1), "b": (1.25, 1.75, 2.25, 2.75), "c": (3.75, 3.25, 2.75, 2.25)}
    words, once = {}, {}
    for r in got:
        assert 0 <= (r.first_position or 0) <= 1 and (r.first_position is None) == (r.copies == 0)
        if r.copies:
            s = "abc"[r.doc_id % 3]
            lane = words.setdefault(s, [0] * 4)
            lane[min(int(r.first_position * 4), 3)] += r.size
            once[s] = max(once.get(s, 0), r.first_position)
    # a and b are taken at most once: the words of each phase are those of their schedules
    for s in "ab":
        total = sum(words[s])
        assert abs(once[s] - 1) < 0.01 or s == "b"
        for got_words, weight in zip(words[s], schedule[s], strict=True):
            assert abs(got_words / total - weight / sum(schedule[s])) < 0.01
    # c is wanted 1.5 times: the first copies fill the first two thirds of its demand, 8 of 12
    assert words["c"][3] == 0 and abs(words["c"][2] / sum(words["c"]) - 1 / 8) < 0.01
    at = [r.first_position for r in got if r.first_position is not None]
    assert at == sorted(at)


def test_mixed_is_sorted_by_position(spark):
    rows = [(i, "w " * 10, "early" if i % 2 else "late") for i in range(200)]
    w = F.when(F.col("source") == "early", F.array(F.lit(1.0), F.lit(0.0))).otherwise(F.array(F.lit(0.0), F.lit(1.0)))
    out = [r.source for r in mixing.mixed(docs_of(spark, rows), w).collect()]
    assert out == ["early"] * 100 + ["late"] * 100


def test_nulls_and_empty(spark):
    assert mixing.plan(spark.createDataFrame([], S)).collect() == []
    assert mixing.mixed(spark.createDataFrame([], S)).collect() == []
    got = mixing.plan(docs_of(spark, [(None, None, None), (None, "a b", None), (1, "", "s"), (1, "a", "s"), (1, "a", "s")])).collect()
    assert sorted((r.size, r.source_size) for r in got) == [(0, 2), (0, 2), (1, 2), (1, 2), (2, 2)]
