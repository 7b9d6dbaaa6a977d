import re

from brute import SF

from tabscope.llm import license_scan

D = "doc_id long, text string"


def brute(text):
    w = license_scan.words_of(text or "")
    at, labels = [], set()
    for p, label in license_scan.PHRASES.items():
        v = p.split()
        for i in range(len(w) - len(v) + 1):
            if w[i:i + len(v)] == v:
                at.append(i)
                labels.add(label)
    return len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels))


def check(spark, rows):
    got = license_scan.scan(spark.createDataFrame(rows, D)).collect()
    key = lambda x: (x[0] is None, x[0] or 0, x[1:6] and str(x[1:6]))
    assert sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got), key=key) == sorted(
        ((d, *brute(t)) for d, t in rows), key=key)
    for r in got:
        assert 0 <= r.score <= 1 and set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(",")))
    return {r.doc_id: r for r in got}


def test_given_documents(spark):
    check(spark, [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()])


def test_phrases_and_notices(spark):
    mit = next(n for n, x in license_scan.NOTICES.items() if x == "mit")
    bsd = next(n for n, x in license_scan.NOTICES.items() if x == "bsd")
    changed = re.sub("obtaining a copy", "that obtains one fine copy", mit)
    rows = [(1, "Released under the MIT  License. mit-license MIT\nLICENSE"), (2, "GNU General Public Licenses"),
            (3, "gnu general Public/License; cc_by CC-BY-NC 4.0 apache2 license Apache.License"), (4, None), (5, ""), (6, "K lİcense İ mit licenſe"),
            (7, "intro " + changed + " and so on"), (8, "x " * 3000 + bsd + " mit license " * 40), (9, " ".join(bsd.split()[:4])), (10, "mit"),
            (4, None), (1, "Released under the MIT  License. mit-license MIT\nLICENSE"), (None, "mit license"), (11, "mit mit license license"), (12, "mit Kelvin")]
    got = check(spark, rows)
    assert got[7].labels == "mit" and got[7].base_labels == "" and 0.6 <= got[7].score < 1
    assert got[8].labels == "bsd,mit" and got[9].labels == ""


def test_empty_and_clashing_names(spark):
    assert license_scan.scan(spark.createDataFrame([], D)).collect() == []
    d = spark.createDataFrame([(1, "mit license")], D).selectExpr("*", "1 as template", "2 as pos", "'w' as words")
    assert license_scan.scan(d).collect()[0].n_base == 1
