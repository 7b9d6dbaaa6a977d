import base64
import gzip
import hashlib
import io

from brute import SF
from pyspark.sql import functions as F

from tabscope.llm import warc

P = "page_id long, url string, html string"


def brute(rows, least=0):
    out, first = {}, {}
    for i, _, h in sorted(rows):
        b = (h or "").encode()
        d = base64.b32encode(hashlib.sha1(b).digest()).decode()
        of = first.setdefault(d, i) if len(b) >= least else i
        out[i] = (len(b), d, "response" if of == i else "revisit", None if of == i else of)
    return out


def result(df):
    return {r.page_id: (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in df.collect()}


ROWS = [(i, f"http://x/{i}?a b\r\n", t) for i, t in enumerate(
    ["same", "other\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\n", "same", "é" * 5000, None, "", "same", "\n", "other", "é" * 5000])] + [(50, None, "same"), (51, "", "solo\x00\x01")]


def test_round_trip_and_revisits(spark, tmp_path):
    df = spark.createDataFrame(ROWS, P).repartition(3).selectExpr("*", "1 as payload", "2 as refers_to")
    path = str(tmp_path / "a")
    assert result(warc.digest_rows(df, path=path)) == brute(ROWS)
    back = {r.page_id: r for r in warc.read_archives(spark, path, with_payload=True).collect()}
    want = brute(ROWS)
    for i, _, h in ROWS:
        if want[i][2] == "response":
            assert back[i].payload == (h or "")
    assert result(warc.digest_rows(df, least_bytes=5)) == brute(ROWS, 5)


def test_given_pages_match_brute_force(spark):
    df = spark.read.parquet(f"{SF}/pages.parquet")
    assert result(warc.digest_rows(df)) == brute([tuple(r) for r in df.select("page_id", "url", "html").collect()])


def test_deduplicating_existing_archives(spark, tmp_path):
    df = spark.createDataFrame(ROWS, P)
    a, b, c = (str(tmp_path / x) for x in "abc")
    warc.write_archives(warc.captures(df).selectExpr("*", "cast(null as bigint) as refers_to"), a)
    warc.deduplicated(spark, a, b)
    warc.deduplicated(spark, b, c)
    want = brute(ROWS)
    for path in (b, c):
        got = {r.page_id: (r.payload_bytes, r.payload_digest, "revisit" if r.refers_to is not None else "response", r.refers_to)
               for r in warc.read_archives(spark, path).collect()}
        assert got == want
    raw = gzip.decompress(next(p for p in (tmp_path / "b").iterdir() if p.suffix == ".gz").read_bytes())
    assert raw.endswith(b"\r\n\r\n") and all(h["warc-type"] in ("response", "revisit") for h, _ in warc.parsed(io.BufferedReader(io.BytesIO(raw))))


def test_nulls_repeats_and_empty(spark):
    assert warc.digest_rows(spark.createDataFrame([], P)).collect() == []
    got = [tuple(r)[3:] + (r.page_id,) for r in warc.digest_rows(spark.createDataFrame(
        [(None, None, "a"), (2, "u", "a"), (2, "u", "a"), (3, "u", "a"), (None, "u", "z")], P)).collect()]
    assert sorted(got, key=str) == sorted([("revisit", 2, None), ("response", None, 2), ("response", None, 2), ("revisit", 2, 3), ("response", None, None)], key=str)


def test_a_revisit_with_a_smaller_id_is_no_original(spark, tmp_path):
    """The record that holds the payload stays the response; a revisit without one in the archives keeps its reference."""
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    records = warc.captures(spark.createDataFrame(
        [(1, "u", "held"), (5, "u", "held"), (7, "u", "held"), (8, "u", "gone"), (9, "u", "x")], P))
    warc.write_archives(records.selectExpr("*", "case page_id when 1 then 5 when 8 then 3 end as refers_to"), a)
    warc.deduplicated(spark, a, b)
    got = {r.page_id: (r.refers_to, r.payload) for r in warc.read_archives(spark, b, with_payload=True).collect()}
    assert got == {1: (5, ""), 5: (None, "held"), 7: (5, ""), 8: (3, ""), 9: (None, "x")}


def test_no_payload_moves_by_digest(spark):
    pages = spark.createDataFrame(ROWS, P)
    headers = warc.captures(pages).withColumn("refers_to", F.lit(None).cast("long")).drop("payload")
    first = warc.originals(headers, 5)
    bare = warc.revisits(headers, first)
    assert "payload" not in bare.columns and "payload" not in first.columns
    assert {r.page_id: r.refers_to for r in bare.collect()} == {i: w[3] for i, w in brute(ROWS, 5).items() if w[3] is not None}
    whole = warc.responses(warc.captures(pages).withColumn("refers_to", F.lit(None).cast("long")), first, 5)
    assert sorted(r.page_id for r in whole.collect()) == sorted(i for i, w in brute(ROWS, 5).items() if w[3] is None)
