import pytest
from brute import SF

COLUMNS = {
    1: "doc_id n_chars edited_sha256 fingerprint edited_fingerprint near_edited near_next",
    2: "doc_id n_bytes n_removed n_spans kept_sha256",
    3: "doc_id n_words n_base first_word last_word base_labels labels score",
    4: "doc_id item_id similarity",
    5: "doc_id size source_size target taken",
    6: "page_id payload_bytes payload_digest record_type refers_to",
    7: "doc_id held_out score predicted",
    8: "doc_id held_out score predicted",
    9: "doc_id size text_crc32 law shard slot grown_shard",
    10: "doc_id n_shingles component_id kept",
    11: "item_id rank doc_id score",
    12: "doc_id n_runs start length period exponent_milli runs_sha256 collapsed_sha256",
    13: "doc_id n_shingles component_id",
}


def test_one_query_for_each_operator():
    from __spark_entry__ import queries
    found = sorted(int(k[2:].split("_")[0]) for k in queries() if k.startswith("op") and k[2].isdigit())
    assert found == list(range(1, 14)) and "pipeline" in queries()


@pytest.mark.parametrize("n", sorted(COLUMNS))
def test_query_returns_its_rows(spark, n):
    from __spark_entry__ import queries
    df = next(fn for k, fn in queries().items() if k.startswith(f"op{n}_"))(spark, SF)
    assert set(COLUMNS[n].split()) <= set(df.columns)
    rows = df.collect()
    table, key = ("pages", "page_id") if n == 6 else ("documents", "doc_id")
    ids = sorted(r[0] for r in spark.read.parquet(f"{SF}/{table}.parquet").select(key).collect())
    if n in (4, 11):
        assert rows and {r.doc_id for r in rows} <= set(ids)
    else:
        assert sorted(r[key] for r in rows) == ids
