"""Queries that SQL expresses against it, and their names and columns."""

import duckdb
import pytest

import check
from sluice.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = queries.all_queries()[name](spark, SF)
    cur = con.execute(queries.oracle_sql()[name])
    at = {d[0]: i for i, d in enumerate(cur.description)}
    cols = sorted(at)
    want = sorted(tuple(check.norm(r[at[c]]) for c in cols) for r in cur.fetchall())
    assert sorted(df.columns) == cols
    assert sorted(tuple(check.norm(r[c]) for c in cols) for r in df.collect()) == want and want


CONTRACT = {
    "op1_quality_rules": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
    "op2_license_scan": "doc_id n_words n_base first_word last_word base_labels labels score",
    "op3_topk": "query_id rank vec_id score",
    "op4_secret_scan": "doc_id n_assign n_access n_hex base_sha256 spans",
    "op5_quality_classifier": "doc_id held_out score predicted",
    "op6_mixing": "doc_id size source_size target taken",
    "op7_bagminhash": "doc_id class_id",
    "op8_sentencepiece": "doc_id n_tokens ids",
    "op9_warc": "page_id payload_bytes payload_digest record_type refers_to",
    "op10_token_records": "doc_id start n_tokens ids_crc32",
    "op11_whitening": "vec_id component n deviation whitened explained identity_error",
    "op12_vector_dedup": "vec_id n_links component_id kept",
    "op13_hard_negatives": "anchor_id positive_id rank negative_id positive_score negative_score",
}


@pytest.mark.parametrize("name", CONTRACT)
def test_columns(spark, name):
    df = queries.all_queries()[name](spark, SF)
    assert df.columns[: len(CONTRACT[name].split())] == CONTRACT[name].split()
    types = dict(df.dtypes)
    assert not {c for c, t in types.items() if t == "void"}
