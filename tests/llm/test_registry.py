"""Queries with SQL against it; the others run, with the columns they promise."""

import duckdb
import pytest

import corpus_pipeline
from tablewinnow.llm import registry

FOLDER = "/root/testdata/sf0.001"
COLUMNS = {
    "op2_pack": "doc_id start length ids_crc32 doc_tokens sequence_id offset",
    "op3_simhash": "doc_id n_chars edited_sha256 fingerprint edited_fingerprint near_edited near_next",
    "op4_quality": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
    "op5_toxicity": "doc_id severity grade toxic",
    "op6_near_dedup": "doc_id fingerprint component_id",
    "op7_language": "doc_id held_out lang_pred score",
    "op8_pii": "doc_id n_email n_ip n_card n_phone base_sha256 spans",
    "op10_secrets": "doc_id n_assign n_access n_hex base_sha256 spans",
    "op11_align_tokens": "doc_id n_a n_b n_groups n_links n_best count_sum groups_sha256",
    "op12_periodic_runs": "doc_id n_runs start length period exponent_milli runs_sha256 collapsed_sha256",
}


@pytest.mark.parametrize("name", registry.oracle_sql())
def test_query_equals_sql(spark, name):
    connection = duckdb.connect()
    for table in ("documents", "pages"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    result = registry.queries()[name](spark, FOLDER)
    columns = sorted(result.columns)
    found = sorted(map(repr, (tuple(r) for r in result.select(*columns).collect())))
    rows = connection.execute(f"SELECT {', '.join(columns)} FROM ({registry.oracle_sql()[name]})")
    assert found == sorted(map(repr, rows.fetchall()))


@pytest.mark.parametrize("name", COLUMNS)
def test_columns(spark, name):
    result = registry.queries()[name](spark, FOLDER)
    assert result.columns[: len(COLUMNS[name].split())] == COLUMNS[name].split()
    assert result.count() > 0


def test_pipeline_equals_its_stages_in_turn(spark):
    """Every stage by itself on what the one before kept, checked against a plain rule."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    counts = [docs.count()]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, FOLDER).collect(), docs.schema)
        counts.append(docs.count())
    assert counts[1] >= 0.95 * counts[0] and counts[2] <= counts[1] and counts[3] == counts[2]
    last = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER)
    whole = corpus_pipeline.run(spark, FOLDER)
    key = ["doc_id", "start", "doc_tokens"]
    assert whole.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()
    assert last.agg({"length": "sum"}).first() == whole.agg({"length": "sum"}).first()
    assert set(key) <= set(whole.columns)
