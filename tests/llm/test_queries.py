"""Registered queries: those with SQL equal it at sf0.01, and the rest hold their contracts."""

import zlib

import pytest
from conftest import SF001, SF01
from parity import compare, duck
from sessionmart.llm.registry import ORACLE, QUERIES

COLUMNS = {
    "op1_": {"doc_id", "n_shingles", "component_id"}, "op2_": {"page_id", "host", "path", "rule", "verdict"},
    "op3_": {"conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"}, "op4_": {"doc_id", "text"},
    "op5_": {"doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"},
    "op6_": {"doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"},
    "op7_": {"doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"}, "op8_": {"doc_id", "item_id", "score"},
    "op9_": {"page_id", "url", "text", "n_chars"}, "op10_": {"doc_id", "held_out", "score", "predicted"},
    "op11_": {"anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"},
    "op12_": {"doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"},
    "op13_": {"doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"},
}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    r = compare(QUERIES[name](spark, SF01), duck(SF01), ORACLE[name])
    assert r["cols_match"] and r["values_match"] and r["rows_spark"] == r["rows_oracle"], r


@pytest.mark.parametrize("start", sorted(COLUMNS))
def test_each_operator_has_one_query_with_its_columns(spark, start):
    (name,) = [q for q in QUERIES if q.startswith(start)]
    if name in ORACLE:
        return
    df = QUERIES[name](spark, SF001)
    assert COLUMNS[start] <= set(df.columns)
    rows = df.collect()
    docs = {r.doc_id for r in spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id").collect()}
    if start in ("op4_", "op7_", "op10_", "op13_"):
        assert sorted(r.doc_id for r in rows) == sorted(docs)
    if start == "op6_":
        assert {r.doc_id for r in rows} == docs
        at = {}
        for r in sorted(rows, key=lambda r: (r.doc_id, r.start)):
            assert r.start == at.get(r.doc_id, 0)
            at[r.doc_id] = r.start + r.length
        assert at == {r.doc_id: r.doc_tokens for r in rows}
    if start == "op8_":
        assert rows and {r.doc_id for r in rows} <= docs
    if start == "op10_":
        assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in rows)
