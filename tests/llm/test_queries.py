"""Queries against their SQL on the smallest tables."""

from __future__ import annotations

import pytest
from oracle import differences

from tessera.llm import queries


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_agrees_with_sql(spark, sf_dir, name):
    assert differences(queries.queries()[name](spark, sf_dir), queries.oracle_sql()[name], sf_dir) == ""


@pytest.mark.parametrize(("name", "columns"), [
    ("op3_token_counts", "doc_id n_bytes n_tokens over_limit"), ("op4_quality", "doc_id held_out score predicted"), ("op6_packing", "doc_id start length ids_crc32 doc_tokens sequence_id offset"),
    ("op7_simhash_near_dedup", "doc_id fingerprint component_id"), ("op8_url_filter", "page_id host path rule verdict"), ("op9_personal_data", "doc_id n_email n_ip n_card n_phone base_sha256 spans"),
    ("op11_merkle_manifest", "doc_id leaf subroot root proof_sha256 folded_root verified"),
    ("op13_jaccard_join", "doc_id n_shingles component_id"),
    ("op12_periodic_runs", "doc_id n_runs start length period exponent_milli runs_sha256 collapsed_sha256"),
])
def test_columns_of_the_contract(spark, sf_dir, name, columns):
    assert queries.queries()[name](spark, sf_dir).columns == columns.split()
