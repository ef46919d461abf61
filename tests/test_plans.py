"""The physical plans the queries are meant to have."""

import pytest

from layerworks.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"

# Queries that write while they are being set up; the others only build a plan.
NATIVE = [
    "filter_project", "derive_columns", "dept_summary", "join_dimension", "rule_strip_cast",
    "rule_date", "rule_mapping", "rule_mapping_long", "cdm_union", "cdm_counts", "expect_metrics",
    "expect_or_drop", "document_id", "source_type", "decode_bytes", "clean_text", "redact_pii",
    "doc_dedup", "chunk_paragraph", "chunk_ids", "chunk_heading", "doc_silver", "doc_quarantine",
    "doc_gold", "access_filter", "newest_event", "upsert_latest",
]


@pytest.mark.parametrize("name", NATIVE)
def test_no_python_in_the_plan(spark, plan, name):
    text = plan(QUERIES[name](spark, FOLDER))
    for node in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "CartesianProduct", "Window"):
        assert node not in text


def test_parsers_cost_one_arrow_step(spark, plan):
    text = plan(QUERIES["doc_parsers"](spark, FOLDER))
    assert text.count("ArrowEvalPython") == 1 and "BatchEvalPython" not in text


def test_filters_and_columns_reach_the_scan(spark, plan):
    text = plan(QUERIES["filter_project"](spark, FOLDER))
    assert "GreaterThanOrEqual(o_totalprice,200000.0)" in text
    assert "struct<o_orderkey:bigint,o_custkey:bigint,o_totalprice:double>" in text


def test_row_local_queries_do_not_shuffle(spark, plan):
    for name in ("cdm_union", "chunk_paragraph", "chunk_heading", "redact_pii", "expect_or_drop", "rule_mapping_long"):
        assert "Exchange hashpartitioning" not in plan(QUERIES[name](spark, FOLDER)), name


def test_known_small_sides_are_broadcast(spark, plan):
    for name in ("join_dimension", "join_literal_rows"):
        assert "BroadcastHashJoin" in plan(QUERIES[name](spark, FOLDER)), name


def test_value_dictionaries_need_no_join(spark, plan):
    for name in ("rule_mapping", "rule_mapping_long"):
        assert "Join" not in plan(QUERIES[name](spark, FOLDER)), name


@pytest.mark.parametrize("name", ["doc_dedup", "doc_silver", "doc_gold", "newest_event"])
def test_copies_are_merged_before_the_only_shuffle(spark, plan, name):
    text = plan(QUERIES[name](spark, FOLDER))
    assert text.count("Exchange hashpartitioning") == 1
    assert "partial_m" in text


def test_a_text_is_cleaned_once(spark, plan):
    """The test for a missing text must not repeat the masking below the projection."""
    assert plan(QUERIES["doc_silver"](spark, FOLDER)).count("[REDACTED_EMAIL]") == 1
