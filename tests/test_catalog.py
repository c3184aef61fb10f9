"""Registered queries next to their SQL twins, at the smallest scale."""

from __future__ import annotations

from pathlib import Path

import pytest

import __spark_entry__ as entry
from oracle_check import check, connect
from staylens.catalog.registry import QUERIES, TWINS

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="benchmark tables are not here")

#: One or two of every kind; ``python tests/oracle_check.py`` runs all of them.
SAMPLE = (
    "cast_to_schema", "price_normalize", "array_parse", "html_break_clean", "display_format", "file_lineage",
    "join_wide_listing", "agg_neighbourhood_invest", "agg_quantile_exact", "agg_quantile_exact_skewed",
    "dedupe_latest", "profile_transform_nulls", "scd2_event_history", "scd2_event_history_skewed", "scd2_merge",
    "fact_review", "fact_review_skewed", "agg_ads", "ml_premium_features", "topk_neighbourhood_cards",
    "underperformer_filter", "invest_question", "promotion_question", "csv_batch_scan", "review_event_sink",
    "scd2_merge_versions", "silver_multi_table_sink_versions", "stream_payload_unwrap", "stream_contract_check", "stream_watermark", "stream_reviews_end_to_end",
)


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(TWINS)
    assert set(QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", SAMPLE)
def test_query_agrees_with_its_twin(spark, con, name):
    assert check(spark, con, FOLDER, name) is None


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert 0 < len(rows) <= 6 and rows[0].revenue.startswith("$")
