"""Medians of groups too large for an approximation to be exact."""

from __future__ import annotations

from types import SimpleNamespace

from pyspark.sql import functions as F

import __spark_entry__  # noqa: F401 - loads the queries
from staylens.catalog.registry import QUERIES
from staylens.plans import gold

ROWS = 100_000


def listings(spark):
    """Every number below ``ROWS`` once: an error of one rank shows."""
    days = (F.col("listing_id") * 7919 % ROWS).cast("int")
    return spark.range(ROWS).withColumnRenamed("id", "listing_id").repartition(7).select(
        "listing_id", F.lit("City").alias("city"), F.lit("Place").alias("neighbourhood"),
        F.lit(100.0).cast("float").alias("price_per_night"), F.lit(5).alias("estimated_revenue_l365d"),
        days.alias("availability_365"), F.lit(1).alias("number_of_reviews_ltm"),
        F.lit(50.0).cast("float").alias("host_response_rate"),
    )


def test_invest_median_is_exact_in_large_groups(spark):
    assert [r.median_availability for r in gold.neighbourhood_invest(listings(spark)).collect()] == [ROWS / 2 - 1]


def test_median_query_is_exact_in_large_groups(spark):
    found = QUERIES["agg_median_approx"](SimpleNamespace(neighbourhood_base=listings(spark)))
    assert dict(found.dtypes)["median_availability"] == "int"
    assert [tuple(r) for r in found.collect()] == [("Place", ROWS // 2 - 1)]


def test_median_of_few_rows_and_of_none(spark):
    rows = [("a", 3), ("a", None), ("a", 1), ("b", None), (None, 7)]
    base = spark.createDataFrame(rows, "neighbourhood STRING, availability_365 INT")
    found = QUERIES["agg_median_approx"](SimpleNamespace(neighbourhood_base=base))
    assert {tuple(r) for r in found.collect()} == {("a", 1), ("b", None), (None, 7)}
