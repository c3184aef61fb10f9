"""Advertising-provider feed to silver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylens.functions import text, times
from staylens.functions.times import AsOf
from staylens.operators.schema_ops import cast_to_schema
from staylens.schemas import schema_of

# Measures that are 0 when missing.
ZERO_COLUMNS = (
    "avg_conversion_rate",
    "post_amount",
    "total_impressions",
    "total_clicks",
    "ctr",
    "return_on_investment",
    "avg_cpc",
    "avg_cpm",
    "campaigns_count",
)


def clean_ads(bronze: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Provider rows with an id; names, categories, measures and dates filled in."""
    now = times.clock(as_of)
    rules = {
        "name": text.category_or(F.col("name"), text.NO_NAME),
        "region_coverage": text.category_or(F.col("region_coverage"), text.UNKNOWN_CATEGORY, ()),
        "data_compliance_level": text.category_or(
            F.col("data_compliance_level"), text.UNKNOWN_CATEGORY, ()
        ),
        "churn_rate": F.col("churn_rate_provider"),
        "campaigns_count": F.col("concurrent_campaigns_count"),
        "partition_date": times.first_timestamp(
            F.col("partition_date"), F.col("last_updated"), as_of=as_of
        ),
        "ingestion_ts": F.coalesce("ingestion_ts", now),
    }
    return (
        bronze.filter(F.col("id").isNotNull())
        .withColumns(rules)
        .fillna(0, subset=list(ZERO_COLUMNS))
    )


def split_ads(cleaned: DataFrame) -> dict[str, DataFrame]:
    return {
        table: cast_to_schema(cleaned, schema_of(table))
        for table in ("providerDetails", "providerMetrics")
    }
