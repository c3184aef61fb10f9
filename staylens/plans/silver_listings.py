"""Listing feed to silver: one cleaned frame, split into six tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staylens.functions import arrays, flags, numbers, text, times
from staylens.operators.dedupe import dedupe_latest
from staylens.operators.schema_ops import LISTING_RENAMES, project_to, source_names
from staylens.schemas import LISTING_TABLES, schema_of

# Which columns the rules apply to.
FLAG_COLUMNS = (
    "host_is_superhost",
    "host_has_profile_pic",
    "host_identity_verified",
    "has_availability",
    "instant_bookable",
)
TIME_COLUMNS = (
    "last_scraped",
    "host_since",
    "calendar_last_scraped",
    "first_review",
    "last_review",
    "ingestion_ts",
)
ZERO_COLUMNS = (
    "estimated_revenue_l365d",
    "estimated_occupancy_l365d",
    "availability_30",
    "availability_60",
    "availability_90",
    "availability_365",
    "availability_eoy",
    "number_of_reviews_ltm",
    "number_of_reviews_l30d",
    "number_of_reviews_ly",
    "host_total_listings_count",
)
#: Columns the quality profile reports on.
PROFILED_COLUMNS = (
    "id",
    "description",
    "neighborhood_overview",
    "price",
    "host_response_rate",
    "host_acceptance_rate",
    "host_is_superhost",
    "host_has_profile_pic",
    "host_identity_verified",
    "has_availability",
    "instant_bookable",
    "last_scraped",
    "host_since",
    "calendar_last_scraped",
    "first_review",
    "last_review",
)


def clean_listings(bronze: DataFrame) -> DataFrame:
    """All column rules of the listing feed in one projection.

    A missing price becomes 0.0 here, so averages further on include it.
    """
    description = text.html_breaks_to_blanks(F.col("description"))
    overview = text.html_breaks_to_blanks(F.col("neighborhood_overview"))
    rules: dict[str, Column] = {
        "description": description,
        "neighborhood_overview": text.first_filled(overview, description),
        "price": F.coalesce(numbers.price_amount(F.col("price")), F.lit(0.0)),
        "host_response_rate": numbers.percent_double(F.col("host_response_rate")),
        "host_acceptance_rate": numbers.percent_int(F.col("host_acceptance_rate")),
        "host_response_time": text.category_or(
            F.col("host_response_time"), text.UNKNOWN, text.MISSING_TOKENS
        ),
        "review_scores_rating": numbers.within(numbers.safe_double(F.col("review_scores_rating"))),
    }
    rules |= {c: flags.tf_flag(F.col(c)) for c in FLAG_COLUMNS}
    rules |= {c: times.timestamp_or_null(F.col(c)) for c in TIME_COLUMNS}
    rules |= {c: numbers.or_zero(F.col(c)) for c in ZERO_COLUMNS}
    return bronze.withColumns(rules)


def _table_rules(table: str) -> dict[str, Column]:
    if table == "HostDetails":
        return {
            "host_name": text.category_or(F.col("host_name"), text.NO_NAME),
            "room_type": text.category_or(F.col("room_type"), text.UNKNOWN_CATEGORY),
            "property_type": text.category_or(F.col("property_type"), text.UNKNOWN_CATEGORY),
        }
    if table == "HostMetrics":
        return {
            "host_response_time": text.category_or(
                F.col("host_response_time"), text.UNKNOWN, text.MISSING_TOKENS
            )
        }
    if table == "RentDetails":
        return {
            "bedrooms": numbers.or_zero(F.col("bedrooms")),
            "beds": numbers.or_zero(F.col("beds")),
            "amenities": arrays.list_or_empty(F.col("amenities")),
        }
    if table == "RentMetrics":
        zeros = ("estimated_revenue_l365d", "estimated_occupancy_l365d", "number_of_reviews_ltm")
        return {
            "price_per_night": F.coalesce("price_per_night", F.lit(0.0).cast("float")),
            **{c: numbers.or_zero(F.col(c)) for c in zeros},
        }
    if table == "Location":
        return {
            c: text.category_or(F.col(c), text.UNKNOWN_CATEGORY)
            for c in ("host_neighbourhood", "neighbourhood")
        }
    return {}


def one_row_per_listing(cleaned: DataFrame) -> DataFrame:
    """Listings with an id, the latest row of each: the only shuffle of the listing job.

    Only the columns of the silver tables go through it.
    """
    needed = {"id", "ingestion_ts"}
    for table in LISTING_TABLES:
        needed.update(source_names(schema_of(table), LISTING_RENAMES).values())
    kept = cleaned.select(*[c for c in cleaned.columns if c in needed])
    return dedupe_latest(kept.filter(F.col("id").isNotNull()), ["id"])


def silver_table(listings: DataFrame, table: str) -> DataFrame:
    """One silver table from cleaned, de-duplicated listings; no shuffle."""
    projected = project_to(listings, schema_of(table), LISTING_RENAMES)
    rules = _table_rules(table)
    return projected.withColumns(rules) if rules else projected


def split_listings(cleaned: DataFrame) -> dict[str, DataFrame]:
    """The six silver tables by name, from one cleaned frame."""
    listings = one_row_per_listing(cleaned)
    return {table: silver_table(listings, table) for table in LISTING_TABLES}
