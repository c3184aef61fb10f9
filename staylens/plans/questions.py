"""The two business questions: which city to invest in, which promotion works best."""

from __future__ import annotations

import warnings
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from staylens.functions import display, numbers
from staylens.operators.quantiles import exact_quantiles
from staylens.operators.skew import salted_left_join
from staylens.schemas import schema_of

# How many entries the reports show.
CARDS, REVENUE_CHART, CITY_CHART, MARKERS = 6, 10, 12, 200
PROVIDER_CARDS, PROVIDER_CHART, PROVIDER_TABLE = 3, 12, 20
# The columns of the advertising mart that the reports show.
SHOWN_ADS_COLUMNS = (
    "provider_id",
    "provider_name",
    "provider_conversion_rate",
    "most_clicked_provider",
    "post_amount",
    "avg_campaign_cost",
    "customer_gained",
)
# The columns of the investment mart that the reports show.
SHOWN_COLUMNS = (
    "city_name",
    "neighbourhood_name",
    "avg_revenue_l365d",
    "neighbourhood_most_bookings",
    "neighbourhood_most_views",
    "avg_order_price",
    "avg_response_rate",
    "median_availability",
    "neighbourhood_needed_boost",
)
# Fixed value: the share of a city's listings that counts as underperforming.
LOW_FRACTION = 0.25


def _zero(name: str) -> Column:
    return numbers.or_zero(F.col(name))


# --- which city -------------------------------------------------------------------


def _by_revenue(invest: DataFrame, k: int) -> DataFrame:
    return invest.orderBy(
        F.col("avg_revenue_l365d").desc_nulls_last(), "city_name", "neighbourhood_name"
    ).limit(k)


def neighbourhood_cards(invest: DataFrame, k: int = CARDS) -> DataFrame:
    """Top neighbourhoods by revenue, ready for display."""
    return _by_revenue(invest, k).select(
        display.title_case(F.col("city_name")).alias("city"),
        F.col("neighbourhood_name").alias("neighbourhood"),
        display.money(F.col("avg_revenue_l365d")).alias("revenue"),
        display.thousands(F.col("neighbourhood_most_bookings")).alias("bookings"),
        display.thousands(F.col("neighbourhood_most_views")).alias("views"),
        display.money(F.col("avg_order_price")).alias("avg_price"),
        display.percent(F.col("avg_response_rate"), 1).alias("response_rate"),
        display.thousands(F.floor(F.col("median_availability"))).alias("availability"),
        display.list_text(F.col("neighbourhood_needed_boost")).alias("boost"),
    )


def revenue_chart(invest: DataFrame, k: int = REVENUE_CHART) -> DataFrame:
    return _by_revenue(invest, k).select(
        display.place_label(F.col("city_name"), F.col("neighbourhood_name")).alias("label"),
        F.round(_zero("avg_revenue_l365d").cast("double"), 2).alias("revenue"),
        _zero("neighbourhood_most_bookings").alias("bookings"),
    )


def cities(invest: DataFrame) -> DataFrame:
    """Distinct city names, blanks left out, in order."""
    name = F.trim("city_name").alias("city")
    return invest.select(name).filter(F.col("city") != "").distinct().orderBy("city")


def in_city(df: DataFrame, city: str, column: str = "city_name") -> DataFrame:
    """Rows of one city, whatever the case on either side."""
    return df.filter(F.lower(F.trim(column)) == city.strip().lower())


def _asked_or_first(city: str | None) -> Column:
    name = F.trim("city_name")
    asked = F.max(F.when(F.lower(name) == (city or "").strip().lower(), F.lower(name)))
    return F.coalesce(F.nullif(asked, F.lit("")), F.lower(F.min(F.when(name != "", name))))


def in_city_or_first(invest: DataFrame, city: str | None = None) -> DataFrame:
    """Rows of the asked city; of the first one by name if none is asked for or it is unknown."""
    shown = invest.agg(_asked_or_first(city).alias("city")).scalar()
    return invest.filter(F.lower(F.trim("city_name")) == shown)


def shown_city(invest: DataFrame, city: str | None = None) -> str:
    """The name, in lower case, of the city that ``in_city_or_first`` shows; empty without any."""
    return invest.agg(_asked_or_first(city)).head()[0] or ""


def city_kpis(invest: DataFrame) -> DataFrame:
    """The figures of a city page, for all cities at once.

    Input is the mart (one row per neighbourhood), so groups stay small.
    """
    views, bookings = _zero("neighbourhood_most_views"), _zero("neighbourhood_most_bookings")
    return invest.groupBy("city_name").agg(
        F.sum(views).alias("active_listings"),
        F.sum(bookings).alias("bookings"),
        F.avg(_zero("avg_order_price")).alias("avg_price"),
        F.sum(_zero("avg_revenue_l365d") * views).alias("total_revenue"),
        F.avg(_zero("avg_response_rate")).alias("avg_response"),
        F.median(_zero("median_availability")).alias("median_availability"),
    )


def city_kpi_texts(kpis: DataFrame) -> DataFrame:
    """``city_kpis`` as a page shows them."""
    return kpis.select(
        display.title_case(F.col("city_name")).alias("city"),
        display.thousands(F.col("active_listings")).alias("active_listings"),
        display.thousands(F.col("bookings")).alias("bookings"),
        display.money(F.col("avg_price")).alias("avg_price"),
        display.money(F.col("total_revenue")).alias("total_revenue"),
        display.percent(F.col("avg_response"), 2).alias("avg_response"),
        display.thousands(F.col("median_availability")).alias("median_availability"),
    )


def city_bookings(invest: DataFrame, k: int = CITY_CHART) -> DataFrame:
    """Top neighbourhoods by bookings in every city."""
    best = Window.partitionBy("city_name").orderBy(
        F.col("neighbourhood_most_bookings").desc_nulls_last(), "neighbourhood_name"
    )
    return (
        invest.withColumn("place", F.row_number().over(best))
        .filter(F.col("place") <= k)
        .select(
            "city_name",
            "place",
            F.coalesce("neighbourhood_name", F.lit("unknown")).alias("neighbourhood"),
            _zero("neighbourhood_most_views").alias("views"),
            _zero("neighbourhood_most_bookings").alias("bookings"),
        )
    )


def located_listings(dim_location: DataFrame, fact_listing: DataFrame) -> DataFrame:
    """Locations ⋈ listings on the location key."""
    facts = fact_listing.select(
        "location_key", "id", "estimated_revenue_l365d", "estimated_occupancy_l365d", "price_per_night"
    )
    places = dim_location.select("location_key", "city", "neighbourhood", "latitude", "longitude")
    return places.join(facts, "location_key")


def underperformers(
    listings: DataFrame,
    fraction: float = LOW_FRACTION,
    limit: int | None = MARKERS,
    heavy: DataFrame | None = None,
) -> DataFrame:
    """Listings at or below their city's lower quantile of revenue or occupancy.

    The city key ignores case and outer blanks.  Rows without coordinates are left out;
    ``limit`` keeps the lowest earners of each city (``None``: all of them).  ``heavy``
    are the heavy cities (lower case, trimmed), by default counted in ``listings``.
    """
    named = listings.withColumn("city", F.lower(F.trim("city")))
    revenue, occupancy = _zero("estimated_revenue_l365d"), _zero("estimated_occupancy_l365d")
    measures = {"revenue_limit": (revenue, fraction), "occupancy_limit": (occupancy, fraction)}
    limits = exact_quantiles(named, ["city"], measures, heavy)
    low = (
        salted_left_join(named, limits, ["city"], spread=[F.col("id")], heavy=heavy)
        .filter((revenue <= F.col("revenue_limit")) | (occupancy <= F.col("occupancy_limit")))
        .dropna(subset=["latitude", "longitude"])
    )
    if limit is None:
        return low
    poorest = Window.partitionBy("city").orderBy(revenue, "id")
    return (
        low.withColumn("_place", F.row_number().over(poorest))
        .filter(F.col("_place") <= limit)
        .drop("_place")
    )


def markers(listings: DataFrame) -> DataFrame:
    """Map markers from underperforming listings."""
    return listings.select(
        "city",
        F.round("latitude", 6).alias("lat"),
        F.round("longitude", 6).alias("lng"),
        F.col("id").alias("listing_id"),
        F.coalesce("neighbourhood", F.lit("unknown")).alias("neighbourhood"),
        display.money(F.col("estimated_revenue_l365d")).alias("revenue"),
        display.thousands(F.col("estimated_occupancy_l365d")).alias("occupancy"),
        display.money(F.col("price_per_night")).alias("price"),
    )


def _with_columns(mart: DataFrame, table: str, shown: Sequence[str], what: str) -> DataFrame:
    """The mart, or a warning and an empty one where it lacks columns that are shown."""
    missing = [c for c in shown if c not in mart.columns]
    if not missing:
        return mart
    warnings.warn(f"the {what} mart lacks " + ", ".join(missing), stacklevel=3)
    return mart.sparkSession.createDataFrame([], schema_of(table))


def invest_answer(invest: DataFrame, located: DataFrame, city: str | None = None) -> dict[str, DataFrame]:
    """Which city and neighbourhood to invest in; ``located`` from ``located_listings``.

    With ``city``, the page of that city, or of the first one by name where it is unknown: its
    figures, bookings and markers.  ``located`` may then hold the listings of that city only.
    A mart that lacks columns the reports show is named in a warning, and its reports are empty.
    """
    invest = _with_columns(invest, "AggNeighbourhoodInvest", SHOWN_COLUMNS, "investment")
    if city is not None:
        shown = in_city_or_first(invest, city)
        name = shown_city(invest, city)
        own = located.withColumn("city", F.lower(F.trim("city"))).filter(F.col("city") == name)
        return {
            "cities": cities(invest),
            "city_kpis": city_kpis(shown),
            "city_kpi_texts": city_kpi_texts(city_kpis(shown)),
            "city_bookings": city_bookings(shown),
            "markers": markers(underperformers(own)),
        }
    return {
        "cards": neighbourhood_cards(invest),
        "revenue_chart": revenue_chart(invest),
        "cities": cities(invest),
        "city_kpis": city_kpis(invest),
        "city_kpi_texts": city_kpi_texts(city_kpis(invest)),
        "city_bookings": city_bookings(invest),
        "markers": markers(underperformers(located)),
    }


# --- which promotion --------------------------------------------------------------


def promotion_kpis(ads: DataFrame) -> DataFrame:
    return ads.agg(
        F.avg(_zero("provider_conversion_rate")).alias("avg_conversion"),
        F.sum(_zero("avg_campaign_cost")).alias("total_spend"),
        F.sum(_zero("customer_gained")).alias("total_customers"),
        F.count(F.lit(1)).alias("provider_count"),
    )


def promotion_kpi_texts(kpis: DataFrame) -> DataFrame:
    """``promotion_kpis`` as a page shows them."""
    return kpis.select(
        display.percent_of_fraction(F.col("avg_conversion")).alias("avg_conversion"),
        display.money(F.col("total_spend")).alias("total_spend"),
        display.thousands(F.col("total_customers")).alias("total_customers"),
        display.thousands(F.col("provider_count")).alias("provider_count"),
    )


def top_providers(ads: DataFrame, k: int = PROVIDER_TABLE) -> DataFrame:
    """Providers with the best conversion, ties by id."""
    return ads.orderBy(F.col("provider_conversion_rate").desc_nulls_last(), "provider_id").limit(k)


def provider_cards(ads: DataFrame, k: int = PROVIDER_CARDS) -> DataFrame:
    return provider_table(ads, k).drop("most_clicked")


def provider_chart(ads: DataFrame, k: int = PROVIDER_CHART) -> DataFrame:
    return top_providers(ads, k).select(
        F.coalesce("provider_name", F.lit("unknown")).alias("label"),
        F.round(_zero("provider_conversion_rate").cast("double") * 100, 2).alias("conversion"),
        F.round(_zero("avg_campaign_cost").cast("double"), 2).alias("cost"),
        _zero("customer_gained").alias("customers"),
        _zero("post_amount").alias("posts"),
    )


def provider_table(ads: DataFrame, k: int = PROVIDER_TABLE) -> DataFrame:
    return top_providers(ads, k).select(
        F.col("provider_name").alias("name"),
        display.percent_of_fraction(F.col("provider_conversion_rate")).alias("conversion"),
        display.fixed(F.col("most_clicked_provider"), 4).alias("most_clicked"),
        display.thousands(F.col("customer_gained")).alias("customers"),
        display.money(F.col("avg_campaign_cost")).alias("cost"),
        display.thousands(F.col("post_amount")).alias("posts"),
    )


def promotion_answer(ads: DataFrame) -> dict[str, DataFrame]:
    """Which promotion strategy works best.

    A mart that lacks columns the reports show is named in a warning, and its reports are empty.
    """
    ads = _with_columns(ads, "AggAds", SHOWN_ADS_COLUMNS, "advertising")
    return {
        "kpis": promotion_kpis(ads),
        "kpi_texts": promotion_kpi_texts(promotion_kpis(ads)),
        "cards": provider_cards(ads),
        "chart": provider_chart(ads),
        "table": provider_table(ads),
    }
