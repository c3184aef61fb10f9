"""Star schema and marts.

Every mart is a projection or a small aggregation over listing rows that are joined
on ``listing_id``.  ``listing_bases`` cuts the silver tables down to the columns the
marts use; a mart on its own joins just the bases it needs, and ``listing_wide`` joins
all of them once for a job that writes every mart.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staylens.functions import arrays, numbers
from staylens.functions.times import AsOf, clock
from staylens.operators.dedupe import dedupe_latest
from staylens.operators.quantiles import exact_quantiles, lower_median
from staylens.operators.schema_ops import cast_to_schema
from staylens.operators.sketches import Sketches
from staylens.operators.skew import salted_left_join
from staylens.schemas import schema_of

# The silver columns the marts are made of.
BASE_COLUMNS = {
    "HostDetails": ("host_name", "host_total_listings_count", "property_type", "room_type"),
    "HostMetrics": ("host_response_time", "host_response_rate", "host_acceptance_rate"),
    "RentDetails": ("accommodates", "bedrooms", "beds", "amenities"),
    "RentMetrics": (
        "price_per_night",
        "estimated_occupancy_l365d",
        "estimated_revenue_l365d",
        "availability_30",
        "availability_365",
    ),
    "Location": ("neighbourhood", "latitude", "longitude", "host_neighbourhood", "country", "city"),
}
PROVIDER_MEASURES = (
    "avg_conversion_rate",
    "post_amount",
    "total_impressions",
    "total_clicks",
    "ctr",
    "total_ad_spend",
    "return_on_investment",
    "region_coverage",
    "churn_rate",
    "avg_cpc",
    "avg_cpm",
    "campaigns_count",
    "data_compliance_level",
    "partition_date",
)
# Fixed value: a listing is premium above this share of its neighbourhood's prices.
PREMIUM_FRACTION = 0.8


# --- bases and joins --------------------------------------------------------------


def listing_base(silver: DataFrame, table: str, unique: bool = False) -> DataFrame:
    """One row per listing: ``listing_id``, the columns marts use, ``<table>_ts``.

    ``unique`` skips the de-duplication where the silver sink already guarantees it.
    """
    rows = silver if unique else dedupe_latest(silver, ["id"], ties=BASE_COLUMNS[table])
    return rows.select(
        F.col("id").alias("listing_id"), *BASE_COLUMNS[table], F.col("ingestion_ts").alias(f"{table}_ts")
    )


def listing_bases(silver: Mapping[str, DataFrame], unique: bool = False) -> dict[str, DataFrame]:
    return {t: listing_base(silver[t], t, unique) for t in BASE_COLUMNS if t in silver}


def join_listings(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Left joins on ``listing_id``: one key, so each side is shuffled once."""
    return reduce(lambda left, right: left.join(right, "listing_id", "left"), others, first)


def listing_wide(
    bases: Mapping[str, DataFrame], review_stats: DataFrame | None = None, copies: str | None = None
) -> DataFrame:
    """All bases side by side for every listing any of them knows, with ``in_<table>`` flags.

    Starting from the distinct ids keeps the key's partitioning through the whole chain
    of left joins, which a chain of full outer joins would lose at every step.  ``copies`` names
    a column for how often the base that has a listing most often has it, counted in that same step.
    """
    tagged = [b.select("listing_id", F.lit(i).alias("_base")) for i, b in enumerate(bases.values())]
    ids = reduce(DataFrame.unionByName, tagged)
    if copies:
        counts = [F.count_if(F.col("_base") == i) for i in range(len(tagged))]
        known = ids.groupBy("listing_id").agg((F.greatest(*counts) if len(counts) > 1 else counts[0]).alias(copies))
    else:
        known = ids.select("listing_id").distinct()
    flagged = [b.withColumn(f"in_{t}", F.lit(True)) for t, b in bases.items()]
    sides = flagged + ([review_stats] if review_stats is not None else [])
    return join_listings(known, *sides)


def review_stats(reviews: DataFrame, since: AsOf = None) -> DataFrame:
    """Reviews per listing and their average score, in one aggregation.

    ``since`` restricts the count to newer reviews; by default all of them count.
    """
    counted = F.count(F.lit(1)) if since is None else F.count_if(F.col("date") >= clock(since))
    return reviews.groupBy("listing_id").agg(
        counted.cast("int").alias("number_of_reviews_ltm"),
        F.avg("sentiment_score").alias("avg_sentiment_score"),
    )


def _stamp(as_of: AsOf, *tables: str) -> Column:
    return F.coalesce(*[F.col(f"{t}_ts") for t in tables], clock(as_of))


def _opened(df: DataFrame, as_of: AsOf) -> DataFrame:
    return df.withColumns(
        {
            "start_date": clock(as_of),
            "end_date": F.lit(None).cast("timestamp"),
            "is_current": F.lit(True),
        }
    )


# --- dimensions -------------------------------------------------------------------


def dim_host(joined: DataFrame, as_of: AsOf = None) -> DataFrame:
    """From HostDetails ⟕ HostMetrics."""
    rows = _opened(joined, as_of).withColumns(
        {
            "host_key": F.col("listing_id"),
            "name": F.col("host_name"),
            "response_time_category": F.col("host_response_time"),
            "ingestion_ts": _stamp(as_of, "HostMetrics", "HostDetails"),
        }
    )
    return cast_to_schema(rows, schema_of("dimHost"))


def dim_property(joined: DataFrame, as_of: AsOf = None) -> DataFrame:
    """From RentDetails ⟕ HostDetails."""
    rows = _opened(joined, as_of).withColumns(
        {
            "property_key": F.col("listing_id"),
            "ameneties": F.col("amenities"),
            "ingestion_ts": _stamp(as_of, "RentDetails", "HostDetails"),
        }
    )
    return cast_to_schema(rows, schema_of("dimProperty"))


def dim_location(location: DataFrame, as_of: AsOf = None) -> DataFrame:
    rows = location.withColumns(
        {"location_key": F.col("listing_id"), "ingestion_ts": _stamp(as_of, "Location")}
    )
    return cast_to_schema(rows, schema_of("dimLocation"))


def provider_base(details: DataFrame) -> DataFrame:
    return dedupe_latest(details, ["id"]).select(
        F.col("id").alias("provider_id"), "name", F.col("ingestion_ts").alias("details_ts")
    )


def provider_metrics_base(metrics: DataFrame) -> DataFrame:
    newest = [F.col("ingestion_ts").desc_nulls_last(), F.col("partition_date").desc_nulls_last()]
    return dedupe_latest(metrics, ["id"], newest).select(
        F.col("id").alias("provider_id"), *PROVIDER_MEASURES, F.col("ingestion_ts").alias("metrics_ts")
    )


def dim_provider(details: DataFrame, as_of: AsOf = None) -> DataFrame:
    rows = _opened(provider_base(details.filter(F.col("id").isNotNull())), as_of).withColumns(
        {
            "provider_key": F.col("provider_id"),
            "ingestion_ts": F.coalesce("details_ts", clock(as_of)),
        }
    )
    return cast_to_schema(rows, schema_of("dimProvider"))


def dim_reviewer(reviews: DataFrame) -> DataFrame:
    """One row per reviewer with the name on their latest review."""
    latest = dedupe_latest(
        reviews.select("reviewer_id", "reviewer_name", "date", "id", "ingestion_ts"),
        ["reviewer_id"],
        latest=[F.col("date").desc_nulls_last(), F.col("id").desc_nulls_last()],
    )
    rows = latest.select(
        F.col("reviewer_id").alias("reviewer_key"),
        F.col("reviewer_name").alias("name"),
        F.col("date").alias("last_review_date"),
        "ingestion_ts",
    )
    return cast_to_schema(rows, schema_of("dimReviewer"))


# --- facts ------------------------------------------------------------------------


def fact_listing(joined: DataFrame, as_of: AsOf = None) -> DataFrame:
    """From RentMetrics ⟕ HostMetrics ⟕ HostDetails."""
    rows = joined.withColumns(
        {
            **{k: F.col("listing_id") for k in ("id", "property_key", "location_key", "host_key")},
            "total_listing_count": F.col("host_total_listings_count"),
            "ingestion_ts": _stamp(as_of, "RentMetrics", "HostMetrics", "HostDetails"),
        }
    )
    return cast_to_schema(rows, schema_of("factListing"))


def fact_review(
    reviews: DataFrame, stats: DataFrame, as_of: AsOf = None, heavy: DataFrame | None = None
) -> DataFrame:
    """Reviews with their listing's review count.

    Reviews of one listing (or of the "no listing" key) may be a large share of all
    rows, so the join spreads hot listings by review id.
    """
    counts = stats.select("listing_id", "number_of_reviews_ltm")
    joined = salted_left_join(
        reviews.select(
            "id", "listing_id", "reviewer_id", "comment", "language", "likes_count",
            "sentiment_score", "ingestion_ts",
        ),
        counts,
        ["listing_id"],
        spread=[F.col("id")],
        heavy=heavy,
    )
    rows = joined.withColumns(
        {
            "reviewer_key": F.col("reviewer_id"),
            **{k: F.col("listing_id") for k in ("property_key", "location_key", "host_key")},
            "like_count": F.col("likes_count"),
            "ingestion_ts": F.coalesce("ingestion_ts", clock(as_of)),
        }
    )
    return cast_to_schema(rows, schema_of("factReview"))


def provider_facts(metrics: DataFrame, details: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Provider metrics ⟕ details, before the cut to a published schema."""
    return (
        provider_metrics_base(metrics)
        .join(provider_base(details), "provider_id", "left")
        .withColumns(
            {
                "provider_key": F.col("provider_id"),
                "ingestion_ts": F.coalesce("metrics_ts", "details_ts", clock(as_of)),
            }
        )
    )


def fact_ad(facts: DataFrame) -> DataFrame:
    return cast_to_schema(facts, schema_of("factAd"))


# --- marts ------------------------------------------------------------------------


def neighbourhood_performance(joined: DataFrame, as_of: AsOf = None) -> DataFrame:
    """From the neighbourhood base; listings are unique there, so a plain count is the distinct count."""
    rows = joined.groupBy("neighbourhood").agg(
        F.count("listing_id").alias("total_active_listings"),
        F.avg("price_per_night").alias("avg_price_per_night"),
        F.avg("estimated_revenue_l365d").alias("avg_annual_revenue"),
        F.avg("estimated_occupancy_l365d").alias("avg_occupancy_rate"),
        F.sum(numbers.or_zero(F.col("number_of_reviews_ltm"))).alias("total_reviews_ltm"),
    )
    return cast_to_schema(
        rows.withColumn("ingestion_ts", clock(as_of)), schema_of("AggNeighborhoodPerformance")
    )


def host_economics(joined: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Per room type, from HostDetails ⟕ RentMetrics ⟕ HostMetrics."""
    rows = joined.groupBy("room_type").agg(
        F.count("listing_id").alias("total_listings"),
        F.avg("price_per_night").alias("avg_price_per_night"),
        F.avg("estimated_revenue_l365d").alias("avg_annual_revenue"),
        F.avg("host_acceptance_rate").alias("avg_acceptance_rate"),
        F.avg("host_response_rate").alias("avg_response_rate"),
    )
    return cast_to_schema(
        rows.withColumn("ingestion_ts", clock(as_of)), schema_of("AggHostEconomics")
    )


def neighbourhood_invest(
    joined: DataFrame, as_of: AsOf = None, boost_limit: float = arrays.BOOST_LIMIT
) -> DataFrame:
    """Per city and neighbourhood: where promotion pays."""
    bookings = numbers.ratio_or_zero(F.col("estimated_revenue_l365d"), F.col("price_per_night"))
    rows = joined.groupBy(
        F.col("city").alias("city_name"), F.col("neighbourhood").alias("neighbourhood_name")
    ).agg(
        F.count("listing_id").alias("neighbourhood_most_views"),
        F.sum(bookings).alias("neighbourhood_most_bookings"),
        F.sum(numbers.or_zero(F.col("number_of_reviews_ltm"))).alias("neighbourhood_highest_reviews"),
        F.avg("price_per_night").alias("avg_order_price"),
        F.avg("estimated_revenue_l365d").alias("avg_revenue_l365d"),
        lower_median("availability_365").alias("median_availability"),
        F.avg("host_response_rate").alias("avg_response_rate"),
    )
    rows = rows.withColumns(
        {
            "neighbourhood_needed_boost": arrays.boost_level(F.col("avg_revenue_l365d"), boost_limit),
            "ingestion_ts": clock(as_of).cast("date"),
        }
    )
    return cast_to_schema(rows, schema_of("AggNeighbourhoodInvest"))


#: What a neighbourhood's sketches answer, for it and for anything made of neighbourhoods.
AUDIENCE = Sketches(distinct={"listings": "listing_id"}, quantiles={"availability": "availability_365", "price": "price_per_night"})
REVIEWERS = Sketches(distinct={"reviewers": "reviewer_id"})


def neighbourhood_sketches(joined: DataFrame, reviews: DataFrame) -> DataFrame:
    """Listings, reviewers, availability and price per city and neighbourhood as mergeable sketches.

    Reviewers are sketched per listing first, which a heavy listing survives, and meet the
    listings as one row each.
    """
    by_listing = REVIEWERS.of(reviews, ["listing_id"]).drop("n_rows")
    by = [F.col("city").alias("city_name"), F.col("neighbourhood").alias("neighbourhood_name")]
    rows = joined.select(*by, "listing_id", "availability_365", "price_per_night")
    place = ["city_name", "neighbourhood_name"]
    people = rows.select(*place, "listing_id").join(by_listing, "listing_id")
    people = REVIEWERS.rolled_up(people.withColumn("n_rows", F.lit(1)), place).drop("n_rows")
    listings = AUDIENCE.of(rows, place)
    same = [listings[c].eqNullSafe(people[c]) for c in place]
    return listings.join(people, same, "left").select(listings["*"], "reviewers")


def city_audience(sketched: DataFrame) -> DataFrame:
    """Per city: listings, distinct reviewers, median availability and price, from the sketches alone."""
    both = Sketches({**AUDIENCE.distinct, **REVIEWERS.distinct}, AUDIENCE.quantiles)
    cities = both.rolled_up(sketched, ["city_name"])
    ranks = {"median_availability": ("availability", 0.5), "median_price": ("price", 0.5)}
    return both.estimates(cities, ranks).withColumn("reviewers", F.coalesce("reviewers", F.lit(0)))


def agg_ads(facts: DataFrame, as_of: AsOf = None) -> DataFrame:
    """One row per provider: conversion, cost per campaign, customers gained."""
    conversion = F.col("avg_conversion_rate")
    rows = facts.select(
        F.col("provider_key").alias("provider_id"),
        F.col("name").alias("provider_name"),
        conversion.alias("provider_conversion_rate"),
        F.col("ctr").alias("most_clicked_provider"),
        "post_amount",
        conversion.alias("avg_campaign_conversion"),
        numbers.ratio_or_zero(F.col("total_ad_spend"), F.col("campaigns_count")).alias("avg_campaign_cost"),
        numbers.whole_product(F.col("total_clicks"), conversion).alias("customer_gained"),
        F.col("ctr").alias("conversion_rate"),
        numbers.whole_product(conversion, F.lit(100), "int").alias("new_customers_l30d_pct"),
        clock(as_of).alias("ingestion_ts"),
    )
    return cast_to_schema(rows, schema_of("AggAds"))


def premium_features(
    joined: DataFrame,
    as_of: AsOf = None,
    fraction: float = PREMIUM_FRACTION,
    heavy: DataFrame | None = None,
) -> DataFrame:
    """Training table for premium pricing, from RentDetails with every other base joined.

    A listing is a premium target when its price lies above the ``fraction`` quantile of
    the prices in its neighbourhood.  ``heavy``: heavy neighbourhoods, by default counted
    in ``joined``.
    """
    price = {"premium_limit": (F.col("price_per_night"), fraction)}
    limits = exact_quantiles(joined, ["neighbourhood"], price, heavy)
    labelled = salted_left_join(
        joined, limits, ["neighbourhood"], spread=[F.col("listing_id")], heavy=heavy
    )
    rows = labelled.withColumns(
        {
            **{
                k: F.col("listing_id")
                for k in ("listing_key", "property_key", "location_key", "host_key")
            },
            "amenities_count": arrays.list_size(F.col("amenities")),
            "response_time_category": F.col("host_response_time"),
            "is_premium_target": F.coalesce(
                F.col("price_per_night") > F.col("premium_limit"), F.lit(False)
            ),
            "ingestion_ts": _stamp(as_of, "RentDetails", "RentMetrics"),
        }
    )
    return cast_to_schema(rows, schema_of("ml_feature_premium_pricing"))


# --- everything -------------------------------------------------------------------


def listing_marts(wide: DataFrame, as_of: AsOf = None) -> dict[str, DataFrame]:
    """Every listing mart from one wide frame; each reads only the columns it needs."""
    location = wide.filter("in_Location")
    rents = wide.filter("in_RentMetrics")
    hosts = wide.filter("in_HostDetails")
    properties = wide.filter("in_RentDetails")
    return {
        "dimHost": dim_host(hosts, as_of),
        "dimProperty": dim_property(properties, as_of),
        "dimLocation": dim_location(location, as_of),
        "factListing": fact_listing(rents, as_of),
        "AggNeighbourhoodInvest": neighbourhood_invest(location, as_of),
        "AggNeighborhoodPerformance": neighbourhood_performance(location, as_of),
        "AggHostEconomics": host_economics(hosts, as_of),
        "ml_feature_premium_pricing": premium_features(properties, as_of),
    }


def provider_marts(
    details: DataFrame, metrics: DataFrame, as_of: AsOf = None
) -> dict[str, DataFrame]:
    facts = provider_facts(metrics, details, as_of)
    return {
        "dimProvider": dim_provider(details, as_of),
        "factAd": fact_ad(facts),
        "AggAds": agg_ads(facts, as_of),
    }


def build_gold(
    silver: Mapping[str, DataFrame], as_of: AsOf = None, unique: bool = False
) -> dict[str, DataFrame]:
    """All marts by name, lazily.  Provider marts only if both provider tables are there."""
    stats = review_stats(silver["Review"])
    marts = listing_marts(listing_wide(listing_bases(silver, unique), stats), as_of)
    marts["factReview"] = fact_review(silver["Review"], stats, as_of)
    marts["dimReviewer"] = dim_reviewer(silver["Review"])
    if {"providerDetails", "providerMetrics"} <= set(silver):
        marts |= provider_marts(silver["providerDetails"], silver["providerMetrics"], as_of)
    return marts
