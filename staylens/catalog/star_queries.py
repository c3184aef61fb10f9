"""Cleaning jobs, dimensions, facts, marts and the business questions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylens.catalog.frame_queries import (
    CITY_KPIS_SQL,
    ECONOMICS_SQL,
    FEATURES_SQL,
    PERFORMANCE_SQL,
    PROVIDER_TABLE_SQL,
)
from staylens.catalog.registry import Tables, flat, query
from staylens.catalog.twins import NOW, flat as flat_sql, title_sql
from staylens.operators.history import insert_only, scd2_merge, scd2_step
from staylens.operators.skew import heavy_keys
from staylens.plans import gold, questions, silver_ads, silver_listings, silver_reviews
from staylens.schemas import LISTING_TABLES
from staylens.sources.sinks import write_versions
from staylens.sources.versions import read_available, read_replaced

# --- cleaning jobs ----------------------------------------------------------------

CLEAN_COLUMNS = (
    "id", "description", "neighborhood_overview", "price", "host_response_rate", "host_acceptance_rate",
    "host_response_time", "host_is_superhost", "host_has_profile_pic", "host_identity_verified",
    "has_availability", "instant_bookable", "availability_30", "availability_365", "number_of_reviews_ltm",
    "estimated_revenue_l365d", "estimated_occupancy_l365d", "host_total_listings_count", "review_scores_rating",
)


@query("clean_listings", f"SELECT {', '.join(CLEAN_COLUMNS)} FROM listing_clean")
def clean_listings(t: Tables) -> DataFrame:
    return silver_listings.clean_listings(t.listing_feed).select(*CLEAN_COLUMNS)


STEP_OF = {
    "HostDetails": "host_details",
    "HostMetrics": "host_metrics",
    "RentDetails": "rent_details",
    "RentMetrics": "rent_metrics",
    "Location": "location",
    "Metadata": "metadata",
}


def _register_split(table: str) -> None:
    @query(f"split_listings_silver_{STEP_OF[table]}", f"SELECT {flat_sql(table)} FROM {STEP_OF[table]}")
    def split(t: Tables) -> DataFrame:
        return flat(silver_listings.split_listings(t.clean_listings)[table])


for _table in LISTING_TABLES:
    _register_split(_table)


@query("split_listings_silver", "SELECT 'HostDetails' AS table_name, id FROM host_details UNION ALL "
       "SELECT 'HostMetrics', id FROM host_metrics UNION ALL SELECT 'RentDetails', id FROM rent_details UNION ALL "
       "SELECT 'RentMetrics', id FROM rent_metrics UNION ALL SELECT 'Location', id FROM location UNION ALL "
       "SELECT 'Metadata', id FROM metadata")
def split_listings_silver(t: Tables) -> DataFrame:
    tables = [
        silver_listings.silver_table(t.listings, name).select(F.lit(name).alias("table_name"), "id")
        for name in LISTING_TABLES
    ]
    return reduce(DataFrame.unionByName, tables)


@query("clean_ads", f"SELECT {flat_sql('providerMetrics')}, name FROM ads_clean")
def clean_ads(t: Tables) -> DataFrame:
    cleaned = silver_ads.clean_ads(t.ads_feed, t.as_of)
    tables = silver_ads.split_ads(cleaned)
    names = tables["providerDetails"].select("id", "name")
    return flat(tables["providerMetrics"]).join(names, "id")


@query("clean_reviews", f"SELECT {flat_sql('Review')} FROM silver_review")
def clean_reviews(t: Tables) -> DataFrame:
    return flat(silver_reviews.clean_reviews(t.review_feed, t.as_of))


# --- dimensions -------------------------------------------------------------------

OPENED = f"{NOW} AS start_date, CAST(NULL AS TIMESTAMP) AS end_date, true AS is_current"
DIM_HOST_SQL = f"""
SELECT d.id AS host_key, {OPENED}, d.host_name AS name, m.host_response_time AS response_time_category,
  coalesce(m.ingestion_ts, d.ingestion_ts) AS ingestion_ts
FROM host_details d LEFT JOIN host_metrics m ON d.id = m.id
"""


@query("dim_host", f"SELECT {flat_sql('dimHost')} FROM ({DIM_HOST_SQL})")
def dim_host(t: Tables) -> DataFrame:
    return flat(gold.dim_host(gold.join_listings(t.base("HostDetails"), t.base("HostMetrics")), t.as_of))


DIM_PROPERTY_SQL = f"""
SELECT {OPENED}, r.id AS property_key, d.room_type, d.property_type, r.bedrooms, r.beds, r.amenities AS ameneties,
  r.accommodates, coalesce(r.ingestion_ts, d.ingestion_ts) AS ingestion_ts
FROM rent_details r LEFT JOIN host_details d ON r.id = d.id
"""


@query("dim_property", f"SELECT {flat_sql('dimProperty')} FROM ({DIM_PROPERTY_SQL})")
def dim_property(t: Tables) -> DataFrame:
    joined = gold.join_listings(t.base("RentDetails"), t.base("HostDetails"))
    return flat(gold.dim_property(joined, t.as_of))


@query("dim_location", f"SELECT {flat_sql('dimLocation')} FROM (SELECT id AS location_key, * FROM location)")
def dim_location(t: Tables) -> DataFrame:
    return flat(t.dim_location)


@query(
    "dim_location_insert_only",
    """
    SELECT c_custkey AS location_key, CASE WHEN c_nationkey < 12 THEN 'before' ELSE c_mktsegment END AS neighbourhood
    FROM customer
    """,
)
def dim_location_insert_only(t: Tables) -> DataFrame:
    customers = t.table("customer")
    known = customers.filter("c_nationkey < 12").selectExpr("c_custkey AS location_key", "'before' AS neighbourhood")
    fresh = customers.selectExpr("c_custkey AS location_key", "c_mktsegment AS neighbourhood")
    return insert_only(known, fresh, "location_key")


@query(
    "dim_provider",
    f"SELECT {flat_sql('dimProvider')} FROM (SELECT id AS provider_key, {OPENED}, name, ingestion_ts FROM ads_clean)",
)
def dim_provider(t: Tables) -> DataFrame:
    return flat(gold.dim_provider(t.silver_ads["providerDetails"], t.as_of))


DIM_REVIEWER_SQL = """
SELECT reviewer_id AS reviewer_key, reviewer_name AS name, date AS last_review_date, ingestion_ts FROM silver_review
QUALIFY row_number() OVER (PARTITION BY reviewer_id ORDER BY date DESC, id DESC) = 1
"""


@query("dim_reviewer", f"SELECT {flat_sql('dimReviewer')} FROM ({DIM_REVIEWER_SQL})")
def dim_reviewer(t: Tables) -> DataFrame:
    return flat(gold.dim_reviewer(t.silver_review))


MERGE_SQL = f"""
WITH history AS (
  SELECT c_custkey AS host_key, TIMESTAMP '2024-01-01' AS start_date, CAST(NULL AS TIMESTAMP) AS end_date,
    true AS is_current, c_name AS name, c_mktsegment AS response_time_category, TIMESTAMP '2024-01-01' AS ingestion_ts
  FROM customer WHERE c_mktsegment <> 'MACHINERY'
  UNION ALL
  SELECT c_custkey, TIMESTAMP '2023-01-01', TIMESTAMP '2024-01-01', false, 'was ' || c_name, NULL, TIMESTAMP '2023-01-01'
  FROM customer WHERE c_acctbal < 0),
snapshot AS (
  SELECT c_custkey AS host_key, c_name AS name,
    CASE WHEN c_nationkey < 8 THEN 'within a day' ELSE c_mktsegment END AS response_time_category
  FROM customer WHERE c_nationkey <> 20)
"""
MERGED_SQL = f"""
SELECT h.* REPLACE (
    CASE WHEN h.is_current AND s.response_time_category <> h.response_time_category THEN {NOW} ELSE h.end_date END AS end_date,
    h.is_current AND coalesce(s.response_time_category = h.response_time_category, true) AS is_current)
FROM history h LEFT JOIN snapshot s ON h.host_key = s.host_key
UNION ALL
SELECT s.host_key, {NOW}, NULL, true, s.name, s.response_time_category, {NOW}
FROM snapshot s LEFT JOIN history h ON h.is_current AND h.host_key = s.host_key
WHERE h.host_key IS NULL OR h.response_time_category <> s.response_time_category
"""


def _history_and_snapshot(t: Tables) -> tuple[DataFrame, DataFrame]:
    customers = t.table("customer")
    day, before = F.lit("2024-01-01").cast("timestamp"), F.lit("2023-01-01").cast("timestamp")
    none = F.lit(None)
    opened = customers.filter("c_mktsegment <> 'MACHINERY'").select(
        F.col("c_custkey").alias("host_key"),
        day.alias("start_date"),
        none.cast("timestamp").alias("end_date"),
        F.lit(True).alias("is_current"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("response_time_category"),
        day.alias("ingestion_ts"),
    )
    closed = customers.filter("c_acctbal < 0").select(
        F.col("c_custkey").alias("host_key"),
        before.alias("start_date"),
        day.alias("end_date"),
        F.lit(False).alias("is_current"),
        F.concat(F.lit("was "), "c_name").alias("name"),
        none.cast("string").alias("response_time_category"),
        before.alias("ingestion_ts"),
    )
    snapshot = customers.filter("c_nationkey <> 20").select(
        F.col("c_custkey").alias("host_key"),
        F.col("c_name").alias("name"),
        F.when(F.col("c_nationkey") < 8, "within a day").otherwise(F.col("c_mktsegment")).alias("response_time_category"),
        F.lit(t.as_of).cast("timestamp").alias("ingestion_ts"),
    )
    return opened.unionByName(closed), snapshot


@query("scd2_merge", f"{MERGE_SQL} SELECT {flat_sql('dimHost')} FROM ({MERGED_SQL})")
def merge(t: Tables) -> DataFrame:
    history, snapshot = _history_and_snapshot(t)
    return flat(scd2_merge(history, snapshot, "host_key", ["name", "response_time_category"], t.as_of))


@query("scd2_merge_versions", f"{MERGE_SQL} SELECT {flat_sql('dimHost')} FROM ({MERGED_SQL})")
def merge_versions(t: Tables) -> DataFrame:
    """The same with closed rows kept apart: written once, then neither read nor written.  Merged twice."""
    history, snapshot = _history_and_snapshot(t)
    layer, is_open = t.work("history"), {"dimHost": F.col("is_current")}
    write_versions(t.spark, {"dimHost": history}, layer, is_open)
    for _ in range(2):
        opened = read_replaced(t.spark, layer, "dimHost")
        changed = scd2_step(opened, snapshot, "host_key", ["name", "response_time_category"], t.as_of)
        write_versions(t.spark, {"dimHost": changed}, layer, is_open)
    return flat(read_available(t.spark, layer, ["dimHost"])["dimHost"])


@query(
    "scd2_merge_close_vanished",
    f"""{MERGE_SQL}
    SELECT host_key, name, CASE WHEN is_current AND host_key NOT IN (SELECT host_key FROM snapshot)
      THEN false ELSE is_current END AS is_current
    FROM ({MERGED_SQL})
    """,
)
def merge_close_vanished(t: Tables) -> DataFrame:
    history, snapshot = _history_and_snapshot(t)
    merged = scd2_merge(
        history, snapshot, "host_key", ["name", "response_time_category"], t.as_of, close_vanished=True
    )
    return merged.select("host_key", "name", "is_current")


# --- facts and marts --------------------------------------------------------------


@query("fact_listing", f"SELECT {flat_sql('factListing')} FROM fact_listing")
def fact_listing(t: Tables) -> DataFrame:
    return flat(t.fact_listing)


FACT_REVIEW_SQL = """
SELECT r.reviewer_id AS reviewer_key, r.listing_id AS property_key, r.listing_id AS location_key,
  r.listing_id AS host_key, r.comment, r.language, r.likes_count AS like_count, r.sentiment_score,
  s.number_of_reviews_ltm, r.ingestion_ts
FROM silver_review r LEFT JOIN review_stats s ON r.listing_id = s.listing_id
"""


@query("fact_review", f"SELECT {flat_sql('factReview')} FROM ({FACT_REVIEW_SQL})")
def fact_review(t: Tables) -> DataFrame:
    return flat(gold.fact_review(t.silver_review, t.stats, t.as_of))


@query("fact_review_skewed", f"SELECT {flat_sql('factReview')} FROM ({FACT_REVIEW_SQL})")
def fact_review_skewed(t: Tables) -> DataFrame:
    """The same fact with the "no listing" key and other frequent listings taken as heavy."""
    heavy = heavy_keys(t.silver_review, ["listing_id"], share=0.002, min_rows=1)
    return flat(gold.fact_review(t.silver_review, t.stats, t.as_of, heavy))


@query("fact_ad", f"SELECT {flat_sql('factAd')} FROM (SELECT id AS provider_key, * FROM ads_clean)")
def fact_ad(t: Tables) -> DataFrame:
    return flat(gold.fact_ad(t.provider_facts))


@query("agg_ads", f"SELECT {flat_sql('AggAds')} FROM agg_ads")
def agg_ads(t: Tables) -> DataFrame:
    return flat(t.agg_ads)


@query(
    "city_audience",
    """
    SELECT n.city AS city_name, n.listings, n.listings AS n_rows, coalesce(p.reviewers, 0) AS reviewers, true AS within
    FROM (SELECT city, count(DISTINCT listing_id) AS listings FROM neighbourhood_base GROUP BY city) n
    LEFT JOIN (SELECT b.city, count(DISTINCT r.reviewer_id) AS reviewers FROM neighbourhood_base b
      JOIN silver_review r ON r.listing_id = b.listing_id GROUP BY b.city) p ON p.city IS NOT DISTINCT FROM n.city
    """,
)
def city_audience(t: Tables) -> DataFrame:
    """Cities from the sketches of their neighbourhoods, next to the exact counts."""
    sketched = t.stored("AggNeighbourhoodSketches", lambda: gold.neighbourhood_sketches(t.neighbourhood_base, t.silver_review))
    found = gold.city_audience(sketched)
    places = t.neighbourhood_base.select("listing_id", F.col("city").alias("city"))
    listings = places.groupBy("city").agg(F.countDistinct("listing_id").alias("listings"))
    people = places.join(t.silver_review.select("listing_id", "reviewer_id"), "listing_id")
    people = people.groupBy("city").agg(F.countDistinct("reviewer_id").alias("reviewers"))
    exact = listings.join(people.withColumnRenamed("city", "c"), F.col("city").eqNullSafe(F.col("c")), "left").drop("c")
    near = lambda name: F.abs(found[name] - F.coalesce(exact[name], F.lit(0))) <= 0.05 * F.coalesce(exact[name], F.lit(0))
    median = found.median_availability.isNull() | found.median_availability.between(0, 365)
    return found.join(exact, found.city_name.eqNullSafe(exact.city)).select(
        "city_name", exact.listings, "n_rows", F.coalesce(exact.reviewers, F.lit(0)).alias("reviewers"),
        (near("listings") & near("reviewers") & median).alias("within"),
    )


MART_ROWS = {
    "dimHost": "host_details",
    "dimProperty": "rent_details",
    "dimLocation": "location",
    "factListing": "fact_listing",
    "AggNeighbourhoodInvest": "invest",
    "AggNeighborhoodPerformance": f"({PERFORMANCE_SQL})",
    "AggHostEconomics": f"({ECONOMICS_SQL})",
    "ml_feature_premium_pricing": f"({FEATURES_SQL})",
    "factReview": "silver_review",
    "dimReviewer": f"({DIM_REVIEWER_SQL})",
    "dimProvider": "ads_clean",
    "factAd": "ads_clean",
    "AggAds": "agg_ads",
}


@query(
    "build_gold",
    " UNION ALL ".join(f"SELECT '{m}' AS mart, count(*) AS n FROM {source}" for m, source in MART_ROWS.items()),
)
def build_gold(t: Tables) -> DataFrame:
    marts = gold.build_gold(t.silver, t.as_of, unique=True)
    counts = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(m).alias("mart"), "n") for m, df in marts.items()]
    return reduce(DataFrame.unionByName, counts)


WIDE_SQL = """
SELECT l.id AS listing_id, l.city, r.estimated_revenue_l365d, m.host_response_time, d.room_type, e.accommodates,
  s.number_of_reviews_ltm
FROM location l JOIN rent_metrics r ON l.id = r.id JOIN host_metrics m ON l.id = m.id
JOIN host_details d ON l.id = d.id JOIN rent_details e ON l.id = e.id LEFT JOIN review_stats s ON l.id = s.listing_id
"""


@query("listing_wide", WIDE_SQL)
def listing_wide(t: Tables) -> DataFrame:
    wide = gold.listing_wide({name: t.base(name) for name in gold.BASE_COLUMNS}, t.stats)
    return wide.select(
        "listing_id", "city", "estimated_revenue_l365d", "host_response_time", "room_type", "accommodates",
        "number_of_reviews_ltm",
    )


# --- business questions -----------------------------------------------------------


@query(
    "invest_question",
    f"""
    SELECT k.city_name, k.active_listings, k.bookings, k.total_revenue, coalesce(m.markers, 0) AS markers
    FROM ({CITY_KPIS_SQL}) k
    LEFT JOIN (SELECT city, count(*) AS markers FROM (
        SELECT city FROM low_listings
        QUALIFY row_number() OVER (PARTITION BY city ORDER BY coalesce(estimated_revenue_l365d, 0), id) <= 200)
      GROUP BY city) m ON m.city = lower(trim(k.city_name))
    """,
)
def invest_question(t: Tables) -> DataFrame:
    answer = questions.invest_answer(t.invest, t.located)
    shown = answer["markers"].groupBy("city").agg(F.count(F.lit(1)).alias("markers"))
    kpis = answer["city_kpis"].withColumn("city", F.lower(F.trim("city_name")))
    return kpis.join(shown, "city", "left").select(
        "city_name",
        "active_listings",
        "bookings",
        F.round("total_revenue", 1).alias("total_revenue"),
        F.coalesce("markers", F.lit(0)).alias("markers"),
    )


@query(
    "invest_question_markers",
    """
    SELECT city, round(latitude, 6) AS lat, round(longitude, 6) AS lng, id AS listing_id, neighbourhood,
      '$' || format('{:,}', estimated_revenue_l365d) AS revenue, format('{:,}', estimated_occupancy_l365d) AS occupancy,
      '$' || format('{:,.0f}', CAST(price_per_night AS DOUBLE)) AS price
    FROM low_listings
    QUALIFY row_number() OVER (PARTITION BY city ORDER BY coalesce(estimated_revenue_l365d, 0), id) <= 200
    """,
)
def invest_question_markers(t: Tables) -> DataFrame:
    return questions.invest_answer(t.invest, t.located)["markers"]


@query(
    "invest_question_city",
    """
    SELECT 'kpis' AS part, CAST(sum(neighbourhood_most_views) AS BIGINT) AS id,
      CAST(sum(neighbourhood_most_bookings) AS BIGINT) AS n FROM invest WHERE city_name = 'ASIA'
    UNION ALL SELECT 'markers', id, CAST(NULL AS BIGINT) FROM low_listings WHERE city = 'asia'
    QUALIFY row_number() OVER (ORDER BY coalesce(estimated_revenue_l365d, 0), id) <= 200
    """,
)
def invest_question_city(t: Tables) -> DataFrame:
    """The page of one city, asked for in another spelling."""
    page = questions.invest_answer(t.invest, t.located, " Asia ")
    kpis = page["city_kpis"].select(F.lit("kpis").alias("part"), F.col("active_listings").cast("bigint").alias("id"), F.col("bookings").cast("bigint").alias("n"))
    return kpis.unionByName(
        page["markers"].select(F.lit("markers").alias("part"), F.col("listing_id").alias("id"), F.lit(None).cast("bigint").alias("n"))
    )


@query("promotion_question", PROVIDER_TABLE_SQL)
def promotion_question(t: Tables) -> DataFrame:
    return questions.promotion_answer(t.agg_ads)["table"]



@query(
    "invest_question_kpi_texts",
    f"""
    SELECT {title_sql('city_name')} AS city,
      format('{{:,}}', CAST(sum(neighbourhood_most_views) AS BIGINT)) AS active_listings,
      format('{{:,}}', CAST(sum(neighbourhood_most_bookings) AS BIGINT)) AS bookings,
      '$' || format('{{:,.0f}}', avg(CAST(avg_order_price AS DOUBLE))) AS avg_price,
      '$' || format('{{:,.0f}}', sum(CAST(avg_revenue_l365d AS DOUBLE) * neighbourhood_most_views)) AS total_revenue,
      format('{{:.2f}}', avg(CAST(avg_response_rate AS DOUBLE))) || '%' AS avg_response,
      format('{{:,}}', CAST(round_even(median(CAST(median_availability AS DOUBLE)), 0) AS BIGINT)) AS median_availability
    FROM invest GROUP BY city_name
    """,
)
def invest_question_kpi_texts(t: Tables) -> DataFrame:
    return questions.city_kpi_texts(questions.city_kpis(t.invest))


@query(
    "promotion_question_kpi_texts",
    """
    SELECT format('{:.2f}', avg(CAST(provider_conversion_rate AS DOUBLE)) * 100) || '%' AS avg_conversion,
      '$' || format('{:,.0f}', sum(CAST(avg_campaign_cost AS DOUBLE))) AS total_spend,
      format('{:,}', CAST(sum(customer_gained) AS BIGINT)) AS total_customers,
      format('{:,}', count(*)) AS provider_count
    FROM agg_ads
    """,
)
def promotion_question_kpi_texts(t: Tables) -> DataFrame:
    return questions.promotion_kpi_texts(questions.promotion_kpis(t.agg_ads))
