"""Plain-SQL twins of the shared steps, for the checking engine.

Each entry is one common table expression; ``twin`` puts the ones a query needs in front
of it.  They are written from the rules, independently of the Spark code.
"""

from __future__ import annotations

import re

from staylens import schemas
from staylens.catalog.feeds import FEEDS

AS_OF = "2024-01-15 00:00:00"
NOW = f"TIMESTAMP '{AS_OF}'"


def squeeze_number(column: str, marks: str, pattern: str, kind: str) -> str:
    text = f"trim(regexp_replace(trim(CAST({column} AS VARCHAR)), '{marks}', '', 'g'))"
    return f"CASE WHEN regexp_full_match({text}, '{pattern}') THEN TRY_CAST({text} AS {kind}) END"


def as_double(column: str, marks: str = "~") -> str:
    return squeeze_number(column, marks, r"[+-]?\d+(\.\d+)?", "DOUBLE")


def as_int(column: str, marks: str = "~") -> str:
    return squeeze_number(column, marks, r"[+-]?\d+", "INTEGER")


def is_missing(column: str, tokens: str = "'n/a','na','null','none'") -> str:
    return f"(coalesce(lower(trim({column})), '') IN ('', {tokens}))"


def category(column: str, default: str, tokens: str = "'n/a','na','null','none','nan'") -> str:
    return f"CASE WHEN {is_missing(column, tokens)} THEN '{default}' ELSE trim({column}) END"


def tf(column: str) -> str:
    key = f"lower(trim({column}))"
    return (
        f"CASE WHEN {key} IN ('t','true','1','yes','y') THEN true "
        f"WHEN {key} IN ('f','false','0','no','n') THEN false END"
    )


def breaks(column: str) -> str:
    return rf"trim(regexp_replace({column}, '<br\s*/?>', ' ', 'g'))"


def price(column: str = "price") -> str:
    return f"CASE WHEN NOT {is_missing(column)} THEN {as_double(column, '[$,]')} END"


def text_list(column: str) -> str:
    return f"""from_json({column}, '["VARCHAR"]')"""


def flat(table: str, alias: str = "") -> str:
    """Select list of a declared table with lists and times as text, floats rounded."""
    ddl = (schemas.BRONZE | schemas.SILVER | schemas.GOLD)[table]
    shown = []
    for part in ddl.split(","):
        name, kind = part.split()
        column = f"{alias}.{name}" if alias else name
        if kind == "ARRAY<STRING>":
            column = f"array_to_string({column}, '|')"
        elif kind == "TIMESTAMP":
            column = f"strftime({column}, '%Y-%m-%d %H:%M:%S')"
        elif kind == "DATE":
            column = f"strftime({column}, '%Y-%m-%d')"
        elif kind in ("FLOAT", "DOUBLE"):
            column = f"round(CAST(CAST({column} AS {kind}) AS DOUBLE), 3)"
        shown.append(f"{column} AS {name}")
    return ", ".join(shown)


LISTING_CLEAN = f"""
SELECT * REPLACE (
    {breaks('description')} AS description,
    CASE WHEN coalesce({breaks('neighborhood_overview')}, '') = '' THEN {breaks('description')}
         ELSE {breaks('neighborhood_overview')} END AS neighborhood_overview,
    coalesce({price()}, 0.0) AS price,
    coalesce({as_double('host_response_rate', '%')}, 0.0) AS host_response_rate,
    coalesce({as_int('host_acceptance_rate', '%')}, 0) AS host_acceptance_rate,
    {category('host_response_time', 'unknown', "'n/a','na','null','none'")} AS host_response_time,
    {', '.join(f"{tf(c)} AS {c}" for c in ('host_is_superhost', 'host_has_profile_pic',
       'host_identity_verified', 'has_availability', 'instant_bookable'))},
    {', '.join(f"coalesce({c}, 0) AS {c}" for c in ('estimated_revenue_l365d',
       'estimated_occupancy_l365d', 'availability_30', 'availability_60', 'availability_90',
       'availability_365', 'availability_eoy', 'number_of_reviews_ltm', 'number_of_reviews_l30d',
       'number_of_reviews_ly', 'host_total_listings_count'))},
    CASE WHEN review_scores_rating BETWEEN 0 AND 5 THEN CAST(review_scores_rating AS DOUBLE) END
      AS review_scores_rating,
    {text_list('host_verifications')} AS host_verifications,
    {text_list('amenities')} AS amenities)
FROM listing_feed
"""

LISTINGS = """
SELECT * FROM listing_clean WHERE id IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY id ORDER BY ingestion_ts DESC) = 1
"""

HOST_DETAILS = f"""
SELECT id, host_id, id AS listing_id, host_url, host_id AS host_profile_id, host_url AS host_profile_url,
  {category('host_name', '')} AS host_name, host_thumbnail_url, host_neighbourhood,
  host_total_listings_count, host_location, host_about, host_is_superhost, host_picture_url,
  host_verifications, host_has_profile_pic, host_identity_verified,
  {category('property_type', 'unkown')} AS property_type, {category('room_type', 'unkown')} AS room_type,
  ingestion_ts FROM listings
"""
HOST_METRICS = """
SELECT id, host_response_time, CAST(host_response_rate AS FLOAT) AS host_response_rate,
  host_acceptance_rate, ingestion_ts FROM listings
"""
RENT_DETAILS = """
SELECT id, accommodates, bathrooms, bathrooms_text, coalesce(bedrooms, 0) AS bedrooms,
  coalesce(beds, 0) AS beds, coalesce(amenities, []) AS amenities, minimum_nights, maximum_nights,
  minimum_minimum_nights, maximum_minimum_nights, minimum_maximum_nights, maximum_maximum_nights,
  minimum_nights_avg_ntm, maximum_nights_avg_ntm, license, ingestion_ts FROM listings
"""
RENT_METRICS = """
SELECT id, CAST(price AS FLOAT) AS price_per_night, has_availability, estimated_occupancy_l365d,
  estimated_revenue_l365d, availability_30, availability_60, availability_90, availability_365,
  availability_eoy, instant_bookable, calculated_host_listings_count,
  calculated_host_listings_count_entire_homes, calculated_host_listings_count_private_rooms,
  calculated_host_listings_count_shared_rooms, number_of_reviews_ltm, ingestion_ts FROM listings
"""
LOCATION = f"""
SELECT id, country, city, listing_url, name, description, {category('neighbourhood', 'unkown')} AS neighbourhood,
  neighborhood_overview, picture_url, latitude, longitude,
  {category('host_neighbourhood', 'unkown')} AS host_neighbourhood, ingestion_ts FROM listings
"""
METADATA = """
SELECT id, source, scrape_id, last_scraped, calendar_last_scraped, ingestion_ts FROM listings
"""

REVIEW_ROWS = f"""
SELECT id, coalesce(listing_id, -1) AS listing_id, coalesce(date, event_ingestion_time, {NOW}) AS date,
  reviewer_id, coalesce(trim(reviewer_name), '') AS reviewer_name,
  coalesce(trim(regexp_replace(comments, '\\s+', ' ', 'g')), '') AS comment,
  coalesce(lower(trim(language)), 'unknown') AS language,
  CASE WHEN sentiment_score IS NULL OR isnan(sentiment_score) THEN CAST(1.0 AS FLOAT)
       ELSE sentiment_score END AS sentiment_score,
  CASE WHEN coalesce(len({text_list('sentiment_label')}), 0) = 0 THEN ['positive']
       ELSE list_transform({text_list('sentiment_label')}, lambda x: lower(trim(x))) END AS sentiment_label,
  coalesce(likes_votes, 0) AS likes_count, {NOW} AS ingestion_ts
FROM review_feed WHERE id IS NOT NULL AND reviewer_id IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY id ORDER BY review_feed.ingestion_ts DESC) = 1
"""
SILVER_REVIEW = """
SELECT *, date AS start_date,
  lead(date) OVER (PARTITION BY reviewer_id ORDER BY date, id) AS end_date,
  lead(date) OVER (PARTITION BY reviewer_id ORDER BY date, id) IS NULL AS is_current
FROM review_rows
"""

ADS_CLEAN = f"""
SELECT id, {category('name', '')} AS name, coalesce(avg_conversion_rate, 0) AS avg_conversion_rate,
  coalesce(post_amount, 0) AS post_amount, coalesce(total_impressions, 0) AS total_impressions,
  coalesce(total_clicks, 0) AS total_clicks, coalesce(ctr, 0) AS ctr, total_ad_spend,
  coalesce(return_on_investment, 0) AS return_on_investment,
  CASE WHEN coalesce(trim(region_coverage), '') = '' THEN 'unkown' ELSE trim(region_coverage) END AS region_coverage,
  churn_rate_provider AS churn_rate, coalesce(avg_cpc, 0) AS avg_cpc, coalesce(avg_cpm, 0) AS avg_cpm,
  coalesce(concurrent_campaigns_count, 0) AS campaigns_count,
  CASE WHEN coalesce(trim(data_compliance_level), '') = '' THEN 'unkown'
       ELSE trim(data_compliance_level) END AS data_compliance_level,
  coalesce(partition_date, last_updated, {NOW}) AS partition_date,
  coalesce(ingestion_ts, {NOW}) AS ingestion_ts
FROM ads_feed WHERE id IS NOT NULL
"""

REVIEW_STATS = """
SELECT listing_id, CAST(count(*) AS INTEGER) AS number_of_reviews_ltm, avg(CAST(sentiment_score AS DOUBLE)) AS avg_sentiment_score
FROM silver_review GROUP BY listing_id
"""

NEIGHBOURHOOD_BASE = """
SELECT l.id AS listing_id, l.city, l.neighbourhood, r.price_per_night, r.estimated_revenue_l365d,
  r.estimated_occupancy_l365d, r.availability_365, h.host_response_rate, s.number_of_reviews_ltm,
  s.avg_sentiment_score
FROM location l LEFT JOIN rent_metrics r ON l.id = r.id LEFT JOIN host_metrics h ON l.id = h.id
LEFT JOIN review_stats s ON l.id = s.listing_id
"""

FACT_LISTING = """
SELECT r.id, r.id AS property_key, r.id AS location_key, r.id AS host_key,
  d.host_total_listings_count AS total_listing_count, r.price_per_night,
  r.estimated_occupancy_l365d, r.estimated_revenue_l365d, m.host_response_rate, m.host_acceptance_rate,
  coalesce(r.ingestion_ts, m.ingestion_ts, d.ingestion_ts) AS ingestion_ts
FROM rent_metrics r LEFT JOIN host_metrics m ON r.id = m.id LEFT JOIN host_details d ON r.id = d.id
"""

INVEST = f"""
SELECT city AS city_name, neighbourhood AS neighbourhood_name,
  CAST(count(DISTINCT listing_id) AS INTEGER) AS neighbourhood_most_views,
  CAST(trunc(sum(CASE WHEN price_per_night > 0 THEN estimated_revenue_l365d / CAST(price_per_night AS DOUBLE) ELSE 0.0 END)) AS BIGINT)
    AS neighbourhood_most_bookings,
  CAST(sum(coalesce(number_of_reviews_ltm, 0)) AS BIGINT) AS neighbourhood_highest_reviews,
  [CASE WHEN avg(estimated_revenue_l365d) > 20000 THEN 'low' ELSE 'high' END] AS neighbourhood_needed_boost,
  CAST(avg(CAST(price_per_night AS DOUBLE)) AS FLOAT) AS avg_order_price,
  CAST(avg(estimated_revenue_l365d) AS FLOAT) AS avg_revenue_l365d,
  CAST(quantile_disc(availability_365, 0.5) AS FLOAT) AS median_availability,
  CAST(avg(CAST(host_response_rate AS DOUBLE)) AS FLOAT) AS avg_response_rate,
  CAST({NOW} AS DATE) AS ingestion_ts
FROM neighbourhood_base GROUP BY city, neighbourhood
"""

AGG_ADS = f"""
SELECT id AS provider_id, name AS provider_name, avg_conversion_rate AS provider_conversion_rate,
  ctr AS most_clicked_provider, post_amount, avg_conversion_rate AS avg_campaign_conversion,
  CAST(CASE WHEN campaigns_count > 0 THEN CAST(total_ad_spend AS DOUBLE) / campaigns_count ELSE 0.0 END AS FLOAT) AS avg_campaign_cost,
  CAST(trunc(CAST(total_clicks AS FLOAT) * CAST(avg_conversion_rate AS FLOAT)) AS BIGINT) AS customer_gained, ctr AS conversion_rate,
  CAST(trunc(CAST(avg_conversion_rate AS FLOAT) * CAST(100 AS FLOAT)) AS INTEGER) AS new_customers_l30d_pct, {NOW} AS ingestion_ts
FROM ads_clean
"""

LOCATED = """
SELECT l.id AS location_key, l.city, l.neighbourhood, l.latitude, l.longitude, f.id,
  f.estimated_revenue_l365d, f.estimated_occupancy_l365d, f.price_per_night
FROM location l JOIN fact_listing f ON l.id = f.location_key
"""

LOW_LISTINGS = """
SELECT q.* EXCLUDE (rev_q, occ_q) FROM (
  SELECT * REPLACE (lower(trim(city)) AS city),
    quantile_cont(coalesce(estimated_revenue_l365d, 0), 0.25) OVER (PARTITION BY lower(trim(city))) AS rev_q,
    quantile_cont(coalesce(estimated_occupancy_l365d, 0), 0.25) OVER (PARTITION BY lower(trim(city))) AS occ_q
  FROM located) q
WHERE (coalesce(estimated_revenue_l365d, 0) <= rev_q OR coalesce(estimated_occupancy_l365d, 0) <= occ_q)
  AND latitude IS NOT NULL AND longitude IS NOT NULL
"""

STEPS = {
    **FEEDS,
    "listing_clean": LISTING_CLEAN,
    "listings": LISTINGS,
    "host_details": HOST_DETAILS,
    "host_metrics": HOST_METRICS,
    "rent_details": RENT_DETAILS,
    "rent_metrics": RENT_METRICS,
    "location": LOCATION,
    "metadata": METADATA,
    "review_rows": REVIEW_ROWS,
    "silver_review": SILVER_REVIEW,
    "ads_clean": ADS_CLEAN,
    "review_stats": REVIEW_STATS,
    "neighbourhood_base": NEIGHBOURHOOD_BASE,
    "fact_listing": FACT_LISTING,
    "invest": INVEST,
    "agg_ads": AGG_ADS,
    "located": LOCATED,
    "low_listings": LOW_LISTINGS,
}


def twin(sql: str) -> str:
    """The statement with every shared step it (or a step) names in a WITH clause."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in STEPS:
            if re.search(rf"\b(FROM|JOIN)\s+{name}\b", text) and name not in needed:
                visit(STEPS[name])
                needed.append(name)

    visit(sql)
    if not needed:
        return sql
    return "WITH " + ",\n".join(f"{n} AS ({STEPS[n]})" for n in needed) + "\n" + sql


def title_sql(column: str) -> str:
    """Runs of letters with a capital first and small letters after."""
    return (
        f"array_to_string(list_transform(regexp_extract_all({column}, '\\p{{L}}+|\\P{{L}}+'), "
        "lambda w: upper(w[1]) || lower(w[2:])), '')"
    )
