"""Declared table schemas of the three layers, as Spark DDL.

Column names, their order and their types are fixed values: the feeds deliver
them and the marts publish them.  Every natural key is BIGINT, so ids above the
32-bit range survive.  All columns are nullable.
"""

from __future__ import annotations

from functools import cache

from pyspark.sql.types import ArrayType, DataType, StringType, StructField, StructType

# --- fixed values: bronze feeds -------------------------------------------------

LISTING = """
id BIGINT, listing_url STRING, scrape_id STRING, last_scraped TIMESTAMP, source STRING,
name STRING, description STRING, neighborhood_overview STRING, picture_url STRING,
host_id STRING, host_url STRING, host_name STRING, host_since TIMESTAMP, host_location STRING,
host_about STRING, host_response_time STRING, host_response_rate STRING,
host_acceptance_rate STRING, host_is_superhost STRING, host_thumbnail_url STRING,
host_picture_url STRING, host_neighbourhood STRING, host_listings_count INT,
host_total_listings_count INT, host_verifications ARRAY<STRING>, host_has_profile_pic STRING,
host_identity_verified STRING, neighbourhood STRING, neighbourhood_cleansed STRING,
neighbourhood_group_cleansed STRING, latitude DOUBLE, longitude DOUBLE, property_type STRING,
room_type STRING, accommodates INT, bathrooms INT, bathrooms_text STRING, bedrooms INT, beds INT,
amenities ARRAY<STRING>, price STRING, minimum_nights INT, maximum_nights INT,
minimum_minimum_nights INT, maximum_minimum_nights INT, minimum_maximum_nights INT,
maximum_maximum_nights INT, minimum_nights_avg_ntm FLOAT, maximum_nights_avg_ntm FLOAT,
calendar_updated TIMESTAMP, has_availability STRING, availability_30 INT, availability_60 INT,
availability_90 INT, availability_365 INT, calendar_last_scraped TIMESTAMP,
number_of_reviews INT, number_of_reviews_ltm INT, number_of_reviews_l30d INT,
availability_eoy INT, number_of_reviews_ly INT, estimated_occupancy_l365d INT,
estimated_revenue_l365d INT, first_review TIMESTAMP, last_review TIMESTAMP,
review_scores_rating FLOAT, review_scores_accuracy FLOAT, review_scores_cleanliness FLOAT,
review_scores_checkin FLOAT, review_scores_communication FLOAT, review_scores_location FLOAT,
review_scores_value FLOAT, license STRING, instant_bookable STRING,
calculated_host_listings_count INT, calculated_host_listings_count_entire_homes INT,
calculated_host_listings_count_private_rooms INT,
calculated_host_listings_count_shared_rooms INT, reviews_per_month FLOAT
"""

REVIEWS = """
listing_id BIGINT, id BIGINT, date TIMESTAMP, reviewer_id BIGINT, reviewer_name STRING,
comments STRING, language STRING, sentiment_score FLOAT, sentiment_label ARRAY<STRING>,
likes_votes INT, event_ingestion_time TIMESTAMP, raw_user_agent STRING,
bot_suspicion_score FLOAT, reviewer_hash_id STRING, aspect_sentiment_json STRING,
extracted_keywords STRING, comment_character_count INT, readability_index FLOAT,
session_id STRING, time_spent_on_review_ms INT, contains_media BOOLEAN, ingestion_ts TIMESTAMP
"""

ADS_PROVIDERS = """
id BIGINT, name STRING, price INT, n_listings INT, last_updated TIMESTAMP,
avg_conversion_rate FLOAT, post_amount INT, total_impressions BIGINT, total_clicks BIGINT,
ctr FLOAT, total_ad_spend FLOAT, return_on_investment FLOAT, target_demographics STRING,
region_coverage STRING, reliability_score FLOAT, api_endpoint_latency STRING,
churn_rate_provider FLOAT, avg_cpc FLOAT, avg_cpm FLOAT, audience_interest_tags STRING,
fraud_traffic_percent FLOAT, attribution_window STRING, concurrent_campaigns_count INT,
market_share_percentage FLOAT, data_compliance_level STRING, partition_date TIMESTAMP,
ingestion_ts TIMESTAMP
"""

# --- fixed values: silver tables ------------------------------------------------

HOST_DETAILS = """
id BIGINT, host_id STRING, listing_id BIGINT, host_url STRING, host_profile_id STRING,
host_profile_url STRING, host_name STRING, host_thumbnail_url STRING, host_neighbourhood STRING,
host_total_listings_count INT, host_location STRING, host_about STRING, host_is_superhost BOOLEAN,
host_picture_url STRING, host_verifications ARRAY<STRING>, host_has_profile_pic BOOLEAN,
host_identity_verified BOOLEAN, property_type STRING, room_type STRING, ingestion_ts TIMESTAMP
"""

HOST_METRICS = """
id BIGINT, host_response_time STRING, host_response_rate FLOAT, host_acceptance_rate INT,
ingestion_ts TIMESTAMP
"""

RENT_DETAILS = """
id BIGINT, accommodates INT, bathrooms INT, bathrooms_text STRING, bedrooms INT, beds INT,
amenities ARRAY<STRING>, minimum_nights INT, maximum_nights INT, minimum_minimum_nights INT,
maximum_minimum_nights INT, minimum_maximum_nights INT, maximum_maximum_nights INT,
minimum_nights_avg_ntm FLOAT, maximum_nights_avg_ntm FLOAT, license STRING, ingestion_ts TIMESTAMP
"""

RENT_METRICS = """
id BIGINT, price_per_night FLOAT, has_availability BOOLEAN, estimated_occupancy_l365d INT,
estimated_revenue_l365d INT, availability_30 INT, availability_60 INT, availability_90 INT,
availability_365 INT, availability_eoy INT, instant_bookable BOOLEAN,
calculated_host_listings_count INT, calculated_host_listings_count_entire_homes INT,
calculated_host_listings_count_private_rooms INT,
calculated_host_listings_count_shared_rooms INT, number_of_reviews_ltm INT, ingestion_ts TIMESTAMP
"""

LOCATION = """
id BIGINT, country STRING, city STRING, listing_url STRING, name STRING, description STRING,
neighbourhood STRING, neighborhood_overview STRING, picture_url STRING, latitude DOUBLE,
longitude DOUBLE, host_neighbourhood STRING, ingestion_ts TIMESTAMP
"""

METADATA = """
id BIGINT, source STRING, scrape_id STRING, last_scraped TIMESTAMP,
calendar_last_scraped TIMESTAMP, ingestion_ts TIMESTAMP
"""

REVIEW = """
id BIGINT, listing_id BIGINT, date TIMESTAMP, start_date TIMESTAMP, end_date TIMESTAMP,
is_current BOOLEAN, reviewer_id BIGINT, reviewer_name STRING, comment STRING, language STRING,
sentiment_score FLOAT, sentiment_label ARRAY<STRING>, likes_count INT, ingestion_ts TIMESTAMP
"""

PROVIDER_DETAILS = "id BIGINT, name STRING, ingestion_ts TIMESTAMP"

PROVIDER_METRICS = """
id BIGINT, avg_conversion_rate FLOAT, post_amount INT, total_impressions BIGINT,
total_clicks BIGINT, ctr FLOAT, total_ad_spend FLOAT, return_on_investment FLOAT,
region_coverage STRING, churn_rate FLOAT, avg_cpc FLOAT, avg_cpm FLOAT, campaigns_count INT,
data_compliance_level STRING, partition_date TIMESTAMP, ingestion_ts TIMESTAMP
"""

# --- fixed values: gold tables --------------------------------------------------

FACT_LISTING = """
id BIGINT, property_key BIGINT, location_key BIGINT, host_key BIGINT, total_listing_count INT,
price_per_night FLOAT, estimated_occupancy_l365d INT, estimated_revenue_l365d INT,
host_response_rate FLOAT, host_acceptance_rate INT, ingestion_ts TIMESTAMP
"""

DIM_PROPERTY = """
start_date TIMESTAMP, end_date TIMESTAMP, is_current BOOLEAN, property_key BIGINT,
room_type STRING, property_type STRING, bedrooms INT, beds INT, ameneties ARRAY<STRING>,
accommodates INT, ingestion_ts TIMESTAMP
"""

DIM_LOCATION = """
location_key BIGINT, neighbourhood STRING, latitude DOUBLE, longitude DOUBLE,
host_neighbourhood STRING, country STRING, city STRING, ingestion_ts TIMESTAMP
"""

DIM_HOST = """
host_key BIGINT, start_date TIMESTAMP, end_date TIMESTAMP, is_current BOOLEAN, name STRING,
response_time_category STRING, ingestion_ts TIMESTAMP
"""

DIM_PROVIDER = """
provider_key BIGINT, start_date TIMESTAMP, end_date TIMESTAMP, is_current BOOLEAN, name STRING,
ingestion_ts TIMESTAMP
"""

DIM_REVIEWER = "reviewer_key BIGINT, name STRING, last_review_date TIMESTAMP, ingestion_ts TIMESTAMP"

FACT_REVIEW = """
reviewer_key BIGINT, property_key BIGINT, location_key BIGINT, host_key BIGINT, comment STRING,
language STRING, like_count INT, sentiment_score FLOAT, number_of_reviews_ltm INT,
ingestion_ts TIMESTAMP
"""

FACT_AD = """
provider_key BIGINT, avg_conversion_rate FLOAT, post_amount INT, total_impressions BIGINT,
total_clicks BIGINT, ctr FLOAT, total_ad_spend FLOAT, return_on_investment FLOAT,
region_coverage STRING, churn_rate FLOAT, avg_cpc FLOAT, avg_cpm FLOAT, campaigns_count INT,
data_compliance_level STRING, partition_date TIMESTAMP, ingestion_ts TIMESTAMP
"""

AGG_NEIGHBOURHOOD_INVEST = """
city_name STRING, neighbourhood_name STRING, neighbourhood_most_views INT,
neighbourhood_most_bookings BIGINT, neighbourhood_highest_reviews BIGINT,
neighbourhood_needed_boost ARRAY<STRING>, avg_order_price FLOAT, avg_revenue_l365d FLOAT,
median_availability FLOAT, avg_response_rate FLOAT, ingestion_ts DATE
"""

AGG_ADS = """
provider_id BIGINT, provider_name STRING, provider_conversion_rate FLOAT,
most_clicked_provider FLOAT, post_amount INT, avg_campaign_conversion FLOAT,
avg_campaign_cost FLOAT, customer_gained BIGINT, conversion_rate FLOAT,
new_customers_l30d_pct INT, ingestion_ts TIMESTAMP
"""

AGG_NEIGHBORHOOD_PERFORMANCE = """
neighbourhood STRING, total_active_listings INT, avg_price_per_night FLOAT,
avg_annual_revenue FLOAT, avg_occupancy_rate FLOAT, total_reviews_ltm BIGINT,
ingestion_ts TIMESTAMP
"""

AGG_HOST_ECONOMICS = """
room_type STRING, total_listings INT, avg_price_per_night FLOAT, avg_annual_revenue FLOAT,
avg_acceptance_rate FLOAT, avg_response_rate FLOAT, ingestion_ts TIMESTAMP
"""

ML_FEATURE_PREMIUM_PRICING = """
listing_key BIGINT, property_key BIGINT, location_key BIGINT, host_key BIGINT,
property_type STRING, accommodates INT, bedrooms INT, amenities_count INT, availability_30 INT,
host_acceptance_rate FLOAT, response_time_category STRING, is_premium_target BOOLEAN,
ingestion_ts TIMESTAMP
"""

BRONZE = {"listing": LISTING, "reviews": REVIEWS, "adsProviders": ADS_PROVIDERS}

SILVER = {
    "HostDetails": HOST_DETAILS,
    "HostMetrics": HOST_METRICS,
    "RentDetails": RENT_DETAILS,
    "RentMetrics": RENT_METRICS,
    "Location": LOCATION,
    "Metadata": METADATA,
    "Review": REVIEW,
    "providerDetails": PROVIDER_DETAILS,
    "providerMetrics": PROVIDER_METRICS,
}

GOLD = {
    "factListing": FACT_LISTING,
    "dimProperty": DIM_PROPERTY,
    "dimLocation": DIM_LOCATION,
    "dimHost": DIM_HOST,
    "dimProvider": DIM_PROVIDER,
    "dimReviewer": DIM_REVIEWER,
    "factReview": FACT_REVIEW,
    "factAd": FACT_AD,
    "AggNeighbourhoodInvest": AGG_NEIGHBOURHOOD_INVEST,
    "AggAds": AGG_ADS,
    "AggNeighborhoodPerformance": AGG_NEIGHBORHOOD_PERFORMANCE,
    "AggHostEconomics": AGG_HOST_ECONOMICS,
    "ml_feature_premium_pricing": ML_FEATURE_PREMIUM_PRICING,
}

#: Silver tables that come out of one cleaned listing frame.
LISTING_TABLES = ("HostDetails", "HostMetrics", "RentDetails", "RentMetrics", "Location", "Metadata")


@cache
def schema_of(table: str) -> StructType:
    """Schema of a table of any layer; raises ``KeyError`` for an unknown name.

    DDL is parsed by the JVM, so a session has to be running.
    """
    return StructType.fromDDL((BRONZE | SILVER | GOLD)[table])


def table_names() -> list[str]:
    return [*BRONZE, *SILVER, *GOLD]


def is_list(data_type: DataType) -> bool:
    return isinstance(data_type, ArrayType)


def text_for_lists(schema: StructType) -> StructType:
    """The schema a CSV file can carry: list columns arrive as text."""
    return StructType(
        [
            StructField(f.name, StringType() if is_list(f.dataType) else f.dataType, f.nullable)
            for f in schema
        ]
    )
