"""The three feeds, derived from the benchmark tables.

A listing is a customer (neighbourhood = nation, city = region, prices and rates from
balances and orders), a review is an order, an advertising provider is a supplier with
its line items, a review event is a row of ``events``.  Dirty spellings are worked in by
expression, over all rows.  The SQL is the common subset of Spark SQL and the checking
engine, so both sides start from the same input text.
"""

from __future__ import annotations

LISTING_FEED = """
SELECT
  c.c_custkey AS id,
  'https://stay.example/rooms/' || CAST(c.c_custkey AS STRING) AS listing_url,
  's' || CAST(c.c_custkey % 9 AS STRING) AS scrape_id,
  CAST('2024-01-' || lpad(CAST(1 + c.c_custkey % 28 AS STRING), 2, '0') AS TIMESTAMP) AS last_scraped,
  'city scrape' AS source,
  c.c_name AS name,
  ' Near ' || n.n_name || '<br />' || c.c_name || '<br/>ask<br>host ' AS description,
  CASE c.c_custkey % 5 WHEN 0 THEN '  ' WHEN 1 THEN NULL WHEN 2 THEN '<br>'
       ELSE 'In <br  />' || n.n_name END AS neighborhood_overview,
  'https://stay.example/p/' || CAST(c.c_custkey AS STRING) AS picture_url,
  'h' || CAST(c.c_custkey % 700 AS STRING) AS host_id,
  'https://stay.example/h/' || CAST(c.c_custkey % 700 AS STRING) AS host_url,
  CASE c.c_custkey % 13 WHEN 0 THEN ' NaN ' WHEN 1 THEN 'n/a' WHEN 2 THEN '' WHEN 3 THEN NULL
       ELSE ' ' || c.c_name || ' ' END AS host_name,
  CAST('2015-03-' || lpad(CAST(1 + c.c_custkey % 30 AS STRING), 2, '0') AS TIMESTAMP) AS host_since,
  r.r_name AS host_location,
  'About ' || c.c_name AS host_about,
  CASE c.c_custkey % 6 WHEN 0 THEN 'within an hour' WHEN 1 THEN 'N/A' WHEN 2 THEN ' within a day '
       WHEN 3 THEN NULL WHEN 4 THEN 'nan' ELSE 'none' END AS host_response_time,
  CASE c.c_custkey % 9 WHEN 0 THEN 'N/A' WHEN 1 THEN CAST(c.c_custkey % 100 AS STRING) || '.5%'
       WHEN 2 THEN NULL ELSE CAST(c.c_custkey % 101 AS STRING) || '%' END AS host_response_rate,
  CASE c.c_custkey % 8 WHEN 0 THEN NULL WHEN 1 THEN '97.5%' WHEN 2 THEN '99999999999%'
       ELSE ' ' || CAST(c.c_custkey % 101 AS STRING) || '% ' END AS host_acceptance_rate,
  CASE c.c_custkey % 7 WHEN 0 THEN 't' WHEN 1 THEN 'f' WHEN 2 THEN ' T ' WHEN 3 THEN 'No'
       WHEN 4 THEN 'maybe' WHEN 5 THEN NULL ELSE '1' END AS host_is_superhost,
  'https://stay.example/t/' || CAST(c.c_custkey % 700 AS STRING) AS host_thumbnail_url,
  'https://stay.example/i/' || CAST(c.c_custkey % 700 AS STRING) AS host_picture_url,
  CASE WHEN c.c_custkey % 31 = 0 THEN 'null' ELSE n.n_name || ' ' END AS host_neighbourhood,
  CAST(CASE WHEN c.c_custkey % 12 = 0 THEN NULL ELSE c.c_custkey % 12 END AS INT) AS host_total_listings_count,
  '["email","phone ' || CAST(c.c_custkey % 3 AS STRING) || '"]' AS host_verifications,
  CASE WHEN c.c_custkey % 4 = 0 THEN 'TRUE' ELSE 'n' END AS host_has_profile_pic,
  CASE WHEN c.c_custkey % 3 = 0 THEN 'yes' ELSE '0' END AS host_identity_verified,
  CASE WHEN c.c_custkey % 29 = 0 THEN 'N/A' ELSE n.n_name END AS neighbourhood,
  CASE WHEN c.c_custkey % 41 = 0 THEN NULL ELSE n.n_nationkey + c.c_custkey / 1e5 END AS latitude,
  c.c_custkey / 5e4 - n.n_nationkey AS longitude,
  CASE WHEN c.c_custkey % 23 = 0 THEN NULL ELSE 'Entire ' || lower(c.c_mktsegment) END AS property_type,
  CASE WHEN c.c_custkey % 19 = 0 THEN ' nan ' ELSE c.c_mktsegment END AS room_type,
  CAST(1 + c.c_custkey % 8 AS INT) AS accommodates,
  CAST(1 + c.c_custkey % 3 AS INT) AS bathrooms,
  CAST(1 + c.c_custkey % 3 AS STRING) || ' baths' AS bathrooms_text,
  CAST(CASE WHEN c.c_custkey % 10 = 3 THEN NULL ELSE c.c_custkey % 5 END AS INT) AS bedrooms,
  CAST(CASE WHEN c.c_custkey % 10 = 7 THEN NULL ELSE c.c_custkey % 6 END AS INT) AS beds,
  CASE c.c_custkey % 4 WHEN 0 THEN NULL WHEN 1 THEN '[]' WHEN 2 THEN '["Wifi","King''s bed"]'
       ELSE '["Wifi","Desk","Shelf ' || CAST(c.c_custkey % 5 AS STRING) || '"]' END AS amenities,
  CASE WHEN c.version = 1 THEN 'N/A'
       WHEN c.c_custkey % 7 = 0 THEN 'n/a ' WHEN c.c_custkey % 11 = 0 THEN ' ' WHEN c.c_custkey % 17 = 0 THEN '1e3'
       WHEN c.c_acctbal >= 1000 THEN
         '$' || CAST(CAST(floor(c.c_acctbal / 1000) AS INT) AS STRING) || ',' ||
         lpad(CAST(CAST(floor(c.c_acctbal) AS INT) % 1000 AS STRING), 3, '0') || '.00'
       ELSE '$' || CAST(CAST(floor(c.c_acctbal) AS INT) AS STRING) || '.50' END AS price,
  CAST(1 + c.c_custkey % 4 AS INT) AS minimum_nights,
  CAST(30 + c.c_custkey % 300 AS INT) AS maximum_nights,
  CAST(1 + c.c_custkey % 4 AS INT) AS minimum_minimum_nights,
  CAST(2 + c.c_custkey % 4 AS INT) AS maximum_minimum_nights,
  CAST(30 + c.c_custkey % 300 AS INT) AS minimum_maximum_nights,
  CAST(31 + c.c_custkey % 300 AS INT) AS maximum_maximum_nights,
  CAST((c.c_custkey % 40) / 8e0 AS FLOAT) AS minimum_nights_avg_ntm,
  CAST(30 + (c.c_custkey % 40) / 8e0 AS FLOAT) AS maximum_nights_avg_ntm,
  CASE WHEN c.c_custkey % 2 = 0 THEN 't' ELSE 'f' END AS has_availability,
  CAST(CASE WHEN c.c_custkey % 14 = 0 THEN NULL ELSE c.c_custkey % 31 END AS INT) AS availability_30,
  CAST(c.c_custkey % 61 AS INT) AS availability_60,
  CAST(c.c_custkey % 91 AS INT) AS availability_90,
  CAST(CASE WHEN c.c_custkey % 15 = 0 THEN NULL ELSE (c.c_custkey * 7) % 366 END AS INT) AS availability_365,
  CAST('2024-01-' || lpad(CAST(1 + c.c_custkey % 28 AS STRING), 2, '0') AS TIMESTAMP) AS calendar_last_scraped,
  CAST(CASE WHEN c.c_custkey % 16 = 0 THEN NULL ELSE c.c_custkey % 16 END AS INT) AS number_of_reviews_ltm,
  CAST(c.c_custkey % 4 AS INT) AS number_of_reviews_l30d,
  CAST(c.c_custkey % 50 AS INT) AS availability_eoy,
  CAST(c.c_custkey % 20 AS INT) AS number_of_reviews_ly,
  CAST(CASE WHEN c.c_custkey % 12 = 0 THEN NULL ELSE o.n_orders * 17 END AS INT) AS estimated_occupancy_l365d,
  CAST(CASE WHEN c.c_custkey % 12 = 0 THEN NULL ELSE floor(o.cents / 4500) END AS INT) AS estimated_revenue_l365d,
  CAST('2019-01-01' AS TIMESTAMP) AS first_review,
  CAST(CASE WHEN c.c_custkey % 3 = 0 THEN NULL ELSE '2024-01-01' END AS TIMESTAMP) AS last_review,
  CAST((c.c_custkey % 64) / 8e0 - 1 AS FLOAT) AS review_scores_rating,
  CAST(NULL AS STRING) AS license,
  CASE WHEN c.c_custkey % 5 = 0 THEN 'Y' ELSE 'false' END AS instant_bookable,
  CAST(c.c_custkey % 5 AS INT) AS calculated_host_listings_count,
  CAST(c.c_custkey % 3 AS INT) AS calculated_host_listings_count_entire_homes,
  CAST(c.c_custkey % 2 AS INT) AS calculated_host_listings_count_private_rooms,
  CAST(0 AS INT) AS calculated_host_listings_count_shared_rooms,
  r.r_name AS city,
  'Country ' || CAST(r.r_regionkey AS STRING) AS country,
  CASE WHEN c.version = 0 THEN TIMESTAMP '2024-02-02 00:00:00'
       ELSE TIMESTAMP '2024-02-01 00:00:00' END AS ingestion_ts
FROM (SELECT *, 0 AS version FROM customer
      UNION ALL SELECT *, 1 AS version FROM customer WHERE c_acctbal <= 0) c
JOIN nation n ON c.c_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey
LEFT JOIN (SELECT o_custkey, count(*) AS n_orders,
                  CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS cents
           FROM orders GROUP BY o_custkey) o ON c.c_custkey = o.o_custkey
"""

REVIEW_FEED = """
SELECT
  CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE o_custkey END AS listing_id,
  o_orderkey AS id,
  CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE CAST(o_orderdate AS TIMESTAMP) END AS date,
  CASE WHEN o_orderkey % 23 = 0 THEN NULL ELSE (o_custkey + 3 * copy) % 400 END AS reviewer_id,
  CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE ' Guest ' || CAST(o_custkey % 400 AS STRING) || ' ' END AS reviewer_name,
  CASE WHEN o_orderkey % 9 = 0 THEN NULL
       ELSE CASE copy WHEN 0 THEN '  great   stay ' ELSE ' an older  text ' END || o_orderpriority || '  ' END AS comments,
  CASE o_orderkey % 5 WHEN 0 THEN NULL WHEN 1 THEN ' EN ' ELSE 'de' END AS language,
  CAST(CASE o_orderkey % 6 WHEN 0 THEN NULL WHEN 1 THEN CAST('NaN' AS DOUBLE)
       ELSE (o_orderkey % 16) / 16e0 END AS FLOAT) AS sentiment_score,
  CASE o_orderkey % 4 WHEN 0 THEN NULL WHEN 1 THEN '[]' WHEN 2 THEN '[" Positive "]'
       ELSE '["Mixed"," CALM"]' END AS sentiment_label,
  CAST(CASE WHEN o_orderkey % 8 = 0 THEN NULL ELSE o_orderkey % 8 END AS INT) AS likes_votes,
  CASE WHEN o_orderkey % 22 = 0 THEN NULL
       ELSE CAST(o_orderdate AS TIMESTAMP) + INTERVAL '1' HOUR END AS event_ingestion_time,
  CASE WHEN copy = 0 THEN TIMESTAMP '2024-02-02 00:00:00' ELSE TIMESTAMP '2024-02-01 00:00:00' END AS ingestion_ts
FROM (SELECT *, 0 AS copy FROM orders
      UNION ALL SELECT *, 1 AS copy FROM orders WHERE o_orderstatus = 'P') o
"""

ADS_FEED = """
SELECT
  s.s_suppkey AS id,
  CASE s.s_suppkey % 9 WHEN 0 THEN ' NaN ' WHEN 1 THEN NULL ELSE ' ' || s.s_name || ' ' END AS name,
  CAST(CASE WHEN s.s_suppkey % 6 = 0 THEN NULL
       ELSE a.discounts / (1e2 * a.clicks) END AS FLOAT) AS avg_conversion_rate,
  CAST(CASE WHEN s.s_suppkey % 7 = 0 THEN NULL ELSE s.s_suppkey % 50 END AS INT) AS post_amount,
  a.impressions AS total_impressions,
  a.clicks AS total_clicks,
  CAST(a.clicks / (1e0 * a.impressions) AS FLOAT) AS ctr,
  CAST(a.spend_cents / 1e2 AS FLOAT) AS total_ad_spend,
  CAST(CASE WHEN s.s_suppkey % 5 = 0 THEN NULL ELSE (s.s_suppkey % 32) / 8e0 END AS FLOAT) AS return_on_investment,
  CASE s.s_suppkey % 4 WHEN 0 THEN ' ' WHEN 1 THEN NULL ELSE n.n_name END AS region_coverage,
  CAST((s.s_suppkey % 16) / 16e0 AS FLOAT) AS churn_rate_provider,
  CAST((s.s_suppkey % 64) / 16e0 AS FLOAT) AS avg_cpc,
  CAST(NULL AS FLOAT) AS avg_cpm,
  CAST(CASE WHEN s.s_suppkey % 10 = 0 THEN NULL WHEN s.s_suppkey % 10 = 1 THEN 0 ELSE a.campaigns END AS INT)
    AS concurrent_campaigns_count,
  CASE WHEN s.s_suppkey % 3 = 0 THEN NULL ELSE ' GDPR ' END AS data_compliance_level,
  CASE WHEN s.s_suppkey % 8 = 0 THEN NULL ELSE TIMESTAMP '2024-01-14 00:00:00' END AS partition_date,
  CASE WHEN s.s_suppkey % 13 = 0 THEN NULL
       ELSE CAST('2024-01-' || lpad(CAST(10 + s.s_suppkey % 11 AS STRING), 2, '0') AS TIMESTAMP) END AS last_updated,
  CAST(NULL AS TIMESTAMP) AS ingestion_ts
FROM supplier s
JOIN nation n ON s.s_nationkey = n.n_nationkey
LEFT JOIN (SELECT l_suppkey, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS impressions, count(*) AS clicks,
             CAST(sum(CAST(round(l_discount * 100) AS BIGINT)) AS BIGINT) AS discounts,
             CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS spend_cents,
             count(DISTINCT l_orderkey) AS campaigns
      FROM lineitem GROUP BY l_suppkey) a ON s.s_suppkey = a.l_suppkey
"""

EVENT_FEED = """
SELECT
  CAST(event_id AS STRING) AS id,
  CASE WHEN event_id % 19 = 0 THEN '' ELSE CAST(user_id AS STRING) END AS listing_id,
  CASE WHEN event_id % 29 = 0 THEN '12x' ELSE CAST(user_id AS STRING) END AS reviewer_id,
  CAST(CAST(ts AS DATE) AS STRING) AS date,
  event_type AS reviewer_name,
  CASE WHEN event_id % 3 = 0 THEN '' ELSE 'nice ' || event_type END AS comments,
  'also ' || event_type AS comment,
  'en' AS language,
  CASE event_id % 5 WHEN 0 THEN '' WHEN 1 THEN NULL ELSE CAST(CAST(floor(value) AS INT) AS STRING) || '.25' END AS sentiment_score,
  CASE event_id % 4 WHEN 0 THEN '["a"," b ",""]' WHEN 1 THEN 'x, y ,,' WHEN 2 THEN '' ELSE NULL END AS sentiment_label,
  CASE WHEN event_id % 6 = 0 THEN NULL ELSE CAST(event_id % 6 AS STRING) END AS likes_votes,
  '7' AS likes_count,
  CASE event_id % 9 WHEN 0 THEN '2024-01-05T10:00:00Z' WHEN 1 THEN '2024-01-05 10:00:00.250'
       WHEN 2 THEN 'yesterday' WHEN 3 THEN '' WHEN 4 THEN NULL WHEN 5 THEN '12:30' WHEN 6 THEN '2024'
       WHEN 7 THEN '2024-01-05' ELSE '2024-01-05T10:00:00+02:00' END AS event_ingestion_time,
  CASE event_id % 5 WHEN 0 THEN 't' WHEN 1 THEN ' Yes ' WHEN 2 THEN '' WHEN 3 THEN NULL ELSE '1' END AS contains_media
FROM events
"""

MESSAGE_FEED = """
SELECT event_id,
  CASE event_id % 9
    WHEN 0 THEN '{"payload":' || body || '}'
    WHEN 1 THEN '{"payload":"' || replace(body, '"', chr(92) || '"') || '"}'
    WHEN 2 THEN '[' || body || ']'
    WHEN 3 THEN 'zz ' || body
    WHEN 4 THEN NULL
    WHEN 5 THEN '{"payload":[' || body || ']}'
    WHEN 6 THEN '{"payload":5,' || substring(body, 2)
    ELSE body END AS value,
  CAST(ts AS TIMESTAMP) AS received_at
FROM (SELECT event_id, ts,
        '{"id":' || CAST(event_id AS STRING) ||
        ',"listing_id":' || CASE WHEN event_id % 10 = 0 THEN '"x"' ELSE CAST(user_id % 50 AS STRING) END ||
        ',"reviewer_id":' || CAST(user_id AS STRING) ||
        ',"reviewer_name":' || CASE WHEN event_id % 12 = 0 THEN '7' ELSE '"' || event_type || '"' END ||
        ',"comments":"ok  then"' ||
        ',"likes_votes":' || CASE event_id % 8 WHEN 0 THEN '3000000000' WHEN 1 THEN '1.5' WHEN 2 THEN 'null'
                                  ELSE CAST(event_id % 8 AS STRING) END ||
        ',"contains_media":' || CASE WHEN event_id % 7 = 0 THEN '"true"' ELSE 'true' END ||
        ',"date":"' || CAST(CAST(ts AS DATE) AS STRING) || '"}' AS body
      FROM events) e
"""

FEEDS = {
    "listing_feed": LISTING_FEED,
    "review_feed": REVIEW_FEED,
    "ads_feed": ADS_FEED,
    "event_feed": EVENT_FEED,
    "message_feed": MESSAGE_FEED,
}
