"""Schema enforcement, filters and column functions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from staylens.catalog.registry import Tables, flat, query, time_text
from staylens.catalog.twins import (
    AS_OF,
    NOW,
    as_double,
    as_int,
    breaks,
    category,
    flat as flat_sql,
    is_missing,
    price,
    text_list,
    tf,
)
from staylens.functions import arrays, display, flags, numbers, text, times
from staylens.operators import schema_ops
from staylens.plans import gold, questions, silver_reviews
from staylens.sources.files import with_ingestion_ts, with_lineage
from staylens.streaming.messages import flatten_json


# --- schema enforcement -----------------------------------------------------------


@query(
    "cast_to_schema",
    """
    SELECT o_orderkey AS id, CAST(o_custkey AS VARCHAR) AS listing_id,
      TRY_CAST(CASE WHEN o_orderkey % 2 = 0 THEN '99999999999' ELSE '12' END AS INTEGER) AS likes_count,
      CAST(NULL AS VARCHAR) AS comment
    FROM orders
    """,
)
def cast_to_schema(t: Tables) -> DataFrame:
    schema = StructType.fromDDL("id BIGINT, listing_id STRING, likes_count INT, comment STRING")
    rows = t.table("orders").select(
        F.col("o_custkey").alias("listing_id"),
        F.when(F.col("o_orderkey") % 2 == 0, "99999999999").otherwise("12").alias("likes_count"),
        F.col("o_orderkey").alias("id"),
    )
    return schema_ops.cast_to_schema(rows, schema)


@query(
    "schema_map_project",
    """
    SELECT id AS listing_id, host_id AS host_profile_id, host_url AS host_profile_url,
      TRY_CAST(price AS DOUBLE) AS price_per_night, trim(host_name) AS shown_name
    FROM (SELECT id, host_id, host_url, host_name, CASE WHEN price = '1e3' THEN price END AS price
          FROM listing_feed)
    """,
)
def schema_map_project(t: Tables) -> DataFrame:
    schema = StructType.fromDDL(
        "listing_id BIGINT, host_profile_id STRING, host_profile_url STRING, "
        "price_per_night DOUBLE, shown_name STRING"
    )
    rows = t.listing_feed.withColumn("trimmed_name", F.trim("host_name"))
    rows = rows.withColumn("price", F.when(F.col("price") == "1e3", F.col("price")))
    return schema_ops.project_to(
        rows, schema, schema_ops.LISTING_RENAMES | {"shown_name": "trimmed_name"}
    )


@query("require_columns", "SELECT o_orderkey, o_custkey FROM orders")
def require_columns(t: Tables) -> DataFrame:
    wanted = ["o_orderkey", "o_custkey"]
    return schema_ops.require_columns(t.table("orders"), wanted).select(*wanted)


@query(
    "ensure_columns",
    "SELECT s_suppkey AS id, s_name AS name, CAST(NULL AS BIGINT) AS total_clicks FROM supplier",
)
def ensure_columns(t: Tables) -> DataFrame:
    schema = StructType.fromDDL("id BIGINT, name STRING, total_clicks BIGINT")
    rows = t.table("supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("title"))
    return schema_ops.ensure_columns(rows, schema, {"name": "title"}).select(
        "id", F.col("title").alias("name"), "total_clicks"
    )


@query(
    "json_struct_flatten",
    """
    SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k, CAST(NULL AS VARCHAR) AS note
    FROM events
    """,
)
def json_struct_flatten(t: Tables) -> DataFrame:
    schema = StructType.fromDDL("k INT, note STRING")
    return flatten_json(t.table("events").select("event_id", "props"), "props", schema)


@query(
    "json_parse_rows",
    f"""
    SELECT event_id, CASE WHEN event_id % 6 > 0 THEN CAST(json_extract(props, '$.k') AS INTEGER) END AS k,
      strftime(coalesce(CASE WHEN event_id % 6 > 3 THEN CAST(ts AS TIMESTAMP) END, {NOW}),
               '%Y-%m-%d %H:%M:%S') AS event_ingestion_time
    FROM events
    """,
)
def json_parse_rows(t: Tables) -> DataFrame:
    broken = F.when(F.col("event_id") % 6 > 0, F.col("props")).otherwise(
        F.concat(F.lit("zz "), "props")
    )
    rows = t.table("events").select(
        "event_id",
        broken.alias("value"),
        F.when(F.col("event_id") % 6 > 3, F.col("ts").cast("timestamp")).alias("event_ingestion_time"),
    )
    parsed = flatten_json(rows, "value", StructType.fromDDL("k INT"))
    received = times.clock(t.as_of)
    return parsed.select(
        "event_id",
        "k",
        F.date_format(F.coalesce("event_ingestion_time", received), "yyyy-MM-dd HH:mm:ss").alias(
            "event_ingestion_time"
        ),
    )


# --- filters ----------------------------------------------------------------------


@query(
    "not_null_filter",
    "SELECT id, reviewer_id FROM review_feed WHERE id IS NOT NULL AND reviewer_id IS NOT NULL",
)
def not_null_filter(t: Tables) -> DataFrame:
    return silver_reviews.clean_review_fields(t.review_feed, t.as_of).select("id", "reviewer_id")


@query(
    "missing_token_predicate",
    f"""
    SELECT id, host_name, {is_missing('host_name')} AS is_missing,
      {is_missing('host_name', "'n/a','na','null','none','nan'")} AS is_missing_name
    FROM listing_feed
    """,
)
def missing_token_predicate(t: Tables) -> DataFrame:
    name = F.col("host_name")
    return t.listing_feed.select(
        "id",
        "host_name",
        text.is_missing(name).alias("is_missing"),
        text.is_missing(name, text.MISSING_NAME_TOKENS).alias("is_missing_name"),
    )


@query(
    "late_window_filter",
    f"""
    SELECT event_id, user_id FROM events
    WHERE ts BETWEEN {NOW} - INTERVAL 48 HOURS AND {NOW} + INTERVAL 48 HOURS
    """,
)
def late_window_filter(t: Tables) -> DataFrame:
    moment = F.col("ts").cast("timestamp")
    return t.table("events").filter(times.in_late_window(moment, t.as_of)).select("event_id", "user_id")


@query(
    "city_filter",
    f"SELECT {flat_sql('AggNeighbourhoodInvest')} FROM invest WHERE lower(trim(city_name)) = 'asia'",
)
def city_filter(t: Tables) -> DataFrame:
    return flat(questions.in_city(t.invest, " Asia "))


@query(
    "city_filter_default",
    f"""
    SELECT {flat_sql('AggNeighbourhoodInvest')} FROM invest
    WHERE trim(city_name) = (SELECT min(trim(city_name)) FROM invest WHERE trim(city_name) <> '')
    """,
)
def city_filter_default(t: Tables) -> DataFrame:
    return flat(questions.in_city_or_first(t.invest))


@query(
    "city_filter_unknown",
    f"""
    SELECT {flat_sql('AggNeighbourhoodInvest')} FROM invest
    WHERE trim(city_name) = (SELECT min(trim(city_name)) FROM invest WHERE trim(city_name) <> '')
    """,
)
def city_filter_unknown(t: Tables) -> DataFrame:
    return flat(questions.in_city_or_first(t.invest, "Atlantis"))


@query(
    "underperformer_filter",
    """
    SELECT city, id, neighbourhood, latitude, longitude,
      estimated_revenue_l365d, estimated_occupancy_l365d
    FROM low_listings
    QUALIFY row_number() OVER (PARTITION BY city ORDER BY coalesce(estimated_revenue_l365d, 0), id) <= 200
    """,
)
def underperformer_filter(t: Tables) -> DataFrame:
    low = questions.underperformers(t.located, heavy=t.heavy_cities)
    return low.select(
        "city",
        "id",
        "neighbourhood",
        "latitude",
        "longitude",
        "estimated_revenue_l365d",
        "estimated_occupancy_l365d",
    )


@query(
    "range_sanity_null",
    """
    SELECT id, CASE WHEN review_scores_rating BETWEEN 0 AND 5 THEN CAST(review_scores_rating AS DOUBLE) END AS rating
    FROM listing_feed
    """,
)
def range_sanity_null(t: Tables) -> DataFrame:
    score = numbers.safe_double(F.col("review_scores_rating"))
    return t.listing_feed.select("id", numbers.within(score).alias("rating"))


@query("ads_metric_project", f"SELECT {flat_sql('AggAds')} FROM agg_ads")
def ads_metric_project(t: Tables) -> DataFrame:
    metrics = t.silver_ads["providerMetrics"].withColumnRenamed("id", "provider_key")
    named = metrics.join(t.silver_ads["providerDetails"].select(F.col("id").alias("provider_key"), "name"), "provider_key")
    return flat(gold.agg_ads(named, t.as_of))


# --- text -------------------------------------------------------------------------


@query("html_break_clean", f"SELECT page_id, {breaks('html')} AS text FROM pages")
def html_break_clean(t: Tables) -> DataFrame:
    return t.table("pages").select("page_id", text.html_breaks_to_blanks(F.col("html")).alias("text"))


@query(
    "text_fallback",
    """
    SELECT id, CASE WHEN coalesce(trim(neighborhood_overview), '') = '' THEN description
                    ELSE neighborhood_overview END AS overview
    FROM listing_feed
    """,
)
def text_fallback(t: Tables) -> DataFrame:
    overview = text.first_filled(F.col("neighborhood_overview"), F.col("description"))
    return t.listing_feed.select("id", overview.alias("overview"))


@query(
    "category_default",
    f"""
    SELECT id, {category('host_name', '')} AS host_name, {category('room_type', 'unkown')} AS room_type,
      {category('host_response_time', 'unknown', "'n/a','na','null','none'")} AS host_response_time
    FROM listing_feed
    """,
)
def category_default(t: Tables) -> DataFrame:
    return t.listing_feed.select(
        "id",
        text.category_or(F.col("host_name"), text.NO_NAME).alias("host_name"),
        text.category_or(F.col("room_type"), text.UNKNOWN_CATEGORY).alias("room_type"),
        text.category_or(F.col("host_response_time"), text.UNKNOWN, text.MISSING_TOKENS).alias("host_response_time"),
    )


@query(
    "text_normalize",
    r"""
    SELECT doc_id, trim(regexp_replace(replace(text, ' ', '  '), '\s+', ' ', 'g')) AS comment,
      lower(trim(lang)) AS language
    FROM documents
    """,
)
def text_normalize(t: Tables) -> DataFrame:
    spaced = F.replace(F.col("text"), F.lit(" "), F.lit("  "))
    return t.table("documents").select(
        "doc_id",
        text.squeeze_whitespace(spaced).alias("comment"),
        text.language_code(F.col("lang")).alias("language"),
    )


@query(
    "rename_event_fields",
    """
    SELECT id, coalesce(nullif(comments, ''), comment) AS comments,
      coalesce(nullif(likes_votes, ''), likes_count) AS likes_votes
    FROM event_feed
    """,
)
def rename_event_fields(t: Tables) -> DataFrame:
    return t.event_feed.select(
        "id",
        text.alias_fallback(F.col("comments"), F.col("comment")).alias("comments"),
        text.alias_fallback(F.col("likes_votes"), F.col("likes_count")).alias("likes_votes"),
    )


# --- numbers ----------------------------------------------------------------------


@query("price_normalize", f"SELECT id, price AS raw_price, {price()} AS price FROM listing_feed")
def price_normalize(t: Tables) -> DataFrame:
    return t.listing_feed.select(
        "id", F.col("price").alias("raw_price"), numbers.price_amount(F.col("price")).alias("price")
    )


@query(
    "safe_double",
    f"""
    SELECT id, {as_double('host_response_rate', '%')} AS rate, coalesce({as_double('price')}, 7.5) AS strict_price
    FROM listing_feed
    """,
)
def safe_double(t: Tables) -> DataFrame:
    return t.listing_feed.select(
        "id",
        numbers.safe_double(F.col("host_response_rate"), "%").alias("rate"),
        numbers.safe_double(F.col("price"), default=7.5).alias("strict_price"),
    )


@query(
    "safe_int",
    f"""
    SELECT id, {as_int('host_acceptance_rate', '%')} AS rate, coalesce({as_int('host_response_rate')}, -1) AS strict_rate
    FROM listing_feed
    """,
)
def safe_int(t: Tables) -> DataFrame:
    return t.listing_feed.select(
        "id",
        numbers.safe_int(F.col("host_acceptance_rate"), "%").alias("rate"),
        numbers.safe_int(F.col("host_response_rate"), default=-1).alias("strict_rate"),
    )


@query(
    "percent_normalize",
    f"""
    SELECT id, coalesce({as_double('host_response_rate', '%')}, 0.0) AS response,
      coalesce({as_int('host_acceptance_rate', '%')}, 0) AS acceptance
    FROM listing_feed
    """,
)
def percent_normalize(t: Tables) -> DataFrame:
    return t.listing_feed.select(
        "id",
        numbers.percent_double(F.col("host_response_rate")).alias("response"),
        numbers.percent_int(F.col("host_acceptance_rate")).alias("acceptance"),
    )


@query(
    "numeric_default",
    """
    SELECT id, coalesce(availability_30, 0) AS availability_30, coalesce(bedrooms, 0) AS bedrooms,
      coalesce(estimated_revenue_l365d, 0) AS revenue
    FROM listing_feed
    """,
)
def numeric_default(t: Tables) -> DataFrame:
    columns = ["availability_30", "bedrooms", "estimated_revenue_l365d"]
    zeros = t.listing_feed.withColumns({c: numbers.or_zero(F.col(c)) for c in columns})
    return zeros.select("id", *columns).withColumnRenamed("estimated_revenue_l365d", "revenue")


@query(
    "nan_default",
    """
    SELECT id, CASE WHEN sentiment_score IS NULL OR isnan(sentiment_score) THEN 1.0
                    ELSE CAST(sentiment_score AS DOUBLE) END AS score
    FROM review_feed
    """,
)
def nan_default(t: Tables) -> DataFrame:
    score = numbers.nan_to(F.col("sentiment_score")).cast("double")
    return t.review_feed.select("id", score.alias("score"))


@query(
    "sentinel_default",
    "SELECT id, coalesce(listing_id, -1) AS listing_id FROM review_feed WHERE id IS NOT NULL AND reviewer_id IS NOT NULL",
)
def sentinel_default(t: Tables) -> DataFrame:
    return silver_reviews.clean_review_fields(t.review_feed, t.as_of).select("id", "listing_id")


@query(
    "safe_ratio",
    """
    SELECT c_custkey, CASE WHEN c_acctbal > 0 THEN 1000.0 / c_acctbal ELSE 0.0 END AS ratio
    FROM customer
    """,
)
def safe_ratio(t: Tables) -> DataFrame:
    ratio = numbers.ratio_or_zero(F.lit(1000.0), F.col("c_acctbal"))
    return t.table("customer").select("c_custkey", ratio.alias("ratio"))


@query(
    "product_truncate",
    """
    SELECT o_orderkey, CAST(trunc(CAST(o_totalprice AS FLOAT) * CAST(0.37 AS FLOAT)) AS BIGINT) AS gained,
      CAST(trunc(CAST((o_orderkey % 100) / 1e2 AS FLOAT) * CAST(100 AS FLOAT)) AS INTEGER) AS pct
    FROM orders
    """,
)
def product_truncate(t: Tables) -> DataFrame:
    rate = (F.col("o_orderkey") % 100 / F.lit(100.0)).cast("float")
    return t.table("orders").select(
        "o_orderkey",
        numbers.whole_product(F.col("o_totalprice"), F.lit(0.37)).alias("gained"),
        numbers.whole_product(rate, F.lit(100), "int").alias("pct"),
    )


@query(
    "event_numeric_coerce",
    r"""
    SELECT id, TRY_CAST(nullif(listing_id, '') AS BIGINT) AS listing_id,
      CAST(TRY_CAST(nullif(sentiment_score, '') AS FLOAT) AS DOUBLE) AS sentiment_score,
      coalesce(reviewer_id, '') <> '' AND TRY_CAST(reviewer_id AS BIGINT) IS NULL AS rejected
    FROM event_feed
    """,
)
def event_numeric_coerce(t: Tables) -> DataFrame:
    reviewer = F.col("reviewer_id")
    return t.event_feed.select(
        "id",
        numbers.event_int(F.col("listing_id")).alias("listing_id"),
        numbers.event_float(F.col("sentiment_score")).cast("double").alias("sentiment_score"),
        numbers.is_unreadable(reviewer, numbers.event_int(reviewer)).alias("rejected"),
    )


# --- flags and times --------------------------------------------------------------


@query(
    "tf_bool",
    f"""
    SELECT id, {tf('host_is_superhost')} AS host_is_superhost, {tf('host_has_profile_pic')} AS host_has_profile_pic,
      {tf('host_identity_verified')} AS host_identity_verified, {tf('has_availability')} AS has_availability,
      {tf('instant_bookable')} AS instant_bookable
    FROM listing_feed
    """,
)
def tf_bool(t: Tables) -> DataFrame:
    columns = ("host_is_superhost", "host_has_profile_pic", "host_identity_verified",
               "has_availability", "instant_bookable")
    return t.listing_feed.select("id", *[flags.tf_flag(F.col(c)).alias(c) for c in columns])


@query(
    "event_bool",
    """
    SELECT id, lower(trim(nullif(contains_media, ''))) IN ('true', '1', 'yes', 'y') AS contains_media
    FROM event_feed
    """,
)
def event_bool(t: Tables) -> DataFrame:
    return t.event_feed.select("id", flags.event_flag(F.col("contains_media")).alias("contains_media"))


@query(
    "timestamp_normalize",
    """
    SELECT o_orderkey, strftime(CASE WHEN o_orderkey % 5 > 0 THEN o_orderdate END, '%Y-%m-%d %H:%M:%S') AS at
    FROM orders
    """,
)
def timestamp_normalize(t: Tables) -> DataFrame:
    shown = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    raw = F.when(F.col("o_orderkey") % 5 > 0, shown).otherwise(F.concat(shown, F.lit(" ?")))
    rows = t.table("orders").select("o_orderkey", times.timestamp_or_null(raw).alias("at"))
    return rows.select("o_orderkey", time_text("at").alias("at"))


@query(
    "iso_timestamp_normalize",
    """
    SELECT id, CASE event_ingestion_time
        WHEN '2024-01-05T10:00:00Z' THEN '2024-01-05T10:00:00+00:00'
        WHEN '2024-01-05 10:00:00.250' THEN '2024-01-05T10:00:00.250000+00:00'
        WHEN '2024-01-05T10:00:00+02:00' THEN '2024-01-05T08:00:00+00:00'
        WHEN '2024-01-05' THEN '2024-01-05T00:00:00+00:00'
        ELSE nullif(event_ingestion_time, '') END AS at
    FROM event_feed
    """,
)
def iso_timestamp_normalize(t: Tables) -> DataFrame:
    return t.event_feed.select("id", times.iso_text(F.col("event_ingestion_time")).alias("at"))


@query(
    "timestamp_fallback",
    f"""
    SELECT id, strftime(coalesce(date, event_ingestion_time, {NOW}), '%Y-%m-%d %H:%M:%S') AS date FROM review_feed
    """,
)
def timestamp_fallback(t: Tables) -> DataFrame:
    first = times.first_timestamp(F.col("date"), F.col("event_ingestion_time"), as_of=t.as_of)
    return t.review_feed.select("id", first.alias("date")).select("id", time_text("date").alias("date"))


# --- lists ------------------------------------------------------------------------


@query(
    "array_default",
    f"SELECT id, array_to_string(coalesce({text_list('amenities')}, []), '|') AS amenities FROM listing_feed",
)
def array_default(t: Tables) -> DataFrame:
    items = arrays.list_or_empty(F.col("amenities"))
    return t.listing_feed.select("id", F.array_join(items, "|").alias("amenities"))


@query(
    "array_parse",
    """
    SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN NULL WHEN 1 THEN ''
        WHEN 2 THEN p_type || '|' || p_brand ELSE 'King''s ' || p_type || '|' || p_brand END AS items,
      CASE p_partkey % 4 WHEN 0 THEN NULL WHEN 1 THEN 0 ELSE 2 END AS n
    FROM part
    """,
)
def array_parse(t: Tables) -> DataFrame:
    kind = F.col("p_partkey") % 4
    raw = (
        F.when(kind == 0, F.lit(" "))
        .when(kind == 1, F.lit("[]"))
        .when(kind == 2, F.concat(F.lit("['"), "p_type", F.lit("', '"), "p_brand", F.lit("']")))
        .otherwise(F.concat(F.lit('["King\'s '), "p_type", F.lit("\", '"), "p_brand", F.lit("']")))
    )
    items = arrays.list_from_text(raw)
    return t.table("part").select(
        "p_partkey", F.array_join(items, "|").alias("items"), F.size(items).alias("n")
    )


@query(
    "string_list_parse",
    """
    SELECT id, CASE sentiment_label WHEN '["a"," b ",""]' THEN 'a|b' WHEN 'x, y ,,' THEN 'x|y' END AS labels
    FROM event_feed
    """,
)
def string_list_parse(t: Tables) -> DataFrame:
    labels = arrays.list_from_loose_text(F.col("sentiment_label"))
    return t.event_feed.select("id", F.array_join(labels, "|").alias("labels"))


@query(
    "array_lower_trim",
    f"""
    SELECT id, CASE WHEN coalesce(len({text_list('sentiment_label')}), 0) = 0 THEN 'positive'
      ELSE array_to_string(list_transform({text_list('sentiment_label')}, lambda x: lower(trim(x))), '|') END AS labels
    FROM review_feed
    """,
)
def array_lower_trim(t: Tables) -> DataFrame:
    labels = arrays.labels_or_default(F.col("sentiment_label"))
    return t.review_feed.select("id", F.array_join(labels, "|").alias("labels"))


@query(
    "array_from_rule",
    """
    SELECT o_custkey, CASE WHEN avg(o_totalprice) > 250000 THEN 'low' ELSE 'high' END AS boost
    FROM orders GROUP BY o_custkey
    """,
)
def array_from_rule(t: Tables) -> DataFrame:
    averages = t.table("orders").groupBy("o_custkey").agg(F.avg("o_totalprice").alias("revenue"))
    boost = arrays.boost_level(F.col("revenue"), limit=250000)
    return averages.select("o_custkey", F.array_join(boost, "|").alias("boost"))


@query(
    "array_count",
    f"SELECT id, CAST(coalesce(len({text_list('amenities')}), 0) AS INTEGER) AS amenities_count FROM listing_feed",
)
def array_count(t: Tables) -> DataFrame:
    return t.listing_feed.select("id", arrays.list_size(F.col("amenities")).alias("amenities_count"))


# --- display ----------------------------------------------------------------------


@query(
    "display_format",
    """
    SELECT c_custkey, format('{:,}', CAST(round_even(c_acctbal, 0) AS BIGINT)) AS whole,
      '$' || format('{:,.0f}', c_acctbal) AS money,
      format('{:.2f}', (c_custkey % 64) / 64e0 * 100) || '%' AS share,
      format('{:.4f}', (c_custkey % 64) / 64e0) AS fixed,
      upper(c_mktsegment[1]) || lower(c_mktsegment[2:]) || ' · ' || c_name AS label
    FROM customer
    """,
)
def display_format(t: Tables) -> DataFrame:
    share = F.col("c_custkey") % 64 / F.lit(64.0)
    return t.table("customer").select(
        "c_custkey",
        display.thousands(F.col("c_acctbal")).alias("whole"),
        display.money(F.col("c_acctbal")).alias("money"),
        display.percent_of_fraction(share).alias("share"),
        display.fixed(share, 4).alias("fixed"),
        display.place_label(F.col("c_mktsegment"), F.col("c_name")).alias("label"),
    )


@query(
    "ingestion_stamp",
    f"SELECT o_orderkey, '{AS_OF}' AS ingestion_ts FROM orders",
)
def ingestion_stamp(t: Tables) -> DataFrame:
    rows = with_ingestion_ts(t.table("orders").select("o_orderkey"), t.as_of)
    return rows.select("o_orderkey", time_text("ingestion_ts").alias("ingestion_ts"))


@query(
    "file_lineage",
    """
    SELECT c_custkey,
      CASE WHEN c_custkey % 4 < 3 THEN split_part(stem, '_', -2) END AS city,
      CASE WHEN c_custkey % 4 < 3 THEN split_part(stem, '_', -1) END AS country
    FROM (SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'listings_' || lower(c_mktsegment) || '_usa'
            WHEN 1 THEN 'listings_new_' || lower(c_mktsegment) || '_usa'
            WHEN 2 THEN 'chicago_' || CAST(c_custkey AS VARCHAR) ELSE 'plain' END AS stem
          FROM customer)
    """,
)
def file_lineage(t: Tables) -> DataFrame:
    kind, segment = F.col("c_custkey") % 4, F.lower("c_mktsegment")
    path = (
        F.when(kind == 0, F.concat(F.lit("s3a://raw/a_b/listings_"), segment, F.lit("_usa.csv.gz")))
        .when(kind == 1, F.concat(F.lit("file:/raw/listings_new_"), segment, F.lit("_usa.csv")))
        .when(kind == 2, F.concat(F.lit("/raw/chicago_"), F.col("c_custkey").cast("string"), F.lit(".csv")))
        .otherwise(F.lit("/raw/x_y/plain.csv"))
    )
    return with_lineage(t.table("customer"), path).select("c_custkey", "city", "country")
