"""Joins, aggregations, windows, top-k and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylens.catalog.registry import Tables, flat, query, time_text
from staylens.catalog.twins import NOW, as_double, flat as flat_sql, is_missing, price, title_sql
from staylens.functions import numbers
from staylens.operators import profile
from staylens.operators.dedupe import dedupe_latest
from staylens.operators.history import event_history
from staylens.operators.quantiles import exact_quantiles, lower_median
from staylens.operators.sketches import Sketches
from staylens.operators.skew import heavy_keys, salted_left_join
from staylens.plans import gold, questions, silver_listings
from staylens.sources.files import union_files
from staylens.sources.sinks import write_table

# --- joins ------------------------------------------------------------------------


@query(
    "join_left_1to1",
    """
    SELECT d.id AS listing_id, d.host_name, d.room_type, m.host_response_time, m.host_acceptance_rate
    FROM host_details d LEFT JOIN host_metrics m ON d.id = m.id
    """,
)
def join_left_1to1(t: Tables) -> DataFrame:
    joined = gold.join_listings(t.base("HostDetails"), t.base("HostMetrics"))
    return joined.select("listing_id", "host_name", "room_type", "host_response_time", "host_acceptance_rate")


@query(
    "join_left_chain",
    """
    SELECT r.id AS listing_id, r.estimated_revenue_l365d, m.host_acceptance_rate, d.host_total_listings_count
    FROM rent_metrics r LEFT JOIN host_metrics m ON r.id = m.id LEFT JOIN host_details d ON r.id = d.id
    """,
)
def join_left_chain(t: Tables) -> DataFrame:
    joined = gold.join_listings(t.base("RentMetrics"), t.base("HostMetrics"), t.base("HostDetails"))
    return joined.select(
        "listing_id", "estimated_revenue_l365d", "host_acceptance_rate", "host_total_listings_count"
    )


@query(
    "join_left_to_aggregate",
    """
    SELECT r.id, r.listing_id, s.number_of_reviews_ltm
    FROM silver_review r LEFT JOIN review_stats s ON r.listing_id = s.listing_id
    """,
)
def join_left_to_aggregate(t: Tables) -> DataFrame:
    reviews = t.silver_review.select("id", "listing_id")
    counts = t.stats.select("listing_id", "number_of_reviews_ltm")
    return salted_left_join(reviews, counts, ["listing_id"], spread=[F.col("id")])


@query(
    "join_wide_listing",
    """
    SELECT listing_id, city, neighbourhood, round(CAST(price_per_night AS DOUBLE), 3) AS price_per_night,
      estimated_revenue_l365d, availability_365, number_of_reviews_ltm,
      round(avg_sentiment_score, 6) AS avg_sentiment_score
    FROM neighbourhood_base
    """,
)
def join_wide_listing(t: Tables) -> DataFrame:
    return t.neighbourhood_base.select(
        "listing_id",
        "city",
        "neighbourhood",
        F.round(F.col("price_per_night").cast("double"), 3).alias("price_per_night"),
        "estimated_revenue_l365d",
        "availability_365",
        "number_of_reviews_ltm",
        F.round("avg_sentiment_score", 6).alias("avg_sentiment_score"),
    )


@query(
    "join_left_provider",
    "SELECT id AS provider_id, name, campaigns_count, total_clicks FROM ads_clean",
)
def join_left_provider(t: Tables) -> DataFrame:
    return t.provider_facts.select("provider_id", "name", "campaigns_count", "total_clicks")


@query(
    "join_inner_clean_raw",
    f"""
    SELECT id, price AS raw_price, coalesce({price()}, 0.0) AS price,
      host_response_rate AS raw_rate, coalesce({as_double('host_response_rate', '%')}, 0.0) AS host_response_rate
    FROM listing_feed
    """,
)
def join_inner_clean_raw(t: Tables) -> DataFrame:
    cleaned = silver_listings.clean_listings(
        profile.keep_raw(t.listing_feed, silver_listings.PROFILED_COLUMNS)
    )
    return cleaned.select(
        "id",
        F.col("raw.price").alias("raw_price"),
        "price",
        F.col("raw.host_response_rate").alias("raw_rate"),
        "host_response_rate",
    )


@query(
    "join_inner_geo",
    """
    SELECT location_key, city, neighbourhood, latitude, longitude, id, estimated_revenue_l365d,
      estimated_occupancy_l365d, CAST(price_per_night AS DOUBLE) AS price_per_night
    FROM located
    """,
)
def join_inner_geo(t: Tables) -> DataFrame:
    return t.located.withColumn("price_per_night", F.col("price_per_night").cast("double"))


# --- aggregations -----------------------------------------------------------------


@query("agg_review_count", "SELECT listing_id, number_of_reviews_ltm FROM review_stats")
def agg_review_count(t: Tables) -> DataFrame:
    return t.stats.select("listing_id", "number_of_reviews_ltm")


@query(
    "agg_review_count_since",
    """
    SELECT listing_id, CAST(count(CASE WHEN date >= TIMESTAMP '1998-01-01' THEN 1 END) AS INTEGER)
      AS number_of_reviews_ltm
    FROM silver_review GROUP BY listing_id
    """,
)
def agg_review_count_since(t: Tables) -> DataFrame:
    stats = gold.review_stats(t.silver_review, since="1998-01-01")
    return stats.select("listing_id", "number_of_reviews_ltm")


@query(
    "agg_avg_sentiment",
    "SELECT listing_id, round(avg_sentiment_score, 6) AS avg_sentiment_score FROM review_stats",
)
def agg_avg_sentiment(t: Tables) -> DataFrame:
    score = F.round("avg_sentiment_score", 6).alias("avg_sentiment_score")
    return t.stats.select("listing_id", score)


PERFORMANCE_SQL = f"""
SELECT neighbourhood, CAST(count(DISTINCT listing_id) AS INTEGER) AS total_active_listings,
  avg(CAST(price_per_night AS DOUBLE)) AS avg_price_per_night, avg(estimated_revenue_l365d) AS avg_annual_revenue,
  avg(estimated_occupancy_l365d) AS avg_occupancy_rate,
  CAST(sum(coalesce(number_of_reviews_ltm, 0)) AS BIGINT) AS total_reviews_ltm, {NOW} AS ingestion_ts
FROM neighbourhood_base GROUP BY neighbourhood
"""


@query(
    "agg_neighbourhood_performance",
    f"SELECT {flat_sql('AggNeighborhoodPerformance')} FROM ({PERFORMANCE_SQL})",
)
def agg_neighbourhood_performance(t: Tables) -> DataFrame:
    return flat(gold.neighbourhood_performance(t.neighbourhood_base, t.as_of))


ECONOMICS_SQL = f"""
SELECT d.room_type, CAST(count(DISTINCT d.id) AS INTEGER) AS total_listings,
  avg(CAST(r.price_per_night AS DOUBLE)) AS avg_price_per_night, avg(r.estimated_revenue_l365d) AS avg_annual_revenue,
  avg(m.host_acceptance_rate) AS avg_acceptance_rate, avg(CAST(m.host_response_rate AS DOUBLE)) AS avg_response_rate,
  {NOW} AS ingestion_ts
FROM host_details d LEFT JOIN rent_metrics r ON d.id = r.id LEFT JOIN host_metrics m ON d.id = m.id
GROUP BY d.room_type
"""


@query("agg_host_economics", f"SELECT {flat_sql('AggHostEconomics')} FROM ({ECONOMICS_SQL})")
def agg_host_economics(t: Tables) -> DataFrame:
    joined = gold.join_listings(t.base("HostDetails"), t.base("RentMetrics"), t.base("HostMetrics"))
    return flat(gold.host_economics(joined, t.as_of))


@query("agg_neighbourhood_invest", f"SELECT {flat_sql('AggNeighbourhoodInvest')} FROM invest")
def agg_neighbourhood_invest(t: Tables) -> DataFrame:
    return flat(t.invest)


@query(
    "agg_median_approx",
    """
    SELECT neighbourhood, quantile_disc(availability_365, 0.5) AS median_availability
    FROM neighbourhood_base GROUP BY neighbourhood
    """,
)
def agg_median_approx(t: Tables) -> DataFrame:
    median = lower_median("availability_365").cast("int").alias("median_availability")
    return t.neighbourhood_base.groupBy("neighbourhood").agg(median)


@query(
    "agg_count_distinct",
    "SELECT reviewer_id, count(DISTINCT listing_id) AS listings FROM review_feed GROUP BY reviewer_id",
)
def agg_count_distinct(t: Tables) -> DataFrame:
    return t.review_feed.groupBy("reviewer_id").agg(F.countDistinct("listing_id").alias("listings"))


LINE_SKETCHES = Sketches({"orders": "l_orderkey", "parts": "l_partkey"}, {"price": "l_extendedprice"})


def _line_sketches(t: Tables) -> DataFrame:
    """Per return flag, merged from finer groups and then with the later lines of the orders."""
    lines, fine = t.table("lineitem"), ["l_returnflag", "l_linestatus", "l_linenumber"]
    early, late = (LINE_SKETCHES.of(lines.filter(part), fine) for part in ("l_linenumber <= 2", "l_linenumber > 2"))
    flags = LINE_SKETCHES.rolled_up(early, ["l_returnflag"])
    return LINE_SKETCHES.merged(flags, LINE_SKETCHES.rolled_up(late, ["l_returnflag"]), ["l_returnflag"])


@query(
    "agg_count_distinct_sketch",
    """
    SELECT l_returnflag, count(DISTINCT l_orderkey) AS orders, count(DISTINCT l_partkey) AS parts, count(*) AS n_rows, true AS orders_within, true AS parts_within
    FROM lineitem GROUP BY l_returnflag
    """,
)
def agg_count_distinct_sketch(t: Tables) -> DataFrame:
    """Merged sketches next to the exact counts: within three standard errors, which is 5 %."""
    names = list(LINE_SKETCHES.distinct)
    exact = t.table("lineitem").groupBy("l_returnflag").agg(
        *[F.countDistinct(c).alias(n) for n, c in LINE_SKETCHES.distinct.items()]
    )
    found = LINE_SKETCHES.estimates(_line_sketches(t), {}).withColumnsRenamed({n: f"{n}_sketch" for n in names})
    within = {f"{n}_within": F.abs(F.col(f"{n}_sketch") - F.col(n)) <= 0.05 * F.col(n) for n in names}
    return exact.join(found, "l_returnflag").withColumns(within).drop(*[f"{n}_sketch" for n in names])


@query(
    "agg_median_sketch",
    """
    SELECT l_returnflag, rank, count(*) AS n_rows, true AS within
    FROM lineitem, (VALUES (5), (50), (95)) AS ranks(rank) GROUP BY l_returnflag, rank
    """,
)
def agg_median_sketch(t: Tables) -> DataFrame:
    """Quantiles from merged sketches: the share of rows below them is right to 2 % of all rows."""
    ranks = {f"q{p}": ("price", p / 100) for p in (5, 50, 95)}
    found = LINE_SKETCHES.estimates(_line_sketches(t), ranks).select("l_returnflag", *ranks)
    lines = t.table("lineitem").select("l_returnflag", F.col("l_extendedprice").cast("double").alias("price"))
    shares = []
    for name in ranks:
        shares += [F.avg((F.col("price") < F.col(name)).cast("int")).alias(f"below_{name}")]
        shares += [F.avg((F.col("price") <= F.col(name)).cast("int")).alias(f"upto_{name}")]
    # A row per return flag: without the broadcast all lines of a flag would meet in one task.
    seen = lines.join(F.broadcast(found), "l_returnflag").groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n_rows"), *shares)
    rows = [
        seen.select(
            "l_returnflag", F.lit(p).alias("rank"), "n_rows",
            ((F.col(f"below_q{p}") <= p / 100 + 0.02) & (F.col(f"upto_q{p}") >= p / 100 - 0.02)).alias("within"),
        )
        for p in (5, 50, 95)
    ]
    return union_files(rows)


QUANTILE_SQL = """
SELECT l_returnflag, round(quantile_cont(l_extendedprice, 0.25), 4) AS price_q25,
  round(quantile_cont(l_quantity, 0.8), 4) AS quantity_q80
FROM lineitem GROUP BY l_returnflag
"""


@query("agg_quantile_exact", QUANTILE_SQL)
def agg_quantile_exact(t: Tables) -> DataFrame:
    return _line_quantiles(t.table("lineitem"))


@query("agg_quantile_exact_skewed", QUANTILE_SQL)
def agg_quantile_exact_skewed(t: Tables) -> DataFrame:
    """The same with the frequent return flags taken as heavy."""
    lines = t.table("lineitem")
    return _line_quantiles(lines, heavy_keys(lines, ["l_returnflag"], share=0.3, min_rows=1))


def _line_quantiles(lines: DataFrame, heavy: DataFrame | None = None) -> DataFrame:
    limits = exact_quantiles(
        lines,
        ["l_returnflag"],
        {"price_q25": (F.col("l_extendedprice"), 0.25), "quantity_q80": (F.col("l_quantity"), 0.8)},
        heavy,
    )
    return limits.select(
        "l_returnflag",
        F.round("price_q25", 4).alias("price_q25"),
        F.round("quantity_q80", 4).alias("quantity_q80"),
    )


CITY_KPIS_SQL = """
SELECT city_name, CAST(sum(coalesce(neighbourhood_most_views, 0)) AS BIGINT) AS active_listings,
  CAST(sum(coalesce(neighbourhood_most_bookings, 0)) AS BIGINT) AS bookings,
  round(avg(CAST(coalesce(avg_order_price, 0) AS DOUBLE)), 3) AS avg_price,
  round(sum(CAST(coalesce(avg_revenue_l365d, 0) AS DOUBLE) * coalesce(neighbourhood_most_views, 0)), 1) AS total_revenue,
  round(avg(CAST(coalesce(avg_response_rate, 0) AS DOUBLE)), 3) AS avg_response,
  median(CAST(coalesce(median_availability, 0) AS DOUBLE)) AS median_availability
FROM invest GROUP BY city_name
"""


@query("agg_city_kpis", CITY_KPIS_SQL)
def agg_city_kpis(t: Tables) -> DataFrame:
    kpis = questions.city_kpis(t.invest)
    return kpis.withColumns(
        {
            "avg_price": F.round("avg_price", 3),
            "total_revenue": F.round("total_revenue", 1),
            "avg_response": F.round("avg_response", 3),
        }
    )


@query(
    "agg_promotion_kpis",
    """
    SELECT round(avg(CAST(coalesce(provider_conversion_rate, 0) AS DOUBLE)), 5) AS avg_conversion,
      round(sum(CAST(coalesce(avg_campaign_cost, 0) AS DOUBLE)), 2) AS total_spend,
      CAST(sum(coalesce(customer_gained, 0)) AS BIGINT) AS total_customers, count(*) AS provider_count
    FROM agg_ads
    """,
)
def agg_promotion_kpis(t: Tables) -> DataFrame:
    kpis = questions.promotion_kpis(t.agg_ads)
    return kpis.withColumns(
        {"avg_conversion": F.round("avg_conversion", 5), "total_spend": F.round("total_spend", 2)}
    )


@query(
    "agg_distinct_cities",
    "SELECT DISTINCT trim(city_name) AS city FROM invest WHERE trim(city_name) <> '' ORDER BY city",
)
def agg_distinct_cities(t: Tables) -> DataFrame:
    return questions.cities(t.invest)


@query(
    "dedupe_latest",
    """
    SELECT id, price, strftime(ingestion_ts, '%Y-%m-%d %H:%M:%S') AS ingestion_ts FROM listing_feed
    QUALIFY row_number() OVER (PARTITION BY id ORDER BY listing_feed.ingestion_ts DESC) = 1
    """,
)
def dedupe(t: Tables) -> DataFrame:
    latest = dedupe_latest(t.listing_feed.select("id", "price", "ingestion_ts"), ["id"])
    return latest.select("id", "price", time_text("ingestion_ts").alias("ingestion_ts"))


PROFILED = silver_listings.PROFILED_COLUMNS


@query(
    "profile_null_counts",
    "SELECT count(*) AS total_rows, "
    + ", ".join(f"count(*) - count({c}) AS {c}_nulls" for c in PROFILED)
    + " FROM listing_clean",
)
def profile_null_counts(t: Tables) -> DataFrame:
    return profile.null_counts(t.clean_listings, PROFILED)


@query(
    "profile_transform_nulls",
    "SELECT "
    + ", ".join(
        f"count(CASE WHEN NOT {is_missing(f'CAST(r.{c} AS VARCHAR)')} AND c.{c} IS NULL THEN 1 END) AS {c}_transform_nulls"
        for c in PROFILED
    )
    + """
    FROM listing_feed r JOIN listing_clean c ON r.id = c.id AND r.ingestion_ts = c.ingestion_ts
    """,
)
def profile_transform_nulls(t: Tables) -> DataFrame:
    cleaned = silver_listings.clean_listings(profile.keep_raw(t.listing_feed, PROFILED))
    return profile.transform_null_counts(cleaned, PROFILED)


@query(
    "row_count_gate",
    "SELECT id, reviewer_id FROM review_feed WHERE id IS NOT NULL AND reviewer_id IS NOT NULL",
)
def row_count_gate(t: Tables) -> DataFrame:
    rows = t.review_feed.dropna(subset=["id", "reviewer_id"]).select("id", "reviewer_id")
    return profile.require_rows(rows, "reviews")


# --- windows ----------------------------------------------------------------------

EVENT_HISTORY_SQL = """
SELECT id, reviewer_id, strftime(date, '%Y-%m-%d %H:%M:%S') AS start_date,
  strftime(lead(date) OVER w, '%Y-%m-%d %H:%M:%S') AS end_date, lead(date) OVER w IS NULL AS is_current
FROM (SELECT event_id AS id, user_id AS reviewer_id, date_trunc('hour', CAST(ts AS TIMESTAMP)) AS date FROM events)
WINDOW w AS (PARTITION BY reviewer_id ORDER BY date, id)
"""


def _events(t: Tables) -> DataFrame:
    return t.table("events").select(
        F.col("event_id").alias("id"),
        F.col("user_id").alias("reviewer_id"),
        F.date_trunc("hour", F.col("ts").cast("timestamp")).alias("date"),
    )


def _shown_history(df: DataFrame) -> DataFrame:
    return df.select(
        "id",
        "reviewer_id",
        time_text("start_date").alias("start_date"),
        time_text("end_date").alias("end_date"),
        "is_current",
    )


@query("scd2_event_history", EVENT_HISTORY_SQL)
def scd2_event_history(t: Tables) -> DataFrame:
    return _shown_history(event_history(_events(t)))


@query("scd2_event_history_skewed", EVENT_HISTORY_SQL)
def scd2_event_history_skewed(t: Tables) -> DataFrame:
    """The same history with every reviewer who has an above-average share taken as heavy."""
    events = _events(t)
    heavy = heavy_keys(events, ["reviewer_id"], share=1 / 150, min_rows=1)
    return _shown_history(event_history(events, heavy=heavy))


PREMIUM_SQL = """
SELECT l.id AS listing_id, l.neighbourhood, coalesce(r.price_per_night > quantile_cont(CAST(r.price_per_night AS DOUBLE), 0.8)
  OVER (PARTITION BY l.neighbourhood), false) AS is_premium_target
FROM rent_details d LEFT JOIN location l ON d.id = l.id LEFT JOIN rent_metrics r ON d.id = r.id
"""


def _premium_base(t: Tables) -> DataFrame:
    names = ("RentDetails", "RentMetrics", "HostMetrics", "HostDetails", "Location")
    return gold.join_listings(*[t.base(n) for n in names])


def _heavy_neighbourhoods(t: Tables) -> DataFrame:
    return heavy_keys(t.listing_table("Location").select("neighbourhood"), ["neighbourhood"])


@query("premium_label", PREMIUM_SQL)
def premium_label(t: Tables) -> DataFrame:
    base = _premium_base(t)
    features = gold.premium_features(base, t.as_of, heavy=_heavy_neighbourhoods(t))
    places = t.base("Location").select("listing_id", "neighbourhood")
    return features.select(F.col("listing_key").alias("listing_id"), "is_premium_target").join(places, "listing_id")


FEATURES_SQL = f"""
SELECT d.id AS listing_key, d.id AS property_key, d.id AS location_key, d.id AS host_key, h.property_type,
  d.accommodates, d.bedrooms, CAST(len(d.amenities) AS INTEGER) AS amenities_count, r.availability_30,
  m.host_acceptance_rate, m.host_response_time AS response_time_category, p.is_premium_target, d.ingestion_ts
FROM rent_details d JOIN ({PREMIUM_SQL}) p ON d.id = p.listing_id
LEFT JOIN rent_metrics r ON d.id = r.id LEFT JOIN host_metrics m ON d.id = m.id
LEFT JOIN host_details h ON d.id = h.id
"""


@query("ml_premium_features", f"SELECT {flat_sql('ml_feature_premium_pricing')} FROM ({FEATURES_SQL})")
def ml_premium_features(t: Tables) -> DataFrame:
    return flat(gold.premium_features(_premium_base(t), t.as_of, heavy=_heavy_neighbourhoods(t)))


# --- top-k ------------------------------------------------------------------------

CARDS_SQL = f"""
SELECT {title_sql('city_name')} AS city, neighbourhood_name AS neighbourhood,
  '$' || format('{{:,.0f}}', CAST(avg_revenue_l365d AS DOUBLE)) AS revenue,
  format('{{:,}}', neighbourhood_most_bookings) AS bookings, format('{{:,}}', neighbourhood_most_views) AS views,
  '$' || format('{{:,.0f}}', CAST(avg_order_price AS DOUBLE)) AS avg_price,
  format('{{:.1f}}', CAST(avg_response_rate AS DOUBLE)) || '%' AS response_rate,
  format('{{:,}}', CAST(floor(median_availability) AS BIGINT)) AS availability,
  array_to_string(neighbourhood_needed_boost, ', ') AS boost
FROM invest ORDER BY avg_revenue_l365d DESC NULLS LAST, city_name, neighbourhood_name LIMIT 6
"""


@query("topk_neighbourhood_cards", CARDS_SQL)
def topk_neighbourhood_cards(t: Tables) -> DataFrame:
    return questions.neighbourhood_cards(t.invest)


@query(
    "topk_revenue_chart",
    f"""
    SELECT {title_sql('city_name')} || ' · ' || neighbourhood_name AS label,
      round(CAST(coalesce(avg_revenue_l365d, 0) AS DOUBLE), 2) AS revenue,
      coalesce(neighbourhood_most_bookings, 0) AS bookings
    FROM invest ORDER BY avg_revenue_l365d DESC NULLS LAST, city_name, neighbourhood_name LIMIT 10
    """,
)
def topk_revenue_chart(t: Tables) -> DataFrame:
    return questions.revenue_chart(t.invest)


@query(
    "topk_city_bookings",
    """
    SELECT city_name, CAST(row_number() OVER w AS INTEGER) AS place,
      coalesce(neighbourhood_name, 'unknown') AS neighbourhood,
      coalesce(neighbourhood_most_views, 0) AS views, coalesce(neighbourhood_most_bookings, 0) AS bookings
    FROM invest
    WINDOW w AS (PARTITION BY city_name ORDER BY neighbourhood_most_bookings DESC NULLS LAST, neighbourhood_name)
    QUALIFY row_number() OVER w <= 12
    """,
)
def topk_city_bookings(t: Tables) -> DataFrame:
    return questions.city_bookings(t.invest)


RANKED_SQL = "FROM agg_ads ORDER BY provider_conversion_rate DESC NULLS LAST, provider_id LIMIT"
SHARE_SQL = "format('{:.2f}', CAST(provider_conversion_rate AS DOUBLE) * 100) || '%'"
COST_SQL = "'$' || format('{:,.0f}', CAST(avg_campaign_cost AS DOUBLE))"
PROVIDER_TABLE_SQL = f"""
SELECT provider_name AS name, {SHARE_SQL} AS conversion, format('{{:.4f}}', CAST(most_clicked_provider AS DOUBLE)) AS most_clicked,
  format('{{:,}}', customer_gained) AS customers, {COST_SQL} AS cost, format('{{:,}}', post_amount) AS posts
{RANKED_SQL} 20
"""


@query("topk_providers", PROVIDER_TABLE_SQL)
def topk_providers(t: Tables) -> DataFrame:
    return questions.provider_table(t.agg_ads)


@query(
    "topk_provider_cards",
    f"""
    SELECT provider_name AS name, {SHARE_SQL} AS conversion, format('{{:,}}', customer_gained) AS customers,
      {COST_SQL} AS cost, format('{{:,}}', post_amount) AS posts
    {RANKED_SQL} 3
    """,
)
def topk_provider_cards(t: Tables) -> DataFrame:
    return questions.provider_cards(t.agg_ads)


@query(
    "topk_provider_chart",
    f"""
    SELECT coalesce(provider_name, 'unknown') AS label,
      round(CAST(provider_conversion_rate AS DOUBLE) * 100, 2) AS conversion,
      round(CAST(avg_campaign_cost AS DOUBLE), 2) AS cost, customer_gained AS customers, post_amount AS posts
    {RANKED_SQL} 12
    """,
)
def topk_provider_chart(t: Tables) -> DataFrame:
    return questions.provider_chart(t.agg_ads)


@query(
    "limit_markers",
    """
    SELECT id, city, estimated_revenue_l365d FROM located
    ORDER BY coalesce(estimated_revenue_l365d, 0), id LIMIT 200
    """,
)
def limit_markers(t: Tables) -> DataFrame:
    poorest = numbers.or_zero(F.col("estimated_revenue_l365d"))
    return t.located.orderBy(poorest, "id").limit(questions.MARKERS).select("id", "city", "estimated_revenue_l365d")


@query("sample_preview", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 20")
def sample_preview(t: Tables) -> DataFrame:
    return t.table("orders").orderBy("o_orderkey").limit(20).select("o_orderkey", "o_custkey", "o_totalprice")


# --- set operations ---------------------------------------------------------------


@query(
    "union_city_files",
    """
    SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment FROM customer
    UNION ALL SELECT s_suppkey, s_name, NULL FROM supplier
    """,
)
def union_city_files(t: Tables) -> DataFrame:
    return union_files(
        [
            t.table("customer").selectExpr("c_custkey AS id", "c_name AS name", "c_mktsegment AS segment"),
            t.table("supplier").selectExpr("s_name AS name", "s_suppkey AS id"),
        ]
    )


@query("append_batches", "SELECT o_orderkey, o_orderstatus FROM orders")
def append_batches(t: Tables) -> DataFrame:
    target, orders = t.work("append_batches"), t.table("orders").select("o_orderkey", "o_orderstatus")
    write_table(orders.filter("o_orderstatus = 'F'"), target)
    write_table(orders.filter("o_orderstatus <> 'F'"), target, mode="append")
    return t.spark.read.parquet(target)
