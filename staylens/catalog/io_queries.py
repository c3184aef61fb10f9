"""Sources and sinks, driven end to end over files Spark writes from the feeds."""

from __future__ import annotations

from contextlib import suppress

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from staylens import jobs
from staylens.catalog.registry import Tables, flat, query, time_text
from staylens.catalog.twins import NOW, flat as flat_sql
from staylens.operators.schema_ops import cast_to_schema
from staylens.plans import gold
from staylens.plans.silver_listings import silver_table
from staylens.schemas import BRONZE, LISTING_TABLES, schema_of, text_for_lists
from staylens.sources import landing
from staylens.sources.files import read_csv, read_optional, read_tables, union_files
from staylens.sources.sinks import TablesFailedError, review_messages, write_table, write_tables
from staylens.sources.versions import read_available


#: Rows of a feed's file, where it has more than its least number of files.
ROWS_PER_FILE = 100_000


def files_for(df: DataFrame, least: int) -> int:
    """``least`` or a multiple of it: the files of a feed grow in number, not in size."""
    return least * max(1, -(-df.count() // (least * ROWS_PER_FILE)))


def write_csv(t: Tables, df: DataFrame, table: str, files: int = 4) -> str:
    """A feed as CSV files, ``files`` or more, in the column order of its schema, lists as JSON text."""
    path = t.work(f"{table}_csv")
    typed = cast_to_schema(df, schema_of(table))
    lists = {f.name: F.to_json(f.name) for f in typed.schema if isinstance(f.dataType, ArrayType)}
    rows = typed.withColumns(lists) if lists else typed
    as_is = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    rows.repartition(files_for(df, files)).write.options(header=True, quote='"', escape='"', **as_is).csv(path)
    return path


ADS_COLUMNS = (
    "id", "name", "avg_conversion_rate", "post_amount", "total_impressions", "total_clicks", "region_coverage",
    "concurrent_campaigns_count", "last_updated", "partition_date",
)
ADS_SQL = """
id, name || chr(10) || '"x", y' AS name, round(CAST(avg_conversion_rate AS DOUBLE), 3) AS avg_conversion_rate,
post_amount, total_impressions, total_clicks, nullif(trim(region_coverage), '') AS region_coverage, concurrent_campaigns_count,
strftime(last_updated, '%Y-%m-%d %H:%M:%S') AS last_updated, strftime(partition_date, '%Y-%m-%d %H:%M:%S') AS partition_date
"""


def awkward_ads(t: Tables) -> DataFrame:
    """Provider rows whose name needs quoting: a line break, quotes and a comma."""
    return t.ads_feed.withColumns(
        {
            "name": F.concat("name", F.lit('\n"x", y')),
            "region_coverage": F.nullif(F.trim("region_coverage"), F.lit("")),
        }
    )


def shown_ads(df: DataFrame) -> DataFrame:
    return flat(df.select(*ADS_COLUMNS))


ADS_SHOWN_SQL = f"SELECT {ADS_SQL} FROM ads_feed"


@query("csv_batch_scan", ADS_SHOWN_SQL)
def csv_batch_scan(t: Tables) -> DataFrame:
    path = write_csv(t, awkward_ads(t), "adsProviders")
    return shown_ads(read_csv(t.spark, schema_of("adsProviders"), [path], t.as_of))


@query(
    "csv_array_schema",
    """
    SELECT id, CASE WHEN sentiment_label IS NULL THEN NULL WHEN sentiment_label = '[]' THEN '[]'
      WHEN sentiment_label = '[" Positive "]' THEN '[" Positive "]' ELSE '["Mixed"," CALM"]' END AS sentiment_label
    FROM review_feed
    """,
)
def csv_array_schema(t: Tables) -> DataFrame:
    path = write_csv(t, t.review_feed, "reviews")
    rows = t.spark.read.schema(text_for_lists(schema_of("reviews"))).options(header=True, quote='"', escape='"').csv(path)
    return rows.select("id", "sentiment_label")


@query("parquet_scan", "SELECT o_orderkey, o_totalprice FROM orders UNION ALL SELECT o_orderkey, o_totalprice FROM orders")
def parquet_scan(t: Tables) -> DataFrame:
    """A glob and a path as one frame, every row of both."""
    orders = read_tables(t.spark, f"{t.folder}/order*.parquet", f"{t.folder}/orders.parquet")
    return orders.select("o_orderkey", "o_totalprice")


@query("parquet_sink", "SELECT l_orderkey, l_linenumber, l_returnflag FROM lineitem")
def parquet_sink(t: Tables) -> DataFrame:
    path, columns = t.work("parquet_sink"), ["l_orderkey", "l_linenumber", "l_returnflag"]
    write_table(t.table("lineitem").select(*columns), path, partition_by=["l_returnflag"])
    return t.spark.read.parquet(path).select(*columns)


@query(
    "bronze_listing_landing",
    """
    SELECT id, name, price, amenities IS NULL AS no_amenities, CAST(coalesce(len(from_json(amenities, '["VARCHAR"]')), 0) AS INTEGER) AS n_amenities,
      strftime(TIMESTAMP '2024-01-15', '%Y-%m-%d %H:%M:%S') AS ingestion_ts
    FROM listing_feed
    """,
)
def bronze_listing_landing(t: Tables) -> DataFrame:
    path = write_csv(t, t.listing_feed, "listing", files=8)
    landed = landing.land_listings(t.spark, path, t.work("bronze_listing"), t.as_of)
    amenities = F.col("amenities")
    return landed.select(
        "id",
        "name",
        "price",
        amenities.isNull().alias("no_amenities"),
        F.size(F.coalesce(amenities, F.array().cast("array<string>"))).alias("n_amenities"),
        time_text("ingestion_ts").alias("ingestion_ts"),
    )


@query(
    "bronze_ads_landing",
    f"{ADS_SHOWN_SQL} WHERE last_updated BETWEEN {NOW} - INTERVAL 48 HOURS AND {NOW} + INTERVAL 48 HOURS",
)
def bronze_ads_landing(t: Tables) -> DataFrame:
    path = write_csv(t, awkward_ads(t), "adsProviders")
    return shown_ads(landing.land_ads(t.spark, path, t.work("bronze_ads"), t.as_of))


ON_TIME_SQL = f"last_updated BETWEEN {NOW} - INTERVAL 48 HOURS AND {NOW} + INTERVAL 48 HOURS"


@query("bronze_ads_landing_many_files", f"{ADS_SHOWN_SQL} WHERE {ON_TIME_SQL}")
def bronze_ads_landing_many_files(t: Tables) -> DataFrame:
    """Several deliveries in one run; one of them is not there."""
    even = F.col("id") % 2 == 0
    paths = [write_csv(t, awkward_ads(t).filter(part), "adsProviders") for part in (even, ~even)]
    return shown_ads(landing.land_ads(t.spark, [*paths, f"{paths[0]}-absent"], t.work("bronze_ads"), t.as_of))


@query("bronze_ads_rejected", f"{ADS_SHOWN_SQL} WHERE NOT coalesce({ON_TIME_SQL}, false)")
def bronze_ads_rejected(t: Tables) -> DataFrame:
    """Rows outside the late window are kept apart, undated ones as well."""
    path, late = write_csv(t, awkward_ads(t), "adsProviders"), t.work("late_ads")
    landing.land_ads(t.spark, path, t.work("bronze_ads"), t.as_of, late)
    return shown_ads(t.spark.read.parquet(late))


def write_broken_ads(t: Tables) -> str:
    """The ads feed as CSV files in which every fifth row has an unreadable number, and the one after too few fields."""
    names = schema_of("adsProviders").names
    columns = cast_to_schema(t.ads_feed, schema_of("adsProviders"))
    clicks, kind = F.col("total_clicks").cast("string"), F.pmod("id", F.lit(5))
    whole = F.to_csv(F.struct(*[F.when(kind == 0, "many").otherwise(clicks).alias(c) if c == "total_clicks" else c for c in names]))
    line = F.when(kind == 1, F.to_csv(F.struct("id", "name"))).otherwise(whole)
    rows = columns.select(line.alias("value"), F.pmod(F.xxhash64("id", "name"), F.lit(4)).alias("part"), F.lit(1).alias("at"))
    heads = t.spark.range(4).select(F.lit(",".join(names)).alias("value"), F.col("id").alias("part"), F.lit(0).alias("at"))
    path = t.work("broken_ads")
    lines = rows.unionByName(heads).repartition("part").sortWithinPartitions("part", "at")
    lines.select("value", "part").write.partitionBy("part").text(path)
    return f"{path}/part=*"


OUTCOMES_SQL = f"""
SELECT id, CASE WHEN id % 5 = 0 THEN 'unreadable: total_clicks' WHEN id % 5 = 1 THEN 'not {{fields}} fields'
  WHEN {ON_TIME_SQL} THEN 'on time' ELSE 'late' END AS outcome
FROM ads_feed
""".format(fields=len(BRONZE["adsProviders"].split(",")))


def ads_outcomes(t: Tables, on_time: str, late: str, malformed: str) -> DataFrame:
    """Where every row went, and why."""
    sides = [t.spark.read.parquet(p).select("id", F.lit(o).alias("outcome")) for p, o in ((on_time, "on time"), (late, "late"))]
    apart = t.spark.read.parquet(malformed)
    first = F.try_to_number(F.substring_index("line", ",", 1), F.lit("9999999999999")).cast("long")
    return union_files([*sides, apart.select(first.alias("id"), F.col("reason").alias("outcome"))])


@query("csv_batch_scan_malformed", OUTCOMES_SQL)
def csv_batch_scan_malformed(t: Tables) -> DataFrame:
    """Rows that do not fit the schema are kept apart with the reason."""
    places = [t.work(name) for name in ("bronze_ads", "late_ads", "malformed_ads")]
    landing.land_ads(t.spark, write_broken_ads(t), places[0], t.as_of, *places[1:])
    return ads_outcomes(t, *places)


@query("csv_stream_scan_malformed", OUTCOMES_SQL)
def csv_stream_scan_malformed(t: Tables) -> DataFrame:
    """The same as a stream of one file a batch."""
    on_time, late, malformed = (t.work(name) for name in ("streamed_ads", "late_ads", "malformed_ads"))
    jobs.stream_ads(t.spark, write_broken_ads(t), on_time, t.work("progress"), t.as_of, late, 1, malformed)
    return ads_outcomes(t, on_time, late, malformed)


@query(
    "review_event_sink",
    """
    SELECT CAST(id AS VARCHAR) AS key, CAST(json_object('id', id, 'listing_id', listing_id, 'comment', comment,
      'language', language, 'likes_count', likes_count) AS VARCHAR) AS value
    FROM review_rows
    """,
)
def review_event_sink(t: Tables) -> DataFrame:
    return review_messages(t.unique_reviews.select("id", "listing_id", "comment", "language", "likes_count"))


@query(
    "silver_multi_table_sink",
    "SELECT t AS table_name, id FROM listings, (VALUES ('HostDetails'), ('HostMetrics'), ('RentDetails'), "
    "('RentMetrics'), ('Location'), ('Metadata')) AS names(t)",
)
def silver_multi_table_sink(t: Tables) -> DataFrame:
    folder = t.work("silver")
    statuses = write_tables({name: silver_table(t.listings, name) for name in LISTING_TABLES}, folder)
    found = read_available(t.spark, folder, [s.table for s in statuses if s.ok])
    return union_files(df.select(F.lit(name).alias("table_name"), "id") for name, df in found.items())


@query(
    "silver_multi_table_sink_versions",
    "SELECT t AS table_name, id FROM listings, (VALUES ('HostDetails'), ('HostMetrics'), ('RentDetails'), "
    "('RentMetrics'), ('Location'), ('Metadata')) AS names(t)",
)
def silver_multi_table_sink_versions(t: Tables) -> DataFrame:
    """One commit for six tables; a second run that fails at its last table changes none of them."""
    folder = t.work("silver_versions")
    tables = {name: silver_table(t.listings, name) for name in LISTING_TABLES}
    write_tables(tables, folder, versioned=True)
    broken = {name: df.limit(1) for name, df in tables.items()}
    broken[LISTING_TABLES[-1]] = t.listings.select(F.raise_error(F.lit("cut off")).alias("id"))
    with suppress(TablesFailedError):
        write_tables(broken, folder)
    found = read_available(t.spark, folder, LISTING_TABLES)
    return union_files(df.select(F.lit(name).alias("table_name"), "id") for name, df in found.items())


@query("optional_table_scan", f"SELECT {flat_sql('AggAds')} FROM agg_ads")
def optional_table_scan(t: Tables) -> DataFrame:
    folder, schema = t.work("gold"), schema_of("AggAds")
    write_table(t.agg_ads, f"{folder}/AggAds.parquet")
    there = read_optional(t.spark, f"{folder}/AggAds.parquet", schema)
    missing = read_optional(t.spark, f"{folder}/NotYet.parquet", schema)
    return flat(there.unionByName(missing))


@query(
    "optional_mart_branch",
    "SELECT provider_id, provider_name, 'both inputs' AS branch FROM agg_ads",
)
def optional_mart_branch(t: Tables) -> DataFrame:
    """Provider marts appear with both inputs there, and not with one of them."""
    needed = ("providerDetails", "providerMetrics")
    rows = []
    for branch, tables in (("both inputs", needed), ("one input", needed[:1])):
        folder = t.work("silver_ads")
        write_tables({name: t.silver_ads[name] for name in tables}, folder)
        found = read_available(t.spark, folder, needed)
        if set(needed) <= set(found):
            marts = gold.provider_marts(found["providerDetails"], found["providerMetrics"], t.as_of)
            rows.append(marts["AggAds"].select("provider_id", "provider_name", F.lit(branch).alias("branch")))
    return union_files(rows)
