"""Streaming: each query runs its stream over a file source until nothing is left."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylens import jobs
from staylens.catalog.frame_queries import EVENT_HISTORY_SQL
from staylens.catalog.io_queries import ADS_SHOWN_SQL, awkward_ads, files_for, shown_ads, write_csv
from staylens.catalog.registry import Tables, flat, query, time_text
from staylens.catalog.twins import AS_OF, NOW, flat as flat_sql
from staylens.operators.schema_ops import cast_to_schema
from staylens.schemas import schema_of
from staylens.sources.files import read_raw_csv, stream_csv, union_files
from staylens.sources.landing import split_late
from staylens.sources.sinks import review_messages, write_table
from staylens.streaming import messages, upsert
from staylens.streaming.drain import (
    batch_folder,
    drain,
    drain_append,
    drain_late_split,
    drain_to_bronze,
    first_deliveries,
    windowed_counts,
)

FILES, FILES_PER_BATCH = 6, 2


def stream_files(rows: DataFrame) -> tuple[int, int]:
    """How many files a feed has and a batch takes: more of both for more rows, in as many batches."""
    files = files_for(rows, FILES)
    return files, files * FILES_PER_BATCH // FILES


def message_stream(t: Tables) -> DataFrame:
    path, (files, per_batch) = t.work("messages"), stream_files(t.message_feed)
    write_table(t.message_feed.select("value", "received_at").repartition(files), path)
    return messages.file_messages(t.spark, path, per_batch)


def review_stream(t: Tables, rows: DataFrame) -> DataFrame:
    """Bronze reviews as a stream of a few batches, in no order."""
    path, schema, (files, per_batch) = t.work("bronze_reviews"), schema_of("reviews"), stream_files(rows)
    write_table(cast_to_schema(rows, schema).repartition(files), path)
    return t.spark.readStream.schema(schema).option("maxFilesPerTrigger", per_batch).parquet(path)


def event_stream(t: Tables) -> DataFrame:
    """Events as a stream; a watermark needs a timestamp that knows its zone."""
    path = t.work("events")
    events = t.table("events").select("event_id", "event_type", F.col("ts").cast("timestamp").alias("ts"))
    write_table(events, path)
    return t.spark.readStream.schema(events.schema).parquet(path)


# --- sources and sinks ------------------------------------------------------------


@query("csv_stream_scan", ADS_SHOWN_SQL)
def csv_stream_scan(t: Tables) -> DataFrame:
    path, target = write_csv(t, awkward_ads(t), "adsProviders"), t.work("ads_streamed")
    rows = stream_csv(t.spark, schema_of("adsProviders"), path, t.as_of, max_files=2)
    drain_append(rows, target, t.work("checkpoint"))
    return shown_ads(t.spark.read.parquet(target))


@query("kafka_review_source", "SELECT value FROM message_feed WHERE value IS NOT NULL")
def kafka_review_source(t: Tables) -> DataFrame:
    """The message source over files: the Kafka source differs in its connection only."""
    target = t.work("messages_streamed")
    drain_append(message_stream(t), target, t.work("checkpoint"))
    return t.spark.read.parquet(target).select("value")


BODY_SQL = """
SELECT event_id, received_at, value, CASE
    WHEN value IS NULL OR NOT json_valid(value) THEN NULL
    WHEN json_type(value, '$.payload') = 'VARCHAR' THEN
      CASE WHEN json_valid(json_extract_string(value, '$.payload')) THEN json_extract_string(value, '$.payload') END
    WHEN json_type(value, '$.payload') IN ('OBJECT', 'ARRAY') THEN CAST(json_extract(value, '$.payload') AS VARCHAR)
    ELSE value END AS body
FROM message_feed
"""
PAYLOAD_SQL = f"SELECT *, CASE WHEN json_type(body) = 'OBJECT' THEN body END AS payload FROM ({BODY_SQL})"
BRONZE_SQL = f"""
SELECT CAST(json_extract(payload, '$.id') AS BIGINT) AS id,
  CASE WHEN json_type(payload, '$.listing_id') = 'UBIGINT' THEN CAST(json_extract(payload, '$.listing_id') AS BIGINT) END AS listing_id,
  CAST(json_extract(payload, '$.reviewer_id') AS BIGINT) AS reviewer_id,
  json_extract_string(payload, '$.reviewer_name') AS reviewer_name, json_extract_string(payload, '$.comments') AS comments,
  CASE WHEN json_type(payload, '$.likes_votes') = 'UBIGINT' THEN TRY_CAST(json_extract(payload, '$.likes_votes') AS INTEGER) END AS likes_votes,
  CASE WHEN json_type(payload, '$.contains_media') = 'BOOLEAN' THEN CAST(json_extract(payload, '$.contains_media') AS BOOLEAN) END AS contains_media,
  strftime(CAST(json_extract_string(payload, '$.date') AS TIMESTAMP), '%Y-%m-%d %H:%M:%S') AS date,
  strftime(received_at, '%Y-%m-%d %H:%M:%S') AS event_ingestion_time, '{AS_OF}' AS ingestion_ts
FROM ({PAYLOAD_SQL}) WHERE payload IS NOT NULL
"""
BRONZE_COLUMNS = (
    "id", "listing_id", "reviewer_id", "reviewer_name", "comments", "likes_votes", "contains_media", "date",
    "event_ingestion_time", "ingestion_ts",
)


@query("bronze_review_sink", BRONZE_SQL)
def bronze_review_sink(t: Tables) -> DataFrame:
    target = t.work("bronze")
    drain_to_bronze(message_stream(t), target, t.work("checkpoint"), t.as_of)
    return flat(t.spark.read.parquet(target).select(*BRONZE_COLUMNS))


@query("stream_batch_drain", f"SELECT count(*) AS n_rows, count(DISTINCT id) AS n_ids, CAST(3 AS BIGINT) AS n_batches FROM ({BRONZE_SQL})")
def stream_batch_drain(t: Tables) -> DataFrame:
    target = t.work("bronze")
    drain_to_bronze(message_stream(t), target, t.work("checkpoint"), t.as_of)
    return t.spark.read.parquet(target).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.countDistinct("id").alias("n_ids"),
        F.countDistinct("batch_id").alias("n_batches"),
    )


# --- late data --------------------------------------------------------------------


@query(
    "stream_watermark",
    """
    SELECT strftime(day, '%Y-%m-%d %H:%M:%S') AS window_start, event_type, count(*) AS n
    FROM (SELECT date_trunc('day', CAST(ts AS TIMESTAMP)) AS day, event_type FROM events)
    GROUP BY day, event_type
    HAVING day + INTERVAL 1 DAY <= (SELECT max(CAST(ts AS TIMESTAMP)) - INTERVAL 48 HOURS FROM events)
    """,
)
def stream_watermark(t: Tables) -> DataFrame:
    """Counts per day and type; only days the watermark has closed come out."""
    moments = event_stream(t).select("ts", "event_type")
    target = t.work("windows")
    drain_append(windowed_counts(moments, "ts", "event_type"), target, t.work("checkpoint"))
    return t.spark.read.parquet(target).select(time_text("window_start").alias("window_start"), "event_type", "n")


LATE_SPLIT_SQL = f"""
SELECT event_id, coalesce(ts BETWEEN {NOW} - INTERVAL 48 HOURS AND {NOW} + INTERVAL 48 HOURS, false) AS accepted
FROM events
"""


@query("stream_late_split", LATE_SPLIT_SQL)
def stream_late_split(t: Tables) -> DataFrame:
    moments = event_stream(t).select("event_id", "ts")
    accepted, late = t.work("accepted"), t.work("late")
    drain_late_split(moments, accepted, late, t.work("checkpoint"), t.as_of, "ts")
    return _both(t.spark.read.parquet(accepted), t.spark.read.parquet(late))


def _both(accepted: DataFrame, late: DataFrame) -> DataFrame:
    return accepted.select("event_id", F.lit(True).alias("accepted")).unionByName(
        late.select("event_id", F.lit(False).alias("accepted"))
    )


ADS_ON_TIME_SQL = f"coalesce(last_updated BETWEEN {NOW} - INTERVAL 48 HOURS AND {NOW} + INTERVAL 48 HOURS, false)"


@query("stream_ads_job", f"SELECT id, {ADS_ON_TIME_SQL} AS accepted FROM ads_feed")
def stream_ads_job(t: Tables) -> DataFrame:
    """The streaming ads job over several batches, then again with nothing new."""
    folder, bronze, checkpoint = write_csv(t, awkward_ads(t), "adsProviders"), t.work("ads"), t.work("checkpoint")
    for _ in range(2):
        jobs.stream_ads(t.spark, folder, bronze, checkpoint, t.as_of, max_files=2)
    sides = ((t.spark.read.parquet(path), accepted) for path, accepted in ((bronze, True), (f"{bronze}_late", False)))
    return union_files(df.select("id", F.lit(accepted).alias("accepted")) for df, accepted in sides)


@query(
    "stream_late_counts",
    f"SELECT count(*) AS n_rows, CAST(count(*) FILTER (NOT {ADS_ON_TIME_SQL}) AS BIGINT) AS n_late FROM ads_feed",
)
def stream_late_counts(t: Tables) -> DataFrame:
    """Rows and late rows per file, kept over the batches of a stream, in one sum."""
    folder = write_csv(t, awkward_ads(t), "adsProviders")
    counts = jobs.stream_ads(t.spark, folder, t.work("ads"), t.work("checkpoint"), t.as_of, max_files=1)
    return counts.agg(F.sum("n_rows").alias("n_rows"), F.sum("n_late").alias("n_late"))


@query(
    "stream_first_deliveries",
    """
    SELECT event_id, CASE WHEN event_id % 4 = 0 THEN 4 ELSE 0 END AS day FROM events
    UNION ALL SELECT event_id, 5 FROM events WHERE event_id % 4 <> 0 AND event_id % 5 = 1
    """,
)
def stream_first_deliveries(t: Tables) -> DataFrame:
    """Copies that come a day later are dropped; after 48 hours nothing is known of the first ones."""
    path, target, checkpoint = t.work("deliveries"), t.work("first_deliveries"), t.work("checkpoint")
    new, n = F.col("event_id") % 4 != 0, F.col("event_id")
    for day, part in ((0, new), (1, new & (n % 3 == 0)), (4, ~new), (5, new & (n % 5 == 1))):
        arrived = F.lit(t.as_of).cast("timestamp") + F.expr(f"INTERVAL {25 * day} HOURS")
        rows = t.table("events").filter(part).select("event_id", F.lit(day).alias("day"), arrived.alias("arrived"))
        rows.coalesce(1).write.mode("append").parquet(path)
        stream = first_deliveries(t.spark.readStream.schema(rows.schema).parquet(path), ["event_id"], "arrived")
        drain(stream, lambda batch, k: write_table(batch, batch_folder(target, k)), checkpoint)
    return t.spark.read.parquet(target).select("event_id", "day")


@query("late_split_batch", LATE_SPLIT_SQL)
def late_split_batch(t: Tables) -> DataFrame:
    events = t.table("events").select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    return _both(*split_late(events, t.as_of, "ts"))


# --- messages ---------------------------------------------------------------------


@query(
    "stream_payload_unwrap",
    f"""
    SELECT event_id, CAST(json_extract(payload, '$.id') AS BIGINT) AS payload_id, payload IS NULL AS quarantined
    FROM ({PAYLOAD_SQL})
    """,
)
def stream_payload_unwrap(t: Tables) -> DataFrame:
    unwrapped = messages.unwrap_payload(t.message_feed)
    return unwrapped.select(
        "event_id",
        F.get_json_object("payload", "$.id").try_cast("bigint").alias("payload_id"),
        F.col("payload").isNull().alias("quarantined"),
    )


CONTRACT_SQL = """
SELECT event_id, CASE WHEN value IS NULL OR NOT json_valid(value) OR json_type(value) <> 'OBJECT' THEN 'not an object'
  ELSE concat_ws('|',
    CASE WHEN json_type(value, '$.listing_id') = 'VARCHAR' THEN 'listing_id' END,
    CASE WHEN json_type(value, '$.reviewer_name') = 'UBIGINT' THEN 'reviewer_name' END,
    CASE WHEN json_type(value, '$.likes_votes') = 'DOUBLE'
           OR TRY_CAST(json_extract_string(value, '$.likes_votes') AS BIGINT) > 2147483647 THEN 'likes_votes' END,
    CASE WHEN json_type(value, '$.contains_media') = 'VARCHAR' THEN 'contains_media' END) END AS violations
FROM message_feed
"""


@query("stream_contract_check", CONTRACT_SQL)
def stream_contract_check(t: Tables) -> DataFrame:
    checked = messages.check_contract(t.message_feed)
    return checked.select("event_id", F.array_join("violations", "|").alias("violations"))


# A right and a wrong JSON value for every kind of field.
RIGHT_AND_WRONG = {
    "string": ('"text"', "7"), "boolean": ("true", '"yes"'), "array": ('["a", "b"]', "[1]"), "float": ("0.5", '"0.5"'),
    "int": ("-5", "3000000000"), "long": ("3000000000", "1.5"),
}
BROKEN_SQL = " ".join(
    f"WHEN event_id % {len(messages.CONTRACT) + 2} = {i} THEN '{field}'" for i, field in enumerate(messages.CONTRACT)
)


@query(
    "stream_contract_check_all_fields",
    f"""
    SELECT event_id, CASE {BROKEN_SQL} WHEN event_id % {len(messages.CONTRACT) + 2} = {len(messages.CONTRACT)}
      THEN '{"|".join(messages.CONTRACT)}' ELSE '' END AS violations
    FROM events
    """,
)
def stream_contract_check_all_fields(t: Tables) -> DataFrame:
    """Every field of the contract broken alone, all of them together, and none."""
    every = len(messages.CONTRACT)
    which = F.pmod("event_id", F.lit(every + 2))
    parts = []
    for i, (field, kind) in enumerate(messages.CONTRACT.items()):
        right, wrong = (F.lit(f'"{field}": {value}') for value in RIGHT_AND_WRONG[kind])
        parts.append(F.when(which.isin(i, every), wrong).otherwise(right))
    value = F.concat(F.lit('{"other": {"id": "x"}, '), F.concat_ws(", ", *parts), F.lit("}"))
    checked = messages.check_contract(t.table("events").select("event_id", value.alias("value")))
    return checked.select("event_id", F.array_join("violations", "|").alias("violations"))


@query(
    "stream_event_stamp",
    f"""
    SELECT event_id, strftime(CASE WHEN event_id % 3 = 0 THEN CAST(ts AS TIMESTAMP) ELSE {NOW} END, '%Y-%m-%d %H:%M:%S')
      AS event_ingestion_time, '{AS_OF}' AS ingestion_ts
    FROM events
    """,
)
def stream_event_stamp(t: Tables) -> DataFrame:
    rows = t.table("events").select(
        "event_id",
        F.when(F.col("event_id") % 3 == 0, F.col("ts").cast("timestamp")).alias("event_ingestion_time"),
        F.lit(None).cast("timestamp").alias("ingestion_ts"),
    )
    return flat(messages.stamp_events(rows, as_of=t.as_of))


NORMALIZED_SQL = f"""
SELECT TRY_CAST(id AS BIGINT) AS id, TRY_CAST(nullif(listing_id, '') AS BIGINT) AS listing_id,
  TRY_CAST(reviewer_id AS BIGINT) AS reviewer_id, date, reviewer_name,
  coalesce(nullif(comments, ''), comment) AS comments, language,
  round(CAST(TRY_CAST(nullif(sentiment_score, '') AS FLOAT) AS DOUBLE), 3) AS sentiment_score,
  CASE sentiment_label WHEN '["a"," b ",""]' THEN 'a|b' WHEN 'x, y ,,' THEN 'x|y' END AS sentiment_label,
  CAST(coalesce(nullif(likes_votes, ''), likes_count) AS BIGINT) AS likes_votes,
  CASE event_ingestion_time WHEN '2024-01-05T10:00:00Z' THEN '2024-01-05T10:00:00+00:00'
    WHEN '2024-01-05 10:00:00.250' THEN '2024-01-05T10:00:00.250000+00:00'
    WHEN '2024-01-05T10:00:00+02:00' THEN '2024-01-05T08:00:00+00:00'
    WHEN '2024-01-05' THEN '2024-01-05T00:00:00+00:00'
    ELSE nullif(event_ingestion_time, '') END AS event_ingestion_time,
  lower(trim(nullif(contains_media, ''))) IN ('true', '1', 'yes', 'y') AS contains_media,
  '{AS_OF.replace(" ", "T")}+00:00' AS ingestion_ts
FROM event_feed WHERE TRY_CAST(reviewer_id AS BIGINT) IS NOT NULL
"""


@query("review_event_normalize", NORMALIZED_SQL)
def review_event_normalize(t: Tables) -> DataFrame:
    events, _ = messages.normalize_events(t.event_feed, t.as_of)
    return flat(
        events.select(
            "id", "listing_id", "reviewer_id", "date", "reviewer_name", "comments", "language", "sentiment_score",
            "sentiment_label", "likes_votes", "event_ingestion_time", "contains_media", "ingestion_ts",
        )
    )


@query(
    "review_event_rejects",
    "SELECT id, reviewer_id FROM event_feed WHERE TRY_CAST(reviewer_id AS BIGINT) IS NULL",
)
def review_event_rejects(t: Tables) -> DataFrame:
    _, rejected = messages.normalize_events(t.event_feed, t.as_of)
    return rejected.select("id", "reviewer_id")


# --- silver upsert ----------------------------------------------------------------


@query("stream_review_upsert", f"SELECT {flat_sql('Review')} FROM silver_review")
def stream_review_upsert(t: Tables) -> DataFrame:
    """Reviews arrive in several batches with copies; each id ends up once."""
    target = t.work("silver_reviews")
    upsert.drain_to_silver(review_stream(t, t.review_feed), target, t.work("checkpoint"), t.as_of)
    return flat(upsert.read_reviews(t.spark, target))


@query("stream_scd2_current", EVENT_HISTORY_SQL)
def stream_scd2_current(t: Tables) -> DataFrame:
    """Events arrive out of order; the history ends up as if they had come in order."""
    events = t.table("events").select(
        F.col("event_id").alias("id"),
        F.col("user_id").alias("reviewer_id"),
        F.date_trunc("hour", F.col("ts").cast("timestamp")).alias("date"),
    )
    target = t.work("silver_reviews")
    stream = review_stream(t, cast_to_schema(events, schema_of("reviews")))
    upsert.drain_to_silver(stream, target, t.work("checkpoint"), t.as_of)
    return flat(upsert.read_reviews(t.spark, target).select("id", "reviewer_id", "start_date", "end_date", "is_current"))


END_TO_END_SQL = f"""
SELECT id, listing_id, reviewer_id, reviewer_name, comment, likes_count,
  strftime(date, '%Y-%m-%d %H:%M:%S') AS start_date, strftime(lead(date) OVER w, '%Y-%m-%d %H:%M:%S') AS end_date,
  lead(date) OVER w IS NULL AS is_current
FROM (SELECT id, coalesce(listing_id, -1) AS listing_id, reviewer_id, reviewer_name, 'ok then' AS comment,
        coalesce(likes_votes, 0) AS likes_count, CAST(date AS TIMESTAMP) AS date FROM ({BRONZE_SQL}))
WINDOW w AS (PARTITION BY reviewer_id ORDER BY date, id)
"""


@query("stream_reviews_end_to_end", END_TO_END_SQL)
def stream_reviews_end_to_end(t: Tables) -> DataFrame:
    """Messages to bronze to silver in one stream."""
    bronze, silver = t.work("bronze"), t.work("silver_reviews")
    upsert.drain_reviews(message_stream(t), bronze, silver, t.work("checkpoint"), t.as_of)
    return flat(
        upsert.read_reviews(t.spark, silver).select(
            "id", "listing_id", "reviewer_id", "reviewer_name", "comment", "likes_count", "start_date", "end_date",
            "is_current",
        )
    )


@query(
    "review_events_from_csv",
    f"""
    SELECT CAST(id AS VARCHAR) AS key, reviewer_id, comments, likes_votes, labels, contains_media
    FROM (SELECT id, reviewer_id, comments, likes_votes, sentiment_label AS labels, contains_media FROM ({NORMALIZED_SQL}))
    """,
)
def review_events_from_csv(t: Tables) -> DataFrame:
    """Raw CSV rows to typed JSON messages, read back from the message text."""
    path = t.work("reviews_csv")
    t.event_feed.repartition(4).write.options(header=True, quote='"', escape='"').csv(path)
    events, _ = messages.normalize_events(read_raw_csv(t.spark, path), t.as_of)
    sent = review_messages(events)
    body = F.from_json("value", "reviewer_id BIGINT, comments STRING, likes_votes BIGINT, sentiment_label ARRAY<STRING>, contains_media BOOLEAN")
    return sent.select("key", body.alias("b")).select(
        "key", "b.reviewer_id", "b.comments", "b.likes_votes",
        F.array_join("b.sentiment_label", "|").alias("labels"), "b.contains_media",
    )
