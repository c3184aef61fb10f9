"""Review messages: source, envelope, contract, typed event.

Everything here is a projection, so it serves batch and streaming frames alike.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from staylens.functions import arrays, flags, numbers, text, times
from staylens.functions.times import AsOf
from staylens.operators.schema_ops import cast_to_schema
from staylens.schemas import schema_of

# Fixed value: most messages taken in one batch.
MAX_BATCH_MESSAGES = 500

# The JSON contract of a review message.  Every field may be missing or null.
CONTRACT = {
    "listing_id": "long",
    "id": "long",
    "date": "string",
    "reviewer_id": "long",
    "reviewer_name": "string",
    "comments": "string",
    "language": "string",
    "sentiment_score": "float",
    "sentiment_label": "array",
    "likes_votes": "int",
    "event_ingestion_time": "string",
    "raw_user_agent": "string",
    "bot_suspicion_score": "float",
    "reviewer_hash_id": "string",
    "aspect_sentiment_json": "string",
    "extracted_keywords": "string",
    "comment_character_count": "int",
    "readability_index": "float",
    "session_id": "string",
    "time_spent_on_review_ms": "int",
    "contains_media": "boolean",
    "ingestion_ts": "string",
}
# Event fields that must read as numbers.
WHOLE_FIELDS = {
    "listing_id": "bigint",
    "id": "bigint",
    "reviewer_id": "bigint",
    "likes_votes": "bigint",
    "comment_character_count": "bigint",
    "time_spent_on_review_ms": "bigint",
}
DECIMAL_FIELDS = ("sentiment_score", "bot_suspicion_score", "readability_index")
TEXT_FIELDS = (
    "date",
    "reviewer_name",
    "language",
    "raw_user_agent",
    "reviewer_hash_id",
    "aspect_sentiment_json",
    "extracted_keywords",
    "session_id",
)


# --- sources ----------------------------------------------------------------------


def kafka_messages(
    spark: SparkSession, servers: str, topic: str, max_per_batch: int = MAX_BATCH_MESSAGES
) -> DataFrame:
    """The topic from its beginning, in bounded batches; messages without a value are skipped.

    The checkpoint of the query that reads it keeps the offsets.
    """
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .option("maxOffsetsPerTrigger", max_per_batch)
        .load()
        .select(F.col("value").cast("string").alias("value"), F.col("timestamp").alias("received_at"))
        .filter(F.col("value").isNotNull())
    )


def file_messages(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """The same messages from a folder of Parquet files (``value``, ``received_at``)."""
    reader = spark.readStream.schema("value STRING, received_at TIMESTAMP")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path).filter(F.col("value").isNotNull())


# --- envelope ---------------------------------------------------------------------


def _kind(document: Column) -> Column:
    """OBJECT, ARRAY, STRING, BIGINT, ... ; NULL for no document."""
    return F.regexp_extract(F.schema_of_variant(document), r"^[A-Z]+", 0)


def _starts_with(text: Column, mark: str) -> Column:
    return F.ltrim(text, F.lit(" \t\r\n")).startswith(mark)


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once per row.

    A filter on a derived column is pushed below the projections it comes from, with
    every step written out wherever it is used.  Parsing is too dear for that, so its
    result is bound as the variable of a one-element ``transform``.
    """
    return F.transform(F.array(value), use)[0]


def _object_text(message: Column) -> Column:
    """The JSON object in a message, as text, or NULL."""

    def text_of(document: Column) -> Column:
        return F.try_variant_get(document, "$", "string")

    def valid(text: Column) -> Column:
        return F.when(F.try_parse_json(text).isNotNull(), text)

    def unwrapped(text: Column) -> Column:
        return _once(
            F.try_parse_json(text),
            lambda document: _once(
                F.try_variant_get(document, "$.payload", "variant"),
                lambda inner: _once(
                    _kind(inner),
                    lambda kind: F.when(kind == "STRING", _once(text_of(inner), valid))
                    .when(kind == "OBJECT", F.to_json(inner))
                    .when(F.coalesce(kind, F.lit("")) != "ARRAY", F.when(document.isNotNull(), text)),
                ),
            ),
        )

    # A message may be a JSON string that holds the JSON text.
    plain = F.when(_starts_with(message, '"'), text_of(F.try_parse_json(message))).otherwise(message)
    body = _once(plain, unwrapped)
    return _once(body, lambda text: F.when(_starts_with(text, "{"), text))


def unwrap_payload(messages: DataFrame, value: str = "value") -> DataFrame:
    """Add ``payload``: the JSON object a message carries, as text; NULL when there is none.

    Accepted are an object, JSON text inside a JSON string, and an envelope
    ``{"payload": ...}`` around either.  Lists, scalars and non-JSON are not.
    """
    return messages.withColumn("payload", _object_text(F.col(value)))


def flatten_json(df: DataFrame, column: str, schema: StructType) -> DataFrame:
    """Parse a JSON column and lift its fields to columns; unreadable fields are NULL."""
    others = [c for c in df.columns if c != column]
    parsed = F.from_json(column, schema).alias("_row")
    return df.select(*others, parsed).select(*others, "_row.*")


def stamp_events(df: DataFrame, received_at: Column | None = None, as_of: AsOf = None) -> DataFrame:
    """Fill in when a message was received and when it was taken in."""
    received = times.clock(as_of) if received_at is None else received_at
    return df.withColumns(
        {
            "event_ingestion_time": F.coalesce("event_ingestion_time", received),
            "ingestion_ts": F.coalesce("ingestion_ts", times.clock(as_of)),
        }
    )


def bronze_reviews(messages: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Messages to typed bronze rows; messages without an object are dropped."""
    payloads = unwrap_payload(messages).filter(F.col("payload").isNotNull())
    rows = flatten_json(payloads.select("received_at", "payload"), "payload", schema_of("reviews"))
    stamped = stamp_events(rows, F.coalesce("received_at", times.clock(as_of)), as_of)
    return cast_to_schema(stamped, schema_of("reviews"))


def split_messages(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(messages that carry an object, quarantined messages)."""
    unwrapped = unwrap_payload(messages)
    return unwrapped.filter(F.col("payload").isNotNull()), unwrapped.filter(F.col("payload").isNull())


# --- contract ---------------------------------------------------------------------


#: The variant types that each kind of field may have, as a pattern; VOID is a JSON null.
VARIANT_TYPES = {
    "string": "STRING",
    "boolean": "BOOLEAN",
    "array": "ARRAY<(STRING|VOID)>",
    "float": "DECIMAL.*|DOUBLE|FLOAT|BIGINT",
    "int": "BIGINT",
    "long": "BIGINT",
}


def _fits(part: Column, kind: str) -> Column:
    """Whether a field's variant has the right type.  Its type is looked at once: nothing shares work in a lambda."""
    right = F.schema_of_variant(part).rlike(f"^(VOID|{VARIANT_TYPES[kind]})$")
    if kind == "int":
        # A whole number in range, or no number at all, which the type decides.
        whole = F.try_variant_get(part, "$", "bigint")
        right &= F.coalesce(whole.between(-(2**31), 2**31 - 1), F.lit(True))
    return F.coalesce(right, part.isNull())


def check_contract(messages: DataFrame, value: str = "value") -> DataFrame:
    """Add ``violations``: the fields that break the contract, or ``not an object``.

    A message is parsed once and its fields are taken out in one pass over its keys.
    """
    fields = "struct<" + ", ".join(f"{field}: variant" for field in CONTRACT) + ">"

    def violations(parts: Column) -> Column:
        broken = [F.when(~_fits(parts[field], kind), F.lit(field)) for field, kind in CONTRACT.items()]
        return F.when(parts.isNotNull(), F.array_compact(F.array(*broken))).otherwise(
            F.array(F.lit("not an object"))
        )

    document = F.when(_starts_with(F.col(value), "{"), F.try_parse_json(F.col(value)))
    return messages.withColumn("violations", _once(F.try_variant_get(document, "$", fields), violations))


def split_by_contract(messages: DataFrame, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """(messages that fit the contract, quarantined messages with their violations)."""
    checked = check_contract(messages, value)
    fits = F.size("violations") == 0
    return checked.filter(fits).drop("violations"), checked.filter(~fits)


# --- raw row to event -------------------------------------------------------------


def normalize_events(raw: DataFrame, as_of: AsOf = None) -> tuple[DataFrame, DataFrame]:
    """Raw text rows to typed review events: (events, rejected rows).

    A row is rejected when a number field holds text that is no number.  Either spelling
    of the two renamed fields is accepted; columns the input lacks are NULL.
    """
    spare = {"comment": None, "likes_count": None}
    wanted = [*CONTRACT, *spare]
    rows = raw.withColumns({c: F.lit(None).cast("string") for c in wanted if c not in raw.columns})
    rows = rows.withColumns(
        {
            "comments": text.alias_fallback(F.col("comments"), F.col("comment")),
            "likes_votes": text.alias_fallback(F.col("likes_votes"), F.col("likes_count")),
        }
    )
    wholes = {c: numbers.event_int(F.col(c), t) for c, t in WHOLE_FIELDS.items()}
    decimals = {c: numbers.event_float(F.col(c)) for c in DECIMAL_FIELDS}
    bad = F.lit(False)
    for name, parsed in (wholes | decimals).items():
        bad = bad | numbers.is_unreadable(F.col(name), parsed)
    now = times.iso_text(times.clock(as_of).cast("string"))
    typed = {
        **wholes,
        **decimals,
        **{c: F.col(c) for c in TEXT_FIELDS},
        "comments": F.col("comments"),
        "sentiment_label": arrays.list_from_loose_text(F.col("sentiment_label")),
        "event_ingestion_time": times.iso_text(F.col("event_ingestion_time")),
        "contains_media": flags.event_flag(F.col("contains_media")),
        "ingestion_ts": F.coalesce(times.iso_text(F.col("ingestion_ts")), now),
    }
    events = rows.filter(~bad).select(*[typed[c].alias(c) for c in CONTRACT])
    return events, rows.filter(bad).select(*raw.columns)
