"""Review feed to silver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylens.functions import arrays, numbers, text, times
from staylens.functions.times import AsOf
from staylens.operators.dedupe import dedupe_latest
from staylens.operators.history import event_history
from staylens.operators.schema_ops import cast_to_schema
from staylens.operators.skew import heavy_keys
from staylens.schemas import schema_of

# Fixed value: the listing of a review that names none.
NO_LISTING = -1
# Fixed value: the score of a review that has none.
DEFAULT_SCORE = 1.0


def clean_review_fields(
    bronze: DataFrame,
    as_of: AsOf = None,
    default_score: float = DEFAULT_SCORE,
    default_label: str = arrays.DEFAULT_LABEL,
) -> DataFrame:
    """Column rules only: reviews with an id and a reviewer, defaults filled in.

    Works on batch and streaming frames alike.
    """
    return bronze.filter(F.col("id").isNotNull() & F.col("reviewer_id").isNotNull()).withColumns(
        {
            "date": times.first_timestamp(
                F.col("date"), F.col("event_ingestion_time"), as_of=as_of
            ),
            "listing_id": F.coalesce("listing_id", F.lit(NO_LISTING)),
            "reviewer_name": F.coalesce(F.trim("reviewer_name"), F.lit("")),
            "comment": text.squeeze_whitespace(F.col("comments")),
            "language": text.language_code(F.col("language")),
            "sentiment_label": arrays.labels_or_default(F.col("sentiment_label"), default_label),
            "sentiment_score": numbers.nan_to(F.col("sentiment_score"), default_score),
            "likes_count": numbers.or_zero(F.col("likes_votes")),
        }
    )


def unique_reviews(bronze: DataFrame, as_of: AsOf = None, **defaults) -> DataFrame:
    """Cleaned reviews, each id once (the latest copy)."""
    return delivered_reviews(bronze, as_of, **defaults).drop("delivered_ts", "delivered_tie")


def delivered_reviews(bronze: DataFrame, as_of: AsOf = None, **defaults) -> DataFrame:
    """The same with ``delivered_ts`` and ``delivered_tie``, which say how late the copy is.

    The latest copy has the greatest ``delivered_ts``, then the smallest ``delivered_tie``, a
    hash of what the copy says.  Copies in different batches compare like copies in one.
    """
    fields = clean_review_fields(bronze, as_of, **defaults)
    marked = fields.withColumns(
        {"delivered_ts": F.col("ingestion_ts"), "delivered_tie": F.xxhash64(*sorted(set(bronze.columns) & set(schema_of("reviews").names)))}
    )
    latest = [F.col("delivered_ts").desc_nulls_last(), F.col("delivered_tie")]
    return dedupe_latest(marked, ["id"], latest, ties=["id"]).withColumn("ingestion_ts", times.clock(as_of))


def with_history(reviews: DataFrame, heavy: DataFrame | None = None) -> DataFrame:
    """Silver reviews from unique ones: the reviewer's history, cut to the schema."""
    return cast_to_schema(event_history(reviews, heavy=heavy), schema_of("Review"))


def clean_reviews(bronze: DataFrame, as_of: AsOf = None, **defaults) -> DataFrame:
    """Silver reviews in one lazy plan.

    Heavy reviewers are counted in bronze, a narrow scan ahead of the de-duplication.
    Jobs write ``unique_reviews`` to a table first and add the history from there.
    """
    heavy = heavy_keys(bronze.dropna(subset=["reviewer_id"]), ["reviewer_id"])
    return with_history(unique_reviews(bronze, as_of, **defaults), heavy)
