"""Bringing a DataFrame to a declared schema."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Silver column -> source column, where the names differ.
LISTING_RENAMES = {
    "listing_id": "id",
    "host_profile_id": "host_id",
    "host_profile_url": "host_url",
    "price_per_night": "price",
}
REVIEW_RENAMES = {"comment": "comments", "likes_count": "likes_votes"}


def source_names(schema: StructType, renames: Mapping[str, str] | None = None) -> dict[str, str]:
    renames = renames or {}
    return {name: renames.get(name, name) for name in schema.names}


def require_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The frame itself, or an error that names the columns it lacks."""
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise ValueError("missing source columns: " + ", ".join(missing))
    return df


def ensure_columns(
    df: DataFrame, schema: StructType, renames: Mapping[str, str] | None = None
) -> DataFrame:
    """Add what the schema needs and the frame lacks, as typed NULLs."""
    sources = source_names(schema, renames)
    absent = {
        sources[f.name]: F.lit(None).cast(f.dataType)
        for f in schema
        if sources[f.name] not in df.columns
    }
    return df.withColumns(absent) if absent else df


def project_to(
    df: DataFrame, schema: StructType, renames: Mapping[str, str] | None = None
) -> DataFrame:
    """Rename and cast to the schema; every source column has to be there."""
    sources = source_names(schema, renames)
    require_columns(df, list(sources.values()))
    return df.select(*[F.col(sources[f.name]).try_cast(f.dataType).alias(f.name) for f in schema])


def cast_to_schema(df: DataFrame, schema: StructType) -> DataFrame:
    """Project to the schema; columns the frame lacks become typed NULLs.

    Values that do not fit the declared type become NULL instead of failing the job.
    """
    return df.select(
        *[
            (
                F.col(f.name).try_cast(f.dataType)
                if f.name in df.columns
                else F.lit(None).cast(f.dataType)
            ).alias(f.name)
            for f in schema
        ]
    )
