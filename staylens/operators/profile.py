"""Data-quality profile of a cleaning job, in one pass over the cleaned rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from staylens.functions.text import MISSING_TOKENS, is_missing


class EmptyResultError(ValueError):
    """A job was left without rows."""


def _nulls(columns: Sequence[str]) -> list[Column]:
    return [F.count_if(F.col(c).isNull()).alias(f"{c}_nulls") for c in columns]


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: ``total_rows`` and ``<column>_nulls``."""
    return df.agg(F.count(F.lit(1)).alias("total_rows"), *_nulls(columns))


def keep_raw(df: DataFrame, columns: Sequence[str], name: str = "raw") -> DataFrame:
    """Carry the raw values along in a struct, so cleaned and raw need no self-join."""
    return df.withColumn(name, F.struct(*[F.col(c).cast("string").alias(c) for c in columns]))


def _lost(columns: Sequence[str], raw: str) -> list[Column]:
    return [
        F.count_if(~is_missing(F.col(f"{raw}.{c}"), MISSING_TOKENS) & F.col(c).isNull()).alias(
            f"{c}_transform_nulls"
        )
        for c in columns
    ]


def transform_null_counts(df: DataFrame, columns: Sequence[str], raw: str = "raw") -> DataFrame:
    """One row: ``<column>_transform_nulls``, values that were there and got lost in cleaning."""
    return df.agg(*_lost(columns, raw))


def quality(df: DataFrame, columns: Sequence[str], raw: str = "raw") -> DataFrame:
    """Both counts in one pass."""
    return df.agg(F.count(F.lit(1)).alias("total_rows"), *_nulls(columns), *_lost(columns, raw))


def counted(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Count rows while they are written, instead of in a pass of their own."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def require_rows(df: DataFrame, what: str) -> DataFrame:
    """The frame itself, or an error when it has no rows (stops at the first row found)."""
    if df.isEmpty():
        raise EmptyResultError(f"no rows left in {what}")
    return df
