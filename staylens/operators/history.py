"""Type-2 history: from a stream of events, and from snapshots of a dimension."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from staylens.functions.times import AsOf, clock
from staylens.operators.skew import heavy_keys, salted_left_join

#: Events of a heavy key are put in order minute by minute.
SLICE_SECONDS = 60
#: Where events without a date stand: before all others.
NO_MOMENT = -(1 << 62)


def event_history(
    events: DataFrame,
    key: str = "reviewer_id",
    at: str = "date",
    tie: str = "id",
    heavy: DataFrame | None = None,
) -> DataFrame:
    """Each event is valid from its own date to the date of the key's next event.

    Adds ``start_date``, ``end_date`` and ``is_current``.  Events of a key are ordered
    by (``at``, ``tie``); ``tie`` is unique within a key.  Ordinary keys use one window.
    A heavy key is never gathered in one task: see ``_next_of_heavy``.

    ``heavy`` defaults to ``heavy_keys(events, [key])``.  ``events`` is read by both
    branches, so it should be a table; the heavy branch is dropped at run time when no
    key is heavy.
    """
    if heavy is None:
        heavy = heavy_keys(events, [key])
    # NULL is a key like any other, and can be heavy.
    hot_keys = F.broadcast(heavy.select(F.col(key).alias("_hot")))
    is_hot = F.col(key).eqNullSafe(F.col("_hot"))
    light = plain_event_history(events.join(hot_keys, is_hot, "left_anti"), key, at, tie)
    hot = _next_of_heavy(events.join(hot_keys, is_hot, "left_semi"), key, at, tie)
    return light.unionByName(_with_validity(hot, at))


def plain_event_history(
    events: DataFrame, key: str = "reviewer_id", at: str = "date", tie: str = "id"
) -> DataFrame:
    """The same with one window and nothing else, for input known to have no heavy key."""
    in_order = Window.partitionBy(key).orderBy(at, tie)
    return _with_validity(events.withColumn("end_date", F.lead(at).over(in_order)), at)


def _with_validity(df: DataFrame, at: str) -> DataFrame:
    return df.withColumns({"start_date": F.col(at), "is_current": F.col("end_date").isNull()})


def _next_of_heavy(events: DataFrame, key: str, at: str, tie: str) -> DataFrame:
    """``end_date`` without a window over a key's whole history.

    All events of one moment except the last end at that very moment, so only the
    distinct moments have to be ordered.  They are, first within a slice of time and
    then slice by slice.  Groups are bounded by the clock, not by the row count.

    A missing key or date is a value of its own in the joins; events without a date come
    first, as they do in a window.
    """
    key_and_moment = ["_key", "_moment"]
    marked = events.withColumns(
        {
            "_key": F.coalesce(F.concat(F.lit("="), F.col(key).cast("string")), F.lit("")),
            "_moment": F.coalesce(F.unix_micros(F.col(at).cast("timestamp")), F.lit(NO_MOMENT)),
        }
    )
    moments = (
        marked.groupBy(*key_and_moment)
        .agg(F.max(tie).alias("_last"), F.first(at).alias("_at"))
        .withColumn("_slice", F.floor(F.col("_moment") / (SLICE_SECONDS * 1_000_000)))
    )
    by_slice = Window.partitionBy("_key").orderBy("_slice")
    slices = (
        moments.groupBy("_key", "_slice")
        .agg(F.min_by("_at", "_moment").alias("_first"))
        .withColumn("_after_slice", F.lead("_first").over(by_slice))
        .drop("_first")
    )
    in_slice = Window.partitionBy("_key", "_slice").orderBy("_moment")
    successors = (
        moments.withColumn("_in_slice", F.lead("_at").over(in_slice))
        .join(slices, ["_key", "_slice"])
        .select(*key_and_moment, "_last", F.coalesce("_in_slice", "_after_slice").alias("_next"))
    )
    joined = salted_left_join(marked, successors, key_and_moment, spread=[F.col(tie)])
    return joined.withColumn(
        "end_date", F.when(F.col(tie) == F.col("_last"), F.col("_next")).otherwise(F.col(at))
    ).drop("_last", "_next", *key_and_moment)


def scd2_merge(
    history: DataFrame,
    snapshot: DataFrame,
    key: str,
    tracked: Sequence[str],
    as_of: AsOf = None,
    close_vanished: bool = False,
) -> DataFrame:
    """Next state of a type-2 dimension, given today's snapshot (one row per key).

    * same tracked values: the open row stays as it is
    * changed: the open row is closed at ``as_of`` and a new one opened
    * new key: a row is opened
    * key missing from the snapshot: stays open, or is closed with ``close_vanished``

    Running it again with the same snapshot changes nothing.  The values are compared
    themselves (no hash), NULL equal to NULL.  One join on a key that is unique on both
    sides; closed rows pass through without a shuffle.
    """
    changed = scd2_step(history.filter("is_current"), snapshot, key, tracked, as_of, close_vanished)
    return history.filter(~F.col("is_current")).unionByName(changed)


def scd2_step(
    opened: DataFrame,
    snapshot: DataFrame,
    key: str,
    tracked: Sequence[str],
    as_of: AsOf = None,
    close_vanished: bool = False,
) -> DataFrame:
    """What ``scd2_merge`` makes of the open rows: the next open rows and the newly closed ones.

    Rows that were closed before have no part in it, so a store that keeps them apart neither reads
    nor writes them.
    """
    columns = opened.columns
    now = clock(as_of)
    fresh = snapshot.withColumns(
        {
            "start_date": now,
            "end_date": F.lit(None).cast("timestamp"),
            "is_current": F.lit(True),
        }
    ).select(*[F.col(c).cast(opened.schema[c].dataType).alias(c) for c in columns])
    pairs = opened.select(F.col(key), F.struct(*columns).alias("old")).join(
        fresh.select(F.col(key), F.struct(*columns).alias("new")), key, "full_outer"
    )
    same = reduce(
        lambda a, b: a & b, [F.col(f"old.{c}").eqNullSafe(F.col(f"new.{c}")) for c in tracked]
    )
    old, new = F.col("old"), F.col("new")
    closed = F.struct(
        *[
            (
                now.alias(c)
                if c == "end_date"
                else F.lit(False).alias(c)
                if c == "is_current"
                else F.col(f"old.{c}").alias(c)
            )
            for c in columns
        ]
    )
    vanished = closed if close_vanished else old
    outcome = (
        F.when(new.isNull(), F.array(vanished))
        .when(old.isNull(), F.array(new))
        .when(same, F.array(old))
        .otherwise(F.array(closed, new))
    )
    return pairs.select(F.inline(outcome)).select(*columns)


def insert_only(dimension: DataFrame, snapshot: DataFrame, key: str) -> DataFrame:
    """Type-0 dimension: rows already there never change, unseen keys are added."""
    return dimension.unionByName(unseen_rows(dimension, snapshot, key))


def unseen_rows(dimension: DataFrame, snapshot: DataFrame, key: str) -> DataFrame:
    """The rows that ``insert_only`` adds."""
    return snapshot.select(*dimension.columns).join(dimension.select(key), key, "left_anti")
