"""Joins and groupings that survive hot keys.

A key is *heavy* when it holds more rows than one task should take: more than ``share``
of all rows, and more than ``min_rows``.  There cannot be more than ``1 / share`` such
keys, whatever the size of the table.  That is the bound behind every ``broadcast`` here:
at most 100,000 rows of a key and a number.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HEAVY_SHARE = 0.00001
HEAVY_MIN_ROWS = 1_000_000
#: Rows without a key match nothing; they only have to be spread.
NO_KEY_PARTS = 10_000


def heavy_keys(
    rows: DataFrame,
    keys: Sequence[str],
    share: float = HEAVY_SHARE,
    min_rows: int = HEAVY_MIN_ROWS,
) -> DataFrame:
    """The heavy keys with ``_parts``, the number of tasks their rows are worth.

    At most ``1 / share`` rows, whose ``_parts`` add up to at most ``2 / share``.  Reads
    the key columns only; counting is combined on the map side.
    """
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    total = rows.select(F.count(F.lit(1)).alias("_total")).scalar()
    limit = F.greatest(F.lit(share) * total, F.lit(float(min_rows)))
    return counts.filter(F.col("_n") > limit).select(*keys, F.ceil(F.col("_n") / limit).cast("int").alias("_parts"))


def salted_left_join(
    rows: DataFrame,
    groups: DataFrame,
    keys: Sequence[str],
    spread: Sequence[Column],
    heavy: DataFrame | None = None,
) -> DataFrame:
    """``rows`` ⟕ ``groups`` on ``keys``, where ``groups`` has one row per key.

    The rows of a heavy key are spread over as many join keys as they are worth tasks,
    by a hash of ``spread`` (not by a random number: a re-run task must send its rows to
    the same place).  The group row of a heavy key is repeated as often, which makes at
    most ``2 / HEAVY_SHARE`` extra rows.  Rows without a key are spread as well.

    ``heavy`` defaults to ``heavy_keys(rows, keys)``.  Where ``rows`` is itself a join,
    pass the heavy keys of the table the keys come from, which costs a narrow scan.
    """
    if heavy is None:
        heavy = heavy_keys(rows, keys)
    parts = F.broadcast(heavy.select(*keys, "_parts"))
    no_key = F.lit(False)
    for key in keys:
        no_key = no_key | F.col(key).isNull()
    tasks = F.when(no_key, NO_KEY_PARTS).otherwise(F.coalesce("_parts", F.lit(1)))
    salted_rows = rows.join(parts, list(keys), "left").withColumn(
        "_salt", F.when(tasks > 1, F.pmod(F.xxhash64(*spread), tasks)).otherwise(0).cast("int")
    )
    salted_groups = groups.join(parts, list(keys), "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1))
    )
    return (
        salted_rows.drop("_parts")
        .join(salted_groups.drop("_parts"), [*keys, "_salt"], "left")
        .drop("_salt")
    )
