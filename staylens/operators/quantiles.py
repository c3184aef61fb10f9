"""Quantiles per group."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from staylens.operators.skew import heavy_keys

#: Value bins per doubling of the value, at every magnitude, and parts a bin is then cut into.
#: Of FLOAT values a part of a bin holds 8 distinct ones, of DOUBLE values about 4 million.
BINS_PER_OCTAVE = 1024
PARTS_PER_BIN = 1 << 20
#: Above the logarithm of any double, in bins; keeps the bins of either sign apart from zero.
_OFFSET = 1100 * BINS_PER_OCTAVE

Measures = Mapping[str, tuple[Column, float]]


def _coarse_bin(value: Column) -> Column:
    """A whole number that never falls as the value grows: logarithmic bins, signed.

    NaN is above all other values, as ``percentile`` has it.
    """
    infinite = F.abs(value) == float("inf")
    size = F.when(infinite, 4 * _OFFSET).otherwise(F.floor(F.log2(F.abs(value)) * BINS_PER_OCTAVE) + _OFFSET)
    return (
        F.when(F.isnan(value), F.lit(8 * _OFFSET).cast("long"))
        .when(value > 0, size)
        .when(value < 0, -size)
        .otherwise(F.lit(0).cast("long"))
    )


def _part(value: Column, low: Column, high: Column) -> Column:
    """The part of [low, high] that holds the value; 0 where there is nothing to cut."""
    width = F.when((high > low) & (F.abs(high) < float("inf")) & (F.abs(low) < float("inf")), high - low)
    return F.coalesce(F.floor((value - low) / width * PARTS_PER_BIN), F.lit(0).cast("long"))


def _match(left: str, right: str, keys: Sequence[str]) -> Column:
    return reduce(
        lambda a, b: a & b, [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys]
    )


def lower_median(column: str) -> Column:
    """The exact median, of two middle values the lower one: an aggregate for whole numbers of a small range.

    Counted per distinct value before and after the shuffle, so a group costs as many entries as it
    has distinct values, however many rows.  NULL values do not count.  The result is a double.
    """
    return F.expr(f"percentile_disc(0.5) WITHIN GROUP (ORDER BY `{column}`)")


def exact_quantiles(
    rows: DataFrame, keys: Sequence[str], measures: Measures, heavy: DataFrame | None = None
) -> DataFrame:
    """Exact quantiles with linear interpolation: one row per group, one column per measure.

    ``measures`` maps an output name to (value, fraction).  NULL values do not count.

    ``percentile`` keeps the distinct values of a group in one task, which is right for
    ordinary groups.  A heavy group is never gathered: see ``_quantiles_of_heavy``.
    ``heavy`` defaults to ``heavy_keys(rows, keys)``; where ``rows`` is a join, pass the
    heavy keys of the table the keys come from.
    """
    if heavy is None:
        heavy = heavy_keys(rows, keys)
    hot_keys = F.broadcast(heavy.select(*keys)).alias("h")
    is_hot = _match("r", "h", keys)
    light = (
        rows.alias("r")
        .join(hot_keys, is_hot, "left_anti")
        .groupBy(*keys)
        .agg(*[F.percentile(v.cast("double"), F.lit(p)).alias(n) for n, (v, p) in measures.items()])
    )
    hot = rows.alias("r").join(hot_keys, is_hot, "left_semi")
    return light.unionByName(_quantiles_of_heavy(hot, keys, measures))


def _holding(sizes: DataFrame, keys: Sequence[str], cut: str, start: Column) -> DataFrame:
    """The cuts that hold ``_rank``, with ``_before``, the values before them.

    ``sizes`` has one row per cut, its values in ``_bin_n``; ``start`` are the values before
    the first.
    """
    order = Window.partitionBy(*keys).orderBy(cut).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return sizes.withColumn("_before", start + F.sum("_bin_n").over(order) - F.col("_bin_n")).filter(
        (F.col("_before") <= F.ceil("_rank")) & (F.col("_before") + F.col("_bin_n") > F.floor("_rank"))
    )


def _quantiles_of_heavy(rows: DataFrame, keys: Sequence[str], measures: Measures) -> DataFrame:
    """The same without gathering a group.

    The rows are first reduced to a count per value (combined on the map side).  Running
    counts over value bins then point to the bins that hold the wanted rank, running counts
    over the parts of these to the parts that do, and only those are looked at value by value.
    """
    group = [*keys, "_measure"]
    values = rows.select(
        *keys,
        F.explode(
            F.array(
                *[
                    F.struct(
                        F.lit(name).alias("_measure"),
                        F.lit(float(p)).alias("_p"),
                        value.cast("double").alias("_v"),
                    )
                    for name, (value, p) in measures.items()
                ]
            )
        ).alias("_m"),
    ).select(*keys, "_m.*")
    counted = (
        values.filter(F.col("_v").isNotNull())
        .groupBy(*group, "_p", "_v")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_bin", _coarse_bin(F.col("_v")))
    )
    total = Window.partitionBy(*group)
    sizes = counted.groupBy(*group, "_p", "_bin").agg(
        F.sum("_n").alias("_bin_n"), F.min("_v").alias("_from"), F.max("_v").alias("_to")
    )
    ranks = sizes.withColumn("_rank", F.col("_p") * (F.sum("_bin_n").over(total) - 1))
    bins = _holding(ranks, group, "_bin", F.lit(0).cast("long"))
    in_bins = counted.alias("c").join(bins.alias("b"), _match("c", "b", [*group, "_bin"]))
    cut = in_bins.select(
        *[F.col(f"c.{k}").alias(k) for k in [*group, "_bin"]],
        "_v",
        "_n",
        "_rank",
        F.col("_before").alias("_start"),
        _part(F.col("_v"), F.col("_from"), F.col("_to")).alias("_part"),
    )
    finer = [*group, "_bin", "_rank", "_start"]
    part_sizes = cut.groupBy(*finer, "_part").agg(F.sum("_n").alias("_bin_n"))
    parts = _holding(part_sizes, finer, "_part", F.col("_start"))
    inside = cut.alias("c").join(
        parts.select(*[k for k in finer if k != "_rank"], "_part", "_before").alias("b"),
        _match("c", "b", [*group, "_bin", "_part"]),
    )
    in_part = (
        Window.partitionBy(*[F.col(f"c.{k}") for k in [*group, "_bin", "_part"]])
        .orderBy("_v")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    ranked = inside.select(
        *[F.col(f"c.{k}").alias(k) for k in group],
        "_v",
        "_rank",
        (F.col("_before") + F.sum("_n").over(in_part)).alias("_end"),
        "_n",
    )

    def value_at(position: Column) -> Column:
        here = (F.col("_end") - F.col("_n") <= position) & (F.col("_end") > position)
        return F.max(F.when(here, F.col("_v")))

    found = ranked.groupBy(*group, "_rank").agg(
        value_at(F.floor("_rank")).alias("_low"), value_at(F.ceil("_rank")).alias("_high")
    )
    # As ``percentile`` does: equal neighbours are the quantile themselves, infinite or not.
    quantile = F.when(F.col("_low") == F.col("_high"), F.col("_low")).otherwise(
        (F.ceil("_rank") - F.col("_rank")) * F.col("_low") + (F.col("_rank") - F.floor("_rank")) * F.col("_high")
    )
    return (
        found.withColumn("_q", quantile)
        .groupBy(*keys)
        .agg(
            *[F.max(F.when(F.col("_measure") == name, F.col("_q"))).alias(name) for name in measures]
        )
    )
