"""Mergeable sketches: distinct counts and quantiles of a coarse group from those of finer ones.

A distinct count or a median cannot be had from the counts and medians of the parts of a group.
Its sketches can be merged, so they are kept as columns of a table: a coarser grouping, or a day
more, costs a merge of a few kilobytes per group and reads no base rows again.

Both kinds are aggregated partially before their shuffle, so a group that holds a third of all
rows sends one sketch per task.  Distinct counts have a standard error of 1.04 / sqrt(2^bits), a
quantile is off in rank by about 1 % (k = 200) or 0.5 % (k = 400).  Quantile sketches
draw random bits: a task that runs again may give another sketch, within the same bounds.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS, K = 12, 400


@dataclass(frozen=True)
class Sketches:
    """Which columns of a table are sketched, by the name of the sketch.

    NULL takes no part, as in ``count(distinct)``.  NaN takes no part in quantiles.
    """

    distinct: Mapping[str, str] = field(default_factory=dict)
    quantiles: Mapping[str, str] = field(default_factory=dict)
    bits: int = BITS
    k: int = K

    def of(self, rows: DataFrame, by: Sequence[str]) -> DataFrame:
        """One row per group: its keys, ``n_rows`` and the sketches."""
        hll = [F.hll_sketch_agg(c, F.lit(self.bits)).alias(n) for n, c in self.distinct.items()]
        kll = [F.kll_sketch_agg_double(_number(c), F.lit(self.k)).alias(n) for n, c in self.quantiles.items()]
        return rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows"), *hll, *kll)

    def rolled_up(self, sketched: DataFrame, by: Sequence[str]) -> DataFrame:
        """The same for coarser groups, from the rows of finer ones."""
        hll = [F.hll_union_agg(n).alias(n) for n in self.distinct]
        kll = [F.kll_merge_agg_double(n, F.lit(self.k)).alias(n) for n in self.quantiles]
        return sketched.groupBy(*by).agg(F.sum("n_rows").alias("n_rows"), *hll, *kll)

    def merged(self, sketched: DataFrame, more: DataFrame, by: Sequence[str]) -> DataFrame:
        """A table of sketches after more rows have come, given the sketches of those."""
        return self.rolled_up(sketched.unionByName(more), by)

    def estimates(self, sketched: DataFrame, ranks: Mapping[str, tuple[str, float]]) -> DataFrame:
        """Distinct counts under the names of their sketches; ``ranks`` names quantiles: ``{"median": ("price", 0.5)}``.

        A quantile of a group without any value is NULL.
        """
        found: dict[str, Column] = {n: F.hll_sketch_estimate(n) for n in self.distinct}
        for name, (of, rank) in ranks.items():
            there = F.kll_sketch_get_n_double(of) > 0
            found[name] = F.when(there, F.kll_sketch_get_quantile_double(of, F.lit(rank)))
        return sketched.withColumns(found).drop(*(set(self.quantiles) - set(found)))


def _number(column: str) -> Column:
    value = F.col(column).cast("double")
    return F.when(~F.isnan(value), value)
