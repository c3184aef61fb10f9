"""Report formatting: the last projection before a page shows the numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _number(value: Column) -> Column:
    number = value.cast("double")
    return F.coalesce(F.nanvl(number, F.lit(0.0)), F.lit(0.0))


def thousands(value: Column) -> Column:
    return F.format_number(F.bround(_number(value), 0), 0)


def money(value: Column) -> Column:
    return F.concat(F.lit("$"), F.format_number(_number(value), 0))


def fixed(value: Column, digits: int) -> Column:
    return F.translate(F.format_number(_number(value), digits), ",", "")


def percent_of_fraction(value: Column) -> Column:
    return F.concat(fixed(_number(value) * 100, 2), F.lit("%"))


def percent(value: Column, digits: int) -> Column:
    return F.concat(fixed(value, digits), F.lit("%"))


def title_case(value: Column) -> Column:
    """Every run of letters with a capital first and small letters after: ``Aix-En-Provence``."""
    parts = F.regexp_extract_all(value, F.lit(r"(\p{L}+|\P{L}+)"), F.lit(1))
    shown = F.transform(parts, lambda p: F.concat(F.upper(F.substring(p, 1, 1)), F.lower(F.substring(p, 2, 2**31 - 1))))
    return F.array_join(shown, "")


def place_label(city: Column, neighbourhood: Column) -> Column:
    return F.concat_ws(" · ", title_case(city), neighbourhood)


def list_text(values: Column) -> Column:
    return F.when(F.size(values) > 0, F.array_join(values, ", ")).otherwise(F.lit("-"))
