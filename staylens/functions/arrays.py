"""List columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

STRINGS = "array<string>"

# Fixed values.
DEFAULT_LABEL = "positive"
BOOST_LIMIT = 20000
BOOST_ABOVE, BOOST_OTHERWISE = "low", "high"


def empty_strings() -> Column:
    return F.array().cast(STRINGS)


def list_or_empty(values: Column) -> Column:
    return F.coalesce(values, empty_strings())


def list_from_text(text: Column) -> Column:
    """``['a', "b's"]`` to an array.  NULL, blank and unreadable text are NULL."""
    return F.when(F.trim(text) != "", F.from_json(text, STRINGS))


def list_from_loose_text(text: Column) -> Column:
    """A bracketed list, or else comma-separated items; items trimmed, blanks dropped."""
    raw = F.trim(F.nullif(text, F.lit("")))
    bracketed = F.when(raw.startswith("[") & raw.endswith("]"), F.from_json(raw, STRINGS))
    items = F.coalesce(bracketed, F.split(raw, ","))
    return F.filter(F.transform(items, lambda item: F.trim(item)), lambda item: item != "")


def labels_or_default(labels: Column, default: str = DEFAULT_LABEL) -> Column:
    """Labels lower-cased and trimmed; NULL and empty become one default label."""
    cleaned = F.transform(labels, lambda label: F.lower(F.trim(label)))
    return F.when(F.size(labels) > 0, cleaned).otherwise(F.array(F.lit(default)))


def boost_level(avg_revenue: Column, limit: float = BOOST_LIMIT) -> Column:
    """``['low']`` above the limit, else (also for NULL) ``['high']``."""
    return F.array(F.when(avg_revenue > limit, F.lit(BOOST_ABOVE)).otherwise(F.lit(BOOST_OTHERWISE)))


def list_size(values: Column) -> Column:
    return F.size(list_or_empty(values))
