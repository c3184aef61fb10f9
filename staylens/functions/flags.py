"""Yes/no texts as booleans."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
YES_TEXTS = ("t", "true", "1", "yes", "y")
NO_TEXTS = ("f", "false", "0", "no", "n")
EVENT_YES_TEXTS = ("true", "1", "yes", "y")


def tf_flag(text: Column) -> Column:
    """Listing flags: yes and no texts, anything else NULL."""
    key = F.lower(F.trim(text.cast("string")))
    return F.when(key.isin(*YES_TEXTS), True).when(key.isin(*NO_TEXTS), False)


def event_flag(text: Column) -> Column:
    """Event flags: yes texts are true, empty is NULL, every other text is false."""
    raw = F.nullif(text.cast("string"), F.lit(""))
    return F.lower(F.trim(raw)).isin(*EVENT_YES_TEXTS)
