"""Timestamps from text, and the job's clock."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: how late or early a provider row may be.
LATE_WINDOW = "48 hours"

AsOf = datetime | str | Column | None


def clock(as_of: AsOf = None) -> Column:
    """The job's clock: ``as_of`` when given (reproducible runs), else now."""
    if as_of is None:
        return F.current_timestamp()
    if isinstance(as_of, Column):
        return as_of.cast("timestamp")
    return F.lit(as_of).cast("timestamp")


def timestamp_or_null(value: Column) -> Column:
    """Timestamp from text (or timestamp); unreadable text is NULL, never an error."""
    return value.try_cast("timestamp")


def first_timestamp(*values: Column, as_of: AsOf = None) -> Column:
    """The first value that reads as a timestamp, else the job's clock."""
    return F.coalesce(*[timestamp_or_null(v) for v in values], clock(as_of))


# Fixed pattern: text that may be a moment starts with a whole date.
WHOLE_DATE = r"^\s*\d{4}-\d{2}-\d{2}"


def iso_text(value: Column) -> Column:
    """ISO-8601 text in UTC for text with a date that reads as a timestamp (no zone: UTC).

    Empty is NULL; text that is no timestamp, such as a year or a time of day alone, passes
    through unchanged.
    """
    text = F.nullif(value.cast("string"), F.lit(""))
    moment = F.when(text.rlike(WHOLE_DATE), timestamp_or_null(F.trim(text)))
    whole = F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.date_format(moment, ".SSSSSS")
    shown = F.concat(
        whole, F.when(micros == ".000000", F.lit("")).otherwise(micros), F.lit("+00:00")
    )
    return F.coalesce(shown, text)


def in_late_window(moment: Column, as_of: AsOf = None, window: str = LATE_WINDOW) -> Column:
    """Inside ``as_of`` ± ``window``, bounds included; NULL moments are outside."""
    now, span = clock(as_of), F.expr(f"INTERVAL '{window.split()[0]}' {window.split()[1].rstrip('s')}")
    return F.coalesce(moment.between(now - span, now + span), F.lit(False))
