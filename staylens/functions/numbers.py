"""Number cleaning as Column expressions.

Everything that meets dirty text uses ``try_cast``: under ANSI mode a plain cast
would stop the job on the first bad row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from staylens.functions.text import MISSING_TOKENS, is_missing

# Fixed patterns: the only number spellings the feeds may use.
DECIMAL_TEXT = r"^[+-]?\d+(\.\d+)?$"
INTEGER_TEXT = r"^[+-]?\d+$"
FLOAT_TEXT = r"^(?i)[+-]?(\d+(_\d+)*\.?(\d+(_\d+)*)?|\.\d+(_\d+)*)(e[+-]?\d+)?$|^(?i)[+-]?(inf|infinity|nan)$"
CURRENCY_MARKS = r"[$,]"
PERCENT_MARK = "%"

# Fixed value: scores lie in this closed range.
SCORE_RANGE = (0, 5)


def _stripped(value: Column, remove: str | None) -> Column:
    text = F.trim(value.cast("string"))
    return F.trim(F.regexp_replace(text, remove, "")) if remove else text


def _parsed(value: Column, pattern: str, type_name: str, remove: str | None, default) -> Column:
    text = _stripped(value, remove)
    number = F.when(text.rlike(pattern), text.try_cast(type_name))
    return number if default is None else F.coalesce(number, F.lit(default).cast(type_name))


def safe_double(value: Column, remove: str | None = None, default: float | None = None) -> Column:
    """Double from text; NULL (or ``default``) for any other spelling."""
    return _parsed(value, DECIMAL_TEXT, "double", remove, default)


def safe_int(value: Column, remove: str | None = None, default: int | None = None) -> Column:
    """Int from text; NULL (or ``default``) for any other spelling or on overflow."""
    return _parsed(value, INTEGER_TEXT, "int", remove, default)


def price_amount(price: Column) -> Column:
    """``$1,200.00`` to 1200.0; missing tokens and unreadable text to NULL."""
    return F.when(~is_missing(price, MISSING_TOKENS), safe_double(price, CURRENCY_MARKS))


def percent_double(rate: Column, default: float | None = 0.0) -> Column:
    return safe_double(rate, PERCENT_MARK, default)


def percent_int(rate: Column, default: int | None = 0) -> Column:
    return safe_int(rate, PERCENT_MARK, default)


def within(value: Column, low: float = SCORE_RANGE[0], high: float = SCORE_RANGE[1]) -> Column:
    """The value where it lies in [low, high], else NULL."""
    return F.when(value.between(low, high), value)


def nan_to(score: Column, default: float = 1.0) -> Column:
    """Float score; NULL and NaN become ``default``."""
    return F.coalesce(F.nanvl(score.cast("double"), F.lit(None).cast("double")), F.lit(default)).cast("float")


def or_zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0))


def ratio_or_zero(numerator: Column, denominator: Column) -> Column:
    """``numerator / denominator`` for a positive denominator, else 0.0."""
    return F.when(denominator > 0, numerator / denominator).otherwise(F.lit(0.0))


def whole_product(left: Column, right: Column, type_name: str = "bigint") -> Column:
    """Product cut (not rounded) to a whole number; NULL when it does not fit.

    Multiplied in single precision, as the published figures are: 0.29 * 100 is 29 there,
    while the widened double product lies just below and would be cut to 28.
    """
    return (left.cast("float") * right.cast("float")).try_cast(type_name)


def event_int(value: Column, type_name: str = "bigint") -> Column:
    """Whole-number field of a raw event: empty is NULL, and so is unreadable text."""
    return _parsed(value, INTEGER_TEXT, type_name, None, None)


def event_float(value: Column) -> Column:
    """Float field of a raw event; type suffixes, as in ``1d``, make it unreadable."""
    text = F.trim(value.cast("string"))
    number = F.regexp_replace(text, "_", "").try_cast("float")
    return F.when(text.rlike(FLOAT_TEXT), number)


def is_unreadable(value: Column, parsed: Column) -> Column:
    """A filled number field whose text did not parse; such a row is rejected."""
    return (F.coalesce(value.cast("string"), F.lit("")) != "") & parsed.isNull()
