"""Text cleaning as Column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts that stand for "no value", compared trimmed and lower-cased.
MISSING_TOKENS = ("n/a", "na", "null", "none")
MISSING_NAME_TOKENS = ("n/a", "na", "null", "none", "nan")

# What missing categories become.  "unkown" is how the published
# tables spell it.
NO_NAME = ""
UNKNOWN = "unknown"
UNKNOWN_CATEGORY = "unkown"

# Fixed patterns.
HTML_BREAK = r"<br\s*/?>"
WHITESPACE_RUN = r"\s+"


def is_blank(text: Column) -> Column:
    return text.isNull() | (F.trim(text) == "")


def is_missing(text: Column, tokens: Sequence[str] = MISSING_TOKENS) -> Column:
    """True for NULL, blank and the missing tokens; never NULL itself."""
    key = F.lower(F.trim(F.coalesce(text.cast("string"), F.lit(""))))
    return key.isin("", *tokens)


def category_or(text: Column, default: str, tokens: Sequence[str] = MISSING_NAME_TOKENS) -> Column:
    """Trimmed text, or ``default`` where it is missing.  No tokens: only blank counts."""
    return F.when(is_missing(text, tokens), F.lit(default)).otherwise(F.trim(text))


def html_breaks_to_blanks(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, HTML_BREAK, " "))


def first_filled(text: Column, fallback: Column) -> Column:
    """``fallback`` where the text is NULL or blank."""
    return F.when(is_blank(text), fallback).otherwise(text)


def squeeze_whitespace(text: Column, default: str | None = "") -> Column:
    """One blank for every run of white space, trimmed; NULL becomes ``default``."""
    squeezed = F.trim(F.regexp_replace(text, WHITESPACE_RUN, " "))
    return squeezed if default is None else F.coalesce(squeezed, F.lit(default))


def language_code(text: Column, default: str = UNKNOWN) -> Column:
    return F.coalesce(F.lower(F.trim(text)), F.lit(default))


def alias_fallback(text: Column, other: Column) -> Column:
    """The first of two spellings of a field that is neither NULL nor empty."""
    return F.coalesce(F.nullif(text, F.lit("")), other)
