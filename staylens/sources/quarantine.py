"""Malformed CSV rows: kept apart with their text, file and reason instead of turning into NULLs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType, StringType, StructType

from staylens.schemas import text_for_lists

#: Holds the text of a row that does not fit its schema; NULL in all other rows.
RAW = "_malformed"


def with_raw(schema: StructType) -> StructType:
    """The schema a reader needs to keep the text of malformed rows."""
    return StructType([*schema.fields]).add(RAW, StringType())


def is_malformed(rows: DataFrame) -> Column:
    """Whether a row does not fit, the same in every query.

    The reader converts only the fields that a query uses and finds only those malformed, so the
    condition uses all that can be: the second part holds for any row.
    """
    typed = [F.col(f.name).isNull().cast("int") for f in rows.schema if isinstance(f.dataType, AtomicType) and not isinstance(f.dataType, StringType)]
    used = F.greatest(F.lit(0), F.lit(0), *typed) >= 0
    return F.col(RAW).isNotNull() & used


def without_malformed(rows: DataFrame) -> DataFrame:
    return rows.filter(~is_malformed(rows)).drop(RAW)


def rejected_rows(rows: DataFrame, schema: StructType, csv_format: dict[str, str]) -> DataFrame:
    """``(source_file, reason, line, ingestion_ts)`` of the malformed rows among ``rows``.

    A row is malformed when it has another number of fields than ``schema``, or a field that cannot
    be read as its type; an empty field can be read as any.  The text is taken apart once more, as
    text only, to see which.
    """
    as_text = ", ".join(f"`{name}` STRING" for name in [*schema.names, RAW])
    options = {k: v for k, v in csv_format.items() if k in ("quote", "escape")}
    options |= {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": RAW}
    fields = F.from_csv(F.col(RAW), as_text, options)
    typed = [f for f in text_for_lists(schema) if not isinstance(f.dataType, StringType)]
    unreadable = [
        F.when(F.col("_fields")[f.name].isNotNull() & F.col(f.name).isNull(), F.lit(f.name)) for f in typed
    ]
    reason = F.when(
        F.col("_fields")[RAW].isNotNull(), F.lit(f"not {len(schema)} fields")
    ).otherwise(F.concat(F.lit("unreadable: "), F.concat_ws(", ", *unreadable)))
    return (
        rows.filter(is_malformed(rows))
        .withColumn("_fields", fields)
        .select("source_file", reason.alias("reason"), F.col(RAW).alias("line"), "ingestion_ts")
    )
