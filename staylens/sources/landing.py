"""Landing the batch feeds in bronze."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from staylens.functions.times import AsOf, in_late_window
from staylens.schemas import schema_of
from staylens.sources.files import CSV_FORMAT, file_stem, partition_folder, path_exists, read_csv, remove_path
from staylens.sources.quarantine import is_malformed, rejected_rows, without_malformed
from staylens.sources.sinks import write_table


#: A CSV file with line breaks in its fields is read by one task.  Cutting its output into
#: several files gives the jobs after it their parallelism, without a shuffle.
ROWS_PER_FILE = 1_000_000


def land_listings(
    spark: SparkSession,
    paths: str | Iterable[str],
    target: str,
    as_of: AsOf = None,
    prefix: str | None = None,
    malformed: str | None = None,
) -> DataFrame:
    """Land every listing file under its own name; all files in one job.

    A file that is delivered again replaces its own folder only.  ``prefix``, what file names start
    with, keeps city names of several words whole.  Returns the whole landed table.

    Rows that do not fit the schema land with NULL for what cannot be read, as published.  With
    ``malformed`` they go to that table instead, with file, reason and text, also by file and replaced
    with it.  A delivery is read a second time only if it has such rows.
    """
    rows = read_csv(spark, schema_of("listing"), paths, as_of, prefix, keep_malformed=malformed is not None)
    rows = rows.withColumn("source_file", file_stem(F.col("filename")))
    if malformed is not None:
        seen, whole = Observation("malformed listings"), rows
        counts = [F.count_if(is_malformed(rows)).alias("rows"), F.collect_set("source_file").alias("files")]
        rows = without_malformed(rows.observe(seen, *counts))
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", ROWS_PER_FILE)
        .partitionBy("source_file")
        .parquet(target)
    )
    if malformed is not None:
        for name in seen.get["files"]:
            remove_path(spark, f"{malformed}/{partition_folder(spark, 'source_file', name)}")
        if seen.get["rows"]:
            rejected = rejected_rows(whole, schema_of("listing"), CSV_FORMAT)
            rejected.write.mode("append").partitionBy("source_file").parquet(malformed)
    return spark.read.parquet(target)


def split_late(df: DataFrame, as_of: AsOf = None, column: str = "last_updated") -> tuple[DataFrame, DataFrame]:
    """(rows inside the late-arrival window, all other rows)."""
    on_time = in_late_window(F.col(column), as_of)
    return df.filter(on_time), df.filter(~on_time)


def land_ads(
    spark: SparkSession,
    paths: str | Iterable[str],
    target: str,
    as_of: AsOf = None,
    rejected: str | None = None,
    malformed: str | None = None,
) -> DataFrame | None:
    """Land provider rows inside the late-arrival window; ``None`` when nothing was delivered.

    All files and globs of ``paths`` that are there are read.  Rows outside the window are
    written to ``rejected`` when that is given, rows that do not fit the schema to ``malformed``.
    """
    given = [paths] if isinstance(paths, str) else list(paths)
    there = [p for p in given if path_exists(spark, p)]
    if not there:
        return None
    rows = read_csv(spark, schema_of("adsProviders"), there, as_of, keep_malformed=malformed is not None)
    if rows.isEmpty():
        return None
    if malformed is not None:
        apart = rejected_rows(rows.withColumn("source_file", file_stem(F.col("filename"))), schema_of("adsProviders"), CSV_FORMAT)
        write_table(apart, malformed)
        rows = without_malformed(rows)
    accepted, late = split_late(rows, as_of)
    write_table(accepted, target)
    if rejected:
        write_table(late, rejected)
    return spark.read.parquet(target)
