"""CSV feeds and Parquet tables, batch and stream."""

from __future__ import annotations

import uuid
import warnings
from collections.abc import Iterable

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from staylens.functions import arrays
from staylens.functions.times import AsOf, clock
from staylens.schemas import is_list, text_for_lists
from staylens.sources.quarantine import RAW, with_raw

# How the CSV feeds are written, and how late a streamed row may be.
CSV_FORMAT = {"header": "true", "multiLine": "true", "quote": '"', "escape": '"'}
WATERMARK_COLUMN, WATERMARK_DELAY = "last_updated", "48 hours"


def parse_list_columns(df: DataFrame, schema: StructType) -> DataFrame:
    lists = {f.name: arrays.list_from_text(F.col(f.name)) for f in schema if is_list(f.dataType)}
    return df.withColumns(lists) if lists else df


def file_stem(path: Column) -> Column:
    """File name without folders and extensions."""
    name = F.regexp_extract(path, r"([^/]+)$", 1)
    return F.regexp_replace(name, r"(\.[^.]+)+$", "")


def place_from_path(path: Column, prefix: str | None = None) -> dict[str, Column]:
    """``city`` and ``country``: the last two ``_`` parts of the file stem, if there are two.

    With ``prefix``, what stems start with (``listings``), the city is all between the prefix
    and the country, so names of several words stay whole: ``listings_new_york_usa``.
    """
    stem = file_stem(path)
    parts = F.split(stem, "_")
    city = F.try_element_at(parts, F.lit(-2))
    if prefix is not None:
        begin = F.lit(f"{prefix}_")
        inner = F.array_join(F.slice(F.split(F.substring(stem, F.length(begin) + 1, F.length(stem)), "_"), 1, F.greatest(F.size(parts) - 1 - len(prefix.split("_")), F.lit(0))), " ")
        city = F.when(stem.startswith(begin) & (inner != ""), inner).otherwise(city)
    return {
        "city": F.when(F.size(parts) >= 2, city),
        "country": F.when(F.size(parts) >= 2, F.try_element_at(parts, F.lit(-1))),
    }


def with_lineage(df: DataFrame, path: Column | None = None, prefix: str | None = None) -> DataFrame:
    """Add ``filename``, ``city`` and ``country`` from the file each row was read from."""
    source = F.col("_metadata.file_path") if path is None else path
    return df.withColumn("filename", source).withColumns(place_from_path(F.col("filename"), prefix))


def with_ingestion_ts(df: DataFrame, as_of: AsOf = None) -> DataFrame:
    return df.withColumn("ingestion_ts", clock(as_of))


def read_csv(
    spark: SparkSession,
    schema: StructType,
    paths: str | Iterable[str],
    as_of: AsOf = None,
    prefix: str | None = None,
    keep_malformed: bool = False,
) -> DataFrame:
    """All files of a CSV feed as one frame, typed, with lineage and ingestion time.

    The files must have the columns of ``schema`` in its order: a moved column is an error, not
    a wrong value.  ``prefix`` is for ``place_from_path``.  ``keep_malformed`` adds the
    text of rows that do not fit the schema, see ``staylens.sources.quarantine``.  Quoted line breaks make a CSV file
    one task, so the feeds should come as many files.
    """
    files = [paths] if isinstance(paths, str) else list(paths or [])
    if not files or not all(files):
        raise ValueError("at least one path is needed")
    columns = text_for_lists(schema)
    reader = spark.read.options(**CSV_FORMAT).option("enforceSchema", "false")
    if keep_malformed:
        reader = reader.option("columnNameOfCorruptRecord", RAW).option("columnPruning", "false")
        columns = with_raw(columns)
    rows = reader.schema(columns).csv(files)
    return with_ingestion_ts(parse_list_columns(with_lineage(rows, prefix=prefix), schema), as_of)


def read_raw_csv(spark: SparkSession, paths: str | Iterable[str]) -> DataFrame:
    """CSV files as they are: the header's columns, every value text.

    Files are read by their own header: those with the same columns in the same order together,
    all of them joined by name.  A column that a file lacks is NULL in its rows.
    """
    files = [paths] if isinstance(paths, str) else list(paths)
    # The first line of every file, with no more than its path: one row per file.
    heads = (
        spark.read.option("wholetext", "false")
        .text(files)
        .select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("at"))
        .filter("at = 0")
        .groupBy("path")
        .agg(F.first("value").alias("header"))
    )
    groups = heads.groupBy("header").agg(F.sort_array(F.collect_list("path")).alias("paths")).orderBy("header").collect()
    if not groups:
        return spark.read.options(**CSV_FORMAT).csv(files)
    return union_files(spark.read.options(**CSV_FORMAT).csv(list(g.paths)) for g in groups)


def stream_csv(
    spark: SparkSession,
    schema: StructType,
    path: str,
    as_of: AsOf = None,
    max_files: int | None = None,
    source: str | None = None,
    keep_malformed: bool = False,
) -> DataFrame:
    """A folder of CSV files as a stream, with a 48 h watermark on ``last_updated``.

    ``source`` names a column for the file each row came in, ``keep_malformed`` is as in ``read_csv``.
    """
    if not path:
        raise ValueError("a path is needed")
    columns = text_for_lists(schema)
    reader = spark.readStream.options(**CSV_FORMAT)
    if keep_malformed:
        reader = reader.option("columnNameOfCorruptRecord", RAW).option("columnPruning", "false")
        columns = with_raw(columns)
    reader = reader.schema(columns)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    rows = reader.csv(path)
    if source:
        rows = rows.withColumn(source, F.col("_metadata.file_path"))
    return with_ingestion_ts(parse_list_columns(rows, schema), as_of).withWatermark(WATERMARK_COLUMN, WATERMARK_DELAY)


def read_tables(spark: SparkSession, *paths: str, merge_schemas: bool = False) -> DataFrame:
    """Parquet folders or globs as one frame.

    ``merge_schemas`` is for files with differing columns; it reads every footer first.
    """
    return spark.read.option("mergeSchema", merge_schemas).parquet(*paths)


def _located(spark: SparkSession, path: str):
    """A Hadoop path and its file system.  Needs a session with a JVM beside it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path or glob matches anything, on whatever file system it lies."""
    target, system = _located(spark, path)
    return bool(system.globStatus(target))


def folder_names(spark: SparkSession, pattern: str) -> list[str]:
    """The names of the folders (or files) that a glob matches."""
    target, system = _located(spark, pattern)
    return [status.getPath().getName() for status in system.globStatus(target) or []]


def partition_folder(spark: SparkSession, column: str, value: str) -> str:
    """The folder name of a partition, odd characters escaped as Spark's writer does."""
    escape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    return f"{column}={escape(value)}"


def hidden_path(path: str, kind: str) -> str:
    """A name beside a table that Spark's readers skip."""
    folder, _, name = path.rstrip("/").rpartition("/")
    return f"{folder}/.{kind}-{name}"


def remove_path(spark: SparkSession, path: str) -> None:
    target, system = _located(spark, path)
    system.delete(target, True)


def read_small(spark: SparkSession, path: str) -> str:
    """A file of a few kilobytes as text."""
    target, system = _located(spark, path)
    stream = system.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_once(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file, complete from the first moment it is seen; ``False`` if it is there already."""
    folder, _, name = path.rpartition("/")
    target, system = _located(spark, path)
    draft, _ = _located(spark, f"{folder}/.{name}-{uuid.uuid4().hex}")
    system.mkdirs(target.getParent())
    stream = system.create(draft, False)
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()
    hadoop = spark._jvm.org.apache.hadoop.fs
    context = hadoop.FileContext.getFileContext(system.getUri(), spark._jsc.hadoopConfiguration())
    strict = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 1)
    strict[0] = hadoop.Options.Rename.NONE  # fails where the target exists
    try:
        context.rename(draft, target, strict)
    except Py4JJavaError as error:
        system.delete(draft, False)
        if "FileAlreadyExistsException" in error.java_exception.getClass().getName():
            return False
        raise
    return True


def publish(spark: SparkSession, fresh: str, path: str) -> None:
    """Put a completely written table in the place of another, which is kept as the previous one.

    Between its two renames the table is absent; ``read_if_there`` then reads the previous one.
    """
    target, system = _located(spark, path)
    previous, _ = _located(spark, hidden_path(path, "previous"))
    written, _ = _located(spark, fresh)
    if system.exists(target):
        system.delete(previous, True)
        if not system.rename(target, previous):
            raise OSError(f"{path} cannot be set aside")
    if not system.rename(written, target):
        raise OSError(f"{fresh} cannot be put in the place of {path}")


def read_if_there(
    spark: SparkSession, path: str, schema: StructType | str | None = None
) -> DataFrame | None:
    """A Parquet table, or ``None`` when nothing has been written there yet."""
    if not path_exists(spark, path):
        path = hidden_path(path, "previous")  # a switch was interrupted, if that is there
        if not path_exists(spark, path):
            return None
    reader = spark.read.schema(schema) if schema is not None else spark.read
    try:
        return reader.parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "UNABLE_TO_INFER_SCHEMA":  # a folder without files
            return None
        raise


def read_optional(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A table that may not be there yet: then a warning and an empty frame."""
    table = read_if_there(spark, path, schema)
    if table is None:
        warnings.warn(f"no data found yet at {path}", stacklevel=2)
        return spark.createDataFrame([], schema)
    return table


def union_files(frames: Iterable[DataFrame]) -> DataFrame:
    """One table from the frames of several files, by column name."""
    first, *rest = frames
    for frame in rest:
        first = first.unionByName(frame, allowMissingColumns=True)
    return first
