"""What the operators share: staged tables, Arrow batches, worker set-up."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from staylens.session import work_path


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate to the shared folder and read it back.

    Its lineage is cut, several readers share it, and a lost executor costs a re-read.
    """
    spark = df.sparkSession
    path = work_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def on_workers(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver did."""
    root = str(Path(__file__).resolve().parents[2])
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(":"):
        spark.sparkContext.environment["PYTHONPATH"] = f"{root}:{known}".rstrip(":")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(column: pa.Array) -> list[str]:
    """The strings of a column; a null counts as empty."""
    return [x or "" for x in column.to_pylist()]


def utf8(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of a string column; a null counts as empty."""
    return [x or b"" for x in column.cast(pa.binary() if column.type != pa.large_string() else pa.large_binary()).to_pylist()]


def map_rows(
    df: DataFrame, function: Callable[[pa.RecordBatch], Iterable[pa.RecordBatch] | pa.RecordBatch], schema: str
) -> DataFrame:
    """``mapInArrow`` with a function of one batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield function(batch)

    return df.mapInArrow(run, schema)


def whole_partition(batches: Iterator[pa.RecordBatch]) -> pa.Table | None:
    """The batches of one partition as one table; None when there is no row."""
    found = [b for b in batches if b.num_rows]
    return pa.Table.from_batches(found) if found else None
