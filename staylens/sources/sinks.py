"""Writing tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from staylens.operators.profile import counted
from staylens.sources.files import hidden_path, path_exists, publish, remove_path
from staylens.sources.versions import Version, commit, is_versioned, latest, places, write_part


@dataclass(frozen=True)
class TableStatus:
    table: str
    rows: int | None = None
    error: str | None = None

    @property
    def ok(self) -> bool:
        return self.error is None


class TablesFailedError(RuntimeError):
    """Some tables of a job could not be written; ``statuses`` tells which and why."""

    def __init__(self, statuses: Sequence[TableStatus]) -> None:
        self.statuses = list(statuses)
        failed = [f"{s.table}: {s.error}" for s in statuses if not s.ok]
        super().__init__("tables not written: " + "; ".join(failed))


def write_table(
    df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] = ()
) -> None:
    """Write Parquet.  ``overwrite`` replaces the whole table, also a partitioned one.

    A table that is there is replaced by renaming, once its successor is written completely: a
    write that fails leaves it as it was.  Its last state is kept beside it, hidden.
    """
    spark = df.sparkSession
    replace = mode == "overwrite" and path_exists(spark, path)
    target = hidden_path(path, "new") if replace else path
    writer = df.write.mode(mode).option("partitionOverwriteMode", "static")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(target)
    if replace:
        publish(spark, target, path)


def write_tables(
    tables: Mapping[str, DataFrame],
    folder: str,
    mode: str = "overwrite",
    partition_by: Mapping[str, Sequence[str]] | None = None,
    versioned: bool | None = None,
) -> list[TableStatus]:
    """Write every table; one that fails does not keep the others from being written.

    Rows are counted during the write.  Raises ``TablesFailedError`` at the end if any failed.

    With ``versioned`` all tables are replaced by one commit, and none when any of them fails: see
    ``write_versions``.  By default a layer stays as it is in this.
    """
    if tables and mode == "overwrite" and not partition_by:
        spark = next(iter(tables.values())).sparkSession
        if versioned or (versioned is None and is_versioned(spark, folder)):
            return write_versions(spark, tables, folder)
    elif versioned:
        raise ValueError("tables with versions are overwritten as a whole, without partitions")
    statuses = []
    for name, df in tables.items():
        watched, seen = counted(df, f"rows of {name}")
        try:
            write_table(
                watched, f"{folder}/{name}.parquet", mode, (partition_by or {}).get(name, ())
            )
            statuses.append(TableStatus(name, rows=seen.get.get("rows")))
        except Exception as error:  # noqa: BLE001 - reported per table below
            statuses.append(TableStatus(name, error=str(error).splitlines()[0]))
    if not all(s.ok for s in statuses):
        raise TablesFailedError(statuses)
    return statuses


def write_versions(
    spark: SparkSession,
    tables: Mapping[str, DataFrame],
    folder: str,
    replaceable: Mapping[str, Column] | None = None,
    base: Version | None = None,
) -> list[TableStatus]:
    """Write all tables and switch to them in one commit; if any fails, none is switched.

    A table in ``replaceable`` gives only what changes: rows that meet the condition take the place
    of those that met it before, the others are added to the rows that stay for good.  ``base`` is
    the version the tables were made from, the latest by default.
    """
    base = base or latest(spark, folder)
    statuses, parts = [], {}
    for name, df in tables.items():
        watched, seen = counted(df, f"rows of {name}")
        try:
            parts[name] = write_part(watched, folder, name, base, (replaceable or {}).get(name))
            statuses.append(TableStatus(name, rows=seen.get.get("rows")))
        except Exception as error:  # noqa: BLE001 - reported per table below
            statuses.append(TableStatus(name, error=str(error).splitlines()[0]))
    if not all(s.ok for s in statuses):
        for place in places(parts) - places(base.tables):
            remove_path(spark, f"{folder}/{place}")
        raise TablesFailedError(statuses)
    commit(spark, folder, base, parts)
    return statuses


def review_messages(reviews: DataFrame, max_records: int | None = None) -> DataFrame:
    """Reviews as messages: key is the review id, value the row as JSON (NULL fields kept)."""
    rows = reviews if max_records is None else reviews.orderBy("id").limit(max_records)
    value = F.to_json(F.struct(*reviews.columns), {"ignoreNullFields": "false"})
    return rows.select(F.coalesce(F.col("id").cast("string"), F.lit("")).alias("key"), value.alias("value"))


def send_reviews(
    reviews: DataFrame, servers: str, topic: str, max_records: int | None = None
) -> None:
    """Publish reviews to Kafka (needs Spark's Kafka package on the cluster)."""
    (
        review_messages(reviews, max_records)
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .save()
    )
