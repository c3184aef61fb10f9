"""One commit for the tables of a layer.

A layer with versions keeps its tables in folders of their own, which no later commit changes:

    <layer>/<table>/v00000007-<id>/            rows that the next commit replaces
    <layer>/<table>/v00000007-<id>/_part=...   where only some of the rows are replaced
    <layer>/_versions/00000007.json            which folders make up every table

A commit writes its folders first and then one small file, which is created only if its number
is still free.  Before that nothing of it is seen, after that all of it; a job that dies half-way
leaves all tables as they were.  A file system needs a rename that fails where the target exists
(HDFS and local ones have it; on object stores let one job at a time write a layer).
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Mapping
from dataclasses import asdict, dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from staylens.sources.files import folder_names, path_exists, read_if_there, read_small, remove_path, write_once

LOG = "_versions"
#: The two sides of a table that is replaced in part.
OPEN, CLOSED = "_part=open", "_part=closed"


class VersionConflictError(RuntimeError):
    """Another job has committed to a table since this one read it."""


@dataclass(frozen=True)
class Parts:
    """The folders of a table, from the layer's folder on."""

    replaced: str | None = None
    kept: tuple[str, ...] = ()

    @property
    def folders(self) -> list[str]:
        return [*([self.replaced] if self.replaced else []), *self.kept]


@dataclass(frozen=True)
class Version:
    """A state of a layer; number 0 is the one before the first commit."""

    number: int
    tables: Mapping[str, Parts]


def places(tables: Mapping[str, Parts]) -> set[str]:
    """The folders that single commits wrote and these tables consist of."""
    return {"/".join(folder.split("/")[:2]) for parts in tables.values() for folder in parts.folders}


def _numbers(spark: SparkSession, layer: str) -> list[int]:
    return sorted(int(name.partition(".")[0]) for name in folder_names(spark, f"{layer}/{LOG}/*.json"))


def _log_file(layer: str, number: int) -> str:
    return f"{layer}/{LOG}/{number:08d}.json"


def _read(spark: SparkSession, layer: str, number: int) -> Version:
    tables = json.loads(read_small(spark, _log_file(layer, number)))
    return Version(number, {t: Parts(p["replaced"], tuple(p["kept"])) for t, p in tables.items()})


def latest(spark: SparkSession, layer: str) -> Version:
    """The state that readers see."""
    numbers = _numbers(spark, layer)
    return _read(spark, layer, numbers[-1]) if numbers else Version(0, {})


def is_versioned(spark: SparkSession, layer: str) -> bool:
    return path_exists(spark, f"{layer}/{LOG}/*.json")


def _frame(spark: SparkSession, layer: str, folders: Iterable[str]) -> DataFrame | None:
    paths = [f"{layer}/{folder}" for folder in folders]
    if not paths:
        return None
    try:
        return spark.read.parquet(*paths)
    except AnalysisException as error:
        if error.getCondition() == "UNABLE_TO_INFER_SCHEMA":  # folders without files
            return None
        raise


def read_available(
    spark: SparkSession, layer: str, tables: Iterable[str], version: Version | None = None
) -> dict[str, DataFrame]:
    """The tables of a layer that are there, by name, all of one version.

    Tables that the layer's log does not name are read as plain folders.
    """
    state = version or latest(spark, layer)
    reads = {
        table: _frame(spark, layer, state.tables[table].folders)
        if table in state.tables
        else read_if_there(spark, f"{layer}/{table}.parquet")
        for table in tables
    }
    return {table: df for table, df in reads.items() if df is not None}


def read_replaced(spark: SparkSession, layer: str, table: str, version: Version | None = None) -> DataFrame | None:
    """Only the rows that a later commit may replace, such as the open rows of a history."""
    parts = (version or latest(spark, layer)).tables.get(table, Parts())
    return _frame(spark, layer, [parts.replaced] if parts.replaced else [])


def write_part(df: DataFrame, layer: str, table: str, base: Version, replaceable: Column | None = None) -> Parts:
    """Write a table's next folder and say what the table then consists of.

    Without ``replaceable`` the rows take the place of the whole table.  With it they are what
    changes: those that meet it take the place of the rows that met it before, the others are added
    to the ones that stay for good, which are neither read nor written.
    """
    spark = df.sparkSession
    place = f"{table}/v{base.number + 1:08d}-{uuid.uuid4().hex[:12]}"
    if replaceable is None:
        df.write.parquet(f"{layer}/{place}")
        return Parts(place)
    sides = F.when(replaceable, F.lit("open")).otherwise(F.lit("closed"))
    df.withColumn("_part", sides).write.partitionBy("_part").parquet(f"{layer}/{place}")
    there = {side: path_exists(spark, f"{layer}/{place}/{side}") for side in (OPEN, CLOSED)}
    kept = base.tables.get(table, Parts()).kept
    return Parts(
        f"{place}/{OPEN}" if there[OPEN] else None,
        (*kept, f"{place}/{CLOSED}") if there[CLOSED] else kept,
    )


def commit(spark: SparkSession, layer: str, base: Version, changed: Mapping[str, Parts]) -> Version:
    """Make ``changed`` the state of these tables, all at once.

    ``base`` is the version the changes were made from.  Commits of other jobs to other tables
    in the meantime are kept; one to the same tables is a ``VersionConflictError``.
    """
    while True:
        now = latest(spark, layer)
        moved = [t for t in changed if now.tables.get(t) != base.tables.get(t)]
        if moved:
            raise VersionConflictError("changed by another job meanwhile: " + ", ".join(moved))
        fresh = Version(now.number + 1, {**now.tables, **changed})
        text = json.dumps({t: asdict(p) for t, p in sorted(fresh.tables.items())}, indent=1)
        if write_once(spark, _log_file(layer, fresh.number), text):
            return fresh


def vacuum(spark: SparkSession, layer: str, keep: int = 10) -> list[str]:
    """Remove folders that the last ``keep`` versions do not name, and older versions.

    Folders that a running job writes carry a later number and stay.  A query that reads a version
    older than these fails, so ``keep`` has to span the longest query.
    """
    if keep < 1:
        raise ValueError("the last version has to stay")
    numbers = _numbers(spark, layer)
    if not numbers:
        return []
    states = [_read(spark, layer, n) for n in numbers[-keep:]]
    needed = set().union(*(places(state.tables) for state in states))
    removed = []
    for table in states[-1].tables:
        for name in folder_names(spark, f"{layer}/{table}/v*"):
            place = f"{table}/{name}"
            if place not in needed and int(name[1:9]) <= numbers[-1]:
                remove_path(spark, f"{layer}/{place}")
                removed.append(place)
    for number in numbers[:-keep]:
        remove_path(spark, _log_file(layer, number))
    return removed
