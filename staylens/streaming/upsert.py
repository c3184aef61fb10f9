"""Silver reviews kept up to date from a stream, on plain Parquet.

The table only ever grows.  Batch N writes its rows to ``batch_id=N``: reviews not seen
before or delivered again later, and a new version of every older review whose ``end_date``
they changed.  Reading takes the newest version of each review.  No existing file is
rewritten, a replayed batch overwrites its own folder and looks only at earlier ones, so every
batch has the same effect however often it runs.

Of several copies of a review the latest wins, in whatever batches and order they come, as in
the batch job.  A copy may name another reviewer or date: then it leaves its old place, whose
neighbours are put in order again, and a row marked ``gone`` is left there.

Rows lie in buckets by reviewer and, within them, in slices of the review's date, some months each.  A narrow table
beside the rows (``_index``) tells a batch what to read, so that it reads neither whole
reviewers nor whole tables:

* by review id, in buckets of it: where the latest copy of a review stands and how late that copy is.
  A batch reads the buckets of its own ids.
* by reviewer, in the rows' buckets: the slices in which reviews of a reviewer were put, how many, and
  whether one left.  A review changes what comes after it and the one right before it, so a batch
  needs a reviewer's slices from the first changed place on, and back to the last one that surely
  still holds one of the reviewer's reviews.  Older slices are not opened.

``compact`` joins many small batches, and turns tables without an index into ones that have it.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from staylens.functions.times import AsOf
from staylens.operators.dedupe import dedupe_latest
from staylens.operators.history import event_history, plain_event_history
from staylens.operators.schema_ops import cast_to_schema
from staylens.operators.skew import HEAVY_MIN_ROWS
from staylens.plans.silver_reviews import delivered_reviews
from staylens.schemas import REVIEW, schema_of
from staylens.sources.files import folder_names, path_exists, read_if_there
from staylens.sources.sinks import write_table
from staylens.streaming.drain import batch_folder, drain
from staylens.streaming.messages import bronze_reviews

#: Reviewer buckets of a table, and months in a slice of dates.  Large tables want thousands of buckets and
#: slices of a month; ``compact`` changes both.
BUCKETS = 16
MONTHS = 12

#: Batch number of compacted rows; a stream counts from 0.
COMPACTED = -1

_HISTORY = ("start_date", "end_date", "is_current")
_DELIVERED = "delivered_ts TIMESTAMP, delivered_tie BIGINT"
_WRITTEN = f"{REVIEW}, {_DELIVERED}, gone BOOLEAN"
_FOLDERS = "batch_id BIGINT, buckets INT, bucket INT"
_STORED = f"{_WRITTEN}, {_FOLDERS}, months INT, slice INT"
_IDS = f"id BIGINT, reviewer_id BIGINT, date TIMESTAMP, {_DELIVERED}"
_INDEX = f"{_IDS}, slice INT, n BIGINT, emptied BOOLEAN, kind STRING, {_FOLDERS}"

#: Folder filters with more parts than this become a range of slices.
MOST_SLICES = 1000


def _bucket(buckets: int, key: str = "reviewer_id") -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def _slice(at: str | Column, months: int) -> Column:
    """The slice of a moment, counted from year 0; reviews without a date stand before all others."""
    return F.coalesce(F.floor((F.year(at) * 12 + F.month(at) - 1) / months), F.lit(0)).cast("int")


def _index(path: str) -> str:
    """A table inside the table's folder, which readers of the rows skip."""
    return f"{path.rstrip('/')}/_index"


def stored_versions(spark: SparkSession, path: str) -> DataFrame | None:
    return read_if_there(spark, path, _STORED)


def _newest(versions: DataFrame) -> DataFrame:
    """The newest version of each review.

    A review that moved has a row marked ``gone`` in its old bucket, of the same batch as its
    new version: whether or not the new one is among ``versions``, the old one is not shown.
    """
    latest = [F.col("batch_id").desc(), F.col("gone")]
    return dedupe_latest(versions, ["id"], latest, ties=["id"]).filter(~F.col("gone"))


def read_reviews(spark: SparkSession, path: str) -> DataFrame:
    """Silver reviews: the newest version of each."""
    versions = stored_versions(spark, path)
    if versions is None:
        return spark.createDataFrame([], schema_of("Review"))
    return _newest(versions).select(*schema_of("Review").names)


def compact(
    spark: SparkSession, path: str, target: str, buckets: int = BUCKETS, months: int = MONTHS
) -> None:
    """Write the current reviews as one fresh table, to replace a long row of batches.

    They become a batch older than any of the stream's, so the same stream goes on in
    ``target``, and a batch it hands out again cannot overwrite them.
    """
    versions = stored_versions(spark, path)
    if versions is None:
        return
    kept = _newest(versions).select(*StructType.fromDDL(_WRITTEN).names)
    _write(kept, batch_folder(target, COMPACTED), buckets, months)
    rows = stored_versions(spark, target)
    _write_index(rows, _added_places(rows, months), target, COMPACTED, buckets)


def _write(rows: DataFrame, folder: str, buckets: int, months: int) -> None:
    # One file per bucket and slice where that is small; one with a hot reviewer is split.
    layout = {"buckets": F.lit(buckets), "months": F.lit(months), "bucket": _bucket(buckets), "slice": _slice("date", months)}
    write_table(rows.withColumns(layout).hint("rebalance", "bucket", "slice"), folder, partition_by=list(layout))


def _write_index(accepted: DataFrame, places: DataFrame, path: str, batch_id: int, buckets: int) -> None:
    ids = accepted.select(*StructType.fromDDL(_IDS).names, F.lit("id").alias("kind"), _bucket(buckets, "id").alias("bucket"))
    of_reviewers = places.withColumns({"kind": F.lit("place"), "bucket": _bucket(buckets)})
    rows = ids.unionByName(of_reviewers, allowMissingColumns=True).withColumn("buckets", F.lit(buckets))
    folder = batch_folder(_index(path), batch_id)
    write_table(rows.hint("rebalance", "kind", "bucket"), folder, partition_by=["kind", "buckets", "bucket"])


def _added_places(rows: DataFrame, months: int) -> DataFrame:
    by_place = rows.groupBy("reviewer_id", _slice("date", months).alias("slice"))
    return by_place.agg(F.count(F.lit(1)).alias("n")).withColumn("emptied", F.lit(False))


def accepted_rows(fresh: DataFrame, ids: DataFrame | None) -> DataFrame:
    """The rows of a batch that are new or later than the stored copy of the review.

    ``ids`` tells the places and ages of earlier copies.  ``old_reviewer`` and ``old_date`` tell
    where the latest of them stands.
    """
    if ids is None:
        return fresh.withColumns(
            {"old_reviewer": F.lit(None).cast("bigint"), "old_date": F.lit(None).cast("timestamp")}
        )
    own = ids.join(fresh.select("id"), "id", "left_semi")
    stored = dedupe_latest(own, ["id"], [F.col("batch_id").desc()], ties=["id"]).select(
        "id",
        F.col("reviewer_id").alias("old_reviewer"),
        F.col("date").alias("old_date"),
        F.struct("delivered_ts", (-F.col("delivered_tie").cast("decimal(20)")).alias("tie")).alias("_old"),
    )
    # NULL stands below any moment in a struct, as an undated copy does.
    later = F.struct("delivered_ts", (-F.col("delivered_tie").cast("decimal(20)")).alias("tie")) > F.col("_old")
    return fresh.join(stored, "id", "left").filter(F.col("_old").isNull() | later).drop("_old")


def touched_reviewers(accepted: DataFrame) -> DataFrame:
    """``(reviewer_id, _from)``: whose order changes, and from which place on."""
    new = accepted.select("reviewer_id", F.struct("date", "id").alias("_at"))
    old = accepted.filter(F.col("old_reviewer").isNotNull()).select(
        F.col("old_reviewer").alias("reviewer_id"), F.struct(F.col("old_date").alias("date"), "id").alias("_at")
    )
    return new.unionByName(old).groupBy("reviewer_id").agg(F.min("_at").alias("_from"))


def _moved(accepted: DataFrame, months: int) -> DataFrame:
    """Accepted copies that stand in another folder, or under another reviewer, than the one before."""
    elsewhere = (F.col("old_reviewer") != F.col("reviewer_id")) | (_slice("old_date", months) != _slice("date", months))
    return accepted.filter(F.col("old_reviewer").isNotNull() & elsewhere)


def changed_places(accepted: DataFrame, months: int) -> DataFrame:
    """``(reviewer_id, slice, n, emptied)``: where a batch puts reviews, and where one has left."""
    left = _moved(accepted, months).select(
        F.col("old_reviewer").alias("reviewer_id"), _slice("old_date", months).alias("slice"),
        F.lit(0).cast("bigint").alias("n"), F.lit(True).alias("emptied"),
    )
    return _added_places(accepted, months).unionByName(left.distinct())


def needed_places(touched: DataFrame, places: DataFrame, months: int) -> DataFrame:
    """``(reviewer_id, slice, n)``: the stored slices a batch has to read of its reviewers.

    From the slice of the first changed place on, and what may hold the review right before it:
    the last slice from which none has left, and those after it.
    """
    known = (
        places.join(touched, "reviewer_id")
        .groupBy("reviewer_id", "slice")
        .agg(F.sum("n").alias("n"), F.max("emptied").alias("emptied"), F.first("_from.date").alias("_from"))
    )
    # A row per slice of the reviewer: few, however many reviews there are.
    sure = F.max(F.when((F.col("slice") < _slice("_from", months)) & ~F.col("emptied"), F.col("slice")))
    first = sure.over(Window.partitionBy("reviewer_id"))
    return known.withColumn("_first", first).filter(F.col("slice") >= F.coalesce("_first", F.lit(0))).select("reviewer_id", "slice", "n")


def most_of_a_reviewer(needed: DataFrame) -> int:
    """The most rows that the slices of one reviewer hold."""
    return needed.groupBy("reviewer_id").agg(F.sum("n").alias("n")).agg(F.max("n")).first()[0] or 0


def _in_slices(wanted: dict[int, set[int]]) -> Column:
    """A filter on folders: the buckets with their slices."""
    alike: dict[tuple[int, ...], list[int]] = {}
    for bucket, slices in wanted.items():
        alike.setdefault(tuple(sorted(slices)), []).append(bucket)
    if len(alike) > MOST_SLICES:
        earliest = min(min(slices) for slices in alike)
        return F.col("bucket").isin(list(wanted)) & (F.col("slice") >= earliest)
    found = F.lit(False)
    for slices, buckets in alike.items():
        found |= F.col("bucket").isin(buckets) & F.col("slice").isin(list(slices))
    return found


def affected_rows(accepted: DataFrame, versions: DataFrame | None) -> DataFrame:
    """Accepted rows of a batch and the stored ones whose validity they may change.

    A review only touches what comes after it and the one review right before it, at its new
    place and at its old one, so that is all that is put in order again, per reviewer.
    ``_is_new`` tells the two kinds apart, ``_old_end`` is the stored ``end_date``.
    """
    columns = [*(c for c in schema_of("Review").names if c not in _HISTORY), "delivered_ts", "delivered_tie"]
    no_end = F.lit(None).cast("timestamp")
    new = accepted.select(*columns, no_end.alias("_old_end"), F.lit(True).alias("_is_new"))
    if versions is None:
        return new
    touched = touched_reviewers(accepted)
    # One join with the reviewers, whose rows may be many: the versions' side can be split.
    of_touched = versions.join(touched, "reviewer_id").join(accepted.select("id"), "id", "left_anti")
    known = _newest(of_touched).select(*columns, F.col("end_date").alias("_old_end"), "_from")
    position = F.struct("date", "id")
    after = known.filter(position >= F.col("_from")).drop("_from")
    before = (
        known.filter(position < F.col("_from"))
        .groupBy("reviewer_id")
        .agg(F.max_by(F.struct(*after.columns), position).alias("_row"))
        .select("_row.*")
    )
    return after.unionByName(before).withColumn("_is_new", F.lit(False)).unionByName(new)


def changed_versions(affected: DataFrame, most: int) -> DataFrame:
    """The rows a batch adds: new reviews, and new versions of those that end elsewhere now.

    ``most``: of no reviewer are more rows affected.  Below what a heavy reviewer has, the plan for
    heavy ones, which gives the same rows, is not even made.
    """
    history = plain_event_history(affected) if most <= HEAVY_MIN_ROWS else event_history(affected)
    changed = history.filter("_is_new OR NOT (end_date <=> _old_end)")
    return cast_to_schema(changed.withColumn("gone", F.lit(False)), StructType.fromDDL(_WRITTEN))


def left_places(accepted: DataFrame, months: int) -> DataFrame:
    """A row marked ``gone`` in the old place of every review that has another now."""
    rows = _moved(accepted, months).select(
        "id", F.col("old_reviewer").alias("reviewer_id"), F.col("old_date").alias("date"), F.lit(True).alias("gone")
    )
    return cast_to_schema(rows, StructType.fromDDL(_WRITTEN))


def _folders_fit(spark: SparkSession, path: str, buckets: int, months: int) -> bool:
    """Whether a table has its index and this layout; a look at folder names."""
    if not path_exists(spark, _index(path)):
        return False
    every, fitting = (folder_names(spark, f"{path}/batch_id=*/{x}") for x in ("buckets=*/*", f"buckets={buckets}/months={months}"))
    return len(every) == len(fitting)


def upsert_batch(
    batch: DataFrame, batch_id: int, path: str, as_of: AsOf = None, buckets: int = BUCKETS, months: int = MONTHS
) -> None:
    """Clean a batch of bronze reviews and add it to the silver table."""
    spark = batch.sparkSession
    versions = stored_versions(spark, path)
    if versions is not None and not _folders_fit(spark, path, buckets, months):
        raise ValueError(f"{path} does not have {buckets} buckets, slices of {months} months and its index; compact it into a new table")
    # A batch that failed half-way may have left index rows: they are its own, and written again.
    earlier = F.col("batch_id") < batch_id
    index = None if versions is None else read_if_there(spark, _index(path), _INDEX)
    ids, places = (None if index is None else index.filter(earlier & (F.col("kind") == kind)) for kind in ("id", "place"))
    fresh = delivered_reviews(batch, as_of).persist()
    if ids is not None:
        # At most ``buckets`` numbers come to the driver; they prune the folders to read.
        own = fresh.select(_bucket(buckets, "id").alias("bucket")).distinct().collect()
        ids = ids.filter(F.col("bucket").isin([r.bucket for r in own]))
    accepted = accepted_rows(fresh, ids).persist()
    changed = changed_places(accepted, months).persist()
    with ThreadPoolExecutor(1) as beside:
        # Written while it is found out what to read.
        indexed = beside.submit(_write_index, accepted, changed, path, batch_id, buckets)
        needed = changed.select("reviewer_id", "slice", "n", F.lit(False).alias("read"))
        if places is not None:
            touched = touched_reviewers(accepted)
            own = changed.select(_bucket(buckets).alias("bucket")).distinct().collect()
            places = places.filter(F.col("bucket").isin([r.bucket for r in own]))
            needed = needed.unionByName(needed_places(touched, places, months).withColumn("read", F.lit(True)))
        needed = needed.persist()
        # A row per bucket and slice: no more than there may be folders.
        wanted: dict[int, set[int]] = {}
        for row in needed.filter("read").select(_bucket(buckets).alias("bucket"), "slice").distinct().collect():
            wanted.setdefault(row.bucket, set()).add(row["slice"])
        most = most_of_a_reviewer(needed)
        if versions is not None:
            versions = versions.filter(earlier).filter(_in_slices(wanted)) if wanted else None
        affected = affected_rows(accepted, versions)
        if most > HEAVY_MIN_ROWS:
            affected = affected.persist()  # the plan for heavy reviewers reads it more than once
        added = changed_versions(affected, most).unionByName(left_places(accepted, months))
        # The index goes first: rows that it does not know would not be found again.
        indexed.result()
    _write(added, batch_folder(path, batch_id), buckets, months)
    for frame in (affected, needed, changed, accepted, fresh):
        frame.unpersist()


def drain_to_silver(
    bronze: DataFrame, path: str, checkpoint: str, as_of: AsOf = None, buckets: int = BUCKETS, months: int = MONTHS
) -> int:
    """Run the upsert over everything a stream of bronze reviews holds now."""
    return drain(bronze, lambda batch, n: upsert_batch(batch, n, path, as_of, buckets, months), checkpoint)


def drain_reviews(
    messages: DataFrame,
    bronze: str,
    silver: str,
    checkpoint: str,
    as_of: AsOf = None,
    buckets: int = BUCKETS,
    months: int = MONTHS,
) -> int:
    """The whole review stream in one query: messages to bronze, bronze to silver.

    The silver step reads the batch back from bronze, so messages are parsed once.
    """

    def land_and_upsert(batch: DataFrame, batch_id: int) -> None:
        folder = batch_folder(bronze, batch_id)
        bronze_reviews(batch, as_of).write.mode("overwrite").parquet(folder)
        landed = batch.sparkSession.read.schema(schema_of("reviews")).parquet(folder)
        upsert_batch(landed, batch_id, silver, as_of, buckets, months)

    return drain(messages, land_and_upsert, checkpoint)
