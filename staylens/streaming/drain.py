"""Running a stream over its backlog: bounded batches until nothing is left."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staylens.functions.times import AsOf, in_late_window
from staylens.operators.profile import EmptyResultError, counted
from staylens.sources.landing import split_late
from staylens.sources.quarantine import without_malformed
from staylens.sources.sinks import write_table
from staylens.streaming.messages import bronze_reviews

Batch = Callable[[DataFrame, int], None]


def drain(
    stream: DataFrame, handle: Batch, checkpoint: str, mode: str = "append", state_rows: list[int] | None = None
) -> int:
    """Process everything that is there now and stop; returns the number of batches.

    Batch size is bounded by the source's own option.  The checkpoint remembers what was
    processed; a batch that failed half-way is handed out again with the same number.
    ``state_rows`` receives the rows kept in state stores after every step of the stream.
    """
    handled: set[int] = set()

    def run(batch: DataFrame, batch_id: int) -> None:
        # Streams switch adaptive execution off; the batch jobs in here want it.
        batch.sparkSession.conf.set("spark.sql.adaptive.enabled", "true")
        handle(batch, batch_id)
        handled.add(batch_id)

    query = (
        stream.writeStream.foreachBatch(run)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    if state_rows is not None:
        state_rows += [sum(o["numRowsTotal"] for o in p["stateOperators"]) for p in query.recentProgress]
    return len(handled)


def batch_folder(target: str, batch_id: int) -> str:
    return f"{target}/batch_id={batch_id}"


def drain_to_bronze(
    messages: DataFrame, target: str, checkpoint: str, as_of: AsOf = None, rows_per_file: int | None = None
) -> int:
    """Messages to typed bronze rows, one folder per batch; returns the rows written.

    A replayed batch overwrites its own folder, so nothing is lost or doubled.  A drain
    that read messages but found no valid one is an error.
    """
    written = []

    def land(batch: DataFrame, batch_id: int) -> None:
        rows, seen = counted(bronze_reviews(batch, as_of), f"bronze batch {batch_id}")
        writer = rows.write.mode("overwrite")
        if rows_per_file:
            writer = writer.option("maxRecordsPerFile", rows_per_file)
        writer.parquet(batch_folder(target, batch_id))
        written.append(seen.get.get("rows", 0))

    batches = drain(messages, land, checkpoint)
    if batches and not sum(written):
        raise EmptyResultError("no valid review message found")
    return sum(written)


def drain_late_split(
    rows: DataFrame,
    accepted: str,
    late: str,
    checkpoint: str,
    as_of: AsOf = None,
    column: str = "last_updated",
    malformed: Callable[[DataFrame], DataFrame] | None = None,
    malformed_target: str | None = None,
) -> int:
    """Rows inside the late-arrival window to one table, all others to another.

    ``malformed`` makes the rows of a third table out of a stream that keeps malformed rows.
    """

    def split(batch: DataFrame, batch_id: int) -> None:
        # Several outputs of one batch: do not fetch it from the source twice.
        whole = batch.persist()
        if malformed is not None:
            write_table(malformed(whole), batch_folder(malformed_target, batch_id))
        on_time, others = split_late(whole if malformed is None else without_malformed(whole), as_of, column)
        write_table(on_time, batch_folder(accepted, batch_id))
        write_table(others, batch_folder(late, batch_id))
        batch.unpersist()

    return drain(rows, split, checkpoint)


def late_counts(rows: DataFrame, source: str, as_of: AsOf = None, column: str = "last_updated") -> DataFrame:
    """Rows and late rows per source so far.  The state is one row per source, however many rows there are."""
    on_time = in_late_window(F.col(column), as_of)
    return rows.groupBy(source).agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(~on_time).alias("n_late"))


def drain_late_counts(
    rows: DataFrame, source: str, target: str, checkpoint: str, as_of: AsOf = None, column: str = "last_updated"
) -> int:
    """Keep ``late_counts`` of a stream: a batch writes the sources it has changed, a replayed one writes them again."""

    def write(batch: DataFrame, batch_id: int) -> None:
        write_table(batch, batch_folder(target, batch_id))

    return drain(late_counts(rows, source, as_of, column), write, checkpoint, mode="update")


def read_late_counts(spark: SparkSession, target: str, source: str) -> DataFrame:
    """The newest counts of every source."""
    kept = read_batches(spark, target)
    newest = F.max_by(F.struct("n_rows", "n_late"), "batch_id").alias("newest")
    return kept.groupBy(source).agg(newest).select(source, "newest.*")


def first_deliveries(
    stream: DataFrame, keys: Sequence[str], arrived: str, within: str = "48 hours"
) -> DataFrame:
    """A stream without rows that were delivered again ``within`` some time.

    ``arrived`` is the moment of delivery.  The state holds the keys of that time only.  A copy that
    comes later than that passes, and so does any row with other keys: what the stream feeds
    has to be idempotent, as the review upsert is, which is spared the work for the rest.
    """
    return stream.withWatermark(arrived, within).dropDuplicatesWithinWatermark(list(keys))


def windowed_counts(
    stream: DataFrame, at: str, by: str, width: str = "1 day", delay: str = "48 hours"
) -> DataFrame:
    """Rows per time window and ``by``.  A window is final ``delay`` after its end;
    rows that come later than that are left out, so the state stays bounded."""
    return (
        stream.withWatermark(at, delay)
        .groupBy(F.window(at, width), by)
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), by, "n")
    )


def drain_append(result: DataFrame, target: str, checkpoint: str) -> None:
    """Append the final rows of a streaming aggregation to a Parquet table."""
    (
        result.writeStream.format("parquet")
        .outputMode("append")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def read_batches(spark: SparkSession, target: str) -> DataFrame:
    return spark.read.parquet(target)
