"""The jobs, callable from Python or from the command line.

    python -m staylens.jobs listings --input 's3a://raw/listings_*.csv.gz' --bronze ... --silver ...
"""

from __future__ import annotations

import argparse
import warnings
from collections.abc import Iterable
from functools import partial

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from staylens.functions.times import AsOf
from staylens.operators import profile
from staylens.operators.history import insert_only, scd2_merge, scd2_step, unseen_rows
from staylens.plans import gold, questions, silver_ads, silver_listings, silver_reviews
from staylens.schemas import LISTING_TABLES, schema_of
from staylens.session import SETTINGS, work_path
from staylens.sources import landing
from staylens.sources.files import CSV_FORMAT, read_if_there, read_raw_csv, remove_path, stream_csv
from staylens.sources.quarantine import rejected_rows, without_malformed
from staylens.sources.sinks import TableStatus, send_reviews, write_table, write_tables, write_versions
from staylens.sources.versions import Version, is_versioned, latest, read_available, read_replaced, vacuum
from staylens.streaming.drain import drain_late_counts, drain_late_split, read_late_counts
from staylens.streaming.messages import MAX_BATCH_MESSAGES, kafka_messages, normalize_events
from staylens.streaming.upsert import BUCKETS, MONTHS, compact, drain_reviews, read_reviews

# The tracked columns of the type-2 dimensions.
TRACKED = {
    "dimHost": ("host_key", ["name", "response_time_category"]),
    "dimProperty": (
        "property_key",
        ["room_type", "property_type", "bedrooms", "beds", "ameneties", "accommodates"],
    ),
    "dimProvider": ("provider_key", ["name"]),
}


SKETCHES = "AggNeighbourhoodSketches"


class Workspace:
    """The intermediate tables of one job, removed at its end.

    Several outputs share a staged table without computing it again, its lineage is cut, and a
    lost executor costs a re-read of files instead of a recomputation.
    """

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.paths: list[str] = []

    def staged(self, df: DataFrame, name: str) -> DataFrame:
        path = work_path(self.spark, name)
        self.paths.append(path)
        write_table(df, path)
        return self.spark.read.parquet(path)

    def __enter__(self) -> Workspace:
        return self

    def __exit__(self, *_: object) -> None:
        for path in self.paths:
            remove_path(self.spark, path)


def listings_to_silver(
    spark: SparkSession, bronze: DataFrame, silver: str, versioned: bool | None = None
) -> tuple[list[TableStatus], DataFrame]:
    """Clean once, de-duplicate once, then write six tables as plain projections.

    Returns the status per table and the quality profile of all delivered rows, which is
    one more scan of the profiled columns and no shuffle.
    """
    cleaned = silver_listings.clean_listings(bronze)
    with Workspace(spark) as work:
        listings = work.staged(silver_listings.one_row_per_listing(cleaned), "listings")
        statuses = write_tables(
            {t: silver_listings.silver_table(listings, t) for t in LISTING_TABLES}, silver, versioned=versioned
        )
    return statuses, listing_quality(bronze)


def listing_quality(bronze: DataFrame) -> DataFrame:
    """Missing values after cleaning, and values that cleaning lost, over all delivered rows."""
    columns = silver_listings.PROFILED_COLUMNS
    cleaned = silver_listings.clean_listings(profile.keep_raw(bronze, columns))
    return profile.quality(cleaned, columns)


def ads_to_silver(
    spark: SparkSession, bronze: DataFrame, silver: str, as_of: AsOf = None, versioned: bool | None = None
) -> list[TableStatus]:
    """Clean and split provider rows; nothing is written when no row is left."""
    cleaned = silver_ads.clean_ads(bronze, as_of)
    if cleaned.isEmpty():
        return []
    return write_tables(silver_ads.split_ads(cleaned), silver, versioned=versioned)


def stream_ads(
    spark: SparkSession,
    folder: str,
    bronze: str,
    checkpoint: str,
    as_of: AsOf = None,
    rejected: str | None = None,
    max_files: int | None = None,
    malformed: str | None = None,
) -> DataFrame:
    """Everything that has newly arrived in a folder of ads files, split by the late window.

    Both sides are written batch by batch, so a batch that is run again overwrites its own part.
    Returns the rows and late rows of every file so far, which stay beside bronze.
    With ``malformed``, rows that do not fit the schema go to that table with file, reason and text.
    """
    ads = schema_of("adsProviders")
    late, progress = rejected or f"{bronze}_late", f"{checkpoint}/split"
    if malformed is None:
        rows = stream_csv(spark, ads, folder, as_of, max_files, "source_file")
        drain_late_split(rows, bronze, late, progress, as_of)
    else:
        watched = stream_csv(spark, ads, folder, as_of, max_files, "source_file", keep_malformed=True)
        apart = partial(rejected_rows, schema=ads, csv_format=CSV_FORMAT)
        drain_late_split(watched, bronze, late, progress, as_of, malformed=apart, malformed_target=malformed)
        rows = without_malformed(watched)
    counts = f"{bronze}_counts"
    drain_late_counts(rows, "source_file", counts, f"{checkpoint}/counts", as_of)
    return read_late_counts(spark, counts, "source_file")


def reviews_to_silver(
    spark: SparkSession, bronze: DataFrame, silver: str, as_of: AsOf = None
) -> list[TableStatus]:
    """Rebuild the silver reviews from all of bronze; an empty result is an error.

    For review streams see ``staylens.streaming.upsert``, which adds to the table.
    """
    with Workspace(spark) as work:
        unique = work.staged(silver_reviews.unique_reviews(bronze, as_of), "reviews")
        profile.require_rows(unique, "reviews")
        # The review table is a plain folder in any layer: the review stream commits to it by itself.
        return write_tables({"Review": silver_reviews.with_history(unique)}, silver, versioned=False)


def publish_reviews(
    spark: SparkSession,
    paths: Iterable[str],
    servers: str,
    topic: str,
    max_records: int | None = None,
    as_of: AsOf = None,
) -> None:
    """Review CSV files to Kafka as typed JSON events; rows with unreadable numbers stay out."""
    events, _ = normalize_events(read_raw_csv(spark, paths), as_of)
    send_reviews(events, servers, topic, max_records)


def silver_to_gold(
    spark: SparkSession,
    silver: str,
    target: str,
    as_of: AsOf = None,
    since: AsOf = None,
    close_vanished: bool = False,
    versioned: bool | None = None,
    sketches: bool = False,
) -> list[TableStatus]:
    """All marts.  Type-2 dimensions are merged into their history, dimLocation only grows.

    ``since`` restricts the review counts to newer reviews, ``close_vanished`` closes the rows
    of keys that the snapshot no longer has.

    With ``versioned`` all marts change in one commit, and a run reads and writes the open rows of a
    type-2 dimension and the new rows of dimLocation only, however many rows were closed before.  A
    layer with versions keeps them; one without them is taken over by the first such run.  ``sketches``
    adds a mart of mergeable sketches per neighbourhood, which answers for cities too.
    """
    if versioned is None:
        versioned = is_versioned(spark, target)
    with Workspace(spark) as work:
        marts = _gold_marts(work, silver, as_of, since, sketches)
        if versioned:
            base = latest(spark, target)
            changes = _history_changes(spark, target, base, marts, as_of, close_vanished)
            fixed = {name: F.col("is_current") for name in TRACKED} | {"dimLocation": F.lit(False)}
            return write_versions(spark, marts | changes, target, fixed, base)
        return write_tables(marts | _histories(spark, target, marts, as_of, close_vanished), target, versioned=False)


def _gold_marts(work: Workspace, silver: str, as_of: AsOf, since: AsOf, sketches: bool) -> dict[str, DataFrame]:
    spark, staged = work.spark, work.staged
    tables = read_available(spark, silver, [*gold.BASE_COLUMNS, "Review", "providerDetails", "providerMetrics"])
    needed = [t for t in (*gold.BASE_COLUMNS, "Review") if t not in tables]
    if needed:
        raise ValueError("silver tables without data: " + ", ".join(needed))
    if "batch_id" in tables["Review"].columns:  # kept up to date by the review stream
        current = read_reviews(spark, f"{silver}/Review.parquet")
        tables["Review"] = staged(current, "current_reviews")
    stats = staged(gold.review_stats(tables["Review"], since), "review_stats")
    # The listing job writes each listing once.  Tables of other origin may not: that is seen on the way.
    seen = Observation("copies of a listing")
    wide = gold.listing_wide(gold.listing_bases(tables, unique=True), stats, copies="_copies")
    wide = staged(wide.observe(seen, F.max("_copies").alias("most")), "listing_wide").drop("_copies")
    if (seen.get["most"] or 0) > 1:
        warnings.warn("silver tables hold listings more than once; the latest row of each counts", stacklevel=3)
        wide = staged(gold.listing_wide(gold.listing_bases(tables), stats), "listing_wide")
    marts = gold.listing_marts(wide, as_of)
    marts["factReview"] = gold.fact_review(tables["Review"], stats, as_of)
    marts["dimReviewer"] = gold.dim_reviewer(tables["Review"])
    if sketches:
        marts[SKETCHES] = gold.neighbourhood_sketches(wide.filter("in_Location"), tables["Review"])
    if {"providerDetails", "providerMetrics"} <= set(tables):
        marts |= gold.provider_marts(tables["providerDetails"], tables["providerMetrics"], as_of)
    return marts


def _histories(
    spark: SparkSession, target: str, marts: dict[str, DataFrame], as_of: AsOf, close_vanished: bool
) -> dict[str, DataFrame]:
    """The next state of the dimensions with a history that are there already."""
    found = {}
    for name, history in read_available(spark, target, [*TRACKED, "dimLocation"]).items():
        if name not in marts:
            continue
        if name in TRACKED:
            key, tracked = TRACKED[name]
            merged = scd2_merge(history, marts[name], key, tracked, as_of, close_vanished)
        else:
            merged = insert_only(history, marts[name], "location_key")
        # The old table stays in place until its successor is written, so it can be read here.
        found[name] = merged
    return found


def _history_changes(
    spark: SparkSession, target: str, base: Version, marts: dict[str, DataFrame], as_of: AsOf, close_vanished: bool
) -> dict[str, DataFrame]:
    """What changes in these dimensions: all rows of one that has no versions yet."""
    plain = {name: df for name, df in marts.items() if name not in base.tables}
    found = _histories(spark, target, plain, as_of, close_vanished)
    for name, (key, tracked) in TRACKED.items():
        opened = read_replaced(spark, target, name, base) if name in marts else None
        if opened is not None:
            found[name] = scd2_step(opened, marts[name], key, tracked, as_of, close_vanished)
    if "dimLocation" in base.tables:
        places = read_available(spark, target, ["dimLocation"], base)
        if places:
            found["dimLocation"] = unseen_rows(places["dimLocation"], marts["dimLocation"], "location_key")
    return found


def answers(spark: SparkSession, target: str, city: str | None = None) -> dict[str, DataFrame]:
    """Both business questions from the published marts; marts without data are left out.

    ``city`` asks for the page of one city: see ``questions.invest_answer``.
    """
    marts = read_available(
        spark, target, ["AggNeighbourhoodInvest", "dimLocation", "factListing", "AggAds", SKETCHES]
    )
    found: dict[str, DataFrame] = {}
    if {"AggNeighbourhoodInvest", "dimLocation", "factListing"} <= set(marts):
        # Quantiles and filter both read the joined listings: join them once.
        places = marts["dimLocation"]
        if city is not None:
            places = questions.in_city(places, questions.shown_city(marts["AggNeighbourhoodInvest"], city), "city")
        joined = questions.located_listings(places, marts["factListing"])
        located = Workspace(spark).staged(joined, "located")  # the reports are read after this returns
        reports = questions.invest_answer(marts["AggNeighbourhoodInvest"], located, city)
        found |= {f"invest_{name}": df for name, df in reports.items()}
    if "AggAds" in marts:
        reports = questions.promotion_answer(marts["AggAds"])
        found |= {f"promotion_{name}": df for name, df in reports.items()}
    if SKETCHES in marts:
        found["invest_audience"] = gold.city_audience(marts[SKETCHES])
    return found


def run(arguments: Iterable[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="staylens.jobs", description=__doc__)
    parser.add_argument(
        "job",
        choices=["listings", "ads", "stream-ads", "reviews", "publish", "stream", "compact", "gold", "answers", "vacuum"],
    )
    parser.add_argument("--input", nargs="*", default=[], help="CSV files or bronze Parquet")
    parser.add_argument("--bronze")
    parser.add_argument("--silver")
    parser.add_argument("--gold")
    parser.add_argument("--servers", help="Kafka bootstrap servers")
    parser.add_argument("--topic")
    parser.add_argument("--checkpoint", help="where the review stream keeps its progress")
    parser.add_argument("--buckets", type=int, default=BUCKETS, help="reviewer buckets of the silver reviews")
    parser.add_argument("--months", type=int, default=MONTHS, help="months in a slice of the silver reviews")
    parser.add_argument("--prefix", help="what listing file names start with; keeps city names of several words whole")
    parser.add_argument("--files-per-batch", type=int, help="ads files in a batch of their stream")
    parser.add_argument("--rejected", help="where ads outside the late window go; <bronze>_late when left out")
    parser.add_argument("--malformed", help="where rows that do not fit their schema go; they land with NULLs when left out")
    parser.add_argument("--messages-per-batch", type=int, default=MAX_BATCH_MESSAGES)
    parser.add_argument("--max-records", type=int, help="publish no more reviews than this")
    parser.add_argument("--since", help="count reviews from this moment on")
    parser.add_argument("--close-vanished", action="store_true", help="close keys that a snapshot lacks")
    parser.add_argument("--versioned", action="store_true", default=None, help="change all tables in one commit")
    parser.add_argument("--sketches", action="store_true", help="also write mergeable sketches per neighbourhood")
    parser.add_argument("--keep", type=int, default=10, help="versions that vacuum leaves")
    parser.add_argument("--city", help="answer for one city, the first one where it is unknown")
    parser.add_argument("--as-of", help="clock of the run; now when left out")
    args = parser.parse_args(arguments)
    spark = SparkSession.builder.appName(f"staylens {args.job}").getOrCreate()
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    statuses: list[TableStatus] = []
    if args.job == "listings":
        bronze = landing.land_listings(spark, args.input, args.bronze, args.as_of, args.prefix, args.malformed)
        statuses, quality = listings_to_silver(spark, bronze, args.silver, args.versioned)
        quality.show(truncate=False, vertical=True)
    elif args.job == "ads":
        late = args.rejected or f"{args.bronze}_late"
        bronze = landing.land_ads(spark, args.input, args.bronze, args.as_of, rejected=late, malformed=args.malformed)
        statuses = [] if bronze is None else ads_to_silver(spark, bronze, args.silver, args.as_of, args.versioned)
    elif args.job == "stream-ads":
        counts = stream_ads(
            spark, args.input[0], args.bronze, args.checkpoint, args.as_of, args.rejected, args.files_per_batch,
            args.malformed,
        )
        counts.show(200, truncate=False)
        landed = read_if_there(spark, args.bronze)
        if landed is not None and args.silver:
            statuses = ads_to_silver(spark, landed, args.silver, args.as_of, args.versioned)
    elif args.job == "reviews":
        bronze = spark.read.schema(schema_of("reviews")).parquet(*args.input)
        statuses = reviews_to_silver(spark, bronze, args.silver, args.as_of)
    elif args.job == "publish":
        publish_reviews(spark, args.input, args.servers, args.topic, args.max_records, args.as_of)
    elif args.job == "compact":
        compact(spark, f"{args.silver}/Review.parquet", args.input[0], args.buckets, args.months)
    elif args.job == "stream":
        messages = kafka_messages(spark, args.servers, args.topic, args.messages_per_batch)
        reviews = f"{args.silver}/Review.parquet"
        drain_reviews(messages, args.bronze, reviews, args.checkpoint, args.as_of, args.buckets, args.months)
    elif args.job == "gold":
        statuses = silver_to_gold(spark, args.silver, args.gold, args.as_of, args.since, args.close_vanished, args.versioned, args.sketches)
    elif args.job == "vacuum":
        for layer in filter(None, (args.silver, args.gold)):
            print(f"{layer}: {len(vacuum(spark, layer, args.keep))} folders removed")
    else:
        for name, report in answers(spark, args.gold, args.city).items():
            print(name)
            report.show(200, truncate=False)
    for status in statuses:
        print(f"{status.table}: {status.rows} rows")


if __name__ == "__main__":
    run()
