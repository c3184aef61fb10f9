"""The query registry and the frames the queries start from."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DateType, DoubleType, FloatType, TimestampType

from staylens.catalog.feeds import FEEDS
from staylens.catalog.twins import AS_OF, twin
from staylens.functions import arrays
from staylens.operators.skew import heavy_keys
from staylens.plans import gold, questions, silver_ads, silver_listings, silver_reviews
from staylens.schemas import LISTING_TABLES
from staylens.session import work_path
from staylens.sources.sinks import write_table

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


_STORED: dict[tuple[str, str, str], str] = {}


class Tables:
    """The benchmark tables of one folder, the feeds and the silver tables made of them."""

    as_of = AS_OF

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder
        spark.conf.set("spark.sql.session.timeZone", "UTC")

    def path(self, table: str) -> str:
        return f"{self.folder}/{table}.parquet"

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    def feed_text(self, name: str) -> DataFrame:
        """A feed as its files carry it, lists as text."""
        frames = {t: self.table(t) for t in TABLES if f" {t}" in FEEDS[name]}
        sql = FEEDS[name]
        if name == "listing_feed":
            # Listings are few bytes and much work each: a file that one task reads is dealt to all.
            frames["customer"] = frames["customer"].hint("rebalance")
        for table, df in frames.items():
            df.createOrReplaceTempView(table)
        return self.spark.sql(sql)

    def work(self, name: str) -> str:
        return work_path(self.spark, name)

    def stored(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """A bronze or silver table: written once per session and folder, then read.

        The layers are tables in this engine, so a query on a layer starts from files.
        """
        key = (self.spark.sparkContext.applicationId, self.folder, name)
        if key not in _STORED:
            path = self.work(name)
            write_table(build(), path)
            _STORED[key] = path
        return self.spark.read.parquet(_STORED[key])

    @cached_property
    def listing_feed(self) -> DataFrame:
        lists = {c: arrays.list_from_text(F.col(c)) for c in ("host_verifications", "amenities")}
        return self.stored("listing", lambda: self.feed_text("listing_feed").withColumns(lists))

    @cached_property
    def review_feed(self) -> DataFrame:
        labels = arrays.list_from_text(F.col("sentiment_label"))
        return self.stored(
            "reviews", lambda: self.feed_text("review_feed").withColumn("sentiment_label", labels)
        )

    @cached_property
    def ads_feed(self) -> DataFrame:
        return self.stored("adsProviders", lambda: self.feed_text("ads_feed"))

    @cached_property
    def event_feed(self) -> DataFrame:
        return self.feed_text("event_feed")

    @cached_property
    def message_feed(self) -> DataFrame:
        return self.feed_text("message_feed")

    @cached_property
    def clean_listings(self) -> DataFrame:
        return silver_listings.clean_listings(self.listing_feed)

    @cached_property
    def listings(self) -> DataFrame:
        return self.stored("listings", lambda: silver_listings.one_row_per_listing(self.clean_listings))

    def listing_table(self, table: str) -> DataFrame:
        return self.stored(table, lambda: silver_listings.silver_table(self.listings, table))

    @cached_property
    def unique_reviews(self) -> DataFrame:
        return self.stored(
            "unique_reviews", lambda: silver_reviews.unique_reviews(self.review_feed, self.as_of)
        )

    @cached_property
    def silver_review(self) -> DataFrame:
        return self.stored("Review", lambda: silver_reviews.with_history(self.unique_reviews))

    @cached_property
    def silver_ads(self) -> dict[str, DataFrame]:
        tables = silver_ads.split_ads(silver_ads.clean_ads(self.ads_feed, self.as_of))
        return {name: self.stored(name, lambda df=df: df) for name, df in tables.items()}

    @cached_property
    def silver(self) -> dict[str, DataFrame]:
        """All silver tables by name."""
        tables = {t: self.listing_table(t) for t in LISTING_TABLES}
        return tables | {"Review": self.silver_review} | self.silver_ads

    def base(self, table: str) -> DataFrame:
        # The silver sink leaves one row per listing.
        return gold.listing_base(self.listing_table(table), table, unique=True)

    @cached_property
    def stats(self) -> DataFrame:
        # Counts and scores need each review once, not the reviewers' history.
        return gold.review_stats(self.unique_reviews)

    @cached_property
    def neighbourhood_base(self) -> DataFrame:
        return gold.join_listings(
            self.base("Location"), self.base("RentMetrics"), self.base("HostMetrics"), self.stats
        )

    @cached_property
    def invest(self) -> DataFrame:
        return gold.neighbourhood_invest(self.neighbourhood_base, self.as_of)

    @cached_property
    def fact_listing(self) -> DataFrame:
        joined = gold.join_listings(
            self.base("RentMetrics"), self.base("HostMetrics"), self.base("HostDetails")
        )
        return gold.fact_listing(joined, self.as_of)

    @cached_property
    def dim_location(self) -> DataFrame:
        return gold.dim_location(self.base("Location"), self.as_of)

    @cached_property
    def located(self) -> DataFrame:
        # Read several times by the reports, so joined once, as the report job does.
        return self.stored(
            "located", lambda: questions.located_listings(self.dim_location, self.fact_listing)
        )

    @cached_property
    def heavy_cities(self) -> DataFrame:
        """Heavy cities, counted where the cities come from."""
        names = self.listing_table("Location").select(F.lower(F.trim("city")).alias("city"))
        return heavy_keys(names, ["city"])

    @cached_property
    def provider_facts(self) -> DataFrame:
        s = self.silver_ads
        return gold.provider_facts(s["providerMetrics"], s["providerDetails"], self.as_of)

    @cached_property
    def agg_ads(self) -> DataFrame:
        return gold.agg_ads(self.provider_facts, self.as_of)


Build = Callable[[Tables], DataFrame]
QUERIES: dict[str, Build] = {}
TWINS: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Build], Build]:
    """Register a query and, where SQL can say it, its twin."""

    def register(build: Build) -> Build:
        if name in QUERIES:
            raise ValueError(f"query {name} is there already")
        QUERIES[name] = build
        if sql is not None:
            TWINS[name] = twin(sql)
        return build

    return register


def flat(df: DataFrame) -> DataFrame:
    """Lists and times as text, floats rounded: values that compare across engines."""
    shown = []
    for field in df.schema:
        column = F.col(field.name)
        if isinstance(field.dataType, ArrayType):
            column = F.array_join(column, "|")
        elif isinstance(field.dataType, TimestampType):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(field.dataType, DateType):
            column = F.date_format(column, "yyyy-MM-dd")
        elif isinstance(field.dataType, (FloatType, DoubleType)):
            column = F.round(column.cast("double"), 3)
        shown.append(column.alias(field.name))
    return df.select(*shown)


def time_text(column: str) -> F.Column:
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss")
