"""What queries do with more rows: files, tasks and plans grow with them, and no further."""

from __future__ import annotations

from pyspark.sql import functions as F

import __spark_entry__  # noqa: F401 - loads the queries
from staylens.catalog import io_queries, stream_queries
from staylens.catalog.registry import QUERIES, Tables
from staylens.streaming import upsert


def test_files_of_a_feed_grow_in_number(spark, monkeypatch):
    monkeypatch.setattr(io_queries, "ROWS_PER_FILE", 10)
    assert [io_queries.files_for(spark.range(n), 4) for n in (0, 40, 41, 400)] == [4, 4, 8, 40]
    files, per_batch = stream_queries.stream_files(spark.range(100))
    assert (files, per_batch) == (12, 4) and files / per_batch == stream_queries.FILES / stream_queries.FILES_PER_BATCH


def test_a_stream_of_more_files_has_as_many_batches(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(io_queries, "ROWS_PER_FILE", 10)
    events = spark.range(200).select(
        F.col("id").alias("event_id"), (F.col("id") % 9).alias("user_id"), F.lit("view").alias("event_type"),
        F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id")).alias("ts"), F.lit(1.0).alias("value"),
    )
    events.write.parquet(str(tmp_path / "events.parquet"))
    (found,) = QUERIES["stream_batch_drain"](Tables(spark, str(tmp_path))).collect()
    assert found.n_batches == 3 and found.n_rows == found.n_ids > 0


def test_quantile_shares_do_not_shuffle_the_lines(spark, tmp_path):
    lines = spark.range(500).select(
        *[F.col("id").alias(c) for c in ("l_orderkey", "l_partkey")], (F.col("id") % 7).cast("int").alias("l_linenumber"),
        F.when(F.col("id") % 3 == 0, "A").otherwise("N").alias("l_returnflag"), F.lit("F").alias("l_linestatus"),
        F.col("id").cast("double").alias("l_extendedprice"),
    )
    lines.write.parquet(str(tmp_path / "lineitem.parquet"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = QUERIES["agg_median_sketch"](Tables(spark, str(tmp_path)))
        assert "SortMergeJoin" not in found._jdf.queryExecution().toString()
        assert {tuple(r) for r in found.collect()} == {(f, p, n, True) for f, n in (("A", 167), ("N", 333)) for p in (5, 50, 95)}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_rows_are_counted_per_reviewer(spark):
    rows = [(1, 0, 5), (1, 1, 7), (2, 0, 9), (2, 0, 2)]
    needed = spark.createDataFrame(rows, "reviewer_id BIGINT, slice INT, n BIGINT")
    assert upsert.most_of_a_reviewer(needed) == 12
    assert upsert.most_of_a_reviewer(needed.limit(0)) == 0


def test_review_counts_need_no_history():
    class Only:
        unique_reviews = None

    seen = []
    stats = Tables.__dict__["stats"].func
    import staylens.catalog.registry as registry

    before, registry.gold.review_stats = registry.gold.review_stats, seen.append
    try:
        stats(Only())
    finally:
        registry.gold.review_stats = before
    assert seen == [None]
