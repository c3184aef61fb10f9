"""Streams over files: replay, copies, out-of-order and late input."""

from __future__ import annotations

import json
import os
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from staylens import jobs
from staylens.operators.profile import EmptyResultError
from staylens.operators.schema_ops import cast_to_schema
from staylens.plans.silver_reviews import clean_reviews
from staylens.schemas import schema_of
from staylens.sources.files import stream_csv
from staylens.streaming import messages, upsert
from staylens.streaming.drain import drain, drain_append, drain_to_bronze, first_deliveries, windowed_counts

AS_OF = "2024-03-01 00:00:00"


def message_files(spark, path, batches):
    for values in batches:
        rows = [(v, None) for v in values]
        spark.createDataFrame(rows, "value STRING, received_at TIMESTAMP").coalesce(1).write.mode("append").parquet(path)


def test_unwrap(spark):
    values = ['{"id":1}', '{"payload":{"id":1}}', '{"payload":"{\\"id\\":1}"}', '"{\\"id\\":1}"',
              "[1]", "zz", '{"payload":[1]}', '{"payload":"text"}', "5", None, '{"id":1,"payload":7}', '{"id":1']
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i INT, value STRING")
    rows = messages.unwrap_payload(df).orderBy("i").collect()
    got = [json.loads(r.payload)["id"] if r.payload else None for r in rows]
    assert got == [1, 1, 1, 1, None, None, None, None, None, None, 1, None]
    good, bad = messages.split_messages(df)
    assert (good.count(), bad.count()) == (5, 7)


def test_contract(spark):
    values = ['{"id":1,"sentiment_score":1,"sentiment_label":[],"contains_media":null}', '{"id":"1"}',
              '{"likes_votes":3000000000}', '{"sentiment_label":["a",1]}', '{"comments":5,"id":1.5}', "[]", "{}"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i INT, value STRING")
    got = [r.violations for r in messages.check_contract(df).orderBy("i").collect()]
    assert got == [[], ["id"], ["likes_votes"], ["sentiment_label"], ["id", "comments"], ["not an object"], []]
    good, bad = messages.split_by_contract(df)
    assert (good.count(), bad.count()) == (2, 5)


def test_bronze_drain_is_bounded_and_replayable(spark, tmp_path):
    source, target, checkpoint = (str(tmp_path / n) for n in ("in", "bronze", "checkpoint"))
    message_files(spark, source, [['{"id":1}', "zz", None], ['{"payload":{"id":2}}'], ['{"id":3}']])
    stream = messages.file_messages(spark, source, max_files=1)
    assert drain_to_bronze(stream, target, checkpoint, AS_OF) == 3
    assert spark.read.parquet(target).select("batch_id").distinct().count() == 3
    message_files(spark, source, [['{"id":4}']])
    assert drain_to_bronze(messages.file_messages(spark, source, 1), target, checkpoint, AS_OF) == 1
    rows = spark.read.parquet(target)
    assert sorted(r.id for r in rows.collect()) == [1, 2, 3, 4]
    assert {str(r.event_ingestion_time) for r in rows.collect()} == {AS_OF}


def test_bronze_drain_without_valid_message_is_an_error(spark, tmp_path):
    source = str(tmp_path / "in")
    message_files(spark, source, [["zz", "[1]"]])
    with pytest.raises(EmptyResultError):
        drain_to_bronze(messages.file_messages(spark, source), str(tmp_path / "out"), str(tmp_path / "c"), AS_OF)


def random_reviews(n, seed):
    rng = random.Random(seed)
    start = datetime(2024, 1, 1)
    return [(i, rng.randrange(8), start + timedelta(hours=rng.randrange(200))) for i in range(n)]


def bronze_frame(spark, rows):
    df = spark.createDataFrame(rows, "id BIGINT, reviewer_id BIGINT, date TIMESTAMP")
    return cast_to_schema(df, schema_of("reviews"))


def state(df):
    return sorted((r.id, r.reviewer_id, r.start_date, r.end_date, r.is_current) for r in df.collect())


def sortable(rows):
    return [tuple(map(str, r)) for r in rows]


@pytest.mark.parametrize("seed", [1, 2])
def test_upsert_equals_one_batch_run(spark, tmp_path, seed):
    rows = random_reviews(120, seed)
    shuffled = rows[:]
    random.Random(seed).shuffle(shuffled)
    batches = [shuffled[:50], shuffled[50:80] + shuffled[:10], shuffled[80:] + shuffled[60:70]]
    path = str(tmp_path / "silver")
    for n, batch in enumerate(batches):
        upsert.upsert_batch(bronze_frame(spark, batch), n, path, AS_OF)
    expected = sortable(sorted(map(tuple, state(clean_reviews(bronze_frame(spark, rows), AS_OF))), key=str))
    assert sorted(sortable(state(upsert.read_reviews(spark, path)))) == sorted(expected)

    # A replayed batch, first or last, changes nothing.
    upsert.upsert_batch(bronze_frame(spark, batches[2]), 2, path, AS_OF)
    assert sorted(sortable(state(upsert.read_reviews(spark, path)))) == sorted(expected)
    currents = upsert.read_reviews(spark, path).filter("is_current").groupBy("reviewer_id").count()
    assert {r["count"] for r in currents.collect()} == {1}

    with pytest.raises(ValueError, match="compact"):
        upsert.upsert_batch(bronze_frame(spark, batches[0]), 3, path, AS_OF, buckets=8)
    target = str(tmp_path / "compacted")
    upsert.compact(spark, path, target, buckets=8)
    assert sorted(sortable(state(upsert.read_reviews(spark, target)))) == sorted(expected)
    upsert.upsert_batch(bronze_frame(spark, batches[2]), 2, target, AS_OF, buckets=8)  # handed out again
    assert sorted(sortable(state(upsert.read_reviews(spark, target)))) == sorted(expected)
    late = [(999, 3, datetime(2024, 1, 2, 0, 30))]
    upsert.upsert_batch(bronze_frame(spark, late), 3, target, AS_OF, buckets=8)
    expected = state(clean_reviews(bronze_frame(spark, rows + late), AS_OF))
    assert sorted(sortable(state(upsert.read_reviews(spark, target)))) == sorted(sortable(expected))


def test_upsert_stream(spark, tmp_path):
    source, path = str(tmp_path / "in"), str(tmp_path / "silver")
    rows = random_reviews(60, 5)
    for part in (rows[40:], rows[:40], rows[30:50]):
        bronze_frame(spark, part).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(schema_of("reviews")).option("maxFilesPerTrigger", 1).parquet(source)
    upsert.drain_to_silver(stream, path, str(tmp_path / "c"), AS_OF)
    expected = state(clean_reviews(bronze_frame(spark, rows), AS_OF))
    assert sorted(sortable(state(upsert.read_reviews(spark, path)))) == sorted(sortable(expected))


def test_watermark_leaves_out_what_is_too_late(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    names = schema_of("adsProviders").names

    def deliver(name, moments, age):
        lines = [",".join(names)]
        for moment in moments:
            lines.append(",".join(moment if n == "last_updated" else "1" if n == "id" else "" for n in names))
        file = source / name
        file.write_text("\n".join(lines) + "\n")
        os.utime(file, (1_700_000_000 + age, 1_700_000_000 + age))

    deliver("a.csv", ["2024-01-01 10:00:00", "2024-01-01 11:00:00"], 0)
    deliver("b.csv", ["2024-01-06 10:00:00"], 10)
    deliver("c.csv", ["2024-01-06 11:00:00"], 20)  # a batch later, the first day is closed
    deliver("d.csv", ["2024-01-01 12:00:00", "2024-01-05 12:00:00"], 30)  # the first one is too late
    deliver("e.csv", ["2024-01-12 10:00:00"], 40)
    stream = stream_csv(spark, schema_of("adsProviders"), str(source), AS_OF, max_files=1)
    counts = (
        stream.groupBy(F.window("last_updated", "1 day"))
        .count()
        .select(F.col("window.start").alias("day"), "count")
    )
    target = str(tmp_path / "out")
    drain_append(counts, target, str(tmp_path / "c"))
    got = {str(r.day)[:10]: r["count"] for r in spark.read.parquet(target).collect()}
    assert got == {"2024-01-01": 2, "2024-01-05": 1, "2024-01-06": 2}
    assert windowed_counts(stream, "last_updated", "name").isStreaming


def test_normalize_events(spark):
    df = spark.createDataFrame(
        [("1", "7", "", "other", "3", "x, y"), ("2", "seven", "a", "b", None, "")],
        "id STRING, reviewer_id STRING, comments STRING, comment STRING, likes_count STRING, sentiment_label STRING",
    )
    events, rejected = messages.normalize_events(df, AS_OF)
    row = events.first()
    assert (row.id, row.reviewer_id, row.comments, row.likes_votes, row.sentiment_label) == (1, 7, "other", 3, ["x", "y"])
    assert row.ingestion_ts == "2024-03-01T00:00:00+00:00" and events.columns == list(messages.CONTRACT)
    assert [r.id for r in rejected.collect()] == ["2"]


@pytest.mark.parametrize("buckets", [1, 32])
def test_the_latest_copy_wins_in_any_order_and_layout(spark, tmp_path, buckets):
    rng = random.Random(9)
    start = datetime(2024, 1, 1)
    rows = [
        (
            rng.randrange(25),
            rng.randrange(5),
            start + timedelta(hours=rng.randrange(60)),
            rng.choice([None, start + timedelta(days=rng.randrange(4))]),
            f"text {rng.randrange(3)}",
        )
        for _ in range(90)
    ]

    def frame(part):
        df = spark.createDataFrame(part, "id BIGINT, reviewer_id BIGINT, date TIMESTAMP, ingestion_ts TIMESTAMP, comments STRING")
        return cast_to_schema(df, schema_of("reviews"))

    path = str(tmp_path / "silver")
    batches = [rows[i : i + 18] for i in range(0, 90, 18)]
    for n, part in enumerate(batches):
        upsert.upsert_batch(frame(part), n, path, AS_OF, buckets)
    shown = lambda df: sorted(map(str, df.select(*schema_of("Review").names).collect()))
    expected = shown(clean_reviews(frame(rows), AS_OF))
    assert shown(upsert.read_reviews(spark, path)) == expected
    upsert.upsert_batch(frame(batches[4]), 4, path, AS_OF, buckets)  # replayed
    assert shown(upsert.read_reviews(spark, path)) == expected
    currents = upsert.read_reviews(spark, path).filter("is_current").groupBy("reviewer_id").count().collect()
    assert {r["count"] for r in currents} == {1}
    target = str(tmp_path / "compacted")
    upsert.compact(spark, path, target, buckets)
    upsert.upsert_batch(frame(batches[0]), 7, target, AS_OF, buckets)  # older copies change nothing
    assert shown(upsert.read_reviews(spark, target)) == expected


def silver_rows(df):
    return sorted(map(str, df.select(*schema_of("Review").names).collect()))


@pytest.mark.parametrize(("buckets", "months"), [(1, 1), (5, 1)])
def test_reviews_that_move_between_slices_and_reviewers(spark, tmp_path, buckets, months):
    rng = random.Random(11)
    start = datetime(2023, 1, 1)
    rows = [
        (rng.randrange(20), rng.randrange(3), rng.choice([None, start + timedelta(days=rng.randrange(500))]), start + timedelta(hours=n), f"t{n}")
        for n in range(80)
    ]

    def frame(part):
        df = spark.createDataFrame(part, "id BIGINT, reviewer_id BIGINT, date TIMESTAMP, ingestion_ts TIMESTAMP, comments STRING")
        return cast_to_schema(df, schema_of("reviews"))

    path = str(tmp_path / "silver")
    for n in range(4):
        upsert.upsert_batch(frame(rows[20 * n : 20 * n + 20]), n, path, AS_OF, buckets, months)
        seen = rows[: 20 * n + 20]
        assert silver_rows(upsert.read_reviews(spark, path)) == silver_rows(clean_reviews(frame(seen), AS_OF))
    with pytest.raises(ValueError, match="compact"):
        upsert.upsert_batch(frame(rows[:1]), 4, path, AS_OF, buckets, months + 1)


def test_a_batch_reads_touched_buckets_and_late_slices_only(spark, tmp_path, monkeypatch):
    start, buckets = datetime(2022, 1, 15), 8
    # One review per reviewer and month, over two years.
    old = [(100 * r + m, r, start + timedelta(days=30 * m)) for r in range(12) for m in range(24)]
    path = str(tmp_path / "silver")
    upsert.upsert_batch(bronze_frame(spark, old), 0, path, AS_OF, buckets, 1)
    before = {f: os.stat(f).st_mtime_ns for f in map(str, (tmp_path / "silver").rglob("*.parquet"))}
    read = {}

    def watched(name):
        real = getattr(upsert, name)

        def run(rows, stored):
            read[name] = stored
            return real(rows, stored)

        monkeypatch.setattr(upsert, name, run)

    watched("accepted_rows")
    watched("affected_rows")
    new = [(9000, 3, datetime(2024, 2, 1)), (9001, 7, datetime(2024, 2, 2))]
    upsert.upsert_batch(bronze_frame(spark, new), 1, path, AS_OF, buckets, 1)

    def bucket_of(values):
        df = spark.createDataFrame([(v,) for v in values], "k BIGINT")
        return {r.b for r in df.select(upsert._bucket(buckets, "k").alias("b")).collect()}

    files = lambda df: {r[0] for r in df.select("_metadata.file_path").distinct().collect()}
    rows = read["affected_rows"]
    assert {r.bucket for r in rows.select("bucket").distinct().collect()} == bucket_of([3, 7])
    last = max(at for _, _, at in old)
    assert {r["slice"] for r in rows.select("slice").distinct().collect()} == {last.year * 12 + last.month - 1}
    assert len(files(rows)) == len(bucket_of([3, 7]))
    ids = read["accepted_rows"]
    assert {r.bucket for r in ids.select("bucket").distinct().collect()} <= bucket_of([9000, 9001])
    # No old file is touched, and the state is that of one batch run.
    assert all(os.stat(f).st_mtime_ns == at for f, at in before.items())
    assert silver_rows(upsert.read_reviews(spark, path)) == silver_rows(clean_reviews(bronze_frame(spark, old + new), AS_OF))
    # An early date reads from there on.
    upsert.upsert_batch(bronze_frame(spark, [(9002, 3, datetime(2023, 6, 1))]), 2, path, AS_OF, buckets, 1)
    months = {r["slice"] for r in read["affected_rows"].select("slice").distinct().collect()}
    assert min(months) == 2023 * 12 + 4 and max(months) == 2024 * 12 + 1


def test_a_batch_cut_off_between_index_and_rows_is_written_again(spark, tmp_path, monkeypatch):
    path, rows = str(tmp_path / "silver"), random_reviews(40, 3)
    real = upsert._write
    upsert.upsert_batch(bronze_frame(spark, rows[:20]), 0, path, AS_OF)

    def fails(*_):
        raise OSError("no disk")

    monkeypatch.setattr(upsert, "_write", fails)
    with pytest.raises(OSError, match="no disk"):
        upsert.upsert_batch(bronze_frame(spark, rows[20:]), 1, path, AS_OF)
    monkeypatch.setattr(upsert, "_write", real)
    upsert.upsert_batch(bronze_frame(spark, rows[20:]), 1, path, AS_OF)
    assert silver_rows(upsert.read_reviews(spark, path)) == silver_rows(clean_reviews(bronze_frame(spark, rows), AS_OF))


def test_a_table_without_an_index_is_compacted_first(spark, tmp_path):
    path, target, rows = str(tmp_path / "silver"), str(tmp_path / "new"), random_reviews(30, 4)
    upsert.upsert_batch(bronze_frame(spark, rows[:20]), 0, path, AS_OF)
    (tmp_path / "silver" / "_index").rename(tmp_path / "aside")
    with pytest.raises(ValueError, match="index"):
        upsert.upsert_batch(bronze_frame(spark, rows[20:]), 1, path, AS_OF)
    upsert.compact(spark, path, target)
    upsert.upsert_batch(bronze_frame(spark, rows[20:]), 1, target, AS_OF)
    assert silver_rows(upsert.read_reviews(spark, target)) == silver_rows(clean_reviews(bronze_frame(spark, rows), AS_OF))


def ads_file(path, rows):
    names = schema_of("adsProviders").names
    lines = [",".join(names)]
    for i, moment in rows:
        lines.append(",".join(moment if n == "last_updated" else str(i) if n == "id" else "" for n in names))
    path.write_text("\n".join(lines) + "\n")


def test_stream_ads_job_with_a_replayed_batch(spark, tmp_path):
    source, bronze, checkpoint = tmp_path / "in", str(tmp_path / "ads"), tmp_path / "checkpoint"
    source.mkdir()
    ads_file(source / "a.csv", [(1, "2024-03-01 10:00:00"), (2, "2023-01-01 00:00:00")])
    ads_file(source / "b.csv", [(3, "2024-02-28 10:00:00"), (4, "")])

    def run():
        counts = jobs.stream_ads(spark, str(source), bronze, str(checkpoint), AS_OF, max_files=1)
        sides = [sorted(r.id for r in spark.read.parquet(p).collect()) for p in (bronze, f"{bronze}_late")]
        return sides, {r.source_file[-5:]: (r.n_rows, r.n_late) for r in counts.collect()}

    first = run()
    assert first == ([[1, 3], [2, 4]], {"a.csv": (2, 1), "b.csv": (2, 1)})
    assert run() == first  # nothing new
    # The last batch was not committed: it is handed out again, with the same number.
    for part in ("split", "counts"):
        commits = checkpoint / part / "commits"
        last = max((f for f in commits.iterdir() if f.name.isdigit()), key=lambda f: int(f.name))
        last.unlink()
        (commits / f".{last.name}.crc").unlink(missing_ok=True)
    assert run() == first
    ads_file(source / "c.csv", [(5, "2024-03-02 00:00:00")])
    assert run() == ([[1, 3, 5], [2, 4]], {"a.csv": (2, 1), "b.csv": (2, 1), "c.csv": (1, 0)})


def test_first_deliveries_hold_a_bounded_state_and_spare_the_upsert(spark, tmp_path):
    source, checkpoint, path, held = (str(tmp_path / n) for n in ("in", "c", "silver", "held"))
    rows, state_rows, passed = random_reviews(60, 8), [], []
    start = datetime(2024, 1, 1)
    deliveries = [(0, rows[:30]), (1, rows[:10]), (4, rows[30:]), (5, rows[:5])]

    def handle(batch, n):
        # Once: what runs twice counts its state rows twice.
        batch.write.mode("overwrite").parquet(f"{held}/{n}")
        landed = spark.read.schema(schema_of("reviews")).parquet(f"{held}/{n}")
        passed.append(landed.count())
        upsert.upsert_batch(landed, n, path, AS_OF)

    for day, part in deliveries:
        frame = bronze_frame(spark, part).withColumn("ingestion_ts", F.lit(start + timedelta(days=day, hours=day)))
        frame.coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(frame.schema).parquet(source)
        drain(first_deliveries(stream, ["id"], "ingestion_ts"), handle, checkpoint, state_rows=state_rows)
    assert [n for n in passed if n] == [30, 30, 5]
    assert max(state_rows) <= 60 and state_rows[-1] < 60
    got = upsert.read_reviews(spark, path).select("id", "reviewer_id", "date", "start_date", "end_date", "is_current")
    want = clean_reviews(bronze_frame(spark, rows), AS_OF).select(*got.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
