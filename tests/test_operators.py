"""DataFrame operators: schema, de-duplication, history, quantiles, skew, profile."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from staylens.operators import profile, schema_ops
from staylens.operators.dedupe import dedupe_latest
from staylens.operators.history import event_history, insert_only, scd2_merge
from staylens.operators.quantiles import exact_quantiles
from staylens.operators.skew import heavy_keys, salted_left_join


def test_cast_to_schema_fills_and_never_raises(spark):
    df = spark.createDataFrame([("99999999999", 3_000_000_000)], "n STRING, id BIGINT")
    schema = StructType.fromDDL("id BIGINT, n INT, absent TIMESTAMP")
    assert schema_ops.cast_to_schema(df, schema).collect() == [(3_000_000_000, None, None)]


def test_require_columns_names_what_is_missing(spark):
    with pytest.raises(ValueError, match="b, c"):
        schema_ops.require_columns(spark.range(1), ["id", "c", "b"])


def test_ensure_columns(spark):
    df = schema_ops.ensure_columns(spark.range(1), StructType.fromDDL("id BIGINT, x STRING"), {"x": "y"})
    assert df.columns == ["id", "y"] and df.first()["y"] is None


def test_dedupe_keeps_latest_and_is_stable(spark):
    rows = [(1, "a", 1), (1, "b", 2), (2, "c", 5), (2, "d", 5), (3, "e", None)]
    df = spark.createDataFrame(rows, "id INT, v STRING, ingestion_ts INT")
    first = {r.id: r.v for r in dedupe_latest(df, ["id"]).collect()}
    again = {r.id: r.v for r in dedupe_latest(df.repartition(3), ["id"]).collect()}
    assert first == again and first[1] == "b" and first[3] == "e"


def test_dedupe_limits_rows_before_the_shuffle(spark):
    df = spark.createDataFrame([(1, 1)], "id INT, ingestion_ts INT")
    plan = dedupe_latest(df, ["id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def _history_by_hand(rows):
    result = {}
    for key in {r[1] for r in rows}:
        mine = sorted((d, i) for i, k, d in rows if k == key)
        for (day, i), following in zip(mine, [*mine[1:], None]):
            result[i] = (day, following[0] if following else None, following is None)
    return result


@pytest.mark.parametrize("split", ["none", "all", "some"])
def test_event_history(spark, split):
    rng = random.Random(7)
    start = datetime(2024, 1, 1)
    rows = [(i, rng.randrange(6), start + timedelta(minutes=rng.randrange(400))) for i in range(600)]
    rows += [(1000 + i, 3, start) for i in range(50)]  # many events in one moment
    rows += [(2000, 77, start)]
    df = spark.createDataFrame(rows, "id BIGINT, reviewer_id BIGINT, date TIMESTAMP")
    heavy = {
        "none": heavy_keys(df, ["reviewer_id"]),
        "all": df.select("reviewer_id").distinct(),
        "some": heavy_keys(df, ["reviewer_id"], share=0.18, min_rows=1),
    }[split]
    got = {r.id: (r.start_date, r.end_date, r.is_current) for r in event_history(df, heavy=heavy).collect()}
    assert got == _history_by_hand(rows)


def test_heavy_keys_are_bounded(spark):
    df = spark.range(10_000).select((F.when(F.col("id") < 3400, 0).otherwise(F.col("id"))).alias("k"))
    heavy = heavy_keys(df, ["k"], share=0.01, min_rows=1)
    assert [(r.k, r._parts) for r in heavy.collect()] == [(0, 34)]  # a third of the rows: 34 tasks' worth
    assert heavy_keys(df, ["k"]).isEmpty()


def test_salted_join_equals_plain_join(spark):
    rows = [(i, None if i % 5 == 0 else i % 7 if i % 2 else 0) for i in range(500)]
    df = spark.createDataFrame(rows, "id BIGINT, k BIGINT")
    groups = spark.createDataFrame([(k, f"g{k}") for k in range(5)], "k BIGINT, name STRING")
    heavy = heavy_keys(df.dropna(), ["k"], share=0.1, min_rows=1)
    salted = salted_left_join(df, groups, ["k"], [F.col("id")], heavy=heavy)
    plain = df.join(groups, "k", "left")
    assert sorted(salted.select("id", "k", "name").collect(), key=str) == sorted(
        plain.select("id", "k", "name").collect(), key=str
    )


@pytest.mark.parametrize("split", ["none", "all", "some"])
@pytest.mark.parametrize("fraction", [0.0, 0.25, 0.5, 0.8, 1.0])
def test_exact_quantiles(spark, fraction, split):
    rng = random.Random(int(fraction * 100))
    rows = [("a", rng.gauss(0, 1000)) for _ in range(501)]
    rows += [("b", float(rng.randrange(4))) for _ in range(200)]
    rows += [("c", -3.5), (None, 1.0), (None, 2.0), ("a", None)]
    df = spark.createDataFrame(rows, "g STRING, v DOUBLE")
    groups = df.select("g").distinct()
    heavy = {"none": None, "all": groups, "some": groups.filter("g IS NULL OR g = 'a'")}[split]
    found = exact_quantiles(df, ["g"], {"q": (F.col("v"), fraction)}, heavy).collect()
    got = {r.g: r.q for r in found}
    assert len(found) == 4
    for group in ("a", "b", "c", None):
        values = [v for g, v in rows if g == group and v is not None]
        assert got[group] == pytest.approx(np.quantile(values, fraction))


COLUMNS = "k INT, start_date TIMESTAMP, end_date TIMESTAMP, is_current BOOLEAN, name STRING, tags ARRAY<STRING>"


def test_scd2_merge(spark):
    day1, day2 = datetime(2024, 1, 1), datetime(2024, 2, 1)
    history = spark.createDataFrame(
        [
            (1, day1, None, True, "same", ["x"]),
            (2, day1, None, True, "old", None),
            (3, day1, None, True, "vanished", None),
            (2, datetime(2023, 1, 1), day1, False, "older", None),
        ],
        COLUMNS,
    )
    snapshot = spark.createDataFrame(
        [(1, "same", ["x"]), (2, "new", None), (4, "fresh", None)], "k INT, name STRING, tags ARRAY<STRING>"
    )
    merged = scd2_merge(history, snapshot, "k", ["name", "tags"], "2024-02-01 00:00:00")
    got = sorted((r.k, r.start_date, r.end_date, r.is_current, r.name) for r in merged.collect())
    assert got == sorted(
        [
            (1, day1, None, True, "same"),
            (2, datetime(2023, 1, 1), day1, False, "older"),
            (2, day1, day2, False, "old"),
            (2, day2, None, True, "new"),
            (3, day1, None, True, "vanished"),
            (4, day2, None, True, "fresh"),
        ],
        key=lambda r: (r[0], r[1]),
    )
    again = scd2_merge(merged, snapshot, "k", ["name", "tags"], "2024-03-01 00:00:00")
    assert sorted(map(str, again.collect())) == sorted(map(str, merged.collect()))
    closing = scd2_merge(history, snapshot, "k", ["name", "tags"], "2024-02-01 00:00:00", close_vanished=True)
    assert [r.is_current for r in closing.filter("k = 3").collect()] == [False]


def test_insert_only_keeps_known_rows(spark):
    known = spark.createDataFrame([(1, "before")], "k INT, v STRING")
    fresh = spark.createDataFrame([(1, "after"), (2, "new")], "k INT, v STRING")
    assert sorted(insert_only(known, fresh, "k").collect()) == [(1, "before"), (2, "new")]


def test_profile(spark):
    df = spark.createDataFrame([("5", 1), ("x", 2), ("N/A", 3), (None, 4)], "price STRING, id INT")
    kept = profile.keep_raw(df, ["price"]).withColumn("price", F.col("price").try_cast("double"))
    assert profile.transform_null_counts(kept, ["price"]).first()[0] == 1
    assert profile.null_counts(kept, ["price"]).first() == (4, 3)
    with pytest.raises(profile.EmptyResultError):
        profile.require_rows(df.filter("id > 9"), "prices")


def test_event_history_is_the_same_for_heavy_and_ordinary_keys(spark):
    rng = random.Random(11)
    start = datetime(2024, 1, 1)
    rows = [
        (i, rng.choice([1, 2, None]), rng.choice([None, start + timedelta(seconds=rng.randrange(300))]))
        for i in range(300)
    ]
    rows += [(900, 5, None), (901, 5, None), (902, None, datetime(1960, 1, 1))]
    df = spark.createDataFrame(rows, "id BIGINT, reviewer_id BIGINT, date TIMESTAMP")
    none = df.select("reviewer_id").limit(0)
    light = sorted(map(str, event_history(df, heavy=none).collect()))
    heavy = sorted(map(str, event_history(df, heavy=df.select("reviewer_id").distinct()).collect()))
    assert light == heavy and len(light) == len(rows)


@pytest.mark.parametrize("fraction", [0.0, 0.3, 0.5, 0.75, 1.0])
def test_quantiles_are_the_same_for_heavy_and_ordinary_groups(spark, fraction):
    rng = random.Random(5)
    inf, nan = float("inf"), float("nan")
    groups = {
        "rates": [rng.random() ** 6 for _ in range(400)],
        "tiny": [rng.choice([-1, 1]) * rng.random() * 10.0 ** -rng.randrange(300) for _ in range(300)],
        "nan": [1.0, 2.0, nan, 0.5, nan],
        "inf": [inf, inf, -inf, 3.0, 4.0, 5.0],
        "mixed": [0.0, -0.0, 1e300, -1e300, 5e-324, 7.0, 7.0, nan],
        "near": [1.0 + i * 2.0**-52 for i in range(300)],
    }
    rows = [(g, v) for g, vs in groups.items() for v in vs]
    df = spark.createDataFrame(rows, "g STRING, v DOUBLE")
    measures = {"q": (F.col("v"), fraction)}
    light = {r.g: r.q for r in exact_quantiles(df, ["g"], measures, df.select("g").limit(0)).collect()}
    heavy = {r.g: r.q for r in exact_quantiles(df, ["g"], measures, df.select("g").distinct()).collect()}
    assert set(light) == set(heavy) == set(groups)
    for g in groups:
        assert heavy[g] == pytest.approx(light[g], rel=1e-12, nan_ok=True), g
