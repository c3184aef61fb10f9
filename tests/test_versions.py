"""Layers whose tables change in one commit, and histories whose closed rows are written once."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from staylens import jobs
from staylens.operators.history import scd2_merge, scd2_step
from staylens.operators.schema_ops import cast_to_schema
from staylens.schemas import schema_of
from staylens.sources import landing, sinks, versions
from staylens.sources.files import write_once
from staylens.sources.sinks import TablesFailedError, write_table, write_tables, write_versions
from test_jobs import AS_OF, listing, write_listing_file

DIM = "k BIGINT, start_date TIMESTAMP, end_date TIMESTAMP, is_current BOOLEAN, name STRING"


def values(spark, layer, *tables):
    return {t: sorted(map(tuple, df.collect())) for t, df in versions.read_available(spark, layer, tables).items()}


def files(folder):
    return {str(p.relative_to(folder)): p.stat().st_mtime_ns for p in folder.rglob("*.parquet")}


def number(spark, n):
    return spark.range(n, n + 1)


def test_all_tables_or_none(spark, tmp_path):
    layer = str(tmp_path)
    write_tables({"a": number(spark, 1), "b": number(spark, 1)}, layer, versioned=True)
    before = files(tmp_path)
    bad = number(spark, 2).select(F.raise_error(F.lit("no")).alias("id"))
    with pytest.raises(TablesFailedError, match="b: .*no") as failed:
        write_tables({"a": number(spark, 2), "b": bad}, layer)
    assert [s.ok for s in failed.value.statuses] == [True, False]
    assert values(spark, layer, "a", "b") == {"a": [(1,)], "b": [(1,)]} and files(tmp_path) == before
    statuses = write_tables({"a": number(spark, 2), "b": number(spark, 2)}, layer)
    assert [s.rows for s in statuses] == [1, 1]
    assert values(spark, layer, "a", "b", "c") == {"a": [(2,)], "b": [(2,)]}


def test_a_job_that_dies_between_two_tables(spark, tmp_path, monkeypatch):
    layer = str(tmp_path)
    write_tables({"a": number(spark, 1), "b": number(spark, 1)}, layer, versioned=True)

    def dies_at_b(df, folder, name, *rest):
        if name == "b":
            raise KeyboardInterrupt
        return versions.write_part(df, folder, name, *rest)

    monkeypatch.setattr(sinks, "write_part", dies_at_b)
    with pytest.raises(KeyboardInterrupt):
        write_tables({"a": number(spark, 2), "b": number(spark, 2)}, layer)
    monkeypatch.undo()
    assert values(spark, layer, "a", "b") == {"a": [(1,)], "b": [(1,)]}
    # What it left belongs to no version, and goes once its number is taken.
    assert versions.vacuum(spark, layer) == []
    write_tables({"a": number(spark, 3), "b": number(spark, 3)}, layer)
    assert len(versions.vacuum(spark, layer, keep=1)) == 3
    assert values(spark, layer, "a", "b") == {"a": [(3,)], "b": [(3,)]}
    assert len({name.rpartition("/")[0] for name in files(tmp_path)}) == 2


def test_two_writers(spark, tmp_path):
    layer = str(tmp_path)
    write_versions(spark, {"a": number(spark, 1), "b": number(spark, 1)}, layer)
    base = versions.latest(spark, layer)
    write_versions(spark, {"a": number(spark, 2)}, layer, base=base)
    write_versions(spark, {"b": number(spark, 2)}, layer, base=base)  # another table: both hold
    assert values(spark, layer, "a", "b") == {"a": [(2,)], "b": [(2,)]}
    with pytest.raises(versions.VersionConflictError, match="a"):
        write_versions(spark, {"a": number(spark, 3)}, layer, base=base)
    assert versions.latest(spark, layer).number == 3
    # Readers of an older version still read it.
    assert [r.id for r in versions.read_available(spark, layer, ["a"], base)["a"].collect()] == [1]


def test_a_number_is_taken_once(spark, tmp_path):
    path = f"{tmp_path}/log/1.json"
    assert write_once(spark, path, "first ü") and not write_once(spark, path, "second")
    assert (tmp_path / "log/1.json").read_text() == "first ü"
    assert [p.name for p in (tmp_path / "log").iterdir() if not p.name.startswith(".")] == ["1.json"]


def test_nothing_there(spark, tmp_path):
    layer = f"{tmp_path}/none"
    assert versions.latest(spark, layer).number == 0 and not versions.is_versioned(spark, layer)
    assert versions.vacuum(spark, layer) == [] and values(spark, layer, "a") == {}
    with pytest.raises(ValueError):
        versions.vacuum(spark, layer, keep=0)
    write_versions(spark, {"dim": spark.createDataFrame([], DIM)}, layer, {"dim": F.col("is_current")})
    assert values(spark, layer, "dim") == {} and versions.latest(spark, layer).number == 1


def dimension(spark, rows):
    return spark.createDataFrame(rows, "k BIGINT, name STRING")


@pytest.mark.parametrize("n_closed", [10, 20_000])
def test_closed_rows_are_written_once(spark, tmp_path, n_closed):
    """Bytes written by a merge do not depend on how many rows were closed before."""
    layer, is_open = str(tmp_path), {"dim": F.col("is_current")}
    day = F.lit("2023-01-01").cast("timestamp")
    closed = spark.range(n_closed).select(
        F.col("id").alias("k"), day.alias("start_date"), day.alias("end_date"), F.lit(False).alias("is_current"),
        F.sha2(F.col("id").cast("string"), 256).alias("name"),
    )
    opened = spark.createDataFrame([(1, "a"), (2, None), (3, "c")], "k BIGINT, name STRING").select(
        "k", day.alias("start_date"), F.lit(None).cast("timestamp").alias("end_date"), F.lit(True).alias("is_current"), "name"
    )
    history = closed.unionByName(opened)
    write_versions(spark, {"dim": history}, layer, is_open)
    expected, sizes = history, []
    days = [[(1, "a"), (2, "b"), (4, None)], [(1, "a"), (2, None), (4, None)], [(1, "x"), (2, None), (4, "d")]]
    for n, rows in enumerate(days):
        now, before = f"2024-01-0{n + 1} 00:00:00", files(tmp_path)
        expected = scd2_merge(expected, dimension(spark, rows), "k", ["name"], now, close_vanished=n == 2)
        step = scd2_step(
            versions.read_replaced(spark, layer, "dim"), dimension(spark, rows), "k", ["name"], now, close_vanished=n == 2
        )
        write_versions(spark, {"dim": step}, layer, is_open)
        after = files(tmp_path)
        assert before.items() <= after.items()  # no file of an earlier commit was touched
        sizes.append(sum((tmp_path / f).stat().st_size for f in after.keys() - before.keys()))
    as_rows = lambda df: sorted(map(repr, df.select("k", "start_date", "end_date", "is_current", "name").collect()))
    assert as_rows(versions.read_available(spark, layer, ["dim"])["dim"]) == as_rows(expected)
    assert max(sizes) < 20_000  # three open rows and the ones closed now; 20,000 hashes take a megabyte
    versions.vacuum(spark, layer, keep=1)
    assert as_rows(versions.read_available(spark, layer, ["dim"])["dim"]) == as_rows(expected)


def test_gold_with_versions_is_gold_without(spark, tmp_path):
    """Three days of listings; one target plain, one with versions, one that is taken over on the second day."""
    reviews = spark.createDataFrame(
        [(1, 1, "2024-01-01", 7, "Ann"), (1, 2, "2024-01-03", 7, "Ann")],
        "listing_id BIGINT, id BIGINT, date STRING, reviewer_id BIGINT, reviewer_name STRING",
    )
    targets = {"plain": [False] * 3, "versions": [True, None, None], "taken": [False, True, None]}
    days = [
        [listing(1, host_name="Ann"), listing(2, host_name="Bob")],
        [listing(1, host_name="Anna"), listing(2, host_name="Bob"), listing(3, host_name="Cleo", neighbourhood="Pilsen")],
        [listing(1, host_name="Ann", beds=4), listing(3, host_name="Cleo")],
    ]
    silver = f"{tmp_path}/silver"
    for n, rows in enumerate(days):
        as_of = f"2024-01-{15 + n} 00:00:00"
        write_listing_file(tmp_path / "listings_chicago_usa.csv", rows)
        bronze = landing.land_listings(spark, f"{tmp_path}/listings_chicago_usa.csv", f"{tmp_path}/bronze", as_of)
        jobs.listings_to_silver(spark, bronze, silver, versioned=True)
        if n == 0:
            jobs.reviews_to_silver(spark, cast_to_schema(reviews, schema_of("reviews")), silver, AS_OF)
        for target, flags in targets.items():
            jobs.silver_to_gold(spark, silver, f"{tmp_path}/{target}", as_of, close_vanished=True, versioned=flags[n], sketches=n == 2)
    marts = ["dimHost", "dimProperty", "dimLocation", "factListing", "factReview", "AggNeighbourhoodInvest"]
    results = {
        target: {m: sorted(map(repr, df.select(*sorted(df.columns)).collect()))
                 for m, df in versions.read_available(spark, f"{tmp_path}/{target}", marts).items()}
        for target in targets
    }
    assert set(results["plain"]) == set(marts)
    assert results["versions"] == results["plain"] and results["taken"] == results["plain"]
    assert len(results["plain"]["dimHost"]) > 3
    reports = {t: [c.asDict() for c in jobs.answers(spark, f"{tmp_path}/{t}")["invest_cards"].collect()] for t in targets}
    assert reports["versions"] == reports["plain"] == reports["taken"] and reports["plain"]
    (audience,) = jobs.answers(spark, f"{tmp_path}/versions")["invest_audience"].collect()
    assert (audience.city_name, audience.listings, audience.reviewers, audience.median_availability) == ("chicago", 2, 1, 100.0)


def test_plain_tables_stay_plain(spark, tmp_path):
    write_tables({"a": number(spark, 1)}, str(tmp_path))
    assert spark.read.parquet(f"{tmp_path}/a.parquet").count() == 1
    write_table(number(spark, 5), f"{tmp_path}/a.parquet")
    assert values(spark, str(tmp_path), "a") == {"a": [(5,)]}
    with pytest.raises(ValueError, match="as a whole"):
        write_tables({"a": number(spark, 1)}, str(tmp_path), mode="append", versioned=True)
