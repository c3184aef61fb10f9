"""Batch jobs end to end on small files, and the registered queries at the smallest scale."""

from __future__ import annotations

import csv
import gzip

import pytest
from pyspark.sql import functions as F

from staylens import jobs
from staylens.operators.schema_ops import cast_to_schema
from staylens.plans import gold, questions, silver_ads
from staylens.schemas import LISTING_TABLES, schema_of, table_names
from staylens.sources import landing
from staylens.sources.files import read_csv, read_if_there, read_optional, read_raw_csv
from staylens.sources.sinks import TablesFailedError, write_table, write_tables
from staylens.streaming.upsert import upsert_batch

AS_OF = "2024-01-15 00:00:00"


def write_listing_file(path, rows, opener=open):
    names = schema_of("listing").names
    with opener(path, "wt", encoding="utf-8", newline="") as file:
        writer = csv.DictWriter(file, names)
        writer.writeheader()
        writer.writerows(rows)


def listing(i, **values):
    base = {
        "id": i, "name": f"Flat {i}", "description": "a<br />b", "price": "$1,200.00", "room_type": "Loft",
        "host_response_rate": "97%", "host_acceptance_rate": "90%", "host_is_superhost": "t",
        "amenities": '["Wifi", "King\'s bed"]', "estimated_revenue_l365d": 24000, "latitude": 1.5, "longitude": 2.5,
        "neighbourhood": "Loop", "availability_365": 100, "last_scraped": "2024-01-01",
    }
    return base | values


@pytest.fixture
def bronze(spark, tmp_path):
    write_listing_file(
        tmp_path / "listings_chicago_usa.csv.gz",
        [listing(3_000_000_000, description='two\nlines, "quoted"'), listing("", name="no id")],
        gzip.open,
    )
    write_listing_file(
        tmp_path / "listings_new_york_usa.csv",
        [listing(2, price="N/A", room_type=" NaN "), listing(2, price="N/A", room_type=" NaN ")],
    )
    paths = [str(p) for p in sorted(tmp_path.glob("listings_*"))]
    return landing.land_listings(spark, paths, str(tmp_path / "bronze"), AS_OF)


def test_registry():
    assert len(table_names()) == 25


def test_landing(spark, bronze, tmp_path):
    assert {(r.source_file, r.city, r.country) for r in bronze.collect()} == {
        ("listings_chicago_usa", "chicago", "usa"),
        ("listings_new_york_usa", "york", "usa"),
    }
    row = bronze.filter("id = 3000000000").first()
    assert row.description == 'two\nlines, "quoted"' and row.amenities == ["Wifi", "King's bed"]
    again = landing.land_listings(spark, str(tmp_path / "listings_new_york_usa.csv"), str(tmp_path / "bronze"), AS_OF)
    assert again.count() == 4  # the file's own folder was replaced, the other kept


def test_csv_needs_a_path(spark):
    for paths in (None, [], ""):
        with pytest.raises(ValueError):
            read_csv(spark, schema_of("listing"), paths)


def test_listing_to_answers(spark, bronze, tmp_path):
    silver, target = str(tmp_path / "silver"), str(tmp_path / "gold")
    statuses, quality = jobs.listings_to_silver(spark, bronze, silver)
    assert [s.rows for s in statuses] == [2] * 6
    checked = quality.first()
    assert (checked["total_rows"], checked["id_nulls"], checked["price_transform_nulls"]) == (4, 1, 0)
    details = {r.id: r for r in spark.read.parquet(f"{silver}/HostDetails.parquet").collect()}
    assert details[2].room_type == "unkown" and details[3_000_000_000].host_is_superhost is True
    prices = {r.id: r.price_per_night for r in spark.read.parquet(f"{silver}/RentMetrics.parquet").collect()}
    assert prices == {2: 0.0, 3_000_000_000: 1200.0}

    reviews = spark.createDataFrame(
        [(3_000_000_000, 1, "2024-01-01", 7, "Ann"), (3_000_000_000, 1, "2024-01-01", 7, "Ann"),
         (None, 2, "2024-01-03", 7, "Ann"), (2, 3, None, None, "nobody")],
        "listing_id BIGINT, id BIGINT, date STRING, reviewer_id BIGINT, reviewer_name STRING",
    )
    jobs.reviews_to_silver(spark, cast_to_schema(reviews, schema_of("reviews")), silver, AS_OF)
    stored = {r.id: r for r in spark.read.parquet(f"{silver}/Review.parquet").collect()}
    assert set(stored) == {1, 2} and stored[2].listing_id == -1
    assert stored[1].end_date == stored[2].date and stored[2].is_current

    # The same reviews kept by the stream give the same facts.
    streamed = str(tmp_path / "silver_streamed")
    for table in LISTING_TABLES:
        spark.read.parquet(f"{silver}/{table}.parquet").write.parquet(f"{streamed}/{table}.parquet")
    for n in range(2):
        rows = cast_to_schema(reviews, schema_of("reviews")).filter(f"id > {n}")
        upsert_batch(rows, n, f"{streamed}/Review.parquet", AS_OF)
    jobs.silver_to_gold(spark, streamed, str(tmp_path / "gold_streamed"), AS_OF)
    facts = sorted(map(str, spark.read.parquet(str(tmp_path / "gold_streamed/factReview.parquet")).collect()))

    statuses = jobs.silver_to_gold(spark, silver, target, AS_OF)
    assert sorted(map(str, spark.read.parquet(f"{target}/factReview.parquet").collect())) == facts
    assert "AggAds" not in {s.table for s in statuses}
    again = jobs.silver_to_gold(spark, silver, target, "2024-01-16 00:00:00")
    assert {s.table: s.rows for s in again} == {s.table: s.rows for s in statuses}
    host = spark.read.parquet(f"{target}/dimHost.parquet")
    assert {str(r.start_date) for r in host.collect()} == {AS_OF}  # nothing changed: history untouched

    reports = jobs.answers(spark, target)
    cards = reports["invest_cards"].collect()
    assert [c.city for c in cards] == ["Chicago", "York"]
    assert cards[0].revenue == "$24,000" and cards[0].avg_price == "$1,200" and cards[0].boost == "low"
    assert reports["invest_markers"].count() == 2

    # A listing that a silver table holds twice counts once, with its latest row.
    places = spark.read.parquet(f"{silver}/Location.parquet")
    older = places.withColumn("ingestion_ts", F.expr("ingestion_ts - INTERVAL 1 DAY")).withColumn("city", F.lit("Nowhere"))
    for table in (*LISTING_TABLES, "Review"):
        rows = places.unionByName(older) if table == "Location" else spark.read.parquet(f"{silver}/{table}.parquet")
        rows.write.parquet(f"{tmp_path}/silver_twice/{table}.parquet")
    with pytest.warns(UserWarning, match="more than once"):
        jobs.silver_to_gold(spark, f"{tmp_path}/silver_twice", f"{tmp_path}/gold_twice", AS_OF)
    for mart in ("AggNeighbourhoodInvest", "AggNeighborhoodPerformance", "dimLocation", "factListing"):
        one, twice = (
            sorted(map(str, spark.read.parquet(f"{folder}/{mart}.parquet").drop("ingestion_ts").collect()))
            for folder in (f"{tmp_path}/gold_streamed", f"{tmp_path}/gold_twice")
        )
        assert one == twice, mart


def test_reviews_without_rows_are_an_error(spark, tmp_path):
    empty = spark.createDataFrame([], schema_of("reviews"))
    with pytest.raises(ValueError, match="reviews"):
        jobs.reviews_to_silver(spark, empty, str(tmp_path), AS_OF)


def test_ads_job(spark, tmp_path):
    path = tmp_path / "ads.csv"
    names = schema_of("adsProviders").names
    rows = [
        {"id": 1, "name": "null", "last_updated": "2024-01-14 00:00:00", "total_clicks": 100, "avg_conversion_rate": 0.29,
         "total_ad_spend": 50.0, "concurrent_campaigns_count": 4},
        {"id": 2, "name": " Ad Co ", "last_updated": "2022-01-14 00:00:00"},
        {"id": 3, "name": "x", "last_updated": ""},
    ]
    with open(path, "w", newline="") as file:
        writer = csv.DictWriter(file, names)
        writer.writeheader()
        writer.writerows(rows)
    assert landing.land_ads(spark, str(tmp_path / "absent.csv"), str(tmp_path / "none"), AS_OF) is None
    bronze = landing.land_ads(spark, str(path), str(tmp_path / "bronze"), AS_OF, str(tmp_path / "late"))
    assert [r.id for r in bronze.collect()] == [1]
    assert sorted(r.id for r in spark.read.parquet(str(tmp_path / "late")).collect()) == [2, 3]
    tables = silver_ads.split_ads(silver_ads.clean_ads(bronze, AS_OF))
    row = tables["providerMetrics"].first()
    assert row.region_coverage == "unkown" and row.ctr == 0.0 and str(row.partition_date) == "2024-01-14 00:00:00"
    ads = gold.provider_marts(tables["providerDetails"], tables["providerMetrics"], AS_OF)["AggAds"]
    mart = ads.first()
    assert (mart.provider_name, mart.avg_campaign_cost, mart.customer_gained, mart.new_customers_l30d_pct) == ("", 12.5, 29, 29)
    assert questions.provider_cards(ads).first().conversion == "29.00%"
    assert jobs.ads_to_silver(spark, bronze.filter("id > 5"), str(tmp_path / "silver")) == []


def test_one_failing_table_does_not_stop_the_others(spark, tmp_path):
    good = spark.range(3)
    bad = good.selectExpr("id", "raise_error('broken') AS x")
    with pytest.raises(TablesFailedError) as failure:
        write_tables({"bad": bad, "good": good}, str(tmp_path))
    assert {s.table: (s.ok, s.rows) for s in failure.value.statuses} == {"bad": (False, None), "good": (True, 3)}
    assert spark.read.parquet(str(tmp_path / "good.parquet")).count() == 3


def test_missing_table_is_empty_with_a_warning(spark, tmp_path):
    with pytest.warns(UserWarning, match="no data"):
        assert read_optional(spark, str(tmp_path / "no.parquet"), schema_of("AggAds")).isEmpty()


def ads_file(path, rows):
    with open(path, "w", newline="") as file:
        writer = csv.DictWriter(file, schema_of("adsProviders").names)
        writer.writeheader()
        writer.writerows(rows)
    return str(path)


def test_every_ads_file_is_landed_and_late_rows_are_kept(spark, tmp_path):
    on_time, late = "2024-01-14 00:00:00", "2022-01-14 00:00:00"
    ads_file(tmp_path / "ads_1.csv", [{"id": 1, "last_updated": on_time}, {"id": 2, "last_updated": late}])
    ads_file(tmp_path / "ads_2.csv", [{"id": 3, "last_updated": on_time}, {"id": 4, "last_updated": ""}])
    files, bronze = [str(tmp_path / f"ads_{n}.csv") for n in (1, 2, 3)], str(tmp_path / "bronze")
    jobs.run(["ads", "--input", *files, "--bronze", bronze, "--silver", str(tmp_path / "silver"), "--as-of", AS_OF])
    assert sorted(r.id for r in spark.read.parquet(bronze).collect()) == [1, 3]
    assert sorted(r.id for r in spark.read.parquet(f"{bronze}_late").collect()) == [2, 4]
    assert sorted(r.id for r in spark.read.parquet(str(tmp_path / "silver/providerMetrics.parquet")).collect()) == [1, 3]


def test_raw_csv_is_read_by_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,listing_id,reviewer_id\n1,10,100\n3,"3\n0",300\n')
    (tmp_path / "b.csv").write_text("reviewer_id,id,listing_id\n200,2,20\n")
    (tmp_path / "c.csv").write_text("id,reviewer_id\n4,400\n")
    rows = read_raw_csv(spark, str(tmp_path)).select("id", "listing_id", "reviewer_id").collect()
    assert sorted(map(tuple, rows)) == [("1", "10", "100"), ("2", "20", "200"), ("3", "3\n0", "300"), ("4", None, "400")]


def test_a_moved_column_is_an_error(spark, tmp_path):
    names = schema_of("adsProviders").names
    moved = [names[1], names[0], *names[2:]]
    (tmp_path / "ads.csv").write_text(",".join(moved) + "\n" + "," * (len(names) - 1) + "\n")
    with pytest.raises(Exception, match="header"):
        read_csv(spark, schema_of("adsProviders"), str(tmp_path / "ads.csv")).collect()


def test_a_failed_write_leaves_the_table(spark, tmp_path):
    path = str(tmp_path / "t.parquet")
    write_table(spark.range(3), path)
    with pytest.raises(Exception, match="broken"):
        write_table(spark.range(9).selectExpr("if(id > 5, raise_error('broken'), id) AS id"), path)
    assert spark.read.parquet(path).count() == 3
    write_table(spark.read.parquet(path).selectExpr("id + 1 AS id"), path)  # read while it is replaced
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [1, 2, 3]
    # A switch that was cut off between its renames: the previous state is still found.
    (tmp_path / "t.parquet").rename(tmp_path / "moved")
    assert sorted(r.id for r in read_if_there(spark, path).collect()) == [0, 1, 2]


def test_an_ads_mart_without_shown_columns_gives_empty_reports(spark):
    mart = spark.createDataFrame([(1, "a")], "provider_id BIGINT, provider_name STRING")
    with pytest.warns(UserWarning, match="advertising mart lacks provider_conversion_rate"):
        reports = questions.promotion_answer(mart)
    assert [reports[name].count() for name in ("cards", "chart", "table")] == [0, 0, 0]
    assert reports["kpis"].first().provider_count == 0


def test_city_names_of_several_words_land_whole(spark, tmp_path):
    path = tmp_path / "listings_new_york_usa.csv"
    write_listing_file(path, [listing(1)])
    landed = landing.land_listings(spark, str(path), str(tmp_path / "bronze"), AS_OF, prefix="listings")
    assert [(r.city, r.country) for r in landed.collect()] == [("new york", "usa")]


def test_answers_for_one_city(spark):
    invest = spark.createDataFrame(
        [("lyon", "Old", 9.0), ("aix-en-provence", "Mill", 5.0), ("lyon", "New", 1.0)],
        "city_name STRING, neighbourhood_name STRING, avg_revenue_l365d DOUBLE",
    )
    invest = cast_to_schema(invest, schema_of("AggNeighbourhoodInvest"))
    located = spark.createDataFrame(
        [(1, " Lyon", "Old", 1.0, 2.0, 10, 3, 5.0), (2, "Aix-en-Provence", "Mill", 1.0, 2.0, 20, 3, 5.0)],
        "id BIGINT, city STRING, neighbourhood STRING, latitude DOUBLE, longitude DOUBLE, estimated_revenue_l365d INT, "
        "estimated_occupancy_l365d INT, price_per_night DOUBLE",
    )
    page = questions.invest_answer(invest, located, " LYON ")
    assert [r.city for r in page["city_kpi_texts"].collect()] == ["Lyon"]
    assert [r.listing_id for r in page["markers"].collect()] == [1]
    first = questions.invest_answer(invest, located, "nowhere")
    assert [r.city for r in first["city_kpi_texts"].collect()] == ["Aix-En-Provence"]
    assert [r.listing_id for r in first["markers"].collect()] == [2]
    with pytest.warns(UserWarning, match="avg_order_price"):
        assert questions.invest_answer(invest.drop("avg_order_price"), located)["cards"].isEmpty()
