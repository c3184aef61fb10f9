"""Malformed CSV rows of the feeds, landed and streamed."""

from __future__ import annotations

from staylens import jobs
from staylens.schemas import BRONZE, schema_of
from staylens.sources import landing
from staylens.sources.files import CSV_FORMAT, read_csv
from staylens.sources.quarantine import rejected_rows, without_malformed
from test_jobs import AS_OF, listing, write_listing_file

ADS = [field.split()[0] for field in BRONZE["adsProviders"].split(",")]
DAY = "2024-01-15 10:00:00"


def ad(i, at=DAY, **values):
    row = dict.fromkeys(ADS, "") | {"id": i, "name": f"n{i}", "last_updated": at} | values
    return ",".join(str(row[c]) for c in ADS)


def ads_file(path, *lines):
    path.write_text("\n".join([",".join(ADS), *lines]) + "\n")


BROKEN = {
    "number": (ad(2, total_clicks="many"), "unreadable: total_clicks"),
    "two fields": (ad("x3", total_clicks="1,5"), f"not {len(ADS)} fields"),
    "two values": (ad("x4", avg_conversion_rate="much"), "unreadable: id, avg_conversion_rate"),
    "few": ("5,n5", f"not {len(ADS)} fields"),
}


def apart(df):
    return sorted((r.source_file.split("/")[-1], r.reason, r.line) for r in df.collect())


def test_rows_are_kept_apart_with_file_reason_and_text(spark, tmp_path):
    lines = [line for line, _ in BROKEN.values()]
    ads_file(tmp_path / "a.csv", ad(1, name='"two\nlines, ""x"""'), *lines, ad(6))
    ads_file(tmp_path / "b.csv", ad(7, DAY.replace("01-15", "03-01")), ad(8, ""), '9,"never closed', ad(10))
    malformed, late = str(tmp_path / "malformed"), str(tmp_path / "late")
    paths = [str(tmp_path / f) for f in ("a.csv", "b.csv")]
    landed = landing.land_ads(spark, paths, str(tmp_path / "ads"), AS_OF, late, malformed)
    assert {r.id: r.name for r in landed.collect()} == {1: 'two\nlines, "x"', 6: "n6"}
    assert sorted(r.id for r in spark.read.parquet(late).collect()) == [7, 8]
    got = apart(spark.read.parquet(malformed))
    assert [g for g in got if g[0] == "a"] == sorted(("a", why, line) for line, why in BROKEN.values())
    # What a quote that is never closed swallows is one row, with all its text.
    (swallowed,) = [g for g in got if g[0] == "b"]
    assert swallowed[1] == f"not {len(ADS)} fields" and "never closed" in swallowed[2] and "n10" in swallowed[2]
    # Without a place for them they land with NULLs, as published.
    assert landing.land_ads(spark, paths, str(tmp_path / "all"), AS_OF, late).count() + spark.read.parquet(late).count() == 9


def test_a_row_is_malformed_whatever_columns_are_read(spark, tmp_path):
    ads_file(tmp_path / "a.csv", ad(1), *[line for line, _ in BROKEN.values()])
    rows = read_csv(spark, schema_of("adsProviders"), str(tmp_path / "a.csv"), AS_OF, keep_malformed=True)
    assert [r.id for r in without_malformed(rows).select("id").collect()] == [1]
    assert without_malformed(rows).count() == 1 and rows.count() == 5
    none = read_csv(spark, schema_of("adsProviders"), str(tmp_path / "a.csv"), AS_OF, keep_malformed=True).limit(0)
    assert rejected_rows(none.withColumnRenamed("filename", "source_file"), schema_of("adsProviders"), CSV_FORMAT).count() == 0


def test_listings_replace_their_malformed_rows_by_file(spark, tmp_path):
    target, malformed = str(tmp_path / "bronze"), str(tmp_path / "malformed")
    one, other = tmp_path / "listings_chicago_usa.csv", tmp_path / "listings_a=b_usa.csv"

    def land(*files):
        return landing.land_listings(spark, [str(f) for f in files], target, AS_OF, malformed=malformed)

    write_listing_file(one, [listing(1), listing("first"), listing(2, latitude="north", description="x\ny")])
    write_listing_file(other, [listing(3), listing("third")])
    assert sorted(r.id for r in land(one, other).collect()) == [1, 3]
    got = apart(spark.read.parquet(malformed))
    assert [(f, why) for f, why, _ in got][:1] == [("listings_a=b_usa", "unreadable: id")]
    assert {why for f, why, _ in got if f == "listings_chicago_usa"} == {"unreadable: id", "unreadable: latitude"}
    write_listing_file(other, [listing(3), listing(4)])
    assert sorted(r.id for r in land(other).collect()) == [1, 3, 4]
    assert {f for f, _, _ in apart(spark.read.parquet(malformed))} == {"listings_chicago_usa"}


def test_streamed_ads(spark, tmp_path):
    source, bronze, malformed = tmp_path / "in", str(tmp_path / "ads"), str(tmp_path / "malformed")
    source.mkdir()
    ads_file(source / "a.csv", ad(1), *[line for line, _ in BROKEN.values()])

    def run():
        counts = jobs.stream_ads(spark, str(source), bronze, str(tmp_path / "c"), AS_OF, max_files=1, malformed=malformed)
        sides = [sorted(r.id for r in spark.read.parquet(p).collect()) for p in (bronze, f"{bronze}_late")]
        return sides, {r.source_file[-5:]: (r.n_rows, r.n_late) for r in counts.collect()}

    wrong = sorted(("a.csv", why, line) for line, why in BROKEN.values())
    assert run() == ([[1], []], {"a.csv": (1, 0)}) and apart(spark.read.parquet(malformed)) == wrong
    ads_file(source / "b.csv", ad(2, "2023-01-01 00:00:00"), BROKEN["few"][0])
    assert run() == ([[1], [2]], {"a.csv": (1, 0), "b.csv": (1, 1)})
    assert apart(spark.read.parquet(malformed)) == sorted([*wrong, ("b.csv", BROKEN["few"][1], BROKEN["few"][0])])
