"""Mergeable sketches on empty groups, missing values, repeats and a group that holds most rows."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from staylens.operators.sketches import Sketches

BOTH = Sketches({"ids": "id"}, {"values": "x"})
RANKS = {"q10": ("values", 0.1), "median": ("values", 0.5), "q90": ("values", 0.9)}


def frame(spark, rows):
    return spark.createDataFrame(rows, "city STRING, place STRING, id BIGINT, x DOUBLE")


def estimated(sketched):
    return {r[0]: r.asDict() for r in BOTH.estimates(sketched, RANKS).collect()}


def test_small_groups_are_exact(spark):
    rows = frame(spark, [
        ("a", "p", 1, 1.0), ("a", "p", 1, 2.0), ("a", "q", 2, 3.0), ("a", None, 1, None), (None, "p", None, None),
        (None, None, 7, float("nan")), ("b", "p", 3, float("inf")), ("b", "p", None, 5.0), ("b", "p", 3, 5.0),
    ])
    fine = BOTH.of(rows, ["city", "place"])
    assert fine.count() == 6
    got = estimated(BOTH.rolled_up(fine, ["city"]))
    assert got == estimated(BOTH.of(rows, ["city"]))
    assert {c: (r["n_rows"], r["ids"], r["median"]) for c, r in got.items()} == {"a": (4, 2, 2.0), "b": (3, 1, 5.0), None: (2, 1, None)}
    assert "values" not in got["a"]


def test_no_rows(spark):
    empty = BOTH.of(frame(spark, []), ["city", "place"])
    assert empty.count() == 0 and estimated(BOTH.rolled_up(empty, ["city"])) == {}


def test_merged_day_by_day_within_bounds(spark):
    rng = random.Random(1)
    rows = [("hot" if rng.random() < 0.8 else f"c{rng.randrange(5)}", f"p{rng.randrange(9)}", rng.randrange(20_000), rng.lognormvariate(3, 2))
            for _ in range(60_000)]
    df = frame(spark, rows).repartition(8)
    kept = BOTH.of(df.filter("id % 3 = 0"), ["city", "place"])
    for day in (1, 2):
        kept = BOTH.merged(kept, BOTH.of(df.filter(F.col("id") % 3 == day), ["city", "place"]), ["city", "place"])
    got = estimated(BOTH.rolled_up(kept, ["city"]))
    for city, found in got.items():
        own = [r for r in rows if r[0] == city]
        distinct = len({r[2] for r in own})
        assert found["n_rows"] == len(own) and abs(found["ids"] - distinct) <= 0.05 * distinct
        for name, (_, rank) in RANKS.items():
            assert abs(sum(r[3] <= found[name] for r in own) / len(own) - rank) < 0.02, (city, name)
    # Rows that come again are no new ids.
    again = BOTH.merged(kept, BOTH.of(df.filter("city <> 'hot'"), ["city", "place"]), ["city", "place"])
    for city, found in estimated(BOTH.rolled_up(again, ["city"])).items():
        distinct = len({r[2] for r in rows if r[0] == city})
        assert abs(found["ids"] - distinct) <= 0.05 * distinct and found["n_rows"] == got[city]["n_rows"] * (1 if city == "hot" else 2)
