"""Column functions on the edge cases of the feeds."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from staylens.functions import arrays, display, flags, numbers, text, times
from staylens.sources import files


def test_price(one):
    raw = ["$1,200.00", "N/A", "", "  ", "1e3", ".5", "(5)", "$-5", None, "none", " 12.5 "]
    assert one(raw, "STRING", numbers.price_amount) == [1200.0, None, None, None, None, None, None, -5.0, None, None, 12.5]


def test_percent(one):
    raw = ["97%", "97.5%", "N/A", None]
    assert one(raw, "STRING", numbers.percent_double) == [97.0, 97.5, 0.0, 0.0]
    assert one(raw, "STRING", numbers.percent_int) == [97, 0, 0, 0]


def test_safe_int_never_raises(one):
    assert one(["99999999999", "12", "+3", "1.0", "x"], "STRING", numbers.safe_int) == [None, 12, 3, None, None]


def test_tf_flag(one):
    raw = [" T ", "yes", "1", "f", "No", "0", "maybe", None]
    assert one(raw, "STRING", flags.tf_flag) == [True, True, True, False, False, False, None, None]


def test_event_flag(one):
    assert one(["t", "yes", "", None, " TRUE ", "no"], "STRING", flags.event_flag) == [False, True, None, None, True, False]


def test_categories(one):
    room = lambda c: text.category_or(c, text.UNKNOWN_CATEGORY)
    assert one([" NaN ", None, " ", " Loft "], "STRING", room) == ["unkown", "unkown", "unkown", "Loft"]
    assert one(["null"], "STRING", lambda c: text.category_or(c, text.NO_NAME)) == [""]
    response = lambda c: text.category_or(c, text.UNKNOWN, text.MISSING_TOKENS)
    assert one(["N/A", "nan"], "STRING", response) == ["unknown", "nan"]
    blank_only = lambda c: text.category_or(c, text.UNKNOWN_CATEGORY, ())
    assert one(["n/a", " ", None], "STRING", blank_only) == ["n/a", "unkown", "unkown"]


def test_html_breaks(one):
    assert one(["a<br />b<br/>c<br>d", None], "STRING", text.html_breaks_to_blanks) == ["a b c d", None]


def test_first_filled(one):
    assert one([" ", None, "x"], "STRING", lambda c: text.first_filled(c, F.lit("fallback"))) == ["fallback", "fallback", "x"]


def test_squeeze(one):
    assert one(["  a \n\t b ", None], "STRING", text.squeeze_whitespace) == ["a b", ""]
    assert one([" EN ", None], "STRING", text.language_code) == ["en", "unknown"]


def test_lists(one):
    parsed = one(["['a','b']", "[\"King's bed\", 'x']", " ", None, "[]", "junk"], "STRING", arrays.list_from_text)
    assert parsed == [["a", "b"], ["King's bed", "x"], None, None, [], None]
    loose = one(["['a', ' b ', '']", "x, y ,,", "", None, "single"], "STRING", arrays.list_from_loose_text)
    assert loose == [["a", "b"], ["x", "y"], None, None, ["single"]]
    labels = one([[" Positive "], [], None], "ARRAY<STRING>", arrays.labels_or_default)
    assert labels == [["positive"], ["positive"], ["positive"]]
    assert one([20000.0, 20000.01, None], "DOUBLE", arrays.boost_level) == [["high"], ["low"], ["high"]]
    assert one([["a"], None], "ARRAY<STRING>", arrays.list_size) == [1, 0]


def test_numbers(one):
    assert one([math.nan, None, 0.5], "FLOAT", numbers.nan_to) == [1.0, 1.0, 0.5]
    assert one([5.0, 5.1, -1.0, 0.0], "DOUBLE", numbers.within) == [5.0, None, None, 0.0]
    assert one([0.0, -2.0, None, 4.0], "DOUBLE", lambda c: numbers.ratio_or_zero(F.lit(8.0), c)) == [0.0, 0.0, 0.0, 2.0]
    assert one([0.29, 0.999], "FLOAT", lambda c: numbers.whole_product(c, F.lit(100), "int")) == [29, 99]
    assert one(["", None, "12", "12.5", "x"], "STRING", numbers.event_int) == [None, None, 12, None, None]
    bad = lambda c: numbers.is_unreadable(c, numbers.event_int(c))
    assert one(["", None, "12", "12.5", "x"], "STRING", bad) == [False, False, False, True, True]


def test_late_window_bounds(one):
    moments = ["2024-01-13 00:00:00", "2024-01-12 23:59:59.999999", "2024-01-17 00:00:00", "2024-01-17 00:00:00.000001", None]
    inside = lambda c: times.in_late_window(c.cast("timestamp"), "2024-01-15 00:00:00")
    assert one(moments, "STRING", inside) == [True, False, True, False, False]


def test_timestamps(one):
    raw = ["2024-01-05T10:00:00Z", "2024-01-05 10:00:00", "2024-01-05T10:00:00+02:00", "later", "", None]
    assert one(raw, "STRING", times.iso_text) == [
        "2024-01-05T10:00:00+00:00", "2024-01-05T10:00:00+00:00", "2024-01-05T08:00:00+00:00", "later", None, None,
    ]
    first = lambda c: times.first_timestamp(c, as_of="2024-01-15 00:00:00").cast("string")
    assert one(["2024-01-05", "junk", None], "STRING", first) == [
        "2024-01-05 00:00:00", "2024-01-15 00:00:00", "2024-01-15 00:00:00",
    ]


def test_display(one):
    assert one([1234567.5, -12.4, None, math.nan], "DOUBLE", display.money) == ["$1,234,568", "$-12", "$0", "$0"]
    assert one([1234.5, 1235.5], "DOUBLE", display.thousands) == ["1,234", "1,236"]
    assert one([0.1234], "DOUBLE", display.percent_of_fraction) == ["12.34%"]
    assert one([1234.5], "DOUBLE", lambda c: display.fixed(c, 4)) == ["1234.5000"]


def test_title_case_follows_every_run_of_letters(one):
    values = ["aix-en-provence", "l'aquila", "MIDDLE EAST", "são paulo", "3rd ward", "", None]
    assert one(values, "STRING", display.title_case) == ["Aix-En-Provence", "L'Aquila", "Middle East", "São Paulo", "3Rd Ward", "", None]


def test_times_need_a_date_to_be_moments(one):
    values = ["12:30", "2024", "2024-01-05", " 2024-01-05 10:00", "", None, "soon"]
    shown = ["12:30", "2024", "2024-01-05T00:00:00+00:00", "2024-01-05T10:00:00+00:00", None, None, "soon"]
    assert one(values, "STRING", times.iso_text) == shown


def test_event_floats_have_no_type_suffix(one):
    values = ["1d", "1f", "1.5", "1e3", ".5", "5.", " 2 ", "inf", "x", "", None]
    got = one(values, "STRING", numbers.event_float)
    assert got == [None, None, 1.5, 1000.0, 0.5, 5.0, 2.0, float("inf"), None, None, None]


def test_city_names_of_several_words_with_a_prefix(spark):
    paths = ["s3://x/listings_new_york_usa.csv.gz", "/a/listings_paris_france.csv", "other_rome_italy.csv", "listings_usa.csv", "one.csv"]
    df = spark.createDataFrame([(p,) for p in paths], "p STRING")
    got = df.select(files.place_from_path(F.col("p"), "listings")["city"]).collect()
    assert [r[0] for r in got] == ["new york", "paris", "rome", "listings", None]
    plain = df.select(files.place_from_path(F.col("p"))["city"]).collect()
    assert [r[0] for r in plain] == ["york", "paris", "rome", "listings", None]
