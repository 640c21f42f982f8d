import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from tallyline import functions as fn


def test_trim_strips_space_separators_but_not_tabs(evaluate):
    got = evaluate(fn.trim_spaces("x"), ["  a b ", " Kenya ", "\ta", None])
    assert got == ["a b", "Kenya", "\ta", None]


def test_blank_to_null(evaluate):
    assert evaluate(fn.blank_to_null("x"), ["  ", "", " a ", None]) == [None, None, "a", None]


def test_phone_and_document(evaluate):
    assert evaluate(fn.phone_digits("x"), ["+254 (7) 12-3", "none", None]) == ["+2547123", None, None]
    ids = ["FAR-24-389531", "far24389531", "FAR 24 389531", "--"]
    assert evaluate(fn.document_code("x"), ids) == ["FAR24389531"] * 3 + [None]


def test_name_key_ignores_order_case_space_and_punctuation(evaluate):
    names = ["ABDI HAWA", "Hawa Abdi", "  hawa   abdi ", "  José  O'Neil-Abdi ", " 12 ", None]
    assert evaluate(fn.name_key("x"), names) == ["abdi hawa"] * 3 + ["jos oneilabdi", None, None]


def test_codes_and_folds(evaluate):
    assert evaluate(fn.upper_code("x", {"KSH": "KES"}), ["Ksh", " kes ", "usd", None]) == [
        "KES", "KES", "USD", None]
    assert evaluate(fn.fold_values("x", {"m": "male", "male": "male"}), [" M ", "Male", "x", None]) == [
        "male", "male", None, None]
    folded = fn.fold_prefix("x", {"active": "active", "closed": "closed"})
    assert evaluate(folded, ["ACTIVE", "Closed (obligations met)", "inactive", None]) == [
        "active", "closed", None, None]


@pytest.mark.parametrize("text, value", [
    ("11,360.00", 11360.0), ("1 175 000", 1175000.0), (" 5. ", 5.0), (".5", 0.5), ("1e3", 1000.0),
    ("-2", -2.0), ("1.5d", None), ("1_000", None), ("", None), ("12%", None), (None, None),
    ("inf", math.inf),
])
def test_parse_number(evaluate, text, value):
    assert evaluate(fn.parse_number("x"), [text]) == [value]


def test_parse_number_finite_only(evaluate):
    assert evaluate(fn.parse_number("x", finite=True), ["nan", "inf", "2"]) == [None, None, 2.0]
    assert math.isnan(evaluate(fn.parse_number("x"), ["nan"])[0])


def test_parse_integer_rounds_half_away_and_checks_range(evaluate):
    texts = ["3.7", "2.5", "-2.5", "1e3", "3000000000", "a year", None]
    assert evaluate(fn.parse_integer("x"), texts) == [4, 3, -3, 1000, None, None, None]


def test_parse_date_formats(evaluate):
    both = fn.parse_date("x", ("yyyy-M-d", "d/M/yyyy"))
    texts = ["1990-05-07", "7/5/1990", "1990", "1990-05", "1990-02-30", " 1990-5-7 ", "", None]
    day = dt.date(1990, 5, 7)
    assert evaluate(both, texts) == [day, day, None, None, None, day, None, None]
    assert evaluate(fn.parse_date("x"), ["7/5/1990"]) == [None]


def test_cast_date_takes_slashes_and_valid_times_only(evaluate):
    texts = ["2026/01/05", "2026-01-05 10:30", "2026-01-05 xyz", "2026-01-05 25:00:00", "2026",
             "2026-01", "2026-01-05 ", None]
    day = dt.date(2026, 1, 5)
    assert evaluate(fn.parse_cast_date("x"), texts) == [day, day, None, None, None, None, day, None]


def test_timestamp_keeps_the_written_digits(evaluate):
    texts = ["2026-07-30T11:31:03+02:00", "2026-07-30 11:31:03Z", "2026-07-30 11:31", "2026-07-30",
             "2026", "30/07/2026", "2026-07-30 25:00", "12:00", None]
    wall = dt.datetime(2026, 7, 30, 11, 31, 3)
    assert evaluate(fn.parse_timestamp("x"), texts) == [
        wall, wall, wall.replace(second=0), dt.datetime(2026, 7, 30), None, None, None, None, None]


def test_timestamp_in_a_named_zone_crosses_the_month_end(evaluate):
    texts = ["2026-07-31T23:30:00Z", "2026-07-31T23:30:00+02:00", "2026-07-31T23:30:00+03:00",
             "2026-07-31 23:30", "2026-07-31"]
    month = fn.month_of(fn.parse_timestamp("x", zone="Africa/Nairobi"))
    assert evaluate(month, texts) == ["2026-08", "2026-08", "2026-07", "2026-08", "2026-07"]
    assert evaluate(fn.month_of(fn.parse_timestamp("x")), texts) == ["2026-07"] * 5


def test_age_on_around_and_off_the_birthday(evaluate):
    as_of = dt.date(2026, 9, 25)
    born = [dt.date(2008, 9, 25), dt.date(2008, 9, 24), dt.date(2008, 9, 26), None]
    assert evaluate(fn.completed_years("x", as_of), born, "date") == [18, 18, 17, None]
    assert evaluate(fn.is_under_age("x", as_of), born, "date") == [False, False, True, None]
    leap = [dt.date(2008, 2, 29)]
    assert evaluate(fn.completed_years("x", dt.date(2026, 2, 28)), leap, "date") == [18]
    assert evaluate(fn.completed_years("x", dt.date(2026, 2, 27)), leap, "date") == [17]


def test_round_half_away_on_the_double_grid(evaluate):
    assert evaluate(fn.round_half_away("x"), [1.005, 2.675, -0.125, 1.5, None], "double") == [
        1.0, 2.68, -0.13, 1.5, None]


def test_exact_sum_keeps_what_no_decimal_holds(spark):
    df = spark.createDataFrame(
        [("a", 0.1)] * 10 + [("b", 1e300), ("b", 1.0), ("c", None), ("d", float("nan"))],
        "g string, x double")
    got = {r["g"]: r["s"] for r in df.groupBy("g").agg(fn.exact_sum("x").alias("s")).collect()}
    assert got["a"] == 1.0 and got["b"] == 1e300 and got["c"] is None and math.isnan(got["d"])


def test_ratio_by_zero_is_null(spark):
    row = spark.range(1).select(fn.safe_ratio(F.lit(1.0), F.lit(0.0)).alias("x")).first()
    assert row["x"] is None
