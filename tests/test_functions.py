from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lonja import functions as fn


def applied(rows, column, *values, kind="STRING"):
    return [row[0] for row in rows(f"x {kind}", *values).select(column).collect()]


SIZES = {
    "EU 36": "36", " T38 ": "38", "37,5": "37.5", "36.5": "36.5", "TALLA 40": "40", "talla 40": "40", "esp.41": "41",
    "7": "7", "EU36,5": "36.5", "T.  39": "39", "36,0": None, "EUR 36": None, "136": None, "38.25": None, "XL": None,
    "": None, None: None, "36 EU": None, "-36": None,
}


def test_sizes(rows):
    assert applied(rows, fn.shoe_size("x"), *SIZES) == list(SIZES.values())


def test_dates_are_cast_and_not_parsed_by_a_pattern(rows, plan):
    made = rows("x STRING", "2024-03-04").select(fn.day_from_text("x").alias("d"))
    assert "gettimestamp" not in plan(made)


def test_dates_of_other_forms(rows):
    """What the pattern yyyy-MM-dd reads beside four digits, what only a cast would read, and what no timestamp can hold."""
    good = {"-2024-01-01": "-2024-01-01", "+12345-01-01": "+12345-01-01", "0000-01-01": "0000-01-01", "+02024-01-01": "2024-01-01"}
    bad = ["2024", "2024-01", "+2024-01-01", "12345-01-01", "-0000-01-01", "2024-01-02T00:00:00", "2024-01-02\n", "\t2024-01-02", "+1234567-01-01"]
    assert applied(rows, fn.day_from_text("x").cast("string"), *good, *bad) == [*good.values()] + [None] * len(bad)


def test_dates_in_four_formats(rows):
    day = date(2024, 3, 4)
    good = ["2024-03-04", "04/03/2024", "04-03-2024", "04.03.2024", "  04/03/2024 "]
    bad = ["31/02/2024", "x", "", None, "04/03-2024", "4/3/2024", "2024/03/04", "2024-3-4", "04032024", "2024-13-01"]
    assert applied(rows, fn.day_from_text("x"), *good, *bad) == [day] * len(good) + [None] * len(bad)


PRICES = {
    "€89,90": 89.9, "1.234,56": 1234.56, "1,234.56": 1234.56, "89.90 EUR": 89.9, "89,9 eur": 89.9, "$12": 12.0,
    "1.234": 1.234, "1,234": 1.234, "1.234.567,89": 1234567.89, "1,234,567.89": 1234567.89, "-5": -5.0, "+5": 5.0,
    "1 234,5": 1234.5, " 12 ": 12.0, ".5": 0.5, ",5": 0.5, "5.": 5.0, "0": 0.0,
    "1.234.567": None, "1,234,567": None, "1,234.567,89": None, "abc": None, "": None, None: None, "nan": None,
    "inf": None, "1e3": None, "5d": None, "1_000": None, "12 uds": None, "--5": None, "€": None, ".": None,
}


def test_prices(rows):
    assert applied(rows, fn.price_value("x"), *PRICES) == list(PRICES.values())


def test_exact_prices_keep_four_decimals(rows):
    found = applied(rows, fn.exact_price("x"), "1.234", "€1.234,56", "0,0001", "123456789012345678")
    assert found == [Decimal("1.2340"), Decimal("1234.5600"), Decimal("0.0001"), None]


def test_whole_numbers(rows):
    assert applied(rows, fn.whole_number("x"), "3", " 4 ", "3.7", "-2", "3.", "x", "", None, "99999999999", "1e2") == [
        3, 4, 3, -2, 3, None, None, None, None, None,
    ]


def test_emails(rows):
    good, bad = ["a@b.es", "a.b@c.d.com"], ["a@b", "ab.es", "a b@c.es", "a@@b.es", "a@b.e", ""]
    assert applied(rows, fn.is_email("x"), *good, *bad) == [True] * len(good) + [False] * len(bad)


def test_text(rows):
    assert applied(rows, fn.title_trim("x"), "  VILLA nueva ", None) == ["Villa Nueva", None]
    assert applied(rows, fn.upper_trim("x"), " sku-1 ") == ["SKU-1"]
    assert applied(rows, fn.joined("x"), (["a", "b"],), (None,), kind="ARRAY<STRING>") == ["a,b", ""]


@pytest.mark.parametrize("session_zone", ["UTC", "America/New_York"])
def test_event_times_do_not_depend_on_the_session_zone(spark, rows, session_zone):
    spark.conf.set("spark.sql.session.timeZone", session_zone)
    try:
        texts = [
            "2024-05-01T10:00:00", "2024-05-01 10:00", "2024-05-01", "2024-05-01T10:00:00Z", "2024-05-01T10:00:00.250+00:00",
            "2024-05-01T10:00:00+0200", "2024-05-01T10:00:00-05:00", "ayer", "", None,
            "2024-05-01T10:00:00 Europe/Madrid", "2024-05-01T10:00:00 CET", "2024-05-01T10:00:00+1:00", "2024-5-1", "2024-05-01T10",
        ]
        in_madrid = fn.wall_clock(fn.event_instant("x", "Europe/Madrid"))
        assert applied(rows, in_madrid, *texts) == [
            datetime(2024, 5, 1, 8), datetime(2024, 5, 1, 8), datetime(2024, 4, 30, 22), datetime(2024, 5, 1, 10),
            datetime(2024, 5, 1, 10, 0, 0, 250000), datetime(2024, 5, 1, 8), datetime(2024, 5, 1, 15), None, None, None,
            datetime(2024, 5, 1, 8), datetime(2024, 5, 1, 8), datetime(2024, 5, 1, 9), datetime(2024, 4, 30, 22), datetime(2024, 5, 1, 8),
        ]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_calendar(rows):
    days = rows("x DATE", date(2024, 12, 30), date(2024, 12, 29)).select(*fn.calendar_columns("x")).collect()
    assert [tuple(day) for day in days] == [(2024, 12, 1, 2, False), (2024, 12, 52, 1, True)]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_bad_text_never_fails(spark, rows, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        table = rows("x STRING", "zz", "31/02/2024", None)
        out = table.select(
            fn.price_value("x"), fn.exact_price("x"), fn.day_from_text("x"), fn.whole_number("x"), fn.event_instant("x")
        )
        assert all(value is None for row in out.collect() for value in row)
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_price_expression_mentions_its_input_once(rows):
    text = rows("x STRING", "1").select(fn.exact_price("x").alias("p"))._jdf.queryExecution().analyzed().toString()
    assert text.count("upper(x") == 1


def test_sum_of_money_is_exact(rows):
    total = rows("x STRING", *["0,1"] * 10).agg(F.sum(fn.exact_price("x"))).first()[0]
    assert total == Decimal("1.0000")
