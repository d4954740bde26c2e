import datetime as dt
from decimal import Decimal

import pytest
from helpers import one, rows, settings
from pyspark.sql import functions as F

from bankmart.functions import dates, numbers, text
from bankmart.schemas import NULL_MARKERS


def value(spark, column):
    return one(spark.range(1).select(column))[0]


def test_every_marker_is_null_and_other_text_is_not(spark):
    df = spark.createDataFrame([(m,) for m in (*NULL_MARKERS, " NA", "none", "0", "nil")], "v string")
    kept = rows(df.select(text.null_if_marker(F.col("v")).alias("v")).na.drop())
    assert kept == [(" NA",), ("0",), ("nil",), ("none",)]


def test_trim_keeps_tabs(spark):
    assert value(spark, text.trimmed(F.lit("  \ta b ")) ) == "\ta b"
    assert value(spark, text.upper_trimmed(F.lit(" aB "))) == "AB"
    assert value(spark, text.lower_trimmed(F.lit(" aB "))) == "ab"


def test_hierarchy_label_is_null_when_a_part_is(spark):
    assert value(spark, text.hierarchy_label(F.lit("a"), F.lit("b"), F.lit("c"))) == "a > b > c"
    assert value(spark, text.hierarchy_label(F.lit("a"), F.lit(None).cast("string"), F.lit("c"))) is None


@pytest.mark.parametrize(
    "given, expected", [("7", 7), ("7.0", 7), (" 7 ", 7), ("1e3", 1000), ("x", None), (None, None), ("9" * 25, None)]
)
def test_key(spark, given, expected):
    assert value(spark, numbers.key(F.lit(given).cast("string"))) == expected


@pytest.mark.parametrize("given, expected", [("7.0", 7), ("-0.00", 0), ("+7.", 7), ("A7", None), ("", None), ("unknown", None)])
def test_key_tries_no_cast_that_fails(spark, monkeypatch, given, expected):
    """Casts that stop at what they cannot read: each such failure costs an exception per row."""
    monkeypatch.setattr(type(F.lit(1)), "try_cast", lambda column, to: column.cast(to))
    key = numbers.key(F.col("v"))
    with settings(spark, **{"spark.sql.ansi.enabled": "true"}):
        assert one(spark.createDataFrame([(given,)], "v string").select(key))[0] == expected


@pytest.mark.parametrize(
    "given, expected",
    [(" 7.0\n", 7), ("1E+3", 1000), ("1e-1", None), ("10e-1", 1), (".0", 0), ("7.5", None), ("7.0.0", None), ("", None),
     (str(2**63 - 1), 2**63 - 1), (f"{-2**63}.0", -2**63), (str(2**63), None), ("0" * 30 + "7", 7), ("+-7", None)],
)
def test_key_of_other_forms(spark, given, expected):
    assert value(spark, numbers.key(F.lit(given))) == expected


def test_exact_average_rounds_half_away_from_zero(spark):
    def average(total, count):
        return value(spark, numbers.exact_average(F.lit(total).cast("decimal(25,2)"), F.lit(count)))

    assert average("2.01", 2) == Decimal("1.01")
    assert average("-2.01", 2) == Decimal("-1.01")
    assert average("10.00", 3) == Decimal("3.33")
    assert average("1.00", 0) is None


def test_percent_and_ratio(spark):
    assert value(spark, numbers.percent(F.lit(1), F.lit(3), 2)) == Decimal("33.33")
    assert value(spark, numbers.percent(F.lit(1), F.lit(16), 1)) == Decimal("6.3")
    assert value(spark, numbers.percent(F.lit(1), F.lit(0), 2)) is None
    third, sixth = numbers.exact_ratio(F.lit(1), F.lit(3)), numbers.exact_ratio(F.lit(2), F.lit(6))
    assert value(spark, third == sixth) is True


@pytest.mark.parametrize(
    "given, pattern, expected",
    [
        ("2024-02-03", None, dt.datetime(2024, 2, 3)),
        ("2024-02-03 04:05:06", None, dt.datetime(2024, 2, 3, 4, 5, 6)),
        ("unknown", None, None),
        ("2024-02-30", None, None),
        ("13/02/2024", "dd/MM/yyyy", dt.datetime(2024, 2, 13)),
        ("02/13/2024", "dd/MM/yyyy", None),
        ("13/02/2024 14:30", "dd/MM/yyyy HH:mm", dt.datetime(2024, 2, 13, 14, 30)),
    ],
)
def test_event_time(spark, given, pattern, expected):
    assert value(spark, dates.event_time(F.lit(given), pattern)) == expected


@pytest.mark.parametrize("zone", ["UTC", "America/Sao_Paulo", "Asia/Tokyo"])
def test_dates_do_not_depend_on_the_zone(spark, zone):
    # Midnight of 2017-10-15 does not exist in Sao Paulo.
    with settings(spark, spark_sql_session_timeZone=zone):
        assert value(spark, dates.event_time(F.lit("2017-10-15"))) == dt.datetime(2017, 10, 15)
        assert value(spark, dates.event_time(F.lit("15/10/2017"), "d/M/yyyy")) == dt.datetime(2017, 10, 15)
        month = dates.month_start(F.lit("2017-10-15 23:59:59").cast("timestamp_ntz"))
        assert value(spark, month) == dt.datetime(2017, 10, 1)


@pytest.mark.parametrize(
    "born, on, years",
    [
        ("2000-02-29", "2025-02-28", 24),
        ("2000-02-29", "2025-03-01", 25),
        ("2000-06-15", "2025-06-14", 24),
        ("2000-06-15", "2025-06-15", 25),
        ("2000-06-15", "2025-06-16", 25),
    ],
)
def test_whole_years(spark, born, on, years):
    assert value(spark, dates.whole_years(F.lit(born).cast("date"), F.lit(on).cast("date"))) == years


def test_calendar_expressions(spark):
    sunday, friday = F.lit("2021-01-03").cast("date"), F.lit("2021-05-07").cast("date")
    assert value(spark, dates.day_of_week(sunday)) == 0
    assert value(spark, dates.is_weekend(sunday)) is True
    assert value(spark, dates.is_weekend(friday)) is False
    assert value(spark, dates.quarter_label(friday)) == "Q2"
    assert value(spark, dates.padded_name(friday, "MMMM")) == "May      "
    assert value(spark, dates.padded_name(friday, "EEEE")) == "Friday   "


def test_today_can_be_given(spark):
    assert value(spark, dates.today(dt.date(2024, 1, 1))) == dt.date(2024, 1, 1)
    assert value(spark, dates.today() == F.current_date()) is True


@pytest.mark.parametrize(
    "text_, key", [("7", 7), ("7.0", 7), ("-3.000", -3), ("7.5", None), ("x", None), ("1e3", 1000), ("99999999999999999999", None)]
)
def test_keys_are_whole_numbers(spark, text_, key):
    assert value(spark, numbers.key(F.lit(text_))) == key


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_times_do_not_depend_on_the_zone(spark, zone):
    with settings(spark, spark_sql_session_timeZone=zone):
        for stamp in ("2024-03-10 02:30:00", "1969-12-31 23:59:59", "2024-11-03 01:30:00"):
            by_pattern = dates.event_time(F.lit(stamp), "yyyy-MM-dd HH:mm:ss")
            assert value(spark, by_pattern) == value(spark, dates.event_time(F.lit(stamp))) == dt.datetime.fromisoformat(stamp)
        assert value(spark, dates.event_time(F.lit("bad"), "yyyy-MM-dd HH:mm")) is None
