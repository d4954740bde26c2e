"""Calendar expressions that do not depend on the session time zone."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

AsOf = dt.date | None

# Fixed value: dates of birth are written day first, padded or not.
BIRTH_DATE_PATTERN = "d/M/yyyy"

# Fixed value: month and day names are padded with blanks to this width.
NAME_WIDTH = 9


def today(as_of: AsOf = None) -> Column:
    """The reporting date: ``as_of``, or the current date when none is given."""
    return F.current_date() if as_of is None else F.lit(as_of)


def event_time(value: Column, pattern: str | None = None) -> Column:
    """Text to ``timestamp_ntz``; null where it does not fit.

    Without a pattern ISO 8601 is expected. A pattern of date letters only is
    parsed as a date, and one with a time of day as a time in UTC, whose clock is
    then taken: the session's zone has no part in either. A pattern with a zone
    gives the clock in UTC.
    """
    if pattern is None:
        return value.try_cast("timestamp_ntz")
    if not any(letter in pattern for letter in "HhkKms"):
        return F.try_to_date(value, pattern).cast("timestamp_ntz")
    if not any(letter in pattern for letter in "xXzZVO"):
        value, pattern = F.concat(value, F.lit(" +0000")), f"{pattern} xx"
    micros = F.unix_micros(F.try_to_timestamp(value, F.lit(pattern)))
    seconds = (micros / F.lit(1_000_000).cast("decimal(7,0)")).cast("decimal(18,6)")
    return F.lit(dt.date(1970, 1, 1)).cast("timestamp_ntz") + F.make_dt_interval(secs=seconds)


def month_start(value: Column) -> Column:
    """First instant of the month as ``timestamp_ntz``."""
    return F.trunc(value.cast("date"), "month").cast("timestamp_ntz")


def birth_date(value: Column) -> Column:
    return F.try_to_date(value, BIRTH_DATE_PATTERN)


def whole_years(born: Column, on: Column) -> Column:
    """Completed years between two dates; a 29 February birthday waits for 1 March."""
    birthday_ahead = F.date_format(on, "MMdd") < F.date_format(born, "MMdd")
    return F.year(on) - F.year(born) - birthday_ahead.cast("int")


def day_of_week(date: Column) -> Column:
    """0 for Sunday to 6 for Saturday."""
    return F.dayofweek(date) - 1


def is_weekend(date: Column) -> Column:
    return day_of_week(date).isin(0, 6)


def quarter_label(date: Column) -> Column:
    return F.concat(F.lit("Q"), F.quarter(date).cast("string"))


def padded_name(date: Column, pattern: str) -> Column:
    """Full month (``MMMM``) or day (``EEEE``) name, padded with blanks."""
    return F.rpad(F.date_format(date, pattern), NAME_WIDTH, " ")
