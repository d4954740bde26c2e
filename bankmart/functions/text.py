"""Text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from bankmart.schemas import NULL_MARKERS


def null_if_marker(value: Column) -> Column:
    """Null for any of the CSV missing-value markers, else the text unchanged."""
    return F.when(~value.isin(*NULL_MARKERS), value)


def trimmed(value: Column) -> Column:
    """Text without leading and trailing blanks; tabs are kept."""
    return F.trim(value)


def upper_trimmed(value: Column) -> Column:
    return F.upper(F.trim(value))


def lower_trimmed(value: Column) -> Column:
    return F.lower(F.trim(value))


def hierarchy_label(*parts: Column) -> Column:
    """``a > b > c``; null when any part is null, which ``concat_ws`` would hide."""
    pieces: list[Column] = []
    for part in parts:
        pieces += [F.lit(" > "), part]
    return F.concat(*pieces[1:])
