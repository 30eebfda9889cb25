"""Rounding, time and number parsing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def round_half_even(col: Column | str, places: int = 4) -> Column:
    """Half-even rounding on the decimal value (Python's ``round`` for printed values, D5)."""
    return F.bround(col, places)


def epoch_year(col: Column | str, tz: str = "UTC") -> Column:
    """Calendar year of an epoch-seconds value, read in time zone ``tz``.

    Independent of the session time zone: the seconds are added to the
    zone-less epoch and the wall clock is then moved from UTC to ``tz``.
    """
    c = F.col(col) if isinstance(col, str) else col
    utc_wall = F.timestamp_add("SECOND", c.cast("long"), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))
    local_wall = F.convert_timezone(F.lit("UTC"), F.lit(tz), utc_wall) if tz != "UTC" else utc_wall
    return F.year(local_wall)


def year_of(col: Column | str, dtype: T.DataType, tz: str = "UTC") -> Column:
    """Year of a rating time stamp: epoch seconds (text inputs) or a timestamp column."""
    c = F.col(col) if isinstance(col, str) else col
    if isinstance(dtype, T.TimestampNTZType):
        return F.year(c)
    if isinstance(dtype, T.TimestampType):
        return epoch_year(F.unix_seconds(c), tz)
    return epoch_year(c, tz)
