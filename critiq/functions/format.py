"""F11/F12 and K5 helpers: placeholders and padded report fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def with_placeholder(col: Column | str, placeholder: str) -> Column:
    """Value as text, or ``placeholder`` when NULL (``N/A``, ``NA``, ``NaN``)."""
    return F.coalesce(_c(col).cast("string"), F.lit(placeholder))


def pad_right(col: Column | str, width: int) -> Column:
    """Left-aligned field of at least ``width`` characters; never truncates."""
    c = _c(col).cast("string")
    return F.rpad(c, F.greatest(F.length(c), F.lit(width)), " ")


def pad_left(col: Column | str, width: int) -> Column:
    """Right-aligned field of at least ``width`` characters; never truncates."""
    c = _c(col).cast("string")
    return F.lpad(c, F.greatest(F.length(c), F.lit(width)), " ")


def fixed(col: Column | str, places: int = 4) -> Column:
    """Fixed-point text with ``places`` decimals (``{:.4f}``)."""
    return F.format_string(f"%.{places}f", _c(col))
