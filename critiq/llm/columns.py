"""Working columns that cannot clash with a caller's."""

from __future__ import annotations

from pyspark.sql import DataFrame


def fresh_name(df: DataFrame, base: str) -> str:
    """``base``, with underscores appended until ``df`` has no column of that name (case ignored)."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base
