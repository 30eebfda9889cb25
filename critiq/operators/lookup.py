"""Dimension lookups with explicit unmatched-key policies.

No broadcast hint is given for dimensions: their size grows with the data, so
the choice is left to Spark's size check (``autoBroadcastJoinThreshold`` at
plan time, AQE's runtime threshold afterwards). A small dimension becomes a
broadcast hash join; a large one a sort-merge join, with AQE splitting skewed
fact partitions.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def lookup(fact: DataFrame, dim: DataFrame, key: str | Sequence[str], how: str = "default",
           defaults: Mapping[str, object] | None = None) -> DataFrame:
    """Attach the non-key columns of ``dim`` to ``fact``.

    ``how="drop"``    – inner join: facts without a dimension row disappear (J2).
    ``how="default"`` – left join: facts without a value keep ``defaults[col]`` (J1/J3),
                        whether the row or only its value is missing; columns
                        without a default stay NULL.
    ``dim`` must be unique on ``key`` (see :func:`dedupe_dimension`).
    """
    keys = [key] if isinstance(key, str) else list(key)
    if how == "drop":
        return fact.join(dim, keys, "inner")
    if how != "default":
        raise ValueError(f"unknown lookup policy {how!r}")
    joined = fact.join(dim, keys, "left")
    for col, value in (defaults or {}).items():
        joined = joined.withColumn(col, F.coalesce(F.col(col), F.lit(value)))
    return joined


def dedupe_dimension(dim: DataFrame, key: str | Sequence[str], order_col: str) -> DataFrame:
    """Keep one row per key, the one with the largest ``order_col`` ("last line wins").

    Rows that tie on ``order_col`` are decided by their remaining columns
    (largest first). ``row_number() = 1`` plans a partial group limit: a key
    that holds a large share of the rows is cut to one row per partition
    before the shuffle.
    """
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in dim.columns if c not in (*keys, order_col)]
    last = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in [order_col, *rest]])
    return dim.withColumn("_rn", F.row_number().over(last)).where("_rn = 1").drop("_rn")


def snowflake_lookup(fact: DataFrame, first: DataFrame, first_key: str, second: DataFrame,
                     second_key: str, value_col: str, default: object) -> DataFrame:
    """Two-level lookup fact -> first (gives ``second_key``) -> second (gives ``value_col``).

    A miss at either level collapses to ``default``; the intermediate key is dropped.
    """
    step = fact.join(first.select(first_key, second_key), first_key, "left")
    step = step.join(second.select(second_key, value_col), second_key, "left")
    return step.drop(second_key).withColumn(value_col, F.coalesce(F.col(value_col), F.lit(default)))


def lookup_few(few: DataFrame, dim: DataFrame, key: str, defaults: Mapping[str, object] | None = None) -> DataFrame:
    """J1 for a frame of a few rows (the one row of a global aggregate, top-k rows).

    The dimension is first cut to the needed keys by a semi join, whose
    small side Spark broadcasts after its own size check, so a large
    dimension is read once and not shuffled to look up a handful of rows.
    Rows of ``few`` whose key is NULL keep NULL columns (no default).
    """
    needed = dim.join(few.select(key).where(F.col(key).isNotNull()).distinct(), key, "left_semi")
    joined = few.join(needed, key, "left")
    for col, value in (defaults or {}).items():
        joined = joined.withColumn(col, F.when(F.col(key).isNotNull(), F.coalesce(F.col(col), F.lit(value))))
    return joined
