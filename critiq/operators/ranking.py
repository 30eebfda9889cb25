"""Ranks, per-group top-k, arg-max with ties, ordered output."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from critiq.session import materialize

_POS_BITS = 33  # monotonically_increasing_id keeps the row position in the low 33 bits


def global_row_number(df: DataFrame, order: Sequence[Column], name: str = "rank",
                      partitions: int | None = None) -> DataFrame:
    """Number the rows 1..n along a total ``order``, without a single-partition window.

    1. range-partition on ``order`` and sort each partition (one shuffle;
       ``partitions`` is by default ``spark.sql.shuffle.partitions``), and
       write that frame once to the checkpoint folder: positions and counts
       must come from one and the same partitioning, and a second run of
       the range shuffle would sample other bounds;
    2. number rows inside each partition (``monotonically_increasing_id``);
    3. count rows per partition, prefix-sum those few counts, broadcast them
       (one row per partition: bounded by the partition count) and add.

    ``order`` must be total (end it with a unique key) for a deterministic result.
    """
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return _numbered(materialize(df.repartitionByRange(n, *order).sortWithinPartitions(*order)), name)


def with_position(df: DataFrame, name: str = "position") -> DataFrame:
    """O1–O3: the place 1..n of every row in the order in which ``df`` hands out its rows.

    For a sorted frame this is the proof of its order: partitions hold ascending ranges, so the place is the number of
    rows in the partitions before plus the place within. The frame is written once, as its sort must not run twice.
    """
    return _numbered(materialize(df), name)


def _numbered(held: DataFrame, name: str) -> DataFrame:
    """Places 1..n over the partitions of a materialised frame, in partition order."""
    rid = F.monotonically_increasing_id()
    numbered = (held.withColumn("_rid", rid)
                .withColumn("_part", F.shiftright(F.col("_rid"), _POS_BITS))
                .withColumn("_pos", F.col("_rid").bitwiseAND(F.lit((1 << _POS_BITS) - 1))))
    sizes = numbered.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    ranked = numbered.join(F.broadcast(offsets), "_part")
    return ranked.select(
        (F.col("_offset") + F.col("_pos") + 1).alias(name),
        *[F.col(c) for c in held.columns],
    )


def top_k_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int,
                    rank_name: str | None = None) -> DataFrame:
    """At most ``k`` rows per group along ``order`` (ties broken by the order itself).

    ``row_number() <= k`` lets Spark plan a partial WindowGroupLimit before the
    shuffle, so a group holding most of the rows ships only ``k`` rows per
    map partition.
    """
    w = Window.partitionBy(*group).orderBy(*order)
    ranked = df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= k)
    if rank_name:
        return ranked.withColumnRenamed("_rn", rank_name)
    return ranked.drop("_rn")


def argmax_with_ties(df: DataFrame, measure: str) -> DataFrame:
    """Every row whose non-NULL ``measure`` equals the global maximum (ties kept).

    Two phases: the maximum as a scalar (each partition passes on one value), then a filter where the rows lie, so any
    number of ties stays spread over the tasks. Both read ``df`` from the checkpoint folder, where it is written once.
    """
    held = materialize(df)
    top = held.agg(F.max(measure)).scalar()
    return held.where(F.col(measure) == top)


def sort_desc_tiebreak(df: DataFrame, measure: str, key: str | Sequence[str]) -> DataFrame:
    """O1: descending by ``measure``, ascending by the key on ties (D6); NULLs last."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.orderBy(F.col(measure).desc_nulls_last(), *[F.col(k).asc_nulls_first() for k in keys])
