"""Sharding by jump consistent hashing, in DataFrame functions only.

A row's key alone and the shard count decide its shard, so appending a shard
moves a row only into the new shard, and only the necessary share of rows.
No ring table is kept. The 64-bit key is taken from the MD5 of the key text;
each jump draws the next value of a linear congruential generator modulo
2^64, computed exactly in ``decimal(38, 0)`` (Spark's ``bigint`` product
would overflow under ANSI rules).

Places inside a shard (``slot``) are numbered without a window over a whole
shard: a second, independent 64-bit value of the same MD5 orders the rows of
a shard, its top bits cut the shard into ``cells`` of even size, cell counts
are summed up (``shards * cells`` rows, a constant, broadcast) and each cell
is numbered on its own.

Defined cases: a NULL key is the empty key text; repeated rows keep one slot
each; an empty table gives an empty result; the operator's own columns are
prefixed, and an input column of the same name as an output column is
replaced by it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Multiplier of the published jump hash generator, and its word size.
MULTIPLIER = 2862933555777941757
WORD = 2 ** 64
CELL_BITS = 10


def key_word(key: Column, start: int = 1) -> Column:
    """64 bits of the MD5 of the key's text as ``decimal(20,0)``: hex digits ``start`` to ``start + 15``."""
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")))
    return F.conv(F.substring(digest, start, 16), 16, 10).cast("decimal(20,0)")


def jump_hash(key: Column, shards: int) -> Column:
    """Shard 0 .. ``shards - 1`` of a 64-bit unsigned ``decimal(20,0)`` key.

    The published loop: draw, jump from ``b`` to ``floor((b + 1) * 2^31 /
    (top 31 bits + 1))`` until the jump leaves the range. A jump always
    moves forward, so ``shards`` steps bound it.
    """
    if shards < 1:
        raise ValueError("need at least one shard")

    def step(state: Column, _: Column) -> Column:
        drawn = ((state["key"] * F.lit(MULTIPLIER).cast("decimal(20,0)") + F.lit(1).cast("decimal(1,0)"))
                 % F.lit(str(WORD)).cast("decimal(20,0)")).cast("decimal(20,0)")
        top = F.floor(drawn / F.lit(2 ** 33).cast("decimal(20,0)")).cast("double")
        jump = F.floor((state["next"] + 1).cast("double") * (F.lit(float(2 ** 31)) / (top + 1.0))).cast("long")
        return F.when(state["next"] < shards, F.struct(
            state["next"].alias("shard"), jump.alias("next"), drawn.alias("key"))).otherwise(state)

    start = F.struct(F.lit(0).cast("long").alias("shard"), F.lit(0).cast("long").alias("next"), key.alias("key"))
    done = F.aggregate(F.sequence(F.lit(1), F.lit(shards)), start, step, lambda s: s["shard"])
    return done.cast("int")


def assign_shards(df: DataFrame, key: str, shards: int, order: list[str] | None = None) -> DataFrame:
    """Add ``shard``, ``grown_shard`` (with one shard more) and ``slot`` (gapless from 0 in each shard).

    Slots follow the second half of the key's MD5, then the key, then the columns of ``order``.
    """
    own = ["_shard", "_grown", "_place", "_cell"]
    rest = [c for c in df.columns if c not in ("shard", "grown_shard", "slot", *own)]

    def placed(frame: DataFrame) -> DataFrame:
        word, place = key_word(F.col(key)), F.substring(F.md5(F.coalesce(F.col(key).cast("string"), F.lit(""))), 17, 16)
        return (frame.withColumn("_shard", jump_hash(word, shards))
                .withColumn("_grown", jump_hash(word, shards + 1))
                .withColumn("_place", place)
                .withColumn("_cell", F.shiftright(F.conv(F.substring(F.col("_place"), 1, 8), 16, 10).cast("long"),
                                                  32 - CELL_BITS).cast("int")))

    rows = placed(df.select(*rest))
    sizes = (placed(df.select(key)).groupBy("_shard", "_cell").agg(F.count(F.lit(1)).alias("_n")))
    before = Window.partitionBy("_shard").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_shard", "_cell", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("_shard", "_cell").orderBy("_place", key, *(order or []))
    numbered = rows.withColumn("_in_cell", F.row_number().over(inside) - 1)
    # at most shards * 2^CELL_BITS rows, whatever the input
    joined = numbered.join(F.broadcast(offsets), ["_shard", "_cell"])
    return joined.select(*rest, F.col("_shard").alias("shard"), F.col("_grown").alias("grown_shard"),
                         (F.col("_before") + F.col("_in_cell")).cast("long").alias("slot"))


def shard_documents(docs: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard per document.

    The text is reduced to its size (UTF-8 bytes plus 1; NULL counts none)
    and CRC-32 (NULL as the empty text) before any shuffle.
    """
    text = F.col(text_col)
    narrow = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).cast("long").alias("text_crc32"),
        F.lit("key").alias("law"))
    placed = assign_shards(narrow, "doc_id", shards, ["size", "text_crc32"])
    return placed.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")

