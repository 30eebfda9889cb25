"""Review tokens stored as a bucketed table that later programs re-load.

The reference stores every token as a line and reads the lines again in two further programs. Here equal tokens (word,
topic, aspect, sentiment) are counted before they are stored, so a word that makes up a third of the text is one row per
topic, aspect and sentiment, and neither the write nor a re-load has a hot group. The table is bucketed and sorted by
(topic, word): term frequencies, distinct pairs and what follows from them start without a shuffle.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from critiq.session import shared_folder

COLUMNS = ["word", "topic", "aspect", "sentiment"]
GROUP = ["topic", "word"]
TIMES = "times"
_STEP = 1 << 16


@dataclass(frozen=True)
class StoredTokens:
    """A stored token table: its name in the session's catalog, its folder and its number of buckets."""

    name: str
    folder: str
    buckets: int

    def read(self, spark: SparkSession) -> DataFrame:
        """word, topic, aspect, sentiment, times: one row per distinct token, bucketed by (topic, word)."""
        return spark.table(self.name)


def store_tokens(tokens: DataFrame, folder: str | None = None, name: str | None = None,
                 buckets: int | None = None) -> StoredTokens:
    """Write ``tokens`` (word, topic, aspect, sentiment) once, counted, bucketed and sorted by (topic, word).

    The tokens are combined map-side before the first shuffle; the second deals the counted rows by bucket, so every
    bucket is one file. ``buckets`` is by default ``spark.sql.shuffle.partitions``, ``folder`` a fresh one below the
    shared checkpoint folder.
    """
    spark = tokens.sparkSession
    folder = folder or shared_folder(spark, "tokens")
    name = name or f"stored_tokens_{uuid.uuid4().hex}"
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    counted = tokens.groupBy(*COLUMNS).agg(F.count(F.lit(1)).alias(TIMES))
    (counted.repartition(n, *GROUP).write.format("parquet").option("path", folder)
     .bucketBy(n, *GROUP).sortBy(*GROUP).saveAsTable(name))
    return StoredTokens(name, folder, n)


def expand_tokens(stored: DataFrame) -> DataFrame:
    """The tokens as they were, one row per occurrence.

    Repeats are dealt out in two steps, so no row ever holds more than 65,536 of them in an array.
    """
    steps = F.sequence(F.lit(0), F.floor((F.col(TIMES) - 1) / _STEP))
    parts = stored.select(*COLUMNS, TIMES, F.explode(steps).alias("_step"))
    here = F.least(F.lit(_STEP), F.col(TIMES) - F.col("_step") * _STEP).cast("int")
    return parts.select(*COLUMNS, F.explode(F.array_repeat(F.lit(True), here)).alias("_one")).drop("_one")


def stored_term_frequency(stored: DataFrame) -> DataFrame:
    """A8 on the stored tokens: topic, word, tf (NULL words count 0). One pass over each bucket, no shuffle."""
    return stored.groupBy(*GROUP).agg(
        F.sum(F.when(F.col("word").isNotNull(), F.col(TIMES)).otherwise(0)).alias("tf"))


def stored_distinct_pairs(stored: DataFrame) -> DataFrame:
    """A11 on the stored tokens: the distinct (word, topic) pairs, without a shuffle."""
    return stored.select("word", "topic").distinct()
