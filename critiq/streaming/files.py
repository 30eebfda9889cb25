"""Structured Streaming readers for the rating and review text files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from critiq import schemas
from critiq.operators.stats import rating_stats


def _stream_csv(spark: SparkSession, folder: str, schema, sep: str, trim: bool, max_files: int | None):
    reader = (spark.readStream.schema(schema)
              .option("sep", sep).option("header", "false")
              .option("quote", "").option("escape", "")
              .option("ignoreLeadingWhiteSpace", str(trim).lower())
              .option("ignoreTrailingWhiteSpace", str(trim).lower()))
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.csv(folder)


def read_ratings_stream(spark: SparkSession, folder: str, sep: str = ",",
                        max_files_per_trigger: int | None = None) -> DataFrame:
    """S1 as a stream: every rating file that appears in ``folder``."""
    return _stream_csv(spark, folder, schemas.RATINGS, sep, True, max_files_per_trigger)


def read_reviews_stream(spark: SparkSession, folder: str, sep: str = ";",
                        max_files_per_trigger: int | None = None) -> DataFrame:
    """S3 as a stream: every review file that appears in ``folder``."""
    return _stream_csv(spark, folder, schemas.REVIEWS, sep, False, max_files_per_trigger)


def running_rating_stats(ratings_stream: DataFrame, keys: Sequence[str] = ("movie_id",),
                         places: int | None = 4) -> DataFrame:
    """A1/A2 over a stream: the same aggregate as the batch analysis.

    The state is one (sum, count) pair per key; emit it with output mode
    ``complete`` or ``update``.
    """
    return rating_stats(ratings_stream, list(keys), places=places)
