"""Logical tables of the analyses, derived from the parquet test tables.

The analyses speak of ``ratings``, ``movies``, ``users``, ``occupation``,
``reviews`` and ``stopwords``. On the test data they are projections of the
TPC-H-like tables; every column is pruned at the scan so only the fields used
are read. Attributes that live in another table (a rating's user, a review's
sentiment) come by a plain equi-join, only where the caller asks for them:
other queries neither read that table nor join it. ``oracle.py`` defines the
same tables in SQL.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _ratings_from(spark: SparkSession, sf_dir: str, li: DataFrame, user: bool, keep: Sequence[str] = ()) -> DataFrame:
    if user:
        orders = _read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
        li = li.join(orders, li["l_orderkey"] == orders["o_orderkey"])
    who = [F.col("o_custkey").alias("user_id")] if user else []
    return li.select(*who, F.col("l_partkey").alias("movie_id"), F.col("l_quantity").alias("rating"),
                     F.col("l_shipdate").alias("ts"), *keep)


def ratings(spark: SparkSession, sf_dir: str, user: bool = False) -> DataFrame:
    """movie_id, rating, ts: one row per line item; with ``user`` also user_id, the customer of its order.

    The user comes by an inner join with the orders (both large: a
    sort-merge join on the order key, which spreads evenly).
    """
    return _ratings_from(spark, sf_dir, _read(spark, sf_dir, "lineitem"), user)


# the two rating "files" of S1
RATING_INPUTS = ["first", "rest"]


def rating_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """user_id, movie_id, rating, ts, input: all ratings in one scan; ``first`` holds line status ``F``, ``rest`` the others."""
    li = _read(spark, sf_dir, "lineitem")
    first, rest = RATING_INPUTS
    half = F.when(F.col("l_linestatus") == "F", first).otherwise(rest)
    return _ratings_from(spark, sf_dir, li.withColumn("input", half), True, ["input"])


def movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """movie_id, title, genres ('|' list: the words of the name, then the type)."""
    part = _read(spark, sf_dir, "part")
    return part.select(
        F.col("p_partkey").alias("movie_id"),
        F.col("p_name").alias("title"),
        F.concat(F.replace("p_name", F.lit(" "), F.lit("|")), F.lit("|"), F.col("p_type")).alias("genres"),
    )


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """user_id, gender (M, F or another segment), age 0..79, occupation_id."""
    c = _read(spark, sf_dir, "customer")
    gender = (F.when(F.col("c_mktsegment") == "BUILDING", "M")
              .when(F.col("c_mktsegment") == "MACHINERY", "F")
              .otherwise(F.col("c_mktsegment")))
    return c.select(
        F.col("c_custkey").alias("user_id"),
        gender.alias("gender"),
        (F.col("c_custkey") % 80).cast("int").alias("age"),
        F.col("c_nationkey").alias("occupation_id"),
    )


def occupation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """occupation_id, name: nations outside region 0 (the rest stay unmatched)."""
    n = _read(spark, sf_dir, "nation")
    return (n.where(F.col("n_regionkey") != 0)
            .select(F.col("n_nationkey").alias("occupation_id"), F.col("n_name").alias("name")))


def reviews(spark: SparkSession, sf_dir: str, sentiment: bool = False) -> DataFrame:
    """id, review, topic (language), aspect (source); with ``sentiment`` also that (from the quality label or NULL).

    Labels are keyed by document and joined once; a document with several
    labels has a row for each.
    """
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    out = [F.col("doc_id").alias("id"), F.col("text").alias("review"), F.col("lang").alias("topic"),
           F.col("source").alias("aspect")]
    if sentiment:
        docs = docs.join(_read(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id", "left")
        out.append(F.when(F.col("quality") == 1, "positive").when(F.col("quality") == 0, "negative")
                   .alias("sentiment"))
    return docs.select(*out)


# The stop-word list used on the test data. It holds repeats
# and one two-word entry on purpose (both must be harmless, D11/D12).
STOPWORDS = [
    "the", "of", "and", "and", "to", "a", "in", "is", "it", "that",
    "de", "la", "le", "les", "et", "en", "el", "y", "que", "los",
    "der", "die", "das", "und", "of", "of the",
]


def stopwords(spark: SparkSession) -> DataFrame:
    """The stop-word list as a one-column frame (a bounded dimension).

    Built from a one-row range so the optimizer knows its (tiny) size and
    plans the anti join as a broadcast; a frame made from a Python list
    would carry no size estimate and force a shuffle of every token.
    """
    return spark.range(1).select(F.explode(F.array(*[F.lit(w) for w in STOPWORDS])).alias("word"))
