"""Explicit schemas of the logical tables (never inferred)."""

from pyspark.sql import types as T

RATINGS = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("movie_id", T.LongType()),
    T.StructField("rating", T.DoubleType()),
    T.StructField("ts", T.LongType()),          # epoch seconds
])

USERS = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("gender", T.StringType()),
    T.StructField("age", T.IntegerType()),
    T.StructField("occupation_id", T.IntegerType()),
    T.StructField("zip", T.StringType()),
])

OCCUPATION = T.StructType([
    T.StructField("occupation_id", T.IntegerType()),
    T.StructField("name", T.StringType()),
])

REVIEWS = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("review", T.StringType()),
    T.StructField("topic", T.StringType()),
    T.StructField("aspect", T.StringType()),
    T.StructField("sentiment", T.StringType()),
])

TOKENS = T.StructType([
    T.StructField("word", T.StringType()),
    T.StructField("topic", T.StringType()),
    T.StructField("aspect", T.StringType()),
    T.StructField("sentiment", T.StringType()),
])
