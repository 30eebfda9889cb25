"""global_row_number against a brute-force sort, including ties and skew."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from critiq.operators import global_row_number, sort_desc_tiebreak


def _check(spark, rows, partitions):
    df = spark.createDataFrame(rows, "k long, v double")
    got = global_row_number(df, [F.col("v").desc(), F.col("k").asc()], "rank", partitions).collect()
    exp = sorted(rows, key=lambda r: (-r[1], r[0]))
    assert [(r["rank"], r.k, r.v) for r in sorted(got, key=lambda r: r["rank"])] == \
        [(i + 1, k, v) for i, (k, v) in enumerate(exp)]


@pytest.mark.parametrize("partitions", [1, 3, 8, 17])
def test_ranks_are_dense_and_ordered(spark, partitions):
    rnd = random.Random(partitions)
    rows = [(k, float(rnd.randint(0, 20)) / 4) for k in rnd.sample(range(10_000), 700)]
    _check(spark, rows, partitions)


def test_hot_value_and_tiny_inputs(spark):
    _check(spark, [(k, 3.0) for k in range(500)] + [(1000 + k, float(k)) for k in range(20)], 8)
    _check(spark, [(1, 1.0)], 8)
    df = spark.createDataFrame([], "k long, v double")
    assert global_row_number(df, [F.col("v").desc(), F.col("k")], "rank").collect() == []


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_many_rows_with_other_columns_and_ties(spark, adaptive):
    # far above the sample that range partitioning draws: three runs, each exactly 1..n in order
    n = 250_000
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    try:
        for _ in range(3):
            df = spark.range(0, n).select(F.xxhash64("id").alias("k"), (F.col("id") % 97).cast("double").alias("v"),
                                          F.concat(F.lit("title "), F.col("id")).alias("title"), F.lit(1).alias("n"))
            out = global_row_number(df, [F.col("v").desc(), F.col("k").asc()], "rank", 16)
            w = Window.orderBy(F.col("v").desc(), F.col("k"))
            wrong = out.withColumn("want", F.row_number().over(w)).where("rank <> want").count()
            stats = out.agg(F.count_distinct("rank"), F.min("rank"), F.max("rank")).first()
            assert (wrong, *stats) == (0, n, 1, n)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)


def test_default_partitions_are_the_shuffle_partitions(spark):
    df = spark.range(0, 1000).select(F.col("id").alias("k"))
    out = global_row_number(df, [F.col("k").desc()], "rank")
    assert out.select(F.spark_partition_id()).distinct().count() <= int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_sort_desc_tiebreak_nulls_last(spark):
    df = spark.createDataFrame([(1, None), (2, 5), (3, 5), (0, 7)], "k long, m long")
    assert [r.k for r in sort_desc_tiebreak(df, "m", "k").collect()] == [0, 2, 3, 1]


def test_ranks_without_adaptive_execution(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rnd = random.Random(9)
        _check(spark, [(k, float(rnd.randint(0, 9))) for k in range(400)], 8)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
