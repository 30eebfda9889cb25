"""The streaming readers feed the batch aggregates and agree with the batch result."""

import os

from pyspark.sql import functions as F

from critiq.operators import rating_stats
from critiq.sources import read_ratings
from critiq.streaming import read_ratings_stream, running_rating_stats


def test_stream_equals_batch(spark, scratch):
    inbox = os.path.join(scratch, "in")
    os.makedirs(inbox)
    with open(os.path.join(inbox, "r1.txt"), "w") as f:
        f.write("1, 10, 4.0, 1577836800\n2, 10, 5.0, 1577836800\n1, 20, 2.0, 1609459200\n")
    with open(os.path.join(inbox, "r2.txt"), "w") as f:
        f.write("3,20,3.0,1609459200\n4,30,3.5,1609459200\n")
    q = (running_rating_stats(read_ratings_stream(spark, inbox, max_files_per_trigger=1))
         .writeStream.outputMode("complete").format("memory").queryName("running_stats")
         .option("checkpointLocation", os.path.join(scratch, "ckpt"))
         .trigger(availableNow=True).start())
    q.awaitTermination(120)
    streamed = sorted(tuple(r) for r in spark.sql("SELECT * FROM running_stats").collect())
    batch = rating_stats(read_ratings(spark, inbox), ["movie_id"])
    assert streamed == sorted(tuple(r) for r in batch.collect())
    assert streamed == [(10, 4.5, 2), (20, 2.5, 2), (30, 3.5, 1)]


def test_review_stream_counts(spark, scratch):
    from critiq.streaming import read_reviews_stream

    inbox = os.path.join(scratch, "rev")
    os.makedirs(inbox)
    with open(os.path.join(inbox, "a.csv"), "w") as f:
        f.write("1;good room;ROOMS;QUALITY;positive\n2;bad price;PRICES;VALUE;negative\n;no id;ROOMS;QUALITY;\n")
    counts = read_reviews_stream(spark, inbox).groupBy("topic").agg(F.count("id").alias("n_reviews"))
    q = (counts.writeStream.outputMode("complete").format("memory").queryName("topic_stream")
         .option("checkpointLocation", os.path.join(scratch, "ck2")).trigger(availableNow=True).start())
    q.awaitTermination(120)
    assert sorted(tuple(r) for r in spark.sql("SELECT * FROM topic_stream").collect()) == [("PRICES", 1), ("ROOMS", 1)]
