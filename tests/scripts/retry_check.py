"""Run with its own local[4,4] session (tasks may be retried); prints OK when all checks pass."""

import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from pyspark import TaskContext
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

spark = (SparkSession.builder.master("local[4,4]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "6").getOrCreate())
spark.sparkContext.setLogLevel("OFF")
spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="retry-ckpt-"))
MARKS = tempfile.mkdtemp(prefix="retry-marks-")

from critiq.operators import global_row_number  # noqa: E402
from critiq import plans  # noqa: E402
from critiq.sources import tables  # noqa: E402


def flaky(tag: str, dtype: str = "double"):
    """Identity that fails the first attempt of partition 1 (a lost task), test-only.

    Each injected failure leaves a marker file, so the check can prove it happened.
    """
    marks = MARKS

    @F.udf(dtype)
    def f(v):
        tc = TaskContext.get()
        if tc is not None and tc.attemptNumber() == 0 and tc.partitionId() == 1:
            open(os.path.join(marks, f"{tag}-{tc.stageId()}"), "w").close()
            raise RuntimeError(f"injected loss of a task ({tag})")
        return v
    return f


rows = spark.range(0, 3000).select(F.col("id").alias("k"), (F.col("id") % 37).cast("double").alias("v"))
before = rows.withColumn("v", flaky("map_side")(F.col("v")))                       # fails before the range shuffle
ranked = global_row_number(before, [F.col("v").desc(), F.col("k")], "rank", 6)
after = ranked.withColumn("v", flaky("reduce_side")(F.col("v")))                   # fails after it
got = sorted((r["rank"], r.k) for r in after.collect())
exp = [(i + 1, k) for i, (k, _) in enumerate(sorted(((k, k % 37) for k in range(3000)), key=lambda x: (-x[1], x[0])))]
assert got == exp, "ranks differ after task retries"

sf = sys.argv[1]
from critiq.operators import review_tokens  # noqa: E402

reviews = tables.reviews(spark, sf).repartition(4, "id")   # so that there is a partition 1 to lose
flaky_reviews = reviews.withColumn("review", flaky("text", "string")(F.col("review")))
clean = sorted(tuple(r) for r in plans.tfidf_scores(review_tokens(reviews, tables.stopwords(spark))).collect())
retried = sorted(tuple(r) for r in plans.tfidf_scores(review_tokens(flaky_reviews, tables.stopwords(spark))).collect())
assert clean == retried, "tf-idf differs after task retries"
injected = sorted(name.split("-")[0] for name in os.listdir(MARKS))
assert {"map_side", "reduce_side", "text"} <= set(injected), injected
print("OK")
