"""A key holding a third of the rows: results stay exact and the hot join partition is split."""

from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from critiq import plans
from critiq.operators import pair_sums
from tests.conftest import explain_text

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
}


@pytest.fixture
def skew_session(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def _movie(i, many):
    """Movie 7 holds over a third of the ratings; with ``many`` the hot user rates a movie of its own each time."""
    return 1000 + i if many and i % 3 == 0 else 7 if i % 3 == 1 else i % 101


def _data(spark, n=30_000, many=False):
    ids = F.col("id")
    ratings = spark.range(n).select(
        F.when(ids % 3 == 0, F.lit(0)).otherwise(ids % 997 + 1).alias("user_id"),     # user 0: a third
        F.when(F.lit(many) & (ids % 3 == 0), ids + 1000).when(ids % 3 == 1, F.lit(7)).otherwise(ids % 101)
        .alias("movie_id"),
        (ids % 5 + 1).cast("double").alias("rating"),
        F.lit(0).cast("long").alias("ts"))
    users = spark.range(0, 1000).select(ids.alias("user_id"),
                                        F.when(ids % 2 == 0, "M").otherwise("F").alias("gender"),
                                        (ids % 80).cast("int").alias("age"), F.lit(1).alias("occupation_id"))
    movies = spark.range(0, 101).select(ids.alias("movie_id"), F.concat(F.lit("m"), ids).alias("title"),
                                        F.lit("Drama").alias("genres"))
    return ratings, users, movies


@pytest.mark.parametrize("many", [True, False])
def test_hot_user_join_is_split_and_exact(skew_session, many):
    spark = skew_session
    n = 300_000 if many else 30_000         # enough rows that the sums come from several map tasks
    ratings, users, movies = _data(spark, n, many)
    out = plans.movie_gender_wide(ratings, users, movies)
    got = {r.movie_id: (r.male, r.female) for r in out.collect()}
    if many:
        assert "isSkewJoin=true" in explain_text(out, "simple") or "skew=true" in explain_text(out, "simple")
    else:       # the hot user's repeats are combined below the join: no partition of it is hot
        assert pair_sums(ratings, "user_id", ["movie_id"]).where("user_id = 0").count() <= 101

    gender = {u: ("M" if u % 2 == 0 else "F") for u in range(1000)}
    sums = defaultdict(lambda: [0.0, 0, 0.0, 0])
    for i in range(n):
        u = 0 if i % 3 == 0 else i % 997 + 1
        m = _movie(i, many)
        r = float(i % 5 + 1)
        s = sums[m]
        if gender[u] == "M":
            s[0] += r; s[1] += 1
        else:
            s[2] += r; s[3] += 1
    for m, (sm, nm, sf, nf) in sums.items():
        male, female = got[m]
        assert (male == pytest.approx(sm / nm, rel=1e-6)) if nm else male is None
        assert (female == pytest.approx(sf / nf, rel=1e-6)) if nf else female is None


def test_hot_movie_rank_and_best(skew_session):
    spark = skew_session
    ratings, _, movies = _data(spark)
    ranked = plans.movie_rating_ranked(ratings, movies, min_count=1).collect()
    assert sorted(r["rank"] for r in ranked) == list(range(1, 102))
    hot = [r for r in ranked if r.movie_id == 7][0]
    assert hot.n == 10_000 + len([i for i in range(30_000) if i % 3 != 1 and i % 101 == 7])
