
import os

import pytest
from pyspark.sql import functions as F

from critiq import plans
from critiq.operators import review_tokens, term_frequency
from critiq.sources import tables
from tests.conftest import SF_SMALL

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_SMALL), reason="test tables not present")


@pytest.fixture(scope="module")
def t(spark):
    return {
        "ratings": tables.ratings(spark, SF_SMALL, user=True), "movies": tables.movies(spark, SF_SMALL),
        "users": tables.users(spark, SF_SMALL), "occupation": tables.occupation(spark, SF_SMALL),
        "reviews": tables.reviews(spark, SF_SMALL), "stop": tables.stopwords(spark),
    }


def _sum(df, col="n"):
    return df.agg(F.sum(col)).collect()[0][0]


def test_counts_add_up_to_the_ratings(t):
    n = t["ratings"].count()
    assert _sum(plans.movie_rating_summary(t["ratings"], t["movies"])) == n
    assert _sum(plans.occupation_rating(t["ratings"], t["users"], t["occupation"])) == n
    assert _sum(plans.yearly_rating(t["ratings"])) == n


def test_genre_counts_equal_list_lengths(t):
    lengths = (t["ratings"].join(t["movies"], "movie_id")
               .agg(F.sum(F.size(F.split("genres", r"\|")))).collect()[0][0])
    assert _sum(plans.genre_rating(t["ratings"], t["movies"])) == lengths


def test_densified_rows_are_movies_times_categories(t):
    movies = t["ratings"].select("movie_id").distinct().count()
    assert plans.movie_gender_long(t["ratings"], t["users"], t["movies"]).count() == movies * 2
    assert plans.movie_age_long(t["ratings"], t["users"], t["movies"]).count() == movies * 6
    # a known user's rating lands in exactly one category; unknown categories add nothing
    known = t["ratings"].join(t["users"].where(F.col("gender").isin("F", "M")), "user_id").count()
    assert _sum(plans.movie_gender_long(t["ratings"], t["users"], t["movies"])) == known


def test_topic_and_aspect_counts_cover_the_same_reviews(t):
    with_id = t["reviews"].where(F.col("id").isNotNull()).count()
    assert _sum(plans.topic_counts(t["reviews"]), "n_reviews") == with_id
    assert _sum(plans.aspect_counts(t["reviews"]), "n_reviews") == with_id


def test_term_frequency_sums_to_the_tokens(t):
    tokens = review_tokens(t["reviews"], t["stop"])
    assert _sum(term_frequency(tokens), "tf") == tokens.count()
