"""Rating analyses over ``ratings(user_id, movie_id, rating, ts)`` and its dimensions.

Plan shape shared by all of them: aggregate the facts as early as the
grouping allows (partial aggregation happens map-side, so a hot movie or user
is combined before the shuffle), and look dimension attributes up on the
aggregated rows. The per-user attribute breakdowns (gender, age) join users to
sums per (user, movie), not to single ratings.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from critiq.functions.buckets import (
    AGE_LABELS_HALF_OPEN, AGE_LABELS_INCLUSIVE, age_group_half_open, age_group_inclusive,
)
from critiq.functions.format import fixed
from critiq.functions.numeric import year_of
from critiq.operators.lookup import lookup, lookup_few, snowflake_lookup
from critiq.operators.ranking import global_row_number
from critiq.operators.stats import (
    best_with_support, category_sums, densify_categories, explode_list, finish_stats,
    pair_sums, pairs_lookup, rating_stats, rating_sums, widen_categories,
)

# Placeholders used in the outputs.
UNKNOWN_TITLE = "Unknown"
UNKNOWN_GROUP = "Unknown"
UNKNOWN_OCCUPATION = "unknown"
NAN_TEXT = "NaN"
# Gender categories, in output order.
GENDERS_LONG = ["F", "M"]
GENDERS_WIDE = ["M", "F"]
AGE_WIDE_COLUMNS = ["avg_0_18", "avg_18_35", "avg_35_50", "avg_50_plus"]


def _titles(movies: DataFrame) -> DataFrame:
    return movies.select("movie_id", "title")


def movie_rating_summary(ratings: DataFrame, movies: DataFrame) -> DataFrame:
    """Per-movie summary: movie_id, title, avg_rating (float32, unrounded), n — every rated movie."""
    stats = rating_stats(ratings, ["movie_id"], places=None, as_float=True)
    return lookup(stats, _titles(movies), "movie_id", "default", {"title": UNKNOWN_TITLE}) \
        .select("movie_id", "title", "avg_rating", "n")


def movie_rating_ranked(ratings: DataFrame, movies: DataFrame, min_count: int = 5) -> DataFrame:
    """Ranked movies: rank, movie_id, title, avg_rating (4 dp), n for movies with n >= min_count.

    Ranked on the rounded average (D7), ties by movie_id (D6).
    """
    stats = rating_stats(ratings, ["movie_id"], places=4).where(F.col("n") >= min_count)
    ranked = global_row_number(stats, [F.col("avg_rating").desc(), F.col("movie_id").asc()], "rank")
    titled = lookup(ranked, _titles(movies), "movie_id", "default", {"title": UNKNOWN_TITLE})
    return titled.select(F.col("rank").cast("long").alias("rank"), "movie_id", "title", "avg_rating", "n")


def best_movie(ratings: DataFrame, movies: DataFrame, min_count: int = 5, places: int | None = 4,
               as_float: bool = False) -> DataFrame:
    """Best movie: one row (NULLs when no movie has ``min_count`` ratings).

    Decided on the average rounded to ``places`` (default), or with
    ``places=None, as_float=True`` on the unrounded float32 average, the
    form of the summary's sentence; ties go to the smaller id.
    """
    stats = rating_stats(ratings, ["movie_id"], places=places, as_float=as_float)
    best = best_with_support(stats, "movie_id", min_count)
    return lookup_few(best, _titles(movies), "movie_id", {"title": UNKNOWN_TITLE}) \
        .select("movie_id", "title", "avg_rating", "n")


def genre_rating(ratings: DataFrame, movies: DataFrame, places: int | None = 4,
                 as_float: bool = False, ranked: bool = True) -> DataFrame:
    """Per-genre ratings: ranked with 4 dp (default), or the plain float32 summary
    (``places=None, as_float=True, ranked=False``).

    A rating counts once in each genre of its movie; ratings of movies
    missing from ``movies`` are dropped (J2). Ratings are summed per movie
    first, so the genre explode runs on one row per movie, not per rating.
    """
    per_movie = rating_sums(ratings, ["movie_id"])
    with_genres = lookup(per_movie, movies.select("movie_id", "genres"), "movie_id", "drop")
    stats = finish_stats(explode_list(with_genres, "genres", "genre"), ["genre"], places, as_float, rollup=True)
    if not ranked:
        return stats
    out = global_row_number(stats, [F.col("avg_rating").desc(), F.col("genre").asc()], "rank")
    return out.select(F.col("rank").cast("long").alias("rank"), "genre", "avg_rating", "n")


def _with_user(ratings: DataFrame, users: DataFrame, attribute: str, how: str, spread: int | None) -> DataFrame:
    """movie_id, attribute, rating_sum, n: one row per (user, movie); ``spread`` as in :func:`pair_sums`."""
    pairs = pair_sums(ratings, "user_id", ["movie_id"], spread)
    return pairs_lookup(pairs, users.select("user_id", attribute), "user_id", how, spread)


def movie_gender_wide(ratings: DataFrame, users: DataFrame, movies: DataFrame,
                      spread: int | None = None) -> DataFrame:
    """Per-movie gender breakdown, wide: movie_id, title, male, female (float32 averages, NULL = N/A).

    Ratings of unknown users are dropped first (D4); other genders are
    ignored but their movie stays (D3).
    """
    rated = _with_user(ratings, users, "gender", "inner", spread)
    sums = category_sums(rated, "movie_id", "gender", GENDERS_WIDE)
    wide = widen_categories(sums, "movie_id", GENDERS_WIDE, ["male", "female"], places=None, as_float=True)
    return lookup(wide, _titles(movies), "movie_id", "default", {"title": UNKNOWN_TITLE}) \
        .select("movie_id", "title", "male", "female")


def movie_age_wide(ratings: DataFrame, users: DataFrame, movies: DataFrame,
                   spread: int | None = None) -> DataFrame:
    """Per-movie age breakdown, wide: movie_id, title and one float32 average per inclusive age group (NULL = NA)."""
    rated = _with_user(ratings, users, "age", "inner", spread)
    grouped = rated.withColumn("age_group", age_group_inclusive("age"))
    # A pivot on the listed groups: one conditional aggregate per group. An explicit
    # ``groupBy().pivot()`` would aggregate twice (per movie and group, then per movie)
    # with a shuffle each; this plans a single map-side-combined shuffle.
    sums = category_sums(grouped, "movie_id", "age_group", AGE_LABELS_INCLUSIVE)
    wide = widen_categories(sums, "movie_id", AGE_LABELS_INCLUSIVE, AGE_WIDE_COLUMNS, places=None, as_float=True)
    return lookup(wide, _titles(movies), "movie_id", "default", {"title": UNKNOWN_TITLE}) \
        .select("movie_id", "title", *AGE_WIDE_COLUMNS)


def _long_output(long: DataFrame, movies: DataFrame, category: str) -> DataFrame:
    text = F.when(F.col("n") > 0, fixed("avg_rating", 4)).otherwise(F.lit(NAN_TEXT))
    titled = lookup(long, _titles(movies), "movie_id", "default", {"title": UNKNOWN_TITLE})
    return titled.select("movie_id", "title", category, "category_order", "avg_rating", text.alias("avg_text"), "n")


def movie_gender_long(ratings: DataFrame, users: DataFrame, movies: DataFrame,
                      spread: int | None = None) -> DataFrame:
    """Per-movie gender breakdown, long: every rated movie x (F, M): avg_rating (4 dp, NULL when n = 0), avg_text, n.

    ``category_order`` is the position in the fixed list (O3): a report is
    ``orderBy("movie_id", "category_order")``.

    Unknown users form an ``Unknown`` group that the fixed category list then
    leaves out, while their movies stay (D2).
    """
    rated = _with_user(ratings, users, "gender", "left", spread).withColumn("gender", F.coalesce("gender", F.lit(UNKNOWN_GROUP)))
    sums = category_sums(rated, "movie_id", "gender", GENDERS_LONG)
    return _long_output(densify_categories(sums, "movie_id", GENDERS_LONG, "gender"), movies, "gender")


def movie_age_long(ratings: DataFrame, users: DataFrame, movies: DataFrame,
                   spread: int | None = None) -> DataFrame:
    """Per-movie age breakdown, long: every rated movie x 6 half-open age groups, as in :func:`movie_gender_long`."""
    rated = _with_user(ratings, users, "age", "left", spread)
    rated = rated.withColumn("age_group", F.coalesce(age_group_half_open("age"), F.lit(UNKNOWN_GROUP)))
    sums = category_sums(rated, "movie_id", "age_group", AGE_LABELS_HALF_OPEN)
    return _long_output(densify_categories(sums, "movie_id", AGE_LABELS_HALF_OPEN, "age_group"),
                        movies, "age_group")


def occupation_stats(ratings: DataFrame, users: DataFrame, occupation: DataFrame) -> DataFrame:
    """occupation, avg_rating, n. Unknown user or occupation id -> ``unknown``.

    Ratings are summed per user before the two lookups, so the joins see one
    row per user instead of one per rating. Occupations without ratings are
    absent (no densify, A16).
    """
    per_user = rating_sums(ratings, ["user_id"])
    named = snowflake_lookup(per_user, users, "user_id", occupation, "occupation_id", "name",
                             UNKNOWN_OCCUPATION)
    return finish_stats(named.withColumnRenamed("name", "occupation"), ["occupation"], 4, rollup=True)


def occupation_rating(ratings: DataFrame, users: DataFrame, occupation: DataFrame) -> DataFrame:
    """Ranked occupations: rank, occupation, avg_rating, n (see :func:`occupation_stats`)."""
    stats = occupation_stats(ratings, users, occupation)
    out = global_row_number(stats, [F.col("avg_rating").desc(), F.col("occupation").asc()], "rank")
    return out.select(F.col("rank").cast("long").alias("rank"), "occupation", "avg_rating", "n")


def yearly_rating(ratings: DataFrame, tz: str = "UTC") -> DataFrame:
    """Ratings per year: year, avg_rating (4 dp), n; ascending by year.

    ``ts`` may be epoch seconds (text inputs) or a timestamp; epoch values
    are read in ``tz`` (D8).
    """
    dtype = ratings.schema["ts"].dataType
    with_year = ratings.select(year_of("ts", dtype, tz).cast("int").alias("year"), "rating")
    return rating_stats(with_year, ["year"], places=4).orderBy("year")
