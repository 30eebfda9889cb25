"""Rating analyses on hand-made fixtures, checked against plain-Python recomputation."""

from collections import defaultdict

import pytest

from critiq import plans
from critiq.functions import age_group_half_open, age_group_inclusive, epoch_year, round_half_even
from critiq.operators import dedupe_dimension, lookup, snowflake_lookup

RATINGS = [  # user, movie, rating, ts
    (1, 10, 4.0, 1577836800), (2, 10, 5.0, 1577836800), (3, 10, 3.0, 1609459199),
    (1, 20, 2.0, 1609459200), (4, 20, 4.5, 1609459200),   # user 4 unknown
    (4, 30, 3.5, 1609459200),                              # only an unknown user
    (5, 40, 1.0, 1577836800), (2, 40, 2.0, 1577836800),   # movie 40 has no dimension row
    (6, 10, 5.0, 1577836800),                              # user 6: third gender value
]
MOVIES = [(10, "Ten (2000)", "Drama|Crime"), (20, "Twenty, The (1990)", "Drama"), (30, "Thirty", "Comedy")]
USERS = [(1, "M", 18, 1), (2, "F", 35, 2), (3, "M", 50, 99), (5, "F", 17, 1), (6, "X", 55, 2)]
OCC = [(1, "Doctor"), (2, "Artist"), (13, "Researcher")]


@pytest.fixture(scope="module")
def data(spark):
    r = spark.createDataFrame(RATINGS, "user_id long, movie_id long, rating double, ts long")
    m = spark.createDataFrame(MOVIES, "movie_id long, title string, genres string")
    u = spark.createDataFrame(USERS, "user_id long, gender string, age int, occupation_id int")
    o = spark.createDataFrame(OCC, "occupation_id int, name string")
    return r, m, u, o


def _avg(xs):
    return sum(xs) / len(xs)


def test_movie_rating_summary_keeps_unmatched_with_default(data):
    r, m, _, _ = data
    got = {x.movie_id: (x.title, x.avg_rating, x.n) for x in plans.movie_rating_summary(r, m).collect()}
    by = defaultdict(list)
    for _, mid, rt, _ in RATINGS:
        by[mid].append(rt)
    titles = {mid: t for mid, t, _ in MOVIES}
    assert set(got) == set(by)
    for mid, xs in by.items():
        title, avg, n = got[mid]
        assert title == titles.get(mid, "Unknown") and n == len(xs)
        assert avg == pytest.approx(_avg(xs), rel=1e-6)
    assert sum(v[2] for v in got.values()) == len(RATINGS)      # invariant: counts add up


def test_ranked_and_best_with_threshold_and_ties(spark, data):
    r, m, _, _ = data
    ranked = plans.movie_rating_ranked(r, m, min_count=2).orderBy("rank").collect()
    # movie 10: avg 4.25 (4 ratings); 20: 3.25; 40: 1.5 (Unknown title)
    assert [(x["rank"], x.movie_id, x.title, x.avg_rating, x.n) for x in ranked] == [
        (1, 10, "Ten (2000)", 4.25, 4), (2, 20, "Twenty, The (1990)", 3.25, 2), (3, 40, "Unknown", 1.5, 2)]
    best = plans.best_movie(r, m, min_count=2).collect()
    assert [tuple(x) for x in best] == [(10, "Ten (2000)", 4.25, 4)]
    none = plans.best_movie(r, m, min_count=100).collect()
    assert [tuple(x) for x in none] == [(None, None, None, None)]      # fallback row
    tie = spark.createDataFrame([(1, 7, 4.0, 0), (1, 5, 4.0, 0)], "user_id long, movie_id long, rating double, ts long")
    assert plans.best_movie(tie, m, min_count=1).collect()[0].movie_id == 5     # smallest key wins a tie


def test_genre_rating_drops_unmatched_and_counts_each_genre(data):
    r, m, _, _ = data
    got = {x.genre: (x.avg_rating, x.n) for x in plans.genre_rating(r, m, places=None, ranked=False).collect()}
    genres = {mid: g.split("|") for mid, _, g in MOVIES}
    by = defaultdict(list)
    for _, mid, rt, _ in RATINGS:
        for g in genres.get(mid, []):
            by[g].append(rt)
    assert set(got) == set(by)
    for g, xs in by.items():
        assert got[g][1] == len(xs) and got[g][0] == pytest.approx(_avg(xs))
    ranked = plans.genre_rating(r, m).orderBy("rank").collect()
    assert [x.genre for x in ranked] == sorted(by, key=lambda g: (-round(_avg(by[g]), 4), g))


def test_gender_wide_drops_unknown_users_keeps_other_gender_rows(data):
    r, m, u, _ = data
    got = {x.movie_id: (x.male, x.female) for x in plans.movie_gender_wide(r, u, m).collect()}
    assert 30 not in got                          # rated only by an unknown user (D4)
    assert got[10] == (pytest.approx(3.5), pytest.approx(5.0))   # X-gender rating ignored (D3)
    assert got[40] == (None, pytest.approx(1.5))


def test_age_wide_inclusive_edges(data):
    r, m, u, _ = data
    got = {x.movie_id: tuple(x)[2:] for x in plans.movie_age_wide(r, u, m).collect()}
    # movie 10: user1 age 18 -> 0-18, user2 35 -> 18-35, user3 50 -> 35-50, user6 55 -> 50+
    assert got[10] == (4.0, 5.0, 3.0, 5.0)
    assert got[40] == (1.0, 2.0, None, None)


def test_gender_long_densifies_and_hides_unknown_group(data):
    r, m, u, _ = data
    rows = plans.movie_gender_long(r, u, m).collect()
    movies = {x[1] for x in RATINGS}
    assert len(rows) == len(movies) * 2             # invariant: movies x categories
    got = {(x.movie_id, x.gender): (x.avg_rating, x.avg_text, x.n) for x in rows}
    assert got[(30, "F")] == (None, "NaN", 0) and got[(30, "M")] == (None, "NaN", 0)   # D2: movie stays
    assert got[(10, "M")] == (3.5, "3.5000", 2)


def test_age_long_half_open_groups(data):
    r, m, u, _ = data
    rows = plans.movie_age_long(r, u, m).collect()
    assert len(rows) == 4 * 6
    got = {(x.movie_id, x.age_group): x.n for x in rows}
    assert got[(10, "2. 18-24")] == 1 and got[(10, "4. 35-44")] == 1 and got[(10, "5. 45-54")] == 1
    assert got[(10, "6. 55+")] == 1 and got[(40, "1. Under 18")] == 1


def test_occupation_two_level_miss_is_unknown(data):
    r, _, u, o = data
    got = {x.occupation: (x.avg_rating, x.n) for x in plans.occupation_rating(r, u, o).collect()}
    # user 3 -> occupation 99 (missing), user 4 -> no user row: both "unknown"
    assert got["unknown"] == (pytest.approx(round(_avg([3.0, 4.5, 3.5]), 4)), 3)
    assert "Researcher" not in got                # no densify
    assert got["Doctor"][1] == 3 and got["Artist"][1] == 3


def test_yearly_rating_time_zone(spark, data):
    r, _, _, _ = data
    utc = {x.year: x.n for x in plans.yearly_rating(r).collect()}
    assert utc == {2020: 6, 2021: 3}
    ny = {x.year: x.n for x in plans.yearly_rating(r, tz="America/New_York").collect()}
    assert ny == {2019: 5, 2020: 4}


def test_buckets_edges_and_null(spark):
    ages = spark.createDataFrame([(a,) for a in [0, 17, 18, 19, 24, 25, 34, 35, 36, 44, 45, 50, 51, 54, 55, 80, None]],
                                 "age int")
    got = {x.age: (x.inc, x.half) for x in ages.select("age", age_group_inclusive("age").alias("inc"),
                                                          age_group_half_open("age").alias("half")).collect()}
    assert got[18] == ("0-18", "2. 18-24") and got[17] == ("0-18", "1. Under 18")
    assert got[35] == ("18-35", "4. 35-44") and got[36] == ("35-50", "4. 35-44")
    assert got[50] == ("35-50", "5. 45-54") and got[51] == ("50+", "5. 45-54")
    assert got[55] == ("50+", "6. 55+") and got[None] == (None, None)


def test_round_half_even_and_epoch_year(spark):
    df = spark.createDataFrame([(3.03125, 1577836800)], "x double, ts long")
    row = df.select(round_half_even("x", 4).alias("r"), epoch_year("ts").alias("y"),
                    epoch_year("ts", "America/Los_Angeles").alias("y2")).collect()[0]
    assert (row.r, row.y, row.y2) == (3.0312, 2020, 2019)


def test_dedupe_dimension_last_wins_and_lookup_policies(spark):
    dim = spark.createDataFrame([(1, "old", 1), (1, "new", 2), (2, "only", 1)], "k long, v string, line long")
    d = dedupe_dimension(dim, "k", "line")
    assert sorted(tuple(x) for x in d.collect()) == [(1, "new", 2), (2, "only", 1)]
    fact = spark.createDataFrame([(1,), (2,), (3,)], "k long")
    dd = d.select("k", "v")
    assert sorted(tuple(x) for x in lookup(fact, dd, "k", "default", {"v": "?"}).collect()) == [
        (1, "new"), (2, "only"), (3, "?")]
    assert sorted(tuple(x) for x in lookup(fact, dd, "k", "drop").collect()) == [(1, "new"), (2, "only")]


def test_snowflake_lookup(spark):
    fact = spark.createDataFrame([(1, 5.0), (2, 4.0), (3, 3.0)], "u long, r double")
    users = spark.createDataFrame([(1, 10), (2, 99)], "u long, occ int")
    occ = spark.createDataFrame([(10, "Doctor")], "occ int, name string")
    got = sorted(tuple(x) for x in snowflake_lookup(fact, users, "u", occ, "occ", "name", "unknown").collect())
    assert got == [(1, 5.0, "Doctor"), (2, 4.0, "unknown"), (3, 3.0, "unknown")]


def test_default_fills_unmatched_keys_and_null_attributes(spark):
    fact = spark.createDataFrame([(1,), (2,)], "k long")
    dim = spark.createDataFrame([(1, None)], "k long, v string")
    got = sorted(tuple(r) for r in lookup(fact, dim, "k", "default", {"v": "Unknown"}).collect())
    assert got == [(1, "Unknown"), (2, "Unknown")]


def test_raw_best_movie_separates_averages_equal_at_four_places(spark):
    # 4.00001 and 4.00002 round alike: the rounded form takes the smaller id, the raw form the larger average
    rows = [(1, 1, 4.00001, 0)] * 5 + [(1, 2, 4.00002, 0)] * 5
    ratings = spark.createDataFrame(rows, "user_id long, movie_id long, rating double, ts long")
    movies = spark.createDataFrame([(1, "One", "x"), (2, "Two", "x")], "movie_id long, title string, genres string")
    assert plans.best_movie(ratings, movies, 5).first().title == "One"
    raw = plans.best_movie(ratings, movies, 5, places=None, as_float=True).first()
    assert (raw.title, raw.movie_id) == ("Two", 2)
    from critiq.sinks import render_best_line
    line = render_best_line(plans.best_movie(ratings, movies, 5, places=None, as_float=True), 5).first().line
    assert line.startswith("Two\tis the highest rated movie with an average rating of 4.00002 among")
