"""Physical plan properties that matter at scale (read from explain output)."""

import os

import pytest

import __spark_entry__ as E
from critiq.plans import catalog
from tests.conftest import SF_SMALL, explain_text

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_SMALL), reason="test tables not present")


def _plan(spark, name):
    return explain_text(E.queries()[name](spark, SF_SMALL), "formatted")


# broadcasts that remain without automatic broadcasting: one row per partition (places of sorted rows) or per split
RANKED = {"movie_rating_ranked", "genre_rating", "occupation_rating", "render_report_lines", "ordered_text_output",
          "ordered_word_freq", "ordered_topic_counts", "ordered_totals", "ordered_years", "ordered_gender_long"}


@pytest.mark.parametrize("broadcast", ["10m", "-1"])
@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_no_cartesian_or_nested_loop_join(spark, name, broadcast):
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    for k in keys:
        spark.conf.set(k, broadcast)
    try:
        plan = _plan(spark, name)
        assert "CartesianProduct" not in plan
        assert "NestedLoopJoin" not in plan
        if broadcast == "-1":
            assert plan.count("BroadcastExchange (") <= 2 * (name in RANKED)
    finally:
        for k in keys:
            spark.conf.unset(k)


def test_labels_are_joined_once(spark):
    plan = explain_text(E.queries()["filter_sentiment"](spark, SF_SMALL), "simple")
    assert plan.count("labels.parquet") == 1


def test_stopword_anti_join_is_broadcast(spark):
    plan = _plan(spark, "review_tokens")
    assert "BroadcastHashJoin" in plan and "LeftAnti" in plan
    assert "SortMergeJoin" not in plan


def test_top_k_limits_before_the_shuffle(spark):
    plan = _plan(spark, "topic_top_words_positive")
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_aggregates_combine_map_side(spark):
    for name in ["movie_rating_summary", "word_freq_over", "occupation_rating", "topic_counts"]:
        assert "partial_" in _plan(spark, name), name


def test_scans_read_only_needed_columns(spark):
    plan = _plan(spark, "yearly_rating")
    schemas = [line.split("ReadSchema: ")[1] for line in plan.splitlines() if "ReadSchema: " in line]
    lineitem = [s for s in schemas if "l_quantity" in s]
    assert lineitem and all("l_quantity" in s and "l_shipdate" in s for s in lineitem)
    for unused in ["l_orderkey", "l_partkey", "l_suppkey", "l_extendedprice", "l_discount", "l_tax", "l_returnflag"]:
        assert all(unused not in s for s in lineitem), unused
    assert "orders.parquet" not in plan        # the customer of an order is not needed for years


def test_filter_reaches_the_scan(spark):
    assert "Not(EqualTo(n_regionkey,0))" in _plan(spark, "lookup_inner")
    assert "IsNotNull(l_quantity)" in _plan(spark, "scan_rating_lines_strict")


def test_both_rating_inputs_are_one_scan(spark):
    plan = explain_text(E.queries()["scan_union_inputs"](spark, SF_SMALL), "simple")
    assert plan.count("lineitem.parquet") == 1 and plan.count("orders.parquet") == 1 and "Union" not in plan
    plan = explain_text(E.queries()["scan_input_files"](spark, SF_SMALL), "simple")
    assert plan.count("FileScan") == 1 and "Union" not in plan


BY_USER = ["movie_gender_wide", "movie_age_wide", "movie_gender_long", "movie_age_long"]


def _below_users_join(spark, name, spread):
    """Plan lines below the users join, and the place of the finished sums per (user, movie) among them."""
    from critiq import plans
    from critiq.sources import tables

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lines = explain_text(getattr(plans, name)(tables.ratings(spark, SF_SMALL, user=True), tables.users(spark, SF_SMALL),
                                                  tables.movies(spark, SF_SMALL), spread), "simple").splitlines()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    join = next(i for i, line in enumerate(lines) if "SortMergeJoin [user_id" in line)
    below = lines[join + 1:]
    return below, next(i for i, line in enumerate(below) if "HashAggregate(keys=[user_id" in line and "movie_id" in line)


@pytest.mark.parametrize("name", BY_USER)
def test_users_join_sees_pairs(spark, name):
    below, pairs = _below_users_join(spark, name, None)
    dealt = next(line for line in below[pairs:] if "Exchange" in line)
    assert "hashpartitioning(user_id" in dealt and "movie_id" in dealt      # a hot user is spread by its movies
    after = next(line for line in below[pairs + 1:] if "Exchange" not in line and "HashAggregate" in line)
    assert "partial_sum" in after                                           # repeats are combined before the shuffle


@pytest.mark.parametrize("name", BY_USER)
def test_pairs_and_users_join_share_one_partitioning(spark, name):
    below, pairs = _below_users_join(spark, name, 8)
    assert not any("Exchange" in line for line in below[:pairs])            # finished where the join needs it
    dealt = next(line for line in below[pairs:] if "Exchange" in line)
    assert "hashpartitioning(user_id" in dealt and "_salt" in dealt and "movie_id" not in dealt


@pytest.mark.parametrize("name", BY_USER)
def test_shared_partitioning_changes_no_row(spark, name):
    from critiq import plans
    from critiq.sources import tables

    args = tables.ratings(spark, SF_SMALL, user=True), tables.users(spark, SF_SMALL), tables.movies(spark, SF_SMALL)
    rows = [sorted(map(tuple, getattr(plans, name)(*args, spread).collect()), key=str) for spread in (None, 5)]
    assert rows[0] == rows[1]


def test_per_movie_analyses_do_not_read_orders(spark):
    for name in ["movie_rating_summary", "movie_rating_ranked", "best_movie", "genre_rating", "yearly_rating"]:
        assert "orders.parquet" not in _plan(spark, name), name
    assert "orders.parquet" in _plan(spark, "movie_gender_wide")


def test_occupation_joins_see_per_user_rows(spark):
    from critiq.plans.ratings import occupation_stats
    from critiq.sources import tables

    plan = explain_text(occupation_stats(tables.ratings(spark, SF_SMALL, user=True), tables.users(spark, SF_SMALL),
                                         tables.occupation(spark, SF_SMALL)), "simple")
    # the fact is aggregated per user before the user lookup
    first_join = plan.index("Join")
    assert "HashAggregate(keys=[user_id" in plan[first_join:]


@pytest.mark.parametrize("name", ["topic_top_tfidf", "cross_scalar", "tfidf_scores"])
def test_tf_is_materialized_once(spark, name):
    # TF feeds the scores, DF and the N subquery; all read the checkpointed TF, not the text
    plan = explain_text(E.queries()[name](spark, SF_SMALL), "simple")
    assert "documents.parquet" not in plan


def test_best_movie_reuses_the_aggregate(spark):
    df = E.queries()["best_movie"](spark, SF_SMALL)
    df.collect()
    assert "ReusedExchange" in explain_text(df, "simple")


def test_word_list_join_follows_the_size_check(spark):
    from pyspark.sql import functions as F

    from critiq.operators import remove_stopwords

    tokens = spark.createDataFrame([("a",), ("b",), ("c",)], "word string")
    words = spark.range(0, 50).select(F.col("id").cast("string").alias("word"))
    assert "BroadcastHashJoin" in explain_text(remove_stopwords(tokens, words), "simple")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        over = remove_stopwords(tokens, words)
        assert "SortMergeJoin" in explain_text(over, "simple")
        assert sorted(r.word for r in over.collect()) == ["a", "b", "c"]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
