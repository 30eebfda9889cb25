"""Stored tokens: bucketed by (topic, word), counted, and equal to the raw tokens when expanded."""

import glob
import os
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from critiq import schemas
from critiq.operators import (
    distinct_pairs, document_frequency, expand_tokens, store_tokens, stored_distinct_pairs, stored_term_frequency, term_frequency,
    with_document_frequency,
)
from tests.conftest import explain_text


def _bag(df):
    return Counter(map(tuple, df.collect()))


@pytest.fixture(scope="module")
def tokens(spark):
    rnd = random.Random(6)
    rows = [(rnd.choice(["phòng", "giá", "tốt", "a\tb", "", None]), rnd.choice(["ROOMS", "PRICES", None]),
             rnd.choice(["QUALITY", "VALUE"]), rnd.choice(["positive", "negative", None])) for _ in range(4000)]
    return spark.createDataFrame(rows, schemas.TOKENS).repartition(5)


@pytest.fixture(scope="module")
def stored(spark, tokens, tmp_path_factory):
    return store_tokens(tokens, str(tmp_path_factory.mktemp("stored") / "t"), buckets=6)


def test_round_trip_and_files(spark, tokens, stored):
    assert _bag(expand_tokens(stored.read(spark))) == _bag(tokens)
    assert len(glob.glob(os.path.join(stored.folder, "part-*"))) <= 6           # one file per bucket
    assert stored.read(spark).count() == tokens.distinct().count()


def test_frequencies_equal_those_of_the_raw_tokens(spark, tokens, stored):
    held = stored.read(spark)
    assert _bag(stored_term_frequency(held)) == _bag(term_frequency(tokens))
    assert _bag(stored_distinct_pairs(held)) == _bag(distinct_pairs(tokens))
    assert _bag(document_frequency(stored_term_frequency(held))) == _bag(document_frequency(term_frequency(tokens)))
    assert _bag(with_document_frequency(stored_term_frequency(held)).select("topic", "word", "tf", "df")) == \
        _bag(with_document_frequency(term_frequency(tokens)).select("topic", "word", "tf", "df"))


def test_stored_tokens_need_no_shuffle(spark, stored):
    held = stored.read(spark)
    for df in (stored_term_frequency(held), stored_distinct_pairs(held)):
        plan = explain_text(df, "formatted")
        assert "Exchange" not in plan and "Bucketed: true" in plan
    # document frequencies and their join shuffle the (topic, word) rows by word, never the stored tokens
    plan = explain_text(with_document_frequency(stored_term_frequency(held)), "simple")
    for chunk in plan.split("FileScan")[:-1]:
        below = chunk.rsplit("Exchange", 1)[-1]
        assert "HashAggregate" in below


def test_hot_word_is_one_row_per_label(spark, tmp_path):
    hot = spark.range(300_000).select(F.lit("hot").alias("word"), F.lit("T").alias("topic"), F.lit("A").alias("aspect"),
                                      F.when(F.col("id") % 2 == 0, "positive").alias("sentiment"))
    held = store_tokens(hot, str(tmp_path / "t"), buckets=4).read(spark)
    assert held.count() == 2
    assert [tuple(r) for r in stored_term_frequency(held).collect()] == [("T", "hot", 300_000)]
    assert expand_tokens(held).groupBy("sentiment").count().orderBy("sentiment").collect() == [
        (None, 150_000), ("positive", 150_000)]


def test_no_tokens(spark, tmp_path):
    held = store_tokens(spark.createDataFrame([], schemas.TOKENS), str(tmp_path / "t")).read(spark)
    assert expand_tokens(held).collect() == [] and stored_term_frequency(held).collect() == []
