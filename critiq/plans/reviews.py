"""Review-text analyses over ``reviews(id, review, topic, aspect, sentiment)``.

``tokens`` is the output of :func:`critiq.operators.review_tokens`; callers
build it once and may persist or write it as an intermediate (S5/K2) before
running several analyses on it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from critiq.session import materialize
from critiq.operators.ranking import argmax_with_ties, sort_desc_tiebreak, top_k_per_group
from critiq.operators.tfidf import group_count, term_frequency, tfidf


def word_freq_over(tokens: DataFrame, threshold: int = 500) -> DataFrame:
    """Word frequencies: word, freq for words seen more than ``threshold`` times; most frequent first."""
    freq = tokens.groupBy("word").agg(F.count("word").alias("freq")).where(F.col("freq") > threshold)
    return sort_desc_tiebreak(freq, "freq", "word")


def _count_by(reviews: DataFrame, col: str) -> DataFrame:
    # Pig COUNT skips rows whose first field (the id) is NULL.
    counts = reviews.groupBy(col).agg(F.count("id").alias("n_reviews"))
    return sort_desc_tiebreak(counts, "n_reviews", col)


def topic_counts(reviews: DataFrame) -> DataFrame:
    """Reviews per topic: topic, n_reviews; largest first."""
    return _count_by(reviews, "topic")


def aspect_counts(reviews: DataFrame) -> DataFrame:
    """Reviews per aspect: aspect, n_reviews; largest first."""
    return _count_by(reviews, "aspect")


def top_aspect(reviews: DataFrame, sentiment: str) -> DataFrame:
    """Top aspect: the aspect(s) with the most reviews of ``sentiment``; all ties kept."""
    picked = reviews.where(F.col("sentiment") == sentiment)
    return argmax_with_ties(picked.groupBy("aspect").agg(F.count("id").alias("n_reviews")), "n_reviews")


def topic_top_words(tokens: DataFrame, sentiment: str, k: int = 5) -> DataFrame:
    """Top words per topic: topic, word, freq — the ``k`` most frequent words per topic for one sentiment."""
    picked = tokens.where(F.col("sentiment") == sentiment)
    tf = term_frequency(picked).withColumnRenamed("tf", "freq")
    return top_k_per_group(tf, ["topic"], [F.col("freq").desc(), F.col("word").asc()], k)


def tfidf_scores(tokens: DataFrame) -> DataFrame:
    """TF-IDF of every pair: topic, word, tf, df, score = tf * ln(N / df) (6 dp) for every pair.

    TF feeds three branches (the scores, DF and the group count N, a scalar
    subquery). It is checkpointed once to the cluster's checkpoint folder,
    so the text is read and tokenised exactly once; without that, the
    subquery would re-run the tokenisation whenever Spark does not happen
    to reuse the main query's shuffle.
    """
    tf = materialize(term_frequency(tokens))
    n_topics = group_count(tf)
    return tfidf(tf, n_topics).select("topic", "word", "tf", "df", "score")


def topic_top_tfidf(tokens: DataFrame, k: int = 5) -> DataFrame:
    """Top TF-IDF words per topic: topic, word, score — the ``k`` best-scoring words per topic (ties by word)."""
    scores = tfidf_scores(tokens).select("topic", "word", "score")
    return top_k_per_group(scores, ["topic"], [F.col("score").desc(), F.col("word").asc()], k)
