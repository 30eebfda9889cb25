"""Term and document frequency, TF-IDF per group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def term_frequency(tokens: DataFrame, group: str = "topic", term: str = "word") -> DataFrame:
    """Group, term, tf = occurrences of the term in the group (Pig COUNT skips NULL terms)."""
    return tokens.groupBy(group, term).agg(F.count(term).alias("tf"))


def distinct_pairs(tokens: DataFrame, group: str = "topic", term: str = "word") -> DataFrame:
    """The distinct (term, group) pairs."""
    return tokens.select(term, group).distinct()


def document_frequency(tf: DataFrame, term: str = "word") -> DataFrame:
    """Term, df = number of groups holding the term.

    Derived from the TF rows, which are already one per (group, term): the
    raw tokens are not shuffled a second time. A NULL group counts as a group
    here, while N counts only non-NULL groups.
    """
    return tf.groupBy(term).agg(F.count(F.lit(1)).alias("df"))


def group_cardinality(tf: DataFrame, group: str = "topic") -> DataFrame:
    """A10: one row, n_groups = number of distinct non-NULL groups."""
    return tf.agg(F.count_distinct(group).alias("n_groups"))


def with_document_frequency(tf: DataFrame, term: str = "word") -> DataFrame:
    """Every TF row with its term's df — TF joined on ``term`` with :func:`document_frequency`.

    DF is aggregated map-side, so a term found in most groups is reduced to
    one row per map partition before its shuffle; the join then lets AQE
    split a hot term's TF partition (skew join) instead of one task holding
    all its rows.
    """
    return tf.join(document_frequency(tf, term), term, "inner")


def group_count(tf: DataFrame, group: str = "topic") -> Column:
    """N as a scalar Column: the number of distinct non-NULL groups in the TF rows."""
    return group_cardinality(tf, group).scalar()


def tfidf(tf: DataFrame, n_groups: Column, term: str = "word", places: int | None = 6) -> DataFrame:
    """score = tf * ln(N / df) for every (group, term).

    ``n_groups`` is a scalar Column (e.g. :func:`group_count`),
    so no cross join is planned. Terms in every group score 0 and stay (D17).
    """
    score = F.col("tf") * F.ln(n_groups.cast("double") / F.col("df"))
    if places is not None:
        score = F.round(score, places)
    return with_document_frequency(tf, term).withColumn("score", score)
