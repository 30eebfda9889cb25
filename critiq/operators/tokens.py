"""Review text to one row per kept word."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from critiq.functions.text import tokenize


def remove_stopwords(tokens: DataFrame, stopwords: DataFrame, col: str = "word") -> DataFrame:
    """Drop tokens found in the word list (left anti join).

    NULL tokens survive, as with an outer join + IS NULL filter. Repeated or
    multi-word list entries are harmless (D11, D12). Spark broadcasts the
    list if its size estimate is below ``spark.sql.autoBroadcastJoinThreshold``
    and joins it by a sort-merge anti join otherwise.
    """
    words = stopwords.select(F.col(stopwords.columns[0]).alias(col))
    return tokens.join(words, col, "left_anti")


def review_tokens(reviews: DataFrame, stopwords: DataFrame, text: str = "review",
                  keep: Sequence[str] = ("topic", "aspect", "sentiment")) -> DataFrame:
    """word and the columns of ``keep`` that ``reviews`` has: cleaned, split, stop words removed.

    Each review is cleaned, split and exploded in one projection (no shuffle);
    the only join is the anti join with the word list.
    """
    kept = [c for c in keep if c in reviews.columns]
    words = reviews.select(F.explode(tokenize(text)).alias("word"), *kept)
    return remove_stopwords(words, stopwords)
