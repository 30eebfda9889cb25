"""Rating averages and counts in flat, wide and long form.

Averages are computed as ``sum / count`` from partial aggregates, so a
breakdown can be rolled up (per movie -> per genre, per user -> per
occupation) without shuffling the facts again. Counts skip NULL ratings, the
same rows the average skips.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from critiq.functions.numeric import round_half_even
from critiq.functions.text import regex_literal, strip


def _avg(total: Column, n: Column) -> Column:
    return F.when(n > 0, total / n)


def rating_sums(ratings: DataFrame, keys: Sequence[str], rating: str = "rating") -> DataFrame:
    """keys..., rating_sum, n: one partial-aggregate row per key."""
    return ratings.groupBy(*keys).agg(F.sum(rating).alias("rating_sum"), F.count(rating).alias("n"))


SALT = "_salt"


def pair_sums(ratings: DataFrame, by: str, keys: Sequence[str], spread: int | None = None,
              rating: str = "rating") -> DataFrame:
    """keys..., ``by``, rating_sum, n: sums per (``by``, keys) below a later join on ``by`` (eager aggregation, J2/J3).

    By default repeats are combined before the shuffle, which deals the sums by all columns, so a ``by`` that holds a large
    share of the rows is spread over all tasks; the join that follows deals the sums again (unless it broadcasts the
    dimension) and adaptive execution splits its hot partitions.

    With ``spread`` one shuffle serves both: rows are dealt by ``by`` and one of ``spread`` salts taken from the keys,
    the sums are finished where they lie, and :func:`pairs_lookup` joins on the same partitioning. This saves a shuffle
    where no ``by`` holds more than ``spread`` partitions' worth of rows.
    """
    if spread is None:
        return rating_sums(ratings, [by, *keys], rating)
    salted = ratings.select(by, *keys, rating, F.pmod(F.hash(*keys), F.lit(spread)).alias(SALT))
    return rating_sums(salted.repartition(F.col(by), F.col(SALT)), [by, SALT, *keys], rating)


def pairs_lookup(pairs: DataFrame, dim: DataFrame, by: str, how: str = "inner", spread: int | None = None) -> DataFrame:
    """Join the rows of :func:`pair_sums` (same ``spread``) with a dimension of one row per ``by``; ``how`` is inner or left."""
    if spread is None:
        return pairs.join(dim, by, how)
    salts = F.explode(F.sequence(F.lit(0), F.lit(spread - 1)))
    return pairs.join(dim.withColumn(SALT, salts), [by, SALT], how).drop(SALT)


def finish_stats(sums: DataFrame, keys: Sequence[str], places: int | None = 4,
                 as_float: bool = False, rollup: bool = False) -> DataFrame:
    """Turn ``rating_sum``/``n`` rows into ``avg_rating``/``n``.

    ``rollup=True`` first re-aggregates the partial rows to ``keys``.
    ``places`` rounds half-even (D5); ``as_float`` casts to float32 (the summary output type).
    """
    if rollup:
        sums = sums.groupBy(*keys).agg(F.sum("rating_sum").alias("rating_sum"), F.sum("n").alias("n"))
    avg = _avg(F.col("rating_sum"), F.col("n"))
    if places is not None:
        avg = round_half_even(avg, places)
    if as_float:
        avg = avg.cast("float")
    return sums.select(*keys, avg.alias("avg_rating"), F.col("n"))


def rating_stats(ratings: DataFrame, keys: Sequence[str], places: int | None = 4,
                 as_float: bool = False, rating: str = "rating") -> DataFrame:
    """Avg and count of ``rating`` per key (partial + final aggregate)."""
    return finish_stats(rating_sums(ratings, keys, rating), list(keys), places, as_float)


def explode_list(df: DataFrame, list_col: str, item_col: str, sep: str = "|") -> DataFrame:
    """one row per trimmed item of a ``sep`` separated list column."""
    items = F.transform(F.split(F.col(list_col), regex_literal(sep)), strip)
    return df.withColumn(item_col, F.explode(items)).drop(list_col)


def category_sums(sums: DataFrame, key: str, category_col: str, categories: Sequence[str]) -> DataFrame:
    """A4/A14 core: per key, sum and count of ratings for each listed category, from ``rating_sum``/``n`` rows.

    One conditional aggregate per category; values outside the list are
    ignored but the key row stays (D3). Every key present in ``sums``
    gets a row, so nothing needs a later cross join to be densified.
    """
    aggs = []
    for i, cat in enumerate(categories):
        hit = F.col(category_col) == F.lit(cat)
        aggs += [F.sum(F.when(hit, F.col("rating_sum"))).alias(f"_sum{i}"),
                 F.sum(F.when(hit, F.col("n")).otherwise(0)).alias(f"_n{i}")]
    return sums.groupBy(key).agg(*aggs)


def widen_categories(sums: DataFrame, key: str, categories: Sequence[str], names: Sequence[str],
                     places: int | None = None, as_float: bool = True) -> DataFrame:
    """A4/A5 wide form: one average column per category (NULL where no rating)."""
    cols = []
    for i, name in enumerate(names[:len(categories)]):
        avg = _avg(F.col(f"_sum{i}"), F.col(f"_n{i}"))
        if places is not None:
            avg = round_half_even(avg, places)
        cols.append((avg.cast("float") if as_float else avg).alias(name))
    return sums.select(key, *cols)


def densify_categories(sums: DataFrame, key: str, categories: Sequence[str], category_name: str,
                       places: int = 4) -> DataFrame:
    """A14 long form: every (key, category) pair, categories in list order.

    Missing pairs get ``avg_rating`` NULL (shown as NaN by renderers) and
    ``n`` 0. Built from the per-key conditional sums by exploding a fixed
    array, so it needs neither a join nor a cross product.
    """
    cells = F.array(*[
        F.struct(F.lit(cat).alias(category_name), F.lit(i + 1).alias("category_order"),
                 F.col(f"_sum{i}").alias("rating_sum"), F.col(f"_n{i}").alias("n"))
        for i, cat in enumerate(categories)
    ])
    long = sums.select(key, F.inline(cells))
    avg = round_half_even(_avg(F.col("rating_sum"), F.col("n")), places)
    return long.select(key, category_name, "category_order", avg.alias("avg_rating"), "n")


def best_with_support(stats: DataFrame, key: str, min_count: int, measure: str = "avg_rating",
                      count_col: str = "n") -> DataFrame:
    """The single best key among those with ``count_col >= min_count``.

    Highest ``measure`` wins; ties go to the smallest key (D15). Always one
    row: NULLs when no key has enough support (the fallback row). A global
    ``min`` over a struct, so each partition reduces to one candidate first.
    """
    eligible = stats.where(F.col(count_col) >= min_count)
    rest = [c for c in stats.columns if c not in (key, measure)]
    ordering = F.struct(F.negative(F.col(measure)).alias("_neg"), F.col(key).alias("_key"),
                        F.col(measure).alias("_m"), *[F.col(c) for c in rest])
    best = eligible.agg(F.min(ordering).alias("_best"))
    return best.select(F.col("_best._key").alias(key), F.col("_best._m").alias(measure),
                       *[F.col(f"_best.{c}").alias(c) for c in rest])
