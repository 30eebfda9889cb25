"""Registered queries that write files or tables and read them back: ordered output, rejected lines, inputs, stored tokens.

Each writes rows of the given tables below the shared checkpoint folder, in a fresh folder per run, and returns what the
library's readers make of the files. The oracles are SQL over the tables themselves.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from critiq import plans, schemas
from critiq.operators import (
    dedupe_dimension, document_frequency, expand_tokens, group_count, rating_sums, review_tokens, sort_desc_tiebreak,
    store_tokens, stored_distinct_pairs, stored_term_frequency, tfidf, with_position,
)
from critiq.plans.oracle import with_tables
from critiq.session import materialize, shared_folder
from critiq.sinks.text import render_best_line, render_key_value, write_report
from critiq.sources import tables
from critiq.sources.checked import check_lines, split_lines
from critiq.sources.ordered import read_numbered_lines
from critiq.sources.text import read_dimension, read_ratings

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

MIN_COUNT = 5
PATHS = 20      # input files of the last-line-wins query


def register(name: str, sql: str):
    def deco(fn):
        QUERIES[name], ORACLE[name] = fn, sql
        return fn
    return deco


# --------------------------------------------------------------------------- O4, K1: ordered text output

@register("ordered_text_output", with_tables("ratings", "movies", "raw_stats") + f"""
, body AS (
  SELECT CAST(s.movie_id AS VARCHAR) AS key,
         coalesce(m.title, 'Unknown') || chr(9) || 'Average rating: ' || CAST(s.avg_rating AS VARCHAR)
         || ' (Total ratings: ' || CAST(s.n AS VARCHAR) || ')' AS line
  FROM raw_stats s LEFT JOIN movies m ON s.movie_id = m.movie_id),
best AS (SELECT * FROM raw_stats WHERE n >= {MIN_COUNT} ORDER BY avg_rating DESC, movie_id LIMIT 1),
closing AS (
  SELECT CASE WHEN b.movie_id IS NULL THEN 'No movies exist' || chr(9) || 'No movie with highest ratings'
              ELSE coalesce(m.title, 'Unknown') || chr(9) || 'is the highest rated movie with an average rating of '
                   || CAST(b.avg_rating AS VARCHAR) || ' among movies with at least {MIN_COUNT} ratings.' END AS line
  FROM (SELECT 1 AS one) o LEFT JOIN best b ON TRUE LEFT JOIN movies m ON b.movie_id = m.movie_id)
SELECT row_number() OVER (ORDER BY part, key NULLS FIRST, line) AS line_no, line
FROM (SELECT 0 AS part, key, line FROM body UNION ALL SELECT 1, NULL, line FROM closing) x
""")
def _ordered_text_output(spark, d):
    ratings, movies = tables.ratings(spark, d), tables.movies(spark, d)
    stats = plans.movie_rating_summary(ratings, movies)
    value = F.concat(F.lit("Average rating: "), F.col("avg_rating").cast("string"), F.lit(" (Total ratings: "),
                     F.col("n").cast("string"), F.lit(")"))
    best = plans.best_movie(ratings, movies, MIN_COUNT, places=None, as_float=True)
    folder = shared_folder(spark, "report")
    write_report(render_key_value(stats, "title", value, keep=["movie_id"]), "movie_id",
                 render_best_line(best, MIN_COUNT), folder)
    return read_numbered_lines(spark, folder)


# --------------------------------------------------------------------------- S6, S7: rejected lines

_LINES_SQL = """
WITH rows AS (
  SELECT l_orderkey AS user_id, CASE WHEN l_linenumber <> 7 THEN l_partkey END AS movie_id, l_quantity AS rating,
         CAST(epoch(l_shipdate) AS BIGINT) AS ts, l_orderkey % 7 = 0 AS short,
         concat_ws(', ', CAST(l_orderkey AS VARCHAR),
                   CASE WHEN l_linenumber = 7 THEN 'x' ELSE CAST(l_partkey AS VARCHAR) END,
                   coalesce(CAST(l_quantity AS VARCHAR), '')) AS head
  FROM lineitem),
lines AS (
  SELECT *, CASE WHEN short THEN head ELSE concat_ws(',', head, CAST(ts AS VARCHAR)) END AS line,
         CASE WHEN short THEN 'short' WHEN movie_id IS NULL OR rating IS NULL THEN 'bad number' END AS reason,
         CASE WHEN short THEN '3 of 4 fields' WHEN movie_id IS NULL THEN 'movie_id: x'
              WHEN rating IS NULL THEN 'rating: ' END AS detail
  FROM rows)
"""


def _checked_lines(spark, d):
    """Rating lines: those of every seventh order are cut short, every seventh line of an order has no numeric movie id."""
    movie = F.when(F.col("l_linenumber") == 7, "x").otherwise(F.col("l_partkey").cast("string"))
    head = F.concat_ws(", ", F.col("l_orderkey").cast("string"), movie,
                       F.coalesce(F.col("l_quantity").cast("string"), F.lit("")))
    epoch = F.unix_seconds(F.col("l_shipdate").cast("timestamp")).cast("string")
    line = F.when(F.col("l_orderkey") % 7 == 0, head).otherwise(F.concat_ws(",", head, epoch))
    lines = spark.read.parquet(f"{d}/lineitem.parquet").select(line.alias("line"))
    return split_lines(check_lines(lines, schemas.RATINGS), shared_folder(spark, "ratings"), schemas.RATINGS)


register("scan_rejected_lines", _LINES_SQL + "SELECT line, reason, detail FROM lines WHERE reason IS NOT NULL")(
    lambda spark, d: _checked_lines(spark, d).rejected)

register("scan_accepted_lines", _LINES_SQL + "SELECT user_id, movie_id, rating, ts FROM lines WHERE reason IS NULL")(
    lambda spark, d: _checked_lines(spark, d).accepted)


@register("scan_line_counts", _LINES_SQL + """
SELECT x.outcome, x.n FROM (
  SELECT count(*) AS "read", count(*) FILTER (reason IS NULL) AS accepted, count(*) FILTER (reason = 'short') AS short,
         count(*) FILTER (reason = 'bad number') AS bad_number FROM lines) c,
LATERAL (VALUES ('read', c."read"), ('accepted', c.accepted), ('short', c.short), ('bad number', c.bad_number)) x(outcome, n)
""")
def _scan_line_counts(spark, d):
    counts = _checked_lines(spark, d).counts
    return spark.createDataFrame(list(counts.items()), "outcome string, n long")


# --------------------------------------------------------------------------- S1: several files in one scan, with their input

def _rating_files(spark, d):
    """The two rating files (line status F and the rest) as folders of text lines, and their paths."""
    rows = tables.rating_inputs(spark, d)
    epoch = F.unix_seconds(F.col("ts").cast("timestamp")).cast("string")
    line = F.concat_ws(",", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("user_id", "movie_id", "rating")],
                       epoch)
    folder = shared_folder(spark, "inputs")
    rows.select("input", line.alias("line")).write.partitionBy("input").text(folder)
    return [f"{folder}/input={name}" for name in tables.RATING_INPUTS]


def _read_rating_files(spark, d):
    found = read_ratings(spark, _rating_files(spark, d), input_name="input")
    return found.withColumn("input", F.regexp_extract("input", "=(.*)$", 1))


_INPUTS_SQL = """
WITH r AS (
  SELECT o.o_custkey AS user_id, l.l_partkey AS movie_id, l.l_quantity AS rating, CAST(epoch(l.l_shipdate) AS BIGINT) AS ts,
         CASE WHEN l.l_linestatus = 'F' THEN 'first' ELSE 'rest' END AS input
  FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey)
"""

register("scan_input_files", _INPUTS_SQL + "SELECT user_id, movie_id, rating, ts, input FROM r")(_read_rating_files)

register("scan_input_counts", _INPUTS_SQL + """
SELECT input, count(*) AS n_lines, count(rating) AS n, sum(rating) AS rating_sum FROM r GROUP BY input
""")(lambda spark, d: _read_rating_files(spark, d).groupBy("input").agg(
    F.count(F.lit(1)).alias("n_lines"), F.count("rating").alias("n"), F.sum("rating").alias("rating_sum")))


# --------------------------------------------------------------------------- J9: the last line wins, over many files

@register("last_line_wins", f"""
SELECT user_id, gender, age, occupation_id, zip FROM (
  SELECT c_custkey AS user_id, c_mktsegment AS gender, CAST(c_custkey % 80 AS INTEGER) AS age,
         CAST(c_nationkey AS INTEGER) AS occupation_id, CAST(c_custkey AS VARCHAR) AS zip,
         row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey % {PATHS}, c_custkey DESC) AS rn
  FROM customer) x
WHERE rn = 1
""")
def _last_line_wins(spark, d):
    """User lines in many files, read in the reverse of their names' order; a key's last line in that order stays."""
    rows = spark.read.parquet(f"{d}/customer.parquet").select(
        (F.col("c_custkey") % PATHS).alias("file"), "c_custkey",
        F.concat_ws(", ", "c_custkey", "c_mktsegment", F.col("c_custkey") % 80, "c_nationkey", "c_custkey").alias("line"))
    folder = shared_folder(spark, "users")
    (rows.repartition(PATHS, "file").sortWithinPartitions("file", "c_custkey").select("file", "line")
     .write.partitionBy("file").text(folder))
    paths = [f"{folder}/file={r.file}" for r in rows.select("file").distinct().orderBy(F.col("file").desc()).collect()]
    users = read_dimension(spark, paths, schemas.USERS, line_order=True)
    return dedupe_dimension(users, "occupation_id", "line_no").select(schemas.USERS.names)


# --------------------------------------------------------------------------- K2, S5: stored tokens

def _stored(spark, d, sentiment=False):
    tokens = review_tokens(tables.reviews(spark, d, sentiment), tables.stopwords(spark))
    if not sentiment:
        tokens = tokens.withColumn("sentiment", F.lit(None).cast("string"))
    return store_tokens(tokens).read(spark)


register("stored_tokens", with_tables("tokens") + "SELECT word, topic, aspect, sentiment FROM tokens")(
    lambda spark, d: expand_tokens(_stored(spark, d, sentiment=True)))

register("stored_term_frequency", with_tables("tf") + "SELECT topic, word, CAST(tf AS BIGINT) AS tf FROM tf")(
    lambda spark, d: stored_term_frequency(_stored(spark, d)))

register("stored_distinct_pairs", with_tables("tokens") + "SELECT DISTINCT word, topic FROM tokens")(
    lambda spark, d: stored_distinct_pairs(_stored(spark, d)))

register("stored_document_frequency", with_tables("dfreq") + "SELECT word, df FROM dfreq")(
    lambda spark, d: document_frequency(stored_term_frequency(_stored(spark, d))))


@register("stored_tfidf", with_tables("tfidf") + "SELECT topic, word, tf, df, score FROM tfidf")
def _stored_tfidf(spark, d):
    tf = materialize(stored_term_frequency(_stored(spark, d)))
    return tfidf(tf, group_count(tf)).select("topic", "word", "tf", "df", "score")


# --------------------------------------------------------------------------- O1, O2, O3: the order itself, as positions

register("ordered_word_freq", with_tables("tokens") + """
SELECT row_number() OVER (ORDER BY freq DESC, word) AS position, word, freq
FROM (SELECT word, count(word) AS freq FROM tokens GROUP BY word HAVING count(word) > 500) x
""")(lambda spark, d: with_position(plans.word_freq_over(
    review_tokens(tables.reviews(spark, d), tables.stopwords(spark)), 500)))

register("ordered_topic_counts", with_tables("reviews") + """
SELECT row_number() OVER (ORDER BY n_reviews DESC, topic NULLS FIRST) AS position, topic, n_reviews
FROM (SELECT topic, count(id) AS n_reviews FROM reviews GROUP BY topic) x
""")(lambda spark, d: with_position(plans.topic_counts(tables.reviews(spark, d))))

register("ordered_totals", with_tables("ratings") + """
SELECT row_number() OVER (ORDER BY total DESC NULLS LAST, movie_id NULLS FIRST) AS position, movie_id, total
FROM (SELECT movie_id, sum(rating) AS total FROM ratings GROUP BY movie_id) x
""")(lambda spark, d: with_position(sort_desc_tiebreak(
    rating_sums(tables.ratings(spark, d), ["movie_id"]).select("movie_id", F.col("rating_sum").alias("total")),
    "total", "movie_id")))

register("ordered_years", with_tables("ratings") + """
SELECT row_number() OVER (ORDER BY year NULLS FIRST) AS position, year, avg_rating, n
FROM (SELECT CAST(year(ts) AS INTEGER) AS year, round_even(avg(rating), 4) AS avg_rating, count(rating) AS n
      FROM ratings GROUP BY 1) x
""")(lambda spark, d: with_position(plans.yearly_rating(tables.ratings(spark, d))))

register("ordered_gender_long", with_tables("user_ratings", "users") + """
, r AS (SELECT r.movie_id, r.rating, u.gender FROM ratings r LEFT JOIN users u ON r.user_id = u.user_id),
cats AS (SELECT * FROM (VALUES ('F', 1), ('M', 2)) AS t(gender, category_order)),
s AS (SELECT movie_id, gender, count(rating) AS n FROM r GROUP BY movie_id, gender)
SELECT row_number() OVER (ORDER BY mv.movie_id NULLS FIRST, c.category_order) AS position, mv.movie_id, c.gender,
       coalesce(s.n, 0) AS n
FROM (SELECT DISTINCT movie_id FROM r) mv CROSS JOIN cats c
LEFT JOIN s ON s.movie_id IS NOT DISTINCT FROM mv.movie_id AND s.gender = c.gender
""")(lambda spark, d: with_position(
    plans.movie_gender_long(tables.ratings(spark, d, user=True), tables.users(spark, d), tables.movies(spark, d))
    .orderBy("movie_id", "category_order").select("movie_id", "gender", "n")))
