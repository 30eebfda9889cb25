"""Registry of the runnable queries on the test tables, with their SQL oracles.

Each entry maps a key of the survey's operator inventory to a callable
``(spark, sf_dir) -> DataFrame`` over the whole parquet tables, and (where
the result is SQL-expressible) to DuckDB SQL over the same base views with
the same column names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from critiq import plans, schemas
from critiq.functions.buckets import age_group_half_open, age_group_inclusive
from critiq.functions.format import fixed, with_placeholder
from critiq.functions.numeric import round_half_even
from critiq.functions.text import normalize_text, tokenize
from critiq.operators import (
    dedupe_dimension, distinct_pairs, document_frequency, explode_list, group_cardinality, group_count,
    lookup, rating_stats, remove_stopwords, review_tokens, snowflake_lookup, sort_desc_tiebreak,
    term_frequency,
)
from critiq.plans import file_catalog
from critiq.plans.oracle import with_tables
from critiq.session import materialize
from critiq.sinks.text import (
    render_best_block, render_best_line, render_delimited, render_key_value, render_report_lines, render_tsv,
)
from critiq.sources import tables
from critiq.sources.text import (
    REVIEW_OPTIONS, TOKEN_OPTIONS, csv_options, filter_required_fields, parse_delimited, parse_lines, parse_movies,
    parse_ratings, parse_words,
)

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

# Parameters of the registered queries (fixed, survey §7.2b).
MIN_COUNT = 5           # the programs' own threshold
WORD_THRESHOLD = 500
TOP_K = 5


def register(name: str, sql: str | None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def _tokens(spark, d, sentiment=False):
    return review_tokens(tables.reviews(spark, d, sentiment), tables.stopwords(spark))


def _user_ratings(spark, d):
    return tables.ratings(spark, d, user=True)


# --------------------------------------------------------------------------- ratings

register("movie_rating_summary", with_tables("ratings", "movies") + """
SELECT s.movie_id, coalesce(m.title, 'Unknown') AS title, s.avg_rating, s.n
FROM (SELECT movie_id, CAST(avg(rating) AS FLOAT) AS avg_rating, count(rating) AS n
      FROM ratings GROUP BY movie_id) s
LEFT JOIN movies m ON s.movie_id = m.movie_id
""")(lambda spark, d: plans.movie_rating_summary(tables.ratings(spark, d), tables.movies(spark, d)))

register("movie_rating_ranked", with_tables("movie_stats", "movies") + f"""
SELECT row_number() OVER (ORDER BY s.avg_rating DESC, s.movie_id) AS rank, s.movie_id,
       coalesce(m.title, 'Unknown') AS title, s.avg_rating, s.n
FROM movie_stats s LEFT JOIN movies m ON s.movie_id = m.movie_id
WHERE s.n >= {MIN_COUNT}
""")(lambda spark, d: plans.movie_rating_ranked(tables.ratings(spark, d), tables.movies(spark, d), MIN_COUNT))

register("best_movie", with_tables("movie_stats", "movies") + f"""
SELECT b.movie_id, CASE WHEN b.movie_id IS NOT NULL THEN coalesce(m.title, 'Unknown') END AS title,
       b.avg_rating, b.n
FROM (SELECT 1 AS one) o
LEFT JOIN (SELECT * FROM movie_stats WHERE n >= {MIN_COUNT}
           ORDER BY avg_rating DESC, movie_id LIMIT 1) b ON TRUE
LEFT JOIN movies m ON b.movie_id = m.movie_id
""")(lambda spark, d: plans.best_movie(tables.ratings(spark, d), tables.movies(spark, d), MIN_COUNT))

_GENRE_STATS = """
SELECT g.genre, {avg} AS avg_rating, count(g.rating) AS n
FROM (SELECT r.rating, trim(unnest(string_split(m.genres, '|'))) AS genre
      FROM ratings r JOIN movies m ON r.movie_id = m.movie_id) g
GROUP BY g.genre
"""

register("genre_rating", with_tables("ratings", "movies") + """
SELECT row_number() OVER (ORDER BY avg_rating DESC, genre) AS rank, genre, avg_rating, n
FROM (""" + _GENRE_STATS.format(avg="round_even(avg(g.rating), 4)") + ") s")(
    lambda spark, d: plans.genre_rating(tables.ratings(spark, d), tables.movies(spark, d)))

register("genre_rating_summary", with_tables("ratings", "movies")
         + _GENRE_STATS.format(avg="CAST(avg(g.rating) AS FLOAT)"))(
    lambda spark, d: plans.genre_rating(tables.ratings(spark, d), tables.movies(spark, d),
                                        places=None, as_float=True, ranked=False))

register("movie_gender_wide", with_tables("user_ratings", "users", "movies") + """
SELECT s.movie_id, coalesce(m.title, 'Unknown') AS title, s.male, s.female
FROM (SELECT r.movie_id,
             CAST(avg(CASE WHEN u.gender = 'M' THEN r.rating END) AS FLOAT) AS male,
             CAST(avg(CASE WHEN u.gender = 'F' THEN r.rating END) AS FLOAT) AS female
      FROM ratings r JOIN users u ON r.user_id = u.user_id GROUP BY r.movie_id) s
LEFT JOIN movies m ON s.movie_id = m.movie_id
""")(lambda spark, d: plans.movie_gender_wide(_user_ratings(spark, d), tables.users(spark, d),
                                              tables.movies(spark, d)))

_P6 = ("CASE WHEN u.age IS NULL THEN NULL WHEN u.age <= 18 THEN '0-18' WHEN u.age <= 35 THEN '18-35' "
       "WHEN u.age <= 50 THEN '35-50' ELSE '50+' END")


def _p7(age: str) -> str:
    return (f"CASE WHEN {age} IS NULL THEN NULL WHEN {age} < 18 THEN '1. Under 18' WHEN {age} < 25 THEN '2. 18-24' "
            f"WHEN {age} < 35 THEN '3. 25-34' WHEN {age} < 45 THEN '4. 35-44' "
            f"WHEN {age} < 55 THEN '5. 45-54' ELSE '6. 55+' END")

register("movie_age_wide", with_tables("user_ratings", "users", "movies") + f"""
SELECT s.movie_id, coalesce(m.title, 'Unknown') AS title, s.avg_0_18, s.avg_18_35, s.avg_35_50, s.avg_50_plus
FROM (SELECT movie_id,
             CAST(avg(CASE WHEN grp = '0-18' THEN rating END) AS FLOAT) AS avg_0_18,
             CAST(avg(CASE WHEN grp = '18-35' THEN rating END) AS FLOAT) AS avg_18_35,
             CAST(avg(CASE WHEN grp = '35-50' THEN rating END) AS FLOAT) AS avg_35_50,
             CAST(avg(CASE WHEN grp = '50+' THEN rating END) AS FLOAT) AS avg_50_plus
      FROM (SELECT r.movie_id, r.rating, {_P6} AS grp FROM ratings r JOIN users u ON r.user_id = u.user_id) x
      GROUP BY movie_id) s
LEFT JOIN movies m ON s.movie_id = m.movie_id
""")(lambda spark, d: plans.movie_age_wide(_user_ratings(spark, d), tables.users(spark, d),
                                           tables.movies(spark, d)))


def _long_sql(category: str, grp_expr: str, values: list[str]) -> str:
    vals = ", ".join(f"('{v}', {i + 1})" for i, v in enumerate(values))
    return with_tables("user_ratings", "users", "movies") + f"""
, r AS (SELECT r.movie_id, r.rating, coalesce({grp_expr}, 'Unknown') AS {category}
        FROM ratings r LEFT JOIN users u ON r.user_id = u.user_id),
s AS (SELECT movie_id, {category}, round_even(avg(rating), 4) AS avg_rating, count(rating) AS n
      FROM r GROUP BY movie_id, {category}),
mv AS (SELECT DISTINCT movie_id FROM ratings),
cats AS (SELECT * FROM (VALUES {vals}) AS t({category}, category_order))
SELECT mv.movie_id, coalesce(m.title, 'Unknown') AS title, c.{category}, c.category_order, s.avg_rating,
       CASE WHEN coalesce(s.n, 0) > 0 THEN printf('%.4f', s.avg_rating) ELSE 'NaN' END AS avg_text,
       coalesce(s.n, 0) AS n
FROM mv CROSS JOIN cats c
LEFT JOIN s ON s.movie_id = mv.movie_id AND s.{category} = c.{category}
LEFT JOIN movies m ON m.movie_id = mv.movie_id
"""


register("movie_gender_long", _long_sql("gender", "u.gender", ["F", "M"]))(
    lambda spark, d: plans.movie_gender_long(_user_ratings(spark, d), tables.users(spark, d),
                                             tables.movies(spark, d)))

register("movie_age_long", _long_sql("age_group", _p7("u.age"),
                                     ["1. Under 18", "2. 18-24", "3. 25-34", "4. 35-44", "5. 45-54", "6. 55+"]))(
    lambda spark, d: plans.movie_age_long(_user_ratings(spark, d), tables.users(spark, d),
                                          tables.movies(spark, d)))

register("occupation_rating", with_tables("user_ratings", "users", "occupation") + """
SELECT row_number() OVER (ORDER BY avg_rating DESC, occupation) AS rank, occupation, avg_rating, n
FROM (SELECT coalesce(o.name, 'unknown') AS occupation, round_even(avg(r.rating), 4) AS avg_rating,
             count(r.rating) AS n
      FROM ratings r LEFT JOIN users u ON r.user_id = u.user_id
      LEFT JOIN occupation o ON u.occupation_id = o.occupation_id
      GROUP BY 1) s
""")(lambda spark, d: plans.occupation_rating(_user_ratings(spark, d), tables.users(spark, d),
                                              tables.occupation(spark, d)))

register("yearly_rating", with_tables("ratings") + """
SELECT CAST(year(ts) AS INTEGER) AS year, round_even(avg(rating), 4) AS avg_rating, count(rating) AS n
FROM ratings GROUP BY 1
""")(lambda spark, d: plans.yearly_rating(tables.ratings(spark, d)))

# --------------------------------------------------------------------------- reviews

register("review_tokens", with_tables("tokens") + "SELECT word, topic, aspect, sentiment FROM tokens")(
    lambda spark, d: _tokens(spark, d, sentiment=True))

register("word_freq_over", with_tables("tokens") + f"""
SELECT word, count(word) AS freq FROM tokens GROUP BY word HAVING count(word) > {WORD_THRESHOLD}
""")(lambda spark, d: plans.word_freq_over(_tokens(spark, d), WORD_THRESHOLD))

register("topic_counts", with_tables("reviews") + "SELECT topic, count(id) AS n_reviews FROM reviews GROUP BY topic")(
    lambda spark, d: plans.topic_counts(tables.reviews(spark, d)))

register("aspect_counts", with_tables("reviews") + "SELECT aspect, count(id) AS n_reviews FROM reviews GROUP BY aspect")(
    lambda spark, d: plans.aspect_counts(tables.reviews(spark, d)))


def _top_aspect_sql(sentiment: str) -> str:
    return with_tables("reviews") + f"""
, c AS (SELECT aspect, count(id) AS n_reviews FROM reviews WHERE sentiment = '{sentiment}' GROUP BY aspect)
SELECT aspect, n_reviews FROM c WHERE n_reviews = (SELECT max(n_reviews) FROM c)
"""


register("top_negative_aspect", _top_aspect_sql("negative"))(
    lambda spark, d: plans.top_aspect(tables.reviews(spark, d, sentiment=True), "negative"))
register("top_positive_aspect", _top_aspect_sql("positive"))(
    lambda spark, d: plans.top_aspect(tables.reviews(spark, d, sentiment=True), "positive"))


def _top_words_sql(sentiment: str) -> str:
    return with_tables("tokens") + f"""
SELECT topic, word, freq FROM (
  SELECT topic, word, freq, row_number() OVER (PARTITION BY topic ORDER BY freq DESC, word) AS rn
  FROM (SELECT topic, word, count(word) AS freq FROM tokens WHERE sentiment = '{sentiment}'
        GROUP BY topic, word) c) x
WHERE rn <= {TOP_K}
"""


register("topic_top_words_positive", _top_words_sql("positive"))(
    lambda spark, d: plans.topic_top_words(_tokens(spark, d, sentiment=True), "positive", TOP_K))
register("topic_top_words_negative", _top_words_sql("negative"))(
    lambda spark, d: plans.topic_top_words(_tokens(spark, d, sentiment=True), "negative", TOP_K))

register("tfidf_scores", with_tables("tfidf") + "SELECT topic, word, tf, df, score FROM tfidf")(
    lambda spark, d: plans.tfidf_scores(_tokens(spark, d)))

register("topic_top_tfidf", with_tables("tfidf") + f"""
SELECT topic, word, score FROM (
  SELECT topic, word, score, row_number() OVER (PARTITION BY topic ORDER BY score DESC, word) AS rn FROM tfidf) x
WHERE rn <= {TOP_K}
""")(lambda spark, d: plans.topic_top_tfidf(_tokens(spark, d), TOP_K))

register("term_frequency", with_tables("tf") + "SELECT topic, word, tf FROM tf")(
    lambda spark, d: term_frequency(_tokens(spark, d)))

register("document_frequency", with_tables("dfreq") + "SELECT word, df FROM dfreq")(
    lambda spark, d: document_frequency(term_frequency(_tokens(spark, d))))

register("topic_cardinality", with_tables("tf") + "SELECT count(DISTINCT topic) AS n_groups FROM tf")(
    lambda spark, d: group_cardinality(term_frequency(_tokens(spark, d))))

register("distinct_pairs", with_tables("tokens") + "SELECT DISTINCT word, topic FROM tokens")(
    lambda spark, d: distinct_pairs(_tokens(spark, d)))


def _cross_scalar(spark, d):
    tf = materialize(term_frequency(_tokens(spark, d)))
    return tf.withColumn("n_groups", group_count(tf))


register("cross_scalar", with_tables("tf") + """
SELECT topic, word, tf, (SELECT count(DISTINCT topic) FROM tf) AS n_groups FROM tf
""")(_cross_scalar)

register("anti_join_wordlist", with_tables("raw_words", "stopwords") + """
SELECT w.id, w.word FROM raw_words w WHERE NOT EXISTS (SELECT 1 FROM stopwords s WHERE s.word = w.word)
""")(lambda spark, d: remove_stopwords(
    tables.reviews(spark, d).select("id", F.explode(tokenize("review")).alias("word")),
    tables.stopwords(spark)))

register("normalize_text", with_tables("reviews") + r"""
SELECT id, regexp_replace(lower(review), '[^a-zA-ZÀ-ỹ\s]', ' ', 'g') AS clean FROM reviews
""")(lambda spark, d: tables.reviews(spark, d).select("id", normalize_text("review").alias("clean")))

register("filter_sentiment", with_tables("reviews") + """
SELECT id, topic, aspect FROM reviews WHERE sentiment = 'negative'
""")(lambda spark, d: tables.reviews(spark, d, sentiment=True).where(F.col("sentiment") == "negative")
     .select("id", "topic", "aspect"))


def _tokens_roundtrip(spark, d):
    lines = render_tsv(_tokens(spark, d, sentiment=True), ["word", "topic", "aspect", "sentiment"])
    return parse_lines(lines, schemas.TOKENS, TOKEN_OPTIONS)


register("tokens_roundtrip", with_tables("tokens") + "SELECT word, topic, aspect, sentiment FROM tokens")(
    _tokens_roundtrip)

# --------------------------------------------------------------------------- per-operator keys

# S1 unions two rating inputs: here the two line-status halves of one table, read in one scan
# (files of several paths: ``scan_input_files``)
register("scan_union_inputs", """
SELECT o.o_custkey AS user_id, l.l_partkey AS movie_id, l.l_quantity AS rating, l.l_shipdate AS ts
FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey WHERE l.l_linestatus = 'F'
UNION ALL
SELECT o.o_custkey, l.l_partkey, l.l_quantity, l.l_shipdate
FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey WHERE l.l_linestatus IS DISTINCT FROM 'F'
""")(lambda spark, d: tables.rating_inputs(spark, d).drop("input"))


def _lines(spark, d, table, *fields, sep):
    """One text line per row of ``table``; a NULL field is empty."""
    parts = [F.coalesce(f.cast("string"), F.lit("")) for f in fields]
    return spark.read.parquet(f"{d}/{table}.parquet").select(F.concat_ws(sep, *parts).alias("line"))


def _rating_lines(spark, d, where="true"):
    # the lines of every seventh order are cut short after three fields
    li = spark.read.parquet(f"{d}/lineitem.parquet").where(where)
    epoch = F.unix_seconds(F.col("l_shipdate").cast("timestamp")).cast("string")
    head = F.concat_ws(", ", F.col("l_orderkey").cast("string"), F.col("l_partkey").cast("string"),
                       F.coalesce(F.col("l_quantity").cast("string"), F.lit("")))
    return li.select(F.when(F.col("l_orderkey") % 7 == 0, head).otherwise(F.concat_ws(",", head, epoch)).alias("line"))


_RATING_LINES_SQL = """
SELECT l_orderkey AS user_id, l_partkey AS movie_id, l_quantity AS rating,
       CASE WHEN l_orderkey % 7 <> 0 THEN CAST(epoch(l_shipdate) AS BIGINT) END AS ts
FROM lineitem
"""

# the file readers' options on lines made of the tables: ratings with short lines, dimensions, reviews, words, tokens
register("scan_rating_lines", _RATING_LINES_SQL)(
    lambda spark, d: parse_lines(_rating_lines(spark, d), schemas.RATINGS, csv_options(",")))

# an empty number is a bad number for the strict reader, so lines without a rating are not made
register("scan_rating_lines_strict",
         "SELECT * FROM (" + _RATING_LINES_SQL + ") x WHERE ts IS NOT NULL AND rating IS NOT NULL")(
    lambda spark, d: parse_ratings(_rating_lines(spark, d, "l_quantity is not null")))

register("yearly_rating_epoch", "SELECT CAST(year(make_timestamp(ts * 1000000)) AS INTEGER) AS year, "
         "round_even(avg(rating), 4) AS avg_rating, count(rating) AS n FROM (" + _RATING_LINES_SQL + ") x "
         "WHERE ts IS NOT NULL GROUP BY 1")(
    lambda spark, d: plans.yearly_rating(filter_required_fields(
        parse_lines(_rating_lines(spark, d), schemas.RATINGS, csv_options(",")), ["ts"])))

register("scan_dimension_lines", """
SELECT c_custkey AS user_id, nullif(trim(c_mktsegment), '') AS gender, CAST(c_custkey % 80 AS INTEGER) AS age,
       CAST(c_nationkey AS INTEGER) AS occupation_id, CAST(c_custkey AS VARCHAR) AS zip
FROM customer
""")(lambda spark, d: parse_lines(
    _lines(spark, d, "customer", F.col("c_custkey"), F.col("c_mktsegment"), F.col("c_custkey") % 80,
           F.col("c_nationkey"), F.col("c_custkey"), sep=", "), schemas.USERS, csv_options(",")))

register("scan_movie_lines", """
SELECT p_partkey AS movie_id, trim(p_name || ', ' || p_type) AS title, trim(p_type) AS genres
FROM part WHERE p_name IS NOT NULL
""")(lambda spark, d: parse_movies(
    _lines(spark, d, "part", F.col("p_partkey"), F.concat("p_name", F.lit(", "), "p_type"),
           F.concat(F.lit("\t"), "p_type"), sep=",").where(~F.col("line").contains(",,"))))

register("scan_review_lines", """
SELECT CAST(doc_id AS VARCHAR) AS id, nullif(regexp_replace(text, '[;\\s]+', ' ', 'g'), '') AS review,
       nullif(lang, '') AS topic, nullif(source, '') AS aspect, CAST(NULL AS VARCHAR) AS sentiment
FROM documents WHERE doc_id IS NOT NULL
""")(lambda spark, d: parse_lines(
    _lines(spark, d, "documents", F.col("doc_id"), F.regexp_replace("text", r"[;\s]+", " "), F.col("lang"),
           F.col("source"), F.lit(None), sep=";").where(~F.col("line").startswith(";")),
    schemas.REVIEWS, REVIEW_OPTIONS))

register("scan_word_lines", """
SELECT trim(p_type) AS word FROM part WHERE trim(p_type) <> ''
""")(lambda spark, d: parse_words(
    _lines(spark, d, "part", F.concat(F.lit("\t "), "p_type", F.lit(" ")), sep="").unionByName(
        spark.range(3).select(F.lit("  ").alias("line")))))

_LINE_SCHEMA = T.StructType([T.StructField("order_key", T.LongType()), T.StructField("part_key", T.LongType()),
                             T.StructField("quantity", T.DoubleType())])


def _raw_lines(spark, d):
    li = spark.read.parquet(f"{d}/lineitem.parquet")
    part = F.when(F.col("l_linenumber") == 7, F.lit("x")).otherwise(F.col("l_partkey").cast("string"))
    return li.select(F.concat_ws(", ", F.col("l_orderkey").cast("string"), part,
                                 F.col("l_quantity").cast("string")).alias("line"))


_PARSE_SQL = """
SELECT TRY_CAST(trim(split_part(line, ',', 1)) AS BIGINT) AS order_key,
       TRY_CAST(trim(split_part(line, ',', 2)) AS BIGINT) AS part_key,
       TRY_CAST(trim(split_part(line, ',', 3)) AS DOUBLE) AS quantity
FROM (SELECT concat_ws(', ', CAST(l_orderkey AS VARCHAR),
                       CASE WHEN l_linenumber = 7 THEN 'x' ELSE CAST(l_partkey AS VARCHAR) END,
                       CAST(l_quantity AS VARCHAR)) AS line FROM lineitem) t
"""

register("parse_typed_fields", _PARSE_SQL)(
    lambda spark, d: _raw_lines(spark, d).select(*parse_delimited("line", ",", _LINE_SCHEMA)))

register("filter_required_fields", "SELECT * FROM (" + _PARSE_SQL + ") p WHERE order_key IS NOT NULL "
         "AND part_key IS NOT NULL AND quantity IS NOT NULL")(
    lambda spark, d: filter_required_fields(_raw_lines(spark, d).select(*parse_delimited("line", ",", _LINE_SCHEMA)),
                                            ["order_key", "part_key", "quantity"]))

register("bucket_age_inclusive", with_tables("users") + f"""
SELECT u.user_id, u.age, {_P6} AS age_group FROM users u
""")(lambda spark, d: tables.users(spark, d).select("user_id", "age", age_group_inclusive("age").alias("age_group")))

register("bucket_age_half_open", with_tables("users") + f"""
SELECT user_id, age, {_p7("age")} AS age_group FROM users
""")(lambda spark, d: tables.users(spark, d).select("user_id", "age", age_group_half_open("age").alias("age_group")))

register("lookup_default", with_tables("users", "occupation") + """
SELECT u.user_id, u.occupation_id, coalesce(o.name, 'unknown') AS occupation
FROM users u LEFT JOIN occupation o ON u.occupation_id = o.occupation_id
""")(lambda spark, d: lookup(tables.users(spark, d).select("user_id", "occupation_id"),
                             tables.occupation(spark, d).withColumnRenamed("name", "occupation"),
                             "occupation_id", "default", {"occupation": "unknown"})
     .select("user_id", "occupation_id", "occupation"))

register("lookup_inner", with_tables("users", "occupation") + """
SELECT u.user_id, u.occupation_id, o.name AS occupation
FROM users u JOIN occupation o ON u.occupation_id = o.occupation_id
""")(lambda spark, d: lookup(tables.users(spark, d).select("user_id", "occupation_id"),
                             tables.occupation(spark, d).withColumnRenamed("name", "occupation"),
                             "occupation_id", "drop")
     .select("user_id", "occupation_id", "occupation"))

register("snowflake_lookup", with_tables("user_ratings", "users", "occupation") + """
SELECT r.user_id, r.movie_id, r.rating, coalesce(o.name, 'unknown') AS name
FROM ratings r LEFT JOIN users u ON r.user_id = u.user_id
LEFT JOIN occupation o ON u.occupation_id = o.occupation_id
""")(lambda spark, d: snowflake_lookup(_user_ratings(spark, d).select("user_id", "movie_id", "rating"),
                                       tables.users(spark, d), "user_id", tables.occupation(spark, d),
                                       "occupation_id", "name", "unknown")
     .select("user_id", "movie_id", "rating", "name"))

register("dedupe_dimension", """
SELECT c_nationkey, c_custkey, c_name, c_mktsegment FROM (
  SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey DESC) AS rn FROM customer) x
WHERE rn = 1
""")(lambda spark, d: dedupe_dimension(
    spark.read.parquet(f"{d}/customer.parquet").select("c_nationkey", "c_custkey", "c_name", "c_mktsegment"),
    "c_nationkey", "c_custkey").select("c_nationkey", "c_custkey", "c_name", "c_mktsegment"))

register("genre_explode", with_tables("movies") + """
SELECT movie_id, trim(unnest(string_split(genres, '|'))) AS genre FROM movies
""")(lambda spark, d: explode_list(tables.movies(spark, d).select("movie_id", "genres"), "genres", "genre"))

register("round_half_even", with_tables("ratings") + """
SELECT movie_id, avg(rating) AS avg_raw, round_even(avg(rating), 4) AS avg_rating FROM ratings GROUP BY movie_id
""")(lambda spark, d: tables.ratings(spark, d).groupBy("movie_id").agg(
    F.avg("rating").alias("avg_raw"), round_half_even(F.avg("rating"), 4).alias("avg_rating")))

register("sort_desc_tiebreak", with_tables("ratings") + """
SELECT movie_id, sum(rating) AS total FROM ratings GROUP BY movie_id ORDER BY total DESC, movie_id
""")(lambda spark, d: sort_desc_tiebreak(
    tables.ratings(spark, d).groupBy("movie_id").agg(F.sum("rating").alias("total")), "total", "movie_id"))

register("render_key_value", with_tables("ratings", "movies") + """
SELECT s.movie_id, coalesce(m.title, 'Unknown') || chr(9) || 'Average rating: ' || CAST(s.avg_rating AS VARCHAR)
       || ' (Total ratings: ' || CAST(s.n AS VARCHAR) || ')' AS line
FROM (SELECT movie_id, CAST(avg(rating) AS FLOAT) AS avg_rating, count(rating) AS n
      FROM ratings GROUP BY movie_id) s
LEFT JOIN movies m ON s.movie_id = m.movie_id
""")(lambda spark, d: render_key_value(
    plans.movie_rating_summary(tables.ratings(spark, d), tables.movies(spark, d)), "title",
    F.concat(F.lit("Average rating: "), F.col("avg_rating").cast("string"), F.lit(" (Total ratings: "),
             F.col("n").cast("string"), F.lit(")")), keep=["movie_id"]))

register("render_delimited", with_tables("movie_stats", "movies") + """
SELECT s.movie_id, concat_ws('::', coalesce(m.title, 'Unknown'), CAST(s.movie_id AS VARCHAR),
                              CAST(s.avg_rating AS VARCHAR), CAST(s.n AS VARCHAR)) AS line
FROM movie_stats s LEFT JOIN movies m ON s.movie_id = m.movie_id
""")(lambda spark, d: render_delimited(
    lookup(rating_stats(tables.ratings(spark, d), ["movie_id"]), tables.movies(spark, d).select("movie_id", "title"),
           "movie_id", "default", {"title": "Unknown"}),
    ["title", "movie_id", "avg_rating", "n"], "::", keep=["movie_id"]))

def _pad(fn: str, expr: str, width: int) -> str:
    """Non-truncating SQL padding (like the Spark side): at least ``width`` characters."""
    return f"{fn}({expr}, CAST(greatest(length({expr}), {width}) AS INTEGER), ' ')"


register("render_report_lines", with_tables("movie_stats", "movies") + f"""
SELECT rank, {_pad("rpad", "CAST(rank AS VARCHAR)", 5)} || ' ' || {_pad("rpad", "title", 50)}
       || ' ' || {_pad("lpad", "printf('%.4f', avg_rating)", 7)} || ' ' || {_pad("lpad", "CAST(n AS VARCHAR)", 7)} AS line
FROM (SELECT row_number() OVER (ORDER BY s.avg_rating DESC, s.movie_id) AS rank,
             coalesce(m.title, 'Unknown') AS title, s.avg_rating, s.n
      FROM movie_stats s LEFT JOIN movies m ON s.movie_id = m.movie_id WHERE s.n >= {MIN_COUNT}) x
""")(lambda spark, d: render_report_lines(
    plans.movie_rating_ranked(tables.ratings(spark, d), tables.movies(spark, d), MIN_COUNT),
    [("rank", 5, "<"), ("title", 50, "<"), (fixed("avg_rating", 4), 7, ">"), ("n", 7, ">")], keep=["rank"]))


def _wide_lines_sql(select_wide: str, value_sql: str) -> str:
    return select_wide + f"""
SELECT movie_id, title || chr(9) || {value_sql} AS line FROM wide
"""


_GENDER_WIDE_CTE = with_tables("user_ratings", "users", "movies") + """, wide AS (
SELECT s.movie_id, coalesce(m.title, 'Unknown') AS title, s.male, s.female
FROM (SELECT r.movie_id,
             CAST(avg(CASE WHEN u.gender = 'M' THEN r.rating END) AS FLOAT) AS male,
             CAST(avg(CASE WHEN u.gender = 'F' THEN r.rating END) AS FLOAT) AS female
      FROM ratings r JOIN users u ON r.user_id = u.user_id GROUP BY r.movie_id) s
LEFT JOIN movies m ON s.movie_id = m.movie_id)"""

register("render_placeholder", _wide_lines_sql(
    _GENDER_WIDE_CTE,
    "'Male: ' || coalesce(CAST(male AS VARCHAR), 'N/A') || ', Female: ' || coalesce(CAST(female AS VARCHAR), 'N/A')"))(
    lambda spark, d: render_key_value(
        plans.movie_gender_wide(_user_ratings(spark, d), tables.users(spark, d), tables.movies(spark, d)),
        "title", F.concat(F.lit("Male: "), with_placeholder("male", "N/A"),
                          F.lit(", Female: "), with_placeholder("female", "N/A")), keep=["movie_id"]))

_AGE_WIDE_CTE = with_tables("user_ratings", "users", "movies") + f""", wide AS (
SELECT s.movie_id, coalesce(m.title, 'Unknown') AS title, s.a0, s.a1, s.a2, s.a3
FROM (SELECT movie_id,
             CAST(avg(CASE WHEN grp = '0-18' THEN rating END) AS FLOAT) AS a0,
             CAST(avg(CASE WHEN grp = '18-35' THEN rating END) AS FLOAT) AS a1,
             CAST(avg(CASE WHEN grp = '35-50' THEN rating END) AS FLOAT) AS a2,
             CAST(avg(CASE WHEN grp = '50+' THEN rating END) AS FLOAT) AS a3
      FROM (SELECT r.movie_id, r.rating, {_P6} AS grp FROM ratings r JOIN users u ON r.user_id = u.user_id) x
      GROUP BY movie_id) s
LEFT JOIN movies m ON s.movie_id = m.movie_id)"""


def _age_wide_lines(spark, d):
    wide = plans.movie_age_wide(_user_ratings(spark, d), tables.users(spark, d), tables.movies(spark, d))
    parts = []
    for label, col in zip(["0-18", "18-35", "35-50", "50+"], ["avg_0_18", "avg_18_35", "avg_35_50", "avg_50_plus"]):
        parts.append(F.concat(F.lit(label + ": "), with_placeholder(col, "NA")))
    return render_key_value(wide, "title", F.concat_ws("\t", *parts), keep=["movie_id"])


register("render_placeholder_age", _wide_lines_sql(
    _AGE_WIDE_CTE,
    "'0-18: ' || coalesce(CAST(a0 AS VARCHAR), 'NA') || chr(9) || '18-35: ' || coalesce(CAST(a1 AS VARCHAR), 'NA')"
    " || chr(9) || '35-50: ' || coalesce(CAST(a2 AS VARCHAR), 'NA') || chr(9) || '50+: '"
    " || coalesce(CAST(a3 AS VARCHAR), 'NA')"))(_age_wide_lines)

register("render_csv_lines", with_tables("user_ratings", "users", "movies") + """
, r AS (SELECT r.movie_id, r.rating, coalesce(u.gender, 'Unknown') AS gender
        FROM ratings r LEFT JOIN users u ON r.user_id = u.user_id),
s AS (SELECT movie_id, gender, round_even(avg(rating), 4) AS avg_rating, count(rating) AS n FROM r GROUP BY ALL),
mv AS (SELECT DISTINCT movie_id FROM ratings),
cats AS (SELECT * FROM (VALUES ('F'), ('M')) AS t(gender)),
long AS (
  SELECT mv.movie_id, coalesce(m.title, 'Unknown') AS title, c.gender,
         CASE WHEN coalesce(s.n, 0) > 0 THEN CAST(s.avg_rating AS VARCHAR) ELSE 'NaN' END AS avg_out,
         coalesce(s.n, 0) AS n
  FROM mv CROSS JOIN cats c
  LEFT JOIN s ON s.movie_id = mv.movie_id AND s.gender = c.gender
  LEFT JOIN movies m ON m.movie_id = mv.movie_id)
SELECT movie_id, gender, concat_ws(',', CAST(movie_id AS VARCHAR), title, gender, avg_out, CAST(n AS VARCHAR)) AS line
FROM long
""")(lambda spark, d: render_delimited(
    plans.movie_gender_long(_user_ratings(spark, d), tables.users(spark, d), tables.movies(spark, d)),
    ["movie_id", "title", "gender", with_placeholder("avg_rating", "NaN"), "n"], ",", keep=["movie_id", "gender"]))


register("render_genre_summary", with_tables("ratings", "movies") + """
SELECT genre, genre || chr(9) || 'Avg: ' || CAST(avg_rating AS VARCHAR) || ', Count: ' || CAST(n AS VARCHAR) AS line
FROM (""" + _GENRE_STATS.format(avg="CAST(avg(g.rating) AS FLOAT)") + ") s")(
    lambda spark, d: render_key_value(
        plans.genre_rating(tables.ratings(spark, d), tables.movies(spark, d), places=None, as_float=True, ranked=False),
        "genre", F.concat(F.lit("Avg: "), F.col("avg_rating").cast("string"), F.lit(", Count: "),
                          F.col("n").cast("string")), keep=["genre"]))

_BEST_RAW = f"""
FROM (SELECT 1 AS one) o
LEFT JOIN (SELECT * FROM raw_stats WHERE n >= {MIN_COUNT} ORDER BY avg_rating DESC, movie_id LIMIT 1) b ON TRUE
LEFT JOIN movies m ON b.movie_id = m.movie_id
"""


def _best_raw(spark, d):
    return plans.best_movie(tables.ratings(spark, d), tables.movies(spark, d), MIN_COUNT, places=None, as_float=True)


register("best_movie_raw", with_tables("raw_stats", "movies") + """
SELECT b.movie_id, CASE WHEN b.movie_id IS NOT NULL THEN coalesce(m.title, 'Unknown') END AS title,
       b.avg_rating, b.n""" + _BEST_RAW)(_best_raw)

register("render_best_movie", with_tables("raw_stats", "movies") + f"""
SELECT CASE WHEN b.movie_id IS NULL THEN 'No movies exist' || chr(9) || 'No movie with highest ratings'
            ELSE coalesce(m.title, 'Unknown') || chr(9) || 'is the highest rated movie with an average rating of '
                 || CAST(b.avg_rating AS VARCHAR) || ' among movies with at least {MIN_COUNT} ratings.' END AS line
""" + _BEST_RAW)(lambda spark, d: render_best_line(_best_raw(spark, d), MIN_COUNT))

register("render_best_block", with_tables("movie_stats", "movies") + f"""
, best AS (SELECT s.movie_id, coalesce(m.title, 'Unknown') AS title, s.avg_rating, s.n
           FROM movie_stats s LEFT JOIN movies m ON s.movie_id = m.movie_id
           WHERE s.n >= {MIN_COUNT} ORDER BY s.avg_rating DESC, s.movie_id LIMIT 1)
SELECT 1 AS line_no, '  Tên phim  : ' || title AS line FROM best
UNION ALL SELECT 2, '  MovieID   : ' || movie_id FROM best
UNION ALL SELECT 3, '  Avg Rating: ' || printf('%.4f', avg_rating) FROM best
UNION ALL SELECT 4, '  Số lượt   : ' || n FROM best
""")(lambda spark, d: render_best_block(
    plans.best_movie(tables.ratings(spark, d), tables.movies(spark, d), MIN_COUNT)))


def queries() -> dict[str, Query]:
    return {**QUERIES, **file_catalog.QUERIES}


def oracle_sql() -> dict[str, str]:
    return {**ORACLE, **file_catalog.ORACLE}
