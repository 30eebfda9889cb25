"""The logical tables of ``critiq.sources.tables`` as SQL common table expressions.

Used to build the DuckDB oracle queries of the registry; each oracle starts
with ``WITH`` and the CTEs it needs, over the pre-registered base views.
"""

from __future__ import annotations

from critiq.sources.tables import STOPWORDS

CTE = {
    "ratings": """ratings AS (
  SELECT l.l_partkey AS movie_id, l.l_quantity AS rating, l.l_shipdate AS ts FROM lineitem l)""",
    # the same table under the same name, with the user of each rating
    "user_ratings": """ratings AS (
  SELECT o.o_custkey AS user_id, l.l_partkey AS movie_id, l.l_quantity AS rating, l.l_shipdate AS ts
  FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey)""",
    "movies": """movies AS (
  SELECT p_partkey AS movie_id, p_name AS title, replace(p_name, ' ', '|') || '|' || p_type AS genres
  FROM part)""",
    "users": """users AS (
  SELECT c_custkey AS user_id,
         CASE c_mktsegment WHEN 'BUILDING' THEN 'M' WHEN 'MACHINERY' THEN 'F' ELSE c_mktsegment END AS gender,
         CAST(c_custkey % 80 AS INTEGER) AS age, c_nationkey AS occupation_id
  FROM customer)""",
    "occupation": """occupation AS (
  SELECT n_nationkey AS occupation_id, n_name AS name FROM nation WHERE n_regionkey <> 0)""",
    "reviews": """reviews AS (
  SELECT d.doc_id AS id, d.text AS review, d.lang AS topic, d.source AS aspect,
         CASE l.quality WHEN 1 THEN 'positive' WHEN 0 THEN 'negative' END AS sentiment
  FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id)""",
    "stopwords": "stopwords AS (SELECT * FROM (VALUES "
                 + ", ".join("('" + w.replace("'", "''") + "')" for w in STOPWORDS)
                 + ") AS t(word))",
    "raw_words": r"""raw_words AS (
  SELECT w.id, w.word, w.topic, w.aspect, w.sentiment FROM (
    SELECT id, unnest(regexp_split_to_array(regexp_replace(lower(review), '[^a-zA-ZÀ-ỹ\s]', ' ', 'g'),
                                            '[\s",()*]+')) AS word, topic, aspect, sentiment
    FROM reviews) w
  WHERE w.word <> '')""",
    "tokens": """tokens AS (
  SELECT w.word, w.topic, w.aspect, w.sentiment FROM raw_words w
  WHERE NOT EXISTS (SELECT 1 FROM stopwords s WHERE s.word = w.word))""",
    "tf": """tf AS (SELECT topic, word, count(word) AS tf FROM tokens GROUP BY topic, word)""",
    "dfreq": """dfreq AS (SELECT word, count(*) AS df FROM tf GROUP BY word)""",
    "tfidf": """tfidf AS (
  SELECT tf.topic, tf.word, tf.tf, dfreq.df,
         round(tf.tf * ln(CAST((SELECT count(DISTINCT topic) FROM tf) AS DOUBLE) / dfreq.df), 6) AS score
  FROM tf JOIN dfreq ON tf.word = dfreq.word)""",
    "raw_stats": """raw_stats AS (
  SELECT movie_id, CAST(avg(rating) AS FLOAT) AS avg_rating, count(rating) AS n FROM ratings GROUP BY movie_id)""",
    "movie_stats": """movie_stats AS (
  SELECT movie_id, round_even(avg(rating), 4) AS avg_rating, count(rating) AS n FROM ratings GROUP BY movie_id)""",
}

# CTEs each CTE depends on, so a query lists only what it reads directly.
_DEPS = {
    "raw_words": ["reviews"],
    "tokens": ["raw_words", "stopwords"],
    "tf": ["tokens"],
    "dfreq": ["tf"],
    "tfidf": ["tf", "dfreq"],
    "movie_stats": ["ratings"],
    "raw_stats": ["ratings"],
}


def with_tables(*names: str) -> str:
    """``WITH`` clause holding ``names`` and everything they depend on, in dependency order."""
    order: list[str] = []

    def visit(n: str) -> None:
        for d in _DEPS.get(n, []):
            visit(d)
        if n not in order:
            order.append(n)

    for n in names:
        visit(n)
    if not order:
        return ""
    return "WITH " + ",\n".join(CTE[n] for n in order) + "\n"
