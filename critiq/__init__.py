"""critiq: rating and review-text analytics as Spark DataFrame functions.

Every public function takes and returns ``pyspark.sql.DataFrame`` (or a
``Column``) and runs entirely on the cluster: no ``collect``, no RDD, no
row-at-a-time Python in library code.

Sub-packages:

* ``sources``   – delimited-text readers (S1–S7) and the logical tables
  derived from the parquet test tables.
* ``sinks``     – text renderings and writers (K1–K5).
* ``functions`` – Column-level helpers (bucketing, text cleaning,
  rounding, time, formatting).
* ``operators`` – DataFrame operators (lookups, rating statistics,
  densify, ranking, tokens, TF-IDF).
* ``plans``     – the composite analyses a user calls, and the query
  registry used by ``__spark_entry__``.
* ``streaming`` – incremental ingestion of the same text inputs.
"""

__version__ = "0.1.0"
