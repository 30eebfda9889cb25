"""Corpus pipeline over ``documents``: quality, line dedup, near-dedup, secrets, packing.

Each stage takes (spark, docs, sf_dir) and works on every row its
predecessor kept; all but the last return the columns of ``documents``:

1. ``quality``: rows whose quality score stays below 0.3 go.
2. ``lines``: lines that repeat an earlier line, exactly or nearly, are cut
   from the texts (a text may end up empty; its row stays).
3. ``near_duplicates``: of every group linked by a similarity of 0.8 or more
   over five-word shingles the smallest doc_id stays.
4. ``secrets``: every secret span is replaced by a mask.
5. ``packing``: the texts are tokenised and packed into sequences of at most
   2048 tokens, one row per piece.

NULL texts stay NULL until packing, which takes them as empty texts.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from critiq.llm import chosen_path, line_dedup, packing, secret_scan
from critiq.llm import quality as quality_model
from critiq.session import materialize

TOKENIZER = "word_bpe_49k.json"


def _recount(docs: DataFrame) -> DataFrame:
    """``n_chars`` of the texts as they are now."""
    return docs.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars")))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_model.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _recount(line_dedup.drop_repeated_lines(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return chosen_path.keep_one(docs, size=5, like=80)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _recount(secret_scan.redact(docs))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # workers that keep an encoder would hold its memory while the stages of a next run need it
    return packing.pack_documents(docs, public_tokenizers.path(TOKENIZER), share=False)


STAGES = [
    ("quality", quality),
    ("lines", lines),
    ("near_duplicates", near_duplicates),
    ("secrets", secrets),
    ("packing", packed),
]

# scores, hashes and token ids are beyond SQL; the stages are tested against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; each result but the last is written once, as the next stage reads it several times."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
