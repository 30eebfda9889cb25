"""Registered queries of the training-data operators: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from critiq.llm import (
    bpe, chosen_path, conversations, fingerprints, line_dedup, packing, pivot_topk, quality, secret_scan, shards, spelling,
    suffix_dedup, warc,
)
from critiq.session import ship_package


TOKENIZER = "word_bpe_49k.json"


def _tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_minhash_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MinHash fingerprint of every document and of its edited text."""
    return fingerprints.fingerprint_edits(_table(spark, sf_dir, "documents"))


def op2_quality_gam(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document by an additive model with pairwise interactions."""
    return quality.score_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op3_jump_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents into 16 shards by jump consistent hashing of doc_id."""
    return shards.shard_documents(_table(spark, sf_dir, "documents"), 16)


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document: base patterns and Markov log-likelihood ratios."""
    return secret_scan.scan_documents(_table(spark, sf_dir, "documents"))


def op5_suffix_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document that a 50-byte string of a smaller document covers."""
    found = suffix_dedup.remove_repeats(_table(spark, sf_dir, "documents"))
    return found.withColumnRenamed("kept", "kept_sha256")


def op6_chosen_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all documents: two-word shingles, similarity of 0.8 or more."""
    return chosen_path.near_groups(_table(spark, sf_dir, "documents"), size=2, like=80)


def op7_pivot_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five best inner products for every vector whose id is divisible by 50, against all others."""
    return pivot_topk.top_k(_table(spark, sf_dir, "embeddings"), 5, 50)


def op8_bpe_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids and decoded text of every document by the tokenization automaton."""
    return bpe.encode_documents(_table(spark, sf_dir, "documents"), _tokenizer_path())


def op9_fuzzy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of all documents that repeat an earlier line, exactly or nearly."""
    return line_dedup.dedup_report(_table(spark, sf_dir, "documents"))


def op10_best_two_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents tokenised, cut and packed into sequences of at most 2048 tokens."""
    return packing.pack_documents(_table(spark, sf_dir, "documents"), _tokenizer_path())


def op11_partenum_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spelling variants among the frequent words of all documents."""
    return spelling.variant_report(_table(spark, sf_dir, "documents"))


def op12_cyk_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Structure of all conversations after planted damage, repaired at the least cost."""
    return conversations.repair_report(_table(spark, sf_dir, "conversations"))


def op13_warc_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages as WARC records: monolithic gzip archives, normalised to a member per record, read back by index."""
    return warc.page_report(_table(spark, sf_dir, "pages"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_minhash_fingerprints": op1_minhash_fingerprints,
    "op2_quality_gam": op2_quality_gam,
    "op3_jump_shards": op3_jump_shards,
    "op4_secret_scan": op4_secret_scan,
    "op5_suffix_repeats": op5_suffix_repeats,
    "op6_chosen_path": op6_chosen_path,
    "op7_pivot_topk": op7_pivot_topk,
    "op8_bpe_automaton": op8_bpe_automaton,
    "op9_fuzzy_lines": op9_fuzzy_lines,
    "op10_best_two_fit": op10_best_two_fit,
    "op11_partenum_spelling": op11_partenum_spelling,
    "op12_cyk_repair": op12_cyk_repair,
    "op13_warc_members": op13_warc_members,
}

ORACLE_SQL: dict[str, str] = {
    "op7_pivot_topk": """
    WITH usable AS (
        SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
        FROM embeddings
        WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
          AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))),
    asked AS (SELECT vec_id, min(v) AS v FROM usable WHERE vec_id % 50 = 0 GROUP BY vec_id),
    scored AS (
        SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
        FROM asked q JOIN usable c ON c.vec_id <> q.vec_id),
    ranked AS (
        SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank,
               vec_id, score FROM scored)
    SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5""",
    # base32: eight groups of five hexadecimal digits (20 bits), four digits each
    "op13_warc_members": """
    WITH payloads AS (
        SELECT page_id, coalesce(html, '') AS html FROM pages),
    marked AS (
        SELECT page_id, octet_length(encode(html)) AS payload_bytes, sha1(html) AS hex,
               first_value(page_id) OVER w AS head, row_number() OVER w AS place
        FROM payloads WINDOW w AS (PARTITION BY html ORDER BY page_id NULLS LAST))
    SELECT page_id, payload_bytes::BIGINT AS payload_bytes,
           array_to_string(list_transform(range(32), lambda i:
               substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                      ((('0x' || substr(hex, 5 * (i // 4) + 1, 5))::BIGINT >> (15 - 5 * (i % 4))) & 31) + 1, 1)), '')
               AS payload_digest,
           CASE WHEN place = 1 THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN place > 1 THEN head END AS refers_to
    FROM marked""",
}
