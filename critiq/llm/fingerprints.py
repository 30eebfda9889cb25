"""MinHash document fingerprints: universal hash permutations over word shingles, in numpy.

A text's shingles are its runs of five lower-case words (a shorter text is
one shingle). Each of ``PERMUTATIONS`` multiply-add-shift hashes (universal
over 32-bit values) keeps its minimum over all shingles; the fingerprint is
the row of these minima, 16 bits each, as hex. The share of equal places of
two fingerprints estimates the Jaccard similarity of their shingle sets.

``fingerprint_edits`` compares each document with an edited copy and with
its successor by id. The successor is met without a global window: part
bounds come from a range partitioning of the ids alone, each part of the id
order is sorted on its own, and the first document of the next part is sent
along as a guard, so the text is shuffled once.

``near_duplicates`` links documents: signature bands are joined in Spark and
every candidate is verified by the Jaccard similarity of its full shingle
sets. A band bucket links its members to its smallest id only, so a large
bucket costs one candidate per member.

Defined cases: NULL text is the empty text; a text without words has the
fingerprint of the empty set, like only itself (likeness 1 to another empty
one); NULL ids sort first and never succeed the last document; rows of one
id are ordered by text; a single document succeeds itself; an empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PERMUTATIONS = 128
SHINGLE = 5
BANDS = 16
LIKE = 0.8
EMPTY = np.uint32(0xFFFFFFFF)
_BLOCK = 1024
_WORDS_KEPT = 500_000


class _WordHashes(dict):
    """Word to 64-bit hash; emptied when full."""

    def __missing__(self, word: str) -> int:
        if len(self) >= _WORDS_KEPT:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


_hashes = _WordHashes()


def _coefficients(n: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20240117)
    return (rng.integers(0, 2 ** 64, (n, 1), dtype=np.uint64) | np.uint64(1),
            rng.integers(0, 2 ** 64, (n, 1), dtype=np.uint64))


_A, _B = _coefficients(PERMUTATIONS)
_POWERS = np.array([pow(0x9E3779B97F4A7C15, i, 2 ** 64) for i in range(SHINGLE)], dtype=np.uint64)


def shingle_hashes(words: list[str], size: int = SHINGLE) -> np.ndarray:
    """64-bit hashes of all runs of ``size`` words, in order; fewer words are one run, no words none."""
    if not words:
        return np.zeros(0, np.uint64)
    table = _hashes
    w = np.fromiter([table[x] for x in words], np.uint64, len(words))
    size = min(size, len(w))
    n = len(w) - size + 1
    out = w[:n] * _POWERS[0]
    for i in range(1, size):
        out = out + w[i:i + n] * _POWERS[i]
    out ^= out >> np.uint64(29)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    return out ^ (out >> np.uint64(32))


def minima(shingles: np.ndarray) -> np.ndarray:
    """Least value of every permutation over the shingles (32 bits each)."""
    low = np.full(PERMUTATIONS, EMPTY, np.uint32)
    x = shingles & np.uint64(0xFFFFFFFF)
    for at in range(0, len(x), _BLOCK):
        hashed = _A * x[at:at + _BLOCK]
        hashed += _B
        np.minimum(low, (hashed.min(axis=1) >> np.uint64(32)).astype(np.uint32), out=low)
    return low


def render(low: np.ndarray) -> str:
    return (low >> np.uint32(16)).astype(">u2").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    return float(np.mean((a >> np.uint32(16)) == (b >> np.uint32(16))))


def fingerprint(text: str | None) -> str:
    return render(minima(shingle_hashes((text or "").lower().split())))


def edited(text: str, following: str) -> str:
    """The last quarter of ``text`` replaced by as many characters of ``following``."""
    n = len(text) // 4
    return text[:len(text) - n] + following[:n]


def _both(text: str, following: str) -> tuple[np.ndarray, np.ndarray]:
    """Minima of a text and of its edited text; shingles before the cut are hashed once."""
    words = text.lower().split()
    shingles = shingle_hashes(words)
    cut = len(text) - len(text) // 4
    head = text[:cut]
    # words of the head that a blank ends stay the same in the edited text
    whole = head.lower().split()
    if head and not head[-1].isspace():
        whole = whole[:-1]
    shared = max(0, len(whole) - SHINGLE + 1) if whole == words[:len(whole)] else 0
    common = minima(shingles[:shared])
    own = np.minimum(common, minima(shingles[shared:]))
    rest = edited(text, following).lower().split()[shared:]
    # the shared run ends inside the text, so the rest still has whole shingles or is the whole text
    return own, np.minimum(common, minima(shingle_hashes(rest)) if len(rest) >= SHINGLE or not shared else EMPTY)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fingerprint per row (no shuffle)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprint(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints, pa.string())],
                                             names=["doc_id", "fingerprint"])

    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return narrow.mapInArrow(run, f"doc_id {narrow.schema['doc_id'].dataType.simpleString()}, fingerprint string")


def _least(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The least value of the partition's one column, if it has rows."""
    least = [pc.min(batch.column(0)) for batch in batches if batch.num_rows]
    if least:
        value = min(v.as_py() for v in least)
        yield pa.RecordBatch.from_arrays([pa.array([value], least[0].type)], names=["doc_id"])


def _in_parts(docs: DataFrame, parts: int) -> DataFrame:
    """doc_id, text, _part, _guard: parts of the id order, each with the start of the next one as guard rows."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    ids = docs.select("doc_id").where(F.col("doc_id").isNotNull()).repartitionByRange(parts, "doc_id")
    # one id per part: bounded by ``parts``
    bounds = sorted(r[0] for r in ids.mapInArrow(_least, f"doc_id {kind}").collect())

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            take, part, guard = [], [], []
            for i, v in enumerate(batch.column(0).to_pylist()):
                k = 0 if v is None else max(0, bisect_right(bounds, v) - 1)
                take.append(i), part.append(k), guard.append(False)
                if v is not None and bounds[bisect_left(bounds, v, 0, len(bounds) - 1)] == v:
                    take.append(i), part.append((k - 1) % len(bounds)), guard.append(True)
            rows = batch.take(pa.array(take, pa.int64()))
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(part, pa.int32()), pa.array(guard, pa.bool_())],
                                             names=["doc_id", "text", "_part", "_guard"])

    return docs.mapInArrow(deal, f"doc_id {kind}, text string, _part int, _guard boolean")


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by part, guard last: each row with its successor."""
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    last = None  # the row that waits for its successor: part, id, text
    waiting = None  # the finished row that waits for its successor's fingerprint, and its own
    out: list[tuple] = []

    def finish(following: str, at_end: bool) -> None:
        nonlocal waiting
        _, key, text = last
        own, other = _both(text, following)
        if waiting:
            out.append((*waiting[0], likeness(waiting[1], own)))
        changed = hashlib.sha256(edited(text, following).encode()).hexdigest()
        row = (key, len(text), changed, render(own), render(other), likeness(own, other))
        waiting = None if at_end else (row, own)
        if at_end:
            out.append((*row, likeness(own, minima(shingle_hashes(following.lower().split())))))

    def flush(kind: pa.DataType) -> pa.RecordBatch:
        columns = list(zip(*out)) if out else [[] for _ in names]
        out.clear()
        kinds = [kind, pa.int64(), *[pa.string()] * 3, pa.float64(), pa.float64()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    kind = None
    for batch in batches:
        kind = batch.schema.field(0).type
        for key, text, part, guard in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            text = text or ""
            if last is not None:
                if last[0] == part:
                    finish(text, guard)
                else:  # only ids that are all NULL leave a part without a guard
                    finish(last[2], True)
            last = None if guard else (part, key, text)
        yield flush(kind)
    if last is not None:
        finish(last[2], True)
        yield flush(kind)


def fingerprint_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      parts: int | None = None) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next per document.

    ``parts``: pieces of the id order (default: eight per shuffle partition, so that partitions come out even).
    """
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    dealt = _in_parts(narrow, parts or 8 * n).repartition(n, "_part")
    ordered = dealt.sortWithinPartitions("_part", "_guard", F.col("doc_id").asc_nulls_first(), "text")
    kind = narrow.schema["doc_id"].dataType.simpleString()
    return ordered.mapInArrow(_compare, f"doc_id {kind}, n_chars long, edited_sha256 string, fingerprint string, "
                                        "edited_fingerprint string, near_edited double, near_next double")


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        likes = []
        for a, b in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
            x, y = (np.unique(shingle_hashes((t or "").lower().split())) for t in (a, b))
            both = len(np.intersect1d(x, y, assume_unique=True))
            likes.append(both / (len(x) + len(y) - both) if len(x) + len(y) else 0.0)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(likes, pa.float64())],
                                         names=["doc_id", "like_id", "jaccard"])


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = LIKE,
                    bands: int = BANDS) -> DataFrame:
    """doc_id, like_id, jaccard: each document with smaller ids that share a band, verified on full shingle sets.

    A bucket's members are linked to its smallest id, so the result spans
    the near-duplicate groups without holding all their pairs. Rows without
    words or with a NULL id take no part.
    """
    width = PERMUTATIONS * 4 // bands
    prints = fingerprints(docs.where(F.col(id_col).isNotNull()), id_col, text_col)
    prints = prints.where(F.col("fingerprint") != F.lit("ffff" * PERMUTATIONS))
    keys = prints.select("doc_id", F.posexplode(F.transform(
        F.sequence(F.lit(0), F.lit(bands - 1)),
        lambda i: F.xxhash64(F.substring("fingerprint", i * width + 1, F.lit(width))))).alias("band", "key"))
    heads = keys.groupBy("band", "key").agg(F.min("doc_id").alias("like_id"), F.count(F.lit(1)).alias("n"))
    pairs = (keys.join(heads.where("n > 1"), ["band", "key"]).where(F.col("doc_id") > F.col("like_id"))
             .select("doc_id", "like_id").distinct())
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    paired = (pairs.join(texts, "doc_id")
              .join(texts.select(F.col("doc_id").alias("like_id"), F.col("text").alias("like_text")), "like_id")
              .select("doc_id", "like_id", "text", "like_text"))
    kind = texts.schema["doc_id"].dataType.simpleString()
    return (paired.mapInArrow(_verify, f"doc_id {kind}, like_id {kind}, jaccard double")
            .where(F.col("jaccard") >= least))
