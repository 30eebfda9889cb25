"""Spelling variants: frequent words one edit apart, found by PartEnum signatures of their letter multisets.

A word's letters with their counts are a binary vector: one dimension per letter and occurrence (the second ``e`` is a
dimension of its own). An inserted or deleted letter changes one dimension, a replaced letter at most two. PartEnum deals
the dimensions into ``PARTS`` parts; two vectors at distance two or less agree in at least ``PARTS - 2`` of them, so
each choice of that many parts, with what the vector holds there, is a signature, and near words share at least one. Of two
near words of six or more letters also the first three or the last three letters agree (one edit leaves all but one letter in
a common start and end), so each signature is taken once with the start and once with the end. This only splits
the groups of words that are made of the same letters; no near pair is lost. Spark equi-joins the signatures and verifies
every candidate pair by its edit distance.

Counting is plain DataFrame code with map-side combined sums; only distinct frequent words are joined. Roots are found by
pointer doubling: a form is at least ``RATIO`` times as frequent as its word, so chains are short and cannot loop.

Defined cases: a NULL text has no words; a NULL document id reads as empty text in the deletion rule; repeated rows count
each; an empty table gives no words; other columns are ignored.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from critiq.session import materialize

PARTS = 5            # parts of the dimensions; signatures hold all but two of them
MIN_LETTERS = 6      # code points of a word
ENDS = 3             # code points at the start or end that near words share
MIN_COUNT = 5        # occurrences of a word
RATIO = 5            # a form is so many times as frequent as its word
# The letters of a run, and the deletion rule's modulus.
LETTERS = "[A-Za-zÀ-ÿ]"
DELETE_EVERY = 199
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def damaged_words(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """word: every run of at least ``MIN_LETTERS`` letters, ASCII lower-cased, with one code point deleted where the rule says.

    Shorter runs cannot yield a word and are not taken up; a deletion may leave a word that is too short.
    """
    runs = F.regexp_extract_all(F.col(text), F.lit(f"{LETTERS}{{{MIN_LETTERS},}}"), 0)
    lowered = docs.select(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("d"), F.explode(runs).alias("run"))
    lowered = lowered.select("d", F.translate("run", UPPER, LOWER).alias("run"))
    mark = F.crc32(F.concat(F.col("d"), F.lit(":"), F.col("run")).cast("binary"))
    place = (F.col("h") % F.char_length("run")).cast("int")
    shorter = F.concat(F.substring(F.col("run"), F.lit(1), place), F.substring(F.col("run"), place + 2, F.char_length("run")))
    return lowered.select("run", mark.alias("h")).select(
        F.when(F.col("h") % DELETE_EVERY == 0, shorter).otherwise(F.col("run")).alias("word"))


def frequent_words(found: DataFrame) -> DataFrame:
    """word, n of the words with enough letters and occurrences."""
    return (found.where(F.char_length("word") >= MIN_LETTERS).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") >= MIN_COUNT))


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit mix of every value."""
    x = x.astype(np.uint64)
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def signatures(words: list[str], parts: int = PARTS) -> np.ndarray:
    """One row of 64-bit signatures per word (of ``MIN_LETTERS`` code points or more): choices of parts times start and end.

    A signature is a hash; equal hashes of different signatures only add candidates, which are verified.
    """
    sizes = np.array([len(w) for w in words], np.int64)
    letters = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.uint64)
    owner = np.repeat(np.arange(len(words)), sizes)
    starts = np.cumsum(sizes) - sizes
    order = np.lexsort((letters, owner))
    new = np.ones(len(order), bool)
    new[1:] = (owner[order][1:] != owner[order][:-1]) | (letters[order][1:] != letters[order][:-1])
    firsts = np.flatnonzero(new)
    turn = np.arange(len(order)) - np.repeat(firsts, np.diff(np.append(firsts, len(order))))
    dimension = _mix((letters[order] << np.uint64(32)) + turn.astype(np.uint64) + np.uint64(1))
    held = np.zeros((len(words), parts), np.uint64)
    np.add.at(held, (owner[order], (dimension % np.uint64(parts)).astype(np.int64)), _mix(dimension + np.uint64(1)))
    held = _mix(held + np.arange(1, parts + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    sides = []
    for side, first in enumerate((starts, starts + sizes - ENDS)):
        end = np.full(len(words), side + 1, np.uint64)
        for i in range(ENDS):
            end = _mix(end * np.uint64(0x100000001B3) + letters[first + i])
        sides.append(end)
    found = []
    for number, chosen in enumerate(itertools.combinations(range(parts), parts - 2)):
        key = _mix(held[:, chosen].sum(axis=1, dtype=np.uint64) + np.uint64(number + 1))
        found += [_mix(key ^ side) for side in sides]
    return np.stack(found, axis=1).view(np.int64)


def near_pairs(words: DataFrame) -> DataFrame:
    """a, b, a_n, b_n: every pair of words (a < b, as in code-point order) exactly one edit apart, once."""
    def sign(batches):
        for batch in batches:
            if batch.num_rows:
                found = signatures(batch.column(0).to_pylist())
                take = pa.array(np.repeat(np.arange(batch.num_rows), found.shape[1]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found.ravel()), batch.column(0).take(take), batch.column(1).take(take)], ["sig", "word", "n"])

    signed = materialize(words.select("word", "n").mapInArrow(sign, "sig long, word string, n long"))
    a = signed.select("sig", F.col("word").alias("a"), F.col("n").alias("a_n"))
    b = signed.select("sig", F.col("word").alias("b"), F.col("n").alias("b_n"))
    close = F.abs(F.char_length("a") - F.char_length("b")) <= 1
    pairs = a.join(b, "sig").where((F.col("a") < F.col("b")) & close & (F.levenshtein("a", "b", 1) == 1))
    return pairs.select("a", "b", "a_n", "b_n").distinct()


def _follow(links: DataFrame) -> DataFrame:
    """word, root: the last word that the forms of every linked word lead to."""
    roots = materialize(links.select("word", F.col("form").alias("root")))
    while True:
        ahead = roots.select(F.col("word").alias("at"), F.col("root").alias("next"))
        step = materialize(roots.join(ahead, roots["root"] == ahead["at"], "left").select("word", "root", "next"))
        roots = step.select("word", F.coalesce("next", "root").alias("root"))
        if step.where(F.col("next").isNotNull()).isEmpty():
            return roots


def variants(words: DataFrame) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of ``words`` (word, n; one row each)."""
    pairs = materialize(near_pairs(words))
    near = pairs.select(F.col("a").alias("word"), F.col("b").alias("other"), F.col("b_n").alias("other_n")).unionByName(
        pairs.select(F.col("b").alias("word"), F.col("a").alias("other"), F.col("a_n").alias("other_n")))
    best = near.groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"),
        F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other").alias("other"))).alias("best"))

    def if_form(value: str) -> Column:
        return F.when(-F.col("best.less") >= RATIO * F.col("n"), F.expr(value))

    found = materialize(words.join(best, "word", "left").select(
        "word", if_form("best.other").alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        if_form("-best.less").alias("form_n")))
    roots = _follow(found.where(F.col("form").isNotNull()))
    return found.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def variant_report(docs: DataFrame) -> DataFrame:
    """Spelling variants among the frequent words of all documents, after the planted deletions."""
    return variants(materialize(frequent_words(damaged_words(docs))))
