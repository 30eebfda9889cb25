"""Spelling variants against brute force over all words, and the completeness of the signatures."""

import itertools
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from critiq.llm import spelling as S
from tests.conftest import SF_SMALL

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def _edit_one(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    p = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    return a[p + (len(a) >= len(b)):] == b[p + (len(b) >= len(a)):]


def _counts(docs):
    lower = str.maketrans(S.UPPER, S.LOWER)
    out = Counter()
    for doc, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(lower)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            out[run] += 1
    return {w: n for w, n in out.items() if len(w) >= 6 and n >= 5}


def _brute(counts):
    """Near words by taking out one letter of each: words one edit apart share what is left, or one is what is left."""
    left = {}
    for w in counts:
        for v in {w} | {w[:i] + w[i + 1:] for i in range(len(w))}:
            left.setdefault(v, set()).add(w)
    near = {w: {o for v in {w} | {w[:i] + w[i + 1:] for i in range(len(w))} for o in left[v] if _edit_one(w, o)}
            for w in counts}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-counts[o], o), default=None)
        if best and counts[best] >= 5 * counts[w]:
            form[w] = best
    rows = []
    for w, n in counts.items():
        root = w
        while root in form:
            root = form[root]
        rows.append((w, form.get(w), root, n, len(near[w]), counts[form[w]] if w in form else None))
    return sorted(rows)


def _rows(df):
    return sorted(map(tuple, df.select("word", "form", "root", "n", "n_near", "form_n").collect()))


def test_near_words_share_a_signature():
    rnd = random.Random(3)
    for alphabet in ("ab", "abcdefgh", "aéüÿxyz"):
        words = {"".join(rnd.choices(alphabet, k=rnd.randint(6, 9))) for _ in range(400)}
        words |= {w[:i] + rnd.choice(alphabet) + w[i + rnd.randint(0, 1):] for w in words for i in (0, 3, len(w) - 1)}
        words = sorted(w for w in words if len(w) >= 6)
        found = S.signatures(words)
        assert found.shape == (len(words), 20)
        for (i, a), (j, b) in itertools.combinations(enumerate(words), 2):
            if _edit_one(a, b):
                assert (found[i] == found[j]).any(), (a, b)


def test_signatures_do_not_depend_on_the_batch():
    words = ["banane", "ananas", "ÿÿÿÿÿÿ", "x" * 5000, "letters"]
    whole = S.signatures(words)
    assert all((S.signatures([w])[0] == row).all() for w, row in zip(words, whole))


@pytest.mark.parametrize("seed", [1, 2])
def test_variants_equal_brute_force_on_dense_words(spark, seed):
    rnd = random.Random(seed)
    counts = {"".join(rnd.choices("abé", k=rnd.randint(6, 8))): int(5 * 6 ** rnd.uniform(0, 4)) for _ in range(1500)}
    words = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(5)
    got = _rows(S.variants(words))
    assert got == _brute(counts)
    assert any(r[1] and r[2] != r[1] for r in got)              # chains of several forms


def test_query_on_edge_documents(spark, edge_docs):
    docs = [(r.doc_id, r.text) for r in edge_docs.select("doc_id", "text").collect()]
    assert _rows(S.variant_report(edge_docs)) == _brute(_counts(docs))


def test_deletions_and_case(spark):
    rows = [(i, "Éclairs éCLAIRS ×÷abcdef word word's o'clockwise " * 3 + f"{'y' * 30}", "fr", "a", 1) for i in range(400)]
    rows.append((None, "Éclairs " * 9, None, None, None))
    got = _rows(S.variant_report(spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(0) for c in ("word", "n", "sig")})))
    assert got == _brute(_counts([(r[0], r[1]) for r in rows]))
    assert {"Éclairs", "éclairs", "×÷abcdef", "clockwise"} <= {r[0] for r in got}


def test_no_documents(spark, no_docs):
    assert _rows(S.variant_report(no_docs)) == []


def test_query_on_the_test_tables(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    want = _brute(_counts([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]))
    got = _rows(S.variant_report(docs))
    assert got == want and len(got) > 500


def test_anagrams_in_one_group(spark):
    words = ["".join(p) for p in itertools.islice(itertools.permutations("abcdefgh"), 3000)]
    counts = dict.fromkeys(words, 7) | {w[:4] + "z" + w[5:]: 40 for w in words[::50]}
    got = _rows(S.variants(spark.createDataFrame(list(counts.items()), "word string, n long")))
    assert got == _brute(counts)
    assert np.unique(S.signatures(words)[:, 0]).size > 20
