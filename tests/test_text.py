"""Review-text analyses on hand-made fixtures, checked against plain-Python recomputation."""

import math
import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from critiq import plans
from critiq.functions import normalize_text
from critiq.operators import argmax_with_ties, review_tokens, top_k_per_group

REVIEWS = [
    ("1", "Phòng rất đẹp, sạch sẽ! 10/10", "ROOMS", "QUALITY", "positive"),
    ("2", "Giá cao quá... phòng nhỏ", "PRICES", "VALUE", "negative"),
    ("3", "", "ROOMS", "QUALITY", "negative"),
    ("4", "12345 !!!", "GENERAL", "SERVICE", "positive"),
    ("5", "Nhân viên và phòng tốt", None, "SERVICE", "positive"),
    (None, "phòng phòng đẹp", "ROOMS", "SERVICE", None),
    ("7", None, "PRICES", "VALUE", "negative"),
    ("8", "THE rooms, the (VIEW) *and* \"price\"", "GENERAL", "QUALITY", "positive"),
]
STOP = ["và", "the", "rất", "và", "bởi vì"]


def _py_tokens():
    out = []
    for _, text, topic, aspect, sent in REVIEWS:
        if text is None:
            continue
        clean = re.sub(r"[^a-zA-ZÀ-ỹ\s]", " ", text.lower())
        for w in re.split(r'[\s",()*]+', clean):
            if w and w not in STOP:
                out.append((w, topic, aspect, sent))
    return out


def _frames(spark):
    reviews = spark.createDataFrame(REVIEWS, "id string, review string, topic string, aspect string, sentiment string")
    stop = spark.createDataFrame([(w,) for w in STOP], "word string")
    return reviews, stop


def test_normalize_keeps_vietnamese_letters(spark):
    df = spark.createDataFrame([("Giá 100$ ĐẸP, ×Ω!",)], "t string")
    assert df.select(normalize_text("t")).collect()[0][0] == "giá      đẹp  ×ω "


def test_tokens_equal_brute_force(spark):
    reviews, stop = _frames(spark)
    got = Counter(tuple(r) for r in review_tokens(reviews, stop).collect())
    assert got == Counter(_py_tokens())
    assert all(w for w, *_ in got)          # no empty tokens (empty / digits-only reviews give none)


def test_word_freq_counts_and_order(spark):
    reviews, stop = _frames(spark)
    rows = plans.word_freq_over(review_tokens(reviews, stop), 1).collect()
    exp = Counter(t[0] for t in _py_tokens())
    assert [(r.word, r.freq) for r in rows] == sorted(((w, c) for w, c in exp.items() if c > 1),
                                                      key=lambda x: (-x[1], x[0]))


def test_topic_counts_skip_null_id_and_keep_null_topic(spark):
    reviews, _ = _frames(spark)
    got = {r.topic: r.n_reviews for r in plans.topic_counts(reviews).collect()}
    assert got == {"ROOMS": 2, "PRICES": 2, "GENERAL": 2, None: 1}


def test_top_aspect_keeps_ties(spark):
    reviews, _ = _frames(spark)
    neg = sorted(tuple(r) for r in plans.top_aspect(reviews, "negative").collect())
    assert neg == [("VALUE", 2)]
    pos = sorted(tuple(r) for r in plans.top_aspect(reviews, "positive").collect())
    assert pos == [("QUALITY", 2), ("SERVICE", 2)]


def test_top_k_per_group_tie_at_k_breaks_by_word(spark):
    rows = [("A", w, f) for w, f in [("e", 5), ("d", 4), ("c", 3), ("b", 3), ("a", 3), ("z", 9)]] + [("B", "q", 1)]
    df = spark.createDataFrame(rows, "topic string, word string, freq long")
    got = top_k_per_group(df, ["topic"], [F.col("freq").desc(), F.col("word").asc()], 4).collect()
    assert sorted((r.topic, r.word) for r in got) == [("A", "a"), ("A", "d"), ("A", "e"), ("A", "z"), ("B", "q")]


def test_tfidf_formula_brute_force(spark):
    reviews, stop = _frames(spark)
    toks = _py_tokens()
    tf = Counter((t[1], t[0]) for t in toks)
    dfreq = Counter(w for (_, w) in tf)
    n = len({t for (t, _) in tf if t is not None})        # NULL topic not counted in N ...
    got = {(r.topic, r.word): (r.tf, r.df, r.score)
           for r in plans.tfidf_scores(review_tokens(reviews, stop)).collect()}
    assert set(got) == set(tf)                              # ... but it is a group in TF and DF
    for key, c in tf.items():
        assert got[key][:2] == (c, dfreq[key[1]])
        assert got[key][2] == round(c * math.log(n / dfreq[key[1]]), 6)
    top = plans.topic_top_tfidf(review_tokens(reviews, stop), 2).collect()
    per = defaultdict(list)
    for (t, w), v in got.items():
        per[t].append((-v[2], w))
    exp = {(t, w) for t, items in per.items() for _, w in sorted(items)[:2]}
    assert {(r.topic, r.word) for r in top} == exp and len(top) == len(exp)


def test_topic_top_words_by_sentiment(spark):
    reviews, stop = _frames(spark)
    got = plans.topic_top_words(review_tokens(reviews, stop), "positive", 2).collect()
    per = defaultdict(Counter)
    for w, t, _, s in _py_tokens():
        if s == "positive":
            per[t][w] += 1
    exp = {(t, w, c) for t, cnt in per.items() for w, c in sorted(cnt.items(), key=lambda x: (-x[1], x[0]))[:2]}
    assert {(r.topic, r.word, r.freq) for r in got} == exp and len(got) == len(exp)


def test_argmax_with_ties_on_empty_input(spark):
    df = spark.createDataFrame([], "aspect string, n long")
    assert argmax_with_ties(df, "n").collect() == []


def test_one_pass_tokenizer_equals_clean_then_split(spark):
    import random

    from critiq.functions import split_tokens, tokenize

    alphabet = list("abcXYZ éÀỹỺ×÷ωЖ\t\n\x0b\f\r\"(),*.;:!?0129'-_") + [" ", " ", " ", "😀"]
    rnd = random.Random(7)
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 40))) for _ in range(400)]
    texts += ["", "   ", "12345", "ĐẸP,quá(ok)*yes\"no\"", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    two = {r.i: r.a for r in df.select("i", split_tokens(normalize_text("t")).alias("a")).collect()}
    one = {r.i: r.a for r in df.select("i", tokenize("t").alias("a")).collect()}
    assert two == one


def test_fast_cleaning_equals_the_negated_class(spark):
    import random

    from critiq.functions.text import KEEP_CLASS

    alphabet = list("abXYZ éÀỹỺ×÷ωЖ\t\n\x0b\f\r\"(),*.;0129'") + ["\u0085", " ", " ", "😀", "𝔸"]
    rnd = random.Random(11)
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 30))) for _ in range(300)] + [None, ""]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    slow = F.regexp_replace(F.lower("t"), KEEP_CLASS, " ")
    assert df.where(~normalize_text("t").eqNullSafe(slow)).count() == 0
