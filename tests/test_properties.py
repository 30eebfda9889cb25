"""Property checks against plain-Python definitions (one Spark job per generated batch)."""

import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from critiq.functions import bucketize, tokenize
from critiq.sources import parse_delimited

SETTINGS = settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def _py_bucket(x, edges, labels, right_closed):
    if x is None:
        return None
    for e, label in zip(edges, labels):
        if (x <= e) if right_closed else (x < e):
            return label
    return labels[-1]


@SETTINGS
@given(ages=st.lists(st.one_of(st.none(), st.integers(-5, 120)), min_size=1, max_size=60),
       edges=st.lists(st.integers(0, 100), min_size=1, max_size=6, unique=True).map(sorted),
       right_closed=st.booleans())
def test_bucketize_matches_rule(spark, ages, edges, right_closed):
    labels = [f"g{i}" for i in range(len(edges) + 1)]
    df = spark.createDataFrame([(i, a) for i, a in enumerate(ages)], "i int, a int")
    got = {r.i: r.b for r in df.select("i", bucketize("a", edges, labels, right_closed).alias("b")).collect()}
    assert got == {i: _py_bucket(a, edges, labels, right_closed) for i, a in enumerate(ages)}


@SETTINGS
@given(lines=st.lists(st.text(alphabet="ab1 ,x.-", max_size=20), min_size=1, max_size=40))
def test_parse_delimited_matches_python_split(spark, lines):
    schema = T.StructType([T.StructField(n, T.StringType()) for n in ("a", "b", "c")])
    df = spark.createDataFrame([(i, s) for i, s in enumerate(lines)], "i int, line string")
    got = {r.i: (r.a, r.b, r.c) for r in df.select("i", *parse_delimited("line", ",", schema)).collect()}
    for i, s in enumerate(lines):
        parts = [p.strip() for p in s.split(",", 2)]
        parts += [None] * (3 - len(parts))
        assert got[i] == tuple(parts), (s, got[i])


@SETTINGS
@given(texts=st.lists(st.text(alphabet="aZéÀỹ×Ж \t\n\",()*.!09", max_size=30), min_size=1, max_size=40))
def test_tokenize_matches_python_regex(spark, texts):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(texts)], "i int, t string")
    got = {r.i: r.w for r in df.select("i", tokenize("t").alias("w")).collect()}
    for i, s in enumerate(texts):
        clean = re.sub(r"[^a-zA-ZÀ-ỹ \t\n\x0b\f\r]", " ", s.lower())
        assert got[i] == [w for w in re.split(r'[ \t\n\x0b\f\r",()*]+', clean) if w], s
