import zlib

import numpy as np
import pytest

from critiq.llm import quality
from tests.llm.conftest import SCHEMA, prose


def _corpus(spark, n=300):
    rows, marks = [], []
    for i in range(n):
        good = i % 3 > 0
        text = prose(i, 30 + i % 50).capitalize() + "." if good else " | ".join(prose(i, 30).upper().split()) + "!!"
        rows.append((i, text, None, None, None))
        marks.append((i, int(good), 0))
    return (spark.createDataFrame(rows, SCHEMA).repartition(3),
            spark.createDataFrame(marks, "doc_id long, quality int, toxic int"))


def test_held_out_accuracy_and_folds(spark):
    docs, labels = _corpus(spark)
    rows = quality.score_documents(docs, labels).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(r.predicted == int(r.score >= 0.3) for r in rows)
    held = [r for r in rows if r.held_out]
    assert held and all(r.predicted == int(r.doc_id % 3 > 0) for r in held)


def test_held_out_labels_are_not_used(spark):
    from pyspark.sql import functions as F

    docs, labels = _corpus(spark)
    spoiled = labels.withColumn("quality", F.when(quality.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    a = {r.doc_id: r.score for r in quality.score_documents(docs, labels).collect()}
    assert a == {r.doc_id: r.score for r in quality.score_documents(docs, spoiled).collect()}


def test_scores_are_sums_of_table_entries():
    rng = np.random.default_rng(3)
    x = rng.random((2000, len(quality.FEATURES)))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)  # a pure interaction
    model = quality.fit(x, y)
    row = x[7]
    total = model.base + sum(t[np.searchsorted(e, v, "right")] for e, t, v in zip(model.edges, model.tables, row))
    total += sum(t[np.searchsorted(model.coarse[i], row[i], "right"), np.searchsorted(model.coarse[j], row[j], "right")]
                 for i, j, t in model.pairs)
    assert model.score(x[7:8])[0] == pytest.approx(1 / (1 + np.exp(-total)))
    assert (1, 0) in [(i, j) for i, j, _ in model.pairs]
    assert np.mean((model.score(x) > 0.5) == y) > 0.9


def test_edges(edge_docs, no_docs, labels, no_labels):
    rows = quality.score_documents(edge_docs, labels).collect()
    assert len(rows) == edge_docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert {r.score for r in quality.score_documents(edge_docs, no_labels).collect()} == {0.5}
    assert quality.score_documents(no_docs, labels).collect() == []
    kept = quality.keep_good(edge_docs, labels)
    assert kept.columns == edge_docs.columns and kept.count() <= edge_docs.count()
    one_class = labels.where("quality = 1")
    assert all(r.score > 0.5 for r in quality.score_documents(edge_docs, one_class).collect())
