import random

import numpy as np
import pytest

from critiq.llm import pivot_topk

SCHEMA = "vec_id long, embedding array<float>, label int"


def _brute(rows, k, every):
    whole = [(i, [int(np.floor(256 * float(np.float32(x)))) for x in v]) for i, v in rows
             if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q in sorted({i for i, _ in whole if i % every == 0}):
        own = min(v for i, v in whole if i == q)
        scored = sorted((-sum(a * b for a, b in zip(own, v)), i) for i, v in whole if i != q)
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])]
    return out


def _run(spark, rows, k=5, every=10):
    frame = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA).repartition(3)
    return sorted(map(tuple, pivot_topk.top_k(frame, k, every).collect()))


@pytest.mark.parametrize("kind", ["spread", "clusters", "ties"])
def test_equals_brute_force(spark, kind):
    rnd = np.random.default_rng({"spread": 1, "clusters": 2, "ties": 3}[kind])
    if kind == "spread":
        x = rnd.normal(size=(400, 8)) * rnd.uniform(0.1, 9, (400, 1))
    elif kind == "clusters":
        x = rnd.normal(size=(10, 8))[rnd.integers(0, 10, 400)] + rnd.normal(size=(400, 8)) * 0.05
    else:
        x = rnd.integers(-1, 2, (400, 3)).astype(float)
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)]
    assert _run(spark, rows) == _brute(rows, 5, 10)


def test_edge_rows(spark):
    nan = float("nan")
    rows = [(0, [1.0, 0.5]), (1, None), (2, [nan, 1.0]), (3, [None, 1.0]), (4, []), (5, [0.25]), (6, [2.0, 2.0]),
            (7, [float("inf"), 0.0]), (10, [0.0, 0.0]), (8, [1.0, 0.5]), (8, [1.0, 0.5]), (None, [1.0, 1.0])]
    want = _brute([(i, v) for i, v in rows], 5, 10)
    assert _run(spark, rows) == want and len([r for r in want if r[0] == 0]) == 5
    assert _run(spark, [(0, [1.0])]) == [] and _run(spark, []) == [] and _run(spark, [(0, None)]) == []
    assert _run(spark, [(0, [1.0]), (1, [2.0])]) == [(0, 1, 1, 131072)]


def test_one_vector_of_most_rows(spark, monkeypatch):
    monkeypatch.setattr(pivot_topk, "CHUNK", 16)  # the shared vector spreads over many chunks
    rnd = random.Random(1)
    rows = [(i, [0.5, -0.5, 1.0] if i % 3 else [rnd.random() for _ in range(3)]) for i in range(300)]
    assert _run(spark, rows) == _brute(rows, 5, 10)


def test_many_queries_of_one_cell_are_parted(spark, monkeypatch):
    monkeypatch.setattr(pivot_topk, "CHUNK", 32)
    monkeypatch.setattr(pivot_topk, "VISITORS", 7)
    rnd = np.random.default_rng(5)
    x = rnd.normal(size=(300, 4)) * 0.01 + [1.0, 2.0, 3.0, 4.0]  # nearly one place: all queries visit the same cells
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)]
    assert _run(spark, rows, every=3) == _brute(rows, 5, 3)


def test_repeated_rows_are_candidates_each(spark):
    rows = [(0, [1.0]), (0, [1.0]), (0, [3.0]), (1, [2.0]), (1, [2.0]), (1, [5.0]), (2, [0.5]), (10, [4.0]), (10, [4.0])]
    got = _run(spark, rows, 4)
    assert got == _brute(rows, 4, 10) and [r[2] for r in got if r[0] == 0] == [1, 10, 10, 1]


def test_clashing_columns_are_ignored(spark):
    frame = spark.createDataFrame([(i, [float(i)], 0, 0, 0) for i in range(20)],
                                  "vec_id long, embedding array<float>, cell int, score int, bound int")
    assert pivot_topk.top_k(frame, 2, 10).count() == 4
