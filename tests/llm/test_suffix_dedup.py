import hashlib
import random

import numpy as np
import pytest

from critiq.llm import suffix_dedup as S
from tests.llm.conftest import SCHEMA, prose


def _brute(rows, length=50):
    seen, out = {}, []
    for i, text in sorted(((i, t) for i, t in rows), key=lambda r: (r[0] is None, r[0] or 0)):
        data = (text or "").encode()
        gone = np.zeros(len(data), bool)
        for p in range(len(data) - length + 1):
            part = data[p:p + length]
            if i is not None and seen.setdefault(part, i) < i:
                gone[p:p + length] = True
        kept = bytes(np.frombuffer(data, np.uint8)[~gone])
        spans = int((gone & ~np.concatenate([[False], gone[:-1]])).sum()) if len(gone) else 0
        out.append((i, len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def _run(spark, rows):
    frame = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], SCHEMA).repartition(3)
    return sorted((tuple(r) for r in S.remove_repeats(frame).collect()), key=str)


def _repeats(seed):
    rnd = random.Random(seed)
    shared = [prose(100 + k, 30) for k in range(6)] + ["a" * 130, "ab" * 70, "x" * 49, "y" * 50]
    rows = []
    for i in range(60):
        parts = [prose(seed * 1000 + i, rnd.randrange(0, 25))]
        for _ in range(rnd.randrange(4)):
            piece = rnd.choice(shared)
            cut = sorted(rnd.randrange(len(piece) + 1) for _ in range(2)) if rnd.random() < 0.5 else [0, len(piece)]
            parts += [piece[cut[0]:cut[1]], prose(seed * 999 + i, rnd.randrange(0, 12))]
        rows.append((i, rnd.choice(["", " ", "é"]).join(parts)))
    return rows + [(60 + k, rows[k][1]) for k in range(0, 20, 3)]


@pytest.mark.parametrize("seed, block", [(1, 1 << 22), (2, 3000), (3, 500)])
def test_equals_brute_force(spark, monkeypatch, seed, block):
    monkeypatch.setattr(S, "BLOCK_BYTES", block)
    rows = _repeats(seed)
    assert _run(spark, rows) == _brute(rows)


def test_few_letters(spark):
    rnd = random.Random(7)
    rows = [(i, "".join(rnd.choice("ab") for _ in range(400)) + "ba" * rnd.randrange(40)) for i in range(25)]
    rows += [(40, "z" * 5000), (41, "z" * 300), (42, "z" * 49), (43, "z" * 50)]
    assert _run(spark, rows) == _brute(rows)


def test_edges(spark, edge_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in edge_docs.collect()]
    small = [(i, t) for i, t in rows if len(t or "") < 10_000]
    assert _run(spark, small) == _brute(small)
    got = {r.doc_id: r for r in S.remove_repeats(edge_docs).collect() if r.doc_id is not None}
    assert got[12].n_removed == 0 and got[12].n_bytes == 70_000 and got[6].n_removed == got[6].n_bytes
    assert S.remove_repeats(no_docs).collect() == []


def test_remaining_bytes(spark):
    text = prose(5, 40)
    frame = spark.createDataFrame([(1, text, None, None, None), (2, "new " + text + " end", None, None, None)], SCHEMA)
    kept = {r.doc_id: bytes(r.kept).decode() for r in S.remove_repeats(frame, texts=True).collect()}
    assert kept == {1: text, 2: "new  end"}


def test_anchors_sit_in_every_string_and_depend_on_it_alone():
    data = np.frombuffer((prose(1, 300) + "q" * 90 + prose(2, 50)).encode(), np.uint8)
    marks = S.anchors(data)
    for p in range(len(data) - S.LENGTH + 1):
        assert ((marks >= p) & (marks <= p + S.REACH)).any()
    own = S.anchors(data[100:150])
    assert set(own + 100) <= set(marks.tolist())


def _shared_line(n):
    line = "this line stands in a very large share of all the documents here"
    return [(i, prose(5000 + i, i % 9) + " " + line + " " + prose(9000 + i, 3 + i % 7)) for i in range(n)]


@pytest.mark.parametrize("block", [1 << 22, 4000])
def test_hot_ranks_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(S, "BLOCK_BYTES", block)
    monkeypatch.setattr(S, "FREQUENT", 2)
    monkeypatch.setattr(S, "HOT", 4)
    rows = _shared_line(150) + [(1000 + i, t) for i, t in _repeats(4)] + [(3000, None), (None, prose(1, 30))]
    assert _run(spark, rows) == _brute(rows)


def test_a_hot_rank_is_spread_over_buckets(spark):
    rows = _shared_line(3000)
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    blocks = frame.mapInArrow(S._to_blocks(1 << 16, 8),
                              "block long, size long, payload binary, frequent binary, marks long").cache()
    hot = S.hot_names(blocks, 0)
    assert len(hot) == 0  # 3,000 are far below HOT
    counts = blocks.select("frequent").where("length(frequent) > 0").mapInArrow(S._counts, "name long, n long")
    hot = np.sort(np.array([r[0] for r in counts.groupBy("name").sum("n").where("`sum(n)` >= 2000").collect()],
                           np.int64).view(np.uint64))
    assert 1 <= len(hot) <= 8
    records = {}
    for bucket, names in ((r[0], r[1]) for r in blocks.select("block", "payload").mapInArrow(
            S._first_records(32, hot), S._ROUND1).select("bucket", "names").collect()):
        records[bucket] = records.get(bucket, 0) + len(names) // S.NAME_BYTES
    dealt = [n for bucket, n in records.items() if bucket >= 32]
    assert len(dealt) == 32 and max(dealt) < 2 * sum(dealt) / 32
