import random
from collections import defaultdict

import pytest

from critiq.llm import chosen_path as C
from critiq.llm import components as Links
from critiq.llm.components import components
from tests.llm.conftest import SCHEMA, prose


def _set(text, size):
    words = (text or "").encode().lower().split()
    if not words:
        return set()
    return set(zip(*[words[i:] for i in range(size)])) if len(words) >= size else {tuple(words)}


def _brute(rows, size, like=80):
    sets = {i: _set(t, size) for i, t in rows}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= like * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i), find(i) == i) for i in ids}


def _copies(seed, groups=12, most=10):
    rnd, rows = random.Random(seed), []
    for g in range(groups):
        words = prose(seed * 100 + g, 60).split()
        for _ in range(rnd.randrange(1, most)):
            copy = list(words)
            for _ in range(rnd.randrange(0, 7)):
                copy[rnd.randrange(len(copy))] = f"new{rnd.randrange(9999)}"
            rows.append(" ".join(copy))
    rnd.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("size", [2, 5])
def test_equals_brute_force(spark, size):
    rows = _copies(3)
    frame = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], SCHEMA).repartition(3)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in C.near_groups(frame, size).collect()}
    assert got == _brute(rows, size)


@pytest.mark.parametrize("leaf", [32, 4])
def test_a_large_group_is_linked_as_by_brute_force(spark, monkeypatch, leaf):
    # with LEAF 4 nearly all nodes of the group are large
    monkeypatch.setattr(C, "LEAF", leaf)
    rows = _copies(4, groups=2, most=80) + [(1000 + i, prose(i, 50)) for i in range(20)]
    frame = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], SCHEMA)
    got = {r.doc_id: r.component_id for r in C.near_groups(frame, 2).collect()}
    assert got == {i: c for i, (_, c, _) in _brute(rows, 2).items()}


@pytest.mark.parametrize("exhaustive, rounds, least", [(1 << 20, 12, 1.0), (60, 12, 0.97), (60, 1, 1.0)])
def test_members_alike_only_to_each_other_are_linked_in_a_large_group(spark, monkeypatch, exhaustive, rounds, least):
    # one template of which hardly two documents are alike (0.71), and a borderline copy (0.82) of each;
    # with 60 comparisons a node, all large nodes branch on, several levels deep or until ROUNDS ends it
    monkeypatch.setattr(C, "LEAF", 1)
    monkeypatch.setattr(C, "EXHAUSTIVE", exhaustive)
    monkeypatch.setattr(C, "ROUNDS", rounds)
    rnd, rows = random.Random(21), []
    template = prose(77, 120, 5000).split()
    for g in range(100):
        words = list(template)
        for k, at in enumerate(rnd.sample(range(0, 120, 2), 11)):
            if k == 5:
                rows.append(" ".join(words))
            words[at] = f"own{g}x{k}"
        rows.append(" ".join(words))
    rows = list(enumerate(rows))
    frame = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], SCHEMA)
    want = {i: c for i, (_, c, _) in _brute(rows, 2).items()}
    assert 50 < len(set(want.values())) <= 100
    got = {r.doc_id: r.component_id for r in C.near_groups(frame, 2).collect()}
    assert all(want[i] == want[c] for i, c in got.items())  # no wrong link
    assert sum(got[i] == want[i] for i in want) >= least * len(want)


def test_branching_splits_nodes_and_keeps_like_documents_together(spark):
    rnd, sets = random.Random(5), []
    for i in range(100):
        own = [rnd.getrandbits(63) for _ in range(100)]
        sets += [(2 * i, own), (2 * i + 1, own[:90] + [rnd.getrandbits(63) for _ in range(10)])]  # 0.82 alike
    raw = [(i, bytearray(C.np.unique(C.np.array(x, C.np.uint64)).tobytes())) for i, x in sets]
    frame = spark.createDataFrame(raw, "id long, set binary")
    together = 0
    for level in range(3):
        steps = {r.id: r.steps for r in C._children(frame, level).collect()}
        assert all(len(s) == C.BRANCHES for s in steps.values())
        together += sum(x == y for i in range(100) for x, y in zip(steps[2 * i], steps[2 * i + 1]))
        assert all(steps[0][k] != steps[2 * i][k] for i in range(1, 100) for k in range(C.BRANCHES))
    assert 0.55 < together / (300 * C.BRANCHES) < 0.8  # 0.82^2 = 0.67 expected


def test_words_are_ascii_lower_cased_and_parted_by_ascii_blanks(spark):
    rows = [(1, "A\tb\nC"), (2, "a B c"), (3, "É b c"), (4, "é b c"), (5, "a b c"), (6, "one"), (7, "ONE"), (8, " ")]
    frame = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], SCHEMA)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in C.near_groups(frame, 2).collect()}
    assert got == {1: (2, 1), 2: (2, 1), 3: (2, 3), 4: (2, 4), 5: (2, 1), 6: (1, 6), 7: (1, 6), 8: (0, 8)}


def test_edges(edge_docs, no_docs):
    rows = C.near_groups(edge_docs, 5).collect()
    assert len(rows) == edge_docs.count()
    by_id = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert by_id[6].component_id == 1 and not by_id[6].kept and by_id[1].kept
    assert all(r.component_id == 8 for r in rows if r.doc_id == 9)
    assert by_id[2].n_shingles == by_id[3].n_shingles == by_id[4].n_shingles == 0 and by_id[2].kept and by_id[3].kept
    assert all(r.component_id is None and r.kept for r in rows if r.doc_id is None)
    kept = C.keep_one(edge_docs)
    assert kept.columns == edge_docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert 6 not in ids and 9 not in ids and ids.count(None) == 2 and {1, 2, 3, 5, 8} <= set(ids)
    assert C.near_groups(no_docs).collect() == [] and C.keep_one(no_docs).collect() == []


@pytest.mark.parametrize("rows", [1 << 18, 50])
def test_components(spark, monkeypatch, rows):
    monkeypatch.setattr(Links, "ROWS", rows)  # one partition, or several
    rnd = random.Random(6)
    links = [(k, k + 1) for k in range(200, 260)] + [(500, 500 + k) for k in range(1, 300)]
    links += [(rnd.randrange(100), rnd.randrange(100)) for _ in range(60)] + [(7, 7), (None, 3), (3, None)]
    near = defaultdict(set)
    for a, b in links:
        if a is not None and b is not None and a != b:
            near[a].add(b), near[b].add(a)
    want = {}
    for start in sorted(near):
        if start not in want:
            todo = [start]
            while todo:
                x = todo.pop()
                if x not in want:
                    want[x] = start
                    todo += near[x]
    frame = spark.createDataFrame(links, "a long, b long")
    assert {r.node: r.component for r in components(frame).collect()} == want
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
