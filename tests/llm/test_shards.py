import hashlib
import zlib
from collections import Counter, defaultdict

from critiq.llm import shards
from tests.llm.conftest import SCHEMA


def _jump(key, n):
    b, j = -1, 0
    while j < n:
        b = j
        key = (key * 2862933555777941757 + 1) % 2 ** 64
        j = int((b + 1) * (2.0 ** 31 / ((key >> 33) + 1)))
    return b


def _key(v):
    return int(hashlib.md5(("" if v is None else str(v)).encode()).hexdigest()[:16], 16)


def test_shards_slots_and_growth(spark):
    docs = spark.createDataFrame([(i, f"text {i}" * (i % 5), None, None, None) for i in range(2000)], SCHEMA)
    rows = shards.shard_documents(docs, 16).collect()
    places = defaultdict(list)
    for r in rows:
        text = f"text {r.doc_id}" * (r.doc_id % 5)
        assert (r.shard, r.grown_shard) == (_jump(_key(r.doc_id), 16), _jump(_key(r.doc_id), 17))
        assert r.grown_shard in (r.shard, 16)
        assert r["size"] == len(text.encode()) + 1 and r.text_crc32 == zlib.crc32(text.encode())
        places[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in places.values())
    assert max(map(len, places.values())) < 2 * min(map(len, places.values()))
    assert 60 < sum(r.grown_shard == 16 for r in rows) < 190


def test_one_and_many_shards(spark):
    docs = spark.range(500).withColumnRenamed("id", "doc_id")
    assert {r.shard for r in shards.assign_shards(docs, "doc_id", 1).collect()} == {0}
    got = shards.assign_shards(docs, "doc_id", 300).collect()
    assert all(r.shard == _jump(_key(r.doc_id), 300) for r in got)


def test_edges(edge_docs, no_docs):
    rows = shards.shard_documents(edge_docs).collect()
    assert len(rows) == edge_docs.count()
    places = defaultdict(list)
    for r in rows:
        places[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in places.values())
    assert Counter(r["size"] for r in rows if r.doc_id in (2, 3)) == {1: 2}
    assert {r.shard for r in rows if r.doc_id is None} == {_jump(_key(None), 16)}
    assert shards.shard_documents(no_docs).collect() == []
    assert "shard" in shards.assign_shards(edge_docs, "doc_id", 4).columns
