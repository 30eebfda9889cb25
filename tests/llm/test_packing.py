import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from critiq.llm import packing
from tests.llm.conftest import SCHEMA, prose

PATH = public_tokenizers.path("word_bpe_49k.json")


def _bins_ok(lengths, bins, limit):
    assert sorted(i for b in bins for i in b) == list(range(len(lengths)))
    assert all(sum(lengths[i] for i in b) <= limit for b in bins)


@pytest.mark.parametrize("seed", range(6))
def test_bins_hold_every_piece_once(seed):
    rnd = random.Random(seed)
    lengths = [rnd.randint(1, 100) for _ in range(rnd.randrange(1, 400))]
    bins = packing.best_two_fit(lengths, 100)
    _bins_ok(lengths, bins, 100)
    decreasing = sorted(lengths, reverse=True)  # first fit decreasing, as a yardstick
    free = []
    for n in decreasing:
        for k, room in enumerate(free):
            if room >= n:
                free[k] -= n
                break
        else:
            free.append(100 - n)
    assert len(bins) <= len(free) + 1


def test_two_smaller_pieces_replace_the_smallest():
    # greedily 60 + 30 leaves a gap of 10 that nothing fits; 22 + 18 fill the place of 30 and the gap
    assert sorted(map(len, packing.best_two_fit([60, 30, 22, 18], 100))) == [1, 3]
    assert packing.best_two_fit([], 10) == [] and packing.best_two_fit([10, 10], 10) == [[1], [0]]
    with pytest.raises(ValueError):
        packing.best_two_fit([11], 10)


def test_one_length_pairs_with_itself_only_if_there_are_two():
    bins = packing.best_two_fit([70, 20, 14], 100)
    _bins_ok([70, 20, 14], bins, 100)
    assert len(packing.best_two_fit([70, 20, 15, 15], 100)) == 2


def _check(docs, rows, limit):
    library = Tokenizer.from_file(PATH)
    want = defaultdict(list)
    for d in docs:
        ids = library.encode(d.text or "", add_special_tokens=False).ids + [0]
        pieces = [ids[i:i + limit] for i in range(0, len(ids), limit)]
        want[d.doc_id] += [(k, k * limit, len(p), zlib.crc32(np.array(p, "<u4").tobytes())) for k, p in enumerate(pieces)]
    got, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        got[r.doc_id].append((r.piece, r.start, r.length, r.ids_crc32))
        sequences[r.sequence_id].append((r.offset, r.length))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= limit


def test_documents_are_cut_and_packed_whole(spark):
    docs = spark.createDataFrame([(i, prose(i, i * 13 % 300), None, None, None) for i in range(150)], SCHEMA)
    _check(docs.collect(), packing.pack_documents(docs, PATH, 256, group_pieces=40).collect(), 256)


def test_pieces_are_the_same_without_a_shared_encoder(edge_docs):
    pieces = [sorted(map(str, packing.token_pieces(edge_docs, PATH, 16, share=share).collect())) for share in (True, False)]
    assert pieces[0] == pieces[1]


def test_edges(edge_docs, no_docs):
    _check(edge_docs.collect(), packing.pack_documents(edge_docs, PATH).collect(), 2048)
    assert packing.pack_documents(no_docs, PATH).collect() == []


def test_pieces_of_a_long_document_are_spread(spark):
    """Groups are counted in pieces: one document of most pieces does not fill one group."""
    docs = spark.createDataFrame([(1, prose(1, 30_000))] + [(i, "short text") for i in range(2, 60)], "doc_id long, text string")
    rows = packing.pack_documents(docs, PATH, 64, group_pieces=100).collect()
    _check(docs.collect(), rows, 64)
    groups = {}
    for r in rows:
        groups[r.sequence_id >> 32] = groups.get(r.sequence_id >> 32, 0) + 1
    assert len(groups) >= len(rows) // 100 and max(groups.values()) < 200
