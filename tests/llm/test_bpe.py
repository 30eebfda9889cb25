import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from critiq.llm import bpe
from tests.llm.conftest import prose

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(PATH)


def _want(library, text):
    ids = library.encode(text, add_special_tokens=False).ids
    return (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
            hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest())


def _texts():
    rnd = random.Random(5)
    points = [chr(c) for c in range(0x3100) if not 0xD800 <= c < 0xE000]
    out = ["", "  \n", "a<|endoftext|>b <|STARTOFTEXT|> <|startoftext|>", "ΑΣ ΟΔΟΣ", "a\x1cb\x85c", "</w> a</w>",
           "'S I'LL don't''re", "é́ ﬁ İ", "日本語 😀😀 ½²", "a" * 300, "ab" * 2000 + "c", "x" * 600_000, prose(1, 90_000)]
    out += ["".join(rnd.choice(points) for _ in range(60)) for _ in range(150)]
    out += ["".join(rnd.choice("abcdehilnorst'  !?,.-=xyzAB01\n") for _ in range(200)) for _ in range(150)]
    return out + ["".join(rnd.choice("aab ") for _ in range(100)) for _ in range(100)]


def test_equals_the_library_one_by_one_and_together(library, encoder):
    texts = _texts()
    want = [_want(library, t) for t in texts]
    assert bpe.digests(encoder, texts) == want
    small = bpe.Encoder(PATH)
    assert [bpe.digests(small, [t])[0] for t in texts[:40]] == want[:40]


def test_full_tables_are_emptied(library, monkeypatch):
    for name in ("TABLE_SIZE", "GROUP_CHARS"):
        monkeypatch.setattr(bpe, name, 50)
    texts = [prose(i, 200) for i in range(20)]
    assert bpe.digests(bpe.Encoder(PATH), texts) == [_want(library, t) for t in texts]


def test_blanks_in_a_row_survive_an_emptied_table(library, monkeypatch):
    """The empty word between them used to go with the table, and could not be read as a word."""
    monkeypatch.setattr(bpe, "TABLE_SIZE", 5)
    monkeypatch.setattr(bpe, "GROUP_CHARS", 1)
    texts = ["one two three four five six", "seven  eight \n nine", " ", "ten,  eleven"]
    assert bpe.digests(bpe.Encoder(PATH), texts) == [_want(library, t) for t in texts]


def test_tasks_of_one_worker_share_an_encoder(tmp_path):
    first = bpe.worker_encoder(PATH)
    assert bpe.worker_encoder(PATH) is first
    rules, copy = open(PATH, encoding="utf-8").read(), tmp_path / "rules.json"
    copy.write_text(rules, encoding="utf-8")
    first = bpe.worker_encoder(str(copy))
    copy.write_text(rules + "\n", encoding="utf-8")  # a file that is replaced is read anew
    assert bpe.worker_encoder(str(copy)) is not first


def test_token_arrays_come_while_texts_are_read(library, encoder, monkeypatch):
    """No more than a group of texts is held at a time: a whole batch of them used to be, with all its ids."""
    monkeypatch.setattr(bpe, "GROUP_CHARS", 2000)
    monkeypatch.setattr(bpe, "READ_WORDS", 7, raising=False)
    texts, taken = [*_texts(), None, "", "last"], []

    def each():
        for text in texts:
            taken.append(text)
            yield text

    found = iter(bpe.token_arrays(encoder, each()))
    got = [next(found).tolist()]
    assert len(taken) < 20
    got += [ids.tolist() for ids in found]
    assert got == [library.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert list(bpe.token_arrays(encoder, [])) == []


def test_scalar_and_joint_reading_agree(encoder):
    rnd = random.Random(2)
    words = list({"".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rnd.randrange(1, 30)))
                  for _ in range(2000)})
    joint = [np.frombuffer(x, np.uint32).tolist() for x in encoder.automaton.read_all(words)]
    assert joint == [encoder.automaton.read(w) for w in words] and encoder.automaton.read_all([]) == []


def test_automaton_against_merges_by_hand():
    # merges of the string "abab": ab, then abab; with ends of word
    vocab = {"a": 0, "b": 1, "a</w>": 2, "b</w>": 3, "ab": 4, "ab</w>": 5, "abab</w>": 6, "aa": 7}
    merges = [("a", "b"), ("a", "b</w>"), ("ab", "ab</w>"), ("a", "a")]
    automaton = bpe.Automaton(vocab, merges, "</w>")
    assert automaton.read("abab") == [6] and automaton.read("ab") == [5]
    assert automaton.read("aab") == [0, 5] and automaton.read("aaab") == [7, 5] and automaton.read("aaaa") == [7, 0, 2]
    assert not automaton.arc(0, 1)


def test_queries_and_edges(spark, library, edge_docs, no_docs):
    rows = bpe.encode_documents(edge_docs, PATH).collect()
    assert len(rows) == edge_docs.count()
    texts = {r.doc_id: r.text or "" for r in edge_docs.collect()}
    for r in rows:
        if r.doc_id is not None:
            assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == _want(library, texts[r.doc_id])
    assert bpe.encode_documents(no_docs, PATH).collect() == []
    ids = {r.doc_id: r.token_ids for r in bpe.tokenize_documents(edge_docs, PATH).collect()}
    assert ids[10] == library.encode(texts[10], add_special_tokens=False).ids
    assert bpe.decode(PATH, ids[1]) == library.decode(ids[1], skip_special_tokens=False)


def test_other_tokenizer_files_are_refused():
    with pytest.raises(Exception):
        bpe.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
