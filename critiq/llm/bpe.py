"""BPE encoding and decoding by a tokenization automaton compiled from the merge list.

Construction. The automaton starts with one state and an arc for every base
symbol. Each merge ``(a, b)`` in order adds one gadget: the state behind
``a`` is replaced by a copy without the ``b`` arc, and a new arc ``ab``
leaves every state that an ``a`` arc leaves and ends in the state behind
``b`` as it is now. The result is deterministic, and its paths are exactly
the token sequences that the merges produce. A copied state shares the arcs
of its original up to the version it was copied at, so one gadget costs two
table entries (``cuts`` and ``copies``) instead of a row of arcs, and an arc
is looked up by following copies; looked-up arcs are kept in a table.

Encoding. A pre-split word is read once, left to right. At every place
exactly one arc label ends that continues an accepted path; the word's
tokens are the labels of the path to its end. Decoding emits arc labels.

Words recur, so finished words are kept in a table of bounded size
(``TABLE_SIZE`` entries; a full table is emptied). Texts are read whole, in
slices cut at blanks, some megabytes at a time, so working memory stays
bounded for very long texts. Their distinct words are looked up; unseen ones
are read together, place by place, as numpy look-ups in the arc and label
tables.

The text rules (normalising, splitting, special tokens, byte symbols) are
those of the given tokenizer file; other kinds of file are refused.
Defined cases: NULL text is the empty text, an empty text has no tokens;
repeated rows are encoded each; an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

import hashlib
import json
import os
import unicodedata
from array import array
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

TABLE_SIZE = 400_000
SLICE_CHARS = 1 << 18
_NEVER = 1 << 60
_SPREAD = np.uint64(0x9E3779B97F4A7C15)
GROUP_CHARS = 1 << 20
WORD_SYMBOLS = 48  # longer words are read one by one
READ_WORDS = 1 << 13  # words that are read in step
_ODD_BLANKS = regex.compile(r"[^\P{White_Space} \n]")  # any blank but space and line feed
# what stands alone between letters in Latin text without apostrophes: one digit, or a run of other signs
_WORD_ENDS = r"(\p{N}|[^ \n\p{L}\p{N}]+)"
_BEYOND_LATIN = regex.compile("[^\x00-\u024f]")
_ASCII_BLANK = regex.compile(r"[ \n]")


class Automaton:
    """States and arcs over token ids. State ``t`` is the state behind an arc labelled ``t``.

    Labels are found from their last symbol backwards: ``inner`` (labels
    inside a word) and ``final`` (labels at its end) hold every ending of a
    label, with the token it is itself, or -1.
    """

    def __init__(self, vocab: dict[str, int], merges: Iterable[tuple[str, str]], end: str):
        self.cuts: dict[int, dict[int, int]] = {}
        self.copies: dict[int, tuple[int, int]] = {}
        self.starts: dict[int, tuple[int, int]] = {}
        self.arcs: dict[int, bool] = {}
        for version, (a, b) in enumerate(merges):
            self.add_gadget(vocab[a], vocab[b], vocab[a + b], version)
        self.labels = [""] * (max(vocab.values(), default=-1) + 1)
        self.lengths = [0] * len(self.labels)
        self.inner: dict[str, int] = {}
        self.final: dict[str, int] = {}
        for text, token in vocab.items():
            self.labels[token] = text
            at_end = text.endswith(end)
            symbols, endings = (text[:-len(end)], self.final) if at_end else (text, self.inner)
            self.lengths[token] = len(symbols)
            for k in range(1, len(symbols)):
                endings.setdefault(symbols[k:], -1)
            endings[symbols] = token
        self._tabulate()

    def _tabulate(self) -> None:
        """The trees of reversed labels as arrays: an open-addressed edge table, and the token of each node.

        Node 0 is the root of the labels inside a word, node 1 of those at its end.
        """
        edges: dict[int, int] = {}
        tokens = [-1, -1]
        for root, endings in enumerate((self.inner, self.final)):
            for text, token in endings.items():
                if token < 0:
                    continue
                node = root
                for c in reversed(text):
                    key = node << 9 | ord(c)
                    node = edges.setdefault(key, len(tokens))
                    if node == len(tokens):
                        tokens.append(-1)
                tokens[node] = token
        bits = max(4, (2 * len(edges)).bit_length())
        self.slot_shift, mask = np.uint64(64 - bits), (1 << bits) - 1
        self.slot_keys = np.full((1 << bits) + 64, -1, np.int64)  # room for the last run
        self.slot_nodes = np.zeros(len(self.slot_keys), np.int32)
        for key, node in edges.items():
            slot = (key * int(_SPREAD) & 0xFFFFFFFFFFFFFFFF) >> (64 - bits) & mask
            while self.slot_keys[slot] >= 0:
                slot += 1
            self.slot_keys[slot], self.slot_nodes[slot] = key, node
        self.node_tokens = np.array(tokens, np.int32)
        self.token_lengths = np.array(self.lengths, np.int32)

    def _step(self, nodes: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        """The node below each node by its symbol; -1 where there is none."""
        keys = (nodes.astype(np.int64) << 9) | symbols
        slots = ((keys.astype(np.uint64) * _SPREAD) >> self.slot_shift).astype(np.int64)
        found = self.slot_keys[slots]
        out = np.where(found == keys, self.slot_nodes[slots], -1)
        open_ = np.flatnonzero((found != keys) & (found >= 0))
        while len(open_):
            slots[open_] += 1
            found = self.slot_keys[slots[open_]]
            hit = found == keys[open_]
            out[open_[hit]] = self.slot_nodes[slots[open_[hit]]]
            open_ = open_[~hit & (found >= 0)]
        return out

    def _leave(self, states: np.ndarray, labels: np.ndarray) -> np.ndarray:
        """Which arcs (state, label) exist."""
        pairs, place = np.unique(states.astype(np.int64) << 20 | labels, return_inverse=True)
        known = list(map(self.arcs.get, pairs.tolist()))
        if None in known:
            known = [self.arc(p >> 20, p & 0xFFFFF) if k is None else k for p, k in zip(pairs.tolist(), known)]
        return np.array(known, bool)[place]

    def read_all(self, words: list[str]) -> list[bytes]:
        """Packed token ids of each of many words, all read in step, place by place."""
        sizes = np.array([len(w) for w in words], np.int64)
        order = np.argsort(-sizes, kind="stable")
        sizes, top = sizes[order], int(sizes.max(initial=0))
        symbols = np.zeros((len(words), top), np.uint16)
        text = "".join([words[i] for i in order])
        symbols[np.arange(top) < sizes[:, None]] = np.frombuffer(text.encode("utf-16-le"), np.uint16)
        symbols = np.ascontiguousarray(symbols.T)
        path = np.zeros((top + 1, len(words)), np.int32)
        for i in range(1, top + 1):
            at = np.arange(np.searchsorted(-sizes, -i, "right"))  # words of at least i symbols
            node = (sizes[at] == i).astype(np.int32)
            found = []
            for j in range(i - 1, -1, -1):
                node = self._step(node, symbols[j][at])
                alive = node >= 0
                at, node = at[alive], node[alive]
                if not len(at):
                    break
                token = self.node_tokens[node]
                label = token >= 0
                found.append((j, at[label], token[label]))
            for j, at, token in reversed(found):
                fresh = path[i][at] == 0
                at, token = at[fresh], token[fresh]
                if j and len(at):
                    leaves = self._leave(path[j][at] - 1, token)
                    at, token = at[leaves], token[leaves]
                path[i][at] = token + 1
        at, left, owners, tokens = np.arange(len(words)), sizes.copy(), [], []
        while len(at):
            token = path[left[at], at] - 1
            if (token < 0).any():
                raise ValueError("the vocabulary lacks a symbol of a word")
            owners.append(order[at])
            tokens.append(token)
            left[at] -= self.token_lengths[token]
            at = at[left[at] > 0]
        # the steps run from the last token of each word to its first
        owner = np.concatenate([np.zeros(0, np.int64), *owners[::-1]])
        packed = np.concatenate([np.zeros(0, np.int32), *tokens[::-1]])[np.argsort(owner, kind="stable")]
        ends = 4 * np.cumsum(np.bincount(owner, minlength=len(words)))
        data = packed.astype(np.uint32).tobytes()
        return [data[i:j] for i, j in zip([0, *ends[:-1].tolist()], ends.tolist())]

    def add_gadget(self, a: int, b: int, ab: int, version: int) -> None:
        self.cuts.setdefault(a, {})[b] = version
        self.copies[ab] = (b, version)
        self.starts[ab] = (a, version)

    def arc(self, state: int, label: int) -> bool:
        """Does an arc ``label`` leave ``state``?"""
        key = state << 20 | label
        known = self.arcs.get(key)
        if known is None:
            if len(self.arcs) >= TABLE_SIZE:
                self.arcs.clear()
            known = self.arcs[key] = self._follow(state, label)
        return known

    def _follow(self, state: int, label: int) -> bool:
        at, until = state, _NEVER
        while True:
            cut = self.cuts.get(at)
            if cut:
                first, before = label, _NEVER
                while True:
                    version = cut.get(first)
                    if version is not None and version < until and version <= before:
                        return False
                    if first not in self.starts:
                        break
                    first, before = self.starts[first]
            if at not in self.copies:
                return True
            at, until = self.copies[at]

    def read(self, word: str) -> list[int]:
        """Token ids of one word of base symbols."""
        n = len(word)
        path = [-1] * (n + 1)  # the label that ends at each place
        for i in range(1, n + 1):
            path[i] = self._ending(word, i, path, self.final if i == n else self.inner)
        out, i = [], n
        while i > 0:
            out.append(path[i])
            i -= self.lengths[path[i]]
        return out[::-1]

    def _ending(self, word: str, i: int, path: list[int], endings: dict[str, int]) -> int:
        """The one label that ends at place ``i`` on an accepted path."""
        found, j = [], i
        while j > 0:
            label = endings.get(word[j - 1:i])
            if label is None:
                break
            j -= 1
            if label >= 0:
                found.append((j, label))
        for j, label in reversed(found):
            if j == 0 or self.arc(path[j], label):
                return label
        raise ValueError(f"the vocabulary lacks a symbol of {word[:40]!r}")


def byte_symbols() -> dict[int, str]:
    """Byte value to its printable symbol: printable Latin-1 bytes stand for themselves, the rest follow U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


@dataclass
class Encoded:
    """Token ids of some consecutive slices of texts: slice ``k`` belongs to text ``owners[k]``."""

    owners: list[int]
    ids: np.ndarray
    offsets: np.ndarray

    def parts(self) -> Iterator[tuple[int, np.ndarray]]:
        for k, owner in enumerate(self.owners):
            yield owner, self.ids[self.offsets[k]:self.offsets[k + 1]]

    def joined(self, strings: pa.Array) -> list[str]:
        """Per slice the ``strings`` of its ids, joined by blanks."""
        lists = pa.LargeListArray.from_arrays(pa.array(self.offsets, pa.int64()), strings.take(pa.array(self.ids)))
        return pc.binary_join(lists, pa.scalar(" ", pa.large_string())).to_pylist()


def _distinct(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct parts between blanks, the place of each part among them, and where each text's parts start."""
    lists = pc.split_pattern(texts, " ")
    flat = lists.flatten().dictionary_encode()
    return (flat.dictionary, flat.indices.to_numpy().astype(np.int64), lists.offsets.to_numpy().astype(np.int64))


def _gathered(values: np.ndarray, sizes: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of ``values`` (``sizes`` long, one after another) in the order of ``codes``, and where each run ends up."""
    counts = sizes[codes]
    ends = np.concatenate([[0], np.cumsum(counts)])
    return values[np.repeat((np.cumsum(sizes) - sizes)[codes] - ends[:-1], counts) + np.arange(ends[-1])], ends


class Encoder:
    """Whole texts to token ids by the rules of one tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        kinds = [x["type"] for x in spec["normalizer"]["normalizers"]]
        steps = [x["type"] for x in spec["pre_tokenizer"]["pretokenizers"]]
        if kinds != ["NFC", "Replace", "Lowercase"] or steps != ["Split", "ByteLevel"] or spec["decoder"]:
            raise ValueError("not a lower-casing word BPE file")
        model = spec["model"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.automaton = Automaton(model["vocab"], merges, model["end_of_word_suffix"])
        # the library only normalises and splits here: it gets the rules without vocabulary and merges
        self.rules = Tokenizer.from_str(json.dumps(spec | {"model": {"type": "BPE", "vocab": {}, "merges": []}}))
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        labels = [*self.automaton.labels]
        labels += [""] * (max(self.special.values(), default=-1) + 1 - len(labels))
        for text, token in self.special.items():
            labels[token] = text
        self.labels = pa.array(labels, pa.large_string())
        self.numbers = pa.array([str(i) for i in range(len(labels))], pa.large_string())
        self.split_special = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")
        self.words = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        self.symbols = byte_symbols()
        self.table: dict[str, bytes] = {"": b""}

    def _read(self, words: list[str]) -> list[bytes]:
        """Packed token ids of each word."""
        symbols = [w if w.isascii() and w.isprintable() else
                   w.encode("utf-8").decode("latin-1").translate(self.symbols) for w in words]
        short = [w for w in symbols if len(w) <= WORD_SYMBOLS]
        found = (value for k in range(0, len(short), READ_WORDS) for value in self.automaton.read_all(short[k:k + READ_WORDS]))
        return [next(found) if len(w) <= WORD_SYMBOLS else array("I", self.automaton.read(w)).tobytes()
                for w in symbols]

    def _values(self, words: list[str]) -> list[bytes]:
        """Packed token ids of distinct words; unseen ones are read together."""
        table = self.table
        if len(table) >= TABLE_SIZE:
            table.clear()
            table[""] = b""  # between neighbouring blanks; no word that could be read
        found = list(map(table.get, words))
        unseen = [w for w, v in zip(words, found) if v is None]
        if not unseen:
            return found
        fresh = dict(zip(unseen, self._read(unseen)))
        table.update((w, v) for w, v in fresh.items() if len(w) <= 64)
        return [fresh[w] if v is None else v for w, v in zip(words, found)]

    def _slices(self, text: str) -> Iterator[str]:
        start = 0
        while len(text) - start > SLICE_CHARS:
            blank = _ASCII_BLANK.search(text, start + SLICE_CHARS)
            if blank is None:
                break
            yield text[start:blank.start()]
            start = blank.start()
        yield text[start:]

    def _pieces(self, text: str) -> Iterator[tuple[str, int | None]]:
        """Normalised slices; with -1 if only blanks still part its words, with the id of a special token if it is one."""
        parts = self.split_special.split(text) if "<|" in text else [text]
        for part in parts:
            if part in self.special:
                yield "", self.special[part]
                continue
            for piece in self._slices(part):
                # Latin text by Python's own rules, all other by the file's (they may follow another Unicode version)
                if _BEYOND_LATIN.search(piece):
                    low = self.rules.normalizer.normalize_str(piece)
                    yield " ".join([low[i:j] for _, (i, j) in self.rules.pre_tokenizer.pre_tokenize_str(low)]), -1
                    continue
                low = unicodedata.normalize("NFC", piece).lower()
                if "'" in low or _ODD_BLANKS.search(low):
                    yield " ".join(self.words.findall(low)), -1
                else:
                    yield low.replace("\n", " "), None

    def _plain(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids and their offsets of slices: distinct chunks between blanks are parted into words by ``_WORD_ENDS``."""
        chunks, codes, starts = _distinct(pa.array(texts, pa.large_string()))
        ids, offsets = self._ready(pc.replace_substring_regex(chunks, _WORD_ENDS, r" \1 "))
        ids, ends = _gathered(ids, np.diff(offsets), codes)
        return ids, ends[starts]

    def _ready(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids and their offsets of texts whose words are parted by blanks."""
        words, codes, starts = _distinct(texts)
        values = self._values(words.to_pylist())
        sizes = np.fromiter(map(len, values), np.int64, len(values)) // 4
        ids, ends = _gathered(np.frombuffer(b"".join(values), np.uint32), sizes, codes)
        return ids, ends[starts]

    def _encoded(self, owners: list[int], texts: list[str], marks: dict[int, int]) -> Encoded:
        """One group of slices, each in its place."""
        parts: list[np.ndarray] = [np.array([marks[k]], np.uint32) if marks.get(k, -1) >= 0 else None
                                   for k in range(len(texts))]
        plain = [k for k in range(len(texts)) if k not in marks]
        ready = [k for k, mark in marks.items() if mark < 0]
        for places, (ids, offsets) in ((plain, self._plain([texts[k] for k in plain])),
                                       (ready, self._ready(pa.array([texts[k] for k in ready], pa.large_string())))):
            for i, k in enumerate(places):
                parts[k] = ids[offsets[i]:offsets[i + 1]]
        offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts], dtype=np.int64)])
        return Encoded(owners, np.concatenate(parts), offsets)

    def encode_all(self, texts: Iterable[str | None]) -> Iterator[Encoded]:
        """Token ids of whole texts, in order, some ``GROUP_CHARS`` characters at a time."""
        owners, group, marks, size = [], [], {}, 0
        for i, text in enumerate(texts):
            for piece, mark in self._pieces(text or ""):
                if mark is not None:
                    marks[len(group)] = mark
                owners.append(i)
                group.append(piece)
                size += len(piece) + 1
                if size >= GROUP_CHARS:
                    yield self._encoded(owners, group, marks)
                    owners, group, marks, size = [], [], {}, 0
        if group:
            yield self._encoded(owners, group, marks)


@lru_cache(maxsize=1)
def _kept_encoder(path: str, size: int, changed: int) -> Encoder:
    return Encoder(path)


def worker_encoder(path: str) -> Encoder:
    """One encoder per Python worker process: its tasks share the compiled file and the words read so far."""
    at = os.stat(path)  # a file that was replaced is read anew
    return _kept_encoder(path, at.st_size, at.st_mtime_ns)


class _Digest:
    """Number of tokens, SHA-256 of the ids and of the decoded text, fed slice by slice."""

    def __init__(self):
        self.n, self.ids, self.labels = 0, hashlib.sha256(), hashlib.sha256()

    def add(self, n: int, ids: str, labels: str) -> None:
        if not n:
            return
        if self.n:
            self.ids.update(b" ")
            self.labels.update(b" ")
        self.n += n
        self.ids.update(ids.encode())
        self.labels.update(labels.encode())


def digests(encoder: Encoder, texts: list[str | None]) -> list[tuple[int, str, str]]:
    """n_tokens, ids_sha256, decoded_sha256 of each text; decoding emits the arc labels of the ids."""
    found = [_Digest() for _ in texts]
    for e in encoder.encode_all(texts):
        for owner, n, ids, labels in zip(e.owners, np.diff(e.offsets).tolist(), e.joined(encoder.numbers),
                                         e.joined(encoder.labels)):
            found[owner].add(n, ids, labels)
    return [(d.n, d.ids.hexdigest(), d.labels.hexdigest()) for d in found]


def token_arrays(encoder: Encoder, texts: Iterable[str | None]) -> Iterator[np.ndarray]:
    """The token ids (uint32) of each text, in order; only those of one group of slices, or one text, are held at a time."""
    parts: list[np.ndarray] = []
    now = 0
    for e in encoder.encode_all(texts):
        for owner, ids in e.parts():  # every text has a slice, so owners rise by one at most
            if owner != now:
                yield parts[0] if len(parts) == 1 else np.concatenate(parts)
                parts, now = [], owner
            parts.append(ids)
    if parts:
        yield parts[0] if len(parts) == 1 else np.concatenate(parts)


def encode_documents(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 per document (no shuffle).

    ``tokenizer_path`` must be readable on every executor (an installed package or a shipped file).
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = None
        for batch in batches:
            encoder = encoder or Encoder(tokenizer_path)
            found = digests(encoder, batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([f[0] for f in found], pa.int64()),
                 pa.array([f[1] for f in found], pa.string()), pa.array([f[2] for f in found], pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = narrow.schema["doc_id"].dataType.simpleString()
    return narrow.mapInArrow(run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def tokenize_documents(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id",
                       text_col: str = "text") -> DataFrame:
    """doc_id, token_ids per document: the operator's real output."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = None
        for batch in batches:
            encoder = encoder or Encoder(tokenizer_path)
            ids = token_arrays(encoder, (text.as_py() for text in batch.column(1)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([x.astype(np.int32) for x in ids], pa.list_(pa.int32()))],
                names=["doc_id", "token_ids"])

    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = narrow.schema["doc_id"].dataType.simpleString()
    return narrow.mapInArrow(run, f"doc_id {kind}, token_ids array<int>")


def decode(tokenizer_path: str, ids: Iterable[int]) -> str:
    """The text of a token id sequence: its arc labels, joined by blanks."""
    labels = Encoder(tokenizer_path).labels
    return " ".join(labels[i].as_py() for i in ids)
