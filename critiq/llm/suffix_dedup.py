"""Removal of repeated substrings by sparse distributed prefix doubling.

A byte goes if a ``LENGTH``-byte string over it also starts in a document
with a smaller id. Positions are ranked by the strings that start there, at
doubling lengths; Spark sorts (rank, document) pairs, and positions whose
rank no other document shares drop out. Two changes make it affordable:

* Ranks are names taken from the content (a rank of length 2k is the mix of
  the ranks at p and p + k) instead of dense numbers, so ranking needs no
  exchange; only the search for equal ranks does.
* Only anchors are exchanged: the positions whose ``GRAM``-byte rank is the
  least in some ``LENGTH``-byte string (about one in fifteen). Equal strings
  have their anchors at equal places, so every repeat is seen at an anchor.

Round 1 sorts (rank, context, document) of all anchors; the context is the
name of everything that a string over the anchor can reach. A context that a
smaller document has too settles all strings over the anchor; a rank without
a smaller document settles it as well. Round 2 takes what is left, the ends
of repeats, with their context bytes and sorts the names of every
``LENGTH``-byte string over the anchor.

Records meet in buckets by their rank. A hot rank (a line that a large share
of the documents hold, with different text around it, has as many contexts
as documents) does not: blocks count the ranks they hold ``FREQUENT`` times
or more, and ranks that reach ``HOT`` in all are dealt by their contexts in
round 1 and by their strings in round 2, where a block sends the least
document of each string once. So they spread over all tasks. Ranks that are
rarer than ``FREQUENT`` in a block are not counted there: their bucket gets
less than ``FREQUENT`` records from such a block. ``HOT`` grows with the
anchors beyond ``MOST_HOT`` times ``HOT`` of them, so that at most
``MOST_HOT`` names of eight bytes are sent to the tasks.

Texts travel as compressed blocks of some megabytes: written once, shuffled
once (both later rounds read the same exchange). Each block sends one record per distinct rank and
context, so a passage that a third of all documents share costs one record
per block. Verdicts return as bit masks. Names have 64 bits from two
independent hashes.

Defined cases: NULL text is the empty text; rows with a NULL id are left
whole and remove nothing; rows of one id never remove each other's strings;
an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from critiq.session import materialize

LENGTH = 50
GRAM = 20
REACH = LENGTH - GRAM
BLOCK_BYTES = 4 << 20
BUCKET_BYTES = 8 << 20
NAME_BYTES = 5
STRETCH = 1 << 16
FREQUENT = 16
HOT = 1 << 16
MOST_HOT = 1_000_000
_U = np.uint64
_MIX = _U(0xBF58476D1CE4E5B9)
_TOP = _U(2 ** 64 - 1)
_rng = np.random.default_rng(50505)
_BYTES = _rng.integers(0, 2 ** 64, (2, 256), dtype=np.uint64)
_BASES = [0x9E3779B97F4A7C13, 0xD6E8FEB86659FD93]


def _mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    out = a * _MIX
    out += b
    out ^= out >> _U(29)
    out *= _MIX
    return out


def _doubled(raw: np.ndarray) -> np.ndarray:
    """Rank of the ``GRAM``-byte string at every place where one starts."""
    rank, size = _BYTES[0][raw], 1
    while 2 * size <= GRAM:
        rank = _mix(rank[:-size], rank[size:])
        size *= 2
    return _mix(rank[:len(raw) - GRAM + 1], rank[GRAM - size:]) if size < GRAM else rank


def _sliding(values: np.ndarray, width: int, fold) -> np.ndarray:
    """``fold`` (minimum or maximum) of every run of ``width`` values, by doubling."""
    out, size = values, 1
    while 2 * size <= width:
        out = fold(out[:-size], out[size:])
        size *= 2
    return fold(out[:len(values) - width + 1], out[width - size:]) if size < width else out


def _ranked_anchors(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Anchors and their ranks."""
    if len(raw) < LENGTH:
        return np.zeros(0, np.int64), np.zeros(0, _U)
    rank = _doubled(raw)
    least = _sliding(rank, REACH + 1, np.minimum)
    around = np.concatenate([np.zeros(REACH, _U), least, np.zeros(REACH, _U)])
    at = np.flatnonzero(rank == _sliding(around, REACH + 1, np.maximum))
    return at, rank[at]


def anchors(raw: np.ndarray) -> np.ndarray:
    """Places whose rank is the least in some ``LENGTH``-byte string of the document."""
    return _ranked_anchors(raw)[0]


@cache
def _power_table(k: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of base ``k`` and of its inverse modulo 2^64 for one stretch of text and what its contexts reach."""
    n = STRETCH + LENGTH + REACH
    return tuple(np.cumprod(np.concatenate([np.ones(1, _U), np.full(n, b, _U)]))
                 for b in (_BASES[k], pow(_BASES[k], -1, 2 ** 64)))


def _rolled(text: np.ndarray) -> Iterator[np.ndarray]:
    """Names of the ``LENGTH``-byte strings at places 0, 1, ... of every row; two numbers a row are held."""
    columns = np.ascontiguousarray(text.T)
    sums, inverse, last = [], [], []
    for k in (0, 1):
        powers, inverses = _power_table(k)
        total = np.zeros(len(text), _U)
        for i in range(LENGTH):
            total += _BYTES[k][columns[i]] * powers[i]
        sums.append(total), inverse.append(inverses[1]), last.append(powers[LENGTH - 1])
    for o in range(len(columns) - LENGTH + 1):
        yield _mix(*sums)
        if o + LENGTH < len(columns):
            sums = [(h - _BYTES[k][columns[o]]) * inverse[k] + _BYTES[k][columns[o + LENGTH]] * last[k]
                    for k, h in enumerate(sums)]


# ---- blocks -----------------------------------------------------------------

def _frequent(texts: list[bytes], marks: list[np.ndarray], ranks: list[np.ndarray], least: int) -> bytes:
    """Names and numbers of the ranks with ``least`` anchors or more in the block."""
    rank = np.concatenate(ranks)
    if len(rank) < least:
        return b""
    ordered = np.sort(rank)
    often = np.unique(ordered[least - 1:][ordered[least - 1:] == ordered[:len(ordered) - least + 1]])
    if not len(often):
        return b""
    where = np.flatnonzero(np.isin(rank, often))
    _, first = np.unique(rank[where], return_index=True)
    ends = np.cumsum([len(m) for m in marks])
    grams = []
    for i in where[first].tolist():
        doc = int(np.searchsorted(ends, i, "right"))
        at = int(marks[doc][i - (ends[doc] - len(marks[doc]))])
        grams.append(np.frombuffer(texts[doc], np.uint8, GRAM, at))
    a, b = ((_BYTES[k][np.array(grams)] * _power_table(k)[0][:GRAM]).sum(axis=1, dtype=_U) for k in (0, 1))
    number = np.searchsorted(ordered, often, "right") - np.searchsorted(ordered, often)
    return np.stack([_mix(a, b), number.astype(_U)], axis=1).tobytes()


def _pack(ids: list, texts: list[bytes], least: int) -> tuple[bytes, bytes, int]:
    """One compressed block (ids, text sizes, anchors as gaps, text bytes), its frequent ranks, number of anchors."""
    marks, ranks = zip(*(_ranked_anchors(np.frombuffer(t, np.uint8) if i is not None else np.zeros(0, np.uint8))
                         for i, t in zip(ids, texts)))
    gaps = [np.diff(m, prepend=0).astype(np.uint8) for m in marks]  # at most REACH
    head = struct.pack("<q", len(ids))
    parts = [np.array([i is None for i in ids], np.uint8), np.array([i or 0 for i in ids], np.int64),
             np.array([len(t) for t in texts], np.int64), np.array([len(m) for m in marks], np.int64), *gaps]
    whole = head + b"".join(p.tobytes() for p in parts) + b"".join(texts)
    return (zstandard.ZstdCompressor(level=3).compress(whole), _frequent(texts, marks, ranks, least),
            sum(len(m) for m in marks))


class _Block:
    """An unpacked block, its anchors and its records.

    A record is a distinct (name, context) with the smallest document id it
    has in the block; records are ordered by bucket, name and context.
    Buckets from ``buckets`` on hold the ``hot`` names, dealt by context.
    """

    def __init__(self, payload: bytes, buckets: int, hot: np.ndarray):
        raw = zstandard.ZstdDecompressor().decompress(payload)
        n = struct.unpack_from("<q", raw)[0]
        self.unknown = np.frombuffer(raw, np.uint8, n, 8).astype(bool)
        self.ids, self.sizes, counts = np.frombuffer(raw, np.int64, 3 * n, 8 + n).reshape(3, n)
        at, marks = 8 + 25 * n, int(counts.sum())
        gaps = np.frombuffer(raw, np.uint8, marks, at).astype(np.int64)
        self.bytes = np.frombuffer(raw, np.uint8, -1, at + marks) if at + marks < len(raw) else np.zeros(0, np.uint8)
        self.starts = np.cumsum(self.sizes) - self.sizes
        doc = np.repeat(np.arange(n), counts)
        run = np.cumsum(gaps)
        first = np.cumsum(counts) - counts
        base = np.concatenate([[0], run])[first]
        self.at = run - base[doc] + self.starts[doc]
        ends = self.starts[doc] + self.sizes[doc]
        self.left = np.minimum(REACH, self.at - self.starts[doc])
        self.right = np.minimum(REACH, ends - self.at - GRAM)
        self.doc = self.ids[doc]
        self._records(buckets, hot)

    def _names(self) -> tuple[np.ndarray, np.ndarray]:
        """Names of the rank and of the context of every anchor, from sums over one stretch of text at a time."""
        name, context = np.empty((2, len(self.at)), _U)
        cuts = np.searchsorted(self.at, np.arange(0, len(self.bytes) + STRETCH, STRETCH))
        for s, (i, j) in enumerate(zip(cuts[:-1], cuts[1:])):
            base = max(0, s * STRETCH - REACH)
            part = self.bytes[base:(s + 1) * STRETCH + LENGTH]
            at = self.at[i:j] - base
            lo, hi = at - self.left[i:j], at + GRAM + self.right[i:j]
            short, long_ = [], []
            for k in (0, 1):
                powers, inverse = _power_table(k)
                sums = np.concatenate([np.zeros(1, _U), np.cumsum(_BYTES[k][part] * powers[:len(part)])])
                short.append((sums[at + GRAM] - sums[at]) * inverse[at])
                long_.append((sums[hi] - sums[lo]) * inverse[lo])
            name[i:j] = _mix(*short)
            context[i:j] = _mix(_mix(*long_), (self.left[i:j] * 64 + self.right[i:j]).astype(_U))
        return name, context

    def _records(self, buckets: int, hot: np.ndarray) -> None:
        name, context = self._names()
        bucket = (name % _U(buckets)).astype(np.int64)
        if len(hot):
            is_hot = np.isin(name, hot)
            bucket[is_hot] = buckets + (context[is_hot] % _U(buckets)).astype(np.int64)
        name = (name // _U(buckets)) & _U(256 ** NAME_BYTES - 1)
        order = np.lexsort((self.doc, context, name, bucket))
        keys = [x[order] for x in (bucket, name, context)]
        fresh = np.ones(len(order), bool)
        fresh[1:] = (keys[0][1:] != keys[0][:-1]) | (keys[1][1:] != keys[1][:-1]) | (keys[2][1:] != keys[2][:-1])
        self.first = order[fresh]  # an anchor of each record, of its smallest document
        self.record = np.empty(len(order), np.int64)  # of each anchor
        self.record[order] = np.cumsum(fresh) - 1
        self.bucket, self.name, self.context = (k[fresh] for k in keys)
        self.least = self.doc[self.first]

    def slices(self) -> Iterator[tuple[int, slice]]:
        """Bucket and its slice of the records."""
        if len(self.bucket):
            cuts = np.flatnonzero(np.diff(self.bucket)) + 1
            for lo, hi in zip([0, *cuts], [*cuts, len(self.bucket)]):
                yield int(self.bucket[lo]), slice(int(lo), int(hi))


def _to_blocks(block_bytes: int, least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        ids, texts, size = [], [], 0

        def block() -> pa.RecordBatch:
            row = ((part << 32) + number, size, *_pack(ids, texts, least))
            kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)],
                                              names=["block", "size", "payload", "frequent", "marks"])

        for batch in batches:
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                texts.append((text.as_py() or "").encode("utf-8", "replace"))
                ids.append(i)
                size += len(texts[-1])
                if size >= block_bytes:
                    yield block()
                    ids, texts, size, number = [], [], 0, number + 1
        if ids:
            yield block()
    return run


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """name (as a signed number), n of the frequent ranks of each block."""
    for batch in batches:
        for data in batch.column(0).to_pylist():
            both = np.frombuffer(data, np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], names=["name", "n"])


def hot_names(blocks: DataFrame, marks: int) -> np.ndarray:
    """Names of the hot ranks, at most ``MOST_HOT``."""
    found = (blocks.select("frequent").where(F.length("frequent") > 0).mapInArrow(_counts, "name long, n long")
             .groupBy("name").agg(F.sum("n").alias("n")).where(F.col("n") >= max(HOT, marks // MOST_HOT)))
    return np.sort(np.array([r[0] for r in found.select("name").collect()], np.int64).view(_U))


# ---- round 1: ranks and contexts of all anchors -------------------------------

def _narrow(values: np.ndarray) -> tuple[int, bytes]:
    """Non-negative numbers in the fewest of 2, 4 or 8 bytes each."""
    top = int(values.max(initial=0))
    kind = np.uint16 if top < 1 << 16 else np.uint32 if top < 1 << 32 else np.uint64
    return np.dtype(kind).itemsize, values.astype(kind).tobytes()


def _wide(width: int, data: bytes) -> np.ndarray:
    return np.frombuffer(data, {2: np.uint16, 4: np.uint32, 8: np.uint64}[width]).astype(np.int64)


_ROUND1 = "bucket long, block long, base long, width int, docs binary, names binary, contexts binary"
_VERDICT = "block long, bucket long, round int, settled binary, open binary"


def _first_records(buckets: int, hot: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, payload in zip(batch.column(0).to_pylist(), batch.column(1)):
                b = _Block(payload.as_py(), buckets, hot)
                rows = []
                for bucket, s in b.slices():
                    base = int(b.least[s].min())
                    width, docs = _narrow(b.least[s] - base)
                    names = b.name[s].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :NAME_BYTES].tobytes()
                    rows.append((bucket, number, base, width, docs, names, b.context[s].tobytes()))
                if rows:
                    columns = list(zip(*rows))
                    kinds = [pa.int64()] * 3 + [pa.int32()] + [pa.binary()] * 3
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, k) for c, k in zip(columns, kinds)],
                        names=["bucket", "block", "base", "width", "docs", "names", "contexts"])
    return run


def _settle(table: pa.Table, buckets: int) -> pa.Table:
    """Verdicts on one bucket: records whose context has a smaller document, and records that stay open.

    A bucket of hot names sees only some contexts of a name, so all that it does not settle stays open.
    """
    docs = [_wide(w, d) + b for w, d, b in zip(*(table[c].to_pylist() for c in ("width", "docs", "base")))]
    sizes = [len(d) for d in docs]
    doc = np.concatenate(docs)
    packed = np.frombuffer(b"".join(table["names"].to_pylist()), np.uint8).reshape(-1, NAME_BYTES)
    name = np.zeros((len(doc), 8), np.uint8)
    name[:, :NAME_BYTES] = packed
    name = name.view("<u8").ravel()
    context = np.frombuffer(b"".join(table["contexts"].to_pylist()), np.uint64)
    order = np.lexsort((doc, context, name))
    n, c, d = name[order], context[order], doc[order]
    new_name = np.ones(len(order), bool)
    new_name[1:] = n[1:] != n[:-1]
    new_context = new_name.copy()
    new_context[1:] |= c[1:] != c[:-1]
    heads = np.flatnonzero(new_name)
    context_least = d[np.maximum.accumulate(np.where(new_context, np.arange(len(d)), 0))]
    rank_least = np.minimum.reduceat(d, heads)[np.cumsum(new_name) - 1]
    settled = d > context_least
    waiting = ~settled & (d > rank_least)
    in_open = np.logical_or.reduceat(waiting, heads)[np.cumsum(new_name) - 1]
    verdict = np.zeros((2, len(order)), bool)
    verdict[0, order] = settled
    verdict[1, order] = (in_open | (table["bucket"][0].as_py() >= buckets)) & ~settled
    cuts = np.cumsum(sizes)[:-1]
    masks = [[np.packbits(v).tobytes() for v in np.split(row, cuts)] for row in verdict]
    return pa.Table.from_arrays(
        [table["block"], table["bucket"], pa.array([1] * len(sizes), pa.int32()),
         pa.array(masks[0], pa.binary()), pa.array(masks[1], pa.binary())],
        names=["block", "bucket", "round", "settled", "open"])


def _verdicts(b: _Block, answers: pa.Table, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per record: settled, open, and the strings (bits) that round 2 found."""
    settled, open_ = np.zeros((2, len(b.bucket)), bool)
    strings = np.zeros(len(b.bucket), np.uint32)
    where = dict(b.slices())
    found = [dict(zip(answers.column_names, r)) for r in zip(*(c.to_pylist() for c in answers.columns))]
    hot_answers = {}
    for r in sorted(found, key=lambda r: r["round"]):
        if r["round"] == 3:
            hot_answers[r["bucket"]] = r["settled"]
            continue
        s = where[r["bucket"]]
        if r["round"] == 1:
            size = s.stop - s.start
            settled[s] = np.unpackbits(np.frombuffer(r["settled"], np.uint8), count=size).astype(bool)
            open_[s] = np.unpackbits(np.frombuffer(r["open"], np.uint8), count=size).astype(bool)
        else:
            strings[s.start + np.flatnonzero(open_[s])] = np.frombuffer(r["settled"], np.uint32)
    if hot_answers:
        picked, place, key, least, of = _hot_strings(b, open_, buckets)
        bucket = key % _U(buckets)
        later = np.zeros(len(key), bool)
        for k, mask in hot_answers.items():
            here = np.flatnonzero(bucket == _U(k - 2 * buckets))
            later[here] = np.unpackbits(np.frombuffer(mask, np.uint8), count=len(here)).astype(bool)
        gone = later[of] | (b.least[picked] > least[of])
        np.bitwise_or.at(strings, picked[gone], np.uint32(1) << place[gone])
    return settled, open_, strings


# ---- round 2: every string over the anchors that are still open ----------------

_WIDTH = LENGTH + REACH
_ROUND2 = "bucket long, block long, payload binary"


def _contexts(b: _Block, picked: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes around an anchor of each record (0 beyond its document), and how far they reach left and right."""
    mark = b.first[picked]
    left, right = b.left[mark], b.right[mark]
    place = np.arange(_WIDTH) - REACH
    inside = (place >= -left[:, None]) & (place < GRAM + right[:, None])
    text = np.where(inside, b.bytes[np.clip(b.at[mark][:, None] + place, 0, len(b.bytes) - 1)], 0)
    return text.astype(np.uint8), left, right


def _hot_strings(b: _Block, open_: np.ndarray, buckets: int) -> tuple:
    """Strings over the open anchors of hot names.

    Record and place of every string, then the distinct strings in order of
    their names with the least document of each in this block, and for every
    string which of the distinct ones it is.
    """
    picked = np.flatnonzero(open_ & (b.bucket >= buckets))
    text, left, right = _contexts(b, picked)
    rows, places, keys = [], [], []
    for o, key in enumerate(_rolled(text)):
        here = np.flatnonzero((o >= REACH - left) & (o <= right))
        rows.append(picked[here]), places.append(np.full(len(here), o, np.uint32)), keys.append(key[here])
    record, place = np.concatenate(rows), np.concatenate(places)
    names, of = np.unique(np.concatenate(keys), return_inverse=True)
    least = np.full(len(names), np.iinfo(np.int64).max)
    np.minimum.at(least, of, b.least[record])
    return record, place, names, least, of


def _second_records(buckets: int, hot: np.ndarray):
    def run(blocks: pa.Table, answers: pa.Table) -> pa.Table:
        rows = []
        pack = zstandard.ZstdCompressor(level=3).compress
        for number, payload in zip(blocks["block"].to_pylist(), blocks["payload"].to_pylist()):
            b = _Block(payload, buckets, hot)
            _, open_, _ = _verdicts(b, answers, buckets)
            for bucket, s in b.slices():
                picked = s.start + np.flatnonzero(open_[s])
                if not len(picked) or bucket >= buckets:
                    continue
                text, left, right = _contexts(b, picked)
                data = struct.pack("<q", len(picked)) + b"".join(
                    [b.name[picked].tobytes(), b.least[picked].tobytes(), left.astype(np.uint8).tobytes(),
                     right.astype(np.uint8).tobytes(), text.tobytes()])
                rows.append((bucket, number, pack(data)))
            if (open_ & (b.bucket >= buckets)).any():
                _, _, names, least, _ = _hot_strings(b, open_, buckets)
                bucket = (names % _U(buckets)).astype(np.int64)
                for k in np.unique(bucket).tolist():
                    here = bucket == k
                    rows.append((2 * buckets + k, number, pack(names[here].tobytes() + least[here].tobytes())))
        columns = list(zip(*rows)) if rows else [[], [], []]
        return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(columns, [pa.int64(), pa.int64(), pa.binary()])],
                                    names=["bucket", "block", "payload"])
    return run


def _answer(table: pa.Table, kind: int, masks: list[bytes]) -> pa.Table:
    return pa.Table.from_arrays(
        [table["block"], table["bucket"], pa.array([kind] * len(masks), pa.int32()), pa.array(masks, pa.binary()),
         pa.array([b""] * len(masks), pa.binary())], names=["block", "bucket", "round", "settled", "open"])


def _after_least(key: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Which rows a smaller document with the same key precedes."""
    order = np.lexsort((doc, key))
    k, d = key[order], doc[order]
    new = np.ones(len(k), bool)
    new[1:] = k[1:] != k[:-1]
    out = np.empty(len(k), bool)
    out[order] = d > d[np.maximum.accumulate(np.where(new, np.arange(len(d)), 0))]
    return out


def _strings(table: pa.Table, buckets: int) -> pa.Table:
    """Per open record the bits of the strings that a smaller document has too; per string of hot names one bit."""
    unpack = zstandard.ZstdDecompressor().decompress
    parts = []
    if table["bucket"][0].as_py() >= 2 * buckets:
        parts = [np.frombuffer(unpack(p), np.uint64).reshape(2, -1) for p in table["payload"].to_pylist()]
        key, doc = np.concatenate(parts, axis=1)
        later = _after_least(key, doc.view(np.int64))
        cuts = np.cumsum([p.shape[1] for p in parts])[:-1]
        return _answer(table, 3, [np.packbits(x).tobytes() for x in np.split(later, cuts)])
    for payload in table["payload"].to_pylist():
        data = unpack(payload)
        n = struct.unpack_from("<q", data)[0]
        parts.append((np.frombuffer(data, np.uint64, n, 8), np.frombuffer(data, np.int64, n, 8 + 8 * n),
                      np.frombuffer(data, np.uint8, n, 8 + 16 * n), np.frombuffer(data, np.uint8, n, 8 + 17 * n),
                      np.frombuffer(data, np.uint8, n * _WIDTH, 8 + 18 * n).reshape(n, _WIDTH)))
    name, doc, left, right, text = (np.concatenate(x) for x in zip(*parts))
    bits = np.zeros(len(doc), np.uint32)
    for o, key in enumerate(_rolled(text)):
        here = np.flatnonzero((o >= REACH - left.astype(int)) & (o <= right))
        later = _after_least(_mix(key[here], name[here]), doc[here])
        bits[here[later]] |= np.uint32(1 << o)
    cuts = np.cumsum([len(p[0]) for p in parts])[:-1]
    return _answer(table, 2, [x.tobytes() for x in np.split(bits, cuts)])


# ---- result -------------------------------------------------------------------

def _removed(b: _Block, answers: pa.Table, buckets: int) -> np.ndarray:
    """Which bytes of the block go."""
    settled, _, strings = _verdicts(b, answers, buckets)
    change = np.zeros(len(b.bytes) + 1, np.int32)
    # an anchor of a larger document than its record's is settled inside the block
    whole = (settled[b.record] | (b.doc > b.least[b.record])) & (b.left + b.right >= REACH)
    np.add.at(change, (b.at - b.left)[whole], 1)
    np.add.at(change, (b.at + GRAM + b.right)[whole], -1)
    found = np.where(whole, np.uint32(0), strings[b.record])
    for o in range(REACH + 1):
        start = b.at[(found >> np.uint32(o)) & np.uint32(1) == 1] - REACH + o
        np.add.at(change, start, 1)
        np.add.at(change, start + LENGTH, -1)
    return np.cumsum(change[:-1], dtype=np.int32) > 0


def _finish(buckets: int, hot: np.ndarray, texts: bool):
    def run(blocks: pa.Table, answers: pa.Table) -> pa.Table:
        rows = []
        for payload in blocks["payload"].to_pylist():
            b = _Block(payload, buckets, hot)
            gone = _removed(b, answers, buckets)
            opens = gone.copy()
            opens[1:] &= ~gone[:-1]
            filled = b.starts[b.sizes > 0]
            opens[filled] = gone[filled]
            for i, unknown, at, size in zip(b.ids.tolist(), b.unknown, b.starts.tolist(), b.sizes.tolist()):
                part = gone[at:at + size]
                kept = b.bytes[at:at + size][~part].tobytes()
                rows.append((None if unknown else i, size, int(part.sum()), int(opens[at:at + size].sum()),
                             kept if texts else hashlib.sha256(kept).hexdigest()))
        columns = list(zip(*rows)) if rows else [[] for _ in range(5)]
        kinds = [pa.int64()] * 4 + [pa.binary() if texts else pa.string()]
        return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                    names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])
    return run


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", texts: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept per document.

    ``kept``: the SHA-256 of the remaining bytes, or with ``texts`` the bytes themselves.
    """
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = materialize(narrow.mapInArrow(
        _to_blocks(BLOCK_BYTES, FREQUENT), "block long, size long, payload binary, frequent binary, marks long"))
    size, marks = (v or 0 for v in blocks.agg(F.sum("size"), F.sum("marks")).first())
    buckets = max(2 * partitions, -(-size // BUCKET_BYTES))
    hot = hot_names(blocks, marks)
    payloads = blocks.select("block", "payload")
    first = materialize(payloads.mapInArrow(_first_records(buckets, hot), _ROUND1)
                        .groupBy("bucket").applyInArrow(lambda t: _settle(t, buckets), _VERDICT))
    second = (payloads.groupBy("block").cogroup(first.groupBy("block"))
              .applyInArrow(_second_records(buckets, hot), _ROUND2)
              .groupBy("bucket").applyInArrow(lambda t: _strings(t, buckets), _VERDICT))
    answers = first.unionByName(second)
    kind = "binary" if texts else "string"
    return payloads.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        _finish(buckets, hot, texts), f"doc_id long, n_bytes long, n_removed long, n_spans long, kept {kind}")
