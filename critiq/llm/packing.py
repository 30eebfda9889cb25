"""Best-two-fit packing of tokenised documents into sequences of bounded length.

A document is its token ids and one end id. Only a document longer than a
sequence is cut, into full pieces and a shorter last one. Pieces are dealt
by a hash into packing groups of about ``GROUP_PIECES`` pieces (however many
documents they come from), and each group is packed on its own: a bin is filled greedily with the longest piece
that still fits; if a gap is left, the bin's smallest piece is taken out and
replaced by the two unpacked pieces that fill the expanded gap most tightly,
if they fill it better. A group leaves about one open bin, so the groups
cost about one sequence in several thousand pieces.

The ids are those of the tokenizers library; they come from the automaton of
``bpe``, which gives equal ids in a fraction of the time.

Defined cases: NULL or empty text is the end id alone; repeated rows are
packed each; NULL ids are kept; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from critiq.llm.bpe import Encoder, token_arrays, worker_encoder
from critiq.session import materialize

SEQUENCE = 2048
END_ID = 0
GROUP_PIECES = 8192


def token_pieces(docs: DataFrame, tokenizer_path: str, limit: int = SEQUENCE, id_col: str = "doc_id",
                 text_col: str = "text", share: bool = True) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32: the cut token sequences of every document (no shuffle).

    With ``share`` the tasks of one Python worker share an encoder, which an idle worker holds until it ends;
    without, every task makes its own and drops it, for jobs whose later stages need the memory.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = None
        for batch in batches:
            encoder = encoder or (worker_encoder if share else Encoder)(tokenizer_path)
            rows = []
            for i, tokens in enumerate(token_arrays(encoder, (text.as_py() for text in batch.column(1)))):
                ids = tokens.astype("<u4").tobytes() + END_ID.to_bytes(4, "little")
                for k, at in enumerate(range(0, len(ids), 4 * limit)):
                    piece = ids[at:at + 4 * limit]
                    rows.append((i, k, at // 4, len(piece) // 4, zlib.crc32(piece)))
            own, piece, start, length, crc = zip(*rows) if rows else ([], [], [], [], [])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(own, pa.int64())), pa.array(piece, pa.int32()),
                 pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                names=["doc_id", "piece", "start", "length", "ids_crc32"])

    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = narrow.schema["doc_id"].dataType.simpleString()
    return narrow.mapInArrow(run, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


def best_two_fit(lengths: list[int], limit: int = SEQUENCE) -> list[list[int]]:
    """Bins (lists of places in ``lengths``) of total length at most ``limit``."""
    pool: dict[int, list[int]] = {}
    for i, n in enumerate(lengths):
        if not 0 < n <= limit:
            raise ValueError(f"length {n} is not in 1..{limit}")
        pool.setdefault(n, []).append(i)
    sizes = sorted(pool)  # lengths with unpacked pieces

    def take(n: int) -> int:
        place = pool[n].pop()
        if not pool[n]:
            sizes.pop(bisect_right(sizes, n) - 1)
        return place

    bins = []
    while sizes:
        n = sizes[-1]
        chosen, gap = [(n, take(n))], limit - n
        while gap:
            k = bisect_right(sizes, gap)
            if not k:
                break
            n = sizes[k - 1]
            chosen.append((n, take(n)))
            gap -= n
        if gap and sizes:
            smallest = min(chosen)
            pair = _best_pair(sizes, pool, gap + smallest[0], smallest[0])
            if pair:
                chosen.remove(smallest)
                chosen += [(n, take(n)) for n in pair]
                if smallest[0] not in pool or not pool[smallest[0]]:
                    sizes.insert(bisect_right(sizes, smallest[0]), smallest[0])
                pool.setdefault(smallest[0], []).append(smallest[1])
        bins.append([place for _, place in chosen])
    return bins


def _best_pair(sizes: list[int], pool: dict[int, list[int]], room: int, least: int) -> tuple[int, int] | None:
    """Two unpacked lengths whose sum is the largest in ``least + 1 .. room``."""
    fit = np.array(sizes[:bisect_right(sizes, room - sizes[0])], dtype=np.int64)
    if not len(fit):
        return None
    partner = np.searchsorted(fit, room - fit, "right") - 1
    # a length pairs with itself only if two pieces have it
    alone = np.array([len(pool[n]) < 2 for n in fit.tolist()])
    own = partner == np.arange(len(fit))
    partner = np.where(own & alone, partner - 1, partner)
    sums = np.where(partner >= 0, fit + fit[partner], 0)
    best = int(sums.argmax())
    if sums[best] <= least:
        return None
    return int(fit[best]), int(fit[partner[best]])


def _pack_group(table: pa.Table, limit: int) -> pa.Table:
    table = table.sort_by([(c, "ascending") for c in ("length", "doc_id", "piece", "ids_crc32")])
    group = table["_group"][0].as_py()
    lengths = table["length"].to_pylist()
    sequence, offset = [0] * len(lengths), [0] * len(lengths)
    for number, places in enumerate(best_two_fit(lengths, limit)):
        at = 0
        for place in places:
            sequence[place], offset[place] = (group << 32) + number, at
            at += lengths[place]
    columns = [table[c] for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
    return pa.Table.from_arrays([*columns, pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())],
                                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])


def pack(pieces: DataFrame, groups: int, limit: int = SEQUENCE) -> DataFrame:
    """``pieces`` (doc_id, piece, start, length, ids_crc32) with sequence_id and offset."""
    dealt = pieces.withColumn("_group", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(groups)))
    kind = pieces.schema["doc_id"].dataType.simpleString()
    return dealt.groupBy("_group").applyInArrow(
        lambda table: _pack_group(table, limit),
        f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer_path: str, limit: int = SEQUENCE, group_pieces: int = GROUP_PIECES,
                   id_col: str = "doc_id", text_col: str = "text", share: bool = True) -> DataFrame:
    """Tokenise, cut and pack all documents; one row per piece.

    The pieces (a few numbers each) are written once: their count sets the number of groups, so the pieces of very
    long documents are spread like any others.
    """
    pieces = materialize(token_pieces(docs, tokenizer_path, limit, id_col, text_col, share))
    return pack(pieces, max(1, -(-pieces.count() // group_pieces)), limit)
