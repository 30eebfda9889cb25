"""Quality classifier: an additive model with pairwise interactions (per-feature lookup tables).

A text is described by ``FEATURES`` (counts of its bytes, words and lines;
never its id, language, source or label). Every feature is cut into quantile
bins. Training boosts shallow trees cyclically: each round visits every
feature in turn and adds a small tree over that feature's bins to its lookup
table; then the pairs with the strongest interaction left get lookup tables
over two features in the same way. A score is the logistic of the summed
table entries, so scoring is a few vectorised additions per text.

The model is fitted on at most ``SAMPLE_ROWS`` labelled rows (those with the
smallest id hashes; documents whose id's CRC-32 is divisible by ``FOLDS``
are held out). All documents are scored, whole.

Defined cases: NULL text is the empty text and is scored as such; a NULL id
counts as the empty id text; labels other than 0 and 1 are ignored, and of
several labels of one document the highest holds; without labels every
score is 0.5, with one class it is the smoothed share; an empty table gives
an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass, field
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FEATURES = ["log_bytes", "upper", "symbols", "bars", "marks", "digits", "word_bytes", "distinct_words",
            "top_word", "same_as_last", "stops", "lines", "repeated_lines", "word_ends"]
SAMPLE_ROWS = 20_000
FOLDS = 5
ACCEPT = 0.3
BINS = 32
ROUNDS, RATE, RIDGE = 80, 0.15, 2.0
PAIRS, PAIR_BINS, PAIR_ROUNDS = 6, 8, 20

# byte classes: 0 other, 1 lower letter, 2 upper letter, 3 digit, 4 blank, 5 line end, 6 stop, 7 bar, 8 mark, 9 symbol
_CLASSES = np.zeros(256, np.uint8)
for _chars, _kind in ((b"abcdefghijklmnopqrstuvwxyz", 1), (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", 2), (b"0123456789", 3),
                      (b" \t", 4), (b"\n", 5), (b".,;:'?-", 6), (b"|", 7), (b"!", 8), (b"#$%&*@^~<>{}[]=+_\\/", 9)):
    _CLASSES[list(_chars)] = _kind
_TABLE = _CLASSES.tobytes()


def describe(text: str | None) -> list[float]:
    """``FEATURES`` of one whole text."""
    raw = (text or "").encode("utf-8", "replace")
    n = len(raw)
    kinds = np.bincount(np.frombuffer(raw.translate(_TABLE), np.uint8), minlength=10)
    words, lines = raw.split(), [x for x in raw.split(b"\n") if x]
    many, some = max(1, len(words)), max(1, n)
    counts = Counter(words)
    letters = max(1, int(kinds[1] + kinds[2]))
    ends = Counter(w[-1] for w in words)
    return [float(np.log1p(n)), kinds[2] / letters, kinds[9] / some, kinds[7] / some, kinds[8] / some,
            kinds[3] / some, n / many, len(counts) / many, max(counts.values(), default=0) / many,
            sum(map(eq, words, words[1:])) / many, kinds[6] / some, 1000 * len(lines) / some,
            1 - len(set(lines)) / max(1, len(lines)), max(ends.values(), default=0) / many]


@dataclass
class Model:
    """Bin edges per feature, a table per feature, and a table per pair (over coarser bins)."""

    base: float = 0.0
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int, np.ndarray]] = field(default_factory=list)

    def score(self, features: np.ndarray) -> np.ndarray:
        total = np.full(len(features), self.base)
        for f, (edges, table) in enumerate(zip(self.edges, self.tables)):
            total += table[np.searchsorted(edges, features[:, f], "right")]
        for i, j, table in self.pairs:
            total += table[np.searchsorted(self.coarse[i], features[:, i], "right"),
                           np.searchsorted(self.coarse[j], features[:, j], "right")]
        return 1 / (1 + np.exp(-total))


def _cuts(values: np.ndarray, bins: int) -> np.ndarray:
    """Inner quantile edges, without repeats."""
    return np.unique(np.quantile(values, np.arange(1, bins) / bins))


def _gain(g, h):
    return g * g / (h + RIDGE)


def _best_cut(g: np.ndarray, h: np.ndarray) -> tuple[float, int]:
    """Gain and place of the best split of ordered bins (place 0: none)."""
    if len(g) < 2:
        return 0.0, 0
    left_g, left_h = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    all_g, all_h = g.sum(), h.sum()
    gains = _gain(left_g, left_h) + _gain(all_g - left_g, all_h - left_h) - _gain(all_g, all_h)
    best = int(gains.argmax())
    return (float(gains[best]), best + 1) if gains[best] > 1e-9 else (0.0, 0)


def _line_tree(g: np.ndarray, h: np.ndarray, depth: int = 2) -> np.ndarray:
    """Leaf value per bin of a shallow tree over ordered bins."""
    _, at = _best_cut(g, h) if depth else (0.0, 0)
    if not at:
        return np.full(len(g), g.sum() / (h.sum() + RIDGE))
    return np.concatenate([_line_tree(g[:at], h[:at], depth - 1), _line_tree(g[at:], h[at:], depth - 1)])


def _plane_tree(g: np.ndarray, h: np.ndarray, depth: int = 2) -> np.ndarray:
    """The same over a plane of bins; every split picks the better axis."""
    cuts = [_best_cut(g.sum(axis=1 - a), h.sum(axis=1 - a)) for a in (0, 1)] if depth else [(0.0, 0)] * 2
    axis = int(cuts[1][0] > cuts[0][0])
    at = cuts[axis][1]
    if not at:
        return np.full(g.shape, g.sum() / (h.sum() + RIDGE))
    parts = [_plane_tree(a, b, depth - 1) for a, b in zip(np.split(g, [at], axis), np.split(h, [at], axis))]
    return np.concatenate(parts, axis)


def _interaction(g: np.ndarray, h: np.ndarray) -> float:
    """Largest gain of four quadrants over the whole plane."""
    sums = [np.cumsum(np.cumsum(x, 0), 1) for x in (g, h)]
    if min(g.shape) < 2:
        return 0.0
    total = 0.0
    quarters = []
    for s in sums:
        a = s[:-1, :-1]
        top, left, whole = s[:-1, -1:], s[-1:, :-1], s[-1, -1]
        quarters.append((a, top - a, left - a, whole - top - left + a))
    for qg, qh in zip(*quarters):
        total = total + _gain(qg, qh)
    return float(np.max(total)) - float(_gain(sums[0][-1, -1], sums[1][-1, -1]))


def fit(features: np.ndarray, labels: np.ndarray) -> Model:
    """Boost the lookup tables on rows of ``features`` with 0/1 ``labels``."""
    n = len(labels)
    if not n:
        return Model()
    share = (labels.sum() + 0.5) / (n + 1)
    model = Model(base=float(np.log(share / (1 - share))))
    if len(np.unique(labels)) < 2:
        return model
    count = features.shape[1]
    model.edges = [_cuts(features[:, f], BINS) for f in range(count)]
    model.coarse = [_cuts(features[:, f], PAIR_BINS) for f in range(count)]
    bins = [np.searchsorted(e, features[:, f], "right") for f, e in enumerate(model.edges)]
    wide = [np.searchsorted(e, features[:, f], "right") for f, e in enumerate(model.coarse)]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    total = np.full(n, model.base)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        return labels - p, p * (1 - p)

    for _ in range(ROUNDS):
        for f in range(count):
            g, h = slopes()
            size = len(model.tables[f])
            step = RATE * _line_tree(np.bincount(bins[f], g, size), np.bincount(bins[f], h, size))
            model.tables[f] += step
            total += step[bins[f]]

    def plane(i: int, j: int, values: np.ndarray) -> np.ndarray:
        rows, columns = len(model.coarse[i]) + 1, len(model.coarse[j]) + 1
        return np.bincount(wide[i] * columns + wide[j], values, rows * columns).reshape(rows, columns)

    g, h = slopes()
    ranked = sorted(((_interaction(plane(i, j, g), plane(i, j, h)), i, j)
                     for i in range(count) for j in range(i)), reverse=True)[:PAIRS]
    model.pairs = [(i, j, np.zeros((len(model.coarse[i]) + 1, len(model.coarse[j]) + 1))) for _, i, j in ranked]
    for _ in range(PAIR_ROUNDS):
        for i, j, table in model.pairs:
            g, h = slopes()
            step = RATE * _plane_tree(plane(i, j, g), plane(i, j, h))
            table += step
            total += step[wide[i], wide[j]]
    return model


def held_out(id_col: str = "doc_id") -> Column:
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % FOLDS == 0


def _feature_rows(texts: pa.Array) -> np.ndarray:
    return np.array([describe(t.as_py()) for t in texts], dtype=np.float64).reshape(-1, len(FEATURES))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", sample_rows: int = SAMPLE_ROWS) -> Model:
    """Fit on a bounded sample of the labelled documents that are not held out."""
    known = (labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & ~held_out(id_col))
             .groupBy(id_col).agg(F.max(label_col).alias("_label")))
    chosen = known.orderBy(F.xxhash64(id_col), id_col).limit(sample_rows)
    rows = docs.select(id_col, F.col(text_col).alias("_text")).join(F.broadcast(chosen), id_col)  # bounded sample
    described = F.arrow_udf(
        lambda texts: pa.array(list(_feature_rows(texts)), pa.list_(pa.float64())), "array<double>")
    sample = rows.select("_label", described("_text").alias("features")).toArrow()
    if not sample.num_rows:
        return Model()
    return fit(np.array(sample["features"].to_pylist()), sample["_label"].to_numpy().astype(np.float64))


def scorer(model: Model) -> Callable[[Column | str], Column]:
    """A column function: whole text to score (0 to 1)."""
    return F.arrow_udf(lambda texts: pa.array(model.score(_feature_rows(texts)), pa.float64()), "double")


def score_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, held_out, score, predicted per document (no shuffle)."""
    model = train(docs, labels, id_col, text_col, sample_rows=sample_rows)
    scored = docs.select(F.col(id_col).alias("doc_id"), scorer(model)(F.col(text_col)).alias("score"))
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score",
                         (F.col("score") >= ACCEPT).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The rows of ``docs`` whose score reaches ``ACCEPT``, with all their columns."""
    model = train(docs, labels, id_col, text_col, sample_rows=sample_rows)
    return docs.where(scorer(model)(F.col(text_col)) >= ACCEPT)
