"""Exact top-k inner products by a pivot-distance index.

Inner products become distances: with ``M`` the largest norm, every vector
gets one more component ``sqrt(M^2 - |x|^2)`` and every query a zero, so
``q.x = (|q|^2 + M^2 - d(q, x)^2) / 2`` and the nearest vectors are the best.
Each vector is keyed by its nearest pivot and its distance to it. Cells are
annuli of that distance, sorted per pivot; a directory keeps their distance
range and size (``PIVOTS * RINGS`` rows at most, whatever the input).

A query first visits the annuli around its own distance from the nearest
pivots until they hold enough vectors, which gives a bound for its k-th
score; then it expands to every annulus whose triangle-inequality bound
still reaches that score, and to no other. Cells are cut into chunks of
about ``CHUNK`` vectors and the queries that visit a cell into parts of about
``VISITORS`` by hashes, so no cell, no vector that many rows share and no crowd
of queries is held by one task; the best of all parts are merged. Cells that
no query visits are not moved.

The pivots are fitted on at most ``SAMPLE`` vectors (smallest id hashes);
every vector is indexed, and the result is exact.

Defined cases: vectors that are NULL or hold NULL or non-finite components,
and rows with a NULL id, take no part; shorter vectors are padded with
zeros; every row is a candidate, repeats too, except rows with the query's
id; rows of one id are one query, with the least of their scaled vectors; an
empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from critiq.session import materialize

PIVOTS, RINGS = 24, 12
SAMPLE = 4096
CHUNK = 4096
VISITORS = 8192
SCALE = 256.0


def _scaled(lists: pa.Array, width: int) -> np.ndarray:
    """Rows of ``floor(SCALE * x)`` as doubles, padded to ``width``."""
    out = np.zeros((len(lists), width))
    sizes = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    rows = np.repeat(np.arange(len(lists)), sizes)
    places = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out[rows, places] = np.floor(SCALE * flat)
    return out


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """vec_id, embedding of the rows that take part."""
    v = F.col(vector_col)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x.cast("double"))
                      & (F.abs(x.cast("double")) < float("inf")))
    return vectors.where(F.col(id_col).isNotNull() & v.isNotNull() & finite).select(
        F.col(id_col).cast("long").alias("vec_id"), v.cast("array<double>").alias("embedding"))


@dataclass
class Index:
    """Pivots (augmented), ring width, largest squared norm, and the directory of annuli."""

    width: int
    top: float
    pivots: np.ndarray
    ring: float
    cells: np.ndarray | None = None   # cell numbers with vectors
    low: np.ndarray | None = None     # their least and greatest distance, and size
    high: np.ndarray | None = None
    size: np.ndarray | None = None

    def lift(self, x: np.ndarray) -> np.ndarray:
        return np.column_stack([x, np.sqrt(np.maximum(0.0, self.top - (x * x).sum(axis=1)))])

    def distances(self, lifted: np.ndarray) -> np.ndarray:
        square = (lifted ** 2).sum(1)[:, None] - 2 * lifted @ self.pivots.T + (self.pivots ** 2).sum(1)
        return np.sqrt(np.maximum(square, 0.0))

    def key(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cell and pivot distance of each vector."""
        far = self.distances(self.lift(x))
        nearest = far.argmin(axis=1)
        r = far[np.arange(len(x)), nearest]
        return nearest * RINGS + np.minimum(RINGS - 1, r / self.ring).astype(np.int64), r

    def reach(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per query and annulus: least possible distance, and the best score that allows."""
        far = self.distances(np.column_stack([queries, np.zeros(len(queries))]))[:, self.cells // RINGS]
        least = np.maximum(0.0, np.maximum(far - self.high, self.low - far))
        norms = (queries ** 2).sum(1)[:, None]
        # rounding of the distances never hides a reachable annulus
        slack = 1e-6 * (self.top + norms + 1.0)
        return least, (norms + self.top - least ** 2) / 2 + slack

    def chunks(self) -> np.ndarray:
        return -(-self.size // CHUNK)


def _pivots(sample: np.ndarray, count: int) -> np.ndarray:
    """Spread-out starts, then a few rounds of nearest-pivot means."""
    chosen = [sample[0]]
    near = ((sample - chosen[0]) ** 2).sum(1)
    while len(chosen) < min(count, len(sample)) and near.max() > 0:
        chosen.append(sample[int(near.argmax())])
        near = np.minimum(near, ((sample - chosen[-1]) ** 2).sum(1))
    pivots = np.array(chosen)
    for _ in range(5):
        own = ((sample ** 2).sum(1)[:, None] - 2 * sample @ pivots.T + (pivots ** 2).sum(1)).argmin(1)
        pivots = np.array([sample[own == p].mean(0) if (own == p).any() else pivots[p] for p in range(len(pivots))])
    return pivots


def build_index(rows: DataFrame) -> Index | None:
    """Fit the pivots on the sample and take the directory of all vectors; None without vectors."""
    width = rows.agg(F.max(F.size("embedding"))).first()[0]
    if not width:
        return None

    def norms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _scaled(batch.column(1), width)
            yield pa.RecordBatch.from_arrays([pa.array((x * x).sum(axis=1))], names=["norm"])

    top = rows.mapInArrow(norms, "norm double").agg(F.max("norm")).first()[0]
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("vec_id", "embedding").toArrow()
    index = Index(width, top, np.zeros((1, width + 1)), 1.0)
    lifted = index.lift(_scaled(sample["embedding"].combine_chunks(), width))
    index.pivots = _pivots(lifted, PIVOTS)
    index.ring = max(1e-9, float(index.distances(lifted).min(axis=1).max()) / RINGS)

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell, r = index.key(_scaled(batch.column(1), width))
            yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(r)], names=["cell", "r"])

    found = (rows.mapInArrow(keys, "cell long, r double").groupBy("cell")
             .agg(F.min("r").alias("low"), F.max("r").alias("high"), F.count(F.lit(1)).alias("size"))
             .orderBy("cell").toArrow())  # at most PIVOTS * RINGS rows
    index.cells, index.low, index.high, index.size = (found[c].to_numpy() for c in ("cell", "low", "high", "size"))
    return index


def _keyed(rows: DataFrame, index: Index, parts: dict[int, int]) -> DataFrame:
    """cell, chunk, part, vec_id, vector (packed doubles): every vector once for each part of its cell's visitors."""
    chunks = dict(zip(index.cells.tolist(), index.chunks().tolist()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _scaled(batch.column(1), index.width)
            cell, _ = index.key(x)
            times = np.array([parts.get(c, 0) for c in cell.tolist()], np.int64)
            n = np.array([chunks.get(c, 1) for c in cell.tolist()], np.int64)
            mixed = batch.column(0).to_numpy().astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
            chunk = (mixed >> np.uint64(33)).astype(np.int64) % np.maximum(n, 1)
            for part in range(int(times.max(initial=0))):
                here = np.flatnonzero(times > part)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cell[here]), pa.array(chunk[here]), pa.array(np.full(len(here), part)),
                     batch.column(0).take(pa.array(here)), pa.array([x[i].tobytes() for i in here], pa.binary())],
                    names=["cell", "chunk", "part", "vec_id", "vector"])

    return rows.mapInArrow(run, "cell long, chunk long, part long, vec_id long, vector binary")


def _reached(batch: pa.RecordBatch, index: Index, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The scaled vectors of a batch of queries, and the pairs (row, annulus) that they visit.

    Queries without a ``bound`` column visit the annuli nearest to them
    that together hold more than ``k`` vectors; those with one, every other
    annulus whose best possible score reaches the bound.
    """
    x = _scaled(batch.column(1), index.width)
    least, best = index.reach(x)
    order = np.argsort(least, axis=1, kind="stable")
    held = np.cumsum(index.size[order], axis=1) - index.size[order]
    open_ = np.zeros(least.shape, bool)
    np.put_along_axis(open_, order, held <= k, axis=1)
    if "bound" in batch.schema.names:
        bound = batch.column("bound").to_numpy(zero_copy_only=False).astype(np.float64)
        open_ = ~open_ & (np.isnan(bound)[:, None] | (best >= bound[:, None]))
    return x, *np.nonzero(open_)


def _parts(queries: DataFrame, index: Index, k: int) -> dict[int, int]:
    """Parts of about ``VISITORS`` queries for each visited cell."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells, n = np.unique(_reached(batch, index, k)[2], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(index.cells[cells]), pa.array(n)], names=["cell", "n"])

    found = queries.mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    return {r["cell"]: -(-r["n"] // VISITORS) for r in found.collect()}  # at most PIVOTS * RINGS rows


def _visits(queries: DataFrame, index: Index, k: int, parts: dict[int, int]) -> DataFrame:
    """cell, chunk, part, query_id, vector of every visit."""
    chunks = index.chunks()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, query, place = _reached(batch, index, k)
            mixed = batch.column(0).to_numpy().astype(np.uint64) * np.uint64(0xBF58476D1CE4E5B9)
            drawn = (mixed >> np.uint64(33)).astype(np.int64)
            for at in range(0, len(query), 4096):
                q, p = query[at:at + 4096], place[at:at + 4096]
                times = chunks[p]
                q, cell = np.repeat(q, times), np.repeat(index.cells[p], times)
                chunk = np.arange(len(q)) - np.repeat(np.cumsum(times) - times, times)
                part = drawn[q] % np.array([parts[c] for c in cell.tolist()], np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cell), pa.array(chunk), pa.array(part), batch.column(0).take(pa.array(q)),
                     pa.array([x[i].tobytes() for i in q], pa.binary())],
                    names=["cell", "chunk", "part", "query_id", "vector"])

    return queries.mapInArrow(run, "cell long, chunk long, part long, query_id long, vector binary")


def _scores(data: pa.Table, asked: pa.Table, width: int, k: int) -> pa.Table:
    """Best ``k`` vectors of one chunk for each visiting query."""
    out: list[tuple] = []
    if data.num_rows and asked.num_rows:
        x = np.frombuffer(b"".join(data["vector"].to_pylist())).reshape(-1, width)
        ids = data["vec_id"].to_numpy()
        order = np.argsort(ids, kind="stable")  # ties go to smaller ids
        x, ids = x[order], ids[order]
        names = asked["query_id"].to_numpy()
        vectors = asked["vector"].to_pylist()
        for at in range(0, len(names), 512):
            scores = np.frombuffer(b"".join(vectors[at:at + 512])).reshape(-1, width) @ x.T
            for q, s in zip(names[at:at + 512], scores):
                s = np.where(ids == q, -np.inf, s)
                if len(s) > k:
                    least = np.partition(s, len(s) - k)[len(s) - k]
                    above, equal = np.flatnonzero(s > least), np.flatnonzero(s == least)
                    chosen = np.concatenate([above, equal[:k - len(above)]])
                else:
                    chosen = np.arange(len(s))
                out += [(q, ids[i], int(s[i])) for i in chosen if s[i] != -np.inf]
    columns = list(zip(*out)) if out else [[], [], []]
    return pa.Table.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["query_id", "vec_id", "score"])


def _visit(queries: DataFrame, rows: DataFrame, index: Index, k: int) -> DataFrame:
    width, keys = index.width, ["cell", "chunk", "part"]
    parts = _parts(queries, index, k)
    met = _keyed(rows, index, parts).groupBy(*keys).cogroup(
        _visits(queries, index, k, parts).groupBy(*keys)).applyInArrow(
        lambda a, b: _scores(a, b, width, k), "query_id long, vec_id long, score long")
    return _best(met, k)


def _best(scored: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("vec_id"))
    ranked = scored.select("query_id", "vec_id", "score", F.row_number().over(w).alias("rank"))
    return ranked.where(F.col("rank") <= k)


def top_k(vectors: DataFrame, k: int = 5, every: int = 50, id_col: str = "vec_id",
          vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` best other rows for each row whose id is divisible by ``every``."""
    rows = usable(vectors, id_col, vector_col)
    index = build_index(rows)
    if index is None:
        return rows.select(F.col("vec_id").alias("query_id"), F.lit(1).alias("rank"), "vec_id",
                           F.lit(0).cast("long").alias("score")).where(F.lit(False))
    scaled = F.transform("embedding", lambda x: F.floor(x * SCALE))
    queries = rows.where(F.col("vec_id") % every == 0).groupBy(F.col("vec_id").alias("query_id")).agg(
        F.min_by("embedding", scaled).alias("embedding"))
    queries = materialize(queries)
    near = materialize(_visit(queries, rows, index, k).drop("rank"))  # k rows per query
    bounds = near.groupBy("query_id").agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).alias("bound"))
    bounded = materialize(queries.join(bounds, "query_id", "left").select("query_id", "embedding", "bound"))
    rest = _visit(bounded, rows, index, k)
    found = _best(near.unionByName(rest.drop("rank")), k)
    return found.select("query_id", "rank", "vec_id", "score")
