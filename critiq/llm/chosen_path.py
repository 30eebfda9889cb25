"""Near-duplicate groups by a chosen-path set similarity join.

Every document is its set of word shingles. In each of ``TREES``
independent trees a document follows one path: at every level it goes to
the child named by its minwise shingle under that level's hash. Two sets of
similarity ``J`` share a path of ``DEPTH`` levels with probability
``J^DEPTH``, so a pair at the threshold meets in no node with probability
``(1 - 0.8^4)^20``, about 3 in 100,000, and a more alike pair far more
rarely. Every pair that meets is compared, or lies in one group already:

* A node with at most ``LEAF`` documents gives all its pairs as candidates.
* A larger one first links its documents to one of them, drawn by a hash,
  and the confirmed links are contracted. A node that is one group then is
  done. Of the others, small work is compared exhaustively: the documents
  outside the node's largest group against all of the node, if these are at
  most ``EXHAUSTIVE`` comparisons. The rest branches on, recursively: every
  document goes to ``BRANCHES`` children, each named by its minwise shingles
  under ``STEP`` further hashes, until a node is small, one group or a single
  document.

Two sets at the threshold share ``BRANCHES * 0.8^STEP`` = 1.28 children of
each node they share, on average, so the tree of their common nodes grows
while that of unlike documents dies out: it ends early with a probability of
0.32 per node, and a pair at the threshold is missed with at most
``(1 - 0.8^4 * 0.68)^20`` = 0.14 % however deep its nodes are. Nodes that are
still large after ``ROUNDS`` levels of branching are compared exhaustively,
so that depth loses no link. Exhaustive comparison is dealt into parts of
bounded size, and only links between different groups leave a part.

Candidates are cut by set size and by a sketch whose estimate would have to
be off by six standard errors to lose a link, and confirmed on full sets.
Only links between different groups change the result: first each document
is confirmed with its most alike candidate, then only those candidates that
still lie in different groups. Equal sets are one class with one
representative throughout.

Defined cases: a text without words (NULL, empty, blanks) has an empty set
and is linked with nothing; fewer words than a shingle are one shingle; rows
that share a doc_id are one document; rows with a NULL doc_id stay alone
(component NULL, kept); an empty table gives an empty result; other columns
are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from critiq.llm.components import components
from critiq.session import materialize

TREES = 20
DEPTH = 4
LEAF = 32
SKETCH = 64
SKETCH_LEAST = 0.5
LIKE = 80  # per cent
EXHAUSTIVE = 1 << 20  # comparisons up to which a node is not branched further
STEP = 2
BRANCHES = 2
ROUNDS = 12
_WORDS_KEPT = 150_000
_BLOCK = 512
_PART = 1 << 19  # shingles of a part that is compared exhaustively
_MIX = np.uint64(0xBF58476D1CE4E5B9)


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= _WORDS_KEPT:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


_hashes = _WordHashes()
_rng = np.random.default_rng(77001)
_A = _rng.integers(0, 2 ** 64, (TREES * DEPTH, 1), dtype=np.uint64) | np.uint64(1)
_B = _rng.integers(0, 2 ** 64, (TREES * DEPTH, 1), dtype=np.uint64)
_SALT = _rng.integers(0, 2 ** 64, TREES, dtype=np.uint64)
_A_ON = _rng.integers(0, 2 ** 64, (ROUNDS, STEP * BRANCHES, 1), dtype=np.uint64) | np.uint64(1)
_B_ON = _rng.integers(0, 2 ** 64, (ROUNDS, STEP * BRANCHES, 1), dtype=np.uint64)


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles: ASCII lower-cased words between ASCII blanks."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    table = _hashes
    w = np.fromiter([table[x] for x in words], np.uint64, len(words))
    size = min(size, len(w))
    n = len(w) - size + 1
    out = w[:n].copy()
    for i in range(1, size):
        out *= _MIX
        out ^= out >> np.uint64(31)
        out += w[i:i + n]
    out *= _MIX
    out ^= out >> np.uint64(29)
    return np.unique(out)


def _minwise(shingles: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    low = np.full(len(a), 0xFFFFFFFF, np.uint64)
    x = shingles & np.uint64(0xFFFFFFFF)
    for at in range(0, len(x), _BLOCK):
        hashed = a * x[at:at + _BLOCK]
        hashed += b
        np.minimum(low, hashed.min(axis=1) >> np.uint64(32), out=low)
    return low


def _names(levels: np.ndarray, salt: np.ndarray) -> np.ndarray:
    """Node names after the minwise shingles of ``levels`` (level by tree)."""
    node = salt.copy()
    for level in levels:
        node = (node ^ (level + np.uint64(0x9E3779B97F4A7C15))) * _MIX
        node ^= node >> np.uint64(31)
    return node.view(np.int64)


def paths(shingles: np.ndarray) -> tuple[np.ndarray, bytes]:
    """Node names (one per tree) at the first ``DEPTH`` levels, and the sketch."""
    low = _minwise(shingles, _A, _B)
    return _names(low.reshape(DEPTH, TREES), _SALT), (low[:SKETCH] & np.uint64(255)).astype(np.uint8).tobytes()


def _describe(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, n_shingles, set_key, nodes (one name per tree), sketch per row."""
    names = ["doc_id", "n_shingles", "set_key", "nodes", "sketch"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column(1):
                s = shingle_set(text.as_py(), size)
                if len(s):
                    nodes, sketch = paths(s)
                    rows.append((len(s), hashlib.blake2b(s.tobytes(), digest_size=16).digest(), nodes, sketch))
                else:
                    rows.append((0, None, None, None))
            columns = list(zip(*rows)) if rows else [[] for _ in names[1:]]
            kinds = [pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(list(c), k) for c, k in zip(columns, kinds)]], names=names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"doc_id {kind}, n_shingles long, set_key binary, nodes array<long>, sketch binary")


def _pair(x: str, y: str) -> list:
    """a, na, b, nb of two (id, size) structs, the smaller id first."""
    swap = F.col(f"{x}.id") > F.col(f"{y}.id")
    lo = F.when(swap, F.col(y)).otherwise(F.col(x))
    hi = F.when(swap, F.col(x)).otherwise(F.col(y))
    return [lo["id"].alias("a"), lo["n"].alias("na"), hi["id"].alias("b"), hi["n"].alias("nb")]


def _candidates(reps: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Candidates a < b with a size ratio that allows a link, and the members (node, id, n) of the large nodes."""
    rows = reps.select(F.struct(F.col("doc_id").alias("id"), F.col("n_shingles").alias("n")).alias("d"),
                       F.explode("nodes").alias("node")).distinct()
    ranked = F.struct(F.xxhash64("d.id", "node").alias("h"), F.col("d"))
    nodes = materialize(rows.groupBy("node").agg(F.count(F.lit(1)).alias("size"), F.min(ranked).alias("_first"))
                        .where("size > 1").select("node", "size", F.col("_first.d").alias("center")))
    met = materialize(rows.join(nodes, "node"))
    small = met.where(F.col("size") <= LEAF).groupBy("node").agg(F.collect_list("d").alias("all"))  # at most LEAF
    found = (small.select(F.col("all"), F.posexplode("all").alias("i", "x"))
             .select("x", F.explode(F.slice("all", F.col("i") + 2, LEAF)).alias("y")).select(*_pair("x", "y")))
    large = met.where(F.col("size") > LEAF)
    pairs = found.unionByName(large.select(*_pair("d", "center")))
    fits = 100 * F.least("na", "nb") >= LIKE * F.greatest("na", "nb")
    return pairs.where((F.col("a") < F.col("b")) & fits).select("a", "b").distinct(), large.select("node", "d.*")


def _alike(x: pa.Array, y: pa.Array) -> pa.Array:
    both = [np.frombuffer(b"".join(v.to_pylist()), np.uint8).reshape(-1, SKETCH) for v in (x, y)]
    return pa.array((both[0] == both[1]).mean(axis=1), pa.float64())


def _confirm(pairs: DataFrame, texts: DataFrame, size: int, like: int) -> DataFrame:
    """The rows of ``pairs`` (a, b) whose full sets are alike."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, kept = None, None
        for batch in batches:
            good = []
            for a, x, y in zip(batch.column(0).to_pylist(), batch.column(2), batch.column(3)):
                if a != last:
                    last, kept = a, shingle_set(x.as_py(), size)
                other = shingle_set(y.as_py(), size)
                both = len(np.intersect1d(kept, other, assume_unique=True))
                good.append(100 * both >= like * (len(kept) + len(other) - both))
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    met = (pairs.join(texts.select(F.col("id").alias("a"), F.col("text").alias("x")), "a")
           .join(texts.select(F.col("id").alias("b"), F.col("text").alias("y")), "b").select("a", "b", "x", "y"))
    kind = texts.schema["id"].dataType.simpleString()
    return met.mapInArrow(run, f"a {kind}, b {kind}")


def _sets(texts: DataFrame, size: int) -> DataFrame:
    """id, set (the bytes of the sorted shingle hashes) of each row (id, text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array([shingle_set(t.as_py(), size).tobytes() for t in batch.column(1)], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), found], names=["id", "set"])

    return texts.mapInArrow(run, f"id {texts.schema['id'].dataType.simpleString()}, set binary")


def _links_of_part(table: pa.Table, like: int) -> pa.Table:
    """Links (a, b) that connect what is alike of the part's open documents and its members, one per pair of groups."""
    side = np.array(table.column("open").to_pylist(), bool)
    opened, members = np.flatnonzero(side), np.flatnonzero(~side)
    ids, groups = table.column("id"), table.column("component")
    a, b = [], []
    if len(opened) and len(members):
        code = {c: i for i, c in enumerate(dict.fromkeys(groups.to_pylist()))}
        group = np.array([code[c] for c in groups.to_pylist()])  # relabelled as groups are linked
        raw = table.column("set")
        held = [np.frombuffer(raw[int(i)].as_py(), np.uint64) for i in members]
        n = np.array([len(x) for x in held])
        starts = np.concatenate([[0], np.cumsum(n)[:-1]])
        names, codes = np.unique(np.concatenate(held), return_inverse=True)
        marked = np.zeros(len(names), np.int32)
        for i in opened:
            apart = group[members] != group[i]
            if not apart.any():
                continue
            mine = np.frombuffer(raw[int(i)].as_py(), np.uint64)
            at = np.minimum(np.searchsorted(names, mine), len(names) - 1)
            at = at[names[at] == mine]
            marked[at] = 1
            both = np.add.reduceat(marked[codes], starts)
            marked[at] = 0
            good = members[apart & (100 * both >= like * (len(mine) + n - both))]
            for g, k in zip(*np.unique(group[good], return_index=True)):
                a.append(i)
                b.append(good[k])
                group[group == g] = group[i]
    take = [pa.array(x, pa.int64()) for x in (a, b)]
    return pa.table({"a": ids.take(take[0]), "b": ids.take(take[1])})


def _children(sets: DataFrame, level: int) -> DataFrame:
    """id, steps: per row of ``sets``, what names its ``BRANCHES`` children at a level of branching."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            steps = [_names(_minwise(np.frombuffer(raw.as_py(), np.uint64), _A_ON[level], _B_ON[level])
                            .reshape(STEP, BRANCHES), _SALT[:BRANCHES]) for raw in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(steps, pa.list_(pa.int64()))],
                                             names=["id", "steps"])

    return sets.mapInArrow(run, f"id {sets.schema['id'].dataType.simpleString()}, steps array<long>")


def _rated(members: DataFrame) -> DataFrame:
    """node, most, left, right, work of every node that holds several groups.

    ``most``: its largest group; ``work``: comparisons of the documents
    outside it with all of the node, dealt into ``left`` by ``right`` parts.
    """
    held = members.groupBy("node", "component").agg(F.count(F.lit(1)).alias("n"), F.sum("n").alias("shingles"))
    nodes = held.groupBy("node").agg(
        F.count(F.lit(1)).alias("groups"), F.sum("n").alias("docs"), F.sum("shingles").alias("shingles"),
        F.max(F.struct("n", "component", "shingles")).alias("most")).where("groups > 1")
    parts = [F.ceil(n / _PART).alias(name) for n, name in (
        (F.col("shingles") - F.col("most.shingles"), "left"), (F.col("shingles"), "right"))]
    work = (F.col("docs") - F.col("most.n")).cast("double") * F.col("docs")
    return nodes.select("node", F.col("most.component").alias("most"), *parts, work.alias("work"))


def _leaves(members: DataFrame, nodes: DataFrame, sets: DataFrame) -> DataFrame:
    """Members (with their node's rating) of the nodes to compare exhaustively, after branching the larger ones.

    ``nodes``: the rating of the nodes of ``members``, written already. One
    row of counts per level reaches the driver.
    """
    leaves = None
    for level in range(ROUNDS + 1):
        small = F.lit(True) if level == ROUNDS else F.col("work") <= EXHAUSTIVE
        found = members.join(nodes.where(small), "node")
        leaves = found if leaves is None else leaves.unionByName(found)
        if nodes.where(~small).isEmpty():
            break
        on = materialize(members.join(nodes.where(~small).select("node"), "node"))
        steps = _children(sets.join(on.select("id").distinct().hint("shuffle_hash"), "id", "left_semi"), level)
        on = on.join(steps, "id").select("node", "id", "n", "component", F.posexplode("steps").alias("branch", "step"))
        members = materialize(on.select(F.xxhash64("node", "branch", "step").alias("node"), "id", "n", "component"))
        nodes = materialize(_rated(members))
    return leaves


def _across(large: DataFrame, groups: DataFrame, docs: DataFrame, size: int, like: int) -> DataFrame | None:
    """Links that join groups (node, component) within the large nodes; None if no large node holds two groups.

    Large nodes branch into small ones (see the module). There the documents
    outside the largest group meet all members: both sides are dealt into
    parts of about ``_PART`` shingles, and every part of the one meets every
    part of the other in a task of its own.
    """
    known = groups.select(F.col("node").alias("id"), "component")
    members = materialize(large.join(known, "id", "left").select(
        "node", "id", "n", F.coalesce("component", "id").alias("component")))
    nodes = materialize(_rated(members))
    if nodes.isEmpty():
        return None
    wanted = members.join(nodes.select("node"), "node").select("id").distinct()
    sets = materialize(_sets(docs.withColumnRenamed("doc_id", "id").join(
        wanted.hint("shuffle_hash"), "id"), size).where(F.length("set") > 0).distinct())
    open_ = F.col("component") != F.col("most")
    met = _leaves(members, nodes, sets).select("node", "id", "component", open_.alias("open"), "left", "right")

    def dealt(rows: DataFrame, own: str, other: str, is_open: bool) -> DataFrame:
        drawn = F.pmod(F.xxhash64("id", "node"), F.col(own)).alias(own)
        return rows.select("node", "id", "component", drawn, F.explode(F.sequence(F.lit(0).cast("long"), F.col(
            other) - 1)).alias(other), F.lit(is_open).alias("open"))

    both = dealt(met.where("open"), "left", "right", True).unionByName(dealt(met, "right", "left", False))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return both.join(sets, "id").groupBy("node", "left", "right").applyInArrow(
        lambda table: _links_of_part(table, like), f"a {kind}, b {kind}").distinct()


def _stars(groups: DataFrame) -> DataFrame:
    """Links (a, b) of every node with the head of its component."""
    return groups.select(F.col("node").alias("a"), F.col("component").alias("b"))


def near_groups(docs: DataFrame, size: int = 5, like: int = LIKE, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, kept: groups of documents linked by similar shingle sets.

    ``size``: words per shingle; ``like``: least similarity of a link, in per cent.
    """
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    rows = materialize(_describe(narrow, size))
    heads = materialize(rows.where(F.col("set_key").isNotNull() & F.col("doc_id").isNotNull())
                        .groupBy("set_key").agg(F.min("doc_id").alias("rep")))
    reps = rows.join(heads, (rows["set_key"] == heads["set_key"]) & (rows["doc_id"] == heads["rep"])).select(rows["*"])
    sketches = reps.select("doc_id", "sketch").dropDuplicates(["doc_id"])
    alike = F.arrow_udf(_alike, "double")
    pairs, large = _candidates(reps)
    pairs = (pairs
             .join(sketches.select(F.col("doc_id").alias("a"), F.col("sketch").alias("x")), "a")
             .join(sketches.select(F.col("doc_id").alias("b"), F.col("sketch").alias("y")), "b")
             .select("a", "b", alike("x", "y").alias("alike")).where(F.col("alike") >= SKETCH_LEAST))
    pairs = materialize(pairs)
    wanted = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct()
    # the narrow side is hashed, so the texts are moved once and not sorted
    texts = materialize(narrow.withColumnRenamed("doc_id", "id").join(wanted.hint("shuffle_hash"), "id"))
    first = pairs.groupBy("b").agg(F.max_by("a", F.struct("alike", F.negative("a"))).alias("a"))
    links = materialize(_confirm(first.select("a", "b"), texts, size, like))
    groups = materialize(components(links))
    left = pairs.join(groups.select(F.col("node").alias("a"), F.col("component").alias("ca")), "a", "left")
    left = left.join(groups.select(F.col("node").alias("b"), F.col("component").alias("cb")), "b", "left")
    apart = F.coalesce("ca", "a") != F.coalesce("cb", "b")
    rest = left.where(apart).join(first.select("a", "b"), ["a", "b"], "left_anti").select("a", "b")
    # the first groups are stars already
    links = _stars(groups).unionByName(_confirm(rest, texts, size, like))
    # rows of one doc_id with different texts are one document
    same = rows.join(heads, "set_key").where(F.col("doc_id") != F.col("rep")).select(
        F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    groups = materialize(components(links.unionByName(same)))
    across = _across(large, groups, narrow, size, like)
    if across is not None:
        groups = materialize(components(_stars(groups).unionByName(across)))
    out = (rows.select("doc_id", "n_shingles")
           .join(groups.select(F.col("node").alias("doc_id"), "component"), "doc_id", "left"))
    component = F.coalesce("component", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      F.col("doc_id").eqNullSafe(component).alias("kept"))


def keep_one(docs: DataFrame, size: int = 5, like: int = LIKE, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """``docs`` with one document (the smallest id) of each near-duplicate group, all columns kept."""
    gone = near_groups(docs, size, like, id_col, text_col).where(~F.col("kept")).select(
        F.col("doc_id").alias(id_col)).distinct()
    return docs.join(gone.hint("shuffle_hash"), id_col, "left_anti").select(*docs.columns)
