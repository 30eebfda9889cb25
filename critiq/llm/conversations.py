"""Repair of conversation structure by weighted CYK interval parsing.

A repaired conversation reads ``(s?(ua)+)?``: nothing, or turns of user and assistant in pairs, a system turn before
them if there is one. The edits of a row are Keep (0), Rerole to user or assistant (3) and Delete (4, the only one for
blank and duplicate rows); empty user or assistant turns can be Inserted anywhere (3); a truncated row that stays
costs 3 more. The cheapest edits win, ties go to the ASCII-least audit (the initials of the edits in order).

The grammar in Chomsky normal form has a nonterminal ``[p q]`` for "takes what has been said from p to q" (start,
after the system turn, after a user, after an assistant), binary rules ``[p q] -> [p r][r q]``, and rules for a single
row, which its insertions precede (the insertion closure). A span's cell holds the cheapest (cost, audit) of every
nonterminal. Cells are combined bottom-up by span length: 1, 2, 4 and so on. One split of a span is enough, because every
derivation is in exactly one state at the boundary and the rules offer all of them. It holds for the audits too: two
audits of the same rows and cost are never prefixes of each other (what the longer one adds would be insertions, which
cost), so the least audit of a span consists of least audits of its parts.

Spark numbers the rows of all conversations once (range partitions, no window over a conversation), blocks of
``BLOCK`` consecutive rows are parsed each by itself, and only the cells of conversations at the edge of a block are combined
further, ``FAN`` at a time. So no task holds a whole conversation, however long; the audit itself has a letter per
row. Repeats within a conversation come from a map-side combined minimum joined back as a table of its own.

Defined cases: a NULL role or text is one space (so the text is blank); NULL conversation ids form one conversation;
rows of one turn are ordered by role, then by the SHA-256 of the text; an empty role or any initial but s, u, a must be
reroled or deleted; no rows at all give zeros, an empty audit and the hash of the empty text; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from critiq.operators.ranking import global_row_number
from critiq.session import materialize

BLOCK = 1024        # consecutive rows that are parsed together
FAN = 64            # neighbouring blocks whose cells are combined in one step

# Costs of the edits.
KEEP, REROLE, DELETE, INSERT, CUT = 0, 3, 4, 3, 3
# The blanks of a text and the marks that end one.
BLANKS, ENDS = "\x20\x09\x0a\x0b\x0c\x0d", ".!?"
# Faults of a row; only the first counts.
FINE, BLANK, REPEATED, TRUNCATED = 0, 1, 2, 3
# States: nothing said, after the system turn, after a user, after an assistant. Initials: s, u, a, any other.
START, SYSTEM, USER, ASSISTANT = range(4)
INITIALS = ["s", "u", "a"]
SAY = {("s", START): SYSTEM, ("u", START): USER, ("u", SYSTEM): USER, ("a", USER): ASSISTANT, ("u", ASSISTANT): USER}
LEGAL = {(0, 1), (1, 2), (2, 1)}
NEVER = 1 << 40
# Number of insertions that lead from one state to another (the closure of the insertion rules).
CLOSURE = {(p, p): 0 for p in range(4)} | {
    (START, USER): 1, (START, ASSISTANT): 2, (SYSTEM, USER): 1, (SYSTEM, ASSISTANT): 2, (USER, ASSISTANT): 1,
    (ASSISTANT, USER): 1}
CELLS = sorted({(p, q) for p in range(4) for q in range(4) if (p, q) in CLOSURE or (p, q) == (START, SYSTEM)})
AT = {cell: i for i, cell in enumerate(CELLS)}
RULES = {(p, q): [r for r in range(4) if (p, r) in AT and (r, q) in AT] for p, q in CELLS}


def _edits(initial: int, fault: int) -> list[tuple[int, int, int, str]]:
    """(from, to, cost, letter) of every edit of one row."""
    found = [(p, p, DELETE, "D") for p in range(4)]
    if fault in (BLANK, REPEATED):
        return found
    more = CUT * (fault == TRUNCATED)
    for (said, p), q in SAY.items():
        if initial < 3 and INITIALS[initial] == said:
            found.append((p, q, KEEP + more, "K"))
        elif said != "s":
            found.append((p, q, REROLE + more, "R"))
    return found


def _leaf(initial: int, fault: int) -> list[tuple[int, str]]:
    """The cells of one row: insertions, then an edit."""
    best = {}
    for (p, r), times in CLOSURE.items():
        for start, q, cost, letter in _edits(initial, fault):
            if start == r:
                best[p, q] = min(best.get((p, q), (NEVER, "")), (times * INSERT + cost, "I" * times + letter))
    return [best.get(cell, (NEVER, "")) for cell in CELLS]


_LEAVES = [[_leaf(i, f) for f in range(4)] for i in range(4)]
LEAF_COSTS = np.array([[[c for c, _ in cells] for cells in row] for row in _LEAVES], np.int64)
LEAF_AUDITS = np.array([[[a.encode() for _, a in cells] for cells in row] for row in _LEAVES])


def combine(left: tuple[np.ndarray, np.ndarray], right: tuple[np.ndarray, np.ndarray]):
    """Cells of spans from the cells of their halves, row by row: ``[p q] -> [p r][r q]``."""
    costs = np.empty(left[0].shape, np.int64)
    audits = []
    for cell, (p, q) in enumerate(CELLS):
        best = None
        for r in RULES[p, q]:
            a, b = AT[p, r], AT[r, q]
            cost = left[0][:, a] + right[0][:, b]
            audit = np.strings.add(left[1][:, a], right[1][:, b])
            if best is None:
                best = cost, audit
            else:
                less = (cost < best[0]) | ((cost == best[0]) & (audit < best[1]))
                best = np.where(less, cost, best[0]), np.where(less, audit, best[1])
        costs[:, cell] = np.minimum(best[0], NEVER)
        audits.append(np.where(best[0] < NEVER, best[1], b""))
    return costs, np.stack(audits, axis=1)


def parse_spans(costs: np.ndarray, audits: np.ndarray, sizes: Sequence[int]):
    """Cells of whole runs of spans: ``sizes`` says how many neighbouring spans make up each run (each at least 1)."""
    sizes = np.asarray(sizes, np.int64)
    done: list = [None] * len(sizes)
    runs = np.arange(len(sizes))
    while len(runs):
        starts = np.cumsum(sizes) - sizes
        for i in np.flatnonzero(sizes == 1):
            done[runs[i]] = costs[starts[i]], audits[starts[i]]
        open_ = sizes > 1
        runs, starts, sizes = runs[open_], starts[open_], sizes[open_]
        if not len(runs):
            break
        halves = (sizes + 1) // 2
        ends = np.cumsum(halves)
        within = np.arange(ends[-1]) - np.repeat(ends - halves, halves)
        left = np.repeat(starts, halves) + 2 * within
        paired = 2 * within + 1 < np.repeat(sizes, halves)
        joined = combine((costs[left[paired]], audits[left[paired]]), (costs[left[paired] + 1], audits[left[paired] + 1]))
        new_costs = costs[left]
        new_costs[paired] = joined[0]
        new_audits = audits[left].astype(joined[1].dtype)
        new_audits[paired] = joined[1]
        costs, audits, sizes = new_costs, new_audits, halves
    return done


def cheapest(costs: np.ndarray, audits: np.ndarray) -> tuple[int, str]:
    """(cost, audit) of the least accepted parse of a whole conversation with these cells."""
    found = []
    for end in (START, ASSISTANT):
        for r in range(4):
            if (START, r) in AT and (r, end) in CLOSURE:
                cell, times = AT[START, r], CLOSURE[r, end]
                found.append((int(costs[cell]) + INSERT * times, audits[cell].decode() + "I" * times))
    return min(found)


def damage(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text with the planted faults: the crc32 of ``conv_id:turn`` modulo 20 decides.

    0 drops the row, 1 empties its text, 2 removes the marks that end a sentence, 3 repeats the row, 4 makes it a
    user's. NULLs read as one space.
    """
    def known(name):
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(known("conv_id"), F.lit(":"), known("turn")).cast("binary")) % 20
    text = (F.when(F.col("_kind") == 1, "").when(F.col("_kind") == 2, F.regexp_replace("_text", "[.!?]", ""))
            .otherwise(F.col("_text")))
    return (rows.select("conv_id", "turn", known("role").alias("_role"), known("text").alias("_text"), kind.alias("_kind"))
            .where("_kind <> 0")
            .select("conv_id", "turn", F.when(F.col("_kind") == 4, "user").otherwise(F.col("_role")).alias("role"),
                    text.alias("text"),
                    F.explode(F.when(F.col("_kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
                    .alias("_copy")).drop("_copy"))


def _order(*more: str) -> list[Column]:
    return [F.col("conv_id").asc_nulls_first(), *map(F.col, more), F.col("turn").asc_nulls_first(), F.col("role"),
            F.col("h")]


def faults(rows: DataFrame) -> DataFrame:
    """rank, conv_id, turn, initial, fault of every row; ``rank`` numbers all rows by conversation and turn."""
    bare = F.btrim("text", F.lit(BLANKS))
    light = rows.select(
        "conv_id", "turn", "role", F.sha2("text", 256).alias("h"),
        F.coalesce(*[F.when(F.substring("role", 1, 1) == s, i) for i, s in enumerate(INITIALS)], F.lit(3)).alias("initial"),
        (bare == "").alias("blank"), (~F.substring(bare, -1, 1).isin(*ENDS)).alias("cut"),
        F.monotonically_increasing_id().alias("place"))  # equal rows are spread over partitions like any others
    ranked = materialize(global_row_number(light, [*_order(), F.col("place")]))
    firsts = ranked.where("not blank").groupBy("conv_id", "role", "h").agg(
        F.min("rank").alias("first"), F.count(F.lit(1)).alias("times")).where("times > 1")
    firsts = materialize(firsts).select(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("h").alias("k"),
                                        "first")
    same = ranked["conv_id"].eqNullSafe(firsts["c"]) & (ranked["role"] == firsts["r"]) & (ranked["h"] == firsts["k"])
    fault = (F.when(F.col("blank"), BLANK).when(F.col("rank") > F.col("first"), REPEATED)
             .when(F.col("cut"), TRUNCATED).otherwise(FINE))
    return ranked.join(firsts, same, "left").select("rank", "conv_id", "turn", "initial", fault.alias("fault"))


_COUNTS = ["blank", "duplicate", "truncated", "illegal"]


def _cell_type(id_type: str) -> str:
    return (f"conv_id {id_type}, seq long, first int, last int, blank long, duplicate long, truncated long, illegal long, "
            "cost long, audit string, costs array<long>, audits array<string>")


def _parse_block(table: pa.Table) -> pa.Table:
    """One row per conversation of a block; cells only for those at its edges, which may go on beyond it."""
    table = table.sort_by("rank")
    ids = table.column("conv_id").to_pylist()
    initial = table.column("initial").to_numpy()
    fault = table.column("fault").to_numpy()
    starts = [0] + [i for i in range(1, len(ids)) if ids[i] != ids[i - 1]]
    ends = starts[1:] + [len(ids)]
    runs = parse_spans(LEAF_COSTS[initial, fault], LEAF_AUDITS[initial, fault], [e - s for s, e in zip(starts, ends)])
    legal = [(a, b) in LEGAL for a, b in zip(initial.tolist(), initial[1:].tolist())] + [True]
    rows = []
    for n, (s, e) in enumerate(zip(starts, ends)):
        costs, audits = runs[n]
        cost, audit = cheapest(costs, audits)
        edge = n in (0, len(starts) - 1)
        kinds = np.bincount(fault[s:e], minlength=4).tolist()
        rows.append((ids[s], int(initial[s]), int(initial[e - 1]), *kinds[1:], legal[s:e - 1].count(False), cost, audit,
                     costs.tolist() if edge else None, [a.decode() for a in audits] if edge else None))
    names = ["first", "last", *_COUNTS, "cost", "audit", "costs", "audits"]
    columns = list(zip(*rows))
    arrays = [pa.array(columns[0], table.schema.field("conv_id").type), pa.array([table.column("seq")[0].as_py()] * len(rows))]
    kinds = [pa.int32()] * 2 + [pa.int64()] * 5 + [pa.string(), pa.list_(pa.int64()), pa.list_(pa.string())]
    return pa.Table.from_arrays(arrays + [pa.array(c, t) for c, t in zip(columns[1:], kinds)], ["conv_id", "seq", *names])


def _join_blocks(table: pa.Table) -> pa.Table:
    """The blocks of one conversation, in order, as one."""
    rows = table.sort_by("seq").to_pylist()
    out = {c: sum(r[c] for r in rows) for c in _COUNTS}
    out["illegal"] += sum((a["last"], b["first"]) not in LEGAL for a, b in zip(rows, rows[1:]))
    (costs, audits), = parse_spans(np.array([r["costs"] for r in rows], np.int64),
                                   np.array([[a.encode() for a in r["audits"]] for r in rows]), [len(rows)])
    out["cost"], out["audit"] = cheapest(costs, audits)
    out |= {"conv_id": rows[0]["conv_id"], "seq": rows[0]["step"], "first": rows[0]["first"], "last": rows[-1]["last"],
            "costs": costs.tolist(), "audits": [a.decode() for a in audits]}
    return pa.Table.from_pylist([out], pa.schema([table.schema.field(c) for c in table.column_names if c != "step"]))


def parse(marked: DataFrame) -> DataFrame:
    """conv_id, blank, duplicate, truncated, illegal, cost, audit of every conversation with rows (see :func:`faults`)."""
    kind = _cell_type(marked.schema["conv_id"].dataType.simpleString())
    names = ["conv_id", *_COUNTS, "cost", "audit"]
    blocks = marked.withColumn("seq", F.floor((F.col("rank") - 1) / BLOCK))
    cells = materialize(blocks.groupBy("seq").applyInArrow(_parse_block, kind))
    last = cells.agg(F.max("seq")).first()[0] or 0
    edge = cells.where(F.col("costs").isNotNull())
    while True:
        steps = edge.withColumn("step", F.floor(F.col("seq") / FAN))
        edge = steps.groupBy("conv_id", "step").applyInArrow(_join_blocks, kind)
        if (last := last // FAN) == 0:
            break
    return cells.where(F.col("costs").isNull()).select(names).unionByName(edge.select(names))


def repaired(rows: DataFrame, parsed: DataFrame) -> DataFrame:
    """conv_id, place, edit, role, text of every repaired conversation, its turns in order within one partition.

    Rows stream through in order behind the audit of their conversation, so a task holds a batch of them and no more.
    """
    id_type = rows.schema["conv_id"].dataType.simpleString()
    texts = rows.select("conv_id", F.lit(1).alias("kind"), "turn", "role", F.sha2("text", 256).alias("h"), "text")
    audits = parsed.select("conv_id", F.lit(0).alias("kind"), F.lit(None).cast(rows.schema["turn"].dataType).alias("turn"),
                           F.lit("").alias("role"), F.lit("").alias("h"), F.col("audit").alias("text"))
    stream = texts.unionByName(audits).repartition("conv_id").sortWithinPartitions(*_order("kind"))

    def edit(batches):
        conv, audit, at, said, place, out = None, "", 0, "", 0, []

        def say(letter, role, text):
            nonlocal said, place
            out.append((conv, place, letter, role, text))
            said, place = role[:1], place + 1

        def insert():
            nonlocal at
            while at < len(audit) and audit[at] == "I":
                at += 1
                say("I", "assistant" if said == "u" else "user", "")

        for batch in batches:
            for who, kind, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "kind", "role", "text"))):
                if kind == 0:
                    insert()                            # what the previous conversation still lacks
                    conv, audit, at, said, place = who, text, 0, "", 0
                    continue
                insert()
                letter, at = audit[at], at + 1
                if letter != "D":
                    say(letter, role if letter == "K" else "assistant" if said == "u" else "user", text)
            yield rows_of(out)
            out.clear()
        insert()
        yield rows_of(out)

    types = [pa.int64(), pa.string(), pa.string(), pa.string()]
    kind = pa.string() if id_type == "string" else pa.int64()

    def rows_of(found):
        columns = list(zip(*found)) or [()] * 5
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, [kind, *types])],
                                          ["conv_id", "place", "edit", "role", "text"])

    return stream.select("conv_id", "kind", "role", "text").mapInArrow(
        edit, f"conv_id {id_type}, place long, edit string, role string, text string")


def digests(turns: DataFrame) -> DataFrame:
    """conv_id, repaired_sha256 of the ``role:text`` lines of conversations whose turns come in order (see :func:`repaired`)."""
    id_type = turns.schema["conv_id"].dataType.simpleString()
    kind = pa.string() if id_type == "string" else pa.int64()

    def rows_of(found):
        return pa.RecordBatch.from_arrays([pa.array([c for c, _ in found], kind), pa.array([h for _, h in found], pa.string())],
                                          ["conv_id", "repaired_sha256"])

    def digest(batches):
        conv, running = None, None
        for batch in batches:
            out = []
            for who, place, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "place", "role", "text"))):
                if place == 0:
                    if running is not None:
                        out.append((conv, running.hexdigest()))
                    conv, running = who, hashlib.sha256()
                else:
                    running.update(b"\n")
                running.update(f"{role}:{text}".encode())
            yield rows_of(out)
        if running is not None:
            yield rows_of([(conv, running.hexdigest())])

    return turns.mapInArrow(digest, f"conv_id {id_type}, repaired_sha256 string")


def repair_report(conversations: DataFrame) -> DataFrame:
    """Damage and repair all conversations: one row for each, with its faults, cost, audit and digest."""
    rows = damage(conversations)
    marked = materialize(faults(rows))
    parsed = materialize(parse(marked))
    turns = marked.groupBy("conv_id", "turn").agg(F.lit(1).alias("one"))
    gaps = turns.groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).cast("long").alias("gaps"))
    found = conversations.select("conv_id")
    for part in (gaps, parsed, digests(repaired(rows, parsed))):
        found = found.unionByName(part, allowMissingColumns=True)
    counts = ["gaps", *_COUNTS, "cost"]
    return found.groupBy("conv_id").agg(
        *[F.coalesce(F.max(c), F.lit(0)).alias(c) for c in counts],
        F.coalesce(F.max("audit"), F.lit("")).alias("audit"),
        F.coalesce(F.max("repaired_sha256"), F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))
