"""Repair of conversations against a search over all edits and a brute-force run of the whole query."""

import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from critiq.llm import conversations as C

SCHEMA = "conv_id long, turn long, role string, text string"


def _search(rows):
    """(cost, audit, lines) of the least repair, by the states that a prefix of the rows can leave."""
    states = {"": (0, "", ())}

    def inserted(states):
        grown = dict(states)
        for _ in range(2):
            for said, (cost, audit, out) in list(grown.items()):
                to, name = ("a", "assistant") if said == "u" else ("u", "user")
                new = (cost + 3, audit + "I", (*out, f"{name}:"))
                if to not in grown or new < grown[to]:
                    grown[to] = new
        return grown

    for role, text, must_go, cut in rows:
        after = {}
        for said, (cost, audit, out) in inserted(states).items():
            ways = [(said, cost + 4, audit + "D", out)]
            if not must_go:
                for to, name, fits in (("s", None, said == ""), ("u", "user", said != "u"), ("a", "assistant", said == "u")):
                    if fits and role[:1] == to:
                        ways.append((to, cost + 3 * cut, audit + "K", (*out, f"{role}:{text}")))
                    elif fits and name:
                        ways.append((to, cost + 3 + 3 * cut, audit + "R", (*out, f"{name}:{text}")))
            for to, *new in ways:
                if to not in after or tuple(new) < after[to]:
                    after[to] = tuple(new)
        states = after
    return min(v for k, v in inserted(states).items() if k in ("", "a"))


def _exhaustive(rows):
    """Every way to edit a few rows, judged by the pattern itself."""
    best = None
    choices = []
    for role, text, must_go, cut in rows:
        ways = [("D", 4, None)]
        if not must_go:
            ways += [("K", 3 * cut, (role[:1], f"{role}:{text}")), ("R", 3 + 3 * cut, ("u", f"user:{text}")),
                     ("R", 3 + 3 * cut, ("a", f"assistant:{text}"))]
        choices.append(ways)
    fills = [c for n in range(3) for c in itertools.product("ua", repeat=n)]
    for gaps in itertools.product(fills, repeat=len(rows) + 1):
        for picked in itertools.product(*choices):
            cost, audit, initials, lines = 0, "", "", []
            for gap, way in itertools.zip_longest(gaps, picked):
                for g in gap:
                    cost, audit, initials = cost + 3, audit + "I", initials + g
                    lines.append("user:" if g == "u" else "assistant:")
                if way:
                    cost, audit = cost + way[1], audit + way[0]
                    if way[2]:
                        initials += way[2][0] or "?"
                        lines.append(way[2][1])
            if re.fullmatch("(s?(ua)+)?", initials):
                best = min(x for x in (best, (cost, audit, tuple(lines))) if x)
    return best


def _cells(rows):
    initial = [("sua".index(r[0][:1]) if r[0][:1] and r[0][:1] in "sua" else 3) for r in rows]
    fault = [C.BLANK if r[2] else C.TRUNCATED if r[3] else C.FINE for r in rows]
    return C.LEAF_COSTS[initial, fault], C.LEAF_AUDITS[initial, fault]


def _random_rows(rnd, n):
    return [(rnd.choice(["system", "user", "user", "assistant", "assistant", "tool", "", "u", " "]), f"t{i}",
             rnd.random() < 0.2, rnd.random() < 0.3) for i in range(n)]


def test_search_equals_all_edits_on_short_conversations():
    rnd = random.Random(1)
    for n in (0, 1, 2, 2, 2):
        for _ in range(12):
            rows = _random_rows(rnd, n)
            assert _search(rows) == _exhaustive(rows)


def test_cells_equal_search():
    rnd = random.Random(2)
    runs = [_random_rows(rnd, rnd.choice([1, 2, 3, 4, 5, 7, 8, 15, 33])) for _ in range(300)] + [_random_rows(rnd, 1500)]
    costs, audits = zip(*(_cells(rows) for rows in runs))
    done = C.parse_spans(np.concatenate(costs), np.concatenate(audits), [len(r) for r in runs])
    for rows, cells in zip(runs, done):
        assert C.cheapest(*cells) == _search(rows)[:2]


def _brute(table):
    out, convs = [], defaultdict(list)
    for conv, turn, role, text in table:
        shown = [" " if v is None else str(v) for v in (conv, turn)]
        kind = zlib.crc32(":".join(shown).encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        convs[conv]
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        convs[conv] += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    for conv, rows in convs.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).hexdigest()))
        seen, marked, counts = set(), [], dict.fromkeys(("blank", "duplicate", "truncated"), 0)
        for _, role, text in rows:
            bare = text.strip(" \t\n\x0b\x0c\r")
            fault = ("blank" if not bare else "duplicate" if (role, text) in seen
                     else "truncated" if bare[-1] not in ".!?" else None)
            seen.add((role, text))
            counts[fault] = counts.get(fault, 0) + 1
            marked.append((role, text, fault in ("blank", "duplicate"), fault == "truncated"))
        turns = [r[0] for r in rows if r[0] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        initials = [r[1][:1] for r in rows]
        illegal = sum(a + b not in ("su", "ua", "au") or not a or not b for a, b in zip(initials, initials[1:]))
        cost, audit, lines = _search(marked)
        out.append((conv, gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit,
                    hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=str)


def _rows(df):
    return sorted(map(tuple, df.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit",
                                       "repaired_sha256").collect()), key=str)


@pytest.fixture(scope="module")
def table():
    rnd = random.Random(5)
    rows = [(None, t, r, x) for t, r, x in [(None, "user", "a."), (1, None, None), (2, "assistant", "b"), (2, "user", "a.")]]
    rows += [(10_000, None, "user", None), (1 << 60, 1, "assistant", "hello there"), ((1 << 60) + 1, 5, "", "?")]
    rows += [(3, 1, "user", "same."), (3, 1, "user", "same."), (3, 2, "user", "same."), (4, 7, "system", "s" * 200_000)]
    rows += [(conv, turn, rnd.choice(["system", "user", "assistant", "assistant", "user", "tool"]),
              rnd.choice(["Hi.", "No end", " \t", "ünï 日本!", "What? ", "x\n", f"{rnd.random()}."]))
             for conv in range(20, 400) for turn in range(rnd.choice([1, 2, 3, 5, 8]))]
    rows += [(5, turn, "user" if turn % 2 else "assistant", f"{turn % 700}.") for turn in range(0, 4000, 1)]
    return rows


def test_query_equals_brute_force(spark, table, monkeypatch):
    clash = ["rank", "h", "kind", "fault", "seq", "_copy", "place", "cost", "audit", "first"]
    df = spark.createDataFrame(table, SCHEMA).select("*", *[F.lit(i).alias(c) for i, c in enumerate(clash)])
    assert _rows(C.repair_report(df.repartition(6))) == _brute(table)
    monkeypatch.setattr(C, "FAN", 2)        # several rounds of joining blocks
    monkeypatch.setattr(C, "BLOCK", 64)
    assert _rows(C.repair_report(df.repartition(3))) == _brute(table)


def test_no_conversations_and_nothing_left(spark):
    assert _rows(C.repair_report(spark.createDataFrame([], SCHEMA))) == []
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    got = _rows(C.repair_report(spark.createDataFrame([(gone, 0, "user", "Hi.")], SCHEMA)))
    assert got == [(gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())]


def test_repaired_turns_alternate(spark, table):
    rows = C.damage(spark.createDataFrame(table, SCHEMA)).persist()
    turns = C.repaired(rows, C.parse(C.faults(rows)))
    found = defaultdict(list)
    for r in turns.collect():
        found[r.conv_id].append((r.place, r.role, r.edit))
    assert len(found) > 250
    for conv in found.values():
        conv.sort()
        assert [p for p, _, _ in conv] == list(range(len(conv)))
        assert re.fullmatch("s?(ua)+", "".join(role[0] for _, role, _ in conv))
