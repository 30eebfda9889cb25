"""Summarise the physical plan of every registered query as a markdown table.

Usage: python tools/plan_summary.py [sf_dir] > PLANS.md
Counts come from the optimized physical plan before execution (AQE may still
turn a sort-merge join into a broadcast at run time when a side is small).
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("simple")
    return buf.getvalue()


def _strip_ids(text: str) -> str:
    return re.sub(r"#\d+L?", "", text)


def summarise(text: str) -> dict:
    lines = text.splitlines()
    shuffles, combined, reused = [], 0, 0
    for i, line in enumerate(lines):
        m = re.search(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition)(?:\((.*)\))?", line)
        if not m or "BroadcastExchange" in line:
            continue
        kind, args = m.group(1), _strip_ids(m.group(2) or "")
        keys = ", ".join(a.strip() for a in args.split(",")[:-1]) if kind != "SinglePartition" else ""
        label = {"hashpartitioning": "hash", "rangepartitioning": "range", "SinglePartition": "single"}[kind]
        label = f"{label}({keys})" if keys else label
        if "ReusedExchange" in line:    # only what the plan itself marks as reused is not counted again
            reused += 1
            continue
        shuffles.append(label)
        if i + 1 < len(lines) and "HashAggregate" in lines[i + 1]:
            combined += 1
    scans = [(t, cols) for cols, t in re.findall(r"FileScan parquet \[([^\]]*)\][^\n]*?/(\w+)\.parquet\]", text)]
    return {
        "shuffles": shuffles,
        "combined": combined,
        "reused": reused,
        "nested": text.count("NestedLoopJoin") + text.count("CartesianProduct"),
        "bhj": text.count("BroadcastHashJoin"),
        "smj": text.count("SortMergeJoin"),
        "group_limit": "WindowGroupLimit" in text,
        "subquery": len(set(re.findall(r"Subquery subquery#(\d+)", text))),
        "scans": sorted({f"{t}({len(cols.split(','))})" for t, cols in scans}),
    }


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from critiq.session import build_session
    from critiq.plans import catalog

    spark = build_session("local[8]", 8)
    print("# Physical plans of the registered queries\n")
    print(f"Generated by `tools/plan_summary.py` on `{sf_dir}` (optimized plans before execution; AQE may")
    print("still turn a sort-merge join into a broadcast at run time). Shuffles list every exchange with its")
    print("keys; only an exchange that the plan marks as reused is counted apart.")
    print("`single` is a one-partition exchange that only carries one partial row per map partition (global")
    print("aggregates, scalars). \"Combined map-side\" counts exchanges fed by a partial hash aggregate.")
    print()
    print("| query | shuffles (exchanges and their keys) | reused | combined map-side | broadcast joins | "
          "sort-merge joins | nested-loop or cross joins | partial top-k | scalar subqueries | scans (columns read) |")
    print("| --- | --- | --- | --- | --- | --- | --- | --- | --- | --- |")
    for name, fn in sorted(catalog.queries().items()):
        s = summarise(plan_text(fn(spark, sf_dir)))
        print(f"| `{name}` | {len(s['shuffles'])}: {', '.join(s['shuffles']) or '-'} | {s['reused']} | {s['combined']} | {s['bhj']} | "
              f"{s['smj']} | {s['nested']} | {'yes' if s['group_limit'] else '-'} | {s['subquery']} | "
              f"{', '.join(s['scans']) or 'checkpointed input'} |")
    spark.stop()


if __name__ == "__main__":
    main()
