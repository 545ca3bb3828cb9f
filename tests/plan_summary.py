"""Write PLANS.md: for each headline query, the physical plan's shuffles,
join strategies, unpartitioned windows and the filters pushed into scans.

    python tests/plan_summary.py [sf_dir]
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

OPS = ["Exchange hashpartitioning", "Exchange rangepartitioning", "Exchange RoundRobin",
       "Exchange SinglePartition", "BroadcastExchange", "SortMergeJoin", "BroadcastHashJoin",
       "ShuffledHashJoin", "CartesianProduct", "BroadcastNestedLoopJoin", "MapInPandas",
       "HashAggregate", "ObjectHashAggregate", "Window", "InMemoryTableScan"]


def walk(node, out: dict) -> None:
    """Count operators of a physical plan by walking its tree. A cached
    relation's own plan is not a child, so it is counted where it is built,
    not at every read."""
    name = node.nodeName()
    if name == "AdaptiveSparkPlan":
        walk(node.initialPlan(), out)
        return
    if name == "Exchange":
        part = node.outputPartitioning().toString()
        key = ("Exchange hashpartitioning" if part.startswith("hashpartitioning") else
               "Exchange rangepartitioning" if part.startswith("rangepartitioning") else
               "Exchange SinglePartition" if part.startswith("SinglePartition") else
               "Exchange RoundRobin")
        out[key] = out.get(key, 0) + 1
    else:
        out[name] = out.get(name, 0) + 1
    if name.startswith("Scan parquet"):
        text = node.simpleString(100)
        table = re.search(r"/([a-z]+)\.parquet", text)
        cols = re.search(r"ReadSchema: struct<([^>]*)>", text)
        filt = re.search(r"PushedFilters: \[([^\]]*)\]", text)
        out.setdefault("scans", []).append(
            (table.group(1) if table else "?", len(cols.group(1).split(",")) if cols else 0,
             filt.group(1) if filt else ""))
    kids = node.children()
    for i in range(kids.size()):
        walk(kids.apply(i), out)


def summarise(df) -> dict:
    out: dict = {}
    walk(df._jdf.queryExecution().executedPlan(), out)
    for op in OPS:
        out.setdefault(op, 0)
    out.setdefault("scans", [])
    return out


ALL_DIR = "/root/testdata/sf0.01"
# Results assembled on the driver from bounded aggregates (no plan to show).
LOCAL_RESULTS = {"kmeans_sweep", "ward_sweep", "eval_auc", "pref_regression",
                 "pref_regression_by_segment"}


def _row(name: str, s: dict) -> str:
    return (f"| {name} | {s['Exchange hashpartitioning']} | {s['Exchange rangepartitioning']} | "
            f"{s['Exchange SinglePartition']} | {s['BroadcastExchange']} | {s['SortMergeJoin']} | "
            f"{s['BroadcastHashJoin']} | {s['CartesianProduct'] + s['BroadcastNestedLoopJoin']} | "
            f"{s['MapInPandas']} | {s['Window']} |")


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    from bench import HEADLINE
    from boutique.session import build_session
    import __spark_entry__ as entry
    spark = build_session(shuffle_partitions=16)
    qs = entry.queries()
    lines = ["# PLANS", "",
             f"Physical plans (initial adaptive plan) of the headline queries at `{sf_dir}`,",
             "generated by `tests/plan_summary.py` by walking each plan tree. Counts are",
             "operator occurrences in this query's own plan (a cached table counts as one",
             "scan of the cache). Scans list (table, columns read, pushed filters).", "",
             "| Query | hash shuffles | range shuffles | single-partition | broadcasts | SMJ | BHJ | cartesian / BNLJ | mapInPandas | windows |",
             "| --- | --- | --- | --- | --- | --- | --- | --- | --- | --- |"]
    details = []
    for name in HEADLINE:
        s = summarise(qs[name](spark, sf_dir))
        lines.append(_row(name, s))
        details.append(f"- **{name}**: " + "; ".join(
            f"`{t}` {n} cols" + (f" [{f}]" if f else "") for t, n, f in s["scans"]))
    lines += ["", "## Scans", ""] + details + [""]
    lines += ["## Every registered query", "",
              f"Same counts for every query at `{ALL_DIR}` (queries whose result is",
              "assembled on the driver from bounded aggregates are listed without a plan:",
              ", ".join(f"`{n}`" for n in sorted(LOCAL_RESULTS)) + ").", "",
              lines[6], lines[7]]
    for name in sorted(set(qs) - LOCAL_RESULTS):
        lines.append(_row(name, summarise(qs[name](spark, ALL_DIR))))
    lines.append("")
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("\n".join(lines))
    print("\n".join(lines))


if __name__ == "__main__":
    main(sys.argv)
