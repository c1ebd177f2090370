"""Summarise the physical plan of every registered query -> PLANS.md.

Usage: python scripts/plan_report.py [sf_dir]
Counts shuffles, broadcasts, join strategies, partial aggregates and window group
limits in the final (AQE) plan, and lists what each scan reads.
"""

from __future__ import annotations

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from callcorpus.plans import queries as Q  # noqa: E402
from callcorpus.session import get_spark  # noqa: E402

MARKERS = [
    ("shuffles", r"Exchange (?:hashpartitioning|rangepartitioning|SinglePartition)"),
    ("spread", r"Exchange RoundRobinPartitioning"),
    ("broadcasts", r"BroadcastExchange"),
    ("smj", r"SortMergeJoin"),
    ("bhj", r"BroadcastHashJoin"),
    ("bnlj", r"BroadcastNestedLoopJoin"),
    ("cartesian", r"CartesianProduct"),
    ("partial_agg", r"(?:Hash|ObjectHash|Sort)Aggregate\(keys?=\[[^\]]*\], functions=\[partial_"),
    ("wgl_partial", r"WindowGroupLimit .* Partial"),
    ("python", r"(?:ArrowEvalPython|BatchEvalPython|MapInPandas|MapInArrow)"),
    ("topk", r"TakeOrderedAndProject"),
]


def summarise(plan: str) -> dict:
    out = {k: len(re.findall(p, plan)) for k, p in MARKERS}
    out["single_partition"] = len(re.findall(r"Exchange SinglePartition", plan))
    scans = re.findall(r"FileScan parquet \S*?\[([^\]]*)\].*?Location: InMemoryFileIndex\(1 paths\)\[file:[^\]]*/(\w+)\.parquet\]", plan)
    out["scans"] = sorted({f"{t}({len(cols.split(','))} cols)" for cols, t in scans})
    return out


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_spark()
    lines = [
        "# PLANS",
        "",
        f"Final (adaptive) physical plans of every registered query at `{sf_dir}`, summarised by",
        "`scripts/plan_report.py`. shuffles = hash/range/single Exchange nodes; spread = the round-robin",
        "exchange `sources.readers.spread` adds only when a scan has fewer splits than cores (one-row-group",
        "test files; a large input skips it); bhj / smj /",
        "bnlj = broadcast-hash / sort-merge / nested-loop joins; partial_agg = map-side partial",
        "aggregates; wgl_partial = map-side top-N per group; python = Python evaluation nodes.",
        "",
        "| query | shuffles | spread | broadcasts | bhj | smj | bnlj | cartesian | partial_agg | wgl_partial | topk | python | scans (columns read) |",
        "|---|---|---|---|---|---|---|---|---|---|---|---|---|",
    ]
    for name, fn in Q.QUERIES.items():
        df = fn(spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()  # run, so AQE's final plan is shown
        plan = df._jdf.queryExecution().executedPlan().toString()
        s = summarise(plan)
        lines.append(
            f"| {name} | {s['shuffles']} | {s['spread']} | {s['broadcasts']} | {s['bhj']} | {s['smj']} | {s['bnlj']} | {s['cartesian']} | "
            f"{s['partial_agg']} | {s['wgl_partial']} | {s['topk']} | {s['python']} | {', '.join(s['scans'])} |"
        )
    with open(os.path.join(ROOT, "PLANS.md"), "w") as f:
        f.write("\n".join(lines) + "\n")
    print("\n".join(lines))


if __name__ == "__main__":
    main()
