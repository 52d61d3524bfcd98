"""Summarize the physical plan of each registered query: shuffles, broadcasts, join kinds,
group limits, generators and the columns each scan reads. Stages that a query materializes
first (the fact table, the roll-up) have a row of their own, planned as they run before their
checkpoint. Writes Markdown to stdout.

Usage: python tools/plan_report.py [sf_dir]
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

KINDS = ["Exchange hashpartitioning", "Exchange SinglePartition", "BroadcastExchange",
         "SortMergeJoin", "ShuffledHashJoin", "BroadcastHashJoin", "WindowGroupLimit",
         "Generate", "ObjectHashAggregate", "SortAggregate", "HashAggregate", "Window"]


def summarize(plan: str) -> dict[str, int]:
    return {k: len(re.findall(r"\b" + re.escape(k), plan)) for k in KINDS}


def main() -> None:
    from lexitrend.session import local_session

    from lexitrend.plans.catalog import QUERIES, plans_of

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session(shuffle_partitions=16)
    print("| query | shuffles | broadcasts | SMJ | SHJ | BHJ | group limit | generate | scans read |")
    print("|---|---|---|---|---|---|---|---|---|")
    seen = set()
    for name, plan in ((n, p) for q in QUERIES for n, p in plans_of(spark, sf, q).items()):
        if name in seen:
            continue
        seen.add(name)
        s = summarize(plan)
        reads = sorted(set(re.findall(r"ReadSchema: struct<([^>]*)>", plan)))
        name = name if name in QUERIES else f"{name} (materialized stage)"
        print(f"| {name} | {s['Exchange hashpartitioning'] + s['Exchange SinglePartition']} | "
              f"{s['BroadcastExchange']} | {s['SortMergeJoin']} | {s['ShuffledHashJoin']} | "
              f"{s['BroadcastHashJoin']} | {s['WindowGroupLimit']} | {s['Generate']} | "
              f"{'; '.join(reads)} |", flush=True)


if __name__ == "__main__":
    main()
