"""Summarise the physical plan of every registered job: scans, exchanges, joins, aggregates.

usage: python tools/plans.py SF_DIR > docs/PLANS.md
"""

from __future__ import annotations

import re
import sys

sys.path.insert(0, __file__.rsplit("/tools/", 1)[0])


def facts(plan: str) -> dict:
    scans = re.findall(r"FileScan (\w+) \[([^\]]*)\].*?PushedFilters: \[([^\]]*)\]", plan)
    return {
        "scans": len(re.findall(r"FileScan ", plan)),
        "cols": max((len(c.split(",")) for _, c, _ in scans), default=0),
        "pushed": sum(1 for _, _, p in scans if p.strip()),
        "exchanges": len(re.findall(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobin)", plan)),
        "broadcast": len(re.findall(r"BroadcastHashJoin", plan)),
        "smj": len(re.findall(r"SortMergeJoin", plan)),
        "partial_agg": len(re.findall(r"partial_", plan)),
        "windows": len(re.findall(r"\bWindow \[", plan)),
        "python": len(re.findall(r"BatchEvalPython|ArrowEvalPython|FlatMapGroupsInPandas|MapInPandas", plan)),
    }


def main():
    sf_dir = sys.argv[1]
    from conform.plans.registry import QUERIES
    from conform.session import local_session
    spark = local_session(8, 8)
    q = QUERIES
    print("# Physical plans of the registered jobs\n")
    print(f"Generated by `python tools/plans.py {sf_dir}` (initial adaptive plan, before runtime re-planning).")
    print("Columns: file scans; widest scan (columns read); scans with pushed filters; shuffles; broadcast and")
    print("sort-merge joins; partial (map-side) aggregates; window operators; Python evaluation nodes.\n")
    print("| job | scans | max cols | pushed | shuffles | bcast | smj | partial agg | windows | python |")
    print("|---|---|---|---|---|---|---|---|---|---|")
    for name in sorted(q):
        plan = q[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        f = facts(plan)
        print(f"| `{name}` | {f['scans']} | {f['cols']} | {f['pushed']} | {f['exchanges']} | {f['broadcast']} | "
              f"{f['smj']} | {f['partial_agg']} | {f['windows']} | {f['python']} |")


if __name__ == "__main__":
    main()
