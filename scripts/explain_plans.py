"""Write docs/PLANS.md: the physical plan of each headline query.

Usage: python scripts/explain_plans.py [SF_DIR]
Each plan is the optimized physical plan (before adaptive re-planning), with a
short line counting shuffles, joins and scans.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from bench import FROM_LANDING, FROM_TABLES  # noqa: E402
from forecastlake.plans.queries import QUERIES  # noqa: E402
from forecastlake.session import get_spark  # noqa: E402

WRITES = {"partitioned_write_hourly", "partitioned_write_daily", "run_report"}


def _trim(plan: str) -> str:
    out = []
    for ln in plan.splitlines():
        ln = re.sub(r"#\d+L?", "", ln)
        out.append(ln if len(ln) <= 220 else ln[:217] + "...")
    return "\n".join(out)


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_spark("local[4]", shuffle_partitions=8)
    parts = ["# Physical plans of the headline queries", "",
             f"Generated by `scripts/explain_plans.py` on `{sf}`. Write queries show the plan of",
             "their read-back; the write plans themselves are covered by `tests/test_plans.py`.", ""]
    for name in [*FROM_LANDING, *FROM_TABLES]:
        plan = QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
        ex = len(re.findall(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobin)", plan))
        joins = re.findall(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|BroadcastNestedLoopJoin|"
                           r"CartesianProduct)", plan)
        scans = len(re.findall(r"FileScan", plan))
        note = " (read-back after the write)" if name in WRITES else ""
        parts += [f"## {name}{note}", "",
                  f"shuffles: {ex}; joins: {', '.join(joins) or 'none'}; file scans: {scans}; "
                  f"Python: {'yes' if 'Python' in plan else 'no'}", "",
                  "```", _trim(plan), "```", ""]
    out = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "docs", "PLANS.md")
    os.makedirs(os.path.dirname(out), exist_ok=True)
    with open(out, "w") as f:
        f.write("\n".join(parts))
    print(out)


if __name__ == "__main__":
    main()
