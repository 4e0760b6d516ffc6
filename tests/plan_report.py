"""Write docs/PLANS.md: the physical plan shape of every registered query
(shuffles, join strategies, windows, scans with pushed filters and read
schema), from ``explain`` on the given tables.

    python tests/plan_report.py [sf_dir]
"""

from __future__ import annotations

import re
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

KEEP = ("Exchange", "Join", "FileScan", "Window", "Aggregate", "BroadcastExchange", "Generate", "Union",
        "Expand", "Sort ")


def summary(plan: str) -> list[str]:
    out = []
    for line in plan.splitlines():
        if not any(k in line for k in KEEP):
            continue
        line = re.sub(r"#\d+L?", "", line)
        line = re.sub(r", \[plan_id=\d+\]", "", line)
        line = re.sub(r"Location: InMemoryFileIndex\(\d+ paths\)\[file:[^\]]*/", "Location: [", line)
        line = re.sub(r"Batched: true, ", "", line)
        out.append(line.rstrip()[:220])
    return out


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    import __spark_entry__ as entry
    from reefcensus.session import get_session

    spark = get_session("local[8]", 8)
    lines = ["# Physical plans", "",
             f"Generated by `tests/plan_report.py` on `{sf_dir}` (local[8], AQE on; plans before",
             "runtime re-optimisation). One block per registered query: exchanges (shuffles),",
             "joins and their strategy, windows, aggregates and scans with pushed filters.", ""]
    for name, fn in sorted(entry.queries().items()):
        df = fn(spark, sf_dir)
        plan = df._jdf.queryExecution().executedPlan().toString()
        s = summary(plan)
        n_ex = sum(1 for x in s if "Exchange hashpartitioning" in x or "Exchange rangepartitioning" in x
                   or "Exchange SinglePartition" in x)
        n_bc = sum(1 for x in s if "BroadcastExchange" in x)
        lines += [f"## {name}", "", f"shuffles: {n_ex}, broadcasts: {n_bc}", "", "```", *s, "```", ""]
    (ROOT / "docs").mkdir(exist_ok=True)
    (ROOT / "docs" / "PLANS.md").write_text("\n".join(lines))
    print("wrote docs/PLANS.md")


if __name__ == "__main__":
    main(sys.argv)
