"""Print what stands out in the physical plans: python tools/plans.py [key ...]"""

from __future__ import annotations

import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from larkspur.registry import load_all  # noqa: E402
from larkspur.session import build_session  # noqa: E402

WATCH = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "Exchange SinglePartition")


def main() -> None:
    spark = build_session(8)
    wanted = sys.argv[1:]
    for key, q in load_all().items():
        if wanted and key not in wanted:
            continue
        df = q.fn(spark, "/root/testdata/sf0.001")
        plan = df._jdf.queryExecution().executedPlan().toString()
        if wanted:
            print(key, plan)
            continue
        seen = {w: plan.count(w) for w in WATCH if w in plan}
        windows = plan.count("Window [") + plan.count("Window(")
        joins = {j: plan.count(j) for j in ("SortMergeJoin", "BroadcastHashJoin", "ShuffledHashJoin") if j in plan}
        print(key, "exchanges", plan.count("Exchange hashpartitioning") + plan.count("Exchange rangepartitioning"), joins, seen, f"windows={windows}" if windows else "", flush=True)


if __name__ == "__main__":
    main()
