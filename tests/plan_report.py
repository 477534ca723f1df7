"""Summarise the physical plan of every registered query into PLANS.md.

    python tests/plan_report.py [/root/testdata/sf0.01] > PLANS.md

For each query: shuffles (Exchange), join strategies, pruning and pushdown on
the scan, per-group limits, Python stages.  Queries that run a job while they
are built (materialised intermediates, staged inputs, streams) are planned
after that job; their final plan is what is summarised.
"""

from __future__ import annotations

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from delaystats.plans.explain import plan_text  # noqa: E402
from delaystats.session import build_session  # noqa: E402


def summarise(plan: str) -> dict[str, str]:
    body = plan.split("\n\n")[0]                      # the operator tree
    kinds = re.findall(r"\(\d+\) Exchange\nInput \[\d+\]: .*?\nArguments: (\w+)", plan)
    joins = sorted(set(re.findall(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|"
                                  r"BroadcastNestedLoopJoin|CartesianProduct)", body)))
    part = [p for p in re.findall(r"PartitionFilters: \[([^\]]*)\]", plan) if p]
    pushed = [p for p in re.findall(r"PushedFilters: \[([^\]]*)\]", plan) if p]
    special = sorted(set(re.findall(r"(TakeOrderedAndProject|WindowGroupLimit|Window|"
                                    r"HashAggregate|SortAggregate|ObjectHashAggregate|"
                                    r"MapInPandas|ArrowEvalPython|BatchEvalPython|Generate|Expand|"
                                    r"InMemoryTableScan)", body)))
    if "Bucketed: true" in plan:
        special.append("bucketed scan")
    return {
        "shuffles": f"{len(kinds)} ({', '.join(kinds)})" if kinds else "0",
        "broadcasts": str(body.count("BroadcastExchange")),
        "joins": ", ".join(joins) or "-",
        "partition filters": "; ".join(part) or "-",
        "pushed filters": "; ".join(pushed) or "-",
        "operators": ", ".join(special),
    }


def main(argv: list[str]) -> None:
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session(8, 8)
    import __spark_entry__ as entry
    print("# Physical plans of the registered queries\n")
    print(f"Generated by `python tests/plan_report.py {sf_dir}` (AQE on, initial plans; "
          "`Exchange` = shuffle).  Filters are truncated by Spark's plan printer.\n")
    print("| query | shuffles | broadcasts | joins | partition filters | pushed filters | operators |")
    print("|---|---|---|---|---|---|---|")
    for name, fn in entry.queries().items():
        try:
            s = summarise(plan_text(fn(spark, sf_dir), "formatted"))
        except Exception as e:  # keep the report going
            s = {"shuffles": f"error: {type(e).__name__}"}
        cells = [s.get(k, "") for k in ("shuffles", "broadcasts", "joins", "partition filters",
                                        "pushed filters", "operators")]
        cells = [c.replace("|", "\\|") for c in cells]
        print(f"| `{name}` | " + " | ".join(cells) + " |")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
