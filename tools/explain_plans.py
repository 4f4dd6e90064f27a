"""Summarise the physical plan of every model (intermediates read from written tables).

Usage: python tools/explain_plans.py [sf_dir] > PLANS.md
For each model: exchanges by kind, join strategies, Expand / Window / aggregate kinds, and
the pushed filters and read schema of its scans, after execution (AQE's final plan).
"""

from __future__ import annotations

import os
import re
import sys
import tempfile
from collections import Counter

HERE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, HERE)

OPS = (r"Exchange hashpartitioning|Exchange rangepartitioning|Exchange SinglePartition|"
       r"Exchange RoundRobinPartitioning|BroadcastExchange|BroadcastHashJoin|SortMergeJoin|"
       r"ShuffledHashJoin|BroadcastNestedLoopJoin|Expand|Window|HashAggregate|SortAggregate|"
       r"ObjectHashAggregate|TakeOrderedAndProject|Generate")


def _pushed(plan: str) -> list[str]:
    """Contents of every ``PushedFilters: [...]`` (brackets matched)."""
    out, key = [], "PushedFilters: ["
    i = plan.find(key)
    while i >= 0:
        j, depth = i + len(key), 1
        while j < len(plan) and depth:
            depth += {"[": 1, "]": -1}.get(plan[j], 0)
            j += 1
        out.append(plan[i + len(key):j - 1])
        i = plan.find(key, j)
    return out


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    from claimlake.plans.catalog import project
    from claimlake.plans.project import MODELS, _ensure_loaded
    from claimlake.session import build_session

    spark = build_session("local[8]", shuffle_partitions=8,
                          conf={"spark.sql.maxMetadataStringLength": "2000"})
    prj = project(spark, sf_dir)
    prj.materialize(["int_drug_enriched", "int_prescriber_summary",
                     "int_prescriber_drug_detail"], tempfile.mkdtemp(prefix="plans-"))
    _ensure_loaded()
    print(f"# Physical plans ({os.path.basename(sf_dir)}, local[8], AQE final plans)\n")
    print("Intermediate models are read from written tables, as in the build. Counts are")
    print("operator occurrences in the executed plan.\n")
    print("| Model | Exchanges / joins / aggregates | Scan filters pushed |")
    print("|---|---|---|")
    for name, spec in MODELS.items():
        if spec.layer != "marts":
            continue
        df = prj.model(name)
        df.write.format("noop").mode("overwrite").save()
        plan = df._jdf.queryExecution().executedPlan().toString()
        ops = Counter(re.findall(OPS, plan))
        pushed = "; ".join(sorted(set(p for p in _pushed(plan) if p))) or "-"
        summary = ", ".join(f"{k} ×{v}" for k, v in sorted(ops.items()))
        print(f"| `{name}` | {summary} | {pushed} |")
    spark.stop()


if __name__ == "__main__":
    main()
