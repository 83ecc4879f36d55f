"""Physical-plan inventory of every registered query (markdown table).

Usage: python tools/plan_report.py [sf_dir]

Runs each query once (so AQE's final plan is known) and counts, in the
final adaptive plan: shuffle exchanges, broadcast exchanges, join kinds,
window operators (and partial window limits), aggregates, and whether scans
carry pushed or partition filters.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def counts(plan: str) -> dict:
    lines = plan.splitlines()

    def n(pat):
        return sum(1 for ln in lines if re.search(pat, ln))
    return {
        "shuffles": n(r"(?<!Broadcast)Exchange (hash|range|Single|round|Round)|ShuffleQueryStage|Exchange hashpartitioning|Exchange SinglePartition|Exchange rangepartitioning|Exchange RoundRobin"),
        "broadcasts": n(r"BroadcastExchange"),
        "smj": n(r"SortMergeJoin"),
        "bhj": n(r"BroadcastHashJoin"),
        "shj": n(r"ShuffledHashJoin"),
        "windows": n(r"\bWindow \["),
        "wgl": n(r"WindowGroupLimit"),
        "aggs": n(r"HashAggregate|ObjectHashAggregate|SortAggregate"),
        "pushed": "yes" if "PushedFilters: [" in plan and "PushedFilters: []" not in plan else "-",
        "partition": "yes" if re.search(r"PartitionFilters: \[[^\]]", plan) else "-",
    }


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from chartlake.plans import registry
    from chartlake.session import get_session
    spark = get_session("local[8]", shuffle_partitions=16)
    spark.sparkContext.setLogLevel("ERROR")
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    cols = ["shuffles", "broadcasts", "smj", "bhj", "shj", "windows", "wgl", "aggs", "pushed", "partition"]
    print("| query | " + " | ".join(cols) + " |")
    print("|---|" + "---|" * len(cols))
    for name in registry.QUERIES:
        df = registry.run(spark, name, sf)
        df.write.format("noop").mode("overwrite").save()
        plan = df._jdf.queryExecution().executedPlan().toString()
        c = counts(plan)
        print(f"| `{name}` | " + " | ".join(str(c[k]) for k in cols) + " |", flush=True)


if __name__ == "__main__":
    main()
