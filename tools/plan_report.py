"""Print the shuffle shape of every registered query's physical plan.

Usage: python tools/plan_report.py [sf_dir]

Static broadcast joins are switched off so the plans look as they would on
large tables (AQE may still pick a broadcast at run time).  For each query:
the number of exchanges, how many gather to a single partition, and the
exchange kinds.
"""

from __future__ import annotations

import re
import sys

sys.path.insert(0, ".")
from cartlytics.registry import QUERIES  # noqa: E402
from cartlytics.session import local_session  # noqa: E402


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    print("| query | exchanges | single-partition | broadcast joins | exchange keys |")
    print("|---|---|---|---|---|")
    for name, fn in QUERIES.items():
        plan = fn(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        ex = re.findall(r"Exchange (\w+)(?:\(([^,\]\)]*))?", plan)
        single = sum(1 for kind, _ in ex if kind == "SinglePartition")
        keys = sorted({re.sub(r"#\d+L?", "", k) or kind for kind, k in ex if kind != "SinglePartition"})
        print(f"| {name} | {len(ex)} | {single} | {plan.count('BroadcastHashJoin')} | {', '.join(keys)} |")


if __name__ == "__main__":
    main()
