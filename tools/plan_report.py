"""Summarise physical plans: scans, shuffles, broadcasts, one-task steps, Python steps.

usage: python tools/plan_report.py [folder] [name ...]      (-v prints the plans)
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

MARKS = {
    "scans": "FileScan",
    "shuffles": "Exchange hashpartitioning",
    "broadcasts": "BroadcastExchange",
    "one_task": "Exchange SinglePartition",
    "range": "Exchange rangepartitioning",
    "nested_loop": "NestedLoopJoin",
    "cartesian": "CartesianProduct",
    "python": "Python",
}


def main(argv):
    from delaykit.catalogue import REGISTRY
    from delaykit.session import build_session

    verbose = "-v" in argv
    args = [a for a in argv[1:] if a != "-v"]
    folder = args[0] if args else "/root/testdata/sf0.01"
    names = args[1:] or [n for n, e in REGISTRY.items() if e.sql]
    conf = {
        "spark.sql.shuffle.partitions": "8",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.adaptive.enabled": "false",
    }
    spark = build_session("plans", "local[8]", **conf)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.sparkContext.setLogLevel("ERROR")
    print("query".ljust(28), *[m.rjust(11) for m in MARKS])
    for name in names:
        plan = REGISTRY[name].run(spark, folder)._jdf.queryExecution().executedPlan().toString()
        print(name.ljust(28), *[str(plan.count(t)).rjust(11) for t in MARKS.values()], flush=True)
        if verbose:
            print(plan)


if __name__ == "__main__":
    main(sys.argv)
