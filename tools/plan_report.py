"""Physical-plan shape of every registered query (over the stored build).

usage: python tools/plan_report.py [sf_dir]   -> markdown table on stdout
Counts shuffles (Exchange), broadcasts, file scans, scalar subqueries, windows and
sort-based aggregates in the executed (AQE initial) plan.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from pyspark.sql import SparkSession
    spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false").config("spark.sql.shuffle.partitions", "8")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    from lapsekit.plans import registry
    registry.use_materialised(spark, sf_dir)
    print("| query | shuffles | broadcasts | scans | scalar subqueries | windows | sort aggregates |")
    print("|---|---|---|---|---|---|---|")
    for name, fn in registry.QUERIES.items():
        if name.startswith("e11"):
            continue  # runs its own writes
        p = fn(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        ex = len(re.findall(r"Exchange (?:hash|range|Single|round)", p))
        print(f"| {name} | {ex} | {p.count('BroadcastExchange')} | {p.count('FileScan')} | "
              f"{p.count('Subquery subquery')} | {p.count('Window [')} | {p.count('SortAggregate')} |")


if __name__ == "__main__":
    main()
