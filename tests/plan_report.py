"""Write PLANS.md: the physical plan shape of every registered query.

Automatic broadcast is switched off so the plans show what large inputs
get (AQE may still broadcast a side at run time once it has measured it).

    python tests/plan_report.py /root/testdata/sf0.1 > PLANS.md
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

KINDS = [
    ("Exchange hashpartitioning", "hash shuffle"),
    ("Exchange rangepartitioning", "range shuffle"),
    ("Exchange SinglePartition", "single-partition exchange"),
    ("BroadcastExchange", "broadcast"),
    ("SortMergeJoin", "sort-merge join"),
    ("BroadcastHashJoin", "broadcast hash join"),
    ("ShuffledHashJoin", "shuffled hash join"),
    ("BroadcastNestedLoopJoin", "nested-loop join"),
    ("CartesianProduct", "cartesian product"),
    ("HashAggregate", "hash aggregate"),
    ("SortAggregate", "sort aggregate"),
    ("Window ", "window"),
    ("Generate ", "generate"),
    ("TakeOrderedAndProject", "top-k"),
    ("Subquery ", "scalar subquery"),
    ("ArrowEvalPython", "python udf"),
    ("BatchEvalPython", "python udf"),
]


def shape(plan: str) -> str:
    parts = []
    for token, label in KINDS:
        n = plan.count(token)
        if n:
            parts.append(f"{n} {label}")
    return ", ".join(parts)


def scans(plan: str) -> str:
    out = []
    for m in re.finditer(r"FileScan parquet \[([^\]]*)\].*?Location: InMemoryFileIndex[^\[]*\[([^\]]*)\]",
                         plan):
        table = os.path.basename(m.group(2).split(",")[0]).replace(".parquet", "")
        cols = len(m.group(1).split(","))
        out.append(f"{table}({cols})")
    return " ".join(sorted(set(out)))


def main() -> None:
    from voltaic.session import local_session
    import __spark_entry__ as E

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session(shuffle_partitions=16, app="voltaic-plans")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    print("# PLANS\n")
    print("Physical plan shape of every registered query (generated by "
          "`tests/plan_report.py`; automatic broadcast off, so the plans show the shape "
          "large inputs get). Counts are operators in the plan; partial and final halves of "
          "one aggregate count as two. Scans list the table and the number of columns read.\n")
    print("| query | operators | scans (columns read) |")
    print("| --- | --- | --- |")
    for name, q in E.queries().items():
        plan = q(spark, sf)._jdf.queryExecution().executedPlan().toString()
        print(f"| `{name}` | {shape(plan)} | {scans(plan)} |")
    spark.stop()


if __name__ == "__main__":
    main()
