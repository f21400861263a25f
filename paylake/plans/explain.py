"""Print the executed physical plan of registered queries, reduced to the operators that matter.

``python -m paylake.plans.explain /root/testdata/sf0.1 name [name ...]``

Each query is run once (noop sink) so the adaptive plan is final; the printout
keeps scans (pushed filters, read schema), exchanges, aggregates, joins,
windows, sorts and top-k nodes.
"""

from __future__ import annotations

import re
import sys

KEEP = ("Scan", "Exchange", "Aggregate", "Join", "Window", "TakeOrdered", "Sort ", "Subquery", "Broadcast",
        "PushedFilters", "ReadSchema", "InMemory", "Limit")


def reduced_plan(df) -> list[str]:
    plan = df._jdf.queryExecution().executedPlan().toString()
    out = []
    for line in plan.split("\n"):
        if any(k in line for k in KEEP):
            line = re.sub(r"#\d+L?", "", line)
            line = re.sub(r"\[plan_id=\d+\]", "", line)
            line = re.sub(r"Location: InMemoryFileIndex\(1 paths\)\[file:[^\]]*/", "Location: ", line)
            out.append(line[:260])
    return out


def main(argv: list[str]) -> int:
    from paylake.plans.catalog import REGISTRY
    from paylake.session import build_session
    sf_dir, names = argv[0], argv[1:]
    spark = build_session("local[8]", shuffle_partitions=16)
    spark.sparkContext.setLogLevel("ERROR")
    for n in names:
        df = REGISTRY[n](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        print(f"### {n}\n\n```")
        print("\n".join(reduced_plan(df)))
        print("```\n", flush=True)
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
