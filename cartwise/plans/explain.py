"""Plan summary of catalogue queries, from ``explain("formatted")``.

    python -m cartwise.plans.explain /root/testdata/sf0.1 frequency_profile blended

Per query: exchanges, scans per table with their pushed filters and read
schema, join strategies, window-group limits and Python UDF nodes, as
planned before AQE re-plans at run time (AQE may still turn a sort-merge
join into a broadcast join once it has measured a side; whole-stage
codegen is applied per query stage at run time, so it is not listed).
"""

from __future__ import annotations

import contextlib
import io
import re
import sys
from collections import Counter


def summarize(df) -> dict:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    formatted = buf.getvalue()
    plan = formatted.split("\n\n(1)")[0]
    scans = re.findall(r"\(\d+\) Scan parquet[^\n]*\n(?:[^\n]*\n){0,8}?Location: [^\n]*?/(\w+)\.parquet\]"
                       r"(?:\n[^\n]*){0,3}?\n(?:PushedFilters: ([^\n]*)\n)?ReadSchema: ([^\n]*)", formatted)
    joins = Counter(re.findall(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|BroadcastNestedLoopJoin|"
                               r"CartesianProduct)", plan))
    return {
        "exchanges": len(re.findall(r"\bExchange \(", plan)),
        "broadcasts": plan.count("BroadcastExchange"),
        "joins": dict(joins),
        "window_group_limit": plan.count("WindowGroupLimit"),
        "python_udf": plan.count("ArrowEvalPython") + plan.count("BatchEvalPython"),
        "scans": [{"table": t, "pushed": p or "[]", "schema": s} for t, p, s in scans],
    }


def main(argv):
    from ..session import build_session
    from . import catalog
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    names = argv[2:] or list(catalog.QUERIES)
    spark = build_session("cartwise-explain", "local[8]", 16)
    spark.sparkContext.setLogLevel("ERROR")
    for n in names:
        s = summarize(catalog.QUERIES[n](spark, sf_dir))
        tables = Counter(x["table"] for x in s["scans"])
        print(f"### {n}\n")
        print(f"- exchanges {s['exchanges']}, broadcasts {s['broadcasts']}, joins {s['joins']}, "
              f"WindowGroupLimit {s['window_group_limit']}, Python UDF nodes {s['python_udf']}")
        print(f"- scans per table: {dict(tables)}")
        seen = set()
        for x in s["scans"]:
            key = (x["table"], x["pushed"], x["schema"])
            if key not in seen:
                seen.add(key)
                print(f"  - `{x['table']}` pushed `{x['pushed']}` read `{x['schema']}`")
        print()


if __name__ == "__main__":
    main(sys.argv)
