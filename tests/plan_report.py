"""Summarise the physical plan of every registered query (from ``explain``).

usage: python -m tests.plan_report [sf_dir] > PLANS.md
"""

from __future__ import annotations

import contextlib
import io
import re
import sys


def summarise(plan: str) -> dict:
    scans = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    return {
        "exchanges": len(re.findall(r"^\(\d+\) Exchange", plan, re.M)),
        "broadcasts": len(re.findall(r"^\(\d+\) BroadcastExchange", plan, re.M)),
        "hash_aggs": len(re.findall(r"^\(\d+\) HashAggregate", plan, re.M)),
        "object_aggs": len(re.findall(r"^\(\d+\) ObjectHashAggregate", plan, re.M)),
        "sort_aggs": len(re.findall(r"^\(\d+\) SortAggregate", plan, re.M)),
        "joins": re.findall(r"^\(\d+\) (\w+Join\w*)", plan, re.M),
        "python": len(re.findall(r"^\(\d+\) (MapIn\w+|ArrowEvalPython|BatchEvalPython|FlatMap\w+)", plan, re.M)),
        "scan_cols": [len([c for c in s.split(",") if ":" in c]) for s in scans],
        "pushed": sorted({p for p in re.findall(r"PushedFilters: \[([^\]]+)\]", plan)}),
        "top_k": "TakeOrderedAndProject" in plan,
    }


def main(argv: list[str]) -> None:
    sys.path.insert(0, ".")
    import __spark_entry__ as E
    from carelake.session import build_session
    sf_dir = argv[0] if argv else "/root/testdata/sf0.1"
    spark = build_session()
    print("| query | exchanges | broadcasts | hash / object / sort aggs | joins | python stages | "
          "scan columns | pushed filters | top-k |")
    print("| --- | --- | --- | --- | --- | --- | --- | --- | --- |")
    for k, q in E.queries().items():
        df = q(spark, sf_dir)
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain("formatted")
        plan = buf.getvalue()
        s = summarise(plan)
        print(f"| {k} | {s['exchanges']} | {s['broadcasts']} | {s['hash_aggs']} / {s['object_aggs']} / "
              f"{s['sort_aggs']} | {', '.join(s['joins']) or '-'} | {s['python']} | "
              f"{s['scan_cols']} | {'; '.join(s['pushed']) or '-'} | {'yes' if s['top_k'] else '-'} |",
              flush=True)


if __name__ == "__main__":
    main(sys.argv[1:])
