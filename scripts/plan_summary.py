"""Summarize the physical plan of every registered query (markdown table).

usage: python scripts/plan_summary.py [sf_dir [name ...]] > PLANS.md
Counts are from the plan Spark executes for the query (AQE may still change
join strategies at run time from measured sizes).
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tessera.plans import registry  # noqa: E402
from tessera.session import local_session  # noqa: E402

JOINS = ("BroadcastHashJoin", "ShuffledHashJoin", "SortMergeJoin", "BroadcastNestedLoopJoin", "CartesianProduct")
PYTHON = ("ArrowEvalPython", "BatchEvalPython", "MapInPandas", "FlatMapGroupsInPandas", "FlatMapCoGroupsInPandas",
          "MapInArrow", "FlatMapGroupsInArrow", "FlatMapCoGroupsInArrow")


def final_plan(df) -> str:
    """Run the query, then return AQE's final physical plan as text."""
    df.collect()
    text = df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")
    if "== Final Plan ==" in text:
        parts = text.split("== Final Plan ==")[1:]
        text = "\n".join(p.split("== Initial Plan ==")[0] for p in parts)
    return text


def summarize(plan: str) -> dict:
    joins = {j: len(re.findall(j + r"\b", plan)) for j in JOINS}
    return {
        "exchanges": plan.count("ShuffleQueryStage"),
        "reused": plan.count("ReusedExchange"),
        "broadcasts": plan.count("BroadcastQueryStage"),
        "joins": ", ".join(f"{k}×{v}" for k, v in joins.items() if v) or "–",
        "group_limit": "yes" if "WindowGroupLimit" in plan else "",
        "python": ", ".join(p for p in PYTHON if p in plan) or "",
        "pushed": "yes" if re.search(r"PushedFilters: \[[^\]]+\]", plan) else "",
    }


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    registry.load_all()
    spark = local_session(8)
    print("# Physical plans of the registered queries\n")
    print(f"Generated by `scripts/plan_summary.py` on `{sf}` (local[8], 8 shuffle partitions, AQE on): each")
    print("query is run and AQE's *final* plan is summarized (scalar subqueries and plans of eager driver-side")
    print("steps such as bounded counts are not included). `shuffles` = materialized shuffle stages, `reused` =")
    print("shuffles read again instead of recomputed, `broadcasts` = broadcast stages (AQE broadcasts sides it")
    print("measured as small); `group limit` = WindowGroupLimit (top-k cut before the shuffle); `python` =")
    print("Python nodes; `pushed` = filters pushed into a parquet scan. PageRank returns its reliably")
    print("checkpointed ranks, so its final plan is a scan of the checkpoint.\n")
    print("| query | shuffles | reused | broadcasts | joins | group limit | python | pushed |")
    print("| --- | --- | --- | --- | --- | --- | --- | --- |")
    for name in sys.argv[2:] or sorted(registry.QUERIES):
        df = registry.QUERIES[name](spark, sf)
        s = summarize(final_plan(df))
        print(f"| {name} | {s['exchanges']} | {s['reused']} | {s['broadcasts']} | {s['joins']} | "
              f"{s['group_limit']} | {s['python']} | {s['pushed']} |", flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
