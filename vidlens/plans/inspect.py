"""Plan inspection: what a query shuffles, joins, aggregates and reads."""

from __future__ import annotations

import re
from collections import Counter

from pyspark.sql import DataFrame


def _plans(df: DataFrame, execute: bool):
    if execute:
        df.collect()  # through the DataFrame's own execution: AQE's final plan
    qe = df._jdf.queryExecution()
    formatted = df.sparkSession._jvm.PythonSQLUtils.explainString(qe, "formatted")
    return formatted, "\n".join(_nodes(qe.executedPlan()))


def _nodes(node) -> list[str]:
    """A line for every operator that ran: adaptive plans by their final plan,
    query stages by their plan, scalar subqueries not followed."""
    kind = node.getClass().getSimpleName()
    if kind == "AdaptiveSparkPlanExec":
        return _nodes(node.executedPlan())
    if kind.endswith("QueryStageExec"):
        return _nodes(node.plan())
    line = [] if kind in ("WholeStageCodegenExec", "InputAdapter") else [node.simpleString(100)]
    if kind == "ReusedExchangeExec":
        return ["ReusedExchange"]
    children = node.children()
    return line + [x for i in range(children.size()) for x in _nodes(children.apply(i))]


def summarise(formatted: str, tree: str) -> dict:
    """Counts from a formatted explain (scans, filters) and an executed tree."""
    ex = Counter()
    for m in re.finditer(r"(?<!Reused)(?<!Broadcast)(?<!\], )Exchange (\w+)", tree):
        kind = m.group(1)
        ex["single" if kind == "SinglePartition" else kind.replace("partitioning", "")] += 1
    joins = Counter(re.findall(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|"
                               r"BroadcastNestedLoopJoin|CartesianProduct)", tree))
    aggs = Counter(re.findall(r"\b(HashAggregate|SortAggregate|ObjectHashAggregate)\b", tree))
    return {"exchanges": dict(ex), "reused": tree.count("ReusedExchange"),
            "broadcasts": tree.count("BroadcastExchange"), "joins": dict(joins), "aggregates": dict(aggs),
            "take_ordered": tree.count("TakeOrderedAndProject"),
            "windows": len(re.findall(r"\bWindow \[", tree)), "subqueries": formatted.count("Subquery:"),
            "scans": sorted(set(re.findall(r"ReadSchema: (struct<[^>]*>)", formatted))),
            "pushed": sorted(set(f for f in re.findall(r"PushedFilters: \[([^\]]*)\]", formatted) if f))}


def plan_summary(df: DataFrame, execute: bool = False) -> dict:
    """Shuffles by partitioning, reused exchanges, broadcasts, join strategies,
    aggregate kinds, top-k operators, windows, scalar subqueries, scan read
    schemas and pushed filters of ``df``'s physical plan.

    ``execute=True`` runs the query first (collecting its rows -- use it on
    small results) so the summary shows AQE's final plan.
    """
    return summarise(*_plans(df, execute))
