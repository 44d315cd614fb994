"""What a query really ran: its final adaptive plan, node by node."""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass, field

from pyspark.sql import DataFrame


@dataclass
class Executed:
    """Nodes of a final plan, subqueries included, reused parts not repeated."""

    nodes: Counter = field(default_factory=Counter)
    scans: Counter = field(default_factory=Counter)
    skew_joins: int = 0


def executed(df: DataFrame) -> Executed:
    """Run the query, then read its plan: reuse is only decided while it runs."""
    df.collect()
    return plan_of(df)


def plan_of(df: DataFrame) -> Executed:
    """The plan of a query that has been collected."""
    found = Executed()
    _walk(df._jdf.queryExecution().executedPlan(), found)
    return found


def _walk(node, found: Executed) -> None:
    name = node.getClass().getSimpleName()
    if name == "AdaptiveSparkPlanExec":
        return _walk(node.executedPlan(), found)
    if name.endswith("QueryStageExec"):
        return _walk(node.plan(), found)
    found.nodes[name] += 1
    if name.startswith("Reused"):
        return None
    if name == "FileSourceScanExec":
        path = node.relation().location().rootPaths().head().getName()
        found.scans[path.removesuffix(".parquet")] += 1
    if name == "SortMergeJoinExec" and node.isSkewJoin():
        found.skew_joins += 1
    for children in (node.children(), node.subqueries()):
        for i in range(children.size()):
            _walk(children.apply(i), found)
    return None
