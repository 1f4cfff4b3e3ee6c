"""Plan inspection helpers (for tests and tuning): count shuffles in the physical plan."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame


def physical_plan(df: DataFrame) -> str:
    """The executed plan as text (forces planning, not execution)."""
    return df._jdf.queryExecution().executedPlan().toString()


def count_exchanges(df: DataFrame, kind: str = "hashpartitioning") -> int:
    """Number of shuffle exchanges of a given partitioning kind in the plan
    (before adaptive re-planning)."""
    plan = physical_plan(df)
    return len(re.findall(r"Exchange " + re.escape(kind), plan))


def _children(node):
    seq = node.children()
    return [seq.apply(i) for i in range(seq.size())]


def _metric(node, name):
    m = node.metrics().get(name)
    return int(m.get().value()) if m.isDefined() else 0


def shuffle_metrics(df: DataFrame) -> dict:
    """Execute ``df``'s own physical plan (rows are counted, not collected) and read
    its final adaptive plan: shuffle exchanges actually executed and the bytes they
    wrote (``dataSize``); broadcasts and their size."""
    jvm_plan = df._jdf.queryExecution().executedPlan()
    jvm_plan.execute().count()
    out = {"shuffles": 0, "shuffle_bytes": 0, "broadcasts": 0, "broadcast_bytes": 0}
    seen = set()

    def walk(node):
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            walk(node.executedPlan())
            return
        if node.getClass().getSimpleName().endswith("QueryStageExec"):  # incl. ResultQueryStage
            walk(node.plan())
            return
        if name.startswith("ReusedExchange"):
            return
        key = node.id() if hasattr(node, "id") else None
        if name == "Exchange" and key not in seen:
            seen.add(key)
            out["shuffles"] += 1
            out["shuffle_bytes"] += _metric(node, "dataSize")
        if name == "BroadcastExchange" and key not in seen:
            seen.add(key)
            out["broadcasts"] += 1
            out["broadcast_bytes"] += _metric(node, "dataSize")
        for c in _children(node):
            walk(c)
        subs = node.subqueries()
        for i in range(subs.size()):
            walk(subs.apply(i))

    walk(jvm_plan)
    return out
