"""What adaptive execution made of a query: the final plan of a run, and which partitions it split."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame


@dataclass(frozen=True)
class SkewRead:
    """A shuffle that is read with skew splitting: partition number to the number of tasks that share it."""

    readers: dict[int, int]


def _below(node) -> Iterator:
    yield node
    kind = node.getClass().getSimpleName()
    if kind == "AdaptiveSparkPlanExec":
        yield from _below(node.executedPlan())
    elif kind in ("ShuffleQueryStageExec", "BroadcastQueryStageExec", "ResultQueryStageExec", "TableCacheQueryStageExec"):
        yield from _below(node.plan())
    else:
        children = node.children()
        for i in range(children.size()):
            yield from _below(children.apply(i))


def run(df: DataFrame):
    """Run a frame to its end without gathering its rows; gives its executed plan, which is then final."""
    execution = df._jdf.queryExecution()
    execution.toRdd().count()
    return execution.executedPlan()


def final_plan_text(df: DataFrame) -> str:
    """The plan that really ran, with what was decided on the way (`skew=true`, coalesced reads, broadcasts)."""
    return "\n".join(node.nodeName() + " " + node.simpleString(1000) for node in _below(run(df)))


def skew_reads(df: DataFrame) -> list[SkewRead]:
    """Run a frame; for each shuffle read with split partitions, how many tasks read each of those."""
    found = []
    for node in _below(run(df)):
        if node.getClass().getSimpleName() != "AQEShuffleReadExec":
            continue
        specs = node.partitionSpecs()
        parts = [specs.apply(i) for i in range(specs.size())]
        shared = Counter(p.reducerIndex() for p in parts if p.getClass().getSimpleName() == "PartialReducerPartitionSpec")
        if shared:
            found.append(SkewRead(dict(shared)))
    return found
