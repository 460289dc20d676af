"""Counters of a run, collected by the pass that writes its result."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def line_counters(valid: Column | str = "valid") -> dict[str, Column]:
    """How many lines a pass reads, and how many of them are bad."""
    good = F.coalesce(F.col(valid) if isinstance(valid, str) else valid, F.lit(False))
    return {"lines": F.count(F.lit(1)), "bad_lines": F.count_if(~good)}


def observed(rows: DataFrame, counters: dict[str, Column]) -> tuple[DataFrame, Observation]:
    """`rows`, and an observation whose `get` has the counters once an action over them has finished.

    Put it where the rows reach their sink without a shuffle in between: a task of the writing stage counts once, however often it was
    run, while one before a shuffle may be run, and counted, again for a later stage.
    """
    observation = Observation()
    return rows.observe(observation, *(counter.alias(name) for name, counter in counters.items())), observation


class StreamCounts:
    """Counters of a stream, added up over its triggers. `update` must be called before a query forgets its oldest progress
    (spark.sql.streaming.numRecentProgressUpdates triggers); calling it again adds nothing twice."""

    def __init__(self, name: str):
        self.name = name
        self.seen: dict[int, dict[str, int]] = {}

    def update(self, query) -> dict[str, int]:
        for progress in query.recentProgress:
            row = progress.observedMetrics.get(self.name)
            if row is not None and progress.numInputRows:
                self.seen[progress.batchId] = row.asDict()
        return self.total()

    def total(self) -> dict[str, int]:
        total: dict[str, int] = {}
        for counts in self.seen.values():
            for name, count in counts.items():
                total[name] = total.get(name, 0) + (count or 0)
        return total
