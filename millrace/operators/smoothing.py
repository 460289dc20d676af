"""Exponential means over long histories, where one device's rows are spread over many tasks.

A step of the mean is the map x -> (1 - alpha) * x + alpha * value. Maps of this kind compose to one of the same kind, a * x + b,
so a stretch of rows is two numbers whatever its length. Rows are cut into time chunks, and these into blocks so short that a plain
running sum of values over powers of (1 - alpha) stays in range. Blocks are composed within their chunk, chunks within their
device, and what comes out is applied to the rows where they lie: they move once, to their (device, chunk).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.session import written

#: The natural logarithm of how far weights within a block may lie apart.
RANGE = 46.0


def block_rows(alpha: float) -> int:
    return max(1, int(RANGE / -math.log1p(-alpha)))


def composed_before(a: np.ndarray, b: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The maps x -> a * x + b of each run composed up to and with each place, by doubling; `first` marks where a run begins."""
    run = np.cumsum(first)
    a, b = a.copy(), b.copy()
    step = 1
    while step < len(a):
        inside = np.flatnonzero(run[step:] == run[:-step]) + step
        if not len(inside):
            break
        before_a, before_b = a[inside - step], b[inside - step]
        b[inside] += a[inside] * before_b
        a[inside] *= before_a
        step *= 2
    return a, b


def _scan(keys: list[str], carried: list[str]):
    """Rows in order with `_a`, `_b`, the composition of the maps of their key before each; batches of any size."""

    def scan(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        open_key, open_a, open_b = None, 1.0, 0.0
        for frame in frames:
            if frame.empty:
                continue
            columns = [frame[k].to_numpy() for k in keys]
            first = np.ones(len(frame), dtype=bool)
            first[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
            a, b = composed_before(frame["_a"].to_numpy(), frame["_b"].to_numpy(), first)
            if tuple(c[0] for c in columns) == open_key:
                end = int(first[1:].argmax()) + 1 if first[1:].any() else len(first)
                b[:end] += a[:end] * open_b
                a[:end] *= open_a
                first[0] = False
            before_a = np.where(first, 1.0, np.concatenate([[open_a], a[:-1]]))
            before_b = np.where(first, 0.0, np.concatenate([[open_b], b[:-1]]))
            open_key, open_a, open_b = tuple(c[-1] for c in columns), a[-1], b[-1]
            yield pd.DataFrame({**{c: frame[c] for c in carried}, "_a": before_a, "_b": before_b})

    return scan


def composed(maps: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The columns of `maps`, with `_a` and `_b` of all maps of the key before each in `order`."""
    spread = maps.repartition(*keys).sortWithinPartitions(*keys, order)
    return spread.mapInPandas(_scan(keys, [c for c in maps.columns if c not in ("_a", "_b")]), maps.schema)


def with_exponential_mean(rows: DataFrame, alpha: float, group: str, chunk: str, place: str, value: str, out: str) -> DataFrame:
    """`rows` with the mean after each row in column `out`, and the one before it in `out`_before.

    `place` numbers the rows of a (group, chunk) from 1. The first mean of a group is its first value, before and after it.
    """
    if not 0 < alpha < 1:
        raise ValueError("alpha must lie between 0 and 1")
    keep = 1.0 - alpha
    size = block_rows(alpha)
    blocked = rows.withColumn("_block", F.expr(f"({place} - 1) div {size}")).withColumn("_spot", (F.col(place) - 1) % size + 1)
    inside = Window.partitionBy(group, chunk, "_block").orderBy(place)
    weight = F.pow(F.lit(keep), F.col("_spot").cast("double"))
    summed = F.sum(F.lit(alpha) * F.col(value) / weight).over(inside.rowsBetween(Window.unboundedPreceding, 0))
    blocked = blocked.withColumn("_a", weight).withColumn("_b", weight * summed)

    # All that is needed of the rows to carry means, a line for each block.
    lines = blocked.groupBy(group, chunk, "_block").agg(
        F.max_by("_a", "_spot").alias("_a"), F.max_by("_b", "_spot").alias("_b"), F.min_by(value, "_spot").alias("_first")
    )
    lines = written(lines, "means")
    within = composed(lines.drop("_first").withColumns({"_own_a": F.col("_a"), "_own_b": F.col("_b")}), [group, chunk], "_block")
    within = written(within, "means")
    chunks = _whole_chunks(within, group, chunk)
    firsts = lines.groupBy(group).agg(F.min_by("_first", F.struct(chunk, "_block")).alias("_first"))
    chunks = composed(chunks, [group], chunk).join(firsts, group)
    chunks = chunks.select(group, chunk, (F.col("_a") * F.col("_first") + F.col("_b")).alias("_carried"))
    before = (F.col("_a") * F.col("_carried") + F.col("_b")).alias("_before")
    carried = within.join(chunks, [group, chunk]).select(group, chunk, "_block", before)

    known = blocked.join(carried, [group, chunk, "_block"]).withColumn(out, F.col("_a") * F.col("_before") + F.col("_b"))
    earlier = F.coalesce(F.lag(out).over(inside), F.col("_before"))
    return known.withColumn(f"{out}_before", earlier).drop("_a", "_b", "_block", "_spot", "_before")


def _whole_chunks(within: DataFrame, group: str, chunk: str) -> DataFrame:
    """The map of each chunk: that of its last block after those before it."""
    last = F.max_by(F.struct("_a", "_b", "_own_a", "_own_b"), "_block").alias("last")
    a = F.col("last._own_a") * F.col("last._a")
    b = F.col("last._own_a") * F.col("last._b") + F.col("last._own_b")
    return within.groupBy(group, chunk).agg(last).select(group, chunk, a.alias("_a"), b.alias("_b"))
