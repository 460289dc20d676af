"""Columns to rows, and rows repeated by a count."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COPIES_AT_ONCE = 10_000


def unpivot(rows: DataFrame, ids: Sequence[str], columns: Sequence[str], name: str, value: str) -> DataFrame:
    """One row per listed column, in a single scan."""
    return rows.unpivot(list(ids), list(columns), name, value)


def repeat_rows(rows: DataFrame, times: str, copies_at_once: int = COPIES_AT_ONCE) -> DataFrame:
    """Each row as often as its column `times` says; the column is dropped.

    Every row is cut into blocks of at most `copies_at_once` copies, and all blocks are spread over
    the tasks before they are expanded. A row without a positive count gives none.
    """
    n = F.col(times)
    kept = [column for column in rows.columns if column != times]
    # A stated number of partitions is kept as it is; the blocks look small, the copies are not.
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    first = F.lit(0).cast("bigint")
    blocks = rows.where(n > 0).withColumn("_block", F.explode(F.sequence(first, F.floor((n - 1) / copies_at_once))))
    size = F.least(F.lit(copies_at_once).cast("bigint"), n - F.col("_block") * copies_at_once)
    spread = blocks.repartition(tasks, *kept, "_block")
    return spread.select(*kept, F.explode(F.sequence(first + 1, size)).alias("_copy")).select(*kept)
