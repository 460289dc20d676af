"""Joins that reduce the large side by the join key before it is shuffled."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def count_by(rows: DataFrame, *keys: str, n: str = "n") -> DataFrame:
    """Rows per key. Counting on the join key first turns a hot key into one row per map task,
    and the join that follows uses the same partitioning."""
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias(n))


def with_lookup(rows: DataFrame, lookup: DataFrame | None, key: str, name: str = "name") -> DataFrame:
    """`rows` with the name of their key, null where the lookup has none.

    An id that the lookup lists twice takes the smallest name, so rows are never doubled. Without
    a lookup the key itself is the name. Spark broadcasts the lookup when its size allows.
    """
    if lookup is None:
        return rows.withColumn(name, F.col(key).cast("string"))
    names = lookup.groupBy(key).agg(F.min(name).alias(name))
    return rows.join(names, key, "left")


def matched(rows: DataFrame, name: str = "name") -> DataFrame:
    return rows.where(F.col(name).isNotNull())


def unmatched(rows: DataFrame, name: str = "name") -> DataFrame:
    return rows.where(F.col(name).isNull())
