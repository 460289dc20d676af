"""Best row, most frequent value and top rows, without a window over a whole group.

A window keeps every row of a group in one task. The functions here reduce on the map side
first, so a group that holds a large part of all rows costs no more than any other.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.reshaping import repeat_rows, unpivot


def best_rows(rows: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Every row whose value equals the maximum of its group, ties and copies included.

    The maximum per group is a partial aggregate. The rows then meet it in a semi join on keys
    and value: rows of a large group spread over their values, and a partition of many equal
    winners is split by adaptive execution. Rows without a value never win.
    """
    top = rows.groupBy(*keys).agg(F.max(value).alias("_top"))
    top = top.select(*[F.col(key).alias(f"_{key}") for key in keys], "_top")
    same_group = [F.col(key).eqNullSafe(F.col(f"_{key}")) for key in keys]
    return rows.join(top, [*same_group, F.col(value) == F.col("_top")], "left_semi")


def best_of_columns(rows: DataFrame, keys: Sequence[str], columns: Sequence[str], name: str, value: str) -> DataFrame:
    """(keys, name, value): every column and row that reaches the group's greatest value of all columns, ties and copies included.

    The same as `best_rows` of the unpivoted columns, from one scan: the greatest of a row needs no group, equal ones are counted,
    and only the winners become rows. A null never wins.

    Rows are dealt by group and the task that read them, so a large group is spread over all tasks and leaves one row for each. A stated
    number of partitions is not merged by adaptive execution: compressed rows look small, the tables that aggregate them are not.
    """
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    best_of_row = rows.select(*keys, *columns, F.greatest(*columns).alias("_best"), F.spark_partition_id().alias("_from"))
    reached = [F.col(column).eqNullSafe(F.col("_best")).alias(column) for column in columns]
    flagged = best_of_row.where(F.col("_best").isNotNull()).select(*keys, "_from", "_best", *reached)
    of_task = _best_counts(flagged.repartition(tasks, *keys, "_from"), [*keys, "_from"], columns, F.count_if)
    top = _best_counts(of_task.repartition(tasks, *keys), keys, columns, F.sum)
    winners = unpivot(top, [*keys, "_best"], columns, name, "_n").where(F.col("_n") > 0)
    return repeat_rows(winners.select(*keys, name, F.col("_best").alias(value), "_n"), "_n")


def _best_counts(rows: DataFrame, keys: Sequence[str], columns: Sequence[str], total: Callable) -> DataFrame:
    """The greatest `_best` of each group, with the `total` of each of `columns` over the rows that have it."""
    counted = rows.groupBy(*keys, "_best").agg(*[total(column).alias(column) for column in columns])
    at_top = [F.max_by(column, "_best").alias(column) for column in columns]
    return counted.groupBy(*keys).agg(F.max("_best").alias("_best"), *at_top)


def first_best(
    rows: DataFrame, keys: Sequence[str], value: str, ties: Sequence[str], carry: Sequence[str] = ()
) -> DataFrame:
    """One row per group: largest numeric value, then the smallest `ties`; `carry` comes along."""
    order = F.struct((-F.col(value)).alias("_descending"), F.col(value), *ties, *carry)
    best = rows.where(F.col(value).isNotNull()).groupBy(*keys).agg(F.min(order).alias("_best"))
    return best.select(*keys, *[f"_best.{name}" for name in dict.fromkeys([value, *ties, *carry])])


def most_frequent(rows: DataFrame, keys: Sequence[str], attribute: str) -> DataFrame:
    """The most frequent value per group; of equally frequent ones the smallest."""
    counts = rows.groupBy(*keys, attribute).agg(F.count(F.lit(1)).alias("_n"))
    return most_counted(counts, keys, attribute, "_n")


def most_counted(counts: DataFrame, keys: Sequence[str], attribute: str, n: str) -> DataFrame:
    """`most_frequent` over rows that are counted already."""
    order = F.struct((-F.col(n)).alias("_descending"), F.col(attribute))
    return counts.groupBy(*keys).agg(F.min(order)[attribute].alias(attribute))


def top_rows(rows: DataFrame, limit: int, *order) -> DataFrame:
    """The first rows of an order; give it enough columns to leave no ties."""
    return rows.orderBy(*order).limit(limit)
