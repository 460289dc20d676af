"""Physical layout of a result."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.session import run_folder


def partition_and_sort(
    rows: DataFrame, partitions: int | None, by: Sequence[str], within: Sequence[str]
) -> DataFrame:
    """All rows of one `by` key together, sorted by `within` inside each partition.

    Meant for aggregated rows: the number of rows per key is then bounded by the other keys.
    """
    spread = rows.repartition(partitions, *by) if partitions else rows.repartition(*by)
    return spread.sortWithinPartitions(*within)


def with_parallelism(rows: DataFrame, partitions: int | None) -> DataFrame:
    """A fixed number of output partitions, or whatever adaptive execution chooses."""
    return rows.repartition(partitions) if partitions else rows


def _ranged(rows: DataFrame, by: str, order: Sequence[str]) -> DataFrame:
    """Rows in one sorted sequence over all partitions, cut at sampled keys; one value of `by` may take many partitions."""
    return rows.repartitionByRange(by, *order).sortWithinPartitions(by, *order)


def write_routed(rows: DataFrame, path: str, route: str, order: Sequence[str], fmt: str = "parquet") -> None:
    """A folder for each value of `route`; its files, in the order of their names, are its rows in `order`.

    A value with most of the rows is written by many tasks. Rows that are equal in all of `order` stay together, so the last columns of
    `order` should tell rows apart.
    """
    _ranged(rows, route, order).write.partitionBy(route).format(fmt).save(path)


def _file_number() -> Column:
    """The number of a written file: its task's, and that of the file within the task."""
    name = F.col("_metadata.file_name")
    task, file = (F.regexp_extract(name, pattern, 1).cast("bigint") for pattern in (r"part-(\d+)", r"[.-]c(\d+)"))
    return (task * 1_000_000 + file).alias("_file")


def in_file_order(spark: SparkSession, path: str, by: str, out: str) -> DataFrame:
    """The rows of a Parquet folder with their place, from 0, among those of their `by` value, in the order of file names and rows.

    What is moved is a line for each file and value: where its rows begin there, and how many files before it has.
    """
    rows = spark.read.parquet(path).select("*", _file_number(), F.col("_metadata.row_index").alias("_row"))
    lines = rows.groupBy(by, "_file").agg(F.min("_row").alias("_first"), F.count("*").alias("_rows"))
    before = Window.partitionBy(by).orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    starts = lines.withColumn("_before", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
    starts = starts.select(F.col(by).alias("_by"), F.col("_file").alias("_of"), "_first", "_before")
    known = rows.join(starts, F.col(by).eqNullSafe(F.col("_by")) & (F.col("_file") == F.col("_of")))
    place = (F.col("_before") + F.col("_row") - F.col("_first")).alias(out)
    return known.select(*[c for c in rows.columns if c not in ("_file", "_row")], place)


def numbered(rows: DataFrame, by: str, order: Sequence[str], out: str) -> DataFrame:
    """`rows` numbered without gaps from 0 within each value of `by`, in `order`, which must tell rows apart.

    The rows are written once in sampled ranges; a number is the row's place in its file and the count of what lies before. No task
    sorts more than a range, however many rows a value has, and a task that runs again gives the same numbers.
    """
    folder = run_folder(rows.sparkSession, "numbered")
    _ranged(rows, by, order).write.parquet(folder)
    return in_file_order(rows.sparkSession, folder, by, out)
