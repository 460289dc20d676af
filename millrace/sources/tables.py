"""Readers: text lines, delimited files, Parquet, and tables loaded with overwrite."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.schemas import strings


def read_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """One row per line in column `value`, from one path or many."""
    return spark.read.text([paths] if isinstance(paths, str) else list(paths))


def read_table(spark: SparkSession, path: str, names: Sequence[str], sep: str = ",") -> DataFrame:
    """Parquet when the path says so, else a headerless delimited file of strings.

    Short rows are padded with nulls and extra fields are ignored.
    """
    if path.endswith(".parquet"):
        return spark.read.parquet(path)
    return spark.read.schema(strings(names)).csv(path, sep=sep)


def read_quoted(
    spark: SparkSession, path: str, columns: Mapping[str, str], sep: str = ",", header: bool = True
) -> DataFrame:
    """A delimited file with quoted fields, typed afterwards.

    The fields are read as text first, so a field that does not fit its type becomes null and
    the row stays.
    """
    text = spark.read.schema(strings(columns)).csv(path, sep=sep, quote='"', header=header)
    return text.select(
        *[
            F.col(name) if kind == "string" else F.col(name).try_cast(kind).alias(name)
            for name, kind in columns.items()
        ]
    )


def load_overwrite(rows: DataFrame, path: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Replace the Parquet table at `path` with `rows` and return a scan of it."""
    rows.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return rows.sparkSession.read.parquet(path)


def save_bucketed(rows: DataFrame, name: str, path: str, keys: Sequence[str], buckets: int) -> DataFrame:
    """Replaces the catalog table `name` at `path`, cut into buckets by its keys and sorted by them, and returns a scan of it.

    Tables with the same number of buckets on their join keys are joined, and grouped by them, where they lie. Rows are moved to their bucket once,
    so each is one file; choose the buckets so that the largest fits a task.
    """
    spread = rows.repartition(buckets, *keys)
    spread.write.mode("overwrite").option("path", path).bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name)
    return rows.sparkSession.table(name)


def overwrite_partitions(rows: DataFrame, path: str, partition_by: Sequence[str]) -> DataFrame:
    """Replaces those partitions of the Parquet table at `path` that `rows` has, leaves the others, and returns a scan of all."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)
    return rows.sparkSession.read.parquet(path)


def read_lookup(spark: SparkSession, path: str, key: str = "id", name: str = "name") -> DataFrame:
    """An id-to-name file: an id, white space, and the rest of the line as the name. `rejected_lookup` has the other lines."""
    return _lookup_lines(spark, path).where(F.size("fields") == 2).select(F.col("fields")[0].alias(key), F.col("fields")[1].alias(name))


def rejected_lookup(spark: SparkSession, path: str) -> DataFrame:
    """The lines of an id-to-name file that lack an id or a name."""
    return _lookup_lines(spark, path).where(F.size("fields") != 2).select("value")


def _lookup_lines(spark: SparkSession, path: str) -> DataFrame:
    text = F.regexp_replace("value", r"^\s+|\s+$", "")
    return read_lines(spark, path).withColumn("fields", F.split(text, r"\s+", 2))
