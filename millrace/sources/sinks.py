"""File sinks: formatted lines, appended CSV, and key/value SequenceFiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SNAPPY_CODEC = "org.apache.hadoop.io.compress.SnappyCodec"


def delimited(columns: Sequence[str], sep: str = ",") -> Column:
    """One text field out of many. A null is written as an empty field, never skipped."""
    return F.concat_ws(sep, *[F.coalesce(F.col(name).cast("string"), F.lit("")) for name in columns])


def write_lines(rows: DataFrame, path: str, sep: str = ",", compress: bool = False) -> None:
    """One line per row, the columns joined by `sep`."""
    lines = rows.select(delimited(rows.columns, sep).alias("value"))
    lines.write.text(path, compression="snappy" if compress else "none")


def append_csv(rows: DataFrame, path: str, files: int | None = None) -> None:
    """Append as CSV in at most `files` files, or without that in as many as Spark has partitions.

    The limit is a shuffle of the result and not a `coalesce`, which would also squeeze the stage
    that computes the result into as few tasks.
    """
    limited = rows.repartition(files) if files else rows
    limited.write.format("csv").mode("append").save(path)


def write_csv(rows: DataFrame, path: str, compress: bool = True) -> None:
    rows.write.option("compression", "snappy" if compress else "none").csv(path)


def write_pairs(rows: DataFrame, path: str, compress: bool = True) -> None:
    """A block-compressed SequenceFile: first column as key, the others as one JSON list.

    There is no DataFrame writer for this format, so the last step goes through pairs: it is the one
    sink that hands rows to Python. Both halves are built as text columns before that.
    """
    key, *rest = rows.columns
    quoted = F.trim(F.to_json(F.array(F.col(key).cast("string"))), F.lit("[]"))
    pairs = rows.select(
        quoted, F.concat(F.lit("["), F.concat_ws(", ", *[F.col(c).cast("string") for c in rest]), F.lit("]"))
    )
    pairs.rdd.map(tuple).saveAsSequenceFile(path, SNAPPY_CODEC if compress else None)
