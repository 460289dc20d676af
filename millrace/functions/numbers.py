"""Tolerant numbers and one rounding rule for all jobs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def round_half_up(value: Column | str, digits: int) -> Column:
    """Half-up rounding of a non-negative double, in arithmetic every engine agrees on."""
    scale = float(10**digits)
    return F.floor(as_column(value) * scale + 0.5) / scale


def number(text: Column | str) -> Column:
    """A double, or null when the text is not a number."""
    return as_column(text).try_cast("double")


def to_euro(price: Column | str, rate: Column | str) -> Column:
    """Price times rate with three decimals; null when either is empty or unreadable."""
    return round_half_up(number(price) * number(rate), 3)


def byte_count(field: Column | str) -> Column:
    """The size field of an access-log line: `-` is 0, a number too long for a bigint is null."""
    text = as_column(field)
    return F.when(text == "-", F.lit(0).cast("bigint")).otherwise(text.try_cast("bigint"))
