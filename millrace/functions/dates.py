"""Date texts of the price and sensor feeds. The formats are fixed values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BID_HOUR = "HH-dd-MM-yyyy"
MINUTE = "yyyy-MM-dd HH:mm"


def bid_hour(text: Column | str) -> Column:
    """`11-05-06-2011` becomes `2011-06-05 11:00`; an unreadable date becomes null."""
    return F.date_format(F.try_to_timestamp(text, F.lit(BID_HOUR)), MINUTE)


def gmt_time(date: Column | str, time: Column | str) -> Column:
    """The timestamp of a GMT date text and a time text; null when unreadable."""
    return F.try_to_timestamp(F.concat_ws(" ", date, time), F.lit(MINUTE))
