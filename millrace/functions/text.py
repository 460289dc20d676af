"""Words of a text column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: a word is a run of letters, digits of any script, underscores and apostrophes.
WORD = r"[\p{L}\p{N}_']+"


def words(text: Column | str, pattern: str = WORD) -> Column:
    """All words of a text, in order, as an array."""
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
