"""Sensor records: device key, the four score columns, JSON in and out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.schemas import DEVICE_KEY_FIELDS, READING_FIELDS, READING_MESSAGE, SCORE_FIELDS


def device_key() -> Column:
    """The key under which a device publishes."""
    return F.concat_ws("-", *DEVICE_KEY_FIELDS)


def complete(rows: DataFrame, *also: str) -> DataFrame:
    """All 28 fields: empty texts for nulls, and zero for a score that is absent or null."""
    texts = [F.coalesce(F.col(name).cast("string"), F.lit("")).alias(name) for name in READING_FIELDS]
    scores = [
        (F.coalesce(F.col(name).cast("double"), F.lit(0.0)) if name in rows.columns else F.lit(0.0)).alias(name)
        for name in SCORE_FIELDS
    ]
    return rows.select(*also, *texts, *scores)


def record_json(*also: str) -> Column:
    """The 28 fields, and further columns, as one JSON object."""
    return F.to_json(F.struct(*READING_FIELDS, *SCORE_FIELDS, *also))


def to_messages(rows: DataFrame) -> DataFrame:
    """Records as `key`, `value` messages."""
    return complete(rows).select(device_key().alias("key"), record_json().alias("value"))


def from_json_text(text: Column | str) -> Column:
    """The record in a JSON text, as a struct; null fields where it does not parse."""
    return F.from_json(text, READING_MESSAGE)


def parsed_fields(text: Column | str, *names: str) -> Column:
    """Text fields of the record in a JSON text, as columns of their own."""
    return F.inline(F.array(F.from_json(text, ", ".join(f"{name} string" for name in names))))


def drifting_fields(rows: DataFrame, text: str, *names: str) -> DataFrame:
    """`rows` with fields of the JSON object in a column as texts, whatever types they have there; null where there is no object."""
    fields = F.struct(*(F.try_variant_get("_object", f"$.{name}", "string").alias(name) for name in names))
    # As in parsed_fields: filters on the fields stay above the `inline`, which else would parse the text for each mention of one.
    return rows.withColumn("_object", F.try_parse_json(text)).select(*rows.columns, F.inline(F.array(fields)))


def drifting_json(text: Column | str, changed: dict[str, Column]) -> Column:
    """The JSON object of a text with some fields set and all others as they are, also those that no schema knows.

    Null where the text is no object, or one that repeats a name.
    """
    known = F.try_parse_json(text).try_cast("map<string,variant>")
    kept = F.map_filter(known, lambda name, _: ~name.isin(*changed))
    pairs = [x for name, value in changed.items() for x in (F.lit(name), value.cast("variant"))]
    return F.to_json(F.map_concat(kept, F.create_map(*pairs)))
