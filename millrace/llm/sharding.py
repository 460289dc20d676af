"""Shards of near-equal size: sampled splitters range-partition the records by key, and prefix sums of the ranges place each one."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Row, functions as F
from pyspark.sql.window import Window

from millrace.llm.words import saved

#: What a record costs besides its text.
OVERHEAD = 8
#: Parts of one that a sample is drawn by.
DRAWS = 1 << 40


@dataclass(frozen=True)
class Shards:
    """A shard is cut into `ranges` ranges or more, of at most about `range_bytes` each, from about `samples` keys for a range.

    Equal texts stay in one shard unless they hold more than one part in `slack` of a shard.
    """

    shards: int = 24
    ranges: int = 8
    range_bytes: int = 1 << 30
    samples: int = 16
    slack: int = 50
    seed: int = 12


def _digits(text: Column, digits: int) -> Column:
    return F.conv(F.substring(F.md5(text), 1, digits), 16, 10).cast("long")


def keyed(docs: DataFrame, id_column: str, text_column: str, carried: Sequence[str]) -> DataFrame:
    """row, size, text_crc32 and the key: `h` from the text, `u` from the id, so that equal texts are neighbours.

    The last bits of `u` differ between repeated rows, which lets even those be parted. They depend on where a row was read, so
    the keys are written before they are used.
    """
    text = F.coalesce(F.col(f"`{text_column}`").cast("string"), F.lit(""))
    salt = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(1 << 20))
    return docs.select(
        F.struct(*(F.col(f"`{c}`") for c in carried)).alias("row"),
        (F.octet_length(text) + OVERHEAD).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        _digits(text, 15).alias("h"),
        (_digits(F.coalesce(F.col(f"`{id_column}`").cast("string"), F.lit("")), 10) * (1 << 20) + salt).alias("u"),
    )


#: The first key of a range: all records of the text hash h, or of those only from u on.
Splitter = tuple[int, int]
WHOLE = -1


def splitters(sample: list[tuple[int, int, float]], goal: float) -> list[Splitter]:
    """Quantiles of a weighted sample of keys, about `goal` apart.

    A range begins at the first record of a text, so that equal texts are one range, unless they weigh more than a range alone.
    """
    found: list[Splitter] = []
    filled = 0.0
    ordered = sorted(sample)
    i = 0
    while i < len(ordered):
        h, end = ordered[i][0], i
        while end < len(ordered) and ordered[end][0] == h:
            end += 1
        weight = sum(w for _, _, w in ordered[i:end])
        if filled and filled + weight > goal:
            found.append((h, WHOLE))
            filled = 0.0
        if weight > goal:
            for _, u, w in ordered[i:end]:
                if filled and filled + w > goal:
                    found.append((h, u))
                    filled = 0.0
                filled += w
        else:
            filled += weight
        i = end
    return sorted(set(found))


def range_of(bounds: list[Splitter]):
    """A column expression of (h, u): how many splitters are not beyond a key."""
    heads = np.array([h for h, _ in bounds], dtype=np.int64)
    by_text: dict[int, list[int]] = {}
    for h, u in bounds:
        by_text.setdefault(h, []).append(u)
    inside = {h: np.array(us, dtype=np.int64) for h, us in by_text.items() if us != [WHOLE]}
    whole = np.array([h for h, us in by_text.items() if us == [WHOLE]], dtype=np.int64)
    parted = np.array(sorted(inside), dtype=np.int64)

    @F.pandas_udf("int")
    def place(h: pd.Series, u: pd.Series) -> pd.Series:
        keys = h.to_numpy()
        found = np.searchsorted(heads, keys, side="left")
        found = found + np.isin(keys, whole)
        for head in np.intersect1d(keys, parted).tolist():
            mine = keys == head
            found[mine] += np.searchsorted(inside[head], u.to_numpy()[mine], side="right")
        return pd.Series(found)

    return place(F.col("h"), F.col("u")) if bounds else F.lit(0)


def _sampled(rows: DataFrame, step: float, seed: int) -> list[tuple[int, int, float]]:
    """Keys drawn with a chance of size / step, at most one; each stands for the greater of its size and `step`."""
    draw = F.pmod(F.xxhash64("h", "u", F.lit(seed)), F.lit(DRAWS)) / F.lit(float(DRAWS))
    drawn = rows.where(draw < F.col("size") / F.lit(step)).select("h", "u", F.greatest(F.col("size").cast("double"), F.lit(step)).alias("weight"))
    return [tuple(r) for r in drawn.collect()]


def _measured(rows: DataFrame, bounds: list[Splitter]) -> list[Row]:
    """Exact bytes, the largest record, rows, and the first and last key of each range."""
    key = F.struct("h", "u")
    measures = F.sum("size").alias("bytes"), F.max("size").alias("largest"), F.count("*").alias("rows"), F.min(key).alias("low"), F.max(key).alias("high")
    return rows.groupBy(range_of(bounds).alias("range")).agg(*measures).orderBy("range").collect()


def sampled_ranges(rows: DataFrame, total: int, how: Shards) -> list[Splitter]:
    """Splitters whose ranges hold at most twice the bytes asked for and one record.

    Quantiles of a sample leave some ranges overfull; those are sampled again, four times as densely each time, and divided.
    """
    wanted = max(how.shards * how.ranges, -(-total // how.range_bytes))
    goal = total / wanted
    step = goal / how.samples
    bounds = splitters(_sampled(rows, step, how.seed), goal)
    tries = 0
    while True:
        overfull = [r["range"] for r in _measured(rows, bounds) if r["bytes"] - r["largest"] > 2 * goal and r["low"] != r["high"]]
        # With a step below the smallest size every record has been drawn.
        if not overfull or step < OVERHEAD:
            return bounds
        tries += 1
        step /= 4
        crowded = rows.where(range_of(bounds).isin(overfull))
        bounds = sorted({*bounds, *splitters(_sampled(crowded, step, how.seed + tries), goal)})


def _without_light_cuts(rows: DataFrame, bounds: list[Splitter], total: int, how: Shards) -> list[Splitter]:
    """The splitters without those inside texts that are to stay whole, which a sample may have weighed too heavy."""
    cut = sorted({h for h, u in bounds if u != WHOLE})
    if not cut:
        return bounds
    weights = rows.where(F.col("h").isin(cut)).groupBy("h").agg(F.sum("size").alias("bytes")).collect()
    heavy = {r["h"] for r in weights if r["bytes"] * how.shards * how.slack > total}
    return [(h, u) for h, u in bounds if u == WHOLE or h in heavy]


def sharded(docs: DataFrame, how: Shards = Shards(), id_column: str = "doc_id", text_column: str = "text", carried: Sequence[str] | None = None) -> DataFrame:
    """row, size, text_crc32, shard, slot of each record; `row` has the `carried` columns, all where that is None.

    Records are in the order of a hash of their text, then of their id. Keys drawn with chances by size give the splitters of ranges;
    ranges that turn out overfull are divided. The exact bytes before each range, and running sums within it, give each
    record its place in the order by bytes; a shard is one of equal pieces of all bytes, and slots count its records in that order. So
    sizes differ by one record, or by one group of equal texts of up to 1 / slack of a shard, which is not cut.
    No task holds more than a range, and a heavy group of equal texts is cut into ranges like the rest.

    A null text has no bytes and the checksum 0. Null and repeated ids are only carried and hashed; repeated rows have places of their
    own. A record larger than a shard leaves its neighbours empty. An empty table gives an empty result.
    """
    carried = docs.columns if carried is None else carried
    rows = saved(keyed(docs, id_column, text_column, carried), "keyed")
    total = rows.agg(F.sum("size")).first()[0]
    if total is None:
        return rows.select("row", "size", "text_crc32", F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))
    keys = rows.select("h", "u", "size")
    bounds = _without_light_cuts(keys, sampled_ranges(keys, total, how), total, how)

    # One line for each range: what lies before it, and the texts that it shares with a neighbour.
    lines, byte, record = [], 0, 0
    for r in _measured(keys, bounds):
        begins, ends = bounds[r["range"] - 1] if r["range"] else (None, WHOLE), bounds[r["range"]] if r["range"] < len(bounds) else (None, WHOLE)
        lines.append((r["range"], byte, record, begins[0] if begins[1] != WHOLE else None, ends[0] if ends[1] != WHOLE else None))
        byte, record = byte + r["bytes"], record + r["rows"]
    ranges = rows.sparkSession.createDataFrame(lines, "range int, first_byte long, first_record long, cut_low long, cut_high long")

    order = Window.partitionBy("range").orderBy("h", "u")
    text = Window.partitionBy("range", "h")
    placed = rows.withColumn("range", range_of(bounds)).join(ranges, "range")
    placed = placed.withColumn("end", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    placed = placed.withColumn("record", F.col("first_record") + F.row_number().over(order) - 1)
    placed = placed.withColumns({"of_text": F.sum("size").over(text), "text_end": F.max("end").over(text)})
    is_cut = F.coalesce(F.col("h") == F.col("cut_low"), F.lit(False)) | F.coalesce(F.col("h") == F.col("cut_high"), F.lit(False))
    is_cut = is_cut | (F.col("of_text") * (how.shards * how.slack) > total)
    # Twice the middle, in bytes, of the record or of the texts it stays with.
    middle = F.col("first_byte") * 2 + F.when(is_cut, F.col("end") * 2 - F.col("size")).otherwise(F.col("text_end") * 2 - F.col("of_text"))
    placed = placed.withColumn("middle", middle.cast("decimal(28,0)"))
    shard = F.expr(f"cast((middle * cast({how.shards} as decimal(9,0))) div cast({2 * total} as decimal(28,0)) as int)")
    placed = saved(placed.select("row", "size", "text_crc32", "record", F.least(shard, F.lit(how.shards - 1)).alias("shard")), "placed")
    firsts = placed.groupBy("shard").agg(F.min("record").alias("first"))
    return placed.join(firsts, "shard").select("row", "size", "text_crc32", "shard", (F.col("record") - F.col("first")).alias("slot"))


def write_shards(placed: DataFrame, path: str) -> None:
    """slot and row as Parquet, a folder for each shard; its files, in the order of their names, hold its slots in order."""
    spread = placed.select("shard", "slot", "row").repartitionByRange("shard", "slot")
    spread.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
