"""Vectors as short codes: each part of a vector by its nearest entry of a codebook, learned by Lloyd's rounds over cover trees."""

from __future__ import annotations

import hashlib
import io
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from millrace.llm.cover_tree import CoverTree, assign, cover_tree, exact, row_squares
from millrace.llm.whitening import matrix, of_one_length, usable
from millrace.llm.words import saved

LONG_MAX = (1 << 63) - 1
#: Components of this size and more take no part: as whole numbers they would not fit a long.
TOO_LARGE = float(1 << 54)


@dataclass(frozen=True)
class Settings:
    """Each component c becomes floor(scale * c). A block of so many components is one set of trees; `tasks` tasks at most add up."""

    parts: int = 16
    entries: int = 64
    rounds: int = 2
    scale: int = 256
    block: int = 1 << 20
    tasks: int = 4096


Codebooks = list[np.ndarray]


def cuts(length: int, parts: int) -> list[int]:
    """Where the parts of a vector begin and end; of equal length where the vector's length allows it."""
    return [length * p // parts for p in range(parts + 1)]


def _packed(arrays: list[np.ndarray]) -> bytes:
    out = io.BytesIO()
    np.savez(out, *arrays)
    return out.getvalue()


def _unpacked(data: bytes) -> list[np.ndarray]:
    with np.load(io.BytesIO(data), allow_pickle=False) as stored:
        return [stored[name] for name in stored.files]


def _blocks(how: Settings, length: int):
    """One row for each block of a partition: keys, labels, and a cover tree for each part."""
    edges = cuts(length, how.parts)
    size = max(64, how.block // length)

    def row(frames: list[pd.DataFrame]) -> pd.DataFrame:
        whole = pd.concat(frames, ignore_index=True)
        points = matrix(whole["vector"], how.scale)
        trees = []
        for begin, end in zip(edges, edges[1:]):
            tree = cover_tree(points[:, begin:end])
            trees.append(_packed([getattr(tree, name) for name in CoverTree.__dataclass_fields__]))
        return pd.DataFrame({"vec_key": [whole["vec_key"].tolist()], "label": [whole["label"].tolist()], "trees": [trees]})

    def block(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        waiting, count = [], 0
        for frame in frames:
            for begin in range(0, len(frame), size):
                some = frame.iloc[begin : begin + size]
                if count and count + len(some) > size:
                    yield row(waiting)
                    waiting, count = [], 0
                waiting.append(some)
                count += len(some)
        if count:
            yield row(waiting)

    return block


def _trees(stored: list[bytes]) -> Iterator[tuple[int, CoverTree]]:
    for part, data in enumerate(stored):
        yield part, CoverTree(*_unpacked(data))


def _summed(codebooks: Codebooks):
    """part, entry, position, total, n: what the points of a partition add to each entry."""

    def add_up(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = [np.zeros(len(book), dtype=np.int64) for book in codebooks]
        sums = [np.zeros(book.shape, dtype=object) for book in codebooks]
        for frame in frames:
            for stored in frame["trees"]:
                for part, tree in _trees(stored):
                    found = assign(tree, codebooks[part])
                    counts[part] += found.counts
                    sums[part] = sums[part] + found.sums
        rows = [
            (part, entry, position, Decimal(int(sums[part][entry, position])), int(counts[part][entry]))
            for part in range(len(codebooks))
            for entry in np.flatnonzero(counts[part]).tolist()
            for position in range(sums[part].shape[1])
        ]
        yield pd.DataFrame(rows, columns=["part", "entry", "position", "total", "n"])

    return add_up


def _coded(codebooks: Codebooks):
    """vec_key, label, code, error of the rows of each block."""

    def code(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for keys, labels, stored in zip(frame["vec_key"], frame["label"], frame["trees"]):
                entries = np.zeros((len(keys), len(codebooks)), dtype=np.uint8)
                errors = np.zeros(len(keys), dtype=object)
                for part, tree in _trees(stored):
                    chosen = assign(tree, codebooks[part]).entry
                    points, book = exact(tree.points, codebooks[part])
                    entries[tree.order, part] = chosen
                    errors[tree.order] += row_squares(points, book[chosen])
                yield pd.DataFrame(
                    {
                        "vec_key": list(keys), "label": list(labels), "code": [bytes(row).hex() for row in entries],
                        "error": [min(LONG_MAX, int(e)) for e in errors],
                    }
                )

    return code


def first_codebooks(rows: DataFrame, length: int, how: Settings) -> Codebooks:
    """The parts of the vectors of the smallest keys; of equal keys the smaller vector, and no key comes last."""
    few = rows.orderBy(F.asc_nulls_last("vec_key"), "vector").limit(how.entries).select("vector").toPandas()
    points = matrix(few["vector"], how.scale)
    edges = cuts(length, how.parts)
    return [points[:, begin:end] for begin, end in zip(edges, edges[1:])]


def next_codebooks(blocks: DataFrame, codebooks: Codebooks, how: Settings) -> Codebooks:
    """Each entry becomes the mean of its points, rounded down; one without points stays."""
    whole = "decimal(38,0)"
    sums = blocks.coalesce(how.tasks).mapInPandas(_summed(codebooks), f"part int, entry int, position int, total {whole}, n long")
    found = sums.groupBy("part", "entry", "position").agg(F.sum("total").cast(whole).alias("total"), F.sum("n").alias("n")).collect()
    after = [book.copy() for book in codebooks]
    for r in found:
        after[r["part"]][r["entry"], r["position"]] = int(r["total"]) // r["n"]
    return after


def codebooks_digest(codebooks: Codebooks) -> str:
    """SHA-256 of all components of the entries by part, entry and position, in decimal and joined by commas."""
    return hashlib.sha256(",".join(str(int(x)) for book in codebooks for x in book.ravel()).encode()).hexdigest()


def vector_codes(
    vectors: DataFrame, how: Settings = Settings(), id_column: str = "vec_id", vector_column: str = "embedding", label_column: str = "label"
) -> DataFrame:
    """vec_key, label, code, error, label_error, codebooks_sha256 of every vector.

    Rows are cut into blocks of a bounded size. Each block is stored once, with a cover tree of each part; a round sends the codebooks
    to the blocks, whose trees assign whole subtrees where the triangle inequality allows it and compare the rest exactly. All
    numbers are whole, so the result does not depend on how the rows are cut into blocks. What comes to the driver are the sums
    of each entry.

    Vectors that are null, empty, of another length than most, or hold null or non-finite components, or ones of 2^54 and more, take no
    part. Repeated rows and null ids each get a row. A length that is no multiple of the parts is cut as evenly as it goes; a
    part without components has code 0 and no error. With fewer vectors than entries there are as many entries as vectors.
    An error beyond the largest long is the largest long. Labels may be null; they are one group. An empty table
    gives an empty result.
    """
    plain = vectors.select(
        F.col(f"`{id_column}`").alias("vec_key"), F.col(f"`{label_column}`").alias("label"), F.col(f"`{vector_column}`").cast("array<double>").alias("vector")
    )
    key, label = (plain.schema[name].dataType.simpleString() for name in ("vec_key", "label"))
    rows, length = of_one_length(saved(plain.where(usable(F.col("vector"), TOO_LARGE)), "vectors"))
    if not length:
        empty = f"vec_key {key}, label {label}, code string, error long, label_error long, codebooks_sha256 string"
        return vectors.sparkSession.createDataFrame([], empty)
    codebooks = first_codebooks(rows, length, how)
    # Keys and labels travel as text, as pandas has no null among whole numbers.
    texts = rows.select(F.col("vec_key").cast("string"), F.col("label").cast("string"), "vector")
    blocks = saved(texts.mapInPandas(_blocks(how, length), "vec_key array<string>, label array<string>, trees array<binary>"), "trees")
    for _ in range(how.rounds):
        codebooks = next_codebooks(blocks, codebooks, how)
    coded = blocks.mapInPandas(_coded(codebooks), "vec_key string, label string, code string, error long")
    coded = saved(coded.select(F.col("vec_key").cast(key), F.col("label").cast(label), "code", "error"), "codes")
    summed = F.sum(F.col("error").cast("decimal(38,0)"))
    by_label = coded.groupBy("label").agg(F.least(summed, F.lit(LONG_MAX).cast("decimal(38,0)")).cast("long").alias("label_error"))
    by_label = by_label.withColumnRenamed("label", "of_label")
    joined = coded.join(by_label, F.col("label").eqNullSafe(F.col("of_label")), "left")
    return joined.select("vec_key", "label", "code", "error", "label_error", F.lit(codebooks_digest(codebooks)).alias("codebooks_sha256"))
