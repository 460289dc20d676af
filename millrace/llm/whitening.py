"""Whitening of vectors: exact integer cross-products from bit planes, centred as integers, and the eigenvectors of their covariance."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from millrace.llm.words import saved

LONG_MAX = (1 << 63) - 1
#: Components of this size and more take no part: a sum of their products would not fit decimal(38,0).
TOO_LARGE = float(1 << 30)


@dataclass(frozen=True)
class Settings:
    """x = floor(scale * c) + offset for each component c. A block of rows is packed at a time; at most `tasks` tasks add up products."""

    components: int = 8
    scale: int = 1024
    offset: int = 100_000
    rows_in_block: int = 8192
    tasks: int = 4096


@dataclass(frozen=True)
class Whitening:
    """n vectors with `sums` by dimension; columns of `directions` are unit eigenvectors of the covariance, by falling eigenvalue."""

    n: int
    sums: list[int]
    directions: np.ndarray
    variances: np.ndarray
    trace: float

    def varies(self) -> np.ndarray:
        """Which components are more than rounding."""
        least = len(self.sums) * np.finfo(float).eps * max(float(self.variances[0]), 0.0) if len(self.variances) else 0.0
        return self.variances > least


def usable(vector: Column, below: float) -> Column:
    """Whether a vector has components, all of them numbers below a size."""
    return F.coalesce((F.size(vector) > 0) & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < below)), F.lit(False))


def of_one_length(rows: DataFrame) -> tuple[DataFrame, int]:
    """The rows whose `vector` has the commonest length, the shorter one of equals, and that length; 0 where there are none."""
    common = rows.groupBy(F.size("vector").alias("length")).count().orderBy(F.desc("count"), "length").first()
    return (rows, 0) if common is None else (rows.where(F.size("vector") == common["length"]), common["length"])


def matrix(column: pd.Series, scale: int, offset: int = 0) -> np.ndarray:
    return np.floor(np.array(column.tolist(), dtype=np.float64) * scale).astype(np.int64) + offset


def planes_of(block: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words, dimension, bit) of the bit planes of whole non-negative numbers: a plane has one bit for each row, 64 rows to a word."""
    rows, width = block.shape
    words, dimension, bit = [], [], []
    for d in range(width):
        column = block[:, d]
        for b in range(int(column.max()).bit_length()):
            packed = np.packbits(((column >> b) & 1).astype(np.uint8))
            words.append(np.pad(packed, (0, -len(packed) % 8)).view(np.uint64))
            dimension.append(d)
            bit.append(b)
    if not words:
        return np.zeros((0, -(-rows // 64)), dtype=np.uint64), np.zeros(0, dtype=int), np.zeros(0, dtype=int)
    return np.stack(words), np.array(dimension), np.array(bit)


def scatter(block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums by dimension and the matrix of summed products of a block of whole numbers, exact, as Python's integers.

    Each dimension is shifted to start at zero. The product of two dimensions is then the sum, over pairs of their planes, of the
    bits that are set in both, weighted by the two bits' places; the shifts are put back at the end.
    """
    rows, width = block.shape
    low = block.min(axis=0)
    words, dimension, bit = planes_of(block - low)
    weight = np.array([1 << int(b) for b in bit], dtype=object)
    sums = np.zeros(width, dtype=object)
    products = np.zeros((width, width), dtype=object)
    if len(words):
        np.add.at(sums, dimension, np.bitwise_count(words).sum(axis=1).astype(object) * weight)
        begins = np.flatnonzero(np.diff(dimension, prepend=-1))
        present = dimension[begins]
        # A sum of `rows` products fits 64 bits unless two dimensions are very wide.
        narrow = 2 * (int(bit.max()) + 1) + rows.bit_length() < 62
        weight = weight.astype(np.int64) if narrow else weight
        for p, own in enumerate(words):
            both = np.bitwise_count(words & own).sum(axis=1, dtype=np.int64)
            both = both * weight if narrow else both.astype(object) * weight
            products[dimension[p], present] += np.add.reduceat(both, begins).astype(object) * int(weight[p])
    shift = low.astype(object)
    products = products + np.outer(sums, shift) + np.outer(shift, sums) + rows * np.outer(shift, shift)
    return sums + rows * shift, products


def _scattered(how: Settings):
    """One row for each pair of dimensions of a partition: how often, sums, product."""

    def add_up(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        count, sums, products = 0, None, None
        for frame in frames:
            for begin in range(0, len(frame), how.rows_in_block):
                some = matrix(frame["vector"].iloc[begin : begin + how.rows_in_block], how.scale, how.offset)
                own_sums, own_products = scatter(some)
                sums = own_sums if sums is None else sums + own_sums
                products = own_products if products is None else products + own_products
                count += len(some)
        if count:
            upper = list(zip(*np.triu_indices(len(sums))))
            yield pd.DataFrame(
                {
                    "i": [int(i) for i, _ in upper], "j": [int(j) for _, j in upper], "n": count,
                    "total": [Decimal(int(sums[i])) for i, _ in upper], "product": [Decimal(int(products[i, j])) for i, j in upper],
                }
            )

    return add_up


def covariance(n: int, sums: list[int], products: dict[tuple[int, int], int]) -> np.ndarray:
    """Centred as integers, and divided last: (n * product - sum * sum) / n / n."""
    out = np.zeros((len(sums), len(sums)))
    for (i, j), product in products.items():
        out[i, j] = out[j, i] = (n * product - sums[i] * sums[j]) / (n * n)
    return out


def fitted(rows: DataFrame, how: Settings = Settings()) -> Whitening | None:
    """The whitening of all of `rows` (`vector`, of one length); None where there are none. What comes to the driver is one matrix."""
    wide = rows.select("vector")
    parts = wide.coalesce(how.tasks).mapInPandas(_scattered(how), "i int, j int, n long, total decimal(38,0), product decimal(38,0)")
    whole = "decimal(38,0)"
    summed = parts.groupBy("i", "j").agg(F.sum("n").alias("n"), F.sum("total").cast(whole).alias("total"), F.sum("product").cast(whole).alias("product"))
    pairs = summed.collect()
    if not pairs:
        return None
    n = pairs[0]["n"]
    sums = [int(r["total"]) for r in sorted((r for r in pairs if r["i"] == r["j"]), key=lambda r: r["i"])]
    spread = covariance(n, sums, {(r["i"], r["j"]): int(r["product"]) for r in pairs})
    values, vectors = np.linalg.eigh(spread)
    order = np.argsort(-values, kind="stable")[: how.components]
    directions = vectors[:, order]
    # Either sign is right; the largest entry of each is made positive, so that it is always the same.
    heads = directions[np.abs(directions).argmax(axis=0), np.arange(directions.shape[1])]
    return Whitening(n, sums, directions * np.where(heads < 0, -1.0, 1.0), values[order], float(np.trace(spread)))


def _projected(whitening: Whitening, how: Settings):
    n, sums, varies = whitening.n, np.array(whitening.sums, dtype=object), whitening.varies()
    scale = np.where(varies, 1 / np.sqrt(np.where(varies, whitening.variances, 1.0)), 0.0)
    turn = whitening.directions * scale

    def project(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if frame.empty:
                continue
            x = matrix(frame["vector"], how.scale, how.offset)
            far = max(int(np.abs(x).max()) * n, int(np.abs(sums).max()))
            apart = n * x - sums.astype(np.int64) if far < 1 << 62 else n * x.astype(object) - sums
            wide = max(abs(int(apart.max())), abs(int(apart.min())))
            if wide * wide * x.shape[1] > LONG_MAX:
                apart = apart.astype(object)
                deviation = [min(LONG_MAX, int(s)) for s in (apart * apart).sum(axis=1)]
            else:
                deviation = (apart * apart).sum(axis=1)
            centred = (apart / n).astype(np.float64)
            yield pd.DataFrame({"vec_key": frame["vec_key"], "deviation": deviation, "whitened": list(centred @ turn)})

    return project


def identity_error(scored: DataFrame, components: list[int]) -> float:
    """The largest entry of the covariance of `whitened`, less the identity; means are subtracted before multiplying."""
    if not components:
        return 0.0
    value = {k: F.col("whitened")[k] for k in components}
    means = scored.agg(*(F.avg(value[k]).alias(f"m{k}") for k in components)).first()
    pairs = [(i, j) for i in components for j in components if i <= j]
    products = scored.agg(*(F.avg((value[i] - means[f"m{i}"]) * (value[j] - means[f"m{j}"])).alias(f"p{i}_{j}") for i, j in pairs)).first()
    return max(abs(products[f"p{i}_{j}"] - (i == j)) for i, j in pairs)


def whitened(vectors: DataFrame, how: Settings = Settings(), id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """vec_key, component, n, deviation, whitened, explained, identity_error: every vector on each of the first components.

    Bit planes give the products of all pairs of dimensions of a block of rows, tasks add their blocks up, and Spark adds up the
    tasks. The covariance is centred in whole numbers, and its eigenvectors are found on the driver from one matrix of the
    vectors' length. The covariance of the result is measured over all rows.

    Vectors that are null, empty, of another length than most, or hold null or non-finite components, or ones of 2^30 and more, take no
    part. Ids are only carried: null and repeated ones each give their rows. A component along which nothing varies has whitened 0
    and is left out of identity_error; a vector of fewer dimensions has fewer components. A deviation that does not
    fit a long is the largest long. An empty table gives an empty result.
    """
    plain = vectors.select(F.col(f"`{id_column}`").alias("vec_key"), F.col(f"`{vector_column}`").cast("array<double>").alias("vector"))
    rows, length = of_one_length(saved(plain.where(usable(F.col("vector"), TOO_LARGE)), "vectors"))
    whitening = fitted(rows, how) if length else None
    kind = rows.schema["vec_key"].dataType.simpleString()
    if whitening is None:
        schema = f"vec_key {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
        return vectors.sparkSession.createDataFrame([], schema)
    # As text on the way through pandas, which has no null among whole numbers.
    asked = rows.withColumn("vec_key", F.col("vec_key").cast("string"))
    scored = saved(asked.mapInPandas(_projected(whitening, how), "vec_key string, deviation long, whitened array<double>"), "whitened")
    error = identity_error(scored, [k for k, varies in enumerate(whitening.varies().tolist()) if varies])
    share = [float(max(v, 0.0) / whitening.trace) if whitening.trace > 0 else 0.0 for v in whitening.variances]
    each = scored.select(F.col("vec_key").cast(kind).alias("vec_key"), "deviation", F.posexplode("whitened").alias("place", "whitened"))
    return each.select(
        "vec_key", (F.col("place") + 1).alias("component"), F.lit(whitening.n).cast("long").alias("n"), "deviation", "whitened",
        F.array(*(F.lit(x) for x in share))[F.col("place")].alias("explained"), F.lit(float(error)).alias("identity_error"),
    )
