"""Nearest neighbours by multi-index hashing: learned binary codes, their substrings indexed, every code in a radius reranked."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from millrace.llm.words import saved


@dataclass(frozen=True)
class Settings:
    """max_fitted bounds the vectors that the rotation and the radius are learned from, thinned by a hash of their id.

    The radius is the smallest at which codes of the sample hold `recall` of the sample's true neighbours; as neighbours in the
    whole table are nearer than those in a sample, it is a safe one.
    """

    neighbours: int = 10
    bits: int = 64
    substrings: int = 8
    recall: float = 0.97
    max_fitted: int = 10_000
    rows_in_block: int = 20_000
    queries_in_block: int = 4_000
    seed: int = 3


@dataclass
class Codes:
    """Principal directions, rotated so that the signs lose little (iterative quantisation)."""

    mean: np.ndarray
    turn: np.ndarray
    substrings: int
    radius: int = 0

    def of(self, vectors: np.ndarray) -> np.ndarray:
        """A row of bytes for each vector; byte s is substring s."""
        signs = ((vectors - self.mean) @ self.turn) > 0
        return np.packbits(signs, axis=1)

    @property
    def bits(self) -> int:
        return self.turn.shape[1]


#: Bits that are set in each byte.
WEIGHT = np.bitwise_count(np.arange(256, dtype=np.uint8)).astype(np.int64)


def fit(sample: np.ndarray, how: Settings) -> Codes:
    random = np.random.default_rng(how.seed)
    mean = sample.mean(axis=0)
    centred = sample - mean
    _, _, directions = np.linalg.svd(centred, full_matrices=True) if len(sample) < sample.shape[1] else np.linalg.svd(centred, full_matrices=False)
    bits = max(8, min(how.bits, sample.shape[1]) // 8 * 8)
    if len(directions) < bits:  # narrow vectors: more bits than directions, so further random ones
        directions = np.vstack([directions, random.normal(size=(bits - len(directions), sample.shape[1]))])
    plane = directions[:bits].T
    low = centred @ plane
    turn, _ = np.linalg.qr(random.normal(size=(bits, bits)))
    for _ in range(30):
        left, _, right = np.linalg.svd(np.where(low @ turn > 0, 1.0, -1.0).T @ low)
        turn = (left @ right).T
    codes = Codes(mean, plane @ turn, bits // 8)
    asked = random.choice(len(sample), size=min(len(sample), 200), replace=False)
    packed, distances = codes.of(sample), []
    for q in asked:
        apart = ((sample - sample[q]) ** 2).sum(axis=1)
        apart[q] = np.inf
        near = np.argsort(apart, kind="stable")[: min(how.neighbours, len(sample) - 1)]
        distances += WEIGHT[packed[near] ^ packed[q]].sum(axis=1).tolist()
    codes.radius = int(np.quantile(distances, how.recall, method="higher")) if distances else bits
    return codes


class Index:
    """Rows filed under the value of each substring of their code."""

    def __init__(self, packed: np.ndarray):
        self.packed = packed
        self.order = [np.argsort(column, kind="stable") for column in packed.T]
        self.begins = [np.searchsorted(column[order], np.arange(257)) for column, order in zip(packed.T, self.order)]

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """Every row whose code differs in at most `radius` bits.

        With m substrings one of them differs in at most radius // m bits; and of the first radius % m + 1 substrings one does, or
        one of the rest differs in fewer. So these buckets are probed, and what they hold is compared in full.
        """
        m = self.packed.shape[1]
        hit = np.zeros(len(self.packed), dtype=bool)
        for s in range(m):
            reach = radius // m if s <= radius % m else radius // m - 1
            if reach < 0:
                continue
            for value in np.flatnonzero(WEIGHT[np.arange(256, dtype=np.uint8) ^ code[s]] <= reach).tolist():
                hit[self.order[s][self.begins[s][value] : self.begins[s][value + 1]]] = True
        rows = np.flatnonzero(hit)
        return rows[WEIGHT[self.packed[rows] ^ code].sum(axis=1) <= radius]


def _usable(vector: Column) -> Column:
    return (
        (F.size(vector) > 0)
        & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists(vector, lambda x: x != 0)
    )


def _matrix(column: pd.Series) -> np.ndarray:
    return np.array(column.tolist(), dtype=np.float64)


def _searched(rows: DataFrame, queries: DataFrame, codes: Codes, radius: int, how: Settings, blocks: int, query_blocks: int) -> DataFrame:
    """The nearest of each block of rows for each query."""

    def search(_, own: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(own) and len(asked):
            vectors, names = _matrix(own["vector"]), own["id"].to_numpy()
            index = Index(codes.of(vectors))
            wanted = _matrix(asked["vector"])
            for query, code, vector in zip(asked["query_id"].tolist(), codes.of(wanted), wanted):
                near = index.within(code, radius)
                near = near[names[near] != query]
                apart = np.sqrt(((vectors[near] - vector) ** 2).sum(axis=1))
                best = np.lexsort((names[near], apart))[: how.neighbours]
                found += zip([query] * len(best), names[near][best].tolist(), apart[best].tolist())
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"]).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})

    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    own = rows.withColumn("block", F.pmod(F.xxhash64("id", F.lit(how.seed)), F.lit(blocks))).withColumn("asked", every(query_blocks))
    asked = queries.withColumn("asked", F.pmod(F.xxhash64("query_id", F.lit(how.seed)), F.lit(query_blocks))).withColumn("block", every(blocks))
    keys = [F.col("block").cast("long").alias("block"), F.col("asked").cast("long").alias("asked")]
    own = own.select("id", "vector", *keys).groupBy("block", "asked")
    asked = asked.select("query_id", "vector", *keys).groupBy("block", "asked")
    found = own.cogroup(asked).applyInPandas(search, "query_id long, vec_id long, score double")
    place = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return found.withColumn("rank", place).where(F.col("rank") <= how.neighbours)


def nearest(vectors: DataFrame, is_query: Column, how: Settings = Settings(), id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the nearest rows of each query by Euclidean distance in double precision, equals by smaller id.

    Rows and queries meet in blocks: each pair of a block of rows and one of queries is a task, which indexes its rows by the
    substrings of their codes and retrieves every code within the radius by the pigeonhole principle. The floats of those are
    compared, and the nearest of each block are merged. A query that finds fewer than it asks for is asked again with the full
    radius, so a far-off one gets its neighbours too.

    Vectors that are null, empty, zero, of another length than most, or hold null or non-finite values take no part, nor do rows
    with a null id. Of rows that repeat an id all are candidates, one of them the query; a query is no candidate of its own id.
    """
    plain = vectors.select(F.col(id_column).cast("long").alias("id"), F.col(vector_column).alias("vector"), is_query.alias("asks"))
    plain = saved(plain.where(F.col("id").isNotNull() & _usable(F.col("vector"))).withColumn("size", F.size("vector")), "vectors")
    sizes = plain.groupBy("size").count().orderBy(F.desc("count"), "size").first()
    empty = "query_id long, rank int, vec_id long, score double"
    if sizes is None:
        return vectors.sparkSession.createDataFrame([], empty)
    rows, count = plain.where(F.col("size") == sizes["size"]), sizes["count"]
    share = min(1 << 20, int((1 << 20) * how.max_fitted / count) + 1)
    sample = rows.where(F.pmod(F.xxhash64("id", F.lit(how.seed + 1)), F.lit(1 << 20)) < share).select("vector").limit(2 * how.max_fitted)
    fitted = sample.toPandas()["vector"]
    codes = fit(_matrix(fitted) if len(fitted) else np.zeros((1, sizes["size"])), how)

    queries = rows.where("asks").groupBy("id").agg(F.min("vector").alias("vector")).withColumnRenamed("id", "query_id")
    asked = queries.count()
    blocks, query_blocks = -(-count // how.rows_in_block), max(1, -(-asked // how.queries_in_block))
    rows = rows.select("id", "vector")
    first = saved(_searched(rows, queries, codes, codes.radius, how, blocks, query_blocks), "neighbours")
    done = first.groupBy("query_id").count().where(F.col("count") >= how.neighbours).select("query_id")
    again = saved(queries.join(done, "query_id", "left_anti"), "asked-again")
    rest = again.count()
    if rest:
        more = _searched(rows, again, codes, codes.bits, how, blocks, max(1, -(-rest // how.queries_in_block)))
        first = first.join(done, "query_id", "left_semi").unionByName(more)
    return first.select("query_id", "rank", "vec_id", "score")
