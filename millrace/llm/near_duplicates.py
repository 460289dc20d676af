"""Near-duplicate documents: MinHash bands propose, odd sketches compare, full shingle sets decide."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from millrace.llm.components import connected_components
from millrace.llm.words import mixed, saved, whole_groups, word_hashes

#: Members of a bucket or cluster that one task compares; larger ones are dealt out as pairs of blocks.
BLOCK = 2048
#: Bytes of full sets in a block, and shingles that a task keeps as Python sets at a time.
BLOCK_BYTES, REMEMBERED = 64 << 20, 1 << 20
#: Standard errors of the similarity estimate below the threshold at which a pair still goes to the exact check.
MARGIN = 4.5


@dataclass(frozen=True)
class Sketching:
    """bands * rows MinHash samples; the samples fold into `bits` parity bits."""

    width: int = 5
    percent: int = 80
    bands: int = 32
    rows: int = 5
    bits: int = 512

    @property
    def samples(self) -> int:
        return self.bands * self.rows

    @property
    def furthest(self) -> int:
        """Most differing parity bits of a pair that may reach the threshold."""
        goal = self.percent / 100
        least = goal - MARGIN * math.sqrt(goal * (1 - goal) / self.samples)
        differing = 2 * self.samples * (1 - least)
        return math.ceil(self.bits / 2 * (1 - math.exp(-2 * differing / self.bits)) + 3)


def shingles(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct hashes of the runs of `width` words; a shorter text is one run, one without words none."""
    found = word_hashes(text)
    if not len(found):
        return found
    size = min(width, len(found))
    with np.errstate(over="ignore"):
        total = np.full(len(found) - size + 1, size, dtype=np.uint64)
        for k in range(size):
            total = mixed(total * np.uint64(0x9E3779B97F4A7C15) + found[k : len(found) - size + 1 + k])
    return np.unique(total)


def _permutations(count: int) -> tuple[np.ndarray, np.ndarray]:
    seeds = mixed(np.arange(1, 2 * count + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return (seeds[:count] >> np.uint64(32)).astype(np.uint32) | np.uint32(1), (seeds[count:] >> np.uint64(32)).astype(np.uint32)


def _samples(found: np.ndarray, factors: np.ndarray, masks: np.ndarray) -> np.ndarray:
    """The smallest value of the set under each permutation of 32-bit values."""
    short = (found >> np.uint64(32)).astype(np.uint32)
    least = np.full(len(factors), 0xFFFFFFFF, dtype=np.uint32)
    with np.errstate(over="ignore"):
        for start in range(0, len(short), 2048):
            least = np.minimum(least, ((short[start : start + 2048, None] ^ masks) * factors).min(axis=0))
    return least


def _identity(found: np.ndarray) -> tuple[int, int]:
    """128 bits of a set, whatever the order; the first half names its class in the graph."""
    with np.errstate(over="ignore"):
        sums = np.array([mixed(found).sum(), mixed(found + np.uint64(0x5851F42D4C957F2D)).sum()], dtype=np.uint64)
    return tuple(mixed(sums).view(np.int64).tolist())


def _signer(how: Sketching):
    def sign(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        factors, masks = _permutations(how.samples)
        places = np.arange(how.samples, dtype=np.uint64) << np.uint64(32)
        for frame in frames:
            rows = []
            for key, text in zip(frame["id"].tolist(), frame["text"].tolist()):
                found = shingles(text, how.width)
                if not len(found):
                    rows.append((key, 0, None, None, None, None))
                    continue
                least = _samples(found, factors, masks)
                odd = mixed(places | least.astype(np.uint64)) % np.uint64(how.bits)
                parity = np.bincount(odd.astype(np.int64), minlength=how.bits) & 1
                banded = least.reshape(how.bands, how.rows).astype(np.uint64)
                value = np.arange(how.bands, dtype=np.uint64)
                for column in range(how.rows):
                    with np.errstate(over="ignore"):
                        value = mixed(value * np.uint64(0x9E3779B97F4A7C15) + banded[:, column])
                with np.errstate(over="ignore"):
                    node, check = _identity(found)
                rows.append((key, len(found), node, check, np.packbits(parity.astype(np.uint8)).tobytes(), value.view(np.int64)))
            # As objects: a column of floats, which pandas makes of whole numbers with nulls, would round them.
            signed = pd.DataFrame(rows, columns=["id", "n_shingles", "node", "check", "sketch", "bands"], dtype=object)
            signed["id"] = frame["id"].astype("Int64").to_numpy(dtype=object, na_value=None)
            yield signed

    return sign


class Forest:
    """Union-find over the positions of one group."""

    def __init__(self, size: int):
        self.parent = list(range(size))

    def root(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = x = self.parent[self.parent[x]]
        return x

    def join(self, x: int, y: int) -> None:
        x, y = self.root(x), self.root(y)
        self.parent[max(x, y)] = min(x, y)

    def roots(self) -> np.ndarray:
        return np.array([self.root(x) for x in range(len(self.parent))])

    def edges(self, names: np.ndarray) -> list[tuple[int, int]]:
        return [(names[r], names[x]) for x in range(len(self.parent)) if (r := self.root(x)) != x]


def _similar(sketches: list[bytes], sides: np.ndarray | None, furthest: int) -> Iterator[tuple[int, np.ndarray]]:
    """For each position, the later positions whose sketches differ in few bits; between the two sides only, if there are two."""
    words = np.frombuffer(b"".join(sketches), dtype=np.uint64).reshape(len(sketches), -1)
    for x in range(len(sketches) - 1):
        near = np.bitwise_count(words[x + 1 :] ^ words[x]).sum(axis=1) <= furthest
        if sides is not None:
            near &= sides[x + 1 :] != sides[x]
        yield x, np.flatnonzero(near) + x + 1


def _sides(frame: pd.DataFrame, key: tuple) -> np.ndarray | None:
    """Which of two different blocks a row is of; rows of one block are compared among themselves."""
    return None if key[-1] == key[-2] else (frame["block"].to_numpy() == key[-2])


def _proposer(how: Sketching):
    def propose(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for key, frame in whole_groups(frames, ["bucket", "low", "high"]):
            names, forest = frame["node"].to_numpy(), Forest(len(frame))
            if len(names) == 2 and key[1] == key[2]:
                first, second = (int.from_bytes(s, "little") for s in frame["sketch"])
                if (first ^ second).bit_count() <= how.furthest:
                    forest.join(0, 1)
            else:
                for x, near in _similar(frame["sketch"].tolist(), _sides(frame, key), how.furthest):
                    for y in near.tolist():
                        forest.join(x, y)
            if edges := forest.edges(names):
                yield pd.DataFrame(edges, columns=["a", "b"])

    return propose


def _verifier(how: Sketching):
    def verify(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for key, frame in whole_groups(frames, ["cluster", "low", "high"]):
            names, sizes, forest = frame["node"].to_numpy(), frame["n_shingles"].to_numpy(), Forest(len(frame))
            packed, sets = frame["members"].tolist(), {}
            kept = 0

            def of(x: int) -> frozenset:
                nonlocal kept
                if x not in sets:
                    if kept + int(sizes[x]) > REMEMBERED:
                        sets.clear()
                        kept = 0
                    sets[x] = frozenset(np.frombuffer(packed[x], dtype=np.uint64).tolist())
                    kept += int(sizes[x])
                return sets[x]

            for x, near in _similar(frame["sketch"].tolist(), _sides(frame, key), how.furthest):
                for y in near.tolist():
                    small, large = sorted((int(sizes[x]), int(sizes[y])))
                    if 100 * small < how.percent * large or forest.root(x) == forest.root(y):
                        continue
                    shared = len(of(x) & of(y))
                    if 100 * shared >= how.percent * (small + large - shared):
                        forest.join(x, y)
            if edges := forest.edges(names):
                yield pd.DataFrame(edges, columns=["a", "b"])

    return verify


def _packer(how: Sketching):
    def pack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            sets = [shingles(text, how.width) for text in frame["text"]]
            sets = [found for found in sets if len(found)]
            yield pd.DataFrame({"node": [_identity(x)[0] for x in sets], "members": [x.tobytes() for x in sets]})

    return pack


def _dealt(rows: DataFrame, group: str) -> DataFrame:
    """Rows of a group with up to BLOCK members, of BLOCK_BYTES, go to one task; of a larger one, each pair of its blocks is a group of its own."""
    heavy = F.col("bytes_of_group") / BLOCK_BYTES if "bytes_of_group" in rows.columns else F.lit(0.0)
    blocks = F.ceil(F.greatest(F.col("members_of_group") / BLOCK, heavy)).cast("int")
    spread = rows.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("node", F.lit(7)), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    return (
        spread.withColumn("other", other)
        .withColumn("low", F.least("block", "other"))
        .withColumn("high", F.greatest("block", "other"))
        .drop("other", "blocks", "members_of_group", "bytes_of_group")
        .repartition(F.col(group), F.col("low"), F.col("high"))
        .sortWithinPartitions(group, "low", "high", "node")
    )


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", how: Sketching = Sketching()) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row: the component of documents linked by near-equal shingle sets.

    Two sets are linked when 100 * intersection >= percent * union. Equal sets are one class, told apart by 128 bits and compared
    once. Bands of MinHash samples put classes into buckets; inside a bucket the XOR of two odd sketches counts the samples that
    differ, and pairs that may reach the threshold join a cluster. Each class then sends its full set to its cluster once, where
    the pairs are checked exactly, unless they are connected already. Buckets and clusters beyond BLOCK
    members or BLOCK_BYTES of sets are compared block by block in many tasks, so nothing is left out and no group has to fit a task.

    Null and empty texts and texts without words have no shingles, and form a component each. Repeated rows get the same answer;
    rows of one id with different texts are judged by their texts. A row with a null id is linked with nothing: its component is
    null, and it is kept. Other columns of `docs` are not looked at; an empty table gives an empty result.
    """
    plain = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"))
    schema = "id long, n_shingles long, node long, check long, sketch binary, bands array<long>"
    signed = saved(plain.mapInPandas(_signer(how), schema), "signatures")
    classes = saved(
        signed.where("n_shingles > 0 and id is not null")
        .groupBy("node", "check")
        .agg(F.min("id").alias("first_id"), *(F.first(c).alias(c) for c in ("n_shingles", "sketch", "bands"))),
        "classes",
    )

    buckets = classes.select("node", F.explode("bands").alias("bucket"))
    # Counted on the map side; a window would bring a whole bucket into one task.
    crowds = buckets.groupBy("bucket").agg(F.count("*").alias("members_of_group")).where("members_of_group > 1")
    met = buckets.join(crowds, "bucket").select("node", "bucket", "members_of_group")
    met = met.join(classes.select("node", "sketch"), "node")
    proposed = _dealt(met, "bucket").mapInPandas(_proposer(how), "a long, b long")
    clusters = connected_components(proposed).withColumnRenamed("component", "cluster")

    weighed = clusters.join(classes.select("node", "n_shingles"), "node")
    sizes = weighed.groupBy("cluster").agg(F.count("*").alias("members_of_group"), (F.sum("n_shingles") * 8).alias("bytes_of_group"))
    wanted = saved(
        clusters.join(sizes, "cluster").join(classes.select("node", "first_id", "n_shingles", "sketch"), "node"), "clusters"
    )
    texts = plain.join(wanted.select(F.col("first_id").alias("id")), "id", "left_semi")
    sets = texts.mapInPandas(_packer(how), "node long, members binary").dropDuplicates(["node"])
    verified = _dealt(wanted.drop("first_id").join(sets, "node"), "cluster").mapInPandas(_verifier(how), "a long, b long")
    found = connected_components(verified)
    named = found.join(classes.select("node", "first_id"), "node")
    named = named.join(named.groupBy("component").agg(F.min("first_id").alias("least_id")), "component").select("node", "least_id")

    answers = (
        classes.select("node", "check", "first_id")
        .join(named, "node", "left")
        .select("node", "check", F.coalesce("least_id", "first_id").alias("of_class"))
    )
    component = F.when(F.col("id").isNotNull(), F.coalesce("of_class", "id"))
    return (
        signed.select("id", "n_shingles", "node", "check")
        .join(answers, ["node", "check"], "left")
        .select(F.col("id").alias("doc_id"), "n_shingles", component.alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )
