"""A hierarchical Pitman-Yor language model: a restaurant for every previous word, all with the restaurant of all words as their parent."""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from millrace.llm.words import saved, whole_groups, word_hashes

#: The token after the last word, and what stands before the first; no word holds white space.
END, START = xxhash.xxh64_intdigest(b"\n"), xxhash.xxh64_intdigest(b" ")
#: Tokens that are sorted together before they are sent.
PIECE = 1_200_000
#: Tokens for which one block is planned.
BLOCK = 4_000_000
#: Pairs that a task adds to those of a block before it merges them.
LOOSE = 1_000_000
#: Customers of one dish up to which the tables are drawn from exact probabilities.
EXACT = 64
#: Where messages are about words, about contexts, or are a block's own tables.
WORDS, CONTEXTS, OWN = 0, 1, 2
ROWS = "bucket int, kind int, side int, part int, blobs array<binary>"
#: Numbers of a message for the driver.
TOTALS = 8


@dataclass(frozen=True)
class Settings:
    """`burn_in` sweeps are thrown away, `samples` are averaged. strengths: of the root and of the contexts. Discounts come from the counts."""

    burn_in: int = 1
    samples: int = 2
    strengths: tuple[float, float] = (1.0, 1.0)
    seed: int = 23


def _planes(values: np.ndarray) -> bytes:
    """The lowest bytes of all values, then the next ones, compressed: what sorted or small numbers have in common lies side by side."""
    return zlib.compress(values.view(np.uint8).reshape(-1, values.itemsize).T.tobytes(), 1)


def _joined(blob: bytes, kind: np.dtype, offset: int = 0) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(zlib.decompress(memoryview(blob)[offset:]), dtype=np.uint8).reshape(kind.itemsize, -1).T).view(kind).ravel()


def _packed(values: np.ndarray) -> bytes:
    """Whole numbers in the narrowest unsigned type that holds them, after a byte that names the type."""
    kind = np.min_scalar_type(int(values.max()) if len(values) else 0)
    return kind.char.encode() + _planes(values.astype(kind))


def _unpacked(blob: bytes) -> np.ndarray:
    return _joined(blob, np.dtype(chr(blob[0])), 1).astype(np.int64)


def _hashes(blob: bytes) -> np.ndarray:
    return _joined(blob, np.dtype(np.uint64))


def _firsts(values: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin."""
    return np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])) if len(values) else np.zeros(0, dtype=np.int64)


def _part(hashes: np.ndarray, parts: int) -> np.ndarray:
    """Which of equal ranges of hashes each one lies in."""
    return (((hashes >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)).astype(np.int64)


@dataclass
class Piece:
    """Counts of (word, context, document) in a block: distinct words, pairs of each, distinct contexts, that of each pair, entries of each pair."""

    words: np.ndarray
    pairs: np.ndarray
    names: np.ndarray
    contexts: np.ndarray
    entries: np.ndarray
    docs: np.ndarray
    counts: np.ndarray


def _cut(texts: list, grid: int) -> Iterator[tuple[int, Piece]]:
    """The counts of the texts, block by block. A block is a range of word hashes and one of context hashes."""
    each = [np.append(word_hashes(text), np.uint64(END)) for text in texts]
    sizes = np.array([len(x) for x in each])
    tokens = np.concatenate([*each, np.array([START], dtype=np.uint64)])
    del each
    distinct, place = np.unique(tokens, return_inverse=True)
    place = place.astype(np.uint32)
    before = np.concatenate([place[-1:], place[:-2]])
    before[np.cumsum(sizes)[:-1]] = place[-1]
    wide, deep = np.uint64(len(distinct).bit_length()), np.uint64(len(texts).bit_length())
    key = place[:-1].astype(np.uint64)
    del tokens, place
    key <<= wide
    key |= before
    key <<= deep
    key |= np.repeat(np.arange(len(texts), dtype=np.uint64), sizes)
    del before
    key.sort()
    first = _firsts(key)
    counts, key = np.diff(np.append(first, len(key))).astype(np.uint32), key[first]
    docs, pair = (key & ((np.uint64(1) << deep) - np.uint64(1))).astype(np.uint32), key >> deep
    del key, first
    begins = _firsts(pair)
    entries, pair = np.diff(np.append(begins, len(pair))), pair[begins]
    words, contexts = (pair >> wide).astype(np.uint32), (pair & ((np.uint64(1) << wide) - np.uint64(1))).astype(np.uint32)
    del pair
    strip = _part(distinct, grid * grid) // grid
    block = strip[words] * grid + strip[contexts]
    block = block.astype(np.min_scalar_type(grid * grid))
    order = np.argsort(block, kind="stable")
    edges = np.append(_firsts(block[order]), len(order))
    for a, z in zip(edges, edges[1:]):
        own = order[a:z]
        names, context = np.unique(contexts[own], return_inverse=True)
        some = entries[own]
        at = np.arange(some.sum()) + np.repeat(begins[own] - np.cumsum(some) + some, some)
        start = _firsts(words[own])
        yield int(block[own[0]]), Piece(
            distinct[words[own][start]], np.diff(np.append(start, len(own))), distinct[names], context, some, docs[at], counts[at]
        )


def _runs(texts: list) -> Iterator[tuple[int, int]]:
    """Runs of texts of about PIECE tokens; a longer text is a run of its own."""
    begin, size = 0, 0
    for i, text in enumerate(texts):
        more = len(text or "") // 6 + 1
        if begin < i and (size + more > PIECE or i - begin == 1 << 16):
            yield begin, i
            begin, size = i, 0
        size += more
    if begin < len(texts):
        yield begin, len(texts)


def _counted(grid: int):
    """Every pair of a word and the one before it in any text, with its count in the texts to learn from, none included."""

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            texts, learn = frame["text"].tolist(), frame["learn"].to_numpy(dtype=bool)
            for begin, end in _runs(texts):
                rows = []
                for b, p in _cut(texts[begin:end], grid):
                    totals = np.add.reduceat(p.counts * learn[begin:end][p.docs], np.cumsum(p.entries) - p.entries)
                    rows.append((b, [_planes(p.words), _packed(p.pairs), _planes(p.names), _packed(p.contexts), _packed(totals)]))
                yield pd.DataFrame(rows, columns=["bucket", "blobs"])

    return count


Counts = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def _merged(parts: list[Counts]) -> Counts:
    if len(parts) == 1:
        return parts[0]
    words, names = (np.unique(np.concatenate([p[i] for p in parts])) for i in (0, 2))
    key = np.concatenate([np.repeat(np.searchsorted(words, p[0]), p[1]) * len(names) + np.searchsorted(names, p[2])[p[3]] for p in parts])
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = _firsts(key)
    counts, key = np.add.reduceat(np.concatenate([p[4] for p in parts])[order], first), key[first]
    return words, np.bincount(key // len(names), minlength=len(words)), names, key % len(names), counts


def _opened(blobs: list[bytes]) -> Counts:
    words, pairs, names, contexts, counts = blobs
    return _hashes(words), _unpacked(pairs), _hashes(names), _unpacked(contexts), _unpacked(counts)


def _summed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """All counts of each block; parts are merged as they come, so that only distinct pairs are held."""
    held: dict[int, list[Counts]] = {}
    loose: dict[int, int] = {}
    for frame in frames:
        for b, blobs in zip(frame["bucket"], frame["blobs"]):
            part = _opened(blobs)
            held.setdefault(b, []).append(part)
            loose[b] = loose.get(b, 0) + len(part[3])
            if len(held[b]) > 1 and loose[b] > max(LOOSE, 2 * len(held[b][0][3])):
                held[b] = [_merged(held[b])]
                loose[b] = len(held[b][0][3])
    for b in list(held):
        words, pairs, names, contexts, counts = _merged(held.pop(b))
        yield pd.DataFrame([(b, [_planes(words), _packed(pairs), _planes(names), _packed(contexts), _packed(counts)])], columns=["bucket", "blobs"])


@dataclass
class Model:
    """What all blocks know: numbers, none of which grows with the input. roots: customers and tables of the root after each sweep."""

    how: Settings
    grid: int
    vocabulary: int = 0
    train_tokens: int = 0
    discounts: tuple[float, float] = (0.5, 0.5)
    roots: list[tuple[float, float]] = field(default_factory=list)

    @property
    def base(self) -> float:
        """The chance of each word under the restaurant that all others rest on; one word stands for all unseen."""
        return 1 / (self.vocabulary + 1)

    def new(self, sweep: int) -> float:
        """The weight of a new table for one word in the root."""
        return (self.how.strengths[0] + self.discounts[0] * self.roots[sweep][1]) * self.base

    def root(self, customers: np.ndarray, tables: np.ndarray, sweep: int) -> np.ndarray:
        return (np.maximum(customers - self.discounts[0] * tables, 0) + self.new(sweep)) / (self.how.strengths[0] + self.roots[sweep][0])


@lru_cache(maxsize=8)
def stirling(discount: float, size: int = EXACT) -> np.ndarray:
    """log of the ways, weighed by the discount, to seat c customers at t tables: row c, column t."""
    ways = np.full((size + 1, size + 1), -np.inf)
    ways[0, 0] = 0.0
    for c in range(size):
        for t in range(1, c + 2):
            stay = ways[c, t] + math.log(c - discount * t) if c > discount * t and ways[c, t] > -np.inf else -np.inf
            ways[c + 1, t] = np.logaddexp(ways[c, t - 1], stay)
    return ways


def seated(customers: np.ndarray, chance: np.ndarray, discount: float, ways: np.ndarray, random: np.random.Generator) -> np.ndarray:
    """Tables of each dish, drawn given its customers and the weight of a new table, strength and tables times the parent's chance.

    Up to EXACT customers this is a draw from the collapsed conditional, ways(c, t) * chance ** t. Beyond, the rest of the customers
    come in groups of a sixteenth of those that sit already, with the chance of a new table as at the group's beginning.
    """
    tables = np.minimum(customers, 1).astype(np.int64)
    few = np.minimum(customers, EXACT)
    log_chance = np.log(chance)
    order = np.argsort(few, kind="stable")
    bounds = np.searchsorted(few[order], np.arange(2, EXACT + 2))
    for c, begin, end in zip(range(2, EXACT + 1), bounds, bounds[1:]):
        for start in range(begin, end, (1 << 20) // c):
            some = order[start : min(end, start + (1 << 20) // c)]
            weights = ways[c, 1 : c + 1] + log_chance[some, None] * np.arange(1, c + 1)
            weights = np.cumsum(np.exp(weights - weights.max(axis=1, keepdims=True)), axis=1)
            tables[some] = 1 + (weights < random.random(len(some))[:, None] * weights[:, -1:]).sum(axis=1)
    rest = np.flatnonzero(customers > EXACT)
    sitting = np.full(len(rest), EXACT, dtype=np.int64)
    while len(rest):
        group = np.minimum(customers[rest] - sitting, np.maximum(sitting // 16, 1))
        new = chance[rest] / (chance[rest] + sitting - discount * tables[rest])
        tables[rest] += random.binomial(group, new)
        sitting += group
        more = sitting < customers[rest]
        rest, sitting = rest[more], sitting[more]
    return tables


class Block:
    """The dishes of a range of words in the restaurants of a range of contexts, with what other blocks answer about both."""

    def __init__(self, blobs: list[bytes]):
        self.words, self.pairs, self.names, self.contexts, self.counts = _opened(blobs)
        self.begins = np.cumsum(self.pairs) - self.pairs
        self.of_word = np.repeat(np.arange(len(self.pairs)), self.pairs)

    def sums(self, tables: np.ndarray) -> list[np.ndarray]:
        """Of a value of each pair: the sum of each word, and of each context."""
        return [np.add.reduceat(tables, self.begins), np.bincount(self.contexts, weights=tables).astype(np.int64)]

    def seat(self, model: Model, bucket: int, sweep: int, words: tuple[np.ndarray, np.ndarray], tables: np.ndarray) -> np.ndarray:
        """Tables of each pair, drawn from the root's customers and tables of each word and the tables of each context after the sweep before."""
        parent = model.root(*words, sweep - 1)
        weight = (model.how.strengths[1] + model.discounts[1] * tables[self.contexts]) * parent[self.of_word]
        return seated(self.counts, weight, model.discounts[1], stirling(model.discounts[1]), np.random.default_rng((model.how.seed, bucket, sweep)))

    def chances(self, model: Model, sweep: int, own: np.ndarray, words: tuple[np.ndarray, np.ndarray], tables: np.ndarray, customers: np.ndarray) -> np.ndarray:
        """The chance of each pair's word after its context, under the seating of a sweep."""
        d, s = model.discounts[1], model.how.strengths[1]
        parent = model.root(*words, sweep)[self.of_word]
        return (self.counts - d * own + (s + d * tables[self.contexts]) * parent) / (s + customers[self.contexts])


def _heard(answers: list[tuple[int, list[bytes]]]) -> list[list[np.ndarray]]:
    """The answers about words and about contexts, in the order of their hashes: each blob joined over the ranges."""
    return [[np.concatenate([_unpacked(b) for b in blobs]) for blobs in zip(*(blobs for s, blobs in answers if s == side))] for side in (WORDS, CONTEXTS)]


def _asked(bucket: int, sides: list[tuple[np.ndarray, list[Callable[[slice], bytes]]]]) -> list[tuple]:
    """Messages of a block: for each side the range of each item, and what packs a run of items. One for each range that has items."""
    rows = []
    for side, (ranges, packers) in enumerate(sides):
        edges = np.append(_firsts(ranges), len(ranges))
        rows += [(bucket, side, int(ranges[a]), [pack(slice(a, z)) for pack in packers]) for a, z in zip(edges, edges[1:])]
    return rows


MESSAGES = "bucket int, side int, part int, blobs array<binary>, totals array<double>"


def _messages(rows: list[tuple], totals: list[float]) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=["bucket", "side", "part", "blobs"])
    frame["totals"] = [totals if i == 0 else [0.0] * TOTALS for i in range(len(rows))]
    return frame


def _introduced(model: Model):
    """First messages: hashes, customers, and one table for each pair that has customers. Totals: pairs of one and of two customers."""

    def introduce(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for b, blobs in zip(frame["bucket"], frame["blobs"]):
                block, sides = Block(blobs), []
                ones, customers = block.sums((block.counts > 0).astype(np.int64)), block.sums(block.counts)
                for hashes, tables, each in zip((block.words, block.names), ones, customers):
                    packers = [lambda a, h=hashes: _planes(h[a]), lambda a, t=tables: _packed(t[a]), lambda a, c=each: _packed(c[a])]
                    sides.append((_part(hashes, model.grid**2), packers))
                once, twice = float((block.counts == 1).sum()), float((block.counts == 2).sum())
                yield _messages([(int(b), OWN, int(b), []), *_asked(int(b), sides)], [once, twice, *[0.0] * 6])

    return introduce


def _gaps(places: np.ndarray) -> np.ndarray:
    return np.diff(places, prepend=0)


def _first_answers(group: pd.DataFrame) -> pd.DataFrame:
    """To each block of a range: the place of its items among all, their customers, tables of all contexts, and in the root one table.

    Totals: pairs of one and of two customers, customers and tables of the root, words, tokens, words of one and of two customers in the root.
    """
    side = int(group["side"].iloc[0])
    if side == OWN:
        return group
    asked = [_hashes(blobs[0]) for blobs in group["blobs"]]
    every = np.unique(np.concatenate(asked))
    places = [np.searchsorted(every, hashes) for hashes in asked]
    tables, customers = np.zeros(len(every), dtype=np.int64), np.zeros(len(every), dtype=np.int64)
    for at, blobs in zip(places, group["blobs"]):
        tables[at] += _unpacked(blobs[1])
        customers[at] += _unpacked(blobs[2])
    root = np.minimum(tables, 1)
    rows = [(b, side, p, [_packed(x) for x in (_gaps(at), customers[at], tables[at], root[at])]) for b, p, at in zip(group["bucket"], group["part"], places)]
    totals = [tables.sum(), root.sum(), (customers > 0).sum(), customers.sum(), (tables == 1).sum(), (tables == 2).sum()]
    return _messages(rows, [0.0, 0.0, *map(float, totals)] if side == WORDS else [0.0] * TOTALS)


def _answers(model: Model, sweep: int):
    def answer(group: pd.DataFrame) -> pd.DataFrame:
        """To each block of a range: tables of all contexts, and those of the root, which are drawn here."""
        side, part = int(group["side"].iloc[0]), int(group["part"].iloc[0])
        places = [np.cumsum(_unpacked(blobs[0])) for blobs in group["blobs"]]
        tables = np.zeros(max(int(at[-1]) for at in places) + 1, dtype=np.int64)
        for at, blobs in zip(places, group["blobs"]):
            tables[at] += _unpacked(blobs[1])
        if side == WORDS:
            random = np.random.default_rng((model.how.seed, 1 << 40, part, sweep))
            root = seated(tables, np.full(len(tables), model.new(sweep - 1)), model.discounts[0], stirling(model.discounts[0]), random)
        else:
            root = np.zeros_like(tables)
        rows = [(b, side, part, [_packed(tables[at]), _packed(root[at])]) for b, at in zip(group["bucket"], places)]
        return _messages(rows, [float(tables.sum()), float(root.sum()), *[0.0] * 6] if side == WORDS else [0.0] * TOTALS)

    return answer


def _swept(model: Model, sweep: int):
    """Every dish of a block is seated anew; the sums of its words and contexts are sent, its own tables are kept beside them."""

    def sweep_block(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for (b,), group in whole_groups(frames, ["bucket"]):
            heard = lambda kind: _heard([(s, x) for k, s, x in zip(group["kind"], group["side"], group["blobs"]) if k == kind])  # noqa: E731, B023
            block = Block(group["blobs"].iloc[0])
            (words, roots), (tables, _) = heard(2)
            own = block.seat(model, int(b), sweep, (words, roots), tables)
            sides = []
            for side, (gaps,), sums in zip((WORDS, CONTEXTS), heard(1), block.sums(own)):
                places = group[(group["kind"] == 1) & (group["side"] == side)]
                ranges = np.repeat(places["part"].to_numpy(), [len(_unpacked(x[0])) for x in places["blobs"]])
                sides.append((ranges, [lambda a, g=gaps: _packed(g[a]), lambda a, t=sums: _packed(t[a])]))
            yield _messages([*_asked(int(b), sides), (int(b), OWN, 0, [_packed(own)])], [0.0] * TOTALS)

    return sweep_block


def _totals(rows: DataFrame) -> list[float]:
    return [x or 0.0 for x in rows.agg(*[F.sum(F.col("totals")[i]) for i in range(TOTALS)]).first()]


def _rows(rows: DataFrame, kind: int, *blobs: int | None) -> DataFrame:
    """Rows of one kind as blocks get them, with those of their blobs that are named; None stands for an empty one."""
    place = [F.col(c) if c in rows.columns else F.lit(0).alias(c) for c in ("side", "part")]
    some = F.array(*(F.lit(_planes(np.zeros(0, dtype=np.uint64))) if i is None else F.col("blobs")[i] for i in blobs)) if blobs else F.col("blobs")
    return rows.select("bucket", F.lit(kind).alias("kind"), *place, some.alias("blobs"))


def _meeting(tables: list[DataFrame], buckets: int) -> DataFrame:
    met = tables[0]
    for more in tables[1:]:
        met = met.unionByName(more)
    return met.repartition(buckets, "bucket").sortWithinPartitions("bucket", "kind", "side", "part")


def train(blocks: DataFrame, how: Settings, grid: int) -> tuple[Model, list[DataFrame]]:
    """The model's numbers, and all that a block needs for the chances of its pairs, as rows in the order of their kinds.

    A sweep seats all blocks at once with the answers of the sweep before. Each block then sends the tables of its words and its
    contexts to the range of hashes where these are summed, and gets the sums over all blocks back.
    """
    model, buckets = Model(how, grid), grid * grid
    first = saved(blocks.mapInPandas(_introduced(model), MESSAGES).groupBy("side", "part").applyInPandas(_first_answers, MESSAGES), "first-answers")
    n1, n2, customers, tables, words, tokens, m1, m2 = _totals(first)
    first = first.where(F.col("side") != OWN)
    # The share of dishes seen once, against those seen twice, gives the discount; kept off the ends.
    discount = lambda once, twice: float(min(max(once / max(once + 2 * twice, 1), 0.05), 0.95))
    model = Model(how, grid, int(words), int(tokens), (discount(m1, m2), discount(n1, n2)), [(customers, tables)])
    kept, last = [_rows(blocks, 0), _rows(first, 1, 1)], _rows(first, 2, 2, 3)
    for k in range(1, how.burn_in + how.samples + 1):
        met = [_rows(blocks, 0, None, 1, None, 3, 4), _rows(first, 1, 0), last]
        sent = saved(_meeting(met, buckets).mapInPandas(_swept(model, k), MESSAGES), "swept")
        answers = saved(sent.where(F.col("side") != OWN).groupBy("side", "part").applyInPandas(_answers(model, k), MESSAGES), "answers")
        model.roots.append(tuple(_totals(answers)[:2]))
        last = _rows(answers, 2)
        if k > how.burn_in:
            kept += [_rows(answers, 2 * k), _rows(sent.where(F.col("side") == OWN), 2 * k + 1)]
    return model, kept


class Scorer:
    """log10 chances of the pairs of one block, averaged over the kept seatings, and the count of each word."""

    def __init__(self, model: Model, rows: dict[int, list[tuple[int, list[bytes]]]]):
        self.block = block = Block(rows[0][0][1])
        (self.seen,), (customers,) = _heard(rows[1])
        total, kept = np.zeros(len(block.counts)), range(model.how.burn_in + 1, model.how.burn_in + model.how.samples + 1)
        for k in kept:
            (words, roots), (tables, _) = _heard(rows[2 * k])
            total += block.chances(model, k, _unpacked(rows[2 * k + 1][0][1][0]), (words, roots), tables, customers)
        self.chance = np.log10(total / len(kept))
        self.keys = block.of_word * len(block.names) + block.contexts

    def pairs(self, words: np.ndarray, pairs: np.ndarray, names: np.ndarray, contexts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each pair of a piece: its log chance, and the word's count in training. A block has every pair of every text."""
        place = np.repeat(np.searchsorted(self.block.words, words), pairs)
        at = np.searchsorted(self.keys, place * len(self.block.names) + np.searchsorted(self.block.names, names)[contexts])
        return self.chance[at], self.seen[place]


#: Comes after all rows of a block.
TEXTS = 1 << 20


def _sent(grid: int):
    """Pieces by block. The first row of a piece carries the ids of its documents."""

    def send(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, row = TaskContext.get().partitionId(), 0
        for frame in frames:
            ids, texts = frame["doc_id"], frame["text"].tolist()
            for begin, end in _runs(texts):
                rows = []
                for b, p in _cut(texts[begin:end], grid):
                    named, docs = np.unique(p.docs, return_inverse=True)
                    numbers = [_packed(x) for x in (p.contexts, p.counts, p.entries, docs, named)]
                    blobs = [_planes(p.words), _packed(p.pairs), _planes(p.names), *numbers]
                    rows.append((b, TEXTS, 0, 0, blobs, (part << 32) + row, None if rows else ids.iloc[begin:end].tolist()))
                row += end - begin
                yield pd.DataFrame(rows, columns=["bucket", "kind", "side", "part", "blobs", "piece", "ids"])

    return send


def _scored(model: Model):
    def score(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer, bucket, rows = None, None, {}
        floor = math.log10(model.train_tokens + model.vocabulary + 1)
        for frame in frames:
            for r in frame.itertuples(index=False):
                if r.bucket != bucket:
                    scorer, bucket, rows = None, r.bucket, {}
                if r.kind != TEXTS:
                    rows.setdefault(r.kind, []).append((r.side, r.blobs))
                    continue
                if scorer is None:
                    scorer, rows = Scorer(model, rows), {}
                words, pairs, names = _hashes(r.blobs[0]), _unpacked(r.blobs[1]), _hashes(r.blobs[2])
                contexts, counts, entries, docs, named = map(_unpacked, r.blobs[3:])
                chance, seen = scorer.pairs(words, pairs, names, contexts)
                total = lambda values: np.bincount(docs, weights=counts * np.repeat(values, entries), minlength=len(named))  # noqa: E731, B023
                sums = [total(x) for x in (np.ones(len(seen)), seen > 0, np.log10(seen + 1) - floor, chance)]
                blobs = [r.blobs[7], *(_packed(x.astype(np.int64)) for x in sums[:2]), *(x.tobytes() for x in sums[2:])]
                yield pd.DataFrame([(r.piece, r.bucket, blobs, r.ids)], columns=["piece", "bucket", "blobs", "ids"])

    return score


def _added(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The scores of every document of a piece, whose parts come one after another; only the sums of one piece are held."""

    def scores() -> pd.DataFrame:
        columns = {"doc_id": list(ids), "n_tokens": sums[0].astype(np.int64), "n_known": sums[1].astype(np.int64)}
        return pd.DataFrame({**columns, "base_score": sums[2], "score": sums[3]})

    piece, sums, ids = None, np.zeros((4, 0)), None
    for frame in frames:
        for r in frame.itertuples(index=False):
            if r.piece != piece:
                if piece is not None:
                    yield scores()
                piece, sums, ids = r.piece, np.zeros((4, 0)), None
            rows = _unpacked(r.blobs[0])
            if rows[-1] >= sums.shape[1]:
                sums = np.pad(sums, ((0, 0), (0, int(rows[-1]) + 1 - sums.shape[1])))
            sums[:2, rows] += [_unpacked(x) for x in r.blobs[1:3]]
            sums[2:, rows] += [np.frombuffer(x) for x in r.blobs[3:]]
            ids = r.ids if r.ids is not None else ids
    if piece is not None:
        yield scores()


def text_scores(docs: DataFrame, learn: Column, how: Settings = Settings(), id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score and score (log10 probability) of every row, learning from those that `learn` names.

    Every previous word has a restaurant of its own, told apart by 64-bit hashes as words are, so contexts grow with the texts. Pairs
    of a word and its context are filed in a grid of blocks, ranges of word hashes by ranges of context hashes: the dishes of a frequent
    word are spread over a row of blocks, those of a frequent context over a column. What crosses blocks are the tables of words and of
    contexts, summed in tables of their own after every sweep; the driver sees eight numbers. All blocks seat their dishes at once, with the
    sums of the sweep before. A block has the pairs of all texts, those of no training text with a count of none, so every pair that is
    to be scored finds its context and its word there. The texts' tokens then meet the blocks piece by piece.

    A null or empty text is its end token alone. Each row is scored by itself, repeated rows and ids alike; a null id is given back.
    `learn` false or null keeps a row out of training. Without training rows words are equally likely. Other columns are not looked at.
    """
    plain = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"), F.coalesce(learn, F.lit(False)).alias("learn"))
    size = plain.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) / 6 + 1)).first()[0] or 0
    grid = int(min(max(3, math.ceil(math.sqrt(size / BLOCK))), 1 << 10))
    buckets = grid * grid
    columns = "bucket int, blobs array<binary>"
    counted = plain.select("text", "learn").mapInPandas(_counted(grid), columns)
    blocks = saved(counted.repartition(buckets, "bucket").mapInPandas(_summed, columns), "blocks")
    model, rows = train(blocks, how, grid)
    # Ids travel as text: beside nulls pandas would make 64-bit numbers inexact.
    sent = plain.select(F.col("doc_id").cast("string").alias("doc_id"), "text").mapInPandas(_sent(grid), f"{ROWS}, piece long, ids array<string>")
    more = {"piece": F.lit(None).cast("long"), "ids": F.lit(None).cast("array<string>")}
    met = _meeting([*(r.withColumns(more) for r in rows), sent], buckets)
    # One row for a piece and block, not for a document and block; a block has at most one part of a piece.
    parts = met.mapInPandas(_scored(model), "piece long, bucket int, blobs array<binary>, ids array<string>")
    whole = parts.repartition(buckets, "piece").sortWithinPartitions("piece", "bucket").mapInPandas(
        _added, "doc_id string, n_tokens long, n_known long, base_score double, score double"
    )
    return whole.select(F.col("doc_id").cast("long"), "n_tokens", "n_known", F.lit(model.train_tokens).cast("long").alias("train_tokens"), "base_score", "score")
