"""Passages that occur more than once in a corpus, byte for byte or word for word, by enhanced suffix arrays over places that may repeat.

A text is a row of units: its bytes, or a 64-bit hash for each word. Places, lengths and windows count units.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from millrace.llm.words import exact_hashes, mixed, saved, word_bounds

#: Bytes of the seed by whose hash windows are grouped: so many bytes of text, or four words.
SEED = 32
#: Window starts that are looked at together, so that a very long text needs no more memory than this; and the bits of a place.
CHUNK, PLACE = 1 << 20, 21
#: Bytes of text that one suffix array takes in.
ARRAY = 1 << 17
#: Bytes of text whose windows are looked at together where texts are short, and rows handed on together.
PILE, ROWS = 1 << 17, 20_000
#: Units, and the column of their spans. The last bit of a seed says which of them it is of.
KINDS = {np.uint8: "spans", np.uint64: "runs"}
BITS = {kind: bit for bit, kind in enumerate(KINDS)}
#: Ranges of window places that the test before a suffix array tells apart.
CUTS = 8
#: Different surroundings of one seed that one task compares; beyond it every window of them is counted by its hash.
SURROUNDINGS = 20_000
#: Words of the shortest passage: more than 50. Most such runs are shorter than 400 bytes.
PASSAGE = 51


def _seeds(raw: np.ndarray) -> np.ndarray:
    """A hash of the SEED bytes at each place, by doubling from 8 bytes. What has equal hashes is compared before it counts as equal."""
    size = 8 // raw.itemsize
    found = np.ndarray(len(raw) - size + 1, dtype=np.uint64, buffer=raw, strides=(raw.itemsize,))
    for factor in (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)):
        with np.errstate(over="ignore"):
            found = found[:-size] * factor + found[size:]
        size *= 2
    return mixed(found)


def _runs(raw: np.ndarray, sizes: np.ndarray, window: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Arrays of (seed hash, place of the seed, first start, last start) for the windows of texts that lie end to end in `raw`."""
    wide = window - SEED // raw.itemsize + 1
    whole = np.ones(max(len(raw) - window + 1, 0), dtype=bool)
    ends = np.cumsum(sizes)
    for begin, end in zip((ends - sizes).tolist(), ends.tolist()):
        whole[max(begin, end - window + 1) : end] = False
    for base in range(0, len(whole), CHUNK):
        part = raw[base : base + CHUNK + window - 1]
        seeds = _seeds(part)
        low = (seeds >> np.uint64(PLACE) << np.uint64(PLACE)) | np.arange(len(seeds), dtype=np.uint64)
        size = 1
        while 2 * size <= wide:
            low = np.minimum(low[:-size], low[size:])
            size *= 2
        if size < wide:
            low = np.minimum(low[: len(low) - (wide - size)], low[wide - size :])
        place = (low & np.uint64((1 << PLACE) - 1)).astype(np.int64)
        place[~whole[base : base + CHUNK]] = -1
        bounds = np.flatnonzero(np.diff(place)) + 1
        firsts = np.concatenate([[0], bounds])
        lasts = np.concatenate([bounds, [len(place)]]) - 1
        within = place[firsts] >= 0
        firsts, lasts = firsts[within], lasts[within]
        spots = place[firsts]
        yield seeds[spots].view(np.int64), spots + base, firsts + base, lasts + base


def owners(raw: np.ndarray, window: int) -> Iterator[tuple[int, int, int, int]]:
    """(seed hash, place of the seed, first start, last start) for runs of windows whose smallest seed, leftmost of equals, is the same.

    Equal windows have equal smallest seeds at the same place within them, wherever they occur.
    """
    for found in _runs(raw, np.array([len(raw)]), window):
        yield from zip(*(x.tolist() for x in found))


def _encoded(texts: pa.Array) -> list[bytes | None]:
    return texts.cast(pa.large_binary() if pa.types.is_large_string(texts.type) else pa.binary()).to_pylist()


def _laid(texts: list[bytes], kind: type) -> tuple[np.ndarray, np.ndarray]:
    """The units of the texts, end to end, and how many each text has."""
    if kind is np.uint8:
        return np.frombuffer(b"".join(texts), dtype=np.uint8), np.array([len(t) for t in texts])
    found, at = exact_hashes(b" ".join(texts))
    ends = np.cumsum([len(t) + 1 for t in texts])
    return found, np.diff(np.searchsorted(at, ends), prepend=0)


def _digest(part: bytes) -> tuple[int, int]:
    return tuple(np.frombuffer(xxhash.xxh3_128_digest(part), dtype=np.int64).tolist())


def _piles(texts: list[bytes]) -> Iterator[slice]:
    """Neighbours of PILE bytes together, or a longer text alone."""
    begin = size = 0
    for i, text in enumerate(texts):
        if size and size + len(text) > PILE:
            yield slice(begin, i)
            begin, size = i, 0
        size += len(text)
    if size:
        yield slice(begin, len(texts))


ANCHOR = {"text_key": pa.int64(), "text_check": pa.int64(), "seed": pa.int64(), "d1": pa.int64(), "d2": pa.int64()}
ANCHOR |= {"first": pa.int32(), "starts": pa.int32(), "spot": pa.int32()}


def _batch(columns: list[np.ndarray], types: dict[str, pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x).cast(kind) for x, kind in zip(columns, types.values())], names=list(types))


def _anchored(texts: list[bytes], keys: tuple[np.ndarray, ...], window: int, kind: type) -> Iterator[list[np.ndarray]]:
    raw, sizes = _laid(texts, kind)
    begins, width = np.cumsum(sizes) - sizes, raw.itemsize
    view = memoryview(raw).cast("B") if len(raw) else b""
    for seeds, spots, firsts, lasts in _runs(raw, sizes, window):
        bounds = zip((firsts * width).tolist(), ((lasts + window) * width).tolist())
        digests = np.frombuffer(b"".join([xxhash.xxh3_128_digest(view[a:b]) for a, b in bounds]), dtype=np.int64).reshape(-1, 2)
        of = np.searchsorted(begins, firsts, side="right") - 1
        seeds = (seeds & ~1) | BITS[kind]
        yield [*(k[of] for k in keys), seeds, digests[:, 0], digests[:, 1], firsts - begins[of], lasts - firsts + 1, spots - firsts]


def _anchors(windows: dict[type, int]):
    """Of each text, a row for each run of windows: seed, two halves of the digest of its surrounding, and where that lies."""

    def anchor(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[list[np.ndarray]] = []
        for batch in batches:
            texts = _encoded(batch.column("text"))
            keys = tuple(batch.column(c).to_numpy() for c in TEXT)
            for pile in _piles(texts):
                for kind, window in windows.items():
                    for rows in _anchored(texts[pile], tuple(k[pile] for k in keys), window, kind):
                        waiting.append(rows)
                        if sum(len(x[0]) for x in waiting) >= ROWS:
                            yield _batch([np.concatenate(c) for c in zip(*waiting)], ANCHOR)
                            waiting = []
        if waiting:
            yield _batch([np.concatenate(c) for c in zip(*waiting)], ANCHOR)

    return anchor


PART = {"seed": pa.int64(), "d1": pa.int64(), "d2": pa.int64(), "n": pa.int64(), "spot": pa.int32(), "part": pa.binary()}


def _surroundings(windows: dict[type, int]):
    """The bytes of the units at the wanted places of each text."""
    kinds = {BITS[kind]: (kind, window) for kind, window in windows.items()}

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of, names = _listed(batch.column("places"))
            seeds, d1, d2, firsts, starts, spots, counts = (names[c] for c in ("seed", "d1", "d2", "first", "starts", "spot", "n"))
            texts, parts, size = _encoded(batch.column("text")), {}, 0
            units: dict[int, memoryview] = {}
            before = -1
            for i, (t, seed, first, n) in enumerate(zip(of.tolist(), seeds.tolist(), firsts.tolist(), starts.tolist())):
                if t != before:
                    units, before = {}, t
                bit = seed & 1
                kind, window = kinds[bit]
                if bit not in units:
                    units[bit] = memoryview(_laid([texts[t]], kind)[0]).cast("B")
                width = np.dtype(kind).itemsize
                part = bytes(units[bit][first * width : (first + n + window - 1) * width])
                if xxhash.xxh3_128_digest(part) == d1[i].tobytes() + d2[i].tobytes():
                    parts[i] = part
                    size += len(part)
                if size > 16 * PILE:
                    yield _batch([*(x[list(parts)] for x in (seeds, d1, d2, counts, spots)), list(parts.values())], PART)
                    parts, size = {}, 0
            if parts:
                yield _batch([*(x[list(parts)] for x in (seeds, d1, d2, counts, spots)), list(parts.values())], PART)

    return cut


def _listed(lists: pa.ListArray) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """The structs of all rows' lists as arrays by field, and of which row each one is; a null is an empty list."""
    sizes = np.nan_to_num(np.asarray(pa.compute.list_value_length(lists).to_numpy(zero_copy_only=False), dtype=np.float64)).astype(np.int64)
    flat = lists.flatten()
    return np.repeat(np.arange(len(lists)), sizes), {f.name: c.to_numpy(zero_copy_only=False) for f, c in zip(flat.type, flat.flatten())}


def suffix_array(raw: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """Places in the order of the bytes that follow, and the common prefix of each with the one before, both up to `reach` (a power of two).

    `raw` ends in a unit that sorts by its place if nothing follows; ranks of 8, 16, 32 ... bytes are kept for the prefixes.
    """
    n = len(raw)
    unit = 8 // raw.itemsize
    first = raw
    if unit > 1:
        first = np.ndarray(n, dtype=">u8", buffer=raw.tobytes() + bytes(8), strides=(1,)).astype(np.uint64)
    order = np.argsort(first)
    ranks = [_ranked(order, first)]
    size = unit
    bits = n.bit_length()
    while size < reach:
        rank = ranks[-1]
        if rank[order[-1]] == n - 1:  # all differ by now
            break
        key = rank.astype(np.int64) << bits
        key[: max(n - size, 0)] |= rank[size:] + np.int64(1)
        if 3 * bits < 64:  # sorted with its place in one number
            key = np.sort(key << bits | np.arange(n))
            order = key & ((1 << bits) - 1)
            ranks.append(_numbered(order, key >> bits))
        else:
            order = np.argsort(key)
            ranks.append(_ranked(order, key))
        size *= 2
    left, right = order[:-1].astype(np.int32), order[1:].astype(np.int32)
    common = np.zeros(max(n - 1, 0), dtype=np.int64)
    for level in range(len(ranks) - 1, -1, -1):
        rank, step = ranks[level], unit << level
        same = (rank[np.minimum(left, n - 1)] == rank[np.minimum(right, n - 1)]) & (np.maximum(left, right) + step <= n)
        grown = same * np.int32(step)
        common += grown
        left += grown
        right += grown
    for _ in range(unit - 1):
        same = (raw[np.minimum(left, n - 1)] == raw[np.minimum(right, n - 1)]) & (np.maximum(left, right) < n)
        if not same.any():
            break
        common += same
        left += same
        right += same
    return order, np.concatenate([[0], common])


def _ranked(order: np.ndarray, key: np.ndarray) -> np.ndarray:
    return _numbered(order, key[order])


def _numbered(order: np.ndarray, sorted_key: np.ndarray) -> np.ndarray:
    rank = np.empty(len(order), dtype=np.int32)
    rank[order] = np.concatenate([[0], np.cumsum(sorted_key[1:] != sorted_key[:-1])])
    return rank


Nested = dict[tuple[int, int], tuple[int, int]]


def maximal_repeats(places: np.ndarray, common: np.ndarray, left: np.ndarray, least: int, nested: Nested) -> Iterator[tuple[int, int, int]]:
    """(place, length, group) from the tree of common-prefix intervals of at least `least` bytes.

    `places` are in suffix order, common[i] is what places[i] shares with the one before, left[i] the byte before it, or a value of
    its own where the text is cut. An interval all of whose places follow the same byte can be extended to the left, and
    is no maximal repeat; its places go up to the interval that holds it. Each place is given with the longest maximal repeat
    that it starts; a repeat's occurrences are its own places and those of the repeats inside it, of which `nested` learns: it gets the
    repeat around each one. Repeats are named by their first row and length there, and by their first row in what is given.
    """
    open_nodes: list[list] = []  # length, first position, left byte or None if several, places and repeats that wait for a maximal repeat

    def close(node: list) -> Iterator[tuple[int, int, int]]:
        if node[2] is None:
            name = (node[1], node[0])
            for p in node[3]:
                if isinstance(p, tuple):
                    nested[p] = name
                else:
                    yield int(places[p]), node[0], node[1]
            node[3] = [name]

    total = len(places)
    for i in range(1, total + 1):
        shared = int(common[i]) if i < total else 0
        begin = i - 1
        last = None
        while open_nodes and open_nodes[-1][0] > shared:
            last = open_nodes.pop()
            if last[2] is None:
                yield from close(last)
            begin = last[1]
            if open_nodes and open_nodes[-1][0] >= shared and open_nodes[-1][0] >= least:
                _absorb(open_nodes[-1], last)
                last = None
        if shared < least:
            continue
        if not open_nodes or open_nodes[-1][0] < shared:
            if last is None and open_nodes:
                open_nodes[-1][3].pop()  # the place before goes on into this interval
            node = [shared, begin, left[i - 1] if last is None else last[2], [i - 1] if last is None else last[3]]
            open_nodes.append(node)
        node = open_nodes[-1]
        node[3].append(i)
        if node[2] is not None and node[2] != left[i]:
            node[2] = None


def _absorb(outer: list, inner: list) -> None:
    outer[3].extend(inner[3])
    if outer[2] != inner[2]:
        outer[2] = None


def repeated_places(
    parts: list[bytes], owned: list[int], least: int, kind: type = np.uint8, nested: Nested | None = None
) -> Iterator[tuple[int, int, int, tuple[int, int]]]:
    """(part, start, length, group) of the maximal repeats of at least `least` units that begin in the first owned[p] units of the parts.

    A group is named by a number and its length before it is cut at the end of a part; `nested` gets the group around each one.

    The parts hold UTF-8 or hashes of words; a unit that neither has stands between them, and no length runs over it.
    """
    width = np.dtype(kind).itemsize
    sizes = np.array([len(p) // width + 1 for p in parts])
    begins = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    gap = b"\xff" * width
    raw = np.frombuffer(gap.join(parts) + gap, dtype=kind)
    reach = 8
    while reach < sizes.max():
        reach *= 2
    order, common = suffix_array(raw, reach)
    part_of = np.repeat(np.arange(len(parts)), sizes)
    start_of = np.arange(len(raw)) - np.repeat(begins, sizes)
    mine = start_of < np.array(owned)[part_of]
    keep = np.flatnonzero(mine[order])
    if not len(keep):
        return
    # What neighbours among the owned places share is the least of what lies between.
    shared = np.minimum.reduceat(common[: keep[-1] + 1], np.concatenate([[0], keep[:-1] + 1]))
    places = order[keep]
    long = shared >= least
    long[0] = False
    runs = np.flatnonzero(np.diff(np.concatenate([[False], long, [False]]).astype(np.int8))).reshape(-1, 2)
    left = np.where(start_of[places] == 0, -1 - np.arange(len(places)), raw[places - 1].astype(np.int64))
    if not len(runs):
        return
    # Where all places follow the same unit, no interval is a maximal repeat; runs of places begin one before that of their first prefix.
    edges = (runs - [1, 0]).ravel()
    padded = np.append(left, 0)
    differ = np.minimum.reduceat(padded, edges)[::2] != np.maximum.reduceat(padded, edges)[::2]
    for begin, end in runs[differ].tolist():
        some = slice(begin - 1, end)
        inside: Nested = {}
        for place, length, group in maximal_repeats(places[some], shared[some], left[some], least, inside):
            part = part_of[place]
            yield int(part), int(start_of[place]), min(length, int(sizes[part] - 1 - start_of[place])), (begin - 1 + group, length)
        if nested is not None:
            nested.update(((begin - 1 + a, x), (begin - 1 + b, y)) for (a, x), (b, y) in inside.items())


def _sharing(parts: list[bytes], spots: list[int], window: int, width: int) -> list[bool]:
    """Whether a part may share a window with another part of its seed.

    A window reaches some way to the left of the seed and the rest to the right. With the ways to the left in CUTS ranges, the bytes
    that all windows of a range have in common must occur in another part too. Units are `width` bytes wide.
    """
    room = window * width - SEED
    edges = [room * i // CUTS for i in range(CUTS + 1)]
    keys = []
    for part, spot in zip(parts, spots):
        spot *= width
        right = len(part) - spot - SEED
        keys.append(
            [
                (i, xxhash.xxh3_64_intdigest(part[spot - a : spot + SEED + room - b]))
                for i, (a, b) in enumerate(zip(edges, edges[1:]))
                if spot >= a and right >= room - b
            ]
        )
    seen = Counter(k for own in keys for k in own)
    return [any(seen[k] > 1 for k in own) for own in keys]


def _groups(frames: Iterator[pd.DataFrame], columns: tuple[str, ...]) -> Iterator[list[tuple]]:
    """The `columns` of the surroundings of one seed after another, from rows in the order of seeds, which is the first column."""
    own: list[tuple] = []
    for frame in frames:
        for row in zip(*(frame[c].tolist() for c in columns)):
            if own and own[0][0] != row[0]:
                yield own
                own = []
            own.append(row)
    if own:
        yield own


def _compared(windows: dict[type, int]):
    """Suffix arrays over whole groups of surroundings, as many groups as fit ARRAY bytes."""

    def compare(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        piles: dict[type, tuple[list, list]] = {kind: ([], []) for kind in windows}
        for rows in _groups(frames, ("seed", "d1", "d2", "n", "part", "spot")):
            kind = next(k for k in windows if BITS[k] == rows[0][0] & 1)
            names, parts = piles[kind]
            if parts and sum(map(len, parts)) + sum(len(r[4]) for r in rows) > ARRAY:
                yield _rows(names, parts, windows[kind], kind)
                piles[kind] = names, parts = [], []
            for row, wanted in zip(rows, _sharing([r[4] for r in rows], [r[5] for r in rows], windows[kind], np.dtype(kind).itemsize)):
                if wanted:
                    names.append(row[:4])
                    parts.append(row[4])
        for kind, (names, parts) in piles.items():
            if parts:
                yield _rows(names, parts, windows[kind], kind)

    return compare


def _rows(names: list[tuple], parts: list[bytes], window: int, kind: type) -> pd.DataFrame:
    """What the surroundings share; those that lie at several places repeat whole, and are not named again."""
    ranges: dict[int, list[tuple[int, int]]] = {}
    width = np.dtype(kind).itemsize
    for p, start, length, _ in repeated_places(parts, [len(p) // width - window + 1 for p in parts], window, kind):
        if names[p][3] == 1:
            ranges.setdefault(p, []).append((start, start + length))
    rows = [(*names[p][:3], first, end - first) for p, own in ranges.items() for first, end in _united(own)]
    return pd.DataFrame(rows, columns=["seed", "d1", "d2", "start", "length"])


#: Rows about an occurrence, about a group within another one, about a group within none.
PLACED, INNER, OUTER = 0, 1, 2
GROUPS = "what int, seed long, d1 long, d2 long, start int, length int, g1 long, g2 long, p1 long, p2 long"


def _group_rows(names: list[tuple], parts: list[bytes], window: int, kind: type) -> Iterator[tuple]:
    """Occurrences and groups among surroundings of one seed. names: seed, digest, and whether the surrounding itself lies at several places."""
    width, nested = np.dtype(kind).itemsize, {}
    found = list(repeated_places(parts, [len(p) // width - window + 1 for p in parts], window, kind, nested))
    at: dict[tuple[int, int], tuple[int, int]] = {}
    for p, start, _, group in found:
        at.setdefault(group, (p, start))
    for inner, outer in nested.items():  # the innermost come first
        at.setdefault(outer, at[inner])
    strings = {g: parts[p][start * width : (start + g[1]) * width] for g, (p, start) in at.items()}
    digests = {g: _digest(x) for g, x in strings.items()}
    for g, x in strings.items():
        around = digests.get(nested.get(g))
        if around is None:
            yield OUTER, 0, 0, 0, 0, len(x) // width, *digests[g], 0, 0
        elif around != digests[g]:
            yield INNER, 0, 0, 0, 0, len(x) // width, *digests[g], *around
    begun = {}
    for p, start, _, g in found:
        if start == 0 and names[p][3]:
            begun[p] = digests[g]
        else:
            yield PLACED, *names[p][:3], start, 0, *digests[g], 0, 0
    for p, (*name, whole) in enumerate(names):
        if whole:  # the longest that begins there
            own, around = tuple(name[1:]), begun.get(p)
            yield PLACED, *name, 0, 0, *own, 0, 0
            if around is None:
                yield OUTER, 0, 0, 0, 0, len(parts[p]) // width, *own, 0, 0
            elif around != own:
                yield INNER, 0, 0, 0, 0, len(parts[p]) // width, *own, *around


def _grouped(window: int, kind: type):
    """The groups of each seed, whose surroundings are no more than a task may hold."""

    def group(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        width = np.dtype(kind).itemsize
        for rows in _groups(frames, ("seed", "d1", "d2", "whole", "part", "spot")):
            sharing = _sharing([r[4] for r in rows], [r[5] for r in rows], window, width)
            rows = [r for r, shares in zip(rows, sharing) if shares or r[3]]
            found = _group_rows([r[:4] for r in rows], [r[4] for r in rows], window, kind) if rows else iter(())
            while some := list(islice(found, 100_000)):
                yield pd.DataFrame(some, columns=[c.split()[0] for c in GROUPS.split(", ")])

    return group


def _united(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The union of [first, end) ranges as disjoint ones that do not touch, in order."""
    out: list[tuple[int, int]] = []
    for first, end in sorted(ranges):
        if out and first <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((first, end))
    return out


def _window_hashes(windows: dict[type, int]):
    def each(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for seed, d1, d2, part in zip(frame["seed"], frame["d1"], frame["d2"], frame["part"]):
                kind = next(k for k in windows if BITS[k] == seed & 1)
                window, width = windows[kind], np.dtype(kind).itemsize
                digests = [_digest(part[i * width : (i + window) * width]) for i in range(len(part) // width - window + 1)]
                yield pd.DataFrame(
                    {"seed": seed, "d1": d1, "d2": d2, "start": range(len(digests)), "w1": [d[0] for d in digests], "w2": [d[1] for d in digests]}
                )

    return each


#: By what a text is known.
TEXT = ["text_key", "text_check"]


def _text_keys() -> list[Column]:
    return [F.xxhash64("text").alias("text_key"), F.xxhash64(F.lit(1), F.col("text")).alias("text_check")]


#: By what a surrounding is known.
SAME = ["seed", "d1", "d2"]


def _gathered(docs: DataFrame, text_column: str, windows: dict[type, int]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The texts, every run of windows, and the classes of equal ones that may repeat, each with one of its places."""
    plain = docs.select(F.col(text_column).alias("text")).where("text is not null").select(*_text_keys(), "text")
    schema = "text_key long, text_check long, seed long, d1 long, d2 long, first int, starts int, spot int"
    anchors = saved(plain.mapInArrow(_anchors(windows), schema), "anchors")
    # Numbers alone are aggregated by hash; all of a class's come from one row.
    place = [F.first(c).alias(c) for c in (*TEXT, "first", "starts", "spot")]
    classes = anchors.groupBy(*SAME).agg(F.count("*").alias("n"), *place)
    # Counted on the map side; a window would bring all classes of a seed into one task.
    shared = classes.groupBy("seed").agg(F.count("*").alias("classes"), F.max("n").alias("most")).where("classes > 1 or most > 1")
    # Most classes stand alone under their seed: they are neither written nor compared.
    classes = saved(classes.join(shared.drop("most"), "seed").where("classes > 1 or n > 1"), "classes")
    return plain, anchors, classes


def _parts(plain: DataFrame, wanted: DataFrame, windows: dict[type, int]) -> DataFrame:
    """One surrounding of each class."""
    places = wanted.groupBy(*TEXT).agg(F.collect_list(F.struct(*SAME, "n", "first", "starts", "spot")).alias("places"))
    texts = plain.join(places.select(*TEXT), TEXT, "left_semi").groupBy(*TEXT).agg(F.first("text").alias("text"))
    schema = "seed long, d1 long, d2 long, n long, spot int, part binary"
    return texts.join(places, TEXT).select("text", "places").mapInArrow(_surroundings(windows), schema)


def _by_seed(plain: DataFrame, classes: DataFrame, windows: dict[type, int], surroundings: int) -> DataFrame:
    """The surroundings of each seed that has several, but no more than a task may hold, one seed after another."""
    wanted = classes.where((F.col("classes") > 1) & (F.col("classes") <= surroundings))
    return _parts(plain, wanted, windows).repartition("seed").sortWithinPartitions(*SAME)


def _crowded(plain: DataFrame, classes: DataFrame, windows: dict[type, int], surroundings: int) -> DataFrame | None:
    """Every window that repeats under a seed with more surroundings, by 128 bits of hash: none where there is no such seed."""
    wanted = classes.where((F.col("classes") > 1) & (F.col("classes") > surroundings))
    if wanted.isEmpty():
        return None
    parts = saved(_parts(plain, wanted, windows), "parts")
    hashed = parts.mapInPandas(_window_hashes(windows), "seed long, d1 long, d2 long, start int, w1 long, w2 long")
    often = hashed.groupBy("w1", "w2").count().where("count > 1").select("w1", "w2")
    window = F.when(F.col("seed").bitwiseAND(1) == 0, windows.get(np.uint8, 0)).otherwise(windows.get(np.uint64, 0))
    return hashed.join(often, ["w1", "w2"]).select(*SAME, "start", window.alias("length"), "w1", "w2")


def _all_spans(docs: DataFrame, text_column: str, windows: dict[type, int], surroundings: int) -> DataFrame:
    """(text_key, text_check, spans, runs): what repeat_spans gives of bytes, and of words, all found together."""
    plain, anchors, classes = _gathered(docs, text_column, windows)
    by_seed = _by_seed(plain, classes, windows, surroundings)
    found = by_seed.mapInPandas(_compared(windows), "seed long, d1 long, d2 long, start int, length int")
    length = F.col("starts") - 1 + F.when(F.col("seed").bitwiseAND(1) == 0, windows.get(np.uint8, 0)).otherwise(windows.get(np.uint64, 0))
    ranges = found.unionByName(classes.where("n > 1").select(*SAME, F.lit(0).alias("start"), length.alias("length")))
    windows_of = _crowded(plain, classes, windows, surroundings)
    if windows_of is not None:
        listed = windows_of.groupBy(*SAME).agg(F.collect_set(F.struct("start", "length")).alias("ranges"))
        merged = listed.mapInPandas(_merged_ranges, listed.schema).select(*SAME, F.inline("ranges"))
        ranges = ranges.unionByName(merged.select(*SAME, "start", "length"))
    covered = saved(ranges, "ranges").withColumn("of", F.col("seed").bitwiseAND(1)).drop("seed")
    # Equal surroundings have equal seeds: the digest is enough, and the rest of the anchors' columns stays behind.
    spans = anchors.select(*TEXT, "d1", "d2", "first").join(covered, ["d1", "d2"])
    begin = F.col("first") + F.col("start")
    spans = spans.select(*TEXT, "of", F.struct(begin.alias("first"), (begin + F.col("length")).alias("end")).alias("span"))
    each = [F.collect_set(F.when(F.col("of") == BITS[kind], F.col("span"))).alias(name) for kind, name in KINDS.items()]
    return spans.groupBy(*TEXT).agg(*each)


def repeat_spans(
    docs: DataFrame, text_column: str = "text", window: int = 400, surroundings: int = SURROUNDINGS, kind: type = np.uint8
) -> DataFrame:
    """(text_key, text_check, spans) of each text that shares a string of `window` units with any other place; spans are [first, end) units.

    Units are bytes, or for np.uint64 the words between white space, case and all.

    The two keys are 128 bits of hash of the text. Every window is filed under its smallest seed; a run of windows with one seed and the bytes
    around it is one row. Rows with equal bytes are one class, reduced before the shuffle: a class of several places repeats
    throughout. Only where a seed has several classes are their bytes gathered, one place for each class, and a suffix array with
    its common-prefix intervals gives the maximal repeats. A seed with more classes than `surroundings` has its windows
    counted by 128-bit hashes instead, so that no task has to hold them together.
    """
    return _all_spans(docs, text_column, {kind: window}, surroundings).select(*TEXT, F.col(KINDS[kind]).alias("spans"))


def repeat_groups(
    docs: DataFrame, text_column: str = "text", window: int = 400, surroundings: int = SURROUNDINGS, kind: type = np.uint8
) -> tuple[DataFrame, DataFrame]:
    """(groups, occurrences) of the maximal repeats of at least `window` units; what they cover is what `repeat_spans` gives.

    groups: group_key, group_check (128 bits of hash of the repeated string), length, and around_key, around_check of the longest group
    that is a proper beginning of it, null if none is. occurrences: text_key, text_check, first, and the longest group that begins
    there. A group occurs at its own places and those of all groups within it, so rows grow with the places and not with their
    nesting. A text of several rows has its occurrences once for each.

    A repeat is maximal among the windows of one smallest seed: where the seed changes within a longer repeat, the next group goes on.
    All places of a string have the same seed, so none is missing. Under a seed with more classes than `surroundings` the groups are
    the repeated windows and the surroundings that repeat whole. Null, empty and short texts have no occurrences.
    """
    same, windows = SAME, {kind: window}
    plain, anchors, classes = _gathered(docs, text_column, windows)
    by_seed = _by_seed(plain, classes, windows, surroundings).withColumn("whole", F.col("n") > 1)
    compared = saved(by_seed.mapInPandas(_grouped(window, kind), GROUPS), "groups")
    alone = classes.where((F.col("classes") == 1) | (F.col("classes") > surroundings)).where("n > 1")
    alone = alone.select(*same, F.lit(0).alias("start"), (F.col("starts") + (window - 1)).alias("length"), F.col("d1").alias("g1"), F.col("d2").alias("g2"))
    counted = _crowded(plain, classes, windows, surroundings)
    if counted is None:
        counted = docs.sparkSession.createDataFrame([], "seed long, d1 long, d2 long, start int, length int, w1 long, w2 long")
    counted = counted.withColumnsRenamed({"w1": "g1", "w2": "g2"})
    # A surrounding that repeats begins with a window that may be a group too: the longer one is named at the place, the other lies around it.
    begun = counted.join(alone.select(*same, "start"), [*same, "start"], "left_anti")
    window_at = counted.where("start = 0").select(*same, F.col("g1").alias("p1"), F.col("g2").alias("p2"))
    longer = F.col("length") > window

    name = [F.col("g1").alias("group_key"), F.col("g2").alias("group_check")]
    inner = F.col("what") == INNER
    around = [F.when(inner, F.col(c)).alias(a) for c, a in (("p1", "around_key"), ("p2", "around_check"))]
    none = [F.lit(None).cast("long").alias(a) for a in ("around_key", "around_check")]
    groups = compared.where(F.col("what") != PLACED).select(*name, "length", *around)
    found = [F.when(longer, F.col(c)).alias(a) for c, a in (("p1", "around_key"), ("p2", "around_check"))]
    groups = groups.unionByName(alone.join(window_at, same, "left").select(*name, "length", *found)).unionByName(counted.select(*name, "length", *none))
    places = compared.where(F.col("what") == PLACED).select(*same, "start", "g1", "g2")
    for rows in (alone, begun):
        places = places.unionByName(rows.select(*same, "start", "g1", "g2"))
    return groups.distinct(), anchors.join(places, same).select(*TEXT, (F.col("first") + F.col("start")).alias("first"), *name)


def _merged_ranges(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A class has few ranges after this, as its windows overlap; each place of it repeats them."""
    for frame in frames:
        merged = [_united([(r["start"], r["start"] + r["length"]) for r in ranges]) for ranges in frame["ranges"]]
        frame["ranges"] = [[{"start": first, "length": end - first} for first, end in own] for own in merged]
        yield frame


#: What without_repeats says of each text, and what it says of passages that stay.
CUT = {"n_bytes": "long", "n_removed": "long", "n_spans": "long", "kept_sha256": "string", "text": "string"}
MARKED = {"n_passages": "long", "n_passage_bytes": "long"}


def _joined(of: np.ndarray, first: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The unions of the [first, end) ranges of each text, as _united has them, all texts at once."""
    if not len(of):
        return of, first, end
    order = np.lexsort((first, of))
    of, first, end = of[order], first[order].astype(np.int64), end[order].astype(np.int64)
    shift = of * (int(end.max()) + 2)
    reach = np.maximum.accumulate(end + shift)
    begins = np.flatnonzero(np.append(True, (first + shift)[1:] > reach[:-1]))
    return of[begins], first[begins], (reach - shift)[np.append(begins[1:], len(of)) - 1]


def _passages(texts: list[bytes], of: np.ndarray, first: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of words as ranges of bytes."""
    cuts = np.flatnonzero(np.diff(of)) + 1
    found = []
    for mine, a, z in zip(np.split(of, cuts), np.split(first, cuts), np.split(end, cuts)) if len(of) else ():
        begins, ends = word_bounds(np.frombuffer(texts[mine[0]], dtype=np.uint8))
        known = a < len(begins)  # another text of the same key may have more words
        found.append((mine[known], begins[a[known]], ends[np.minimum(z[known], len(ends)) - 1]))
    return tuple(np.concatenate(x) for x in zip(*found)) if found else (of, first, end)


def _removed(marked: bool):
    types = {"n_bytes": pa.int64(), "n_removed": pa.int64(), "n_spans": pa.int64(), "kept_sha256": pa.string()}

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("text")
            texts = [t or b"" for t in _encoded(column)]
            sizes = np.array([len(t) for t in texts], dtype=np.int64)
            spans, runs = (_listed(batch.column(name)) for name in KINDS.values())
            of, first, end = spans[0], spans[1]["first"], spans[1]["end"]
            end = np.minimum(end, sizes[of])
            passages = _passages(texts, runs[0], runs[1]["first"], runs[1]["end"])
            if not marked:
                of, first, end = (np.concatenate(x) for x in zip((of, first, end), passages))
            of, first, end = _joined(of, first, end)
            gone = np.bincount(of, weights=end - first, minlength=len(texts)).astype(np.int64)
            counts = np.bincount(of, minlength=len(texts))
            ranges = iter(zip(first.tolist(), end.tolist()))
            hashes, left = [], texts.copy()
            for i, (text, n) in enumerate(zip(texts, counts.tolist())):
                if n:
                    bounds = [0, *(x for span in islice(ranges, n) for x in span), len(text)]
                    text = b"".join([text[a:b] for a, b in zip(bounds[::2], bounds[1::2])])
                    left[i] = text.decode("utf-8", "ignore").encode()
                hashes.append(hashlib.sha256(text).hexdigest())
            whole = pa.array(left, pa.binary(), mask=column.is_null().to_numpy(zero_copy_only=False)).view(pa.string()).cast(column.type)
            out = [pa.array(x).cast(kind) for x, kind in zip((sizes, gone, counts, hashes), types.values())]
            if marked:
                of, first, end = _joined(*passages)
                out += [whole, pa.array(np.bincount(of, minlength=len(texts))), pa.array(np.bincount(of, weights=end - first, minlength=len(texts)).astype(np.int64))]
            yield pa.RecordBatch.from_arrays([batch.column("row"), *(out if marked else [*out, whole])], names=["row", *CUT, *(MARKED if marked else ())])

    return remove


def without_repeats(
    docs: DataFrame, text_column: str = "text", window: int = 400, words: int | None = None, marked: int | None = None
) -> DataFrame:
    """The rows of `docs`: all its columns under `row`, n_bytes, n_removed, n_spans, kept_sha256 and the remaining `text`.

    Every byte covered by a string of `window` bytes that starts at another place too is taken out, in every document that has
    it. A character that loses some of its bytes goes from `text` whole; kept_sha256 is of the bytes. Null and empty texts have 0
    bytes, and a null text stays null. Repeated rows repeat each other: both lose what they share. Ids are not looked at.
    With `words`, every run of so many words that occurs at another place too goes as well, whatever white space parts its
    words; it goes from the first byte of its first word to the last of its last. With `marked` in its place, such runs stay:
    n_passages counts them, and n_passage_bytes their bytes, overlapping ones as one.
    """
    if words and marked:
        raise ValueError("passages are taken out or marked, not both")
    windows = {np.uint8: window} | ({np.uint64: words or marked} if words or marked else {})
    spans = _all_spans(docs, text_column, windows, SURROUNDINGS)
    keyed = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns if c != text_column)).alias("row"), F.col(text_column).alias("text"))
    keyed = keyed.select("row", *_text_keys(), "text")
    schema = keyed.select("row").schema
    for name, kind in (CUT | MARKED if marked else CUT).items():
        schema = schema.add(name, kind)
    return keyed.join(spans, TEXT, "left").drop(*TEXT).mapInArrow(_removed(bool(marked)), schema)
