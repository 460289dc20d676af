"""Words of a text as 64-bit hashes, and frames kept between steps in the shared folder."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame

from millrace.session import run_folder

#: A worker forgets its words beyond this number, so that its memory stays bounded.
REMEMBERED = 300_000
#: What keeps the first 0 to 8 bytes of eight.
LEADING = np.array([(1 << 8 * n) - 1 for n in range(9)], dtype=np.uint64)


class WordHashes(dict):
    """The hash of each word, computed once per worker while the word is remembered."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        found = self[word] = xxhash.xxh64_intdigest(word)
        return found


_hashes = WordHashes()


def words(text: str | None) -> list[bytes]:
    """Lower-cased A-Z words between white space (space, tab, line feed, vertical tab, form feed, return), as UTF-8."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def word_hashes(text: str | None) -> np.ndarray:
    found = words(text)
    return np.fromiter(map(_hashes.__getitem__, found), dtype=np.uint64, count=len(found))


def word_bounds(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the words between white space begin in bytes, and where they end."""
    inside = np.zeros(len(raw) + 2, dtype=bool)
    inside[1:-1] = (raw != 32) & (raw - np.uint8(9) > 4)
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return edges[::2], edges[1::2]


def exact_hashes(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """A hash of 63 bits for each word between white space, case and all, and where the word begins.

    Words of up to 16 bytes are two numbers, mixed one after the other, all words at once; longer ones go through xxhash.
    """
    first, end = word_bounds(np.frombuffer(text, dtype=np.uint8))
    size = end - first
    eights = np.ndarray(len(text) + 9, dtype=np.uint64, buffer=text + bytes(16), strides=(1,))
    with np.errstate(over="ignore"):
        found = mixed((eights[first] & LEADING[np.minimum(size, 8)]) + size.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        rest = eights[np.minimum(first + 8, len(text))] & LEADING[np.clip(size - 8, 0, 8)]
        found = mixed(found * np.uint64(0xD6E8FEB86659FD93) + rest)
    for i in np.flatnonzero(size > 16).tolist():
        found[i] = xxhash.xxh64_intdigest(text[first[i] : end[i]])
    return found >> np.uint64(1), first


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    with np.errstate(over="ignore"):
        values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def saved(rows: DataFrame, purpose: str) -> DataFrame:
    """`rows` computed once and written to the shared folder, where they outlive the executors."""
    folder = run_folder(rows.sparkSession, purpose)
    rows.write.parquet(folder)
    return rows.sparkSession.read.schema(rows.schema).parquet(folder)


def whole_groups(frames: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[tuple[tuple, pd.DataFrame]]:
    """The groups of a partition that is sorted by `keys`, one at a time, whatever the batches."""
    open_rows: list[pd.DataFrame] = []
    open_key: tuple | None = None
    for frame in frames:
        if frame.empty:
            continue
        values = [frame[k].to_numpy() for k in keys]
        change = np.zeros(len(frame), dtype=bool)
        for v in values:
            change[1:] |= v[1:] != v[:-1]
        bounds = [0, *np.flatnonzero(change).tolist(), len(frame)]
        for start, end in zip(bounds, bounds[1:]):
            key = tuple(v[start] for v in values)
            if open_key is not None and key != open_key:
                yield open_key, open_rows[0] if len(open_rows) == 1 else pd.concat(open_rows, ignore_index=True)
                open_rows = []
            open_key = key
            open_rows.append(frame.iloc[start:end])
    if open_key is not None:
        yield open_key, open_rows[0] if len(open_rows) == 1 else pd.concat(open_rows, ignore_index=True)
