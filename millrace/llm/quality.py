"""A quality classifier: document statistics, random Fourier features, ridge scores from summed normal equations, isotonic calibration."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame, functions as F

from millrace.llm.words import saved, words

#: Frequent short words of the four languages of the corpus; a fixed value.
STOP_WORDS = frozenset(
    "a an and are as at be by for from have he in is it of on or that the this to was with "
    "au avec dans de des du en est et la le les ne par pas pour que qui se sur un une "
    "auf das dem den der des die ein eine für im ist mit nicht sich und von zu "
    "como con del el en es las los más no para por que se su un una y".encode().split()
)
NAMES = (
    "size words word_length distinct top_word stop_words letters capitals digits spaces lines line_repeats "
    "punctuation commas stops marks symbols brackets wide runs"
).split()
_KIND = np.zeros(256, dtype=np.int64)
for _k, _chars in enumerate(
    [b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t", b"\n\r", b",;:", b".", b"!?", b"#$%&*+@^_`~|=\\", b"()[]{}<>/\"'-"], 1
):
    _KIND[np.frombuffer(_chars, dtype=np.uint8)] = _k
_KIND[128:] = 11


def statistics(text: str | None) -> list[float]:
    """The features of NAMES, all finite; of an empty or null text all 0."""
    found = words(text)
    raw = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), dtype=np.uint8)
    size = max(len(raw), 1)
    kinds = np.bincount(_KIND[raw], minlength=12)
    seen = Counter(found)
    n = max(len(found), 1)
    lines = [x for x in (text or "").split("\n") if x.strip()]
    same = int((raw[1:] == raw[:-1]).sum())
    small, capital, digit, space, line, comma, stop, mark, symbol, bracket, wide = (kinds[1:] / size).tolist()
    return [
        float(np.log1p(len(raw))), float(np.log1p(len(found))), min(size / n, 100.0), len(seen) / n,
        (max(seen.values()) / n if seen else 0.0), sum(c for w, c in seen.items() if w in STOP_WORDS) / n,
        small + capital + wide, capital / max(small + capital, 1e-9), digit, space, len(lines) / n,
        1 - len(set(lines)) / max(len(lines), 1), comma + stop + mark + symbol + bracket, comma, stop, mark, symbol, bracket, wide, same / size,
    ]


@dataclass(frozen=True)
class Settings:
    """max_labelled bounds the labelled rows that the fit uses; more are thinned by a hash of their id, alike in every run."""

    features: int = 256
    width: float = 4.0
    ridge: float = 1.0
    max_labelled: int = 1_000_000
    seed: int = 11


def _measured(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        frame["stats"] = [statistics(text) for text in frame["text"]]
        yield frame.drop(columns="text")


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    turn: np.ndarray
    shift: np.ndarray
    weights: np.ndarray
    steps: tuple[np.ndarray, np.ndarray]

    def features(self, stats: np.ndarray) -> np.ndarray:
        scaled = np.clip((stats - self.mean) / self.scale, -8, 8)
        waves = np.cos(scaled @ self.turn + self.shift) * np.sqrt(2 / len(self.shift))
        return np.hstack([waves, np.ones((len(stats), 1))])

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.features(stats) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        """Calibrated; a thousandth of the plain score keeps apart what a step of the calibration levels."""
        raw = self.raw(stats)
        steps = np.interp(raw, *self.steps) if len(self.steps[0]) else np.full(len(raw), 0.5)
        return np.clip(0.999 * steps + 0.001 / (1 + np.exp(-4 * (raw - 0.5))), 0, 1)


def _stacked(column: pd.Series, width: int) -> np.ndarray:
    return np.array(column.tolist(), dtype=float).reshape(len(column), width)


def _summed(rows: DataFrame, of_batch, shape: tuple[int, ...]) -> np.ndarray:
    """The sum over all rows of of_batch(stats, y): summed in each partition, then in a few tasks, then here."""

    def each(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(shape)
        for frame in frames:
            if len(frame):
                total += of_batch(_stacked(frame["stats"], len(NAMES)), frame["y"].to_numpy(dtype=float))
        yield pd.DataFrame({"total": [total.tobytes()]})

    def again(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(shape)
        for frame in frames:
            for part in frame["total"]:
                total += np.frombuffer(part).reshape(shape)
        yield pd.DataFrame({"total": [total.tobytes()]})

    parts = rows.mapInPandas(each, "total binary").repartition(8).mapInPandas(again, "total binary").collect()
    return sum((np.frombuffer(p["total"]).reshape(shape) for p in parts), np.zeros(shape))


def fit(labelled: DataFrame, how: Settings = Settings()) -> Model | None:
    """A model of `labelled` (id, stats, y 0 or 1); None if a class has no row."""
    count = labelled.count()
    if count > how.max_labelled:
        labelled = labelled.where(F.pmod(F.xxhash64("id", F.lit(how.seed)), F.lit(1 << 20)) < int((1 << 20) * how.max_labelled / count))
    labelled = saved(labelled, "labelled")
    width = len(NAMES)
    calibrates = F.pmod(F.xxhash64("id", F.lit(how.seed + 1)), F.lit(5)) == 0
    to_fit = labelled.where(~calibrates)

    def moments(stats: np.ndarray, y: np.ndarray) -> np.ndarray:
        row = np.concatenate([stats, stats**2, np.column_stack([np.ones(len(y)), y])], axis=1)
        return row.sum(axis=0)

    sums = _summed(to_fit, moments, (2 * width + 2,))
    n, ones = sums[-2], sums[-1]
    if not 0 < ones < n:
        return None
    mean = sums[:width] / n
    scale = np.sqrt(np.maximum(sums[width : 2 * width] / n - mean**2, 1e-12))
    scale[scale < 1e-5] = 1.0
    random = np.random.default_rng(how.seed)
    turn = random.normal(size=(width, how.features)) / how.width
    shift = random.uniform(0, 2 * np.pi, how.features)
    model = Model(mean, scale, turn, shift, np.zeros(how.features + 1), (np.array([]), np.array([])))

    def normal(stats: np.ndarray, y: np.ndarray) -> np.ndarray:
        z = model.features(stats)
        weight = np.where(y > 0, 0.5 / ones, 0.5 / (n - ones))[:, None] * n
        return (z * weight).T @ np.column_stack([z, y])

    size = how.features + 1
    equations = _summed(to_fit, normal, (size, size + 1))
    model.weights = np.linalg.solve(equations[:, :size] + how.ridge * np.eye(size), equations[:, size])

    def scored(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if len(frame):
                yield pd.DataFrame({"raw": model.raw(_stacked(frame["stats"], width)), "y": frame["y"].astype(float)})

    held = labelled.where(calibrates)
    if held.isEmpty():
        held = labelled
    steps = IsotonicRegression(featuresCol="raw", labelCol="y", weightCol="w").fit(
        held.mapInPandas(scored, "raw double, y double").withColumn("w", F.lit(1.0))
    )
    model.steps = (steps.boundaries.toArray(), steps.predictions.toArray())
    return model


def quality_scores(
    docs: DataFrame, labels: DataFrame, how: Settings = Settings(), id_column: str = "doc_id", text_column: str = "text",
    label_column: str = "quality", learn: Column | None = None,
) -> DataFrame:
    """doc_id, score (0 to 1), predicted (1 from 0.5 on) of every row of `docs`.

    `learn` says, over id_column, which documents may be learned from; all, if it is None. The score sees the text alone. A null
    or empty text is scored by its zero statistics. A null id is scored, but has no label. Repeated labels count each; a null
    label is none. Without labels of both classes every score is 0.5. Other columns are not looked at.
    """
    plain = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"))
    measured = saved(plain.mapInPandas(_measured, "id long, stats array<double>"), "statistics")
    known = labels.select(F.col(id_column).cast("long").alias(id_column), F.col(label_column).cast("int").alias("y")).where("y in (0, 1)")
    if learn is not None:
        known = known.where(learn)
    model = fit(measured.join(known.withColumnRenamed(id_column, "id"), "id"), how)

    def score(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            stats = _stacked(frame["stats"], len(NAMES))
            found = model.score(stats) if model is not None else np.full(len(frame), 0.5)
            yield pd.DataFrame({"doc_id": frame["id"].astype("Int64"), "score": found, "predicted": (found >= 0.5).astype("int32")})

    return measured.mapInPandas(score, "doc_id long, score double, predicted int")
