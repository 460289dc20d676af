"""Keyed online scoring: one small state per device, kept for as long as the device sends."""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from decimal import Decimal
from itertools import chain, groupby

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from millrace.operators.scoring import ERROR_FACTOR, LARGEST_STEP, MILLIONTHS, millionths
from millrace.plans.sensors import drifting_readings_of, is_reading, readings_of, scored_drifting_messages, scored_messages
from millrace.session import SETTINGS

STORE = "spark.sql.streaming.stateStore.providerClass"

STATE = (
    "records bigint, value double, prediction double, predictionNext double, "
    "errors decimal(38,0), latest timestamp"
)
SCORES = "prediction double, error double, anomaly double, predictionNext double, late boolean"


def score_frame(readings: pd.DataFrame, state: tuple | None, alpha: float = 1.0) -> tuple[pd.DataFrame, tuple]:
    """Scores for one device's readings in order, and the state after them.

    `alpha` weighs the newest value in the forecast; 1 forecasts the last value.
    """
    records, value, prediction, forecast, errors, latest = state or (0, 0.0, 0.0, 0.0, Decimal(0), None)
    values = readings["value"].to_numpy(dtype=float)
    count = len(values)

    if alpha == 1.0:
        forecasts = values
    else:
        seed = [forecast] if records else []
        smoothed = pd.Series(np.concatenate([seed, values])).ewm(alpha=alpha, adjust=False).mean()
        forecasts = smoothed.to_numpy()[len(seed):]
    predictions = np.concatenate([[forecast], forecasts[:-1]])

    numbers = records + np.arange(count)
    misses = np.abs(np.concatenate([[prediction], predictions[:-1]]) - np.concatenate([[value], values[:-1]]))
    error = np.where(numbers >= 2, misses, 0.0)

    whole = np.floor(np.minimum(error * MILLIONTHS + 0.5, LARGEST_STEP)).astype(np.int64)
    if float(whole.max()) * count >= LARGEST_STEP:
        whole = whole.astype(object)  # the sum needs wider integers
    before = np.concatenate([[0], np.cumsum(whole)[:-1]])
    earlier_sum = (before.astype(object) + int(errors)).astype(float)
    earlier_count = np.maximum(numbers - 2, 0)
    with np.errstate(divide="ignore", invalid="ignore"):
        mean = earlier_sum / MILLIONTHS / earlier_count
        ratio = np.minimum(1.0, error / (ERROR_FACTOR * mean))
    # A mean of equal values may differ from them in its last bit, which is no error.
    wrong = error > 0 if alpha == 1.0 else whole > 0
    anomaly = np.where(earlier_count < 1, 0.0, np.where(earlier_sum == 0, np.where(wrong, 1.0, 0.0), ratio))

    times = readings["ts"].to_numpy()
    newest = times.max() if latest is None else max(times.max(), np.datetime64(latest))
    late = np.zeros(count, dtype=bool) if latest is None else times < np.datetime64(latest)
    # One frame from arrays that are not copied: adding columns one by one costs more than all the arithmetic above.
    known = {name: readings[name].array for name in readings.columns}
    scores = {"prediction": predictions, "error": error, "anomaly": anomaly, "predictionNext": forecasts, "late": late}
    scored = pd.DataFrame({**known, **scores}, copy=False)
    after = (
        int(records + count),
        float(values[-1]),
        float(predictions[-1]),
        float(forecasts[-1]),
        Decimal(int(errors) + int(whole.sum())),
        pd.Timestamp(newest).to_pydatetime(),
    )
    return scored, after


def in_order(batch: pd.DataFrame) -> pd.DataFrame:
    """One device's readings by time and then by position in the feed."""
    order = np.lexsort((batch["seq"].to_numpy(), batch["ts"].to_numpy()))
    return batch if (order[1:] > order[:-1]).all() else batch.iloc[order]


class Scorer(StatefulProcessor):
    """One value per device for ever; the rows of a trigger pass through in batches.

    A device that sends one batch is scored at once. The batches of a busier one are put aside by hour in the state store, and
    scored hour by hour, so that a task holds an hour of a device and no whole trigger.
    """

    def __init__(self, alpha: float):
        self.alpha = alpha

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.score = handle.getValueState("score", STATE)
        self.aside = handle.getMapState("aside", "hour bigint, part int", "rows binary")

    def _scored(self, rows: pd.DataFrame, state: tuple | None) -> tuple[pd.DataFrame, tuple]:
        return score_frame(in_order(rows), state, self.alpha)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        state = self.score.get()  # None for a new device; asking whether it exists would be one more call to the JVM
        first, second = next(rows), next(rows, None)
        if second is None:
            scored, state = self._scored(first, state)
            yield scored
        else:
            hours = set()
            for part, frame in enumerate(chain((first, second), rows)):
                for hour, some in frame.groupby(frame["ts"].astype("datetime64[s]").astype("int64") // 3600):
                    self.aside.updateValue((int(hour), part), (pickle.dumps(some),))
                    hours.add((int(hour), part))
            for _, parts in groupby(sorted(hours), key=lambda place: place[0]):
                places = list(parts)
                frame = pd.concat([pickle.loads(self.aside.getValue(place)[0]) for place in places], ignore_index=True)
                scored, state = self._scored(frame, state)
                for place in places:
                    self.aside.removeKey(place)
                yield scored
        self.score.update(state)

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        names = [field.split()[0] for field in STATE.split(", ")]
        records, value, prediction, forecast, errors, latest = (initialState[name].iloc[0] for name in names)
        moment = pd.Timestamp(latest).to_pydatetime()
        self.score.update((int(records), float(value), float(prediction), float(forecast), Decimal(int(errors)), moment))

    def close(self) -> None:
        pass


def score_stream(readings: DataFrame, alpha: float = 1.0, state: DataFrame | None = None) -> DataFrame:
    """A stream with `device_id`, `ts`, `seq` and `value`, plus the scores; other columns come along.

    A micro-batch is put in order of (ts, seq) per device; what the source reads per trigger
    bounds it. A reading older than one already scored is scored as it comes and marked `late`.
    The state of a device is six numbers, and is kept for ever. `state` (device_id and those numbers, as `state_after` gives them)
    is where devices go on from at the first start. States need the RocksDB store, which the session is set to.
    """
    readings.sparkSession.conf.set(STORE, SETTINGS[STORE])
    output = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in readings.schema.fields) + ", " + SCORES
    return readings.where(is_reading()).groupBy("device_id").transformWithStateInPandas(
        Scorer(alpha), output, "append", "none", state.groupBy("device_id") if state is not None else None
    )


def state_after(scored: DataFrame) -> DataFrame:
    """device_id and the state that a stream has after the scored rows (`score_history`'s), to go on from there."""
    last = F.struct("ts", "seq")
    return scored.groupBy("device_id").agg(
        F.count("*").alias("records"),
        *(F.max_by(name, last).alias(name) for name in ("value", "prediction", "predictionNext")),
        F.sum(millionths(F.col("error"))).cast("decimal(38,0)").alias("errors"),
        F.max("ts").cast("timestamp").alias("latest"),
    )


def stored_state(spark: SparkSession, checkpoint: str) -> DataFrame:
    """device_id and state of every device, as the last finished trigger of a query left them in its checkpoint."""
    rows = spark.read.format("statestore").option("stateVarName", "score").load(checkpoint)
    return rows.select("key.device_id", "value.*")


def score_message_stream(messages: DataFrame, alpha: float = 1.0, state: DataFrame | None = None, drifting: bool = False) -> DataFrame:
    """Messages in, enriched messages out, under the same keys; `late` marks those older than one scored before.

    Rows of a device must arrive in time order from trigger to trigger for the scores to be those of the batch. What cannot be
    scored is in `rejected_messages`, a stream of its own. With `drifting`, messages may have any further fields, which they keep.
    """
    if drifting:
        return scored_drifting_messages(score_stream(drifting_readings_of(messages), alpha, state))
    return scored_messages(score_stream(readings_of(messages), alpha, state))
