"""Forecast, lagged error and anomaly score per device, over a whole history.

Per device, records numbered from 0 in order of (ts, seq):

    predictionNext(n) = value(n), or an exponential mean of the values
    prediction(n)     = predictionNext(n-1), 0 for the first record
    error(n)          = |prediction(n-1) - value(n-1)| for n >= 2, else 0
    anomaly(n)        = least(1, error(n) / (3 * mean of error(2..n-1))), 0 without such errors,
                        1 when all of them are 0 and error(n) is not

The mean is a running sum over the device, which a plain window would compute in one task per
device. Here a device is cut into time chunks: steps within a chunk come from a window over
(device, chunk), what earlier chunks carry over comes from one summary row per chunk, and a
join on (device, chunk) puts the two together. Errors are summed as whole millionths, so the
result does not depend on how the history was cut.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.smoothing import with_exponential_mean

MILLIONTHS = 1_000_000.0
ERROR_FACTOR = 3.0
#: Most millionths of one step; larger steps count as this many, in the stream too.
LARGEST_STEP = 9e18


def millionths(step: Column) -> Column:
    """A distance as a whole number of millionths, wide enough to be summed."""
    whole = step * MILLIONTHS + 0.5
    return F.floor(F.when(whole >= LARGEST_STEP, LARGEST_STEP).otherwise(whole)).cast("decimal(20,0)")


def finite(value: Column) -> Column:
    """Whether a value can be scored: null, not-a-number and infinity cannot."""
    return F.coalesce(~F.isnan(value) & (F.abs(value) < float("inf")), F.lit(False))


def anomaly_score(error: Column, earlier_sum: Column, earlier_count: Column, is_error: Column | None = None) -> Column:
    mean = earlier_sum.cast("double") / MILLIONTHS / earlier_count
    ratio = F.least(F.lit(1.0), error / (F.lit(ERROR_FACTOR) * F.nullif(mean, F.lit(0.0))))
    perfect_so_far = F.when(error > 0 if is_error is None else is_error, 1.0).otherwise(0.0)
    return F.when(earlier_count < 1, 0.0).when(earlier_sum == 0, perfect_so_far).otherwise(ratio)


def score_history(readings: DataFrame, chunk: str = "hour", alpha: float = 1.0) -> DataFrame:
    """Scores for rows with `device_id`, `ts`, `seq` and `value`; other columns come along.

    Rows without a device, time or finite value are left out. `chunk` is the unit of `date_trunc` that bounds
    how much of one device a single task holds. With an `alpha` below 1 the forecast is the exponential mean
    alpha * value(n) + (1 - alpha) * predictionNext(n-1), which begins with the first value.
    """
    usable = readings.where(F.col("device_id").isNotNull() & finite(F.col("value")))
    placed = usable.withColumn("_chunk", F.date_trunc(chunk, "ts")).where("_chunk is not null")
    inside = Window.partitionBy("device_id", "_chunk").orderBy("ts", "seq")
    if alpha != 1.0:
        return _smoothed_history(placed, inside, alpha).select(*readings.columns, "prediction", "error", "anomaly", "predictionNext")
    two_back = inside.rowsBetween(Window.unboundedPreceding, -2)
    rows = (
        placed.withColumns(
            {
                "_n": F.row_number().over(inside),
                "_one_back": F.lag("value", 1).over(inside),
                "_two_back": F.lag("value", 2).over(inside),
            }
        )
        .withColumn("_step", millionths(F.abs(F.col("value") - F.col("_one_back"))))
        .withColumn("_steps_two_back", F.sum("_step").over(two_back))
    )

    summary = rows.groupBy("device_id", "_chunk").agg(
        F.max("_n").alias("_rows"),
        F.min_by("value", "_n").alias("_first"),
        F.max_by("value", "_n").alias("_last"),
        F.max_by("_one_back", "_n").alias("_before_last"),
        F.sum("_step").alias("_steps"),
    )
    across = Window.partitionBy("device_id").orderBy("_chunk")
    earlier = across.rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("decimal(20,0)")
    carried = (
        summary.withColumn("_last_so_far", F.lag("_last").over(across))
        .withColumn("_gap", F.coalesce(millionths(F.abs(F.col("_first") - F.col("_last_so_far"))), zero))
        .withColumn("_before", F.when(F.col("_rows") > 1, F.col("_before_last")).otherwise(F.col("_last_so_far")))
        .withColumns(
            {
                "_rows_so_far": F.coalesce(F.sum("_rows").over(earlier), F.lit(0)),
                "_steps_so_far": F.coalesce(F.sum(F.col("_gap") + F.coalesce("_steps", zero)).over(earlier), zero),
                "_before_so_far": F.lag("_before").over(across),
            }
        )
        .select("device_id", "_chunk", "_rows_so_far", "_steps_so_far", "_last_so_far", "_before_so_far", "_gap")
    )

    n, position = F.col("_n"), F.col("_rows_so_far") + F.col("_n")
    previous = F.when(n >= 2, F.col("_one_back")).otherwise(F.col("_last_so_far"))
    one_before = (
        F.when(n >= 3, F.col("_two_back")).when(n == 2, F.col("_last_so_far")).otherwise(F.col("_before_so_far"))
    )
    earlier_sum = (
        F.when(n >= 3, F.col("_steps_so_far") + F.col("_gap") + F.coalesce("_steps_two_back", zero))
        .when(n == 2, F.col("_steps_so_far"))
        .otherwise(
            F.col("_steps_so_far") - millionths(F.abs(F.col("_last_so_far") - F.col("_before_so_far")))
        )
    )
    error = F.when(position >= 3, F.abs(one_before - previous)).otherwise(0.0)
    return rows.join(carried, ["device_id", "_chunk"]).select(
        *readings.columns,
        F.coalesce(previous, F.lit(0.0)).alias("prediction"),
        error.alias("error"),
        anomaly_score(error, earlier_sum, position - 3).alias("anomaly"),
        F.col("value").alias("predictionNext"),
    )


def _smoothed_history(placed: DataFrame, inside, alpha: float) -> DataFrame:
    """The scores of an exponential mean. Its misses depend on the mean, so their sums are carried from chunk to chunk after it."""
    numbered = placed.withColumn("_n", F.row_number().over(inside))
    rows = with_exponential_mean(numbered, alpha, "device_id", "_chunk", "_n", "value", "predictionNext")
    across = Window.partitionBy("device_id").orderBy("_chunk")
    earlier = across.rowsBetween(Window.unboundedPreceding, -1)
    counts = numbered.groupBy("device_id", "_chunk").agg(F.count("*").alias("_rows"))
    counts = counts.withColumn("_rows_so_far", F.coalesce(F.sum("_rows").over(earlier), F.lit(0))).drop("_rows")
    rows = rows.join(counts, ["device_id", "_chunk"]).withColumn("_position", F.col("_rows_so_far") + F.col("_n"))
    rows = rows.withColumn("prediction", F.when(F.col("_position") == 1, 0.0).otherwise(F.col("predictionNext_before")))

    # The miss of a row is the error of the next one; that of the first row of a device counts nowhere.
    zero = F.lit(0).cast("decimal(20,0)")
    rows = rows.withColumn("_miss", F.abs(F.col("prediction") - F.col("value")))
    rows = rows.withColumn("_step", F.when(F.col("_position") > 1, millionths(F.col("_miss"))).otherwise(zero))
    rows = rows.withColumns(
        {
            "_miss_before": F.lag("_miss").over(inside),
            "_step_before": F.lag("_step").over(inside),
            "_steps": F.sum("_step").over(inside.rowsBetween(Window.unboundedPreceding, -1)),
        }
    )
    ends = rows.groupBy("device_id", "_chunk").agg(
        F.sum("_step").alias("_total"), F.max_by("_miss", "_n").alias("_last_miss"), F.max_by("_step", "_n").alias("_last_step")
    )
    ends = ends.select(
        "device_id",
        "_chunk",
        F.coalesce(F.sum("_total").over(earlier), zero).alias("_steps_so_far"),
        F.lag("_last_miss").over(across).alias("_miss_so_far"),
        F.lag("_last_step").over(across).alias("_step_so_far"),
    )
    known = rows.join(ends, ["device_id", "_chunk"])
    position = F.col("_position")
    error = F.when(position >= 3, F.coalesce("_miss_before", "_miss_so_far")).otherwise(0.0)
    # What came before the row, less the miss that is its own error.
    own_step = F.coalesce("_step_before", "_step_so_far", zero)
    earlier_sum = F.col("_steps_so_far") + F.coalesce("_steps", zero) - own_step
    # A mean of equal values may differ from them in its last bit, which is no error.
    return known.withColumn("error", error).withColumn("anomaly", anomaly_score(error, earlier_sum, position - 3, own_step > 0))
