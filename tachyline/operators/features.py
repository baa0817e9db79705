"""Window features of the Gold table and of live serving.

Frames count rows, so the "ten seconds" stretch where bad rows were removed.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from tachyline.operators.lanes import SHORT, LongLane, ShortLane, row_count
from tachyline.operators.sliding import INDEX, sliding
from tachyline.schemas import (
    FEATURE_COLUMNS,
    LOOK_AHEAD_ROWS,
    SERVING_ROWS,
    WEAR_LAG_ROWS,
    WEAR_WINDOW_SECONDS,
)

Lane = ShortLane | LongLane


def wear_rates(df: DataFrame, lane: Lane = SHORT) -> DataFrame:
    """Adds ``wear_rate_10s`` over a lag of 100 rows and its mean over this row and the next 30.

    The look-ahead shrinks at the end of a simulation, so the mean is NULL only
    where no row in reach has a rate.
    """
    wear = F.col("engine_wear")
    return lane.framed(
        df,
        lambda w: {"wear_rate_10s": (wear - F.lag(wear, WEAR_LAG_ROWS).over(w)) / float(WEAR_WINDOW_SECONDS)},
        lambda w: {"future_wear_rate": F.avg("wear_rate_10s").over(w.rowsBetween(0, LOOK_AHEAD_ROWS))},
        before=WEAR_LAG_ROWS,
        after=LOOK_AHEAD_ROWS,
    )


def labelled_rows(df: DataFrame) -> DataFrame:
    """Rows that can be labelled; rolling features start over at the first of them."""
    return df.where(F.col("future_wear_rate").isNotNull())


def rolling_features(
    df: DataFrame,
    lane: Lane = SHORT,
    frame_rows: int = WEAR_LAG_ROWS + 1,
    min_rows: int = 1,
    load: Column | None = None,
) -> DataFrame:
    """Rolling statistics over the last ``frame_rows`` rows, this one included.

    With ``min_rows`` above one, rows with a shorter history are dropped.
    """
    rpm, used = F.col("engine_rpm"), F.col("load") if load is None else load
    made, over = sliding(df, {"rpm": rpm, "throttle": F.col("throttle"), "load": used}, frame_rows, lane)
    if min_rows > 1:
        made = made.where(F.col(INDEX) >= min_rows)
    features = {
        "rpm_avg_10s": over["rpm_mean"],
        "rpm_std_10s": over["rpm_stddev"],
        "throttle_avg_10s": over["throttle_mean"],
        "engine_load_avg_10s": over["load_mean"],
        "power_factor": rpm * used,
        "rpm_range_10s": over["rpm_max"] - over["rpm_min"],
        "load_max_10s": over["load_max"],
    }
    return made.select(*df.columns, *[column.alias(name) for name, column in features.items()])


def rolling_features_by_step(df: DataFrame, lane: Lane = SHORT, back: int = WEAR_LAG_ROWS) -> DataFrame:
    """The rolling statistics with frames by step distance instead of by rows.

    Steps are distinct, so such a frame has at most ``back + 1`` rows.
    """
    rpm = F.col("engine_rpm")

    def columns(w: WindowSpec) -> dict[str, Column]:
        frame = w.rangeBetween(-back, 0)
        return {
            "rpm_avg_10s": F.avg(rpm).over(frame),
            "rpm_std_10s": F.stddev(rpm).over(frame),
            "throttle_avg_10s": F.avg("throttle").over(frame),
            "engine_load_avg_10s": F.avg("load").over(frame),
            "power_factor": rpm * F.col("load"),
            "rpm_range_10s": F.max(rpm).over(frame) - F.min(rpm).over(frame),
            "load_max_10s": F.max("load").over(frame),
        }

    return lane.framed(df, columns, before=back)


def gold_features(df: DataFrame, lane: Lane = SHORT) -> DataFrame:
    """Wear rates, the filter on them, then the rolling features: the order is part of the result."""
    return rolling_features(lane.settle(labelled_rows(wear_rates(df, lane))), lane)


def serving_features(df: DataFrame, lane: Lane = SHORT, load: Column | None = None, rows: int = SERVING_ROWS) -> DataFrame:
    """Features over a full buffer of ``rows`` samples; shorter histories give no row."""
    return rolling_features(df, lane, frame_rows=rows, min_rows=rows, load=load).select(
        "simulation_id", "step", *FEATURE_COLUMNS
    )


def every_nth(df: DataFrame, n: int) -> DataFrame:
    return df.where(F.col("step") % n == 0)


def warmup_progress(df: DataFrame, lane: Lane = SHORT, rows: int = SERVING_ROWS) -> DataFrame:
    """Fill level of the serving buffer, in rows and in percent."""
    counted = lane.running(df, {"buffered": row_count()})
    filled = counted.withColumn("buffered", F.least(F.col("buffered"), F.lit(rows).cast("long")))
    return filled.withColumn("progress_pct", F.col("buffered") / rows * 100)
