"""Per-session statistics: running means, smoothing, history, latest state, state machines."""

from math import ceil, log

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from tachyline.functions import driving
from tachyline.operators.features import Lane
from tachyline.operators.lanes import SHORT, Within, last_known, row_count, running_sum
from tachyline.schemas import SERVING_ROWS

# Smoothing weight, fan limits, shortest tick.
SMOOTHING = 0.3
FAN_ON_TEMP = 102.0
FAN_OFF_TEMP = 96.0
SHORTEST_TICK = 1e-4

_WHOLE = (Window.unboundedPreceding, Window.unboundedFollowing)


def session_summary(df: DataFrame) -> DataFrame:
    """Ticks, mean speed and fuel rate, and the last wear of each simulation."""
    return df.groupBy("simulation_id").agg(
        F.count(F.lit(1)).alias("session_ticks"),
        F.avg(F.coalesce("speed_kmh", F.lit(0.0))).alias("avg_speed_kmh"),
        F.avg(F.coalesce("fuel_rate_lph", F.lit(0.0))).alias("avg_fuel_lph"),
        F.max_by("engine_wear", "step").alias("total_wear"),
    )


def running_means(df: DataFrame, names: dict[str, str], lane: Lane = SHORT) -> DataFrame:
    """``names`` maps an input column to its cumulative mean; a missing value counts as zero."""
    sums = {f"__sum_{name}": running_sum(F.coalesce(name, F.lit(0.0))) for name in names}
    summed = lane.running(df, {"session_ticks": row_count(), **sums})
    means = {out: F.col(f"__sum_{name}") / F.col("session_ticks") for name, out in names.items()}
    return summed.withColumns(means).drop(*sums)


def smoothed(
    df: DataFrame,
    value: Column,
    name: str,
    lane: Lane = SHORT,
    weight: float = SMOOTHING,
    initial: float | Column = 0.0,
) -> DataFrame:
    """First-order lag ``y = (1 - weight) * y + weight * x`` from ``initial``, without a loop.

    ``initial`` may be a column that is the same in all rows of a simulation: what an earlier
    session ended with.

    Rows are taken in chunks of such a length that a value decays by 1e-9 over
    one. A running sum with growing weights gives the part from the row's own
    chunk; the totals of the chunks before it add the rest. Three of them reach
    1e-27, far below the precision of a double.
    """
    keep = 1.0 - weight
    chunk = max(1, ceil(log(1e-9) / log(keep)))
    faded = keep**chunk
    counted = lane.running(df, {"__n": row_count()})
    placed = (
        counted.withColumn("__place", F.pmod(F.col("__n") - 1, F.lit(chunk)))
        .withColumn("__chunk", F.floor((F.col("__n") - 1) / chunk))
        .withColumn("__x", value * weight / F.pow(F.lit(keep), F.col("__place")))
    )

    def sums(w: WindowSpec) -> dict[str, Column]:
        ordered = w.orderBy("__n")
        return {
            "__mine": F.sum("__x").over(ordered),
            "__total": F.sum("__x").over(ordered.rowsBetween(*_WHOLE)) * keep ** (chunk - 1),
        }

    def earlier(w: WindowSpec) -> dict[str, Column]:
        reach = [F.coalesce(F.lag("__total", chunk * i).over(w), F.lit(0.0)) * faded ** (i - 1) for i in (1, 2, 3)]
        return {"__earlier": reach[0] + reach[1] + reach[2]}

    carried = lane.framed(
        placed,
        Within("__chunk", sums),
        earlier,
        before=3 * chunk,
        # Orders the rows like the step, in the sort order of the sums.
        order=("__chunk", "__n"),
        index="__n",
        part_rows=chunk,
    )
    result = (
        F.coalesce("__mine", F.lit(0.0)) * F.pow(F.lit(keep), F.col("__place"))
        + F.col("__earlier") * F.pow(F.lit(keep), F.col("__place") + 1)
        + F.pow(F.lit(keep), F.col("__n")) * initial
    )
    helpers = ["__n", "__place", "__chunk", "__x", "__mine", "__total", "__earlier"]
    return carried.withColumn(name, result).drop(*helpers)


def last_samples(df: DataFrame, rows: int = SERVING_ROWS) -> DataFrame:
    """The newest ``rows`` rows of each session; Spark limits each group before the shuffle too."""
    newest = Window.partitionBy("simulation_id").orderBy(F.desc("step"))
    return df.withColumn("__rank", F.row_number().over(newest)).where(F.col("__rank") <= rows).drop("__rank")


def history(df: DataFrame, rows: int = SERVING_ROWS) -> DataFrame:
    """Chart history of each session, with defaults for missing fields."""
    return last_samples(df, rows).select(
        "simulation_id",
        "step",
        F.coalesce("simulation_time", F.lit(0.0)).alias("t"),
        F.coalesce("engine_rpm", F.lit(0.0)).alias("rpm"),
        F.coalesce("current_gear", F.lit(0)).alias("gear"),
        F.coalesce("speed_kmh", F.lit(0.0)).alias("speed_kmh"),
    )


def latest_state(df: DataFrame) -> DataFrame:
    """The row with the highest step of each session.

    One ``max_by`` per column instead of one over a struct: numbers fit the buffer of
    a hash aggregate, a struct would make Spark sort its input.
    """
    newest = [F.max_by(name, "step").alias(name) for name in df.columns if name != "simulation_id"]
    return df.groupBy("simulation_id").agg(*newest).select(*df.columns)


def throttle_rate(df: DataFrame, lane: Lane = SHORT) -> DataFrame:
    """Change of the throttle per second since the previous row; NULL on the first."""

    def rate(w: WindowSpec) -> dict[str, Column]:
        moved = F.col("throttle") - F.lag("throttle").over(w)
        passed = F.col("simulation_time") - F.lag("simulation_time").over(w)
        # Without both times there is no rate; ``greatest`` alone would skip a missing one.
        return {"throttle_change_rate": F.when(passed.isNotNull(), moved / F.greatest(passed, F.lit(SHORTEST_TICK)))}

    return lane.framed(df, rate, before=1)


def fan_state(df: DataFrame, lane: Lane = SHORT, on: float = FAN_ON_TEMP, off: float = FAN_OFF_TEMP) -> DataFrame:
    """Hysteresis: on above one limit, off below the other, otherwise as before; off at first."""
    temp = F.col("coolant_temp_c")
    signal = F.when(temp > on, F.lit(True)).when(temp < off, F.lit(False))
    held = lane.running(df, {"fan_active": last_known(signal)})
    return held.withColumn("fan_active", F.coalesce("fan_active", F.lit(False)))


def held_controls(df: DataFrame, lane: Lane = SHORT, order: tuple[str, ...] = ("step",)) -> DataFrame:
    """Pedal and brake targets after each command; one that is not given stays as it was."""
    named = {"pedal_target": last_known(F.col("pedal")), "brake_target": last_known(F.col("brake"))}
    return lane.running(df, named, order)


def gear_changes(df: DataFrame, lane: Lane = SHORT) -> DataFrame:
    """Adds the gear before, whether this row shifts, and the number of shifts so far."""

    def shifted(w: WindowSpec) -> dict[str, Column]:
        before = F.lag("current_gear").over(w)
        return {
            "previous_gear": before,
            "is_shift": F.coalesce(F.col("current_gear") != before, F.lit(False)),
        }

    marked = lane.settle(lane.framed(df, shifted, before=1))
    return lane.running(marked, {"shift_count": running_sum(F.col("is_shift").cast("long"))})


def shift_events(df: DataFrame, lane: Lane = SHORT) -> DataFrame:
    return gear_changes(df, lane).where("is_shift").select(
        "simulation_id", "step", "previous_gear", "current_gear", "shift_count"
    )


def gear_dwell(df: DataFrame, lane: Lane = SHORT) -> DataFrame:
    """Every stay in one gear: its first step and its number of rows."""
    return (
        gear_changes(df, lane)
        .groupBy("simulation_id", "shift_count")
        .agg(
            F.min_by("current_gear", "step").alias("current_gear"),
            F.min("step").alias("first_step"),
            F.count(F.lit(1)).alias("dwell_rows"),
        )
    )


DAY_MICROS = 86_400_000_000


def trips(df: DataFrame, pause_seconds: float, lane: Lane = SHORT) -> DataFrame:
    """Trips of each simulation: samples with less than the pause between neighbours.

    ``df`` has ``at`` (microseconds) and ``value``; samples without a time belong to no trip.
    ``trip`` counts from 1. A simulation of any length is cut into blocks, unlike session windows.
    """
    pause = int(pause_seconds * 1e6)

    def starts(w: WindowSpec) -> dict[str, Column]:
        return {"starts": F.coalesce(F.col("at") - F.lag("at").over(w) >= pause, F.lit(True))}

    timed = df.where(F.col("at").isNotNull()).select("simulation_id", "at", "value")
    numbered = lane.settle(lane.running(timed, {"place": row_count()}, order=("at", "value"), block_rows=DAY_MICROS))
    marked = lane.settle(lane.framed(numbered, starts, before=1, order=("place",), index="place"))
    placed = lane.running(marked, {"trip": running_sum(F.col("starts").cast("long"))}, order=("place",))
    ends = [F.timestamp_micros(F.min("at")).alias("started"), F.timestamp_micros(F.max("at")).alias("ended")]
    return placed.groupBy("simulation_id", "trip").agg(*ends, F.count(F.lit(1)).alias("samples"), F.max("value").alias("most"))


def zone_time(df: DataFrame, redline: float = driving.REDLINE_RPM, tick: float = 0.1) -> DataFrame:
    """Rows and seconds each session spends in every gauge zone."""
    zone = driving.rpm_zone(F.col("engine_rpm"), redline)
    counted = df.groupBy("simulation_id", zone.alias("zone")).agg(F.count(F.lit(1)).alias("zone_rows"))
    return counted.withColumn("zone_seconds", F.col("zone_rows") * tick)


def live_scores(df: DataFrame, score: Column, lane: Lane = SHORT) -> DataFrame:
    """Coaching output per prediction row: smoothed score, tier, risk and text."""
    shown = smoothed(df.withColumn("score", score), F.col("score"), "display_score", lane)
    return shown.withColumns(driving.coaching(F.col("score")))
