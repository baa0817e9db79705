"""Missing steps of a simulation: where they are, and rows that fill them from both neighbours."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from tachyline.operators.lanes import SHORT, LongLane, ShortLane

Lane = ShortLane | LongLane
_NEXT = "__next_"


def _with_next(df: DataFrame, columns: list[str], lane: Lane) -> DataFrame:
    def following(w: WindowSpec) -> dict[str, Column]:
        return {_NEXT + name: F.lead(name).over(w) for name in columns}

    return lane.framed(df, following, after=1)


def step_gaps(df: DataFrame, lane: Lane = SHORT) -> DataFrame:
    """One row per run of missing steps between two rows; rows without a step bound no gap."""
    gap = F.col(_NEXT + "step") - F.col("step") - 1
    return _with_next(df.select("simulation_id", "step"), ["step"], lane).where(gap > 0).select(
        "simulation_id",
        (F.col("step") + 1).alias("first_missing"),
        (F.col(_NEXT + "step") - 1).alias("last_missing"),
        gap.cast("long").alias("missing_steps"),
    )


def filled_steps(df: DataFrame, columns: list[str], lane: Lane = SHORT) -> DataFrame:
    """Every step from the first to the last of a simulation, with ``is_filled`` for those added.

    The numbers in ``columns`` are taken from the straight line between both neighbours; where
    one of them is NULL, so is the filled value. Rows as given stay as they are, also repeated
    steps and rows without a step.
    """
    step, until = F.col("step"), F.greatest(F.col("step"), F.col(_NEXT + "step") - 1)
    place = F.explode(F.when(step.isNull(), F.array(step)).otherwise(F.sequence(step, F.coalesce(until, step)))).alias("__at")
    spread = _with_next(df.select("simulation_id", "step", *columns), ["step", *columns], lane).select("*", place)
    added = F.coalesce(F.col("__at") > step, F.lit(False))
    share = (F.col("__at") - step) / (F.col(_NEXT + "step") - step)

    def between(name: str) -> Column:
        value = F.col(name).cast("double")
        return F.when(added, value + (F.col(_NEXT + name) - value) * share).otherwise(value).alias(name)

    return spread.select("simulation_id", F.col("__at").alias("step"), *[between(name) for name in columns], added.alias("is_filled"))
