import re

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tachyline.operators.lanes import KEY, SHORT, Lanes, LongLane, last_known, long_keys, row_count, running_sum, spread
from tachyline.operators.sliding import sliding
from tachyline.session import settings


def series(spark, seed, sizes=(1, 7, 40, 333), missing=0.2):
    """Simulations of given sizes, with gaps between steps and missing values."""
    rng = np.random.default_rng(seed)
    parts = []
    for name, size in enumerate(sizes):
        steps = np.sort(rng.choice(size * 5 + 1, size, replace=False))
        values = rng.normal(1000, 300, size)
        values[rng.random(size) < missing] = np.nan
        parts.append(pd.DataFrame({"simulation_id": f"s{name}", "step": steps.astype("int32"), "x": values}))
    frame = pd.concat(parts).sample(frac=1, random_state=seed)
    return spark.createDataFrame(frame).withColumn("x", F.nanvl("x", F.lit(None).cast("double")))


def ordered(df):
    return df.toPandas().sort_values(["simulation_id", "step"], ignore_index=True)


def same(left, right):
    pd.testing.assert_frame_equal(ordered(left), ordered(right), rtol=1e-11, atol=1e-9, check_dtype=False)


@pytest.mark.parametrize("block", [3, 16, 1000])
def test_running_values_in_blocks(spark, block):
    df = series(spark, block)
    specs = {
        "n": row_count(),
        "total": running_sum(F.col("x")),
        "known": last_known(F.when(F.col("x") > 1100, 1).when(F.col("x") < 900, 0)),
    }
    same(LongLane(block).running(df, specs), SHORT.running(df, specs))


@pytest.mark.parametrize("block", [5, 12, 64])
def test_frames_in_blocks(spark, block):
    df = series(spark, block)
    stages = (
        lambda w: {"change": F.col("x") - F.lag("x", 4).over(w)},
        lambda w: {"ahead": F.avg("change").over(w.rowsBetween(0, 3))},
    )
    same(LongLane(block).framed(df, *stages, before=4, after=3), SHORT.framed(df, *stages, before=4, after=3))


def test_a_frame_longer_than_a_block_widens_the_block(spark):
    df = series(spark, 1)

    def stage(w):
        return {"highest": F.max("x").over(w.rowsBetween(-30, 0))}

    same(LongLane(4).framed(df, stage, before=30), SHORT.framed(df, stage, before=30))


@pytest.mark.parametrize("lane", [SHORT, LongLane(32)])
@pytest.mark.parametrize("rows", [1, 2, 11])
def test_sliding_statistics_equal_plain_frames(spark, lane, rows):
    df = series(spark, rows, missing=0.4)
    made, over = sliding(df, {"x": F.col("x")}, rows, lane)
    got = made.select("simulation_id", "step", *[column.alias(name) for name, column in over.items()])
    frame = Window.partitionBy("simulation_id").orderBy("step").rowsBetween(-(rows - 1), 0)
    want = df.select(
        "simulation_id",
        "step",
        F.avg("x").over(frame).alias("x_mean"),
        F.stddev("x").over(frame).alias("x_stddev"),
        F.max("x").over(frame).alias("x_max"),
        F.min("x").over(frame).alias("x_min"),
    )
    same(got, want)


def test_a_constant_signal_has_no_deviation(spark):
    df = spark.range(500).select(F.lit("a").alias("simulation_id"), F.col("id").cast("int").alias("step"), F.lit(6500.1).alias("x"))
    made, over = sliding(df, {"x": F.col("x")}, 101)
    assert made.agg(F.max(over["x_stddev"])).first()[0] < 1e-6


def test_lanes_divide_by_length(spark):
    df = series(spark, 3)
    lanes = Lanes.of(df, long_rows=30, block_rows=8)
    assert [part.select("simulation_id").distinct().count() for part, _ in lanes.parts] == [2, 2]
    assert lanes.union().count() == df.count()
    assert len(Lanes.of(df, long_rows=10_000).parts) == 1


def test_more_long_keys_than_are_listed_stay_a_frame(spark):
    df = series(spark, 4)
    for at_most in (1, 100):
        keys = long_keys(df, KEY, 5, at_most)
        assert sorted(row[0] for row in keys.collect()) == ["s1", "s2", "s3"]
        assert df.join(keys, KEY, "left_semi").count() == 7 + 40 + 333
    assert long_keys(df, KEY, 1000) is None


def test_one_simulation_with_a_third_of_all_rows(spark):
    long = spark.range(30_000).select(F.lit("long").alias("simulation_id"), F.col("id").cast("int").alias("step"))
    short = spark.range(60_000).select(
        F.concat(F.lit("s"), F.floor(F.col("id") / 600)).alias("simulation_id"), (F.col("id") % 600).cast("int").alias("step")
    )
    df = long.unionByName(short).withColumn("x", (F.col("step") % 17).cast("double"))
    lanes = Lanes.of(df, long_rows=10_000, block_rows=1_000)
    assert len(lanes.parts) == 2

    def step(part, lane):
        counted = lane.running(part, {"n": row_count(), "total": running_sum(F.col("x"))})
        return lane.framed(counted, lambda w: {"before": F.lag("x", 100).over(w)}, before=100)

    same(lanes.map(step).union(), step(df, SHORT))
    spread = lanes.parts[1][0].transform(lambda part: LongLane(1_000).running(part, {"n": row_count()}))
    plan = spread._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"hashpartitioning\(simulation_id#\d+, __block#", plan)


@pytest.mark.parametrize("block", [3, 16])
def test_missing_steps_and_keys_are_kept_in_the_long_lane(spark, block):
    """A row without a step comes first; rows without a simulation are one."""
    df = series(spark, block, sizes=(40,)).unionByName(series(spark, 5, sizes=(25,)).withColumn("simulation_id", F.lit(None).cast("string")))
    first = spark.createDataFrame([("s0", None, 5.0), (None, None, 7.0)], df.schema)
    df = df.unionByName(first)
    specs = {"n": row_count(), "total": running_sum(F.col("x")), "known": last_known(F.col("x"))}
    same(LongLane(block).running(df, specs), SHORT.running(df, specs))

    def change(w):
        return {"before": F.lag("x", 2).over(w)}

    same(LongLane(block).framed(df, change, before=2), SHORT.framed(df, change, before=2))
    lanes = Lanes.of(df, long_rows=20, block_rows=block)
    assert [part.count() for part, _ in lanes.parts] == [0, 67]


def test_running_values_take_one_exchange_of_the_rows(spark):
    """The totals per block have an exchange or two of their own; the rows have one, for the join and the window."""
    df = series(spark, 2)
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false"):
        plan = LongLane(16).running(df, {"n": row_count()})._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"Exchange hashpartitioning\(__place_in_order#", plan)) == 2
    assert not re.search(r"Exchange hashpartitioning\(coalesce", plan)
    assert plan.index("Window") < plan.index("Exchange") and "Exchange" not in plan[: plan.index("SortMergeJoin")]


def test_more_rows_are_spread_over_more_tasks(spark):
    df = series(spark, 6)
    assert spread(df, KEY, 381, 1_000) is df
    wide = spread(df, KEY, 381, 10)
    assert wide.rdd.getNumPartitions() == 39
    plan = SHORT.running(wide, {"n": row_count()})._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
