"""Every registered query against its SQL, and window queries through the block-wise lane too."""

import os

import __spark_entry__ as contract
import pytest
from conftest import SF
from pyspark.sql import functions as F

from checks import oracle
from checks.compare import connect, differences
from checks.queries import QUERIES
from tachyline.session import scratch_dir, settings

ORACLES = oracle.oracle_sql()
WINDOWED = [
    "future_wear_rate",
    "rolling_features",
    "gold_features",
    "serving_features_300",
    "session_running_avg",
    "score_ema",
    "slow_ema",
    "throttle_rate",
    "fan_hysteresis",
    "gear_dwell",
    "last_300_history",
]


@pytest.fixture(scope="module")
def connection():
    return connect(SF)


def test_every_query_has_an_oracle():
    assert set(ORACLES) == set(QUERIES) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, connection, name):
    assert differences(QUERIES[name](spark, SF), connection, ORACLES[name]) is None


@pytest.mark.parametrize("name", WINDOWED)
def test_long_simulations_give_the_same(spark, connection, name):
    with settings(spark, spark__tachyline__longKeyRows="590", spark__tachyline__blockRows="320"):
        made = QUERIES[name](spark, SF)
        assert differences(made, connection, ORACLES[name]) is None


def test_entry_is_the_label_distribution(spark):
    rows = {row["driving_style"]: row["label_rows"] for row in contract.entry(spark).collect()}
    assert rows == {"AGGRESSIVE": 1283, "NORMAL": 5132 - 1283}


def test_inputs_of_streams_leave_one_copy(spark, tmp_path):
    """Held tables go when the files of the stream are written, and texts are made after the rows have been dealt."""
    from checks import queries

    rows = spark.range(200).select(F.col("id").cast("int").alias("step"), F.lit("x").alias("text"))
    before = set(os.listdir(scratch_dir(spark)))
    streams_ = [queries.by_step(rows, "kept-by-step"), queries.as_stream(rows, "kept-dealt", lambda df: df.withColumn("text", F.lit("y")))]
    new = sorted(set(os.listdir(scratch_dir(spark))) - before)
    assert [name.rsplit("-", 1)[0] for name in new] == ["kept-by-step", "kept-dealt"]
    assert all(stream.isStreaming for stream in streams_)
    read = [spark.read.parquet(f"{scratch_dir(spark)}/{name}") for name in new]
    assert [df.count() for df in read] == [200, 200]
    assert [df.select("text").distinct().first()[0] for df in read] == ["x", "y"]
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "false") == "false"
