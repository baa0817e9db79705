"""Recorded telemetry as a view over an order-line table.

Each supplier plays one simulation; its order lines, in order, are the steps. The
divisors are powers of two, so running sums of wear are exact in any order.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tachyline.operators.lanes import Lanes, row_count, running_sum
from tachyline.schemas import SILVER_COLUMNS

LINE_ORDER = ("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate")
ORDERS_PER_BLOCK = 1 << 18
_SOURCE = [
    "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    *LINE_ORDER,
]


def _double(value: float):
    return F.lit(float(value))


def _signals() -> dict:
    quantity, price = F.col("l_quantity"), F.col("l_extendedprice")
    return {
        "engine_rpm": F.when(F.col("l_partkey") % 101 == 0, _double(-1))
        .when(F.col("l_partkey") % 103 == 0, F.lit(None).cast("double"))
        .otherwise(price / 16),
        "speed_kmh": quantity * 4,
        "load": quantity / 64,
        "throttle": F.when(F.col("l_orderkey") % 109 != 0, F.col("l_discount") * 10),
        "brake": F.col("l_tax") * 10,
        "throttle_rate": F.col("l_discount") - F.col("l_tax"),
        "current_gear": F.col("l_linenumber").cast("int"),
        "coolant_temp_c": F.when(F.col("l_partkey") % 107 == 0, _double(300)).otherwise(20 + quantity * 1.5),
        "oil_temp_c": 15 + quantity * 2.25,
        "gearbox_wear": _double(0),
        "fuel_rate_lph": price / 2048,
        "pedal": F.col("l_discount") * 10,
    }


def telemetry(spark: SparkSession, directory: str, extended: bool = False) -> Lanes:
    """Silver-shaped rows (without the ingest time), divided into lanes."""
    lines = spark.read.parquet(f"{directory}/lineitem.parquet").select(*dict.fromkeys(_SOURCE))
    named = lines.withColumn("simulation_id", F.col("l_suppkey").cast("string")).drop("l_suppkey")
    columns = SILVER_COLUMNS + (["fuel_rate_lph", "pedal"] if extended else [])

    def steps(df: DataFrame, lane) -> DataFrame:
        counted = lane.running(
            df,
            {"seq": row_count(), "engine_wear": running_sum(F.col("l_quantity") / 65536)},
            order=LINE_ORDER,
            block_rows=min(ORDERS_PER_BLOCK, getattr(lane, "block_rows", ORDERS_PER_BLOCK)),
        )
        step = (F.col("seq") - 1).cast("int")
        shaped = (
            counted.withColumn("step", step)
            .withColumn("simulation_time", F.col("step") * F.lit(0.1))
            .withColumns(_signals())
        )
        return lane.settle(shaped.select(*columns))

    return Lanes.of(named).map(steps)
