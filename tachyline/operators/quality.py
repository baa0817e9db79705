"""Parsing of raw events, quality checks, split and metrics."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tachyline.functions import rules
from tachyline.schemas import EXTENDED_PATHS, METRICS_DATASET, QUALITY_FLAGS, SILVER_PATHS, raw_event_schema


VERDICT = "is_valid"


def bronze_projection(df: DataFrame) -> DataFrame:
    """Kafka source rows with the metadata renamed and the payload as text."""
    return df.select(
        F.col("timestamp").alias("kafka_ts"),
        "partition",
        "offset",
        F.col("value").cast("string").alias("raw_event"),
    )


def parse_events(df: DataFrame, extended: bool = False) -> DataFrame:
    """Adds ``parsed``; malformed text gives a struct of NULLs, a wrong type a NULL field."""
    return df.withColumn("parsed", F.from_json("raw_event", raw_event_schema(extended)))


def flatten_events(df: DataFrame, extended: bool = False, keep_raw: bool = False, also: tuple[str, ...] = ()) -> DataFrame:
    """The fields of ``parsed`` as columns; ``also`` names columns that are kept beside them."""
    paths = {**SILVER_PATHS, **EXTENDED_PATHS} if extended else SILVER_PATHS
    fields = [F.col(f"parsed.payload.{path}").alias(name) for name, path in paths.items()]
    raw = [F.col("raw_event")] if keep_raw else []
    return df.select(*fields, F.current_timestamp().alias("processed_at"), *raw, *also)


def check_quality(df: DataFrame) -> DataFrame:
    """The rows with one flag per rule and the verdict, in a single projection."""
    flags = rules.flags()
    broken = reduce(Column.__or__, flags.values())
    return df.select("*", *[flag.alias(name) for name, flag in flags.items()], (~broken).alias(VERDICT))


def valid_rows(checked: DataFrame) -> DataFrame:
    """Rows that no rule objects to, without the flags."""
    kept = [name for name in checked.columns if name not in QUALITY_FLAGS]
    return checked.where(F.col(VERDICT)).select(*kept)


def quarantined_rows(checked: DataFrame, strict: bool = False) -> DataFrame:
    """Invalid rows; ``strict`` adds the undetermined ones, which otherwise go nowhere."""
    verdict = F.col(VERDICT)
    return checked.where(~F.coalesce(verdict, F.lit(False)) if strict else ~verdict)


# What the metrics table counts; a NULL counts for neither side, and nothing sums up to NULL.
COUNTED = {
    "null_violations": "is_null_violation",
    "range_violations": "is_range_violation",
    "invalid_rows": f"NOT {VERDICT}",
}


def quality_metrics(checked: DataFrame) -> DataFrame:
    """One row: all rows, and those that meet each condition."""
    counts = [F.expr(f"sum(int({condition}))").alias(name) for name, condition in COUNTED.items()]
    stamped = [F.lit(METRICS_DATASET).alias("dataset"), F.current_timestamp().alias("check_time")]
    return checked.agg(F.count(F.lit(1)).alias("total_rows"), *counts).select("*", *stamped)


def metrics_per_window(checked: DataFrame, time: str, size: str = "1 minute", slide: str | None = None) -> DataFrame:
    """The same counts per window of event time, tumbling or sliding; rows without a time are in none.

    Batch or stream: a stream needs a watermark on ``time``, which closes windows and frees their state.
    """
    counts = [F.expr(f"coalesce(sum(int({condition})), 0L)").alias(name) for name, condition in COUNTED.items()]
    counted = checked.groupBy(F.window(time, size, slide or size)).agg(F.count(F.lit(1)).alias("total_rows"), *counts)
    return counted.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "total_rows", *COUNTED)


def undetermined_count(checked: DataFrame) -> DataFrame:
    """How many rows are in neither table."""
    return checked.groupBy().agg((F.count("*") - F.count("is_valid")).alias("undetermined_rows"))


def deduplicated(df: DataFrame) -> DataFrame:
    """One row per simulation and step, whatever was delivered twice.

    Copies are combined before the shuffle, so a step repeated many times does not
    gather its copies in one task.
    """
    return df.dropDuplicates(["simulation_id", "step"])
