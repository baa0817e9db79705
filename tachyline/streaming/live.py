"""Running session counters, latest state and history over a stream of samples."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tachyline.operators import sessions
from tachyline.schemas import SERVING_ROWS
from tachyline.session import exists, staged
from tachyline.sources.streams import handle, start, write_batch

HISTORY_BUCKETS = 64
_BUCKET = "history_bucket"


def update_table(changes: DataFrame, path: str, checkpoint: str, bounded: bool = False) -> StreamingQuery:
    """Write the changed rows of a streaming aggregate, batch by batch."""

    def write(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch, batch_id, path)

    return start(changes.writeStream.outputMode("update").foreachBatch(write), checkpoint, bounded)


def current_rows(spark: SparkSession, path: str, key: str = "simulation_id") -> DataFrame:
    """The newest version of every row of an update table."""
    changes = spark.read.parquet(path)
    kept = [name for name in changes.columns if name != "batch_id"]
    newest = [F.max_by(name, "batch_id").alias(name) for name in kept if name != key]
    return changes.groupBy(key).agg(*newest).select(*kept)


def session_counters(samples: DataFrame) -> DataFrame:
    """One state row per simulation; every task sums up its own rows first."""
    return sessions.session_summary(samples)


def latest_states(samples: DataFrame) -> DataFrame:
    return sessions.latest_state(samples)


def keep_history(
    samples: DataFrame, path: str, checkpoint: str, bounded: bool = False, rows: int = SERVING_ROWS, buckets: int = HISTORY_BUCKETS
) -> StreamingQuery:
    """A table of the newest ``rows`` rows per simulation, never more, whatever has streamed by.

    Simulations are spread over ``buckets`` folders, by a number that must not change for a
    table. A micro-batch reads and replaces only the folders of the simulations it has; a
    repeated one changes nothing.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        merge_history(sessions.history(batch, rows), path, rows, buckets)

    return handle(samples, write, checkpoint, bounded)


def merge_history(newest: DataFrame, path: str, rows: int = SERVING_ROWS, buckets: int = HISTORY_BUCKETS) -> None:
    bucket = F.pmod(F.xxhash64("simulation_id"), F.lit(buckets)).cast("int")
    with staged(newest.withColumn(_BUCKET, bucket), "history-batch") as arrived:
        merged = arrived
        if exists(arrived.sparkSession, path):
            touched = arrived.select(_BUCKET).distinct()
            known = arrived.sparkSession.read.schema(arrived.schema).parquet(path).join(F.broadcast(touched), _BUCKET, "left_semi")
            merged = arrived.unionByName(known)
        kept = sessions.last_samples(merged.dropDuplicates(["simulation_id", "step"]), rows)
        with staged(kept, "history") as made:
            writer = made.repartition(_BUCKET).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            writer.partitionBy(_BUCKET).parquet(path)


def current_history(spark: SparkSession, path: str) -> DataFrame:
    """The newest rows per simulation over all micro-batches."""
    return spark.read.parquet(path).drop(_BUCKET)


def paused_trips(samples: DataFrame, pause: str, delay: str) -> DataFrame:
    """``sessions.trips`` of a stream, by session windows that merge as samples fill a pause.

    ``samples`` has ``simulation_id``, ``ts`` and ``value``. A trip is put out when the
    watermark, ``delay`` behind the newest sample of all simulations, has passed its pause.
    """
    timed = samples.withWatermark("ts", delay).groupBy("simulation_id", F.session_window("ts", pause).alias("trip"))
    found = timed.agg(F.count(F.lit(1)).alias("samples"), F.max("value").alias("most"))
    ended = F.col("trip.end") - F.expr(f"INTERVAL {pause}")
    return found.select("simulation_id", F.col("trip.start").alias("started"), ended.alias("ended"), "samples", "most")
