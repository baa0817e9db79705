"""Continuous Bronze ingestion, duplicate removal, and the streaming validity split and merge."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tachyline.operators import quality
from tachyline.plans.medallion import check_events
from tachyline.session import exists, staged
from tachyline.sources.streams import append_json, handle, write_batch
from tachyline.sources.tables import write_silver

SENT = "sent_at"
_APPLIED = "query_id string, batch_id long"


def ingest_bronze(kafka_rows: DataFrame, path: str, checkpoint: str, bounded: bool = False) -> StreamingQuery:
    return append_json(quality.bronze_projection(kafka_rows), path, checkpoint, bounded)


def split_stream(
    bronze: DataFrame,
    silver_path: str,
    quarantine_path: str,
    metrics_path: str,
    checkpoint: str,
    strict: bool = False,
    bounded: bool = False,
) -> StreamingQuery:
    """Valid rows, quarantine and metrics of every micro-batch, each under its batch number."""

    def write(batch: DataFrame, batch_id: int) -> None:
        # A compressed table takes a fraction of the disk that cached blocks take where memory ends.
        with staged(check_events(batch), "checked-batch", "zstd") as checked:
            write_batch(quality.quarantined_rows(checked, strict), batch_id, quarantine_path)
            write_batch(quality.quality_metrics(checked), batch_id, metrics_path)
            write_batch(quality.valid_rows(checked), batch_id, silver_path)

    return handle(bronze, write, checkpoint, bounded)


def deduplicated_events(bronze: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """Bronze rows of a stream, each event once, with the time it was ``sent_at`` and a watermark on it.

    A copy that comes within ``delay`` of event time is left out, in whatever micro-batch;
    state older than that is freed. An event is known by its id; one without an id by its
    place in the topic, so it is never taken for a copy. Its time is its own, or else that of
    the broker. Events more than ``delay`` behind the newest are dropped by the watermark,
    which ``late_counts`` counts.
    """
    text = F.col("raw_event")
    own_time = F.timestamp_seconds(F.get_json_object(text, "$.timestamp").try_cast("double"))
    place = F.concat_ws(":", F.lit("at"), F.coalesce(F.col("partition").cast("string"), F.lit("")), F.coalesce(F.col("offset").cast("string"), F.lit("")))
    event_id = F.coalesce(F.nullif(F.get_json_object(text, "$.event_id"), F.lit("")), place)
    known = bronze.withColumns({SENT: F.coalesce(own_time, F.col("kafka_ts").cast("timestamp")), "__event": event_id})
    return known.withWatermark(SENT, delay).dropDuplicatesWithinWatermark(["__event"]).drop("__event")


def late_counts(query: StreamingQuery) -> list[tuple[int, int]]:
    """(batch number, rows the watermark dropped before the first stateful operator), for the batches still known."""
    return [
        (progress["batchId"], sum(operator["numRowsDroppedByWatermark"] for operator in progress["stateOperators"]))
        for progress in query.recentProgress
    ]


def window_metrics(bronze: DataFrame, delay: str = "10 minutes", size: str = "1 minute", slide: str | None = None) -> DataFrame:
    """Quality counts per window of event time over a stream, every event counted once."""
    once = quality.parse_events(deduplicated_events(bronze, delay))
    return quality.metrics_per_window(quality.check_quality(quality.flatten_events(once, also=(SENT,))), SENT, size, slide)


def start_window_metrics(
    bronze: DataFrame, path: str, checkpoint: str, late_path: str | None = None, bounded: bool = False, **windows: str
) -> StreamingQuery:
    """Closed windows to ``path``, and to a table beside it how many rows of each micro-batch came too late.

    The count of a micro-batch is known when it has ended, so it is written with the next one;
    ``write_late_counts`` writes what is left when a query has ended.
    """
    late = late_path or f"{path.rstrip('/')}.late"

    def write(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch, batch_id, path)
        spark = batch.sparkSession
        query = spark.streams.get(spark.sparkContext.getLocalProperty("sql.streaming.queryId"))
        if query:
            write_late_counts(spark, query, late)

    return handle(window_metrics(bronze, **windows), write, checkpoint, bounded)


def write_late_counts(spark: SparkSession, query: StreamingQuery, path: str) -> None:
    """The rows that came too late per micro-batch; a batch written before is replaced by itself."""
    found = [(batch_id, rows) for batch_id, rows in late_counts(query) if rows]
    if found:
        counted = spark.createDataFrame(found, "batch_id long, late_rows long").coalesce(1)
        counted.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(path)


def open_windows(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Windows that ``start_window_metrics`` has not closed, read from its state: counts so far."""
    operators = spark.read.format("state-metadata").load(checkpoint)
    counting = operators.where("operatorName = 'stateStoreSave'").select("operatorId").first()[0]
    state = spark.read.format("statestore").option("path", checkpoint).option("operatorId", counting).load()
    names = ["total_rows", *quality.COUNTED]
    counts = F.col("value").cast(f"struct<{', '.join(f'{name}: long' for name in names)}>")
    listed = [F.coalesce(counts[name], F.lit(0)).alias(name) for name in names]
    window = F.col("key").cast("struct<window: struct<start: timestamp, end: timestamp>>")["window"]
    return state.select(window["start"].alias("window_start"), window["end"].alias("window_end"), *listed)


def merge_batch(
    batch: DataFrame, batch_id: int, query_id: str, silver_path: str, quarantine_path: str, metrics_path: str, strict: bool, layout: str
) -> bool:
    """One micro-batch into the tables; False if the log says that it has been applied.

    Every write can be repeated: a merge of the same rows changes nothing, and the others
    replace their batch number. The log comes last, so a batch that failed half-way is redone.
    """
    spark, log = batch.sparkSession, f"{silver_path.rstrip('/')}.applied"
    if exists(spark, log):
        last = spark.read.schema(_APPLIED).parquet(log).where(F.col("query_id") == query_id).agg(F.max("batch_id")).first()[0]
        if last is not None and batch_id <= last:
            return False
    checked = check_events(batch).persist()
    try:
        write_batch(quality.quarantined_rows(checked, strict), batch_id, quarantine_path)
        write_batch(quality.quality_metrics(checked), batch_id, metrics_path)
        write_silver(quality.valid_rows(checked), silver_path, "merge", layout)
    finally:
        checked.unpersist()
    applied = spark.createDataFrame([(query_id, batch_id)], _APPLIED).coalesce(1)
    applied.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("query_id").parquet(log)
    return True


def merge_stream(
    bronze: DataFrame,
    silver_path: str,
    quarantine_path: str,
    metrics_path: str,
    checkpoint: str,
    strict: bool = False,
    layout: str = "hashed",
    bounded: bool = False,
) -> StreamingQuery:
    """Bronze to the Silver table that batch jobs write: one row per simulation and step, whatever is delivered twice.

    A log beside the table holds the last batch number applied per query, which lives in the
    query's checkpoint: a batch repeated after a restart is passed over.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        query_id = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        merge_batch(batch, batch_id, query_id, silver_path, quarantine_path, metrics_path, strict, layout)

    return handle(bronze, write, checkpoint, bounded)
