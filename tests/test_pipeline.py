"""Tables, batch jobs and streams from JSON events to coached predictions."""

import json
import time

import pandas as pd
import pytest
from conftest import SF
from pyspark.sql import functions as F

from checks.queries import live, predictions
from tachyline.functions import events
from tachyline.operators import forest, quality, sessions
from tachyline.operators.lanes import Lanes
from tachyline.plans import medallion
from tachyline.schemas import COMMAND_EVENT_SCHEMA, METRICS_SCHEMA, SILVER_PATHS, SILVER_SCHEMA, raw_event_schema
from tachyline.session import scratch_dir, settings
from tachyline.sources import streams, tables
from checks.recorded import telemetry
from tachyline.streaming import ingest, serving
from tachyline.streaming import live as live_streams
from tachyline.streaming.windows import ROCKSDB


@pytest.fixture(scope="module")
def bronze(spark, tmp_path_factory):
    """The recorded telemetry as Bronze JSON files, with two broken messages."""
    root = str(tmp_path_factory.mktemp("lake"))
    rows = telemetry(spark, SF).union()
    texts = rows.select(F.to_json(events.telemetry_event(SILVER_PATHS)).alias("raw_event"))
    broken = spark.createDataFrame([("not json",), (None,)], "raw_event string")
    meta = [F.current_timestamp().alias("kafka_ts"), F.lit(0).cast("long").alias("partition"), F.lit(0).cast("long").alias("offset")]
    texts.unionByName(broken).select(*meta, "raw_event").repartition(6).write.json(f"{root}/bronze")
    return root


@pytest.fixture(scope="module")
def lake(spark, bronze):
    layout = medallion.Layout(bronze)
    medallion.run_batch(spark, layout)
    medallion.run_learning(spark, layout, trees=5)
    return layout


def test_silver_tables(spark, lake):
    silver = tables.read_silver(spark, lake.at("silver"))
    assert silver.schema.names == SILVER_SCHEMA.names and silver.count() == 5832
    assert tables.read_table(spark, lake.at("quarantine")).count() == 115 + 2
    metrics = spark.read.schema(METRICS_SCHEMA).parquet(lake.at("metrics")).first()
    assert (metrics["total_rows"], metrics["null_violations"], metrics["invalid_rows"]) == (6002, 32, 117)


def test_gold_and_dataset(spark, lake):
    gold = tables.read_table(spark, lake.at("gold"))
    full = spark.read.parquet(lake.at("dataset/full"))
    assert gold.count() == full.count() == 5132
    train, test = tables.read_split(spark, lake.at("dataset/train"), lake.at("dataset/test"))
    assert (train.count(), test.count()) == (4111, 1021)


def test_training_outputs(spark, lake):
    report = {row["class"]: row for row in spark.read.parquet(lake.at("training/report")).collect()}
    assert set(report) == {"AGGRESSIVE", "NORMAL", "macro avg", "weighted avg"}
    accuracy = spark.read.parquet(lake.at("training/accuracy")).first()[0]
    assert accuracy == pytest.approx(report["weighted avg"]["recall"]) and accuracy > 0.5
    assert spark.read.parquet(lake.at("training/importance")).agg(F.sum("importance")).first()[0] == pytest.approx(1.0)


def test_silver_again_changes_nothing_and_metrics_add_up(spark, lake):
    medallion.run_silver(spark, lake)
    assert tables.read_silver(spark, lake.at("silver")).count() == 5832
    assert tables.read_table(spark, lake.at("quarantine")).count() == 117
    assert spark.read.parquet(lake.at("metrics")).count() == 2


@pytest.mark.parametrize("layout", ["simulation", "hashed"])
def test_silver_layouts_and_modes(spark, tmp_path, layout):
    path = str(tmp_path / layout)
    rows = [("007", n, *[1.0] * 7, 2, *[1.0] * 4) for n in range(5)]
    names = [name for name in SILVER_SCHEMA.names if name != "processed_at"]
    df = spark.createDataFrame(pd.DataFrame(rows, columns=names)).withColumn("processed_at", F.current_timestamp())
    df = df.select(*[F.col(f.name).cast(f.dataType) for f in SILVER_SCHEMA.fields])
    tables.write_silver(df.unionByName(df), path, layout=layout)
    tables.write_silver(df.withColumn("simulation_id", F.lit("8")), path, layout=layout, mode="append")
    tables.write_silver(df, path, layout=layout)
    counts = {row[0]: row[1] for row in tables.read_silver(spark, path).groupBy("simulation_id").count().collect()}
    assert counts == {"007": 5, "8": 5}


@pytest.mark.parametrize("layout", ["simulation", "hashed"])
def test_silver_writes_leave_the_rest_alone(spark, tmp_path, layout):
    """Simulations 373 and 1090 share a bucket; slices overlap."""
    path = str(tmp_path / layout)
    names = [name for name in SILVER_SCHEMA.names if name != "processed_at"]

    def rows(simulation, steps, speed):
        made = pd.DataFrame([(simulation, n, 1.0, 1.0, speed, *[1.0] * 4, 2, *[1.0] * 4) for n in steps], columns=names)
        df = spark.createDataFrame(made).withColumn("processed_at", F.current_timestamp())
        return df.select(*[F.col(f.name).cast(f.dataType) for f in SILVER_SCHEMA.fields])

    tables.write_silver(rows("373", range(4), 1.0), path, layout=layout)
    tables.write_silver(rows("1090", range(3), 1.0), path, layout=layout)
    tables.write_silver(rows("373", range(2, 6), 2.0), path, layout=layout)
    found = {(r["simulation_id"], r["step"]): r["speed_kmh"] for r in tables.read_silver(spark, path).collect()}
    assert found == {("373", n): 1.0 if n < 2 else 2.0 for n in range(6)} | {("1090", n): 1.0 for n in range(3)}
    tables.write_silver(rows("373", range(1), 3.0), path, layout=layout, mode="replace")
    assert tables.read_silver(spark, path).groupBy("simulation_id").count().orderBy("count").collect() == [("373", 1), ("1090", 3)]


def test_unknown_write_options_are_refused(spark):
    df = spark.range(1).select(F.lit("a").alias("simulation_id"))
    for options in ({"mode": "upsert"}, {"layout": "flat"}):
        with pytest.raises(ValueError):
            tables.write_silver(df, "/nowhere", **options)


def test_scratch_is_the_shared_folder(spark):
    assert scratch_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_exact_and_approximate_gold_agree_on_features(spark, lake):
    silver = Lanes.of(tables.read_silver(spark, lake.at("silver")))
    rated = medallion.rated_features(silver)
    exact, approx = medallion.gold_table(rated, exact=True), medallion.gold_table(rated)
    assert exact.drop("driving_style").exceptAll(approx.drop("driving_style")).count() == 0
    assert exact.where("driving_style = 'AGGRESSIVE'").count() == 1283


def kafka_file(spark, path, values, part):
    rows = [(bytearray(value, "utf-8"), "simulation.raw", 0, offset) for offset, value in enumerate(values)]
    df = spark.createDataFrame(rows, "value binary, topic string, partition int, offset long")
    df.withColumn("timestamp", F.lit(f"2024-01-01 00:00:0{part}").cast("timestamp")).coalesce(1).write.mode("append").parquet(path)


def test_bronze_stream_continues_from_its_checkpoint(spark, tmp_path):
    source, sink, log = (str(tmp_path / name) for name in ("source", "sink", "log"))
    kafka_file(spark, source, ["a", "b"], 1)
    schema = spark.read.parquet(source).schema
    for part, total in ((2, 2), (3, 3), (4, 3)):
        stream = streams.file_stream(spark, source, schema)
        ingest.ingest_bronze(stream, sink, log, bounded=True).awaitTermination()
        assert tables.read_bronze(spark, sink).count() == total
        if part == 2:
            kafka_file(spark, source, ["c"], part)
    assert {row["raw_event"] for row in tables.read_bronze(spark, sink).collect()} == {"a", "b", "c"}


def test_streamed_split_equals_the_batch_split(spark, bronze, tmp_path):
    parts = [str(tmp_path / name) for name in ("silver", "quarantine", "metrics")]
    stream = streams.file_stream(spark, f"{bronze}/bronze", tables.read_bronze(spark, f"{bronze}/bronze").schema, "json", 2)
    ingest.split_stream(stream, *parts, str(tmp_path / "log"), bounded=True).awaitTermination()
    silver, quarantine, metrics = (spark.read.parquet(part) for part in parts)
    assert metrics.count() == 3
    assert metrics.agg(F.sum("total_rows"), F.sum("invalid_rows")).first()[:] == (6002, 117)
    assert (silver.count(), quarantine.count()) == (5832, 117)
    checked = medallion.check_events(tables.read_bronze(spark, f"{bronze}/bronze"))
    names = [name for name in SILVER_SCHEMA.names if name != "processed_at"]
    assert silver.select(names).exceptAll(quality.valid_rows(checked).select(names)).count() == 0


def test_a_repeated_micro_batch_replaces_itself(spark, tmp_path):
    path = str(tmp_path / "table")
    for batch, rows in ((0, 3), (1, 4), (1, 4)):
        streams.write_batch(spark.range(rows), batch, path)
    assert spark.read.parquet(path).count() == 7


def test_routing_and_commands(spark):
    controls = spark.createDataFrame([("s", 1.5, None), ("s", None, 0.25)], "simulation_id string, throttle double, brake double")
    messages = streams.command_messages(controls)
    other = spark.createDataFrame([("k", '{"event_type": "simulation.raw"}'), ("k", "not json")], messages.schema)
    routed = streams.routed_events(messages.unionByName(other), COMMAND_EVENT_SCHEMA, "driver.command", require_payload=False)
    targets = {(row["pedal_target"], row["brake_target"]) for row in streams.control_targets(routed).collect()}
    assert targets == {(1.0, None), (None, 0.25)}
    empty = other.select("key", F.lit('{"event_type": "simulation.raw"}').alias("value"))
    assert streams.routed_events(empty, raw_event_schema(), "simulation.raw").count() == 0
    assert streams.routed_events(empty, raw_event_schema(), "simulation.raw", require_payload=False).count() == 2


def test_messages_are_keyed_by_simulation(spark):
    rows = telemetry(spark, SF).union().limit(5)
    message = streams.as_messages(rows, events.telemetry_event(), F.col("simulation_id")).first()
    body = json.loads(message["value"])
    assert body["event_type"] == "simulation.raw" and body["payload"]["simulation_id"] == message["key"]


def shuffled_stream(spark, df, path, files=6, per_batch=2):
    """The rows in random order over several micro-batches."""
    df.repartition(files, F.rand(3)).write.parquet(path)
    return streams.file_stream(spark, path, df.schema, max_files=per_batch)


def run_stateful(spark, stream, path, log):
    with settings(spark, **ROCKSDB, spark__sql__shuffle__partitions="4"):
        streams.append_parquet(stream, path, log, bounded=True).awaitTermination()
    return spark.read.parquet(path)


def same_rows(left, right, keys):
    frames = [df.toPandas().sort_values(keys, ignore_index=True) for df in (left, right)]
    pd.testing.assert_frame_equal(frames[0], frames[1][list(frames[0].columns)], check_dtype=False, rtol=1e-9, atol=1e-9)


def test_served_features_equal_batch_features(spark, tmp_path):
    """Out of order, over several micro-batches, with copies."""
    from tachyline.operators.features import serving_features

    batch = live(spark, SF).union().where("simulation_id in ('1', '2', '3')")
    samples = batch.select("simulation_id", *serving.SAMPLE.names)
    copied = samples.unionByName(samples.where("step % 7 = 0"))
    stream = shuffled_stream(spark, copied, str(tmp_path / "samples"))
    made = run_stateful(
        spark, serving.serving_features(stream, patience=1000), str(tmp_path / "out"), str(tmp_path / "log")
    )
    same_rows(made, serving_features(batch), ["simulation_id", "step"])


def test_served_smoothing_equals_batch_smoothing(spark, tmp_path):
    batch = predictions(spark, SF).union().select("simulation_id", "step", "score")
    # A longer simulation than the recorded ones.
    longer = spark.range(30, 400).select(
        F.lit("long").alias("simulation_id"), (F.col("id") * 10).cast("int").alias("step"), (F.col("id") % 101).cast("double").alias("score")
    )
    batch = batch.unionByName(longer)
    stream = shuffled_stream(spark, batch, str(tmp_path / "scores"))
    made = run_stateful(
        spark, serving.smoothed_scores(stream, patience=4000), str(tmp_path / "out"), str(tmp_path / "log")
    )
    same_rows(made, sessions.smoothed(batch, F.col("score"), "display_score"), ["simulation_id", "step"])


def test_live_scores_equal_batch_scores(spark, lake, tmp_path):
    model = forest.PipelineModel.load(lake.at("model"))
    features = spark.read.parquet(lake.at("dataset/test")).drop("driving_style")
    stream = shuffled_stream(spark, features, str(tmp_path / "features"))
    path = str(tmp_path / "out")
    streams.append_parquet(serving.predictions(stream, model), path, str(tmp_path / "log"), bounded=True).awaitTermination()
    want = forest.score(model, features.where("step % 10 = 0"))
    same_rows(spark.read.parquet(path), want, ["simulation_id", "step"])
    coached = serving.coached(want.withColumn("display_score", F.col("score"))).select("status_name").distinct()
    assert {row[0] for row in coached.collect()} <= {"DANGER", "CAUTION", "OPTIMAL"}


def test_streamed_latest_state(spark, tmp_path):
    df = telemetry(spark, SF).union()
    stream = shuffled_stream(spark, df, str(tmp_path / "samples"))
    path = str(tmp_path / "states")
    with settings(spark, spark__sql__shuffle__partitions="4"):
        live_streams.update_table(live_streams.latest_states(stream), path, str(tmp_path / "log"), True).awaitTermination()
    made = live_streams.current_rows(spark, path)
    same_rows(made, sessions.latest_state(df), ["simulation_id"])


def signals(spark, steps):
    signal = F.sin("step") * 500 + 2000
    rows = spark.createDataFrame([("a", int(n)) for n in steps], "simulation_id string, step int")
    return rows.select(
        "simulation_id", "step", signal.alias("engine_rpm"), (F.col("step") % 9 / 10).alias("throttle"),
        (F.col("step") % 7 / 10).alias("load"), F.lit(1.0).alias("speed_kmh"), F.lit(2).alias("current_gear"),
    )


LOST = [50, 333, 334, *range(700, 720), 899, 1399, 1400]


@pytest.mark.parametrize(("steps", "files"), [(range(2000), 2), ([n for n in range(2000) if n not in LOST], 5), (range(0, 1500, 2), 3)])
def test_windows_count_rows_with_default_settings(spark, tmp_path, steps, files):
    """In step order, with events that never come; however the stream is cut, windows hold 300 rows."""
    from tachyline.operators.features import serving_features

    sample, path = signals(spark, steps), str(tmp_path / "samples")
    edges = [max(steps) * i // files for i in range(files)] + [max(steps) + 1]
    for start, end in zip(edges, edges[1:], strict=False):
        sample.where((F.col("step") >= start) & (F.col("step") < end)).coalesce(1).write.mode("append").parquet(path)
    stream = streams.file_stream(spark, path, sample.schema, max_files=1)
    made = run_stateful(spark, serving.serving_features(stream), str(tmp_path / "out"), str(tmp_path / "log"))
    want = serving_features(sample)
    if max(steps) % 2 == 0:  # with gaps at the end, the last rows wait for the timer
        want = want.where(F.col("step") <= max(steps) - 256)
    same_rows(made, want, ["simulation_id", "step"])


def test_late_rows_are_put_out(spark, tmp_path):
    """A row 400 steps late is marked, with nothing computed for it."""
    path = str(tmp_path / "samples")
    for steps in ([n for n in range(1000) if n != 500], [500, 998, 999]):
        signals(spark, steps).coalesce(1).write.mode("append").parquet(path)
    stream = streams.file_stream(spark, path, signals(spark, [0]).schema, max_files=1)
    made = run_stateful(spark, serving.served(stream), str(tmp_path / "out"), str(tmp_path / "log"))
    assert [(row["step"], row["rpm_avg_10s"]) for row in made.where("late").collect()] == [(500, None)]
    assert made.where("NOT late").count() == 999 - 299


def test_waiting_rows_are_flushed_by_the_timer(spark, tmp_path):
    path, out = str(tmp_path / "samples"), str(tmp_path / "out")
    signals(spark, [n for n in range(1000) if n != 990]).coalesce(1).write.parquet(path)
    stream = streams.file_stream(spark, path, signals(spark, [0]).schema)
    with settings(spark, **ROCKSDB, spark__sql__shuffle__partitions="2"):
        run = streams.append_parquet(serving.serving_features(stream, timed=True, flush_ms=1), out, str(tmp_path / "log"))
        try:
            for _ in range(60):
                time.sleep(0.5)
                if run.lastProgress and spark.read.schema("step int").parquet(out).agg(F.max("step")).first()[0] == 999:
                    break
        finally:
            run.stop()
    made = spark.read.parquet(out)
    assert made.count() == made.select("step").distinct().count() == 999 - 299
