"""Live streams: closing passes, chained operators, duplicates, merges, event-time windows, bounded history."""

import json

import pandas as pd
import pytest
from conftest import SF
from pyspark.sql import functions as F

from checks.queries import live
from checks.recorded import telemetry
from tachyline.operators import forest, quality, sessions
from tachyline.operators.features import serving_features
from tachyline.operators.lanes import Lanes
from tachyline.session import settings
from tachyline.sources import streams, tables
from tachyline.streaming import ingest, serving
from tachyline.streaming import live as live_streams
from tachyline.streaming.windows import ROCKSDB, packed, unpacked

BRONZE = "kafka_ts timestamp, partition long, offset long, raw_event string"


@pytest.fixture(autouse=True, scope="module")
def stateful(spark):
    with settings(spark, **ROCKSDB, spark__sql__shuffle__partitions="4"):
        yield


def same_rows(left, right, keys=("simulation_id", "step")):
    frames = [df.toPandas().sort_values(list(keys), ignore_index=True) for df in (left, right)]
    pd.testing.assert_frame_equal(frames[0], frames[1][list(frames[0].columns)], check_dtype=False, rtol=1e-9, atol=1e-9)


def gapped(spark, keep="step % 3 <> 2"):
    return serving.live_samples(live(spark, SF).union().where("simulation_id in ('1', '2')").where(keep))


def test_closing_pass_between_bounded_runs(spark, tmp_path):
    """Settled and closing rows are the batch windows after every run, and the state goes on."""
    source, out, log = (str(tmp_path / name) for name in ("source", "out", "log"))
    samples = gapped(spark)
    seen = None
    for low, high in ((0, 459), (460, 2000)):
        part = samples.where(F.col("step").between(low, high))
        part.coalesce(2).write.mode("append").parquet(source)
        seen = part if seen is None else seen.unionByName(part)
        stream = streams.file_stream(spark, source, samples.schema, max_files=1)
        streams.append_parquet(serving.serving_features(stream), out, log, True).awaitTermination()
        closing = serving.closing_features(spark, log)
        settled = spark.read.parquet(out)
        assert closing.count() > 0
        same_rows(settled.unionByName(closing), serving_features(seen))


@pytest.fixture(scope="module")
def model(spark):
    rows = serving_features(gapped(spark, "step % 2 = 0"))
    style = F.when(F.col("throttle_avg_10s") > 0.5, "AGGRESSIVE").otherwise("NORMAL")
    return forest.fit_forest(rows.withColumn("driving_style", style), trees=3, depth=3)


def messages(spark, samples, path, edges=(0, 200, 420, 2000)):
    """Telemetry events of ``samples`` as a stream of one file per span of steps."""
    for low, high in zip(edges, edges[1:], strict=False):
        rows = samples.where((F.col("step") >= low) & (F.col("step") < high))
        parts = [F.struct("engine_rpm").alias("engine"), F.struct("current_gear").alias("gearbox"), F.struct("speed_kmh").alias("vehicle"), F.struct("throttle").alias("driver")]
        payload = F.struct("simulation_id", "step", F.struct(*parts).alias("modules"))
        event = F.struct(F.lit("simulation.raw").alias("event_type"), payload.alias("payload"))
        rows.select(F.to_json(event).alias("value")).coalesce(1).write.mode("append").parquet(path)
    return streams.file_stream(spark, path, spark.read.parquet(path).schema, max_files=1)


def test_one_chained_query_equals_two_with_a_table_between(spark, model, tmp_path):
    samples = gapped(spark, "step <> 333 AND step <> 340")
    stream = messages(spark, samples, str(tmp_path / "messages"))
    paths = {name: str(tmp_path / name) for name in ("scored", "coached", "chained")}
    logs = {name: f"{path}.log" for name, path in paths.items()}
    serving.start_scoring(stream, model, paths["scored"], logs["scored"], True).awaitTermination()
    predicted = streams.file_stream(spark, paths["scored"], spark.read.parquet(paths["scored"]).schema)
    serving.start_coaching(predicted, paths["coached"], logs["coached"], True).awaitTermination()
    serving.start_live_coaching(stream, model, paths["chained"], logs["chained"], True).awaitTermination()
    chained = spark.read.parquet(paths["chained"])
    full = chained.where("buffered = 300")
    same_rows(full.select("simulation_id", "step", "score", "display_score", "display_text"), spark.read.parquet(paths["coached"]))
    warm = chained.where("buffered < 300").toPandas()
    assert set(warm["score"]) == set(warm["display_score"]) == {0.0}
    assert sorted(warm["step"]) == sorted(2 * [n for n in range(0, 300, 10)])
    assert set(warm.loc[warm["step"] == 150, "display_text"]) == {"AI is warming up...\nProgress: 50%"}


@pytest.mark.parametrize("keep", ["step % 3 <> 2", "step <> 340"])
def test_closing_pass_of_scoring_and_coaching(spark, model, tmp_path, keep):
    """With gaps at the end, both tables are complete once they are closed, also when nothing was settled."""
    samples = gapped(spark, keep)
    stream = messages(spark, samples, str(tmp_path / "messages"))
    scored, coached = str(tmp_path / "scored"), str(tmp_path / "coached")
    serving.start_scoring(stream, model, scored, f"{scored}.log", True).awaitTermination()
    serving.close_scoring(spark, model, scored, f"{scored}.log")
    predicted = streams.file_stream(spark, scored, spark.read.parquet(serving.closing_path(scored)).schema)
    serving.start_coaching(predicted, coached, f"{coached}.log", True).awaitTermination()
    for _ in range(2):  # a closing pass may be repeated
        serving.close_scoring(spark, model, scored, f"{scored}.log")
        serving.close_coaching(spark, scored, coached, f"{coached}.log")
    want = forest.score(model, serving_features(samples).where("step % 10 = 0"))
    same_rows(serving.with_closing(spark, scored).select("simulation_id", "step", "score"), want)
    smooth = sessions.smoothed(want, F.col("score"), "display_score")
    same_rows(serving.with_closing(spark, coached).select("simulation_id", "step", "score", "display_score"), smooth)


def test_late_rows_are_kept_by_default(spark, model, tmp_path):
    rows = gapped(spark, "simulation_id = '1' AND step < 450")
    path, out, chained = (str(tmp_path / name) for name in ("messages", "out", "chained"))
    messages(spark, rows.where("step <> 20"), path, (0, 450))
    stream = messages(spark, rows.where("step = 20"), path, (0, 450))
    serving.start_scoring(stream, model, out, f"{out}.log", True).awaitTermination()
    serving.start_live_coaching(stream, model, chained, f"{chained}.log", True).awaitTermination()
    for table in (out, chained):
        assert [(r["simulation_id"], r["step"]) for r in serving.late_rows(spark, table).collect()] == [("1", 20)]
    assert serving.late_rows(spark, str(tmp_path / "nothing")).count() == 0


def event(event_id, at, **payload):
    return json.dumps({"event_type": "simulation.raw", "event_id": event_id, "timestamp": at, "payload": payload})


def test_duplicates_and_events_without_id_or_time(spark, tmp_path):
    path, out = str(tmp_path / "bronze"), str(tmp_path / "out")
    stamp = pd.Timestamp("2024-01-01", tz="UTC").to_pydatetime()
    first = [(stamp, 0, 0, event("a", 1_704_067_200)), (stamp, 0, 1, event("b", None)), (stamp, 0, 2, event(None, 1_704_067_201)), (stamp, 0, 3, "not json"), (stamp, 1, 3, None)]
    again = [(stamp, 0, 4, event("a", 1_704_067_200)), (stamp, 0, 5, event("b", None)), (stamp, 0, 6, event(None, 1_704_067_201)), (stamp, 0, 7, event("", 1_704_067_201)), (None, None, None, event("c", None))]
    for rows in (first, again):
        spark.createDataFrame(rows, BRONZE).coalesce(1).write.mode("append").parquet(path)
    stream = streams.file_stream(spark, path, spark.read.parquet(path).schema, max_files=1)
    streams.append_parquet(ingest.deduplicated_events(stream), out, f"{out}.log", True).awaitTermination()
    left = sorted((r["partition"], r["offset"]) for r in spark.read.parquet(out).where("offset IS NOT NULL").collect())
    assert left == [(0, 0), (0, 1), (0, 2), (0, 3), (0, 6), (0, 7), (1, 3)]
    assert spark.read.parquet(out).where("offset IS NULL").count() == 1


def test_rows_behind_the_watermark_are_counted(spark, tmp_path):
    """Windows close, state is freed, late rows are in no window but in the count."""
    path, out = str(tmp_path / "bronze"), str(tmp_path / "out")
    spans = [[0, 30, 61, 62], [700, 701], [702], [5, 6, 640], [1500]]  # the second batch closes minutes 0 and 1, for the fourth
    for number, seconds in enumerate(spans):
        rows = [(None, 0, 10 * number + i, event(f"{number}-{i}", 1_704_067_200 + s, simulation_id="1", step=s)) for i, s in enumerate(seconds)]
        spark.createDataFrame(rows, BRONZE).coalesce(1).write.mode("append").parquet(path)
    stream = streams.file_stream(spark, path, spark.read.parquet(path).schema, max_files=1)
    query = ingest.start_window_metrics(stream, out, f"{out}.log", bounded=True, delay="2 minutes")
    query.awaitTermination()
    ingest.write_late_counts(spark, query, f"{out}.late")
    closed = {r["window_start"].minute: r["total_rows"] for r in spark.read.parquet(out).collect()}
    waiting = {r["window_start"].minute: r["total_rows"] for r in ingest.open_windows(spark, f"{out}.log").collect()}
    assert closed == {0: 2, 1: 2, 10: 1, 11: 3} and waiting == {25: 1}
    assert spark.read.parquet(f"{out}.late").agg(F.sum("late_rows")).first()[0] == 2


def test_sliding_windows_overlap(spark):
    rows = [(10, "1"), (70, "1"), (70, None), (None, "1")]
    checked = quality.check_quality(quality.flatten_events(quality.parse_events(spark.createDataFrame([(event("x", 0, simulation_id=i, step=1), t) for t, i in rows], "raw_event string, seconds long").withColumn("at", F.timestamp_seconds("seconds"))), also=("at",)))
    found = quality.metrics_per_window(checked, "at", "2 minutes", "1 minute").orderBy("window_start").collect()
    assert [(r["total_rows"], r["null_violations"]) for r in found] == [(1, 1), (3, 3), (2, 2)]


def test_applied_batches_are_passed_over(spark, tmp_path):
    paths = [str(tmp_path / name) for name in ("silver", "quarantine", "metrics")]

    def bronze(steps, rpm):
        modules = {"engine": {"engine_rpm": rpm}, "vehicle": {"speed_kmh": 1.0}, "driver": {"throttle": 0.1}, "thermals": {"coolant_temp_c": 20.0}}
        return spark.createDataFrame([(None, 0, s, event(str(s), 1, simulation_id="1", step=s, modules=modules)) for s in steps], BRONZE)

    def merged(rows, number, query):
        return ingest.merge_batch(rows, number, query, *paths, False, "hashed")

    def speeds():
        return {r["step"]: r["engine_rpm"] for r in tables.read_silver(spark, paths[0]).collect()}

    assert merged(bronze([1, 2, 2], 10.0), 0, "q") and merged(bronze([2, 3], 20.0), 1, "q")
    assert speeds() == {1: 10.0, 2: 20.0, 3: 20.0}
    assert not merged(bronze([1, 2, 2], 10.0), 0, "q") and not merged(bronze([2, 3], 99.0), 1, "q")
    assert speeds() == {1: 10.0, 2: 20.0, 3: 20.0}
    assert merged(bronze([3], 30.0), 0, "another query")  # its batch numbers are its own
    assert speeds()[3] == 30.0
    assert merged(bronze([], 0.0).limit(0), 2, "q") and len(speeds()) == 3


def test_history_stays_bounded(spark, tmp_path):
    path, out = str(tmp_path / "samples"), str(tmp_path / "history")
    rows = telemetry(spark, SF).union().where("simulation_id in ('1', '2', '3')")
    for number in range(20):
        rows.where(F.col("step") % 20 == number).coalesce(1).write.mode("append").parquet(path)
    stream = streams.file_stream(spark, path, rows.schema, max_files=1)
    live_streams.keep_history(stream, out, f"{out}.log", True, buckets=2).awaitTermination()
    for _ in range(2):
        made = live_streams.current_history(spark, out)
        assert {r["count"] for r in made.groupBy("simulation_id").count().collect()} == {300}
        same_rows(made, sessions.history(rows))
        live_streams.merge_history(sessions.history(rows.where("step < 100")), out, buckets=2)  # an old batch again


@pytest.mark.parametrize("long_rows", [None, 3])
def test_trips(spark, long_rows):
    """A gap of exactly the pause parts trips; ties, missing times and a missing simulation."""
    times = [0, 10, 10, 69, 129, 130, 190, 10**6, None]
    rows = [("a", t if t is None else t * 10**6, float(i)) for i, t in enumerate(times)] + [(None, 5 * 10**6, 1.0), ("b", None, 1.0)]
    df = spark.createDataFrame(rows, "simulation_id string, at long, value double")
    found = Lanes.of(df, long_rows=long_rows, block_rows=4).map(lambda part, lane: sessions.trips(part, 60, lane)).union()
    got = sorted((r["simulation_id"] or "", r["trip"], r["samples"], r["most"]) for r in found.collect())
    assert got == [("", 1, 1, 1.0), ("a", 1, 4, 3.0), ("a", 2, 2, 5.0), ("a", 3, 1, 6.0), ("a", 4, 1, 7.0)]


def test_no_rate_without_both_times(spark):
    rows = [("1", 0, 0.1, 0.0), ("1", 1, 0.2, None), ("1", 2, 0.4, 1.0), ("1", 3, 0.5, 2.0)]
    df = spark.createDataFrame(rows, "simulation_id string, step int, throttle double, simulation_time double")
    rates = [r["throttle_change_rate"] for r in sessions.throttle_rate(df).orderBy("step").collect()]
    assert rates[:3] == [None, None, None] and abs(rates[3] - 0.1) < 1e-12


def test_window_rows_are_one_value_of_state():
    rows = pd.DataFrame({"step": [3, 4], "score": [0.1, None], "buffered": [300, 300]})
    kind = serving._with(serving.SCORE, (serving.BUFFERED, serving.T.IntegerType()))
    value = packed(rows, kind)
    assert isinstance(value, bytes) and len(value) == 2 * 3 * 8
    pd.testing.assert_frame_equal(unpacked(value, kind), rows)
    assert list(unpacked(b"", kind).columns) == list(rows.columns)
