"""The registered queries: every operator over the whole test tables."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tachyline.functions import driving, events
from tachyline.functions.numbers import steady_round
from tachyline.operators import evaluation, features, forest, gaps, labels, quality, sessions, split
from tachyline.operators.lanes import Lanes
from tachyline.plans import incremental, medallion
from tachyline.schemas import (
    AGGRESSIVE,
    COMMAND_EVENT_SCHEMA,
    EXTENDED_PATHS,
    FEATURE_COLUMNS,
    LABEL_QUANTILE,
    NORMAL,
    QUALITY_FLAGS,
    SILVER_PATHS,
)
from tachyline.session import fresh_path, freed_shuffles, settings, stage, staged
from tachyline.sources import streams
from checks.recorded import telemetry
from tachyline.sources.tables import note_changes, read_bronze, read_silver, read_table, write_bucketed, write_gold, write_silver
from tachyline.streaming import ingest, serving
from tachyline.streaming import live as live_streams
from tachyline.streaming.windows import ROCKSDB

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

FEATURE_PLACES = {
    "rpm_avg_10s": 3,
    "rpm_std_10s": 3,
    "throttle_avg_10s": 6,
    "engine_load_avg_10s": 6,
    "power_factor": 3,
    "rpm_range_10s": 3,
}
SERVING_PLACES = {**FEATURE_PLACES, "load_max_10s": 6}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def rounded(df: DataFrame, places: dict[str, int]) -> DataFrame:
    return df.withColumns({name: steady_round(F.col(name), n) for name, n in places.items()})


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{name}.parquet")


def checked(spark: SparkSession, directory: str) -> Lanes:
    return telemetry(spark, directory).transform(quality.check_quality)


def silver(spark: SparkSession, directory: str) -> Lanes:
    return checked(spark, directory).transform(quality.valid_rows)


def featured(spark: SparkSession, directory: str) -> DataFrame:
    return silver(spark, directory).map(features.gold_features).union()


def rates(spark: SparkSession, directory: str) -> Lanes:
    return silver(spark, directory).map(features.wear_rates).transform(features.labelled_rows)


def rated(spark: SparkSession, directory: str) -> DataFrame:
    """The table Gold is made from, with rates rounded so that two engines' sums agree."""
    return stage(rounded(medallion.rated_features(silver(spark, directory)), {"future_wear_rate": 12}), "rated")


def labelled(spark: SparkSession, directory: str) -> DataFrame:
    return medallion.gold_table(rated(spark, directory), exact=True)


def live(spark: SparkSession, directory: str) -> Lanes:
    """Raw samples as live serving takes them: defaults filled, load estimated."""

    def sample(df: DataFrame) -> DataFrame:
        names = ["engine_rpm", "throttle", "speed_kmh", "current_gear"]
        filled = df.select("simulation_id", "step", *[events.with_default(name) for name in names])
        return filled.withColumn("load", driving.load_estimate(F.col("throttle"), F.col("engine_rpm")))

    return telemetry(spark, directory).transform(sample)


def predictions(spark: SparkSession, directory: str) -> Lanes:
    """Every tenth full-buffer row, with a score that depends on the throttle alone."""
    full = live(spark, directory).map(features.warmup_progress)
    return full.transform(
        lambda df: features.every_nth(df.where(F.col("buffered") == 300), 10).withColumn("score", F.col("throttle") * 100)
    )


def kafka_rows(spark: SparkSession, directory: str) -> DataFrame:
    """Rows shaped like the Kafka source's."""
    return table(spark, directory, "events").select(
        F.col("props").cast("binary").alias("value"),
        F.lit("simulation.raw").alias("topic"),
        (F.col("user_id") % 8).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    )


def event_texts(rows: DataFrame, paths: dict[str, str] = SILVER_PATHS) -> DataFrame:
    return rows.select(F.to_json(events.telemetry_event(paths)).alias("raw_event"))


def raw_events(spark: SparkSession, directory: str, paths: dict[str, str] = SILVER_PATHS) -> DataFrame:
    return event_texts(telemetry(spark, directory, extended=True).union(), paths)


@query
def bronze_projection(spark, directory):
    return quality.bronze_projection(kafka_rows(spark, directory))


@query
def parse_flatten(spark, directory):
    return quality.flatten_events(quality.parse_events(raw_events(spark, directory))).drop("processed_at")


@query
def parse_flatten_extended(spark, directory):
    texts = raw_events(spark, directory, {**SILVER_PATHS, **EXTENDED_PATHS})
    return quality.flatten_events(quality.parse_events(texts, True), True).drop("processed_at")


@query
def dq_flags(spark, directory):
    return checked(spark, directory).union().select("simulation_id", "step", *QUALITY_FLAGS)


@query
def silver_valid(spark, directory):
    return silver(spark, directory).union()


@query
def silver_quarantine(spark, directory):
    return quality.quarantined_rows(checked(spark, directory).union())


@query
def silver_quarantine_strict(spark, directory):
    return quality.quarantined_rows(checked(spark, directory).union(), strict=True)


@query
def dq_metrics(spark, directory):
    return quality.quality_metrics(checked(spark, directory).union()).drop("check_time")


@query
def dq_undetermined(spark, directory):
    return quality.undetermined_count(checked(spark, directory).union())


@query
def silver_idempotent(spark, directory):
    """The valid rows delivered twice give the valid rows once."""
    rows = silver(spark, directory).union()
    return quality.deduplicated(rows.unionByName(rows))


@query
def wear_rate_lag(spark, directory):
    made = silver(spark, directory).map(features.wear_rates).union()
    return rounded(made, {"wear_rate_10s": 12}).select("simulation_id", "step", "wear_rate_10s")


@query
def future_wear_rate(spark, directory):
    made = rates(spark, directory).union()
    return rounded(made, {"future_wear_rate": 12}).select("simulation_id", "step", "future_wear_rate")


@query
def rolling_features(spark, directory):
    made = rounded(featured(spark, directory), FEATURE_PLACES)
    return made.select("simulation_id", "step", *FEATURE_COLUMNS)


@query
def rolling_features_by_step(spark, directory):
    made = rates(spark, directory).map(features.rolling_features_by_step).union()
    return rounded(made, FEATURE_PLACES).select("simulation_id", "step", *FEATURE_COLUMNS)


@query
def label_threshold_exact(spark, directory):
    return labels.exact_threshold(rounded(rates(spark, directory).union(), {"future_wear_rate": 12}))


@query
def label_threshold_approx(spark, directory):
    """Whether the rank of the approximate threshold is off by no more than its stated error."""
    found_rates = rates(spark, directory).union().select("future_wear_rate")
    compared = found_rates.withColumn("threshold", labels.approximate_threshold(found_rates).scalar())
    rate, found = F.col("future_wear_rate"), F.col("threshold")
    counted = compared.agg(
        F.count(F.lit(1)).alias("rated_rows"),
        F.count_if(rate < found).alias("below"),
        F.count_if(rate <= found).alias("upto"),
    )
    wanted, slack = F.col("rated_rows") * LABEL_QUANTILE, F.col("rated_rows") / 10_000 + 1
    held = (F.col("below") <= wanted + slack) & (F.col("upto") >= wanted - slack)
    return counted.select("rated_rows", held.alias("rank_within_bound"))


@query
def label_threshold_sketched(spark, directory):
    """Whether the rank of the threshold from stored sketches is off by no more than a percent."""
    found_rates = stage(rates(spark, directory).union().select("simulation_id", "future_wear_rate"), "rates")
    sketches = stage(labels.rate_sketches(found_rates), "sketches")
    compared = found_rates.withColumn("threshold", labels.sketched_threshold(sketches).scalar())
    rate, found = F.col("future_wear_rate"), F.col("threshold")
    counted = compared.agg(
        F.count(F.lit(1)).alias("rated_rows"),
        F.count_if(rate < found).alias("below"),
        F.count_if(rate <= found).alias("upto"),
    )
    wanted, slack = F.col("rated_rows") * LABEL_QUANTILE, F.col("rated_rows") / 100 + 1
    held = (F.col("below") <= wanted + slack) & (F.col("upto") >= wanted - slack)
    return counted.select("rated_rows", held.alias("rank_within_bound"))


@query
def step_gaps(spark, directory):
    return silver(spark, directory).map(gaps.step_gaps).union()


@query
def filled_steps(spark, directory):
    names = ["engine_rpm", "speed_kmh"]
    filled = silver(spark, directory).map(lambda df, lane: gaps.filled_steps(df, names, lane)).union()
    return rounded(filled, {"engine_rpm": 6, "speed_kmh": 6})


@query
def gold_features_bucketed(spark, directory):
    """The Gold features from a bucketed, sorted Silver table."""
    path = fresh_path(spark, "silver-bucketed")
    rows = write_bucketed(silver(spark, directory).union(), path.rsplit("/", 1)[1].replace("-", "_"), path)
    made = stage(rounded(medallion.rated_features(Lanes.of(rows)), {"future_wear_rate": 12}), "rated")
    return rounded(medallion.gold_table(made, exact=True), FEATURE_PLACES)


@query
def gold_features(spark, directory):
    return rounded(labelled(spark, directory), FEATURE_PLACES)


@query
def gold_features_approx(spark, directory):
    """The default label; rows within the error of the approximate threshold may have either."""
    table_ = rated(spark, directory)
    threshold = labels.approximate_threshold(table_).scalar()
    styled = table_.withColumn("driving_style", labels.style_label(F.col("future_wear_rate"), threshold))
    exact = labels.exact_threshold(table_).select("threshold").scalar()
    near = F.abs(F.col("future_wear_rate") - exact) < 1e-6
    shown = styled.withColumn("driving_style", F.when(near, "EITHER").otherwise(F.col("driving_style")))
    return rounded(split.available_columns(shown), FEATURE_PLACES)


@query
def label_distribution(spark, directory):
    return labelled(spark, directory).groupBy("driving_style").agg(F.count(F.lit(1)).alias("label_rows"))


@query
def ml_dataset(spark, directory):
    return rounded(split.ml_dataset(labelled(spark, directory)), FEATURE_PLACES)


@query
def training_rows(spark, directory):
    return rounded(split.complete_rows(split.ml_dataset(labelled(spark, directory))), FEATURE_PLACES)


def _split(spark, directory) -> tuple[DataFrame, DataFrame]:
    return split.group_split(split.ml_dataset(labelled(spark, directory)))


def _tagged(spark, directory) -> DataFrame:
    train, test = _split(spark, directory)
    return train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test")))


@query
def group_split(spark, directory):
    return _tagged(spark, directory).select("simulation_id", "step", "split")


@query
def split_counts(spark, directory):
    return _tagged(spark, directory).groupBy("split").agg(
        F.count(F.lit(1)).alias("split_rows"), F.count_distinct("simulation_id").alias("simulations")
    )


@query
def distinct_simulations(spark, directory):
    return split.distinct_simulations(rates(spark, directory).union())


@query
def last_train_id(spark, directory):
    rows = rates(spark, directory).union()
    return spark.range(1).select(F.lit(split.last_train_id(rows)).alias("simulation_id"))


@query
def class_weights(spark, directory):
    train, _ = _split(spark, directory)
    return rounded(evaluation.class_weights(split.complete_rows(train)), {"class_weight": 9})


def _predicted(spark, directory) -> DataFrame:
    """A fixed rule in place of a model, so that the metrics can be compared."""
    load = steady_round(F.col("engine_load_avg_10s"), 6)
    return labelled(spark, directory).withColumn("prediction", F.when(load > 0.41, "AGGRESSIVE").otherwise("NORMAL"))


@query
def accuracy(spark, directory):
    return rounded(evaluation.accuracy(_predicted(spark, directory)), {"accuracy": 9})


@query
def classification_report(spark, directory):
    report = evaluation.classification_report(_predicted(spark, directory))
    return rounded(report, {"precision": 9, "recall": 9, "f1": 9})


_MODELS: dict[tuple[str, str], tuple[forest.PipelineModel, DataFrame]] = {}


def _forest(spark: SparkSession, directory: str) -> tuple[forest.PipelineModel, DataFrame]:
    """The full-size forest and the test side; queries of one session share the model."""
    key = spark.sparkContext.applicationId, directory
    if key not in _MODELS:
        train, test = (stage(side, "side") for side in _split(spark, directory))
        _MODELS[key] = forest.fit_forest(train), test
    return _MODELS[key]


@query
def rf_quality(spark, directory):
    """Mean share of either class found, on simulations the forest has not seen; a constant answer has one half."""
    model, test = _forest(spark, directory)
    scored = forest.score(model, test)
    hit, named = (F.col("label") == F.col("driving_style")).cast("int"), F.col("driving_style") == NORMAL
    right = scored.agg(
        F.count(F.lit(1)).alias("test_rows"), F.avg(F.when(named, hit)).alias("of_normal"), F.avg(F.when(~named, hit)).alias("of_aggressive")
    )
    forest_ = model.stages[-1]
    full = forest_.getNumTrees == forest.TREES and max(tree.depth for tree in forest_.trees) <= forest.DEPTH
    better = (F.col("of_normal") + F.col("of_aggressive")) / 2 > 0.55
    return right.select("test_rows", better.alias("beats_constant"), F.lit(full).alias("full_size"))


@query
def rf_scores(spark, directory):
    model, test = _forest(spark, directory)
    scored = forest.score(model, test)
    aggressive, score = F.col("label") == AGGRESSIVE, F.col("score")
    share = F.when(aggressive, score).otherwise(100 - score) / 100
    return scored.select(
        "simulation_id",
        "step",
        "driving_style",
        score.between(0, 100).alias("score_in_range"),
        (aggressive == (score > 50)).alias("label_fits_score"),
        (F.abs(F.col("confidence") - share) < 1e-9).alias("confidence_fits_score"),
    )


@query
def feature_importance(spark, directory):
    """Ranked importances: each at most as large as the one before it, all adding up to one."""
    ranked = forest.feature_importance(spark, _forest(spark, directory)[0])
    listed = [(place, row["feature"], row["importance"]) for place, row in enumerate(ranked.collect())]
    ranked = spark.createDataFrame(listed, "place int, feature string, importance double")
    total = F.sum("importance").over(Window.partitionBy())
    before = F.lag("importance", 1, 1.0).over(Window.orderBy("place"))
    return ranked.select(
        "feature",
        (F.col("importance") <= before).alias("descends"),
        F.col("importance").between(0, 1).alias("in_range"),
        (F.abs(total - 1) < 1e-9).alias("adds_up_to_one"),
    )


@query
def serving_features_300(spark, directory):
    return rounded(live(spark, directory).map(features.serving_features).union(), SERVING_PLACES)


@query
def warmup_progress(spark, directory):
    made = live(spark, directory).map(features.warmup_progress).union()
    return rounded(made, {"progress_pct": 6}).select("simulation_id", "step", "buffered", "progress_pct")


@query
def every_nth(spark, directory):
    return features.every_nth(serving_features_300(spark, directory), 10)


@query
def session_running_avg(spark, directory):
    names = {"speed_kmh": "avg_speed_kmh", "fuel_rate_lph": "avg_fuel_lph"}
    made = telemetry(spark, directory, extended=True).map(lambda df, lane: sessions.running_means(df, names, lane))
    return rounded(made.union(), {"avg_speed_kmh": 6, "avg_fuel_lph": 3}).select(
        "simulation_id", "step", "session_ticks", "avg_speed_kmh", "avg_fuel_lph"
    )


@query
def session_summary(spark, directory):
    made = sessions.session_summary(telemetry(spark, directory, extended=True).union())
    return rounded(made, {"avg_speed_kmh": 6, "avg_fuel_lph": 3})


@query
def score_ema(spark, directory):
    made = predictions(spark, directory).map(
        lambda df, lane: sessions.smoothed(df, F.col("score"), "display_score", lane)
    )
    return rounded(made.union(), {"display_score": 6}).select("simulation_id", "step", "display_score")


@query
def slow_ema(spark, directory):
    made = telemetry(spark, directory).map(
        lambda df, lane: sessions.smoothed(df, F.col("oil_temp_c"), "oil_lagged", lane, weight=0.006, initial=15.0)
    )
    return rounded(made.union(), {"oil_lagged": 6}).select("simulation_id", "step", "oil_lagged")


@query
def coaching_tier(spark, directory):
    made = predictions(spark, directory).map(lambda df, lane: sessions.live_scores(df, F.col("score"), lane)).union()
    return rounded(made, {"display_score": 6, "wear_factor": 6}).select(
        "simulation_id", "step", "score", "display_score", "style_key", "status_name", "wear_factor", "display_text"
    )


@query
def prediction_log(spark, directory):
    """The log line of every third prediction, labelled by its score."""
    made = features.every_nth(predictions(spark, directory).union(), 30)
    decided = driving.decision(F.col("score") / 100)
    return made.select("simulation_id", "step", driving.prediction_log(decided["label"], F.col("score")).alias("log_line"))


@query
def warmup_text(spark, directory):
    """What is shown every tenth step until the buffer is full."""
    made = live(spark, directory).map(features.warmup_progress).union()
    filling = features.every_nth(made.where(F.col("buffered") < 300), 10)
    return filling.select("simulation_id", "step", driving.warmup_text(F.col("progress_pct")).alias("shown"))


@query
def prediction_decision(spark, directory):
    made = silver(spark, directory).union().select("simulation_id", "step", "throttle")
    decided = made.withColumns(driving.decision(F.col("throttle"))).drop("throttle")
    return rounded(decided, {"score": 6, "confidence": 6})


@query
def last_300_history(spark, directory):
    return telemetry(spark, directory).transform(sessions.history).union()


@query
def latest_state(spark, directory):
    return telemetry(spark, directory).transform(sessions.latest_state).union()


@query
def throttle_rate(spark, directory):
    made = telemetry(spark, directory).map(sessions.throttle_rate).union()
    return rounded(made, {"throttle_change_rate": 6}).select("simulation_id", "step", "throttle_change_rate")


@query
def load_estimate(spark, directory):
    return rounded(live(spark, directory).union(), {"load": 6}).select("simulation_id", "step", "load")


@query
def fan_hysteresis(spark, directory):
    made = telemetry(spark, directory).map(sessions.fan_state).union()
    return made.select("simulation_id", "step", "coolant_temp_c", "fan_active")


@query
def gear_shift_events(spark, directory):
    return telemetry(spark, directory).map(sessions.shift_events).union()


@query
def gear_dwell(spark, directory):
    return telemetry(spark, directory).map(sessions.gear_dwell).union()


@query
def gear_text(spark, directory):
    """Gears shifted down by one, so that neutral occurs."""
    gear = driving.gear_text(F.col("current_gear") - 1)
    return telemetry(spark, directory).union().select("simulation_id", "step", gear.alias("gear"))


@query
def rpm_zone_time(spark, directory):
    return rounded(sessions.zone_time(telemetry(spark, directory).union()), {"zone_seconds": 6})


@query
def event_envelope(spark, directory):
    event = events.envelope(
        "simulation.raw",
        F.struct("user_id", "value"),
        F.col("event_id").cast("string"),
        F.unix_micros(F.col("ts").cast("timestamp")) / 1e6,
    )
    return table(spark, directory, "events").select(event.alias("e")).select(
        "e.event_type", "e.event_version", "e.event_id", "e.timestamp", "e.payload.user_id", "e.payload.value"
    )


@query
def event_envelope_defaults(spark, directory):
    """Id and time made up at run time, sent as JSON and read back."""
    event = events.envelope("simulation.raw", F.struct(F.col("event_id").alias("number"), "user_id", "value"))
    kind = "event_type string, event_id string, timestamp double, payload struct<number: long, user_id: long, value: double>"
    sent = table(spark, directory, "events").select(F.to_json(event).alias("value"))
    age = events.now_seconds() - F.col("e.timestamp")
    return sent.select(F.from_json("value", kind).alias("e")).select(
        F.col("e.payload.number").alias("event_id"),
        "e.event_type",
        "e.payload.user_id",
        "e.payload.value",
        F.col("e.event_id").rlike("^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$").alias("has_uuid"),
        age.between(0, 3600).alias("has_time"),
    )


@query
def command_envelope(spark, directory):
    """Commands written as JSON and read back."""
    event = events.command_event(
        events.clamp_unit(F.col("value") / 50), F.lit(None).cast("double"), event_id=F.col("event_id").cast("string")
    )
    sent = table(spark, directory, "events").select(F.to_json(event).alias("raw_event"))
    received = sent.select(F.from_json("raw_event", COMMAND_EVENT_SCHEMA).alias("e"))
    read = received.select("e.event_type", "e.event_id", "e.payload.pedal", "e.payload.brake")
    return rounded(read, {"pedal": 6})


@query
def event_routing(spark, directory):
    rows = table(spark, directory, "events").withColumnRenamed("props", "payload")
    return rows.where(events.is_routed("purchase")).select("event_id", "user_id", "event_type", "payload")


@query
def control_clamp(spark, directory):
    control = events.clamp_unit((F.col("value") - 10) / 50)
    given = F.when(F.col("event_id") % 7 != 0, control)
    return table(spark, directory, "events").select("event_id", steady_round(given, 9).alias("control"))


def _commands(spark: SparkSession, directory: str) -> DataFrame:
    """Events as commands of their user; pedal and brake are often not given."""
    number = F.col("event_id")
    return table(spark, directory, "events").select(
        F.col("user_id").cast("string").alias("simulation_id"),
        number.alias("step"),
        events.clamp_unit(F.when(number % 3 == 0, F.col("value") / 50)).alias("pedal"),
        events.clamp_unit(F.when(number % 5 == 0, 1 - F.col("value") / 50)).alias("brake"),
    )


@query
def control_targets_held(spark, directory):
    held = Lanes.of(_commands(spark, directory)).map(sessions.held_controls).union()
    return rounded(held, {"pedal_target": 9, "brake_target": 9}).select("simulation_id", "step", "pedal_target", "brake_target")


@query
def command_messages(spark, directory):
    """Commands as messages, keyed by simulation, and what a listener reads from them."""
    rows = _commands(spark, directory).select("simulation_id", F.col("pedal").alias("throttle"), "brake", "step")
    sent = streams.command_messages(rows.drop("step"))
    read = sent.select("key", F.from_json("value", COMMAND_EVENT_SCHEMA).alias("e"))
    targets = read.select("key", "e.event_type", "e.payload.pedal", "e.payload.brake")
    return rounded(targets, {"pedal": 9, "brake": 9})


@query
def coaching_text_ties(spark, directory):
    """Texts at exact ties of their last digit, as 1.25, which go to the even digit."""
    score = F.col("speed_kmh") / 8
    shown = telemetry(spark, directory).union().select("simulation_id", "step", score.alias("score"))
    texts = shown.withColumns(driving.coaching(F.col("score"))).withColumn("log_line", driving.prediction_log(F.lit("normal"), F.col("score") / 2))
    return texts.select("simulation_id", "step", "display_text", "log_line")


@query
def slow_ema_carried(spark, directory):
    """Smoothing that starts from a value of its own in every simulation."""

    def lagged(df: DataFrame, lane) -> DataFrame:
        started = F.col("simulation_id").cast("double") / 64
        return sessions.smoothed(df, F.col("oil_temp_c"), "oil_lagged", lane, weight=0.006, initial=started)

    made = telemetry(spark, directory).map(lagged).union()
    return rounded(made, {"oil_lagged": 6}).select("simulation_id", "step", "oil_lagged")


# Settings that send every simulation through the block-wise lane.
LONG_LANE = {"spark__tachyline__longKeyRows": "100", "spark__tachyline__blockRows": "320"}


@query
def long_lane_running(spark, directory):
    with settings(spark, **LONG_LANE):
        return session_running_avg(spark, directory)


@query
def long_lane_framed(spark, directory):
    with settings(spark, **LONG_LANE):
        return future_wear_rate(spark, directory)


@query
def long_lane_smoothed(spark, directory):
    with settings(spark, **LONG_LANE):
        return slow_ema(spark, directory)


@query
def default_fill(spark, directory):
    rows = telemetry(spark, directory, extended=True).union()
    return rows.select("simulation_id", "step", *[events.with_default(name) for name in events.FIELD_DEFAULTS])


ROWS_PER_FILE = 1 << 18
ROWS_PER_STATE_TASK = 1 << 20


def files_for(rows: int, parts: int) -> int:
    """How many files each of ``parts`` equal parts of a stream's input is written to, so that no task has many rows."""
    return max(1, -(-rows // (parts * ROWS_PER_FILE)))


def stateful(spark: SparkSession, directory: str, name: str = "lineitem") -> dict[str, str]:
    """Settings of a stream over a table: eight tasks hold its state, more of them where it has many rows."""
    tasks = max(8, -(-table(spark, directory, name).count() // ROWS_PER_STATE_TASK))
    return {**ROCKSDB, "spark__sql__shuffle__partitions": str(tasks)}


# Event texts take far less room so than with the session's codec.
STREAM_CODEC = "zstd"


def as_stream(df: DataFrame, name: str, made: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> DataFrame:
    """What ``made`` makes of the rows of ``df``, in no order, as a stream of at least three micro-batches read from files.

    The rows are dealt to files before ``made`` makes texts of them, which are larger.
    """
    path = fresh_path(df.sparkSession, name)
    each = files_for(df.count(), 8)
    with freed_shuffles(df.sparkSession):
        rows = made(df.repartition(8 * each))
        rows.write.option("compression", STREAM_CODEC).parquet(path)
    return streams.file_stream(df.sparkSession, path, rows.schema, max_files=3 * each)


STEP_SPAN = 80


def by_step(df: DataFrame, name: str, step: str = "step", span: int = STEP_SPAN, files: int = 3) -> DataFrame:
    """The rows of ``df`` as a live stream: ``span`` steps after the other, in no order among them.

    ``df`` is held as a table until the stream's files are written.
    """
    spark, path = df.sparkSession, fresh_path(df.sparkSession, name)
    with freed_shuffles(spark), staged(df, name, STREAM_CODEC) as rows:
        last, count = rows.agg(F.max(step), F.count(F.lit(1))).first()
        each = files_for(count, -(-(last + 1) // span))
        for start in range(0, last + 1, span):
            part = rows.where(F.col(step).between(start, start + span - 1)).repartition(each)
            part.write.mode("append").option("compression", STREAM_CODEC).parquet(path)
    return streams.file_stream(spark, path, rows.schema, max_files=files * each)


def streamed(spark: SparkSession, name: str, run: Callable[[str, str], None]) -> str:
    """Run a bounded stream into a fresh table and return its path."""
    path = fresh_path(spark, name)
    run(path, f"{path}.checkpoint")
    return path


@query
def membership_filter(spark, directory):
    """Rows of the simulations that reach 200 km/h in the highest gear: about a third of them."""
    rows = silver(spark, directory).union()
    fast = rows.where("speed_kmh >= 200 AND current_gear = 7")
    return split.of_simulations(rows, split.distinct_simulations(fast)).select("simulation_id", "step")


def lakehouse(spark: SparkSession, directory: str, *jobs: Callable[[SparkSession, medallion.Layout], None]) -> medallion.Layout:
    """A fresh lakehouse with the recorded events as Bronze, after running ``jobs``."""
    layout = medallion.Layout(fresh_path(spark, "lakehouse"))
    bronze = raw_events(spark, directory).select(
        F.current_timestamp().alias("kafka_ts"),
        F.lit(0).cast("long").alias("partition"),
        F.lit(0).cast("long").alias("offset"),
        "raw_event",
    )
    bronze.write.option("compression", "gzip").json(layout.at("bronze"))
    for job in jobs:
        job(spark, layout)
    return layout


def _hashed_silver(spark: SparkSession, layout: medallion.Layout) -> None:
    medallion.run_silver(spark, layout, silver_layout="hashed")


def _silver_by_simulation(spark: SparkSession, layout: medallion.Layout) -> None:
    medallion.run_silver(spark, layout)


def _exact_gold(spark: SparkSession, layout: medallion.Layout) -> None:
    """The Gold job on rates that are rounded first, as the SQL's are."""
    write_gold(medallion.gold_table(_rounded_rates(spark, layout), exact=True), layout.at("gold"))


def _rounded_rates(spark: SparkSession, layout: medallion.Layout) -> DataFrame:
    made = medallion.rated_features(Lanes.of(read_silver(spark, layout.at("silver"))))
    return stage(rounded(made, {"future_wear_rate": 12}), "rated")


@query
def table_silver(spark, directory):
    """The Silver table after two runs of its job."""
    layout = lakehouse(spark, directory, _hashed_silver, _hashed_silver)
    return read_silver(spark, layout.at("silver")).drop("processed_at")


@query
def table_silver_by_simulation(spark, directory):
    layout = lakehouse(spark, directory, _silver_by_simulation)
    return read_silver(spark, layout.at("silver")).drop("processed_at")


@query
def table_silver_incremental(spark, directory):
    """Silver from overlapping slices of steps, one of them delivered twice; buckets hold many simulations."""
    rows = stage(silver(spark, directory).union().withColumn("processed_at", F.current_timestamp()), "silver-rows")
    slices = [F.col("step") < 250, F.col("step").between(200, 450), F.col("step") < 250, F.col("step") > 400]
    path = fresh_path(spark, "silver")
    for chosen in slices:
        write_silver(rows.where(chosen), path, layout="hashed")
    return read_silver(spark, path).drop("processed_at")


@query
def table_quarantine(spark, directory):
    layout = lakehouse(spark, directory, _hashed_silver)
    return read_table(spark, layout.at("quarantine")).drop("processed_at")


@query
def table_metrics(spark, directory):
    layout = lakehouse(spark, directory, _hashed_silver)
    return read_table(spark, layout.at("metrics")).drop("check_time")


@query
def table_gold(spark, directory):
    layout = lakehouse(spark, directory, _hashed_silver, _exact_gold)
    return rounded(read_table(spark, layout.at("gold")), FEATURE_PLACES)


@query
def table_gold_incremental(spark, directory):
    """Gold after two slices of Silver: every row of some simulations, then the rest and part of the first again."""
    layout = medallion.Layout(fresh_path(spark, "lakehouse"))
    rows = silver(spark, directory).union().withColumn("processed_at", F.current_timestamp())
    first = F.pmod(F.xxhash64("simulation_id"), F.lit(3)) > 0
    for chosen in (first & (F.col("step") < 400), ~first | (F.col("step") > 300)):
        delivered = stage(rows.where(chosen), "delivered")
        note_changes(delivered, layout.at("silver_changes"))
        write_silver(delivered, layout.at("silver"))
        incremental.run_gold(spark, layout, True, lambda lanes: rounded(medallion.rated_features(lanes), {"future_wear_rate": 12}))
    return rounded(incremental.read_folders(spark, layout.at("gold_by_simulation")), FEATURE_PLACES)


@query
def table_split(spark, directory):
    """Rows of the dataset, train and test tables per simulation."""
    layout = lakehouse(spark, directory, _hashed_silver, _exact_gold, medallion.run_dataset, medallion.run_split)
    parts = [
        spark.read.parquet(layout.at(f"dataset/{part}")).select(F.lit(part).alias("part"), "simulation_id")
        for part in ("full", "train", "test")
    ]
    rows = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return rows.groupBy("part", "simulation_id").agg(F.count(F.lit(1)).alias("part_rows"))


@query
def stream_bronze_append(spark, directory):
    rows = as_stream(kafka_rows(spark, directory), "messages")
    path = streamed(spark, "bronze", lambda to, log: ingest.ingest_bronze(rows, to, log, True).awaitTermination())
    return read_bronze(spark, path)


@query
def stream_silver_split(spark, directory):
    """Valid, quarantined and lost rows per table, from JSON events in micro-batches."""

    def texts(rows: DataFrame) -> DataFrame:
        return event_texts(rows).select(
            F.lit(None).cast("timestamp").alias("kafka_ts"),
            F.lit(0).cast("long").alias("partition"),
            F.lit(0).cast("long").alias("offset"),
            "raw_event",
        )

    stream = as_stream(telemetry(spark, directory).union(), "raw-events", texts)

    def run(path: str, log: str) -> None:
        parts = [f"{path}/{part}" for part in ("silver", "quarantine", "metrics")]
        ingest.split_stream(stream, *parts, log, bounded=True).awaitTermination()

    path = streamed(spark, "split", run)
    counts = [
        spark.read.parquet(f"{path}/{part}").select(F.lit(part).alias("part"), "simulation_id")
        for part in ("silver", "quarantine")
    ]
    return counts[0].unionByName(counts[1]).groupBy("part", "simulation_id").agg(F.count(F.lit(1)).alias("part_rows"))


@query
def stream_session_stats(spark, directory):
    samples = telemetry(spark, directory, extended=True).union()
    stream = as_stream(samples.select("simulation_id", "step", "speed_kmh", "fuel_rate_lph", "engine_wear"), "samples")

    def run(path: str, log: str) -> None:
        live_streams.update_table(live_streams.session_counters(stream), path, log, True).awaitTermination()

    with settings(spark, **stateful(spark, directory)):
        path = streamed(spark, "session-stats", run)
    return rounded(live_streams.current_rows(spark, path), {"avg_speed_kmh": 6, "avg_fuel_lph": 3})


@query
def stream_latest_state(spark, directory):
    stream = as_stream(telemetry(spark, directory).union(), "state-samples")

    def run(path: str, log: str) -> None:
        live_streams.update_table(live_streams.latest_states(stream), path, log, True).awaitTermination()

    with settings(spark, **stateful(spark, directory)):
        path = streamed(spark, "latest-state", run)
    return live_streams.current_rows(spark, path)


@query
def stream_history(spark, directory):
    stream = as_stream(telemetry(spark, directory).union(), "history-samples")

    def run(path: str, log: str) -> None:
        live_streams.keep_history(stream, path, log, True).awaitTermination()

    return live_streams.current_history(spark, streamed(spark, "history", run))


@query
def stream_serving_features(spark, directory):
    stream = by_step(serving.live_samples(telemetry(spark, directory).union()), "live-samples")

    def run(path: str, log: str) -> None:
        streams.append_parquet(serving.serving_features(stream), path, log, True).awaitTermination()

    with settings(spark, **stateful(spark, directory)):
        path = streamed(spark, "serving", run)
    return rounded(spark.read.parquet(path), SERVING_PLACES)


@query
def stream_serving_features_gaps(spark, directory):
    """Every third step never comes: windows still hold 300 rows, and a closing pass adds the end of each simulation."""
    samples = serving.live_samples(telemetry(spark, directory).union()).where("step % 3 <> 2")
    stream = by_step(samples, "gapped-samples")

    def run(path: str, log: str) -> None:
        streams.append_parquet(serving.serving_features(stream), path, log, True).awaitTermination()

    with settings(spark, **stateful(spark, directory)):
        path = streamed(spark, "serving-gaps", run)
        closing = stage(serving.closing_features(spark, f"{path}.checkpoint"), "closing-features")
    return rounded(spark.read.parquet(path).unionByName(closing), SERVING_PLACES)


@query
def stream_score_ema(spark, directory):
    """Scores as a prediction stream would deliver them, smoothed with keyed state."""
    scored = predictions(spark, directory).union().select("simulation_id", "step", "score")
    stream = by_step(scored, "scores")

    def run(path: str, log: str) -> None:
        streams.append_parquet(serving.smoothed_scores(stream), path, log, True).awaitTermination()

    with settings(spark, **stateful(spark, directory)):
        path = streamed(spark, "smoothed", run)
    return rounded(spark.read.parquet(path), {"display_score": 6}).select("simulation_id", "step", "display_score")


@query
def stream_live_coaching(spark, directory):
    """JSON events to predictions to coaching output, by two streams with a table between them."""
    model, _ = _forest(spark, directory)
    numbered = raw_events(spark, directory).select(F.col("raw_event").alias("value"), F.get_json_object("raw_event", "$.payload.step").cast("int").alias("step"))
    messages = by_step(numbered, "live-messages")

    def scoring(path: str, log: str) -> None:
        serving.start_scoring(messages, model, path, log, True).awaitTermination()

    def coaching(path: str, log: str) -> None:
        predicted = streams.file_stream(spark, scored, spark.read.parquet(scored).schema)
        serving.start_coaching(predicted, path, log, True).awaitTermination()

    with settings(spark, **stateful(spark, directory)):
        scored = streamed(spark, "scored", scoring)
        coached = streamed(spark, "coached", coaching)
    score, shown = F.col("score"), F.col("display_score")
    return spark.read.parquet(coached).select(
        "simulation_id",
        "step",
        score.between(0, 100).alias("score_in_range"),
        (shown.between(0, 100) & (shown >= score * 0.3 - 1e-9)).alias("display_fits"),
        ((F.col("status_name") == "DANGER") == (score > 70)).alias("tier_fits"),
    )


@query
def stream_chained_coaching(spark, directory):
    """JSON events to coaching output by one query of two stateful operators, neutral rows while the buffer fills."""
    model, _ = _forest(spark, directory)
    numbered = raw_events(spark, directory).select(F.col("raw_event").alias("value"), F.get_json_object("raw_event", "$.payload.step").cast("int").alias("step"))
    messages = by_step(numbered, "chained-messages")

    def run(path: str, log: str) -> None:
        serving.start_live_coaching(messages, model, path, log, True).awaitTermination()

    with settings(spark, **stateful(spark, directory)):
        path = streamed(spark, "chained", run)
    score, shown, full = F.col("score"), F.col("display_score"), F.col("progress_pct") >= 100
    return spark.read.parquet(path).select(
        "simulation_id",
        "step",
        F.when(~full, F.col("display_text")).alias("warmup_text"),
        (score.between(0, 100) & (full | (score == 0))).alias("score_in_range"),
        (shown.between(0, 100) & (shown >= score * 0.3 - 1e-9)).alias("display_fits"),
        ((F.col("status_name") == "DANGER") == (score > 70)).alias("tier_fits"),
    )


def timed_bronze(spark: SparkSession, directory: str) -> DataFrame:
    """Bronze rows of the recorded telemetry whose events are sent a second after the other; ``step`` beside them."""
    sent = F.col("step").cast("double") + 1_704_067_200
    name = F.concat_ws("-", "simulation_id", F.col("step").cast("string"))
    event = events.telemetry_event(SILVER_PATHS, event_id=name, timestamp=sent)
    meta = [F.lit(None).cast("timestamp").alias("kafka_ts"), F.lit(0).cast("long").alias("partition"), F.lit(0).cast("long").alias("offset")]
    return telemetry(spark, directory).union().select(*meta, F.to_json(event).alias("raw_event"), "step")


def with_repeats(rows: DataFrame, step: str, share: int = 3) -> DataFrame:
    """Every ``share``-th row is delivered again, one span of steps later."""
    again = rows.where(F.pmod(F.xxhash64("raw_event"), F.lit(share)) == 0).withColumn(step, F.col(step) + STEP_SPAN)
    return rows.unionByName(again)


@query
def stream_deduplicated(spark, directory):
    """Events as a stream in which a third comes again in a later micro-batch."""
    event = events.envelope(
        "simulation.raw", F.struct("user_id", "value"), F.col("event_id").cast("string"), F.unix_micros(F.col("ts").cast("timestamp")) / 1e6
    )
    rows = table(spark, directory, "events")
    bronze = rows.select(
        F.col("ts").cast("timestamp").alias("kafka_ts"),
        F.lit(0).cast("long").alias("partition"),
        F.col("event_id").alias("offset"),
        F.to_json(event).alias("raw_event"),
        (F.floor(F.col("event_id") * 8 / rows.count()) * STEP_SPAN).cast("int").alias("step"),
    )
    stream = by_step(with_repeats(bronze, "step"), "redelivered", files=1)

    def run(path: str, log: str) -> None:
        streams.append_json(ingest.deduplicated_events(stream.drop("step"), "10 days"), path, log, True).awaitTermination()

    with settings(spark, **stateful(spark, directory, "events")):
        path = streamed(spark, "deduplicated", run)
    kind = "event_id string, payload struct<user_id: long, value: double>"
    return read_bronze(spark, path).select(F.from_json("raw_event", kind).alias("e")).select("e.event_id", "e.payload.user_id", "e.payload.value")


@query
def stream_silver_merged(spark, directory):
    """Silver from a stream that is stopped, started again and given a batch it has applied; steps overlap."""
    rows = timed_bronze(spark, directory)
    source, root = fresh_path(spark, "merged-events"), fresh_path(spark, "merged")
    tables_ = [f"{root}/{part}" for part in ("silver", "quarantine", "metrics")]
    each = files_for(table(spark, directory, "lineitem").count(), 6)
    for low, high in ((0, 250), (200, 450), (400, 10**6)):
        part = rows.where(F.col("step").between(low, high)).drop("step")
        part.repartition(2 * each).write.mode("append").parquet(source)
        stream = streams.file_stream(spark, source, part.schema, max_files=each)
        ingest.merge_stream(stream, *tables_, f"{root}/log", bounded=True).awaitTermination()
    last = spark.read.parquet(f"{tables_[0]}.applied").first()
    if ingest.merge_batch(rows.drop("step").limit(0), last["batch_id"], last["query_id"], *tables_, False, "hashed"):
        raise ValueError("a batch was applied twice")
    return read_silver(spark, tables_[0]).drop("processed_at")


@query
def stream_dq_per_minute(spark, directory):
    """Quality counts per minute of event time, closed by the watermark or still open in the state; copies count once."""
    rows = with_repeats(timed_bronze(spark, directory), "step")
    stream = by_step(rows, "timed-events").drop("step")

    def run(path: str, log: str) -> None:
        ingest.start_window_metrics(stream, path, log, bounded=True, delay="8 minutes").awaitTermination()

    with settings(spark, **stateful(spark, directory)):
        path = streamed(spark, "dq-minutes", run)
        still_open = stage(ingest.open_windows(spark, f"{path}.checkpoint"), "open-windows")
    return spark.read.parquet(path).drop("batch_id").unionByName(still_open)


@query
def dq_sliding(spark, directory):
    """Quality counts over two minutes, every thirty seconds."""
    parsed = quality.parse_events(timed_bronze(spark, directory))
    timed = parsed.withColumn("sent_at", F.timestamp_seconds("parsed.timestamp"))
    return quality.metrics_per_window(quality.check_quality(quality.flatten_events(timed, also=("sent_at",))), "sent_at", "2 minutes", "30 seconds")


TRIP_PAUSE_HOURS = 6


def trip_samples(spark: SparkSession, directory: str) -> DataFrame:
    """Events as samples of their user."""
    return table(spark, directory, "events").select(
        F.col("user_id").cast("string").alias("simulation_id"), F.col("ts").cast("timestamp").alias("ts"), "value"
    )


@query
def trips_by_pause(spark, directory):
    """Trips of the users' events, in either lane."""
    timed = trip_samples(spark, directory).select("simulation_id", F.unix_micros("ts").alias("at"), "value")
    found = []
    for conf in ({}, {"spark__tachyline__longKeyRows": "10", "spark__tachyline__blockRows": "16"}):
        with settings(spark, **conf):
            found.append(stage(Lanes.of(timed).map(lambda df, lane: sessions.trips(df, TRIP_PAUSE_HOURS * 3600, lane)).union(), "trips"))
    lanes = [df.withColumn("lane", F.lit(name)) for name, df in zip(("short", "long"), found, strict=True)]
    return lanes[0].unionByName(lanes[1])


@query
def stream_trips(spark, directory):
    """The same trips by session windows over a stream; a sample of nobody, a year later, closes the last ones."""
    samples = trip_samples(spark, directory).withColumn("step", F.floor(F.unix_seconds("ts") / 86_400).cast("int") - 19_723)
    end = samples.agg((F.max("ts") + F.expr("INTERVAL 365 DAYS")).alias("ts"), (F.max("step") + STEP_SPAN).alias("step"))
    samples = samples.unionByName(end.select(F.lit(None).cast("string").alias("simulation_id"), "ts", F.lit(0.0).alias("value"), "step"))
    stream = by_step(samples, "trip-samples", span=4, files=1).drop("step")

    def run(path: str, log: str) -> None:
        trips = live_streams.paused_trips(stream, f"{TRIP_PAUSE_HOURS} hours", "5 days")
        streams.append_parquet(trips, path, log, True).awaitTermination()

    with settings(spark, spark__sql__shuffle__partitions="8"):
        path = streamed(spark, "trips", run)
    return spark.read.parquet(path).where("simulation_id IS NOT NULL")
