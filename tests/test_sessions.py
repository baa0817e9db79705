import math

import pytest
from pyspark.sql import functions as F

from tachyline.functions import driving, events
from tachyline.functions.numbers import steady_round
from tachyline.operators import evaluation, sessions
from tachyline.operators.lanes import SHORT, LongLane


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def samples(spark, name, values, kind="double"):
    return spark.createDataFrame([("s", n, v) for n, v in enumerate(values)], f"simulation_id string, step int, {name} {kind}")


def column(df, name):
    return [row[name] for row in df.orderBy("step").collect()]


@pytest.mark.parametrize("lane", [SHORT, LongLane(256)])
@pytest.mark.parametrize("weight", [0.3, 0.05, 0.9])
def test_smoothing_equals_the_recursion(spark, lane, weight):
    values = [math.sin(n) * 50 + n % 13 for n in range(700)]
    expected, y = [], 5.0
    for x in values:
        y = (1 - weight) * y + weight * x
        expected.append(y)
    made = sessions.smoothed(samples(spark, "x", values), F.col("x"), "y", lane, weight, initial=5.0)
    assert column(made, "y") == pytest.approx(expected, rel=1e-11, abs=1e-9)
    assert made.columns == ["simulation_id", "step", "x", "y"]


@pytest.mark.parametrize("lane", [SHORT, LongLane(4)])
def test_fan_holds_between_its_limits(spark, lane):
    temps = [100.0, 103.0, 99.0, 97.0, None, 95.0, 98.0, 102.0, 102.5]
    made = sessions.fan_state(samples(spark, "coolant_temp_c", temps), lane)
    assert column(made, "fan_active") == [False, True, True, True, True, False, False, False, True]


@pytest.mark.parametrize("lane", [SHORT, LongLane(2)])
def test_gear_changes_and_stays(spark, lane):
    df = samples(spark, "current_gear", [1, 1, 2, 2, 2, 1], "int")
    assert column(sessions.shift_events(df, lane), "step") == [2, 5]
    stays = sessions.gear_dwell(df, lane).orderBy("first_step").collect()
    assert [(row["current_gear"], row["dwell_rows"]) for row in stays] == [(1, 2), (2, 3), (1, 1)]


def test_running_means_count_missing_values_as_zero(spark):
    made = sessions.running_means(samples(spark, "speed_kmh", [10.0, None, 20.0]), {"speed_kmh": "mean"})
    assert column(made, "mean") == [10.0, 5.0, 10.0]


def test_history_and_latest_state(spark):
    rows = [("s", n, n * 0.1, None if n == 399 else 1000.0, None, 5.0) for n in range(400)]
    df = spark.createDataFrame(
        rows, "simulation_id string, step int, simulation_time double, engine_rpm double, current_gear int, speed_kmh double"
    )
    kept = sessions.history(df).orderBy("step").collect()
    assert len(kept) == 300 and kept[0]["step"] == 100
    assert (kept[-1]["rpm"], kept[-1]["gear"]) == (0.0, 0)
    assert sessions.latest_state(df).first()["step"] == 399


def test_throttle_rate_guards_against_standing_time(spark):
    rows = [("s", 0, 0.0, 0.1), ("s", 1, 0.1, 0.3), ("s", 2, 0.1, 0.4)]
    df = spark.createDataFrame(rows, "simulation_id string, step int, simulation_time double, throttle double")
    assert column(sessions.throttle_rate(df), "throttle_change_rate") == [None, pytest.approx(2.0), pytest.approx(1000.0)]


@pytest.mark.parametrize(
    ("score", "status", "key"),
    [(70.1, "DANGER", "aggressive"), (70.0, "CAUTION", "normal"), (30.1, "CAUTION", "normal"), (30.0, "OPTIMAL", "calm")],
)
def test_coaching_tiers(spark, score, status, key):
    made = {name: value(spark, c) for name, c in driving.coaching(F.lit(score)).items()}
    assert (made["status_name"], made["style_key"]) == (status, key)
    risk = 1 + (score / 25) ** 2
    assert made["display_text"] == f"STATUS: {status}\nAI LOAD: {int(score)}%\nWEAR RATE: {risk:.1f}x"


def test_texts(spark):
    assert value(spark, driving.warmup_text(F.lit(50.0))) == "AI is warming up...\nProgress: 50%"
    log = value(spark, driving.prediction_log(F.lit("normal"), F.lit(25.0)))
    assert log == "[AI] NORMAL | AGG: 25.0% | RISK: 2.0x"
    assert [value(spark, driving.gear_text(F.lit(g))) for g in (-1, 0, 3)] == ["N", "N", "D3"]


@pytest.mark.parametrize(("p", "label", "confidence"), [(0.5, "NORMAL", 0.5), (0.8, "AGGRESSIVE", 0.8), (0.1, "NORMAL", 0.9)])
def test_decision(spark, p, label, confidence):
    made = {name: value(spark, c) for name, c in driving.decision(F.lit(p)).items()}
    assert made == {"label": label, "score": pytest.approx(p * 100), "confidence": pytest.approx(confidence)}


def test_zones_and_clamp(spark):
    zones = [value(spark, driving.rpm_zone(F.lit(rpm))) for rpm in (5119.0, 5120.0, 6399.0, 6400.0)]
    assert zones == ["green", "yellow", "yellow", "red"]
    controls = [F.lit(v).cast("double") for v in (-1, 0.5, 2, None)]
    assert [value(spark, events.clamp_unit(c)) for c in controls] == [0.0, 0.5, 1.0, None]


def test_envelope_defaults(spark):
    given = events.envelope("t", F.struct(F.lit(1).alias("a")), F.lit("id"), F.lit(7.5))
    row = value(spark, given)
    assert (row["event_id"], row["timestamp"], row["event_version"]) == ("id", 7.5, 1)
    made = value(spark, events.envelope("t", F.struct(F.lit(1).alias("a")), F.lit(""), F.lit(0.0)))
    assert len(made["event_id"]) == 36 and made["timestamp"] > 1.6e9


def test_report_by_hand(spark):
    pairs = [("A", "A")] * 3 + [("A", "B")] * 1 + [("B", "A")] * 2 + [("B", "B")] * 4 + [("C", "B")] * 1
    df = spark.createDataFrame(pairs, "driving_style string, prediction string")
    rows = {row["class"]: row for row in evaluation.classification_report(df).collect()}
    assert rows["A"]["precision"] == pytest.approx(3 / 5) and rows["A"]["recall"] == pytest.approx(3 / 4)
    assert (rows["C"]["precision"], rows["C"]["recall"], rows["C"]["f1"], rows["C"]["support"]) == (0.0, 0.0, 0.0, 1)
    assert rows["macro avg"]["recall"] == pytest.approx((3 / 4 + 4 / 6 + 0) / 3)
    assert rows["weighted avg"]["recall"] == pytest.approx(7 / 11)
    assert evaluation.accuracy(df).first()[0] == pytest.approx(7 / 11)


def test_balanced_class_weights(spark):
    df = spark.createDataFrame([("A",)] * 3 + [("B",)], "driving_style string")
    weights = {row["driving_style"]: row["class_weight"] for row in evaluation.class_weights(df).collect()}
    assert weights == {"A": pytest.approx(4 / 6), "B": pytest.approx(2.0)}


def test_steady_round_sends_noisy_ties_up(spark):
    for v in (0.0000005, 0.00000049999999999, 0.00000050000000001):
        assert value(spark, steady_round(F.lit(v), 6)) == 1e-6
