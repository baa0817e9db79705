import json

import pytest

from tachyline.operators import quality
from tachyline.schemas import QUALITY_FLAGS, SILVER_COLUMNS

GOOD = {
    "engine": {"engine_rpm": 1200.0},
    "thermals": {"coolant_temp_c": 20.5, "oil_temp_c": 20.1},
    "gearbox": {"current_gear": 1},
    "vehicle": {"speed_kmh": 3.2, "load": 0.4, "mass_kg": 1450},
    "driver": {"throttle": 0.2, "brake": 0.0, "throttle_rate": 0.1},
    "wear": {"engine_wear": 0.0001, "gearbox_wear": 0.0},
}


def event(**changed):
    modules = {name: dict(fields) for name, fields in GOOD.items()}
    for path, value in changed.items():
        module, _, field = path.partition("__")
        modules[module][field] = value
    payload = {"simulation_id": "sim-1", "time": 0.1, "step": 1, "modules": modules}
    return json.dumps({"event_type": "simulation.raw", "event_version": 1, "event_id": "e", "timestamp": 1.5, "payload": payload})


def checked(spark, *texts):
    df = spark.createDataFrame([(text,) for text in texts], "raw_event string")
    return quality.check_quality(quality.flatten_events(quality.parse_events(df)))


def verdict(spark, text):
    return checked(spark, text).first()


def test_a_good_event_is_flattened(spark):
    row = verdict(spark, event())
    assert (row["simulation_id"], row["step"], row["simulation_time"], row["engine_rpm"]) == ("sim-1", 1, 0.1, 1200.0)
    assert row["is_valid"] is True and row["processed_at"] is not None
    assert list(row.asDict())[: len(SILVER_COLUMNS)] == SILVER_COLUMNS


@pytest.mark.parametrize("text", ["not json", None, "", "[]", "{}"])
def test_unreadable_text_is_quarantined(spark, text):
    row = verdict(spark, text)
    assert row["is_null_violation"] is True and row["is_valid"] is False


def test_a_wrong_type_loses_that_field_only(spark):
    row = verdict(spark, event(engine__engine_rpm="x"))
    assert row["engine_rpm"] is None and row["speed_kmh"] == 3.2 and row["is_valid"] is False


def test_a_missing_unchecked_value_leaves_the_verdict_open(spark):
    for field in ("driver__throttle", "thermals__coolant_temp_c"):
        row = verdict(spark, event(**{field: None}))
        assert row["is_null_violation"] is False
        assert row["is_range_violation"] is None and row["is_valid"] is None


def test_a_definite_violation_outweighs_a_missing_value(spark):
    assert verdict(spark, event(driver__throttle=None, engine__engine_rpm=-1.0))["is_valid"] is False
    row = verdict(spark, event(driver__throttle=None, engine__engine_rpm=None))
    assert row["is_null_violation"] is True and row["is_valid"] is False


@pytest.mark.parametrize(
    ("field", "inside", "outside"),
    [
        ("engine__engine_rpm", [0.0, 10000.0], [-0.1, 10000.1]),
        ("vehicle__speed_kmh", [0.0, 500.0], [-0.1, 500.1]),
        ("driver__throttle", [0.0, 1.1], [-0.1, 1.11]),
        ("thermals__coolant_temp_c", [-50.0, 250.0], [-50.1, 250.1]),
    ],
)
def test_range_bounds_are_inclusive(spark, field, inside, outside):
    rows = checked(spark, *[event(**{field: value}) for value in inside + outside]).collect()
    assert [row["is_valid"] for row in rows] == [True, True, False, False]


def test_split_and_metrics_add_up(spark):
    df = checked(spark, event(), event(driver__throttle=None), "not json", event(engine__engine_rpm=-1.0)).cache()
    valid, bad = quality.valid_rows(df), quality.quarantined_rows(df)
    assert not set(QUALITY_FLAGS) & set(valid.columns) and set(QUALITY_FLAGS) <= set(bad.columns)
    assert (valid.count(), bad.count(), quality.quarantined_rows(df, strict=True).count()) == (1, 2, 3)
    metrics = quality.quality_metrics(df).first()
    assert (metrics["total_rows"], metrics["null_violations"], metrics["range_violations"], metrics["invalid_rows"]) == (4, 1, 1, 2)
    assert metrics["dataset"] == "silver_telemetry"
    assert quality.undetermined_count(df).first()[0] == 1


def test_metrics_of_nothing(spark):
    metrics = quality.quality_metrics(checked(spark, event()).limit(0)).first()
    assert metrics["total_rows"] == 0 and metrics["null_violations"] is None and metrics["invalid_rows"] is None


def test_copies_are_kept_once(spark):
    df = quality.valid_rows(checked(spark, event(), event(), event()))
    assert quality.deduplicated(df).count() == 1


def test_raw_text_can_be_kept(spark):
    df = spark.createDataFrame([("not json",)], "raw_event string")
    kept = quality.flatten_events(quality.parse_events(df), keep_raw=True).first()
    assert kept["raw_event"] == "not json"
