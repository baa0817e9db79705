"""Table schemas, the feature contract and the fixed parameters of the data model."""

from pyspark.sql import types as T

# The column contract shared by feature engineering, training and serving.
META_COLUMNS = ["simulation_id", "step"]
FEATURE_COLUMNS = [
    "rpm_avg_10s",
    "rpm_std_10s",
    "throttle_avg_10s",
    "engine_load_avg_10s",
    "power_factor",
    "speed_kmh",
    "rpm_range_10s",
    "current_gear",
    "load_max_10s",
]
TARGET_COLUMN = "driving_style"
DATASET_COLUMNS = META_COLUMNS + FEATURE_COLUMNS + [TARGET_COLUMN]

# Labels, event types, topics.
AGGRESSIVE = "AGGRESSIVE"
NORMAL = "NORMAL"
RAW_EVENT = "simulation.raw"
COMMAND_EVENT = "driver.command"
RAW_TOPIC = "simulation.raw"
COMMAND_TOPIC = "driver.commands"
EVENT_VERSION = 1
METRICS_DATASET = "silver_telemetry"

# Window sizes (rows) and label parameters.
TICKS_PER_SECOND = 10
WEAR_WINDOW_SECONDS = 10
WEAR_LAG_ROWS = TICKS_PER_SECOND * WEAR_WINDOW_SECONDS
LOOK_AHEAD_ROWS = 30
SERVING_ROWS = 300
LABEL_QUANTILE = 0.75
LABEL_FALLBACK = 0.0005
TRAIN_RATIO = 0.8

QUALITY_FLAGS = ["is_null_violation", "is_range_violation", "is_logical_violation", "is_valid"]


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


_DOUBLE, _INT, _STRING = T.DoubleType(), T.IntegerType(), T.StringType()


def _event(payload: T.StructType) -> T.StructType:
    return _struct(
        event_type=_STRING,
        event_version=_INT,
        event_id=_STRING,
        timestamp=_DOUBLE,
        payload=payload,
    )


def raw_event_schema(extended: bool = False) -> T.StructType:
    """Parse schema of a telemetry event.

    ``extended`` adds the payload fields that live statistics use but Silver
    does not keep: the fuel rate and the pedal position.
    """
    engine = {"engine_rpm": _DOUBLE}
    driver = {"throttle": _DOUBLE, "brake": _DOUBLE, "throttle_rate": _DOUBLE}
    if extended:
        engine["fuel_rate_lph"] = _DOUBLE
        driver["pedal"] = _DOUBLE
    modules = _struct(
        engine=_struct(**engine),
        thermals=_struct(coolant_temp_c=_DOUBLE, oil_temp_c=_DOUBLE),
        gearbox=_struct(current_gear=_INT),
        vehicle=_struct(speed_kmh=_DOUBLE, load=_DOUBLE),
        driver=_struct(**driver),
        wear=_struct(engine_wear=_DOUBLE, gearbox_wear=_DOUBLE),
    )
    payload = _struct(simulation_id=_STRING, time=_DOUBLE, step=_INT, modules=modules)
    return _event(payload)


COMMAND_EVENT_SCHEMA = _event(_struct(pedal=_DOUBLE, brake=_DOUBLE))

BRONZE_SCHEMA = _struct(
    kafka_ts=T.TimestampType(),
    partition=T.LongType(),
    offset=T.LongType(),
    raw_event=_STRING,
)

# Silver column -> path inside the event payload, in table order.
SILVER_PATHS = {
    "simulation_id": "simulation_id",
    "step": "step",
    "simulation_time": "time",
    "engine_rpm": "modules.engine.engine_rpm",
    "speed_kmh": "modules.vehicle.speed_kmh",
    "load": "modules.vehicle.load",
    "throttle": "modules.driver.throttle",
    "brake": "modules.driver.brake",
    "throttle_rate": "modules.driver.throttle_rate",
    "current_gear": "modules.gearbox.current_gear",
    "coolant_temp_c": "modules.thermals.coolant_temp_c",
    "oil_temp_c": "modules.thermals.oil_temp_c",
    "engine_wear": "modules.wear.engine_wear",
    "gearbox_wear": "modules.wear.gearbox_wear",
}
EXTENDED_PATHS = {
    "fuel_rate_lph": "modules.engine.fuel_rate_lph",
    "pedal": "modules.driver.pedal",
}
SILVER_COLUMNS = list(SILVER_PATHS)

_SILVER_TYPES = {"simulation_id": _STRING, "step": _INT, "current_gear": _INT}
SILVER_SCHEMA = _struct(
    **{name: _SILVER_TYPES.get(name, _DOUBLE) for name in SILVER_COLUMNS},
    processed_at=T.TimestampType(),
)

METRICS_SCHEMA = _struct(
    total_rows=T.LongType(),
    null_violations=T.LongType(),
    range_violations=T.LongType(),
    invalid_rows=T.LongType(),
    dataset=_STRING,
    check_time=T.TimestampType(),
)
