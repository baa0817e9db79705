"""Event envelopes, routing, control clamping and missing-field defaults."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from tachyline.schemas import COMMAND_EVENT, EVENT_VERSION, RAW_EVENT, SILVER_PATHS

# Defaults for fields missing from an event, and the nominal maximum engine speed.
FIELD_DEFAULTS = {
    "engine_rpm": 0.0,
    "speed_kmh": 0.0,
    "coolant_temp_c": 0.0,
    "fuel_rate_lph": 0.0,
    "engine_wear": 0.0,
    "throttle": 0.0,
    "current_gear": 0,
}


def now_seconds() -> Column:
    return F.unix_micros(F.current_timestamp()) / 1e6


def envelope(
    event_type: str,
    payload: Column,
    event_id: Column | None = None,
    timestamp: Column | None = None,
) -> Column:
    """Event struct; an empty id becomes a fresh UUID, an empty or zero time the current one."""
    given_id = F.lit(None).cast("string") if event_id is None else event_id
    given_time = F.lit(None).cast("double") if timestamp is None else timestamp
    return F.struct(
        F.lit(event_type).alias("event_type"),
        F.lit(EVENT_VERSION).alias("event_version"),
        payload.alias("payload"),
        F.coalesce(F.when(given_id != "", given_id), F.uuid()).alias("event_id"),
        F.coalesce(F.when(given_time != 0, given_time), now_seconds()).alias("timestamp"),
    )


def _nest(paths: dict[str, str]) -> list[Column]:
    """Columns rebuilt into the nested structs that ``paths`` describes."""
    inner: dict[str, dict[str, str]] = {}
    for column, path in paths.items():
        head, _, rest = path.partition(".")
        inner.setdefault(head, {})[column] = rest
    return [
        (F.struct(*_nest(rest)) if all(rest.values()) else F.col(next(iter(rest)))).alias(head)
        for head, rest in inner.items()
    ]


def telemetry_payload(paths: dict[str, str] = SILVER_PATHS) -> Column:
    """Flat Silver columns as the nested payload of a telemetry event."""
    return F.struct(*_nest(paths))


def telemetry_event(paths: dict[str, str] = SILVER_PATHS, **given: Column) -> Column:
    return envelope(RAW_EVENT, telemetry_payload(paths), **given)


def command_event(throttle: Column, brake: Column, **given: Column) -> Column:
    return envelope(COMMAND_EVENT, F.struct(throttle.alias("pedal"), brake.alias("brake")), **given)


def is_routed(event_type: str, require_payload: bool = True) -> Column:
    """Events of one type; the dashboard also skips empty payloads, the command listener does not."""
    matches = F.col("event_type") == event_type
    return matches & F.col("payload").isNotNull() if require_payload else matches


def clamp_unit(control: Column) -> Column:
    """Control value limited to [0, 1]; NULL stays NULL and means "no change"."""
    return F.when(control.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(1.0), control)))


def with_default(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(FIELD_DEFAULTS[name])).alias(name)
