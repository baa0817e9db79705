"""The registered queries written as plain SQL over the same tables."""


def rounded(expression: str, places: int) -> str:
    return f"floor(({expression}) * 1e{places} + 0.501) / 1e{places}"


_W = "PARTITION BY simulation_id ORDER BY step"
_FRAME = f"({_W} ROWS BETWEEN 100 PRECEDING AND CURRENT ROW)"
_BY_STEP = f"({_W} RANGE BETWEEN 100 PRECEDING AND CURRENT ROW)"
_BUFFER = f"({_W} ROWS BETWEEN 299 PRECEDING AND CURRENT ROW)"
_SO_FAR = f"({_W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"

# Each name is a common table expression that may use the ones above it.
_TABLES = {
    "telemetry": """
    SELECT CAST(l_suppkey AS VARCHAR) AS simulation_id,
           CAST(row_number() OVER w - 1 AS INTEGER) AS step,
           (row_number() OVER w - 1) * CAST(0.1 AS DOUBLE) AS simulation_time,
           CASE WHEN l_partkey % 101 = 0 THEN CAST(-1 AS DOUBLE)
                WHEN l_partkey % 103 = 0 THEN NULL
                ELSE l_extendedprice / 16 END AS engine_rpm,
           l_quantity * 4 AS speed_kmh,
           l_quantity / 64 AS load,
           CASE WHEN l_orderkey % 109 = 0 THEN NULL ELSE l_discount * 10 END AS throttle,
           l_tax * 10 AS brake,
           l_discount - l_tax AS throttle_rate,
           l_linenumber AS current_gear,
           CASE WHEN l_partkey % 107 = 0 THEN CAST(300 AS DOUBLE)
                ELSE 20 + l_quantity * CAST(1.5 AS DOUBLE) END AS coolant_temp_c,
           15 + l_quantity * CAST(2.25 AS DOUBLE) AS oil_temp_c,
           sum(l_quantity / 65536) OVER (w ROWS UNBOUNDED PRECEDING) AS engine_wear,
           CAST(0 AS DOUBLE) AS gearbox_wear,
           l_extendedprice / 2048 AS fuel_rate_lph,
           l_discount * 10 AS pedal
    FROM lineitem
    WINDOW w AS (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_partkey, l_shipdate)""",
    "flagged": """
    SELECT *,
           (simulation_id IS NULL OR step IS NULL OR engine_rpm IS NULL OR speed_kmh IS NULL) AS is_null_violation,
           (engine_rpm < 0 OR engine_rpm > 10000 OR speed_kmh < 0 OR speed_kmh > 500
            OR throttle < 0 OR throttle > CAST(1.1 AS DOUBLE)
            OR coolant_temp_c < -50 OR coolant_temp_c > 250) AS is_range_violation,
           FALSE AS is_logical_violation
    FROM telemetry""",
    "checked": "SELECT *, NOT (is_null_violation OR is_range_violation OR is_logical_violation) AS is_valid FROM flagged",
    "silver": "SELECT * FROM checked WHERE is_valid",
    "lagged": f"""
    SELECT *, (engine_wear - lag(engine_wear, 100) OVER ({_W})) / CAST(10 AS DOUBLE) AS wear_rate_10s
    FROM silver""",
    "rates": f"""
    SELECT *, avg(wear_rate_10s) OVER ({_W} ROWS BETWEEN CURRENT ROW AND 30 FOLLOWING) AS future_wear_rate
    FROM lagged""",
    "base": f"""
    SELECT *, {rounded("future_wear_rate", 12)} AS steady_rate
    FROM rates WHERE future_wear_rate IS NOT NULL""",
    "threshold": "SELECT coalesce(quantile_disc(steady_rate, 0.75), 0.0005) AS p75 FROM base",
    "features": f"""
    SELECT simulation_id, step, steady_rate, speed_kmh, current_gear,
           {rounded(f"avg(engine_rpm) OVER {_FRAME}", 3)} AS rpm_avg_10s,
           {rounded(f"stddev_samp(engine_rpm) OVER {_FRAME}", 3)} AS rpm_std_10s,
           {rounded(f"avg(throttle) OVER {_FRAME}", 6)} AS throttle_avg_10s,
           {rounded(f"avg(load) OVER {_FRAME}", 6)} AS engine_load_avg_10s,
           {rounded("engine_rpm * load", 3)} AS power_factor,
           {rounded(f"max(engine_rpm) OVER {_FRAME} - min(engine_rpm) OVER {_FRAME}", 3)} AS rpm_range_10s,
           max(load) OVER {_FRAME} AS load_max_10s
    FROM base""",
    "gold": """
    SELECT simulation_id, step, rpm_avg_10s, rpm_std_10s, throttle_avg_10s, engine_load_avg_10s, power_factor,
           speed_kmh, rpm_range_10s, current_gear, load_max_10s,
           CASE WHEN steady_rate > p75 THEN 'AGGRESSIVE' ELSE 'NORMAL' END AS driving_style
    FROM features CROSS JOIN threshold""",
    "ids": """
    SELECT simulation_id, row_number() OVER (ORDER BY simulation_id) AS place, count(*) OVER () AS total
    FROM (SELECT DISTINCT simulation_id FROM gold)""",
    "sides": """
    SELECT simulation_id, CASE WHEN place <= greatest(1, floor(total * CAST(0.8 AS DOUBLE))) THEN 'train' ELSE 'test' END AS split
    FROM ids""",
    "train": "SELECT gold.* FROM gold JOIN sides USING (simulation_id) WHERE split = 'train'",
    "predicted": """
    SELECT driving_style, CASE WHEN engine_load_avg_10s > 0.41 THEN 'AGGRESSIVE' ELSE 'NORMAL' END AS prediction
    FROM gold""",
    "per_class": """
    SELECT *, CASE WHEN precision_ + recall_ > 0 THEN 2 * precision_ * recall_ / (precision_ + recall_) ELSE 0 END AS f1_
    FROM (SELECT label, actual,
                 CASE WHEN predicted > 0 THEN CAST(hits AS DOUBLE) / predicted ELSE 0 END AS precision_,
                 CASE WHEN actual > 0 THEN CAST(hits AS DOUBLE) / actual ELSE 0 END AS recall_
          FROM (SELECT label,
                       count(*) FILTER (WHERE driving_style = label) AS actual,
                       count(*) FILTER (WHERE prediction = label) AS predicted,
                       count(*) FILTER (WHERE driving_style = label AND prediction = label) AS hits
                FROM predicted CROSS JOIN (VALUES ('AGGRESSIVE'), ('NORMAL')) AS labels_(label)
                GROUP BY label))""",
    "live": """
    SELECT simulation_id, step, simulation_time, coalesce(engine_rpm, 0) AS engine_rpm, coalesce(throttle, 0) AS throttle,
           coalesce(speed_kmh, 0) AS speed_kmh, coalesce(current_gear, 0) AS current_gear,
           coalesce(throttle, 0) * (coalesce(engine_rpm, 0) / 6500) AS load,
           coalesce(throttle, 0) * 100 AS score
    FROM telemetry""",
    "buffered": f"""
    SELECT *, count(*) OVER {_BUFFER} AS buffered FROM live""",
    "serving": f"""
    SELECT * FROM (
    SELECT simulation_id, step, speed_kmh, current_gear, buffered,
           {rounded(f"avg(engine_rpm) OVER {_BUFFER}", 3)} AS rpm_avg_10s,
           {rounded(f"stddev_samp(engine_rpm) OVER {_BUFFER}", 3)} AS rpm_std_10s,
           {rounded(f"avg(throttle) OVER {_BUFFER}", 6)} AS throttle_avg_10s,
           {rounded(f"avg(load) OVER {_BUFFER}", 6)} AS engine_load_avg_10s,
           {rounded("engine_rpm * load", 3)} AS power_factor,
           {rounded(f"max(engine_rpm) OVER {_BUFFER} - min(engine_rpm) OVER {_BUFFER}", 3)} AS rpm_range_10s,
           {rounded(f"max(load) OVER {_BUFFER}", 6)} AS load_max_10s
    FROM buffered) WHERE buffered = 300""",
    "scored": """
    SELECT simulation_id, step, score, row_number() OVER (PARTITION BY simulation_id ORDER BY step) AS n
    FROM buffered WHERE buffered = 300 AND step % 10 = 0""",
    "smoothed": """
    SELECT a.simulation_id, a.step, a.score, sum(0.3 * power(CAST(0.7 AS DOUBLE), a.n - b.n) * b.score) AS display_score
    FROM scored a JOIN scored b ON a.simulation_id = b.simulation_id AND b.n <= a.n
    GROUP BY a.simulation_id, a.step, a.score""",
    "fans": f"""
    SELECT simulation_id, step, coolant_temp_c,
           coalesce(last_value(CASE WHEN coolant_temp_c > 102 THEN TRUE WHEN coolant_temp_c < 96 THEN FALSE END IGNORE NULLS)
                    OVER {_SO_FAR}, FALSE) AS fan_active
    FROM telemetry""",
    "gears": f"""
    SELECT simulation_id, step, current_gear, lag(current_gear) OVER ({_W}) AS previous_gear FROM telemetry""",
    "shifts": f"""
    SELECT *, coalesce(current_gear <> previous_gear, FALSE) AS is_shift,
           CAST(sum(CASE WHEN current_gear <> previous_gear THEN 1 ELSE 0 END) OVER {_SO_FAR} AS BIGINT) AS shift_count
    FROM gears""",
    "kafka": """
    SELECT ts AS kafka_ts, CAST(user_id % 8 AS INTEGER) AS partition, event_id AS "offset", props AS raw_event FROM events""",
}


def with_tables(select: str, upto: str) -> str:
    """``select`` behind the common table expressions up to and including ``upto``."""
    names = list(_TABLES)
    parts = [f"{name} AS ({_TABLES[name].strip()})" for name in names[: names.index(upto) + 1]]
    return "WITH " + ",\n".join(parts) + "\n" + select


_FLAT = (
    "simulation_id, step, simulation_time, engine_rpm, speed_kmh, load, throttle, brake, throttle_rate, current_gear, "
    "coolant_temp_c, oil_temp_c, engine_wear, gearbox_wear"
)
_FLAGS = "is_null_violation, is_range_violation, is_logical_violation, is_valid"
_SERVED = (
    "simulation_id, step, rpm_avg_10s, rpm_std_10s, throttle_avg_10s, engine_load_avg_10s, power_factor, speed_kmh, "
    "rpm_range_10s, current_gear, load_max_10s"
)
_STREAM_STATS = f"""
SELECT simulation_id, count(*) AS session_ticks,
       {rounded("avg(speed_kmh)", 6)} AS avg_speed_kmh,
       {rounded("avg(fuel_rate_lph)", 3)} AS avg_fuel_lph,
       max_by(engine_wear, step) AS total_wear
FROM telemetry GROUP BY simulation_id"""
_METRICS = """
SELECT count(*) AS total_rows,
       CAST(sum(CAST(is_null_violation AS INTEGER)) AS BIGINT) AS null_violations,
       CAST(sum(CAST(is_range_violation AS INTEGER)) AS BIGINT) AS range_violations,
       CAST(sum(CAST(NOT is_valid AS INTEGER)) AS BIGINT) AS invalid_rows,
       'silver_telemetry' AS dataset
FROM checked"""
_COUNTS = """count(*) AS total_rows, count(*) FILTER (WHERE is_null_violation) AS null_violations,
       count(*) FILTER (WHERE is_range_violation) AS range_violations, count(*) FILTER (WHERE NOT is_valid) AS invalid_rows"""
_SENT = "SELECT *, to_timestamp(1704067200 + step) AS sent_at FROM checked"
_TRIPS = """
SELECT simulation_id, CAST(trip AS BIGINT) AS trip, min(ts) AS started, max(ts) AS ended, count(*) AS samples, max(value) AS most
FROM (SELECT *, sum(starts) OVER (PARTITION BY simulation_id ORDER BY ts, value ROWS UNBOUNDED PRECEDING) AS trip
      FROM (SELECT CAST(user_id AS VARCHAR) AS simulation_id, CAST(ts AS TIMESTAMPTZ) AS ts, value,
                   CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, value) < INTERVAL 6 HOUR THEN 0 ELSE 1 END AS starts
            FROM events))
GROUP BY simulation_id, trip"""
_HISTORY = """
SELECT simulation_id, step, simulation_time AS t, coalesce(engine_rpm, 0) AS rpm, coalesce(current_gear, 0) AS gear,
       coalesce(speed_kmh, 0) AS speed_kmh
FROM telemetry QUALIFY row_number() OVER (PARTITION BY simulation_id ORDER BY step DESC) <= 300"""
_SMOOTHED = f"SELECT simulation_id, step, {rounded('display_score', 6)} AS display_score FROM smoothed"
_COACHING = """
SELECT simulation_id, step, score, {display} AS display_score,
       CASE WHEN score > 70 THEN 'aggressive' WHEN score > 30 THEN 'normal' ELSE 'calm' END AS style_key,
       CASE WHEN score > 70 THEN 'DANGER' WHEN score > 30 THEN 'CAUTION' ELSE 'OPTIMAL' END AS status_name,
       {risk} AS wear_factor,
       printf('STATUS: %s' || chr(10) || 'AI LOAD: %d%%' || chr(10) || 'WEAR RATE: %.1fx',
              CASE WHEN score > 70 THEN 'DANGER' WHEN score > 30 THEN 'CAUTION' ELSE 'OPTIMAL' END,
              CAST(trunc(score) AS BIGINT), 1 + (score / 25) * (score / 25)) AS display_text
FROM smoothed""".format(
    display=rounded("display_score", 6), risk=rounded("1 + (score / 25) * (score / 25)", 6)
)

_COMMANDS = """
SELECT CAST(user_id AS VARCHAR) AS simulation_id, event_id AS step,
       CASE WHEN event_id % 3 = 0 AND value IS NOT NULL THEN greatest(0, least(1, value / 50)) END AS pedal,
       CASE WHEN event_id % 5 = 0 AND value IS NOT NULL THEN greatest(0, least(1, 1 - value / 50)) END AS brake
FROM events"""


def oracle_sql() -> dict[str, str]:
    return {
        "bronze_projection": with_tables("SELECT * FROM kafka", "kafka"),
        "parse_flatten": with_tables(f"SELECT {_FLAT} FROM telemetry", "telemetry"),
        "parse_flatten_extended": with_tables(f"SELECT {_FLAT}, fuel_rate_lph, pedal FROM telemetry", "telemetry"),
        "dq_flags": with_tables(f"SELECT simulation_id, step, {_FLAGS} FROM checked", "checked"),
        "silver_valid": with_tables(f"SELECT {_FLAT} FROM silver", "silver"),
        "silver_quarantine": with_tables(f"SELECT {_FLAT}, {_FLAGS} FROM checked WHERE NOT is_valid", "checked"),
        "silver_quarantine_strict": with_tables(
            f"SELECT {_FLAT}, {_FLAGS} FROM checked WHERE is_valid IS DISTINCT FROM TRUE", "checked"
        ),
        "dq_metrics": with_tables(
            _METRICS,
            "checked",
        ),
        "dq_undetermined": with_tables("SELECT count(*) - count(is_valid) AS undetermined_rows FROM checked", "checked"),
        "silver_idempotent": with_tables(f"SELECT {_FLAT} FROM silver", "silver"),
        "wear_rate_lag": with_tables(
            f"SELECT simulation_id, step, {rounded('wear_rate_10s', 12)} AS wear_rate_10s FROM lagged", "lagged"
        ),
        "future_wear_rate": with_tables(
            "SELECT simulation_id, step, steady_rate AS future_wear_rate FROM base", "base"
        ),
        "rolling_features": with_tables(f"SELECT {_SERVED} FROM features", "features"),
        "rolling_features_by_step": with_tables(
            f"""
SELECT simulation_id, step, speed_kmh, current_gear,
       {rounded(f"avg(engine_rpm) OVER {_BY_STEP}", 3)} AS rpm_avg_10s,
       {rounded(f"stddev_samp(engine_rpm) OVER {_BY_STEP}", 3)} AS rpm_std_10s,
       {rounded(f"avg(throttle) OVER {_BY_STEP}", 6)} AS throttle_avg_10s,
       {rounded(f"avg(load) OVER {_BY_STEP}", 6)} AS engine_load_avg_10s,
       {rounded("engine_rpm * load", 3)} AS power_factor,
       {rounded(f"max(engine_rpm) OVER {_BY_STEP} - min(engine_rpm) OVER {_BY_STEP}", 3)} AS rpm_range_10s,
       max(load) OVER {_BY_STEP} AS load_max_10s
FROM base""",
            "base",
        ),
        "label_threshold_exact": with_tables("SELECT p75 AS threshold FROM threshold", "threshold"),
        "label_threshold_approx": with_tables(
            "SELECT count(*) AS rated_rows, TRUE AS rank_within_bound FROM base", "base"
        ),
        "gold_features_approx": with_tables(
            f"""
SELECT {_SERVED}, CASE WHEN abs(steady_rate - p75) < 1e-6 THEN 'EITHER' WHEN steady_rate > p75 THEN 'AGGRESSIVE' ELSE 'NORMAL' END
         AS driving_style
FROM features CROSS JOIN threshold""",
            "gold",
        ),
        "rf_quality": with_tables(
            """
SELECT count(*) AS test_rows, TRUE AS beats_constant, TRUE AS full_size
FROM gold JOIN sides USING (simulation_id) WHERE split = 'test' AND rpm_std_10s IS NOT NULL""",
            "sides",
        ),
        "rf_scores": with_tables(
            """
SELECT simulation_id, step, driving_style, TRUE AS score_in_range, TRUE AS label_fits_score, TRUE AS confidence_fits_score
FROM gold JOIN sides USING (simulation_id) WHERE split = 'test' AND rpm_std_10s IS NOT NULL""",
            "sides",
        ),
        "feature_importance": """
SELECT unnest(['rpm_avg_10s', 'rpm_std_10s', 'throttle_avg_10s', 'engine_load_avg_10s', 'power_factor', 'speed_kmh',
               'rpm_range_10s', 'current_gear', 'load_max_10s']) AS feature, TRUE AS descends, TRUE AS in_range, TRUE AS adds_up_to_one""",
        "event_envelope_defaults": """
SELECT event_id, 'simulation.raw' AS event_type, user_id, value, TRUE AS has_uuid, TRUE AS has_time FROM events""",
        "gold_features": with_tables("SELECT * FROM gold", "gold"),
        "label_distribution": with_tables(
            "SELECT driving_style, count(*) AS label_rows FROM gold GROUP BY driving_style", "gold"
        ),
        "ml_dataset": with_tables("SELECT * FROM gold WHERE driving_style IS NOT NULL", "gold"),
        "training_rows": with_tables("SELECT * FROM gold WHERE rpm_std_10s IS NOT NULL", "gold"),
        "group_split": with_tables(
            "SELECT simulation_id, step, split FROM gold JOIN sides USING (simulation_id)", "sides"
        ),
        "split_counts": with_tables(
            """
SELECT split, count(*) AS split_rows, count(DISTINCT simulation_id) AS simulations
FROM gold JOIN sides USING (simulation_id) GROUP BY split""",
            "sides",
        ),
        "distinct_simulations": with_tables("SELECT DISTINCT simulation_id FROM gold", "gold"),
        "last_train_id": with_tables("SELECT max(simulation_id) AS simulation_id FROM sides WHERE split = 'train'", "sides"),
        "class_weights": with_tables(
            f"""
SELECT driving_style, count(*) AS class_rows,
       {rounded("sum(count(*)) OVER () / (count(*) OVER () * CAST(count(*) AS DOUBLE))", 9)} AS class_weight
FROM train WHERE rpm_std_10s IS NOT NULL GROUP BY driving_style""",
            "train",
        ),
        "accuracy": with_tables(
            f"SELECT {rounded('avg(CASE WHEN driving_style = prediction THEN 1.0 ELSE 0.0 END)', 9)} AS accuracy FROM predicted",
            "predicted",
        ),
        "classification_report": with_tables(
            f"""
SELECT label AS class, {rounded("precision_", 9)} AS "precision", {rounded("recall_", 9)} AS recall,
       {rounded("f1_", 9)} AS f1, actual AS support FROM per_class
UNION ALL
SELECT 'macro avg', {rounded("avg(precision_)", 9)}, {rounded("avg(recall_)", 9)}, {rounded("avg(f1_)", 9)},
       CAST(sum(actual) AS BIGINT) FROM per_class
UNION ALL
SELECT 'weighted avg', {rounded("sum(precision_ * actual) / sum(actual)", 9)},
       {rounded("sum(recall_ * actual) / sum(actual)", 9)}, {rounded("sum(f1_ * actual) / sum(actual)", 9)},
       CAST(sum(actual) AS BIGINT) FROM per_class""",
            "per_class",
        ),
        "serving_features_300": with_tables(f"SELECT {_SERVED} FROM serving", "serving"),
        "warmup_progress": with_tables(
            f"SELECT simulation_id, step, buffered, {rounded('buffered / 300.0 * 100', 6)} AS progress_pct FROM buffered",
            "buffered",
        ),
        "every_nth": with_tables(f"SELECT {_SERVED} FROM serving WHERE step % 10 = 0", "serving"),
        "session_running_avg": with_tables(
            f"""
SELECT simulation_id, step, row_number() OVER ({_W}) AS session_ticks,
       {rounded(f"avg(speed_kmh) OVER {_SO_FAR}", 6)} AS avg_speed_kmh,
       {rounded(f"avg(fuel_rate_lph) OVER {_SO_FAR}", 3)} AS avg_fuel_lph
FROM telemetry""",
            "telemetry",
        ),
        "session_summary": with_tables(_STREAM_STATS, "telemetry"),
        "score_ema": with_tables(
            _SMOOTHED, "smoothed"
        ),
        "slow_ema": with_tables(
            f"""
SELECT a.simulation_id, a.step,
       {rounded("15 * power(CAST(0.994 AS DOUBLE), a.step + 1) + sum(0.006 * power(CAST(0.994 AS DOUBLE), a.step - b.step) * b.oil_temp_c)", 6)} AS oil_lagged
FROM telemetry a JOIN telemetry b ON a.simulation_id = b.simulation_id AND b.step <= a.step
GROUP BY a.simulation_id, a.step""",
            "telemetry",
        ),
        "coaching_tier": with_tables(_COACHING, "smoothed"),
        "prediction_log": with_tables(
            """
SELECT simulation_id, step,
       printf('[AI] %s | AGG: %.1f%% | RISK: %.1fx', CASE WHEN score / 100 > 0.5 THEN 'AGGRESSIVE' ELSE 'NORMAL' END,
              score, 1 + (score / 25) * (score / 25)) AS log_line
FROM scored WHERE step % 30 = 0""",
            "scored",
        ),
        "warmup_text": with_tables(
            """
SELECT simulation_id, step,
       printf('AI is warming up...' || chr(10) || 'Progress: %.0f%%', CAST(buffered AS DOUBLE) / 300 * 100) AS shown
FROM buffered WHERE buffered < 300 AND step % 10 = 0""",
            "buffered",
        ),
        "prediction_decision": with_tables(
            f"""
SELECT simulation_id, step,
       CASE WHEN throttle > 0.5 THEN 'AGGRESSIVE' ELSE 'NORMAL' END AS label,
       {rounded("throttle * 100", 6)} AS score,
       {rounded("CASE WHEN throttle > 0.5 THEN throttle ELSE 1 - throttle END", 6)} AS confidence
FROM silver""",
            "silver",
        ),
        "last_300_history": with_tables(
            _HISTORY,
            "telemetry",
        ),
        "latest_state": with_tables(
            f"SELECT {_FLAT} FROM telemetry QUALIFY row_number() OVER (PARTITION BY simulation_id ORDER BY step DESC) = 1",
            "telemetry",
        ),
        "throttle_rate": with_tables(
            f"""
SELECT simulation_id, step,
       {rounded(f"(throttle - lag(throttle) OVER ({_W})) / greatest(simulation_time - lag(simulation_time) OVER ({_W}), 1e-4)", 6)}
         AS throttle_change_rate
FROM telemetry""",
            "telemetry",
        ),
        "load_estimate": with_tables(
            f"SELECT simulation_id, step, {rounded('load', 6)} AS load FROM live", "live"
        ),
        "fan_hysteresis": with_tables("SELECT * FROM fans", "fans"),
        "gear_shift_events": with_tables(
            "SELECT simulation_id, step, previous_gear, current_gear, shift_count FROM shifts WHERE is_shift", "shifts"
        ),
        "gear_dwell": with_tables(
            """
SELECT simulation_id, shift_count, min(current_gear) AS current_gear, min(step) AS first_step, count(*) AS dwell_rows
FROM shifts GROUP BY simulation_id, shift_count""",
            "shifts",
        ),
        "gear_text": with_tables(
            """
SELECT simulation_id, step, CASE WHEN current_gear - 1 <= 0 THEN 'N' ELSE 'D' || CAST(current_gear - 1 AS VARCHAR) END AS gear
FROM telemetry""",
            "telemetry",
        ),
        "rpm_zone_time": with_tables(
            f"""
SELECT simulation_id, zone, count(*) AS zone_rows, {rounded("count(*) * CAST(0.1 AS DOUBLE)", 6)} AS zone_seconds
FROM (SELECT simulation_id, CASE WHEN engine_rpm >= 6400 THEN 'red' WHEN engine_rpm >= 5120 THEN 'yellow'
                                 WHEN engine_rpm IS NOT NULL THEN 'green' END AS zone FROM telemetry)
GROUP BY simulation_id, zone""",
            "telemetry",
        ),
        "event_envelope": """
SELECT 'simulation.raw' AS event_type, CAST(1 AS INTEGER) AS event_version, CAST(event_id AS VARCHAR) AS event_id,
       CAST(epoch_us(ts) AS DOUBLE) / 1e6 AS timestamp, user_id, value
FROM events""",
        "command_envelope": f"""
SELECT 'driver.command' AS event_type, CAST(event_id AS VARCHAR) AS event_id,
       {rounded("greatest(0, least(1, value / 50))", 6)} AS pedal, CAST(NULL AS DOUBLE) AS brake
FROM events""",
        "event_routing": "SELECT event_id, user_id, event_type, props AS payload FROM events WHERE event_type = 'purchase' AND props IS NOT NULL",
        "control_clamp": f"SELECT event_id, CASE WHEN event_id % 7 <> 0 AND value IS NOT NULL THEN {rounded('greatest(0, least(1, (value - 10) / 50))', 9)} END AS control FROM events",
        "control_targets_held": f"""
SELECT simulation_id, step, {rounded("last_value(pedal IGNORE NULLS) OVER " + _SO_FAR, 9)} AS pedal_target,
       {rounded("last_value(brake IGNORE NULLS) OVER " + _SO_FAR, 9)} AS brake_target
FROM ({_COMMANDS})""",
        "command_messages": f"""
SELECT simulation_id AS key, 'driver.command' AS event_type, {rounded("pedal", 9)} AS pedal, {rounded("brake", 9)} AS brake
FROM ({_COMMANDS})""",
        "coaching_text_ties": with_tables(
            """
SELECT simulation_id, step,
       printf('STATUS: %s' || chr(10) || 'AI LOAD: %d%%' || chr(10) || 'WEAR RATE: %.1fx', 'OPTIMAL', CAST(trunc(score) AS BIGINT),
              1 + (score / 25) * (score / 25)) AS display_text,
       printf('[AI] NORMAL | AGG: %.1f%% | RISK: %.1fx', score / 2, 1 + (score / 50) * (score / 50)) AS log_line
FROM (SELECT simulation_id, step, speed_kmh / 8 AS score FROM telemetry)""",
            "telemetry",
        ),
        "slow_ema_carried": with_tables(
            f"""
SELECT a.simulation_id, a.step,
       {rounded("any_value(CAST(a.simulation_id AS DOUBLE)) / 64 * power(CAST(0.994 AS DOUBLE), a.step + 1) + sum(0.006 * power(CAST(0.994 AS DOUBLE), a.step - b.step) * b.oil_temp_c)", 6)} AS oil_lagged
FROM telemetry a JOIN telemetry b ON a.simulation_id = b.simulation_id AND b.step <= a.step
GROUP BY a.simulation_id, a.step""",
            "telemetry",
        ),
        "long_lane_running": with_tables(
            f"""
SELECT simulation_id, step, row_number() OVER ({_W}) AS session_ticks,
       {rounded(f"avg(speed_kmh) OVER {_SO_FAR}", 6)} AS avg_speed_kmh,
       {rounded(f"avg(fuel_rate_lph) OVER {_SO_FAR}", 3)} AS avg_fuel_lph
FROM telemetry""",
            "telemetry",
        ),
        "long_lane_framed": with_tables(
            "SELECT simulation_id, step, steady_rate AS future_wear_rate FROM base", "base"
        ),
        "long_lane_smoothed": with_tables(
            f"""
SELECT a.simulation_id, a.step,
       {rounded("15 * power(CAST(0.994 AS DOUBLE), a.step + 1) + sum(0.006 * power(CAST(0.994 AS DOUBLE), a.step - b.step) * b.oil_temp_c)", 6)} AS oil_lagged
FROM telemetry a JOIN telemetry b ON a.simulation_id = b.simulation_id AND b.step <= a.step
GROUP BY a.simulation_id, a.step""",
            "telemetry",
        ),
        "stream_latest_state": with_tables(
            f"SELECT {_FLAT} FROM telemetry QUALIFY row_number() OVER (PARTITION BY simulation_id ORDER BY step DESC) = 1",
            "telemetry",
        ),
        "default_fill": with_tables(
            """
SELECT simulation_id, step, coalesce(engine_rpm, 0) AS engine_rpm, coalesce(speed_kmh, 0) AS speed_kmh,
       coalesce(coolant_temp_c, 0) AS coolant_temp_c, coalesce(fuel_rate_lph, 0) AS fuel_rate_lph,
       coalesce(engine_wear, 0) AS engine_wear, coalesce(throttle, 0) AS throttle, coalesce(current_gear, 0) AS current_gear
FROM telemetry""",
            "telemetry",
        ),
        "membership_filter": with_tables(
            """
SELECT simulation_id, step FROM silver
WHERE simulation_id IN (SELECT simulation_id FROM silver WHERE speed_kmh >= 200 AND current_gear = 7)""",
            "silver",
        ),
        "table_silver": with_tables(f"SELECT {_FLAT} FROM silver", "silver"),
        "table_silver_by_simulation": with_tables(f"SELECT {_FLAT} FROM silver", "silver"),
        "table_silver_incremental": with_tables(f"SELECT {_FLAT} FROM silver", "silver"),
        "table_quarantine": with_tables(f"SELECT {_FLAT}, {_FLAGS} FROM checked WHERE NOT is_valid", "checked"),
        "table_metrics": with_tables(_METRICS, "checked"),
        "table_gold_incremental": with_tables("SELECT * FROM gold", "gold"),
        "gold_features_bucketed": with_tables("SELECT * FROM gold", "gold"),
        "label_threshold_sketched": with_tables("SELECT count(*) AS rated_rows, TRUE AS rank_within_bound FROM base", "base"),
        "step_gaps": with_tables(
            f"""
SELECT simulation_id, CAST(step + 1 AS INTEGER) AS first_missing, CAST(next_step - 1 AS INTEGER) AS last_missing,
       CAST(next_step - step - 1 AS BIGINT) AS missing_steps
FROM (SELECT simulation_id, step, lead(step) OVER ({_W}) AS next_step FROM silver) WHERE next_step > step + 1""",
            "silver",
        ),
        "filled_steps": with_tables(
            f"""
, spans AS (
    SELECT simulation_id, min(step) AS low, max(step) AS high FROM silver GROUP BY simulation_id),
every_step AS (
    SELECT simulation_id, CAST(unnest(range(low, high + 1)) AS INTEGER) AS step FROM spans),
given AS (
    SELECT e.simulation_id, e.step, s.step IS NULL AS is_filled, s.engine_rpm, s.speed_kmh, s.step AS own
    FROM every_step e LEFT JOIN silver s USING (simulation_id, step)),
near AS (
    SELECT *, last_value(own IGNORE NULLS) OVER before AS p, first_value(own IGNORE NULLS) OVER after AS n,
           last_value(engine_rpm IGNORE NULLS) OVER before AS rpm_p, first_value(engine_rpm IGNORE NULLS) OVER after AS rpm_n,
           last_value(speed_kmh IGNORE NULLS) OVER before AS speed_p, first_value(speed_kmh IGNORE NULLS) OVER after AS speed_n
    FROM given
    WINDOW before AS ({_W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
           after AS ({_W} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
SELECT simulation_id, step, is_filled,
       {rounded("CASE WHEN is_filled THEN rpm_p + (rpm_n - rpm_p) * (CAST(step - p AS DOUBLE) / (n - p)) ELSE engine_rpm END", 6)} AS engine_rpm,
       {rounded("CASE WHEN is_filled THEN speed_p + (speed_n - speed_p) * (CAST(step - p AS DOUBLE) / (n - p)) ELSE speed_kmh END", 6)} AS speed_kmh
FROM near""",
            "silver",
        ),
        "table_gold": with_tables("SELECT * FROM gold", "gold"),
        "table_split": with_tables(
            """
SELECT 'full' AS part, simulation_id, count(*) AS part_rows FROM gold GROUP BY simulation_id
UNION ALL
SELECT split AS part, simulation_id, count(*) FROM gold JOIN sides USING (simulation_id) GROUP BY split, simulation_id""",
            "sides",
        ),
        "stream_bronze_append": with_tables(
            'SELECT kafka_ts, CAST(partition AS BIGINT) AS partition, "offset", raw_event FROM kafka', "kafka"
        ),
        "stream_silver_split": with_tables(
            """
SELECT CASE WHEN is_valid THEN 'silver' ELSE 'quarantine' END AS part, simulation_id, count(*) AS part_rows
FROM checked WHERE is_valid IS NOT NULL GROUP BY 1, 2""",
            "checked",
        ),
        "stream_session_stats": with_tables(_STREAM_STATS, "telemetry"),
        "stream_history": with_tables(_HISTORY, "telemetry"),
        "stream_serving_features": with_tables(f"SELECT {_SERVED} FROM serving", "serving"),
        "stream_serving_features_gaps": with_tables(
            f"""
SELECT {_SERVED} FROM (
    SELECT simulation_id, step, speed_kmh, current_gear, buffered,
           {rounded(f"avg(engine_rpm) OVER {_BUFFER}", 3)} AS rpm_avg_10s,
           {rounded(f"stddev_samp(engine_rpm) OVER {_BUFFER}", 3)} AS rpm_std_10s,
           {rounded(f"avg(throttle) OVER {_BUFFER}", 6)} AS throttle_avg_10s,
           {rounded(f"avg(load) OVER {_BUFFER}", 6)} AS engine_load_avg_10s,
           {rounded("engine_rpm * load", 3)} AS power_factor,
           {rounded(f"max(engine_rpm) OVER {_BUFFER} - min(engine_rpm) OVER {_BUFFER}", 3)} AS rpm_range_10s,
           {rounded(f"max(load) OVER {_BUFFER}", 6)} AS load_max_10s
    FROM (SELECT *, count(*) OVER {_BUFFER} AS buffered
          FROM live WHERE step % 3 <> 2)
) WHERE buffered = 300""",
            "live",
        ),
        "stream_score_ema": with_tables(_SMOOTHED, "smoothed"),
        "stream_deduplicated": "SELECT CAST(event_id AS VARCHAR) AS event_id, user_id, value FROM events",
        "stream_silver_merged": with_tables(f"SELECT {_FLAT} FROM silver", "silver"),
        "stream_dq_per_minute": with_tables(
            f"""
SELECT time_bucket(INTERVAL 1 MINUTE, sent_at) AS window_start, time_bucket(INTERVAL 1 MINUTE, sent_at) + INTERVAL 1 MINUTE AS window_end, {_COUNTS}
FROM ({_SENT}) GROUP BY 1, 2""",
            "checked",
        ),
        "dq_sliding": with_tables(
            f"""
SELECT window_start, window_start + INTERVAL 2 MINUTE AS window_end, {_COUNTS}
FROM ({_SENT}), LATERAL unnest(range(4)) AS shifts(i),
     LATERAL (SELECT time_bucket(INTERVAL 30 SECOND, sent_at) - i * INTERVAL 30 SECOND AS window_start)
GROUP BY 1, 2""",
            "checked",
        ),
        "trips_by_pause": f"SELECT simulation_id, trip, started, ended, samples, most, lane FROM ({_TRIPS}), (VALUES ('short'), ('long')) AS lanes(lane)",
        "stream_trips": f"SELECT simulation_id, started, ended, samples, most FROM ({_TRIPS})",
        "stream_chained_coaching": with_tables(
            """
SELECT simulation_id, step,
       CASE WHEN buffered < 300 THEN printf('AI is warming up...' || chr(10) || 'Progress: %.0f%%', CAST(buffered AS DOUBLE) / 300 * 100) END AS warmup_text,
       TRUE AS score_in_range, TRUE AS display_fits, TRUE AS tier_fits
FROM buffered WHERE step % 10 = 0""",
            "buffered",
        ),
        "stream_live_coaching": with_tables(
            "SELECT simulation_id, step, TRUE AS score_in_range, TRUE AS display_fits, TRUE AS tier_fits FROM scored", "scored"
        ),
    }
