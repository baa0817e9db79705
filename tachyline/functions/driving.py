"""Driving-style expressions: load estimate, decision, coaching, gauge zones."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from tachyline.functions.numbers import one_decimal
from tachyline.schemas import AGGRESSIVE, NORMAL

# Nominal and red-line engine speed, coaching limits.
MAX_RPM = 6500.0
REDLINE_RPM = 6400.0
YELLOW_SHARE = 0.8
DANGER_SCORE = 70
CAUTION_SCORE = 30
RISK_SCALE = 25.0


def load_estimate(throttle: Column, rpm: Column) -> Column:
    return throttle * (rpm / MAX_RPM)


def decision(probability: Column) -> dict[str, Column]:
    """Label, score 0-100 and confidence from the probability of the aggressive class."""
    aggressive = probability > 0.5
    return {
        "label": F.when(aggressive, AGGRESSIVE).otherwise(NORMAL),
        "score": probability * 100,
        "confidence": F.when(aggressive, probability).otherwise(1 - probability),
    }


def wear_factor(score: Column) -> Column:
    return 1 + F.pow(score / RISK_SCALE, 2)


def _by_score(score: Column, danger: str, caution: str, calm: str) -> Column:
    return F.when(score > DANGER_SCORE, danger).when(score > CAUTION_SCORE, caution).otherwise(calm)


def coaching(score: Column) -> dict[str, Column]:
    status = _by_score(score, "DANGER", "CAUTION", "OPTIMAL")
    risk = wear_factor(score)
    return {
        "style_key": _by_score(score, "aggressive", "normal", "calm"),
        "status_name": status,
        "wear_factor": risk,
        "display_text": F.format_string(
            "STATUS: %s\nAI LOAD: %d%%\nWEAR RATE: %.1fx", status, score.cast("int"), one_decimal(risk)
        ),
    }


def prediction_log(label: Column, score: Column) -> Column:
    return F.format_string(
        "[AI] %s | AGG: %.1f%% | RISK: %.1fx", F.upper(label), one_decimal(score), one_decimal(wear_factor(score))
    )


def warmup_text(progress_pct: Column) -> Column:
    return F.format_string("AI is warming up...\nProgress: %.0f%%", F.bround(progress_pct, 0))


def rpm_zone(rpm: Column, redline: float = REDLINE_RPM) -> Column:
    return F.when(rpm >= redline, "red").when(rpm >= redline * YELLOW_SHARE, "yellow").when(rpm.isNotNull(), "green")


def gear_text(gear: Column) -> Column:
    return F.when(gear <= 0, F.lit("N")).otherwise(F.concat(F.lit("D"), gear.cast("string")))
