"""Derived scores and labels (CASE expressions), all null-aware."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltaic import schemas as K
from voltaic.functions.columns import has_text, ratio

__all__ = ["risk_level", "with_risk_score", "meter_anomaly_flag", "meter_anomaly_type",
           "band_anomaly", "cdc_op_name", "billing_mismatch", "is_overheating"]


def risk_level(score: Column | str, high: int = K.RISK_HIGH_MIN_SCORE,
               medium: int = K.RISK_MEDIUM_MIN_SCORE) -> Column:
    s = F.col(score) if isinstance(score, str) else score
    return (F.when(s >= high, F.lit("HIGH"))
             .when(s >= medium, F.lit("MEDIUM"))
             .otherwise(F.lit("LOW")))


def with_risk_score(df: DataFrame, oil_delta_c: float = K.RISK_OIL_DELTA_C, gas_ppm: float = K.RISK_GAS_PPM,
                    vibration_mm_s: float = K.RISK_VIBRATION_MM_S, load_pct: float = K.RISK_LOAD_PCT,
                    weights: dict[str, int] | None = None) -> DataFrame:
    """Oil-temperature delta, five 0/1 risk flags, weighted score and level.

    A NULL reading raises no flag (``when`` falls through to 0); columns the
    feed does not carry (e.g. vibration) are treated as NULL.
    """
    w = dict(K.RISK_WEIGHTS, **(weights or {}))

    def c(name: str) -> Column:
        return F.col(name) if name in df.columns else F.lit(None).cast("double")

    flags = {
        "risk_alarm": F.when(has_text(c("alarm_code")), 1).otherwise(0),
        "risk_oil_temp": F.when(F.col("oil_temp_delta_c") > oil_delta_c, 1).otherwise(0),
        "risk_gas": F.when(c("dissolved_gas_ppm") > gas_ppm, 1).otherwise(0),
        "risk_vibration": F.when(c("vibration_mm_s") > vibration_mm_s, 1).otherwise(0),
        "risk_overload": F.when(c("load_pct") > load_pct, 1).otherwise(0),
    }
    out = df.withColumn("oil_temp_delta_c", c("oil_temperature_c") - c("ambient_temperature_c"))
    out = out.withColumns(flags)
    score = sum((F.lit(w[k]) * F.col(k) for k in flags), F.lit(0))
    return out.withColumn("risk_score", score.cast("int")).withColumn("risk_level", risk_level("risk_score"))


def meter_anomaly_flag(kwh: Column, low: Column, high: Column) -> Column:
    """Strictly outside the band; NULL when the reading or a bound is NULL."""
    return (kwh < low) | (kwh > high)


def meter_anomaly_type(kwh: Column, low: Column, high: Column) -> Column:
    return (F.when(kwh < low, F.lit("LOW_CONSUMPTION"))
             .when(kwh > high, F.lit("HIGH_CONSUMPTION"))
             .otherwise(F.lit(None).cast("string")))


def band_anomaly(kwh: Column, status: Column | None = None) -> Column:
    """Documented fixed-band meter signals: suspected theft, spike, suspicious status."""
    lo, hi = K.THEFT_KWH_BAND
    slo, shi = K.SPIKE_KWH_BAND
    expr = (F.when(kwh.between(lo, hi), F.lit("SUSPECTED_THEFT"))
             .when(kwh.between(slo, shi), F.lit("SPIKE")))
    if status is not None:
        expr = expr.when(status.isin(*K.SUSPECT_METER_STATUSES), F.concat(F.lit("STATUS_"), status))
    return expr.otherwise(F.lit(None).cast("string"))


def is_overheating(oil_delta: Column) -> Column:
    lo, hi = K.OVERHEAT_DELTA_BAND
    return oil_delta.between(lo, hi)


def cdc_op_name(op: Column | str) -> Column:
    o = F.col(op) if isinstance(op, str) else op
    expr = None
    for code, name in K.CDC_OP_NAMES.items():
        expr = F.when(o == code, F.lit(name)) if expr is None else expr.when(o == code, F.lit(name))
    return expr.otherwise(F.lit(None).cast("string"))


def billing_mismatch(units: Column, rate: Column, base: Column) -> Column:
    """Relative gap between metered charge (units x rate) and billed base amount."""
    return ratio(F.abs(units * rate - base), base)
