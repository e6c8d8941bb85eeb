"""Feed contracts, canonical column names and fixed domain values."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must equal the source pipeline's for identical results)
# ---------------------------------------------------------------------------
SCD_OPEN_END_DATE = "9999-12-31"          # record_end_date of a current row
SCD_BASELINE_START_DATE = "1900-01-01"    # record_effective_date when a snapshot has none
SCD_COLUMNS = ("record_effective_date", "record_end_date", "is_current", "scd_version")

CDC_OP_DELETE = 1
CDC_OP_INSERT = 2
CDC_OP_BEFORE_IMAGE = 3
CDC_OP_AFTER_IMAGE = 4
CDC_OP_NAMES = {1: "DELETE", 2: "INSERT", 4: "UPDATE"}

# Transformer risk rule: flag thresholds (strictly greater than) and weights.
RISK_OIL_DELTA_C = 25.0
RISK_GAS_PPM = 800.0
RISK_VIBRATION_MM_S = 7.0
RISK_LOAD_PCT = 90.0
RISK_WEIGHTS = {"risk_alarm": 3, "risk_oil_temp": 2, "risk_gas": 2, "risk_vibration": 1, "risk_overload": 1}
RISK_HIGH_MIN_SCORE = 6
RISK_MEDIUM_MIN_SCORE = 3

# Meter anomaly: per-region percentile band.
METER_LOW_PERCENTILE = 0.01
METER_HIGH_PERCENTILE = 0.99
# Documented fixed bands of the meter feed (kWh) and telemetry overheating (deg C above ambient).
THEFT_KWH_BAND = (0.001, 0.05)
SPIKE_KWH_BAND = (50.0, 120.0)
SUSPECT_METER_STATUSES = ("TAMPERED", "DISCONNECTED")
OVERHEAT_DELTA_BAND = (60.0, 90.0)
# Documented billing fraud signal: base amount band.
FRAUD_BASE_AMOUNT_BAND = (0.01, 50.0)

# Data-quality plausibility bounds.
VOLTAGE_MIN_V = 150.0
VOLTAGE_MAX_V = 300.0
OIL_DELTA_IMPLAUSIBLE_C = 80.0
DQ_SAMPLE_KEYS = 20

# Candidate column names, first present wins.
AMOUNT_CANDIDATES = ("amount_due", "amount", "total_amount", "bill_amount")
PRODUCTION_CANDIDATES = ("production_mw", "generation_mw", "total_generation_mw")
INJECTION_CANDIDATES = ("grid_injection_mw", "injection_mw", "grid_export_mw")
MAINTENANCE_DATE_CANDIDATES = ("maintenance_date", "performed_at", "date", "reported_date")
RENEWABLE_TIME_CANDIDATES = ("timestamp", "datetime")
RENEWABLE_EVOLVED_COLUMNS = ("curtailment_mw", "battery_storage_mwh")
RENEWABLE_SCHEMA_HINTS = "production_mw double, curtailment_mw double, battery_storage_mwh double"
RENEWABLE_FILE_PATTERN = r"renewable_production_(\d{8})_(\d{4})"

# Columns that each layer boundary asks for before any job runs (a feed without them is no such feed).
CONTRACTS = {
    "smart_meter_readings": ("event_id", "meter_id", "timestamp", "region"),
    "substation_telemetry": ("telemetry_id", "transformer_id", "timestamp"),
    "billing_cdc": ("transaction_id", "cdc_timestamp"),
    "transformer_snapshot": ("transformer_id",),
    "transformer_delta": ("record_effective_date",),
    "customer_hourly_usage": ("event_date", "region", "kwh_total"),
    "transformer_health_hourly": ("event_date", "region", "transformer_id"),
}

# Feed names that differ from the names the curated layers use.
CANONICAL_NAMES = {"reading_kwh": "kwh_consumed", "load_percentage": "load_pct"}

# ---------------------------------------------------------------------------
# Feed contracts (JSON messages as they arrive; timestamps stay strings). A measure that feeds
# name in two ways is listed under both names.
# ---------------------------------------------------------------------------
CORRUPT = "_corrupt_record"               # the raw text of a line that is no such message
S, D, L, I, B = T.StringType(), T.DoubleType(), T.LongType(), T.IntegerType(), T.BooleanType()


def _schema(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


SMART_METER_SCHEMA = _schema(
    ("event_id", S), ("meter_id", S), ("customer_id", S), ("timestamp", S),
    ("reading_kwh", D), ("voltage_v", D), ("current_a", D), ("power_factor", D),
    ("frequency_hz", D), ("meter_status", S), ("region", S), ("state", S),
    ("grid_zone", S), ("is_anomaly_flag", B),
    ("kwh_consumed", D), ("reading_type", S), ("temperature_c", D),
)

TELEMETRY_SCHEMA = _schema(
    ("telemetry_id", S), ("substation_id", S), ("transformer_id", S), ("timestamp", S),
    ("load_mw", D), ("capacity_mw", I), ("load_percentage", D), ("voltage_kv", D),
    ("oil_temperature_c", D), ("ambient_temperature_c", D), ("dissolved_gas_ppm", D),
    ("humidity_percent", D), ("breaker_status", S), ("alarm_code", S), ("region", S),
    ("state", S), ("iot_device_id", S), ("iot_hub_enqueued_time", S), ("sequence_number", L),
    ("load_pct", D), ("vibration_mm_s", D),
)

BILLING_CDC_SCHEMA = _schema(
    ("__$start_lsn", S), ("__$seqval", S), ("__$operation", I), ("__$update_mask", S),
    ("__$command_id", I), ("transaction_id", S), ("bill_id", S), ("customer_id", S),
    ("meter_id", S), ("billing_period_start", S), ("billing_period_end", S), ("due_date", S),
    ("units_consumed_kwh", D), ("rate_per_kwh", D), ("base_amount", D), ("tax_amount", D),
    ("total_amount", D), ("payment_status", S), ("payment_method", S), ("region", S),
    ("state", S), ("fraud_flag", B), ("cdc_timestamp", S),
)

MAINTENANCE_SCHEMA = _schema(
    ("log_id", S), ("transformer_id", S), ("substation_id", S), ("region", S), ("state", S),
    ("maintenance_type", S), ("failure_type", S), ("severity", S), ("reported_date", T.DateType()),
    ("scheduled_date", T.DateType()), ("completed_date", T.DateType()), ("technician_id", S),
    ("technician_name", S), ("hours_spent", D), ("parts_replaced", S), ("cost_inr", D),
    ("downtime_hours", D), ("root_cause", S), ("resolution_notes", S),
    ("follow_up_required", S), ("next_inspection_date", T.DateType()),
)


def with_corrupt(schema: T.StructType) -> T.StructType:
    """A JSON contract that also keeps the raw text of lines that don't fit it."""
    return T.StructType([*schema.fields, T.StructField(CORRUPT, S, True)])


AUDIT_METRICS_SCHEMA = "batch_id string, layer string, table_fqn string, metric_name string, metric_value string"
DQ_VIOLATIONS_SCHEMA = ("batch_id string, layer string, dataset string, rule_name string, severity string, "
                        "violation_count bigint, sample_keys string, created_ts timestamp")
