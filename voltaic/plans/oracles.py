"""Independent ANSI-SQL (DuckDB) formulations of every bound query (``oracle_sql()``).

Written directly against the registered views (``events``, ``lineitem``, ...),
without any voltaic code, so a DuckDB run is an independent check of the Spark
plans. Percentiles use the exact rank definition (smallest value whose rank is
at least ceil(p * n)).
"""

from __future__ import annotations


def ES(x: str) -> str:
    """Sum of a measure."""
    return f"SUM(CAST({x} AS DOUBLE))"


def EA(x: str) -> str:
    return f"AVG(CAST({x} AS DOUBLE))"


def R(*columns: str) -> str:
    """All columns, the named measures rounded to the six decimals at which results are compared."""
    return "* REPLACE (" + ", ".join(f"round({c}, 6) AS {c}" for c in columns) + ")"


USAGE = ("kwh_total", "voltage_avg", "current_avg", "pf_avg", "anomaly_rate")
BILLED = ("amount_total", "amount_paid", "amount_outstanding", "fraud_rate")
REN_HOUR = ("production_mw_sum", "grid_injection_mw_sum", "curtailment_mw_sum", "battery_storage_mwh_max", "curtailment_rate")
REN_DAY = ("renewable_production_mw", "renewable_injection_mw", "renewable_curtailment_mw", "renewable_curtailment_rate")
OPS_DOUBLES = ("kwh_total", "meter_anomaly_rate", "high_risk_rate", "amount_total", "amount_paid", "amount_outstanding", "fraud_rate", *REN_DAY)


def GR(num: str, den: str) -> str:
    return f"(CASE WHEN {den} > 0 THEN CAST({num} AS DOUBLE) / CAST({den} AS DOUBLE) ELSE 0.0 END)"


EV_K = "(SELECT *, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events)"

METER_FEED = f"""
meter_feed AS (
  SELECT event_id, user_id AS meter_id, user_id AS customer_id, ts AS event_ts, CAST(ts AS DATE) AS event_date,
         value AS kwh_consumed,
         140.0::DOUBLE + 2.0::DOUBLE * CAST(k AS DOUBLE) AS voltage_v,
         CAST(k AS DOUBLE) / 4 AS current_a,
         0.75::DOUBLE + CAST(k AS DOUBLE) / 400 AS power_factor,
         event_type AS region,
         event_type || '-' || CASE WHEN k < 50 THEN 'A' ELSE 'B' END AS state
  FROM {EV_K}),
meters AS (SELECT * FROM meter_feed QUALIFY ROW_NUMBER() OVER (PARTITION BY event_id ORDER BY event_ts DESC) = 1)"""


def thresholds(src: str, name: str) -> str:
    return f"""
{name} AS (
  SELECT region,
         MIN(kwh_consumed) FILTER (WHERE rn >= CEIL(0.01 * n)) AS p01_kwh,
         MIN(kwh_consumed) FILTER (WHERE rn >= CEIL(0.99 * n)) AS p99_kwh
  FROM (SELECT region, kwh_consumed,
               ROW_NUMBER() OVER (PARTITION BY region ORDER BY kwh_consumed) AS rn,
               COUNT(kwh_consumed) OVER (PARTITION BY region) AS n
        FROM {src} WHERE kwh_consumed IS NOT NULL)
  GROUP BY region)"""


def scored(src: str, thr: str, name: str) -> str:
    return f"""
{name} AS (
  SELECT m.*,
         (m.kwh_consumed < t.p01_kwh) OR (m.kwh_consumed > t.p99_kwh) AS is_kwh_anomaly,
         CASE WHEN m.kwh_consumed < t.p01_kwh THEN 'LOW_CONSUMPTION'
              WHEN m.kwh_consumed > t.p99_kwh THEN 'HIGH_CONSUMPTION' END AS anomaly_type
  FROM {src} m LEFT JOIN {thr} t ON m.region = t.region)"""


SCORED_METERS = METER_FEED + "," + thresholds("meters", "thr") + "," + scored("meters", "thr", "scored_meters")

TELEMETRY = """
tel_feed AS (
  SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS telemetry_id,
         l_partkey AS substation_id, l_suppkey AS transformer_id,
         l_shipdate AS telemetry_ts, CAST(l_shipdate AS DATE) AS event_date,
         40.0::DOUBLE + 2.0::DOUBLE * l_quantity AS oil_temperature_c, 40.0::DOUBLE AS ambient_temperature_c,
         l_extendedprice / 100 AS dissolved_gas_ppm, l_tax * 100 AS vibration_mm_s, l_discount * 1000 AS load_pct,
         CASE WHEN l_returnflag = 'R' THEN 'OVERLOAD' WHEN l_returnflag = 'A' THEN '' END AS alarm_code,
         l_returnflag AS region, l_linestatus AS state
  FROM lineitem),
tel_latest AS (
  SELECT * FROM tel_feed
  QUALIFY ROW_NUMBER() OVER (PARTITION BY telemetry_id
                             ORDER BY telemetry_ts DESC, substation_id DESC, transformer_id DESC) = 1),
tel_flags AS (
  SELECT *,
         CASE WHEN alarm_code IS NOT NULL AND alarm_code <> '' THEN 1 ELSE 0 END AS risk_alarm,
         CASE WHEN oil_temp_delta_c > 25 THEN 1 ELSE 0 END AS risk_oil_temp,
         CASE WHEN dissolved_gas_ppm > 800 THEN 1 ELSE 0 END AS risk_gas,
         CASE WHEN vibration_mm_s > 7 THEN 1 ELSE 0 END AS risk_vibration,
         CASE WHEN load_pct > 90 THEN 1 ELSE 0 END AS risk_overload
  FROM (SELECT *, oil_temperature_c - ambient_temperature_c AS oil_temp_delta_c FROM tel_latest)),
tel_score AS (
  SELECT *, CAST(3 * risk_alarm + 2 * risk_oil_temp + 2 * risk_gas + risk_vibration + risk_overload AS INTEGER)
            AS risk_score FROM tel_flags),
scored_tel AS (
  SELECT *, CASE WHEN risk_score >= 6 THEN 'HIGH' WHEN risk_score >= 3 THEN 'MEDIUM' ELSE 'LOW' END AS risk_level
  FROM tel_score)"""

CDC_ORDER = 'cdc_ts DESC, "__$seqval" DESC, "__$start_lsn" DESC, "__$operation" DESC'
CDC = f"""
cdc_feed AS (
  SELECT l_orderkey, l_linenumber,
         CASE l_returnflag WHEN 'N' THEN 2 WHEN 'A' THEN 4 WHEN 'R' THEN 1 END AS "__$operation",
         lpad(hex(l_partkey), 12, '0') AS "__$seqval", lpad(hex(l_suppkey), 12, '0') AS "__$start_lsn",
         l_shipdate AS cdc_ts, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_linestatus
  FROM lineitem),
early AS (
  SELECT * FROM cdc_feed WHERE cdc_ts < TIMESTAMP '1997-01-01' AND "__$operation" IS DISTINCT FROM 3
  QUALIFY ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {CDC_ORDER}) = 1),
target AS (SELECT * FROM early WHERE "__$operation" IN (2, 4)),
later AS (
  SELECT * FROM cdc_feed WHERE cdc_ts >= TIMESTAMP '1997-01-01' AND "__$operation" IS DISTINCT FROM 3
  QUALIFY ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {CDC_ORDER}) = 1)"""


def cdc_result(ops: str, with_upserts: bool) -> str:
    kept = f"""SELECT t.* FROM target t WHERE NOT EXISTS (
  SELECT 1 FROM later l WHERE l.l_orderkey = t.l_orderkey AND l.l_linenumber = t.l_linenumber
                          AND l."__$operation" IN ({ops}))"""
    if with_upserts:
        kept += '\nUNION ALL SELECT * FROM later WHERE "__$operation" IN (2, 4)'
    return f"WITH {CDC}\n{kept}"


CUSTOMER = """
cust_dim AS (
  SELECT c_custkey AS customer_id, c_custkey // 10 AS meter_id, c_name, c_nationkey, c_acctbal, c_mktsegment,
         DATE '1900-01-01' AS record_effective_date, DATE '9999-12-31' AS record_end_date,
         true AS is_current, 1 AS scd_version
  FROM customer),
cust_delta AS (
  SELECT c_custkey AS customer_id, c_custkey // 10 AS meter_id, c_name, c_nationkey,
         CASE WHEN c_mktsegment = 'BUILDING' THEN c_acctbal + 100
              WHEN c_mktsegment = 'FURNITURE' THEN NULL ELSE c_acctbal END AS c_acctbal,
         c_mktsegment, '2025-06-01' AS record_effective_date, '9999-12-31' AS record_end_date, true AS is_current
  FROM customer
  UNION ALL
  SELECT c_custkey + 1000000000, c_custkey // 10, c_name, c_nationkey, c_acctbal, c_mktsegment,
         '2025-06-01', '9999-12-31', true
  FROM customer WHERE c_mktsegment = 'AUTOMOBILE'),
scd_join AS (
  SELECT t.customer_id AS t_id, s.customer_id AS s_id, t.scd_version AS t_version,
         t.meter_id AS t_meter_id, t.c_name AS t_c_name, t.c_nationkey AS t_c_nationkey,
         t.c_acctbal AS t_c_acctbal, t.c_mktsegment AS t_c_mktsegment,
         t.record_effective_date AS t_eff, t.record_end_date AS t_end,
         s.meter_id AS s_meter_id, s.c_name AS s_c_name, s.c_nationkey AS s_c_nationkey,
         s.c_acctbal AS s_c_acctbal, s.c_mktsegment AS s_c_mktsegment,
         s.record_effective_date AS s_eff, s.record_end_date AS s_end,
         (t.customer_id IS NOT NULL AND s.customer_id IS NOT NULL AND (
            t.meter_id IS DISTINCT FROM s.meter_id OR t.c_name IS DISTINCT FROM s.c_name
            OR t.c_nationkey IS DISTINCT FROM s.c_nationkey OR t.c_acctbal IS DISTINCT FROM s.c_acctbal
            OR t.c_mktsegment IS DISTINCT FROM s.c_mktsegment)) AS changed
  FROM (SELECT * FROM cust_dim WHERE is_current) t FULL OUTER JOIN cust_delta s ON t.customer_id = s.customer_id),
scd_changes AS (
  SELECT t_id AS customer_id, t_meter_id AS meter_id, t_c_name AS c_name, t_c_nationkey AS c_nationkey,
         t_c_acctbal AS c_acctbal, t_c_mktsegment AS c_mktsegment, t_eff AS record_effective_date,
         CASE WHEN changed THEN CAST(s_eff AS DATE) - 1 ELSE t_end END AS record_end_date,
         CASE WHEN changed THEN false ELSE true END AS is_current, t_version AS scd_version,
         CASE WHEN changed THEN 'expire' ELSE 'keep' END AS _scd_action
  FROM scd_join WHERE t_id IS NOT NULL
  UNION ALL
  SELECT s_id, s_meter_id, s_c_name, s_c_nationkey, s_c_acctbal, s_c_mktsegment, CAST(s_eff AS DATE),
         CAST(COALESCE(s_end, '9999-12-31') AS DATE), true, CAST(COALESCE(t_version + 1, 1) AS INTEGER),
         CASE WHEN t_id IS NOT NULL THEN 'new_version' ELSE 'new_key' END
  FROM scd_join WHERE s_id IS NOT NULL AND (t_id IS NULL OR changed)),
scd_applied AS (
  SELECT * EXCLUDE (_scd_action) FROM scd_changes
  UNION ALL SELECT * FROM cust_dim WHERE NOT is_current),
append_only AS (
  SELECT * FROM cust_dim
  UNION ALL
  SELECT d.customer_id, d.meter_id, d.c_name, d.c_nationkey, d.c_acctbal, d.c_mktsegment,
         CAST(d.record_effective_date AS DATE), CAST(d.record_end_date AS DATE), d.is_current,
         CAST(COALESCE(c.scd_version + 1, 1) AS INTEGER)
  FROM cust_delta d LEFT JOIN (SELECT customer_id, scd_version FROM cust_dim WHERE is_current) c
       ON d.customer_id = c.customer_id)"""

TRANSFORMER = """
trf_dim AS (
  SELECT s_suppkey AS transformer_id, s_name, s_nationkey AS region, s_acctbal,
         DATE '1900-01-01' AS record_effective_date, DATE '9999-12-31' AS record_end_date,
         true AS is_current, 1 AS scd_version
  FROM supplier)"""

BILLS = """
bills AS (
  SELECT o_orderkey AS transaction_id, o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS due_date,
         o_orderdate AS cdc_ts, o_totalprice AS total_amount,
         CASE o_orderstatus WHEN 'F' THEN 'PAID' WHEN 'O' THEN 'PENDING' WHEN 'P' THEN 'DISPUTED' END AS payment_status,
         o_totalprice < 25000 AS fraud_flag
  FROM orders),
bill_daily AS (
  SELECT due_date AS bill_date, COUNT(*) AS tx_count,
         """ + ES("total_amount") + """ AS amount_total,
         """ + ES("CASE WHEN payment_status = 'PAID' THEN total_amount ELSE 0.0 END") + """ AS amount_paid,
         """ + ES("CASE WHEN payment_status <> 'PAID' THEN total_amount ELSE 0.0 END") + """ AS amount_outstanding,
         CAST(SUM(CASE WHEN payment_status = 'PAID' THEN 1 ELSE 0 END) AS BIGINT) AS paid_count,
         CAST(SUM(CASE WHEN payment_status = 'PENDING' THEN 1 ELSE 0 END) AS BIGINT) AS pending_count,
         CAST(SUM(CASE WHEN payment_status = 'DISPUTED' THEN 1 ELSE 0 END) AS BIGINT) AS disputed_count,
         CAST(SUM(CASE WHEN fraud_flag = true THEN 1 ELSE 0 END) AS BIGINT) AS fraud_count,
         CAST(SUM(CASE WHEN fraud_flag = true THEN 1 ELSE 0 END) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) AS fraud_rate
  FROM bills GROUP BY due_date)"""

RENEWABLE = f"""
ren_feed AS (
  SELECT event_id AS reading_id, user_id AS plant_id, ts AS event_ts, value AS production_mw,
         value * 0.9::DOUBLE AS grid_injection_mw,
         CASE WHEN ts >= TIMESTAMP '2024-01-16' THEN value * 0.1::DOUBLE END AS curtailment_mw,
         CASE WHEN ts >= TIMESTAMP '2024-01-16' THEN CAST(k AS DOUBLE) END AS battery_storage_mwh
  FROM {EV_K}),
ren_hourly AS (
  SELECT date_trunc('hour', event_ts) AS hour_ts, CAST(date_trunc('hour', event_ts) AS DATE) AS event_date, plant_id,
         {ES("production_mw")} AS production_mw_sum,
         {ES("grid_injection_mw")} AS grid_injection_mw_sum,
         {ES("COALESCE(curtailment_mw, 0.0)")} AS curtailment_mw_sum,
         MAX(battery_storage_mwh) AS battery_storage_mwh_max,
         {GR(ES("COALESCE(curtailment_mw, 0.0)"), ES("production_mw"))} AS curtailment_rate
  FROM ren_feed GROUP BY ALL),
ren_daily AS (
  SELECT event_date, {ES("production_mw_sum")} AS renewable_production_mw,
         {ES("grid_injection_mw_sum")} AS renewable_injection_mw,
         {ES("curtailment_mw_sum")} AS renewable_curtailment_mw,
         {GR(ES("curtailment_mw_sum"), ES("production_mw_sum"))} AS renewable_curtailment_rate
  FROM ren_hourly GROUP BY event_date)"""


def usage_hourly(src: str, name: str) -> str:
    return f"""
{name} AS (
  SELECT date_trunc('hour', event_ts) AS hour_ts, event_date, meter_id, region, state,
         {ES("kwh_consumed")} AS kwh_total, {EA("voltage_v")} AS voltage_avg, {EA("current_a")} AS current_avg,
         {EA("power_factor")} AS pf_avg,
         CAST(SUM(CAST(is_kwh_anomaly AS INTEGER)) AS BIGINT) AS anomaly_events,
         COUNT(*) AS reading_events,
         CAST(SUM(CAST(is_kwh_anomaly AS INTEGER)) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) AS anomaly_rate
  FROM {src} GROUP BY ALL)"""


def energy_daily(src: str, name: str) -> str:
    return f"""
{name} AS (
  SELECT event_date, region, state, {ES("kwh_total")} AS kwh_total,
         CAST(SUM(anomaly_events) AS BIGINT) AS meter_anomaly_events,
         CAST(SUM(reading_events) AS BIGINT) AS meter_reading_events,
         {GR("SUM(anomaly_events)", "SUM(reading_events)")} AS meter_anomaly_rate
  FROM {src} GROUP BY ALL)"""


HEALTH = """
health_hourly AS (
  SELECT hour_ts, event_date, transformer_id, region, state,
         MAX(risk_score) AS risk_score_max, AVG(risk_score) AS risk_score_avg,
         MIN(oil_temp_delta_c) FILTER (WHERE rn_p >= CEIL(0.95 * n_p)) AS oil_temp_delta_p95,
         MAX(dissolved_gas_ppm) AS dissolved_gas_max, MAX(load_pct) AS load_pct_max,
         CAST(SUM(risk_alarm) AS BIGINT) AS alarm_events, COUNT(*) AS telemetry_events,
         CASE WHEN MAX(risk_score) >= 6 THEN 'HIGH' WHEN MAX(risk_score) >= 3 THEN 'MEDIUM' ELSE 'LOW' END AS risk_level
  FROM (SELECT *, date_trunc('hour', telemetry_ts) AS hour_ts,
               ROW_NUMBER() OVER (PARTITION BY date_trunc('hour', telemetry_ts), event_date, transformer_id, region, state
                                  ORDER BY oil_temp_delta_c) AS rn_p,
               COUNT(oil_temp_delta_c) OVER (PARTITION BY date_trunc('hour', telemetry_ts), event_date, transformer_id,
                                             region, state) AS n_p
        FROM scored_tel)
  GROUP BY hour_ts, event_date, transformer_id, region, state),
risk_daily AS (
  SELECT event_date, region, state,
         CAST(SUM(CASE WHEN risk_level = 'HIGH' THEN 1 ELSE 0 END) AS BIGINT) AS transformers_high_risk_hours,
         CAST(SUM(CASE WHEN risk_level = 'MEDIUM' THEN 1 ELSE 0 END) AS BIGINT) AS transformers_medium_risk_hours,
         CAST(SUM(CASE WHEN risk_level = 'LOW' THEN 1 ELSE 0 END) AS BIGINT) AS transformers_low_risk_hours,
         COUNT(*) AS transformer_hours,
         CASE WHEN COUNT(*) > 0 THEN CAST(SUM(CASE WHEN risk_level = 'HIGH' THEN 1 ELSE 0 END) AS DOUBLE)
                                     / CAST(COUNT(*) AS DOUBLE) ELSE 0.0 END AS high_risk_rate
  FROM health_hourly GROUP BY ALL)"""

DASH_METERS = """
dm_feed AS (
  SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) || '-' || CAST(l_partkey AS VARCHAR)
           AS event_id,
         l_partkey AS meter_id, l_shipdate AS event_ts, CAST(l_shipdate AS DATE) AS event_date,
         l_quantity AS kwh_consumed, 200.0::DOUBLE + l_tax * 1000 AS voltage_v, l_discount * 100 AS current_a,
         1.0::DOUBLE - l_discount AS power_factor, l_returnflag AS region, l_linestatus AS state
  FROM lineitem)"""

OPS = ("WITH " + DASH_METERS + "," + thresholds("dm_feed", "dm_thr") + "," + scored("dm_feed", "dm_thr", "dm_scored")
       + "," + usage_hourly("dm_scored", "dm_hourly") + "," + energy_daily("dm_hourly", "energy") + ","
       + TELEMETRY + "," + HEALTH + "," + BILLS + "," + RENEWABLE + """,
ops AS (
  SELECT * FROM energy
  LEFT JOIN risk_daily USING (event_date, region, state)
  LEFT JOIN (SELECT bill_date AS event_date, tx_count, amount_total, amount_paid, amount_outstanding, fraud_rate
             FROM bill_daily) b USING (event_date)
  LEFT JOIN ren_daily USING (event_date))
""")


def key_line(cols: list[str]) -> str:
    def field(c: str) -> str:
        v = f"COALESCE(CAST({c} AS VARCHAR), '')"
        return (f"CASE WHEN regexp_matches({v}, '[,\"' || chr(10) || chr(13) || ']') "
                f"THEN '\"' || replace({v}, '\"', '\"\"') || '\"' ELSE {v} END")
    return "concat_ws(',', " + ", ".join(field(c) for c in cols) + ")"


def rule_rows(src: str, dataset: str, rules: list[tuple[str, str, str, list[str]]], layer: str = "SILVER",
              include_zero: bool = False, samples: bool = True) -> str:
    """UNION ALL of rule summary rows (count and, optionally, sample keys)."""
    parts = []
    for rule, sev, pred, keys in rules:
        order = ", ".join(f"{k} ASC NULLS FIRST" for k in keys)
        sample = ""
        if samples:
            sample = f""", '{",".join(keys)}' || ' | ' || (
            SELECT string_agg(line, ' | ' ORDER BY rn) FROM (
              SELECT {key_line(keys)} AS line, ROW_NUMBER() OVER (ORDER BY {order}) AS rn
              FROM {src} WHERE COALESCE({pred}, false)) WHERE rn <= 20) AS sample_keys"""
        having = "" if include_zero else "HAVING COUNT(*) FILTER (WHERE COALESCE(" + pred + ", false)) > 0"
        parts.append(f"""SELECT '{layer}' AS layer, '{dataset}' AS dataset, '{rule}' AS rule_name, '{sev}' AS severity,
            COUNT(*) FILTER (WHERE COALESCE({pred}, false)) AS violation_count{sample}
          FROM {src} {having}""")
    return "\nUNION ALL\n".join(parts)


BLANK = "({c} IS NULL OR trim(CAST({c} AS VARCHAR)) = '')"
METER_RULES = [
    ("PK_NOT_NULL_event_id", "CRITICAL", BLANK.format(c="event_id"), ["meter_id", "event_ts", "region"]),
    ("PK_NOT_NULL_meter_id", "CRITICAL", BLANK.format(c="meter_id"), ["event_id", "event_ts", "region"]),
    ("NEGATIVE_KWH", "WARNING", "kwh_consumed < 0", ["event_id", "meter_id", "kwh_consumed"]),
    ("INVALID_TIMESTAMP", "CRITICAL", "event_ts IS NULL", ["event_id", "meter_id"]),
    ("VOLTAGE_OUT_OF_RANGE", "WARNING", "(voltage_v < 150 OR voltage_v > 300)", ["event_id", "meter_id", "voltage_v", "region"]),
]
TEL_RULES = [
    ("PK_NOT_NULL_telemetry_id", "CRITICAL", BLANK.format(c="telemetry_id"), ["transformer_id", "telemetry_ts", "region"]),
    ("PK_NOT_NULL_transformer_id", "CRITICAL", BLANK.format(c="transformer_id"), ["telemetry_id", "telemetry_ts", "region"]),
    ("INVALID_TIMESTAMP", "CRITICAL", "telemetry_ts IS NULL", ["telemetry_id", "transformer_id", "region"]),
    ("OIL_TEMP_DELTA_IMPLAUSIBLE", "WARNING", "oil_temp_delta_c > 80", ["telemetry_id", "transformer_id", "oil_temp_delta_c", "region"]),
]
BILL_RULES = [
    ("PK_NOT_NULL_transaction_id", "CRITICAL", BLANK.format(c="transaction_id"), ["customer_id", "cdc_ts"]),
    ("NEGATIVE_AMOUNT", "WARNING", "total_amount < 0", ["transaction_id", "customer_id", "total_amount"]),
]
END_RULE = [("SCD2_CURRENT_END_DATE_NOT_MAX", "WARNING", "(is_current AND record_end_date <> DATE '9999-12-31')",
             ["customer_id", "record_end_date", "scd_version"])]
MULTI_RULE = [("SCD2_MULTIPLE_CURRENT_RECORDS", "CRITICAL", "true", ["customer_id", "count"])]
MULTI_SRC = "(SELECT customer_id, COUNT(*) AS count FROM append_only WHERE is_current GROUP BY customer_id HAVING COUNT(*) > 1)"

FAULTY = """
faulty_m AS (
  SELECT * REPLACE (CASE WHEN event_id % 40 = 3 THEN NULL ELSE event_id END AS event_id,
                    CASE WHEN event_id % 40 = 5 THEN NULL ELSE meter_id END AS meter_id,
                    CASE WHEN event_id % 40 = 7 THEN -kwh_consumed ELSE kwh_consumed END AS kwh_consumed,
                    CASE WHEN event_id % 40 = 9 THEN NULL ELSE event_ts END AS event_ts) FROM meter_feed
  UNION ALL SELECT * REPLACE (event_ts - INTERVAL 1 HOUR AS event_ts) FROM meter_feed WHERE event_id % 40 = 11),
dq_meters AS (
  SELECT * FROM faulty_m WHERE event_id IS NULL UNION ALL
  (SELECT * FROM faulty_m WHERE event_id IS NOT NULL
   QUALIFY ROW_NUMBER() OVER (PARTITION BY event_id ORDER BY event_ts DESC) = 1)),
faulty_t AS (
  SELECT * REPLACE (CASE WHEN substation_id % 50 = 1 THEN NULL ELSE telemetry_id END AS telemetry_id,
                    CASE WHEN substation_id % 50 = 2 THEN NULL ELSE transformer_id END AS transformer_id,
                    CASE WHEN substation_id % 50 = 3 THEN NULL ELSE telemetry_ts END AS telemetry_ts),
         oil_temperature_c - ambient_temperature_c AS oil_temp_delta_c FROM tel_feed),
dq_tel AS (
  SELECT * FROM faulty_t WHERE telemetry_id IS NULL UNION ALL
  (SELECT * FROM faulty_t WHERE telemetry_id IS NOT NULL
   QUALIFY ROW_NUMBER() OVER (PARTITION BY telemetry_id ORDER BY telemetry_ts DESC NULLS LAST, substation_id DESC,
                              transformer_id DESC NULLS LAST) = 1)),
dq_bills AS (
  SELECT * REPLACE (CASE WHEN transaction_id % 60 = 1 THEN NULL ELSE transaction_id END AS transaction_id,
                    CASE WHEN transaction_id % 60 = 2 THEN -total_amount ELSE total_amount END AS total_amount) FROM bills),
early_end AS (
  SELECT * REPLACE (CASE WHEN c_nationkey = 3 THEN DATE '2025-12-31' ELSE record_end_date END AS record_end_date) FROM cust_dim)"""
DQ_WITH = "WITH " + METER_FEED + "," + TELEMETRY + "," + BILLS + "," + CUSTOMER + "," + FAULTY


def _pick(rules, names):
    return [r for r in rules if r[0] in names]


RANGES = ("(" + rule_rows("dq_meters", "smart_meter_readings", _pick(METER_RULES, {"NEGATIVE_KWH", "VOLTAGE_OUT_OF_RANGE"}))
          + "\nUNION ALL\n" + rule_rows("dq_tel", "substation_telemetry", _pick(TEL_RULES, {"OIL_TEMP_DELTA_IMPLAUSIBLE"}))
          + "\nUNION ALL\n" + rule_rows("dq_bills", "billing_transactions_current", _pick(BILL_RULES, {"NEGATIVE_AMOUNT"})) + ")")


def _coverage(metric: str, facts: str, dim: str, key: str) -> str:
    return f"""SELECT '{metric}' AS metric_name, COUNT(*) AS keys_in_facts,
         CAST(SUM(COALESCE(hit, 0)) AS BIGINT) AS keys_found_in_dim,
         printf('%.4f', CASE WHEN COUNT(*) > 0 THEN CAST(SUM(COALESCE(hit, 0)) AS DOUBLE) / COUNT(*) ELSE 0.0 END)
           AS metric_value
  FROM (SELECT DISTINCT {key} FROM {facts}) f
  LEFT JOIN (SELECT DISTINCT {key}, 1 AS hit FROM {dim} WHERE is_current) d USING ({key})"""


def _ri(name: str, child: str, fk: str, parent: str, pk: str) -> str:
    return f"""SELECT '{name}' AS relationship, COUNT(*) AS child_rows,
         COUNT(*) FILTER (WHERE c.{fk} IS NULL) AS null_fk_rows,
         COUNT(*) FILTER (WHERE c.{fk} IS NOT NULL AND p.k IS NULL) AS orphan_rows,
         COUNT(DISTINCT c.{fk}) FILTER (WHERE c.{fk} IS NOT NULL AND p.k IS NULL) AS orphan_keys
  FROM {child} c LEFT JOIN (SELECT DISTINCT {pk} AS k FROM {parent}) p ON c.{fk} = p.k"""


ORACLES: dict[str, str] = {
    "q_parse_event_time": """SELECT event_id, TRY_CAST(CAST(ts AS VARCHAR) AS TIMESTAMP) AS event_ts,
        CAST(TRY_CAST(CAST(ts AS VARCHAR) AS TIMESTAMP) AS DATE) AS event_date FROM events""",
    "q_hour_bucket": "SELECT event_id, date_trunc('hour', ts) AS hour_ts FROM events",
    "q_lineage": """SELECT event_id, 'smart_meter' AS _source_system, 'bench-batch' AS _batch_id,
        'events.parquet' AS source_file, true AS has_ingestion_ts FROM events""",
    "q_resolve_column": "SELECT o_orderkey AS transaction_id, o_totalprice AS amount, 'total_amount' AS amount_source FROM orders",
    "q_schema_evolve": f"WITH {RENEWABLE} SELECT reading_id, production_mw, curtailment_mw, battery_storage_mwh FROM ren_feed",
    "q_ts_from_filename": """SELECT event_id AS reading_id,
        'landing/renewable_production_' || strftime(ts, '%Y%m%d') || '_' || strftime(ts, '%H') || '00.json' AS source_file,
        date_trunc('hour', ts) AS event_ts FROM events""",
    "q_scd2_baseline": f"WITH {CUSTOMER} SELECT * FROM cust_dim",
    "q_parse_envelope": "SELECT CAST(json_extract(props, '$.k') AS INTEGER) AS k, event_id, ts FROM events",
    "q_dedup_latest": f"WITH {TELEMETRY} SELECT * FROM tel_latest",
    "q_cdc_latest": f"""WITH {CDC} SELECT * FROM cdc_feed WHERE "__$operation" IS DISTINCT FROM 3
        QUALIFY ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {CDC_ORDER}) = 1""",
    "q_cdc_delete": cdc_result("1", False),
    "q_cdc_upsert": cdc_result("2, 4", True),
    "q_cdc_apply": cdc_result("1, 2, 4", True),
    "q_cdc_op_name": f"""WITH {CDC} SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, cdc_ts, "__$operation",
        CASE "__$operation" WHEN 2 THEN 'INSERT' WHEN 4 THEN 'UPDATE' WHEN 1 THEN 'DELETE' END AS cdc_operation
        FROM cdc_feed""",
    "q_scd2_next_version": f"""WITH {CUSTOMER} SELECT d.*, CAST(COALESCE(c.scd_version + 1, 1) AS INTEGER) AS scd_version
        FROM cust_delta d LEFT JOIN (SELECT customer_id, scd_version FROM cust_dim WHERE is_current) c
        ON d.customer_id = c.customer_id""",
    "q_scd2_apply": f"WITH {CUSTOMER} SELECT * FROM scd_applied",
    "q_scd2_expired": f"WITH {CUSTOMER} SELECT * EXCLUDE (_scd_action) FROM scd_changes WHERE _scd_action = 'expire'",
    "q_scd2_inserted": f"WITH {CUSTOMER} SELECT * FROM scd_changes WHERE _scd_action IN ('new_version', 'new_key')",
    "q_dim_current": f"WITH {CUSTOMER} SELECT * FROM scd_applied WHERE is_current",
    "q_snapshot_diff": """WITH new AS (
          SELECT c_custkey, c_name, c_nationkey,
                 CASE WHEN c_mktsegment = 'BUILDING' THEN c_acctbal + 100 ELSE c_acctbal END AS c_acctbal, c_mktsegment
          FROM customer WHERE c_mktsegment <> 'HOUSEHOLD'
          UNION ALL
          SELECT c_custkey + 1000000000, c_name, c_nationkey, c_acctbal, c_mktsegment
          FROM customer WHERE c_mktsegment = 'MACHINERY'),
        j AS (SELECT o.c_custkey AS o_key, n.c_custkey AS n_key, o.c_name AS o_name, n.c_name AS n_name,
                     o.c_nationkey AS o_nat, n.c_nationkey AS n_nat, o.c_acctbal AS o_bal, n.c_acctbal AS n_bal,
                     o.c_mktsegment AS o_seg, n.c_mktsegment AS n_seg
              FROM customer o FULL OUTER JOIN new n ON o.c_custkey = n.c_custkey)
        SELECT o_key AS c_custkey, o_name AS c_name, o_nat AS c_nationkey, o_bal AS c_acctbal, o_seg AS c_mktsegment,
               CASE WHEN n_key IS NULL THEN 'delete' ELSE 'update_preimage' END AS _change_type
        FROM j WHERE o_key IS NOT NULL AND (n_key IS NULL OR o_name IS DISTINCT FROM n_name
              OR o_nat IS DISTINCT FROM n_nat OR o_bal IS DISTINCT FROM n_bal OR o_seg IS DISTINCT FROM n_seg)
        UNION ALL
        SELECT n_key, n_name, n_nat, n_bal, n_seg,
               CASE WHEN o_key IS NULL THEN 'insert' ELSE 'update_postimage' END
        FROM j WHERE n_key IS NOT NULL AND (o_key IS NULL OR o_name IS DISTINCT FROM n_name
              OR o_nat IS DISTINCT FROM n_nat OR o_bal IS DISTINCT FROM n_bal OR o_seg IS DISTINCT FROM n_seg)""",
    "q_region_thresholds": f"WITH {METER_FEED}, {thresholds('meters', 'thr')} SELECT * FROM thr",
    "q_meter_anomaly": f"""WITH {SCORED_METERS} SELECT event_id, meter_id, region, kwh_consumed, is_kwh_anomaly,
        anomaly_type FROM scored_meters""",
    "q_risk_flags": f"""WITH {TELEMETRY} SELECT telemetry_id, oil_temp_delta_c, risk_alarm, risk_oil_temp, risk_gas,
        risk_vibration, risk_overload FROM scored_tel""",
    "q_risk_score": f"WITH {TELEMETRY} SELECT telemetry_id, risk_score FROM scored_tel",
    "q_risk_level": f"WITH {TELEMETRY} SELECT telemetry_id, risk_score, risk_level FROM scored_tel",
    "q_band_anomaly": f"""WITH {METER_FEED} SELECT event_id, kwh_consumed,
        CASE WHEN kwh_consumed BETWEEN 0.001 AND 0.05 THEN 'SUSPECTED_THEFT'
             WHEN kwh_consumed BETWEEN 50.0 AND 120.0 THEN 'SPIKE' END AS band_anomaly FROM meter_feed""",
    "q_billing_mismatch": f"""WITH {BILLS},
        charge AS (SELECT l_orderkey AS transaction_id,
                          {ES("l_extendedprice * (1 - l_discount) * (1 + l_tax)")} AS metered_charge
                   FROM lineitem GROUP BY l_orderkey)
        SELECT b.transaction_id, round(b.total_amount, 6) AS total_amount, round(c.metered_charge, 6) AS metered_charge,
               round(abs(c.metered_charge * 1.0::DOUBLE - b.total_amount) / b.total_amount, 6) AS mismatch_ratio,
               b.total_amount / 1000.0::DOUBLE BETWEEN 0.01 AND 50.0 AS base_amount_in_fraud_band
        FROM bills b LEFT JOIN charge c USING (transaction_id)""",
    "q_usage_hourly": f"WITH {SCORED_METERS}, {usage_hourly('scored_meters', 'hourly')} SELECT {R(*USAGE)} FROM hourly",
    "q_meter_customers": f"WITH {CUSTOMER} SELECT DISTINCT meter_id, customer_id FROM cust_dim WHERE is_current",
    "q_usage_customer": f"""WITH {SCORED_METERS}, {usage_hourly('scored_meters', 'hourly')}, {CUSTOMER}
        SELECT {R(*USAGE)} FROM hourly LEFT JOIN (SELECT meter_id, MIN(customer_id) AS customer_id, COUNT(*) AS meter_owner_count
                                        FROM cust_dim WHERE is_current GROUP BY meter_id) o USING (meter_id)""",
    "q_health_hourly": f"WITH {TELEMETRY}, {HEALTH} SELECT * FROM health_hourly",
    "q_health_enriched": f"""WITH {TELEMETRY}, {HEALTH}, {TRANSFORMER}
        SELECT * FROM health_hourly LEFT JOIN (SELECT transformer_id, s_name, region AS dim_region, s_acctbal
                                               FROM trf_dim WHERE is_current) d USING (transformer_id)""",
    "q_billing_daily": f"WITH {BILLS} SELECT {R(*BILLED)} FROM bill_daily",
    "q_renewable_hourly": f"WITH {RENEWABLE} SELECT {R(*REN_HOUR)} FROM ren_hourly",
    "q_renewable_daily": f"WITH {RENEWABLE} SELECT {R(*REN_DAY)} FROM ren_daily",
    "q_energy_daily": f"""WITH {SCORED_METERS}, {usage_hourly('scored_meters', 'hourly')}, {energy_daily('hourly', 'energy')}
        SELECT {R("kwh_total", "meter_anomaly_rate")} FROM energy""",
    "q_risk_daily": f"WITH {TELEMETRY}, {HEALTH} SELECT * FROM risk_daily",
    "q_ops_daily": OPS + f"SELECT {R(*OPS_DOUBLES)} FROM ops",
    "q_ops_snapshot": OPS + f"SELECT {R(*OPS_DOUBLES)} FROM ops ORDER BY event_date DESC, region ASC NULLS FIRST, state ASC NULLS FIRST LIMIT 30",
    "q_dq_null_keys": DQ_WITH + " SELECT * FROM (" + "\nUNION ALL\n".join([
        rule_rows("dq_meters", "smart_meter_readings", _pick(METER_RULES, {"PK_NOT_NULL_event_id", "PK_NOT_NULL_meter_id"}), include_zero=True, samples=False),
        rule_rows("dq_tel", "substation_telemetry", _pick(TEL_RULES, {"PK_NOT_NULL_telemetry_id", "PK_NOT_NULL_transformer_id"}), include_zero=True, samples=False),
        rule_rows("dq_bills", "billing_transactions_current", _pick(BILL_RULES, {"PK_NOT_NULL_transaction_id"}), include_zero=True, samples=False)]) + ")",
    "q_dq_ranges": DQ_WITH + " SELECT dataset, rule_name, severity, violation_count FROM " + RANGES,
    "q_dq_samples": DQ_WITH + " SELECT dataset, rule_name, sample_keys FROM " + RANGES,
    "q_dq_bad_ts": DQ_WITH + " SELECT * FROM (" + "\nUNION ALL\n".join([
        rule_rows("dq_meters", "smart_meter_readings", _pick(METER_RULES, {"INVALID_TIMESTAMP"}), include_zero=True, samples=False),
        rule_rows("dq_tel", "substation_telemetry", _pick(TEL_RULES, {"INVALID_TIMESTAMP"}), include_zero=True, samples=False)]) + ")",
    "q_dq_multi_current": f"WITH {CUSTOMER} " + rule_rows(MULTI_SRC, "dim_customer", MULTI_RULE),
    "q_dq_scd2_end": DQ_WITH + " SELECT * FROM (" + rule_rows("scd_applied", "dim_customer", END_RULE, include_zero=True, samples=False)
    + "\nUNION ALL\n" + rule_rows("append_only", "dim_customer_append_only", END_RULE, include_zero=True, samples=False)
    + "\nUNION ALL\n" + rule_rows("early_end", "dim_customer_early_end", END_RULE, include_zero=True, samples=False) + ")",
    "q_dq_empty": OPS + """SELECT 'GOLD' AS layer, 'ops_daily_dashboard' AS dataset, 'GOLD_EMPTY_TABLE' AS rule_name,
          'CRITICAL' AS severity, CAST(1 AS BIGINT) AS violation_count, '' AS sample_keys
        FROM (SELECT COUNT(*) AS n FROM ops) WHERE n = 0
        UNION ALL
        SELECT 'GOLD', 'ops_daily_negative_energy', 'GOLD_EMPTY_TABLE', 'CRITICAL', CAST(1 AS BIGINT), ''
        FROM (SELECT COUNT(*) AS n FROM ops WHERE kwh_total < 0) WHERE n = 0""",
    "q_dq_report": DQ_WITH + " SELECT * FROM (" + "\nUNION ALL\n".join([
        rule_rows("dq_meters", "smart_meter_readings", METER_RULES),
        rule_rows("dq_tel", "substation_telemetry", TEL_RULES),
        rule_rows("dq_bills", "billing_transactions_current", BILL_RULES),
        rule_rows(MULTI_SRC, "dim_customer", MULTI_RULE),
        rule_rows("early_end", "dim_customer", END_RULE)])
    + ") ORDER BY CASE severity WHEN 'CRITICAL' THEN 1 WHEN 'WARNING' THEN 2 ELSE 3 END, dataset, rule_name",
    "q_join_coverage": f"WITH {SCORED_METERS}, {TELEMETRY}, {CUSTOMER}, {TRANSFORMER} "
    + _coverage("meter_to_customer_join_coverage", "scored_meters", "cust_dim", "meter_id")
    + "\nUNION ALL\n" + _coverage("telemetry_to_transformer_join_coverage", "scored_tel", "trf_dim", "transformer_id")
    + "\nUNION ALL\n" + _coverage("faulty telemetry_to_transformer_join_coverage", """(SELECT CASE WHEN substation_id % 50 = 2
        THEN transformer_id + 1000000000 ELSE transformer_id END AS transformer_id FROM tel_latest)""", "trf_dim", "transformer_id"),
    "q_referential_integrity": "\nUNION ALL\n".join([
        _ri("faulty orders.o_custkey->customer", """(SELECT CASE WHEN o_orderkey % 50 = 1 THEN NULL WHEN o_orderkey % 50 = 2
            THEN o_custkey + 1000000000 ELSE o_custkey END AS o_custkey FROM orders)""", "o_custkey", "customer", "c_custkey"),
        _ri("orders.o_custkey->customer", "orders", "o_custkey", "customer", "c_custkey"),
        _ri("lineitem.l_orderkey->orders", "lineitem", "l_orderkey", "orders", "o_orderkey"),
        _ri("lineitem.l_suppkey->supplier", "lineitem", "l_suppkey", "supplier", "s_suppkey"),
        _ri("lineitem.l_partkey->part", "lineitem", "l_partkey", "part", "p_partkey"),
        _ri("events.user_id->customer", "events", "user_id", "customer", "c_custkey"),
        _ri("customer.c_nationkey->nation", "customer", "c_nationkey", "nation", "n_nationkey"),
        _ri("supplier.s_nationkey->nation", "supplier", "s_nationkey", "nation", "n_nationkey"),
        _ri("nation.n_regionkey->region", "nation", "n_regionkey", "region", "r_regionkey")]),
    "q_time_bounds": f"""WITH {SCORED_METERS}, {TELEMETRY}, {BILLS}
        SELECT 'smart_meter_readings' AS source, MIN(event_ts) AS min_ts, MAX(event_ts) AS max_ts FROM scored_meters
        UNION ALL SELECT 'substation_telemetry', MIN(telemetry_ts), MAX(telemetry_ts) FROM scored_tel
        UNION ALL SELECT 'billing_transactions_current', MIN(cdc_ts), MAX(cdc_ts) FROM bills""",
    "q_rowcounts": f"""WITH {SCORED_METERS}, {TELEMETRY}, {BILLS}, {usage_hourly('scored_meters', 'hourly')}
        """ + "\nUNION ALL\n".join(
        [f"SELECT 'BRONZE' AS layer, '{t}' AS table_name, COUNT(*) AS row_count FROM {t}"
         for t in ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]]
        + ["SELECT 'SILVER', 'smart_meter_readings', COUNT(*) FROM scored_meters",
           "SELECT 'SILVER', 'substation_telemetry', COUNT(*) FROM scored_tel",
           "SELECT 'GOLD', 'customer_hourly_usage', COUNT(*) FROM hourly",
           "SELECT 'GOLD', 'billing_kpis_daily', COUNT(*) FROM bill_daily"]),
    "q_scd2_variant": f"""WITH {CUSTOMER}, v AS (
          SELECT *, t_id IS NOT NULL AND s_id IS NOT NULL AND (t_c_acctbal IS DISTINCT FROM s_c_acctbal
                    OR t_c_mktsegment IS DISTINCT FROM s_c_mktsegment) AS ch FROM scd_join)
        SELECT t_id AS customer_id, t_meter_id AS meter_id, t_c_name AS c_name, t_c_nationkey AS c_nationkey,
               t_c_acctbal AS c_acctbal, t_c_mktsegment AS c_mktsegment, t_eff AS record_effective_date,
               CASE WHEN ch THEN CAST(s_eff AS DATE) ELSE t_end END AS record_end_date, NOT ch AS is_current,
               t_version AS scd_version FROM v WHERE t_id IS NOT NULL
        UNION ALL
        SELECT s_id, s_meter_id, s_c_name, s_c_nationkey, s_c_acctbal, s_c_mktsegment, CAST(s_eff AS DATE),
               CAST(s_end AS DATE), true, 1 FROM v WHERE t_id IS NULL""",
    "q_metrics_report": f"""WITH {BILLS}
        SELECT layer, lower(layer) || '.' || name AS table_fqn, 'rowcount' AS metric_name, CAST(n AS VARCHAR) AS metric_value
        FROM (SELECT 'BRONZE' AS layer, 'orders' AS name, COUNT(*) AS n FROM orders
              UNION ALL SELECT 'BRONZE', 'lineitem', COUNT(*) FROM lineitem
              UNION ALL SELECT 'BRONZE', 'events', COUNT(*) FROM events
              UNION ALL SELECT 'SILVER', 'billing_transactions_current', COUNT(*) FROM bills)""",
    "q_partition_overwrite": f"""WITH {BILLS}
        SELECT bill_month, payment_status, n + CASE WHEN bill_month BETWEEN 199501 AND 199503 THEN 1000 ELSE 0 END AS tx_count
        FROM (SELECT CAST(year(due_date) * 100 + month(due_date) AS INTEGER) AS bill_month, payment_status, COUNT(*) AS n
              FROM bills GROUP BY ALL)""",
    "q_cdc_stream": f"""WITH {CDC} SELECT * FROM (SELECT * FROM cdc_feed WHERE "__$operation" IS DISTINCT FROM 3
        QUALIFY ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {CDC_ORDER}) = 1)
        WHERE "__$operation" IN (2, 4)""",
    "q_csv_feed": """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_custkey END AS o_custkey, o_totalprice,
        o_orderstatus FROM orders""",
    "q_scd2_deltas": f"""WITH {TRANSFORMER}
        SELECT transformer_id, s_name, region, s_acctbal, record_effective_date,
               CASE WHEN region < 10 THEN DATE '2025-04-30' ELSE DATE '2025-05-31' END AS record_end_date,
               false AS is_current, scd_version FROM trf_dim
        UNION ALL
        SELECT transformer_id, s_name, region, s_acctbal + 1, DATE '2025-05-01', DATE '2025-05-31', false, 2
        FROM trf_dim WHERE region < 10
        UNION ALL
        SELECT transformer_id, s_name, region, s_acctbal + 2, DATE '2025-06-01', DATE '9999-12-31', true,
               CASE WHEN region < 10 THEN 3 ELSE 2 END FROM trf_dim""",
    "q_meter_silver": f"""WITH m AS (
          SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS VARCHAR) AS meter_id, event_type AS region,
                 TRY_CAST(CAST(ts AS VARCHAR) AS TIMESTAMP) AS event_ts, value AS kwh_consumed FROM events),
        t AS ({thresholds('m', 'x').split('AS (', 1)[1].rsplit(')', 1)[0]})
        SELECT m.event_id, m.meter_id, m.region, m.event_ts, CAST(m.event_ts AS DATE) AS event_date, m.kwh_consumed,
               (m.kwh_consumed < t.p01_kwh) OR (m.kwh_consumed > t.p99_kwh) AS is_kwh_anomaly,
               CASE WHEN m.kwh_consumed < t.p01_kwh THEN 'LOW_CONSUMPTION'
                    WHEN m.kwh_consumed > t.p99_kwh THEN 'HIGH_CONSUMPTION' END AS anomaly_type
        FROM m LEFT JOIN t ON m.region = t.region""",
    "q_maintenance_silver": """SELECT o_orderkey AS log_id, o_custkey AS transformer_id,
        CAST(o_orderdate AS DATE) AS reported_date, CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AS maintenance_ts
        FROM orders""",
    "q_renewable_silver": """SELECT event_id AS reading_id, user_id AS plant_id, value AS production_mw,
        date_trunc('hour', ts) AS event_ts, CAST(date_trunc('hour', ts) AS DATE) AS event_date,
        CAST(NULL AS DOUBLE) AS curtailment_mw, CAST(NULL AS DOUBLE) AS battery_storage_mwh FROM events""",
    "q_billing_silver": """SELECT o_orderkey AS transaction_id,
        strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%g') AS cdc_timestamp,
        CAST(o_orderdate AS DATE) AS billing_period_start, CAST(o_orderdate AS DATE) + 29 AS billing_period_end,
        CAST(o_orderdate AS DATE) + 30 AS due_date, o_orderdate AS cdc_ts FROM orders""",
    "q_overheat_signal": f"""WITH {TELEMETRY} SELECT telemetry_id, transformer_id, oil_temp_delta_c FROM scored_tel
        WHERE oil_temp_delta_c BETWEEN 60.0 AND 90.0""",
    "q_canonicalize": "SELECT event_id, value AS kwh_consumed, value / 5 AS load_pct FROM events",
    "q_key_validity": "\nUNION ALL\n".join(
        f"SELECT '{feed}' AS feed, '{route}' AS route, COUNT(*) AS n FROM {src} WHERE "
        + ("NOT " if route == "valid" else "") + f"({key} IS NULL OR trim(CAST({key} AS VARCHAR)) = '')"
        for feed, src, key in [("smart_meter", "events", "event_id"),
                               ("telemetry", "(SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) "
                                             "AS telemetry_id FROM lineitem)", "telemetry_id"),
                               ("telemetry_alarm", "(SELECT CASE WHEN l_returnflag = 'R' THEN 'OVERLOAD' "
                                                   "WHEN l_returnflag = 'A' THEN '' END AS alarm_code FROM lineitem)",
                                "alarm_code")]
        for route in ("valid", "quarantine")),
}


_CDC_VALUES = '"__$operation", "__$seqval", "__$start_lsn", cdc_ts, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_linestatus'
# what a watermark leaves: held-back events of the first third, far behind the newest event of the second, are late
_ON_TIME = """SELECT e.* FROM events e, (SELECT MIN(ts) + to_seconds(date_diff('second', MIN(ts), MAX(ts)) // 3) AS cut FROM events)
        WHERE NOT (event_id % 50 = 7 AND ts < cut)"""
_LANDED = [("BRONZE", "bronze.smart_meter_events", "events"), ("BRONZE", "bronze.substation_telemetry_events", "events"),
           ("BRONZE", "bronze.billing_cdc_events", "events"), ("BRONZE", "bronze.maintenance_logs", "supplier"),
           ("BRONZE", "bronze.transformer_master_snapshot", "supplier"),
           ("BRONZE", "bronze.transformer_master_delta", "(SELECT * FROM supplier UNION ALL SELECT * FROM supplier)"),
           ("BRONZE", "bronze.customer_master_snapshot", "customer"), ("BRONZE", "bronze.renewable_production", "events"),
           ("SILVER", "silver.smart_meter_readings", "meters"), ("SILVER", "silver.smart_meter_quarantine", "(SELECT 1 WHERE false)"),
           ("SILVER", "silver.substation_telemetry", "meters"), ("SILVER", "silver.substation_telemetry_quarantine", "(SELECT 1 WHERE false)"),
           ("SILVER", "silver.maintenance_logs", "supplier"), ("SILVER", "silver.dim_customer", "customer"),
           ("SILVER", "silver.renewable_production", "(SELECT DISTINCT event_id FROM events)"),
           ("SILVER", "silver.renewable_quarantine", "(SELECT 1 WHERE false)"), ("SILVER", "silver.dim_transformer_quarantine", "(SELECT 1 WHERE false)"),
           ("SILVER", "silver.dim_transformer", "(SELECT * FROM supplier UNION ALL SELECT * FROM supplier)"),
           ("SILVER", "silver.billing_quarantine", "(SELECT 1 WHERE false)"), ("SILVER", "silver.billing_transactions_current", "live"),
           ("GOLD", "gold.customer_hourly_usage", "(SELECT DISTINCT date_trunc('hour', event_ts), meter_id, region, state FROM meters)"),
           ("GOLD", "gold.transformer_health_hourly", "(SELECT DISTINCT date_trunc('hour', event_ts), meter_id, region, state FROM meters)"),
           ("GOLD", "gold.billing_kpis_daily", "(SELECT DISTINCT CAST(cdc_ts AS DATE) FROM live)"),
           ("GOLD", "gold.renewable_kpis_hourly", "(SELECT DISTINCT date_trunc('hour', ts), user_id FROM events)"),
           ("GOLD", "gold.ops_daily_dashboard", "(SELECT DISTINCT event_date, region, state FROM meters)"),
           ]
ORACLES |= {
    "q_meter_signals": f"""WITH {METER_FEED} SELECT event_id, kwh_consumed, status AS meter_status,
        CASE WHEN kwh_consumed BETWEEN 0.001 AND 0.05 THEN 'SUSPECTED_THEFT' WHEN kwh_consumed BETWEEN 50.0 AND 120.0 THEN 'SPIKE'
             WHEN status IN ('TAMPERED', 'DISCONNECTED') THEN 'STATUS_' || status END AS signal
        FROM (SELECT *, CASE WHEN voltage_v < 160 THEN 'TAMPERED' WHEN voltage_v < 180 THEN 'DISCONNECTED' WHEN voltage_v < 330 THEN 'ACTIVE' END AS status
              FROM meter_feed)""",
    "q_region_thresholds_stored": ORACLES["q_region_thresholds"],
    "q_write_metrics": f"""WITH {METER_FEED}, {TELEMETRY}, {BILLS}
        SELECT 'smart_meter_readings' AS table_name, COUNT(*) AS row_count, MIN(event_ts) AS min_ts, MAX(event_ts) AS max_ts FROM meters
        UNION ALL SELECT 'substation_telemetry', COUNT(*), MIN(telemetry_ts), MAX(telemetry_ts) FROM tel_latest
        UNION ALL SELECT 'billing_transactions_current', COUNT(*), MIN(cdc_ts), MAX(cdc_ts) FROM bills""",
    "q_landed_feeds": f"""WITH {METER_FEED}, live AS (
          SELECT * FROM (SELECT user_id, event_id, ts AS cdc_ts FROM events QUALIFY ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1)
          WHERE event_id % 3 <> 2) """
    + " UNION ALL ".join(f"SELECT '{layer}' AS layer, '{name}' AS table_fqn, 'rowcount' AS metric_name, CAST(COUNT(*) AS VARCHAR) AS metric_value FROM {rows}"
                         for layer, name, rows in _LANDED)
    + "".join(f" UNION ALL SELECT 'BRONZE', '{name}', 'status', 'loaded'" for layer, name, _ in _LANDED if layer == "BRONZE"),
    "q_stream_dedup": _ON_TIME,
    "q_stream_dedup_id": _ON_TIME,
    "q_usage_hourly_stream": ORACLES["q_usage_hourly"],
    "q_health_hourly_stream": ORACLES["q_health_hourly"],
    "q_renewable_hourly_stream": ORACLES["q_renewable_hourly"],
    "q_cdc_apply_buckets": ORACLES["q_cdc_stream"],
    "q_change_feed": f"""WITH {CDC},
      live AS (SELECT * FROM (
          SELECT v, c.* FROM cdc_feed c JOIN (VALUES (0, TIMESTAMP '1996-06-01'), (1, TIMESTAMP '1998-01-01'), (2, TIMESTAMP '9999-01-01')) t(v, upto)
            ON cdc_ts < upto WHERE "__$operation" IS DISTINCT FROM 3
          QUALIFY ROW_NUMBER() OVER (PARTITION BY v, l_orderkey, l_linenumber ORDER BY {CDC_ORDER}) = 1) WHERE "__$operation" IN (2, 4)),
      before AS (SELECT v + 1 AS v, * EXCLUDE (v) FROM live WHERE v < 2)
      SELECT * EXCLUDE (v), 'insert' AS _change_type, CAST(v AS BIGINT) AS _commit_version
        FROM live ANTI JOIN before USING (v, l_orderkey, l_linenumber)
      UNION ALL SELECT * EXCLUDE (v), 'delete', CAST(v AS BIGINT) FROM before ANTI JOIN live USING (v, l_orderkey, l_linenumber)
      UNION ALL SELECT * EXCLUDE (v), 'update_preimage', CAST(v AS BIGINT) FROM before SEMI JOIN live USING (v, l_orderkey, l_linenumber)
        WHERE (v, l_orderkey, l_linenumber, {_CDC_VALUES}) NOT IN (SELECT (v, l_orderkey, l_linenumber, {_CDC_VALUES}) FROM live)
      UNION ALL SELECT * EXCLUDE (v), 'update_postimage', CAST(v AS BIGINT) FROM live SEMI JOIN before USING (v, l_orderkey, l_linenumber)
        WHERE (v, l_orderkey, l_linenumber, {_CDC_VALUES}) NOT IN (SELECT (v, l_orderkey, l_linenumber, {_CDC_VALUES}) FROM before)""",
    "q_scd2_buckets": ORACLES["q_scd2_apply"],
    "q_latest_incremental": ORACLES["q_dedup_latest"],
}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
