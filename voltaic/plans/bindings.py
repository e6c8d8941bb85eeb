"""Bindings of every operator to the driver's test tables (``queries()``).

Each query reads whole given tables (parquet under ``sf_dir``) and maps them
onto the utility-grid domain once, in the ``*_feed`` functions below:

* smart-meter readings  <- ``events``   (meter = user, region = event type, kWh = value)
* substation telemetry  <- ``lineitem`` (transformer = supplier, oil delta = 2 x quantity, ...)
* billing CDC changes   <- ``lineitem`` (key = order + line number, op from return flag)
* billing transactions  <- ``orders``   (status F/O/P = PAID/PENDING/DISPUTED)
* customer / transformer dimensions <- ``customer`` / ``supplier``
* renewable production  <- ``events``   (evolved columns only from 2024-01-16 on)

Timestamps are returned as local (NTZ) timestamps, the type the source tables use.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltaic.functions.columns import (backfill_columns, rounded, to_ntz, ts_from_filename,
                                       with_event_time, with_hour_bucket, first_existing, resolve_column)
from voltaic.functions.columns import canonicalize
from voltaic.functions.scoring import band_anomaly, billing_mismatch, cdc_op_name, is_overheating, with_risk_score
from voltaic.operators import marts, merge, quality
from voltaic.operators.anomaly import region_thresholds, score_meter_anomaly
from voltaic.operators.dedup import cdc_latest, dedup_latest, split_key_validity
from voltaic import schemas as K
from voltaic.sources.ingest import add_ingestion_cols, parse_envelope, source_file_name

CDC_KEY = ["l_orderkey", "l_linenumber"]
CDC_SPLIT_DATE = "1997-01-01"
CDC_VERSION_DATES = ("1996-06-01", "1998-01-01")
CDC_DELIVERIES = 4
CDC_FILE_BYTES = 32 * 1024 ** 2
SCD_EFFECTIVE = "2025-06-01"
NEW_KEY_OFFSET = 1_000_000_000
EVOLVED_FROM = "2024-01-16"
STREAM_DELAY = "10 minutes"
FRAUD_BELOW = 25000.0
FRAUD_SCALE = 1000.0    # brings order totals into the range of the fraud band of base amounts


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


# ---------------------------------------------------------------------------
# Domain feeds derived from the given tables
# ---------------------------------------------------------------------------
def meter_feed(spark, sf) -> DataFrame:
    """Smart-meter readings (silver shape, before dedup/scoring) from ``events``."""
    ev = parse_envelope(_t(spark, sf, "events"), "k INT", "props",
                        keep=["event_id", "ts", "user_id", "event_type", "value"])
    k = F.col("k").cast("double")
    return ev.select(
        "event_id", F.col("user_id").alias("meter_id"), F.col("user_id").alias("customer_id"),
        F.col("ts").alias("event_ts"), F.to_date("ts").alias("event_date"),
        F.col("value").alias("kwh_consumed"),
        (F.lit(140.0) + F.lit(2.0) * k).alias("voltage_v"),
        (k / 4).alias("current_a"),
        (F.lit(0.75) + k / 400).alias("power_factor"),
        F.col("event_type").alias("region"),
        F.concat(F.col("event_type"), F.lit("-"), F.when(F.col("k") < 50, "A").otherwise("B")).alias("state"))


def latest_meters(spark, sf) -> DataFrame:
    return dedup_latest(meter_feed(spark, sf), ["event_id"], [F.col("event_ts").desc()], total_order=False)


def scored_meters(spark, sf) -> DataFrame:
    return score_meter_anomaly(latest_meters(spark, sf))


# Feeds with faults, dealt over the whole table by a fixed rule, so that every quality rule has something to find.
def faulty_meters(spark, sf) -> DataFrame:
    """Meter readings, deduplicated, with missing ids, negative energy, broken times and repeated deliveries."""
    m, fault = meter_feed(spark, sf), F.col("event_id") % 40
    broken = m.withColumns({
        "meter_id": F.when(fault == 5, F.lit(None)).otherwise(F.col("meter_id")),
        "kwh_consumed": F.when(fault == 7, -F.col("kwh_consumed")).otherwise(F.col("kwh_consumed")),
        "event_ts": F.when(fault == 9, F.lit(None)).otherwise(F.col("event_ts")),
        "event_id": F.when(fault == 3, F.lit(None)).otherwise(F.col("event_id"))})
    again = m.filter(fault == 11).withColumn("event_ts", F.expr("event_ts - interval 1 hour"))
    valid, held = split_key_validity(broken.unionByName(again), ["event_id"])
    return dedup_latest(valid, ["event_id"], [F.col("event_ts").desc()], total_order=False).unionByName(held)


def faulty_telemetry(spark, sf) -> DataFrame:
    """Telemetry, deduplicated and risk-scored, with missing ids and broken times."""
    t, fault = telemetry_feed(spark, sf), F.col("substation_id") % 50
    t = t.withColumns({"telemetry_id": F.when(fault == 1, F.lit(None)).otherwise(F.col("telemetry_id")),
                       "transformer_id": F.when(fault == 2, F.lit(None)).otherwise(F.col("transformer_id")),
                       "telemetry_ts": F.when(fault == 3, F.lit(None)).otherwise(F.col("telemetry_ts"))})
    valid, held = split_key_validity(t, ["telemetry_id"])
    return with_risk_score(_latest_telemetry(valid).unionByName(held))


def faulty_bills(spark, sf) -> DataFrame:
    """Bills with missing ids and negative amounts."""
    b, fault = bills_feed(spark, sf), F.col("transaction_id") % 60
    return b.withColumns({"total_amount": F.when(fault == 2, -F.col("total_amount")).otherwise(F.col("total_amount")),
                          "transaction_id": F.when(fault == 1, F.lit(None)).otherwise(F.col("transaction_id"))})


def early_ending_dim(spark, sf) -> DataFrame:
    """A customer dimension whose current rows of one nation end too early."""
    end = F.when(F.col("c_nationkey") == 3, F.lit("2025-12-31").cast("date")).otherwise(F.col("record_end_date"))
    return customer_dim(spark, sf).withColumn("record_end_date", end)


def telemetry_feed(spark, sf) -> DataFrame:
    """Substation telemetry from ``lineitem`` (telemetry id repeats: a real dedup workload)."""
    li = _t(spark, sf, "lineitem")
    return li.select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("telemetry_id"),
        F.col("l_partkey").alias("substation_id"), F.col("l_suppkey").alias("transformer_id"),
        F.col("l_shipdate").alias("telemetry_ts"), F.to_date("l_shipdate").alias("event_date"),
        (F.lit(40.0) + F.lit(2.0) * F.col("l_quantity")).alias("oil_temperature_c"),
        F.lit(40.0).alias("ambient_temperature_c"),
        (F.col("l_extendedprice") / 100).alias("dissolved_gas_ppm"),
        (F.col("l_tax") * 100).alias("vibration_mm_s"),
        (F.col("l_discount") * 1000).alias("load_pct"),
        F.when(F.col("l_returnflag") == "R", "OVERLOAD").when(F.col("l_returnflag") == "A", "")
         .alias("alarm_code"),
        F.col("l_returnflag").alias("region"), F.col("l_linestatus").alias("state"))


def telemetry_latest(spark, sf) -> DataFrame:
    t = telemetry_feed(spark, sf)
    return _latest_telemetry(t)


def _latest_telemetry(t: DataFrame) -> DataFrame:
    # the order is total: no two rows of an id share all three, so no row hash is needed and columns can be pruned
    return dedup_latest(t, ["telemetry_id"], [F.col("telemetry_ts").desc(), F.col("substation_id").desc(),
                                              F.col("transformer_id").desc()], total_order=False)


def scored_telemetry(spark, sf) -> DataFrame:
    return with_risk_score(telemetry_latest(spark, sf))


def cdc_feed(spark, sf) -> DataFrame:
    """Billing-style change rows from ``lineitem``: N = insert, A = after-image, R = delete."""
    return _changes(_t(spark, sf, "lineitem"))


def _changes(li: DataFrame) -> DataFrame:
    hex12 = lambda c: F.lpad(F.hex(F.col(c)), 12, "0")
    return li.select(
        *CDC_KEY,
        F.when(F.col("l_returnflag") == "N", 2).when(F.col("l_returnflag") == "A", 4)
         .when(F.col("l_returnflag") == "R", 1).alias("__$operation"),
        hex12("l_partkey").alias("__$seqval"), hex12("l_suppkey").alias("__$start_lsn"),
        F.col("l_shipdate").alias("cdc_ts"),
        "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linestatus")


def cdc_target_and_changes(spark, sf) -> tuple[DataFrame, DataFrame]:
    """(current-state target built from changes before the split date, latest later change per key)."""
    ch = cdc_feed(spark, sf)
    early = cdc_latest(ch.filter(F.col("cdc_ts") < F.lit(CDC_SPLIT_DATE).cast("timestamp_ntz")), CDC_KEY)
    target = merge.cdc_upserts(early)          # the early changes applied to an empty table
    later = cdc_latest(ch.filter(F.col("cdc_ts") >= F.lit(CDC_SPLIT_DATE).cast("timestamp_ntz")), CDC_KEY)
    return target, later


def bills_feed(spark, sf) -> DataFrame:
    """Current billing transactions from ``orders``."""
    o = _t(spark, sf, "orders")
    return o.select(
        F.col("o_orderkey").alias("transaction_id"), F.col("o_custkey").alias("customer_id"),
        F.to_date("o_orderdate").alias("due_date"), F.col("o_orderdate").alias("cdc_ts"),
        F.col("o_totalprice").alias("total_amount"),
        F.when(F.col("o_orderstatus") == "F", "PAID").when(F.col("o_orderstatus") == "O", "PENDING")
         .when(F.col("o_orderstatus") == "P", "DISPUTED").alias("payment_status"),
        (F.col("o_totalprice") < FRAUD_BELOW).alias("fraud_flag"))


def customer_dim(spark, sf) -> DataFrame:
    """Customer dimension (SCD2 baseline); a meter serves up to ten customers."""
    c = _t(spark, sf, "customer").select(
        F.col("c_custkey").alias("customer_id"), F.expr("c_custkey div 10").alias("meter_id"),
        "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    return merge.scd2_baseline(c)


def customer_delta(spark, sf) -> DataFrame:
    """Incoming customer versions: BUILDING balances +100, FURNITURE balances unknown (NULL),
    other segments unchanged, AUTOMOBILE customers re-keyed as brand-new customers."""
    c = _t(spark, sf, "customer")
    seg = F.col("c_mktsegment")
    base = c.select(
        F.col("c_custkey").alias("customer_id"), F.expr("c_custkey div 10").alias("meter_id"), "c_name",
        "c_nationkey",
        F.when(seg == "BUILDING", F.col("c_acctbal") + 100).when(seg == "FURNITURE", F.lit(None))
         .otherwise(F.col("c_acctbal")).alias("c_acctbal"), "c_mktsegment")
    new = c.filter(seg == "AUTOMOBILE").select(
        (F.col("c_custkey") + NEW_KEY_OFFSET).alias("customer_id"), F.expr("c_custkey div 10").alias("meter_id"),
        "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    return base.unionByName(new).withColumns({
        "record_effective_date": F.lit(SCD_EFFECTIVE), "record_end_date": F.lit(K.SCD_OPEN_END_DATE),
        "is_current": F.lit(True)})


def transformer_dim(spark, sf) -> DataFrame:
    s = _t(spark, sf, "supplier").select(F.col("s_suppkey").alias("transformer_id"), "s_name",
                                         F.col("s_nationkey").alias("region"), "s_acctbal")
    return merge.scd2_baseline(s)


def renewable_feed(spark, sf) -> DataFrame:
    """Renewable readings; the two evolved columns exist only in the later files."""
    ev = parse_envelope(_t(spark, sf, "events"), "k INT", "props", keep=["event_id", "ts", "user_id", "value"])
    cut = F.lit(EVOLVED_FROM).cast("timestamp_ntz")
    base = [F.col("event_id").alias("reading_id"), F.col("user_id").alias("plant_id"), F.col("ts").alias("event_ts"),
            F.col("value").alias("production_mw"), (F.col("value") * 0.9).alias("grid_injection_mw")]
    early = ev.filter(F.col("ts") < cut).select(*base)
    late = ev.filter(F.col("ts") >= cut).select(*base, (F.col("value") * 0.1).alias("curtailment_mw"),
                                                F.col("k").cast("double").alias("battery_storage_mwh"))
    return early.unionByName(late, allowMissingColumns=True)


def dashboard_meters(spark, sf) -> DataFrame:
    """Meter readings for the dashboard from ``lineitem`` (same dates/regions as telemetry and bills)."""
    li = _t(spark, sf, "lineitem")
    r = li.select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"),
                    F.col("l_partkey").cast("string")).alias("event_id"),
        F.col("l_partkey").alias("meter_id"), F.col("l_shipdate").alias("event_ts"),
        F.to_date("l_shipdate").alias("event_date"), F.col("l_quantity").alias("kwh_consumed"),
        (F.lit(200.0) + F.col("l_tax") * 1000).alias("voltage_v"), (F.col("l_discount") * 100).alias("current_a"),
        (F.lit(1.0) - F.col("l_discount")).alias("power_factor"),
        F.col("l_returnflag").alias("region"), F.col("l_linestatus").alias("state"))
    return score_meter_anomaly(r)


def _ops(spark, sf) -> DataFrame:
    energy = marts.energy_daily(marts.usage_hourly(dashboard_meters(spark, sf)))
    risk = marts.risk_daily(marts.health_hourly(scored_telemetry(spark, sf)))
    bills = marts.billing_daily(bills_feed(spark, sf))
    ren = marts.renewable_daily(marts.renewable_hourly(renewable_feed(spark, sf)))
    return marts.ops_daily(energy, risk, bills, ren)


def _scd_applied(spark, sf) -> DataFrame:
    return merge.scd2_apply(customer_dim(spark, sf), customer_delta(spark, sf), ["customer_id"])


# ---------------------------------------------------------------------------
# Queries
# ---------------------------------------------------------------------------
def q_parse_event_time(spark, sf):
    ev = _t(spark, sf, "events").select("event_id", F.col("ts").cast("string").alias("timestamp"))
    return to_ntz(with_event_time(ev, "timestamp"))


def q_hour_bucket(spark, sf):
    return with_hour_bucket(_t(spark, sf, "events").select("event_id", "ts"), "ts").drop("ts")


def q_lineage(spark, sf):
    ev = add_ingestion_cols(_t(spark, sf, "events").select("event_id"), "smart_meter", "bench-batch")
    return ev.select("event_id", "_source_system", "_batch_id", source_file_name("_source_file").alias("source_file"),
                     F.col("_ingestion_ts").isNotNull().alias("has_ingestion_ts"))


def q_resolve_column(spark, sf):
    b = bills_feed(spark, sf)
    return b.select("transaction_id", first_existing(b, K.AMOUNT_CANDIDATES).alias("amount"),
                    F.lit(resolve_column(b, K.AMOUNT_CANDIDATES)).alias("amount_source"))


def q_schema_evolve(spark, sf):
    """Readings landed as JSON in two layouts (S6, T8, P8): the schema is inferred from the first files and saved, evolved
    by the new files alone, and columns that a layout lacks come back as typed NULLs."""
    from voltaic.session import shared_dir
    from voltaic.sources.ingest import evolve_feed
    root = shared_dir(spark, "voltaic", "schema_evolve")
    columns = ["reading_id", "production_mw", *K.RENEWABLE_EVOLVED_COLUMNS]
    feed = renewable_feed(spark, sf).select("event_ts", *columns)
    cut, hints = F.lit(EVOLVED_FROM).cast("timestamp_ntz"), "reading_id bigint"
    feed.filter(F.col("event_ts") < cut).select(columns[:2]).write.json(f"{root}/landing")
    evolve_feed(spark, f"{root}/landing", f"{root}/schema", hints)
    feed.filter(F.col("event_ts") >= cut).select(columns).write.mode("append").json(f"{root}/landing")
    schema = evolve_feed(spark, f"{root}/landing", f"{root}/schema", hints)
    return backfill_columns(spark.read.schema(schema).json(f"{root}/landing"), K.RENEWABLE_EVOLVED_COLUMNS).select(columns)


def q_ts_from_filename(spark, sf):
    ev = _t(spark, sf, "events").select(
        F.col("event_id").alias("reading_id"),
        F.concat(F.lit("landing/renewable_production_"), F.date_format("ts", "yyyyMMdd"), F.lit("_"),
                 F.date_format("ts", "HH"), F.lit("00.json")).alias("source_file"))
    return to_ntz(ev.withColumn("event_ts", ts_from_filename("source_file", K.RENEWABLE_FILE_PATTERN)))


def q_scd2_baseline(spark, sf):
    return customer_dim(spark, sf)


def q_parse_envelope(spark, sf):
    return parse_envelope(_t(spark, sf, "events"), "k INT", "props", keep=["event_id", "ts"])


def q_dedup_latest(spark, sf):
    return telemetry_latest(spark, sf)


def q_cdc_latest(spark, sf):
    return cdc_latest(cdc_feed(spark, sf), CDC_KEY)


def q_cdc_delete(spark, sf):
    target, later = cdc_target_and_changes(spark, sf)
    return merge.cdc_apply(target, later, CDC_KEY, upserts=False)


def q_cdc_upsert(spark, sf):
    target, later = cdc_target_and_changes(spark, sf)
    return merge.cdc_apply(target, later, CDC_KEY, deletes=False)


def q_cdc_apply(spark, sf):
    target, later = cdc_target_and_changes(spark, sf)
    return merge.cdc_apply(target, later, CDC_KEY)


def q_cdc_op_name(spark, sf):
    ch = cdc_feed(spark, sf)
    return ch.select(*CDC_KEY, "l_partkey", "l_suppkey", "cdc_ts", "__$operation",
                     cdc_op_name("__$operation").alias("cdc_operation"))


def q_scd2_next_version(spark, sf):
    return merge.scd2_next_version(customer_delta(spark, sf), customer_dim(spark, sf), ["customer_id"])


def q_scd2_apply(spark, sf):
    return _scd_applied(spark, sf)


def q_scd2_expired(spark, sf):
    ch = merge.scd2_changes(customer_dim(spark, sf), customer_delta(spark, sf), ["customer_id"])
    return ch.filter(F.col("_scd_action") == "expire").drop("_scd_action")


def q_scd2_inserted(spark, sf):
    ch = merge.scd2_changes(customer_dim(spark, sf), customer_delta(spark, sf), ["customer_id"])
    return ch.filter(F.col("_scd_action").isin("new_version", "new_key"))


def q_dim_current(spark, sf):
    return merge.dim_current(_scd_applied(spark, sf))


def q_snapshot_diff(spark, sf):
    c = _t(spark, sf, "customer")
    seg = F.col("c_mktsegment")
    new = (c.filter(seg != "HOUSEHOLD")
            .withColumn("c_acctbal", F.when(seg == "BUILDING", F.col("c_acctbal") + 100).otherwise(F.col("c_acctbal")))
            .unionByName(c.filter(seg == "MACHINERY").withColumn("c_custkey", F.col("c_custkey") + NEW_KEY_OFFSET)))
    return merge.snapshot_diff(c, new, ["c_custkey"])


def q_region_thresholds(spark, sf):
    return region_thresholds(latest_meters(spark, sf))


def q_region_thresholds_stored(spark, sf):
    """Regional percentiles from stored slice counts, added up over three deliveries (A1): only the slices that
    hold a rank are looked into."""
    from voltaic.operators.anomaly import add_counts, slice_counts
    from voltaic.plans.tables import merge_buckets, read_current
    from voltaic.session import shared_dir
    root, meters = shared_dir(spark, "voltaic", "slice_counts"), latest_meters(spark, sf)
    for i in range(3):
        more = slice_counts(meters.filter(F.pmod(F.hash("meter_id"), F.lit(3)) == i), "region", "kwh_consumed")
        merge_buckets(spark, root, more, ["g", "slice"], add_counts, f"delivery{i}", buckets=4)
    return region_thresholds(meters, counts=read_current(spark, root))


def q_meter_anomaly(spark, sf):
    return scored_meters(spark, sf).select("event_id", "meter_id", "region", "kwh_consumed",
                                           "is_kwh_anomaly", "anomaly_type")


def q_risk_flags(spark, sf):
    return scored_telemetry(spark, sf).select("telemetry_id", "oil_temp_delta_c", "risk_alarm", "risk_oil_temp",
                                              "risk_gas", "risk_vibration", "risk_overload")


def q_risk_score(spark, sf):
    return scored_telemetry(spark, sf).select("telemetry_id", "risk_score")


def q_risk_level(spark, sf):
    return scored_telemetry(spark, sf).select("telemetry_id", "risk_score", "risk_level")


def q_band_anomaly(spark, sf):
    m = meter_feed(spark, sf)
    return m.select("event_id", "kwh_consumed", band_anomaly(F.col("kwh_consumed")).alias("band_anomaly"))


def q_meter_signals(spark, sf):
    """The documented meter signals with the meter's status (C8): bands first, then a suspicious status."""
    k = F.col("voltage_v")
    status = F.when(k < 160, "TAMPERED").when(k < 180, "DISCONNECTED").when(k < 330, "ACTIVE")
    m = meter_feed(spark, sf).withColumn("meter_status", status)
    return m.select("event_id", "kwh_consumed", "meter_status", band_anomaly(F.col("kwh_consumed"), F.col("meter_status")).alias("signal"))


def q_overheat_signal(spark, sf):
    t = scored_telemetry(spark, sf)
    return t.filter(is_overheating(F.col("oil_temp_delta_c"))).select("telemetry_id", "transformer_id",
                                                                       "oil_temp_delta_c")


def q_canonicalize(spark, sf):
    """Feed names (``reading_kwh``, ``load_percentage``) mapped to the curated names."""
    ev = _t(spark, sf, "events").select("event_id", F.col("value").alias("reading_kwh"),
                                        (F.col("value") / 5).alias("load_percentage"))
    return canonicalize(ev)


def q_key_validity(spark, sf):
    """Rows kept for dedup vs quarantined for a NULL/blank key, per feed."""
    parts = []
    for name, df, key in [("smart_meter", meter_feed(spark, sf), "event_id"),
                          ("telemetry", telemetry_feed(spark, sf), "telemetry_id"),
                          ("telemetry_alarm", telemetry_feed(spark, sf), "alarm_code")]:
        ok, bad = split_key_validity(df, [key])
        parts.append(ok.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("feed"), F.lit("valid").alias("route"), "n"))
        parts.append(bad.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("feed"), F.lit("quarantine").alias("route"), "n"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _bronze_like(df, system: str) -> DataFrame:
    """Lineage columns as a bronze table carries them (fixed ingestion time, file = table file)."""
    return df.withColumns({"_ingestion_ts": F.lit("2025-06-15 00:00:00").cast("timestamp"),
                           "_source_system": F.lit(system), "_batch_id": F.lit("bench-batch"),
                           "_source_file": F.lit(f"landing/{system}.json")})


def q_meter_silver(spark, sf):
    """Silver smart-meter table (G1) from a bronze-shaped feed: feed names, string time, lineage."""
    from voltaic.plans.pipeline import silver_meters
    ev = parse_envelope(_t(spark, sf, "events"), "k INT", "props",
                        keep=["event_id", "ts", "user_id", "event_type", "value"])
    bronze = _bronze_like(ev.select(
        F.col("event_id").cast("string").alias("event_id"), F.col("user_id").cast("string").alias("meter_id"),
        F.col("ts").cast("string").alias("timestamp"), F.col("value").alias("reading_kwh"),
        (F.lit(140.0) + F.lit(2.0) * F.col("k").cast("double")).alias("voltage_v"),
        F.col("event_type").alias("region")), "smart_meter")
    readings, _ = silver_meters(bronze)
    return to_ntz(readings.select("event_id", "meter_id", "region", "event_ts", "event_date", "kwh_consumed",
                                  "is_kwh_anomaly", "anomaly_type"))


def q_maintenance_silver(spark, sf):
    """Maintenance logs (G3): maintenance time resolved from the first present date column."""
    from voltaic.plans.pipeline import silver_maintenance
    o = _t(spark, sf, "orders").select(F.col("o_orderkey").alias("log_id"), F.col("o_custkey").alias("transformer_id"),
                                       F.to_date("o_orderdate").alias("reported_date"))
    return to_ntz(silver_maintenance(o))


def q_renewable_silver(spark, sf):
    """Renewable silver table (G6) from files without a time column: time from the file name,
    evolved columns backfilled, readings deduplicated."""
    from voltaic.plans.pipeline import silver_renewable
    ev = _t(spark, sf, "events")
    bronze = ev.select(
        F.col("event_id").alias("reading_id"), F.col("user_id").alias("plant_id"), F.col("value").alias("production_mw"),
        F.concat(F.lit("landing/renewable_production_"), F.date_format("ts", "yyyyMMdd"), F.lit("_"),
                 F.date_format("ts", "HH"), F.lit("00.json")).alias("_source_file"),
        F.lit("2025-06-15 00:00:00").cast("timestamp").alias("_ingestion_ts"))
    return to_ntz(silver_renewable(bronze)[0].select("reading_id", "plant_id", "production_mw", "event_ts", "event_date",
                                                  "curtailment_mw", "battery_storage_mwh"))


def q_billing_silver(spark, sf):
    """Billing change rows typed (P3): CDC time and the three dates parsed from strings."""
    from voltaic.plans.pipeline import silver_billing
    o = _t(spark, sf, "orders").select(
        F.col("o_orderkey").alias("transaction_id"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss.SSS").alias("cdc_timestamp"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("billing_period_start"),
        F.date_format(F.date_add(F.to_date("o_orderdate"), 29), "yyyy-MM-dd").alias("billing_period_end"),
        F.date_format(F.date_add(F.to_date("o_orderdate"), 30), "yyyy-MM-dd").alias("due_date"))
    return to_ntz(silver_billing(o))


def q_billing_mismatch(spark, sf):
    li = _t(spark, sf, "lineitem")
    charge = (li.groupBy(F.col("l_orderkey").alias("transaction_id"))
                .agg(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax")))
                     .alias("metered_charge")))
    b = bills_feed(spark, sf).join(charge, "transaction_id", "left")
    lo, hi = K.FRAUD_BASE_AMOUNT_BAND
    return rounded(b.select("transaction_id", "total_amount", "metered_charge",
                    billing_mismatch(F.col("metered_charge"), F.lit(1.0), F.col("total_amount")).alias("mismatch_ratio"),
                    (F.col("total_amount") / FRAUD_SCALE).between(lo, hi).alias("base_amount_in_fraud_band")))


def q_usage_hourly(spark, sf):
    return rounded(marts.usage_hourly(scored_meters(spark, sf)))


def q_meter_customers(spark, sf):
    """The (meter, customer) bridge."""
    return marts.meter_customers(merge.dim_current(customer_dim(spark, sf)))


def q_usage_customer(spark, sf):
    hourly = marts.usage_hourly(scored_meters(spark, sf))
    return rounded(marts.usage_with_customer(hourly, merge.dim_current(customer_dim(spark, sf))))


def q_health_hourly(spark, sf):
    return marts.health_hourly(scored_telemetry(spark, sf))


def q_health_enriched(spark, sf):
    return marts.health_enriched(marts.health_hourly(scored_telemetry(spark, sf)),
                                 merge.dim_current(transformer_dim(spark, sf)))


def q_billing_daily(spark, sf):
    return rounded(marts.billing_daily(bills_feed(spark, sf)))


def q_renewable_hourly(spark, sf):
    return rounded(marts.renewable_hourly(renewable_feed(spark, sf)))


def q_renewable_daily(spark, sf):
    return rounded(marts.renewable_daily(marts.renewable_hourly(renewable_feed(spark, sf))))


def q_energy_daily(spark, sf):
    return rounded(marts.energy_daily(marts.usage_hourly(scored_meters(spark, sf))))


def q_risk_daily(spark, sf):
    return marts.risk_daily(marts.health_hourly(scored_telemetry(spark, sf)))


def q_ops_daily(spark, sf):
    return rounded(_ops(spark, sf))


def q_ops_snapshot(spark, sf):
    return rounded(marts.ops_snapshot(_ops(spark, sf)))


def q_dq_null_keys(spark, sf):
    meters, tel, bills = faulty_meters(spark, sf), faulty_telemetry(spark, sf), faulty_bills(spark, sf)
    parts = [quality.rule_counts(meters, [r for r in quality.meter_rules() if r.rule_name.startswith("PK_")],
                                 "smart_meter_readings", include_zero=True),
             quality.rule_counts(tel, [r for r in quality.telemetry_rules() if r.rule_name.startswith("PK_")],
                                 "substation_telemetry", include_zero=True),
             quality.rule_counts(bills, quality.billing_rules(bills)[:1], "billing_transactions_current",
                                 include_zero=True)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _range_violations(spark, sf) -> DataFrame:
    meters, tel, bills = faulty_meters(spark, sf), faulty_telemetry(spark, sf), faulty_bills(spark, sf)
    m_rules = [r for r in quality.meter_rules() if r.rule_name in ("NEGATIVE_KWH", "VOLTAGE_OUT_OF_RANGE")]
    t_rules = [r for r in quality.telemetry_rules() if r.rule_name == "OIL_TEMP_DELTA_IMPLAUSIBLE"]
    b_rules = quality.billing_rules(bills)[1:]
    return (quality.evaluate_rules(meters, m_rules, "smart_meter_readings")
            .unionByName(quality.evaluate_rules(tel, t_rules, "substation_telemetry"))
            .unionByName(quality.evaluate_rules(bills, b_rules, "billing_transactions_current")))


def q_dq_ranges(spark, sf):
    return _range_violations(spark, sf).select("dataset", "rule_name", "severity", "violation_count")


def q_dq_samples(spark, sf):
    return _range_violations(spark, sf).select("dataset", "rule_name", "sample_keys")


def q_dq_bad_ts(spark, sf):
    meters, tel = faulty_meters(spark, sf), faulty_telemetry(spark, sf)
    m = [r for r in quality.meter_rules() if r.rule_name == "INVALID_TIMESTAMP"]
    t = [r for r in quality.telemetry_rules() if r.rule_name == "INVALID_TIMESTAMP"]
    return (quality.rule_counts(meters, m, "smart_meter_readings", include_zero=True)
            .unionByName(quality.rule_counts(tel, t, "substation_telemetry", include_zero=True)))


def _append_only_load(spark, sf) -> DataFrame:
    """A dimension loaded append-only (new versions appended, nothing expired)."""
    dim = customer_dim(spark, sf)
    nxt = merge.scd2_next_version(customer_delta(spark, sf), dim, ["customer_id"])
    nxt = nxt.withColumns({"record_effective_date": F.to_date("record_effective_date"),
                           "record_end_date": F.to_date("record_end_date")})
    return dim.unionByName(nxt)


def q_dq_multi_current(spark, sf):
    return quality.dimension_multi_current(_append_only_load(spark, sf), "customer_id", "dim_customer")


def q_dq_scd2_end(spark, sf):
    rule = [quality.dimension_end_date_rule("customer_id")]
    return (quality.rule_counts(_scd_applied(spark, sf), rule, "dim_customer", include_zero=True)
            .unionByName(quality.rule_counts(_append_only_load(spark, sf), rule, "dim_customer_append_only",
                                             include_zero=True))
            .unionByName(quality.rule_counts(early_ending_dim(spark, sf), rule, "dim_customer_early_end",
                                             include_zero=True)))


def q_dq_empty(spark, sf):
    ops = _ops(spark, sf)
    return (quality.empty_table_violation(ops, "ops_daily_dashboard")
            .unionByName(quality.empty_table_violation(ops.filter(F.col("kwh_total") < 0), "ops_daily_negative_energy")))


def q_dq_report(spark, sf):
    meters, tel, bills = faulty_meters(spark, sf), faulty_telemetry(spark, sf), faulty_bills(spark, sf)
    parts = [quality.evaluate_rules(meters, quality.meter_rules(), "smart_meter_readings"),
             quality.evaluate_rules(tel, quality.telemetry_rules(), "substation_telemetry"),
             quality.evaluate_rules(bills, quality.billing_rules(bills), "billing_transactions_current"),
             quality.dimension_multi_current(_append_only_load(spark, sf), "customer_id", "dim_customer"),
             quality.evaluate_rules(early_ending_dim(spark, sf), [quality.dimension_end_date_rule("customer_id")],
                                    "dim_customer")]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return quality.dq_report(out)


def q_join_coverage(spark, sf):
    """Coverage of the whole dimensions, and of telemetry whose transformer ids were garbled on the way (every 50th
    substation's), so that a rate below one is seen."""
    meters, tel = latest_meters(spark, sf), telemetry_latest(spark, sf)
    garbled = tel.withColumn("transformer_id", F.when(F.col("substation_id") % 50 == 2, F.col("transformer_id") + NEW_KEY_OFFSET)
                             .otherwise(F.col("transformer_id")))
    customers, transformers = merge.dim_current(customer_dim(spark, sf)), merge.dim_current(transformer_dim(spark, sf))
    names = ("keys_in_facts", "keys_found_in_dim")
    out = None
    for metric, facts, dim, key in (("meter_to_customer_join_coverage", meters, customers, "meter_id"),
                                    ("telemetry_to_transformer_join_coverage", tel, transformers, "transformer_id"),
                                    ("faulty telemetry_to_transformer_join_coverage", garbled, transformers, "transformer_id")):
        found = quality.join_coverage(facts, dim, key, *names)
        row = found.select(F.lit(metric).alias("metric_name"), *names, quality.coverage_metric(found, *names).alias("metric_value"))
        out = row if out is None else out.unionByName(row)
    return out


def q_referential_integrity(spark, sf):
    t = lambda n: _t(spark, sf, n)
    fault = F.col("o_orderkey") % 50
    broken = t("orders").select(F.when(fault == 1, F.lit(None)).when(fault == 2, F.col("o_custkey") + NEW_KEY_OFFSET)
                                .otherwise(F.col("o_custkey")).alias("o_custkey"))
    rels = [
        ("faulty orders.o_custkey->customer", broken, ["o_custkey"], t("customer"), ["c_custkey"]),
        ("orders.o_custkey->customer", t("orders"), ["o_custkey"], t("customer"), ["c_custkey"]),
        ("lineitem.l_orderkey->orders", t("lineitem"), ["l_orderkey"], t("orders"), ["o_orderkey"]),
        ("lineitem.l_suppkey->supplier", t("lineitem"), ["l_suppkey"], t("supplier"), ["s_suppkey"]),
        ("lineitem.l_partkey->part", t("lineitem"), ["l_partkey"], t("part"), ["p_partkey"]),
        ("events.user_id->customer", t("events"), ["user_id"], t("customer"), ["c_custkey"]),
        ("customer.c_nationkey->nation", t("customer"), ["c_nationkey"], t("nation"), ["n_nationkey"]),
        ("supplier.s_nationkey->nation", t("supplier"), ["s_nationkey"], t("nation"), ["n_nationkey"]),
        ("nation.n_regionkey->region", t("nation"), ["n_regionkey"], t("region"), ["r_regionkey"]),
    ]
    return quality.referential_integrity(rels)


def q_time_bounds(spark, sf):
    return to_ntz(quality.time_bounds([
        ("smart_meter_readings", latest_meters(spark, sf), "event_ts"),
        ("substation_telemetry", telemetry_latest(spark, sf), "telemetry_ts"),
        ("billing_transactions_current", bills_feed(spark, sf), "cdc_ts")]))


def q_rowcounts(spark, sf):
    names = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]
    tables = [("BRONZE", n, _t(spark, sf, n)) for n in names]
    tables += [("SILVER", "smart_meter_readings", latest_meters(spark, sf)),
               ("SILVER", "substation_telemetry", telemetry_latest(spark, sf)),
               ("GOLD", "customer_hourly_usage", marts.usage_hourly(latest_meters(spark, sf))),
               ("GOLD", "billing_kpis_daily", marts.billing_daily(bills_feed(spark, sf)))]
    return quality.row_counts(tables)


def _slices(rows: DataFrame, ts: str) -> list[DataFrame]:
    """A feed in three parts, by time: each is landed, and taken by a stream, before the next."""
    cut = rows.agg(F.expr(f"timestampadd(second, cast(timestampdiff(second, min({ts}), max({ts})) div 3 as int), min({ts}))").alias("a"),
                   F.expr(f"timestampadd(second, cast(timestampdiff(second, min({ts}), max({ts})) div 3 * 2 as int), min({ts}))").alias("b")).first()
    at = F.col(ts)
    return [rows.filter(at < F.lit(cut["a"])), rows.filter((at >= F.lit(cut["a"])) & (at < F.lit(cut["b"]))), rows.filter(at >= F.lit(cut["b"]))]


def _stream_dedup(spark, sf, within_watermark: bool) -> DataFrame:
    """Events landed in three deliveries. Each repeats the one before it whole, and the last one also brings events
    of the first third that were held back: they are older than the watermark and must go."""
    from voltaic.session import shared_dir
    from voltaic.streaming.ingest import run_available_now, watermark_dedup
    root, events = shared_dir(spark, "voltaic", "stream_dedup"), _t(spark, sf, "events")
    one, two, three = _slices(events, "ts")
    held = F.col("event_id") % 50 == 7
    one, late = one.filter(~held), one.filter(held)
    for delivery in (one, one.unionByName(two), two.unionByName(three).unionByName(late)):
        delivery.write.mode("append").parquet(f"{root}/landing")
        stream = spark.readStream.schema(events.schema).parquet(f"{root}/landing")
        stream = stream.withColumn("__event_time", F.col("ts").cast(T.TimestampType()))
        deduped = watermark_dedup(stream, ["event_id"], "__event_time", STREAM_DELAY, within_watermark).select(*events.columns)
        run_available_now(deduped, f"{root}/data", f"{root}/_checkpoint")
    return spark.read.schema(events.schema).parquet(f"{root}/data")


def q_stream_dedup(spark, sf):
    """Repeated deliveries down to once under a watermark that evicts (T4): repeats are found in the state or are
    late, and events that come first after the watermark passed them are dropped."""
    return _stream_dedup(spark, sf, within_watermark=False)


def q_stream_dedup_id(spark, sf):
    """The same by event id alone within the watermark (T5)."""
    return _stream_dedup(spark, sf, within_watermark=True)


def _mart_stream(spark, rows: DataFrame, ts: str, hourly, keys: list[str], name: str) -> DataFrame:
    """A feed landed in three parts in the order of time, each drained into an hourly mart. The feed is stored
    once: its bounds and each of its parts would otherwise compute it whole again."""
    from voltaic.session import cut_lineage, shared_dir
    from voltaic.streaming.marts import read_mart, run_mart
    root, rows = shared_dir(spark, "voltaic", name), cut_lineage(rows)
    for part in _slices(rows, ts):
        part.write.mode("append").parquet(f"{root}/landing")
        stream = spark.readStream.schema(rows.schema).parquet(f"{root}/landing")
        run_mart(hourly(stream), f"{root}/mart", f"{root}/_checkpoint", keys, buckets=8)
    return read_mart(spark, f"{root}/mart")


def q_usage_hourly_stream(spark, sf):
    """Hourly usage from a stream of readings, scored by the regional bands (A2)."""
    from voltaic.streaming.marts import usage_hourly_stream
    readings = scored_meters(spark, sf)
    return rounded(_mart_stream(spark, readings, "event_ts", usage_hourly_stream, ["meter_id", "region", "state"], "usage_stream"))


def q_health_hourly_stream(spark, sf):
    """Hourly transformer health from a stream of telemetry (A3)."""
    from voltaic.streaming.marts import health_hourly_stream
    return _mart_stream(spark, scored_telemetry(spark, sf), "telemetry_ts", health_hourly_stream, ["transformer_id", "region", "state"], "health_stream")


def q_renewable_hourly_stream(spark, sf):
    """Hourly renewable production from a stream whose later files have more columns (A5)."""
    from voltaic.streaming.marts import renewable_hourly_stream
    return rounded(_mart_stream(spark, renewable_feed(spark, sf), "event_ts", renewable_hourly_stream, ["plant_id"], "renewable_stream"))


def q_cdc_stream(spark, sf):
    """Billing-style changes landed in four deliveries, merged by a stream one delivery at a time (T9): the
    deliveries are dealt by part key, so changes arrive out of order and late ones must have no effect. A delivery is one
    file, or as many as keep each to about ``CDC_FILE_BYTES`` of the table. Rows are dealt before they are made wider, and
    lie in the order of their part key, which takes less room."""
    from voltaic.plans.tables import STORED, size_of
    from voltaic.session import shared_dir, tidy_shuffles
    from voltaic.streaming.ingest import cdc_foreach_batch, read_cdc_state, stream_table
    root = shared_dir(spark, "voltaic", "cdc_stream")
    files = -(-size_of(spark, f"{sf}/lineitem.parquet") // (CDC_DELIVERIES * CDC_FILE_BYTES))
    dealt = _t(spark, sf, "lineitem").repartition(CDC_DELIVERIES * files, "l_partkey")
    with tidy_shuffles(spark):
        _changes(dealt).sortWithinPartitions("l_partkey").write.parquet(f"{root}/landing", compression=STORED)
    q = (stream_table(spark, f"{root}/landing", files_per_batch=files).writeStream
         .foreachBatch(cdc_foreach_batch(f"{root}/state", CDC_KEY, buckets=8)).option("checkpointLocation", f"{root}/_checkpoint")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return read_cdc_state(spark, f"{root}/state")


def _billing_versions(spark, sf, feed: bool) -> str:
    """Billing-style changes merged into a bucketed table in three dated versions; the table's path."""
    from voltaic.plans.tables import merge_buckets
    from voltaic.session import shared_dir
    from voltaic.streaming.ingest import latest_changes
    root, ch = shared_dir(spark, "voltaic", "billing_versions"), cdc_feed(spark, sf)
    day = [F.lit(d).cast("timestamp_ntz") for d in CDC_VERSION_DATES]
    for i, part in enumerate((F.col("cdc_ts") < day[0], (F.col("cdc_ts") >= day[0]) & (F.col("cdc_ts") < day[1]), F.col("cdc_ts") >= day[1])):
        merge_buckets(spark, root, ch.filter(part), CDC_KEY, latest_changes(CDC_KEY), f"run{i}", buckets=8,
                      feed_keys=CDC_KEY if feed else None, visible=merge.cdc_upserts)
    return root


def q_cdc_apply_buckets(spark, sf):
    """CDC merges that read and write the touched buckets of keys only (M1, M2): the live rows after three of them."""
    from voltaic.streaming.ingest import read_cdc_state
    return read_cdc_state(spark, _billing_versions(spark, sf, feed=False))


def q_change_feed(spark, sf):
    """What each of three merges inserted, updated and deleted, read from the first version on."""
    from voltaic.plans.tables import read_changes
    return read_changes(spark, _billing_versions(spark, sf, feed=True))


def q_scd2_buckets(spark, sf):
    """An SCD2 merge that reads and writes the touched buckets of keys only (M3): the dimension after a delta of
    changed, unchanged and new customers."""
    from voltaic.plans.tables import merge_buckets, read_current
    from voltaic.session import shared_dir
    root = shared_dir(spark, "voltaic", "scd2_buckets")
    merge_buckets(spark, root, customer_dim(spark, sf), ["customer_id"], lambda old, rows: rows, "base", buckets=8)
    merge_buckets(spark, root, customer_delta(spark, sf), ["customer_id"],
                  lambda old, delta: merge.scd2_apply(old, delta, ["customer_id"]) if old is not None else delta, "delta")
    return read_current(spark, root)


def q_latest_incremental(spark, sf):
    """The latest telemetry of each id from per-key state and new deliveries only (W1, W2): three deliveries, dealt by
    line status and return flag, each merged into the state of those before it."""
    from voltaic.plans.tables import merge_buckets, read_current
    from voltaic.session import shared_dir
    root, feed = shared_dir(spark, "voltaic", "latest_incremental"), telemetry_feed(spark, sf)
    for i, part in enumerate(("state = 'O'", "state <> 'O' and region = 'R'", "state <> 'O' and region <> 'R'")):
        merge_buckets(spark, root, feed.filter(part), ["telemetry_id"],
                      lambda old, new: _latest_telemetry(new if old is None else old.unionByName(new)), f"delivery{i}", buckets=8)
    return read_current(spark, root)


def q_write_metrics(spark, sf):
    """Row counts and time bounds as the writes themselves saw them (A12, Q16, Q17): nothing is read back."""
    from voltaic.plans.tables import observed_write
    from voltaic.session import shared_dir
    root, rows = shared_dir(spark, "voltaic", "write_metrics"), []
    for name, df, ts in (("smart_meter_readings", latest_meters(spark, sf), "event_ts"),
                         ("substation_telemetry", telemetry_latest(spark, sf), "telemetry_ts"),
                         ("billing_transactions_current", bills_feed(spark, sf), "cdc_ts")):
        seen = observed_write(df, lambda d, n=name: d.write.parquet(f"{root}/{n}"), ts)
        rows.append((name, seen["rows"], seen["min_ts"], seen["max_ts"]))
    return spark.createDataFrame(rows, "table_name string, row_count bigint, min_ts timestamp_ntz, max_ts timestamp_ntz")


def _land_feeds(spark, sf, root):
    """The given tables as landed feeds: JSON of three systems, CSV logs, parquet masters, JSON that evolves."""
    from voltaic.plans.pipeline import Sources
    iso = lambda c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    m = meter_feed(spark, sf)
    m.select(F.col("event_id").cast("string").alias("event_id"), F.col("meter_id").cast("string").alias("meter_id"), iso("event_ts").alias("timestamp"),
             F.col("kwh_consumed").alias("reading_kwh"), "voltage_v", "current_a", "power_factor", "region", "state").write.json(f"{root}/smart_meter")
    text = lambda c: F.col(c).cast("string")
    m.select(text("event_id").alias("telemetry_id"), text("customer_id").alias("substation_id"), text("meter_id").alias("transformer_id"),
             iso("event_ts").alias("timestamp"), F.col("voltage_v").alias("oil_temperature_c"), F.lit(40.0).alias("ambient_temperature_c"),
             F.col("kwh_consumed").alias("load_pct"), "region", "state").write.json(f"{root}/telemetry")
    op = F.element_at(F.array(F.lit(2), F.lit(4), F.lit(1)), (F.col("event_id") % 3 + 1).cast("int"))
    m.select(text("meter_id").alias("transaction_id"), op.alias("__$operation"), F.lpad(F.hex("event_id"), 12, "0").alias("__$seqval"),
             iso("event_ts").alias("cdc_timestamp"), iso("event_ts").alias("due_date"), F.col("kwh_consumed").alias("total_amount")).write.json(f"{root}/billing")
    s = _t(spark, sf, "supplier")
    s.select(F.concat(F.lit("L"), "s_suppkey").alias("log_id"), F.col("s_suppkey").alias("transformer_id"), F.lit("2025-06-01").alias("reported_date"),
             F.col("s_acctbal").alias("cost_inr")).write.option("header", True).csv(f"{root}/maintenance")
    trf = s.select(F.col("s_suppkey").cast("string").alias("transformer_id"), "s_name", "s_acctbal")
    trf.write.parquet(f"{root}/transformer")
    changed = trf.withColumns({"s_acctbal": F.col("s_acctbal") + 1, "record_effective_date": F.lit("2025-06-01")})
    for day in ("01", "02"):                       # two files that a glob finds; the second says the same
        changed.write.parquet(f"{root}/delta_{day}")
    _t(spark, sf, "customer").select(F.col("c_custkey").alias("customer_id"), F.col("c_custkey").cast("string").alias("meter_id"), "c_name").write.parquet(f"{root}/customer")
    r = renewable_feed(spark, sf).withColumns({"timestamp": iso("event_ts")}).drop("event_ts")
    r.filter("battery_storage_mwh is null").drop("battery_storage_mwh", "curtailment_mw").write.json(f"{root}/renewable")
    r.filter("battery_storage_mwh is not null").write.mode("append").json(f"{root}/renewable")
    return Sources(smart_meter=f"{root}/smart_meter", telemetry=f"{root}/telemetry", billing_cdc=f"{root}/billing", maintenance=f"{root}/maintenance",
                   transformer_snapshot=f"{root}/transformer", transformer_delta=f"{root}/delta_*", customer_snapshot=f"{root}/customer",
                   renewable=f"{root}/renewable")


def q_landed_feeds(spark, sf):
    """All feeds landed as files and run through the layers (S1-S3, S5, S9, S13-S15, K2-K7, K9, K10, Q18): streams and batch readers
    into bronze, merges into new tables, partitioned marts, audit appends, catalog tables. What the catalog's
    audit table says of each table: its row count, and "loaded" for bronze."""
    from voltaic.plans.pipeline import run_pipeline
    from voltaic.session import shared_dir
    root = shared_dir(spark, "voltaic", "landed_feeds")
    prefix = "q" + root.rsplit("/", 1)[1][:12]
    sources = _land_feeds(spark, sf, f"{root}/landing")
    run_pipeline(spark, sources, f"{root}/lake", "INCR", batch_id="b1", catalog_prefix=prefix, buckets=4)
    metrics = spark.table(f"{prefix}_audit.table_metrics").filter("batch_id = 'b1' and layer <> 'AUDIT' and metric_name in ('rowcount', 'status')")
    return metrics.select("layer", "table_fqn", "metric_name", "metric_value")


def q_csv_feed(spark, sf):
    """Orders landed as CSV in two column orders (S4), read back by each file's own header."""
    from voltaic.session import shared_dir
    from voltaic.sources.ingest import read_csv_feed
    root = shared_dir(spark, "voltaic", "csv_feed")
    o = _t(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    o.filter("o_orderstatus = 'F'").write.option("header", True).csv(f"{root}/f")
    o.filter("o_orderstatus <> 'F'").select("o_totalprice", "o_orderstatus", "o_orderkey").write.option("header", True).csv(f"{root}/rest")
    return read_csv_feed(spark, f"{root}/*", T.StructType.fromDDL("o_orderkey bigint, o_custkey bigint, o_totalprice double, o_orderstatus string"))


def q_scd2_deltas(spark, sf):
    """Two dated deltas applied in order (S13): a changed supplier gets three versions."""
    from voltaic.plans.pipeline import apply_deltas
    dim = transformer_dim(spark, sf)
    s = _t(spark, sf, "supplier").select(F.col("s_suppkey").alias("transformer_id"), "s_name",
                                         F.col("s_nationkey").alias("region"), "s_acctbal")
    later = s.withColumns({"s_acctbal": F.col("s_acctbal") + 2, "record_effective_date": F.lit("2025-06-01")})
    first = s.filter("region < 10").withColumns({"s_acctbal": F.col("s_acctbal") + 1, "record_effective_date": F.lit("2025-05-01")})
    return apply_deltas(dim, later.unionByName(first))


def q_scd2_variant(spark, sf):
    """The documented merge variant (M4): some columns compared, old rows closed on the effective date
    itself, no new versions of changed keys."""
    return merge.scd2_apply(customer_dim(spark, sf), customer_delta(spark, sf), ["customer_id"],
                            compare_cols=["c_acctbal", "c_mktsegment"], end_offset_days=0, insert_new_versions=False)


def q_metrics_report(spark, sf):
    """The metrics of one of two runs, in report order."""
    counts = quality.row_counts([("BRONZE", n, _t(spark, sf, n)) for n in ("orders", "lineitem", "events")]
                                + [("SILVER", "billing_transactions_current", bills_feed(spark, sf))])
    rows = counts.select("layer", F.concat_ws(".", F.lower("layer"), "table_name").alias("table_fqn"),
                         F.lit("rowcount").alias("metric_name"), F.col("row_count").cast("string").alias("metric_value"))
    runs = rows.withColumn("batch_id", F.lit("b1")).unionByName(rows.withColumns({"batch_id": F.lit("b2"), "metric_value": F.lit("0")}))
    return quality.metrics_report(runs, "b1")


def q_partition_overwrite(spark, sf):
    """A mart partitioned by month, then an incremental write that replaces only the months it holds (K5)."""
    from voltaic.plans.tables import write_partitioned
    from voltaic.session import shared_dir
    path = shared_dir(spark, "voltaic", "partition_overwrite")
    month = F.year("due_date") * 100 + F.month("due_date")
    mart = bills_feed(spark, sf).groupBy(month.alias("bill_month"), "payment_status").agg(F.count(F.lit(1)).alias("tx_count"))
    write_partitioned(spark, mart, path, ["bill_month"], incremental=False)
    again = mart.filter("bill_month between 199501 and 199503").withColumn("tx_count", F.col("tx_count") + 1000)
    write_partitioned(spark, again, path, ["bill_month"], incremental=True)
    return spark.read.parquet(path).select("bill_month", "payment_status", "tx_count")


#: Queries whose feed or state has to be written first.
EAGER = ("q_schema_evolve", "q_partition_overwrite", "q_stream_dedup", "q_stream_dedup_id", "q_cdc_stream", "q_csv_feed", "q_scd2_deltas",
         "q_usage_hourly_stream", "q_health_hourly_stream", "q_renewable_hourly_stream", "q_region_thresholds_stored", "q_write_metrics", "q_landed_feeds", "q_cdc_apply_buckets", "q_change_feed", "q_scd2_buckets", "q_latest_incremental")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)
