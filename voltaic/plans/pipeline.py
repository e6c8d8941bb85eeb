"""End-to-end medallion run: bronze ingest -> silver curation -> gold marts -> audit.

Everything upstream of this module is a pure DataFrame function; this module
decides what is written where and when actions run. One ``batch_id`` is used
for every layer of a run. Re-running with the same inputs is idempotent:
streams resume from their checkpoints, the CDC target is the same function of
its inputs, and the SCD2 merge of an already applied delta changes nothing.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltaic import schemas as K
from voltaic.functions.columns import (backfill_columns, canonicalize, parse_ts, require_columns, resolve_column,
                                       to_ntz, ts_from_filename, with_event_time)
from voltaic.functions.scoring import with_risk_score
from voltaic.operators import marts, merge, quality
from voltaic.operators.anomaly import score_meter_anomaly
from voltaic.operators.dedup import dedup_latest, split_key_validity, with_fallback_key
from voltaic.session import cut_lineage
from voltaic.plans.tables import (AUDIT_DDL, Layout, current_version, delete, ensure_database, exists, folders, merge_buckets,
                                  observed_write, publish, read_current, read_if_present, register_current_view,
                                  register_table, reset_checkpoints, write_partitioned, write_table)
from voltaic.sources.ingest import (add_ingestion_cols, evolve_feed, new_files_only, read_csv_feed, read_json_feed,
                                    read_parquet_feed, stream_json_feed)
from voltaic.streaming.ingest import latest_changes, run_available_now


@dataclass
class Sources:
    """Landing folders of the seven feeds (any may be None to skip that feed)."""
    smart_meter: str | None = None
    telemetry: str | None = None
    billing_cdc: str | None = None
    maintenance: str | None = None
    transformer_snapshot: str | None = None
    transformer_delta: str | None = None
    customer_snapshot: str | None = None
    renewable: str | None = None


@dataclass
class RunResult:
    batch_id: str
    tables: dict[str, str] = field(default_factory=dict)
    metrics: list[tuple[str, str, str, str]] = field(default_factory=list)
    written: dict[str, dict] = field(default_factory=dict)      # what the writes of whole tables observed


# ---------------------------------------------------------------------------
# Bronze
# ---------------------------------------------------------------------------
def ingest_bronze(spark: SparkSession, src: Sources, lay: Layout, batch_id: str, run_mode: str, res: RunResult) -> None:
    incr = run_mode == "INCR"
    run = F.lit(f"run-{batch_id}")

    def stream(name: str, folder: str, schema: T.StructType, system: str, glob: str = "*.json") -> None:
        s = add_ingestion_cols(stream_json_feed(spark, folder, schema, glob=glob), system, batch_id).withColumn(RUN, run)
        out = lay.path("bronze", name)
        run_available_now(s, out, f"{lay.checkpoints}/{name}", partition_by=[RUN])
        res.tables[f"bronze.{name}"] = out

    def batch(name: str, df: DataFrame, system: str, append_ok: bool) -> None:
        out = lay.path("bronze", name)
        df = add_ingestion_cols(df, system, batch_id)
        if append_ok and incr:
            ledger = _try_read(spark, out)
            df = new_files_only(df, ledger)
            write_table(df.withColumn(RUN, run), out, "append", [RUN], repartition_by_partitions=False)
        else:
            write_table(df.withColumn(RUN, run), out, "overwrite", [RUN], repartition_by_partitions=False)
        res.tables[f"bronze.{name}"] = out

    if src.smart_meter:
        stream("smart_meter_events", src.smart_meter, K.with_corrupt(K.SMART_METER_SCHEMA), "smart_meter")
    if src.telemetry:
        stream("substation_telemetry_events", src.telemetry, K.with_corrupt(K.TELEMETRY_SCHEMA), "substation_telemetry")
    if src.billing_cdc:
        batch("billing_cdc_events", read_json_feed(spark, src.billing_cdc, K.with_corrupt(K.BILLING_CDC_SCHEMA)), "billing_cdc", True)
    if src.maintenance:
        batch("maintenance_logs", read_csv_feed(spark, src.maintenance, K.MAINTENANCE_SCHEMA), "maintenance_csv", True)
    for name, path, system in [("transformer_master_snapshot", src.transformer_snapshot, "transformer_master"),
                               ("transformer_master_delta", src.transformer_delta, "transformer_master_delta"),
                               ("customer_master_snapshot", src.customer_snapshot, "customer_master")]:
        if path:
            batch(name, read_parquet_feed(spark, path), system, False)
    if src.renewable:
        schema = evolve_feed(spark, src.renewable, f"{lay.schemas}/renewable", K.RENEWABLE_SCHEMA_HINTS, glob="*.json")
        stream("renewable_production", src.renewable, schema, "renewable_production")
    for t in res.tables:
        res.metrics.append(("BRONZE", t, "status", "loaded"))


#: Bronze tables are partitioned by the run that ingested their rows.
RUN = "_run"


def _try_read(spark: SparkSession, path: str) -> DataFrame | None:
    """A bronze table with the columns of all its files, or None if it was never written."""
    if not exists(spark, path):
        return None
    return read_if_present(lambda: spark.read.option("mergeSchema", True).parquet(path))


def _consumed(lay: Layout, name: str) -> str:
    return lay.path("silver", f"_consumed/{name}")


def pending_bronze(spark: SparkSession, lay: Layout, name: str, incremental: bool) -> tuple[DataFrame | None, list[str]]:
    """Bronze rows that a silver merge has yet to take, and their runs; only those runs' files are read.

    A FULL run takes all runs again. Runs are noted by :func:`note_consumed` after the merge, so what a
    failed run ingested is taken by the next one; taking a run twice changes nothing.
    """
    path = lay.path("bronze", name)
    runs = sorted(f for f in folders(spark, path) if f.startswith(f"{RUN}="))
    if incremental:
        notes = _consumed(lay, name)
        done = {r["run"] for r in spark.read.schema("run string").json(notes).collect()} if exists(spark, notes) else set()  # one row per run
        runs = [r for r in runs if r not in done]
    if not runs:
        return None, []
    read = spark.read.option("mergeSchema", True).option("basePath", path)
    return read.parquet(*[f"{path}/{r}" for r in runs]), runs


def note_consumed(spark: SparkSession, lay: Layout, name: str, runs: list[str]) -> None:
    if runs:
        spark.createDataFrame([(r,) for r in runs], "run string").coalesce(1).write.mode("append").json(_consumed(lay, name))


def latest_rows(key: str):
    """Merge function for :func:`merge_buckets`: the last delivery of each key, by ingestion time and file."""
    def merge_rows(state: DataFrame | None, rows: DataFrame) -> DataFrame:
        rows = rows if state is None else state.unionByName(rows, allowMissingColumns=True)
        return dedup_latest(rows, [key], [F.col("_ingestion_ts").desc(), F.col("_source_file").desc()])
    return merge_rows


# ---------------------------------------------------------------------------
# Silver
# ---------------------------------------------------------------------------
def _curated(bronze: DataFrame) -> DataFrame:
    """Curated names only."""
    return canonicalize(bronze).drop(*K.CANONICAL_NAMES)


def typed_meters(bronze: DataFrame, fallback_key: bool = False) -> tuple[DataFrame, DataFrame, str]:
    """(rows with a key, quarantined rows, the key column). With ``fallback_key`` a reading without ``event_id``
    is keyed by ``meter_id|event_ts`` instead of quarantined."""
    require_columns(bronze, K.CONTRACTS["smart_meter_readings"], "smart-meter feed")
    sm = with_event_time(_curated(bronze), "timestamp", "event_ts", "event_date")
    key = "event_id"
    if fallback_key:
        sm, key = with_fallback_key(sm, "event_id", ["meter_id", "event_ts"]), "_dedup_key"
    return *split_key_validity(sm, [key]), key


def silver_meters(bronze: DataFrame, materialize=None, fallback_key: bool = False) -> tuple[DataFrame, DataFrame]:
    """(scored readings, quarantined rows). Scoring reads the deduplicated readings twice
    (per-region thresholds, then the join); ``materialize`` (e.g. ``cut_lineage``) lets the
    writer store them once so the dedup shuffle is not repeated. ``fallback_key``: see :func:`typed_meters`."""
    valid, quarantine, key = typed_meters(bronze, fallback_key)
    latest = latest_rows(key)(None, valid)
    if fallback_key:
        latest, quarantine = latest.drop(key), quarantine.drop(key)
    if materialize is not None:
        latest = materialize(latest)
    return score_meter_anomaly(latest), quarantine


def typed_telemetry(bronze: DataFrame) -> tuple[DataFrame, DataFrame]:
    require_columns(bronze, K.CONTRACTS["substation_telemetry"], "telemetry feed")
    return split_key_validity(with_event_time(_curated(bronze), "timestamp", "telemetry_ts", "event_date"), ["telemetry_id"])


def silver_telemetry(bronze: DataFrame) -> tuple[DataFrame, DataFrame]:
    valid, quarantine = typed_telemetry(bronze)
    return with_risk_score(latest_rows("telemetry_id")(None, valid)), quarantine


def silver_maintenance(bronze: DataFrame) -> DataFrame:
    c = resolve_column(bronze, K.MAINTENANCE_DATE_CANDIDATES)
    return bronze.withColumn("maintenance_ts", parse_ts(F.col(c).cast("string"))) if c else bronze


def silver_renewable(bronze: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(readings, quarantined rows): typed, backfilled, the latest of each reading id."""
    c = resolve_column(bronze, K.RENEWABLE_TIME_CANDIDATES)
    if c:
        ren = bronze.withColumn("event_ts", parse_ts(F.col(c).cast("string"))).drop(c)
    else:
        ren = bronze.withColumn("event_ts", ts_from_filename("_source_file", K.RENEWABLE_FILE_PATTERN))
    ren = backfill_columns(ren.withColumn("event_date", F.to_date("event_ts")), K.RENEWABLE_EVOLVED_COLUMNS)
    if "reading_id" not in ren.columns:
        return ren, ren.limit(0)
    ren, quarantine = split_key_validity(ren, ["reading_id"])
    return dedup_latest(ren, ["reading_id"], [F.col("_ingestion_ts").desc(), F.col("_source_file").desc()]), quarantine


def silver_billing(bronze: DataFrame) -> DataFrame:
    """Typed change rows, ready for :func:`cdc_latest`."""
    require_columns(bronze, K.CONTRACTS["billing_cdc"], "billing change feed")
    b = bronze.withColumn("cdc_ts", parse_ts("cdc_timestamp"))
    for c in ("billing_period_start", "billing_period_end", "due_date"):
        if c in b.columns:
            b = b.withColumn(c, F.to_date(parse_ts(F.col(c).cast("string"))))
    return b


def _dim_dates(df: DataFrame) -> DataFrame:
    fix = {c: F.to_date(F.col(c).cast("string")) for c in ("record_effective_date", "record_end_date") if c in df.columns}
    return df.withColumns(fix) if fix else df


def split_deltas(deltas: DataFrame, key: str = "transformer_id") -> tuple[DataFrame, DataFrame]:
    """(delta rows with a key and an effective date, rows without one of them, for quarantine)."""
    require_columns(deltas, [key, *K.CONTRACTS["transformer_delta"]], "transformer delta")
    return split_key_validity(_dim_dates(deltas), [key, "record_effective_date"])


def apply_deltas(dim: DataFrame, deltas: DataFrame, key: str = "transformer_id", step=None) -> DataFrame:
    """An SCD2 dimension after all dated deltas, applied in the order of their effective dates.

    One merge for each date (dates of delta files: a handful; ``step`` may store the dimension in
    between). A row that is not newer than its key's current version changes nothing, so deltas
    that were applied before may be given again. Rows without a key or an effective date are no
    version of anything: they are left out (:func:`split_deltas` gives them).
    """
    deltas, _ = split_deltas(deltas, key)
    days = [r[0] for r in deltas.select("record_effective_date").distinct().orderBy("record_effective_date").collect()]
    for i, day in enumerate(days):
        rows = deltas.filter(F.col("record_effective_date") == F.lit(day))
        current = merge.dim_current(dim).select(key, F.to_date("record_effective_date").alias("__since"))
        rows = dedup_latest(rows, [key], [F.col("record_end_date").desc()] if "record_end_date" in rows.columns else [])
        rows = rows.join(current, key, "left").filter("__since is null or record_effective_date > __since").drop("__since")
        dim = merge.scd2_apply(dim, rows, [key])
        if step is not None and i < len(days) - 1:
            dim = step(dim)
    return dim


def run_silver(spark: SparkSession, lay: Layout, batch_id: str, res: RunResult, run_mode: str = "FULL",
               buckets: int = 64) -> dict[str, DataFrame]:
    """Silver tables. The latest row of each key (readings, telemetry, billing changes) and the transformer
    dimension are bucketed tables that continue from their current version in either run mode: an INCR run
    reads the bronze files of new runs only, and touches only the buckets of their keys. What a run
    applies again changes nothing."""
    out: dict[str, DataFrame] = {}
    incr = run_mode == "INCR"
    b = lambda n: _try_read(spark, lay.path("bronze", n))

    def save(name: str, df: DataFrame, ts_col: str | None = None) -> None:
        path = lay.path("silver", name)
        res.written[f"silver.{name}"] = observed_write(df, lambda rows: write_table(rows, path), ts_col)
        res.tables[f"silver.{name}"] = path
        out[name] = spark.read.parquet(path)

    def held(name: str, rows: DataFrame | None = None, runs: Sequence[str] = ()) -> None:
        """Quarantined rows, a partition for each bronze run: a run that is taken again replaces its own."""
        path = lay.path("silver", name)
        if rows is not None and not incr:
            write_table(rows.drop(RUN), f"{path}/{RUN}=all")
            for old in folders(spark, path):
                if old != f"{RUN}=all":
                    delete(spark, f"{path}/{old}")
        for run in runs if incr else ():                       # one run, unless some failed
            write_table(rows.filter(F.col(RUN) == run.split("=", 1)[1]).drop(RUN), f"{path}/{run}")
        res.tables[f"silver.{name}"] = path
        out[name] = spark.read.option("mergeSchema", True).parquet(path).drop(RUN)

    def latest(source: str, state: str, quarantine: str, split, key: str, merge_rows=None, **feed) -> str | None:
        """Merge what is new in a bronze table into the latest row of each key; the state's path."""
        path = lay.path("silver", state)
        rows, runs = pending_bronze(spark, lay, source, incr)
        if rows is not None:
            valid, invalid = split(rows)
            held(quarantine, invalid, runs)
            merge_buckets(spark, path, valid.drop(RUN), [key], merge_rows or latest_rows(key), batch_id, buckets=buckets, **feed)
            note_consumed(spark, lay, source, runs)
        elif folders(spark, lay.path("silver", quarantine)):
            held(quarantine)
        return path if current_version(spark, path) else None

    meters = latest("smart_meter_events", "smart_meter_latest", "smart_meter_quarantine", lambda r: typed_meters(r)[:2], "event_id")
    if meters:
        save("smart_meter_readings", score_meter_anomaly(read_current(spark, meters)), "event_ts")
    telemetry = latest("substation_telemetry_events", "substation_telemetry_latest", "substation_telemetry_quarantine", typed_telemetry, "telemetry_id")
    if telemetry:
        save("substation_telemetry", with_risk_score(read_current(spark, telemetry)), "telemetry_ts")
    if (mnt := b("maintenance_logs")) is not None:
        save("maintenance_logs", silver_maintenance(mnt.drop(RUN)))
    if (cust := b("customer_master_snapshot")) is not None:
        save("dim_customer", _dim_dates(merge.scd2_baseline(cust.drop(RUN))))
    if (ren := b("renewable_production")) is not None:
        readings, q = silver_renewable(ren.drop(RUN))
        save("renewable_production", readings)
        save("renewable_quarantine", q)

    snap, delta = b("transformer_master_snapshot"), b("transformer_master_delta")
    if snap is not None:
        key, path = ["transformer_id"], lay.path("silver", "dim_transformer_versions")
        if current_version(spark, path) is None:
            require_columns(snap, K.CONTRACTS["transformer_snapshot"], "transformer snapshot")
            base = _dim_dates(merge.scd2_baseline(snap.drop(RUN)))
            merge_buckets(spark, path, base, key, lambda old, rows: rows, f"{batch_id}-base", buckets=buckets, feed_keys=[*key, "scd_version"])
        if delta is not None:
            rows, invalid = split_deltas(delta.drop(RUN))
            save("dim_transformer_quarantine", invalid)
            merge_buckets(spark, path, rows, key, lambda old, new: apply_deltas(old, new, step=cut_lineage), batch_id,
                          feed_keys=[*key, "scd_version"])
        out["dim_transformer"] = publish(spark, path, lay.path("silver", "dim_transformer"), key)
        res.tables["silver.dim_transformer"] = lay.path("silver", "dim_transformer")

    key = ["transaction_id"]
    bills = latest("billing_cdc_events", "billing_changes_latest", "billing_quarantine",
                   lambda r: split_key_validity(silver_billing(r), key), key[0], latest_changes(key), feed_keys=key, visible=merge.cdc_upserts)
    if bills:
        out["billing_transactions_current"] = publish(spark, bills, lay.path("silver", "billing_transactions_current"), key, merge.cdc_upserts)
        res.tables["silver.billing_transactions_current"] = lay.path("silver", "billing_transactions_current")
    return out


# ---------------------------------------------------------------------------
# Gold
# ---------------------------------------------------------------------------
def run_gold(spark: SparkSession, lay: Layout, silver: dict[str, DataFrame], incremental: bool,
             res: RunResult) -> dict[str, DataFrame]:
    out: dict[str, DataFrame] = {}

    def save(name: str, df: DataFrame, part: str) -> None:
        path = lay.path("gold", name)
        seen = observed_write(df, lambda rows: write_partitioned(spark, rows, path, [part], incremental))
        if not incremental:                       # an incremental write replaces some dates only
            res.written[f"gold.{name}"] = seen
        res.tables[f"gold.{name}"] = path
        out[name] = spark.read.parquet(path)

    hourly = health = bills = ren = None
    if "smart_meter_readings" in silver:
        hourly = marts.usage_hourly(silver["smart_meter_readings"])
        cust = silver.get("dim_customer")
        save("customer_hourly_usage",
             marts.usage_with_customer(hourly, merge.dim_current(cust)) if cust is not None and "meter_id" in cust.columns
             else hourly, "event_date")
    if "substation_telemetry" in silver:
        health = marts.health_hourly(silver["substation_telemetry"])
        trf = silver.get("dim_transformer")
        save("transformer_health_hourly",
             marts.health_enriched(health, merge.dim_current(trf)) if trf is not None else health, "event_date")
    if "billing_transactions_current" in silver:
        save("billing_kpis_daily", marts.billing_daily(silver["billing_transactions_current"]), "bill_date")
        bills = out["billing_kpis_daily"]
    if "renewable_production" in silver:
        save("renewable_kpis_hourly", marts.renewable_hourly(silver["renewable_production"]), "event_date")
        ren = marts.renewable_daily(out["renewable_kpis_hourly"])
    if hourly is not None and health is not None:
        for mart in ("customer_hourly_usage", "transformer_health_hourly"):
            require_columns(out[mart], K.CONTRACTS[mart], mart)
        energy, risk = marts.energy_daily(out["customer_hourly_usage"]), marts.risk_daily(out["transformer_health_hourly"])
        if bills is None:
            bills = spark.createDataFrame([], "bill_date date, tx_count bigint, amount_total double, amount_paid double, "
                                              "amount_outstanding double, fraud_rate double")
        if ren is None:
            ren = spark.createDataFrame([], "event_date date, renewable_production_mw double, renewable_injection_mw double, "
                                            "renewable_curtailment_mw double, renewable_curtailment_rate double")
        save("ops_daily_dashboard", marts.ops_daily(energy, risk, bills, ren), "event_date")
    return out


# ---------------------------------------------------------------------------
# Audit
# ---------------------------------------------------------------------------
def run_audit(spark: SparkSession, lay: Layout, batch_id: str, silver: dict[str, DataFrame],
              gold: dict[str, DataFrame], res: RunResult) -> None:
    parts = []
    if "smart_meter_readings" in silver:
        sm = silver["smart_meter_readings"].unionByName(silver["smart_meter_quarantine"], allowMissingColumns=True)
        parts.append(quality.evaluate_rules(sm, quality.meter_rules(), "smart_meter_readings"))
    if "substation_telemetry" in silver:
        tel = silver["substation_telemetry"].unionByName(silver["substation_telemetry_quarantine"],
                                                         allowMissingColumns=True)
        parts.append(quality.evaluate_rules(tel, quality.telemetry_rules(), "substation_telemetry"))
    if "billing_transactions_current" in silver:
        bill = silver["billing_transactions_current"].unionByName(silver["billing_quarantine"], allowMissingColumns=True)
        parts.append(quality.evaluate_rules(bill, quality.billing_rules(bill), "billing_transactions_current"))
    if "dim_transformer" in silver:
        trf = silver["dim_transformer"]
        parts.append(quality.dimension_multi_current(trf, "transformer_id", "dim_transformer"))
        parts.append(quality.evaluate_rules(trf, [quality.dimension_end_date_rule("transformer_id")], "dim_transformer"))
    if "ops_daily_dashboard" in gold:
        parts.append(quality.empty_table_violation(gold["ops_daily_dashboard"], "ops_daily_dashboard"))
    if parts:
        v = parts[0]
        for p in parts[1:]:
            v = v.unionByName(p)
        v = v.select(F.lit(batch_id).alias("batch_id"), *v.columns, F.current_timestamp().alias("created_ts"))
        write_table(v.repartition(1), lay.path("audit", "dq_violations"), "append")
        res.tables["audit.dq_violations"] = lay.path("audit", "dq_violations")

    # coverage and time bounds (tiny one-row aggregates)
    if "smart_meter_readings" in silver and "dim_customer" in silver and "meter_id" in silver["dim_customer"].columns:
        cov = quality.join_coverage(silver["smart_meter_readings"], merge.dim_current(silver["dim_customer"]), "meter_id")
        rate = cov.select(quality.coverage_metric(cov, "keys_in_facts", "keys_found_in_dim")).first()[0]
        res.metrics.append(("SILVER", "silver.smart_meter_readings", "meter_to_customer_join_coverage", rate))
    if "substation_telemetry" in silver and "dim_transformer" in silver:
        cov = quality.join_coverage(silver["substation_telemetry"], merge.dim_current(silver["dim_transformer"]),
                                    "transformer_id")
        rate = cov.select(quality.coverage_metric(cov, "keys_in_facts", "keys_found_in_dim")).first()[0]
        res.metrics.append(("SILVER", "silver.substation_telemetry", "telemetry_to_transformer_join_coverage", rate))
    for name, seen in res.written.items():                      # seen by the writes themselves
        layer = name.split(".")[0].upper()
        res.metrics.append((layer, name, "rowcount", str(seen["rows"])))
        res.metrics += [(layer, name, m, str(seen[m])) for m in ("min_ts", "max_ts") if m in seen]
    # tables that a run appends to or replaces in part: row counts from the parquet footers
    tables = [(name.split(".")[0].upper(), name, df) for name, path in res.tables.items() if name not in res.written
              and exists(spark, path) and (df := read_if_present(lambda p=path: spark.read.parquet(p))) is not None]
    for row in quality.row_counts(tables).collect() if tables else []:
        res.metrics.append((row["layer"], row["table_name"], "rowcount", str(row["row_count"])))
    metrics = quality.metric_rows(spark, batch_id, res.metrics)
    write_table(metrics.coalesce(1), lay.path("audit", "table_metrics"), "append")


def register_catalog(spark: SparkSession, target_root: str, prefix: str, res: RunResult) -> dict[str, str]:
    """Register every written table as ``<prefix>_<layer>.<table>`` (external parquet tables),
    the audit tables with their typed columns, and ``*_current`` views of the dimensions."""
    lay = Layout(target_root)
    names = {}
    for name, path in res.tables.items():
        layer, table = name.split(".", 1)
        db = f"{prefix}_{layer}"
        ensure_database(spark, db, f"{lay.root.rstrip('/')}/_catalog")
        names[name] = register_table(spark, db, table, path, AUDIT_DDL.get(table) if layer == "audit" else None)
        if layer == "silver" and table.startswith("dim_") and not table.endswith("_quarantine"):
            names[f"{name}_current"] = register_current_view(spark, db, table)
    return names


def run_pipeline(spark: SparkSession, sources: Sources, target_root: str, run_mode: str = "FULL",
                 batch_id: str | None = None, catalog_prefix: str | None = None,
                 forget_checkpoints: bool = False, buckets: int = 64) -> RunResult:
    """Run all layers once with a single batch id; returns written paths and metrics.

    With ``catalog_prefix`` the written tables are also registered in the session
    catalog (``<prefix>_bronze`` ... ``<prefix>_audit`` databases). ``forget_checkpoints`` makes the
    streams read every landed file again (the latest-per-key steps absorb the repeats). ``buckets``: of
    the merged tables, when they are new.
    """
    if run_mode not in ("FULL", "INCR"):
        raise ValueError("run_mode must be FULL or INCR")
    batch_id = batch_id or uuid.uuid4().hex
    lay = Layout(target_root)
    res = RunResult(batch_id)
    if forget_checkpoints:
        reset_checkpoints(spark, lay)
    ingest_bronze(spark, sources, lay, batch_id, run_mode, res)
    silver = run_silver(spark, lay, batch_id, res, run_mode, buckets)
    gold = run_gold(spark, lay, silver, run_mode == "INCR", res)
    run_audit(spark, lay, batch_id, silver, gold, res)
    res.tables["audit.table_metrics"] = lay.path("audit", "table_metrics")
    if catalog_prefix:
        register_catalog(spark, target_root, catalog_prefix, res)
    return res


def read_report(spark: SparkSession, target_root: str, batch_id: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(DQ report, metrics report, executive snapshot) of one run."""
    lay = Layout(target_root)
    dq = quality.dq_report(spark.read.parquet(lay.path("audit", "dq_violations")), batch_id)
    met = quality.metrics_report(spark.read.parquet(lay.path("audit", "table_metrics")), batch_id)
    snap = marts.ops_snapshot(spark.read.parquet(lay.path("gold", "ops_daily_dashboard")))
    return dq, met, to_ntz(snap)
