"""End-to-end run of all layers on small literal feeds, then an idempotent re-run."""

import json
import os

from pyspark.sql import functions as F

from voltaic.plans.pipeline import Sources, read_report, run_pipeline


def _jsonl(path, recs):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        for r in recs:
            f.write(json.dumps(r) + "\n")


def _meter(i, kwh, ts="2025-06-15T10:00:48.337Z", eid=None, region="NORTH"):
    return {"event_id": eid if eid is not None else f"ev{i}", "meter_id": f"SM-N-{i % 3:05d}", "customer_id": "CUST-1",
            "timestamp": ts, "reading_kwh": kwh, "voltage_v": 230.0 if i else 100.0, "current_a": 5.0,
            "power_factor": 0.9, "frequency_hz": 50.0, "meter_status": "ACTIVE", "region": region, "state": "Delhi",
            "grid_zone": "ZONE-1", "is_anomaly_flag": False}


def _feeds(spark, root):
    meters = [_meter(i, 1.0 + i) for i in range(30)] + [_meter(1, 2.0), _meter(40, 3.0, eid=None, ts="bad-time"),
                                                         _meter(41, 3.0, eid="")]
    _jsonl(f"{root}/smart_meter/part1.json", meters)
    tel = [{"telemetry_id": f"t{i}", "substation_id": "SUB-N-001", "transformer_id": f"TRF-N-{i % 2:04d}",
            "timestamp": "2025-06-15T10:30:00.000Z", "load_percentage": 95.0 if i == 0 else 50.0, "oil_temperature_c": 70.0,
            "ambient_temperature_c": 30.0, "dissolved_gas_ppm": 100.0, "alarm_code": "OVERHEAT" if i == 0 else None,
            "region": "NORTH", "state": "Delhi", "sequence_number": i} for i in range(4)]
    _jsonl(f"{root}/telemetry/part1.json", tel)
    def bill(tx, op, amt, ts, seq):
        return {"__$start_lsn": "00000000000A", "__$seqval": seq, "__$operation": op, "__$command_id": 1,
                "transaction_id": tx, "customer_id": "CUST-1", "meter_id": "SM-N-00001",
                "billing_period_start": "2025-06-01", "billing_period_end": "2025-06-30", "due_date": "2025-07-01",
                "total_amount": amt, "payment_status": "PAID" if tx == "tx1" else "PENDING", "fraud_flag": False,
                "cdc_timestamp": ts}
    _jsonl(f"{root}/billing/feed.json", [
        bill("tx1", 2, 100.0, "2025-06-15T10:00:00.000Z", "000000000001"),
        bill("tx1", 3, 100.0, "2025-06-15T11:00:00.000Z", "000000000002"),
        bill("tx1", 4, 120.0, "2025-06-15T11:00:00.000Z", "000000000002"),
        bill("tx2", 2, 50.0, "2025-06-15T10:00:00.000Z", "000000000001"),
        bill("tx2", 1, 50.0, "2025-06-15T12:00:00.000Z", "000000000003"),
        bill("tx3", 2, 70.0, "2025-06-15T10:00:00.000Z", "000000000001")])
    os.makedirs(f"{root}/maintenance", exist_ok=True)
    with open(f"{root}/maintenance/maintenance_logs_2025_06.csv", "w") as f:
        f.write("log_id,transformer_id,reported_date,hours_spent,cost_inr\nML-1,TRF-N-0000,2025-06-02,,\n"
                "ML-2,TRF-N-0001,2025-06-03,4.5,1200.0\n")
    snap = spark.createDataFrame(
        [("TRF-N-0000", "NORTH", 80.0, "ACTIVE", "2025-01-01", "9999-12-31", True, 1),
         ("TRF-N-0001", "NORTH", 70.0, "ACTIVE", "2025-01-01", "9999-12-31", True, 1)],
        "transformer_id string, region string, health_index_score double, status string, record_effective_date string, "
        "record_end_date string, is_current boolean, scd_version long")
    snap.write.mode("overwrite").parquet(f"{root}/trf/snapshot")
    delta = spark.createDataFrame(
        [("TRF-N-0000", "NORTH", 60.0, "UNDER_MAINTENANCE", "2025-06-01", "9999-12-31", True, 2),
         ("TRF-N-0001", "NORTH", 70.0, "ACTIVE", "2025-06-01", "9999-12-31", True, 2)], snap.schema)
    delta.write.mode("overwrite").parquet(f"{root}/trf/delta")
    spark.createDataFrame([("CUST-1", "SM-N-00001", "NORTH"), ("CUST-2", "SM-N-00001", "NORTH")],
                          "customer_id string, meter_id string, region string").write.mode("overwrite").parquet(f"{root}/cust")
    _jsonl(f"{root}/ren/renewable_production_20250615_0800.json",
           [{"reading_id": "r1", "plant_id": "P1", "timestamp": "2025-06-15T08:10:00.000Z", "production_mw": 10.0,
             "grid_injection_mw": 9.0}])
    _jsonl(f"{root}/ren/renewable_production_20250615_0900.json",
           [{"reading_id": "r2", "plant_id": "P1", "timestamp": "2025-06-15T09:10:00.000Z", "production_mw": 10.0,
             "grid_injection_mw": 9.0, "curtailment_mw": 1.0, "battery_storage_mwh": 3.0}])
    return Sources(smart_meter=f"{root}/smart_meter", telemetry=f"{root}/telemetry", billing_cdc=f"{root}/billing",
                   maintenance=f"{root}/maintenance", transformer_snapshot=f"{root}/trf/snapshot",
                   transformer_delta=f"{root}/trf/delta", customer_snapshot=f"{root}/cust", renewable=f"{root}/ren")


def test_full_then_incremental_run(spark, tmpdir_path):
    src = _feeds(spark, f"{tmpdir_path}/landing")
    target = f"{tmpdir_path}/lake"
    r1 = run_pipeline(spark, src, target, "FULL", batch_id="b1")
    sm = spark.read.parquet(r1.tables["silver.smart_meter_readings"])
    assert sm.count() == 31                              # 33 rows, one duplicate event, one blank key quarantined
    assert "kwh_consumed" in sm.columns and sm.filter(F.col("event_ts").isNull()).count() == 1
    bill = spark.read.parquet(r1.tables["silver.billing_transactions_current"])
    assert sorted((r.transaction_id, r.total_amount) for r in bill.collect()) == [("tx1", 120.0), ("tx3", 70.0)]
    trf = spark.read.parquet(r1.tables["silver.dim_transformer"])
    assert trf.count() == 3 and trf.filter("is_current").count() == 2
    ops = spark.read.parquet(r1.tables["gold.ops_daily_dashboard"])
    assert ops.filter("event_date is not null").count() == 1    # the bad-time reading forms a NULL-date row
    assert ops.count() == 2
    dq, met, snap = read_report(spark, target, "b1")
    rules = {(r.dataset, r.rule_name): r.violation_count for r in dq.collect()}
    assert rules[("smart_meter_readings", "PK_NOT_NULL_event_id")] == 1
    assert rules[("smart_meter_readings", "INVALID_TIMESTAMP")] == 1
    assert rules[("smart_meter_readings", "VOLTAGE_OUT_OF_RANGE")] == 1
    assert ("dim_transformer", "SCD2_MULTIPLE_CURRENT_RECORDS") not in rules
    names = {(r.table_fqn, r.metric_name) for r in met.collect()}
    assert ("silver.substation_telemetry", "telemetry_to_transformer_join_coverage") in names
    ren = spark.read.parquet(r1.tables["gold.renewable_kpis_hourly"])
    assert sorted(r.curtailment_mw_sum for r in ren.collect()) == [0.0, 1.0]

    r2 = run_pipeline(spark, src, target, "INCR", batch_id="b2", catalog_prefix="grid")
    assert spark.catalog.tableExists("grid_gold.ops_daily_dashboard")
    assert spark.table("grid_silver.dim_transformer_current").count() == 2
    assert spark.table("grid_gold.ops_daily_dashboard").count() == 2                          # its partitions are registered
    assert spark.sql("SELECT count(*) FROM grid_audit.dq_violations WHERE batch_id = 'b2'").first()[0] > 0
    assert spark.table("grid_audit.table_metrics").schema["metric_value"].dataType.typeName() == "string"
    assert spark.read.parquet(r2.tables["silver.smart_meter_readings"]).count() == 31
    assert spark.read.parquet(r2.tables["bronze.billing_cdc_events"]).count() == 6     # file ledger: no re-append
    trf2 = spark.read.parquet(r2.tables["silver.dim_transformer"])
    assert sorted(map(tuple, trf2.collect())) == sorted(map(tuple, trf.collect()))   # SCD2 re-run is a no-op
    bill2 = spark.read.parquet(r2.tables["silver.billing_transactions_current"])
    assert sorted((r.transaction_id, r.total_amount) for r in bill2.collect()) == [("tx1", 120.0), ("tx3", 70.0)]
