import datetime as dt

from pyspark.sql import functions as F

from voltaic.operators import marts, quality
from voltaic.operators.anomaly import region_thresholds, score_meter_anomaly
from conftest import rows

T = dt.datetime(2025, 6, 15, 10, 15)


def _readings(spark):
    data = [(f"e{i}", "m1", "N", float(i), T) for i in range(1, 101)]
    data += [("x1", "m2", None, 5.0, T), ("x2", "m3", "S", 7.0, T), ("x3", "m1", "N", None, T)]
    return spark.createDataFrame(data, "event_id string, meter_id string, region string, kwh_consumed double, event_ts timestamp")


def test_meter_anomaly_boundaries_and_nulls(spark):
    df = _readings(spark)
    thr = {r.region: (r.p01_kwh, r.p99_kwh) for r in region_thresholds(df).collect()}
    assert thr["N"] == (1.0, 99.0) and thr["S"] == (7.0, 7.0)
    got = {r.event_id: (r.is_kwh_anomaly, r.anomaly_type) for r in score_meter_anomaly(df).collect()}
    assert got["e1"] == (False, None) and got["e99"] == (False, None)   # equal to bound: not anomalous
    assert got["e100"] == (True, "HIGH_CONSUMPTION")
    assert got["x1"] == (None, None)      # NULL region never matches a threshold
    assert got["x2"] == (False, None)     # one-row region
    assert got["x3"] == (None, None)      # NULL reading -> unknown, not false


def test_usage_with_customer_does_not_fan_out(spark):
    r = spark.createDataFrame([("e1", "m1", "N", "N1", 2.0, 230.0, 5.0, 0.9, True, T, dt.date(2025, 6, 15)),
                               ("e2", "m1", "N", "N1", 3.0, 240.0, 6.0, 1.0, False, T, dt.date(2025, 6, 15))],
                              "event_id string, meter_id string, region string, state string, kwh_consumed double, "
                              "voltage_v double, current_a double, power_factor double, is_kwh_anomaly boolean, "
                              "event_ts timestamp, event_date date")
    hourly = marts.usage_hourly(r)
    h = hourly.first()
    assert (h.kwh_total, h.voltage_avg, h.anomaly_events, h.reading_events, h.anomaly_rate) == (5.0, 235.0, 1, 2, 0.5)
    cust = spark.createDataFrame([("c2", "m1", "S"), ("c1", "m1", "E")], "customer_id string, meter_id string, region string")
    j = marts.usage_with_customer(hourly, cust)
    assert j.count() == 1
    one = j.first()
    assert (one.customer_id, one.meter_owner_count, one.region) == ("c1", 2, "N")   # fact region kept
    assert len(set(j.columns)) == len(j.columns)


def test_billing_daily_null_status_and_missing_columns(spark):
    b = spark.createDataFrame([("t1", dt.date(2025, 7, 1), 10.0, "PAID", True), ("t2", dt.date(2025, 7, 1), 5.0, None, False),
                               ("t3", dt.date(2025, 7, 1), 2.0, "PENDING", None)],
                              "transaction_id string, due_date date, total_amount double, payment_status string, fraud_flag boolean")
    d = marts.billing_daily(b).first()
    assert (d.tx_count, d.amount_total, d.amount_paid, d.amount_outstanding) == (3, 17.0, 10.0, 2.0)
    assert (d.paid_count, d.pending_count, d.fraud_count) == (1, 1, 1)
    bare = marts.billing_daily(b.select("transaction_id", "due_date")).first()
    assert bare.amount_total == 0.0 and bare.paid_count is None and bare.fraud_rate is None


def test_renewable_zero_production_and_missing_evolved_columns(spark):
    df = spark.createDataFrame([("p1", T, 0.0, 0.0)], "plant_id string, event_ts timestamp, production_mw double, grid_injection_mw double")
    r = marts.renewable_hourly(df).first()
    assert (r.curtailment_mw_sum, r.curtailment_rate, r.battery_storage_mwh_max) == (0.0, 0.0, None)


def test_dq_rules_zero_many_and_empty(spark):
    df = spark.createDataFrame([(i, float(100 if i < 30 else 230)) for i in range(40)] + [(None, 230.0)],
                               "event_id int, voltage_v double")
    rules = [quality.Rule("VOLTAGE_OUT_OF_RANGE", "WARNING", (F.col("voltage_v") < 150) | (F.col("voltage_v") > 300),
                          ("event_id", "voltage_v")),
             quality.Rule("NEVER", "WARNING", F.lit(False), ("event_id",)),
             quality.Rule("PK", "CRITICAL", F.col("event_id").isNull(), ("event_id",))]
    out = {r.rule_name: r for r in quality.evaluate_rules(df, rules, "m").collect()}
    assert set(out) == {"VOLTAGE_OUT_OF_RANGE", "PK"}           # zero violations -> no row
    v = out["VOLTAGE_OUT_OF_RANGE"]
    assert v.violation_count == 30
    parts = v.sample_keys.split(" | ")
    assert parts[0] == "event_id,voltage_v" and len(parts) == 21 and parts[1] == "0,100.0" and parts[20] == "19,100.0"
    assert out["PK"].sample_keys == "event_id | "
    empty = quality.empty_table_violation(df.filter("false"), "g")
    assert [(r.rule_name, r.violation_count) for r in empty.collect()] == [("GOLD_EMPTY_TABLE", 1)]
    assert quality.empty_table_violation(df, "g").count() == 0


def test_coverage_and_integrity(spark):
    facts = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "k string")
    dim = spark.createDataFrame([("a",), ("c",)], "k string")
    c = quality.join_coverage(facts, dim, "k").first()
    assert (c.keys_in_facts, c.keys_found_in_dim) == (3, 1)
    ri = quality.referential_integrity([("f->d", facts, ["k"], dim, ["k"])]).first()
    assert (ri.child_rows, ri.null_fk_rows, ri.orphan_rows, ri.orphan_keys) == (4, 1, 2, 1)


def test_billing_daily_extended_counts(spark):
    b = spark.createDataFrame([("t1", dt.date(2025, 7, 1), 1.0, "OVERDUE"), ("t2", dt.date(2025, 7, 1), 2.0, None)],
                              "transaction_id string, due_date date, total_amount double, payment_status string")
    d = marts.billing_daily(b, extended=True).first()
    assert (d.overdue_count, d.unknown_status_count, d.amount_outstanding) == (1, 1, 1.0)


def test_sample_keys_use_csv_quoting(spark):
    df = spark.createDataFrame([('a,b', 1), ('say "hi"', 2), (None, 3)], "k string, v int")
    r = quality.evaluate_rules(df, [quality.Rule("R", "WARNING", F.lit(True), ("k", "v"))], "d").first()
    assert r.sample_keys == 'k,v | ,3 | "a,b",1 | "say ""hi""",2'
