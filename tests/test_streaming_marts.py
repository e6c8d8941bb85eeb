"""Hourly marts as streams: late rows, retried epochs, and state that stays bounded."""

import datetime as dt
import os

from pyspark.sql import functions as F

from voltaic.operators import marts
from voltaic.streaming.ingest import run_available_now, watermark_dedup
from voltaic.streaming.marts import late_rows, read_mart, run_mart, usage_hourly_stream

DDL = ("event_ts timestamp_ntz, event_date date, meter_id string, region string, state string, kwh_consumed double, "
       "voltage_v double, current_a double, power_factor double")


def readings(spark, *rows):
    day = dt.datetime(2025, 1, 1)
    return spark.createDataFrame([(at := day + dt.timedelta(minutes=m), at.date(), meter, "r", "s", kwh, 1.0, 1.0, 1.0) for m, meter, kwh in rows], DDL)


def listed(mart):
    rows = mart.select("hour_ts", "meter_id", "kwh_total", "reading_events").collect()
    return sorted(map(tuple, rows), key=lambda r: tuple(map(str, r)))


def test_usage_stream_counts_late_rows_and_equals_the_batch(spark, tmpdir_path):
    land, mart = f"{tmpdir_path}/land", f"{tmpdir_path}/mart"

    def drain(rows):
        rows.write.mode("append").parquet(land)
        q = run_mart(usage_hourly_stream(spark.readStream.schema(DDL).parquet(land), "1 hour"), mart, f"{tmpdir_path}/ck", ["meter_id", "region", "state"], buckets=4)
        return q, listed(read_mart(spark, mart))

    first = readings(spark, (10, "a", 1.0), (20, "a", 2.0), (70, "a", 4.0), (75, None, 8.0))
    q, got = drain(first)
    assert late_rows(q) == 0
    assert got == listed(marts.usage_hourly(first)) and len(got) == 3
    more = readings(spark, (50, "a", 16.0), (300, "a", 1.0))                        # 50: the hour is still open
    q, got = drain(more)
    assert late_rows(q) == 0 and (dt.datetime(2025, 1, 1, 0), "a", 19.0, 3) in got
    q, got = drain(readings(spark, (30, "a", 100.0), (31, "b", 100.0), (290, "a", 5.0)))   # the watermark is at minute 240
    assert late_rows(q) == 2
    want = marts.usage_hourly(first.unionByName(more).unionByName(readings(spark, (290, "a", 5.0))))
    assert got == listed(want)
    assert max(op["numRowsTotal"] for op in q.lastProgress["stateOperators"]) <= 2          # closed hours have left


def test_dedup_state_is_evicted(spark, tmpdir_path):
    land = f"{tmpdir_path}/land"
    rows = spark.range(0, 1000).select("id", (F.lit("2025-01-01").cast("timestamp") + F.make_dt_interval(mins=F.col("id"))).alias("ts"))
    totals = []
    for i in range(4):
        rows.filter(f"id >= {250 * i - 3} and id < {250 * (i + 1)}").write.mode("append").parquet(land)   # three rows come again
        stream = watermark_dedup(spark.readStream.schema(rows.schema).parquet(land), ["id"], "ts", "10 minutes")
        q = run_available_now(stream, f"{tmpdir_path}/out", f"{tmpdir_path}/ck")
        totals.append(q.lastProgress["stateOperators"][0]["numRowsTotal"])
        assert q.lastProgress["stateOperators"][0]["customMetrics"].get("rocksdbPutLatency") is not None
    assert max(totals) <= 12                                                                # not a thousand
    assert spark.read.parquet(f"{tmpdir_path}/out").count() == 1000


def test_a_drain_loads_state_from_files_and_replays_no_changes(spark, tmpdir_path):
    rows = spark.createDataFrame([(dt.datetime(2025, 1, 1), "a")], "ts timestamp, k string")
    for _ in range(2):
        rows.write.mode("append").parquet(f"{tmpdir_path}/land")
        stream = spark.readStream.schema(rows.schema).parquet(f"{tmpdir_path}/land")
        run_available_now(watermark_dedup(stream, ["k"], "ts"), f"{tmpdir_path}/out", f"{tmpdir_path}/ck")
    kept = [f for _, _, files in os.walk(f"{tmpdir_path}/ck/state") for f in files]
    assert any(f.endswith(".zip") for f in kept) and not any(f.endswith(".changelog") for f in kept)
    assert spark.read.parquet(f"{tmpdir_path}/out").count() == 1
