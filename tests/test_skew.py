"""A hot key holding a third of the rows: results equal a brute-force computation."""

import math

import pandas as pd
from pyspark.sql import functions as F

from voltaic.operators import marts
from voltaic.operators.anomaly import region_thresholds, score_meter_anomaly
from voltaic.operators.dedup import dedup_latest
from conftest import SF_SMALL


def _skewed(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    hot = (F.col("event_id") % 3) == 0          # fixture only: a third of the rows share one meter and region
    return ev.select(
        F.col("event_id"), F.when(hot, F.lit(-1)).otherwise(F.col("user_id")).alias("meter_id"),
        F.when(hot, F.lit("HOT")).otherwise(F.col("event_type")).alias("region"), F.lit("S").alias("state"),
        F.col("ts").alias("event_ts"), F.to_date("ts").alias("event_date"), F.col("value").alias("kwh_consumed"),
        F.lit(230.0).alias("voltage_v"), F.lit(5.0).alias("current_a"), F.lit(0.9).alias("power_factor"))


def test_hot_key_dedup_thresholds_and_usage(spark):
    df = _skewed(spark).repartition(6)
    pdf = df.toPandas()

    latest = dedup_latest(df, ["meter_id"], [F.col("event_ts").desc()])
    got = {r.meter_id: r.event_id for r in latest.select("meter_id", "event_id").collect()}
    want = pdf.sort_values("event_ts").groupby("meter_id").tail(1).set_index("meter_id")["event_id"].to_dict()
    assert got == want

    thr = {r.region: (r.p01_kwh, r.p99_kwh) for r in region_thresholds(df).collect()}
    for region, g in pdf.groupby("region"):
        v = sorted(g["kwh_consumed"])
        n = len(v)
        assert thr[region] == (v[math.ceil(0.01 * n) - 1], v[math.ceil(0.99 * n) - 1]), region

    hourly = marts.usage_hourly(score_meter_anomaly(df)).filter(F.col("meter_id") == -1)
    pdf["hour"] = pd.to_datetime(pdf["event_ts"]).dt.floor("h")
    hot = pdf[pdf.meter_id == -1].groupby("hour")["kwh_consumed"].agg(["count", "sum"])
    got_rows = {r.hour_ts: (r.reading_events, r.kwh_total) for r in hourly.collect()}
    assert len(got_rows) == len(hot)
    for h, row in hot.iterrows():
        n, s = got_rows[h.to_pydatetime()]
        assert n == row["count"] and abs(s - row["sum"]) < 1e-6
