import json
import os
import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltaic.sources.ingest import evolve_schema, load_schema, save_schema, stream_json_feed
from voltaic.streaming.ingest import run_available_now, watermark_dedup

SCHEMA = T.StructType([T.StructField("event_id", T.StringType()), T.StructField("timestamp", T.StringType()),
                       T.StructField("v", T.DoubleType())])


def _write(folder, name, recs):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        for r in recs:
            f.write(json.dumps(r) + "\n")


def test_watermark_dedup_across_runs(spark, tmpdir_path):
    land, out, ck = f"{tmpdir_path}/land", f"{tmpdir_path}/out", f"{tmpdir_path}/ck"

    def job():
        s = stream_json_feed(spark, land, SCHEMA).withColumn("ts", F.to_timestamp("timestamp"))
        run_available_now(watermark_dedup(s, ["event_id"], "ts", "10 minutes"), out, ck)

    _write(land, "a.json", [{"event_id": "e1", "timestamp": "2025-06-15T10:00:00Z", "v": 1.0},
                            {"event_id": "e1", "timestamp": "2025-06-15T10:00:00Z", "v": 1.0},   # same batch
                            {"event_id": "e2", "timestamp": "2025-06-15T11:00:00Z", "v": 2.0}])
    job()
    assert spark.read.parquet(out).count() == 2
    job()  # nothing new: checkpoint makes the rerun a no-op
    assert spark.read.parquet(out).count() == 2
    _write(land, "b.json", [{"event_id": "e2", "timestamp": "2025-06-15T11:00:00Z", "v": 2.0},   # later run dup
                            {"event_id": "e0", "timestamp": "2025-06-15T09:00:00Z", "v": 0.0},   # behind watermark
                            {"event_id": "e3", "timestamp": "2025-06-15T11:05:00Z", "v": 3.0}])
    job()
    ids = sorted(r.event_id for r in spark.read.parquet(out).collect())
    assert ids == ["e1", "e2", "e3"]


def test_schema_evolution_restart_adds_columns(spark, tmpdir_path):
    land, loc = f"{tmpdir_path}/ren", f"{tmpdir_path}/schema"
    _write(land, "renewable_production_20250615_0800.json", [{"reading_id": "r1", "production_mw": 1}])
    s1 = evolve_schema(spark, land, load_schema(spark, loc), "production_mw double, curtailment_mw double")
    save_schema(spark, s1, loc)
    _write(land, "renewable_production_20250615_0900.json",
           [{"reading_id": "r2", "production_mw": 2.5, "battery_storage_mwh": 4.0}])
    s2 = evolve_schema(spark, land, load_schema(spark, loc), "production_mw double")
    assert s2.fieldNames()[:len(s1.fields)] == s1.fieldNames()     # persisted columns keep their place
    assert {"curtailment_mw", "battery_storage_mwh"} <= set(s2.fieldNames())
    assert s2["production_mw"].dataType == T.DoubleType()


def test_streaming_cdc_foreach_batch(spark, tmpdir_path):
    from voltaic.streaming.ingest import cdc_foreach_batch, read_cdc_state
    land, ck, target = f"{tmpdir_path}/cdc", f"{tmpdir_path}/ck", f"{tmpdir_path}/current"
    schema = T.StructType([T.StructField("__$operation", T.IntegerType()), T.StructField("__$seqval", T.StringType()),
                           T.StructField("transaction_id", T.StringType()), T.StructField("amount", T.DoubleType()),
                           T.StructField("cdc_timestamp", T.StringType())])
    changes = lambda df: df.withColumn("cdc_ts", F.to_timestamp("cdc_timestamp")).drop("cdc_timestamp")

    def job():
        s = changes(stream_json_feed(spark, land, schema))
        q = (s.writeStream.foreachBatch(cdc_foreach_batch(target, ["transaction_id"]))
             .option("checkpointLocation", ck).trigger(availableNow=True).start())
        q.awaitTermination()
        assert q.exception() is None
        return sorted((r.transaction_id, r.amount) for r in read_cdc_state(spark, target).collect())

    rec = lambda op, tx, amt, ts: {"__$operation": op, "__$seqval": "000000000001", "transaction_id": tx,
                                   "amount": amt, "cdc_timestamp": f"2025-06-15T{ts}:00Z"}
    assert read_cdc_state(spark, target) is None
    _write(land, "a.json", [rec(2, "t1", 10.0, "10:00"), rec(2, "t2", 20.0, "10:00")])
    assert job() == [("t1", 10.0), ("t2", 20.0)]
    _write(land, "b.json", [rec(4, "t1", 15.0, "12:00"), rec(1, "t2", None, "11:00"), rec(2, "t3", 30.0, "11:00")])
    assert job() == [("t1", 15.0), ("t3", 30.0)]
    _write(land, "c.json", [rec(4, "t1", 11.0, "11:00"), rec(4, "t2", 21.0, "10:30")])      # both late
    assert job() == [("t1", 15.0), ("t3", 30.0)]
    _write(land, "d.json", [rec(1, "t1", None, "13:00"), rec(1, "t3", None, "13:00")])      # everything goes
    assert job() == []
    _write(land, "e.json", [rec(2, "t4", 40.0, "14:00")])
    assert job() == [("t4", 40.0)]                                                          # and stays gone
    # a retried epoch starts from the version before it
    batch = changes(spark.createDataFrame([(4, "000000000001", "t4", 41.0, "2025-06-15T15:00:00Z")], schema))
    for _ in range(2):
        cdc_foreach_batch(target, ["transaction_id"])(batch, 5)
        assert [(r.transaction_id, r.amount) for r in read_cdc_state(spark, target).collect()] == [("t4", 41.0)]


def test_stream_dedup_of_a_folder_equals_that_of_a_file(spark, tmpdir_path):
    from voltaic.streaming.ingest import stream_dedup_events
    rows = spark.range(200).selectExpr("id as event_id", "timestamp_ntz'2025-01-01 00:00:00' + make_interval(0,0,0,0,0,cast(id % 37 as int)) as ts", "id * 2 as v")
    rows.coalesce(1).write.parquet(f"{tmpdir_path}/one")
    rows.repartition(4).write.parquet(f"{tmpdir_path}/four.parquet")
    one = [os.path.join(tmpdir_path, "one", f) for f in os.listdir(f"{tmpdir_path}/one") if f.endswith(".parquet")][0]
    for table in (one, f"{tmpdir_path}/four.parquet"):
        for within in (False, True):
            got = stream_dedup_events(spark, table, "400 days", within, files_per_batch=1)
            assert got.count() == 200 and got.distinct().count() == 200


def test_evolving_numbers_and_corrupt_lines(spark, tmpdir_path):
    land = f"{tmpdir_path}/ren"
    _write(land, "a.json", [{"id": "r1", "mw": 5}])
    s1 = evolve_schema(spark, land)
    _write(land, "b.json", [{"id": "r2", "mw": 5.5, "turbine": 7}])
    with open(f"{land}/c.json", "w") as f:
        f.write("{not json\n")
    s2 = evolve_schema(spark, land, s1)
    rows = {r.id: r for r in spark.read.schema(s2).json(land).collect()}
    assert (rows["r1"].mw, rows["r2"].mw, rows["r2"].turbine) == (5.0, 5.5, 7.0)
    assert rows[None]._corrupt_record == "{not json"


def test_parse_envelope_binary_payload_keeps_broker_metadata(spark):
    import datetime as dt
    from voltaic.schemas import SMART_METER_SCHEMA
    from voltaic.sources.ingest import parse_envelope
    msg = json.dumps({"event_id": "e1", "meter_id": "SM-N-00001", "timestamp": "2025-06-15T10:00:48.337Z",
                      "reading_kwh": 2.5, "region": "NORTH"}).encode()
    df = spark.createDataFrame([(bytearray(msg), dt.datetime(2025, 6, 15, 10, 0, 49))], "value binary, timestamp timestamp")
    out = parse_envelope(df, SMART_METER_SCHEMA, "value", keep=[F.col("timestamp").alias("kafka_ts")])
    r = out.first()
    assert (r.event_id, r.reading_kwh, r.region, r.kafka_ts) == ("e1", 2.5, "NORTH", dt.datetime(2025, 6, 15, 10, 0, 49))
    assert out.columns[-1] == "kafka_ts" and "meter_status" in out.columns


def test_dedup_within_watermark_on_id_only(spark, tmpdir_path):
    land, out, ck = f"{tmpdir_path}/land", f"{tmpdir_path}/out", f"{tmpdir_path}/ck"
    _write(land, "a.json", [{"event_id": "t1", "timestamp": "2025-06-15T10:00:00Z", "v": 1.0},
                            {"event_id": "t1", "timestamp": "2025-06-15T10:00:05Z", "v": 1.0},   # same id, new time
                            {"event_id": "t2", "timestamp": "2025-06-15T10:01:00Z", "v": 2.0}])
    s = stream_json_feed(spark, land, SCHEMA).withColumn("ts", F.to_timestamp("timestamp"))
    run_available_now(watermark_dedup(s, ["event_id"], "ts", "5 minutes", within_watermark=True), out, ck)
    assert sorted(r.event_id for r in spark.read.parquet(out).collect()) == ["t1", "t2"]


def test_subscribe_stream_parses_payloads_with_throttling(spark, tmpdir_path):
    from voltaic.sources.ingest import subscribe_stream
    land, out, ck = f"{tmpdir_path}/bus", f"{tmpdir_path}/out", f"{tmpdir_path}/ck"
    _write(land, "p1.json", [{"event_id": "e1", "timestamp": "2025-06-15T10:00:00Z", "v": 1.5}])
    _write(land, "p2.json", [{"event_id": "e2", "timestamp": "2025-06-15T10:00:01Z", "v": 2.5}])
    # a text stream stands in for the bus: one payload per line in column `value`, one file per trigger
    s = subscribe_stream(spark, "text", {"path": land, "maxFilesPerTrigger": "1"}, SCHEMA, "value",
                         keep=[F.current_timestamp().alias("received_ts")])
    q = s.writeStream.format("parquet").option("checkpointLocation", ck).trigger(availableNow=True).start(out)
    q.awaitTermination()
    assert q.recentProgress and max(p["numInputRows"] for p in q.recentProgress) == 1   # throttled: 1 file per batch
    got = sorted((r.event_id, r.v) for r in spark.read.parquet(out).collect())
    assert got == [("e1", 1.5), ("e2", 2.5)]
