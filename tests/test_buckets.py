"""Bucketed tables: merges touch what changed, epochs can be retried, changes can be read, increments equal the whole."""

import datetime as dt
import os
import time

import pytest
from pyspark.sql import functions as F

from voltaic.operators.dedup import dedup_latest
from voltaic.plans import pipeline
from voltaic.plans.pipeline import Sources, apply_deltas, run_pipeline
from voltaic.plans.tables import (bucket_of, current_version, merge_buckets, observed_write, publish, read_changes, read_current)
from voltaic.streaming.ingest import cdc_foreach_batch, read_cdc_state
from tests.test_pipeline import _jsonl, _meter

CDC = "`__$operation` int, `__$seqval` string, transaction_id string, amount double, cdc_ts timestamp"


def change(spark, *rows):
    return spark.createDataFrame([(op, "1", k, v, dt.datetime(2025, 1, day)) for op, k, v, day in rows], CDC)


def live(spark, root):
    return sorted((r.transaction_id, r.amount) for r in read_cdc_state(spark, root).collect())


def test_an_epoch_can_be_retried_any_number_of_times(spark, tmpdir_path):
    root = f"{tmpdir_path}/state"
    merge = cdc_foreach_batch(root, ["transaction_id"], buckets=4)
    epochs = [change(spark, (2, "a", 1.0, 1), (2, "b", 1.0, 1)), change(spark, (4, "a", 2.0, 2), (2, "c", 1.0, 2)),
              change(spark, (1, "b", None, 3), (4, "c", 3.0, 3), (2, "d", 1.0, 3))]
    for e, batch in enumerate(epochs):
        merge(batch, e)
    want = [("a", 2.0), ("c", 3.0), ("d", 1.0)]
    assert live(spark, root) == want
    for _ in range(4):                                                     # 2, 2, 2, 2
        merge(epochs[2], 2)
        assert live(spark, root) == want and current_version(spark, root).version == 2
    # a crash after the rows were written and before the log line: the folder is there, the line is not
    os.makedirs(f"{root}/v=3-crashed/data/_bucket=0")
    merge(change(spark, (1, "d", None, 4)), 3)
    assert live(spark, root) == want[:2]
    feed = sorted((r._commit_version, r._change_type, r.transaction_id, r.amount) for r in read_changes(spark, root).collect())
    assert feed == [(0, "insert", "a", 1.0), (0, "insert", "b", 1.0), (1, "insert", "c", 1.0), (1, "update_postimage", "a", 2.0),
                    (1, "update_preimage", "a", 1.0), (2, "delete", "b", 1.0), (2, "insert", "d", 1.0), (2, "update_postimage", "c", 3.0),
                    (2, "update_preimage", "c", 1.0), (3, "delete", "d", 1.0)]
    assert read_changes(spark, root, 1, 2).count() == 7 and read_changes(spark, root, 9).count() == 0
    assert len([f for f in os.listdir(f"{root}/_versions") if f.endswith(".json")]) == 2    # the log doesn't grow


def files_of(root, spark):
    return {b: sorted(f for f in os.listdir(p.replace("file:", "")) if f.endswith(".parquet")) for b, p in current_version(spark, root).parts.items()}


def test_untouched_buckets_keep_their_files(spark, tmpdir_path):
    root, out = f"{tmpdir_path}/t", f"{tmpdir_path}/out"
    keep_last = lambda old, new: dedup_latest(new if old is None else old.unionByName(new, allowMissingColumns=True), ["k"], [F.col("v").desc()])
    rows = spark.range(200).select(F.col("id").alias("k"), F.lit(1).alias("v"))
    merge_buckets(spark, root, rows, ["k"], keep_last, "r0", buckets=16)
    first = files_of(root, spark)
    assert len(first) == 16 and publish(spark, root, out, ["k"]).count() == 200
    published = {b: sorted(os.listdir(f"{out}/{b}")) for b in os.listdir(out) if b.startswith("_bucket=")}
    merge_buckets(spark, root, spark.createDataFrame([(3, 2), (1000, 1)], "k long, v int"), ["k"], keep_last, "r1")
    touched = {str(r[0]) for r in spark.createDataFrame([(3,), (1000,)], "k long").select(bucket_of(["k"], 16)).collect()}
    second = files_of(root, spark)
    assert {b for b in first if first[b] != second[b]} == touched
    got = publish(spark, root, out, ["k"])
    assert got.count() == 201 and got.filter("k = 3").first().v == 2
    assert {b for b in published if sorted(os.listdir(f"{out}/{b}")) != published[b]} == {f"_bucket={b}" for b in touched}
    # no changes: no version; a column that a merge adds; a bucket that a merge empties
    assert merge_buckets(spark, root, rows.limit(0), ["k"], keep_last, "r2").n == 1
    merge_buckets(spark, root, rows.filter("k = 5").withColumns({"v": F.lit(9), "note": F.lit("x")}), ["k"], keep_last, "r3")
    assert {r.note for r in read_current(spark, root).collect()} == {"x", None} and read_current(spark, root).count() == 201
    only = [r.k for r in rows.filter(bucket_of(["k"], 16) == 7).collect()]
    merge_buckets(spark, root, rows.filter(F.col("k").isin(only)), ["k"], lambda old, new: old.limit(0), "r4")
    left = read_current(spark, root).count()
    assert left == publish(spark, root, out, ["k"]).count() and left <= 201 - len(only)


def test_deltas_without_a_key_or_a_date_are_held(spark, tmpdir_path):
    root, lake = f"{tmpdir_path}/in", f"{tmpdir_path}/lake"
    spark.createDataFrame([("T1", 80.0), ("T2", 70.0)], "transformer_id string, score double").write.parquet(f"{root}/snap")
    rows = [("T1", 60.0, "2025-05-01"), (None, 1.0, "2025-05-01"), (" ", 1.0, "2025-05-01"), ("T2", 2.0, None)]
    deltas = spark.createDataFrame(rows, "transformer_id string, score double, record_effective_date string")
    deltas.write.parquet(f"{root}/delta")
    counts = []
    for i in range(3):
        r = run_pipeline(spark, Sources(transformer_snapshot=f"{root}/snap", transformer_delta=f"{root}/delta"), lake, "FULL", batch_id=f"b{i}")
        counts.append((spark.read.parquet(r.tables["silver.dim_transformer"]).count(), spark.read.parquet(r.tables["silver.dim_transformer_quarantine"]).count()))
    assert counts == [(3, 3)] * 3
    dim = read_current(spark, f"{lake}/silver/dim_transformer_versions")
    assert sorted(map(str, apply_deltas(dim, deltas).collect())) == sorted(map(str, dim.collect()))


def test_an_incremental_run_reads_new_bronze_files_only(spark, tmpdir_path):
    src, both = f"{tmpdir_path}/land", f"{tmpdir_path}/both"
    one = [_meter(i, 1.0 + i) for i in range(12)]
    two = [_meter(i, 50.0 + i) for i in (3, 4)] + [_meter(i, 2.0) for i in range(20, 25)] + [_meter(9, 1.0, eid="")]
    _jsonl(f"{src}/a.json", one)
    run_pipeline(spark, Sources(smart_meter=src), f"{tmpdir_path}/lake", "INCR", batch_id="b1")
    seen = []
    real = pipeline.typed_meters

    def spied(rows, *a, **k):
        seen.extend(rows.inputFiles())
        return real(rows, *a, **k)

    pipeline.typed_meters = spied
    try:
        _jsonl(f"{src}/b.json", two)
        r = run_pipeline(spark, Sources(smart_meter=src), f"{tmpdir_path}/lake", "INCR", batch_id="b2")
        assert seen and all("/_run=run-b2/" in f for f in seen)
        seen.clear()
        run_pipeline(spark, Sources(smart_meter=src), f"{tmpdir_path}/lake", "INCR", batch_id="b3")
        assert not seen                                                     # nothing new
    finally:
        pipeline.typed_meters = real
    _jsonl(f"{both}/a.json", one)
    run_pipeline(spark, Sources(smart_meter=both), f"{tmpdir_path}/full", "FULL", batch_id="b1")
    _jsonl(f"{both}/b.json", two)
    f = run_pipeline(spark, Sources(smart_meter=both), f"{tmpdir_path}/full", "FULL", batch_id="b2")
    get = lambda x: sorted(map(tuple, spark.read.parquet(x.tables["silver.smart_meter_readings"])
                               .select("event_id", "kwh_consumed", "is_kwh_anomaly", "anomaly_type").collect()))
    assert get(r) == get(f) and len(get(r)) == 17
    assert spark.read.parquet(r.tables["silver.smart_meter_quarantine"]).count() == 1
    metrics = {(m[1], m[2]): m[3] for m in r.metrics}
    assert metrics["silver.smart_meter_readings", "rowcount"] == "17" and ("silver.smart_meter_readings", "max_ts") in metrics


def test_contracts_fail_before_any_job(spark, tmpdir_path):
    bad = spark.createDataFrame([("x", "2025-05-01")], "transformer string, record_effective_date string")
    dim = spark.createDataFrame([("T", 1, True)], "transformer_id string, scd_version int, is_current boolean")
    jobs = lambda: len(spark.sparkContext.statusTracker().getJobIdsForGroup(None))
    before = jobs()
    with pytest.raises(ValueError, match="transformer_id"):
        apply_deltas(dim, bad)
    with pytest.raises(ValueError, match="transaction_id"):
        pipeline.silver_billing(bad)
    with pytest.raises(ValueError, match="region"):
        pipeline.typed_meters(spark.createDataFrame([("e", "m", "t")], "event_id string, meter_id string, timestamp string"))
    assert jobs() == before


def test_a_write_reports_what_it_wrote(spark, tmpdir_path):
    rows = spark.range(10).select("id", F.timestamp_seconds("id").alias("ts"))
    seen = observed_write(rows, lambda df: df.write.parquet(f"{tmpdir_path}/t"), "ts")
    assert (seen["rows"], seen["max_ts"].second) == (10, 9)
    assert observed_write(rows.limit(0), lambda df: df.write.parquet(f"{tmpdir_path}/u"), "ts") == {"rows": 0, "min_ts": None, "max_ts": None}


@pytest.mark.parametrize("buckets", [8, 64])
def test_a_merge_and_its_change_feed_are_one_write(spark, tmpdir_path, monkeypatch, buckets):
    from voltaic.operators.merge import snapshot_diff
    from voltaic.plans import tables
    root, real, seen = f"{tmpdir_path}/t", tables.write_table, []

    def spied(df, path, *a, **k):
        seen.append((k["repartition_by_partitions"], "_change_type" in df.columns))
        return real(df, path, *a, **k)

    monkeypatch.setattr(tables, "write_table", spied)
    keep_last = lambda old, new: dedup_latest(new if old is None else old.unionByName(new), ["k"], [F.col("v").desc()])
    shown = lambda rows: rows.filter("v % 5 <> 0")
    first = spark.createDataFrame([(i, i % 7) for i in range(60)], "k long, v int")
    more = spark.createDataFrame([(i, i % 11 + 1) for i in range(30, 90)], "k long, v int")
    states = [first.limit(0)]
    for i, rows in enumerate((first, more, more.limit(0).union(more.filter("k = 89")))):        # the last one changes nothing
        merge_buckets(spark, root, rows, ["k"], keep_last, f"r{i}", buckets=buckets, feed_keys=["k"], visible=shown)
        states.append(spark.createDataFrame(read_current(spark, root).collect(), first.schema))
    assert seen == [(buckets > 16, True)] * 3                  # no second shuffle of few buckets; the feed is in the same job
    got = sorted(map(str, (tuple(r) for r in read_changes(spark, root).collect())))
    want = [str((*r, i)) for i in range(3) for r in snapshot_diff(shown(states[i]), shown(states[i + 1]), ["k"]).collect()]
    assert got == sorted(want) and {r._commit_version for r in read_changes(spark, root).collect()} >= {0, 1}
    assert read_current(spark, root).columns == ["k", "v"]


def shuffle_files(spark):
    dirs = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {f for top in dirs for _, _, names in os.walk(top.getPath()) for f in names if f.startswith("shuffle_")}


def left_over(spark, before):
    """Shuffle files that are there beside those of before, given some seconds to go."""
    for _ in range(50):
        if not (more := shuffle_files(spark) - before):
            break
        time.sleep(0.2)
    return more


@pytest.mark.parametrize(("buckets", "size"), [(4, 1), (20, 10_000)])
def test_a_merge_in_steps_gives_the_same_rows_and_feed_and_leaves_no_shuffle_files(spark, tmpdir_path, monkeypatch, buckets, size):
    from voltaic.plans import tables
    keep_last = lambda old, new: dedup_latest(new if old is None else old.unionByName(new, allowMissingColumns=True), ["k"], [F.col("v").desc()])
    shown = lambda rows: rows.filter("v % 5 <> 0")
    first = spark.createDataFrame([(i, i % 7) for i in range(60)] + [(None, 3), (None, 3), (7, 0)], "k long, v int")
    more = spark.createDataFrame([(i, i % 11 + 1, "x") for i in range(30, 90)] + [(None, 4, None)], "k long, v int, note string")
    few = spark.createDataFrame([(3, 9), (200, 1)], "k long, v int")
    real, stored = tables.write_table, {}

    def spied(df, path, *a, **k):
        before = shuffle_files(spark)
        out = real(df, path, *a, **k)
        assert not left_over(spark, before)                # gone before the next step begins
        return out

    def run(root):
        writes = []
        monkeypatch.setattr(tables, "write_table", lambda df, path, *a, **k: writes.append(path) or spied(df, path, *a, **k))
        for i, rows in enumerate((first, more, few)):
            before = shuffle_files(spark)
            merge_buckets(spark, root, rows, ["k"], keep_last, f"r{i}", buckets=buckets, feed_keys=["k"], visible=shown)
            assert not left_over(spark, before)
        stored[root] = [sorted(str(tuple(r)) for r in df.collect()) for df in (read_current(spark, root), read_changes(spark, root))]
        return len(writes), set(current_version(spark, root).parts)

    assert run(f"{tmpdir_path}/whole") == (3, {str(b) for b in range(buckets)})
    monkeypatch.setattr(tables, "STEP_BYTES", size)
    writes, parts = run(f"{tmpdir_path}/steps")
    assert 5 < writes <= 2 * buckets + 2 and len(parts) == buckets
    assert stored[f"{tmpdir_path}/whole"] == stored[f"{tmpdir_path}/steps"]
    assert len(stored[f"{tmpdir_path}/steps"][0]) == 92    # keys 0 to 89, 200 and null


def test_steps_of_a_merge_are_as_large_as_their_buckets_allow(spark, tmpdir_path, monkeypatch):
    from voltaic.plans import tables
    base = tables.Version(0, 0, 0, "t", tmpdir_path, 8, "{}", {}, [])
    for b, size in (("0", 40), ("1", 70), ("10", 500), ("2", 10)):
        os.makedirs(f"{tmpdir_path}/{b}")
        with open(f"{tmpdir_path}/{b}/f", "wb") as f:
            f.write(b"x" * size)
        base.parts[b] = f"{tmpdir_path}/{b}"
    monkeypatch.setattr(tables, "STEP_BYTES", 100)
    touched = {"10": 1, "2": 1, "0": 1, "1": 1, "11": 1}   # a change takes 10 bytes; bucket 11 is new
    assert tables._steps(spark, base, touched, 50) == [["0"], ["1", "2"], ["10"], ["11"]]
    assert tables._steps(spark, None, touched, 50) == [["0", "1", "2", "10", "11"]]
