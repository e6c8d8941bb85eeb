"""Physical-plan properties the design relies on at scale (checked on sf0.001 plans)."""

import re

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def formatted(df) -> str:
    jvm = df.sparkSession.sparkContext._jvm
    return jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_latest_per_key_limits_before_the_shuffle(spark):
    from voltaic.operators.dedup import dedup_latest
    df = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    p = plan(dedup_latest(df, ["l_orderkey", "l_linenumber"], [F.col("l_shipdate").desc()]))
    partial = p.index("WindowGroupLimit") if "Partial" in p else -1
    assert re.search(r"WindowGroupLimit .*Partial", p), p
    # the partial limit sits below (after, in text order) the exchange: rows are cut map-side
    assert p.rfind("Exchange hashpartitioning") < p.rfind("Partial") and partial >= 0


def test_building_a_batch_query_runs_no_job_and_writes_nothing(spark, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame

    from voltaic.plans import bindings

    def forbidden(*_, **__):
        raise AssertionError("an action while the plan is built")

    for name in ("collect", "count", "first", "take", "toPandas", "toArrow", "checkpoint", "cache", "persist"):
        monkeypatch.setattr(DataFrame, name, forbidden)
    monkeypatch.setattr(DataFrame, "write", property(forbidden))
    for name, query in bindings.queries().items():
        if name not in bindings.EAGER:
            assert query(spark, SF_SMALL).columns, name


def test_cdc_apply_joins_only_the_touched_keys(spark):
    from voltaic.operators import merge
    from voltaic.operators.dedup import cdc_latest
    ddl = "transaction_id string, `__$operation` int, cdc_ts timestamp, amount double"
    target = spark.read.parquet(f"{SF_SMALL}/orders.parquet").selectExpr(
        "cast(o_orderkey as string) transaction_id", "2 as `__$operation`", "cast(o_orderdate as timestamp) cdc_ts",
        "o_totalprice amount")
    changes = spark.createDataFrame([("1", 1, None, None), ("2", 4, None, 5.0)], ddl)
    out = merge.cdc_apply(target, cdc_latest(changes))
    assert "LeftAnti" in plan(out)
    assert out.count() == target.filter("transaction_id not in ('1', '2')").count() + 1


def test_scan_pruning_and_pushdown(spark):
    from voltaic.plans import bindings
    f = formatted(bindings.q_hour_bucket(spark, SF_SMALL))
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in f
    _, later = bindings.cdc_target_and_changes(spark, SF_SMALL)     # split filter applied before the window
    f = formatted(later)
    assert re.search(r"PushedFilters: \[.*GreaterThanOrEqual\(l_shipdate", f), f


def test_referential_integrity_pre_aggregates_the_child(spark):
    from voltaic.plans import bindings
    p = plan(bindings.q_referential_integrity(spark, SF_SMALL))
    assert "partial_count" in p
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_dq_samples_are_bounded_per_rule(spark):
    from voltaic.plans import bindings
    p = plan(bindings.q_dq_samples(spark, SF_SMALL))
    assert re.search(r"WindowGroupLimit \[rule_name.*Partial", p), p


@pytest.mark.parametrize("name", ["q_usage_hourly", "q_ops_daily", "q_scd2_apply", "q_dq_report", "q_health_hourly",
                                  "q_snapshot_diff", "q_billing_mismatch", "q_join_coverage"])
def test_no_python_in_the_hot_path_and_no_cross_products(spark, name):
    import __spark_entry__ as E
    p = plan(E.queries()[name](spark, SF_SMALL))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "CartesianProduct",
                "BroadcastNestedLoopJoin"):
        assert bad not in p, (name, bad)


def test_thresholds_are_looked_up_without_a_shuffle_of_the_readings_by_region(spark):
    from voltaic.operators.anomaly import score_meter_anomaly
    df = spark.createDataFrame([(i % 3, f"r{i % 2}" if i % 5 else None, float(i)) for i in range(40)], "event_id long, region string, kwh_consumed double")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")             # no table is small enough by itself
    try:
        scored = score_meter_anomaly(df)
        p = plan(scored)
        assert "hashpartitioning(region" not in p and "SortMergeJoin" not in p, p
        assert scored.count() == 40 and scored.filter("region is null and is_kwh_anomaly is null").count() == 8
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_change_files_of_a_delivery_grow_in_number_not_in_size(spark, tmpdir_path, monkeypatch):
    import os

    from voltaic import session
    from voltaic.plans import bindings
    from voltaic.plans.tables import current_version
    monkeypatch.setattr(session, "shared_dir", lambda *_, **__: f"{tmpdir_path}/cdc")
    monkeypatch.setattr(bindings, "CDC_FILE_BYTES", os.path.getsize(f"{SF_SMALL}/lineitem.parquet") // 8 + 1)
    got = bindings.q_cdc_stream(spark, SF_SMALL)
    assert len([f for f in os.listdir(f"{tmpdir_path}/cdc/landing") if f.endswith(".parquet")]) == 8
    assert current_version(spark, f"{tmpdir_path}/cdc/state").version == 3     # four deliveries still
    want = bindings.merge.cdc_upserts(bindings.cdc_latest(bindings.cdc_feed(spark, SF_SMALL), bindings.CDC_KEY)).select(*got.columns)
    assert got.count() == want.count() and got.exceptAll(want).isEmpty()


def test_the_feed_of_a_mart_stream_is_computed_once(spark, monkeypatch):
    from voltaic.plans import bindings

    class Seen(Exception):
        pass

    def spied(rows, ts):
        raise Seen(plan(rows))

    monkeypatch.setattr(bindings, "_slices", spied)
    with pytest.raises(Seen) as seen:
        bindings.q_health_hourly_stream(spark, SF_SMALL)
    assert "FileScan" in str(seen.value) and "Window" not in str(seen.value) and "Exchange" not in str(seen.value)


def test_a_stream_of_changes_leaves_no_shuffle_files_and_stores_them_small(spark, tmpdir_path, monkeypatch):
    import glob
    import os

    from test_buckets import left_over, shuffle_files

    from voltaic import session
    from voltaic.plans import bindings, tables
    from voltaic.plans.tables import read_changes
    monkeypatch.setattr(session, "shared_dir", lambda *_, **__: f"{tmpdir_path}/cdc")
    monkeypatch.setattr(tables, "STEP_BYTES", 64 * 1024, raising=False)
    before = shuffle_files(spark)
    got = bindings.q_cdc_stream(spark, SF_SMALL)
    assert not left_over(spark, before)
    want = bindings.merge.cdc_upserts(bindings.cdc_latest(bindings.cdc_feed(spark, SF_SMALL), bindings.CDC_KEY)).select(*got.columns)
    assert got.count() == want.count() and got.exceptAll(want).isEmpty()
    changes = read_changes(spark, f"{tmpdir_path}/cdc/state")                  # all four epochs' changes add up to the live rows
    sums = {r[0]: r[1] for r in changes.groupBy("_change_type").count().collect()}
    assert sums["insert"] - sums["delete"] == got.count() and changes.select("_commit_version").distinct().count() == 4
    for part in ("landing", "state/v=*/data/*"):
        files = glob.glob(f"{tmpdir_path}/cdc/{part}/*.parquet")
        assert files and all(f.endswith(".zstd.parquet") for f in files)
    landed = spark.read.parquet(f"{tmpdir_path}/cdc/landing")
    feed = bindings.cdc_feed(spark, SF_SMALL)
    assert landed.count() == feed.count() and landed.exceptAll(feed).isEmpty()
    assert len([f for f in os.listdir(f"{tmpdir_path}/cdc/landing") if f.endswith(".parquet")]) == 4
