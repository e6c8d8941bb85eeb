import datetime as dt

import pytest
from pyspark.sql import functions as F

from voltaic.functions import columns as C
from voltaic.functions import scoring as S
from conftest import rows


def test_require_columns_fails_at_plan_time(spark):
    df = spark.createDataFrame([(1,)], "a int")
    C.require_columns(df, ["a"])
    with pytest.raises(ValueError, match="b"):
        C.require_columns(df, ["a", "b"])


def test_resolve_and_first_existing(spark):
    df = spark.createDataFrame([(1.5, 2.5)], "total_amount double, bill_amount double")
    assert C.resolve_column(df, ["amount_due", "amount", "total_amount", "bill_amount"]) == "total_amount"
    assert C.resolve_column(df, ["x", "y"]) is None
    got = df.select(C.first_existing(df, ["nope", "bill_amount"]).alias("v"),
                    C.first_existing(df, ["nope"], F.lit(0.0)).alias("d")).first()
    assert (got.v, got.d) == (2.5, 0.0)


def test_canonicalize_maps_feed_names_only_when_target_absent(spark):
    df = spark.createDataFrame([(1.0, 2.0)], "reading_kwh double, load_percentage double")
    assert sorted(C.canonicalize(df).columns) == ["kwh_consumed", "load_pct"]
    both = spark.createDataFrame([(1.0, 2.0)], "reading_kwh double, kwh_consumed double")
    assert C.canonicalize(both).columns == ["reading_kwh", "kwh_consumed"]


def test_parse_timestamp_is_lenient_under_ansi(spark):
    df = spark.createDataFrame([("2025-06-15T10:00:48.337Z",), ("not-a-time",), ("",), (None,), ("2025-06-15",)],
                               "timestamp string")
    out = C.with_event_time(df, "timestamp").collect()
    ts = [r.event_ts for r in out]
    assert ts[1] is None and ts[2] is None and ts[3] is None
    assert ts[0] == dt.datetime(2025, 6, 15, 10, 0, 48, 337000)
    assert out[4].event_date == dt.date(2025, 6, 15)
    assert "timestamp" not in C.with_event_time(df, "timestamp").columns


def test_hour_bucket_keeps_ntz(spark):
    df = spark.sql("select timestamp_ntz'2024-01-01 10:59:59' as ts")
    out = C.with_hour_bucket(df, "ts")
    assert out.schema["hour_ts"].dataType.typeName() == "timestamp_ntz"
    assert out.first().hour_ts == dt.datetime(2024, 1, 1, 10, 0)


def test_ts_from_filename(spark):
    df = spark.createDataFrame([("dbfs:/x/renewable_production_20250615_0900.json",), ("other.json",)], "f string")
    got = [r.t for r in df.select(C.ts_from_filename("f").alias("t")).collect()]
    assert got == [dt.datetime(2025, 6, 15, 9, 0), None]


def test_backfill_and_blank(spark):
    df = spark.createDataFrame([(" ",), (None,), ("x",)], "k string")
    assert [r.b for r in df.select(C.is_blank("k").alias("b")).collect()] == [True, True, False]
    out = C.backfill_columns(df, ["curtailment_mw", "k"])
    assert out.schema["curtailment_mw"].dataType.typeName() == "double"


def test_ratios_do_not_throw_on_zero(spark):
    df = spark.createDataFrame([(1, 0), (1, 2), (None, 2), (1, None)], "n int, d int")
    got = df.select(C.ratio(F.col("n"), F.col("d")).alias("r"), C.guarded_ratio(F.col("n"), F.col("d")).alias("g")).collect()
    assert [(r.r, r.g) for r in got] == [(None, 0.0), (0.5, 0.5), (None, None), (None, 0.0)]


def test_null_safe_change_detects_null_transitions(spark):
    df = spark.createDataFrame([(1, None), (None, 1), (None, None), (2, 2), (2, 3)], "a int, b int")
    t = df.select(F.struct(F.col("a").alias("x")).alias("t"), F.struct(F.col("b").alias("x")).alias("s"))
    got = [r.c for r in t.select(C.null_safe_changed(["x"], "t", "s").alias("c")).collect()]
    assert got == [True, True, False, False, True]


def test_null_safe_change_with_a_dot_in_the_name(spark):
    df = spark.sql("select named_struct('a.b', 1) as t, named_struct('a.b', 2) as s")
    assert df.select(C.null_safe_changed(["a.b"], "t", "s")).first()[0]


def test_rounded_touches_doubles_only(spark):
    r = C.rounded(spark.sql("select 1.00000049D as x, 3 as n, 'a' as s")).first()
    assert tuple(r) == (1.0, 3, "a")


def test_canonicalize_keeps_both_spellings(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, 3.0), (None, 4.0)], "reading_kwh double, kwh_consumed double")
    assert [r.kwh_consumed for r in C.canonicalize(df).collect()] == [1.0, 3.0, 4.0]


def test_risk_score_boundaries(spark):
    df = spark.createDataFrame([
        ("A", 50.0, 25.0, 800.0, 7.0, 90.0),      # all exactly on thresholds -> only alarm
        ("", 51.0, 25.0, 800.1, 7.1, 90.1),       # empty alarm -> 0; everything else raised
        (None, None, None, None, None, None),     # nulls raise nothing
    ], "alarm_code string, oil_temperature_c double, ambient_temperature_c double, dissolved_gas_ppm double, "
       "vibration_mm_s double, load_pct double")
    out = S.with_risk_score(df).collect()
    assert [(r.risk_alarm, r.risk_oil_temp, r.risk_score, r.risk_level) for r in out] == [
        (1, 0, 3, "MEDIUM"), (0, 1, 6, "HIGH"), (0, 0, 0, "LOW")]


def test_cdc_op_name_and_bands(spark):
    df = spark.createDataFrame([(1, 0.01), (2, 60.0), (3, 5.0), (4, None)], "op int, kwh double")
    got = df.select(S.cdc_op_name("op").alias("n"), S.band_anomaly(F.col("kwh")).alias("b")).collect()
    assert [(r.n, r.b) for r in got] == [("DELETE", "SUSPECTED_THEFT"), ("INSERT", "SPIKE"), (None, None), ("UPDATE", None)]


def test_size_for_input(spark):
    from voltaic.session import size_for_input
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        assert size_for_input(spark, 100 * 1024 ** 4) == 409600          # 100 TiB / 256 MiB
        assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == str(256 * 1024 ** 2)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.initialPartitionNum")


def test_a_local_scratch_folder_is_refused_on_a_cluster():
    from types import SimpleNamespace

    import pytest

    from voltaic.session import shared_base

    def session(master, **conf):
        return SimpleNamespace(conf=SimpleNamespace(get=lambda k, d=None: conf.get(k.replace(".", "_"), d)), sparkContext=SimpleNamespace(master=master))

    home = {"spark_sql_warehouse_dir": "file:/home/u/spark-warehouse"}
    assert shared_base(session("local[4]", **home)) == home["spark_sql_warehouse_dir"]
    assert shared_base(session("yarn", spark_checkpoint_dir="hdfs://n/c", **home)) == "hdfs://n/c"
    assert shared_base(session("yarn", spark_sql_warehouse_dir="s3a://b/w")) == "s3a://b/w"
    with pytest.raises(ValueError):
        shared_base(session("spark://n:7077", **home))
