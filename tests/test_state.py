"""Versioned state, dated deltas, quarantine, feeds with changing columns: nothing is lost."""

import datetime as dt
import math
import os

import pytest
from pyspark.sql import functions as F

from voltaic.operators import marts, merge
from voltaic.operators.anomaly import add_counts, exact_percentiles, slice_counts
from voltaic.plans.pipeline import Sources, apply_deltas, run_pipeline, silver_renewable
from voltaic.plans.tables import read_current, read_if_present, write_version
from voltaic.sources.ingest import read_csv_feed
from voltaic.schemas import MAINTENANCE_SCHEMA

OPEN = dt.date(9999, 12, 31)


def test_a_retry_with_the_same_tag_reads_what_it_replaces(spark, tmpdir_path):
    table = f"{tmpdir_path}/t"
    assert read_current(spark, table) is None
    write_version(spark, spark.range(3), table, "b1")
    for _ in range(3):
        write_version(spark, read_current(spark, table).selectExpr("id + 1 as id"), table, "b2")
    assert sorted(r.id for r in read_current(spark, table).collect()) == [3, 4, 5]
    assert len([f for f in os.listdir(table) if f.startswith("v=")]) == 2                    # old versions are pruned


def test_a_read_error_is_no_missing_table(spark, tmpdir_path):
    assert read_if_present(lambda: spark.read.parquet(f"{tmpdir_path}/none")) is None
    os.makedirs(f"{tmpdir_path}/bad")
    with open(f"{tmpdir_path}/bad/part-0.parquet", "w") as f:
        f.write("not parquet")
    with pytest.raises(Exception):
        read_if_present(lambda: spark.read.parquet(f"{tmpdir_path}/bad").limit(1).count())


def _dim(spark, rows):
    return merge.scd2_baseline(spark.createDataFrame(rows, "transformer_id string, score double, status string"))


def test_dated_deltas_in_order_keep_every_version_and_column(spark):
    dim = _dim(spark, [("T1", 80.0, "ok"), ("T2", 50.0, "ok")])
    deltas = spark.createDataFrame([("T1", 60.0, "2025-06-01", "9999-12-31", "x"), ("T1", 70.0, "2025-05-01", "9999-12-31", None),
                                    ("T3", 1.0, "2025-05-01", "9999-12-31", "y")],
                                   "transformer_id string, score double, record_effective_date string, record_end_date string, note string")
    out = apply_deltas(dim, deltas)
    t1 = [tuple(r) for r in out.filter("transformer_id = 'T1'").orderBy("scd_version")
          .select("score", "status", "note", "record_end_date", "is_current").collect()]
    assert t1 == [(80.0, "ok", None, dt.date(2025, 4, 30), False), (70.0, "ok", None, dt.date(2025, 5, 31), False),
                  (60.0, "ok", "x", OPEN, True)]
    again = apply_deltas(out, deltas)
    assert sorted(map(str, again.collect())) == sorted(map(str, out.collect()))


def test_full_runs_keep_the_dimension_and_the_bills(spark, tmpdir_path):
    root, lake = f"{tmpdir_path}/in", f"{tmpdir_path}/lake"
    ddl = "transformer_id string, region string, score double, record_effective_date string, record_end_date string"
    spark.createDataFrame([("T1", "N", 80.0, "2025-01-01", "9999-12-31")], ddl).withColumns(
        {"is_current": F.lit(True), "scd_version": F.lit(1)}).write.parquet(f"{root}/snap")

    def bills(rows):
        table = spark.createDataFrame(rows, "`__$operation` int, transaction_id string, total_amount double, cdc_timestamp string")
        table.coalesce(1).write.mode("append").json(f"{root}/bills")

    bills([(2, "a", 1.0, "2025-01-01T00:00:00Z"), (2, None, 5.0, "2025-01-01T00:00:00Z"), (2, " ", 6.0, "2025-01-01T00:00:00Z")])
    counts = []
    for k, (day, score) in enumerate([("2025-05-01", 70.0), ("2025-06-01", 60.0)]):
        spark.createDataFrame([("T1", "N", score, day, "9999-12-31")], ddl).write.mode("overwrite").parquet(f"{root}/delta")
        r = run_pipeline(spark, Sources(transformer_snapshot=f"{root}/snap", transformer_delta=f"{root}/delta", billing_cdc=f"{root}/bills"),
                         lake, "FULL", batch_id="same")
        counts.append(spark.read.parquet(r.tables["silver.dim_transformer"]).count())
        assert spark.read.parquet(r.tables["silver.billing_quarantine"]).count() == 2
        bills([(1, "a", None, "2025-02-01T00:00:00Z"), (2, "b", 2.0, "2025-02-01T00:00:00Z")] if not k else [])
    assert counts == [2, 3]
    assert [r.transaction_id for r in spark.read.parquet(r.tables["silver.billing_transactions_current"]).collect()] == ["b"]


def test_renewable_rows_without_an_id_are_kept_apart(spark):
    rows = spark.createDataFrame([(None, 1.0), (None, 2.0), (" ", 3.0), ("r", 4.0)], "reading_id string, production_mw double")
    rows = rows.withColumns({"_ingestion_ts": F.current_timestamp(), "_source_file": F.lit("renewable_production_20250101_0100.json")})
    good, held = silver_renewable(rows)
    assert (good.count(), held.count()) == (1, 3)


def test_csv_files_keep_their_own_header(spark, tmpdir_path):
    for name, text in {"a": "log_id,transformer_id,cost_inr\nL1,TRF-1,10.5\n", "b": "log_id,cost_inr,transformer_id\nL2,20.5,TRF-2\n",
                       "c": "log_id,transformer_id,cost_inr,extra\nL3,TRF-3,30.5,e\n"}.items():
        with open(f"{tmpdir_path}/{name}.csv", "w") as f:
            f.write(text)
    got = {r.log_id: (r.transformer_id, r.cost_inr, r.extra) for r in read_csv_feed(spark, tmpdir_path, MAINTENANCE_SCHEMA).collect()}
    assert got == {"L1": ("TRF-1", 10.5, None), "L2": ("TRF-2", 20.5, None), "L3": ("TRF-3", 30.5, "e")}


@pytest.mark.parametrize("values,want", [([4e-7] * 1000, 4e-4), ([1.0, math.nan], math.nan), ([1.0, math.inf], math.inf), ([None], None)])
def test_mart_sums_are_plain_sums(spark, values, want):
    hour = dt.datetime(2025, 1, 1)
    rows = [(hour, hour.date(), "m", "r", "s", v, 1.0, 1.0, 1.0) for v in values]
    ddl = "event_ts timestamp_ntz, event_date date, meter_id string, region string, state string, kwh_consumed double, voltage_v double, current_a double, power_factor double"
    got = marts.usage_hourly(spark.createDataFrame(rows, ddl)).first().kwh_total
    assert got is None if want is None else got == pytest.approx(want, nan_ok=True)


def test_percentiles_do_not_depend_on_partitioning_and_take_any_double(spark):
    values = [math.nan, math.inf, -math.inf, 0.0, -1e300, 1e300, 5e-324] + [i / 7 for i in range(-300, 300)]
    df = spark.createDataFrame([("g" if i % 3 else None, v) for i, v in enumerate(values)] + [("g", None)], "g string, v double")
    asked = {"lo": 0.01, "mid": 0.5, "hi": 0.99}
    runs = [sorted(map(str, exact_percentiles(df.repartition(n), "g", "v", asked).collect())) for n in (4, 64)]
    assert runs[0] == runs[1] and len(runs[0]) == 2
    known = sorted((v for i, v in enumerate(values) if i % 3), key=lambda v: (math.isnan(v), v))
    row = exact_percentiles(df, "g", "v", asked).filter("g = 'g'").first()
    assert [row.lo, row.mid] == [known[math.ceil(p * len(known)) - 1] for p in (0.01, 0.5)]


def test_bridge_lists_every_owner(spark):
    cust = spark.createDataFrame([("c1", "m"), ("c2", "m"), ("c3", None)], "customer_id string, meter_id string")
    assert sorted(map(tuple, marts.meter_customers(cust).collect())) == [("m", "c1"), ("m", "c2")]


def test_percentiles_where_all_values_crowd_in_one_slice(spark):
    """Distinct values within a millionth of each other, a third of them one value, in one of two groups."""
    crowd = spark.range(60_000).selectExpr("'g' as g", "case when id % 3 = 0 then 1.0000003d else 1d + id * 1e-12 end as v")
    rest = spark.range(999).selectExpr("cast(null as string) as g", "-pow(10, id % 300) as v")
    df = crowd.unionByName(rest)
    asked = {"p0": 0.0, "p1": 0.01, "mid": 0.5, "p99": 0.99, "top": 1.0}
    got = {r.g: r for r in exact_percentiles(df, "g", "v", asked).collect()}
    for g in ("g", None):
        known = sorted(r.v for r in df.filter(F.col("g").eqNullSafe(F.lit(g))).collect())
        assert [got[g][n] for n in asked] == [known[max(1, math.ceil(p * len(known))) - 1] for p in asked.values()]
    stored = add_counts(slice_counts(df.filter("v < 1"), "g", "v"), slice_counts(df.filter("v >= 1"), "g", "v"))
    again = {r.g: r for r in exact_percentiles(df, "g", "v", asked, stored).collect()}
    assert again == got
