"""Literal-row cases for dedup, CDC apply, SCD2 and snapshot diff."""

import datetime as dt

from pyspark.sql import functions as F

from voltaic.operators import merge
from voltaic.operators.dedup import cdc_latest, dedup_latest, split_key_validity
from conftest import rows

CDC_DDL = ("`__$start_lsn` string, `__$seqval` string, `__$operation` int, `__$command_id` int, "
           "transaction_id string, total_amount double, cdc_ts timestamp, _ingestion_ts timestamp")
T0 = dt.datetime(2025, 6, 15, 10, 0)
T1 = dt.datetime(2025, 6, 15, 11, 0)


def test_dedup_latest_total_order_and_identical_rows(spark):
    df = spark.createDataFrame([("e1", T0, "a"), ("e1", T0, "b"), ("e1", T0, "b"), ("e2", T1, "x")],
                               "event_id string, _ingestion_ts timestamp, v string")
    one = dedup_latest(df, ["event_id"], [F.col("_ingestion_ts").desc()])
    again = dedup_latest(df.repartition(5), ["event_id"], [F.col("_ingestion_ts").desc()])
    assert rows(one) == rows(again)            # tie broken the same way whatever the partitioning
    assert len(rows(one)) == 2


def test_split_key_validity_keeps_null_keys_apart(spark):
    df = spark.createDataFrame([("a", 1), (None, 2), (" ", 3), (None, 4)], "event_id string, v int")
    valid, bad = split_key_validity(df, ["event_id"])
    assert rows(valid, "v") == [(1,)]
    assert rows(bad, "v") == [(2,), (3,), (4,)]   # not collapsed into one row


def test_cdc_before_after_tie_keeps_after_image(spark):
    # before (3) and after (4) image share lsn, seqval and time: the update must win
    df = spark.createDataFrame([
        ("00000000000A", "00000000000B", 3, 1, "t1", 100.0, T0, T0),
        ("00000000000A", "00000000000B", 4, 1, "t1", 150.0, T0, T0),
    ], CDC_DDL)
    assert rows(cdc_latest(df), "`__$operation`", "total_amount") == [(4, 150.0)]


def test_cdc_apply_cases(spark):
    target = spark.createDataFrame([
        ("0", "0", 2, 1, "keep", 1.0, T0, T0),
        ("0", "0", 2, 1, "upd", 2.0, T0, T0),
        ("0", "0", 2, 1, "del", 3.0, T0, T0),
        ("0", "0", 2, 1, None, 9.0, T0, T0),
    ], CDC_DDL)
    changes = spark.createDataFrame([
        ("1", "1", 4, 1, "upd", 20.0, T1, T1),      # update replaces all columns
        ("1", "1", 1, 1, "del", None, T1, T1),      # delete
        ("1", "1", 1, 1, "ghost", None, T1, T1),    # delete of unknown key: no-op
        ("1", "1", 2, 1, "ins", 5.0, T0, T1),       # insert then delete -> gone
        ("2", "2", 1, 1, "ins", None, T1, T1),
        ("1", "1", 1, 1, "back", None, T0, T1),     # delete then insert -> present
        ("2", "2", 2, 1, "back", 7.0, T1, T1),
        ("1", "1", 2, 1, None, 8.0, T1, T1),        # NULL key never matches; inserted
    ], CDC_DDL)
    latest = cdc_latest(changes)
    out = merge.cdc_apply(target, latest)
    assert rows(out, "transaction_id", "total_amount") == [
        ("back", 7.0), ("keep", 1.0), ("upd", 20.0), (None, 8.0), (None, 9.0)]
    # second run of the same changes: every keyed row is unchanged (idempotent); a NULL-key
    # upsert never matches, so MERGE semantics insert it again
    second = merge.cdc_apply(out, latest)
    assert rows(second.filter("transaction_id is not null"), "transaction_id", "total_amount") == \
        rows(out.filter("transaction_id is not null"), "transaction_id", "total_amount")
    assert second.filter("transaction_id is null").count() == 3
    # empty change set leaves the target untouched
    empty = spark.createDataFrame([], changes.schema)
    assert rows(merge.cdc_apply(target, cdc_latest(empty))) == rows(target)


DIM_DDL = ("id int, name string, score double, record_effective_date date, record_end_date date, "
           "is_current boolean, scd_version int")
D_OPEN = dt.date(9999, 12, 31)


def _dim(spark):
    return spark.createDataFrame([
        (1, "a", 1.0, dt.date(2024, 1, 1), dt.date(2024, 12, 31), False, 1),   # history
        (1, "a", 2.0, dt.date(2025, 1, 1), D_OPEN, True, 2),
        (2, "b", None, dt.date(2025, 1, 1), D_OPEN, True, 1),
        (3, "c", 3.0, dt.date(2025, 1, 1), D_OPEN, True, 1),
    ], DIM_DDL)


def _delta(spark):
    return spark.createDataFrame([
        (1, "a", 5.0, "2025-06-01", "9999-12-31", True),   # changed
        (2, "b", 4.0, "2025-06-01", "9999-12-31", True),   # NULL -> value is a change
        (3, "c", 3.0, "2025-06-01", "9999-12-31", True),   # unchanged
        (4, "d", 1.0, "2025-06-01", "9999-12-31", True),   # new key
    ], "id int, name string, score double, record_effective_date string, record_end_date string, is_current boolean")


def test_scd2_apply_cases(spark):
    out = merge.scd2_apply(_dim(spark), _delta(spark), ["id"])
    got = rows(out, "id", "score", "record_end_date", "is_current", "scd_version")
    assert got == [
        (1, 1.0, dt.date(2024, 12, 31), False, 1),
        (1, 2.0, dt.date(2025, 5, 31), False, 2),
        (1, 5.0, D_OPEN, True, 3),
        (2, 4.0, D_OPEN, True, 2),
        (2, None, dt.date(2025, 5, 31), False, 1),
        (3, 3.0, D_OPEN, True, 1),
        (4, 1.0, D_OPEN, True, 1),
    ]
    # same delta twice: no-op (no second current version)
    twice = merge.scd2_apply(out, _delta(spark), ["id"])
    assert rows(twice) == rows(out)
    assert out.filter("is_current").groupBy("id").count().filter("count > 1").count() == 0


def test_scd2_documented_variant(spark):
    out = merge.scd2_apply(_dim(spark), _delta(spark), ["id"], compare_cols=["name"], end_offset_days=0,
                           insert_new_versions=False)
    # only names are compared -> nothing changed; new key still inserted
    assert rows(out.filter("is_current"), "id", "scd_version") == [(1, 2), (2, 1), (3, 1), (4, 1)]


def test_scd2_next_version_and_baseline(spark):
    nv = merge.scd2_next_version(_delta(spark), _dim(spark), ["id"])
    assert rows(nv, "id", "scd_version") == [(1, 3), (2, 2), (3, 2), (4, 1)]
    base = merge.scd2_baseline(spark.createDataFrame([(1,)], "id int")).first()
    assert (base.record_effective_date, base.record_end_date, base.is_current, base.scd_version) == (
        dt.date(1900, 1, 1), D_OPEN, True, 1)


def test_snapshot_diff(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "k int, v string")
    new = spark.createDataFrame([(1, "a"), (3, "c"), (4, "d")], "k int, v string")
    got = rows(merge.snapshot_diff(old, new, ["k"]), "k", "v", "_change_type")
    assert got == [(2, "b", "delete"), (3, "c", "update_postimage"), (3, None, "update_preimage"), (4, "d", "insert")]


def test_fallback_key(spark):
    from voltaic.operators.dedup import with_fallback_key
    df = spark.createDataFrame([("e1", "m1", "t1"), (None, "m1", "t1"), (" ", "m2", None), (None, None, None)],
                               "event_id string, meter_id string, event_ts string")
    got = [r._dedup_key for r in with_fallback_key(df, "event_id", ["meter_id", "event_ts"]).collect()]
    assert got == ["e1", "m1|t1", "m2|", None]


def test_silver_meters_fallback_key(spark):
    from voltaic.plans.pipeline import silver_meters
    rows_in = [("e1", "m1", "2025-06-15T10:00:00Z", 1.0, "N", T0, "f1"),
               (None, "m1", "2025-06-15T11:00:00Z", 2.0, "N", T0, "f1"),
               (None, "m1", "2025-06-15T11:00:00Z", 2.0, "N", T1, "f2"),     # same meter+time: one reading
               (None, None, None, 3.0, "N", T0, "f1")]                        # nothing to key on
    df = spark.createDataFrame(rows_in, "event_id string, meter_id string, timestamp string, reading_kwh double, "
                                        "region string, _ingestion_ts timestamp, _source_file string")
    kept, bad = silver_meters(df, fallback_key=True)
    assert kept.count() == 2 and bad.count() == 1
    plain_kept, plain_bad = silver_meters(df)
    assert plain_kept.count() == 1 and plain_bad.count() == 3
