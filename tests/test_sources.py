import os

from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltaic.schemas import MAINTENANCE_SCHEMA, SMART_METER_SCHEMA
from voltaic.session import cut_lineage
from voltaic.sources.ingest import add_ingestion_cols, read_csv_feed, read_json_feed, source_file_name


def test_csv_empty_cells_are_null_and_lineage_names_the_file(spark, tmpdir_path):
    os.makedirs(f"{tmpdir_path}/m")
    with open(f"{tmpdir_path}/m/maintenance_logs_2025_04.csv", "w") as f:
        f.write("log_id,transformer_id,reported_date,completed_date,hours_spent,parts_replaced,cost_inr\n"
                "ML-1,TRF-N-0001,2025-04-05,,,NONE,\nML-2,TRF-N-0002,2025-04-06,2025-04-07,3.5,OIL,1200.5\n")
    df = read_csv_feed(spark, f"{tmpdir_path}/m", MAINTENANCE_SCHEMA)
    df = add_ingestion_cols(df, "maintenance_csv", "b1").withColumn("file", source_file_name("_source_file"))
    rows = {r.log_id: r for r in df.collect()}
    assert rows["ML-1"].hours_spent is None and rows["ML-1"].completed_date is None
    assert rows["ML-1"].parts_replaced == "NONE"               # the literal string, not NULL
    assert rows["ML-2"].cost_inr == 1200.5
    assert rows["ML-2"].file == "maintenance_logs_2025_04.csv" and rows["ML-2"]._batch_id == "b1"
    inferred = read_csv_feed(spark, f"{tmpdir_path}/m")
    assert inferred.schema["hours_spent"].dataType == T.DoubleType()   # empty cells do not spoil inference


def test_json_feed_keeps_malformed_lines_visible(spark, tmpdir_path):
    os.makedirs(f"{tmpdir_path}/j")
    with open(f"{tmpdir_path}/j/a.json", "w") as f:
        f.write('{"event_id": "e1", "reading_kwh": 1.5}\n{not json\n')
    schema = T.StructType(SMART_METER_SCHEMA.fields + [T.StructField("_corrupt_record", T.StringType())])
    df = read_json_feed(spark, f"{tmpdir_path}/j", schema).cache()
    assert df.filter(F.col("_corrupt_record").isNotNull()).count() == 1
    assert df.filter(F.col("event_id") == "e1").first().reading_kwh == 1.5


def test_cut_lineage_round_trip(spark):
    df = spark.range(10).withColumn("x", F.col("id") * 2)
    cut = cut_lineage(df)
    assert sorted(r.x for r in cut.collect()) == list(range(0, 20, 2))
    assert "voltaic/lineage" in cut.inputFiles()[0]


def test_csv_stream_checks_headers(spark, tmpdir_path):
    from voltaic.sources.ingest import stream_csv_feed
    from voltaic.streaming.ingest import run_available_now
    os.makedirs(f"{tmpdir_path}/s")
    with open(f"{tmpdir_path}/s/a.csv", "w") as f:
        f.write("log_id,transformer_id\nML-1,TRF-1\n")
    schema = T.StructType([T.StructField("log_id", T.StringType()), T.StructField("transformer_id", T.StringType())])
    run_available_now(stream_csv_feed(spark, f"{tmpdir_path}/s", schema), f"{tmpdir_path}/o", f"{tmpdir_path}/c")
    assert [tuple(r) for r in spark.read.parquet(f"{tmpdir_path}/o").collect()] == [("ML-1", "TRF-1")]


def test_register_table_repoints_to_new_version(spark, tmpdir_path):
    from voltaic.plans.tables import ensure_database, read_current, register_current_view, register_table, write_version
    root = f"{tmpdir_path}/dim"
    v1 = write_version(spark, spark.createDataFrame([(1, True)], "k int, is_current boolean"), root, "b1")
    ensure_database(spark, "vt_silver", f"{tmpdir_path}/_catalog")
    register_table(spark, "vt_silver", "dim", v1)
    register_current_view(spark, "vt_silver", "dim")
    assert spark.table("vt_silver.dim_current").count() == 1
    v2 = write_version(spark, spark.createDataFrame([(1, False), (1, True), (2, True)], "k int, is_current boolean"),
                       root, "b2")
    assert read_current(spark, root).count() == 3
    register_table(spark, "vt_silver", "dim", v2)
    assert spark.table("vt_silver.dim").count() == 3
    assert spark.table("vt_silver.dim_current").count() == 2


def test_a_feed_is_looked_into_once_and_conflicts_keep_their_lines(spark, tmpdir_path):
    import json
    import os

    from voltaic.sources.ingest import evolve_feed
    land, loc = f"{tmpdir_path}/land", f"{tmpdir_path}/schema"
    os.makedirs(land)

    def put(name, *recs):
        with open(f"{land}/{name}.json", "w") as f:
            f.writelines(json.dumps(r) + "\n" for r in recs)

    put("a", {"id": "r1", "mw": 5, "at": {"lat": 1}})
    first = evolve_feed(spark, land, loc)
    os.chmod(f"{land}/a.json", 0)                                     # whoever reads it again may fail; the schema stays
    put("b", {"id": "r2", "mw": "five", "at": {"lat": 2.5, "lon": 3}, "tags": [1, "x"]}, {"id": "r3", "note": None})
    seen = []
    real = spark.read.__class__.json
    spark.read.__class__.json = lambda self, path, *a, **k: (seen.append(path), real(self, path, *a, **k))[1]
    try:
        second = evolve_feed(spark, land, loc)
        assert [[os.path.basename(p) for p in x] for x in seen if isinstance(x, list)] == [["b.json"]]
        seen.clear()
        assert evolve_feed(spark, land, loc) == second and not [x for x in seen if isinstance(x, list)]
    finally:
        spark.read.__class__.json = real
        os.chmod(f"{land}/a.json", 0o644)
    assert first["mw"].dataType.typeName() == second["mw"].dataType.typeName() == "double"
    assert second["at"].dataType.fieldNames() == ["lat", "lon"] and second["tags"].dataType.elementType.typeName() == "string"
    rows = {r.id: r for r in spark.read.schema(second).json(land).collect()}
    assert rows["r1"].mw == 5.0 and rows["r2"].mw is None and '"five"' in rows["r2"]._corrupt_record and rows["r2"]["at"].lon == 3.0


def test_type_lattice():
    from pyspark.sql import types as T

    from voltaic.sources.ingest import wider_type
    d, s = T.DoubleType(), T.StringType()
    assert wider_type(T.LongType(), d) == d and wider_type(T.IntegerType(), T.LongType()) == T.LongType()
    assert wider_type(T.NullType(), d) == d and wider_type(d, s) == s and wider_type(T.BooleanType(), d) == s
    a, b = T.StructType.fromDDL("x bigint, y string"), T.StructType.fromDDL("x double, z boolean")
    assert wider_type(a, b).simpleString() == "struct<x:double,y:string,z:boolean>"
    assert wider_type(T.ArrayType(T.LongType()), T.ArrayType(s)) == T.ArrayType(s)


def test_where_a_subscription_starts():
    import datetime as dt
    import json

    import pytest

    from voltaic.sources.ingest import bus_options
    noon = dt.datetime(2025, 1, 1, 12, tzinfo=dt.timezone.utc)
    assert bus_options("kafka", "latest", 500) == {"startingOffsets": "latest", "maxOffsetsPerTrigger": "500"}
    assert bus_options("kafka", noon)["startingTimestamp"] == "1735732800000"
    assert json.loads(bus_options("eventhubs")["eventhubs.startingPosition"])["offset"] == "-1"
    assert json.loads(bus_options("eventhubs", noon)["eventhubs.startingPosition"])["enqueuedTime"].startswith("2025-01-01T12:00")
    assert bus_options("json", per_trigger=2) == {"maxFilesPerTrigger": "2"}
    with pytest.raises(ValueError):
        bus_options("json", "latest")
