"""Feed readers (S1-S15) and lineage columns.

Streams always get an explicit schema (file streams require one). Schema
evolution for JSON landing folders is "infer from the files that are new, merge with
what is known and with hints, persist, then stream with it": a restart after new columns appeared
picks them up.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltaic.plans.tables import exists
from voltaic.schemas import CORRUPT

__all__ = ["add_ingestion_cols", "source_file_name", "parse_envelope", "subscribe_stream", "read_json_feed",
           "read_csv_feed",
           "read_parquet_feed", "stream_json_feed", "stream_csv_feed", "merge_schema_hints",
           "evolve_schema", "evolve_feed", "wider_type", "bus_options", "save_schema", "load_schema", "new_files_only"]


def add_ingestion_cols(df: DataFrame, source_system: str, batch_id: str,
                       ingestion_ts: Column | None = None) -> DataFrame:
    """Lineage columns: ``_ingestion_ts``, ``_source_system``, ``_batch_id``, ``_source_file``.

    ``_source_file`` comes from the hidden ``_metadata.file_path`` of file
    sources (works for batch and streaming reads).
    """
    has_meta = True
    try:
        df.select("_metadata.file_path")
    except Exception:  # not a file source (e.g. literal rows)
        has_meta = False
    src = F.col("_metadata.file_path") if has_meta else F.lit(None).cast("string")
    return df.withColumns({
        "_ingestion_ts": ingestion_ts if ingestion_ts is not None else F.current_timestamp(),
        "_source_system": F.lit(source_system),
        "_batch_id": F.lit(batch_id),
        "_source_file": src,
    })


def source_file_name(col: Column | str = "_source_file") -> Column:
    """Base name of a file path column."""
    c = F.col(col) if isinstance(col, str) else col
    return F.regexp_extract(c, r"([^/]+)$", 1)


def parse_envelope(df: DataFrame, schema: T.StructType | str, value_col: str = "value",
                   keep: Sequence[str | Column] = ()) -> DataFrame:
    """Message-bus envelope to typed columns: ``from_json(CAST(value AS STRING))`` then ``d.*``.

    Works on any source that delivers a binary/string payload column (Kafka
    ``value``, Event Hubs ``body``) and on batch or streaming frames alike;
    ``keep`` carries broker metadata (e.g. its timestamp) alongside.
    """
    payload = F.from_json(F.col(value_col).cast("string"), schema).alias("__d")
    kept = [F.col(k) if isinstance(k, str) else k for k in keep]
    parsed = df.select(payload, *kept)
    return parsed.select("__d.*", *[c for c in parsed.columns if c != "__d"])


def bus_options(fmt: str, start: str | dt.datetime = "earliest", per_trigger: int | None = None) -> dict[str, str]:
    """Where a subscription starts and how much a micro-batch takes, as the options of a connector.

    ``start`` is ``earliest``, ``latest`` or a point in time: the first message at or after it, and the end of a
    partition that has none. It counts for a new query only; a restarted one continues from its checkpoint. Folders
    of files (``text``, ``json``, ``csv``, ``parquet``) are always read from their first file.
    """
    if fmt == "kafka":
        where = {"startingTimestamp": str(int(start.timestamp() * 1000)), "startingOffsetsByTimestampStrategy": "latest"} \
            if isinstance(start, dt.datetime) else {"startingOffsets": start}
        return where | ({"maxOffsetsPerTrigger": str(per_trigger)} if per_trigger else {})
    if fmt == "eventhubs":
        at = {"offset": None, "seqNo": -1, "isInclusive": True,
              "enqueuedTime": start.astimezone(dt.timezone.utc).strftime("%Y-%m-%dT%H:%M:%S.%fZ")} if isinstance(start, dt.datetime) else \
            {"offset": "-1" if start == "earliest" else "@latest", "seqNo": -1, "enqueuedTime": None, "isInclusive": True}
        return {"eventhubs.startingPosition": json.dumps(at)} | ({"maxEventsPerTrigger": str(per_trigger)} if per_trigger else {})
    if start != "earliest":
        raise ValueError(f"a {fmt} folder is read from its first file; start={start!r} is for message buses")
    return {"maxFilesPerTrigger": str(per_trigger)} if per_trigger else {}


def subscribe_stream(spark: SparkSession, fmt: str, options: dict[str, str], schema: T.StructType | str,
                     value_col: str = "value", keep: Sequence[str | Column] = ()) -> DataFrame:
    """Message-bus stream parsed into typed columns.

    ``fmt``/``options`` are handed to the source unchanged, so start position
    (``startingOffsets``), throttling (``maxOffsetsPerTrigger`` / ``maxFilesPerTrigger``)
    and subscription settings are the connector's own. The connector itself is
    supplied by the deployment (e.g. ``kafka`` with its package on the classpath).
    """
    raw = spark.readStream.format(fmt).options(**options).load()
    return parse_envelope(raw, schema, value_col, keep)


def read_json_feed(spark: SparkSession, path: str, schema: T.StructType | None = None,
                   glob: str | None = None) -> DataFrame:
    """Batch JSON lines; malformed lines go to ``_corrupt_record`` when the schema has it."""
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    if glob:
        r = r.option("pathGlobFilter", glob)
    return r.json(path)


def _files_by_header(spark: SparkSession, path: str) -> list[list[str]]:
    """The CSV files under ``path``, grouped by their header line (a few groups; one name per file)."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"),
                                         F.col("_metadata.file_block_start").alias("start"),
                                         F.monotonically_increasing_id().alias("line"))
    # the lines of a file's first block are read in order by one task
    first = lines.filter("start = 0").groupBy("file").agg(F.min_by("value", "line").alias("header"))
    return [r["files"] for r in first.groupBy("header").agg(F.sort_array(F.collect_list("file")).alias("files"))
            .orderBy("header").collect()]


def read_csv_feed(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """CSV with a header row. With a contract schema, each file's columns are matched by its own
    header *names* (Spark takes one file's header for all of them otherwise, which shifts values
    when files reorder or drop columns) and converted with ``try_cast``: an empty or malformed
    cell becomes NULL, a missing column a typed NULL, and columns not in the contract are kept
    as strings after the contract columns."""
    if schema is None:
        return spark.read.option("header", True).option("inferSchema", True).csv(path)

    def typed(files: list[str] | str) -> DataFrame:
        raw = spark.read.option("header", True).csv(files)           # every column a string, named by the header
        known = [(F.col(f"`{f.name}`").try_cast(f.dataType) if f.name in raw.columns
                  else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema.fields]
        return raw.select(*known, *[F.col(f"`{c}`") for c in raw.columns if c not in set(schema.fieldNames())])

    groups = _files_by_header(spark, path)
    if len(groups) < 2:
        return typed(path)
    out = typed(groups[0])
    for files in groups[1:]:
        out = out.unionByName(typed(files), allowMissingColumns=True)
    return out


def read_parquet_feed(spark: SparkSession, *paths: str) -> DataFrame:
    return spark.read.parquet(*paths)


def stream_json_feed(spark: SparkSession, folder: str, schema: T.StructType, glob: str | None = None,
                     max_files_per_trigger: int | None = None) -> DataFrame:
    """JSON landing folder as a stream (a folder, never a single file path)."""
    r = spark.readStream.schema(schema)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.json(folder)


def stream_csv_feed(spark: SparkSession, folder: str, schema: T.StructType, glob: str | None = None) -> DataFrame:
    """CSV landing folder as a stream. Streams need the schema up front, so the header of
    every file is checked against it (``enforceSchema=false``): a file whose columns do not
    match fails instead of having its values shifted into the wrong columns."""
    r = spark.readStream.schema(schema).option("header", True).option("enforceSchema", False)
    if glob:
        r = r.option("pathGlobFilter", glob)
    return r.csv(folder)


def merge_schema_hints(schema: T.StructType, hints: str) -> T.StructType:
    """Override/add fields with DDL hints (``"a double, b double"``)."""
    hint = T.StructType.fromDDL(hints) if hasattr(T.StructType, "fromDDL") else T._parse_datatype_string(hints)
    fields = {f.name: f for f in schema.fields}
    for f in hint.fields:
        fields[f.name] = T.StructField(f.name, f.dataType, True)
    ordered = [fields[f.name] for f in schema.fields] + [fields[f.name] for f in hint.fields if f.name not in
                                                         {g.name for g in schema.fields}]
    return T.StructType(ordered)


def wider_type(a: T.DataType, b: T.DataType) -> T.DataType:
    """The least type of the lattice that holds values of both, as JSON infers types.

    NULL below everything; whole numbers below doubles; structs and arrays part by part (a field that one
    side lacks stays); any other two different types meet in text, which holds what both look like.
    """
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    numbers = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)
    if isinstance(a, numbers) and isinstance(b, numbers):
        whole = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
        return T.LongType() if isinstance(a, whole) and isinstance(b, whole) else T.DoubleType()
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        mine, other = {f.name: f.dataType for f in a.fields}, {f.name: f.dataType for f in b.fields}
        return T.StructType([T.StructField(n, wider_type(mine[n], other[n]) if n in mine and n in other else mine.get(n, other.get(n)))
                             for n in [*mine, *[n for n in other if n not in mine]]])
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(wider_type(a.elementType, b.elementType))
    return T.StringType()


def _as_doubles(t: T.DataType) -> T.DataType:
    """JSON numbers are doubles unless a hint says otherwise: 5 today may be 5.5 tomorrow."""
    if isinstance(t, T.LongType):
        return T.DoubleType()
    if isinstance(t, T.StructType):
        return T.StructType([T.StructField(f.name, _as_doubles(f.dataType)) for f in t.fields])
    return T.ArrayType(_as_doubles(t.elementType)) if isinstance(t, T.ArrayType) else t


def _kept(known: T.DataType, seen: T.DataType) -> T.DataType:
    """A known column's type after new values: it stays readable next to what was written, so it only grows new
    fields. Values that don't fit (text in a number) are NULL and their line is kept in ``_corrupt_record``."""
    if isinstance(known, T.StructType) and isinstance(seen, T.StructType):
        mine, other = {f.name: f.dataType for f in known.fields}, {f.name: f.dataType for f in seen.fields}
        return T.StructType([T.StructField(n, _kept(mine[n], other.get(n, mine[n])) if n in mine else other[n])
                             for n in [*mine, *[n for n in other if n not in mine]]])
    return seen if isinstance(known, T.NullType) else known


def evolve_schema(spark: SparkSession, folder: str | Sequence[str], previous: T.StructType | None = None,
                  hints: str | None = None, glob: str | None = None, since: str | None = None) -> T.StructType:
    """The previous schema with the columns appended that are found in the folder (or files) now, hints applied, and a
    ``_corrupt_record`` column for lines that don't fit.

    Types of new columns are those of :func:`wider_type` over all their values; a known column keeps its
    type (:func:`_kept`). JSON numbers are doubles, so files already written stay readable next
    to later ones. ``since`` (a timestamp) infers from files modified after it only.
    """
    r = spark.read
    if glob:
        r = r.option("pathGlobFilter", glob)
    if since:
        r = r.option("modifiedAfter", since)
    inferred = r.json(folder if isinstance(folder, str) else list(folder)).schema
    fields = {f.name: f.dataType for f in (previous.fields if previous is not None else [])}
    for f in inferred.fields:
        if f.name != CORRUPT:
            fields[f.name] = _kept(fields[f.name], _as_doubles(f.dataType)) if f.name in fields else _as_doubles(f.dataType)
    out = T.StructType([T.StructField(n, _as_doubles(t), True) for n, t in fields.items()])
    out = merge_schema_hints(out, hints) if hints else out
    return out if CORRUPT in out.fieldNames() else out.add(CORRUPT, T.StringType())


def evolve_feed(spark: SparkSession, folder: str, location: str, hints: str | None = None, glob: str | None = None) -> T.StructType:
    """The schema of a landing folder, evolved by the files that came since the last call.

    ``location`` holds the schema and a ledger of the files seen (path and time of modification), so each file is
    looked into once in its life. Only the names of new files reach the driver. The schema is saved
    before the ledger: after a crash in between, files are seen again, which changes nothing.
    """
    found = spark.read.format("binaryFile").option("pathGlobFilter", glob or "*.json").option("recursiveFileLookup", True)
    files = found.load(folder).select("path", "modificationTime")            # the listing; no file is read
    seen = f"{location}/files"
    ledger = spark.read.schema("path string, modificationTime timestamp").parquet(seen) if exists(spark, seen) else None
    fresh = files if ledger is None else files.join(ledger, ["path", "modificationTime"], "left_anti")
    rows = fresh.collect()
    known = load_schema(spark, f"{location}/schema")
    if not rows and known is not None:
        return known
    names = [r["path"] for r in rows]
    schema = evolve_schema(spark, names, known, hints) if names else evolve_schema(spark, folder, known, hints, glob)
    save_schema(spark, schema, f"{location}/schema")
    spark.createDataFrame(rows, "path string, modificationTime timestamp").coalesce(1).write.mode("append").parquet(seen)
    return schema


def save_schema(spark: SparkSession, schema: T.StructType, location: str) -> None:
    """Persist a schema as one JSON text row (any shared file system)."""
    spark.createDataFrame([(schema.json(),)], "schema string").coalesce(1).write.mode("overwrite").text(location)


def load_schema(spark: SparkSession, location: str) -> T.StructType | None:
    rows = spark.read.text(location).take(1) if exists(spark, location) else []
    return T.StructType.fromJson(json.loads(rows[0][0])) if rows else None


def new_files_only(df: DataFrame, ledger: DataFrame | None, file_col: str = "_source_file") -> DataFrame:
    """Incremental batch loads: drop rows of files already recorded in ``ledger``."""
    if ledger is None:
        return df
    return df.join(ledger.select(file_col).distinct(), file_col, "left_anti")
