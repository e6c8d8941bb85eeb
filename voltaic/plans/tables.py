"""Table layout and writes (the only place that persists data).

Merge targets are immutable versions, ``<table>/v=<tag>-<id>/``, listed in ``<table>/_versions``, because Spark
cannot overwrite a path its own plan is reading. A version holds all rows (``write_version``) or the buckets
of keys that a merge touched (``merge_buckets``), and names the folders of earlier versions for the rest. Partitioned
marts use dynamic partition overwrite so an incremental run replaces only the dates it produced.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltaic.operators.merge import snapshot_diff
from voltaic.session import tidy_shuffles


@dataclass(frozen=True)
class Layout:
    root: str

    def path(self, layer: str, table: str) -> str:
        return f"{self.root.rstrip('/')}/{layer}/{table}"

    @property
    def checkpoints(self) -> str:
        return f"{self.root.rstrip('/')}/_checkpoints"

    @property
    def schemas(self) -> str:
        return f"{self.root.rstrip('/')}/_schemas"


def write_table(df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] = (),
                repartition_by_partitions: bool = True, compression: str | None = None) -> str:
    """Write parquet; for partitioned output, cluster rows by partition value first
    (one shuffle) so each date is written by few tasks instead of every task
    writing a small file per date. The ``rebalance`` hint lets adaptive execution
    split a hot date over several writers and merge small dates, so one date
    holding a third of the rows does not end up in a single task."""
    if partition_by and repartition_by_partitions:
        df = df.hint("rebalance", *partition_by)
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path, compression=compression)
    return path


def observed_write(df: DataFrame, write: Callable[[DataFrame], object], ts_col: str | None = None) -> dict:
    """Run ``write(df)`` and return what it wrote: ``rows`` and, with ``ts_col``, ``min_ts`` and ``max_ts``.

    The metrics are accumulated by the write's own tasks (``DataFrame.observe``), so nothing is read back.
    ``write`` must run one action on the frame that it gets.
    """
    seen = Observation(f"write-{uuid.uuid4().hex}")
    bounds = [F.min(ts_col).alias("min_ts"), F.max(ts_col).alias("max_ts")] if ts_col else []
    write(df.observe(seen, F.count(F.lit(1)).alias("rows"), *bounds))
    return dict(seen.get)


def write_partitioned(spark: SparkSession, df: DataFrame, path: str, partition_by: Sequence[str],
                      incremental: bool) -> str:
    """Partitioned write; INCR replaces only the partitions present in ``df``."""
    key = "spark.sql.sources.partitionOverwriteMode"
    old = spark.conf.get(key, "static")
    spark.conf.set(key, "dynamic" if incremental else "static")
    try:
        return write_table(df, path, "overwrite", partition_by)
    finally:
        spark.conf.set(key, old)


#: What Spark says when a table was never written: no folder, or one without any file.
_ABSENT = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def read_if_present(read: Callable[[], DataFrame]) -> DataFrame | None:
    """``read()``, or None if its path was never written. Any other error is raised."""
    try:
        return read()
    except AnalysisException as e:
        if e.getCondition() in _ABSENT:
            return None
        raise


@dataclass(frozen=True)
class Version:
    """One line of a table's version log; it says all that is needed to read the table as of that version."""
    n: int                                  # lines count up; the last one is the current version
    version: int                            # place in the chain of versions: a retry has the number of what it replaces
    epoch: int
    tag: str
    path: str                               # the folder that this version wrote
    buckets: int                            # 0: the rows are not dealt to buckets
    schema: str
    parts: dict[str, str]                   # bucket -> folder, from this version or an earlier one
    feed: list                              # (version, folder) of the change rows of this version and those before it
    file: str = ""                          # the log file that holds the line

    def struct(self) -> T.StructType:
        return T.StructType.fromJson(json.loads(self.schema))


_LOG = ("n bigint, version bigint, epoch bigint, tag string, path string, buckets int, schema string, "
        "parts map<string,string>, feed array<struct<version:bigint,path:string>>")


def _versions(spark: SparkSession, table_path: str) -> list[Version]:
    """The lines that the log holds, oldest first: the kept versions, and what a crash left."""
    if not exists(spark, f"{table_path}/_versions"):
        return []
    log = spark.read.schema(_LOG).json(f"{table_path}/_versions")
    rows = log.select("*", F.col("_metadata.file_path").alias("file")).collect()
    return sorted((Version(**r.asDict()) for r in rows), key=lambda v: v.n)


def current_version(spark: SparkSession, table_path: str, before_tag: int | None = None) -> Version | None:
    """The newest version of a versioned table (optionally of the epochs before ``before_tag``), or None."""
    log = _versions(spark, table_path)
    return next((v for v in reversed(log) if before_tag is None or v.epoch < before_tag), None)


def read_version(spark: SparkSession, version: Version, buckets: Iterable[str] | None = None,
                 schema: T.StructType | None = None) -> DataFrame:
    """The rows of a version, or of some of its buckets (with columns that a later schema adds as NULLs)."""
    schema = schema or version.struct()
    paths = [p for b, p in sorted(version.parts.items()) if buckets is None or b in set(buckets)]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def read_current(spark: SparkSession, table_path: str, before_tag: int | None = None) -> DataFrame | None:
    v = current_version(spark, table_path, before_tag)
    return read_version(spark, v) if v else None


def _commit(spark: SparkSession, table_path: str, log: list[Version], new: Version) -> Version:
    """Append the line that makes ``new`` current, then drop what no kept version needs.

    Kept are the current version and the newest one of an epoch before it, which is where a retry of the
    current epoch starts, however often it is retried. Lines of other versions leave the log, and folders
    that no kept version names are deleted; change rows stay as long as a kept version lists them.
    """
    line = spark.createDataFrame([(new.n, new.version, new.epoch, new.tag, new.path, new.buckets, new.schema, new.parts,
                                   [tuple(f) for f in new.feed])], _LOG)
    line.coalesce(1).write.mode("append").json(f"{table_path}/_versions")
    before = next((v for v in reversed(log) if v.epoch < new.epoch), None)
    kept = [new, *([before] if before else [])]
    used = {p for v in kept for p in [*v.parts.values(), *(f[1] for f in v.feed)]}
    for v in log:
        if v is before:
            continue
        delete(spark, v.file)
    for v in log:
        mine = [*v.parts.values(), *(f[1] for f in v.feed)]
        for p in {p for p in mine if p not in used}:
            delete(spark, p)
    return new


def _next(log: list[Version], base: Version | None, tag: str, epoch: int | None) -> tuple[int, int, int]:
    """Line number, chain number and epoch of what is written on top of ``base``."""
    last = log[-1] if log else None
    if epoch is None:                       # runs that are not numbered: a tag that comes again is a retry
        epoch = last.epoch + (last.tag != tag) if last else 0
    return (last.n + 1 if last else 0), (base.version + 1 if base else 0), epoch


def write_version(spark: SparkSession, df: DataFrame, table_path: str, tag: str, epoch: int | None = None) -> str:
    """Write ``df`` as a new version in a folder of its own and make it the current one; returns the folder.

    The folder is never one that an earlier version uses, so a retry with the same tag may read
    the version that it replaces. The version log gains one line, last: readers see the old
    version until that file is committed and the new one from then on.
    """
    log = _versions(spark, table_path)
    target = f"{table_path}/v={tag}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(target)
    n, version, epoch = _next(log, log[-1] if log else None, str(tag), epoch)
    _commit(spark, table_path, log, Version(n, version, epoch, str(tag), target, 0, df.schema.json(), {"all": target}, []))
    return target


BUCKET = "_bucket"
#: The folder of a version's change rows, beside those of its buckets.
FEED = -1
#: With so many buckets at most, the tasks of a merge write their own files: to shuffle all rows once more would save few files.
DIRECT_BUCKETS = 16
#: A merge takes so many bytes of stored rows and changes at a time, and one bucket at least: the shuffle files of a step go
#: before the next one, so that they grow with a step and not with the table.
STEP_BYTES = 256 * 1024 ** 2
#: Versions stay, two of them beside the one that is written: they are stored small.
STORED = "zstd"


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(f"`{k}`").cast("string") for k in keys]), F.lit(buckets)).cast("int")


def _signatures(rows: DataFrame, keys: Sequence[str], buckets: int) -> dict[str, tuple]:
    """For each bucket the number of its rows and the sum of their hashes (at most ``buckets`` rows come back)."""
    mark = F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns]).cast("decimal(38,0)")
    return {str(r[0]): (r[1], r[2]) for r in rows.groupBy(bucket_of(keys, buckets)).agg(F.count(F.lit(1)), F.sum(mark)).collect()}


def _steps(spark: SparkSession, base: Version | None, touched: dict[str, int], size: int) -> list[list[str]]:
    """The touched buckets in groups of about ``STEP_BYTES``. ``touched``: the number of changes of each; ``size``: bytes of all changes."""
    rows, steps, room = sum(touched.values()), [], 0
    for b in sorted(touched, key=int):
        own = size * touched[b] // rows + (size_of(spark, base.parts[b]) if base and b in base.parts else 0)
        if not steps or own > room:
            steps.append([])
            room = STEP_BYTES
        steps[-1].append(b)
        room -= own
    return steps


def merge_buckets(spark: SparkSession, table_path: str, changes: DataFrame, keys: Sequence[str],
                  merge: Callable[[DataFrame | None, DataFrame], DataFrame], tag: str, epoch: int | None = None,
                  buckets: int = 64, feed_keys: Sequence[str] | None = None,
                  visible: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> Version | None:
    """Merge ``changes`` into a table that is dealt to buckets by a hash of ``keys``; only buckets that hold a
    changed key are read and written, all others keep their files.

    ``merge(rows, changes)`` gets the rows of touched buckets (None in a new table) and their changes and returns their new
    rows; it must treat each key by itself, and is called for about ``STEP_BYTES`` of buckets at a time. The number of
    buckets is fixed by the first version: about the table's size by that of a task's output. With ``epoch`` the merge starts
    from the newest version of an earlier epoch, so an epoch may be retried any number of times, whether or not it was
    committed before. With ``feed_keys`` (unique in ``visible(rows)``) the rows that the merge inserted, deleted and updated
    are written beside the version, by the same job of each step (so that the merge's shuffle serves both), for
    :func:`read_changes`. No changes: no version, and the current one is returned.
    """
    log = _versions(spark, table_path)
    base = next((v for v in reversed(log) if epoch is None or v.epoch < epoch), None)
    buckets = base.buckets if base else buckets
    n, version, epoch = _next(log, base, str(tag), epoch)
    target = f"{table_path}/v={tag}-{uuid.uuid4().hex[:12]}"
    with tidy_shuffles(spark):              # the changes are read by each step, which finds those of its buckets together
        changes.withColumn(BUCKET, bucket_of(keys, buckets)).sortWithinPartitions(BUCKET).write.parquet(f"{target}/in", compression=STORED)
        changes = spark.read.parquet(f"{target}/in")
        touched = {str(r[0]): r[1] for r in changes.groupBy(BUCKET).count().collect()}     # at most ``buckets``
    if not touched:
        delete(spark, target)
        return base
    known = {f.name for f in base.struct().fields} if base else set()
    for step in _steps(spark, base, touched, size_of(spark, f"{target}/in")):
        old = read_version(spark, base, step) if base else None
        new = merge(old, changes.filter(F.col(BUCKET).isin([int(b) for b in step])).drop(BUCKET))
        schema = T.StructType([*(base.struct().fields if base else []), *[f for f in new.schema.fields if f.name not in known]])
        out = new.withColumn(BUCKET, bucket_of(keys, buckets))
        if feed_keys is not None:
            has = set(new.columns)
            after = visible(new.select(*[F.col(f"`{f.name}`") if f.name in has else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]))
            rows = (snapshot_diff(visible(read_version(spark, base, step, schema)), after, feed_keys) if base
                    else after.withColumn("_change_type", F.lit("insert")))
            out = (out.withColumn("_change_type", F.lit(None).cast("string"))
                   .unionByName(rows.withColumn(BUCKET, F.lit(FEED)), allowMissingColumns=True)
                   .withColumn("_commit_version", F.lit(version).cast("bigint")))
        with tidy_shuffles(spark):
            write_table(out, f"{target}/data", "append", [BUCKET], repartition_by_partitions=buckets > DIRECT_BUCKETS, compression=STORED)
    written = {d.split("=", 1)[1]: f"{target}/data/{d}" for d in folders(spark, f"{target}/data") if d.startswith(f"{BUCKET}=")}
    feed = written.pop(str(FEED), None)                    # none: no row changed
    if base:                                # a bucket whose rows came out as they were keeps its files
        now = spark.read.schema(schema).parquet(*written.values()) if written else spark.createDataFrame([], schema)
        with tidy_shuffles(spark):
            was, now = _signatures(read_version(spark, base, touched, schema), keys, buckets), _signatures(now, keys, buckets)
        for b in [b for b in written if b in base.parts and was.get(b) == now.get(b)]:
            delete(spark, written[b])
            written[b] = base.parts[b]
    parts = {b: p for b, p in (base.parts if base else {}).items() if b not in touched} | written
    made = Version(n, version, epoch, str(tag), target, buckets, schema.json(), parts, list(base.feed) if base else [])
    if feed is not None:
        made.feed.append((version, feed))
    delete(spark, f"{target}/in")
    return _commit(spark, table_path, log, made)


def read_changes(spark: SparkSession, table_path: str, first: int = 0, last: int | None = None) -> DataFrame | None:
    """The change feed of a bucketed table from version ``first`` to ``last``, both included (default: all).

    Rows as they were or became, with ``_change_type`` (``insert``, ``delete``, ``update_preimage``, ``update_postimage``)
    and ``_commit_version``. A column that a later version added is NULL before it.
    """
    v = current_version(spark, table_path)
    if v is None:
        return None
    paths = [f[1] for f in v.feed if f[0] >= first and (last is None or f[0] <= last)]
    schema = T.StructType([*v.struct().fields, T.StructField("_change_type", T.StringType()), T.StructField("_commit_version", T.LongType())])
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def publish(spark: SparkSession, table_path: str, out: str, keys: Sequence[str],
            view: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> DataFrame:
    """Keep a plain folder, partitioned by bucket, equal to ``view`` of a bucketed table's current version.

    Only buckets that changed since the last publication are written; what was published is noted
    last, so a publication that fails is done again by the next one.
    """
    v = current_version(spark, table_path)
    noted = spark.read.schema("bucket string, path string").json(f"{out}_published") if exists(spark, f"{out}_published") else None
    done = {r["bucket"]: r["path"] for r in noted.collect()} if noted is not None else {}      # one row per bucket
    changed = {b for b in {*done, *v.parts} if done.get(b) != v.parts.get(b)}
    rows = view(read_version(spark, v, changed)).withColumn(BUCKET, bucket_of(keys, v.buckets))
    if changed:
        for b in changed:
            delete(spark, f"{out}/{BUCKET}={b}")
        write_table(rows, out, "append", [BUCKET])
        note = spark.createDataFrame(sorted(v.parts.items()), "bucket string, path string")
        note.coalesce(1).write.mode("overwrite").json(f"{out}_published")
    return spark.read.schema(rows.schema).parquet(out).drop(BUCKET)


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _fs(spark, path)
    return fs.exists(p)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder (none if it is missing)."""
    p, fs = _fs(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()] if fs.exists(p) else []


def size_of(spark: SparkSession, path: str) -> int:
    """Bytes of a file, or of all files of a folder."""
    p, fs = _fs(spark, path)
    return fs.getContentSummary(p).getLength()


def delete(spark: SparkSession, path: str) -> None:
    p, fs = _fs(spark, path)
    fs.delete(p, True)


def reset_checkpoints(spark: SparkSession, lay: Layout) -> None:
    """Forget what the streams have read: the next run ingests every landed file again."""
    delete(spark, lay.checkpoints)


# ---------------------------------------------------------------------------
# Catalog registration (external tables over the written folders)
# ---------------------------------------------------------------------------
AUDIT_DDL = {
    "table_metrics": "batch_id STRING, layer STRING, table_fqn STRING, metric_name STRING, metric_value STRING",
    "dq_violations": ("batch_id STRING, layer STRING, dataset STRING, rule_name STRING, severity STRING, "
                      "violation_count BIGINT, sample_keys STRING, created_ts TIMESTAMP"),
}


def ensure_database(spark: SparkSession, db: str, location_root: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{db}` LOCATION '{location_root.rstrip('/')}/{db}.db'")


def register_table(spark: SparkSession, db: str, table: str, path: str, ddl: str | None = None) -> str:
    """(Re)point ``db.table`` at ``path`` as an external parquet table and refresh its file listing.

    Dropping an external table never deletes data, so re-registration after a
    new version is written is safe.
    """
    fqn = f"`{db}`.`{table}`"
    current = None
    if spark.catalog.tableExists(f"{db}.{table}"):
        rows = spark.sql(f"DESCRIBE TABLE EXTENDED {fqn}").filter("col_name = 'Location'").collect()
        current = rows[0]["data_type"] if rows else None
    if current is not None and current.rstrip("/").endswith(path.rstrip("/").split(":", 1)[-1]):
        spark.sql(f"REFRESH TABLE {fqn}")
        _sync_partitions(spark, fqn)
        return f"{db}.{table}"
    spark.sql(f"DROP TABLE IF EXISTS {fqn}")
    cols = f"({ddl}) " if ddl else ""
    spark.sql(f"CREATE TABLE {fqn} {cols}USING parquet LOCATION '{path}'")
    _sync_partitions(spark, fqn)
    return f"{db}.{table}"


def _sync_partitions(spark: SparkSession, fqn: str) -> None:
    """Make the catalog list the partitions that the folder has now: without it a partitioned table reads as empty."""
    if any(c.isPartition for c in spark.catalog.listColumns(fqn)):
        spark.sql(f"MSCK REPAIR TABLE {fqn} SYNC PARTITIONS")


def register_current_view(spark: SparkSession, db: str, table: str) -> str:
    """``<table>_current``: the current rows of an SCD2 dimension."""
    spark.sql(f"CREATE OR REPLACE VIEW `{db}`.`{table}_current` AS SELECT * FROM `{db}`.`{table}` WHERE is_current = true")
    return f"{db}.{table}_current"
