"""Structured Streaming jobs.

* ``run_available_now``: append a stream to parquet with a checkpoint and
  ``availableNow`` (drain what has landed, then stop). Re-running adds nothing
  for files already committed: the checkpoint is the exactly-once ledger.
* ``watermark_dedup``: duplicate delivery removed with bounded state: the
  event-time watermark lets Spark evict keys older than the delay.
* ``cdc_foreach_batch``: each micro-batch of change rows is merged into the latest
  change per key, deletes included (a version per batch that holds the touched
  buckets only, so a failed batch is simply retried from the checkpoint).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from voltaic.operators.dedup import cdc_latest
from voltaic.operators.merge import cdc_upserts
from voltaic.plans.tables import merge_buckets, read_current
from voltaic.session import shared_dir

__all__ = ["run_available_now", "watermark_dedup", "stream_table", "stream_dedup_events", "cdc_foreach_batch",
           "read_cdc_state", "latest_changes", "use_rocksdb"]


def use_rocksdb(spark: SparkSession) -> None:
    """Keep streaming state in RocksDB on the executors' disks, not in their heaps. Each epoch checkpoints its files, not a
    log of its changes: every drain is a new run, and would replay the changes of all epochs since the last snapshot."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass",
                   "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "false")


def run_available_now(stream: DataFrame, out_path: str, checkpoint: str, fmt: str = "parquet",
                      partition_by: Sequence[str] = ()) -> StreamingQuery:
    """Append ``stream`` to ``out_path`` until the source is drained, then stop; the finished query tells its progress."""
    use_rocksdb(stream.sparkSession)
    w = (stream.writeStream.format(fmt).outputMode("append")
         .option("checkpointLocation", checkpoint).trigger(availableNow=True))
    if partition_by:
        w = w.partitionBy(*partition_by)
    q = w.start(out_path)
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return q


def watermark_dedup(stream: DataFrame, keys: Sequence[str], event_time: str, delay: str = "10 minutes",
                    within_watermark: bool = False) -> DataFrame:
    """Drop repeated deliveries of the same event.

    ``within_watermark=False`` keys on ``keys + [event_time]`` (state expires with
    the watermark). ``True`` keys on ``keys`` only via
    ``dropDuplicatesWithinWatermark``, which also bounds state. The event-time
    column must be a timestamp (parse strings first).
    """
    s = stream.withWatermark(event_time, delay)
    if within_watermark:
        return s.dropDuplicatesWithinWatermark(list(keys))
    return s.dropDuplicates([*keys, event_time])


def _is_file(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(p).isFile()


def stream_table(spark: SparkSession, table: str, files_per_batch: int | None = None) -> DataFrame:
    """A parquet table, one file or a folder of files, as a stream."""
    reader = spark.readStream.schema(spark.read.parquet(table).schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if _is_file(spark, table):
        folder, name = table.rsplit("/", 1)
        return reader.option("pathGlobFilter", name).parquet(folder)
    return reader.parquet(table)


def stream_dedup_events(spark: SparkSession, events: str, delay: str = "10 minutes", within_watermark: bool = False,
                        files_per_batch: int | None = None) -> DataFrame:
    """Events delivered twice (two streaming sources over the same table), de-duplicated with a
    watermark in as many micro-batches as the sources give, and appended to parquet in the
    shared folder; returns the deduplicated table.

    Late data: an event that is older than ``delay`` behind the newest event of the batches
    before it is dropped, so ``delay`` must cover how far the table is out of order.
    """
    both = stream_table(spark, events, files_per_batch).unionByName(stream_table(spark, events, files_per_batch))
    columns = both.columns
    both = both.withColumn("__event_time", F.col("ts").cast(T.TimestampType()))
    deduped = watermark_dedup(both, ["event_id"], "__event_time", delay, within_watermark).select(*columns)
    out = shared_dir(spark, "voltaic", "stream_dedup")
    run_available_now(deduped, f"{out}/data", f"{out}/_checkpoint")
    return spark.read.schema(deduped.schema).parquet(f"{out}/data")


def latest_changes(key: Sequence[str], op_col: str = "__$operation"):
    """Merge function for :func:`merge_buckets`: the latest change of each key, deletes included."""
    def merge(state: DataFrame | None, changes: DataFrame) -> DataFrame:
        return cdc_latest(changes if state is None else state.unionByName(changes, allowMissingColumns=True), key, op_col=op_col)
    return merge


def cdc_foreach_batch(target_root: str, key: Sequence[str], op_col: str = "__$operation", buckets: int = 64):
    """``foreachBatch`` function that merges each micro-batch of changes into versioned state.

    The state is the latest change of each key, deletes included: a change that arrives after a later
    one of its key (by time, then sequence) finds it there and has no effect, and a deleted key stays
    deleted. An epoch reads and writes only the buckets of keys that it changes, and leaves its
    inserted, updated and deleted rows as the change feed of its version. A retried epoch, whether it
    was committed or not, starts from the newest version of an earlier epoch, so it may be retried any number of times.
    :func:`read_cdc_state` gives the live rows.
    """
    def apply(batch: DataFrame, epoch: int) -> None:
        merge_buckets(batch.sparkSession, target_root, batch, key, latest_changes(key, op_col), str(epoch), epoch=epoch,
                      buckets=buckets, feed_keys=key, visible=lambda rows: cdc_upserts(rows, op_col))
    return apply


def read_cdc_state(spark: SparkSession, target_root: str, op_col: str = "__$operation") -> DataFrame | None:
    """The live rows of the newest state: every key whose latest change is not a delete."""
    state = read_current(spark, target_root)
    return None if state is None else cdc_upserts(state, op_col)
