"""The hourly marts as streams (A2, A3, A5): windowed aggregation under a watermark.

Each micro-batch emits the hours that it changed (update mode) and merges them into a bucketed table by hour
and keys, so the mart is complete while hours are still open, a retried epoch changes nothing, and only
touched buckets are written. The watermark bounds the state: an hour whose end lies ``delay`` behind
the newest event of earlier batches is closed and leaves the state; a row that belongs to a closed
hour is late, is dropped, and is counted by Spark (``late_rows``). On input whose disorder stays within
``delay`` the mart equals the batch mart. Rows without an event time belong to no hour and are left out.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from voltaic import schemas as K
from voltaic.functions.columns import backfill_columns
from voltaic.operators import marts
from voltaic.plans.tables import merge_buckets, read_current
from voltaic.streaming.ingest import use_rocksdb

__all__ = ["hourly_stream", "usage_hourly_stream", "health_hourly_stream", "renewable_hourly_stream", "run_mart",
           "read_mart", "late_rows"]


def hourly_stream(stream: DataFrame, ts_col: str, keys: Sequence[Column | str], measures: Sequence[Column], delay: str) -> DataFrame:
    """Hours of a stream: ``hour_ts, event_date``, keys, measures. The hour has the type of the event time."""
    kind = stream.schema[ts_col].dataType
    seen = stream.withColumn("__at", F.col(ts_col).cast(T.TimestampType())).withWatermark("__at", delay)
    hours = seen.groupBy(F.window("__at", "1 hour"), *keys).agg(*measures)
    hour = F.col("window.start").cast(kind)
    return hours.select(hour.alias("hour_ts"), F.to_date(hour).alias("event_date"), *[c for c in hours.columns if c != "window"])


def usage_hourly_stream(readings: DataFrame, delay: str = "2 hours", ts_col: str = "event_ts") -> DataFrame:
    return marts.usage_rates(hourly_stream(readings, ts_col, ["meter_id", "region", "state"], marts.usage_measures(readings), delay))


def health_hourly_stream(telemetry: DataFrame, delay: str = "2 hours", ts_col: str = "telemetry_ts") -> DataFrame:
    return marts.health_rates(hourly_stream(telemetry, ts_col, ["transformer_id", "region", "state"], marts.health_measures(telemetry), delay))


def renewable_hourly_stream(production: DataFrame, delay: str = "2 hours", ts_col: str = "event_ts") -> DataFrame:
    df = backfill_columns(production, K.RENEWABLE_EVOLVED_COLUMNS)
    return marts.renewable_rates(hourly_stream(df, ts_col, [marts.renewable_plant(df)], marts.renewable_measures(df), delay))


def _replace(keys: Sequence[str]) -> Callable[[DataFrame | None, DataFrame], DataFrame]:
    """Merge function: the batch's rows take the place of those with the same keys (NULLs are equal)."""
    def merge(rows: DataFrame | None, new: DataFrame) -> DataFrame:
        if rows is None:
            return new
        same = [F.col(f"t.`{k}`").eqNullSafe(F.col(f"s.`{k}`")) for k in keys]
        return rows.alias("t").join(new.alias("s"), same, "left_anti").unionByName(new)
    return merge


def run_mart(hourly: DataFrame, table: str, checkpoint: str, keys: Sequence[str], buckets: int = 64) -> StreamingQuery:
    """Drain the stream into the mart and stop; the finished query tells its progress."""
    spark = hourly.sparkSession
    use_rocksdb(spark)
    keys = ["hour_ts", *keys]
    merge = _replace(keys)

    def apply(batch: DataFrame, epoch: int) -> None:
        merge_buckets(batch.sparkSession, table, batch, keys, merge, str(epoch), epoch=epoch, buckets=buckets)

    q = (hourly.writeStream.outputMode("update").foreachBatch(apply).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return q


def read_mart(spark: SparkSession, table: str) -> DataFrame | None:
    return read_current(spark, table)


def late_rows(q: StreamingQuery) -> int:
    """Input rows that a run dropped because their hour was closed, after partial aggregation: one for each
    hour and keys of a task's late rows."""
    return sum(op["numRowsDroppedByWatermark"] for p in q.recentProgress for op in p["stateOperators"])
