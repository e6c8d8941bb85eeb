"""Session construction and cluster-shared scratch locations."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every voltaic job relies on. The time zone is pinned because
# event dates and hour buckets of zoned timestamps depend on it.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(master: str | None = None, app_name: str = "voltaic",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with voltaic's defaults.

    On a cluster leave ``master`` unset (the launcher supplies it) and size
    ``shuffle_partitions`` to the data (AQE coalesces small ones at runtime).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(SESSION_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def size_for_input(spark: SparkSession, input_bytes: int, target_partition_bytes: int = 256 * 1024 ** 2,
                   max_split_bytes: int = 256 * 1024 ** 2) -> int:
    """Size shuffles for an input volume so each reducer handles ~``target_partition_bytes``.

    Sets the initial shuffle partition count (adaptive execution coalesces small
    ones at runtime and uses the same size as its advisory target) and the
    maximum scan split size. Returns the partition count.
    """
    n = max(1, -(-int(input_bytes) // int(target_partition_bytes)))
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(n))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(int(target_partition_bytes)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(int(max_split_bytes)))
    return n


def shared_base(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``, or ``spark.sql.warehouse.dir`` where that is unset, as the session gives it.

    The warehouse's default is a folder of the driver's machine, which executors elsewhere don't
    see: on a cluster such a folder is refused, and ``spark.checkpoint.dir`` has to name a shared one.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.conf.get("spark.sql.warehouse.dir")
        master = spark.sparkContext.master
        here = base.startswith(("file:", "/")) and not spark.conf.get("spark.hadoop.fs.defaultFS", "file:").startswith(("hdfs:", "viewfs:", "s3"))
        if here and not (master == "local" or master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return base


def shared_dir(spark: SparkSession, *parts: str, unique: bool = True) -> str:
    """A folder that the driver and every executor reach, under :func:`shared_base`."""
    base = shared_base(spark)
    path = "/".join([base.rstrip("/"), *parts])
    return f"{path}/{uuid.uuid4().hex}" if unique else path


#: Spark's setting that removes an execution's shuffle files when it ends.
TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def tidy_shuffles(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of each write inside go when it ends; else they stay until the driver happens to collect its garbage."""
    before = spark.conf.get(TIDY, "false")
    spark.conf.set(TIDY, "true")
    try:
        yield
    finally:
        spark.conf.set(TIDY, before)


def cut_lineage(df, spark: SparkSession | None = None):
    """Write ``df`` once as parquet under the shared checkpoint directory and read it back.

    Survives executor loss, unlike a local checkpoint: the data sits on the
    shared file system and later plans restart from it. The plan is computed
    once (a reliable ``checkpoint()`` of an unpersisted plan computes it twice).
    """
    spark = spark or df.sparkSession
    path = shared_dir(spark, "voltaic", "lineage")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


__all__ = ["build_session", "size_for_input", "shared_base", "shared_dir", "tidy_shuffles", "cut_lineage", "SESSION_DEFAULTS"]
