"""Helpers that the training-data operators share: tables, scratch tables, word splitting."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltaic.session import shared_base

#: Code points that separate words; everything else is part of a word.
WORD_SPACE = "\x20\x09\x0a\x0b\x0c\x0d"


_shipped: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Sends this package to the executors once, so that tasks can import it wherever they run."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent.parent
    archive = Path(tempfile.mkdtemp(prefix="voltaic-code-")) / "voltaic_code.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent).as_posix())
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_code(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_dir(spark: SparkSession) -> str:
    """A fresh folder under ``spark.checkpoint.dir``; under the warehouse where that is unset (refused if it is a
    folder of one machine and the session runs on a cluster)."""
    return f"{shared_base(spark).rstrip('/')}/voltaic-llm/{uuid.uuid4().hex}"


#: Spark's setting that removes an execution's shuffle files when it ends.
TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def store(df: DataFrame, compression: str = "snappy", tidy: bool = False, path: str | None = None, block: int | None = None) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    What follows restarts from these files when executors are lost, and nothing is computed twice. With ``tidy`` the
    shuffle files of the write go when it ends, since nothing reads them any more. ``path``: a folder
    of the caller's own (:func:`scratch_dir`), which the caller may delete when nothing reads it any more. ``block``: how
    many bytes a task gathers in memory before it writes them (Parquet's own bound is 128 MB for each task).
    """
    spark = df.sparkSession
    ship_code(spark)
    path = path or scratch_dir(spark)
    before = spark.conf.get(TIDY, "false")
    spark.conf.set(TIDY, "true" if tidy else before)
    try:
        out = df.write.option("compression", compression)
        (out.option("parquet.block.size", block) if block else out).parquet(path)
    finally:
        spark.conf.set(TIDY, before)
    return spark.read.schema(df.schema).parquet(path)


def words_of(text: str | None) -> list[bytes]:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text as UTF-8, A-Z lower-cased.

    ``bytes`` methods treat ASCII only, and ``bytes.split()`` splits at exactly those six bytes.
    """
    return text.encode("utf-8", "replace").lower().split() if text else []


def doc_crc(col: str = "doc_id"):
    """crc32 of the id written as text (null: of the empty text)."""
    return F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary"))


def least_count(counts: DataFrame, most: int, floor: int = 1) -> int | None:
    """The least count ``n`` (``floor`` or more) so that at most ``most`` rows have it or a higher one.

    Counts are looked at in eight steps for each doubling, so a few hundred rows come to the driver,
    however many different counts there are. None: even the highest step has too many rows.
    """
    steps = counts.filter(F.col("n") >= floor).groupBy(F.floor(F.log2("n") * 8)).agg(F.min("n").alias("least"), F.count(F.lit(1)).alias("rows"))
    least, total = None, 0
    for step in sorted(steps.collect(), key=lambda r: -r["least"]):
        if total + step["rows"] > most:
            break
        least, total = step["least"], total + step["rows"]
    return least
