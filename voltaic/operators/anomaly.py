"""Dynamic per-region consumption bands (A1) and meter anomaly scoring.

Percentiles are exact: the value whose rank is ``ceil(p * n)``. No sketch is merged
per region and no region's readings meet in one task. The value axis is refined level by level, and a
level is one partial aggregation with a bounded number of results per region:

1. ``slice_counts``: values are counted per (region, slice); a slice is a 1024th of a power of two, so there are
   as many as the values' magnitudes need, some thousands as a rule. These counts can be stored, and added up as
   readings arrive (``add_counts``);
2. running counts name the slice that holds each rank; its values are counted in ``PARTS`` equal parts between its
   least and greatest value;
3. the values of the part that holds the rank are counted one by one. A slice of a 1024th of a
   power of two in 2**20 parts leaves a part at most 2**22 different doubles, however many readings there are and
   wherever they crowd.

What is looked up for each reading (a row for each group and percentile) is broadcast: a shuffle by region would
put all readings into as many tasks as there are regions.

Everything is one lazy plan; building it runs no job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voltaic import schemas as K
from voltaic.functions.scoring import meter_anomaly_flag, meter_anomaly_type

__all__ = ["slice_counts", "add_counts", "exact_percentiles", "region_thresholds", "score_meter_anomaly"]

#: Slices for each power of two on the value axis; parts of a slice.
SLICES = 1024
PARTS = 1 << 20
_LEAST = 1080 * SLICES      # more than the number of slices below 1
_NAN_SLICE = 1 << 40


def _slice(v: Column) -> Column:
    """Monotone slice number of a double: zero in the middle, infinities at the ends, NaN last (as Spark orders it)."""
    size = F.floor(F.least(F.log2(F.abs(v)), F.lit(2000.0)) * SLICES) + _LEAST
    return F.when(F.isnan(v), F.lit(_NAN_SLICE)).when(v == 0, F.lit(0)).otherwise(F.signum(v) * size).cast("bigint")


def _values(df: DataFrame, group: str, value: str) -> DataFrame:
    rows = df.select(F.col(f"`{group}`").alias("g"), F.col(f"`{value}`").cast("double").alias("v")).filter("v is not null")
    return rows.withColumn("slice", _slice(F.col("v")))


def slice_counts(df: DataFrame, group: str, value: str) -> DataFrame:
    """``g, slice, n, low, high``: how many values of each group lie in each slice, and between which."""
    return _values(df, group, value).groupBy("g", "slice").agg(
        F.count(F.lit(1)).alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))


def add_counts(counts: DataFrame | None, more: DataFrame) -> DataFrame:
    """Counts of two disjoint sets of values as counts of both."""
    both = more if counts is None else counts.unionByName(more)
    return both.groupBy("g", "slice").agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"))


def exact_percentiles(df: DataFrame, group: str, value: str, percentiles: dict[str, float],
                      counts: DataFrame | None = None) -> DataFrame:
    """One row per group (NULL included) that has a value: a column per named percentile.

    A percentile ``p`` is the smallest value whose rank among the group's non-NULL values is at
    least ``ceil(p * n)`` (and at least 1). ``counts``: stored :func:`slice_counts` of exactly these values;
    without them the values are counted here.
    """
    rows = _values(df, group, value)
    counts = slice_counts(df, group, value) if counts is None else counts
    of_group = Window.partitionBy("g")
    counts = counts.withColumns({"upto": F.sum("n").over(of_group.orderBy("slice")), "total": F.sum("n").over(of_group)})
    wanted = F.array(*[F.struct(F.lit(name).alias("name"),
                                F.greatest(F.ceil(F.lit(p) * F.col("total")), F.lit(1)).cast("bigint").alias("rank"))
                       for name, p in percentiles.items()])
    held = counts.select("g", "slice", "low", "high", (F.col("upto") - F.col("n")).alias("before"), "upto", F.explode(wanted).alias("w"))
    held = held.filter("w.rank > before and w.rank <= upto").select(
        F.col("g").alias("pg"), F.col("slice").alias("pslice"), "low", "high", "w.name", (F.col("w.rank") - F.col("before")).alias("need"))
    inside = rows.join(F.broadcast(held), F.col("g").eqNullSafe(F.col("pg")) & (F.col("slice") == F.col("pslice")))
    wide = F.col("high") > F.col("low")                                     # false for NaN and for infinities alone
    part = F.when(wide, F.floor((F.col("v") - F.col("low")) / (F.col("high") - F.col("low")) * PARTS)).otherwise(F.lit(0))
    inside = inside.select("g", "name", "need", "v", part.cast("bigint").alias("part"))
    per_part = inside.groupBy("g", "name", "need", "part").agg(F.count(F.lit(1)).alias("n"))
    per_part = per_part.withColumn("upto", F.sum("n").over(Window.partitionBy("g", "name").orderBy("part")))
    chosen = per_part.filter("need > upto - n and need <= upto").select(
        F.col("g").alias("pg"), F.col("name").alias("pname"), F.col("part").alias("ppart"), (F.col("need") - F.col("upto") + F.col("n")).alias("left"))
    last = inside.join(F.broadcast(chosen), F.col("g").eqNullSafe(F.col("pg")) & (F.col("name") == F.col("pname")) & (F.col("part") == F.col("ppart")))
    exact = last.groupBy("g", "name", "left", "v").agg(F.count(F.lit(1)).alias("n"))
    exact = exact.withColumn("upto", F.sum("n").over(Window.partitionBy("g", "name").orderBy("v"))).filter(F.col("upto") >= F.col("left"))
    return exact.groupBy(F.col("g").alias(group)).agg(
        *[F.min(F.when(F.col("name") == name, F.col("v"))).alias(name) for name in percentiles])


def region_thresholds(readings: DataFrame, group: str = "region", value: str = "kwh_consumed",
                      low: float = K.METER_LOW_PERCENTILE, high: float = K.METER_HIGH_PERCENTILE,
                      counts: DataFrame | None = None) -> DataFrame:
    """Per-group low/high percentiles of ``value`` (``p01_kwh``, ``p99_kwh``)."""
    return exact_percentiles(readings, group, value, {"p01_kwh": low, "p99_kwh": high}, counts)


def score_meter_anomaly(readings: DataFrame, thresholds: DataFrame | None = None, group: str = "region",
                        value: str = "kwh_consumed", keep_bounds: bool = False, **kw) -> DataFrame:
    """Add ``is_kwh_anomaly`` (strictly outside the band; NULL when unknown) and
    ``anomaly_type``. A NULL group never matches a threshold row."""
    thr = thresholds if thresholds is not None else region_thresholds(readings, group, value, **kw)
    out = readings.join(F.broadcast(thr), group, "left")
    kwh, lo, hi = F.col(value), F.col("p01_kwh"), F.col("p99_kwh")
    out = out.withColumns({"is_kwh_anomaly": meter_anomaly_flag(kwh, lo, hi),
                           "anomaly_type": meter_anomaly_type(kwh, lo, hi)})
    return out if keep_bounds else out.drop("p01_kwh", "p99_kwh")
