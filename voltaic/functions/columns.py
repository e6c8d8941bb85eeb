"""Plan-time column resolution and null/ANSI-safe scalar expressions."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltaic.schemas import CANONICAL_NAMES, SCD_COLUMNS

__all__ = [
    "require_columns", "resolve_column", "first_existing", "canonicalize", "parse_ts",
    "parse_date", "with_event_time", "hour_bucket", "with_hour_bucket", "ts_from_filename",
    "backfill_columns", "is_blank", "has_text", "ratio", "guarded_ratio", "null_safe_changed",
    "rounded", "change_columns", "to_ntz",
]


def require_columns(df: DataFrame, cols: Iterable[str], what: str = "input") -> DataFrame:
    """Fail at plan time (no job runs) when a contract column is missing."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"{what} is missing required column(s): {', '.join(missing)}")
    return df


def resolve_column(df: DataFrame, candidates: Sequence[str]) -> str | None:
    """First candidate present in ``df`` (plan-time), else None."""
    for c in candidates:
        if c in df.columns:
            return c
    return None


def first_existing(df: DataFrame, candidates: Sequence[str], default: Column | None = None) -> Column:
    """Column for the first present candidate, or ``default`` (typed NULL if omitted)."""
    name = resolve_column(df, candidates)
    if name is not None:
        return F.col(name)
    return default if default is not None else F.lit(None)


def canonicalize(df: DataFrame, mapping: dict[str, str] | None = None) -> DataFrame:
    """Bring feed column names to the curated names (``reading_kwh -> kwh_consumed`` ...).

    Where a feed has both, a row's curated value wins and the other one, which stays, fills its gaps.
    """
    mapping = CANONICAL_NAMES if mapping is None else mapping
    renames = {src: dst for src, dst in mapping.items() if src in df.columns and dst not in df.columns}
    both = {src: dst for src, dst in mapping.items() if src in df.columns and dst in df.columns}
    if both:
        df = df.withColumns({dst: F.coalesce(F.col(dst), F.col(src)) for src, dst in both.items()})
    return df.withColumnsRenamed(renames) if renames else df


def parse_ts(col: Column | str, fmt: str | None = None) -> Column:
    """ISO/format timestamp parse that yields NULL (not an error) on bad input under ANSI."""
    c = F.col(col) if isinstance(col, str) else col
    return F.try_to_timestamp(c, F.lit(fmt)) if fmt else F.try_to_timestamp(c)


def parse_date(col: Column | str) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.to_date(F.try_to_timestamp(c))


def with_event_time(df: DataFrame, src: str = "timestamp", ts_col: str = "event_ts",
                    date_col: str = "event_date", drop_source: bool = True) -> DataFrame:
    """Typed event time plus its calendar date. Strings are parsed leniently (bad -> NULL)."""
    dtype = df.schema[src].dataType
    ts = F.col(src) if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)) else parse_ts(src)
    out = df.withColumn(ts_col, ts).withColumn(date_col, F.to_date(F.col(ts_col)))
    return out.drop(src) if drop_source and src != ts_col else out


def hour_bucket(col: Column | str) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.date_trunc("hour", c)


def with_hour_bucket(df: DataFrame, ts_col: str, out: str = "hour_ts") -> DataFrame:
    """Truncate to the hour, keeping the input's timestamp flavour (zoned or local)."""
    bucket = hour_bucket(ts_col)
    if isinstance(df.schema[ts_col].dataType, T.TimestampNTZType):
        bucket = bucket.cast(T.TimestampNTZType())
    return df.withColumn(out, bucket)


def ts_from_filename(path_col: Column | str, pattern: str = r"renewable_production_(\d{8})_(\d{4})") -> Column:
    """Timestamp encoded in a file name as ``..._YYYYMMDD_HHMM...``; NULL when absent."""
    p = F.col(path_col) if isinstance(path_col, str) else path_col
    day = F.regexp_extract(p, pattern, 1)
    hhmm = F.regexp_extract(p, pattern, 2)
    return F.try_to_timestamp(F.concat_ws(" ", day, hhmm), F.lit("yyyyMMdd HHmm"))


def backfill_columns(df: DataFrame, cols: Iterable[str], dtype: str = "double") -> DataFrame:
    """Add evolved columns that an older schema lacks, as typed NULLs."""
    missing = {c: F.lit(None).cast(dtype) for c in cols if c not in df.columns}
    return df.withColumns(missing) if missing else df


def is_blank(col: Column | str) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return c.isNull() | (F.trim(c.cast("string")) == "")


def has_text(col: Column | str) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return c.isNotNull() & (c != "")


def ratio(num: Column, den: Column) -> Column:
    """Unguarded ratio; NULL instead of an ANSI error when the denominator is 0."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def guarded_ratio(num: Column, den: Column) -> Column:
    """``num/den`` when ``den > 0`` else 0.0 (also 0.0 for a NULL denominator)."""
    return F.when(den > 0, F.try_divide(num.cast("double"), den.cast("double"))).otherwise(F.lit(0.0))


def null_safe_changed(cols: Sequence[str], left: str, right: str) -> Column:
    """True when any compared column differs, NULL <-> value counting as a change."""
    if not cols:
        return F.lit(False)
    pred = None
    for c in cols:
        diff = ~F.col(f"{left}.`{c}`").eqNullSafe(F.col(f"{right}.`{c}`"))
        pred = diff if pred is None else (pred | diff)
    return pred


def rounded(df: DataFrame, scale: int = 6) -> DataFrame:
    """Doubles rounded to ``scale`` decimals, for results that are compared value by value.

    Floating-point sums depend on the order of addition in their last bits; marts keep
    Spark's plain sums and only a comparison rounds.
    """
    return df.withColumns({f.name: F.round(F.col(f"`{f.name}`"), scale) for f in df.schema.fields
                           if isinstance(f.dataType, T.DoubleType)})


def change_columns(df: DataFrame, exclude: Iterable[str] = SCD_COLUMNS, keys: Iterable[str] = ()) -> list[str]:
    """Business columns to compare: everything but SCD columns, keys and ``_``-prefixed lineage."""
    skip = set(exclude) | set(keys)
    return [c for c in df.columns if c not in skip and not c.startswith("_")]


def to_ntz(df: DataFrame) -> DataFrame:
    """Cast zoned timestamp columns to local (NTZ) ones, same wall clock in the session zone."""
    casts = {f.name: F.col(f.name).cast(T.TimestampNTZType())
             for f in df.schema.fields if isinstance(f.dataType, T.TimestampType)}
    return df.withColumns(casts) if casts else df
