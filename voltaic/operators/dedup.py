"""Latest-record-per-key selection (W1-W3) and key-validity routing.

``row_number() == 1`` over a key window is planned by Spark as a *partial*
``WindowGroupLimit`` before the shuffle and a final one after it, so a hot key
is cut to one row per map task before it reaches the exchange: a key holding a
third of the input costs one row per input split in the shuffle, not a third of
the data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voltaic import schemas as K
from voltaic.functions.columns import is_blank

__all__ = ["row_hash", "dedup_latest", "split_key_validity", "with_fallback_key", "cdc_order", "cdc_latest"]

_RN = "__rn"


def row_hash(df: DataFrame) -> Column:
    """Deterministic content hash of a row: a last-resort total-order tie-break."""
    return F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])


def dedup_latest(df: DataFrame, keys: Sequence[str], order: Sequence[Column],
                 total_order: bool = True) -> DataFrame:
    """Keep one row per key: the first under ``order`` (give ``.desc()`` for latest).

    With ``total_order`` a content hash breaks remaining ties, so the result does
    not depend on how the input happens to be partitioned. Rows whose key is
    NULL form one group per key value like any other; route them away first with
    :func:`split_key_validity` when NULL keys must not collapse.
    """
    ordering = list(order)
    if total_order:
        ordering.append(row_hash(df).desc())
    w = Window.partitionBy(*[F.col(f"`{k}`") for k in keys]).orderBy(*ordering)
    return df.withColumn(_RN, F.row_number().over(w)).filter(F.col(_RN) == 1).drop(_RN)


def split_key_validity(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows with every key present and non-blank, quarantined rows with a NULL/blank key)."""
    bad = None
    for k in keys:
        cond = is_blank(F.col(f"`{k}`"))
        bad = cond if bad is None else (bad | cond)
    return df.filter(~bad), df.filter(bad)


def with_fallback_key(df: DataFrame, primary: str, fallback: Sequence[str], out: str = "_dedup_key") -> DataFrame:
    """Dedup key = the primary id, or (when it is NULL/blank) the fallback columns joined
    (e.g. ``meter_id || event_ts``); NULL only when every part is missing."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in fallback]
    any_part = None
    for c in fallback:
        any_part = F.col(c).isNotNull() if any_part is None else (any_part | F.col(c).isNotNull())
    alt = F.when(any_part, F.concat_ws("|", *parts))
    return df.withColumn(out, F.when(~is_blank(primary), F.col(primary).cast("string")).otherwise(alt))


def cdc_order(df: DataFrame, ts_col: str = "cdc_ts", seq_col: str = "__$seqval",
              ingest_col: str = "_ingestion_ts") -> list[Column]:
    """Latest-change ordering: event time, sequence, ingestion time, then LSN,
    command id and operation (after-image before before-image) as tie-breaks.
    Hex LSN/sequence strings are fixed-width, so string order is numeric order."""
    cols = [ts_col, seq_col, ingest_col, "__$start_lsn", "__$command_id", "__$operation"]
    return [F.col(f"`{c}`").desc() for c in cols if c in df.columns]


def cdc_latest(df: DataFrame, key: Sequence[str] = ("transaction_id",), ts_col: str = "cdc_ts",
               op_col: str = "__$operation") -> DataFrame:
    """Latest change per key after dropping before-images (op 3).

    Before-images never win: on a tie of time and sequence they would otherwise
    be able to displace the after-image and lose the update.
    """
    changes = df.filter(F.col(f"`{op_col}`").isNull() | (F.col(f"`{op_col}`") != K.CDC_OP_BEFORE_IMAGE))
    return dedup_latest(changes, key, cdc_order(changes, ts_col=ts_col))
