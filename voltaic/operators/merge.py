"""MERGE semantics on immutable files: CDC apply, SCD type 2, snapshot diff.

Without a transactional table format a MERGE is a pure function
``(old state, changes) -> new state``; the pipeline writes the result to a new
version folder. Each merge is one keyed join (one shuffle of each side by key),
never a row loop, and the new state is produced in a single pass over the join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltaic import schemas as K
from voltaic.functions.columns import change_columns, null_safe_changed

__all__ = ["cdc_upserts", "cdc_apply", "empty_like", "scd2_baseline",
           "dim_current", "scd2_next_version", "scd2_changes", "scd2_apply", "snapshot_diff"]


def _q(c: str) -> str:
    return f"`{c}`"


def _key_cond(keys: Sequence[str], left: str, right: str) -> Column:
    cond = None
    for k in keys:
        eq = F.col(f"{left}.{_q(k)}") == F.col(f"{right}.{_q(k)}")
        cond = eq if cond is None else (cond & eq)
    return cond


def empty_like(spark, schema: T.StructType) -> DataFrame:
    """An empty target with a given schema (merge into a table that does not exist yet)."""
    return spark.createDataFrame([], schema)


# ---------------------------------------------------------------------------
# CDC (M1, M2)
# ---------------------------------------------------------------------------
def cdc_upserts(latest: DataFrame, op_col: str = "__$operation") -> DataFrame:
    return latest.filter(F.col(_q(op_col)).isin(K.CDC_OP_INSERT, K.CDC_OP_AFTER_IMAGE))


def cdc_apply(target: DataFrame, latest: DataFrame, key: Sequence[str] = ("transaction_id",),
              op_col: str = "__$operation", deletes: bool = True, upserts: bool = True) -> DataFrame:
    """Apply one change per key: deletes remove the key, inserts/after-images
    replace every column (or insert). ``latest`` must hold one row per key
    (see :func:`voltaic.operators.dedup.cdc_latest`).

    One anti-join removes every key that is deleted or replaced; the upserts are
    then appended. A delete of an unknown key is a no-op and NULL keys never match.

    Only the touched keys enter the join; adaptive execution broadcasts them when their
    measured size allows it. Building the plan runs no job.
    """
    touched_ops = []
    if deletes:
        touched_ops.append(K.CDC_OP_DELETE)
    if upserts:
        touched_ops += [K.CDC_OP_INSERT, K.CDC_OP_AFTER_IMAGE]
    touched = latest.filter(F.col(_q(op_col)).isin(*touched_ops)).select(*[_q(k) for k in key])
    kept = target.join(touched, list(key), "left_anti").select(*[_q(c) for c in target.columns])
    if not upserts:
        return kept
    new_rows = cdc_upserts(latest, op_col).select(*[_q(c) for c in target.columns])
    return kept.unionByName(new_rows)


# ---------------------------------------------------------------------------
# SCD type 2
# ---------------------------------------------------------------------------
def scd2_baseline(df: DataFrame, start: str = K.SCD_BASELINE_START_DATE, end: str = K.SCD_OPEN_END_DATE) -> DataFrame:
    """Give a plain snapshot the SCD2 columns (one current version per row) unless it has them."""
    if "is_current" in df.columns:
        return df
    return df.withColumns({
        "record_effective_date": F.to_date(F.lit(start)),
        "record_end_date": F.to_date(F.lit(end)),
        "is_current": F.lit(True),
        "scd_version": F.lit(1),
    })


def dim_current(dim: DataFrame) -> DataFrame:
    return dim.filter(F.col("is_current"))


def scd2_next_version(delta: DataFrame, dim: DataFrame, key: Sequence[str]) -> DataFrame:
    """Incoming rows with ``scd_version`` = current version + 1 (1 for new keys)."""
    cur = dim_current(dim).select(*[_q(k) for k in key], F.col("scd_version").alias("__cur_version"))
    out = delta.drop("scd_version").join(cur, list(key), "left")
    nxt = F.coalesce(F.col("__cur_version") + F.lit(1), F.lit(1)).cast(dim.schema["scd_version"].dataType)
    return out.withColumn("scd_version", nxt).drop("__cur_version")


def scd2_changes(dim: DataFrame, delta: DataFrame, key: Sequence[str],
                 compare_cols: Sequence[str] | None = None, end_offset_days: int = 1,
                 insert_new_versions: bool = True) -> DataFrame:
    """Current rows and delta rows after the merge, tagged by ``_scd_action``:

    ``keep`` (untouched current row), ``expire`` (changed: closed with
    ``record_end_date = effective - end_offset_days``), ``new_version`` (the changed
    row's successor, version + 1) and ``new_key`` (version 1). ``delta`` must be
    unique per key. The change test is null-safe over ``compare_cols`` (default:
    all business columns, excluding SCD and ``_`` lineage columns).
    """
    dim_cols = dim.columns
    types = {f.name: f.dataType for f in dim.schema.fields}
    if compare_cols is None:
        compare_cols = [c for c in change_columns(delta, keys=key) if c in dim_cols]
    cur = dim_current(dim)
    cur = cur.alias("t")
    src = delta.withColumn("__present", F.lit(True)).alias("s")
    j = cur.join(src, _key_cond(key, "t", "s"), "full_outer")

    t_here = F.col("t.is_current").isNotNull()
    s_here = F.col("s.__present").isNotNull()
    changed = t_here & s_here & null_safe_changed(compare_cols, "t", "s")

    eff = F.to_date(F.col("s.record_effective_date")) if "record_effective_date" in delta.columns \
        else F.current_date()
    end_new = (F.to_date(F.coalesce(F.col("s.record_end_date").cast("string"), F.lit(K.SCD_OPEN_END_DATE)))
               if "record_end_date" in delta.columns else F.to_date(F.lit(K.SCD_OPEN_END_DATE)))

    def typed(c: str, e: Column) -> Column:
        return e.cast(types[c]).alias(c)

    old_fields, new_fields = [], []
    for c in dim_cols:
        t_c = F.col(f"t.{_q(c)}")
        if c == "record_end_date":
            old = F.when(changed, F.date_sub(eff, end_offset_days)).otherwise(t_c)
            new = end_new
        elif c == "is_current":
            old = F.when(changed, F.lit(False)).otherwise(t_c)
            new = F.lit(True)
        elif c == "scd_version":
            old = t_c
            new = F.coalesce(t_c + F.lit(1), F.lit(1))
        elif c == "record_effective_date":
            old = t_c
            new = eff
        elif c in key:
            old, new = t_c, F.col(f"s.{_q(c)}")
        else:
            old = t_c
            new = F.col(f"s.{_q(c)}") if c in delta.columns else t_c       # absent from the delta: carried forward
        old_fields.append(typed(c, old))
        new_fields.append(typed(c, new))

    action_old = F.when(changed, F.lit("expire")).otherwise(F.lit("keep"))
    action_new = F.when(t_here, F.lit("new_version")).otherwise(F.lit("new_key"))
    emit_new = s_here & (~t_here | changed)
    if not insert_new_versions:
        emit_new = s_here & ~t_here
    old_row = F.when(t_here, F.struct(*old_fields, action_old.alias("_scd_action")))
    new_row = F.when(emit_new, F.struct(*new_fields, action_new.alias("_scd_action")))
    rows = F.filter(F.array(old_row, new_row), lambda r: r.isNotNull())
    return j.select(F.inline(rows))


def scd2_apply(dim: DataFrame, delta: DataFrame, key: Sequence[str],
               compare_cols: Sequence[str] | None = None, end_offset_days: int = 1,
               insert_new_versions: bool = True) -> DataFrame:
    """New dimension after an SCD2 merge: untouched history plus :func:`scd2_changes`.

    Columns that only the delta has are added (NULL in older rows); columns that it lacks are
    carried forward. Re-applying the same delta is a no-op (the new current rows equal the delta).
    One full outer join of the current rows with the delta; the history is not shuffled.
    """
    known = {f.name: f.dataType for f in delta.schema.fields}
    fresh = {c: F.lit(None).cast(known[c]) for c in change_columns(delta, keys=key) if c not in dim.columns}
    dim = dim.withColumns(fresh) if fresh else dim                    # a column that the delta brings is kept
    history = dim.filter(~F.coalesce(F.col("is_current"), F.lit(False)))
    merged = scd2_changes(dim, delta, key, compare_cols, end_offset_days, insert_new_versions).drop("_scd_action")
    return history.unionByName(merged)


# ---------------------------------------------------------------------------
# Snapshot diff: change feed between two versions of a table
# ---------------------------------------------------------------------------
def snapshot_diff(old: DataFrame, new: DataFrame, key: Sequence[str],
                  compare_cols: Sequence[str] | None = None) -> DataFrame:
    """Rows ``insert``, ``delete``, ``update_preimage``, ``update_postimage``
    (column ``_change_type``) between two snapshots unique per key; one full
    outer join, one pass."""
    cols = [c for c in new.columns if c in old.columns]
    if compare_cols is None:
        compare_cols = [c for c in cols if c not in key]
    j = (old.withColumn("__present", F.lit(True)).alias("o")
         .join(new.withColumn("__present", F.lit(True)).alias("n"), _key_cond(key, "o", "n"), "full_outer"))
    o_here, n_here = F.col("o.__present").isNotNull(), F.col("n.__present").isNotNull()
    changed = o_here & n_here & null_safe_changed(compare_cols, "o", "n")

    def row(side: str, tag: Column) -> Column:
        return F.struct(*[F.col(f"{side}.{_q(c)}").alias(c) for c in cols], tag.alias("_change_type"))

    old_row = F.when(o_here & ~n_here, row("o", F.lit("delete"))) \
        .when(changed, row("o", F.lit("update_preimage")))
    new_row = F.when(n_here & ~o_here, row("n", F.lit("insert"))) \
        .when(changed, row("n", F.lit("update_postimage")))
    return j.select(F.inline(F.filter(F.array(old_row, new_row), lambda r: r.isNotNull())))
