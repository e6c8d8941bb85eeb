"""Data-quality rules, coverage/integrity checks and audit reports.

Rules over one dataset are evaluated together: one plan tags every violating
row with the rules it breaks (an ``inline`` of an array of structs), and both
counts and samples are aggregated from the tagged rows, so what lies below them
(such as a dedup exchange) is planned once and reused. Samples are the first
``DQ_SAMPLE_KEYS`` keys in key order: ``row_number() <= 20`` is planned as a
partial ``WindowGroupLimit`` before the shuffle, so even a rule broken by a
third of all rows ships at most 20 rows per task to the sampler and never
gathers an unbounded group.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voltaic import schemas as K
from voltaic.functions.columns import is_blank, resolve_column

__all__ = ["Rule", "rule_violations", "rule_counts", "evaluate_rules", "meter_rules", "telemetry_rules", "billing_rules",
           "dimension_multi_current", "dimension_end_date_rule", "empty_table_violation",
           "join_coverage", "coverage_metric", "referential_integrity", "time_bounds", "row_counts",
           "dq_report", "metrics_report", "metric_rows"]

#: Shards that each rule's sample candidates are cut in first.
SHARDS = 64
VIOLATION_COLUMNS = ["layer", "dataset", "rule_name", "severity", "violation_count", "sample_keys"]


@dataclass(frozen=True)
class Rule:
    """A row-level rule: rows where ``predicate`` is TRUE violate it (NULL is not a violation)."""
    rule_name: str
    severity: str
    predicate: Column
    key_cols: Sequence[str] = field(default_factory=tuple)


def _csv_field(c: Column) -> Column:
    """One CSV field with minimal quoting: NULL -> empty; quoted when it holds a comma,
    a double quote or a line break (inner quotes doubled)."""
    v = F.coalesce(c.cast("string"), F.lit(""))
    quoted = F.concat(F.lit('"'), F.regexp_replace(v, '"', '""'), F.lit('"'))
    return F.when(v.rlike('[,"\n\r]'), quoted).otherwise(v)


def _key_string(df: DataFrame, cols: Sequence[str]) -> Column:
    present = [c for c in cols if c in df.columns]
    if not present:
        return F.lit("")
    return F.concat_ws(",", *[_csv_field(F.col(c)) for c in present])


def rule_violations(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One row per (violating row, broken rule): rule_name, severity, key (CSV of the
    rule's key columns) and ``sort`` (the typed key tuple; each rule owns one field
    of the struct, so rows of one rule compare by their own key types)."""
    keysets = [[c for c in r.key_cols if c in df.columns] for r in rules]
    key_structs = [F.struct(*[F.col(c).alias(f"k{j}") for j, c in enumerate(ks)]) if ks
                   else F.struct(F.lit(0).alias("k0")) for ks in keysets]
    key_types = df.select(*[k.alias(f"r{i}") for i, k in enumerate(key_structs)]).schema
    tags = []
    for i, r in enumerate(rules):
        sort = F.struct(*[(key_structs[j] if j == i else F.lit(None).cast(key_types[j].dataType)).alias(f"r{j}")
                          for j in range(len(rules))])
        tag = F.struct(F.lit(r.rule_name).alias("rule_name"), F.lit(r.severity).alias("severity"),
                       _key_string(df, keysets[i]).alias("key"), sort.alias("sort"))
        tags.append(F.when(F.coalesce(r.predicate, F.lit(False)), tag))
    arr = F.filter(F.array(*tags), lambda t: t.isNotNull())
    return df.select(F.inline(arr))


def evaluate_rules(df: DataFrame, rules: Sequence[Rule], dataset: str, layer: str = "SILVER",
                   sample_size: int = K.DQ_SAMPLE_KEYS) -> DataFrame:
    """Violation summary rows (layer, dataset, rule_name, severity, violation_count, sample_keys).

    A rule without violations yields no row. ``sample_keys`` is the CSV header of
    the key columns followed by up to ``sample_size`` key rows, joined by `` | ``,
    keys taken in ascending key order.
    """
    viol = rule_violations(df, rules)
    counts = viol.groupBy("rule_name", "severity").agg(F.count(F.lit(1)).alias("violation_count"))
    samples = _rule_samples(df, viol, rules, sample_size)
    # rule names are unique within one call; both sides hold one row per rule
    out = counts.join(samples, "rule_name", "left")
    return out.select(F.lit(layer).alias("layer"), F.lit(dataset).alias("dataset"), "rule_name", "severity",
                      "violation_count", F.coalesce("sample_keys", F.lit("")).alias("sample_keys"))


def rule_counts(df: DataFrame, rules: Sequence[Rule], dataset: str, layer: str = "SILVER",
                include_zero: bool = False) -> DataFrame:
    """Violation count per rule (layer, dataset, rule_name, severity, violation_count)."""
    out = _rule_counts(df, rules, include_zero)
    return out.select(F.lit(layer).alias("layer"), F.lit(dataset).alias("dataset"), "rule_name", "severity",
                      "violation_count")


def _rule_counts(df: DataFrame, rules: Sequence[Rule], include_zero: bool = False) -> DataFrame:
    """All rule counts in one global aggregation (one partial row per task)."""
    aggs = [F.count_if(F.coalesce(r.predicate, F.lit(False))).alias(f"c{i}") for i, r in enumerate(rules)]
    wide = df.agg(*aggs)
    pairs = F.array(*[F.struct(F.lit(r.rule_name).alias("rule_name"), F.lit(r.severity).alias("severity"),
                               F.col(f"c{i}").alias("violation_count")) for i, r in enumerate(rules)])
    out = wide.select(F.inline(pairs))
    return out if include_zero else out.filter(F.col("violation_count") > 0)


def _rule_samples(df: DataFrame, viol: DataFrame, rules: Sequence[Rule], sample_size: int) -> DataFrame:
    """First ``sample_size`` keys per rule, in key order, as `header | row | row ...`.

    Two levels: the rows of a rule are first cut to ``sample_size`` in each of ``SHARDS`` shards, so
    what one task merges at the end does not grow with the number of tasks.
    """
    shard = F.pmod(F.xxhash64("key"), F.lit(SHARDS))
    part = Window.partitionBy("rule_name", "__shard").orderBy(F.col("sort").asc_nulls_first())
    viol = viol.withColumn("__shard", shard).withColumn("__rn", F.row_number().over(part)).filter(F.col("__rn") <= sample_size)
    w = Window.partitionBy("rule_name").orderBy(F.col("sort").asc_nulls_first())
    top = viol.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") <= sample_size)
    agg = top.groupBy("rule_name").agg(F.sort_array(F.collect_list(F.struct("__rn", "key"))).alias("__s"))
    headers = F.create_map(*[x for r in rules for x in
                             (F.lit(r.rule_name), F.lit(",".join(c for c in r.key_cols if c in df.columns)))])
    body = F.array_join(F.transform(F.col("__s"), lambda e: e["key"]), " | ")
    return agg.select("rule_name", F.concat_ws(" | ", headers[F.col("rule_name")], body).alias("sample_keys"))


# ---------------------------------------------------------------------------
# Rule sets of the source pipeline (Q1-Q11)
# ---------------------------------------------------------------------------
# Fixed values (must equal the source pipeline's): dataset, rule name, severity, sample key columns.
RULES = (
    ("meter", "PK_NOT_NULL_event_id", "CRITICAL", ("meter_id", "event_ts", "region")),
    ("meter", "PK_NOT_NULL_meter_id", "CRITICAL", ("event_id", "event_ts", "region")),
    ("meter", "NEGATIVE_KWH", "WARNING", ("event_id", "meter_id", "kwh_consumed")),
    ("meter", "INVALID_TIMESTAMP", "CRITICAL", ("event_id", "meter_id")),
    ("meter", "VOLTAGE_OUT_OF_RANGE", "WARNING", ("event_id", "meter_id", "voltage_v", "region")),
    ("telemetry", "PK_NOT_NULL_telemetry_id", "CRITICAL", ("transformer_id", "telemetry_ts", "region")),
    ("telemetry", "PK_NOT_NULL_transformer_id", "CRITICAL", ("telemetry_id", "telemetry_ts", "region")),
    ("telemetry", "INVALID_TIMESTAMP", "CRITICAL", ("telemetry_id", "transformer_id", "region")),
    ("telemetry", "OIL_TEMP_DELTA_IMPLAUSIBLE", "WARNING", ("telemetry_id", "transformer_id", "oil_temp_delta_c", "region")),
    ("billing", "PK_NOT_NULL_transaction_id", "CRITICAL", ("customer_id", "cdc_ts")),
    ("billing", "NEGATIVE_AMOUNT", "WARNING", ("transaction_id", "customer_id")),
    ("dimension", "SCD2_MULTIPLE_CURRENT_RECORDS", "CRITICAL", ("count",)),
    ("dimension", "SCD2_CURRENT_END_DATE_NOT_MAX", "WARNING", ("record_end_date", "scd_version")),
    ("gold", "GOLD_EMPTY_TABLE", "CRITICAL", ()),
)


def _rules(dataset: str, predicates: dict[str, Column], first: Sequence[str] = (), last: Sequence[str] = ()) -> list[Rule]:
    """The dataset's rules that have a predicate; ``first`` and ``last`` are key columns known only at plan time."""
    return [Rule(name, severity, predicates[name], (*first, *keys, *last))
            for d, name, severity, keys in RULES if d == dataset and name in predicates]


def meter_rules() -> list[Rule]:
    v = F.col("voltage_v")
    return _rules("meter", {
        "PK_NOT_NULL_event_id": is_blank("event_id"), "PK_NOT_NULL_meter_id": is_blank("meter_id"),
        "NEGATIVE_KWH": F.col("kwh_consumed") < 0, "INVALID_TIMESTAMP": F.col("event_ts").isNull(),
        "VOLTAGE_OUT_OF_RANGE": (v < K.VOLTAGE_MIN_V) | (v > K.VOLTAGE_MAX_V)})


def telemetry_rules() -> list[Rule]:
    return _rules("telemetry", {
        "PK_NOT_NULL_telemetry_id": is_blank("telemetry_id"), "PK_NOT_NULL_transformer_id": is_blank("transformer_id"),
        "INVALID_TIMESTAMP": F.col("telemetry_ts").isNull(),
        "OIL_TEMP_DELTA_IMPLAUSIBLE": F.col("oil_temp_delta_c") > K.OIL_DELTA_IMPLAUSIBLE_C})


def billing_rules(bills: DataFrame) -> list[Rule]:
    amount = resolve_column(bills, K.AMOUNT_CANDIDATES)
    rules = _rules("billing", {"PK_NOT_NULL_transaction_id": is_blank("transaction_id")})
    return rules + (_rules("billing", {"NEGATIVE_AMOUNT": F.col(amount) < 0}, last=(amount,)) if amount else [])


def dimension_multi_current(dim: DataFrame, key: str, dataset: str, layer: str = "SILVER") -> DataFrame:
    """SCD2_MULTIPLE_CURRENT_RECORDS (Q12): keys with more than one current row."""
    multi = dim.filter(F.col("is_current")).groupBy(key).count().filter(F.col("count") > 1)
    return evaluate_rules(multi, _rules("dimension", {"SCD2_MULTIPLE_CURRENT_RECORDS": F.lit(True)}, first=(key,)),
                          dataset, layer)


def dimension_end_date_rule(key: str) -> Rule:
    """SCD2_CURRENT_END_DATE_NOT_MAX (Q13)."""
    pred = F.col("is_current") & (F.to_date(F.col("record_end_date")) != F.to_date(F.lit(K.SCD_OPEN_END_DATE)))
    return _rules("dimension", {"SCD2_CURRENT_END_DATE_NOT_MAX": pred}, first=(key,))[0]


def empty_table_violation(df: DataFrame, dataset: str, layer: str = "GOLD") -> DataFrame:
    """GOLD_EMPTY_TABLE (Q14): one CRITICAL row when ``df`` has no rows, else none.

    Reads at most one row per partition (``limit(1)``), not the table.
    """
    _, name, severity, _ = next(r for r in RULES if r[0] == "gold")
    n = df.limit(1).agg(F.count(F.lit(1)).alias("n"))
    return n.filter(F.col("n") == 0).select(
        F.lit(layer).alias("layer"), F.lit(dataset).alias("dataset"), F.lit(name).alias("rule_name"),
        F.lit(severity).alias("severity"), F.lit(1).cast("bigint").alias("violation_count"),
        F.lit("").alias("sample_keys"))


# ---------------------------------------------------------------------------
# Coverage, integrity, bounds, counts
# ---------------------------------------------------------------------------
def join_coverage(facts: DataFrame, dim: DataFrame, key: str,
                  total_name: str = "keys_in_facts", hit_name: str = "keys_found_in_dim") -> DataFrame:
    """Distinct fact keys and how many of them exist in the dimension (one row).

    Both sides are reduced to distinct keys (partial aggregation) before the join.
    """
    f = facts.select(key).distinct()
    d = dim.select(key).distinct().withColumn("__hit", F.lit(1))
    return (f.join(d, key, "left")
             .agg(F.count(F.lit(1)).alias(total_name),
                  F.sum(F.coalesce(F.col("__hit"), F.lit(0))).cast("bigint").alias(hit_name)))


def coverage_metric(coverage: DataFrame, total_name: str, hit_name: str) -> Column:
    """Coverage rate formatted with four decimals ('0.0000' when there are no keys)."""
    rate = F.when(F.col(total_name) > 0, F.col(hit_name) / F.col(total_name)).otherwise(F.lit(0.0))
    return F.format_string("%.4f", rate)


def referential_integrity(relations: Sequence[tuple[str, DataFrame, Sequence[str], DataFrame, Sequence[str]]]) -> DataFrame:
    """Orphan report, one row per relationship ``(name, child, fk, parent, pk)``:
    child_rows, null_fk_rows, orphan_rows, orphan_keys.

    The child is first reduced to one row per foreign-key value with its row count
    (partial aggregation: a hot key collapses before the shuffle), then matched
    against the parent's distinct keys; no row-level join of the two tables.
    """
    parts = []
    for name, child, fk, parent, pk in relations:
        per_key = child.groupBy(*fk).agg(F.count(F.lit(1)).alias("__n"))
        pkeys = parent.select(*[F.col(p).alias(f) for p, f in zip(pk, fk)]).distinct().withColumn("__hit", F.lit(True))
        null_fk = None
        for f in fk:
            null_fk = F.col(f).isNull() if null_fk is None else (null_fk | F.col(f).isNull())
        j = per_key.join(pkeys, list(fk), "left")
        orphan = ~null_fk & F.col("__hit").isNull()
        parts.append(j.agg(
            F.lit(name).alias("relationship"),
            F.coalesce(F.sum("__n"), F.lit(0)).cast("bigint").alias("child_rows"),
            F.coalesce(F.sum(F.when(null_fk, F.col("__n"))), F.lit(0)).cast("bigint").alias("null_fk_rows"),
            F.coalesce(F.sum(F.when(orphan, F.col("__n"))), F.lit(0)).cast("bigint").alias("orphan_rows"),
            F.count_if(orphan).alias("orphan_keys")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def time_bounds(sources: Sequence[tuple[str, DataFrame, str]]) -> DataFrame:
    """min/max event time per source ``(name, df, ts_col)`` (one global aggregate each)."""
    parts = [df.agg(F.lit(name).alias("source"), F.min(ts).alias("min_ts"), F.max(ts).alias("max_ts"))
             for name, df, ts in sources]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def row_counts(tables: Sequence[tuple[str, str, DataFrame]]) -> DataFrame:
    """Row count per ``(layer, table, df)``; all counts run as one job."""
    parts = [df.agg(F.lit(layer).alias("layer"), F.lit(name).alias("table_name"),
                    F.count(F.lit(1)).alias("row_count")) for layer, name, df in tables]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def metric_rows(spark, batch_id: str, rows: Sequence[tuple[str, str, str, str]]) -> DataFrame:
    """Audit metric rows (batch_id, layer, table_fqn, metric_name, metric_value) from literals."""
    return spark.createDataFrame([(batch_id, *r) for r in rows], K.AUDIT_METRICS_SCHEMA)


def dq_report(violations: DataFrame, batch_id: str | None = None) -> DataFrame:
    """Violations of one run, CRITICAL first, then dataset and rule (O1)."""
    v = violations if batch_id is None or "batch_id" not in violations.columns else \
        violations.filter(F.col("batch_id") == batch_id)
    sev = F.when(F.col("severity") == "CRITICAL", 1).when(F.col("severity") == "WARNING", 2).otherwise(3)
    return v.orderBy(sev, "dataset", "rule_name")


def metrics_report(metrics: DataFrame, batch_id: str | None = None) -> DataFrame:
    """Metrics of one run ordered by layer, table, metric (O2)."""
    m = metrics if batch_id is None else metrics.filter(F.col("batch_id") == batch_id)
    return m.select("layer", "table_fqn", "metric_name", "metric_value").orderBy("layer", "table_fqn", "metric_name")
