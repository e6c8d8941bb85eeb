"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

1. ``source_targets``: sources in code-point order get weights, share the total size by them, and stop
   at ``limit`` times their own size; the excess is shared again until no source is above. A round
   is one aggregation over the table of sources.
2. ``place``: the documents of a source lie one after another in the order of a seeded hash. Starts
   are prefix sums over a range-partitioned order (running sums inside each task, plus a sum over
   the tasks before it), so a source that holds a third of all rows is spread over many tasks.
3. Quotas: a source's stream is its documents repeated; its first ``target`` words, cut into blocks of
   ``block_words``, are its exact quota (the last block may be shorter). Each repetition ends before
   the next begins, so no document is taken more than ``limit`` times.
4. ``split_quotas``: a tree over the output shards. A node holds a number of blocks of each source; how
   many of each go to its left half is one multivariate-hypergeometric draw, the rest go right. Every
   shard ends with an exact count of each source and every block is counted once. A stage of the
   tree is a grouping by node; a task holds one node, that is one number for each source, and descends
   ``LEVELS`` levels at once.
5. ``draw_blocks``: a seeded permutation of each source's blocks (a Feistel network, computed without
   any shuffle) turns a shard's interval of slots into the blocks that it draws; intervals are
   disjoint, so blocks are. Blocks join the pieces of documents that lie in them.
6. Pieces are put in a random order inside each shard, which holds ``shard_words`` words.

All draws are seeded by (seed, node) and by the sources' names and documents, so reruns agree. Copies of a row
(same source, id, text) are counted and placed together.

Defined results: a null or empty text has size 0 and is never taken; a null source is the last one; a
source without words has target 0; repeated rows each take their part; equal hashes fall back to
the id and the size; an empty table gives an empty result; other columns are carried by no step, so
their names never clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voltaic.llm.common import store

WEIGHTS = (5, 2, 1)
#: No source's target is above this many times its size.
LIMIT = 3
BLOCK_WORDS = 2048
SHARD_WORDS = 1 << 20
SEED = 20240607
#: Levels of the splitting tree that one task descends.
LEVELS = 10
#: Blocks grow beyond ``BLOCK_WORDS`` where there would be more of them: hypergeometric draws take counts below 10**9.
MOST_BLOCKS = 1 << 29

WORD = r"[^\x20\x09-\x0D]+"


class Mix(NamedTuple):
    """What ``mix`` finds; all are stored or derive from stored rows."""

    #: ``no, source, source_size, weight, target, quota`` (whole words), one row per source.
    sources: DataFrame
    #: ``no, doc_id, size, mark, copy, start``: each row's place in its source.
    places: DataFrame
    #: ``shard, position, no, block, epoch, start, doc_id, mark, copy, from_word, n_words``: what the mix takes.
    pieces: DataFrame


def numbered(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``df`` with a running number from 0 in the given order; no task sees more than its range of rows."""
    ranged = store(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__id", F.monotonically_increasing_id()))
    part, row = F.shiftright("__id", 33), F.col("__id").bitwiseAND(F.lit((1 << 33) - 1))
    counts = ranged.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()  # one row per partition
    before, total = {}, 0
    for r in sorted(counts, key=lambda r: r["part"]):
        before[r["part"]], total = total, total + r["n"]
    if not before:
        return ranged.withColumn(name, row).drop("__id")
    base = F.create_map(*[F.lit(x).cast("bigint") for kv in before.items() for x in kv])
    return ranged.withColumn(name, base[part] + row).drop("__id")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, limit: int = LIMIT) -> DataFrame:
    """``no, source, source_size, weight, target, quota`` from ``source, source_size`` (one row per source)."""
    sources = numbered(sizes, [F.asc_nulls_last("source")], "no")
    weight = F.element_at(F.array(*[F.lit(w).cast("bigint") for w in weights]), (F.col("no") % len(weights) + 1).cast("int"))
    sources = store(sources.select("no", "source", "source_size", weight.alias("weight")))
    total, left, open_weight = None, 0, 0
    full = F.lit(False)
    while True:
        found = sources.agg(
            F.sum("source_size"), F.sum(F.when(full, 0).otherwise(F.col("weight"))), F.sum(F.when(full, F.col("source_size")).otherwise(0)),
        ).first()
        total = found[0] or 0
        rest, open_before = total - limit * (found[2] or 0), open_weight
        left, open_weight = rest, found[1] or 0
        if open_weight in (0, open_before):
            break
        share = F.col("weight") * F.lit(float(left)) / F.lit(float(open_weight))
        full = limit * F.col("source_size") <= share
    share = F.col("weight") * F.lit(float(left)) / F.lit(float(open_weight or 1))
    target = F.least(F.when(full, limit * F.col("source_size")).otherwise(share), limit * F.col("source_size")).cast("double")
    return store(sources.withColumn("target", target).withColumn("quota", F.floor(F.col("target") + 0.5).cast("bigint")))


def _running(rows: DataFrame) -> DataFrame:
    """Sorted rows with ``task`` and ``before``: the words of their source that lie before them in the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, source, carried = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            no = batch.column("no").to_numpy()
            words = batch.column("size").to_numpy() * batch.column("copies").to_numpy()
            ahead = np.cumsum(words) - words
            first = np.flatnonzero(np.r_[True, no[1:] != no[:-1]])
            base = np.repeat(ahead[first], np.diff(np.r_[first, len(no)]))
            before = ahead - base
            if no[0] == source:
                before[: first[1] if len(first) > 1 else len(no)] += carried
            source, carried = no[-1], int(before[-1] + words[-1])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(len(no), task, np.int32)), pa.array(before)], names=[*batch.schema.names, "task", "before"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.mapInArrow(run, f"{kinds}, task int, before bigint")


def place(rows: DataFrame) -> DataFrame:
    """``no, doc_id, size, mark, copy, start`` from ``no, doc_id, size, mark, copies``."""
    order = ["no", "mark", "doc_id", "size"]
    running = store(_running(rows.repartitionByRange(*order).sortWithinPartitions(*order)))
    tasks = running.groupBy("no", "task").agg(F.sum(F.col("size") * F.col("copies")).alias("words"))
    ahead = Window.partitionBy("no").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)  # one row per task
    tasks = tasks.select("no", "task", F.coalesce(F.sum("words").over(ahead), F.lit(0)).alias("ahead"))
    placed = running.join(tasks, ["no", "task"])
    copy = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("copies") - 1)).alias("copy")
    placed = placed.select("no", "doc_id", "size", "mark", (F.col("ahead") + F.col("before")).alias("base"), copy)
    return placed.select("no", "doc_id", "size", "mark", "copy", (F.col("base") + F.col("copy") * F.col("size")).alias("start"))


def split_node(low: int, high: int, blocks: np.ndarray, slots: np.ndarray, levels: int, seed: int) -> list[tuple[int, int, np.ndarray, np.ndarray]]:
    """The nodes ``(low, high, blocks, first slots)`` that ``levels`` levels below shards ``low`` to ``high - 1`` hold."""
    if high - low == 1 or not levels:
        return [(low, high, blocks, slots)]
    middle = (low + high) // 2
    total = int(blocks.sum())
    left = total * (middle - low) // (high - low)
    rng = np.random.default_rng([seed, low, high])
    drawn = rng.multivariate_hypergeometric(blocks, left, method="marginals") if left else np.zeros_like(blocks)
    return split_node(low, middle, drawn, slots, levels - 1, seed) + split_node(middle, high, blocks - drawn, slots + drawn, levels - 1, seed)


def split_quotas(quotas: DataFrame, shards: int, seed: int = SEED, levels: int = LEVELS) -> DataFrame:
    """``shard, no, first, blocks``: the exact number of blocks of each source in each shard, and its first slot."""

    def descend(node: pd.DataFrame) -> pd.DataFrame:
        node = node.sort_values("no")
        no = node["no"].to_numpy()
        below = split_node(int(node["low"].iloc[0]), int(node["high"].iloc[0]), node["blocks"].to_numpy(), node["first"].to_numpy(), levels, seed)
        parts = [pd.DataFrame({"low": a, "high": b, "no": no, "first": s, "blocks": n})[n > 0] for a, b, n, s in below]
        return pd.concat(parts, ignore_index=True)

    kinds = "low bigint, high bigint, no bigint, first bigint, blocks bigint"
    nodes = quotas.filter("blocks > 0").selectExpr("0L as low", f"{shards}L as high", "no", "0L as first", "blocks")
    width = shards
    while width > 1:
        nodes = store(nodes.groupBy("low", "high").applyInPandas(descend, kinds))
        width = -(-width // (1 << levels))
    return nodes.select(F.col("low").alias("shard"), "no", "first", "blocks")


def permuted(slots: np.ndarray, size: np.ndarray, key: np.ndarray) -> np.ndarray:
    """A permutation of 0 to ``size - 1`` at ``slots``, another for each key: a four-round Feistel network,
    applied again to what falls outside (at most three in four do, so few times)."""
    half = np.ones(len(slots), np.uint64)
    while (short := (np.uint64(1) << (2 * half)) < size.astype(np.uint64)).any():
        half += short
    mask = (np.uint64(1) << half) - np.uint64(1)
    out, todo = slots.astype(np.uint64), np.arange(len(slots))
    while len(todo):
        left, right = out[todo] >> half[todo], out[todo] & mask[todo]
        for turn in range(4):
            mixed = (right + key[todo].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(turn + 1)) * np.uint64(0xBF58476D1CE4E5B9)
            mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
            left, right = right, left ^ ((mixed ^ (mixed >> np.uint64(29))) & mask[todo])
        out[todo] = (left << half[todo]) | right
        todo = todo[out[todo] >= size[todo].astype(np.uint64)]
    return out.astype(np.int64)


def draw_blocks(shards: DataFrame, quotas: DataFrame, seed: int = SEED) -> DataFrame:
    """``no, block, shard``: the blocks that each shard draws."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shard, no, first, blocks, total = (batch.column(c).to_numpy() for c in ("shard", "no", "first", "blocks", "total"))
            ends = np.cumsum(blocks)
            row = np.repeat(np.arange(len(blocks)), blocks)
            slots = first[row] + np.arange(len(row)) - (ends - blocks)[row]
            drawn = permuted(slots, total[row], no[row] + seed)
            yield pa.RecordBatch.from_arrays([pa.array(no[row]), pa.array(drawn), pa.array(shard[row])], names=["no", "block", "shard"])

    rows = shards.join(quotas.select("no", F.col("blocks").alias("total")), "no")
    return rows.select("shard", "no", "first", "blocks", "total").mapInArrow(run, "no bigint, block bigint, shard bigint")


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, limit: int = LIMIT, shard_words: int = SHARD_WORDS, block_words: int = BLOCK_WORDS, seed: int = SEED) -> Mix:
    """The mix of all ``docs`` (``doc_id, source, text``)."""
    text = F.col("text").cast("string")
    size = F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")
    rows = docs.select(F.col("source").cast("string").alias("source"), "doc_id", size.alias("size"), document_mark(seed).alias("mark"))
    rows = store(rows.groupBy("source", "doc_id", "size", "mark").agg(F.count(F.lit(1)).alias("copies")))
    sources = source_targets(rows.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("source_size")), weights, limit)
    named = rows.join(sources.select("no", F.col("source").alias("__source")), F.col("source").eqNullSafe(F.col("__source")))
    places = store(place(named.select("no", "doc_id", "size", "mark", "copies")))

    words = sources.agg(F.sum("quota")).first()[0] or 0
    block = max(block_words, -(-words // MOST_BLOCKS))
    quotas = sources.select("no", F.expr(f"(quota + {block - 1}) div {block}").alias("blocks"))
    count = quotas.agg(F.sum("blocks")).first()[0] or 0
    shards = max(1, min(count, -(-count * block // shard_words)))
    drawn = store(draw_blocks(split_quotas(quotas, shards, seed), quotas, seed))

    streams = places.filter("size > 0").join(sources.select("no", "source_size", "quota"), "no")

    def spans(epoch: Column) -> Column:
        low = epoch * F.col("source_size") + F.col("start")
        high = F.least(low + F.col("size"), F.col("quota"))
        first, last = F.floor(low / block), F.floor((high - 1) / block)

        def span(k: Column) -> Column:
            a, b = F.greatest(low, k * block), F.least(high, (k + 1) * block)
            return F.struct(epoch.cast("int").alias("epoch"), k.cast("bigint").alias("block"), (a - low).cast("bigint").alias("from_word"), (b - a).cast("bigint").alias("n_words"))

        return F.when(low < high, F.transform(F.sequence(first, last), span)).otherwise(F.array().cast("array<struct<epoch:int,block:bigint,from_word:bigint,n_words:bigint>>"))

    taken = F.flatten(F.transform(F.sequence(F.lit(0).cast("bigint"), F.lit(limit - 1).cast("bigint")), spans))
    cut = streams.select("no", "start", "doc_id", "mark", "copy", F.explode(taken).alias("s")).select("no", "start", "doc_id", "mark", "copy", "s.*")
    pieces = cut.join(drawn, ["no", "block"])
    order = Window.partitionBy("shard").orderBy(F.xxhash64(F.lit(seed), "shard", "no", "start", "epoch", "block"), "no", "start", "epoch", "block")
    pieces = pieces.withColumn("position", (F.row_number().over(order) - 1).cast("bigint"))
    return Mix(sources, places, pieces)


def document_mark(seed: int = SEED) -> Column:
    """What orders the documents of a source, and names a document together with its id."""
    return F.xxhash64(F.lit(seed), F.col("source").cast("string"), F.col("doc_id").cast("string"), F.col("text").cast("string"))


def mixed_texts(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: ``shard, position, doc_id, text``; a document that a block cuts gives its words, joined by spaces."""
    found = mix(docs, **options)
    mark = document_mark(options.get("seed", SEED))
    texts = docs.select(F.col("doc_id").alias("__doc"), mark.alias("__mark"), F.col("text").cast("string").alias("text")).dropDuplicates(["__doc", "__mark"])
    pieces = found.pieces.join(found.places.select("no", "start", "size").filter("size > 0"), ["no", "start"])
    whole = pieces.join(texts, pieces["doc_id"].eqNullSafe(F.col("__doc")) & (pieces["mark"] == F.col("__mark")))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    part = F.array_join(F.slice(words, (F.col("from_word") + 1).cast("int"), F.col("n_words").cast("int")), " ")
    return whole.select("shard", "position", "doc_id", F.when(F.col("n_words") == F.col("size"), F.col("text")).otherwise(part).alias("text"))


def digest(docs: DataFrame) -> DataFrame:
    found = mix(docs.select("doc_id", "source", "text"))
    taken = found.pieces.groupBy("no", F.col("start").alias("at")).agg(F.sum("n_words").alias("words"), F.min(F.struct("shard", "position")).alias("first"))
    places = found.places.withColumn("at", F.when(F.col("size") > 0, F.col("start")))
    rows = places.join(taken, ["no", "at"], "left").join(found.sources.select("no", "source_size", "target"), "no")
    return rows.select(
        "doc_id", "size", "source_size", "target", F.coalesce("words", F.lit(0)).cast("bigint").alias("taken"),
        F.col("first.shard").alias("first_shard"), F.col("first.position").alias("first_position"),
    )
