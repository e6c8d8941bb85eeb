"""SimHash near-duplicates, searched with pivot distance tables.

A fingerprint holds, per bit, the majority over the XXH64 hashes of a text's word shingles. Two
fingerprints link when at most ``max_bits`` (2) bits differ; groups are the connected components.

Search. Exact copies collapse to one node per distinct fingerprint first, so a text that is a third
of all rows costs one node. Two of four 16-bit blocks agree in every linked pair, so nodes meet in
buckets keyed by two blocks. Inside a bucket the pivot table decides: every node carries its
precomputed Hamming distances to many reference fingerprints, a pair whose largest coordinate
difference exceeds ``max_bits`` cannot link (triangle inequality) and is discarded, and the survivors
are verified by counting the bits that differ. Buckets above ``BUCKET`` members never form all
pairs: their nodes meet at the fingerprints one bit away from them (two nodes within two bits share
such a point), each node is paired with the smallest node at that point, and the same pivot test and
verification follow. Where only one bit may differ, the node that is the point itself takes the smallest one's place. No partner is dropped, and the work stays linear in a group's size.

Defined results: a null, empty or blank text has fingerprint zero and links like any other; a text of
fewer words than a shingle is one shingle; repeated rows share a group; a null id never becomes a
group's id unless all its ids are null; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltaic.llm.common import store, words_of

SHINGLE = 3
MAX_BITS = 2
SEED = 42
#: Buckets up to this size form their pairs; larger ones meet at one-bit neighbours instead.
BUCKET = 16
#: Reference fingerprints: the first of a fixed pseudo-random sequence.
N_PIVOTS = 24
PIVOTS = [xxhash.xxh64_intdigest(i.to_bytes(4, "little"), 7) - (1 << 63) for i in range(N_PIVOTS)]


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The unsigned 64-bit fingerprint of one text."""
    words = words_of(text)
    if not words:
        return 0
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return digest(joined, SEED)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = [0, *ends[:-1].tolist()]
    hashes = [digest(joined[a:b], SEED) for a, b in zip(starts, (ends - 1).tolist()[shingle - 1 :], strict=False)]
    counts, step = np.zeros(64, np.int64), 1 << 14
    for at in range(0, len(hashes), step):
        part = np.array(hashes[at : at + step], "<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * counts > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprint_udf(shingle: int = SHINGLE):
    """Column function: text -> fingerprint as a (signed) long."""

    @F.pandas_udf("long")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(np.array([fingerprint(t, shingle) for t in texts], np.uint64).view(np.int64), dtype="int64")

    return run


def _pivot_table(fps: DataFrame) -> DataFrame:
    """Adds ``coord``: the Hamming distances of ``fp`` to every reference fingerprint."""
    return fps.withColumn("coord", F.array(*[F.bit_count(F.col("fp").bitwiseXOR(F.lit(p))).cast("byte") for p in PIVOTS]))


def _verified(pairs: DataFrame, max_bits: int) -> DataFrame:
    """Of candidate pairs ``(a, b)`` of (fp, coord), those that pivots cannot exclude and that link."""
    near = F.forall(F.zip_with("a.coord", "b.coord", lambda x, y: F.abs(x - y)), lambda d: d <= max_bits)
    links = F.bit_count(F.col("a.fp").bitwiseXOR(F.col("b.fp"))) <= max_bits
    return pairs.filter(near).filter(links).select(F.col("a.fp").alias("u"), F.col("b.fp").alias("v"))


def linked_fingerprints(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Edges ``(u, v)``, u != v, whose components are those of all links between distinct ``fp``."""
    if not 0 <= max_bits <= 2:
        raise ValueError("the buckets are exact for at most two differing bits")
    nodes = _pivot_table(fps.select("fp").distinct())
    block = [F.shiftrightunsigned("fp", 16 * i).bitwiseAND(F.lit(0xFFFF)) for i in range(4)]
    two = [(i, j) for i in range(4) for j in range(i + 1, 4)]
    keys = F.array(*[F.lit(k << 32).bitwiseOR(F.shiftleft(block[i], 16)).bitwiseOR(block[j]) for k, (i, j) in enumerate(two)])
    members = nodes.select(F.explode(keys).alias("key"), F.struct("fp", "coord").alias("n"))
    sizes = members.groupBy("key").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    members = store(members.join(sizes, "key"))
    small = members.filter(F.col("size") <= BUCKET)
    pairs = (
        small.select("key", F.col("n").alias("a"))
        .join(small.select("key", F.col("n").alias("b")), "key")
        .filter("a.fp < b.fp")
        .select("a", "b")
    )
    crowded = members.filter(F.col("size") > BUCKET).select("n").distinct()
    flips = F.array(F.lit(0), *[F.lit((1 << i) - (1 << 64) * (i == 63)) for i in range(64)])
    points = crowded.select("n", F.explode(F.transform(flips, lambda f: f.bitwiseXOR(F.col("n.fp")))).alias("point"))
    if max_bits == 2:
        centres = points.groupBy("point").agg(F.min("n").alias("a"), F.count(F.lit(1)).alias("size")).filter("size > 1")
    else:  # the smallest node at a point may be two bits away: the node at the point itself links with all others there
        centres = crowded.select(F.col("n.fp").alias("point"), F.col("n").alias("a"))
    stars = points.withColumnRenamed("n", "b").join(centres, "point").filter("a.fp <> b.fp").select("a", "b")
    return store(_verified(pairs, max_bits).unionByName(_verified(stars, max_bits)).distinct())


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges(u, v)``; root is the smallest node of its component.

    Alternating large-star and small-star rounds; each round's edges are written to the shared
    folder, and a round is a grouping and a join by node, so no component is ever gathered in one task.
    """

    def signature(e: DataFrame):
        return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    def star(e: DataFrame, large: bool) -> DataFrame:
        if large:
            e = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        else:
            e = e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = e.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        out = e.join(least, "u")
        if large:
            out = out.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        else:
            out = out.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        return out.filter("u <> v").distinct()

    before = signature(edges)
    while before[0]:
        edges = store(star(star(edges, True), False))
        after = signature(edges)
        if after == before:
            break
        before = after
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return stars.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def simhash_groups(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, fp`` (signed long), ``root`` (a group's fingerprint), ``component_id``."""
    marked = store(docs.select(F.col(id_col).alias("doc_id"), fingerprint_udf(shingle)(F.col(text_col)).alias("fp")))
    return group_fingerprints(marked, max_bits)


def group_fingerprints(marked: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """``doc_id, fp`` with ``root`` and ``component_id`` (smallest id that links reach) added."""
    firsts = marked.groupBy("fp").agg(F.min("doc_id").alias("first"))
    roots = components(linked_fingerprints(marked, max_bits))
    named = firsts.join(roots, firsts.fp == roots.node, "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    least = named.groupBy("root").agg(F.min("first").alias("component_id"))
    return marked.join(named.join(least, "root").select("fp", "root", "component_id"), "fp").select("doc_id", "fp", "root", "component_id")


def keep_one_per_group(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs`` (all columns) without near-duplicates: of each group the smallest ``doc_id`` stays.

    Several rows with that id (repeated rows) leave one. A group whose ids are all null keeps one row.
    """
    names = docs.columns
    marked = docs.withColumn("__fp", fingerprint_udf(shingle)(F.col("text")))
    ids = store(marked.select("doc_id", F.col("__fp").alias("fp")))
    grouped = group_fingerprints(ids, max_bits)
    winners = grouped.filter(F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy("root").agg(F.min(F.struct("doc_id", "fp")).alias("w"))
    winners = winners.select(F.col("w.doc_id").alias("__id"), F.col("w.fp").alias("__wfp"))
    if ids.count() == ids.select("doc_id").distinct().count() and not ids.filter("doc_id is null").limit(1).count():
        return docs.join(winners, docs["doc_id"] == F.col("__id")).select(*names)
    # ids that repeat or are null name no row: the fingerprint is part of the key, so null ids are no hot key
    kept = marked.join(winners, marked["doc_id"].eqNullSafe(F.col("__id")) & (marked["__fp"] == F.col("__wfp")))
    return kept.dropDuplicates(["__id", "__wfp"]).select(*names)


def digest(spark: SparkSession, docs: DataFrame) -> DataFrame:
    groups = simhash_groups(docs)
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
