"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

A text's features are the hashes of its words (whole, and cut to stems of a few bytes, so that
inflected forms share evidence), word pairs and pairs with one word between, each counted as present or
absent, of the whole text. Spark extracts them where the documents lie. The
classifier is fitted on a bounded, documented sample of labelled rows (``SAMPLE``, those whose id hashes
lowest) in one task: FTRL-proximal keeps a learning rate for each coordinate, and L1 sets most weights
to exactly zero, so the non-zero ones are a small table that every scoring task receives.

Defined results: a null or empty text has no features and gets the bias alone; labels that are
null are no labels; an id labelled twice is toxic if any label says so; without labels every score is
the bias of an untrained model (0.5 before the prior, see ``fit``); repeated rows are scored each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltaic.llm.common import doc_crc, words_of

FOLDS, HELD_OUT = 4, 2
#: Labelled rows that the classifier is fitted on at most, each id once, and features of all of them together
#: (about 250 MB): rows are taken in the order of their ids' hashes while both bounds hold.
SAMPLE = 12_000
SAMPLE_FEATURES = 60_000_000
SPACE_BITS = 20
ALPHA, BETA, L1, L2 = 1.0, 1.0, 4.0, 0.5
#: Lengths in bytes of the stems that longer words are cut to.
STEMS = (6, 8)
EPOCHS = 3
THRESHOLD = 0.3
#: Signs at a word's ends that are not part of it.
EDGES = b".,;:!?\"'()[]{}<>*#$%&|-_/\\"
BIAS = 0


def features(text: str | None) -> np.ndarray:
    """Hashed features of a whole text, repeats included; 0 (the bias) is not among them."""
    words = [w for w in (w.strip(EDGES) for w in words_of(text)) if w]
    h = np.array([*map(xxhash.xxh3_64_intdigest, words)], np.uint64)
    a, b, shift = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(64 - SPACE_BITS)
    stems = [np.array([*map(xxhash.xxh3_64_intdigest, {w[:n] for w in words if len(w) > n})], np.uint64) * np.uint64(2 * n + 1) for n in STEMS]
    pairs = (h[:-1] ^ (h[:-1] >> np.uint64(29))) * a + h[1:]
    skips = (h[:-2] ^ (h[:-2] >> np.uint64(31))) * b + h[2:]
    return np.maximum(np.concatenate([h, *stems, pairs * a, skips * b]) >> shift, 1).astype(np.int32)


def labelled(labels: DataFrame, limit: int = SAMPLE) -> DataFrame:
    """At most ``limit`` training rows ``doc_id, toxic``: those that hash lowest outside the held-out fold."""
    rows = labels.filter("toxic is not null and doc_id is not null").filter(doc_crc() % FOLDS != HELD_OUT)
    rows = rows.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    return rows.orderBy(F.xxhash64(F.col("doc_id").cast("string")), "doc_id").limit(limit)


class Ftrl:
    """Per-coordinate FTRL-proximal for presence features."""

    def __init__(self, size: int):
        self.z, self.n = np.zeros(size), np.zeros(size)

    def weights(self, at: np.ndarray) -> np.ndarray:
        z = self.z[at]
        l1 = np.where(at == BIAS, 0.0, L1)
        return np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((BETA + np.sqrt(self.n[at])) / ALPHA + L2))

    def learn(self, at: np.ndarray, label: int) -> None:
        w = self.weights(at)
        g = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - label
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / ALPHA * w
        self.n[at] = n + g * g


def learned(rows: Iterator[tuple[bytes, int]], epochs: int = EPOCHS, most: int = SAMPLE_FEATURES) -> tuple[np.ndarray, np.ndarray]:
    """Places (ascending) and values of the non-zero weights after ``epochs`` passes over ``(feature places, label)``."""
    kept, size = [], 0
    for places, label in rows:
        size += len(places) // 4
        if size > most:
            break
        kept.append((places, int(label)))
    model = Ftrl(1 << SPACE_BITS)
    for _ in range(epochs):
        for places, label in kept:
            model.learn(np.concatenate([[BIAS], np.frombuffer(places, "<i4")]), label)
    w = model.weights(np.arange(1 << SPACE_BITS))
    return np.flatnonzero(w), w[np.flatnonzero(w)]


def fit(docs: DataFrame, labels: DataFrame, limit: int = SAMPLE) -> tuple[np.ndarray, np.ndarray]:
    """The non-zero weights: places (ascending) and values. One task learns from at most ``limit`` rows.

    Of rows that share an id one is taken, the one whose text hashes lowest.
    """
    chosen = labelled(labels, limit)
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(chosen), "doc_id")
    rows = rows.groupBy("doc_id", "toxic").agg(F.min(F.struct(F.xxhash64("text"), "text"))["text"].alias("text"))

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            each = [np.unique(features(t.as_py())).astype("<i4").tobytes() for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays([batch.column(2), batch.column(1), pa.array(each, pa.binary())], names=["at", "toxic", "places"])

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = ((places.as_py(), label.as_py()) for b in batches for places, label in zip(b.column(2), b.column(1), strict=True))
        places, values = learned(rows)
        yield pa.RecordBatch.from_arrays([pa.array(places.astype(np.int64)), pa.array(values)], names=["place", "weight"])

    rows = rows.select("text", F.col("toxic").cast("int").alias("toxic"), F.xxhash64(F.lit(1), F.col("doc_id").cast("string")).alias("at"))
    found = rows.mapInArrow(extract, "at long, toxic int, places binary")
    in_order = found.repartition(1).sortWithinPartitions("at", "places")
    weights = in_order.mapInArrow(learn, "place long, weight double").toArrow()
    places, values = weights["place"].to_numpy(), weights["weight"].to_numpy()
    order = np.argsort(places)
    return places[order], values[order]


def score(docs: DataFrame, weights: tuple[np.ndarray, np.ndarray], text_col: str = "text") -> DataFrame:
    """``docs`` with ``toxicity`` (0 to 1) added."""

    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        dense = np.zeros(1 << SPACE_BITS)
        dense[weights[0]] = weights[1]
        for texts in batches:
            out = np.empty(len(texts))
            for i, text in enumerate(texts):
                at = features(text)
                at = np.unique(at[dense[at] != 0])
                out[i] = 1 / (1 + np.exp(-np.clip(dense[BIAS] + dense[at].sum(), -35, 35)))
            yield pd.Series(out)

    return docs.withColumn("toxicity", run(F.col(text_col).cast("string")))


def digest(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    scored = score(docs.select("doc_id", "text"), fit(docs, labels))
    return scored.select(
        "doc_id", (doc_crc() % FOLDS == HELD_OUT).alias("held_out"), F.col("toxicity").alias("score"), (F.col("toxicity") >= THRESHOLD).cast("int").alias("predicted")
    )


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` (all columns) that score below the threshold."""
    scored = score(docs.select(F.struct(*docs.columns).alias("row"), F.col("text")), fit(docs, labels))
    return scored.filter(F.col("toxicity") < threshold).select("row.*")
