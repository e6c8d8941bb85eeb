"""Language-model scoring with a log-frequency Bloom filter.

Counting. Each task counts the hashed words (and an end mark) and word pairs of its training texts in
numpy and sends partial counts to the bucket of each key, where they are summed. A word is named by its 64-bit XXH3 hash.

The model. Counts are quantised on a logarithmic scale: an n-gram of count c has ``level(c) =
1 + floor(log_B c)`` and enters the Bloom filter once per level, under (n-gram, level). A query probes
levels 1, 2, ... until one is missing; the last present level gives the count back as the middle of
its range. The probability of a word after the word before it interpolates both orders with the
fixed weight ``LAMBDA``: ``LAMBDA * min(1, c(h, w) / c(h)) + (1 - LAMBDA) * (c(w) + 0.5) / (N + 0.5 (V + 1))``,
all counts read from the filter; a text starts after an end mark.

Size. The whole model is a Bloom filter of all words and pairs, those that occur once included. It has as
many buckets as the training text needs (one for each ``BUCKET_CHARS`` code points) and ``BITS`` bits for each
entry, so its false positives do not grow with the corpus. An n-gram's bucket follows from its key; a bucket is
counted and built by one task and stays in storage. Besides, the frequent n-grams are in a broadcast filter of at
most ``MAX_FILTER_BYTES``: pairs of ``cutoff`` levels or more and words of one level less, with the least cutoff (2 or
more) with which they fit. An n-gram that the broadcast filter does not give such a level is looked up in its
bucket: each batch of texts sends each such n-gram once, and the levels come back to the batch. The bound thus
decides where an n-gram is looked up and not whether.

Base score. Word counts are exact, whatever the filter holds: the most frequent words, at most
``HEAD`` of them, are looked up in a broadcast table; each text's other words go as (row, word) through a
join with all counts and come back as sums per row. Every word is covered by one of the two.

Defined results: a null or empty text is the end mark alone; a null id counts as the empty text in the
hash that splits the rows; repeated rows count and are scored each; without training rows N and V
are zero; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from voltaic.llm.common import doc_crc, least_count, store, words_of

FOLDS, HELD_OUT = 5, 1
B = 2.0
LAMBDA = 0.3
#: Bits for each filter entry, and probes by entry: about one false positive in 50 at level 1.
BITS, PROBES = 10, 5
SEGMENT_BITS = 1 << 22
MAX_FILTER_BYTES = 128 << 20
#: Code points of training text for each bucket of the whole filter.
BUCKET_CHARS = 4_000_000
#: A word's level that its bucket has to tell.
OPEN = 255
#: Most words in the broadcast table of exact counts: 16 MB.
HEAD = 1 << 20
#: Hashes gathered in a task before it sends partial counts.
GATHER = 1_500_000
#: Rows that a task hands over together; bytes that it gathers for a stored file before it writes them.
ROWS, BLOCK_BYTES = 1 << 15, 8 << 20
#: Documents that look up their n-grams together, and about how many code points they have at most.
UNIT, UNIT_CHARS = 500, 2_000_000
END = np.uint64(0x9E3779B97F4A7C15)
WORD, PAIR = 0, 1
M1, M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * M1
    x = (x ^ (x >> np.uint64(27))) * M2
    return x ^ (x >> np.uint64(31))


def hashed(text: str | None) -> np.ndarray:
    """The text's tokens: a hash for each word, then the end mark."""
    digest = xxhash.xxh3_64_intdigest
    return np.array([*map(digest, words_of(text)), int(END)], np.uint64)


def pair_keys(tokens: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The key of each token together with the one before it; the first of a text follows an end mark."""
    before = np.empty_like(tokens)
    before[1:] = tokens[:-1]
    before[starts] = END
    return mix(before * M1 + np.uint64(1)) ^ tokens


def level(count: np.ndarray) -> np.ndarray:
    return 1 + np.floor(np.log(np.maximum(count, 1)) / np.log(B) + 1e-9).astype(np.int64)


def middle(levels: np.ndarray) -> np.ndarray:
    """The count that a level stands for (0: absent): the geometric middle of its whole numbers."""
    low = np.ceil(B ** (levels - 1.0) - 1e-9)
    high = np.maximum(np.ceil(B ** (levels * 1.0) - 1e-9) - 1, low)
    return np.where(levels > 0, np.sqrt(low * high), 0.0)


def _entry(keys: np.ndarray, kind: int, at: int) -> np.ndarray:
    return mix(keys + np.uint64((0x632BE59BD9B4E019 * (2 * at + kind)) % (1 << 64)))


def _places(entries: np.ndarray, probe: int, size: int = SEGMENT_BITS) -> np.ndarray:
    """The bit of the probe inside an entry's segment of ``size`` bits."""
    return (mix(entries + np.uint64((probe + 1) * int(M2) % (1 << 64))) % np.uint64(size)).astype(np.int64)


def present(filter_bytes: np.ndarray, base: np.ndarray, entries: np.ndarray, size: int = SEGMENT_BITS) -> np.ndarray:
    """Whether the filter holds ``entries``, whose segments of ``size`` bits begin at the bits ``base``."""
    found = np.ones(len(entries), bool)
    for probe in range(PROBES):
        bit = base + _places(entries, probe, size)
        found &= (filter_bytes[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 > 0
    return found


def probe_levels(filter_bytes: np.ndarray, base: np.ndarray, keys: np.ndarray, kind: int, size: int = SEGMENT_BITS) -> np.ndarray:
    """The levels that the filter gives for ``keys``: probes each level until one is missing."""
    reached, alive, at = np.zeros(len(keys), np.uint8), np.arange(len(keys)), 0
    while len(alive) and at < 64:
        at += 1
        alive = alive[present(filter_bytes, base[alive], _entry(keys[alive], kind, at), size)]
        reached[alive] = at
    return reached


def bases(segments: int, keys: np.ndarray) -> np.ndarray:
    """The bits at which the segments of ``keys`` begin in the broadcast filter."""
    return ((keys & np.uint64((1 << 63) - 1)) % np.uint64(segments)).astype(np.int64) * SEGMENT_BITS


def probe_counts(filter_bytes: np.ndarray, segments: int, keys: np.ndarray, kind: int) -> np.ndarray:
    """The counts that the broadcast filter gives for ``keys``."""
    return middle(probe_levels(filter_bytes, bases(segments, keys), keys, kind).astype(np.int64))


def bucket_cuts(keys: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of ascending ``keys`` (they ascend, too) and where each one's keys end: bucket numbers, ends."""
    at = ((keys >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
    ends = np.append(np.flatnonzero(at[1:] != at[:-1]) + 1, len(at)) if len(at) else np.zeros(0, np.int64)
    return at[ends - 1].astype(np.int64), ends


def by_bucket(columns: tuple[np.ndarray, ...], buckets: int) -> dict[int, list[bytes]]:
    """Columns, the first of ascending keys, cut by bucket."""
    which, ends = bucket_cuts(columns[0], buckets)
    starts = np.append(0, ends[:-1]) if len(ends) else ends
    return {int(b): [c[x:y].tobytes() for c in columns] for b, x, y in zip(which, starts, ends)}


def joined(column: pa.ChunkedArray, kind: type | str) -> np.ndarray:
    """The numbers that a column of binaries (no nulls) holds, one row's behind the other's."""
    parts = [np.zeros(0, kind)]
    for c in column.chunks:
        ends = np.asarray(pa.Array.from_buffers(pa.int32(), len(c) + 1, [None, c.buffers()[1]], offset=c.offset)) if len(c) else [0, 0]
        if ends[-1] > ends[0]:
            parts.append(np.frombuffer(c.buffers()[2], kind, (ends[-1] - ends[0]) // np.dtype(kind).itemsize, ends[0]))
    return np.concatenate(parts)


def units(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The rows cut into at most ``UNIT`` each, and of about ``UNIT_CHARS`` code points of text (column 1) or one row."""
    sizes, at = np.cumsum(pc.fill_null(pc.utf8_length(batch.column(1)), 0).to_numpy(zero_copy_only=False), dtype=np.int64), 0
    while at < batch.num_rows:
        end = int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + UNIT_CHARS, "right"))
        end = max(at + 1, min(at + UNIT, end))
        yield batch.slice(at, end - at)
        at = end


def _sent(texts: list[np.ndarray], buckets: int) -> pa.RecordBatch:
    """One row for each bucket and kind: the keys of the texts' n-grams and how often each occurs."""
    rows, tokens = [], np.concatenate(texts)
    starts = np.cumsum([0, *map(len, texts[:-1])])
    for kind, found in ((WORD, tokens), (PAIR, pair_keys(tokens, starts))):
        keys, n = np.unique(found, return_counts=True)
        rows += [(bucket, kind, *cut) for bucket, cut in by_bucket((keys, n.astype("<u4")), buckets).items()]
    columns = [list(c) for c in zip(*rows)]
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int8()), pa.array(columns[2], pa.binary()), pa.array(columns[3], pa.binary())],
        names=["bucket", "kind", "keys", "n"],
    )


def bloom(keys: dict[int, np.ndarray], counts: dict[int, np.ndarray]) -> bytes:
    """A bucket of the whole filter: all levels of its n-grams, ``BITS`` bits for each entry."""
    tops = {k: level(counts[k]) for k in keys}
    bits = np.zeros(max(64, -(-BITS * sum(int(t.sum()) for t in tops.values()) // 8) * 8), bool)
    for k, top in tops.items():
        for at in range(1, int(top.max(initial=0)) + 1):
            entries = _entry(keys[k][top >= at], k, at)
            for probe in range(PROBES):
                bits[_places(entries, probe, len(bits))] = True
    return np.packbits(bits, bitorder="little").tobytes()


def count_ngrams(texts: DataFrame, buckets: int) -> DataFrame:
    """The n-grams of column ``text`` of all rows: ``kind, key, n`` of all words and of the pairs that may be
    frequent, and for each bucket a row ``bucket, bits`` with its part of the whole filter."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, size = [], 0
        for batch in batches:
            for text in batch.column(0):
                texts.append(hashed(text.as_py()))
                size += len(texts[-1])
                if size >= GATHER:
                    yield _sent(texts, buckets)
                    texts, size = [], 0
        if size:
            yield _sent(texts, buckets)

    def total(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = pa.Table.from_batches(list(batches))
        keys, counts = {}, {}
        for kind in (WORD, PAIR):
            own = got.filter(pc.equal(got["kind"], kind))
            keys[kind], back = np.unique(joined(own["keys"], np.uint64), return_inverse=True)
            counts[kind] = np.bincount(back, joined(own["n"], "<u4"), len(keys[kind])).astype(np.int64)
        del got, own, back
        for kind in (WORD, PAIR):
            may = np.flatnonzero(counts[kind] >= (2 if kind == PAIR else 1))  # the cutoff for pairs is level 2 at least
            for at in range(0, len(may), ROWS):
                some = may[at : at + ROWS]
                none = [pa.nulls(len(some), pa.int64()), pa.nulls(len(some), pa.binary())]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(some), kind, np.int8)), pa.array(keys[kind][some].view(np.int64)), pa.array(counts[kind][some]), *none], names=names)
        last = [pa.nulls(1, pa.int8()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.array([key[0].as_py()], pa.int64()), pa.array([bloom(keys, counts)], pa.binary())]
        yield pa.RecordBatch.from_arrays(last, names=names)

    names = ["kind", "key", "n", "bucket", "bits"]
    parts = texts.select("text").mapInArrow(run, "bucket long, kind byte, keys binary, n binary")
    return parts.groupBy("bucket").applyInArrow(total, "kind byte, key long, n long, bucket long, bits binary")


def _level() -> Column:
    return (F.lit(1) + F.floor(F.log2("n") / float(np.log2(B)) + 1e-9)).cast("long")


def least_cutoff(counts: DataFrame) -> int:
    """The least level (2 or more) so that the pairs that have it and the words of one level less fit into the broadcast filter."""
    sizes = counts.select("kind", _level().alias("level")).groupBy("kind", "level").agg(F.sum("level").alias("entries")).collect()  # a few dozen levels
    cutoff = 2
    while sum(r["entries"] for r in sizes if r["level"] >= cutoff - (r["kind"] == WORD)) > MAX_FILTER_BYTES * 8 // BITS:
        cutoff += 1
    return cutoff


def build_filter(spark: SparkSession, counts: DataFrame) -> tuple[np.ndarray, int]:
    """The broadcast filter's bytes and its number of segments: all n-grams of ``counts``."""
    chosen = counts.withColumn("level", _level())
    entries = chosen.agg(F.coalesce(F.sum("level"), F.lit(0))).first()[0]
    segments = max(1, -(-entries * BITS // SEGMENT_BITS))

    # all levels of an n-gram lie in one segment, so each n-gram is sent once
    segment = F.pmod(F.col("key").bitwiseAND(F.lit((1 << 63) - 1)), F.lit(segments)).cast("int")

    def build(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(SEGMENT_BITS // 8, np.uint8)
        for batch in batches:
            kind, top = np.asarray(batch.column("kind")), np.asarray(batch.column("level"))
            keys = np.asarray(batch.column("key")).view(np.uint64)
            for at in range(1, int(top.max(initial=0)) + 1):
                for k in (WORD, PAIR):
                    entries = _entry(keys[(top >= at) & (kind == k)], k, at)
                    for probe in range(PROBES):
                        bit = _places(entries, probe)
                        np.bitwise_or.at(bits, bit >> 3, np.left_shift(np.uint8(1), (bit & 7).astype(np.uint8)))
        yield pa.RecordBatch.from_pydict({"segment": pa.array([key[0].as_py()], pa.int32()), "bits": pa.array([zlib.compress(bits.tobytes(), 1)])})

    parts = chosen.select(segment.alias("segment"), "kind", "key", F.col("level").cast("byte").alias("level")).groupBy("segment").applyInArrow(build, "segment int, bits binary")
    out = np.zeros(segments * SEGMENT_BITS // 8, np.uint8)
    for row in parts.toLocalIterator():  # one segment at a time, at most MAX_FILTER_BYTES in all
        at = row["segment"] * SEGMENT_BITS // 8
        out[at : at + SEGMENT_BITS // 8] = np.frombuffer(zlib.decompress(row["bits"]), np.uint8)
    return out, segments


def head_counts(words: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Keys (ascending) and exact counts of the words whose count makes them fit into ``HEAD`` places."""
    least = least_count(words, HEAD)
    rows = words.filter(F.col("n") >= least).select("key", "n").toArrow() if least is not None else None
    keys = rows["key"].to_numpy().view(np.uint64) if rows is not None else np.zeros(0, np.uint64)
    n = rows["n"].to_numpy() if rows is not None else np.zeros(0, np.int64)
    order = np.argsort(keys)
    return keys[order], n[order]


def log_p(one: np.ndarray, before: np.ndarray, both: np.ndarray, below: float) -> np.ndarray:
    """log10 of the probability of words by the levels of the word, of the one before it and of both."""
    value = middle(np.arange(256))
    return np.log10(LAMBDA * np.minimum(1.0, value[both] / np.maximum(value[before], 1.0)) + (1 - LAMBDA) * np.minimum(1.0, (value[one] + 0.5) / below))


def answers(asked: DataFrame, filter_: DataFrame) -> DataFrame:
    """``unit, bucket, words, pairs``: the level (a byte) of each key that a unit asks a bucket for."""

    def look_up(questions: pa.Table, stored: pa.Table) -> pa.Table:
        bits = np.frombuffer(stored["bits"][0].as_py() if stored.num_rows else bytes(8), np.uint8)
        out = {"unit": questions["unit"], "bucket": questions["bucket"]}
        for kind, name in ((WORD, "words"), (PAIR, "pairs")):
            asked = pc.fill_null(questions[name], b"")
            keys, back = np.unique(joined(asked, np.uint64), return_inverse=True)
            found = probe_levels(bits, np.zeros(len(keys), np.int64), keys, kind, 8 * len(bits))[back]
            ends = np.cumsum(pc.binary_length(asked).to_numpy() // 8)
            out[name] = pa.array([found[a:b].tobytes() for a, b in zip([0, *ends], ends)], pa.binary())
        return pa.table(out)

    return asked.groupBy("bucket").cogroup(filter_.groupBy("bucket")).applyInArrow(look_up, "unit long, bucket long, words binary, pairs binary")


def late_scores(states: DataFrame, looked_up: DataFrame, below: float) -> DataFrame:
    """``part, at, late``: by row, the sum over the words that had to wait for a level."""

    def add(state: pa.Table, levels: pa.Table) -> pa.Table:
        levels = levels.sort_by("bucket")
        words, both = (np.frombuffer(b"".join(levels[name].to_pylist()), np.uint8) for name in ("words", "pairs"))
        unit, size, data = (state[name][0].as_py() for name in ("unit", "size", "state"))
        row = np.frombuffer(data, "<u2", size)
        one, before, new = (np.frombuffer(data, np.uint8, size, (2 + i) * size).copy() for i in range(3))
        lookups, used = np.frombuffer(data, "<u4", -1, 5 * size) if len(data) > 5 * size else np.zeros(0, "<u4"), 0
        for side in (one, before):
            missing = side == OPEN
            side[missing] = words[lookups[used : used + missing.sum()]]
            used += missing.sum()
        sums = np.bincount(row, log_p(one, before, both[np.cumsum(new) - 1], below))
        rows = np.unique(row).astype(np.int64)
        return pa.table({"part": pa.array(np.full(len(rows), unit >> 40, np.int32)), "at": (unit & ((1 << 40) - 1)) + rows, "late": sums[rows]})

    return states.groupBy("unit").cogroup(looked_up.groupBy("unit")).applyInArrow(add, "part int, at long, late double")


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` for each row of ``docs``."""
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    docs = docs.withColumn("held_out", doc_crc() % FOLDS == HELD_OUT)
    training = docs.filter(~F.col("held_out"))
    buckets = 1 + (training.agg(F.sum(F.length("text"))).first()[0] or 0) // BUCKET_CHARS
    whole = store(count_ngrams(training, buckets), tidy=True, block=BLOCK_BYTES)
    counts = whole.filter("kind is not null").select("kind", "key", "n")
    words = counts.filter(F.col("kind") == WORD)
    total, distinct = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    below = total + 0.5 * (distinct + 1)
    cutoff = least_cutoff(counts)
    bits, segments = build_filter(spark, counts.filter(_level() >= F.lit(cutoff) - (F.col("kind") == WORD).cast("int")))
    model = spark.sparkContext.broadcast((bits, segments, *head_counts(words)))
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, segments, keys, exact = model.value
        part, at = TaskContext.get().partitionId(), 0
        for whole in batches:
            for batch in units(whole):
                each = [hashed(t.as_py()) for t in batch.column(1)]
                n = np.array([len(x) for x in each])
                starts = np.concatenate([[0], np.cumsum(n)[:-1]])
                tokens = np.concatenate(each)
                found, back = np.unique(tokens, return_inverse=True)
                place = np.searchsorted(keys, found)
                hit = np.zeros(len(found), bool) if not len(keys) else keys[np.minimum(place, len(keys) - 1)] == found
                count = np.where(hit, exact[np.minimum(place, len(keys) - 1)], 0) if len(keys) else np.zeros(len(found), np.int64)
                held = hit[back]
                base = np.add.reduceat(np.where(held, np.log10((count[back] + 0.5) / below), 0.0), starts) if below else np.zeros(len(n))
                known = np.add.reduceat(held.astype(np.int64), starts)
                # the model: levels of the word, of the one before it, of both
                single = probe_levels(bits, bases(segments, found), found, WORD)
                if cutoff > 2:  # else all words are in the broadcast filter
                    single[single < cutoff - 1] = OPEN
                one = single[back]
                before = np.empty_like(one)
                before[1:] = one[:-1]
                before[starts] = single[np.searchsorted(found, END)]
                pairs, which = np.unique(pair_keys(tokens, starts), return_inverse=True)
                both = probe_levels(bits, bases(segments, pairs), pairs, PAIR)
                later = (both < cutoff)[which] | (one == OPEN) | (before == OPEN)
                both = both[which]
                score = np.add.reduceat(np.where(later, 0.0, log_p(one, before, both, below)), starts)
                # what the buckets have to tell: each pair and word once, in the order of the keys
                row = np.repeat(np.arange(len(n), dtype="<u2"), n)
                todo = np.flatnonzero(later)
                todo = todo[np.argsort(which[todo], kind="stable")]
                new = np.diff(which[todo], prepend=-1) > 0
                behind = np.empty_like(back)  # the place in ``found`` of the word before
                behind[1:] = back[:-1]
                behind[starts] = np.searchsorted(found, END)
                open_, rank = np.flatnonzero(single == OPEN), np.cumsum(single == OPEN) - 1
                lookups = [rank[x[todo][side[todo] == OPEN]].astype("<u4") for x, side in ((back, one), (behind, before))]
                asked = {PAIR: by_bucket((pairs[which[todo][new]],), buckets), WORD: by_bucket((found[open_],), buckets)}
                unit = (part << 40) + at
                if len(todo):
                    state = b"".join(x.tobytes() for x in (row[todo], one[todo], before[todo], new.astype(np.uint8), *lookups))
                    where = sorted(asked[PAIR].keys() | asked[WORD].keys())
                    ask = [[asked[kind].get(b, [None])[0] for b in where] for kind in (WORD, PAIR)]
                    k = 1 + len(where)
                    yield pa.RecordBatch.from_arrays(
                        [
                            *[pa.nulls(k, t) for t in types[:9]], pa.array([unit] * k, pa.int64()), pa.array([None, *where], pa.int64()), pa.array([None, *ask[0]], pa.binary()),
                            pa.array([None, *ask[1]], pa.binary()), pa.array([len(todo)] + [None] * len(where), pa.int64()), pa.array([state] + [None] * len(where), pa.binary()),
                        ],
                        names=names,
                    )
                rare = ~held
                ends = np.concatenate([[0], np.cumsum(np.add.reduceat(rare.astype(np.int64), starts))]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(n), part, np.int32)), pa.array(np.arange(at, at + len(n))), batch.column(0), batch.column(2), pa.array(n.astype(np.int64)),
                        pa.array(known), pa.array(base), pa.array(score), pa.ListArray.from_arrays(pa.array(ends), pa.array(tokens[rare].view(np.int64))),
                        *[pa.nulls(len(n), t) for t in types[9:]],
                    ],
                    names=names,
                )
                at += len(n)
            pa.default_memory_pool().release_unused()

    schema = (
        f"part int, at long, doc_id {id_type}, held_out boolean, n_tokens long, known long, base double, score double, rare array<long>,"
        " unit long, bucket long, words binary, pairs binary, size long, state binary"
    )
    fields = to_arrow_schema(StructType.fromDDL(schema))
    names, types = fields.names, fields.types
    written = store(docs.select("doc_id", "text", "held_out").mapInArrow(run, schema), block=BLOCK_BYTES)
    scored = written.filter("part is not null").select(*names[:9])
    looked_up = answers(written.filter("bucket is not null").select("unit", "bucket", "words", "pairs"), whole.filter("bits is not null").select("bucket", "bits"))
    late = late_scores(written.filter("size is not null").select("unit", "size", "state"), looked_up, below)
    rare = scored.select("part", "at", F.explode("rare").alias("key")).join(words.select("key", "n"), "key", "left")
    sums = rare.groupBy("part", "at").agg(
        F.count("n").alias("more"), F.sum(F.log10((F.coalesce("n", F.lit(0)) + F.lit(0.5)) / F.lit(float(below)))).alias("rest")
    )
    full = scored.drop("rare").join(sums, ["part", "at"], "left").join(late, ["part", "at"], "left")
    return full.select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce("more", F.lit(0))).alias("n_known"), F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("rest", F.lit(0.0))).alias("base_score"), (F.col("score") + F.coalesce("late", F.lit(0.0))).alias("score"),
    )
