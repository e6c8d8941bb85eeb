"""Byte-level BPE encoding and decoding.

Words are the matches of the tokenizer's splitting pattern. Each text is split once: a task numbers the distinct words of a
bounded group of its documents, and the groups are stored. A word that is a token is that token, as the splitting library
has it; all other words are encoded by Spark higher-order functions: a word's bytes are folded, one merge for each step,
always the pair whose joined bytes have the lowest rank (the leftmost of equals), until no joined pair has a rank. The
rank map is a literal, small buckets of token pairs, so a look-up doesn't search the vocabulary. The words that occur
in the most groups (a bounded number) are folded once for all documents and sent to the tasks as a table; the others are
folded in their group. Each document's ids are then put together from its words' ids, and decoding joins the
binary pieces of the ids. Documents don't leave their partition.

Words above ``LONG`` bytes (unbroken runs) are merged with a heap instead, which gives the same ids
in time n log n where the fold needs n squared.

Defined results: a null or empty text has no ids and decodes to nothing; repeated rows are encoded each;
a null id is carried along; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import heapq
import json
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltaic.llm.common import least_count, scratch_dir, store
from voltaic.llm.native import let
from voltaic.plans.tables import delete

#: How the rank map spreads pairs over its buckets, and what it takes off the ranks that it stores.
FACTOR, BELOW = 641, 1 << 30
LONG = 96
#: A piece while it is folded, in one long: from the top the rank of it and the next piece joined, less ``BELOW`` (zero or
#: more: none), where it begins in its word (7 bits), its own rank (22 bits). The least is the next pair to merge.
PIECE, PLACE = (1 << 22) - 1, 29
#: Code points of documents whose distinct words make one row.
GROUP = 4_000_000
#: Marks that close a chunk of letters, each a word of its own there.
MARKS = frozenset(".,;:!?)")
#: Most words in the broadcast table of words that many groups share, which are encoded once for all documents: about 20 MB.
FREQUENT = 1 << 20


def read_ranks(path: str | None = None) -> bytes:
    """A rank file's content (about 1 MB): a line for each token, its bytes in base64 and its rank."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    with open(path, "rb") as f:
        return f.read()


@lru_cache(maxsize=2)
def ranks_of(content: bytes) -> dict[bytes, int]:
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, content.splitlines()) if token}


@lru_cache(maxsize=1)
def _pattern():
    import regex
    from public_tokenizers import PATTERN

    return regex.compile(PATTERN)


def rank_table(ranks: dict[bytes, int]) -> Column:
    """The rank map as a literal: for pairs of tokens, named by their own ranks, the rank of their joined bytes.

    Pair (a, b) lies in the bucket ``(a * FACTOR + b) % buckets``, which holds a number that is no token's, then
    ``a, rank - BELOW`` for each of its pairs. There are at least as many buckets as tokens, so in one bucket a alone names
    the pair; ranks are stored below zero, so no a is taken for one.
    """
    size = _buckets(ranks)
    buckets: list[list[int]] = [[size] for _ in range(size)]
    for token, rank in ranks.items():
        for i in range(1, len(token)):
            a, b = ranks.get(token[:i]), ranks.get(token[i:])
            if a is not None and b is not None:
                buckets[(a * FACTOR + b) % size] += [a, rank - BELOW]
    return F.from_json(F.lit(json.dumps(buckets)), "array<array<int>>")


def _buckets(ranks: dict[bytes, int]) -> int:
    return 1 << max(17, max(ranks.values()).bit_length())


def fold_merges(word: Column, table: Column, buckets: int) -> Column:
    """The ids of a word, an array of its bytes' pieces (:func:`byte_pieces`), by folding ranked merges over it."""
    none, low_bits = F.array().cast("array<long>"), (1 << PLACE) - 1

    def piece(x: Column) -> Column:
        return x.bitwiseAND(F.lit(PIECE)).cast("int")

    def rank(a: Column, b: Column) -> Column:  # in its place, below zero, or anything else if the pair has none
        bucket = F.get(table, (a * FACTOR + b).bitwiseAND(F.lit(buckets - 1)))
        return F.shiftleft(let(bucket, lambda each: F.get(each, F.array_position(each, a).cast("int"))).cast("long"), PLACE)

    def step(s: Column) -> Column:
        def merged(low: Column, one: Column, k: Column) -> Column:  # the pieces k and k + 1 (from 1) become one
            def left(x: Column) -> Column:
                return F.array(rank(piece(x), one) + x.bitwiseAND(F.lit(low_bits)))

            place = low.bitwiseAND(F.lit(low_bits - PIECE)) + one
            joined = F.when(k + 1 < F.size(s), rank(one, piece(F.get(s, k + 1))) + place).otherwise(place)
            before = F.when(k > 1, F.concat(F.slice(s, F.lit(1), k - 2), left(F.get(s, k - 2)))).otherwise(none)
            return F.concat(before, F.array(joined), F.slice(s, k + 2, F.size(s)))

        def at(low: Column) -> Column:
            one = (F.shiftright(low, PLACE) + BELOW).cast("int")
            return let(one, lambda one: let(F.array_position(s, low).cast("int"), lambda k: merged(low, one, k)))

        return let(F.array_min(s), lambda low: F.when(low < 0, at(low)).otherwise(s))

    return F.aggregate(F.sequence(F.lit(1), F.size(word)), word, lambda s, _: step(s), lambda s: F.transform(s, piece))


def byte_pieces(words: list[bytes], pairs: np.ndarray) -> pa.Array:
    """The words as lists of their bytes' pieces; ``pairs`` from :func:`byte_pairs`."""
    ends = np.concatenate([[0], np.cumsum([len(w) for w in words], dtype=np.int64)])
    every = np.frombuffer(b"".join(words), np.uint8).astype(np.int64)
    after = np.full(len(every), 256)
    after[:-1] = every[1:]
    after[ends[1:] - 1] = 256
    place = np.arange(len(every)) - np.repeat(ends[:-1], np.diff(ends))
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(pairs[every, after] + (place << (PIECE.bit_length()))))


def byte_pairs(ranks: dict[bytes, int]) -> np.ndarray:
    """The piece of a byte (row) before another (column; 256: before none), as if it began its word."""
    found = np.zeros((256, 257), np.int64)
    for a in range(256):
        found[a] = ranks[bytes([a])]
        for b in range(256):
            rank = ranks.get(bytes([a, b]))
            if rank is not None:
                found[a, b] += (rank - BELOW) << PLACE
    return found


def heap_merges(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same ids for one long word: pairs wait in a heap by rank and place."""
    end = [i + 1 for i in range(len(word))]  # of the piece that starts at i; 0: merged into the one before
    before = list(range(-1, len(word) - 1))
    heap: list[tuple[int, int, int, int]] = []

    def offer(a: int) -> None:
        if a >= 0 and end[a] < len(word):
            b = end[a]
            rank = ranks.get(word[a : end[b]])
            if rank is not None:
                heapq.heappush(heap, (rank, a, b, end[b]))

    for i in range(len(word)):
        offer(i)
    while heap:
        _, a, b, c = heapq.heappop(heap)
        if end[a] != b or end[b] != c:  # one of the two has been merged since
            continue
        end[a], end[b] = c, 0
        if c < len(word):
            before[c] = a
        offer(before[a])
        offer(a)
    out, at = [], 0
    while at < len(word):
        out.append(ranks[word[at : end[at]]])
        at = end[at]
    return out


class _Words(dict):
    """Numbers of the distinct words of a group."""

    def __missing__(self, word: str) -> int:
        self[word] = len(self)
        return self[word]


def split_words(text: str) -> list[str]:
    """The matches of the splitting pattern."""
    return _pattern().findall(text)


def objects(words: pa.Array) -> list:
    """The column as Python strings or bytes, in a fraction of the time that ``to_pylist`` takes, which makes a scalar of each."""
    return words.to_numpy(zero_copy_only=False).tolist()


def number_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, _Words]:
    """The words of texts as numbers, all in a row; how many numbers end with each text; the words.

    Where a space stands alone, a word never crosses it but takes it as its first character, so each
    distinct chunk between spaces is split once for its group and looked up from then on. Other texts, and what
    stands before a text's first space, are split as they are.
    """
    words = _Words()
    chunks = pc.split_pattern(texts, " ")
    ends = np.asarray(chunks.offsets)[1:] - chunks.offsets[0].as_py()
    firsts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
    coded = chunks.flatten().dictionary_encode()
    index, distinct = coded.indices.to_numpy().astype(np.int64), objects(coded.dictionary)
    blank = np.array([not c.isalpha() and (not c or c[0].isspace() or c[-1].isspace()) for c in distinct], bool)
    text_of = np.repeat(np.arange(len(ends)), ends - firsts)
    later = np.ones(len(index), bool)
    later[firsts] = False
    odd = np.zeros(len(ends), bool)
    odd[text_of[later & blank[index]]] = True
    # a first chunk has an entry of its own behind the distinct ones; the last entry has no words. All entries' words are
    # one list: a list for each of them would be looked through by Python's garbage collector again and again
    sizes, flat = np.zeros(len(distinct) + len(ends) + 1, np.int64), []
    begins = [distinct[i] for i in index[firsts].tolist()]
    for i, first in enumerate(begins):
        odd[i] |= bool(ends[i] - firsts[i] > 1 and (not first or first[-1].isspace()))
    looked_up = later & ~odd[text_of]
    used = np.zeros(len(distinct), bool)
    used[index[looked_up]] = True
    for i in np.flatnonzero(used).tolist():
        chunk, before = distinct[i], len(flat)
        if chunk.isalpha():  # mostly letters and a closing mark
            flat.append(words[" " + chunk])
        elif chunk[-1:] in MARKS and chunk[:-1].isalpha():
            flat += words[" " + chunk[:-1]], words[chunk[-1]]
        else:
            flat += [words[w] for w in split_words(" " + chunk)]
        sizes[i] = len(flat) - before
    for i, first in enumerate(begins):
        before = len(flat)
        flat += [words[w] for w in split_words(texts[i].as_py() if odd[i] else first)]
        sizes[len(distinct) + i] = len(flat) - before
    index[~looked_up] = len(sizes) - 1
    index[firsts] = len(distinct) + np.arange(len(ends))
    starts, flat = np.concatenate([[0], np.cumsum(sizes)]), np.array(flat, np.int32)
    numbers = pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), pa.array(flat)).take(pa.array(index)).flatten().to_numpy()
    return numbers, np.cumsum(sizes[index])[ends - 1], words


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, pa.Array]]:
    """Groups of about ``GROUP`` code points: ids and texts."""
    ids, texts, size = [], [], 0
    for batch in batches:
        text = pc.fill_null(batch.column(1), "")
        sizes, at = np.cumsum(pc.utf8_length(text).to_numpy(zero_copy_only=False), dtype=np.int64), 0
        while at < len(text):
            done = int(sizes[at - 1]) if at else 0
            end = min(int(np.searchsorted(sizes, done + GROUP - size)) + 1, len(text))
            ids.append(batch.column(0).slice(at, end - at))
            texts.append(text.slice(at, end - at))
            size, at = size + int(sizes[end - 1]) - done, end
            if size >= GROUP:
                yield pa.concat_arrays(ids), pa.concat_arrays(texts)
                ids, texts, size = [], [], 0
    if texts:
        yield pa.concat_arrays(ids), pa.concat_arrays(texts)


def planes(numbers: np.ndarray) -> np.ndarray:
    """Numbers below 2^32 as all their lowest bytes, then all their second ones and so on: they pack better than in a row."""
    return numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T.ravel()


def from_planes(content: bytes) -> np.ndarray:
    return np.frombuffer(content, np.uint8).reshape(4, -1).T.copy().view("<u4").ravel().astype(np.int64)


def words_in(content: pa.Scalar, sizes: pa.Scalar) -> pa.Array:
    """The words of a group, stored one behind the other (at most ``LONG`` bytes each) with their sizes beside them."""
    ends = np.cumsum(np.frombuffer(sizes.as_py(), np.uint8), dtype=np.int64)
    return _binaries(np.frombuffer(content.as_py(), np.uint8), np.concatenate([[0], ends]))


def packed(numbers: np.ndarray) -> bytes:
    """Numbers below 2^32 for a broadcast, of which each machine keeps a copy on its disk."""
    return zlib.compress(planes(numbers).tobytes(), 1)


def unpacked(content: bytes) -> np.ndarray:
    return from_planes(zlib.decompress(content))


def _lists(lists: list[list[int]]) -> pa.Array:
    return pa.array(lists, pa.list_(pa.int32()))


def _hashes(words: list[bytes]) -> np.ndarray:
    return np.array([*map(xxhash.xxh3_64_intdigest, words)], np.uint64)


def frequent_words(groups: DataFrame, ranks: bytes, table: Column, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The words that occur in the most groups, at most ``most``, encoded once each and kept by falling number of groups:
    their hashes (ascending) and where each of them is kept, then the numbers of ids and the ids of what is kept."""
    spark = groups.sparkSession
    counted, encoded = scratch_dir(spark), scratch_dir(spark)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                yield pa.RecordBatch.from_arrays([words_in(batch.column(0)[at], batch.column(1)[at])], names=["word"])

    every = groups.select("words", "sizes").mapInArrow(spread, "word binary")
    counts = store(every.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), tidy=True, path=counted)
    least = least_count(counts, most, 2)
    if least is None:
        delete(spark, counted)
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    known = ranks_of(ranks)
    pairs = byte_pairs(known)

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = objects(batch.column(0))
            columns = [pa.array(_hashes(words).view(np.int64)), batch.column(1), byte_pieces(words, pairs)]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "n", "bytes"])

    chosen = counts.filter(F.col("n") >= least).select("word", "n").repartition(F.col("word")).mapInArrow(spell, "key long, n long, bytes array<long>")
    folded = chosen.select("key", "n", let(table, lambda t: fold_merges(F.col("bytes"), t, _buckets(known))).alias("ids"))
    found = store(folded, tidy=True, path=encoded).toArrow().combine_chunks()
    for path in (counted, encoded):  # what the tasks need of them is broadcast
        delete(spark, path)
    keys = found["key"].to_numpy().view(np.uint64)
    order = np.lexsort((keys, -found["n"].to_numpy()))
    kept = np.empty(len(order), np.int64)
    kept[order] = np.arange(len(order))
    ascending = np.argsort(keys)
    lists = found["ids"].combine_chunks() if isinstance(found["ids"], pa.ChunkedArray) else found["ids"]
    lists = lists.take(pa.array(order))
    return keys[ascending], kept[ascending], np.diff(np.asarray(lists.offsets)).astype(np.int64), lists.flatten().to_numpy().astype(np.int64)


def encode_documents(docs: DataFrame, ranks: bytes | None = None, id_col: str = "doc_id", text_col: str = "text", frequent: int = FREQUENT, decode: bool = False) -> DataFrame:
    """``doc_id, ids`` (little-endian unsigned 32-bit): the ids of each row's whole text.

    With ``decode`` also ``decoded``, the bytes that the ids stand for, made by the same task.
    """
    ranks = ranks or read_ranks()
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    context = docs.sparkSession.sparkContext
    content = context.broadcast(ranks)
    known = ranks_of(ranks)
    pairs = byte_pairs(known)
    row = lambda a: pa.ListArray.from_arrays(pa.array([0, len(a)], pa.int32()), a)
    binary = lambda a, kind: pa.array([np.asarray(a).astype(kind).tobytes()], pa.binary())

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = ranks_of(content.value)
        for ids, texts in _groups(batches):
            numbers, ends, words = number_words(texts)
            spelled = [w.encode("utf-8", "replace") for w in words]
            # a word that is a token needs no merges, a long one a heap
            ready = np.array([w in known or len(w) > LONG for w in spelled], bool)
            # those that are ready come first, then the most frequent, since small numbers pack well, and so do words in order
            seen = np.bincount(numbers, minlength=len(spelled))
            first = np.flatnonzero(ready).tolist()
            later = np.array(sorted(np.flatnonzero(~ready).tolist(), key=spelled.__getitem__), np.int64)
            later = later[np.argsort(-seen[later], kind="stable")].tolist()
            place = np.empty(len(spelled), np.int64)
            place[first + later] = np.arange(len(spelled))
            folded = [spelled[i] for i in later]
            made = _lists([[known[spelled[i]]] if spelled[i] in known else heap_merges(spelled[i], known) for i in first])
            columns = [row(ids), binary(ends, "<i8"), binary(planes(place[numbers]), np.uint8), pa.array([b"".join(folded)], pa.binary()), binary([*map(len, folded)], np.uint8), row(made)]
            pa.default_memory_pool().release_unused()
            yield pa.RecordBatch.from_arrays(columns, names=["ids", "ends", "numbers", "words", "sizes", "ready"])

    table = rank_table(known)
    fixed = f"ids array<{kind}>, ends binary, numbers binary"
    groups = store(docs.mapInArrow(number, f"{fixed}, words binary, sizes binary, ready array<array<int>>"), "zstd")
    keys, kept, sizes, every = frequent_words(groups, ranks, table, frequent)
    steps = np.diff(keys, prepend=np.uint64(0))
    head = context.broadcast([packed(x) for x in (steps >> np.uint64(32), steps & np.uint64(0xFFFFFFFF), kept)])
    head_ids = context.broadcast([packed(x) for x in (sizes, every)])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # words are numbered anew: those that are ready, those of the frequent words' table in its order (so the steps
        # from one to the next say which), then those that are folded here
        high, low, kept = map(unpacked, head.value)
        keys = np.cumsum((high.astype(np.uint64) << np.uint64(32)) + low.astype(np.uint64), dtype=np.uint64)
        for batch in batches:
            for at in range(batch.num_rows):
                words = objects(words_in(batch.column(3)[at], batch.column(4)[at]))
                found = np.full(len(words), -1, np.int64)
                if len(keys):
                    mine = _hashes(words)
                    near = np.minimum(np.searchsorted(keys, mine), len(keys) - 1)
                    found = np.where(keys[near] == mine, kept[near], -1)
                shared, own = np.flatnonzero(found >= 0), np.flatnonzero(found < 0)
                shared = shared[np.argsort(found[shared], kind="stable")]
                ready = batch.column(5).slice(at, 1)
                first = len(ready.flatten())
                number = np.arange(first + len(words))
                number[first + np.concatenate([shared, own])] = number[first:].copy()
                columns = [
                    batch.column(0).slice(at, 1), batch.column(1).slice(at, 1), binary(planes(number[from_planes(batch.column(2)[at].as_py())]), np.uint8), ready,
                    row(byte_pieces([words[i] for i in own.tolist()], pairs)), binary(planes(np.diff(found[shared], prepend=0)), np.uint8),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["ids", "ends", "numbers", "ready", "rest", "steps"])

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes, every = map(unpacked, head_ids.value)
        starts = np.concatenate([[0], np.cumsum(sizes)])
        shared = pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), pa.array(every.astype(np.int32)))
        pieces = pa.array(pieces_of(content.value), pa.binary()) if decode else None
        for batch in batches:
            for at in range(batch.num_rows):
                ids, ready, encoded = (batch.column(i).slice(at, 1).flatten() for i in (0, 3, 4))
                ends = np.frombuffer(batch.column(1)[at].as_py(), "<i8")
                numbers, steps = (from_planes(batch.column(i)[at].as_py()) for i in (2, 5))
                ready, encoded = (pa.ListArray.from_arrays(a.offsets, a.values) for a in (ready, encoded))
                lists = pa.concat_arrays([ready, shared.take(pa.array(np.cumsum(steps))), encoded])
                tokens = lists.take(pa.array(numbers)).flatten().to_numpy()
                ends = np.concatenate([[0], np.cumsum(np.diff(np.asarray(lists.offsets))[numbers])])[np.concatenate([[0], ends])]
                columns = [ids, _binaries(tokens.astype("<u4"), ends * 4)]
                if decode:
                    columns.append(decoded(tokens, ends, pieces))
                out = pa.RecordBatch.from_arrays(columns, names=["doc_id", "ids", "decoded"][: len(columns)])
                del lists, tokens, numbers, columns
                pa.default_memory_pool().release_unused()
                for a in range(0, len(ids), 500):
                    yield out.slice(a, 500)

    encoded = let(table, lambda t: F.transform("rest", lambda w: fold_merges(w, t, _buckets(known))))
    placed = groups.mapInArrow(place, f"{fixed}, ready array<array<int>>, rest array<array<long>>, steps binary")
    # stored in between, so that a task runs one Python worker beside the JVM and not two
    return store(placed.withColumn("rest", encoded), "zstd").mapInArrow(join, f"doc_id {kind}, ids binary" + ", decoded binary" * decode)


def _binaries(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The bytes of ``values``, cut at ``ends`` (the first is where they begin)."""
    return pa.BinaryArray.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(values)])


def pieces_of(ranks: bytes) -> list[bytes]:
    """The binary piece of each id."""
    pieces = [b""] * (max(ranks_of(ranks).values(), default=-1) + 1)
    for token, rank in ranks_of(ranks).items():
        pieces[rank] = token
    return pieces


def decoded(ids: np.ndarray, ends: np.ndarray, pieces: pa.Array) -> pa.Array:
    """The binary pieces of ids, joined; the ids of each text end at ``ends`` (the first is where they begin)."""
    joined = pieces.take(pa.array(ids))
    return _binaries(joined.buffers()[2] or b"", np.asarray(pa.Array.from_buffers(pa.int32(), len(joined) + 1, [None, joined.buffers()[1]]))[ends])


def decode_documents(encoded: DataFrame, ranks: bytes | None = None) -> DataFrame:
    """``doc_id, ids`` with ``decoded``: the binary pieces of the ids, joined."""
    content = encoded.sparkSession.sparkContext.broadcast(ranks or read_ranks())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = pa.array(pieces_of(content.value), pa.binary())
        for batch in batches:
            ids = batch.column(1).to_pylist()
            ends = np.concatenate([[0], np.cumsum([len(x) // 4 for x in ids], dtype=np.int64)])
            out = decoded(np.frombuffer(b"".join(ids), "<u4"), ends, pieces)
            yield pa.RecordBatch.from_arrays([*batch.columns, out], names=["doc_id", "ids", "decoded"])

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, ids binary, decoded binary")


def digest(docs: DataFrame) -> DataFrame:
    """Digests of the ids and of the bytes they decode to."""
    both = encode_documents(docs, decode=True)
    return both.select(
        "doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )
