"""Best-fit packing of tokenized documents into fixed-length sequences by linear grouping.

Tokens are counted once, where the documents lie; everything after that works on lengths.

1. ``cut_pieces``: each document becomes its ids plus a closing id; only longer ones are cut, into
   full pieces with the shorter remainder first. A piece carries its rank among the pieces of its
   length in its own task.
2. The histogram of lengths (at most ``capacity`` rows, whatever the input) goes to the driver.
   ``plan_packing`` packs the histogram: large lengths (from a half, a third and a quarter of the
   capacity on, whichever gives the fewest sequences) are split, longest first, into groups of equal cardinality and rounded up to their group's longest; a linear
   programme over configurations of those few sizes is solved by column generation; actual lengths
   are substituted for the rounded ones; what rounding down left over and all small lengths follow
   by best fit, longest first. Runs of equal sequences are handled at once, so the work depends on
   the number of different lengths, not on the number of documents.
3. The plan is a table of slots ``(length, first rank, how many per sequence, first sequence,
   offset)``; its size is bounded by the plan's steps, not by the rows. Each piece finds its slot by
   binary search with its global rank among pieces of its length, which comes from per-task counts,
   so a length that a third of all pieces share is never gathered in one task.

Defined results: a null or empty text is the closing id alone (one piece of length 1); repeated rows
are packed each; an empty table gives an empty result; a null id is carried along.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from voltaic.llm.common import store

CAPACITY = 2048
CLOSING_ID = 0
#: Lengths from a half, a third or a quarter of the capacity on are large; the plan with the fewest sequences is taken.
SHARES = (2, 3, 4)
#: Groups of equal cardinality that large lengths are rounded up in.
GROUPS = 128
#: Rounds of column generation; each basis on the way is a feasible packing.
ROUNDS = 600
#: Above this many code points a text is looked through for one unbroken run of that size.
RUN = 20_000


def byte_alphabet() -> dict[str, int]:
    """The printable stand-in of each byte in byte-level vocabularies, by its rule."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


@lru_cache(maxsize=2)
def _encoders(vocabulary: bytes):
    """Two encoders of the same vocabulary: by ranks (fast, without added tokens), and ``tokenizers`` itself."""
    import tiktoken
    from public_tokenizers import PATTERN
    from tokenizers import Tokenizer

    whole = Tokenizer.from_str(vocabulary.decode())
    model, back = json.loads(vocabulary)["model"], byte_alphabet()
    special = {t.content for t in whole.get_added_tokens_decoder().values()}
    ranks = {bytes(back[c] for c in token): i for token, i in model["vocab"].items() if token not in special}
    fast = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return fast, whole


@lru_cache(maxsize=2)
def _added(vocabulary: bytes) -> tuple[str, ...]:
    """The strings that stand for one id wherever they occur in a text."""
    return tuple(t.content for t in _encoders(vocabulary)[1].get_added_tokens_decoder().values())


def encode(text: str | None, vocabulary: bytes) -> np.ndarray:
    """The text's ids; the string of an added token is its id, as ``tokenizers`` reads it without ``add_special_tokens``."""
    if not text:
        return np.zeros(0, "<u4")
    fast, whole = _encoders(vocabulary)
    if any(token in text for token in _added(vocabulary)):
        return np.array(whole.encode(text, add_special_tokens=False).ids, "<u4")
    if len(text) > RUN and max(len(max(text.split(), key=len, default="")), len(text) - sum(map(len, text.split()))) > RUN:
        return np.array(whole.encode(text, add_special_tokens=False).ids, "<u4")
    return np.asarray(fast.encode_to_numpy(text, disallowed_special=()), "<u4")


def cut_pieces(docs: DataFrame, vocabulary: bytes, capacity: int = CAPACITY, closing_id: int = CLOSING_ID, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, part, local_rank``: one row per piece."""
    spark = docs.sparkSession
    content = spark.sparkContext.broadcast(vocabulary)
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, part = np.zeros(capacity + 1, np.int64), TaskContext.get().partitionId()
        for batch in batches:
            rows, out = [], []
            for row, text in enumerate(batch.column(1)):
                ids = np.append(encode(text.as_py(), content.value), np.uint32(closing_id)).astype("<u4")
                first = len(ids) % capacity or capacity
                for piece, (a, b) in enumerate(zip([0, *range(first, len(ids), capacity)], range(first, len(ids) + 1, capacity), strict=True)):
                    rows.append(row)
                    out.append((piece, a, b - a, zlib.crc32(ids[a:b].tobytes()), part, seen[b - a]))
                    seen[b - a] += 1
            if rows:
                columns = list(zip(*out, strict=True))
                kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(rows)), *[pa.array(np.array(c, np.int64)).cast(k) for c, k in zip(columns, kinds, strict=True)]],
                    names=["doc_id", "piece", "start", "length", "ids_crc32", "part", "local_rank"],
                )

    return docs.mapInArrow(run, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, part int, local_rank long")


def _configurations(sizes: np.ndarray, need: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Configurations (rows: how many of each size) and how often each is used, by column generation."""
    k = len(sizes)
    most = capacity // int(sizes.min())
    basis = np.diag(capacity // sizes).astype(float)  # columns are configurations
    use = np.linalg.solve(basis, need.astype(float))
    at = np.arange(capacity + 1)
    for _ in range(ROUNDS):
        worth = np.linalg.solve(basis.T, np.ones(k))
        best, choice = np.zeros(capacity + 1), []
        for _ in range(most):  # the most valuable configuration with one more item
            reach = at[:, None] - sizes[None, :]
            value = np.where(reach >= 0, best[np.maximum(reach, 0)] + worth[None, :], -1.0)
            pick = value.argmax(axis=1)
            gain = value[at, pick]
            better = gain > best + 1e-12
            choice.append(np.where(better, pick, -1))
            best = np.where(better, gain, best)
        if best[-1] <= 1 + 1e-7:
            break
        column, room = np.zeros(k), capacity
        for layer in reversed(choice):
            if layer[room] >= 0:
                column[layer[room]] += 1
                room -= sizes[layer[room]]
        step = np.linalg.solve(basis, column)
        ratio = np.where(step > 1e-9, use / np.where(step > 1e-9, step, 1), np.inf)
        out = int(ratio.argmin())
        basis[:, out] = column
        use = np.maximum(np.linalg.solve(basis, need.astype(float)), 0)
    return basis.T.astype(int), use


def _grouped(counts: dict[int, int], large: int, groups: int) -> list[list[list[int]]]:
    """Large lengths, longest first, in groups of equal cardinality: runs ``[length, count]``."""
    total = sum(n for size, n in counts.items() if size >= large)
    quota, out, room = -(-total // groups) if total else 0, [], 0
    for size in sorted((s for s in counts if s >= large), reverse=True):
        n = counts[size]
        while n:
            if not room:
                out.append([])
                room = quota
            take = min(n, room)
            out[-1].append([size, take])
            n, room = n - take, room - take
    return out


def plan_packing(counts: dict[int, int], capacity: int = CAPACITY, shares: tuple[int, ...] = SHARES, groups: int = GROUPS) -> np.ndarray:
    """Slots ``(length, first rank, per sequence, first sequence, offset)`` that pack the histogram.

    Rank r of a length lies in the slot with the largest first rank up to r; with d = r - first rank
    its sequence is first sequence + d // per sequence, its place offset + (d % per sequence) * length.
    """
    fewest, best = None, np.zeros((0, 5), np.int64)
    for share in shares:
        slots, sequences = _plan(counts, capacity, max(1, capacity // share), groups)
        if fewest is None or sequences < fewest:
            fewest, best = sequences, slots
        if fewest * capacity < sum(s * n for s, n in counts.items()) + capacity:
            break  # no packing has fewer
    return best


def _plan(counts: dict[int, int], capacity: int, large: int, groups: int) -> tuple[np.ndarray, int]:
    """The slots of one plan and how many sequences it takes; lengths from ``large`` on go through configurations."""
    counts = {int(s): int(n) for s, n in counts.items() if n > 0}
    left = dict(counts)
    bins: dict[int, list[tuple[int, list[tuple[int, int]]]]] = {}  # room -> runs of (how many sequences, [(length, times)])

    def put(n: int, content: list[tuple[int, int]]) -> None:
        if n:
            bins.setdefault(capacity - sum(s * t for s, t in content), []).append((n, content))

    def merged(content: list[int]) -> list[tuple[int, int]]:
        return [(s, content.count(s)) for s in sorted(set(content), reverse=True)]

    queues = _grouped(counts, large, groups)
    if queues:
        sizes, need = np.array([q[0][0] for q in queues]), np.array([sum(n for _, n in q) for q in queues])
        # groups that begin with the same length are one size
        names, back = np.unique(-sizes, return_inverse=True)
        total = np.bincount(back, weights=need).astype(np.int64)
        queue: list[list[list[int]]] = [[] for _ in names]
        for g, q in zip(back, queues, strict=True):
            queue[g].extend([list(run) for run in q])
        shapes, use = _configurations(-names, total, capacity)
        for shape, n in zip(shapes, np.floor(use + 1e-6).astype(int), strict=True):
            slots = [g for g, times in enumerate(shape) for _ in range(times)]
            n = min([n, *(sum(r[1] for r in queue[g]) // t for g, t in enumerate(shape) if t)])
            while n > 0:  # as far as every slot keeps one length
                wanted: dict[int, int] = {}
                for g in slots:
                    wanted[g] = wanted.get(g, 0) + 1
                run = min([n, *(max(1, queue[g][0][1] // t) if queue[g][0][1] >= t else 1 for g, t in wanted.items())])
                content = []
                for g, t in wanted.items():
                    take = run * t
                    if queue[g][0][1] < take:  # one sequence across the border of two lengths
                        for _ in range(t):
                            content.append(queue[g][0][0])
                            queue[g][0][1] -= 1
                            if not queue[g][0][1]:
                                queue[g].pop(0)
                    else:
                        content += [queue[g][0][0]] * t
                        queue[g][0][1] -= take
                        if not queue[g][0][1]:
                            queue[g].pop(0)
                for s in content:
                    left[s] -= run
                put(run, merged(content))
                n -= run
    for size in sorted((s for s, n in left.items() if n), reverse=True):
        n = left[size]
        while n:
            room = min((r for r in bins if r >= size), default=None)
            runs = bins.pop(room) if room is not None else [(n, [])]
            per = (capacity if room is None else room) // size
            while runs:
                many, content = runs.pop()
                full = min(many, n // per)
                put(full, [*content, (size, per)])
                n -= full * per
                rest = many - full
                if rest and n and n < per:  # the last ones share a sequence
                    put(1, [*content, (size, n)])
                    n, rest = 0, rest - 1
                if content:
                    put(rest, content)
    slots, ranks, sequence = [], dict.fromkeys(counts, 0), 0
    for runs in bins.values():
        for many, content in runs:
            offset = 0
            for size, per in content:
                slots.append((size, ranks[size], per, sequence, offset))
                ranks[size] += many * per
                offset += size * per
            sequence += many
    return np.array(sorted(slots), np.int64).reshape(-1, 5), sequence


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Stored pieces of ``cut_pieces`` with ``sequence_id`` and ``offset``."""
    spark = pieces.sparkSession
    counts = store(pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n")))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most ``capacity`` rows
    slots = spark.sparkContext.broadcast(plan_packing(histogram, capacity))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = counts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        table = slots.value
        size, rank = length.to_numpy(np.int64), rank.to_numpy(np.int64)
        key = table[:, 0] * (1 << 44) + table[:, 1]
        hit = table[np.searchsorted(key, size * (1 << 44) + rank, side="right") - 1]
        ahead, per = rank - hit[:, 1], hit[:, 2]
        return pd.DataFrame({"sequence_id": hit[:, 3] + ahead // per, "offset": hit[:, 4] + ahead % per * size})

    ranked = pieces.join(firsts, ["part", "length"]).withColumn("at", place("length", F.col("before") + F.col("local_rank")))
    return ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "at.sequence_id", "at.offset")


def pack_documents(docs: DataFrame, vocabulary: bytes | None = None, capacity: int = CAPACITY) -> DataFrame:
    """Every document's pieces with their sequence and place in it."""
    return pack(store(cut_pieces(docs, vocabulary or read_vocabulary(), capacity)), capacity)


def read_vocabulary(path: str | None = None) -> bytes:
    """A tokenizer file's content, read on the driver (about 1 MB) and sent to the tasks from there."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("byte_bpe_50k.json")
    with open(path, "rb") as f:
        return f.read()


def digest(spark: SparkSession, docs: DataFrame) -> DataFrame:
    return pack_documents(docs)
