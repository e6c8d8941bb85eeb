"""Periodic runs of words, found with an enhanced suffix array.

A run is a stretch of consecutive words that repeats with a smallest period ``q``, spans at least
``max(MIN_LENGTH, 2 * q)`` words and cannot be extended on either side. Texts are handled where they
lie; a task takes many short texts (or one long one) at a time as one array of word numbers in which
every text has numbers of its own, so nothing matches across texts and one set of array operations
serves them all.

1. Suffix array, its inverse (ISA) and the LCP of neighbours, by prefix doubling: a round sorts only
   the suffixes that are still tied, and the ranks of the rounds give the LCP by binary descent.
2. Branching-tandem test, without any tree nodes: an LCP interval is the stretch of the suffix array
   around a boundary whose LCP values are not smaller; its children are peeled off from the left, one
   boundary at a time, and each suffix ``i`` of the smaller side looks up ``ISA[i + depth]`` and
   ``ISA[i - depth]``. If that rank lies in the other side, the two suffixes agree in exactly
   ``depth`` words: the last square of a run of that period. Smaller sides add up to n log n at most.
3. Squares are rotated to the left until the words differ, which gives the run's start. Squares that
   end at the same word and whose period is a multiple of a run's period belong to that run: they
   are merged into it before they are rotated, so one word repeated n times costs n, not n * n.

Memory is about 8 * log2(n) bytes a word for the texts that are handled together: ``GROUP_WORDS`` or one
longer text, which is never cut.

Defined results: a null, empty or blank text has no words and no runs, and an empty collapsed text;
a null id counts as the empty string where the query derives numbers from ids; repeated rows are
analysed each; ties cannot arise between runs (start and period name a run); an empty table gives an
empty result; the columns of the input never mix with those added.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MIN_LENGTH = 12
#: Words that are handled together; a longer text is handled alone.
GROUP_WORDS = 1 << 17
#: Suffixes of smaller sides that are looked up at once.
LOOKUPS = 1 << 20

#: Changes the words of a text before the search: from its id and number of words the first word to
#: replace and the period to repeat from there; None leaves the text as it is.
Edit = Callable[[object, int], tuple[int, int] | None]


def _refine(rank: np.ndarray, tied: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ranks after sorting the ``tied`` suffixes inside their groups by ``second``; what is still tied.

    A rank is the place of its group's first member among all suffixes, so other groups keep theirs.
    """
    key = (rank[tied].astype(np.int64) << 32) | second
    order = np.argsort(key)
    key, members = key[order], tied[order]
    old = key >> 32
    place = np.arange(len(members))
    new_group = np.r_[True, key[1:] != key[:-1]]
    old_group = np.r_[True, old[1:] != old[:-1]]
    starts = np.maximum.accumulate(np.where(new_group, place, 0))
    ranks = rank.copy()
    ranks[members] = (old + starts - np.maximum.accumulate(np.where(old_group, place, 0))).astype(np.int32)
    sizes = np.diff(np.r_[np.flatnonzero(new_group), len(members)])
    return ranks, members[np.repeat(sizes > 1, sizes)]


def suffix_array(w: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(SA, ISA, LCP) of numbers below 2**31; ``LCP[k]`` belongs to ``SA[k - 1]`` and ``SA[k]``, -1 at both ends."""
    n = len(w)
    rank, tied = _refine(np.zeros(n, np.int32), np.arange(n), w.astype(np.int64))
    levels, step = [np.r_[rank, np.int32(-1)]], 1
    while len(tied):
        after = tied + step
        second = np.where(after < n, rank[np.minimum(after, n - 1)] + np.int64(1), 0)
        rank, tied = _refine(rank, tied, second)
        levels.append(np.r_[rank, np.int32(-1)])
        step *= 2
    order = np.empty(n, np.int32)
    order[rank] = np.arange(n, dtype=np.int32)
    lcp = np.zeros(n + 1, np.int32)
    lcp[0] = lcp[n] = -1
    at = 1 + np.flatnonzero(levels[0][order[1:]] == levels[0][order[:-1]])
    a, b = order[at - 1].astype(np.int64), order[at].astype(np.int64)
    same = np.zeros(len(at), np.int64)
    for k in range(len(levels) - 2, -1, -1):  # in the last round all ranks differ
        same += (levels[k][a + same] == levels[k][b + same]).astype(np.int64) << k
    lcp[at] = same
    return order, rank, lcp


def _sides(lcp: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Boundaries ``k`` of positive LCP with the bounds ``left <= k - 1 < k < right`` of their interval's two sides.

    Left of ``k`` all LCP values are larger, right of it none is smaller: equal boundaries of an
    interval take their children off from the left.
    """
    n = len(lcp) - 1
    at = np.flatnonzero(lcp > 0)
    if not len(at):
        return at, at, at
    gaps = np.diff(np.r_[-1, np.flatnonzero(lcp <= 0), n + 1])
    tables = [lcp]
    while 2 ** len(tables) <= gaps.max():
        half, t = 1 << (len(tables) - 1), tables[-1]
        tables.append(np.minimum(t, np.r_[t[half:], np.full(half, -1, np.int32)]))
    value, left, right = lcp[at], at.copy(), at + 1
    for j in range(len(tables) - 1, -1, -1):
        span, t = 1 << j, tables[j]
        left = left - span * ((left >= span) & (t[np.maximum(left - span, 0)] > value))
        right = right + span * ((right + span <= n + 1) & (t[np.minimum(right, n)] >= value))
    return at, left - 1, right


def branching_squares(w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and periods of all squares whose two halves' suffixes agree in exactly one period."""
    order, rank, lcp = suffix_array(w)
    n = len(w)
    at, left, right = _sides(lcp)
    smaller_left = at - left <= right - at
    low, size = np.where(smaller_left, left, at), np.where(smaller_left, at - left, right - at)
    other_low, other_high = np.where(smaller_left, at, left), np.where(smaller_left, right, at)
    starts, periods = [], []
    ends = np.cumsum(size)
    first = 0
    while first < len(at):
        last = max(first + 1, int(np.searchsorted(ends, (ends[first - 1] if first else 0) + LOOKUPS, "right")))
        many = size[first:last]
        box = np.repeat(np.arange(first, last), many)
        inside = np.arange(len(box)) - np.repeat(np.cumsum(many) - many, many)
        i, depth = order[low[box] + inside].astype(np.int64), lcp[at[box]].astype(np.int64)
        for partner, start in ((i + depth, i), (i - depth, i - depth)):
            known = (partner >= 0) & (partner < n)
            r = rank[np.where(known, partner, 0)]
            hit = known & (r >= other_low[box]) & (r < other_high[box])
            starts.append(start[hit])
            periods.append(depth[hit])
        first = last
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *starts]), np.concatenate([none, *periods])


def _rotated(w: np.ndarray, start: int, period: int) -> int:
    """The leftmost start that a square reaches by rotation."""
    block = 64
    while start:
        b = min(block, start)
        differ = np.flatnonzero(w[start - b : start] != w[start - b + period : start + period])
        if len(differ):
            return start - b + int(differ[-1]) + 1
        start, block = start - b, 2 * block
    return 0


def runs_of(w: np.ndarray, min_length: int = MIN_LENGTH) -> list[tuple[int, int, int]]:
    """``(start, length, period)`` of all runs of an array of numbers, by start, then period."""
    if len(w) < min_length:
        return []
    start, period = branching_squares(w)
    reach, going = np.zeros(len(start), np.int64), np.ones(len(start), bool)
    for t in range(1, min_length + 1):  # squares that cannot become long enough are most of them
        back = start - t
        going &= (back >= 0) & (w[np.maximum(back, 0)] == w[np.maximum(back + period, 0)])
        reach += going
    long_enough = 2 * period + reach >= min_length
    start, period = start[long_enough], period[long_enough]
    end = start + 2 * period
    found, here, at = [], [], -1
    for k in np.lexsort((period, end)).tolist():
        s, p, e = int(start[k]), int(period[k]), int(end[k])
        if e != at:
            here, at = [], e
        if any(p % q == 0 and s >= first for first, q in here):
            continue  # a multiple of the period of a run that ends here and holds this square
        first = _rotated(w, s, p)
        here.append((first, p))
        found.append((first, e - first, p))
    return sorted(((s, n, p) for s, n, p in found if n >= min_length), key=lambda r: (r[0], r[2]))


def analyse_texts(texts: list[str | None], ids: list | None = None, edit: Edit | None = None, min_length: int = MIN_LENGTH) -> list[tuple[list[tuple[int, int, int]], str]]:
    """For each text its runs and the text without the words that runs repeat, joined by single spaces."""
    split = [t.encode("utf-8", "replace").split() if t else [] for t in texts]
    sizes = np.array([len(x) for x in split], np.int64)
    words = [x for s in split for x in s]
    if not words:
        return [([], "") for _ in texts]
    ends = np.cumsum(sizes)
    taken = np.arange(len(words))
    for d, id_ in enumerate(ids if ids is not None and edit is not None else []):
        change = edit(id_, int(sizes[d])) if sizes[d] else None
        if change is not None:
            a, p = change
            low, n = int(ends[d] - sizes[d]) + a, int(sizes[d]) - a
            taken[low : low + n] = low + np.arange(n) % p
    numbers, distinct = pd.factorize(np.array(words, dtype=object))
    numbers = numbers[taken].astype(np.int64) + np.repeat(np.arange(len(texts)), sizes) * len(distinct)
    numbers = np.unique(numbers, return_inverse=True)[1]
    found: list[list] = [[] for _ in texts]
    drop = np.zeros(len(words) + 1, np.int64)
    for s, n, p in runs_of(numbers, min_length):
        d = int(np.searchsorted(ends, s, "right"))
        found[d].append((s - int(ends[d] - sizes[d]), n, p))
        drop[s + p] += 1
        drop[s + n] -= 1
    kept = np.cumsum(drop[:-1]) == 0
    out = []
    for d, (e, n) in enumerate(zip(ends.tolist(), sizes.tolist(), strict=True)):
        places = taken[e - n : e]
        own = split[d] if kept[e - n : e].all() and (places == np.arange(e - n, e)).all() else [words[i] for i in places[kept[e - n : e]]]
        out.append((found[d], b" ".join(own).decode()))
    return out


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def find_runs(docs: DataFrame, min_length: int = MIN_LENGTH, edit: Edit | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``runs`` (structs of start, length and period, by start, then period) and ``collapsed``, one row per row."""
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            low, size = 0, 0
            for row in range(batch.num_rows):
                value = batch.column(1)[row]
                # a word and its space are two bytes at least: half of the bytes bound the words
                size += (value.as_buffer().size + 1) // 2 if value.is_valid else 0
                if size >= 3 * GROUP_WORDS or row == batch.num_rows - 1:
                    part = batch.slice(low, row + 1 - low)
                    found = analyse_texts(part.column(1).to_pylist(), part.column(0).to_pylist(), edit, min_length)
                    runs = [[{"start": s, "length": n, "period": p} for s, n, p in r] for r, _ in found]
                    yield pa.RecordBatch.from_arrays([part.column(0), pa.array(runs, pa.list_(_RUN)), pa.array([c for _, c in found], pa.string())], names=["doc_id", "runs", "collapsed"])
                    low, size = row + 1, 0

    return docs.mapInArrow(run, f"doc_id {kind}, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string")


def collapse(docs: DataFrame, min_length: int = MIN_LENGTH) -> DataFrame:
    """``docs`` (all columns) with every run cut to its first period; texts without runs are left as they are."""
    names = docs.columns

    @F.pandas_udf("string")
    def cut(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            own = texts.where(texts.notna(), None).tolist()
            out, low, size = [], 0, 0
            for row, text in enumerate(own):
                size += len(text or "")
                if size >= 6 * GROUP_WORDS or row == len(own) - 1:
                    part = own[low : row + 1]
                    out += [c if r else t for t, (r, c) in zip(part, analyse_texts(part, min_length=min_length), strict=True)]
                    low, size = row + 1, 0
            yield pd.Series(out, dtype="object")

    return docs.select(*[cut(F.col("text").cast("string")).alias("text") if c == "text" else F.col(f"`{c}`") for c in names])


def planted(doc_id, n_words: int) -> tuple[int, int] | None:
    """The repetition that the query plants in every tenth text, by the crc32 of its id."""
    h = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n_words
    return a, 1 + (n_words - a) // (3 + g % 8)


def digest(docs: DataFrame) -> DataFrame:
    found = find_runs(docs, edit=planted)
    # the greatest length, then the smallest start and period
    best = F.array_min(F.transform("runs", lambda r: F.struct((-r.length).alias("l"), r.start.alias("s"), r.period.alias("p"))))
    lines = F.concat(F.array_join(F.transform("runs", lambda r: F.concat(r.start, F.lit(","), r.length, F.lit(","), r.period, F.lit("\n"))), ""))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"),
        F.col("best.s").alias("start"), (-F.col("best.l")).alias("length"), F.col("best.p").alias("period"),
        F.expr("(-best.l * 1000) div best.p").alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
