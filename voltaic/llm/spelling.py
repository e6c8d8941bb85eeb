"""Spelling variants of a corpus vocabulary, found by reduced-alphabet generation.

1. ``count_words``: occurrences are counted by partial aggregation, so a very frequent word costs a row
   per task.
2. Letters are hashed to a few symbols. Words within one edit (one code point inserted, deleted or
   replaced) have reduced words within one edit, so all links lie between a reduced word and the
   members of its full one-edit neighbourhood: itself and every deletion, substitution and insertion
   over the few symbols. The neighbourhood of each distinct reduced word is generated as
   64-bit hashes, each in constant time from prefix sums (``_sums``), so a word of any length costs
   its length. The hashes are joined with the reduced vocabulary; a hash that stands for two reduced
   words only adds candidates.
3. Candidates are the members of two joined reduced words, verified on the original strings.
   Where two reduced words have more than ``CROWD`` pairs of members, no pairs are formed: all their
   members meet once more by their own strings (each word without one of its code points, and
   each word as a whole), where a group has at most one member for each letter. That is exact, too, so
   no group of words ever forms all its pairs and no link is lost.
4. A word's form is its near word of the largest count if that is ``RATIO`` times its own; counts grow at
   every step, so forms are followed to the last in a few rounds of doubling.

Defined results: a null or empty text has no words; a null id counts as an empty string where the
query derives numbers from ids; a tie between near words of the same count goes to the first in
code-point order; repeated rows count each; an empty table gives an empty result; other columns are
not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltaic.llm.common import store

#: Letters of words: A-Z are lower-cased, the others are taken as they are.
LETTERS = "abcdefghijklmnopqrstuvwxyz" + "".join(map(chr, range(0xC0, 0x100)))
MIN_LETTERS = 7
MIN_COUNT = 2
#: A form occurs at least this many times as often.
RATIO = 10
SYMBOLS = 4
#: Pairs of members that two reduced words may form.
CROWD = 4096

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def _weights(code: np.ndarray) -> np.ndarray:
    """Odd, scattered 64-bit numbers for small numbers."""
    x = (code.astype(np.uint64) + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0x94D049BB133111EB)
    return (x ^ (x >> np.uint64(27))) | np.uint64(1)


def symbols_of(letters: str, symbols: int = SYMBOLS) -> str:
    """The symbol, a letter itself, that each letter is hashed to."""
    return "".join(chr(97 + int(w >> np.uint64(40)) % symbols) for w in _weights(np.array([ord(c) for c in letters])))


class _Sums:
    """Words as one array of code points, with what the hash of any one-edit neighbour needs.

    The hash of a string c[0], c[1], ... is the sum of weight(c[j]) * BASE**j modulo 2**64.
    """

    def __init__(self, words: list[str]):
        sizes = np.array([len(w) for w in words], np.int64)
        self.codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
        self.word = np.repeat(np.arange(len(words)), sizes)
        ends = np.cumsum(sizes)
        self.place = np.arange(len(self.codes)) - (ends - sizes)[self.word]
        powers = np.ones(int(sizes.max(initial=0)) + 2, np.uint64)
        np.multiply.accumulate(np.r_[np.uint64(1), np.full(len(powers) - 1, _BASE)], out=powers)
        self.power = powers[self.place]
        self.own = _weights(self.codes) * self.power
        run = np.cumsum(self.own, dtype=np.uint64)
        base = np.r_[np.uint64(0), run][ends - sizes]
        self.total = np.r_[np.uint64(0), run][ends] - base  # of each word
        self.before = run - self.own - base[self.word]
        self.after = self.total[self.word] - self.before - self.own
        self.end_power = powers[sizes]

    def deletions(self) -> np.ndarray:
        return self.before + self.after * _INVERSE

    def replaced(self, code: int) -> np.ndarray:
        return self.before + _weights(np.array([code]))[0] * self.power + self.after

    def inserted(self, code: int) -> tuple[np.ndarray, np.ndarray]:
        """In front of each code point, and at the end of each word."""
        w = _weights(np.array([code]))[0]
        return self.before + w * self.power + (self.own + self.after) * _BASE, self.total + w * self.end_power


def neighbourhoods(words: list[str], symbols: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the words; rows and hashes of their full one-edit neighbourhoods, themselves included, each once."""
    s = _Sums(words)
    every = np.arange(len(words))
    rows, hashes = [every, s.word], [s.total, s.deletions()]
    for c in map(ord, symbols):
        inside, end = s.inserted(c)
        rows += [s.word, s.word, every]
        hashes += [s.replaced(c), inside, end]
    row, value = np.concatenate(rows), np.concatenate(hashes)
    order = np.lexsort((value, row))
    row, value = row[order], value[order]
    new = np.r_[True, (row[1:] != row[:-1]) | (value[1:] != value[:-1])][: len(row)]
    return s.total, row[new], value[new]


def _arrow(rows: DataFrame, column: str, make, kinds: str, letters: int = 1 << 16) -> DataFrame:
    """``make(record batch, strings)`` on parts of about so many letters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            strings = batch.column(column).to_pylist()
            low, size = 0, 0
            for row, s in enumerate(strings):
                size += len(s)
                if size >= letters or row == len(strings) - 1:
                    yield make(batch.slice(low, row + 1 - low), strings[low : row + 1])
                    low, size = row + 1, 0

    return rows.mapInArrow(run, kinds)


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.astype(np.uint64).view(np.int64))


def reduced_neighbours(reduced: DataFrame, symbols: str) -> DataFrame:
    """``own, near``: hashes of each reduced word and of its full one-edit neighbourhood."""

    def make(batch: pa.RecordBatch, strings: list[str]) -> pa.RecordBatch:
        own, row, value = neighbourhoods(strings, symbols)
        return pa.RecordBatch.from_arrays([_signed(own[row]), _signed(value)], names=["own", "near"])

    return _arrow(reduced.select("reduced"), "reduced", make, "own bigint, near bigint")


def _hashed(words: DataFrame, column: str, name: str) -> DataFrame:
    """``words`` with the hash of a column's strings."""

    def make(batch: pa.RecordBatch, strings: list[str]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([*batch.columns, _signed(_Sums(strings).total)], names=[*batch.schema.names, name])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in words.schema.fields)
    return _arrow(words, column, make, f"{kinds}, {name} bigint")


def _own_keys(words: DataFrame) -> DataFrame:
    """``key, kind, word, n``: each word as a whole (0), without each code point (1), and with each replaced by a blank (2)."""

    def make(batch: pa.RecordBatch, strings: list[str]) -> pa.RecordBatch:
        s = _Sums(strings)
        every = np.arange(len(strings))
        row = np.concatenate([every, s.word, s.word])
        kind = np.repeat(np.array([0, 1, 2], np.int32), [len(every), len(s.word), len(s.word)])
        key = np.concatenate([s.total, s.deletions(), s.replaced(0)])
        picked = batch.take(pa.array(row))
        return pa.RecordBatch.from_arrays([_signed(key), pa.array(kind), picked.column("word"), picked.column("n")], names=["key", "kind", "word", "n"])

    return _arrow(words.select("word", "n"), "word", make, "key bigint, kind int, word string, n bigint").distinct()


def _verified(a: str, b: str) -> Column:
    return F.levenshtein(F.col(a), F.col(b), 1) == 1


def near_pairs(words: DataFrame, symbols: int = SYMBOLS, crowd: int = CROWD) -> DataFrame:
    """``a, a_n, b, b_n``: all pairs of ``words`` (``word, n``; distinct words) within one edit, each once, in no set order."""
    symbols_used = "".join(chr(97 + i) for i in range(symbols))
    reduced = F.translate("word", LETTERS, symbols_of(LETTERS, symbols))
    marked = store(_hashed(words.select("word", "n", reduced.alias("reduced")), "reduced", "h"))
    sizes = store(marked.groupBy("h").agg(F.count(F.lit(1)).alias("size")))
    near = reduced_neighbours(marked.select("reduced").distinct(), symbols_used).filter("own <= near")
    pairs = near.join(sizes.select(F.col("h").alias("near"), F.col("size").alias("near_size")), "near")
    pairs = store(pairs.join(sizes.select(F.col("h").alias("own"), F.col("size").alias("own_size")), "own").dropDuplicates(["own", "near"]))

    few = pairs.filter(F.col("own_size") * F.col("near_size") <= crowd).select("own", "near")
    left = marked.select(F.col("h").alias("own"), F.col("word").alias("a"), F.col("n").alias("a_n"))
    right = marked.select(F.col("h").alias("near"), F.col("word").alias("b"), F.col("n").alias("b_n"))
    close = few.join(left, "own").join(right, "near").filter("own <> near or a < b").filter(_verified("a", "b")).select("a", "a_n", "b", "b_n")

    many = pairs.filter(F.col("own_size") * F.col("near_size") > crowd)
    crowded = many.select(F.explode(F.array("own", "near")).alias("h")).distinct()
    keys = store(_own_keys(marked.join(crowded, "h", "left_semi")))
    one = keys.select("key", "kind", F.col("word").alias("a"), F.col("n").alias("a_n"))
    two = keys.select("key", F.col("kind").alias("kind_b"), F.col("word").alias("b"), F.col("n").alias("b_n"))
    shorter = one.filter("kind = 1").join(two.filter("kind_b = 0"), "key")
    replaced = one.filter("kind = 2").join(two.filter("kind_b = 2"), "key").filter("a < b")
    exact = shorter.unionByName(replaced).filter(_verified("a", "b")).select("a", "a_n", "b", "b_n")

    both = close.unionByName(exact)
    swap = F.col("a") < F.col("b")
    ends = [F.when(swap, F.col(x)).otherwise(F.col(y)).alias(name) for x, y, name in (("a", "b", "a"), ("a_n", "b_n", "a_n"), ("b", "a", "b"), ("b_n", "a_n", "b_n"))]
    return both.select(*ends).distinct()


def follow_forms(forms: DataFrame) -> DataFrame:
    """``word, root`` from ``word, form``: the last form that is reached. Chains never return, as counts grow."""
    found = store(forms.select("word", F.col("form").alias("root")))
    while True:
        after = found.select(F.col("word").alias("root"), F.col("root").alias("further"))
        stepped = store(found.join(after, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")))
        found = stepped.select("word", "root")
        if not stepped.filter("moved").limit(1).count():
            return found


def spelling_groups(words: DataFrame, ratio: int = RATIO, symbols: int = SYMBOLS, crowd: int = CROWD) -> DataFrame:
    """``word, form, root, n, n_near, form_n``, one row per row of ``words`` (``word, n``; distinct words)."""
    links = store(near_pairs(words, symbols, crowd))
    ways = links.select("a", "b", "b_n").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"), F.col("a_n").alias("b_n")))
    best = ways.groupBy(F.col("a").alias("word")).agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("b_n")).alias("less"), F.col("b").alias("b"))).alias("best"))
    known = words.join(best, "word", "left")
    has_form = -F.col("best.less") >= ratio * F.col("n")
    known = store(known.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(has_form, F.col("best.b")).alias("form"), F.when(has_form, -F.col("best.less")).alias("form_n"),
    ))
    roots = follow_forms(known.filter("form is not null"))
    return known.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def count_words(runs: DataFrame, min_letters: int = MIN_LETTERS, min_count: int = MIN_COUNT) -> DataFrame:
    """``word, n`` of the words that occur often enough, from one row per occurrence."""
    return runs.filter(F.length("word") >= min_letters).groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_count)


def letter_runs(docs: DataFrame, min_letters: int = MIN_LETTERS) -> DataFrame:
    """``doc_id, word``: every maximal run of letters of ``min_letters`` code points or more, A-Z lower-cased."""
    found = F.regexp_extract_all(F.col("text").cast("string"), F.lit(f"[A-Za-zÀ-ÿ]{{{min_letters},}}"), F.lit(0))
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return docs.select("doc_id", F.explode(found).alias("run")).select("doc_id", F.translate("run", upper, upper.lower()).alias("word"))


def misspelled(runs: DataFrame) -> DataFrame:
    """The query's occurrences: of some words of some documents, named by a crc32, one letter is missing."""
    h = F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("word")).cast("binary"))
    place = (F.col("h") % F.length("word")).cast("int")
    shorter = F.concat(F.substring("word", F.lit(1), place), F.substring("word", place + 2, F.length("word")))
    return runs.withColumn("h", h).select(F.when(F.col("h") % 31 == 0, shorter).otherwise(F.col("word")).alias("word"))


def digest(docs: DataFrame) -> DataFrame:
    return spelling_groups(store(count_words(misspelled(letter_runs(docs)))))
