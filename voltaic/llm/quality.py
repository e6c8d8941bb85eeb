"""Line-first quality rules, with Spark expressions only.

Every line of a text is judged by itself: punctuation (it must hold a sentence's end, few signs and no
shouting), navigation (items between separators) and boilerplate (notices that sites repeat: each stands for
``NOTICE_SPAN`` code points, and a line fails if its notices stand for half of it or more). Lines
that fail are removed; a text that loses more than half of its code points that way is rejected. The
base rules reject texts of fewer than ``MIN_WORDS`` words and texts of which more than half of the words
lie in repeated three-word windows.

A text's repeated windows are found inside its row: its windows are sorted by a hash and their
words, and equal neighbours mark their positions, so the work is that of a sort, however repetitive
the text is. No rows are exchanged.

Defined results: a null or empty text has no words and is rejected by the base rules; blank lines
stay and count for nothing, so a text whose lines all pass is left as it is; repeated rows are judged each; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltaic.llm.native import let, words

MIN_WORDS = 50
SYMBOLS = r"[#*$%&|<>]+"
#: A line holds the end of a sentence or clause: a closing mark before white space or the line's end.
ENDING = r"[.!?;:…。！？\"”»)\]](?:[\x20\x09-\x0D]|\z)"
SEPARATOR = r"[|›»·•]"
#: Notices that sites repeat on many pages.
BOILERPLATE = (
    r"(?i)\b(?:all rights reserved|privacy policy|terms of (?:use|service)|cookie (?:policy|settings)|(?:uses?|accept) cookies"
    r"|(?:enable|requires) javascript|subscribe to our|sign up for|log in to|click here|share this|lorem ipsum|skip to (?:main )?content)\b|©"
)

#: Code points of a line that one notice stands for: the notice and the words around it.
NOTICE_SPAN = 60


def count_of(text: Column, pattern: str) -> Column:
    """How many code points of a text lie in matches of ``pattern``."""
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


def line_passes(line: Column) -> Column:
    """The verdict on one line that has a word."""

    def judged(n_words: Column) -> Column:
        punctuation = line.rlike(ENDING) & (10 * count_of(line, SYMBOLS) <= F.length(line)) & (5 * count_of(line, "!!") <= 2 * n_words)
        separators = count_of(line, SEPARATOR)
        navigation = (separators >= 3) & (4 * separators >= n_words)
        boilerplate = line.rlike(BOILERPLATE) & (2 * NOTICE_SPAN * F.regexp_count(line, F.lit(BOILERPLATE)) >= F.length(line))
        return punctuation & ~navigation & ~boilerplate

    return let(F.size(words(line)), judged)


def repeated_words(w: Column) -> Column:
    """How many words lie in three-word windows that occur twice or more in the array ``w``."""

    def window(i: Column) -> Column:
        a, b, c = F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)
        return F.struct(F.xxhash64(a, b, c).alias("h"), a.alias("a"), b.alias("b"), c.alias("c"), i.alias("i"))

    def same(x: Column, y: Column) -> Column:
        return F.coalesce((x.h == y.h) & (x.a == y.a) & (x.b == y.b) & (x.c == y.c), F.lit(False))

    def positions(s: Column) -> Column:
        marked = F.transform(s, lambda x, k: F.when(same(x, F.get(s, k - 1)) | same(x, F.get(s, k + 1)), x.i))
        return F.sort_array(F.filter(marked, lambda i: i.isNotNull()))

    def covered(p: Column) -> Column:
        spans = F.transform(p, lambda i, k: F.least(F.lit(3), F.coalesce(F.get(p, k + 1) - i, F.lit(3))))
        return F.aggregate(spans, F.lit(0).cast("long"), lambda total, n: total + n)

    windows = F.when(F.size(w) >= 3, F.transform(F.sequence(F.lit(0), F.size(w) - 3), window))
    return F.coalesce(let(let(F.sort_array(windows), positions), covered), F.lit(0).cast("long"))


def judge(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with a struct ``quality``: the counts, ``base_failed``, ``kept`` and the cleaned text ``clean``."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))

    def measured(w: Column) -> Column:
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            repeated_words(w).alias("n_repeat_words"),
        )

    has_word = lambda line: line.rlike(r"[^\x20\x09-\x0D]")
    chars = lambda lines: F.aggregate(lines, F.lit(0).cast("long"), lambda n, x: n + F.length(x))

    def lined(every: Column) -> Column:
        def counted(lines: Column, kept: Column) -> Column:
            return F.struct(
                (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
                F.array_join(kept, "\n").alias("clean"),
                (2 * chars(F.filter(kept, has_word)) < chars(lines)).alias("lost"),
            )

        kept = F.filter(every, lambda line: ~has_word(line) | line_passes(line))
        return let(F.filter(every, has_word), lambda lines: let(kept, lambda k: counted(lines, k)))

    rows = docs.withColumn("__w", let(words(text), measured))
    rows = rows.withColumn("__l", let(F.split(text, "\n"), lined))
    failed = (F.col("__w.n_words") < MIN_WORDS) | (100 * F.col("__w.n_repeat_words") > 50 * F.col("__w.n_words"))
    quality = F.struct(
        "__w.n_words", "__w.word_chars", count_of(text, SYMBOLS).cast("long").alias("n_symbols"), "__l.n_dup_lines", "__w.n_repeat_words",
        failed.alias("base_failed"), (~failed & ~F.col("__l.lost")).alias("kept"), F.col("__l.clean").alias("clean"),
    )
    return rows.select(*[F.col(f"`{c}`") for c in docs.columns], quality.alias("quality"))


def digest(docs: DataFrame) -> DataFrame:
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    return judge(docs.select("doc_id", "text")).select("doc_id", *[f"quality.{n}" for n in names])


def keep_clean(docs: DataFrame) -> DataFrame:
    """The rows that pass, with their failed lines removed and ``n_chars`` (where there is one) counted anew."""
    judged = judge(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("text")))
    kept = judged.filter("quality.kept")
    columns = {c: F.col("row")[c] for c in docs.columns} | {"text": F.col("quality.clean")}
    if "n_chars" in columns:
        columns["n_chars"] = F.length("quality.clean").cast(docs.schema["n_chars"].dataType)
    return kept.select(*[v.alias(k) for k, v in columns.items()])


#: The same rules as list functions over positions.
ORACLE_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT r, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM d),
g AS (
  SELECT r, i, count(*) OVER (PARTITION BY r, a, b, c) AS n FROM (
    SELECT r, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM w WHERE len(w) >= 3)
  )
),
p AS (SELECT r, count(DISTINCT i + k) AS n FROM g, (VALUES (0), (1), (2)) t(k) WHERE g.n > 1 GROUP BY r),
l AS (SELECT r, line, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM d)),
j AS (
  SELECT r, line,
    regexp_matches(line, '[.!?;:…。！？"”»)\]](?:[\x20\x09-\x0D]|\z)')
    AND 10 * (length(line) - length(regexp_replace(line, '[#*$%&|<>]', '', 'g'))) <= length(line)
    AND 5 * (length(line) - length(replace(line, '!!', ''))) <= 2 * n
    AND NOT (length(line) - length(regexp_replace(line, '[|›»·•]', '', 'g')) >= 3 AND 4 * (length(line) - length(regexp_replace(line, '[|›»·•]', '', 'g'))) >= n)
    AND NOT coalesce(nullif(120 * len(regexp_extract_all(line, '(?i)\b(?:all rights reserved|privacy policy|terms of (?:use|service)|cookie (?:policy|settings)|(?:uses?|accept) cookies|(?:enable|requires) javascript|subscribe to our|sign up for|log in to|click here|share this|lorem ipsum|skip to (?:main )?content)\b|©')), 0) >= length(line), false) AS ok
  FROM l WHERE n > 0
),
q AS (SELECT r, count(*) - count(DISTINCT line) AS dup, 2 * coalesce(sum(length(line)) FILTER (ok), 0) < sum(length(line)) AS lost FROM j GROUP BY r),
m AS (
  SELECT d.doc_id, CAST(len(w.w) AS BIGINT) AS n_words, CAST(coalesce(list_sum(list_transform(w.w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
    CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(coalesce(q.dup, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(p.n, 0) AS BIGINT) AS n_repeat_words, coalesce(q.lost, false) AS lost
  FROM d JOIN w USING (r) LEFT JOIN p USING (r) LEFT JOIN q USING (r)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT lost AS kept
FROM (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
"""
