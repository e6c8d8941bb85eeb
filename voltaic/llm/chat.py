"""Chat formatting with Spark expressions only.

A conversation's turns are collected as structs and sorted; adjacent turns of one role become one
marked block whose parts stay apart by a joint, and everything is concatenated:

    <|role:user|>text<|+|>text<|end|><|role:assistant|>text<|end|>

Inside texts and roles the characters that control strings need are replaced by two-character escapes
(``\\b`` for the backslash, ``\\l`` for ``<``, ``\\s`` for ``[``, and in roles ``\\p`` for ``|``), so no text can form a
control string, of this template or of those that mark turns by ``[INST]`` or ``</s>``, and the escape is undone exactly. The loss mask
is a run-length list over the formatted text's code points: the texts of assistant turns count, marks and
joints don't.

Defined results: a null text is empty, a null role the empty role; rows of one conversation with
equal turns are ordered by role and text; rows with a null id form one conversation; an empty table
gives an empty result. A conversation becomes one row, so its texts must fit in one string.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voltaic.llm.native import let

JOINT, END = "<|+|>", "<|end|>"
LOSS_ROLE = "assistant"


def escape(text: Column) -> Column:
    for plain, coded in (("\\", "\\b"), ("<", "\\l"), ("[", "\\s")):
        text = F.replace(text, F.lit(plain), F.lit(coded))
    return text


def unescape(text: Column) -> Column:
    for plain, coded in (("[", "\\s"), ("<", "\\l"), ("\\", "\\b")):
        text = F.replace(text, F.lit(coded), F.lit(plain))
    return text


def mark(role: Column) -> Column:
    return F.concat(F.lit("<|role:"), F.replace(escape(role), F.lit("|"), F.lit("\\p")), F.lit("|>"))


def format_conversations(rows: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """``conv_id, formatted, loss_mask`` (array of ``n`` code points and whether they count)."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    turns = rows.select(F.col(id_col).alias("conv_id"), F.struct("turn", text("role").alias("role"), text("text").alias("text")).alias("t"))
    turns = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))

    def parts(ts: Column) -> Column:
        def part(t: Column, i: Column) -> Column:
            first = F.coalesce(F.get(ts, i - 1).role != t.role, F.lit(True))
            last = F.coalesce(F.get(ts, i + 1).role != t.role, F.lit(True))
            return F.struct(
                F.when(first, mark(t.role)).otherwise(JOINT).alias("open"), escape(t.text).alias("body"),
                F.when(last, END).otherwise("").alias("close"), (t.role == LOSS_ROLE).alias("loss"),
            )

        return F.transform(ts, part)

    def output(ps: Column) -> Column:
        runs = F.transform(
            ps,
            lambda p: F.array(
                F.struct(F.length(p.open).alias("n"), F.lit(False).alias("loss")),
                F.struct(F.length(p.body).alias("n"), p.loss.alias("loss")),
                F.struct(F.length(p.close).alias("n"), F.lit(False).alias("loss")),
            ),
        )
        whole = F.array_join(F.transform(ps, lambda p: F.concat(p.open, p.body, p.close)), "")
        return F.struct(whole.alias("formatted"), F.flatten(runs).alias("loss_mask"))

    return turns.select("conv_id", let(parts(F.col("turns")), output).alias("o")).select("conv_id", "o.formatted", "o.loss_mask")


def under_mask(text: Column, mask: Column) -> Column:
    """The code points of a text that a run-length mask counts, by the runs' lengths alone."""
    flags = F.flatten(F.transform(mask, lambda r: F.array_repeat(r.loss, r.n)))
    return F.array_join(F.transform(F.filter(F.arrays_zip(F.split(text, "", -1).alias("c"), flags.alias("f")), lambda z: z.f), lambda z: z.c), "")


def read_back(formatted: DataFrame) -> DataFrame:
    """``formatted`` with ``turns`` (role, text, whether it counts) and ``loss_text``, read from the formatted text and the mask alone.

    The loss text is what lies under the mask, unescaped; turns are found by the control strings.
    """

    def block(b: Column) -> Column:
        head = F.substring_index(b, "|>", 1)
        role = unescape(F.replace(F.substr(head, F.lit(8)), F.lit("\\p"), F.lit("|")))
        bodies = F.split(F.substr(b, F.length(head) + 3), r"<\|\+\|>", -1)
        return F.transform(bodies, lambda x: F.struct(role.alias("role"), unescape(x).alias("text")))

    blocks = F.split("formatted", r"<\|end\|>", -1)
    found = F.flatten(F.transform(F.slice(blocks, 1, F.size(blocks) - 1), block))
    # the mask's runs come in threes: mark or joint, text, end or nothing
    flags = F.filter("loss_mask", lambda r, i: i % 3 == 1)
    turns = F.zip_with(found, flags, lambda t, r: F.struct(t.role.alias("role"), t.text.alias("text"), r.loss.alias("loss")))
    return formatted.withColumns({"turns": turns, "loss_text": unescape(under_mask(F.col("formatted"), F.col("loss_mask")))})


def digest_formatted(formatted: DataFrame) -> DataFrame:
    back = read_back(formatted)
    said = F.array_join(F.transform("turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n"))), "")
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"), F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"),
    )


def digest(spark: SparkSession, conversations: DataFrame) -> DataFrame:
    control = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
    rows = conversations.select("conv_id", "turn", "role", "text").unionByName(control)
    return digest_formatted(format_conversations(rows))


#: The digests from the rows themselves; only ``formatted_chars`` repeats the template's arithmetic.
ORACLE_SQL = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), n AS (
  SELECT *, row_number() OVER t AS i, lag(role) OVER t IS DISTINCT FROM role AS starts,
    length(text) + length(regexp_replace(text, '[^\\<\[]', '', 'g')) AS body,
    length(role) + length(regexp_replace(role, '[^\\<\[|]', '', 'g')) AS head
  FROM c WINDOW t AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY i) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(body) + sum(CASE WHEN starts THEN head + length('<|role:|><|end|>') ELSE length('<|+|>') END) AS BIGINT) AS formatted_chars
FROM n GROUP BY conv_id
"""
