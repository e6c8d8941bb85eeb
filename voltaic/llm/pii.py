"""Personal data by weak supervision, with Spark expressions only.

Base spans come from four patterns (email, ip, card, phone) with their checks and always stay. Wider
patterns propose further spans (secrets, local phone numbers, national ids, persons); whether a proposal
counts is learned without labels:

1. Labelers vote on each proposal (yes, no or nothing): a strict regex, a gazetteer, the words before
   it, and its make-up.
2. The votes are counted by kind and vote pattern, at most ``4 * 3^4`` rows whatever the input, and
   expectation-maximisation over these counts estimates each labeler's reliability and each kind's share.
3. A naive Bayes span classifier over length, shape, the word before and the signs around is trained on
   the posteriors; its features are hashed into a fixed number of places, so its weights are a literal.

Proposals are found, voted on and classified inside their row; only the counts are exchanged. Patterns
are written so that a match costs linear time on unbroken runs.

Defined results: a null or empty text has no spans; offsets are code points, the end exclusive; repeated
rows are treated each; without proposals nothing is added; an empty table gives an empty result.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltaic.llm.common import store
from voltaic.llm.native import let

BASE = ("email", "ip", "card", "phone")
#: The base patterns. A card's run is matched as far as it goes, and only if it has 14 to 19 digits; the others are checked afterwards.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){13,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must hold for a pattern to be tried.
NEEDED = {"email": "@", "ip": ".", "phone": "+"}

#: Fixed values of the proposals: the wide pattern, then for each labeler the pattern of yes and of no (empty: never).
#: The strict and make-up labelers see the span, the gazetteer too, the context labeler the 32 code points before it.
PROPOSALS = {
    "secret": {
        "wide": r"(?<![A-Za-z0-9_/+-])(?=[A-Za-z_/+-]*+[0-9])(?=[0-9_/+-]*+[A-Za-z])[A-Za-z0-9_/+-]{12,}+",
        "strict": (r"^(?:[0-9a-f]{16,}|[A-Z0-9]{16,}|(?=.*[A-Z])(?=.*[a-z]).{20,})$", r"^(?:[0-9/+-]+|[A-Za-z]+[0-9]+)$"),
        "gazetteer": (r"^(?:AKIA|ASIA|ghp_|gho_|sk_|pk_|xox|AIza|eyJ)", r"^(?:https?|www)"),
        "context": (r"(?i)(?:password|passwd|pwd|secret|token|api.?key|access.?key|credentials?|auth)[^A-Za-z0-9]{0,5}$", r"(?i)(?:isbn|commit|version|order|invoice|model|doi)[^A-Za-z0-9]{0,5}$"),
        "make_up": (r"^(?:[A-Za-z_/+-]*+[0-9]++[A-Za-z_/+-]++){2}", r"^[^0-9]*+[0-9]*+$|^[0-9]++[^0-9]*+$"),
    },
    "phone_local": {
        "wide": r"(?<![0-9+.-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[.-][0-9]{4}(?![0-9.-])",
        "strict": (r"^(?:\([2-9][0-9]{2}\)\x20|[2-9][0-9]{2}-)[2-9][0-9]{2}-[0-9]{4}$", r"^\(?[01]"),
        "gazetteer": (r"^\(?(?:212|213|305|312|415|510|617|646|650|702|718|800|888|917)", r"^\(?(?:000|999)"),
        "context": (r"(?i)(?:phone|tel|call|fax|mobile|cell|contact)[^A-Za-z0-9]{0,5}$", r"(?i)(?:isbn|order|invoice|model|part|doi|no)[^A-Za-z0-9]{0,5}$"),
        "make_up": (r"^[^.]*$", r"\..*-|-.*\."),
    },
    "national_id": {
        "wide": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
        "strict": (r"^(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)", r"^(?:000|666|9)|-00-|-0000$"),
        "gazetteer": ("", r"^(?:078-05-1120|219-09-9999|123-45-6789)$"),
        "context": (r"(?i)(?:ssn|social|security|tax|national|insurance|id)[^A-Za-z0-9]{0,5}$", r"(?i)(?:isbn|order|invoice|model|part)[^A-Za-z0-9]{0,5}$"),
        "make_up": (r"^(?!(.)\1\1)", r"^(.)\1\1-\1\1-\1{4}$"),
    },
    "person": {
        "wide": r"(?<![A-Za-z])(?:Mr|Mrs|Ms|Dr|Prof)\.?\x20[A-Z][a-z]{1,20}(?:\x20[A-Z][a-z]{1,20}){0,2}",
        "strict": (r"^(?:Mr|Mrs|Ms|Dr|Prof)\.\x20[A-Z]", ""),
        "gazetteer": (r"\b(?:James|Mary|John|Anna|Maria|Peter|Paul|Michael|David|Sarah|Thomas|Laura|Daniel|Julia|Robert|Emma)\b", r"\x20(?:Who|No|What|The)\b"),
        "context": (r"(?i)(?:dear|contact|by|from|with|patient|client|signed)[^A-Za-z0-9]{0,5}$", ""),
        "make_up": (r"\x20[A-Z][a-z]+\x20[A-Z][a-z]+$", r"\x20[A-Z][a-z]$"),
    },
}
KINDS = (*BASE, *PROPOSALS)
LABELERS = ("strict", "gazetteer", "context", "make_up")
NO, YES, NOTHING = 0, 1, 2
CONTEXT = 32
#: Classifier features: four for each proposal, hashed to this many places for each kind and feature.
PLACES = 64
SLOTS = 4
ROUNDS = 30
SPAN = "struct<k:int,s:int,e:int>"


#: Items that a fold appends to one array before it starts another, and code points of a piece of text: work and
#: copies stay linear in a text's matches and length.
STEP, BLOCK = 256, 4096


def folded(items: Column, kind: str, begin: Column, add: Callable[[Column, Column], tuple[Column, Column]]) -> Column:
    """``array<kind>``: for each item what ``add(state, item)`` gives out, beside the next state (an int)."""

    def item(state: Column, x: Column) -> Column:
        at, out = add(state.at, x)
        return F.struct(at.alias("at"), F.concat(state.out, F.array(out)).alias("out"))

    def step(state: Column, part: Column) -> Column:
        own = F.aggregate(part, F.struct(state.at.alias("at"), F.array().cast(f"array<{kind}>").alias("out")), item)
        return let(own, lambda o: F.struct(o.at.alias("at"), F.concat(state.out, F.array(o.out)).alias("out")))

    start = F.struct(begin.alias("at"), F.array().cast(f"array<array<{kind}>>").alias("out"))

    def run(every: Column) -> Column:
        parts = F.sequence(F.lit(0), F.floor((F.size(every) - 1) / STEP).cast("int"))
        steps = F.transform(parts, lambda i: F.slice(every, i * STEP + 1, F.lit(STEP)))
        return F.when(F.size(every) > 0, F.flatten(F.aggregate(steps, start, step, lambda state: state.out)))

    return let(items, run)


def blocks_of(text: Column) -> Column:
    """A text in pieces of ``BLOCK`` code points, for :func:`cut`."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))


def cut(blocks: Column, start: Column, length: Column) -> Column:
    """A substring by code points (from 0) that looks at the pieces it lies in only."""
    first = F.floor(start / BLOCK).cast("int")
    many = F.floor((start + length) / BLOCK).cast("int") - first + 1
    return F.substring(F.array_join(F.slice(blocks, first + 1, many), ""), (start - first * BLOCK + 1).cast("int"), length)


def located(text: Column, pattern: str) -> Column:
    """``array<struct<s, e, v>>``: all matches of a pattern with code-point offsets.

    The text between the matches has known lengths, and so have the matches: offsets are their running sum.
    """

    def placed(found: Column) -> Column:
        gaps = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found))
        pairs = F.zip_with(gaps, found, lambda gap, v: F.struct(F.length(gap).alias("gap"), v.alias("v")))

        def add(at: Column, pair: Column) -> tuple[Column, Column]:
            s = at + pair.gap
            e = s + F.length(pair.v)
            return e, F.struct(s.alias("s"), e.alias("e"), pair.v.alias("v"))

        return folded(pairs, "struct<s:int,e:int,v:string>", F.lit(0), add)

    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda found: F.when(F.size(found) > 0, placed(found)))


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def passes_luhn(number: Column) -> Column:
    def weigh(total: Column, i: Column) -> Column:
        d = F.substring(F.reverse(number), i, F.lit(1)).cast("int")
        return total + F.when(i % 2 == 1, d).when(d > 4, 2 * d - 9).otherwise(2 * d)

    return F.aggregate(F.sequence(F.lit(1), F.length(number)), F.lit(0), weigh) % 10 == 0


def _check(kind: str) -> Callable[[Column], Column]:
    """What a match must pass besides its pattern."""
    part = lambda p: F.regexp_replace(p, "^0+(?=[0-9])", "").rlike("^(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$")
    return {
        "email": lambda m: F.lit(True),
        "ip": lambda m: F.forall(F.split(m.v, r"\."), part),
        "card": lambda m: passes_luhn(digits(m.v)),
        "phone": lambda m: F.length(digits(m.v)).between(10, 15),
    }[kind]


def _of_kind(kind: str, matches: Column) -> Column:
    return F.transform(matches, lambda m: F.struct(F.lit(KINDS.index(kind)).alias("k"), m.s.alias("s"), m.e.alias("e")))


def base_spans(text: Column) -> Column:
    """``array<struct<k, s, e>>``: the base spans by start, then kind."""
    found = []
    for kind, pattern in PATTERNS.items():
        spans = _of_kind(kind, F.filter(located(text, pattern), _check(kind)))
        guard = F.contains(text, F.lit(NEEDED[kind])) if kind in NEEDED else F.lit(True)
        if kind != "email":
            guard = guard & text.rlike("[0-9]")
        found.append(F.coalesce(F.when(guard, spans), F.array().cast(f"array<{SPAN}>")))
    return _in_order(F.concat(*found))


def _in_order(spans: Column) -> Column:
    keyed = F.sort_array(F.transform(spans, lambda x: F.struct(x.s.alias("s"), x.k.alias("k"), x.e.alias("e"))))
    return F.transform(keyed, lambda x: F.struct(x.k.alias("k"), x.s.alias("s"), x.e.alias("e")))


def _vote(value: Column, yes: str, no: str) -> Column:
    vote = F.lit(NOTHING)
    if no:
        vote = F.when(value.rlike(no), NO).otherwise(vote)
    return F.when(value.rlike(yes), YES).otherwise(vote) if yes else vote


def _judge(blocks: Column, kind: str) -> Callable[[Column], Column]:
    """A proposal's kind, place, votes (a number of base 3) and feature places."""
    rules, i = PROPOSALS[kind], list(PROPOSALS).index(kind)

    def judged(m: Column) -> Column:
        before = cut(blocks, F.greatest(m.s - CONTEXT, F.lit(0)), F.least(m.s, F.lit(CONTEXT)))
        after = cut(blocks, m.e, F.lit(1))

        def row(ahead: Column) -> Column:
            votes = reduce(lambda code, name: code * 3 + _vote(ahead if name == "context" else m.v, *rules[name]), LABELERS, F.lit(0))
            shape = F.regexp_replace(F.regexp_replace(F.regexp_replace(m.v, "[0-9]+", "9"), "[a-z]+", "a"), "[A-Z]+", "A")
            around = F.concat(F.regexp_extract(ahead, r"([^A-Za-z0-9]?)$", 1), after)
            word = F.lower(F.regexp_extract(ahead, r"([A-Za-z]+)[^A-Za-z]*$", 1))
            seen = (F.length(m.v), F.xxhash64(F.substring(shape, F.lit(1), F.lit(4))), F.xxhash64(word), F.xxhash64(around))
            places = F.array(*[(F.pmod(x, F.lit(PLACES)) + (i * SLOTS + slot) * PLACES).cast("int") for slot, x in enumerate(seen)])
            return F.struct(F.lit(KINDS.index(kind)).alias("k"), m.s.alias("s"), m.e.alias("e"), votes.cast("int").alias("votes"), places.alias("places"))

        return let(before, row)

    return judged


def proposals(text: Column, base: Column) -> Column:
    """``array<struct<k, s, e, votes, places>>``: further spans that touch no base span."""
    none = F.array().cast("array<struct<k:int,s:int,e:int,votes:int,places:array<int>>>")
    touching = lambda m: lambda b: (b.s < m.e) & (m.s < b.e)

    def judged(blocks: Column, cells: Column) -> Column:
        found = []
        for kind, rules in PROPOSALS.items():
            def free(m: Column) -> Column:  # base spans are looked for in the cells that a proposal lies in
                first, last = F.floor(m.s / BLOCK).cast("int"), F.floor(m.e / BLOCK).cast("int")
                return ~F.exists(F.slice(cells, first + 1, last - first + 1), lambda cell: F.exists(cell, touching(m)))

            guard = text.rlike(r"(?:Mr|Mrs|Ms|Dr|Prof)\.?\x20[A-Z]") if kind == "person" else text.rlike("[0-9]")
            spans = F.transform(F.filter(located(text, rules["wide"]), free), _judge(blocks, kind))
            found.append(F.coalesce(F.when(guard, spans), none))
        return F.concat(*found)

    every = F.sequence(F.lit(0), F.floor(F.length(text) / BLOCK).cast("int"))
    cells = F.transform(every, lambda c: F.filter(base, lambda b: (b.s < (c + 1) * BLOCK) & (b.e >= c * BLOCK)))
    return let(blocks_of(text), lambda blocks: let(cells, lambda own: judged(blocks, own)))


def find(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with ``__pii``: the base spans and the proposals of each row, kept in the shared folder."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    both = let(text, lambda t: let(base_spans(t), lambda base: F.struct(base.alias("base"), proposals(t, base).alias("more"))))
    return store(docs.withColumn("__pii", both))


def reliabilities(patterns: list[tuple[int, list[int], int]]) -> dict[tuple[int, tuple[int, ...]], float]:
    """Expectation-maximisation over counted vote patterns ``(kind, votes, n)``: P(personal | kind, votes).

    Starts from the majority of votes; a labeler's reliability is its chance of yes for personal and
    for other spans, counted with one imagined vote of either sort on the likelier side.
    """
    sure = {(k, tuple(v)): (1.0 + 3 * v.count(YES)) / (2.0 + 3 * (v.count(YES) + v.count(NO))) for k, v, _ in patterns}
    for _ in range(ROUNDS):
        share = {}
        for kind in {k for k, _, _ in patterns}:
            rows = [(sure[k, tuple(v)], n) for k, v, n in patterns if k == kind]
            share[kind] = (1 + sum(p * n for p, n in rows)) / (2 + sum(n for _, n in rows))
        says = []
        for j in range(len(LABELERS)):
            yes, no = [4.0, 1.0], [1.0, 4.0]  # of personal spans, of others
            for k, v, n in patterns:
                if v[j] != NOTHING:
                    p = sure[k, tuple(v)]
                    side = yes if v[j] == YES else no
                    side[0] += p * n
                    side[1] += (1 - p) * n
            says.append((yes[0] / (yes[0] + no[0]), yes[1] / (yes[1] + no[1])))
        for k, v, _ in patterns:
            logit = math.log(share[k] / (1 - share[k]))
            for (a, b), vote in zip(says, v, strict=True):
                if vote != NOTHING:
                    logit += math.log(a / b) if vote == YES else math.log((1 - a) / (1 - b))
            sure[k, tuple(v)] = 1 / (1 + math.exp(-max(-30.0, min(30.0, logit))))
    return sure


def train(found: DataFrame) -> list[float]:
    """The span classifier's weights: a log ratio for each feature place, then a prior for each kind of proposal."""
    more = found.select(F.explode("__pii.more").alias("p")).select("p.*")
    counted = more.groupBy("k", "votes").count().collect()  # at most 4 * 81 rows
    unpack = lambda code: [code // 3 ** (len(LABELERS) - 1 - j) % 3 for j in range(len(LABELERS))]
    sure = reliabilities([(r["k"], unpack(r["votes"]), r["count"]) for r in counted])
    size = len(PROPOSALS) * SLOTS * PLACES
    if not sure:
        return [0.0] * (size + len(PROPOSALS))
    p = F.lit(0.5)
    for (k, votes), value in sure.items():
        p = F.when((F.col("k") == k) & (F.col("votes") == reduce(lambda c, v: c * 3 + v, votes, 0)), float(value)).otherwise(p)
    sums = more.withColumn("p", p).select("p", F.explode("places").alias("place")).groupBy("place").agg(F.sum("p").alias("yes"), F.sum(1 - F.col("p")).alias("no")).collect()
    yes, no = [0.0] * size, [0.0] * size
    for r in sums:  # at most 4 * 4 * 64 rows
        yes[r["place"]], no[r["place"]] = r["yes"], r["no"]
    weights, priors = [], []
    for block in range(size // PLACES):
        a, b = yes[block * PLACES : (block + 1) * PLACES], no[block * PLACES : (block + 1) * PLACES]
        weights += [math.log((x + 0.1) / (sum(a) + 0.1 * PLACES)) - math.log((y + 0.1) / (sum(b) + 0.1 * PLACES)) for x, y in zip(a, b, strict=True)]
        if block % SLOTS == 0:
            priors.append(math.log((sum(a) + 0.5) / (sum(b) + 0.5)))
    return weights + priors


def decide(found: DataFrame, weights: list[float]) -> DataFrame:
    """``found`` with ``__pii`` replaced by its spans: ``base`` and ``all``, by start and kind."""
    table = F.from_json(F.lit(json.dumps(weights)), "array<double>")
    first = len(PROPOSALS) * SLOTS * PLACES

    def accepted(more: Column, w: Column) -> Column:
        logit = lambda p: F.aggregate(p.places, F.get(w, p.k - len(BASE) + first), lambda total, at: total + F.get(w, at))
        return F.transform(F.filter(more, lambda p: logit(p) >= 0), lambda p: F.struct(p.k.alias("k"), p.s.alias("s"), p.e.alias("e")))

    base = F.col("__pii.base")
    whole = let(table, lambda w: accepted(F.col("__pii.more"), w))
    return found.withColumn("__pii", F.struct(base.alias("base"), _in_order(F.concat(base, whole)).alias("all")))


def spans(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with ``__pii.base`` and ``__pii.all``: arrays of (kind, start, end)."""
    found = find(docs, text_col)
    return decide(found, train(found))


def _named(k: Column) -> Column:
    return F.element_at(F.array(*[F.lit(x) for x in KINDS]), k + 1)


def _written(found: Column) -> Column:
    return F.array_join(F.transform(found, lambda x: F.concat_ws(":", _named(x.k), x.s.cast("string"), x.e.cast("string"))), ",")


def digest(docs: DataFrame) -> DataFrame:
    text = docs.select("doc_id", "text")
    found = find(text).select("doc_id", "__pii")
    done = decide(found, train(found))
    count = lambda i: F.size(F.filter("__pii.base", lambda x: x.k == i)).cast("long")
    return done.select(
        "doc_id", *[count(i).alias(f"n_{kind}") for i, kind in enumerate(BASE)], F.sha2(_written(F.col("__pii.base")), 256).alias("base_sha256"), _written(F.col("__pii.all")).alias("spans")
    )


def redacted(text: Column, found: Column) -> Column:
    """The text with each span replaced by its kind in brackets; spans that overlap become one."""

    def replaced(blocks: Column) -> Column:
        def add(at: Column, x: Column) -> tuple[Column, Column]:
            piece = F.concat(cut(blocks, at, x.s - at), F.lit("["), F.upper(_named(x.k)), F.lit("]"))
            return F.greatest(at, x.e), F.when(x.s >= at, piece).otherwise("")

        end = F.array_max(F.transform(found, lambda x: x.e))
        return F.concat(F.array_join(folded(found, "string", F.lit(0), add), ""), cut(blocks, end, F.length(text) - end))

    return F.when(F.size(found) == 0, text).otherwise(let(blocks_of(text), replaced))


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` (all columns) with personal data in ``text`` replaced; ``n_chars``, where there is one, counted anew."""
    done = spans(docs)
    clean = F.when(F.col("text").isNotNull(), redacted(F.col("text").cast("string"), F.col("__pii.all")))
    rows = done.withColumn("__clean", clean)
    columns = {c: F.col(f"`{c}`") for c in docs.columns} | {"text": F.col("__clean")}
    if "n_chars" in columns:
        columns["n_chars"] = F.coalesce(F.length("__clean"), F.lit(0)).cast(docs.schema["n_chars"].dataType)
    return rows.select(*[v.alias(k) for k, v in columns.items()])
