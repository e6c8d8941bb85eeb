"""What round by round was found wrong: masks, long texts, null ids, bounded fits, SQL that says what the code does."""

import time

import duckdb
import numpy as np
from pyspark.sql import functions as F

from voltaic.llm import chat, pii, quality, simhash, toxicity


def test_a_shifted_mask_changes_the_loss_text(spark):
    rows = spark.createDataFrame([(1, 0, "user", "hello <there>"), (1, 1, "assistant", "a [b] \\ \U0001f600 c"), (1, 2, "assistant", ""), (1, 3, "user", "x"), (1, 4, "assistant", "end")],
                                 "conv_id long, turn long, role string, text string")
    formatted = chat.format_conversations(rows)
    good = chat.read_back(formatted).first()
    assert good.loss_text == "a [b] \\ \U0001f600 cend" and [t.text for t in good.turns] == [r.text for r in rows.collect()]
    sha = chat.digest_formatted(formatted).first().loss_sha256
    for change in (lambda r, i: F.when(i == 3, r.n - 1).when(i == 5, r.n + 1).otherwise(r.n), lambda r, i: F.lit(0), lambda r, i: F.when(i == 4, r.n + 1).otherwise(r.n)):
        moved = F.transform("loss_mask", lambda r, i: F.struct(change(r, i).cast("int").alias("n"), r.loss.alias("loss")))
        assert chat.digest_formatted(formatted.withColumn("loss_mask", moved)).first().loss_sha256 != sha


def test_quality_sql_says_what_the_code_does(spark):
    line = "This is a sentence of the text that stands on one long line. " * 12
    texts = [line + "Click here for more.", line + "Click here. " * 13, "All rights reserved.\n" + line, "Click here.\n" * 40 + line, line, None, ""]
    documents = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: tuple(r)[1:] for r in quality.digest(documents).collect()}
    con = duckdb.connect()
    con.register("documents", documents.toPandas())
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    want = {r[0]: r[1:] for r in con.sql(f"SELECT doc_id, {', '.join(names)} FROM ({quality.ORACLE_SQL})").fetchall()}
    assert got == want
    varied = " ".join(f"Sentence number {i} of a text says word{i} and word{i + 1}." for i in range(40))
    more = spark.createDataFrame([(1, varied + " Click here for more.")], "doc_id long, text string")
    con.register("documents", more.toPandas())
    assert quality.digest(more).first().kept and con.sql(f"SELECT kept FROM ({quality.ORACLE_SQL})").fetchall() == [(True,)]


def test_many_matches_in_one_text(spark):
    n = 100_000
    text = " ".join(f"é{i}: u{i}@mail.org" for i in range(n))
    docs = spark.createDataFrame([(1, text), (2, "write to a@b.co now")], "doc_id long, text string")
    began = time.time()
    got = {r.doc_id: r for r in pii.digest(docs).collect()}
    clean = {r.doc_id: r.text for r in pii.redact(docs).collect()}
    assert time.time() - began < 120
    assert got[1].n_email == n and got[2].n_email == 1
    assert clean[1] == " ".join(f"é{i}: [EMAIL]" for i in range(n)) and clean[2] == "write to [EMAIL] now"


def test_near_duplicates_with_null_ids(spark):
    rows = [(None, f"some words that make text number {i} here") for i in range(300)] * 2 + [(7, "kept"), (7, "kept"), (8, "kept"), (None, "kept")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = simhash.keep_one_per_group(docs)
    groups = simhash.simhash_groups(docs).select("root").distinct().count()
    got = kept.collect()
    assert len(got) == groups and [r.text for r in got if r.doc_id == 7] == ["kept"]


def plain_ftrl(rows, epochs):
    """FTRL-proximal, one weight at a time."""
    z, n = {}, {}

    def weight(i):
        l1 = 0.0 if i == toxicity.BIAS else toxicity.L1
        x = z.get(i, 0.0)
        return 0.0 if abs(x) <= l1 else -(x - np.sign(x) * l1) / ((toxicity.BETA + n.get(i, 0.0) ** 0.5) / toxicity.ALPHA + toxicity.L2)

    for _ in range(epochs):
        for places, label in rows:
            at = [toxicity.BIAS, *places]
            w = {i: weight(i) for i in at}
            g = 1 / (1 + np.exp(-sum(w.values()))) - label
            for i in at:
                before = n.get(i, 0.0)
                z[i] = z.get(i, 0.0) + g - ((before + g * g) ** 0.5 - before**0.5) / toxicity.ALPHA * w[i]
                n[i] = before + g * g
    return {i: w for i in z if (w := weight(i))}


def test_ftrl_equals_one_weight_at_a_time(spark):
    good, bad = "a calm text about rivers and old stones", "you awful rotten thing go away now"
    rows = [(i, f"{bad if i % 3 == 0 else good} with word{i % 7} and word{i % 5}", int(i % 3 == 0)) for i in range(120)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows] * 3, "doc_id long, text string")            # each row three times
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    places, values = toxicity.fit(docs, labels)
    kept = toxicity.labelled(labels).withColumn("at", F.xxhash64(F.lit(1), F.col("doc_id").cast("string"))).orderBy("at").collect()
    texts = {i: t for i, t, _ in rows}
    want = plain_ftrl([(np.unique(toxicity.features(texts[r.doc_id])).tolist(), r.toxic) for r in kept], toxicity.EPOCHS)
    assert sorted(want) == places.tolist() and np.allclose([want[i] for i in places.tolist()], values)
    assert len(places) > 5
    few = [np.array([1, 2, 3], "<i4").tobytes()] * 5
    assert toxicity.learned(iter([(p, 1) for p in few]), most=6)[0].tolist() == toxicity.learned(iter([(p, 1) for p in few[:2]]))[0].tolist()


def test_topk_prunes_for_each_query_and_takes_any_size(spark):
    from voltaic.llm import topk

    rng = np.random.default_rng(3)
    centres = rng.normal(size=(40, 16)) * 40
    x = np.floor((centres[rng.integers(0, 40, 3000)] + rng.normal(size=(3000, 16))) * 256 / 16)
    pivots, ids = x[:: len(x) // 32][:32], np.arange(len(x))
    tables = topk._distances(x, pivots).astype("<f4")
    q = np.arange(0, 3000, 50)
    best = topk.Best(len(q), 5)
    far = float(np.sqrt((pivots * pivots).sum(1)).max())
    for at in range(0, len(x), 1000):
        topk._search(best, x[q], ids[q], tables[q], x[at : at + 1000], ids[at : at + 1000], tables[at : at + 1000], far)
    scores = x[q] @ x.T
    for row, own in enumerate(q):
        want = sorted(((-s, i) for i, s in enumerate(scores[row]) if i != own))[:5]
        assert [(-s, i) for s, i in zip(best.score[row], best.id[row], strict=True)] == want
    assert best.evaluated < 0.25 * len(q) * len(x)                              # most pairs are never multiplied
    big = spark.createDataFrame([(0, [2.0**22, 3.0]), (1, [2.0**21, -1.0]), (2, [2.0**22 + 1 / 256, 5.0]), (3, [0.5])], "vec_id long, embedding array<double>")
    got = [(r.rank, r.vec_id, r.score) for r in topk.digest(spark, big).orderBy("rank").collect()]
    v = {0: [2**30, 768], 1: [2**29, -256], 2: [2**30 + 1, 1280], 3: [128, 0]}
    want = sorted(((-sum(a * b for a, b in zip(v[0], v[i], strict=True)), i) for i in (1, 2, 3)))
    assert got == [(n + 1, i, -s) for n, (s, i) in enumerate(want)]
    huge = spark.createDataFrame([(0, [1e30]), (1, [2.0])], "vec_id long, embedding array<double>")
    assert {r.v[0] for r in topk.quantised(huge).collect()} == {2.56e32, 512.0}
    try:
        topk.digest(spark, huge)
        raise AssertionError
    except ValueError as e:
        assert "no longs" in str(e)
