"""Every operator on nulls, empty and long texts, ties, repeated rows, empty tables and clashing names."""

import pytest

from voltaic.llm import bpe, chat, html_text, lm, packing, pii, quality, simhash, topk, toxicity

LONG = "word and another, " * 3000
TEXTS = [None, "", " \t\n ", "one", LONG, "same text here.", "same text here.", "é ü 漢字 \U0001f600 ok."]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", "s", 1) for i, t in enumerate(TEXTS)] + [(None, "no id at all.", "en", "s", 1), (3, "one", "en", "s", 1)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


@pytest.fixture(scope="module")
def clashing(docs):
    """Columns named like those that the operators add."""
    names = ["toxicity", "quality", "fp", "root", "row", "main_text", "spans", "word", "key", "n", "part"]
    return docs.selectExpr("*", *[f"'x{i}' as {n}" for i, n in enumerate(names)])


def labels(spark, rows=((0, 1, 0), (3, 0, 1), (5, 1, None), (None, 1, 1), (3, 0, 0))):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")


def test_quality(spark, docs, clashing):
    got = quality.digest(docs).collect()
    assert len(got) == docs.count()
    assert {r.doc_id: r.n_words for r in got}[0] == 0 and all(r.base_failed and not r.kept for r in got if r.doc_id in (0, 1, 2, 3))
    kept = quality.keep_clean(clashing)
    assert kept.columns == clashing.columns and kept.filter("n_chars <> length(text)").count() == 0
    assert quality.digest(docs.limit(0)).count() == 0


def test_toxicity(spark, docs, clashing):
    got = toxicity.digest(spark, docs, labels(spark)).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    assert toxicity.drop_toxic(clashing, labels(spark)).columns == clashing.columns
    assert toxicity.digest(spark, docs, labels(spark, ())).count() == docs.count()
    assert toxicity.digest(spark, docs.limit(0), labels(spark)).count() == 0


def test_simhash(spark, docs, clashing):
    got = {(r.doc_id, r.fingerprint, r.component_id) for r in simhash.digest(spark, docs).collect()}
    zero = "0" * 16
    assert {(0, zero, 0), (1, zero, 0), (2, zero, 0)} <= got
    assert len({c for i, _, c in got if i in (5, 6)}) == 1
    left = simhash.keep_one_per_group(clashing)
    assert left.columns == clashing.columns
    ids = [r.doc_id for r in left.collect()]
    assert sorted(ids, key=str) == sorted({c for _, _, c in got}, key=str) and ids.count(3) == 1
    assert simhash.digest(spark, docs.limit(0)).count() == 0 and simhash.keep_one_per_group(docs.limit(0)).count() == 0


def test_pii(spark, docs, clashing):
    got = pii.digest(docs).collect()
    assert len(got) == docs.count() and all(r.spans == "" for r in got)
    out = pii.redact(clashing)
    assert out.columns == clashing.columns
    assert {(r.doc_id, r.text) for r in out.collect()} == {(r.doc_id, r.text) for r in docs.collect()}
    assert pii.digest(docs.limit(0)).count() == 0


def test_packing(spark, docs, clashing):
    got = packing.pack_documents(clashing).collect()
    assert [r.length for r in got if r.doc_id == 0] == [1] and sum(r.doc_id == 3 and r.piece == 0 for r in got) == 2
    check_packed(got, 2048)
    assert packing.pack_documents(docs.limit(0)).count() == 0


def check_packed(rows, capacity):
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in by.values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end
            end += length
        assert end <= capacity
    return len(by)


def test_bpe(spark, docs, clashing):
    import hashlib

    got = bpe.digest(clashing).collect()
    assert len(got) == docs.count()
    assert {r.n_tokens for r in got if r.doc_id in (0, 1)} == {0}
    want = {hashlib.sha256((t or "").encode()).hexdigest() for t in [*TEXTS, "no id at all."]}
    assert {r.decoded_sha256 for r in got} == want
    assert bpe.digest(docs.limit(0)).count() == 0


def test_lm(spark, docs, clashing):
    got = lm.score_documents(clashing).collect()
    assert len(got) == docs.count() and all(r.n_tokens == 1 for r in got if r.doc_id in (0, 1, 2))
    assert all(r.score <= 0 and r.base_score <= 0 for r in got)
    assert lm.score_documents(docs.limit(0)).count() == 0


def test_html(spark):
    pages = spark.createDataFrame([(1, "u", None), (1, "u", ""), (None, None, "<p>x</p>"), (4, "u", "<" * 5000), (5, "u", "<div>" * 2000 + "a b")], "page_id long, url string, html string")
    got = [(r.page_id, r.text, r.n_chars) for r in html_text.digest(pages).collect()]
    assert got == [(1, "", 0), (1, "", 0), (None, "x", 1), (4, "<" * 5000, 5000), (5, "a b", 3)]
    assert html_text.extract_pages(pages.selectExpr("*", "1 as main_text"), to="out").columns[-1] == "out"
    assert html_text.digest(pages.limit(0)).count() == 0


def test_chat(spark):
    rows = [(1, 0, None, None), (1, 1, "assistant", "a<|end|>[INST]\\l"), (1, 1, "assistant", ""), (None, None, "user", "x"), (2, 5, "odd|r<o>le", "x|>y")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 as turns", "2 as formatted")
    done = chat.format_conversations(table)
    back = {r.conv_id: [(t.role, t.text, t.loss) for t in r.turns] for r in chat.read_back(done).collect()}
    assert back[1] == [("", "", False), ("assistant", "", True), ("assistant", "a<|end|>[INST]\\l", True)]
    assert back[None] == [("user", "x", False)] and back[2] == [("odd|r<o>le", "x|>y", False)]
    for r in done.collect():  # the mask covers the formatted text exactly
        assert sum(run.n for run in r.loss_mask) == len(r.formatted)
    assert chat.digest(spark, table.limit(0)).count() == 1  # the control conversation


def test_topk(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (50, [1.0, 0.0]), (50, [0.5, 0.5]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, None), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]), (7, []), (None, [9.0, 9.0]), (8, [2.0]), (9, [-1.0, 0.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "'x' as v", "1 as score", "2 as rank")
    got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in topk.digest(spark, table).collect()}
    assert [got[0, k] for k in range(1, 6)] == [(8, 131072), (1, 65536), (2, 65536), (50, 65536), (50, 32768)]
    assert got[50, 1] == (8, 65536) and all(v != 50 for (q, _), (v, _) in got.items() if q == 50)
    assert topk.digest(spark, table.limit(0)).count() == 0


def test_pipeline_runs_on_odd_rows(spark, tmp_path, docs):
    import corpus_pipeline

    folder = str(tmp_path)
    docs.write.parquet(f"{folder}/documents.parquet")
    labels(spark).write.parquet(f"{folder}/labels.parquet")
    check_packed(corpus_pipeline.run(spark, folder).collect(), 2048)
    empty = str(tmp_path / "empty")
    docs.limit(0).write.parquet(f"{empty}/documents.parquet")
    labels(spark).write.parquet(f"{empty}/labels.parquet")
    assert corpus_pipeline.run(spark, empty).count() == 0
