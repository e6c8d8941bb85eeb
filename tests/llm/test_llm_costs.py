"""What the training-data operators spend: counts of steps and sizes that must not grow."""

import gc

import numpy as np
import pyarrow as pa

from voltaic.llm import bpe, lm, topk


def test_topk_takes_few_steps_where_bounds_exclude_nothing(monkeypatch):
    """Vectors in all directions: a chunk's candidates come in a few steps for a query, and the answer is exact."""
    rng = np.random.default_rng(5)
    x, ids = np.floor(rng.normal(size=(3000, 32)) * 40), np.arange(3000)
    pivots, q = x[:32], np.arange(0, 3000, 60)
    table = topk._distances(x, pivots).astype("<f4")
    steps = []
    add = topk.Best.add
    monkeypatch.setattr(topk.Best, "add", lambda self, *a: (steps.append(1), add(self, *a))[1])
    best = topk.Best(len(q), 5)
    topk._search(best, x[q], ids[q], table[q], x, ids, table, float(np.sqrt((pivots * pivots).sum(1)).max()))
    assert best.evaluated > 0.5 * len(q) * len(x)
    assert len(steps) <= 5
    scores = x[q] @ x.T
    for row, own in enumerate(q):
        want = sorted((-s, i) for i, s in enumerate(scores[row]) if i != own)[:5]
        assert [(-s, i) for s, i in zip(best.score[row], best.id[row], strict=True)] == want


def test_topk_of_whole_numbers_beyond_doubles_and_ties():
    """In 64-bit whole numbers, with equal scores and ids that come twice."""
    rng = np.random.default_rng(6)
    x, ids = rng.integers(-2, 3, (900, 3)).astype(float) * 2**27, np.arange(900) // 2
    table = topk._distances(x, x[:4]).astype("<f4")
    q = np.arange(0, 900, 45)
    best = topk.Best(len(q), 5, np.int64)
    far = float(np.sqrt((x[:4] * x[:4]).sum(1)).max())
    for at in range(0, 900, 400):
        s = slice(at, at + 400)
        topk._search(best, x[q], ids[q], table[q], x[s], ids[s], table[s], far)
    for row, own in enumerate(ids[q].tolist()):
        want = sorted((-int(sum(int(a) * int(b) for a, b in zip(x[q[row]], v, strict=True))), int(i)) for v, i in zip(x, ids, strict=True) if i != own)[:5]
        assert [(-int(s), int(i)) for s, i in zip(best.score[row], best.id[row], strict=True)] == want


def test_lm_units_are_bounded_by_their_text_too():
    texts = ["ab" * 10, None, "x" * (lm.UNIT_CHARS + 1), "", "c", *["d"] * (lm.UNIT + 1), *["e" * (lm.UNIT_CHARS // 4)] * 9]
    batch = pa.RecordBatch.from_pydict({"id": pa.array(range(len(texts))), "text": pa.array(texts)})
    cuts = [cut.column(1).to_pylist() for cut in lm.units(batch.slice(1))]
    assert [t for cut in cuts for t in cut] == texts[1:]
    assert all(len(cut) <= lm.UNIT and (len(cut) == 1 or sum(len(t or "") for t in cut) <= lm.UNIT_CHARS) for cut in cuts)
    assert list(lm.units(batch.slice(0, 0))) == []


def test_lm_joined_reads_cut_columns():
    rows = [np.arange(n, dtype=np.uint64).tobytes() for n in (3, 0, 2, 4)]
    whole = pa.array([b"odd", *rows], pa.binary())
    got = lm.joined(pa.chunked_array([whole.slice(1, 2), whole.slice(3, 0), whole.slice(3)]), np.uint64)
    assert got.tolist() == [0, 1, 2, 0, 1, 0, 1, 2, 3]
    assert lm.joined(pa.chunked_array([], pa.binary()), "<u4").tolist() == []


def test_lm_stores_little_at_a_time_and_reads_states_alone(spark, monkeypatch):
    """What a task holds for its stored file is bounded, and a bucket that answers doesn't read what waits for it."""
    stored = []

    def store(df, *args, **more):
        stored.append((more.get("block"), df.columns))
        return kept(df, *args, **more)

    kept = lm.store
    monkeypatch.setattr(lm, "store", store)
    docs = spark.createDataFrame([(i, f"w{i} w{i % 7} a b {i % 3}") for i in range(300)], "doc_id long, text string")
    assert lm.score_documents(docs).count() == 300
    assert all(block and block < 128 << 20 for block, _ in stored)
    assert "state" in stored[-1][1] and "words" in stored[-1][1]


def test_bpe_numbering_keeps_no_list_for_each_chunk():
    """Python's garbage collector has nothing to look through, however many chunks a group has."""
    texts = pa.array([" ".join(f"{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676 % 26)}{'k' * (i // 17576)}." for i in range(30_000))] * 2)
    rounds = []
    count = lambda phase, info: rounds.append(info["generation"]) if phase == "start" else None
    gc.collect()
    gc.callbacks.append(count)
    try:
        numbers, ends, words = bpe.number_words(texts)
    finally:
        gc.callbacks.remove(count)
    assert len(rounds) <= 3, len(rounds)
    names = list(words)
    assert ends.tolist() == [len(numbers) // 2, len(numbers)]
    assert [names[i] for i in numbers[: ends[0]]] == bpe.split_words(texts[0].as_py())
