"""Source mix, periodic runs and spelling groups against brute force, and on odd rows."""

import collections
import hashlib
import random
import re
import zlib

import duckdb
import numpy as np
import pytest

from voltaic.llm import mixing, runs, spelling
from voltaic.llm import queries as Q

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def rows():
    return duckdb.sql(f"select doc_id, source, text from '{SF}/documents.parquet'").fetchall()


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in any column, empty, blank and long texts, repeated rows, names like those the operators use."""
    texts = [None, "", " \t\n ", "alone", "again and " * 3000, "copied words here.", "copied words here.", "é ü 漢字 \U0001f600 écarté", "\x85 \xa0  "]
    data = [(i, t, "en", [None, "a", "b"][i % 3], 1) for i, t in enumerate(texts)]
    data += [(None, "no id at all.", None, "a", None), (4, texts[4], "en", "b", 1), (5, "copied words here.", "en", "b", 1), (5, "copied words here.", "en", "b", 1)]
    return spark.createDataFrame(data, SCHEMA).selectExpr("*", *[f"'x' as {c}" for c in ("size", "start", "no", "word", "runs", "shard", "h", "n", "copy")])


def size_of(text):
    return len(WORD.findall(text or ""))


def plain_targets(sizes):
    """Targets by resharing, source by source, as the contract says."""
    names = sorted(sizes, key=lambda s: (s is None, [ord(c) for c in s or ""]))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, full = sum(sizes.values()), set()
    while True:
        free = [s for s in names if s not in full]
        left = total - sum(3 * sizes[s] for s in full)
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        above = {s for s in free if share[s] > 3 * sizes[s]}
        if not above:
            return {s: float(3 * sizes[s]) if s in full else share[s] for s in names}
        full |= above


def check_mix(got, rows):
    sizes = collections.Counter()
    for _, s, t in rows:
        sizes[s] += size_of(t)
    targets = plain_targets(sizes)
    assert sorted((r.doc_id, r.size, r.source_size) for r in got if r.doc_id is not None) == sorted((d, size_of(t), sizes[s]) for d, s, t in rows if d is not None)
    left = collections.defaultdict(list)
    for d, s, t in rows:
        left[d, size_of(t)].append(s)
    taken = collections.Counter()
    for r in got:
        assert any(abs(r.target - targets[s]) <= 1e-6 * max(1, targets[s]) for s in left[r.doc_id, r.size])
        assert 0 <= r.taken <= 3 * r.size and (r.first_shard is None) == (r.taken == 0)
        taken[round(r.target, 6), r.source_size] += r.taken
    want = collections.Counter()
    for s, target in targets.items():
        want[round(target, 6), sizes[s]] += target
    assert all(abs(taken[k] - v) <= 1 for k, v in want.items())


def test_mix_query(spark, rows):
    got = Q.op11_source_mix(spark, SF).collect()
    check_mix(got, rows)
    assert sorted(got) == sorted(Q.op11_source_mix(spark, SF).collect())


def test_mix_odd_rows(spark, odd):
    plain = [(r.doc_id, r.source, r.text) for r in odd.select("doc_id", "source", "text").collect()]
    check_mix(mixing.digest(odd).collect(), plain)
    assert mixing.digest(odd.limit(0)).count() == 0
    blank = odd.withColumn("text", odd.lang.cast("string").substr(1, 0))
    assert {(r.size, r.target, r.taken) for r in mixing.digest(blank).collect()} == {(0, 0.0, 0)}


def test_mix_shards(spark, rows):
    """Many shards: exact quotas, every word of the streams once, pieces of every shard in a gapless order."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = mixing.mix(docs, shard_words=1500, block_words=64)
    pieces = found.pieces.collect()
    quota = {r.no: r.quota for r in found.sources.collect()}
    by_source, by_shard = collections.defaultdict(list), collections.defaultdict(list)
    sizes = {r.no: r.source_size for r in found.sources.collect()}
    for p in pieces:
        low = p.epoch * sizes[p.no] + p.start + p.from_word
        assert p.block == low // 64 == (low + p.n_words - 1) // 64
        by_source[p.no].append((low, low + p.n_words))
        by_shard[p.shard].append(p)
    for no, spans in by_source.items():
        spans.sort()
        assert spans[0][0] == 0 and spans[-1][1] == quota[no] and all(a[1] == b[0] for a, b in zip(spans, spans[1:], strict=False))
    assert len(by_shard) > 20
    blocks = [len({(p.no, p.block) for p in own}) for own in by_shard.values()]
    assert max(blocks) - min(blocks) <= 1
    assert all(sorted(p.position for p in own) == list(range(len(own))) for own in by_shard.values())
    # sources are spread over shards: the largest one is in nearly all
    top = max(quota, key=quota.get)
    assert sum(any(p.no == top for p in own) for own in by_shard.values()) > 0.8 * len(by_shard)
    # the texts: a whole document as it is, a part as its words
    texts = {(d, size_of(t)): t for d, _, t in rows}
    out = mixing.mixed_texts(docs, shard_words=1500, block_words=64).collect()
    assert len(out) == len(pieces) and sum(size_of(r.text) for r in out) == sum(quota.values())
    parts = {(p.shard, p.position): p for p in pieces}
    for r in out:
        p = parts[r.shard, r.position]
        whole = next(t for (d, _), t in texts.items() if d == p.doc_id)
        assert r.doc_id == p.doc_id and WORD.findall(r.text) == WORD.findall(whole)[p.from_word : p.from_word + p.n_words]


def test_splitting_tree_and_permutation(spark):
    quotas = spark.createDataFrame([(0, 1000), (1, 37), (2, 0), (3, 5)], "no long, blocks long")
    for levels in (1, 2, 10):
        leaves = mixing.split_quotas(quotas, 37, levels=levels).collect()
        first = collections.defaultdict(list)
        for r in leaves:
            first[r.no].append((r.first, r.first + r.blocks))
        for no, n in ((0, 1000), (1, 37), (3, 5)):
            spans = sorted(first[no])
            assert spans[0][0] == 0 and spans[-1][1] == n and all(a[1] == b[0] for a, b in zip(spans, spans[1:], strict=False))
        per = collections.Counter()
        for r in leaves:
            per[r.shard] += r.blocks
        assert set(per) == set(range(37)) and max(per.values()) - min(per.values()) <= 1
    for n in (1, 2, 3, 5, 64, 1000):
        out = mixing.permuted(np.arange(n), np.full(n, n), np.full(n, 7))
        assert sorted(out.tolist()) == list(range(n))
    assert mixing.permuted(np.arange(1000), np.full(1000, 1000), np.full(1000, 7)).tolist() != list(range(1000))


def plain_runs(w, least=12):
    best = {}
    for p in range(1, len(w) // 2 + 1):
        i = 0
        while i + p < len(w):
            if w[i] != w[i + p]:
                i += 1
                continue
            s = i
            while i + p < len(w) and w[i] == w[i + p]:
                i += 1
            if i - s >= p:
                best.setdefault((s, i + p), p)
    return sorted(((s, e - s, p) for (s, e), p in best.items() if e - s >= max(least, 2 * p)), key=lambda r: (r[0], r[2]))


def test_runs_of_random_words():
    rng = random.Random(5)
    for _ in range(1500):
        n, k = rng.randint(0, 70), rng.choice([1, 2, 2, 3, 6])
        w = [rng.randrange(k) for _ in range(n)]
        if n > 5 and rng.random() < 0.4:
            a = rng.randrange(n)
            p = rng.randint(1, max(1, (n - a) // 2))
            w = [w[i if i < a else a + (i - a) % p] for i in range(n)]
        least = rng.choice([2, 5, 12])
        assert runs.runs_of(np.array(w, np.int64), least) == plain_runs(w, least)


def plain_digest(doc_id, text):
    w = WORD.findall(text or "")
    n, h = len(w), zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    found = plain_runs(w) if len(set(w)) < n else []
    dropped = {i for s, m, q in found for i in range(s + q, s + m)}
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (len(found), *best, best[1] and 1000 * best[1] // best[2], sha("".join(f"{s},{m},{q}\n" for s, m, q in found)), sha(" ".join(x for i, x in enumerate(w) if i not in dropped)))


def digests(df):
    return [(r.doc_id, (r.n_runs, r.start, r.length, r.period, r.exponent_milli, r.runs_sha256, r.collapsed_sha256)) for r in df.collect()]


def test_runs_query(spark, rows):
    small = {d: t for d, _, t in rows if size_of(t) <= 1500}
    got = {d: x for d, x in digests(Q.op12_periodic_runs(spark, SF))}
    assert len(got) == len(rows)
    assert {d: got[d] for d in small} == {d: plain_digest(d, t) for d, t in small.items()}
    assert any(got[d][0] for d in small)


def test_runs_odd_rows(spark, odd):
    long = "again and " * 3000
    for d, x in digests(runs.digest(odd)):
        if d != 4:
            texts = [r.text for r in odd.filter("doc_id <=> " + ("null" if d is None else str(d))).collect()]
            assert x in [plain_digest(d, t) for t in texts]
    assert {x[:5] for d, x in digests(runs.digest(odd)) if d == 4} == {(1, 0, 6000, 2, 3_000_000)}
    assert runs.digest(odd.limit(0)).count() == 0
    cut = runs.collapse(odd)
    assert cut.columns == odd.columns and {r.text for r in cut.filter("doc_id = 4").collect()} == {"again and"}
    assert sorted((str(r.doc_id), str(r.text)) for r in cut.collect()) == sorted((str(r.doc_id), "again and" if r.text == long else str(r.text)) for r in odd.collect())


def edits(w, alphabet):
    out = {w[:i] + w[i + 1 :] for i in range(len(w))}
    out |= {w[:i] + c + w[i + 1 :] for i in range(len(w)) for c in alphabet}
    out |= {w[:i] + c + w[i:] for i in range(len(w) + 1) for c in alphabet}
    return out - {w}


def plain_groups(counts):
    alphabet = sorted({c for w in counts for c in w})
    out = {}
    for w, n in counts.items():
        near = [x for x in edits(w, alphabet) if x in counts]
        best = min(near, key=lambda x: (-counts[x], x), default=None)
        form = best if best is not None and counts[best] >= 10 * n else None
        out[w] = [form, None, n, len(near), counts[form] if form else None]
    for w, row in out.items():
        root = w
        while out[root][0]:
            root = out[root][0]
        row[1] = root
    return {w: tuple(r) for w, r in out.items()}


def plain_words(rows):
    counts = collections.Counter()
    for d, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            if h % 31 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            if len(run) >= 7:
                counts[run] += 1
    return {w: n for w, n in counts.items() if n >= 2}


def grouped(df):
    got = df.collect()
    assert len({r.word for r in got}) == len(got)
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in got}


def test_spelling_query(spark, rows):
    want = plain_groups(plain_words([(d, t) for d, _, t in rows]))
    got = grouped(Q.op13_spelling_groups(spark, SF))
    assert got == want and any(r[0] for r in got.values())


@pytest.mark.parametrize("crowd", [0, 3, 4096])
def test_spelling_crowded_words_and_chains(spark, crowd):
    rng = random.Random(2)
    counts = {}
    for _ in range(300):
        w = "".join(rng.choice("abé") for _ in range(rng.randint(7, 9)))
        counts[w] = rng.choice([2, 3, 30, 400, 5000])
    for i, n in enumerate((10**6, 10**5, 10**4, 10**3, 10**2, 10)):  # a chain of forms
        counts["chained" + "x" * i] = n
    for i in range(50):  # long words that differ at one place, and one longer
        counts["q" * i + "z" + "q" * (399 - i)] = 2 + i % 2
    counts["q" * 401] = 5000
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert grouped(spelling.spelling_groups(words, crowd=crowd)) == plain_groups(counts)


def test_spelling_odd_rows(spark, odd):
    more = spark.createDataFrame([(9, "Ecarteur ×÷×÷×÷× ECARTEUR ÉCARTEUR écarteur", None, None, None), (9, "Écarteur " + "k" * 30_000, "en", "a", 1), (None, "k" * 30_000 + "-" + "k" * 30_001 + " " + "k" * 30_001, "en", "a", 1)], SCHEMA)
    docs = odd.select("doc_id", "text").unionByName(more.select("doc_id", "text"))
    counts = plain_words([(r.doc_id, r.text) for r in docs.collect()])
    got = grouped(spelling.digest(docs))
    assert {w: r[2] for w, r in got.items()} == counts
    short = {w: n for w, n in counts.items() if len(w) < 1000}
    assert {w: r for w, r in got.items() if w in short} == plain_groups(short)
    assert {w: r[3] for w, r in got.items() if w not in short} == {w: sum(abs(len(w) - len(x)) == 1 for x in counts if x not in short) for w in counts if w not in short}
    assert spelling.digest(docs.limit(0)).count() == 0
