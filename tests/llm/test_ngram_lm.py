import math
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sectile.llm import ngram_lm as lm

D = "/root/testdata/sf0.01"


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 1 << 40), max_size=200), st.lists(st.integers(0, 1 << 40), max_size=50), st.integers(1, 16))
def test_elias_fano(values, queries, block):
    lm.EliasFano.BLOCK = block
    try:
        v = np.sort(np.array(values, np.uint64))
        head, data = lm.EliasFano.parts(v)
        ef = lm.EliasFano(*head, data)
        assert [ef[i] for i in range(len(v))] == v.tolist()
        q = np.array(queries + values[:5], np.uint64)
        n = len(v)
        for lo, hi in ((np.zeros(len(q), int), np.full(len(q), n)), (np.arange(len(q)) % (n + 1), np.minimum(n, np.arange(len(q)) % (n + 1) + 7))):
            at = ef.successors(q, lo, hi)
            assert at.tolist() == [a + int(np.searchsorted(v[a:b], x, side="left")) for x, a, b in zip(q, lo, hi)]
        assert ef.values(np.arange(n)[::-1]).tolist() == v[::-1].tolist()
    finally:
        lm.EliasFano.BLOCK = 1 << 12


def test_trie_finds_pairs_by_context():
    pairs = sorted({(c, w) for c in range(50) for w in np.random.default_rng(c).integers(0, 900, c)})
    c, w = map(np.array, zip(*pairs))
    trie = lm.Trie.build(50, c, w, np.arange(len(c)).astype(np.uint16))
    assert trie.find(c, w).tolist() == list(range(len(c)))
    assert (trie.find(c, (w + 1) % 900) >= 0).tolist() == [((x, (y + 1) % 900) in set(pairs)) for x, y in pairs]
    assert trie.children(7).tolist() == [y for x, y in pairs if x == 7]
    assert trie.children(0).tolist() == [] and trie.find(np.array([0, 0]), np.array([0, 5])).tolist() == [-1, -1]


def brute(rows):
    words = [(i, (t or "").encode().lower().split() + [None]) for i, t in rows]
    held = [zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0 for i, _ in rows]
    c, b = Counter(), Counter()
    for (_, w), h in zip(words, held):
        if not h:
            c.update(w)
            b.update(zip([None] + w[:-1], w))
    n, v = sum(c.values()), len(c)
    once, twice = (sum(x == k for x in c.values()) for k in (1, 2))
    d = once / (once + 2 * twice) if once else 0.5

    def p(t):
        return (c[t] - d) / n if c[t] else d * v / n

    out = []
    for (i, w), h in zip(words, held):
        base = sum(math.log10((c[t] + 0.1) / (n + 0.1 * (v + 1))) for t in w)
        full = sum(math.log10((b[x, t] + lm.MU * p(t)) / (c[x] + lm.MU)) for x, t in zip([None] + w[:-1], w))
        out.append((i, h, len(w), sum(c[t] > 0 for t in w), n, base, full))
    return out


@pytest.mark.parametrize("chunk,hot", [(1_000_000, 100_000), (300, 50)])
def test_against_brute_force(spark, monkeypatch, chunk, hot):
    monkeypatch.setattr(lm, "CHUNK", chunk)
    monkeypatch.setattr(lm, "HOT", hot)
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{D}/documents.parquet").limit(200).collect()]
    rows += [(5001, None), (5002, ""), (5003, "of the " * 4000), (5004, "Ä ä A a"), (5004, "Ä ä A a"), (None, "the")]
    df = spark.createDataFrame([(i, t, 1.5, 7) for i, t in rows], "doc_id long, text string, score double, x long").toDF("doc_id", "text", "score", "TEXT")
    key = lambda r: (r[0] if r[0] is not None else -1, r[2])
    got, want = sorted(map(tuple, lm.score(df).collect()), key=key), sorted(brute(rows), key=key)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    for g, w in zip(got, want):
        assert g[5] == pytest.approx(w[5], rel=1e-9)
        assert g[6] == pytest.approx(w[6], rel=1e-3, abs=2e-3 + 1e-4 * w[2])


def test_held_out_texts_are_likelier_than_under_the_base(spark):
    rows = lm.score(spark.read.parquet(f"{D}/documents.parquet")).collect()
    held = [r for r in rows if r.held_out]
    assert len(rows) == 1000 and sum(r.score for r in held) > sum(r.base_score for r in held)


def test_no_rows(spark):
    assert lm.score(spark.createDataFrame([], "doc_id long, text string")).count() == 0
