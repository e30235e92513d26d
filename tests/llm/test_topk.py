import numpy as np
import pytest

from sectile.llm import topk


def brute(rows, k, every):
    ok = [(i, np.floor(256 * np.array(x, float)).astype(int)) for i, x in rows if i is not None and x is not None and all(y is not None and np.isfinite(y) for y in x)]
    d = max((len(x) for _, x in ok), default=0)
    ids = np.array([i for i, _ in ok])
    m = np.array([np.pad(x, (0, d - len(x))) for _, x in ok])
    out = []
    for q in sorted({i for i in ids.tolist() if i % every == 0}):
        s = m @ m[np.flatnonzero(ids == q)[0]]
        o = [j for j in np.lexsort((ids, -s)) if ids[j] != q][:k]
        out += [(q, n + 1, int(ids[j]), int(s[j])) for n, j in enumerate(o)]
    return out


@pytest.mark.parametrize("shard,leaf,roots,blocks", [(4096, 128, 1 << 20, 256), (40, 4, 1 << 20, 256), (40, 4, 0, 2)])
def test_against_brute_force(spark, monkeypatch, shard, leaf, roots, blocks):
    monkeypatch.setattr(topk, "SHARD", shard)
    monkeypatch.setattr(topk, "ROOTS", roots)
    monkeypatch.setattr(topk, "TASK_BLOCKS", blocks)
    monkeypatch.setattr(topk, "LEAF", leaf)
    r = np.random.default_rng(2)
    same = r.normal(size=8).tolist()
    rows = [(i, same if i % 3 == 0 else (r.normal(size=8) * 0.3).tolist()) for i in range(500)]
    rows += [(500, None), (550, [1.0, None]), (600, [float("nan")] * 8), (650, [float("inf")] * 8), (None, same), (700, [0.5]), (750, [])]
    df = spark.createDataFrame([(i, x, 0) for i, x in rows], "vec_id long, embedding array<float>, rank int")
    rows = [(x.vec_id, x.embedding) for x in df.collect()]
    got = sorted(map(tuple, topk.top_k(df, k=5, every=50).collect()))
    assert got == brute(rows, 5, 50)


def test_few_rows(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0]), (1, [0.5, 0.25])], "vec_id long, embedding array<float>")
    assert [tuple(x) for x in topk.top_k(df).collect()] == [(0, 1, 1, 256 * 128 + 512 * 64)]
    assert topk.top_k(df.limit(0)).count() == 0


def test_table_against_brute_force(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    assert sorted(map(tuple, topk.top_k(df).collect())) == brute([(x.vec_id, x.embedding) for x in df.collect()], 5, 50)


@pytest.mark.parametrize("shard", [4096, 30])
def test_large_components_are_scored_exactly(spark, monkeypatch, shard):
    monkeypatch.setattr(topk, "SHARD", shard)
    r = np.random.default_rng(5)
    rows = [(i, (r.normal(size=4) * 1e6).tolist()) for i in range(120)]
    got = sorted(map(tuple, topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()))
    assert got == brute(rows, 5, 50)
    with pytest.raises(ValueError):
        topk.top_k(spark.createDataFrame([(0, [1e12, 1.0])], "vec_id long, embedding array<double>"))


def test_repeated_rows_ties_and_clashing_names(spark):
    rows = [(50, [1.0], 1, 2)] * 3 + [(i, [2.0], 3, 4) for i in range(1, 9)] + [(7, [2.0], 5, 6)] * 2
    df = spark.createDataFrame(rows, "a long, embedding array<float>, b long, c long").toDF("vec_id", "embedding", "VEC_ID", "score")
    got = sorted(map(tuple, topk.top_k(df).collect()))
    assert got == [(50, n + 1, i, 256 * 512) for n, i in enumerate([1, 2, 3, 4, 5])]


def test_queries_go_only_where_a_box_can_better_them(spark, monkeypatch):
    """Far clusters: the boxes are tight, so most blocks of queries are not sent to most shards."""
    monkeypatch.setattr(topk, "SHARD", 20)
    r = np.random.default_rng(6)
    rows = [(i, (np.eye(6)[i % 6] * 5 + r.normal(size=6) * 0.01).tolist()) for i in range(300)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    rows = [(x.vec_id, x.embedding) for x in df.collect()]
    assert sorted(map(tuple, topk.top_k(df, every=25).collect())) == brute(rows, 5, 25)
