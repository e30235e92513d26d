import numpy as np

from sectile.llm import quality_classifier as qc

D = "/root/testdata/sf0.01"


def test_labelled_rows_agree(spark):
    got = qc.classify(spark.read.parquet(f"{D}/documents.parquet")).join(spark.read.parquet(f"{D}/labels.parquet"), "doc_id").collect()
    clean, junk = [r for r in got if r.quality == 1], [r for r in got if r.quality == 0]
    assert sum(r.kept for r in clean) >= 0.98 * len(clean)
    assert sum(not r.kept for r in junk) >= 0.7 * len(junk)


def test_odd_rows(spark):
    docs = spark.read.parquet(f"{D}/documents.parquet").select("doc_id", "text").limit(100)
    odd = spark.createDataFrame([(9001, None), (9002, ""), (None, "x"), (9003, "dup row"), (9003, "dup row"), (9004, "y" * 200000)], "doc_id long, text string")
    got = qc.classify(docs.unionByName(odd).selectExpr("*", "1 AS score")).collect()
    assert len(got) == 106
    assert all(r.score == 0 and not r.kept for r in got if r.doc_id in (9001, 9002))
    assert qc.classify(docs.limit(0)).count() == 0


def test_fit_against_dense_steps(monkeypatch):
    """The sparse steps against the same rule on a dense matrix, one document and feature at a time."""
    r = np.random.default_rng(3)
    monkeypatch.setattr(qc, "BUCKETS", 40)
    rows = []
    for i in range(30):
        at = np.sort(r.choice(40, 6, replace=False))
        n = r.integers(1, 5, 6)
        rows.append((float(r.random()), at, n / n.sum()))
    w, bias = qc._fitted(rows, 25)
    x = np.zeros((30, 40))
    for i, (_, at, share) in enumerate(rows):
        x[i, at] = share
    scale = np.array([1 / np.sqrt(x[:, j].mean() + 1e-4) for j in range(40)])
    y = np.array([p for p, _, _ in rows])
    good = max(1, sum(y >= 0.5))
    bad = max(1, sum(y < 0.5))
    v, c, g2, c2 = np.zeros(40), 0.0, np.full(40, 1e-8), 1e-8
    for _ in range(25):
        p = [1 / (1 + np.exp(-(sum(x[i, j] * scale[j] * v[j] for j in range(40)) + c))) for i in range(30)]
        e = [(p[i] - y[i]) * (0.5 / good if y[i] >= 0.5 else 0.5 / bad) for i in range(30)]
        g = np.array([sum(e[i] * x[i, j] * scale[j] for i in range(30)) + 1e-5 * v[j] for j in range(40)])
        g2, c2 = g2 + g * g, c2 + sum(e) ** 2
        v, c = v - 0.3 * g / np.sqrt(g2), c - 0.3 * sum(e) / np.sqrt(c2)
    assert np.allclose(w, v * scale, rtol=2e-3, atol=1e-3) and abs(bias - c) < 1e-3


def test_sample_is_bounded_by_rows_and_features(spark, monkeypatch):
    seen = []
    fitted = qc._fitted
    monkeypatch.setattr(qc, "_fitted", lambda rows, steps: seen.append(rows) or fitted(rows, 3))
    one_id = spark.range(400).selectExpr("1L AS doc_id", "concat('some words of text number ', id) AS text")
    qc.classify(one_id, train=50)
    assert len(seen[-1]) == 50
    same = spark.range(400).selectExpr("1L AS doc_id", "'some words of text' AS text")
    qc.classify(same, train=50)
    assert len(seen[-1]) == 1
    qc.classify(one_id, train=50, train_features=200)
    assert 1 <= len(seen[-1]) < 50 and sum(len(r[1]) for r in seen[-1]) <= 200


def test_score_is_the_model_applied_to_the_features(spark, monkeypatch):
    got = {}
    fitted = qc._fitted
    monkeypatch.setattr(qc, "_fitted", lambda rows, steps: got.setdefault("m", fitted(rows, steps)))
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    out = {r.doc_id: r for r in qc.classify(docs).collect()}
    w, bias = got["m"]
    for d in docs.collect():
        at = qc._hashed(d.text.encode())
        want = 1 / (1 + np.exp(-(sum(float(w[i]) for i in at) / len(at) + bias)))
        assert abs(out[d.doc_id].score - want) < 1e-5 and out[d.doc_id].kept == (out[d.doc_id].score >= 0.5)
