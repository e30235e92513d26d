import hashlib
import random

import numpy as np

from sectile.llm import suffix_dedup as sd


def brute(rows):
    """(id, text) -> removal by the definition; rows with a null id are left alone."""
    seen, out = {}, []
    for i, t in sorted(((i, t) for i, t in rows if i is not None), key=lambda x: x[0]):
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - 49):
            if seen.setdefault(b[p : p + 50], i) < i:
                gone[p : p + 50] = True
        n = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        out.append((i, len(b), int(gone.sum()), n, hashlib.sha256(np.frombuffer(b, np.uint8)[~gone].tobytes()).hexdigest()))
    return out


def texts():
    r = random.Random(3)
    letters = "abcdeéß日 "
    base = ["".join(r.choices(letters, k=r.randint(0, 400))) for _ in range(60)]
    passage = "".join(r.choices(letters, k=90))
    out = list(base)
    for _ in range(60):
        a, b = r.choice(base), r.choice(base)
        x, y = r.randint(0, len(a)), r.randint(0, len(b))
        out.append(a[x : x + r.randint(20, 200)] + r.choice(["", passage, "-"]) + b[y : y + r.randint(20, 200)])
    out += ["a" * 300, "a" * 49, "a" * 50, "b" + "a" * 120, "ab" * 100, None, "", base[3], base[3], passage * 3, " " * 200]
    return out


def test_against_brute_force(spark):
    rows = list(enumerate(texts()))
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, n_bytes string").repartition(5)
    got = [tuple(x) for x in sd.report(df).orderBy("doc_id").collect()]
    assert got == brute(rows)


def test_long_texts_are_cut_into_slabs(monkeypatch, spark):
    r = random.Random(4)
    long = "".join(r.choices("abcdefgh ", k=5000))
    rows = [(0, long), (1, "x" + long[1000:3000] + "y" + long[10:90]), (2, long[:40] + long[4900:])]
    monkeypatch.setattr(sd, "SLAB", 256)
    n = 0
    for k, t in rows:
        i, p, lo, hi = sd.anchors([t.encode()])
        assert sorted(s for a, b in zip(lo, hi) for s in range(a, b + 1)) == list(range(len(t) - 49))
        assert ((p >= lo.clip(0)) & (p <= hi + 34) & (p >= hi) & (p <= lo + 34)).all()
        n += len(p)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert [tuple(x) for x in sd.report(df).orderBy("doc_id").collect()] == brute(rows)


def test_repeated_rows_null_ids_and_no_rows(spark):
    t = "word " * 3 + "".join(random.Random(1).choices("abcdefgh", k=100))
    df = spark.createDataFrame([(5, t), (5, t), (None, t), (7, "z" + t)], "doc_id long, text string")
    got = sorted((x.doc_id or -1, x.n_removed) for x in sd.report(df).collect())
    assert got == [(-1, 0), (5, 0), (5, 0), (7, len(t))]
    assert sd.report(df.limit(0)).count() == 0
    assert sd.strip(df.limit(0)).count() == 0


def test_stripped_text_stays_text(spark):
    t = "é" * 10 + "".join(random.Random(1).choices("abcdefgh", k=100)) + "日本"
    rows = [(1, t, "s"), (2, "ü" + t[3:] + "語 new tail", "s"), (3, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = {x.doc_id: x for x in sd.strip(df).collect()}
    assert out[1].text == t and out[3].text is None and out[2].text.endswith("語 new tail") and len(out[2].text) < 30
    assert sd.strip(df).columns == df.columns


def test_multikey_quicksort_on_long_equal_prefixes():
    r = random.Random(9)
    rows = ["a" * r.randint(0, 45) + "".join(r.choices("ab", k=50)) for _ in range(400)]
    buf = np.frombuffer("".join(x[:50] for x in rows).encode() + b"0" * 8, np.uint8)
    doc = np.array([r.randint(0, 50) for _ in rows])
    got = sd.dominated(buf, np.arange(len(rows)) * 50, doc)
    least = {}
    for x, d in zip(rows, doc):
        least[x[:50]] = min(d, least.get(x[:50], d))
    assert got.tolist() == [d > least[x[:50]] for x, d in zip(rows, doc)]


def test_hot_leads_are_held_back(monkeypatch, spark):
    monkeypatch.setattr(sd, "HOT", 3)
    monkeypatch.setattr(sd, "HELD_SUFFIXES", 60)
    r = random.Random(12)
    letters = "abcdefgh "
    passage = "".join(r.choices(letters, k=120))
    rows = [(i, "".join(r.choices(letters, k=60)) + passage[: r.randint(60, 120)] + "".join(r.choices(letters, k=60)) + " " * r.randint(0, 90)) for i in range(80)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert [tuple(x) for x in sd.report(df).orderBy("doc_id").collect()] == brute(rows)


def test_a_text_longer_than_a_slab_and_clashing_names(spark):
    r = random.Random(13)
    long = "".join(r.choices("abcdefgh ", k=sd.SLAB + 300_000))
    cut = sd.SLAB - 40
    rows = [(0, long), (1, "x" + long[cut : cut + 200] + "y")]
    df = spark.createDataFrame([(i, t, -1, "lo") for i, t in rows], "doc_id long, text string, a long, b string").toDF("doc_id", "text", "ID", "TEXT")
    assert [tuple(x) for x in sd.report(df).orderBy("doc_id").collect()] == brute(rows)
    out = sd.strip(df)
    assert out.columns == df.columns and sorted(tuple(x) for x in out.collect()) == [(0, long, -1, "lo"), (1, "xy", -1, "lo")]


def test_texts_under_one_id_keep_their_own_runs(spark):
    a, b = ("".join(random.Random(k).choices("abcdefgh", k=100)) for k in (1, 2))
    df = spark.createDataFrame([(1, a), (5, "pq" + a), (5, b + "rs"), (9, b)], "doc_id long, text string")
    assert sorted((x.doc_id, x.n_removed) for x in sd.report(df).collect()) == [(1, 0), (5, 0), (5, 100), (9, 100)]
