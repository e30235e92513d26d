import re
from collections import Counter

from sectile.llm import quality_rules as q

D = "/root/testdata/sf0.001"
ODD = [None, "", "   \n\t", "a b c d e f g h " * 30, "x\n\nx\nx\n", "é" * 3000, "word " * 5000, "same text here", "same text here", *(f"abc {c}" for c in "\u0085\u2028\u2029"), "a b \u2028\n", " \u2029 ", "x\u0085 \u2028y \r\n"]


def brute(t):
    t = t or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    grams = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    hit = {k for i in range(len(w) - 7) if grams[tuple(w[i : i + 8])] > 1 for k in range(i, i + 8)}
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(hit)


def as_counts(r):
    return r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words


def test_counts_against_brute_force(spark):
    docs = spark.read.parquet(f"{D}/documents.parquet")
    got = {r.doc_id: r for r in q.score(docs).collect()}
    for d in docs.collect():
        r = got[d.doc_id]
        n, _, _, _, rep = brute(d.text)
        assert as_counts(r) == brute(d.text)
        assert r.base_failed == (n < 20 or 100 * rep > 30 * n)
        assert not (r.base_failed and r.kept)


def test_odd_texts_and_clashing_columns(spark):
    df = spark.createDataFrame([(i, t, 7) for i, t in enumerate(ODD)], "doc_id long, text string, n_words int")
    for r in q.score(df).collect():
        assert as_counts(r) == brute(ODD[r.doc_id])
    assert q.keep(df).columns == df.columns
    assert q.score(df.limit(0)).count() == 0 and q.keep(df.limit(0)).count() == 0


def test_clean_documents_stay_and_junk_goes(spark):
    d = "/root/testdata/sf0.01"
    got = q.score(spark.read.parquet(f"{d}/documents.parquet")).join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id").collect()
    clean = [r for r in got if r.quality == 1 and not r.base_failed]
    junk = [r for r in got if r.quality == 0]
    assert sum(r.kept for r in clean) >= 0.99 * len(clean)
    assert sum(not r.kept for r in junk) >= 0.9 * len(junk)


def test_clashing_names_come_back_as_they_are(spark):
    text = " ".join(f"word{i}" for i in range(80)) + "."
    df = spark.createDataFrame([(1, text, "x", 7)], "doc_id long, text string, c string, d int").toDF("doc_id", "text", "TEXT", "counts")
    out = q.keep(df)
    assert out.columns == df.columns and [tuple(r) for r in out.collect()] == [(1, text, "x", 7)]
    assert q.score(df).count() == 1
