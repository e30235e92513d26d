import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sectile.llm import near_dedup as nd


def plain(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 4), max_size=14), st.lists(st.integers(0, 4), max_size=14), st.integers(0, 12))
def test_banded_alignment(a, b, k):
    d = plain(a, b)
    assert nd.edits_within(np.array(a, np.uint32), np.array(b, np.uint32), k) == (d if d <= k else None)


def test_alignment_of_long_sequences():
    r = random.Random(2)
    a = [r.randrange(300) for _ in range(6000)]
    b = list(a)
    for _ in range(200):
        i = r.randrange(len(b))
        b[i : i + 1] = r.choice([[], [7], [8, 9]])
    x, y = np.array(a, np.uint32), np.array(b, np.uint32)
    d = nd._banded(a if len(a) >= len(b) else b, b if len(a) >= len(b) else a, 1200)
    assert nd.edits_within(x, y, 30_000) == nd.edits_within(x, y, 1200) == d <= 400
    assert nd.edits_within(x[:4000], y[:4000], 1200) == nd._banded(a[:4000], b[:4000], 900)
    assert nd.edits_within(x, y, 20) is None


def corpus():
    r = random.Random(5)
    words = ["".join(r.choices("abcdefghij", k=5)) for _ in range(3000)]
    docs = [" ".join(r.choices(words, k=r.randint(40, 300))) for _ in range(150)]
    out = list(docs)
    for d in docs[:60]:
        w = d.split()
        for _ in range(max(1, len(w) // 60)):
            w[r.randrange(len(w))] = r.choice(words)
        out.append(" ".join(w))
    out += docs[:5] * 20 + ["", "", None, "one two", "one  two", " \n", "three words here"]
    return out


def near(a, b):
    n, d = max(len(a), len(b)), plain(a, b)
    x, y = ({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} for w in (a, b))
    return d <= 0.07 * n + 1e-9 or (d <= 0.2 * n + 1e-9 and len(x & y) >= 0.8 * len(x | y) - 1e-9)


def test_pairs_of_every_kind_are_found(spark):
    """Of each kind of near copy that counts as alike, nine of ten pairs and more; what does not count stays apart."""
    r = random.Random(12)
    words = ["".join(r.choices("abcdefghijklm", k=6)) for _ in range(5000)]

    def scattered(w, share):
        w = list(w)
        for i in r.sample(range(len(w)), int(share * len(w))):
            w[i] = r.choice(words)
        return w

    def put_in(w, n):
        at = r.randrange(len(w))
        return w[:at] + r.choices(words, k=n) + w[at:]

    def left_out(w, n):
        at = r.randrange(len(w) - n)
        return w[:at] + w[at + n :]

    kinds = {
        "2 % of words": lambda w: scattered(w, 0.02), "5 % of words": lambda w: scattered(w, 0.05), "7 % of words": lambda w: scattered(w, 0.07),
        "60 words put in": lambda w: put_in(w, 60), "50 words left out": lambda w: left_out(w, 50), "30 put in, 20 left out": lambda w: left_out(put_in(w, 30), 20), "40 % of words": lambda w: scattered(w, 0.4),
    }
    pairs, texts = [], []
    for name, change in kinds.items():
        for _ in range(80):
            w = r.choices(words, k=300)
            pairs.append((name, len(texts), len(texts) + 1))
            texts += [" ".join(w), " ".join(change(w))]
    got = {x.doc_id: x.class_id for x in nd.classes(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    for name in kinds:
        mine = [(a, b) for k, a, b in pairs if k == name]
        assert all(near(texts[a].split(), texts[b].split()) == (name != "40 % of words") for a, b in mine[:3])
        found = sum(got[a] == got[b] for a, b in mine) / len(mine)
        assert found == 0 if name == "40 % of words" else found >= 0.9, (name, found)


def test_classes_against_brute_force(spark):
    texts = corpus()
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, class_id string")
    got = {r.doc_id: r.class_id for r in nd.classes(df).collect()}
    words = [(t or "").lower().split() for t in texts]
    own = list(range(len(texts)))

    def find(i):
        while own[i] != i:
            i = own[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            a, b = words[i], words[j]
            n = max(len(a), len(b))
            same = (texts[i] or "") == (texts[j] or "")
            if same or (n and min(len(a), len(b)) >= 0.8 * n and len(set(a) & set(b)) > 0.4 * len(set(a)) and near(a, b)):
                x, y = find(i), find(j)
                own[max(x, y)] = min(x, y)
    assert got == {i: find(i) for i in range(len(texts))}
    kept = nd.keep(df).collect()
    assert sorted(r.doc_id for r in kept) == sorted(set(got.values()))


def crowded():
    """Texts over one long passage, all unlike each other, and behind them pairs that meet in the crowded buckets only."""
    r = random.Random(11)
    common = [f"c{i}" for i in range(70)]
    own = [[f"t{d}x{i}" for i in range(30)] for d in range(60)]
    twins = [[f"u{d}x{i}" if i % 5 == 0 else w for i, w in enumerate(words)] for d, words in enumerate(own[40:])]
    texts = [" ".join(common + words) for words in own[:40]]
    behind = [" ".join(common + words) for words in own[40:] + twins]
    r.shuffle(behind)
    return texts + behind


@pytest.mark.parametrize("block", [nd.BLOCK, 7])
def test_alike_texts_behind_many_unlike_leaders(spark, monkeypatch, block):
    monkeypatch.setattr(nd, "BLOCK", block)  # 7: buckets of several blocks, classes that fill blocks of their own
    texts = crowded()
    got = {r.doc_id: r.class_id for r in nd.classes(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    h, first = nd.hashed_words(texts)
    bands = nd.sketch(h, first)
    want = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if (bands[i] == bands[j]).any() and nd.alike(h[first[i] : first[i + 1]], h[first[j] : first[j + 1]]):
                want[i] = want[j]
    buckets = [np.unique(column, return_counts=True)[1].max() for column in bands.T]
    assert max(buckets) > 15
    assert sum(i != c for i, c in enumerate(want)) > 10
    assert got == dict(enumerate(want))


def test_repeated_rows_null_keys_and_no_rows(spark):
    df = spark.createDataFrame([(1, "a b c"), (1, "a b c"), (None, "a b c"), (2, None)], "doc_id long, text string")
    got = sorted((r.doc_id or -1, r.class_id) for r in nd.classes(df).collect())
    assert got == [(-1, None), (1, 1), (2, 2)]
    assert sorted(r.doc_id or -1 for r in nd.keep(df).collect()) == [-1, 1, 2]
    assert nd.classes(df.limit(0)).count() == 0
    assert nd.keep(df.limit(0)).count() == 0


def test_a_large_class_and_unlike_texts_in_one_bucket(spark, monkeypatch):
    monkeypatch.setattr(nd, "BLOCK", 5)
    r = random.Random(3)
    common = [f"c{i}" for i in range(70)]
    family = [f"f{i}" for i in range(30)]
    texts = [" ".join(common + [f"t{d}x{i}" for i in range(30)]) for d in range(12)]
    for d in range(40):
        mine = list(family)
        mine[d % 30] = f"g{d}"
        texts.append(" ".join(common + mine))
    order = list(range(len(texts)))
    r.shuffle(order)
    got = {x.doc_id: x.class_id for x in nd.classes(spark.createDataFrame([(i, texts[o]) for i, o in enumerate(order)], "doc_id long, text string")).collect()}
    least = min(i for i, o in enumerate(order) if o >= 12)
    assert got == {i: i if o < 12 else least for i, o in enumerate(order)}


def test_clashing_names_come_back_as_they_are(spark):
    df = spark.createDataFrame([(1, 7, "a b c d e f", 8), (2, 6, "a b c d e f", 9)], "doc_id long, DOC_ID2 long, text string, _n long").toDF("doc_id", "DOC_ID", "text", "_n")
    out = nd.keep(df)
    assert out.columns == ["doc_id", "DOC_ID", "text", "_n"] and [tuple(r) for r in out.collect()] == [(1, 7, "a b c d e f", 8)]
    out = nd.keep(df.toDF("doc_id", "id", "text", "class_id"))
    assert out.columns == ["doc_id", "id", "text", "class_id"] and [tuple(r) for r in out.collect()] == [(1, 7, "a b c d e f", 8)]


def test_a_very_long_text(spark):
    r = random.Random(8)
    long = [f"w{r.randrange(5000)}" for _ in range(100_000)]
    edited = [w if i % 50 else "x" for i, w in enumerate(long)]
    got = nd.classes(spark.createDataFrame([(1, " ".join(long)), (2, " ".join(edited)), (3, " ".join(long[:50_000]))], "doc_id long, text string"))
    assert sorted((x.doc_id, x.class_id) for x in got.collect()) == [(1, 1), (2, 1), (3, 3)]
