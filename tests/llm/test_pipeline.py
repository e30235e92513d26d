import hashlib

import duckdb
import numpy as np
import public_tokenizers as P
import tiktoken

import corpus_pipeline as cp
from sectile.llm import bpe, mixing, queries
from sectile.llm.common import cut, table

D = "/root/testdata/sf0.001"


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def near(a, b):
    n, d = max(len(a), len(b)), distance(a, b)
    x, y = ({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} for w in (a, b))
    return d <= 0.07 * n + 1e-9 or (d <= 0.2 * n + 1e-9 and len(x & y) >= 0.8 * len(x | y) - 1e-9)


def brute(docs):
    """Rows of the pipeline by the definitions: the SQL of the quality rules, all pairs, all strings of 50 bytes, tiktoken."""
    c = duckdb.connect()
    c.execute(f"CREATE VIEW documents AS SELECT * FROM '{D}/documents.parquet'")
    rel = c.execute(queries.ORACLE_SQL["op8_quality_rules"])
    names = [x[0] for x in rel.description]
    kept = [r[names.index("doc_id")] for r in rel.fetchall() if r[names.index("kept")]]
    words = {i: docs[i].lower().split() for i in kept}
    own = {i: i for i in kept}

    def root(i):
        while own[i] != i:
            i = own[i]
        return i

    for i in kept:
        for j in kept:
            a, b = words[i], words[j]
            n = max(len(a), len(b))
            if j < i and root(i) != root(j) and min(len(a), len(b)) >= 0.8 * n and len(set(a) & set(b)) > 0.4 * min(len(set(a)), len(set(b))) and near(a, b):
                x, y = root(i), root(j)
                own[max(x, y)] = min(x, y)
    ranks = bpe.load_ranks(open(P.path("byte_bpe_50k.tiktoken"), "rb").read())
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    seen, out = {}, []
    for i in sorted(i for i in kept if root(i) == i):
        b = docs[i].encode()
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - 49):
            if seen.setdefault(b[p : p + 50], i) < i:
                gone[p : p + 50] = True
        edge = [0, *(np.flatnonzero(np.diff(gone.astype(int))) + 1).tolist(), len(b)]
        text = b"".join(b[s:e] for s, e in zip(edge, edge[1:]) if e > s and not gone[s]).decode(errors="ignore")
        ids = np.asarray(enc.encode_ordinary(text), "<u4").tobytes()
        out.append((i, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    return out


def test_rows_against_brute_force(spark):
    docs = {r.doc_id: r.text for r in table(spark, D, "documents").collect()}
    got = sorted((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in cp.run(spark, D).collect())
    assert got == brute(docs)


def test_rows_carry_their_places_in_the_mixture(spark):
    """Bytes before a row within its source by the order of digests, and slots by a plain earliest deadline first."""
    docs = table(spark, D, "documents")
    for _, stage in cp.STAGES[:-1]:
        docs = cut(stage(spark, docs, D))
    size, start, rows = {}, {}, docs.select("doc_id", "source", "text").collect()
    for r in sorted(rows, key=lambda r: hashlib.md5(str(r.doc_id).encode()).hexdigest()):
        start[r.doc_id] = size.get(r.source, 0)
        size[r.source] = start[r.doc_id] + len(r.text.encode()) + 1
    period = max(mixing.PERIOD, mixing.PERIOD_PER_SOURCE * len(size))
    weight = {s: max(1, int(n**0.5 * 1000)) for s, n in size.items()}
    whole = {s: 1 + w * (period - len(size)) // sum(weight.values()) for s, w in weight.items()}
    rest = sorted(size, key=lambda s: (-(weight[s] * (period - len(size)) % sum(weight.values())), s))
    share = {s: whole[s] + (s in rest[: period - sum(whole.values())]) for s in size}
    slot, done = {}, dict.fromkeys(size, 0)
    for t in range(period):
        ready = [(-(-(done[s] + 1) * period // share[s]), s) for s in size if done[s] * period // share[s] <= t]
        if ready:
            s = min(ready)[1]
            slot[s, done[s]] = t
            done[s] += 1

    def at(r):
        turn, k = divmod(start[r.doc_id] // mixing.BLOCK_BYTES, share[r.source])
        return turn * period + slot[r.source, k]

    want = sorted((r.doc_id, at(r), start[r.doc_id]) for r in rows)
    got = sorted((r.doc_id, r.slot, r.start_byte) for r in cp.run(spark, D).collect())
    assert got == want and len({s for _, s, _ in want}) > 1


def test_places_of_repeated_rows(spark):
    df = spark.createDataFrame([(1, "a", "xx"), (1, "a", "xx"), (2, None, None), (None, "", ""), (None, "", "")], "doc_id long, source string, text string")
    rows = mixing.with_places(df, mixing.positions(df, block_bytes=2)).collect()
    assert len(rows) == 5 and all(r.slot is not None for r in rows)
    assert sorted(r.start_byte for r in rows if r.doc_id == 1) == [0, 3]
    assert sorted(r.start_byte for r in rows if r.doc_id is None) in ([0, 1], [0, 2], [1, 2])


def test_stages_keep_the_columns(spark):
    docs = table(spark, D, "documents")
    n = docs.count()
    for name, stage in cp.STAGES[:-1]:
        out = stage(spark, docs, D)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes, name
        out = cut(out)
        assert 0 < out.count() <= n, name
        docs, n = out, out.count()


def test_no_documents(spark):
    docs = table(spark, D, "documents").limit(0)
    for name, stage in cp.STAGES:
        assert stage(spark, docs, D).count() == 0, name


def test_registered(spark):
    import __spark_entry__ as e

    assert "pipeline" in e.queries() and "pipeline" not in e.oracle_sql()


def test_odd_rows_pass_all_stages(spark, tmp_path):
    """Null and empty texts, null ids, repeated rows, clashing columns and a very long text in one run."""
    good = " ".join(f"word{i}" for i in range(90)) + "."
    rows = [(1, good, "en", "a", 1), (2, good, "en", "b", 1), (3, None, "en", "a", 0), (4, "", "en", "a", 0), (None, good.replace("word1", "other1"), "en", "a", 1), (5, good.replace("word", "term"), None, None, None), (5, good.replace("word", "term"), None, None, None)]
    rows.append((6, " ".join(f"word{i}" + "." * (i % 10 == 9) for i in range(100, 120_100)), "en", "a", 2))
    df = spark.createDataFrame([(*r, 7, "x", "y") for r in rows], "doc_id long, text string, lang string, source string, n_chars long, slot int, k string, start_byte string")
    df.write.parquet(str(tmp_path / "documents.parquet"))
    out = cp.run(spark, str(tmp_path)).collect()
    assert sorted(r.doc_id or 0 for r in out) == [0, 1, 5, 6]  # no words: out; the copy and the repeated row: out
    assert all(r.slot is not None and int(r.start_byte) >= 0 for r in out) and max(r.n_tokens for r in out) > 120_000
    one = {r.doc_id: r.ids_sha256 for r in out}
    assert {r.doc_id: r.ids_sha256 for r in cp.run(spark, str(tmp_path)).collect()} == one
