import hashlib
import json
import random

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from tokenizers import Tokenizer

from sectile.llm import bpe, queries, token_counts

TEXTS = ["", None, "a" * 3000, " \n\t x  y z", "<|endoftext|>hi <|startoftext|>x <|start", "ΣΑΣ İstanbul é ́x don't WE'LL", "日本語 🙂🙂 123 45.6", "\x01\x7f" + "é" * 40, "x " * 20000 + "<|endoftext|>" + " ý" * 9000, "same", "same"]
SCHEMA = "doc_id long, text string, N_TOKENS string"


def frame(spark, texts=TEXTS):
    return spark.createDataFrame([(i, t, "z") for i, t in enumerate(texts)], SCHEMA)


def test_ids_equal_the_library(spark):
    ranks = bpe.load_ranks(open(P.path("byte_bpe_50k.tiktoken"), "rb").read())
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = {r.doc_id: r for r in bpe.round_trip(frame(spark), P.path("byte_bpe_50k.tiktoken"), P.PATTERN).collect()}
    assert len(got) == len(TEXTS)
    for i, t in enumerate(TEXTS):
        ids = np.asarray(enc.encode_ordinary(t or ""), "<u4").tobytes()
        assert got[i].n_tokens == len(ids) // 4
        assert got[i].ids_sha256 == hashlib.sha256(ids).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()


def test_encode_then_decode(spark):
    coded = bpe.encode(frame(spark), P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
    back = {r.doc_id: bytes(r.content) for r in bpe.decode(coded, P.path("byte_bpe_50k.tiktoken"), P.PATTERN).collect()}
    assert back == {i: (t or "").encode() for i, t in enumerate(TEXTS)}


def test_ranks_with_a_gap_are_refused():
    with pytest.raises(ValueError):
        bpe.model_bytes({b"a": 0, b"b": 2})


def test_counts_equal_the_library(spark):
    lib = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    got = {r.doc_id: r for r in token_counts.token_counts(frame(spark), P.path("word_bpe_49k.json")).collect()}
    for i, t in enumerate(TEXTS):
        n = len(lib.encode(t or "", add_special_tokens=False).ids)
        assert (got[i].n_tokens, got[i].over_limit, got[i].n_bytes) == (n, n > 2048, len((t or "").encode()))


def test_whole_table_against_the_libraries(spark):
    lib = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    d = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{d}/documents.parquet").collect()}
    got = {r.doc_id: r.n_tokens for r in queries.op9_token_counts(spark, d).collect()}
    assert got == {i: len(lib.encode(t, add_special_tokens=False).ids) for i, t in texts.items()}


def test_empty_table(spark):
    none = frame(spark).limit(0)
    assert bpe.round_trip(none, P.path("byte_bpe_50k.tiktoken"), P.PATTERN).count() == 0
    assert token_counts.token_counts(none, P.path("word_bpe_49k.json")).count() == 0


def counter():
    return token_counts.Counter(json.loads(open(P.path("word_bpe_49k.json")).read()))


@pytest.mark.parametrize("chunk", [1, 3, 7, 1 << 14])
def test_chunk_maps_compose_to_the_library_counts(monkeypatch, chunk):
    monkeypatch.setattr(token_counts, "CHUNK", chunk)
    lib, mine, r = Tokenizer.from_file(P.path("word_bpe_49k.json")), counter(), random.Random(chunk)
    for _ in range(1500):
        text = "".join(r.choices("abcdeorsvltm''''  !?.-129 éßΣ日🙂\n\t́ŀ", k=r.randint(0, 40)))
        assert mine.count(text) == len(lib.encode(text, add_special_tokens=False).ids), text


def test_states_are_few_and_tables_bounded_in_one_long_word(monkeypatch):
    lib, mine, r = Tokenizer.from_file(P.path("word_bpe_49k.json")), counter(), random.Random(4)
    word = "acgt" * 500_000
    mine.count(word)
    assert len(mine.fst.values) < 100
    monkeypatch.setattr(token_counts, "STATES", 500)
    monkeypatch.setattr(token_counts, "EDGES", 700)
    word = "".join(r.choices("abcdefghijklmnopqrstuvwxyz", k=60_000))
    assert mine.count(word) == len(lib.encode(word, add_special_tokens=False).ids)
    assert len(mine.fst.values) <= 500 and len(mine.fst.next) <= 702


def test_clashing_names_play_no_part(spark):
    df = spark.createDataFrame([(1, 5, "two words", "x", 9)], "a long, b long, c string, d string, e long").toDF("doc_id", "DOC_ID", "text", "TEXT", "n_tokens")
    lib = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    want = len(lib.encode("two words", add_special_tokens=False).ids)
    assert [(r.doc_id, r.n_tokens) for r in token_counts.token_counts(df, P.path("word_bpe_49k.json")).collect()] == [(1, want)]
    assert [r.doc_id for r in bpe.round_trip(df, P.path("byte_bpe_50k.tiktoken"), P.PATTERN).collect()] == [1]


def test_pairs_of_tokens_against_plain_merging():
    fst = counter().fst

    def merged(symbols):
        while True:
            ranked = [(fst.rank[p], i) for i, p in enumerate(zip(symbols, symbols[1:])) if p in fst.rank]
            if not ranked:
                return symbols
            _, i = min(ranked)
            symbols = [*symbols[:i], symbols[i] + symbols[i + 1], *symbols[i + 2 :]]

    def symbols(token):
        body = token.removesuffix(fst.end) if len(token) > len(fst.end) else token
        return [*body[:-1], body[-1] + token[len(body) :]]

    r = random.Random(6)
    tokens = [t for t in fst.vocab if not t.startswith("<|")]
    inner = [t for t in tokens if not t.endswith(fst.end)]
    short = [t for t in inner if len(t) < 4]
    whole = 0
    for _ in range(6000):
        a, b = r.choice(r.choice([inner, short])), r.choice(r.choice([tokens, short]))
        assert fst._fits(None, b) == (merged(symbols(b)) == [b])
        if fst._fits(None, a):
            whole += 1
            assert fst._fits(a, b) == (merged(symbols(a) + symbols(b)) == [a, b]), (a, b)
    assert whole > 1000


def test_every_cased_letter_counts_as_in_the_library():
    """All letters that have case in the newest tables, alone and after another letter."""
    lib, mine = Tokenizer.from_file(P.path("word_bpe_49k.json")), counter()
    cased = [chr(c) for c in range(0x80, 0x1F000) if not 0xD800 <= c < 0xE000 and (chr(c).lower() != chr(c) or c in token_counts._NEWER)]
    assert len(cased) > 1300
    for c in cased:
        for text in (c, "a" + c + c.lower()):
            assert mine.count(text) == len(lib.encode(text, add_special_tokens=False).ids), hex(ord(c))
