"""Byte-level BPE by a sentencepiece model that is serialised straight from a rank file.

Every byte becomes one printable character, so every token of the vocabulary is a string of such characters; its
score is the negative of its rank, so the best-scoring merge is the merge of lowest rank. The normaliser is the
identity. Texts are split into pre-tokens by a pattern; each is encoded on its own. Decoding maps the characters of
the pieces back to bytes.

Defined results: a null text counts as empty; an empty text has no ids and decodes to no bytes; repeated rows each
give a row; extra columns, clashing ones too, are ignored; a text of any length is coded whole; an empty table gives an empty
table.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Sequence
from pathlib import Path

import numpy as np
import regex
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import arrow_map, ids_and_texts, only

#: Pre-tokens whose ids a worker remembers at most.
CACHE = 250_000


def byte_letters() -> list[str]:
    """A printable character for each byte: itself where it prints, else the next free one from 256 on."""
    prints = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b if b in prints else next(spare)) for b in range(256)]


def load_ranks(data: bytes) -> dict[bytes, int]:
    """Tokens and ranks of a file with a base64 token and its rank on each line."""
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in data.splitlines() if line)}


def _varint(n: int) -> bytes:
    n &= (1 << 64) - 1
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    return bytes(out + bytes([n]))


def _number(field: int, n: int) -> bytes:
    return _varint(field << 3) + _varint(n)


def _block(field: int, data: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(data)) + data


#: Fixed values of the public sentencepiece model format: field numbers and enumerations.
_PIECE, _TRAINER, _NORMALIZER, _UNKNOWN, _BPE = 1, 2, 3, 2, 2


def model_bytes(ranks: dict[bytes, int]) -> bytes:
    """The vocabulary as a serialised model. Ids are the ranks; the unknown piece, never met, comes last."""
    letters = byte_letters()
    order = sorted(ranks.items(), key=lambda x: x[1])
    if [r for _, r in order] != list(range(len(order))):
        raise ValueError("ranks must be 0, 1, 2, ...")
    out = bytearray()
    for token, rank in order:
        piece = "".join(letters[b] for b in token).encode()
        out += _block(_PIECE, _block(1, piece) + b"\x15" + struct.pack("<f", -float(rank)) + _number(3, 1))
    unk = len(order)
    out += _block(_PIECE, _block(1, b"<unk>") + b"\x15" + struct.pack("<f", -float(unk)) + _number(3, _UNKNOWN))
    out += _block(_TRAINER, _number(3, _BPE) + _number(4, unk + 1) + _number(40, unk) + _number(41, -1) + _number(42, -1) + _number(43, -1) + _block(45, b"<unk>"))
    out += _block(_NORMALIZER, _block(1, b"identity") + _number(3, 0) + _number(4, 0) + _number(5, 0))
    return bytes(out)


class ByteBpe:
    """Encoder and decoder; build it on the worker from model_bytes()."""

    def __init__(self, model: bytes, pattern: str):
        self.sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.split = regex.compile(pattern).findall
        self.letters = dict(enumerate(byte_letters()))
        back = {c: b for b, c in self.letters.items()}
        self.unk = self.sp.unk_id()
        self.bytes_of = [bytes(back[c] for c in self.sp.id_to_piece(i)) for i in range(self.unk)]
        self.known: dict[str, bytes] = {}

    def _pretoken(self, piece: str) -> bytes:
        ids = self.sp.encode(piece.encode().decode("latin-1").translate(self.letters))
        return np.asarray(ids, "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        pieces = self.split(text)
        known = self.known
        if len(known) > CACHE:
            known.clear()
        out = [known.get(p) for p in pieces]
        for i, ids in enumerate(out):
            if ids is None:
                p = pieces[i]
                ids = known.get(p)
                if ids is None:
                    ids = self._pretoken(p)
                    if len(p) <= 64:
                        known[p] = ids
                out[i] = ids
        return b"".join(out)

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))


_READY: dict[str, ByteBpe] = {}


def _ready(shared, pattern: str, key: str) -> ByteBpe:
    if key not in _READY:
        _READY.clear()
        _READY[key] = ByteBpe(shared.value, pattern)
    return _READY[key]


def _maker(spark, vocabulary: str, pattern: str):
    model = model_bytes(load_ranks(Path(vocabulary).read_bytes()))
    shared = spark.sparkContext.broadcast(model)  # under 2 MB: the size of the vocabulary
    key = hashlib.sha256(model + pattern.encode()).hexdigest()
    return lambda: _ready(shared, pattern, key)


def encode(docs: DataFrame, vocabulary: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, ids): ids of each text as an array of ints."""
    make = _maker(docs.sparkSession, vocabulary, pattern)
    docs = only(docs, key, text)

    def run(b):
        bpe = make()
        keys, texts = ids_and_texts(b, key, text)
        yield {key: keys, "ids": [np.frombuffer(bpe.encode(t), "<u4").astype(np.int32) for t in texts]}

    return arrow_map(docs, run, T.StructType([T.StructField(key, docs.schema[key].dataType), T.StructField("ids", T.ArrayType(T.IntegerType()))]))


def decode(coded: DataFrame, vocabulary: str, pattern: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """(key, content): the bytes that the ids stand for."""
    make = _maker(coded.sparkSession, vocabulary, pattern)
    coded = only(coded, key, ids)

    def run(b):
        bpe = make()
        yield {key: b.column(key).to_pylist(), "content": [bpe.decode(np.asarray(x or [], "<u4").tobytes()) for x in b.column(ids).to_pylist()]}

    return arrow_map(coded, run, T.StructType([coded.schema[key], T.StructField("content", T.BinaryType())]))


def round_trip(docs: DataFrame, vocabulary: str, pattern: str, key: str = "doc_id", text: str = "text", also: Sequence[str] = ()) -> DataFrame:
    """Per row: n_tokens, ids_sha256, decoded_sha256 and the columns `also`. One pass, no shuffle; a text is encoded and its ids decoded again."""
    make = _maker(docs.sparkSession, vocabulary, pattern)
    docs = only(docs, key, text, *also)

    def run(b):
        bpe = make()
        keys, texts = ids_and_texts(b, key, text)
        coded = [bpe.encode(t) for t in texts]
        yield {
            key: keys,
            "n_tokens": [len(x) // 4 for x in coded],
            "ids_sha256": [hashlib.sha256(x).hexdigest() for x in coded],
            "decoded_sha256": [hashlib.sha256(bpe.decode(x)).hexdigest() for x in coded],
        } | {c: b.column(c) for c in also}

    schema = T.StructType([docs.schema[key], T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType()), *[docs.schema[c] for c in also]])
    return arrow_map(docs, run, schema)
