"""Language-model scoring with an Elias-Fano n-gram trie, in shards.

Words (runs outside ASCII white space, A-Z in lower case; 64-bit fingerprints) and one end per text are tokens.
The model is learnt from the texts whose crc32 of the id leaves a remainder other than 0. Unigrams are discounted by
D = n1 / (n1 + 2 n2); what the discounts free is the probability of the unknown word. Pairs are smoothed towards
unigrams: p(w | v) = (c(v w) + MU p(w)) / (c(v) + MU); an end is the context of a text's first token. Both sum to one
over the known words, the end and the unknown word.

1. Tasks reduce their texts to chunks; the distinct fingerprints of a chunk, with counts, are dealt by fingerprint.
   Buckets count words, number them and send numbers and counts back to the chunks.
2. The distinct pairs of a chunk, with counts, are dealt by their context; frequent contexts are split by the following
   word, which leaves each pair's count whole. A bucket builds its shard of the trie: level 1 has the contexts and monotone
   pointers to their successors, level 2 the successors. Siblings are numbered from the last value of the range before
   them, which makes the level monotone; both levels are partitioned Elias-Fano sequences. A probability is a 16-bit code.
   The levels go to a file that is mapped and unlinked at once. A pair is found by the successor search in its context's
   range, which the pointers give.
3. A code for each pair comes back to the chunk, where it is read for each token and summed for each text. A pair that
   all texts hold costs one record for each chunk.

All shuffles carry packed arrays and grow in proportion to the input; nothing of it goes to the driver but a row of
four sums for each bucket.

Defined results: a null text counts as empty (one token, the end); a null id counts as the empty string for the
remainder; repeated rows each count and each get a row; extra columns play no part; a very long text is a chunk of its
own; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import mmap
import tempfile
import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import arrow_fold, bucket_count, cut, mix, only, pack, span_hashes, unpack, word_spans

#: Tokens of a chunk; text bytes for each bucket of words and of pairs; tokens of a context that is split.
CHUNK, WORD_BUCKET, PAIR_BUCKET, HOT = 1_000_000, 16 << 20, 4 << 20, 100_000
#: Rows of packed arrays (up to MBs each) that a function sees at once.
PACKED_ROWS = 32
MU = 20.0
_END = np.uint64(0x0123456789ABCDEF)
_STEP = 12 / 65535  # of a probability's code, in powers of ten


# -- Elias-Fano -----------------------------------------------------------------------------------------------------


class EliasFano:
    """A monotone sequence in blocks: of each value the low bits are stored as they are, the high bits as gaps in unary."""

    BLOCK = 1 << 12

    def __init__(self, n: int, first: np.ndarray, shift: np.ndarray, at: np.ndarray, data):
        self.n, self.first, self.shift, self.at, self.data = n, first, shift, at, data

    @classmethod
    def parts(cls, values: np.ndarray) -> tuple:
        """(n, first, shift, at) and the bytes."""
        first, shift, at, out, size = [], [], [0], [], 0
        for b in range(0, len(values), cls.BLOCK):
            v = values[b : b + cls.BLOCK].astype(np.uint64)
            base = v[0]
            v = v - base
            low = max(0, int(v[-1] // np.uint64(len(v))).bit_length() - 1) if len(v) else 0
            high = (v >> np.uint64(low)).astype(np.int64) + np.arange(len(v))
            bits = np.zeros(int(high[-1]) + 1, np.uint8)
            bits[high] = 1
            lows = (v[:, None] >> np.arange(low, dtype=np.uint64) & np.uint64(1)).astype(np.uint8) if low else np.zeros((0, 0), np.uint8)
            for piece in (np.packbits(lows.reshape(-1)), np.packbits(bits)):
                out.append(piece)
                size += len(piece)
                at.append(size)
            first.append(int(base))
            shift.append(low)
        return (len(values), np.array(first, np.uint64), np.array(shift, np.uint8), np.array(at, np.int64)), np.concatenate(out).tobytes() if out else b""

    def block(self, b: int) -> np.ndarray:
        size = min(self.BLOCK, self.n - b * self.BLOCK)
        low = int(self.shift[b])
        raw = np.frombuffer(self.data, np.uint8)
        bits = np.unpackbits(raw[self.at[2 * b + 1] : self.at[2 * b + 2]])
        high = (np.flatnonzero(bits)[:size] - np.arange(size)).astype(np.uint64)
        if low:
            lows = np.unpackbits(raw[self.at[2 * b] : self.at[2 * b + 1]])[: size * low].reshape(size, low)
            lows = lows.astype(np.uint64) @ (np.uint64(1) << np.arange(low, dtype=np.uint64))
            return (high << np.uint64(low) | lows) + self.first[b]
        return high + self.first[b]

    def __getitem__(self, i: int) -> int:
        return int(self.block(i // self.BLOCK)[i % self.BLOCK])

    def values(self, i: np.ndarray) -> np.ndarray:
        """The values at i. Each block is read once."""
        out = np.zeros(len(i), np.uint64)
        order = np.argsort(i, kind="stable")
        edge = np.searchsorted(i[order] // self.BLOCK, np.arange(len(self.first) + 1))
        for b in np.flatnonzero(np.diff(edge)):
            at = order[edge[b] : edge[b + 1]]
            out[at] = self.block(b)[i[at] - b * self.BLOCK]
        return out

    def successors(self, x: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """For each x the index of the first value not below it among those at lo, ..., hi - 1; hi if there is none.

        Only blocks that the ranges meet are read, each once.
        """
        x = x.astype(np.uint64)
        out = hi.copy()
        open_ = np.flatnonzero(lo < hi)
        if not len(open_):
            return out
        # the last block of the range that starts below x, and no earlier one than that of lo
        home = np.searchsorted(self.first, x[open_], side="left") - 1
        home = np.clip(home, lo[open_] // self.BLOCK, (hi[open_] - 1) // self.BLOCK)
        order = open_[np.argsort(home, kind="stable")]
        edge = np.searchsorted(np.sort(home), np.arange(len(self.first) + 1))
        for b in np.flatnonzero(np.diff(edge)):
            at = order[edge[b] : edge[b + 1]]
            found = b * self.BLOCK + np.searchsorted(self.block(b), x[at], side="left")
            out[at] = np.clip(found, lo[at], hi[at])
        return out


class Trie:
    """Contexts 0, 1, ... and the sorted successors of each, with codes."""

    def __init__(self, pointers: EliasFano, successors: EliasFano, codes: np.ndarray):
        self.pointers, self.nexts, self.codes = pointers, successors, codes

    @classmethod
    def build(cls, n_contexts: int, context: np.ndarray, word: np.ndarray, codes: np.ndarray) -> "Trie":
        """context, word: sorted by both. The levels are mapped from a file that is unlinked at once."""
        pointers = np.searchsorted(context, np.arange(n_contexts + 1))
        full = np.flatnonzero(np.diff(pointers))
        last = word[pointers[full + 1] - 1].astype(np.uint64) + np.uint64(1)  # of each range, counted from its start
        base = np.zeros(n_contexts, np.uint64)
        base[full] = np.cumsum(last) - last
        a, da = EliasFano.parts(pointers)
        b, db = EliasFano.parts(base[context] + word.astype(np.uint64))
        with tempfile.TemporaryFile() as f:  # has no name from the start
            f.write(da + db + codes.astype("<u2").tobytes() + b"\0")
            f.flush()
            m = memoryview(mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ))
        x, y = len(da), len(da) + len(db)
        return cls(EliasFano(*a, m[:x]), EliasFano(*b, m[x:y]), np.frombuffer(m[y : y + 2 * len(codes)], "<u2"))

    def ranges(self, context: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where the successors of each context lie on level 2, and what they are numbered from."""
        few, back = np.unique(context, return_inverse=True)
        lo, hi = (self.pointers.values(few + i).astype(np.int64) for i in (0, 1))
        base = np.zeros(len(few), np.uint64)
        base[lo > 0] = self.nexts.values(lo[lo > 0] - 1) + np.uint64(1) if (lo > 0).any() else 0
        return lo[back], hi[back], base[back]

    def find(self, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Index of each pair on level 2, or -1: a search in the context's range for the word, counted from its base."""
        lo, hi, base = self.ranges(context)
        x = base + word.astype(np.uint64)
        at = self.nexts.successors(x, lo, hi)
        found = at < hi
        found[found] = self.nexts.values(at[found]) == x[found]
        return np.where(found, at, -1)

    def children(self, context: int) -> np.ndarray:
        (lo,), (hi,), (base,) = self.ranges(np.array([context]))
        return (self.nexts.values(np.arange(lo, hi)) - base).astype(np.int64)


def code(log10_p: np.ndarray) -> np.ndarray:
    return np.clip(np.rint(-np.asarray(log10_p) / _STEP), 0, 65535).astype(np.uint16)


def value(codes: np.ndarray) -> np.ndarray:
    return codes.astype(np.float64) * -_STEP


# -- the passes -----------------------------------------------------------------------------------------------------

_L, _I, _B, _D = T.LongType(), T.IntegerType(), T.BinaryType(), T.DoubleType()


def _struct(**kinds) -> T.StructType:
    return T.StructType([T.StructField(k, v) for k, v in kinds.items()])


def _held_out(key) -> bool:
    return zlib.crc32(("" if key is None else str(key)).encode()) % 10 == 0


def _chunks(batches):
    """(name, keys, tokens of each text, sorted distinct fingerprints, index of each token among them)."""
    keys, sizes, hashes, n = [], [], [], 0

    def close():
        h = np.concatenate(hashes)
        distinct, index = np.unique(h, return_inverse=True)
        name = hashlib.blake2b(h.tobytes() + repr(keys).encode(), digest_size=12).hexdigest()
        return name, list(keys), np.array(sizes, np.int64), distinct, index.astype(np.uint32)

    for b in batches:
        for key, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            raw = np.frombuffer((text or "").encode().lower(), np.uint8)
            h = np.append(span_hashes(raw, *word_spans(raw)), _END)
            keys.append(key)
            sizes.append(len(h))
            hashes.append(h)
            n += len(h)
            if n >= CHUNK:
                yield close()
                keys, sizes, hashes, n = [], [], [], 0
    if n:
        yield close()


def _named(seen: dict, name: str) -> str:
    """Equal chunks of a task get names of their own."""
    seen[name] = seen.get(name, 0) + 1
    from pyspark import TaskContext

    return f"{name}-{TaskContext.get().partitionId()}-{seen[name]}"


def _word_counts(rows: DataFrame, buckets: int) -> DataFrame:
    """Rows of kind 0: sums (a bucket's tokens, words, words seen once and twice); of kind 1: numbers and counts for a chunk."""
    sent = _struct(bucket=_I, chunk=T.StringType(), h=_B, c=_B, other=_B)
    reply = _struct(kind=_I, chunk=T.StringType(), bucket=_I, ids=_B, counts=_B, parts=_B, sums=T.ArrayType(_L))

    def deal(batches):
        seen: dict = {}
        for name, keys, sizes, distinct, index in _chunks(batches):
            learnt = np.repeat(np.array([not _held_out(k) for k in keys]), sizes)
            c = np.bincount(index[learnt], minlength=len(distinct)).astype(np.uint32)
            other = np.bincount(index[~learnt], minlength=len(distinct)).astype(np.uint32)
            to = ((distinct >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
            edge = np.searchsorted(to, np.arange(buckets + 1))
            full = np.flatnonzero(np.diff(edge))
            name = _named(seen, name)
            yield {"bucket": full.astype(np.int32), "chunk": [name] * len(full), "h": [pack(distinct[edge[i] : edge[i + 1]]) for i in full], "c": [pack(c[edge[i] : edge[i + 1]]) for i in full], "other": [pack(other[edge[i] : edge[i + 1]]) for i in full]}

    def count(batches):
        held: dict[int, list] = {}
        for b in batches:
            for bucket, chunk, h, c, other in zip(*(b.column(i).to_pylist() for i in range(5))):
                held.setdefault(bucket, []).append((chunk, unpack(h, np.uint64), unpack(c, np.uint32), unpack(other, np.uint32)))
        for bucket, rows_ in held.items():
            h = np.concatenate([x[1] for x in rows_])
            c = np.concatenate([x[2] for x in rows_]).astype(np.float64)
            distinct, index = np.unique(h, return_inverse=True)
            total = np.bincount(index, c, len(distinct)).astype(np.int64)
            sums = [int(total.sum()), int((total > 0).sum()), int((total == 1).sum()), int((total == 2).sum())]
            every = total + np.bincount(index, np.concatenate([x[3] for x in rows_]), len(distinct)).astype(np.int64)
            parts = np.minimum(every // HOT + 1, 65535).astype(np.uint16)[index]
            yield {"kind": [0], "chunk": [None], "bucket": [bucket], "ids": [None], "counts": [None], "parts": [None], "sums": [sums]}
            at = np.cumsum([0] + [len(x[1]) for x in rows_])
            each = total[index].astype(np.uint64)
            ids = index.astype(np.uint32)
            for i, (chunk, *_) in enumerate(rows_):
                part = slice(at[i], at[i + 1])
                yield {"kind": [1], "chunk": [chunk], "bucket": [bucket], "ids": [pack(ids[part])], "counts": [pack(each[part])], "parts": [pack(parts[part])], "sums": [None]}

    return arrow_fold(arrow_fold(rows, deal, sent).repartition(buckets, "bucket"), count, reply, rows=PACKED_ROWS)


def score(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: held_out, n_tokens, n_known, train_tokens, base_score, score (both log10 of the text's probability)."""
    rows = only(docs, key, text)
    size = int(rows.agg(F.sum(F.octet_length(text))).first()[0] or 0)
    word_buckets, pair_buckets = bucket_count(size, WORD_BUCKET), bucket_count(size, PAIR_BUCKET)
    counted = cut(_word_counts(rows, word_buckets))
    sums = np.array([r.sums for r in counted.filter("kind = 0").select("sums").collect()], np.int64).reshape(-1, 4).sum(0)
    n_train, n_words, once, twice = (int(x) for x in sums)
    discount = once / (once + 2 * twice) if once else 0.5
    unknown = discount * n_words / n_train if n_train else 1.0

    def unigram(c: np.ndarray) -> np.ndarray:
        return np.log10(np.where(c > 0, (c - discount) / max(1, n_train), unknown))

    told = counted.filter("kind = 1").groupBy("chunk").agg(F.sort_array(F.collect_list(F.struct("bucket", "ids", "counts", "parts"))).alias("told"))
    content = _struct(chunk=T.StringType(), keys=T.ArrayType(rows.schema[key].dataType), sizes=T.ArrayType(_I), index=_B)

    def contents(batches):
        seen: dict = {}
        for name, keys, sizes, _, index in _chunks(batches):
            yield {"chunk": [_named(seen, name)], "keys": [keys], "sizes": [sizes], "index": [pack(index)]}

    meta_type = T.ArrayType(_struct(key=rows.schema[key].dataType, held_out=T.BooleanType(), n_tokens=_L, n_known=_L, base_score=_D))
    sent = _struct(bucket=_I, chunk=T.StringType(), context=_B, context_count=_B, run=_B, word=_B, unigram=_B, times=_B, meta=meta_type, at=_B)

    def pairs(batches):
        """For each chunk: its distinct pairs by bucket, and a row with what its texts need later (which pair each token ends)."""
        for b in batches:
            for chunk, keys, sizes, index, told_ in zip(*(b.column(c).to_pylist() for c in ("chunk", "keys", "sizes", "index", "told"))):
                if told_ is None:
                    raise RuntimeError("the input changed between two reads")
                ids = np.concatenate([unpack(x["ids"], np.uint32).astype(np.uint64) | np.uint64(x["bucket"]) << np.uint64(32) for x in told_])
                counts = np.concatenate([unpack(x["counts"], np.uint64) for x in told_]).astype(np.int64)
                parts = np.concatenate([unpack(x["parts"], np.uint16) for x in told_]).astype(np.uint64)
                at = unpack(index, np.uint32).astype(np.int64)
                sizes = np.array(sizes)
                first = np.cumsum(sizes) - sizes
                c = counts[at]
                base = np.log10((c + 0.1) / (n_train + 0.1 * (n_words + 1)))
                held = np.array([_held_out(k) for k in keys])
                meta = [
                    {"key": k, "held_out": bool(o), "n_tokens": int(n), "n_known": int(m), "base_score": float(s)}
                    for k, o, n, m, s in zip(keys, held, sizes, np.add.reduceat((c > 0).astype(np.int64), first), np.add.reduceat(base, first))
                ]
                before = np.empty_like(at)
                before[1:] = at[:-1]
                before[first] = at[-1]  # every text ends with the end
                pair, place = np.unique(before * len(ids) + at, return_inverse=True)
                v, w = pair // len(ids), pair % len(ids)
                times = np.bincount(place[~np.repeat(held, sizes)], minlength=len(pair)).astype(np.uint32)
                # frequent contexts are split by the word that follows
                to = (mix(ids[v] * np.uint64(0x9E3779B97F4A7C15) + mix(ids[w]) % parts[v]) % np.uint64(pair_buckets)).astype(np.int64)
                order = np.argsort(to, kind="stable")
                rank = np.empty(len(order), np.uint32)
                rank[order] = np.arange(len(order), dtype=np.uint32)
                edge = np.searchsorted(to[order], np.arange(pair_buckets + 1))
                u = code(unigram(counts))
                out = {f.name: [] for f in sent}
                for i in np.flatnonzero(np.diff(edge)):
                    o = order[edge[i] : edge[i + 1]]
                    start = np.flatnonzero(np.concatenate(([True], v[o][1:] != v[o][:-1])))
                    heads = v[o][start]
                    run = np.diff(np.append(start, len(o))).astype(np.uint32)
                    row = (int(i), chunk, pack(ids[heads]), pack(counts[heads]), pack(run), pack(ids[w[o]]), pack(u[w[o]]), pack(times[o]), None, None)
                    for name, x in zip(out, row):
                        out[name].append(x)
                home = int(mix(np.array([zlib.crc32(chunk.encode())]))[0] % np.uint64(pair_buckets))
                for name, x in zip(out, (home, chunk, *[None] * 6, meta, pack(rank[place]))):
                    out[name].append(x)
                yield out

    back = _struct(chunk=T.StringType(), bucket=_I, codes=_B, meta=meta_type, at=_B)

    def shard(batches):
        """Builds the shards of the trie of this task's buckets and answers with the code of each pair."""
        held: dict[int, list] = {}
        for b in batches:
            for bucket, chunk, *arrays, meta, at in zip(*(b.column(i).to_pylist() for i in range(10))):
                if meta is not None:
                    yield {"chunk": [chunk], "bucket": [-1], "codes": [None], "meta": [meta], "at": [at]}
                else:
                    held.setdefault(bucket, []).append((chunk, arrays))
        for bucket in list(held):
            mine = held.pop(bucket)
            parts = []
            for _, arrays in mine:
                context, cc, run, word, uni, times = (unpack(x, k) for x, k in zip(arrays, (np.uint64, np.int64, np.uint32, np.uint64, np.uint16, np.uint32)))
                parts.append((np.repeat(context, run), np.repeat(cc, run), word, uni, times))
            edge = np.cumsum([0] + [len(x[2]) for x in parts])
            context, cc, word, uni, times = map(np.concatenate, zip(*parts))
            del parts
            heads, v = np.unique(context, return_inverse=True)
            words, w = np.unique(word, return_inverse=True)
            del context, word
            pair = v * len(words) + w
            learnt = times > 0
            known, place = np.unique(pair[learnt], return_inverse=True)
            c = np.bincount(place, times[learnt], len(known))
            one = np.zeros(len(known), np.int64)
            one[place] = np.flatnonzero(learnt)  # any record of the pair
            p = (c + MU * 10 ** value(uni[one])) / (cc[one] + MU)
            trie = Trie.build(len(heads), known // len(words), known % len(words), code(np.log10(p)))
            at = trie.find(v, w)
            unseen = code(np.log10(MU / (cc + MU)) + value(uni))
            codes = np.where(at >= 0, trie.codes[np.maximum(at, 0)], unseen) if len(known) else unseen
            for i, (chunk, _) in enumerate(mine):
                yield {"chunk": [chunk], "bucket": [bucket], "codes": [pack(codes[edge[i] : edge[i + 1]].astype(np.uint16))], "meta": [None], "at": [None]}

    result = T.StructType([T.StructField(key, rows.schema[key].dataType), *_struct(held_out=T.BooleanType(), n_tokens=_L, n_known=_L, train_tokens=_L, base_score=_D, score=_D)])

    def finish(batches):
        """The rows of a chunk stand together: its own first (bucket -1), then the codes by bucket."""

        def close(meta, at, codes):
            n = np.array([m["n_tokens"] for m in meta])
            logs = value(np.concatenate(codes))[unpack(at, np.uint32)]
            return {key: [m["key"] for m in meta], "train_tokens": [n_train] * len(meta), "score": np.add.reduceat(logs, np.cumsum(n) - n), **{x: [m[x] for m in meta] for x in ("held_out", "n_tokens", "n_known", "base_score")}}

        here, meta, at, codes = None, None, None, []
        for b in batches:
            for chunk, _, z, m, a in zip(*(b.column(i).to_pylist() for i in range(5))):
                if chunk != here:
                    if meta:
                        yield close(meta, at, codes)
                    here, codes = chunk, []
                if m is not None:
                    meta, at = m, a
                else:
                    codes.append(unpack(z, np.uint16))
        if meta:
            yield close(meta, at, codes)

    joined = arrow_fold(rows, contents, content).join(told, "chunk", "left")
    answers = arrow_fold(arrow_fold(joined, pairs, sent, rows=PACKED_ROWS).repartition(pair_buckets, "bucket"), shard, back, rows=PACKED_ROWS)
    return arrow_fold(answers.repartition(word_buckets, "chunk").sortWithinPartitions("chunk", "bucket"), finish, result, rows=PACKED_ROWS)
