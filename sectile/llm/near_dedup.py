"""Near-duplicate documents by Order MinHash, checked by banded alignment.

A text's words (runs outside ASCII white space, A-Z in lower case) give k-mers of five words, each labelled by its
occurrence within the text. For each hash function the sketch takes the three labelled k-mers of smallest hash and keeps
them in text order, so texts must agree in order as well as in content: the sketch follows edit similarity, not
overlap of sets. Texts that share the value of a function (a band) are candidates. Candidates are aligned word by
word within a band of diagonals as wide as the allowed edits. Alike are texts whose edit similarity, 1 - edits / longer
length, reaches 0.93, and texts whose edit similarity reaches 0.8 and that share 0.8 of their runs of five words (Jaccard):
edits in one place leave most runs whole. Both are found by nine pairs of ten and more; pairs with many scattered edits
share few runs, so no sketch of runs finds them, and they are not counted as alike.

Exact copies are merged first, by digest, so a group of copies is one text from there on. A bucket holds texts of one
band value and similar length. A text is compared with the smallest of its buckets' leaders (smallest ids), then with
those that are still of another class. Where classes of a bucket still differ, the bucket is dealt into blocks, and
every two texts of different classes meet in the first bucket they share: each block with itself and with each other one.
No pairs are sent: a block is one packed row, what two blocks give is their links. A pair is aligned only if the words that
each has and the other lacks, counted by a product of bit matrices, are few enough (an edit changes one word on each
side, so no alike pair is lost), and only while its classes are still apart. So a group of like texts of any size costs a
few comparisons for each text; unlike texts of a bucket cost one product of bit rows for each pair. Classes are
connected components, found by alternating large-star and small-star steps, each written to the shared folder.

Words are compared by 32 bits of their hashes once they travel: two different words pass for one in 4 of 10^9 cases, which
can hide an edit but not make texts alike that differ in many words.

Defined results: a null text counts as empty; texts without words are alike only if they are equal; rows with the same
key are one document; a null key has a null class; texts of one to four words are one k-mer; an empty table gives an
empty table. The class id is the smallest key of the class.
"""

from __future__ import annotations

import bisect
import hashlib

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import arrow_fold, arrow_map, bucket_count, cut, ids_and_texts, mix, only, only_last, pack, release, rolled, span_hashes, unpack, unrolled, word_spans

K, BANDS, TAKEN, SIMILARITY = 5, 20, 3, 0.8
#: Edit similarity that is enough by itself.
CLOSE = 0.93
#: Texts of a block, and words of one at most (unless it is a single text); pairs of texts for each task that compares blocks.
BLOCK, BLOCK_WORDS, TASK_PAIRS = 256, 1 << 22, 1 << 19
_C = mix(np.arange(1, 400, dtype=np.uint64))
_ODD = _C | np.uint64(1)
_MAX = np.uint64(0xFFFFFFFFFFFFFFFF)
#: Bytes of text hashed together.
_GROUP = 1 << 21


def hashed_words(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts in a row, and for each text the index of its first word (one more at the end)."""
    raw = [t.encode().lower() for t in texts]
    buf = np.frombuffer(b" ".join(raw), np.uint8)
    starts, ends = word_spans(buf)
    at = np.cumsum([0] + [len(r) + 1 for r in raw])
    return span_hashes(buf, starts, ends), np.searchsorted(starts, at)


def sketch(h: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Band values [texts, BANDS]; a text without words has zeros."""
    n_docs = len(first) - 1
    out = np.zeros((n_docs, BANDS), np.uint64)
    n = np.diff(first)
    n_k = np.where(n >= K, n - K + 1, np.minimum(n, 1))
    if not n_k.sum():
        return out
    doc = np.repeat(np.arange(n_docs), n_k)
    start = np.cumsum(n_k) - n_k
    at = first[doc] + np.arange(len(doc)) - start[doc]
    last = first[doc + 1]
    kmer = np.zeros(len(at), np.uint64)
    for i in range(K):  # short texts end early
        j = at + i
        kmer += np.where(j < last, h[np.minimum(j, len(h) - 1)] * _ODD[i], np.uint64(0))
    kmer = mix(kmer)
    order = np.argsort(mix(kmer ^ _C[doc % 300] ^ doc.astype(np.uint64)), kind="stable")
    ks, ds = kmer[order], doc[order]
    new = np.concatenate(([True], (ks[1:] != ks[:-1]) | (ds[1:] != ds[:-1])))
    run = np.flatnonzero(new)
    occurrence = np.empty(len(at), np.uint64)
    occurrence[order] = (np.arange(len(at)) - np.repeat(run, np.diff(np.append(run, len(at))))).astype(np.uint64)
    label = mix(kmer + occurrence * _ODD[10])
    has = np.flatnonzero(n_k)
    begin = start[has]
    sizes = n_k[has]
    row = np.repeat(np.arange(len(has)), sizes)
    none = len(label)
    for b in range(BANDS):
        v = (label ^ _C[20 + b]) * _ODD[120 + b]
        v ^= v >> np.uint64(32)
        places = np.full((TAKEN, len(has)), none)
        for t in range(TAKEN):
            low = np.minimum.reduceat(v, begin)
            hit = np.flatnonzero(v == low[row])
            p = hit[np.searchsorted(hit, begin)]
            places[t] = np.where(sizes > t, p, none)
            v[p] = _MAX
        value = np.zeros(len(has), np.uint64)
        for t, at_ in enumerate(np.sort(places, axis=0)):  # in text order
            value = mix(value + np.where(at_ < none, label[np.minimum(at_, none - 1)] * _ODD[1 + t], np.uint64(0)) + np.uint64(1))
        out[has, b] = value
    return out


def edits_within(a: np.ndarray, b: np.ndarray, k: int) -> int | None:
    """Edit distance of two sequences if at most k. Bit vectors hold the 2 k + 1 diagonals around the main one."""
    if len(a) < len(b):
        a, b = b, a
    if len(a) - len(b) > k:
        return None
    same = a[: len(b)] == b
    head = len(b) if same.all() else int(np.argmin(same))
    a, b = a[head:], b[head:]
    if len(b):
        same = a[len(a) - len(b) :][::-1] == b[::-1]
        tail = len(b) if same.all() else int(np.argmin(same))
        a, b = a[: len(a) - tail], b[: len(b) - tail]
    if not len(b):
        return len(a)
    both, n_a = np.unique(np.concatenate((a, b)), return_inverse=True)
    bag = np.bincount(n_a[: len(a)], minlength=len(both)) - np.bincount(n_a[len(a) :], minlength=len(both))
    if max(bag[bag > 0].sum(), -bag[bag < 0].sum()) > k:
        return None
    k = max(1, min(k, len(a)))
    x, y = n_a[: len(a)].tolist(), n_a[len(a) :].tolist()
    for narrow in (k >> 6, k >> 3):  # long texts mostly have few edits
        if narrow >= 256 and (found := _banded(x, y, narrow)) is not None:
            return found
    return _banded(x, y, k)


def _banded(a: list[int], b: list[int], k: int) -> int | None:
    """Edit distance of a and b (not longer) if at most k."""
    if len(a) - len(b) > k:
        return None
    # where a word of a stands, as bits: row i + 1 is bit k of column i + 1
    if len(a) <= 1 << 12:
        bits: dict[int, int] = {}
        for i, w in enumerate(a):
            bits[w] = bits.get(w, 0) | 1 << (i + k)

        def matches(w: int, j: int) -> int:
            return bits.get(w, 0) >> j
    else:  # the rows of the band only
        places: dict[int, list[int]] = {}
        for i, w in enumerate(a):
            places.setdefault(w, []).append(i)

        def matches(w: int, j: int) -> int:
            at, out = places.get(w, ()), 0
            for i in at[bisect.bisect_left(at, j - k) : bisect.bisect_right(at, j + k)]:
                out |= 1 << (i + k - j)
            return out

    mask, top, score = (1 << 2 * k + 1) - 1, 1 << 2 * k, 0
    plus = mask >> (k + 1) << (k + 1)
    minus = mask ^ plus
    for j, w in enumerate(b):
        plus, minus = plus >> 1 | top, minus >> 1
        match = matches(w, j) & mask
        flat = ((match & plus) + plus ^ plus | match | minus) & mask
        right = (minus | ~(flat | plus)) << 1 & mask | 1
        left = (flat & plus) << 1 & mask
        plus, minus = (left | ~(flat | right)) & mask, right & flat
        score += not flat >> k & 1
    below = (1 << len(a) - len(b)) - 1 << k + 1
    score += (plus & below).bit_count() - (minus & below).bit_count()
    return score if score <= k else None


def runs(words: np.ndarray) -> np.ndarray:
    """Hashes of the different runs of K words; a shorter text is one run."""
    n = max(1, len(words) - K + 1)
    out = np.zeros(n, np.uint64)
    for i in range(min(K, len(words))):
        out = mix(out ^ words[i : i + n].astype(np.uint64) + _ODD[i])
    return np.unique(out)


def alike(a: np.ndarray, b: np.ndarray) -> bool:
    longer = max(len(a), len(b))
    if not longer:
        return False
    if edits_within(a, b, int((1 - CLOSE) * longer + 1e-9)) is not None:
        return True
    x, y = runs(a), runs(b)
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both >= SIMILARITY * (len(x) + len(y) - both) - 1e-9 and edits_within(a, b, int((1 - SIMILARITY) * longer + 1e-9)) is not None


def _sketches(docs: DataFrame, key: str, text: str) -> DataFrame:
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("digest", T.BinaryType()), T.StructField("n", T.IntegerType()), T.StructField("bands", T.ArrayType(T.LongType())), T.StructField("words", T.BinaryType())])

    def run(b):
        ids, texts = ids_and_texts(b, key, text)
        i = 0
        while i < len(ids):
            j, size = i, 0
            while j < len(ids) and (j == i or size + len(texts[j]) < _GROUP):
                size += len(texts[j])
                j += 1
            part = texts[i:j]
            h, first = hashed_words(part)
            values = sketch(h, first)
            n = np.diff(first)
            short = h.astype(np.uint32)
            yield {
                "id": ids[i:j],
                "digest": [hashlib.blake2b(t.encode(), digest_size=16).digest() for t in part],
                "n": n.astype(np.int32),
                "bands": [v.view(np.int64) if m else [] for v, m in zip(values, n)],
                "words": [pack(short[first[x] : first[x + 1]]) if n[x] else b"" for x in range(len(part))],
            }
            i = j

    return arrow_map(docs.select(key, text), run, schema)


def _verified(pairs: DataFrame, words: DataFrame) -> DataFrame:
    """The pairs (a, b) whose texts are alike."""
    left = words.select(F.col("id").alias("a"), F.col("words").alias("wa"))
    right = words.select(F.col("id").alias("b"), F.col("words").alias("wb"))

    def run(batch):
        a, b = batch.column("a").to_pylist(), batch.column("b").to_pylist()
        ok = [alike(unpack(x, np.uint32), unpack(y, np.uint32)) for x, y in zip(batch.column("wa").to_pylist(), batch.column("wb").to_pylist())]
        yield {"a": [x for x, o in zip(a, ok) if o], "b": [x for x, o in zip(b, ok) if o]}

    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "wa", "wb")
    return arrow_map(joined, run, _LINK)


_L, _I, _B = T.LongType(), T.IntegerType(), T.BinaryType()
_LINK = T.StructType([T.StructField("a", _L), T.StructField("b", _L)])
_BLOCK = T.StructType([*_LINK, T.StructField("band", _I), T.StructField("value", _L), T.StructField("size", _L), T.StructField("blk", T.StringType()), T.StructField("whole", _L), *(T.StructField(x, _B) for x in ("ids", "cs", "ns", "bands", "words"))])


def _cells(n: str | Column) -> Column:
    """Length class of a text of n words: alike texts are of one class or of neighbouring ones."""
    return F.floor(F.log(F.greatest(n, F.lit(1)).cast("double")) / -F.log(F.lit(SIMILARITY)))


class Block:
    """Texts of a bucket: ids, classes, numbers of words, band values and word hashes, one text after the other."""

    def __init__(self, ids: np.ndarray, cs: np.ndarray, ns: np.ndarray, bands: np.ndarray, words: np.ndarray):
        self.ids, self.cs, self.ns, self.bands, self.words = ids, cs, ns, bands.reshape(-1, BANDS), words
        self.at = np.concatenate(([0], np.cumsum(ns)))

    @classmethod
    def read(cls, *packed: bytes) -> "Block":
        return cls(*(unpack(x, k) for x, k in zip(packed, (np.int64, np.int64, np.int32, np.int64, np.uint32))))

    def packed(self) -> list[bytes]:
        return [pack(x) for x in (self.ids, self.cs, self.ns, self.bands, self.words)]

    def text(self, i: int) -> np.ndarray:
        return self.words[self.at[i] : self.at[i + 1]]

    def bits(self, width: int) -> np.ndarray:
        out = np.zeros((len(self.ids), width), np.float32)
        out[np.repeat(np.arange(len(self.ids)), self.ns), self.words & np.uint32(width - 1)] = 1
        return out

    def run_bits(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Bits of the runs of each text, and how many different runs it has."""
        each = [runs(self.text(i)) for i in range(len(self.ids))]
        n = np.array([len(r) for r in each])
        out = np.zeros((len(self.ids), width), np.float32)
        out[np.repeat(np.arange(len(self.ids)), n), np.concatenate(each) & np.uint64(width - 1)] = 1
        return out, n


def links_between(x: Block, y: Block, band: int, size: int) -> list[tuple[int, int]]:
    """Links that connect the classes of two blocks (x may be y) of the bucket as far as their alike pairs do.

    Pairs that share an earlier bucket have met there.
    """
    width = 1 << min(15, max(8, int(np.ceil(2 - size * np.log2(SIMILARITY)))))
    p = x.bits(width)
    q = p if y is x else y.bits(width)
    longer = np.maximum(x.ns[:, None], y.ns)
    edits = np.maximum(p.sum(1)[:, None], q.sum(1)) - p @ q.T  # at least
    ok = (np.maximum(edits, np.abs(x.ns[:, None] - y.ns)) <= (1 - SIMILARITY) * longer + 1e-9) & (x.cs[:, None] != y.cs)
    far = ok & (edits > (1 - CLOSE) * longer + 1e-9)
    if far.any():  # these must share runs; a bit that the other lacks is a run that it lacks
        (p, n), (q, m) = (u := x.run_bits(width)), (u if y is x else y.run_bits(width))
        meet = p @ q.T
        both = np.minimum(n[:, None] - p.sum(1)[:, None] + meet, m - q.sum(1) + meet)  # at most
        ok &= ~far | (both >= SIMILARITY * (n[:, None] + m - both) - 1e-9)
    i, j = np.nonzero(np.triu(ok, 1) if y is x else ok)
    cell = [np.floor(np.log(np.maximum(b.ns, 1)) / -np.log(SIMILARITY)) for b in (x, y)]
    here = (np.maximum(cell[0][i], cell[1][j]) >= size) & ~(x.bands[i, :band] == y.bands[j, :band]).any(1)
    up: dict[int, int] = {}

    def top(c: int) -> int:
        while c in up:
            c = up[c]
        return c

    out = []
    for m, n in zip(i[here].tolist(), j[here].tolist()):
        a, b = top(int(x.cs[m])), top(int(y.cs[n]))
        if a != b and alike(x.text(m), y.text(n)):
            up[max(a, b)] = min(a, b)
            out.append((int(x.ids[m]), int(y.ids[n])))
    return out


def _met(entries: DataFrame, words: DataFrame) -> DataFrame:
    """Links (a, b) between the classes of each bucket. entries: (id, n, band, value, size, c)."""
    bucket = ["band", "value", "size"]
    per_class = entries.groupBy(*bucket, "c").agg(F.count(F.lit(1)).alias("_c"))
    mixed = cut(per_class.groupBy(*bucket).agg(F.count(F.lit(1)).alias("_k"), F.sum("_c").alias("_m")).filter("_k > 1"))
    pairs = mixed.agg(F.sum(F.col("_m") * F.col("_m"))).first()[0]
    if not pairs:
        return entries.sparkSession.createDataFrame([], _LINK)
    tasks = bucket_count(pairs, TASK_PAIRS)
    block = F.greatest(F.lit(1.0), F.least(F.lit(float(BLOCK)), F.floor(F.lit(float(BLOCK_WORDS)) * F.pow(F.lit(SIMILARITY), "size"))))
    big = F.col("_c") > F.col("_b")  # a class that fills blocks of its own: they needn't meet
    part = F.pmod(F.xxhash64(F.when(big, F.col("id")).otherwise(F.col("c"))), F.ceil(F.when(big, F.col("_c")).otherwise(F.col("_m")) / F.col("_b")))
    dealt = entries.join(per_class.join(mixed, bucket).withColumn("_b", block), [*bucket, "c"])
    dealt = dealt.withColumns({"whole": F.when(big, F.col("c")), "blk": F.concat_ws("/", F.when(big, F.col("c")).cast("string"), part.cast("string")), "alone": F.col("_m") <= F.col("_b")})
    dealt = dealt.select("id", "n", *bucket, "c", "whole", "blk", "alone").join(words, "id")
    order = [*bucket, "blk"]
    names = (*order, "whole", "alone", "id", "c", "n", "bands", "words")

    def build(batches):
        def close(at, whole, alone, rows):
            ids, cs, ns, bands, texts = zip(*rows)
            b = Block(np.array(ids, np.int64), np.array(cs, np.int64), np.array(ns, np.int32), np.array(bands, np.int64), np.concatenate([unpack(t, np.uint32) for t in texts]))
            links = links_between(b, b, at[0], at[2]) if whole is None else []
            none = dict.fromkeys(_BLOCK.names)
            if links:
                yield {k: [None] * len(links) for k in none} | {"a": [a for a, _ in links], "b": [b for _, b in links]}
            if not alone:
                yield {k: [v] for k, v in (none | dict(zip(_BLOCK.names[2:], (*at, whole, *b.packed())))).items()}

        at, whole, alone, rows = None, None, True, []
        for b in batches:
            for *key, w, only_one, i, c, n, v, t in zip(*(b.column(x).to_pylist() for x in names)):
                if key != at:
                    if rows:
                        yield from close(at, whole, alone, rows)
                    at, whole, alone, rows = key, w, only_one, []
                rows.append((i, c, n, v, t))
        if rows:
            yield from close(at, whole, alone, rows)

    built = cut(arrow_fold(dealt.repartition(tasks, *order).sortWithinPartitions(*order).select(*names), build, _BLOCK))
    blocks = built.filter("a IS NULL").drop("a", "b")
    keys = blocks.select(*bucket, "blk", "whole")
    two = keys.join(keys.select(*bucket, F.col("blk").alias("other"), F.col("whole").alias("_w")), bucket).filter("blk < other AND coalesce(whole <> _w, true)").select(*order, "other")
    data = ["ids", "cs", "ns", "bands", "words"]
    left = two.join(blocks.select(*order, *data), order)
    both = left.join(blocks.select(*bucket, F.col("blk").alias("other"), *(F.col(x).alias("o_" + x) for x in data)), [*bucket, "other"])

    def cross(batches):
        for b in batches:
            for band, size, *packed in zip(*(b.column(x).to_pylist() for x in ("band", "size", *data, *("o_" + x for x in data)))):
                links = links_between(Block.read(*packed[: len(data)]), Block.read(*packed[len(data) :]), band, size)
                if links:
                    yield {"a": [a for a, _ in links], "b": [b for _, b in links]}

    across = arrow_fold(both.repartition(tasks, *order, "other"), cross, _LINK)
    return built.filter("a IS NOT NULL").select("a", "b").unionByName(across).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))


def components(edges: DataFrame) -> DataFrame:
    """(id, class_id) for each end of an edge (a, b): the smallest id that is connected to it."""

    def state(e: DataFrame) -> tuple:
        r = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        return r[0], r[1]

    def star(e: DataFrame, large: bool) -> DataFrame:
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        if not large:
            both = both.filter("a > b")
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        moved = both.filter("b > a") if large else both
        out = moved.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        if not large:
            out = out.unionByName(low.select("a", F.col("m").alias("b")))
        return out.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()

    e = cut(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = state(e)
    while before[0]:
        e = cut(star(star(e, True), False))
        after = state(e)
        if after == before:
            break
        before = after
    return e.select(F.col("a").alias("id"), F.col("b").alias("class_id")).unionByName(e.select(F.col("b").alias("id"), F.col("b").alias("class_id")).distinct())


def classes(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, class_id, kept) for each document; kept is true for the smallest key of a class."""
    return only_last(lambda: _classes(only(docs, key, text), key, text))


def _classes(docs: DataFrame, key: str, text: str) -> DataFrame:
    sk = cut(_sketches(docs.filter(F.col(key).isNotNull()).select(F.col(key).cast("long").alias(key), text), key, text))
    first = cut(sk.groupBy("digest").agg(F.min("id").alias("rep")))  # on its own, so that a join with it can be split where copies are many
    member = cut(sk.select("id", "digest").join(first, "digest").select("id", "rep"))  # id -> the smallest id of its copies
    texts = sk.join(first.select(F.col("rep").alias("id"), "digest"), ["id", "digest"]).dropDuplicates(["id", "digest"])
    bands = cut(texts.select("id", "n", F.posexplode("bands").alias("band", "value")))
    # a table of its own, so that the joins of pairs with it can be split where a leader has many texts
    words = cut(sk.select("id", "words", "bands").join(member.filter("id = rep").select("id"), "id", "left_semi").dropDuplicates(["id"]))
    release(sk, first)  # the large tables go as soon as nothing reads them
    # buckets are (band, value, length class): lengths that may be alike share a class, others mostly don't meet
    key_ = ["band", "value", "size"]
    several = bands.groupBy("band", "value").agg(F.count(F.lit(1)).alias("_c")).filter("_c > 1").select("band", "value")
    cell = _cells("n")
    cells = cut(bands.join(several, ["band", "value"]).withColumn("size", F.explode(F.array(cell, cell + 1))))
    leader = cells.groupBy(*key_).agg(F.min(F.struct("id", "n")).alias("leader"), F.count(F.lit(1)).alias("_c")).filter("_c > 1")
    shared = cut(cells.join(leader, key_).select("id", "n", *key_, F.col("leader.id").alias("l"), F.col("leader.n").alias("ln")))
    release(bands, cells)

    def close(n: str, m: str) -> F.Column:
        return F.least(n, m) >= SIMILARITY * F.greatest(n, m) - 1e-9

    def pairs(df: DataFrame, one: str, other: str) -> DataFrame:
        return df.select(F.greatest(one, other).alias("a"), F.least(one, other).alias("b")).distinct()

    def classed(df: DataFrame, column: str, to: str) -> DataFrame:
        return df.join(found.select(F.col("id").alias(column), F.col("class_id").alias(to)), column, "left").withColumn(to, F.coalesce(to, column))

    def merged(new: DataFrame) -> DataFrame:
        """The classes after the links `new`: only classes are connected, not texts."""
        ends = classed(classed(new, "a", "_x"), "b", "_y").filter("_x <> _y").select(F.col("_x").alias("a"), F.col("_y").alias("b"))
        up = components(ends).select(F.col("id").alias("class_id"), F.col("class_id").alias("_up"))
        whole = found.unionByName(up.select(F.col("class_id").alias("id"), "class_id")).dropDuplicates(["id"])
        return cut(whole.join(up, "class_id", "left").select("id", F.coalesce("_up", "class_id").alias("class_id")))

    # a text's own leaders: the smallest first, then those of other classes
    led = shared.filter((F.col("id") != F.col("l")) & close("n", "ln"))
    twice = member.groupBy("id").agg(F.max("rep").alias("a"), F.min("rep").alias("b")).filter("a <> b").select("a", "b")  # one id, two texts
    first_links = _verified(led.groupBy("id").agg(F.min("l").alias("l")).select(F.col("id").alias("a"), F.col("l").alias("b")), words)
    found = cut(components(first_links.unionByName(twice)))
    found = merged(_verified(pairs(classed(classed(led.select("id", "l").distinct(), "id", "c"), "l", "d").filter("c <> d"), "id", "l"), words))
    # in buckets in which classes still differ, every two texts of different classes (the leader has met all)
    mine = cut(classed(shared.filter("id <> l").select("id", "n", *key_), "id", "c"))
    found = merged(_met(mine, words))
    final = member.withColumnRenamed("id", "_id").withColumnRenamed("rep", "id").join(found, "id", "left").select(F.col("_id").alias("id"), F.coalesce("class_id", "id").alias("class_id")).distinct()
    out = docs.select(key).distinct().withColumn("id", F.col(key).cast("long")).join(final, "id", "left")
    out = out.select(key, "class_id")
    return out.withColumn("kept", F.coalesce(F.col("class_id") == F.col(key), F.lit(True)))


def keep(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each class, with the columns of docs; of rows with one key the first text stays."""
    row = rolled(docs, k=key, t=text)
    gone = cut(classes(docs, key, text).filter("NOT kept").select(F.col(key).alias("k")))
    once = F.row_number().over(W.partitionBy("k").orderBy("t"))
    stays = row.join(gone, "k", "left_anti").withColumn("nth", F.when(F.col("k").isNull(), 1).otherwise(once))
    return unrolled(stays.filter("nth = 1"), docs)
