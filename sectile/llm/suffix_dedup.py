"""Removal of passages that repeat across documents, by range-partitioned suffixes.

A byte goes if a string of 50 bytes around it also starts in a document of smaller id. To sort every suffix of the
corpus would take many times its size, so only suffixes at anchors are sorted: each string of 50 bytes has one anchor,
the position of its smallest 16-byte hash (the first of equals), which depends on nothing but the string; equal strings
have equal anchors, so no match is lost. The steps:

1. Anchors are gathered by hash (48 bits, packed arrays); an anchor goes on only if two texts have it. What a task
   finds twice in its own texts it sends once.
2. Each remaining anchor's suffix, with the bytes around it, goes to the bucket of its 16 leading bytes (all that equal
   strings are sure to share); the splitters are quantiles of the different leads among the remaining anchors of a sample
   (about 2,000 documents; it shapes the balance, not the result). A task sorts what it has and sends a string only from
   its smallest document. Strings of leads that many sampled documents have are held back while the task goes on, so a
   string that a third of all documents hold reaches its bucket once for each task.
3. A bucket sorts its strings by multikey quicksort with 8-byte characters: within a run of strings that agree so
   far, only runs with different next characters are sorted again. The smallest document of a run of equal strings keeps
   it. Equal strings have equal leading bytes, so runs never cross the boundary of two buckets; runs that cross the
   boundary of two tasks are compared in the bucket.

Exact copies are merged by digest before step 2: a copy of a smaller document goes wholly, from 50 bytes on.

Defined results: a null text counts as empty; a document with a null id is left alone and takes nothing from others;
repeated rows (same id) take nothing from each other; two texts under one id are told apart by 64 bits of a digest; a
very long text is cut into slabs that overlap; extra columns, clashing ones too, come back as they are; an empty table
gives an empty table.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import arrow_fold, arrow_map, bucket_count, cut, int_lists, mix, only, only_last, pack, place, rolled, squeeze, unpack, unrolled, unsqueeze

LENGTH, GRAM = 50, 16
WINDOW = LENGTH - GRAM + 1
#: Text bytes whose anchors are found at once; anchors and suffixes that a task holds before it sends; text bytes for each bucket.
SLAB, HELD_ANCHORS, HELD_SUFFIXES, BUCKET = 1 << 20, 800_000, 30_000, 10 << 20
#: Bytes kept around an anchor: before it, and from it on.
BEFORE = LENGTH - GRAM
WIDTH = BEFORE + LENGTH
#: Documents of the sample for the splitters, about, and leads of one of them at most; documents of it that make a lead hot.
SAMPLE, SAMPLE_LEADS, HOT = 2000, 64, 40
_MANY = np.iinfo(np.int64).min
_BYTE = (mix(np.arange(1, 257, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32)
_MULT = 0x9E3779B1


def _ordered_hashes(buf: np.ndarray) -> np.ndarray:
    """For each position of a 16-byte string: its 32-bit hash above, the position below."""
    x = _BYTE[buf]
    size, c = 1, _MULT
    while size < GRAM:
        x = x[:-size] * np.uint32(c) + x[size:]
        size, c = 2 * size, c * c & 0xFFFFFFFF
    x ^= x >> np.uint32(15)
    x *= np.uint32(0x85EBCA6B)
    x ^= x >> np.uint32(13)
    return x.astype(np.uint64) << np.uint64(32) | np.arange(len(x), dtype=np.uint64)


def _runs_of(buf: np.ndarray, valid: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchors in a slab, and the first and last start of the strings that have them. valid: of the starts."""
    m = _ordered_hashes(buf)
    size = 1
    while 2 * size <= WINDOW:
        m = np.minimum(m[:-size], m[size:])
        size *= 2
    m = np.minimum(m[: len(m) - (WINDOW - size)], m[WINDOW - size :])
    s = np.flatnonzero(valid[: len(m)])
    if not len(s):
        return s, s, s
    a = (m[s] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    new = np.flatnonzero((a[1:] != a[:-1]) | (s[1:] != s[:-1] + 1)) + 1
    lo = np.concatenate(([0], new))
    hi = np.concatenate((new, [len(s)])) - 1
    return a[lo], s[lo], s[hi]


def anchors(texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """(index of the text, anchor, first start, last start), positions within the text, in order of the texts.

    A long text is cut into slabs that overlap; a run of starts that crosses a cut comes in two pieces.
    """
    found, part, base, at = [], [], [], 0

    def flush():
        nonlocal part, base, at
        if part:
            buf = np.frombuffer(b"".join(p for _, _, p in part), np.uint8)
            if len(buf) >= LENGTH:
                valid = np.ones(len(buf), bool)
                for b, (_, _, p) in zip(base, part):
                    valid[b + max(0, len(p) - LENGTH + 1) : b + len(p)] = False
                p, lo, hi = _runs_of(buf, valid)
                k = np.searchsorted(np.array(base), p, side="right") - 1
                shift = np.array(base)[k] - np.array([s for _, s, _ in part])[k]
                found.append((np.array([i for i, _, _ in part])[k], p - shift, lo - shift, hi - shift))
        part, base, at = [], [], 0

    for i, t in enumerate(texts):
        for s in range(0, max(1, len(t) - LENGTH + 1), SLAB):
            piece = t[s : s + SLAB + LENGTH - 1]
            if len(piece) < LENGTH:
                continue
            if at + len(piece) > SLAB:
                flush()
            part.append((i, s, piece))
            base.append(at)
            at += len(piece)
    flush()
    if not found:
        return (np.zeros(0, np.int64),) * 4
    return tuple(np.concatenate(x) for x in zip(*found))


def _words_at(buf: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The 8 bytes from each position, big-endian."""
    view = np.ndarray((len(buf) - 7,), ">u8", buf, 0, (1,))
    return view[at].astype(np.uint64)


def _first_of(sorted_keys: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.concatenate(([True], sorted_keys[1:] != sorted_keys[:-1]))) if len(sorted_keys) else np.zeros(0, np.int64)


def dominated(buf: np.ndarray, at: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """For each string of 50 bytes at buf[at]: does a smaller document have an equal one? By multikey quicksort."""
    out = np.zeros(len(at), bool)
    if len(at) < 2:
        return out
    word = _words_at(buf, at)
    order = np.argsort(word)
    word = word[order]
    new = np.concatenate(([True], word[1:] != word[:-1]))
    for depth in (8, 16, 24, 32, 40, LENGTH - 8, None):
        start = np.flatnonzero(new)
        size = np.diff(np.append(start, len(new)))
        if not (size > 1).any():
            return out
        if not (size > 1).all():  # strings that stand alone are in place
            more = np.repeat(size > 1, size)
            order, new = order[more], new[more]
            start = np.flatnonzero(new)
            size = np.diff(np.append(start, len(new)))
        run = np.repeat(np.arange(len(start)), size)
        if depth is None:
            least = np.minimum.reduceat(doc[order], start)
            out[order] = doc[order] > least[run]
            return out
        word = _words_at(buf, at[order] + depth)
        uneven = np.logical_or.reduceat(word != word[start][run], start)
        if uneven.any():
            where = np.flatnonzero(uneven[run])
            again = where[np.lexsort((word[where], run[where]))]
            order[where], word[where] = order[again], word[again]
            new[1:] |= word[1:] != word[:-1]
    return out


class Suffixes:
    """Suffixes at anchors: bytes around them and where they come from."""

    def __init__(self, around: np.ndarray, doc: np.ndarray, mark: np.ndarray, p: np.ndarray, lo: np.ndarray, hi: np.ndarray):
        self.around, self.doc, self.mark, self.p, self.lo, self.hi = around, doc, mark, p, lo, hi

    @staticmethod
    def joined(parts: list["Suffixes"]) -> "Suffixes":
        return Suffixes(*(np.concatenate([getattr(x, n) for x in parts]) for n in ("around", "doc", "mark", "p", "lo", "hi")))

    def take(self, i: np.ndarray) -> "Suffixes":
        return Suffixes(*(getattr(self, n)[i] for n in ("around", "doc", "mark", "p", "lo", "hi")))

    def lead(self) -> np.ndarray:
        return _leads(self.around.reshape(-1), np.arange(len(self.p)) * WIDTH + BEFORE)

    def judged(self) -> tuple[np.ndarray, tuple]:
        """Rows with a string that no smaller document here has; documents, marks, first and last starts of the strings that go."""
        n = (self.hi - self.lo + 1).astype(np.int64)
        row = np.repeat(np.arange(len(n)), n)
        start = self.lo.astype(np.int64)[row] + np.arange(len(row)) - (np.cumsum(n) - n)[row]
        gone = dominated(self.around.reshape(-1), row * WIDTH + BEFORE + start - self.p[row], self.doc[row])
        stays = np.unique(row[~gone])
        r, s = row[gone], start[gone]
        new = _first_of_runs(r, s)
        last = np.append(new[1:], len(r)) - 1 if len(r) else new
        return stays, (self.doc[r[new]], self.mark[r[new]], s[new].astype(np.int32), s[last].astype(np.int32))


def _first_of_runs(row: np.ndarray, s: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.concatenate(([True], (row[1:] != row[:-1]) | (s[1:] != s[:-1] + 1)))) if len(row) else np.zeros(0, np.int64)


def by_document(doc: np.ndarray, mark: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> dict:
    o = np.lexsort((lo, mark, doc))
    doc, mark, lo, hi = doc[o], mark[o], lo[o], hi[o]
    first = np.flatnonzero(np.concatenate(([True], (doc[1:] != doc[:-1]) | (mark[1:] != mark[:-1])))) if len(doc) else np.zeros(0, np.int64)
    return {"id": doc[first], "mark": mark[first], "lo": int_lists(lo, first), "hi": int_lists(hi, first)}


def around(text: bytes, p: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """The bytes around each anchor that its strings need; zeros elsewhere."""
    padded = np.zeros(len(text) + WIDTH, np.uint8)
    padded[BEFORE : BEFORE + len(text)] = np.frombuffer(text, np.uint8)
    at = np.arange(WIDTH)
    needed = (at >= (lo - p + BEFORE)[:, None]) & (at < (hi - p + WIDTH)[:, None])
    return padded[p[:, None] + at] * needed


_L, _I, _B = T.LongType(), T.IntegerType(), T.BinaryType()
_PACKED = T.StructType([T.StructField("id", _L), T.StructField("mark", _L), T.StructField("z", _B)])
_SENT = T.StructType([T.StructField("bucket", _I), T.StructField("direct", T.BooleanType()), T.StructField("h", _B), T.StructField("doc", _B), T.StructField("pos", _B)])
_FOUND = T.StructType([T.StructField("id", _L), T.StructField("pos", T.ArrayType(_I))])
_TO = T.StructType([T.StructField("to", _I), *(T.StructField(x, _B) for x in ("doc", "mark", "lo", "hi"))])
_RUNS = T.StructType([T.StructField("id", _L), T.StructField("mark", _L), T.StructField("lo", T.ArrayType(_I)), T.StructField("hi", T.ArrayType(_I))])
_MOVED = T.StructType([T.StructField("bucket", _I), T.StructField("n", _I), T.StructField("around", _B), *(T.StructField(x, _B) for x in ("doc", "mark", "p", "lo", "hi"))])


def _dealt(buckets: int, doc: np.ndarray, *columns: np.ndarray) -> tuple[list[int], list[list[bytes]]]:
    """Buckets of documents, and for each the packed columns of its rows: few rows, whatever the number of documents."""
    to = (mix(doc.view(np.uint64)) % np.uint64(buckets)).astype(np.int64)
    o = np.lexsort((columns[0], doc, to))
    edge = np.searchsorted(to[o], np.arange(buckets + 1))
    full = np.flatnonzero(np.diff(edge))
    return full.tolist(), [[pack(c[o[edge[i] : edge[i + 1]]]) for i in full] for c in (doc, *columns)]


def _mark(text: bytes) -> int:
    """Tells different texts under one id apart."""
    return int.from_bytes(hashlib.blake2b(text, digest_size=8).digest(), "little", signed=True)


def _leads(buf: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The GRAM bytes from each position, ordered as bytes."""
    return buf[at[:, None] + np.arange(GRAM)].view(f"S{GRAM}").reshape(-1)


def _rows(b: pa.RecordBatch) -> tuple[list[int], list[bytes]]:
    return b.column(0).to_pylist(), [(x or "").encode() for x in b.column(1).to_pylist()]


def _squeezed(rows: DataFrame) -> DataFrame:
    """(id, mark of the text, compressed text)"""

    def run(b):
        ids, texts = _rows(b)
        yield {"id": ids, "mark": [_mark(t) for t in texts], "z": [squeeze(t) for t in texts]}

    return arrow_map(rows, run, _PACKED)


def _shared_anchors(rows: DataFrame, buckets: int) -> DataFrame:
    """(id, anchors of the text whose 16 bytes another text has too)."""

    def packed(h, doc, pos):
        o = np.argsort(h)
        h, doc, pos = h[o], doc[o], pos[o]
        first = _first_of(h)
        size = np.diff(np.append(first, len(h)))
        many = np.repeat(np.minimum.reduceat(doc, first) != np.maximum.reduceat(doc, first), size)
        to, (there, at) = _dealt(buckets, doc[many], pos[many])
        yield {"bucket": to, "direct": [True] * len(to), "h": [b""] * len(to), "doc": there, "pos": at}
        once = first[many[first]]  # one row stands for all of them
        doc = doc.copy()
        doc[once] = _MANY
        stay = ~many
        stay[once] = True
        h, doc, pos = h[stay], doc[stay], pos[stay]
        to = (h * np.uint64(buckets) >> np.uint64(48)).astype(np.int64)
        edge = np.searchsorted(to, np.arange(buckets + 1))
        full = np.flatnonzero(np.diff(edge))
        small = h.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]
        yield {
            "bucket": full.astype(np.int32),
            "direct": [False] * len(full),
            "h": [pack(np.ascontiguousarray(small[edge[i] : edge[i + 1]]).view("V6").reshape(-1)) for i in full],
            "doc": [pack(doc[edge[i] : edge[i + 1]]) for i in full],
            "pos": [pack(pos[edge[i] : edge[i + 1]]) for i in full],
        }

    def gather(batches):
        held, n = [], 0
        for b in batches:
            ids, texts = _rows(b)
            k, p, _, _ = anchors(texts)
            if len(k):
                buf = np.frombuffer(b"".join(texts), np.uint8)
                at = np.cumsum([0] + [len(t) for t in texts])[k] + p
                h = mix(mix(_words_at(buf, at)) + _words_at(buf, at + 8)) >> np.uint64(16)
                doc, pos = np.array(ids, np.int64)[k], p.astype(np.int32)
                same = np.lexsort((pos, doc))  # a run cut in two has its anchor twice
                fresh = np.concatenate(([True], (pos[same][1:] != pos[same][:-1]) | (doc[same][1:] != doc[same][:-1])))
                o = same[fresh]
                held.append((h[o], doc[o], pos[o]))
                n += len(o)
            if n >= HELD_ANCHORS:
                yield from packed(*map(np.concatenate, zip(*held)))
                held, n = [], 0
        if n:
            yield from packed(*map(np.concatenate, zip(*held)))

    def match(batches):
        held = []
        for b in batches:
            for bucket, direct, h, doc, pos in zip(*(b.column(i).to_pylist() for i in range(5))):
                if direct:
                    yield {"to": [bucket], "doc": [doc], "mark": [None], "lo": [pos], "hi": [None]}
                else:
                    doc, pos = unpack(doc, np.int64), unpack(pos, np.int32)
                    wide = np.zeros((len(doc), 8), np.uint8)
                    wide[:, :6] = unpack(h, "V6").view(np.uint8).reshape(-1, 6)
                    held.append((wide.view("<u8").reshape(-1), doc, pos))
        if held:
            h, doc, pos = map(np.concatenate, zip(*held))
            del held
            o = np.argsort(h)
            h, doc, pos = h[o], doc[o], pos[o]
            first = _first_of(h)
            size = np.diff(np.append(first, len(h)))
            found = np.repeat(np.minimum.reduceat(doc, first) != np.maximum.reduceat(doc, first), size) & (doc != _MANY)
            if found.any():
                to, (doc, pos) = _dealt(buckets, doc[found], pos[found])
                yield {"to": to, "doc": doc, "mark": [None] * len(to), "lo": pos, "hi": [None] * len(to)}

    def lists(batches):
        held = [(unpack(doc, np.int64), unpack(pos, np.int32)) for b in batches for doc, pos in zip(b.column("doc").to_pylist(), b.column("lo").to_pylist())]
        if held:
            doc, pos = map(np.concatenate, zip(*held))
            o = np.lexsort((pos, doc))
            first = _first_of(doc[o])
            yield {"id": doc[o][first], "pos": int_lists(pos[o], first)}

    matched = arrow_fold(arrow_fold(rows, gather, _SENT).repartition(buckets, "bucket"), match, _TO)
    return arrow_fold(matched.repartition(buckets, "to"), lists, _FOUND)


def _splitters(rows: DataFrame, found: DataFrame, n_docs: int, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Quantiles of the different leads of suffixes that travel, and the leads of which a hot part of the sample has one."""
    out_of = 1 << 20
    chosen = F.pmod(F.xxhash64("id"), F.lit(out_of)) < max(1, min(out_of, out_of * SAMPLE // max(1, n_docs)))
    texts = rows.filter(chosen).select("id", F.col("text").alias("t")).dropDuplicates(["id"])
    pos = found.filter(chosen).groupBy("id").agg(F.flatten(F.collect_list("pos")).alias("pos"))

    def lead(b):
        for t, pos in zip(b.column("t").to_pylist(), b.column("pos").to_pylist()):
            buf = np.frombuffer((t or "").encode(), np.uint8)
            at = np.array(pos[:: -(-len(pos) // SAMPLE_LEADS)], np.int64)
            at = at[at + GRAM <= len(buf)]  # another text of the id may be longer
            if len(at):
                yield {"lead": np.unique(_leads(buf, at)).tolist()}

    got = arrow_map(texts.join(pos, "id").select("t", "pos"), lead, T.StructType([T.StructField("lead", _B)])).toPandas()
    w, times = np.unique(np.array([bytes(x) for x in got["lead"]], f"S{GRAM}"), return_counts=True)
    return np.unique(w[np.arange(1, buckets) * len(w) // buckets]) if len(w) else w, w[times >= HOT]


def repeated_runs(rows: DataFrame) -> DataFrame:
    """(id, mark, lo, hi): runs of starts of 50-byte strings that go. rows: (id, text), ids not null."""
    return only_last(lambda: _repeated_runs(rows))


def _repeated_runs(rows: DataFrame) -> DataFrame:
    size = rows.agg(F.sum(F.octet_length("text")), F.count(F.lit(1))).first()
    buckets = bucket_count(size[0] or 0, BUCKET)
    found = cut(_shared_anchors(rows, buckets))
    splitters, hot = _splitters(rows, found, size[1], buckets)
    texts = _squeezed(rows)
    marks = cut(arrow_map(rows, lambda b: iter([{"id": (r := _rows(b))[0], "digest": [hashlib.blake2b(t, digest_size=16).digest() for t in r[1]], "mark": [_mark(t) for t in r[1]], "n": [len(t) for t in r[1]]}]), T.StructType([T.StructField("id", _L), T.StructField("digest", _B), T.StructField("mark", _L), T.StructField("n", _I)])))
    least = cut(marks.groupBy("digest").agg(F.min("id").alias("least")))  # on its own, so that the join can be split where copies are many
    copies = marks.join(least, "digest")
    whole = copies.filter(f"id > least AND n >= {LENGTH}").select("id", "mark", F.array(F.lit(0)).alias("lo"), F.array(F.col("n") - LENGTH).alias("hi")).distinct()
    first = copies.filter("id = least").select("id", "mark").distinct()
    wanted = found.groupBy("id").agg(F.flatten(F.collect_list("pos")).alias("pos")).join(first, "id")
    near = wanted.join(texts.dropDuplicates(["id", "mark"]), ["id", "mark"]).select("id", "mark", "z", "pos")

    def sent(parts, back):
        """Sends what of parts stands; what has a hot lead goes to the list `back` instead, if there is one."""
        all_ = Suffixes.joined(parts)
        stays, runs = all_.judged()
        empty = {"bucket": [], "n": [], "around": [], "doc": [], "mark": [], "p": [], "lo": [], "hi": []}
        s = all_.take(stays)
        lead = s.lead()
        if back is not None and len(hot) and len(lead):
            at = np.minimum(np.searchsorted(hot, lead), len(hot) - 1)
            held = hot[at] == lead
            if 0 < held.sum() <= HELD_SUFFIXES // 2:
                back.append(s.take(np.flatnonzero(held)))
                s, lead = s.take(np.flatnonzero(~held)), lead[~held]
        s, to = s.take(o := np.argsort(lead)), np.searchsorted(splitters, lead[o], side="right")
        edge = np.searchsorted(to, np.arange(len(splitters) + 2))
        for i in np.flatnonzero(np.diff(edge)):
            part = s.take(np.arange(edge[i], edge[i + 1]))
            empty["bucket"].append(int(i))
            empty["n"].append(len(part.p))
            empty["around"].append(squeeze(part.around.tobytes()))
            for x in ("doc", "mark", "p", "lo", "hi"):
                empty[x].append(pack(getattr(part, x)))
        to, columns = _dealt(buckets, *runs)
        for x, v in (("bucket", to), ("n", [0] * len(to)), ("around", [None] * len(to)), ("p", [None] * len(to)), *zip(("doc", "mark", "lo", "hi"), columns)):
            empty[x] += v
        if empty["n"]:
            yield empty

    def cut_out(batches):
        held, n = [], 0
        for b in batches:
            ids, marks_, z, pos = (b.column(i).to_pylist() for i in range(4))
            for i, m, t, want in zip(ids, marks_, z, pos):
                text = unsqueeze(t)
                _, p, lo, hi = anchors([text])
                o = np.isin(p, np.array(want, np.int64))
                p, lo, hi = p[o], lo[o], hi[o]
                if len(p):
                    held.append(Suffixes(around(text, p, lo, hi), np.full(len(p), i), np.full(len(p), m), p.astype(np.int32), lo.astype(np.int32), hi.astype(np.int32)))
                    n += len(p)
                if n >= HELD_SUFFIXES:
                    back = []
                    yield from sent(held, back)
                    held, n = back, sum(len(x.p) for x in back)
        if n:
            yield from sent(held, None)

    def bucket(batches):
        held = []
        for b in batches:
            for to, n, text, doc, mark, p, lo, hi in zip(*(b.column(i).to_pylist() for i in range(8))):
                if not n:
                    yield {"to": [to], "doc": [doc], "mark": [mark], "lo": [lo], "hi": [hi]}
                else:
                    raw = np.frombuffer(unsqueeze(text), np.uint8).reshape(n, WIDTH)
                    held.append(Suffixes(raw, unpack(doc, np.int64), unpack(mark, np.int64), unpack(p, np.int32), unpack(lo, np.int32), unpack(hi, np.int32)))
        if held:
            every = Suffixes.joined(held)
            del held
            lead = every.lead()
            order = np.argsort(lead)
            edge = np.append(_first_of(lead[order]), len(order))  # equal strings have equal leading bytes
            at = 0
            while at < len(order):
                to = int(edge[max(np.searchsorted(edge, at + HELD_SUFFIXES, side="right") - 1, np.searchsorted(edge, at, side="right"))])
                _, runs = every.take(order[at:to]).judged()
                yield dict(zip(_TO.names, ((d := _dealt(buckets, *runs))[0], *d[1])))
                at = to

    def gathered(batches):
        held = [tuple(unpack(x, k) for x, k in zip(row, (np.int64, np.int64, np.int32, np.int32))) for b in batches for row in zip(*(b.column(i).to_pylist() for i in range(1, 5)))]
        if held:
            yield by_document(*map(np.concatenate, zip(*held)))

    moved = arrow_fold(near, cut_out, _MOVED).repartition(buckets, "bucket")
    return arrow_fold(arrow_fold(moved, bucket, _TO).repartition(buckets, "to"), gathered, _RUNS).unionByName(whole)


def spans_of(lo: list, hi: list) -> tuple[np.ndarray, np.ndarray]:
    """Removed spans [start, end) of runs of starts."""
    if not lo:
        return (np.zeros(0, np.int64),) * 2
    o = np.argsort(lo)
    a = np.array(lo, np.int64)[o]
    b = np.maximum.accumulate(np.array(hi, np.int64)[o] + LENGTH)
    new = np.flatnonzero(np.concatenate(([True], a[1:] > b[:-1])))
    return a[new], b[np.append(new[1:], len(a)) - 1]


def without(text: bytes, start: np.ndarray, end: np.ndarray) -> bytes:
    edge = [0, *np.stack((start, end), 1).reshape(-1).tolist(), len(text)]
    return b"".join(text[edge[i] : edge[i + 1]] for i in range(0, len(edge), 2))


def _gathered(runs: DataFrame) -> DataFrame:
    return runs.groupBy("id", "mark").agg(F.flatten(F.collect_list("lo")).alias("lo"), F.flatten(F.collect_list("hi")).alias("hi"))


def report(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: n_bytes, n_removed, n_spans, kept_sha256."""
    docs = only(docs, key, text)
    rows = docs.filter(F.col(key).isNotNull()).select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    runs = _gathered(repeated_runs(rows))
    texts = _squeezed(docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text")))
    schema = T.StructType([T.StructField(key, _L), *(T.StructField(x, _L) for x in ("n_bytes", "n_removed", "n_spans")), T.StructField("kept_sha256", T.StringType())])

    def run(b):
        out = {f.name: [] for f in schema}
        for i, z, lo, hi in zip(*(b.column(c).to_pylist() for c in ("id", "z", "lo", "hi"))):
            t = unsqueeze(z)
            start, end = spans_of(lo or [], hi or [])
            for name, v in zip(out, (i, len(t), int((end - start).sum()), len(start), hashlib.sha256(without(t, start, end)).hexdigest())):
                out[name].append(v)
        yield out

    return arrow_map(texts.join(runs, ["id", "mark"], "left").select("id", "z", "lo", "hi"), run, schema)


def strip(docs: DataFrame, key: str = "doc_id", text: str = "text", n_chars: str | None = None) -> DataFrame:
    """docs with the repeated passages cut out of text; a cut inside a character leaves out what is left of it. A column
    n_chars, if named, gets the new lengths of texts that are not null."""
    rows = only(docs, key, text).toDF("id", "text").filter("id IS NOT NULL").select(F.col("id").cast("long"), "text")
    runs = _gathered(repeated_runs(rows))
    whole = rolled(docs, id=key, t=text)
    shape = whole.schema["row"].dataType
    marked = arrow_map(whole.select(F.col("id").cast("long").alias("id"), "t", "row"), lambda b: iter([{"row": b.column(2), "id": b.column(0), "mark": [_mark(t) for t in _rows(b)[1]]}]), T.StructType([T.StructField("row", shape), T.StructField("id", _L), T.StructField("mark", _L)]))
    at = place(docs, text)

    def run(b):
        row = b.column("row")
        texts = row.field(at).to_pylist()
        for i, (lo, hi) in enumerate(zip(b.column("lo").to_pylist(), b.column("hi").to_pylist())):
            if lo:
                texts[i] = without((texts[i] or "").encode(), *spans_of(lo, hi)).decode(errors="ignore")
        yield {"row": row, "text": texts}

    out = arrow_map(marked.join(runs, ["id", "mark"], "left").select("row", "lo", "hi"), run, T.StructType([T.StructField("row", shape), T.StructField("text", T.StringType())]))
    new = {text: "text"}
    if n_chars is not None:
        i = place(docs, n_chars)
        out = out.withColumn("n", F.coalesce(F.length("text").cast(docs.schema[i].dataType), F.col(f"row.c{i}")))
        new[n_chars] = "n"
    return unrolled(out, docs, **new)
