"""Conversation structure repair: the cheapest edits that give a conversation roles `(s?(ua)+)?`.

Rows are kept (K, free), given the role user or assistant (R, 1) or deleted (D, 2; blank and duplicate rows must go);
a user or assistant row with an empty text may be inserted (I, 5) anywhere; a truncated row that stays costs 5 more.
Of all cheapest edits the one with the least letters in ASCII order is taken.

A node of the graph is (rows consumed, state of the roles so far). Minimum costs from the start and to the end mark the
tight arcs, those on some cheapest path; a walk from the start takes, at each step, the least letter of a tight arc out of
the frontier of nodes that the letters so far can reach.

Rows are brought into order by a range sort on (conv_id, turn, role, digest of the text), so a conversation of any size
lies in pieces over as many partitions as it needs. A piece is solved at once where it holds a whole conversation; else
the min-plus matrices of its pieces are composed (costs before and after each piece), then its end states (the state in
which the walk enters each piece), and each piece is walked by itself. Only matrices and states of one conversation's
pieces (one for each 8,192 rows) meet in a task. Texts travel once, to the task that hashes what a conversation keeps;
that task reads a conversation as a stream, a text at a time.

Defined results: null roles and texts are one space; rows of one turn are ordered by role, then SHA-256 of the text, null
turns first; equal rows are counted once and their copies are duplicates; a null conv_id is a conversation of its own;
conversations whose rows all went are returned with zeros; extra columns, clashing ones too, play no part; very long texts
are held one at a time; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache
from itertools import groupby

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import arrow_fold, cut, only

#: Rows of a piece at most.
PIECE = 8192
RESULT = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")

# States of the roles so far: 0 none, 1 a system row, 2 ends with a user row, 3 ends with an assistant row.
_NEXT = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}
_STATES, _ENDS, _FAR = range(4), (0, 3), 1 << 60
_COST = {"K": 0, "R": 1, "D": 2, "I": 5}
_TRUNCATED = 5
_ROLE_OF = {2: "user", 3: "assistant"}

# A row's code: 4 * fault + initial. Faults: 0 none, 1 truncated, 2 must go.
_INITIALS = "sua"


def _code(role: str, must_go: bool, truncated: bool) -> int:
    at = _INITIALS.find(role[:1]) if role else -1
    return 4 * (2 if must_go else int(truncated)) + (at if at >= 0 else 3)


def _row_arcs(code: int) -> list[tuple[str, int, int, int]]:
    """(letter, cost, from state, to state) of the arcs that consume a row."""
    fault, first = divmod(code, 4)
    out = [("D", _COST["D"], q, q) for q in _STATES]
    if fault < 2:
        more = _TRUNCATED * fault
        out += [("K", _COST["K"] + more, q, to) for q, to in (_NEXT[_INITIALS[first]].items() if first < 3 else ())]
        out += [("R", _COST["R"] + more, q, to) for name in "ua" for q, to in _NEXT[name].items()]
    return out


_INSERTS = [("I", _COST["I"], q, to) for name in "ua" for q, to in _NEXT[name].items()]


def _times(a, b):
    """Min-plus product of two 4 x 4 matrices."""
    return tuple(tuple(min(a[i][k] + b[k][j] for k in _STATES) for j in _STATES) for i in _STATES)


def _matrix(arcs):
    out = [[0 if i == j else _FAR for j in _STATES] for i in _STATES] if arcs is _INSERTS else [[_FAR] * 4 for _ in _STATES]
    for _, c, q, to in arcs:
        out[q][to] = min(out[q][to], c)
    return tuple(map(tuple, out))


_ONE = tuple(tuple(0 if i == j else _FAR for j in _STATES) for i in _STATES)
_INSERTED = _times(_times(_matrix(_INSERTS), _matrix(_INSERTS)), _matrix(_INSERTS))  # up to three inserts: a fourth never helps
_ARCS = [_row_arcs(c) for c in range(12)]
_STEP = [_times(_INSERTED, _matrix(a)) for a in _ARCS]
_START = (0, _FAR, _FAR, _FAR)
_FINISH = tuple(min(_INSERTED[q][e] for e in _ENDS) for q in _STATES)


def _piece_matrix(codes) -> tuple:
    out = _ONE
    for c in codes:
        out = _times(out, _STEP[c])
    return out


def _after(costs, matrix):
    return tuple(min(costs[q] + matrix[q][to] for q in _STATES) for to in _STATES)


def _before(matrix, costs):
    return tuple(min(matrix[q][to] + costs[to] for to in _STATES) for q in _STATES)


def _walk(codes, forward, backward, total, frontier, last) -> tuple[list[str], str, frozenset]:
    """Edits of each row, edits after the last row, and the frontier at the end.

    forward: least costs of the states before the first row; backward: least costs to the end from the states after the
    last. Edits are written as K, D, U and A (given the role user, assistant), u and a (inserted).
    """
    to_end = [backward]
    for c in reversed(codes):
        to_end.append(_before(_STEP[c], to_end[-1]))
    to_end.reverse()
    edits, from_start = [], forward
    for i, code in enumerate(codes):
        done = ""
        # nodes of this row: cheapest ways there with inserts, and on from there
        here = _after(from_start, _INSERTED)
        on = _before(_STEP[code], to_end[i + 1])
        while True:
            tight = [(let, to, True) for let, c, q, to in _ARCS[code] if q in frontier and here[q] + c + to_end[i + 1][to] == total]
            tight += [(let, to, False) for let, c, q, to in _INSERTS if q in frontier and here[q] + c + on[to] == total]
            least = min(t[0] for t in tight)
            frontier = frozenset(to for let, to, _ in tight if let == least)
            (state,) = frontier if len(frontier) == 1 else (None,)
            done += {"K": "K", "D": "D", "R": {2: "U", 3: "A"}.get(state), "I": {2: "u", 3: "a"}.get(state)}[least]
            if least != "I":
                break
        edits.append(done)
        from_start = _after(from_start, _STEP[code])
    tail = ""
    if last:
        here = _after(from_start, _INSERTED)
        while not any(q in frontier and here[q] == total for q in _ENDS):
            frontier = frozenset(to for _, c, q, to in _INSERTS if q in frontier and here[q] + c + _FINISH[to] == total)
            (state,) = frontier
            tail += {2: "u", 3: "a"}[state]
    return edits, tail, frontier


@lru_cache(maxsize=1 << 16)
def _whole(codes: bytes) -> tuple[list[str], str]:
    """Edits of a conversation that is given whole."""
    total = min(_after(_START, _times(_piece_matrix(codes), _INSERTED))[e] for e in _ENDS)
    edits, tail, _ = _walk(codes, _START, _FINISH, total, frozenset([0]), True)
    return edits, tail


def damage(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copies) with faults set by crc32(conv_id:turn) % 20; a dropped row has no copies."""
    r = only(rows, "conv_id", "turn", "role", "text")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    text, role = F.coalesce("text", F.lit(" ")), F.coalesce("role", F.lit(" "))
    d = r.withColumn("d", F.crc32(key.cast("binary")) % 20)
    return d.select(
        "conv_id", "turn", F.when(F.col("d") == 4, "user").otherwise(role).alias("role"),
        F.when(F.col("d") == 1, "").when(F.col("d") == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(F.col("d") == 0, 0).when(F.col("d") == 3, 2).otherwise(1).cast("long").alias("copies"),
    )


def _with_digest(rows: DataFrame) -> DataFrame:
    r = rows if "copies" in rows.columns else rows.withColumn("copies", F.lit(1).cast("long"))
    nothing = F.lit(" ")
    return r.select("conv_id", "turn", F.coalesce("role", nothing).alias("role"), F.coalesce("text", nothing).alias("text"), "copies").withColumn("digest", F.unhex(F.sha2("text", 256)))


def _slim(rows: DataFrame) -> DataFrame:
    """A row for each different (conv_id, turn, role, text): number of copies, and what is wrong with the first of them."""
    keys = ["conv_id", "turn", "role", "digest"]
    blank, ends = ~F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")
    s = _with_digest(rows).select(*keys, "copies", blank.alias("blank"), (~ends).alias("truncated")).groupBy(*keys).agg(F.sum("copies").alias("n"), F.max("blank").alias("blank"), F.max("truncated").alias("truncated"))
    s = cut(s)
    order = F.struct(F.col("turn").isNotNull().alias("set"), F.col("turn").alias("turn"))
    first = s.filter("n > 0").groupBy("conv_id", "role", "digest").agg(F.min(order)["turn"].alias("turn")).select(*(F.col(k).alias(f"f_{k}") for k in keys))
    same = F.lit(True)
    for k in keys:  # the turn is part of the key, so a text that recurs in many turns is no hot key
        same = same & F.col(k).eqNullSafe(F.col(f"f_{k}"))
    return s.join(first, same, "left").select(*keys, "n", "blank", "truncated", (F.col("f_digest").isNull() & (F.col("n") > 0)).alias("seen"))


_FLAGS = ("n", "blank", "truncated", "seen")


def _pieces(slim: DataFrame) -> DataFrame:
    """Runs of rows in order: (conv_id, part, k, keys and codes as arrays); edits are there where a run is a whole conversation."""
    key = ["conv_id", "turn", "role", "digest"]
    names, most = [*key, *_FLAGS, "part"], PIECE
    rows = slim.repartitionByRange(*key).sortWithinPartitions(*key).select(*key, *_FLAGS, F.spark_partition_id().alias("part"))
    lists = {"turns": slim.schema["turn"].dataType, "roles": T.StringType(), "digests": T.BinaryType(), "ns": T.LongType(), "edits": T.StringType()}
    schema = T.StructType([slim.schema["conv_id"], T.StructField("part", T.IntegerType()), T.StructField("k", T.LongType()), *(T.StructField(c, T.ArrayType(t)) for c, t in lists.items()),
                           T.StructField("codes", T.BinaryType()), T.StructField("flags", T.BinaryType()), T.StructField("tail", T.StringType()), T.StructField("matrix", T.ArrayType(T.LongType()))])

    def made(conv, k, held, whole):
        turns, roles, digests, ns, codes, flags, part = zip(*held)
        codes = bytes(codes)
        live = bytes(c for c, n in zip(codes, ns) if n)  # dropped rows are in no conversation
        out = {"conv_id": conv, "part": part[0], "k": k, "turns": turns, "roles": roles, "digests": digests, "ns": ns, "codes": codes, "flags": bytes(flags), "edits": None, "tail": None, "matrix": None}
        if whole:
            edits, tail = _whole(live)
            spread = iter(edits)
            out |= {"edits": [next(spread) if n else "" for n in ns], "tail": tail}
        else:
            # the copies of a row are deleted one by one; that adds the same to all ways
            out |= {"matrix": [x for row in _piece_matrix(live) for x in row]}
        return out

    def run(batches):
        def rows_():
            for b in batches:
                yield from zip(*(b.column(c).to_pylist() for c in names))

        first, waiting = True, None
        for conv, mine in groupby(rows_(), key=lambda r: r[0]):
            if waiting is not None:
                yield made(*waiting, not first)
                first = False
            k, held = 0, []
            for _, turn, role, digest, n, blank, truncated, seen, part in mine:
                if len(held) == most:
                    yield made(conv, k, held, False)
                    k, held = k + 1, []
                held.append((turn, role, digest, n, _code(role, blank or seen, truncated), blank + 2 * seen + 4 * truncated, part))
            if k:
                yield made(conv, k, held, False)
                waiting, first = None, False
            else:
                waiting = conv, k, held
        if waiting is not None:
            yield made(*waiting, False)  # it may go on in the next partition

    def batched(batches):
        for out in run(batches):
            yield {c: [v] for c, v in out.items()}

    return arrow_fold(rows, batched, schema)


def _by_conversation(pieces: DataFrame, columns: list[str], fn, more: T.StructType) -> DataFrame:
    """fn(the pieces of a conversation in order) -> a tuple of `more` for each; slim columns only."""
    key = ["conv_id", "part", "k"]
    p = pieces.select(*key, *columns).repartition("conv_id").sortWithinPartitions(*key)
    schema, width = T.StructType([pieces.schema[c] for c in key] + list(more)), len(p.columns)

    def run(batches):
        def rows():
            for b in batches:
                yield from zip(*(b.column(i).to_pylist() for i in range(width)))

        for _, mine in groupby(rows(), key=lambda r: r[0]):
            mine = list(mine)
            for r, found in zip(mine, fn([m[3:] for m in mine])):
                yield {n: [v] for n, v in zip(schema.names, (*r[:3], *found))}

    return arrow_fold(p, run, schema)


def _costs_around(pieces: list) -> list[tuple]:
    """(forward, backward, total, first piece, last piece) of each piece from their matrices."""
    ms = [tuple(tuple(m[4 * i : 4 * i + 4]) for i in _STATES) for (m,) in pieces]
    forward, backward = [_START], [_FINISH]
    for m in ms:
        forward.append(_after(forward[-1], m))
    for m in reversed(ms):
        backward.append(_before(m, backward[-1]))
    backward.reverse()
    total = backward[0][0]
    return [(list(forward[i]), list(backward[i + 1]), total, i + 1 == len(ms)) for i in range(len(ms))]


def _entered(pieces: list) -> list[tuple]:
    """The state in which the walk enters each piece, from the end states of each piece for each state it may enter in."""
    state, out = 0, []
    for (ends,) in pieces:
        out.append((state,))
        state = ends[state]
    return out


def _joined(pieces: DataFrame, more: DataFrame) -> DataFrame:
    m = more.select(*(F.col(c).alias(f"m_{c}") if c in ("conv_id", "part", "k") else F.col(c) for c in more.columns))
    return pieces.join(m, pieces.conv_id.eqNullSafe(m.m_conv_id) & (pieces.part == m.m_part) & (pieces.k == m.m_k)).drop("m_conv_id", "m_part", "m_k")


def _solved(partial: DataFrame) -> DataFrame:
    """Edits of the pieces of conversations that lie in several, or at the edge of a partition."""
    long, longs = T.LongType(), T.ArrayType(T.LongType())
    costs = _by_conversation(partial, ["matrix"], _costs_around, T.StructType([T.StructField("forward", longs), T.StructField("backward", longs), T.StructField("total", long), T.StructField("last", T.BooleanType())]))
    p = cut(_joined(partial, costs))

    def walked(r, state):
        live = bytes(c for c, n in zip(r["codes"], r["ns"]) if n)
        forward, backward = tuple(r["forward"]), tuple(r["backward"])
        if _after(forward, _INSERTED)[state] >= _FAR:
            return None
        return _walk(live, forward, backward, r["total"], frozenset([state]), r["last"])

    def ends(b):
        for r in b.to_pylist():
            out = []
            for q in _STATES:
                on_a_cheapest_way = r["forward"][q] + _before(_piece_matrix(bytes(c for c, n in zip(r["codes"], r["ns"]) if n)), tuple(r["backward"]))[q] == r["total"]
                out.append(min(walked(r, q)[2]) if on_a_cheapest_way else 0)
            yield {"conv_id": [r["conv_id"]], "part": [r["part"]], "k": [r["k"]], "ends": [out]}

    key = [partial.schema[c] for c in ("conv_id", "part", "k")]
    slim = p.select("conv_id", "part", "k", "codes", "ns", "forward", "backward", "total", "last")
    ended = arrow_fold(slim, lambda batches: (o for b in batches for o in ends(b)), T.StructType([*key, T.StructField("ends", longs)]))
    entered = _by_conversation(ended, ["ends"], _entered, T.StructType([T.StructField("state", long)]))
    names = [c for c in partial.columns if c != "matrix"]

    def edited(b):
        for r in b.to_pylist():
            edits, tail, _ = walked(r, r["state"])
            spread = iter(edits)
            r |= {"edits": [next(spread) if n else "" for n in r["ns"]], "tail": tail}
            yield {c: [r[c]] for c in names}

    return arrow_fold(_joined(p, entered).drop("matrix"), lambda batches: (o for b in batches for o in edited(b)), T.StructType([partial.schema[c] for c in names]))


def edits(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, digest, n, flags, edits, tail) for each different row: what to do with it, in letters.

    edits: inserts before it (u, a), then K, D, U or A for its first copy (the others go); tail: inserts after the
    conversation's last row; flags: 1 blank, 2 seen before, 4 truncated."""
    pieces = cut(_pieces(_slim(rows)))
    done = pieces.filter("edits IS NOT NULL").drop("matrix").unionByName(_solved(pieces.filter("edits IS NULL")))
    at = F.posexplode(F.arrays_zip("turns", "roles", "digests", "ns", "edits")).alias("i", "r")
    flat = done.select("conv_id", "codes", "flags", "tail", at)
    flag = F.conv(F.hex(F.substring("flags", F.col("i") + 1, F.lit(1))), 16, 10).cast("int")
    tail = F.when(F.col("i") + 1 == F.octet_length("flags"), F.col("tail")).otherwise("")
    return flat.select("conv_id", F.col("r.turns").alias("turn"), F.col("r.roles").alias("role"), F.col("r.digests").alias("digest"), F.col("r.ns").alias("n"), flag.alias("flags"), F.col("r.edits").alias("edits"), tail.alias("tail"))


_LEGAL = ("su", "ua", "au")


class _Conversation:
    """What is returned of a conversation, gathered row by row."""

    def __init__(self):
        self.least = self.most = self.turn = None
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = self.cost = 0
        self.initial, self.audit, self.tail, self.sha, self.any = None, [], "", hashlib.sha256(), False

    def row(self, turn, role, n, flags, letters, tail):
        """A row's numbers; returns the role under which its text stays, or None."""
        self.tail += tail or ""
        if not n:
            return None
        if turn is not None and turn != self.turn:
            self.least, self.most, self.turn, self.turns = turn if self.least is None else self.least, turn, turn, self.turns + 1
        must_go = flags & 3
        self.blank += n if flags & 1 else 0
        self.duplicate += 0 if flags & 1 else n - (not flags & 2)
        cut_off = flags == 4
        self.truncated += cut_off
        first = role[:1]
        self.illegal += n - 1 + (self.initial is not None and self.initial + first not in _LEGAL)
        self.initial = first
        self._inserted(letters[:-1])
        last = letters[-1]
        self.audit.append({"U": "R", "A": "R"}.get(last, last) + "D" * (n - 1))
        self.cost += 2 * (n - 1) + {"K": 0, "D": 2, "U": 1, "A": 1}[last] + (_TRUNCATED if cut_off and last != "D" else 0)
        assert last == "D" or not must_go
        return {"K": role, "U": "user", "A": "assistant", "D": None}[last]

    def _inserted(self, letters):
        for x in letters:
            self.audit.append("I")
            self.cost += _COST["I"]
            self.stays({"u": "user", "a": "assistant"}[x], "")

    def stays(self, role, text):
        self.sha.update(f"{chr(10) if self.any else ''}{role}:{text}".encode())
        self.any = True

    def result(self):
        self._inserted(self.tail)
        gaps = 0 if self.least is None else self.most - self.least + 1 - self.turns
        return gaps, self.blank, self.duplicate, self.truncated, self.illegal, self.cost, "".join(self.audit), self.sha.hexdigest()


def repair(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text[, copies]) -> RESULT: a row for each conversation."""
    long, text = T.LongType(), T.StringType()
    schema = T.StructType([rows.schema["conv_id"], *(T.StructField(c, long) for c in RESULT[1:7]), *(T.StructField(c, text) for c in RESULT[7:])])
    key = ["conv_id", "turn", "role", "digest"]
    done = edits(rows).withColumn("text", F.lit(None).cast("string"))
    texts = _with_digest(rows).filter("copies > 0").select(*key, *(F.lit(None).cast(t).alias(c) for c, t in (("n", "long"), ("flags", "int"), ("edits", "string"), ("tail", "string"))), "text")
    # of one key the edits come first, then its text
    both = done.unionByName(texts).repartition("conv_id").sortWithinPartitions(*key, F.col("text").isNotNull())

    def run(batches):
        here, now, role_of, waits = object(), None, None, None
        out = []
        for b in batches:
            for conv, turn, role, digest, n, flags, letters, tail, said in zip(*(b.column(i).to_pylist() for i in range(9))):
                if conv != here or now is None:
                    if now is not None:
                        out.append((here, *now.result()))
                    here, now, waits = conv, _Conversation(), None
                if said is None:
                    role_of = now.row(turn, role, n, flags, letters, tail)
                    waits = (turn, role, digest) if role_of is not None else None
                elif waits == (turn, role, digest):
                    now.stays(role_of, said)
                    waits = None
            if out:
                yield dict(zip(RESULT, zip(*out)))
                out = []
        if now is not None:
            yield dict(zip(RESULT, zip(*[(here, *now.result())])))

    return arrow_fold(both, run, schema)
