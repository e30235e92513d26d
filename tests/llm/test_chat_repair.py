import hashlib
import random
import re
import zlib
from itertools import product

import pytest

from sectile.llm import chat_repair as cr
from sectile.llm import queries

D = "/root/testdata/sf0.001"
SHAPE = re.compile(r"(s?(ua)+)?")


def sha(x):
    return hashlib.sha256(x).digest()


def faults(rows):
    """Faults of rows in order."""
    seen, out = set(), []
    for _, role, text in rows:
        last = re.findall(r"[^\x20\x09-\x0D]", text)
        out.append("blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(roles, bad, most=3):
    """Brute force: every edit with up to `most` inserts between rows, without graph or costs to the end."""
    best = (1 << 30, "", [])
    n = len(roles)
    stack = [(0, 0, "", [], 0)]
    while stack:
        i, cost, letters, out, ins = stack.pop()
        if cost > best[0]:
            continue
        if i == n and SHAPE.fullmatch("".join(r[0] if r else " " for r, _ in out)):
            best = min(best, (cost, letters, out), key=lambda b: b[:2])
        if i < n:
            stack.append((i + 1, cost + 2, letters + "D", out, ins))
            if bad[i] in ("", "truncated"):
                more = 5 * (bad[i] == "truncated")
                stack.append((i + 1, cost + more, letters + "K", [*out, (roles[i], i)], ins))
                for r in ("user", "assistant"):
                    stack.append((i + 1, cost + 1 + more, letters + "R", [*out, (r, i)], ins))
        if ins < most:
            for r in ("user", "assistant"):
                stack.append((i, cost + 5, letters + "I", [*out, (r, None)], ins + 1))
    return best


@pytest.mark.parametrize("seed", range(4))
def test_edits_against_all_edits(seed):
    r = random.Random(seed)
    for _ in range(25):
        roles = [r.choice(["user", "assistant", "system", "tool"]) for _ in range(r.randint(0, 5))]
        bad = [r.choice(["", "", "", "truncated", "blank"]) for _ in roles]
        edits, tail = cr._whole(bytes(cr._code(x, b == "blank", b == "truncated") for x, b in zip(roles, bad)))
        letters = re.sub("[ua]", "I", re.sub("[UA]", "R", "".join(edits) + tail))
        assert letters == cheapest(roles, bad)[1]


def brute(rows, most=3):
    """All results of one conversation from its rows after damage."""
    rows = sorted(rows, key=lambda x: (x[0] is not None, x[0] or 0, x[1], sha(x[2].encode())))
    bad = faults(rows)
    turns = [t for t, _, _ in rows if t is not None]
    first = [x[1][:1] for x in rows]
    cost, letters, out = cheapest([x[1] for x in rows], bad, most)
    text = "\n".join(f"{r}:{'' if i is None else rows[i][2]}" for r, i in out)
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(first, first[1:]))
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, bad.count("blank"), bad.count("duplicate"), bad.count("truncated"), illegal, cost, letters, hashlib.sha256(text.encode()).hexdigest())


def damaged(rows):
    by = {}
    for c, t, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        d = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        mine = by.setdefault(c, [])
        if d == 0:
            continue
        text = "" if d == 1 else re.sub("[.!?]", "", text) if d == 2 else text
        mine += [(t, "user" if d == 4 else role, text)] * (2 if d == 3 else 1)
    return by


def results(df):
    return {x[0]: tuple(x[1:]) for x in df.select(*cr.RESULT).collect()}


def test_query_against_brute_force(spark):
    rows = [tuple(x) for x in spark.read.parquet(f"{D}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert results(queries.op11_conversation_repair(spark, D)) == {c: brute(m) for c, m in damaged(rows).items()}


ODD = [
    (1, 0, "user", "Hi."), (1, 1, "assistant", "Yes!"), (1, 1, "assistant", "Yes!"), (1, 5, None, None), (2, None, "user", "a.\n\t"), (2, None, "user", "a."), (2, 3, "Assistant", "b"),
    (None, 7, "system", "s."), (None, None, "user", "u?"), (3, 2, "", "x."), (4, 0, "user", "é" * 200_000 + "."), (4, 1, "assistant", " "), (5, 1, "system", "only."), (6, 0, "assistant", "a."), (6, 1, "user", "."),
]


def test_odd_rows_and_clashing_columns(spark):
    df = spark.createDataFrame([(*x, 1, "z") for x in ODD], "conv_id long, turn long, role string, text string, n int, edits string")
    want = {c: brute(m) for c, m in damaged(ODD).items()}
    assert results(cr.repair(cr.damage(df))) == want
    clash = df.toDF("conv_id", "turn", "role", "text", "TEXT", "digest")
    assert results(cr.repair(cr.damage(clash))) == want
    assert cr.repair(cr.damage(df.limit(0))).count() == 0


def test_rows_that_are_all_dropped(spark):
    c = next(c for c in range(10_000) if all(zlib.crc32(f"{c}:{t}".encode()) % 20 == 0 for t in (0, 1)) or zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    df = spark.createDataFrame([(c, 0, "user", "x.")], "conv_id long, turn long, role string, text string")
    assert results(cr.repair(cr.damage(df))) == {c: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


def forward(rows):
    """Cheapest letters of a long conversation: least (cost, letters) of each state, row by row."""
    bad = faults(rows)
    now = {0: (0, "", 0)}

    def put(to, q, v):
        if v is not None and (q not in to or v < to[q]):
            to[q] = v

    def inserted(at):
        for _ in range(3):
            for q, (c, s, k) in list(at.items()):
                to = {0: 2, 1: 2, 2: 3, 3: 2}[q]
                put(at, to, (c + 5, s + "I", k))
        return at

    for (_, role, _), b in zip(rows, bad):
        nxt = {}
        for q, (c, s, k) in inserted(now).items():
            put(nxt, q, (c + 2, s + "D", k))
            if b in ("", "truncated"):
                more, to = 5 * (b == "truncated"), {0: 2, 1: 2, 2: 3, 3: 2}[q]
                put(nxt, to, (c + 1 + more, s + "R", k))
                kept = {"s": 1 if q == 0 else None, "u": 2 if q != 2 else None, "a": 3 if q == 2 else None}.get(role[:1])
                if kept is not None:
                    put(nxt, kept, (c + more, s + "K", k))
        now = nxt
    return min(v for q, v in inserted(now).items() if q in (0, 3))[:2]


def test_long_conversations_in_pieces(spark, monkeypatch):
    """Pieces of three rows over several partitions give what one pass over the whole conversation gives."""
    monkeypatch.setattr(cr, "PIECE", 3)
    r = random.Random(5)
    rows = [(c, t, r.choice(["user", "assistant", "system", "tool"]), r.choice(["a.", "b", "", f"{t}.", f"{t}!"])) for c, n in ((1, 150), (2, 1), (3, 40), (4, 7), (5, 90)) for t in range(n)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(6)
    got = results(cr.repair(df))
    for c in range(1, 6):
        mine = sorted([x[1:] for x in rows if x[0] == c], key=lambda x: x[0])
        assert got[c][5:7] == forward(mine), c
        letters = got[c][6]
        assert len(letters.replace("I", "")) == len(mine)


def test_all_short_role_strings():
    for roles in product(["user", "assistant", "system"], repeat=3):
        edits, tail = cr._whole(bytes(cr._code(x, False, False) for x in roles))
        assert re.sub("[ua]", "I", re.sub("[UA]", "R", "".join(edits) + tail)) == cheapest(roles, [""] * 3)[1]
