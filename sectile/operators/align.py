"""Global alignment of slices: least squares over all matched points, without the system in one place.

Every slice z gets an affine transform T_z, such that T_a(p_a) = T_b(p_b) for the matched points of slices a and b. With
T_z(p) = p + s * u_z' h(p), h(p) = ((x - cx) / s, (y - cy) / s, 1), the unknown u_z is 3 x 2, and x and y share one matrix of
3 x 3 blocks. Spark reduces the points of each pair of slices to the sums of its blocks; what remains is a table of blocks
(i, j), where i is the rank of a slice and j - i is at most the reach of the matches.

The system is solved by substructuring. Slices are cut into segments; the last `reach` slices of each are its boundary. No
block joins the interiors of two segments, so each task eliminates the interior of one segment exactly and returns what
that adds to the blocks of the boundaries before and after it (a Schur complement). The boundaries are a system of the same
kind, with a few slices for each segment, and are cut into segments again until a system of LEAST slices is left. Then the
interiors are solved, level by level, from their boundaries. A task holds the blocks of one segment; rounds grow with the
logarithm of the number of slices.

Points are shuffled once: they are filed by pair, and each round reads them twice, with what the pairs know of the solution.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .cuts import cut, filed
from .windows import global_index

#: Slices of a segment, where the reach leaves room; and of a system that one task solves.
SEGMENT, LEAST = 128, 256

_BLOCK, _RIGHT = [f"g{k}" for k in range(9)], [f"r{k}" for k in range(6)]
_SYSTEM = "i long, j long, " + ", ".join(f"{c} double" for c in _BLOCK + _RIGHT)
_SOLVED = "i long, " + ", ".join(f"u{k} double" for k in range(6))


def _basis(x: str, y: str, cx: float, cy: float, s: float) -> list[Column]:
    return [(F.col(x) - cx) / s, (F.col(y) - cy) / s, F.lit(1.0)]


def pair_blocks(points: DataFrame, cx: float, cy: float, s: float) -> DataFrame:
    """Sums of each pair of slices (i_a, i_b): blocks aa, bb, ab (9 each), right sides a, b (6 each), weight; n, of whole points."""
    ha, hb, w = _basis("xa", "ya", cx, cy, s), _basis("xb", "yb", cx, cy, s), F.col("w")
    d = [(F.col("xb") - F.col("xa")) / s, (F.col("yb") - F.col("ya")) / s]

    def sums(name, left, right):
        return [F.sum(w * p * q).alias(f"{name}{k}") for k, (p, q) in enumerate((p, q) for p in left for q in right)]

    return points.groupBy("i_a", "i_b").agg(*sums("aa", ha, ha), *sums("bb", hb, hb), *sums("ab", ha, hb), *sums("ra", ha, d), *sums("rb", hb, d), F.sum("w").alias("weight"), F.count_if((F.col("xa") + F.col("ya") + F.col("xb") + F.col("yb")).isNotNull()).alias("n"))


def _entries(pairs: DataFrame, slices: DataFrame, size: int, smooth: float, pull: float) -> DataFrame:
    """The upper blocks of the normal equations and their right sides, a row for each (i, j); slice 0 is held still."""

    def rows(df, i, j, block, right=None):
        return df.select(i.cast("long").alias("i"), j.cast("long").alias("j"), *(b.alias(c) for b, c in zip(block, _BLOCK)), *(r.alias(c) for r, c in zip(right or [F.lit(0.0)] * 6, _RIGHT)))

    a, b = F.col("i_a"), F.col("i_b")
    ab = [F.col(f"ab{k}") for k in range(9)]
    swapped = [F.col(f"ab{3 * (k % 3) + k // 3}") for k in range(9)]
    n = F.greatest(F.col("weight"), F.lit(1.0)) * pull
    own = [[F.col(f"{side}{k}") + (n if k in (0, 4) else 0.0) for k in range(9)] for side in ("aa", "bb")]
    parts = [
        rows(pairs, a, a, own[0], [F.col(f"ra{k}") for k in range(6)]),
        rows(pairs, b, b, own[1], [-F.col(f"rb{k}") for k in range(6)]),
        rows(pairs, F.least(a, b), F.greatest(a, b), [-F.when(a < b, p).otherwise(q) for p, q in zip(ab, swapped)]),
    ]
    eye = [F.lit(smooth if k in (0, 4, 8) else 0.0) for k in range(9)]
    i = F.col("i")
    follow = slices.filter(i < size - 1)
    parts += [rows(follow, i, i, eye), rows(follow, i + 1, i + 1, eye), rows(follow, i, i + 1, [-x for x in eye])]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return _added(out.filter("i > 0"))


def _added(entries: DataFrame) -> DataFrame:
    return entries.groupBy("i", "j").agg(*(F.sum(c).alias(c) for c in _BLOCK + _RIGHT))


def _assembled(pdf: pd.DataFrame):
    """Slices in order, the matrix [3 n, 3 n] and the right side [3 n, 2] of some entries."""
    ids = np.unique(pdf[["i", "j"]].to_numpy())
    n = len(ids)
    i, j = np.searchsorted(ids, pdf["i"]), np.searchsorted(ids, pdf["j"])
    block, right = pdf[_BLOCK].to_numpy().reshape(-1, 3, 3), pdf[_RIGHT].to_numpy().reshape(-1, 3, 2)
    m, r = np.zeros((n, n, 3, 3)), np.zeros((n, 3, 2))
    np.add.at(m, (i, j), block)
    off = i != j
    np.add.at(m, (j[off], i[off]), block[off].transpose(0, 2, 1))
    np.add.at(r, i, right)
    return ids, m.transpose(0, 2, 1, 3).reshape(3 * n, 3 * n), r.reshape(3 * n, 2)


def _rows_of(ids: np.ndarray, u: np.ndarray) -> pd.DataFrame:
    return pd.DataFrame({"i": ids, **{f"u{k}": u.reshape(-1, 6)[:, k] for k in range(6)}})


def _eliminated(segment: int, reach: int):
    """Of the entries of a segment's interior: what its elimination adds to the boundaries."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        ids, m, r = _assembled(pdf)
        inner = np.repeat(ids % segment < segment - reach, 3)
        keep = ids[ids % segment >= segment - reach]
        rest = np.linalg.solve(m[np.ix_(inner, inner)], np.concatenate((m[np.ix_(inner, ~inner)], r[inner]), 1)) if inner.any() else np.zeros((0, 3 * len(keep) + 2))
        take = m[np.ix_(~inner, inner)] @ rest
        # entries between boundaries are not in this group: only the complement goes on
        block, right = -take[:, :-2].reshape(len(keep), 3, len(keep), 3).transpose(0, 2, 1, 3), -take[:, -2:].reshape(len(keep), 6)
        a, b = np.triu_indices(len(keep))
        out = pd.DataFrame({"i": keep[a], "j": keep[b]})
        out[_BLOCK] = block[a, b].reshape(-1, 9)
        out[_RIGHT] = np.where((a == b)[:, None], right[a], 0.0)
        return out

    return run


def _filled_in(segment: int, reach: int):
    """The interior of a segment from its entries and the solved boundaries (rows with u)."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        told = pdf["u0"].notna().to_numpy()
        known = {i: u for i, u in zip(pdf["i"][told], pdf.loc[told, [f"u{k}" for k in range(6)]].to_numpy())}
        if told.all():
            return _rows_of(np.zeros(0, np.int64), np.zeros((0, 6)))
        ids, m, r = _assembled(pdf[~told])
        inner = ids % segment < segment - reach
        edge, x = ids[~inner], np.repeat(inner, 3)
        u = np.array([known[i] for i in edge]).reshape(-1, 2)
        return _rows_of(ids[inner], np.linalg.solve(m[np.ix_(x, x)], r[x] - m[np.ix_(x, ~x)] @ u))

    return run


def solve_blocks(entries: DataFrame, size: int, reach: int, segment: int = SEGMENT, least: int = LEAST) -> DataFrame:
    """(i, u0 ... u5) that solves the symmetric system of entries (i <= j <= i + reach, both below `size`)."""
    entries = cut(entries)
    if size <= least:

        def whole(pdf: pd.DataFrame) -> pd.DataFrame:
            ids, m, r = _assembled(pdf)
            return _rows_of(ids, np.linalg.solve(m, r))

        return cut(entries.withColumn("s", F.lit(0)).groupBy("s").applyInPandas(whole, _SOLVED))  # `least` slices at most
    segment = max(segment, 4 * reach)
    at, role = F.col("i"), F.pmod(F.col("i"), F.lit(segment)) >= segment - reach
    role_j = F.pmod(F.col("j"), F.lit(segment)) >= segment - reach
    owner = F.floor(F.when(~role, at).otherwise(F.col("j")) / segment)  # the segment of the interior slice
    inner = entries.filter(~(role & role_j)).withColumn("s", owner)
    more = inner.groupBy("s").applyInPandas(_eliminated(segment, reach), _SYSTEM)
    reduced = _added(entries.filter(role & role_j).unionByName(more))
    # boundary slices are numbered anew, without gaps, in order
    new = lambda c: F.floor(F.col(c) / segment) * reach + F.pmod(F.col(c), F.lit(segment)) - (segment - reach)
    there = size // segment * reach + max(0, size % segment - (segment - reach))
    solved = solve_blocks(reduced.withColumn("i", new("i")).withColumn("j", new("j")), there, 2 * reach - 1, segment, least)
    back = F.floor(F.col("i") / reach) * segment + F.pmod(F.col("i"), F.lit(reach)) + (segment - reach)
    edges = solved.withColumn("i", back)
    # a boundary is seen by the segment that it ends and by the next
    seen = edges.withColumn("s", F.explode(F.array(F.floor(F.col("i") / segment), F.floor(F.col("i") / segment) + 1)))
    both = inner.unionByName(seen, allowMissingColumns=True)
    inside = both.groupBy("s").applyInPandas(_filled_in(segment, reach), _SOLVED)
    return cut(inside.unionByName(edges))


def slice_affines(points: DataFrame, smooth: float = 1e-3, pull: float = 1e-3, reject: float = 5.0, rounds: int = 3, segment: int = SEGMENT, least: int = LEAST) -> DataFrame:
    """(z, a00, a01, tx, a10, a11, ty) for each slice, the first of which stays; points: z_a, z_b, xa, ya, xb, yb, w.

    smooth: weight of equal transforms of neighbours, in shares of a typical pair's weight; pull: towards no deformation,
    in shares of the weight. After each round, all points are judged anew: those go whose error is beyond `reject` pixels,
    three deviations (from the approximate median of errors) and twice the median of their pair; and all points of pairs
    whose median is beyond the first two and the largest of the pairs that share a slice with it. That finds wrong pairs and
    stray points among many; pairs of few points should come from a robust fit each (fits.robust_transforms)."""
    sides = points.select(F.explode(F.array("z_a", "z_b")).alias("z")).groupBy("z").agg(F.count(F.lit(1)).alias("n"))
    slices = cut(global_index(sides, "z", F.floor(F.col("z") / 10_000), "i"))
    last, n = slices.agg(F.max("i"), F.sum("n")).first()
    slices, size = slices.select("z", "i"), last + 1
    a, b = (slices.select(F.col("z").alias(f"z_{k}"), F.col("i").alias(f"i_{k}")) for k in "ab")
    p = filed(points.join(a, "z_a").join(b, "z_b").select("i_a", "i_b", "xa", "ya", "xb", "yb", "w"), n // 2, "i_a", "i_b")
    m = p.filter("w > 0").agg(F.avg("xa"), F.avg("ya"), F.var_pop("xa") + F.var_pop("ya"), F.max(F.abs(F.col("i_b") - F.col("i_a")))).first()
    cx, cy, s, reach = m[0] or 0.0, m[1] or 0.0, float(np.sqrt(m[2] or 0)) or 1.0, int(m[3] or 1)
    u, keep, links = None, p, None
    for k in range(rounds + 1):
        if k:
            keep = _kept(p, _told(links, u), cx, cy, s, reject)  # from the points and the last solution; earlier rounds are not in the plan
        pairs = cut(pair_blocks(keep, cx, cy, s))
        links = links or pairs.select("i_a", "i_b", "n")
        typical = pairs.filter("weight > 0").agg(F.percentile_approx("weight", 0.5)).first()[0] or 1.0
        u = solve_blocks(_entries(pairs, slices, size, smooth * typical, pull), size, max(reach, 1), segment, least)
    d = slices.join(u, "i", "left")
    v = [F.coalesce(f"u{k}", F.lit(0.0)) for k in range(6)]  # u[h, axis]
    t = [s * v[4 + c] - v[c] * cx - v[2 + c] * cy for c in (0, 1)]
    return d.select("z", (1 + v[0]).alias("a00"), v[2].alias("a01"), t[0].alias("tx"), v[1].alias("a10"), (1 + v[3]).alias("a11"), t[1].alias("ty"))


def _told(links: DataFrame, u: DataFrame) -> DataFrame:
    """i_a, i_b, n and the solutions of both slices, a0 ... a5 and b0 ... b5."""
    out = links
    for k in "ab":
        out = out.join(u.select(F.col("i").alias(f"i_{k}"), *(F.col(f"u{n}").alias(f"{k}{n}") for n in range(6))), f"i_{k}", "left")
    return cut(out.select("i_a", "i_b", "n", *(F.coalesce(f"{k}{n}", F.lit(0.0)).alias(f"{k}{n}") for k in "ab" for n in range(6))))


def _errors(p: DataFrame, told: DataFrame, cx: float, cy: float, s: float) -> DataFrame:
    """p with the distance e between its two points after the transforms, and what else is told of the pairs."""
    out = p.join(told.hint("shuffle_hash"), ["i_a", "i_b"])  # few pairs meet the points where they are filed

    def at(k, axis):
        h = _basis(f"x{k}", f"y{k}", cx, cy, s)
        return F.col(f"{'xy'[axis]}{k}") + s * sum((F.col(f"{k}{2 * n + axis}") * h[n] for n in range(3)), F.lit(0.0))

    return out.withColumn("e", F.hypot(at("a", 0) - at("b", 0), at("a", 1) - at("b", 1)))


def _kept(p: DataFrame, told: DataFrame, cx: float, cy: float, s: float, reject: float) -> DataFrame:
    e, counts = _errors(p, told, cx, cy, s), F.col("w") > 0
    low = F.count_if(counts & (F.col("e") <= reject / (3 * 1.4826))).alias("_low")
    ranked = e.withColumn("_r", F.row_number().over(W.partitionBy("i_a", "i_b").orderBy(F.asc_nulls_last("e"))))
    pairs = cut(ranked.groupBy("i_a", "i_b").agg(F.max(F.when(F.col("_r") == F.floor((F.col("n") + 1) / 2), F.col("e"))).alias("_pair"), low, F.count_if(counts & F.col("e").isNotNull()).alias("_all")))
    few, every = pairs.agg(F.sum("_low"), F.sum("_all")).first()
    limit = reject
    if 2 * (few or 0) < (every or 0):  # else three deviations are within `reject`
        typical = e.filter(counts).agg(F.percentile_approx("e", 0.5, 10_000)).first()[0] or 0.0
        limit = max(reject, 3 * 1.4826 * typical)
    sides = pairs.select(F.explode(F.array("i_a", "i_b")).alias("_i"), "_pair").groupBy("_i").agg(F.max("_pair").alias("_worst"))
    for k in "ab":  # a wrong pair drags its neighbours along: of pairs that share a slice only the worst goes
        pairs = pairs.join(sides.select(F.col("_i").alias(f"i_{k}"), F.col("_worst").alias(f"_worst_{k}")), f"i_{k}")
    goes = (F.col("_pair") > limit) & (F.col("_pair") >= F.greatest("_worst_a", "_worst_b"))
    judged = _errors(p, told.join(pairs.filter(~goes).select("i_a", "i_b", "_pair"), ["i_a", "i_b"]), cx, cy, s)
    return judged.filter((F.col("e") <= limit) | (F.col("e") <= 2 * F.col("_pair"))).select(*p.columns)


_T = ("a", "b", "tx", "c", "d", "ty")


def _after(second: str, first: str) -> list[Column]:
    """The transform `first`, then `second`, of columns with these prefixes."""
    a, b, tx, c, d, ty = (F.col(f"{second}{n}") for n in _T)
    p, q, x, r, s, y = (F.col(f"{first}{n}") for n in _T)
    return [a * p + b * r, a * q + b * s, a * x + b * y + tx, c * p + d * r, c * q + d * s, c * x + d * y + ty]


def chained(changes: DataFrame, by: list[str], run: str, reference: DataFrame) -> DataFrame:
    """(by, run, linked, a, b, tx, c, d, ty): from the frame of each run into that of the reference run.

    changes: by, run, a, b, tx, c, d, ty from the frame of `run` into that of run + 1; reference: by, run. Transforms are
    composed outward from the reference by doubling: each run knows the way to a run nearer by, whose way is added to its
    own, so rounds grow with the logarithm of the longest chain. Runs beyond a missing change are not linked."""
    to = [F.col(c) for c in by]
    forward = changes.select(*to, F.col(run).alias("r"), (F.col(run) + 1).alias("n"), *_T)
    det = F.col("a") * F.col("d") - F.col("b") * F.col("c")
    inverse = [F.col("d") / det, -F.col("b") / det, (F.col("b") * F.col("ty") - F.col("d") * F.col("tx")) / det, -F.col("c") / det, F.col("a") / det, (F.col("c") * F.col("tx") - F.col("a") * F.col("ty")) / det]
    backward = changes.select(*to, (F.col(run) + 1).alias("r"), F.col(run).alias("n"), *(x.alias(c) for x, c in zip(inverse, _T)))
    ref = reference.select(*to, F.col(run).alias("_ref"))
    steps = forward.join(ref, by).filter("r < _ref").unionByName(backward.join(ref, by).filter("r > _ref"))
    ends = changes.select(*to, F.col(run).alias("r")).unionByName(changes.select(*to, (F.col(run) + 1).alias("r"))).unionByName(ref.select(*to, F.col("_ref").alias("r"))).distinct()
    # a run without a step points to itself: the reference, and whatever has lost its way
    ways = cut(ends.join(steps.drop("_ref"), [*by, "r"], "left").select(*to, "r", F.coalesce("n", "r").alias("n"), *(F.coalesce(c, F.lit(float(c in "ad"))).alias(c) for c in _T)))
    while True:
        there = ways.select(*to, F.col("r").alias("n"), F.col("n").alias("_n"), *(F.col(c).alias(f"n_{c}") for c in _T))
        new = ways.join(there, [*by, "n"])
        new = cut(new.select(*to, "r", F.col("_n").alias("n"), *(x.alias(c) for x, c in zip(_after("n_", ""), _T)), (F.col("_n") != F.col("n")).alias("_moved")))
        ways = new.drop("_moved")
        if new.filter("_moved").isEmpty():
            break
    return ways.join(ref, by).select(*to, F.col("r").alias(run), (F.col("n") == F.col("_ref")).alias("linked"), *(F.when(F.col("n") == F.col("_ref"), F.col(c)).alias(c) for c in _T))
