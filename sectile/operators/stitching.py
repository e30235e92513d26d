"""Tile transforms from point matches: joint solves, filtering, loop closure, and searches that refine where it pays.

Spark reduces matches to second moments of each two tiles; a solve sees a row for each two tiles of one slice.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .cuts import cut

_I = np.array([[1.0, 0, 0], [0, 1, 0]])
_X, _Y = np.array([[0.0, 0, 1], [0, 0, 0]]), np.array([[0.0, 0, 0], [0, 0, 1]])
_TURN = np.array([[0.0, -1, 0], [1, 0, 0]])
_FREE = np.eye(6).reshape(6, 2, 3)
#: For each model the fixed part of a transform and what its unknowns multiply. A rigid turn is linear in its angle.
BASES = {
    "translation": (_I, np.stack((_X, _Y))),
    "rigid": (_I, np.stack((_TURN, _X, _Y))),
    "similarity": (0 * _I, np.stack((np.array([[1.0, 0, 0], [0, 1, 0]]), _TURN, _X, _Y))),
    "affine": (0 * _I, _FREE),
    "affine_rigid": (0 * _I, _FREE),
}
#: What pulls an affine towards a rotation: a = d, b = -c, a + d = 2, as (2 x 3 weights, target).
_PULLS = ((np.array([[1.0, 0, 0], [0, -1, 0]]), 0.0), (np.array([[0.0, 1, 0], [1, 0, 0]]), 0.0), (np.array([[1.0, 0, 0], [0, 1, 0]]), 2.0))


_Z = ("xa", "ya", None, "xb", "yb", None)  # a match as (xa, ya, 1, xb, yb, 1)
_MOMENTS = [(i, j) for i in range(6) for j in range(i, 6)]


def pair_moments(points: DataFrame, by: list[str]) -> DataFrame:
    """by, a, b, n and the sums m0 ... m20 of products of (xa, ya, 1, xb, yb, 1): all that a solve needs of the matches of
    two tiles, however many they are."""
    z = [F.lit(1.0) if c is None else F.col(c).cast("double") for c in _Z]
    return points.groupBy(*by, "a", "b").agg(F.count(F.lit(1)).alias("n"), *(F.sum(z[i] * z[j]).alias(f"m{k}") for k, (i, j) in enumerate(_MOMENTS)))


class Pairs:
    """The linked pairs of tiles of a slice as quadratic forms of the unknowns: with x, pair l has the squared errors
    x' A[l] x - 2 r[l]' x + c[l]. Sets of pairs are rows of a boolean array, and are solved together."""

    def __init__(self, tiles: int, a: np.ndarray, b: np.ndarray, n: np.ndarray, moments: np.ndarray, model: str, pull: float = 0.1):
        self.tiles, self.a, self.b, self.n, self.model = tiles, a, b, n, model
        self.fixed, self.basis = BASES[model]
        k, links = len(self.basis), len(a)
        self.size = max(1.0, float(np.sqrt(np.max(moments[:, (0, 1, 3, 4), (0, 1, 3, 4)] / n[:, None])))) if links else 1.0
        scale = np.array([1 / self.size, 1 / self.size, 1.0] * 2)
        m = moments * scale[:, None] * scale
        at = np.zeros((links, tiles, k, 2, 6))  # what an unknown of a tile does to the difference of the two points
        rows = np.arange(links)
        at[rows, a, :, :, :3] += self.basis
        at[rows, b, :, :, 3:] -= self.basis
        at = at[:, 1:].reshape(links, (tiles - 1) * k, 2, 6)  # tile 0 stays
        fixed = np.broadcast_to(self.fixed, (tiles, 2, 3)).copy()
        fixed[0] = _I
        still = np.concatenate((fixed[a], -fixed[b]), 2)
        self.A = np.einsum("luri,lij,lvrj->luv", at, m, at)
        self.r = -np.einsum("luri,lij,lrj->lu", at, m, still)
        self.c = np.einsum("lri,lij,lrj->l", still, m, still)
        self.A0, self.r0 = self._prior(m, pull, k)

    def _prior(self, m, pull, k):
        size = (self.tiles - 1) * k
        left, right = np.zeros((size, size)), np.zeros(size)
        if self.model == "affine_rigid":
            own = np.zeros((self.tiles, 3, 3))
            np.add.at(own, self.a, m[:, :3, :3])
            np.add.at(own, self.b, m[:, 3:, 3:])
            spread = own[:, 0, 0] + own[:, 1, 1] - (own[:, 0, 2] ** 2 + own[:, 1, 2] ** 2) / np.maximum(own[:, 2, 2], 1)
            for row, target in _PULLS:
                r = np.einsum("kij,ij->k", self.basis, row)
                for t in range(1, self.tiles):
                    mine = slice((t - 1) * k, t * k)
                    left[mine, mine] += pull / max(1 - pull, 1e-9) * spread[t] * np.outer(r, r)
                    right[mine] += pull / max(1 - pull, 1e-9) * spread[t] * target * r
        return left, right

    def solve(self, sets: np.ndarray) -> np.ndarray:
        """Unknowns of each set of pairs by least squares."""
        left = self.A0 + np.einsum("sl,luv->suv", sets, self.A)
        return np.einsum("suv,sv->su", np.linalg.pinv(left, rcond=1e-12, hermitian=True), self.r0 + sets @ self.r)

    def rms(self, x: np.ndarray) -> np.ndarray:
        """Of each pair under each row of unknowns."""
        e2 = np.einsum("su,luv,sv->sl", x, self.A, x) - 2 * x @ self.r.T + self.c
        return np.sqrt(np.maximum(e2, 0) / self.n) * self.size

    def linked(self, sets: np.ndarray) -> np.ndarray:
        """[sets, tiles]: whether the pairs link the tile to tile 0."""
        near = np.zeros((len(sets), self.tiles, self.tiles), bool)
        near[:, range(self.tiles), range(self.tiles)] = True
        for s, l in zip(*np.nonzero(sets)):
            near[s, self.a[l], self.b[l]] = near[s, self.b[l], self.a[l]] = True
        for _ in range(self.tiles.bit_length()):
            near = near @ near
        return near[:, 0]

    def left_out(self, sets: np.ndarray) -> np.ndarray:
        """Loop error of each set: the largest rms of a pair under the solve of the others, of pairs that can be missed."""
        out = np.zeros(len(sets))
        s, l = np.nonzero(sets)
        rest = sets[s]
        rest[np.arange(len(l)), l] = False
        spare = self.linked(rest).all(1)
        if spare.any():
            s, l, rest = s[spare], l[spare], rest[spare]
            np.maximum.at(out, s, self.rms(self.solve(rest))[np.arange(len(l)), l])
        return out

    def transforms(self, x: np.ndarray) -> np.ndarray:
        """[tiles, 2, 3] of one row of unknowns."""
        u = x.reshape(-1, len(self.basis))
        out = np.concatenate((_I[None], self.fixed + np.einsum("tk,kij->tij", u, self.basis)))
        if self.model == "rigid":
            turn = np.exp(1j * u[:, 0])
            out[1:, :, :2] = np.stack((turn.real, -turn.imag, turn.imag, turn.real), 1).reshape(-1, 2, 2)
        out[:, :, 2] *= self.size
        return out


def closing(p: Pairs, most: float) -> tuple[np.ndarray | None, str]:
    """(the pairs to use, why none): all, or what is left after the pairs without which loops close best. Where two choices
    close the loops equally well, no pair can be blamed."""
    use = np.ones((1, len(p.a)), bool)
    while (error := p.left_out(use)[0]) > most:
        without = np.repeat(use, len(p.a), 0) & ~np.eye(len(p.a), dtype=bool)
        without = without[use[0]]
        without = without[p.linked(without).all(1)]
        if not len(without):
            return None, f"loops are open by {error:.1f} px"
        errors = p.left_out(without)
        if (errors <= most).sum() > 1:
            return None, f"loops are open by {error:.1f} px and no single pair is at fault"
        use = without[[errors.argmin()]]
    return use[0], ""


def _slices(moments: DataFrame, by: list[str], columns: str, make) -> DataFrame:
    """make(names of tiles, a, b, n, moments) -> rows, for each slice; a row of moments for each two tiles of it."""

    def run(key, pdf):
        pdf = pdf.sort_values(["a", "b"])
        tiles = np.unique(pdf[["a", "b"]].to_numpy().astype(str))
        i, j = (np.searchsorted(tiles, pdf[c].to_numpy().astype(str)) for c in "ab")
        m = np.zeros((len(pdf), 6, 6))
        for k, (r, c) in enumerate(_MOMENTS):
            m[:, r, c] = m[:, c, r] = pdf[f"m{k}"]
        return pd.DataFrame([(*key, *row) for row in make(tiles, i, j, pdf["n"].to_numpy(), m)])

    kinds = ", ".join(f"`{c}` {dict(moments.dtypes)[c]}" for c in by)
    return moments.groupBy(*by).applyInPandas(run, f"{kinds}, {columns}")


def _transforms(moments: DataFrame, by: list[str], model: str, pull: float) -> DataFrame:
    """by, tile, linked (all tiles of the slice), a, b, tx, c, d, ty."""

    def make(tiles, i, j, n, m):
        p = Pairs(len(tiles), i, j, n, m, model, pull)
        every = np.ones((1, len(i)), bool)
        t, all_linked = p.transforms(p.solve(every)[0]), bool(p.linked(every).all())
        return [(tile, all_linked, *map(float, x.reshape(-1))) for tile, x in zip(tiles, t)]

    return _slices(moments, by, "tile string, linked boolean, a double, b double, tx double, c double, d double, ty double", make)


def near_moments(points: DataFrame, by: list[str], model: str, pull: float = 0.1, factor: float = 3.0, rounds: int = 10, least: int = 3, moments: DataFrame | None = None) -> DataFrame:
    """pair_moments of the matches that stay: those farther apart than factor times the mean of their slice go, and pairs of
    tiles with fewer than `least` then, again and again until a slice loses none or would fall apart. Errors are joined and
    counted by Spark; a slice that is settled leaves its moments, and its matches are not read again.

    points are read several times; moments: those of all points, where they are known."""
    names, columns = ["a", "b", "tx", "c", "d", "ty"], [*by, "a", "b", "xa", "ya", "xb", "yb"]
    here, settled = points.select(*columns), []
    now = cut(pair_moments(here, by)) if moments is None else moments
    for k in range(rounds):
        t = cut(_transforms(now, by, model, pull))
        e = here
        for side in "ab":
            e = e.join(t.select(*by, F.col("tile").alias(side), *(F.col(n).alias(f"{side}_{n}") for n in names)), [*by, side])
        at = [[F.col(f"{s}_{n}") for n in names] + [F.col(f"x{s}"), F.col(f"y{s}")] for s in "ab"]
        (ax, ay), (bx, by_) = ((a * x + b * y + tx, c * x + d * y + ty) for a, b, tx, c, d, ty, x, y in at)
        e = e.withColumn("_e", F.hypot(ax - bx, ay - by_))
        limit = cut(e.groupBy(*by).agg((F.avg("_e") * factor).alias("_limit"), F.count(F.lit(1)).alias("_n")))
        near = e.join(limit.drop("_n"), by).filter("_e <= _limit")
        less = cut(pair_moments(near, by).filter(F.col("n") >= least))
        tiles = t.groupBy(*by).agg(F.count(F.lit(1)).alias("_tiles"))
        still = _transforms(less, by, model, pull).groupBy(*by).agg(F.count(F.lit(1)).alias("_t"), F.bool_and("linked").alias("_linked"))
        fewer = less.groupBy(*by).agg(F.sum("n").alias("_m")).join(limit, by).filter("_m < _n").join(tiles, by).join(still, by).filter("_linked AND _t = _tiles").select(*by)
        fewer = cut(fewer)
        if fewer.isEmpty():
            break
        settled.append(now.join(fewer, by, "left_anti"))
        now = cut(less.join(fewer, by, "left_semi"))
        if k + 1 < rounds:
            here = cut(near.join(now.select(*by, "a", "b"), [*by, "a", "b"], "left_semi").select(*columns))
    for x in settled:
        now = now.unionByName(x)
    return now


def solved_tiles(points: DataFrame, by: list[str], model: str, most: float, loops: bool = False, pull: float = 0.1) -> DataFrame:
    """points: by, a, b, xa, ya, xb, yb (a match for each row) -> by, tile, ok, reason, a, b, tx, c, d, ty, matches.

    The first tile is the reference. Tiles that no match links to it fail the slice. With `loops`, pairs go until loops
    close within `most`; else far matches go, and a pair that is left with more than `most` rms fails the slice."""
    if loops:
        return _solved(pair_moments(points, by), by, model, most, True, pull)
    return solved_models(points, by, [model], most, pull).drop("model")


def solved_models(points: DataFrame, by: list[str], models: list[str], most: float, pull: float = 0.1) -> DataFrame:
    """solved_tiles (without loops) for several models, with the column `model`; the matches are made once for all."""
    here, out = cut(points.select(*by, "a", "b", "xa", "ya", "xb", "yb")), None
    every = cut(pair_moments(here, by))
    for model in models:
        one = _solved(near_moments(here, by, model, pull, moments=every), by, model, most, False, pull).withColumn("model", F.lit(model))
        out = one if out is None else out.unionByName(one)
    return out


def _solved(moments: DataFrame, by: list[str], model: str, most: float, loops: bool, pull: float) -> DataFrame:
    def make(tiles, i, j, n, m):
        p = Pairs(len(tiles), i, j, n, m, model, pull)
        use, why = np.ones(len(i), bool), ""
        lost = ~p.linked(use[None])[0]
        if lost.any():
            use, why = None, f"not linked to {tiles[0]}: {', '.join(tiles[lost])}"
        elif loops:
            use, why = closing(p, most)
        elif (worst := p.rms(p.solve(use[None])).max(initial=0.0)) > most:
            use, why = None, f"a pair is left with {worst:.1f} px rms"
        if use is None:
            return [(tile, False, why, *[None] * 6, int(n.sum())) for tile in tiles]
        t = p.transforms(p.solve(use[None])[0])
        return [(tile, True, "", *map(float, x.reshape(-1)), int(n[use].sum())) for tile, x in zip(tiles, t)]

    return _slices(moments, by, "tile string, ok boolean, reason string, a double, b double, tx double, c double, d double, ty double, matches long", make)


def bisected(positions: DataFrame, start: Column, measure: Callable[[DataFrame], DataFrame], moved: Callable[[str, str], Column], by: list[str], rank: str, value: str, limit: float) -> DataFrame:
    """Measures the positions that `start` picks, then the middle of every two neighbours whose values moved over the limit,
    until none did. positions: by, rank (0, 1, ... within by). measure adds the column `value`."""
    done = cut(measure(positions.filter(start)))
    fresh = done.select(*by, rank)
    while True:
        at = W.partitionBy(*by).orderBy(rank)
        pairs = done.withColumn("_r", F.lead(rank).over(at)).withColumn("_v", F.lead(value).over(at)).filter(F.col("_r") - F.col(rank) >= 2)
        near = pairs.join(fresh.select(*by, F.col(rank).alias("_f")), by).filter((F.col("_f") == F.col(rank)) | (F.col("_f") == F.col("_r")))
        middle = near.filter(moved(value, "_v") > limit).select(*by, F.floor((F.col(rank) + F.col("_r")) / 2).alias(rank)).distinct()
        found = cut(measure(positions.join(middle, [*by, rank], "left_semi")))
        if found.isEmpty():
            return done
        done, fresh = cut(done.unionByName(found)), found.select(*by, rank)


def retried(keys: DataFrame, levels: list[int], attempt: Callable[[DataFrame, int], DataFrame], on: list[str]) -> DataFrame:
    """Each key at the first of the levels (coarse to fine) at which attempt() says `ok`, or at the last one."""
    out, rest = None, keys
    for i, level in enumerate(levels):
        tried = cut(attempt(rest, level).withColumn("level", F.lit(level)))
        settled = tried if i == len(levels) - 1 else tried.filter("ok")
        out = settled if out is None else out.unionByName(settled)
        rest = tried.filter("NOT ok").select(*on)
    return out


def anchored(old: DataFrame, new: DataFrame, on: list[str], by: list[str], extent: float) -> DataFrame:
    """Per `by`: the affine that takes the new plan's frame onto the old one's, by least squares on the corners of tiles
    that both hold; the median shift where its linear part moves no point of the extent by more than half a pixel.

    Plans: on, by, width, height, a, b, tx, c, d, ty. Sums only: a plan of any size is spread."""
    names = ["a", "b", "tx", "c", "d", "ty"]
    both = new.join(old.select(*on, *[F.col(n).alias(f"o_{n}") for n in names]), on)
    corner = F.explode(F.array(*[F.struct((F.col("width") * i).alias("x"), (F.col("height") * j).alias("y")) for i in (0.0, 1.0) for j in (0.0, 1.0)]))
    both = both.select(*by, *names, *[f"o_{n}" for n in names], corner.alias("k"))

    def put(pre):
        return [F.col(f"{pre}{p}") * F.col("k.x") + F.col(f"{pre}{q}") * F.col("k.y") + F.col(f"{pre}{t}") for p, q, t in (("a", "b", "tx"), ("c", "d", "ty"))]

    (x, y), (u, v) = put(""), put("o_")
    pts = cut(both.select(*by, x.alias("x"), y.alias("y"), u.alias("u"), v.alias("v")))
    means = pts.groupBy(*by).agg(*[F.avg(c).alias(f"m{c}") for c in "xyuv"], F.median(F.col("u") - F.col("x")).alias("sx"), F.median(F.col("v") - F.col("y")).alias("sy"), F.count(F.lit(1)).alias("corners"))
    dx, dy, du, dv = (F.col(c) - F.col(f"m{c}") for c in "xyuv")
    sums = pts.join(means, by).groupBy(*by).agg(*[F.sum(e).alias(n) for n, e in (("xx", dx * dx), ("xy", dx * dy), ("yy", dy * dy), ("xu", dx * du), ("yu", dy * du), ("xv", dx * dv), ("yv", dy * dv))])
    s = sums.join(means, by).withColumn("det", F.col("xx") * F.col("yy") - F.col("xy") * F.col("xy"))
    lin = {n: (F.col(f"x{w}") * F.col("yy") - F.col(f"y{w}") * F.col("xy") if i == 0 else F.col(f"y{w}") * F.col("xx") - F.col(f"x{w}") * F.col("xy")) / F.col("det") for n, w, i in (("a", "u", 0), ("b", "u", 1), ("c", "v", 0), ("d", "v", 1))}
    s = s.withColumns(lin)
    off = F.greatest(F.abs(F.col("a") - 1), F.abs("b"), F.abs("c"), F.abs(F.col("d") - 1))
    s = s.withColumn("shift_only", off * extent <= 0.5)
    whole = {"a": "1D", "b": "0D", "c": "0D", "d": "1D", "tx": "sx", "ty": "sy"}
    full = {"a": "a", "b": "b", "c": "c", "d": "d", "tx": "mu - a * mx - b * my", "ty": "mv - c * mx - d * my"}
    return s.select(*by, "corners", "shift_only", *[F.expr(f"CASE WHEN shift_only THEN {whole[n]} ELSE {full[n]} END").alias(n) for n in names])
