"""Numeric operators with small state: one solve per key in applyInPandas; large sums are reduced by Spark first."""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .cuts import cut

MODELS = {"translation": 1, "rigid": 2, "similarity": 2, "affine": 3}


def fit_points(model: str, p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Least-squares 2 x 3 transform p -> q."""
    if model == "affine":
        a = np.column_stack((p, np.ones(len(p))))
        return np.linalg.lstsq(a, q, rcond=None)[0].T
    mp, mq = p.mean(0), q.mean(0)
    if model == "translation":
        return np.column_stack((np.eye(2), mq - mp))
    x, y = p - mp, q - mq
    c, s = (x * y).sum(), (x[:, 0] * y[:, 1] - x[:, 1] * y[:, 0]).sum()
    scale = 1 / max(np.hypot(c, s), 1e-300) if model == "rigid" else 1 / max((x * x).sum(), 1e-300)
    m = np.array([[c, -s], [s, c]]) * scale
    return np.column_stack((m, mq - m @ mp))


def moved(t: np.ndarray, p: np.ndarray) -> np.ndarray:
    return p @ t[:, :2].T + t[:, 2]


#: Points of all hypotheses that are judged at once.
_JUDGED = 4_000_000


def _hypotheses(model: str, p: np.ndarray, q: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """[rounds, 2, 3]: the transform through the points of each row of indices; nan where they don't fix one."""
    a, b = p[rows], q[rows]
    if model == "affine":
        one = np.concatenate((a, np.ones((*a.shape[:2], 1))), 2)
        flat = np.abs(np.linalg.det(one)) < 1e-9
        one[flat] = np.eye(3)
        out = np.linalg.solve(one, b).transpose(0, 2, 1)
        out[flat] = np.nan
        return out
    turn = np.ones(len(rows), complex)
    if model != "translation":  # the plane as complex numbers: a turn and scale is a factor
        z, w = (x[:, 1] - x[:, 0] for x in (a @ [1, 1j], b @ [1, 1j]))
        with np.errstate(divide="ignore", invalid="ignore"):
            turn = w / z
            turn = turn / np.abs(turn) if model == "rigid" else turn
    linear = np.stack((turn.real, -turn.imag, turn.imag, turn.real), 1).reshape(-1, 2, 2)
    shift = b.mean(1) - np.einsum("nij,nj->ni", linear, a.mean(1))
    return np.concatenate((linear, shift[:, :, None]), 2)


def _distances(t: np.ndarray, p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """[..., points] of transforms [..., 2, 3]."""
    return np.linalg.norm(p @ np.swapaxes(t[..., :2], -1, -2) + t[..., None, :, 2] - q, axis=-1)


def consensus(model: str, p: np.ndarray, q: np.ndarray, threshold: float, rounds: int = 1000, least: int = 10, seed: int = 0):
    """Transform with the most points within the threshold, refitted to them, and the mask of those points; or None.

    All hypotheses are drawn at once and judged in blocks; the winner is refitted and its points chosen anew, twice."""
    k, n = MODELS[model], len(p)
    least = max(least, k)
    if n < least:
        return None
    rng = np.random.default_rng(seed)
    drawn = np.stack([rng.permutation(n)[:k] for _ in range(rounds)]) if n <= 4 * k else rng.integers(0, n, (rounds, k))
    drawn = drawn[(np.diff(np.sort(drawn, 1), axis=1) > 0).all(1)]  # k different points
    score, winner = -1, None
    for t in np.array_split(_hypotheses(model, p, q, drawn), max(1, len(drawn) * n // _JUDGED)):
        votes = (_distances(t, p, q) < threshold).sum(1)
        if len(votes) and votes.max() > score:
            score, winner = votes.max(), t[votes.argmax()]
    if winner is None:
        return None
    mask = _distances(winner, p, q) < threshold
    for again in (True, True, False):
        if mask.sum() < least:
            return None
        t = fit_points(model, p[mask], q[mask])
        if again:
            mask = _distances(t, p, q) < threshold
    return t, mask


def robust_transforms(matches: DataFrame, by: list[str], model: str, threshold: float, seed: int = 0) -> DataFrame:
    """matches: by, x, y, u, v -> by, a, b, tx, c, d, ty, n_inliers, residual_px. Pairs without a model give no row."""
    kinds = ", ".join(f"{c} {dict(matches.dtypes)[c]}" for c in by)

    def run(key, pdf):
        pdf = pdf.sort_values(["x", "y", "u", "v"])
        p, q = pdf[["x", "y"]].to_numpy(float), pdf[["u", "v"]].to_numpy(float)
        got = consensus(model, p, q, threshold, seed=seed)
        if got is None:
            return pd.DataFrame()
        t, ok = got
        err = np.hypot(*(moved(t, p[ok]) - q[ok]).T)
        return pd.DataFrame([(*key, *t.reshape(-1), int(ok.sum()), float(np.sqrt((err**2).mean())))])

    return matches.groupBy(*by).applyInPandas(run, f"{kinds}, a double, b double, tx double, c double, d double, ty double, n_inliers long, residual_px double")


def layout(pairs: DataFrame, by: list[str], a: str = "tile_a", b: str = "tile_b") -> DataFrame:
    """Tile positions from pairwise shifts dx, dy (b minus a) with weight w; the largest linked set, its first tile at 0.

    A link is dropped, worst first, while leaving it out makes the others agree far better."""
    kinds = ", ".join(f"{c} {dict(pairs.dtypes)[c]}" for c in by)

    def solve(tiles, i, j, d, w):
        n = len(tiles)
        m = np.zeros((len(i) + 1, n))
        m[np.arange(len(i)), j], m[np.arange(len(i)), i] = 1, -1
        m[-1, 0] = 1
        s = np.append(np.sqrt(w), 1.0)[:, None]
        x = np.linalg.lstsq(m * s, np.vstack((d, [[0, 0]])) * s, rcond=None)[0]
        return x, np.hypot(*(x[j] - x[i] - d).T)

    def run(key, pdf):
        pdf = pdf.sort_values([a, b])
        names = sorted({*pdf[a], *pdf[b]})
        group = {t: {t} for t in names}
        for x, y in zip(pdf[a], pdf[b]):
            if group[x] is not group[y]:
                group[x] |= group[y]
                for t in group[y]:
                    group[t] = group[x]
        keep = max(group.values(), key=lambda g: (len(g), [-ord(c) for c in min(g)]))
        pdf = pdf[pdf[a].isin(keep)]
        tiles = sorted(keep)
        at = {t: k for k, t in enumerate(tiles)}
        i, j = pdf[a].map(at).to_numpy(), pdf[b].map(at).to_numpy()
        d, w = pdf[["dx", "dy"]].to_numpy(float), pdf["w"].to_numpy(float)
        use = np.ones(len(i), bool)
        x, err = solve(tiles, i, j, d, w)
        while use.sum() > len(tiles):
            trials = []
            for k in np.flatnonzero(use):
                less = use.copy()
                less[k] = False
                y, e = solve(tiles, i[less], j[less], d[less], w[less])
                trials.append((np.sqrt((e**2).mean()), k, y))
            rest, k, y = min(trials, key=lambda t: t[0])
            now = np.sqrt((solve(tiles, i[use], j[use], d[use], w[use])[1] ** 2).mean())
            if rest > now / 3 or now < 1e-6:
                break
            use[k], x = False, y
        return pd.DataFrame([(*key, t, *x[at[t]], int((~use).sum())) for t in tiles])

    return pairs.groupBy(*by).applyInPandas(run, f"{kinds}, tile string, tx double, ty double, dropped long")


def tile_gains(relations: DataFrame, by: list[str]) -> DataFrame:
    """Gains and offsets that make tiles agree. relations: a, b, gain, offset, n, cnr, middle: value_a = gain value_b + offset.

    Log gains with a weak pull to 0 and mean 0, then offsets with sum 0; gains are scaled to mean 1."""
    kinds = ", ".join(f"{c} {dict(relations.dtypes)[c]}" for c in by)

    def balanced(n, i, j, weight, diff, pull, tie):
        """x that minimises sum weight (x_i - x_j - diff)^2 + pull |x|^2 + tie (sum x)^2, by its normal equations."""
        m, y = pull * np.eye(n) + tie, np.zeros(n)
        for a, b, sign in ((i, i, 1), (j, j, 1), (i, j, -1), (j, i, -1)):
            np.add.at(m, (a, b), sign * weight)
        np.add.at(y, i, weight * diff)
        np.add.at(y, j, -weight * diff)
        return np.linalg.solve(m, y)

    def run(key, pdf):
        tiles = np.unique(pdf[["a", "b"]].to_numpy().astype(str))
        i, j = (np.searchsorted(tiles, pdf[c].to_numpy().astype(str)) for c in "ab")
        gain, offset, middle, n_rows, cnr = (pdf[c].to_numpy(float) for c in ("gain", "offset", "middle", "n", "cnr"))
        top = n_rows.max()
        g = np.exp(balanced(len(tiles), i, j, n_rows * np.minimum(1, cnr / 10) ** 2, -np.log(gain), 0.05**2 * top, 100.0**2 * top))
        g *= len(g) / g.sum()
        o = balanced(len(tiles), i, j, n_rows, g[j] * middle - g[i] * (gain * middle + offset), 1e-12 * top, 100.0**2 * top)
        return pd.DataFrame([(*key, t, float(x), float(y)) for t, x, y in zip(tiles, g, o)])

    return relations.groupBy(*by).applyInPandas(run, f"{kinds}, tile string, g double, o double")


def slice_shifts(points: DataFrame, neighbours: int, prior: float = 1e-3, reject: float = 3.0, rounds: int = 3) -> DataFrame:
    """Shift of each slice that brings matched points together. points: z_a, z_b, xa, ya, xb, yb, w.

    Spark reduces the points of a pair to three sums; the driver solves a banded system with one unknown for each slice.
    In each round points far from the solution (by MAD) are left out; slice 0 stays."""
    spark = points.sparkSession
    keep, out = points, None
    for _ in range(rounds):
        s = keep.groupBy("z_a", "z_b").agg(F.sum("w").alias("w"), F.sum(F.col("w") * (F.col("xb") - F.col("xa"))).alias("sx"), F.sum(F.col("w") * (F.col("yb") - F.col("ya"))).alias("sy")).toPandas()  # a row for each pair of slices
        zs = np.unique(np.concatenate((s["z_a"], s["z_b"])))
        at = {z: k for k, z in enumerate(zs)}
        n, lam = len(zs), prior * float(np.median(s["w"]))
        i, j = s["z_a"].map(at).to_numpy(), s["z_b"].map(at).to_numpy()
        band = max(neighbours, int((j - i).max()))
        diag = np.zeros((band + 1, n))
        w = s["w"].to_numpy(float)
        rhs = np.zeros((n, 2))
        np.add.at(diag[0], i, w)
        np.add.at(diag[0], j, w)
        np.subtract.at(diag, (j - i, i), w)
        for c, name in enumerate(("sx", "sy")):  # T_a(p_a) = T_b(p_b): d_a - d_b = p_b - p_a
            np.add.at(rhs[:, c], i, s[name])
            np.subtract.at(rhs[:, c], j, s[name])
        diag[0, :-1] += lam
        diag[0, 1:] += lam
        diag[1, :-1] -= lam
        diag[0, 0] += 1e6 * max(w.max(), 1)
        d = solve_banded(diag, rhs)
        d -= d[0]
        out = spark.createDataFrame([(int(z), float(x), float(y)) for z, (x, y) in zip(zs, d)], "z long, tx double, ty double")
        a = out.select(F.col("z").alias("z_a"), F.col("tx").alias("ax"), F.col("ty").alias("ay"))
        b = out.select(F.col("z").alias("z_b"), F.col("tx").alias("bx"), F.col("ty").alias("by"))
        e = points.join(a, "z_a").join(b, "z_b").withColumn("e", F.hypot(F.col("xa") + F.col("ax") - F.col("xb") - F.col("bx"), F.col("ya") + F.col("ay") - F.col("yb") - F.col("by")))
        limit = max(1e-6, reject * 1.4826 * (e.agg(F.percentile_approx("e", 0.5, 10_000)).first()[0] or 0))
        keep = cut(e.filter(F.col("e") <= limit).select(*points.columns))
    return out


def solve_banded(diag: np.ndarray, rhs: np.ndarray) -> np.ndarray:
    """Cholesky of a symmetric band matrix: diag[k, i] is the element (i + k, i)."""
    k, n = diag.shape[0] - 1, diag.shape[1]
    low = diag.copy()
    for i in range(n):
        low[0, i] = np.sqrt(low[0, i])
        m = min(k, n - 1 - i)
        low[1 : m + 1, i] /= low[0, i]
        for r in range(1, m + 1):
            low[: m + 1 - r, i + r] -= low[r, i] * low[r : m + 1, i]
    x = rhs.astype(float).copy()
    for i in range(n):
        m = min(k, n - 1 - i)
        x[i] /= low[0, i]
        x[i + 1 : i + m + 1] -= low[1 : m + 1, i, None] * x[i]
    for i in range(n - 1, -1, -1):
        m = min(k, n - 1 - i)
        x[i] = (x[i] - (low[1 : m + 1, i, None] * x[i + 1 : i + m + 1]).sum(0)) / low[0, i]
    return x


def _flat_terms() -> list:
    x, y = F.col("x"), F.col("y")
    return [F.lit(1.0), x, y, x * x, x * y, y * y]


def flat_gain(most: float = 1.5):
    """The gain of a field (c0 ... c5) at x, y, within 1 / most and most."""
    log = sum((F.col(f"c{i}") * t for i, t in enumerate(_flat_terms())), F.lit(0.0))
    return F.least(F.greatest(F.exp(log), F.lit(1 / most)), F.lit(most))


def flat_fields(pixels: DataFrame, by: list[str], prior: float = 0.2, least: float = 5, most: float = 1.5) -> DataFrame:
    """Second-order polynomial (c0 ... c5) of the log brightness over a tile, of mean gain 1 over the pixels it is fitted to.

    pixels: a row for each pixel, x and y in -1 ... 1, v (mean relative brightness), w (slices behind it). Pixels of `least`
    slices count, by their slices; each pixel also says "gain 1" with the weight `prior`, which rules where nothing was
    measured. Fields of fewer than 60 such pixels are null. Spark sums the 6 x 6 equations of a key; one small task solves them."""
    terms = _flat_terms()
    used = F.coalesce((F.col("w") >= least) & (F.col("v") > 0), F.lit(False))
    weight = F.when(used, F.col("w")).otherwise(0.0)
    log = F.when(used, F.log(F.least(F.greatest("v", F.lit(1 / most)), F.lit(most)))).otherwise(0.0)
    sums = [F.sum((weight + prior) * terms[i] * terms[j]).alias(f"m{i}{j}") for i in range(6) for j in range(i, 6)] + [F.sum(weight * terms[i] * log).alias(f"r{i}") for i in range(6)]
    reduced = pixels.groupBy(*by).agg(*sums, F.count_if(used).alias("n"))
    kinds = ", ".join(f"{c} {dict(pixels.dtypes)[c]}" for c in by)

    def run(batches):
        for pdf in batches:
            rows = []
            for r in pdf.to_dict("records"):
                m = np.array([[r[f"m{min(i, j)}{max(i, j)}"] for j in range(6)] for i in range(6)])
                fit = np.linalg.lstsq(m, [r[f"r{i}"] for i in range(6)], rcond=None)[0] if r["n"] >= 10 * len(m) else [None] * 6
                rows.append((*[r[c] for c in by], *fit))
            yield pd.DataFrame(rows, columns=[*by, *[f"c{i}" for i in range(6)]])

    fit = cut(reduced.mapInPandas(run, f"{kinds}, " + ", ".join(f"c{i} double" for i in range(6))))
    log_gain = sum((F.col(f"c{i}") * t for i, t in enumerate(terms)), F.lit(0.0))
    mean = pixels.filter(used).join(fit, by).groupBy(*by).agg((F.sum(F.col("w") * F.exp(log_gain)) / F.sum("w")).alias("_m"))
    return fit.join(mean, by, "left").withColumn("c0", F.col("c0") - F.log("_m")).drop("_m")


class Trees:
    """Gradient-boosted trees for 0/1 labels on binned features: fit on the driver's sample, predict in pandas functions.

    A level of a tree is one histogram of gradients over (node, feature, bin); trees are complete, a node that does not
    split sends all rows left."""

    def __init__(self, rounds: int = 40, depth: int = 3, rate: float = 0.2, bins: int = 32, least_rows: int = 4):
        self.rounds, self.depth, self.rate, self.bins, self.least_rows = rounds, depth, rate, bins, least_rows

    def _binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, c, side="right") for e, c in zip(self.edges, x.T)], 1)

    def fit(self, x: np.ndarray, y: np.ndarray, w: np.ndarray | None = None) -> "Trees":
        w = np.ones(len(y)) if w is None else w
        ranks = np.arange(1, self.bins) * len(x) // self.bins
        self.edges = [np.unique(c[ranks]) for c in np.sort(x, 0).T]
        b, n_features = self._binned(x), x.shape[1]
        self.start = float(np.log((w @ y + 1e-6) / (w @ (1 - y) + 1e-6)))
        cells = b + np.arange(n_features) * self.bins
        f, self.trees = np.full(len(y), self.start), []
        for _ in range(self.rounds):
            p = 1 / (1 + np.exp(-f))
            sums = np.stack((w * (y - p), w * p * (1 - p), np.ones(len(y))))
            node, splits = np.zeros(len(y), int), []
            for level in range(self.depth):
                size = n_features * self.bins
                flat = (node[:, None] * size + cells).reshape(-1)
                hist = np.stack([np.bincount(flat, np.repeat(s, n_features), size << level) for s in sums]).reshape(3, 1 << level, n_features, self.bins)
                left = hist.cumsum(3)
                every = left[..., -1:]
                gain = (left[0] ** 2 / (left[1] + 1) + (every[0] - left[0]) ** 2 / (every[1] - left[1] + 1) - every[0] ** 2 / (every[1] + 1))[..., :-1]
                gain = gain.reshape(1 << level, -1)
                best = gain.argmax(1)
                feature, at = np.divmod(best, self.bins - 1)
                worth = (gain[np.arange(len(best)), best] > 1e-9) & (every[2, :, 0, 0] >= self.least_rows)
                at = np.where(worth, at, self.bins)
                splits.append((feature, at))
                node = 2 * node + (b[np.arange(len(y)), feature[node]] > at[node])
            g, h = (np.bincount(node, s, 1 << self.depth) for s in sums[:2])
            leaf = self.rate * g / (h + 1)
            f += leaf[node]
            self.trees.append((splits, leaf))
        return self

    def predict(self, x: np.ndarray) -> np.ndarray:
        b, rows = self._binned(x), np.arange(len(x))
        f = np.full(len(x), self.start)
        for splits, leaf in self.trees:
            node = np.zeros(len(x), int)
            for feature, at in splits:
                node = 2 * node + (b[rows, feature[node]] > at[node])
            f += leaf[node]
        return 1 / (1 + np.exp(-f))


def probabilities(df: DataFrame, model: Trees, features: list[str], out: str = "p") -> DataFrame:
    def run(batches):
        for pdf in batches:
            yield pdf.assign(**{out: model.predict(pdf[features].to_numpy(float))})

    return df.mapInPandas(run, ", ".join(f"`{c}` {t}" for c, t in df.dtypes) + f", {out} double")


def spread_out(df: DataFrame, by: list[str], x: str, y: str, k: int) -> DataFrame:
    """Farthest-point sample of k rows for each key, from the first by position on."""
    def run(key, pdf):
        pdf = pdf.sort_values([y, x]).reset_index(drop=True)
        p = pdf[[x, y]].to_numpy(float)
        chosen, far = [0], np.hypot(*(p - p[0]).T)
        while len(chosen) < min(k, len(p)):
            i = int(far.argmax())
            chosen.append(i)
            far = np.minimum(far, np.hypot(*(p - p[i]).T))
        return pdf.iloc[chosen]

    return df.groupBy(*by).applyInPandas(run, df.schema)


def placed_boxes(df: DataFrame, by: list[str], width: str, height: str, size: int, k: int, seed: int = 0) -> DataFrame:
    """k random boxes of one size that do not overlap, inside each width x height; the seed and the key fix them."""
    kinds = ", ".join(f"{c} {dict(df.dtypes)[c]}" for c in by)

    def boxes(key, w, h):
        rng = np.random.default_rng([seed, zlib.crc32(repr(key).encode())])
        out = []
        for _ in range(200 * k):
            if len(out) == k or w < size or h < size:
                break
            x, y = int(rng.integers(0, w - size + 1)), int(rng.integers(0, h - size + 1))
            if all(abs(x - a) >= size or abs(y - b) >= size for a, b in out):
                out.append((x, y))
        return out

    def run(batches):  # a key needs nothing of other rows
        for pdf in batches:
            keys = zip(*(list(pdf[c].array) for c in by))  # scalars of NumPy, as they came as keys of groups
            rows = [(*key, i, *p) for key, w, h in zip(keys, pdf[width], pdf[height]) for i, p in enumerate(boxes(key, int(w), int(h)))]
            if rows:
                yield pd.DataFrame(rows, columns=[*by, "i", "x", "y"])

    rows = df.groupBy(*by).agg(F.first(F.struct(width, height)).alias("_s")).select(*by, F.col(f"_s.{width}").alias(width), F.col(f"_s.{height}").alias(height))
    return rows.mapInPandas(run, f"{kinds}, i long, x long, y long")


def spacings(pairs: DataFrame, prior: float = 0.05):
    """Spacing of neighbouring slices from measured distances d of pairs (z_a, z_b) with weight w: nominal 1, held by the prior.

    Spark sums the pairs; the driver solves one small dense system of normal equations banded by the pairs' reach."""
    s = pairs.groupBy("z_a", "z_b").agg(F.sum("w").alias("w"), (F.sum(F.col("w") * F.col("d")) / F.sum("w")).alias("d")).toPandas()  # a row for each pair of slices
    lo, hi = int(s["z_a"].min()), int(s["z_b"].max())
    n, reach = hi - lo, int((s["z_b"] - s["z_a"]).max())
    diag, rhs = np.zeros((reach, n)), np.zeros((n, 1))
    for a, b, w, d in zip(s["z_a"] - lo, s["z_b"] - lo, s["w"], s["d"]):
        for i in range(a, b):
            diag[: b - i, i] += w
            rhs[i] += w * d
    diag[0] += prior * max(float(s["w"].median()), 1e-9)
    rhs += prior * max(float(s["w"].median()), 1e-9)
    x = solve_banded(diag, rhs)[:, 0]
    return pairs.sparkSession.createDataFrame([(lo + i, float(v)) for i, v in enumerate(x)], "z long, spacing double")


def merged_segment(places: DataFrame, segment: list[str], tile: str, most: float) -> DataFrame:
    """Median place of each tile, the smallest corner of a segment at 0, and whether the segment may be fixed: no slice is
    farther than `most` from the medians."""
    from pyspark.sql import Window as W

    m = places.groupBy(*segment, tile).agg(F.median("tx").alias("_x"), F.median("ty").alias("_y"))
    far = places.join(m, [*segment, tile]).groupBy(*segment).agg(F.max(F.hypot(F.col("tx") - F.col("_x"), F.col("ty") - F.col("_y"))).alias("_d"))
    w = W.partitionBy(*segment)
    out = m.join(far, segment).withColumn("mode", F.when(F.col("_d") <= most, "fixed").otherwise("slice"))
    return out.select(*segment, tile, "mode", (F.col("_x") - F.min("_x").over(w)).alias("tx"), (F.col("_y") - F.min("_y").over(w)).alias("ty"))


def shared_linear(points: DataFrame, pair: list[str], by: list[str]) -> DataFrame:
    """One round of a frame fit: linear part a, b, c, d common to all pairs of a key, each pair with its own shift.

    Points x, y -> u, v are centred in their pair; the 2 x 2 normal equations are sums over the key."""
    from pyspark.sql import Window as W

    w = W.partitionBy(*by, *pair)
    p = points
    for n in "xyuv":
        p = p.withColumn(f"_{n}", F.col(n) - F.avg(n).over(w))
    s = p.groupBy(*by).agg(*[F.sum(F.col(f"_{i}") * F.col(f"_{j}")).alias(i + j) for i, j in ("xx", "xy", "yy", "xu", "yu", "xv", "yv")])
    det = F.col("xx") * F.col("yy") - F.col("xy") * F.col("xy")
    out = {"a": ("xu", "yy", "yu", "xy"), "b": ("yu", "xx", "xu", "xy"), "c": ("xv", "yy", "yv", "xy"), "d": ("yv", "xx", "xv", "xy")}
    return s.select(*by, *[((F.col(p_) * F.col(q) - F.col(r_) * F.col(t)) / det).alias(n) for n, (p_, q, r_, t) in out.items()])


def patch_gains(bins: DataFrame, by: list[str], grid: int, smooth: float = 0.3, prior: float = 0.02) -> DataFrame:
    """Log gains of the patches of each tile from bins (a, pa, b, pb, gain, w): value_a = gain value_b there.

    Patches of a tile that touch like to agree; all gains have mean 1."""
    kinds = ", ".join(f"{c} {dict(bins.dtypes)[c]}" for c in by)

    def run(key, pdf):
        pdf = pdf.sort_values(["a", "pa", "b", "pb"])
        tiles = sorted({*pdf["a"], *pdf["b"]})
        n, k = len(tiles) * grid * grid, grid * grid
        at = {t: i * k for i, t in enumerate(tiles)}
        rows, y = [], []

        def row(plus, minus, w, value):
            m = np.zeros(n)
            m[plus] += w
            if minus is not None:
                m[minus] -= w
            rows.append(m)
            y.append(w * value)

        top = np.sqrt(pdf["w"].max())
        for a, pa, b, pb, gain, w in zip(pdf["a"], pdf["pa"], pdf["b"], pdf["pb"], pdf["gain"], pdf["w"]):
            row(at[a] + pa, at[b] + pb, np.sqrt(w), -np.log(gain))
        for t in tiles:
            for i in range(k):
                if (i + 1) % grid:
                    row(at[t] + i, at[t] + i + 1, smooth * top, 0)
                if i + grid < k:
                    row(at[t] + i, at[t] + i + grid, smooth * top, 0)
                row(at[t] + i, None, prior * top, 0)
        rows.append(np.full(n, 100 * top / n))
        y.append(0)
        g = np.linalg.lstsq(np.array(rows), np.array(y), rcond=None)[0]
        return pd.DataFrame([(*key, t, i, float(np.exp(g[at[t] + i]))) for t in tiles for i in range(k)])

    return bins.groupBy(*by).applyInPandas(run, f"{kinds}, tile string, patch long, gain double")


def window_affines(matches: DataFrame, by: list[str], prior: float = 1e-3) -> DataFrame:
    """Affine transforms of the tiles of a window that bring matched points (a, b, xa, ya, xb, yb, w) together.

    All tiles are pulled a little towards the identity, the first one strongly. Spark sums the products of the points of each
    two tiles; a solve sees a row for each two tiles of a window. Matches with a null don't count."""
    kinds = ", ".join(f"{c} {dict(matches.dtypes)[c]}" for c in by)
    z = ["xa", "ya", None, "xb", "yb", None]
    v = [F.lit(1.0) if c is None else F.col(c).cast("double") for c in z]
    at_ = [(i, j) for i in range(6) for j in range(i, 6)]
    sums = [F.sum(F.col("w") * v[i] * v[j]).alias(f"m{k}") for k, (i, j) in enumerate(at_)]
    rows = matches.dropna(subset=["a", "b", "xa", "ya", "xb", "yb", "w"]).groupBy(*by, "a", "b").agg(F.sum("w").alias("w"), F.max(F.greatest(*(F.abs(v[k]) for k in (0, 1, 3, 4)))).alias("top"), *sums)

    def run(key, pdf):
        pdf = pdf.sort_values(["a", "b"])
        tiles = sorted({*pdf["a"], *pdf["b"]})
        at = {t: 3 * i for i, t in enumerate(tiles)}
        n = 3 * len(tiles)
        scale = max(1.0, float(pdf["top"].max()))
        unit = np.array([1 / scale, 1 / scale, 1, -1 / scale, -1 / scale, -1])
        m, rhs = np.zeros((n, n)), np.zeros((n, 2))
        for a, b, row in zip(pdf["a"], pdf["b"], pdf[[f"m{k}" for k in range(len(at_))]].to_numpy(float)):
            i, own = np.r_[at[a] : at[a] + 3, at[b] : at[b] + 3], np.zeros((6, 6))
            for k, (p, q) in enumerate(at_):
                own[p, q] = own[q, p] = row[k]
            np.add.at(m, np.ix_(i, i), own * np.outer(unit, unit))
        weight = prior * max(float(pdf["w"].sum()) / len(tiles), 1e-9)
        for t in tiles:
            k = weight * (1e6 if t == tiles[0] else 1)
            for j, want in enumerate(((scale, 0), (0, scale), (0, 0))):
                m[at[t] + j, at[t] + j] += k
                rhs[at[t] + j] += k * np.array(want)
        x = np.linalg.solve(m, rhs)
        return pd.DataFrame([(*key, t, *(float(c) for c in (x[at[t], 0] / scale, x[at[t] + 1, 0] / scale, x[at[t] + 2, 0], x[at[t], 1] / scale, x[at[t] + 1, 1] / scale, x[at[t] + 2, 1]))) for t in tiles])

    return rows.groupBy(*by).applyInPandas(run, f"{kinds}, tile string, a double, b double, tx double, c double, d double, ty double")


#: Pairs of points whose slopes are held at once.
_SLOPES = 4_000_000


def _inversions(p: np.ndarray):
    """The pairs k < l of a permutation with p[k] > p[l], as (first and last of the larger values, in a list of places; the
    smaller values), bit by bit: among places that share the higher bits, zeros that come after ones."""
    for b in range(max(1, int(len(p) - 1).bit_length()) - 1, -1, -1):
        one = (p >> b & 1).astype(np.int64)
        before = np.cumsum(one) - one
        start = p >> (b + 1) << (b + 1)  # the places that share the higher bits lie together from here on
        ones = before - before[start]
        ones_from = start + np.minimum(1 << b, len(p) - start)
        at = np.where(one == 1, ones_from + ones, np.arange(len(p)) - ones)
        new = np.empty_like(p)
        new[at] = p
        zero = (one == 0) & (ones > 0)
        yield new, ones_from[zero], ones[zero], p[zero]
        p = new


def median_slope(n: np.ndarray, x: np.ndarray, sample: int = 100_000) -> float | None:
    """Median of (x_j - x_i) / (n_j - n_i) over all pairs of points, n ascending; memory grows with the points.

    Of many points, slopes of a sample of pairs give two bounds. The order of x - s n tells how many slopes are at most s: its
    inversions. Halving brings the bounds nearer, then the two orders differ in few pairs, which are looked at one by one."""
    total = len(x) * (len(x) - 1) // 2
    if not total:
        return None
    if total <= _SLOPES:
        i, j = np.triu_indices(len(x), 1)
        s = np.sort((x[j] - x[i]) / (n[j] - n[i]))
        return float(0.5 * s[(total - 1) // 2] + 0.5 * s[total // 2])
    rng = np.random.default_rng(0)
    i, j = np.sort(rng.integers(0, len(x), (max(sample, len(x)), 2)), 1).T
    i, j = i[i < j], j[i < j]
    drawn = np.sort((x[j] - x[i]) / (n[j] - n[i]))
    place = np.arange(len(x))
    n, width = n.astype(float), 4 / np.sqrt(len(drawn))

    def ordered(s):
        return place if s == -np.inf else place[::-1] if s == np.inf else np.lexsort((-place, x - s * n))

    def counted(order):
        return sum(int(c.sum()) for _, _, c, _ in _inversions(order))

    while True:
        ends = [(0.5 - width) * len(drawn), (0.5 + width) * len(drawn)] if np.isfinite(x).all() else [-1, len(drawn)]
        bounds = [-np.inf if k < 0 else np.inf if k >= len(drawn) else drawn[int(k)] for k in ends]
        orders = [ordered(s) for s in bounds]
        below, upto = (counted(o) for o in orders)
        width *= 2
        if below > (total - 1) // 2 or total // 2 >= upto:
            continue
        while upto - below > _SLOPES and np.isfinite(bounds).all() and bounds[1] - bounds[0] > 1e-9 * max(map(abs, bounds)):
            s = (bounds[0] + bounds[1]) / 2
            o = ordered(s)
            if (k := counted(o)) > total // 2:
                bounds[1], orders[1], upto = s, o, k
            elif k <= (total - 1) // 2:
                bounds[0], orders[0], below = s, o, k
            else:
                break
        first, last = (total - 1) // 2 - below, total // 2 - below
        rank = np.empty_like(place)
        rank[orders[0]] = place
        values, counts = np.zeros(0), np.zeros(0, np.int64)
        for listed, start, many, small in _inversions(rank[orders[1]]):
            cuts = np.flatnonzero(np.diff(np.cumsum(many) // _SLOPES, prepend=0))
            for a, c, v in zip(*(np.split(y, cuts) for y in (start, many, small))):
                large = listed[np.repeat(a - np.cumsum(c) + c, c) + np.arange(c.sum())]
                k, l = orders[0][np.repeat(v, c)], orders[0][large]  # noqa: E741
                s, m = np.unique((x[l] - x[k]) / (n[l] - n[k]), return_counts=True)
                values, at = np.unique(np.concatenate((values, s)), return_inverse=True)
                counts = np.bincount(at.reshape(-1), np.concatenate((counts, m)), len(values)).astype(np.int64)
        upper = np.cumsum(counts)
        lo, hi = (values[np.searchsorted(upper, r, side="right")] for r in (first, last))
        # the orders are those of rounded numbers: a slope next to a bound may be on its wrong side
        slack = [1e-15 * (np.abs(x).max() + abs(s) * (abs(n[0]) + abs(n[-1]))) * 4 if np.isfinite(s) else 0.0 for s in bounds]
        if (np.isinf(bounds[0]) or lo > bounds[0] + slack[0]) and (np.isinf(bounds[1]) or hi < bounds[1] - slack[1]):
            return float(0.5 * lo + 0.5 * hi)


def median_slopes(df: DataFrame, by: list[str], n: str, x: str) -> DataFrame:
    """by, slope: the median slope of all pairs of points (n, x) of a key; null where no pair has values, no row for one point.

    A task holds the points of one key, never their pairs."""
    kinds = ", ".join(f"{c} {dict(df.dtypes)[c]}" for c in by)

    def run(key, pdf):
        if len(pdf) < 2:
            return pd.DataFrame()
        pdf = pdf.dropna().sort_values(n)
        return pd.DataFrame({**{c: [k] for c, k in zip(by, key)}, "slope": pd.Series([median_slope(pdf[n].to_numpy(), pdf[x].to_numpy(float))], dtype=float)})

    return df.select(*by, n, x).groupBy(*by).applyInPandas(run, f"{kinds}, slope double")
