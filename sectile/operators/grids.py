"""Smooth fields on grids: warps within a tile, and gain and offset of tile patches, with a membrane penalty.

Spark reduces points to the normal equations of a grid's nodes (a few sums for each two nodes that share a cell); a task then
solves one grid, whose size does not depend on the number of points.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _membrane(n: int, m: int) -> np.ndarray:
    """Sum of squared differences of neighbouring nodes of an n x m grid (rows x columns), as a matrix."""
    at = np.arange(n * m).reshape(n, m)
    i = np.concatenate((at[:, :-1].ravel(), at[:-1].ravel()))
    j = np.concatenate((at[:, 1:].ravel(), at[1:].ravel()))
    out = np.zeros((n * m, n * m))
    for a, b, s in ((i, i, 1), (j, j, 1), (i, j, -1), (j, i, -1)):
        np.add.at(out, (a, b), s)
    return out


def _corners(x: Column, y: Column, size: tuple[float, float], nodes: tuple[int, int]) -> list[tuple[Column, Column]]:
    """(node, bilinear weight) of the four nodes around a point; points outside count at the edge."""
    (w, h), (n, m) = size, nodes
    u = F.greatest(F.lit(0.0), F.least(x / w * (m - 1), F.lit(float(m - 1))))
    v = F.greatest(F.lit(0.0), F.least(y / h * (n - 1), F.lit(float(n - 1))))
    i, j = F.least(F.floor(u), F.lit(m - 2)), F.least(F.floor(v), F.lit(n - 2))
    p, q = u - i, v - j
    return [((j + b) * m + i + a, (p if a else 1 - p) * (q if b else 1 - q)) for b in (0, 1) for a in (0, 1)]


def fitted_grids(points: DataFrame, by: list[str], x: str, y: str, values: list[str], weight: str, size: tuple[float, float], nodes: tuple[int, int], stiffness: float, pull: float = 1e-6) -> DataFrame:
    """by, gy, gx and a column for each of values: node values of the bilinear field that fits the points, as smooth as asked.

    Least squares of (field - value) weighted by `weight`, plus stiffness times the squared differences of neighbouring nodes
    and a slight pull to 0, both in shares of the mean weight of a node. size: width and height that the grid spans."""
    n, m = nodes
    corners = _corners(F.col(x), F.col(y), size, nodes)
    both = [(k, l) for k in range(4) for l in range(k, 4)]
    # points of a cell have the same four nodes, so a point adds to one row of sums
    rows = points.select(*by, corners[0][0].cast("int").alias("_i"), F.col(weight).alias("_w"), *(s.alias(f"_s{k}") for k, (_, s) in enumerate(corners)), *(F.col(v).alias(f"_v{i}") for i, v in enumerate(values)))
    rows = rows.groupBy(*by, "_i").agg(
        *(F.sum(F.col("_w") * (F.col(f"_s{k}") * F.col(f"_s{l}"))).alias(f"_g{k}{l}") for k, l in both),
        *(F.sum(F.col("_w") * (F.col(f"_s{k}") * F.col(f"_v{i}"))).alias(f"_r{k}{i}") for k in range(4) for i in range(len(values))),
    )
    smooth = _membrane(n, m)

    def run(key, pdf):
        left, right = np.zeros((n * m, n * m)), np.zeros((n * m, len(values)))
        pdf = pdf.sort_values("_i").fillna(0.0)  # a sum of nulls only
        at = pdf["_i"].to_numpy()[:, None] + np.array([0, 1, m, m + 1])
        for k, l in both:  # noqa: E741
            np.add.at(left, (at[:, k], at[:, l]), pdf[f"_g{k}{l}"])
            if k != l:
                np.add.at(left, (at[:, l], at[:, k]), pdf[f"_g{k}{l}"])
        for k in range(4):
            np.add.at(right, at[:, k], pdf[[f"_r{k}{i}" for i in range(len(values))]].to_numpy())
        typical = max(left.sum() / (n * m), 1e-12)
        f = np.linalg.solve(left + typical * (stiffness * smooth + pull * np.eye(n * m)), right)
        return pd.DataFrame([(*key, k // m, k % m, *map(float, f[k])) for k in range(n * m)])

    kinds = ", ".join(f"`{c}` {dict(points.dtypes)[c]}" for c in by)
    return rows.groupBy(*by).applyInPandas(run, f"{kinds}, gy long, gx long, " + ", ".join(f"`{v}` double" for v in values))


def warp_grids(matches: DataFrame, by: list[str], size: tuple[float, float], nodes: tuple[int, int], stiffness: float = 0.05) -> DataFrame:
    """by, gy, gx, dx, dy: the warp within each tile that takes its points (x, y) to where they belong (u, v), weight w."""
    d = matches.withColumns({"dx": F.col("u") - F.col("x"), "dy": F.col("v") - F.col("y")})
    return fitted_grids(d, by, "x", "y", ["dx", "dy"], "w", size, nodes, stiffness)


def patch_balance(bins: DataFrame, by: list[str], grid: int, smooth: float = 0.3, prior: float = 0.02, least_contrast: float = 0.0) -> DataFrame:
    """by, tile, patch, gain, offset: brightness gain and offset of the patches of each tile.

    bins: by, a, pa, b, pb (patches that overlap), gain and offset of the relation value_a = gain * value_b + offset, middle
    (mean value of b there), contrast, w. Relations of less contrast than `least_contrast` say nothing of gains; others weigh
    by their contrast. First the log gains are solved, then the offsets that make the balanced values equal at the middle;
    neighbouring patches of a tile like to agree, gains have mean 1, offsets sum 0. Spark sums a row for each two patches."""
    use = F.when(F.col("contrast") >= least_contrast, F.col("w") * F.col("contrast")).otherwise(0.0)
    keys = [*by, "a", "pa", "b", "pb"]
    rows = bins.groupBy(*keys).agg(F.sum(use).alias("wg"), F.sum(use * -F.log("gain")).alias("lg"), F.sum("w").alias("wo"), F.sum(F.col("w") * F.col("middle")).alias("mb"), F.sum(F.col("w") * (F.col("gain") * F.col("middle") + F.col("offset"))).alias("ma"))
    k = grid * grid
    smooth_one = _membrane(grid, grid)

    def run(key, pdf):
        tiles = np.unique(pdf[["a", "b"]].to_numpy().astype(str))
        i, j = (np.searchsorted(tiles, pdf[c].to_numpy().astype(str)) * k + pdf[p].to_numpy() for c, p in (("a", "pa"), ("b", "pb")))
        n = len(tiles) * k

        def solved(w, value):
            """x that minimises sum w (x_i - x_j)^2 - 2 value (x_i - x_j), plus the membrane of each tile and the prior."""
            top = max(float(w.max()), 1e-12)
            left = np.kron(np.eye(len(tiles)), smooth**2 * top * smooth_one) + prior**2 * top * np.eye(n) + (100 / n) ** 2 * top
            right = np.zeros(n)
            for p, q, s in ((i, i, 1), (j, j, 1), (i, j, -1), (j, i, -1)):
                np.add.at(left, (p, q), s * w)
            np.add.at(right, i, value)
            np.add.at(right, j, -value)
            return np.linalg.solve(left, right)

        g = np.exp(solved(pdf["wg"].to_numpy(), pdf["lg"].to_numpy()))
        g *= n / g.sum()
        o = solved(pdf["wo"].to_numpy(), g[j] * pdf["mb"].to_numpy() - g[i] * pdf["ma"].to_numpy())
        return pd.DataFrame([(*key, t, p, float(g[x * k + p]), float(o[x * k + p])) for x, t in enumerate(tiles) for p in range(k)])

    kinds = ", ".join(f"`{c}` {dict(bins.dtypes)[c]}" for c in by)
    return rows.groupBy(*by).applyInPandas(run, f"{kinds}, tile string, patch long, gain double, offset double")
