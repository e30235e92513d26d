"""Grid fields against dense least squares and known distortions."""

import numpy as np

from sectile.operators import grids
from sectile.plans import q_align
from sectile.plans.registry import QUERIES

D = "/root/testdata/sf0.01"
POINTS = "g string, x double, y double, u double, v double, w double"


def weights(x, y, size, nodes):
    n, m = nodes
    u, v = np.clip(x / size[0] * (m - 1), 0, m - 1), np.clip(y / size[1] * (n - 1), 0, n - 1)
    i, j = np.minimum(np.floor(u), m - 2).astype(int), np.minimum(np.floor(v), n - 2).astype(int)
    out = np.zeros((len(x), n * m))
    for b in (0, 1):
        for a in (0, 1):
            out[np.arange(len(x)), (j + b) * m + i + a] += np.where(a, u - i, 1 - u + i) * np.where(b, v - j, 1 - v + j)
    return out


def test_equals_dense_least_squares(spark):
    r = np.random.default_rng(1)
    x, y = r.uniform(-5, 105, 60), r.uniform(-5, 85, 60)  # a few points lie outside
    u, v, w = x + r.normal(0, 3, 60), y + r.normal(0, 3, 60), r.uniform(0.1, 2, 60)
    rows = [("a", *map(float, p)) for p in zip(x, y, u, v, w)] + [("b", 1.0, 1.0, 3.0, 0.0, 1.0)]
    got = {(q.g, q.gy, q.gx): (q.dx, q.dy) for q in grids.warp_grids(spark.createDataFrame(rows, POINTS), ["g"], (100.0, 80.0), (4, 5), 0.1).collect()}
    b = weights(x, y, (100, 80), (4, 5))
    typical = (b.T @ (w[:, None] * b)).sum() / 20
    rows_ = [np.sqrt(w)[:, None] * b]
    for k in range(20):
        for j in ((k + 1,) if k % 5 < 4 else ()) + ((k + 5,) if k < 15 else ()):
            d = np.zeros((1, 20))
            d[0, k], d[0, j] = 1, -1
            rows_.append(np.sqrt(0.1 * typical) * d)
    rows_.append(np.sqrt(1e-6 * typical) * np.eye(20))
    a = np.concatenate(rows_)
    right = np.zeros((len(a), 2))
    right[:60] = np.sqrt(w)[:, None] * np.column_stack((u - x, v - y))
    want = np.linalg.lstsq(a, right, rcond=None)[0]
    assert np.allclose([got["a", k // 5, k % 5] for k in range(20)], want, atol=1e-8)
    assert abs(got["b", 0, 0][0] - 2) < 0.01 and abs(got["b", 3, 4][0] - 2) < 0.01  # one point moves the whole tile


def test_query_fits_what_no_affine_can(spark):
    p = q_align.warp_points(lambda name: spark.read.parquet(f"{D}/{name}.parquet")).filter("z = 3 AND tile = 2").toPandas()
    out = [q for q in QUERIES["nu18_warp_grids"](spark, D).collect() if (q.z, q.tile) == (3, 2)]
    f = np.zeros((99, 2))
    for q in out:
        f[q.gy * 11 + q.gx] = q.dx, q.dy
    x, y = p["x"].to_numpy(), p["y"].to_numpy()
    d = np.column_stack((p["u"] - x, p["v"] - y))
    left = d - weights(x, y, (1000, 800), (9, 11)) @ f
    flat = np.column_stack((x, y, np.ones(len(x))))
    affine = d - flat @ np.linalg.lstsq(flat, d, rcond=None)[0]
    assert len(out) == 99 and np.sqrt((left**2).mean()) < 0.15 < 1.0 < np.sqrt((affine**2).mean())


def test_patch_query_recovers_gains_and_offsets(spark):
    got = {(q.tile, q.patch): (q.gain, q.offset) for q in QUERIES["nu24_patch_balance"](spark, D).collect() if q.z == 4}
    assert len(got) == 54
    gain = np.array([1 + int(t) / 50 + p / 200 for t, p in got])
    gain *= len(gain) / gain.sum()
    offset = np.array([int(t) - p / 4 for t, p in got])
    have = np.array(list(got.values()))
    assert np.abs(have[:, 0] - gain).max() < 0.01
    # offsets are in the scale of the balanced values, whose mean gain is 1, and sum to nothing
    scale = gain[0] / (1 + int(next(iter(got))[0]) / 50 + next(iter(got))[1] / 200)
    assert np.abs(have[:, 1] - (offset - offset.mean()) * scale).max() < 0.35
