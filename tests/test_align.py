"""The global affine solve against a dense one and planted transforms; frame chains with gaps."""

import numpy as np
from pyspark.sql import functions as F

from sectile.operators import align
from sectile.plans import q_align

D = "/root/testdata/sf0.001"
NAMES = ("a00", "a01", "tx", "a10", "a11", "ty")


def dense(points, smooth, pull, reject, rounds):
    """The same least squares as one matrix: rows of equations, no blocks and no segments."""
    p = {c: points[c].to_numpy(float) for c in ("xa", "ya", "xb", "yb", "w")}
    zs = np.unique(points[["z_a", "z_b"]].to_numpy())
    ia, ib = np.searchsorted(zs, points["z_a"]), np.searchsorted(zs, points["z_b"])
    cx, cy = p["xa"].mean(), p["ya"].mean()
    s = np.sqrt(p["xa"].var() + p["ya"].var())
    n, keep = len(zs), np.ones(len(points), bool)

    def basis(x, y):
        return np.column_stack(((x - cx) / s, (y - cy) / s, np.ones(len(x))))

    ha, hb = basis(p["xa"], p["ya"]), basis(p["xb"], p["yb"])
    for k in range(rounds + 1):
        if k:
            e = np.hypot(*(np.column_stack((p["xa"], p["ya"])) + s * np.einsum("nh,nhc->nc", ha, u[ia]) - np.column_stack((p["xb"], p["yb"])) - s * np.einsum("nh,nhc->nc", hb, u[ib])).T)
            half = lambda v: np.sort(v)[(len(v) + 1) // 2 - 1]
            limit = max(reject, 3 * 1.4826 * half(e))
            link = ia * n + ib
            mid = {x: half(e[link == x]) for x in np.unique(link)}
            worst = {i: max(v for x, v in mid.items() if i in (x // n, x % n)) for i in range(n)}
            lost = [x for x, v in mid.items() if v > limit and v >= max(worst[x // n], worst[x % n])]
            keep = ((e <= limit) | (e <= 2 * np.array([mid[x] for x in link]))) & ~np.isin(link, lost)
        at = np.flatnonzero(keep)
        a = np.zeros((len(at), n, 3))
        a[np.arange(len(at)), ia[at]] = ha[at]
        a[np.arange(len(at)), ib[at]] -= hb[at]
        d = np.column_stack((p["xb"] - p["xa"], p["yb"] - p["ya"]))[at] / s
        w = np.sqrt(p["w"][at])[:, None]
        rows, right = [a.reshape(len(at), -1) * w], [d * w]
        link = ia[at] * n + ib[at]
        weights = np.sort([p["w"][at][link == x].sum() for x in np.unique(link)])
        lam = smooth * weights[(len(weights) + 1) // 2 - 1]
        for i in range(n - 1):
            for h in range(3):
                row = np.zeros((n, 3))
                row[i, h], row[i + 1, h] = 1, -1
                rows.append(np.sqrt(lam) * row.reshape(1, -1))
                right.append(np.zeros((1, 2)))
        for x in np.unique(link):
            weight = max(p["w"][at][link == x].sum(), 1)
            for i in (x // n, x % n):
                for h in range(2):
                    row = np.zeros((n, 3))
                    row[i, h] = 1
                    rows.append(np.sqrt(pull * weight) * row.reshape(1, -1))
                    right.append(np.zeros((1, 2)))
        m = np.concatenate(rows)[:, 3:]
        u = np.concatenate((np.zeros((3, 2)), np.linalg.lstsq(m, np.concatenate(right), rcond=None)[0])).reshape(n, 3, 2)
    out = {}
    for i, z in enumerate(zs):
        lin = np.eye(2) + u[i, :2].T
        t = s * u[i, 2] - u[i, :2].T @ (cx, cy)
        out[int(z)] = (lin[0, 0], lin[0, 1], t[0], lin[1, 0], lin[1, 1], t[1])
    return out


def test_query_equals_a_dense_solve(spark):
    tables = lambda name: spark.read.parquet(f"{D}/{name}.parquet")
    want = dense(q_align.slice_points(tables).toPandas(), 1e-3, 1e-3, 5.0, 3)
    from sectile.plans.registry import QUERIES

    got = {r.z: tuple(r[c] for c in NAMES) for r in QUERIES["nu15_slice_affines"](spark, D).collect()}
    assert set(got) == set(want) and len(got) > 10
    for z in want:
        assert np.allclose(got[z], want[z], atol=2e-4, rtol=1e-4), z


def test_segments_give_what_one_system_gives(spark):
    tables = lambda name: spark.read.parquet(f"{D}/{name}.parquet")
    p = q_align.slice_points(tables).filter("z_a <> z_b").withColumn("z_a", F.col("z_a") + 10 * F.pmod("xa", F.lit(6)).cast("int")).withColumn("z_b", F.col("z_a") + 1 + F.pmod("ya", F.lit(3)).cast("int"))
    one = {r.z: tuple(r[c] for c in NAMES) for r in align.slice_affines(p, rounds=0).collect()}
    many = {r.z: tuple(r[c] for c in NAMES) for r in align.slice_affines(p, rounds=0, segment=12, least=8).collect()}
    assert set(one) == set(many) and len(one) > 50
    assert max(np.abs(np.subtract(one[z], many[z])).max() for z in one) < 1e-6


def parts(sin, cos, z):
    return sin(z / 50) / 100, cos(z / 70) / 120 - 1 / 120, sin(z / 300) * 40, z * 0.01


def planted(spark, n, wrong):
    """Every slice has its own turn, scale and drift; each meets the next two in eight points."""
    pairs = spark.range(n).select(F.col("id").alias("z_a"), F.explode(F.array(F.lit(1), F.lit(2))).alias("d")).filter(F.col("z_a") + F.col("d") < n)
    pts = pairs.withColumn("j", F.explode(F.sequence(F.lit(0), F.lit(7)))).withColumn("z_b", F.col("z_a") + F.col("d"))
    h = F.xxhash64("z_a", "d", "j")
    pts = pts.withColumn("x", F.pmod(h, F.lit(2000)).cast("double")).withColumn("y", F.pmod(F.shiftright(h, 20), F.lit(2000)).cast("double"))

    def seen(z):
        turn, scale, sx, sy = parts(F.sin, F.cos, z)
        return (1 + scale) * F.col("x") - turn * F.col("y") + sx, turn * F.col("x") + (1 + scale) * F.col("y") + sy

    (xa, ya), (xb, yb) = seen(F.col("z_a")), seen(F.col("z_b"))
    off = F.when(F.col("z_a").isin(*wrong) & (F.col("d") == 1), 300.0).otherwise(0.0)
    return pts.select("z_a", "z_b", xa.alias("xa"), ya.alias("ya"), (xb + off).alias("xb"), yb.alias("yb"), F.lit(1.0).alias("w"))


def worst(out):
    """The farthest that a transform puts what its slice shows from where it is."""
    got = out.toPandas().sort_values("z")
    turn, scale, sx, sy = parts(np.sin, np.cos, got["z"].to_numpy(float))
    far = 0.0
    for x, y in ((100.0, 100.0), (1900.0, 200.0), (1000.0, 1800.0)):
        px, py = (1 + scale) * x - turn * y + sx, turn * x + (1 + scale) * y + sy
        far = max(far, np.abs(got.a00 * px + got.a01 * py + got.tx - x).max(), np.abs(got.a10 * px + got.a11 * py + got.ty - y).max())
    return len(got), far


def test_planted_affines_of_ten_thousand_slices(spark):
    n, far = worst(align.slice_affines(planted(spark, 10_000, [-1]), smooth=1e-9, pull=0.0, rounds=0))
    assert n == 10_000 and far < 1e-4


def test_a_wrong_pair_goes(spark):
    points = planted(spark, 400, [200])
    assert worst(align.slice_affines(points, smooth=1e-9, pull=0.0, rounds=0))[1] > 10
    assert worst(align.slice_affines(points, smooth=1e-9, pull=0.0, rounds=1))[1] < 1e-4


def test_chain_stops_at_a_missing_change(spark):
    rows = [("p", r, 1.0, 0.0, 2.0, 0.0, 1.0, -1.0) for r in (0, 1, 2, 4)] + [("q", 7, 2.0, 0.0, 0.0, 0.0, 2.0, 1.0)]
    ch = spark.createDataFrame(rows, "g string, run long, a double, b double, tx double, c double, d double, ty double")
    ref = spark.createDataFrame([("p", 1), ("q", 8), ("r", 3)], "g string, run long")
    got = {(x.g, x.run): (x.linked, x.a, x.tx, x.ty) for x in align.chained(ch, ["g"], "run", ref).collect()}
    assert got["p", 0] == (True, 1.0, 2.0, -1.0) and got["p", 1] == (True, 1.0, 0.0, 0.0) and got["p", 3] == (True, 1.0, -4.0, 2.0)
    assert got["p", 4] == got["p", 5] == (False, None, None, None)
    assert got["q", 7] == (True, 2.0, 0.0, 1.0) and got["r", 3] == (True, 1.0, 0.0, 0.0)
