"""Tile solves against transforms that are known, and searches against plain loops."""

import numpy as np
import pytest

from sectile.operators import stitching as st


def ring(model, seed=1, noise=0.0, n_points=40):
    """Transforms of four tiles in a ring, and (a, b, p, q) of each two neighbours in their common strip."""
    r = np.random.default_rng(seed)
    turns = np.array([0, 0.003, -0.002, 0.004]) * (model != "translation")
    scale = np.array([1, 1.002, 0.999, 1.001]) if model in ("similarity", "affine") else np.ones(4)
    t = np.zeros((4, 2, 3))
    for i, (x, y) in enumerate(((0, 0), (180, 3), (-2, 170), (178, 175))):
        c, s = scale[i] * np.cos(turns[i]), scale[i] * np.sin(turns[i])
        t[i] = [[c, -s, x], [s, c, y]]
    if model == "affine":
        t[1:, 0, 1] += 0.004
    out = []
    for a, b in ((0, 1), (0, 2), (1, 3), (2, 3)):
        side = (a, b) in ((0, 1), (2, 3))
        world = r.uniform((180, 0) if side else (0, 172), (200, 200), (n_points, 2)) + (0, 172 * ((a, b) == (2, 3)))
        p, q = ((world - t[i][:, 2]) @ np.linalg.inv(t[i][:, :2]).T + r.normal(0, noise, world.shape) for i in (a, b))
        out.append((a, b, p, q))
    return t, out


def pairs(links, model, pull=0.1):
    n, m = [], []
    for _, _, p, q in links:
        z = np.column_stack((p, np.ones(len(p)), q, np.ones(len(p))))
        n.append(len(p))
        m.append(z.T @ z)
    return st.Pairs(4, np.array([x[0] for x in links]), np.array([x[1] for x in links]), np.array(n), np.array(m), model, pull)


def solved(p, use=None):
    use = np.ones((1, len(p.a)), bool) if use is None else use[None]
    x = p.solve(use)
    return p.transforms(x[0]), p.rms(x)[0]


def errors(t, links):
    return [np.sqrt((((p @ t[a][:, :2].T + t[a][:, 2]) - (q @ t[b][:, :2].T + t[b][:, 2])) ** 2).sum(1).mean()) for a, b, p, q in links]


@pytest.mark.parametrize("model", list(st.BASES))
def test_solve_from_moments_finds_the_transforms(model):
    t, links = ring(model)
    got, rms = solved(pairs(links, model, pull=1e-9))
    assert np.allclose(got[:, :, :2], t[:, :, :2], atol=2e-4) and np.allclose(got[:, :, 2], t[:, :, 2], atol=0.05)
    assert rms.max() < 0.05


@pytest.mark.parametrize("model", ["translation", "similarity", "affine"])
def test_rms_from_moments_is_that_of_the_points(model):
    _, links = ring("affine", noise=0.7)
    t, rms = solved(pairs(links, model))
    assert np.allclose(rms, errors(t, links), rtol=1e-6)


def test_pull_keeps_thin_strips_from_shearing():
    t, links = ring("rigid", noise=0.5)
    free, pulled = solved(pairs(links, "affine"))[0], solved(pairs(links, "affine_rigid", 0.5))[0]
    assert np.abs(pulled - t)[:, :, :2].max() < np.abs(free - t)[:, :, :2].max()


def test_one_bad_pair_of_a_ring_is_ambiguous_and_with_diagonals_is_found():
    t, links = ring("translation")
    a, b, p, q = links[2]
    links[2] = a, b, p, q + 30
    use, why = st.closing(pairs(links, "translation"), 2.0)
    assert use is None and "no single pair" in why
    at = np.array([[190.0, 185.0], [185.0, 190.0]])
    links += [(a, b, at, at + t[a][:, 2] - t[b][:, 2]) for a, b in ((0, 3), (1, 2))]
    p = pairs(links, "translation")
    use, why = st.closing(p, 2.0)
    assert why == "" and use.tolist() == [True, True, False, True, True, True] and np.abs(solved(p, use)[0] - t).max() < 1e-6


def test_leave_one_out_is_a_solve_of_the_others():
    _, links = ring("translation", noise=2.0)
    p = pairs(links, "translation")
    want = max(errors(solved(pairs(links[:k] + links[k + 1 :], "translation"))[0], [links[k]])[0] for k in range(4))
    assert np.isclose(p.left_out(np.ones((1, 4), bool))[0], want)


def rows_of(z, links):
    return [(z, f"{a}", f"{b}", *map(float, x), *map(float, y)) for a, b, p, q in links for x, y in zip(p, q)]


POINTS = "z long, a string, b string, xa double, ya double, xb double, yb double"


def test_solved_tiles_by_slice(spark):
    rows = [x for z in (1, 2) for x in rows_of(z, ring("rigid", seed=z)[1])]
    rows += [(3, "0", "1", 1.0, 2.0, 3.0, 4.0), (3, "5", "6", 1.0, 2.0, 3.0, 4.0)]
    out = {(r.z, r.tile): r for r in st.solved_tiles(spark.createDataFrame(rows, POINTS), ["z"], "rigid", 1.0, loops=True).collect()}
    assert all(out[z, "3"].ok and abs(out[z, "3"].tx - 178) < 0.1 for z in (1, 2))
    assert not out[3, "0"].ok and "not linked" in out[3, "0"].reason


def test_far_matches_are_filtered(spark):
    t, links = ring("rigid", noise=0.1)
    for _, _, _, q in links:
        q[::13] += 40
    whole = sum(len(q) for *_, q in links)
    far = sum(len(q[::13]) for *_, q in links)
    df = spark.createDataFrame(rows_of(1, links) + rows_of(2, ring("rigid", seed=5)[1]), POINTS)
    out = {(r.z, r.tile): r for r in st.solved_tiles(df, ["z"], "rigid", 1.0).collect()}
    assert out[1, "0"].matches == whole - far and out[1, "0"].ok
    assert abs(out[1, "3"].tx - t[3][0, 2]) < 0.5 and out[2, "0"].ok
    strict = st.solved_tiles(df, ["z"], "rigid", 0.0).collect()
    assert all(not r.ok and "rms" in r.reason for r in strict)


def test_query_leaves_out_the_wrong_pair(spark):
    """Shifts are those that the matches were made with; slices with a wrong pair lose its matches and no others."""
    from sectile.plans import q_stitch
    from sectile.plans.registry import QUERIES

    d = "/root/testdata/sf0.001"
    m = q_stitch.loop_matches(lambda name: spark.read.parquet(f"{d}/{name}.parquet"))
    n = {(r.z, r.a, r.b): r.n for r in m.groupBy("z", "a", "b").count().withColumnRenamed("count", "n").collect()}
    got = QUERIES["nu10_loops"](spark, d).collect()
    assert len({r.z for r in got}) >= 9 and all(r.ok for r in got)
    for r in got:
        k = int(r.tile)
        assert abs(r.tx - (100 * (k - 1) + (r.z * k) % 7 - r.z % 7)) < 0.05 and abs(r.ty - ((r.z + k) % 5 - (r.z + 1) % 5)) < 0.05
        mine = sum(v for (z, a, b), v in n.items() if z == r.z)
        assert r.matches == mine - (n[r.z, "2", "3"] if r.z % 3 == 0 else 0)


def test_bisection_finds_a_jump(spark):
    from pyspark.sql import functions as F

    positions = spark.range(200).selectExpr("id % 2 AS g", "id div 2 AS i")
    asked = []

    def measure(at):
        asked.append(at.count())
        return at.withColumn("v", F.when(F.col("g") * 20 + F.col("i") > 57, 100.0).otherwise(0.0))

    got = st.bisected(positions, F.col("i") % 33 == 0, measure, lambda a, b: F.abs(F.col(a) - F.col(b)), ["g"], "i", "v", 1.0).collect()
    for g, jump in ((0, 57), (1, 37)):
        v = {r.i: r.v for r in got if r.g == g}
        assert v[jump] == 0 and v[jump + 1] == 100 and len(v) < 14
    assert sum(asked) == len(got)
