"""The search for pairs from coarse to fine, and matching again within a distorted tile."""

import numpy as np
from pyspark.sql import functions as F

from sectile.operators import matching as m
from sectile.plans import q_align

D = "/root/testdata/sf0.01"


def test_wrong_and_empty_levels_go_on_and_the_frontier_shrinks(spark):
    k = q_align.word_keypoints(lambda name: spark.read.parquet(f"{D}/{name}.parquet"))
    pairs = k.select("z").distinct().select("z", F.lit(0).alias("a"), F.lit(1).alias("b"), F.lit(500.0).alias("ex"), F.lit(0.0).alias("ey"))
    out, sizes = m.search_pairs(k, pairs, "z", [4, 2, 1], 60.0, 4.0)
    got = out.collect()
    assert len(got) == sizes[0] > 90 and sizes[0] > sizes[1] and sizes[1] < 0.5 * sizes[0]
    for r in got:
        assert r.ok and abs(r.dx - (500 + r.z % 3)) < 1e-6 and abs(r.dy - 12) < 1e-6, r
        assert (r.level == 4) == (r.z % 5 != 0 and r.z % 7 != 0)


def test_gates(spark):
    found = spark.createDataFrame([(z, 0, 1, 10.0 + 80 * (z == 3), 0.0) for z in range(6)] + [(9, 0, 2, 1.0, 1.0)], "z long, a int, b int, dx double, dy double")
    got = {(r.z, r.b): r.agrees for r in m.agreeing(found, found, "z", 3, 5.0).collect()}
    assert got[3, 1] is False and got[2, 1] is True and got[9, 2] is None
    k = spark.createDataFrame([(1, tile, 1, w, float(w), 0.0 if tile == 0 else float(w % 2) * 30) for tile in (0, 1) for w in range(12)], "z long, tile int, level int, word long, x double, y double")
    pairs = spark.createDataFrame([(1, 0, 1, 0.0, 0.0), (2, 0, 1, 0.0, 0.0)], "z long, a int, b int, ex double, ey double")
    out = {r.z: r for r in m.search_pairs(k, pairs, "z", [1], 20.0, 2.0)[0].collect()}
    assert out[1].n == 6 and not out[2].ok and out[2].reason == "few matches" and not out[1].ok and out[1].reason == "not plausible"


def test_repeated_words_do_not_match(spark):
    rows = [(1, 0, 7, float(i), 0.0) for i in range(50)] + [(1, 1, 7, 3.0, 0.0), (1, 0, 8, 1.0, 1.0), (1, 1, 8, 0.0, 0.0)]
    k = spark.createDataFrame(rows, "z long, tile int, word long, x double, y double")
    out = m.voted_offsets(m.unique_words(k, ["z", "tile"]), spark.createDataFrame([(1, 0, 1)], "z long, a int, b int"), ["z"], 2.0).collect()
    assert [(r.dx, r.dy, r.n) for r in out] == [(1.0, 1.0, 1)]


def test_matches_spread_over_a_tile_that_is_distorted_within_itself(spark):
    """The displacement changes by 60 px over the tile, the radius is 12: only what spreads from the seeds finds the far side."""
    r = np.random.default_rng(3)
    n = 900
    x, y = r.uniform(0, 900, n), r.uniform(0, 900, n)
    bend = 60 * (x / 900) ** 2
    d = r.normal(0, 1, (n, 8))
    a = [(1, i, float(x[i]), float(y[i]), d[i].tolist()) for i in range(n)]
    b = [(1, i, float(x[i] + bend[i]), float(y[i] - 5), (d[i] + r.normal(0, 0.05, 8)).tolist()) for i in range(n)]
    kinds = "g long, id long, x double, y double, d array<double>"
    fa, fb = spark.createDataFrame(a, kinds), spark.createDataFrame(b, kinds)
    seeds = [(1, i, i) for i in np.flatnonzero(x < 150)[:20].tolist()]
    out, counts = m.rematched(fa, fb, spark.createDataFrame(seeds, "g long, ia long, ib long"), ["g"], cell=100.0, radius=16.0, most=1.0)
    got = [(q.ia, q.ib) for q in out.collect()]
    assert all(i == j for i, j in got) and len(got) > 0.95 * n
    assert counts[0] < 0.6 * n and counts == sorted(counts)
