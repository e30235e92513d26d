"""Global alignment, frame chains and pair search on the driver tables."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators import align, grids, matching
from ..operators.cuts import dealt
from .base import query, r


def slice_points(t):
    """Line items as points that two slices share: a supplier and one of the next three; each slice has its own affine.

    Every 97th part is a wrong match, and so are all matches of supplier 3 with the next one."""
    l = t("lineitem").select(F.col("l_suppkey").alias("z_a"), (F.col("l_suppkey") + 1 + F.col("l_linenumber") % 3).alias("z_b"), (F.col("l_partkey") % 1000).cast("double").alias("x"), (F.col("l_quantity") * 20).alias("y"), "l_tax", "l_discount", "l_partkey")
    bad = F.when((F.col("l_partkey") % 97 == 0) | ((F.col("z_a") == 3) & (F.col("z_b") == 4)), 150.0 + F.col("l_partkey") % 50).otherwise(0.0)

    def seen(z, e):
        k = F.col(z)
        x = F.col("x") * (1 + (k % 7) / 2000) + F.col("y") * (k % 5) / 3000 + k * 0.5 + F.col(e) * 10
        y = F.col("y") * (1 - (k % 3) / 2000) - F.col("x") * (k % 4) / 4000 - (k % 11) * 3.0
        return x, y

    (xa, ya), (xb, yb) = seen("z_a", "l_tax"), seen("z_b", "l_discount")
    return l.select("z_a", "z_b", xa.alias("xa"), ya.alias("ya"), (xb + bad).alias("xb"), (yb - bad).alias("yb"), F.lit(1.0).alias("w"))


@query()
def nu15_slice_affines(t):
    """Affine of each slice from all its matches; wrong points and the wrong pair are left out on the way."""
    out = align.slice_affines(slice_points(t))
    return out.select("z", *(r(c, 5).alias(c) for c in ("a00", "a01", "tx", "a10", "a11", "ty")))


_CHANGES = """m AS (SELECT l_suppkey AS g, date_trunc('month', l_shipdate) AS mo, 1 + avg(l_discount) / 100 AS a, avg(l_tax) / 50 AS b, sum(l_quantity) / 100 AS tx, -avg(l_tax) / 60 AS c, 1 - avg(l_discount) / 90 AS d, avg(l_quantity) - 25 AS ty FROM lineitem GROUP BY 1, 2),
ch AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY mo) AS k, count(*) OVER (PARTITION BY g) AS n FROM m), rf AS (SELECT DISTINCT g, 1 + n // 3 AS ref FROM ch)"""


@query(f"""WITH RECURSIVE {_CHANGES},
f AS (SELECT g, ref AS run, 1.0::DOUBLE AS a, 0.0::DOUBLE AS b, 0.0::DOUBLE AS tx, 0.0::DOUBLE AS c, 1.0::DOUBLE AS d, 0.0::DOUBLE AS ty FROM rf UNION ALL
 SELECT f.g, ch.k, f.a * ch.a + f.b * ch.c, f.a * ch.b + f.b * ch.d, f.a * ch.tx + f.b * ch.ty + f.tx, f.c * ch.a + f.d * ch.c, f.c * ch.b + f.d * ch.d, f.c * ch.tx + f.d * ch.ty + f.ty FROM f JOIN ch ON ch.g = f.g AND ch.k = f.run - 1 JOIN rf ON rf.g = f.g AND f.run <= ref),
iv AS (SELECT g, k + 1 AS run, d / e AS a, -b / e AS b, (b * ty - d * tx) / e AS tx, -c / e AS c, a / e AS d, (c * tx - a * ty) / e AS ty FROM (SELECT *, a * d - b * c AS e FROM ch)),
h AS (SELECT g, ref AS run, 1.0::DOUBLE AS a, 0.0::DOUBLE AS b, 0.0::DOUBLE AS tx, 0.0::DOUBLE AS c, 1.0::DOUBLE AS d, 0.0::DOUBLE AS ty FROM rf UNION ALL
 SELECT h.g, iv.run, h.a * iv.a + h.b * iv.c, h.a * iv.b + h.b * iv.d, h.a * iv.tx + h.b * iv.ty + h.tx, h.c * iv.a + h.d * iv.c, h.c * iv.b + h.d * iv.d, h.c * iv.tx + h.d * iv.ty + h.ty FROM h JOIN iv ON iv.g = h.g AND iv.run = h.run + 1 JOIN rf ON rf.g = h.g AND h.run >= ref),
u AS (SELECT * FROM f UNION ALL SELECT h.* FROM h JOIN rf USING (g) WHERE run > ref)
SELECT g, run, true AS linked, round(a, 6) AS a, round(b, 6) AS b, round(tx, 4) AS tx, round(c, 6) AS c, round(d, 6) AS d, round(ty, 4) AS ty FROM u""")
def nu14_frame_chain(t):
    """Frames of a supplier's months, each of which changes into the next; the reference is a third of the way along."""
    l = t("lineitem").groupBy(F.col("l_suppkey").alias("g"), F.date_trunc("month", "l_shipdate").alias("mo")).agg(
        (1 + F.avg("l_discount") / 100).alias("a"), (F.avg("l_tax") / 50).alias("b"), (F.sum("l_quantity") / 100).alias("tx"), (-F.avg("l_tax") / 60).alias("c"), (1 - F.avg("l_discount") / 90).alias("d"), (F.avg("l_quantity") - 25).alias("ty")
    )
    ch = l.withColumn("run", F.row_number().over(W.partitionBy("g").orderBy("mo")).cast("long")).drop("mo")
    ref = ch.groupBy("g").agg(F.count(F.lit(1)).alias("n")).select("g", (1 + F.floor(F.col("n") / 3)).cast("long").alias("run"))
    out = align.chained(ch, ["g"], "run", ref)
    return out.select("g", "run", "linked", *(r(c, 6).alias(c) for c in "abcd"), r("tx", 4).alias("tx"), r("ty", 4).alias("ty"))


def word_keypoints(t):
    """Parts as keypoints of two tiles of a supplier's slice: every part at the finest of three levels, fewer at the coarse
    ones. In every fifth slice the coarsest level of tile 1 is 35 px off, in every seventh it shows almost nothing."""
    l = t("lineitem").select(F.col("l_suppkey").alias("z"), F.col("l_partkey").alias("word"))
    l = dealt(l, t("lineitem").count(), "z", "word").distinct()
    level = F.explode(F.expr("filter(array(4, 2, 1), v -> word % v = 0)")).alias("level")
    p = l.select("z", "word", (F.hash("word") % 900).cast("double").alias("x"), (F.hash(F.col("word") + 1) % 700).cast("double").alias("y"), level)
    p = p.withColumn("tile", F.explode(F.array(F.lit(0), F.lit(1))))
    second = F.col("tile") == 1
    wrong = F.when(second & (F.col("level") == 4) & (F.col("z") % 5 == 0), 35.0).otherwise(0.0)
    p = p.filter(~(second & (F.col("level") == 4) & (F.col("z") % 7 == 0) & (F.col("word") % 1280 > 0)))
    return p.select("z", "tile", "level", "word", (F.col("x") - F.when(second, 500 + F.col("z") % 3).otherwise(0)).alias("x"), (F.col("y") - F.when(second, 12.0).otherwise(0.0) + wrong).alias("y"))


@query()
def mi5_pair_search(t):
    """Displacements of two tiles in all slices; pairs that a level gets wrong or can't find go on to the next."""
    k = word_keypoints(t)
    pairs = k.select("z").distinct().select("z", F.lit(0).alias("a"), F.lit(1).alias("b"), F.lit(500.0).alias("ex"), F.lit(0.0).alias("ey"))
    out, _ = matching.search_pairs(k, pairs, "z", [4, 2, 1], 60.0, 4.0)
    return out.select("z", "a", "b", r("dx", 4).alias("dx"), r("dy", 4).alias("dy"), "n", "level", "ok", "reason")


_NEAR = """p AS (SELECT vec_id AS id, label AS g, embedding[1]::DOUBLE AS u, embedding[2]::DOUBLE AS v, list_transform(embedding[3:10], lambda x: x::DOUBLE) AS d FROM embeddings),
a AS (SELECT * FROM p WHERE id % 2 = 0), b AS (SELECT * FROM p WHERE id % 2 = 1),
m AS (SELECT a.g, a.id AS ia, b.id AS ib, list_sum(list_transform(list_zip(a.d, b.d), lambda x: (x[1] - x[2]) * (x[1] - x[2]))) AS e FROM a JOIN b ON a.g = b.g AND (a.u + 0.01 - b.u) * (a.u + 0.01 - b.u) + (a.v - b.v) * (a.v - b.v) <= 0.05::DOUBLE * 0.05),
o AS (SELECT *, row_number() OVER (PARTITION BY g, ia ORDER BY e, ib) AS k FROM m), q AS (SELECT *, row_number() OVER (PARTITION BY g, ib ORDER BY e, ia) AS h FROM o WHERE k = 1)"""


@query(f"WITH {_NEAR} SELECT g, ia, ib, round(e, 6) AS e FROM q WHERE h = 1")
def nu19_near_prediction(t):
    """One round of matching around a predicted place: even and odd vectors of a label, the first two numbers as places."""
    e = F.col("embedding")
    p = t("embeddings").select(F.col("label").alias("g"), F.col("vec_id").alias("id"), e[0].cast("double").alias("x"), e[1].cast("double").alias("y"), F.slice(e.cast("array<double>"), 3, 8).alias("d"))
    a = p.filter("id % 2 = 0").select("g", "id", (F.col("x") + 0.01).alias("px"), F.col("y").alias("py"), "d")
    out = matching.near_prediction(a, p.filter("id % 2 = 1"), ["g"], 0.05)
    return out.select("g", "ia", "ib", r("e").alias("e"))


def warp_points(t):
    """Line items as points of the tiles of a slice, each tile bent within itself."""
    l = t("lineitem").select((F.col("l_suppkey") % 10).alias("z"), F.col("l_linenumber").alias("tile"), (F.hash("l_orderkey") % 500 + 500).cast("double").alias("x"), (F.hash("l_partkey", "l_orderkey") % 400 + 400).cast("double").alias("y"), "l_tax")
    bend = F.sin(F.col("x") / 250) * (4 + F.col("tile"))
    return l.select("z", "tile", "x", "y", (F.col("x") + bend + F.col("l_tax")).alias("u"), (F.col("y") + F.cos(F.col("y") / 200) * 3 - F.col("l_tax")).alias("v"), F.lit(1.0).alias("w"))


@query()
def nu18_warp_grids(t):
    """Warp of each tile on 9 x 11 nodes."""
    out = grids.warp_grids(warp_points(t), ["z", "tile"], (1000.0, 800.0), (9, 11), 0.002)
    return out.select("z", "tile", "gy", "gx", r("dx").alias("dx"), r("dy").alias("dy"))


def patch_relations(t):
    """Relations of patches of neighbouring tiles, made from the gain and offset of each patch."""
    l = t("lineitem").select((F.col("l_suppkey") % 10).alias("z"), ((F.col("l_linenumber") - 1) % 5).alias("a"), (F.col("l_partkey") % 9).alias("pa"), (F.col("l_orderkey") % 9).alias("pb"), (F.col("l_quantity") + 50).alias("middle"), (F.col("l_discount") * 10 + 0.1).alias("contrast"))
    l = l.withColumn("b", F.col("a") + 1)

    def own(tile, patch):
        return 1 + F.col(tile) / 50 + F.col(patch) / 200, F.col(tile) - F.col(patch) / 4

    (ga, oa), (gb, ob) = own("a", "pa"), own("b", "pb")
    return l.select("z", F.col("a").cast("string").alias("a"), "pa", F.col("b").cast("string").alias("b"), "pb", (gb / ga).alias("gain"), ((ob - oa) / ga).alias("offset"), "middle", "contrast", F.lit(1.0).alias("w"))


@query()
def nu24_patch_balance(t):
    """Gains and offsets of nine patches of a tile, from relations of which those of little contrast tell of offsets only."""
    out = grids.patch_balance(patch_relations(t), ["z"], 3, 0.01, 1e-3, 0.2)
    return out.select("z", "tile", "patch", r("gain").alias("gain"), r("offset").alias("offset"))
