"""Numeric and image operators on the driver tables. Those without SQL are tested by recovery and against NumPy."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from ..operators import aggregates as a
from ..operators import fits, images
from .base import query, r
from .q_scalars import image

_STOPS = [{"t": 0, "zoom": 1.0, "cx": 0.0, "cy": 10.0, "z": 0.0}, {"t": 4, "zoom": 8.0, "cx": 100.0, "cy": -20.0, "z": 300.0}, {"t": 10, "zoom": 2.0, "cx": 40.0, "cy": 0.0, "z": 900.0}]
_U = "(CASE WHEN t < {0} THEN 0 WHEN t > {1} THEN 1 ELSE (t - {0}) / ({1} - {0}) END)"
_EASE = "({u} * {u} * (3 - 2 * {u}))"
_E0, _E1 = (_EASE.format(u=_U.format(p, q)) for p, q in (("0.0::DOUBLE", "4.0::DOUBLE"), ("4.0::DOUBLE", "10.0::DOUBLE")))


@query(f"WITH f AS (SELECT i AS frame, i / 25.0::DOUBLE AS t FROM range(250) x(i)) SELECT frame, t, round(CASE WHEN t >= 4 THEN 8 * 0.25::DOUBLE ** {_E1} ELSE 8.0::DOUBLE ** {_E0} END, 6) AS zoom, round(CASE WHEN t >= 4 THEN 100 - 60 * {_E1} ELSE 100 * {_E0} END, 6) AS cx, round(CASE WHEN t >= 4 THEN 300 + 600 * {_E1} ELSE 300 * {_E0} END, 6) AS z FROM f")
def im27_timeline(t):
    from ..functions.motion import timeline

    return timeline(t("region").sparkSession, 250, 25.0, _STOPS).select("frame", "t", r("zoom").alias("zoom"), r("cx").alias("cx"), r("z").alias("z"))


def places(t):
    return t("lineitem").groupBy(F.col("l_returnflag").alias("segment"), F.col("l_linenumber").alias("tile"), F.col("l_suppkey").alias("z")).agg(F.avg("l_quantity").alias("tx"), F.avg(F.col("l_tax") * 100).alias("ty"))


@query("WITH p AS (SELECT l_returnflag AS segment, l_linenumber AS tile, l_suppkey AS z, avg(l_quantity) AS tx, avg(l_tax * 100) AS ty FROM lineitem GROUP BY 1, 2, 3), m AS (SELECT segment, tile, median(tx) AS mx, median(ty) AS my FROM p GROUP BY 1, 2), d AS (SELECT segment, max(sqrt((tx - mx) ** 2 + (ty - my) ** 2)) AS d FROM p JOIN m USING (segment, tile) GROUP BY 1) SELECT segment, tile, CASE WHEN d <= 20 THEN 'fixed' ELSE 'slice' END AS mode, round(mx - min(mx) OVER (PARTITION BY segment), 6) AS tx, round(my - min(my) OVER (PARTITION BY segment), 6) AS ty FROM m JOIN d USING (segment)")
def nu13_merge_segment(t):
    from ..operators.fits import merged_segment

    return merged_segment(places(t), ["segment"], "tile", 20.0).select("segment", "tile", "mode", r("tx").alias("tx"), r("ty").alias("ty"))


@query()
def nu2_ransac(t):
    e = F.col("embedding")
    m = t("embeddings").select("label", *[e[i].cast("double").alias(n) for i, n in enumerate("xyuv")])
    return fits.robust_transforms(m, ["label"], "translation", 0.3)


@query()
def nu6_tile_gains(t):
    l = t("lineitem").select(F.col("l_returnflag").alias("z"), "l_orderkey", F.col("l_linenumber").alias("k"), "l_extendedprice")
    b = l.select("z", "l_orderkey", (F.col("k") - 1).alias("k"), F.col("l_extendedprice").alias("y"))
    pairs = l.join(b, ["z", "l_orderkey", "k"]).select("z", F.col("k").cast("string").alias("a"), (F.col("k") + 1).cast("string").alias("b"), F.col("l_extendedprice").alias("x"), "y")
    rel = a.iqr_line(pairs, ["z", "a", "b"], "x", "y").join(pairs.groupBy("z", "a", "b").agg(F.count(F.lit(1)).alias("n"), F.median("y").alias("middle")), ["z", "a", "b"])
    return fits.tile_gains(rel.filter("gain > 0").withColumn("cnr", F.lit(8.0)), ["z"])


@query()
def nu8_layout(t):
    from ..operators.joins import pairs_within

    p = t("lineitem").groupBy((F.col("l_suppkey") % 50).alias("z"), F.col("l_linenumber").cast("string").alias("tile")).agg(F.avg("l_quantity").alias("x"), F.avg(F.col("l_tax") * 100).alias("y"))
    q = pairs_within(p, ["z"], ["tile"], ["x", "y"])
    return fits.layout(q.select("z", F.col("tile_a"), F.col("tile_b"), (F.col("x_b") - F.col("x_a")).alias("dx"), (F.col("y_b") - F.col("y_a")).alias("dy"), F.lit(1.0).alias("w")), ["z"])


@query()
def nu15_slice_shifts(t):
    l = t("lineitem").select((F.col("l_suppkey") % 100).alias("z_a"), (F.col("l_suppkey") % 100 + 1 + F.col("l_linenumber") % 3).alias("z_b"), F.col("l_partkey").cast("double").alias("xa"), F.col("l_quantity").alias("ya"), (F.col("l_partkey") + F.col("l_tax")).alias("xb"), (F.col("l_quantity") + F.col("l_discount")).alias("yb"), F.lit(1.0).alias("w"))
    return fits.slice_shifts(l, 3)


@query()
def nu22_flat_field(t):
    """Pixels are the quantities and discounts of a return flag; the line items of one are its slices."""
    pixel = [F.col("l_returnflag"), ((F.col("l_quantity") - 25) / 25).alias("x"), ((F.col("l_discount") - 0.05) / 0.05).alias("y")]
    l = t("lineitem").select(*pixel, "l_extendedprice").groupBy("l_returnflag", "x", "y").agg(F.avg("l_extendedprice").alias("v"), F.count(F.lit(1)).cast("double").alias("w"))
    whole = l.groupBy("l_returnflag").agg((F.sum(F.col("v") * F.col("w")) / F.sum("w")).alias("m"))
    return fits.flat_fields(l.join(whole, "l_returnflag").withColumn("v", F.col("v") / F.col("m")).drop("m"), ["l_returnflag"])


@query()
def nu31_spacings(t):
    l = t("lineitem").select((F.col("l_suppkey") % 100).alias("z_a"), (F.col("l_suppkey") % 100 + 1 + F.col("l_linenumber") % 3).alias("z_b"), (1 + F.col("l_linenumber") % 3 + F.col("l_tax")).alias("d"), F.lit(1.0).alias("w"))
    return fits.spacings(l)


@query()
def nu33_trees(t):
    """Fitted to 2,000 vectors at most, of the smallest digests of their ids; all are scored."""
    e = t("embeddings").select("vec_id", *[F.col("embedding")[i].cast("double").alias(f"f{i}") for i in range(8)], (F.col("label") < 5).cast("double").alias("y"))
    names = [f"f{i}" for i in range(8)]
    s = e.orderBy(F.md5(F.col("vec_id").cast("string")), "vec_id").limit(2000).toPandas()
    return fits.probabilities(e, fits.Trees().fit(s[names].to_numpy(), s["y"].to_numpy()), names).select("vec_id", "p")


@query()
def so6_farthest_points(t):
    return fits.spread_out(t("supplier").select("s_nationkey", F.col("s_acctbal").alias("x"), F.col("s_suppkey").cast("double").alias("y")), ["s_nationkey"], "x", "y", 3)


@query()
def so7_random_boxes(t):
    return fits.placed_boxes(t("part").select("p_partkey", (100 + F.col("p_size")).alias("w"), (90 + F.col("p_size")).alias("h")), ["p_partkey"], "w", "h", 24, 4)


def blocks(t):
    """The 500 x 64 image in slices of 25 rows."""
    return image(t).select(F.floor(F.col("y") / 25).alias("z"), (F.col("y") % 25).alias("y"), "x", "v")


_PIXELS = "z long, y long, x long, v double"


@query()
def im3_background(t):
    return images.per_image(blocks(t), ["z"], "y", "x", "v", lambda p: images.background(p, 15.0, 60.0, least=8, least_dark=8, grow=1).astype(float), _PIXELS)


@query()
def im6_keypoints(t):
    def run(p):
        xy, d = images.keypoints(p, 20, 1.0, 4)
        return pd.DataFrame({"k": np.arange(len(xy)), "px": xy[:, 0], "py": xy[:, 1], "descriptor": list(d.astype(np.float32))})

    return images.per_image(blocks(t), ["z"], "y", "x", "v", run, "z long, k long, px double, py double, descriptor array<float>")


@query()
def im8_destriped(t):
    return images.per_image(blocks(t), ["z"], "y", "x", "v", lambda p: images.destriped(p, levels=3), _PIXELS)


@query()
def im13_equalised(t):
    return images.per_image(blocks(t), ["z"], "y", "x", "v", lambda p: images.equalised(np.clip(p, 0, 255).astype(np.uint8), 3).astype(float), _PIXELS)


@query()
def im15_warped(t):
    m = np.array([[1.0, 0.02, 1.5], [-0.01, 1.0, -0.7]])
    return images.per_image(blocks(t), ["z"], "y", "x", "v", lambda p: images.affine_warp(p, m, p.shape)[0], _PIXELS)


@query()
def im17_local_contrast(t):
    return images.per_image(blocks(t), ["z"], "y", "x", "v", lambda p: images.local_contrast(p, 8), _PIXELS)


@query()
def jn19_template(t):
    def run(p):
        if len(p) <= 5:  # nothing to look for
            return pd.DataFrame()
        y, x, s = images.template_match(p, p[5:15, 20:40])
        return pd.DataFrame({"py": [y], "px": [x], "score": [s]})

    return images.per_image(blocks(t), ["z"], "y", "x", "v", run, "z long, py long, px long, score double")


@query()
def im4_tissue_score(t):
    def run(p):
        s = images.tissue_score(p, 5)
        yy, xx = np.mgrid[: s.shape[0], : s.shape[1]]
        return pd.DataFrame({"cy": yy.reshape(-1), "cx": xx.reshape(-1), "score": s.reshape(-1)})

    return images.per_image(blocks(t), ["z"], "y", "x", "v", run, "z long, cy long, cx long, score double")


@query()
def im5_cell_features(t):
    def run(p):
        f = images.cell_features(p, 8)
        yy, xx = np.mgrid[: f.shape[0], : f.shape[1]]
        return pd.DataFrame({"cy": yy.reshape(-1), "cx": xx.reshape(-1), "features": list(f.reshape(-1, f.shape[2]))})

    return images.per_image(blocks(t), ["z"], "y", "x", "v", run, "z long, cy long, cx long, features array<double>")


@query()
def im19_raw_classes(t):
    return images.per_image(blocks(t), ["z"], "y", "x", "v", lambda p: images.raw_classes(p, 60.0, 12.0, 200.0).astype(float), _PIXELS)


@query()
def nu24_patch_gains(t):
    from ..operators.joins import pairs_within

    l = t("lineitem").select((F.col("l_suppkey") % 10).alias("z"), "l_orderkey", F.col("l_linenumber").alias("tile"), (F.col("l_partkey") % 4).alias("p"), F.col("l_extendedprice").alias("v"))
    m = l.groupBy("z", "tile", "p").agg(F.median("v").alias("v"), F.count(F.lit(1)).alias("n"))
    q = pairs_within(m, ["z"], ["tile"], ["p", "v", "n"]).filter("tile_b = tile_a + 1")
    b = q.select("z", F.col("tile_a").cast("string").alias("a"), F.col("p_a").alias("pa"), F.col("tile_b").cast("string").alias("b"), F.col("p_b").alias("pb"), (F.col("v_a") / F.col("v_b")).alias("gain"), (F.col("n_a") + F.col("n_b")).cast("double").alias("w"))
    return fits.patch_gains(b, ["z"], 2)


@query()
def nu17_window_affines(t):
    l = t("lineitem").select((F.col("l_suppkey") % 10).alias("z"), F.col("l_linenumber").cast("string").alias("a"), (F.col("l_linenumber") + 1).cast("string").alias("b"), F.col("l_quantity").alias("xa"), (F.col("l_partkey") % 97).cast("double").alias("ya"), (F.col("l_quantity") + F.col("l_tax")).alias("xb"), (F.col("l_partkey") % 97 - F.col("l_discount")).alias("yb"), F.lit(1.0).alias("w"))
    return fits.window_affines(l, ["z"])


@query()
def nu37_wavelet_noise(t):
    return images.per_image(blocks(t), ["z"], "y", "x", "v", lambda p: pd.DataFrame({"noise": [images.wavelet_noise(p)]}), "z long, noise double")
