"""Display levels of tile slices: starting windows, running medians, jumps, balance; and curves of the slice spacing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import joins, windows

#: Where the middle of the tissue goes on the display, and how wide its spread becomes.
TARGET, SPREAD = 140.0, 160.0


def start_windows(stats: DataFrame, p5: str = "p5", p50: str = "p50", p95: str = "p95") -> DataFrame:
    """lo_raw and hi_raw from percentiles of the tissue."""
    s = F.greatest(F.col(p95) - F.col(p5), F.lit(1.0))
    return stats.withColumn("lo_raw", F.col(p50) - TARGET / SPREAD * s).withColumn("hi_raw", F.col(p50) + (255 - TARGET) / SPREAD * s)


def levels(stats: DataFrame, z: str, tile: str, block: str, size: int = 51) -> DataFrame:
    """lo and hi: running medians of the starting windows of a tile and block, plus the slice's jump of the middle.

    The jump is the median over the tiles of a slice of each tile's jump in units of its window."""
    d = start_windows(stats)
    for c in ("lo", "hi"):
        d = windows.running_median(d, f"{c}_raw", size, z, [tile, block], c)
    d = windows.running_median(d, "p50", size, z, [tile, block], "_m").withColumn("_j", (F.col("p50") - F.col("_m")) / (F.col("hi") - F.col("lo")))
    d = d.withColumn("jump", F.median("_j").over(W.partitionBy(z)) * (F.col("hi") - F.col("lo")))
    return d.withColumn("lo", F.col("lo") + F.col("jump")).withColumn("hi", F.col("hi") + F.col("jump")).drop("_m", "_j")


def balanced(lv: DataFrame, maps: DataFrame, z: str, tile: str, size: int) -> DataFrame:
    """lo, hi remapped so that the tiles of a slice agree. maps: (z, tile, g, o) at the measured slices.

    A tile's map is smoothed at two anchors, interpolated over z (ends held) and applied against the slice's common window;
    tiles without a map keep their own."""
    anchor = lv.groupBy(tile).agg(F.median("lo").alias("r1"), F.median("hi").alias("r2"))
    m = maps.join(anchor, tile).withColumn("m1", F.col("g") * F.col("r1") + F.col("o")).withColumn("m2", F.col("g") * F.col("r2") + F.col("o"))
    for c in ("m1", "m2"):
        m = windows.running_median(m, c, size, z, [tile], f"{c}s")
    out = lv
    for c in ("m1", "m2"):
        out = out.join(joins.interpolated(lv.select(tile, z), m.select(tile, z, f"{c}s"), z, f"{c}s", [tile], c), [tile, z], "left")
    out = out.join(anchor, tile).withColumn("g", (F.col("m2") - F.col("m1")) / (F.col("r2") - F.col("r1"))).withColumn("o", F.col("m1") - F.col("g") * F.col("r1"))
    for c in ("lo", "hi"):
        common = F.median(F.col("g") * F.col(c) + F.col("o")).over(W.partitionBy(z))
        out = out.withColumn(f"{c}_b", F.coalesce((common - F.col("o")) / F.col("g"), F.col(c)))
    return out.select(z, tile, F.col("lo_b").alias("lo"), F.col("hi_b").alias("hi"))


def falling_curve(pairs: DataFrame, d: str, v: str, least: int = 5) -> DataFrame:
    """(d, v): medians in half-unit bins with at least `least` pairs, from (0, 1) on, made strictly falling."""
    bins = pairs.withColumn("_b", F.bround(2 * F.col(d))).filter("_b > 0").groupBy("_b").agg(F.median(d).alias("d"), F.median(v).alias("v"), F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= least)
    every = bins.select("_b", "d", "v").unionByName(bins.sparkSession.createDataFrame([(0.0, 0.0, 1.0)], "_b double, d double, v double"))  # a row for each bin
    o = W.orderBy("d").rowsBetween(W.unboundedPreceding, 0)
    return every.withColumn("_i", F.row_number().over(W.orderBy("d")) - 1).select("d", (F.min("v").over(o) - 1e-6 * F.col("_i")).alias("v"))


def adaptive(samples: DataFrame, by: list[str], x: str, v: str, sigma: Column, rungs: list[float], sigmas: float = 2.0) -> DataFrame:
    """Median over the longest window of a ladder whose estimates still agree with all shorter ones.

    Each rung gives an estimate e and an uncertainty u; rungs count while the running intersection of [e - u, e + u] is
    not empty, and the first always does. One self join in the range of the longest rung, by value of x in cells."""
    top = max(rungs)
    s = samples.withColumn("_s", sigma)
    a = s.select(*by, F.col(x).alias("_x"), "_s", F.explode(F.array(*[(F.floor(F.col(x) / top) + i) for i in (-1, 0, 1)])).alias("_cell"))
    b = s.select(*by, F.col(x).alias("_y"), F.col(v).alias("_v"), F.floor(F.col(x) / top).alias("_cell"))
    near = a.join(b, [*by, "_cell"]).withColumn("_d", F.abs(F.col("_x") - F.col("_y"))).filter(F.col("_d") <= top)
    est = near.groupBy(*by, "_x", "_s").agg(*[F.percentile(F.when(F.col("_d") <= h, F.col("_v")), F.lit(0.5)).alias(f"e{i}") for i, h in enumerate(rungs)], *[F.count(F.when(F.col("_d") <= h, 1)).alias(f"n{i}") for i, h in enumerate(rungs)])
    ok, lo, hi, best = F.lit(True), None, None, F.col("e0")
    for i in range(len(rungs)):
        u = sigmas * 1.2533 * F.col("_s") / F.sqrt(F.col(f"n{i}"))
        lo = F.col("e0") - u if lo is None else F.greatest(lo, F.col(f"e{i}") - u)
        hi = F.col("e0") + u if hi is None else F.least(hi, F.col(f"e{i}") + u)
        if i:
            ok = ok & (lo <= hi)
            best = F.when(ok, F.col(f"e{i}")).otherwise(best)
    return est.select(*by, F.col("_x").alias(x), best.alias("smooth"))


def reference_windows(stats: DataFrame, z: str, median: str, contrast: str, m_ref: float, c_ref: float, half: float, by=()) -> DataFrame:
    """Windows that give every slice the reference's brightness and contrast, smoothed over positions within `half`.

    Width W = 255 c / c_ref; the reference median falls on m_ref of 255, so L = m - m_ref W / 255 and H = L + W."""
    d = stats.withColumn("_w", 255 * F.col(contrast) / c_ref)
    d = windows.range_median(d, "_w", z, half, by, "W")
    d = d.withColumn("_l", F.col(median) - m_ref * F.col("W") / 255)
    d = windows.range_median(d, "_l", z, half, by, "L")
    return d.withColumn("H", F.col("L") + F.col("W")).drop("_w", "_l")
