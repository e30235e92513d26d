"""Timelines of moving views as tables: one row for each frame."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .scalars import ease


def timeline(spark: SparkSession, frames: int, fps: float, stops: list[dict]) -> DataFrame:
    """Eased moves between stops (t, zoom, cx, cy, z): zoom by ratio, the rest straight; ends are held."""
    f = spark.range(frames).select(F.col("id").alias("frame"), (F.col("id") / fps).alias("t"))
    out = {k: F.lit(float(stops[0][k])) for k in ("zoom", "cx", "cy", "z")}
    for a, b in zip(stops, stops[1:]):
        u = ease((F.col("t") - a["t"]) / (b["t"] - a["t"]))
        here = F.col("t") >= a["t"]
        out["zoom"] = F.when(here, F.lit(float(a["zoom"])) * F.pow(F.lit(b["zoom"] / a["zoom"]), u)).otherwise(out["zoom"])
        for k in ("cx", "cy", "z"):
            out[k] = F.when(here, a[k] + (b[k] - a[k]) * u).otherwise(out[k])
    return f.withColumns(out)


def scale_bar(width_px: int, nm_per_px, share: float = 0.2):
    """Length in nanometres of a bar of at most a share of the width: 1, 2 or 5 times a power of ten."""
    from .scalars import nice_length

    return nice_length(nm_per_px * width_px * share)


def travelled(t: Column, start: Column, end: Column, ease_: Column) -> Column:
    """0 to 1 from start to end: the speed rises from rest on a cosine ramp over ease_ and falls to rest on another (each at
    most half the way). A step at start where end is not later."""
    length = end - start
    e = F.least(ease_, length / 2)
    s = F.least(F.greatest(t - start, F.lit(0.0)), length)

    def ramp(x: Column) -> Column:
        return x / 2 - e / (2 * math.pi) * F.sin(math.pi * x / F.nullif(e, F.lit(0.0)))

    way = F.when(s < e, ramp(s)).when(s > length - e, length - e - ramp(length - s)).otherwise(s - e / 2)
    return F.when(length <= 0, (t >= start).cast("double")).otherwise(way / F.nullif(length - e, F.lit(0.0)))


def built(t: Column, done: Column, depth: Column, thick: Column, first: Column, ease_: Column) -> Column:
    """Depth built by time t: the first slice (thick) at an even pace over `first` (at most half of done), the rest eased."""
    head = F.least(first, done / 2)
    even = F.least(F.greatest(t / F.greatest(head, F.lit(1e-9)), F.lit(0.0)), F.lit(1.0))
    return thick * even + (depth - thick) * travelled(t, head, done, F.least(ease_, (done - head) / 2))


def visible_end(frames: DataFrame, by: list[str], t: str, depth: str, done: str, level: int, out: str = "stop") -> DataFrame:
    """Per `by`: the time of the last frame that is deeper than the one before by a voxel of the level or more; `done` if none is."""
    ahead = F.col(depth) - F.lag(depth).over(W.partitionBy(*by).orderBy(t))
    moved = frames.withColumn("_a", ahead).groupBy(*by).agg(F.max(F.when(F.col("_a") >= 2**level, F.col(t))).alias("_t"), F.max(done).alias("_d"))
    return moved.select(*by, F.coalesce("_t", "_d").alias(out))


def veil(u: Column, depth: Column) -> Column:
    """Opacity per voxel of what is u (0 to 1) of the way to clear: one sees depth * u / (1 - u) voxels into it."""
    return F.when(u <= 0, 1.0).when(u >= 1, 0.0).otherwise(-F.expm1(-(1 - u) / (depth * F.nullif(u, F.lit(0.0)))))
