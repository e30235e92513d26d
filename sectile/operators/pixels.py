"""Images and volumes as rows (keys, y, x, v) or blocks; pure column arithmetic and group aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def downsampled(df: DataFrame, by: list[str], x: str, y: str, v: str, fx: int, fy: int) -> DataFrame:
    """Means of blocks of fy rows by fx columns."""
    return df.groupBy(*by, F.floor(F.col(y) / fy).alias(y), F.floor(F.col(x) / fx).alias(x)).agg(F.avg(v).alias(v))


def pooled(df: DataFrame, v: str, axes: dict[str, int]) -> DataFrame:
    """2 x 2 (x 2) means, halves up; an odd axis (given its length) repeats its last plane."""
    weight: Column = F.lit(1).cast("long")
    for a, n in axes.items():
        if n % 2:
            weight = weight * F.when(F.col(a) == n - 1, 2).otherwise(1)
    k = 2 ** len(axes)
    return df.groupBy(*[F.floor(F.col(a) / 2).alias(a) for a in axes]).agg(F.floor((F.sum(F.col(v) * weight) + k // 2) / k).alias(v))


def edge_distance(x: Column, y: Column, x0: Column, y0: Column, x1: Column, y1: Column) -> tuple[Column, Column]:
    """Distances to the nearer side of a tile, by column and row."""
    return F.least(x - x0, x1 - 1 - x), F.least(y - y0, y1 - 1 - y)


def cut_blend(df: DataFrame, by: list[str], v: str, score: str, order: str) -> DataFrame:
    """The value of the highest score; of equal scores the first in order."""
    return df.groupBy(*by).agg(F.max_by(v, F.struct(F.col(score), -F.col(order))).alias(v))


def weighted_blend(df: DataFrame, by: list[str], v: str, weight: Column) -> DataFrame:
    return df.withColumn("_w", weight).groupBy(*by).agg((F.sum(F.col("_w") * F.col(v)) / F.sum("_w")).alias(v))


def seam_weight(dc: Column, dr: Column, width: float) -> Column:
    """Steep weights that leave a narrow seam."""
    tau = width / 2
    return F.exp(F.least(dr / tau, F.lit(30.0)) + F.least(dc / tau, F.lit(30.0)) - 60)


def feather_weight(dc: Column, dr: Column, width: float) -> Column:
    def ramp(d: Column) -> Column:
        return F.least(F.greatest((d + 1) / width, F.lit(0.0)), F.lit(1.0))

    return ramp(dc) * ramp(dr)


def normalised(v: Column, lo: Column, hi: Column) -> Column:
    return F.least(F.greatest((v - lo) / (hi - lo), F.lit(0.0)), F.lit(1.0))


def window_fraction(df: DataFrame, by: list[str], x: str, y: str, v: str, half: int) -> DataFrame:
    """Share of v in the square window around each pixel, by running sums along rows, then columns."""
    row = W.partitionBy(*by, y).orderBy(x).rangeBetween(-half, half)
    col = W.partitionBy(*by, x).orderBy(y).rangeBetween(-half, half)
    d = df.withColumn("_s", F.sum(v).over(row)).withColumn("_n", F.count(F.lit(1)).over(row))
    return d.withColumn("fraction", F.sum("_s").over(col) / F.sum("_n").over(col)).drop("_s", "_n")


def laplacian_noise(df: DataFrame, by: list[str], x: str, y: str, v: str) -> DataFrame:
    """Noise of an image from the mean absolute response of the 3 x 3 difference of Laplacians, inner pixels only."""
    row, col = W.partitionBy(*by, y).orderBy(x), W.partitionBy(*by, x).orderBy(y)
    d = df.withColumn("_h", F.lag(v).over(row) - 2 * F.col(v) + F.lead(v).over(row))
    d = d.withColumn("_r", F.lag("_h").over(col) - 2 * F.col("_h") + F.lead("_h").over(col))
    return d.filter("_r IS NOT NULL").groupBy(*by).agg((F.sqrt(F.lit(3.141592653589793 / 2)) / 6 * F.avg(F.abs("_r"))).alias("noise"))


def bilinear(df: DataFrame, grid: DataFrame, x: str, y: str, gx: str, gy: str, value: str, n: int, m: int) -> DataFrame:
    """Values of an n by m grid of nodes at points in node units, edges held: four equi joins folded into one."""
    fx, fy = F.least(F.greatest(F.col(x), F.lit(0.0)), F.lit(float(n - 1))), F.least(F.greatest(F.col(y), F.lit(0.0)), F.lit(float(m - 1)))
    d = df.withColumn("_fx", fx).withColumn("_fy", fy)
    d = d.withColumn("_x0", F.least(F.floor("_fx"), F.lit(n - 2))).withColumn("_y0", F.least(F.floor("_fy"), F.lit(m - 2)))
    node = F.array(*[F.struct((F.col("_x0") + i).alias("gx"), (F.col("_y0") + j).alias("gy"), ((F.col("_fx") - F.col("_x0")) if i else (1 - F.col("_fx") + F.col("_x0"))).alias("wx"), ((F.col("_fy") - F.col("_y0")) if j else (1 - F.col("_fy") + F.col("_y0"))).alias("wy")) for i in (0, 1) for j in (0, 1)])
    e = d.withColumn("_k", F.explode(node)).withColumns({"_gx": F.col("_k.gx"), "_gy": F.col("_k.gy")})
    g = grid.select(F.col(gx).cast("long").alias("_gx"), F.col(gy).cast("long").alias("_gy"), F.col(value).alias("_v"))
    return e.join(g, ["_gx", "_gy"]).groupBy(*df.columns).agg(F.sum(F.col("_k.wx") * F.col("_k.wy") * F.col("_v")).alias(value))


def composited(df: DataFrame, by: list[str], depth: str, alpha: str, v: str) -> DataFrame:
    """Layers seen from the front: each counts by its alpha times what the nearer ones let through; an alpha of 1 hides the rest."""
    nearer = W.partitionBy(*by).orderBy(depth).rowsBetween(W.unboundedPreceding, -1)
    seen = F.coalesce(F.product(1 - F.col(alpha)).over(nearer), F.lit(1.0))
    return df.withColumn("_t", seen).groupBy(*by).agg(F.sum(F.col("_t") * F.col(alpha) * F.col(v)).alias(v), F.sum(F.col("_t") * F.col(alpha)).alias("cover"))


def field_at(df: DataFrame, field: DataFrame, by: list[str], x: str, y: str, gx: str, gy: str, value: str, size: tuple[int, int], nodes: tuple[int, int]) -> DataFrame:
    """df with the field's value at each pixel: nodes stand in the middle of their share of the tile, edges are held.

    Each pixel meets its four nodes by an equi join on (by, node)."""
    def along(c, px, n):
        at = F.least(F.greatest((F.col(c) + 0.5) * n / px - 0.5, F.lit(0.0)), F.lit(float(n - 1)))
        return at, F.least(F.floor(at), F.lit(max(n - 2, 0)))

    (fx, x0), (fy, y0) = along(x, size[0], nodes[0]), along(y, size[1], nodes[1])
    near = [F.struct((x0 + i).alias("gx"), (y0 + j).alias("gy"), ((fx - x0 if i else 1 - fx + x0) * (fy - y0 if j else 1 - fy + y0)).alias("w")) for i in (0, 1) for j in (0, 1)]
    d = df.withColumn("_n", F.explode(F.array(*near))).withColumns({"_gx": F.col("_n.gx"), "_gy": F.col("_n.gy"), "_w": F.col("_n.w")})
    g = field.select(*by, F.col(gx).alias("_gx"), F.col(gy).alias("_gy"), F.col(value).alias("_v"))
    return d.join(g, [*by, "_gx", "_gy"]).groupBy(*df.columns).agg(F.sum(F.col("_w") * F.col("_v")).alias(value))
