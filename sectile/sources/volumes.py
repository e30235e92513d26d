"""Multiscale block volumes: shapes, shards, and block tables as Parquet partitioned by scale."""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BLOCKS = T.StructType([T.StructField(x, T.IntegerType()) for x in ("scale", "zb", "yb", "xb", "nz", "ny", "nx")] + [T.StructField("data", T.BinaryType())])


def scale_length(n: Column, scale: Column) -> Column:
    """Halved `scale` times, rounded up."""
    return F.ceil(n / F.pow(F.lit(2.0), scale))


def shard_boxes(df: DataFrame, axes: dict[str, tuple[str, int]]) -> DataFrame:
    """A row for each shard: its index, first and last (exclusive) position of each axis (length column, shard size)."""
    for a, (n, size) in axes.items():
        df = df.withColumn(a, F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(F.col(n) / size) - 1)))
        df = df.withColumn(f"{a}0", F.col(a) * size).withColumn(f"{a}1", F.least((F.col(a) + 1) * size, F.col(n)))
    return df


def write_volume(spark: SparkSession, volume: np.ndarray, path: str, block: int = 32) -> None:
    """A small array as scale 0 of a block table."""
    rows = []
    for z in range(0, volume.shape[0], block):
        for y in range(0, volume.shape[1], block):
            for x in range(0, volume.shape[2], block):
                b = np.ascontiguousarray(volume[z : z + block, y : y + block, x : x + block])
                rows.append((0, z // block, y // block, x // block, *b.shape, zlib.compress(b.tobytes())))
    spark.createDataFrame(rows, BLOCKS).write.mode("append").partitionBy("scale").parquet(path)


def next_scale(blocks: DataFrame, shape: tuple[int, int, int], block: int = 32) -> DataFrame:
    """The next coarser scale: 2 x 2 x 2 means, halves up, odd axes repeat their last plane.

    A coarse block needs the eight fine blocks under it; they meet by one shuffle on the coarse block's index."""
    out = [-(-n // 2) for n in shape]

    def pool(pdf):
        import pandas as pd

        zb, yb, xb = (int(pdf[c].iloc[0]) // 2 for c in ("zb", "yb", "xb"))
        size = [min(2 * block, n - 2 * block * b) for n, b in zip(shape, (zb, yb, xb))]
        full = np.zeros(size, np.uint8)
        for r in pdf.itertuples():
            a = np.frombuffer(zlib.decompress(r.data), np.uint8).reshape(r.nz, r.ny, r.nx)
            o = [(i % 2) * block for i in (r.zb, r.yb, r.xb)]
            full[o[0] : o[0] + r.nz, o[1] : o[1] + r.ny, o[2] : o[2] + r.nx] = a
        even = np.pad(full, [(0, n % 2) for n in size], mode="edge").astype(np.uint16)
        s = sum(even[i::2, j::2, k::2] for i in (0, 1) for j in (0, 1) for k in (0, 1))
        p = (s + 4 >> 3).astype(np.uint8)
        return pd.DataFrame([(int(pdf["scale"].iloc[0]) + 1, zb, yb, xb, *p.shape, zlib.compress(np.ascontiguousarray(p).tobytes()))], columns=BLOCKS.names)

    assert all(n > 0 for n in out)
    return blocks.withColumns({k: F.floor(F.col(c) / 2) for k, c in (("_z", "zb"), ("_y", "yb"), ("_x", "xb"))}).groupBy("_z", "_y", "_x").applyInPandas(lambda k, pdf: pool(pdf), BLOCKS)


def read_window(blocks: DataFrame, lo: tuple, hi: tuple, block: int = 32) -> np.ndarray:
    """A small window [lo, hi), zeros outside the volume. Only the blocks it meets are read."""
    hit = blocks
    for c, a, b in zip(("zb", "yb", "xb"), lo, hi):
        hit = hit.filter((F.col(c) >= a // block) & (F.col(c) <= (b - 1) // block))
    out = np.zeros([b - a for a, b in zip(lo, hi)], np.uint8)
    for r in hit.collect():
        a = np.frombuffer(zlib.decompress(r.data), np.uint8).reshape(r.nz, r.ny, r.nx)
        at = [r.zb * block, r.yb * block, r.xb * block]
        src = [slice(max(0, l - p), max(0, h - p)) for l, h, p in zip(lo, hi, at)]
        part = a[tuple(src)]
        dst = tuple(slice(max(0, p - l), max(0, p - l) + n) for p, l, n in zip(at, lo, part.shape))
        out[dst] = part
    return out
