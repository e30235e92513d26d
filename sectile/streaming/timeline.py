"""Incremental modes of the acquisition clock with Structured Streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.cuts import cut


def sessions(events: DataFrame, ts: str, by: list[str], gap: str, late: str) -> DataFrame:
    """Runs of the clock without a gap: start, end and number of slices for each key. Rows later than `late` are dropped."""
    e = events.withWatermark(ts, late)
    s = e.groupBy(*by, F.session_window(ts, gap).alias("w")).agg(F.count(F.lit(1)).alias("n"))
    return s.select(*by, F.col("w.start").alias("first"), F.col("w.end").alias("end"), "n")


def tile_statistics(events: DataFrame, ts: str, by: list[str], value: str, window: str, late: str) -> DataFrame:
    """Statistics of each key and time window, final once the watermark has passed."""
    e = events.withWatermark(ts, late)
    g = e.groupBy(*by, F.window(ts, window).alias("w")).agg(F.avg(value).alias("mean"), F.stddev_pop(value).alias("std"), F.min(value).alias("min"), F.max(value).alias("max"), F.count(F.lit(1)).alias("n"))
    return g.select(*by, F.col("w.start").alias("start"), "mean", "std", "min", "max", "n")


def complete_groups(files: DataFrame, modified: str, group: list[str], file: str, least_age: str) -> DataFrame:
    """Groups of files whose newest file is older than `least_age` by the stream's clock; siblings wait for each other."""
    e = files.withWatermark(modified, least_age)
    g = e.groupBy(*group, F.session_window(modified, least_age).alias("w")).agg(F.collect_set(file).alias("_f"), F.max(modified).alias("newest"))
    return g.select(*group, F.array_sort("_f").alias("files"), "newest")


def append_slabs(stream: DataFrame, path: str, slab: int, z: str = "z", checkpoint: str | None = None):
    """Slices land in whole slabs: partitions of `slab` slices, of which only those that a batch touches are written again."""

    def put(batch: DataFrame, _: int) -> None:
        new = batch.withColumn("slab", F.floor(F.col(z) / slab))
        spark = batch.sparkSession
        try:
            old = spark.read.parquet(path)
        except Exception as e:  # the first batch
            if "PATH_NOT_FOUND" not in str(e):
                raise
            old = None
        if old is not None:
            touched = old.join(F.broadcast(new.select("slab").distinct()), "slab", "left_semi")
            new = new.unionByName(touched.join(new.select(z).distinct(), z, "left_anti")).select(*old.columns)
        new = cut(new)  # it reads what it overwrites
        new.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("slab").parquet(path)

    w = stream.writeStream.foreachBatch(put)
    return (w.option("checkpointLocation", checkpoint) if checkpoint else w).start()
