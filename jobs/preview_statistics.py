"""Running statistics of an acquisition: takes the files that are new since the last run, and no others.

    python -m jobs.preview_statistics --config jobs/jobs.toml --events PATH --output PATH --checkpoint PATH

While an acquisition runs, its log grows by files. A run reads the new ones as a file stream that ends when none is left
(availableNow); the checkpoint remembers what was taken. Each batch writes its partial sums and histogram into partitions of
its own, (day, batch), and the days that it touched are summed again from the partials of all batches. So a late row
changes its own day only, and a batch that is repeated after a crash writes the same partitions again: nothing counts twice.

Output, in folders of `output`:
  partials  (day, batch) / tile, bin, n, total, squares, low, high: sums of one batch; bin is null for missing values
  stats     (day) / tile, n, n_missing, mean, std, low, high, p5, p50, p95 (lower edges of histogram bins)

Null, NaN and infinite values are missing; a null time is a day of its own (null), a null type a tile of its own. Partials
are as large as days x tiles x bins, not as the input; nothing of the input passes through the driver but the list of the
days that a batch touches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from jobs.common import log, main

PARTIALS = "tile string, bin bigint, n bigint, total double, squares double, low double, high double, day date, batch bigint"
STATS = "tile string, n bigint, n_missing bigint, mean double, std double, low double, high double, p5 double, p50 double, p95 double, day date"
SHARES = {"p5": 0.05, "p50": 0.5, "p95": 0.95}


def partial(events: DataFrame, width: float) -> DataFrame:
    """Sums and counts for each day, tile and histogram bin; they add up over batches."""
    v = F.col("value")
    there = v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf")))
    e = events.select(F.to_date("ts").alias("day"), F.col("event_type").alias("tile"), F.when(there, v).alias("v"))
    e = e.withColumn("bin", F.floor(F.col("v") / F.lit(width)).cast("long"))
    return e.groupBy("day", "tile", "bin").agg(F.count(F.lit(1)).alias("n"), F.sum("v").alias("total"), F.sum(F.col("v") * F.col("v")).alias("squares"), F.min("v").alias("low"), F.max("v").alias("high"))


def summed(partials: DataFrame, width: float) -> DataFrame:
    """STATS from partials; windows see the bins of one day and tile."""
    bins = partials.groupBy("day", "tile", "bin").agg(F.sum("n").alias("n"), F.sum("total").alias("total"), F.sum("squares").alias("squares"), F.min("low").alias("low"), F.max("high").alias("high"))
    here = W.partitionBy("day", "tile")
    known = F.when(F.col("bin").isNotNull(), F.col("n")).otherwise(0)
    up_to = F.sum(known).over(here.orderBy(F.col("bin").asc_nulls_first()).rowsBetween(W.unboundedPreceding, 0))
    b = bins.withColumn("_up", up_to).withColumn("_all", F.sum(known).over(here))

    def at(share: float) -> Column:  # the first bin whose running count reaches the share
        return F.min(F.when(F.col("_up") >= F.lit(share) * F.col("_all"), F.col("bin"))) * F.lit(width)

    s = b.groupBy("day", "tile").agg(
        F.sum(known).alias("n"), F.sum(F.when(F.col("bin").isNull(), F.col("n")).otherwise(0)).alias("n_missing"), F.sum("total").alias("_t"), F.sum("squares").alias("_s"),
        F.min("low").alias("low"), F.max("high").alias("high"), *(at(x).cast("double").alias(k) for k, x in SHARES.items()),
    )
    mean = F.col("_t") / F.when(F.col("n") > 0, F.col("n"))
    spread = F.sqrt(F.greatest(F.col("_s") / F.when(F.col("n") > 0, F.col("n")) - mean * mean, F.lit(0.0)))
    return s.withColumn("mean", mean).withColumn("std", F.when(F.col("n") > 0, spread)).select(*(c.split()[0] for c in STATS.split(", ")))


def _write(df: DataFrame, path: str, by: list[str]) -> None:
    df.repartition(*by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def as_pattern(path: str) -> str:
    """A pattern that only this path matches: a stream takes a pattern for a single file, but a plain path for a folder only."""
    path = path.rstrip("/")
    return path if set(path) & set("*?[{") else f"{path[:-1]}[{path[-1]}]"


def run(spark: SparkSession, events: str, output: str, checkpoint: str, width: float = 1.0, files_per_batch: int = 1000) -> dict[str, int]:
    """Takes the new files of the table of events at the path; returns the numbers of batches and rows taken."""
    taken = {"batches": 0, "read": 0}
    schema = spark.read.parquet(events).select("ts", "event_type", "value").schema

    def put(batch: DataFrame, number: int) -> None:
        mine = partial(batch, width).withColumn("batch", F.lit(number).cast("long"))
        _write(mine, f"{output}/partials", ["day", "batch"])
        every = batch.sparkSession.read.schema(PARTIALS).parquet(f"{output}/partials")
        days = [r.day for r in every.filter(F.col("batch") == number).select("day").distinct().collect()]  # a row for each day of the calendar
        touched = F.col("day").isin([d for d in days if d is not None])
        touched = touched | F.col("day").isNull() if None in days else touched
        _write(summed(every.filter(touched), width), f"{output}/stats", ["day"])
        taken["batches"] += 1
        read = every.filter(F.col("batch") == number).agg(F.sum("n")).first()[0] or 0
        taken["read"] += read
        log.info("batch %d: read %d rows of %s, wrote %d days to %s", number, read, events, len(days), output)

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(as_pattern(events))
    started = stream.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    try:
        started.awaitTermination()
    finally:
        started.stop()
    log.info("took %d rows in %d batches", taken["read"], taken["batches"])
    return taken


if __name__ == "__main__":
    main("preview_statistics", __doc__.split("\n")[0], ["events", "output", "checkpoint"], run)
