"""Window operators on keyed, ordered rows. Names of columns are parameters; `by` is the list of partition columns."""

from __future__ import annotations

import math
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def _over(by, order):
    return W.partitionBy(*by).orderBy(*([order] if isinstance(order, str) else order))


def global_index(df: DataFrame, order: str, bucket: Column, out: str = "z") -> DataFrame:
    """Dense rank from 0 of `order` over all rows, without one task for all: ranks within buckets that follow the
    order, plus the number of distinct values in the buckets before."""
    at = df.select(F.col(order).alias("_o"), bucket.alias("_b")).distinct()
    sizes = at.groupBy("_b").agg(F.count(F.lit(1)).alias("_n"))  # a row for each bucket
    start = sizes.select("_b", F.coalesce(F.sum("_n").over(W.orderBy("_b").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_s"))
    ranked = at.withColumn("_r", F.row_number().over(W.partitionBy("_b").orderBy("_o"))).join(F.broadcast(start), "_b")
    return df.join(ranked.select(F.col("_o").alias(order), (F.col("_s") + F.col("_r") - 1).cast("long").alias(out)), order)


def islands(df: DataFrame, keys: list[str], order, by=(), out: str = "segment") -> DataFrame:
    """Number of the run of equal keys, from 0."""
    w = _over(by, order)
    here, before = F.struct(*keys), F.lag(F.struct(*keys)).over(w)
    return df.withColumn("_new", (~here.eqNullSafe(before)).cast("long")).withColumn(out, F.sum("_new").over(w.rowsBetween(W.unboundedPreceding, 0)) - 1).drop("_new")


def blocks(df: DataFrame, breaks: Column, order, by=(), out: str = "block") -> DataFrame:
    """Number of forced breaks up to each row."""
    w = _over(by, order).rowsBetween(W.unboundedPreceding, 0)
    return df.withColumn(out, F.sum(F.coalesce(breaks, F.lit(False)).cast("long")).over(w))


def filled(df: DataFrame, col: str, order, by=(), out: str | None = None) -> DataFrame:
    """Nulls take the last value before, else the first after."""
    w = _over(by, order)
    last = F.last(col, ignorenulls=True).over(w.rowsBetween(W.unboundedPreceding, 0))
    first = F.first(col, ignorenulls=True).over(w.rowsBetween(0, W.unboundedFollowing))
    return df.withColumn(out or col, F.coalesce(last, first))


def gaps(df: DataFrame, seconds: str, segment: str, order, by=(), factor: float = 1.5) -> DataFrame:
    """interval_s to the row before; median_s of the intervals inside the segment, else of all; gap."""
    w = _over(by, order)
    out = df.withColumn("interval_s", F.col(seconds) - F.lag(seconds).over(w)).withColumn("_in", F.when(F.col(segment) == F.lag(segment).over(w), F.col("interval_s")))
    own = F.median("_in").over(W.partitionBy(*by, segment))
    out = out.withColumn("median_s", F.coalesce(own, F.median("interval_s").over(W.partitionBy(*by))))
    return out.drop("_in").withColumn("gap", F.coalesce(F.col("interval_s") > factor * F.col("median_s"), F.lit(False)))


def carried(df: DataFrame, event: Column, usable: Column, order, by=(), out: str = "seam") -> DataFrame:
    """An event on an unusable row is carried to the next usable one: any event since the last usable row before."""
    w = _over(by, order)
    out_df = df.withColumn("_e", event.cast("int")).withColumn("_u", usable.cast("int"))
    group = F.coalesce(F.sum("_u").over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    out_df = out_df.withColumn("_g", group)
    return out_df.withColumn(out, F.max("_e").over(W.partitionBy(*by, "_g").orderBy(*([order] if isinstance(order, str) else order)).rowsBetween(W.unboundedPreceding, 0)) == 1).drop("_e", "_u", "_g")


def first_of(df: DataFrame, key: list[str], prefer: list) -> DataFrame:
    """The preferred row of each key."""
    return df.withColumn("_n", F.row_number().over(W.partitionBy(*key).orderBy(*prefer))).filter("_n = 1").drop("_n")


def running_median(df: DataFrame, col: str, size: int, order, by=(), out: str = "smooth") -> DataFrame:
    """Median of `size` rows around each; of an even size one more before than after. Edges use what there is."""
    frame = _over(by, order).rowsBetween(-(size // 2), (size - 1) // 2)
    return df.withColumn(out, F.percentile(col, F.lit(0.5)).over(frame))


def range_median(df: DataFrame, col: str, position: str, half: float, by=(), out: str = "smooth") -> DataFrame:
    """Median of the rows whose position is within `half`."""
    return df.withColumn(out, F.percentile(col, F.lit(0.5)).over(_over(by, position).rangeBetween(-half, half)))


def ramp(df: DataFrame, col: str, half: int, order, by=(), out: str = "smooth") -> DataFrame:
    """Running mean of 2 half + 1 rows; beyond the ends the end values go on."""
    w = _over(by, order)
    all_ = w.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    n, i = F.count(F.lit(1)).over(all_), F.row_number().over(w)
    df = df.withColumn("_before", F.greatest(half - (i - 1), F.lit(0))).withColumn("_after", F.greatest(half - (n - i), F.lit(0)))
    df = df.withColumn("_first", F.first(col).over(all_)).withColumn("_last", F.last(col).over(all_)).withColumn("_sum", F.sum(col).over(w.rowsBetween(-half, half)))
    return df.withColumn(out, (F.col("_sum") + F.col("_before") * F.col("_first") + F.col("_after") * F.col("_last")) / (2 * half + 1)).drop("_before", "_after", "_first", "_last", "_sum")


def noise(df: DataFrame, col: str, order, by: list[str], out: str = "noise") -> DataFrame:
    """Robust noise of a series: 1.4826 MAD of the differences / sqrt 2. One row for each group."""
    d = df.withColumn("_d", F.col(col) - F.lag(col).over(_over(by, order))).filter("_d IS NOT NULL")
    d = d.withColumn("_m", F.median("_d").over(W.partitionBy(*by)))
    return d.groupBy(*by).agg((F.median(F.abs(F.col("_d") - F.col("_m"))) * 1.4826 / F.sqrt(F.lit(2.0))).alias(out))


def median3(df: DataFrame, col: str, order, by=(), out: str = "smooth") -> DataFrame:
    """Median of three neighbours, the ends repeated."""
    w = _over(by, order)
    three = F.array_sort(F.array(F.coalesce(F.lag(col).over(w), F.col(col)), F.col(col), F.coalesce(F.lead(col).over(w), F.col(col))))
    return df.withColumn(out, F.element_at(three, 2))


def cumulative(df: DataFrame, col: str, order, by=(), out: str = "position") -> DataFrame:
    return df.withColumn(out, F.sum(col).over(_over(by, order).rowsBetween(W.unboundedPreceding, 0)))


def trapezoid(df: DataFrame, value: str, at: str, order, by=(), out: str = "integral") -> DataFrame:
    """Cumulative integral of value over `at`."""
    w = _over(by, order)
    step = (F.col(value) + F.lag(value).over(w)) / 2 * (F.col(at) - F.lag(at).over(w))
    return df.withColumn("_s", F.coalesce(step, F.lit(0.0))).withColumn(out, F.sum("_s").over(w.rowsBetween(W.unboundedPreceding, 0))).drop("_s")


def constrained(df: DataFrame, spacing: str, nominal: Column, half: int, order, by: list[str], breaks: Column | None = None, least: float = 0.25, out: str = "held") -> DataFrame:
    """Spacings over the running mean of their ratio to nominal (half 0: as they are), at least a share of nominal, scaled so
    that the rows between two breaks keep their depth. Rows at a break have the nominal spacing."""
    brk = F.lit(False) if breaks is None else F.coalesce(breaks, F.lit(False))
    df = df.withColumn("_n", nominal.cast("double")).withColumn("_b", brk)
    df = df.withColumn("_k", F.sum(F.col("_b").cast("int")).over(_over(by, order).rowsBetween(W.unboundedPreceding, 0)))
    block = [*by, "_k", "_b"]
    near = _over(block, order).rowsBetween(-half, half)
    held = F.col(spacing) / F.avg(F.col(spacing) / F.col("_n")).over(near) if half else F.col(spacing)
    floor = least * F.col("_n")
    df = df.withColumn("_s", F.greatest(held - floor, F.lit(0.0)))
    all_ = W.partitionBy(*block)
    over, room = F.sum("_s").over(all_), F.sum(F.col("_n") - floor).over(all_)
    return df.withColumn(out, F.when(F.col("_b") | (over <= 0), F.col("_n")).otherwise(floor + F.col("_s") * room / over)).drop("_n", "_b", "_k", "_s")


def coverage(intervals: DataFrame, lo: str, hi: str, by=(), out: str = "n") -> DataFrame:
    """Steps of the number of intervals [lo, hi) that cover a position: one row where it may change."""
    ends = intervals.select(*by, F.col(lo).alias("at"), F.lit(1).alias("_d")).unionByName(intervals.select(*by, F.col(hi).alias("at"), F.lit(-1).alias("_d")))
    ends = ends.groupBy(*by, "at").agg(F.sum("_d").alias("_d"))
    return ends.withColumn(out, F.sum("_d").over(_over(by, "at").rowsBetween(W.unboundedPreceding, 0))).drop("_d")


def detrended(df: DataFrame, y: str, x: str, by=(), out: str = "level") -> DataFrame:
    """Minus the least-squares line of its group."""
    w = W.partitionBy(*by)
    n, sx, sy = F.count(F.lit(1)).over(w), F.avg(x).over(w), F.avg(y).over(w)
    df = df.withColumn("_mx", sx).withColumn("_my", sy)
    sxy = F.sum((F.col(x) - F.col("_mx")) * (F.col(y) - F.col("_my"))).over(w)
    sxx = F.sum((F.col(x) - F.col("_mx")) ** 2).over(w)
    slope = F.when(sxx > 0, sxy / sxx).otherwise(0.0)
    return df.withColumn(out, F.when(n > 0, F.col(y) - F.col("_my") - slope * (F.col(x) - F.col("_mx")))).drop("_mx", "_my")


def without_drift(df: DataFrame, y: str, order, sigma: float, by=(), steps: Column | None = None, out: str = "level") -> DataFrame:
    """Minus a Gaussian low-pass over positions, the ends repeated. Where `steps` holds, the step to the row is none of the
    drift: the low-pass is of the rows with these steps taken out. y holds no nulls."""
    at, reach = _over(by, order), int(4 * sigma + 0.5)
    weights = [math.exp(-k * k / (2 * sigma * sigma)) for k in range(-reach, reach + 1)]
    weights = [x / sum(weights) for x in weights]
    missing = F.array(*[F.lit(sum(weights[:k])) for k in range(reach + 1)])  # weight of the first k places
    step = F.coalesce(F.when(F.lit(False) if steps is None else steps, F.col(y) - F.lag(y).over(at)), F.lit(0.0))
    df = df.withColumn("_d", step)
    df = df.withColumn("_s", F.col(y) - F.sum("_d").over(at.rowsBetween(W.unboundedPreceding, 0)))
    whole = at.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    before = F.row_number().over(at) - 1
    df = df.withColumns({"_v": F.collect_list("_s").over(at.rowsBetween(-reach, reach)), "_f": F.first("_s").over(whole), "_l": F.last("_s").over(whole)})
    df = df.withColumns({"_lo": reach - F.least(before, F.lit(reach)), "_hi": reach - F.least(F.count(F.lit(1)).over(W.partitionBy(*by)) - 1 - before, F.lit(reach)).cast("int")})
    here = F.zip_with("_v", F.slice(F.array(*map(F.lit, weights)), F.col("_lo") + 1, F.size("_v")), lambda v, w: v * w)
    drift = F.aggregate(here, F.lit(0.0), lambda t, x: t + x) + F.col("_f") * F.element_at(missing, F.col("_lo") + 1) + F.col("_l") * F.element_at(missing, F.col("_hi") + 1)
    return df.withColumn(out, F.col(y) - drift).drop("_d", "_s", "_v", "_f", "_l", "_lo", "_hi")


def gauged(df: DataFrame, col: str, order, by=(), how: str = "first", out: str = "shifted") -> DataFrame:
    """Shifted so that the first value (or the mean) is 0."""
    base = F.first(col).over(_over(by, order).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)) if how == "first" else F.avg(col).over(W.partitionBy(*by))
    return df.withColumn(out, F.col(col) - base)


def spread(df: DataFrame, cell: list[str], by: list[str], order: list, k: int) -> DataFrame:
    """Round robin over cells: the k rows of lowest rank within their cell."""
    df = df.withColumn("_r", F.row_number().over(W.partitionBy(*by, *cell).orderBy(*order)))
    return df.withColumn("_n", F.row_number().over(W.partitionBy(*by).orderBy("_r", *order))).filter(F.col("_n") <= k).drop("_n").withColumnRenamed("_r", "cell_rank")


def envelope(df: DataFrame, y: str, x, by=(), out: str = "low") -> DataFrame:
    """Smallest y so far."""
    return df.withColumn(out, F.min(y).over(_over(by, x).rowsBetween(W.unboundedPreceding, 0)))


def stretches(df: DataFrame, z: str, gap: int, by: list[str]) -> DataFrame:
    """Runs of positions at most `gap` apart: first, last, n."""
    w = _over(by, z)
    df = df.withColumn("_new", F.coalesce(F.col(z) - F.lag(z).over(w) > gap, F.lit(True)).cast("int")).withColumn("_s", F.sum("_new").over(w.rowsBetween(W.unboundedPreceding, 0)))
    return df.groupBy(*by, "_s").agg(F.min(z).alias("first"), F.max(z).alias("last"), F.count(F.lit(1)).alias("n")).drop("_s")


def every_nth(df: DataFrame, n: int, order, by=(), ends: bool = True) -> DataFrame:
    """Every n-th row by position, and the last."""
    w = _over(by, order)
    df = df.withColumn("_i", F.row_number().over(w) - 1).withColumn("_c", F.count(F.lit(1)).over(W.partitionBy(*by)))
    keep = F.col("_i") % n == 0
    return df.filter(keep | (F.col("_i") == F.col("_c") - 1) if ends else keep).drop("_i", "_c")


def even_pick(df: DataFrame, k: int, order, by=(), lo: float = 0.0, hi: float = 1.0) -> DataFrame:
    """k rows at evenly spaced positions between the shares lo and hi (half to even, repeats once)."""
    w = _over(by, order)
    df = df.withColumn("_i", F.row_number().over(w) - 1).withColumn("_c", F.count(F.lit(1)).over(W.partitionBy(*by)))
    span = float(Decimal(str(hi)) - Decimal(str(lo)))  # 0.95 - 0.05 is 0.9: where a position is a half, the last bit counts
    spots = F.array_distinct(F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: F.bround((F.col("_c") - 1) * (lo + span * i / max(1, k - 1))).cast("int")))
    return df.filter(F.array_contains(spots, F.col("_i"))).drop("_i", "_c")
