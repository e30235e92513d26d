"""Aggregations. Names of columns are parameters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .cuts import cut


def slice_stats(df: DataFrame, by: list[str], v: str, top: float, percents=(0.5, 1, 50, 99, 99.5)) -> DataFrame:
    """mean, std (population), percentiles, min, max, share of zeros and of saturated values."""
    p = F.percentile(v, F.array(*[F.lit(x / 100.0) for x in percents]))
    out = df.groupBy(*by).agg(F.avg(v).alias("mean"), F.stddev_pop(v).alias("std"), p.alias("_p"), F.min(v).alias("min"), F.max(v).alias("max"), F.avg((F.col(v) == 0).cast("double")).alias("frac_zero"), F.avg((F.col(v) >= top).cast("double")).alias("frac_saturated"))
    return out.select(*by, "mean", "std", *[F.col("_p")[i].alias(f"p{str(x).replace('.', '_')}") for i, x in enumerate(percents)], "min", "max", "frac_zero", "frac_saturated")


def masked_percentiles(df: DataFrame, by: list[str], v: str, mask: Column, percents=(5, 50, 95), least: float = 0.05) -> DataFrame:
    """Percentiles inside the mask; of all values where the mask holds less than `least` of them."""
    d = df.withColumn("_m", mask)
    ps = F.array(*[F.lit(x / 100.0) for x in percents])
    out = d.groupBy(*by).agg(F.avg(F.col("_m").cast("double")).alias("fraction"), F.percentile(F.when(F.col("_m"), F.col(v)), ps).alias("_i"), F.percentile(v, ps).alias("_a"))
    pick = F.when(F.col("fraction") >= least, F.col("_i")).otherwise(F.col("_a"))
    return out.select(*by, "fraction", *[pick[i].alias(f"t_p{x}") for i, x in enumerate(percents)])


def odd_ones(df: DataFrame, group: list[str], shape: list[str]) -> DataFrame:
    """Rows whose shape is rarer than the most frequent shape of their group."""
    n = df.groupBy(*group, *shape).agg(F.count(F.lit(1)).alias("n")).withColumn("_max", F.max("n").over(W.partitionBy(*group)))
    return df.join(n.filter("n < _max").select(*group, *shape), [*group, *shape], "left_semi")


def largest_group(df: DataFrame, by: list[str], value: list[str]) -> DataFrame:
    """The most frequent value of each key, ties to the smaller."""
    n = df.groupBy(*by, *value).agg(F.count(F.lit(1)).alias("n"))
    return n.withColumn("_k", F.row_number().over(W.partitionBy(*by).orderBy(F.desc("n"), *value))).filter("_k = 1").drop("_k")


def duplicate_content(df: DataFrame, digest: str, owner: str, own_label: Column) -> DataFrame:
    """Groups of equal content under two owners or more; rows that contradict their label are the copies, or else all."""
    groups = df.groupBy(digest).agg(F.countDistinct(owner).alias("_o"), F.count(F.lit(1)).alias("_n"), F.sum((~own_label).cast("int")).alias("_bad")).filter("_o >= 2")
    out = df.withColumn("_wrong", ~own_label).join(groups, digest)
    return out.withColumn("excluded", F.when((F.col("_bad") > 0) & (F.col("_bad") < F.col("_n")), F.col("_wrong")).otherwise(F.lit(True))).drop("_o", "_n", "_bad", "_wrong")


def set_mismatch(df: DataFrame, group: list[str], member: list[str], item: str) -> DataFrame:
    """Members whose set of items is not the modal set of the group (ties to the first member): missing, extra."""
    sets = df.groupBy(*group, *member).agg(F.array_sort(F.collect_set(item)).alias("_s"))
    freq = sets.groupBy(*group, "_s").agg(F.count(F.lit(1)).alias("_n"), F.min(F.struct(*member)).alias("_first"))
    modal = freq.withColumn("_k", F.row_number().over(W.partitionBy(*group).orderBy(F.desc("_n"), "_first"))).filter("_k = 1").select(*group, F.col("_s").alias("_modal"))
    out = sets.join(modal, group).filter("_s <> _modal")
    return out.select(*group, *member, F.size(F.array_except("_modal", "_s")).cast("long").alias("missing"), F.size(F.array_except("_s", "_modal")).cast("long").alias("extra"))


def missing_cells(df: DataFrame, by: list[str], item: str) -> DataFrame:
    """Items of 1 ... the group's largest that are absent."""
    return df.groupBy(*by).agg(F.collect_set(item).alias("_s"), F.max(item).alias("_m")).select(*by, F.explode(F.array_except(F.sequence(F.lit(1), F.col("_m")), "_s")).alias(item))


def ranges(df: DataFrame, by: list[str], z: str, limit: int = 8, out: str = "ranges") -> DataFrame:
    """Positions as text: '3-7, 9', at most `limit` ranges, then '...'."""
    d = df.select(*by, z).distinct()
    d = d.withColumn("_g", F.col(z) - F.row_number().over(W.partitionBy(*by).orderBy(z)))
    runs = d.groupBy(*by, "_g").agg(F.min(z).alias("_lo"), F.max(z).alias("_hi"))
    text = F.when(F.col("_lo") == F.col("_hi"), F.col("_lo").cast("string")).otherwise(F.concat_ws("-", "_lo", "_hi"))
    every = runs.groupBy(*by).agg(F.sort_array(F.collect_list(F.struct("_lo", text.alias("t")))).alias("_r"))
    names = F.transform(F.slice("_r", 1, limit), lambda x: x["t"])
    return every.select(*by, F.concat(F.concat_ws(", ", names), F.when(F.size("_r") > limit, F.lit(", ...")).otherwise(F.lit(""))).alias(out))


def histogram_percentile(hist: DataFrame, by: list[str], bin_: str, n: str, share: float, out: str = "p") -> DataFrame:
    """The first bin whose running count reaches the share of all."""
    w = W.partitionBy(*by)
    h = hist.withColumn("_c", F.sum(n).over(w.orderBy(bin_).rowsBetween(W.unboundedPreceding, 0))).withColumn("_t", F.sum(n).over(w))
    return h.filter(F.col("_c") >= share * F.col("_t")).groupBy(*by).agg(F.min(bin_).alias(out))


def otsu(hist: DataFrame, by: list[str], bin_: str, n: str) -> DataFrame:
    """The bin that parts a histogram with the largest variance between the sides; ties to the first."""
    w = W.partitionBy(*by)
    run = w.orderBy(bin_).rowsBetween(W.unboundedPreceding, 0)
    h = hist.withColumn("w0", F.sum(n).over(run)).withColumn("s0", F.sum(F.col(n) * F.col(bin_)).over(run)).withColumn("wt", F.sum(n).over(w)).withColumn("st", F.sum(F.col(n) * F.col(bin_)).over(w))
    w1 = F.col("wt") - F.col("w0")
    between = F.when(w1 > 0, F.col("w0") * w1 * F.pow(F.col("s0") / F.col("w0") - (F.col("st") - F.col("s0")) / w1, 2))
    h = h.withColumn("between", between).filter("between IS NOT NULL")
    return h.withColumn("_k", F.row_number().over(w.orderBy(F.desc("between"), bin_))).filter("_k = 1").select(*by, F.col(bin_).alias("threshold"))


def auc(df: DataFrame, by: list[str], score: str, label: Column) -> DataFrame:
    """Area under the curve by rank sum, equal scores at their mean rank."""
    tied = df.withColumn("_y", label.cast("double")).groupBy(*by, score).agg(F.sum("_y").alias("_p"), F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(W.partitionBy(*by).orderBy(score).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    ranked = tied.withColumn("_rank", before + (F.col("_n") + 1) / 2)
    out = ranked.groupBy(*by).agg(F.sum(F.col("_rank") * F.col("_p")).alias("_s"), F.sum("_p").alias("_pos"), F.sum("_n").alias("_all"))
    return out.select(*by, ((F.col("_s") - F.col("_pos") * (F.col("_pos") + 1) / 2) / (F.col("_pos") * (F.col("_all") - F.col("_pos")))).alias("auc"))


#: Bins of a histogram of a group, and values of a bin that are sorted as they are.
_BINS, _FEW = 4096, 250_000


def quantiles(df: DataFrame, by: list[str], v: Column, shares: list[float], lo: Column, hi: Column, out: str) -> DataFrame:
    """(by, out): the exact quantiles of v, as F.percentile gives them, of groups of any size.

    A histogram between lo and hi (bounds of the group; loose ones cost time only) tells for each rank the bin that holds
    it, and its least and largest value. Bins with many values are divided again; of the others the values are counted.
    So no task holds more of a group than its bins, and a pass over df sends a row for each bin."""
    group, keys = F.struct(*by).alias("_g"), ["_g", "_lo", "_hi"]  # as one key, nulls are a group too
    d = df.select(*by, v.alias("_v"), lo.alias("_lo"), hi.alias("_hi")).filter("_v IS NOT NULL")

    def binned(x, keys):
        at = (F.col("_v") / 2 - F.col("_lo") / 2) / F.nullif(F.col("_hi") / 2 - F.col("_lo") / 2, F.lit(0.0))
        bin_ = F.when(at <= 0, 0).when(at < 1, (at * _BINS).cast("int")).otherwise(_BINS)  # what is not a number comes last
        h = x.groupBy(*keys, bin_.alias("_bin")).agg(F.count(F.lit(1)).alias("_c"), F.min("_v").alias("_least"), F.max("_v").alias("_most"))
        w = W.partitionBy(*keys)
        before = F.coalesce(F.sum("_c").over(w.orderBy("_bin").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
        return h.select(*keys, "_c", "_least", "_most", before.alias("_before"), F.sum("_c").over(w).alias("_all"))

    def within(asked):
        return d.select(group, "_v").join(asked.select(*keys).distinct(), "_g").filter(F.col("_v").between(F.col("_lo"), F.col("_hi")))

    def told(asked, rows):  # of each rank that is asked for in a range, the row of `rows` that holds it
        return asked.drop("_many").join(rows, keys).filter((F.col("_rank") >= F.col("_before")) & (F.col("_rank") < F.col("_before") + F.col("_c"))).drop("_lo", "_hi")

    at = [x for p in shares for x in (F.floor(p * (F.col("_all") - 1)), F.ceil(p * (F.col("_all") - 1)))]
    held = F.filter(F.array(*(F.struct(F.lit(k).alias("k"), x.alias("at")) for k, x in enumerate(at))), lambda t: (t["at"] >= F.col("_before")) & (t["at"] < F.col("_before") + F.col("_c")))
    first = binned(d, by).withColumn("_t", F.explode(held)).select(group, F.col("_t.k").alias("_k"), F.col("_all").alias("_n"), F.col("_t.at").alias("_rank"), "_before", "_c", "_least", "_most")
    narrowed = lambda x: cut(x.select("_g", "_k", "_n", (F.col("_rank") - F.col("_before")).alias("_rank"), F.col("_c").alias("_many"), F.col("_least").alias("_lo"), F.col("_most").alias("_hi")))
    asked, many = narrowed(first), (F.col("_many") > _FEW) & (F.col("_lo") < F.col("_hi"))
    for _ in range(4):
        if asked.filter(many).isEmpty():
            break
        asked = narrowed(told(asked.filter(many), binned(within(asked.filter(many)), keys))).unionByName(asked.filter(~many))
    left = asked.filter("_lo < _hi")
    counted = within(left).groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_c"))
    before = F.sum("_c").over(W.partitionBy(*keys).orderBy("_v")) - F.col("_c")
    counted = counted.select(*keys, "_c", F.col("_v").alias("_least"), F.col("_v").alias("_most"), before.alias("_before"))
    values = told(left, counted).select("_g", "_k", "_n", F.col("_least").alias("_x")).unionByName(asked.filter("NOT _lo < _hi").select("_g", "_k", "_n", F.col("_lo").alias("_x")))
    whole = values.groupBy("_g").agg(F.max("_n").alias("_n"), *(F.max(F.when(F.col("_k") == k, F.col("_x"))).alias(f"_{k}") for k in range(len(at))))

    def between(i, p):
        low, high, place = F.col(f"_{2 * i}"), F.col(f"_{2 * i + 1}"), p * (F.col("_n") - 1)
        return F.when(low == high, low).otherwise((F.ceil(place) - place) * low + (place - F.floor(place)) * high)

    return cut(whole.select(*(F.col("_g")[c].alias(c) for c in by), F.array(*(between(i, p) for i, p in enumerate(shares))).alias(out)))


def _quartiles(df: DataFrame, by: list[str], a: str, b: str) -> DataFrame:
    """by, _n, ends of a and b (_a0, _a1, _b0, _b1) and their quartiles _a, _b. df is read several times."""
    ends = cut(df.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"), *(f(c).cast("double").alias(f"{n}{k}") for c, n in ((a, "_a"), (b, "_b")) for k, f in enumerate((F.min, F.max)))))
    group = F.struct(*by).alias("_g")
    d, out = df.withColumn("_g", group).join(ends.withColumn("_g", group).drop(*by), "_g"), ends.withColumn("_g", group)
    for c, n in ((a, "_a"), (b, "_b")):
        q = quantiles(d, by, F.col(c).cast("double"), [0.25, 0.5, 0.75], F.col(f"{n}0"), F.col(f"{n}1"), n)
        out = out.join(q.select(group, n), "_g", "left")
    return out.drop("_g")


def robust_line(df: DataFrame, by: list[str], a: str, b: str, least: int = 20, reject: float = 3.0, rounds: int = 4) -> DataFrame:
    """a = gain b + offset by reduced major axis: median and MAD of the residuals pick the pairs of each round.

    The medians come from histograms (quantiles()): a group of any size is spread, and a round is five passes over the pairs."""
    q = cut(df.filter(F.col(a).isNotNull() & F.col(b).isNotNull()).select(*by, a, b))
    line = _quartiles(q, by, a, b)
    line = line.filter((F.col("_n") >= least) & (F.col("_a")[2] > F.col("_a")[0]) & (F.col("_b")[2] > F.col("_b")[0]))
    line = line.withColumn("gain", (F.col("_a")[2] - F.col("_a")[0]) / (F.col("_b")[2] - F.col("_b")[0]))
    ends = [f"_{c}{k}" for c in "ab" for k in (0, 1)]
    line = cut(line.select(*by, *ends, "gain", (F.col("_a")[1] - F.col("gain") * F.col("_b")[1]).alias("offset")))
    for _ in range(rounds):
        residual = lambda x, y: x - (F.col("gain") * y + F.col("offset"))
        low, high = (residual(F.col(f"_a{k}"), F.col(f"_b{1 - k}")) for k in (0, 1))
        mid = quantiles(q.join(line, by), by, residual(F.col(a), F.col(b)), [0.5], low, high, "_m")
        line = line.join(mid, by).withColumn("_mid", F.col("_m")[0]).drop("_m")
        off = F.abs(residual(F.col(a), F.col(b)) - F.col("_mid"))
        mad = quantiles(q.join(line, by), by, off, [0.5], F.lit(0.0), F.greatest(F.abs(low - F.col("_mid")), F.abs(high - F.col("_mid"))), "_m")
        line = line.join(mad.select(*by, (F.col("_m")[0] * 1.4826).alias("_sigma")), by)
        kept = q.join(line, by).filter(off <= reject * F.greatest("_sigma", F.lit(1e-6)))
        new = kept.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.stddev_pop(a).alias("_sa"), F.stddev_pop(b).alias("_sb"), F.avg(a).alias("_ma"), F.avg(b).alias("_mb")).filter((F.col("n") >= least) & (F.col("_sa") > 0) & (F.col("_sb") > 0))
        new = new.withColumn("gain", F.col("_sa") / F.col("_sb")).select(*by, "gain", (F.col("_ma") - F.col("gain") * F.col("_mb")).alias("offset"), "n")
        counted = cut(line.select(*by, *ends).join(new, by))
        line = counted.drop("n")
    return counted.select(*by, "gain", "offset", "n")


def iqr_line(df: DataFrame, by: list[str], a: str, b: str) -> DataFrame:
    """Gain and offset from the quartiles of both."""
    g = _quartiles(cut(df.select(*by, a, b)), by, a, b).withColumn("gain", (F.col("_a")[2] - F.col("_a")[0]) / (F.col("_b")[2] - F.col("_b")[0]))
    return g.select(*by, "gain", (F.col("_a")[1] - F.col("gain") * F.col("_b")[1]).alias("offset"))


def mad_reject(df: DataFrame, by: list[str], v: str, least: float, factor: float = 3.0) -> DataFrame:
    """The flag `keep`: within the larger of `least` and factor times 1.4826 MAD of the group's median."""
    w = W.partitionBy(*by)
    d = df.withColumn("_m", F.median(v).over(w)).withColumn("_d", F.abs(F.col(v) - F.col("_m")))
    return d.withColumn("keep", F.col("_d") <= F.greatest(F.lit(least), factor * 1.4826 * F.median("_d").over(w))).drop("_m", "_d")


def translation(df: DataFrame, by: list[str], x: str, y: str, u: str, v: str) -> DataFrame:
    return df.groupBy(*by).agg(F.avg(F.col(u) - F.col(x)).alias("tx"), F.avg(F.col(v) - F.col(y)).alias("ty"))


def similarity(df: DataFrame, by: list[str], x: str, y: str, u: str, v: str) -> DataFrame:
    """Least-squares rotation, scale and shift (x, y) -> (u, v): a = s cos, b = s sin."""
    w = W.partitionBy(*by)
    c = df.select(*by, *[F.col(k).alias(n) for k, n in ((x, "x"), (y, "y"), (u, "u"), (v, "v"))])
    for n in "xyuv":
        c = c.withColumn(f"m{n}", F.avg(n).over(w))
    dx, dy, du, dv = (F.col(n) - F.col(f"m{n}") for n in "xyuv")
    s = c.groupBy(*by).agg(F.sum(dx * du + dy * dv).alias("_p"), F.sum(dx * dv - dy * du).alias("_q"), F.sum(dx * dx + dy * dy).alias("_n"), *[F.first(f"m{n}").alias(f"m{n}") for n in "xyuv"])
    s = s.withColumn("a", F.col("_p") / F.col("_n")).withColumn("b", F.col("_q") / F.col("_n"))
    return s.select(*by, "a", "b", (F.col("mu") - F.col("a") * F.col("mx") + F.col("b") * F.col("my")).alias("tx"), (F.col("mv") - F.col("b") * F.col("mx") - F.col("a") * F.col("my")).alias("ty"))


def affine(df: DataFrame, by: list[str], x: str, y: str, u: str, v: str) -> DataFrame:
    """Least-squares u = a x + b y + tx, v = c x + d y + ty from centred normal equations."""
    w = W.partitionBy(*by)
    c = df.select(*by, *[F.col(k).alias(n) for k, n in ((x, "x"), (y, "y"), (u, "u"), (v, "v"))])
    for n in "xyuv":
        c = c.withColumn(f"m{n}", F.avg(n).over(w))
    dx, dy, du, dv = (F.col(n) - F.col(f"m{n}") for n in "xyuv")
    s = c.groupBy(*by).agg(*[F.sum(e).alias(n) for n, e in (("xx", dx * dx), ("xy", dx * dy), ("yy", dy * dy), ("xu", dx * du), ("yu", dy * du), ("xv", dx * dv), ("yv", dy * dv))], *[F.first(f"m{n}").alias(f"m{n}") for n in "xyuv"])
    det = F.col("xx") * F.col("yy") - F.col("xy") * F.col("xy")
    s = s.withColumns({"a": (F.col("xu") * F.col("yy") - F.col("yu") * F.col("xy")) / det, "b": (F.col("yu") * F.col("xx") - F.col("xu") * F.col("xy")) / det, "c": (F.col("xv") * F.col("yy") - F.col("yv") * F.col("xy")) / det, "d": (F.col("yv") * F.col("xx") - F.col("xv") * F.col("xy")) / det})
    return s.select(*by, "a", "b", (F.col("mu") - F.col("a") * F.col("mx") - F.col("b") * F.col("my")).alias("tx"), "c", "d", (F.col("mv") - F.col("c") * F.col("mx") - F.col("d") * F.col("my")).alias("ty"))
