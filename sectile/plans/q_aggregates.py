"""Aggregations and robust fits on the driver tables: lineitem as tile slices (supplier z, line number tile)."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators import aggregates as a
from .base import query, r


def _rounded(df, keys, n=4):
    return df.select(*[F.col(c) if c in keys or t != "double" else r(c, n).alias(c) for c, t in df.dtypes])


@query("""SELECT l_suppkey, l_returnflag, round(avg(l_quantity), 6) AS mean, round(stddev_pop(l_quantity), 6) AS std, round(quantile_cont(l_quantity, 0.005), 6) AS p0_5, round(quantile_cont(l_quantity, 0.01), 6) AS p1, round(quantile_cont(l_quantity, 0.5), 6) AS p50, round(quantile_cont(l_quantity, 0.99), 6) AS p99, round(quantile_cont(l_quantity, 0.995), 6) AS p99_5,
min(l_quantity) AS min, max(l_quantity) AS max, round(avg(CASE WHEN l_quantity = 0 THEN 1.0 ELSE 0.0 END), 6) AS frac_zero, round(avg(CASE WHEN l_quantity >= 50 THEN 1.0 ELSE 0.0 END), 6) AS frac_saturated FROM lineitem GROUP BY 1, 2""")
def ag1_slice_stats(t):
    return _rounded(a.slice_stats(t("lineitem"), ["l_suppkey", "l_returnflag"], "l_quantity", 50.0), [], 6)


@query("""SELECT l_suppkey, round(avg(CASE WHEN l_discount > 0.09 THEN 1.0 ELSE 0.0 END), 6) AS fraction, round(CASE WHEN avg(CASE WHEN l_discount > 0.09 THEN 1.0 ELSE 0.0 END) >= 0.08 THEN quantile_cont(l_quantity, 0.05) FILTER (WHERE l_discount > 0.09) ELSE quantile_cont(l_quantity, 0.05) END, 6) AS t_p5,
round(CASE WHEN avg(CASE WHEN l_discount > 0.09 THEN 1.0 ELSE 0.0 END) >= 0.08 THEN quantile_cont(l_quantity, 0.5) FILTER (WHERE l_discount > 0.09) ELSE quantile_cont(l_quantity, 0.5) END, 6) AS t_p50,
round(CASE WHEN avg(CASE WHEN l_discount > 0.09 THEN 1.0 ELSE 0.0 END) >= 0.08 THEN quantile_cont(l_quantity, 0.95) FILTER (WHERE l_discount > 0.09) ELSE quantile_cont(l_quantity, 0.95) END, 6) AS t_p95 FROM lineitem GROUP BY 1""")
def ag2_masked_percentiles(t):
    return _rounded(a.masked_percentiles(t("lineitem"), ["l_suppkey"], "l_quantity", F.col("l_discount") > 0.09, least=0.08), [], 6)


@query("WITH n AS (SELECT l_orderkey, l_returnflag, count(*) AS n FROM lineitem GROUP BY 1, 2), m AS (SELECT *, max(n) OVER (PARTITION BY l_orderkey) AS mx FROM n) SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem JOIN m USING (l_orderkey, l_returnflag) WHERE n < mx")
def ag3_odd_shapes(t):
    return a.odd_ones(t("lineitem"), ["l_orderkey"], ["l_returnflag"]).select("l_orderkey", "l_linenumber", "l_partkey")


@query("WITH n AS (SELECT l_suppkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2) SELECT l_suppkey, l_linenumber, n FROM (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY n DESC, l_linenumber) AS k FROM n) WHERE k = 1")
def ag4_largest_group(t):
    return a.largest_group(t("lineitem"), ["l_suppkey"], ["l_linenumber"])


@query("""WITH d AS (SELECT doc_id, source, md5(text) AS h, doc_id % 3 <> 0 AS own FROM documents), g AS (SELECT h, count(*) AS n, sum(CASE WHEN own THEN 0 ELSE 1 END) AS bad FROM d GROUP BY 1 HAVING count(DISTINCT source) >= 2) SELECT doc_id, h, CASE WHEN bad > 0 AND bad < n THEN NOT own ELSE true END AS excluded FROM d JOIN g USING (h)""")
def ag5_duplicate_content(t):
    d = t("documents").select("doc_id", "source", F.md5("text").alias("h"))
    return a.duplicate_content(d, "h", "source", F.col("doc_id") % 3 != 0).select("doc_id", "h", "excluded")


@query("""WITH s AS (SELECT l_orderkey % 100 AS g, l_orderkey AS m, list_sort(list(DISTINCT l_linenumber)) AS s FROM lineitem GROUP BY 1, 2), f AS (SELECT g, s, count(*) AS n, min(m) AS first FROM s GROUP BY 1, 2), k AS (SELECT g, s AS modal FROM (SELECT *, row_number() OVER (PARTITION BY g ORDER BY n DESC, first) AS k FROM f) WHERE k = 1)
SELECT g, m, CAST(len(list_filter(modal, lambda x: NOT list_contains(s, x))) AS BIGINT) AS missing, CAST(len(list_filter(s, lambda x: NOT list_contains(modal, x))) AS BIGINT) AS extra FROM s JOIN k USING (g) WHERE s <> modal""")
def ag6_set_mismatch(t):
    return a.set_mismatch(t("lineitem").select((F.col("l_orderkey") % 100).alias("g"), F.col("l_orderkey").alias("m"), "l_linenumber"), ["g"], ["m"], "l_linenumber")


@query("SELECT lang, source, count(*) AS n, count(DISTINCT md5(text)) AS texts FROM documents GROUP BY 1, 2")
def ag7_distinct_counts(t):
    return t("documents").groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n"), F.countDistinct(F.md5("text")).alias("texts"))


_MISSING = "WITH m AS (SELECT l_orderkey, max(l_linenumber) AS m FROM lineitem GROUP BY 1), g AS (SELECT l_orderkey, unnest(range(1, m + 1)) AS ln FROM m), x AS (SELECT l_orderkey, CAST(ln AS INTEGER) AS l_linenumber FROM g WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = g.l_orderkey AND l.l_linenumber = ln))"


@query(_MISSING + " SELECT * FROM x")
def ag8_missing_grid(t):
    return a.missing_cells(t("lineitem"), ["l_orderkey"], "l_linenumber")


@query(_MISSING + ", i AS (SELECT *, l_linenumber - row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS g FROM x), q AS (SELECT l_orderkey, g, min(l_linenumber) AS lo, max(l_linenumber) AS hi FROM i GROUP BY 1, 2) SELECT l_orderkey, string_agg(CASE WHEN lo = hi THEN CAST(lo AS VARCHAR) ELSE lo || '-' || hi END, ', ' ORDER BY lo) AS ranges FROM q GROUP BY 1")
def ag9_ranges(t):
    return a.ranges(a.missing_cells(t("lineitem"), ["l_orderkey"], "l_linenumber"), ["l_orderkey"], "l_linenumber")


@query("SELECT l_suppkey, median(l_extendedprice) AS price, coalesce(median(CASE WHEN l_tax > 0.079 AND l_quantity > 49 THEN l_tax END), 8.0) AS voxel FROM lineitem GROUP BY 1")
def ag11_group_medians(t):
    return t("lineitem").groupBy("l_suppkey").agg(F.median("l_extendedprice").alias("price"), F.coalesce(F.median(F.when((F.col("l_tax") > 0.079) & (F.col("l_quantity") > 49), F.col("l_tax"))), F.lit(8.0)).alias("voxel"))


@query("SELECT l_returnflag, round(quantile_cont(l_quantity, 0.05), 6) AS p5, round(quantile_cont(l_quantity, 0.5), 6) AS p50, round(quantile_cont(l_quantity, 0.95), 6) AS p95, round(avg(CASE WHEN abs(l_quantity / 25 - 1) <= 0.1 THEN 1.0 ELSE 0.0 END), 6) AS in_band, count(*) FILTER (WHERE l_quantity >= 50) AS clipped FROM lineitem GROUP BY 1")
def ag12_reference_qc(t):
    p = F.percentile("l_quantity", F.array(F.lit(0.05), F.lit(0.5), F.lit(0.95)))
    g = t("lineitem").groupBy("l_returnflag").agg(p.alias("p"), F.avg((F.abs(F.col("l_quantity") / 25 - 1) <= 0.1).cast("double")).alias("b"), F.count_if(F.col("l_quantity") >= 50).alias("clipped"))
    return g.select("l_returnflag", *[r(F.col("p")[i]).alias(n) for i, n in enumerate(("p5", "p50", "p95"))], r("b").alias("in_band"), "clipped")


@query("SELECT l_suppkey, l_returnflag, round(sum(l_discount * l_quantity * l_quantity), 4) AS qq, round(sum(l_discount * l_quantity * l_tax), 4) AS qt, round(sum(l_discount), 4) AS w FROM lineitem GROUP BY 1, 2")
def ag13_pair_sums(t):
    d, q, x = F.col("l_discount"), F.col("l_quantity"), F.col("l_tax")
    return t("lineitem").groupBy("l_suppkey", "l_returnflag").agg(r(F.sum(d * q * q), 4).alias("qq"), r(F.sum(d * q * x), 4).alias("qt"), r(F.sum(d), 4).alias("w"))


@query("SELECT l_suppkey, count(*) AS n, round(sqrt(sum(u * e * e) / sum(u)), 6) AS rms, round(max(abs(e)), 6) AS max, sum(u) < 0.5 * count(*) AS rejected FROM (SELECT l_suppkey, l_quantity - 25 AS e, CASE WHEN l_discount > 0.05 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS u FROM lineitem) GROUP BY 1")
def ag14_pair_residuals(t):
    d = t("lineitem").select("l_suppkey", (F.col("l_quantity") - 25).alias("e"), (F.col("l_discount") > 0.05).cast("double").alias("u"))
    return d.groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("n"), r(F.sqrt(F.sum(F.col("u") * F.col("e") * F.col("e")) / F.sum("u"))).alias("rms"), r(F.max(F.abs("e"))).alias("max"), (F.sum("u") < 0.5 * F.count(F.lit(1))).alias("rejected"))


@query("WITH p AS (SELECT label, unnest(embedding)::DOUBLE AS v, unnest(range(64)) AS i FROM embeddings) SELECT label, i AS pixel, count(*) AS n, round(avg(v), 6) AS mean FROM p GROUP BY 1, 2")
def ag15_pixel_mean(t):
    return t("embeddings").select("label", F.posexplode("embedding").alias("i", "v")).groupBy("label", F.col("i").cast("long").alias("pixel")).agg(F.count(F.lit(1)).alias("n"), r(F.avg(F.col("v").cast("double"))).alias("mean"))


@query("WITH p AS (SELECT label, unnest(embedding)::DOUBLE AS v, unnest(range(64)) AS i FROM embeddings), m AS (SELECT label, i, median(v) AS m FROM p GROUP BY 1, 2) SELECT label, i AS pixel, round(m / sqrt(sum(m * m) OVER (PARTITION BY label)), 6) AS shape FROM m")
def ag16_median_shape(t):
    m = t("embeddings").select("label", F.posexplode("embedding").alias("i", "v")).groupBy("label", F.col("i").cast("long").alias("pixel")).agg(F.median(F.col("v").cast("double")).alias("m"))
    return m.select("label", "pixel", r(F.col("m") / F.sqrt(F.sum(F.col("m") * F.col("m")).over(W.partitionBy("label")))).alias("shape"))


_HIST = "SELECT l_returnflag AS c, CAST(l_quantity AS BIGINT) AS bin, count(*) AS n FROM lineitem GROUP BY 1, 2"


def hist(t):
    return t("lineitem").groupBy(F.col("l_returnflag").alias("c"), F.col("l_quantity").cast("long").alias("bin")).agg(F.count(F.lit(1)).alias("n"))


@query(_HIST)
def ag17_histogram(t):
    return hist(t)


@query(f"WITH h AS ({_HIST}), s AS (SELECT *, sum(n) OVER (PARTITION BY c ORDER BY bin) AS s, sum(n) OVER (PARTITION BY c) AS t FROM h) SELECT c, min(bin) AS p FROM s WHERE s >= 0.9 * t GROUP BY 1")
def ag18_histogram_percentile(t):
    return a.histogram_percentile(hist(t), ["c"], "bin", "n", 0.9)


@query("WITH c AS (SELECT l_suppkey, l_partkey % 10 AS cell, avg(l_extendedprice) AS m FROM lineitem GROUP BY 1, 2) SELECT l_suppkey, round(median(m), 4) AS v FROM c GROUP BY 1")
def ag19_median_of_cells(t):
    c = t("lineitem").groupBy("l_suppkey", (F.col("l_partkey") % 10).alias("cell")).agg(F.avg("l_extendedprice").alias("m"))
    return c.groupBy("l_suppkey").agg(r(F.median("m"), 4).alias("v"))


@query("SELECT l_suppkey, round(quantile_cont(l_tax, 0.01), 6) AS rq_1, round(quantile_cont(l_tax, 0.5), 6) AS rq_50, round(quantile_cont(l_tax, 0.99), 6) AS rq_99 FROM lineitem GROUP BY 1")
def ag20_quantile_vector(t):
    g = t("lineitem").groupBy("l_suppkey").agg(F.percentile("l_tax", F.array(F.lit(0.01), F.lit(0.5), F.lit(0.99))).alias("q"))
    return g.select("l_suppkey", *[r(F.col("q")[i]).alias(f"rq_{n}") for i, n in enumerate((1, 50, 99))])


@query("WITH q AS (SELECT l_returnflag AS f, quantile_cont(l_extendedprice, [0, 0.25, 0.5, 0.75, 1]) AS q FROM lineitem GROUP BY 1), x AS (SELECT f, q, unnest([5000.0, 20000.0, 60000.0])::DOUBLE AS x FROM q) SELECT f, x, round(CASE WHEN x <= q[1] THEN 0 WHEN x >= q[5] THEN 1 ELSE list_sum(list_transform([1, 2, 3, 4], lambda i: 0.25 * greatest(0, least(1, (x - q[i]) / (q[i + 1] - q[i]))))) END, 6) AS cdf FROM x")
def ag21_cdf_lookup(t):
    g = t("lineitem").groupBy(F.col("l_returnflag").alias("f")).agg(F.percentile("l_extendedprice", F.array(*[F.lit(x) for x in (0.0, 0.25, 0.5, 0.75, 1.0)])).alias("q"))
    x = g.withColumn("x", F.explode(F.array(F.lit(5000.0), F.lit(20000.0), F.lit(60000.0))))
    part = F.aggregate(F.sequence(F.lit(0), F.lit(3)), F.lit(0.0), lambda s, i: s + 0.25 * F.greatest(F.lit(0.0), F.least(F.lit(1.0), (F.col("x") - F.get("q", i)) / (F.get("q", i + 1) - F.get("q", i)))))
    return x.select("f", "x", r(F.when(F.col("x") <= F.col("q")[0], 0.0).when(F.col("x") >= F.col("q")[4], 1.0).otherwise(part)).alias("cdf"))


@query("SELECT l_orderkey, median((1 + l_discount) * l_quantity + l_tax) AS v FROM lineitem GROUP BY 1")
def ag22_common_window(t):
    return t("lineitem").groupBy("l_orderkey").agg(F.median((1 + F.col("l_discount")) * F.col("l_quantity") + F.col("l_tax")).alias("v"))


@query("WITH b AS (SELECT l_suppkey AS s, l_partkey % 20 AS b, median(l_quantity) FILTER (WHERE l_linestatus = 'F') AS x, median(l_quantity) FILTER (WHERE l_linestatus = 'O') AS y, count(*) AS n FROM lineitem GROUP BY 1, 2) SELECT s, count(*) AS stretches, median(y - x) AS step FROM b WHERE n >= 10 AND x IS NOT NULL AND y IS NOT NULL GROUP BY 1")
def ag23_seam_step(t):
    side = [F.median(F.when(F.col("l_linestatus") == s, F.col("l_quantity"))) for s in "FO"]
    b = t("lineitem").groupBy(F.col("l_suppkey").alias("s"), (F.col("l_partkey") % 20).alias("b")).agg(side[0].alias("x"), side[1].alias("y"), F.count(F.lit(1)).alias("n"))
    return b.filter("n >= 10 AND x IS NOT NULL AND y IS NOT NULL").groupBy("s").agg(F.count(F.lit(1)).alias("stretches"), F.median(F.col("y") - F.col("x")).alias("step"))


@query("SELECT l_returnflag, median(abs(l_quantity - 25)) AS med, count(*) FILTER (WHERE abs(l_quantity - 25) > 20) AS over FROM lineitem GROUP BY 1")
def ag24_step_summary(t):
    d = F.abs(F.col("l_quantity") - 25)
    return t("lineitem").groupBy("l_returnflag").agg(F.median(d).alias("med"), F.count_if(d > 20).alias("over"))


@query("SELECT coalesce(p_brand, 'all') AS p_brand, round(stddev_samp(p_retailprice) / avg(p_retailprice), 6) AS cv, count(*) AS n FROM part GROUP BY GROUPING SETS ((p_brand), ())")
def ag25_cv_total(t):
    g = t("part").rollup("p_brand").agg((F.stddev_samp("p_retailprice") / F.avg("p_retailprice")).alias("cv"), F.count(F.lit(1)).alias("n"))
    return g.select(F.coalesce("p_brand", F.lit("all")).alias("p_brand"), r("cv").alias("cv"), "n")


@query("SELECT CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS BIGINT) AS day, count(*) FILTER (WHERE value > 100) AS jumps FROM events GROUP BY 1")
def ag26_jumps_per_day(t):
    return t("events").groupBy(F.datediff("ts", F.lit("2024-01-01").cast("date")).cast("long").alias("day")).agg(F.count_if(F.col("value") > 100).alias("jumps"))


@query("WITH b AS (SELECT s_nationkey AS n, s_acctbal AS x0, s_acctbal + 100 + s_suppkey AS x1 FROM supplier), m AS (SELECT median(x1 - x0) AS m FROM b) SELECT n, min(x0) AS x0, max(x1) AS x1, round(max(x1) - min(x0), 4) AS extent, max(x1 - x0) > 1.5 * any_value(m) AS outlier FROM b, m GROUP BY 1")
def ag27_canvas(t):
    b = t("supplier").select(F.col("s_nationkey").alias("n"), F.col("s_acctbal").alias("x0"), (F.col("s_acctbal") + 100 + F.col("s_suppkey")).alias("x1"))
    m = b.agg(F.median(F.col("x1") - F.col("x0")).alias("m"))  # one row
    return b.join(F.broadcast(m)).groupBy("n").agg(F.min("x0").alias("x0"), F.max("x1").alias("x1"), r(F.max("x1") - F.min("x0"), 4).alias("extent"), (F.max(F.col("x1") - F.col("x0")) > 1.5 * F.first("m")).alias("outlier"))


@query("WITH s AS (SELECT l_suppkey, quantile_cont(l_extendedprice, 0.005) AS lo, quantile_cont(l_extendedprice, 0.995) AS hi FROM lineitem GROUP BY 1) SELECT round(quantile_cont(lo, 0.01), 4) AS lo, round(quantile_cont(hi, 0.99), 4) AS hi FROM s")
def ag28_fixed_window(t):
    s = t("lineitem").groupBy("l_suppkey").agg(F.percentile("l_extendedprice", F.lit(0.005)).alias("lo"), F.percentile("l_extendedprice", F.lit(0.995)).alias("hi"))
    return s.agg(r(F.percentile("lo", F.lit(0.01)), 4).alias("lo"), r(F.percentile("hi", F.lit(0.99)), 4).alias("hi"))


@query("WITH p AS (SELECT vec_id, unnest(embedding)::DOUBLE AS v, unnest(range(64)) AS i FROM embeddings), d AS (SELECT vec_id, v - lag(v) OVER (PARTITION BY vec_id ORDER BY i) AS d FROM p), m AS (SELECT *, median(d) OVER (PARTITION BY vec_id) AS m FROM d WHERE d IS NOT NULL) SELECT vec_id, round(1.4826 * median(abs(d - m)) / sqrt(2.0), 6) AS noise FROM m GROUP BY 1")
def ag29_texture_noise(t):
    from ..operators.windows import noise

    p = t("embeddings").select("vec_id", F.posexplode("embedding").alias("i", "v")).withColumn("v", F.col("v").cast("double"))
    return noise(p, "v", "i", ["vec_id"]).select("vec_id", r("noise").alias("noise"))


@query("WITH s AS (SELECT l_returnflag AS g, l_quantity AS s, CASE WHEN l_discount > 0.05 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS y FROM lineitem), t AS (SELECT g, s, sum(y) AS p, count(*) AS n FROM s GROUP BY 1, 2), k AS (SELECT *, coalesce(sum(n) OVER (PARTITION BY g ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + (n + 1) / 2.0 AS rk FROM t), a AS (SELECT g, sum(rk * p) AS s, sum(p) AS pos, sum(n) AS al FROM k GROUP BY 1) SELECT g, round(CAST((s - pos * (pos + 1) / 2) / (pos * (al - pos)) AS DOUBLE), 6) AS auc FROM a")
def ag30_auc(t):
    s = t("lineitem").select(F.col("l_returnflag").alias("g"), F.col("l_quantity").alias("s"), "l_discount")
    return a.auc(s, ["g"], "s", F.col("l_discount") > 0.05).select("g", r("auc").alias("auc"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, round(1.0 / count(*) OVER (PARTITION BY l_returnflag, l_linestatus) / (SELECT count(DISTINCT (l_returnflag, l_linestatus)) FROM lineitem), 9) AS w FROM lineitem")
def ag31_balanced_weights(t):
    l = t("lineitem")
    groups = l.select("l_returnflag", "l_linestatus").groupBy("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("n"))
    groups = groups.withColumn("k", F.count(F.lit(1)).over(W.partitionBy(F.lit(1))))  # a row for each group
    return l.join(F.broadcast(groups), ["l_returnflag", "l_linestatus"]).select("l_orderkey", "l_linenumber", "l_partkey", r(F.lit(1.0) / F.col("n") / F.col("k"), 9).alias("w"))


@query("SELECT l_suppkey AS z, CAST(floor(l_partkey / 500) AS BIGINT) AS blk, round(avg(CASE WHEN l_discount = 0 THEN 1.0 ELSE 0.0 END), 6) AS f FROM lineitem GROUP BY 1, 2")
def ag32_clipping(t):
    return t("lineitem").groupBy(F.col("l_suppkey").alias("z"), F.floor(F.col("l_partkey") / 500).alias("blk")).agg(r(F.avg((F.col("l_discount") == 0).cast("double"))).alias("f"))


@query("WITH m AS (SELECT l_suppkey AS z, l_linenumber AS tile, avg(l_quantity) AS x, avg(l_tax * 1000) AS y FROM lineitem GROUP BY 1, 2), d AS (SELECT z, sqrt((x - lag(x) OVER o) ** 2 + (y - lag(y) OVER o) ** 2) AS d FROM m WINDOW o AS (PARTITION BY tile ORDER BY z)) SELECT z, round(max(d), 6) AS d FROM d WHERE d IS NOT NULL GROUP BY 1")
def ag33_tile_jumps(t):
    m = t("lineitem").groupBy(F.col("l_suppkey").alias("z"), F.col("l_linenumber").alias("tile")).agg(F.avg("l_quantity").alias("x"), F.avg(F.col("l_tax") * 1000).alias("y"))
    o = W.partitionBy("tile").orderBy("z")
    d = m.withColumn("d", F.hypot(F.col("x") - F.lag("x").over(o), F.col("y") - F.lag("y").over(o)))
    return d.filter("d IS NOT NULL").groupBy("z").agg(r(F.max("d")).alias("d"))


@query("WITH w AS (SELECT unnest([10.0, 20.0, 30.0])::DOUBLE AS w), s AS (SELECT l_suppkey, w, avg(CASE WHEN abs(l_quantity - 25) > w / 2 THEN 1.0 ELSE 0.0 END) AS f FROM lineitem, w GROUP BY 1, 2) SELECT w, round(median(f), 6) AS med, round(quantile_cont(f, 0.95), 6) AS p95 FROM s GROUP BY 1")
def ag34_candidate_widths(t):
    per = t("lineitem").groupBy("l_suppkey").agg(F.array(*[F.struct(F.lit(x).alias("w"), F.avg((F.abs(F.col("l_quantity") - 25) > x / 2).cast("double")).alias("f")) for x in (10.0, 20.0, 30.0)]).alias("c"))
    return per.select(F.explode("c").alias("c")).groupBy("c.w").agg(r(F.median("c.f")).alias("med"), r(F.percentile("c.f", F.lit(0.95))).alias("p95"))


@query("WITH p AS (SELECT unnest(embedding)::DOUBLE AS v, unnest(range(64)) AS i FROM embeddings) SELECT CAST(floor(i / 8) AS BIGINT) AS bin, round(avg(v), 6) AS mean FROM p GROUP BY 1")
def ag35_profile(t):
    return t("embeddings").select(F.posexplode("embedding").alias("i", "v")).groupBy(F.floor(F.col("i") / 8).alias("bin")).agg(r(F.avg(F.col("v").cast("double"))).alias("mean"))


# -- robust fits ----------------------------------------------------------------------------------------------------

_PAIRS = "SELECT a.l_returnflag AS f, a.l_extendedprice AS x, b.l_extendedprice AS y FROM lineitem a JOIN lineitem b ON a.l_orderkey = b.l_orderkey AND a.l_linenumber = b.l_linenumber - 1"


def price_pairs(t):
    l = t("lineitem")
    b = l.select("l_orderkey", (F.col("l_linenumber") - 1).alias("l_linenumber"), F.col("l_extendedprice").alias("y"))
    return l.select("l_orderkey", "l_linenumber", F.col("l_returnflag").alias("f"), F.col("l_extendedprice").alias("x")).join(b, ["l_orderkey", "l_linenumber"]).select("f", "x", "y")


def _round_sql(n: int) -> str:
    return f""", r{n} AS (SELECT p.*, x - (gain * y + off) AS r FROM p JOIN l{n - 1} USING (f)), m{n} AS (SELECT f, median(r) AS mid FROM r{n} GROUP BY 1), s{n} AS (SELECT f, mid, 1.4826 * median(abs(r - mid)) AS sg FROM r{n} JOIN m{n} USING (f) GROUP BY 1, 2),
l{n} AS (SELECT f, stddev_pop(x) / stddev_pop(y) AS gain, avg(x) - stddev_pop(x) / stddev_pop(y) * avg(y) AS off, count(*) AS n FROM r{n} JOIN s{n} USING (f) WHERE abs(r - mid) <= 1.2 * greatest(sg, 1e-6) GROUP BY 1)"""


@query(f"WITH p AS ({_PAIRS}), l0 AS (SELECT f, (quantile_cont(x, 0.75) - quantile_cont(x, 0.25)) / (quantile_cont(y, 0.75) - quantile_cont(y, 0.25)) AS gain, median(x) - (quantile_cont(x, 0.75) - quantile_cont(x, 0.25)) / (quantile_cont(y, 0.75) - quantile_cont(y, 0.25)) * median(y) AS off FROM p GROUP BY 1)" + "".join(_round_sql(i) for i in (1, 2, 3, 4)) + ' SELECT f, round(gain, 6) AS gain, round(off, 3) AS "offset", n FROM l4')
def nu4_robust_relation(t):
    return a.robust_line(price_pairs(t), ["f"], "x", "y", reject=1.2).select("f", r("gain").alias("gain"), r("offset", 3).alias("offset"), "n")


@query(f'WITH p AS ({_PAIRS}), q AS (SELECT f, quantile_cont(x, 0.25) AS a, median(x) AS b, quantile_cont(x, 0.75) AS c, quantile_cont(y, 0.25) AS d, median(y) AS e, quantile_cont(y, 0.75) AS g FROM p GROUP BY 1) SELECT f, round((c - a) / (g - d), 6) AS gain, round(b - (c - a) / (g - d) * e, 4) AS "offset" FROM q')
def nu5_iqr_relation(t):
    return a.iqr_line(price_pairs(t), ["f"], "x", "y").select("f", r("gain").alias("gain"), r("offset", 4).alias("offset"))


_XY = "SELECT label AS g, embedding[1]::DOUBLE AS x, embedding[2]::DOUBLE AS y, embedding[3]::DOUBLE AS u, embedding[4]::DOUBLE AS v FROM embeddings"


def points(t):
    e = F.col("embedding")
    return t("embeddings").select(F.col("label").alias("g"), *[e[i].cast("double").alias(n) for i, n in enumerate("xyuv")])


@query(f"SELECT g, round(avg(u - x), 6) AS tx, round(avg(v - y), 6) AS ty FROM ({_XY}) GROUP BY 1")
def nu1_translation(t):
    return a.translation(points(t), ["g"], "x", "y", "u", "v").select("g", r("tx").alias("tx"), r("ty").alias("ty"))


_CENTRED = f"WITH p AS ({_XY}), m AS (SELECT *, avg(x) OVER w AS mx, avg(y) OVER w AS my, avg(u) OVER w AS mu, avg(v) OVER w AS mv FROM p WINDOW w AS (PARTITION BY g)), s AS (SELECT g, any_value(mx) AS mx, any_value(my) AS my, any_value(mu) AS mu, any_value(mv) AS mv, sum((x-mx)*(x-mx)) AS xx, sum((x-mx)*(y-my)) AS xy, sum((y-my)*(y-my)) AS yy, sum((x-mx)*(u-mu)) AS xu, sum((y-my)*(u-mu)) AS yu, sum((x-mx)*(v-mv)) AS xv, sum((y-my)*(v-mv)) AS yv FROM m GROUP BY 1)"


@query(_CENTRED + ", f AS (SELECT *, (xu + yv) / (xx + yy) AS a, (xv - yu) / (xx + yy) AS b FROM s) SELECT g, round(a, 6) AS a, round(b, 6) AS b, round(mu - a * mx + b * my, 6) AS tx, round(mv - b * mx - a * my, 6) AS ty FROM f")
def nu1_similarity(t):
    return _rounded(a.similarity(points(t), ["g"], "x", "y", "u", "v"), [], 6)


@query(_CENTRED + ", f AS (SELECT *, (xu * yy - yu * xy) / (xx * yy - xy * xy) AS a, (yu * xx - xu * xy) / (xx * yy - xy * xy) AS b, (xv * yy - yv * xy) / (xx * yy - xy * xy) AS c, (yv * xx - xv * xy) / (xx * yy - xy * xy) AS d FROM s) SELECT g, round(a, 6) AS a, round(b, 6) AS b, round(mu - a * mx - b * my, 6) AS tx, round(c, 6) AS c, round(d, 6) AS d, round(mv - c * mx - d * my, 6) AS ty FROM f")
def nu1_affine(t):
    return _rounded(a.affine(points(t), ["g"], "x", "y", "u", "v"), [], 6)


@query(f"WITH p AS ({_XY}) SELECT g, round(sqrt(avg((u - (0.5 * x + 0.1)) ** 2 + (v - (0.5 * y - 0.1)) ** 2)), 6) AS rms FROM p GROUP BY 1")
def nu3_residuals(t):
    d = F.hypot(F.col("u") - (0.5 * F.col("x") + 0.1), F.col("v") - (0.5 * F.col("y") - 0.1))
    return points(t).groupBy("g").agg(r(F.sqrt(F.avg(d * d))).alias("rms"))


@query("WITH m AS (SELECT *, median(l_extendedprice) OVER (PARTITION BY l_suppkey) AS m FROM lineitem), d AS (SELECT *, median(abs(l_extendedprice - m)) OVER (PARTITION BY l_suppkey) AS s FROM m) SELECT l_suppkey, count(*) FILTER (WHERE abs(l_extendedprice - m) <= greatest(100, 1.0 * 1.4826 * s)) AS kept, avg(CASE WHEN abs(l_extendedprice - m) <= greatest(100, 1.0 * 1.4826 * s) THEN 1.0 ELSE 0.0 END) < 0.5 AS rejected FROM d GROUP BY 1")
def nu16_mad_reject(t):
    k = a.mad_reject(t("lineitem"), ["l_suppkey"], "l_extendedprice", 100.0, 1.0)
    return k.groupBy("l_suppkey").agg(F.count_if("keep").alias("kept"), (F.avg(F.col("keep").cast("double")) < 0.5).alias("rejected"))


@query(f"WITH h AS ({_HIST}), s AS (SELECT *, sum(n) OVER w AS w0, sum(n * bin) OVER w AS s0, sum(n) OVER (PARTITION BY c) AS wt, sum(n * bin) OVER (PARTITION BY c) AS st FROM h WINDOW w AS (PARTITION BY c ORDER BY bin)), b AS (SELECT c, bin, CAST(w0 AS DOUBLE) * (wt - w0) * (s0 / CAST(w0 AS DOUBLE) - (st - s0) / CAST(wt - w0 AS DOUBLE)) ** 2 AS v FROM s WHERE wt > w0) SELECT c, bin AS threshold FROM (SELECT *, row_number() OVER (PARTITION BY c ORDER BY v DESC, bin) AS k FROM b) WHERE k = 1")
def nu34_otsu(t):
    return a.otsu(hist(t), ["c"], "bin", "n")
