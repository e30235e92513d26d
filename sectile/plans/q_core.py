"""Levels, inventories, plans and the remaining table operators on the driver tables."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import scalars as s

from ..operators import aggregates as a
from ..operators import joins as j
from ..operators import levels as lv
from ..operators import windows as w
from .base import query, r

_STATS = "SELECT date_diff('day', DATE '1990-01-01', CAST(l_shipdate AS DATE)) // 7 AS z, l_returnflag AS tile, quantile_cont(l_extendedprice, 0.05) AS p5, quantile_cont(l_extendedprice, 0.5) AS p50, quantile_cont(l_extendedprice, 0.95) AS p95 FROM lineitem GROUP BY 1, 2"


def stats(t):
    q = F.percentile("l_extendedprice", F.array(F.lit(0.05), F.lit(0.5), F.lit(0.95)))
    g = t("lineitem").groupBy(F.floor(F.datediff("l_shipdate", F.lit("1990-01-01").cast("date")) / 7).alias("z"), F.col("l_returnflag").alias("tile")).agg(q.alias("q"))
    return g.select("z", "tile", *[F.col("q")[i].alias(n) for i, n in enumerate(("p5", "p50", "p95"))]).withColumn("block", F.floor(F.col("z") / 100))


_LEVELS = f"""WITH st AS (SELECT *, z // 100 AS block FROM ({_STATS})), rw AS (SELECT *, p50 - 140.0 / 160 * greatest(p95 - p5, 1) AS lo_raw, p50 + 115.0 / 160 * greatest(p95 - p5, 1) AS hi_raw FROM st),
sm AS (SELECT *, median(lo_raw) OVER w AS lo, median(hi_raw) OVER w AS hi, median(p50) OVER w AS m FROM rw WINDOW w AS (PARTITION BY tile, block ORDER BY z ROWS BETWEEN 25 PRECEDING AND 25 FOLLOWING)),
ju AS (SELECT *, median((p50 - m) / (hi - lo)) OVER (PARTITION BY z) * (hi - lo) AS jump FROM sm), lv AS (SELECT z, tile, lo + jump AS lo, hi + jump AS hi, lo_raw, hi_raw FROM ju)"""


@query(_LEVELS + " SELECT z, tile, round(lo + 1e-8, 5) AS lo, round(hi + 1e-8, 5) AS hi FROM lv")
def display_levels(t):
    """The flagship: for every slice and tile the display window that keeps brightness steady."""
    return lv.levels(stats(t), "z", "tile", "block").select("z", "tile", r(F.col("lo") + 1e-8, 5).alias("lo"), r(F.col("hi") + 1e-8, 5).alias("hi"))


@query(_LEVELS + " SELECT z, tile, round(lo_raw + 1e-8, 5) AS lo_raw, round(hi_raw + 1e-8, 5) AS hi_raw FROM lv")
def nu28_start_windows(t):
    return lv.start_windows(stats(t)).select("z", "tile", r(F.col("lo_raw") + 1e-8, 5).alias("lo_raw"), r(F.col("hi_raw") + 1e-8, 5).alias("hi_raw"))


_MAPS = "SELECT z, tile, 1 + (ascii(tile) % 5 + z % 7) / 50.0::DOUBLE AS g, (z % 11) * 10.0::DOUBLE AS o FROM lv WHERE z % 5 = 0 AND tile <> 'N'"


@query(_LEVELS + f""", mp AS ({_MAPS}), an AS (SELECT tile, median(lo) AS r1, median(hi) AS r2 FROM lv GROUP BY 1), ms AS (SELECT z, tile, median(g * r1 + o) OVER w AS m1, median(g * r2 + o) OVER w AS m2 FROM mp JOIN an USING (tile) WINDOW w AS (PARTITION BY tile ORDER BY z ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING)),
br AS (SELECT lv.*, (SELECT max(x.z) FROM ms x WHERE x.tile = lv.tile AND x.z <= lv.z) AS z0, (SELECT min(x.z) FROM ms x WHERE x.tile = lv.tile AND x.z >= lv.z) AS z1 FROM lv),
ip AS (SELECT b.z, b.tile, b.lo, b.hi, CASE WHEN z0 IS NULL THEN y.m1 WHEN z1 IS NULL OR z0 = z1 THEN x.m1 ELSE x.m1 + (y.m1 - x.m1) * (b.z - z0) / (z1 - z0) END AS m1, CASE WHEN z0 IS NULL THEN y.m2 WHEN z1 IS NULL OR z0 = z1 THEN x.m2 ELSE x.m2 + (y.m2 - x.m2) * (b.z - z0) / (z1 - z0) END AS m2 FROM br b LEFT JOIN ms x ON x.tile = b.tile AND x.z = z0 LEFT JOIN ms y ON y.tile = b.tile AND y.z = z1),
gg AS (SELECT *, (m2 - m1) / (r2 - r1) AS g FROM ip JOIN an USING (tile)), go AS (SELECT *, m1 - g * r1 AS o FROM gg) SELECT z, tile, round(coalesce((median(g * lo + o) OVER (PARTITION BY z) - o) / g, lo), 3) AS lo, round(coalesce((median(g * hi + o) OVER (PARTITION BY z) - o) / g, hi), 3) AS hi FROM go""")
def nu27_balance(t):
    l = lv.levels(stats(t), "z", "tile", "block").select("z", "tile", "lo", "hi")
    m = l.filter("z % 5 = 0 AND tile <> 'N'").select("z", "tile", (1 + (F.ascii("tile") % 5 + F.col("z") % 7) / 50.0).alias("g"), (F.col("z") % 11 * 10.0).alias("o"))
    return lv.balanced(l, m, "z", "tile", 3).select("z", "tile", r("lo", 3).alias("lo"), r("hi", 3).alias("hi"))


@query("WITH p AS (SELECT l_quantity / 10 AS d, 1 - l_quantity / 60 + l_discount AS v FROM lineitem), b AS (SELECT round_even(2 * d, 0) AS b, median(d) AS d, median(v) AS v, count(*) AS n FROM p GROUP BY 1 HAVING b > 0 AND n >= 5 UNION ALL SELECT 0, 0, 1, 0) SELECT round(d, 6) AS d, round(min(v) OVER (ORDER BY d ROWS UNBOUNDED PRECEDING) - 1e-6 * (row_number() OVER (ORDER BY d) - 1), 7) AS v FROM b")
def nu30_falling_curve(t):
    p = t("lineitem").select((F.col("l_quantity") / 10).alias("d"), (1 - F.col("l_quantity") / 60 + F.col("l_discount")).alias("v"))
    return lv.falling_curve(p, "d", "v").select(r("d").alias("d"), r("v", 7).alias("v"))


_WEEK = "SELECT o_orderpriority AS p, date_diff('day', DATE '1990-01-01', CAST(o_orderdate AS DATE)) // 7 AS x, round(sum(o_totalprice), 2) AS v FROM orders GROUP BY 1, 2"


def _rung(i, h):
    return f", e{i} AS (SELECT a.p, a.x, median(b.v) AS e, 2 * 1.2533 * 300000.0 / sqrt(count(*)) AS u FROM d a JOIN d b ON a.p = b.p AND abs(a.x - b.x) <= {h} GROUP BY 1, 2)"


@query(f"WITH d AS ({_WEEK})" + "".join(_rung(i, h) for i, h in enumerate((2, 3, 4, 6))) + " SELECT p, x, round(CASE WHEN greatest(e0.e - e0.u, e1.e - e1.u) > least(e0.e + e0.u, e1.e + e1.u) THEN e0.e WHEN greatest(e0.e - e0.u, e1.e - e1.u, e2.e - e2.u) > least(e0.e + e0.u, e1.e + e1.u, e2.e + e2.u) THEN e1.e WHEN greatest(e0.e - e0.u, e1.e - e1.u, e2.e - e2.u, e3.e - e3.u) > least(e0.e + e0.u, e1.e + e1.u, e2.e + e2.u, e3.e + e3.u) THEN e2.e ELSE e3.e END, 4) AS smooth FROM e0 JOIN e1 USING (p, x) JOIN e2 USING (p, x) JOIN e3 USING (p, x)")
def wn12_adaptive(t):
    d = t("orders").groupBy(F.col("o_orderpriority").alias("p"), F.floor(F.datediff("o_orderdate", F.lit("1990-01-01").cast("date")) / 7).alias("x")).agg(r(F.sum("o_totalprice"), 2).alias("v"))
    return lv.adaptive(d, ["p"], "x", "v", F.lit(300000.0), [2, 3, 4, 6]).select("p", "x", r("smooth", 4).alias("smooth"))


@query("SELECT a.s_suppkey AS a, b.s_suppkey AS b, 'right' AS side FROM supplier a JOIN supplier b ON b.s_suppkey = a.s_suppkey + 1 AND b.s_suppkey % 10 <> 0 UNION ALL SELECT a.s_suppkey, b.s_suppkey, 'below' FROM supplier a JOIN supplier b ON b.s_suppkey = a.s_suppkey + 10")
def wn25_grid_neighbours(t):
    k = t("supplier").select(F.col("s_suppkey").alias("b"))
    step = k.select((F.col("b") - 1).alias("a"), "b", F.lit("right").alias("side")).filter("b % 10 <> 0").unionByName(k.select((F.col("b") - 10).alias("a"), "b", F.lit("below").alias("side")))
    return step.join(k.withColumnRenamed("b", "a"), "a", "left_semi").select("a", "b", "side")


# -- sources, sinks, plans ------------------------------------------------------------------------------------------


@query("SELECT page_id, length(html) AS size, 8 + page_id % 50 * 300 AS expected, length(html) < 8 + page_id % 50 * 300 AS truncated, CASE page_id % 3 WHEN 0 THEN 1000.0 WHEN 1 THEN 1.0 ELSE 25400000.0 END::DOUBLE * 2 AS nm FROM pages")
def src2_header_properties(t):
    from ..sources.stacks import unit_nm

    h = t("pages").select("page_id", F.length("html").cast("long").alias("size"), (8 + F.col("page_id") % 50 * 300).alias("expected"), F.element_at(F.array(F.lit("micron"), F.lit("nm"), F.lit("inch")), (F.col("page_id") % 3 + 1).cast("int")).alias("unit"))
    return h.select("page_id", "size", "expected", (F.col("size") < F.col("expected")).alias("truncated"), (2 * unit_nm(F.col("unit"))).alias("nm"))


@query("SELECT page_id, regexp_extract(url, '//([^/]*)/([a-z]*)/([0-9]+)', 1) AS host, regexp_extract(url, '//([^/]*)/([a-z]*)/([0-9]+)', 2) AS lang, regexp_extract(url, '//([^/]*)/([a-z]*)/([0-9]+)', 3) AS num, regexp_matches(url, '//([^/]*)/([a-z]*)/([0-9]+)') AS matched FROM pages")
def src5_listing(t):
    from ..sources.stacks import named_groups

    p = r"//(?P<host>[^/]*)/(?P<lang>[a-z]*)/(?P<num>[0-9]+)"
    return named_groups(t("pages").select("page_id", "url"), "url", p).select("page_id", "host", "lang", "num", "matched")


@query("SELECT page_id, concat_ws(';', md5(substr(html, 1, 40)), md5(substr(html, length(html) // 2 + 1, 40)), CASE WHEN replace(right(html, 40), right(html, 1), '') = '' THEN '-' ELSE md5(right(html, 40)) END) AS hashes FROM pages")
def src7_fingerprint(t):
    from ..sources.stacks import fingerprint

    return t("pages").select("page_id", fingerprint("html", 40).alias("hashes"))


@query("SELECT o_orderkey, lower(o_orderstatus) IN ('o', 'f') AS seam, CAST(o_orderkey % 7 AS VARCHAR) || '-' || CAST(o_custkey % 3 AS VARCHAR) AS tile FROM orders WHERE o_orderstatus <> 'P'")
def src8_slice_list(t):
    o = t("orders").filter("o_orderstatus <> 'P'")
    return o.select("o_orderkey", F.lower("o_orderstatus").isin("o", "f").alias("seam"), F.concat_ws("-", F.col("o_orderkey") % 7, F.col("o_custkey") % 3).alias("tile"))


@query("SELECT s_nationkey AS n, CAST(count(*) AS BIGINT) AS rows, md5(string_agg(CAST(s_suppkey AS VARCHAR), ',' ORDER BY s_suppkey)) AS digest FROM supplier GROUP BY 1")
def or6_plan_digest(t):
    keys = F.transform(F.array_sort(F.collect_list("s_suppkey")), lambda x: x.cast("string"))
    return t("supplier").groupBy(F.col("s_nationkey").alias("n")).agg(F.count(F.lit(1)).alias("rows"), F.md5(F.concat_ws(",", keys)).alias("digest"))


@query("SELECT l_orderkey // 2000 AS chunk, l_orderkey, l_linenumber, l_partkey, n_name FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey")
def src10_chunk_range(t):
    l = t("lineitem").withColumn("chunk", F.floor(F.col("l_orderkey") / 2000))
    m = t("supplier").join(F.broadcast(t("nation")), F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("s_suppkey").alias("l_suppkey"), "n_name")
    return l.join(m, "l_suppkey").select("chunk", "l_orderkey", "l_linenumber", "l_partkey", "n_name")


@query("WITH i AS (SELECT o_orderkey, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) - 1 AS i FROM orders) SELECT o_orderkey, i % 20 AS task, i // 50 AS chunk FROM i")
def or2_task_split(t):
    i = F.row_number().over(W.partitionBy("o_orderpriority").orderBy("o_orderkey")) - 1
    return t("orders").withColumn("i", i).select("o_orderkey", (F.col("i") % 20).cast("long").alias("task"), F.floor(F.col("i") / 50).alias("chunk"))


@query("SELECT DISTINCT o_orderpriority AS segment, o_orderkey // 500 AS chunk, min(o_orderkey) OVER (PARTITION BY o_orderpriority, o_orderkey // 500) AS lo FROM orders")
def or3_chunks(t):
    return t("orders").groupBy(F.col("o_orderpriority").alias("segment"), F.floor(F.col("o_orderkey") / 500).alias("chunk")).agg(F.min("o_orderkey").alias("lo"))


@query("WITH s AS (SELECT l_suppkey // 2 AS parent, max(l_shipdate) AS m FROM lineitem WHERE l_quantity > 40 GROUP BY 1), d AS (SELECT l_suppkey // 2 AS parent, min(l_shipdate) AS made FROM lineitem WHERE l_quantity < 3 GROUP BY 1) SELECT s.parent, d.made IS NULL OR d.made < s.m AS redo FROM s LEFT JOIN d USING (parent)")
def or5_parents_to_redo(t):
    k = F.floor(F.col("l_suppkey") / 2).alias("parent")
    src = t("lineitem").filter("l_quantity > 40").groupBy(k).agg(F.max("l_shipdate").alias("m"))
    made = t("lineitem").filter("l_quantity < 3").groupBy(k).agg(F.min("l_shipdate").alias("made"))
    return src.join(made, "parent", "left").select("parent", (F.col("made").isNull() | (F.col("made") < F.col("m"))).alias("redo"))


@query("SELECT p_partkey, k AS scale, CAST(ceil((p_size * 100 + 7) / (2.0::DOUBLE ** k)) AS BIGINT) AS n FROM part, (SELECT unnest(range(6)) AS k)")
def snk6_scale_shapes(t):
    from ..sources.volumes import scale_length

    return t("part").withColumn("scale", F.explode(F.sequence(F.lit(0), F.lit(5)))).select("p_partkey", F.col("scale").cast("long").alias("scale"), scale_length(F.col("p_size") * 100 + 7, F.col("scale")).alias("n"))


@query("SELECT p_partkey, z, y, z * 64 AS z0, least(z * 64 + 64, p_size * 10) AS z1, y * 128 AS y0, least(y * 128 + 128, p_size * 20) AS y1 FROM part, (SELECT unnest(range(8)) AS z), (SELECT unnest(range(8)) AS y) WHERE z < ceil(p_size * 10 / 64.0) AND y < ceil(p_size * 20 / 128.0)")
def snk5_shard_boxes(t):
    from ..sources.volumes import shard_boxes

    p = t("part").select("p_partkey", (F.col("p_size") * 10).cast("long").alias("nz"), (F.col("p_size") * 20).cast("long").alias("ny"))
    return shard_boxes(p, {"z": ("nz", 64), "y": ("ny", 128)}).select("p_partkey", "z", "y", "z0", "z1", "y0", "y1")


@query("WITH s AS (SELECT p_partkey AS k, sc, CAST(ceil(p_size * 1000 / 2.0::DOUBLE ** sc) AS BIGINT) AS n FROM part, (SELECT unnest(range(6)) AS sc)) SELECT k, coalesce(min(CASE WHEN n * n <= 40000000 THEN sc END), max(sc)) AS scale FROM s GROUP BY 1")
def snk8_choose_scale(t):
    from ..sources.volumes import scale_length

    sc = t("part").select(F.col("p_partkey").alias("k"), "p_size", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(5).cast("long"))).alias("sc"))
    n = scale_length(F.col("p_size") * 1000, F.col("sc"))
    return sc.groupBy("k").agg(F.coalesce(F.min(F.when(n * n <= 40000000, F.col("sc"))), F.max("sc")).alias("scale"))


@query("WITH b AS (SELECT x, y, z, list_sum([(((x >> i) & 1) << (3 * i)) + (((y >> i) & 1) << (3 * i + 1)) + (((z >> i) & 1) << (3 * i + 2)) for i in range(4)])::BIGINT AS m FROM (SELECT unnest(range(9)) AS x), (SELECT unnest(range(5)) AS y), (SELECT unnest(range(7)) AS z)) SELECT m // 64 AS shard, count(*) AS blocks, min(m) AS first FROM b GROUP BY 1")
def snk9_shard_blocks(t):
    spark = t("region").sparkSession
    n = spark.range(9 * 5 * 7).select((F.col("id") % 9).alias("x"), (F.floor(F.col("id") / 9) % 5).alias("y"), F.floor(F.col("id") / 45).alias("z"))
    m = n.withColumn("m", s.morton(F.col("x"), F.col("y"), F.col("z"), 4))
    return m.groupBy(F.floor(F.col("m") / 64).alias("shard")).agg(F.count(F.lit(1)).alias("blocks"), F.min("m").alias("first"))


@query("SELECT o_orderstatus || ': ' || count(*) || ' rows, ' || count(DISTINCT o_custkey) || ' customers' AS line FROM orders GROUP BY o_orderstatus")
def snk3_report_lines(t):
    return t("orders").groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("o_custkey").alias("c")).select(F.concat(F.col("o_orderstatus"), F.lit(": "), F.col("n"), F.lit(" rows, "), F.col("c"), F.lit(" customers")).alias("line"))


@query("SELECT o_orderkey, CAST(round(o_totalprice) AS BIGINT) AS price, printf('%.2f', o_totalprice) AS text FROM orders")
def snk17_plot_table(t):
    return t("orders").select("o_orderkey", F.round("o_totalprice").cast("long").alias("price"), F.format_string("%.2f", "o_totalprice").alias("text"))


# -- the rest of the table functions --------------------------------------------------------------------------------


@query("SELECT l_orderkey, l_linenumber FROM lineitem WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_orderstatus <> 'P') GROUP BY 1, 2")
def mi2_missing_transforms(t):
    o = t("orders").filter("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("l_orderkey"))
    return t("lineitem").select("l_orderkey", "l_linenumber").distinct().join(o, "l_orderkey", "left_anti")


@query("SELECT l_suppkey, min_by(l_partkey, (l_linenumber, l_partkey)) AS reference, min(l_linenumber) AS tile FROM lineitem GROUP BY 1")
def mi6_gauge_tiles(t):
    return t("lineitem").groupBy("l_suppkey").agg(F.min_by("l_partkey", F.struct("l_linenumber", "l_partkey")).alias("reference"), F.min("l_linenumber").alias("tile"))


@query("SELECT n_nationkey, coalesce(m, 'auto') AS mode FROM nation LEFT JOIN (VALUES (3, 'fixed'), (7, 'slice')) o(k, m) ON k = n_nationkey")
def mi7_mode_overrides(t):
    n = t("nation")
    o = n.sparkSession.createDataFrame([(3, "fixed"), (7, "slice")], "n_nationkey int, m string")
    return n.join(F.broadcast(o), "n_nationkey", "left").select("n_nationkey", F.coalesce("m", F.lit("auto")).alias("mode"))


@query("SELECT DISTINCT o_custkey // 10 AS chunk, count(*) OVER (PARTITION BY o_custkey // 10) AS n FROM orders")
def mi11_sample_chunks(t):
    return t("orders").groupBy(F.floor(F.col("o_custkey") / 10).alias("chunk")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT o_orderkey, c_acctbal AS position, c_custkey IS NULL AS lost FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_custkey % 10 <> 0) ON o_custkey = c_custkey")
def mi13_positions(t):
    c = t("customer").filter("c_custkey % 10 <> 0").select(F.col("c_custkey").alias("o_custkey"), F.col("c_acctbal").alias("position"))
    return j.required_left(t("orders").select("o_orderkey", "o_custkey"), c, ["o_custkey"]).select("o_orderkey", "position", F.col("unmatched").alias("lost"))


@query("SELECT a.page_id, CASE WHEN b.page_id IS NULL THEN 'absent' WHEN length(a.html) <> length(b.html) THEN 'shape' ELSE 'ok' END AS state FROM pages a LEFT JOIN pages b ON b.page_id = a.page_id + 1 AND b.page_id % 4 <> 0")
def mi14_reference_files(t):
    p = t("pages").select("page_id", F.length("html").alias("n"))
    ref = p.filter("page_id % 4 <> 0").select((F.col("page_id") - 1).alias("page_id"), F.col("n").alias("m"))
    return p.join(ref, "page_id", "left").select("page_id", F.when(F.col("m").isNull(), "absent").when(F.col("n") != F.col("m"), "shape").otherwise("ok").alias("state"))


@query("WITH g AS (SELECT l_suppkey AS k, min(l_partkey) AS lo, max(l_partkey) AS hi FROM lineitem GROUP BY 1) SELECT k, lo, hi FROM g WHERE lo >= 5")
def mi15_new_spans(t):
    return t("lineitem").groupBy(F.col("l_suppkey").alias("k")).agg(F.min("l_partkey").alias("lo"), F.max("l_partkey").alias("hi")).filter("lo >= 5")


@query("WITH f AS (SELECT page_id, string_split(url, '/') AS f FROM pages WHERE len(string_split(url, '/')) = 5) SELECT f[4] AS scale, max_by(f[3], page_id) AS state, count(*) AS n FROM f GROUP BY 1")
def mi22_last_record(t):
    f = t("pages").select("page_id", F.split("url", "/").alias("f")).filter(F.size("f") == 5)
    return f.groupBy(F.col("f")[3].alias("scale")).agg(F.max_by(F.col("f")[2], "page_id").alias("state"), F.count(F.lit(1)).alias("n"))


@query("WITH b AS (SELECT s_suppkey AS k, s_nationkey AS g, s_acctbal AS lo, s_acctbal + 300 AS hi FROM supplier) SELECT c_custkey, k FROM customer JOIN b ON c_nationkey = g AND c_acctbal >= lo AND c_acctbal < hi")
def mi25_cells_in_boxes(t):
    b = t("supplier").select(F.col("s_suppkey").alias("k"), F.col("s_nationkey").alias("c_nationkey"), F.col("s_acctbal").alias("lo"), (F.col("s_acctbal") + 300).alias("hi"))
    return j.inside(t("customer"), b, ["c_nationkey"], "c_acctbal", "lo", "hi", 300.0).select("c_custkey", "k")


@query("SELECT page_id, CAST(u AS BIGINT) AS z, sha256(url) AS run FROM (SELECT page_id, url, unnest(list_distinct(regexp_extract_all(url, '[0-9]+'))) AS u FROM pages)")
def mi27_z_lists(t):
    return t("pages").select("page_id", "url", F.explode(F.array_distinct(F.regexp_extract_all("url", F.lit("([0-9]+)"), 1))).alias("u")).select("page_id", F.col("u").cast("long").alias("z"), F.sha2("url", 256).alias("run"))


@query("SELECT DISTINCT l_suppkey AS z FROM lineitem WHERE l_tax IS NOT NULL")
def mi30_distinct_z(t):
    return t("lineitem").filter("l_tax IS NOT NULL").select(F.col("l_suppkey").alias("z")).distinct()


@query("WITH i AS (SELECT o_orderkey AS z, o_orderstatus <> lag(o_orderstatus) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS ch, lag(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS b FROM orders) SELECT b AS z_before, z AS z_after, 'change' AS reason FROM i WHERE ch UNION SELECT b, z, 'config' FROM i WHERE z % 997 = 0 AND b IS NOT NULL AND NOT coalesce(ch, false)")
def nu21_interfaces(t):
    o = W.partitionBy("o_custkey").orderBy("o_orderkey")
    i = t("orders").select(F.col("o_orderkey").alias("z"), (F.col("o_orderstatus") != F.lag("o_orderstatus").over(o)).alias("ch"), F.lag("o_orderkey").over(o).alias("b")).filter("b IS NOT NULL")
    asked = i.filter("ch OR z % 997 = 0")
    return asked.select(F.col("b").alias("z_before"), F.col("z").alias("z_after"), F.when(F.col("ch"), "change").otherwise("config").alias("reason")).distinct()


@query("SELECT l_suppkey, l_returnflag, count(*) AS n, round(sqrt(count(*)) * least(1, (quantile_cont(l_quantity, 0.9) - quantile_cont(l_quantity, 0.1)) / greatest(stddev_pop(l_quantity), 1e-6) / 10), 6) AS w FROM lineitem GROUP BY 1, 2")
def nu24_bin_weights(t):
    q = F.percentile("l_quantity", F.array(F.lit(0.1), F.lit(0.9)))
    g = t("lineitem").groupBy("l_suppkey", "l_returnflag").agg(F.count(F.lit(1)).alias("n"), q.alias("q"), F.stddev_pop("l_quantity").alias("sd"))
    return g.select("l_suppkey", "l_returnflag", "n", r(F.sqrt("n") * F.least(F.lit(1.0), (F.col("q")[1] - F.col("q")[0]) / F.greatest("sd", F.lit(1e-6)) / 10)).alias("w"))


@query("WITH m AS (SELECT l_linenumber AS k, avg(l_tax) AS tx, avg(l_discount) AS sx FROM lineitem GROUP BY 1) SELECT l_suppkey, l_linenumber, round(avg(l_quantity) - any_value(tx) * 100 + any_value(sx) * 10, 6) AS v FROM lineitem JOIN m ON k = l_linenumber GROUP BY 1, 2")
def nu25_shape_corrected(t):
    m = t("lineitem").groupBy("l_linenumber").agg(F.avg("l_tax").alias("tx"), F.avg("l_discount").alias("sx"))
    v = t("lineitem").groupBy("l_suppkey", "l_linenumber").agg(F.avg("l_quantity").alias("q")).join(F.broadcast(m), "l_linenumber")  # a row for each tile
    return v.select("l_suppkey", "l_linenumber", r(F.col("q") - F.col("tx") * 100 + F.col("sx") * 10).alias("v"))


@query("WITH p AS (SELECT s_suppkey AS k, s_nationkey AS z, s_acctbal AS v FROM supplier), o AS (SELECT *, row_number() OVER (PARTITION BY z ORDER BY v DESC, k) AS i FROM p) SELECT z, k AS owner FROM o WHERE i = 1")
def nu38_seam_owner(t):
    return w.first_of(t("supplier").select(F.col("s_suppkey").alias("k"), F.col("s_nationkey").alias("z"), F.col("s_acctbal").alias("v")), ["z"], [F.desc("v"), "k"]).select("z", F.col("k").alias("owner"))


@query("WITH f AS (SELECT s_suppkey AS z, CASE WHEN s_suppkey < 50 THEN (50 - s_suppkey) / 50.0::DOUBLE ELSE 0 END AS w FROM supplier) SELECT z, round(3 * w * w - 2 * w * w * w, 6) AS w, round((3 * w * w - 2 * w * w * w) * s_acctbal, 4) AS dx FROM f JOIN supplier ON z = s_suppkey")
def nu20_field_weights(t):
    u = F.when(F.col("s_suppkey") < 50, (50 - F.col("s_suppkey")) / 50.0).otherwise(0.0)
    return t("supplier").select(F.col("s_suppkey").alias("z"), r(s.ease(u)).alias("w"), r(s.ease(u) * F.col("s_acctbal"), 4).alias("dx"))




@query(f"WITH s AS (SELECT z, tile, p50 AS m, p95 - p5 AS c FROM ({_STATS})), a AS (SELECT *, median(255 * c / 90000.0) OVER o AS W FROM s WINDOW o AS (PARTITION BY tile ORDER BY z RANGE BETWEEN 6 PRECEDING AND 6 FOLLOWING)), b AS (SELECT *, median(m - 140.0 * W / 255) OVER o AS L FROM a WINDOW o AS (PARTITION BY tile ORDER BY z RANGE BETWEEN 6 PRECEDING AND 6 FOLLOWING)) SELECT z, tile, round(W + 1e-8, 5) AS w, round(L + 1e-8, 5) AS lo FROM b")
def nu29_reference_windows(t):
    d = stats(t).select("z", "tile", F.col("p50").alias("m"), (F.col("p95") - F.col("p5")).alias("c"))
    return lv.reference_windows(d, "z", "m", "c", 140.0, 90000.0, 6, ["tile"]).select("z", "tile", r(F.col("W") + 1e-8, 5).alias("w"), r(F.col("L") + 1e-8, 5).alias("lo"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, s_acctbal AS tx, s_suppkey / 2.0::DOUBLE AS ty FROM lineitem JOIN supplier ON l_suppkey = s_suppkey")
def src9_transform_lookup(t):
    k = t("supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_acctbal").alias("tx"), (F.col("s_suppkey") / 2.0).alias("ty"))
    return t("lineitem").join(k, "l_suppkey").select("l_orderkey", "l_linenumber", "l_partkey", "tx", "ty")


@query("WITH m AS (SELECT l_suppkey AS z, l_linenumber AS tile, CAST(max(l_partkey) % 3 AS BIGINT) AS code FROM lineitem WHERE l_tax > 0.04 GROUP BY 1, 2) SELECT s_suppkey AS z, p_partkey % 7 + 1 AS tile, p_partkey, coalesce(code, 0) AS code FROM part JOIN supplier ON p_partkey % 100 = s_suppkey LEFT JOIN m ON m.z = s_suppkey AND m.tile = p_partkey % 7 + 1")
def src14_mask_lookup(t):
    m = t("lineitem").filter("l_tax > 0.04").groupBy(F.col("l_suppkey").alias("z"), F.col("l_linenumber").cast("long").alias("tile")).agg((F.max("l_partkey") % 3).alias("code"))
    p = t("part").join(t("supplier"), F.col("p_partkey") % 100 == F.col("s_suppkey")).select(F.col("s_suppkey").alias("z"), (F.col("p_partkey") % 7 + 1).alias("tile"), "p_partkey")
    return p.join(m, ["z", "tile"], "left").select("z", "tile", "p_partkey", F.coalesce("code", F.lit(0)).alias("code"))


@query("SELECT o_orderkey || ',' || o_orderstatus || ',' || printf('%.3f', o_totalprice) || ',' || strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS line FROM orders")
def snk2_csv_rows(t):
    return t("orders").select(F.concat_ws(",", "o_orderkey", "o_orderstatus", F.format_string("%.3f", "o_totalprice"), F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss")).alias("line"))


@query("WITH o AS (SELECT o_orderkey AS k, o_custkey AS x, CAST(length(o_orderstatus) AS DOUBLE) AS y, o_orderpriority AS g FROM orders), n AS (SELECT k, x * 2 + k % 3 AS u, y + 5.0 AS v FROM o WHERE k % 7 <> 0) SELECT g, count(*) AS n, round(avg(u - x), 6) AS tx, round(avg(v - y), 6) AS ty FROM o JOIN n USING (k) GROUP BY 1")
def jn16_append_fit(t):
    o = t("orders").select(F.col("o_orderkey").alias("k"), F.col("o_custkey").alias("x"), F.length("o_orderstatus").cast("double").alias("y"), F.col("o_orderpriority").alias("g"))
    n = o.filter("k % 7 <> 0").select("k", (F.col("x") * 2 + F.col("k") % 3).alias("u"), (F.col("y") + 5.0).alias("v"))
    j_ = o.join(n, "k")
    return a.translation(j_, ["g"], "x", "y", "u", "v").join(j_.groupBy("g").agg(F.count(F.lit(1)).alias("n")), "g").select("g", "n", r("tx").alias("tx"), r("ty").alias("ty"))


@query("WITH b AS (SELECT p_partkey % 4 AS scale, p_partkey AS shard FROM part), r AS (SELECT string_split(url, '/') AS f FROM pages), d AS (SELECT CAST(page_id % 4 AS BIGINT) AS scale, page_id AS shard, max_by(length(url), page_id) AS n FROM pages GROUP BY 1, 2) SELECT b.scale, b.shard FROM b WHERE NOT EXISTS (SELECT 1 FROM d WHERE d.scale = b.scale AND d.shard = b.shard AND n % 2 = 0)")
def snk10_export_todo(t):
    done = t("pages").groupBy((F.col("page_id") % 4).alias("scale"), F.col("page_id").alias("shard")).agg(F.max_by(F.length("url"), "page_id").alias("n")).filter("n % 2 = 0")
    return t("part").select((F.col("p_partkey") % 4).alias("scale"), F.col("p_partkey").alias("shard")).join(done, ["scale", "shard"], "left_anti")


@query("WITH l AS (SELECT o_orderkey AS file, length(o_orderpriority) AS size, epoch_us(o_orderdate) AS mtime FROM orders), c AS (SELECT file, size, mtime + CASE WHEN file % 9 = 0 THEN 1 ELSE 0 END AS mtime FROM l WHERE file % 5 <> 0) SELECT l.file FROM l WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.file = l.file AND c.size = l.size AND c.mtime = l.mtime)")
def src6_headers_to_read(t):
    l = t("orders").select(F.col("o_orderkey").alias("file"), F.length("o_orderpriority").alias("size"), F.unix_micros(F.col("o_orderdate").cast("timestamp")).alias("mtime"))
    cache = l.filter("file % 5 <> 0").withColumn("mtime", F.col("mtime") + (F.col("file") % 9 == 0).cast("int"))
    return l.join(cache, ["file", "size", "mtime"], "left_anti").select("file")


@query("SELECT o_orderkey FROM orders LEFT JOIN customer ON o_custkey = c_custkey AND c_acctbal > 5000 WHERE c_acctbal IS NULL OR c_acctbal < 9000")
def mi19_layer_rows(t):
    c = t("customer").filter("c_acctbal > 5000").select(F.col("c_custkey").alias("o_custkey"), "c_acctbal")
    return t("orders").join(c, "o_custkey", "left").filter("c_acctbal IS NULL OR c_acctbal < 9000").select("o_orderkey")


@query("WITH e AS (SELECT label % 2 AS g, label AS pr, embedding[1]::DOUBLE AS x, embedding[2]::DOUBLE AS y, embedding[3]::DOUBLE AS u, embedding[4]::DOUBLE AS v FROM embeddings), c AS (SELECT g, x - avg(x) OVER w AS x, y - avg(y) OVER w AS y, u - avg(u) OVER w AS u, v - avg(v) OVER w AS v FROM e WINDOW w AS (PARTITION BY pr)), s AS (SELECT g, sum(x*x) AS xx, sum(x*y) AS xy, sum(y*y) AS yy, sum(x*u) AS xu, sum(y*u) AS yu, sum(x*v) AS xv, sum(y*v) AS yv FROM c GROUP BY 1) SELECT g, round((xu*yy - yu*xy) / (xx*yy - xy*xy), 6) AS a, round((yu*xx - xu*xy) / (xx*yy - xy*xy), 6) AS b, round((xv*yy - yv*xy) / (xx*yy - xy*xy), 6) AS c, round((yv*xx - xv*xy) / (xx*yy - xy*xy), 6) AS d FROM s")
def nu14_shared_linear(t):
    from ..operators.fits import shared_linear

    e = F.col("embedding")
    p = t("embeddings").select((F.col("label") % 2).alias("g"), F.col("label").alias("pr"), *[e[i].cast("double").alias(n) for i, n in enumerate("xyuv")])
    return shared_linear(p, ["pr"], ["g"]).select("g", *[r(n).alias(n) for n in "abcd"])
