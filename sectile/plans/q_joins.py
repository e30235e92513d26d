"""Joins, filters, sets and sorts on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import joins as j
from ..operators import windows as w
from .base import query, r


@query("SELECT o_orderkey, c_name, c_custkey IS NULL AS unmatched FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0) c ON o_custkey = c_custkey")
def jn1_left_checked(t):
    c = t("customer").filter("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey"), "c_name")
    return j.required_left(t("orders").select("o_orderkey", "o_custkey"), c, ["o_custkey"]).select("o_orderkey", "c_name", "unmatched")


@query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def jn2_many_to_one_violations(t):
    return j.duplicated_keys(t("lineitem"), ["l_orderkey", "l_linenumber"])


@query("SELECT c_custkey, n_name, r_name FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey")
def jn3_three_way(t):
    n = t("nation").withColumnRenamed("n_nationkey", "c_nationkey").withColumnRenamed("n_regionkey", "r_regionkey")
    return t("customer").join(n, "c_nationkey").join(t("region"), "r_regionkey").select("c_custkey", "n_name", "r_name")


@query("SELECT o_orderkey, l_suppkey, a.n_name AS customer_nation, b.n_name AS supplier_nation, l_linenumber, l_partkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey JOIN nation a ON c_nationkey = a.n_nationkey JOIN nation b ON s_nationkey = b.n_nationkey")
def jn4_double_role(t):
    n = t("nation")
    a = n.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("customer_nation"))
    b = n.select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("supplier_nation"))
    lines = t("lineitem").join(t("orders"), F.col("l_orderkey") == F.col("o_orderkey")).join(t("customer"), F.col("o_custkey") == F.col("c_custkey")).join(t("supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    return lines.join(a, "c_nationkey").join(b, "s_nationkey").select("o_orderkey", "l_suppkey", "customer_nation", "supplier_nation", "l_linenumber", "l_partkey")


@query("SELECT a.l_orderkey, CAST(count(*) AS BIGINT) AS n, round(sum(abs(a.l_extendedprice - b.l_extendedprice)), 2) AS d FROM lineitem a JOIN lineitem b ON a.l_orderkey = b.l_orderkey AND a.l_linenumber < b.l_linenumber GROUP BY 1")
def jn5_theta_pairs(t):
    p = j.pairs_within(t("lineitem"), ["l_orderkey"], ["l_linenumber"], ["l_extendedprice"])
    return p.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"), r(F.sum(F.abs(F.col("l_extendedprice_a") - F.col("l_extendedprice_b"))), 2).alias("d"))


_BOX = "SELECT s_suppkey AS k, s_nationkey AS g, s_acctbal AS x0, CAST(s_suppkey AS DOUBLE) AS y0, s_acctbal + 1500 AS x1, CAST(s_suppkey + 40 AS DOUBLE) AS y1 FROM supplier"


@query(f"WITH b AS ({_BOX}) SELECT a.k AS ka, b.k AS kb, round(greatest(a.x0, b.x0), 4) AS ox0, round(least(a.x1, b.x1), 4) AS ox1, greatest(a.y0, b.y0) AS oy0, least(a.y1, b.y1) AS oy1 FROM b a JOIN b ON a.g = b.g AND a.k < b.k WHERE least(a.x1, b.x1) - greatest(a.x0, b.x0) >= 10 AND least(a.y1, b.y1) - greatest(a.y0, b.y0) >= 10")
def jn6_box_overlap(t):
    k = F.col("s_suppkey")
    box = t("supplier").select(k.alias("k"), F.col("s_nationkey").alias("g"), F.col("s_acctbal").alias("x0"), k.cast("double").alias("y0"), (F.col("s_acctbal") + 1500).alias("x1"), (k + 40).cast("double").alias("y1"))
    a, b = (box.select("g", *[F.col(c).alias(f"{c}{s}") for c in ("k", "x0", "y0", "x1", "y1")]) for s in "ab")
    out = j.overlapping(a, b, ["g"], ("x0a", "y0a", "x1a", "y1a"), ("x0b", "y0b", "x1b", "y1b"), (1500.0, 40.0), 10).filter("ka < kb")
    return out.select("ka", "kb", r("ox0", 4).alias("ox0"), r("ox1", 4).alias("ox1"), "oy0", "oy1")


@query("WITH p AS (SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts) AS i FROM events) SELECT a.event_id, b.event_id AS event_id_b, CAST(b.i - a.i AS BIGINT) AS step FROM p a JOIN p b ON a.user_id = b.user_id AND b.i BETWEEN a.i + 1 AND a.i + 4")
def jn7_band(t):
    return j.band(t("events").select("event_id", "user_id", "ts"), 4, ["ts"], ["user_id"], ["event_id"]).select("event_id", "event_id_b", F.col("step").cast("long").alias("step"))


_SEG = "WITH i AS (SELECT user_id, event_id, ts, event_type AS tile, CAST(floor(value / 50) AS BIGINT) AS s FROM events), n AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts) AS i FROM i)"


@query(_SEG + " SELECT a.event_id AS a, b.event_id AS b FROM n a JOIN n b ON a.user_id = b.user_id AND b.i = a.i + 1 WHERE (a.s = b.s AND a.tile = b.tile) OR a.s <> b.s")
def jn8_conditional(t):
    e = t("events").select("user_id", "event_id", "ts", F.col("event_type").alias("tile"), F.floor(F.col("value") / 50).alias("s"))
    p = j.band(e, 1, ["ts"], ["user_id"], ["event_id", "tile", "s"])
    return p.filter("(s = s_b AND tile = tile_b) OR s <> s_b").select(F.col("event_id").alias("a"), F.col("event_id_b").alias("b"))


@query("""WITH a AS (SELECT * FROM embeddings WHERE label % 2 = 0), b AS (SELECT * FROM embeddings WHERE label % 2 = 1), d AS (SELECT a.vec_id AS a, b.vec_id AS b, sqrt(list_sum(list_transform(list_zip(a.embedding, b.embedding), lambda x: (x[1]::DOUBLE - x[2]::DOUBLE) * (x[1]::DOUBLE - x[2]::DOUBLE)))) AS d FROM a, b),
k AS (SELECT *, row_number() OVER (PARTITION BY a ORDER BY d, b) AS k FROM d) SELECT x.a, x.b, round(x.d, 6) AS d1 FROM k x JOIN k y ON x.a = y.a AND x.k = 1 AND y.k = 2 WHERE x.d < 0.9 * y.d""")
def jn9_knn_ratio(t):
    e = t("embeddings")
    return j.nearest_two(e.filter("label % 2 = 0"), e.filter("label % 2 = 1"), "vec_id", "embedding", 0.9).select("a", "b", r("d1").alias("d1"))


_DAY = "date_diff('day', DATE '1990-01-01', CAST(o_orderdate AS DATE))"
_LERP = f"""WITH d AS (SELECT o_orderpriority AS p, {_DAY} AS x, round(sum(o_totalprice), 2) AS v FROM orders GROUP BY 1, 2), s AS (SELECT * FROM d WHERE x % 10 = 0),
b AS (SELECT d.p, d.x, (SELECT max(s.x) FROM s WHERE s.p = d.p AND s.x <= d.x) AS x0, (SELECT min(s.x) FROM s WHERE s.p = d.p AND s.x >= d.x) AS x1 FROM d), v AS (SELECT b.*, s0.v AS v0, s1.v AS v1 FROM b LEFT JOIN s s0 ON s0.p = b.p AND s0.x = b.x0 LEFT JOIN s s1 ON s1.p = b.p AND s1.x = b.x1)"""


def _sampled(t):
    d = t("orders").groupBy(F.col("o_orderpriority").alias("p"), F.datediff("o_orderdate", F.lit("1990-01-01").cast("date")).cast("long").alias("x")).agg(r(F.sum("o_totalprice"), 2).alias("v"))
    return d, d.filter("x % 10 = 0")


@query(_LERP + " SELECT p, x, x0 AS x_before, v0 AS v_before, x1 AS x_after, v1 AS v_after FROM v")
def jn10_bracket(t):
    return j.bracketed(*_sampled(t), "x", "v", ["p"])


@query(_LERP + " SELECT p, x, round(CASE WHEN x0 IS NULL THEN v1 WHEN x1 IS NULL OR x0 = x1 THEN v0 ELSE v0 + (v1 - v0) * (x - x0) / (x1 - x0) END + 1e-7, 5) AS v FROM v")
def jn11_lerp(t):
    return j.interpolated(*_sampled(t), "x", "v", ["p"]).select("p", "x", r(F.col("v") + 1e-7, 5).alias("v"))


@query("WITH p AS (SELECT l_suppkey AS k, l_orderkey AS id, l_linenumber AS ln, l_partkey AS lo, l_partkey + 40 AS hi FROM lineitem), c AS (SELECT DISTINCT l_suppkey AS k, l_partkey AS cut FROM lineitem WHERE l_quantity = 50) SELECT DISTINCT k, id, ln, lo FROM p WHERE EXISTS (SELECT 1 FROM c WHERE c.k = p.k AND lo < cut AND hi >= cut)")
def jn12_crossing(t):
    l = t("lineitem")
    p = l.select(F.col("l_suppkey").alias("k"), F.col("l_orderkey").alias("id"), F.col("l_linenumber").alias("ln"), F.col("l_partkey").alias("lo"), (F.col("l_partkey") + 40).alias("hi"))
    return j.crossing(p, "lo", "hi", l.filter("l_quantity = 50").select(F.col("l_suppkey").alias("k"), F.col("l_partkey").alias("cut")), "cut", ["k"]).select("k", "id", "ln", "lo").distinct()


@query("SELECT o_orderkey, l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM orders JOIN lineitem ON o_orderdate = l_shipdate AND o_custkey = l_partkey")
def jn13_timestamp_equality(t):
    o = t("orders").select("o_orderkey", F.col("o_orderdate").alias("ts"), F.col("o_custkey").alias("k"))
    return o.join(t("lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", F.col("l_shipdate").alias("ts"), F.col("l_partkey").alias("k")), ["ts", "k"]).select("o_orderkey", "l_orderkey", "l_linenumber", F.col("k").alias("l_partkey"), "l_extendedprice")


@query("SELECT c_custkey, 'buys' AS what FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 400000) UNION ALL SELECT c_custkey, 'never' FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)")
def jn14_semi_anti(t):
    c, o = t("customer").select("c_custkey"), t("orders").withColumnRenamed("o_custkey", "c_custkey")
    return c.join(o.filter("o_totalprice > 400000"), "c_custkey", "left_semi").withColumn("what", F.lit("buys")).unionByName(c.join(o, "c_custkey", "left_anti").withColumn("what", F.lit("never")))


@query("WITH a AS (SELECT l_suppkey AS k, sum(l_quantity) AS q FROM lineitem WHERE l_returnflag = 'A' GROUP BY 1), b AS (SELECT l_suppkey AS k, sum(l_quantity) AS q FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1) SELECT k, a.q AS q_a, b.q AS q_b, round(b.q / a.q, 6) AS q_ratio FROM a JOIN b USING (k)")
def jn15_two_runs(t):
    def run(flag):
        return t("lineitem").filter(F.col("l_returnflag") == flag).groupBy(F.col("l_suppkey").alias("k")).agg(F.sum("l_quantity").alias("q"))

    return j.compared(run("A"), run("R"), ["k"], ["q"]).withColumn("q_ratio", r("q_ratio"))


@query("SELECT CAST(least(greatest(floor((l_quantity + 0.5) / 51 * 8), 0), 7) AS BIGINT) AS pa, CAST(least(greatest(floor((l_discount * 100 + 0.5) / 11 * 4), 0), 3) AS BIGINT) AS pb, count(*) AS n, round(avg(l_extendedprice), 4) AS mean FROM lineitem GROUP BY ALL")
def jn17_patch_bins(t):
    patch = F.expr("CAST(least(greatest(floor((l_quantity + 0.5) / 51 * 8), 0), 7) AS BIGINT)"), F.expr("CAST(least(greatest(floor((l_discount * 100 + 0.5) / 11 * 4), 0), 3) AS BIGINT)")
    return t("lineitem").groupBy(patch[0].alias("pa"), patch[1].alias("pb")).agg(F.count(F.lit(1)).alias("n"), r(F.avg("l_extendedprice"), 4).alias("mean"))


_FRAMES = "SELECT l_orderkey * 10 + l_linenumber AS frame, l_quantity AS q, l_discount AS d, CASE WHEN l_tax > 0 THEN l_tax END AS x FROM lineitem"


@query("WITH f AS (SELECT l_orderkey * 10 + l_linenumber AS frame, l_quantity AS q, l_discount AS d, CASE WHEN l_tax > 0 THEN l_tax END AS x, l_linestatus AS s FROM lineitem), o AS (SELECT q, d, x, min(frame) AS old_frame FROM f WHERE s IS DISTINCT FROM 'O' GROUP BY ALL) SELECT f.frame, min(old_frame) AS old_frame FROM f JOIN o ON f.q IS NOT DISTINCT FROM o.q AND f.d IS NOT DISTINCT FROM o.d AND f.x IS NOT DISTINCT FROM o.x WHERE f.s = 'O' GROUP BY 1")
def jn18_reusable_rows(t):
    """Open rows are the new ones, all others the old ones."""
    f = t("lineitem").select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("frame"), F.col("l_quantity").alias("q"), F.col("l_discount").alias("d"), F.expr("CASE WHEN l_tax > 0 THEN l_tax END").alias("x"), F.col("l_linestatus").eqNullSafe("O").alias("new"))
    return j.same_rows(f.filter("new"), f.filter("NOT new"), ["q", "d", "x"], "frame")


@query()
def nu7_components(t):
    """Over all edges; suppliers are even nodes and parts odd ones. No SQL: a walk by recursion doesn't bear all edges."""
    e = t("lineitem").filter("l_suppkey IS NOT NULL AND l_partkey IS NOT NULL").select((F.col("l_suppkey") * 2).alias("a"), (F.col("l_partkey") * 2 + 1).alias("b"))
    nodes = e.select(F.col("a").alias("node")).unionByName(e.select(F.col("b").alias("node")))
    return j.components(e, nodes, "a", "b", "node")


_LISTING = "SELECT o_orderkey AS k, length(o_orderpriority) AS size, md5(o_orderpriority || o_orderstatus) AS md5 FROM orders"


@query(f"WITH a AS ({_LISTING} WHERE o_orderkey % 5 <> 0), b AS (SELECT k, size + CASE WHEN k % 7 = 0 THEN 1 ELSE 0 END AS size, CASE WHEN k % 11 = 0 THEN 'x' ELSE md5 END AS md5 FROM ({_LISTING}) WHERE k % 3 <> 0) SELECT coalesce(a.k, b.k) AS k, CASE WHEN b.k IS NULL THEN 'missing' WHEN a.k IS NULL THEN 'extra' WHEN a.size <> b.size THEN 'size' ELSE 'md5' END AS problem FROM a FULL JOIN b ON a.k = b.k WHERE a.k IS NULL OR b.k IS NULL OR a.size <> b.size OR a.md5 <> b.md5")
def snk12_transfer_diff(t):
    l = t("orders").select(F.col("o_orderkey").alias("k"), F.length("o_orderpriority").alias("size"), F.md5(F.concat("o_orderpriority", "o_orderstatus")).alias("md5"))
    b = l.filter("k % 3 <> 0").withColumn("size", F.col("size") + (F.col("k") % 7 == 0).cast("int")).withColumn("md5", F.when(F.col("k") % 11 == 0, F.lit("x")).otherwise(F.col("md5")))
    return j.differences(l.filter("k % 5 <> 0"), b, "k", ["size", "md5"])


@query("SELECT k, CASE WHEN b IS NULL THEN 'missing' WHEN a IS NULL THEN 'extra' ELSE 'md5' END AS problem FROM (SELECT coalesce(x.c, y.c) AS k, x.h AS a, y.h AS b FROM (SELECT c_custkey AS c, md5(c_name) AS h FROM customer WHERE c_custkey < 1400) x FULL JOIN (SELECT c_custkey AS c, md5(CASE WHEN c_nationkey = 3 THEN 'bad' ELSE c_name END) AS h FROM customer WHERE c_custkey > 30) y ON x.c = y.c) WHERE a IS DISTINCT FROM b")
def snk16_copy_verify(t):
    c = t("customer")
    a = c.filter("c_custkey < 1400").select(F.col("c_custkey").alias("k"), F.md5("c_name").alias("md5"))
    b = c.filter("c_custkey > 30").select(F.col("c_custkey").alias("k"), F.md5(F.when(F.col("c_nationkey") == 3, "bad").otherwise(F.col("c_name"))).alias("md5"))
    return j.differences(a, b, "k", ["md5"])


# -- filters --------------------------------------------------------------------------------------------------------


@query("SELECT event_id FROM events WHERE ts >= (TIMESTAMPTZ '2024-01-02 00:00:00 America/New_York') AT TIME ZONE 'UTC' AND ts <= (TIMESTAMPTZ '2024-01-05 12:00:00 America/New_York') AT TIME ZONE 'UTC' AND event_id BETWEEN 100 AND 9000")
def flt1_selection(t):
    def utc(x):
        return F.to_utc_timestamp(F.lit(x).cast("timestamp_ntz"), "America/New_York").cast("timestamp_ntz")

    return t("events").filter((F.col("ts") >= utc("2024-01-02 00:00:00")) & (F.col("ts") <= utc("2024-01-05 12:00:00")) & F.col("event_id").between(100, 9000)).select("event_id")


@query("SELECT event_id FROM events WHERE NOT (event_type = 'error' OR value < 1)")
def flt2_not_excluded(t):
    return t("events").withColumn("excluded", (F.col("event_type") == "error") | (F.col("value") < 1)).filter("NOT excluded").select("event_id")


@query("SELECT event_id, ts IS NULL OR ts > TIMESTAMP '2024-01-20 00:00:00' - INTERVAL 2 HOUR AS pending FROM events")
def flt3_pending(t):
    cut = F.lit("2024-01-20 00:00:00").cast("timestamp_ntz") - F.expr("INTERVAL 2 HOURS")
    return t("events").select("event_id", (F.col("ts").isNull() | (F.col("ts") > cut)).alias("pending"))


@query("SELECT event_id, max(CASE WHEN value > 200 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id, event_type) = 1 AS waits FROM events")
def flt4_group_waits(t):
    from pyspark.sql import Window as W

    return t("events").select("event_id", (F.max((F.col("value") > 200).cast("int")).over(W.partitionBy("user_id", "event_type")) == 1).alias("waits"))


@query("WITH k AS (SELECT url AS path FROM pages WHERE page_id % 10 = 0 UNION SELECT regexp_extract(url, '[^/]*$') FROM pages WHERE page_id % 15 = 0) SELECT page_id FROM pages WHERE url IN (SELECT path FROM k) OR regexp_extract(url, '[^/]*$') IN (SELECT path FROM k)")
def flt5_path_or_name(t):
    p = t("pages").withColumn("name", F.regexp_extract("url", "[^/]*$", 0))
    known = p.filter("page_id % 10 = 0").select(F.col("url").alias("path")).union(p.filter("page_id % 15 = 0").select("name")).distinct()
    # two equi joins in place of one disjunctive join
    return p.join(known.withColumnRenamed("path", "url"), "url", "left_semi").select("page_id").union(p.join(known.withColumnRenamed("path", "name"), "name", "left_semi").select("page_id")).distinct()


_ASKED = "SELECT CAST(DATE '1996-01-01' + CAST(i * 9 AS INTEGER) AS TIMESTAMP) AS ts FROM range(400) x(i)"


@query(f"WITH a AS ({_ASKED}), o AS (SELECT DISTINCT o_orderdate AS ts FROM orders) SELECT epoch_us(a.ts) AS us, o.ts IS NOT NULL AS found FROM a LEFT JOIN o USING (ts)")
def flt6_exclusions_found(t):
    spark = t("orders").sparkSession
    asked = spark.range(400).select(F.date_add(F.lit("1996-01-01").cast("date"), (F.col("id") * 9).cast("int")).cast("timestamp_ntz").alias("ts"))
    got = j.required_left(asked, t("orders").select(F.col("o_orderdate").alias("ts")).distinct(), ["ts"])
    return got.select(F.unix_micros(F.col("ts").cast("timestamp")).alias("us"), (~F.col("unmatched")).alias("found"))


@query("SELECT o_orderkey FROM orders, (SELECT 100000.0 AS x0, NULL AS x1, NULL AS y0, DATE '1998-01-01' AS y1) b WHERE coalesce(o_totalprice >= x0, true) AND coalesce(o_totalprice < x1, true) AND coalesce(o_orderdate >= y0, true) AND coalesce(o_orderdate < y1, true)")
def flt10_open_region(t):
    sides = [F.col("o_totalprice") >= 100000.0, F.col("o_totalprice") < F.lit(None), F.col("o_orderdate") >= F.lit(None), F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz")]
    inside = F.lit(True)
    for s in sides:
        inside = inside & F.coalesce(s, F.lit(True))
    return t("orders").filter(inside).select("o_orderkey")


@query("WITH e AS (SELECT o_orderkey AS k, md5(o_orderstatus || o_orderpriority) AS s FROM orders), h AS (SELECT k, CASE WHEN k % 9 = 0 THEN 'old' ELSE s END AS s FROM e WHERE k % 4 <> 0) SELECT e.k, h.k IS NULL AS missing FROM e LEFT JOIN h ON e.k = h.k WHERE h.s IS DISTINCT FROM e.s")
def flt14_stale(t):
    e = t("orders").select(F.col("o_orderkey").alias("k"), F.md5(F.concat("o_orderstatus", "o_orderpriority")).alias("s"))
    have = e.filter("k % 4 <> 0").select("k", F.when(F.col("k") % 9 == 0, "old").otherwise(F.col("s")).alias("h"))
    return e.join(have, "k", "left").filter(~F.col("s").eqNullSafe(F.col("h"))).select("k", F.col("h").isNull().alias("missing"))


# -- sets and sorts -------------------------------------------------------------------------------------------------


@query("SELECT l_returnflag AS f, l_orderkey AS k FROM lineitem WHERE l_quantity < 3 UNION ALL SELECT o_orderstatus, o_orderkey FROM orders WHERE o_totalprice < 20000")
def st1_union_all(t):
    return t("lineitem").filter("l_quantity < 3").select(F.col("l_returnflag").alias("f"), F.col("l_orderkey").alias("k")).unionByName(t("orders").filter("o_totalprice < 20000").select(F.col("o_orderstatus").alias("f"), F.col("o_orderkey").alias("k")))


@query("(SELECT 'missing' AS side, o_orderkey AS k FROM orders EXCEPT SELECT 'missing', l_orderkey FROM lineitem) UNION ALL (SELECT 'extra', l_orderkey FROM lineitem EXCEPT SELECT 'extra', o_orderkey FROM orders WHERE o_orderstatus = 'F')")
def st2_except(t):
    o, l = t("orders"), t("lineitem").select(F.col("l_orderkey").alias("k"))
    a = o.select(F.col("o_orderkey").alias("k")).subtract(l).withColumn("side", F.lit("missing"))
    return a.unionByName(l.subtract(o.filter("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("k"))).withColumn("side", F.lit("extra")))


@query("WITH n AS (SELECT unnest([1, 2, 3]) AS ln), k AS (SELECT DISTINCT l_orderkey FROM lineitem), m AS (SELECT l_orderkey, count(*) FILTER (WHERE NOT EXISTS (SELECT 1 FROM lineitem x WHERE x.l_orderkey = k.l_orderkey AND x.l_linenumber = ln)) AS miss FROM k, n GROUP BY 1) SELECT l_orderkey, miss = 0 AS complete FROM m")
def st3_subset(t):
    return t("lineitem").groupBy("l_orderkey").agg((F.size(F.array_except(F.array(F.lit(1), F.lit(2), F.lit(3)), F.collect_set("l_linenumber"))) == 0).alias("complete"))


@query("SELECT l_partkey AS k FROM lineitem WHERE l_quantity > 48 UNION SELECT p_partkey FROM part WHERE p_size > 45")
def st4_union_distinct(t):
    return t("lineitem").filter("l_quantity > 48").select(F.col("l_partkey").alias("k")).union(t("part").filter("p_size > 45").select("p_partkey")).distinct()


@query("SELECT l_partkey AS k FROM lineitem WHERE l_quantity > 45 INTERSECT SELECT p_partkey FROM part WHERE p_size > 25")
def st5_intersect(t):
    return t("lineitem").filter("l_quantity > 45").select(F.col("l_partkey").alias("k")).intersect(t("part").filter("p_size > 25").select(F.col("p_partkey").alias("k")))


@query("SELECT l_orderkey, count(DISTINCT l_linenumber) = max(l_linenumber) AND count(DISTINCT l_linestatus) = 1 AS complete FROM lineitem GROUP BY 1")
def st6_all_parts_of_one_run(t):
    return t("lineitem").groupBy("l_orderkey").agg(((F.countDistinct("l_linenumber") == F.max("l_linenumber")) & (F.countDistinct("l_linestatus") == 1)).alias("complete"))


@query("""WITH i AS (SELECT user_id, epoch_us(ts) AS lo, epoch_us(ts) + CAST(round(value * 1e8) AS BIGINT) AS hi FROM events), m AS (SELECT *, max(hi) OVER (PARTITION BY user_id ORDER BY lo ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM i),
g AS (SELECT *, sum(CASE WHEN before IS NULL OR lo > before + 1 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY lo ROWS UNBOUNDED PRECEDING) AS g FROM m) SELECT user_id, min(lo) AS lo, max(hi) AS hi, count(*) AS n FROM g GROUP BY user_id, g.g""")
def st7_interval_merge(t):
    from pyspark.sql import Window as W

    i = t("events").select("user_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("lo"), F.expr("CAST(round(value * 1e8) AS BIGINT)").alias("w")).withColumn("hi", F.col("lo") + F.col("w"))
    o = W.partitionBy("user_id").orderBy("lo")
    m = i.withColumn("before", F.max("hi").over(o.rowsBetween(W.unboundedPreceding, -1)))
    m = w.blocks(m, F.col("before").isNull() | (F.col("lo") > F.col("before") + 1), "lo", ["user_id"], "g")
    return m.groupBy("user_id", "g").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.count(F.lit(1)).alias("n")).drop("g")


_RANK = "CASE o_orderpriority WHEN '1-URGENT' THEN 0 WHEN '2-HIGH' THEN 1 ELSE 2 END"


@query(f"SELECT o_orderkey, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY {_RANK}, CASE WHEN o_totalprice > 100000 THEN o_orderdate END NULLS LAST, o_orderkey) AS BIGINT) AS n FROM orders")
def so1_severity_order(t):
    from pyspark.sql import Window as W

    o = W.partitionBy("o_custkey").orderBy(F.expr(_RANK), F.expr("CASE WHEN o_totalprice > 100000 THEN o_orderdate END").asc_nulls_last(), "o_orderkey")
    return t("orders").select("o_orderkey", F.row_number().over(o).cast("long").alias("n"))


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 200")
def so2_top_n(t):
    return t("orders").select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(200)


@query("WITH c AS (SELECT l_suppkey, l_linenumber, count(*) AS n, min(l_orderkey * 100 + l_linenumber) AS seen FROM lineitem GROUP BY 1, 2) SELECT l_suppkey, l_linenumber AS mode FROM (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY n DESC, seen, l_linenumber) AS k FROM c) WHERE k = 1")
def so3_modal_first_seen(t):
    c = t("lineitem").groupBy("l_suppkey", "l_linenumber").agg(F.count(F.lit(1)).alias("n"), F.min(F.col("l_orderkey") * 100 + F.col("l_linenumber")).alias("seen"))
    return w.first_of(c, ["l_suppkey"], [F.desc("n"), "seen", "l_linenumber"]).select("l_suppkey", F.col("l_linenumber").alias("mode"))


@query("SELECT l_suppkey, l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey) AS k FROM lineitem) WHERE k <= 5")
def so4_strongest_k(t):
    from pyspark.sql import Window as W

    o = W.partitionBy("l_suppkey").orderBy(F.desc("l_extendedprice"), "l_orderkey", "l_linenumber", "l_partkey")
    return t("lineitem").withColumn("k", F.row_number().over(o)).filter("k <= 5").select("l_suppkey", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")


@query("WITH b AS (SELECT l_suppkey AS z, CAST(floor(l_quantity / 10) AS BIGINT) AS blk, avg(CASE WHEN l_discount = 0 THEN 1.0 ELSE 0.0 END) AS f FROM lineitem GROUP BY 1, 2), w AS (SELECT *, row_number() OVER (PARTITION BY z ORDER BY f DESC, blk) AS k FROM b) SELECT z, blk, round(f, 6) AS f FROM w WHERE k = 1 ORDER BY w.f DESC, z LIMIT 20")
def so5_worst_blocks(t):
    b = t("lineitem").groupBy(F.col("l_suppkey").alias("z"), F.floor(F.col("l_quantity") / 10).alias("blk")).agg(F.avg((F.col("l_discount") == 0).cast("double")).alias("f"))
    return w.first_of(b, ["z"], [F.desc("f"), "blk"]).orderBy(F.desc("f"), "z").limit(20).select("z", "blk", r("f").alias("f"))


_TILE = "CAST(l_suppkey % 12 AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR)"


@query(f"WITH d AS (SELECT DISTINCT {_TILE} AS tile, l_returnflag AS f FROM lineitem) SELECT f, tile, CAST(row_number() OVER (PARTITION BY f ORDER BY list_transform(string_split(tile, '-'), lambda x: CAST(x AS INTEGER))) AS BIGINT) AS n FROM d")
def so8_tile_order(t):
    from pyspark.sql import Window as W

    from ..functions.scalars import tile_key

    d = t("lineitem").select(F.concat_ws("-", F.col("l_suppkey") % 12, "l_linenumber").alias("tile"), F.col("l_returnflag").alias("f")).distinct()
    return d.select("f", "tile", F.row_number().over(W.partitionBy("f").orderBy(tile_key("tile"))).cast("long").alias("n"))


@query("SELECT s_suppkey, s_nationkey, CAST(row_number() OVER (PARTITION BY s_nationkey ORDER BY abs(s_acctbal - 4000) DESC, s_suppkey) AS BIGINT) AS n FROM supplier")
def so9_back_to_front(t):
    from pyspark.sql import Window as W

    return t("supplier").select("s_suppkey", "s_nationkey", F.row_number().over(W.partitionBy("s_nationkey").orderBy(F.desc(F.abs(F.col("s_acctbal") - 4000)), "s_suppkey")).cast("long").alias("n"))
