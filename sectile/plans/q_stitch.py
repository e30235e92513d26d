"""Stitching, refinement and plan checks on the driver tables."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import motion
from ..functions import scalars as s
from ..operators import pixels as p
from ..operators import stitching as st
from .base import query, r
from .q_scalars import _IMG, image


def _matches(t):
    """Line items as matches: the tiles are line numbers of an order; positions differ by a shift of the tile and noise."""
    l = t("lineitem").select((F.col("l_suppkey") % 20).alias("z"), "l_orderkey", F.col("l_linenumber").alias("k"), F.col("l_quantity").alias("x"), (F.col("l_discount") * 100).alias("y"), (F.col("l_tax") * 10).alias("e"))
    other = l.select("l_orderkey", (F.col("k") - 1).alias("k"), F.col("e").alias("f"))
    at = F.col("k").cast("double")
    return l.join(other, ["l_orderkey", "k"]).select("z", F.col("k").cast("string").alias("a"), (F.col("k") + 1).cast("string").alias("b"), (F.col("x") + 30).alias("xa"), F.col("y").alias("ya"), (F.col("x") + at + F.col("e") - F.col("f")).alias("xb"), (F.col("y") + F.col("f")).alias("yb"))


@query()
def nu8_models(t):
    """All five models of a tile on the same matches."""
    return st.solved_models(_matches(t), ["z"], list(st.BASES), 5.0)


@query()
def nu9_filtered(t):
    return st.solved_tiles(_matches(t), ["z"], "affine_rigid", 2.0)


def loop_matches(t):
    """Matches of five line numbers, each with the next and the one after it, under the shifts of the slice; in every third
    slice the pair (2, 3) is 40 px off."""
    l = t("lineitem").select((F.col("l_suppkey") % 20).alias("z"), ((F.col("l_linenumber") - 1) % 5 + 1).alias("k"), (F.col("l_partkey") % 300).cast("double").alias("x"), F.col("l_quantity").alias("y"), (F.col("l_tax") - 0.04).alias("e"))
    m = l.withColumn("to", F.explode(F.array(F.col("k") + 1, F.col("k") + 2))).filter("to <= 5")
    off = F.when((F.col("z") % 3 == 0) & (F.col("k") == 2) & (F.col("to") == 3), 40.0).otherwise(0.0)

    def shift(k):
        return F.col(k) * 100 + (F.col("z") * F.col(k)) % 7, (F.col("z") + F.col(k)) % 5

    (ax, ay), (bx, by) = shift("k"), shift("to")
    return m.select("z", F.col("k").cast("string").alias("a"), F.col("to").cast("string").alias("b"), (F.col("x") - ax).alias("xa"), (F.col("y") - ay).alias("ya"), (F.col("x") - bx + F.col("e") + off).alias("xb"), (F.col("y") - by).alias("yb"))


@query()
def nu10_loops(t):
    """Loops through five tiles of a slice; where one pair is wrong, it is found and left out."""
    return st.solved_tiles(loop_matches(t), ["z"], "translation", 3.0, loops=True)


_RANKED = "SELECT o_orderpriority AS g, x, v, row_number() OVER (PARTITION BY o_orderpriority ORDER BY x) - 1 AS i FROM (SELECT o_orderpriority, date_diff('day', DATE '1990-01-01', CAST(o_orderdate AS DATE)) AS x, max(o_totalprice) AS v FROM orders GROUP BY 1, 2)"


@query(f"""WITH RECURSIVE p AS ({_RANKED}), s AS (SELECT g, i FROM p WHERE i % 64 = 0), w AS (SELECT g, i AS lo, lead(i) OVER (PARTITION BY g ORDER BY i) AS hi FROM s UNION ALL
SELECT w.g, CASE WHEN side = 0 THEN lo ELSE (lo + hi) // 2 END, CASE WHEN side = 0 THEN (lo + hi) // 2 ELSE hi END FROM w JOIN p a ON a.g = w.g AND a.i = w.lo JOIN p b ON b.g = w.g AND b.i = w.hi, (VALUES (0), (1)) y(side) WHERE hi - lo >= 2 AND abs(a.v - b.v) > 20000)
SELECT DISTINCT p.g, CAST(p.i AS BIGINT) AS i, p.v FROM w JOIN p ON p.g = w.g AND p.i = w.lo""")
def nu11_bisected(t):
    """Days measured at every 64th position, and between neighbours that differ by more than 20,000."""
    d = t("orders").groupBy(F.col("o_orderpriority").alias("g"), F.datediff("o_orderdate", F.lit("1990-01-01").cast("date")).alias("x")).agg(F.max("o_totalprice").alias("v"))
    p_ = d.withColumn("i", (F.row_number().over(W.partitionBy("g").orderBy("x")) - 1).cast("long"))
    values = p_.select("g", "i", "v")
    return st.bisected(p_.select("g", "i"), F.col("i") % 64 == 0, lambda at: at.join(values, ["g", "i"]), lambda a, b: F.abs(F.col(a) - F.col(b)), ["g"], "i", "v", 20000.0)


@query("WITH a AS (SELECT l_suppkey AS z, f AS level, CAST(count(*) FILTER (WHERE l_quantity * f <= 50) AS BIGINT) AS n FROM lineitem, (VALUES (8), (4), (2), (1)) y(f) GROUP BY 1, 2), o AS (SELECT *, n >= 20 AS ok, row_number() OVER (PARTITION BY z ORDER BY CASE WHEN n >= 20 OR level = 1 THEN 0 ELSE 1 END, level DESC) AS i FROM a) SELECT z, level, n, ok FROM o WHERE i = 1")
def nu12_retried(t):
    """Suppliers with enough line items at the coarsest level at which they have them."""
    l = t("lineitem").select(F.col("l_suppkey").alias("z"), "l_quantity")

    def attempt(keys, level):
        n = l.join(keys, "z", "left_semi").groupBy("z").agg(F.count(F.when(F.col("l_quantity") * level <= 50, 1)).alias("n"))
        return n.withColumn("ok", F.col("n") >= 20)

    return st.retried(l.select("z").distinct(), [8, 4, 2, 1], attempt, ["z"]).select("z", "level", "n", "ok")


_PLANS = """n AS (SELECT o_orderkey AS k, o_orderpriority AS g, 100.0::DOUBLE AS w, 80.0::DOUBLE AS h, 1 + (o_custkey % 7) / 1000.0::DOUBLE AS a, (o_custkey % 5) / 1000.0::DOUBLE AS b, o_custkey * 1.0::DOUBLE AS tx, 0.0::DOUBLE AS c, 1.0::DOUBLE AS d, (o_orderkey % 211) * 1.0::DOUBLE AS ty FROM orders),
o AS (SELECT k, CASE WHEN left(g, 1) <= '2' THEN a ELSE a * 1.001 END AS a, b, CASE WHEN left(g, 1) <= '2' THEN tx + 5 ELSE tx * 1.001 + 5 END AS tx, c, d, ty - 3 + k % 3 AS ty FROM n WHERE k % 7 <> 0),
q AS (SELECT g, n.a * x + n.b * y + n.tx AS x, n.c * x + n.d * y + n.ty AS y, o.a * x + o.b * y + o.tx AS u, o.c * x + o.d * y + o.ty AS v FROM n JOIN o USING (k), (VALUES (0.0::DOUBLE, 0.0::DOUBLE), (0, 80), (100, 0), (100, 80)) e(x, y)),
m AS (SELECT g, avg(x) AS mx, avg(y) AS my, avg(u) AS mu, avg(v) AS mv, median(u - x) AS sx, median(v - y) AS sy, count(*) AS corners FROM q GROUP BY 1),
f AS (SELECT g, sum((x - mx) * (x - mx)) AS xx, sum((x - mx) * (y - my)) AS xy, sum((y - my) * (y - my)) AS yy, sum((x - mx) * (u - mu)) AS xu, sum((y - my) * (u - mu)) AS yu, sum((x - mx) * (v - mv)) AS xv, sum((y - my) * (v - mv)) AS yv FROM q JOIN m USING (g) GROUP BY 1),
l AS (SELECT m.*, (xu * yy - yu * xy) / (xx * yy - xy * xy) AS a, (yu * xx - xu * xy) / (xx * yy - xy * xy) AS b, (xv * yy - yv * xy) / (xx * yy - xy * xy) AS c, (yv * xx - xv * xy) / (xx * yy - xy * xy) AS d FROM f JOIN m USING (g)),
z AS (SELECT *, greatest(abs(a - 1), abs(b), abs(c), abs(d - 1)) * 400 <= 0.5 AS shift_only FROM l)"""


@query(f"WITH {_PLANS} SELECT g, corners, shift_only, " + ", ".join(f"round(CASE WHEN shift_only THEN {w} ELSE {f} END, 5) AS {n}" for n, w, f in (("a", "1", "a"), ("b", "0", "b"), ("tx", "sx", "mu - a * mx - b * my"), ("c", "0", "c"), ("d", "1", "d"), ("ty", "sy", "mv - c * mx - d * my"))) + " FROM z")
def jn16_anchor(t):
    """Two plans of the same tiles: some groups differ by a shift, others by a stretch as well."""
    k = F.col("o_orderkey")
    n = t("orders").select(k.alias("k"), F.col("o_orderpriority").alias("g"), F.lit(100.0).alias("width"), F.lit(80.0).alias("height"), (1 + (F.col("o_custkey") % 7) / 1000.0).alias("a"), ((F.col("o_custkey") % 5) / 1000.0).alias("b"), F.col("o_custkey").cast("double").alias("tx"), F.lit(0.0).alias("c"), F.lit(1.0).alias("d"), (k % 211).cast("double").alias("ty"))
    same = F.substring("g", 1, 1) <= "2"
    o = n.filter("k % 7 <> 0").select("k", F.when(same, F.col("a")).otherwise(F.col("a") * 1.001).alias("a"), "b", F.when(same, F.col("tx") + 5).otherwise(F.col("tx") * 1.001 + 5).alias("tx"), "c", "d", (F.col("ty") - 3 + F.col("k") % 3).alias("ty"))
    out = st.anchored(o, n, ["k"], ["g"], 400.0)
    return out.select("g", "corners", "shift_only", *[r(c, 5).alias(c) for c in ("a", "b", "tx", "c", "d", "ty")])


_FLAT = f"WITH n AS (SELECT y // 16 AS tile, x // 8 AS gx, (y % 16) // 4 AS gy, 1 + avg(v) / 997 AS gain FROM ({_IMG}) GROUP BY 1, 2, 3), q AS (SELECT y // 16 AS tile, y, x, v, least(greatest((x + 0.5::DOUBLE) / 8 - 0.5, 0), 7) AS fx, least(greatest((y % 16 + 0.5::DOUBLE) / 4 - 0.5, 0), 3) AS fy FROM ({_IMG})), c AS (SELECT *, CAST(least(floor(fx), 6) AS BIGINT) AS x0, CAST(least(floor(fy), 2) AS BIGINT) AS y0 FROM q), g AS (SELECT c.y, c.x, c.v, sum(n.gain * (CASE WHEN gx = x0 THEN 1 - fx + x0 ELSE fx - x0 END) * (CASE WHEN gy = y0 THEN 1 - fy + y0 ELSE fy - y0 END)) AS gain FROM c JOIN n ON n.tile = c.tile AND gx BETWEEN x0 AND x0 + 1 AND gy BETWEEN y0 AND y0 + 1 GROUP BY 1, 2, 3)"


@query(_FLAT + " SELECT y, x, round(gain, 6) AS gain, round(v / gain, 4) AS v FROM g")
def nu23_flat_field_at_pixels(t):
    """Tiles of 16 rows; their fields have a node for each 4 x 8 pixels."""
    i = image(t).withColumn("tile", F.floor(F.col("y") / 16))
    n = i.groupBy("tile", F.floor(F.col("x") / 8).alias("gx"), F.floor(F.col("y") % 16 / 4).alias("gy")).agg((1 + F.avg("v") / 997).alias("gain"))
    out = p.field_at(i.withColumn("row", F.col("y") % 16), n, ["tile"], "x", "row", "gx", "gy", "gain", (64, 16), (8, 4))
    return out.select("y", "x", r("gain").alias("gain"), r(F.col("v") / F.col("gain"), 4).alias("v"))


@query("SELECT o_orderkey, o_orderpriority AS value FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '5-LOW')")
def flt13_outside_domain(t):
    return s.outside_domain(t("orders"), {"o_orderpriority": ("1-URGENT", "2-HIGH", "5-LOW")}, ["o_orderkey"]).select("o_orderkey", "value")


@query("SELECT DISTINCT l_quantity / 2 AS percent, 't_p' || replace(regexp_replace(CAST(l_quantity / 2 AS VARCHAR), '[.]0$', ''), '.', '_') AS name FROM lineitem")
def mi8_percentile_columns(t):
    return t("lineitem").select((F.col("l_quantity") / 2).alias("percent")).distinct().withColumn("name", s.percentile_name(F.col("percent"), True))


@query("SELECT l_suppkey AS parent, CAST(count(*) AS BIGINT) AS children, made IS NULL OR made <= max(m) AS redo FROM (SELECT l_suppkey // 2 AS l_suppkey, l_suppkey AS child, max(l_shipdate) AS m FROM lineitem GROUP BY 1, 2) c LEFT JOIN (SELECT s_suppkey AS k, max(o_orderdate) AS made FROM supplier JOIN orders ON o_custkey % 50 = s_suppkey GROUP BY 1) d ON k = l_suppkey GROUP BY 1, made")
def or5_shards_to_redo(t):
    """A shard is made anew if it was made before the newest of the shards it is pooled from."""
    child = t("lineitem").groupBy(F.col("l_suppkey").alias("child")).agg(F.max("l_shipdate").alias("changed")).withColumn("parent", F.floor(F.col("child") / 2))
    o = t("orders").groupBy((F.col("o_custkey") % 50).alias("parent")).agg(F.max("o_orderdate").alias("made"))
    made = o.join(t("supplier").select(F.col("s_suppkey").alias("parent")), "parent", "left_semi")
    return s.stale_parents(child, made, "parent", "changed", "made").select("parent", "children", "redo")


_PAIRS = "SELECT l_suppkey AS z, l_linenumber % 3 || '-' || l_partkey % 3 AS a, (l_linenumber + 1) % 3 || '-' || l_partkey % 2 AS b, l_quantity - 25 AS before, (l_discount - 0.05) * 400 AS after FROM lineitem"


@query(f"WITH k AS (SELECT * FROM ({_PAIRS}) WHERE split_part(a, '-', 1) = split_part(b, '-', 1) OR split_part(a, '-', 2) = split_part(b, '-', 2)), m AS (SELECT z, a, b, median(before) AS before, median(after) AS after FROM k GROUP BY 1, 2, 3), g AS (SELECT *, CASE WHEN z < 30 THEN '0-30' WHEN z < 60 THEN '30-60' ELSE '60-' END AS band FROM m) SELECT band, CAST(count(*) AS BIGINT) AS seams, round(median(abs(before)), 6) AS before_med, round(median(abs(after)), 6) AS after_med, CAST(count(*) FILTER (WHERE abs(before) > 10) AS BIGINT) AS before_n10, CAST(count(*) FILTER (WHERE abs(after) > 10) AS BIGINT) AS after_n10 FROM g GROUP BY 1")
def mi29_sweep_summary(t):
    """Seams of tiles side by side: median size before and after, and how many are large, by bands of slices."""
    a, b = (F.concat_ws("-", (x % 3).cast("string"), (F.col("l_partkey") % n).cast("string")) for x, n in ((F.col("l_linenumber"), 3), (F.col("l_linenumber") + 1, 2)))
    l = t("lineitem").select(F.col("l_suppkey").alias("z"), a.alias("a"), b.alias("b"), (F.col("l_quantity") - 25).alias("before"), ((F.col("l_discount") - 0.05) * 400).alias("after"))
    out = s.seam_summary(l, "z", "a", "b", ["before", "after"], [30, 60], 10.0)
    return out.select("band", "seams", r("before_med").alias("before_med"), r("after_med").alias("after_med"), "before_n10", "after_n10")


@query("WITH f AS (SELECT event_id, value AS zoom, user_id * 1.0::DOUBLE AS z, (event_id % 11) / 10.0::DOUBLE AS reveal, CASE WHEN event_id % 5 = 0 THEN NULL ELSE user_id - event_id % 40 END AS start FROM events), s AS (SELECT *, CASE WHEN start IS NULL OR z + 0.5 <= start THEN NULL ELSE z + 0.5 - start END AS span, CASE WHEN start IS NULL OR z + 0.5 <= start THEN NULL ELSE start * 1.0::DOUBLE END AS lo FROM f) SELECT event_id, lo, round(radians(30) * reveal, 6) AS yaw, round(radians(20) * reveal, 6) AS tilt, round(1000 * zoom * (1 + 0.5::DOUBLE * reveal), 4) AS distance, round(z + 0.5 - coalesce(reveal * span / 2, 0), 6) AS look FROM s")
def mi18_mesh_camera(t):
    """Where the camera looks while meshes are revealed: turned, raised and pulled back about the middle of what is shown."""
    f = t("events").select("event_id", F.col("value").alias("zoom"), F.col("user_id").cast("double").alias("z"), (F.col("event_id") % 11 / 10.0).alias("reveal"), F.when(F.col("event_id") % 5 != 0, (F.col("user_id") - F.col("event_id") % 40).cast("double")).alias("start"))
    lo, yaw, tilt, distance, look = s.mesh_camera(F.col("z"), F.col("start"), F.col("reveal"), F.col("zoom"), 30.0, 20.0, 1.5, 1000.0)
    return f.select("event_id", lo.alias("lo"), r(yaw).alias("yaw"), r(tilt).alias("tilt"), r(distance, 4).alias("distance"), r(look).alias("look"))


_WAY = "CASE WHEN {l} <= 0 THEN CASE WHEN {t} >= {a} THEN 1.0 ELSE 0.0 END ELSE (CASE WHEN {s} < {e} THEN {s} / 2 - {e} / (2 * pi()) * sin(pi() * {s} / {e}) WHEN {s} > {l} - {e} THEN {l} - {e} - (({l} - {s}) / 2 - {e} / (2 * pi()) * sin(pi() * ({l} - {s}) / {e})) ELSE {s} - {e} / 2 END) / ({l} - {e}) END"


@query("WITH f AS (SELECT event_id, value AS t, (user_id % 5) * 1.0::DOUBLE AS a, (event_id % 4) * 20.0::DOUBLE AS l, least((event_id % 7) * 3.0::DOUBLE, (event_id % 4) * 10.0::DOUBLE) AS e, value / 90 AS u FROM events), g AS (SELECT *, least(greatest(t - a, 0), l) AS s FROM f) SELECT event_id, round(" + _WAY.format(l="l", t="t", a="a", s="s", e="e") + ", 6) AS way, round(CASE WHEN u <= 0 THEN 1.0 WHEN u >= 1 THEN 0.0 ELSE 1 - exp(-(1 - u) / (8 * u)) END, 6) AS opacity FROM g")
def mi21_progress(t):
    """How far moves of several lengths and ramps are, and how opaque what fades on the way is."""
    f = t("events").select("event_id", F.col("value").alias("t"), (F.col("user_id") % 5).cast("double").alias("a"), (F.col("event_id") % 4 * 20).cast("double").alias("l"), (F.col("event_id") % 7 * 3).cast("double").alias("e"))
    way = motion.travelled(F.col("t"), F.col("a"), F.col("a") + F.col("l"), F.col("e"))
    return f.select("event_id", r(way).alias("way"), r(motion.veil(F.col("t") / 90, F.lit(8.0))).alias("opacity"))


@query("WITH f AS (SELECT c_nationkey AS g, (row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1) / 25.0::DOUBLE AS t FROM customer), d AS (SELECT *, max(t) OVER (PARTITION BY g) AS l0, least(0.5::DOUBLE, max(t) OVER (PARTITION BY g) / 2) AS a FROM f), h AS (SELECT *, l0 - a AS l, least(1.0::DOUBLE, (l0 - a) / 2) AS e, least(greatest(t - a, 0), l0 - a) AS s FROM d), b AS (SELECT *, 16 * least(greatest(t / greatest(a, 1e-9), 0), 1) + (800 - 16) * (" + _WAY.format(l="l", t="t", a="a", s="s", e="e") + ") AS depth FROM h), q AS (SELECT *, depth - lag(depth) OVER (PARTITION BY g ORDER BY t) AS ahead FROM b) SELECT g, round(coalesce(max(CASE WHEN ahead >= 4 THEN t END), max(l0)), 6) AS stop FROM q GROUP BY 1")
def mi21_build_stop(t):
    """Frames are the customers of a nation: when a build of 800 voxels visibly stops."""
    w = W.partitionBy("g")
    f = t("customer").select(F.col("c_nationkey").alias("g"), ((F.row_number().over(W.partitionBy("c_nationkey").orderBy("c_custkey")) - 1) / 25.0).alias("t")).withColumn("done", F.max("t").over(w))
    f = f.withColumn("depth", motion.built(F.col("t"), F.col("done"), F.lit(800.0), F.lit(16.0), F.lit(0.5), F.lit(1.0)))
    return motion.visible_end(f, ["g"], "t", "depth", "done", 2).select("g", r("stop").alias("stop"))


@query("WITH w AS (SELECT p_partkey, p_retailprice / 10 AS lo, p_size * 255.0::DOUBLE / 225 AS span FROM part) SELECT p_partkey, round(lo - 12 / 255.0::DOUBLE * span, 6) AS lo, round(lo - 12 / 255.0::DOUBLE * span + span, 6) AS hi, CAST(2000 - p_partkey % 1000 - p_size AS BIGINT) AS row0, CAST(2000 - p_partkey % 1000 AS BIGINT) AS row1 FROM w JOIN (SELECT p_partkey, p_size FROM part) USING (p_partkey)")
def mi16_crop_windows(t):
    """Windows so wide that their former ends come out at 12 and 237, and rows of a crop of a turned canvas."""
    at = F.col("p_partkey") % 1000
    lo, hi = s.widened(F.col("p_retailprice") / 10, F.col("p_retailprice") / 10 + F.col("p_size"), 12.0, 237.0)
    row0, row1 = s.turned(at, at + F.col("p_size"), F.lit(2000))
    return t("part").select("p_partkey", r(lo).alias("lo"), r(hi).alias("hi"), row0.cast("long").alias("row0"), row1.cast("long").alias("row1"))
