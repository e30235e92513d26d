"""Window operators on the driver tables: events as the acquisition clock (event_type a tile, user a file)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import windows as w
from .base import micros, query, r

_CLOCK = "SELECT event_id, user_id, event_type, value, ts, epoch_us(ts) AS us FROM events"


def clock(t):
    return t("events").select("event_id", "user_id", "event_type", "value", "ts", micros("ts").alias("us"))


@query("SELECT event_id, CAST(dense_rank() OVER (ORDER BY ts) - 1 AS BIGINT) AS z FROM events")
def wn1_slice_index(t):
    return w.global_index(t("events").select("event_id", "ts"), "ts", F.date_trunc("hour", "ts")).select("event_id", "z")


_SEGMENTS = f"""WITH c AS ({_CLOCK}), s AS (SELECT *, CASE WHEN event_type IS DISTINCT FROM lag(event_type) OVER o THEN 1 ELSE 0 END AS new FROM c WINDOW o AS (PARTITION BY user_id ORDER BY us)),
seg AS (SELECT *, CAST(sum(new) OVER (PARTITION BY user_id ORDER BY us ROWS UNBOUNDED PRECEDING) - 1 AS BIGINT) AS segment FROM s)"""


@query(_SEGMENTS + " SELECT event_id, user_id, segment FROM seg")
def wn2_segments(t):
    return w.islands(clock(t), ["event_type"], "us", ["user_id"]).select("event_id", "user_id", "segment")


@query(f"""WITH c AS ({_CLOCK}), n AS (SELECT *, CASE WHEN value >= 20 THEN value END AS v FROM c) SELECT event_id, coalesce(last_value(v IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY us ROWS UNBOUNDED PRECEDING),
 first_value(v IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY us ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS v FROM n""")
def wn3_fill(t):
    return w.filled(clock(t).withColumn("v", F.expr("CASE WHEN value >= 20 THEN value END")), "v", "us", ["user_id"]).select("event_id", "v")


_GAPS = _SEGMENTS + """, i AS (SELECT *, CAST((us - lag(us) OVER o) / 1e6 AS DOUBLE) AS interval_s, lag(segment) OVER o AS ps FROM seg WINDOW o AS (PARTITION BY user_id ORDER BY us)),
m AS (SELECT *, coalesce(median(CASE WHEN ps = segment THEN interval_s END) OVER (PARTITION BY user_id, segment), median(interval_s) OVER (PARTITION BY user_id)) AS median_s FROM i),
g AS (SELECT *, coalesce(interval_s > 1.5 * median_s, false) AS gap FROM m)"""


def gapped(t):
    c = w.islands(clock(t), ["event_type"], "us", ["user_id"]).withColumn("s", F.col("us") / F.lit(1e6))
    # differences are taken in whole microseconds, so that both engines agree
    c = w.gaps(c, "us", "segment", "us", ["user_id"])
    return c.withColumn("interval_s", F.col("interval_s") / F.lit(1e6)).withColumn("median_s", F.col("median_s") / F.lit(1e6))


@query(_GAPS + " SELECT event_id, segment, round(interval_s, 6) AS interval_s, round(median_s, 7) AS median_s, gap FROM g")
def wn4_gaps(t):
    return gapped(t).select("event_id", "segment", r("interval_s").alias("interval_s"), r("median_s", 7).alias("median_s"), "gap")


@query(_GAPS + """, u AS (SELECT *, value >= 20 AS usable, coalesce(sum(CASE WHEN value >= 20 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY us ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS grp FROM g)
SELECT event_id, max(CASE WHEN gap THEN 1 ELSE 0 END) OVER (PARTITION BY user_id, grp ORDER BY us ROWS UNBOUNDED PRECEDING) = 1 AS seam FROM u""")
def wn5_seam(t):
    return w.carried(gapped(t), F.col("gap"), F.col("value") >= 20, "us", ["user_id"]).select("event_id", "seam")


_ORDER = "l_shipdate, l_partkey, l_suppkey, l_extendedprice, l_quantity, l_discount, l_tax"


@query(f"""SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {_ORDER}) AS n FROM lineitem) WHERE n = 1""")
def wn6_dedup(t):
    return w.first_of(t("lineitem"), ["l_orderkey", "l_linenumber"], _ORDER.split(", ")).select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")


_MEDIAN = f"WITH c AS (SELECT *, date_trunc('day', ts) AS day FROM ({_CLOCK})), m AS (SELECT *, median(value) OVER (PARTITION BY event_type, day ORDER BY us ROWS BETWEEN 25 PRECEDING AND 25 FOLLOWING) AS smooth FROM c)"


def smoothed(t):
    return w.running_median(clock(t).withColumn("day", F.date_trunc("day", "ts")), "value", 51, "us", ["event_type", "day"])


@query(_MEDIAN + " SELECT event_id, round(smooth, 6) AS smooth FROM m")
def wn7_running_median(t):
    return smoothed(t).select("event_id", r("smooth").alias("smooth"))


@query(_SEGMENTS + ", b AS (SELECT *, us - lag(us) OVER (PARTITION BY user_id ORDER BY us) AS d FROM seg) SELECT event_id, CAST(sum(CASE WHEN d > 20000000000 OR value > 150 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY us ROWS UNBOUNDED PRECEDING) AS BIGINT) AS block FROM b")
def wn8_blocks(t):
    c = clock(t).withColumn("d", F.expr("us - lag(us) OVER (PARTITION BY user_id ORDER BY us)"))
    return w.blocks(c, (F.col("d") > 20_000_000_000) | (F.col("value") > 150), "us", ["user_id"]).select("event_id", "block")


@query(_MEDIAN + " SELECT event_id, round(value - smooth, 6) AS jump, round(median(value - smooth) OVER (PARTITION BY date_trunc('hour', ts)), 6) AS slice_jump FROM m")
def wn9_jump(t):
    j = smoothed(t).withColumn("j", F.col("value") - F.col("smooth"))
    return j.select("event_id", r("j").alias("jump"), r(F.expr("median(j) OVER (PARTITION BY date_trunc('hour', ts))")).alias("slice_jump"))


_DAILY = "WITH d AS (SELECT o_orderpriority AS p, date_diff('day', DATE '1990-01-01', CAST(o_orderdate AS DATE)) AS day, round(avg(o_totalprice), 4) AS v FROM orders GROUP BY 1, 2)"


def daily(t):
    return t("orders").groupBy(F.col("o_orderpriority").alias("p"), F.datediff("o_orderdate", F.lit("1990-01-01").cast("date")).cast("long").alias("day")).agg(r(F.avg("o_totalprice"), 4).alias("v"))


@query(_DAILY + """, w AS (SELECT *, row_number() OVER (PARTITION BY p ORDER BY day) AS i, count(*) OVER (PARTITION BY p) AS n, first_value(v) OVER a AS f, last_value(v) OVER a AS l, sum(v) OVER (PARTITION BY p ORDER BY day ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING) AS s FROM d WINDOW a AS (PARTITION BY p ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))
SELECT p, day, round((s + greatest(3 - (i - 1), 0) * f + greatest(3 - (n - i), 0) * l) / 7, 6) AS smooth FROM w""")
def wn10_ramp(t):
    return w.ramp(daily(t), "v", 3, "day", ["p"]).select("p", "day", r("smooth", 6).alias("smooth"))


@query(_DAILY + " SELECT p, day, round(median(v) OVER (PARTITION BY p ORDER BY day RANGE BETWEEN 15 PRECEDING AND 15 FOLLOWING), 6) AS smooth FROM d")
def wn11_range_median(t):
    return w.range_median(daily(t), "v", "day", 15, ["p"]).select("p", "day", r("smooth", 6).alias("smooth"))


@query(f"WITH c AS ({_CLOCK}), d AS (SELECT event_type, value - lag(value) OVER (PARTITION BY event_type ORDER BY us) AS d FROM c), m AS (SELECT *, median(d) OVER (PARTITION BY event_type) AS m FROM d WHERE d IS NOT NULL) SELECT event_type, round(median(abs(d - m)) * 1.4826 / sqrt(2.0), 6) AS noise FROM m GROUP BY 1")
def wn13_noise(t):
    return w.noise(clock(t), "value", "us", ["event_type"]).select("event_type", r("noise").alias("noise"))


@query(_DAILY + ", c AS (SELECT *, count(*) OVER (PARTITION BY p ORDER BY day RANGE BETWEEN 10 PRECEDING AND 10 FOLLOWING) AS n FROM d), s AS (SELECT p, day, row_number() OVER (PARTITION BY p ORDER BY day) AS i FROM c WHERE n < 21), g AS (SELECT *, day - i AS g FROM s) SELECT p, CAST(min(day) AS BIGINT) AS first, CAST(max(day) AS BIGINT) AS last, count(*) AS n FROM g GROUP BY p, g.g")
def wn14_shortened(t):
    from pyspark.sql import Window as W

    short = daily(t).withColumn("n", F.count(F.lit(1)).over(W.partitionBy("p").orderBy("day").rangeBetween(-10, 10))).filter("n < 21").drop("n")
    return w.stretches(short, "day", 1, ["p"])


@query(_DAILY + ", l AS (SELECT *, coalesce(lag(v) OVER o, v) AS a, coalesce(lead(v) OVER o, v) AS b FROM d WINDOW o AS (PARTITION BY p ORDER BY day)) SELECT p, CAST(day AS BIGINT) AS day, list_sort([a, v, b])[2] AS smooth FROM l")
def wn15_median3(t):
    return w.median3(daily(t), "v", "day", ["p"]).select("p", "day", "smooth")


@query(f"WITH c AS ({_CLOCK}) SELECT event_id, CAST(sum(CAST(round(value * 100) AS BIGINT)) OVER (PARTITION BY user_id ORDER BY us ROWS UNBOUNDED PRECEDING) AS BIGINT) AS position FROM c")
def wn16_positions(t):
    return w.cumulative(clock(t).withColumn("s", F.round(F.col("value") * 100).cast("long")), "s", "us", ["user_id"]).select("event_id", "position")


@query(f"""WITH c AS (SELECT *, value + 1 AS s FROM ({_CLOCK})), q AS (SELECT *, greatest(s / (avg(s) OVER (PARTITION BY user_id ORDER BY us ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) / 50.0), 12.5) AS x FROM c),
o AS (SELECT *, sum(x - 12.5) OVER (PARTITION BY user_id) AS over_, count(*) OVER (PARTITION BY user_id) AS n FROM q) SELECT event_id, round(CASE WHEN over_ > 0 THEN 12.5 + (x - 12.5) * n * 37.5 / over_ ELSE 50.0 END, 5) AS held FROM o""")
def wn17_constrained(t):
    return w.constrained(clock(t).withColumn("s", F.col("value") + 1), "s", F.lit(50.0), 2, "us", ["user_id"]).select("event_id", r("held", 5).alias("held"))


@query("""WITH i AS (SELECT l_returnflag AS f, l_orderkey AS lo, l_orderkey + l_linenumber AS hi FROM lineitem), e AS (SELECT f, lo AS pos, 1 AS d FROM i UNION ALL SELECT f, hi, -1 FROM i), g AS (SELECT f, pos, sum(d) AS d FROM e GROUP BY 1, 2)
SELECT f, pos, CAST(sum(d) OVER (PARTITION BY f ORDER BY pos ROWS UNBOUNDED PRECEDING) AS BIGINT) AS n FROM g""")
def wn18_coverage(t):
    i = t("lineitem").select(F.col("l_returnflag").alias("f"), F.col("l_orderkey").alias("lo"), (F.col("l_orderkey") + F.col("l_linenumber")).alias("hi"))
    return w.coverage(i, "lo", "hi", ["f"]).select("f", F.col("at").alias("pos"), F.col("n").cast("long").alias("n"))


@query(_DAILY + ", f AS (SELECT p, regr_slope(v, day) AS k, regr_intercept(v, day) AS b FROM d GROUP BY 1) SELECT d.p, CAST(day AS BIGINT) AS day, round(v - (b + k * day), 3) AS level FROM d JOIN f USING (p)")
def wn19_trend(t):
    return w.detrended(daily(t), "v", "day", ["p"]).select("p", "day", r("level", 3).alias("level"))


@query(_DAILY + " SELECT p, CAST(day AS BIGINT) AS day, round(v - first_value(v) OVER (PARTITION BY p ORDER BY day), 4) AS first, round(v - avg(v) OVER (PARTITION BY p), 4) AS mean FROM d")
def wn20_gauge(t):
    d = w.gauged(daily(t), "v", "day", ["p"], "first", "a")
    return w.gauged(d, "v", "day", ["p"], "mean", "b").select("p", "day", r("a", 4).alias("first"), r("b", 4).alias("mean"))


@query("""WITH c AS (SELECT s_suppkey AS k, s_nationkey AS n, CAST(floor(s_acctbal / 2000) AS BIGINT) AS cell, md5(CAST(s_suppkey AS VARCHAR)) AS h FROM supplier), a AS (SELECT *, row_number() OVER (PARTITION BY n, cell ORDER BY h, k) AS cr FROM c),
b AS (SELECT *, row_number() OVER (PARTITION BY n ORDER BY cr, h, k) AS i FROM a) SELECT k, n, cell, CAST(cr AS BIGINT) AS cell_rank FROM b WHERE i <= 3""")
def wn21_spread(t):
    s = t("supplier").select(F.col("s_suppkey").alias("k"), F.col("s_nationkey").alias("n"), F.floor(F.col("s_acctbal") / 2000).alias("cell"), F.md5(F.col("s_suppkey").cast("string")).alias("h"))
    return w.spread(s, ["cell"], ["n"], ["h", "k"], 3).select("k", "n", "cell", F.col("cell_rank").cast("long").alias("cell_rank"))


@query(_DAILY + " SELECT p, CAST(day AS BIGINT) AS day, min(v) OVER (PARTITION BY p ORDER BY day ROWS UNBOUNDED PRECEDING) AS low FROM d")
def wn22_envelope(t):
    return w.envelope(daily(t), "v", "day", ["p"]).select("p", "day", "low")


@query(_DAILY + ", s AS (SELECT *, coalesce((round(v) + lag(round(v)) OVER o) / 2 * (day - lag(day) OVER o), 0) AS s FROM d WINDOW o AS (PARTITION BY p ORDER BY day)) SELECT p, CAST(day AS BIGINT) AS day, round(sum(s) OVER (PARTITION BY p ORDER BY day ROWS UNBOUNDED PRECEDING), 2) AS integral FROM s")
def wn23_ease_integral(t):
    return w.trapezoid(daily(t).withColumn("v", F.round("v")), "v", "day", "day", ["p"]).select("p", "day", r("integral", 2).alias("integral"))


@query("SELECT event_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts) - 1 AS BIGINT) AS i FROM events")
def wn24_stack_position(t):
    return t("events").select("event_id", F.expr("CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts) - 1 AS BIGINT)").alias("i"))


@query(f"WITH c AS ({_CLOCK}), z AS (SELECT event_type, user_id, row_number() OVER (PARTITION BY event_type ORDER BY us) AS z, value FROM c), b AS (SELECT * FROM z WHERE value > 60), s AS (SELECT *, CASE WHEN z - lag(z) OVER (PARTITION BY event_type ORDER BY z) <= 3 THEN 0 ELSE 1 END AS new FROM b), g AS (SELECT *, sum(new) OVER (PARTITION BY event_type ORDER BY z ROWS UNBOUNDED PRECEDING) AS g FROM s) SELECT event_type, min(z) AS first, max(z) AS last, count(*) AS n FROM g GROUP BY event_type, g.g")
def ag10_stretches(t):
    z = clock(t).withColumn("z", F.expr("CAST(row_number() OVER (PARTITION BY event_type ORDER BY us) AS BIGINT)")).filter("value > 60")
    return w.stretches(z, "z", 3, ["event_type"])


@query("WITH i AS (SELECT o_orderkey, o_orderpriority, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderdate, o_orderkey) - 1 AS i, count(*) OVER (PARTITION BY o_orderpriority) AS n FROM orders) SELECT o_orderkey, o_orderpriority FROM i WHERE i % 25 = 0 OR i = n - 1")
def flt7_every_nth(t):
    return w.every_nth(t("orders").select("o_orderkey", "o_orderpriority", "o_orderdate"), 25, ["o_orderdate", "o_orderkey"], ["o_orderpriority"]).select("o_orderkey", "o_orderpriority")


_PICK = "WITH i AS (SELECT o_orderkey, o_orderpriority, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderdate, o_orderkey) - 1 AS i, count(*) OVER (PARTITION BY o_orderpriority) AS n FROM orders), k AS (SELECT unnest(range(12)) AS k) SELECT DISTINCT o_orderkey, o_orderpriority FROM i, k WHERE i.i = CAST(round_even((n - 1) * {0}, 0) AS BIGINT)"


@query(_PICK.format("(0.0::DOUBLE + 1.0::DOUBLE * k / 11)"))
def flt8_even_pick(t):
    return w.even_pick(t("orders").select("o_orderkey", "o_orderpriority", "o_orderdate"), 12, ["o_orderdate", "o_orderkey"], ["o_orderpriority"]).select("o_orderkey", "o_orderpriority")


@query(_PICK.format("(0.05::DOUBLE + 0.9::DOUBLE * k / 11)"))
def flt9_quantile_positions(t):
    return w.even_pick(t("orders").select("o_orderkey", "o_orderpriority", "o_orderdate"), 12, ["o_orderdate", "o_orderkey"], ["o_orderpriority"], 0.05, 0.95).select("o_orderkey", "o_orderpriority")


_BLOCK = "OVER (PARTITION BY user_id, k, brk"


@query(f"""WITH c AS (SELECT *, value + 1 AS s, 40.0::DOUBLE + user_id % 3 * 10 AS nom, event_id % 11 = 0 AS brk FROM ({_CLOCK})), b AS (SELECT *, sum(CASE WHEN brk THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY us ROWS UNBOUNDED PRECEDING) AS k FROM c),
q AS (SELECT *, greatest(s / (avg(s / nom) {_BLOCK} ORDER BY us ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING)) - 0.4 * nom, 0) AS x FROM b), o AS (SELECT *, sum(x) {_BLOCK}) AS over_, sum(nom - 0.4 * nom) {_BLOCK}) AS room FROM q)
SELECT event_id, round(CASE WHEN brk OR over_ <= 0 THEN nom ELSE 0.4 * nom + x * room / over_ END, 5) AS held FROM o""")
def wn17_between_breaks(t):
    """Nominal spacings that differ, and breaks between which depths are kept."""
    c = clock(t).withColumn("s", F.col("value") + 1)
    out = w.constrained(c, "s", 40.0 + F.col("user_id") % 3 * 10, 2, "us", ["user_id"], F.col("event_id") % 11 == 0, 0.4)
    return out.select("event_id", r("held", 5).alias("held"))


@query(_DAILY + """, s AS (SELECT *, row_number() OVER w - 1 AS i, count(*) OVER (PARTITION BY p) AS n, CASE WHEN day % 97 = 0 THEN coalesce(v - lag(v) OVER w, 0) ELSE 0 END AS st FROM d WINDOW w AS (PARTITION BY p ORDER BY day)),
c AS (SELECT *, v - sum(st) OVER (PARTITION BY p ORDER BY day ROWS UNBOUNDED PRECEDING) AS slow FROM s), g AS (SELECT k, exp(-k * k / 12.5::DOUBLE) AS w FROM range(-10, 11) y(k)),
j AS (SELECT c.p, c.day, c.v, sum(b.slow * w) / sum(w) AS drift FROM c CROSS JOIN g JOIN c b ON b.p = c.p AND b.i = least(greatest(c.i + k, 0), c.n - 1) GROUP BY 1, 2, 3) SELECT p, CAST(day AS BIGINT) AS day, round(v - drift, 3) AS level FROM j""")
def wn19_low_pass(t):
    """Days without their slow drift; the steps to every 97th day are kept."""
    return w.without_drift(daily(t), "v", "day", 2.5, ["p"], F.col("day") % 97 == 0).select("p", "day", r("level", 3).alias("level"))
