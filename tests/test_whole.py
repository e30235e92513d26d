"""Queries over whole tables against plain loops."""

import numpy as np

import __spark_entry__ as e

D = "/root/testdata/sf0.001"


def test_all_rows_are_asked_for_reuse(spark):
    rows = spark.read.parquet(f"{D}/lineitem.parquet").collect()
    old, want = {}, {}
    for new in (False, True):
        for r in rows:
            frame, same = r.l_orderkey * 10 + r.l_linenumber, (r.l_quantity, r.l_discount, r.l_tax if r.l_tax > 0 else None)
            if not new and r.l_linestatus != "O":
                old[same] = min(frame, old.get(same, frame))
            elif new and r.l_linestatus == "O" and same in old:
                want[frame] = min(old[same], want.get(frame, old[same]))
    got = {r.frame: r.old_frame for r in e.queries()["jn18_reusable_rows"](spark, D).collect()}
    assert got == want and len(want) > 100


def test_window_fraction_of_the_whole_image(spark):
    from sectile.plans.q_scalars import image

    d = D.replace("0.001", "0.01")
    v = {(r.y, r.x): r.v > 130 for r in image(lambda name: spark.read.parquet(f"{d}/{name}.parquet")).collect()}
    got = {(r.y, r.x): r.fraction for r in e.queries()["mi24_window_fraction"](spark, d).collect()}
    assert got.keys() == v.keys() and max(y for y, _ in got) >= 80
    for y, x in v:
        near = [v[a, b] for a in range(y - 2, y + 3) for b in range(x - 2, x + 3) if (a, b) in v]
        assert abs(got[y, x] - np.mean(near)) < 1e-6


def test_components_over_all_edges(spark, tmp_path):
    r = np.random.default_rng(3)
    edges = [(int(s), int(p)) for s, p in zip(r.integers(0, 60, 70), r.integers(0, 90, 70))] + [(100 + i // 2, 100 + (i + 1) // 2) for i in range(40)]
    spark.createDataFrame([(s, p, 1.0, 0.0) for s, p in edges], "l_suppkey long, l_partkey long, l_quantity double, l_discount double").write.parquet(f"{tmp_path}/lineitem.parquet")
    own = {n: n for s, p in edges for n in (2 * s, 2 * p + 1)}

    def find(n):
        while own[n] != n:
            n = own[n]
        return n

    for s, p in edges:
        x, y = find(2 * s), find(2 * p + 1)
        own[max(x, y)] = min(x, y)
    got = {x.node: x.component for x in e.queries()["nu7_components"](spark, str(tmp_path)).collect()}
    assert got == {n: find(n) for n in own} and len(set(got.values())) > 3


def test_plot_table_has_all_rows(spark, tmp_path):
    spark.createDataFrame([(k, k + 0.25) for k in range(1, 49)], "o_orderkey long, o_totalprice double").write.parquet(f"{tmp_path}/orders.parquet")
    got = sorted(tuple(x) for x in e.queries()["snk17_plot_table"](spark, str(tmp_path)).collect())
    assert got == [(k, k, f"{k}.25") for k in range(1, 49)]


def test_background_query_finds_some_and_not_all(spark):
    from pyspark.sql import functions as F

    r = e.queries()["im3_background"](spark, "/root/testdata/sf0.01").agg(F.count("*").alias("n"), F.sum("v").alias("s")).first()
    assert r.n == 32_000 and 0.02 * r.n < r.s < 0.98 * r.n
