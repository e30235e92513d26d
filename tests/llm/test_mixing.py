from collections import defaultdict

from sectile.llm import mixing

D = "/root/testdata/sf0.01"


def test_blocks_run_in_their_windows_and_sources_keep_their_pace(spark):
    # texts shorter than a block, so that every block has a row
    docs = spark.range(6000).selectExpr("id AS doc_id", "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('s', id % 11) END AS source", "repeat('x', cast(id % 90 AS int)) AS text")
    rows = mixing.positions(docs, block_bytes=200).collect()
    assert len(rows) == docs.count()
    assert all(r.release <= r.slot < r.due for r in rows)
    slots = {}
    blocks = defaultdict(set)
    for r in rows:
        assert slots.setdefault(r.slot, (r.source, r.block)) == (r.source, r.block)
        blocks[r.source].add(r.slot)
    share = {r.source: r.share for r in rows}
    period = rows[0].period
    assert sum(share.values()) == period
    dry = min(max(b) for b in blocks.values())
    for s, mine in blocks.items():
        n = 0
        for t in range(dry):
            assert abs(n - t * share[s] / period) < 1
            n += t in mine


def test_blocks_hold_equal_bytes(spark):
    rows = mixing.positions(spark.read.parquet(f"{D}/documents.parquet"), block_bytes=20000).collect()
    by = defaultdict(list)
    for r in rows:
        by[r.source].append(r)
    for mine in by.values():
        mine.sort(key=lambda r: r.start_byte)
        at = 0
        for r in mine:
            assert (r.start_byte, r.block) == (at, at // 20000)
            at += r.n_bytes


def test_targets_odd_rows_and_order(spark):
    df = spark.createDataFrame([(1, "a", "xx", 0), (1, "a", "xx", 0), (2, None, None, 0), (None, "", "", 0), (3, "b", "y" * 9000, 0)], "doc_id long, source string, text string, slot int")
    rows = mixing.positions(df, {"a": 3.0, "b": 1.0}, block_bytes=4).collect()
    assert len(rows) == 5
    share = {r.source: r.share for r in rows}
    assert share["a"] > 2.9 * share["b"] and share[""] >= 1
    out = mixing.mixed(df, {"a": 3.0, "b": 1.0})
    assert out.columns == df.columns and sorted(map(str, out.collect())) == sorted(map(str, df.collect()))
    assert mixing.positions(df.limit(0)).count() == 0


def test_clashing_names_ties_and_very_long_texts(spark):
    long = "z" * 500_000
    rows = [(1, 7, "a", "xx", 5, "p"), (1, 8, "a", "yy", 6, "q"), (2, 9, "a", long, 7, "r")]
    df = spark.createDataFrame(rows, "a long, b long, c string, d string, e long, f string").toDF("doc_id", "DOC_ID", "source", "text", "_bytes", "_share")
    out = mixing.mixed(df, block_bytes=64)
    assert out.columns == df.columns and sorted(map(tuple, out.collect())) == rows
    placed = [mixing.positions(df.select("*").repartition(n), block_bytes=64).select("doc_id", "n_bytes", "start_byte", "slot").collect() for n in (1, 3)]
    assert sorted(map(tuple, placed[0])) == sorted(map(tuple, placed[1]))
    back = mixing.with_places(out, mixing.positions(df, block_bytes=64))
    assert back.columns == [*df.columns, "slot", "start_byte"] and back.filter("slot IS NULL").count() == 0
    assert sorted(tuple(r)[:6] for r in back.collect()) == rows
