"""Both jobs: reruns, growing input, odd rows, and the command line."""

import datetime
import json
import os
import subprocess
import sys

import pytest

from jobs import archive_inventory as inv
from jobs import preview_statistics as prev
from jobs import queries

D = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
EVENTS = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_inventory_of_odd_rows(spark, tmp_path):
    docs = [
        (1, "abc", "en", "a", 3), (2, "abc", "en", "b", 3), (3, "abc", "en", "b", 3), (4, "", "en", "a", 0), (5, None, "en", "a", 0), (6, "é" * 9, "fr", "a", 18), (7, "x", None, "a", 1),
        (8, "y", "en", None, 1), (9, "z", "en", "", 1), (9, "z", "en", "", 1), (10, "w", "en", "a/b c", None), (None, "abc", "en", "a", 3), (11, "last", "de", "a", 4),
    ]
    at, out = str(tmp_path / "docs"), str(tmp_path / "out")
    spark.createDataFrame(docs, DOCS).write.parquet(at)
    counts = inv.run(spark, at, out)
    assert counts == {"read": 13, "files": 12, "ok": 3}
    got = {r.doc_id: r for r in spark.read.schema(inv.FILES).parquet(f"{out}/files").collect()}
    assert {k: r.status for k, r in got.items()} == {1: "ok", 2: "copy", 3: "copy", 4: "empty", 5: "empty", 6: "length", 7: "label", 8: "label", 9: "ok", 10: "length", None: "no_id", 11: "ok"}
    assert (got[2].copy_of, got[2].copy_source, got[1].copy_of) == (1, "a", None)
    assert [got[k].z for k in (1, 9, 11, 2)] == [0, 1, 2, None] and got[9].times == 2 and got[9].source == ""
    report = {(r.source, r.status): r for r in spark.read.schema(inv.REPORT).parquet(f"{out}/report").collect()}
    assert (report["b", "copy"].n_files, report["b", "copy"].n_bytes, report["b", "copy"].first_id, report["b", "copy"].last_id) == (2, 6, 2, 3)
    assert sum(r.n_rows for r in report.values()) == 13


def test_inventory_runs_again_with_the_same_result(spark, tmp_path):
    out = str(tmp_path / "out")
    first = inv.run(spark, f"{D}/documents.parquet", out)
    one = rows(spark.read.schema(inv.FILES).parquet(f"{out}/files"))
    assert inv.run(spark, f"{D}/documents.parquet", out) == first
    assert rows(spark.read.schema(inv.FILES).parquet(f"{out}/files")) == one
    assert inv.run(spark, f"{D}/documents.parquet", str(tmp_path / "small"), bucket=7) == first
    assert rows(spark.read.schema(inv.FILES).parquet(str(tmp_path / "small" / "files"))) == one
    # a source that is gone from the archive is gone from the inventory
    fewer = str(tmp_path / "fewer")
    spark.read.parquet(f"{D}/documents.parquet").filter("source = 'src1'").write.parquet(fewer)
    inv.run(spark, fewer, out)
    assert {r.source for r in spark.read.schema(inv.FILES).parquet(f"{out}/files").collect()} == {"src1"}


def test_inventory_of_an_empty_archive(spark, tmp_path):
    at, out = str(tmp_path / "docs"), str(tmp_path / "out")
    spark.createDataFrame([], DOCS).write.parquet(at)
    assert inv.run(spark, at, out) == {"read": 0, "files": 0, "ok": 0}


def moment(day, hour=1):
    return datetime.datetime(2024, 1, day, hour)


def stats(spark, out):
    return {(str(r.day) if r.day else None, r.tile): r for r in spark.read.schema(prev.STATS).parquet(f"{out}/stats").collect()}


def put(spark, at, rows_):
    spark.createDataFrame([(i, *r, None) for i, r in enumerate(rows_)], EVENTS).coalesce(1).write.mode("append").parquet(at)


def test_statistics_take_only_what_is_new(spark, tmp_path):
    at, out, mark = (str(tmp_path / x) for x in ("events", "out", "mark"))
    put(spark, at, [(moment(1), 1, "t", 2.0), (moment(1), 1, "t", 4.0), (moment(2), 1, "u", 1.5)])
    assert prev.run(spark, at, out, mark) == {"batches": 1, "read": 3}
    first = stats(spark, out)
    assert (first["2024-01-01", "t"].n, first["2024-01-01", "t"].mean, first["2024-01-01", "t"].std, first["2024-01-01", "t"].p50) == (2, 3.0, 1.0, 2.0)
    assert prev.run(spark, at, out, mark) == {"batches": 0, "read": 0}
    assert stats(spark, out) == first
    # new files: a late row of the first day, a new day, missing values, no time, no type
    put(spark, at, [(moment(1, 3), 1, "t", 9.0), (moment(3), 1, "t", None), (moment(3), 1, "t", float("nan")), (moment(3), 1, None, 5.0), (None, 1, "t", 7.0)])
    put(spark, at, [(moment(3), 1, "t", float("inf")), (moment(1), 1, "t", 2.5)])
    assert prev.run(spark, at, out, mark, files_per_batch=1) == {"batches": 2, "read": 7}
    now = stats(spark, out)
    t = now["2024-01-01", "t"]
    assert (t.n, t.n_missing, t.mean, t.low, t.high, t.p5, t.p50, t.p95) == (4, 0, 4.375, 2.0, 9.0, 2.0, 2.0, 9.0)
    assert now["2024-01-02", "u"] == first["2024-01-02", "u"]
    assert (now["2024-01-03", "t"].n, now["2024-01-03", "t"].n_missing, now["2024-01-03", "t"].mean) == (0, 3, None)
    assert now["2024-01-03", None].mean == 5.0 and now[None, "t"].n == 1
    # all at once gives the same
    whole, mark2 = str(tmp_path / "whole"), str(tmp_path / "mark2")
    prev.run(spark, at, whole, mark2)
    assert stats(spark, whole) == now


def test_a_batch_that_is_repeated_counts_once(spark, tmp_path):
    """The output of the last batch is written, its commit is lost: the next run takes it again."""
    at, out, mark = (str(tmp_path / x) for x in ("events", "out", "mark"))
    put(spark, at, [(moment(1), 1, "t", 2.0)])
    prev.run(spark, at, out, mark)
    put(spark, at, [(moment(1), 1, "t", 4.0)])
    prev.run(spark, at, out, mark)
    before = stats(spark, out)
    for name in ("1", ".1.crc"):
        os.remove(f"{mark}/commits/{name}")
    assert prev.run(spark, at, out, mark) == {"batches": 1, "read": 1}
    assert stats(spark, out) == before and before["2024-01-01", "t"].n == 2


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_settings_are_as_before(spark, name):
    held = {k: v for k, v in spark.conf.getAll.items()} if hasattr(type(spark.conf), "getAll") else None
    assert queries.QUERIES[name](spark, D).count() > 0
    assert held is None or {k: v for k, v in spark.conf.getAll.items()} == held
    assert not spark.streams.active


def test_command_line(tmp_path):
    config = tmp_path / "c.toml"
    config.write_text(f"[archive_inventory]\nbucket = 50\ndocuments = {json.dumps(f'{D}/documents.parquet')}\n")
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    done = subprocess.run([sys.executable, "-m", "jobs.archive_inventory", "--config", str(config), "--output", str(tmp_path / "out")], cwd=root, capture_output=True, text=True, timeout=300, env=os.environ | {"SPARK_LOCAL_IP": "127.0.0.1"})
    assert done.returncode == 0, done.stderr[-2000:]
    assert "read 200 rows" in done.stderr and os.path.exists(tmp_path / "out" / "files" / "_SUCCESS")
    short = subprocess.run([sys.executable, "-m", "jobs.preview_statistics", "--events", "x"], cwd=root, capture_output=True, text=True, timeout=100)
    assert short.returncode == 2 and "no path for: output, checkpoint" in short.stderr
