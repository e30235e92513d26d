import json
import os
import struct
import time
import zlib

import numpy as np
import pytest

from sectile.plans import orchestrate as o
from sectile.sources import files, stacks, volumes
from sectile.streaming import timeline


def test_stack_reader(spark, tmp_path):
    a = np.random.default_rng(0).integers(0, 65535, (5, 12, 9)).astype(np.uint16)
    stacks.write_stack(str(tmp_path / "t0.tif"), a)
    stacks.write_stack(str(tmp_path / "t1.tif"), a + 1)
    h = stacks.read_header(str(tmp_path / "t0.tif"))
    assert (h["n_slices"], h["height"], h["width"], h["truncated"], h["unit"]) == (5, 12, 9, False, "nm")
    os.truncate(tmp_path / "t1.tif", os.path.getsize(tmp_path / "t1.tif") - 10)
    assert stacks.read_header(str(tmp_path / "t1.tif"))["complete"] == 4
    (tmp_path / "bad.tif").write_bytes(b"no stack at all")
    with pytest.raises(ValueError):
        stacks.read_header(str(tmp_path / "bad.tif"))
    spark.dataSource.register(stacks.StackSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    rows = spark.read.format("stack").option("slices", 2).load(str(tmp_path / "t?.tif")).filter("index >= 1 AND index <= 3").collect()
    assert sorted((os.path.basename(r.file), r["index"]) for r in rows) == [(f"t{k}.tif", i) for k in (0, 1) for i in (1, 2, 3)]
    for r in rows:
        assert np.array_equal(np.frombuffer(r.pixels, "<u2").reshape(r.h, r.w), a[r["index"]] + int(r.file.endswith("1.tif")))
    part = spark.read.format("stack").options(row0=3, row1=7, col0=2, col1=5).load(str(tmp_path / "t0.tif")).collect()
    assert np.array_equal(np.frombuffer(part[2].pixels, "<u2").reshape(4, 3), a[2, 3:7, 2:5])


def test_volume_scales_and_windows(spark, tmp_path):
    v = np.random.default_rng(1).integers(0, 255, (70, 33, 65)).astype(np.uint8)
    path = str(tmp_path / "vol")
    volumes.write_volume(spark, v, path, 32)
    blocks = spark.read.schema(volumes.BLOCKS).parquet(path)
    assert np.array_equal(volumes.read_window(blocks, (5, 0, 20), (40, 40, 70)), np.pad(v, ((0, 0), (0, 7), (0, 5)))[5:40, :40, 20:70])
    p = np.pad(v, ((0, 0), (0, 1), (0, 1)), mode="edge").astype(int)
    want = sum(p[i::2, j::2, k::2] for i in (0, 1) for j in (0, 1) for k in (0, 1)) + 4 >> 3
    volumes.next_scale(blocks, v.shape, 32).write.mode("append").partitionBy("scale").parquet(path)
    got = volumes.read_window(spark.read.schema(volumes.BLOCKS).parquet(path).filter("scale = 1"), (0, 0, 0), want.shape, 32)
    assert np.array_equal(got, want)


def test_small_formats(tmp_path):
    a = np.arange(60, dtype=np.uint8).reshape(5, 4, 3)
    data = files.png(a)
    at = data.index(b"IDAT")
    raw = zlib.decompress(data[at + 4 : at + 4 + struct.unpack(">I", data[at - 4 : at])[0]])
    assert raw[1:13] == a[0].tobytes()
    assert files.byte_range("bytes=2-5", 10) == (2, 5) and files.byte_range("bytes=-3", 10) == (7, 9) and files.byte_range("bytes=20-", 10) is None and files.byte_range("x", 1) is None
    assert files.ply(np.zeros((3, 3)), np.array([[0, 1, 2]])).startswith(b"ply\n")
    assert files.precomputed_info((100, 60, 7), (8, 8, 40), 3)["scales"][2]["size"] == [25, 15, 2]
    target = tmp_path / "x"
    with pytest.raises(RuntimeError):
        files.atomic_write(str(target), lambda p: (_ for _ in ()).throw(RuntimeError()))
    assert os.listdir(tmp_path) == []
    files.atomic_write(str(target), lambda p: open(p, "w").write("ok"))
    assert target.read_text() == "ok"


def test_config_and_chain(tmp_path):
    (tmp_path / "a.yml").write_text("x: {p: 1, q: 2}\n")
    (tmp_path / "b.yml").write_text("base: a.yml\nx: {q: 3}\n")
    c = o.load_config(str(tmp_path / "b.yml"), {"x": {"p": 0, "r": 9}, "y": 1}, {"x.s.t": 5})
    assert c == {"x": {"p": 1, "q": 3, "r": 9, "s": {"t": 5}}, "y": 1} and o.look_up(c, "x.s.t") == 5
    (tmp_path / "a.yml").write_text("base: b.yml\n")
    with pytest.raises(ValueError):
        o.load_config(str(tmp_path / "b.yml"), {})
    ran = []
    chain = o.Chain(str(tmp_path / "state.json"))
    for name, after in (("check", []), ("stats", ["check"]), ("levels", ["stats"])):
        chain.step(name, after)(lambda c, n=name: ran.append(n))
    assert chain.run({"stats": 1}) == ["check", "stats", "levels"] == ran
    assert chain.run({"stats": 1}) == []
    assert chain.run({"stats": 2}, dry=True) == ["stats", "levels"]
    assert chain.run({"stats": 1}, only=["stats"]) == ["stats"]
    assert json.loads((tmp_path / "state.json").read_text()).keys() == {"check", "stats", "levels"}


def test_streams_equal_batches(spark, tmp_path):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet").selectExpr("CAST(ts AS timestamp) AS ts", "event_type", "value", "event_id")
    src = str(tmp_path / "in")
    ev.repartition(3).write.parquet(src)
    stream = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).parquet(src)

    def finished(df, name, mode):
        q = df.writeStream.format("memory").queryName(name).outputMode(mode).start()
        q.processAllAvailable()
        q.stop()
        return sorted(map(str, spark.table(name).collect()))

    stats = lambda d: timeline.tile_statistics(d, "ts", ["event_type"], "value", "1 day", "400 days").selectExpr("event_type", "start", "round(mean, 6) AS mean", "n")
    assert finished(stats(stream), "st", "complete") == sorted(map(str, stats(ev).collect()))
    s = lambda d: timeline.sessions(d, "ts", ["event_type"], "3 hours", "400 days")
    assert finished(s(stream), "se", "complete") == sorted(map(str, s(ev).collect()))
    assert timeline.complete_groups(ev, "ts", ["event_type"], "event_id", "3 hours").count() > 0


def test_slabs_grow(spark, tmp_path):
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(str(tmp_path / "cp"))
    src, out = str(tmp_path / "z"), str(tmp_path / "slabs")
    for lo in (0, 10):
        spark.range(lo, lo + 12, numPartitions=1).selectExpr("id AS z", f"{lo} AS v").write.mode("append").parquet(src)
        time.sleep(0.01)
        q = timeline.append_slabs(spark.readStream.schema("z long, v int").parquet(src), out, 8, checkpoint=str(tmp_path / "c"))
        q.processAllAvailable()
        q.stop()
    rows = {r.z: r.v for r in spark.read.parquet(out).collect()}
    assert rows == {z: 10 if z >= 10 else 0 for z in range(22)}


def test_layers_options_resources_and_frozen_plans(tmp_path):
    import pytest

    a = {"x": {"p": 1, "q": {"r": 2}}, "y": 3, "e": {}}
    assert o.nested(o.leaves(a)) == a
    assert o.nested(o.layered(o.leaves(a), o.leaves({"x": {"q": 5, "p": {"k": 1}}, "y": {"z": 4}, "e": {}}))) == {"x": {"q": 5, "p": {"k": 1}}, "y": {"z": 4}, "e": {}}
    assert o.nested(o.layered(o.leaves(a), o.leaves({"x": {}}))) == a
    assert o.look_up(a, "x.q") == {"r": 2} and o.look_up(a, "x.q.r") == 2 and o.look_up(a, "x.no", 7) == 7
    with pytest.raises(ValueError, match="model must be one of.*side must"):
        o.check_options({"model": "z", "side": 1, "other": 2}, {"model": ("a", "b"), "side": ("l", "r"), "unset": (1,)})
    o.check_options({"model": "a"}, {"model": ("a", "b")})
    ok = {"median": 120, "contrast": 2, "per": "slice", "brightness": "tissue", "breaks": [9, 3, 9]}
    assert o.reference_settings(ok)["breaks"] == [3, 9]
    for wrong in ({"median": 255}, {"median": None}, {"contrast": 0}, {"per": "tile"}):
        with pytest.raises(ValueError):
            o.reference_settings(ok | wrong)
    assert o.percentile_column(0.5, ["p0_5"]) == "p0_5" and o.percentile_column(5, ["t_p5"], tissue=True) == "t_p5"
    with pytest.raises(ValueError):
        o.percentile_column(0.7, ["p0_5"])
    c = {"resources": {"align": {"cores": 8, "memory": "16g", "timeout": "600s"}, "render": {"timeout": 14400}, "check": {"nodes": 1}}}
    jobs = ("align", "render", "check", "export")
    assert o.resources(c, "align", jobs) == {"spark.executor.cores": "8", "spark.executor.memory": "16g", "spark.network.timeout": "600s"}
    assert o.resources(c, "export", jobs) == {}
    for job in ("render", "check", "none"):
        with pytest.raises(ValueError):
            o.resources(c, job, jobs)
    at = str(tmp_path / "plan.json")
    assert [o.frozen(at, {"a": 1}, "d"), o.frozen(at, {"a": 1}, "d")] == ["made", "kept"]
    with pytest.raises(ValueError):
        o.frozen(at, {"a": 2}, "d")
    assert [o.frozen(at, {"a": 2}, "d", overwrite=True), o.frozen(at, {"a": 2}, "d")] == ["made", "kept"]


def test_chunks_come_back(spark, tmp_path):
    rows = [(k, i, [float(k), i / 2]) for k in range(3) for i in range(4)]
    df = spark.createDataFrame(rows, "k long, i long, v array<double>")
    done = files.write_chunks(df, str(tmp_path), "k", ["k", "i", "v"]).collect()
    assert sorted((x.k, x.n) for x in done) == [(0, 4), (1, 4), (2, 4)]
    assert sorted(files.local_files(str(tmp_path))) == ["0.npz", "1.npz", "2.npz"]
    back = files.read_chunks(spark, str(tmp_path), "k long, i long, v array<double>")
    assert sorted((x.k, x.i, list(x.v)) for x in back.collect()) == rows


def test_copy_ends(tmp_path):
    (tmp_path / "a/b").mkdir(parents=True)
    a = str(tmp_path / "a")
    assert files.copy_ends(a, str(tmp_path / "c"))[1] == tmp_path / "c"
    for x, y in ((a, a), (a, f"{a}/b"), (f"{a}/b", a), (f"{a}/none", f"{a}/c")):
        with pytest.raises(ValueError):
            files.copy_ends(x, y)


def test_single_plane_has_no_old_corrections():
    old = {"canvas_size_xy": [101, 60], "settings": {"downsample": 1, "clahe": True}, "patchgrid": "x", "shading": "y", "z": 3}
    new = o.single_plane(old, 4, {"shading": "n", "patchgrid": None}, clahe=False)
    assert new == {"canvas_size_xy": [101, 60], "downsample": 4, "shape": [1, 15, 26], "settings": {"downsample": 4, "clahe": False}, "shading": "n", "z": 3}
    assert old["settings"]["clahe"]
