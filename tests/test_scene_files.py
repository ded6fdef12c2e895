"""The data source and sink of scene files, against the tables' SQL twins, and
their rules: what a dead or repeated task leaves, lawful states, pushed filters."""

import json
import os
import struct

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from posegrid.operators import file_queries, scene_sink
from posegrid.sources import scene_files

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages conversations".split()


def comparable(columns, rows):
    plain = lambda v: float(f"{v:.9g}") if isinstance(v, float) else v
    return sorted(str([plain(dict(zip(columns, r))[c]) for c in sorted(columns)]) for r in rows)


@pytest.mark.parametrize("name", list(file_queries.QUERIES))
def test_files_hold_the_tables(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    twin = con.sql(file_queries.oracle_sql()[name])
    want = comparable(twin.columns, twin.fetchall())
    got = file_queries.QUERIES[name](spark, SF)
    assert comparable(got.columns, got.collect()) == want and len(want) > 3


def put(root, name, content):
    path = os.path.join(root, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as sink:
        sink.write(content)


def load(spark, root, layout, **options):
    scene_files.register(spark)
    return spark.read.format("scene_files").options(layout=layout, **options).load(str(root))


def test_reconstruction_in_both_encodings(spark, tmp_path):
    images = struct.pack("<Q", 2)
    for k, name in ((5, b"a b.png"), (6, b"c.png")):
        images += struct.pack("<i7di", k, 1, 0, 0, 0, 0.5, 1.5, 2.5, 9) + name + b"\0" + struct.pack("<Q", 1) + struct.pack("<ddq", 1, 2, 3)
    cameras = struct.pack("<Q", 1) + struct.pack("<2i2Q4d", 9, 1, 640, 480, 500, 501, 320, 240)
    put(tmp_path, "bin/sparse/0/images.bin", images)
    put(tmp_path, "bin/sparse/0/cameras.bin", cameras)
    put(tmp_path, "txt/sparse/0/images.txt", b"# head\n5 1 0 0 0 0.5 1.5 2.5 9 a b.png\n1 2 3\n6 1 0 0 0 0.5 1.5 2.5 9 c.png\n\n")
    put(tmp_path, "txt/sparse/0/cameras.txt", b"# head\n9 PINHOLE 640 480 500 501 320 240\n")
    got = load(spark, tmp_path, "sparse_images").orderBy("scene", "image_id").collect()
    assert [(r.scene, r.encoding, r.image_id, r.camera_id, r.name, r.qvec, r.tvec, r.n_points) for r in got] == [
        (scene, kind, k, 9, name, [1, 0, 0, 0], [0.5, 1.5, 2.5], n)
        for scene, kind, last in (("bin", "binary", 1), ("txt", "text", 0))
        for k, name, n in ((5, "a b.png", 1), (6, "c.png", last))
    ]
    got = load(spark, tmp_path, "sparse_cameras").collect()
    assert {(r.encoding, r.model, r.width, r.height, *r.params) for r in got} == {
        (k, "PINHOLE", 640, 480, 500, 501, 320, 240) for k in ("binary", "text")
    }


def test_files_not_asked_for_stay_shut(spark, tmp_path):
    """A file that is not asked for is not opened: these would fail."""
    for k in range(6):
        put(tmp_path, f"s{k % 2}/depth/f{k}.npy", file_queries.npy(np.ones((2, 3))) if k in (0, 2) else b"broken")
    some = load(spark, tmp_path, "depth", folders="depth", scenes="s0", stems="f0,f2,f5")
    assert [(r.stem, r.depth) for r in some.orderBy("stem").collect()] == [("f0", [1.0] * 6), ("f2", [1.0] * 6)]
    rows = load(spark, tmp_path, "depth", folders="depth", stems="f0,f2")
    assert rows.where("stem = 'f0'").count() == 1 and rows.count() == 2  # a filtered scan leaves the next one whole
    with pytest.raises(Exception):
        load(spark, tmp_path, "depth", folders="depth").collect()


def test_partitions_hold_files_by_size(spark, tmp_path):
    for k in range(10):
        put(tmp_path, f"s/depth/{k}.npy", file_queries.npy(np.full((3, 3), k)))
    rows = load(spark, tmp_path, "depth", folders="depth", bytes="200000")
    assert 2 <= rows.rdd.getNumPartitions() <= 5 and rows.count() == 10
    assert load(spark, tmp_path, "ply").count() == 0


def test_vertices_of_every_encoding(spark, tmp_path):
    x = np.arange(70_000, dtype=float)
    for k, kind in enumerate(("binary_little_endian", "binary_big_endian", "ascii")):
        columns = {"x": x, "y": -x, "z": x / 2} | ({"red": x % 250, "green": x % 7, "blue": x % 9} if k else {})
        put(tmp_path, f"s{k}/p.ply", file_queries.ply(columns | {"opacity": x + 1}, kind))
    got = load(spark, tmp_path, "ply", properties="opacity,absent").groupBy("scene").agg(
        {"k": "max", "z": "sum", "red": "sum", "opacity": "sum", "absent": "count"}
    )
    red = int((x % 250).sum())
    want = {f"s{k}": (69_999, x.sum() / 2, red if k else None, x.sum() + len(x), 0) for k in range(3)}
    assert {r.scene: (r["max(k)"], r["sum(z)"], r["sum(red)"], r["sum(opacity)"], r["count(absent)"]) for r in got.collect()} == want


# -- the sink


def lists(spark, rows, path, **settings):
    scene_sink.write_lists(spark.createDataFrame(rows, "scene string, record string, pos long"), str(path), "pos", **settings)
    return {n: json.loads((path / n).read_text()) for n in sorted(os.listdir(path))}


def test_lists_are_whole_ordered_and_unescaped(spark, tmp_path):
    rows = [("a", json.dumps({"t": f"é{k}"}, ensure_ascii=False), k) for k in range(500)] + [("b", '{"t": 1}', 0), ("c", None, None)]
    got = lists(spark, rows, tmp_path / "out")
    assert got == {"a.json": [{"t": f"é{k}"} for k in range(500)], "b.json": [{"t": 1}], "c.json": []}
    assert "é7" in (tmp_path / "out" / "a.json").read_text(encoding="utf-8")


def test_lists_that_are_there_are_kept(spark, tmp_path):
    lists(spark, [("a", '{"t": 1}', 0)], tmp_path / "out")
    again = [("a", '{"t": 2}', 0), ("b", '{"t": 2}', 0)]
    assert lists(spark, again, tmp_path / "out") == {"a.json": [{"t": 1}], "b.json": [{"t": 2}]}
    assert lists(spark, again, tmp_path / "out", replace=True)["a.json"] == [{"t": 2}]


def batches(rows):
    return iter([pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=["scene", "record"])])


def test_a_dead_and_a_repeated_task_leave_one_whole_file(tmp_path):
    writer = scene_sink.ListWriter({"path": str(tmp_path)})

    def dies():
        yield from batches([("a", "1"), ("a", "2")])
        raise RuntimeError("the executor is lost")

    with pytest.raises(RuntimeError):
        writer.write(dies())
    first = writer.write(batches([("a", "1"), ("a", "2"), ("b", "3")]))
    writer.write(batches([("a", "1"), ("a", "2"), ("b", "3")]))  # a second attempt, whose result does not count
    writer.commit([first, None])
    assert {n: json.loads((tmp_path / n).read_text()) for n in sorted(os.listdir(tmp_path))} == {"a.json": [1, 2], "b.json": [3]}


def test_a_failed_job_leaves_nothing(tmp_path):
    writer = scene_sink.ListWriter({"path": str(tmp_path)})
    done = writer.write(batches([("a", "1")]))
    writer.abort([done, None])
    assert os.listdir(tmp_path) == []
    split = [writer.write(batches([("a", "1")])), writer.write(batches([("a", "2")]))]
    with pytest.raises(ValueError, match="two tasks"):
        writer.commit(split)
    assert os.listdir(tmp_path) == []


def test_a_job_whose_task_dies_leaves_nothing(spark, tmp_path):
    from pyspark.sql import functions as F

    rows = spark.range(2000).select((F.col("id") % 7).cast("string").alias("scene"), "id", F.expr("if(id = 1999, raise_error('lost'), '1')").cast("string").alias("record"))
    with pytest.raises(Exception, match="lost"):
        scene_sink.write_lists(rows, str(tmp_path / "out"), "id")
    assert not (tmp_path / "out").exists() or os.listdir(tmp_path / "out") == []


def scenes(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "scene string")


def states(log):
    return {r.scene: r.status for r in log.states().collect()}


def test_log_takes_lawful_steps_only(spark, tmp_path):
    log = scene_sink.RunLog(spark, str(tmp_path / "log"))
    assert states(log) == {}
    with pytest.raises(ValueError, match="from None to running"):
        log.move(scenes(spark, "a"), "running")
    log.move(scenes(spark, "a", "b"), "pending")
    log.move(scenes(spark, "a"), "running")
    with pytest.raises(ValueError, match="b cannot go from pending to completed"):
        log.move(scenes(spark, "a", "b"), "completed")
    assert states(log) == {"a": "running", "b": "pending"}
    log.move(scenes(spark, "a"), "completed")
    with pytest.raises(ValueError, match="from completed"):
        log.move(scenes(spark, "a"), "running")


def test_log_entries_that_meet(spark, tmp_path, monkeypatch):
    """Somebody commits between another's check and claim: that one checks again."""
    log, other = (scene_sink.RunLog(spark, str(tmp_path / "log")) for _ in range(2))
    log.move(scenes(spark, "a", "b"), "pending")
    claim, met = log._claim, []

    def late(path, entry):
        if not met:
            met.append(path)
            other.move(scenes(spark, "a"), "running")
        return claim(path, entry)

    monkeypatch.setattr(log, "_claim", late)
    log.move(scenes(spark, "b"), "running")
    assert states(log) == {"a": "running", "b": "running"} and len(log._commits()) == 3
    met.clear()
    monkeypatch.setattr(other, "move", lambda *_: scene_sink.RunLog(spark, str(tmp_path / "log")).move(scenes(spark, "a"), "completed"))
    with pytest.raises(ValueError, match="a cannot go from completed"):
        log.move(scenes(spark, "a"), "failed")


def test_failed_scenes_are_taken_again(spark, tmp_path):
    log, out = scene_sink.RunLog(spark, str(tmp_path / "log")), tmp_path / "out"
    work = lambda todo: todo.selectExpr("scene", "'1' AS record", "0L AS pos").where("scene <> 'c'")
    with pytest.raises(Exception, match="broke"):
        scene_sink.run_scenes(scenes(spark, "a", "b", "c"), lambda t: work(t).selectExpr("scene", "raise_error('broke') AS record", "pos"), str(out), log)
    assert set(states(log).values()) == {"failed"}
    scene_sink.run_scenes(scenes(spark, "a", "b"), work, str(out), log)
    scene_sink.run_scenes(scenes(spark, "a", "b", "c"), work, str(out), log)
    assert set(states(log).values()) == {"completed"}
    assert {n: json.loads((out / n).read_text()) for n in sorted(os.listdir(out))} == {"a.json": [1], "b.json": [1], "c.json": []}
