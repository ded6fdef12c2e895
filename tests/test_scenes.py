import itertools
import json
import struct

import duckdb
import numpy as np
import pytest

from posegrid import plans
from posegrid.operators import export, groups, models
from posegrid.operators import queries as operator_queries
from posegrid.sources import files
from posegrid.streaming import tracks

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages conversations".split()
CHECKED = (
    "q08_inter_object_distance j10_triplets j09_object_region_across j22_rle_iou a05_mad_trim a15_rle_area_bbox m05_relative_euler "
    "q04_rotation q13_proxy_direction q15_relpos w16_keepalive x02_slug d01_filter_repeats t02_hotstart_batch"
).split()


@pytest.mark.parametrize("name", CHECKED)
def test_plan_and_twin_agree(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    twin = con.sql(plans.oracle_sql()[name])
    want = sorted(str([dict(zip(twin.columns, r))[c] for c in sorted(twin.columns)]) for r in twin.fetchall())
    got = plans.queries()[name](spark, SF)
    assert sorted(str([r[c] for c in sorted(got.columns)]) for r in got.collect()) == want and want


def test_every_plan_has_a_twin():
    assert set(plans.queries()) == set(plans.oracle_sql()) and len(plans.queries()) > 150


def test_plans_need_no_cross_product(spark):
    for name in ("q08_inter_object_distance", "j10_triplets", "j22_rle_iou"):
        text = plans.queries()[name](spark, SF)._jdf.queryExecution().toString()
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_triples_are_drawn_from_all_instances_of_a_pair(spark):
    held = {}
    for r in operator_queries._sql(spark, SF, "select * from in_either").collect():
        held.setdefault((r.scene_id, r.frame_a, r.frame_b), []).append(r)
    want = {}
    for key, rows in held.items():
        some = lambda t: len({r.label for r in t}) == 3 and not all(r.in_a for r in t) and not all(r.in_b for r in t)
        valid = {frozenset(r.ins_id for r in t) for t in itertools.combinations(rows, 3) if some(t)}
        if valid:
            want[key] = valid
    got = {}
    for r in plans.queries()["j10_triplets"](spark, SF).collect():
        got.setdefault((r.scene_id, r.frame_a, r.frame_b), []).append(frozenset((r.ins_a, r.ins_b, r.ins_c)))
    assert {k: len(v) for k, v in got.items()} == {k: min(10, len(v)) for k, v in want.items()}
    assert all(set(v) <= want[k] and len(set(v)) == len(v) for k, v in got.items())
    assert any(r.pos > 12 for k, v in got.items() for t in v for r in held[k] if r.ins_id in t)


def test_mask_overlaps_of_all_pairs_of_a_label(spark):
    masks = {}
    for r in operator_queries._sql(spark, SF, "select vec_id, label, counts from rle").collect():
        pixels = np.repeat(np.arange(len(r.counts)) % 2 == 1, r.counts)
        if pixels.any():
            masks.setdefault(r.label, []).append((r.vec_id, set(np.flatnonzero(pixels).tolist())))
    want = {
        (i, j): (len(x & y), len(x | y)) for held in masks.values() for (i, x), (j, y) in itertools.combinations(sorted(held, key=lambda m: m[0]), 2)
    }
    assert {(r.a, r.b): (r.inter, r.uni) for r in plans.queries()["j22_rle_iou"](spark, SF).collect()} == want
    assert any(j - i > 30 for i, j in want)


def test_cameras_meet_all_instances_of_their_scene(spark):
    instances, held = {}, plans.queries()
    for r in operator_queries._sql(spark, SF, "select scene_id, ins_id from instances").collect():
        instances.setdefault(r.scene_id, set()).add(r.ins_id)
    cams = operator_queries._sql(spark, SF, "select scene_id, frame_idx from cams").collect()
    want = {(*c, i) for c in cams for i in instances.get(c.scene_id, ())}
    for name in ("m02_world_to_cam", "m03_project", "m17_axis_words"):
        assert {(r.scene_id, r.frame_idx, r.ins_id) for r in held[name](spark, SF).collect()} == want
    pairs = operator_queries._sql(spark, SF, "select scene_id, frame_a, frame_b from cam_covis where cov > 0.25e0").collect()
    seen = {}
    for r in operator_queries._sql(spark, SF, "select scene_id, frame_idx, ins_id from observations").collect():
        seen.setdefault((r.scene_id, r.frame_idx), set()).add(r.ins_id)
    want = {(*p, i) for p in pairs for i in seen.get((p.scene_id, p.frame_a), set()) & seen.get((p.scene_id, p.frame_b), set())}
    for name in ("q05_center_distance", "q06_center_direction", "q07_orient"):
        assert {(r.scene_id, r.frame_a, r.frame_b, r.ins_id) for r in held[name](spark, SF).collect()} == want


def test_relative_rotation_of_a_quarter_turn(spark):
    from posegrid.plans.geometry import relative

    a = {f"r{i}{j}": float(i == j) for i in range(3) for j in range(3)}
    b = {**a, "r00": 0.0, "r02": 1.0, "r20": -1.0, "r22": 0.0}
    scope = {"a": type("C", (), a), "b": type("C", (), b)}
    entry = lambda i, j: eval(relative(i, j), scope)  # noqa: E731, S307
    assert np.degrees(np.arctan2(entry(0, 2), entry(2, 2))) == pytest.approx(90)


def test_group_results_do_not_depend_on_partitions(spark):
    rows = operator_queries._sql(spark, SF, operator_queries._BOXES)
    for op in (groups.suppress, groups.assign_tracks):
        assert sorted(op(rows.repartition(1)).collect()) == sorted(op(rows.repartition(9)).collect())
    pairs = operator_queries._sql(spark, SF, "select scene_id, frame_a, frame_b, cov from pairs")
    a, b = (sorted(groups.sample_pairs(pairs.repartition(n), most=20).collect()) for n in (1, 7))
    assert a == b and max(np.unique([r.scene_id for r in a], return_counts=True)[1]) <= 20


def test_dense_ids_and_records(spark, tmp_path):
    made = operator_queries.k02_training_records(spark, SF)
    ids = sorted(r.id for r in made.collect())
    assert ids == list(range(len(ids))) and ids
    qa = spark.createDataFrame([("s", 1, ["a", "b"], "Q?", "x", "t", "u")], "scene_id string, pos int, images array<string>, question string, answer string, question_type string, sub_question_type string")
    export.write_jsonl(export.training_records(qa), str(tmp_path / "out"))
    line = json.loads(spark.read.text(str(tmp_path / "out")).first().value)
    assert line["conversations"][0]["value"] == "<image>\n<image>\nQ?" and line["id"] == 0


def test_resumable_write(spark, tmp_path):
    path = str(tmp_path / "scenes")
    export.write_scenes(spark.createDataFrame([(1, "a"), (2, "b")], "scene_id long, v string"), path)
    export.write_scenes(spark.createDataFrame([(2, "again"), (3, "c")], "scene_id long, v string"), path)
    assert sorted(tuple(r) for r in spark.read.parquet(path).select("scene_id", "v").collect()) == [(1, "a"), (2, "b"), (3, "c")]


def test_model_is_asked_once_a_key(spark):
    rows = spark.createDataFrame([("k", "long enough description"), ("k", "long enough description"), ("k", "short")], "key string, description string")
    got = models.decide(rows, ["key", "description"], models.longest_wins).groupBy("decision").count().collect()
    assert {r.decision: r["count"] for r in got} == {"KEEP": 2, "DROP": 1}


def test_stream_equals_batch(spark, tmp_path):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    rows = operator_queries._sql(spark, SF, "select obj_id, frame_idx, matched from track_events where obj_id < 6")
    rows.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = tracks.track(spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in")))
    query = stream.writeStream.format("memory").queryName("tracked").outputMode("append").option(
        "checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
    query.awaitTermination(240)
    assert sorted(spark.table("tracked").collect()) == sorted(tracks.track(rows).collect())


def test_track_states_match_the_window_plans(spark):
    states = operator_queries.t01_track_states(spark, SF)
    ends = {r.obj_id: r.alive for r in states.groupBy("obj_id").agg({"frame_idx": "max"}).join(states, "obj_id").where("frame_idx = `max(frame_idx)`").collect()}
    assert ends == {r.obj_id: r.value for r in plans.queries()["w16_keepalive"](spark, SF).collect()}
    removed = {r.obj_id: r.f for r in states.where("removed").selectExpr("obj_id", "frame_idx").groupBy("obj_id").agg({"frame_idx": "min"}).toDF("obj_id", "f").collect()}
    assert removed == {r.obj_id: r.removed_at for r in plans.queries()["t02_hotstart_batch"](spark, SF).collect()}


def test_camera_and_instance_files(spark, tmp_path):
    pose = [[float(4 * i + j + 1) for j in range(4)] for i in range(4)]
    held = {"fl_x": 1.0, "fl_y": 1.0, "cx": 0.5, "cy": 0.5, "w": 4, "h": 3, "frames": [{"file_path": "b.jpg", "transform_matrix": pose}],
            "test_frames": [{"file_path": "a.jpg", "transform_matrix": pose, "is_bad": True}]}
    (tmp_path / "t.json").write_text(json.dumps(held))
    got = files.camera_json(spark, str(tmp_path / "t.json")).orderBy("frame_idx").collect()
    assert [(r.stem, r.is_bad) for r in got] == [("a", True), ("b", False)] and got[0].c2w[:4] == [1, -2, -3, 4] and got[0].c2w[12:] == pose[3]
    (tmp_path / "poses").mkdir()
    (tmp_path / "poses" / "1.txt").write_text("\n".join(" ".join(map(str, r)) for r in pose))
    (tmp_path / "poses" / "2.txt").write_text("1 2 inf")
    assert [r.stem for r in files.pose_text(spark, str(tmp_path / "poses")).collect()] == ["1"]
    (tmp_path / "i.json").write_text(json.dumps({"objects": [{"ins_id": "7", "label": "x"}]}))
    (tmp_path / "j.json").write_text(json.dumps([{"ins_id": "8", "label": "y"}]))
    assert sorted(r.ins_id for r in files.instance_json(spark, str(tmp_path / "[ij].json")).collect()) == ["7", "8"]


def test_binary_files(spark, tmp_path):
    np.save(tmp_path / "c.npy", np.arange(6.0).reshape(2, 3))
    assert files.decoded(spark, str(tmp_path / "c.npy"), files.read_npy, files.NPY).where("i = 1 and j = 2").first().value == 5
    np.savez(tmp_path / "frame_1.npz", intrinsic=np.eye(3), pose=np.eye(4))
    assert len(files.decoded(spark, str(tmp_path / "frame_1.npz"), files.read_camera_npz, files.CAMERA_NPZ).first().pose) == 16
    (tmp_path / "p.ply").write_bytes(files.write_ply(np.array([[1.0, 2, 3]]), np.array([[9, 8, 7]])))
    assert files.decoded(spark, str(tmp_path / "p.ply"), files.read_ply, files.PLY).first().properties == {"x": 1, "y": 2, "z": 3, "red": 9, "green": 8, "blue": 7}
    image = struct.pack("<Qi7di", 1, 5, *range(7), 3) + b"n.jpg\0" + struct.pack("<Q", 1) + bytes(24)
    assert files.read_sparse_images(image).iloc[0].tolist()[:3] == [5, 3, "n.jpg"]
    point = struct.pack("<QQ3d3BdQ", 1, 4, 1.0, 2.0, 3.0, 1, 2, 3, 0.5, 2) + bytes(16)
    assert files.read_sparse_points(point).iloc[0].n_track == 2
    camera = struct.pack("<Q2i2Q4d", 1, 2, 1, 640, 480, 1.0, 2.0, 3.0, 4.0)
    assert files.read_sparse_cameras(camera).iloc[0].params == [1, 2, 3, 4]


def test_mask_stats_agree_with_run_arithmetic(spark):
    got = {r.mask_id: r for r in operator_queries.a16_mask_components(spark, SF).collect()}
    want = {r.vec_id: r.area for r in plans.queries()["a15_rle_area_bbox"](spark, SF).collect()}
    assert all(got[i].area == a and got[i].largest <= a and got[i].area_eroded <= a for i, a in want.items()) and len(got) >= len(want)
    assert groups.erode(np.ones((5, 6), dtype=bool), 1).sum() == 12


def test_boxes_of_groups(spark):
    boxes = operator_queries.a09_fit_boxes(spark, SF).collect()
    assert boxes and all(b.n >= 3 and min(b.ex, b.ey, b.ez) >= 0 for b in boxes)
