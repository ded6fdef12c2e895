"""Templates and geometry against plain numpy, worked out apart from the SQL."""

import math

import numpy as np
import pandas as pd
import pytest

from posegrid.functions.dialect import Spark
from posegrid.operators import groups, models
from posegrid.plans import run
from posegrid.plans.registry import render

SF = "/root/testdata/sf0.001"
EGO = ["front", "front-right", "right", "back-right", "back", "back-left", "left", "front-left"]


@pytest.fixture(scope="module")
def boxes(spark):
    rows = spark.sql(render("select * from instances", Spark(SF))).toPandas()
    return {r.ins_id: r for r in rows.itertuples(index=False)}


def center(b):
    return np.array([b.cx, b.cy, b.cz], dtype=float)


def touch(a, b):
    return all(abs(p - q) <= (s + t) / 2 for p, q, s, t in zip(center(a), center(b), (a.ex, a.ey, a.ez), (b.ex, b.ey, b.ez)))


def frame(a, b):
    """Forward, right and up of one who stands at a and faces b."""
    f = (b - a) / np.linalg.norm(b - a)
    up = np.array([1.0, 0, 0]) if abs(f[2]) > 0.99 else np.array([0, 0, -1.0])
    r = np.cross(f, up)
    r /= np.linalg.norm(r)
    return f, r, np.cross(r, f)


def where(a, b, c):
    f, r, u = frame(a, b)
    v = c - a
    x, y, z = v @ r, v @ u, v @ f
    flat = math.hypot(x, z)
    if flat < 1e-6 or abs(y) >= 1.2 * flat:
        return None, None
    turn = math.degrees(math.atan2(x, z))
    return int(np.round(round(turn, 9) / 45)) % 8, turn


@pytest.mark.parametrize(("name", "source"), [("q15_relpos", "triplets"), ("q16_region_relpos", "two_and_region_a")])
def test_relative_position(spark, boxes, name, source):
    got = {tuple(r[c] for c in ("scene_id", "frame_a", "frame_b", "ins_a", "ins_b", "ins_c")): r for r in run(name)(spark, SF).collect()}
    region = source != "triplets"
    triples = spark.sql(render(f"select scene_id, frame_a, frame_b, ins_id_a, ins_id_b, ins_id_c from {source}", Spark(SF))).collect()
    want = {}
    for key in map(tuple, triples):
        a, b, c = (boxes[i] for i in key[3:])
        if region:
            c = c._replace(ex=c.ex * 8, ey=c.ey * 8, ez=c.ez * 8)
        if touch(a, b) or touch(a, c) or touch(b, c) or np.linalg.norm(center(b) - center(a)) < 1e-6:
            continue
        idx, turn = where(center(a), center(b), center(c))
        if idx is not None:
            want[key] = idx, turn
    assert got.keys() == want.keys()
    for key, (idx, turn) in want.items():
        row = got[key]
        options = row["options"].split("/")
        assert row["label"] == EGO[idx] and len(set(options)) == 4 and set(options) <= set(EGO)
        assert options["ABCD".index(row["answer"])] == EGO[idx]
        off = (turn - 45 * idx + 180) % 360 - 180
        if abs(off) >= 19.501:
            assert EGO[(idx + (1 if off > 0 else -1)) % 8] not in options


def test_the_local_frame_near_the_vertical():
    f, r, u = frame(np.zeros(3), np.array([0.01, 0.02, 1.0]))
    assert abs(f @ r) < 1e-9 and abs(f @ u) < 1e-9 and abs(u @ r) < 1e-9 and abs(r[0]) < 1e-12


def test_motion_options(spark):
    turned = {"forward": "backward", "left": "right", "up": "down"}
    turned |= {v: k for k, v in turned.items()}
    rows = run("q01_main_dir")(spark, SF).collect()
    assert rows
    for r in rows:
        words, options = r["label"].split("-"), r["options"].split("/")
        assert options["ABCD".index(r["answer"])] == r["label"] and len(set(options)) == 4
        wrong = set(options) - {r["label"]}
        if len(words) == 2:
            a, b = words
            assert wrong == {f"{a}-{turned[b]}", f"{turned[a]}-{b}", f"{turned[a]}-{turned[b]}"}
        elif len(words) == 3:
            a, b, c = words
            assert wrong == {f"{a}-{b}", f"{a}-{c}", f"{b}-{c}"}
        else:
            assert turned[words[0]] in wrong and all("-" not in w for w in wrong)


def test_drawn_pairs_are_valid_and_as_many_as_there_are(spark, boxes):
    seen = spark.sql(render("select scene_id, frame_idx, ins_id from observations", Spark(SF))).toPandas()
    held = seen.groupby(["scene_id", "frame_idx"])["ins_id"].apply(list).to_dict()
    pairs = {tuple(r) for r in spark.sql(render("select scene_id, frame_a, frame_b from pairs", Spark(SF))).collect()}
    got = {}
    for r in run("j07_object_pairs_across")(spark, SF).collect():
        got.setdefault((r.scene_id, r.frame_a, r.frame_b), set()).add((r.ins_a, r.ins_b))
    for key in pairs:
        s, fa, fb = key
        every = {(a, b) for a in held[s, fa] for b in held[s, fb] if a != b and boxes[a].label != boxes[b].label}
        assert got.get(key, set()) <= every and len(got.get(key, set())) == min(3, len(every))


def test_common_objects_only(spark):
    seen = {tuple(r) for r in spark.sql(render("select scene_id, frame_idx, ins_id from observations", Spark(SF))).collect()}
    rows = run("q05_center_distance")(spark, "/root/testdata/sf0.001").collect()
    assert rows and all((r.scene_id, f, r.ins_id) in seen for r in rows for f in (r.frame_a, r.frame_b))


def test_containment_of_turned_boxes(spark, boxes):
    got = {(r.inner_id, r.outer_id) for r in run("j16_box_containment")(spark, SF).collect()}
    want = set()
    for a in boxes.values():
        for b in boxes.values():
            if a.scene_id != b.scene_id or a.ins_id == b.ins_id or b.ins_id % 5:
                continue
            t, u = math.radians(a.yaw_deg), math.radians(b.yaw_deg)
            turn = lambda w: np.array([[math.cos(w), -math.sin(w), 0], [math.sin(w), math.cos(w), 0], [0, 0, 1]])
            corners = [center(a) + turn(t) @ (np.array([i, j, k]) * (a.ex, a.ey, a.ez) / 2) for i in (-1, 1) for j in (-1, 1) for k in (-1, 1)]
            local = [turn(u).T @ (p - center(b)) for p in corners]
            if all((np.abs(p) <= np.array([b.ex, b.ey, b.ez]) * 4 + 1e-6).all() for p in local):
                want.add((a.ins_id, b.ins_id))
    assert got == want and got


def test_oriented_overlap_of_equal_and_turned_boxes(spark):
    names = [f"{f}_{s}" for s in "ab" for f in ("cx", "cy", "cz", "ex", "ey", "ez", "yaw_deg")]
    rows = [(1, 2, 0, 0, 0, 2, 2, 2, 0, 0, 0, 0, 2, 2, 2, 0), (1, 3, 0, 0, 0, 2, 2, 2, 0, 1, 0, 0, 2, 2, 2, 0),
            (1, 4, 0, 0, 0, 2, 2, 2, 0, 0, 0, 0, 2, 2, 2, 45), (1, 5, 0, 0, 0, 2, 2, 2, 0, 9, 0, 0, 2, 2, 2, 45)]
    df = spark.createDataFrame([(r[0], r[1], *map(float, r[2:])) for r in rows], ["a", "b", *names])
    got = {r.b: r.ratio for r in groups.oriented_overlaps(df, least=0.0001).collect()}
    assert got.keys() == {2, 3, 4} and got[2] == pytest.approx(1) and got[3] == pytest.approx(0.5)
    assert got[4] == pytest.approx(2 * math.sqrt(2) - 2, abs=1e-6)


def test_least_loaded_slots(spark):
    rows = [(g, i, float(5 if i == 0 else 1)) for g in (1, 2) for i in range(12)]
    got = groups.least_loaded(spark.createDataFrame(rows, "group_id long, item_id long, load double"), slots=3).toPandas()
    for _, part in got.sort_values("item_id").groupby("group_id"):
        assert part["slot"].tolist() == [0, 1, 2, 1, 2, 1, 2, 1, 2, 1, 2, 0]


def test_groups_that_span_batches(spark):
    rows = spark.createDataFrame([(k // 700, k) for k in range(7000)], "g long, v long")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    total = lambda x: pd.DataFrame({"g": [x["g"].iloc[0]], "n": [len(x)], "first": [x["v"].iloc[0]]})
    got = sorted(map(tuple, groups.by_group(rows, "g", "v", total, "g long, n long, first long").collect()))
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == [(g, 700, 700 * g) for g in range(10)]


def test_null_keys_get_a_decision(spark):
    rows = spark.createDataFrame([(None, "a long enough description"), ("k", "short"), (None, "a long enough description")], "k string, description string")
    got = sorted(str((r.k, r.decision)) for r in models.decide(rows, ["k", "description"], models.longest_wins).collect())
    assert got == ["('k', 'DROP')", "(None, 'KEEP')", "(None, 'KEEP')"]
