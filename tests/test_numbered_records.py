"""Records numbered by scene: the ids of one global order, and no shuffle of records."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from posegrid import plans
from posegrid.functions import scenes
from posegrid.functions.dialect import Spark
from posegrid.operators import export, queries
from posegrid.plans.registry import query, render

SF = "/root/testdata/sf0.001"


def test_records_are_not_shuffled_and_ids_follow_the_order(spark):
    made = queries.k02_training_records(spark, SF)
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert plan[: plan.index("RepartitionByExpression")].count("MapInArrow") == 1  # records come after the last shuffle
    rows = query(spark, render("select scene_id, frame_a, frame_b, draw, label_a from objects_across", Spark(SF))).orderBy("scene_id", "frame_a", "frame_b", "draw").collect()
    got = made.orderBy("id").collect()
    assert [r.id for r in got] == list(range(len(rows)))
    for r, want in zip(got, rows):
        assert r.scene_id == want.scene_id and f'"image":["f{want.frame_a}","f{want.frame_b}"]' in r.record and f"indicates {want.label_a}." in r.record


def test_first_ids_are_sums_before(spark):
    sizes = spark.range(1000).select((F.col("id") * 7 % 1009).alias("k"), (F.col("id") % 5).alias("n"))
    before = 0
    want = {k: n for k, n in sizes.collect()}
    for k, first in sorted(map(tuple, export.first_ids(sizes, "k").collect())):
        assert first == before
        before += want[k]


@pytest.mark.parametrize("cells", [1, 300, 1 << 15])
def test_couples_whatever_the_blocks(monkeypatch, cells):
    rng = np.random.default_rng(3)
    ids, frames = np.arange(14), np.arange(9)
    scene = scenes.Scene(5, frames, ids, rng.random((9, 14)) < 0.6, np.ones(14, bool), rng.integers(0, 5, 14), np.zeros((14, 7)), None, np.ones(14, bool))
    a, b, _ = scene.pairs()
    want = scenes.couples(scene, a, b, "j07", scene.known, scene.known, most=4)  # by a partition of the keys
    keep = want[1] <= 3
    monkeypatch.setattr(scenes, "CACHED", cells)
    got = scenes.couples(scene, a, b, "j07", scene.known, scene.known)
    assert all((x == y[keep]).all() for x, y in zip((got[0], got[1], *got[2]), (want[0], want[1], *want[2])))
    assert scenes.count_couples(scene, a, b, scene.known, scene.known) == len(got[0]) > 20


def test_pairs_are_counted_without_draws(spark, monkeypatch):
    text = "select scene_id, frame_a, frame_b, count(*), max(draw) from objects_across group by 1, 2, 3"
    want = sorted(map(tuple, query(spark, render(text, Spark(SF))).collect()))
    made = plans.run("w09_cap_per_pair")(spark, SF)
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, made.collect())) == want and len(want) > 300
    assert plan.count("Exchange") == 1 and "HashAggregate" not in plan


def test_only_couples_that_fit_are_drawn(monkeypatch):
    drawn = []
    reduced = scenes._reduced
    monkeypatch.setattr(scenes, "_reduced", lambda x: drawn.append(x.size) or reduced(x))
    shown = np.eye(18, 20, 2, dtype=bool) | (np.arange(20) < 2)  # three of twenty a frame
    scene = scenes.Scene(5, np.arange(18), np.arange(20), shown, np.ones(20, bool), np.arange(20), np.zeros((20, 7)), None, np.ones(20, bool))
    a, b, _ = scene.pairs()
    assert len(scenes.couples(scene, a, b, "j07", scene.known, scene.known)[0]) == 3 * len(a) > 0
    assert sum(drawn) < 60 * len(a)
