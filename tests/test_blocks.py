"""Camera pairs in blocks: the plans' own pairs, whatever the blocks' size."""

import pytest

from posegrid.functions import blocks
from posegrid.functions.dialect import Spark
from posegrid.plans.aggregates import j22_rle_iou
from posegrid.plans.filters import f05_motion
from posegrid.plans.geometry import cam_pairs
from posegrid.plans.registry import query, render, run

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("size", [7, 2048])
def test_pairs_of_blocks_are_all_pairs(spark, monkeypatch, size):
    monkeypatch.setattr(blocks, "BLOCK", size)
    monkeypatch.setattr(blocks, "ROWS", 5)
    for text in (cam_pairs, f05_motion):
        rows = [sorted(map(tuple, query(spark, render(text(d), d)).collect())) for d in (Spark(SF), Spark(SF, derives=False))]
        assert rows[0] == rows[1] and rows[0]


def test_only_named_poses_are_made(spark):
    cameras = blocks._cameras(spark, SF, True)
    made = blocks.block_pairs(cameras, blocks.close, "cov", "select a.tx, b.tz from t").schema.simpleString()
    assert "a:struct<tx:double>,b:struct<tz:double>" in made
    made = blocks.block_pairs(cameras, blocks.close, "cov", "select cov from t")
    assert made.columns == ["scene_id", "frame_a", "frame_b", "cov"] and made.count() > 0


def test_scenes_without_cameras_are_dropped_before_they_are_grouped(spark):
    plan = run("q06_center_direction")(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    lines = plan.splitlines()
    below = [lines[k + 1] for k, line in enumerate(lines) if "Aggregate [_groupingexpression" in line]
    assert len(below) == 3 and all("Join LeftSemi" in line for line in below)


@pytest.mark.parametrize("size", [7, 2048])
def test_pairs_of_masks_are_all_pairs(spark, monkeypatch, size):
    monkeypatch.setattr(blocks, "BLOCK", size)
    monkeypatch.setattr(blocks, "ROWS", 5)
    made = run("j22_rle_iou")(spark, SF)
    assert "Join" not in made._jdf.queryExecution().optimizedPlan().toString()
    d = Spark(SF, derives=False)
    want = sorted(map(tuple, query(spark, render(j22_rle_iou(d), d)).collect()))
    assert sorted(map(tuple, made.collect())) == want and want
