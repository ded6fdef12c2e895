"""Draws a scene at a time: the rows of the plans' own joins."""

import pytest

from posegrid.functions.dialect import Spark
from posegrid.plans.registry import query, render

SF = "/root/testdata/sf0.001"
COUPLE = "scene_id, frame_a, frame_b, cov, ins_id_a, label_a, cx_a, ez_a, ins_id_b, label_b, cy_b, ex_b, draw"
TRIPLE = "scene_id, frame_a, frame_b, ins_id_a, cx_a, ex_a, ins_id_b, cy_b, ey_b, ins_id_c, label_c, cz_c, ez_c, draw"
ROWS = {
    "objects_across": COUPLE, "regions_across": COUPLE, "object_region_across": COUPLE, "triplets": TRIPLE,
    "two_and_region_a": TRIPLE, "two_and_region_b": TRIPLE, "in_either": "scene_id, frame_a, frame_b, ins_id, in_a, in_b",
}


@pytest.mark.parametrize("view", ROWS)
def test_the_rows_of_the_joins(spark, view):
    text = f"select {ROWS[view]} from {view}"
    read = lambda d: query(spark, render(text, d))
    want = sorted(map(tuple, read(Spark(SF, derives=False)).collect()))
    assert sorted(map(tuple, read(Spark(SF)).collect())) == want and len(want) > 300


@pytest.mark.parametrize("view", ROWS)
def test_nothing_is_shuffled_by_pair(spark, view):
    plan = query(spark, render(f"select {ROWS[view]} from {view}", Spark(SF)))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan
