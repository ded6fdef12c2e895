"""Values of camera pairs are worked out once a row, not wherever they are named."""

import pytest

from posegrid.plans.registry import run

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["q01_main_dir", "q04_rotation", "q06_center_direction"])
def test_poses_are_spelled_out_once(spark, name):
    plan = run(name)(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("r02") < 40


@pytest.mark.parametrize("name", ["q13_proxy_direction", "q14_region_proxy_direction", "q15_relpos", "q16_region_relpos"])
def test_fixed_options_need_no_lambdas(spark, name):
    plan = run(name)(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "lambdafunction" not in plan and plan.count("md5(") < 16


@pytest.mark.parametrize("name", ["q15_relpos", "q16_region_relpos", "m14_ego8", "m18_local_frame"])
def test_steps_of_the_local_frame_are_spelled_out_once(spark, name):
    plan = run(name)(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.lower().count("sqrt(") < 30
