"""Frames of five digits have paths of their own, and their numbers no ties."""

from posegrid.functions.dialect import Spark
from posegrid.plans.registry import render
from posegrid.plans.text import s01_camera_frames


def test_no_two_frames_share_a_path(spark, tmp_path):
    rows = spark.range(10_050).selectExpr("id as vec_id", "array_repeat(cast(0.5 as float), 64) as embedding", "0 as label")
    rows.coalesce(1).write.parquet(str(tmp_path / "embeddings.parquet"))
    d = Spark(str(tmp_path))
    got = spark.sql(render(s01_camera_frames(d), d)).selectExpr("count(*) as n", "count(distinct path) as paths").first()
    assert (got["n"], got["paths"]) == (10_050, 10_050)
