"""Overlaps of a frame's boxes: worked out whole where they are few, through the grid where not."""

import duckdb

from posegrid.operators import spatial_queries as q

SF = "/root/testdata/sf0.001"


def test_frames_of_few_boxes_need_no_grid(spark, monkeypatch):
    con = duckdb.connect()
    con.execute(f"create view lineitem as select * from '{SF}/lineitem.parquet'")
    twin = con.sql(q.oracle_sql()["j21_grid_box_iou"])
    asked, plain = [], q.spatial.box_pairs
    monkeypatch.setattr(q.spatial, "box_pairs", lambda a, b, dims: asked.append(a.count()) or plain(a, b, dims))
    made = q.j21_grid_box_iou(spark, SF)
    assert asked == [0]
    want = sorted(twin.fetchall())
    assert sorted(map(tuple, made.select(*twin.columns).collect())) == want and want
    monkeypatch.setattr(q, "FEW", 12)
    assert sorted(map(tuple, q.j21_grid_box_iou(spark, SF).select(*twin.columns).collect())) == want and asked[1] > 0


def test_reversed_boxes_meet_none(spark):
    rows = [(1, 1, 1, 1, 9.0, 0.0, 0.0, 3.0, 3.0, 3), (1, 1, 1, 2, 9.0, 2.0, 2.0, 1.0, 1.0, 3), (1, 1, 1, 3, 9.0, 1.0, 1.0, 4.0, 4.0, 3)]
    boxes = spark.createDataFrame(rows, "part long, scene_id long, frame_idx long, k long, area double, x0 double, y0 double, x1 double, y1 double, n long")
    assert [(r.a, r.b, r.inter, r.hull) for r in q._few_boxes(boxes).collect()] == [(1, 3, 4.0, 16.0)]
