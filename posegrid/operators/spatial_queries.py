"""Queries by place: the same results as the pairwise plans, through the grid."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dialect import Spark
from ..plans.registry import query, render, twin
from . import groups, spatial
from .export import scratch

FIELDS = ("cx", "cy", "cz", "ex", "ey", "ez", "yaw_deg")


def _sql(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    return query(spark, render(text, Spark(sf_dir)))


def _boxes(spark: SparkSession, sf_dir: str, table: str, turned: bool) -> DataFrame:
    """Boxes of a scene with the axis-aligned box around them."""
    rows = _sql(spark, sf_dir, f"select scene_id as part, ins_id, {', '.join(FIELDS)} from {table}")
    half = [F.col(e) / 2 for e in ("ex", "ey", "ez")]
    if turned:
        c, s = F.abs(F.cos(F.radians("yaw_deg"))), F.abs(F.sin(F.radians("yaw_deg")))
        half = [c * half[0] + s * half[1], s * half[0] + c * half[1], half[2]]
    sides = [(F.col(c) - h, F.col(c) + h) for c, h in zip(("cx", "cy", "cz"), half)]
    return rows.select("*", F.array(*[low for low, _ in sides]).alias("lo"), F.array(*[high for _, high in sides]).alias("hi"))


def j14_grid_overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    boxes = _boxes(spark, sf_dir, "instances", False)
    pairs = spatial.box_pairs(boxes, boxes).where("a.ins_id < b.ins_id")
    sides = [f"(least(a.hi[{d}], b.hi[{d}]) - greatest(a.lo[{d}], b.lo[{d}]))" for d in range(3)]
    return pairs.selectExpr("part AS scene_id", "a.ins_id AS a", "b.ins_id AS b", f"round({' * '.join(sides)}, 6) AS inter_vol")


def j15_grid_oriented_overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overlaps of the turned regions of a scene."""
    boxes = _boxes(spark, sf_dir, "regions", True)
    pairs = spatial.box_pairs(boxes, boxes).where("a.ins_id < b.ins_id")
    sides = [f"{s}.{c} AS {c}_{s}" for s in "ab" for c in FIELDS]
    return groups.oriented_overlaps(pairs.selectExpr("a.ins_id AS a_id", "b.ins_id AS b_id", *sides).withColumnsRenamed({"a_id": "a", "b_id": "b"}), least=0.33)


def j16_grid_containment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boxes all of whose corners lie in a region, both turned about z."""
    slack = F.expr("transform(lo, x -> x - 1e-5)"), F.expr("transform(hi, x -> x + 1e-5)")
    regions = _boxes(spark, sf_dir, "regions", True).withColumns({"lo": slack[0], "hi": slack[1]})
    pairs = spatial.box_pairs(_boxes(spark, sf_dir, "instances", True), regions).where("a.ins_id <> b.ins_id")
    held = ["abs(a.cz - b.cz) + a.ez / 2 <= b.ez / 2 + 1e-6"]
    for i in (-1, 1):
        for j in (-1, 1):
            dx = f"(a.cx + {i} * cos(radians(a.yaw_deg)) * a.ex / 2 - {j} * sin(radians(a.yaw_deg)) * a.ey / 2 - b.cx)"
            dy = f"(a.cy + {i} * sin(radians(a.yaw_deg)) * a.ex / 2 + {j} * cos(radians(a.yaw_deg)) * a.ey / 2 - b.cy)"
            held += [
                f"abs(cos(radians(b.yaw_deg)) * {dx} + sin(radians(b.yaw_deg)) * {dy}) <= b.ex / 2 + 1e-6",
                f"abs(cos(radians(b.yaw_deg)) * {dy} - sin(radians(b.yaw_deg)) * {dx}) <= b.ey / 2 + 1e-6",
            ]
    return pairs.where(" and ".join(held)).selectExpr("part AS scene_id", "a.ins_id AS inner_id", "b.ins_id AS outer_id")


#: Boxes of a frame that is worked out whole.
FEW = 256


def j21_grid_box_iou(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of boxes of a frame that overlap, with their shares: frames of few boxes are worked out
    whole where their boxes are, only larger ones go through the grid."""
    rows = _sql(spark, sf_dir, """
        select scene_id * 100 + frame_idx as part, scene_id, frame_idx, cast(k as bigint) as k, cast(w * h as double) as area,
            cast(x as double) as x0, cast(y as double) as y0, cast(x + w as double) as x1, cast(y + h as double) as y1,
            count(*) over (partition by scene_id, frame_idx) as n
        from detections""")  # fmt: skip
    path = scratch(spark, "crowded")
    _sql(spark, sf_dir, f"select scene_id, frame_idx from masks group by 1, 2 having count(*) > {FEW}").write.parquet(path)
    # the join by frame goes below the numbering: rows of other frames are not numbered for the grid
    many = rows.join(F.broadcast(spark.read.parquet(path)), ["scene_id", "frame_idx"], "left_semi")
    valued = _few_boxes(rows.where(f"n <= {FEW}")).unionByName(_many_boxes(many))
    return valued.selectExpr(
        "scene_id", "frame_idx", "a", "b", "round(inter / all + 1e-9, 6) AS iou",
        "round(inter / all - (hull - all) / hull + 1e-9, 6) AS giou", "round(inter / area_b + 1e-9, 6) AS ioa",
    ).where("iou > 0")


def _few_boxes(rows: DataFrame) -> DataFrame:
    """Pairs of boxes of a part that share some area, many parts at once."""

    def run(parts: list[dict[str, np.ndarray]]) -> tuple[np.ndarray, ...]:
        held = {c: np.concatenate([p[c] for p in parts]) for c in parts[0]}
        sizes = np.array([len(p["k"]) for p in parts])
        firsts = np.cumsum(sizes) - sizes
        i, j = [], []
        for n in np.unique(sizes).tolist():
            low, high = np.triu_indices(n, 1)
            at = firsts[sizes == n][:, None]
            i.append((at + low).ravel())
            j.append((at + high).ravel())
        i, j = np.concatenate(i), np.concatenate(j)
        wide = np.minimum(held["x1"][i], held["x1"][j]) - np.maximum(held["x0"][i], held["x0"][j])
        high = np.minimum(held["y1"][i], held["y1"][j]) - np.maximum(held["y0"][i], held["y0"][j])
        meet = (wide > 0) & (high > 0)
        i, j, inter = i[meet], j[meet], (wide * high)[meet]
        hull = (np.maximum(held["x1"][i], held["x1"][j]) - np.minimum(held["x0"][i], held["x0"][j])) * (np.maximum(held["y1"][i], held["y1"][j]) - np.minimum(held["y0"][i], held["y0"][j]))
        area = held["area"]
        return held["scene_id"][i], held["frame_idx"][i], held["k"][i], held["k"][j], inter, hull, area[i] + area[j] - inter, area[j]

    schema = "scene_id long, frame_idx long, a long, b long, inter double, hull double, all double, area_b double"
    return groups.by_group_arrays(rows.drop("n"), "part", "k", run, schema, many=64)


def _many_boxes(rows: DataFrame) -> DataFrame:
    """The same through the grid."""
    boxes = rows.select("part", "scene_id", "frame_idx", "k", "area", F.array("x0", "y0").alias("lo"), F.array("x1", "y1").alias("hi"))
    pairs = spatial.box_pairs(boxes, boxes, 2).where("a.k < b.k")
    inter = " * ".join(f"(least(a.hi[{d}], b.hi[{d}]) - greatest(a.lo[{d}], b.lo[{d}]))" for d in range(2))
    hull = " * ".join(f"(greatest(a.hi[{d}], b.hi[{d}]) - least(a.lo[{d}], b.lo[{d}]))" for d in range(2))
    valued = pairs.withColumns({"inter": F.expr(inter), "hull": F.expr(hull)}).withColumn("all", F.expr("a.area + b.area - inter"))
    return valued.selectExpr("a.scene_id", "a.frame_idx", "a.k AS a", "b.k AS b", "inter", "hull", "all", "b.area AS area_b")


def j18_nearest_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean squared distance to the three nearest points of the same part."""
    return spatial.near_means(spark, sf_dir, "").select("part", F.col("id").alias("k"), F.round("mean_d2", 6).alias("mean_d2"))


QUERIES = {
    f.__name__: f
    for f in (j14_grid_overlaps, j15_grid_oriented_overlaps, j16_grid_containment, j18_nearest_points, j21_grid_box_iou)
}


def oracle_sql() -> dict[str, str]:
    return {
        "j14_grid_overlaps": twin("j14_aabb_overlaps"),
        "j16_grid_containment": twin("j16_box_containment"),
        "j18_nearest_points": twin("j18_knn3_points"),
        "j21_grid_box_iou": f"select * from ({twin('j21_box_iou_giou')}) t where iou > 0",
    }
