"""Queries over scene files: written to the shared folder from the driver's
tables, and read back by the data sources; each with its SQL twin over the tables."""

from __future__ import annotations

import io
import struct
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dialect import Duck, Spark
from ..plans.registry import query, render
from ..sources import files, scene_files
from . import scene_sink
from .export import scratch

FILE = "path string, content binary"
_POSE = ("r00", "r01", "r02", "tx", "r10", "r11", "r12", "ty", "r20", "r21", "r22", "tz")


def _sql(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    return query(spark, render(text, Spark(sf_dir)))


def _each(rows: DataFrame, encode: Callable[..., Iterator[tuple[str, bytes]]]) -> DataFrame:
    """The files that a function makes of every row."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame([f for r in batch.itertuples(index=False) for f in encode(r)], columns=["path", "content"])

    return rows.mapInPandas(run, FILE)


def _by_scene(rows: DataFrame, encode: Callable[[int, pd.DataFrame], list[tuple[str, bytes]]]) -> DataFrame:
    """The files that a function makes of a scene's rows (one scene's frames or points)."""
    make = lambda key, held: pd.DataFrame(encode(int(key[0]), held), columns=["path", "content"])
    return rows.groupBy("scene_id").applyInPandas(make, FILE)


def _read(spark: SparkSession, root: str, layout: str, **options: str) -> DataFrame:
    scene_files.register(spark)
    return spark.read.format("scene_files").options(layout=layout, **options).load(root).withColumn("scene_id", F.col("scene").cast("long"))


def _matrix(r) -> np.ndarray:
    return np.array([*(getattr(r, n) for n in _POSE), 0, 0, 0, 1], dtype=float).reshape(4, 4)


def npy(a: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.save(out, a)
    return out.getvalue()


def png_head(width: int, height: int) -> bytes:
    return b"\x89PNG\r\n\x1a\n\0\0\0\rIHDR" + struct.pack(">II", width, height) + b"\x08\0\0\0\0"


CAMS = "select scene_id, frame_idx, vec_id, tx, ty, tz, r00, r01, r02, r10, r11, r12, r20, r21, r22 from cams"


def s02_camera_npz_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch(spark, "npz")

    def encode(r) -> Iterator[tuple[str, bytes]]:
        out, name = io.BytesIO(), "intrinsic" if r.frame_idx % 2 else "intrinsics"
        np.savez(out, **{name: np.diag([500.0 + r.scene_id, 500, 1]), "pose": _matrix(r)})
        yield f"{root}/{r.scene_id}/dense/cam/frame_{r.frame_idx:05d}.npz", out.getvalue()
        if r.frame_idx == 0 and r.scene_id % 2 == 0:
            yield f"{root}/{r.scene_id}/dense/rgb/frame_00000.png", png_head(640 + r.scene_id, 480)

    scene_sink.put_files(_each(_sql(spark, sf_dir, CAMS), encode))
    got = _read(spark, root, "camera_npz")
    return got.selectExpr(
        "scene_id", "cast(frame_idx as bigint) AS frame_idx", "intrinsic[0] AS fl_x", "cast(width as bigint) AS width",
        "round(pose[3], 6) AS tx", "round(pose[11], 6) AS tz", "round(pose[0] + pose[5] + pose[10], 6) AS trace",
    )


S02 = """
    select scene_id, cast(frame_idx as bigint) as frame_idx, 500e0 + scene_id as fl_x,
        cast(case when scene_id % 2 = 0 then 640 + scene_id end as bigint) as width,
        round(tx, 6) as tx, round(tz, 6) as tz, round(r00 + r11 + r22, 6) as trace
    from cams"""


def s03_pose_text_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every eleventh pose is not finite, every thirteenth frame has no image, and
    every third scene no intrinsics."""
    root = scratch(spark, "poses")

    def encode(r) -> Iterator[tuple[str, bytes]]:
        scene, m = f"{root}/{r.scene_id}", _matrix(r)
        text = "\n".join(" ".join(map(repr, row)) for row in m.tolist())
        yield f"{scene}/pose/{r.vec_id}.txt", (text.replace("1.0", "-inf", 1) if r.vec_id % 11 == 0 else text).encode()
        if r.vec_id % 13:
            yield f"{scene}/color/{r.vec_id}.{'png' if r.vec_id % 2 else 'jpg'}", b""
        if r.frame_idx == 0 and r.scene_id % 3:
            yield f"{scene}/intrinsic/intrinsic_color.txt", b"500 0 320 0\n0 500 240 0\n0 0 1 0\n0 0 0 1\n"

    scene_sink.put_files(_each(_sql(spark, sf_dir, CAMS), encode))
    got = _read(spark, root, "pose_text")
    return got.selectExpr(
        "scene_id", "cast(stem as bigint) AS vec_id", "round(pose[7], 6) AS ty", "intrinsic[2] AS cx", "substring_index(image, '.', -1) AS kind"
    )


S03 = """
    select scene_id, vec_id, round(ty, 6) as ty, case when scene_id % 3 <> 0 then 320e0 end as cx,
        case when vec_id % 2 = 1 then 'png' else 'jpg' end as kind
    from cams where vec_id % 11 <> 0 and vec_id % 13 <> 0"""


SPARSE_POINTS = """
    select ins_id div 20 as scene_id, row_number() over (partition by ins_id div 20 order by ins_id, l_orderkey, l_linenumber, x, y, z) as point_id,
        cast(x as double) as x, cast(y as double) as y, cast(z as double) as z, (l_orderkey % 30) / 10e0 as error, l_linenumber as n_track
    from points"""


def sparse_points_binary(held: pd.DataFrame) -> bytes:
    out = [struct.pack("<Q", len(held))]
    for r in held.itertuples():
        out.append(struct.pack("<Q3d3BdQ", r.point_id, r.x, r.y, r.z, 1, 2, 3, r.error, r.n_track) + bytes(8 * r.n_track))
    return b"".join(out)


def sparse_points_text(held: pd.DataFrame) -> bytes:
    rows = [f"{r.point_id} {r.x!r} {r.y!r} {r.z!r} 1 2 3 {r.error!r}" + " 7 8" * r.n_track for r in held.itertuples()]
    return ("# points\n" + "\n".join(rows) + "\n").encode()


def s04_sparse_point_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every third scene's points are text; where there are both, binary counts."""
    root = scratch(spark, "sparse")

    def encode(scene: int, held: pd.DataFrame) -> list[tuple[str, bytes]]:
        folder = f"{root}/{scene}/sparse/0"
        if scene % 3 == 0:
            return [(f"{folder}/points3D.txt", sparse_points_text(held))]
        spare = [(f"{folder}/points3D.txt", b"not read")] if scene % 3 == 1 else []
        return [(f"{folder}/points3D.bin", sparse_points_binary(held)), *spare]

    scene_sink.put_files(_by_scene(_sql(spark, sf_dir, SPARSE_POINTS), encode))
    got = _read(spark, root, "sparse_points").where("error <= 2 and (encoding = 'text' or n_track >= 3)")
    return got.groupBy("scene_id", "encoding").agg(
        F.count("*").alias("n"), F.round(F.sum("x"), 4).alias("sum_x"), F.sum("point_id").alias("sum_id"), F.sum("n_track").alias("n_seen")
    )


S04 = """
    select scene_id, encoding, count(*) as n, round(sum(x), 4) as sum_x, cast(sum(point_id) as bigint) as sum_id, cast(sum(n_track) as bigint) as n_seen
    from (select *, case when scene_id % 3 = 0 then 'text' else 'binary' end as encoding from ({points}) p) q
    where error <= 2 and (encoding = 'text' or n_track >= 3) group by 1, 2"""


def s06_covisibility_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scenes by number modulo 4: the first folder, the second one, two files in
    the first (no matrix, although the second has one), no folder."""
    root = scratch(spark, "covisibility")

    def encode(scene: int, held: pd.DataFrame) -> list[tuple[str, bytes]]:
        m = np.eye(40)
        m[held.frame_a, held.frame_b] = m[held.frame_b, held.frame_a] = held["cov"]
        first, second = f"{root}/{scene}/covisibility/v0", f"{root}/{scene}/spare"
        names = [[f"{first}/m.npy"], [f"{second}/m.npy"], [f"{first}/m.npy", f"{first}/n.npy", f"{second}/m.npy"], []][scene % 4]
        return [(n, npy(m)) for n in names]

    scene_sink.put_files(_by_scene(_sql(spark, sf_dir, "select scene_id, frame_a, frame_b, cov from covis"), encode))
    got = _read(spark, root, "covisibility", folders="covisibility/v0,spare")
    above = F.size(F.filter("cov", lambda c: c > 0.25)).cast("long")
    total = F.round(F.aggregate("cov", F.lit(0.0), lambda s, c: s + c), 4)
    return got.select("scene_id", F.col("row").cast("long").alias("frame_no"), above.alias("n_above"), total.alias("total"))


S06 = """
    select s.scene_id, cast(f.frame_no as bigint) as frame_no, 1 + count(case when c.cov > 0.25e0 then 1 end) as n_above,
        round(1 + coalesce(sum(c.cov), 0), 4) as total
    from (select distinct scene_id from covis where scene_id % 4 < 2) s
    join (select unnest(range(40)) as frame_no) f on true
    left join (select scene_id, frame_a as frame_no, cov from covis union all select scene_id, frame_b, cov from covis) c
        on c.scene_id = s.scene_id and c.frame_no = f.frame_no
    group by 1, 2"""


def s09_depth_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames with their depth; every seventeenth has none, and says so."""
    root = scratch(spark, "depth")
    frames = _sql(spark, sf_dir, "select c.scene_id, c.vec_id, n.embedding from cams c join cam_norms n on n.vec_id = c.vec_id")

    def encode(r) -> Iterator[tuple[str, bytes]]:
        folder = "depth_da3" if r.scene_id % 2 else "dense/depth_da3"
        yield f"{root}/{r.scene_id}/{folder}/{r.vec_id}.npy", npy(np.array(r.embedding, dtype="f4").reshape(4, -1))

    scene_sink.put_files(_each(frames.where("vec_id % 17 <> 0"), encode))
    got = _read(spark, root, "depth", folders="depth_da3,dense/depth_da3").selectExpr("scene_id AS of_scene", "stem", "height", "width", "depth")
    valid = F.size(F.filter("depth", lambda x: x > 0.001)).cast("long")
    met = frames.join(got, (F.col("scene_id") == F.col("of_scene")) & (F.col("vec_id").cast("string") == F.col("stem")), "left")
    return met.select(
        "scene_id", "vec_id", F.col("height").cast("long").alias("height"), F.col("width").cast("long").alias("width"),
        F.when(F.col("depth").isNotNull(), valid).alias("n_valid"), F.col("depth").isNull().alias("missing"),
    )


S09 = """
    select c.scene_id, c.vec_id, case when c.vec_id % 17 <> 0 then cast(4 as bigint) end as height, case when c.vec_id % 17 <> 0 then len(n.embedding) // 4 end as width,
        case when c.vec_id % 17 <> 0 then cast(len(list_filter(n.embedding, lambda x: x > 0.001)) as bigint) end as n_valid, c.vec_id % 17 = 0 as missing
    from cams c join cam_norms n on n.vec_id = c.vec_id"""


def ply(columns: dict[str, np.ndarray], layout: str = "binary_little_endian") -> bytes:
    """A vertex table; unsigned bytes for colours, else 64-bit floats."""
    kinds = {n: ("uchar", "u1") if n in ("red", "green", "blue") else ("double", "f8") for n in columns}
    n = len(next(iter(columns.values())))
    head = f"ply\nformat {layout} 1.0\nelement vertex {n}\n" + "".join(f"property {kinds[c][0]} {c}\n" for c in columns) + "end_header\n"
    if layout == "ascii":
        return (head + "\n".join(" ".join(repr(v.item()) for v in r) for r in zip(*columns.values())) + "\n").encode()
    order = "<" if "little" in layout else ">"
    rows = np.empty(n, dtype=[(c, order + kinds[c][1]) for c in columns])
    for c, v in columns.items():
        rows[c] = v
    return head.encode() + rows.tobytes()


def s11_ply_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vertices in three encodings; odd scenes have no colours, every third an opacity."""
    root = scratch(spark, "ply")

    def encode(scene: int, held: pd.DataFrame) -> list[tuple[str, bytes]]:
        columns = {c: held[c].to_numpy(float) for c in "xyz"}
        if scene % 2 == 0:
            columns |= {c: held["n_track"].to_numpy(np.uint8) for c in ("red", "green", "blue")}
        if scene % 3 == 0:
            columns["opacity"] = held["error"].to_numpy(float)
        layout = ("binary_little_endian", "binary_big_endian", "ascii")[scene % 3]
        return [(f"{root}/{scene}/point_cloud/iteration_7000/point_cloud.ply", ply(columns, layout))]

    scene_sink.put_files(_by_scene(_sql(spark, sf_dir, SPARSE_POINTS), encode))
    got = _read(spark, root, "ply", properties="opacity")
    return got.groupBy("scene_id").agg(
        F.count("*").alias("n"), F.round(F.sum("z"), 4).alias("sum_z"), F.sum("red").alias("sum_red"), F.round(F.sum("opacity"), 4).alias("sum_opacity")
    )


S11 = """
    select scene_id, count(*) as n, round(sum(z), 4) as sum_z, cast(sum(case when scene_id % 2 = 0 then n_track end) as bigint) as sum_red,
        round(sum(case when scene_id % 3 = 0 then error end), 4) as sum_opacity
    from ({points}) p group by 1"""


def _instance_records(spark: SparkSession, sf_dir: str, scenes: DataFrame, tag: str) -> DataFrame:
    """The instances of scenes as JSON texts: eight corners and where they are seen."""
    rows = _sql(spark, sf_dir, "select scene_id, ins_id, label, cx, cy, cz, ex, ey, ez, yaw_deg from instances")
    seen = _sql(spark, sf_dir, "select ins_id as of_id, frame_idx from observations").groupBy("of_id").agg(
        F.transform(F.array_sort(F.collect_set("frame_idx")), lambda f: F.concat(F.lit("f"), f.cast("string"))).alias("images")
    )
    cos, sin = F.cos(F.radians("yaw_deg")), F.sin(F.radians("yaw_deg"))
    corner = lambda sx, sy, sz: F.struct(
        (F.col("cx") + cos * F.col("ex") * sx / 2 - sin * F.col("ey") * sy / 2).alias("x"),
        (F.col("cy") + sin * F.col("ex") * sx / 2 + cos * F.col("ey") * sy / 2).alias("y"),
        (F.col("cz") + F.col("ez") * sz / 2).alias("z"),
    )
    corners = F.array(*[corner(x, y, z) for x in (-1, 1) for y in (-1, 1) for z in (-1, 1)])
    held = rows.join(seen, F.col("ins_id") == F.col("of_id"), "left").withColumn("scene", F.col("scene_id").cast("string"))
    record = F.to_json(F.struct(
        F.col("ins_id").cast("string").alias("ins_id"), F.col("label"), corners.alias("bounding_box"),
        F.coalesce("images", F.array().cast("array<string>")).alias("images"), F.lit(f"é {tag}").alias("description"),
    ))
    return held.join(scenes, "scene", "left_semi").select("scene", record.alias("record"), F.col("ins_id").alias("pos"))


def k01_instance_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON list of instances a scene, in two runs: the first one does the
    even scenes, the second all the others; read back by the reader of instance files."""
    root = scratch(spark, "lists")
    log = scene_sink.RunLog(spark, f"{root}/log")
    scenes = _sql(spark, sf_dir, "select distinct cast(scene_id as string) as scene from instances")
    for tag, some in (("first", scenes.where("scene % 2 = 0")), ("second", scenes)):
        scene_sink.run_scenes(some, lambda todo, tag=tag: _instance_records(spark, sf_dir, todo, tag), f"{root}/scenes", log)
    got = files.instance_json(spark, f"{root}/scenes/*.json")
    scene = F.regexp_extract("path", r"(\d+)\.json$", 1)
    states = log.states().select(F.col("scene").alias("of"), "status")
    low = F.array_min(F.transform("bounding_box", lambda c: c["x"]))
    return got.withColumn("scene", scene).join(states, F.col("scene") == F.col("of")).select(
        F.col("scene").cast("long").alias("scene_id"), F.col("ins_id").cast("long").alias("ins_id"), "label", "description", "status",
        F.size("bounding_box").cast("long").alias("n_corners"), F.size("images").cast("long").alias("n_images"), F.round(low, 4).alias("low_x"),
    )


K01 = """
    select i.scene_id, i.ins_id, i.label, case when i.scene_id % 2 = 0 then 'é first' else 'é second' end as description, 'completed' as status,
        cast(8 as bigint) as n_corners, coalesce(o.n, 0) as n_images,
        round(i.cx - (abs(cos(radians(i.yaw_deg))) * i.ex + abs(sin(radians(i.yaw_deg))) * i.ey) / 2, 4) as low_x
    from instances i left join (select ins_id, count(distinct frame_idx) as n from observations group by 1) o on o.ins_id = i.ins_id"""

QUERIES = {
    f.__name__: f
    for f in (
        s02_camera_npz_files, s03_pose_text_files, s04_sparse_point_files, s06_covisibility_files, s09_depth_files, s11_ply_files, k01_instance_lists,
    )
}


def oracle_sql() -> dict[str, str]:
    points = SPARSE_POINTS.replace(" div ", " // ")
    texts = (S02, S03, S04.replace("{points}", points), S06, S09, S11.replace("{points}", points), K01)
    return {name: render(text, Duck()) for name, text in zip(QUERIES, texts)}
