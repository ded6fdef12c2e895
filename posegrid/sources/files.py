"""Readers of scene files: camera JSON and text, arrays, point clouds, sparse
reconstructions.  Text and JSON go through Spark's own readers; binary formats
are decoded batch by batch from ``binaryFile`` rows."""

from __future__ import annotations

import io
import struct
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TRANSFORMS = (
    "fl_x double, fl_y double, cx double, cy double, w int, h int, camera_model string, "
    "frames array<struct<file_path:string,transform_matrix:array<array<double>>,is_bad:boolean>>, "
    "test_frames array<struct<file_path:string,transform_matrix:array<array<double>>,is_bad:boolean>>"
)


def stem(path):
    return F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"\.[^.]*$", "")


def camera_json(spark: SparkSession, path: str) -> DataFrame:
    """Frames of both lists, by path; columns 1 and 2 of the pose are negated."""
    raw = spark.read.schema(TRANSFORMS).option("multiLine", True).json(path).withColumn("scene", F.input_file_name())
    both = F.concat(F.coalesce("frames", F.array()), F.coalesce("test_frames", F.array()))
    rows = raw.select("scene", "fl_x", "fl_y", "cx", "cy", "w", "h", F.coalesce("camera_model", F.lit("PINHOLE")).alias("camera_model"),
                      F.posexplode(F.array_sort(both)).alias("frame_idx", "f"))
    flat = F.flatten("f.transform_matrix")
    flip = F.transform(flat, lambda x, i: F.when((i % 4).isin(1, 2) & (i < 12), -x).otherwise(x))
    return rows.select("scene", "frame_idx", F.col("f.file_path").alias("file_path"), stem(F.col("f.file_path")).alias("stem"),
                       flip.alias("c2w"), F.coalesce("f.is_bad", F.lit(False)).alias("is_bad"),
                       "fl_x", "fl_y", "cx", "cy", "w", "h", "camera_model")


def pose_text(spark: SparkSession, path: str) -> DataFrame:
    """One 4x4 pose a file; wrong shapes and non-finite entries are dropped."""
    raw = spark.read.text(path, wholetext=True).withColumn("path", F.input_file_name())
    numbers = F.transform(F.split(F.trim(F.regexp_replace("value", r"\s+", " ")), " "), lambda x: x.try_cast("double"))
    rows = raw.select("path", stem(F.col("path")).alias("stem"), numbers.alias("c2w"))
    finite = F.forall("c2w", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.where((F.size("c2w") == 16) & finite)


def instance_json(spark: SparkSession, path: str) -> DataFrame:
    """Instances from a list, or from the first of four keys of an object."""
    item = "array<struct<ins_id:string,label:string,bounding_box:array<struct<x:double,y:double,z:double>>,images:array<string>,description:string>>"
    raw = spark.read.text(path, wholetext=True).withColumn("path", F.input_file_name())
    as_list = F.from_json("value", item)
    keyed = F.from_json("value", ", ".join(f"{k} {item}" for k in ("instances", "objects", "annotations", "data")))
    held = F.when(F.ltrim("value").startswith("["), as_list).otherwise(
        F.coalesce(keyed["instances"], keyed["objects"], keyed["annotations"], keyed["data"])
    )
    return raw.select("path", F.inline(held))


def mask_index_json(spark: SparkSession, path: str) -> DataFrame:
    schema = (
        "scene string, items array<struct<image:string,label:string,mask_path:string,"
        "mask_rle:struct<size:array<int>,counts:string>,bbox:array<double>,score:double>>, missing_images array<string>"
    )
    return spark.read.schema(schema).option("multiLine", True).json(path).select("scene", F.inline("items"))


def decoded(spark: SparkSession, path: str, decode: Callable[[bytes], pd.DataFrame], schema: str) -> DataFrame:
    """Rows that a decoder finds in each binary file, with the file's path."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, content in zip(batch["path"], batch["content"]):
                rows = decode(content)
                rows.insert(0, "path", name)
                yield rows

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, f"path string, {schema}")


def read_npy(content: bytes) -> pd.DataFrame:
    """An array as rows of (i, j, value), flattened to two axes."""
    a = np.load(io.BytesIO(content), allow_pickle=False)
    a = a.reshape(len(a), -1) if a.ndim != 1 else a[:, None]
    i, j = np.indices(a.shape)
    return pd.DataFrame({"i": i.ravel(), "j": j.ravel(), "value": a.ravel().astype(float)})


NPY = "i long, j long, value double"


def read_camera_npz(content: bytes) -> pd.DataFrame:
    held = np.load(io.BytesIO(content), allow_pickle=False)
    k = held["intrinsic"] if "intrinsic" in held else held["intrinsics"]
    return pd.DataFrame({"intrinsic": [k.astype(float).ravel().tolist()], "pose": [held["pose"].astype(float).ravel().tolist()]})


CAMERA_NPZ = "intrinsic array<double>, pose array<double>"
_PLY = {"char": "i1", "uchar": "u1", "short": "i2", "ushort": "u2", "int": "i4", "uint": "u4", "float": "f4", "double": "f8",
        "int8": "i1", "uint8": "u1", "int16": "i2", "uint16": "u2", "int32": "i4", "uint32": "u4", "float32": "f4", "float64": "f8"}


def read_ply(content: bytes) -> pd.DataFrame:
    """Vertices as (k, properties by name): any set of scalar properties."""
    head, _, body = content.partition(b"end_header")
    body = body[body.index(b"\n") + 1 :]
    lines = head.decode("ascii").split("\n")
    layout = next(x.split()[1] for x in lines if x.startswith("format"))
    count, fields, inside = 0, [], False
    for line in map(str.split, lines):
        if line[:1] == ["element"]:
            inside = line[1] == "vertex"
            count = int(line[2]) if inside else count
        elif line[:1] == ["property"] and inside:
            fields.append((line[2], line[1]))
    if layout == "ascii":
        values = np.array(body.split()[: count * len(fields)], dtype=float).reshape(count, len(fields))
        columns = {name: values[:, k] for k, (name, _) in enumerate(fields)}
    else:
        order = "<" if "little" in layout else ">"
        rows = np.frombuffer(body, dtype=[(n, order + _PLY[t]) for n, t in fields], count=count)
        columns = {n: rows[n].astype(float) for n, _ in fields}
    properties = [dict(zip(columns, map(float, v))) for v in zip(*columns.values())]
    return pd.DataFrame({"k": np.arange(count), "properties": properties})


PLY = "k long, properties map<string,double>"


def write_ply(points: np.ndarray, colors: np.ndarray) -> bytes:
    names = [(n, "<f4") for n in "xyz"] + [(n, "u1") for n in ("red", "green", "blue")]
    rows = np.empty(len(points), dtype=names)
    for k, n in enumerate("xyz"):
        rows[n] = points[:, k]
    for k, n in enumerate(("red", "green", "blue")):
        rows[n] = colors[:, k]
    kinds = ["float"] * 3 + ["uchar"] * 3
    props = "".join(f"property {kind} {name}\n" for kind, (name, _) in zip(kinds, names))
    return f"ply\nformat binary_little_endian 1.0\nelement vertex {len(points)}\n{props}end_header\n".encode() + rows.tobytes()


def read_sparse_images(content: bytes) -> pd.DataFrame:
    """Binary image table of a sparse reconstruction: pose, camera and name."""
    (n,), at, rows = struct.unpack_from("<Q", content), 8, []
    for _ in range(n):
        image, *pose, camera = struct.unpack_from("<i7di", content, at)
        at += struct.calcsize("<i7di")
        end = content.index(b"\0", at)
        name, (n_points,) = content[at:end].decode(), struct.unpack_from("<Q", content, end + 1)
        at = end + 9 + 24 * n_points
        rows.append((image, camera, name, pose[:4], pose[4:], n_points))
    return pd.DataFrame(rows, columns=["image_id", "camera_id", "name", "qvec", "tvec", "n_points"])


SPARSE_IMAGES = "image_id int, camera_id int, name string, qvec array<double>, tvec array<double>, n_points long"


def read_sparse_points(content: bytes) -> pd.DataFrame:
    (n,), at, rows = struct.unpack_from("<Q", content), 8, []
    for _ in range(n):
        point, x, y, z, r, g, b, error = struct.unpack_from("<Q3d3Bd", content, at)
        at += struct.calcsize("<Q3d3Bd")
        (track,) = struct.unpack_from("<Q", content, at)
        at += 8 + 8 * track
        rows.append((point, x, y, z, r, g, b, error, track))
    return pd.DataFrame(rows, columns=["point_id", "x", "y", "z", "r", "g", "b", "error", "n_track"])


SPARSE_POINTS = "point_id long, x double, y double, z double, r int, g int, b int, error double, n_track long"
#: Parameters of each public camera model, by its number.
CAMERA_PARAMS = {0: 3, 1: 4, 2: 4, 3: 5, 4: 8, 5: 8, 6: 12, 7: 5, 8: 4, 9: 5, 10: 12}


def read_sparse_cameras(content: bytes) -> pd.DataFrame:
    (n,), at, rows = struct.unpack_from("<Q", content), 8, []
    for _ in range(n):
        camera, model, w, h = struct.unpack_from("<2i2Q", content, at)
        at += 24
        params = struct.unpack_from(f"<{CAMERA_PARAMS[model]}d", content, at)
        at += 8 * len(params)
        rows.append((camera, model, w, h, list(params)))
    return pd.DataFrame(rows, columns=["camera_id", "model", "width", "height", "params"])


SPARSE_CAMERAS = "camera_id int, model int, width long, height long, params array<double>"


def covisibility(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The first of the candidate folders that holds exactly one matrix."""
    files = None
    for rank, path in enumerate(paths):
        part = spark.read.format("binaryFile").option("pathGlobFilter", "*.npy").load(path).select("path", F.lit(rank).alias("rank"))
        files = part if files is None else files.unionByName(part)
    scene = F.element_at(F.split("path", "/"), -2)
    counted = files.groupBy(scene.alias("scene"), "rank").agg(F.count("*").alias("n"), F.min("path").alias("path")).where("n = 1")
    return counted.groupBy("scene").agg(F.min_by("path", "rank").alias("path"))
