"""Scene files as a Python data source: ``spark.read.format("scene_files")``.

The files of all scenes below a root (``load(root)``; a scene is a folder in it)
are listed once, dealt to partitions by size, and decoded to Arrow batches in
the tasks: arrays stay arrays, a vertex table is decoded column by column.
Options ``scenes`` and ``stems`` ("a,b") prune files before any is opened.  (Spark 4.1
can push filters to a Python source, but keeps them with the table: a second scan of
the same DataFrame, without the filter, then lacks rows; so none are taken.)
The root is a path, or a URI of a file system that pyarrow knows.

Layouts (``option("layout", ...)``):

``camera_npz``      frame_*.npz: intrinsics and pose; its place among the scene's frames; the
                    size of the scene's first image, from its header
``pose_text``       pose/<stem>.txt, a 4x4 of finite numbers, else the row goes; only with an
                    image color/<stem>.jpg or .png; the scene's intrinsic/intrinsic_color.txt
``sparse_cameras``, ``sparse_images``, ``sparse_points``
                    a reconstruction, binary where the scene has the binary file, else text
``covisibility``    one N x N matrix, a row a row: the first folder of option ``folders`` that the scene
                    has counts, and only if it holds exactly one .npy
``depth``           <stem>.npy in the first folder of ``folders`` that the scene has
``ply``             vertices: x, y, z, colours (null where the file has none) and the scalar
                    properties named by option ``properties``
"""

from __future__ import annotations

import io
import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from .files import _PLY, CAMERA_PARAMS

FIRST = "scene string, stem string, path string"
SCHEMAS = {
    "camera_npz": f"{FIRST}, frame_idx int, intrinsic array<double>, pose array<double>, width int, height int",
    "pose_text": f"{FIRST}, pose array<double>, intrinsic array<double>, image string",
    "sparse_cameras": f"{FIRST}, encoding string, camera_id int, model string, width long, height long, params array<double>",
    "sparse_images": f"{FIRST}, encoding string, image_id int, camera_id int, name string, qvec array<double>, tvec array<double>, n_points long",
    "sparse_points": f"{FIRST}, encoding string, point_id long, x double, y double, z double, red int, green int, blue int, error double, n_track long",
    "covisibility": f"{FIRST}, size int, row int, cov array<double>",
    "depth": f"{FIRST}, height int, width int, depth array<float>",
    "ply": f"{FIRST}, k long, x double, y double, z double, red int, green int, blue int",
}
#: Public camera models by number.
CAMERA_MODELS = ("SIMPLE_PINHOLE PINHOLE SIMPLE_RADIAL RADIAL OPENCV OPENCV_FISHEYE FULL_OPENCV FOV SIMPLE_RADIAL_FISHEYE "
                 "RADIAL_FISHEYE THIN_PRISM_FISHEYE").split()  # fmt: skip
VERTICES = 1 << 16  # of a batch


@dataclass
class Item:
    scene: str
    stem: str
    path: str
    size: int
    at: int = 0
    image: str | None = None
    beside: str | None = None


@dataclass
class Files(InputPartition):
    items: list[Item]


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if ":/" in path else (fs.LocalFileSystem(), path)


def _stem(path: str) -> str:
    return path.rpartition("/")[2].rpartition(".")[0]


class Reader(DataSourceReader):
    def __init__(self, options: dict, schema: StructType):
        self.layout = options["layout"]
        self.root = options["path"].rstrip("/")
        self.folders = [f.strip("/") for f in options.get("folders", "").split(",") if f]
        self.properties = [p for p in options.get("properties", "").split(",") if p]
        self.bytes = int(options.get("bytes", 64 << 20))
        self.wanted = {k: set(options[f"{k}s"].split(",")) for k in ("scene", "stem") if options.get(f"{k}s")}
        self.arrow = to_arrow_schema(schema)

    # -- listing

    def partitions(self) -> list[Files]:
        system, root = file_system(self.root)
        scenes: dict[str, dict[str, fs.FileInfo]] = {}
        for info in system.get_file_info(fs.FileSelector(root, recursive=True)):
            inner = info.path[len(root.rstrip("/")) + 1 :]
            scene, _, rest = inner.partition("/")
            if rest and info.type == fs.FileType.File:
                scenes.setdefault(scene, {})[rest] = info
        out: list[Files] = []
        size = self.bytes
        for scene in sorted(scenes):
            if scene not in self.wanted.get("scene", {scene}):
                continue
            for item in self._items(scene, scenes[scene]):
                if item.stem not in self.wanted.get("stem", {item.stem}):
                    continue
                if size >= self.bytes:
                    out.append(Files([]))
                    size = 0
                out[-1].items.append(item)
                size += item.size + (1 << 16)  # and what opening one costs
        return out or [Files([])]

    def _items(self, scene: str, found: dict[str, fs.FileInfo]) -> Iterator[Item]:
        def item(rest: str, **more) -> Item:
            return Item(scene, _stem(rest), found[rest].path, found[rest].size, **more)

        if self.layout == "camera_npz":
            names = sorted(r for r in found if re.search(r"(^|/)frame_[^/]*\.npz$", r))
            first = f"dense/rgb/{_stem(names[0])}.png" if names else ""
            image = found[first].path if first in found else None
            for at, rest in enumerate(names):
                yield item(rest, at=at, image=image)
        elif self.layout == "pose_text":
            intrinsic = found.get("intrinsic/intrinsic_color.txt")
            for rest in sorted(found):
                if not re.fullmatch(r"pose/[^/]+\.txt", rest):
                    continue
                images = [found[i].path for i in (f"color/{_stem(rest)}.{kind}" for kind in ("jpg", "png")) if i in found]
                if images:
                    yield item(rest, image=images[0], beside=intrinsic.path if intrinsic else None)
        elif self.layout.startswith("sparse_"):
            what = {"sparse_cameras": "cameras", "sparse_images": "images", "sparse_points": "points3D"}[self.layout]
            for kind in ("bin", "txt"):
                names = sorted(r for r in found if r.rpartition("/")[2] == f"{what}.{kind}")
                if names:
                    yield item(names[0])
                    break
        elif self.layout in ("covisibility", "depth"):
            for folder in self.folders or [""]:
                inside = [r for r in found if r.startswith(f"{folder}/") or not folder]
                if not inside:
                    continue
                arrays = sorted(r for r in inside if re.fullmatch(r"[^/]+\.npy", r[len(folder) + 1 :] if folder else r))
                if self.layout == "depth" or len(arrays) == 1:
                    yield from map(item, arrays)
                break
        elif self.layout == "ply":
            yield from map(item, sorted(r for r in found if r.endswith(".ply")))

    # -- decoding

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        system, _ = file_system(self.root)

        def get(path: str) -> bytes:
            with system.open_input_file(path) as source:
                return source.read()

        rows: list[tuple] = []
        for item in partition.items:
            head = (item.scene, item.stem, item.path)
            if self.layout in ("ply", "sparse_points"):
                whole = self._ply(get(item.path)) if self.layout == "ply" else _points(item, get(item.path))
                n = len(whole[0])
                for at in range(0, n, VERTICES):
                    few = min(VERTICES, n - at)
                    columns = [[h] * few for h in head] + [c if c is None else c[at : at + few] for c in whole]
                    yield self._batch([pa.nulls(few) if c is None else c for c in columns])
                continue
            for row in getattr(self, f"_{self.layout}")(item, get):
                rows.append((*head, *row))
            if len(rows) >= 1024:
                yield self._batch(list(zip(*rows)))
                rows = []
        if rows:
            yield self._batch(list(zip(*rows)))

    def _batch(self, columns: list) -> pa.RecordBatch:
        made = [c.cast(f.type) if isinstance(c, pa.Array) else pa.array(c, type=f.type) for c, f in zip(columns, self.arrow)]
        return pa.RecordBatch.from_arrays(made, schema=self.arrow)

    def _camera_npz(self, item: Item, get) -> Iterator[tuple]:
        held = np.load(io.BytesIO(get(item.path)), allow_pickle=False)
        k = held["intrinsic"] if "intrinsic" in held else held["intrinsics"]
        width = height = None
        if item.image:
            head = get(item.image)[:24]
            if head[:8] == b"\x89PNG\r\n\x1a\n":
                width, height = struct.unpack(">II", head[16:24])
        yield item.at, k.astype(float).ravel(), held["pose"].astype(float).ravel(), width, height

    def _pose_text(self, item: Item, get) -> Iterator[tuple]:
        pose = _numbers(get(item.path))
        if pose is None or len(pose) != 16 or not np.isfinite(pose).all():
            return
        k = _numbers(get(item.beside)) if item.beside else None
        yield pose, k, item.image

    def _sparse_cameras(self, item: Item, get) -> Iterator[tuple]:
        content = get(item.path)
        if item.path.endswith(".txt"):
            for words in _lines(content):
                yield "text", int(words[0]), words[1], int(words[2]), int(words[3]), [float(w) for w in words[4:]]
            return
        (n,), at = struct.unpack_from("<Q", content), 8
        for _ in range(n):
            camera, model, width, height = struct.unpack_from("<2i2Q", content, at)
            params = struct.unpack_from(f"<{CAMERA_PARAMS[model]}d", content, at + 24)
            at += 24 + 8 * len(params)
            yield "binary", camera, CAMERA_MODELS[model], width, height, params

    def _sparse_images(self, item: Item, get) -> Iterator[tuple]:
        content = get(item.path)
        if item.path.endswith(".txt"):
            lines = [x for x in content.decode().splitlines() if not x.startswith("#")]
            for head, points in zip(lines[::2], [*lines[1::2], ""]):  # an image's points may be an empty line
                words = head.split(maxsplit=9)
                q, t = [float(w) for w in words[1:5]], [float(w) for w in words[5:8]]
                yield "text", int(words[0]), int(words[8]), words[9], q, t, len(points.split()) // 3
            return
        (n,), at = struct.unpack_from("<Q", content), 8
        for _ in range(n):
            image, *pose, camera = struct.unpack_from("<i7di", content, at)
            end = content.index(b"\0", at + 64)
            (n_points,) = struct.unpack_from("<Q", content, end + 1)
            yield "binary", image, camera, content[at + 64 : end].decode(), pose[:4], pose[4:], n_points
            at = end + 9 + 24 * n_points

    def _covisibility(self, item: Item, get) -> Iterator[tuple]:
        a = np.load(io.BytesIO(get(item.path)), allow_pickle=False)
        for k, row in enumerate(a.astype(float)):
            yield len(a), k, row

    def _depth(self, item: Item, get) -> Iterator[tuple]:
        a = np.load(io.BytesIO(get(item.path)), allow_pickle=False).astype("f4")
        yield a.shape[0], a.shape[1], a.ravel()

    def _ply(self, content: bytes) -> list[np.ndarray | None]:
        head, _, body = content.partition(b"end_header")
        body = body[body.index(b"\n") + 1 :]
        lines = [x.split() for x in head.decode("ascii").splitlines()]
        layout = next(x[1] for x in lines if x[:1] == ["format"])
        elements: list[tuple[str, int, list[tuple[str, str]]]] = []
        for x in lines:
            if x[:1] == ["element"]:
                elements.append((x[1], int(x[2]), []))
            elif x[:1] == ["property"]:
                elements[-1][2].append((x[-1], x[1]))
        if elements[0][0] != "vertex":
            raise ValueError("vertices must be the first element")
        _, count, fields = elements[0]
        if layout == "ascii":
            values = np.array(body.split()[: count * len(fields)], dtype=float).reshape(count, len(fields))
            columns = {name: values[:, k] for k, (name, _) in enumerate(fields)}
        else:
            order = "<" if "little" in layout else ">"
            rows = np.frombuffer(body, dtype=[(n, order + _PLY[t]) for n, t in fields], count=count)
            columns = {n: rows[n] for n, _ in fields}
        number = lambda n, kind: columns[n].astype(kind) if n in columns else None
        return [
            np.arange(count), *(number(n, float) for n in "xyz"), *(number(n, np.int32) for n in ("red", "green", "blue")),
            *(number(n, float) for n in self.properties),
        ]


def _lines(content: bytes) -> Iterator[list[str]]:
    return (x.split() for x in content.decode().splitlines() if x.strip() and not x.startswith("#"))


def _numbers(content: bytes) -> np.ndarray | None:
    try:
        return np.array(content.split(), dtype=float)
    except ValueError:
        return None


def _points(item: Item, content: bytes) -> list[np.ndarray]:
    """The points of a reconstruction, by column."""
    if item.path.endswith(".txt"):
        rows = list(_lines(content))
        fixed = np.array([r[:8] for r in rows], dtype=float).reshape(-1, 8)
        track = np.array([(len(r) - 8) // 2 for r in rows], dtype=np.int64)
        ids, kind = fixed[:, 0].astype(np.int64), "text"
        xyz, rgb, error = fixed[:, 1:4], fixed[:, 4:7].astype(np.int32), fixed[:, 7]
    else:
        (n,), at = struct.unpack_from("<Q", content), 8
        begins, track = np.empty(n, dtype=np.int64), np.empty(n, dtype=np.int64)
        for k in range(n):  # records differ in length by their tracks
            begins[k] = at
            (track[k],) = struct.unpack_from("<Q", content, at + 43)
            at += 51 + 8 * int(track[k])
        record = np.dtype([("id", "<u8"), ("xyz", "<f8", 3), ("rgb", "u1", 3), ("error", "<f8")])
        raw = np.frombuffer(content, dtype=np.uint8)[begins[:, None] + np.arange(43)]
        rows = np.ascontiguousarray(raw).view(record).reshape(-1)
        ids, xyz, rgb, error, kind = rows["id"].astype(np.int64), rows["xyz"], rows["rgb"].astype(np.int32), rows["error"], "binary"
    return [np.full(len(ids), kind, dtype=object), ids, *xyz.T, *rgb.T, error, track]


class SceneFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return "scene_files"

    def schema(self) -> str:
        more = [f", `{p}` double" for p in self.options.get("properties", "").split(",") if p]
        return SCHEMAS[self.options["layout"]] + "".join(more)

    def reader(self, schema: StructType) -> Reader:
        return Reader(dict(self.options), schema)


def register(spark: SparkSession) -> None:
    """Make the format known to the session."""
    spark.dataSource.register(SceneFiles)
