"""All pairs of a label's cameras, in blocks.

A label's cameras are cut into blocks by their frame number; each pair of blocks is
a group of its own, so the pairs of one label spread over all tasks and a task holds
two blocks and the pairs of a few rows.  Rows shuffled grow with a label's blocks.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.bindings import of_cameras
from ..plans.registry import derived, query, render
from .dialect import Spark

#: Cameras of a block, and those whose pairs are held at once.
BLOCK, ROWS = 2048, 64
POSE = ["tx", "ty", "tz", *(f"r{i}{j}" for i in range(3) for j in range(3))]

Side = dict[str, np.ndarray]


def block_pairs(cameras: DataFrame, found: Callable[[Side, Side, slice], tuple[np.ndarray, np.ndarray, pa.Array]], last: str, text: str) -> DataFrame:
    """(scene_id, frame_a, frame_b, ``last``, a, b): for each pair of cameras, a before b by
    ``vec_id``, that ``found`` names by their places in both blocks, with a value; a and b are
    their poses, of which only what the text names is made (a side it does not name is left out)."""
    size, step = BLOCK, ROWS
    named = {side: [c for c in POSE if re.search(rf"\b{side}\.{c}\b", text)] for side in "ab"}
    named = {side: held for side, held in named.items() if held}
    block = F.expr(f"frame_idx div {size}")
    of_all = "count(*) over (partition by scene_id)"
    keys = F.transform(F.sequence(F.lit(0), F.expr(f"(n - 1) div {size}")), lambda x: F.struct(F.least(x, block).alias("i"), F.greatest(x, block).alias("j")))
    copies = cameras.where("scene_id is not null").withColumn("n", F.expr(of_all)).withColumn("key", F.explode(keys)).drop("n").select("*", "key.i", "key.j").drop("key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(list(batches)).combine_chunks()
        first = int(rows["i"][0].as_py())
        held: Side = {c: rows[c].to_numpy() for c in rows.column_names if c != "embedding"}
        if "embedding" in rows.column_names:
            flat = rows["embedding"].combine_chunks()
            held["embedding"] = flat.flatten().to_numpy(zero_copy_only=False).reshape(len(flat), -1).astype(np.float64)
        at_a, at_b = held["frame_idx"] // size == first, held["frame_idx"] // size == int(rows["j"][0].as_py())
        a, b = ({c: v[at] for c, v in held.items()} for at in (at_a, at_b))
        for low in range(0, len(a["vec_id"]), step):
            x, y, value = found(a, b, slice(low, low + step))
            if len(x):
                sides = {"a": (a, x), "b": (b, y)}
                poses = [pa.StructArray.from_arrays([pa.array(sides[s][0][c][sides[s][1]]) for c in held], held) for s, held in named.items()]
                columns = [pa.array(a["scene_id"][x]), pa.array(a["frame_idx"][x]), pa.array(b["frame_idx"][y]), pa.array(value), *poses]
                yield pa.RecordBatch.from_arrays(columns, names=["scene_id", "frame_a", "frame_b", last, *named])

    poses = [f"{side} struct<{', '.join(f'{c}: double' for c in held)}>" for side, held in named.items()]
    schema = ", ".join([f"scene_id long, frame_a long, frame_b long, {last} double", *poses])
    return copies.groupBy("scene_id", "i", "j").applyInArrow(run, schema)


def close(a: Side, b: Side, rows: slice, least: float = 0.25) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs whose vectors' cosine is over ``least``: by a product of blocks, then by the
    same sum, term after term, as the plan's text."""
    with np.errstate(invalid="ignore", divide="ignore"):
        near = (a["embedding"][rows] @ b["embedding"].T) / (a["norm"][rows, None] * b["norm"])
        x, y = np.nonzero(~(near <= least - 1e-6) & (a["vec_id"][rows, None] < b["vec_id"]))
        x += rows.start
        total = np.zeros(len(x))
        for k in range(a["embedding"].shape[1]):
            total += a["embedding"][x, k] * b["embedding"][y, k]
        cov = total / (a["norm"][x] * b["norm"][y])
    over = ~(cov <= least)
    return x[over], y[over], cov[over]


def apart(a: Side, b: Side, rows: slice, least: float = 2.0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of cameras at least so far from one another."""
    squares = [(a[c][rows, None] - b[c]) ** 2 for c in ("tx", "ty", "tz")]
    dist = np.sqrt(squares[0] + squares[1] + squares[2])
    x, y = np.nonzero(~(dist < least) & (a["vec_id"][rows, None] < b["vec_id"]))
    return x + rows.start, y, dist[x, y]


def _cameras(spark: SparkSession, sf_dir: str, vectors: bool, seen_only: bool = False) -> DataFrame:
    poses = ", ".join(f"c.{x}" for x in POSE)
    also = ", slice(n.embedding, 1, 64) as embedding, n.norm" if vectors else ""
    source = "cams c join cam_norms n on n.vec_id = c.vec_id and n.scene_id = c.scene_id and n.frame_idx = c.frame_idx" if vectors else "cams c"
    shown = f"left semi join {of_cameras(Spark(sf_dir))} f on f.scene_id = c.scene_id and f.frame_idx = c.frame_idx" if seen_only else ""
    where = "where n.norm is not null" if vectors else "where c.tx is not null and c.ty is not null and c.tz is not null"
    return query(spark, render(f"select c.scene_id, cast(c.frame_idx as bigint) as frame_idx, c.vec_id, {poses}{also} from {source} {shown} {where}", Spark(sf_dir)))


@derived
def cam_close(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    """Covisible camera pairs with both poses."""
    return block_pairs(_cameras(spark, sf_dir, True), close, "cov", text)


def cam_near(spark: SparkSession, sf_dir: str, text: str, least: float) -> DataFrame:
    """As ``cam_close``, with a bound of its own, which pairs may reach."""
    below = float(np.nextafter(least, -np.inf))
    return block_pairs(_cameras(spark, sf_dir, True), lambda a, b, rows: close(a, b, rows, below), "cov", text)


@derived
def cam_apart(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    """Pairs of cameras at least two meters apart."""
    return block_pairs(_cameras(spark, sf_dir, False), apart, "dist", text)


@derived
def cam_close_shown(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    """Those of cameras whose frames show something in the scene of the same number."""
    return block_pairs(_cameras(spark, sf_dir, True, seen_only=True), close, "cov", text)


@derived
def mask_pairs(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    """(a, b, inter, uni): all pairs of masks of a label, by their words' common bits."""
    d = Spark(sf_dir)
    words = query(spark, render("select vec_id, label, area, words from rle_words", d))
    size = BLOCK
    masks = words.where("label is not null and vec_id is not null")
    # a label's masks are dealt to blocks by a number in it, whatever their ids
    masks = masks.selectExpr("*", "row_number() over (partition by label order by vec_id) - 1 as place", "count(*) over (partition by label) as n")
    block = F.expr(f"place div {size}")
    keys = F.transform(F.sequence(F.lit(0), F.expr(f"(n - 1) div {size}")), lambda x: F.struct(F.least(x, block).alias("i"), F.greatest(x, block).alias("j")))
    copies = masks.withColumn("key", F.explode(keys)).select("vec_id", "area", "words", "label", block.alias("own"), "key.i", "key.j")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(list(batches)).combine_chunks().sort_by("vec_id")
        lists = rows["words"].combine_chunks()
        sizes = np.diff(lists.offsets.to_numpy())
        bits = np.zeros((len(sizes), int(sizes.max())), dtype=np.uint64)
        bits[np.arange(bits.shape[1]) < sizes[:, None]] = lists.flatten().to_numpy().view(np.uint64)
        ids, area, own = (rows[c].to_numpy() for c in ("vec_id", "area", "own"))
        at_a, at_b = np.flatnonzero(own == rows["i"][0].as_py()), np.flatnonzero(own == rows["j"][0].as_py())
        for low in range(0, len(at_a), ROWS):
            part = at_a[low : low + ROWS]
            common = np.zeros((len(part), len(at_b)), dtype=np.int64)
            for w in range(bits.shape[1]):
                common += np.bitwise_count(bits[part, w, None] & bits[at_b, w])
            x, y = np.nonzero(ids[part, None] < ids[at_b])
            inter = common[x, y]
            uni = area[part][x] + area[at_b][y] - inter
            if len(x):
                yield pa.RecordBatch.from_arrays([pa.array(v) for v in (ids[part][x], ids[at_b][y], inter, uni)], names=["a", "b", "inter", "uni"])

    return copies.groupBy("label", "i", "j").applyInArrow(run, "a long, b long, inter long, uni long")
