"""Order-dependent operators as grouped functions over Arrow batches.

Each runs one group (a scene, a frame, or a scene's label) in one call, with an
explicit order inside, so results do not depend on partitioning.  Groups are
bounded by what a scene or a frame holds, not by the corpus.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import hull, kernels, rle


def fuse_instances(points: DataFrame, *, limit: float = 0.3, every: bool = False, fixpoint: bool = True) -> DataFrame:
    """Points (group_id, item_pos, x, y, z) to fused instances: trimmed point
    sets fused in item order, then merged to a fixpoint.  Points without a group are one of their own."""

    def run(rows: dict[str, np.ndarray]) -> tuple[np.ndarray, ...] | None:
        order = np.lexsort([rows[c] for c in ("z", "y", "x", "item_pos")])
        pos, xyz = rows["item_pos"][order], np.column_stack([rows[c][order] for c in "xyz"])
        edges = [0, *(np.flatnonzero(pos[1:] != pos[:-1]) + 1).tolist(), len(pos)]
        items, sets = [], []
        for a, b in zip(edges, edges[1:]):
            cloud = kernels.trim(xyz[a:b])
            if len(cloud) >= 3:
                items.append(int(pos[a]))
                sets.append(cloud)
        if not sets:
            return None
        found = kernels.fused(sets, limit, every)
        if fixpoint:
            found = kernels.merged(found, limit)
        n = len(found)
        listed = np.array([",".join(str(items[i]) for i in sorted(members)) for members, _, _ in found], dtype=object)
        values = np.array([(*box[0], *box[2]) for _, _, box in found])
        return np.full(n, rows["group_id"][0]), np.arange(n), np.array([len(m) for m, _, _ in found]), listed, *values.T

    schema = "group_id long, instance int, n_items int, items string, " + ", ".join(f"{c} double" for c in "cx cy cz ex ey ez".split())
    cols = points.where("item_pos is not null").select(
        F.coalesce("group_id", F.lit(_NO_GROUP)).alias("group_id"), F.col("item_pos").cast("long").alias("item_pos"), *[F.col(c).cast("double").alias(c) for c in "xyz"]
    )
    made = by_group_arrays(cols, "group_id", "item_pos", run, schema)
    return made.withColumn("group_id", F.nullif("group_id", F.lit(_NO_GROUP)))


#: The number that stands for no group.
_NO_GROUP = -(2**63)


def by_group(rows: DataFrame, key: str, order: str, fn: Callable[[pd.DataFrame], pd.DataFrame | None], schema: str) -> DataFrame:
    """Apply a function to each group of rows, in the order of a column.

    Partitions are sorted and streamed, so many small groups share a call and a
    task holds a batch and one group."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        for batch in batches:
            if not len(batch):
                continue
            keys = batch[key].to_numpy()
            cuts = np.flatnonzero(keys[1:] != keys[:-1]) + 1
            if held and held[-1][key].iloc[-1] == keys[0] and not len(cuts):
                held.append(batch)
                continue
            edges = [0, *cuts.tolist(), len(batch)]
            pieces = [batch.iloc[a:b] for a, b in zip(edges, edges[1:])]
            if held and held[-1][key].iloc[-1] == keys[0]:
                pieces[0] = pd.concat([*held, pieces[0]])
            elif held:
                pieces.insert(0, pd.concat(held))
            held = [pieces.pop()]
            found = [x for x in map(fn, pieces) if x is not None and len(x)]
            if found:
                yield pd.concat(found)
        if held and (last := fn(pd.concat(held))) is not None and len(last):
            yield last

    # a number given is kept: work here goes by groups, not by the bytes that partitions are merged by
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(parts, key).sortWithinPartitions(key, order).mapInPandas(run, schema)


_ARROW = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string()}


def by_group_arrays(rows: DataFrame, key: str, order: str, fn: Callable[..., tuple[np.ndarray, ...] | None], schema: str, *, many: int = 0) -> DataFrame:
    """As ``by_group``, with a group's columns as arrays (numbers, without nulls as such) and the result's as well:
    nothing is made of a group but slices.  With ``many`` the function takes lists of so many groups."""
    names, kinds = [c.split()[0] for c in schema.split(", ")], [_ARROW[c.split()[1]] for c in schema.split(", ")]
    columns = rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None

        def found(whole: pa.Table) -> pa.RecordBatch:
            values = {c: whole[c].to_numpy() for c in columns}
            keys = values[key]
            edges = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
            groups = [{c: v[a:b] for c, v in values.items()} for a, b in zip(edges, edges[1:])]
            if many:
                groups = [groups[low : low + many] for low in range(0, len(groups), many)]
            out = [x for group in groups if (x := fn(group)) is not None]
            made = [np.concatenate(c) for c in zip(*out)] if out else [[] for _ in names]
            return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(made, kinds)], names=names)

        for batch in batches:
            whole = pa.Table.from_batches([batch])
            held = pa.concat_tables([held, whole]) if held is not None else whole
            keys = held[key].to_numpy()
            if len(keys) and keys[0] != keys[-1]:
                cut = int(np.flatnonzero(keys[1:] != keys[:-1])[-1]) + 1
                yield found(held.slice(0, cut))
                held = held.slice(cut)
        if held is not None and held.num_rows:
            yield found(held)

    # a number given is kept: work here goes by groups, not by the bytes that partitions are merged by
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.where(f"{key} is not null").repartition(parts, key).sortWithinPartitions(key, order).mapInArrow(run, schema)


_CORNERS = ("x0", "y0", "x1", "y1")


def suppress(boxes: DataFrame, *, limit: float = 0.1, over: str = "union", least_score: float = 0.0) -> DataFrame:
    """Boxes (group_id, box_id, score, x0, y0, x1, y1) kept by suppression over
    the union or the smaller one."""

    def run(rows: dict[str, np.ndarray]) -> tuple[np.ndarray, ...] | None:
        at = np.flatnonzero(rows["score"] > least_score)
        xyxy = np.column_stack([rows[c][at] for c in _CORNERS])
        kept = at[sorted(kernels.greedy_keep(kernels.box_iou(xyxy, xyxy, over), rows["score"][at], limit))] if len(at) else at
        return rows["group_id"][kept], rows["box_id"][kept], rows["score"][kept]

    cols = boxes.select("group_id", "box_id", F.col("score").cast("double").alias("score"), *[F.col(c).cast("double").alias(c) for c in _CORNERS])
    alone = cols.where(F.col("group_id").isNull() & (F.col("score") > least_score)).select("group_id", "box_id", "score")  # in no group: nothing hides them
    return by_group_arrays(cols, "group_id", "box_id", run, "group_id long, box_id long, score double").unionByName(alone)


def assign_tracks(boxes: DataFrame, *, least_iou: float = 0.1) -> DataFrame:
    """One-to-one matches of detections and tracks (``is_track``) of a group."""

    def run(rows: dict[str, np.ndarray]) -> tuple[np.ndarray, ...] | None:
        tracks = rows["is_track"] == 1
        if tracks.all() or not tracks.any():
            return None
        xyxy = np.column_stack([rows[c] for c in _CORNERS])
        iou = kernels.box_iou(xyxy[~tracks], xyxy[tracks])
        matched = np.array(kernels.assign(1 - iou), dtype=np.int64).reshape(-1, 2)
        i, j = matched[iou[matched[:, 0], matched[:, 1]] >= least_iou].T
        return np.full(len(i), rows["group_id"][0]), rows["box_id"][~tracks][i], rows["box_id"][tracks][j], iou[i, j]

    cols = boxes.select("group_id", "box_id", F.col("is_track").cast("int").alias("is_track"), *[F.col(c).cast("double").alias(c) for c in _CORNERS])
    return by_group_arrays(cols, "group_id", "box_id", run, "group_id long, det long, track long, iou double")


def sample_pairs(pairs: DataFrame, *, most: int = 100, seed: int = 42) -> DataFrame:
    """Greedy non-repeating frame pairs (scene_id, frame_a, frame_b, cov)."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        scene = rows["scene_id"].iloc[0]
        draw = lambda *key: (hashlib.md5("|".join(map(str, (seed, scene, *key))).encode()).hexdigest(), key)
        got = kernels.sample_pairs(list(rows[["frame_a", "frame_b", "cov"]].itertuples(index=False)), draw, most)
        out = [(scene, b, a, c) if int(draw("s", a, b)[0][0], 16) % 2 else (scene, a, b, c) for a, b, c in got]
        return pd.DataFrame(out, columns=["scene_id", "frame_a", "frame_b", "cov"])

    return pairs.groupBy("scene_id").applyInPandas(run, "scene_id long, frame_a long, frame_b long, cov double")


def erode(mask: np.ndarray, radius: int) -> np.ndarray:
    """Cells whose square neighbourhood is all foreground (the border is not)."""
    out = mask
    for axis in (0, 1):
        padded = np.pad(out, [(radius, radius) if a == axis else (0, 0) for a in (0, 1)])
        sums = np.cumsum(np.insert(padded.astype(np.int32), 0, 0, axis=axis), axis=axis)
        width = 2 * radius + 1
        out = np.take(sums, range(width, sums.shape[axis]), axis=axis) - np.take(sums, range(sums.shape[axis] - width), axis=axis) == width
    return out


MASK_STATS = "mask_id long, text string, area long, n_components long, largest long, area_clean long, area_eroded long"


def mask_stats(masks: DataFrame, *, area: int = 16, radius: int = 1) -> DataFrame:
    """Masks (mask_id, height, counts) by raster: the text form of the runs,
    components and their largest area, and areas after hole filling and erosion."""

    def run(batches):
        for batch in batches:
            out = []
            for mask_id, height, counts in batch[["mask_id", "height", "counts"]].itertuples(index=False):
                counts = [int(c) for c in counts]
                counts = [*counts, *([0] if len(counts) % 2 else []), -sum(counts) % height]
                mask = rle.to_mask(counts, height, sum(counts) // height)
                labels, areas = rle.label_components(mask)
                names = np.unique(labels[labels > 0])
                clean = rle.fill_and_clean(mask, area) if mask.size else mask
                out.append((mask_id, rle.encode_counts(counts), int(mask.sum()), len(names), int(areas.max(initial=0)),
                            int(clean.sum()), int(erode(mask, radius).sum()) if mask.size else 0))
            yield pd.DataFrame(out, columns=[f.split()[0] for f in MASK_STATS.split(", ")])

    return masks.mapInPandas(run, MASK_STATS)


def fit_boxes(points: DataFrame, *, principal: bool = False) -> DataFrame:
    """One oriented box for each group (group_id, x, y, z) of three points or
    more: of least volume, or along the principal axes."""

    def run(groups: list[dict[str, np.ndarray]]) -> tuple[np.ndarray, ...] | None:
        clouds = [np.column_stack([rows[c] for c in "xyz"])[np.lexsort([rows[c] for c in "zyx"])] for rows in groups]
        clouds = [kernels.trim(cloud) for cloud in clouds]
        at = [k for k, cloud in enumerate(clouds) if len(cloud) >= 3]
        if not at:
            return None
        clouds, ids = [clouds[k] for k in at], [groups[k]["group_id"][0] for k in at]
        boxes = [kernels.pca_box(cloud) for cloud in clouds] if principal else hull.least_boxes(clouds)
        return np.array(ids), np.array([len(cloud) for cloud in clouds]), *np.array([(*b[0], *b[2]) for b in boxes]).T

    cols = points.select("group_id", *[F.col(c).cast("double").alias(c) for c in "xyz"])
    schema = "group_id long, n long, " + ", ".join(f"{c} double" for c in "cx cy cz ex ey ez".split())
    return by_group_arrays(cols, "group_id", "x", run, schema, many=128)


def oriented_overlaps(pairs: DataFrame, *, least: float = 0.3) -> DataFrame:
    """Pairs of oriented boxes (a, b, and of each side cx, cy, cz, ex, ey, ez,
    yaw_deg) whose common volume is at least a share of the smaller one."""
    fields = ("cx", "cy", "cz", "ex", "ey", "ez", "yaw_deg")

    def box(row, side: str):
        cx, cy, cz, ex, ey, ez, yaw = (float(getattr(row, f"{f}_{side}")) for f in fields)
        c, s = np.cos(np.radians(yaw)), np.sin(np.radians(yaw))
        return np.array([cx, cy, cz]), np.array([[c, -s, 0.0], [s, c, 0.0], [0.0, 0.0, 1.0]]), np.array([ex, ey, ez])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ratios = [kernels.overlap_ratio(box(r, "a"), box(r, "b")) for r in batch.itertuples(index=False)]
            out = batch[["a", "b"]].assign(ratio=np.array(ratios, dtype=float))
            yield out[out["ratio"] >= least]

    return pairs.mapInPandas(run, "a long, b long, ratio double")


def least_loaded(items: DataFrame, *, slots: int = 8) -> DataFrame:
    """Each item (group_id, item_id, load) in turn to the slot of its group with
    the least load so far, the first among equals."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        loads = [0.0] * slots
        chosen = []
        for load in rows["load"]:
            k = min(range(slots), key=loads.__getitem__)
            loads[k] += load
            chosen.append(k)
        return rows[["group_id", "item_id"]].assign(slot=chosen, load_after=[float(x) for x in _running(chosen, rows["load"])])

    return by_group(items.select("group_id", "item_id", "load"), "group_id", "item_id", run, "group_id long, item_id long, slot long, load_after double")


def _running(slots: list[int], loads) -> list[float]:
    """The load of the chosen slot after each placement."""
    held: dict[int, float] = {}
    out = []
    for k, load in zip(slots, loads):
        held[k] = held.get(k, 0.0) + load
        out.append(held[k])
    return out
