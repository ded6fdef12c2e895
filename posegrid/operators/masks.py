"""Masks of a frame against each other, by a sweep over their run boundaries.

The boundaries of all runs cut the frame's pixels (in the masks' own order) into
stretches on which no mask changes; each stretch is owned by the covering mask
of the highest score (the first, among equals).  Areas, intersections and
what every mask keeps are sums over stretches, so the work grows with the runs and not
with the pixels.  A task holds one frame's masks.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .groups import by_group

#: Masks that keep less of their area than this are suppressed.
SHRINK = 0.3


def stretches(counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(length of each stretch, masks x stretches: covered)."""
    stops = [np.cumsum(c) for c in counts]
    begins = [s[:-1:2] for s in stops]  # counts are background first
    ends = [s[1::2] for s in stops]
    edges = np.unique(np.concatenate([np.zeros(1, dtype=np.int64), *stops]))
    cover = np.zeros((len(counts), len(edges)), dtype=np.int32)
    for k, (b, e) in enumerate(zip(begins, ends)):
        np.add.at(cover[k], np.searchsorted(edges, b[: len(e)]), 1)
        np.add.at(cover[k], np.searchsorted(edges, e), -1)
    return np.diff(edges), np.cumsum(cover, axis=1)[:, :-1] > 0


def owners(cover: np.ndarray, scores: np.ndarray) -> np.ndarray:
    """The mask that owns each stretch, -1 for none."""
    order = np.argsort(-scores, kind="stable")
    ranked = cover[order]
    return np.where(ranked.any(axis=0), order[ranked.argmax(axis=0)], -1)


def to_counts(lengths: np.ndarray, inside: np.ndarray) -> list[int]:
    """Runs of a mask that covers some stretches, background first."""
    if not len(lengths):
        return []
    inside = np.concatenate(([False], inside))
    turns = np.flatnonzero(inside[1:] != inside[:-1])
    total = np.concatenate(([0], np.cumsum(lengths)))
    return np.diff(np.concatenate(([0], total[turns], [total[-1]]))).tolist()


def _frames(masks: DataFrame) -> DataFrame:
    return masks.select("frame_id", "mask_id", F.col("score").cast("double").alias("score"), F.col("counts").cast("array<long>").alias("counts"))


def _counts(rows: pd.DataFrame) -> list[np.ndarray]:
    return [np.zeros(0, dtype=np.int64) if c is None else np.asarray(c, dtype=np.int64) for c in rows["counts"]]


def non_overlapping(masks: DataFrame) -> DataFrame:
    """Masks (frame_id, mask_id, score, counts) so that each pixel is of one: the
    areas before and after, what is left as runs, and whether a mask shrank too much.

    A null or empty list of counts covers nothing; a null score is the lowest."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        lengths, cover = stretches(_counts(rows))
        owner = owners(cover, rows["score"].fillna(-np.inf).to_numpy())
        before = cover @ lengths
        after = np.bincount(owner[owner >= 0], weights=lengths[owner >= 0], minlength=len(rows)).astype(np.int64)
        left = [to_counts(lengths, owner == k) for k in range(len(rows))]
        shrunk = after / np.maximum(before, 1) < SHRINK
        return rows[["frame_id", "mask_id"]].assign(area=before, area_left=after, shrunk=shrunk, counts_left=left)

    schema = "frame_id long, mask_id long, area long, area_left long, shrunk boolean, counts_left array<long>"
    return by_group(_frames(masks), "frame_id", "mask_id", run, schema)


def mask_pairs(masks: DataFrame) -> DataFrame:
    """Pairs of masks of a frame that meet: intersection, over the union and over the smaller one."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        lengths, cover = stretches(_counts(rows))
        inter = (cover * lengths) @ cover.T.astype(np.int64)
        area = np.diag(inter)
        a, b = np.nonzero(np.triu(inter, 1))
        both, ids = inter[a, b], rows["mask_id"].to_numpy()
        return pd.DataFrame({
            "frame_id": np.full(len(a), rows["frame_id"].iloc[0]), "a": ids[a], "b": ids[b], "inter": both,
            "iou": both / (area[a] + area[b] - both), "iom": both / np.minimum(area[a], area[b]),
        })

    return by_group(_frames(masks), "frame_id", "mask_id", run, "frame_id long, a long, b long, inter long, iou double, iom double")
