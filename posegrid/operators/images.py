"""Pairs of images and of masks measured row by row in Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from ..functions import rasters, rle

METRICS = "image_id long, ssim double, mse double, lncc double, n_unlike long, gradient double"
POINT = "image_id long, x long, y long, label int"


def image_metrics(images: DataFrame, *, patch: int = 3) -> DataFrame:
    """(image_id, width, a, b: pixels row by row) to the images' likeness:
    structural similarity, mean squared error, local correlation over all whole patches (mean, and
    how many are unlike), and the mean gradient weight of ``a``.

    Images of unequal or broken shape, and those with a null pixel, give nulls."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for image_id, width, a, b in batch[["image_id", "width", "a", "b"]].itertuples(index=False):
                row = (image_id, None, None, None, None, None)
                if a is not None and b is not None and width and len(a) == len(b) and len(a) and len(a) % width == 0:
                    a, b = (np.array(x, dtype=float).reshape(-1, int(width)) for x in (a, b))
                    if np.isfinite(a).all() and np.isfinite(b).all():
                        local = rasters.lncc(a, b, patch) if min(a.shape) >= patch else np.zeros(0)
                        row = (
                            image_id, rasters.ssim(a, b), float(((a - b) ** 2).mean()), float(local.mean()) if local.size else None,
                            int((local >= 0.9).sum()), float(rasters.gradient_weights(a).mean()),
                        )
                out.append(row)
            yield pd.DataFrame(out, columns=[c.split()[0] for c in METRICS.split(", ")])

    return images.select("image_id", "width", "a", "b").mapInPandas(run, METRICS)


def error_points(masks: DataFrame) -> DataFrame:
    """(image_id, height, truth, guess: run lengths) to the point where a click
    would correct the deepest error.  Masks end with their last run; null is empty."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for image_id, height, *sides in batch[["image_id", "height", "truth", "guess"]].itertuples(index=False):
                counts = [[] if c is None else [int(n) for n in c] for c in sides]
                width = max(1, -(-max(map(sum, counts)) // int(height)))
                shapes = []
                for c in counts:
                    c = [*c, 0] if len(c) % 2 else c  # then the rest is background
                    shapes.append(rle.to_mask([*c, int(height) * width - sum(c)], int(height), width))
                out.append((image_id, *rasters.error_point(*shapes)))
            yield pd.DataFrame(out, columns=[c.split()[0] for c in POINT.split(", ")])

    return masks.select("image_id", "height", "truth", "guess").mapInPandas(run, POINT)
