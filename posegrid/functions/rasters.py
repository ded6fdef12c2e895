"""Measures of images and masks on pixel grids: likeness, gradients, local
correlation, and distances to the background."""

from __future__ import annotations

import numpy as np

#: Window, width and stabilisers of structural similarity.
WINDOW, SIGMA, C1, C2 = 11, 1.5, 0.01**2, 0.03**2


def _blur(image: np.ndarray) -> np.ndarray:
    """The Gaussian window's weighted means, zeros beyond the border."""
    half = WINDOW // 2
    weight = np.exp(-((np.arange(WINDOW) - half) ** 2) / (2 * SIGMA**2))
    weight /= weight.sum()
    for axis in (0, 1):
        padded = np.pad(image, [(half, half) if a == axis else (0, 0) for a in (0, 1)])
        n = image.shape[axis]
        image = sum(w * np.take(padded, range(k, k + n), axis=axis) for k, w in enumerate(weight))
    return image


def ssim(a: np.ndarray, b: np.ndarray) -> float:
    """Mean structural similarity of two images of one channel."""
    ma, mb = _blur(a), _blur(b)
    va, vb, both = _blur(a * a) - ma * ma, _blur(b * b) - mb * mb, _blur(a * b) - ma * mb
    return float((((2 * ma * mb + C1) * (2 * both + C2)) / ((ma * ma + mb * mb + C1) * (va + vb + C2))).mean())


def gradient_weights(image: np.ndarray) -> np.ndarray:
    """The larger central difference of each inner pixel, spread to 0..1 (0
    where all are alike); 1 along the border."""
    out = np.ones(image.shape)
    if min(image.shape) > 2:
        across, down = np.abs(image[1:-1, 2:] - image[1:-1, :-2]), np.abs(image[2:, 1:-1] - image[:-2, 1:-1])
        steep = np.maximum(across, down)
        spread = steep.max() - steep.min()
        out[1:-1, 1:-1] = (steep - steep.min()) / spread if spread > 0 else 0.0
    return out


def patch_sums(image: np.ndarray, size: int) -> np.ndarray:
    """Sums of all whole patches, by a summed-area table."""
    table = np.zeros((image.shape[0] + 1, image.shape[1] + 1))
    table[1:, 1:] = image.cumsum(axis=0).cumsum(axis=1)
    return table[size:, size:] - table[:-size, size:] - table[size:, :-size] + table[:-size, :-size]


def lncc(a: np.ndarray, b: np.ndarray, size: int = 3) -> np.ndarray:
    """One minus the squared local correlation of all whole patches, 0 to 2."""
    n = size * size
    sa, sb = patch_sums(a, size), patch_sums(b, size)
    cross = patch_sums(a * b, size) - sa * sb / n
    va, vb = patch_sums(a * a, size) - sa * sa / n, patch_sums(b * b, size) - sb * sb / n
    return np.clip(1 - cross * cross / (va * vb + 1e-8), 0, 2)


def squared_distances(mask: np.ndarray) -> np.ndarray:
    """Squared distance of every pixel to the nearest one outside the mask: along
    columns first, then the least over each row; exact.  Without any outside it is infinite."""
    height, width = mask.shape
    far = height + width + 1
    up = np.zeros(mask.shape, dtype=np.int64)
    for down in (False, True):
        rows = range(height - 1, -1, -1) if down else range(height)
        run = np.full(width, far, dtype=np.int64)
        for y in rows:
            run = np.where(mask[y], np.minimum(run + 1, far), 0)
            up[y] = np.minimum(up[y], run) if down else run
    across = (np.arange(width)[:, None] - np.arange(width)[None]) ** 2
    out = np.empty(mask.shape)
    for y in range(height):
        out[y] = (across + up[y][None] ** 2).min(axis=1)
    return np.where(out >= far * far, np.inf, out) if mask.all() else out


def error_point(truth: np.ndarray, guess: np.ndarray) -> tuple[int, int, int]:
    """(x, y, label): the middle of the deepest error, a pixel with the largest
    distance to what is no such error (the border is none); the first in rows.
    Label 1 for what is missing, 0 for what is too much or nothing is wrong."""
    depth = [np.pad(e, 1) for e in (truth & ~guess, ~truth & guess)]
    missing, extra = (squared_distances(e)[1:-1, 1:-1] for e in depth)
    positive = missing.size > 0 and missing.max() > extra.max()
    chosen = missing if positive else extra
    at = int(chosen.argmax()) if chosen.size else 0
    return at % max(1, truth.shape[1]), at // max(1, truth.shape[1]), int(positive)
