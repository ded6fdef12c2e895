"""Run-length masks: column-major runs, background first, and their text form.

The text form writes each count (from the third on, its difference to the count
two before) in groups of five bits, low first, offset by 48; bit 5 of a group
says that more follow, and the last group's bit 4 is the sign.
"""

from __future__ import annotations

import numpy as np


def decode_counts(text: str) -> list[int]:
    counts: list[int] = []
    value = shift = 0
    for char in text:
        group = ord(char) - 48
        value |= (group & 31) << shift
        shift += 5
        if not group & 32:
            if group & 16:
                value -= 1 << shift
            counts.append(value + (counts[-2] if len(counts) > 2 else 0))
            value = shift = 0
    return counts


def encode_counts(counts: list[int]) -> str:
    out = []
    for i, count in enumerate(counts):
        value = count - counts[i - 2] if i > 2 else count
        while True:
            group, value = value & 31, value >> 5
            more = value != (-1 if group & 16 else 0)
            out.append(chr(48 + (group | 32 * more)))
            if not more:
                break
    return "".join(out)


def to_mask(counts: list[int], height: int, width: int) -> np.ndarray:
    flags = np.arange(len(counts)) % 2 == 1
    return np.repeat(flags, counts).reshape(width, height).T


def from_mask(mask: np.ndarray) -> list[int]:
    flat = np.concatenate(([False], np.asarray(mask, dtype=bool).T.ravel()))
    edges = np.flatnonzero(flat[1:] != flat[:-1])
    return np.diff(np.concatenate(([0], edges, [len(flat) - 1]))).tolist()


def label_components(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(labels from 1, area of each cell's component), four-neighbour, by
    pointer jumping on the least index of each component."""
    mask = np.asarray(mask, dtype=bool)
    root = np.where(mask, np.arange(mask.size).reshape(mask.shape), mask.size)
    while True:
        least = root.copy()
        least[1:] = np.where(mask[1:] & mask[:-1], np.minimum(least[1:], root[:-1]), least[1:])
        least[:-1] = np.where(mask[1:] & mask[:-1], np.minimum(least[:-1], root[1:]), least[:-1])
        least[:, 1:] = np.where(mask[:, 1:] & mask[:, :-1], np.minimum(least[:, 1:], root[:, :-1]), least[:, 1:])
        least[:, :-1] = np.where(mask[:, 1:] & mask[:, :-1], np.minimum(least[:, :-1], root[:, 1:]), least[:, :-1])
        flat = np.append(least.ravel(), mask.size)
        least = flat[least]
        if (least == root).all():
            break
        root = least
    names, inverse, counts = np.unique(root, return_inverse=True, return_counts=True)
    inverse = inverse.reshape(mask.shape)
    return np.where(mask, inverse + 1, 0), np.where(mask, counts[inverse], 0)


def fill_and_clean(mask: np.ndarray, area: int) -> np.ndarray:
    """Small holes become foreground, small islands background."""
    mask = np.asarray(mask, dtype=bool)
    _, holes = label_components(~mask)
    filled = mask | ((holes > 0) & (holes <= area))
    _, islands = label_components(filled)
    return filled & ~((islands > 0) & (islands <= min(area, int(filled.sum()) // 2)))
