"""Convex hulls, and the box of least volume around points.

A box of least volume has two adjacent faces that each hold an edge of the hull.
Given two edges, a box is a rotation about the first one: its first face holds that
edge and lies between the hull's two faces at it, the second one holds the other edge, and the
third is square to both.  All pairs of edges whose faces admit this are searched:
their volumes are sampled along the rotation, and the best ones narrowed down.
Boxes with a face on one of the hull's faces are the ends of these rotations.
"""

from __future__ import annotations

import numpy as np

from .kernels import fit_box

SAMPLES, NARROWED, STEPS = 9, 48, 40
_GOLD = (5**0.5 - 1) / 2


def _cross(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``np.cross`` of rows of three, without its handling of axes."""
    out = np.empty(np.broadcast_shapes(a.shape, b.shape))
    for k, i, j in ((0, 1, 2), (1, 2, 0), (2, 0, 1)):
        np.subtract(a[..., i] * b[..., j], a[..., j] * b[..., i], out=out[..., k])
    return out


def _spanning(points: np.ndarray, flat: float) -> list[int]:
    """Places of up to four points that span as much as the points do."""
    out = [int(np.lexsort(points.T[::-1])[0])]
    away = np.linalg.norm(points - points[out[0]], axis=1)
    if away.max() <= flat:
        return out
    out.append(int(away.argmax()))
    u = (points[out[1]] - points[out[0]]) / away.max()
    off = (points - points[out[0]]) - np.outer((points - points[out[0]]) @ u, u)
    away = np.linalg.norm(off, axis=1)
    if away.max() <= flat:
        return out
    out.append(int(away.argmax()))
    normal = np.cross(u, off[out[2]] / away.max())
    away = np.abs((points - points[out[0]]) @ normal)
    if away.max() > flat:
        out.append(int(away.argmax()))
    return out


def convex_hull(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Triangles (places of points, seen from outside) and their outer normals;
    both empty where the points do not span a solid."""
    scale = max(float(np.ptp(points, axis=0).max()), 1e-300)
    flat = 1e-10 * scale
    first = _spanning(points, flat * 10)
    if len(first) < 4:
        return np.zeros((0, 3), dtype=int), np.zeros((0, 3))
    middle = points[first].mean(axis=0)

    def planes(tri: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        a, b, c = (points[tri[:, k]] for k in range(3))
        normal = _cross(b - a, c - a)
        normal /= np.maximum(np.linalg.norm(normal, axis=1, keepdims=True), 1e-300)
        inward = ((a - middle) * normal).sum(axis=1) < 0
        tri = np.where(inward[:, None], tri[:, [0, 2, 1]], tri)
        normal = np.where(inward[:, None], -normal, normal)
        return tri, normal, (normal * a).sum(axis=1)

    i, j, k, m = first
    tri, normal, offset = planes(np.array([[i, j, k], [i, j, m], [i, k, m], [j, k, m]]))
    left = np.setdiff1d(np.arange(len(points)), first)
    while len(left):
        beyond = points[left] @ normal.T - offset
        far = beyond.max(axis=1)
        left, beyond, far = left[far > flat], beyond[far > flat], far[far > flat]
        if not len(left):
            break
        best = int(far.argmax())
        seen = beyond[best] > flat
        edges = tri[seen][:, [0, 1, 1, 2, 2, 0]].reshape(-1, 2)
        known = {tuple(e) for e in edges.tolist()}
        rim = np.array([e for e in edges.tolist() if (e[1], e[0]) not in known])
        new = planes(np.column_stack([rim, np.full(len(rim), left[best])]))
        tri, normal, offset = (np.concatenate((old[~seen], more)) for old, more in zip((tri, normal, offset), new))
        left = np.delete(left, best)
    return tri, normal


def _rectangles(points: np.ndarray, normals: np.ndarray, edges: np.ndarray) -> list[np.ndarray]:
    """For each normal the axes (as rows) of its best box with a side along an edge."""
    u = edges - (normals @ edges.T)[:, :, None] * normals[:, None]
    size = np.linalg.norm(u, axis=2)
    fits = size > 1e-9
    u = u / np.where(fits, size, 1.0)[:, :, None]
    v = _cross(normals[:, None], u)
    area = _width(points, u.reshape(-1, 3)) * _width(points, v.reshape(-1, 3))
    k = np.where(fits, area.reshape(fits.shape), np.inf).argmin(axis=1)
    return [np.stack((normals[r], u[r, k[r]], v[r, k[r]])) for r in np.flatnonzero(fits.any(axis=1))]


def _width(points: np.ndarray, axes: np.ndarray) -> np.ndarray:
    """How far points (or each set of points) reach along axes."""
    local = points @ axes.swapaxes(-1, -2)
    return local.max(axis=-2) - local.min(axis=-2)


def _volumes(points: np.ndarray, first: np.ndarray, other: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Volumes and axes of the boxes of a first normal and another edge; points may be a
    set for each of the first axis of both."""
    second = _cross(first, other)
    size = np.linalg.norm(second, axis=-1)
    second = second / np.maximum(size, 1e-300)[..., None]
    axes = np.stack((first, second, _cross(first, second)), axis=-2)
    volume = _width(points, axes.reshape(*axes.shape[:-3], -1, 3)).reshape(axes.shape[:-1]).prod(axis=-1)
    return np.where(size > 1e-9, volume, np.inf), axes


def _between(a: np.ndarray, b: np.ndarray, t: np.ndarray) -> np.ndarray:
    n = (1 - t)[..., None] * a + t[..., None] * b
    return n / np.maximum(np.linalg.norm(n, axis=-1, keepdims=True), 1e-300)


def _best_pairs(points: np.ndarray, edges: np.ndarray, sides: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of the pairs of edges that may hold a box, those of the least sampled volumes (the last one
    again, if fewer): the normals of the first edge's faces, the second edge, and the sample's place.
    ``sides`` are the normals of each edge's two faces."""
    a, b = sides[:, 0], sides[:, 1]
    corners = np.stack([x @ y.T for x in (a, b) for y in (a, b)])
    i, j = np.nonzero((corners.min(axis=0) <= 1e-12) & (corners.max(axis=0) >= -1e-12) & ~np.eye(len(edges), dtype=bool))
    ts = np.linspace(0, 1, SAMPLES)
    step = max(1, (1 << 22) // (3 * len(points)))
    sampled = np.empty((SAMPLES, len(i)))
    for row, t in zip(sampled, ts):
        n = _between(a, b, np.full(len(a), t))
        for k in range(0, len(i), step):
            row[k : k + step] = _volumes(points, n[i[k : k + step]], edges[j[k : k + step]])[0]
    chosen = np.argsort(sampled.min(axis=0), kind="stable")[:NARROWED]
    chosen = np.r_[chosen, np.repeat(chosen[-1:], NARROWED - len(chosen))]
    return a[i[chosen]], b[i[chosen]], edges[j[chosen]], ts[sampled[:, chosen].argmin(axis=0)]


def _edge_pairs(sets: list[np.ndarray], pairs: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]) -> np.ndarray:
    """The axes of the best box of each set of points that two edges (``_best_pairs``) hold; all sets
    are narrowed down at once, with their first points again where others have more."""
    most = max(map(len, sets))
    points = np.stack([np.concatenate((s, np.repeat(s[:1], most - len(s), axis=0))) for s in sets])
    a, b, other, middle = (np.stack(c) for c in zip(*pairs))
    width = 1 / (SAMPLES - 1)
    low, high = np.clip(middle - width, 0, 1), np.clip(middle + width, 0, 1)
    sides = [np.concatenate((x, x), axis=1) for x in (a, b, other)]
    for _ in range(STEPS):
        x, y = high - _GOLD * (high - low), low + _GOLD * (high - low)
        both = _volumes(points, _between(*sides[:2], np.concatenate((x, y), axis=1)), sides[2])[0]
        less = both[:, : x.shape[1]] <= both[:, x.shape[1] :]
        low, high = np.where(less, low, x), np.where(less, y, high)
    volume, axes = _volumes(points, _between(*sides[:2], np.concatenate((middle, (low + high) / 2), axis=1)), sides[2])
    return axes[np.arange(len(sets)), volume.argmin(axis=1)]


Box = tuple[np.ndarray, np.ndarray, np.ndarray]


def least_box(points: np.ndarray) -> Box:
    """(centre, axes as columns, full extents) of a box of least volume."""
    return least_boxes([points])[0]


def least_boxes(sets: list[np.ndarray]) -> list[Box]:
    """The box of each set of points; what is iterative is done for all of them at once."""
    tried = [_tries(points) for points in sets]
    at = [k for k, (_, solid, _) in enumerate(tried) if solid is not None]
    if at:
        found = _edge_pairs([tried[k][1] for k in at], [tried[k][2] for k in at])
        for k, axes in zip(at, found):
            tried[k][0].append(axes)
    return [_least(points, np.stack(tries)) for points, (tries, _, _) in zip(sets, tried)]


def _least(points: np.ndarray, axes: np.ndarray) -> Box:
    """Of several axes (as rows) those of the least box: by volume, then by its largest face, then the first."""
    axes = axes * np.sign(np.linalg.det(axes))[:, None, None]  # a right-handed frame
    local = points @ axes.swapaxes(1, 2)
    low, high = local.min(axis=1), local.max(axis=1)
    size = high - low
    volume = size.prod(axis=1)
    at = np.flatnonzero(volume == volume.min()) if not np.isnan(volume[0]) else np.zeros(1, dtype=int)
    k = int(at[np.sort(size[at], axis=1)[:, 1:].prod(axis=1).argmin()])
    return (low[k] + high[k]) / 2 @ axes[k], axes[k].T, size[k]


def _tries(points: np.ndarray) -> tuple[list[np.ndarray], np.ndarray | None, tuple | None]:
    """Axes to try, and for a solid its corners and the pairs of edges to narrow down."""
    tri, normals = convex_hull(points)
    tries = [fit_box(points, 8)[1].T]
    if len(tri):
        used = np.unique(tri)
        solid = points[used]
        half = tri[:, [0, 1, 1, 2, 2, 0]].reshape(-1, 2)
        face = np.repeat(np.arange(len(tri)), 3)
        order = np.lexsort((half.max(axis=1), half.min(axis=1)))
        pairs = face[order].reshape(-1, 2)  # each edge is of two triangles
        ends = half[order][::2]
        bent = (normals[pairs[:, 0]] * normals[pairs[:, 1]]).sum(axis=1) < 1 - 1e-12
        edges = points[ends[bent, 1]] - points[ends[bent, 0]]
        edges /= np.linalg.norm(edges, axis=1, keepdims=True)
        tries += _rectangles(solid, np.unique(np.round(normals, 12), axis=0), edges)
        return tries, solid, _best_pairs(solid, edges, normals[pairs[bent]])
    # points of a plane, a line or a place: the least rectangle, if there is one
    span = _spanning(points, 1e-9 * max(float(np.ptp(points, axis=0).max()), 1e-300))
    if len(span) == 3:
        n = np.cross(points[span[1]] - points[span[0]], points[span[2]] - points[span[0]])
        few = points[_rim(points, n / np.linalg.norm(n))]
        edges = np.diff(np.vstack((few, few[:1])), axis=0)
        tries = _rectangles(few, (n / np.linalg.norm(n))[None], edges)
    elif len(span) == 2:
        u = points[span[1]] - points[span[0]]
        u /= np.linalg.norm(u)
        v = np.cross(u, np.eye(3)[int(np.abs(u).argmin())])
        v /= np.linalg.norm(v)
        tries = [np.stack((u, v, np.cross(u, v)))]
    return tries, None, None


def _rim(points: np.ndarray, normal: np.ndarray) -> list[int]:
    """Places of the corners of a plane set's hull, in turn."""
    u = np.cross(normal, np.eye(3)[int(np.abs(normal).argmin())])
    flat = points @ np.column_stack((u, np.cross(normal, u))) / np.linalg.norm(u)
    order = np.lexsort((flat[:, 1], flat[:, 0])).tolist()

    def chain(places: list[int]) -> list[int]:
        out: list[int] = []
        for p in places:
            while len(out) > 1:
                d, e = flat[out[-1]] - flat[out[-2]], flat[p] - flat[out[-1]]
                if d[0] * e[1] - d[1] * e[0] > 0:
                    break
                out.pop()
            out.append(p)
        return out[:-1]

    return chain(order) + chain(order[::-1])
