"""Iterative geometry that has no closed form, in numpy; one group at a time."""

from __future__ import annotations

import functools
import itertools
import math

import numpy as np

#: Corner order: signs of x, y and z, the last one fastest.
SIGNS = np.array(list(itertools.product((-1.0, 1.0), repeat=3)))


def orthonormal(m: np.ndarray) -> np.ndarray:
    """The nearest rotation."""
    u, _, v = np.linalg.svd(m)
    return u @ np.diag([1.0, 1.0, np.sign(np.linalg.det(u @ v))]) @ v


def corners(center: np.ndarray, axes: np.ndarray, extents: np.ndarray) -> np.ndarray:
    return center + (SIGNS * (extents / 2)) @ axes.T


def pca_box(points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(centre, axes as columns, full extents) along the principal axes."""
    mean = points.mean(axis=0)
    _, vectors = np.linalg.eigh(np.cov((points - mean).T, bias=True))
    axes = orthonormal(vectors[:, ::-1])
    return _enclose(points, axes)


def _enclose(points: np.ndarray, axes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    local = points @ axes
    low, high = local.min(axis=0), local.max(axis=0)
    return axes @ ((low + high) / 2), axes, high - low


def fit_box(points: np.ndarray, steps: int = 24) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A small oriented box: the principal axes and the world's as seeds, each
    turned about each of its axes in steps that narrow.  Approximate."""
    best = min((_enclose(points, np.eye(3)), pca_box(points)), key=lambda b: b[2].prod())
    width = np.pi / 4
    for _ in range(6):
        axes = best[1] @ _turns(width, steps)
        local = points @ axes  # all turns at once
        low, high = local.min(axis=1), local.max(axis=1)
        volume = (high - low).prod(axis=1)
        k = int(volume.argmin())
        if volume[k] < best[2].prod():
            best = axes[k] @ ((low[k] + high[k]) / 2), axes[k], high[k] - low[k]
        width /= 3
    return best


@functools.lru_cache(maxsize=64)
def _turns(width: float, steps: int) -> np.ndarray:
    """Rotations about each axis by each of some angles up to a width, one after another."""
    angles = np.linspace(-width, width, steps)
    c, s = np.cos(angles), np.sin(angles)
    turns = np.zeros((3, len(angles), 3, 3))
    for axis in range(3):
        i, j = [k for k in range(3) if k != axis]
        turns[axis, :, axis, axis] = 1.0
        turns[axis, :, i, i], turns[axis, :, i, j], turns[axis, :, j, i], turns[axis, :, j, j] = c, -s, s, c
    return turns.reshape(-1, 3, 3)


Point = tuple[float, float, float]


def _clip(faces: list[list[Point]], normal: Point, limit: float) -> list[list[Point]]:
    """The part of a convex solid on the inner side of a plane, in plain numbers: faces have a few corners."""
    nx, ny, nz = normal
    sides = [[x * nx + y * ny + z * nz for x, y, z in face] for face in faces]
    if max(map(max, sides)) <= limit + 1e-12:
        return faces
    out, rim = [], []
    for face, side in zip(faces, sides):
        side = [0.0 if abs(s - limit) < 1e-12 else s - limit for s in side]
        kept = []
        a, da = face[-1], side[-1]
        for b, db in zip(face, side):  # the edge from a to b, then b
            if (da < 0 < db) or (db < 0 < da):
                t = da / (da - db)
                cut = (a[0] + (b[0] - a[0]) * t, a[1] + (b[1] - a[1]) * t, a[2] + (b[2] - a[2]) * t)
                kept.append(cut)
                rim.append(cut)
            if db <= 0:
                kept.append(b)
                if db == 0:
                    rim.append(b)
            a, da = b, db
        if len(kept) > 2 and min(side) < 0:
            out.append(kept)
    if len(rim) > 2:
        rim = sorted({(round(x, 12), round(y, 12), round(z, 12)) for x, y, z in rim})
        if len(rim) > 2:
            n = len(rim)
            mx, my, mz = (sum(p[k] for p in rim) / n for k in range(3))
            ux, uy, uz = rim[0][0] - mx, rim[0][1] - my, rim[0][2] - mz
            vx, vy, vz = ny * uz - nz * uy, nz * ux - nx * uz, nx * uy - ny * ux
            turn = lambda p: math.atan2((p[0] - mx) * vx + (p[1] - my) * vy + (p[2] - mz) * vz, (p[0] - mx) * ux + (p[1] - my) * uy + (p[2] - mz) * uz)
            out.append(sorted(rim, key=turn))
    return out


def _clip_flat(faces: list[np.ndarray], normal: np.ndarray, limit: float) -> list[np.ndarray]:
    """As ``_clip``, in arrays."""
    if max(float((face @ normal).max()) for face in faces) <= limit + 1e-12:
        return faces
    out, rim = [], []
    for face in faces:
        side = face @ normal - limit
        side[np.abs(side) < 1e-12] = 0.0
        kept = []
        for k in range(len(face)):
            a, b, da, db = face[k], face[(k + 1) % len(face)], side[k], side[(k + 1) % len(face)]
            if da <= 0:
                kept.append(a)
            if (da < 0 < db) or (db < 0 < da):
                cut = a + (b - a) * (da / (da - db))
                kept.append(cut)
                rim.append(cut)
            elif da == 0:
                rim.append(a)
        if len(kept) > 2 and side.min() < 0:
            out.append(np.array(kept))
    if len(rim) > 2:
        rim = np.unique(np.round(np.array(rim), 12), axis=0)
        if len(rim) > 2:
            mid = rim.mean(axis=0)
            u = rim[0] - mid
            v = np.cross(normal, u)
            turn = np.arctan2((rim - mid) @ v, (rim - mid) @ u)
            out.append(rim[np.argsort(turn)])
    return out


_FACES = [[0, 1, 3, 2], [4, 5, 7, 6], [0, 1, 5, 4], [2, 3, 7, 6], [0, 2, 6, 4], [1, 3, 7, 5]]


def intersection_volume(a, b) -> float:
    """Volume shared by two oriented boxes: one is clipped by the other's six
    half-spaces, and cones from its middle to its faces are summed."""
    (ca, ra, ea), (cb, rb, eb) = a, b
    if np.linalg.norm(ca - cb) > (np.linalg.norm(ea) + np.linalg.norm(eb)) / 2:
        return 0.0
    if min(ea.min(), eb.min()) <= 1e-9 * max(ea.max(), eb.max()):
        return _flat_volume(a, b)
    solid = list(map(tuple, corners(ca, ra, ea).tolist()))
    faces = [[solid[k] for k in f] for f in _FACES]
    center, half = np.asarray(cb, dtype=float).tolist(), (np.asarray(eb, dtype=float) / 2).tolist()
    for k, axis in enumerate(np.asarray(rb, dtype=float).T.tolist()):
        for sign in (1.0, -1.0):
            normal = (sign * axis[0], sign * axis[1], sign * axis[2])
            faces = _clip(faces, normal, sum(n * c for n, c in zip(normal, center)) + half[k])
            if not faces:
                return 0.0
    every = [p for face in faces for p in face]
    mx, my, mz = (sum(p[k] for p in every) / len(every) for k in range(3))
    volume = 0.0
    for face in faces:
        moved = [(x - mx, y - my, z - mz) for x, y, z in face]
        ax, ay, az = moved[0]
        for (bx, by, bz), (cx, cy, cz) in zip(moved[1:], moved[2:]):
            volume += abs(ax * (by * cz - bz * cy) - ay * (bx * cz - bz * cx) + az * (bx * cy - by * cx)) / 6
    return volume


def _flat_volume(a, b) -> float:
    """As ``intersection_volume``, for boxes without thickness, whose volumes are of the order of what
    is rounded off: these sums are not to be done in another order."""
    (ca, ra, ea), (cb, rb, eb) = a, b
    solid = corners(ca, ra, ea)
    faces = [solid[f] for f in _FACES]
    for k in range(3):
        for sign in (1.0, -1.0):
            normal = sign * rb[:, k]
            faces = _clip_flat(faces, normal, float(normal @ cb) + eb[k] / 2)
            if not faces:
                return 0.0
    mid = np.concatenate(faces).mean(axis=0)
    volume = 0.0
    for face in faces:
        for k in range(1, len(face) - 1):
            volume += abs(np.linalg.det(np.stack((face[0] - mid, face[k] - mid, face[k + 1] - mid)))) / 6
    return float(volume)


def overlap_ratio(a, b) -> float:
    smaller = min(a[2].prod(), b[2].prod())
    return intersection_volume(a, b) / smaller if smaller > 0 else 0.0


def trim(points: np.ndarray, share: float = 0.1) -> np.ndarray:
    """Drop the tenth of the points with the largest robust z-score."""
    n = len(points)
    if n < 5:
        return points
    off = np.abs(points - np.median(points, axis=0))
    z = 0.6745 * off / np.maximum(np.median(off, axis=0), 1e-6)
    keep = np.argsort(z.max(axis=1), kind="stable")[: n - max(1, round(share * n))]
    return points[np.sort(keep)]


def align(axes: np.ndarray, extents: np.ndarray, up: np.ndarray, points: np.ndarray | None = None):
    """Turn a box so that its nearest axis is ``up`` and its heading stays;
    extents are carried over, or enclose ``points`` (relative to the centre)."""
    dots = axes.T @ up
    top = int(np.abs(dots).argmax())
    z = up if dots[top] >= 0 else -up
    flat = axes - np.outer(z, z @ axes)
    others = [k for k in range(3) if k != top]
    first, second = sorted(others, key=lambda k: -np.linalg.norm(flat[:, k]))
    x = flat[:, first]
    if np.linalg.norm(x) < 1e-8:
        x = np.eye(3)[int(np.abs(z).argmin())]
        x = x - (x @ z) * z
    x = x / np.linalg.norm(x)
    y = np.cross(z, x)
    if y @ axes[:, second] < 0:
        x, y = -x, -y
    turned = orthonormal(np.column_stack((x, y, z)))
    if points is None:
        return turned, extents[[first, second, top]]
    return turned, 2 * np.abs(points @ turned).max(axis=0)


def greedy_keep(iou: np.ndarray, scores: np.ndarray, limit: float) -> list[int]:
    """Suppression: by score (first among equals), keep what overlaps no kept
    one beyond the limit."""
    kept: list[int] = []
    free = iou <= limit  # what is not comparable is beyond it
    left = np.ones(len(scores), dtype=bool)
    for i in np.argsort(-scores, kind="stable").tolist():
        if left[i]:
            kept.append(i)
            left &= free[:, i]
    return kept


def _paths(c: np.ndarray) -> np.ndarray:
    """The row (from 1) of each column (from 1), or 0."""
    n, m = c.shape
    u, v = np.zeros(n + 1), np.zeros(m + 1)
    match, way = np.zeros(m + 1, dtype=int), np.zeros(m + 1, dtype=int)
    for row in range(1, n + 1):
        match[0], at = row, 0
        least, done = np.full(m + 1, np.inf), np.zeros(m + 1, dtype=bool)
        while match[at]:
            done[at] = True
            i = match[at]
            slack = c[i - 1] - u[i] - v[1:]
            better = ~done[1:] & (slack < least[1:])
            least[1:][better], way[1:][better] = slack[better], at
            nxt = 1 + int(np.where(done[1:], np.inf, least[1:]).argmin())
            step = least[nxt]
            u[match[done]] += step
            v[done] -= step
            least[1:][~done[1:]] -= step
            at = nxt
        while at:
            match[at], at = match[way[at]], way[at]
    return match


def _few_paths(c: list[list[float]], n: int, m: int) -> list[int]:
    """As ``_paths``, step by step."""
    u, v = [0.0] * (n + 1), [0.0] * (m + 1)
    match, way = [0] * (m + 1), [0] * (m + 1)
    for row in range(1, n + 1):
        match[0], at = row, 0
        least, done = [math.inf] * (m + 1), [False] * (m + 1)
        while match[at]:
            done[at] = True
            i = match[at]
            costs, ui, nxt, step = c[i - 1], u[i], 0, math.inf
            for j in range(1, m + 1):
                if not done[j]:
                    slack = costs[j - 1] - ui - v[j]
                    if slack < least[j]:
                        least[j], way[j] = slack, at
                    if least[j] < step:
                        nxt, step = j, least[j]
            for j in range(m + 1):
                if done[j]:
                    u[match[j]] += step
                    v[j] -= step
                else:
                    least[j] -= step
            at = nxt
        while at:
            match[at], at = match[way[at]], way[at]
    return match


def assign(cost: np.ndarray) -> list[tuple[int, int]]:
    """Least-cost one-to-one assignment, by shortest augmenting paths."""
    turned = cost.shape[0] > cost.shape[1]
    c = cost.T if turned else cost
    n, m = c.shape
    if n * m > 1024:
        match = _paths(c)
    else:  # plain numbers are faster than arrays of a few
        match = _few_paths(c.tolist(), n, m)
    pairs = [(match[j] - 1, j - 1) for j in range(1, m + 1) if match[j]]
    return sorted((b, a) if turned else (a, b) for a, b in pairs)


def box_iou(a: np.ndarray, b: np.ndarray, over: str = "union") -> np.ndarray:
    """Pairwise overlap of xyxy boxes over the union or the smaller one."""
    low = np.maximum(a[:, None, :2], b[None, :, :2])
    high = np.minimum(a[:, None, 2:], b[None, :, 2:])
    inter = np.clip(high - low, 0, None).prod(axis=2)
    size = lambda x: np.clip(x[:, 2:] - x[:, :2], 0, None).prod(axis=1)
    if over == "least":
        return inter / np.maximum(np.minimum(size(a)[:, None], size(b)[None]), 1e-12)
    return inter / np.maximum(size(a)[:, None] + size(b)[None] - inter, 1e-12)


Fused = tuple[list[int], np.ndarray, tuple]


def fuse(tracks: list[np.ndarray], limit: float, every: bool = False) -> list[list[int]]:
    """The members of each group of ``fused``."""
    return [g[0] for g in fused(tracks, limit, every)]


def fused(tracks: list[np.ndarray], limit: float, every: bool = False) -> list[Fused]:
    """Online greedy fusion of point sets, in order: each joins the best-
    overlapping group (or all beyond the limit), which moves to the end."""
    groups: list[Fused] = []
    for i, points in enumerate(tracks):
        box = fit_box(points, 8)
        ratios = [overlap_ratio(box, g[2]) for g in groups]
        hits = [k for k, r in enumerate(ratios) if r >= limit]
        if hits and not every:
            hits = [max(hits, key=lambda k: (ratios[k], -k))]
        members, together = [i], points
        for k in hits:
            members, together = groups[k][0] + members, np.concatenate((groups[k][1], together))
        groups = [g for k, g in enumerate(groups) if k not in hits]
        groups.append((members, together, fit_box(together, 8) if hits else box))
    return groups


def merge_to_fixpoint(tracks: list[np.ndarray], limit: float) -> list[list[int]]:
    """The members of each group of ``merged``, of point sets."""
    return [g[0] for g in merged([([i], p, fit_box(p, 8)) for i, p in enumerate(tracks)], limit)]


def merged(groups: list[Fused], limit: float) -> list[Fused]:
    """Merge the strongest pair (first among equals) until none reaches the
    limit; only the merged group's row of the pair matrix is worked out anew."""
    groups = list(groups)
    n = len(groups)
    ratio = np.full((n, n), -1.0)
    for i, j in itertools.combinations(range(n), 2):
        ratio[i, j] = overlap_ratio(groups[i][2], groups[j][2])
    alive = list(range(n))
    while len(alive) > 1:
        i, j = np.unravel_index(ratio.argmax(), ratio.shape)
        if ratio[i, j] < limit:
            break
        points = np.concatenate((groups[i][1], groups[j][1]))
        groups[i] = (groups[i][0] + groups[j][0], points, fit_box(points, 8))
        ratio[j], ratio[:, j] = -1.0, -1.0
        alive.remove(j)
        for k in alive:
            if k != i:
                ratio[min(i, k), max(i, k)] = overlap_ratio(groups[i][2], groups[k][2])
    return [groups[i] for i in alive]


def sample_pairs(pairs: list[tuple], order, most: int) -> list[tuple]:
    """Greedy non-repeating pairs: frames in a drawn order, partners in a drawn
    order; an accepted pair marks both frames used, but the inner loop goes on
    without testing its own frame again."""
    partners: dict = {}
    for a, b, *rest in pairs:
        partners.setdefault(a, []).append((b, *rest))
    used, out = set(), []
    for a in sorted(partners, key=lambda x: order("i", x)):
        if a in used:
            continue
        for b, *rest in sorted((x for x in partners[a] if x[0] not in used), key=lambda x: order("j", a, x[0])):
            out.append((a, b, *rest))
            used.update((a, b))
            if len(out) >= most:
                return out
    return out
