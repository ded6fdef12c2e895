"""Hulls and boxes of least volume against exhaustive search over point pairs."""

import itertools

import numpy as np
import pytest

from posegrid.functions import hull, kernels


@pytest.mark.parametrize("seed", range(12))
def test_hull_is_the_supporting_planes(seed):
    rng = np.random.default_rng(seed)
    points = rng.normal(size=(40, 3)) if seed % 3 else rng.integers(0, 4, (40, 3)).astype(float)
    tri, normals = hull.convex_hull(points)
    away = points @ normals.T - (points[tri[:, 0]] * normals).sum(axis=1)
    assert away.max() < 1e-8  # all points are on the inner side
    corners = set(np.unique(tri).tolist())
    for i in range(len(points)):  # a point is a corner if some direction sees it alone
        others = np.delete(points, i, axis=0)
        if (points[i] != others).any(axis=1).all():
            sees = (points[i] @ normals.T >= (others @ normals.T).max(axis=0) + 1e-9).any()
            assert not sees or i in corners
    edges = [tuple(sorted(e)) for t in tri.tolist() for e in itertools.combinations(t, 2)]
    assert all(edges.count(e) == 2 for e in set(edges)) and len(corners) - len(set(edges)) + len(tri) == 2


def exhaustive(points, turns=721):
    """All pairs of lines between points, all turns about the first, narrowed twice."""
    lines = np.array([b - a for a, b in itertools.combinations(points, 2)])
    lines = lines / np.linalg.norm(lines, axis=1, keepdims=True)
    best = np.inf
    for e in lines:
        u = np.cross(e, np.eye(3)[np.abs(e).argmin()])
        u = u / np.linalg.norm(u)
        v = np.cross(e, u)

        def volume(angle, other):
            n = np.cos(angle)[..., None] * u + np.sin(angle)[..., None] * v
            m = np.cross(n, other)
            m = m / np.maximum(np.linalg.norm(m, axis=-1, keepdims=True), 1e-12)
            k = np.cross(n, m)
            return np.prod([np.ptp(x @ points.T, axis=-1) for x in (n, m, k)], axis=0)

        angle = np.linspace(0, np.pi, turns)
        grid = np.broadcast_to(angle[:, None], (turns, len(lines)))
        found = volume(grid, lines[None])
        for k in np.argsort(found.min(axis=0))[:6]:
            middle, width = angle[found[:, k].argmin()], np.pi / (turns - 1)
            for _ in range(5):
                near = np.linspace(middle - width, middle + width, 201)
                values = volume(near, lines[k][None])
                middle, width = near[values.argmin()], width / 50
                best = min(best, values.min())
    return best


@pytest.mark.parametrize("seed", range(8))
def test_least_volume_of_small_sets(seed):
    rng = np.random.default_rng(seed)
    points = rng.normal(size=(7 + seed % 3, 3)) * [3, 2, 1]
    center, axes, extents = hull.least_box(points)
    assert extents.prod() <= exhaustive(points) * (1 + 1e-6)
    assert np.allclose(axes.T @ axes, np.eye(3)) and np.linalg.det(axes) > 0
    assert (np.abs((points - center) @ axes) <= extents / 2 + 1e-9).all()


@pytest.mark.parametrize("seed", range(6))
def test_never_larger_than_the_angle_search(seed):
    rng = np.random.default_rng(seed)
    points = rng.normal(size=(300, 3)) @ rng.normal(size=(3, 3))
    for steps in (8, 24):
        assert hull.least_box(points)[2].prod() <= kernels.fit_box(points, steps)[2].prod() * (1 + 1e-9)


def test_turned_boxes_are_found():
    rng = np.random.default_rng(5)
    for _ in range(10):
        turn = kernels.orthonormal(rng.normal(size=(3, 3)))
        solid = kernels.corners(rng.normal(size=3), turn, np.array([5.0, 3.0, 1.0]))
        inner = solid.mean(axis=0) + rng.uniform(-0.5, 0.5, (60, 3)) * [5, 3, 1] @ turn.T
        assert np.sort(hull.least_box(np.vstack((solid, inner)))[2]) == pytest.approx([1, 3, 5])


def test_flat_straight_and_single_sets():
    rng = np.random.default_rng(6)
    turn = kernels.orthonormal(rng.normal(size=(3, 3)))
    square = np.array([[0, 0, 0], [2, 0, 0], [2, 1, 0], [0, 1, 0], [1, 0.5, 0]]) @ turn.T
    assert np.sort(hull.least_box(square)[2]) == pytest.approx([0, 1, 2], abs=1e-9)
    line = np.outer([0.0, 1.0, 5.0], turn[0])
    assert np.sort(hull.least_box(line)[2]) == pytest.approx([0, 0, 5], abs=1e-9)
    assert hull.least_box(np.ones((4, 3)))[2] == pytest.approx([0, 0, 0])
