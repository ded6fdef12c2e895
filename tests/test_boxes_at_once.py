"""Boxes of many groups are narrowed down at once; fused groups keep the boxes they have."""

import numpy as np
import pytest

from posegrid.functions import hull, kernels
from posegrid.operators import groups


def test_many_boxes_take_the_steps_of_one(monkeypatch):
    rng = np.random.default_rng(3)
    sets = [rng.normal(size=(n, 3)) * (9, 4, 1) for n in (12, 30, 5, 21)] + [np.c_[rng.normal(size=(6, 2)), np.zeros(6)], np.outer(np.arange(4.0), (1, 2, 3))]
    alone = [hull.least_box(s) for s in sets]
    steps, plain = [], hull._between
    monkeypatch.setattr(hull, "_between", lambda *a: steps.append(1) or plain(*a))
    together = hull.least_boxes(sets)
    assert len(steps) == 4 * hull.SAMPLES + hull.STEPS + 1
    for s, (c, axes, size), (c2, axes2, size2) in zip(sets, alone, together):
        assert np.allclose(c, c2) and np.allclose(axes, axes2) and np.allclose(size, size2)
        assert (np.abs((s - c2) @ axes2) <= size2 / 2 + 1e-9).all()


def test_fused_groups_keep_their_boxes(monkeypatch):
    rng = np.random.default_rng(5)
    sets = [rng.normal(size=(8, 3)) + at for at in (0, 0, 40, 40, 80)]
    seen, plain = [], kernels.fit_box
    monkeypatch.setattr(kernels, "fit_box", lambda points, steps: seen.append(points.tobytes()) or plain(points, steps))
    found = kernels.merged(kernels.fused(sets, 0.1), 0.1)
    assert len(seen) == len(set(seen))
    for members, points, box in found:
        assert (points == np.concatenate([sets[i] for i in members])).all()
        assert all((x == y).all() for x, y in zip(box, plain(points, 8)))


def test_points_without_a_group_are_one(spark):
    rows = [(g, p, float(x), float(x * x % 7), float(p + x % 3)) for g in (None, 4) for p in (0, 1) for x in range(6)]
    made = groups.fuse_instances(spark.createDataFrame(rows, "group_id long, item_pos long, x double, y double, z double")).collect()
    assert {r.group_id for r in made} == {None, 4} and len({tuple(r[1:]) for r in made}) * 2 == len(made)


def test_shared_volume_of_turned_boxes():
    s = 0.5**0.5
    turned = np.array([[s, -s, 0.0], [s, s, 0.0], [0.0, 0.0, 1.0]])
    a, b = (np.zeros(3), np.eye(3), np.full(3, 2.0)), (np.zeros(3), turned, np.full(3, 2.0))
    assert kernels.intersection_volume(a, b) == pytest.approx(2 * 8 * (2**0.5 - 1))  # a regular octagon, two high
    assert kernels.intersection_volume(a, a) == pytest.approx(8) and kernels.overlap_ratio(a, (np.array([1.0, 0, 0]), *a[1:])) == pytest.approx(0.5)
    flat = (np.zeros(3), np.eye(3), np.array([2.0, 2.0, 0.0]))
    assert kernels.intersection_volume(flat, a) == 0
