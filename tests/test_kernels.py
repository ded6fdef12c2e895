import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from posegrid.functions import kernels as k_
from posegrid.functions import kernels as k
from posegrid.functions import rle

UNIT = (np.zeros(3), np.eye(3), np.ones(3))


def turned(angle):
    c, s = np.cos(angle), np.sin(angle)
    return np.array([[c, -s, 0], [s, c, 0], [0, 0, 1.0]])


def test_overlap_of_shifted_and_turned_cubes():
    half = (np.array([0.5, 0, 0]), np.eye(3), np.ones(3))
    assert k.overlap_ratio(UNIT, half) == pytest.approx(0.5)
    assert k.overlap_ratio(UNIT, UNIT) == pytest.approx(1.0)
    assert k.overlap_ratio(UNIT, (np.array([3.0, 0, 0]), np.eye(3), np.ones(3))) == 0
    octagon = (np.zeros(3), turned(np.pi / 4), np.ones(3))
    assert k.intersection_volume(UNIT, octagon) == pytest.approx(2 * (np.sqrt(2) - 1))


@settings(max_examples=20, deadline=None)
@given(st.integers(0, 10_000))
def test_overlap_against_sampling(seed):
    rng = np.random.default_rng(seed)
    a, b = ((rng.uniform(-0.5, 0.5, 3), k.orthonormal(rng.normal(size=(3, 3))), rng.uniform(0.5, 2, 3)) for _ in range(2))
    p = a[0] + rng.uniform(-0.5, 0.5, (20_000, 3)) * a[2] @ a[1].T
    inside = (np.abs((p - b[0]) @ b[1]) <= b[2] / 2).all(axis=1).mean() * a[2].prod()
    assert k.intersection_volume(a, b) == pytest.approx(inside, abs=0.08)


@settings(max_examples=20, deadline=None)
@given(st.integers(0, 10_000))
def test_fitted_box_holds_its_points(seed):
    rng = np.random.default_rng(seed)
    points = rng.uniform(-0.5, 0.5, (200, 3)) * [3, 2, 1] @ k.orthonormal(rng.normal(size=(3, 3))).T
    center, axes, extents = k.fit_box(points)
    assert (np.abs((points - center) @ axes) <= extents / 2 + 1e-9).all()
    assert extents.prod() <= np.ptp(points, axis=0).prod() + 1e-9 and extents.prod() < 6 * 1.5


def test_align_keeps_heading_and_permutes_extents():
    axes, extents = k.align(turned(0.3) @ np.eye(3)[:, [2, 0, 1]], np.array([3.0, 1, 2]), np.array([0, 0, 1.0]))
    assert np.abs(axes[:, 2]) == pytest.approx([0, 0, 1]) and sorted(extents) == [1, 2, 3] and extents[2] == 3


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 5), st.integers(1, 5), st.integers(0, 1000))
def test_assignment_is_least(n, m, seed):
    from itertools import permutations

    cost = np.random.default_rng(seed).random((n, m))
    got = sum(cost[i, j] for i, j in k.assign(cost))
    small, big = (cost, m) if n <= m else (cost.T, n)
    assert got == pytest.approx(min(sum(small[i, p[i]] for i in range(len(small))) for p in permutations(range(big), len(small))))


def test_trim_drops_the_far_tenth():
    points = np.concatenate((np.random.default_rng(0).normal(size=(95, 3)), np.full((5, 3), 50.0)))
    assert k.trim(points).max() < 10 and len(k.trim(points)) == 90 and len(k.trim(points[:4])) == 4


def test_fusion_reaches_a_fixpoint():
    rng = np.random.default_rng(1)
    sets = [rng.uniform(0, 1, (50, 3)) + [c, 0, 0] for c in (0, 0.1, 5, 5.1, 0.05)]
    assert sorted(map(sorted, k.fuse(sets, 0.3))) == [[0, 1, 4], [2, 3]]
    assert sorted(map(sorted, k.merge_to_fixpoint(sets, 0.3))) == [[0, 1, 4], [2, 3]]


def test_suppression_leaves_no_overlap():
    rng = np.random.default_rng(2)
    low = rng.uniform(0, 5, (60, 2))
    boxes = np.concatenate((low, low + rng.uniform(0.5, 2, (60, 2))), axis=1)
    iou = k.box_iou(boxes, boxes)
    kept = k.greedy_keep(iou, rng.random(60), 0.1)
    assert (np.triu(iou[np.ix_(kept, kept)], 1) <= 0.1).all()


@settings(max_examples=100, deadline=None)
@given(st.integers(1, 9), st.integers(1, 9), st.integers(0, 1000))
def test_mask_codec(h, w, seed):
    mask = np.random.default_rng(seed).random((h, w)) < 0.5
    counts = rle.from_mask(mask)
    assert (rle.to_mask(counts, h, w) == mask).all()
    assert rle.decode_counts(rle.encode_counts(counts)) == counts
    big = [100_000, 3, 7, 90_000, 1]
    assert rle.decode_counts(rle.encode_counts(big)) == big


def test_components_and_cleaning():
    mask = np.array([[1, 1, 0, 0, 1], [1, 0, 0, 0, 1], [1, 1, 1, 0, 0], [1, 0, 1, 0, 1], [1, 1, 1, 0, 0]], dtype=bool)
    labels, areas = rle.label_components(mask)
    assert len(np.unique(labels)) == 4 and areas[0, 0] == 11 and areas[3, 4] == 1
    clean = rle.fill_and_clean(mask, 2)
    assert clean[3, 1] and not clean[3, 4] and not clean[0, 4]


def test_assignments_of_few_are_those_of_arrays():
    rng = np.random.default_rng(5)
    for n, m in [(1, 1), (1, 5), (4, 4), (3, 9), (8, 8)] * 20:
        cost = rng.integers(0, 6, (n, m)) / 5  # many ties
        assert k_._few_paths(cost.tolist(), n, m)[1:] == k_._paths(cost)[1:].tolist()


def test_suppression_looks_at_a_kept_box_once():
    class Counted(np.ndarray):
        n = 0

        def max(self, *args, **kwargs):
            Counted.n += 1
            return super().max(*args, **kwargs)

    like = np.eye(50).view(Counted)
    assert k_.greedy_keep(like, np.arange(50.0), 0.1) == list(range(49, -1, -1)) and Counted.n == 0
