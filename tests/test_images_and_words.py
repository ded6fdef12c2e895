"""Image measures, error points and vocabularies against plain loops."""

import numpy as np
import pytest

from posegrid.functions import rasters, rle
from posegrid.operators import images, vocabulary


def plain_ssim(a, b):
    weight = [np.exp(-((k - 5) ** 2) / 4.5) for k in range(11)]
    weight = np.outer(weight, weight) / np.sum(weight) ** 2
    total = 0.0
    for y in range(a.shape[0]):
        for x in range(a.shape[1]):
            s = np.zeros(5)
            for i in range(11):
                for j in range(11):
                    v, u = y + i - 5, x + j - 5
                    if 0 <= v < a.shape[0] and 0 <= u < a.shape[1]:
                        p, q = a[v, u], b[v, u]
                        s += weight[i, j] * np.array([p, q, p * p, q * q, p * q])
            mp, mq, pp, qq, pq = s
            total += (2 * mp * mq + 1e-4) * (2 * (pq - mp * mq) + 9e-4) / ((mp**2 + mq**2 + 1e-4) * (pp - mp**2 + qq - mq**2 + 9e-4))
    return total / a.size


def test_likeness_equals_loops():
    rng = np.random.default_rng(1)
    for shape in ((9, 14), (3, 3), (20, 5)):
        a, b = rng.random(shape), rng.random(shape)
        assert rasters.ssim(a, b) == pytest.approx(plain_ssim(a, b), abs=1e-12)
        local = rasters.lncc(a, b, 3)
        for y in range(shape[0] - 2):
            for x in range(shape[1] - 2):
                p, q = a[y : y + 3, x : x + 3].ravel(), b[y : y + 3, x : x + 3].ravel()
                cross, vp, vq = ((p - p.mean()) * (q - q.mean())).sum(), ((p - p.mean()) ** 2).sum(), ((q - q.mean()) ** 2).sum()
                assert local[y, x] == pytest.approx(min(2, max(0, 1 - cross**2 / (vp * vq + 1e-8))), abs=1e-9)
        grad = rasters.gradient_weights(a)
        steep = {(y, x): max(abs(a[y, x + 1] - a[y, x - 1]), abs(a[y + 1, x] - a[y - 1, x])) for y in range(1, shape[0] - 1) for x in range(1, shape[1] - 1)}
        low, high = min(steep.values()), max(steep.values())
        for (y, x), v in steep.items():
            assert grad[y, x] == pytest.approx((v - low) / (high - low) if high > low else 0)
    assert rasters.ssim(a, a) == pytest.approx(1) and (rasters.gradient_weights(np.ones((4, 4)))[1:-1, 1:-1] == 0).all()


def plain_distance(mask):
    out = np.full(mask.shape, np.inf)
    off = np.argwhere(~mask)
    for y in range(mask.shape[0]):
        for x in range(mask.shape[1]):
            if len(off):
                out[y, x] = ((off - [y, x]) ** 2).sum(axis=1).min()
    return out


@pytest.mark.parametrize("seed", range(20))
def test_distances_and_error_points_equal_brute_force(seed):
    rng = np.random.default_rng(seed)
    shape = tuple(rng.integers(1, 25, 2))
    truth, guess = (rng.random(shape) < p for p in rng.choice([0, 0.2, 0.8, 0.95, 1], 2))
    assert (rasters.squared_distances(truth) == plain_distance(truth)).all()
    deep = [plain_distance(np.pad(e, 1))[1:-1, 1:-1] for e in (truth & ~guess, ~truth & guess)]
    label = int(deep[0].max() > deep[1].max())
    best = deep[0] if label else deep[1]
    y, x = np.argwhere(best == best.max())[0]
    assert rasters.error_point(truth, guess) == (x, y, label)


def test_images_of_odd_shape(spark):
    rows = [(1, 2, [1.0, 2.0, 3.0, 4.0], [1.0, 2.0, 3.0, 4.0]), (2, 2, [1.0], [1.0]), (3, None, [1.0], [1.0]), (4, 1, None, [1.0]), (5, 2, [1.0, None], [1.0, 2.0]), (6, 2, [], [])]
    got = {r.image_id: r for r in images.image_metrics(spark.createDataFrame(rows, "image_id long, width long, a array<double>, b array<double>")).collect()}
    assert got[1].ssim == pytest.approx(1) and got[1].mse == 0 and got[1].lncc is None and got[1].gradient == 1
    assert all(got[k].ssim is None for k in range(2, 7))
    masks = [(1, 3, rle.from_mask(np.ones((3, 3), bool)), None), (2, 3, None, None), (3, 2, [0, 4], [0, 2, 1])]
    points = {r.image_id: (r.x, r.y, r.label) for r in images.error_points(spark.createDataFrame(masks, "image_id long, height long, truth array<long>, guess array<long>")).collect()}
    assert points == {1: (1, 1, 1), 2: (0, 0, 0), 3: (1, 0, 1)}


def test_vocabulary_equals_a_loop(spark):
    rng = np.random.default_rng(3)
    names = ["Chair", "sofa-bed", "tv 42", "lamp;shade", "", "###"]
    rows = [(s, f, [names[k] for k in rng.integers(0, 6, rng.integers(0, 4))]) for s in range(5) for f in range(30)]
    df = spark.createDataFrame(rows + [(None, 1, ["x"])], "scene_id long, frame_idx long, hint array<string>").repartition(7)

    def model():
        return lambda row, prompt: None if len(row["hint"]) == 0 else f"{', '.join(row['hint'])}\n{'more' if len(prompt) > 4 else ''}"

    got = {(r.scene_id, r.frame_idx): (r.prompt, r.labels) for r in vocabulary.vocabulary(df, model).collect()}
    for s in range(5):
        known = set()
        for f in range(30):
            hint = next(h for a, b, h in rows if (a, b) == (s, f))
            labels = []
            if hint:
                text = ", ".join(hint) + "\n" + ("more" if len(known) > 4 else "")
                labels = sorted(set(vocabulary.parse(text)) | {"wall", "floor", "ceiling"})
            assert got[s, f] == (sorted(known), labels)
            known |= set(labels)
    assert len(got) == 150
    scenes = vocabulary.scene_vocabulary(vocabulary.vocabulary(df, model)).collect()
    assert all(r.categories == sorted(r.categories) and "wall" in r.categories for r in scenes) and len(scenes) == 5


def test_parse():
    assert vocabulary.parse("A chair, 2 Sofa-Beds;\nlamp.") == ["a chair", "sofa-beds", "lamp"]
    assert vocabulary.parse("") == [] and vocabulary.parse(",,;") == []
