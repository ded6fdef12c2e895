"""Cross products of rows, to the last bit as numpy's."""

import numpy as np

from posegrid.functions import hull


def test_cross_products():
    rng = np.random.default_rng(2)
    a, b = rng.normal(size=(2, 500, 3))
    assert (hull._cross(a, b) == np.cross(a, b)).all() and (hull._cross(a[0], b) == np.cross(a[0], b)).all()
