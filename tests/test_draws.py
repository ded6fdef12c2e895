"""Drawn triples against all triples in plain Python, with and without ties."""

import itertools
import random

import numpy as np
import pytest

from posegrid.functions import draws


def plain(first, second, key, a, b):
    number = lambda seed, *keys: draws._reduced(draws.hashed(np.array([seed]), *(np.array([k % draws.PRIME]) for k in keys)) ** 2)[0]
    ids = sorted({i for i, _ in a} | {i for i, _ in b}, key=lambda i: (number(first, *key, i), i))
    label, in_a, in_b = dict(a) | dict(b), {i for i, _ in a}, {i for i, _ in b}
    valid = [
        t for t in itertools.combinations(ids, 3)
        if len({label[i] for i in t}) == 3 and not in_a.issuperset(t) and not in_b.issuperset(t)
    ]
    return [i for t in sorted(valid, key=lambda t: (number(second, *key, *t), t))[: draws.MOST] for i in t]


@pytest.mark.parametrize("ties", [0, 3, 40])
def test_triples_equal_all_triples(monkeypatch, ties):
    if ties:
        monkeypatch.setattr(draws, "_reduced", lambda x: x % ties)
    rng = random.Random(ties)
    pairs = []
    for k in range(60):
        things = [(rng.randrange(1 << 40), rng.randrange(6)) for _ in range(rng.choice((0, 2, 3, 5, 9, 14)))]
        a = rng.sample(things, rng.randint(0, len(things)))
        b = [t for t in things if t not in a or rng.random() < 0.4]
        pairs.append(((k % 5, k, k + 1), a, b))
    columns = [np.array(c) for c in zip(*(p[0] for p in pairs))]
    held = [[np.array([t[f] for t in p[side]], dtype=np.int64) for p in pairs] for side, f in ((1, 0), (1, 1), (2, 0), (2, 1))]
    got = draws.triples(77, 12345, *columns, *held)
    assert got == [plain(77, 12345, *p) for p in pairs] and sum(map(len, got)) > 300


def test_folding_is_the_modulus():
    x = np.array([0, 1, draws.PRIME - 1, draws.PRIME, draws.PRIME + 1, 2 * draws.PRIME, (1 << 62) - 1, (draws.PRIME - 1) ** 2])
    assert (draws._reduced(x) == x % draws.PRIME).all()


@pytest.mark.parametrize("ties", [0, 2, 17])
def test_couples_equal_all_couples(monkeypatch, ties):
    if ties:
        monkeypatch.setattr(draws, "_reduced", lambda x: x % ties)
    rng = random.Random(ties)
    rows, want = [], []
    for k in range(80):
        a, b = ([(rng.randrange(40), rng.randrange(5)) for _ in range(rng.choice((0, 1, 3, 8, 20)))] for _ in range(2))
        a, b = (list(dict(x).items()) for x in (a, b))
        rows.append(((k % 3, k, k + 2), a, b))
        number = lambda *keys: draws._reduced(draws.hashed(np.array([99]), *(np.array([x % draws.PRIME]) for x in keys)) ** 2)[0]
        all_of = [(number(k % 3, k, k + 2, i, j), i, j) for i, x in a for j, y in b if i != j and x != y]
        want.append([x for t in sorted(all_of)[:3] for x in t[1:]])
    columns = [np.array(c) for c in zip(*(r[0] for r in rows))]
    held = [[np.array([t[f] for t in r[side]], dtype=np.int64) for r in rows] for side, f in ((1, 0), (1, 1), (2, 0), (2, 1))]
    assert draws.couples(99, 3, *columns, *held) == want and sum(map(len, want)) > 100
