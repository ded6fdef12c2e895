import random
import re

import numpy as np
import pytest

from posegrid.llm import minhash
from posegrid.llm.components import components


def shingle_set(text, size):
    w = re.findall(r"[^\x20\x09-\x0d]+", re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} or ({tuple(w)} if w else set())


def brute(rows, size, percent=80):
    sets = {d: shingle_set(t, size) for d, t in rows}
    ids = sorted(sets)
    root = {d: d for d in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, a in enumerate(ids):
        for b in ids[:k]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                u, v = sorted((find(a), find(b)))
                root[v] = u
    return {d: find(d) for d in ids}, {d: len(s) for d, s in sets.items()}


def corpus():
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    rows = []
    for _ in range(12):
        base = [word() for _ in range(rng.randrange(20, 120))]
        for _ in range(rng.randrange(1, 12)):
            copy = list(base)
            for _ in range(rng.randrange(0, max(1, len(base) // 15))):
                copy[rng.randrange(len(copy))] = word()
            rows.append((len(rows), " ".join(copy)))
    rows += [(1000, None), (1001, ""), (1002, " \n"), (1003, "one two"), (1004, "ONE  two"), (1005, "one"), (1006, "w " * 40_000)]
    return rows


@pytest.mark.parametrize("block", [4, 512])
@pytest.mark.parametrize("size", [4, 5])
def test_components_against_brute_force(spark, monkeypatch, block, size):
    monkeypatch.setattr(minhash, "BLOCK", block)
    rows = corpus()
    df = spark.createDataFrame([(*r, "k", 1) for r in rows], "doc_id long, text string, key string, node int")
    got = minhash.near_duplicates(df, shingle_words=size).collect()
    want, sizes = brute(rows, size)
    assert {r.doc_id: (r.component_id, r.n_shingles, r.kept) for r in got} == {d: (want[d], sizes[d], want[d] == d) for d in want}
    kept = {r.doc_id for r in minhash.keep_one(df, shingle_words=size).collect()}
    assert kept == {d for d in want if want[d] == d}


def test_null_and_repeated_ids(spark):
    text = "a b c d e f g"
    df = spark.createDataFrame([(None, text), (5, text), (5, text), (3, text), (None, None)], "doc_id long, text string")
    got = sorted(map(str, ((r.doc_id, r.component_id, r.kept) for r in minhash.near_duplicates(df).collect())))
    assert got == sorted(map(str, [(None, None, True), (None, None, True), (5, 3, False), (5, 3, False), (3, 3, True)]))
    assert minhash.near_duplicates(df.limit(0)).count() == 0 and minhash.keep_one(df.limit(0)).count() == 0


@pytest.mark.parametrize("n", [1, 2, 40, 900])
def test_sketches_fill_and_estimate(n):
    rng, errors = np.random.default_rng(n), []
    for _ in range(30):
        base = rng.integers(0, 2**63, n, dtype=np.uint64)
        k = max(1, int(0.9 * n))
        a, b = np.unique(base[:k]), np.unique(base[n - k :])
        x, y = minhash.sketch_many([a, b], 288)
        assert (x != minhash._TOP).all() and (y != minhash._TOP).all()
        errors.append((x == y).mean() - len(np.intersect1d(a, b)) / len(np.union1d(a, b)))
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.05


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, k) for k in range(101, 140)] + [(7, 7), (None, 3), (201, 200)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    want = {i: 0 for i in range(61)} | {k: 100 for k in range(100, 140)} | {200: 200, 201: 200}
    assert got == want
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0
