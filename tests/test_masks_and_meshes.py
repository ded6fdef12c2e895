"""The run sweep against pixels, components against union-find."""

import random

import duckdb
import numpy as np
import pytest

from posegrid.functions import rle
from posegrid.operators import components, masks, raster_queries

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages conversations".split()


@pytest.mark.parametrize("name", list(raster_queries.QUERIES))
def test_twins_agree(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    twin = con.sql(raster_queries.oracle_sql()[name])
    rows = lambda names, held: sorted(str([dict(zip(names, r))[c] for c in sorted(names)]) for r in held)
    got = raster_queries.QUERIES[name](spark, SF)
    want = rows(twin.columns, twin.fetchall())
    assert rows(got.columns, got.collect()) == want and len(want) > 50


def rasters(rng, n):
    shapes = [rng.random((9, 11)) < p for p in rng.choice([0, 0.1, 0.5, 0.9, 1], n)]
    return shapes, [float(s) for s in rng.choice([0.2, 0.5, 0.9], n)]  # with ties


def test_sweep_equals_rasters(spark):
    rng = np.random.default_rng(4)
    rows, truth = [], {}
    for frame in range(6):
        shapes, scores = rasters(rng, 7)
        truth[frame] = (shapes, scores)
        rows += [(frame, k, s, rle.from_mask(m)) for k, (m, s) in enumerate(zip(shapes, scores))]
    df = spark.createDataFrame(rows + [(7, 1, None, None), (7, 2, 0.5, []), (7, 3, None, [2, 3])], "frame_id long, mask_id long, score double, counts array<long>")
    got = {(r.frame_id, r.mask_id): r for r in masks.non_overlapping(df).collect()}
    pairs = {(r.frame_id, r.a, r.b): r for r in masks.mask_pairs(df).collect()}
    for frame, (shapes, scores) in truth.items():
        stack = np.array(shapes)
        best = np.full(stack.shape[1:], -1)
        for k in sorted(range(7), key=lambda k: (-scores[k], k))[::-1]:
            best[stack[k]] = k
        for k in range(7):
            r = got[frame, k]
            kept = best == k
            assert (r.area, r.area_left) == (stack[k].sum(), kept.sum())
            assert r.shrunk == (kept.sum() / max(1, stack[k].sum()) < 0.3)
            assert (rle.to_mask(r.counts_left, 9, 11) == kept).all()
            for j in range(k + 1, 7):
                both = (stack[k] & stack[j]).sum()
                assert ((frame, k, j) in pairs) == bool(both)
                if both:
                    p = pairs[frame, k, j]
                    assert (p.inter, p.iou, p.iom) == (both, both / (stack[k] | stack[j]).sum(), both / min(stack[k].sum(), stack[j].sum()))
    assert [(k, got[7, k].area, got[7, k].area_left) for k in (1, 2, 3)] == [(1, 0, 0), (2, 0, 0), (3, 3, 3)]


def union_find(edges):
    up = {}

    def root(x):
        while up.setdefault(x, x) != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for u, v in edges:
        a, b = root(u), root(v)
        up[max(a, b)] = min(a, b)
    return {x: root(x) for x in list(up)}


@pytest.mark.parametrize("seed", range(3))
def test_components_equal_union_find(spark, seed):
    rng = random.Random(seed)
    n = 400
    edges = [(rng.randrange(n), rng.randrange(n)) for _ in range(n * (1 + seed) // 3)] + [(0, k) for k in range(1, 90)]
    rows = edges + [(5, 5), (None, 3), (4, None)]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(rows, "u long, v long")).collect()}
    assert got == union_find([e for e in edges if e[0] != e[1]])
    assert components.components(spark.createDataFrame([(1, 1)], "u long, v long")).count() == 0


def test_a_long_chain_ends_in_few_rounds(spark):
    n, rounds = 100_000, []
    shuffled = spark.range(n).selectExpr(f"(id * 7919) % {n} AS u", f"((id + 1) * 7919) % {n} AS v").where("u < 1000000").where(f"v <> 0 and u <> {n}")
    got = components.components(shuffled, rounds)
    assert got.selectExpr("count(*) AS n", "max(component) AS c").first() == (n, 0) and len(rounds) <= 20


def test_triangles_that_share_edges_only(spark):
    rows = [(1, 1, 2, 3), (2, 3, 2, 4), (3, 4, 5, 6), (4, 9, 9, 8), (5, 8, 9, 7), (6, None, 20, 21), (7, 21, 20, 22), (8, 30, 31, 32)]
    df = spark.createDataFrame(rows, "triangle long, a long, b long, c long")
    got = {r.triangle: (r.cluster, r["size"]) for r in components.mesh_clusters(df).collect()}
    assert got == {1: (1, 2), 2: (1, 2), 3: (3, 1), 4: (4, 2), 5: (4, 2), 6: (6, 2), 7: (6, 2), 8: (8, 1)}
    assert sorted(r.triangle for r in components.clean_mesh(df, largest=1, least=2).collect()) == [1, 2, 4, 5, 6, 7]
    assert components.clean_mesh(df.limit(0)).count() == 0
