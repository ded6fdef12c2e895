"""The grid join and nearest points, against all pairs in numpy."""

import duckdb
import numpy as np
import pytest

from posegrid import plans
from posegrid.operators import queries, spatial, spatial_queries

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages conversations".split()


@pytest.mark.parametrize("name", list(spatial_queries.oracle_sql()))
def test_the_pairwise_plans_results(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    twin = con.sql(spatial_queries.oracle_sql()[name])
    plain = lambda v: float(v) if isinstance(v, float) else v
    rows = lambda names, held: sorted(str([plain(dict(zip(names, r))[c]) for c in sorted(names)]) for r in held)
    got = spatial_queries.QUERIES[name](spark, SF)
    want = rows(twin.columns, twin.fetchall())
    assert rows(got.columns, got.collect()) == want and want


def test_oriented_overlaps_are_the_same(spark):
    read = lambda df: sorted((r.a, r.b, round(r.ratio, 9)) for r in df.collect())
    sf = "/root/testdata/sf0.01"
    want = read(queries.j15_oriented_overlaps(spark, sf))
    assert want and read(spatial_queries.j15_grid_oriented_overlaps(spark, sf)) == want


def boxes(spark, rng, n, dims, first):
    """Sizes over eight powers of ten, points and shared faces included."""
    size = 10.0 ** rng.uniform(-5, 3, (n, 1)) * rng.uniform(0, 1, (n, dims))
    size[rng.random(n) < 0.1] = 0
    lo = np.round(rng.normal(0, 50, (n, dims)), int(rng.integers(0, 3)))
    hi = np.maximum(lo, np.round(lo + size, 6))
    part = rng.integers(0, 3, n)
    rows = [(int(p), first + i, a.tolist(), b.tolist()) for i, (p, a, b) in enumerate(zip(part, lo, hi))]
    return spark.createDataFrame(rows, "part long, id long, lo array<double>, hi array<double>"), part, lo, hi


@pytest.mark.parametrize("dims, split", [(1, 2000), (2, 3), (3, 2000), (3, 5)])
def test_pairs_are_all_that_meet(spark, monkeypatch, dims, split):
    monkeypatch.setattr(spatial, "SPLIT", split)
    rng = np.random.default_rng(10 * dims + split)
    left, pa_, la, ha = boxes(spark, rng, 300, dims, 0)
    right, pb, lb, hb = boxes(spark, rng, 200, dims, 1000)
    meet = (pa_[:, None] == pb[None]) & (la[:, None] <= hb[None]).all(axis=2) & (lb[None] <= ha[:, None]).all(axis=2)
    want = sorted((int(i), int(j) + 1000) for i, j in zip(*np.nonzero(meet)))
    got = [(r["a"], r["b"]) for r in spatial.box_pairs(left, right, dims).selectExpr("a.id AS a", "b.id AS b").collect()]
    assert sorted(got) == want and len(want) > 50


def test_odd_boxes_meet_none(spark):
    rows = [(1, 0, [0.0], [1.0]), (1, 1, [2.0], [1.0]), (None, 2, [0.0], [1.0]), (1, 3, None, [1.0]), (1, 4, [None], [1.0]), (1, 5, [1.0], [1.0])]
    df = spark.createDataFrame(rows, "part long, id long, lo array<double>, hi array<double>")
    got = sorted((r["a"], r["b"]) for r in spatial.box_pairs(df, df, 1).selectExpr("a.id AS a", "b.id AS b").collect())
    assert got == [(0, 0), (0, 5), (5, 0), (5, 5)]
    assert spatial.box_pairs(df.limit(0), df, 1).count() == 0


def test_the_join_has_a_spatial_key(spark):
    for name in ("j14_grid_overlaps", "j21_grid_box_iou"):
        text = spatial_queries.QUERIES[name](spark, SF)._jdf.queryExecution().toString()
        assert "CartesianProduct" not in text and "NestedLoop" not in text and "cell" in text


def plain_nearest(rows, k):
    by_part, out = {}, {}
    for part, i, *p in rows:
        by_part.setdefault(part, []).append((i, p))
    for part, held in by_part.items():
        ids, xyz = np.array([h[0] for h in held]), np.array([h[1] for h in held])
        for i, p in zip(ids, xyz):
            away = np.round(((p - xyz) ** 2).sum(axis=1), 9)
            order = [j for j in np.lexsort((ids, away)) if ids[j] != i][:k]
            for rank, j in enumerate(order, 1):
                out[part, int(i), rank] = (int(ids[j]), float(away[j]))
    return out


def clouds(rng):
    rows = [(1, i, *p) for i, p in enumerate(rng.normal(0, 1, (900, 3)))]  # one of many blocks
    rows += [(2, i, *p) for i, p in enumerate(rng.integers(0, 4, (400, 3)))]  # ties
    rows += [(3, i, *p) for i, p in enumerate(np.vstack([rng.normal(0, 0.01, (300, 3)), rng.normal(0, 1000, (5, 3)), [[1e6, 0, 0]]]))]  # far ones
    rows += [(4, i, 1.0, 1.0, 1.0) for i in range(150)] + [(5, 0, 0.0, 0.0, 0.0)] + [(6, i, float(i), 0.0, 0.0) for i in range(3)]
    rows += [(7, i, *p) for i, p in enumerate(np.column_stack([rng.uniform(0, 100, 200), np.zeros((200, 2))]))]  # a line
    return [(int(a), int(b), float(x), float(y), float(z)) for a, b, x, y, z in rows]


@pytest.mark.parametrize("k", [1, 3, 7])
def test_nearest_are_exact(spark, k):
    rows = clouds(np.random.default_rng(k))
    df = spark.createDataFrame(rows + [(1, 5000, None, 0.0, 0.0), (None, 1, 0.0, 0.0, 0.0)], "part long, id long, x double, y double, z double")
    got = {(r.part, r.id, r["rank"]): (r.other, round(r.d2, 9)) for r in spatial.nearest(df, k).collect()}
    want = plain_nearest(rows, k)
    assert got.keys() == want.keys()
    for key, (other, d2) in want.items():
        assert got[key][0] == other and got[key][1] == pytest.approx(d2, rel=1e-9, abs=2e-9), key


def test_rows_compared_grow_with_the_points(spark):
    from pyspark.sql import functions as F

    def compared(n):
        df = spark.range(n).select(F.lit(1).alias("part"), "id", *[F.rand(k).alias(c) for k, c in enumerate("xyz")])
        return spatial.candidates(df, 3).selectExpr("sum(length(a.ids) / 8 * b.n) AS n").first()["n"]

    few, many = compared(8_000), compared(64_000)
    assert many / few < 14 and many < 64_000 * 64_000 / 10


def test_no_side_is_broadcast_whole(spark):
    for name in ("j14_grid_overlaps", "j16_grid_containment"):
        plan = spatial_queries.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        joins = [line for line in plan.splitlines() if "Join" in line and "piece" in line]
        assert joins and all("SortMergeJoin" in line for line in joins)


@pytest.mark.parametrize("few", [2048, 200])
def test_mean_of_nearest_is_exact(spark, monkeypatch, few):
    monkeypatch.setattr(spatial, "FEW", few)
    rows = clouds(np.random.default_rng(few)) + [(8, i, *p) for i, p in enumerate([(0.0, 0.0, 0.0), (1.0, 0.0, 0.0), (None, 1.0, 1.0)])] + [(9, 0, None, 0.0, 0.0), (9, 1, 2.0, 0.0, 0.0)]
    df = spark.createDataFrame(rows + [(None, 1, 0.0, 0.0, 0.0)], "part long, at long, x double, y double, z double")
    got = {(r.part, r.id): r.mean_d2 for r in spatial.mean_nearest(df, ["at"]).collect()}
    want = {}
    for (part, i, _), (_, d2) in plain_nearest([r for r in rows if r[0] < 8], 3).items():
        want.setdefault((part, i + 1), []).append(d2)
    want = {key: sum(v) / len(v) for key, v in want.items()}
    want |= {(8, 1): 1.0, (8, 2): 1.0, (8, 3): None, (9, 1): None, (9, 2): None}
    assert got.keys() == want.keys()
    for key, d2 in want.items():
        assert got[key] == (None if d2 is None else pytest.approx(d2, rel=1e-9, abs=3e-9)), key


@pytest.mark.parametrize("query", [plans.run("j18_knn3_points"), spatial_queries.j18_nearest_points])
def test_small_parts_take_no_rows_a_pair(spark, query):
    plan = query(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan and "Window" not in plan
