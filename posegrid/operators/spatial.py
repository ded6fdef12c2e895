"""Joins by place: boxes that meet, and each point's nearest points.

``box_pairs`` finds all pairs of boxes of a part that meet.  Boxes live on grids
of cells of a power of two: one is a resident of the at most 2^d cells of the first grid
whose cells are as wide as it, and asks on this and all coarser grids that
have residents, so no box is copied more than 2^d times a grid, whatever the
sizes.  A pair that shares several cells is reported in the one that holds the corner
where its intersection begins.  Cells with many residents are split, and who
asks is copied to each piece.  All of it is DataFrame work.

``nearest`` finds each point's k nearest points of its part, exactly: points are
laid out along a Morton curve and cut into blocks; distances inside a block bound
how far its points' neighbours can be; blocks whose boxes come within that bound
(a box join) are compared, and the best over all of them win.  A point whose bound
is far beyond its block's others asks for itself.

``mean_nearest`` has the mean squared distance to them: parts of few points are worked
out whole, many at once, after one shuffle; only larger ones go through ``nearest``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.dialect import Spark
from ..plans.registry import derived, query, render
from .export import scratch

#: Residents of a cell beyond which it is split.
SPLIT = 2_000
LOW, HIGH = -30, 60  # exponents of the grids' cell widths
#: Points of a block.
BLOCK = 64
#: Points of a part that is worked out whole, distances held at once, and rows of a batch.
FEW, CELLS, ROWS = 2048, 1 << 18, 1 << 16
_CELL = ("part", "level", "cell")


def _width(level: Column) -> Column:
    return F.pow(F.lit(2.0), level)


def _leveled(boxes: DataFrame, side: str, dims: int) -> DataFrame:
    """(part, side struct, own level): the first grid as wide as the box."""
    widest = F.greatest(F.lit(0.0), *[F.get("hi", F.lit(d)) - F.get("lo", F.lit(d)) for d in range(dims)])
    level = F.when(widest <= 2.0**LOW, LOW).otherwise(F.least(F.lit(HIGH), F.ceil(F.log2(widest)))).cast("int")
    level = F.when(_width(level) < widest, level + 1).otherwise(level)  # logarithms are not exact
    others = [c for c in boxes.columns if c != "part"]
    return boxes.where(" and ".join(["part is not null", *(f"lo[{d}] <= hi[{d}]" for d in range(dims))])).select(
        "part", F.struct(*others).alias(side), level.alias("own")
    )


def _cells(side: str, level: Column, dims: int) -> Column:
    """The cells of a grid that a box meets."""
    spans = [
        F.sequence(*[F.floor(F.get(f"{side}.{end}", F.lit(d)) / _width(level)).cast("long") for end in ("lo", "hi")]) for d in range(dims)
    ]

    def crossed(heads: Column, span: Column) -> Column:
        return F.flatten(F.transform(heads, lambda head: F.transform(span, lambda x: F.concat(head, F.array(x)))))

    out = F.transform(spans[0], lambda x: F.array(x))
    for span in spans[1:]:
        out = crossed(out, span)
    return F.explode(out).alias("cell")


def _one_way(residents: DataFrame, r: str, asking: DataFrame, q: str, levels: list[int], dims: int, strictly: bool) -> DataFrame:
    """Pairs whose resident's grid is at least as coarse as the other's own
    (or coarser, ``strictly``)."""
    if not levels:
        levels = [HIGH]
    at_home = residents.withColumn("level", F.col("own")).select("part", r, "level", _cells(r, F.col("level"), dims))
    grids = F.filter(F.array(*map(F.lit, levels)), lambda x: x > F.col("own") if strictly else x >= F.col("own"))
    visits = asking.select("part", q, F.explode(grids).alias("level")).select("part", q, "level", _cells(q, F.col("level"), dims))

    crowded = at_home.groupBy(*_CELL).agg(F.count("*").alias("n")).where(F.col("n") > SPLIT)
    crowded = crowded.select(*[F.col(c).alias(f"of_{c}") for c in _CELL], F.ceil(F.col("n") / SPLIT).cast("int").alias("pieces"))

    def split(rows: DataFrame) -> DataFrame:
        on = [F.col(c) == F.col(f"of_{c}") for c in _CELL]
        return rows.join(crowded, on, "left").withColumn("pieces", F.coalesce("pieces", F.lit(1))).drop(*[f"of_{c}" for c in _CELL])

    at_home = split(at_home).withColumn("piece", F.pmod(F.xxhash64(r), F.col("pieces")).cast("int")).drop("pieces")
    visits = split(visits).withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1))).drop("pieces")
    # copies by cell outgrow what the tables' sizes promise: neither side may be sent whole to the driver
    met = at_home.hint("merge").join(visits.hint("merge"), [*_CELL, "piece"])
    both = [F.get(f"{r}.lo", F.lit(d)) <= F.get(f"{q}.hi", F.lit(d)) for d in range(dims)]
    both += [F.get(f"{q}.lo", F.lit(d)) <= F.get(f"{r}.hi", F.lit(d)) for d in range(dims)]
    begins = [F.greatest(F.get(f"{r}.lo", F.lit(d)), F.get(f"{q}.lo", F.lit(d))) for d in range(dims)]
    here = [F.floor(begin / _width(F.col("level"))).cast("long") == F.get("cell", F.lit(d)) for d, begin in enumerate(begins)]
    for condition in (*both, *here):
        met = met.where(condition)
    return met.select("part", "a", "b")


def box_pairs(left: DataFrame, right: DataFrame, dims: int = 3) -> DataFrame:
    """(part, a, b): the pairs of a left and a right box of one part that meet,
    faces included.  Sides have ``part``, ``lo`` and ``hi`` (arrays of ``dims`` doubles) and any
    other columns; ``a`` and ``b`` are structs of all but the part.  Boxes with a null or
    a reversed side meet none."""
    a, b = _leveled(left, "a", dims), _leveled(right, "b", dims)
    levels = [sorted(r["own"] for r in side.select("own").distinct().collect()) for side in (a, b)]  # some ninety at most
    return _one_way(a, "a", b, "b", levels[0], dims, False).unionByName(_one_way(b, "b", a, "a", levels[1], dims, True))


# -- nearest points


def _spread(x: Column) -> Column:
    """The 21 bits of a number, two zero bits after each."""
    for shift, mask in ((32, 0x1F00000000FFFF), (16, 0x1F0000FF0000FF), (8, 0x100F00F00F00F00F), (4, 0x10C30C30C30C30C3), (2, 0x1249249249249249)):
        x = x.bitwiseOR(F.shiftleft(x, shift)).bitwiseAND(F.lit(mask))
    return x


def _morton(points: DataFrame) -> DataFrame:
    """Points with ``code``, their place on a Morton curve through the part's box."""
    box = points.groupBy("part").agg(*[f(c).alias(f"{n}_{c}") for c in "xyz" for n, f in (("low", F.min), ("high", F.max))])
    box = box.withColumnRenamed("part", "of")
    widest = F.greatest(*[F.col(f"high_{c}") - F.col(f"low_{c}") for c in "xyz"])
    place = lambda c: F.when(widest > 0, F.floor((F.col(c) - F.col(f"low_{c}")) / widest * ((1 << 21) - 1))).otherwise(0).cast("long")
    code = F.lit(0).cast("long")
    for k, c in enumerate("xyz"):
        code = code.bitwiseOR(F.shiftleft(_spread(place(c)), k))
    return points.join(box, F.col("part") == F.col("of")).select("part", "id", "x", "y", "z", code.alias("code"))


_BLOCKS = "part long, block long, n int, lo array<double>, hi array<double>, ids binary, xyz binary, bounds binary"


def _bounds(xyz: np.ndarray, k: int) -> np.ndarray:
    """How far at most each point's k-th other point is; infinite for too few."""
    if len(xyz) <= k:
        return np.full(len(xyz), np.inf)
    away = ((xyz[:, None] - xyz[None]) ** 2).sum(axis=2)
    np.fill_diagonal(away, np.inf)
    return np.partition(away, k - 1, axis=1)[:, k - 1]


def _blocks(points: DataFrame, k: int) -> DataFrame:
    """The blocks, written once: what they hold must not change between reads."""

    def pack(part: int, number: int, ids: np.ndarray, xyz: np.ndarray) -> tuple:
        bounds = _bounds(xyz, k)
        return part, number, len(ids), xyz.min(axis=0), xyz.max(axis=0), ids.tobytes(), xyz.tobytes(), bounds.tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, part, ids, xyz = TaskContext.get().partitionId() << 40, None, np.zeros(0, np.int64), np.zeros((0, 3))
        names = [c.split()[0] for c in _BLOCKS.split(", ")]
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.float64()), pa.list_(pa.float64()), pa.binary(), pa.binary(), pa.binary()]

        def cut(last: bool) -> list[tuple]:
            nonlocal number, ids, xyz
            out = []
            while len(ids) >= 2 * BLOCK or (last and len(ids)):  # the last two blocks of a part share what is left
                n = BLOCK if len(ids) >= 2 * BLOCK else len(ids) if len(ids) <= BLOCK else (len(ids) + 1) // 2
                out.append(pack(part, number, ids[:n], xyz[:n]))
                ids, xyz, number = ids[n:], xyz[n:], number + 1
            return out

        for batch in batches:
            parts = batch.column(0).to_numpy()
            new_ids = batch.column(1).to_numpy()
            new_xyz = np.column_stack([batch.column(c).to_numpy() for c in (2, 3, 4)])
            edges = [0, *(np.flatnonzero(parts[1:] != parts[:-1]) + 1).tolist(), len(parts)]
            rows = []
            for a, b in zip(edges, edges[1:]):
                if b > a:
                    if parts[a] != part:
                        rows += cut(True)
                        part = int(parts[a])
                    ids, xyz = np.concatenate((ids, new_ids[a:b])), np.concatenate((xyz, new_xyz[a:b]))
                    rows += cut(False)
            yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(zip(*rows), kinds)] if rows else [pa.array([], type=t) for t in kinds], names=names)
        rows = cut(True)
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(zip(*rows), kinds)], names=names)

    laid = _morton(points).repartitionByRange("part", "code").sortWithinPartitions("part", "code", "id")
    path = scratch(points.sparkSession, "blocks")
    laid.select("part", "id", "x", "y", "z").mapInArrow(run, _BLOCKS).write.parquet(path)
    return points.sparkSession.read.parquet(path)


_ASKS = "part long, block long, lo array<double>, hi array<double>, ids binary, xyz binary, bounds binary"
_FOUND = "part long, id long, other long, d2 double"


def _asking(blocks: DataFrame) -> DataFrame:
    """Who asks, and how far: a block, but for points whose bound is far beyond
    its usual ones; those ask alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for part, block, ids, xyz, bounds in zip(*(batch.column(c).to_pylist() for c in ("part", "block", "ids", "xyz", "bounds"))):
                ids, xyz, bound = np.frombuffer(ids, np.int64), np.frombuffer(xyz).reshape(-1, 3), np.frombuffer(bounds)
                usual = bound <= 16 * np.median(bound) if np.isfinite(bound).all() else np.ones(len(bound), dtype=bool)
                for at in [usual, *(np.arange(len(ids)) == i for i in np.flatnonzero(~usual))]:
                    far = np.sqrt(bound[at].max()) * (1 + 1e-9)
                    far = min(far, 1e18)  # too few points in the block: all blocks of the part
                    low, high = xyz[at].min(axis=0) - far, xyz[at].max(axis=0) + far
                    rows.append((part, block, low, high, ids[at].tobytes(), xyz[at].tobytes(), bound[at].tobytes()))
            kinds = [pa.int64(), pa.int64(), pa.list_(pa.float64()), pa.list_(pa.float64()), pa.binary(), pa.binary(), pa.binary()]
            names = [c.split()[0] for c in _ASKS.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(zip(*rows), kinds)] if rows else [pa.array([], type=t) for t in kinds], names=names)

    return blocks.select("part", "block", "ids", "xyz", "bounds").mapInArrow(run, _ASKS)


def candidates(points: DataFrame, k: int) -> DataFrame:
    """(part, a, b): who asks and the blocks it must be compared with."""
    blocks = _blocks(points, k)
    return box_pairs(_asking(blocks), blocks.select("part", "block", "n", "lo", "hi", "ids", "xyz"))


def nearest(points: DataFrame, k: int = 3) -> DataFrame:
    """(part, id, rank, other, d2): the k nearest other points (all, if fewer) of
    each point (part, id, x, y, z; ids unique in a part), by squared distance
    rounded to 9 places, ties by id.  Rows with a null are left out."""
    whole = points.select(F.col("part").cast("long").alias("part"), F.col("id").cast("long").alias("id"), *[F.col(c).cast("double").alias(c) for c in "xyz"]).dropna()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                piece = batch.slice(at, 256)
                out: list[list[np.ndarray]] = [[], [], [], []]
                for part, ids, xyz, bounds, others, places in zip(*(c.to_pylist() for c in piece.columns)):
                    a, b = np.frombuffer(xyz).reshape(-1, 3), np.frombuffer(places).reshape(-1, 3)
                    ids, others, bound = np.frombuffer(ids, np.int64), np.frombuffer(others, np.int64), np.frombuffer(bounds)
                    away = ((a[:, None] - b[None]) ** 2).sum(axis=2)
                    near = (away <= bound[:, None] * (1 + 1e-9) + 1e-9) & (ids[:, None] != others[None])
                    if len(others) > 8 * k:  # no more than the k best of a block, and their ties, can count
                        masked = np.where(near, away, np.inf)
                        near &= masked <= np.partition(masked, k - 1, axis=1)[:, k - 1 : k] + 1e-8
                    i, j = np.nonzero(near)
                    for held, values in zip(out, (np.full(len(i), part), ids[i], others[j], away[i, j])):
                        held.append(values)
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in out], names=["part", "id", "other", "d2"])

    pairs = candidates(whole, k).select("part", "a.ids", "a.xyz", "a.bounds", F.col("b.ids").alias("others"), F.col("b.xyz").alias("places"))
    order = Window.partitionBy("part", "id").orderBy(F.round("d2", 9), "other")
    return pairs.mapInArrow(run, _FOUND).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("part", "id", "rank", "other", "d2")


def _means(xyz: np.ndarray, void: np.ndarray, starts: np.ndarray, sizes: np.ndarray, k: int) -> np.ndarray:
    """The mean squared distance of each point to the k nearest others of its part, parts of
    a size at once: distances rounded to 9 places (halves up), ties by place; of void
    points unknown (NaN), and last."""
    out = np.full(len(xyz), np.nan)
    for n in np.unique(sizes[sizes > 1]).tolist():
        of_size = starts[sizes == n]
        step = max(1, CELLS // (n * n))
        for low in range(0, len(of_size), step):
            at = of_size[low : low + step, None] + np.arange(n)
            away = np.zeros((len(at), n, n))
            for c in range(3):
                x = xyz[at, c]
                d = x[:, :, None] - x[:, None]
                away += d * d
            key = np.where(away < 2.0**22, np.floor(away * 1e9 + 0.5), away * 1e9)
            key = np.where(np.isnan(key), 1e300, np.minimum(key, 9e299))
            gone = void[at]
            key[np.broadcast_to(gone[:, None], key.shape)] = 2e300
            key[:, np.arange(n), np.arange(n)] = np.inf
            total, count = np.zeros(at.shape), np.zeros(at.shape)
            g, i = np.ogrid[: len(at), :n]
            for _ in range(min(k, n - 1)):
                j = key.argmin(axis=2)  # the first among equals
                known = ~(gone | gone[g, j])
                total += np.where(known, away[g, i, j], 0.0)
                count += known
                key[g, i, j] = np.inf
            with np.errstate(invalid="ignore"):
                out[at] = total / count
    return out


def mean_nearest(points: DataFrame, order: list[str], k: int = 3) -> DataFrame:
    """(part, id, mean_d2): for each point (part, x, y, z and the columns of the order) of a part with
    others, the mean squared distance to its k nearest others (all, if fewer), as ``nearest`` has them; its id
    is its place in its part by the order, from 1.  A distance to a point with a null is
    unknown: it comes last and does not count."""
    rows = points.where("part is not null").select(F.col("part").cast("long").alias("part"), *order, *[F.col(c).cast("double").alias(c) for c in "xyz"])
    by = [*order, *"xyz"]
    many = rows.groupBy("part").agg(F.count("*").alias("n")).where(F.col("n") > FEW).select(F.col("part").alias("of"))
    some = not many.isEmpty()
    # at most a part in FEW rows
    few = rows.join(F.broadcast(many), F.col("part") == F.col("of"), "left_anti") if some else rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None

        def found(whole: pa.Table) -> pa.RecordBatch:
            part = whole["part"].to_numpy()
            starts = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
            sizes = np.diff(np.r_[starts, len(part)])
            void = np.logical_or.reduce([whole[c].is_null().to_numpy() for c in "xyz"])
            means = _means(np.column_stack([whole[c].to_numpy() for c in "xyz"]), void, starts, sizes, k)
            place = np.arange(len(part)) - np.repeat(starts, sizes) + 1
            unknown = void | (np.isnan(means) & _lonely(void, starts, sizes))
            others = np.repeat(sizes, sizes) > 1
            columns = [pa.array(part[others]), pa.array(place[others]), pa.array(means[others], mask=unknown[others])]
            return pa.RecordBatch.from_arrays(columns, names=["part", "id", "mean_d2"])

        for batch in batches:
            whole = pa.Table.from_batches([batch])
            held = pa.concat_tables([held, whole]) if held is not None else whole
            part = held["part"].to_numpy()
            if held.num_rows >= ROWS and part[0] != part[-1]:
                cut = int(np.searchsorted(part, part[-1]))
                yield found(held.slice(0, cut))
                held = held.slice(cut)
        if held is not None and held.num_rows:
            yield found(held)

    # a number given is kept: a few bytes of points are much work
    parts = int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    laid = few.repartition(parts, "part").sortWithinPartitions("part", *by).select("part", *"xyz")
    out = laid.mapInArrow(run, "part long, id long, mean_d2 double")
    if not some:
        return out
    large = rows.join(F.broadcast(many), F.col("part") == F.col("of"), "left_semi")
    large = large.withColumn("id", F.row_number().over(Window.partitionBy("part").orderBy(*by)).cast("long")).select("part", "id", *"xyz")
    means = nearest(large, k).groupBy("part", "id").agg(F.avg("d2").alias("mean_d2"))
    return out.unionByName(large.select("part", "id").join(means, ["part", "id"], "left"))


def _lonely(void: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Whether a point's part has no other point without a null."""
    known = np.add.reduceat((~void).astype(np.int64), starts)
    return np.repeat(known, sizes) - ~void == 0


@derived
def near_means(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    """Each point's mean squared distance to the three nearest of its part."""
    order = ["l_orderkey", "l_linenumber", "l_suppkey"]
    text = f"select ins_id as part, {', '.join(order)}, x, y, z from points"
    return mean_nearest(query(spark, render(text, Spark(sf_dir))), order)
