"""Seeded draws of objects for many frame pairs at once, in numpy."""

from __future__ import annotations

import functools
import itertools

import numpy as np
import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql.functions import pandas_udf

#: The draws' modulus and multiplier (as the SQL text of ``drawn``).
PRIME, FACTOR = 2147483647, 48271
#: Triples of a pair that are drawn, and those looked at for them.
MOST, AHEAD = 10, 24
#: Candidate triples held at once.
CELLS = 1 << 17


def _reduced(x: np.ndarray) -> np.ndarray:
    """Numbers below 2^62 modulo 2^31 - 1, by folding."""
    x = (x & PRIME) + (x >> 31)
    x = (x & PRIME) + (x >> 31)
    return np.where(x >= PRIME, x - PRIME, x)


def hashed(seed: np.ndarray, *keys: np.ndarray) -> np.ndarray:
    """The draw's number for keys (below the modulus), taken in turn; not yet squared."""
    for k in keys:
        seed = _reduced((seed + k) * FACTOR)
    return seed


@functools.lru_cache(maxsize=256)
def _places(n: int) -> tuple[np.ndarray, ...]:
    """Of n objects: both places of all pairs, and of all triples the third place
    and the numbers of its pairs (first and second, first and third, second and third)."""
    low, high = np.triu_indices(n, 1)
    number = np.zeros((n, n), dtype=np.intp)
    number[low, high] = np.arange(len(low))
    x, y, z = np.array(list(itertools.combinations(range(n), 3)), dtype=np.intp).reshape(-1, 3).T
    return low, high, x, y, z, number[x, y], number[x, z], number[y, z]


def _block(numbers: list[np.ndarray], first: int, second: int, ids: np.ndarray, labels: np.ndarray, where: np.ndarray) -> list[list[int]]:
    """The triples of pairs with equally many objects (ids ascending; ``where``: 1
    in frame a, 2 in b, 3 in both)."""
    keys = [v[:, None] for v in numbers]
    seed = np.full((len(ids), 1), first, dtype=np.int64)
    draw = hashed(seed, *keys, ids % PRIME)
    turn = np.argsort(_reduced(draw * draw), axis=1, kind="stable")  # ties by id
    ids, labels, where = (np.take_along_axis(v, turn, axis=1) for v in (ids, labels, where))
    low, high, x, y, z, xy, xz, yz = _places(ids.shape[1])
    take = functools.partial(np.take, axis=1)
    small = ids % PRIME
    head = hashed(np.full((len(ids), 1), second, dtype=np.int64), *keys, small)
    two = hashed(take(head, low), take(small, high))
    order = hashed(take(two, xy), take(small, z))
    order = _reduced(order * order)
    unlike = take(labels, low) != take(labels, high)
    shared = take(where, low) & take(where, high)
    fits = take(unlike, xy) & take(unlike, xz) & take(unlike, yz) & ((take(shared, xy) & take(where, z)) == 0)
    order = np.where(fits, order, PRIME).astype(np.int32)

    few = min(AHEAD, order.shape[1])
    some = np.argpartition(order, few - 1, axis=1)[:, :few]
    value = np.take_along_axis(order, some, axis=1)
    rank = np.lexsort((*(np.take_along_axis(ids, p[some], axis=1) for p in (z, y, x)), value), axis=1)[:, :MOST]
    best, value = np.take_along_axis(some, rank, axis=1), np.take_along_axis(value, rank, axis=1)
    if few < order.shape[1]:  # where ties reach beyond those looked at, look at all
        last = np.take_along_axis(order, some, axis=1).max(axis=1)
        for r in np.flatnonzero((last == value[:, -1]) & (last < PRIME)):
            best[r] = np.lexsort((ids[r][z], ids[r][y], ids[r][x], order[r]))[:MOST]
            value[r] = order[r][best[r]]
    drawn = np.stack([np.take_along_axis(ids, p[best], axis=1) for p in (x, y, z)], axis=2).reshape(len(ids), -1)
    n = 3 * (value < PRIME).sum(axis=1)
    return [d[:k] for d, k in zip(drawn.tolist(), n.tolist())]


def triples(first: int, second: int, scene: np.ndarray, a: np.ndarray, b: np.ndarray, ids_a, labels_a, ids_b, labels_b) -> list[list[int]]:
    """For each pair of frames a and b of a scene, at most ten triples, end to end:
    objects of either frame in a drawn order (seed ``first``), three unlike labels, not
    all in a frame; by a second draw (``second``)."""
    out: list[list[int]] = [[]] * len(scene)
    groups: dict[int, tuple[list[int], list[int], list[int], list[int]]] = {}
    for row, (ia, la, ib, lb) in enumerate(zip(ids_a, labels_a, ids_b, labels_b)):
        held = {i: (label, 1) for i, label in zip(ia.tolist(), la.tolist())}
        for i, label in zip(ib.tolist(), lb.tolist()):
            held[i] = (label, 3 if i in held else 2)
        if len(held) > 2:
            rows, ids, labels, where = groups.setdefault(len(held), ([], [], [], []))
            rows.append(row)
            for i in sorted(held):
                ids.append(i)
                labels.append(held[i][0])
                where.append(held[i][1])
    numbers = [v.astype(np.int64) % PRIME for v in (scene, a, b)]
    for n, (rows, *columns) in groups.items():
        ids, labels, where = (np.array(c, dtype=t).reshape(-1, n) for c, t in zip(columns, (np.int64, np.int64, np.uint8)))
        step = max(1, CELLS // max(1, n * (n - 1) * (n - 2) // 6))
        for at in range(0, len(rows), step):
            part = rows[at : at + step]
            found = _block([v[part] for v in numbers], first, second, ids[at : at + step], labels[at : at + step], where[at : at + step])
            for row, drawn in zip(part, found):
                out[row] = drawn
    return out


def _padded(lists: list[np.ndarray], width: int) -> np.ndarray:
    """Lists as rows of a table, zeros after their ends."""
    sizes = np.array([len(x) for x in lists])
    out = np.zeros((len(lists), width), dtype=np.int64)
    out[np.arange(width) < sizes[:, None]] = np.concatenate([np.zeros(0, dtype=np.int64), *lists])
    return out


def couples(seed: int, most: int, scene: np.ndarray, a: np.ndarray, b: np.ndarray, ids_a, labels_a, ids_b, labels_b) -> list[list[int]]:
    """For each pair of frames a and b of a scene, at most ``most`` couples of an object of
    each, end to end: not the same one, unlike labels; by a draw."""
    sizes = np.array([[len(x), len(y)] for x, y in zip(ids_a, ids_b)]).reshape(-1, 2)
    out: list[list[int]] = [[]] * len(scene)
    order = np.argsort(sizes.max(axis=1), kind="stable")  # alike in size together: little padding
    order = order[sizes[order].min(axis=1) > 0]
    numbers = [v.astype(np.int64) % PRIME for v in (scene, a, b)]
    at = 0
    while at < len(order):
        widest = int(sizes[order[min(at + 1024, len(order)) - 1]].max())
        part = order[at : at + max(1, min(1024, CELLS // (widest * widest)))]
        at += len(part)
        wide = sizes[part].max(axis=0)
        ia, la = (_padded([v[r] for r in part], wide[0]) for v in (ids_a, labels_a))
        ib, lb = (_padded([v[r] for r in part], wide[1]) for v in (ids_b, labels_b))
        head = hashed(np.full((len(part), 1), seed, dtype=np.int64), *(v[part][:, None] for v in numbers), ia % PRIME)
        draw = hashed(head[:, :, None], (ib % PRIME)[:, None])
        draw = _reduced(draw * draw)
        fits = (np.arange(wide[0]) < sizes[part][:, :1])[:, :, None] & (np.arange(wide[1]) < sizes[part][:, 1:])[:, None]
        fits &= (ia[:, :, None] != ib[:, None]) & (la[:, :, None] != lb[:, None])
        flat = np.where(fits, draw, PRIME).reshape(len(part), -1)
        few = min(most + 5, flat.shape[1])
        some = np.argpartition(flat, few - 1, axis=1)[:, :few]
        for r, row in enumerate(part.tolist()):
            at_r, value = some[r], flat[r][some[r]]
            if few < flat.shape[1] and np.sort(value)[min(most, few) - 1] == value.max() < PRIME:  # ties reach further
                at_r, value = np.arange(flat.shape[1]), flat[r]
            at_r, value = at_r[value < PRIME], value[value < PRIME]
            left, right = ia[r][at_r // wide[1]], ib[r][at_r % wide[1]]
            best = np.lexsort((right, left, value))[:most]
            out[row] = np.column_stack((left[best], right[best])).ravel().tolist()
    return out


def register(spark: SparkSession) -> None:
    """``draw_triples`` and ``draw_couples`` for SQL texts."""

    @pandas_udf("array<bigint>")
    def draw_couples(
        seed: pd.Series, most: pd.Series, scene: pd.Series, a: pd.Series, b: pd.Series,
        ids_a: pd.Series, labels_a: pd.Series, ids_b: pd.Series, labels_b: pd.Series,
    ) -> pd.Series:
        if not len(scene):
            return pd.Series([], dtype=object)
        numbers = [v.to_numpy() for v in (scene, a, b)]
        return pd.Series(couples(int(seed.iloc[0]), int(most.iloc[0]), *numbers, *(v.to_list() for v in (ids_a, labels_a, ids_b, labels_b))))

    @pandas_udf("array<bigint>")
    def draw_triples(
        first: pd.Series, second: pd.Series, scene: pd.Series, a: pd.Series, b: pd.Series,
        ids_a: pd.Series, labels_a: pd.Series, ids_b: pd.Series, labels_b: pd.Series,
    ) -> pd.Series:
        if not len(scene):
            return pd.Series([], dtype=object)
        numbers = [v.to_numpy() for v in (scene, a, b)]
        return pd.Series(triples(int(first.iloc[0]), int(second.iloc[0]), *numbers, *(v.to_list() for v in (ids_a, labels_a, ids_b, labels_b))))

    spark.udf.register("draw_triples", draw_triples)
    spark.udf.register("draw_couples", draw_couples)
