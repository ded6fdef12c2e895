"""Operator 11, vector code compression: delta-maintained Lloyd rounds.

A vector of integers is cut into equal consecutive parts, and every part becomes
the index of its nearest entry in its position's codebook (squared Euclidean
distance, ties to the lower index).  A codebook starts as that part of the
vectors with the least ids and is bettered by Lloyd rounds: assign all parts, then
replace each entry by the componentwise floor(sum / count) of its parts; an
entry without parts stays.

The rounds are maintained by deltas.  The table of vectors is persisted with the
assignments of the round before, the driver holds the running integer sum and
count of every entry (parts x entries x width numbers, whatever the table's
size), and a round sends only what changes them: every task adds up the plus of
the entry a part joins and the minus of the one it leaves, for the parts whose
assignment changed, and these sums, a few rows a task, are the round's one
shuffle.  A round without a change ends the loop, as no later one would change
anything.  What executors lose is assigned anew from the rows before it, since
the codebooks of all rounds travel with the tasks; only the final codes
(checkpointed) outlive the run.

Null vectors, those with a null or non-finite component and those of another
length than the least id's are left out.  Rows repeat as often as they are there;
rows of one id are rows of their own, in the order of their integers' bytes
(little-endian), and null ids come last.
With fewer rows than entries, codebooks have as many entries as there are rows.
Null labels form a group.  No rows give an empty table.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .runtime import durable, held
from .vectors import integer_rows, matrix

#: Copies of a label's sum, so that a label of a third of all rows meets them in as many tasks.
SALTS = 32
_DELTA = "part int, entry int, place int, total long"


@dataclass
class Codes:
    """``rows`` (vec_id, label, code binary, error long), ``books`` (parts x
    entries x width), and how many parts changed their entry in each round."""

    rows: DataFrame
    books: np.ndarray
    changed: list[int]


def assign(x: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each row's nearest entry by part, and the squared distances."""
    n, (parts, _, width) = len(x), books.shape
    cut = x.reshape(n, parts, width)
    code, away = np.empty((n, parts), dtype=np.uint8), np.empty((n, parts), dtype=np.int64)
    for p in range(parts):
        piece = cut[:, p]
        far = (books[p] ** 2).sum(axis=1) - 2 * (piece @ books[p].T)
        code[:, p] = far.argmin(axis=1)
        away[:, p] = far[np.arange(n), code[:, p]] + (piece**2).sum(axis=1)
    return code, away


def _bytes(rows: np.ndarray) -> pa.Array:
    return pa.array([r.tobytes() for r in rows], type=pa.binary())


def _assigned(state: DataFrame, books: np.ndarray, first: bool, schema: T.StructType) -> DataFrame:
    """The rows with the code they had (``was``) and the one they get."""
    width = books.shape[0] * books.shape[2]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held(None)
        for batch in batches:
            cols = dict(zip(batch.schema.names, batch.columns))
            code, _ = assign(matrix(cols["v"], width), books)
            was = pa.nulls(batch.num_rows, pa.binary()) if first else cols["code"]
            yield pa.RecordBatch.from_arrays(
                [cols["vec_id"], cols["label"], cols["v"], was, _bytes(code)], names=[f.name for f in schema]
            )

    return state.mapInArrow(run, schema)


def _deltas(state: DataFrame, shape: tuple[int, int, int]) -> DataFrame:
    """What changes the sums (place 0 and on) and counts (place -1) of the
    entries: a task's sums over the parts whose entry is another one now."""
    parts, entries, width = shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held(None)
        moved = np.zeros((parts, entries, width + 1), dtype=np.int64)
        for batch in batches:
            x = matrix(batch.column(0), parts * width).reshape(-1, parts, width)
            ones = np.ones((len(x), parts, 1), dtype=np.int64)
            x = np.concatenate((ones, x), axis=2)
            now = np.frombuffer(b"".join(batch.column(2).to_pylist()), dtype=np.uint8).reshape(-1, parts)
            olds = batch.column(1).to_pylist()
            known = np.array([o is not None for o in olds], dtype=bool)
            was = np.frombuffer(b"".join(o or bytes(parts) for o in olds), dtype=np.uint8).reshape(-1, parts)
            differs = (was != now) | ~known[:, None]
            for p in range(parts):
                at = differs[:, p]
                np.add.at(moved[p], now[at, p], x[at, p])
                at = at & known
                np.subtract.at(moved[p], was[at, p], x[at, p])
        p, e, k = np.nonzero(moved)
        rows = [pa.array(c, type=pa.int32()) for c in (p, e, k - 1)] + [pa.array(moved[p, e, k], type=pa.int64())]
        yield pa.RecordBatch.from_arrays(rows, names=["part", "entry", "place", "total"])

    changed = state.where("was is null or was <> code").select("v", "was", "code")
    return changed.mapInArrow(run, _DELTA).groupBy("part", "entry", "place").agg(F.sum("total").alias("total"))


def fit(
    df: DataFrame,
    *,
    parts: int = 8,
    entries: int = 16,
    rounds: int = 6,
    scale: int = 4096,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
) -> Codes:
    """Fit the codebooks on all rows and encode them; see the module."""
    if not 1 <= entries <= 256:
        raise ValueError("a code is a byte a part: 1 to 256 entries")
    rows, dim = integer_rows(df, scale, id_col=id_col, vector_col=vector_col, label_col=label_col)
    if dim % parts:
        raise ValueError(f"{dim} components do not make {parts} equal parts")
    kinds = [*rows.schema.fields, T.StructField("was", T.BinaryType()), T.StructField("code", T.BinaryType())]
    out = T.StructType([*rows.schema.fields[:2], T.StructField("code", T.BinaryType()), T.StructField("error", T.LongType())])
    if not dim:
        return Codes(df.sparkSession.createDataFrame([], out), np.zeros((parts, 0, 0), dtype=np.int64), [])

    least = rows.orderBy(F.asc_nulls_last("vec_id"), "v").limit(entries).collect()
    seeds = np.stack([np.frombuffer(r["v"], dtype="<i4").astype(np.int64) for r in least])
    books = np.ascontiguousarray(seeds.reshape(len(least), parts, -1).swapaxes(0, 1))
    sums, counts = np.zeros_like(books), np.zeros(books.shape[:2], dtype=np.int64)
    state, changed = rows, []
    for turn in range(rounds):
        before = state
        state = _assigned(before, books, turn == 0, T.StructType(kinds)).persist(StorageLevel.MEMORY_AND_DISK)
        moved = 0
        for d in _deltas(state, books.shape).collect():  # at most parts x entries x (width + 1) rows
            if d["place"] < 0:
                counts[d["part"], d["entry"]] += d["total"]
            else:
                sums[d["part"], d["entry"], d["place"]] += d["total"]
            moved += 1
        if turn:
            before.unpersist()
        changed.append(moved)
        if not moved:
            break
        used = counts > 0
        books = books.copy()
        books[used] = sums[used] // counts[used][:, None]

    def final(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held(None)
        for batch in batches:
            cols = dict(zip(batch.schema.names, batch.columns))
            code, away = assign(matrix(cols["v"], dim), books)
            yield pa.RecordBatch.from_arrays(
                [cols["vec_id"], cols["label"], _bytes(code), pa.array(away.sum(axis=1), type=pa.int64())],
                names=["vec_id", "label", "code", "error"],
            )

    coded = durable(state.mapInArrow(final, out))
    if state is not rows:
        state.unpersist()
    return Codes(coded, books, changed)


def with_label_error(rows: DataFrame) -> DataFrame:
    """``rows`` with ``label_error``, the error summed over equal labels (nulls
    together).  The sums, one a label, are copied ``SALTS`` times, and each row
    meets one of the copies."""
    sums = rows.groupBy("label").agg(F.sum("error").alias("label_error")).select(
        F.col("label").alias("of"), "label_error", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("copy")
    )
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("vec_id", "code"), F.lit(SALTS)).cast("int"))
    met = salted.join(sums, F.col("label").eqNullSafe(F.col("of")) & (F.col("salt") == F.col("copy")))
    return met.select(*rows.columns, "label_error")


def books_sha256(books: np.ndarray) -> str:
    """Digest of all entries' decimal components, joined by commas."""
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()
