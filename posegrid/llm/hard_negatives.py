"""Operator 13, hard-negative mining by a full score sort for each anchor.

Vectors become integers, and a row's score is its integer inner product with an
anchor; higher scores come first, ties by smaller id.  An anchor's positives are
its first other rows of the same label.  Its negatives to a positive are the first rows
of other labels that score at most as much as the positive and at least ``low``
percent of it.

All rows are scored against all anchors, in cells: a block of rows (at most
about ``ROWS`` of them) against a block of anchors (about ``ANCHORS``).  Rows go
to a block by their hash, so blocks are even whatever the labels, ids or vectors;
every block of rows is sent to each block of anchors, and back.  A cell sorts the
scores of each of its anchors in full (lexsort by score and id).  The first pass reads
the first rows of the anchor's label in each cell; their best over all cells are
its positives.  The second pass sorts the other labels' scores, finds each
positive's upper limit by binary search and reads from there up to k rows above
the lower limit; the first k over all cells are the result, since each of them is among
the first k of its cell.  A task holds one cell, scored by some anchors at a time.

Rows with a null id or label, a null vector, a null or non-finite component or
another number of components than the least id's take no part.  Rows that repeat
as a whole (id, label, integers) count once; rows that share only an id are rows
of their own, in the order of their hash, and an anchor's positives may hold another row
of its id.  Without anchors, positives or rows there is no result.  Other columns
are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .ordered import parts_of
from .runtime import held, scratch
from .vectors import integer_rows

ROWS, ANCHORS = 1 << 16, 1 << 12
#: Scores held at once by a task.
SCORES = 1 << 22
_FOUND = "anchor_id long, anchor_rid long, score long, positive_id long, positive_rid long"
_MINED = "anchor_id long, anchor_rid long, positive_id long, positive_rid long, positive_score long, negative_id long, negative_rid long, negative_score long"
RESULT = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def _packed(column: pa.ChunkedArray, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype="<i4").reshape(-1, width)


def _numbers(column: pa.ChunkedArray) -> np.ndarray:
    return column.to_numpy().astype(np.int64)


class Cell:
    """A block of rows and a block of anchors: rows in the order of their ids,
    labels numbered alike, and scores a group of anchors at a time."""

    def __init__(self, rows: pa.Table, anchors: pa.Table, width: int):
        ids, rids = _numbers(rows["vec_id"]), _numbers(rows["rid"])
        order = np.lexsort((rids, ids))
        self.ids, self.rids = ids[order], rids[order]
        self.x = _packed(rows["v"], width)[order]
        self.anchors = anchors
        self.anchor_ids, self.anchor_rids = _numbers(anchors["vec_id"]), _numbers(anchors["rid"])
        self.a = _packed(anchors["v"], width)
        both = pa.chunked_array([*rows["label"].chunks, *anchors["label"].chunks], type=rows["label"].type)
        label = both.combine_chunks().dictionary_encode().indices.to_numpy()
        self.labels, self.anchor_labels = label[: len(ids)][order], label[len(ids) :]

    def scores(self):
        """(anchor's place, its scores of all rows), exact in 64 bits."""
        most = max((int(np.abs(m).max()) for m in (self.x, self.a) if m.size), default=0)
        kind = np.float64 if most * most * self.x.shape[1] < 1 << 53 else np.int64
        x = self.x.astype(kind)
        step = max(1, SCORES // max(1, len(x)))
        for at in range(0, len(self.a), step):
            block = (self.a[at : at + step].astype(kind) @ x.T).astype(np.int64)
            yield from zip(range(at, at + len(block)), block)


def _table(columns: list[list[np.ndarray]], schema: str) -> pa.Table:
    names = [c.split()[0] for c in schema.split(", ")]
    return pa.table({n: np.concatenate([np.zeros(0, dtype=np.int64), *c]) for n, c in zip(names, columns)})


def _first_positives(rows: pa.Table, anchors: pa.Table, width: int, k: int) -> pa.Table:
    """A cell's first k rows of each anchor's label, without itself."""
    cell, out = Cell(rows, anchors, width), [[] for _ in range(5)]
    for j, score in cell.scores():
        self_row = (cell.ids == cell.anchor_ids[j]) & (cell.rids == cell.anchor_rids[j])
        like = np.flatnonzero((cell.labels == cell.anchor_labels[j]) & ~self_row)
        first = like[np.lexsort((like, -score[like]))[:k]]  # places in the order of ids
        n = len(first)
        found = (np.full(n, cell.anchor_ids[j]), np.full(n, cell.anchor_rids[j]), score[first], cell.ids[first], cell.rids[first])
        for column, values in zip(out, found):
            column.append(values)
    return _table(out, _FOUND)


def _first_negatives(rows: pa.Table, anchors: pa.Table, width: int, k: int, low: int) -> pa.Table:
    """A cell's first k rows of other labels within each positive's limits."""
    cell, out = Cell(rows, anchors, width), [[] for _ in range(8)]
    positives = anchors["positives"].to_pylist()
    for j, score in cell.scores():
        other = np.flatnonzero(cell.labels != cell.anchor_labels[j])
        order = other[np.lexsort((other, -score[other]))]
        falling = -score[order]
        for p in positives[j]:
            upper = p["score"]
            lower = -((-low * upper) // 100)  # the least score with 100 * score >= low * upper
            start = int(np.searchsorted(falling, -upper, "left"))
            stop = int(np.searchsorted(falling, -lower, "right"))
            got = order[start : max(start, min(stop, start + k))]
            n = len(got)
            found = (
                np.full(n, cell.anchor_ids[j]), np.full(n, cell.anchor_rids[j]), np.full(n, p["positive_id"]),
                np.full(n, p["positive_rid"]), np.full(n, upper), cell.ids[got], cell.rids[got], score[got],
            )
            for column, values in zip(out, found):
                column.append(values)
    return _table(out, _MINED)


def mine(
    df: DataFrame,
    anchor: Column,
    *,
    positives: int = 5,
    negatives: int = 5,
    low: int = 80,
    scale: int = 256,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
) -> DataFrame:
    """The mined rows (``RESULT``); ``anchor`` says of a ``vec_id`` whether it is one."""
    spark = df.sparkSession
    taking_part = df.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
    whole, width = integer_rows(taking_part, scale, id_col=id_col, vector_col=vector_col, label_col=label_col)
    path = scratch(spark, "negatives")
    whole.groupBy("vec_id", "label", "v").agg(F.xxhash64("vec_id", "label", "v").alias("rid")).write.parquet(path)
    rows = spark.read.parquet(path)
    size = rows.agg(F.count("*").alias("n"), F.count_if(anchor).alias("anchors")).first()
    row_blocks = max(parts_of(df), math.ceil(size["n"] / ROWS))
    anchor_blocks = max(1, math.ceil(size["anchors"] / ANCHORS))

    def at(blocks: int, name: str, salt: int) -> Column:
        return F.pmod(F.xxhash64("rid", F.lit(salt)), F.lit(blocks)).cast("int").alias(name)

    def every(blocks: int, name: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias(name)

    queries = spark.read.parquet(path).where(anchor)
    asking = spark.read.parquet(path).where(anchor)  # with columns of its own
    dealt = rows.select("*", at(row_blocks, "b", 1), every(anchor_blocks, "a")).groupBy("b", "a")
    cells = dealt.cogroup(queries.select("*", at(anchor_blocks, "a", 2), every(row_blocks, "b")).groupBy("b", "a"))

    def first_positives(left: pa.Table, right: pa.Table) -> pa.Table:
        held(None)
        return _first_positives(left, right, width, positives)

    def first_negatives(left: pa.Table, right: pa.Table) -> pa.Table:
        held(None)
        return _first_negatives(left, right, width, negatives, low)

    best = Window.partitionBy("anchor_id", "anchor_rid").orderBy(F.desc("score"), "positive_id", "positive_rid")
    found = cells.applyInArrow(first_positives, _FOUND).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= positives)
    listed = found.groupBy("anchor_id", "anchor_rid").agg(F.collect_list(F.struct("score", "positive_id", "positive_rid")).alias("positives"))
    asked = asking.join(listed, (F.col("vec_id") == F.col("anchor_id")) & (F.col("rid") == F.col("anchor_rid"))).select(*asking.columns, "positives")
    again = dealt.cogroup(asked.select("*", at(anchor_blocks, "a", 2), every(row_blocks, "b")).groupBy("b", "a"))
    of = Window.partitionBy("anchor_id", "anchor_rid", "positive_id", "positive_rid")
    ranked = again.applyInArrow(first_negatives, _MINED).withColumn(
        "rank", F.row_number().over(of.orderBy(F.desc("negative_score"), "negative_id", "negative_rid"))
    )
    return ranked.where(F.col("rank") <= negatives).select(*RESULT)
