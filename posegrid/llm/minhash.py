"""Operator 4, MinHash near-duplicate detection.

Sketching follows "fast similarity sketching" (Dahlgaard, Knudsen and Thorup,
2017).  In round ``i`` every shingle is hashed to one of ``t`` bins with a value
in ``[i, i+1)`` and each bin keeps its least; rounds go on until all bins are
filled, and rounds ``t .. 2t-1`` send every shingle to bin ``i - t``, so every
coordinate fills.  The share of equal coordinates of two sketches has mean J and
is concentrated like a sum of ``t`` independent trials, for O(t log t + n) hashes.

From sketches to components:

1. Equal shingle sets form a class, whose representative is its least id.
2. Representatives share a bucket for each band of ``ROWS`` equal coordinates
   (``BANDS`` of them: a pair at 0.8 meets with chance 1 - 5e-7, a higher one
   with more).
3. In each bucket all members are verified on their full sets against the least
   one; the links found give components.
4. A bucket whose members are in one component by now is done.  In the others
   all pairs of members of different components are verified on full sets, in
   blocks of bounded size, without emitting the pairs; only links are emitted.
5. Components again, over all links.

No bucket, candidate or partner is capped.  Buckets are counted by partial
aggregation and joined back, so no task gets all members of one; those compared
in full are split into blocks of at most ``BLOCK`` members, fewer where their
sets are large (``BLOCK_BYTES``).  Large exact groups meet only in partial
aggregation.

Null or wordless texts, and rows with a null id, are linked with nothing (their
component is their own id, and they are kept).  Rows that share an id and a text
fall in one class; rows that share an id only are one node, linked if either
text is.  Other columns are ignored.  An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shingles as sh
from .components import components
from .runtime import durable, map_blocks, unused

BANDS, ROWS = 48, 6
#: Members of a bucket that one task compares with as many others, and the mean
#: size of a block's sets.
BLOCK, BLOCK_BYTES = 256, 8 << 20
_ROUND = 0xA24BAED4963EE407
_TOP = np.uint64(0xFFFFFFFFFFFFFFFF)


def sketch_many(sets: list[np.ndarray], t: int) -> np.ndarray:
    """Sketches of non-empty sets, a row each, all sets side by side."""
    out = np.full((len(sets), t), _TOP, dtype=np.uint64)
    flat = out.reshape(-1)
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    items = np.concatenate(sets) if sets else np.zeros(0, dtype=np.uint64)
    owner = np.repeat(np.arange(len(sets)), sizes)
    for i in range(2 * t):
        if not len(items):
            break
        h = sh.mix(items + np.uint64((i + 1) * _ROUND & 0xFFFFFFFFFFFFFFFF))
        bins = ((h >> np.uint64(32)) * np.uint64(t)) >> np.uint64(32) if i < t else np.full(len(h), i - t, dtype=np.uint64)
        value = (np.uint64(i) << np.uint64(48)) | (sh.mix(h) >> np.uint64(16))
        np.minimum.at(flat, owner * t + bins.astype(np.int64), value)
        if i < 4 or i % 8 == 7:  # drop the sets that are full
            open_ = (out == _TOP).any(axis=1)
            keep = open_[owner]
            items, owner = items[keep], owner[keep]
    return out


def band_keys(sketch: np.ndarray, bands: int, rows: int) -> np.ndarray:
    key = np.arange(1, bands + 1, dtype=np.uint64)[None, :] * np.uint64(_ROUND) + np.zeros((len(sketch), 1), dtype=np.uint64)
    parts = sketch[:, : bands * rows].reshape(len(sketch), bands, rows)
    for k in range(rows):
        key = sh.mix(key ^ parts[:, :, k])
    return key.view(np.int64)


def signatures(docs: DataFrame, size: int, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(doc_id, n_shingles, digest of the set, band keys) of every row."""

    def make():
        def run(cols: dict[str, list]) -> dict[str, list]:
            sets = sh.shingles([t or "" for t in cols["text"]], size)
            full = [i for i, s in enumerate(sets) if len(s)]
            keys: list = [None] * len(sets)
            digest: list = [None] * len(sets)
            for at in range(0, len(full), 512):
                part = full[at : at + 512]
                lines = band_keys(sketch_many([sets[i] for i in part], bands * rows), bands, rows)
                for i, line in zip(part, lines):
                    keys[i] = line
                    digest[i] = hashlib.blake2b(sets[i].tobytes(), digest_size=16).digest()
            return {"doc_id": cols["doc_id"], "n_shingles": [len(s) for s in sets], "digest": digest, "bands": keys}

        return run

    return map_blocks(docs, make, "doc_id long, n_shingles long, digest binary, bands array<long>")


def _sets(docs: DataFrame, size: int) -> DataFrame:
    def make():
        def run(cols: dict[str, list]) -> dict[str, list]:
            sets = sh.shingles([t or "" for t in cols["text"]], size)
            return {"node": cols["doc_id"], "shingles": [s.tobytes() for s in sets]}

        return run

    return map_blocks(docs, make, "node long, shingles binary")


def _verified(pairs: DataFrame, percent: int) -> DataFrame:
    """Keep the pairs whose full sets are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                a = np.frombuffer(x.as_buffer(), dtype=np.uint64)
                b = np.frombuffer(y.as_buffer(), dtype=np.uint64)
                keep.append(similar(a, b, percent))
            yield batch.select([0, 1]).filter(pa.array(keep, type=pa.bool_()))

    return pairs.select("u", "v", "x", "y").mapInArrow(run, "u long, v long")


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """100 * intersection >= percent * union, for sorted distinct arrays."""
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    if 100 * len(small) < percent * len(large) or not len(small):
        return False
    at = np.searchsorted(large, small)
    common = int((large[np.minimum(at, len(large) - 1)] == small).sum())
    return 100 * common >= percent * (len(a) + len(b) - common)


def _block_links(percent: int):
    """All links between members of different components, within one block."""

    def run(table: pa.Table) -> pa.Table:
        node, comp = np.array(table["node"].to_pylist()), np.array(table["component"].to_pylist())
        left = np.array(table["left"].to_pylist())
        right = np.array(table["right"].to_pylist())
        sets = [np.frombuffer(x.as_buffer(), dtype=np.uint64) for c in table["shingles"].chunks for x in c]
        sizes = np.array([len(s) for s in sets])
        _, index = np.unique(np.concatenate(sets), return_inverse=True)
        starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
        mask = np.zeros(int(index.max()) + 1, dtype=np.int32)
        names, counts = np.unique(comp, return_counts=True)
        main = names[counts.argmax()]
        us, vs = [], []
        order = np.arange(len(node))
        for i in np.flatnonzero(comp != main):
            part = index[starts[i] : starts[i] + sizes[i]]
            other = (comp != comp[i]) & ((comp == main) | (order > i)) & ((left[i] & right) | (right[i] & left))
            other &= (100 * np.minimum(sizes, sizes[i]) >= percent * np.maximum(sizes, sizes[i]))
            if not other.any():
                continue
            mask[part] = 1
            common = np.add.reduceat(mask[index], starts)
            mask[part] = 0
            for j in np.flatnonzero(other & (100 * common >= percent * (sizes + sizes[i] - common))):
                us.append(int(node[i]))
                vs.append(int(node[j]))
        return pa.table({"u": pa.array(us, type=pa.int64()), "v": pa.array(vs, type=pa.int64())})

    return run


def near_duplicates(
    docs: DataFrame,
    *,
    shingle_words: int = 5,
    percent: int = 80,
    id_col: str = "doc_id",
    text_col: str = "text",
    bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    signed = durable(signatures(docs, shingle_words, bands, rows))
    linkable = signed.where("doc_id is not null and digest is not null")
    classes = linkable.groupBy("digest").agg(F.min("doc_id").alias("node"))
    reps = linkable.select("doc_id", "digest", "n_shingles", "bands").join(
        classes.withColumnRenamed("node", "doc_id"), ["digest", "doc_id"]
    ).select(F.col("doc_id").alias("node"), "n_shingles", "bands")
    keyed = reps.select("node", F.explode("bands").alias("key"))
    buckets = keyed.groupBy("key").agg(F.count("*").alias("n"), F.min("node").alias("pivot")).where("n > 1")
    members = durable(keyed.join(buckets, "key").select("node", "key", "n", "pivot"))
    nodes = members.select("node").distinct()
    sets = durable(
        _sets(docs.join(nodes.withColumnRenamed("node", "doc_id"), "doc_id", "left_semi"), shingle_words).distinct()
    )
    stars = members.where("pivot <> node").select(F.col("pivot").alias("u"), F.col("node").alias("v")).distinct()
    pairs = stars.join(sets.selectExpr("node AS v", "shingles AS y"), "v").join(
        sets.selectExpr("node AS u", "shingles AS x"), "u"
    )
    links = durable(_verified(pairs, percent))
    first = durable(components(links))
    placed = members.join(first, "node", "left").withColumn("component", F.coalesce("component", "node"))
    sized = placed.join(reps.select("node", "n_shingles"), "node")
    open_buckets = (
        sized.where("n > 2").groupBy("key")
        .agg(F.min("component").alias("low"), F.max("component").alias("high"), F.sum(8 * F.col("n_shingles").cast("long")).alias("bytes"))
        .where("low <> high").select("key", "bytes")
    )
    live = (
        sized.join(open_buckets, "key")
        .withColumn("blocks", F.ceil(F.greatest(F.col("n") / BLOCK, F.col("bytes") / BLOCK_BYTES)).cast("int"))
        .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    )
    # block b of a bucket meets blocks b.. of it: each pair of blocks is one group
    spread = live.select(
        "key", "node", "component", "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    ).select(
        "key", "node", "component",
        F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
        (F.col("block") <= F.col("other")).alias("left"), (F.col("block") >= F.col("other")).alias("right"),
    )
    more = (
        spread.join(sets, "node")
        .groupBy("key", "low", "high")
        .applyInArrow(_block_links(percent), "u long, v long")
    )
    parts = components(links.unionByName(more))
    of_class = classes.join(parts, "node", "left").select("digest", F.coalesce("component", "node").alias("component_id"))
    result = signed.select("doc_id", "n_shingles", "digest").join(of_class, "digest", "left")
    own = F.when(F.col("doc_id").isNull(), F.lit(None)).otherwise(F.coalesce("component_id", "doc_id"))
    return result.select("doc_id", "n_shingles", own.alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id"))
    )


def keep_one(docs: DataFrame, *, shingle_words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All rows but those whose document links, directly or not, to one of a
    lesser id; rows with a null id stay.  All columns pass through."""
    found = near_duplicates(docs, shingle_words=shingle_words, percent=percent, id_col=id_col, text_col=text_col)
    name = unused("gone", docs)
    gone = found.where("not kept").select(F.col("doc_id").alias(name))
    return docs.join(gone, F.col(id_col).cast("long") == F.col(name), "left_anti")
