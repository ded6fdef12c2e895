"""Operator 9, document fingerprints: bottom-k sketches of shingle hashes.

The fingerprint of a set is the ``k`` least of its 64-bit shingle hashes (all of
them if fewer), as text: the hashes in ascending order, 16 hex digits each.  It
depends on the set only, and fingerprints of the parts of a set merge into that
of the whole.  Two of them estimate resemblance, containment and distinct
counts of the sets (exactly while the sets have at most ``k`` members).

Shingles have five words; see ``shingles`` for short and empty texts (the empty
set's fingerprint is "").  Null text counts as empty, and two empty sets are
alike (1.0).  Null ids sort first; rows that share an id are ordered by text.
Other columns are ignored.  An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shingles as sh
from .ordered import with_next_first
from .runtime import BLOCK_CHARS, map_blocks

K = 128
SHINGLE_WORDS = 5


def sketches(texts: list[str], k: int = K, size: int = SHINGLE_WORDS) -> list[np.ndarray]:
    return [s[:k] for s in sh.shingles(texts, size)]


def to_text(sketch: np.ndarray) -> str:
    return sketch.astype(">u8").tobytes().hex()


def from_text(text: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(text), dtype=">u8").astype(np.uint64)


def merge(a: np.ndarray, b: np.ndarray, k: int = K) -> np.ndarray:
    """The sketch of the union."""
    return np.union1d(a, b)[:k]


def distinct_count(a: np.ndarray, k: int = K) -> float:
    """Distinct shingles: exact below k, else (k - 1) / (k-th least, scaled)."""
    return float(len(a)) if len(a) < k else (k - 1) / (float(a[-1]) / 2.0**64)


def resemblance(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """|A and B| / |A or B|: the shared part of the union's sketch."""
    union = merge(a, b, k)
    if not len(union):
        return 1.0
    both = np.intersect1d(a, b, assume_unique=True)
    return float(np.isin(union, both, assume_unique=True).sum()) / len(union)


def containment(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """|A and B| / |A|, from resemblance and the union's and A's counts."""
    if not len(a):
        return 1.0
    shared = resemblance(a, b, k) * distinct_count(merge(a, b, k), k)
    return min(1.0, shared / max(1.0, distinct_count(a, k)))


def fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", k: int = K, size: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, fingerprint, n_distinct) of every whole text; one pass."""

    def make():
        def run(cols: dict[str, list]) -> dict[str, list]:
            found = sketches([t or "" for t in cols["text"]], k, size)
            return {
                "doc_id": cols["doc_id"],
                "fingerprint": [to_text(f) for f in found],
                "n_distinct": [distinct_count(f, k) for f in found],
            }

        return run

    cols = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return map_blocks(cols, make, "doc_id long, fingerprint string, n_distinct double")


EDITED = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double, containment_edited double"
)


def edit(text: str, following: str) -> str:
    """The last half replaced by as much of the beginning of the next text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def edited_likeness(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each text against its edited self and the next text in id order.

    One shuffle deals the texts to ranges of ids; the first row of the next
    range travels along, so every row finds its successor inside its task.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    fields = to_arrow_schema(docs.sparkSession.createDataFrame([], EDITED).schema)
    cols = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def work(ids: list, texts: list[str]) -> pa.RecordBatch:
        """All but the last row, which is only the successor."""
        edited = [edit(a, b) for a, b in zip(texts, texts[1:])]
        found = sketches([*texts, *edited])
        own, changed = found[: len(texts)], found[len(texts) :]
        rows = {
            "doc_id": ids[:-1],
            "n_chars": [len(t) for t in texts[:-1]],
            "edited_sha256": [hashlib.sha256(e.encode()).hexdigest() for e in edited],
            "fingerprint": [to_text(f) for f in own[:-1]],
            "edited_fingerprint": [to_text(f) for f in changed],
            "near_edited": [resemblance(a, b) for a, b in zip(own, changed)],
            "near_next": [resemblance(a, b) for a, b in zip(own, own[1:])],
            "containment_edited": [containment(a, b) for a, b in zip(own, changed)],
        }
        return pa.RecordBatch.from_arrays([pa.array(rows[f.name], type=f.type) for f in fields], schema=fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list = []
        texts: list[str] = []
        held, part, closed = 0, None, False
        for batch in batches:
            for doc_id, text, of, tail in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "part", "tail"))):
                if of != part:
                    ids, texts, held, part, closed = [], [], 0, of, False
                if closed:
                    continue
                ids.append(doc_id)
                texts.append(text)
                held += len(text)
                if tail or (held > BLOCK_CHARS // 2 and len(ids) > 1):
                    if len(ids) > 1:
                        yield work(ids, texts)
                    ids, texts, held, closed = ids[-1:], texts[-1:], len(text), tail

    return with_next_first(cols, "doc_id", "text").mapInArrow(run, EDITED)
