"""Operator 6, language identification: multinomial naive Bayes over hashed
character n-grams.

Counting is one pass: every task sums n-gram counts of its rows by language
and sends one sparse row per (language, bucket), which a shuffle adds up; the
result is a languages x buckets matrix whatever the corpus size.  Buckets are the
leading bits of a hash, so the sums of fewer, wider buckets follow from those of
more: with many labels there are as many bits as keep the matrix within
``MAX_MODEL_BYTES`` (2^14 buckets up to 512 labels, half as many for twice the
labels).  The matrix of log probabilities is broadcast; scoring is a product of
a sparse batch (texts x buckets, a coordinate an n-gram) with it in numpy.

A text that is null or has no letter is ``und`` with score 0.  The score is the
posterior probability, tempered by the square root of the number of n-grams
(n-grams overlap, so the raw product is far too sure).  Rows repeat and pass
through as they are; null ids stay null and are never held out; other columns
are ignored.  With no usable training row every text is ``und``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .runtime import durable, filter_rows, map_blocks

#: Hash buckets (a power of two) and n-gram orders.
BUCKET_BITS = 14
ORDERS = (1, 2, 3)
#: Bytes of the matrix that may be broadcast.
MAX_MODEL_BYTES = 64 << 20
#: Labels whose counts a task holds before it sends them on.
LABELS_HELD = 64
#: Additive smoothing of bucket counts.
SMOOTHING = 0.5
PREDICTED = "doc_id long, lang_pred string, score double"


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def features(text: str, bits: int = BUCKET_BITS) -> np.ndarray:
    """Hash buckets of the n-grams of the lower-cased text.

    Anything but letters becomes one blank; blanks count in n-grams, so word
    starts and ends are seen.
    """
    cps = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    letter = _letters().take(cps)
    cps = np.where(letter, cps, np.uint32(32))
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    keep[0] = True
    cps = cps[keep].astype(np.uint64)
    shift = np.uint64(64 - bits)
    out = []
    for n in ORDERS:
        if len(cps) < n:
            continue
        h = np.full(len(cps) - n + 1, n, dtype=np.uint64)
        for k in range(n):
            h = (h ^ cps[k : len(cps) - n + 1 + k]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        out.append(h >> shift)
    return np.concatenate(out).astype(np.int64)


_LETTER_TABLE: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """Which code points are letters, for every code point."""
    if not _LETTER_TABLE:
        table = np.zeros(0x110000, dtype=bool)
        table[[c for c in range(0x110000) if chr(c).isalpha()]] = True
        _LETTER_TABLE.append(table)
    return _LETTER_TABLE[0]


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


@dataclass
class Model:
    """Log probabilities, languages x buckets, and log priors."""

    langs: list[str]
    log_prob: np.ndarray
    log_prior: np.ndarray
    bits: int

    def score(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        preds, scores = ["und"] * len(texts), [0.0] * len(texts)
        rows = [i for i, t in enumerate(texts) if t and self.langs and has_letter(t)]
        if not rows:
            return preds, scores
        grams = [features(texts[i], self.bits) for i in rows]
        size = np.fromiter(map(len, grams), dtype=np.int64, count=len(grams))
        bucket, begin = np.concatenate(grams), np.cumsum(size) - size
        log = np.stack([p + np.add.reduceat(line.take(bucket), begin) for p, line in zip(self.log_prior, self.log_prob)])
        best = log.argmax(axis=0)
        gap = (log - log.max(axis=0)) / np.sqrt(np.maximum(size, 1))
        sure = 1.0 / np.exp(gap).sum(axis=0)
        for i, k, p in zip(rows, best.tolist(), sure.tolist()):
            preds[i], scores[i] = self.langs[k], p
        return preds, scores


def train(rows: DataFrame, *, text_col: str = "text", label_col: str = "lang", bits: int = BUCKET_BITS) -> Model:
    """Fit on all rows whose text and label are not null.

    The driver receives at most ``MAX_MODEL_BYTES`` of sums, a row a label.
    More labels than that many bytes have numbers are no languages: ValueError.
    """

    def rows_of(sums: dict[str, np.ndarray], n_docs: dict[str, int]) -> Iterator[pa.RecordBatch]:
        for label, total in sums.items():
            at = np.flatnonzero(total)
            at, n = np.append(at, -1), np.append(total[at], n_docs[label])
            yield pa.RecordBatch.from_arrays(
                [pa.array([label] * len(at)), pa.array(at, type=pa.int64()), pa.array(n, type=pa.int64())],
                names=["label", "bucket", "n"],
            )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        n_docs: dict[str, int] = {}
        for batch in batches:
            labels, texts = batch.column(1).to_pylist(), batch.column(0)
            for label, text in zip(labels, texts):
                text = text.as_py()
                if not has_letter(text):
                    continue
                if label not in sums:
                    if len(sums) >= LABELS_HELD:
                        yield from rows_of(sums, n_docs)
                        sums, n_docs = {}, {}
                    sums[label] = np.zeros(1 << bits, dtype=np.int64)
                sums[label] += np.bincount(features(text, bits), minlength=1 << bits)
                n_docs[label] = n_docs.get(label, 0) + 1
        yield from rows_of(sums, n_docs)

    usable = rows.select(F.col(text_col).alias("t"), F.col(label_col).cast("string").alias("l")).dropna()
    sums = durable(
        usable.mapInArrow(count, "label string, bucket long, n long").groupBy("label", "bucket").agg(F.sum("n").alias("n"))
    )
    n_labels = sums.where("bucket < 0").count()
    kept = bits
    while n_labels * (8 << kept) > MAX_MODEL_BYTES:
        kept -= 1
        if kept < 0:
            raise ValueError("too many labels to be languages")
    narrow = F.when(F.col("bucket") < 0, -1).otherwise(F.shiftright("bucket", bits - kept))
    # a language's sums travel as one array, so the driver gets a row a language
    packed = (
        sums.groupBy("label", narrow.alias("bucket")).agg(F.sum("n").alias("n"))
        .groupBy("label").agg(F.collect_list(F.struct("bucket", "n")).alias("v"))
    )
    langs, n_docs = [], []
    matrix = np.zeros((n_labels, 1 << kept))
    for k, row in enumerate(packed.orderBy("label").toLocalIterator()):
        langs.append(row["label"])
        for bucket, n in row["v"]:
            if bucket < 0:
                n_docs.append(n)
            else:
                matrix[k, bucket] = n
    matrix += SMOOTHING
    prior = np.array(n_docs, dtype=float)
    return Model(langs, np.log(matrix / matrix.sum(axis=1, keepdims=True)), np.log(prior / max(prior.sum(), 1.0)), kept)


def predict(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Language and score of every whole text, in one pass without a shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        held = shared.value

        def run(cols: dict[str, list]) -> dict[str, list]:
            preds, scores = held.score(cols["text"])
            return {"doc_id": cols["doc_id"], "lang_pred": preds, "score": scores}

        return run

    cols = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return map_blocks(cols, make, PREDICTED)


def keep_identified(docs: DataFrame, model: Model, *, text_col: str = "text", least_score: float = 0.5) -> DataFrame:
    """The rows whose language is known with at least that score; rows without
    a letter, null texts and undecided ones go."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        held = shared.value

        def run(texts: list) -> list[bool]:
            preds, scores = held.score(texts)
            return [p != "und" and s >= least_score for p, s in zip(preds, scores)]

        return run

    return filter_rows(docs, make, text_col)
