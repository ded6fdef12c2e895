"""Operator 3, byte-level BPE encoding and decoding.

Token starts come from the codepoint-class scan of ``pretoken`` (no regular
expression); the slices feed pair merging behind a bounded cache; offsets of
the tokens in bytes are kept, so any id range can be decoded on its own.

Null text counts as empty; an empty text has no ids and decodes to no bytes;
repeated rows and ids pass through; other columns are ignored.  Ids that the
vocabulary does not have are refused when decoding.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bpe, pretoken
from .runtime import held, map_blocks


def codec_of(path: str, kinds: bytes) -> "Codec":
    """Kept by a Python worker from task to task."""
    return held(("codec", path), lambda: Codec(path, kinds))


ENCODED = "doc_id long, ids binary, n_tokens long, piece_ends array<long>"


class Codec:
    """Encode by a rank file; ids are little-endian unsigned 32-bit integers."""

    def __init__(self, path: str, kinds: bytes):
        self.vocab = bpe.from_ranks(path)
        top = max(self.vocab.bytes) + 1
        table = [self.vocab.bytes.get(i, b"") for i in range(top)]
        self.flat = np.frombuffer(b"".join(table), dtype=np.uint8)
        self.length = np.fromiter(map(len, table), dtype=np.int64, count=top)
        self.begin = np.cumsum(self.length) - self.length

        def learn(pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
            ids = self.vocab.encode_many([p.encode() for p in pieces])
            return np.concatenate(ids), np.fromiter(map(len, ids), dtype=np.int64, count=len(ids))

        self.pieces = bpe.PieceIds(lambda texts: pretoken.distinct(texts, kinds), learn)

    def encode(self, texts: list[str]) -> list[bytes]:
        return [i.tobytes() for i in self.pieces.by_text(texts)]

    def encode_with_ends(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Of each text the ids, and the byte offset where each pre-token ends."""
        ids, ends, places = self.pieces.encode(texts)
        offsets = self.offsets(ids)[ends]
        return [(ids[ends[a] : ends[b]], offsets[a + 1 : b + 1] - offsets[a]) for a, b in zip(places.tolist(), places[1:].tolist())]

    def offsets(self, ids: bytes | np.ndarray) -> np.ndarray:
        """Byte offset of every token's start, and the end."""
        ids = np.frombuffer(ids, dtype="<u4") if isinstance(ids, bytes) else ids
        if len(ids) and (int(ids.max()) >= len(self.length) or not self.length[ids].all()):
            raise ValueError("ids that the vocabulary does not have")
        return np.concatenate(([0], np.cumsum(self.length[ids])))

    def decode(self, ids: bytes | np.ndarray) -> bytes:
        """The bytes of the ids, each token's laid at its offset."""
        ids = np.frombuffer(ids, dtype="<u4") if isinstance(ids, bytes) else ids
        at = self.offsets(ids)
        return self.flat[np.repeat(self.begin[ids] - at[:-1], self.length[ids]) + np.arange(at[-1])].tobytes()

    def decode_part(self, ids: np.ndarray, ends: np.ndarray, first: int, last: int) -> bytes:
        """The bytes of the pre-tokens ``first .. last``, by the offsets kept."""
        at = self.offsets(ids)
        begin = int(ends[first - 1]) if first else 0
        low, high = np.searchsorted(at, (begin, int(ends[last])))
        return self.decode(ids[low:high])


def encode(docs: DataFrame, ranks_path: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Ids of every whole text, and the byte offset where each pre-token ends."""
    kinds = pretoken.kinds_by_tiktoken()

    def make():
        codec = codec_of(ranks_path, kinds)

        def run(cols: dict[str, list]) -> dict[str, list]:
            done = codec.encode_with_ends([t or "" for t in cols["text"]])
            return {
                "doc_id": cols["doc_id"],
                "ids": [i.tobytes() for i, _ in done],
                "n_tokens": [len(i) for i, _ in done],
                "piece_ends": [e for _, e in done],
            }

        return run

    cols = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return map_blocks(cols, make, ENCODED, keeps=True)


def decode(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """Bytes of each row's ids, as text; bytes that are no UTF-8 become U+FFFD."""
    kinds = pretoken.kinds_by_tiktoken()

    def make():
        codec = codec_of(ranks_path, kinds)

        def run(cols: dict[str, list]) -> dict[str, list]:
            return {"doc_id": cols["doc_id"], "text": [codec.decode(i or b"").decode("utf-8", "replace") for i in cols["ids"]]}

        return run

    return map_blocks(encoded.select("doc_id", "ids", F.lit(None).cast("string").alias("text")), make, "doc_id long, text string", keeps=True)


DIGESTS = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def round_trip(docs: DataFrame, ranks_path: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode, decode the ids, and report digests of both, in one pass."""
    kinds = pretoken.kinds_by_tiktoken()

    def make():
        codec = codec_of(ranks_path, kinds)

        def run(cols: dict[str, list]) -> dict[str, list]:
            done = codec.encode_with_ends([t or "" for t in cols["text"]])
            back = [codec.decode(ids) for ids, _ in done]
            if any(len(b) != (e[-1] if len(e) else 0) for b, (_, e) in zip(back, done)):
                raise ValueError("decoded bytes do not end where the last pre-token does")
            return {
                "doc_id": cols["doc_id"],
                "n_tokens": [len(i) for i, _ in done],
                "ids_sha256": [hashlib.sha256(i.tobytes()).hexdigest() for i, _ in done],
                "decoded_sha256": [hashlib.sha256(b).hexdigest() for b in back],
            }

        return run

    cols = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return map_blocks(cols, make, DIGESTS, keeps=True)
