"""Operator 7, token-id files: bit-plane shuffling with a chunk index.

A file holds the ids of consecutive documents, each ended by the end id, cut
into chunks of ``CHUNK`` ids.  A chunk of n ids is transposed into planes: plane
p holds bit p (or byte p) of all its ids, so the high planes of small ids are
almost constant; every plane is compressed with zstandard on its own.  Layout,
all integers little-endian::

    magic "PGTOKEN1", u8 plane kind (1 bits, 8 bytes), 7 zero bytes
    the planes of each chunk, one after the other
    document table, zstandard: i64 doc_id, u64 tokens, u8 id is null - as columns
    index: for each chunk u64 offset, u32 ids, 32 or 4 u32 plane sizes
    footer: u64 table offset, u64 table size, u64 documents,
            u64 index offset, u64 chunks, u64 ids, magic

Each attempt of a task writes files of its own, moved from a working name once
they are whole; the manifest, checkpointed, says which ones count, and the
others (of lost executors or second attempts) are deleted after it is written.
Files go to a folder that all executors share, by the file system its URI
names.  Documents are dealt to ranges of ids, a file a range, so file names in
order hold ids in order and a document's start is its file's start plus its
place in it.

Null text counts as empty (just the end id).  Null ids sort first, rows that
share an id by text; each row is a document.  Other columns are ignored.  An
empty table gives no files and no rows.
"""

from __future__ import annotations

import binascii
import os
import struct
import uuid
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import bpe, pretoken
from .ordered import in_ranges
from .runtime import BLOCK_CHARS, durable, held, scratch

MAGIC = b"PGTOKEN1"
CHUNK = 1 << 16
BITS, BYTES = 1, 8
_FOOTER = struct.Struct("<6Q8s")
MANIFEST = "part int, file string, n_docs long, n_ids long, n_bytes long"
READ = "doc_id long, start long, n_tokens long, ids_crc32 long"


def to_planes(ids: np.ndarray, kind: int) -> list[bytes]:
    """Bit planes (32, packed) or byte planes (4) of 32-bit ids."""
    raw = ids.astype("<u4").view(np.uint8).reshape(-1, 4)
    if kind == BYTES:
        return [np.ascontiguousarray(raw[:, p]).tobytes() for p in range(4)]
    bits = np.unpackbits(raw, axis=1, bitorder="little")
    return [np.packbits(bits[:, p], bitorder="little").tobytes() for p in range(32)]


def from_planes(planes: list[bytes], n: int, kind: int) -> np.ndarray:
    if kind == BYTES:
        raw = np.stack([np.frombuffer(p, dtype=np.uint8) for p in planes], axis=1)
    else:
        rows = [np.unpackbits(np.frombuffer(p, dtype=np.uint8), count=n, bitorder="little") for p in planes]
        raw = np.packbits(np.stack(rows, axis=1), axis=1, bitorder="little")
    return np.ascontiguousarray(raw).view("<u4").reshape(-1)


class Writer:
    """Streams ids into chunks; holds one chunk and the document table."""

    def __init__(self, sink, kind: int = BYTES, level: int = 3):
        self.sink, self.kind = sink, kind
        self.pack = zstandard.ZstdCompressor(level=level)
        self.at = self.n_ids = self.pending = 0
        self.parts: list[np.ndarray] = []
        self.index: list[bytes] = []
        self.doc_ids, self.counts, self.nulls = array("q"), array("Q"), bytearray()
        self._put(MAGIC + bytes([kind]) + bytes(7))

    def _put(self, data: bytes) -> None:
        self.sink.write(data)
        self.at += len(data)

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.doc_ids.append(doc_id or 0)
        self.nulls.append(doc_id is None)
        self.counts.append(len(ids))
        self.parts.append(ids)
        self.pending += len(ids)
        if self.pending >= CHUNK:
            whole = np.concatenate(self.parts)
            cut = len(whole) - len(whole) % CHUNK
            for k in range(0, cut, CHUNK):
                self._chunk(whole[k : k + CHUNK])
            self.parts, self.pending = [whole[cut:]], len(whole) - cut

    def _chunk(self, ids: np.ndarray) -> None:
        planes = [self.pack.compress(p) for p in to_planes(ids, self.kind)]
        self.index.append(struct.pack(f"<QI{len(planes)}I", self.at, len(ids), *map(len, planes)))
        for p in planes:
            self._put(p)
        self.n_ids += len(ids)

    def close(self) -> None:
        if self.pending:
            self._chunk(np.concatenate(self.parts))
        table_at = self.at
        self._put(self.pack.compress(self.doc_ids.tobytes() + self.counts.tobytes() + bytes(self.nulls)))
        index_at = self.at
        self._put(b"".join(self.index))
        n = len(self.doc_ids)
        self._put(_FOOTER.pack(table_at, index_at - table_at, n, index_at, len(self.index), self.n_ids, MAGIC))


class Reader:
    """Random access by chunk; ``documents`` streams chunk by chunk."""

    def __init__(self, source):
        self.source = source
        end = source.size()
        foot = self._get(end - _FOOTER.size, _FOOTER.size)
        table_at, table_size, self.n_docs, index_at, n_chunks, self.n_ids, magic = _FOOTER.unpack(foot)
        head = self._get(0, 16)
        if magic != MAGIC or head[:8] != MAGIC:
            raise ValueError("not a token file")
        self.kind = head[8]
        row = struct.Struct(f"<QI{32 if self.kind == BITS else 4}I")
        self.index = list(row.iter_unpack(self._get(index_at, n_chunks * row.size)))
        self.unpack = zstandard.ZstdDecompressor()
        table = self.unpack.decompress(self._get(table_at, table_size)) if self.n_docs else b""
        n = self.n_docs
        self.doc_ids = np.frombuffer(table, dtype="<i8", count=n)
        self.counts = np.frombuffer(table, dtype="<u8", count=n, offset=8 * n).astype(np.int64)
        self.nulls = np.frombuffer(table, dtype=np.uint8, count=n, offset=16 * n).astype(bool)

    def _get(self, at: int, size: int) -> bytes:
        self.source.seek(at)
        return self.source.read(size)

    def chunk(self, k: int) -> np.ndarray:
        at, n, *sizes = self.index[k]
        raw, planes, done = self._get(at, sum(sizes)), [], 0
        for size in sizes:
            planes.append(self.unpack.decompress(raw[done : done + size]))
            done += size
        return from_planes(planes, n, self.kind)

    def documents(self) -> Iterator[tuple[int | None, np.ndarray]]:
        held, k = np.zeros(0, dtype="<u4"), 0
        for doc_id, n, null in zip(self.doc_ids.tolist(), self.counts.tolist(), self.nulls.tolist()):
            while len(held) < n:
                held = np.concatenate((held, self.chunk(k)))
                k += 1
            yield None if null else doc_id, held[:n]
            held = held[n:]


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    """The file system a URI names, and the path in it; plain paths are local."""
    return fs.FileSystem.from_uri(path) if ":/" in path else (fs.LocalFileSystem(), path)


def encoder(path: str, kinds: bytes) -> bpe.PieceIds:
    """The tokenizers library behind a table of pre-tokens.

    The library's merges never cross a pre-token, so its model is asked once for
    each distinct one, in the byte alphabet that it expects.
    """
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(path)
    special = {t.content: i for i, t in library.get_added_tokens_decoder().items()}
    if len(special) > 1:
        raise ValueError("one special token at most")
    mark, mark_id = next(iter(special.items()), (None, None))
    model, shown = library.model, str.maketrans({chr(b): c for c, b in bpe.byte_alphabet().items()})

    def learn(pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        flat, sizes = array("I"), []
        for p in pieces:
            ids = [mark_id] if p == mark else [t.id for t in model.tokenize(p.encode().decode("latin-1").translate(shown))]
            flat.extend(ids)
            sizes.append(len(ids))
        return np.frombuffer(flat, dtype="<u4"), np.array(sizes, dtype=np.int64)

    return bpe.PieceIds(lambda texts: pretoken.distinct(texts, kinds, mark), learn, 1 << 19)


def write_files(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int, *, kind: int = BYTES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode every whole text and write one file for each range of ids.

    Returns the manifest, a row a file.  It is checkpointed: the files are
    written once, and a lost executor only repeats its own files.
    """
    kinds = pretoken.kinds_by_tiktoken()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = held(("files", tokenizer_path), lambda: encoder(tokenizer_path, kinds))
        system, root = file_system(folder)
        end = np.array([end_id], dtype="<u4")
        writer = sink = own = part = None

        def finish() -> pa.RecordBatch:
            writer.close()
            sink.close()
            name = f"{root}/part-{part:06d}-{uuid.uuid4().hex}.pgt"
            system.move(own, name)
            row = (part, name, len(writer.counts), writer.n_ids, writer.at)
            return pa.RecordBatch.from_arrays(
                [pa.array([v], type=t) for v, t in zip(row, (pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64()))],
                names=["part", "file", "n_docs", "n_ids", "n_bytes"],
            )

        for batch in batches:
            doc_ids, texts, of = (batch.column(c).to_pylist() for c in ("doc_id", "text", "part"))
            at = 0
            while at < len(texts):
                size, stop = 0, at
                while stop < len(texts) and of[stop] == of[at] and (stop == at or size + len(texts[stop]) < BLOCK_CHARS):
                    size += len(texts[stop])
                    stop += 1
                if of[at] != part:
                    if writer:
                        yield finish()
                    part = of[at]
                    own = f"{root}/_writing-{part:06d}-{uuid.uuid4().hex}"
                    sink = system.open_output_stream(own)
                    writer = Writer(sink, kind)
                for doc_id, ids in zip(doc_ids[at:stop], codec.by_text(texts[at:stop])):
                    writer.add(doc_id, np.concatenate((ids, end)))
                at = stop
        if writer:
            yield finish()

    system, root = file_system(folder)
    system.create_dir(root, recursive=True)
    cols = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    dealt, _ = in_ranges(cols, "doc_id", "text")
    manifest = durable(dealt.select("doc_id", "text", "part").mapInArrow(run, MANIFEST))
    held_files = {r["file"].rpartition("/")[2] for r in manifest.select("file").toLocalIterator()}  # one a range
    for info in system.get_file_info(fs.FileSelector(root)):
        if info.base_name not in held_files:
            system.delete_file(info.path)
    return manifest


def read_files(manifest: DataFrame, folder: str) -> DataFrame:
    """Read the files back: each document's start, length and checksum.

    Starts need the sizes of all earlier files: one number a file, summed on
    the manifest (which has as many rows as shuffle partitions).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, _ = file_system(folder)
        for batch in batches:
            for name, start in zip(batch.column("file").to_pylist(), batch.column("start").to_pylist()):
                with system.open_input_file(name) as source:
                    rows: list[tuple] = []
                    for doc_id, ids in Reader(source).documents():
                        rows.append((doc_id, start, len(ids), binascii.crc32(ids.tobytes())))
                        start += len(ids)
                        if len(rows) == 10_000:
                            yield _rows(rows)
                            rows = []
                    if rows:
                        yield _rows(rows)

    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = manifest.select("part", "file", F.coalesce(F.sum("n_ids").over(earlier), F.lit(0)).alias("start"))
    n_files = max(1, manifest.count())
    placed = sums.withColumn("at", F.row_number().over(Window.orderBy("part")) - 1)
    return placed.repartitionById(n_files, F.col("at")).select("file", "start").mapInArrow(run, READ)


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, type=pa.int64()) for c in zip(*rows)], names=["doc_id", "start", "n_tokens", "ids_crc32"]
    )


def round_trip(docs: DataFrame, tokenizer_path: str, end_id: int) -> DataFrame:
    """Write to a new folder in the shared scratch space and read back."""
    folder = scratch(docs.sparkSession, "tokens")
    return read_files(write_files(docs, folder, tokenizer_path, end_id), folder)
