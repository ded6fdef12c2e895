"""Operator 12, best-fit packing by best-two-fit.

Documents become ids, each ended by the end id; one longer than the capacity is
cut into pieces of that length, its last piece the rest.  Pieces are then packed
into as few sequences of at most the capacity as best-two-fit finds: a sequence is filled
greedily, the longest piece that fits first; then, where room is left and it
holds more than one piece, its shortest one is replaced by two unpacked pieces
that together fill the gap it leaves more tightly.

What fits depends on lengths only, so the packing is worked out on their counts
(one number a length, at most the capacity), a *pattern* of lengths at a time: a pattern
is repeated until one of its lengths runs short, which is exact, as the same
choice would be made each time until then.  Every pattern uses up a length down
to what one sequence may hold of it, so there are at most about capacity * ln(capacity) patterns,
however many documents.  Pieces then find their places apart from each other: a
piece is numbered among those of its length (by its task's counts and those of
earlier tasks), and the patterns' ranges of these numbers give sequence and offset.

The ids come from the tokenizers library: its answers for distinct runs of
characters between ASCII white space (which no pre-token crosses) are kept from text to
text, all but those asked for once when the table is full.  Runs of plain letters, digits
and marks are normalised by the library, split by the file's own pattern, and the model is asked
for each distinct pre-token; runs that hold a special string, a control
character or characters from ``PLAIN`` on go to the library whole.

Null text counts as empty (the end id alone).  Null ids stay null.  Rows that
repeat are documents of their own.  An empty table gives no rows.  Other columns
are ignored.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from . import bpe
from .runtime import blocks, held, scratch

#: Letters up to here are classed alike by all Unicode versions in use.
PLAIN = "\u0590"
PIECES = "doc_id long, piece int, start long, length int, ids binary, task int, nth long"
#: Code points of text encoded at once; larger blocks hold fewer distinct runs in all.
BLOCK = 1 << 21
_RANK = 42  # bits of a piece's number among those of its length


class Known:
    """Ids of strings, each distinct one of a block looked up once and learned
    once.  When full, the table forgets what was in one block only."""

    def __init__(self, learn: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], limit: int = 1 << 18):
        self.learn, self.limit = learn, limit
        self.keys = pa.array([], type=pa.large_string())
        self.begin, self.size, self.hits = (np.zeros(0, dtype=np.int64) for _ in range(3))
        self.flat = np.zeros(0, dtype="<u4")

    def ids(self, strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, how many each string has)."""
        block = strings.dictionary_encode()
        place = pc.index_in(block.dictionary, value_set=self.keys)
        new = place.is_null()
        fresh = block.dictionary.filter(new)
        at = place.fill_null(0).to_numpy().astype(np.int64)
        if len(fresh):
            at[new.to_numpy(zero_copy_only=False)] = len(self.keys) + np.arange(len(fresh))
            ids, sizes = self.learn(fresh.to_pylist())
            self.keys = pa.concat_arrays([self.keys, fresh])
            self.begin = np.concatenate((self.begin, len(self.flat) + np.cumsum(sizes) - sizes))
            self.size, self.flat = np.concatenate((self.size, sizes)), np.concatenate((self.flat, ids))
        self.hits = np.pad(self.hits, (0, len(fresh)))
        self.hits[at] += 1
        at = at[block.indices.to_numpy()]
        begin, size = self.begin[at], self.size[at]
        ends = np.cumsum(size)
        out = self.flat[np.repeat(begin - ends + size, size) + np.arange(ends[-1] if len(ends) else 0)]
        if len(self.keys) > self.limit:
            self._forget()
        return out, size

    def _forget(self) -> None:
        keep = self.hits > 1
        begin, size = self.begin[keep], self.size[keep]
        ends = np.cumsum(size)
        self.flat = self.flat[np.repeat(begin - ends + size, size) + np.arange(int(size.sum()))]
        self.keys, self.begin, self.size, self.hits = self.keys.filter(pa.array(keep)), ends - size, size, self.hits[keep] // 2


class Runs:
    """Ids of runs between white space, new ones many at a time."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as source:
            split = json.load(source)["pre_tokenizer"]["pretokenizers"][0]
        if split["type"] != "Split" or split["behavior"] != "Removed" or not split["invert"]:
            raise ValueError("the file's pre-tokenizer must keep the matches of a pattern")
        self.library = Tokenizer.from_file(path)
        special = [regex.escape(t.content) for t in self.library.get_added_tokens_decoder().values()]
        self.odd = regex.compile("|".join([*special, r"[^\n\p{L}\p{M}\p{N}\p{P}\p{S}]", f"[{PLAIN}-\U0010ffff]"])).search
        self.find = regex.compile(split["pattern"]["Regex"] + "| ").findall
        self.shown = str.maketrans({chr(b): c for c, b in bpe.byte_alphabet().items()})
        self.words = Known(self._words)

    def _plain(self, runs: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Plain runs in one text, whose line ends the library makes blanks."""
        words = pa.array(self.find(self.library.normalizer.normalize_str("\n".join(runs))), type=pa.large_string())
        blank = np.asarray(pc.equal(words, " ")).astype(bool)
        ids, sizes = self.words.ids(words.filter(pa.array(~blank)))
        ends = np.concatenate(([0], np.cumsum(sizes)))
        edges = np.concatenate(([0], np.cumsum(~blank)[blank], [len(sizes)]))
        return ids, np.diff(ends[edges])

    def _words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        tokenize = self.library.model.tokenize
        shown = "\n".join(words).encode().decode("latin-1").translate(self.shown).split(self.shown[10])
        return _flat([[t.id for t in tokenize(w)] for w in shown])

    def learn(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        plain = np.ones(len(texts), dtype=bool)
        if "" in texts or self.odd("\n".join(texts)):
            plain = np.array([bool(t) and self.odd(t) is None for t in texts], dtype=bool)
        if plain.all():
            return self._plain(texts)
        ids, sizes = self._plain([t for t, ok in zip(texts, plain.tolist()) if ok]) if plain.any() else _flat([])
        easy = iter(np.split(ids, np.cumsum(sizes)[:-1]))
        return _flat([next(easy).tolist() if ok else self.library.encode(t, add_special_tokens=False).ids for t, ok in zip(texts, plain.tolist())])


def _flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    return np.array([i for x in lists for i in x], dtype="<u4"), np.array([len(x) for x in lists], dtype=np.int64)


class Codec:
    """Ids of whole texts, a block at a time."""

    def __init__(self, path: str):
        self.runs = Known(Runs(path).learn)

    def by_text(self, texts: list[str]) -> list[np.ndarray]:
        runs = pc.ascii_split_whitespace(pa.array(texts, type=pa.large_string()))  # an empty one at a blank end
        ids, sizes = self.runs.ids(runs.flatten())
        edges = np.concatenate(([0], np.cumsum(sizes)))[runs.offsets.to_numpy()].tolist()
        return [ids[a:b] for a, b in zip(edges, edges[1:])]


def pieces(
    docs: DataFrame, tokenizer_path: str, end_id: int, capacity: int = 2048, *, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The pieces of all documents with their ids, written to a table in the
    shared folder: ``PIECES``, where ``nth`` numbers a task's pieces of a length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = held(("packing", tokenizer_path), lambda: Codec(tokenizer_path))
        task, seen = TaskContext.get().partitionId(), [0] * (capacity + 1)
        for batch in batches:
            doc_ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for part in blocks([len(t) for t in texts], BLOCK):
                rows: list[tuple] = []
                for doc_id, ids in zip(doc_ids[part], codec.by_text(texts[part])):
                    ids = np.append(ids, np.array([end_id], dtype="<u4"))
                    for k, start in enumerate(range(0, len(ids), capacity)):
                        piece = ids[start : start + capacity]
                        rows.append((doc_id, k, start, len(piece), piece.tobytes(), task, seen[len(piece)]))
                        seen[len(piece)] += 1
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.int32(), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, type=t) for c, t in zip(zip(*rows), kinds)],
                    names=[c.split()[0] for c in PIECES.split(", ")],
                )

    cols = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    path = scratch(docs.sparkSession, "pieces")
    cols.mapInArrow(run, PIECES).write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.parquet(path)


@dataclass
class Pattern:
    """``times`` sequences that each hold ``uses``: (length, how many)."""

    times: int
    uses: list[tuple[int, int]]


def best_two_fit(counts: np.ndarray, capacity: int) -> list[Pattern]:
    """Patterns that use up ``counts`` (pieces by length, 1 to the capacity)."""
    left = np.array(counts, dtype=np.int64)
    lengths = np.arange(capacity + 1)
    out: list[Pattern] = []
    while True:
        longest = np.maximum.accumulate(np.where(left > 0, lengths, 0))  # the longest left, up to each length
        taken: dict[int, int] = {}
        gap, size = capacity, int(longest[capacity])
        if not size:
            return out
        while size:
            taken[size] = n = min(int(left[size]), gap // size)
            gap -= n * size
            size = int(longest[min(gap, size - 1)])
        needs = dict(taken)  # what must be there for this choice
        least = min(taken)
        if gap and sum(taken.values()) > 1:
            pair = _tightest_pair(left, taken, gap + least)
            if pair and sum(pair) > least:
                taken[least] -= 1
                for length in pair:
                    taken[length] = taken.get(length, 0) + 1
                    needs[length] = needs.get(length, 0) + 1
        uses = [(length, n) for length, n in sorted(taken.items(), reverse=True) if n]
        times = 1 + min((int(left[length]) - needs[length]) // n for length, n in uses)
        for length, n in uses:
            left[length] -= n * times
        out.append(Pattern(times, uses))


def _tightest_pair(left: np.ndarray, taken: dict[int, int], gap: int) -> tuple[int, int] | None:
    """The two unpacked lengths, the second not the longer one, whose sum is the
    largest within the gap; of equal sums the one with the longest piece."""
    free = left[: gap + 1].copy()
    for length, n in taken.items():
        if length <= gap:
            free[length] -= n
    first = np.flatnonzero(free > 0)
    if not len(first):
        return None
    longest = np.maximum.accumulate(np.where(free > 0, np.arange(gap + 1), 0))
    partner = longest[np.minimum(np.where(free[first] > 1, first, first - 1), gap - first)]
    sums = np.where(partner > 0, first + partner, 0)
    best = len(sums) - 1 - int(sums[::-1].argmax())
    return (int(first[best]), int(partner[best])) if sums[best] else None


def _ranges(patterns: list[Pattern]) -> np.ndarray:
    """By length and number: the range's first key, how many a sequence, the
    first sequence, the offset."""
    used: dict[int, int] = {}
    rows, sequence = [], 0
    for p in patterns:
        offset = 0
        for length, n in p.uses:
            rank = used.get(length, 0)
            rows.append(((length << _RANK) + rank, n, sequence, offset))
            used[length] = rank + n * p.times
            offset += n * length
        sequence += p.times
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 4)


def place(cut: DataFrame, capacity: int = 2048) -> DataFrame:
    """``cut`` with ``sequence_id`` and ``offset``; it has the columns length,
    task and nth of ``pieces`` and any others.  Read twice: carry what is needed."""
    by_task = cut.groupBy("length", "task").agg(F.count("*").alias("n"))
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for row in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect():  # at most the capacity
        counts[row["length"]] = row["n"]
    table = _ranges(best_two_fit(counts, capacity))
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    begins = by_task.select(
        F.col("length").alias("of_length"), F.col("task").alias("of_task"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("begin")
    )
    met = cut.join(begins, (F.col("length") == F.col("of_length")) & (F.col("task") == F.col("of_task")))
    kept = [c for c in cut.columns if c not in ("task", "nth")]
    ranked = met.select(*kept, (F.col("begin") + F.col("nth")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held(None)
        for batch in batches:
            length = batch.column(batch.schema.get_field_index("length")).to_numpy().astype(np.int64)
            rank = batch.column(batch.num_columns - 2).to_numpy()
            row = table[np.searchsorted(table[:, 0], (length << _RANK) + rank, "right") - 1]
            k = (length << _RANK) + rank - row[:, 0]
            columns = [*batch.columns[:-2], pa.array(row[:, 2] + k // row[:, 1]), pa.array(row[:, 3] + k % row[:, 1] * length)]
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return ranked.mapInArrow(run, ranked.schema)


def sequences(placed: DataFrame) -> DataFrame:
    """(sequence_id, length, ids binary): the packed sequences themselves, from
    placed pieces that carry their ``ids``; a group is one sequence."""
    ordered = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(ordered, F.lit(b"").cast("binary"), lambda all_ids, p: F.concat(all_ids, p["ids"]))
    return placed.groupBy("sequence_id").agg(F.sum("length").alias("length"), joined.alias("ids"))
