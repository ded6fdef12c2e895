"""Byte-level pair merging: vocabularies, a merge engine and its cache."""

from __future__ import annotations

import base64
import functools
import heapq
import json
from collections.abc import Callable
from itertools import islice

import numpy as np

NEVER = np.iinfo(np.int32).max
#: Longer pieces are merged one by one, by a heap.
LOCKSTEP_BYTES = 64



@functools.cache
def byte_alphabet() -> dict[str, int]:
    """The public byte-level alphabet: printable bytes stand for themselves,
    the others for the code points from 256 on, in order."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(other)}


class HashTable:
    """Non-negative 64-bit keys to 32-bit values, looked up many at a time:
    open addressing over numpy arrays, a slot and the few after it."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        bits = max(10, int(len(keys)).bit_length() + 1)
        self._shift, self._mask = np.uint64(64 - bits), (1 << bits) - 1
        self._keys = np.full(1 << bits, -1, dtype=np.int64)
        self._values = np.full(1 << bits, NEVER, dtype=np.int32)
        slot, left, self._probes = self._slot(keys), np.arange(len(keys)), 0
        while len(left):
            self._probes += 1
            at = slot[left]
            free = self._keys[at] < 0
            self._keys[at[free]] = keys[left[free]]
            placed = self._keys[at] == keys[left]
            self._values[at[placed]] = values[left[placed]]
            left = left[~placed]
            slot[left] = (slot[left] + 1) & self._mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self._shift).view(np.int64)

    def items(self) -> tuple[np.ndarray, np.ndarray]:
        held = self._keys >= 0
        return self._keys[held], self._values[held]

    def of(self, keys: np.ndarray) -> np.ndarray:
        """Values of the keys; NEVER where there is none."""
        slot = self._slot(keys)
        found = self._keys.take(slot)
        out = np.where(found == keys, self._values.take(slot), NEVER)
        todo = np.flatnonzero((found != keys) & (found >= 0))
        slot = slot[todo]
        while len(todo):
            slot = (slot + 1) & self._mask
            found = self._keys[slot]
            hit = found == keys[todo]
            out[todo[hit]] = self._values[slot[hit]]
            more = ~hit & (found >= 0)
            todo, slot = todo[more], slot[more]
        return out


class Vocabulary:
    """Tokens as bytes, and the rank and result of each pair that merges.

    ``pairs`` maps ``left << 20 | right`` to the pair's rank; ``result`` maps a
    rank to the merged token's id.
    """

    def __init__(self, tokens: dict[bytes, int], pairs: dict[int, int], result: dict[int, int] | None):
        self.ids = tokens
        self.bytes = {i: t for t, i in tokens.items()}
        self.single = np.array([tokens[bytes([b])] for b in range(256)], dtype=np.int64)
        self.pairs, self.result = pairs, result
        keys = np.fromiter(pairs, dtype=np.int64, count=len(pairs))
        ranks = np.fromiter(pairs.values(), dtype=np.int64, count=len(pairs))
        self.ranks = HashTable(keys, ranks)
        self.by_rank = None
        if result is not None:
            self.by_rank = np.zeros(max(result) + 1, dtype=np.int64)
            self.by_rank[np.fromiter(result, dtype=np.int64)] = np.fromiter(result.values(), dtype=np.int64)

    def id_of(self, rank: int) -> int:
        return rank if self.result is None else self.result[rank]

    def encode_many(self, pieces: list[bytes]) -> list[np.ndarray]:
        """Merge all pieces in lockstep: in each round every piece that can
        still merge merges its lowest-ranked pair, leftmost first."""
        out: list[np.ndarray | None] = [None] * len(pieces)
        short = []
        for i, p in enumerate(pieces):
            if len(p) > LOCKSTEP_BYTES:
                out[i] = np.array(self.encode(p), dtype="<u4")
            else:
                short.append(i)
        joined = b"".join(pieces[i] for i in short)
        lengths = np.fromiter((len(pieces[i]) for i in short), dtype=np.int64, count=len(short))
        symbols = self.single[np.frombuffer(joined, dtype=np.uint8)]
        owner = np.repeat(np.arange(len(short)), lengths)
        done_ids, done_owner = [], []
        while len(symbols) > 1:
            ranks = np.full(len(symbols), NEVER, dtype=np.int32)
            same = owner[:-1] == owner[1:]
            at = np.flatnonzero(same)
            ranks[at] = self.ranks.of(symbols[at] << 20 | symbols[at + 1])
            starts = np.flatnonzero(np.concatenate(([True], ~same)))
            lowest = np.minimum.reduceat(ranks, starts)
            size = np.diff(np.append(starts, len(symbols)))
            over = np.repeat(lowest == NEVER, size)
            if over.any():
                done_ids.append(symbols[over])
                done_owner.append(owner[over])
                keep = ~over
                symbols, owner, ranks = symbols[keep], owner[keep], ranks[keep]
                if not len(symbols):
                    break
                live = lowest != NEVER
                lowest, size = lowest[live], size[live]
            hit = np.flatnonzero(ranks == np.repeat(lowest, size))
            first = hit[np.concatenate(([True], owner[hit][1:] != owner[hit][:-1]))]
            symbols = symbols.copy()
            symbols[first] = lowest if self.by_rank is None else self.by_rank[lowest]
            keep = np.ones(len(symbols), dtype=bool)
            keep[first + 1] = False
            symbols, owner = symbols[keep], owner[keep]
        done_ids.append(symbols)
        done_owner.append(owner)
        ids, owner = np.concatenate(done_ids), np.concatenate(done_owner)
        order = np.argsort(owner, kind="stable")
        ids = ids[order].astype("<u4")
        ends = np.cumsum(np.bincount(owner, minlength=len(short))).tolist()
        for k, i in enumerate(short):
            out[i] = ids[ends[k - 1] if k else 0 : ends[k]]
        return out

    def encode(self, piece: bytes) -> list[int]:
        """One piece of any length, by a heap over a linked list: n log n."""
        parts = self.single[np.frombuffer(piece, dtype=np.uint8)].tolist()
        n = len(parts)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap: list[tuple[int, int, int, int]] = []

        def offer(i: int) -> None:
            j = after[i]
            if j < n and (rank := self.pairs.get(parts[i] << 20 | parts[j])) is not None:
                heapq.heappush(heap, (rank, i, parts[i], parts[j]))

        for i in range(n - 1):
            offer(i)
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = after[i]
            if j >= n or parts[i] != a or parts[j] != b:
                continue
            parts[i], parts[j] = self.id_of(rank), -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            if before[i] >= 0:
                offer(before[i])
            offer(i)
        return [p for p in parts if p >= 0]


def from_ranks(path: str) -> Vocabulary:
    """A rank file: base64 bytes and rank a line.  Any two tokens whose bytes
    joined are a token merge, at that token's rank."""
    with open(path, "rb") as f:
        rows = (line.split() for line in f if line.strip())
        tokens = {base64.b64decode(t): int(r) for t, r in rows}
    pairs = {}
    for token, rank in tokens.items():
        for cut in range(1, len(token)):
            a = tokens.get(token[:cut])
            if a is not None and (b := tokens.get(token[cut:])) is not None:
                pairs[a << 20 | b] = rank
    return Vocabulary(tokens, pairs, None)


def from_json(path: str) -> tuple[Vocabulary, dict[str, int]]:
    """A byte-level BPE model file; also its added special tokens."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    alphabet = byte_alphabet()
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    vocab = spec["model"]["vocab"]
    tokens = {bytes(map(alphabet.__getitem__, t)): i for t, i in vocab.items() if t not in special}
    pairs, result = {}, {}
    for rank, pair in enumerate(spec["model"]["merges"]):
        a, b = pair if isinstance(pair, list) else pair.split(" ")
        pairs[vocab[a] << 20 | vocab[b]] = rank
        result[rank] = vocab[a + b]
    return Vocabulary(tokens, pairs, result), special


class Memo:
    """Values of pre-tokens, worked out once; bounded.

    Two generations of at most ``limit`` entries (and a block's) each: what is
    looked up moves to the younger one, and the older one goes when that is full.
    """

    def __init__(self, work: Callable[[list[str]], list], limit: int = 1 << 17):
        self.work, self.limit = work, limit
        self.young: dict[str, object] = {}
        self.old: dict[str, object] = {}

    def of(self, pieces: list[str]) -> list:
        young, old = self.young, self.old
        if absent := set(pieces).difference(young):
            new = []
            for p in absent:
                value = old.get(p)
                if value is None:
                    new.append(p)
                else:
                    young[p] = value
            young.update(zip(new, self.work(new)))
        out = list(map(young.__getitem__, pieces))
        if len(young) > self.limit:
            self.young, self.old = {}, young
        return out


class _Numbers(dict):
    """Numbers keys as they are first asked for."""

    def __missing__(self, key: str) -> int:
        self[key] = n = len(self)
        return n


class PieceIds:
    """Ids of texts, by a table of the ids of their pre-tokens.

    ``split`` gives the distinct pre-tokens of a block of texts, the number of
    every one in order, and how many each text has; ``learn`` gives the ids of
    new pre-tokens end to end, and how many each has.  The ids of a block are
    gathered from one array.  The table starts anew beyond ``limit`` entries.
    """

    def __init__(
        self,
        split: Callable[[list[str]], tuple[list[str], np.ndarray, list[int]]],
        learn: Callable[[list[str]], tuple[np.ndarray, np.ndarray]],
        limit: int = 1 << 18,
    ):
        self.split, self.learn, self.limit = split, learn, limit
        self._clear()

    def _clear(self) -> None:
        self.table = _Numbers()
        self.begin, self.size = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        self.ids = np.zeros(0, dtype="<u4")

    def _numbers(self, pieces: list[str]) -> np.ndarray:
        known = len(self.table)
        at = np.fromiter(map(self.table.__getitem__, pieces), dtype=np.int64, count=len(pieces))
        if len(self.table) > known:
            ids, sizes = self.learn(list(islice(self.table, known, None)))
            self.begin = np.concatenate((self.begin, len(self.ids) + np.cumsum(sizes) - sizes))
            self.size = np.concatenate((self.size, sizes))
            self.ids = np.concatenate((self.ids, ids))
        return at

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(all ids, end of every pre-token in them, end of every text in the
        pre-tokens); both kinds of ends begin with 0."""
        if len(self.table) > self.limit:
            self._clear()
        pieces, number, per_text = self.split(texts)
        at = self._numbers(pieces)[number]
        size = self.size[at]
        ends = np.concatenate(([0], np.cumsum(size)))
        ids = self.ids[np.repeat(self.begin[at] - ends[:-1], size) + np.arange(ends[-1])]
        return ids, ends, np.concatenate(([0], np.cumsum(per_text, dtype=np.int64)))

    def by_text(self, texts: list[str]) -> list[np.ndarray]:
        ids, ends, places = self.encode(texts)
        edges = ends[places].tolist()
        return [ids[a:b] for a, b in zip(edges, edges[1:])]
