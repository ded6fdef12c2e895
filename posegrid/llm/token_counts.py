"""Operator 1, token counts: finite-state tokenizer compilation.

Two deterministic machines are composed.  The first splits text into
pre-tokens (``pretoken``): each character is a function on nine states, chunk
state maps compose by a parallel prefix scan, so chunks of a text are worked on
side by side.  The second, compiled here, reads the bytes of a pre-token and
says how many tokens it has: every transition is annotated with the change of
the token count.

States of the second machine.  Let ``e(i)`` be the last token of the encoding
of the first ``i`` bytes.  A token ``t`` ending at ``i`` is ``e(i)`` iff the
pair (``e(i - len(t))``, ``t``) encodes to itself; exactly one ``t`` does.  So it
is enough to know the longest suffix that begins some token and, for every
position in it from which a token can still grow, the last token and the count
relative to here.

Chunks of a long pre-token are worked on side by side, each as if the pre-token
began there, and a little way into the next chunk.  Where the last tokens of one
chunk and those of the next agree over as many bytes as the longest token has, and
their counts differ by one number, the two are in the same state: the map of a
chunk is then that state and a shift of the count, and the maps of all chunks
compose by a prefix sum of the shifts.  Pre-tokens with chunks that do not fall
into step (long runs of one odd pattern) are run through from the start.  Short
pre-tokens are a chunk each: many run side by side (lanes).

Null text counts as empty; empty text has 0 bytes and 0 tokens; repeated rows
and repeated or null ids pass through as they are; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bpe, pretoken
from .bpe import NEVER
from .runtime import held, map_blocks

#: Bytes that run side by side at once; pieces from which lanes pay.
LANE_BYTES = 1 << 19
LANES = 48
#: Longer pieces are cut into chunks of so many bytes.
CHUNK_BYTES = 1 << 10
SCHEMA = "doc_id long, n_bytes long, n_tokens long, n_pieces long"


class CountMachine:
    """A deterministic transducer from bytes to changes of the token count.

    It is compiled to tables: the automaton of all token prefixes with its
    fall-back links, the longest token that ends at each of its nodes, the next
    shorter one that ends a token, and the border symbols of every token.  Many
    pieces run side by side, a lane each, a byte a step.
    """

    CACHE_BITS = 18

    def __init__(self, vocab: bpe.Vocabulary):
        self.vocab = vocab
        self._automaton()
        self._spines()
        self.pair_key = np.full(1 << self.CACHE_BITS, -1, dtype=np.int64)
        self.pair_fits = np.zeros(1 << self.CACHE_BITS, dtype=bool)
        self.pairs: dict[int, bool] = {}
        self.plain: tuple | None = None

    def _automaton(self) -> None:
        ids = self.vocab.ids
        nodes = {b"": 0}
        for t in sorted(ids, key=len):
            for k in range(1, len(t) + 1):
                nodes.setdefault(t[:k], len(nodes))
        order = sorted(nodes, key=len)
        fail, ends = np.zeros(len(nodes), dtype=np.int32), np.full(len(nodes), -1, dtype=np.int32)
        shorter = np.full(max(ids.values()) + 1, -1, dtype=np.int32)
        length = np.zeros_like(shorter)
        keys, children = [], []
        for text in order[1:]:
            node = nodes[text]
            keys.append(nodes[text[:-1]] << 8 | text[-1])
            children.append(node)
            cut = 1
            while text[cut:] not in nodes:
                cut += 1
            fail[node] = nodes[text[cut:]]
            ends[node] = ends[fail[node]]
            if text in ids:
                shorter[ids[text]], length[ids[text]] = ends[node], len(text)
                ends[node] = ids[text]
        self.children = bpe.HashTable(np.array(keys, dtype=np.int64), np.array(children, dtype=np.int64))
        self.fail, self.ends, self.shorter, self.length = fail, ends, shorter, length

    def _spines(self) -> None:
        """How each token's first and last symbols came about.

        A row lists the border symbols from a single byte up to the token, and
        the rank of the merge that ended each.  Merges are learnt in order, so a
        pair ranks above those that made its parts; a file that breaks this, or
        names two merges for a token, is refused.
        """
        v = self.vocab
        split: dict[int, tuple[int, int, int]] = {}
        for key, rank in v.pairs.items():
            token = v.id_of(rank)
            if token in split:
                raise ValueError("a token with several merges")
            split[token] = key >> 20, key & 0xFFFFF, rank
        for left, right, rank in split.values():
            if any(part in split and split[part][2] >= rank for part in (left, right)):
                raise ValueError("merges out of order")
        sides = []
        for side in (0, 1):
            lines: dict[int, list] = {int(t): [(int(t), NEVER)] for t in v.single}
            for token, (*parts, rank) in sorted(split.items(), key=lambda x: x[1][2]):
                part = parts[side]
                lines[token] = [*lines[part][:-1], (part, rank), (token, NEVER)]
            depth = max(map(len, lines.values()))
            symbols = np.zeros((len(self.length), depth), dtype=np.int64)
            ended = np.full((len(self.length), depth + 1), -1, dtype=np.int32)  # shifted: [0] is "began"
            height = np.zeros(len(self.length), dtype=np.int64)
            for token, line in lines.items():
                height[token] = len(line) - 1
                for k, (symbol, rank) in enumerate(line):
                    symbols[token, k], ended[token, k + 1] = symbol, rank
            sides.append((symbols, ended, height))
        self.heads, self.tails = sides
        ids = list(v.ids.values())
        self.whole = np.zeros(len(self.length), dtype=bool)
        self.whole[ids] = [len(e) == 1 for e in v.encode_many([v.bytes[i] for i in ids])]

    def _walk(self, before: np.ndarray, token: np.ndarray) -> np.ndarray:
        """Whether two tokens, side by side, encode to themselves.

        Up to the first merge across the border each side merges as if alone.
        So it is enough to go back through the moments at which a symbol at the
        border changes and see that no pair across it goes before the next
        change: the lower rank goes first, the left one among equals.
        """
        (ls, le, lh), (rs, re, rh) = self.tails, self.heads
        fits = np.ones(len(before), dtype=bool)
        todo = np.arange(len(before))
        a, b, i, j = before, token, lh[before], rh[token]
        while len(todo):
            rank = self.vocab.ranks.of(ls[a, i] << 20 | rs[b, j])
            clash = (rank < le[a, i + 1]) & (rank <= re[b, j + 1]) & (rank != NEVER)
            fits[todo[clash]] = False
            left_began, right_began = le[a, i], re[b, j]
            back = left_began > right_began
            go = ~clash & ((left_began >= 0) | (right_began >= 0))
            i, j = (i - back)[go], (j - ~back)[go]
            todo, a, b = todo[go], a[go], b[go]
        return fits

    def fits(self, before: np.ndarray, token: np.ndarray) -> np.ndarray:
        """As ``_walk``, behind a direct-mapped cache; -1 before: the start."""
        out = self.whole[token]
        inner = np.flatnonzero(before >= 0)
        if not len(inner):
            return out
        a, b = before[inner].astype(np.int64), token[inner].astype(np.int64)
        key = a << 20 | b
        slot = (key * 0x9E3779B1 >> 7) & ((1 << self.CACHE_BITS) - 1)
        known = self.pair_key[slot] == key
        got = self.pair_fits[slot]
        if not known.all():
            new = ~known
            fresh, where = np.unique(key[new], return_inverse=True)
            value = self._walk(fresh >> 20, fresh & 0xFFFFF)
            got[new] = value[where]
            self.pair_key[slot[new]] = key[new]
            self.pair_fits[slot[new]] = got[new]
            # of keys that share a slot the last one written stays, with its value
        out[inner] = got
        return out

    def _step(self, node: np.ndarray, byte: np.ndarray) -> np.ndarray:
        out = self.children.of(node << 8 | byte)
        miss = np.flatnonzero(out == NEVER)
        at = node[miss]
        while len(miss):
            at = self.fail[at].astype(np.int64)
            got = self.children.of(at << 8 | byte[miss])
            out[miss] = got
            more = got == NEVER
            miss, at = miss[more], at[more]
        return out.astype(np.int64)

    def count(self, pieces: list[bytes]) -> np.ndarray:
        """Tokens of each (non-empty) piece."""
        total = np.zeros(len(pieces), dtype=np.int64)
        lengths = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces))
        for low, high in ((0, 16), (16, 64), (64, 512), (512, 2 * CHUNK_BYTES)):
            lanes = np.flatnonzero((lengths > low) & (lengths <= high))
            if len(lanes) < LANES:
                total[lanes] = [self._run(pieces[i]) for i in lanes]
                continue
            lanes = lanes[np.argsort(-lengths[lanes], kind="stable")]
            for part in np.array_split(lanes, -(-len(lanes) * int(lengths[lanes[0]]) // LANE_BYTES)):
                _, count = self._lanes([pieces[i] for i in part], lengths[part])
                total[part] = count[lengths[part], np.arange(len(part))]
        for i in np.flatnonzero(lengths > 2 * CHUNK_BYTES).tolist():
            total[i] = self._chunks(pieces[i])
        return total

    def _chunks(self, piece: bytes) -> int:
        """A long piece, by the composition of its chunks' maps."""
        reach = int(self.length.max())
        over = 2 * reach  # how far a chunk runs into the next one
        starts = np.arange(0, max(1, len(piece) - over), CHUNK_BYTES)
        shifts, ahead = 0, None  # the last chunk's last tokens and counts where the next one is compared
        most = max(2, LANE_BYTES // (CHUNK_BYTES + over))
        for at in range(0, len(starts), most):
            part = starts[at : at + most]
            lengths = np.minimum(len(piece) - part, CHUNK_BYTES + over)
            if at + len(part) == len(starts):
                lengths[-1] = len(piece) - part[-1]
                lengths[:-1] = CHUNK_BYTES + over
            order = np.argsort(-lengths, kind="stable")
            last, count = self._lanes([piece[part[k] : part[k] + lengths[k]] for k in order], lengths[order])
            place = np.argsort(order)
            last, count = last[:, place], count[:, place]
            here = slice(over - reach, over + 1)
            there = slice(CHUNK_BYTES + over - reach, CHUNK_BYTES + over + 1)
            before = [(last[there, k], count[there, k]) for k in range(len(part) - 1)]
            for k, held in enumerate(before if ahead is None else [ahead, *before], int(ahead is None)):
                gap = held[1] - count[here, k]
                if (held[0] != last[here, k]).any() or (gap != gap[0]).any():
                    return self._run(piece)
                shifts += int(gap[0])
            ahead = last[there, -1].copy(), count[there, -1].copy()
            whole = int(count[lengths[-1], -1])
        return shifts + whole

    def _run(self, piece: bytes) -> int:
        """A piece from its start, byte by byte."""
        if self.plain is None:
            keys, values = self.children.items()
            self.plain = dict(zip(keys.tolist(), values.tolist())), *(x.tolist() for x in (self.fail, self.ends, self.shorter, self.length))
        child, fail, ends, shorter, length = self.plain
        last, count, node = [-1] * (len(piece) + 1), [0] * (len(piece) + 1), 0
        for i, byte in enumerate(piece, 1):
            while (found := child.get(node << 8 | byte)) is None:
                node = fail[node]
            node = found
            token = ends[node]
            start = i - length[token]
            while not self._pair(last[start], token):
                token = shorter[token]
                start = i - length[token]
            last[i], count[i] = token, count[start] + 1
        return count[-1]

    def _pair(self, before: int, token: int) -> bool:
        if before < 0:
            return bool(self.whole[token])
        key = before << 20 | token
        if (ok := self.pairs.get(key)) is None:
            if len(self.pairs) >= 1 << self.CACHE_BITS:
                self.pairs.clear()
            ok = self.pairs[key] = bool(self._walk(np.array([before]), np.array([token]))[0])
        return ok

    def _lanes(self, pieces: list[bytes], lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Last token and count after each byte (rows) of each piece (columns)."""
        n, longest = len(pieces), int(lengths[0])
        byte = np.frombuffer(b"".join(p.ljust(longest, b"\0") for p in pieces), dtype=np.uint8).reshape(n, longest)
        last = np.full((longest + 1, n), -1, dtype=np.int32)
        count = np.zeros((longest + 1, n), dtype=np.int32)
        node = np.zeros(n, dtype=np.int64)
        active = np.searchsorted(-lengths, -np.arange(longest), side="left")  # lanes longer than i
        for i in range(longest):
            k = int(active[i])
            node = self._step(node[:k], byte[:k, i].astype(np.int64))
            todo, token = np.arange(k), self.ends[node]
            while len(todo):
                start = i + 1 - self.length[token]
                ok = self.fits(last[start, todo], token)
                good = todo[ok]
                last[i + 1, good] = token[ok]
                count[i + 1, good] = count[start[ok], good] + 1
                todo, token = todo[~ok], self.shorter[token[~ok]]
        return last, count


def compiled(path: str) -> CountMachine:
    return CountMachine(bpe.from_json(path)[0])


def _counter(path: str) -> tuple[str | None, bpe.Memo]:
    vocab, special = bpe.from_json(path)
    if len(special) > 1:
        raise ValueError("one special token at most")
    mark, machine = next(iter(special), None), CountMachine(vocab)

    def work(new: list[str]) -> list[int]:
        counts = machine.count([p.encode() for p in new]).tolist()
        return [1 if p == mark else n for p, n in zip(new, counts)]

    return mark, bpe.Memo(work)


def token_counts(docs: DataFrame, tokenizer_path: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Count the tokens of every whole text as the tokenizer file's library would.

    No shuffle and no driver step: one pass over the scan.  The file must be a
    byte-level BPE model; strings of its special tokens count as one token.
    """
    kinds = pretoken.kinds_by_tiktoken()

    def make():
        mark, memo = held(("counts", tokenizer_path), lambda: _counter(tokenizer_path))

        def run(cols: dict[str, list]) -> dict[str, list]:
            texts = [t or "" for t in cols["text"]]
            pieces, number, per_text = pretoken.distinct(texts, kinds, mark)
            counts = np.array(memo.of(pieces), dtype=np.int64)[number]
            places = np.concatenate(([0], np.cumsum(per_text, dtype=np.int64)))
            n_tokens = np.diff(np.concatenate(([0], np.cumsum(counts)))[places])
            return {
                "doc_id": cols["doc_id"],
                "n_bytes": [len(t.encode()) for t in texts],
                "n_tokens": n_tokens,
                "n_pieces": per_text,
            }

        return run

    cols = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return map_blocks(cols, make, SCHEMA, keeps=True)
