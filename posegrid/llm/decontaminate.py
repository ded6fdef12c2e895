"""Operator 5, benchmark decontamination: q-gram lemma filtering.

Texts are lower-cased and their white space squeezed.  An item of m characters
counts as present where some stretch of the text is within k edits of it, k
being a share of m.  By the q-gram lemma such a stretch shares at least
``m + 1 - q (k + 1)`` q-grams with the item, and their diagonals (place in the
text less place in the item) lie within k of each other.  So:

1. every text position is looked up in a table of all items' q-grams; regions
   where no window has as many hits as the lemma leaves to it are dropped;
2. the remaining hits are counted by item and diagonal band; bands are k wide
   twice over and overlap by half, so one of them has all hits of a match;
3. bands with too few hits are dropped, the others are verified by an alignment
   banded to those diagonals.

Nothing within the budget is lost.  A q-gram that stands at over ``COMMON`` places
of the items says little: where an item has q-grams enough besides, the lemma is
applied to those (each common one it loses lowers the count it needs by one), and
common ones are looked up only for the items that have too few others.  Hits are
worked on in slices of at most ``SLICE``, by item, so shared wording and repeated
texts take time but no memory.

Items shorter than ``q`` (after squeezing) have no q-gram and count as present
where they stand verbatim and as whole words; empty ones match nothing.  Items are
broadcast in blocks of at most ``ITEM_CHARS`` characters, one after the other and
one pass over the texts each; there is no join.

Null texts have no matches; rows with a null id are reported with it; repeated
rows are reported each.  Items with the same text are reported each.  Null items
match nothing.  Other columns are ignored.  Empty tables give no matches.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runtime import filter_rows, map_blocks

Q = 8
#: Edits allowed, as a share of the item's length.
EDIT_SHARE = 0.06
#: Characters of benchmark text that are broadcast at a time.
ITEM_CHARS = 8 << 20
WINDOW = 32
#: Places in the items from which a q-gram is common, and hits worked on at once.
COMMON = 64
SLICE = 1 << 21
#: Characters of items that are aligned at once.
ALIGNED = 1 << 18
_BASE = np.uint32(0x9E3779B1)
MATCHES = "doc_id long, item_id long, edits int, match_start int, match_end int, n_text int"


def normalise(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def gram_hashes(text: str, q: int) -> np.ndarray:
    """A 32-bit hash of every q-gram.  Collisions only add hits, and what is
    found is verified by alignment."""
    cps = code_points(text)
    n = len(cps) - q + 1
    if n < 1:
        return np.zeros(0, dtype=np.uint32)
    h = cps[:n].copy()
    for k in range(1, q):
        h *= _BASE
        h += cps[k : k + n]
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x846CA68B)
    h ^= h >> np.uint32(16)
    return h


def align(items: np.ndarray, m: np.ndarray, stretches: np.ndarray, low: np.ndarray, n: np.ndarray, budget: int) -> tuple[np.ndarray, np.ndarray]:
    """Least edits of whole items against any stretch of a text on a band of
    diagonals, many at a time, and the diagonal where each ends.

    Row r is an item (``items[r, :m[r]]``, longest first) and the text from place
    ``low[r]`` on (the lowest diagonal); ``n[r]`` is the text's length.  Beyond
    the budget the result is ``budget + 1``.
    """
    width, far = stretches.shape[1] - items.shape[1] + 1, budget + 1
    lane = np.arange(width)
    inside = lambda rows, i: (low[rows, None] + i + lane >= 0) & (low[rows, None] + i + lane <= n[rows, None])
    edits, ends = np.full(len(m), far, dtype=np.int64), np.zeros(len(m), dtype=np.int64)
    rows = np.arange(len(m))
    cost = np.where(inside(rows, 0), 0, far)
    for i in range(items.shape[1]):
        done = m[rows] == i
        alive = ~done & (cost < far).any(axis=1)
        if done.any():
            edits[rows[done]], ends[rows[done]] = cost[done].min(axis=1), cost[done].argmin(axis=1)
        if not alive.all():
            rows, cost = rows[alive], cost[alive]
            if not len(rows):
                return edits, ends
        step = cost + (stretches[rows, i : i + width] != items[rows, i, None])
        step[:, :-1] = np.minimum(step[:, :-1], cost[:, 1:] + 1)
        step = np.minimum.accumulate(step - lane, axis=1) + lane
        cost = np.where(inside(rows, i + 1), np.minimum(step, far), far)
    edits[rows], ends[rows] = cost.min(axis=1), cost.argmin(axis=1)
    return edits, ends


@dataclass
class Index:
    """All q-grams of a block of items."""

    items: list[tuple[int | None, str]]
    q: int = Q
    share: float = EDIT_SHARE
    codes: list[np.ndarray] = field(default_factory=list)

    def __post_init__(self) -> None:
        q = self.q
        self.short = [(i, t) for i, t in self.items if 0 < len(t) < q]
        self.items = [(i, t) for i, t in self.items if len(t) >= q]
        self.codes = [code_points(t) for _, t in self.items]
        m = self.length = np.array([len(t) for _, t in self.items], dtype=np.int64)
        self.budget = np.minimum((m * self.share).astype(np.int64), np.maximum((m - q) // q, 0))
        self.need = np.maximum(m + 1 - q * (self.budget + 1), 1)
        grams = [gram_hashes(t, q) for _, t in self.items]
        owner = np.repeat(np.arange(len(grams)), [len(g) for g in grams])
        place = np.concatenate([np.arange(len(g)) for g in grams]) if grams else np.zeros(0, dtype=np.int64)
        flat = np.concatenate(grams) if grams else np.zeros(0, dtype=np.uint32)
        order = np.argsort(flat, kind="stable")
        self.owner, self.place = owner[order], place[order]
        self.keys, starts, sizes = np.unique(flat[order], return_index=True, return_counts=True)
        self.starts = np.append(starts, len(flat))
        # items with q-grams enough that are not common need those only
        common = np.repeat(sizes > COMMON, sizes)
        lost = np.bincount(self.owner[common], minlength=len(m))
        self.rare = self.need > lost
        self.least_hits = np.where(self.rare, self.need - lost, self.need)
        used = ~(common & self.rare[self.owner])
        self.owner, self.place = self.owner[used], self.place[used]
        self.starts = np.concatenate(([0], np.cumsum(used)))[self.starts]
        # entries in order of q-gram and item, for ranges of items
        self.entry = np.repeat(np.arange(len(self.keys)), np.diff(self.starts)) * max(len(m), 1) + self.owner
        bits = max(16, int(len(self.keys)).bit_length() + 6)
        self.shift = np.uint32(32 - min(bits, 24))
        self.seen = np.zeros(1 << min(bits, 24), dtype=bool)
        self.seen[self.keys >> self.shift] = True
        # a stretch of m - q + 1 + budget positions with `need` hits has a full
        # window with at least this many, whatever the part left over holds
        spans = np.maximum(m - q + 1 + self.budget, 1)
        windows, rest = spans // WINDOW, spans % WINDOW
        bound = np.where(windows > 0, -(-(self.need - rest) // np.maximum(windows, 1)), 0)
        self.least = int(bound.min()) if len(m) else 1
        self.reach = int((m + 2 * self.budget).max()) + WINDOW if len(m) else 0

    def matches(self, texts: list[str]) -> list[tuple[int | None, int, int, int, int]]:
        """(text, item id, edits, start, end): the best match of each item in each text."""
        found = [(t, self.items[i][0], *v) for (t, i), v in self._near(texts).items()]
        for item_id, item in self.short:
            for t, text in enumerate(texts):
                at = text.find(item)
                while at >= 0 and not _whole_words(text, at, at + len(item)):
                    at = text.find(item, at + 1)
                if at >= 0:
                    found.append((t, item_id, 0, at, at + len(item)))
        return sorted(found, key=lambda r: (r[0], r[1] is None, r[1] or 0, *r[2:]))

    def _hits(self, joined: str) -> tuple[np.ndarray, np.ndarray]:
        """Positions of q-grams of items in dense enough regions, and which ones."""
        grams = gram_hashes(joined, self.q)
        hits = self.seen.take(grams >> self.shift)
        if self.least > 1 and len(grams):
            sums = np.concatenate((np.zeros(1, dtype=np.int32), np.cumsum(hits, dtype=np.int32)))
            dense = np.flatnonzero(sums[WINDOW:] - sums[:-WINDOW] >= self.least)
            # regions around dense windows, as few long stretches
            breaks = np.flatnonzero(np.diff(dense) > 2 * self.reach + WINDOW)
            lows = np.maximum(dense[np.concatenate(([0], breaks + 1))] - self.reach, 0) if len(dense) else dense
            highs = dense[np.concatenate((breaks, [len(dense) - 1]))] + WINDOW + self.reach if len(dense) else dense
            held = np.zeros(len(grams), dtype=bool)
            for low, high in zip(lows.tolist(), highs.tolist()):
                held[low:high] = True
            hits &= held
        at = np.flatnonzero(hits)
        slot = np.searchsorted(self.keys, grams[at])
        known = self.keys[np.minimum(slot, len(self.keys) - 1)] == grams[at]
        return at[known], slot[known]

    def _slices(self, slot: np.ndarray):
        """(first item, item after the last, positions) of slices that have
        at most ``SLICE`` hits, but for a single position and item."""
        n = len(self.items)
        todo = [(0, n, 0, len(slot))]
        while todo:
            low, high, begin, end = todo.pop()
            part = slot[begin:end]
            first = np.searchsorted(self.entry, part * n + low)
            many = np.searchsorted(self.entry, part * n + high) - first
            total = int(many.sum())
            if total > SLICE and high - low > 1:
                middle = (low + high) // 2
                todo += [(middle, high, begin, end), (low, middle, begin, end)]
            elif total > SLICE and end - begin > 1:
                middle = (begin + end) // 2
                todo += [(low, high, middle, end), (low, high, begin, middle)]
            elif total:
                yield low, high, slice(begin, end), first, many

    def _near(self, texts: list[str]) -> dict[tuple[int, int], tuple[int, int, int]]:
        if not self.items:
            return {}
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        joined = "\n".join(texts) + "\n"
        at, slot = self._hits(joined)
        if not len(at):
            return best
        cps = code_points(joined)
        edges = np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts])))
        before = self.reach + 2  # bands may lie a little before the text
        width = int(at[-1]) + 2 * before
        held: list[tuple[np.ndarray, np.ndarray]] = []
        item_of_held = -1
        for low, high, where, first, many in self._slices(slot):
            if held and (high - low > 1 or low != item_of_held):
                self._verify(cps, edges, width, before, *_added(held), best)
                held = []
            place = np.repeat(at[where], many)
            entry = np.repeat(first, many) + np.arange(len(place)) - np.repeat(np.cumsum(many) - many, many)
            item = self.owner[entry]
            band = (place - self.place[entry]) // (self.budget[item] + 1)
            text = np.searchsorted(edges, place, side="right") - 1
            group = (text * len(self.items) + item) * width + band + before
            held.append(np.unique(np.concatenate((group, group - 1)), return_counts=True))
            item_of_held = low
            if high - low > 1:
                self._verify(cps, edges, width, before, *held.pop(), best)
        if held:
            self._verify(cps, edges, width, before, *_added(held), best)
        return best

    def _verify(self, cps, edges, width, before, found, counts, best) -> None:
        """Align the bands with hits enough; keep the best of a text and item."""
        group = found[counts >= self.least_hits[found // width % len(self.items)]]
        pair, band = group // width, group % width - before
        text, item = pair // len(self.items), pair % len(self.items)
        for k in np.unique(self.budget[item]).tolist():
            of = np.flatnonzero(self.budget[item] == k)
            of = of[np.argsort(-self.length[item[of]], kind="stable")]
            while len(of):
                longest, wide = int(self.length[item[of[0]]]), 4 * k + 2
                part, of = np.split(of, [max(1, ALIGNED // (longest + wide))])
                t, i = text[part], item[part]
                m, low, n = self.length[i], band[part] * (k + 1) - k - edges[t], np.diff(edges)[t] - 1
                items = np.zeros((len(part), longest), dtype=np.int64)
                for r, x in enumerate(i.tolist()):
                    items[r, : m[r]] = self.codes[x]
                place = low[:, None] + np.arange(longest + wide - 1)
                known = (place >= 0) & (place < n[:, None])
                stretches = np.where(known, cps[np.where(known, place + edges[t][:, None], 0)].astype(np.int64), -1)
                edits, ends = align(items, m, stretches, low, n, k)
                ends += m + low
                for r in np.flatnonzero(edits <= k).tolist():
                    got = int(edits[r]), max(0, int(ends[r] - m[r])), int(ends[r])
                    at = int(t[r]), int(i[r])
                    best[at] = min(best.get(at, got), got)


def _added(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Sums of counts by group."""
    groups, at = np.unique(np.concatenate([g for g, _ in held]), return_inverse=True)
    return groups, np.bincount(at, weights=np.concatenate([c for _, c in held]))


def _whole_words(text: str, begin: int, end: int) -> bool:
    inner = lambda k: 0 <= k < len(text) and text[k].isalnum()
    return not (inner(begin - 1) and text[begin].isalnum()) and not (inner(end) and text[end - 1].isalnum())


def item_blocks(benchmark: DataFrame, id_col: str, text_col: str) -> Iterator[list[tuple[int | None, str]]]:
    """The items, normalised, in blocks of bounded size (for all but a single
    item beyond the bound); the driver holds one block at a time."""
    rows = benchmark.select(F.col(id_col).cast("long"), F.col(text_col)).where(F.col(text_col).isNotNull())
    block: list[tuple[int | None, str]] = []
    size = 0
    for item_id, text in rows.orderBy(id_col, text_col).toLocalIterator():
        text = normalise(text)
        if size and size + len(text) > ITEM_CHARS:
            yield block
            block, size = [], 0
        block.append((item_id, text))
        size += len(text)
    yield block


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    q: int = Q,
    share: float = EDIT_SHARE,
) -> DataFrame:
    """A row for each text and item it holds: the best match, its edits and
    place in the normalised text."""
    cols = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    spark = docs.sparkSession
    found = None
    for block in item_blocks(benchmark, item_id_col, item_text_col):
        shared = spark.sparkContext.broadcast(Index(block, q, share))

        def make(shared=shared):
            index = shared.value

            def run(cols: dict[str, list]) -> dict[str, list]:
                texts = [normalise(t) for t in cols["text"]]
                rows = index.matches(texts)
                return {
                    "doc_id": [cols["doc_id"][r[0]] for r in rows],
                    "item_id": [r[1] for r in rows],
                    "edits": [r[2] for r in rows],
                    "match_start": [r[3] for r in rows],
                    "match_end": [r[4] for r in rows],
                    "n_text": [len(texts[r[0]]) for r in rows],
                }

            return run

        part = map_blocks(cols, make, MATCHES)
        found = part if found is None else found.unionByName(part)
    return found


def keep_clean(docs: DataFrame, benchmark: DataFrame, *, text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The rows that hold no benchmark item, with all their columns."""
    for block in item_blocks(benchmark, item_id_col, item_text_col):
        shared = docs.sparkSession.sparkContext.broadcast(Index(block))

        def make(shared=shared):
            index = shared.value

            def run(texts: list) -> list[bool]:
                found = {m[0] for m in index.matches([normalise(t) for t in texts])}
                return [i not in found for i in range(len(texts))]

            return run

        docs = filter_rows(docs, make, text_col)
    return docs
