"""Pre-tokenisation without regular expressions.

Code points become small class ids by table look-up (two characters of look
ahead are folded into the class), every class is a function on the states of a
nine-state machine, and functions compose associatively.  The closure of these
functions under composition is finite and small, so a whole prefix is one
integer; a blocked prefix scan over the integers gives the state before every
character, and with it every token start.

The split computed is that of the public byte-level pattern
``'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+``.
"""

from __future__ import annotations

import functools
import zlib

import numpy as np

from .shingles import span_hashes

# Character kinds of the table.
PUNCT, LETTER, NUMBER, SPACE, BLANK = range(5)
# Classes after look-ahead: a contraction of 2 or 3 characters, a single blank
# U+0020 before other text, other white space before other text, white space
# before white space or the end.
C_PUNCT, C_LETTER, C_NUMBER, C_TAIL2, C_TAIL3, C_JOIN, C_LONE, C_WHITE = range(8)
FRESH = 8  # added to the class of a text's first character
# States: nothing open, inside a run of letters, numbers, punctuation, after a
# joining blank, inside white space, after a closed token, 1 or 2 letters of a
# contraction to come.
S_NONE, S_LETTER, S_NUMBER, S_PUNCT, S_JOIN, S_WHITE, S_DONE, S_ONE, S_TWO = range(9)
N_STATES = 9


def _step(cls: int, state: int) -> tuple[int, int]:
    """(next state, 1 if a token starts at this character)."""
    if cls >= FRESH:
        return _step(cls - FRESH, S_NONE)
    if cls == C_LETTER:
        if state == S_TWO:
            return S_ONE, 0
        if state == S_ONE:
            return S_DONE, 0
        return S_LETTER, int(state not in (S_LETTER, S_JOIN))
    if cls == C_NUMBER:
        return S_NUMBER, int(state not in (S_NUMBER, S_JOIN))
    if cls == C_PUNCT or (cls in (C_TAIL2, C_TAIL3) and state in (S_PUNCT, S_JOIN)):
        return S_PUNCT, int(state not in (S_PUNCT, S_JOIN))
    if cls == C_TAIL2:
        return S_ONE, 1
    if cls == C_TAIL3:
        return S_TWO, 1
    if cls == C_JOIN:
        return S_JOIN, 1
    if cls == C_LONE:
        return S_DONE, 1
    return S_WHITE, int(state != S_WHITE)


@functools.cache
def machine() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(function id of a class, composition table, states, starts).

    ``compose[f << 4 | g]`` is "f, then g"; ``states[f]`` the state that f leads
    to from the outset; ``starts[class << 4 | state]`` whether a token starts.
    """
    classes = range(2 * FRESH)
    starts = np.array([[_step(c, s)[1] for s in range(N_STATES)] for c in classes], dtype=bool)
    ids: dict[tuple[int, ...], int] = {tuple(range(N_STATES)): 0}
    of_class = []
    for c in classes:
        f = tuple(_step(c, s)[0] for s in range(N_STATES))
        of_class.append(ids.setdefault(f, len(ids)))
    todo = list(ids)
    while todo:
        f = todo.pop()
        for g in list(ids):
            for h in (tuple(g[x] for x in f), tuple(f[x] for x in g)):
                if h not in ids:
                    ids[h] = len(ids)
                    todo.append(h)
    known = list(ids)
    assert len(known) <= 16
    compose = np.zeros(256, dtype=np.uint8)
    for i, f in enumerate(known):
        for j, g in enumerate(known):
            compose[i << 4 | j] = ids[tuple(g[x] for x in f)]
    after = np.zeros(16, dtype=np.uint8)
    after[: len(known)] = [f[S_NONE] for f in known]
    table = np.zeros((2 * FRESH, 16), dtype=bool)
    table[:, :N_STATES] = starts
    return np.array(of_class, dtype=np.uint8), compose, after, table.ravel()


def prefix_scan(fns: np.ndarray, lane: int = 128) -> np.ndarray:
    """Exclusive prefix composition of function ids.

    Lanes of ``lane`` ids are scanned in lockstep; their totals are scanned the
    same way, one level up, and composed into every lane.
    """
    compose = machine()[1]
    n = len(fns)
    if n <= lane:
        out = np.zeros(n, dtype=np.uint8)
        acc = 0
        flat = compose.tolist()
        for i, f in enumerate(fns.tolist()):
            out[i] = acc
            acc = flat[acc << 4 | f]
        return out
    lanes = -(-n // lane)
    grid = np.zeros(lanes * lane, dtype=np.uint8)
    grid[:n] = fns
    grid = np.ascontiguousarray(grid.reshape(lanes, lane).T)
    out = np.empty_like(grid)
    acc = np.zeros(lanes, dtype=np.uint8)
    for i in range(lane):
        out[i] = acc
        acc = compose.take(acc << 4 | grid[i])
    before = prefix_scan(acc, lane)
    out = compose.take(out | (before << 4)[None, :])
    return np.ascontiguousarray(out.T).reshape(-1)[:n]


def kinds_of(letters: str, numbers: str, spaces: str) -> bytes:
    """A compressed kind table of all code points."""
    table = np.zeros(0x110000, dtype=np.uint8)
    for chars, kind in ((letters, LETTER), (numbers, NUMBER), (spaces, SPACE)):
        table[np.frombuffer(chars.encode("utf-32-le"), dtype=np.uint32)] = kind
    table[0x20] = BLANK
    return zlib.compress(table.tobytes(), 9)


def _every_char() -> str:
    return "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))


@functools.cache
def kinds_by_tiktoken() -> bytes:
    """Kinds as the tiktoken library's own regex engine sees them.

    The tokenizers library's pre-tokenizer has the same ones (see the tests).
    """
    import tiktoken

    single = {bytes([i]): i for i in range(256)}
    chars = _every_char()

    def members(pattern: str) -> str:
        enc = tiktoken.Encoding("kinds", pat_str=pattern, mergeable_ranks=single, special_tokens={})
        step = 1 << 16
        return "".join(
            bytes(enc.encode_ordinary(chars[i : i + step])).decode() for i in range(0, len(chars), step)
        )

    return kinds_of(members(r"\p{L}"), members(r"\p{N}"), members(r"\s"))


@functools.cache
def _table(packed: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(packed), dtype=np.uint8)


#: Class by ``kind << 1 | next is white space or the end``.
_CLASS = np.array(
    [C_PUNCT, C_PUNCT, C_LETTER, C_LETTER, C_NUMBER, C_NUMBER, C_LONE, C_WHITE, C_JOIN, C_WHITE], dtype=np.uint8
)
_PAIRS = (("r", "e"), ("v", "e"), ("l", "l"))


def boundaries(text: str, first: np.ndarray, packed: bytes, whole: list[tuple[int, int]] = ()) -> np.ndarray:
    """Starts of all tokens of texts laid end to end, and the total length.

    ``first`` holds the starts of the (non-empty) texts.  ``whole`` lists spans
    that are one token each and part the text before from the text after.
    """
    cps = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
    n = len(cps)
    if not n:
        return np.zeros(1, dtype=np.int64)
    kind = _table(packed).take(cps)
    fresh = np.zeros(n + 1, dtype=bool)
    fresh[first] = True
    fresh[n] = True
    for a, b in whole:
        fresh[a] = fresh[b] = True
    ends = fresh[1:].copy()  # the next character is white space or another text's
    ends[:-1] |= kind[1:] >= SPACE
    cls = _CLASS.take(kind << 1 | ends)
    for at in np.flatnonzero(cps == 0x27).tolist():
        if at + 1 < n and not fresh[at + 1]:
            nxt = text[at + 1]
            if nxt in "stmd":
                cls[at] = C_TAIL2
            elif at + 2 < n and not fresh[at + 2] and (nxt, text[at + 2]) in _PAIRS:
                cls[at] = C_TAIL3
    cls |= fresh[:n].view(np.uint8) << 3
    of_class, _, states, starts = machine()
    state = states.take(prefix_scan(of_class.take(cls)))
    flags = starts.take(cls << 4 | state)
    for a, b in whole:
        flags[a] = True
        flags[a + 1 : b] = False
    return np.append(np.flatnonzero(flags), n)


def _marks(texts: list[str], packed: bytes, special: str | None) -> tuple[str, np.ndarray, list[int]]:
    """The texts end to end, all token starts in them, and tokens of each text."""
    text = "".join(texts)
    lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    edges = np.concatenate(([0], np.cumsum(lengths)))
    whole = []
    if special and special in text:
        for k, t in enumerate(texts):
            at = t.find(special)
            while at >= 0:
                whole.append((int(edges[k]) + at, int(edges[k]) + at + len(special)))
                at = t.find(special, at + len(special))
    marks = boundaries(text, edges[:-1][lengths > 0], packed, whole)
    return text, marks, np.diff(np.searchsorted(marks[:-1], edges)).tolist()


def slices(texts: list[str], packed: bytes, special: str | None = None) -> tuple[list[str], list[int]]:
    """All pre-tokens of the texts in order, and how many each text has.

    With ``special``, each of its occurrences is one piece of its own and the
    texts around it are split separately.
    """
    text, marks, per_text = _marks(texts, packed, special)
    cut = marks.tolist()
    return [text[a:b] for a, b in zip(cut, cut[1:])], per_text


def distinct(texts: list[str], packed: bytes, special: str | None = None) -> tuple[list[str], np.ndarray, list[int]]:
    """As ``slices``, with each pre-token once, and the number of every one.

    Pre-tokens are told apart by hash, and every one is then compared with the
    one that stands for it, so that a collision is seen (and nothing is merged).
    """
    text, marks, per_text = _marks(texts, packed, special)
    cps = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
    begin, size = marks[:-1], np.diff(marks)
    hashes = span_hashes(cps, begin, marks[1:])
    order = np.argsort(hashes)
    ranked = hashes[order]
    new = np.ones(len(order), dtype=bool)
    new[1:] = ranked[1:] != ranked[:-1]
    first, number = order[new], np.empty(len(order), dtype=np.int64)
    number[order] = np.cumsum(new) - 1
    model = begin[first][number]
    same = (size == size[first][number]).all()
    if not same or not (cps == cps[np.arange(len(cps)) - np.repeat(begin - model, size)]).all():
        first = number = np.arange(len(begin))
    return [text[a:b] for a, b in zip(begin[first].tolist(), marks[first + 1].tolist())], number, per_text
