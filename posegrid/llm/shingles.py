"""Word shingles as 64-bit hashes, many texts at a time.

Words are runs of anything but U+0020 and U+0009-U+000D, with A-Z lower-cased.
A text's set has the distinct shingles of ``size`` words; with fewer words, the
whole sequence as one; without words it is empty.  Hashes are polynomial sums
modulo 2**64 with mixed words, so equal shingles have equal hashes anywhere,
and different ones collide with a chance of about 2**-64 a pair.
"""

from __future__ import annotations

import functools

import numpy as np

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_STEP = 0xD6E8FEB86659FD93


def mix(h: np.ndarray) -> np.ndarray:
    """A public 64-bit finaliser (murmur-style): every bit depends on all."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


@functools.lru_cache(maxsize=2)
def _powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, 2**bits of each."""
    out = []
    for base in (_BASE, _INVERSE):
        p = np.ones(1, dtype=np.uint64)
        for k in range(bits):
            p = np.concatenate((p, p * np.uint64(pow(base, 1 << k, 1 << 64))))
        out.append(p)
    return out[0], out[1]


def span_hashes(cps: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of each span of code points, by its content and length only."""
    up, down = _powers(max(16, len(cps).bit_length()))
    total = np.concatenate((np.zeros(1, dtype=np.uint64), np.cumsum((cps + np.uint64(1)) * up[: len(cps)], dtype=np.uint64)))
    return mix((total[end] - total[begin]) * down[begin] + (end - begin).astype(np.uint64) * np.uint64(_STEP))


def words(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word, and the number of words of each text."""
    joined = "\n".join(texts) + "\n"
    cps = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    space = (cps == 32) | ((cps >= 9) & (cps <= 13))
    upper = (cps >= 65) & (cps <= 90)
    cps = cps + (upper.view(np.uint8) << 5)
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    if not space[0]:
        edge = np.concatenate(([0], edge))
    begin, end = edge[0::2], edge[1::2]
    h = span_hashes(cps, begin, end)
    lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    text_start = np.concatenate(([0], np.cumsum(lengths + 1)))
    return h, np.diff(np.searchsorted(begin, text_start))


def shingles(texts: list[str], size: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    h, n_words = words(texts)
    step = [np.uint64(pow(_STEP, k, 1 << 64)) for k in range(size)]
    full = np.zeros(max(0, len(h) - size + 1), dtype=np.uint64)
    for k in range(size):
        full += h[k : len(h) - size + 1 + k] * step[k] if len(full) else full
    full = mix(full + np.uint64(size))
    out = []
    at = 0
    for n in n_words.tolist():
        if n >= size:
            out.append(np.unique(full[at : at + n - size + 1]))
        elif n:
            part = h[at : at + n]
            with np.errstate(over="ignore"):
                out.append(mix((part * np.array(step[:n])).sum(keepdims=True, dtype=np.uint64) + np.uint64(n)))
        else:
            out.append(np.zeros(0, dtype=np.uint64))
        at += n
    return out
