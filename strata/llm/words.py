"""Vectorised word hashing over UTF-8 bytes.

A word is a maximal run of bytes of one class; classes are 256-entry tables,
so multi-byte characters need no decoding. Word and window hashes are 64-bit
polynomial sums over random byte values (from a fixed seed), finished with a
mixing step; they are the same in every process.
"""

from __future__ import annotations

import numpy as np

PIECE = 1 << 20

_rng = np.random.default_rng(20240601)
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LOWER = np.arange(256)
_LOWER[65:91] += 32
_BYTE_LOWER = _BYTE[_LOWER]
_B = 0x9E3779B97F4A7C15 | 1
_B_INV = pow(_B, -1, 1 << 64)


def _class(gaps: list[tuple[int, int]]) -> np.ndarray:
    t = np.ones(256, dtype=bool)
    for a, b in gaps:
        t[a:b + 1] = False
    return t


#: [^\x20\x09-\x0D]+
NON_SPACE = _class([(0x20, 0x20), (0x09, 0x0D)])
#: [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ of the lower-cased text, on the raw bytes
ALNUM = _class([(0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F)])


class _Powers:
    up = np.ones(1, dtype=np.uint64)
    down = np.ones(1, dtype=np.uint64)

    @classmethod
    def of(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            size = max(n, PIECE + 1)

            def powers(base: int) -> np.ndarray:
                a = np.full(size, base, dtype=np.uint64)
                a[0] = 1
                return np.multiply.accumulate(a)
            cls.up, cls.down = powers(_B), powers(_B_INV)
        return cls.up[:n], cls.down[:n]


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _spans(buf: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    flags = np.zeros(len(buf) + 2, dtype=np.int8)
    flags[1:-1] = word[buf]
    step = np.diff(flags)
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


def _hash_piece(buf: np.ndarray, word: np.ndarray, values: np.ndarray, prefix: int | None):
    starts, ends = _spans(buf, word)
    all_ends = ends
    if prefix:
        ends = np.minimum(ends, starts + prefix)
    up, down = _Powers.of(len(buf) + 1)
    sums = np.zeros(len(buf) + 1, dtype=np.uint64)
    np.cumsum(values[buf] * up[:-1], out=sums[1:])
    return starts, all_ends, mix((sums[ends] - sums[starts]) * down[starts])


def hash_words(texts: list[bytes | None], word: np.ndarray, lower: bool, prefix: int | None = None):
    """(hashes, first, starts, ends) of the words of all texts in order:
    ``first[i]:first[i + 1]`` are text i's words; starts and ends are byte
    places in text i. With ``prefix``, only a word's first bytes are hashed. Memory is bounded by a few times the texts plus the
    temporaries of one piece of about a megabyte (or of one longer word)."""
    values = _BYTE_LOWER if lower else _BYTE
    parts, place, joined, size = [], [], [], 0

    def flush() -> None:
        nonlocal joined, size
        if not joined:
            return
        buf = np.frombuffer(b"\n".join(t for _, _, t in joined), dtype=np.uint8)
        s, e, h = _hash_piece(buf, word, values, prefix)
        at = np.cumsum([0] + [len(t) + 1 for _, _, t in joined])
        k = np.searchsorted(at, s, side="right") - 1
        shift = np.array([o for _, o, _ in joined]) - at[:-1]
        parts.append((h, np.array([i for i, _, _ in joined])[k], s + shift[k], e + shift[k]))
        joined, size = [], 0

    for i, t in enumerate(texts):
        t = t or b""
        place.append(len(t))
        o = 0
        while len(t) - o > PIECE:  # cut a long text between two words
            cut = o + PIECE
            while cut < len(t) and word[t[cut]]:
                cut += 1
            flush()
            joined.append((i, o, t[o:cut]))
            flush()
            o = cut
        joined.append((i, o, t[o:]))
        size += len(t) - o + 1
        if size > PIECE:
            flush()
    flush()
    n = len(texts)
    if not parts:
        empty = np.zeros(0, dtype=np.int64)
        return np.zeros(0, dtype=np.uint64), np.zeros(n + 1, dtype=np.int64), empty, empty
    h, d, s, e = (np.concatenate([p[k] for p in parts]) for k in range(4))
    first = np.searchsorted(d, np.arange(n + 1), side="left")
    return h, first, s, e


def windows(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all windows of k consecutive words (of one text)."""
    n = len(hashes)
    if n < k:
        return np.zeros(0, dtype=np.uint64)
    up, down = _Powers.of(n + 1)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(hashes * up[:n], out=sums[1:])
    return mix((sums[k:] - sums[:n - k + 1]) * down[:n - k + 1] + np.uint64(k))


def covered(n: int, starts: np.ndarray, k: int) -> np.ndarray:
    """Which of n words lie in a window of k words from one of ``starts``."""
    step = np.zeros(n + 1, dtype=np.int64)
    np.add.at(step, starts, 1)
    np.add.at(step, np.minimum(starts + k, n), -1)
    return np.cumsum(step[:n]) > 0
