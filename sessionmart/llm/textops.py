"""Vectorised word and unit hashing for batches of texts (numpy, inside tasks).

Words are maximal runs of bytes other than space, tab, LF, VT, FF and CR
(``[^\\x20\\x09-\\x0D]+``). Texts of a batch are laid end to end in one byte
buffer; word boundaries and 64-bit word hashes come from a few array passes, so
no Python loop runs per word. Null texts count as empty.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (xor-shift-multiply finaliser)."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def is_space() -> np.ndarray:
    """Lookup table over bytes: the six white-space bytes that separate words."""
    t = np.zeros(256, bool)
    t[[9, 10, 11, 12, 13, 32]] = True
    return t


def byte_values() -> np.ndarray:
    """A fixed 64-bit value for each byte."""
    return mix(np.arange(1, 257, dtype=U64) * U64(0xD6E8FEB86659FD93))


def powers(n: int, base: int = _BASE) -> tuple[np.ndarray, np.ndarray]:
    """``base**i`` and its inverse modulo 2**64, for i below n."""
    up = np.full(n, U64(base), U64)
    down = np.full(n, U64(pow(base, -1, 1 << 64)), U64)
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=U64), np.cumprod(down, dtype=U64)


class Words:
    """Words of a batch of texts.

    ``hash``: one 64-bit hash a word; ``doc``: index of its text; ``start`` and
    ``end``: byte positions in ``buf``; ``first``: position of each text in
    ``buf`` (one more at the end); ``at``: first word of each text (one more at the end).
    """

    __slots__ = ("buf", "first", "start", "end", "hash", "doc", "at")


class WordHasher:
    """Splits and hashes batches; keeps its tables between batches.

    ``gaps``: a lookup table of the bytes that separate words (white space by default).
    """

    def __init__(self, gaps: np.ndarray | None = None) -> None:
        self.space, self.values = is_space() if gaps is None else gaps, byte_values()
        self.up, self.down = powers(1 << 16)

    def __call__(self, texts: Sequence[str | None], lower: bool = True) -> Words:
        raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
        if lower:
            raw = [b.lower() for b in raw]  # of bytes: A-Z alone
        w = Words()
        w.first = np.zeros(len(raw) + 1, np.int64)
        np.cumsum([len(b) + 1 for b in raw], out=w.first[1:])
        w.buf = buf = np.frombuffer(b"\n".join(raw) + b"\n", np.uint8)
        if not raw:
            buf = w.buf = np.zeros(0, np.uint8)
        if len(buf) > len(self.up):
            self.up, self.down = powers(len(buf) + len(buf) // 8)  # two tables of 8 bytes a place: not rounded up to twice as many
        gap = self.space[buf]
        edge = np.flatnonzero(np.diff(gap.astype(np.int8), prepend=np.int8(1)))
        w.start, w.end = edge[0::2], edge[1::2]
        run = np.zeros(len(buf) + 1, U64)
        np.cumsum(self.values[buf] * self.up[: len(buf)], out=run[1:], dtype=U64)
        w.hash = mix((run[w.end] - run[w.start]) * self.down[w.start] + (w.end - w.start).astype(U64))
        w.at = np.searchsorted(w.start, w.first)
        w.doc = np.repeat(np.arange(len(raw)), np.diff(w.at))
        return w


def chunks(texts: Sequence[str | None], max_chars: int = 2_000_000) -> Iterator[slice]:
    """Slices of a batch with about ``max_chars`` characters each (a longer text stands alone)."""
    start = size = 0
    for i, t in enumerate(texts):
        n = len(t) if t else 0
        if size and size + n > max_chars:
            yield slice(start, i)
            start, size = i, 0
        size += n
    if start < len(texts):
        yield slice(start, len(texts))


def gram_hashes(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all n-word sequences inside a text, and the index of their first words."""
    m = len(words.hash) - n + 1
    if m <= 0:
        return np.zeros(0, U64), np.zeros(0, np.int64)
    ok = np.flatnonzero(words.doc[:m] == words.doc[n - 1 :])
    k = pow(_BASE, 3, 1 << 64)
    out = np.zeros(m, U64)
    for j in range(n):
        out = out * U64(k) + words.hash[j : j + m]
    return mix(out[ok]), ok


def shingle_sets(words: Words, n: int = 5) -> list[np.ndarray]:
    """Per text, its sorted distinct n-word shingle hashes; a shorter text is one shingle, one without words none."""
    grams, at = gram_hashes(words, n)
    cut = np.searchsorted(at, words.at)
    out = []
    for i in range(len(words.at) - 1):
        g = grams[cut[i] : cut[i + 1]]
        if len(g) > 1:
            g = np.sort(g)
            g = g[np.concatenate(([True], g[1:] != g[:-1]))]
        elif not len(g) and words.at[i + 1] > words.at[i]:
            h = U64(words.at[i + 1] - words.at[i])
            for x in words.hash[words.at[i] : words.at[i + 1]]:
                h = U64((int(h) * _BASE + int(x)) & _MASK)
            g = mix(np.array([h], U64))
        out.append(g)
    return out
