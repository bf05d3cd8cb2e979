"""Words, shingles and their 64-bit hashes, for a batch of texts at a time.

A word is a run of bytes other than 0x20 and 0x09-0x0D; A-Z count as a-z. All
passes over the bytes are NumPy passes over the joined texts of a batch; a
batch is cut at ``SLICE`` bytes, so the working arrays stay bounded by the
longest single text.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

SLICE = 1 << 20
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_BASE = 0x9E3779B97F4A7C15 | 1
_INV = pow(_BASE, -1, 1 << 64)
_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of SplitMix64."""
    x = x.astype(_U, copy=True)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


_powers = {"n": 0, "up": np.ones(1, _U), "down": np.ones(1, _U)}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if _powers["n"] < n:
        n = max(n, SLICE * 2)
        for name, base in (("up", _BASE), ("down", _INV)):
            a = np.full(n, base, dtype=_U)
            a[0] = 1
            _powers[name] = np.multiply.accumulate(a)
        _powers["n"] = n
    return _powers["up"], _powers["down"]


def slices(texts: Sequence[str | None], most: int = SLICE) -> Iterator[tuple[int, list[bytes]]]:
    """(index of the first text, texts as UTF-8) in runs of about ``most`` bytes."""
    start, size, out = 0, 0, []
    for i, t in enumerate(texts):
        b = t.encode("utf-8", "surrogatepass") if isinstance(t, str) else b""
        if out and size + len(b) > most:
            yield start, out
            start, size, out = i, 0, []
        out.append(b)
        size += len(b) + 1
    if out:
        yield start, out


def word_hashes(texts: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash of each word, first word of each text with the total at the end,
    byte start of each word in its text, byte end)."""
    joined = b" ".join(texts) + b" "
    c = _LOWER[np.frombuffer(joined, dtype=np.uint8)]
    gap = _SPACE[c]
    edge = np.flatnonzero(gap[1:] != gap[:-1]) + 1
    if not gap[0]:
        edge = np.concatenate(([0], edge))
    starts, ends = edge[0::2], edge[1::2]
    up, down = _power_tables(len(c) + 1)
    total = np.zeros(len(c) + 1, dtype=_U)
    np.cumsum((c.astype(_U) + _U(1)) * up[: len(c)], out=total[1:])
    h = mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(_U))
    sizes = np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts))
    at = np.concatenate(([0], np.cumsum(sizes)))
    first = np.searchsorted(starts, at)
    of = np.repeat(np.arange(len(texts)), np.diff(first))
    return h, first, starts - at[of], ends - at[of]


def shingles(h: np.ndarray, first: np.ndarray, n: int) -> list[np.ndarray]:
    """For each text its sorted distinct n-word shingles (as hashes); with
    fewer words the whole sequence is the only one; without words none."""
    k = _U(0xD6E8FEB86659FD93)
    g = h.copy()
    for j in range(1, n):
        g[: len(g) - j] = g[: len(g) - j] * k + h[j:]
    g = mix(g + _U(n))
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= n:
            out.append(np.unique(g[a : b - n + 1]))
        elif b > a:
            one = h[a : a + 1].copy()
            for j in range(a + 1, b):
                one = one * k + h[j]
            out.append(mix(one + _U(b - a)))
        else:
            out.append(np.empty(0, dtype=_U))
    return out


def text_shingles(texts: Sequence[str | None], n: int) -> Iterator[np.ndarray]:
    for _, part in slices(texts):
        h, first, _, _ = word_hashes(part)
        yield from shingles(h, first, n)
