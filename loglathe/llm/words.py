"""Words of texts as 64-bit hashes, for many texts at a time.

Words are runs of bytes other than the six ASCII white-space characters, with A to Z in
lower case. A word's hash is a polynomial of its bytes modulo 2 ** 64, taken from prefix
sums, and mixed with its length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

_BASE = 0x9E3779B97F4A7C15 | 1
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
# Texts are taken together up to this many bytes.
CHUNK_BYTES = 1 << 18

_forward = np.ones(1, np.uint64)
_backward = np.ones(1, np.uint64)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, from 0 to n - 1."""
    global _forward, _backward
    if len(_forward) < n:
        size = max(n, CHUNK_BYTES + (CHUNK_BYTES >> 2))
        inverse = pow(_BASE, -1, 1 << 64)
        for name, base in (("_forward", _BASE), ("_backward", inverse)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            globals()[name] = np.multiply.accumulate(steps)
    return _forward[:n], _backward[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (a bijection)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash of every word, number of words of each text, and where each word begins and ends.

    The last array has two columns: byte positions in the texts joined by a space each.
    """
    joined = _LOWER[np.frombuffer(b" ".join(texts) + b" ", np.uint8)]
    space = _IS_SPACE[joined]
    change = np.flatnonzero(np.diff(space, prepend=True))
    starts, ends = change[::2], change[1::2]
    forward, backward = _powers(len(joined) + 1)
    sums = np.zeros(len(joined) + 1, np.uint64)
    np.cumsum((joined.astype(np.uint64) + np.uint64(1)) * forward[:len(joined)], out=sums[1:])
    hashes = (sums[ends] - sums[starts]) * backward[starts]
    hashes = mix(hashes ^ ((ends - starts).astype(np.uint64) << np.uint64(48)))
    bounds = np.cumsum([len(t) + 1 for t in texts])
    upto = np.searchsorted(starts, bounds)
    return hashes, np.diff(upto, prepend=0), np.stack([starts, ends], 1)


def chunks(texts: list[str | None], size: int = CHUNK_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """Texts as bytes, in pieces of about ``size`` bytes, each with the index of its first."""
    piece: list[bytes] = []
    first, held = 0, 0
    for i, text in enumerate(texts):
        piece.append((text or "").encode())
        held += len(piece[-1])
        if held >= size:
            yield first, piece
            piece, first, held = [], i + 1, 0
    if piece:
        yield first, piece
