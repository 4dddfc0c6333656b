"""Shingle sets, their parity sketches, and the keys by which near sets meet.

A set is XORed into a sketch: every shingle flips one bit. What two sets share cancels
out, so the Hamming distance of two sketches is at most the size of the sets' symmetric
difference. Sets of sizes a and b with a Jaccard similarity of at least 3/4 differ in at
most (a + b) / 7 shingles. Cut into more than that many blocks, two such sketches agree in
one. Take any order of all blocks' contents, and of either sketch the first d + 1 blocks
that are not blank, where d is the most by which such a set may differ from another: then
the two selections share a block. The order used puts contents last that many sketches of
a sample have, so that passages which many texts share seldom bring them together.

Sets meet in the size band of the smaller one: each gives the keys of its own band, and of
the band below where a partner may be there. In bands of small sets every shingle is a
block of its own.
"""

from __future__ import annotations

import numpy as np

from loglathe.llm.words import mix

SHINGLE = 5
# Bands are powers of two; below this size each shingle is a block.
LEAST_BLOCKED = 64
# Width of the sketches that are compared inside a join, a power of two. Two sets of n
# shingles that have little in common are told apart if it is well above n / 2.
FOLDED_BITS = 2048
_ODD = np.uint64(0xD6E8FEB86659FD93)


def shingle_sets(hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of every text, in ascending order, and their number for each text.

    A text of fewer words than a shingle has its whole sequence as one.
    """
    n = len(hashes)
    owner = np.repeat(np.arange(len(counts)), counts)
    short = (counts > 0) & (counts < SHINGLE)
    ends = np.cumsum(counts)
    out, owners = [], []
    if n >= SHINGLE:
        last = n - SHINGLE + 1
        value = np.zeros(last, np.uint64)
        for k in range(SHINGLE):
            value = value * _ODD + hashes[k:k + last]
        inside = owner[:last] == owner[SHINGLE - 1:]
        out.append(mix(value[inside]))
        owners.append(owner[:last][inside])
    for i in np.flatnonzero(short):
        value = np.full(1, int(counts[i]), np.uint64)
        for h in hashes[ends[i] - counts[i]:ends[i]]:
            value = value * _ODD + h
        out.append(mix(mix(value)))
        owners.append(np.full(1, i))
    value = np.concatenate([*out, np.zeros(0, np.uint64)])
    owner = np.concatenate([*owners, np.zeros(0, np.int64)]).astype(np.int64)
    order = np.lexsort((value, owner))
    value, owner = value[order], owner[order]
    fresh = np.ones(len(value), bool)
    fresh[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    value, owner = value[fresh], owner[fresh]
    return value, np.bincount(owner, minlength=len(counts))


def band_of(sizes: np.ndarray) -> np.ndarray:
    """The exponent of the power of two at or below each size."""
    return np.frexp(np.maximum(sizes, 1).astype(np.float64))[1].astype(np.int64) - 1


def blocks_in(band: np.ndarray, fine: bool) -> np.ndarray:
    """Number of blocks in a band; 0 stands for one block a shingle."""
    least = np.left_shift(1, band)
    blocks = least
    return np.where((least < LEAST_BLOCKED) | fine, 0, blocks)


class Order:
    """How often the contents of blocks occurred in a sample; all others count as rare."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray):
        by_key = np.argsort(keys)
        self.keys, self.counts = keys[by_key], counts[by_key]

    def of(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.zeros(len(keys), np.int64)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.counts[at], 0)


def keys(value: np.ndarray, counts: np.ndarray, order: Order | None, fine: bool = False
         ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys, the text each belongs to, and the texts that lack blocks that are not blank.

    Without an order, the keys of all blocks that are not blank. ``fine`` makes every
    shingle a block; then no text ever lacks blocks.
    """
    band = band_of(counts)
    own = (counts + 4 * counts // 3) // 7 + 1
    below = (counts + np.left_shift(1, band) - 1) // 7 + 1
    # A partner in the band below has three quarters of the size, at least.
    low = (counts > 0) & (3 * counts <= 4 * (np.left_shift(1, band) - 1)) & (band > 0)
    out, owners, lacking = [], [], []
    for wanted, at, need in ((counts > 0, band, own), (low, band - 1, below)):
        texts = np.flatnonzero(wanted)
        if not len(texts):
            continue
        picked = np.repeat(wanted, counts)
        owner = np.repeat(np.arange(len(counts)), counts)[picked]
        v = value[picked]
        blocks = blocks_in(at, fine)[owner].astype(np.uint64)
        block = np.where(blocks > 0, ((v >> np.uint64(32)) * blocks) >> np.uint64(32), v)
        # A block has as many bits as there are hashes; what it holds is named by the XOR of
        # random codes of its flipped bits.
        bit = mix(v + _ODD)
        first = np.ones(len(v), bool)
        first[1:] = (block[1:] != block[:-1]) | (owner[1:] != owner[:-1])
        begin = np.flatnonzero(first)
        pattern = np.bitwise_xor.reduceat(bit, begin)
        block, owner = block[begin], owner[begin]
        pattern = np.where(blocks[begin] > 0, pattern, np.uint64(1))
        filled = pattern != 0
        block, owner, pattern = block[filled], owner[filled], pattern[filled]
        # Keys of different bands, and of the two ways to cut, never meet.
        salt = (at[owner] * 2 + fine).astype(np.uint64)
        key = mix(mix(block * _ODD + salt) ^ pattern)
        have = np.bincount(owner, minlength=len(counts))
        if order is not None:
            # Rare contents first, and in order of blocks among those equally rare.
            rank = order.of(key)
            sequence = np.argsort(owner * (int(rank.max(initial=0)) + 1) + rank, kind="stable")
            owner, key = owner[sequence], key[sequence]
            place = np.arange(len(owner)) - np.repeat(np.cumsum(have) - have, have)
            used = place < need[owner]
            owner, key = owner[used], key[used]
        out.append(key)
        owners.append(owner)
        lacking.append(texts[have[texts] < need[texts]])
    none = np.zeros(0, np.int64)
    return (np.concatenate([*out, np.zeros(0, np.uint64)]), np.concatenate([*owners, none]),
            np.unique(np.concatenate([*lacking, none])))


def sketch(value: np.ndarray) -> bytes:
    """The parity sketch of one set: four bits a shingle or more, 64 bits at least."""
    bits = max(64, 4 << int(band_of(np.array([len(value)]))[0]))
    flipped = np.bincount((value & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(flipped.astype(np.uint8), bitorder="little").tobytes()


def folded(value: np.ndarray) -> list[int]:
    """A parity sketch of ``FOLDED_BITS`` whatever the size, as signed numbers of 64 bits."""
    flipped = np.bincount((value & np.uint64(FOLDED_BITS - 1)).astype(np.int64), minlength=FOLDED_BITS) & 1
    return np.packbits(flipped.astype(np.uint8), bitorder="little").view(np.int64).tolist()


def sketches(value: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``sketch`` of many sets, one after the other, and where each begins, one more at the end."""
    bits = np.where(counts > 0, np.maximum(64, np.left_shift(4, band_of(counts))), 0)
    begin = np.append(0, np.cumsum(bits))
    own = np.repeat(bits, counts).astype(np.uint64)
    at = np.repeat(begin[:-1], counts) + (value & (own - np.uint64(1))).astype(np.int64)
    flipped = np.bincount(at, minlength=int(begin[-1])) & 1
    return np.packbits(flipped.astype(np.uint8), bitorder="little"), begin // 8


def folded_all(value: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """``folded`` of many sets, a row each."""
    at = np.repeat(np.arange(len(counts)) * FOLDED_BITS, counts) + (value & np.uint64(FOLDED_BITS - 1)).astype(np.int64)
    flipped = np.bincount(at, minlength=len(counts) * FOLDED_BITS) & 1
    return np.packbits(flipped.astype(np.uint8), bitorder="little").view(np.int64).reshape(len(counts), -1)


def hamming(a: bytes, b: bytes) -> int:
    """Distance of two sketches; the larger is folded, which XORs equal residues."""
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    while len(x) > len(y):
        x = x[:len(x) // 2] ^ x[len(x) // 2:]
    while len(y) > len(x):
        y = y[:len(y) // 2] ^ y[len(y) // 2:]
    return int(np.bitwise_count(x ^ y).sum())


def set_digest(value: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """A 64-bit name of each set; equal sets have equal names."""
    ends = np.cumsum(counts)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(value))])
    return mix((sums[ends] - sums[ends - counts]) * _ODD + counts.astype(np.uint64))
