"""Hamming search over fingerprints stored as vertical bit planes.

Plane b holds bit b of every fingerprint, 64 fingerprints to a machine word.
One XOR per plane compares 64 pairs at once; the distances of the 64 lanes
are kept in bit-sliced counters that take two planes per carry-save addition.
A block (one word of lanes) is abandoned as soon as all its lanes exceed the
radius. Only numpy, no Spark: the operator calls it inside tasks.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

BITS = 64
ABANDON_EVERY = 8  # planes between two looks at the counters
SHIFT_LANES = 63  # runs up to this length are compared by shifting the planes
QUERY_ROWS = 256  # queries of a longer run that are compared at once


def planes(fps: np.ndarray) -> np.ndarray:
    """(64, words + 1) bit planes of uint64 fingerprints; the last word is padding for shifts."""
    n = len(fps)
    bits = np.unpackbits(fps.astype("<u8").view(np.uint8).reshape(n, 8), axis=1, bitorder="little")
    packed = np.packbits(bits.T, axis=1, bitorder="little")
    words = np.zeros((BITS, (n + 63) // 64 + 1), dtype="<u8")
    words.view(np.uint8).reshape(BITS, -1)[:, : packed.shape[1]] = packed
    return words


def _pack(mask: np.ndarray) -> np.ndarray:
    packed = np.packbits(mask, bitorder="little")
    out = np.zeros((len(mask) + 63) // 64 * 8, dtype=np.uint8)
    out[: len(packed)] = packed
    return out.view("<u8")


def _lanes(words: np.ndarray) -> np.ndarray:
    """(block, 64) truth values of packed words."""
    return np.unpackbits(np.ascontiguousarray(words).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def _exceeds(counter: list[np.ndarray], radius: int) -> np.ndarray:
    over = np.zeros_like(counter[0])
    equal = ~over
    for k in reversed(range(len(counter))):
        if radius >> k & 1:
            equal = equal & counter[k]
        else:
            over |= equal & counter[k]
            equal = equal & ~counter[k]
    return over


def within(differ: Callable[[int, np.ndarray], np.ndarray], mask: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Blocks and lanes whose distance is at most ``radius``.

    ``differ(bit, blocks)`` gives the XOR words of one plane for the given
    block numbers; ``mask`` has the lanes of each block that hold a pair.
    """
    alive = np.flatnonzero(mask)
    lanes = mask[alive]
    width = (radius + 2).bit_length()
    counter = [np.zeros_like(lanes) for _ in range(width)]
    for bit in range(0, BITS, 2):
        if not len(alive):
            break
        x, y = differ(bit, alive), differ(bit + 1, alive)
        half = counter[0] ^ x
        carry = (counter[0] & x) | (half & y)
        counter[0] = half ^ y
        for k in range(1, width):
            counter[k], carry = counter[k] ^ carry, counter[k] & carry
        lanes = lanes & ~_exceeds(counter, radius)
        if (bit + 2) % ABANDON_EVERY == 0:
            keep = lanes != 0
            if not keep.all():
                alive, lanes = alive[keep], lanes[keep]
                counter = [c[keep] for c in counter]
    block, lane = np.nonzero(_lanes(lanes)) if len(alive) else (np.zeros(0, int), np.zeros(0, int))
    return alive[block], lane


def near_pairs(fps: np.ndarray, run: np.ndarray, radius: int):
    """Yield (left, right) index arrays of all pairs of one run within ``radius``.

    ``run`` numbers the bucket of each fingerprint and is sorted. Pairs come
    in bounded pieces: one for each shift, or for each group of queries.
    """
    n = len(fps)
    if n < 2:
        return
    plane = planes(fps)
    starts = np.flatnonzero(np.r_[True, run[1:] != run[:-1]])
    sizes = np.diff(np.r_[starts, n])
    short = np.repeat(sizes <= SHIFT_LANES, sizes)
    for d in range(1, min(SHIFT_LANES, int(sizes[sizes <= SHIFT_LANES].max(initial=1)))):
        pair = np.zeros(n, dtype=bool)
        pair[:-d] = (run[d:] == run[:-d]) & short[:-d]

        def shifted(bit: int, at: np.ndarray, d: int = d) -> np.ndarray:
            own = plane[bit, at]
            return own ^ ((own >> np.uint64(d)) | (plane[bit, at + 1] << np.uint64(64 - d)))

        block, lane = within(shifted, _pack(pair), radius)
        left = block * 64 + lane
        if len(left):
            yield left, left + d
    for start, size in zip(starts[sizes > SHIFT_LANES], sizes[sizes > SHIFT_LANES], strict=True):
        own = fps[start : start + size]
        vertical = planes(own)[:, :-1]
        words = vertical.shape[1]
        for low in range(0, size, QUERY_ROWS):
            query = own[low : low + QUERY_ROWS].astype("<u8")
            pair = np.arange(words * 64)[None, :] > np.arange(low, low + len(query))[:, None]
            pair[:, size:] = False

            def crossed(bit: int, at: np.ndarray, query=query, vertical=vertical, words=words) -> np.ndarray:
                row, word = np.divmod(at, words)
                return vertical[bit, word] ^ (np.uint64(0) - ((query[row] >> np.uint64(bit)) & np.uint64(1)))

            mask = _pack(pair.reshape(-1))
            block, lane = within(crossed, mask, radius)
            if len(block):
                row, word = np.divmod(block, words)
                yield start + low + row, start + word * 64 + lane
