"""Hashes of all words of a block of text at once, in numpy.

A word's hash is a polynomial in its bytes modulo 2^64 under an odd base, with a
random number for each byte: prefix sums over the block give those of all words by
one subtraction each. Two bases give 128 bits. A-Z count as a-z.
"""

from __future__ import annotations

import numpy as np

from reelstat.llm.common import mix

#: Two odd bases, and a random number for each byte under each of them.
BASES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1342543DE82EF95))
_BYTES = np.random.default_rng(20).integers(1, 2 ** 63, (2, 256), np.uint64)
_BYTES[:, 65:91] = _BYTES[:, 97:123]
#: Bytes whose powers of the bases are kept; longer blocks are summed in parts.
_PART = 1 << 20
#: What a byte is: 0 part of a word, 1 a gap between words, 2 a gap that ends a piece.
WORDS = np.zeros(256, np.uint8)
WORDS[list(b" \t\n\v\f\r")] = 1


def _powers(base: np.uint64) -> np.ndarray:
    return np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(_PART, base))])


_POWERS = tuple(map(_powers, BASES))
_INVERSES = tuple(_powers(np.uint64(pow(int(b), -1, 2 ** 64))) for b in BASES)


def word_hashes(data: bytes, kinds: np.ndarray = WORDS, halves: int = 2) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, one or two rows of 64 bits; piece of each word; starts; ends) of the words of a block."""
    codes = np.frombuffer(data, np.uint8)
    kind = kinds[codes]
    inside = np.concatenate([[False], kind == 0, [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    piece = np.concatenate([np.zeros(1, np.int64), np.cumsum(kind == 2)])[starts]
    found = np.zeros((halves, len(starts)), np.uint64)
    longest = int((ends - starts).max(initial=0))
    for row in range(halves):
        powers, inverses, table = _POWERS[row], _INVERSES[row], _BYTES[row]
        for at in range(0, len(codes), _PART):  # the sum at a word's end less that at its start, moved to power 0
            part = codes[at:at + _PART]
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(table[part] * powers[:len(part)])])
            low, high = np.searchsorted(ends, at, "right"), np.searchsorted(starts, at + len(part))
            if low == high:
                continue
            first, last = np.maximum(starts[low:high] - at, 0), np.minimum(ends[low:high] - at, len(part))
            here = (sums[last] - sums[first]) * inverses[first]
            before = at + first - starts[low:high]  # bytes of the word in earlier parts
            if longest < _PART:
                found[row, low:high] += here * powers[before]
            else:
                found[row, low:high] += here * np.array([pow(int(BASES[row]), int(n), 2 ** 64) for n in before], np.uint64)
        found[row] = mix(found[row] ^ mix((ends - starts).astype(np.uint64)))
    return found, piece, starts, ends
