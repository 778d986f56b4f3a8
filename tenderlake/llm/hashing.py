"""Prefix polynomial hashes of byte strings, modulo 2^64, for whole arrays at once.

``prefix(x)[j] - prefix(x)[i]`` is the hash of ``x[i:j]`` times ``BASE ** i``;
multiplied by the inverse power it is the hash of the substring alone,
wherever it stands. Modulo 2^64 the hash of long structured strings can be
forced to collide, so equal hashes are candidates, to be verified on the bytes.
"""

from __future__ import annotations

import numpy as np

BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
_tables = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE ** 0 .. n - 1 and their inverses."""
    if len(_tables[0]) < n:
        size = max(n, 1 << 16)
        for k, base in enumerate((BASE, INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _tables[k] = np.cumprod(steps)
    return _tables[0][:n], _tables[1][:n]


def prefix(octets: np.ndarray) -> np.ndarray:
    out = np.zeros(len(octets) + 1, np.uint64)
    terms = out[1:]
    terms[:] = octets
    terms += np.uint64(1)
    terms *= powers(len(octets))[0]
    np.cumsum(terms, out=terms)
    return out


def substrings(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each x[start:end]; unmixed, so that equal strings have equal hashes at any place."""
    return (sums[ends] - sums[starts]) * powers(len(sums))[1][starts]


def windows(sums: np.ndarray, width: int) -> np.ndarray:
    """Hash of every substring of ``width`` bytes."""
    n = len(sums) - width
    return (sums[width:] - sums[:n]) * powers(n)[1] if n > 0 else np.empty(0, np.uint64)


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread the hashes over all bits."""
    values = values ^ values >> np.uint64(32)
    values *= np.uint64(0xD6E8FEB86659FD93)
    values ^= values >> np.uint64(32)
    values *= np.uint64(0xD6E8FEB86659FD93)
    values ^= values >> np.uint64(32)
    return values


def spaced_words(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The text with A-Z lower-cased and one space before, between and after its words; the places of the spaces."""
    octets = np.frombuffer(b" " + b" ".join(text.lower().split()) + b" ", np.uint8)
    return octets, np.flatnonzero(octets == 32)
