"""Words of many texts at once as arrays: boundaries, 64-bit hashes, hashes of runs of words."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_VALUES = np.random.default_rng(20240229).integers(0, 2**64, 256, dtype=np.uint64)
_STEP = np.uint64(0x9E3779B97F4A7C15)  # odd, so that it has an inverse
_BACK = np.uint64(pow(int(_STEP), -1, 2**64))
_POWERS: dict[str, np.ndarray] = {}


def _powers(base: np.uint64, n: int) -> np.ndarray:
    """1, base, base^2, ... modulo 2^64; kept for up to four million."""
    name = str(base)
    found = _POWERS.get(name)
    if found is None or len(found) < n:
        found = np.ones(1 << max(16, int(n - 1).bit_length()), np.uint64)
        size = 1
        with np.errstate(over="ignore"):
            found[1:2] = base
            size, factor = 2, base * base
            while size < len(found):
                found[size : 2 * size] = found[:size] * factor
                size, factor = 2 * size, factor * factor
        if len(found) <= 1 << 22:
            _POWERS[name] = found
    return found[:n]


def mixed(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """Bijective scrambling of 64-bit numbers."""
    with np.errstate(over="ignore"):
        x = x + np.uint64((salt * 0xD1B54A32D192ED03 + 0x9E3779B97F4A7C15) % 2**64)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def word_hashes(texts: Sequence[bytes], lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word in order, A-Z lower-cased if asked for, and the number of words of each text.

    Words are what ASCII white space separates. The hash is a polynomial of the bytes modulo 2^64, scrambled.
    """
    data = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    if lower:
        data = _LOWER[data]
    space = _SPACE[data]
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    if len(data) and not space[0]:
        edge = np.concatenate([[0], edge])
    begin, end = edge[0::2], edge[1::2]
    with np.errstate(over="ignore"):
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_VALUES[data] * _powers(_STEP, len(data)), out=sums[1:])
        hashes = mixed((sums[end] - sums[begin]) * _powers(_BACK, len(data))[begin])
    stops = np.cumsum([len(t) + 1 for t in texts])
    upto = np.searchsorted(begin, stops)
    return hashes, np.diff(upto, prepend=0)


def run_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` words."""
    n = len(words) - size + 1
    with np.errstate(over="ignore"):
        total = np.zeros(n, np.uint64)
        for j in range(size):
            total += words[j : j + n] * np.uint64(pow(int(_STEP), 2 * j + 1, 2**64))
    return mixed(total)


def shingle_sets(texts: Sequence[bytes], size: int) -> list[np.ndarray]:
    """Sorted distinct hashes of the runs of ``size`` words of each text; a text with fewer words is one run, without any none."""
    hashes, counts = word_hashes(texts)
    out, at = [], 0
    for n in counts.tolist():
        own = hashes[at : at + n]
        at += n
        out.append(np.unique(run_hashes(own, min(size, n))) if n else own)
    return out
