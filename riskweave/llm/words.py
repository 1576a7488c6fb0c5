"""Hashes of all words of a text at once, with numpy."""

from __future__ import annotations

import numpy as np

_S = [np.uint64(s) for s in range(64)]
M1, M2, M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_VALUE = np.random.default_rng(5).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_VALUE[ord("A") : ord("Z") + 1] = _VALUE[ord("a") : ord("z") + 1]
_VALUE[_SPACE] = 0
_PLACES = 1 << 16
_POWER = np.concatenate([[np.uint64(1)], np.full(_PLACES - 1, M1)]).cumprod(dtype=np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _S[30])) * M2
    x = (x ^ (x >> _S[27])) * M3
    return x ^ (x >> _S[31])


def words_of(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first byte, end, 64-bit hash) of each word; A-Z hash like a-z.

    The hash is the sum of the bytes' values times powers of their places.
    """
    raw = np.frombuffer(text, dtype=np.uint8)
    inside = np.zeros(len(raw) + 2, dtype=np.int8)
    inside[1:-1] = ~_SPACE[raw]
    edges = np.diff(inside)
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    if not len(starts):
        return starts, ends, np.zeros(0, dtype=np.uint64)
    base = starts[0]
    place = np.arange(base, len(raw)) - np.repeat(starts, np.diff(starts, append=len(raw)))
    terms = _VALUE[raw[base:]] * _POWER[place & (_PLACES - 1)]
    if place.max() >= _PLACES:  # places repeat in words of more than 64 KB only; there the turn is mixed in
        far = np.flatnonzero(place >= _PLACES)
        terms[far] = mixed(terms[far] + (place[far] // _PLACES).astype(np.uint64)) * (~_SPACE[raw[base:][far]]).astype(np.uint64)
    return starts, ends, mixed(np.add.reduceat(terms, starts - base))
