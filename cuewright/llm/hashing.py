"""Vectorised hashes of words, of runs of words and of byte windows, and minimiser positions.

A word's bytes are taken eight at a time, each lane mixed into a 64-bit state, so
that words of up to eight bytes cannot collide with others of their length.  Runs
of words and windows of bytes are built by doubling: two neighbours of one length
are joined to one of twice that length, the last two overlapping.  Joining is not
linear (it multiplies, folds and adds in turn), so texts with much structure, such
as Thue-Morse words, collide no more often than others do.  Two seeds give 128 bits
wherever equality decides a result; 64 bits are used only to pick candidates.
"""

from __future__ import annotations

import hashlib

import numpy as np

U = np.uint64
_M1, _M2, _M3 = U(0xBF58476D1CE4E5B9), U(0x94D049BB133111EB), U(0x9E3779B97F4A7C15)
_SEEDS = (U(0x243F6A8885A308D3), U(0x13198A2E03707344))
#: Bytes beyond which a word is hashed by blake2b.
LONG = 128
#: Keeps the first 0 to 8 bytes of a little-endian lane.
_KEEP = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
#: ASCII white space, as in [\x20\x09-\x0D].
SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> U(30))
    x = x * _M1
    x ^= x >> U(27)
    x *= _M2
    return x ^ (x >> U(31))


def join(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """One value for each pair in order; for a given a, different b give different values."""
    t = a * _M1
    t ^= t >> U(32)
    t += b
    t *= _M2
    t ^= t >> U(29)
    return t


def _lanes(x: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on, zeros behind the end."""
    held = np.zeros(len(x) + 8, np.uint8)
    held[: len(x)] = x
    return np.ndarray((len(x) + 1,), "<u8", held, 0, (1,))


def word_bounds(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of maximal runs without ASCII white space."""
    inside = np.zeros(len(x) + 2, np.int8)
    inside[1:-1] = ~SPACE[x]
    d = np.diff(inside)
    return np.flatnonzero(d == 1), np.flatnonzero(d == -1)


def spans(x: np.ndarray, start: np.ndarray, end: np.ndarray, seed: int = 0) -> np.ndarray:
    """Hash of the bytes of each span."""
    size, lanes = end - start, _lanes(x)
    h = mix(size.astype(np.uint64) * _M3 + _SEEDS[seed])
    at, rest, who = start, size, None
    while len(at):
        lane = lanes[at] & _KEEP[np.minimum(rest, 8)]
        if who is None:
            h = mix(h ^ lane)
        else:
            h[who] = mix(h[who] ^ lane)
        more = np.flatnonzero((rest > 8) & (size <= LONG) if who is None else rest > 8)
        who = more if who is None else who[more]
        at, rest = at[more] + 8, rest[more] - 8
    for i in np.flatnonzero(size > LONG).tolist():
        d = hashlib.blake2b(x[start[i] : end[i]].tobytes(), digest_size=8, salt=bytes([seed + 1])).digest()
        h[i] = int.from_bytes(d, "little")
    return h


def _doubled(g: np.ndarray, size: int, n: int) -> np.ndarray:
    """From values of runs of ``size``, those of runs of n."""
    while 2 * size <= n:
        g = join(g[:-size], g[size:])
        size *= 2
    if size < n:
        g = join(g[: len(g) - (n - size)], g[n - size :])
    return g


def ngrams(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of n consecutive values of h."""
    return mix(_doubled(h, 1, n)) if len(h) >= n else np.zeros(0, np.uint64)


def windows(x: np.ndarray, k: int, seed: int = 0) -> np.ndarray:
    """Hash of every k-byte window, k being 8 at least."""
    if len(x) < k:
        return np.zeros(0, np.uint64)
    lanes = np.array(_lanes(x)[: len(x) - 7])
    return mix(_doubled(mix(lanes + _SEEDS[seed]) if seed else lanes, 8, k))


def _sliding(v: np.ndarray, w: int, op: np.ufunc, fill: int) -> np.ndarray:
    """op over every w consecutive values, in linear time: block prefixes and suffixes."""
    n = len(v)
    blocks = -(-n // w)
    a = np.full(blocks * w, U(fill), np.uint64)
    a[:n] = v
    a = a.reshape(blocks, w)
    left = op.accumulate(a, axis=1).ravel()
    right = op.accumulate(a[:, ::-1], axis=1)[:, ::-1].ravel()
    return op(right[: n - w + 1], left[w - 1 : n])


def minimisers(v: np.ndarray, w: int) -> np.ndarray:
    """Positions that hold the smallest value of some w consecutive ones; equal values all count.

    Whether a position is chosen depends only on values in its windows, so equal
    stretches of two texts choose the same positions, and each run of w
    positions holds a chosen one.
    """
    if len(v) < w:
        return np.zeros(0, np.int64)
    low = _sliding(v, w, np.minimum, (1 << 64) - 1)
    padded = np.zeros(len(low) + 2 * (w - 1), np.uint64)
    padded[w - 1 : w - 1 + len(low)] = low
    return np.flatnonzero(_sliding(padded, w, np.maximum, 0) == v)


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)
