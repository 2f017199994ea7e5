"""Words of Arrow string columns as numpy arrays: places and 64-bit hashes, no Python string per word.

A word is a maximal run of bytes other than space, tab, line feed, vertical
tab, form feed and carriage return.  UTF-8 never uses those bytes inside a
longer character, so bytes and code points agree on where words are.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_seeds = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _seeds.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))
_powers = np.ones(1, np.uint64), np.ones(1, np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(32))


def _power_tables(n: int):
    global _powers
    if len(_powers[0]) < n + 1:
        size = max(n + 1, 2 * len(_powers[0]))
        with np.errstate(over="ignore"):
            out = []
            for base in (_BASE, _INVERSE):
                steps = np.full(size, base, np.uint64)
                steps[0] = 1
                out.append(np.multiply.accumulate(steps))
        _powers = out[0], out[1]
    return _powers


@dataclass
class Words:
    data: np.ndarray  # all bytes of the column, as hashed
    raw: np.ndarray  # the same bytes unchanged
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    cuts: np.ndarray  # words of row i: cuts[i] to cuts[i + 1]

    def doc_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.cuts) - 1), np.diff(self.cuts))


def string_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets; null rows are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return binary_buffers(column.cast(pa.large_string()).fill_null(""))


def binary_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a large column without nulls."""
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8)[offs[0] : offs[-1]] if data is not None and len(column) else np.zeros(0, np.uint8)
    return raw, offs - offs[0]


def ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers of ``starts[i]`` up to ``starts[i] + sizes[i]``, one run after another."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(int(ends[-1]) if len(ends) else 0)


def _run_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """By prefix sums over each stretch; stretches keep the power tables short."""
    hashes = np.empty(len(starts), np.uint64)
    stretch = 1 << 17
    at = 0
    with np.errstate(over="ignore"):
        while at < len(starts):
            lo = int(starts[at])
            upto = max(at + 1, int(np.searchsorted(ends, lo + stretch, "right")))
            hi = int(ends[upto - 1])
            power, inverse = _power_tables(hi - lo)
            sums = np.zeros(hi - lo + 1, np.uint64)
            np.cumsum(_BYTE[data[lo:hi]] * power[: hi - lo], out=sums[1:])
            s, e = starts[at:upto] - lo, ends[at:upto] - lo
            hashes[at:upto] = mix((sums[e] - sums[s]) * inverse[s] + (e - s).astype(np.uint64) * _BASE)
            at = upto
    return hashes


def run_hashes(raw: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """One hash per run of bytes ``raw[offs[i]:offs[i + 1]]``."""
    return _run_hashes(raw, offs[:-1], offs[1:])


def split_words(column: pa.Array, *, lower: bool = False) -> Words:
    raw, offs = string_buffers(column)
    data = _LOWER[raw] if lower else raw
    n = len(data)
    if not n:
        none = np.zeros(0, np.int64)
        return Words(data, raw, none, none, np.zeros(0, np.uint64), np.zeros(len(offs), np.int64))
    solid = ~_SPACE[data]
    first = np.zeros(n + 1, bool)
    first[offs[:-1]] = True
    first[n] = True
    before = np.concatenate([[False], solid[:-1]])
    starts = np.nonzero(solid & (~before | first[:n]))[0]
    after = np.concatenate([solid[1:], [False]])
    ends = np.nonzero(solid & (~after | first[1:]))[0] + 1
    hashes = _run_hashes(data, starts, ends)
    cuts = np.searchsorted(starts, offs)
    return Words(data, raw, starts, ends, hashes, cuts)


_ROLL = _seeds.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(hashes: np.ndarray, size: int) -> np.ndarray:
    """One hash per run of ``size`` words of one document; with fewer words, one for the whole sequence; none without words."""
    n = len(hashes)
    if not n:
        return hashes
    size = min(n, size)
    with np.errstate(over="ignore"):
        out = hashes[: n - size + 1] * _ROLL[0]
        for k in range(1, size):
            out = out + hashes[k : n - size + 1 + k] * _ROLL[k]
        return mix(out + np.uint64(size))


_WINDOW_BASE = np.uint64(0xD1342543DE82EF95)
_WINDOW_INVERSE = np.uint64(pow(int(_WINDOW_BASE), -1, 2**64))


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """One hash per run of ``size`` consecutive words of one document, in time independent of ``size``."""
    n = len(hashes)
    if n < size:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        steps = np.full(n, _WINDOW_BASE, np.uint64)
        steps[0] = 1
        back = np.full(n, _WINDOW_INVERSE, np.uint64)
        back[0] = 1
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(hashes * np.multiply.accumulate(steps), out=sums[1:])
        return mix((sums[size:] - sums[:-size]) * np.multiply.accumulate(back)[: n - size + 1])
