"""Numpy kernels over the text of an Arrow batch: UTF-8 bytes, words, rolling hashes, sliding extremes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that one kernel call works on; a longer document is one call of its own.
CHUNK_BYTES = 1 << 19

_U = np.uint64
#: Odd multiplier of the rolling hashes (2**64 divided by the golden ratio) and its inverse modulo 2**64.
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers."""
    x = x.astype(_U, copy=True)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


_BYTE = mix64(np.arange(1, 257, dtype=_U) * _U(_BASE))
_powers: list[np.ndarray] = [np.ones(1, _U), np.ones(1, _U)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64 for i < n (kept between calls for texts of up to CHUNK_BYTES)."""
    if len(_powers[0]) >= n:
        return _powers[0][:n], _powers[1][:n]
    size, pair = max(n, CHUNK_BYTES + 1), []
    for base in (_BASE, _INVERSE):
        steps = np.full(size, base, _U)
        steps[0] = 1
        pair.append(np.cumprod(steps))
    if size == CHUNK_BYTES + 1:
        _powers[:] = pair
    return pair[0][:n], pair[1][:n]


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column, and the offset of each row (one more than rows); nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)
    offsets = offsets[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    if data is None or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), offsets - offsets[0]
    return np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]], offsets - offsets[0]


def row_chunks(offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes, or of one row."""
    start, rows = 0, len(offsets) - 1
    while start < rows:
        end = max(start + 1, int(np.searchsorted(offsets, offsets[start] + limit, "right")) - 1)
        yield start, min(end, rows)
        start = min(end, rows)


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and per row the index of its first word (one more than rows)."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    solid = ~SPACE[data]
    before = np.empty_like(solid)
    before[0], before[1:] = False, solid[:-1]
    before[offsets[:-1][offsets[:-1] < len(data)]] = False
    after = np.empty_like(solid)
    after[-1], after[:-1] = False, solid[1:]
    after[offsets[1:][offsets[1:] > 0] - 1] = False
    starts, ends = np.flatnonzero(solid & ~before), np.flatnonzero(solid & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


#: The prime 2**31 - 1, and two bases for hashes modulo it.
_PRIME, _PRIME_BASES = (1 << 31) - 1, (1103515245, 1812433253 % ((1 << 31) - 1))
_RESIDUE = ((_BYTE >> _U(20)) & _U(_PRIME)) % _U(_PRIME)
_prime_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers_of(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo the prime for i < n (kept between calls for texts of up to CHUNK_BYTES)."""
    if base in _prime_powers and len(_prime_powers[base][0]) >= n:
        return _prime_powers[base][0][:n], _prime_powers[base][1][:n]
    size, pair = max(n, CHUNK_BYTES + 1), []
    for step in (base, pow(base, -1, _PRIME)):
        out, have = np.ones(size, _U), 1
        while have < size:  # twice as many at a time
            more = min(have, size - have)
            out[have:have + more] = out[:more] * _U(pow(step, have, _PRIME)) % _U(_PRIME)
            have += more
        pair.append(out)
    if size == CHUNK_BYTES + 1:
        _prime_powers[base] = (pair[0], pair[1])
    return pair[0][:n], pair[1][:n]


def span_residues(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, which: int = 0) -> np.ndarray:
    """31-bit polynomial hash of each span's bytes modulo a prime, independent of where it stands."""
    up, down = _powers_of(_PRIME_BASES[which], len(data) + 1)
    terms = _RESIDUE[data]
    terms *= up[:-1]
    high = terms >> _U(31)
    terms &= _U(_PRIME)
    terms += high  # congruent, and below 2**33, so that sums do not overflow
    sums = np.zeros(len(data) + 1, _U)
    np.cumsum(terms, out=sums[1:])
    return (sums[ends] - sums[starts]) % _U(_PRIME) * down[starts] % _U(_PRIME)


def short_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each span's bytes, independent of where it stands, for spans of up to a hundred bytes or so.

    It is a polynomial modulo 2**64, which gives the same value to some texts of a thousand letters whatever its base is.
    """
    up, down = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, _U)
    np.cumsum(_BYTE[data] * up[:-1], out=sums[1:])
    return mix64((sums[ends] - sums[starts]) * down[starts])


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each span's bytes, of any length, independent of where it stands: two polynomials, one of them
    modulo a prime."""
    return mix64(short_hashes(data, starts, ends) + mix64(span_residues(data, starts, ends)))


def run_hashes(items: np.ndarray, length: int) -> np.ndarray:
    """64-bit hash of every run of ``length`` items; entry i is the run that starts at i."""
    n = len(items) - length + 1
    if n <= 0:
        return np.zeros(0, _U)
    up, down = powers(len(items) + 1)
    sums = np.zeros(len(items) + 1, _U)
    np.cumsum(items * up[:-1], out=sums[1:])
    return mix64((sums[length:] - sums[:n]) * down[:n])


def sliding(values: np.ndarray, width: int, best) -> np.ndarray:
    """``best`` (np.minimum or np.maximum) over every run of ``width`` values, in log(width) passes."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = best(out[:-step], out[step:])
        have += step
    return out


def minimizers(hashes: np.ndarray, width: int) -> np.ndarray:
    """Mask of the values that are the least of some run of ``width`` values (all of equal ones)."""
    if len(hashes) < width:
        return np.zeros(len(hashes), bool)
    low = sliding(hashes, width, np.minimum)
    edge = np.zeros(width - 1, hashes.dtype)
    return sliding(np.concatenate([edge, low, edge]), width, np.maximum) == hashes


def segments(sorted_keys: np.ndarray) -> np.ndarray:
    """Start of each run of equal keys."""
    if not len(sorted_keys):
        return np.zeros(0, np.int64)
    return np.flatnonzero(np.concatenate([[True], sorted_keys[1:] != sorted_keys[:-1]]))


def runs(sorted_keys: np.ndarray) -> list[tuple[int, int]]:
    """[start, end) of each run of equal keys."""
    at = segments(sorted_keys)
    return list(zip(at.tolist(), np.append(at[1:], len(sorted_keys))[:len(at)].tolist(), strict=True))


def take_ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indexes of the ranges [start, start + length) one after another."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    keep = lengths > 0
    starts, lengths = starts[keep], lengths[keep]
    steps = np.ones(total, np.int64)
    steps[0] = starts[0]
    at = np.cumsum(lengths)[:-1]
    steps[at] = starts[1:] - starts[:-1] - lengths[:-1] + 1
    return np.cumsum(steps)


def pieces(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[bytes]:
    """The spans as bytes."""
    raw = data.tobytes()
    return [raw[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
