"""Words of whole texts as numpy arrays, one bounded slice of an Arrow batch at a time.

A word is a run of word bytes; A-Z count as a-z. Each word gets a 64-bit hash out of
prefix sums over the bytes, so that no Python object per word is made. All words of a
text are taken, whatever its length; a slice holds whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def seeds(n: int, salt: int) -> np.ndarray:
    """n odd 64-bit numbers fixed by the salt."""
    steps = np.arange(1, n + 1, dtype=np.uint64) + np.uint64(salt * 1_000_003)
    return mix(mix(steps * np.uint64(_BASE))) | np.uint64(1)


_FOLDED = seeds(256, 7)  # a number for each byte
_FOLDED[65:91] = _FOLDED[97:123]

# Word bytes: all but ASCII white space, and all but ASCII that is no letter or digit.
SPACED = np.array([c != 0x20 and not 0x09 <= c <= 0x0D for c in range(256)])
ALNUM = np.array([c >= 128 or chr(c).isalnum() for c in range(256)])

_powers = np.empty(0, np.uint64)
_inverses = np.empty(0, np.uint64)


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers, _inverses
    if len(_powers) < n:
        n = max(n, SLICE_BYTES + 1)
        for base in (_BASE, _INVERSE):
            table = np.full(n, base, np.uint64)
            table[0] = 1
            np.cumprod(table, out=table)
            if base == _BASE:
                _powers = table
            else:
                _inverses = table
    return _powers, _inverses


class Words(NamedTuple):
    """hashes[bounds[i]:bounds[i + 1]] are the words of text i of the slice."""

    hashes: np.ndarray
    bounds: np.ndarray


class Slice(NamedTuple):
    """Whole texts, first .. first + len(offsets) - 1 of the batch."""

    first: int
    data: np.ndarray
    offsets: np.ndarray


def slices(texts: pa.Array, size: int = SLICE_BYTES) -> Iterator[Slice]:
    """The texts in slices of about ``size`` bytes; a null counts as empty."""
    texts = pc.fill_null(texts, "")
    wide = pa.types.is_large_string(texts.type)
    _, ends, data = texts.buffers()
    n = len(texts)
    if n == 0:
        return
    offsets = np.frombuffer(ends, np.int64 if wide else np.int32)[texts.offset : texts.offset + n + 1].astype(np.int64)
    content = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    row = 0
    while row < n:
        stop = max(row + 1, int(np.searchsorted(offsets, offsets[row] + size, "right")) - 1)
        stop = min(stop, n)
        yield Slice(row, content[offsets[row] : offsets[stop]], offsets[row : stop + 1] - offsets[row])
        row = stop


def runs(inside: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true values; a run ends where a text does."""
    n = len(inside)
    before = np.zeros(n, bool)
    before[1:] = inside[:-1]
    after = np.zeros(n, bool)
    after[:-1] = inside[1:]
    cuts = bounds[1:-1]
    before[cuts[cuts < n]] = False
    after[cuts[cuts > 0] - 1] = False
    return np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1


def placed(part: Slice, alphabet: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of the words, and the bounds of the texts among them."""
    starts, ends = runs(alphabet[part.data], part.offsets)
    return starts, ends, np.searchsorted(starts, part.offsets)


class Hasher:
    """Hashes of byte ranges of a slice, A-Z as a-z, out of prefix sums."""

    def __init__(self, part: Slice):
        n = len(part.data)
        powers, self.inverses = _power_tables(n + 1)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_FOLDED[part.data] * powers[:n], out=self.sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray, salt: int = 0) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * self.inverses[starts] + np.uint64(salt))


def words(part: Slice, alphabet: np.ndarray = SPACED) -> Words:
    starts, ends, bounds = placed(part, alphabet)
    return Words(Hasher(part).of(starts, ends), bounds)


def windows(found: Words, n: int) -> Words:
    """Hashes of n consecutive words of each text; of fewer words, of them all."""
    hashes, bounds = found
    held = np.diff(bounds)
    counts = np.where(held >= n, held - n + 1, np.minimum(held, 1))
    out_bounds = np.concatenate([[0], np.cumsum(counts)])
    at = np.repeat(bounds[:-1] - out_bounds[:-1], counts) + np.arange(out_bounds[-1])
    length = np.repeat(np.minimum(held, n), counts)
    total = np.zeros(len(at), np.uint64)
    for j in range(n):
        used = length > j
        if used.all():
            total = mix(total * np.uint64(_BASE) + hashes[at + j])
        else:
            total[used] = mix(total[used] * np.uint64(_BASE) + hashes[at[used] + j])
    return Words(total, out_bounds)


def distinct(found: Words) -> Words:
    """The distinct hashes of each text, ascending."""
    hashes, bounds = found
    parts, sizes = [], np.zeros(len(bounds), np.int64)
    for i in range(len(bounds) - 1):
        own = hashes[bounds[i] : bounds[i + 1]]
        if len(own):
            own = np.sort(own)
            own = own[np.concatenate([[True], own[1:] != own[:-1]])]
            sizes[i + 1] = len(own)
            parts.append(own)
    return Words(np.concatenate(parts) if parts else np.empty(0, np.uint64), np.cumsum(sizes))


def lists(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """An Arrow list column; values[bounds[i]:bounds[i + 1]] is row i."""
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(values.view(np.int64)))
