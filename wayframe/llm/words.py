"""Words of many texts at once, as numpy arrays over their UTF-8 bytes.

A word is a longest run of bytes other than ASCII white space (0x20, 0x09-0x0D), the
pattern ``[^\\x20\\x09-\\x0D]+``. Texts are taken in slices of bounded size, so that what a
task holds does not depend on the number of rows in an Arrow batch; one text longer than a
slice is a slice of its own and is still read whole. Words are named by 64-bit hashes: two
different words share one with a probability of about 2**-64.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_SYMBOLS = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_KEPT = 4 * SLICE_BYTES
_powers: list[tuple[np.ndarray, np.ndarray]] = []


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64; short tables are kept."""
    if n > _KEPT:
        return tuple(np.cumprod(np.full(n, x, np.uint64), dtype=np.uint64) for x in (_BASE, _INVERSE))
    if not _powers or len(_powers[0][0]) < n:
        size = min(_KEPT, max(n, SLICE_BYTES + (1 << 17)))
        _powers[:] = [tuple(np.cumprod(np.full(size, x, np.uint64), dtype=np.uint64) for x in (_BASE, _INVERSE))]
    return _powers[0]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread a 64-bit value over all its bits (the splitmix64 finaliser)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, silent: np.ndarray | None = None) -> np.ndarray:
    """A hash of each byte span ``data[start:end]``; ``silent`` bytes do not count."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    power, inverse = _power_tables(len(data) + 1)
    values = _SYMBOLS[data]
    if silent is not None:
        values[silent] = 0
    values *= power[: len(data)]
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(values, out=sums[1:])
    return mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


@dataclass
class Texts:
    """Some rows of a batch: their bytes, and where each text begins."""

    first: int  # row of the batch
    data: np.ndarray
    offsets: np.ndarray  # one more than texts

    def __len__(self) -> int:
        return len(self.offsets) - 1


@dataclass
class Words:
    starts: np.ndarray
    ends: np.ndarray
    doc: np.ndarray  # text of each word, ascending
    first: np.ndarray  # first word of each text, one more than texts

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[Texts]:
    """The texts of a string column in slices; null counts as empty."""
    column = column.cast(pa.large_string()).fill_null("")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    if not n:
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset: column.offset + n + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    row = 0
    while row < n:
        end = int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1
        end = min(n, max(row + 1, end))
        yield Texts(row, data[offsets[row]: offsets[end]], offsets[row: end + 1] - offsets[row])
        row = end


def words(texts: Texts, inside: np.ndarray | None = None) -> Words:
    """Where the words of each text are; ``inside`` are the bytes of words, if not all but space."""
    word = ~SPACE[texts.data] if inside is None else inside
    breaks = np.zeros(len(word) + 1, bool)
    breaks[texts.offsets] = True
    before = np.empty_like(word)
    before[:1] = False
    before[1:] = word[:-1]
    starts = np.flatnonzero(word & (~before | breaks[:-1]))
    after = np.empty_like(word)
    after[-1:] = False
    after[:-1] = word[1:]
    ends = np.flatnonzero(word & (~after | breaks[1:])) + 1
    first = np.searchsorted(starts, texts.offsets)
    doc = np.repeat(np.arange(len(texts)), np.diff(first))
    return Words(starts, ends, doc, first)


def word_hashes(texts: Texts, found: Words, lower: bool = False) -> np.ndarray:
    return span_hashes(LOWER[texts.data] if lower else texts.data, found.starts, found.ends)


def windows(hashes: np.ndarray, found: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of ``size`` words inside one text, and the run's first word."""
    if len(hashes) < size:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    at = np.flatnonzero(found.doc[: len(hashes) - size + 1] == found.doc[size - 1:])
    out = np.zeros(len(at), np.uint64)
    for k in range(size):
        out = mix(out * np.uint64(0x100000001B3) + hashes[at + k])
    return out, at


def within(values: np.ndarray, groups: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (group, value) pairs, ordered by group and value."""
    order = np.lexsort((values, groups))
    v, g = values[order], groups[order]
    keep = np.ones(len(v), bool)
    keep[1:] = (v[1:] != v[:-1]) | (g[1:] != g[:-1])
    return v[keep], g[keep]


def sums(values: np.ndarray, groups: np.ndarray, n: int) -> np.ndarray:
    """Whole-number sums per group."""
    return np.bincount(groups, weights=values, minlength=n).astype(np.int64)
