"""Words and their hashes for whole Arrow batches of texts, without a Python loop over rows.

A text is taken as UTF-8 bytes. Words are maximal runs of bytes that a table of
separators does not name. ``RAW`` separates at the six ASCII white-space
characters; ``PLAIN`` also at ASCII punctuation and control characters and lowers A-Z, so copies
that differ in case or punctuation give the same words. A null text has no words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa

#: Texts of one slice have this many bytes together, or are one single text.
SLICE_BYTES = 2 << 20
_SEED = 0x5EED
_MASK = (1 << 64) - 1
_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)


def _raw_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[[0x20, *range(0x09, 0x0E)]] = 0
    return table


def _plain_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    for code in range(128):
        table[code] = ord(chr(code).lower()) if chr(code).isalnum() else 0
    return table


#: Byte to byte; 0 separates. A zero byte in a text is a word character of RAW; it takes the free code of the blank.
RAW, PLAIN = _raw_table(), _plain_table()
RAW[0] = 0x20


def mix(x: np.ndarray) -> np.ndarray:
    """Finish a 64-bit hash: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@cache
def _letters(lane: int) -> np.ndarray:
    return np.random.default_rng(_SEED + lane).integers(1, 1 << 63, 256, dtype=np.uint64)


_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(n: int, lane: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """base^0..base^(n-1) and their inverses modulo 2^64."""
    held = _powers.get(lane)
    if held is None or len(held[0]) < n:
        size = max(n, 1 << 12)
        base, inverse = _BASES[lane], pow(_BASES[lane], -1, 1 << 64)
        made = []
        for b in (base, inverse):
            p = np.full(size, b, dtype=np.uint64)
            p[0] = 1
            made.append(np.cumprod(p, dtype=np.uint64))
        held = (made[0], made[1])
        if n <= 4 * SLICE_BYTES:  # a single huge text does not stay in memory
            _powers[lane] = held
    return held


def rolling(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, lane: int = 0) -> np.ndarray:
    """Hash of values[start:end] for many ranges: polynomial prefix sums modulo 2^64."""
    up, down = powers(len(values) + 1, lane)
    sums = np.empty(len(values) + 1, dtype=np.uint64)
    sums[0] = 0
    np.cumsum(values * up[: len(values)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts one after the other, and where each begins and ends."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    if not len(texts):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, where, data = texts.buffers()
    offsets = np.frombuffer(where, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.empty(0, np.uint8)
    return raw, offsets - offsets[0]


@dataclass
class Words:
    """Words of a slice: text i has words bounds[i]:bounds[i+1]; start and end are byte places."""

    data: np.ndarray
    offsets: np.ndarray
    start: np.ndarray
    end: np.ndarray
    bounds: np.ndarray

    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.bounds) - 1), self.counts())

    def hashes(self, lane: int = 0) -> np.ndarray:
        return rolling(_letters(lane)[self.data], self.start, self.end, lane)


def words_of(texts: pa.Array, table: np.ndarray = RAW) -> Words:
    raw, offsets = buffers(texts)
    data = table[raw]
    inside = data != 0
    cut = np.zeros(len(data) + 1, dtype=bool)
    cut[offsets] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | cut[1:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | cut[1:-1]
    start = np.flatnonzero(begins)
    return Words(data, offsets, start, np.flatnonzero(ends) + 1, np.searchsorted(start, offsets))


def slices(batch: pa.RecordBatch, column: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that the texts of a piece stay below ``most`` bytes; a longer text is a piece of its own."""
    _, offsets = buffers(batch.column(column))
    at, n = 0, batch.num_rows
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1)
        yield batch.slice(at, to - at)
        at = to


def shingles(hashes: np.ndarray, bounds: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every run of ``size`` words inside one text, and the text's index.

    A text of fewer words, but at least one, has a single shingle of all its words.
    """
    counts = np.diff(bounds)
    made = np.where(counts >= size, counts - size + 1, (counts > 0).astype(counts.dtype))
    owner = np.repeat(np.arange(len(counts)), made)
    begin = np.repeat(bounds[:-1], made) + np.arange(made.sum()) - np.repeat(np.cumsum(made) - made, made)
    return rolling(hashes, begin, np.minimum(begin + size, bounds[1:][owner])), owner


def distinct_pairs(owner: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (owner, value) pairs, sorted; owners must be in rising order."""
    order = np.lexsort((values, owner))
    owner, values = owner[order], values[order]
    new = np.ones(len(owner), dtype=bool)
    new[1:] = (owner[1:] != owner[:-1]) | (values[1:] != values[:-1])
    return owner[new], values[new]


def signed(x: np.ndarray) -> np.ndarray:
    """Unsigned hashes as Spark's long."""
    return x.view(np.int64)


def lists(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    """Array column from flat values and the number of values of each row."""
    offsets = np.zeros(len(counts) + 1, dtype=np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, type=kind))
