"""Text to vectors: an exchangeable encoder inside one Arrow function.

An encoder is any object with ``dim`` and ``encode(list[str]) -> ndarray``.
Pass a factory that makes one; each Python worker calls it once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence
from typing import Protocol

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

from vectorloom.config import DIMS, ENCODE_BATCH, ENCODE_BYTES, NORM_FLOOR


class Encoder(Protocol):
    dim: int

    def encode(self, texts: list[str]) -> np.ndarray: ...


class HashingEncoder:
    """Signed bag of words: the MD5 of a word names its component and sign.

    Words stand between ASCII whitespace and ASCII letters are lower-cased.
    """

    name = "hashing-bag-of-words"
    _CACHE_LIMIT = 100_000

    def __init__(self, dim: int = DIMS[0]):
        self.dim = dim
        self._slots: dict[bytes, int] = {}

    def _place(self, words: list[bytes]) -> list[int]:
        """Slots of words: the first four bytes of a digest name the component, the top bit of the fifth its sign; no word, no slot."""
        digests = np.frombuffer(b"".join([hashlib.md5(w).digest() for w in words]), dtype=np.uint8).reshape(-1, 16)
        component = digests[:, :4].copy().view(">u4")[:, 0].astype(np.int64) % self.dim
        slots = np.where(digests[:, 4] < 128, component, component + self.dim).tolist()
        return [slot if word else -1 for word, slot in zip(words, slots)]

    def encode(self, texts: list[str]) -> np.ndarray:
        """Cut in Arrow; each distinct word of the batch is hashed once, and one count adds all up."""
        if len(self._slots) > self._CACHE_LIMIT:
            self._slots.clear()
        lowered = pc.ascii_lower(pa.array(texts, pa.large_string()))
        split = pc.ascii_split_whitespace(lowered)
        words = split.flatten().dictionary_encode()
        slots = self._slots
        distinct = words.dictionary.cast(pa.large_binary()).to_numpy(zero_copy_only=False).tolist()
        fresh = [word for word in distinct if word not in slots]
        slots.update(zip(fresh, self._place(fresh)))
        named = np.fromiter(map(slots.__getitem__, distinct), dtype=np.int64, count=len(distinct))
        found = named[words.indices.to_numpy(zero_copy_only=False)]
        cells = pc.list_parent_indices(split).to_numpy() * (2 * self.dim) + found
        counts = np.bincount(cells[found >= 0], minlength=len(texts) * 2 * self.dim).reshape(len(texts), 2, self.dim)
        return (counts[:, 0] - counts[:, 1]).astype(np.float64)


def hashing_encoder(dim: int = DIMS[0]) -> Callable[[], Encoder]:
    return lambda: HashingEncoder(dim)


def unit_rows(matrix: np.ndarray) -> np.ndarray:
    lengths = np.linalg.norm(matrix, axis=1, keepdims=True)
    return matrix / np.maximum(lengths, NORM_FLOOR)


def _list_array(matrix: np.ndarray) -> pa.Array:
    rows, width = matrix.shape
    offsets = pa.array(np.arange(0, rows * width + 1, width, dtype=np.int32))
    return pa.ListArray.from_arrays(offsets, pa.array(matrix.astype(np.float32).ravel()))


def _parts(texts: pa.Array) -> Iterator[list[str]]:
    """Texts in runs of at most ``ENCODE_BATCH`` and, from the second on, ``ENCODE_BYTES``; an absent one is empty."""
    ends = np.cumsum(pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64)
    start = 0
    while start < len(texts):
        limit = ENCODE_BYTES + (ends[start - 1] if start else 0)
        stop = max(start + 1, min(start + ENCODE_BATCH, int(np.searchsorted(ends, limit, "right"))))
        yield ["" if t is None else t for t in texts.slice(start, stop - start).to_pylist()]
        start = stop


def encoder_udf(factory: Callable[[], Encoder], dims: Sequence[int] = DIMS) -> Callable[[Column], Column]:
    """Column function from text to ``struct<embedding_384, embedding_192, ..>``.

    One model call gives every size: the full vector is normalised, each
    shorter one is its head normalised again.
    """
    dims = tuple(dims)
    full = max(dims)
    fields = ", ".join(f"embedding_{d}: array<float>" for d in dims)

    @F.arrow_udf(f"struct<{fields}>")
    def embed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = factory()
        for texts in batches:
            parts = [np.asarray(encoder.encode(part), dtype=np.float64) for part in _parts(texts)]
            vectors = unit_rows(np.concatenate(parts) if parts else np.zeros((0, full)))
            if vectors.shape[1] != full:
                raise ValueError(f"encoder gives {vectors.shape[1]} components, expected {full}")
            columns = [
                _list_array(vectors if d == full else unit_rows(vectors[:, :d])) for d in dims
            ]
            yield pa.StructArray.from_arrays(columns, names=[f"embedding_{d}" for d in dims])

    return embed
