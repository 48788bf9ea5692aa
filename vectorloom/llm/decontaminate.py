"""Benchmark passages inside documents: SimHash of item-sized windows, multi-index Hamming search, exact check.

A benchmark item of n shingles is compared with every window of n shingles of a document (a shorter document is one window).
Shingles are five plain words (A-Z lowered; ASCII punctuation and white space separate); a shorter text has a single one. A
window's similarity to an item is the weighted Jaccard similarity of the two, a shingle's weight being how often it occurs.
Pairs of at least 0.8 are leaks.

1. Windows that share no shingle with any item have similarity 0 and get no fingerprint.
2. Every other window gets a 128-bit SimHash of its shingles, where the first, second, third... occurrence of a shingle in the window count as
   different elements of weight one. So the weighted Jaccard similarity is that of two plain sets, and no repeated
   shingle can rule the bits, however often it occurs. The items of the same size are indexed by 16 blocks of 8 bits: two
   fingerprints within ``RADIUS`` = 47 bits agree, up to two bits, in one block at least (16 blocks of three
   wrong bits would make 48), so the index returns all fingerprints within the radius. At similarity 0.8 the
   fingerprints differ in about 20 bits with a deviation of 4, so the radius is more than six deviations away.
3. What lies within the radius is checked exactly.

Items are taken in blocks of ``ITEMS`` with a bounded number of shingles, one pass over the documents for each, so what is
sent to the tasks has a fixed size. A document is handled where it was read; nothing is shuffled but found leaks.

Defined cases: null and wordless texts and items match nothing; an item given twice is found twice; of several windows of
one document and item the best counts, the first of equals; rows that share a doc_id are judged one by one; further columns are not read;
an empty table on either side gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vectorloom.llm.keys import id_of, keyed
from vectorloom.llm.words import PLAIN, mix, shingles, slices, words_of
from vectorloom.session import stored

SIZE, THRESHOLD, RADIUS = 5, 0.8, 47
ITEMS = 2048
_BLOCKS, _STEP = 16, 4096
_ONES = np.array([bin(i).count("1") for i in range(256)], np.uint8)


@dataclass
class ItemIndex:
    """Items of one block. ``sets``: sorted distinct shingles and their weights; by size: numbers, fingerprints, blocks."""

    ids: list
    sets: list
    sizes: np.ndarray
    known: np.ndarray
    of: np.ndarray
    bounds: np.ndarray
    filter: np.ndarray
    by_size: dict


def _bits(values: np.ndarray) -> np.ndarray:
    """128 columns of +1 and -1 for each shingle."""
    both = np.stack([mix(values), mix(values ^ np.uint64(0xA5A5A5A5A5A5A5A5))], axis=1)
    return np.unpackbits(both.view(np.uint8).reshape(len(values), 16), axis=1).astype(np.int32) * 2 - 1


def _ranked(values: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Bits of the ``rank``-th occurrence of each shingle in a window, from 1."""
    return _bits(values ^ mix((rank - 1).astype(np.uint64)))


def _occurrences(values: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """How often the shingle of each place occurs in the n places that begin there, and in the n places that end there."""
    kind = np.unique(values, return_inverse=True)[1].astype(np.int64)
    key = kind * (2 * (len(values) + n)) + np.arange(len(values)) + n
    order = np.argsort(key)
    key, at = key[order], np.arange(len(values))
    ahead, back = np.empty(len(values), np.int64), np.empty(len(values), np.int64)
    ahead[order] = np.searchsorted(key, key + n) - at
    back[order] = at - np.searchsorted(key, key - n, "right") + 1
    return ahead, back


def _window_sums(values: np.ndarray, n: int) -> np.ndarray:
    """Summed bits of every window of n shingles, each window's repeated shingles told apart by their rank in it."""
    first = _ranked(values[:n], _occurrences(values[:n], n)[1]).sum(0, dtype=np.int32)
    ahead, back = _occurrences(values, n)
    steps = _ranked(values[n:], back[n:])
    steps -= _ranked(values[: len(values) - n], ahead[: len(values) - n])
    return np.concatenate([first[None], first + np.cumsum(steps, axis=0, dtype=np.int32)])


def _packed(sums: np.ndarray) -> np.ndarray:
    return np.packbits(sums > 0, axis=1)


def build_index(ids: list, texts: list, size: int = SIZE) -> ItemIndex:
    words = words_of(pa.array(texts, pa.large_string()), PLAIN)
    values, owner = shingles(words.hashes(), words.bounds, size)
    sizes = np.bincount(owner, minlength=len(ids))
    cuts = np.concatenate([[0], np.cumsum(sizes)])
    sets, prints = [], np.zeros((len(ids), 16), np.uint8)
    for i in range(len(ids)):
        own = values[cuts[i] : cuts[i + 1]]
        sets.append(np.unique(own, return_counts=True))
        if len(own):
            prints[i] = _packed(_window_sums(own, len(own)))[0]
    pairs = sorted({(int(v), int(o)) for v, o in zip(values, owner)})
    flat = np.array([p[0] for p in pairs], np.uint64)
    known, at = np.unique(flat, return_index=True)
    filt = np.zeros(1 << 20, dtype=bool)
    filt[(known >> np.uint64(44)).astype(np.int64)] = True
    by_size = {}
    for n in np.unique(sizes[sizes > 0]).tolist():
        here = np.flatnonzero(sizes == n)
        distance = _ONES[np.arange(256, dtype=np.uint8)[:, None, None] ^ prints[here][None]]
        by_size[n] = (here, prints[here], np.ascontiguousarray((distance <= 2).transpose(2, 0, 1)))
    return ItemIndex(ids, sets, sizes, known, np.array([p[1] for p in pairs], np.int64), np.append(at, len(flat)), filt, by_size)


def _weighted(window: np.ndarray, item: tuple[np.ndarray, np.ndarray], n_item: int) -> float:
    own, weight = np.unique(window, return_counts=True)
    at = np.minimum(np.searchsorted(item[0], own), len(item[0]) - 1)
    common = np.minimum(weight, item[1][at])[item[0][at] == own].sum()
    return float(common / (len(window) + n_item - common))


def _best(values: np.ndarray, starts: np.ndarray, n: int, item, n_item: int, threshold: float):
    """Best window of at least the threshold among ``starts``: (similarity, start) or None."""
    inside = np.concatenate([[0], np.cumsum(np.isin(values, item[0]))])
    bound = inside[starts + n] - inside[starts]
    bound = bound / (n + n_item - bound)
    best = None
    for i in np.lexsort((starts, -bound)):
        if bound[i] < threshold - 1e-12 or best and bound[i] < best[0]:
            break
        s = _weighted(values[starts[i] : starts[i] + n], item, n_item)
        if s >= threshold - 1e-12 and (best is None or (s, -starts[i]) > (best[0], -best[1])):
            best = (s, int(starts[i]))
    return best


def document_leaks(values: np.ndarray, hits: np.ndarray, index: ItemIndex, radius: int, threshold: float) -> dict:
    """item number -> (similarity, start) for one document, given where its shingles are an item's shingle."""
    at = np.searchsorted(index.known, values[hits])
    found: dict[int, tuple] = {}
    spans: dict[int, list] = {}
    for p, k in zip(hits.tolist(), at.tolist()):
        for i in index.of[index.bounds[k] : index.bounds[k + 1]].tolist():
            spans.setdefault(int(index.sizes[i]), []).append(p)
    for size, places in spans.items():
        here, prints, near = index.by_size[size]
        n = min(size, len(values))
        places = np.unique(places)
        mark = np.zeros(len(values) + 2, np.int32)
        np.add.at(mark, np.maximum(places - n + 1, 0), 1)
        np.add.at(mark, np.minimum(places, len(values) - n) + 1, -1)
        starts = np.flatnonzero(np.cumsum(mark)[: len(values) - n + 1] > 0)
        gaps = np.flatnonzero(np.diff(starts) > n)
        for run in np.split(starts, gaps + 1):
            for lo in range(0, len(run), _STEP):
                part = run[lo : lo + _STEP]
                base = part[0]
                prints_here = _packed(_window_sums(values[base : part[-1] + n], n)[part - base])
                for j, i in enumerate(here.tolist()):
                    may = np.zeros(len(part), dtype=bool)
                    for b in range(_BLOCKS):
                        may |= near[b, prints_here[:, b], j]
                    may[may] = _ONES[prints_here[may] ^ prints[j]].sum(1) <= radius
                    if may.any():
                        best = _best(values, part[may], n, index.sets[i], size, threshold)
                        if best and (i not in found or best[0] > found[i][0]):
                            found[i] = best
    return found


def _leak_rows(held, size: int, radius: int, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index: ItemIndex = held.value
        for batch in batches:
            out: list[tuple] = []
            for piece in slices(batch):
                words = words_of(piece.column("text"), PLAIN)
                values, owner = shingles(words.hashes(), words.bounds, size)
                maybe = np.flatnonzero(index.filter[(values >> np.uint64(44)).astype(np.int64)])
                if len(maybe):
                    at = np.minimum(np.searchsorted(index.known, values[maybe]), len(index.known) - 1)
                    maybe = maybe[index.known[at] == values[maybe]]
                cuts = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=piece.num_rows))])
                for d in np.unique(owner[maybe]).tolist():
                    own = maybe[np.searchsorted(maybe, cuts[d]) : np.searchsorted(maybe, cuts[d + 1])] - cuts[d]
                    leaks = document_leaks(values[cuts[d] : cuts[d + 1]], own, index, radius, threshold)
                    key, tag = piece.column("key")[d].as_py(), piece.column("tag")[d].as_py()
                    out += [(key, tag, index.ids[i], s, start) for i, (s, start) in leaks.items()]
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.int64())
            columns = list(zip(*out)) if out else [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), k) for c, k in zip(columns, kinds)], ["key", "tag", "item_id", "similarity", "start"]
            )

    return run


def _item_blocks(items: DataFrame) -> Iterator[tuple[list, list]]:
    """The items, a bounded number at a time."""
    items = stored(items.select(F.col("item_id").cast("long").alias("i"), F.col("text").alias("t")).where("t is not null"), "items")
    facts = items.agg(F.count("*").alias("n"), F.sum(F.length("t")).alias("size")).first()
    blocks = max(1, -(-facts.n // ITEMS), -(-(facts.size or 0) // (64 * ITEMS * SIZE)))
    for b in range(blocks if facts.n else 0):
        rows = items.where(F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == b).orderBy("i", "t").collect()
        if rows:
            yield [r.i for r in rows], [r.t for r in rows]


def find_leaks(
    docs: DataFrame, items: DataFrame, size: int = SIZE, threshold: float = THRESHOLD, radius: int = RADIUS
) -> DataFrame:
    """doc_id, item_id, similarity and start (first shingle's place) of every leak, with internal key and tag."""
    spark = docs.sparkSession
    rows, found = keyed(docs), None
    schema = "key long, tag long, item_id long, similarity double, start long"
    for ids, texts in _item_blocks(items):
        held = spark.sparkContext.broadcast(build_index(ids, texts, size))
        one = rows.mapInArrow(_leak_rows(held, size, radius, threshold), schema)
        found = one if found is None else found.unionByName(one)
    if found is None:
        found = spark.createDataFrame([], schema)
    return found.select(id_of().alias("doc_id"), "item_id", "similarity", "start", "key", "tag")


def drop_leaks(docs: DataFrame, items: DataFrame, **settings) -> DataFrame:
    """The documents without a leak, with all their columns."""
    found = find_leaks(docs, items, **settings).select("key", "tag").distinct()
    marked = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("key"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("tag"),
    )
    return marked.join(found, ["key", "tag"], "left_anti").select("row.*")
