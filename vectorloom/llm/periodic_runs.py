"""Periodic runs of words by recompression: a run-length grammar answers how far two places agree.

A run is a stretch of words with smallest period q (words q apart are identical) and at least ``max(LEAST, TIMES * q)`` words that no
neighbouring word extends keeping period q.

1. Candidates: a run of period p has at least ``m = max(LEAST - p, (TIMES - 1) * p)`` places whose word is that p places on. On a grid of step m / 2
   one grid point at least has a whole step of them behind it. So for each p the grid points are probed at a few places of their step; what
   fails one cannot be that point. The grids of all p are harmonic: n / 1 + n / 2 + n / 3 + ... points.
2. Recompression: the words of the documents with candidates are rewritten level by level, alternately blocks of a repeated
   symbol (symbol, length) and pairs over a split of the alphabet (left, right), until each document is one symbol. Equal factors are
   parsed alike but at their ends, so two places are compared by climbing while both stand at the edge of a symbol
   and descending where symbols differ: a few steps for each level, in both directions, for all candidates at once.
3. A candidate's exact extensions to both sides give its stretch. Stretches found with several periods keep the smallest, which
   divides the others, as a stretch of three periods has no two that do not share it.

A document is handled where it was read; nothing is shuffled. Words are ``[^\\x20\\x09-\\x0D]+``, compared in full.

Defined cases: a null or empty text has no words, no runs and an empty collapsed text; rows are handled one by one, so repeated rows give equal results and a
null id is an id like any other; a very long text is one unit of work, whose room is some hundred bytes a word; columns other than id and text are not
read; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vectorloom.llm.words import RAW, buffers, mix, slices, words_of

LEAST, TIMES = 24, 3
#: Grid points that are probed, and places that are compared, at a time.
CHUNK = 1 << 20
_SPLITS = 4
RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"


@dataclass
class Level:
    """Symbols of one level; the first and last symbol of the level below that each stands for; what each is part of above."""

    symbol: np.ndarray
    first: np.ndarray | None
    last: np.ndarray | None
    blocks: bool
    up: np.ndarray | None = None


def _raised(level: Level, head: np.ndarray, size: np.ndarray, made: np.ndarray, blocks: bool) -> Level:
    first = np.flatnonzero(head).astype(np.int32)
    level.up = (np.cumsum(head) - 1).astype(np.int32)
    return Level(made, first, (first + size - 1).astype(np.int32), blocks)


def _named(symbol: np.ndarray, joint: np.ndarray, code: np.ndarray, fresh: int) -> tuple[np.ndarray, int]:
    """``symbol`` with a new name for each distinct code at the places ``joint``."""
    kinds, which = np.unique(code, return_inverse=True)
    symbol = symbol.copy()
    symbol[joint] = fresh + which
    return symbol, fresh + len(kinds)


def grammar(symbol: np.ndarray, marks: np.ndarray, fresh: int) -> list[Level]:
    """Levels above a sequence in which each place of ``marks`` holds a symbol of its own; the first and the last place are marks.

    Symbols are below ``fresh``. Marks are never joined with anything.
    """
    levels, bound, split = [Level(symbol.astype(np.int64), None, None, False)], np.sort(symbol[marks]), 0
    while len(levels[-1].symbol) > len(marks) + np.count_nonzero(np.diff(marks) > 1):
        here = levels[-1]
        s = here.symbol
        head = np.append(True, s[1:] != s[:-1])
        if not head.all():
            begin = np.flatnonzero(head)
            size = np.diff(np.append(begin, len(s)))
            joint = np.flatnonzero(size > 1)
            made, fresh = _named(s[begin], joint, s[begin][joint] * len(s) + size[joint], fresh)
            levels.append(_raised(here, head, size, made, True))
            here, s = levels[-1], made
        free = ~np.isin(s, bound)
        best = None
        for split in range(split + 1, split + 1 + _SPLITS):
            left = (mix(s.astype(np.uint64) + mix(np.array([split], np.uint64))) & np.uint64(1)).astype(bool)
            pair = np.flatnonzero((left & free)[:-1] & (~left & free)[1:])
            if best is None or len(pair) > len(best):
                best = pair
        if not len(best):
            continue
        head = np.ones(len(s), dtype=bool)
        head[best + 1] = False
        begin = np.flatnonzero(head)
        size = np.diff(np.append(begin, len(s)))
        made, fresh = _named(s[begin], np.flatnonzero(size > 1), s[best] * fresh + s[best + 1], fresh)
        levels.append(_raised(here, head, size, made, False))
    return levels


def extend(levels: list[Level], i: np.ndarray, j: np.ndarray, step: int) -> np.ndarray:
    """How many places agree from i and from j on (i != j, both in one document), forwards (``step`` 1) or backwards (-1)."""
    at_i, at_j = i.astype(np.int64), j.astype(np.int64)
    height, live = np.zeros(len(i), np.int64), np.arange(len(i))

    def rest(level: Level, parent: np.ndarray, at: np.ndarray) -> np.ndarray:
        return level.last[parent] - at + 1 if step > 0 else at - level.first[parent] + 1

    for h, level in enumerate(levels):
        a, b = at_i[live], at_j[live]
        same = level.symbol[a] == level.symbol[b]
        height[live[~same]] = h
        live, a, b = live[same], a[same], b[same]
        if not len(live):
            break
        above = levels[h + 1]
        edge = above.first if step > 0 else above.last
        pa_, pb = level.up[a], level.up[b]
        # Not both at the edge of what they are part of: equal symbols agree to the nearer end of it.
        inside = (edge[pa_] != a) | (edge[pb] != b)
        ra, rb = rest(above, pa_, a), rest(above, pb, b)
        on = step * np.where(inside, np.minimum(ra, rb), 0)
        a, b = a + on, b + on
        stops = inside & (ra != rb)
        at_i[live], at_j[live] = np.where(stops, a, level.up[a]), np.where(stops, b, level.up[b])
        height[live[stops]] = h
        live = live[~stops]
    for h in range(int(height.max(initial=0)), 0, -1):
        level, below = levels[h], levels[h - 1]
        edge = level.first if step > 0 else level.last
        lower = np.flatnonzero(height >= h)
        pa_, pb = at_i[lower], at_j[lower]
        a, b = edge[pa_].astype(np.int64), edge[pb].astype(np.int64)
        on = (below.symbol[a] == below.symbol[b]).astype(np.int64)
        if level.blocks:
            on *= np.minimum(rest(level, pa_, a), rest(level, pb, b))
        at_i[lower], at_j[lower] = a + step * on, b + step * on
    return (at_i - i) * step


def _codes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A number for each word, the same for the same word, and where each text's words begin and end."""
    words = words_of(texts, RAW)
    offsets = np.concatenate([[0], np.cumsum(words.end - words.start)])
    data = np.ascontiguousarray(words.data[words.data != 0])
    column = pa.Array.from_buffers(pa.large_binary(), len(words.start), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data)])
    return column.dictionary_encode().indices.to_numpy().astype(np.int32), words.bounds


def grid(codes: np.ndarray, bounds: np.ndarray, least: int, times: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Grid points (place, period) that pass the probes, some at a time."""
    sizes = np.diff(bounds)
    most = np.where(sizes >= least, sizes // times, 0)
    base, n = np.repeat(bounds[:-1], most), np.repeat(sizes, most)
    period = np.arange(most.sum()) - np.repeat(np.cumsum(most) - most, most) + 1
    step = np.maximum(1, np.maximum(least - period, (times - 1) * period) // 2)
    count = np.maximum((n - period - step) // step + 1, 0)
    ends, done = np.cumsum(count), 0
    lo = 0
    while lo < len(period):
        hi = max(lo + 1, int(np.searchsorted(ends, done + CHUNK, "right")))
        which = np.repeat(np.arange(lo, hi), count[lo:hi])
        place = base[which] + (np.arange(len(which)) + done - (ends - count)[which]) * step[which]
        for probe in (lambda s: 0, lambda s: s - 1, lambda s: s // 2, lambda s: s // 4):
            there = place + probe(step[which])
            same = codes[there] == codes[there + period[which]]
            place, which = place[same], which[same]
        if len(place):
            yield place, period[which]
        lo, done = hi, int(ends[hi - 1])


def runs_of(codes: np.ndarray, bounds: np.ndarray, least: int = LEAST, times: int = TIMES) -> np.ndarray:
    """Rows (document, start, length, period) of all runs, sorted; document i is codes[bounds[i]:bounds[i+1]]."""
    found = list(grid(codes, bounds, least, times))
    if not found:
        return np.empty((0, 4), np.int64)
    # Only documents with candidates, with a mark of its own before, between and behind them.
    owner = [np.searchsorted(bounds, place, "right") - 1 for place, _ in found]
    docs = np.unique(np.concatenate(owner))
    sizes = np.diff(bounds)[docs]
    begin = np.cumsum(sizes) - sizes + np.arange(len(docs)) + 1
    marks = np.append(begin - 1, begin[-1] + sizes[-1])
    top = int(codes.max()) + 1
    padded = np.empty(int(marks[-1]) + 1, np.int64)
    padded[marks] = top + np.arange(len(marks))
    shift = begin - bounds[docs]
    padded[np.arange(sizes.sum()) + np.repeat(np.arange(len(docs)) + 1, sizes)] = codes[
        np.arange(sizes.sum()) + np.repeat(bounds[docs] - (np.cumsum(sizes) - sizes), sizes)
    ]
    levels = grammar(padded, marks, top + len(marks))
    rows = []
    for (place, period), whose in zip(found, owner):
        i = place + shift[np.searchsorted(docs, whose)]
        back, on = extend(levels, i - 1, i + period - 1, -1), extend(levels, i, i + period, 1)
        length = back + period + on
        good = length >= np.maximum(least, times * period)
        rows.append(np.unique(np.stack([whose, place - back - bounds[whose], length, period], 1)[good], axis=0))
    rows = np.unique(np.concatenate(rows), axis=0)
    again = np.zeros(len(rows), dtype=bool)
    again[1:] = (rows[1:, :3] == rows[:-1, :3]).all(1)
    rows = rows[~again]  # of equal stretches the smallest period
    return rows[np.lexsort((rows[:, 3], rows[:, 1], rows[:, 0]))]


def _run_rows(rewrite, least: int, times: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch):
                codes, bounds = _codes(piece.column("text"))
                raw, offsets = buffers(piece.column("text"))
                whole, ids, takes = raw.tobytes(), piece.column("doc_id").to_pylist(), {}
                if rewrite is not None:
                    for d, key in enumerate(ids):
                        take = rewrite(key, int(bounds[d + 1] - bounds[d]))
                        if take is not None:
                            takes[d], codes[bounds[d] : bounds[d + 1]] = take, codes[bounds[d] : bounds[d + 1]][take]
                rows = runs_of(codes, bounds, least, times)
                cuts = np.searchsorted(rows[:, 0], np.arange(piece.num_rows + 1))
                texts = []
                for d in range(piece.num_rows):
                    words = whole[offsets[d] : offsets[d + 1]].split()
                    if d in takes:
                        words = [words[k] for k in takes[d].tolist()]
                    own = rows[cuts[d] : cuts[d + 1]]
                    if len(own):
                        gone = np.zeros(len(words) + 1, np.int64)
                        np.add.at(gone, own[:, 1] + own[:, 3], 1)
                        np.add.at(gone, own[:, 1] + own[:, 2], -1)
                        words = [w for w, g in zip(words, np.cumsum(gone).tolist()) if not g]
                    texts.append(b" ".join(words))
                struct = pa.StructArray.from_arrays([pa.array(rows[:, c].copy(), pa.int64()) for c in (1, 2, 3)], ["start", "length", "period"])
                yield pa.RecordBatch.from_arrays(
                    [piece.column("doc_id"), pa.array(np.diff(bounds), pa.int64()), pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), struct),
                     pa.array(texts, pa.binary()).cast(pa.string())],
                    ["doc_id", "n_words", "runs", "collapsed"],
                )

    return run


def find_runs(
    docs: DataFrame, least: int = LEAST, times: int = TIMES, rewrite: Callable[[int | None, int], np.ndarray | None] | None = None
) -> DataFrame:
    """Per document: doc_id, n_words, runs (start, length, period; by start, then period) and collapsed, the words joined by one blank without
    those that a run repeats after its first period. ``rewrite`` may give, for an id and its number of words, the numbers of the words to look at instead.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(_run_rows(rewrite, least, times), f"doc_id long, n_words long, runs {RUNS}, collapsed string")


def strongest(runs: str = "runs"):
    """The run of greatest length / period, compared exactly; of equals the first."""
    return F.expr(
        f"aggregate({runs}, cast(null as struct<start: bigint, length: bigint, period: bigint>), "
        "(b, r) -> if(b is null or r.length * b.period > b.length * r.period, r, b))"
    )
