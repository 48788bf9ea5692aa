"""Sampled SentencePiece segmentations: forward filtering, backward sampling over the piece lattice; lossless decoding.

A text becomes bytes with a blank in front (the model's dummy prefix) and every blank as the model's mark. No piece has a mark behind another
sign, and none holds a line feed, so the lattice falls apart before each run of marks and around each line feed; the segments between are
independent and each distinct one of a slice is filtered once.

Forward filtering gives each place of a segment the log of the summed weight of all ways to reach it. Backward sampling starts at the end
and draws the piece that ends there in proportion to (weight up to its start) x (weight of the piece); so a segmentation comes with
exactly its share of the total weight. Pieces are looked up by hashes that grow byte by byte, only as far as some piece begins so. The random numbers are a hash of seed, row key, number of the segment and step: the same row gives the
same pieces wherever and however often it is computed.

Weights are the model's scores where they are log-probabilities; a merge-ordered model has ranks instead, whose weight is 1 / (rank + 10), raised to
``theta``. A sign without a piece is written in the model's byte pieces, as is a literal mark sign. Decoding gives the bytes back exactly.

The vocabulary (a file of fixed size, its path a parameter) is read once by the driver and sent to the tasks.

``round_trip`` encodes and decodes in one pass, so a text goes to a Python worker once. What a worker holds beside the slice at hand is bounded in bytes.

Defined cases: a null text has null ids, an empty one no ids; a null key is a key of its own; repeated rows get the same ids; of pieces
equally likely each has its equal share; a very long text is one slice, whose lattice takes some hundred bytes for each of its own; other columns stay as they are, except
that a column of the name of a result is replaced by it; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from vectorloom.llm.keys import NULL_ID
from vectorloom.llm.words import buffers, lists, mix, rolling, slices

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
THETA, SEED = 1.0, 11
#: A lattice takes some hundred times the room of its text, so texts go in smaller slices.
SLICE_BYTES = 1 << 19
#: Bytes of segments a worker keeps filtered from slice to slice.
STORED = 1 << 18
_MARK = 0xFF  # stands for a blank; no UTF-8 text has this byte
_END = 0xFE  # closes a segment; no UTF-8 text and no piece has this byte
_GOLD = np.uint64(0x9E3779B97F4A7C15)
_BASE = np.uint64(0xD6E8FEB86659FD93)
_GRID = 1 << 30  # shares are compared on this grid, exactly
_SLOT = np.uint64(46)  # of a hash the bits above this one are its slot
_PIECE, _MORE = 1, 2  # what is in a slot: a piece, a beginning of a longer one
_BYTES = np.arange(256)
_WIDTH = np.select([_BYTES == _MARK, _BYTES < 0x80, _BYTES < 0xE0, _BYTES < 0xF0], [1, 1, 2, 3], 4)
_LEAD = ((_BYTES & 0xC0) != 0x80) & (_BYTES != _END)


@dataclass
class Vocabulary:
    """Pieces by their sorted hashes, log weights, longest length; ids of these and then of the bytes; all bytes for decoding.

    ``kinds`` says what is in a slot, ``heads`` gives the first hash in it.
    """

    hashes: np.ndarray
    ids: np.ndarray
    weights: np.ndarray
    longest: int
    byte_ids: np.ndarray
    flat: np.ndarray
    bounds: np.ndarray
    kinds: np.ndarray
    heads: np.ndarray
    store: "Store | None" = None


def _hash(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return rolling(data.astype(np.uint64) + np.uint64(1), start, end)


def _further(h: np.ndarray, byte: np.ndarray) -> np.ndarray:
    """Hashes of ranges that have grown by a byte."""
    h = (h + byte + np.uint64(1)) * _BASE
    return h ^ (h >> np.uint64(31))


def _slot(h: np.ndarray) -> np.ndarray:
    return (h >> _SLOT).view(np.int64)


def load_vocabulary(path: str = MODEL, theta: float = THETA) -> Vocabulary:
    import sentencepiece  # by the driver alone; the tasks need the pieces only

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    n = model.get_piece_size()
    normal = [i for i in range(n) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
    made = [b""] * n
    for i in normal:
        made[i] = model.id_to_piece(i).replace("▁", "\0").encode().replace(b"\0", bytes([_MARK]))
        if bytes([_MARK]) in made[i].lstrip(bytes([_MARK])) or b"\n" in made[i]:
            raise ValueError(f"piece {i} crosses a word boundary")
    byte_ids = np.full(256, -1)
    for i in range(n):
        if model.is_byte(i):
            value = int(model.id_to_piece(i)[1:-1], 16)
            byte_ids[value], made[i] = i, bytes([value])
    if (byte_ids < 0).any():
        raise ValueError("the model has no byte pieces, so not every text can be written")
    scores = np.array([model.get_score(i) for i in normal])
    logs = scores if scores.min() > -100 else -np.log(-scores + 10)
    sizes = np.array([len(b) for b in made])
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    flat = np.frombuffer(b"".join(made), np.uint8)
    kinds, heads = np.zeros(1 << 18, np.uint8), np.zeros(1 << 18, np.int32)
    begin, size = bounds[:-1][normal], sizes[normal]
    hashes = np.zeros(len(normal), np.uint64)
    for k in range(int(size.max())):
        live = np.flatnonzero(size > k)
        hashes[live] = _further(hashes[live], flat[begin[live] + k])
        kinds[_slot(hashes[size > k + 1])] |= _MORE
    kinds[_slot(hashes)] |= _PIECE
    order = np.argsort(hashes)
    hashes = hashes[order]
    heads[_slot(hashes[::-1])] = np.arange(len(hashes))[::-1]  # the first of a slot is written last
    ids = np.concatenate([np.array(normal)[order], byte_ids]).astype(np.int32)
    weights = np.concatenate([theta * logs[order], np.full(256, theta * (logs.min() - 1.0))])
    return Vocabulary(hashes, ids, weights, int(size.max()), byte_ids, flat, bounds, kinds, heads)


def _edges(v: Vocabulary, text: np.ndarray):
    """All pieces in the segments: start, end, number, and how many shorter ones have that end; also how many have each end.

    ``text`` has _END behind each segment and no less than a longest piece of it at the end.
    """
    met = np.zeros(len(text) + 1, np.int64)
    found = []

    def note(start, stop, piece):
        found.append((start, stop, piece, met[stop]))
        met[stop] += 1  # these ends are all different

    lead = _LEAD[text]
    live = np.flatnonzero(lead)
    spelled = lead.copy()  # signs without a piece of their own
    h = np.zeros(len(live), np.uint64)
    for n in range(1, v.longest + 1):
        if not len(live):
            break
        h = _further(h, text[live + (n - 1)])
        slot = _slot(h)
        kind = v.kinds[slot]
        hit = np.flatnonzero(kind & _PIECE)
        own = h[hit]
        at = v.heads[slot[hit]].astype(np.int64)
        good = v.hashes[at] == own
        rest = np.flatnonzero(~good)  # other ranges, and pieces that are not the first of their slot
        at[rest] = np.minimum(np.searchsorted(v.hashes, own[rest]), len(v.hashes) - 1)
        good[rest] = v.hashes[at[rest]] == own[rest]
        begin, at = live[hit[good]], at[good]
        note(begin, begin + n, at)
        if n <= 4:
            spelled[begin[_WIDTH[text[begin]] == n]] = False
        more = np.flatnonzero(kind & _MORE)
        live, h = live[more], h[more]
    # Signs without a piece of their own are written byte by byte.
    if spelled.any():
        place = np.arange(len(text))
        at = np.flatnonzero(spelled[np.maximum.accumulate(np.where(lead, place, 0))] & (text != _END))
        note(at, at + 1, len(v.hashes) + np.where(text[at] == _MARK, 0x20, text[at]).astype(np.int64))
    if not found:
        return *[np.empty(0, np.int64)] * 4, met
    return *(np.concatenate(x) for x in zip(*found)), met


@dataclass
class Lattice:
    """Per node (a place of a segment), its incoming pieces with running probabilities. The nodes go by their distance from the segment's start.

    Those of node i are first[i]:first[i+1], from short to long; ``ends`` has the last node of each segment, the first ones are the nodes below ``roots``.
    """

    upto: np.ndarray  # share of the node's pieces so far, on the grid
    first: np.ndarray
    source: np.ndarray
    ids: np.ndarray
    ends: np.ndarray
    roots: int


def forward(v: Vocabulary, data: np.ndarray, bounds: np.ndarray) -> Lattice:
    """Filter all segments at once, by distance from the segment's start; segment i is data[bounds[i]:bounds[i+1]]."""
    sizes = np.diff(bounds)
    nodes = len(data) + len(sizes)  # a segment of n bytes has n + 1 nodes
    begin = bounds[:-1] + np.arange(len(sizes))
    text = np.full(nodes + v.longest, _END, np.uint8)
    inside = np.ones(nodes, dtype=bool)
    inside[begin + sizes] = False
    text[:nodes][inside] = data
    start, stop, piece, rank, met = _edges(v, text)
    # Nodes of one distance are next to each other, those of longer segments first.
    order = np.argsort(-sizes, kind="stable")
    far = int(sizes.max(initial=0))
    base = np.concatenate([[0], np.cumsum(np.searchsorted(-sizes[order], -np.arange(far + 1), "right"))])
    line = np.empty(len(sizes), np.int64)
    line[order] = np.arange(len(sizes))
    node = base[np.arange(nodes) - np.repeat(begin, sizes + 1)] + np.repeat(line, sizes + 1)
    count = np.empty(nodes, np.int64)
    count[node] = met[:nodes]
    first = np.concatenate([[0], np.cumsum(count)])
    at = first[node[stop]] + rank
    source, which = np.empty(len(at), np.int64), np.empty(len(at), np.int64)
    source[at], which[at] = node[start], piece
    weight = v.weights[which]
    total = np.full(nodes, -np.inf)
    total[: len(sizes)] = 0.0
    chance = np.empty(len(at))
    for a, b in zip(base[1:-1], base[2:]):
        lo, hi = first[a], first[b]
        if lo == hi:
            continue
        met = a + np.flatnonzero(count[a:b])  # a place inside a sign may have none
        head, n = first[met] - lo, count[met]
        value = total[source[lo:hi]] + weight[lo:hi]
        top = np.maximum.reduceat(value, head)
        share = np.exp(value - np.repeat(top, n))
        norm = np.add.reduceat(share, head)
        total[met] = top + np.log(norm)
        chance[lo:hi] = share / np.repeat(norm, n)
    # Running share within a node, one place at a time, so it does not depend on what else is in the slice.
    many, place = np.flatnonzero(count > 1), 1
    while len(many):
        at = first[many] + place
        chance[at] += chance[at - 1]
        place += 1
        many = many[count[many] > place]
    upto = np.floor(chance * _GRID).astype(np.int32)
    upto[first[1:][count > 0] - 1] = _GRID
    return Lattice(upto, first, source, v.ids[which], base[sizes] + line, len(sizes))


def backward(lattice: Lattice, segment: np.ndarray, seeds: np.ndarray, who: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Draw a segmentation for each occurrence of a segment, from its end to its start: in each step whose piece it is, and its id."""
    node, drawn = lattice.ends[segment], []
    while len(who):
        u = (mix(seeds) >> np.uint64(34)).astype(np.int32)
        edge = lattice.first[node]
        past = np.flatnonzero(lattice.upto[edge] <= u)
        while len(past):  # the last piece of a node has the whole grid below it
            edge[past] += 1
            past = past[lattice.upto[edge[past]] <= u[past]]
        drawn.append((who, lattice.ids[edge]))
        node = lattice.source[edge]
        on = np.flatnonzero(node >= lattice.roots)
        node, seeds, who = node[on], seeds[on] + _GOLD, who[on]
    return drawn


def _segments(texts: pa.Array):
    """Bytes of all texts with their prefix, the segments' starts and ends, and the text of each."""
    raw, offsets = buffers(texts)
    sizes = np.diff(offsets)
    some = sizes > 0
    new = np.concatenate([[0], np.cumsum(sizes + some)])
    data = np.full(new[-1], _MARK, np.uint8)
    keep = np.ones(len(data), dtype=bool)
    keep[new[:-1][some]] = False
    data[keep] = np.where(raw == 0x20, _MARK, raw)
    mark, feed = data == _MARK, data == 0x0A
    begins = mark.copy()
    begins[1:] &= ~mark[:-1]
    begins |= feed
    begins[1:] |= feed[:-1]
    begins[new[:-1][some]] = True
    start = np.flatnonzero(begins)
    end = np.append(start[1:], len(data)) if len(start) else start
    owner = np.searchsorted(new, start, "right") - 1
    return data, start, end, owner


@dataclass
class Store:
    """Segments that came more than once, filtered, and new ones that wait to join them."""

    hashes: np.ndarray
    data: np.ndarray
    bounds: np.ndarray
    lattice: Lattice | None
    waiting: list

    def find(self, h: np.ndarray) -> np.ndarray:
        """Number of each segment, -1 if it is not here."""
        if not len(self.hashes):
            return np.full(len(h), -1)
        at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        return np.where(self.hashes[at] == h, at, -1)

    def take(self, v: Vocabulary, h: np.ndarray, data: np.ndarray, bounds: np.ndarray) -> None:
        """Note new segments; filter all anew when enough of them wait."""
        if len(self.data) >= STORED:
            return
        self.waiting.append((h, data, bounds))
        if sum(len(w[0]) for w in self.waiting) * 2 < len(self.hashes):
            return
        parts = [(self.hashes, self.data, self.bounds), *self.waiting]
        h = np.concatenate([p[0] for p in parts])
        data = np.concatenate([p[1] for p in parts])
        sizes = np.concatenate([np.diff(p[2]) for p in parts])
        start = np.cumsum(sizes) - sizes
        self.hashes, first = np.unique(h, return_index=True)
        self.data, self.bounds = _gather(data, start[first], sizes[first])
        self.lattice, self.waiting = forward(v, self.data, self.bounds), []


def _gather(data: np.ndarray, start: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    return data[np.repeat(start - bounds[:-1], sizes) + np.arange(bounds[-1])], bounds


def encode_slice(v: Vocabulary, texts: pa.Array, keys: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts one after the other, and their number per text."""
    data, start, end, owner = _segments(texts)
    if not len(start):
        return np.empty(0, np.int32), np.zeros(len(texts), np.int64)
    h, first, which, times = np.unique(_hash(data, start, end), return_index=True, return_inverse=True, return_counts=True)
    number = np.arange(len(start)) - np.searchsorted(owner, owner)
    row = mix(keys.view(np.uint64) ^ mix(np.array([seed], np.uint64)))
    seeds = mix(row[owner] + number.astype(np.uint64) * _GOLD)
    if v.store is None:
        v.store = Store(np.empty(0, np.uint64), np.empty(0, np.uint8), np.zeros(1, np.int64), None, [])
    kept = v.store.find(h)
    new = np.flatnonzero(kept < 0)
    own, bounds = _gather(data, start[first[new]], (end - start)[first[new]])
    place = np.where(kept >= 0, kept, 0)
    place[new] = np.arange(len(new))
    counts, drawn = np.zeros(len(start), np.int64), []
    for known in (True, False):
        mine = np.flatnonzero((kept >= 0)[which] == known)
        if len(mine):
            lattice = v.store.lattice if known else forward(v, own, bounds)
            steps = backward(lattice, place[which[mine]], seeds[mine], mine)
            for who, _ in steps:
                counts[who] += 1
            drawn += steps
    ids, last = np.empty(int(counts.sum()), np.int32), np.cumsum(counts)
    for who, part in drawn:
        last[who] -= 1
        ids[last[who]] = part
    again = np.flatnonzero(times[new] > 1)
    v.store.take(v, h[new[again]], *_gather(own, bounds[again], np.diff(bounds)[again]))
    return ids, np.bincount(owner, weights=counts, minlength=len(texts)).astype(np.int64)


def _ids_of(v: Vocabulary, key: pa.Array, text: pa.Array, seed: int) -> pa.Array:
    ids, counts = encode_slice(v, text, key.to_numpy(), seed)
    found = lists(ids, counts, pa.int32())
    return pc.if_else(text.is_valid(), found, pa.scalar(None, found.type)) if text.null_count else found


def _encoded(held, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = held.value
        for batch in batches:
            for piece in slices(batch, "__text", SLICE_BYTES):
                found = _ids_of(v, piece.column("__key"), piece.column("__text"), seed)
                yield pa.RecordBatch.from_arrays([piece.column("__row"), found], ["__row", "ids"])

    return run


def _struct(docs: DataFrame, *without: str):
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns if c not in without] or [F.lit(None).cast("int").alias("__none")]).alias("__row")


def _schema(rows: DataFrame, more: str) -> StructType:
    """The carried columns, whatever their names, and further ones."""
    return StructType([StructField("__row", rows.schema["__row"].dataType), *StructType.fromDDL(more)])


def _keyed(docs: DataFrame, key_col: str, text_col: str, *without: str) -> DataFrame:
    return docs.select(
        _struct(docs, *without), F.coalesce(F.col(key_col).cast("long"), F.lit(NULL_ID)).alias("__key"), F.col(text_col).alias("__text")
    )


def encode_texts(
    docs: DataFrame, path: str = MODEL, theta: float = THETA, seed: int = SEED, key_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """All columns of the input, and ``ids``: a sampled segmentation of the text, fixed by seed and key."""
    held = docs.sparkSession.sparkContext.broadcast(load_vocabulary(path, theta))
    rows = _keyed(docs, key_col, text_col, "ids")
    schema = _schema(rows, "ids array<int>")
    return rows.mapInArrow(_encoded(held, seed), schema).select("__row.*", "ids")


@dataclass
class _Spelling:
    """What each id stands for: marks are blanks, a byte piece is its byte."""

    flat: np.ndarray
    begin: np.ndarray
    size: np.ndarray

    @staticmethod
    def of(v: Vocabulary) -> "_Spelling":
        flat = np.where(v.flat == _MARK, 0x20, v.flat).astype(np.uint8)
        flat[v.bounds[v.byte_ids]] = np.arange(256)
        return _Spelling(flat, v.bounds, np.diff(v.bounds))

    def decode(self, column: pa.Array) -> pa.Array:
        """Texts of lists of ids."""
        ids = column.flatten().to_numpy(zero_copy_only=False)
        n = column.value_lengths().fill_null(0).to_numpy()
        size = self.size[ids]
        ends = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
        out = self.flat[np.repeat(self.begin[ids] - ends[:-1], size) + np.arange(ends[-1])] if len(ids) else np.empty(0, np.uint8)
        stop = ends[np.cumsum(n)]
        start = np.concatenate([[0], stop[:-1]]) + (n > 0)  # without the prefix
        raw = out.tobytes()
        return pa.array([None if bad else raw[a:b].decode() for a, b, bad in zip(start, stop, column.is_null().to_pylist())], pa.string())


def _decoded(held):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spelling = _Spelling.of(held.value)
        for whole in batches:
            for lo in range(0, whole.num_rows, 512):
                batch = whole.slice(lo, 512)
                yield pa.RecordBatch.from_arrays([batch.column("__row"), spelling.decode(batch.column("ids"))], ["__row", "decoded"])

    return run


def decode_ids(frame: DataFrame, path: str = MODEL) -> DataFrame:
    """All columns of the input, and ``decoded``: the text that ``ids`` stand for."""
    held = frame.sparkSession.sparkContext.broadcast(load_vocabulary(path))
    rows = frame.select(_struct(frame, "decoded"), "ids")
    schema = _schema(rows, "decoded string")
    return rows.mapInArrow(_decoded(held), schema).select("__row.*", "decoded")


def _round(held, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = held.value
        spelling = _Spelling.of(v)
        for batch in batches:
            for piece in slices(batch, "__text", SLICE_BYTES):
                text = piece.column("__text")
                ids = _ids_of(v, piece.column("__key"), text, seed)
                decoded = spelling.decode(ids)
                same = pc.fill_null(pc.equal(text, decoded), False)
                same = pc.or_(same, pc.and_(text.is_null(), decoded.is_null()))
                yield pa.RecordBatch.from_arrays([piece.column("__row"), ids, decoded, same], ["__row", "ids", "decoded", "lossless"])

    return run


def round_trip(
    docs: DataFrame, path: str = MODEL, theta: float = THETA, seed: int = SEED, key_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """All columns of the input but the text; its ids as ``encode_texts`` gives them, what they decode to, and whether that is the text."""
    held = docs.sparkSession.sparkContext.broadcast(load_vocabulary(path, theta))
    made = ("ids", "decoded", "lossless")
    rows = _keyed(docs, key_col, text_col, text_col, *made)
    kept = [c for c in docs.columns if c not in (text_col, *made)]
    schema = _schema(rows, "ids array<int>, decoded string, lossless boolean")
    return rows.mapInArrow(_round(held, seed), schema).select(*[F.col(f"__row.`{c}`") for c in kept], *made)
