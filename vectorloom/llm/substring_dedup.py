"""Removal of repeated passages by relative Lempel-Ziv parsing.

A document is parsed against everything that starts earlier: the same document
before the current word, and all documents of smaller id. A factor is a maximal run of
words that one earlier place also has; factors of ``window`` words or more
become duplicate spans. The reference is an index of seeds of ``window`` words. A seed
that straddles two factors is looked up by itself, so what lies on a factor boundary is not missed.

1. Anchors: of the ``window - anchor + 1`` runs of ``anchor`` words in a window, the one with the smallest hash.
   Two equal windows have equal anchors, so only windows whose anchor occurs twice in the corpus can repeat.
2. Reference blocks: documents are dealt by range of their smallest anchor hash, so copies and near copies
   come into one block (a frequent value is spread over neighbouring tasks). A block parses its documents against each
   other at once, and later seeds go on as factors, one row each.
3. Seeds whose anchor also occurs outside the block, as the counts of step 1 tell, are looked up in all other
   blocks through their hash. A block sends a seed once at most, however often it occurs.

Words are ``[^\\x20\\x09-\\x0D]+``, unchanged. Hashes of windows have 96 bits.

Defined cases: a null text has no words, as an empty one; a document shorter than the window
keeps all its words; a null id counts as smaller than any other; rows that share an
id count as one place each, so a repeated row removes nothing from its twin; columns other than id
and text are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vectorloom.llm.keys import id_of, keyed
from vectorloom.llm.words import RAW, Words, distinct_pairs, mix, rolling, signed, slices, words_of

WINDOW, ANCHOR = 20, 8
BLOCK_BYTES = 4 << 20
_LOW = np.uint64((1 << 32) - 1)


def _reach(x: np.ndarray, n: int, op) -> np.ndarray:
    """op over x[i:i+n] for every i, by doubling; the array shrinks by n - 1."""
    have = 1
    while have < n:
        step = min(have, n - have)
        x = op(x[:-step], x[step:])
        have += step
    return x


def _anchors(words: Words, window: int, anchor: int):
    """Start of every window and the hash of its anchor; then the hashes of all anchor places."""
    h = words.hashes()
    if len(h) < window:
        return np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.uint64), h
    begin = np.arange(len(h) - anchor + 1)
    runs = rolling(h, begin, begin + anchor)
    low = _reach(runs, window - anchor + 1, np.minimum)
    first = np.arange(len(low))
    inside = first + window <= words.bounds[1:][words.owner()[first]]
    # A place is an anchor if it is the smallest of some window around it.
    edge = np.zeros(window - anchor, np.uint64)
    around = _reach(np.concatenate([edge, np.where(inside, low, 0), edge]), window - anchor + 1, np.maximum)
    return first[inside], low[inside], runs[around == runs], h


def _place(low: np.ndarray, words: Words, first: np.ndarray, piece: pa.RecordBatch) -> np.ndarray:
    """Where a document of the slice belongs: its smallest anchor above, a hash of its key below. 0: no window."""
    least = np.full(piece.num_rows, np.iinfo(np.uint64).max, np.uint64)
    owner = words.owner()[first]
    np.minimum.at(least, owner, low)
    has = np.zeros(piece.num_rows, dtype=bool)
    has[owner] = True
    own = mix(piece.column("key").to_numpy().view(np.uint64) ^ mix(piece.column("tag").to_numpy().view(np.uint64)))
    return np.where(has, (least & ~_LOW) | (own & _LOW) | np.uint64(1), np.uint64(0))


def _rows_of(what: str, window: int, anchor: int):
    """Per slice: 'counts' of anchors, the 'owners' of anchors, or the 'texts' of documents with a window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch):
                words = words_of(piece.column("text"), RAW)
                first, low, places, _ = _anchors(words, window, anchor)
                if what == "counts":
                    found, n = np.unique(places, return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(signed(found)), pa.array(n)], ["anchor", "n"])
                    continue
                place = _place(low, words, first, piece)
                if what == "owners":
                    owner, found = distinct_pairs(words.owner()[first], low)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(signed(found)), pa.array(signed(place[owner]))], ["anchor", "place"]
                    )
                else:
                    at = pa.array(np.flatnonzero(place))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(signed(place)).take(at)] + [piece.column(c).take(at) for c in ("key", "tag", "text")],
                        ["place", "key", "tag", "text"],
                    )

    return run


def _runs(tag_cols: list[np.ndarray], start: np.ndarray, source: np.ndarray) -> np.ndarray:
    """Where a new factor begins: another row, a gap, or a source that does not go on."""
    new = np.ones(len(start), dtype=bool)
    if len(start) > 1:
        same = (start[1:] == start[:-1] + 1) & (source[1:] == source[:-1] + 1)
        for c in tag_cols:
            same &= c[1:] == c[:-1]
        new[1:] = ~same
    return np.flatnonzero(new)


_SEEDS = "h1 long, h2 int, key long, tag long, start long, src_key long, src_start long, n long"


def _short(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint32).view(np.int32)


def _block_seeds(texts: list, key, tag, anchors, totals, window: int, anchor: int) -> Iterator[pa.RecordBatch]:
    """Parse the documents of a block against each other; open seeds come with their hash, factors with their source."""
    words = words_of(pa.array(texts, pa.large_string()), RAW)
    first, low, places, h = _anchors(words, window, anchor)
    known, at = np.unique(anchors, return_index=True)
    low, places = signed(low), signed(places)
    hit = np.isin(low, known)
    first, low = first[hit], low[hit]
    inside, n = np.unique(places, return_counts=True)
    owner = words.owner()[first]
    h1 = rolling(h, first, first + window)
    h2 = rolling(words.hashes(1), first, first + window, 1) & _LOW
    start = first - words.bounds[:-1][owner]
    order = np.lexsort((start, key[owner], h2, h1))
    a, b, k, s = h1[order], h2[order], key[owner][order], start[order]
    new = np.ones(len(order), dtype=bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    lead = np.flatnonzero(new)
    of = np.repeat(lead, np.diff(np.append(lead, len(order))))
    keep = order[new]
    away = totals[at[np.searchsorted(known, low[keep])]] > n[np.searchsorted(inside, low[keep])]
    keep = keep[away]
    none = pa.nulls(len(keep), pa.int64())
    names = ["h1", "h2", "key", "tag", "start", "src_key", "src_start", "n"]
    yield pa.RecordBatch.from_arrays(
        [pa.array(signed(h1[keep])), pa.array(_short(h2[keep])), pa.array(key[owner[keep]]), pa.array(tag[owner[keep]]),
         pa.array(start[keep]), none, none, pa.array(np.ones(len(keep), np.int64))], names,
    )
    # The earliest place itself, also where a repeated row gives it twice, has no source.
    source = (k[of] != k) | (s[of] != s)
    later, src_key, src_start = order[source], k[of][source], s[of][source]
    if len(later):
        back = np.lexsort((src_key, start[later], owner[later]))
        later, src_key, src_start = later[back], src_key[back], src_start[back]
        begin = _runs([owner[later], src_key], start[later], src_start)
        length = np.diff(np.append(begin, len(later))).astype(np.int64)
        at = later[begin]
        mark = [mix((key[owner[at]] * 31 + tag[owner[at]] + start[at] + c).view(np.uint64)) for c in (1, 2)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(signed(mark[0])), pa.array(_short(mark[1])), pa.array(key[owner[at]]), pa.array(tag[owner[at]]),
             pa.array(start[at]), pa.array(src_key[begin]), pa.array(src_start[begin]), pa.array(length)], names,
        )


def _block_rows(window: int, anchor: int):
    """Rows come sorted by place, anchors before texts; a block closes at ``BLOCK_BYTES`` of text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, keys, tags, anchors, totals, size = [], [], [], [], [], 0
        place = held = None

        def close():
            yield from _block_seeds(
                texts, np.array(keys, np.int64), np.array(tags, np.int64), np.concatenate(anchors), np.concatenate(totals),
                window, anchor,
            )

        for batch in batches:
            here = batch.column("place").to_numpy()
            key, tag, text = batch.column("key"), batch.column("tag"), batch.column("text")
            known = batch.column("known")
            flat = known.flatten()
            name = flat.field("anchor").to_numpy(zero_copy_only=False)
            total = flat.field("n").to_numpy(zero_copy_only=False)
            cut = np.concatenate([[0], np.cumsum(known.value_lengths().fill_null(0).to_numpy())])
            is_text = text.is_valid().to_numpy(zero_copy_only=False)
            for i in range(batch.num_rows):
                if not is_text[i]:
                    place, held = here[i], (name[cut[i] : cut[i + 1]].copy(), total[cut[i] : cut[i + 1]].copy())
                elif place == here[i]:
                    texts.append(text[i].as_py())
                    keys.append(key[i].as_py())
                    tags.append(tag[i].as_py())
                    anchors.append(held[0])
                    totals.append(held[1])
                    size += len(texts[-1])
                    if size >= BLOCK_BYTES:
                        yield from close()
                        texts, keys, tags, anchors, totals, size = [], [], [], [], [], 0
        if texts:
            yield from close()

    return run


def _block_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of the sorted rows of the blocks, the texts that have a repeated anchor."""
    place = None
    for batch in batches:
        here, is_text = batch.column("place").to_numpy(), batch.column("text").is_valid().to_numpy(zero_copy_only=False)
        keep = np.zeros(batch.num_rows, dtype=bool)
        for i in range(batch.num_rows):
            if not is_text[i]:
                place = here[i]
            keep[i] = is_text[i] and place == here[i]
        yield pa.RecordBatch.from_arrays(
            [batch.column(c).filter(pa.array(keep)) for c in ("key", "tag", "text")], ["key", "tag", "text"]
        )


def _found(rows: DataFrame, window: int, anchor: int) -> tuple[DataFrame, DataFrame]:
    """Texts that can hold a repeat, and (key, tag, start, src_key, src_start, n): n seeds in a row from word ``start`` that also begin
    at word ``src_start`` of the earlier ``src_key``."""
    twice = (
        rows.mapInArrow(_rows_of("counts", window, anchor), "anchor long, n long")
        .groupBy("anchor").agg(F.sum("n").alias("n")).where("n > 1")
    )
    known = (
        rows.mapInArrow(_rows_of("owners", window, anchor), "anchor long, place long")
        .join(twice, "anchor").groupBy("place").agg(F.collect_set(F.struct("anchor", "n")).alias("known"))
    )
    texts = rows.mapInArrow(_rows_of("texts", window, anchor), "place long, key long, tag long, text string")
    blocks = (
        texts.withColumn("known", F.lit(None).cast("array<struct<anchor: bigint, n: bigint>>"))
        .unionByName(known, allowMissingColumns=True)
        .repartitionByRange("place").sortWithinPartitions("place", F.col("text").isNotNull(), "key")
    )
    seeds = blocks.mapInArrow(_block_rows(window, anchor), _SEEDS)
    # Every block sends a seed once at most, so a hot passage has few rows in its window.
    earliest = F.min(F.when(F.col("src_key").isNull(), F.struct("key", "start"))).over(Window.partitionBy("h1", "h2"))
    return blocks.mapInArrow(_block_texts, "key long, tag long, text string"), (
        seeds.withColumn("src", earliest)
        .where("src_key is not null or key != src.key or start != src.start")
        .select("key", "tag", "start", F.coalesce("src_key", "src.key").alias("src_key"),
                F.coalesce("src_start", "src.start").alias("src_start"), "n")
    )


def factors(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """The factors of every document, each as doc_id, start, n_words, source_id, source_start (word places).

    Factors may overlap at their ends, where a seed lies on a boundary.
    """
    _, found = _found(keyed(docs), window, anchor)
    # A factor goes on while the next seed has the next place of the same source.
    line = found.withColumn("end", F.col("start") + F.col("n")).withColumn("shift", F.col("src_start") - F.col("start"))
    grouped = line.groupBy("key", "tag", "src_key", "shift").agg(F.sort_array(F.collect_set(F.struct("start", "end"))).alias("s"))
    merged = grouped.select("key", "src_key", "shift", F.explode(F.expr("""
        aggregate(s, cast(array() as array<struct<start: bigint, `end`: bigint>>), (a, x) ->
          if(size(a) > 0 and element_at(a, -1).`end` >= x.start,
             concat(slice(a, 1, size(a) - 1), array(named_struct('start', element_at(a, -1).start, 'end', greatest(element_at(a, -1).`end`, x.`end`)))),
             concat(a, array(x))))""")).alias("f"))
    return merged.select(
        id_of().alias("doc_id"), F.col("f.start").alias("start"),
        (F.col("f.end") - F.col("f.start") + (window - 1)).alias("n_words"),
        id_of("src_key").alias("source_id"), (F.col("f.start") + F.col("shift")).alias("source_start"),
    )


def _whole_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n, sha = [], []
        for text in batch.column("text"):
            found = text.as_buffer().to_pybytes().split()
            n.append(len(found))
            sha.append(hashlib.sha256(b" ".join(found)).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [batch.column("key"), batch.column("tag"), pa.array(n, pa.int64()), pa.array(sha, pa.string())],
            ["key", "tag", "n_words", "whole_sha"],
        )


def _kept_rows(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            removed, texts = [], []
            for text, spans in zip(batch.column("text"), batch.column("spans")):
                found = text.as_buffer().to_pybytes().split()
                gone = np.zeros(len(found) + 1, dtype=np.int64)
                flat = spans.values
                start = flat.field("start").to_numpy(zero_copy_only=False)
                np.add.at(gone, start, 1)
                np.add.at(gone, start + flat.field("n").to_numpy(zero_copy_only=False) + window - 1, -1)
                keep = np.cumsum(gone)[:-1] == 0
                removed.append(len(found) - int(keep.sum()))
                texts.append(b" ".join([w for w, k in zip(found, keep.tolist()) if k]).decode())
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("tag"), pa.array(removed, pa.int64()), pa.array(texts, pa.string())],
                ["key", "tag", "n_removed", "kept"],
            )

    return run


def dedup_passages(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR, with_text: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every document, and on request the kept text (``kept``,
    null where nothing was removed: the document's own words then stay)."""
    rows = keyed(docs)
    texts, found = _found(rows, window, anchor)
    spans = found.groupBy("key", "tag").agg(F.collect_set(F.struct("start", "n")).alias("spans"))
    changed = (
        texts.join(spans, ["key", "tag"]).select("key", "tag", "text", "spans")
        .mapInArrow(_kept_rows(window), "key long, tag long, n_removed long, kept string")
        .select("key", "tag", "n_removed", F.sha2("kept", 256).alias("kept_sha"), *(["kept"] if with_text else []))
        .dropDuplicates(["key", "tag"])
    )
    whole = rows.mapInArrow(_whole_rows, "key long, tag long, n_words long, whole_sha string")
    return whole.join(changed, ["key", "tag"], "left").select(
        id_of().alias("doc_id"), "n_words", F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"),
        F.coalesce("kept_sha", "whole_sha").alias("kept_sha256"), *(["kept"] if with_text else []),
    )
