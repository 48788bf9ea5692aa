"""Language of texts by bit-sliced Bloom filters of n-grams.

An n-gram is four bytes of lower-cased words with a blank on either side. Counts per language are taken over all documents that have a language and
are not held out; a language keeps the n-grams whose share in it is at least ``SHARE`` of the largest share in any language. All
languages share one filter: slot s holds a bit mask with a bit per language, and an n-gram sets its language's bit in ``HASHES`` slots. One
look-up, the AND of those slots, so returns every language that may contain the n-gram. An n-gram must also be at least ``MIN_SHARE`` of
its language's n-grams, so a language has 1 / ``MIN_SHARE`` of them at most, whatever the corpus. The number of slots follows the number of
kept n-grams (``BITS`` for each), rounded up to a power of two.

A text's n-grams give a count of bits per language. A false positive has the chance f = (filled share of the language's bits) ^ hashes, so of n
n-grams, c of them found, (c - n f) / (1 - f) are expected to be true. The language with the largest corrected count wins; the
score is its share of all corrected counts.

Defined cases: null texts and texts without a letter are ``und`` with score 0, as is every text when nothing was learned; a text whose
n-grams are all unknown gets the first language by name with score 0; ties go to the first language by name; repeated rows are predicted
alike; ids, sources and further columns are never looked at; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vectorloom.llm.folds import held_out
from vectorloom.llm.words import buffers, mix, slices
from vectorloom.session import stored

HASHES, BITS, SHARE, MIN_COUNT, MIN_SHARE = 3, 24, 0.5, 3, 1e-6
NONE = "und"


def _letters() -> np.ndarray:
    """Bytes of words: letters lowered, bytes beyond ASCII as they are, all else a blank."""
    table = np.full(256, 0x20, np.uint8)
    for c in range(0x41, 0x5B):
        table[c] = table[c + 32] = c + 32
    table[128:] = np.arange(128, 256)
    return table


_TABLE = _letters()


def grams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Four-byte n-grams, coded as integers, of every text with blanks around, and the text of each."""
    raw, offsets = buffers(texts)
    sizes = np.diff(offsets)
    at = np.cumsum(sizes + 2) - (sizes + 2)
    data = np.full(int((sizes + 2).sum()), 0x20, np.uint8)
    data[np.arange(len(raw)) + np.repeat(at + 1 - offsets[:-1], sizes)] = _TABLE[raw]
    # Runs of blanks count once.
    keep = np.ones(len(data), dtype=bool)
    keep[1:] = (data[1:] != 0x20) | (data[:-1] != 0x20)
    owner = np.repeat(np.arange(len(sizes)), sizes + 2)[keep]
    data = data[keep].astype(np.uint32)
    if len(data) < 4:
        return np.empty(0, np.uint32), np.empty(0, np.int64)
    code = (data[:-3] << 24) | (data[1:-2] << 16) | (data[2:-1] << 8) | data[3:]
    inside = (owner[:-3] == owner[3:]) & (data[1:-2] != 0x20)
    return code[inside], owner[:-3][inside]


def _count_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in slices(batch):
            names = piece.column("lang").dictionary_encode()
            code, owner = grams(piece.column("text"))
            which = names.indices.to_numpy()[owner].astype(np.uint64)
            both, n = np.unique((which << np.uint64(32)) | code, return_counts=True)
            lang = names.dictionary.take(pa.array((both >> np.uint64(32)).astype(np.int64)))
            yield pa.RecordBatch.from_arrays(
                [lang, pa.array((both & np.uint64(0xFFFFFFFF)).astype(np.int64)), pa.array(n)], ["lang", "gram", "n"]
            )


@dataclass
class LanguageFilter:
    names: list
    slots: np.ndarray  # one 64-bit mask per slot and group of 64 languages
    false: np.ndarray

    def places(self, code: np.ndarray) -> list[np.ndarray]:
        h = mix(code.astype(np.uint64) + np.uint64(1))
        step = mix(h) | np.uint64(1)
        top = np.uint64(len(self.slots) - 1)
        return [((h + np.uint64(i) * step) & top).astype(np.int64) for i in range(HASHES)]

    def masks(self, code: np.ndarray) -> np.ndarray:
        first, *rest = self.places(code)
        out = self.slots[first]
        for p in rest:
            out = out & self.slots[p]
        return out


def build_filter(names: list, code: np.ndarray, lang: np.ndarray, bits: int = BITS) -> LanguageFilter:
    """Filter over (n-gram, language number) pairs."""
    size = 1 << max(10, int(np.ceil(np.log2(max(len(np.unique(code)), 1) * bits))))
    made = LanguageFilter(names, np.zeros((size, -(-max(len(names), 1) // 64)), np.uint64), np.zeros(len(names)))
    for i in range(len(names)):
        own = code[lang == i]
        for p in made.places(own):
            made.slots[np.unique(p), i // 64] |= np.uint64(1 << (i % 64))
    for i in range(len(names)):
        filled = (made.slots[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1)
        made.false[i] = filled.mean() ** HASHES
    return made


def learn(docs: DataFrame, share: float = SHARE, min_count: int = MIN_COUNT, bits: int = BITS) -> LanguageFilter:
    """Count n-grams of all labelled texts outside the held-out fold, and build the filter."""
    rows = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out()).select(
        F.col("lang").cast("string").alias("lang"), "text"
    )
    counts = rows.mapInArrow(_count_rows, "lang string, gram long, n long").groupBy("gram", "lang").agg(F.sum("n").alias("n"))
    counts = stored(counts, "grams")
    totals = {r.lang: r.n for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    names = sorted(totals)
    if not names:
        return build_filter([], np.empty(0, np.uint32), np.empty(0, np.int64), bits)
    total = F.create_map(*[x for name in names for x in (F.lit(name), F.lit(float(totals[name])))])
    part = counts.withColumn("p", F.col("n") / total[F.col("lang")]).where((F.col("n") >= min_count) & (F.col("p") >= MIN_SHARE))
    most = part.groupBy("gram").agg(F.max("p").alias("top"))
    kept = part.join(most, "gram").where(F.col("p") >= share * F.col("top")).select("gram", "lang").toArrow()
    code = kept.column("gram").to_numpy().astype(np.uint32)
    lang = np.searchsorted(np.array(names), kept.column("lang").to_numpy(zero_copy_only=False).astype(str))
    return build_filter(names, code, lang, bits)


def _predicted(held):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f: LanguageFilter = held.value
        for batch in batches:
            for piece in slices(batch):
                text, n_rows, n_lang = piece.column("text"), piece.num_rows, len(f.names)
                lang, score = np.full(n_rows, -1), np.zeros(n_rows)
                if n_lang:
                    code, owner = grams(text)
                    masks = f.masks(code)
                    n = np.bincount(owner, minlength=n_rows)
                    found = np.stack([
                        np.bincount(owner, weights=(masks[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1), minlength=n_rows)
                        for i in range(n_lang)
                    ], axis=1)
                    true = np.maximum((found - n[:, None] * f.false) / np.maximum(1 - f.false, 1e-9), 0)
                    lang = true.argmax(1)
                    score = true.max(1) / np.maximum(true.sum(1), 1e-9)
                    lang[~_has_letter(text)] = -1
                    score[lang < 0] = 0
                names = pa.array([*f.names, NONE]).take(pa.array(np.where(lang < 0, n_lang, lang)))
                yield pa.RecordBatch.from_arrays(
                    [piece.column("doc_id"), piece.column("held_out"), names, pa.array(np.clip(score, 0, 1))],
                    ["doc_id", "held_out", "lang_pred", "score"],
                )

    return run


def _has_letter(texts: pa.Array) -> np.ndarray:
    raw, offsets = buffers(texts)
    ascii_letter = np.concatenate([[0], np.cumsum((_TABLE[raw] != 0x20) & (raw < 128))])
    out = np.diff(ascii_letter[offsets]) > 0
    for i in np.flatnonzero(~out):  # only texts without an ASCII letter
        text = texts[int(i)].as_py()
        out[i] = bool(text) and any(c.isalpha() for c in text)
    return out


def identify(docs: DataFrame, model: LanguageFilter | None = None) -> DataFrame:
    """Per document: doc_id, held_out, lang_pred, score."""
    held = docs.sparkSession.sparkContext.broadcast(model or learn(docs))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_predicted(held), "doc_id long, held_out boolean, lang_pred string, score double")
