"""Toxicity of texts that may be disguised: noisy-channel restoring of words, then a linear score.

1. Language model: counts of all undisguised words, a distributed table that grows with the corpus, backed off (Witten-Bell) to
   trigrams of letters, both over all documents.
2. Channel: a token that could be disguised spans a lattice; that is every token with a sign of ``LEET``, with or without
   letters, with a filler between letters, or with a letter three times in a row. A sign may stand for the letters it resembles (leetspeak), or
   for nothing (decoration at an end, a separator between letters, a filler); a sign or letter that repeats the one before may be a repetition.
   List Viterbi (``lattice``) gives the ``BEST`` best words of each lattice under channel and trigrams, of a token of any length; they are scored by the words,
   and the best one is taken.
3. Three or more one-character tokens in a row are a run. Between two of them a word may end, so a run of any length is cut into
   the words of its best path, and each of them counts. Every stretch of a run is a possible word as long as any word of the corpus
   that ``min_docs`` documents can hold, with as many signs between its letters as it has letters.
4. Every distinct token is decoded once, and the words are joined back to the documents that hold it.
5. Score: logistic regression on the plain and restored words of a document (runs of a letter count once), over all words whose share differs
   between the labels at a false discovery rate of ``FALSE``. It is fitted on a bounded sample of labelled rows outside the held-out fold; the
   words and their weights are bounded by that sample.

Words are cut at ASCII signs other than letters and digits; A-Z are lowered. Language, source and id are never looked at.

Defined cases: a null or empty text has no words and scores the intercept; without any labelled row, or with one class only, all
scores are that class's share (0 without any); repeated rows score alike; of several labels of an id the largest
counts; of equally good words or paths the one of smallest hash is taken; a very long text is one slice, a very long token or run takes time in proportion to
its length; further columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vectorloom.llm.folds import SAMPLE, held_out, labelled_sample
from vectorloom.llm.keys import NULL_ID, id_of
from vectorloom.llm.lattice import LETTERS, channel, decode
from vectorloom.llm.words import PLAIN, RAW, Words, distinct_pairs, lists, signed, slices, words_of
from vectorloom.session import stored

MIN_DOCS, FALSE = 5, 0.01
# Letters a sign can stand for.
LEET = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s",
        "!": "i", "|": "il", "+": "t", "(": "c", "<": "c", "*": "aeiou", "#": "aeiou", "%": "aeiou"}
#: Channel log-probabilities: a sign for one of its letters, a filler between letters, a look-alike sign that means nothing.
SIGN, FILLER, LOST, REPEAT = math.log(0.3), math.log(0.5), math.log(1e-5), math.log(0.5)
#: A look-alike sign at an end of a token that is decoration.
EDGE = math.log(0.5)
#: Best words of a token, and of a stretch of a run.
BEST, BEST_IN_RUN = 8, 2
#: Texts go in slices of this many bytes, tokens in lots of this many, dealt over tasks by their number.
SLICE_BYTES, LOT, TOKENS_PER_TASK = 1 << 19, 4096, 20_000


def _symbols() -> np.ndarray:
    table = np.zeros(256, np.int64)
    for i, c in enumerate(b"abcdefghijklmnopqrstuvwxyz"):
        table[c] = table[c - 32] = i + 1
    table[128:] = 27
    return table


_SYMBOL = _symbols()


def _trigram_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(LETTERS**3, np.int64)
    for batch in batches:
        for piece in slices(batch, most=SLICE_BYTES):
            words = words_of(piece.column("text"), RAW)
            # One symbol per character, as in decoding; a text ends with an edge.
            data = np.insert(words.data, words.offsets[1:], 0)
            data = data[(data & 0xC0) != 0x80]
            s = np.concatenate([[0, 0], np.where(data == 0, 0, _SYMBOL[data]), [0]])
            total += np.bincount((s[:-2] * LETTERS + s[1:-1]) * LETTERS + s[2:], minlength=LETTERS**3)
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["gram", "n"])


def language_model(docs: DataFrame) -> np.ndarray:
    """log P(letter | two before) from all texts; 28 x 28 x 28, smoothed with pairs and single letters."""
    rows = docs.select(F.coalesce("text", F.lit("")).alias("text")).mapInArrow(_trigram_rows, "gram long, n long")
    counts = np.zeros(LETTERS**3)
    for r in rows.groupBy("gram").agg(F.sum("n").alias("n")).collect():  # 21,952 rows at most
        counts[r.gram] = r.n
    c3 = counts.reshape((LETTERS,) * 3)
    c2, c1 = c3.sum(0), c3.sum((0, 1))
    p1 = (c1 + 1) / (c1 + 1).sum()
    p2 = (c2 + 5 * p1) / (c2.sum(1, keepdims=True) + 5)
    return np.log((c3 + 5 * p2) / (c3.sum(2, keepdims=True) + 5))


def _table(signs: bytes) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[list(signs)] = True
    return table


_ALPHA = _table(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ") | (np.arange(256) >= 128)
_DIGIT = _table(b"0123456789")
#: Signs that are taken off both ends of a token before it is looked at for fillers.
_EDGE = _table(b".,;:?!\"'()[]{}<>-_~^=/\\`&#%*")
_SIGNS = _table("".join(LEET).encode())
#: Look-alike signs that are often decoration at an end.
_DECOR = "!(<*#%"


def _bare(words: Words, edge: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each token without the signs of ``edge`` at its ends."""
    inner = np.flatnonzero(~edge[words.data] & (words.data != 0))
    if not len(inner):
        return words.start, words.start
    first, last = np.searchsorted(inner, words.start), np.searchsorted(inner, words.end)
    some = last > first
    start = np.where(some, inner[np.minimum(first, len(inner) - 1)], words.start)
    return start, np.where(some, inner[np.maximum(last - 1, 0)] + 1, words.start)


def _single(words: Words) -> np.ndarray:
    """Tokens of one character, or of a letter or digit and one edge sign."""
    lead = np.concatenate([[0], np.cumsum((words.data & 0xC0) != 0x80)])
    start, end = _bare(words, _EDGE)
    size, inner = lead[words.end] - lead[words.start], lead[end] - lead[start]
    return (size == 1) | (size == 2) & (inner == 1) & (_ALPHA | _DIGIT)[words.data[start]]


def _disguised(words: Words) -> tuple[np.ndarray, list[str]]:
    """Tokens of a slice that could be disguised, lowered, and the text of each; the tokens of a run are joined by blanks."""
    data = words.data
    if not len(words.start):
        return np.empty(0, np.int64), []
    start, end = _bare(words, _EDGE)
    alpha = np.concatenate([[0], np.cumsum(_ALPHA[data])])
    signs = np.concatenate([[0], np.cumsum(_SIGNS[data])])
    n_alpha = alpha[end] - alpha[start]
    same = np.zeros(len(data), np.int64)
    same[2:] = (data[2:] == data[1:-1]) & (data[2:] == data[:-2]) & _ALPHA[data[2:]]
    runs = np.concatenate([[0], np.cumsum(same)])
    odd = (n_alpha > 0) & ((n_alpha < end - start) | (runs[end] - runs[np.minimum(start + 2, end)] > 0))
    odd |= signs[words.end] > signs[words.start]
    owner = words.owner()
    text = data.tobytes()

    def token(a: int) -> str:
        return text[words.start[a] : words.end[a]].lower().decode("utf-8", "replace")

    at = np.flatnonzero(odd)
    whose, picked = owner[at].tolist(), [token(i) for i in at.tolist()]
    single = _single(words)
    cut = np.ones(len(single), dtype=bool)
    cut[1:] = (single[1:] != single[:-1]) | (owner[1:] != owner[:-1])
    begin = np.flatnonzero(cut)
    ends = np.append(begin[1:], len(single))
    long = single[begin] & (ends - begin >= 3)
    for lo, hi in zip(begin[long].tolist(), ends[long].tolist()):
        picked.append(" ".join(token(i) for i in range(lo, hi)))
        whose.append(owner[lo])
    return np.array(whose, np.int64), picked


_CHANNEL = channel(LEET, SIGN)
_LOOKS, _DECORATES, _LETTER = (np.zeros(129, dtype=bool) for _ in range(3))
_LOOKS[[ord(c) for c in LEET]] = True
_DECORATES[[ord(c) for c in _DECOR]] = True
_LETTER[[*b"abcdefghijklmnopqrstuvwxyz", 128]] = True


def _flat(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Codes of all signs one after the other, where each text begins, and for each sign its class and whether it repeats the one before."""
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    begin = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    low = np.minimum(codes, 128)
    again = np.zeros(len(codes), dtype=bool)
    again[1:] = (codes[1:] == codes[:-1]) & (_LETTER | _LOOKS)[low[1:]]
    return codes, begin, low, again


def word_candidates(tokens: list[str], model: np.ndarray) -> tuple[np.ndarray, ...]:
    """Possible words of single tokens: token, hash, channel and letter log-probability."""
    codes, begin, low, again = _flat(tokens)
    size = np.diff(begin)
    inner = [t.strip(_DECOR + ".,;:?\"')[]{}>-_~^=/\\`&") for t in tokens]
    lo = np.array([t.find(i) if i else len(t) for t, i in zip(tokens, inner)], np.int64)
    hi = np.array([a + len(i) if i else 0 for a, i in zip(lo.tolist(), inner)], np.int64)
    owner = np.repeat(np.arange(len(tokens)), size)
    place = np.arange(len(codes)) - begin[owner]
    outside = (place < lo[owner]) | (place >= hi[owner])
    silent = np.select([_LETTER[low], ~_LOOKS[low], _DECORATES[low] & outside], [-np.inf, FILLER, EDGE], LOST)
    ends = np.zeros(len(codes), dtype=bool)
    ends[begin[1:][size > 0] - 1] = True
    which, _, word, said, letters = decode(codes, silent, again, REPEAT, begin[:-1], size, ends, model, _CHANNEL, BEST)
    return which, word, said, letters


def run_candidates(runs: list[str], model: np.ndarray, longest: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Possible words of stretches of runs, some at a time: run, first and last unit, hash, channel and letter log-probability."""
    units = [r.split(" ") for r in runs]
    counts = np.array([len(u) for u in units], np.int64)
    codes, begin, low, again = _flat([c for u in units for c in u])
    size = np.diff(begin)
    several = np.repeat(size > 1, size)
    # A look-alike sign beside a letter may be decoration; one that is a token of its own is a letter.
    silent = np.select([_LETTER[low], ~_LOOKS[low], _DECORATES[low] & several], [-np.inf, FILLER, EDGE], -np.inf)
    ends = np.zeros(len(codes), dtype=bool)
    ends[begin[1:] - 1] = True
    first = np.concatenate([[0], np.cumsum(counts)])
    whose = np.repeat(np.arange(len(runs)), counts)
    last = np.minimum(first[whose + 1], np.arange(len(size)) + 2 * longest)
    for lo in range(0, len(size), LOT):
        start = begin[lo : min(lo + LOT, len(size))]
        span, signs, word, said, letters = decode(
            codes, silent, again, REPEAT, start, begin[last[lo : lo + LOT]] - start, ends, model, _CHANNEL, BEST_IN_RUN, longest
        )
        stop = np.searchsorted(begin, start[span] + signs)
        run = whose[lo + span]
        yield run, lo + span - first[run], stop - first[run], word, said, letters


def _skips(run: str) -> list[int]:
    """Units of a run that may be a sign or number between words."""
    return [i for i, u in enumerate(run.split(" ")) if len(u) == 1 and not u.isalnum() or u.isdigit()]


def _candidate_rows(held, longest: int):
    names = ["th", "a", "b", "word", "some", "channel", "letters"]

    def made(th, row, a, b, word, said, letters):
        return pa.RecordBatch.from_arrays(
            [th.take(pa.array(row)), pa.array(a, pa.int32()), pa.array(b, pa.int32()), pa.array(signed(word)), pa.array(np.ones(len(row), dtype=bool)),
             pa.array(said), pa.array(letters)], names,
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = held.value
        for batch in batches:
            for piece in slices(batch, "token", LOT * 16):
                tokens, th = piece.column("token").to_pylist(), piece.column("th")
                is_run = np.array([" " in t for t in tokens], dtype=bool)
                single, several = np.flatnonzero(~is_run), np.flatnonzero(is_run)
                for lo in range(0, len(single), LOT):
                    at = single[lo : lo + LOT]
                    which, word, said, letters = word_candidates([tokens[i] for i in at], model)
                    yield made(th, at[which], np.zeros(len(which), np.int32), np.ones(len(which), np.int32), word, said, letters)
                if len(several):
                    chosen = [tokens[i] for i in several]
                    for which, a, b, word, said, letters in run_candidates(chosen, model, longest):
                        yield made(th, several[which], a, b, word, said, letters)
                    skips = [(i, k) for i, r in zip(several, chosen) for k in _skips(r)]
                    n, (row, k) = len(skips), zip(*skips) if skips else ((), ())
                    k = np.array(k, np.int32)
                    yield pa.RecordBatch.from_arrays(
                        [th.take(pa.array(row, pa.int64())), pa.array(k), pa.array(k + 1), th.take(pa.array(row, pa.int64())), pa.array(np.zeros(n, dtype=bool)),
                         pa.array(np.full(n, LOST)), pa.array(np.zeros(n))], names,
                    )

    return run


def _path_words(best: dict, trail: dict) -> set:
    """Words of the best path that leads furthest."""
    at, out = max(best), set()
    while at:
        at, word = trail[at]
        out.add(word)
    return out - {None}


def _choice_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words of the best path through the stretches of each token, which come sorted by (th, a, b)."""
    now, best, trail, out = None, {}, {}, []

    def made(rows: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in (0, 1)], ["th", "word"])

    for batch in batches:
        for th, a, b, word, value in zip(*(batch.column(c).to_pylist() for c in ("th", "a", "b", "word", "value"))):
            if th != now:
                if now is not None:
                    out += [(now, w) for w in _path_words(best, trail)]
                now, best, trail = th, {0: 0.0}, {}
            if a in best:
                total = best[a] + value
                if b not in best or (total, -(word or 0)) > (best[b], -(trail[b][1] or 0)):
                    best[b], trail[b] = total, (a, word)
        yield made(out)
        out = []
    if now is not None:
        yield made([(now, w) for w in _path_words(best, trail)])


def _word_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Undisguised words and how often each occurs in a slice: tokens of letters, apart from signs at the ends that resemble none."""
    edge = _EDGE & ~_SIGNS
    for batch in batches:
        for piece in slices(batch, most=SLICE_BYTES):
            words = words_of(piece.column("text"), RAW)
            if not len(words.start):
                continue
            start, end = _bare(words, edge)
            alpha = np.concatenate([[0], np.cumsum(_ALPHA[words.data])])
            plain = (end > start) & (alpha[end] - alpha[start] == end - start)
            text = words.data.copy()
            outside = np.zeros(len(text) + 1, np.int64)
            np.add.at(outside, start[plain], 1)
            np.add.at(outside, end[plain], -1)
            text[np.cumsum(outside)[:-1] == 0] = 0x20
            text = np.insert(text, words.offsets[1:], 0x20)  # a text does not run into the next
            short = _short(pa.array([text.tobytes()], pa.large_binary()).view(pa.large_string()))
            key, first, n = np.unique(short.hashes(), return_index=True, return_counts=True)
            size = (short.end - short.start)[first]
            yield pa.RecordBatch.from_arrays([pa.array(signed(key)), pa.array(n.astype(np.int64)), pa.array(size.astype(np.int32))], ["word", "n", "size"])


def _hash(token: str) -> int:
    return int.from_bytes(blake2b(token.encode("utf-8", "replace"), digest_size=8).digest(), "little", signed=True)


def _fact_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each text, with the hashes of its disguised tokens, and one for each distinct token of a slice."""
    names = ["key", "tag", "tokens", "th", "token"]
    for batch in batches:
        for piece in slices(batch, most=SLICE_BYTES):
            whose, tokens = _disguised(words_of(piece.column("text"), RAW))
            kinds = {t: _hash(t) for t in set(tokens)}
            owner, th = distinct_pairs(whose, np.array([kinds[t] for t in tokens], np.int64).view(np.uint64))
            n, m = piece.num_rows, len(kinds)
            yield pa.RecordBatch.from_arrays(
                [*[piece.column(c) for c in names[:2]], lists(signed(th), np.bincount(owner, minlength=n), pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.string())], names
            )
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(m, pa.int64()), pa.nulls(m, pa.int64()), pa.nulls(m, pa.list_(pa.int64())), pa.array(kinds.values(), pa.int64()),
                 pa.array(kinds.keys(), pa.string())], names
            )


def token_facts(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(key, tag, tokens) of every text, and (th, token) of every distinct token, from one pass over the texts."""
    facts = stored(
        rows.select("key", "tag", "text").mapInArrow(_fact_rows, "key long, tag long, tokens array<long>, th long, token string"), "facts"
    )
    tokens = facts.where("th is not null").groupBy("th").agg(F.first("token").alias("token"))
    return facts.where("th is null").select("key", "tag", "tokens"), stored(tokens, "tokens")


def restored_words(docs: DataFrame, tokens: DataFrame, model: np.ndarray, min_docs: int = MIN_DOCS) -> DataFrame:
    """(th, word): keys of the words that each of the ``tokens`` (th, token) stands for."""
    spark = docs.sparkSession
    texts = docs.select(F.coalesce("text", F.lit("")).alias("text"))
    words = stored(
        texts.mapInArrow(_word_rows, "word long, n long, size int").groupBy("word").agg(F.sum("n").alias("n"), F.first("size").alias("size")), "words"
    )
    facts = words.agg(F.count("*").alias("kinds"), F.sum("n").alias("n"), F.max(F.when(F.col("n") >= min_docs, F.col("size"))).alias("longest")).first()
    kinds, n = float(facts.kinds or 1), float(facts.n or 0)
    held = spark.sparkContext.broadcast(model)
    # Tokens are small and dear, so they are dealt by their number.
    tasks = max(spark.sparkContext.defaultParallelism, -(-tokens.count() // TOKENS_PER_TASK))
    made = tokens.repartition(tasks).mapInArrow(
        _candidate_rows(held, facts.longest or 1), "th long, a int, b int, word long, some boolean, channel double, letters double"
    )
    value = F.col("channel") + F.when(
        F.col("some"), F.log(F.coalesce("n", F.lit(0)) + F.lit(kinds) * F.exp("letters") + F.lit(1e-300)) - math.log(n + kinds)
    ).otherwise(0.0)
    valued = made.join(words, "word", "left").select("th", "a", "b", F.when(F.col("some"), F.col("word")).alias("word"), value.alias("value"))
    return stored(
        valued.repartition("th").sortWithinPartitions("th", "a", "b").mapInArrow(_choice_rows, "th long, word long").distinct(), "restored"
    )


def _short(texts: pa.Array) -> Words:
    """Plain words with runs of a letter taken once."""
    words = words_of(texts, PLAIN)
    if not len(words.start):
        return words
    keep = np.ones(len(words.data), dtype=bool)
    keep[1:] = (words.data[1:] != words.data[:-1]) | (words.data[1:] >= 128)
    keep[words.start] = True
    new = np.concatenate([[0], np.cumsum(keep)])
    return Words(words.data[keep], words.offsets, new[words.start], new[words.end], words.bounds)


def _keys(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every plain word with runs of a letter taken once, and the text of each."""
    short = _short(texts)
    return short.hashes(), short.owner()


def _doc_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct plain words of each text."""
    for batch in batches:
        for piece in slices(batch, most=SLICE_BYTES):
            values, owner = _keys(piece.column("text"))
            owner, values = distinct_pairs(owner, values)
            yield pa.RecordBatch.from_arrays(
                [piece.column("key"), piece.column("tag"), piece.column("y"), lists(signed(values), np.bincount(owner, minlength=piece.num_rows), pa.int64())],
                ["key", "tag", "y", "words"],
            )


def fit_logistic(rows: np.ndarray, columns: np.ndarray, y: np.ndarray, penalty: np.ndarray, rounds: int = 30) -> np.ndarray:
    """Weights and, last, the intercept by Newton steps on presence features (row, column), each solved by conjugate gradients; the
    intercept is not penalised."""
    n, m = len(y), len(penalty)
    pull = np.append(penalty, 1e-6)

    def forward(w: np.ndarray) -> np.ndarray:
        return np.bincount(rows, weights=w[columns], minlength=n) + w[-1]

    def back(r: np.ndarray) -> np.ndarray:
        return np.append(np.bincount(columns, weights=r[rows], minlength=m), r.sum())

    w = np.zeros(m + 1)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(forward(w), -30, 30)))
        curve = np.maximum(p * (1 - p), 1e-9)
        rest = back(y - p) - pull * w
        scale = 1 / (back(curve) + pull)  # the diagonal, as features are 0 or 1
        step, way = np.zeros(m + 1), scale * rest
        left = rest @ way
        for _ in range(200):
            if left < 1e-18:
                break
            bent = back(curve * forward(way)) + pull * way
            far = left / (way @ bent)
            step += far * way
            rest = rest - far * bent
            new = rest @ (scale * rest)
            way, left = scale * rest + new / left * way, new
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def discovered(z: np.ndarray, tests: int, rate: float) -> float:
    """Smallest |z| that Benjamini and Hochberg's rule accepts among ``tests`` two-sided tests, of which the largest are given; infinite if none is."""
    z = np.sort(z)[::-1]
    p = np.array([math.erfc(v / math.sqrt(2)) for v in z])
    good = np.flatnonzero(p <= rate * (np.arange(len(z)) + 1) / max(tests, 1))
    return float(z[good[-1]]) if len(good) else math.inf


def fit_words(features: DataFrame, min_docs: int, rate: float) -> tuple[np.ndarray, np.ndarray, float]:
    """Word keys, their weights and the intercept, from stored sample features (key, y, words)."""
    totals = features.agg(F.count("*").alias("n"), F.sum("y").alias("ones")).first()
    n, ones = totals.n, totals.ones or 0
    share = ones / n if n else 0.0
    nothing = np.empty(0, np.int64), np.empty(0), math.log(max(share, 1e-9) / max(1 - share, 1e-9))
    if not ones or ones == n:
        return nothing
    seen = features.select("y", F.explode("words").alias("word")).groupBy("word").agg(F.count("*").alias("c"), F.sum("y").alias("c1"))
    p, p1, p0 = F.col("c") / n, F.col("c1") / ones, (F.col("c") - F.col("c1")) / (n - ones)
    z = F.abs(p1 - p0) / F.sqrt(p * (1 - p) * (1 / ones + 1 / (n - ones)) + 1e-12)
    support = F.when(p1 > p0, F.col("c1")).otherwise(F.col("c") - F.col("c1"))
    tested = stored(seen.where(F.col("c") >= min_docs).select("word", support.alias("support"), z.alias("z")), "tested")
    # What the rule accepts is at or above this; words of a bounded sample.
    likely = tested.where(F.col("z") >= _tail(rate)).collect()
    least = discovered(np.array([r.z for r in likely]), tested.count(), rate)
    best = sorted((r.word, r.support) for r in likely if r.z >= least)
    if not best:
        return nothing
    words = np.array([b[0] for b in best], np.int64)
    # Words seen in few documents of their label, often copies of one, are held back; widespread ones are free.
    penalty = np.clip((10 / np.array([max(b[1], 1) for b in best], np.float64)) ** 2, 1e-3, 10)
    # At most ``sample`` rows with some of these words.
    chosen = features.sparkSession.createDataFrame([(int(w),) for w in words], "word long")
    hits = features.select("key", "tag", "y", F.explode("words").alias("word")).join(F.broadcast(chosen), "word").groupBy("key", "tag", "y").agg(
        F.collect_list("word").alias("w")
    )
    rows = features.select("key", "tag", "y").join(hits.select("key", "tag", "w"), ["key", "tag"], "left").select("y", "w").toArrow()
    held = rows.column("w").combine_chunks()
    sizes = held.value_lengths().fill_null(0).to_numpy()
    columns = np.searchsorted(words, held.flatten().to_numpy(zero_copy_only=False))
    w = fit_logistic(np.repeat(np.arange(len(sizes)), sizes), columns, rows.column("y").to_numpy().astype(np.float64), penalty)
    return words, w[:-1], float(w[-1])


def _tail(rate: float) -> float:
    """The |z| whose two-sided probability is ``rate``."""
    low, high = 0.0, 40.0
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if math.erfc(mid / math.sqrt(2)) > rate else (low, mid)
    return low


def _hit_rows(held):
    """The learned words among the plain words of each text, and the sum of their weights."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, weights = held.value
        for batch in batches:
            for piece in slices(batch, most=SLICE_BYTES):
                values, owner = _keys(piece.column("text"))
                values = signed(values)
                hit = np.isin(values, words)
                owner, values = distinct_pairs(owner[hit], values[hit])
                total = np.bincount(owner, weights=weights[np.searchsorted(words, values)] if len(words) else None, minlength=piece.num_rows)
                yield pa.RecordBatch.from_arrays(
                    [piece.column("key"), piece.column("tag"), piece.column("held_out"),
                     lists(values, np.bincount(owner, minlength=piece.num_rows), pa.int64()), pa.array(total.astype(np.float64))],
                    ["key", "tag", "held_out", "words", "total"],
                )

    return run


def _with_restored(rows: DataFrame, restored: DataFrame, *more: str) -> DataFrame:
    """The restored words of each (key, tag): ``more``, as structs of word and further columns."""
    parts = rows.select("key", "tag", F.explode("tokens").alias("th"))
    return parts.join(restored, "th").groupBy("key", "tag").agg(F.collect_set(F.struct("word", *more)).alias("more"))


def score_toxicity(
    docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, min_docs: int = MIN_DOCS, rate: float = FALSE, threshold: float = 0.5
) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted, and internal key and tag."""
    spark = docs.sparkSession
    rows = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("key"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("tag"),
        held_out().alias("held_out"), F.coalesce("text", F.lit("")).alias("text"),
    )
    facts, tokens = token_facts(rows)
    restored = restored_words(docs, tokens, language_model(docs), min_docs)
    chosen = F.broadcast(stored(labelled_sample(labels, "toxic", sample), "sample"))  # at most ``sample`` rows of two numbers
    seen = rows.join(chosen, "key").select("key", "tag", "y", "text").mapInArrow(_doc_rows, "key long, tag long, y int, words array<long>")
    found = _with_restored(facts.join(chosen, "key"), restored)
    union = F.array_union("words", F.coalesce("more.word", F.array().cast("array<long>"))).alias("words")
    features = stored(seen.dropDuplicates(["key", "tag"]).join(found, ["key", "tag"], "left").select("key", "tag", "y", union), "features")
    words, weights, intercept = fit_words(features, min_docs, rate)
    held = spark.sparkContext.broadcast((words, weights))
    hits = stored(rows.mapInArrow(_hit_rows(held), "key long, tag long, held_out boolean, words array<long>, total double"), "hits")
    # The tokens that stand for a learned word; stored, so that Spark knows how many there are.
    learned = spark.createDataFrame([(int(w), float(v)) for w, v in zip(words, weights)], "word long, weight double")
    useful = stored(restored.join(F.broadcast(learned), "word"), "useful")
    more = stored(_with_restored(facts, useful, "weight"), "more")
    logit = F.aggregate(
        F.filter(F.array_sort(F.coalesce("more", F.expr("cast(array() as array<struct<word: bigint, weight: double>>)"))), lambda m: ~F.array_contains("words", m["word"])),
        F.col("total") + F.lit(float(intercept)), lambda total, m: total + m["weight"],
    )
    scored = hits.join(more, ["key", "tag"], "left").withColumn(
        "score", 1 / (1 + F.exp(-F.least(F.greatest(logit, F.lit(-500.0)), F.lit(500.0))))
    )
    return scored.select(
        id_of().alias("doc_id"), "held_out", "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "key", "tag"
    )


def drop_toxic(docs: DataFrame, labels: DataFrame, **settings) -> DataFrame:
    """The documents that are not predicted toxic, with all their columns."""
    found = score_toxicity(docs, labels, **settings).where("predicted = 1").select("key", "tag").distinct()
    marked = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("key"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("tag"),
    )
    return marked.join(found, ["key", "tag"], "left_anti").select("row.*")
