"""Quality of texts by attention-based multiple-instance learning.

A document is a bag of passages of ``PASSAGE`` words, the last one shorter; all passages of the whole text are encoded. A passage x is encoded as
h = tanh(W x + b). Gated attention weighs it: a = softmax over the document of w . (tanh(V h) * sigmoid(U h)). The document is scored
from the weighted sum of its encoded passages, so the attention learns from labels of documents alone which passages tell.

Passage features: shares of kinds of signs, lengths and shapes of words, repetition inside the passage and of earlier parts of the document, line lengths,
and hashed words. They come from whole batches of bytes at once; language, source and id are never looked at.

The network is fitted by Adam on a bounded sample of labelled documents outside the held-out fold (``sample``), of which a long one gives as many passages as it has.

Defined cases: a null, empty or wordless text is a bag of one passage of zeros; without any label every score is 0.5, with one class only
that class's value; repeated rows score alike; of several labels of an id the largest counts; further columns are not
read; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vectorloom.llm.folds import held_out, labelled_sample
from vectorloom.llm.keys import NULL_ID, id_of
from vectorloom.llm.words import RAW, buffers, lists, shingles, slices, words_of
from vectorloom.session import stored

PASSAGE, HASHED = 48, 64
SAMPLE, EPOCHS, HIDDEN, GATES = 6000, 30, 24, 12
_GROUPS = (b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t", b"\n\r", b".", b",", b";:", b"!", b"?", b"|", b"#", b"$",
           b"%", b"&", b"*", b"@", b"/\\", b"\"'", b"()[]{}<>", b"-_=+~")


def _kinds() -> np.ndarray:
    table = np.full(256, len(_GROUPS), np.int64)
    for i, group in enumerate(_GROUPS):
        table[list(group)] = i
    table[128:] = len(_GROUPS) + 1
    return table


_KIND = _kinds()
_N_KINDS = len(_GROUPS) + 2
WIDTH = _N_KINDS + 9 + HASHED


def _again(owner: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Whether the same value of the same owner came before."""
    order = np.lexsort((values, owner))
    same = np.zeros(len(order), dtype=bool)
    same[1:] = (owner[order][1:] == owner[order][:-1]) & (values[order][1:] == values[order][:-1])
    out = np.zeros(len(order), dtype=bool)
    out[order] = same
    return out


def passages(texts: pa.Array, size: int = PASSAGE) -> tuple[np.ndarray, np.ndarray]:
    """Features of all passages (rows in order of the texts), and the number of passages of each text (1 at least)."""
    raw, offsets = buffers(texts)
    words = words_of(texts, RAW)
    counts = words.counts()
    n_passages = np.maximum(-(-counts // size), 1)
    first = np.cumsum(n_passages) - n_passages
    owner = words.owner()
    number = np.arange(len(owner)) - words.bounds[:-1][owner]
    of = first[owner] + number // size
    total = int(n_passages.sum())
    x = np.zeros((total, WIDTH), np.float32)
    # A passage reaches from its first word to the next passage's first word; the first begins with the text.
    begin = np.repeat(offsets[:-1], n_passages)
    head = number % size == 0
    later = head & (number > 0)
    begin[of[later]] = words.start[later]
    length = np.diff(np.append(begin, len(raw)))
    byte_of = np.repeat(np.arange(total), length)
    if len(raw):
        kinds = np.bincount(byte_of * _N_KINDS + _KIND[raw], minlength=total * _N_KINDS).reshape(total, _N_KINDS)
        x[:, :_N_KINDS] = kinds / np.maximum(length, 1)[:, None]
    n = np.maximum(np.bincount(of, minlength=total), 1)
    if len(owner):
        h = words.hashes()
        long = words.end - words.start

        def share(flags) -> np.ndarray:
            return np.bincount(of, weights=flags, minlength=total) / n

        upper = np.concatenate([[0], np.cumsum(_KIND[raw] == 1)])
        caps = upper[words.end] - upper[words.start]
        twice = np.zeros(len(h), dtype=bool)
        twice[1:] = (h[1:] == h[:-1]) & (owner[1:] == owner[:-1])
        runs, run_owner = shingles(h, words.bounds, 5)
        run_again = np.zeros(len(h), dtype=bool)
        place = words.bounds[:-1][run_owner] + np.arange(len(runs)) - np.searchsorted(run_owner, run_owner)
        run_again[place] = _again(run_owner, runs)
        mean = share(long)
        at = _N_KINDS
        for column in (
            np.log1p(np.bincount(of, minlength=total)) / 4, mean / 10, np.sqrt(np.maximum(share(long * long) - mean * mean, 0)) / 10,
            share(caps == long), share((caps > 0) & (caps < long)), share(twice), share(_again(of, h)), share(_again(owner, h)), share(run_again),
        ):
            x[:, at] = column
            at += 1
        bucket = (h & np.uint64(HASHED - 1)).astype(np.int64)
        sign = 1.0 - 2.0 * ((h >> np.uint64(20)) & np.uint64(1)).astype(np.float64)
        x[:, at:] = (np.bincount(of * HASHED + bucket, weights=sign, minlength=total * HASHED) / np.repeat(n, HASHED)).reshape(total, HASHED)
    return x, n_passages


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Network:
    """Weights by name; mean and scale of the features."""

    mean: np.ndarray
    scale: np.ndarray
    p: dict

    def forward(self, x: np.ndarray, first: np.ndarray) -> tuple:
        """Score of every bag; bag i has the passages from first[i] on."""
        p = self.p
        x = (x - self.mean) / self.scale
        sizes = np.diff(np.append(first, len(x)))
        h = np.tanh(x @ p["W"] + p["b"])
        t, g = np.tanh(h @ p["V"]), _sigmoid(h @ p["U"])
        e = (t * g) @ p["w"]
        e = np.exp(e - np.repeat(np.maximum.reduceat(e, first), sizes))
        a = e / np.repeat(np.add.reduceat(e, first), sizes)
        z = np.add.reduceat(h * a[:, None], first)
        return _sigmoid(z @ p["c"] + p["d"]), x, sizes, h, t, g, a, z

    def gradients(self, x: np.ndarray, first: np.ndarray, y: np.ndarray) -> dict:
        """Of the mean cross-entropy, by the chain rule."""
        p = self.p
        score, x, sizes, h, t, g, a, z = self.forward(x, first)
        d_logit = (score - y) / len(y)
        d_z = np.repeat(d_logit[:, None] * p["c"][None, :], sizes, axis=0)
        d_a = (d_z * h).sum(1)
        d_e = a * (d_a - np.repeat(np.add.reduceat(a * d_a, first), sizes))
        d_t, d_g = d_e[:, None] * p["w"] * g * (1 - t * t), d_e[:, None] * p["w"] * t * g * (1 - g)
        d_h = (d_z * a[:, None] + d_t @ p["V"].T + d_g @ p["U"].T) * (1 - h * h)
        return {"W": x.T @ d_h, "b": d_h.sum(0), "V": h.T @ d_t, "U": h.T @ d_g, "w": (t * g).T @ d_e, "c": z.T @ d_logit, "d": d_logit.sum()}


def new_network(x: np.ndarray, hidden: int = HIDDEN, gates: int = GATES, seed: int = 3) -> Network:
    rng = np.random.default_rng(seed)
    p = {
        "W": rng.normal(0, x.shape[1] ** -0.5, (x.shape[1], hidden)), "b": np.zeros(hidden), "V": rng.normal(0, hidden**-0.5, (hidden, gates)),
        "U": rng.normal(0, hidden**-0.5, (hidden, gates)), "w": rng.normal(0, 0.1, gates), "c": rng.normal(0, 0.1, hidden), "d": np.float64(0),
    }
    return Network(x.mean(0), x.std(0) + 1e-3, p)


def fit(x: np.ndarray, sizes: np.ndarray, y: np.ndarray, epochs: int = EPOCHS, batch: int = 128, rate: float = 3e-3, decay: float = 1e-3) -> Network:
    net = new_network(x)
    first = np.cumsum(sizes) - sizes
    rng = np.random.default_rng(4)
    m = {k: np.zeros_like(v) for k, v in net.p.items()}
    v2 = {k: np.zeros_like(v) for k, v in net.p.items()}
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for lo in range(0, len(y), batch):
            own = order[lo : lo + batch]
            n = sizes[own]
            start = np.cumsum(n) - n
            rows = np.repeat(first[own] - start, n) + np.arange(n.sum())
            step += 1
            for k, grad in net.gradients(x[rows], start, y[own]).items():
                grad = grad + (decay * net.p[k] if k in ("W", "c") else 0)
                m[k] = 0.9 * m[k] + 0.1 * grad
                v2[k] = 0.999 * v2[k] + 0.001 * grad * grad
                net.p[k] = net.p[k] - rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v2[k] / (1 - 0.999**step)) + 1e-8)
    return net


def _bag_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in slices(batch):
            x, n = passages(piece.column("text"))
            yield pa.RecordBatch.from_arrays([piece.column("key"), piece.column("y"), lists(x.ravel(), n * WIDTH, pa.float32())], ["key", "y", "bag"])


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE) -> Network | float:
    """The fitted network; a plain score where there are no two classes to tell apart."""
    chosen = stored(labelled_sample(labels, label, sample), "sample")
    # At most ``sample`` rows of two numbers are broadcast; of them come the bags that the network is fitted on.
    bags = stored(
        docs.select(F.col("doc_id").cast("long").alias("key"), F.coalesce("text", F.lit("")).alias("text"))
        .join(F.broadcast(chosen), "key").mapInArrow(_bag_rows, "key long, y int, bag array<float>"),
        "bags",
    )
    # The same id on several rows gives one bag.
    rows = bags.groupBy("key", "y").agg(F.max("bag").alias("bag")).orderBy("key").toArrow()
    y = rows.column("y").to_numpy().astype(np.float64)
    if len(np.unique(y)) < 2:
        return float(y[0]) if len(y) else 0.5
    bag = rows.column("bag").combine_chunks()
    x = bag.flatten().to_numpy(zero_copy_only=False).reshape(-1, WIDTH)
    return fit(x, bag.value_lengths().to_numpy() // WIDTH, y)


def _scored(held):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = held.value
        for batch in batches:
            for piece in slices(batch):
                if isinstance(net, float):
                    score = np.full(piece.num_rows, net)
                else:
                    x, n = passages(piece.column("text"))
                    score = net.forward(x, np.cumsum(n) - n)[0]
                yield pa.RecordBatch.from_arrays([piece.column("key"), piece.column("held_out"), pa.array(score, pa.float64())], ["key", "held_out", "score"])

    return run


def score_quality(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, threshold: float = 0.3) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted."""
    held = docs.sparkSession.sparkContext.broadcast(train(docs, labels, sample=sample))
    rows = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("key"), held_out().alias("held_out"), F.coalesce("text", F.lit("")).alias("text")
    )
    scored = rows.mapInArrow(_scored(held), "key long, held_out boolean, score double")
    return scored.select(id_of().alias("doc_id"), "held_out", "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
