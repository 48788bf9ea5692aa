"""Restoring disguised words and scores on the held-out fold."""

import itertools
import zlib

import numpy as np
import pyarrow as pa
import pytest

from vectorloom.llm import toxicity as T
from vectorloom.llm.toxicity import drop_toxic, language_model, restored_words, run_candidates, score_toxicity, token_facts, word_candidates
from vectorloom.llm.words import RAW, signed, words_of

SCHEMA = "doc_id long, text string, y int"
DISGUISED = ["idi0t", "id1ot", "i.d.i.o.t", "m0r0n", "$tupid", "stuuuupid", "tr@sh", "l0$er", "cl0wn", "w0rthle$s", "m-o-r-o-n"]


@pytest.fixture(scope="module")
def tables(spark):
    folder = "/root/testdata/sf0.1"
    return spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")


@pytest.fixture(scope="module")
def model(tables):
    return language_model(tables[0])


def test_language_model_counts_every_text(spark):
    texts = [None, "", "ab AB", "a1b é" * 3000]
    m = language_model(spark.createDataFrame([(i, t, 0) for i, t in enumerate(texts)], SCHEMA))
    assert m.shape == (28, 28, 28) and np.allclose(np.exp(m).sum(2), 1)


def key_of(text):
    return int(T._keys(pa.array([text]))[0][0])


def brute(chars, model, best, longest=10**9):
    """Hash -> (channel, letters) of the best texts over all paths; ``chars``: (sign, log-probability of silence) in order."""
    ways = []
    for i, (c, silent) in enumerate(chars):
        letter = c.isalpha()
        own = [(c, 0.0)] if letter else [(x, T.SIGN - np.log(len(T.LEET[c]))) for x in T.LEET.get(c, "")]
        if silent is not None:
            own.append(("", silent))
        if i and chars[i - 1][0] == c and (letter or c in T.LEET):
            own.append(("", T.REPEAT))
        ways.append(own)
    found = {}
    symbol = lambda x: ord(x) - 96 if x < "\x80" else 27
    for path in itertools.product(*ways):
        text = "".join(x[0] for x in path)
        short = "".join(x for i, x in enumerate(text) if i == 0 or text[i - 1] != x or x >= "\x80")
        if not text or len(short.encode()) > longest:
            continue
        letters, a, b = 0.0, 0, 0
        for x in text:
            letters, a, b = letters + model[a, b, symbol(x)], b, symbol(x)
        letters += model[a, b, 0]
        score = letters + sum(x[1] for x in path)
        if short not in found or score > found[short][0]:
            found[short] = (score, letters)
    ranked = sorted(found.items(), key=lambda x: -x[1][0])[:best]
    return {key_of(t): (s - m, m) for t, (s, m) in ranked}


def close(got, want):
    assert got.keys() == want.keys() and all(np.allclose(got[k], want[k]) for k in want), (got, want)


def test_words_are_the_best_of_all_paths(model):
    tokens = ["idi0t", "1d0", "a$3", "b.b", "ss1", "0*x", "$$$a", "é1é", "!!", "(ab", "aab!", "x", "i.d.i.o.t", "lll", "*a*", "77"]
    which, word, said, letters = word_candidates(tokens, model)
    for i, t in enumerate(tokens):
        inner = t.strip(T._DECOR + ".,;:?\"')[]{}>-_~^=/\\`&")
        lo = t.find(inner) if inner else len(t)
        hi = lo + len(inner) if inner else 0
        silence = [None if c.isalpha() else T.FILLER if c not in T.LEET else T.EDGE if c in T._DECOR and not lo <= k < hi else T.LOST for k, c in enumerate(t)]
        at = np.flatnonzero(which == i)
        close({int(word[k]): (said[k], letters[k]) for k in at}, brute(list(zip(t, silence)), model, T.BEST))
    plain = {"idiot", "moron", "stupid", "trash", "loser", "clown", "worthless"}
    which, word, said, letters = word_candidates(DISGUISED, model)
    first = [int(word[np.flatnonzero(which == i)][np.argmax((said + letters)[which == i])]) for i in range(len(DISGUISED))]
    assert set(first) <= {key_of(w) for w in plain}
    assert len(word_candidates([], model)[0]) == 0


def test_stretches_of_runs(model):
    runs = ["a m 0 r", "s, t u", "1 ! i", "a . b -", "é x x"]
    got = {}
    for lot in run_candidates(runs, model, 3):
        for r, a, b, word, said, letters in zip(*lot):
            got.setdefault((int(r), int(a), int(b)), {})[int(word)] = (said, letters)
    for i, r in enumerate(runs):
        units = r.split(" ")
        for a in range(len(units)):
            for b in range(a + 1, len(units) + 1):
                chars = [(c, None if c.isalpha() else T.FILLER if c not in T.LEET else T.EDGE if len(u) > 1 and c in T._DECOR else None) for u in units[a:b] for c in u]
                close(got.get((i, a, b), {}), brute(chars, model, T.BEST_IN_RUN, 3))


def test_long_tokens_are_decoded_whole(model):
    tokens = ["st" + "u" * 5000 + "pid", "-".join("worthless" * 300), "1" * 3000]
    which, word, _, _ = word_candidates(tokens, model)
    assert key_of("stupid") in word[which == 0].tolist() and key_of("worthles" * 300) in word[which == 1].tolist() and (which == 2).any()


def test_best_path_of_a_token():
    """Against every way through random stretches."""
    rng = np.random.default_rng(2)
    rows, want = [], set()
    for th in range(40):
        n = int(rng.integers(1, 7))
        spans = [(a, b, int(rng.integers(1, 1 << 40)) if rng.random() < 0.9 else None, float(rng.normal())) for a in range(n) for b in range(a + 1, n + 1)
                 for _ in range(2) if b == a + 1 or rng.random() < 0.6]
        ways = {0: [(0.0, ())]}
        for b in range(1, n + 1):
            ways[b] = [(v + x, w + (t,)) for a, e, t, x in spans if e == b for v, w in ways[a]]
        want |= {(th, w) for w in max(ways[n])[1] if w is not None} if all(t is not None for _, w in ways[n] for t in w) else \
            {(th, w) for w in max(ways[n], key=lambda x: x[0])[1] if w is not None}
        rows += sorted([(th, *s) for s in spans], key=lambda r: r[:3])
    columns = [pa.array(list(c), k) for c, k in zip(zip(*rows), (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.float64()))]
    batch = pa.RecordBatch.from_arrays(columns, ["th", "a", "b", "word", "value"])
    got = [x for out in T._choice_rows(iter([batch.slice(0, 7), batch.slice(7)])) for x in zip(*(c.to_pylist() for c in out.columns))]
    assert set(got) == want


def test_discovery_rule():
    z = np.array([6.0, 5.0, 4.5, 3.4, 3.3])
    assert T.discovered(z, 10, 0.01) == 3.3 and T.discovered(z, 1000, 0.01) == 4.5 and T.discovered(z[-1:], 10**6, 0.01) == np.inf
    assert abs(T._tail(0.05) - 1.959964) < 1e-5


def test_fit_is_that_of_dense_newton_steps():
    rng = np.random.default_rng(6)
    x = (rng.random((400, 12)) < 0.2).astype(float)
    y = (rng.random(400) < 1 / (1 + np.exp(-(x @ rng.normal(size=12) * 2 - 1)))).astype(float)
    penalty, w, full = rng.random(12) + 0.1, np.zeros(13), np.column_stack([x, np.ones(400)])
    for _ in range(30):
        p = 1 / (1 + np.exp(-(full @ w)))
        pull = np.append(penalty, 1e-6)
        w += np.linalg.solve((full.T * (p * (1 - p))) @ full + np.diag(pull), full.T @ (y - p) - pull * w)
    assert np.allclose(T.fit_logistic(*np.nonzero(x), y, penalty), w, atol=1e-6)


def test_held_out_accuracy_and_disguise(spark, tables, model):
    docs, labels = tables
    words = ["the", "and", "thing", "other"] * 20
    extra = spark.createDataFrame([(900_000 + i, " ".join(words[:40] + [t] + words[40:])) for i, t in enumerate([*DISGUISED, "l o s e r", "the"])],
                                  "doc_id long, text string")
    scored = score_toxicity(docs.select("doc_id", "text").unionByName(extra), labels)
    got = {r.doc_id: r for r in scored.collect()}
    rows = [(r.toxic, got[r.doc_id]) for r in labels.collect()]
    held = [(y, r.predicted) for y, r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r.score <= 1 for i, r in got.items())
    hits = sum(y and p for y, p in held)
    # Almost half of the positive labels are noise: their documents hold no toxic word.
    assert sum(p for _, p in held) - hits <= 2 and hits >= 0.5 * sum(y for y, _ in held)
    flags = [got[900_000 + i].predicted for i in range(len(DISGUISED) + 2)]
    assert sum(flags[:-1]) >= len(DISGUISED) - 1 and flags[-1] == 0, [got[900_000 + i].score for i in range(len(DISGUISED) + 2)]


def test_edges(spark, tables):
    labels = spark.createDataFrame([(i, i % 2, None) for i in range(1, 40)] + [(None, 1, 1), (2, 0, 0), (2, 1, 0)], "doc_id long, toxic int, key int")
    rows = [(i, "bad word here" if i % 2 else "fine words here", 0) for i in range(1, 40)] + [(None, None, 1), (50, "", 1), (50, "", 1), (51, "bad " * 50_000, 1)]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = score_toxicity(docs, labels).collect()
    assert len(got) == len(rows) and {r.doc_id: r.predicted for r in got}[51] == 1
    left = drop_toxic(docs, labels)
    assert left.columns == docs.columns and {r.doc_id for r in left.collect()} >= {4, 6, 8}
    assert score_toxicity(docs, labels.limit(0)).where("predicted = 1").count() == 0
    assert score_toxicity(docs.limit(0), labels).count() == 0


def test_keys_take_runs_once():
    a, _ = T._keys(pa.array(["Hello helo HELLO"]))
    assert len(set(a.tolist())) == 1


LONG_WORD = "donaudampfschifahrtsgeselschaftskapitaen"
CORPUS = [f"the {LONG_WORD} is it", "i think that you are a moron and i said it to the idiot", "a stupid plan of a clown in the trash", "the rap song is crap", "what an ass",
          "is it so that the loser went on to be worthless, as i said"] * 40
#: Text -> words that its disguised tokens stand for.
SPACED = {"you are a m o r o n": {"a", "moron"}, "s t u p i d i d i o t": {"stupid", "idiot"}, "m o r o n i am": {"moron", "i"}, "l o s e r": {"loser"},
          " ".join(LONG_WORD): {LONG_WORD}, "so " + " - ".join(LONG_WORD) + " it": {LONG_WORD}, "i m o r o n": {"i", "moron"}, "c l 0 w n, t r a s h.": {"clown", "trash"}, "s t u p i d " * 30: {"stupid"}}
SIGNS = {"!diot": {"idiot"}, "(rap song": {"rap"}, "@$$": {"ass"}, "455": {"ass"}, "idi0t!!!": {"idiot"}, "a$$$": {"ass"}, "#stupid*": {"stupid"},
         "i.d.i.o.t.": {"idiot"}, "<l0wn": {"clown"}, "plain, words (here": {"here"}}


def decoded(spark, texts):
    docs = spark.createDataFrame([(i, t, 0) for i, t in enumerate([*CORPUS, *texts])], SCHEMA).repartition(4)
    words = sorted({w for t in CORPUS for w in t.replace(",", "").split()} | {"here"})
    key, of = T._keys(pa.array(words, pa.large_string()))
    name = {}
    for k, i in zip(signed(key).tolist(), of.tolist()):
        name.setdefault(k, words[i])
    name[signed(T._keys(pa.array(["ass"]))[0])[0]] = "ass"
    found = {}
    tokens = spark.createDataFrame([(t, T._hash(x)) for t in texts for x in T._disguised(words_of(pa.array([t]), RAW))[1]], "text string, th long")
    rows = docs.selectExpr("doc_id key", "cast(y as long) tag", "text")
    held = restored_words(docs, token_facts(rows)[1], language_model(docs))
    for r in tokens.join(held, "th").collect():
        found.setdefault(r.text, set()).add(name.get(r.word, "?"))
    return found


def test_runs_are_cut_into_words(spark):
    """A spaced-out word beside 'a', 'i' or another one, and a run longer than a window."""
    got = decoded(spark, list(SPACED))
    assert {t: got[t] & w for t, w in SPACED.items()} == SPACED, got
    assert all(got[t] == w for t, w in SPACED.items() if len(t) < 100 and "0" not in t), got


def test_signs_at_the_ends_and_tokens_without_letters(spark):
    got = decoded(spark, list(SIGNS))
    assert got == SIGNS


def test_many_texts_with_disguise_are_found(spark, tables):
    docs, labels = tables
    base = " ".join(["the", "and", "thing", "other"] * 20)
    texts = [f"{base} {t} {base}" for t in ("a m o r o n", "s t u p i d i d i o t", "!diot", "+rash", "i d i o t a")]
    extra = spark.createDataFrame(list(enumerate([*texts, base + " (and thing! 455 2024", base], 900_000)), "doc_id long, text string")
    got = {r.doc_id: r.predicted for r in score_toxicity(docs.select("doc_id", "text").unionByName(extra), labels).where("doc_id >= 900000").collect()}
    assert [got[i] for i in sorted(got)] == [1] * len(texts) + [0, 0]


def test_letters_outside_ascii_are_one_symbol(spark):
    """In counting as in decoding, and texts do not run into each other."""
    m = language_model(spark.createDataFrame([(i, "aéb", 0) for i in range(500)], SCHEMA).coalesce(1))
    assert np.exp(m[1, 27, 2]) > 0.9 and np.exp(m[27, 2, 0]) > 0.9
