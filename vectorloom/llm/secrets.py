"""Secrets in texts by DataFrame functions alone: fixed patterns, and a randomness test battery for other tokens.

Base spans, leftmost and not overlapping within a kind: ``assign`` (a password-like name, a sign, a value of 12 characters or
more), ``access`` (AKIA and at least 14 of A-Z0-9), ``hex`` (16 of 0-9a-f or more). A match that is too short is dropped, and the search goes
on behind it.

The method adds spans of kind ``random`` among tokens of at least 20 characters of the base64 alphabets:

1. The smallest alphabet that holds all characters is the inferred encoding (decimal, hex, letters, base32, 62 or 64 signs).
2. Three tests of the null hypothesis that the characters are independent and uniform over that alphabet: chi-squared
   on the counts (Wilson-Hilferty), runs above and below the middle, serial correlation at lag 1. Fisher's method
   joins them; a token with a joint p-value below ``UNIFORM_P`` is not random.
3. Short prose also passes such tests, so false discoveries are controlled against prose: the likelihood ratio of the
   uniform alphabet over the letter frequencies of all documents is an e-value, which grows with the length. Within each encoding and
   length band (powers of two) of m tokens, those with e >= m / (alpha * rank) are kept: the e-value form
   of Benjamini-Hochberg, with ranks counted in bins of one unit of ln e. It holds under any dependence.

Statistics go over all documents: one row of 66 sums, and a count per band and bin, both of fixed size. Matches, not texts, are
shuffled; places come from running sums of the lengths between matches, so long texts with many matches cost no more than linear work.

Defined cases: null text counts as empty; empty and clean texts have no span; repeated rows get the same
spans; further columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vectorloom.llm.keys import id_of, keyed
from vectorloom.session import stored

# The patterns of the base kinds, in the order of their kinds.
NAMES = r"(?i:(?:password|passwd|secret|token|api_?key))"
VALUE = r"[A-Za-z0-9+/_.=-]+"
PATTERNS = {
    "assign": NAMES + r"[\"']?\x20*[:=]\x20*[\"']?" + VALUE,
    "access": r"AKIA[A-Z0-9]+",
    "hex": r"[0-9a-f]{16,}",
    "random": r"[A-Za-z0-9+/_-]{20,}",
}
KINDS = list(PATTERNS)
MIN_ASSIGN, MIN_ACCESS = 12, 18
UNIFORM_P, ALPHA = 0.001, 0.01
#: Alphabets from small to large; the first that fits is the encoding.
ALPHABETS = {
    "decimal": string.digits, "hex": "0123456789abcdef", "hex_upper": "0123456789ABCDEF", "lower": string.ascii_lowercase,
    "upper": string.ascii_uppercase, "base32": string.ascii_uppercase + "234567", "lower36": string.digits + string.ascii_lowercase,
    "upper36": string.digits + string.ascii_uppercase, "letters": string.ascii_letters,
    "alnum": string.digits + string.ascii_letters, "base64": string.ascii_letters + string.digits + "+/",
    "base64url": string.ascii_letters + string.digits + "_-", "mixed": string.ascii_letters + string.digits + "+/_-",
}
SYMBOLS = string.ascii_letters + string.digits + "+/_-"


def _matches(rows: DataFrame) -> DataFrame:
    """(key, tag, kind, start, hit): every match of every pattern with its place in code points."""
    parts = []
    for kind, pattern in PATTERNS.items():
        some = F.col("text").rlike(pattern)
        gaps = F.transform(F.split("text", pattern, -1), lambda g: F.length(g))
        hits = F.regexp_extract_all("text", F.lit(pattern), F.lit(0))
        parts.append(F.when(some, F.struct(F.lit(kind).alias("kind"), F.slice(gaps, 1, F.size(hits)).alias("gaps"), hits.alias("hits"))))
    found = rows.withColumn("part", F.explode(F.array_compact(F.array(*parts)))).select(
        "key", "tag", "part.kind", F.posexplode(F.arrays_zip("part.gaps", "part.hits")).alias("i", "m")
    )
    # The same row given twice has the same matches: they count once.
    once = found.groupBy("key", "tag", "kind", "i").agg(F.first("m.gaps").alias("gap"), F.first("m.hits").alias("hit"))
    order = Window.partitionBy("key", "tag", "kind").orderBy("i")
    return once.select(
        "key", "tag", "kind", "hit",
        (F.sum(F.col("gap") + F.length("hit")).over(order) - F.length("hit")).alias("start"),
    )


def _tail(z: Column) -> Column:
    """Chance of a standard normal value above z, by the five-term approximation of the error function."""
    x = F.abs(z) / math.sqrt(2)
    t = 1 / (1 + 0.3275911 * x)
    poly = t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429))))
    half = 0.5 * poly * F.exp(-x * x)
    return F.greatest(F.when(z >= 0, half).otherwise(1 - half), F.lit(1e-300))


def _letter_logs(rows: DataFrame) -> dict[str, float]:
    """Log frequency of each symbol in all texts, by one aggregation."""
    sums = rows.agg(*[
        F.sum(F.octet_length("text") - F.octet_length(F.replace("text", F.lit(c), F.lit("")))).alias(f"c{i}")
        for i, c in enumerate(SYMBOLS)
    ]).first()
    return {c: math.log((sums[i] or 0) + 1) for i, c in enumerate(SYMBOLS)}


def _scored(tokens: DataFrame, logs: dict[str, float]) -> DataFrame:
    """Encoding, joint p-value of the battery and ln e of every token in ``hit``."""
    encoding, alphabet = F.lit(None).cast("string"), F.lit(None).cast("string")
    for name, signs in reversed(ALPHABETS.items()):
        fits = F.col("hit").rlike("^[" + "".join("\\" + c if c in "+/_-" else c for c in signs) + "]+$")
        encoding, alphabet = F.when(fits, name).otherwise(encoding), F.when(fits, signs).otherwise(alphabet)
    table = F.create_map(*[
        x for name, signs in ALPHABETS.items()
        for x in (F.lit(name), F.array(*[
            F.lit(math.log(sum(math.exp(logs[s]) for s in signs)) - logs[c] - math.log(len(signs))) for c in signs
        ]))
    ])
    df = tokens.withColumn("encoding", encoding).withColumn("alphabet", alphabet)
    df = df.withColumn("n", F.length("hit").cast("double")).withColumn("k", F.length("alphabet").cast("double"))
    df = df.withColumn("x", F.expr("transform(slice(split(hit, ''), 1, length(hit)), c -> locate(c, alphabet))"))
    df = df.withColumn("ratio", table[F.col("encoding")])
    df = df.withColumn("squares", F.expr(
        "aggregate(array_distinct(x), 0D, (s, c) -> s + power(size(filter(x, v -> v = c)), 2))"))
    df = df.withColumn("high", F.expr("cast(size(filter(x, v -> v > k / 2)) as double)"))
    df = df.withColumn("runs", F.expr(
        "1 + size(filter(sequence(1, size(x) - 1), i -> (element_at(x, i) > k / 2) != (element_at(x, i + 1) > k / 2)))"))
    df = df.withColumn("mean", F.expr("aggregate(x, 0D, (s, v) -> s + v) / n"))
    df = df.withColumn("spread", F.expr("aggregate(x, 0D, (s, v) -> s + (v - mean) * (v - mean))"))
    df = df.withColumn("lagged", F.expr(
        "aggregate(sequence(1, size(x) - 1), 0D, (s, i) -> s + (element_at(x, i) - mean) * (element_at(x, i + 1) - mean))"))
    df = df.withColumn("ln_e", F.expr("aggregate(x, 0D, (s, v) -> s + element_at(ratio, v))"))
    n, k, high = F.col("n"), F.col("k"), F.col("high")
    chi = k / n * F.col("squares") - n
    df_chi = k - 1
    p_chi = _tail((F.pow(F.greatest(chi, F.lit(0.0)) / df_chi, F.lit(1 / 3)) - (1 - 2 / (9 * df_chi))) / F.sqrt(2 / (9 * df_chi)))
    both = 2 * high * (n - high)
    p_runs = F.when(
        (high > 0) & (high < n) & (both > n),
        2 * _tail(F.abs((F.col("runs") - both / n - 1) / F.sqrt(both * (both - n) / (n * n * (n - 1))))),
    ).otherwise(F.lit(1e-12))
    p_lag = F.when(F.col("spread") > 0, 2 * _tail(F.abs(F.col("lagged") / F.col("spread") * F.sqrt(n) + 1 / F.sqrt(n)))).otherwise(
        F.lit(1e-12)
    )
    half = -(F.log(p_chi) + F.log(F.least(p_runs, F.lit(1.0))) + F.log(F.least(p_lag, F.lit(1.0))))
    return df.select(
        *tokens.columns, "encoding", F.floor(F.log2("n")).cast("int").alias("band"), "ln_e",
        (F.exp(-half) * (1 + half + half * half / 2)).alias("p_uniform"),
    )


def _discovered(scored: DataFrame, alpha: float, uniform_p: float) -> DataFrame:
    """Tokens that the battery takes for random and whose e-value stands the false-discovery rule of their band."""
    binned = scored.withColumn("bin", F.floor(F.greatest(F.least("ln_e", F.lit(700.0)), F.lit(0.0))).cast("int"))
    # At most 13 encodings x 31 bands x 701 bins.
    counts = binned.groupBy("encoding", "band", "bin").count()
    band = Window.partitionBy("encoding", "band")
    rank = F.sum("count").over(band.orderBy(F.desc("bin")))
    limits = (
        counts.select("encoding", "band", "bin", rank.alias("rank"), F.sum("count").over(band).alias("m"))
        .where(F.col("bin") >= F.log(F.col("m") / (alpha * F.col("rank"))))
        .groupBy("encoding", "band").agg(F.min("bin").alias("limit"))
    )
    return binned.join(F.broadcast(limits), ["encoding", "band"]).where(
        (F.col("bin") >= F.col("limit")) & (F.col("p_uniform") >= uniform_p)
    )


def secret_spans(rows: DataFrame, alpha: float = ALPHA, uniform_p: float = UNIFORM_P) -> DataFrame:
    """(key, tag, kind, start, end) of every secret in keyed rows; end is exclusive."""
    found = stored(_matches(rows), "matches")
    value = F.length(F.regexp_extract("hit", NAMES + r"[\"']?\x20*[:=]\x20*[\"']?(" + VALUE + ")", 1))
    base = found.where(
        ((F.col("kind") == "assign") & (value >= MIN_ASSIGN))
        | ((F.col("kind") == "access") & (F.length("hit") >= MIN_ACCESS))
        | (F.col("kind") == "hex")
    ).select("key", "tag", "kind", "hit", "start")
    # Stored, so that the filters above do not repeat the long expressions below them.
    scored = stored(_scored(found.where("kind = 'random'"), _letter_logs(rows)), "scored")
    added = _discovered(scored, alpha, uniform_p)
    return base.unionByName(added.select("key", "tag", "kind", "hit", "start")).select(
        "key", "tag", "kind", "start", (F.col("start") + F.length("hit")).alias("end")
    )


def _order(kind: str = "kind") -> Column:
    return F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col(kind))


def scan_secrets(docs: DataFrame, alpha: float = ALPHA, uniform_p: float = UNIFORM_P) -> DataFrame:
    """Per document: doc_id, n_assign, n_access, n_hex, n_random, base_sha256 and spans ('kind:start:end', by start and kind)."""
    rows = keyed(docs)
    found = secret_spans(rows, alpha, uniform_p)
    listed = found.groupBy("key", "tag").agg(
        *[F.count(F.when(F.col("kind") == k, 1)).alias(f"n_{k}") for k in KINDS],
        F.sort_array(F.collect_list(F.struct("start", _order().alias("o"), "kind", "end"))).alias("all"),
    )

    def joined(spans: str) -> Column:
        return F.expr(f"array_join(transform({spans}, s -> concat_ws(':', s.kind, s.start, s.end)), ',')")

    return rows.drop("text").join(listed, ["key", "tag"], "left").select(
        id_of().alias("doc_id"),
        *[F.coalesce(f"n_{k}", F.lit(0).cast("long")).alias(f"n_{k}") for k in KINDS],
        F.sha2(F.coalesce(joined("filter(all, s -> s.kind != 'random')"), F.lit("")), 256).alias("base_sha256"),
        F.coalesce(joined("all"), F.lit("")).alias("spans"),
    )


def mask_secrets(docs: DataFrame, mark: str = "[SECRET]", **settings) -> DataFrame:
    """The documents with every secret span (overlapping ones as one) replaced; n_chars follows the text where it is a column."""
    names = docs.columns
    found = secret_spans(keyed(docs), **settings)
    spans = found.groupBy("key", "tag").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("spans"))
    marked = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("key"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("tag"),
    )
    cut = F.expr(f"""
        aggregate(spans, named_struct('at', 0L, 'out', ''), (a, s) -> named_struct(
            'at', greatest(a.at, s.`end`),
            'out', if(s.start >= a.at, concat(a.out, substring(row.text, cast(a.at + 1 as int), cast(s.start - a.at as int)), '{mark}'), a.out)),
          a -> concat(a.out, substring(row.text, cast(a.at + 1 as int), length(row.text))))""")
    text = F.when(F.col("spans").isNull(), F.col("row.text")).otherwise(cut)
    new = marked.join(spans, ["key", "tag"], "left").select("row", text.alias("new"))
    return new.select(*[
        F.col("new").alias(c) if c == "text" else F.coalesce(F.length("new"), F.lit(0)).cast(docs.schema[c].dataType).alias(c)
        if c == "n_chars" else F.col(f"row.`{c}`") for c in names
    ])
