"""Registered queries of the training-data operators, and their SQL where SQL can state them."""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vectorloom.llm.decontaminate import find_leaks
from vectorloom.llm.exact_dedup import exact_groups
from vectorloom.llm.language_id import identify
from vectorloom.llm.merkle import leaf, manifest
from vectorloom.llm.ngram_join import ngram_classes
from vectorloom.llm.periodic_runs import find_runs, strongest
from vectorloom.llm.piece_sampling import round_trip
from vectorloom.llm.quality import score_quality
from vectorloom.llm.secrets import scan_secrets
from vectorloom.llm.substring_dedup import dedup_passages
from vectorloom.llm.toxicity import score_toxicity
from vectorloom.llm.vector_dedup import near_vectors
from vectorloom.llm.warc import read_pages, write_pages
from vectorloom.session import new_folder


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_classes(_table(spark, folder, "documents")).select("doc_id", "class_id", "n_links")


def op2_warc(spark: SparkSession, folder: str) -> DataFrame:
    path = new_folder(spark, "archive")
    write_pages(_table(spark, folder, "pages"), path)
    return read_pages(spark, path)


def op3_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return scan_secrets(_table(spark, folder, "documents"))


def op4_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = find_leaks(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))
    return found.select("doc_id", "item_id", F.round("similarity", 9).alias("similarity"))


def op5_vector_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_vectors(_table(spark, folder, "embeddings"))


def op6_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    found = score_toxicity(_table(spark, folder, "documents"), _table(spark, folder, "labels"))
    return found.select("doc_id", "held_out", "score", "predicted")


def op7_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return dedup_passages(_table(spark, folder, "documents"))


def op8_piece_sampling(spark: SparkSession, folder: str) -> DataFrame:
    """Sampled ids, and a digest of what they decode to beside that of the text."""
    coded = round_trip(_table(spark, folder, "documents").select("doc_id", "text"))
    return coded.select("doc_id", "ids", F.size("ids").cast("long").alias("n_ids"), F.sha2("decoded", 256).alias("decoded_sha256"), "lossless")


def op9_quality(spark: SparkSession, folder: str) -> DataFrame:
    return score_quality(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op10_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return identify(_table(spark, folder, "documents"))


def op11_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Every row with its proof; of the rows whose id's crc32 three divides, the leaf of the lowered text is checked."""
    docs = _table(spark, folder, "documents")
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    found = leaf([F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), lowered])
    return manifest(docs, altered=F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, found))


def _planted(doc_id: int | None, n: int) -> np.ndarray | None:
    """Of every tenth id the words from some place on are repeated: the numbers of the words to read instead."""
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    p, i = 1 + (n - a) // (3 + g % 8), np.arange(n)
    return np.where(i < a, i, a + (i - a) % p)


def op12_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    found = find_runs(_table(spark, folder, "documents"), rewrite=_planted).withColumn("best", strongest())
    lines = F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n")))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"), F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_groups(_table(spark, folder, "documents")).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


QUERIES = {f.__name__: f for f in (op1_ngram_jaccard, op2_warc, op3_secret_scan, op4_decontamination, op5_vector_dedup, op6_toxicity, op7_substring_dedup, op8_piece_sampling, op9_quality, op10_language_id, op11_merkle_manifest, op12_periodic_runs, op13_exact_dedup)}


def _words(column: str) -> str:
    """Plain words in DuckDB: A-Z lowered, cut at ASCII characters that are neither letters nor digits."""
    lower = f"translate(coalesce({column}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"regexp_extract_all({lower}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"


_SHINGLES = """
    w AS (SELECT doc_id, {words} AS w FROM documents),
    sh AS (SELECT DISTINCT doc_id, CASE WHEN len(w) < 5 THEN list_aggregate(w, 'string_agg', ' ')
           ELSE list_aggregate(w[i:i + 4], 'string_agg', ' ') END AS s
           FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM w WHERE len(w) > 0))
""".format(words=_words("text"))

#: Pairs by shared shingles, then classes by walking the links.
_NGRAM = f"""
WITH RECURSIVE {_SHINGLES},
    n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
    shared AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM sh a JOIN sh b USING (s) WHERE a.doc_id <> b.doc_id GROUP BY 1, 2),
    links AS (SELECT x, y FROM shared JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y
              WHERE c >= 0.8 * (nx.n + ny.n - c) - 1e-6),
    walk AS (SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT walk.x, links.y FROM walk JOIN links ON links.x = walk.y)
SELECT d.doc_id, (SELECT min(y) FROM walk WHERE walk.x = d.doc_id) AS class_id,
       (SELECT count(*) FROM links WHERE links.x = d.doc_id) AS n_links
FROM documents d
"""

_LIST = "CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [list_aggregate(w, 'string_agg', ' ')] ELSE " \
    "list_transform(range(1, len(w) - 3), lambda i: list_aggregate(w[i:i + 4], 'string_agg', ' ')) END"

#: All windows of the documents that share a shingle with the item, by weighted similarity.
_LEAKS = f"""
WITH d AS (SELECT doc_id, {_LIST} AS sh FROM (SELECT doc_id, {_words("text")} AS w FROM documents)),
    i AS (SELECT item_id, {_LIST} AS ish FROM (SELECT item_id, {_words("text")} AS w FROM benchmark)),
    ds AS (SELECT DISTINCT doc_id, unnest(sh) AS s FROM d), iw AS (SELECT item_id, s, count(*) AS ci FROM
           (SELECT item_id, unnest(ish) AS s FROM i) GROUP BY 1, 2),
    pairs AS (SELECT DISTINCT doc_id, item_id FROM ds JOIN iw USING (s)),
    win AS (SELECT doc_id, item_id, sh, len(ish) AS n, unnest(range(1, greatest(len(sh) - len(ish) + 1, 1) + 1)) AS b
            FROM pairs JOIN d USING (doc_id) JOIN i USING (item_id)),
    wc AS (SELECT doc_id, item_id, b, n, m, s, count(*) AS c FROM (SELECT doc_id, item_id, b, n, len(sh[b:b + n - 1]) AS m,
           unnest(sh[b:b + n - 1]) AS s FROM win) GROUP BY ALL),
    sim AS (SELECT doc_id, item_id, b, any_value(n) + any_value(m) AS total, sum(least(c, ci)) AS common
            FROM wc JOIN iw USING (item_id, s) GROUP BY 1, 2, 3)
SELECT doc_id, item_id, round(max(common / (total - common)), 9) AS similarity FROM sim GROUP BY 1, 2
HAVING max(common / (total - common)) >= 0.8
"""

#: crc32 of the decimal id, bit by bit.
_CRC = (
    "xor(list_reduce([4294967295::BIGINT] || list_transform(string_split(doc_id::VARCHAR, ''), lambda ch: ord(ch)::BIGINT), lambda c, b: "
    "list_reduce([xor(c, b)] || range(8), lambda x, i: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384::BIGINT) ELSE x // 2 END)), 4294967295::BIGINT)"
)


def _leaf(text: str) -> str:
    values = ("doc_id", "source", "lang", "n_chars", text)
    return "sha256(" + " || ".join(f"coalesce(strlen(({v})::VARCHAR)::VARCHAR || ':' || ({v})::VARCHAR, '-')" for v in values) + ")"


_TAMPERED = f"CASE WHEN {_CRC} % 3 = 0 THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END"

#: Levels of every tree by recursion; each node with the digests left and right of it in its run; then every leaf upwards.
_MERKLE = f"""
WITH RECURSIVE leaves AS (
        SELECT doc_id, coalesce('=' || lang, '') AS g, {_leaf("text")} AS leaf, {_leaf(_TAMPERED)} AS found FROM documents),
    placed AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM leaves),
    up AS (SELECT g, 0 AS level, pos, leaf AS digest, count(*) OVER (PARTITION BY g) AS n FROM placed
           UNION ALL
           SELECT g, level + 1, pos // 8, sha256(string_agg(digest, '' ORDER BY pos)), any_value((n + 7) // 8)
           FROM up WHERE n > 1 GROUP BY g, level, pos // 8),
    subroots AS (SELECT g, digest AS subroot FROM up WHERE n = 1),
    tops AS (SELECT 0 AS level, row_number() OVER (ORDER BY encode(g)) - 1 AS pos, subroot AS digest, count(*) OVER () AS n, g FROM subroots),
    above AS (SELECT level, pos, digest, n FROM tops
              UNION ALL
              SELECT level + 1, pos // 8, sha256(string_agg(digest, '' ORDER BY pos)), any_value((n + 7) // 8)
              FROM above WHERE n > 1 GROUP BY level, pos // 8),
    nodes AS (SELECT g, level, pos, digest, n FROM up UNION ALL SELECT NULL, level, pos, digest, n FROM above),
    sided AS (SELECT *, coalesce(string_agg(digest, '') OVER (run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
                     coalesce(string_agg(digest, '') OVER (run ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS behind
              FROM nodes WHERE n > 1 WINDOW run AS (PARTITION BY g, level, pos // 8 ORDER BY pos)),
    inner_walk AS (SELECT placed.doc_id, placed.g, placed.leaf, 0 AS level, pos, found AS now, '' AS siblings FROM placed
              UNION ALL
              SELECT w.doc_id, w.g, w.leaf, w.level + 1, w.pos // 8, sha256(s.before || w.now || s.behind), w.siblings || s.before || s.behind
              FROM inner_walk w JOIN sided s ON s.g = w.g AND s.level = w.level AND s.pos = w.pos),
    inside AS (SELECT doc_id, g, leaf, arg_max(now, level) AS now, arg_max(siblings, level) AS siblings
               FROM inner_walk GROUP BY doc_id, g, leaf),
    outer_walk AS (SELECT i.doc_id, i.g, i.leaf, 0 AS level, t.pos, i.now, i.siblings FROM inside i JOIN tops t USING (g)
              UNION ALL
              SELECT w.doc_id, w.g, w.leaf, w.level + 1, w.pos // 8, sha256(s.before || w.now || s.behind), w.siblings || s.before || s.behind
              FROM outer_walk w JOIN sided s ON s.g IS NULL AND s.level = w.level AND s.pos = w.pos),
    done AS (SELECT doc_id, g, leaf, arg_max(now, level) AS now, arg_max(siblings, level) AS siblings FROM outer_walk GROUP BY doc_id, g, leaf)
SELECT d.doc_id, d.leaf, s.subroot, r.digest AS root, sha256(d.siblings) AS proof_sha256, d.now AS folded_root, d.now = r.digest AS verified
FROM done d JOIN subroots s USING (g), (SELECT digest FROM above WHERE n = 1) r
"""

_EXACT = """
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS chars, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents),
    b AS (SELECT *, row_number() OVER (PARTITION BY norm ORDER BY chars DESC, doc_id) AS r, count(*) OVER (PARTITION BY norm) AS group_size,
                 first_value(doc_id) OVER (PARTITION BY norm ORDER BY chars DESC, doc_id) AS keep_id FROM d)
SELECT doc_id, keep_id, group_size, r = 1 AS kept, sha256(norm) AS text_sha256 FROM b
"""

#: All pairs, then components by walking the links.
_VECTORS = """
WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
    links AS (SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
              WHERE list_cosine_similarity(a.e, b.e) >= 0.95),
    walk AS (SELECT vec_id AS x, vec_id AS y FROM v UNION SELECT walk.x, links.y FROM walk JOIN links ON links.x = walk.y),
    least AS (SELECT x, min(y) AS component_id FROM walk GROUP BY x), n AS (SELECT x, count(*) AS n FROM links GROUP BY x)
SELECT vec_id, coalesce(n.n, 0) AS n_links, component_id, component_id = vec_id AS kept
FROM v JOIN least ON least.x = vec_id LEFT JOIN n ON n.x = vec_id
"""

#: Every window of 20 words by its text; those that also start earlier cover the words that go.
_PASSAGES = """
WITH d AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w FROM documents),
    win AS (SELECT doc_id, i, list_aggregate(w[i:i + 19], 'string_agg', ' ') AS s
            FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM d WHERE len(w) >= 20)),
    late AS (SELECT doc_id, i FROM win QUALIFY row_number() OVER (PARTITION BY s ORDER BY doc_id, i) > 1),
    gone AS (SELECT doc_id, list_distinct(flatten(list(range(i, i + 20)))) AS g FROM late GROUP BY doc_id),
    kept AS (SELECT doc_id, w, coalesce(len(g), 0) AS n_removed,
             CASE WHEN g IS NULL THEN w ELSE list_transform(list_sort(list_filter(range(1, len(w) + 1), lambda k: NOT list_contains(g, k))), lambda k: w[k]) END AS k
             FROM d LEFT JOIN gone USING (doc_id))
SELECT doc_id, len(w) AS n_words, n_removed, sha256(coalesce(list_aggregate(k, 'string_agg', ' '), '')) AS kept_sha256 FROM kept
"""

#: A SHA-1 in base32: five hex digits are four characters.
_WARC = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
    b AS (SELECT *, max(page_id) OVER (PARTITION BY html) AS last,
          list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
            ((('0x' || substr(h, (5 * (i // 4) + 1)::INT, 5))::BIGINT >> (15 - 5 * (i % 4))::INT) % 32 + 1)::INT, 1)), 'string_agg', '') AS digest FROM p)
SELECT page_id, strlen(html) AS payload_bytes, digest AS payload_digest, CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> last THEN last END AS refers_to FROM b
"""

ORACLE: dict[str, str] = {
    "op2_warc": _WARC, "op5_vector_dedup": _VECTORS, "op7_substring_dedup": _PASSAGES,
    "op4_decontamination": _LEAKS, "op1_ngram_jaccard": _NGRAM, "op11_merkle_manifest": _MERKLE, "op13_exact_dedup": _EXACT,
}
