"""The same queries in ANSI SQL, over the given tables."""

from __future__ import annotations

_SPACE = (
    r"[\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
)
_TITLE = r"regexp_extract(text, '^[^\n]*', 0)"


def _clean(column: str) -> str:
    """Cleaning for texts without a backslash, which is all the given ones."""
    plain = rf"translate(regexp_replace({column}, '(^|[^\\])%[^\n]*', '\1', 'g'), '~&${{}}', '  ')"
    for source, target in (("---", "—"), ("--", "–"), ("``", "“"), ("''''", "”"), ("!`", "¡"), ("?`", "¿")):
        plain = f"replace({plain}, '{source}', '{target}')"
    return f"nullif(trim(regexp_replace({plain}, '{_SPACE}', ' ', 'g')), '')"


def _vectors(source: str, key: str, column: str, name: str) -> str:
    """CTEs for the hashed bag-of-words vectors of a text column."""
    return rf"""
    {name}_words AS (
      SELECT {key} AS k, unnest(string_split_regex(translate({column},
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ \t\n\r\x0b\x0c]+')) AS w
      FROM {source}),
    {name}_slots AS (
      SELECT k, ('0x' || substr(md5(w), 1, 8))::UBIGINT % 64 AS slot,
        sum(CASE WHEN substr(md5(w), 9, 1) IN ('0','1','2','3','4','5','6','7') THEN 1 ELSE -1 END)::DOUBLE AS s
      FROM {name}_words WHERE w <> '' GROUP BY ALL),
    {name}_full AS (
      SELECT d.k, r.slot, coalesce(s.s, 0) AS s
      FROM (SELECT {key} AS k FROM {source}) d CROSS JOIN (SELECT unnest(range(64)) AS slot) r
      LEFT JOIN {name}_slots s ON s.k = d.k AND s.slot = r.slot),
    {name} AS (
      SELECT k, list((s / greatest(n, 1e-12))::FLOAT ORDER BY slot)::DOUBLE[] AS v
      FROM (SELECT *, sqrt(sum(s * s) OVER (PARTITION BY k)) AS n FROM {name}_full) GROUP BY k)"""


_SILVER = f"""
    silver AS (
      SELECT doc_id::VARCHAR AS arxiv_id, {_clean(_TITLE)} AS title, {_clean('text')} AS abstract_clean,
        source AS authors, lang, source, TIMESTAMP '2020-01-01' + to_hours(doc_id) AS published
      FROM documents WHERE {_clean('text')} IS NOT NULL AND {_clean(_TITLE)} IS NOT NULL)"""
_QUESTIONS = _vectors("benchmark", "item_id", "text", "asked")

_SIZES = "(SELECT unnest([64, 32, 16, 8]) AS dim)"


def _ranked(vectors: str, queries: str, key: str, sizes: str, where: str = "true") -> str:
    """Rank by distance rounded to 12 places, then id."""
    cosine = "list_cosine_similarity(v.v[1:d.dim], q.v[1:d.dim])"
    return f"""
    pairs AS (
      SELECT q.k AS qid, d.dim, v.k AS vid, round(1 - {cosine}, 12) AS distance
      FROM {vectors} v CROSS JOIN {queries} q CROSS JOIN {sizes} d
      WHERE {where}),
    ranked AS (
      SELECT *, row_number() OVER (PARTITION BY qid, dim ORDER BY distance, vid) AS rank
      FROM pairs WHERE NOT isnan(distance) QUALIFY rank <= {key})"""


_STORED = "stored AS (SELECT vec_id AS k, embedding::DOUBLE[] AS v, label FROM embeddings)"
_MEANS = """
    means AS (
      SELECT label AS k, list(x ORDER BY pos) AS v FROM (
        SELECT label, pos, avg(x::DOUBLE) AS x
        FROM (SELECT label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings)
        GROUP BY label, pos) GROUP BY label)"""
_CENTRE = """
    centre AS (
      SELECT 0 AS k, list(x ORDER BY pos) AS v FROM (
        SELECT pos, avg(x::DOUBLE) AS x
        FROM (SELECT unnest(embedding) AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings)
        GROUP BY pos))"""

_FULL = "(SELECT 64 AS dim)"
_BY_LABEL = f"""
  WITH {_STORED}, {_MEANS}, {_ranked('stored', 'means', '10', '{sizes}')}
  SELECT qid AS label, dim, rank, vid AS vec_id, round(1 - distance, 4) AS score FROM ranked"""
_BY_LABEL_FULL = f"""
  WITH {_STORED}, {_MEANS}, {_ranked('stored', 'means', '10', _FULL)}
  SELECT qid AS label, rank, vid AS vec_id, round(1 - distance, 4) AS score FROM ranked"""
_CHECKED = r"""
  checked AS (
    SELECT doc_id, CASE WHEN lang = 'en' THEN '2401.' || doc_id ELSE lang || '/' || lpad(doc_id::VARCHAR, 7, '0') END AS paper_id,
      nullif(regexp_extract(text, '^[^\n]*', 0), '') AS title, text AS abstract, lang, n_chars
    FROM documents)"""
_EVERY_LAYER = f"""
  WITH {_SILVER}, s AS (SELECT count(*) AS n FROM silver)
  SELECT (SELECT count(*) FROM documents) AS bronze, n AS silver, n AS gold, 0 AS skipped, 1 AS empty_runs FROM s"""

ORACLE = {
    "text_search": f"""
      WITH {_SILVER}, {_vectors('silver', 'arxiv_id', 'abstract_clean', 'gold')}, {_QUESTIONS},
      {_ranked('gold', 'asked', '10', _FULL)}
      SELECT qid AS query_id, rank, arxiv_id, title, authors, round(1 - distance, 4) AS score,
        'https://arxiv.org/abs/' || arxiv_id AS arxiv_url, 'https://arxiv.org/pdf/' || arxiv_id AS pdf_url
      FROM ranked JOIN silver ON arxiv_id = vid""",
    "text_search_filtered": f"""
      WITH {_SILVER}, kept AS (
        SELECT * FROM silver WHERE (lang IN ('fr', 'src3') OR source IN ('fr', 'src3')) AND published >= DATE '2020-01-15'),
      {_vectors('kept', 'arxiv_id', 'abstract_clean', 'gold')}, {_QUESTIONS},
      {_ranked('gold', 'asked', '10', _FULL)}
      SELECT qid AS query_id, rank, vid AS arxiv_id, round(1 - distance, 4) AS score FROM ranked""",
    "vector_topk_multi": _BY_LABEL.replace("{sizes}", _SIZES),
    "vector_topk_single": f"""
      WITH {_STORED}, {_CENTRE}, {_ranked('stored', 'centre', '10', _FULL)}
      SELECT rank, vid AS vec_id, round(1 - distance, 4) AS score FROM ranked""",
    "vector_topk_all_cells": _BY_LABEL_FULL,
    "vector_topk_approx": f"""
      WITH {_STORED}, {_MEANS},
      cells AS (
        SELECT s.k, s.v, m.k AS cell FROM stored s CROSS JOIN means m
        QUALIFY row_number() OVER (PARTITION BY s.k ORDER BY round(list_cosine_similarity(s.v, m.v), 12) DESC, m.k) = 1),
      probes AS (
        SELECT q.k AS qid, q.v, m.k AS cell FROM means q CROSS JOIN means m
        QUALIFY row_number() OVER (PARTITION BY q.k ORDER BY round(list_cosine_similarity(q.v, m.v), 12) DESC, m.k) <= 3),
      ranked AS (
        SELECT qid, c.k AS vid, round(1 - list_cosine_similarity(c.v, p.v), 12) AS distance,
          row_number() OVER (PARTITION BY qid ORDER BY round(1 - list_cosine_similarity(c.v, p.v), 12), c.k) AS rank
        FROM probes p JOIN cells c USING (cell) QUALIFY rank <= 10)
      SELECT qid AS label, rank, vid AS vec_id, round(1 - distance, 4) AS score FROM ranked""",
    "vector_topk_pq": f"""
      WITH {_STORED}, {_MEANS},
      unit AS (SELECT k, v, list_transform(v, lambda x: x / sqrt(list_dot_product(v, v))) AS u FROM stored),
      centres AS (SELECT k AS cell, v, list_transform(v, lambda x: x / sqrt(list_dot_product(v, v))) AS c FROM means),
      placed AS (
        SELECT s.k, s.u, m.cell, m.c FROM unit s CROSS JOIN centres m
        QUALIFY row_number() OVER (PARTITION BY s.k ORDER BY round(list_cosine_similarity(s.v, m.v), 12) DESC, m.cell) = 1),
      left_over AS (SELECT k, cell, list_transform(list_zip(u, c), lambda z: z[1] - z[2]) AS r FROM placed),
      parts AS (SELECT k, cell, p, r[8 * p + 1 : 8 * p + 8] AS r FROM left_over CROSS JOIN (SELECT unnest(range(8)) AS p)),
      words AS (SELECT p, r AS w, row_number() OVER (PARTITION BY p ORDER BY k) AS code FROM parts QUALIFY code <= 16),
      codes AS (
        SELECT a.k, a.cell, a.p, w.w FROM parts a JOIN words w USING (p)
        QUALIFY row_number() OVER (PARTITION BY a.k, a.p ORDER BY round(list_distance(a.r, w.w) ** 2, 12), w.code) = 1),
      probes AS (
        SELECT q.cell AS qid, q.v, m.cell, list_transform(list_zip(q.c, m.c), lambda z: z[1] - z[2]) AS r FROM centres q CROSS JOIN centres m
        QUALIFY row_number() OVER (PARTITION BY q.cell ORDER BY round(list_cosine_similarity(q.v, m.v), 12) DESC, m.cell) <= 3),
      near AS (
        SELECT qid, c.k, round(sum(list_distance(b.r[8 * p + 1 : 8 * p + 8], c.w) ** 2), 12) AS d
        FROM probes b JOIN codes c USING (cell) GROUP BY qid, c.k),
      short AS (SELECT qid, k FROM near QUALIFY row_number() OVER (PARTITION BY qid ORDER BY d, k) <= 50),
      ranked AS (
        SELECT t.qid, t.k AS vid, round(1 - list_cosine_similarity(s.v, m.v), 12) AS distance,
          row_number() OVER (PARTITION BY t.qid ORDER BY round(1 - list_cosine_similarity(s.v, m.v), 12), t.k) AS rank
        FROM short t JOIN stored s ON s.k = t.k JOIN means m ON m.k = t.qid QUALIFY rank <= 10)
      SELECT qid AS label, rank, vid AS vec_id, round(1 - distance, 4) AS score FROM ranked""",
    "vector_recall": """
      SELECT count(*) FILTER (WHERE vec_id % 100 = 0) AS queries,
        count(*) FILTER (WHERE vec_id % 100 = 0) * least(10, count(*)) AS answers, true AS enough FROM embeddings""",
    "notified_stream": """
      SELECT 'loaded' AS state, doc_id::VARCHAR AS name, md5(text) AS text_md5 FROM documents
      UNION ALL SELECT DISTINCT 'file not found', source || '-' || wave || '.jsonl', NULL FROM documents CROSS JOIN (SELECT unnest(range(3)) AS wave)""",
    "first_wins_many_files": """
      WITH w AS (SELECT source, min(doc_id) AS winner FROM documents GROUP BY source)
      SELECT way, source AS arxiv_id, winner, md5(text) AS text_md5
      FROM w JOIN documents d USING (source) CROSS JOIN (VALUES ('batch'), ('stream')) v(way) WHERE d.doc_id = winner""",
    "stream_first_wins_state": """
      WITH w AS (SELECT source || '-' || (doc_id % 5) AS arxiv_id, doc_id, text,
          row_number() OVER (PARTITION BY source, doc_id % 5 ORDER BY CASE WHEN doc_id % 3 = 0 AND doc_id % 5 <> 4 THEN 0 ELSE 1 END, doc_id) AS r
        FROM documents)
      SELECT arxiv_id, doc_id AS winner, md5(text) AS text_md5 FROM w WHERE r = 1""",
    "full_then_incremental": """
      WITH l AS (
        SELECT 'before' AS state, doc_id, CASE WHEN doc_id % 4 <> 3 THEN 'full 1' WHEN doc_id % 8 <> 7 THEN 'more 1' ELSE 'more 2' END AS load FROM documents
        UNION ALL SELECT 'after', doc_id, CASE WHEN lang <> 'fr' THEN 'full 2' ELSE 'more 3' END FROM documents)
      SELECT state, doc_id, load FROM l""",
    "resumed_after_failure": f"""
      WITH {_SILVER}, s AS (SELECT count(*) AS n FROM silver), d AS (SELECT count(*) AS n FROM documents)
      SELECT 'failed' AS status, 1 AS runs, d.n AS bronze, 0 AS gold, s.n AS silver FROM s, d
      UNION ALL SELECT 'success', 1, 0, s.n, s.n FROM s""",
    "archived_files": """
      SELECT lang || CASE WHEN doc_id % 2 = 0 THEN '.jsonl' ELSE '_1.jsonl' END AS file, count(*) AS rows FROM documents GROUP BY 1
      UNION ALL SELECT 'loaded from ' || lang || '.jsonl', count(*) FROM documents GROUP BY 1""",
    "seeded_states": """
      SELECT source || '/' || doc_id AS key, CASE WHEN lang <> 'fr' THEN true END AS day_back,
        CASE WHEN lang = 'fr' THEN strftime(TIMESTAMP '2020-01-01' + to_hours(doc_id), '%Y-%m-%d %H:%M:%S') END AS value, 0 AS added_twice FROM documents""",
    "test_set_scores": f"""
      WITH {_SILVER}, {_vectors('silver', 'arxiv_id', 'abstract_clean', 'gold')},
      cases AS (SELECT arxiv_id, left(abstract_clean, 80) AS query FROM silver WHERE arxiv_id::BIGINT % 100 = 0),
      {_vectors('cases', 'arxiv_id', 'query', 'asked')}, {_ranked('gold', 'asked', '10', _SIZES)},
      placed AS (
        SELECT t.arxiv_id, d.dim, coalesce(r.rank, 11) AS rank FROM cases t CROSS JOIN {_SIZES} d
        LEFT JOIN ranked r ON r.qid = t.arxiv_id AND r.dim = d.dim AND r.vid = t.arxiv_id)
      SELECT dim, count(*) AS queries, round(avg((rank <= 1)::INT), 6) AS accuracy,
        round(avg(rank), 6) AS avg_rank, round(avg(1.0 / rank), 6) AS mrr FROM placed GROUP BY dim""",
    "vector_topk_pruned": f"""
      WITH {_STORED}, {_ranked('stored', 'stored', '10', _FULL)}
      SELECT qid AS query_id, rank, vid AS vec_id, round(1 - distance, 4) AS score FROM ranked""",
    "latex_clean": r"""
      WITH f AS (SELECT doc_id, source, lang, regexp_extract(text, '^[A-Za-z]*') AS word FROM documents)
      SELECT doc_id AS id,
        trim(regexp_replace(source || ' ' || lang || ' ' || doc_id || '/√(' || word || ') <cit.> été 50% $' || doc_id || ' <ref> ' || word || ' α '
        || list_aggregate(list_reverse(range(1, doc_id % 8 + 2)), 'string_agg', '/') || '/x', ' +', ' ', 'g')) AS cleaned,
        upper(substr('\textbf{' || source, 1, 12)) AS swapped FROM f""",
    "vector_distance": f"""
      WITH {_MEANS}
      SELECT vec_id, label, round(1 - c, 6) AS distance, round(c, 4) + 0.0::DOUBLE AS score FROM (
        SELECT vec_id, label, list_cosine_similarity(embedding::DOUBLE[], v) AS c
        FROM embeddings JOIN means ON k = label)""",
    "vector_text": """
      SELECT vec_id, len(embedding) AS size, round(embedding[1]::DOUBLE, 6) AS first, round(embedding[-1]::DOUBLE, 6) AS last,
        len(embedding) - 1 AS commas, true AS same FROM embeddings""",
    "matryoshka_dims": f"""
      WITH heads AS (SELECT vec_id, dim, embedding[1:dim]::DOUBLE[] AS h FROM embeddings CROSS JOIN {_SIZES}),
      lengths AS (SELECT *, sqrt(list_sum(list_transform(h, lambda x: x * x))) AS n FROM heads),
      scaled AS (
        SELECT vec_id, dim, CASE WHEN dim = 64 THEN h
          ELSE list_transform(h, lambda x: (x / greatest(n, 1e-12))::FLOAT)::DOUBLE[] END AS v FROM lengths)
      SELECT vec_id, dim, len(v) AS size, round(sqrt(list_sum(list_transform(v, lambda x: x * x))), 4) AS length,
        round(v[1], 4) + 0.0::DOUBLE AS first, round(v[2], 4) + 0.0::DOUBLE AS second FROM scaled""",
    "hash_encoder": f"""
      WITH {_vectors('documents', 'doc_id', 'text', 'unused')},
      heads AS (
        SELECT k, dim, list(s ORDER BY slot) AS h, sqrt(sum(s * s)) AS n
        FROM unused_full JOIN {_SIZES} ON slot < dim GROUP BY k, dim),
      full_length AS (SELECT k, n AS fn FROM heads WHERE dim = 64),
      unit AS (
        SELECT k, dim, list_transform(h, lambda x: x / greatest(fn, 1e-12)) AS u FROM heads JOIN full_length USING (k)),
      lengths AS (SELECT *, sqrt(list_sum(list_transform(u, lambda x: x * x))) AS un FROM unit),
      scaled AS (
        SELECT k, dim, list_transform(u, lambda x: (CASE WHEN dim = 64 THEN x ELSE x / greatest(un, 1e-12) END)::FLOAT)::DOUBLE[] AS v
        FROM lengths)
      SELECT k AS doc_id, dim, round(sqrt(list_sum(list_transform(v, lambda x: x * x))), 4) AS length,
        round(v[1], 4) + 0.0::DOUBLE AS first, round(v[len(v)], 4) + 0.0::DOUBLE AS last,
        round(list_sum(v), 4) + 0.0::DOUBLE AS total FROM scaled""",
    "retrieval_metrics": f"""
      WITH {_SILVER}, {_vectors('silver', 'arxiv_id', 'abstract_clean', 'gold')}, {_QUESTIONS},
      {_ranked('gold', 'asked', '10', _SIZES)},
      truth AS (SELECT qid, vid FROM ranked WHERE dim = 64 AND rank = 1),
      placed AS (
        SELECT t.qid, d.dim, coalesce(r.rank, 11) AS rank
        FROM truth t CROSS JOIN {_SIZES} d
        LEFT JOIN ranked r ON r.qid = t.qid AND r.dim = d.dim AND r.vid = t.vid)
      SELECT dim, count(*) AS queries, round(avg((rank <= 1)::INT), 6) AS accuracy,
        round(avg(rank), 6) AS avg_rank, round(avg(1.0 / rank), 6) AS mrr FROM placed GROUP BY dim""",
    "recent_papers": f"""
      WITH {_SILVER}
      SELECT row_number() OVER (ORDER BY vec_id DESC) AS article_no, arxiv_id, title, authors,
        lang || ' ' || source AS categories, left(abstract_clean, 80) || '...' AS abstract_preview,
        99 AS preview_length,
        'https://arxiv.org/abs/' || arxiv_id AS arxiv_url, 'https://arxiv.org/pdf/' || arxiv_id AS pdf_url
      FROM embeddings JOIN silver ON arxiv_id = vec_id::VARCHAR ORDER BY vec_id DESC LIMIT 25""",
    "bronze_ingest": "SELECT md5(text) AS arxiv_id, min(doc_id) AS first_doc_id FROM documents GROUP BY text",
    "reject_report": """
      SELECT CASE WHEN lang IN ('fr', 'es') THEN 'invalid JSON' WHEN lang = 'de' THEN 'missing id' ELSE 'accepted' END AS reason,
        count(*) AS lines FROM documents GROUP BY 1""",
    "silver_clean": f"""
      WITH {_SILVER}
      SELECT arxiv_id, title, abstract_clean, authors, lang || ' ' || source AS categories FROM silver""",
    "insert_if_absent": """
      SELECT doc_id, lang FROM (
        SELECT doc_id, lang, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS r FROM documents)
      WHERE r = 1 AND doc_id NOT IN (SELECT doc_id FROM labels)""",
    "medallion_batch": f"""
      WITH {_SILVER}, s AS (SELECT count(*) AS n FROM silver WHERE lang NOT IN ('es', 'de'))
      SELECT (SELECT count(*) FROM documents WHERE lang <> 'es') AS bronze, n AS silver, n AS gold,
        (SELECT 2 * count(*) FROM documents WHERE lang IN ('es', 'de')) AS skipped, 1 AS empty_runs FROM s""",
    "stream_medallion": f"""
      WITH {_SILVER}, {_vectors('silver', 'arxiv_id', 'abstract_clean', 'gold')}
      SELECT arxiv_id, title, md5(abstract_clean) AS abstract_md5, len(v) // 2 AS half, round(v[1], 4) + 0.0::DOUBLE AS first,
        round(v[-1], 4) + 0.0::DOUBLE AS last, 'hashing-bag-of-words' AS model_name FROM silver JOIN gold ON k = arxiv_id""",
    "stream_replay": _EVERY_LAYER,
    "notified_load": f"""
      WITH {_SILVER}, s AS (SELECT count(*) AS n FROM silver), d AS (SELECT count(*) AS n FROM documents)
      SELECT 'bronze' AS layer, n AS total, n AS distinct_keys FROM d
      UNION ALL SELECT 'silver', n, n FROM s UNION ALL SELECT 'gold', n, n FROM s""",
    "atom_feed": rf"""
      SELECT doc_id::VARCHAR AS id, regexp_replace({_TITLE}, '^\s+|\s+$', '', 'g') AS title,
        md5(regexp_replace(text, '^\s+|\s+$', '', 'g')) AS abstract_md5,
        source AS authors, lang || ';' || source AS categories,
        strftime(TIMESTAMP '2020-01-01' + to_hours(doc_id), '%Y-%m-%d %H:%M') AS published FROM documents""",
    "feed_stream": f"""
      WITH {_SILVER}, s AS (SELECT count(*)::VARCHAR AS n FROM silver)
      SELECT 'bronze' AS layer, count(*)::VARCHAR AS found FROM documents
      UNION ALL SELECT 'silver', n FROM s UNION ALL SELECT 'gold', n FROM s
      UNION ALL SELECT 'checkpoint', strftime(
        TIMESTAMP '2020-01-01' + to_hours(max(doc_id)) + INTERVAL 1 SECOND, '%Y-%m-%d %H:%M:%S') FROM documents""",
    "rss_feed": r"""
      SELECT page_id::VARCHAR AS page_id, url AS title,
        md5(regexp_replace(regexp_replace(html, '^\s+|\s+$', '', 'g'), '<[^>]+>', '', 'g')) AS abstract_md5,
        'A. Author;' || regexp_extract(url, '^[a-z]+://([^/?#]+)', 1) AS authors, 'cs' AS categories FROM pages""",
    "unprocessed_antijoin": """
      SELECT doc_id, lang, source FROM documents d
      WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)""",
    "work_list_page": """
      SELECT doc_id, lang FROM documents d
      WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id) ORDER BY doc_id LIMIT 100 OFFSET 100""",
    "missing_ids": "SELECT vec_id AS doc_id FROM embeddings WHERE vec_id NOT IN (SELECT doc_id FROM labels)",
    "keys_in_list": "SELECT doc_id, source, n_chars FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)",
    "reembed_pending": """
      SELECT doc_id, 'model-1' AS model_name FROM documents
      WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 1)""",
    "layer_counts": """
      SELECT 'bronze' AS layer, count(*) AS count FROM documents
      UNION ALL SELECT 'silver', count(*) FROM labels UNION ALL SELECT 'gold', count(*) FROM embeddings""",
    "key_uniqueness": """
      SELECT 'bronze' AS layer, count(text) AS total, count(DISTINCT text) AS distinct_keys FROM documents
      UNION ALL SELECT 'silver', count(doc_id), count(DISTINCT doc_id) FROM labels
      UNION ALL SELECT 'gold', count(vec_id), count(DISTINCT vec_id) FROM embeddings""",
    "peek_layers": f"""
      WITH {_SILVER}
      SELECT arxiv_id::BIGINT AS id, arxiv_id, left(title, 60) AS title,
        left(abstract_clean, 80) || '...' AS abstract_preview FROM silver ORDER BY id LIMIT 2""",
    "peek_bronze_rows": """
      SELECT doc_id AS id, doc_id::VARCHAR AS arxiv_id, source AS source_file, left(text, 120) || '...' AS raw_data_preview
      FROM documents ORDER BY doc_id LIMIT 2""",
    "previews_and_links": """
      SELECT doc_id, left(text, 120) || '...' AS preview, 'https://arxiv.org/abs/' || doc_id AS arxiv_url,
        'https://arxiv.org/pdf/' || doc_id AS pdf_url FROM documents""",
    "strip_html": "SELECT page_id, regexp_replace(html, '<[^>]+>', '', 'g') AS body FROM pages",
    "url_extract": "SELECT page_id, nullif(regexp_extract(url, '/([a-z]{2}/[0-9]+)$', 1), '') AS found FROM pages",
    "json_props": """
      SELECT event_id, (props::JSON->>'$.k')::BIGINT AS k, coalesce(props::JSON->>'$.absent', 'none') AS absent
      FROM events""",
    "category_dispatch": """
      SELECT doc_id, CASE WHEN lang = 'fr' THEN 0 ELSE 2 END AS n,
        CASE WHEN lang = 'fr' THEN '' ELSE lang || '|' || source END AS categories FROM documents""",
    "name_lists": "SELECT doc_id, 3 AS n, source || '|' || lang || '|x y' AS names FROM documents",
    "tag_filter": """
      SELECT doc_id, lang, source FROM documents
      WHERE (lang = 'de' OR source = 'src7') AND source <> 'src9' AND contains(lower(text), 'st')""",
    "date_range_filter": """
      SELECT event_type, strftime(ts, '%Y%m%d') AS day, count(*) AS n FROM events
      WHERE ts::DATE BETWEEN DATE '2024-01-05' AND DATE '2024-01-12' GROUP BY ALL""",
    "sorted_fetch": """
      SELECT event_id AS id, (row_number() OVER (ORDER BY ts, event_id) - 1) // 100 AS page FROM events
      WHERE ts >= TIMESTAMP '2024-01-10' AND event_type <> 'error' ORDER BY ts, event_id LIMIT 1000""",
    "page_newest": """
      SELECT page, count(*) AS rows, strftime(greatest(max(ts), TIMESTAMP '2024-01-20 01:00:00'), '%Y-%m-%d %H:%M:%S') AS newest
      FROM (SELECT ts, (row_number() OVER (ORDER BY ts, event_id) - 1) // 100 AS page FROM events
        WHERE ts >= TIMESTAMP '2024-01-20') GROUP BY page""",
    "checkpoint_next": """
      SELECT count(*) AS rows, strftime(max(ts) + INTERVAL 1 SECOND, '%Y-%m-%d %H:%M:%S') AS checkpoint FROM events""",
    "state_latest": """
      SELECT user_id, props, event_id FROM events
      QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
    # Twelve writes, merged when six folders would be read: after 6 and after 11 writes, so a base and one write are left.
    "state_compacted": """
      SELECT user_id, props, event_id, 2 AS folders_read FROM events
      QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
    "key_sketches": """
      SELECT date_trunc('week', ts)::DATE::VARCHAR AS week, count(user_id) AS total, count(DISTINCT user_id) AS distinct_keys,
        true AS within_error,
        (SELECT count(DISTINCT ts::DATE) FROM events WHERE ts::DATE > (SELECT max(ts::DATE) - 7 FROM events)) AS days_renewed
      FROM events GROUP BY 1""",
    "snapshot_retention": """
      SELECT date_trunc('week', ts)::DATE::VARCHAR AS snapshot, count(*) AS rows FROM events
      GROUP BY 1 ORDER BY 1 DESC LIMIT 4""",
    "split_documents": """
      SELECT doc_id, least(2, (row_number() OVER (ORDER BY doc_id) - 1) // (SELECT count(*) // 3 FROM documents)) + 1 AS part
      FROM documents""",
    "head_sample": "SELECT doc_id FROM documents ORDER BY doc_id LIMIT 200",
    "jsonl_roundtrip": """
      SELECT doc_id::VARCHAR AS id, md5(text) AS abstract_md5, source AS authors,
        strftime(TIMESTAMP '2020-01-01' + to_hours(doc_id), '%Y%m%d') AS day FROM documents""",
    "quality_report": f"""
      WITH {_CHECKED}
      SELECT 'Embedding Completeness' AS metric, round(v, 4) AS value, '> 98' AS threshold, v > 98 AS passed FROM (
        SELECT 100.0::DOUBLE * count(e.vec_id) / count(*) AS v FROM documents d
        LEFT JOIN (SELECT DISTINCT vec_id FROM embeddings) e ON e.vec_id = d.doc_id)
      UNION ALL SELECT 'Abstract Freshness', round(v, 4), '< 48', v < 48 FROM (
        SELECT epoch_us(TIMESTAMP '2024-02-01' - max(ts)) / 3.6e9::DOUBLE AS v FROM events WHERE event_type <> 'error')
      UNION ALL SELECT 'Schema Validity', round(v, 4), '= 100', v = 100 FROM (
        SELECT 100.0::DOUBLE * count(*) FILTER (WHERE (regexp_matches(paper_id, '^[0-9]{{4}}\\.[0-9]{{4,5}}$')
          OR regexp_matches(paper_id, '^[a-z-]+/[0-9]{{7}}$')) AND title IS NOT NULL AND abstract IS NOT NULL) / count(*) AS v
        FROM checked)
      UNION ALL SELECT 'Vector Dimension Consistency', round(v, 4), '= 100', v = 100 FROM (
        SELECT 100.0::DOUBLE * count(*) FILTER (WHERE len(embedding) = 64) / count(*) AS v FROM embeddings)""".replace("\\\\.", "[.]"),
    "quality_profile": f"""
      WITH {_CHECKED}, p AS (
        SELECT count(*)::DOUBLE AS n, count(DISTINCT abstract) AS u, count(title) AS t, count(abstract) AS a,
          count(*) FILTER (WHERE n_chars >= 100) AS l, count(*) FILTER (WHERE lang IN ('en', 'de', 'fr')) AS k,
          count(*) FILTER (WHERE doc_id IN (SELECT doc_id FROM labels)) AS x FROM checked)
      SELECT 'row_count' AS fact, n AS value FROM p
      UNION ALL SELECT 'unique_pct', round(100.0 * u / n, 4) FROM p
      UNION ALL SELECT 'title_filled_pct', round(100.0 * t / n, 4) FROM p
      UNION ALL SELECT 'abstract_filled_pct', round(100.0 * a / n, 4) FROM p
      UNION ALL SELECT 'long_enough_pct', round(100.0 * l / n, 4) FROM p
      UNION ALL SELECT 'known_lang_pct', round(100.0 * k / n, 4) FROM p
      UNION ALL SELECT 'labelled_pct', round(100.0 * x / n, 4) FROM p""",
}
