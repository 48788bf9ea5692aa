"""Named queries over the given tables; each takes (spark, folder of the tables)."""

from __future__ import annotations

import math
from datetime import datetime, timezone

import numpy as np
from pyspark.errors import StreamingQueryException
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vectorloom.config import TOP_K, nested_dims
from vectorloom.functions import fields, text, vectors
from vectorloom.functions.encoders import HashingEncoder, encoder_udf, hashing_encoder
from vectorloom.operators import listing, quality, tables
from vectorloom.operators.approx import build_cells, fit_centres, recall, top_k_cells
from vectorloom.operators.checkpoint import next_checkpoint, pages_newest
from vectorloom.operators.compacted import KeyedState
from vectorloom.operators.export import split_parts, write_jsonl
from vectorloom.operators.lake import Lake
from vectorloom.operators.pruned import top_k_pruned
from vectorloom.operators.quantised import Codebooks, build_quantised, fit_codebooks, residuals, top_k_quantised
from vectorloom.operators.retrieval import scores, true_ranks
from vectorloom.operators.search import embed_queries, recent, search, search_filter
from vectorloom.operators.sketches import KeySketches, relative_error
from vectorloom.operators.snapshots import Snapshots
from vectorloom.operators.topk import top_k
from vectorloom.plans.loads import load_files
from vectorloom.plans.stages import clean_rows, parse_lines
from vectorloom.session import PLAIN_READS, folder_names, new_folder, small_buffers, spread, stored
from vectorloom.sources.archive import move_file
from vectorloom.sources.feeds import atom_records, fetch, rss_records, scan_atom, scan_rss
from vectorloom.sources.lines import head_lines, read_jsonl, scan_lines, stream_lines
from vectorloom.sources.message_log import message_log
from vectorloom.sources.notifications import arrival_messages
from vectorloom.sources.testset import read_test_set
from vectorloom.streaming.first_seen import state_session, write_first_seen
from vectorloom.streaming.medallion import load_feed, load_notified, load_stream

# Size of the vectors in the given ``embeddings`` table, and of those made here.
DIM = 64
SIZES = nested_dims(DIM)
MODEL = HashingEncoder.name
EPOCH = "2020-01-01"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


# -- the given documents in the shape of papers ---------------------------


def papers(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as raw records: the first line is the title, the id gives the time."""
    documents = spread(table(spark, folder, "documents"))
    return documents.select(
        F.col("doc_id").cast("string").alias("id"),
        F.regexp_extract("text", r"^[^\n]*", 0).alias("title"),
        F.col("text").alias("abstract"),
        F.array("source").alias("authors"),
        F.array("lang", "source").alias("categories"),
        F.date_format(_hours("doc_id"), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("published"),
        "doc_id",
    )


def _hours(number: str):
    return F.timestamp_seconds(
        F.unix_timestamp(F.lit(f"{EPOCH} 00:00:00")) + F.col(number) * F.lit(3600)
    )


def _silver(spark: SparkSession, folder: str) -> DataFrame:
    rows = papers(spark, folder)
    cleaned = tables.compute_once(
        rows.select("id", "categories", F.array_join("authors", ", ").alias("authors"), "published", "title", "abstract"),
        clean_title=text.clean_title(F.col("title")),
        abstract_clean=text.clean_abstract(F.col("abstract")),
    )
    return cleaned.where(F.col("abstract_clean").isNotNull() & F.col("clean_title").isNotNull()).select(
        F.col("id").alias("arxiv_id"),
        F.col("clean_title").alias("title"),
        "authors",
        "categories",
        "abstract_clean",
        F.to_timestamp("published").alias("published"),
    )


def _gold(silver: DataFrame) -> DataFrame:
    embedded = silver.select("arxiv_id", encoder_udf(hashing_encoder(DIM), SIZES)(F.col("abstract_clean")).alias("v"))
    return embedded.select("arxiv_id", "v.*")


def _questions(spark: SparkSession, folder: str) -> DataFrame:
    asked = table(spark, folder, "benchmark").select(
        F.col("item_id").alias("query_id"), F.col("text").alias("query")
    )
    return embed_queries(asked, hashing_encoder(DIM), dims=SIZES)


def _record_files(spark: SparkSession, folder: str) -> str:
    """Documents as JSON-lines files in id order."""
    path = new_folder(spark, "jsonl")
    write_jsonl(papers(spark, folder).sort("doc_id"), path)
    return path


def _mean(column: str):
    """Aggregate: the mean vector, without unfolding the components into rows."""
    return vector_to_array(Summarizer.mean(array_to_vector(F.col(column).cast("array<double>"))))


def _prototypes(spark: SparkSession, folder: str) -> DataFrame:
    """Mean vector of each label."""
    return table(spark, folder, "embeddings").groupBy("label").agg(_mean("embedding").alias("query_vector"))


# -- search ----------------------------------------------------------------


def text_search(spark, folder):
    """Papers nearest to each benchmark text, with title, score and links."""
    silver = stored(_silver(spark, folder), "silver")
    found = search(
        _gold(silver),
        silver,
        _questions(spark, folder),
        dim=DIM,
        gold_within_silver=True,
    )
    return found.select("query_id", "rank", "arxiv_id", "title", "authors", "score", "arxiv_url", "pdf_url")


def text_search_filtered(spark, folder):
    """The same among papers with one of two tags, from a date on."""
    silver = stored(_silver(spark, folder), "silver")
    keep = search_filter(["fr", "src3"], "2020-01-15")
    found = search(_gold(silver.where(keep)), silver, _questions(spark, folder), dim=DIM, where=keep)
    return found.select("query_id", "rank", "arxiv_id", "score")


def vector_topk_multi(spark, folder):
    """Nearest vectors of each label's mean at every size."""
    found = top_k(
        table(spark, folder, "embeddings"),
        _prototypes(spark, folder),
        id_col="vec_id",
        vector_col="embedding",
        query_id="label",
        dims=SIZES,
    )
    return found.select("label", "dim", "rank", "vec_id", vectors.score(F.col("distance")).alias("score"))


def vector_topk_single(spark, folder):
    """Nearest vectors of the mean of the whole table."""
    rows = table(spark, folder, "embeddings")
    centre = rows.agg(_mean("embedding").alias("query_vector")).withColumn("query_id", F.lit(0))
    found = top_k(rows, centre, id_col="vec_id", vector_col="embedding")
    return found.select("rank", "vec_id", vectors.score(F.col("distance")).alias("score"))


def vector_topk_pruned(spark, folder):
    """The ten nearest vectors of every vector, by cells that the bounds leave."""
    rows = table(spark, folder, "embeddings").select("vec_id", "embedding")
    asked = rows.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query_vector"))
    found, _ = top_k_pruned(rows, asked, id_col="vec_id", vector_col="embedding")
    return found.select("query_id", "rank", "vec_id", vectors.score(F.col("distance")).alias("score"))


def _label_centres(spark, folder) -> np.ndarray:
    """Label means in label order: given centres, one row per label."""
    means = _prototypes(spark, folder).where(F.col("label").isNotNull()).orderBy("label").collect()
    return np.array([r["query_vector"] for r in means])


def _cell_search(spark, folder, centres, probes):
    path = new_folder(spark, "cells")
    build_cells(table(spark, folder, "embeddings"), path, centres, "vec_id", "embedding")
    found = top_k_cells(
        spark, path, centres, _prototypes(spark, folder), probes, id_col="vec_id", vector_col="embedding", query_id="label"
    )
    return found.select("label", "rank", "vec_id", vectors.score(F.col("distance")).alias("score"))


def vector_topk_approx(spark, folder):
    """Nearest vectors of each label's mean in three cells; the cells have the label means as their centres."""
    return _cell_search(spark, folder, _label_centres(spark, folder), 3)


def vector_topk_all_cells(spark, folder):
    """Cluster search that probes every fitted cluster: the exact answer."""
    centres = fit_centres(table(spark, folder, "embeddings"), 8, "embedding")
    return _cell_search(spark, folder, centres, len(centres))


def vector_topk_pq(spark, folder):
    """Nearest vectors of each label's mean by codes of given code words: what is left of the sixteen first vectors, cut into eight parts."""
    rows = table(spark, folder, "embeddings")
    centres = _label_centres(spark, folder)
    first = np.array([r.embedding for r in rows.select("vec_id", "embedding").orderBy("vec_id").limit(16).collect()], np.float64)
    words = residuals(first, centres)[1].reshape(len(first), 8, DIM // 8).transpose(1, 0, 2)
    books, path = Codebooks(centres, words), new_folder(spark, "codes")
    build_quantised(rows, path, books, "vec_id", "embedding")
    found = top_k_quantised(
        spark, path, books, _prototypes(spark, folder), 3, 50, id_col="vec_id", vector_col="embedding", query_id="label"
    )
    return found.select("label", "rank", "vec_id", vectors.score(F.col("distance")).alias("score"))


def vector_recall(spark, folder):
    """Whether the search by codes finds 0.9 of the exact answers, for every hundredth vector against all."""
    rows = table(spark, folder, "embeddings").select("vec_id", "embedding")
    cells = max(4, math.isqrt(rows.count()) // 4)
    books, path = fit_codebooks(rows, cells, 16, 256, "embedding"), new_folder(spark, "codes")
    build_quantised(rows, path, books, "vec_id", "embedding")
    asked = rows.where("vec_id % 100 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query_vector"))
    exact = stored(top_k(rows, asked, id_col="vec_id", vector_col="embedding"), "exact")
    # As a user sets it: half of the cells, and a quarter more while the measured recall asks for it.
    share, probes = 0.0, cells // 4
    while share < 0.9 and probes < cells:
        probes = min(cells, probes + -(-cells // 4))
        found = top_k_quantised(spark, path, books, asked, probes, 200, id_col="vec_id", vector_col="embedding")
        share = recall(found, exact, "query_id", "vec_id").first()["recall"] or 0.0
    return exact.agg(
        F.count_distinct("query_id").alias("queries"), F.count(F.lit(1)).alias("answers"), F.lit(share >= 0.9).alias("enough")
    )


def vector_distance(spark, folder):
    """Cosine distance and score of each vector to its label's mean."""
    # Written first: Spark then knows how small it is and joins it without a shuffle.
    means = stored(_prototypes(spark, folder), "means")
    rows = table(spark, folder, "embeddings").join(means, "label")
    distance = vectors.cosine_distance(F.col("embedding"), F.col("query_vector"))
    return rows.select(
        "vec_id", "label", F.round(distance, 6).alias("distance"), vectors.score(distance).alias("score")
    )


def vector_text(spark, folder):
    """Vectors to text and back."""
    written = vectors.to_text(F.col("embedding"))
    return table(spark, folder, "embeddings").select(
        "vec_id",
        F.size(vectors.from_text(written)).alias("size"),
        F.round(F.get(vectors.from_text(written), F.lit(0)).cast("double"), 6).alias("first"),
        F.round(F.element_at(vectors.from_text(written), -1).cast("double"), 6).alias("last"),
        F.length(F.regexp_replace(written, "[^,]", "")).alias("commas"),
        (vectors.from_text(written) == F.col("embedding")).alias("same"),
    )


def matryoshka_dims(spark, folder):
    """Every vector at every size: size, length and first components."""
    whole = table(spark, folder, "embeddings")
    sizes = [
        F.struct(
            F.lit(d).alias("dim"),
            (vectors.truncate_normalize(F.col("embedding"), d) if d != DIM else F.col("embedding")).alias("v"),
        )
        for d in SIZES
    ]
    rows = whole.select("vec_id", F.inline(F.array(*sizes)))
    return rows.select(
        "vec_id",
        "dim",
        F.size("v").alias("size"),
        F.round(vectors.norm(F.col("v")), 4).alias("length"),
        F.round(F.get("v", F.lit(0)).cast("double"), 4).alias("first"),
        F.round(F.get("v", F.lit(1)).cast("double"), 4).alias("second"),
    )


def hash_encoder(spark, folder):
    """Vectors of all documents at every size."""
    embedded = spread(table(spark, folder, "documents")).select(
        "doc_id", encoder_udf(hashing_encoder(DIM), SIZES)(F.col("text")).alias("v")
    )
    sizes = [F.struct(F.lit(d).alias("dim"), F.col(f"v.embedding_{d}").alias("v")) for d in SIZES]
    rows = embedded.select("doc_id", F.inline(F.array(*sizes)))
    total = F.aggregate("v", F.lit(0.0), lambda t, x: t + x.cast("double"))
    return rows.select(
        "doc_id",
        "dim",
        F.round(vectors.norm(F.col("v")), 4).alias("length"),
        F.round(F.get("v", F.lit(0)).cast("double"), 4).alias("first"),
        F.round(F.element_at("v", -1).cast("double"), 4).alias("last"),
        F.round(total, 4).alias("total"),
    )


def retrieval_metrics(spark, folder):
    """How well shorter vectors find what the full one ranks first."""
    ranked = stored(
        top_k(
            _gold(_silver(spark, folder)),
            _questions(spark, folder),
            vector_col=f"embedding_{DIM}",
            dims=SIZES,
        ),
        "ranked",
    )
    truth = ranked.where((F.col("dim") == DIM) & (F.col("rank") == 1)).select(
        "query_id", F.col("arxiv_id").alias("true_id")
    )
    found = scores(true_ranks(truth, ranked, SIZES), TOP_K)
    return found.select(
        "dim",
        "queries",
        F.round("accuracy", 6).alias("accuracy"),
        F.round("avg_rank", 6).alias("avg_rank"),
        F.round("mrr", 6).alias("mrr"),
    )


def test_set_scores(spark, folder):
    """Scores against a loaded test set: the head of every hundredth text has to find its paper."""
    silver = stored(_silver(spark, folder), "silver")
    chosen = silver.where(F.col("arxiv_id").cast("long") % 100 == 0)
    case = F.struct("arxiv_id", F.substring("abstract_clean", 1, 200).alias("abstract"), F.substring("abstract_clean", 1, 80).alias("query"))
    path = new_folder(spark, "tests")
    # A file is one array; a thousand cases at most.
    files = chosen.groupBy((F.col("arxiv_id").cast("long") / 100_000).cast("long").alias("part")).agg(F.to_json(F.collect_list(case)).alias("value"))
    files.write.partitionBy("part").text(path)
    cases = stored(read_test_set(spark, path).select("arxiv_id", "query"), "cases")
    gold = stored(_gold(silver), "gold")
    listing.require_ids(cases, gold, "arxiv_id")
    asked = embed_queries(cases.select(F.col("arxiv_id").alias("query_id"), "query"), hashing_encoder(DIM), dims=SIZES)
    ranked = stored(top_k(gold, asked, vector_col=f"embedding_{DIM}", dims=SIZES), "ranked")
    truth = cases.select(F.col("arxiv_id").alias("query_id"), F.col("arxiv_id").alias("true_id"))
    found = scores(true_ranks(truth, ranked, SIZES), TOP_K)
    return found.select(
        "dim", "queries", F.round("accuracy", 6).alias("accuracy"), F.round("avg_rank", 6).alias("avg_rank"), F.round("mrr", 6).alias("mrr"),
    )


def recent_papers(spark, folder):
    """The 25 papers embedded last, with attributes and links."""
    silver = stored(_silver(spark, folder), "silver")
    gold = table(spark, folder, "embeddings").select(
        F.col("vec_id").cast("string").alias("arxiv_id"),
        F.col("embedding").alias(f"embedding_{DIM}"),
        _hours("vec_id").alias("embedded_at"),
    )
    rows = recent(gold, silver, 25, DIM)
    return rows.select(
        "article_no",
        "arxiv_id",
        "title",
        "authors",
        F.array_join("categories", " ").alias("categories"),
        text.preview(F.col("abstract_clean"), 80).alias("abstract_preview"),
        F.length(f"embedding_{DIM}_preview").alias("preview_length"),
        "arxiv_url",
        "pdf_url",
    )


# -- layers ----------------------------------------------------------------


def bronze_ingest(spark, folder):
    """JSON-lines scan, tolerant parse and first-wins on equal texts."""
    path = new_folder(spark, "jsonl")
    rows = papers(spark, folder)
    write_jsonl(rows.withColumn("id", F.md5("abstract")).sort("doc_id"), path)
    accepted = parse_lines(read_jsonl(spark, path)).where(F.col("reason").isNull())
    kept = tables.first_wins(accepted, ["arxiv_id"], "seq")
    return kept.select(
        "arxiv_id", fields.json_field(F.col("raw_data"), "doc_id", "bigint").alias("first_doc_id")
    )


def first_wins_many_files(spark, folder):
    """One-line files before larger ones, ids repeated: the winner of each id, by batch load and by stream.

    A document's source is its id, the first hundred documents are files of their own.
    """
    path = new_folder(spark, "many")
    rows = papers(spark, folder).withColumn("id", F.col("authors")[0])
    single = F.concat(F.lit("a"), F.lpad(F.col("doc_id").cast("string"), 3, "0"))
    line = F.to_json(F.struct("id", "title", "abstract", "doc_id"))
    named = rows.select(line.alias("value"), F.when(F.col("doc_id") < 100, single).otherwise("b").alias("part"), "doc_id")
    few = named.where("part != 'b'").repartition("part")
    few.select("value", "part").write.partitionBy("part").text(path)
    named.where("part = 'b'").sort("doc_id").select("value", "part").write.mode("append").partitionBy("part").text(path)
    out = None
    for way in ("batch", "stream"):
        lake = _new_lake(spark)
        if way == "batch":
            load_files(lake, path, hashing_encoder(DIM), MODEL)
        else:
            files = stream_lines(spark, path, suffix=".txt")
            load_stream(lake, files, hashing_encoder(DIM), new_folder(spark, "checkpoint"), once=True, model_name=MODEL).awaitTermination()
        found = lake.read("bronze").select(
            F.lit(way).alias("way"), "arxiv_id", fields.json_field(F.col("raw_data"), "doc_id", "bigint").alias("winner"),
            F.md5(fields.json_field(F.col("raw_data"), "abstract", "string")).alias("text_md5"),
        )
        out = found if out is None else out.unionByName(found)
    return out


def latex_clean(spark, folder):
    """Macros around facts of each document, cleaned by the text rules and by another cleaner."""
    word = F.regexp_extract("text", "^[A-Za-z]*", 0)
    number, lang, source = F.col("doc_id").cast("string"), F.col("lang"), F.col("source")
    nested = F.aggregate(
        F.sequence(F.lit(1), (F.col("doc_id") % 8 + 1).cast("int")), F.lit("x"),
        lambda a, i: F.concat(F.lit("\\frac{"), i.cast("string"), F.lit("}{"), a, F.lit("}")),
    )
    tex = F.concat(
        F.lit("\\textbf{"), source, F.lit("} \\emph{\\textit{"), lang, F.lit("}} % gone\n \\frac{"), number, F.lit("}{\\sqrt{"), word,
        F.lit("}} \\cite{a,b} \\'{e}t\\'e~50\\% \\$"), number, F.lit(" \\ref{s} \\begin{itemize}"), word, F.lit("\\end{itemize} $\\alpha$ "), nested,
    )
    record = F.to_json(F.struct(F.lit("t").alias("title"), tex.alias("abstract")))
    bronze = table(spark, folder, "documents").select(F.col("doc_id").alias("id"), number.alias("arxiv_id"), record.alias("raw_data"))
    at = F.lit(datetime(2024, 1, 1, tzinfo=timezone.utc)).cast("timestamp")
    ours = clean_rows(bronze, at).select("id", F.col("abstract_clean").alias("cleaned"))
    other = clean_rows(bronze, at, lambda c: F.upper(F.substring(c, 1, 12))).select("id", F.col("abstract_clean").alias("swapped"))
    return ours.join(other, "id")


def reject_report(spark, folder):
    """Broken, keyless and good lines counted by reason."""
    rows = papers(spark, folder)
    line = F.to_json(F.struct("id", "title", "abstract"))
    broken = F.when(F.col("categories")[0] == "fr", F.substring(line, 1, 20)).when(
        F.col("categories")[0] == "de", F.to_json(F.struct("title"))
    ).when(F.col("categories")[0] == "es", F.concat(F.lit("["), line, F.lit("]"))).otherwise(line)
    lines = rows.select(broken.alias("value"))
    parsed = parse_lines(lines)
    return parsed.groupBy(F.coalesce("reason", F.lit("accepted")).alias("reason")).agg(
        F.count(F.lit(1)).alias("lines")
    )


def silver_clean(spark, folder):
    """Cleaned titles and texts of all documents."""
    return _silver(spark, folder).select(
        "arxiv_id", "title", "abstract_clean", "authors", F.array_join("categories", " ").alias("categories")
    )


def stream_first_wins_state(spark, folder):
    """The winner of each id over files with repeats, by state kept per id; the second run goes on from the checkpoint of the first."""
    session = state_session(spark)
    rows = papers(session, folder).withColumn("id", F.concat(F.col("authors")[0], F.lit("-"), F.col("doc_id") % 5))
    line = F.to_json(F.struct("id", "title", "abstract", "doc_id"))
    inbox, out, progress = (new_folder(session, n) for n in ("seen_in", "seen_out", "seen_progress"))
    waves = ((F.col("doc_id") % 3 == 0) & (F.col("doc_id") % 5 != 4), (F.col("doc_id") % 3 != 0) | (F.col("doc_id") % 5 == 4))
    for number, wave in enumerate(waves):
        rows.where(wave).sort("doc_id").select(line.alias("value")).write.mode("append").text(f"{inbox}/{number}")
        write_first_seen(stream_lines(session, f"{inbox}/*", suffix=".txt"), out, progress).awaitTermination()
    found = spark.read.parquet(out)
    record = F.col("raw_data")
    return found.select(
        "arxiv_id", fields.json_field(record, "doc_id", "bigint").alias("winner"), F.md5(fields.json_field(record, "abstract", "string")).alias("text_md5")
    )


def full_then_incremental(spark, folder):
    """A full load, two incremental ones, a full one and an incremental one: the load of each row before and after the second full load."""
    documents = table(spark, folder, "documents").select("doc_id", "lang")
    snapshots = Snapshots(spark, new_folder(spark, "snapshots"))

    def rows(load: str, keep=None):
        return (documents if keep is None else documents.where(keep)).withColumn("load", F.lit(load))

    snapshots.full(rows("full 1", F.col("doc_id") % 4 != 3))
    snapshots.add(rows("more 1", F.col("doc_id") % 8 != 7), ["doc_id"], "lang")
    before = snapshots.add(rows("more 2"), ["doc_id"], "lang")
    snapshots.full(rows("full 2", F.col("lang") != "fr"))
    after = snapshots.add(rows("more 3"), ["doc_id"], "lang")
    states = [snapshots.read(version).select(F.lit(name).alias("state"), "doc_id", "load") for name, version in (("before", before), ("after", after))]
    return states[0].unionByName(states[1])


def insert_if_absent(spark, folder):
    """First document of each text that is not in the label table yet."""
    # The digest stands for the text, which then is not shuffled.
    documents = spread(table(spark, folder, "documents")).select(
        "doc_id", F.sha2("text", 256).alias("text_key"), "lang"
    )
    fresh = tables.first_wins(documents, ["text_key"], "doc_id")
    return tables.absent_from(fresh, table(spark, folder, "labels"), ["doc_id"]).select("doc_id", "lang")


def medallion_batch(spark, folder):
    """Files to bronze, silver and gold, then again: the second load adds nothing.

    Spanish documents arrive as cut lines, German ones without a text: the first
    are skipped by bronze, the others by silver, in each of the two runs.
    """
    lang = F.col("categories")[0]
    rows = papers(spark, folder).withColumn("abstract", F.when(lang == "de", F.lit(" ")).otherwise(F.col("abstract")))
    line = F.to_json(F.struct("id", "title", "abstract", "authors", "categories", "published"))
    path = new_folder(spark, "jsonl")
    rows.select(F.when(lang == "es", F.substring(line, 1, 20)).otherwise(line).alias("value")).write.text(path)
    lake = _new_lake(spark)
    for _ in range(2):
        load_files(lake, path, hashing_encoder(DIM), MODEL)
    return _run_log(lake)


def _new_lake(spark: SparkSession) -> Lake:
    root = new_folder(spark, "lake")
    prefix = "loom_" + root.rsplit("-", 1)[1] + "_"
    return Lake(spark, root, prefix, SIZES).create()


def _run_log(lake: Lake) -> DataFrame:
    runs = lake.read("runs")
    return runs.agg(
        F.sum("bronze").alias("bronze"),
        F.sum("silver").alias("silver"),
        F.sum("gold").alias("gold"),
        F.sum("skipped").alias("skipped"),
        F.count_if((F.col("bronze") == 0) & (F.col("status") == "success")).alias("empty_runs"),
    )


def stream_medallion(spark, folder):
    """The same files as a stream of micro-batches: the resulting layers."""
    path = _record_files(spark, folder)
    lake = _new_lake(spark)
    lines = stream_lines(spark, path, suffix=".json", max_files=4)
    load_stream(lake, lines, hashing_encoder(DIM), new_folder(spark, "progress"), once=True, model_name=MODEL).awaitTermination()
    full = F.col(f"embedding_{DIM}")
    gold = lake.read("gold").select(
        "arxiv_id", F.size(f"embedding_{SIZES[1]}").alias("half"), "model_name",
        F.round(F.get(full, F.lit(0)).cast("double"), 4).alias("first"), F.round(F.element_at(full, -1).cast("double"), 4).alias("last"),
    )
    silver = lake.read("silver").select("arxiv_id", "title", F.md5("abstract_clean").alias("abstract_md5"))
    return silver.join(gold, "arxiv_id")


def stream_replay(spark, folder):
    """Two streams without common progress over the same files: no second copy."""
    path = _record_files(spark, folder)
    lake = _new_lake(spark)
    for _ in range(2):
        lines = stream_lines(spark, path, suffix=".json")
        load_stream(lake, lines, hashing_encoder(DIM), new_folder(spark, "progress"), once=True, model_name=MODEL).awaitTermination()
    return _run_log(lake)


class _Unready:
    """An encoder that is not there yet."""

    dim = DIM

    def encode(self, texts):
        raise RuntimeError("the model is not loaded")


def resumed_after_failure(spark, folder):
    """A stream whose first run fails in the last layer, goes on from its checkpoint, then finds nothing new."""
    path = _record_files(spark, folder)
    lake, progress = _new_lake(spark), new_folder(spark, "progress")
    for encoder in (_Unready, hashing_encoder(DIM), hashing_encoder(DIM)):
        query = load_stream(lake, stream_lines(spark, path, suffix=".json"), encoder, progress, once=True, model_name=MODEL)
        try:
            query.awaitTermination()
        except StreamingQueryException:
            if encoder is not _Unready:
                raise
    runs = lake.read("runs").groupBy("status").agg(F.count(F.lit(1)).alias("runs"), F.sum("bronze").alias("bronze"), F.sum("gold").alias("gold"))
    return runs.crossJoin(F.broadcast(listing.layer_counts(silver=lake.read("silver")).select(F.col("count").alias("silver"))))


def archived_files(spark, folder):
    """Files moved into the watched folder and put away after loading; names that come again get a number."""
    staged, inbox, away, progress = (new_folder(spark, n) for n in ("staged", "inbox", "archive", "progress"))
    rows = papers(spark, folder).withColumn("half", F.col("doc_id") % 2).withColumn("lang", F.col("categories")[0])
    line = F.to_json(F.struct("id", "title", "abstract", "authors", "categories", "published"))
    rows.select(line.alias("value"), "half", "lang").repartition("half", "lang").write.partitionBy("half", "lang").text(staged)
    lake = _new_lake(spark)
    for half in (0, 1):
        for name in sorted(n for n in folder_names(spark, f"{staged}/half={half}") if n.startswith("lang=")):
            for part in (n for n in folder_names(spark, f"{staged}/half={half}/{name}") if n.startswith("part-")):
                move_file(spark, f"{staged}/half={half}/{name}/{part}", f"{inbox}/{half}/{name[5:]}.jsonl")
        lines = stream_lines(spark, f"{inbox}/*", max_files=3)
        load_stream(lake, lines, hashing_encoder(DIM), progress, once=True, model_name=MODEL, archive=away).awaitTermination()
    put_away = scan_lines(spark, away).groupBy(F.col("source_file").alias("file")).agg(F.count(F.lit(1)).alias("rows"))
    loaded = lake.read("bronze").groupBy(F.concat(F.lit("loaded from "), "source_file").alias("file")).agg(F.count(F.lit(1)).alias("rows"))
    return put_away.unionByName(loaded)


def seeded_states(spark, folder):
    """A checkpoint for each document as a source: those without one start 24 hours back, the others keep theirs; seeding twice adds nothing."""
    documents = table(spark, folder, "documents").select(F.concat_ws("/", "source", "doc_id").alias("key"), "lang", _hours("doc_id").alias("at"))
    lake = _new_lake(spark)
    known = documents.where("lang = 'fr'").select(
        "key", F.col("at").cast("string").alias("value"), F.lit(1).cast("long").alias("version"), F.current_timestamp().alias("updated_at")
    )
    lake.append("state", known)
    added = [lake.seed_states(documents) for _ in range(2)]
    day_back = F.abs(F.unix_timestamp(F.current_timestamp()) - F.unix_timestamp(fields.iso_timestamp(F.col("value"))) - 86_400) < 7200
    return lake.state().select(
        "key", F.when(F.col("version") == 0, day_back).alias("day_back"), F.when(F.col("version") == 1, F.col("value")).alias("value"), F.lit(added[1]).alias("added_twice")
    )


def notified_load(spark, folder):
    """Arrival messages of the files drive the load."""
    path = _record_files(spark, folder)
    lake = _new_lake(spark)
    inbox = new_folder(spark, "messages")
    arrival_messages(scan_lines(spark, path)).write.text(inbox)
    messages = spark.readStream.text(inbox)
    load_notified(lake, messages, hashing_encoder(DIM), new_folder(spark, "progress"), once=True, model_name=MODEL).awaitTermination()
    return listing.key_counts("arxiv_id", **{n: lake.read(n) for n in ("bronze", "silver", "gold")})


def notified_stream(spark, folder):
    """A log of messages that grows between three runs of one load; some name a file again, some a file that is not there."""
    rows = papers(spark, folder)
    line = F.to_json(F.struct("id", "title", "abstract", "authors", "categories", "published"))
    inbox, log, progress = (new_folder(spark, n) for n in ("notified", "log", "progress"))
    lake = _new_lake(spark)
    with small_buffers(spark):
        for wave in range(3):
            rows.where(F.col("doc_id") % 3 == wave).select(line.alias("value")).write.text(f"{inbox}/{wave}")
            # Files of the runs before are named again.
            there = arrival_messages(scan_lines(spark, [f"{inbox}/{n}" for n in range(wave + 1)]))
            gone = rows.select(F.format_string("%s-%d.jsonl", F.col("authors")[0], F.lit(wave)).alias("filename")).distinct()
            missing = gone.select(F.to_json(F.struct(F.concat(F.lit(f"{inbox}/gone/"), "filename").alias("filepath"), "filename")).alias("value"))
            there.unionByName(missing).write.text(f"{log}/{wave:08d}")
            load_notified(lake, message_log(spark, log), hashing_encoder(DIM), progress, once=True, model_name=MODEL).awaitTermination()
    loaded = lake.read("bronze", **PLAIN_READS).select(
        F.lit("loaded").alias("state"), F.col("arxiv_id").alias("name"), F.md5(fields.json_field(F.col("raw_data"), "abstract", "string")).alias("text_md5")
    )
    return loaded.unionByName(lake.read("rejects").select(F.col("reason").alias("state"), F.col("source_file").alias("name"), F.lit(None).cast("string").alias("text_md5")))


def _atom_files(spark: SparkSession, folder: str) -> str:
    """Documents as Atom feed files."""
    path = new_folder(spark, "atom")
    term = F.transform("categories", lambda c: F.struct(c.alias("_term"), F.lit("").alias("_VALUE")))
    entries = papers(spark, folder).select(
        F.concat(F.lit("http://arxiv.org/abs/"), "id").alias("id"),
        F.concat(F.lit("\n  "), "title", F.lit("\n")).alias("title"),
        F.col("abstract").alias("summary"),
        "published",
        F.transform("authors", lambda a: F.struct(a.alias("name"))).alias("author"),
        term.alias("category"),
    )
    entries.write.format("xml").option("rootTag", "feed").option("rowTag", "entry").save(path)
    return path


def atom_feed(spark, folder):
    """Atom files read as records."""
    records = atom_records(scan_atom(spark, _atom_files(spark, folder)))
    return records.select(
        "id",
        "title",
        F.md5("abstract").alias("abstract_md5"),
        F.array_join("authors", ";").alias("authors"),
        F.array_join("categories", ";").alias("categories"),
        F.date_format(fields.iso_timestamp(F.col("published")), "yyyy-MM-dd HH:mm").alias("published"),
    )


def feed_stream(spark, folder):
    """Atom files as a stream: rows of the layers and the event-time checkpoint."""
    lake = _new_lake(spark)
    lake.set_state("atom", f"{EPOCH}T00:00:00Z")
    entries = scan_atom(spark, _atom_files(spark, folder), stream=True)
    load_feed(
        lake, entries, atom_records, hashing_encoder(DIM), new_folder(spark, "progress"),
        state_key="atom", once=True, model_name=MODEL,
    ).awaitTermination()
    rows = listing.layer_counts(**{n: lake.read(n) for n in ("bronze", "silver", "gold")})
    stamp = F.date_format(fields.iso_timestamp(F.col("value")), "yyyy-MM-dd HH:mm:ss")
    state = lake.state().where(F.col("key") == "atom").select(
        F.lit("checkpoint").alias("layer"), stamp.alias("found")
    )
    return rows.select("layer", F.col("count").cast("string").alias("found")).unionByName(state)


def rss_feed(spark, folder):
    """Web pages as RSS items, read back as records without tags."""
    path = new_folder(spark, "rss")
    pages = table(spark, folder, "pages")
    items = pages.select(
        F.col("url").alias("title"),
        F.concat(F.lit("http://arxiv.org/abs/"), "page_id").alias("link"),
        F.col("html").alias("description"),
        F.concat(F.lit("A. Author, "), F.parse_url("url", F.lit("HOST")), F.lit(" , ,")).alias("creator"),
    )
    items.write.format("xml").option("rootTag", "rss").option("rowTag", "item").save(path)
    records = rss_records(scan_rss(spark, path), "cs", max_papers=None)
    return records.select(
        F.col("id").alias("page_id"),
        "title",
        F.md5("abstract").alias("abstract_md5"),
        F.array_join("authors", ";").alias("authors"),
        F.array_join("categories", ";").alias("categories"),
    )


# -- rows, fields, lists ------------------------------------------------------


def unprocessed_antijoin(spark, folder):
    documents = table(spark, folder, "documents").select("doc_id", "lang", "source")
    return listing.unprocessed(documents, table(spark, folder, "labels"), "doc_id")


def work_list_page(spark, folder):
    """Second page of 100 unprocessed documents."""
    return listing.work_list(unprocessed_antijoin(spark, folder), 100, 100, "doc_id").select("doc_id", "lang")


def missing_ids(spark, folder):
    """Vectors whose document has no label."""
    wanted = table(spark, folder, "embeddings").select(F.col("vec_id").alias("doc_id"))
    return listing.missing_ids(wanted, table(spark, folder, "labels"), "doc_id")


def keys_in_list(spark, folder):
    """Documents whose id is in the label table."""
    documents = table(spark, folder, "documents").select("doc_id", "source", "n_chars")
    return listing.in_list(documents, table(spark, folder, "labels"), "doc_id")


def reembed_pending(spark, folder):
    """Documents without a vector of one model, whatever others they have."""
    done = table(spark, folder, "labels").select(
        "doc_id", F.concat(F.lit("model-"), F.col("quality").cast("string")).alias("model_name")
    )
    wanted = table(spark, folder, "documents").select("doc_id", F.lit("model-1").alias("model_name"))
    return tables.absent_from(wanted, done, ["doc_id", "model_name"])


def layer_counts(spark, folder):
    return listing.layer_counts(
        bronze=table(spark, folder, "documents"),
        silver=table(spark, folder, "labels"),
        gold=table(spark, folder, "embeddings"),
    )


def key_uniqueness(spark, folder):
    documents, labels, vecs = (table(spark, folder, n) for n in ("documents", "labels", "embeddings"))
    return listing.key_counts(
        "key",
        bronze=documents.select(F.sha2("text", 256).alias("key")),
        silver=labels.select(F.col("doc_id").alias("key")),
        gold=vecs.select(F.col("vec_id").alias("key")),
    )


def peek_layers(spark, folder):
    """First two rows of the cleaned layer with previews."""
    silver = _silver(spark, folder).select(
        F.col("arxiv_id").cast("bigint").alias("id"), "arxiv_id", "title", "abstract_clean", "categories",
        F.col("published").alias("processed_at"),
    )
    return listing.peek_silver(silver).select("id", "arxiv_id", "title", "abstract_preview")


def peek_bronze_rows(spark, folder):
    """First two rows of the raw layer with previews."""
    bronze = table(spark, folder, "documents").select(
        F.col("doc_id").alias("id"), F.col("doc_id").cast("string").alias("arxiv_id"), F.col("source").alias("source_file"),
        _hours("doc_id").alias("ingested_at"), F.col("text").alias("raw_data"),
    )
    return listing.peek_bronze(bronze).select("id", "arxiv_id", "source_file", "raw_data_preview")


def previews_and_links(spark, folder):
    documents = table(spark, folder, "documents")
    paper = F.col("doc_id").cast("string")
    return documents.select(
        "doc_id",
        text.preview(F.col("text"), 120).alias("preview"),
        text.abs_url(paper).alias("arxiv_url"),
        text.pdf_url(paper).alias("pdf_url"),
    )


def strip_html(spark, folder):
    return spread(table(spark, folder, "pages")).select("page_id", text.strip_html(F.col("html")).alias("body"))


def url_extract(spark, folder):
    """Part of a link after its host; null where there is none."""
    return table(spark, folder, "pages").select(
        "page_id", text.id_from_url(F.col("url"), r"/([a-z]{2}/[0-9]+)$").alias("found")
    )


def json_props(spark, folder):
    """Fields of JSON texts, with a default for an absent one."""
    events = table(spark, folder, "events")
    k = fields.json_field(F.col("props"), "k", "bigint")
    missing = F.coalesce(fields.json_field(F.col("props"), "absent"), F.lit("none"))
    return events.select("event_id", k.alias("k"), missing.alias("absent"))


def category_dispatch(spark, folder):
    """Categories given as a list, as a text, or not at all, become one list."""
    documents = table(spark, folder, "documents")
    as_text = F.concat_ws(" ", F.lit(" "), "lang", F.lit("\t"), "source")
    line = (
        F.when(F.col("lang") == "en", F.to_json(F.struct("doc_id", F.array("lang", "source").alias("categories"))))
        .when(F.col("lang") == "fr", F.to_json(F.struct("doc_id")))
        .otherwise(F.to_json(F.struct("doc_id", as_text.alias("categories"))))
    )
    found = fields.tags(fields.parse_record(line)["categories"])
    return documents.select("doc_id", F.size(found).alias("n"), F.array_join(found, "|").alias("categories"))


def name_lists(spark, folder):
    """Names between commas, blanks dropped."""
    documents = table(spark, folder, "documents")
    names = text.comma_list(F.concat(F.lit(" "), "source", F.lit(",\n, "), "lang", F.lit(" , x y,")))
    return documents.select("doc_id", F.size(names).alias("n"), F.array_join(names, "|").alias("names"))


def tag_filter(spark, folder):
    """Documents with one of some tags whose text mentions a phrase."""
    documents = table(spark, folder, "documents")
    tags = F.array("lang", "source")
    keep = fields.any_tag(tags, ["de", "src7"]) & ~fields.has_tag(tags, "src9")
    return documents.where(keep & fields.mentions("st", F.col("text"))).select("doc_id", "lang", "source")


# -- time, state, snapshots ---------------------------------------------------


def date_range_filter(spark, folder):
    """Events of a range of days, both ends included."""
    events = table(spark, folder, "events")
    kept = events.where(fields.submitted_between(F.col("ts"), "20240105", "20240112"))
    return kept.groupBy("event_type", fields.day_text(F.col("ts")).alias("day")).agg(F.count(F.lit(1)).alias("n"))


def sorted_fetch(spark, folder):
    """Oldest events since a day in pages of 100, at most 1000 as asked for."""
    events = table(spark, folder, "events").select(F.col("event_id").alias("id"), F.col("ts").alias("published"), "event_type")
    found = fetch(events, since="20240110", where=F.col("event_type") != "error", max_total=1000)
    return found.select("id", "page")


def page_newest(spark, folder):
    """Newest time of each page, never before the checkpoint."""
    events = table(spark, folder, "events").select(F.col("event_id").alias("id"), F.col("ts").alias("published"))
    pages = fetch(events, since="20240120")
    newest = pages_newest(pages, F.lit(datetime(2024, 1, 20, 1, tzinfo=timezone.utc)))
    return newest.select("page", "rows", F.date_format("newest", "yyyy-MM-dd HH:mm:ss").alias("newest"))


def checkpoint_next(spark, folder):
    """Next checkpoint after all events: one second past the newest."""
    events = table(spark, folder, "events")
    since = F.lit(datetime(2024, 1, 1, tzinfo=timezone.utc))
    start = F.lit(datetime(2024, 2, 1, tzinfo=timezone.utc))
    found = next_checkpoint(events, since, start, "ts")
    return found.select("rows", F.date_format("checkpoint", "yyyy-MM-dd HH:mm:ss").alias("checkpoint"))


def state_latest(spark, folder):
    """Last value written per key of an event log."""
    events = table(spark, folder, "events")
    latest = tables.latest_by_key(events, "user_id", "props", "ts", "event_id")
    return latest.select("user_id", "props", "event_id")


def state_compacted(spark, folder):
    """Last value written per key, from a log of twelve writes (by hour of the day, so older values come late) that is merged after every five."""
    events = table(spark, folder, "events")
    state = KeyedState(spark, new_folder(spark, "state"), every=5)
    for part in range(12):
        rows = events.where(F.floor(F.hour("ts") / 2) == part)
        state.append(rows.select(F.col("user_id").cast("string").alias("key"), F.col("props").alias("value"), F.col("ts").alias("updated_at"), F.col("event_id").alias("version")))
    return state.read().select(
        F.col("key").cast("long").alias("user_id"), F.col("value").alias("props"), F.col("version").alias("event_id"),
        F.lit(len(state.sources())).alias("folders_read"),
    )


def key_sketches(spark, folder):
    """Users per week from daily sketches: a load of all but the last seven days, then one of everything that sketches the new days only."""
    events = table(spark, folder, "events").select("user_id", F.to_date("ts").alias("day"))
    last = events.agg(F.max("day").alias("last")).first()["last"]
    kept = KeySketches(spark, new_folder(spark, "sketches"))
    kept.refresh(events.where(F.col("day") <= F.date_sub(F.lit(last), 7)), "user_id", "day")
    renewed = kept.refresh(events, "user_id", "day")
    week = F.date_trunc("week", "day").cast("date").cast("string").alias("week")
    exact = events.groupBy(week).agg(F.count_distinct("user_id").alias("exact"))
    error = F.abs(F.col("distinct_keys") - F.col("exact"))
    return kept.counts(week).join(exact, "week").select(
        "week", "total", F.col("exact").alias("distinct_keys"), (error <= F.col("exact") * 4 * relative_error()).alias("within_error"),
        F.lit(renewed).alias("days_renewed"),
    )


def snapshot_retention(spark, folder):
    """Rows of the current weekly snapshot and the three before it."""
    weekly = table(spark, folder, "events").select(F.to_date(F.date_trunc("week", "ts")).alias("snapshot"), "value")
    kept = tables.kept_snapshots(weekly, "snapshot")
    counts = weekly.groupBy("snapshot").agg(F.count(F.lit(1)).alias("rows"))
    return counts.join(F.broadcast(kept), "snapshot", "left_semi").select(
        F.col("snapshot").cast("string").alias("snapshot"), "rows"
    )


# -- files ----------------------------------------------------------------------


def split_documents(spark, folder):
    """Lines of the record files in three contiguous parts."""
    lines = scan_lines(spark, _record_files(spark, folder))
    parts = split_parts(lines, 3)
    doc = F.get_json_object("value", "$.doc_id").cast("bigint")
    return parts.select(doc.alias("doc_id"), "part")


def head_sample(spark, folder):
    """First 200 lines of the record files."""
    lines = head_lines(scan_lines(spark, _record_files(spark, folder)), 200)
    return lines.select(F.get_json_object("value", "$.doc_id").cast("bigint").alias("doc_id"))


def jsonl_roundtrip(spark, folder):
    """Records written as JSON lines and read again."""
    lines = scan_lines(spark, _record_files(spark, folder))
    record = fields.parse_record(F.col("value"))
    return lines.select(record.alias("r")).select(
        F.try_variant_get("r.id", "$", "string").alias("id"),
        F.md5("r.abstract").alias("abstract_md5"),
        F.array_join(fields.names_list(F.col("r.authors")), ";").alias("authors"),
        F.date_format(fields.iso_timestamp(F.col("r.published")), "yyyyMMdd").alias("day"),
    )


# -- quality ------------------------------------------------------------------------


def _checked(spark, folder):
    documents = table(spark, folder, "documents")
    paper_id = F.when(F.col("lang") == "en", F.concat(F.lit("2401."), F.col("doc_id").cast("string"))).otherwise(
        F.concat("lang", F.lit("/"), F.lpad(F.col("doc_id").cast("string"), 7, "0"))
    )
    return documents.select(
        "doc_id", paper_id.alias("paper_id"), F.nullif(F.regexp_extract("text", r"^[^\n]*", 0), F.lit("")).alias("title"),
        F.col("text").alias("abstract"), "lang", "n_chars",
    )


def quality_report(spark, folder):
    """The contract's metrics with threshold and verdict."""
    rows = _checked(spark, folder)
    vecs = table(spark, folder, "embeddings").withColumn("doc_id", F.col("vec_id"))
    now = F.lit(datetime(2024, 2, 1, tzinfo=timezone.utc))
    events = table(spark, folder, "events")
    report = quality.report(
        quality.verdict(quality.embedding_completeness(rows, vecs, "doc_id", "embedding"), quality.COMPLETENESS),
        quality.verdict(quality.freshness_hours(events, "ts", now, F.col("event_type") != "error"), quality.FRESHNESS),
        quality.verdict(quality.schema_validity(rows, "paper_id", "title", "abstract"), quality.VALIDITY),
        quality.verdict(quality.dimension_consistency(vecs, "embedding", DIM), quality.DIMENSIONS),
    )
    return report.select("metric", F.round("value", 4).alias("value"), "threshold", "passed")


def quality_profile(spark, folder):
    """Rows, unique texts, filled columns and rule checks of the documents."""
    rows = _checked(spark, folder).withColumn("abstract_key", F.sha2("abstract", 256))
    profile = quality.column_profile(rows, "abstract_key", ["title", "abstract"])
    rules = quality.rule_validity(
        rows, long_enough_pct=F.col("n_chars") >= 100, known_lang_pct=F.col("lang").isin("en", "de", "fr")
    )
    labelled = quality.list_consistency(rows, "doc_id", table(spark, folder, "labels"), "doc_id")
    facts = [
        (profile, ["row_count", "unique_pct", "title_filled_pct", "abstract_filled_pct"]),
        (rules, ["long_enough_pct", "known_lang_pct"]),
        (labelled.withColumnRenamed("value", "labelled_pct"), ["labelled_pct"]),
    ]
    return quality.report(
        *[
            df.select(F.inline(F.array(*[
                F.struct(F.lit(n).alias("fact"), F.round(F.col(n).cast("double"), 4).alias("value")) for n in names
            ])))
            for df, names in facts
        ]
    )


QUERIES = {
    f.__name__: f
    for f in (
        text_search, text_search_filtered, vector_topk_multi, vector_topk_single, vector_topk_approx, vector_topk_pruned, vector_topk_pq, vector_recall,
        vector_topk_all_cells, vector_distance, vector_text, matryoshka_dims, hash_encoder,
        retrieval_metrics, test_set_scores, recent_papers, bronze_ingest, first_wins_many_files, stream_first_wins_state, full_then_incremental, latex_clean, reject_report, silver_clean, insert_if_absent,
        medallion_batch, stream_medallion, stream_replay, resumed_after_failure, archived_files, seeded_states, notified_load, notified_stream, atom_feed, feed_stream, rss_feed,
        unprocessed_antijoin, work_list_page, missing_ids, keys_in_list, reembed_pending, layer_counts,
        key_uniqueness, peek_layers, peek_bronze_rows, previews_and_links, strip_html, url_extract, json_props,
        category_dispatch, name_lists, tag_filter, date_range_filter, sorted_fetch, page_newest,
        checkpoint_next, state_latest, state_compacted, key_sketches, snapshot_retention, split_documents, head_sample,
        jsonl_roundtrip, quality_report, quality_profile,
    )
}
