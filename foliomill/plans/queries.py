"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator, each over whole tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foliomill.functions import text as tx
from foliomill.functions.splitter import recursive_chunks
from foliomill.operators import chat, enrich, evaluate, ivf, keyed, ranking, retrieval, sweep
from foliomill.plans import inputs, medallion
from foliomill.session import fresh_path
from foliomill.sources import files, tables
from foliomill.streaming import changes, ingest

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

TOP_K = 4
THRESHOLD = 0.4
IVF_K = 10
IVF_RECALL = 0.9
N_QUESTIONS = 1500
LAST_USED_ID = 1000
TRACE_MINUTES = 1440
GATE = {"judge_mean": 0.8, "recall_at_3": 0.01}
SWEEP_SETS = (
    sweep.ChunkParams(475, 50),
    sweep.ChunkParams(100, 20),
    sweep.ChunkParams(475, 48),
    sweep.ChunkParams(400, 40),
)
VECTORS = ("vec_id", "embedding")


def query(fn: Query) -> Query:
    REGISTRY[fn.__name__] = fn
    return fn


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.table(spark, sf_dir, "documents")


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.table(spark, sf_dir, "pages")


def _conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.table(spark, sf_dir, "conversations")


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.table(spark, sf_dir, "events")


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = _events(spark, sf_dir).schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)


def _batch_chunks(text: Column) -> Column:
    return tx.fixed_chunks(text, *medallion.BATCH_CHUNKS)


def _json(value: str) -> Column:
    return F.to_json(F.col(value))


# --- sources and tables -------------------------------------------------------------------------------------------


def _text_folder(spark: SparkSession, sf_dir: str) -> str:
    """Documents as text files in a folder per language, beside files that no scan for texts may find."""
    docs = inputs.table(spark, sf_dir, "documents").select("text", "lang")
    docs.write.partitionBy("lang").text(folder := fresh_path(spark, "texts"))
    docs.write.parquet(f"{folder}/other")
    return folder


def _bytes_per_language(found: DataFrame, path: str) -> DataFrame:
    lang = F.regexp_extract(path, "/lang=([^/]+)/", 1)
    return found.groupBy(lang.alias("lang")).agg(F.sum("length").alias("n_bytes"))


@query
def bronze_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row is a line of a file, so the files' lengths are the texts' bytes and one line end each."""
    return _bytes_per_language(files.scan_binary(spark, _text_folder(spark, sf_dir), "*.txt"), "input_file")


@query
def bronze_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = fresh_path(spark, "bronze_stream")
    stream = files.stream_binary(spark, _text_folder(spark, sf_dir), "*.txt").select("path", "length", "content")
    landed = ingest.drain_to_table(stream, f"{run}/table", f"{run}/checkpoint")
    return _bytes_per_language(landed.withColumn("length", F.octet_length("content").cast("bigint")), "path")


@query
def bronze_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.page_files(spark, sf_dir).select("path", "length", F.md5("content").alias("content_md5"))


@query
def filter_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.suffix_filter(inputs.table(spark, sf_dir, "pages").select("page_id", "url"), "url", ".html")


@query
def ingest_changed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user's events are one file, rewritten by every event; the known version ends at the last good event."""
    path = F.concat(F.lit("user-"), F.col("user_id").cast("string")).alias("path")
    written = F.max("ts").alias("modificationTime")
    events = _events(spark, sf_dir)
    listing = events.groupBy(path).agg(written)
    known = events.filter("event_type <> 'error'").groupBy(path).agg(written)
    return files.changed_files(listing, known)


@query
def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = fresh_path(spark, "stream_ingest")
    return ingest.drain_to_table(_event_stream(spark, sf_dir), f"{run}/table", f"{run}/checkpoint")


@query
def append_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = fresh_path(spark, "append_flow")
    stream = _event_stream(spark, sf_dir).select("event_id", "user_id", "event_type")
    failed = F.col("event_type") == "error"
    for name, part in (("failures", stream.filter(failed)), ("activity", stream.filter(~failed))):
        ingest.run_flow(part, f"{run}/table", name, f"{run}/checkpoint-{name}")
    return ingest.flow_rows(stream, f"{run}/table").drop("batch_id")


@query
def snapshot_ctas(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = inputs.table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars", F.md5("text").alias("text_md5"))
    return tables.snapshot_table(docs, f"snapshot_{uuid.uuid4().hex}", fresh_path(spark, "snapshot"))


# --- pages, text and chunks ---------------------------------------------------------------------------------------


def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return medallion.silver_pages(inputs.document_files(spark, sf_dir), "txt", inputs.as_of())


@query
def silver_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _silver(spark, sf_dir).select("input_file", "page_nr", "page_content", "document_name")


@query
def document_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = inputs.table(spark, sf_dir, "pages")
    return pages.select("page_id", "url", tx.document_name(F.col("url"), "html").alias("document_name"))


@query
def html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pages(spark, sf_dir).select("page_id", tx.html_text(F.col("html")).alias("extracted_text"))


@query
def doc_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    whole = tx.join_pages(enrich.text_pages(F.col("content")))
    return inputs.document_files(spark, sf_dir).select("input_file", whole.alias("extracted_text"))


@query
def chunk_fixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = inputs.table(spark, sf_dir, "documents")
    return enrich.chunk_fixed(docs, "text", *medallion.BATCH_CHUNKS).select("doc_id", "chunk_ix", "content_chunk")


def _recursive_check(spark: SparkSession, sf_dir: str, size: int, overlap: int) -> DataFrame:
    """Chunk count of every document and a digest of its chunks in order."""
    docs = _documents(spark, sf_dir).select("doc_id", recursive_chunks(F.col("text"), size, overlap).alias("chunks"))
    return docs.select(
        "doc_id", F.size("chunks").cast("bigint").alias("n_chunks"), F.md5(F.array_join("chunks", "\x1f")).alias("chunks_md5")
    )


@query
def chunk_recursive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _recursive_check(spark, sf_dir, *medallion.BATCH_CHUNKS)


@query
def chunk_recursive_small(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _recursive_check(spark, sf_dir, *medallion.INCREMENTAL_CHUNKS)


@query
def gold_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    gold = medallion.gold_chunks(_silver(spark, sf_dir), as_of=inputs.as_of())
    return tables.overwrite_table(gold, fresh_path(spark, "gold"), medallion.GOLD_SCHEMA)


@query
def evaluation_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Good recent traces go into the evaluation set; equal inputs are one record, and known expectations stay."""
    events = _events(spark, sf_dir)
    start = evaluate.window_start(inputs.newest_time(events), TRACE_MINUTES)
    recent = evaluate.recent_traces(inputs.traces(events), "ts", "status", start).select("event_id")
    request = F.md5(F.concat_ws("#", "event_type", "props")).alias("input_hash")
    traced = events.join(recent, "event_id", "left_semi").select("event_id", request, F.lit(None).cast("double").alias("expected"))
    known = events.filter("event_type = 'purchase'").select("event_id", request, F.col("value").alias("expected"))
    return keyed.merge_records(known, traced, ["input_hash"], ["event_id"], ["expected"])


@query
def gold_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = medallion.extracted_texts(inputs.page_files(spark, sf_dir), ".html")
    gold = medallion.topics_and_chunks(texts)
    return gold.select("path", "length", "topic", "parsed_topic_str", "chunk_ix", "chunked_text")


@query
def doc_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _pages(spark, sf_dir).select("url", tx.html_text(F.col("html")).alias("text"))
    chunked = pages.withColumn("chunks", _batch_chunks(F.col("text")))
    reason = enrich.coverage_reason(F.col("text"), F.col("chunks"), F.col("url").endswith(".html"))
    n_chunks = F.when(F.col("reason") == "chunked", F.size("chunks")).otherwise(0)
    return (
        chunked.withColumn("reason", reason)
        .groupBy("reason")
        .agg(F.count(F.lit(1)).alias("n_pages"), F.sum(n_chunks).cast("bigint").alias("n_chunks"))
    )


@query
def union_modalities(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = F.concat(F.lit("documents/"), F.col("doc_id").cast("string")).alias("path")
    docs = inputs.table(spark, sf_dir, "documents").select(path, F.col("text").alias("extracted_text"), "lang")
    pages = _pages(spark, sf_dir).select(F.col("url").alias("path"), tx.html_text(F.col("html")).alias("extracted_text"), "page_id")
    return enrich.combine_modalities(docs, pages)


@query
def prompt_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    request = enrich.build_request(inputs.PROMPT, F.col("text"))
    docs = inputs.table(spark, sf_dir, "documents").select("doc_id", request.alias("request"))
    return docs.select("doc_id", F.md5("request").alias("request_md5"), F.length("request").cast("bigint").alias("n_chars"))


@query
def topic_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir).select("doc_id", enrich.topic_json(F.col("text")).alias("topic"))
    return enrich.parse_topic(docs)


@query
def json_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = _events(spark, sf_dir).select("event_id", F.from_json("props", "k int").alias("p"))
    return parsed.select("event_id", "p.k", F.to_json("p").alias("props_json"))


# --- keys, changes and history ------------------------------------------------------------------------------------


@query
def change_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    before, after = inputs.snapshot_before(spark, sf_dir), inputs.snapshot_after(spark, sf_dir)
    return keyed.change_feed(before, after, ["doc_id"], 1)


@query
def cdc_scd1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed.current_rows(inputs.event_changes(_events(spark, sf_dir)), ["user_id"], inputs.CHANGE_ORDER)


@query
def cdc_scd1_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = fresh_path(spark, "cdc_scd1_stream")
    stream = inputs.event_changes(_event_stream(spark, sf_dir))
    changes.ingest_changes(stream, f"{run}/changes", f"{run}/checkpoint", ["user_id"], inputs.CHANGE_ORDER)
    return changes.read_current(stream, f"{run}/changes", ["user_id"], inputs.CHANGE_ORDER)


@query
def cdc_scd2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed.history_rows(inputs.event_changes(_events(spark, sf_dir)), ["user_id"], inputs.CHANGE_ORDER)


@query
def key_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = inputs.table(spark, sf_dir, "documents")
    checks = [
        keyed.key_violations(docs, ["doc_id"], "documents by doc_id"),
        keyed.key_violations(docs.select(F.md5("text").alias("text")), ["text"], "documents by text"),
        keyed.key_violations(_conversations(spark, sf_dir), ["conv_id", "turn"], "conversations by conv_id, turn"),
        keyed.key_violations(_conversations(spark, sf_dir), ["conv_id"], "conversations by conv_id"),
    ]
    return enrich.combine_modalities(*checks)


@query
def merge_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = inputs.table(spark, sf_dir, "documents").select("doc_id", F.md5("text").alias("input_hash"))
    labels = inputs.table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("expected"))
    existing = docs.join(labels, "doc_id")
    incoming = docs.join(labels, "doc_id", "left_anti").withColumn("expected", F.lit(None).cast("int"))
    return keyed.merge_records(existing, incoming, ["input_hash"], ["doc_id"], ["expected"])


@query
def identity_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _silver(spark, sf_dir).select("input_file", "page_nr")
    return ranking.identity_ids(pages, ["input_file", "page_nr"], LAST_USED_ID)


# --- retrieval ----------------------------------------------------------------------------------------------------


def _vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.table(spark, sf_dir, "embeddings")


@query
def embed_hashed(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = inputs.table(spark, sf_dir, "benchmark")
    cells = F.posexplode(tx.hashed_embedding(F.col("text"))).alias("bucket", "weight")
    weights = items.select("item_id", cells).filter("weight > 0")
    return weights.withColumn("weight", F.round("weight", 6))


def _printed(embedding: str) -> Column:
    """Non-zero weights in millionths, as ``bucket:weight`` in bucket order."""
    cells = F.transform(
        F.col(embedding), lambda w, ix: F.when(w > 0, F.concat_ws(":", ix, F.round(w * 1_000_000).cast("bigint")))
    )
    return F.array_join(cells, ",")


def _chunk_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    gold = medallion.gold_chunks(_silver(spark, sf_dir), _batch_chunks, inputs.as_of())
    return retrieval.index_rows(gold, "chunk_id", "content_chunk")


@query
def index_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = f"chunk_index_{uuid.uuid4().hex}"
    index = retrieval.write_index(_chunk_index(spark, sf_dir), name, fresh_path(spark, "index"), "chunk_id")
    return index.select("chunk_id", "text_hash", _printed("embedding").alias("embedding_e6"))


@query
def index_sync(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = retrieval.index_rows(inputs.snapshot_before(spark, sf_dir), "doc_id", "text")
    plan = retrieval.sync_plan(index, inputs.snapshot_after(spark, sf_dir), "doc_id", "text")
    return retrieval.embed_changes(plan, "doc_id").select("doc_id", "action", _printed("embedding").alias("embedding_e6"))


@query
def index_after_sync(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored index after the source has moved on."""
    before = retrieval.index_rows(inputs.snapshot_before(spark, sf_dir), "doc_id", "text")
    index = retrieval.write_index(before, f"doc_index_{uuid.uuid4().hex}", fresh_path(spark, "index"), "doc_id")
    synced = retrieval.apply_sync(index, inputs.snapshot_after(spark, sf_dir), "doc_id", "text")
    return synced.select("doc_id", "text_hash", _printed("embedding").alias("embedding_e6"))


@query
def vector_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _vectors(spark, sf_dir)
    return retrieval.top_k(vectors, vectors, TOP_K, index_cols=VECTORS, query_cols=VECTORS, skip_self=True)


@query
def vector_topk_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same hits from a grid of many small tiles."""
    vectors = _vectors(spark, sf_dir)
    tiles = {"query_tile": 200, "index_tile": 300, "cell_pairs": 2}
    return retrieval.top_k(vectors, vectors, TOP_K, index_cols=VECTORS, query_cols=VECTORS, skip_self=True, **tiles)


@query
def vector_topk_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _vectors(spark, sf_dir)
    index = vectors.filter("label = 3")
    return retrieval.top_k(index, vectors, TOP_K, index_cols=VECTORS, query_cols=VECTORS, skip_self=True)


@query
def vector_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _vectors(spark, sf_dir)
    return retrieval.top_k(
        vectors, vectors, TOP_K, index_cols=VECTORS, query_cols=VECTORS, min_score=THRESHOLD, skip_self=True
    )


@query
def vector_mmr(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _vectors(spark, sf_dir)
    return retrieval.diverse_top_k(vectors, vectors, 3, 10, 0.5, index_cols=VECTORS, query_cols=VECTORS, skip_self=True)


@query
def recall_at_3(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _vectors(spark, sf_dir)
    hits = retrieval.top_k(vectors, vectors, 3, index_cols=VECTORS, query_cols=VECTORS, skip_self=True)
    labels = vectors.select(F.col("vec_id").alias("id"), "label")
    return retrieval.recall_at_k(hits, 3, labels, labels)


def _ivf_hits(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Approximate and exact hits of the vectors whose number is divisible by 20 among all vectors."""
    vectors = _vectors(spark, sf_dir).select(F.col("vec_id").alias("id"), F.col("embedding").alias("vec"))
    asked = vectors.filter("id % 20 = 0")
    index = ivf.build_ivf(vectors, ivf.fit_centroids(vectors, k=IVF_K))
    columns = ("id", "vec")
    exact = retrieval.top_k(vectors, asked, IVF_K, index_cols=columns, query_cols=columns, skip_self=True)
    return ivf.ivf_top_k(index, asked, IVF_K, skip_self=True), exact


@query
def vector_ivf_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ivf_hits(spark, sf_dir)[0]


@query
def vector_ivf_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = ivf.recall_of(*_ivf_hits(spark, sf_dir))
    return counts.select("n_queries", "n_wanted", (F.col("n_found") >= IVF_RECALL * F.col("n_wanted")).alias("enough"))


def _questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.table(spark, sf_dir, "benchmark").select("item_id", tx.hashed_embedding(F.col("text")).alias("embedding"))


@query
def retrieve_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents to pages to chunks to vectors, and the best chunks for every question."""
    hits = retrieval.top_k(
        _chunk_index(spark, sf_dir),
        _questions(spark, sf_dir),
        TOP_K,
        index_cols=("chunk_id", "embedding"),
        query_cols=("item_id", "embedding"),
    )
    return hits.select(F.col("query_id").alias("item_id"), F.col("id").alias("chunk_id"), "score", "rank")


# --- evaluation, monitoring, tuning -------------------------------------------------------------------------------


@query
def eval_allocation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.allocate_questions(inputs.table(spark, sf_dir, "documents"), "doc_id", N_QUESTIONS)


def _scored(spark: SparkSession, sf_dir: str, *facts: DataFrame) -> DataFrame:
    """Every answered turn, with the facts of its conversation where there are any.

    Facts are one row per conversation, so the turns of a busy one can be dealt out over several tasks at run time.
    """
    rows = inputs.answered_sets(spark, sf_dir)
    for own in facts:
        rows = rows.join(own, "conv_id", "left")
    return rows


def _contexts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.context_sets(spark, sf_dir, *medallion.BATCH_CHUNKS)


@query
def score_correctness(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _scored(spark, sf_dir, inputs.expected_sets(spark, sf_dir))
    score = evaluate.where_known(evaluate.correctness(F.col("a"), F.col("e")), "e")
    return rows.select("conv_id", "turn", score.alias("correctness"), evaluate.missing_reason(e="no expected response").alias("reason"))


@query
def score_sufficiency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per answered turn: the expected response of its conversation against the context."""
    rows = _scored(spark, sf_dir, inputs.expected_sets(spark, sf_dir), _contexts(spark, sf_dir))
    score = evaluate.where_known(evaluate.covered_share(F.col("e"), F.col("c")), "e", "c")
    reason = evaluate.missing_reason(e="no expected response", c="no context")
    return rows.select("conv_id", "turn", score.alias("sufficiency"), reason.alias("reason"))


@query
def score_relevance(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.answered_sets(spark, sf_dir)
    return rows.select("conv_id", "turn", evaluate.relevance(F.col("q"), F.col("a")).alias("relevance"))


@query
def score_groundedness(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _scored(spark, sf_dir, _contexts(spark, sf_dir))
    score = evaluate.where_known(evaluate.covered_share(F.col("a"), F.col("c")), "c")
    return rows.select("conv_id", "turn", score.alias("groundedness"), evaluate.missing_reason(c="no context").alias("reason"))


@query
def score_chunk_relevance(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _scored(spark, sf_dir, _contexts(spark, sf_dir))
    score = evaluate.where_known(evaluate.chunk_relevance(F.col("q"), F.col("cs")), "cs")
    return rows.select("conv_id", "turn", score.alias("chunk_relevance"), evaluate.missing_reason(cs="no context").alias("reason"))


def _labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = inputs.table(spark, sf_dir, "documents").select("doc_id", "lang")
    return docs.join(inputs.table(spark, sf_dir, "labels"), "doc_id")


@query
def score_safety(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.safety_rate(_labelled(spark, sf_dir), ["lang"], "toxic")


@query
def score_guidelines(spark: SparkSession, sf_dir: str) -> DataFrame:
    answers = _conversations(spark, sf_dir).filter("role = 'assistant'")
    return evaluate.score_guidelines(answers, "text", ["conv_id", "turn"])


def _safe(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = inputs.table(spark, sf_dir, "labels")
    return labels.select(F.col("doc_id").alias("conv_id"), (1 - F.col("toxic")).alias("safety"))


@query
def score_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All scorers in one row per answered turn. The facts of a conversation meet first, the turns join them once."""
    facts = inputs.expected_sets(spark, sf_dir).join(_contexts(spark, sf_dir), "conv_id", "full_outer")
    facts = facts.join(_safe(spark, sf_dir), "conv_id", "full_outer")
    rows = _scored(spark, sf_dir, facts)
    q, a, e, c = (F.col(name) for name in ("q", "a", "e", "c"))
    rules = [evaluate.follows(r, F.col("answer")).cast("int").alias(r.name) for r in evaluate.GUIDELINES]
    return rows.select(
        "conv_id",
        "turn",
        evaluate.where_known(evaluate.correctness(a, e), "e").alias("correctness"),
        evaluate.where_known(evaluate.covered_share(e, c), "e", "c").alias("sufficiency"),
        evaluate.relevance(q, a).alias("relevance"),
        evaluate.where_known(evaluate.covered_share(a, c), "c").alias("groundedness"),
        evaluate.where_known(evaluate.chunk_relevance(q, F.col("cs")), "cs").alias("chunk_relevance"),
        "safety",
        evaluate.missing_reason(e="no expected response", c="no context", safety="no label").alias("reason"),
        *rules,
    )


def _request_id() -> Column:
    return F.concat_ws("#", F.col("conv_id").cast("string"), F.col("turn").cast("string"))


@query
def monitor_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = _conversations(spark, sf_dir).filter("role = 'user'").select("conv_id", "turn")
    return evaluate.monitor_sample(asked, _request_id())


@query
def monitor_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Continuous monitoring: each judge scores the requests of its own sample. Requests without an answer, a context or a
    label stay in, with nulls and the reason."""
    asked = _conversations(spark, sf_dir).filter("role = 'user'").select("conv_id", "turn")
    facts = _contexts(spark, sf_dir).join(_safe(spark, sf_dir), "conv_id", "full_outer")
    rows = asked.join(inputs.answered_sets(spark, sf_dir), ["conv_id", "turn"], "left").join(facts, "conv_id", "left")
    requests = evaluate.monitor_sample(rows, _request_id())
    q, a, c = F.col("q"), F.col("a"), F.col("c")
    scores = {
        "safety": F.col("safety"),
        "groundedness": evaluate.where_known(evaluate.covered_share(a, c), "a", "c"),
        "relevance_to_query": evaluate.where_known(evaluate.relevance(q, a), "a"),
        "chunk_relevance": evaluate.where_known(evaluate.chunk_relevance(q, F.col("cs")), "q", "cs"),
    }
    reason = evaluate.missing_reason(a="no answer", c="no context", safety="no label")
    return evaluate.score_sampled(requests.withColumn("reason", reason), ["conv_id", "turn", "reason"], scores)


@query
def trace_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _events(spark, sf_dir)
    start = evaluate.window_start(inputs.newest_time(events), TRACE_MINUTES)
    return evaluate.ranked_traces(evaluate.recent_traces(inputs.traces(events), "ts", "status", start), "ts", "event_id")


@query
def trace_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _events(spark, sf_dir)
    recent = F.col("ts") > evaluate.window_start(inputs.newest_time(events), TRACE_MINUTES)
    return inputs.traces(events).groupBy("status").agg(
        F.count(F.lit(1)).alias("n_traces"), F.sum(recent.cast("bigint")).alias("n_recent")
    )


def _judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _labelled(spark, sf_dir).select("lang", "quality", (1 - F.col("toxic")).alias("safety"))


@query
def judge_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.judge_means(_judged(spark, sf_dir), ["lang"], ["quality", "safety"])


@query
def quality_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = _judged(spark, sf_dir).agg(((F.avg("quality") + F.avg("safety")) / 2).alias("judge_mean"))
    recall = recall_at_3(spark, sf_dir).agg(F.avg("recall").alias("recall_at_3"))
    one_row = enrich.combine_modalities(judged, recall).agg(*[F.max(m).alias(m) for m in GATE])
    return evaluate.quality_gate(one_row, GATE)


@query
def sweep_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sweep.sweep_chunks(_documents(spark, sf_dir), "text", SWEEP_SETS)


@query
def sweep_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus is read once, cut by every set, and all chunks meet the questions in one join."""
    docs, sets = _documents(spark, sf_dir), sweep.DEFAULT_SETS
    chunks = sweep.chunks_by_run(docs.select("doc_id", "text"), "text", sets)
    keyed_chunks = chunks.withColumn("chunk_id", enrich.chunk_id("doc_id", "chunk_ix"))
    index = keyed_chunks.select("run", "chunk_id", tx.hashed_embedding(F.col("content_chunk")).alias("embedding"))
    hits = retrieval.top_k_by_run(
        index,
        _questions(spark, sf_dir),
        {n: p.top_k for n, p in enumerate(sets)},
        index_cols=("chunk_id", "embedding"),
        query_cols=("item_id", "embedding"),
    )
    names = F.array(*[F.lit(p.run_id) for p in sets])
    return sweep.compare_runs(hits.withColumn("run_id", F.get(names, F.col("run").cast("int"))), "score")


# --- conversations and memory -------------------------------------------------------------------------------------


@query
def valid_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.valid_messages(_conversations(spark, sf_dir))


@query
def memory_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.keyword_messages(_conversations(spark, sf_dir), inputs.KEYWORD).select("conv_id", "turn", "text")


@query
def thread_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = chat.thread_pages(chat.valid_messages(_conversations(spark, sf_dir)), "conv_id", "turn", "role", "text")
    return pages.select("conv_id", "page", "n_messages", _json("messages").alias("messages_json"))


@query
def history_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    requests = chat.request_histories(_conversations(spark, sf_dir), "conv_id", "turn", "role", "text")
    return requests.select(
        "conv_id",
        "turn",
        "earlier_pages",
        F.size("messages").cast("bigint").alias("n_messages"),
        _json("messages").alias("messages_json"),
    )


@query
def full_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last request of every conversation with all that was said before, in pages of four turns."""
    messages = _conversations(spark, sf_dir)
    last = messages.filter("role = 'user'").groupBy("conv_id").agg(F.max("turn").alias("turn"))
    pages = chat.full_histories(messages, last, "conv_id", "turn", "role", "text", 4)
    return pages.select("conv_id", "turn", "page", "n_messages", _json("messages").alias("messages_json"))


@query
def last_message(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.last_messages(_conversations(spark, sf_dir), "conv_id", "turn")


@query
def with_system(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = _conversations(spark, sf_dir)
    threads = chat.thread_pages(messages.filter("role <> 'system'"), "conv_id", "turn", "role", "text")
    system = keyed.newest_per_key(messages.filter("role = 'system'"), ["conv_id"], ["turn"])
    system = system.select("conv_id", F.col("text").alias("system"))
    return chat.open_threads(threads, system, "conv_id").select("conv_id", "page", _json("messages").alias("messages_json"))


@query
def pairs_to_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.pairs_to_messages(inputs.answered(spark, sf_dir), ["conv_id", "turn"], "question", "answer")


@query
def normalize_response(spark: SparkSession, sf_dir: str) -> DataFrame:
    message = F.struct("role", F.col("text").alias("content"))
    reply = (
        F.when(F.col("role") == "user", F.to_json(F.struct(F.array(message, message).alias("messages"))))
        .when(F.col("role") == "assistant", F.to_json(F.struct(F.array(F.struct(message.alias("message"))).alias("choices"))))
        .otherwise("no answer")
    )
    replies = _conversations(spark, sf_dir).select("conv_id", "turn", reply.alias("reply"))
    parsed = chat.normalize_reply(replies, "reply")
    last = chat.last_of(F.col("messages"))
    return parsed.select("conv_id", "turn", "status", last["role"].alias("role"), last["content"].alias("content"))


@query
def sources_render(spark: SparkSession, sf_dir: str) -> DataFrame:
    def source(name: Column, page: str) -> Column:
        return F.struct(name.alias("doc_name"), F.col(page).cast("string").alias("page_nr"))

    listed = F.to_json(F.array(source(F.col("source"), "n_chars"), source(F.concat_ws("-", "lang", "source"), "doc_id")))
    sources = F.when(F.col("lang") == "es", "").when(F.col("lang") == "de", "[]").otherwise(listed)
    docs = inputs.table(spark, sf_dir, "documents")
    return docs.select("doc_id", chat.render_answer(F.col("text"), sources).alias("rendered"))


def _memories(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = _conversations(spark, sf_dir).withColumn("user_id", F.col("conv_id") % inputs.N_USERS)
    puts = chat.memory_puts(messages.filter("role = 'user'"), "user_id", ["conv_id", "turn"], inputs.KEYWORD)
    return chat.stored_memories(puts, ["conv_id", "turn"])


@query
def memory_put(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _memories(spark, sf_dir).select("namespace", "user_id", "key", "data")


def _memory_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = _conversations(spark, sf_dir).filter("role = 'user'").withColumn("user_id", F.col("conv_id") % inputs.N_USERS)
    last = keyed.newest_per_key(asked, ["user_id"], ["conv_id", "turn"]).select("user_id", F.col("text").alias("query"))
    return chat.search_memories(_memories(spark, sf_dir), last)


@query
def memory_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _memory_hits(spark, sf_dir)


@query
def memory_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.memory_context(_memory_hits(spark, sf_dir), inputs.SYSTEM_INTRO)
