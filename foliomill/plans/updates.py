"""Registered queries over batches: tables, history, chunks and index that are kept up to date, and their SQL.

Batches come from the shared tables: documents appear, are cut short, vanish, come back and are delivered again with the
text they had; events arrive in parts that overlap in time, so that some are late.
"""

from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from foliomill.operators import answers, enrich, keyed, parse, refresh
from foliomill.operators.enrich import chunk_id
from foliomill.plans import inputs, medallion, oracle
from foliomill.plans.queries import _events, _printed, query
from foliomill.session import fresh_path
from foliomill.sources import checked
from foliomill.sources.buckets import BucketTable
from foliomill.sources.parts import PartTable
from foliomill.sources.tables import overwrite_table
from foliomill.streaming import evolving
from foliomill.streaming.history import ingest_history, read_history

N_BATCHES = 3
EVENT_PARTS = 4
BUCKETS = 16
KEYS = ("path",)
ORDER = ["version"]

# doc_id decides what happens to a document in a batch: (batch, condition, change, text); the first that holds counts
STEPS = (
    (1, "doc_id % 10 <> 3", "insert", "text"),
    (2, "doc_id % 10 = 3", "insert", "text"),
    (2, "doc_id % 5 = 1", "update_postimage", "substring(text, 1, length(text) // 2)"),
    (2, "doc_id % 10 = 7", "delete", "NULL"),
    (3, "doc_id % 9 = 4", "delete", "NULL"),
    (3, "doc_id % 20 = 7", "insert", "concat(text, ' again')"),
    (3, "doc_id % 6 = 2", "update_postimage", "text"),
)
SHORTER = "substring(text, 1, cast(floor(length(text) / 2) AS int))"


def document_batch(spark: SparkSession, sf_dir: str, number: int) -> DataFrame:
    """``path, extracted_text, version, _change_type`` of the documents that a batch brings."""
    docs = inputs.table(spark, sf_dir, "documents")
    path = F.concat(F.lit("/"), F.col("source"), F.lit("/Doc "), F.col("doc_id").cast("string"), F.lit(".txt"))
    step = None
    for batch, condition, change, text in STEPS:
        if batch == number:
            value = F.expr(SHORTER if "//" in text else f"cast({text} AS string)")
            row = F.struct(F.lit(change).alias("change"), value.alias("text"))
            step = F.when(F.expr(condition), row) if step is None else step.when(F.expr(condition), row)
    rows = docs.select(path.alias("path"), step.alias("_step")).filter("_step IS NOT NULL")
    return rows.select(
        "path", F.col("_step.text").alias("extracted_text"), F.lit(number).cast("bigint").alias("version"), F.col("_step.change").alias("_change_type")
    )


# fixed shapes of the tables
SHAPES = {
    "current": "path string, extracted_text string, version bigint, _change_type string",
    "gold": "path string, chunk_id string, chunk_ix int, chunked_text string, topic string, parsed_topic_str string",
    "index": "path string, chunk_id string, text_hash string, embedding array<double>",
}


def _tables(root: str) -> dict[str, PartTable]:
    return {name: PartTable(f"{root}/{name}", KEYS, StructType.fromDDL(shape), BUCKETS) for name, shape in SHAPES.items()}


def cut(texts: DataFrame, splitter: medallion.Splitter = medallion.incremental_splitter) -> DataFrame:
    """Topic and chunks of changed documents, with a key that depends on file and position only."""
    return medallion.topics_and_chunks(texts, splitter).withColumn("chunk_id", chunk_id("path", "chunk_ix"))


def refresh_all(
    spark: SparkSession, batches: list[DataFrame], root: str, upto: str, splitter: medallion.Splitter = medallion.incremental_splitter
) -> dict[str, PartTable]:
    """Fold batches one after another into the tables down to ``upto`` (``current``, ``gold`` or ``index``)."""
    tables = _tables(root)
    for version, batch in enumerate(batches, 1):
        buckets = refresh.refresh_current(tables["current"], batch, ORDER, version)
        if upto == "current":
            continue
        delta = refresh.document_delta(tables["current"], spark, buckets, version, "extracted_text")
        delta = overwrite_table(delta, f"{root}/delta/version={version}")
        refresh.refresh_derived(tables["gold"], tables["current"], delta, version, lambda texts: cut(texts, splitter))
        if upto == "index":
            refresh.refresh_index(tables["index"], tables["gold"], delta, version, "chunked_text")
    return tables


def _refreshed(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    batches = [document_batch(spark, sf_dir, n) for n in range(1, N_BATCHES + 1)]
    return refresh_all(spark, batches, fresh_path(spark, "refresh"), name)[name].read(spark)


@query
def refresh_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    return refresh.live(_refreshed(spark, sf_dir, "current")).drop("_change_type")


@query
def refresh_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _refreshed(spark, sf_dir, "gold").drop("chunk_id")


@query
def refresh_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _refreshed(spark, sf_dir, "index").select("chunk_id", "text_hash", _printed("embedding").alias("embedding_e6"))


def _history_of_parts(spark: SparkSession, parts: list[DataFrame], keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """History kept by a stream of files that is drained after each part has arrived."""
    run = fresh_path(spark, "history")
    for part in parts:
        part.write.mode("append").parquet(f"{run}/arrived")
        stream = spark.readStream.schema(part.schema).parquet(f"{run}/arrived")
        ingest_history(stream, f"{run}/table", f"{run}/checkpoint", keys, order, BUCKETS)
    return read_history(parts[0], f"{run}/table", keys, order)


@query
def refresh_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every version of every document, kept batch by batch."""
    batches = [document_batch(spark, sf_dir, n) for n in range(1, N_BATCHES + 1)]
    return _history_of_parts(spark, batches, KEYS, ORDER).withColumn("extracted_text", F.md5("extracted_text"))


def _event_parts(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    changes = inputs.event_changes(_events(spark, sf_dir))
    return [changes.filter(F.pmod(F.xxhash64("event_id"), F.lit(EVENT_PARTS)) == n) for n in range(EVENT_PARTS)]


@query
def cdc_scd2_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """History of every user from parts of the events that overlap in time."""
    return _history_of_parts(spark, _event_parts(spark, sf_dir), ["user_id"], inputs.CHANGE_ORDER)


@query
def cdc_scd1_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Current row of every user from the same parts; each rewrites the buckets of its users only."""
    parts = _event_parts(spark, sf_dir)
    table = BucketTable(fresh_path(spark, "cdc_scd1_buckets"), ("user_id",), parts[0].schema, BUCKETS)
    for version, part in enumerate(parts, 1):
        refresh.refresh_current(table, part, inputs.CHANGE_ORDER, version)
    return refresh.live(table.read(spark)).drop("_change_type")


@query
def cdc_scd1_patch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Current row of every user where a third of the changes lack the value and a quarter the properties."""
    events = inputs.event_changes(_events(spark, sf_dir))
    sparse = events.withColumns(
        {"value": F.when(F.col("event_id") % 3 != 0, F.col("value")), "props": F.when(F.col("event_id") % 4 != 1, F.col("props"))}
    )
    return keyed.patched_rows(sparse, ["user_id"], inputs.CHANGE_ORDER)


def frequent_words(requests: pd.Series) -> pd.Series:
    """Stand-in for a model: the topic of the document behind a prompt as JSON."""

    def topic(request: str) -> str:
        words = Counter(w for w in re.findall("[a-z]+", request[len(inputs.PROMPT) :].lower()) if len(w) >= enrich.MIN_TOPIC_LETTERS)
        best = min(words, key=lambda w: (-words[w], w), default=enrich.NO_TOPIC)
        return json.dumps({"topic": best}, separators=(",", ":"))

    return requests.map(topic)


@query
def infer_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topics from a model that is asked about every second document first and about all later: each request is sent once."""
    store = fresh_path(spark, "answers")
    docs = inputs.table(spark, sf_dir, "documents").select("doc_id", "text")
    request = enrich.build_request(inputs.PROMPT, F.col("text"))
    answers.ask_missing(docs.filter("doc_id % 2 = 0").select(request.alias("request")), store, frequent_words, 1)
    return answers.infer_once(docs, request, store, frequent_words, 2).select("doc_id", "answer", "run")


# what damages a page: (condition on page_id, content)
NO_TEXT, OPEN_TAG, NO_CONTENT = 11, 13, 17


def damaged_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Web pages as bytes, some of which are cut in a tag, no UTF-8 or missing."""
    html = F.encode("html", "UTF-8")
    content = (
        F.when(F.col("page_id") % NO_CONTENT == 6, F.lit(None).cast("binary"))
        .when(F.col("page_id") % NO_TEXT == 3, F.concat(F.unhex(F.lit("FF")), html))
        .when(F.col("page_id") % OPEN_TAG == 5, F.encode(F.concat("html", F.lit("<p class")), "UTF-8"))
        .otherwise(html)
    )
    return inputs.table(spark, sf_dir, "pages").select("page_id", content.alias("content"))


@query
def extract_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of web pages by the scanner, cut at their headings, and the files that it sets aside."""
    pages, errors = parse.parse_files(damaged_pages(spark, sf_dir), parse.html_pages, "page_id", "content", fresh_path(spark, "parsed"))
    errors = errors.withColumn("error", F.regexp_replace("error", r" at character \d+$", ""))
    return enrich.combine_modalities(pages, errors)


CHECKS = {"no text": "trim(text) <> ''", "too short": "n_chars >= 40", "no junk": "source <> 'src3'"}


def _checked(spark: SparkSession, sf_dir: str) -> checked.Checked:
    docs = inputs.table(spark, sf_dir, "documents").select("doc_id", "text", "source", "n_chars", F.md5("text").alias("text_md5"))
    rules = {name: F.expr(rule) for name, rule in CHECKS.items()}
    return checked.write_checked(docs, fresh_path(spark, "checked"), rules, ["text_md5"], ["doc_id"])


@query
def write_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both tables that a write under rules leaves: documents, and those that break a rule or repeat a text."""
    found = _checked(spark, sf_dir)
    bad = found.bad.select("doc_id", F.array_join(checked.PROBLEMS, ", ").alias("problems"))
    return found.good.select("doc_id", F.lit("").alias("problems")).unionByName(bad)


@query
def write_checked_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the same write counted, from its metrics."""
    return spark.createDataFrame(sorted(_checked(spark, sf_dir).counts.items()), "rule string, n bigint")


@query
def stream_evolving(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as JSON lines of two folders with other columns, drained one after the other."""
    run = fresh_path(spark, "evolving")
    events = inputs.table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", F.round("value", 2).alias("value"))
    early = events.filter("event_id % 2 = 0").select(F.to_json(F.struct("event_id", "user_id")).alias("value"))
    reading = F.when(F.col("event_id") % 5 == 0, F.lit("none")).otherwise(F.col("value").cast("string"))
    late_id = F.when(F.col("event_id") % 7 == 0, F.concat(F.lit("u"), F.col("user_id"))).otherwise(F.col("user_id").cast("string"))
    late = events.filter("event_id % 2 = 1").select("event_id", late_id.alias("user_id"), "event_type", reading.alias("reading"))
    line = F.when(F.col("event_id") % 11 == 0, F.concat(F.lit("broken "), F.col("event_id"))).otherwise(F.to_json(F.struct("*")))
    for number, part in enumerate((early, late.select(line.alias("value")))):
        part.write.text(f"{run}/arrived/{number}")
        evolving.ingest_lines(spark, f"{run}/arrived", f"{run}/table", "part-*")
    return evolving.read_lines(spark, f"{run}/table")


def _versions() -> str:
    batches = []
    for number in range(1, N_BATCHES + 1):
        steps = [(c, ct, t) for n, c, ct, t in STEPS if n == number]
        change = " ".join(f"WHEN {c} THEN '{ct}'" for c, ct, _ in steps)
        text = " ".join(f"WHEN {c} THEN {t}" for c, _, t in steps)
        batches.append(f"SELECT {oracle.FILE} AS path, CASE {text} END AS t, {number}::bigint AS version, CASE {change} END AS ct FROM documents")
    return f"SELECT * FROM ({' UNION ALL '.join(batches)}) WHERE ct IS NOT NULL"


def _checks() -> str:
    broken = ", ".join(f"CASE WHEN NOT ({rule}) THEN '{name}' END" for name, rule in CHECKS.items())
    return f"""
        SELECT doc_id, CASE WHEN p <> '' THEN p WHEN row_number() OVER (PARTITION BY text, p = '' ORDER BY doc_id) > 1 THEN '{checked.REPEATED}'
          ELSE '' END AS problems
        FROM (SELECT doc_id, text, concat_ws(', ', {broken}) AS p FROM documents)"""


def statements() -> dict[str, str]:
    newest = f"SELECT * FROM ({_versions()}) QUALIFY row_number() OVER (PARTITION BY path ORDER BY version DESC) = 1"
    current = f"SELECT path, t, version FROM ({newest}) WHERE ct <> 'delete'"
    chunks = f"SELECT * FROM {oracle.recursive(current, 'path', 't', *medallion.INCREMENTAL_CHUNKS)}"
    named = f"SELECT md5(path || '#' || chunk_ix) AS chunk_id, content_chunk FROM ({chunks})"
    every = oracle.statements()
    return {
        "refresh_current": f"SELECT path, t AS extracted_text, version FROM ({current})",
        "refresh_gold": f"""
            SELECT path, chunk_ix, content_chunk AS chunked_text, topic, topic AS parsed_topic_str
            FROM ({chunks}) JOIN ({oracle.topic(current, "path", "t")}) USING (path)""",
        "refresh_index": f"""
            SELECT chunk_id, md5(content_chunk) AS text_hash, coalesce(embedding_e6, '') AS embedding_e6 FROM ({named})
            LEFT JOIN ({oracle.printed(named, "chunk_id", "content_chunk")}) USING (chunk_id)""",
        "refresh_history": f"""
            SELECT path, md5(t) AS extracted_text, version, version AS "__START_AT", next AS "__END_AT" FROM (
              SELECT *, lead(version) OVER (PARTITION BY path ORDER BY version) AS next FROM ({_versions()})) WHERE ct <> 'delete'""",
        "cdc_scd2_stream": every["cdc_scd2"],
        "cdc_scd1_buckets": every["cdc_scd1"],
        "infer_once": f"""
            WITH t AS (SELECT doc_id, topic FROM ({oracle.topic("SELECT doc_id, text FROM documents", "doc_id", "text")}))
            SELECT doc_id, topic AS answer, CASE WHEN count(*) FILTER (doc_id % 2 = 0) OVER (PARTITION BY text) > 0 THEN 1 ELSE 2 END::bigint AS run
            FROM documents JOIN t USING (doc_id)""",
        "extract_pages": f"""
            WITH p AS (
              SELECT page_id, html, octet_length(encode(html)) AS n, CASE WHEN page_id % {NO_CONTENT} = 6 THEN 'no content'
                WHEN page_id % {NO_TEXT} = 3 THEN 'ValueError: no UTF-8 at byte 0'
                WHEN page_id % {OPEN_TAG} = 5 THEN 'ValueError: a tag is not closed' END AS error FROM pages
            ), c AS (
              SELECT page_id, ix, {oracle.visible("CASE WHEN ix = 1 THEN part ELSE '<h1' || part END")} AS page_content
              FROM (SELECT page_id, unnest(l) AS part, unnest(range(1, len(l) + 1)) AS ix
                    FROM (SELECT page_id, string_split(html, '<h1') AS l FROM p WHERE error IS NULL))
            )
            SELECT page_id, (row_number() OVER (PARTITION BY page_id ORDER BY ix) - 1)::int AS page_nr, page_content,
              NULL::bigint AS length, NULL AS error FROM c WHERE page_content <> ''
            UNION ALL
            SELECT page_id, NULL, NULL, CASE WHEN error LIKE '%UTF%' THEN n + 1 WHEN error LIKE '%tag%' THEN n + 8 END, error
            FROM p WHERE error IS NOT NULL""",
        "write_checked": f"SELECT doc_id, problems FROM ({_checks()})",
        "write_checked_counts": f"""
            WITH c AS (SELECT * FROM ({_checks()}))
            SELECT 'rows' AS rule, count(*) AS n FROM c UNION ALL SELECT 'good', count(*) FROM c WHERE problems = ''
            {" ".join(f"UNION ALL SELECT '{n}', count(*) FROM c WHERE contains(problems, '{n}')" for n in (*CHECKS, checked.REPEATED))}""",
        "stream_evolving": """
            SELECT event_id, user_id, NULL AS event_type, NULL AS reading, NULL AS _rescued FROM events WHERE event_id % 2 = 0
            UNION ALL
            SELECT event_id, CASE WHEN event_id % 7 <> 0 THEN user_id END, event_type,
              CASE WHEN event_id % 5 = 0 THEN 'none' ELSE round(value, 2)::varchar END,
              CASE WHEN event_id % 7 = 0 THEN '{"user_id":"u' || user_id || '"}' END
            FROM events WHERE event_id % 2 = 1 AND event_id % 11 <> 0
            UNION ALL
            SELECT NULL, NULL, NULL, NULL, '{"_line":"broken ' || event_id || '"}' FROM events WHERE event_id % 2 = 1 AND event_id % 11 = 0""",
        "cdc_scd1_patch": f"""
            WITH c AS (
              SELECT event_id, ts, user_id, event_type, ct, CASE WHEN event_id % 3 <> 0 THEN value END AS v,
                CASE WHEN event_id % 4 <> 1 THEN props END AS p,
                row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS r
              FROM ({oracle.CHANGES}) WHERE ct <> 'update_preimage'
            ), d AS (SELECT user_id, coalesce(max(r) FILTER (ct = 'delete'), 0) AS gone FROM c GROUP BY 1)
            SELECT user_id, arg_max(event_id, r) AS event_id, arg_max(ts, r) AS ts, arg_max(event_type, r) AS event_type,
              arg_max(v, r) FILTER (v IS NOT NULL) AS value, arg_max(p, r) FILTER (p IS NOT NULL) AS props
            FROM c JOIN d USING (user_id) WHERE r > gone GROUP BY user_id""",
    }
