"""Registered queries of the training-data operators: thin calls over whole tables, and their DuckDB statements."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foliomill.llm import ngram_lm
from foliomill.llm.bpe import encoded_digests
from foliomill.llm.decontaminate import contamination
from foliomill.llm.exact_dup import exact_duplicates
from foliomill.llm.near_dup import near_duplicates
from foliomill.llm.quality import learn, quality_scores
from foliomill.llm.recompress import remove_repeated_words
from foliomill.llm.repeats import remove_repeats
from foliomill.llm.spelling import spelling_variants
from foliomill.llm.token_count import token_counts
from foliomill.llm.url_lists import active_entries, url_host, url_key
from foliomill.llm.warc import archive_round_trip
from foliomill.llm.whitening import whitened

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(fn: Query) -> Query:
    REGISTRY[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer(name: str) -> str:
    """Path of a public vocabulary file; the same on every worker."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op1_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return ngram_lm.score_texts(docs, ngram_lm.learn(docs))


@query
def op2_bpe_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded_digests(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"))


@query
def op3_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


@query
def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        "contaminated",
    )


LETTERS = "abcdefghijklmnopqrstuvwxyz"
SQL["op4_decontaminate"] = rf"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{LETTERS.upper()}', '{LETTERS}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{LETTERS.upper()}', '{LETTERS}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), bw AS (
  SELECT DISTINCT item_id, len(v) AS n, array_to_string(v, ' ') AS g FROM (
    SELECT item_id, w[s : s + 9] AS v
    FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s FROM b WHERE len(w) > 0)
  )
), lengths AS (SELECT DISTINCT n FROM bw), dw AS (
  SELECT doc_id, s, n, array_to_string(w[s : s + n - 1], ' ') AS g
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d CROSS JOIN lengths WHERE len(w) >= n)
), hits AS (
  SELECT doc_id, s, dw.n, item_id FROM dw JOIN bw USING (g) WHERE dw.n = bw.n
), words AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM hits) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids
  FROM (SELECT DISTINCT doc_id, cast(item_id AS varchar) AS i FROM hits) GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""


@query
def op5_warc_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_round_trip(spark, table(spark, sf_dir, "pages"))


SQL["op5_warc_archives"] = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS body, octet_length(encode(coalesce(html, ''))) AS n FROM pages
), o AS (
  SELECT *, CASE WHEN n >= 1000 THEN max(page_id) OVER (PARTITION BY body) ELSE page_id END AS own FROM p
)
SELECT page_id, n AS payload_bytes, sha1(body) AS payload_digest,
       CASE WHEN own = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN own <> page_id THEN own END AS refers_to
FROM o
"""


@query
def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents"))


SQL["op6_exact_dedup"] = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""


@query
def op7_quality_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality_scores(docs, learn(docs, table(spark, sf_dir, "labels")))


@query
def op8_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), tokenizer("piece_bpe_32k.model"))


DAY = 86400
START = 1704067200  # 2024-01-01


def _digits(text: Column, at: int) -> Column:
    """Number in six hexadecimal digits of a text's md5."""
    return F.conv(F.substring(F.md5(text), at, 6), 16, 10).cast("bigint")


def page_captures(pages: DataFrame) -> DataFrame:
    """Pages as captures of one year: the fetch time follows from the page's number."""
    return pages.select("page_id", "url", (F.lit(START) + F.pmod(F.col("page_id") * 7919, F.lit(365 * DAY))).alias("fetched_at"))


def list_entries(pages: DataFrame) -> DataFrame:
    """Dated entries derived from the pages: hosts and parent domains that come and go on three lists, and single URLs."""
    hosts = pages.select(url_host(F.col("url")).alias("host")).distinct().filter("host <> ''")
    a, b = _digits(F.col("host"), 1), _digits(F.col("host"), 7)
    hosts = hosts.select("host", a.alias("a"), b.alias("b"))
    added = F.lit(START) + F.col("a") % 300 * DAY
    removed = added + (F.col("b") % 60 + 10) * DAY
    event = lambda at, action, when: F.when(when, F.struct(at.alias("at"), F.lit(action).alias("action")))
    always = F.lit(True)
    events = F.array_compact(
        F.array(
            event(added, "add", always),
            event(removed, "remove", F.col("b") % 3 != 0),
            event(removed + 20 * DAY, "add", F.col("a") % 5 == 0),
        )
    )
    parent = F.regexp_replace("host", r"^[^.]*\.", "")
    names = {
        "malware": (F.col("a") % 3 == 0, F.col("host")),
        "adult": (F.col("b") % 4 == 0, F.col("host")),
        "spam": (F.col("a") % 7 == 0, parent),
    }
    lists = F.array_compact(
        F.array(*[F.when(cond, F.struct(F.lit(name).alias("list"), key.alias("key"))) for name, (cond, key) in names.items()])
    )
    by_host = hosts.withColumn("l", F.explode(lists)).withColumn("e", F.explode(events)).select("l.list", "l.key", "e.at", "e.action")
    urls = pages.filter(F.col("page_id") % 50 == 0).select(
        F.lit("takedown").alias("list"),
        url_key(F.col("url")).alias("key"),
        (F.lit(START) + F.col("page_id") % 200 * DAY).alias("at"),
        F.lit("add").alias("action"),
    )
    return by_host.unionByName(urls)


@query
def op10_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    found = active_entries(page_captures(pages), list_entries(pages), "page_id", "url", "fetched_at")
    return found.withColumn("lists", F.array_join("lists", ","))


SQL["op10_url_filters"] = r"""
WITH p AS (
  SELECT page_id, url, 1704067200 + page_id * 7919 % 31536000 AS t,
         lower(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]*)', 1)) AS host,
         regexp_replace(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)', 1), '/+$', '') AS path
  FROM pages
), h AS (
  SELECT host, regexp_replace(host, '^[^.]*\.', '') AS parent,
         cast('0x' || substr(md5(host), 1, 6) AS bigint) AS a, cast('0x' || substr(md5(host), 7, 6) AS bigint) AS b
  FROM (SELECT DISTINCT host FROM p WHERE host <> '')
), l AS (
  SELECT 'malware' AS list, host AS key, a, b FROM h WHERE a % 3 = 0
  UNION ALL SELECT 'adult', host, a, b FROM h WHERE b % 4 = 0
  UNION ALL SELECT 'spam', parent, a, b FROM h WHERE a % 7 = 0
), e AS (
  SELECT list, key, 1704067200 + a % 300 * 86400 AS happened, 'add' AS action FROM l
  UNION SELECT list, key, 1704067200 + (a % 300 + b % 60 + 10) * 86400, 'remove' FROM l WHERE b % 3 <> 0
  UNION SELECT list, key, 1704067200 + (a % 300 + b % 60 + 30) * 86400, 'add' FROM l WHERE a % 5 = 0
  UNION SELECT 'takedown', host || path || '/', 1704067200 + page_id % 200 * 86400, 'add' FROM p WHERE page_id % 50 = 0
), k AS (
  SELECT page_id, t, host || path || '/' AS key FROM p WHERE host <> ''
  UNION ALL
  SELECT page_id, t, array_to_string(list_slice(s, i, len(s)), '.')
  FROM (SELECT page_id, t, s, unnest(range(1, len(s) + 1)) AS i FROM (SELECT page_id, t, string_split(host, '.') AS s FROM p WHERE host <> ''))
), latest AS (
  SELECT page_id, list, k.key, action FROM k JOIN e ON k.key = e.key AND e.happened <= k.t
  QUALIFY row_number() OVER (PARTITION BY page_id, list, k.key ORDER BY happened DESC, action DESC) = 1
), m AS (
  SELECT page_id, count(*) AS n, string_agg(DISTINCT list, ',' ORDER BY list) AS lists FROM latest WHERE action = 'add' GROUP BY page_id
)
SELECT page_id, t AS fetched_at, host, coalesce(n, 0) AS n_entries, coalesce(lists, '') AS lists, n IS NOT NULL AS blocked
FROM p LEFT JOIN m USING (page_id)
"""


@query
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"))


@query
def op12_whitened_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitened(table(spark, sf_dir, "embeddings"))


@query
def op13_repeated_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeated_words(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
