"""How the shared tables stand in for files, change feeds, traces, evaluation records and conversations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foliomill.functions.text import fixed_chunks, html_text, token_set
from foliomill.operators.chat import answered_turns

AS_OF = "2024-02-01 00:00:00"
CHANGE_ORDER = ["ts", "event_id"]
N_USERS = 10
KEYWORD = "that"
JUNK_RUN = r"[*#%$&]{3}"
SYSTEM_INTRO = "You answer questions for one user. Known about the user: "
PROMPT = "Name the main topic of the document below. Reply with one JSON object that has the key topic.\n\n"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def as_of() -> Column:
    return F.lit(AS_OF).cast("timestamp_ntz")


def document_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as text files of a folder per source."""
    docs = table(spark, sf_dir, "documents")
    path = F.concat(F.lit("/"), F.col("source"), F.lit("/Doc "), F.col("doc_id").cast("string"), F.lit(".txt"))
    return docs.select(path.alias("input_file"), F.encode("text", "UTF-8").alias("content"))


def page_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Web pages as files: url as path, bytes, length."""
    content = F.encode("html", "UTF-8")
    return table(spark, sf_dir, "pages").select(
        F.col("url").alias("path"), F.octet_length(content).cast("bigint").alias("length"), content.alias("content")
    )


def event_changes(events: DataFrame) -> DataFrame:
    """Events as a change feed per user, ordered by time, then event."""
    kind = (
        F.when(F.col("event_type") == "error", "delete")
        .when(F.col("event_type") == "signup", "insert")
        .when(F.col("event_type") == "view", "update_preimage")
        .otherwise("update_postimage")
    )
    return events.withColumn("_change_type", kind)


def _moderated(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return docs.join(table(spark, sf_dir, "labels"), "doc_id", "left")


def snapshot_before(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Corpus before moderation: documents not marked as poor."""
    kept = _moderated(spark, sf_dir).filter(F.coalesce("quality", F.lit(1)) == 1)
    return kept.select("doc_id", "text", "lang")


def snapshot_after(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Corpus after moderation: documents not marked as toxic, runs of junk characters removed."""
    kept = _moderated(spark, sf_dir).filter(F.coalesce("toxic", F.lit(0)) == 0)
    return kept.select("doc_id", F.regexp_replace("text", JUNK_RUN, "").alias("text"), "lang")


def traces(events: DataFrame) -> DataFrame:
    return events.select("event_id", "ts", F.when(F.col("event_type") == "error", "ERROR").otherwise("OK").alias("status"))


def newest_time(events: DataFrame) -> Column:
    """The time of the newest event as a literal, so that filters on it are pushed into the scan."""
    return F.lit(str(events.agg(F.max("ts")).first()[0])).cast("timestamp_ntz")


def answered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return answered_turns(table(spark, sf_dir, "conversations"), "conv_id", "turn", "role", "text")


def answered_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answered turns with their token sets: ``conv_id, turn, question, answer, q, a``."""
    return answered(spark, sf_dir).withColumns({"q": token_set(F.col("question")), "a": token_set(F.col("answer"))})


def expected_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected response of a conversation: the document with its number, if it is labelled as good; token sets are only
    made for documents that a conversation asks for."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    good = table(spark, sf_dir, "labels").filter("quality = 1").select("doc_id")
    docs = docs.join(good.join(_asked(spark, sf_dir, "doc_id"), "doc_id", "left_semi"), "doc_id", "left_semi")
    return docs.select(F.col("doc_id").alias("conv_id"), token_set(F.col("text")).alias("e"))


def _asked(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").filter("role = 'user'").select(F.col("conv_id").alias(name)).distinct()


def context_sets(spark: SparkSession, sf_dir: str, size: int, overlap: int) -> DataFrame:
    """Retrieved context of a conversation: the web page with its number, as one token set and per chunk."""
    pages = table(spark, sf_dir, "pages").select("page_id", "html")
    pages = pages.join(_asked(spark, sf_dir, "page_id"), "page_id", "left_semi")
    pages = pages.select(F.col("page_id").alias("conv_id"), html_text(F.col("html")).alias("t"))
    return pages.select(
        "conv_id",
        token_set(F.col("t")).alias("c"),
        F.transform(fixed_chunks(F.col("t"), size, overlap), token_set).alias("cs"),
    )
