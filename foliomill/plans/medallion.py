"""Document preparation end to end: bytes, pages, chunks, index."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliomill.functions.splitter import recursive_chunks
from foliomill.functions.text import document_name, html_text
from foliomill.operators.enrich import chunk_id, explode_chunks, explode_pages, parse_topic, text_pages, topic_json
from foliomill.sources.files import suffix_filter, with_audit_time
from foliomill.sources.tables import overwrite_table

# Chunk size and overlap of the batch and the incremental tables.
BATCH_CHUNKS = (475, 50)
INCREMENTAL_CHUNKS = (100, 20)

GOLD_SCHEMA = (
    "chunk_id string, input_file string, page_nr string, document_name string, content_chunk string, "
    "_datetime timestamp_ntz, page_content string"
)

Splitter = Callable[[Column], Column]


@dataclass(frozen=True)
class Layers:
    """Folders of the stored layers."""

    bronze: str
    silver: str
    gold: str


def batch_splitter(text: Column) -> Column:
    return recursive_chunks(text, *BATCH_CHUNKS)


def incremental_splitter(text: Column) -> Column:
    return recursive_chunks(text, *INCREMENTAL_CHUNKS)


def silver_pages(bronze: DataFrame, suffix: str, as_of: Column | None = None) -> DataFrame:
    """Bronze files to named pages; the bytes go no further than the page map."""
    pages = explode_pages(bronze, text_pages(F.col("content")), ["input_file"])
    return with_audit_time(pages.withColumn("document_name", document_name(F.col("input_file"), suffix)), "_datetime", as_of)


def gold_chunks(silver: DataFrame, splitter: Splitter = batch_splitter, as_of: Column | None = None) -> DataFrame:
    """Silver pages to chunks with a key that depends on file, page and position only."""
    pages = silver.select("input_file", "page_nr", "page_content", "document_name")
    chunks = explode_chunks(pages, splitter(F.col("page_content")))
    keyed = chunks.withColumn("chunk_id", chunk_id("input_file", "page_nr", "chunk_ix"))
    return with_audit_time(keyed, "_datetime", as_of).drop("chunk_ix")


def extracted_texts(files: DataFrame, suffix: str) -> DataFrame:
    """Visible text in place of the bytes, for files with the suffix; later shuffles then move text only.

    Bytes that aren't UTF-8 give an empty text and ``readable`` false; they stop nothing.
    """
    content = F.col("content").cast("string")
    readable = F.coalesce(F.is_valid_utf8(content), F.lit(False))
    text = F.when(readable, html_text(content)).otherwise("")
    return suffix_filter(files, "path", suffix).withColumns({"extracted_text": text, "readable": readable}).drop("content")


def topics_and_chunks(texts: DataFrame, splitter: Splitter = incremental_splitter) -> DataFrame:
    """Texts to topic and chunks; the topic is worked out per document, before the chunks are exploded.

    The grain is ``(path, chunk_ix)``: a file has many chunks, so its path alone cannot be the key of an index.
    """
    with_topic = parse_topic(texts.withColumn("topic", topic_json(F.col("extracted_text"))))
    return explode_chunks(with_topic, splitter(F.col("extracted_text"))).withColumnRenamed("content_chunk", "chunked_text")


def build_layers(files: DataFrame, layers: Layers, suffix: str, splitter: Splitter = batch_splitter) -> DataFrame:
    """Bronze, silver and gold, each stored before the next one reads it."""
    bronze = overwrite_table(files, layers.bronze)
    silver = overwrite_table(silver_pages(bronze, suffix), layers.silver)
    return overwrite_table(gold_chunks(silver, splitter), layers.gold)
