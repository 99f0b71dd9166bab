"""Incremental document preparation: new and rewritten files to current texts, history, chunks and index."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliomill.operators.enrich import chunk_id
from foliomill.operators.keyed import current_rows, history_rows
from foliomill.operators.retrieval import apply_sync
from foliomill.plans.medallion import Splitter, extracted_texts, incremental_splitter, topics_and_chunks
from foliomill.session import fresh_path
from foliomill.sources.files import changed_files, scan_binary, stream_binary, with_audit_time
from foliomill.sources.tables import overwrite_table
from foliomill.streaming.ingest import flow_rows, run_flow

KEYS = ["path"]
ORDER = ["modificationTime", "processing_time"]
INDEX_SCHEMA = "chunk_id string, text_hash string, embedding array<double>"


@dataclass(frozen=True)
class Refresh:
    """Tables after one run; ``index_path`` goes into the next run."""

    current: DataFrame
    history: DataFrame
    gold: DataFrame
    index: DataFrame
    index_path: str


def ingest_files(spark: SparkSession, folder: str, glob: str, bronze: str, checkpoint: str, run_id: int) -> DataFrame:
    """Land new files by stream and rewritten ones, which a file stream passes over, by batch.

    A file counts as rewritten only if its path has been landed before: one that arrives between stream and listing is
    left to the stream of the next run.
    """
    stream = stream_binary(spark, folder, glob)
    run_flow(stream, bronze, "new", checkpoint)
    listing = scan_binary(spark, folder, glob).withColumnRenamed("input_file", "path").drop("_datetime")
    this_run = (F.col("flow") == "rewritten") & (F.col("batch_id") == run_id)
    known = flow_rows(stream, bronze).filter(~this_run)  # a repeated run replaces its own batch and must not read it
    seen = listing.join(known.select("path").distinct(), "path", "left_semi")
    rewritten = with_audit_time(changed_files(seen, known), "processing_time")
    rewritten.write.mode("overwrite").parquet(f"{bronze}/flow=rewritten/batch_id={run_id}")
    return flow_rows(stream, bronze).drop("flow", "batch_id")


def refresh(
    spark: SparkSession,
    folder: str,
    root: str,
    run_id: int,
    glob: str = "*",
    suffix: str = ".html",
    previous_index: str | None = None,
    splitter: Splitter = incremental_splitter,
) -> Refresh:
    """One run over ``folder``: stored gold and index are written to new paths, the last ones stay readable."""
    bronze = ingest_files(spark, folder, glob, f"{root}/bronze", f"{root}/checkpoint", run_id)
    changes = extracted_texts(bronze, suffix).withColumn("_change_type", F.lit("insert"))
    current = current_rows(changes, KEYS, ORDER)
    gold = overwrite_table(topics_and_chunks(current, splitter), fresh_path(spark, "gold"))
    source = gold.select(chunk_id("path", "chunk_ix").alias("chunk_id"), "chunked_text")
    old = spark.read.schema(INDEX_SCHEMA).parquet(previous_index) if previous_index else spark.createDataFrame([], INDEX_SCHEMA)
    index_path = fresh_path(spark, "index")
    index = overwrite_table(apply_sync(old, source, "chunk_id", "chunked_text"), index_path, INDEX_SCHEMA)
    return Refresh(current, history_rows(changes, KEYS, ORDER), gold, index, index_path)
