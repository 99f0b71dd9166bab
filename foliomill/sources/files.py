"""File sources: batch and streaming scans of binary files, and detection of rewritten files."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from foliomill.sources.buckets import read_if_there

ANY_AGE = "36500d"  # by default a stream passes over files a week older than the newest
BINARY_FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def with_audit_time(df: DataFrame, column: str, as_of: Column | None = None) -> DataFrame:
    """Stamp rows with the processing time, or with ``as_of`` where a run has to be repeatable."""
    return df.withColumn(column, F.current_timestamp() if as_of is None else as_of)


def scan_binary(spark: SparkSession, folder: str, glob: str = "*", as_of: Column | None = None) -> DataFrame:
    """Files below ``folder`` whose names match ``glob``. Bytes are read only if ``content`` is selected."""
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(folder)
    )
    return with_audit_time(files.withColumnRenamed("path", "input_file"), "_datetime", as_of)


def stream_binary(spark: SparkSession, folder: str, glob: str = "*", files_per_batch: int | None = None) -> DataFrame:
    """Stream of new files; each file is delivered once per checkpoint, however old it is when it arrives."""
    reader = (
        spark.readStream.format("binaryFile")
        .schema(BINARY_FILE_SCHEMA)
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", glob)
        .option("maxFileAge", ANY_AGE)
    )
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return with_audit_time(reader.load(folder), "processing_time")


def stored_schema(spark: SparkSession, location: str, sample: str, format_name: str = "parquet") -> StructType:
    """Schema of a file stream, inferred once from ``sample`` and kept at ``location`` for all later runs."""
    kept = read_if_there(spark, "schema string", location).first()
    if kept is not None:
        return StructType.fromJson(json.loads(kept["schema"]))
    schema = spark.read.format(format_name).load(sample).schema
    spark.createDataFrame([(schema.json(),)], "schema string").coalesce(1).write.parquet(location)
    return schema


def changed_files(listing: DataFrame, known: DataFrame, path: str = "path", modified: str = "modificationTime") -> DataFrame:
    """Files of a listing not yet ingested in this version. A file stream skips known paths, so rewritten files
    come in through this batch."""
    return listing.join(known.select(path, modified), [path, modified], "left_anti")


def suffix_filter(df: DataFrame, path: str, suffix: str) -> DataFrame:
    return df.filter(F.col(path).endswith(suffix))
