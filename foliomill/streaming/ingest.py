"""Incremental ingest: drain a stream once and land each batch exactly once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StringType, StructField, StructType


def drain_to_table(stream: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Append everything available to the table at ``path``, wait for it, and return the table."""
    query = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
    )
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(path)


def run_flow(
    stream: DataFrame,
    target: str,
    flow: str,
    checkpoint: str,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
) -> None:
    """Named flow into a shared target. Several flows may feed one target, each with its own checkpoint.

    A batch owns the folder of its number, so a batch that runs again after a failure replaces itself.
    """

    def land(batch: DataFrame, batch_id: int) -> None:
        rows = prepare(batch) if prepare else batch
        rows.write.mode("overwrite").parquet(f"{target}/flow={flow}/batch_id={batch_id}")

    query = (
        stream.writeStream.foreachBatch(land)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def flow_rows(stream: DataFrame, target: str) -> DataFrame:
    """Everything landed by the flows of a target, with ``flow`` and ``batch_id``."""
    schema = StructType([*stream.schema.fields, StructField("flow", StringType()), StructField("batch_id", LongType())])
    return stream.sparkSession.read.schema(schema).parquet(target)
