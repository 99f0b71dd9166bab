"""Current table kept from a stream of changes.

Each batch is reduced to the newest change per key and lands in a folder of its own; nothing is rewritten in
place, so a lost executor or a repeated batch cannot damage rows already landed. Readers take the newest change
per key over the folded base and the batches after it. Deletions stay as rows until they are read or folded,
because an older change may still arrive late.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliomill.operators.keyed import current_rows, latest_changes, newest_per_key
from foliomill.streaming.ingest import flow_rows, run_flow

FLOW = "changes"


def ingest_changes(stream: DataFrame, target: str, checkpoint: str, keys: Sequence[str], order: Sequence[str]) -> None:
    run_flow(stream, target, FLOW, checkpoint, lambda batch: latest_changes(batch, keys, order))


def landed_changes(stream: DataFrame, target: str, base: str | None = None) -> DataFrame:
    """Changes to resolve: the folded base, if any, and the batches it does not contain yet."""
    landed = flow_rows(stream, target).drop("flow")
    if base is None:
        return landed
    folded = stream.sparkSession.read.schema(landed.schema).parquet(base)
    upto = folded.agg(F.max("batch_id")).first()[0]
    return folded.unionByName(landed.filter(F.col("batch_id") > (-1 if upto is None else upto)))


def fold_changes(stream: DataFrame, target: str, new_base: str, keys: Sequence[str], order: Sequence[str], base: str | None = None) -> None:
    """Write the newest change per key, deletions included, to ``new_base``; run it when batches pile up."""
    changes = landed_changes(stream, target, base)
    upto = changes.agg(F.max("batch_id")).first()[0]
    newest_per_key(changes, keys, order).withColumn("batch_id", F.lit(upto).cast("bigint")).write.parquet(new_base)


def read_current(stream: DataFrame, target: str, keys: Sequence[str], order: Sequence[str], base: str | None = None) -> DataFrame:
    return current_rows(landed_changes(stream, target, base).drop("batch_id"), keys, order)
