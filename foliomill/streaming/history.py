"""History of every key kept from a stream of changes.

Changes are stored as they come, once each and in place; all else works on their keys, order and place. The newest change
of each key, whose interval is open, is the state: a bucketed table of one row per key. A batch reads the buckets it
touches, closes and opens intervals, and appends the versions that are new or whose end moved to a log. A late change, one
that is older than the open one of its key, splits an interval that is closed already: for keys with late changes, and for
no others, the logged versions are read again, from the buckets of these keys alone. Reading the history brings each
version and its change together, which is the only time that whole changes are shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from foliomill.operators.keyed import CHANGE_COLUMNS, drop_preimages, is_delete, newest_per_key, next_in_key, with_keys
from foliomill.session import fresh_path
from foliomill.sources.buckets import BUCKET, BucketTable, read_if_there
from foliomill.sources.tables import overwrite_table

END = "__END_AT"
PLACE = ("_from", "_row")  # batch that brought a change, and its row there


def _version_schema(schema: StructType, keys: Sequence[str], order: Sequence[str]) -> StructType:
    return StructType([*[schema[c] for c in (*keys, *order)], *[StructField(c, LongType()) for c in PLACE]])


def _log_schema(schema: StructType, keys: Sequence[str], order: Sequence[str]) -> StructType:
    end = StructField(END, schema[order[0]].dataType)
    return StructType([*_version_schema(schema, keys, order).fields, end, StructField("batch_id", LongType()), StructField(BUCKET, LongType())])


def _resolved(log: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Every version once, as the newest batch left it."""
    values = [c for c in log.columns if c not in ("batch_id", BUCKET)]
    newest = log.groupBy(*keys, *order).agg(F.max_by(F.struct(*values), "batch_id").alias("_v"))
    return newest.select("_v.*")


def apply_batch(
    batch: DataFrame, batch_id: int, target: str, keys: Sequence[str], order: Sequence[str], n_buckets: int, slices: int | None = None
) -> None:
    """Fold one batch of changes into the history at ``target``. A batch that runs again gives the same state. Changes
    without a key are left out."""
    spark = batch.sparkSession
    keys, order = list(keys), list(order)
    shape = _version_schema(batch.schema, keys, order)
    stored = with_keys(drop_preimages(batch), keys).withColumn("_row", F.monotonically_increasing_id())
    stored = overwrite_table(stored, f"{target}/changes/batch_id={batch_id}")
    # of changes with one key and order the last one counts
    new = stored.groupBy(*keys, *order).agg(F.max("_row").alias("_row")).withColumn("_from", F.lit(batch_id).cast("bigint"))
    new = overwrite_table(new.select(*shape.names), fresh_path(spark, "history-batch"))
    open_rows = BucketTable(f"{target}/open", tuple(keys), shape, n_buckets)
    buckets = open_rows.touched(new)
    before = open_rows.read(spark, buckets, before=batch_id)

    at = F.struct(*order)
    firsts = new.groupBy(*keys).agg(F.min(at).alias("_first"))
    met = overwrite_table(before.join(firsts, keys), fresh_path(spark, "history-open"))
    is_late = F.col("_first") <= at
    late = met.filter(is_late).select(*keys)
    late_buckets = open_rows.touched(late)
    log_schema = _log_schema(batch.schema, keys, order)
    log = read_if_there(spark, log_schema, f"{target}/log").filter(F.col("batch_id") < batch_id)
    reread = _resolved(log.filter(F.col(BUCKET).isin(late_buckets)).join(late, keys, "left_semi"), keys, order)
    opened = met.filter(~is_late).drop("_first").withColumn(END, F.lit(None).cast(log_schema[END].dataType))
    known = reread.unionByName(opened).withColumn("_new", F.lit(0)).withColumnRenamed(END, "_end")

    # a change that is delivered again takes the place of its version
    both = known.unionByName(new.withColumn("_new", F.lit(1)), allowMissingColumns=True)
    both = both.groupBy(*keys, *order).agg(F.max_by(F.struct(*new.columns, "_end"), "_new").alias("_v"), F.max("_new").alias("_new"))
    versions = next_in_key(both.select("_v.*", "_new"), keys, order, END, slices)
    moved = versions.filter((F.col("_new") == 1) | ~F.col(END).eqNullSafe(F.col("_end")))
    moved = moved.select(*new.columns, END).withColumn(BUCKET, open_rows.bucket().cast("bigint"))
    moved.write.mode("overwrite").partitionBy(BUCKET).parquet(f"{target}/log/batch_id={batch_id}")
    open_rows.replace(newest_per_key(before.unionByName(new), keys, order), buckets, batch_id)


def ingest_history(
    stream: DataFrame, target: str, checkpoint: str, keys: Sequence[str], order: Sequence[str], n_buckets: int = 64
) -> None:
    """Drain a stream of changes into the history at ``target``."""
    query = (
        stream.writeStream.foreachBatch(lambda batch, batch_id: apply_batch(batch, batch_id, target, keys, order, n_buckets))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def read_history(changes: DataFrame, target: str, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Every version of every key with its validity; deletions close an interval and add no row. ``changes`` (the stream or
    a table of the same shape) gives the columns and is not read."""
    spark, schema = changes.sparkSession, changes.schema
    log = read_if_there(spark, _log_schema(schema, list(keys), list(order)), f"{target}/log")
    versions = _resolved(log, list(keys), list(order)).select(*PLACE, END)
    stored = StructType([*schema.fields, StructField("_row", LongType()), StructField("batch_id", LongType())])
    stored = read_if_there(spark, stored, f"{target}/changes").withColumnRenamed("batch_id", "_from")
    kept = stored.filter(~F.coalesce(is_delete(), F.lit(False))).join(versions, list(PLACE))
    return kept.select(*schema.names, END).withColumn("__START_AT", F.col(order[0])).drop(*CHANGE_COLUMNS)
