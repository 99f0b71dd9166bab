"""Keeping prepared documents up to date: current texts, their chunks and the index of these, from batch to batch.

All three tables are part tables keyed by document. A batch appends the rows of the documents that it changes and names
these documents; nothing else is moved or written. Only documents whose text changed are cut and embedded again; the chunks
of removed and shortened documents go. Tables of small rows may be kept in buckets that are rewritten (``BucketTable``).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foliomill.functions.text import hashed_embedding
from foliomill.operators.keyed import drop_preimages, is_delete, latest_changes, newest_per_key, with_keys
from foliomill.session import fresh_path
from foliomill.sources.buckets import BucketTable
from foliomill.sources.parts import PartTable
from foliomill.sources.tables import overwrite_table

INSERT, UPDATE, DELETE = "insert", "update", "delete"


def live(rows: DataFrame) -> DataFrame:
    """Rows whose newest change is no deletion."""
    return rows.filter(~F.coalesce(is_delete(), F.lit(False)))


def refresh_current(table: BucketTable | PartTable, changes: DataFrame, order: Sequence[str], version: int) -> list[int]:
    """Bring a table of the newest change per key up to date and return the touched buckets.

    Deletions stay as rows: a change that is older and arrives later must not revive its key. Read it through
    :func:`live`. A repeated version starts from the same state and gives the same one. Changes without a key are left
    out.
    """
    changes = with_keys(drop_preimages(changes), table.keys)
    if isinstance(table, PartTable):
        return _append_current(table, changes, order, version)
    buckets = table.touched(changes)
    before = table.read(changes.sparkSession, buckets, before=version)
    newest = latest_changes(changes, table.keys, order).select(*table.schema.names)
    table.replace(newest_per_key(before.unionByName(newest), table.keys, order), buckets, version)
    return buckets


def _append_current(table: PartTable, changes: DataFrame, order: Sequence[str], version: int) -> list[int]:
    """Which changes count is settled by key and order alone; then each text moves once, to the bucket it stays in."""
    spark, keys, at = changes.sparkSession, list(table.keys), F.struct(*order)
    changes = changes.select(*table.schema.names)
    heads = changes.groupBy(*keys).agg(F.max(at).alias("_at"), F.count(F.lit(1)).alias("_n"), F.sum(table.text_bytes()).alias("_bytes"))
    held = table.read(spark, before=version, only=changes).select(*keys, at.alias("_held"))
    late = F.coalesce(F.col("_held") > F.col("_at"), F.lit(False))
    heads = heads.join(held, keys, "left").withColumn("_late", late).withColumn("_held", F.col("_held").isNotNull())
    heads = overwrite_table(heads.withColumn("_bucket", table.bucket()).drop("_at"), fresh_path(spark, "heads"))
    found = heads.agg(F.sum("_bytes"), F.max("_n"), F.max("_late"), F.collect_set("_bucket")).first()
    n_bytes, most, any_late, buckets = found
    if (most or 0) > 1:  # one row per key and task leaves the map side, however often a key comes
        changes = newest_per_key(changes, keys, order)
    if any_late:
        changes = changes.join(heads.filter("_late").select(*keys), keys, "left_anti").select(*table.schema.names)
    n_files = table.files_for(n_bytes)
    table.append(changes.repartition(n_files, *keys), heads.filter("_held AND NOT _late"), version, n_files)
    return sorted(buckets)


def document_delta(table: PartTable, spark: SparkSession, buckets: Sequence[int], version: int, text: str) -> DataFrame:
    """``keys, action`` of the documents that a version of a current table inserted, updated or deleted.

    A document delivered again with an equal text is none of these. Only the documents that the version appended are
    compared with what they were, by hash.
    """
    keys = list(table.keys)
    added, gone = table.added(spark, version), F.coalesce(is_delete(), F.lit(False))
    old = live(table.read(spark, buckets, before=version, only=added)).select(*keys, F.xxhash64(text).alias("_old"), F.md5(text).alias("_old5"))
    new = added.select(*keys, F.when(~gone, F.xxhash64(text)).alias("_new"), F.when(~gone, F.md5(text)).alias("_new5"))
    met = old.join(new, keys, "full_outer")
    same = F.col("_old").eqNullSafe(F.col("_new")) & F.col("_old5").eqNullSafe(F.col("_new5"))
    action = F.when(F.col("_old").isNull(), F.when(F.col("_new").isNotNull(), INSERT)).when(F.col("_new").isNull(), DELETE).when(~same, UPDATE)
    return met.select(*keys, action.alias("action")).filter("action IS NOT NULL")


def _of(rows: DataFrame, delta: DataFrame, keys: Sequence[str], *actions: str) -> DataFrame:
    """Rows of the documents with some action; the rows stay where they lie, the documents' keys come to them."""
    wanted = delta.filter(F.col("action").isin(*actions)).select(*keys)
    return rows.join(wanted.hint("shuffle_hash"), list(keys), "left_semi")


def _before(delta: DataFrame) -> DataFrame:
    """Documents that had rows before."""
    return delta.filter(F.col("action") != INSERT)


def refresh_derived(
    table: PartTable, current: PartTable, delta: DataFrame, version: int, derive: Callable[[DataFrame], DataFrame]
) -> None:
    """Bring rows derived from documents up to date: ``derive`` runs on inserted and updated documents only.

    ``current`` has the documents of ``delta``, which is stored, as its rows of this version; those derived from them are
    written where they arise.
    """
    spark = delta.sparkSession
    changed = _of(live(current.added(spark, version)), delta, table.keys, INSERT, UPDATE)
    table.append(derive(changed), _before(delta), version, current.n_files(spark, version))


def refresh_index(
    index: PartTable,
    chunks: PartTable,
    delta: DataFrame,
    version: int,
    text: str,
    embed: Callable[[Column], Column] = hashed_embedding,
) -> None:
    """Bring the index of stored chunks up to date: of the updated documents' chunks, those whose text is the one that is
    already embedded keep their vector. Only the chunks of these documents are matched with stored ones."""
    spark = delta.sparkSession
    keys = list(index.keys)
    grain = [c for c in index.schema.names if c not in ("text_hash", "embedding")]
    want = chunks.added(spark, version).select(*grain, F.col(text).alias("_text"), F.md5(text).alias("text_hash"))
    updated = delta.filter(F.col("action") == UPDATE).select(*keys)
    stored = index.read(spark, before=version, only=updated)
    stored = stored.select(*grain, F.col("text_hash").alias("_old"), F.col("embedding").alias("_vector"))
    met = _of(want, delta, keys, UPDATE).join(stored, grain, "left")
    same = F.col("_old").eqNullSafe(F.col("text_hash")) & F.col("_vector").isNotNull()
    nothing = F.lit(None).cast(index.schema["embedding"].dataType)
    met = met.select(*grain, "_text", "text_hash", F.when(same, F.col("_vector")).alias("_vector"))
    met = met.unionByName(_of(want, delta, keys, INSERT).withColumn("_vector", nothing))
    fresh = embed(F.when(F.col("_vector").isNull(), F.col("_text")))
    rows = met.select(*grain, "text_hash", F.coalesce("_vector", fresh).alias("embedding"))
    index.append(rows, _before(delta), version, chunks.n_files(spark, version))
