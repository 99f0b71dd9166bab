"""Operators that match rows by key: newest row, change feeds, current and history tables, key checks, merges.

Any key may own a large share of the rows. Newest-row selection is therefore an aggregation, which leaves one row
per key and task before the shuffle, and history intervals are computed inside ranges of key and order, so that no task
ever holds all rows of one key.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliomill.session import fresh_path
from foliomill.sources.tables import overwrite_table

CHANGE_COLUMNS = ("_change_type", "_commit_version", "_commit_timestamp")


def newest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the last by ``order`` (earlier columns first, later ones break ties)."""
    row = F.struct(*df.columns)
    return df.groupBy(*keys).agg(F.max_by(row, F.struct(*order)).alias("_row")).select("_row.*")


def is_delete(change_type: str = "_change_type") -> Column:
    return F.lower(F.col(change_type)) == "delete"


def drop_preimages(changes: DataFrame, change_type: str = "_change_type") -> DataFrame:
    """The row as it was before an update carries no new state and must not enter the sequence."""
    return changes.filter(~F.lower(F.col(change_type)).eqNullSafe("update_preimage"))


def with_keys(changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Changes whose key is complete: a stored table can't tell which row a change without a key means."""
    return changes.filter(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]))


def latest_changes(changes: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Newest change per key, deletions included, so that a late older change cannot revive a deleted key."""
    return newest_per_key(drop_preimages(changes), keys, order)


def current_rows(changes: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Current table from a change feed: one row per live key. Nulls in the newest change overwrite."""
    latest = latest_changes(changes, keys, order)
    return latest.filter(~F.coalesce(is_delete(), F.lit(False))).drop(*CHANGE_COLUMNS)


def patched_rows(changes: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Current table in which a null in a change leaves its column as it was: one row per live key.

    Every column has its newest value that isn't null and no older than the key's last deletion, which empties all of
    them; the order columns are those of the newest change. One aggregate does all columns and combines before the
    shuffle, so a hot key leaves one row per task. Order values are unique within a key.
    """
    changes = drop_preimages(changes)
    at, gone = F.struct(*order), F.coalesce(is_delete(), F.lit(False))
    values = [c for c in changes.columns if c not in (*keys, *order, *CHANGE_COLUMNS)]
    # a struct around the value keeps it apart from a missing one
    newest = [F.max_by(F.struct(at.alias("at"), F.col(c).alias("v")), F.when(F.col(c).isNotNull() & ~gone, at)).alias(c) for c in values]
    folded = changes.groupBy(*keys).agg(F.max(at).alias("_last"), F.max(F.when(gone, at)).alias("_gone"), *newest)
    since = lambda value: F.col("_gone").isNull() | (value > F.col("_gone"))
    live = folded.filter(since(F.col("_last")))
    ordered = {c: F.col("_last")[c] for c in order}
    patched = {c: F.when(since(F.col(c)["at"]), F.col(c)["v"]) for c in values}
    return live.select(*[{**ordered, **patched}.get(c, F.col(c)).alias(c) for c in changes.columns if c not in CHANGE_COLUMNS])


def next_in_key(df: DataFrame, keys: Sequence[str], order: Sequence[str], output: str, slices: int | None = None) -> DataFrame:
    """Add ``output``: the value of ``order[0]`` in the following row of the same key.

    Rows are range-partitioned by key and whole order, so a large key spans as many partitions as its share of the rows
    asks for. Every partition is a slice with windows of its own; a closing row at the end of a key's part carries the
    first value of its next part. The slices are stored once, because both steps must see the same ones.
    """
    sequence = order[0]
    by = [F.col(c) for c in (*keys, *order)]
    ranged = df.repartitionByRange(slices, *by) if slices else df.repartitionByRange(*by)
    sliced = overwrite_table(ranged.withColumn("_slice", F.spark_partition_id()), fresh_path(df.sparkSession, "slices"))
    firsts = sliced.groupBy(*keys, "_slice").agg(F.min(F.struct(*order)).getField(sequence).alias("_first"))
    closing = (
        firsts.withColumn(sequence, F.lead("_first").over(Window.partitionBy(*keys).orderBy("_slice")))
        .filter(F.col(sequence).isNotNull())
        .select(*keys, "_slice", sequence, F.lit(True).alias("_closing"))
    )
    within = Window.partitionBy(*keys, "_slice").orderBy(F.col("_closing"), *order)
    return (
        sliced.withColumn("_closing", F.lit(False))
        .unionByName(closing, allowMissingColumns=True)
        .withColumn(output, F.lead(sequence).over(within))
        .filter(~F.col("_closing"))
        .drop("_slice", "_closing")
    )


def history_rows(changes: DataFrame, keys: Sequence[str], order: Sequence[str], slices: int | None = None) -> DataFrame:
    """Every version of every key with its validity. A deletion closes the version before it and adds no row."""
    versions = next_in_key(drop_preimages(changes), keys, order, "__END_AT", slices)
    live = versions.filter(~F.coalesce(is_delete(), F.lit(False)))
    return live.withColumn("__START_AT", F.col(order[0])).drop(*CHANGE_COLUMNS)


def _fingerprints(df: DataFrame, keys: Sequence[str], values: Sequence[str], side: str) -> DataFrame:
    """Two hashes of the values per key, and how many rows have it; combined before the shuffle, without the values."""
    first, second = F.xxhash64(*values), F.xxhash64(F.hash(*values), *reversed(values))
    marks = df.select(*keys, first.alias("a"), second.alias("b"))
    return marks.groupBy(*keys).agg(
        F.count(F.lit(1)).alias(f"_n_{side}"), F.struct(F.max("a").alias("a"), F.max("b").alias("b")).alias(f"_{side}")
    )


def changed_keys(old: DataFrame, new: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """``keys, _kind`` (``insert``, ``delete`` or ``update``) of the keys whose rows differ. A repeated key stops the job:
    a feed cannot tell which of its rows became which."""
    both = _fingerprints(old, keys, values, "old").join(_fingerprints(new, keys, values, "new"), list(keys), "full_outer")
    repeated = (F.coalesce("_n_old", F.lit(0)) > 1) | (F.coalesce("_n_new", F.lit(0)) > 1)
    message = F.concat(F.lit("key occurs more than once in a snapshot: "), F.to_json(F.struct(*keys)))
    kind = (
        F.when(repeated, F.raise_error(message).cast("string"))
        .when(F.col("_n_old").isNull(), "insert")
        .when(F.col("_n_new").isNull(), "delete")
        .when(F.col("_old") != F.col("_new"), "update")
    )
    return both.select(*keys, kind.alias("_kind")).filter(F.col("_kind").isNotNull())


def change_feed(old: DataFrame, new: DataFrame, keys: Sequence[str], commit_version: int) -> DataFrame:
    """Row changes that turn snapshot ``old`` into snapshot ``new``; keys are unique and not null on both sides.

    Keys and hashes meet first; whole rows are only fetched for the keys that changed.
    """
    values = [c for c in new.columns if c not in keys]
    changed = changed_keys(old, new, keys, values)

    def rows(side: DataFrame, kinds: dict[str, str]) -> DataFrame:
        names = F.create_map(*[F.lit(x) for pair in kinds.items() for x in pair])
        met = side.join(changed.filter(F.col("_kind").isin(list(kinds))), list(keys))
        return met.select(*keys, *values, names[F.col("_kind")].alias("_change_type"))

    feed = rows(old, {"delete": "delete", "update": "update_preimage"}).unionByName(
        rows(new, {"insert": "insert", "update": "update_postimage"})
    )
    return feed.withColumn("_commit_version", F.lit(commit_version).cast("bigint"))


def apply_feed(old: DataFrame, feed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Snapshot after a change feed; the inverse of :func:`change_feed`."""
    base = old.withColumn("_change_type", F.lit("insert")).withColumn("_commit_version", F.lit(-1).cast("bigint"))
    return current_rows(base.unionByName(feed), keys, ["_commit_version"])


def key_violations(df: DataFrame, keys: Sequence[str], rule: str) -> DataFrame:
    """Counts behind a primary key: rows, rows with a null in the key, keys that repeat and the rows they hold."""
    missing = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    groups = df.groupBy(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)], missing.alias("missing")).count()
    repeated = ~F.col("missing") & (F.col("count") > 1)

    def total(value: Column) -> Column:
        return F.coalesce(F.sum(value), F.lit(0)).cast("bigint")

    return groups.agg(
        total(F.col("count")).alias("n_rows"),
        total(F.when(F.col("missing"), F.col("count")).otherwise(0)).alias("n_null_rows"),
        total(repeated.cast("int")).alias("n_repeated_keys"),
        total(F.when(repeated, F.col("count")).otherwise(0)).alias("n_repeated_rows"),
    ).select(F.lit(rule).alias("rule"), "*")


def require_keys(report: DataFrame) -> None:
    """Stop a job on null or repeated keys. The report has one row per rule."""
    broken = [r["rule"] for r in report.filter("n_null_rows > 0 OR n_repeated_keys > 0").collect()]
    if broken:
        raise ValueError(f"key rules broken: {', '.join(broken)}")


def quarantine(df: DataFrame, required: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows with every required column set, and the rest."""
    missing = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in required])
    return df.filter(~missing), df.filter(missing)


def merge_records(
    existing: DataFrame, incoming: DataFrame, identity: Sequence[str], order: Sequence[str], values: Sequence[str]
) -> DataFrame:
    """Upsert evaluation records: equal inputs are one record, an incoming value wins over an existing one.

    Values missing on the incoming side keep the existing value. Copies of one input fold before the shuffle.
    """
    origin = existing.withColumn("_origin", F.lit(0)).unionByName(incoming.withColumn("_origin", F.lit(1)))
    rank = F.struct("_origin", *order)
    newest_set = [F.max(F.when(F.col(v).isNotNull(), F.struct(rank, F.col(v).alias("v")))).getField("v").alias(v) for v in values]
    last = F.max(rank).alias("_last")
    merged = origin.groupBy(*identity).agg(last, *newest_set)
    return merged.select(
        *identity,
        *[F.col(f"_last.{c}").alias(c) for c in order],
        *values,
        F.when(F.col("_last._origin") == 1, "incoming").otherwise("existing").alias("origin"),
    )
