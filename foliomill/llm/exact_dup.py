"""Exact duplicates: combine locally, then per salt, then over all salts, comparing whole texts at every stage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliomill.llm.components import ROWS, stored

SALTS = 16
HOT_SHARE = 1000  # a text with more than this part of all rows is frequent; so fewer texts are than this number


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def text_classes(
    docs: DataFrame, id_column: str, text_column: str, salts: int = SALTS, digest: Callable[[Column], Column] = sha256
) -> DataFrame:
    """One row per different text: ``_digest, _text, _keep, _n`` (largest id with the row's place, number of rows).

    The grouping key holds the text itself beside its digest, so equal digests alone never merge rows. The salt is the
    number of the input partition: Spark combines equal texts of a partition before the first shuffle, then those of one
    salt meet, then the salts' winners. However often a text occurs, a task gets at most one row of it per partition in
    the first shuffle and one per salt in the second.
    """
    text = F.coalesce(F.col(text_column), F.lit(""))
    rows = docs.select(
        digest(text).alias("_digest"),
        text.alias("_text"),
        F.struct(F.col(id_column).alias("id"), F.monotonically_increasing_id().alias("row")).alias("_id"),
        F.pmod(F.spark_partition_id(), F.lit(salts)).alias("_salt"),
    )
    salted = rows.groupBy("_digest", "_salt", "_text").agg(F.max("_id").alias("_keep"), F.count("*").alias("_n"))
    # one exchange by digest serves this grouping and the one by digest alone
    merged = salted.drop("_salt").repartition("_digest")
    return merged.groupBy("_digest", "_text").agg(F.max("_keep").alias("_keep"), F.sum("_n").alias("_n"))


def exact_duplicates(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    salts: int = SALTS,
    digest: Callable[[Column], Column] = sha256,
) -> DataFrame:
    """One row per input row: ``<id_column>, keep_id, group_size, kept, text_sha256``.

    ``keep_id`` is the largest id among the rows of an equal text. Null text counts as empty. Ids that are null are
    smaller than any other; a group with null ids only has a null ``keep_id``. Of rows repeated with the same id and
    text exactly one is kept. An empty table gives an empty result; other columns are not read.

    Every row of a digest goes into the comparison of whole texts. Digests under which all texts turned out equal are
    then enough to find a row's group; if ``digest`` ever gives one value to different texts, those rows are found by text.
    The groups of frequent texts, fewer than ``HOT_SHARE``, are sent to the rows; only the others are met by a shuffle.
    ``docs`` is read twice and rows are told apart by their place in it, so it must come from stored data.
    """
    text = F.coalesce(F.col(text_column), F.lit(""))
    spark = docs.sparkSession
    classes = text_classes(docs, id_column, text_column, salts, digest)
    per_digest = classes.groupBy("_digest").agg(
        F.count("*").alias("_texts"), F.max("_keep").alias("_keep"), F.max("_n").alias("group_size"), F.sum("_n").alias("_rows")
    )
    per_digest = stored(per_digest, "exact-groups", ROWS)
    total = per_digest.agg(F.sum("_rows")).first()[0] or 0
    clashing = per_digest.filter("_texts > 1").select("_digest")
    owned = per_digest.filter("_texts = 1").drop("_texts")
    is_hot = F.col("_rows") * HOT_SHARE > total

    rows = docs.select(
        F.col(id_column).alias("_id"),
        F.monotonically_increasing_id().alias("_row"),
        digest(text).alias("_digest"),
        sha256(text).alias("text_sha256"),
    )
    hot = owned.filter(is_hot).select("_digest", F.struct("_keep", "group_size").alias("_hot"))
    rows = rows.join(F.broadcast(hot), "_digest", "left")
    found = rows.filter("_hot IS NOT NULL").select("_id", "_row", "text_sha256", "_hot.*")
    rest = rows.filter("_hot IS NULL").drop("_hot").join(owned.filter(~is_hot).drop("_rows"), "_digest")
    found = found.unionByName(rest.drop("_digest"))
    if not clashing.isEmpty():
        texts = docs.select(
            F.col(id_column).alias("_id"), F.monotonically_increasing_id().alias("_row"), digest(text).alias("_digest"), text.alias("_text")
        )
        owners = classes.withColumnRenamed("_n", "group_size")
        texts = texts.join(clashing, "_digest", "left_semi").join(owners, ["_digest", "_text"])
        found = found.unionByName(texts.select("_id", "_row", sha256(F.col("_text")).alias("text_sha256"), "_keep", "group_size"))
    return found.select(
        F.col("_id").alias(id_column),
        F.col("_keep.id").alias("keep_id"),
        F.col("group_size").cast("long").alias("group_size"),
        (F.col("_row") == F.col("_keep.row")).alias("kept"),
        "text_sha256",
    )
