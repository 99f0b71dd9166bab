"""Distributed ranks, generated ids and the allocation of questions, without a global sort in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

PREFIX_DIGITS = 4  # hexadecimal digits of the md5: 65,536 groups of even size, whatever the keys look like


def stable_rank(df: DataFrame, grain: Sequence[str], output: str = "rank", digits: int = PREFIX_DIGITS) -> DataFrame:
    """Rank 1..n by the md5 of ``grain`` (unique per row), plus ``n_total``.

    The hash prefix cuts the rows into even groups. Only the group sizes, at most ``16 ** digits`` rows, are summed
    up in one place and broadcast; ranks inside a group come from a window. The same rows give the same ranks
    however they are partitioned.
    """
    if not 1 <= digits <= 4:
        raise ValueError("digits must be 1 to 4, the group sizes are broadcast")
    hashed = df.withColumn("_h", F.md5(F.concat_ws("#", *[F.col(c).cast("string") for c in grain])))
    hashed = hashed.withColumn("_p", F.substring("_h", 1, digits))
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    sizes = hashed.groupBy("_p").agg(F.count(F.lit(1)).alias("_n"))
    offsets = sizes.select(
        "_p",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"),
        F.sum("_n").over(Window.partitionBy(F.lit(0))).alias("n_total"),
    )
    inside = Window.partitionBy("_p").orderBy("_h", *grain)
    return (
        hashed.withColumn("_r", F.row_number().over(inside))
        .join(F.broadcast(offsets), "_p")
        .withColumn(output, F.col("_r") + F.col("_offset"))
        .drop("_h", "_p", "_r", "_offset")
    )


def last_used_id(table: DataFrame, column: str = "id") -> int:
    return table.agg(F.coalesce(F.max(column), F.lit(0))).first()[0]


def identity_ids(df: DataFrame, grain: Sequence[str], last_used: int, output: str = "id") -> DataFrame:
    """Dense bigint ids above ``last_used``; a retried task or a rerun hands out the same ids."""
    ranked = stable_rank(df, grain, "_rank")
    return ranked.withColumn(output, F.col("_rank") + F.lit(last_used).cast("bigint")).drop("_rank", "n_total")


def allocate_questions(docs: DataFrame, doc_id: str, n_questions: int) -> DataFrame:
    """Spread ``n_questions`` over all documents; with fewer questions than documents some get none."""
    total = F.lit(n_questions).cast("bigint")
    share = F.floor(total / F.col("n_total")) + (F.col("_rank") <= total % F.col("n_total")).cast("bigint")
    return stable_rank(docs.select(doc_id), [doc_id], "_rank").select(doc_id, share.alias("n_questions"))
