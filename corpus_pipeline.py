"""A training corpus from raw documents: poor texts go, copies and near copies go, benchmark leaks go, the rest is encoded.

Every stage takes ``(spark, docs, sf_dir)`` with ``docs`` read from stored Parquet, and all but the last return the columns
of ``docs``, whatever they are called. Rows are told apart by their place in the stored input, so null and repeated ids are
no trouble: a row with a null id is a document like any other. Null and empty texts are empty documents: the classifier
scores them, equal ones are one group of exact copies, and no later stage links or drops them. An empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliomill.llm.bpe import encode_texts
from foliomill.llm.components import stored
from foliomill.llm.decontaminate import contamination
from foliomill.llm.exact_dup import exact_duplicates
from foliomill.llm.near_dup import near_duplicates
from foliomill.llm.quality import keep_good, learn
from foliomill.llm.queries import table, tokenizer

def _numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with each row's place, and the name of that column, which no column of ``docs`` has."""
    name, taken = "_place_in_stage", {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return docs.withColumn(name, F.monotonically_increasing_id()), name


def _ids(rows: DataFrame, row: str) -> DataFrame:
    """Id and place as one ordered value, which no two rows share."""
    return rows.select(F.struct("doc_id", F.col(row).alias("row")).alias("id"), "text")


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learned from the labels' training part, scores 0.7 or more.

    Without labels every document scores 0.5 and goes.
    """
    return keep_good(docs, learn(docs, table(spark, sf_dir, "labels")))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts the one with the largest id; of rows that share it the last in the table. Null ids
    are smaller than any other."""
    rows, row = _numbered(docs)
    kept = exact_duplicates(_ids(rows, row), "id").filter("kept").select(F.col("id.row").alias(row))
    return rows.join(kept, row, "left_semi").drop(row)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id; of rows that share it the first in the table.
    Null ids are smaller than any other here."""
    rows, row = _numbered(docs)
    gone = near_duplicates(_ids(rows, row), "id").filter(~F.col("kept")).select(F.col("id.row").alias(row))
    return rows.join(gone, row, "left_anti").drop(row)


def without_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs."""
    rows, row = _numbered(docs)
    found = contamination(rows.select(row, "text"), table(spark, sf_dir, "benchmark"), row)
    return rows.join(found.filter("contaminated").select(row), row, "left_anti").drop(row)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, token_ids, decoded_sha256``: ids as little-endian unsigned 32-bit integers."""
    found = encode_texts(docs, tokenizer("byte_bpe_50k.json"))
    return found.select(
        "doc_id",
        (F.octet_length("token_ids") / 4).cast("bigint").alias("n_tokens"),
        "token_ids",
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("quality classifier", good_quality),
    ("exact dedup", without_copies),
    ("MinHash near-dedup", without_near_copies),
    ("benchmark decontamination", without_leaks),
    ("BPE encoding and decoding", encoded),
]

#: SQL can state neither the classifier nor the encoding.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.lower().replace(" ", "-"))
    return docs
