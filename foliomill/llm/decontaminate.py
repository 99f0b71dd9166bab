"""Benchmark decontamination as a prefix-filtered containment join over word windows, in DataFrame functions only.

A window of an item is contained in a document if all its words follow each other there. As every word is needed, the
prefix of a window, its words ordered by how rare they are in the corpus, need only be its rarest word: a document
without that word cannot hold the window. Where a document has the word, its position and the word's place in the window
give the only possible start; starts before the text or windows beyond its end are out, and the rest is compared word
by word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliomill.session import fresh_path

WINDOW = 10
BLOCK_BYTES = 8 << 20  # window text that is sent to the executors at once
# fixed values: what separates words, and the letters that are lower-cased
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def words_of(text: Column) -> Column:
    """Words in their own case; null has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SEPARATORS), "")


def lowered(word: Column) -> Column:
    """A-Z in lower case, other letters as they are."""
    return F.when(F.octet_length(word) == F.length(word), F.lower(word)).otherwise(F.translate(word, UPPER, UPPER.lower()))


def item_windows(items: DataFrame, item_column: str, text_column: str, size: int = WINDOW) -> DataFrame:
    """``_item, _words`` for every run of ``size`` words of an item; an item with fewer words is one window."""
    words = items.select(F.col(item_column).alias("_item"), words_of(lowered(F.col(text_column))).alias("_all"))
    words = words.filter(F.size("_all") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("_all") - size + 1, F.lit(1)))
    cut = words.withColumn("_start", F.explode(starts))
    return cut.select("_item", F.slice("_all", F.col("_start"), F.lit(size)).alias("_words"))


def word_counts(docs: DataFrame, text_column: str, wanted: DataFrame) -> DataFrame:
    """``_word, _n`` over the whole corpus for the words of ``wanted``; others are dropped before the shuffle."""
    words = docs.select(F.explode(words_of(F.col(text_column))).alias("_raw"))
    words = words.select(lowered(F.col("_raw")).alias("_word"))
    return words.join(F.broadcast(wanted), "_word", "left_semi").groupBy("_word").agg(F.count("*").alias("_n"))


def _blocks(bytes_total: int) -> int:
    return max(1, -(-bytes_total // BLOCK_BYTES))


def rarest_words(docs: DataFrame, text_column: str, windows: DataFrame) -> DataFrame:
    """``_window, _words, _key, _offset``: each different window with its rarest word and that word's place in it.

    Ties go to the word that comes first in the alphabet, then to the first place. Words that no document has make a
    window impossible; such windows are left out.
    """
    spark = docs.sparkSession
    different = windows.select("_words").distinct().withColumn("_window", F.xxhash64("_words"))
    vocabulary = windows.select(F.explode("_words").alias("_word")).distinct()
    vocabulary.write.parquet(path := fresh_path(spark, "benchmark-words"))
    vocabulary = spark.read.schema("_word string").parquet(path)
    size = vocabulary.agg(F.sum(F.octet_length("_word") + 16)).first()[0] or 0
    n = _blocks(size)
    parts = [word_counts(docs, text_column, vocabulary.filter(F.pmod(F.xxhash64("_word"), F.lit(n)) == i)) for i in range(n)]
    counts = parts[0]
    for part in parts[1:]:
        counts = counts.unionByName(part)
    placed = different.select("_window", "_words", F.posexplode("_words").alias("_offset", "_word"))
    ranked = placed.join(counts, "_word", "left").groupBy("_words").agg(
        F.min("_window").alias("_window"),
        F.min(F.struct(F.coalesce("_n", F.lit(0)).alias("n"), F.col("_word").alias("w"), F.col("_offset").alias("o"))).alias("_least"),
    )
    ranked = ranked.filter("_least.n > 0")
    return ranked.select("_window", "_words", F.col("_least.w").alias("_key"), F.col("_least.o").alias("_offset"))


def window_hits(docs: DataFrame, text_column: str, keyed: DataFrame) -> DataFrame:
    """``_row, _id, _n_words`` once for every row of ``docs`` (``_id`` and the text), and ``_row, _start, _words`` for
    every occurrence of a window of ``keyed``, a bounded block of windows that goes to every executor.

    One pass reads, cuts and probes; the words of a document are only looked at again where a key matched. An empty word
    stands before the words of every document and is a key itself: it carries the row through the probe.
    """
    words = docs.select("_row", "_id", F.concat(F.array(F.lit("")), words_of(F.col(text_column))).alias("_all"))
    each = words.select("_row", "_id", "_all", F.posexplode("_all").alias("_at", "_raw"))
    each = each.withColumn("_key", lowered(F.col("_raw")))
    own = keyed.sparkSession.range(1).select(
        F.lit("").alias("_key"), F.lit(0).alias("_offset"), F.array(F.lit("")).alias("_words"), F.lit(None).cast("bigint").alias("_window")
    )
    found = each.join(F.broadcast(keyed.select("_key", "_offset", "_words", "_window").unionByName(own)), "_key")
    begin, length = F.col("_at") - F.col("_offset"), F.size("_words")
    inside = (begin >= 1) & (begin + length <= F.size("_all"))
    separator = "\u001f"  # cannot be part of a word
    same = lowered(F.array_join(F.slice("_all", begin + 1, length), separator)) == F.array_join("_words", separator)
    found = found.filter(F.col("_window").isNull() | (inside & same))
    is_row = F.col("_window").isNull()
    return found.select(
        "_row",
        F.when(is_row, F.col("_id")).alias("_id"),
        F.when(is_row, F.size("_all") - 1).cast("bigint").alias("_n_words"),
        F.when(~is_row, begin).alias("_start"),
        F.when(~is_row, F.col("_words")).alias("_words"),
    )


def contamination(
    docs: DataFrame,
    items: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
    size: int = WINDOW,
) -> DataFrame:
    """One row per input row: ``<id_column>, n_words, n_hit, n_items, item_ids, contaminated``.

    A word is hit if it lies in an occurrence of a window. Null and empty texts have no words; items without words have
    no window; without items or documents the result has no hits or no rows. Null ids and repeated rows stay as rows of
    their own; null item ids are not counted; other columns are not read.
    """
    spark = docs.sparkSession
    id_type = docs.schema[id_column].dataType
    rows = docs.select(
        F.monotonically_increasing_id().alias("_row"), F.col(id_column).alias("_id"), F.col(text_column).alias("_text")
    )
    windows = item_windows(items, item_column, item_text_column, size)
    rarest_words(rows, "_text", windows).write.parquet(path := fresh_path(spark, "benchmark-windows"))
    keyed = spark.read.parquet(path)
    total = keyed.agg(F.sum(F.octet_length(F.array_join("_words", " ")) + F.octet_length("_key") + 32)).first()[0] or 0
    n = _blocks(total)
    blocks = [window_hits(rows, "_text", keyed.filter(F.pmod(F.col("_window"), F.lit(n)) == i)) for i in range(n)]
    hits = blocks[0]
    for block in blocks[1:]:
        hits = hits.unionByName(block.filter(F.col("_start").isNotNull()))
    hits.write.parquet(path := fresh_path(spark, "benchmark-hits"))
    hits = spark.read.parquet(path)

    occurring = hits.filter(F.col("_start").isNotNull())
    hit = occurring.select("_row", F.explode(F.sequence(F.col("_start"), F.col("_start") + F.size("_words") - 1)).alias("_at"))
    hit = hit.groupBy("_row", "_at").agg(F.lit(1).alias("_one")).groupBy("_row").agg(F.count("*").alias("_hit"))
    owners = windows.filter(F.col("_item").isNotNull()).select("_item", "_words").distinct()
    matched = occurring.select("_row", "_words").distinct().join(owners, "_words").select("_row", "_item").distinct()
    matched = matched.groupBy("_row").agg(F.sort_array(F.collect_list(F.col("_item").cast("string"))).alias("_items"))
    found = hits.filter(F.col("_n_words").isNotNull()).select("_row", F.col("_id").cast(id_type).alias(id_column), "_n_words")
    found = found.join(hit, "_row", "left").join(matched, "_row", "left")
    none = F.array().cast("array<string>")
    return found.select(
        id_column,
        F.col("_n_words").alias("n_words"),
        F.coalesce("_hit", F.lit(0)).cast("bigint").alias("n_hit"),
        F.coalesce(F.size("_items"), F.lit(0)).cast("bigint").alias("n_items"),
        F.coalesce("_items", none).alias("item_ids"),
        F.col("_hit").isNotNull().alias("contaminated"),
    )
