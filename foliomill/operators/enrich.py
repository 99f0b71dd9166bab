"""Per-document enrichment: page extraction, chunking, prompts, topics and model seams."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliomill.functions.text import fixed_chunks, is_blank, let, page_map, tokens

TOPIC_SCHEMA = "topic string"
NO_TOPIC = "N/A"
MIN_TOPIC_LETTERS = 5


def text_pages(content: Column) -> Column:
    """Page map of plain-text bytes, one page per line, as a column expression."""
    return page_map(F.decode(content, "UTF-8"))


def extract_pages(
    df: DataFrame,
    parser: Callable[[bytes], list[str]],
    keys: list[str],
    content: str = "content",
    on_error: str = "fail",
) -> DataFrame:
    """Page map of any file format through a parser plug-in, one call per file inside Arrow batches.

    ``on_error="fail"`` lets a broken file stop the job; ``"record"`` gives it no pages and a message in ``error``.
    """
    if on_error not in ("fail", "record"):
        raise ValueError("on_error is 'fail' or 'record'")

    def parse(value: bytes | None) -> tuple[list[tuple[str, str]], str | None]:
        if value is None:
            return [], None
        try:
            return [(str(ix), page) for ix, page in enumerate(parser(bytes(value)))], None
        except Exception as problem:
            if on_error == "fail":
                raise
            return [], f"{type(problem).__name__}: {problem}"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            parsed = [parse(value) for value in batch[content]]
            out = batch[keys].copy()
            out["pages"] = [dict(pages) for pages, _ in parsed]
            out["error"] = [error for _, error in parsed]
            yield out

    key_types = ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys)
    return df.select(*keys, content).mapInPandas(run, f"{key_types}, pages map<string,string>, error string")


def explode_pages(df: DataFrame, pages: Column, keep: Sequence[str]) -> DataFrame:
    """One row per page: ``page_nr`` (text, as extracted), ``page_ix`` for ordering, ``page_content``.

    Pass the expression that makes the page map, not a column computed before: Spark adds a filter on the size of an
    exploded column, and that filter would compute the map a second time.
    """
    found = df.select(*keep, F.explode(pages).alias("page_nr", "page_content"))
    return found.withColumn("page_ix", F.col("page_nr").cast("int"))


def explode_chunks(df: DataFrame, chunks: Column) -> DataFrame:
    """One row per chunk: ``chunk_ix`` and ``content_chunk``. Documents without chunks drop out, see coverage."""
    return df.select("*", F.posexplode(chunks).alias("chunk_ix", "content_chunk"))


def chunk_fixed(df: DataFrame, text: str, size: int, overlap: int) -> DataFrame:
    return explode_chunks(df, fixed_chunks(F.col(text), size, overlap))


def chunk_id(*grain: str) -> Column:
    return F.md5(F.concat_ws("#", *[F.col(c).cast("string") for c in grain]))


def coverage_reason(text: Column, chunks: Column, eligible: Column) -> Column:
    """Why a document has no chunk, or ``chunked``; read from the row itself, before the explode can drop it."""
    return (
        F.when(~eligible, "not eligible")
        .when(text.isNull(), "null text")
        .when(is_blank(text), "blank text")
        .when(F.size(chunks) < 1, "no chunk")
        .otherwise("chunked")
    )


def uncovered(docs: DataFrame, chunks: DataFrame, key: str) -> DataFrame:
    """Documents missing from a stored chunk table."""
    return docs.join(chunks.select(key), key, "left_anti")


def build_request(prompt: str, text: Column) -> Column:
    """Prompt and document in one request; a missing text gives no request."""
    return F.concat(F.lit(prompt), text)


def frequent_word(text: Column, min_letters: int = MIN_TOPIC_LETTERS) -> Column:
    """Most frequent token of at least ``min_letters``, ties by alphabet; null where there is none.

    Sorting the tokens makes equal ones neighbours, so one pass in the row counts them and nothing is shuffled.
    """
    words = F.sort_array(F.filter(tokens(text), lambda t: F.length(t) >= min_letters))
    start = F.struct(
        F.lit("").alias("word"), F.lit(0).alias("run"), F.lit(None).cast("string").alias("best"), F.lit(0).alias("most")
    )

    def step(acc: Column, word: Column) -> Column:
        run = F.when(acc["word"] == word, acc["run"] + 1).otherwise(F.lit(1))

        def advance(n: Column) -> Column:
            ahead = n > acc["most"]
            return F.struct(
                word.alias("word"),
                n.alias("run"),
                F.when(ahead, word).otherwise(acc["best"]).alias("best"),
                F.when(ahead, n).otherwise(acc["most"]).alias("most"),
            )

        return let(run, advance)

    return F.aggregate(words, start, step, lambda acc: acc["best"])


def topic_json(text: Column) -> Column:
    """Topic of a document as the JSON text a model would return."""
    return F.to_json(F.struct(F.coalesce(frequent_word(text), F.lit(NO_TOPIC)).alias("topic")))


def parse_topic(df: DataFrame, topic: str = "topic") -> DataFrame:
    """Add ``parsed_topic_str``: the response reduced to its declared fields; malformed text gives ``{}``."""
    return df.selectExpr("*", f"to_json(from_json({topic}, '{TOPIC_SCHEMA}')) AS parsed_topic_str")


def infer(df: DataFrame, model: Callable[[pd.Series], pd.Series], request: str, output: str) -> DataFrame:
    """Call a model once per row on Arrow batches of requests. Use it before any explode.

    The call counts as non-deterministic, so Spark neither repeats nor reorders it.
    """

    @F.pandas_udf("string")
    def call(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield model(batch)

    return df.withColumn(output, call.asNondeterministic()(F.col(request)))


def embed(df: DataFrame, model: Callable[[pd.Series], pd.Series], text: str, output: str = "embedding") -> DataFrame:
    """Embed a text column through a model callable on Arrow batches."""

    @F.pandas_udf("array<double>")
    def call(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield model(batch)

    return df.withColumn(output, call.asNondeterministic()(F.col(text)))


def combine_modalities(*tables: DataFrame) -> DataFrame:
    """Union by column name; a column a table lacks is null there."""
    first, *rest = tables
    for table in rest:
        first = first.unionByName(table, allowMissingColumns=True)
    return first
