"""Column expressions over text. All but the counting of embeddings stay in the JVM and touch one row at a time."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

# The white space that a Python ``str.strip`` removes.
WHITESPACE = r"[\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"

NOT_BLANK = "[^" + WHITESPACE[1:]

SCRIPT_OR_STYLE = r"(?s)<(script|style)[^>]*>.*?</(script|style)>"
TAG = r"<[^>]*>"
BLANK_RUN = r"[ \t\r\n]+"

EMBEDDING_DIM = 64
PART_ROWS = 256  # texts embedded at once


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind ``value`` once for ``body``: a lambda that mentions an expression would evaluate it per element."""
    return F.transform(F.array(value), body)[0]


def strip(text: Column) -> Column:
    return F.regexp_replace(text, f"^{WHITESPACE}+|{WHITESPACE}+$", "")


def is_blank(text: Column) -> Column:
    return ~F.coalesce(text.rlike(NOT_BLANK), F.lit(False))


def tokens(text: Column) -> Column:
    """Lower-case runs of a-z, in order. The one tokenizer that every lexical operator shares."""
    return F.array_remove(F.split(F.lower(text), "[^a-z]+"), "")


def token_set(text: Column) -> Column:
    return F.array_distinct(tokens(text))


def html_text(html: Column) -> Column:
    """Visible text of a web page: no scripts, styles or tags, white space folded."""
    bare = F.regexp_replace(F.regexp_replace(html, SCRIPT_OR_STYLE, " "), TAG, " ")
    return F.trim(F.regexp_replace(bare, BLANK_RUN, " "))


def document_name(path: Column, suffix: str) -> Column:
    """``folder/file`` in lower case with blanks as underscores; a path that does not match gives ``/``."""
    pattern = r".*\/([^\/]+)\/([^\/]+)\." + suffix  # fixed value: folder and file of a path

    def part(group: int) -> Column:
        return F.regexp_replace(F.lower(F.regexp_extract(path, pattern, group)), " ", "_")

    return F.concat(part(1), F.lit("/"), part(2))


def page_map(text: Column, separator: str = "\n") -> Column:
    """``map<string,string>`` from 0-based page number to page text."""
    pages = F.split(text, separator)
    return F.map_from_entries(F.transform(pages, lambda page, ix: F.struct(ix.cast("string"), page)))


def join_pages(pages: Column) -> Column:
    """Whole text of one document from its page map, in page order, without leaving the row."""
    entries = F.transform(
        F.map_entries(pages), lambda e: F.struct(e["key"].cast("int").alias("ix"), F.coalesce(e["value"], F.lit("")).alias("txt"))
    )
    return F.array_join(F.transform(F.sort_array(entries), lambda e: e["txt"]), "")


def fixed_chunks(text: Column, size: int, overlap: int) -> Column:
    """Chunks of ``size`` characters, each starting ``size - overlap`` after the one before.

    The text is cut once into steps and neighbouring steps are glued, so the work is linear in the text;
    repeated ``substring`` calls would walk a long text from its start for every chunk.
    """
    if not 0 <= overlap < size:
        raise ValueError("overlap must be at least 0 and below size")
    step = size - overlap
    span = math.ceil(size / step)
    n_chunks = F.greatest(F.ceil((F.length(text) - overlap) / step), F.lit(1)).cast("int")

    def glue(steps: Column) -> Column:
        return F.transform(
            F.slice(steps, F.lit(1), n_chunks),
            lambda _, ix: F.substring(F.array_join(F.slice(steps, ix + 1, F.lit(span)), ""), 1, size),
        )

    return let(F.regexp_extract_all(text, F.lit("(?s).{1,%d}" % step), F.lit(0)), glue)


def token_buckets(text: Column, dim: int = EMBEDDING_DIM) -> Column:
    """Hash bucket of each token, from the first four hexadecimal digits of its md5."""
    return F.transform(tokens(text), lambda t: F.conv(F.substring(F.md5(t), 1, 4), 16, 10).cast("int") % dim)


def hashed_embedding(text: Column, dim: int = EMBEDDING_DIM) -> Column:
    """Unit-length hashed bag of words; a text without tokens gives the zero vector, a null text null.

    The buckets of some texts of a batch are counted at once: one number per token goes to Python, one vector comes back.
    """

    @F.arrow_udf("array<double>")
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            for lo in range(0, len(batch), PART_ROWS):
                buckets = batch.slice(lo, PART_ROWS)
                there = buckets.is_valid().to_numpy(zero_copy_only=False)
                sizes = np.where(there, buckets.value_lengths().fill_null(0).to_numpy(zero_copy_only=False), 0)
                rows = np.repeat(np.arange(len(buckets)), sizes)
                flat = buckets.flatten().to_numpy(zero_copy_only=False)
                counts = np.bincount(rows * dim + flat, minlength=len(buckets) * dim).reshape(-1, dim).astype(np.float64)
                length = np.sqrt((counts * counts).sum(1, keepdims=True))
                vectors = np.divide(counts, length, out=np.zeros_like(counts), where=length > 0)
                ends = np.concatenate([[0], np.cumsum(there)]) * dim
                starts = pa.array(ends.astype(np.int32), mask=np.concatenate([~there, [False]]))
                yield pa.ListArray.from_arrays(starts, pa.array(vectors[there].ravel()))

    return count(token_buckets(text, dim))
