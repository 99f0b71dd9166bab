"""Recursive text splitting: prefer paragraph cuts, then lines, then words, then characters.

The helper works on offsets into one text, so a chunk costs one slice; Spark hands it Arrow batches of texts, and it hands
chunks back a few texts at a time, because the chunks of a batch take many times the room of its texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

# Separators in order of preference; the empty one cuts between characters.
SEPARATORS = ("\n\n", "\n", " ", "")

PART_BYTES = 1 << 18  # of text whose chunks are handed back at once, or one longer text

Span = tuple[int, int]


def _spans(text: str, lo: int, hi: int, separator: str) -> Iterator[Span]:
    """Non-empty pieces of ``text[lo:hi]``; a separator opens the piece that follows it."""
    if not separator:
        yield from ((at, at + 1) for at in range(lo, hi))
        return
    start, seen = lo, text.find(separator, lo, hi)
    while seen >= 0:
        if seen > start:
            yield start, seen
        start = seen
        seen = text.find(separator, seen + len(separator), hi)
    if start < hi:
        yield start, hi


def _pack(text: str, spans: list[Span], size: int, overlap: int, out: list[str]) -> None:
    """Fill chunks up to ``size`` from touching spans; the next chunk starts with at most ``overlap`` of the last."""
    first, start = 0, spans[0][0]
    for at, (lo, hi) in enumerate(spans):
        if hi - start > size:
            if lo > start and (chunk := text[start:lo].strip()):
                out.append(chunk)
            while lo - start > overlap or (hi - start > size and lo > start):
                first += 1
                start = spans[first][0] if first < at else lo
    if chunk := text[start : spans[-1][1]].strip():
        out.append(chunk)


def _split(text: str, lo: int, hi: int, level: int, size: int, overlap: int, out: list[str]) -> None:
    while SEPARATORS[level] and text.find(SEPARATORS[level], lo, hi) < 0:
        level += 1
    finer = level + 1
    short: list[Span] = []
    for span in _spans(text, lo, hi, SEPARATORS[level]):
        if span[1] - span[0] < size:
            short.append(span)
            continue
        if short:
            _pack(text, short, size, overlap, out)
            short = []
        if finer < len(SEPARATORS):
            _split(text, *span, finer, size, overlap, out)
        else:
            out.append(text[span[0] : span[1]])
    if short:
        _pack(text, short, size, overlap, out)


def split_text(text: str | None, size: int, overlap: int) -> list[str]:
    """Chunks of one text; a missing or blank text has none."""
    if overlap > size:
        raise ValueError("overlap must not exceed size")
    chunks: list[str] = []
    if text:
        _split(text, 0, len(text), 0, size, overlap, chunks)
    return chunks


def _parts(texts: pa.Array) -> Iterator[pa.Array]:
    """The texts in order, ``PART_BYTES`` and the text that goes beyond them at a time."""
    lo = size = 0
    for at, n in enumerate(pc.fill_null(pc.binary_length(texts), 0).to_pylist(), 1):
        size += n + 8
        if size > PART_BYTES:
            yield texts.slice(lo, at - lo)
            lo, size = at, 0
    if lo < len(texts):
        yield texts.slice(lo)


def recursive_chunks(text: Column, size: int, overlap: int) -> Column:
    """``array<string>`` of chunks; Arrow batches in, smaller Arrow batches out."""

    @F.arrow_udf("array<string>")
    def split_batches(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            for part in _parts(texts):
                yield pa.array([split_text(value, size, overlap) for value in part.to_pylist()], pa.list_(pa.string()))

    return split_batches(text)
