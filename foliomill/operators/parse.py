"""Files to pages by a parser, with the files it can't read set aside in the same pass; a scanner for web pages."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

OUT_BYTES = 4 << 20  # text of pages that a task holds before it passes them on
_TOKEN = re.compile(r"<!--.*?-->|<(/?)([a-zA-Z][a-zA-Z0-9]*)?[^>]*>", re.DOTALL)
_HIDDEN = ("script", "style")
_BLANKS = re.compile(r"[ \t\r\n]+")


def html_pages(content: bytes, opens: tuple[str, ...] = ("h1",)) -> list[str]:
    """Visible text of a web page, cut before each of some elements; pages without text are left out.

    Tags and comments separate words, what scripts and styles hold is hidden. Bytes that are no UTF-8, a tag that is not
    closed and a hidden element without an end are errors.
    """
    try:
        html = content.decode("utf-8")
    except UnicodeDecodeError as problem:
        raise ValueError(f"no UTF-8 at byte {problem.start}") from None
    pages, held, at = [], [], 0

    def close() -> None:
        text = _BLANKS.sub(" ", " ".join(held)).strip(" ")
        if text:
            pages.append(text)
        held.clear()

    while at < len(html):
        begin = html.find("<", at)
        if begin < 0:
            held.append(html[at:])
            break
        held.append(html[at:begin])
        token = _TOKEN.match(html, begin)
        if token is None:
            raise ValueError(f"a tag is not closed at character {begin}")
        name = (token[2] or "").lower()
        at = token.end()
        if name in opens and not token[1]:
            close()
        elif name in _HIDDEN and not token[1]:
            end = re.compile(f"</{name}[^>]*>", re.IGNORECASE).search(html, at)
            if end is None:
                raise ValueError(f"{name} is not closed at character {begin}")
            at = end.end()
    close()
    return pages


def parse_files(
    files: DataFrame, parser: Callable[[bytes], list[str]], key: str, content: str, target: str
) -> tuple[DataFrame, DataFrame]:
    """Store the pages of ``files`` and the files that ``parser`` fails on; returns both tables.

    Pages have ``<key>, page_nr, page_content``, failed files ``<key>, length, error``. A file is parsed once: pages and
    errors are parts of one write, so neither can be there without the other. A null content is an error too; a file
    without pages is in neither table. Files go through the parser one at a time, and their pages are passed on whenever
    ``OUT_BYTES`` of text have been gathered, so a task holds little more than its largest file.
    """
    key_type = files.schema[key].dataType.simpleString()
    made = f"`{key}` {key_type}, page_nr int, page_content string, length bigint, error string, _broken boolean"

    def parse(value: bytes | None) -> tuple[list[str], str | None]:
        if value is None:
            return [], "no content"
        try:
            return parser(value), None
        except Exception as problem:
            return [], f"{type(problem).__name__}: {problem}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        places: list[int] = []
        held = 0

        def out(batch: pa.RecordBatch) -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True)) or [()] * 5
            types = (pa.int32(), pa.string(), pa.int64(), pa.string(), pa.bool_())
            arrays = [batch.column(0).take(pa.array(places, pa.int64()))] + [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, names=[key, "page_nr", "page_content", "length", "error", "_broken"])

        for batch in batches:
            for place in range(batch.num_rows):
                value = batch.column(1)[place].as_py()
                pages, error = parse(value)
                if error is not None:
                    rows.append((None, None, None if value is None else len(value), error, True))
                    places.append(place)
                for nr, page in enumerate(pages):
                    rows.append((nr, page, None, None, False))
                    places.append(place)
                    held += len(page)
                if held >= OUT_BYTES:
                    yield out(batch)
                    rows, places, held = [], [], 0
            if rows:
                yield out(batch)
                rows, places, held = [], [], 0

    parsed = files.select(key, content).mapInArrow(run, made)
    parsed.write.mode("overwrite").partitionBy("_broken").parquet(target)
    stored = files.sparkSession.read.schema(parsed.schema).parquet(target)
    pages = stored.filter("NOT _broken").select(key, "page_nr", "page_content")
    return pages, stored.filter("_broken").select(key, "length", "error")
