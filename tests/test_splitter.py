import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from foliomill.functions.splitter import PART_BYTES, _parts, recursive_chunks, split_text

VECTORS = [
    ("aaa bbb ccc ddd eee", 7, 3, ["aaa bbb", "ccc", "ddd", "eee"]),
    ("one two\n\nthree four five", 10, 4, ["one two", "three", "four five"]),
    ("abcdefghij", 4, 1, ["abcd", "defg", "ghij"]),
    ("", 4, 1, []),
    ("   ", 4, 1, []),
    (None, 4, 1, []),
    ("para one.\n\npara two is longer\nline b", 12, 5, ["para one.", "para two is", "is longer", "line b"]),
    ("a b c d e f", 5, 2, ["a b c", "c d", "d e", "e f"]),
]
TEXTS = st.text(alphabet="ab é\n😀", max_size=120)


def plain_split(text, size, overlap, separators=("\n\n", "\n", " ", "")):
    """The published algorithm on lists of strings, step by step; slow on purpose."""
    at = next(i for i, s in enumerate(separators) if s == "" or s in text)
    separator, rest = separators[at], separators[at + 1 :]
    parts = list(text) if separator == "" else text.split(separator)
    pieces = parts if separator == "" else parts[:1] + [separator + p for p in parts[1:]]
    chunks, waiting = [], []

    def merge(items):
        window, total, done = [], 0, []
        for item in items:
            if total + len(item) > size:
                if window and "".join(window).strip():
                    done.append("".join(window).strip())
                while total > overlap or (total + len(item) > size and total > 0):
                    total -= len(window.pop(0))
            window.append(item)
            total += len(item)
        if "".join(window).strip():
            done.append("".join(window).strip())
        return done

    for piece in filter(None, pieces):
        if len(piece) < size:
            waiting.append(piece)
            continue
        chunks += merge(waiting)
        waiting = []
        chunks += plain_split(piece, size, overlap, rest) if rest else [piece]
    return chunks + merge(waiting)


@pytest.mark.parametrize("text,size,overlap,expected", VECTORS)
def test_known_chunks(text, size, overlap, expected):
    assert split_text(text, size, overlap) == expected


@settings(max_examples=400, deadline=None)
@given(TEXTS, st.integers(1, 30), st.integers(0, 30))
def test_equals_the_plain_algorithm(text, size, overlap):
    overlap = min(overlap, size)
    assert split_text(text, size, overlap) == (plain_split(text, size, overlap) if text else [])


@settings(max_examples=200, deadline=None)
@given(TEXTS, st.integers(2, 30), st.integers(0, 10))
def test_chunks_fit_and_come_from_the_text(text, size, overlap):
    for chunk in split_text(text, size, min(overlap, size - 1)):
        assert len(chunk) <= size and chunk in text and chunk.strip()


def test_overlap_may_not_exceed_size():
    with pytest.raises(ValueError):
        split_text("abc", 2, 3)


def test_column_form(spark):
    df = spark.createDataFrame([(t,) for t, *_ in VECTORS], "t string")
    got = df.select(recursive_chunks(F.col("t"), 7, 3).alias("c")).collect()
    assert [r.c for r in got] == [split_text(t, 7, 3) for t, *_ in VECTORS]


def test_a_batch_is_handed_back_in_parts(spark):
    texts = [None, "é" * 1000, ""] * 700 + ["x" * (3 * PART_BYTES), None]
    parts = list(_parts(pa.array(texts)))
    assert [t for part in parts for t in part.to_pylist()] == texts
    assert len(parts) > 5 and all(sum(len((t or "").encode()) for t in part.to_pylist()[:-1]) <= PART_BYTES for part in parts)
    rows = [(i, None if i % 5 == 0 else "word " * (i * 37 % 300)) for i in range(3000)]
    df = spark.createDataFrame(rows, "i int, t string").coalesce(1)
    got = df.select("i", recursive_chunks(F.col("t"), 40, 5).alias("c")).collect()
    assert {r.i: r.c for r in got} == {i: split_text(t, 40, 5) for i, t in rows}
