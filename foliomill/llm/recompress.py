"""Repeated runs of words by recompression: words covered by a window that also starts somewhere else.

A text is a string of names, at first those of its words. A round names pairs: a bit of each name says whether it may
open or close a pair, so a pair is formed wherever an opening name stands before a closing one, and neither word order
nor place has a say. Some rounds first name runs of one repeated name. A name is the hash of what it is made of and
therefore the same in every task. Each symbol knows the stretch of words that settles that it is there: within equal
stretches the symbols are equal, whatever stands around them.

Of the symbols that a window of ``WINDOW`` words settles, one of the highest level and of least hash is its anchor, so
equal windows have equal anchors at equal offsets. Spark then goes down from the anchors: names that occur once are out;
of the rest, those whose windows span equal words together repeat; what remains is compared window by window.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliomill.llm.components import stored
from foliomill.llm.sizes import sized_batches
from foliomill.llm.words import _BACK, _STEP, _powers, mixed, word_hashes

WINDOW = 35
ROUNDS = 5
RUN_ROUNDS = (0, 3)
PIECE = 1 << 18  # words worked on at once; longer texts are taken in overlapping pieces
CHUNK = 1 << 20  # bytes hashed at once
_FAR = 1 << 40  # no window reaches a text's end
_INDEX = np.uint64((1 << 24) - 1)
_SPACE = re.compile(rb"[\t-\r ]")


def text_words(text: bytes) -> np.ndarray:
    """Hash of each word of a text, taken in chunks that end between words."""
    if len(text) <= CHUNK:
        return word_hashes([text], lower=False)[0]
    found, at = [], 0
    while at < len(text):
        space = _SPACE.search(text, at + CHUNK)
        end = space.start() if space else len(text)
        found.append(word_hashes([text[at:end]], lower=False)[0])
        at = end
    return np.concatenate(found)


class Piece(NamedTuple):
    """Some texts' words in a row: ``row, offset`` and number of words of each part, and all hashes."""

    rows: list[int]
    offsets: list[int]
    sizes: list[int]
    words: np.ndarray


def pieces(rows: list[int], texts: list[bytes]) -> Iterator[Piece]:
    """Texts in pieces of about ``PIECE`` words; the parts of a long text overlap so that each window starts in one."""
    held: list[tuple[int, int, np.ndarray]] = []
    size = 0

    def joined() -> Piece:
        return Piece([h[0] for h in held], [h[1] for h in held], [len(h[2]) for h in held], np.concatenate([h[2] for h in held]))

    for row, text in zip(rows, texts, strict=True):
        words = text_words(text)
        for at in range(0, len(words) - WINDOW + 1, PIECE):
            part = words[at : at + PIECE + WINDOW - 1]
            if held and size + len(part) > PIECE + WINDOW:
                yield joined()
                held, size = [], 0
            held.append((row, at, part))
            size += len(part)
    if held:
        yield joined()


class Symbols(NamedTuple):
    """A level of a parse: names, the text each stands in, and the words ``[low, high)`` that settle it."""

    name: np.ndarray
    text: np.ndarray
    low: np.ndarray
    high: np.ndarray


def _beside(s: Symbols) -> tuple[np.ndarray, np.ndarray]:
    """``low`` of the symbol before and ``high`` of the one behind each; beyond a text's end nothing is settled."""
    same = s.text[1:] == s.text[:-1]
    return np.concatenate([[-_FAR], np.where(same, s.low[:-1], -_FAR)]), np.concatenate([np.where(same, s.high[1:], _FAR), [_FAR]])


def name_runs(s: Symbols, level: int) -> Symbols:
    """Each run of one name becomes a symbol; what stands beside it settles where it ends."""
    before, behind = _beside(s)
    first = np.flatnonzero(np.concatenate([[True], (s.name[1:] != s.name[:-1]) | (s.text[1:] != s.text[:-1])]))
    last = np.concatenate([first[1:], [len(s.name)]]) - 1
    many = (last - first + 1).astype(np.uint64)
    with np.errstate(over="ignore"):
        run = mixed(s.name[first] + mixed(many, 31 + level), 32 + level)
    return Symbols(np.where(many > 1, run, s.name[first]), s.text[first], before[first], behind[last])


def name_pairs(s: Symbols, level: int) -> Symbols:
    """Each opening name with a closing one behind it becomes a symbol. An opening name is settled by what stands behind
    it, a closing one that is left alone by what stands before."""
    before, behind = _beside(s)
    opens = (mixed(s.name, 33 + level) & np.uint64(1)).astype(bool)
    pair = np.zeros(len(opens), bool)
    pair[:-1] = opens[:-1] & ~opens[1:] & (s.text[1:] == s.text[:-1])
    kept = np.flatnonzero(~np.concatenate([[False], pair[:-1]]))
    with np.errstate(over="ignore"):
        both = mixed(s.name * _STEP + np.concatenate([s.name[1:], [np.uint64(0)]]), 34 + level)
    return Symbols(
        np.where(pair, both, s.name)[kept],
        s.text[kept],
        np.where(opens, s.low, before)[kept],
        np.where(opens, behind, s.high)[kept],
    )


def parse(words: np.ndarray, text: np.ndarray) -> list[Symbols]:
    """Symbols of all levels, the words first, as far up as a window can settle any."""
    place = np.arange(len(words))
    levels = [Symbols(words, text, place, place + 1)]
    for r in range(ROUNDS):
        s = levels[-1]
        s = name_pairs(name_runs(s, 100 * r) if r in RUN_ROUNDS else s, 100 * r + 50)
        if not (s.high - s.low <= WINDOW).any():
            break
        levels.append(s)
    return levels


class Spans:
    """Hashes of any stretches of words, in two lanes of 64 bits."""

    def __init__(self, words: np.ndarray):
        self.back = _powers(_BACK, len(words) + 1)
        self.sums = []
        with np.errstate(over="ignore"):
            for lane in (words, mixed(words, 41)):
                sums = np.zeros(len(words) + 1, np.uint64)
                np.cumsum(lane * _powers(_STEP, len(words)), out=sums[1:])
                self.sums.append(sums)

    def of(self, begin: np.ndarray, end: np.ndarray, extra: np.ndarray | int = 0, lanes: int = 2) -> list[np.ndarray]:
        with np.errstate(over="ignore"):
            back = self.back[begin]
            return [
                mixed(mixed((sums[end] - sums[begin]) * back, 42 + k) + np.asarray(extra).astype(np.uint64), 44 + k).view(np.int64)
                for k, sums in enumerate(self.sums[:lanes])
            ]


def _anchor_of(level: Symbols, starts: np.ndarray) -> np.ndarray:
    """For each window the settled symbol of least hash on a level, or -1."""
    first = np.searchsorted(level.low, starts, "left")
    behind = np.searchsorted(level.high, starts + WINDOW, "right")
    ok = behind > first
    found = np.full(len(starts), -1, np.int64)
    if not ok.any():
        return found
    first, behind = first[ok], behind[ok]
    least = [(mixed(level.name, 51) & ~_INDEX) | np.arange(len(level.name), dtype=np.uint64)]
    longest = int((behind - first).max())
    while 2 << (len(least) - 1) <= longest:
        half, below = 1 << (len(least) - 1), least[-1]
        least.append(np.concatenate([np.minimum(below[:-half], below[half:]), below[-half:]]))
    power = np.frexp((behind - first).astype(np.float64))[1] - 1  # largest power of two within
    best = np.empty(len(first), np.uint64)
    for p in range(len(least)):
        of = power == p
        best[of] = np.minimum(least[p][first[of]], least[p][behind[of] - (1 << p)])
    found[ok] = (best & _INDEX).astype(np.int64)
    return found


def anchors(piece: Piece) -> dict[str, np.ndarray]:
    """Anchors of all windows of a piece: first and last start, the anchor's key, two hashes of all that its windows span."""
    sizes = np.array(piece.sizes)
    ends = np.cumsum(sizes)
    begins = ends - sizes
    text = np.repeat(np.arange(len(sizes)), sizes)
    n_starts = sizes - WINDOW + 1
    of = np.repeat(np.arange(len(sizes)), n_starts)
    starts = np.arange(int(n_starts.sum())) - np.repeat(np.cumsum(n_starts) - n_starts, n_starts) + begins[of]
    levels = parse(piece.words, text)
    spans = Spans(piece.words)
    level_of, low, high = np.full(len(starts), -1), np.empty(len(starts), np.int64), np.empty(len(starts), np.int64)
    open_ = np.arange(len(starts))
    for k in range(len(levels) - 1, -1, -1):
        # a text's end makes low and high of its neighbours meaningless for the search, so these symbols go
        settled = (levels[k].low >= 0) & (levels[k].high < _FAR) & (levels[k].high - levels[k].low <= WINDOW)
        level = Symbols(*(c[settled] for c in levels[k]))
        found = _anchor_of(level, starts[open_])
        hit = found >= 0
        at, found = open_[hit], found[hit]
        level_of[at], low[at], high[at] = k, level.low[found], level.high[found]
        open_ = open_[~hit]
        if not len(open_):
            break
    new = np.concatenate([[True], (of[1:] != of[:-1]) | (level_of[1:] != level_of[:-1]) | (low[1:] != low[:-1]) | (high[1:] != high[:-1])])
    first = np.flatnonzero(new)
    last = np.concatenate([first[1:], [len(starts)]]) - 1
    begin, end, low, high, level_of = starts[first], starts[last], low[first], high[first], level_of[first]
    s1, s2 = spans.of(begin, end + WINDOW, (low - begin) * 128 + (low - end + 64))
    shift = np.array(piece.offsets)[of[first]] - begins[of[first]]
    return {
        "_row": np.array(piece.rows, np.int64)[of[first]],
        "_low": begin + shift,
        "_high": end + shift,
        "_key": spans.of(low, high, level_of, 1)[0],
        "_s1": s1,
        "_s2": s2,
    }


_ANCHORS = "_row bigint, _low bigint, _high bigint, _key bigint, _s1 bigint, _s2 bigint"


def _find_anchors(rows: DataFrame) -> DataFrame:
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in sized_batches(batch, 1):
                for piece in pieces(part.column(0).to_pylist(), part.column(1).cast(pa.binary()).to_pylist()):
                    yield pa.RecordBatch.from_pydict({k: pa.array(v) for k, v in anchors(piece).items()})

    return rows.mapInArrow(find, _ANCHORS)


def _repeated(df: DataFrame, *keys: str) -> DataFrame:
    """Keys of more than one row; equal rows are combined before the shuffle. They are stored, so that the join back deals
    out its rows anew and can split those of a frequent key."""
    return stored(df.groupBy(*keys).agg(F.count("*").alias("_times")).filter("_times > 1").drop("_times"), "repeated-keys")


def _window_names(rows: DataFrame, ranges: DataFrame) -> DataFrame:
    """``_row, _at, _w1, _w2``: two hashes of every window that starts in ``ranges`` (``_row, _low, _high``).

    A row's ranges are gathered beside its text: what a task holds of them follows from one text.
    """
    per_row = ranges.groupBy("_row").agg(F.collect_list("_low").alias("_low"), F.collect_list("_high").alias("_high"))
    met = rows.join(per_row, "_row").select("_row", "_text", "_low", "_high")

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                text = batch.column(1).slice(i, 1).cast(pa.binary())[0].as_py()
                spans = Spans(text_words(text))
                low, high = (np.asarray(batch.column(c)[i].values) for c in (2, 3))
                for k in range(0, len(low), 8192):
                    n = high[k : k + 8192] - low[k : k + 8192] + 1
                    at = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low[k : k + 8192], n)
                    w1, w2 = spans.of(at, at + WINDOW)
                    row = np.full(len(at), batch.column(0)[i].as_py(), np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in (row, at, w1, w2)], names=["_row", "_at", "_w1", "_w2"])

    return met.mapInArrow(name, "_row bigint, _at bigint, _w1 bigint, _w2 bigint")


def repeated_starts(rows: DataFrame) -> DataFrame:
    """``_row, _low, _high``: ranges of starts of windows that occur more than once."""
    found = _find_anchors(rows)
    named = stored(found.join(_repeated(found.select("_key"), "_key"), "_key"), "anchors")
    whole = _repeated(named, "_s1", "_s2").withColumn("_all", F.lit(True))
    named = stored(named.join(whole, ["_s1", "_s2"], "left").withColumn("_all", F.col("_all").isNotNull()), "anchors-named")
    done = named.filter("_all").select("_row", "_low", "_high")
    # a window that is left may be equal to one of a span that repeats: one span of each kind goes along
    left = named.filter("NOT _all")
    asked = stored(left.select("_key").distinct(), "asked-keys")
    twins = named.filter("_all").join(asked, "_key", "left_semi").dropDuplicates(["_s1", "_s2"])
    single = stored(_window_names(rows, left.unionByName(twins).select("_row", "_low", "_high")), "windows")
    single = single.join(_repeated(single, "_w1", "_w2"), ["_w1", "_w2"])
    return done.unionByName(single.select("_row", F.col("_at").alias("_low"), F.col("_at").alias("_high")))


def remove_repeated_words(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per input row: ``<id_column>, n_words, n_removed, spans, kept``.

    Words are what ASCII white space separates, unchanged. ``spans`` are the maximal removed runs of words as ``start,
    stop``, ``kept`` the other words joined by one blank (binary). Null, empty and blank texts have no words; a text under
    ``WINDOW`` words loses nothing. Windows are told apart by 128 bits. Null ids and repeated rows stay rows of their own,
    and a repeated row's text is a repetition; other columns are not read; an empty table gives an empty result. The table
    is read more than once and rows are told apart by their place in it, so ``docs`` must come from stored data.
    """
    id_type = docs.schema[id_column].dataType.simpleString()
    rows = docs.select(
        F.monotonically_increasing_id().alias("_row"),
        F.coalesce(F.col(text_column), F.lit("")).alias("_text"),
        F.col(id_column).alias("_id"),
    )
    ranges = repeated_starts(rows.select("_row", "_text"))
    ranges = ranges.groupBy("_row").agg(F.collect_list("_low").alias("_low"), F.collect_list("_high").alias("_high"))
    met = rows.join(ranges, "_row", "left").select("_id", "_text", "_low", "_high")
    span = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in sized_batches(batch, 1):
                total, kept, spans = [], [], []
                for i, text in enumerate(part.column(1).cast(pa.binary()).to_pylist()):
                    words = text.split()  # of bytes: at ASCII white space only
                    total.append(len(words))
                    spans.append([])
                    if (low := part.column(2)[i].values) is not None:
                        low, high = np.asarray(low), np.asarray(part.column(3)[i].values)
                        order = np.argsort(low, kind="stable")
                        begin, end = low[order], np.maximum.accumulate(high[order] + WINDOW)
                        new = np.concatenate([[True], begin[1:] > end[:-1]])
                        begin, end = begin[new].tolist(), end[np.append(np.flatnonzero(new)[1:] - 1, len(end) - 1)].tolist()
                        spans[-1] = [{"start": a, "stop": b} for a, b in zip(begin, end, strict=True)]
                        words = [w for a, b in zip([0, *end], [*begin, len(words)], strict=True) for w in words[a:b]]
                    kept.append(words)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array(total, pa.int64()),
                        pa.array([t - len(k) for t, k in zip(total, kept, strict=True)], pa.int64()),
                        pa.array(spans, span),
                        pa.array([b" ".join(k) for k in kept], pa.binary()),
                    ],
                    names=["_id", "n_words", "n_removed", "spans", "kept"],
                )

    made = f"_id {id_type}, n_words bigint, n_removed bigint, spans array<struct<start: bigint, stop: bigint>>, kept binary"
    return met.mapInArrow(remove, made).withColumnRenamed("_id", id_column)
