"""Repeated passages: bytes covered by a string of 200 bytes that also starts somewhere else.

Sampled positions take the place of a periodic difference cover: of the 153 runs of 48 bytes within a string of 200, the
one of least hash is its anchor. Equal strings have their anchors at equal offsets, so a sampled position and an offset
name every string, and one position in 77 is sampled instead of two in three. The suffixes at the anchors get names (hashes
of what follows); those whose name is unique are out. The starts that share an anchor are merged in groups of neighbours:
what all strings of a group have in common must repeat for one of them to repeat, and if the text that they span together
repeats, all do. Groups that neither test decides are cut down, in the end to single strings.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliomill.llm.components import stored
from foliomill.llm.words import _BACK, _STEP, _VALUES, _powers, mixed

LENGTH = 200
GRAM = 48
STARTS = LENGTH - GRAM + 1  # starts that can share an anchor
GROUP = 24  # starts tested together
PIECE = 1 << 20  # bytes worked on at once; longer texts are taken in overlapping pieces
_PLACE = np.uint64((1 << 24) - 1)


class Hashes:
    """Hashes of any stretch of a buffer, from running sums."""

    def __init__(self, data: np.ndarray):
        with np.errstate(over="ignore"):
            self.sums = np.zeros(len(data) + 1, np.uint64)
            np.cumsum(_VALUES[data] * _powers(_STEP, len(data)), out=self.sums[1:])
        self.back = _powers(_BACK, len(data) + 1)

    def of(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mixed((self.sums[end] - self.sums[begin]) * self.back[begin])


class Piece(NamedTuple):
    row: int
    offset: int
    data: bytes


def pieces(rows: list[int], texts: list[bytes]) -> Iterator[list[Piece]]:
    """Texts in lists of about ``PIECE`` bytes; the pieces of a long text overlap so that each string starts in one."""
    held, size = [], 0
    for row, text in zip(rows, texts, strict=True):
        for at in range(0, max(1, len(text) - LENGTH + 1), PIECE):
            data = text[at : at + PIECE + LENGTH - 1]
            if held and size + len(data) > PIECE + LENGTH:
                yield held
                held, size = [], 0
            held.append(Piece(row, at, data))
            size += len(data)
    if held:
        yield held


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` values, from running minima to both sides within blocks."""
    n = len(values) - width + 1
    full = -(-len(values) // width) * width
    padded = np.full(full, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(values)] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).reshape(-1)
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def anchors(held: list[Piece]) -> dict[str, np.ndarray] | None:
    """Anchors of all strings in some pieces: place, first and last start, hash of its gram, hash of all that its starts span."""
    sizes = np.array([len(p.data) for p in held])
    ends = np.cumsum(sizes)
    begins = ends - sizes
    data = np.frombuffer(b"".join(p.data for p in held), np.uint8)
    if len(data) < LENGTH:
        return None
    hashes = Hashes(data)
    grams = np.arange(len(data) - GRAM + 1)
    gram = hashes.of(grams, grams + GRAM)
    least = _sliding_min((gram & ~_PLACE) | grams.astype(np.uint64), STARTS) & _PLACE
    n_starts = np.maximum(sizes - LENGTH + 1, 0)
    of = np.repeat(np.arange(len(held)), n_starts)
    starts = np.arange(int(n_starts.sum())) - np.repeat(np.cumsum(n_starts) - n_starts, n_starts) + begins[of]
    if not len(starts):
        return None
    at = least[starts].astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (of[1:] != of[:-1])]))
    last = np.concatenate([first[1:], [len(starts)]]) - 1
    place, low, high, of = at[first], starts[first], starts[last], of[first]
    with np.errstate(over="ignore"):
        span = hashes.of(low, high + LENGTH) + mixed((place - low).astype(np.uint64) * np.uint64(256) + (place - high).astype(np.uint64), 21)
    shift = np.array([p.offset for p in held])[of] - begins[of]
    return {
        "_row": np.array([p.row for p in held], np.int64)[of],
        "_at": place + shift,
        "_low": low + shift,
        "_high": high + shift,
        "_gram": gram[place].view(np.int64),
        "_span": mixed(span).view(np.int64),
    }


_ANCHORS = "_row bigint, _at bigint, _low bigint, _high bigint, _gram bigint, _span bigint"


def _find_anchors(rows: DataFrame) -> DataFrame:
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                for held in pieces(part.column(0).to_pylist(), part.column(1).cast(pa.binary()).to_pylist()):
                    found = anchors(held)
                    if found:
                        yield pa.RecordBatch.from_pydict({k: pa.array(v) for k, v in found.items()})

    return rows.mapInArrow(find, _ANCHORS)


def _repeated(df: DataFrame, *keys: str) -> DataFrame:
    """Keys of more than one row; equal rows are combined before the shuffle. They are stored, so that the join back deals
    out its rows anew and can split those of a frequent key."""
    return stored(df.groupBy(*keys).agg(F.count("*").alias("_times")).filter("_times > 1").drop("_times"), "repeated-keys")


def _undecided_texts(rows: DataFrame, undecided: DataFrame) -> DataFrame:
    """The undecided anchors with the text that their starts span, as ``_snip`` from ``_low`` on."""
    per_row = undecided.groupBy("_row").agg(F.collect_list(F.struct("_at", "_low", "_high", "_gram")).alias("_anchors"))
    met = rows.join(per_row, "_row").select("_row", "_text", "_anchors")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row, text = batch.column(0)[i].as_py(), batch.column(1).slice(i, 1).cast(pa.binary())[0].as_py()
                own = batch.column(2)[i].as_py()
                for at in range(0, len(own), 4096):
                    some = own[at : at + 4096]
                    yield pa.RecordBatch.from_pydict(
                        {
                            "_row": pa.array([row] * len(some), pa.int64()),
                            **{k: pa.array([a[k] for a in some], pa.int64()) for k in ("_at", "_low", "_high", "_gram")},
                            "_snip": pa.array([text[a["_low"] : a["_high"] + LENGTH] for a in some], pa.binary()),
                        }
                    )

    return met.mapInArrow(cut, "_row bigint, _at bigint, _low bigint, _high bigint, _gram bigint, _snip binary")


def _groups(snips: DataFrame, width: int) -> DataFrame:
    """Starts of each row of ``snips`` in groups of neighbours, cut at multiples of ``width`` before the anchor.

    ``_from, _to`` first and last start; ``_cell`` number of the group, ``_core`` hash of what the strings of a whole
    group share, ``_span`` hash of what these strings span together.
    """

    def group(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 2048):
                part = batch.slice(start, 2048)
                row, at, low, high, gram = (part.column(i).to_numpy(zero_copy_only=False) for i in range(5))
                snips = part.column(5).to_pylist()
                hashes = Hashes(np.frombuffer(b"".join(snips), np.uint8))
                sizes = np.array([len(s) for s in snips])
                shift = np.cumsum(sizes) - sizes - low
                near, far = (at - high) // width, (at - low) // width
                n = far - near + 1
                of = np.repeat(np.arange(len(row)), n)
                cell = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + near[of]
                begin = np.maximum(low[of], at[of] - (cell + 1) * width + 1)
                end = np.minimum(high[of], at[of] - cell * width)
                # from the latest start that a whole group has to the end of its earliest string
                core = hashes.of(at[of] - cell * width + shift[of], at[of] - (cell + 1) * width + 1 + LENGTH + shift[of])
                with np.errstate(over="ignore"):
                    edges = (at[of] - begin).astype(np.uint64) * np.uint64(256) + (at[of] - end).astype(np.uint64)
                    span = mixed(hashes.of(begin + shift[of], end + LENGTH + shift[of]) + mixed(edges, 22))
                columns = {"_row": row[of], "_at": at[of], "_gram": gram[of], "_cell": cell, "_from": begin, "_to": end}
                columns |= {"_core": core.view(np.int64), "_span": span.view(np.int64)}
                yield pa.RecordBatch.from_pydict({k: pa.array(v) for k, v in columns.items()})

    made = "_row bigint, _at bigint, _gram bigint, _cell bigint, _from bigint, _to bigint, _core bigint, _span bigint"
    return snips.select("_row", "_at", "_low", "_high", "_gram", "_snip").mapInArrow(group, made)


def _flagged(df: DataFrame, keys: list[str], flag: str) -> DataFrame:
    return df.join(_repeated(df, *keys).withColumn(flag, F.lit(True)), keys, "left").withColumn(flag, F.col(flag).isNotNull())


def _with_twins(df: DataFrame, keys: list[str]) -> DataFrame:
    """The undecided rows, and of the decided ones that they may still be equal to in part one of each kind."""
    undecided = df.filter(~F.col("_all"))
    asked = stored(undecided.select(*keys).distinct(), "asked-keys")
    twins = df.filter("_all").join(asked, keys, "left_semi").dropDuplicates(["_gram", "_span"])
    return undecided.unionByName(twins)


def repeated_starts(rows: DataFrame) -> DataFrame:
    """``_row, _from, _to``: ranges of starts of strings that occur more than once."""
    found = _find_anchors(rows)
    named = stored(found.join(_repeated(found.select("_gram"), "_gram"), "_gram"), "anchors")
    named = stored(_flagged(named, ["_gram", "_span"], "_all"), "anchors-named")
    done = named.filter("_all").select("_row", F.col("_low").alias("_from"), F.col("_high").alias("_to"))
    snips = stored(_undecided_texts(rows, _with_twins(named, ["_gram"])), "undecided")

    groups = stored(_groups(snips, GROUP), "groups")
    groups = groups.join(_repeated(groups, "_gram", "_cell", "_core"), ["_gram", "_cell", "_core"])
    groups = stored(_flagged(groups, ["_gram", "_span"], "_all"), "groups-named")
    done = done.unionByName(groups.filter("_all").select("_row", "_from", "_to"))

    rest = _with_twins(groups, ["_gram", "_cell", "_core"]).select("_row", "_at", "_from", "_to")
    rest = rest.join(snips.select("_row", "_at", "_low", "_gram", "_snip"), ["_row", "_at"])
    # an anchor at the border of two pieces has a row in each: only the one that holds the group counts
    rest = rest.filter((F.col("_low") <= F.col("_from")) & (F.col("_to") + LENGTH <= F.col("_low") + F.length("_snip")))
    cut = F.substring(F.col("_snip"), (F.col("_from") - F.col("_low") + 1).cast("int"), (F.col("_to") - F.col("_from") + LENGTH).cast("int"))
    single = _groups(rest.select("_row", "_at", F.col("_from").alias("_low"), F.col("_to").alias("_high"), "_gram", cut.alias("_snip")), 1)
    single = stored(single.select("_row", "_gram", "_cell", "_core", "_from", "_to"), "strings")
    single = single.join(_repeated(single, "_gram", "_cell", "_core"), ["_gram", "_cell", "_core"])
    return done.unionByName(single.select("_row", "_from", "_to"))


def remove_repeats(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per input row: ``<id_column>, n_bytes, n_removed, n_spans, spans, kept``.

    ``spans`` are the maximal removed runs as ``start, stop`` in bytes of UTF-8, ``kept`` the other bytes in order (binary:
    a run may end within a character). Null and empty texts and those under ``LENGTH`` bytes lose nothing. Null ids and
    repeated rows stay rows of their own, and a repeated row's text is a repetition; other columns are not read; an empty
    table gives an empty result. The table is read more than once and rows are told apart by their place in it, so
    ``docs`` must come from stored data.
    """
    id_type = docs.schema[id_column].dataType.simpleString()
    rows = docs.select(
        F.monotonically_increasing_id().alias("_row"),
        F.coalesce(F.col(text_column), F.lit("")).alias("_text"),
        F.col(id_column).alias("_id"),
    )
    ranges = repeated_starts(rows.select("_row", "_text"))
    ranges = ranges.groupBy("_row").agg(F.collect_list("_from").alias("_from"), F.collect_list("_to").alias("_to"))
    met = rows.join(ranges, "_row", "left").select("_id", "_text", "_from", "_to")
    span = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                texts = part.column(1).cast(pa.binary()).to_pylist()
                kept, spans = [], []
                for i, text in enumerate(texts):
                    first = part.column(2)[i].values
                    if first is None or not len(text):
                        kept.append(text)
                        spans.append([])
                        continue
                    first, last = (np.asarray(c[i].values) for c in (part.column(2), part.column(3)))
                    order = np.argsort(first, kind="stable")
                    begin, end = first[order], np.maximum.accumulate(last[order] + LENGTH)
                    new = np.concatenate([[True], begin[1:] > end[:-1]])
                    begin, end = begin[new], end[np.concatenate([np.flatnonzero(new)[1:] - 1, [len(end) - 1]])]
                    spans.append([{"start": a, "stop": b} for a, b in zip(begin.tolist(), end.tolist(), strict=True)])
                    keep = np.concatenate([[0], end]), np.concatenate([begin, [len(text)]])
                    kept.append(b"".join(text[a:b] for a, b in zip(*(k.tolist() for k in keep), strict=True)))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array([len(t) for t in texts], pa.int64()),
                        pa.array([len(t) - len(k) for t, k in zip(texts, kept, strict=True)], pa.int64()),
                        pa.array([len(s) for s in spans], pa.int64()),
                        pa.array(spans, span),
                        pa.array(kept, pa.binary()),
                    ],
                    names=["_id", "n_bytes", "n_removed", "n_spans", "spans", "kept"],
                )

    made = f"_id {id_type}, n_bytes bigint, n_removed bigint, n_spans bigint, spans array<struct<start: bigint, stop: bigint>>, kept binary"
    return met.mapInArrow(remove, made).withColumnRenamed("_id", id_column)
