"""Bigram language model in a log-frequency Bloom filter.

The filter holds no counts but events: an n-gram of quantised count q is inserted as (n-gram, 1) to (n-gram, q). A count
is read by probing level after level until one is missing, and stands for the least count of its level.

The probability of a word after a history is (b * p * pair + PRIOR * lower) / (history + PRIOR). ``pair`` is the probed count
of the two, ``history`` the largest count of the history's level, ``lower`` the word's smoothed share of the corpus. ``p`` is
the probability that a pair of that level is there and no false positive, from the rate of these and from how often the
word would follow by chance; ``b`` takes off what false positives still add over all words. As pairs are rounded down and
histories up, and the lower order adds up to one with an unseen token, the probabilities after a history add up to one or
somewhat less.

The filter is cut by key into segments, each as large as its own events need, so all levels are kept at every
size. A filter of up to ``SHARED_BITS`` is sent to every worker; from a larger one nothing is sent, and the n-grams of the
texts travel to their segments and the levels back. Both ways give the same scores.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliomill.llm.components import stored
from foliomill.llm.sizes import sized_batches
from foliomill.llm.words import mixed, word_hashes

END = np.uint64(0x5BD1E995C0FFEE01)  # key of the end of a text, counted as a token
START = np.uint64(0x27D4EB2F165667C5)  # key of the place before the first word, only a history
_PAIR = np.uint64(0x9FB21C651E98DF25)

SHARED_BITS = 1 << 30  # 128 MB: up to this size the filter is sent to every worker
BITS_PER_EVENT = 7
HASHES = 5
UNIT_BYTES = 1 << 22  # texts whose n-grams travel together to the segments of a larger filter
SEGMENT_TOKENS = 1 << 21  # tokens of the corpus per segment whose n-grams one task counts
HEAVY_TOKENS = 1 << 20  # most tokens that are sent to every worker with exact counts
FLUSH = 3 << 20  # n-grams that a task combines before it passes them on
PRIOR = 3.0  # weight of the lower order, in occurrences of the history
_LOW = np.uint64((1 << 48) - 1)


class Shape(NamedTuple):
    """Addresses in the filter. A key's top bits are its segment, which has its own range of bytes."""

    segment_bits: int
    edges: np.ndarray  # byte at which each segment begins, and the end of the last

    def segments(self, keys: np.ndarray) -> np.ndarray:
        return segments_of(keys, self.segment_bits)


class Model(NamedTuple):
    n_tokens: int
    n_types: int
    types: dict[int, int]  # number of tokens of each level
    shape: Shape
    cuts: tuple[int, int]  # lowest level kept for single tokens and for bigrams, 1 unless a bound was asked for
    shared: Broadcast  # filter or, if that is too large, None; heavy keys, their exact counts
    unigrams: DataFrame
    filters: DataFrame  # _segment, _bits


def segments_of(keys: np.ndarray, segment_bits: int) -> np.ndarray:
    return (keys >> np.uint64(64 - segment_bits)) if segment_bits else np.zeros(len(keys), np.uint64)


def bits_for(events: int) -> int:
    """Bits of a filter, in whole bytes."""
    return -(-events * BITS_PER_EVENT // 8) * 8


def false_rate() -> float:
    """Share of the n-grams that were never inserted and are found on a level all the same."""
    return (1 - np.exp(-HASHES / BITS_PER_EVENT)) ** HASHES


def places(segments: np.ndarray, low: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
    """First place of each key's event, as a part of 2^64, and the step to the next one."""
    with np.errstate(over="ignore"):
        own = mixed(low + segments * _PAIR, level)
        return own, mixed(own, 101) | np.uint64(1)


def bit_of(own: np.ndarray, sizes: np.ndarray | np.uint64) -> np.ndarray:
    """Bit in a segment of ``sizes`` bits, fewer than 2^32."""
    return (own >> np.uint64(32)) * sizes >> np.uint64(32)


def held_out(id_column: str) -> Column:
    """Texts that the model doesn't learn from: a remainder of the id's checksum. A null id is not held out."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string")) % 7 == 2, F.lit(False))


def token_keys(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys of all tokens with the end of each text, keys of the tokens before them, tokens of each text."""
    hashes, counts = word_hashes(texts)
    counts = counts + 1
    stops = np.cumsum(counts)
    keys = np.empty(int(stops[-1]) if len(stops) else 0, np.uint64)
    is_end = np.zeros(len(keys), bool)
    is_end[stops - 1] = True
    keys[~is_end], keys[is_end] = hashes, END
    before = np.empty_like(keys)
    before[1:] = keys[:-1]
    before[stops - counts] = START
    return keys, before, counts


def pair_keys(before: np.ndarray, keys: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mixed(before * _PAIR + keys, 3)


def levels(counts: np.ndarray) -> np.ndarray:
    """Quantised count: 1, 2, 3, then two levels an octave, from its power of two and from one and a half times that."""
    octave = np.frexp(counts.astype(np.float64))[1].astype(np.int64) - 1
    return np.maximum(1, 2 * octave + (2 * counts >= 3 * np.exp2(octave)))


def count_of(level: np.ndarray) -> np.ndarray:
    """Least count of a level, 0 for none."""
    octave = np.exp2(level // 2)
    return np.where(level <= 1, level, np.where(level % 2, 1.5 * octave, octave)).astype(np.float64)


def most_of(level: np.ndarray) -> np.ndarray:
    """Largest count of a level, 0 for none."""
    return np.where(level > 0, count_of(level + 1) - 1, 0.0)


def _level(n: Column) -> Column:
    octave = F.length(F.bin(n)) - 1
    return F.greatest(F.lit(1), 2 * octave + (2 * n >= 3 * F.pow(F.lit(2.0), octave)).cast("int"))


def _flushed(batches: Iterator[pa.RecordBatch], take) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Distinct keys with their counts, each time that enough have been gathered."""
    held: list[np.ndarray] = []
    size = 0
    for batch in batches:
        for part in sized_batches(batch, 0):
            keys = take(part.column(0).cast(pa.binary()).to_pylist())
            held.append(keys)
            size += len(keys)
            if size >= FLUSH:
                yield np.unique(np.concatenate(held), return_counts=True)
                held, size = [], 0
    if held:
        yield np.unique(np.concatenate(held), return_counts=True)


def _with_start(texts: list[bytes]) -> np.ndarray:
    return np.concatenate([token_keys(texts)[0], np.repeat(START, len(texts))])


def count_tokens(texts: DataFrame) -> DataFrame:
    """``_key, _n``: exact counts of all tokens of ``_text``, and of the starts, combined in the tasks before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, n in _flushed(batches, _with_start):
            yield pa.record_batch([pa.array(keys.view(np.int64)), pa.array(n)], names=["_key", "_n"])

    return texts.mapInArrow(count, "_key bigint, _n bigint").groupBy("_key").agg(F.sum("_n").alias("_n"))


def _by_segment(keys: np.ndarray, segment_bits: int) -> tuple[np.ndarray, list[int], np.ndarray]:
    """Segments of sorted keys, where each segment begins with the end of the last, and the low 48 bits of each key."""
    segments = segments_of(keys, segment_bits)
    cut = np.flatnonzero(np.diff(segments.astype(np.int64), prepend=-1)).tolist() + [len(keys)]
    return segments, cut, np.ascontiguousarray(keys).view(np.uint8).reshape(-1, 8)[:, :6]


def _unpacked(packed: list[bytes]) -> np.ndarray:
    low = np.zeros((sum(map(len, packed)) // 6, 8), np.uint8)
    low[:, :6] = np.frombuffer(b"".join(packed), np.uint8).reshape(-1, 6)
    return low.view(np.uint64)[:, 0]


def _packed(keys: np.ndarray, counts: np.ndarray, order: int, segment_bits: int) -> Iterator[pa.RecordBatch]:
    """A row per segment of sorted distinct keys: the low 48 bits of each, and the counts."""
    segments, cut, low = _by_segment(keys, segment_bits)
    counts = np.minimum(counts, 2**32 - 1).astype(np.uint32)
    for at in range(0, len(cut) - 1, 64):
        edges = list(zip(cut[at : at + 64], cut[at + 1 : at + 65], strict=False))
        yield pa.record_batch(
            [
                pa.array(segments[[a for a, _ in edges]].astype(np.int64)),
                pa.array([order] * len(edges), pa.int32()),
                pa.array([low[a:b].tobytes() for a, b in edges], pa.binary()),
                pa.array([counts[a:b].tobytes() for a, b in edges], pa.binary()),
            ],
            names=["_segment", "_order", "_keys", "_counts"],
        )


_PACKED = "_segment bigint, _order int, _keys binary, _counts binary"


def _pair_segments(texts: DataFrame, segment_bits: int) -> DataFrame:
    def pairs(batch: list[bytes]) -> np.ndarray:
        keys, before, _ = token_keys(batch)
        return pair_keys(before, keys)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, n in _flushed(batches, pairs):
            yield from _packed(keys, n, 2, segment_bits)

    return texts.mapInArrow(pack, _PACKED)


def _token_segments(unigrams: DataFrame, segment_bits: int) -> DataFrame:
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            order = np.argsort(keys)
            yield from _packed(keys[order], batch.column(1).to_numpy(zero_copy_only=False)[order], 1, segment_bits)

    return unigrams.select("_key", "_n").mapInArrow(pack, _PACKED)


def _filters(packed: DataFrame, cuts: tuple[int, int]) -> DataFrame:
    """``_segment, _bits``: count the n-grams of each segment and insert their events into a filter of the size they need.

    An n-gram has at most as many events as occurrences, so a segment's filter is bounded by its share of the tokens.
    """

    def insert(table: pa.Table) -> pa.Table:
        segment = table.column("_segment")[0].as_py()
        order = np.array(table.column("_order").to_pylist())
        keys, counts = table.column("_keys").to_pylist(), table.column("_counts").to_pylist()
        counted = []
        for n in (1, 2):
            own = np.flatnonzero(order == n)
            if len(own):
                found, where = np.unique(_unpacked([keys[i] for i in own]), return_inverse=True)
                total = np.bincount(where, np.frombuffer(b"".join(counts[i] for i in own), np.uint32))
                counted.append((found, levels(total), cuts[n - 1]))
        events = sum(int(np.maximum(top - cut + 1, 0).sum()) for _, top, cut in counted)
        bits = np.zeros(bits_for(events) // 8, np.uint8)
        for found, top, cut in counted:
            for level in range(cut, int(top.max()) + 1):
                there = found[top >= level]
                own, step = places(np.full(len(there), segment, np.uint64), there, level)
                for _ in range(HASHES):
                    place = bit_of(own, np.uint64(8 * len(bits)))
                    np.bitwise_or.at(bits, (place >> np.uint64(3)).astype(np.int64), np.uint8(1) << (place & np.uint64(7)).astype(np.uint8))
                    own += step
        return pa.table({"_segment": pa.array([segment], pa.int64()), "_bits": pa.array([bits.tobytes()], pa.binary())})

    return packed.groupBy("_segment").applyInArrow(insert, "_segment bigint, _bits binary")


def _lowest_level(events: dict[int, int], capacity: int) -> int:
    """Smallest level from which on all events fit; ``events`` has the number of n-grams of each level."""
    cut = 1
    while sum(n * (level - cut + 1) for level, n in events.items() if level >= cut) > capacity:
        cut += 1
    return cut


def learn(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", filter_bits: int | None = None) -> Model:
    """Count all tokens and bigrams of the rows that aren't held out and build the filter.

    Single tokens are counted exactly and stored. The filter keeps all counts, unless ``filter_bits`` asks for a pruned
    model: then the lowest levels that might not fit are left out. What reaches the driver is bounded: the filter if it has
    at most ``SHARED_BITS``, a number per segment, and the exact counts of tokens that make up at least one part in
    ``HEAVY_TOKENS`` of the corpus, of which there are not more.
    """
    spark = docs.sparkSession
    texts = docs.filter(~held_out(id_column)).select(F.coalesce(F.col(text_column), F.lit("")).alias("_text"))
    unigrams = stored(count_tokens(texts), "token-counts")
    start = int(START.astype(np.int64))
    words = unigrams.filter(F.col("_key") != start)
    n_tokens, n_types = words.agg(F.coalesce(F.sum("_n"), F.lit(0)), F.count("*")).first()
    by_level = {r.l: r["count"] for r in unigrams.groupBy(_level(F.col("_n")).alias("l")).count().collect()}
    types = {r.l: r["count"] for r in words.groupBy(_level(F.col("_n")).alias("l")).count().collect()}
    first = second = 1
    if filter_bits is not None:
        capacity = filter_bits // BITS_PER_EVENT
        first = _lowest_level(by_level, capacity // 4)
        # with levels half an octave apart, fewer events than this lie on a level or above
        while 3.5 * n_tokens / count_of(np.array(second)) > capacity * 3 // 4:
            second += 1
    segment_bits = max(0, (n_tokens // SEGMENT_TOKENS).bit_length())
    packed = _pair_segments(texts, segment_bits).unionByName(_token_segments(unigrams, segment_bits))
    filters = stored(_filters(packed, (first, second)), "filter-segments")
    sizes = np.zeros(1 << segment_bits, np.int64)
    for segment, size in filters.select("_segment", F.length("_bits")).toLocalIterator():
        sizes[segment] = size
    shape = Shape(segment_bits, np.concatenate([[0], np.cumsum(sizes)]))
    data = None
    if 8 * sizes.sum() <= SHARED_BITS:
        data = np.zeros(sizes.sum(), np.uint8)
        for row in filters.toLocalIterator():
            at = shape.edges[row["_segment"]]
            data[at : at + len(row["_bits"])] = np.frombuffer(row["_bits"], np.uint8)
    heavy = words.filter(F.col("_n") > n_tokens / HEAVY_TOKENS).toPandas().sort_values("_key")
    shared = spark.sparkContext.broadcast((data, heavy["_key"].to_numpy(np.int64), heavy["_n"].to_numpy(np.int64)))
    return Model(n_tokens, n_types, types, shape, (first, second), shared, unigrams, filters)


def probe(data: np.ndarray, shape: Shape, keys: np.ndarray, cut: int) -> np.ndarray:
    """Levels of keys in the filter; 0 where even the lowest is missing."""
    segments = shape.segments(keys)
    begin = shape.edges[segments.astype(np.int64)]
    size = shape.edges[segments.astype(np.int64) + 1] - begin
    return _probe(data, segments, keys & _LOW, (8 * begin).astype(np.uint64), (8 * size).astype(np.uint64), cut)


def _probe(data: np.ndarray, segments: np.ndarray, low: np.ndarray, base: np.ndarray, sizes: np.ndarray, cut: int) -> np.ndarray:
    """Levels, one after another; a key that misses one of a level's bits is not asked for the others."""
    found = np.zeros(len(low), np.int64)
    live, level = np.flatnonzero(sizes), cut
    while len(live) and level <= 127:
        own, step = places(segments[live], low[live], level)
        for _ in range(HASHES):
            at = base[live] + bit_of(own, sizes[live])
            there = (data[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
            live, own, step = live[there], own[there], step[there]
            own = own + step
        found[live] = level
        level += 1
    return found


class Ngrams(NamedTuple):
    """Sorted distinct keys of the single tokens and the bigrams of some texts, and where each token's are among them."""

    singles: np.ndarray
    own: np.ndarray
    history: np.ndarray
    pairs: np.ndarray
    both: np.ndarray


def ngrams(keys: np.ndarray, before: np.ndarray) -> Ngrams:
    singles, at = np.unique(np.concatenate([keys, before]), return_inverse=True)
    pairs, both = np.unique(pair_keys(before, keys), return_inverse=True)
    return Ngrams(singles, at[: len(keys)], at[len(keys) :], pairs, both)


def mass_of(types: dict[int, int]) -> float:
    """What the lower order is divided by: the tokens' counts as the filter has them, raised by false positives now and
    then, one for each type and one for all others."""
    rate, raised = false_rate(), np.arange(8)
    chance = rate**raised * (1 - rate)
    return 1 + sum(n * (float((chance * count_of(level + raised)).sum()) + 1) for level, n in types.items())


def true_share(level: np.ndarray, by_chance: np.ndarray) -> np.ndarray:
    """Probability that a pair found on a level was inserted there, if it is expected ``by_chance`` times."""
    there = -np.expm1(-by_chance)
    return there / (there + false_rate() ** np.maximum(level, 1) * (1 - there) + 1e-300)


def false_mass(after: np.ndarray, types: dict[int, int]) -> np.ndarray:
    """Count that false positives add to a history of each size over the whole vocabulary, after ``true_share``."""
    rate, mass = false_rate(), mass_of(types)
    total = np.zeros(len(after))
    for own, n in types.items():
        by_chance = after * (float(count_of(np.array(own))) + 1) / mass
        for level in range(1, 7):
            found = n * np.exp(-by_chance) * rate**level * (1 - rate)
            # a pair is held to be no more frequent than the word
            count = np.minimum(count_of(np.array(level)), most_of(np.array(own)))
            total += found * true_share(np.array(level), by_chance) * np.minimum(count, after)
    return total


def log_probabilities(grams: Ngrams, singles: np.ndarray, pairs: np.ndarray, types: dict[int, int]) -> np.ndarray:
    """log10 probability of each token after the one before it, from the probed levels of single tokens and bigrams only."""
    own, history, level = singles[grams.own], singles[grams.history], pairs[grams.both]
    after = most_of(history)
    # a pair is no more frequent than its parts, and not there if one of them isn't
    both = np.minimum(np.minimum(count_of(level), most_of(own)), after)
    lower = (count_of(own) + 1) / mass_of(types)
    levels_after = np.arange(int(singles.max(initial=0)) + 1)
    sizes = most_of(levels_after)
    kept = np.divide(sizes, sizes + false_mass(sizes, types), out=np.zeros(len(sizes)), where=sizes > 0)
    both = both * kept[history] * true_share(level, after * lower)
    return np.log10((both + PRIOR * lower) / (after + PRIOR))


def _sent(rows: DataFrame, segment_bits: int, id_type: str) -> DataFrame:
    """Texts in units, and the n-grams of each unit packed by segment; ``_to`` is the segment, or negative for a unit.

    A unit is named by its first row. ``_order`` is 0 for a text, 1 for single tokens and 2 for bigrams.
    """

    def unit(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = parts[0].column(1)[0].as_py()
        for part in parts:
            n = part.num_rows
            yield pa.record_batch(
                [
                    pa.array([-1 - name] * n, pa.int64()),
                    pa.array([name] * n, pa.int64()),
                    pa.array([0] * n, pa.int32()),
                    part.column(0).cast(pa.binary()),
                    part.column(1),
                    part.column(2),
                ],
                names=names,
            )
        texts = [t for part in parts for t in part.column(0).cast(pa.binary()).to_pylist()]
        grams = ngrams(*token_keys(texts)[:2])
        for order, keys in ((1, grams.singles), (2, grams.pairs)):
            segments, cut, low = _by_segment(keys, segment_bits)
            n = len(cut) - 1
            yield pa.record_batch(
                [
                    pa.array(segments[cut[:-1]].astype(np.int64)),
                    pa.array([name] * n, pa.int64()),
                    pa.array([order] * n, pa.int32()),
                    pa.array([low[a:b].tobytes() for a, b in zip(cut, cut[1:], strict=False)], pa.binary()),
                    pa.nulls(n, pa.int64()),
                    pa.nulls(n, parts[0].column(2).type),
                ],
                names=names,
            )

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            for part in sized_batches(batch, 0):
                more = pc.sum(pc.binary_length(part.column(0))).as_py()
                if held and size + more > UNIT_BYTES:
                    yield from unit(held)
                    held, size = [], 0
                held.append(part)
                size += more
        if held:
            yield from unit(held)

    names = ["_to", "_unit", "_order", "_data", "_row", "_id"]
    return rows.mapInArrow(send, f"_to bigint, _unit bigint, _order int, _data binary, _row bigint, _id {id_type}")


def _answered(sent: DataFrame, filters: DataFrame, cuts: tuple[int, int]) -> DataFrame:
    """``sent`` with a byte per n-gram, its level, in place of the n-grams, and ``_from``, the segment; texts stay."""
    filters = filters.select(
        F.col("_segment").alias("_to"),
        F.lit(None).cast("bigint").alias("_unit"),
        F.lit(3).alias("_order"),
        F.col("_bits").alias("_data"),
        F.lit(None).cast("bigint").alias("_row"),
        F.lit(None).cast(sent.schema["_id"].dataType).alias("_id"),
    )

    def answer(table: pa.Table) -> pa.Table:
        segment = table.column("_to")[0].as_py()
        order = table.column("_order").to_numpy()
        if segment >= 0:
            packed = table.column("_data").to_pylist()
            data = np.frombuffer(b"".join(packed[i] for i in np.flatnonzero(order == 3)), np.uint8)
            for n in (1, 2):
                own = np.flatnonzero(order == n)
                low = _unpacked([packed[i] for i in own])
                sizes = np.full(len(low), 8 * len(data), np.uint64)
                found = _probe(data, np.full(len(low), segment, np.uint64), low, np.zeros(len(low), np.uint64), sizes, cuts[n - 1])
                found, at = found.astype(np.uint8).tobytes(), 0
                for i in own:
                    size = len(packed[i]) // 6
                    packed[i], at = found[at : at + size], at + size
            kept = np.flatnonzero(order < 3)
            table = table.set_column(3, "_data", pa.array(packed, pa.binary())).take(pa.array(kept))
        return table.rename_columns(["_from", "_unit", "_order", "_data", "_row", "_id"])

    id_type = sent.schema["_id"].dataType.simpleString()
    made = f"_from bigint, _unit bigint, _order int, _data binary, _row bigint, _id {id_type}"
    return sent.unionByName(filters).groupBy("_to").applyInArrow(answer, made)


def score_texts(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per input row: ``<id_column>, held_out, n_tokens, n_known, train_tokens, base_score, score``.

    ``score`` comes from the filter alone; ``n_known`` and ``base_score`` from exact counts: the heavy tokens' are at hand,
    the others', of which none is frequent, are joined per text and token. Null and empty texts have one token, the end.
    Null ids and repeated rows stay rows of their own; other columns are not read; an empty table gives an empty result.
    """
    id_type = docs.schema[id_column].dataType.simpleString()
    shape, cuts, n_tokens, n_types, shared = model.shape, model.cuts, model.n_tokens, model.n_types, model.shared
    types = model.types
    rows = docs.select(
        F.coalesce(F.col(text_column), F.lit("")).alias("_text"),
        F.monotonically_increasing_id().alias("_row"),
        F.col(id_column).alias("_id"),
    )
    names = ["_row", "_key", "_tf", "_id", "_tokens", "_known", "_base", "_score"]

    def summed(row: np.ndarray, ids: pa.Array, tokens: tuple, grams: Ngrams, found: tuple) -> Iterator[pa.RecordBatch]:
        """Rows of some texts, and of each text's tokens that are not at hand, from the levels of their n-grams."""
        _, heavy, heavy_counts = shared.value
        keys, _, counts = tokens
        starts = np.cumsum(counts) - counts
        total = np.add.reduceat(log_probabilities(grams, *found, types), starts)
        at = np.minimum(np.searchsorted(heavy, keys.view(np.int64)), max(0, len(heavy) - 1))
        at_hand = heavy[at] == keys.view(np.int64) if len(heavy) else np.zeros(len(keys), bool)
        exact = np.log10(np.where(at_hand, heavy_counts[at] + 1, 1)) if len(heavy) else np.zeros(len(keys))
        yield pa.record_batch(
            [
                pa.array(row),
                # a key that meets no count, so that these rows spread evenly
                pa.array(mixed(row.view(np.uint64), 77).view(np.int64)),
                pa.nulls(len(row), pa.int64()),
                ids,
                pa.array(counts.astype(np.int64)),
                pa.array(np.add.reduceat(at_hand.astype(np.int64), starts)),
                pa.array(np.add.reduceat(exact, starts)),
                pa.array(total),
            ],
            names=names,
        )
        rare = np.flatnonzero(~at_hand)
        words, word = np.unique(keys[rare], return_inverse=True)
        of = np.repeat(np.arange(len(row)), counts)[rare]
        both, times = np.unique(of * max(1, len(words)) + word, return_counts=True)
        size = len(both)
        none = [pa.nulls(size, ids.type), *(pa.nulls(size, t) for t in (pa.int64(), pa.int64(), pa.float64(), pa.float64()))]
        yield pa.record_batch(
            [
                pa.array(row[both // max(1, len(words))]),
                pa.array(words[both % max(1, len(words))].view(np.int64) if size else np.zeros(0, np.int64)),
                pa.array(times.astype(np.int64)),
                *none,
            ],
            names=names,
        )

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        data = shared.value[0]
        for batch in batches:
            for part in sized_batches(batch, 0):
                tokens = token_keys(part.column(0).cast(pa.binary()).to_pylist())
                grams = ngrams(*tokens[:2])
                found = (probe(data, shape, grams.singles, cuts[0]), probe(data, shape, grams.pairs, cuts[1]))
                yield from summed(part.column(1).to_numpy(zero_copy_only=False), part.column(2), tokens, grams, found)

    def finish(table: pa.Table) -> pa.Table:
        order = table.column("_order").to_numpy()
        texts = table.take(pa.array(np.flatnonzero(order == 0)))
        tokens = token_keys(texts.column("_data").to_pylist())
        grams = ngrams(*tokens[:2])
        answers, segments = table.column("_data").to_pylist(), table.column("_from").to_numpy()
        found = []
        for n in (1, 2):  # keys in order are segments in order
            own = np.flatnonzero(order == n)
            own = own[np.argsort(segments[own])]
            found.append(np.frombuffer(b"".join(answers[i] for i in own), np.uint8).astype(np.int64))
        ids = pa.concat_arrays(texts.column("_id").chunks)
        return pa.Table.from_batches(summed(texts.column("_row").to_numpy(), ids, tokens, grams, tuple(found)))

    made = f"_row bigint, _key bigint, _tf bigint, _id {id_type}, _tokens bigint, _known bigint, _base double, _score double"
    if shared.value[0] is not None:
        scored = rows.mapInArrow(score, made)
    else:
        sent = _sent(rows, shape.segment_bits, id_type)
        scored = _answered(sent, model.filters, cuts).groupBy("_unit").applyInArrow(finish, made)
    found = scored.join(model.unigrams, "_key", "left")
    known = F.when(F.col("_tf").isNotNull() & F.col("_n").isNotNull(), F.col("_tf"))
    found = found.groupBy("_row").agg(
        F.max("_id").alias("_id"),
        F.max("_tokens").alias("n_tokens"),
        (F.max("_known") + F.coalesce(F.sum(known), F.lit(0))).alias("n_known"),
        (F.max("_base") + F.coalesce(F.sum(known * F.log10(F.col("_n") + 1)), F.lit(0.0))).alias("_base"),
        F.max("_score").alias("score"),
    )
    per_token = float(np.log10(n_tokens + n_types + 1))
    return found.select(
        F.col("_id").alias(id_column),
        held_out("_id").alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(n_tokens).cast("bigint").alias("train_tokens"),
        (F.col("_base") - F.col("n_tokens") * per_token).alias("base_score"),
        "score",
    )
