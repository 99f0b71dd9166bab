"""Near duplicates: one-permutation hashing with optimal densification, banded buckets, star-shaped candidate links.

A text is its set of five-word shingles. One hash function deals the shingles over bins and the least of each bin is
kept; an empty bin takes over the value of the first filled bin in an order of its own, the same for all texts. Four
bins make a band, equal bands a bucket. Two sets that are similar enough share no bucket with a probability of at most
(1 - 0.75^4)^32, five in a million; nothing else is left to chance.

Within a bucket only links from one member to all others are tested, on the full sets, and then from the most frequent
component of the bucket to each other one. As such stars may miss a link between two of the others, members of buckets
that are still not connected are compared by their rarest shingles: in an order common to all, two linked sets share one
of the first seventh of the smaller and the first quarter of the larger set, and not too late to leave room for the rest.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliomill.llm.components import LINKS, ROWS, merged, stored, with_labels
from foliomill.llm.sizes import BATCH_ROWS, small_batches
from foliomill.llm.words import mixed, shingle_sets

WORDS = 5
SIMILAR = (75, 100)
BINS = 128
ROWS_PER_BAND = 4
BANDS = BINS // ROWS_PER_BAND
HUB_ROUNDS = 1
HEAD = 16  # of the shingles before one, those by which a pair is known to have met already
_BIN_SHIFT = np.uint64(64 - (BINS - 1).bit_length())
#: Order in which an empty bin looks at the others.
_DETOURS = np.argsort(np.random.default_rng(19).random((BINS, BINS)), axis=1)
_BAND_SALTS = mixed(np.arange(BANDS, dtype=np.uint64), 5)


def signature(shingles: np.ndarray) -> np.ndarray:
    """Least hash of each bin of a sorted set, empty bins filled from others. The top bits of a hash are its bin."""
    bins = (shingles >> _BIN_SHIFT).astype(np.int64)
    first = np.flatnonzero(np.diff(bins, prepend=-1))
    out, filled = np.zeros(BINS, np.uint64), np.zeros(BINS, bool)
    out[bins[first]] = shingles[first]
    filled[bins[first]] = True
    if len(first) < BINS:
        empty = np.flatnonzero(~filled)
        detours = _DETOURS[empty]
        out[empty] = out[detours[np.arange(len(empty)), filled[detours].argmax(1)]]
    return out


def bands(values: np.ndarray) -> np.ndarray:
    """A key for every band of a signature."""
    with np.errstate(over="ignore"):
        key = _BAND_SALTS.copy()
        for column in values.reshape(BANDS, ROWS_PER_BAND).T:
            key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + column)
    return key


def set_key(shingles: np.ndarray) -> tuple[int, int]:
    """Two 64-bit sums that identify a set."""
    return tuple(int(mixed(shingles, salt).sum(dtype=np.uint64).astype(np.int64)) for salt in (11, 13))


def _signatures(rows: DataFrame, id_type: str) -> DataFrame:
    """``_id, _n, _s1, _s2, _bands``."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in small_batches(batch, BATCH_ROWS):
                sets = shingle_sets(part.column(1).cast(pa.binary()).to_pylist(), WORDS)
                keys = [set_key(s) for s in sets]
                values = [signature(s) if len(s) else None for s in sets]
                yield pa.record_batch(
                    [
                        part.column(0),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([k[0] for k in keys], pa.int64()),
                        pa.array([k[1] for k in keys], pa.int64()),
                        pa.array([None if v is None else bands(v).view(np.int64) for v in values], pa.list_(pa.int64())),
                    ],
                    names=["_id", "_n", "_s1", "_s2", "_bands"],
                )

    return rows.mapInArrow(sign, f"_id {id_type}, _n bigint, _s1 bigint, _s2 bigint, _bands array<bigint>")


def _candidate_texts(rows: DataFrame, classes: DataFrame, wanted: DataFrame) -> DataFrame:
    """``_c, _text`` for the wanted classes: the text of the row with the class's least id, if its set is the class's."""
    chosen = classes.select("_c", "_min", "_n", "_s1", "_s2").join(wanted, "_c", "left_semi")
    found = rows.join(chosen, F.col("_id").eqNullSafe(F.col("_min"))).select("_c", "_text", "_n", "_s1", "_s2")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in small_batches(batch, BATCH_ROWS):
                sets = shingle_sets(part.column(1).cast(pa.binary()).to_pylist(), WORDS)
                want = zip(*(part.column(i).to_pylist() for i in (2, 3, 4)), strict=True)
                same = [(len(s), *set_key(s)) == w for s, w in zip(sets, want, strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1)], names=["_c", "_text"]).filter(pa.array(same))

    return found.mapInArrow(check, "_c bigint, _text string").dropDuplicates(["_c"])


def _similar(links: DataFrame, texts: DataFrame) -> DataFrame:
    """Those of ``u, v`` whose full shingle sets are similar enough."""
    near = links.join(texts.select(F.col("_c").alias("u"), F.col("_text").alias("_a")), "u")
    near = near.join(texts.select(F.col("_c").alias("v"), F.col("_text").alias("_b")), "v").select("u", "v", "_a", "_b")

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in small_batches(batch, BATCH_ROWS):
                left = shingle_sets(part.column(2).cast(pa.binary()).to_pylist(), WORDS)
                right = shingle_sets(part.column(3).cast(pa.binary()).to_pylist(), WORDS)
                shared = [len(np.intersect1d(a, b, assume_unique=True)) for a, b in zip(left, right, strict=True)]
                linked = [
                    SIMILAR[1] * s >= SIMILAR[0] * (len(a) + len(b) - s) for s, a, b in zip(shared, left, right, strict=True)
                ]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1)], names=["u", "v"]).filter(pa.array(linked))

    return near.mapInArrow(test, "u bigint, v bigint")


def _possible(m: Column, n: Column) -> Column:
    """Whether sets of ``m`` and ``n`` shingles can be similar enough."""
    return SIMILAR[1] * F.least(m, n) >= SIMILAR[0] * F.greatest(m, n)


def _link(a: Column, b: Column) -> list[Column]:
    """Ends of a link between two members (``_c, _n``) in order."""
    return [F.least(a["_c"], b["_c"]).alias("u"), F.greatest(a["_c"], b["_c"]).alias("v")]


def _groups(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Components within each bucket that holds more than one: ``_bucket, _label, _low, _high, _size``."""
    labelled = with_labels(members, "_c", labels, "_label")
    member = F.struct("_c", "_n")
    groups = labelled.groupBy("_bucket", "_label").agg(F.min(member).alias("_low"), F.max(member).alias("_high"), F.count("*").alias("_size"))
    groups = stored(groups, "bucket-groups", LINKS)
    several = groups.groupBy("_bucket").agg(F.count("*").alias("_groups")).filter("_groups > 1").select("_bucket")
    return groups.join(several, "_bucket")


def _hub_links(groups: DataFrame, end: str) -> DataFrame:
    """Links from one member of each bucket's largest component to one of every other."""
    hubs = groups.groupBy("_bucket").agg(F.max(F.struct("_size", F.col("_label"), F.col(end).alias("member"))).alias("_hub"))
    hub, own = F.col("_hub.member"), F.col(end)
    spokes = groups.join(hubs, "_bucket").filter((F.col("_label") != F.col("_hub._label")) & _possible(hub["_n"], own["_n"]))
    return spokes.select(*_link(hub, own)).distinct()


def _open_members(members: DataFrame, centres: DataFrame, labels: DataFrame) -> DataFrame:
    """``_c, _label`` of the members of buckets in which those that were no centre are not all connected.

    A centre has been tested against every member of its bucket.
    """
    waiting = with_labels(members.drop("_n").join(centres, ["_bucket", "_c"], "left_anti"), "_c", labels, "_label")
    waiting = stored(waiting.select("_bucket", "_c", "_label"), "waiting", LINKS)
    ends = waiting.groupBy("_bucket").agg(F.min("_label").alias("_low"), F.max("_label").alias("_high"))
    return waiting.join(ends.filter("_low <> _high"), "_bucket").select("_c", "_label").distinct()


def _shingles(texts: DataFrame) -> DataFrame:
    """``_c, _label, _n, _shingle``: a row for each shingle of ``texts`` (``_c, _label, _text``)."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in small_batches(batch, BATCH_ROWS):
                sets = shingle_sets(part.column(2).cast(pa.binary()).to_pylist(), WORDS)
                sizes = np.array([len(s) for s in sets], np.int64)
                again = pa.array(np.repeat(np.arange(len(sets)), sizes))
                columns = [part.column(0).take(again), part.column(1).take(again), pa.array(np.repeat(sizes, sizes))]
                columns.append(pa.array(np.concatenate(sets).view(np.int64) if sets else np.zeros(0, np.int64)))
                yield pa.RecordBatch.from_arrays(columns, names=["_c", "_label", "_n", "_shingle"])

    return texts.select("_c", "_label", "_text").mapInArrow(cut, "_c bigint, _label bigint, _n bigint, _shingle bigint")


def _prefix_links(open_members: DataFrame, texts: DataFrame) -> DataFrame:
    """``u, v`` of different components whose sets may be similar enough: all that are, and few others.

    Shingles are ordered by the number of open members that have them, then by hash. If two sets share at least ``k``
    shingles, the first of these in the order is among the first ``n - k + 1`` of either set, and at most as many follow
    it as are left behind it. Shingles of one member stand first and link nothing.
    """
    many, parts = SIMILAR
    both = many + parts
    cut = stored(_shingles(texts.join(open_members, "_c")), "shingles", ROWS)
    times = cut.groupBy("_shingle").agg(F.count("*").alias("_times")).filter("_times > 1")
    shared = cut.join(times, "_shingle")
    # a member's own shingles, as many as its text has
    sets = shared.groupBy("_c", "_label", "_n").agg(F.sort_array(F.collect_list(F.struct("_times", "_shingle"))).alias("_set"))
    own = F.col("_n") - F.size("_set")
    as_larger = F.col("_n") - F.ceil(many * F.col("_n") / parts) + 1
    as_smaller = F.col("_n") - F.ceil(2 * many * F.col("_n") / both) + 1
    first = F.slice("_set", 1, F.greatest(as_larger - own, F.lit(0)).cast("int"))
    placed = sets.select("_c", "_label", "_n", own.alias("_own"), as_smaller.alias("_short"), first.alias("_first"))
    placed = placed.select("*", F.posexplode("_first").alias("_ix", "_s")).select(
        "_c",
        "_label",
        "_n",
        "_short",
        F.col("_s._shingle").alias("_shingle"),
        (F.col("_own") + F.col("_ix")).alias("_at"),
        F.slice(F.col("_first._shingle"), F.lit(1), F.least("_ix", F.lit(HEAD))).alias("_head"),
    )
    placed = stored(placed, "prefixes", LINKS)
    small = placed.filter("_at < _short").alias("a")
    large = placed.alias("b")
    least = F.ceil(many * (F.col("a._n") + F.col("b._n")) / both)
    met = small.join(
        large,
        (F.col("a._shingle") == F.col("b._shingle"))
        & (F.col("a._label") != F.col("b._label"))
        & ((F.col("a._n") < F.col("b._n")) | ((F.col("a._n") == F.col("b._n")) & (F.col("a._c") < F.col("b._c"))))
        & (parts * F.col("a._n") >= many * F.col("b._n"))
        & (F.col("a._n") - F.col("a._at") >= least)
        & (F.col("b._n") - F.col("b._at") >= least)
        # a pair that shares an earlier one has met there
        & ~F.arrays_overlap("a._head", "b._head"),
    )
    u, v = F.col("a._c"), F.col("b._c")
    return met.select(F.least(u, v).alias("u"), F.greatest(u, v).alias("v")).distinct()


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per input row: ``<id_column>, n_shingles, component_id, kept``.

    ``component_id`` is the least id that can be reached over links, the row's own included; ``kept`` says that it is the
    row's own. Rows with equal sets are one class from the start, so copies never become pairs. Null, empty and blank
    texts have no shingles, are linked with nothing and kept. Null ids are larger than any other; rows repeated with one
    id have the same result. An empty table gives an empty result; other columns are not read.
    """
    spark = docs.sparkSession
    id_type = docs.schema[id_column].dataType.simpleString()
    rows = docs.select(F.col(id_column).alias("_id"), F.coalesce(F.col(text_column), F.lit("")).alias("_text"))
    signed = stored(_signatures(rows, id_type), "signatures")
    classes = signed.filter("_n > 0").groupBy("_n", "_s1", "_s2").agg(F.min("_id").alias("_min"), F.first("_bands").alias("_bands"))
    classes = stored(classes.withColumn("_c", F.monotonically_increasing_id()), "classes", ROWS)

    banded = classes.select(F.explode("_bands").alias("_bucket"), "_c", "_n")
    buckets = banded.groupBy("_bucket").agg(F.min(F.struct("_c", "_n")).alias("_centre"), F.count("*").alias("_size")).filter("_size > 1")
    members = stored(banded.join(buckets.drop("_size"), "_bucket"), "members", ROWS)
    texts = stored(_candidate_texts(rows, classes, members.select("_c").distinct()), "candidate-texts", ROWS)
    labels = spark.createDataFrame([], "node bigint, label bigint")

    def linked(links: DataFrame) -> DataFrame:
        """Labels after the test of further links."""
        found = stored(_similar(links, texts), "similar", LINKS)
        return labels if found.isEmpty() else merged(labels, found)

    stars = members.filter((F.col("_centre._c") != F.col("_c")) & _possible(F.col("_centre._n"), F.col("_n")))
    labels = linked(stars.select(*_link(F.col("_centre"), F.struct("_c", "_n"))).distinct())
    centres = members.select("_bucket", F.col("_centre._c").alias("_c")).distinct()
    members = members.select("_bucket", "_c", "_n")
    for number in range(HUB_ROUNDS):
        groups = _groups(members, labels)
        if groups.isEmpty():
            break
        labels = linked(_hub_links(groups, "_high" if number % 2 else "_low"))
    open_members = stored(_open_members(members, centres, labels), "open-members", LINKS)
    if not open_members.isEmpty():
        labels = linked(_prefix_links(open_members, texts))

    owned = with_labels(classes.select("_c", "_n", "_s1", "_s2", "_min"), "_c", labels, "_label")
    least = owned.groupBy("_label").agg(F.min("_min").alias("_least"))
    owned = owned.join(least, "_label").select("_n", "_s1", "_s2", "_least")
    found = signed.select("_id", "_n", "_s1", "_s2").join(owned, ["_n", "_s1", "_s2"], "left")
    component = F.when(F.col("_n") > 0, F.col("_least")).otherwise(F.col("_id"))
    return found.select(
        F.col("_id").alias(id_column),
        F.col("_n").alias("n_shingles"),
        component.alias("component_id"),
        F.col("_id").eqNullSafe(component).alias("kept"),
    )
