"""Approximate retrieval: vectors filed under coarse centroids, queries answered from the nearest files.

The centroids are fitted on a bounded sample and are all that the driver ever holds. Every vector is filed; a file with
many of them is dealt over strips, and each query meets all strips of its files, so a direction that a third of the
vectors share is not one task's work. How many files a query looks into is measured on the sample.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliomill.operators.retrieval import HELD_BYTES, INDEX_TILE, QUERY_TILE, SCALE, SCORE_CELLS, _unit_rows, join_tiles, pack_tiles

FIT_ROWS = 20_000  # vectors that the centroids are fitted on, at most
MOST_LISTS = 4096  # centroids sent to every task, at most
FIT_ROUNDS = 12
TRIAL_QUERIES = 256  # sampled vectors that the number of probes is measured with
STRIP_ROWS = 8 * INDEX_TILE
_HASHES = 1 << 30


class Centroids(NamedTuple):
    """Unit centroids as rows, and the number of files that a query looks into."""

    rows: np.ndarray
    n_probe: int


class IvfIndex(NamedTuple):
    centroids: Centroids
    tiles: DataFrame  # list, strip, slot, n, ids, rows
    strips: DataFrame  # list, n, strips


def _kmeans(rows: np.ndarray, k: int, rounds: int = FIT_ROUNDS) -> np.ndarray:
    """Unit centroids by Lloyd's rounds on the sphere; a centroid without rows starts again at the row it serves worst."""
    lots = np.random.default_rng(11)
    centroids = rows[np.sort(lots.choice(len(rows), k, replace=False))]
    for _ in range(rounds):
        near = rows @ centroids.T
        own, fit = near.argmax(1), near.max(1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, own, rows)
        empty = np.flatnonzero(np.bincount(own, minlength=k) == 0)
        sums[empty] = rows[np.argsort(fit, kind="stable")[: len(empty)]]
        norm = np.linalg.norm(sums, axis=1, keepdims=True)
        centroids = np.divide(sums, norm, out=np.zeros_like(sums), where=norm > 0)
    return centroids


def probes_for(rows: np.ndarray, centroids: np.ndarray, k: int, recall: float) -> int:
    """Files to look into so that ``recall`` of the true ``k`` nearest are among them, measured within some rows."""
    asked = rows[:: max(1, len(rows) // TRIAL_QUERIES)][:TRIAL_QUERIES]
    k = min(k, len(rows))
    nearest = np.argpartition(-(asked @ rows.T), k - 1, axis=1)[:, :k]
    own = (rows @ centroids.T).argmax(1)
    order = np.argsort(np.argsort(-(asked @ centroids.T), axis=1, kind="stable"), axis=1)
    place = np.sort(order[np.arange(len(asked))[:, None], own[nearest]].ravel())  # when the file of each is looked into
    return int(place[min(len(place) - 1, int(np.ceil(recall * len(place))) - 1)]) + 1


def fit_centroids(
    vectors: DataFrame, n_lists: int | None = None, k: int = 10, recall: float = 0.97, fit_rows: int = FIT_ROWS
) -> Centroids:
    """Centroids of ``vectors`` (``id, vec``) from at most ``fit_rows`` of them, chosen by the hash of their ids.

    ``n_lists`` is by default the square root of the number of vectors, no more than ``MOST_LISTS`` and a 32nd of the
    sample.
    """
    known = vectors.filter(F.col("id").isNotNull() & F.col("vec").isNotNull())
    n = known.count()
    share = min(_HASHES, int(_HASHES * fit_rows / max(1, n)))
    sample = known.filter(F.pmod(F.xxhash64("id"), F.lit(_HASHES)) < share).orderBy("id").limit(fit_rows).select("vec").toArrow()
    if not sample.num_rows:
        return Centroids(np.zeros((0, 0)), 1)
    rows = _unit_rows(sample.column(0).combine_chunks())
    rows = np.unique(rows, axis=0)  # copies of one vector would take many centroids
    lists = n_lists or round(n**0.5)
    centroids = _kmeans(rows, max(1, min(lists, MOST_LISTS, -(-len(rows) // 32))))
    return Centroids(centroids, probes_for(rows, centroids, k, recall))


def _filed(vectors: DataFrame, centroids: Centroids, probes: int) -> DataFrame:
    """``list, id, vec``: each vector under its nearest ``probes`` centroids."""
    shared = vectors.sparkSession.sparkContext.broadcast(centroids.rows)
    types = {f.name: f.dataType.simpleString() for f in vectors.schema}

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pc.and_(pc.is_valid(batch.column(0)), pc.is_valid(batch.column(1))))
            if not batch.num_rows or not len(shared.value):
                continue
            unit = _unit_rows(batch.column(1))
            if unit.shape[1] != shared.value.shape[1]:
                raise ValueError(f"vectors must have one length, found {sorted({unit.shape[1], shared.value.shape[1]})}")
            step = max(1, SCORE_CELLS // max(len(shared.value), probes * unit.shape[1]))  # bounds what is scored and what is copied
            for lo in range(0, len(unit), step):
                near = np.argsort(-(unit[lo : lo + step] @ shared.value.T), axis=1, kind="stable")[:, :probes]
                again = pa.array(np.repeat(np.arange(lo, lo + len(near)), near.shape[1]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(near.ravel().astype(np.int64)), batch.column(0).take(again), batch.column(1).take(again)], names=["list", "id", "vec"]
                )

    return vectors.select("id", "vec").mapInArrow(place, f"list bigint, id {types['id']}, vec {types['vec']}")


def build_ivf(vectors: DataFrame, centroids: Centroids, strip_rows: int = STRIP_ROWS, tile_rows: int = INDEX_TILE) -> IvfIndex:
    """File every vector (``id, vec``): tiles of one file and strip each, and the number of strips of each file. A strip has
    no more rows than a task holds."""
    strip_rows = max(1, min(strip_rows, HELD_BYTES // (8 * max(1, centroids.rows.shape[1]))))
    filed = _filed(vectors, centroids, 1)
    counted = filed.groupBy("list").agg(F.count("*").alias("n"))  # a row per centroid
    strips = vectors.sparkSession.createDataFrame(
        [(r["list"], r["n"], -(-r["n"] // strip_rows)) for r in counted.collect()], "list bigint, n bigint, strips bigint"
    )
    dealt = filed.join(F.broadcast(strips), "list").withColumn("strip", F.pmod(F.xxhash64("id"), F.col("strips")))
    tiles = pack_tiles(dealt.select("list", "strip", "id", "vec").repartition("list", "strip"), tile_rows, "list", "strip")
    return IvfIndex(centroids, tiles, strips)


def ivf_top_k(
    index: IvfIndex,
    queries: DataFrame,
    k: int,
    *,
    n_probe: int | None = None,
    min_score: float | None = None,
    skip_self: bool = False,
    query_tile: int = QUERY_TILE,
) -> DataFrame:
    """``query_id, id, score, rank``: the best ``k`` of ``queries`` (``id, vec``) among the files they look into.

    With ``n_probe`` as large as the number of files the result is exact.
    """
    asked = _filed(queries, index.centroids, n_probe or index.centroids.n_probe)
    salt = F.pmod(F.xxhash64("id"), F.lit(16))  # a file that many queries look into is packed by several tasks
    asked = pack_tiles(asked.select("list", "id", "vec").repartition(F.col("list"), salt), query_tile, "list")
    asked = asked.join(F.broadcast(index.strips), "list").withColumn("strip", F.explode(F.sequence(F.lit(0), F.col("strips") - 1)))
    asked = asked.withColumn("strip", F.col("strip").cast("bigint"))
    floor = -2 * SCALE if min_score is None else int(np.rint(min_score * SCALE))
    return join_tiles(asked, index.tiles, k, ["list", "strip"], floor=floor, skip_self=skip_self)


def recall_of(found: DataFrame, exact: DataFrame) -> DataFrame:
    """One row: ``n_queries, n_wanted, n_found`` of two tables of hits; an equal score at the last rank counts as found."""
    last = exact.groupBy("query_id").agg(F.count("*").alias("_wanted"), F.min("score").alias("_least"))
    hits = found.select("query_id", F.col("score").alias("_score"))
    per_query = last.join(hits, "query_id", "left").groupBy("query_id", "_wanted").agg(
        F.sum(F.coalesce((F.col("_score") >= F.col("_least")).cast("bigint"), F.lit(0))).alias("_found")
    )
    return per_query.agg(
        F.count("*").alias("n_queries"),
        F.coalesce(F.sum("_wanted"), F.lit(0)).alias("n_wanted"),
        F.coalesce(F.sum(F.least("_found", "_wanted")), F.lit(0)).alias("n_found"),
    )
