"""Exact similarity retrieval over a table of vectors, index building and index upkeep.

Scores are cosine similarities rounded to six decimals before ranking; equal scores rank by lower id. Queries and index
are packed into tiles, stored tables of unit rows; tiles meet in the cells of a grid, where a task holds the index rows of
its cell, lets the query tiles pass one by one and hands on the best ``k`` rows per query. Vectors never pass through the
driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from foliomill.functions.text import hashed_embedding
from foliomill.session import fresh_path

QUERY_TILE = 2048  # rows of a tile, fewer if the vectors are long
INDEX_TILE = 8192
TILE_BYTES = 1 << 20
HELD_BYTES = 32 << 20  # unit rows held by one task
CELL_PAIRS = 64  # pairs of full tiles that a cell of the grid holds, while there are no more than the most cells
CELLS_PER_CORE = 4
ROWS_PER_BUCKET = 100_000  # some 50 MB of vectors with 64 dimensions
SCALE = 1_000_000
SCORE_CELLS = 1_000_000  # scores held at once by one task
FEW_ROWS = 4  # rows looked at one by one, in multiples of k


def _unit_rows(vectors: pa.Array) -> np.ndarray:
    """Vectors as unit rows; a zero vector stays zero."""
    lengths = pc.unique(pc.list_value_length(vectors)).to_pylist()
    if len(lengths) > 1:
        raise ValueError(f"vectors must have one length, found {sorted(lengths)}")
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if not np.isfinite(flat).all():
        raise ValueError("vectors must hold finite numbers only")
    rows = flat.reshape(len(vectors), lengths[0] if lengths else 0)
    norm = np.linalg.norm(rows, axis=1, keepdims=True)
    return np.divide(rows, norm, out=np.zeros_like(rows), where=norm > 0)


def _ids(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False)


def _block_best(
    ids: np.ndarray,
    rows: np.ndarray,
    q_ids: np.ndarray,
    q_rows: np.ndarray,
    k: int,
    floor: int,
    skip_self: bool,
    to_beat: np.ndarray | None = None,
) -> pd.DataFrame:
    """Rows of one block that may be among the best ``k`` of each query, at least the best ``k`` of the block.

    ``to_beat`` holds the score each query's rows have to reach; where few rows reach it, only those are looked at.
    Otherwise score and position by id make one integer, so that ties need no second pass.
    """
    by_id = np.argsort(ids, kind="stable")
    ids, rows = ids[by_id], rows[by_id]
    n = len(ids)
    earlier_wins = np.arange(n - 1, -1, -1, dtype=np.int64)
    q_own, own = _equal_ids(ids, q_ids) if skip_self else (np.zeros(0, np.int64), np.zeros(0, np.int64))
    kept = []
    step = max(1, SCORE_CELLS // n)
    for lo in range(0, len(q_ids), step):
        raw = q_rows[lo : lo + step] @ rows.T
        raw *= SCALE
        here = slice(*np.searchsorted(q_own, [lo, lo + step]))
        hit, mine = q_own[here] - lo, own[here]
        raw[hit, mine] = -np.inf
        if to_beat is not None:
            q, c = np.nonzero(raw > to_beat[lo : lo + step, None] - 1)
            if len(q) <= FEW_ROWS * k * len(raw):
                kept.append(_found(q, c, raw, lo, ids, floor))
                continue
        best = np.tile(np.arange(n), (len(raw), 1))
        if n > k:
            raw[hit, mine] = -2 * SCALE
            sortable = np.rint(raw).astype(np.int64) * n + earlier_wins
            best = np.argpartition(sortable, n - k, axis=1)[:, n - k :]
            raw[hit, mine] = -np.inf
        kept.append(_found(np.repeat(np.arange(len(raw)), best.shape[1]), best.ravel(), raw, lo, ids, floor))
    return pd.concat(kept, ignore_index=True)


def _equal_ids(ids: np.ndarray, q_ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of queries and of rows that have the same id; ``ids`` are sorted and may repeat."""
    if ids.dtype.kind != q_ids.dtype.kind:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first, end = np.searchsorted(ids, q_ids, "left"), np.searchsorted(ids, q_ids, "right")
    copies = end - first
    q = np.repeat(np.arange(len(q_ids)), copies)
    return q, np.arange(len(q)) + np.repeat(first - (np.cumsum(copies) - copies), copies)


def _found(q: np.ndarray, c: np.ndarray, raw: np.ndarray, lo: int, ids: np.ndarray, floor: int) -> pd.DataFrame:
    scores = np.rint(raw[q, c])
    usable = np.isfinite(scores) & (scores >= floor)
    return pd.DataFrame({"q": q[usable] + lo, "id": ids[c[usable]], "score": scores[usable].astype(np.int64)})


def _trim(found: pd.DataFrame, k: int) -> pd.DataFrame:
    ordered = found.sort_values(["q", "score", "id"], ascending=[True, False, True], kind="stable")
    return ordered.groupby("q", sort=False).head(k)


def _scores_to_beat(best: pd.DataFrame, n_queries: int, k: int) -> np.ndarray:
    """Score of the last of ``k`` rows per query; a query with fewer rows takes any."""
    sizes = np.bincount(best["q"], minlength=n_queries)
    last = best.groupby("q")["score"].min()
    limits = np.full(n_queries, -np.inf)
    limits[last.index] = last.to_numpy()
    return np.where(sizes >= k, limits, -np.inf)


def _best_batch(found: pd.DataFrame, q_ids: np.ndarray, run: int, schema: pa.Schema) -> pa.RecordBatch:
    columns = [
        pa.array([run] * len(found), type=pa.int64()),
        pa.array(q_ids[found["q"].to_numpy()], type=schema.field(1).type),
        pa.array(found["id"].to_numpy(), type=schema.field(2).type),
        pa.array(found["score"].to_numpy() / SCALE, type=pa.float64()),
    ]
    return pa.RecordBatch.from_arrays(columns, schema=schema)


def pack_tiles(df: DataFrame, rows: int, *by: str) -> DataFrame:
    """Stored tiles of unit rows: ``by, slot, n, size, ids, rows``, where ``df`` has ``by, id, vec``.

    Rows without id or vector are left out. A tile holds at most ``rows`` rows and ``TILE_BYTES`` and rows of one ``by``
    only; its matrix is kept as ``size`` bytes. ``slot`` numbers the tiles of a task from the task's own number on, so that
    a remainder of it deals tiles out evenly. Nothing is shuffled. A task holds ``HELD_BYTES`` of rows that don't fill a
    tile; beyond that they become smaller tiles. Tiles are written a few at a time: by itself the writer keeps a hundred
    before it looks at their size, and the reader takes a whole row group at once.
    """
    types = {f.name: f.dataType.simpleString() for f in df.schema}

    def tile(key: tuple, slot: int, ids: pa.Array, unit: np.ndarray) -> pa.RecordBatch:
        columns = [pa.array([k], pa.int64()) for k in (*key, slot, len(ids), unit.nbytes)]
        columns += [pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids), pa.array([unit.tobytes()], pa.binary())]
        return pa.RecordBatch.from_arrays(columns, names=[*by, "slot", "n", "size", "ids", "rows"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slot = TaskContext.get().partitionId()
        held: dict[tuple, tuple[list, list]] = {}

        def cut(key: tuple, least: int) -> Iterator[pa.RecordBatch]:
            nonlocal slot
            ids, unit = held.pop(key)
            ids, unit = pa.concat_arrays(ids), np.concatenate(unit)
            most = max(1, min(rows, TILE_BYTES // (8 * max(1, unit.shape[1]))))
            while len(ids) >= (most if least else 1):
                yield tile(key, slot, ids[:most], unit[:most])
                ids, unit, slot = ids[most:], unit[most:], slot + 1
            if len(ids):
                held[key] = ([ids], [unit])

        for batch in batches:
            at = len(by)
            batch = batch.filter(pc.and_(pc.is_valid(batch.column(at)), pc.is_valid(batch.column(at + 1))))
            if not batch.num_rows:
                continue
            unit = _unit_rows(batch.column(at + 1))
            groups = {(): np.arange(batch.num_rows)} if not by else batch.select(by).to_pandas().groupby(list(by)).indices
            for key, places in groups.items():
                key = tuple(int(k) for k in (key if isinstance(key, tuple) else (key,)))
                ids, parts = held.setdefault(key, ([], []))
                if parts and parts[0].shape[1] != unit.shape[1]:
                    raise ValueError(f"vectors must have one length, found {sorted({parts[0].shape[1], unit.shape[1]})}")
                ids.append(batch.column(at).take(pa.array(places)))
                parts.append(unit[places])
                if sum(map(len, ids)) >= min(rows, TILE_BYTES // (8 * max(1, unit.shape[1]))):
                    yield from cut(key, rows)
            if sum(part.nbytes for _, parts in held.values() for part in parts) > HELD_BYTES:
                for key in list(held):
                    yield from cut(key, 0)
        for key in list(held):
            yield from cut(key, 0)

    made = "".join(f"{c} bigint, " for c in by) + f"slot bigint, n bigint, size bigint, ids array<{types['id']}>, rows binary"
    tiles = df.select(*by, "id", "vec").mapInArrow(pack, made)
    few = {"parquet.block.size": 8 * TILE_BYTES, "parquet.page.size.row.check.min": 1, "parquet.block.size.row.check.min": 1}
    tiles.write.options(**few).parquet(path := fresh_path(df.sparkSession, "tiles"))
    return df.sparkSession.read.schema(tiles.schema).parquet(path)


def _grid(n_queries: int, n_index: int, index_bytes: int, cores: int, cell_pairs: int) -> tuple[int, int]:
    """Groups of query tiles and of index tiles: enough cells for the work and the cluster, and of these the shape that
    copies the fewest tiles (a query tile goes to every index group, an index tile to every query group).

    There are at most ``CELLS_PER_CORE`` cells a core, so that a tile is copied as often in a large table as in a small
    one, and more only where the index rows of a cell would exceed ``HELD_BYTES``.
    """
    cells = max(min(-(-n_queries * n_index // cell_pairs), CELLS_PER_CORE * cores), min(cores, n_queries * n_index), 1)
    index_groups = max(1, min(n_index, cells, round((cells * n_index / max(1, n_queries)) ** 0.5)))
    index_groups = max(index_groups, min(n_index, -(-index_bytes // HELD_BYTES)))
    query_groups = max(1, min(n_queries, -(-cells // index_groups)))
    return query_groups, index_groups


def _sizes(tiles: DataFrame) -> tuple[int, int]:
    """Number of tiles, and bytes of their rows."""
    return tuple(next(tiles.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).toLocalIterator()))


def _held_blocks(tiles: list[tuple[np.ndarray, np.ndarray]]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Index rows of a cell by id, in blocks of ``INDEX_TILE``."""
    widths = sorted({rows.shape[1] for _, rows in tiles})
    if len(widths) > 1:
        raise ValueError(f"vectors must have one length, found {widths}")
    ids, rows = np.concatenate([i for i, _ in tiles]), np.concatenate([r for _, r in tiles])
    tiles.clear()
    by_id = np.argsort(ids, kind="stable")
    return [(ids[part], rows[part]) for part in np.split(by_id, range(INDEX_TILE, len(by_id), INDEX_TILE))]


def _score_cells(k: int, floor: int, skip_self: bool, n_on: int, schema: pa.Schema) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Best ``k`` per query and cell, from tiles sorted by cell, those of the index first (``on, is query, run, query ids, ids,
    rows``). The index rows of one cell are held, the query tiles pass one by one."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, tiles, blocks = None, [], []
        for batch in batches:
            cells = list(zip(*(batch.column(c).to_pylist() for c in range(n_on))))
            asks, runs = batch.column(n_on).to_pylist(), batch.column(n_on + 1).to_pylist()
            for i, own in enumerate(cells):
                if own != cell:
                    cell, tiles, blocks = own, [], []
                ids = _ids(batch.column(n_on + (2 if asks[i] else 3))[i].values)
                rows = np.frombuffer(batch.column(n_on + 4)[i].as_py(), np.float64).reshape(len(ids), -1)
                if not asks[i]:
                    tiles.append((ids.copy(), rows))
                    continue
                if tiles:
                    blocks = _held_blocks(tiles)
                best = None
                for held_ids, held_rows in blocks:
                    if rows.shape[1] != held_rows.shape[1]:
                        raise ValueError(f"vectors must have one length, found {sorted({rows.shape[1], held_rows.shape[1]})}")
                    to_beat = None if best is None else _scores_to_beat(best, len(ids), k)
                    found = _block_best(held_ids, held_rows, ids, rows, k, floor, skip_self, to_beat)
                    best = _trim(found if best is None else pd.concat([best, found], ignore_index=True), k)
                if best is not None:
                    yield _best_batch(best, ids, runs[i], schema)

    return scan


def join_tiles(
    queries: DataFrame,
    index: DataFrame,
    k: int,
    on: list[str],
    *,
    run: str | None = None,
    floor: int = -2 * SCALE,
    skip_self: bool = False,
    cells: tuple[int, Column] | None = None,
) -> DataFrame:
    """``query_id, id, score, rank`` of the best ``k`` per query over all pairs of tiles that agree in ``on``.

    Tiles of both sides are dealt out by ``on`` and sorted, so that a task reads each tile of a cell once; ``on`` must keep
    the index rows of a cell within what a task can hold. ``cells`` gives their number and the number of a row's own, and
    each is a task. With ``run``, one of these columns, the result has it too and queries of different runs are different
    queries.
    """
    id_types = [tiles.schema["ids"].dataType.elementType for tiles in (queries, index)]
    fields = [("run", pa.int64()), ("query_id", to_arrow_type(id_types[0])), ("id", to_arrow_type(id_types[1])), ("score", pa.float64())]
    of = F.lit(0).cast("bigint") if run is None else F.col(run)
    none = [F.lit(None).cast(tiles.schema["ids"].dataType) for tiles in (queries, index)]
    names = ["_asks", "_run", "_query_ids", "_index_ids", "_rows"]
    asked = queries.select(*on, *[c.alias(n) for c, n in zip((F.lit(True), of, F.col("ids"), none[1], F.col("rows")), names)])
    own = index.select(*on, *[c.alias(n) for c, n in zip((F.lit(False), of, none[0], F.col("ids"), F.col("rows")), names)])
    met = own.unionByName(asked)
    met = met.repartition(*on) if cells is None else met.repartitionById(max(2, cells[0]), cells[1])
    made = f"run bigint, query_id {id_types[0].simpleString()}, id {id_types[1].simpleString()}, score double"
    found = met.sortWithinPartitions(*on, "_asks").mapInArrow(_score_cells(k, floor, skip_self, len(on), pa.schema(fields)), made)
    order = Window.partitionBy("run", "query_id").orderBy(F.col("score").desc(), "id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    ranked = ranked.withColumn("rank", F.col("rank").cast("bigint"))
    return ranked.drop("run") if run is None else ranked


def top_k(
    index: DataFrame,
    queries: DataFrame,
    k: int,
    *,
    index_cols: tuple[str, str],
    query_cols: tuple[str, str],
    min_score: float | None = None,
    skip_self: bool = False,
    query_tile: int = QUERY_TILE,
    index_tile: int = INDEX_TILE,
    cell_pairs: int = CELL_PAIRS,
) -> DataFrame:
    """``query_id, id, score, rank`` of the ``k`` most similar vectors per query, optionally from ``min_score`` up.

    Both sides are packed into tiles where they lie and stored. The tiles are dealt to the rows and columns of a grid and
    meet on its cells; each cell hands on ``k`` rows per query, so what is shuffled is the tiles times the grid's sides,
    which follow the cluster and not the tables, and these hits. All vectors against all vectors is quadratic work whatever
    the plan. Filters on the index belong before the call, where they reach its scan. Ids are unique on both sides.
    """
    if k < 1:
        raise ValueError("k must be positive")
    spark = index.sparkSession
    (index_id, index_vec), (query_id, query_vec) = index_cols, query_cols
    own = pack_tiles(index.select(F.col(index_id).alias("id"), F.col(index_vec).alias("vec")), index_tile)
    asked = pack_tiles(queries.select(F.col(query_id).alias("id"), F.col(query_vec).alias("vec")), query_tile)
    rows, columns = _grid(asked.count(), *_sizes(own), spark.sparkContext.defaultParallelism, cell_pairs)
    asked = asked.withColumns({"_row": F.pmod("slot", F.lit(rows)), "_column": F.explode(F.sequence(F.lit(0), F.lit(columns - 1)))})
    own = own.withColumns({"_column": F.pmod("slot", F.lit(columns)), "_row": F.explode(F.sequence(F.lit(0), F.lit(rows - 1)))})
    on = ["_row", "_column"]
    asked, own = (t.withColumns({c: F.col(c).cast("bigint") for c in on}) for t in (asked, own))
    floor = -2 * SCALE if min_score is None else int(np.rint(min_score * SCALE))
    cells = (rows * columns, (F.col("_row") * columns + F.col("_column")).cast("int"))
    return join_tiles(asked, own, k, on, floor=floor, skip_self=skip_self, cells=cells)


def top_k_by_run(
    index: DataFrame,
    queries: DataFrame,
    k: dict[int, int],
    *,
    index_cols: tuple[str, str],
    query_cols: tuple[str, str],
    query_tile: int = QUERY_TILE,
    index_tile: int = INDEX_TILE,
    cell_pairs: int = CELL_PAIRS,
) -> DataFrame:
    """``run, query_id, id, score, rank``: the same queries against the index rows of each ``run``, all in one join.

    ``index`` has a column ``run``; ``k`` gives the number of hits for each. The queries are packed once and their tiles
    go to the cells of every run.
    """
    spark = index.sparkSession
    run = F.col("run").cast("bigint").alias("run")
    own = pack_tiles(index.select(run, F.col(index_cols[0]).alias("id"), F.col(index_cols[1]).alias("vec")), index_tile, "run")
    asked = pack_tiles(queries.select(F.col(query_cols[0]).alias("id"), F.col(query_cols[1]).alias("vec")), query_tile)
    rows, columns = _grid(asked.count(), *_sizes(own), spark.sparkContext.defaultParallelism, cell_pairs)
    line = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n - 1).cast("bigint")))
    runs = F.array(*[F.lit(r).cast("bigint") for r in sorted(k)])
    asked = asked.withColumn("run", F.explode(runs)).withColumn("_column", line(columns)).withColumn("_row", F.pmod("slot", F.lit(rows)))
    own = own.withColumn("_column", F.pmod("slot", F.lit(columns))).withColumn("_row", line(rows))
    own = own.filter(F.array_contains(runs, F.col("run")))
    cell = ((F.array_position(runs, F.col("run")) - 1) * rows + F.col("_row")) * columns + F.col("_column")
    cells = (len(k) * rows * columns, cell.cast("int"))
    found = join_tiles(asked, own, max(k.values()), ["run", "_row", "_column"], run="run", cells=cells)
    most = F.create_map(*[F.lit(x).cast("bigint") for pair in k.items() for x in pair])
    return found.filter(F.col("rank") <= most[F.col("run")])


def _pick_diverse(k: int, weight: float) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def pick(candidates: list) -> list[tuple]:
        candidates = sorted(candidates, key=lambda c: c["id"])
        rows = np.array([c["vec"] for c in candidates], dtype=np.float64)
        norm = np.linalg.norm(rows, axis=1, keepdims=True)
        rows = np.divide(rows, norm, out=np.zeros_like(rows), where=norm > 0)
        alike = np.round(rows @ rows.T, 6)
        relevance = np.array([c["score"] for c in candidates])
        closest = np.zeros(len(rows))
        open_rows = np.ones(len(rows), dtype=bool)
        picks = []
        for step in range(min(k, len(rows))):
            value = np.round(weight * relevance - (1.0 - weight) * closest, 9)
            at = int(np.argmax(np.where(open_rows, value, -np.inf)))
            picks.append((step + 1, candidates[at]["id"], float(value[at])))
            open_rows[at] = False
            closest = alike[at] if step == 0 else np.maximum(closest, alike[at])
        return picks

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(q, *p) for q, cands in zip(batch["query_id"], batch["cands"]) for p in pick(list(cands))]
            yield pd.DataFrame(rows, columns=["query_id", "step", "id", "mmr_score"])

    return run


def diverse_top_k(
    index: DataFrame,
    queries: DataFrame,
    k: int,
    fetch_k: int,
    weight: float,
    *,
    index_cols: tuple[str, str],
    query_cols: tuple[str, str],
    skip_self: bool = False,
) -> DataFrame:
    """Maximal marginal relevance: ``query_id, step, id, mmr_score`` for ``k`` picks out of ``fetch_k`` candidates.

    Similarities have six decimals, the weighted score nine, so that halving a similarity never meets a rounding tie.
    A group holds the ``fetch_k`` candidates of one query, never more.
    """
    near = top_k(index, queries, fetch_k, index_cols=index_cols, query_cols=query_cols, skip_self=skip_self)
    vectors = index.select(F.col(index_cols[0]).alias("id"), F.col(index_cols[1]).alias("vec"))
    groups = (
        near.join(vectors, "id")
        .groupBy("query_id")
        .agg(F.collect_list(F.struct("id", "score", "vec")).alias("cands"))
    )
    types = {f.name: f.dataType.simpleString() for f in near.schema}
    schema = f"query_id {types['query_id']}, step int, id {types['id']}, mmr_score double"
    return groups.mapInPandas(_pick_diverse(k, weight), schema)


def recall_at_k(hits: DataFrame, k: int, query_labels: DataFrame, index_labels: DataFrame) -> DataFrame:
    """Share of the relevant vectors found in the first ``k`` hits, per query; relevant means the same label.

    Both label tables are ``(id, label)``; a vector is not relevant to itself.
    """
    relevant = index_labels.groupBy("label").agg((F.count(F.lit(1)) - 1).alias("n_relevant"))
    wanted = query_labels.select(F.col("id").alias("query_id"), "label").join(relevant, "label")
    found = hits.filter(F.col("rank") <= k).join(index_labels.select("id", F.col("label").alias("hit_label")), "id")
    per_query = (
        wanted.join(found, "query_id", "left")
        .groupBy("query_id", "n_relevant")
        .agg(F.coalesce(F.sum((F.col("hit_label") == F.col("label")).cast("bigint")), F.lit(0)).alias("n_hits"))
    )
    recall = F.when(F.col("n_relevant") > 0, F.round(F.col("n_hits") / F.col("n_relevant"), 6))
    return per_query.select("query_id", "n_hits", "n_relevant", recall.alias("recall"))


def index_rows(source: DataFrame, key: str, text: str, embed: Callable[[Column], Column] = hashed_embedding) -> DataFrame:
    """Rows of a vector index: key, hash of the text, vector."""
    return source.select(F.col(key), F.md5(text).alias("text_hash"), embed(F.col(text)).alias("embedding"))


def write_index(rows: DataFrame, table: str, path: str, key: str, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Store an index bucketed by key, one file per bucket, so that later syncs meet it without shuffling it again.

    The number of buckets follows from the number of rows, so a bucket's file stays of one size however large the index.
    """
    buckets = max(1, -(-rows.select(key).count() // rows_per_bucket))
    rows.repartition(buckets, key).write.mode("overwrite").option("path", path).bucketBy(buckets, key).sortBy(key).saveAsTable(table)
    return rows.sparkSession.table(table)


def sync_plan(index: DataFrame, source: DataFrame, key: str, text: str) -> DataFrame:
    """Compare a stored index with its source by text hash: ``key, action, text`` for every key of either side.

    The index contributes its key and hash only; texts ride along on the source side.
    """
    have = index.select(F.col(key).alias("_have"), F.col("text_hash").alias("_old_hash"))
    want = source.select(F.col(key).alias("_want"), F.col(text).alias("text"), F.md5(text).alias("_new_hash"))
    action = (
        F.when(F.col("_have").isNull(), "insert")
        .when(F.col("_want").isNull(), "delete")
        .when(F.col("_old_hash").eqNullSafe(F.col("_new_hash")), "keep")
        .otherwise("update")
    )
    joined = have.join(want, F.col("_have") == F.col("_want"), "full_outer")
    return joined.select(F.coalesce("_have", "_want").alias(key), action.alias("action"), "text")


def embed_changes(plan: DataFrame, key: str, embed: Callable[[Column], Column] = hashed_embedding) -> DataFrame:
    """Embed only what was inserted or updated; kept and deleted rows carry no vector."""
    changed = F.col("action").isin("insert", "update")
    return plan.select(key, "action", F.when(changed, embed(F.col("text"))).alias("embedding"))


def apply_sync(
    index: DataFrame, source: DataFrame, key: str, text: str, embed: Callable[[Column], Column] = hashed_embedding
) -> DataFrame:
    """Index after a triggered sync: unchanged rows keep their stored vectors, only new and changed texts are embedded.

    Both sides meet by key alone, by which the stored index is bucketed.
    """
    want = source.select(key, F.col(text).alias("_text"), F.md5(text).alias("_new_hash"))
    have = index.select(key, F.col("text_hash").alias("_old_hash"), F.col("embedding").alias("_stored"))
    met = want.join(have, key, "left")
    same = F.col("_old_hash").eqNullSafe(F.col("_new_hash")) & F.col("_stored").isNotNull()
    fresh = embed(F.when(~same, F.col("_text")))
    return met.select(key, F.col("_new_hash").alias("text_hash"), F.when(same, F.col("_stored")).otherwise(fresh).alias("embedding"))
