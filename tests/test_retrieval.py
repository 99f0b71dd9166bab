import numpy as np
import pytest
from pyspark.sql import functions as F

from foliomill.operators import retrieval

COLS = ("id", "v")
BLOCKS = {"query_tile": 7, "index_tile": 11, "cell_pairs": 2}


def frame(spark, rows, id_type="bigint"):
    return spark.createDataFrame([(i, [float(x) for x in v]) for i, v in rows], f"id {id_type}, v array<double>")


def corpus(n=60, dim=6, seed=5):
    """Random vectors of which a third are copies of one."""
    rng = np.random.default_rng(seed)
    rows = rng.integers(-3, 4, size=(n, dim)).astype(float)
    rows[: n // 3] = rows[0]
    rows[-1] = 0.0
    return [(int(i), rows[i]) for i in rng.permutation(n)]


def plain_top_k(index, queries, k, min_score=None, skip_self=False):
    def unit(v):
        norm = np.linalg.norm(v)
        return v / norm if norm else v

    out = set()
    for q, qv in queries:
        scored = [(-round(float(unit(qv) @ unit(v)), 6), i) for i, v in index if not (skip_self and i == q)]
        scored = [s for s in sorted(scored) if min_score is None or -s[0] >= min_score][:k]
        out |= {(q, i, -s + 0.0, at + 1) for at, (s, i) in enumerate(scored)}
    return out


def hits(df):
    return {(r.query_id, r.id, r.score + 0.0, r.rank) for r in df.collect()}


@pytest.mark.parametrize("ways", [{}, BLOCKS], ids=["one tile", "tiles"])
@pytest.mark.parametrize("k,min_score,skip_self", [(1, None, False), (5, None, True), (25, 0.2, True), (100, None, False)])
def test_top_k_is_exact(spark, ways, k, min_score, skip_self):
    index, queries = corpus(), corpus(25, seed=5)
    got = retrieval.top_k(
        frame(spark, index).repartition(4), frame(spark, queries), k,
        index_cols=COLS, query_cols=COLS, min_score=min_score, skip_self=skip_self, **ways,
    )
    assert hits(got) == plain_top_k(index, queries, k, min_score, skip_self)


def test_runs_are_searched_apart(spark):
    parts = {3: corpus(40, seed=1), 5: corpus(25, seed=2), 9: corpus(30, seed=3)}
    rows = [(run, i, [float(x) for x in v]) for run, own in parts.items() for i, v in own]
    index = spark.createDataFrame(rows, "run int, id bigint, v array<double>").repartition(3)
    queries, k = corpus(12), {3: 2, 5: 6, 9: 1}
    got = retrieval.top_k_by_run(index, frame(spark, queries), k, index_cols=COLS, query_cols=COLS, query_tile=5, index_tile=7, cell_pairs=2)
    assert got.columns == ["run", "query_id", "id", "score", "rank"]
    want = {(run, *hit) for run, own in parts.items() for hit in plain_top_k(own, queries, k[run])}
    assert {(r.run, r.query_id, r.id, r.score + 0.0, r.rank) for r in got.collect()} == want


def test_small_batches_give_the_same_hits(spark):
    index, queries = corpus(200), corpus(10)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "9")
    try:
        got = hits(retrieval.top_k(frame(spark, index), frame(spark, queries), 5, index_cols=COLS, query_cols=COLS))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == plain_top_k(index, queries, 5)


@pytest.mark.parametrize("ways", [{}, BLOCKS], ids=["one tile", "tiles"])
def test_text_ids(spark, ways):
    index = [(f"c{i:02d}é", v) for i, v in corpus(30)]
    got = retrieval.top_k(frame(spark, index, "string"), frame(spark, corpus(5)), 3, index_cols=COLS, query_cols=COLS, **ways)
    assert hits(got) == plain_top_k(index, corpus(5), 3)


def test_missing_vectors_and_empty_sides(spark):
    index = frame(spark, corpus(10))
    holes = index.unionByName(spark.createDataFrame([(99, None)], "id bigint, v array<double>"))
    assert hits(retrieval.top_k(holes, index, 2, index_cols=COLS, query_cols=COLS)) == plain_top_k(corpus(10), corpus(10), 2)
    none = index.limit(0)
    assert retrieval.top_k(index, none, 2, index_cols=COLS, query_cols=COLS).count() == 0
    assert retrieval.top_k(none, index, 2, index_cols=COLS, query_cols=COLS).count() == 0
    assert retrieval.top_k(none, index, 2, index_cols=COLS, query_cols=COLS, **BLOCKS).count() == 0


def test_uneven_vectors_fail(spark):
    bad = frame(spark, [(1, [1.0, 2.0]), (2, [1.0])])
    with pytest.raises(Exception, match="one length"):
        retrieval.top_k(bad, frame(spark, [(1, [1.0, 2.0])]), 1, index_cols=COLS, query_cols=COLS).collect()


def test_diverse_top_k_against_plain_loop(spark):
    rng = np.random.default_rng(3)
    index = [(i, rng.normal(size=4)) for i in range(40)]
    queries = index[:6]
    weight, k, fetch = 0.7, 4, 9
    got = retrieval.diverse_top_k(frame(spark, index), frame(spark, queries), k, fetch, weight, index_cols=COLS, query_cols=COLS)
    vec = {i: v / np.linalg.norm(v) for i, v in index}
    expected = set()
    for q, _ in queries:
        cands = sorted((i, s) for qq, i, s, _ in plain_top_k(index, queries, fetch) if qq == q)
        chosen = []
        while len(chosen) < k:
            scored = []
            for i, s in cands:
                if i not in chosen:
                    closest = max((round(float(vec[i] @ vec[c]), 6) for c in chosen), default=0.0)
                    scored.append((-round(weight * s - (1 - weight) * closest, 9), i))
            best = min(scored)
            chosen.append(best[1])
            expected.add((q, len(chosen), best[1], -best[0]))
    assert {(r.query_id, r.step, r.id, r.mmr_score) for r in got.collect()} == expected


def test_recall(spark):
    hits_df = spark.createDataFrame([(1, 2, 0.9, 1), (1, 3, 0.8, 2), (2, 1, 0.7, 1)], "query_id bigint, id bigint, score double, rank bigint")
    labels = spark.createDataFrame([(1, 0), (2, 0), (3, 1), (4, 0)], "id bigint, label int")
    got = {r.query_id: (r.n_hits, r.n_relevant, r.recall) for r in retrieval.recall_at_k(hits_df, 1, labels, labels).collect()}
    assert got == {1: (1, 2, 0.5), 2: (1, 2, 0.5), 3: (0, 0, None), 4: (0, 2, 0.0)}


def test_index_sync(spark, tmp_path):
    before = spark.createDataFrame([(1, "alpha"), (2, "beta"), (3, "gamma")], "k bigint, t string")
    after = spark.createDataFrame([(2, "beta"), (3, "gamma ray"), (4, "delta")], "k bigint, t string")
    index = retrieval.write_index(retrieval.index_rows(before, "k", "t"), "sync_test", str(tmp_path / "index"), "k", 1)
    plan = retrieval.sync_plan(index, after, "k", "t")
    shuffles = plan._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")
    assert shuffles == 1  # the source side only, the index is bucketed by key
    assert {r.k: r.action for r in plan.collect()} == {1: "delete", 2: "keep", 3: "update", 4: "insert"}
    changed = retrieval.embed_changes(plan, "k").filter("embedding IS NOT NULL")
    assert {r.k for r in changed.collect()} == {3, 4}

    marked = index.withColumn("embedding", F.array(F.lit(-1.0)))
    synced = {r.k: r.embedding for r in retrieval.apply_sync(marked, after, "k", "t").collect()}
    rebuilt = {r.k: r.embedding for r in retrieval.index_rows(after, "k", "t").collect()}
    assert synced.pop(2) == [-1.0] and rebuilt.pop(2)
    assert synced == rebuilt
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = retrieval.apply_sync(index, after, "k", "t")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == 1  # stored vectors stay where they are


def test_copies_of_tiles_follow_the_cluster(spark, monkeypatch):
    """Four times the vectors in four times the tiles: each tile is copied as often as before."""
    dealt = []
    kept = retrieval.join_tiles
    monkeypatch.setattr(retrieval, "join_tiles", lambda asked, own, *a, **b: dealt.append(asked.count() + own.count()) or kept(asked, own, *a, **b))
    for n in (60, 240):
        rows = frame(spark, corpus(n))
        retrieval.top_k(rows, rows, 2, index_cols=COLS, query_cols=COLS, skip_self=True, query_tile=2, index_tile=2, cell_pairs=1)
    assert dealt[1] <= 4.5 * dealt[0]


def test_index_rows_of_a_cell_are_bounded():
    rows, columns = retrieval._grid(1, 4000, 4000 << 20, 12, 64)
    assert rows == 1 and columns == 125  # 32 MB each
    assert retrieval._grid(5000, 5000, 2500 << 20, 12, 1) == (1, 79)


def test_long_vectors_make_small_tiles(spark):
    wide = spark.range(600).select("id", F.array_repeat(F.col("id").cast("double") + 1, 2000).alias("vec")).coalesce(1)
    tiles = retrieval.pack_tiles(wide, 8192)
    assert tiles.agg(F.sum("n")).first()[0] == 600
    assert tiles.filter(F.octet_length("rows") > 1 << 20).count() == 0 and tiles.filter("size <> octet_length(rows)").count() == 0


def test_repeated_ids_are_all_skipped(spark):
    rows = corpus(30) + corpus(30)[:9]
    got = retrieval.top_k(frame(spark, rows), frame(spark, corpus(30)), 4, index_cols=COLS, query_cols=COLS, skip_self=True)
    found = got.collect()
    assert len(found) == 30 * 4 and all(r.id != r.query_id for r in found)
