import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from foliomill.operators import ivf, retrieval
from foliomill.plans import queries


def frame(spark, rows, id_type="bigint"):
    return spark.createDataFrame([(i, None if v is None else [float(x) for x in v]) for i, v in rows], f"id {id_type}, vec array<double>")


def clustered(n=600, dim=8, seed=2):
    """Clusters, a third of all rows one vector, a zero vector."""
    rng = np.random.default_rng(seed)
    rows = rng.normal(size=(12, dim))[rng.integers(0, 12, n)] + 0.3 * rng.normal(size=(n, dim))
    rows[: n // 3] = rows[0]
    rows[-1] = 0
    return list(enumerate(rows))


def hits(df):
    return {(r.query_id, r.id, r.score + 0.0, r.rank) for r in df.collect()}


def exact(spark, index, asked, k, **more):
    cols = ("id", "vec")
    return retrieval.top_k(index, asked, k, index_cols=cols, query_cols=cols, **more)


@pytest.mark.parametrize("id_type", ["bigint", "string"])
def test_all_files_give_the_exact_hits(spark, id_type):
    rows = [(i if id_type == "bigint" else f"v{i:04d}", v) for i, v in clustered()]
    vectors = frame(spark, [*rows, (None, rows[0][1]), (rows[3][0] * 2, None)], id_type).repartition(3)
    asked = frame(spark, rows[::20], id_type)
    centroids = ivf.fit_centroids(vectors, n_lists=9)
    index = ivf.build_ivf(vectors, centroids, strip_rows=40, tile_rows=16)
    assert index.tiles.agg(F.sum("n")).first()[0] == len(rows)
    assert index.tiles.agg(F.max("n")).first()[0] <= 16
    assert index.strips.filter("strips > 3").count()  # the file of the frequent vector
    got = ivf.ivf_top_k(index, asked, 5, n_probe=len(centroids.rows), skip_self=True, query_tile=7)
    assert hits(got) == hits(exact(spark, frame(spark, rows, id_type), asked, 5, skip_self=True))


def test_recall_with_the_measured_probes(spark):
    rng = np.random.default_rng(8)
    rows = list(enumerate(rng.normal(size=(3000, 16))))
    vectors = frame(spark, rows).repartition(4)
    asked = vectors.filter("id % 20 = 0")
    centroids = ivf.fit_centroids(vectors, fit_rows=1000)
    assert 1 < centroids.n_probe < len(centroids.rows)
    counts = ivf.recall_of(ivf.ivf_top_k(ivf.build_ivf(vectors, centroids), asked, 10), exact(spark, vectors, asked, 10)).first()
    assert counts.n_queries == 150 and counts.n_wanted == 1500 and counts.n_found >= 0.9 * 1500
    one = ivf.recall_of(ivf.ivf_top_k(ivf.build_ivf(vectors, centroids), asked, 10, n_probe=1), exact(spark, vectors, asked, 10)).first()
    assert one.n_found < counts.n_found


def test_registered_recall(spark, sf_dir):
    found, wanted = queries._ivf_hits(spark, sf_dir)
    counts = ivf.recall_of(found, wanted).first()
    assert counts.n_wanted > 0 and counts.n_found >= 0.9 * counts.n_wanted


def test_empty_sides(spark):
    none, some = frame(spark, []), frame(spark, clustered(40))
    index = ivf.build_ivf(none, ivf.fit_centroids(none))
    assert ivf.ivf_top_k(index, some, 3).count() == 0
    index = ivf.build_ivf(some, ivf.fit_centroids(some))
    assert ivf.ivf_top_k(index, none, 3).count() == 0
    assert ivf.recall_of(ivf.ivf_top_k(index, none, 3), exact(spark, some, none, 3)).first().n_queries == 0


def test_sample_is_bounded(spark):
    vectors = frame(spark, clustered(600))
    assert len(ivf.fit_centroids(vectors, fit_rows=100).rows) <= 100 // 32 + 1


def test_vectors_are_filed_a_few_at_a_time(spark, monkeypatch):
    """What a query is copied to is handed on in parts, whatever the number of files it looks into."""
    rows = clustered(400)
    vectors = frame(spark, rows).coalesce(1)
    centroids = ivf.fit_centroids(vectors, n_lists=12)
    want = {tuple(r) for r in ivf._filed(vectors, centroids, 5).select("list", "id").collect()}
    monkeypatch.setattr(ivf, "SCORE_CELLS", 400)
    made = []
    kept = type(vectors).mapInArrow
    monkeypatch.setattr(type(vectors), "mapInArrow", lambda self, f, schema: made.append(f) or kept(self, f, schema))
    assert {tuple(r) for r in ivf._filed(vectors, centroids, 5).select("list", "id").collect()} == want
    batch = pa.RecordBatch.from_arrays([pa.array(range(400)), pa.array([[float(x) for x in v] for _, v in rows])], names=["id", "vec"])
    assert max(b.num_rows for b in made[0]([batch])) <= 50
