"""The corpus pipeline: every stage against a plain statement of what it keeps, over odd rows and clashing columns."""

import random
import struct

import public_tokenizers
import pytest

import corpus_pipeline
from foliomill.llm import queries
from test_dedup import expected_near
from test_filters import expected_hits

BENCHMARK = [(1, "this sentence of the benchmark has exactly twelve words in it you see"), (2, "short item"), (3, None)]


@pytest.fixture(scope="module")
def stage_docs(spark, texts, tmp_path_factory):
    """The odd rows with passages of the benchmark, and columns named as the stages' own."""
    rows = [*texts, (300, f"before it. {BENCHMARK[0][1].upper()}! and after"), (301, "a short, item here"), (302, "nothing of that")]
    path = str(tmp_path_factory.mktemp("stage") / "documents.parquet")
    schema = "doc_id long, text string, _row long, _PLACE_in_stage string, kept boolean, id int, component_id string"
    spark.createDataFrame([(i, t, 7, "x", False, 3, "y") for i, t in rows], schema).repartition(3).write.parquet(path)
    return spark.read.parquet(path), rows


@pytest.fixture(scope="module")
def sf_folder(spark, stage_docs, tmp_path_factory):
    folder = tmp_path_factory.mktemp("sf")
    spark.createDataFrame(BENCHMARK, "item_id long, text string").write.parquet(str(folder / "benchmark.parquet"))
    rng = random.Random(1)
    labels = [(i, rng.randrange(2), 0) for i, _ in stage_docs[1] if i is not None]
    spark.createDataFrame([*labels, (None, 1, 0), (1, None, 0)], "doc_id long, quality int, toxic int").write.parquet(str(folder / "labels.parquet"))
    stage_docs[0].write.parquet(str(folder / "documents.parquet"))
    return str(folder)


def kept(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=repr)


def check_columns(found, docs):
    assert found.columns == docs.columns
    assert {tuple(r)[2:] for r in found.collect()} <= {(7, "x", False, 3, "y")}


def test_good_quality(spark, stage_docs, sf_folder):
    docs, rows = stage_docs
    found = corpus_pipeline.good_quality(spark, docs, sf_folder)
    check_columns(found, docs)
    scores = queries.quality_scores(docs, queries.learn(docs, queries.table(spark, sf_folder, "labels"))).collect()
    assert len(scores) == len(rows) and found.count() == sum(r.predicted for r in scores)


def test_without_copies(spark, stage_docs, sf_folder):
    docs, rows = stage_docs
    found = corpus_pipeline.without_copies(spark, docs, sf_folder)
    check_columns(found, docs)
    owners = {}
    for i, t in rows:
        owners[t or ""] = max(owners.get(t or "", -1), -1 if i is None else i)
    want = [(None if i == -1 else i, t) for t, i in owners.items()]
    assert sorted(((i, t or "") for i, t in kept(found)), key=repr) == sorted(want, key=repr)


def test_without_near_copies(spark, stage_docs, sf_folder):
    docs, rows = stage_docs
    found = corpus_pipeline.without_near_copies(spark, docs, sf_folder)
    check_columns(found, docs)
    # ids of the rows by their place among equal ids, nulls first: the smallest of a group stays
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is not None, rows[k][0] or 0, k))
    place = {k: n for n, k in enumerate(order)}
    want = {r[0] for r in expected_near([(place[k], t) for k, (_, t) in enumerate(rows)]) if r[3]}
    ids = sorted((rows[k][0] for k in range(len(rows)) if place[k] in want), key=repr)
    assert sorted((r.doc_id for r in found.collect()), key=repr) == ids


def test_without_leaks(spark, stage_docs, sf_folder):
    docs, rows = stage_docs
    found = corpus_pipeline.without_leaks(spark, docs, sf_folder)
    check_columns(found, docs)
    want = [(i, t) for i, t in rows if not expected_hits([(i, t)], BENCHMARK)[0][-1]]
    assert 0 < len(want) < len(rows) and kept(found) == sorted(want, key=repr)


def test_encoded(spark, stage_docs, sf_folder):
    from tokenizers import Tokenizer

    docs, rows = stage_docs
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = sorted(((r.doc_id, r.n_tokens, bytes(r.token_ids)) for r in corpus_pipeline.encoded(spark, docs, sf_folder).collect()), key=repr)
    want = [(i, len(ids := library.encode(t or "", add_special_tokens=False).ids), struct.pack(f"<{len(ids)}I", *ids)) for i, t in rows]
    assert got == sorted(want, key=repr)


def test_run_without_further_columns(spark, sf_folder, tmp_path):
    """The table as it comes: the stages' own columns meet none of the operators'."""
    folder = tmp_path / "plain"
    for name in ("documents", "benchmark", "labels"):
        table = spark.read.parquet(f"{sf_folder}/{name}.parquet")
        (table.select("doc_id", "text") if name == "documents" else table).write.parquet(f"{folder}/{name}.parquet")
    want = sorted((r.doc_id for r in corpus_pipeline.run(spark, sf_folder).collect()), key=repr)
    assert sorted((r.doc_id for r in corpus_pipeline.run(spark, str(folder)).collect()), key=repr) == want


def test_run_and_empty_tables(spark, stage_docs, sf_folder, tmp_path):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality classifier", "exact dedup", "MinHash near-dedup", "benchmark decontamination", "BPE encoding and decoding"]
    docs = stage_docs[0]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.stored(stage(spark, docs, sf_folder), "stage")
    want = sorted((r.doc_id for r in docs.collect()), key=repr)
    assert sorted((r.doc_id for r in corpus_pipeline.run(spark, sf_folder).collect()), key=repr) == want
    none = stage_docs[0].filter("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, sf_folder).count() == 0
