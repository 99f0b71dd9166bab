"""Physical plans: what is pushed down, what is shuffled, where Python runs."""

import pytest

from foliomill.operators import keyed
from foliomill.plans import inputs, medallion, queries

# those over batches write tables before they return, and have tests of their own
QUERIES = {n: q for n, q in queries.REGISTRY.items() if q.__module__ == queries.__name__}
PYTHON = ("ArrowEvalPython", "BatchEvalPython", "MapInArrow", "MapInPandas", "FlatMapCoGroupsInArrow", "PythonMapInArrow")
WITH_PYTHON = {
    "chunk_recursive", "chunk_recursive_small", "vector_topk", "vector_topk_filtered", "vector_threshold", "vector_mmr",
    "recall_at_3", "retrieve_chunks", "quality_gate", "sweep_compare", "vector_topk_blocks", "vector_ivf_topk",
    "vector_ivf_recall", "embed_hashed", "index_sync", "index_after_sync", "gold_incremental",
}
WRITES = {"stream_ingest", "append_flow", "cdc_scd1_stream", "snapshot_ctas", "gold_table", "index_build"}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITES))
def test_no_nested_loops_and_python_only_where_declared(spark, sf_dir, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert any(node in plan for node in PYTHON) == (name in WITH_PYTHON)


@pytest.mark.parametrize("name", ["chunk_recursive", "chunk_recursive_small"])
def test_splitter_runs_once_per_text(spark, sf_dir, name):
    assert plan_of(QUERIES[name](spark, sf_dir)).count("ArrowEvalPython [") == 1


@pytest.mark.parametrize("name", ["cdc_scd1", "last_message", "memory_put"])
def test_newest_rows_combine_before_the_shuffle(spark, sf_dir, name):
    assert "partial_max_by" in plan_of(QUERIES[name](spark, sf_dir))


@pytest.mark.parametrize("name", ["vector_topk", "memory_search"])
def test_ranked_limits_shrink_rows_before_the_shuffle(spark, sf_dir, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    assert "Partial" in plan[plan.index("WindowGroupLimit") :]


@pytest.mark.parametrize("name,pushed", [
    ("filter_suffix", "StringEndsWith(url,.html)"),
    ("trace_window", "GreaterThan(ts,"),
    ("score_relevance", "EqualTo(role,user)"),
])
def test_filters_reach_the_scan(spark, sf_dir, name, pushed):
    assert pushed in plan_of(QUERIES[name](spark, sf_dir))


@pytest.mark.parametrize("name,columns", [
    ("filter_suffix", "struct<page_id:bigint,url:string>"),
    ("monitor_sample", "struct<conv_id:bigint,turn:bigint,role:string>"),
    ("trace_counts", "struct<ts:timestamp_ntz,event_type:string>"),
    ("eval_allocation", "struct<doc_id:bigint>"),
])
def test_scans_read_needed_columns_only(spark, sf_dir, name, columns):
    assert f"ReadSchema: {columns}" in plan_of(QUERIES[name](spark, sf_dir))


@pytest.mark.parametrize("name", ["chunk_fixed", "topic_enrich", "embed_hashed", "sources_render", "score_guidelines", "bronze_pages"])
def test_row_work_does_not_shuffle_by_key(spark, sf_dir, name):
    assert "hashpartitioning" not in plan_of(QUERIES[name](spark, sf_dir))


def test_large_keys_are_grouped_by_slice(spark, sf_dir):
    events = inputs.event_changes(inputs.table(spark, sf_dir, "events"))
    plan = plan_of(keyed.history_rows(events, ["user_id"], inputs.CHANGE_ORDER))
    assert "lead(ts" in plan and "Join" not in plan
    shuffles = [line for line in plan.splitlines() if "Exchange hashpartitioning(user_id" in line]
    assert sum("_slice" not in line for line in shuffles) == 1  # the first values of the slices


def test_pages_are_cut_once_and_split_once(spark, sf_dir):
    assert plan_of(QUERIES["silver_pages"](spark, sf_dir)).count("map_from_entries") == 1
    silver = medallion.silver_pages(inputs.document_files(spark, sf_dir), "txt")
    assert plan_of(medallion.gold_chunks(silver)).count("ArrowEvalPython [") == 1


def test_embedding_is_computed_once_per_chunk(spark, sf_dir):
    chunks = queries._chunk_index(spark, sf_dir).select("chunk_id", "embedding")
    assert plan_of(chunks).count("ArrowEvalPython [") == 1


def test_tiles_are_made_where_the_rows_lie(spark, sf_dir, monkeypatch):
    """Index rows are read with their filter and needed columns only, and not shuffled before they are tiles."""
    plans = []
    vectors = inputs.table(spark, sf_dir, "embeddings")
    kept = type(vectors).mapInArrow
    monkeypatch.setattr(type(vectors), "mapInArrow", lambda self, *a, **b: plans.append(plan_of(self)) or kept(self, *a, **b))
    QUERIES["vector_topk_filtered"](spark, sf_dir)
    packed = [p for p in plans if "embeddings.parquet" in p]
    assert any("EqualTo(label,3)" in p for p in packed)
    assert all("Exchange" not in p for p in packed)
    assert any("ReadSchema: struct<vec_id:bigint,embedding:array<float>>" in p for p in packed)


def test_vectors_do_not_pass_the_driver(spark, sf_dir, monkeypatch):
    vectors = inputs.table(spark, sf_dir, "embeddings")
    for name in ("toArrow", "toPandas", "collect"):
        monkeypatch.setattr(type(vectors), name, lambda self, *a, **b: pytest.fail("collected"))
    for name in ("vector_topk", "vector_topk_blocks", "vector_threshold", "vector_mmr", "recall_at_3"):
        plan = plan_of(QUERIES[name](spark, sf_dir))
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
