"""Plans of the registered training-data queries: where Python runs, and no nested loops."""

import pytest

from foliomill.llm import queries


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["op4_decontaminate", "op10_url_filters"])
def test_native_queries_run_no_python(spark, sf_dir, name):
    plan = plan_of(queries.REGISTRY[name](spark, sf_dir))
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


@pytest.mark.parametrize("name", ["op2_bpe_roundtrip", "op4_decontaminate", "op6_exact_dedup", "op9_token_counts", "op10_url_filters", "op12_whitened_embeddings"])
def test_no_nested_loops(spark, sf_dir, name):
    plan = plan_of(queries.REGISTRY[name](spark, sf_dir))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize("name", ["op2_bpe_roundtrip", "op7_quality_cnn", "op9_token_counts"])
def test_row_work_is_not_shuffled(spark, sf_dir, name):
    assert "Exchange hashpartitioning" not in plan_of(queries.REGISTRY[name](spark, sf_dir))
