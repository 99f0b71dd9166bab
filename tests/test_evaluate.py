import datetime as dt

import pytest
from pyspark.sql import functions as F

from foliomill.functions.text import token_set
from foliomill.operators import evaluate
from foliomill.operators.sweep import ChunkParams, compare_runs, run_all, sweep_chunks


def score(spark, column, **texts):
    df = spark.createDataFrame([tuple(texts.values())], ", ".join(f"{n} string" for n in texts))
    return df.select(column(*[token_set(F.col(n)) for n in texts])).first()[0]


def test_lexical_scorers(spark):
    assert score(spark, evaluate.correctness, a="red blue", e="blue green") == 0.5
    assert score(spark, evaluate.correctness, a="", e="") == 0.0
    assert score(spark, evaluate.covered_share, e="a b c", c="c b x") == 0.666667
    assert score(spark, evaluate.covered_share, e="", c="x") == 0.0
    assert score(spark, evaluate.relevance, q="a b", a="b c d") == 0.25
    assert score(spark, lambda q, c, d: evaluate.chunk_relevance(q, F.array(c, d)), q="a b", c="a", d="a b") == 0.75


def test_guidelines(spark):
    df = spark.createDataFrame([(1, "It is simply done."), (2, "The provided context says no"), (3, "Justice is done!")], "i int, r string")
    got = {(r.i, r.guideline): r.passed for r in evaluate.score_guidelines(df, "r", ["i"]).collect()}
    assert len(got) == 9
    assert got[1, "no_minimising_words"] == 0 and got[3, "no_minimising_words"] == 1
    assert got[2, "no_mention_of_context"] == 0 and got[1, "no_mention_of_context"] == 1
    assert got[2, "ends_a_sentence"] == 0 and got[3, "ends_a_sentence"] == 1


def test_gate(spark):
    metrics = spark.createDataFrame([(0.9, 0.5)], "judge double, recall double")
    shut = evaluate.quality_gate(metrics, {"judge": 0.8, "recall": 0.6})
    assert {(r.metric, r.passed, r.gate_open) for r in shut.collect()} == {("judge", 1, 0), ("recall", 0, 0)}
    with pytest.raises(ValueError, match="recall"):
        evaluate.require_gate(shut)
    opened = evaluate.quality_gate(metrics, {"judge": 0.9, "recall": 0.5})
    assert {r.gate_open for r in opened.collect()} == {1}
    evaluate.require_gate(opened)
    missing = evaluate.quality_gate(metrics.withColumn("recall", F.lit(None).cast("double")), {"recall": 0.0})
    assert missing.first().gate_open == 0


def test_sampling_is_stable_and_near_its_rate(spark):
    ids = spark.range(4000).select(F.col("id").cast("string").alias("r"))
    one = evaluate.monitor_sample(ids, F.col("r")).agg(F.avg("sampled_groundedness"), F.avg("sampled_safety")).first()
    assert abs(one[0] - 0.4) < 0.03 and one[1] == 1.0
    a = evaluate.monitor_sample(ids.repartition(5), F.col("r")).filter("sampled_groundedness = 1").select("r")
    b = evaluate.monitor_sample(ids, F.col("r")).filter("sampled_groundedness = 1").select("r")
    assert a.exceptAll(b).count() == 0 and a.count() == b.count()


def test_trace_window_defaults_to_ten_minutes(spark):
    now = dt.datetime(2024, 5, 1, 12)
    rows = [(i, now - dt.timedelta(minutes=m), s) for i, (m, s) in enumerate([(1, "OK"), (9, "OK"), (10, "OK"), (15, "OK"), (2, "ERROR")])]
    traces = spark.createDataFrame(rows, "i int, ts timestamp_ntz, status string")
    got = evaluate.recent_traces(traces, "ts", "status", evaluate.window_start(F.lit(str(now)).cast("timestamp_ntz")))
    assert [r.i for r in got.collect()] == [0, 1]
    millis = spark.createDataFrame([(1, 399_999, "OK"), (2, 400_001, "OK"), (3, 900_000, "OK")], "i int, ms bigint, status string")
    got = evaluate.recent_traces(millis, "ms", "status", evaluate.window_start_ms(1_000_000))
    assert [r.i for r in got.collect()] == [3, 2]


def test_judge_seam(spark):
    df = spark.createDataFrame([("a", "abc")], "q string, a string")
    out = evaluate.judge(df, lambda rows: rows["a"].str.len() - rows["q"].str.len(), ["q", "a"], "s")
    assert out.first().s == 2.0


def test_sweep(spark):
    docs = spark.createDataFrame([("x" * 1000,), ("y" * 10,), ("",), (None,)], "t string")
    sets = (ChunkParams(475, 50), ChunkParams(100, 20))
    got = {r.chunk_size: (r.n_chunks, r.min_chars, r.max_chars) for r in sweep_chunks(docs, "t", sets).collect()}
    assert got == {475: (4, 10, 475), 100: (14, 10, 100)}
    results = run_all(sets, lambda p: spark.range(2).select((F.col("id") * p.chunk_size).cast("double").alias("score")))
    assert {(r.run_id, r.n_results, r.mean_score) for r in compare_runs(results, "score").collect()} == {
        ("475/50/4", 2, 237.5), ("100/20/4", 2, 50.0),
    }
