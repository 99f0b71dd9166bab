"""Scorers, judges, gates, sampling and trace selection. One score per row and scorer, all as column expressions."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Sampling rates of the continuous monitor and the trace window.
MONITOR_RATES = {"safety": 1.0, "groundedness": 0.4, "relevance_to_query": 1.0, "chunk_relevance": 1.0}
TRACE_WINDOW_MINUTES = 10
SAMPLE_BUCKETS = 10_000


def _share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, F.round(part / whole, 6)).otherwise(F.lit(0.0))


def _common(a: Column, b: Column) -> Column:
    return F.size(F.array_intersect(a, b))


def correctness(answer: Column, expected: Column) -> Column:
    """F1 of the token sets of answer and expected response."""
    return _share(2 * _common(answer, expected), F.size(answer) + F.size(expected))


def covered_share(claimed: Column, support: Column) -> Column:
    """Share of ``claimed`` tokens that occur in ``support``: sufficiency of a context for the expected response,
    or groundedness of an answer in its context."""
    return _share(_common(claimed, support), F.size(claimed))


def relevance(question: Column, answer: Column) -> Column:
    """Jaccard similarity of two token sets."""
    return _share(_common(question, answer), F.size(F.array_union(question, answer)))


def chunk_relevance(question: Column, chunks: Column) -> Column:
    """Share of question tokens met by each chunk, averaged over the chunks (an array of token sets)."""
    hits = F.aggregate(chunks, F.lit(0), lambda acc, chunk: acc + _common(question, chunk))
    return _share(hits, F.size(question) * F.size(chunks))


def where_known(score: Column, *needed: str) -> Column:
    """The score where everything that it needs is there, else null."""
    there = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in needed])
    return F.when(there, score)


def missing_reason(**needed: str) -> Column:
    """What is missing, as text per column name; null if nothing is."""
    found = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(text)) for c, text in needed.items()]))
    return F.when(F.size(found) > 0, F.array_join(found, ", "))


@dataclass(frozen=True)
class Guideline:
    """Phrase rule on a response: ``must`` tells whether the pattern has to occur or must not."""

    name: str
    pattern: str
    must: bool


GUIDELINES = (
    Guideline("no_minimising_words", r"(?i)\b(simply|just|obviously)\b", False),
    Guideline("no_mention_of_context", r"(?i)\b(provided|given) (context|documents?)\b", False),
    Guideline("ends_a_sentence", r"[.!?]\s*$", True),
)


def follows(guideline: Guideline, response: Column) -> Column:
    found = response.rlike(guideline.pattern)
    return found if guideline.must else ~found


def score_guidelines(df: DataFrame, response: str, keys: Sequence[str], rules: Sequence[Guideline] = GUIDELINES) -> DataFrame:
    """``keys, guideline, passed``: one row per response and rule; the rules are a short literal list."""
    verdicts = F.array(
        *[F.struct(F.lit(r.name).alias("guideline"), follows(r, F.col(response)).cast("int").alias("passed")) for r in rules]
    )
    return df.select(*keys, F.inline(verdicts))


def safety_rate(flags: DataFrame, groups: Sequence[str], unsafe: str) -> DataFrame:
    rate = F.round(F.avg(1 - F.col(unsafe)), 6)
    return flags.groupBy(*groups).agg(F.count(F.lit(1)).alias("n_rows"), rate.alias("safety"))


def judge(df: DataFrame, model: Callable[[pd.DataFrame], pd.Series], inputs: Sequence[str], output: str) -> DataFrame:
    """Score rows with a model callable on Arrow batches of the input columns."""

    @F.pandas_udf("double")
    def call(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        for batch in batches:
            yield model(batch)

    return df.withColumn(output, call.asNondeterministic()(F.struct(*inputs)))


def judge_means(scores: DataFrame, groups: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """Mean of each metric per group, and the mean of those means."""
    means = scores.groupBy(*groups).agg(*[F.avg(m).alias(m) for m in metrics])
    overall = reduce(lambda a, b: a + b, [F.col(m) for m in metrics]) / len(metrics)
    rounded = [F.round(m, 6).alias(f"mean_{m}") for m in metrics]
    return means.select(*groups, *rounded, F.round(overall, 6).alias("mean_of_means"))


def quality_gate(metrics: DataFrame, thresholds: Mapping[str, float]) -> DataFrame:
    """Compare a one-row table of metrics with their thresholds; the gate opens only if every one is met."""
    checks = F.array(
        *[
            F.struct(
                F.lit(name).alias("metric"),
                F.round(name, 6).alias("value"),
                F.lit(float(limit)).alias("threshold"),
                F.coalesce(F.col(name) >= limit, F.lit(False)).cast("int").alias("passed"),
            )
            for name, limit in thresholds.items()
        ]
    )
    opened = F.forall("checks", lambda c: c["passed"] == 1).cast("int").alias("gate_open")
    return metrics.select(checks.alias("checks")).select(opened, F.inline("checks"))


def require_gate(gate: DataFrame) -> None:
    """Stop a job whose gate is closed. The table has one row per threshold."""
    failed = [r["metric"] for r in gate.filter("passed = 0").collect()]
    if failed:
        raise ValueError(f"quality gate closed by: {', '.join(failed)}")


def sample_bucket(request_id: Column) -> Column:
    """Stable bucket 0..9999 of a request, from the first eight hexadecimal digits of its md5."""
    return F.conv(F.substring(F.md5(request_id), 1, 8), 16, 10).cast("bigint") % SAMPLE_BUCKETS


def monitor_sample(requests: DataFrame, request_id: Column, rates: Mapping[str, float] = MONITOR_RATES, overall: float = 1.0) -> DataFrame:
    """Add one 0/1 column per judge; a request stays in or out of a sample on every run."""
    with_bucket = requests.withColumn("bucket", sample_bucket(request_id))
    for name, rate in rates.items():
        limit = round(overall * rate * SAMPLE_BUCKETS)
        with_bucket = with_bucket.withColumn(f"sampled_{name}", (F.col("bucket") < limit).cast("int"))
    return with_bucket


def score_sampled(requests: DataFrame, keys: Sequence[str], scores: Mapping[str, Column]) -> DataFrame:
    """Scores of sampled requests only: a judge outside its sample is not evaluated and leaves a null."""
    return requests.select(*keys, *[F.when(F.col(f"sampled_{n}") == 1, score).alias(n) for n, score in scores.items()])


def window_start(as_of: Column, minutes: int = TRACE_WINDOW_MINUTES) -> Column:
    """Start of the trace window before the time ``as_of``."""
    return as_of - F.expr(f"INTERVAL {int(minutes)} MINUTES")


def window_start_ms(as_of_ms: int, minutes: int = TRACE_WINDOW_MINUTES) -> Column:
    """Start of the trace window for times kept as epoch milliseconds."""
    return F.lit(as_of_ms - minutes * 60_000).cast("bigint")


def recent_traces(traces: DataFrame, time: str, status: str, start: Column) -> DataFrame:
    """Successful traces after ``start``, newest first. A literal ``start`` reaches the scan."""
    return traces.filter((F.col(time) > start) & (F.col(status) == "OK")).orderBy(F.col(time).desc())


def ranked_traces(traces: DataFrame, time: str, key: str) -> DataFrame:
    """Add ``rank``: the place of a trace from the newest on, ties by key.

    Traces are ranked within the hour and hours by their counts, so no task sees more than one hour of traces.
    """
    hourly = traces.withColumn("_hour", F.date_trunc("hour", time))
    sizes = hourly.groupBy("_hour").agg(F.count(F.lit(1)).alias("_n"))
    newer = Window.orderBy(F.col("_hour").desc()).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_hour", F.coalesce(F.sum("_n").over(newer), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("_hour").orderBy(F.col(time).desc(), key)
    ranked = hourly.join(offsets, "_hour").withColumn("rank", F.row_number().over(inside) + F.col("_before"))
    return ranked.drop("_hour", "_before")
