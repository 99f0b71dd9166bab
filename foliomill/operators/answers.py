"""Model calls that are made once: answers are kept in a table by the content of their request.

Equal requests are one request, whatever number of rows ask it and whenever. Only requests without an answer go to the
model, in parts of bounded size, and the answers of a part are stored before the next one begins and before anything is
joined to them: what fails later, or runs again, finds them there.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foliomill.session import fresh_path
from foliomill.sources.buckets import read_if_there
from foliomill.sources.tables import overwrite_table

STORE = "request_hash string, answer string, run bigint"
PART_ROWS = 100_000  # requests that are sent before their answers are stored


def request_hash(request: Column) -> Column:
    return F.sha2(request, 256)


def answers(spark: SparkSession, store: str) -> DataFrame:
    """``request_hash, answer, run``: all answers so far, one per request."""
    return read_if_there(spark, STORE, f"{store}/answers").select("request_hash", "answer", "run")


def _call(requests: DataFrame, model: Callable[[pd.Series], pd.Series]) -> DataFrame:
    def call(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            replies = model(batch.column(1).to_pandas())
            if len(replies) != batch.num_rows:
                raise ValueError(f"the model gave {len(replies)} answers to {batch.num_rows} requests")
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(replies, pa.string(), from_pandas=True)], names=["request_hash", "answer"])

    return requests.select("request_hash", "request").mapInArrow(call, "request_hash string, answer string")


def ask_missing(requests: DataFrame, store: str, model: Callable[[pd.Series], pd.Series], run: int, part_rows: int = PART_ROWS) -> int:
    """Call the model for the requests (column ``request``) that have no answer yet; returns how many were sent.

    ``model`` gets batches of requests and gives an answer or null for each; a null is no answer, and its request is sent
    again by the next run. Null requests are never sent. A run that is repeated after a failure sends what is missing.
    """
    spark = requests.sparkSession
    asked = requests.filter(F.col("request").isNotNull()).select(request_hash(F.col("request")).alias("request_hash"), "request")
    asked = asked.groupBy("request_hash").agg(F.min("request").alias("request"))
    missing = overwrite_table(asked.join(answers(spark, store), "request_hash", "left_anti"), fresh_path(spark, "requests"))
    total = missing.count()
    parts = -(-total // part_rows)
    for part in range(parts):
        own = missing.filter(F.pmod(F.xxhash64("request_hash"), F.lit(parts)) == part)
        landed = _call(own, model).filter("answer IS NOT NULL").withColumn("run", F.lit(run).cast("bigint"))
        landed.write.mode("append").parquet(f"{store}/answers")
    return total


def infer_once(
    df: DataFrame, request: Column, store: str, model: Callable[[pd.Series], pd.Series], run: int, part_rows: int = PART_ROWS
) -> DataFrame:
    """``df`` with ``answer`` and the ``run`` that got it, null where the request is null or has no answer.

    A request that very many rows share is one row of the join's smaller side.
    """
    asked = df.withColumn("_request", request)
    ask_missing(asked.select(F.col("_request").alias("request")), store, model, run, part_rows)
    found = asked.withColumn("request_hash", request_hash(F.col("_request"))).drop("_request")
    return found.join(answers(df.sparkSession, store), "request_hash", "left").drop("request_hash")
