"""Parameter sweeps: every parameter set is data of one job instead of a job of its own."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliomill.functions.text import fixed_chunks


@dataclass(frozen=True)
class ChunkParams:
    chunk_size: int
    chunk_overlap: int
    top_k: int = 4

    @property
    def run_id(self) -> str:
        return f"{self.chunk_size}/{self.chunk_overlap}/{self.top_k}"


# The parameter sets compared by default.
DEFAULT_SETS = (ChunkParams(475, 48), ChunkParams(400, 40))


def sweep_chunks(docs: DataFrame, text: str, sets: Sequence[ChunkParams]) -> DataFrame:
    """Chunk statistics per parameter set in one scan.

    The sets are a short literal list evaluated inside each row; the corpus is neither copied nor joined.
    """
    per_row = F.array(
        *[
            F.struct(
                F.lit(p.run_id).alias("run_id"),
                F.lit(p.chunk_size).alias("chunk_size"),
                F.lit(p.chunk_overlap).alias("chunk_overlap"),
                F.transform(fixed_chunks(F.col(text), p.chunk_size, p.chunk_overlap), F.length).alias("lengths"),
            )
            for p in sets
        ]
    )
    runs = docs.select(F.inline(per_row))
    return (
        runs.select("run_id", "chunk_size", "chunk_overlap", F.explode("lengths").alias("n"))
        .groupBy("run_id", "chunk_size", "chunk_overlap")
        .agg(
            F.count(F.lit(1)).alias("n_chunks"),
            F.sum("n").cast("bigint").alias("n_chars"),
            F.min("n").alias("min_chars"),
            F.max("n").alias("max_chars"),
            F.round(F.avg("n"), 6).alias("avg_chars"),
        )
    )


def chunks_by_run(docs: DataFrame, text: str, sets: Sequence[ChunkParams]) -> DataFrame:
    """Chunks of all sets in one scan: the columns of ``docs`` without the text, ``run`` (number of the set), ``chunk_ix``,
    ``content_chunk``."""
    per_row = F.array(*[F.struct(F.lit(n).alias("run"), fixed_chunks(F.col(text), p.chunk_size, p.chunk_overlap).alias("c")) for n, p in enumerate(sets)])
    runs = docs.select(*[c for c in docs.columns if c != text], F.inline(per_row))
    return runs.select("*", F.posexplode("c").alias("chunk_ix", "content_chunk")).drop("c")


def run_all(sets: Sequence[ChunkParams], run: Callable[[ChunkParams], DataFrame]) -> DataFrame:
    """Result rows of all runs in one table, tagged with their run."""
    tables = [run(p).withColumn("run_id", F.lit(p.run_id)) for p in sets]
    return reduce(lambda a, b: a.unionByName(b), tables)


def compare_runs(results: DataFrame, score: str) -> DataFrame:
    return results.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("n_results"), F.round(F.avg(score), 6).alias("mean_score"), F.max(score).alias("best_score")
    )
