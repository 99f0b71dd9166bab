"""Tables in hash buckets of a key: a change reads and replaces only the buckets that it touches.

A version writes the new content of its buckets to a folder of its own and then a manifest, which names for every bucket
the version that holds it. Readers go by the newest manifest, so a job that is lost half-way leaves the table as it was,
and one that is repeated replaces its own folder. Old folders stay readable until they are removed.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

BUCKET = "_bucket"
_NONE = -1  # stands in a manifest so that an empty one has a row
_MANIFEST = f"{BUCKET} int, held bigint, version bigint"


def read_if_there(spark: SparkSession, schema: StructType | str, path: str) -> DataFrame:
    """The table at ``path``, empty where nothing has been written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


@dataclass(frozen=True)
class BucketTable:
    """Place and shape of a table. The number of buckets never changes; choose it so that one bucket fits a task."""

    root: str
    keys: tuple[str, ...]
    schema: StructType
    n_buckets: int

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.n_buckets)).cast("int")

    def touched(self, changes: DataFrame) -> list[int]:
        """Buckets that the keys of some rows fall into: ``n_buckets`` numbers at most."""
        return sorted(r[0] for r in changes.select(self.bucket().alias(BUCKET)).distinct().collect())

    def manifest(self, spark: SparkSession, before: int | None = None) -> dict[int, int]:
        """Version that holds each bucket, by the newest manifest, or the newest of a version under ``before``."""
        found = read_if_there(spark, _MANIFEST, f"{self.root}/manifests")
        if before is not None:
            found = found.filter(F.col("version") < before)
        newest = found.agg(F.max("version")).first()[0]
        if newest is None:
            return {}
        rows = found.filter(F.col("version") == newest).collect()
        return {r[BUCKET]: r["held"] for r in rows if r[BUCKET] != _NONE}

    def read(self, spark: SparkSession, buckets: Sequence[int] | None = None, before: int | None = None) -> DataFrame:
        """Rows of the table, or of some buckets: no file of another bucket is opened."""
        held = self.manifest(spark, before)
        wanted = sorted(held if buckets is None else set(buckets) & set(held))
        if not wanted:
            return spark.createDataFrame([], self.schema)
        paths = [f"{self.root}/data/version={held[b]}/{BUCKET}={b}" for b in wanted]
        return spark.read.schema(self.schema).parquet(*paths)

    def replace(self, rows: DataFrame, buckets: Sequence[int], version: int) -> None:
        """Make ``rows`` the whole content of ``buckets``, a file each. A bucket without rows is empty from then on."""
        spark = rows.sparkSession
        held = self.manifest(spark, before=version)
        dealt = rows.select(*self.schema.names).withColumn(BUCKET, self.bucket()).repartition(BUCKET)
        dealt.write.mode("overwrite").partitionBy(BUCKET).parquet(path := f"{self.root}/data/version={version}")
        written = spark.read.schema(f"{BUCKET} int").parquet(path).distinct().collect()
        written = {r[0] for r in written}
        if not written <= set(buckets):
            raise ValueError(f"rows of buckets that were not read: {sorted(written - set(buckets))[:5]}")
        kept = [(b, v) for b, v in held.items() if b not in set(buckets)]
        lines = [*kept, *((b, version) for b in sorted(written)), (_NONE, version)]
        manifest = spark.createDataFrame(lines, f"{BUCKET} int, held bigint").coalesce(1)
        manifest.write.mode("overwrite").parquet(f"{self.root}/manifests/version={version}")
