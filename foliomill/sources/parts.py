"""Tables of large rows that change by key: a change appends the rows of its keys and names the keys they replace.

A version writes its rows to a folder of its own, bucketed by key, then the keys whose earlier rows no longer count, then
one line that makes both visible. What earlier versions hold is neither shuffled nor written again; rows that were replaced
are left out when the table is read. Only the replaced keys move to do so, because the rows lie bucketed. A job that is lost
half-way leaves the table as it was, and one that is repeated replaces its own version.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from foliomill.sources.buckets import read_if_there

BUCKET_BYTES = 32 << 20  # of text that one bucket file of a version is to hold
FOLD_AFTER = 16  # versions that are read side by side before their live rows are written as one
_PART = "name string, n_files int, whole boolean, version bigint"


@dataclass(frozen=True)
class PartTable:
    """Place and shape of a table. ``n_buckets`` is the least number of bucket files of a version."""

    root: str
    keys: tuple[str, ...]
    schema: StructType
    n_buckets: int

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.n_buckets)).cast("int")

    def touched(self, changes: DataFrame) -> list[int]:
        """Buckets that the keys of some rows fall into: ``n_buckets`` numbers at most."""
        return sorted(r[0] for r in changes.select(self.bucket()).distinct().collect())

    def text_bytes(self) -> Column:
        """Bytes of text in a row."""
        sizes = [F.coalesce(F.octet_length(f.name), F.lit(0)).cast("bigint") for f in self.schema.fields if f.dataType == StringType()]
        return sum(sizes, F.lit(0).cast("bigint"))

    def files_for(self, text_bytes: int | None) -> int:
        return max(self.n_buckets, -(-(text_bytes or 0) // BUCKET_BYTES))

    def parts(self, spark: SparkSession, before: int | None = None) -> list[tuple[int, str, int]]:
        """``version, name, n_files`` of the versions that hold rows, of those under ``before`` if given, oldest first."""
        found = read_if_there(spark, _PART, f"{self.root}/parts")
        if before is not None:
            found = found.filter(F.col("version") < before)
        rows = sorted(found.collect(), key=lambda r: (r["version"], r["whole"]))
        folded = max((at for at, r in enumerate(rows) if r["whole"]), default=0)
        return [(r["version"], r["name"], r["n_files"]) for r in rows[folded:]]

    def _rows(self, spark: SparkSession, name: str, n_files: int) -> DataFrame:
        if not spark.catalog.tableExists(name):  # written by another session
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema.fields)
            by = ", ".join(f"`{k}`" for k in self.keys)
            spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({by}) INTO {n_files} BUCKETS LOCATION '{self.root}/data/{name}'")
        return spark.table(name)

    def _gone(self, spark: SparkSession, names: Sequence[str]) -> DataFrame:
        shape = StructType([self.schema[k] for k in self.keys])
        return spark.read.schema(shape).parquet(*[f"{self.root}/gone/{name}" for name in names])

    def read(
        self, spark: SparkSession, buckets: Sequence[int] | None = None, before: int | None = None, only: DataFrame | None = None
    ) -> DataFrame:
        """Rows of the table, or of some buckets, or of the keys in ``only``."""
        parts, found = self.parts(spark, before), None
        wanted = None if buckets is None else sorted(set(buckets))
        for at, (_, name, n_files) in enumerate(parts):
            rows = self._rows(spark, name, n_files)
            if wanted is not None and len(wanted) < self.n_buckets:
                rows = rows.filter(self.bucket().isin(wanted))
            if only is not None:
                rows = rows.join(only.select(*self.keys).hint("shuffle_hash"), list(self.keys), "left_semi")
            if later := [name for _, name, _ in parts[at + 1 :]]:
                rows = rows.join(self._gone(spark, later).hint("shuffle_hash"), list(self.keys), "left_anti")
            rows = rows.select(*self.schema.names)
            found = rows if found is None else found.unionByName(rows)
        return spark.createDataFrame([], self.schema) if found is None else found

    def added(self, spark: SparkSession, version: int) -> DataFrame:
        """Rows that a version appended."""
        for at, name, n_files in self.parts(spark, before=version + 1):
            if at == version:
                return self._rows(spark, name, n_files).select(*self.schema.names)
        return spark.createDataFrame([], self.schema)

    def n_files(self, spark: SparkSession, version: int) -> int:
        return next((n for at, _, n in self.parts(spark, before=version + 1) if at == version), self.n_buckets)

    def append(self, rows: DataFrame, gone: DataFrame, version: int, n_files: int) -> None:
        """Add ``rows`` as a version and let the rows that earlier versions have of the keys in ``gone`` count no longer.

        ``rows`` should lie as they come from :meth:`added` of an equally bucketed table, or be partitioned by key.
        """
        earlier = self.parts(rows.sparkSession, before=version)
        if len(earlier) >= FOLD_AFTER:
            live = self.read(rows.sparkSession, before=version)
            self._write(live, None, earlier[-1][0], max(n for _, _, n in earlier))
        self._write(rows, gone, version, n_files)

    def _write(self, rows: DataFrame, gone: DataFrame | None, version: int, n_files: int) -> None:
        """Rows, then the keys they replace, then the line that names both. Without ``gone`` they replace all rows up to this
        version, whose own line stays, so that a lost job loses nothing."""
        spark, name = rows.sparkSession, f"part_{uuid.uuid4().hex}"
        writer = rows.select(*self.schema.names).write.option("compression", "zstd").option("path", f"{self.root}/data/{name}")
        writer.bucketBy(n_files, *self.keys).saveAsTable(name)
        if gone is not None:
            gone.select(*self.keys).write.option("compression", "zstd").parquet(f"{self.root}/gone/{name}")
        part = spark.createDataFrame([(name, n_files, gone is None)], "name string, n_files int, whole boolean").coalesce(1)
        part.write.mode("append" if gone is None else "overwrite").parquet(f"{self.root}/parts/version={version}")

    def replace(self, rows: DataFrame, buckets: Sequence[int], version: int) -> None:
        """Make ``rows`` the whole content of ``buckets``. A bucket without rows is empty from then on."""
        spark = rows.sparkSession
        if not set(found := self.touched(rows)) <= set(buckets):
            raise ValueError(f"rows of buckets that were not read: {sorted(set(found) - set(buckets))[:5]}")
        gone = self.read(spark, buckets, before=version).select(*self.keys).distinct()
        n_files = self.files_for(rows.agg(F.sum(self.text_bytes())).first()[0])
        self.append(rows.repartition(n_files, *self.keys), gone, version, n_files)
