"""Streams of JSON lines whose columns change: new ones are added, and values that don't fit are kept aside.

The columns are kept in versions beside the checkpoint. A batch whose rows have columns that the last version lacks writes
a new one, with a type that all their values in the batch fit; a column keeps its type from then on. A value that does not
fit, and a line that is no JSON object, go to the rescue column as text, so nothing that arrived is lost.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from foliomill.sources.buckets import read_if_there

RESCUED = "_rescued"
TYPES = ("bigint", "double", "string")  # of a new column: the first that fits all its values
_VERSIONS = "columns string, version bigint"
_LINE = "_line"


def _fields(line: Column) -> Column:
    """Names and values of a JSON object, values as their text; null for other lines."""
    return F.from_json(line, "map<string,string>")


def columns(spark: SparkSession, location: str, before: int | None = None) -> dict[str, str]:
    """Names and types of the newest version, or of the newest under ``before``, in the order in which they came."""
    found = read_if_there(spark, _VERSIONS, f"{location}/columns")
    if before is not None:
        found = found.filter(F.col("version") < before)
    newest = found.agg(F.max_by("columns", "version")).first()[0]
    return {} if newest is None else dict(json.loads(newest))


def _evolved(batch: DataFrame, known: dict[str, str]) -> dict[str, str]:
    """``known`` and the columns that only this batch has, by name: as many rows reach the driver as there are columns."""
    fields = batch.select(F.explode("_fields").alias("name", "value")).filter(~F.col("name").isin([*known, RESCUED, _LINE]))
    fits = [F.every(F.col("value").isNull() | F.expr(f"try_cast(value AS {t})").isNotNull()).alias(t) for t in TYPES[:-1]]
    found = fields.groupBy("name").agg(F.count("value").alias("_values"), *fits).filter("_values > 0").collect()
    return known | {r["name"]: next((t for t in TYPES[:-1] if r[t]), TYPES[-1]) for r in sorted(found, key=lambda r: r["name"])}


def _typed(batch: DataFrame, known: dict[str, str]) -> DataFrame:
    """Rows with the known columns, and what doesn't fit them in the rescue column."""
    value = lambda name: F.try_element_at("_fields", F.lit(name))
    cast = {name: value(name).try_cast(t) for name, t in known.items()}
    misfits = F.map_filter("_fields", lambda name, v: v.isNotNull() & F.coalesce(F.element_at(_misfit(known), name), F.lit(True)))
    whole = F.when(F.col("_fields").isNull(), F.to_json(F.create_map(F.lit(_LINE), F.col("value"))))
    rest = F.when(F.size(misfits) > 0, F.to_json(misfits))
    return batch.select(*[c.alias(n) for n, c in cast.items()], F.coalesce(whole, rest).alias(RESCUED))


def _misfit(known: dict[str, str]) -> Column:
    """By name, whether a row's value can't be cast to the column's type."""
    pairs = []
    for name, t in known.items():
        value = F.try_element_at("_fields", F.lit(name))
        pairs += [F.lit(name), value.isNotNull() & value.try_cast(t).isNull()]
    return F.create_map(*pairs) if pairs else F.lit(None).cast("map<string,boolean>")


def land_batch(batch: DataFrame, batch_id: int, target: str) -> None:
    """Store one batch of lines (column ``value``). A batch that runs again replaces its rows and its version."""
    spark = batch.sparkSession
    batch = batch.select("value", _fields(F.col("value")).alias("_fields"))
    before = columns(spark, target, before=batch_id)
    known = _evolved(batch, before)
    _typed(batch, known).write.mode("overwrite").parquet(f"{target}/rows/batch_id={batch_id}")
    version = spark.createDataFrame([(json.dumps(list(known.items())),)], "columns string").coalesce(1)
    version.write.mode("overwrite").parquet(f"{target}/columns/version={batch_id}")


def ingest_lines(spark: SparkSession, folder: str, target: str, glob: str = "*.json") -> None:
    """Drain the files below ``folder`` that have arrived since the last call."""
    stream = spark.readStream.option("pathGlobFilter", glob).option("recursiveFileLookup", "true").text(folder)
    query = (
        stream.writeStream.foreachBatch(lambda batch, batch_id: land_batch(batch, batch_id, target))
        .option("checkpointLocation", f"{target}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def read_lines(spark: SparkSession, target: str) -> DataFrame:
    """All rows under the newest columns; a row that came before a column has null there."""
    ddl = ", ".join(f"`{n}` {t}" for n, t in [*columns(spark, target).items(), (RESCUED, "string"), ("batch_id", "bigint")])
    return read_if_there(spark, StructType.fromDDL(ddl), f"{target}/rows").drop("batch_id")
