"""Table sinks: typed overwrites and snapshots. Every write goes to a path of its own."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def conform(df: DataFrame, schema: StructType | str) -> DataFrame:
    """Columns of ``schema``, in its order and with its types."""
    declared = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in declared.fields])


def overwrite_table(df: DataFrame, path: str, schema: StructType | str | None = None) -> DataFrame:
    """Replace the table at ``path`` and return it as read back; ``df`` must not read from ``path``."""
    typed = df if schema is None else conform(df, schema)
    typed.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(typed.schema).parquet(path)


def save_table(df: DataFrame, name: str, path: str, schema: StructType | str | None = None) -> DataFrame:
    """Overwrite a catalog table stored at ``path``."""
    typed = df if schema is None else conform(df, schema)
    typed.write.mode("overwrite").option("path", path).saveAsTable(name)
    return df.sparkSession.table(name)


def snapshot_table(df: DataFrame, name: str, path: str) -> DataFrame:
    """``CREATE TABLE ... AS SELECT`` of a derived table."""
    spark = df.sparkSession
    view = f"{name}_source"
    df.createOrReplaceTempView(view)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{path}' AS SELECT * FROM {view}")
    spark.catalog.dropTempView(view)
    return spark.table(name)
