"""Writing a table under rules: bad rows go to a table of their own, and what was found is counted by the write itself."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

SALTS = 32
REPEATED = "repeated key"
PROBLEMS = "_problems"


@dataclass(frozen=True)
class Checked:
    """Both tables, and the rows that break each rule (``rows`` and ``good`` count all and the good ones)."""

    good: DataFrame
    bad: DataFrame
    counts: dict[str, int]


def _copies(rows: DataFrame, keys: Sequence[str], order: Sequence[str], salts: int) -> DataFrame:
    """Mark every row but the first by ``order`` of a key. Null keys repeat nothing.

    The rows of a key are numbered within salts, and then the first ones of its salts among each other, so a key that a
    third of the rows share is never sorted by one task.
    """
    salt = F.when(F.col("_clean"), F.pmod(F.xxhash64(*order), F.lit(salts)))
    known = F.col("_clean")
    for key in keys:
        known = known & F.col(key).isNotNull()
    by = [F.col(o) for o in order]
    rows = rows.withColumns({"_known": known, "_salt": salt})
    # rows that break another rule are spread by hash: their numbers mean nothing
    rows = rows.withColumn("_salt", F.when(F.col("_known"), F.col("_salt")).otherwise(-1 - F.pmod(F.xxhash64(*rows.columns), F.lit(1 << 20))))
    rows = rows.withColumn("_nr", F.row_number().over(Window.partitionBy(*keys, "_salt").orderBy(*by)))
    rows = rows.withColumn("_salt", F.when(F.col("_known") & (F.col("_nr") == 1), F.lit(salts)).otherwise(F.col("_salt")))
    rows = rows.withColumn("_nr2", F.row_number().over(Window.partitionBy(*keys, "_salt").orderBy(*by)))
    first = (F.col("_nr") == 1) & (F.col("_nr2") == 1)
    return rows.withColumn("_copy", F.col("_known") & ~first).drop("_known", "_salt", "_nr", "_nr2")


def write_checked(
    df: DataFrame,
    path: str,
    rules: Mapping[str, Column],
    keys: Sequence[str] = (),
    order: Sequence[str] = (),
    salts: int = SALTS,
) -> Checked:
    """Store the rows of ``df`` that break no rule, and the others with the names of those they break.

    A rule is a condition that good rows meet; null counts as broken. With ``keys`` the first row by ``order`` (unique
    within a key) of those that meet all rules stays and further ones break the rule ``REPEATED``. Everything happens in
    one job over ``df``: no row is read twice to be counted, and either both tables are there or none.
    """
    broken = F.array_compact(F.array(*[F.when(~F.coalesce(rule, F.lit(False)), F.lit(name)) for name, rule in rules.items()]))
    rows = df.withColumn(PROBLEMS, broken.cast("array<string>")).withColumn("_clean", F.size(PROBLEMS) == 0)
    if keys:
        rows = _copies(rows, keys, order, salts)
        rows = rows.withColumn(PROBLEMS, F.when(F.col("_copy"), F.array(F.lit(REPEATED))).otherwise(F.col(PROBLEMS))).drop("_copy")
    rows = rows.withColumn("_table", F.when(F.size(PROBLEMS) == 0, "good").otherwise("bad")).drop("_clean")
    names = [*rules, *([REPEATED] if keys else [])]
    seen = Observation()
    counted = [F.coalesce(F.sum(F.array_contains(PROBLEMS, n).cast("bigint")), F.lit(0)).alias(n) for n in names]
    good = F.coalesce(F.sum((F.col("_table") == "good").cast("bigint")), F.lit(0)).alias("good")
    rows.observe(seen, F.count(F.lit(1)).alias("rows"), good, *counted).write.mode("overwrite").partitionBy("_table").parquet(path)
    stored = df.sparkSession.read.schema(rows.schema).parquet(path)
    return Checked(
        stored.filter("_table = 'good'").drop("_table", PROBLEMS), stored.filter("_table = 'bad'").drop("_table"), dict(seen.get)
    )
