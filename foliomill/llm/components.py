"""Connected components of a stored list of links, by alternating stars."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliomill.session import fresh_path


def stored(df: DataFrame, purpose: str, share: int = 1) -> DataFrame:
    """``df`` written to the shared folder and read back: a lost executor never sends later steps back to its sources.

    Tables that are small beside the documents, such as links, are written by one of ``share`` shuffle partitions each.
    """
    spark = df.sparkSession
    if share > 1:
        df = df.coalesce(max(1, int(spark.conf.get("spark.sql.shuffle.partitions")) // share))
    df.write.parquet(path := fresh_path(spark, purpose))
    return spark.read.schema(df.schema).parquet(path)


CHUNK = 1 << 18
LINKS = 8  # share of the shuffle partitions that write links and labels
ROWS = 4  # and of those that write rows of some hundred bytes


def _least(links: DataFrame) -> DataFrame:
    """``u, m``: the least of a node and its neighbours."""
    return links.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))


def _pairs(df: DataFrame, *pairs: tuple) -> DataFrame:
    """``u, v`` of several pairs of a row, without equal ends."""
    ends = F.explode(F.array(*[F.struct(F.col(u).alias("u"), F.col(v).alias("v")) for u, v in pairs]))
    return df.select(ends.alias("_p")).select("_p.u", "_p.v").filter("u <> v")


def _large_star(links: DataFrame) -> DataFrame:
    both = _pairs(links, ("u", "v"), ("v", "u"))
    return both.join(_least(both), "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    return _pairs(down.join(_least(down), "u"), ("v", "m"), ("u", "m")).distinct()


def _contracted(links: DataFrame) -> DataFrame:
    """Links with the same components, and fewer chains: a task leads the ends of up to ``CHUNK`` links at a time to the
    least node that they are connected with among these links."""

    def stars(u: list[int], v: list[int]) -> pa.RecordBatch:
        above: dict[int, int] = {}

        def root(x: int) -> int:
            while (up := above.get(x, x)) != x:
                above[x] = x = above.get(up, up)
            return x

        for a, b in zip(u, v, strict=True):
            a, b = root(a), root(b)
            above[max(a, b)] = min(a, b)
        ends = [(x, r) for x in list(above) if (r := root(x)) != x]
        return pa.record_batch([pa.array([e[k] for e in ends], pa.int64()) for k in (0, 1)], names=["u", "v"])

    def contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        u: list[int] = []
        v: list[int] = []
        for batch in batches:
            u += batch.column(0).to_pylist()
            v += batch.column(1).to_pylist()
            if len(u) >= CHUNK:
                yield stars(u, v)
                u, v = [], []
        if u:
            yield stars(u, v)

    return links.select("u", "v").mapInArrow(contract, "u bigint, v bigint")


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """``node, label`` for every node of ``links`` (``u, v``) that is not the least of its component; the label is.

    A node's links are only combined by minimum and joined back, so a node with very many links is never one group in a
    task. Rounds go on until the links no longer change, about as often as the logarithm of the longest chain.
    """
    links = stored(_contracted(links.filter("u <> v")).distinct(), "links", LINKS)
    before = None
    while (now := _state(links)) != before:
        before = now
        links = stored(_small_star(_large_star(links)), "links", LINKS)
    return links.select(F.col("u").alias("node"), F.col("v").alias("label"))


def with_labels(df: DataFrame, column: str, labels: DataFrame, output: str) -> DataFrame:
    """Add the label of the node in ``column``; a node without one is its own."""
    found = df.join(labels.select(F.col("node").alias(column), F.col("label").alias(output)), column, "left")
    return found.withColumn(output, F.coalesce(output, column))


def merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` after more links (``u, v``): only the components that these connect are looked at again."""
    ends = with_labels(with_labels(links, "u", labels, "_lu"), "v", labels, "_lv")
    moved = components(ends.select(F.col("_lu").alias("u"), F.col("_lv").alias("v")))
    old = with_labels(labels.withColumnRenamed("label", "_old"), "_old", moved, "label").select("node", "label")
    new = moved.join(labels.select("node"), "node", "left_anti").select("node", "label")
    return stored(old.unionByName(new), "labels", LINKS)
