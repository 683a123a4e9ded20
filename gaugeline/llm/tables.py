"""Tables written between steps, and connected components of a link table."""

from __future__ import annotations

import contextlib
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeline import storage
from gaugeline.session import scratch_path


def written(df: DataFrame, name: str, paths: list[str] | None = None) -> DataFrame:
    """``df`` written to the shared scratch folder and read again: cuts the lineage, survives lost
    executors. The path is added to ``paths``, for :func:`discard`."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    if paths is not None:
        paths.append(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, paths: list[str]) -> None:
    """Delete written tables that nothing reads any more."""
    while paths:
        storage.delete(spark, paths.pop())


@contextlib.contextmanager
def bucketed(df: DataFrame, key: str) -> Iterator[DataFrame]:
    """``df`` written in buckets by ``key``, so that joins on it do not shuffle it again. The table is
    known to the session while the block runs; nothing lazy may outlive it."""
    spark = df.sparkSession
    path = scratch_path(spark, "buckets")
    name = "buckets_" + path.rpartition("-")[2]
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.repartition(n, key).write.bucketBy(n, key).sortBy(key).option("path", path).saveAsTable(name)
    try:
        yield spark.table(name)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        storage.delete(spark, path)


def unused(df: DataFrame, *names: str) -> list[str]:
    """Names for working columns, made from ``names``, that no column of ``df`` has in any case."""
    taken, found = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        found.append(name)
    return found


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def components(links: DataFrame, name: str = "links") -> DataFrame:
    """Connected components of the links ``(a, b)`` of longs: rows ``(node, component)`` for each node
    that occurs, ``component`` being the smallest node that links reach.

    Alternates large-star and small-star steps, each a shuffle of the links by node, until every node has
    one link. The links shrink towards one for each node. Both joins are plain equi-joins with a
    table that has one row a key, so adaptive execution may split a node with very many links.
    Links of a node with itself stand for a lone node. Rows with a null end are left out.
    """
    edges = written(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .where(F.col("a").isNotNull() & F.col("b").isNotNull()).distinct(), name, old := [])
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
        large = written(both.where("v >= u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")), name, old)
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = written(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), name, new := [])
        discard(edges.sparkSession, old)
        old = new
        # Every smallest node has a link with itself, so one link a node means that all are stars.
        if edges.groupBy("u").agg(F.count("*").alias("n")).where("n > 1").isEmpty():
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
