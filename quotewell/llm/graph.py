"""Connected components of a graph of edges, each node's label being its smallest node; tables in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from quotewell.session import shared_dir


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows written to the shared folder and read again: lost executors cost no more than one task's work."""
    df.write.parquet(path := shared_dir(df.sparkSession, label))
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unused(df: DataFrame, name: str) -> str:
    """The name, with as many underscores before it as it takes to be none of the columns."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name = "_" + name
    return name


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, label) of every node with an edge, by alternating large and small stars until nothing changes.

    Minima are counted before the shuffle; the joins on a hot node are plain equi-joins, which Spark may split.
    """
    pairs = stored(edges.filter(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "edges")
    before = None
    while True:
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        # Large star: every larger neighbour of u is linked to the smallest of u and its neighbours.
        large = both.filter(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stored(large.filter("u != v").distinct(), "large")
        # Small star: u and its smaller neighbours are linked to the smallest of them.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", "m")).filter("u != v").distinct()
        pairs = stored(small, "small")
        now = pairs.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x"), F.bit_xor(F.xxhash64("v", "u")).alias("y")).first()
        if now == before:
            break
        before = now
    labels = pairs.groupBy("u").agg(F.min("v").alias("label")).withColumnRenamed("u", "node")
    return labels.union(labels.select(F.col("label").alias("node"), "label").distinct())
