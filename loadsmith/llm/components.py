"""Connected components of a graph given as edges, as Spark joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadsmith.scratch import remove, scratch_path


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node that reaches a smaller one; root is the smallest of these.

    Alternating star operations: large stars link each larger neighbour to the smallest
    one, small stars the smaller ones, until nothing changes (a few rounds; each halves
    the depth at least).  Minima are aggregated before the shuffle and joined back, so a
    node with very many neighbours is a skewed join side, which Spark splits.  Each round
    is written to the shared checkpoint folder.  ``edges``: two long columns, null-free.
    """
    spark = edges.sparkSession
    a, b = edges.columns
    now = edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct()
    seen, last = None, None
    while True:
        if seen is not None:
            now = _small_star(_large_star(now))
        path = scratch_path(spark, "stars")
        now.write.parquet(path)
        now = spark.read.schema("a long, b long").parquet(path)
        mark = now.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("b", "a").cast("decimal(38,0)"))).first()
        if last:
            remove(spark, last)
        if tuple(mark) == seen:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen, last = tuple(mark), path


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.withColumnRenamed("m", "b")).distinct()
