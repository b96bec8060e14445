"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from clickweir.session import delete_path, scratch_path


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours are linked to its smallest one."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a"))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return (both.filter("v > u").join(least, "u")
            .select(F.col("v").alias("a"), F.col("m").alias("b")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours are linked to the smallest of them; a > b in `edges`."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").filter("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())


def _stored(edges: DataFrame, label: str) -> tuple[str, DataFrame]:
    path = scratch_path(edges.sparkSession, label)
    edges.write.parquet(path)
    return path, edges.sparkSession.read.schema(edges.schema).parquet(path)


def connected_components(edges: DataFrame, label: str = "links") -> DataFrame:
    """node, component (the smallest node reachable) for every node that has a link.

    `edges` has columns a and b; direction, repetition and loops don't matter. Large-star and
    small-star rounds, each a stored table, until nothing changes. Minima are combined before
    shuffles; a node with very many links meets them in a join, which adaptive skew handling splits
    on the side of the links. Only a count and a checksum reach the driver.
    """
    spark = edges.sparkSession
    first = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    path, now = _stored(first, label)
    mark = _mark(now)
    while True:
        old = path
        path, now = _stored(_small_star(_large_star(now)), label)
        before, mark = mark, _mark(now)
        delete_path(spark, old)      # the new round is complete in the shared folder
        if mark == before:
            break
    roots = now.select(F.col("b").alias("node")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        roots.select("node", F.col("node").alias("component")))
