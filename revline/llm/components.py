"""Connected components of an edge table, by alternating large and small stars.

Each step replaces every node's edges by edges to its smallest neighbour. Work
and memory of a step are linear in the edges; a number of steps logarithmic in
the longest path suffices. Every step is written to the shared scratch folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revline.session import write_scratch


def shuffled_anew(df: DataFrame, key: str) -> DataFrame:
    """``df`` with a whole-number key that Spark takes for a new one.

    An aggregate by ``key`` is already partitioned by it, and a join would use it
    as it stands. With a shuffle of its own on both sides, adaptive execution can
    split the rows of a hot key over many tasks.
    """
    return df.withColumn(key, F.col(key).bitwiseXOR(F.lit(0).cast("long")))


def _star(arcs: DataFrame) -> DataFrame:
    """(u, v, m): each arc with the smallest of u and its arcs' ends.

    A node may have a third of all arcs: the minimum is combined before the
    shuffle, and the join can be split.
    """
    least = arcs.groupBy("u").agg(F.min("v").alias("m"))
    return arcs.join(shuffled_anew(least, "u"), "u").withColumn("m", F.least("m", "u"))


def _large(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionByName(
        edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return (_star(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .where("u <> v").distinct())


def _small(edges: DataFrame) -> DataFrame:
    """Edges point from the larger node u to the smaller v."""
    starred = _star(edges)
    moved = starred.select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = starred.select("u", F.col("m").alias("v"))
    return moved.unionByName(own).where("u <> v").distinct()


def _unfinished(edges: DataFrame) -> bool:
    """True while a node points to two nodes, or to one that points on: then the
    edges are not yet stars around the smallest nodes."""
    ends = edges.select(F.col("u").alias("x"), F.lit(1).alias("out"), F.lit(0).alias("inward")).unionByName(
        edges.select(F.col("v").alias("x"), F.lit(0).alias("out"), F.lit(1).alias("inward")))
    nodes = ends.groupBy("x").agg(F.sum("out").alias("out"), F.max("inward").alias("inward"))
    return not nodes.where("out > 1 OR (out > 0 AND inward > 0)").isEmpty()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node it is connected to, for every node with an edge.

    Self-loops and repeated edges do no harm; nulls are left out. A self-loop
    alone gives no row.
    """
    edges = write_scratch(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
             .where(F.col(a).isNotNull() & F.col(b).isNotNull()).where("u <> v").distinct(), "edges")
    while _unfinished(edges):
        edges = write_scratch(_small(_large(edges)), "edges")
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
