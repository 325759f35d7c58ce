"""Connected components of a graph, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from broadsheet.llm.scratch import remove, written


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
    return tuple(row)


def components(links: DataFrame) -> DataFrame:
    """``(node, component)`` of every node of ``links(a, b)``: the least node it reaches.

    Each step rewires edges to the least neighbour seen, so the number of steps grows with
    the logarithm of the longest path. Least neighbours are partial aggregates, and the
    joins are equi-joins that adaptive execution can split, so a node of very many links
    does not fill a task. Links never leave the executors.
    """
    a, b = F.col("a"), F.col("b")
    edges = written(links.where(a != b).select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "edges")
    before, state = None, _state(edges)
    while state != before:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(
            "u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").where("v != m").select(
            F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = written(large, "edges")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(
            F.explode(F.when(F.col("v") == F.col("m"), F.array(F.struct("u", F.col("m").alias("v"))))
                      .otherwise(F.array(F.struct("u", F.col("m").alias("v")),
                                         F.struct(F.col("v").alias("u"), F.col("m").alias("v")))))
            .alias("e")).select("e.*").distinct()
        small = written(small, "edges")
        remove(edges)
        remove(large)
        edges = small
        before, state = state, _state(edges)
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
